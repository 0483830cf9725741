"""From raw documents to token identifiers: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.llm import digests, leaks, minhash, pieces, quality
from rankweave.llm.common import kept, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity lies within the limit of their language."""
    read = ["doc_id", "lang", "text"]
    rest = F.struct(F.lit(0).alias("none"), *[c for c in docs.columns if c not in read])
    left = quality.judged(docs.select(*read, rest.alias("rest")), table(spark, sf_dir, "labels")).where("q_kept")
    return left.select(*[c if c in read else F.col("rest")[c].alias(c) for c in docs.columns])


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id. Of rows that agree in both, also without doc_id, one stays."""
    marks = kept(digests.exact_duplicates(docs).select("doc_id", "kept", F.col("text_sha256").alias("digest")), "exact-marks")
    dropped = marks.where("not kept").select("doc_id", "digest")
    digest = F.sha2(F.coalesce(docs["text"], F.lit("")), 256)
    left = docs.join(dropped, docs["doc_id"].eqNullSafe(dropped["doc_id"]) & (digest == dropped["digest"]), "left_anti")
    again = kept(marks.where("kept").groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest"), "given-again")
    if again.isEmpty():
        return left
    rows = left.select(F.struct(*docs.columns).alias("row"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))
    once = rows.join(again, "digest", "left_anti").select("row")
    one = rows.join(again, "digest", "left_semi").groupBy("digest").agg(F.max("row").alias("row")).select("row")
    return once.unionByName(one).select("row.*")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8."""
    dropped = minhash.near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(docs.columns)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    own = docs.select(F.struct(*docs.columns).alias("row"), "text")
    return leaks.leaks(own, table(spark, sf_dir, "benchmark")).where(F.size("leaks") == 0).select("row.*")


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, pieces, exact for every document left."""
    return pieces.sentence_pieces(docs)


STAGES = [
    ("quality", quality_stage),
    ("exact_duplicates", exact_stage),
    ("near_duplicates", near_stage),
    ("benchmark", benchmark_stage),
    ("sentence_pieces", pieces_stage),
]

# Model, hash minima and path search have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
