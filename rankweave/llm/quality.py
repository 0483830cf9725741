"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is over whole code points (`ngrams`): its tables grow with the trusted text and are joined by shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.llm import ngrams
from rankweave.llm.common import kept
from rankweave.storage import fits_broadcast

# Share of the trusted documents of a language that lie within its limit; README says what others cost.
QUANTILE = 0.995
# One of so many trusted documents is kept out of the model and gives the quantiles.
HELD_OUT = 5
# Symbols of average text a document is filled up with: without, short trusted texts lift the limits for all.
PRIOR_SYMBOLS = 60
# A language with fewer such documents takes the quantile of all.
LEAST_TRUSTED = 5
# Bits of a map of trusted identifiers: sixteen for each, but 16 MB at most. A full map only leaves all rows in.
BITS_EACH, MOST_BITS = 16, 1 << 27
ADDED = ["q_symbols", "q_perplexity", "q_limit", "q_kept"]
# Fixed value: bits of one row of such a map.
MAP_BITS = 1 << 15


def likely(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """Rows of `docs` whose doc_id is in `trusted`, and some others: those whose hash falls on a bit of the map as well.

    Cuts texts down before they are shuffled. The map is broadcast; it has 4,096 rows of 4 KB at most.
    """
    bits = min(MOST_BITS, max(MAP_BITS, 1 << (BITS_EACH * trusted.count()).bit_length()))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    part, bit = F.floor(place / MAP_BITS), place % MAP_BITS
    rows = trusted.select(part.alias("map_part"), bit.alias("bit")).groupBy("map_part").agg(F.bitmap_construct_agg("bit").alias("map_bits"))
    found = docs.withColumns({"map_part": part, "map_bit": bit}).join(F.broadcast(rows), "map_part")
    byte = F.conv(F.hex(F.expr("substring(map_bits, cast(map_bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    return found.where(F.getbit(byte, (F.col("map_bit") % 8).cast("int")) == 1).select(docs.columns)


def train(docs: DataFrame, trusted: DataFrame) -> dict[int, DataFrame]:
    """The model of all trusted texts: rows of `docs` whose doc_id is among the identifiers in `trusted`."""
    # labels grow with the documents, so they are not broadcast, however few there are
    trusted = trusted.select("doc_id").distinct()
    texts = likely(docs.select("doc_id", "text"), trusted).join(trusted.hint("merge"), "doc_id").select("text")
    return ngrams.kneser_ney(ngrams.counts(texts))


def judged(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, carry: list[str] | None = None) -> DataFrame:
    """`docs` with columns q_symbols, q_perplexity, q_limit and q_kept; columns of these names in `docs` are replaced.

    Trusted are the documents that a label marks with quality 1. Perplexity is per symbol, with PRIOR_SYMBOLS symbols
    of average trusted text added to each document, so an empty or null text has the average and is kept. A fifth of
    the trusted documents is not trained on. The limit of a language is the `quantile` of its documents in that
    fifth; languages with fewer than LEAST_TRUSTED there, and null, take the quantile of all. Without any trusted
    text nothing is rejected. A null doc_id has no label; a doc_id given twice is judged for each row. Of the columns
    of `docs` only `carry` is in the result, if given; it must have doc_id and lang.
    """
    trusted = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    aside = F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0
    model = train(docs, trusted.where(~aside))
    read = ["doc_id", "lang", "text"]
    result = [c for c in carry or docs.columns if c not in ADDED]
    # the caller's other columns in one, whatever their names
    others = {c: f"c{i}" for i, c in enumerate(c for c in result if c not in read)}
    rest = F.struct(F.lit(0).alias("c"), *[docs[f"`{c}`"].alias(place) for c, place in others.items()])
    own = docs.select(*read, rest.alias("rest"))
    scored = kept(ngrams.scored(own, "text", model, ["doc_id", "lang", "rest", *[c for c in result if c == "text"]]), "scores")
    known = kept(scored.select("doc_id", "lang", F.col("symbols").alias("n"), "nll").join(trusted.where(aside), "doc_id"), "trusted-scores")
    mean = known.agg(F.sum("nll") / F.sum("n")).first()[0] or 0.0
    smooth = lambda nll, n: F.exp((nll + PRIOR_SYMBOLS * mean) / (n + PRIOR_SYMBOLS))
    value = smooth(F.col("nll"), F.col("n"))
    whole = known.agg(F.percentile_approx(value, quantile, 10_000)).first()[0]
    limits = known.groupBy("lang").agg(F.percentile_approx(value, quantile, 10_000).alias("own"), F.count("*").alias("rows"))
    limits = limits.where(F.col("rows") >= LEAST_TRUSTED).where("lang is not null").select(F.col("lang").alias("q_lang"), "own")
    limits = kept(limits, "limits")
    limits = F.broadcast(limits) if fits_broadcast(limits) else limits
    out = scored.withColumns({"q_symbols": F.col("symbols"), "q_perplexity": smooth(F.col("nll"), F.col("symbols"))})
    out = out.join(limits, out["lang"] == limits["q_lang"], "left")
    out = out.withColumn("q_limit", F.coalesce("own", F.lit(whole).cast("double")))
    kept_flag = F.coalesce(F.col("q_perplexity") <= F.col("q_limit"), F.lit(True))
    columns = [F.col("rest")[others[c]].alias(c) if c in others else c for c in result]
    return out.withColumn("q_kept", kept_flag).select(*columns, *ADDED)
