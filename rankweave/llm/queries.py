"""Registered queries of the corpus operators, and their SQL forms in DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.llm import centroids, chat, digests, leaks, lengths, lines, minhash, pieces, quality, repeats, search, tiles, toxicity
from rankweave.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.preference_format(chat.preference_sides(table(spark, sf_dir, "conversations")))


ORACLE["op1_preference_format"] = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
h AS (
  SELECT conv_id, lead(conv_id) OVER w AS next_id, lag(conv_id) OVER w AS earlier_id
  FROM t WHERE pos = 0 WINDOW w AS (PARTITION BY role, text ORDER BY conv_id)),
l AS (
  SELECT t.conv_id, max(pos) AS last FROM t JOIN h USING (conv_id)
  WHERE next_id IS NULL AND earlier_id IS NULL AND role = 'assistant' GROUP BY t.conv_id),
s AS (
  SELECT conv_id AS pair_id, next_id AS rejected_id, true AS chosen, pos, role, text FROM h JOIN t USING (conv_id) WHERE next_id IS NOT NULL
  UNION ALL SELECT h.conv_id, next_id, false, pos, role, text FROM h JOIN t ON t.conv_id = next_id
  UNION ALL SELECT conv_id, NULL, true, pos, role, text FROM l JOIN t USING (conv_id) WHERE pos <= last
  UNION ALL SELECT conv_id, NULL, false, pos, role, CASE WHEN pos = last THEN substring(text, 1, length(text) // 2) ELSE text END
  FROM l JOIN t USING (conv_id) WHERE pos <= last),
b AS (
  SELECT pair_id, pos, max(rejected_id) AS rejected_id, max(role) FILTER (chosen) AS cr, max(text) FILTER (chosen) AS ct,
         max(role) FILTER (NOT chosen) AS rr, max(text) FILTER (NOT chosen) AS rt
  FROM s GROUP BY pair_id, pos),
d AS (
  SELECT *, '<|im_start|>' || cr || chr(10) || ct || '<|im_end|>' || chr(10) AS c, '<|im_start|>' || rr || chr(10) || rt || '<|im_end|>' || chr(10) AS r,
         pos < coalesce(min(CASE WHEN cr IS DISTINCT FROM rr OR ct IS DISTINCT FROM rt THEN pos END) OVER (PARTITION BY pair_id), pos + 1) AS shared
  FROM b),
e AS (
  SELECT *, sum(CASE WHEN NOT shared THEN length(c) END) OVER w AS ce, sum(CASE WHEN NOT shared THEN length(r) END) OVER w AS re
  FROM d WINDOW w AS (PARTITION BY pair_id ORDER BY pos))
SELECT pair_id, max(rejected_id) AS rejected_id, count(*) FILTER (shared) AS prompt_turns,
       coalesce(string_agg(c, '' ORDER BY pos) FILTER (shared), '') AS prompt,
       coalesce(string_agg(c, '' ORDER BY pos) FILTER (NOT shared), '') AS chosen,
       coalesce(string_agg(r, '' ORDER BY pos) FILTER (NOT shared), '') AS rejected,
       coalesce(string_agg((ce - length(c) + 13 + length(cr))::BIGINT || '-' || (ce - 1)::BIGINT, ',' ORDER BY pos) FILTER (NOT shared AND cr = 'assistant'), '') AS chosen_mask,
       coalesce(string_agg((re - length(r) + 13 + length(rr))::BIGINT || '-' || (re - 1)::BIGINT, ',' ORDER BY pos) FILTER (NOT shared AND rr = 'assistant'), '') AS rejected_mask
FROM e GROUP BY pair_id
"""


@query
def op2_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.without_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


ORACLE["op2_repeated_passages"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, unnest(range(0, length(h) // 2)) AS pos, h FROM d),
b AS (SELECT doc_id, pos, substr(h, 2 * pos + 1, 2) AS byte,
             CASE WHEN 2 * pos + 200 <= length(h) THEN substr(h, 2 * pos + 1, 200) END AS win FROM p),
f AS (SELECT doc_id, pos, byte, win IS NOT NULL AND row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) > 1 AS later FROM b),
c AS (SELECT doc_id, pos, byte, bool_or(later) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS gone FROM f),
e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY pos), false) AS begins FROM c),
g AS (SELECT doc_id, count(*) AS n_bytes, count(*) FILTER (gone) AS n_removed, count(*) FILTER (begins) AS n_spans,
             string_agg(byte, '' ORDER BY pos) FILTER (NOT gone) AS kept FROM e GROUP BY doc_id)
SELECT doc_id, coalesce(n_bytes, 0) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)
"""


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.judged(docs, labels, carry=["doc_id", "lang"]).select(
        "doc_id", "lang", F.col("q_symbols").alias("n_symbols"), F.col("q_perplexity").alias("perplexity"),
        F.col("q_limit").alias("perplexity_limit"), F.col("q_kept").alias("kept"),
    )


@query
def op4_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.without_repeated_lines(table(spark, sf_dir, "documents"))


ORACLE["op4_repeated_lines"] = """
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
x AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS pos FROM l),
w AS (SELECT doc_id, pos, line || chr(10) || lead(line, 1) OVER o || chr(10) || lead(line, 2) OVER o AS win
      FROM x WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
f AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) AS r FROM w WHERE win IS NOT NULL),
c AS (SELECT DISTINCT doc_id, pos + k AS pos FROM f, (VALUES (0), (1), (2)) AS v(k) WHERE r > 1),
g AS (SELECT x.doc_id, count(*) AS n_lines, count(c.pos) AS n_removed, string_agg(line, chr(10) ORDER BY x.pos) FILTER (c.pos IS NULL) AS kept_text
      FROM x LEFT JOIN c ON x.doc_id = c.doc_id AND x.pos = c.pos GROUP BY x.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN coalesce(kept_text, '') END AS kept_text
FROM documents d LEFT JOIN g USING (doc_id)
"""


@query
def op5_token_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lengths.limit_answers(lengths.length_histogram(docs, lengths.token_count("text")))


@query
def op6_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests.exact_duplicates(table(spark, sf_dir, "documents"))


ORACLE["op6_exact_duplicates"] = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256, strlen(coalesce(text, ''))::BIGINT AS n_bytes
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


ORACLE["op8_near_duplicates"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) = 1 THEN ws[1] ELSE ws[i] || ' ' || ws[i + 1] END AS sh
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws), 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
t AS (SELECT doc_id, sh, n FROM s JOIN n USING (doc_id)),
e AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.sh = b.sh AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT r.doc_id, u.b FROM r JOIN u ON r.c = u.a)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(c) AS component_id, r.doc_id = min(c) AS kept
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""


@query
def op9_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = leaks.leaks(docs, table(spark, sf_dir, "benchmark"))
    items = F.transform("leaks", lambda x: x["item_id"])
    return out.select("doc_id", (F.size("leaks") > 0).alias("leaked"), items.alias("item_ids"))


@query
def op10_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.sentence_pieces(table(spark, sf_dir, "documents"))


@query
def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.similar_documents(table(spark, sf_dir, "documents"), size=4, percent=85)


ORACLE["op11_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS sh
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
t AS (SELECT doc_id, sh, n FROM s JOIN n USING (doc_id)),
e AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.sh = b.sh AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT r.doc_id, u.b FROM r JOIN u ON r.c = u.a)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(c) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""


@query
def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(table(spark, sf_dir, "embeddings"), k=40, rounds=5, seed="2:")


def _centroids_sql(rounds: int = 5) -> str:
    """Distances as sums over components; they stay far below 2 ** 53, so sums of doubles are exact."""
    steps = [
        """WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM v),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id::VARCHAR), v) - 1 AS c, v
  FROM v WHERE vec_id IS NOT NULL QUALIFY c < 40)"""
    ]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS (
  SELECT vec_id, v.v, min(struct_pack(d := list_sum(list_transform(list_zip(v.v, k.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT, c := c)) AS best
  FROM v CROSS JOIN c{r} k GROUP BY vec_id, v.v)""")
        if r < rounds:
            steps.append(f"""s{r} AS (
  SELECT best.c AS c, j, sum(x)::BIGINT AS s, count(*) AS n
  FROM (SELECT best, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM a{r}) GROUP BY best.c, j),
m{r} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY j) AS v FROM s{r} GROUP BY c),
c{r + 1} AS (SELECT c, coalesce(m{r}.v, c{r}.v) AS v FROM c{r} LEFT JOIN m{r} USING (c))""")
    return ",\n".join(steps) + f"""
SELECT vec_id, best.c::INTEGER AS cluster, best.d AS distance, (sum(best.d) OVER (PARTITION BY best.c))::BIGINT AS cluster_inertia,
       (sum(best.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(k.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} k ON k.c = best.c
"""


ORACLE["op12_centroids"] = _centroids_sql()


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


_TERMS = r"""unnest(regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term"""

ORACLE["op13_ranked_search"] = f"""
WITH t AS (SELECT doc_id, {_TERMS.format("text")} FROM documents),
n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
z AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM n),
p AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, z GROUP BY term, docs),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, {_TERMS.format("text")} FROM benchmark) GROUP BY ALL),
m AS (SELECT doc_id, 25 + (75 * n * docs) // total AS m FROM n, z),
s AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN p USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10
"""
