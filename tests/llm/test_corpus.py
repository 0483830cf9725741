"""The corpus operators against brute force, and on nulls, empty and long texts, repeats, empty tables and odd columns."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import DATA, rows
from rankweave.llm import chat, components, digests, leaks, lengths, lines, minhash, ngrams, pieces, quality, repeats, toxicity
from rankweave.llm.common import table

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, bucket string, kept string, k int"


def documents(spark, texts, schema=SCHEMA):
    """Rows from (doc_id, text), with columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, "en", "s", 0, 0.5, "b", "x", 1) for i, t in texts], schema).repartition(3)


def prose(seed, count, size=40):
    pick = random.Random(seed)
    vocabulary = ["".join(pick.choices("abcdefghij", k=pick.randint(1, 6))) for _ in range(400)]
    return [" ".join(pick.choices(vocabulary, k=pick.randint(1, size))) for _ in range(count)]


ODD = [(None, None), (None, "a b c"), (1, None), (2, ""), (3, " \n\t "), (4, "ü▁s \u0000 ▁"), (5, "x"), (5, "x"), (5, "y"), (6, "word " * 30_000)]


# exact duplicates


def test_exact_duplicates_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(digests, "RANGE_ROWS", 10)
    texts = [(i, t) for i, t in enumerate(prose(1, 60) * 3 + [""] * 5)]
    groups = collections.defaultdict(list)
    for i, t in texts:
        groups[t].append(i)
    expected = {(i, max(groups[t]), len(groups[t]), i == max(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in texts}
    out = digests.exact_duplicates(documents(spark, texts).repartition(11))
    assert {tuple(r)[:5] for r in out.collect()} == expected
    low = digests.exact_duplicates(documents(spark, texts), keep="low")
    assert {r["doc_id"]: r["keep_id"] for r in low.collect()} == {i: min(groups[t]) for i, t in texts}


def test_exact_duplicates_of_odd_rows(spark):
    out = digests.exact_duplicates(documents(spark, ODD)).collect()
    assert len(out) == len(ODD)
    empty = [r for r in out if r["n_bytes"] == 0]
    assert {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in empty} == {(None, 2, 3, False), (1, 2, 3, False), (2, 2, 3, True)}
    assert all(r["kept"] and r["group_size"] == 2 for r in out if r["doc_id"] == 5 and r["text_sha256"] == hashlib.sha256(b"x").hexdigest())


# repeated passages


def cut(texts):
    """Brute force: bytes covered by a 100-byte string that starts earlier too."""
    seen, out = set(), {}
    for i, t in sorted(texts, key=lambda x: x[0]):
        data = t.encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            own = data[p : p + 100]
            if own in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(own)
        runs = len(re.findall(b"\x01+", bytes(gone)))
        out[i] = (len(data), sum(gone), runs, bytes(b for b, g in zip(data, gone) if not g))
    return out


def test_repeats_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(repeats, "ROUTE_BYTES", 4000)
    passages, pick = prose(2, 12, 60), random.Random(3)
    texts = [(i, " ".join([t, pick.choice(passages), pick.choice(passages), "é" * pick.randint(0, 130)])) for i, t in enumerate(prose(4, 70))]
    texts += [(100 + i, t) for i, (_, t) in enumerate(texts[:20])] + [(200, "ab" * 400), (201, "\0" * 250)]
    out = repeats.without_repeats(documents(spark, texts)).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in out} == cut(texts)


def test_segments_that_share_an_anchor_alone_need_no_transform(monkeypatch):
    import numpy as np

    pick, phrase = random.Random(45), "one phrase of some words stands here"
    noise = lambda n: "".join(pick.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    sides = [(noise(80), noise(80)) for _ in range(4)]
    texts = [noise(120) + phrase + noise(120) for _ in range(60)]
    # strings that repeat mostly before, mostly behind and on both sides of the phrase
    for before, behind in ((64, 0), (65, 5), (5, 65), (0, 64), (32, 32), (30, 34), (80, 80), (31, 32), (63, 0)):
        a, b = pick.choice(sides)
        texts += [noise(150) + a[len(a) - before :] + phrase + b[:behind] + noise(150) for _ in range(2)]
    body = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    docs, keys = np.arange(len(texts)), np.zeros(len(texts), np.int32)
    blocks = [b for _, b in repeats._packed(docs, keys, body, repeats.segments(body, offsets), 1)]
    transformed, later_windows = [], repeats._later_windows
    monkeypatch.setattr(repeats, "_later_windows", lambda text, left: transformed.append(len(text)) or later_windows(text, left))
    ids, _, doc, start, end = repeats._removed_runs(blocks)
    gone = [0] * len(texts)
    for i in set(ids[doc].tolist()):
        s, e = repeats._merged_runs([start[ids[doc] == i]], [end[ids[doc] == i]])
        gone[i] = int((e - s).sum())
    assert gone == [n for _, (_, n, _, _) in sorted(cut(enumerate(texts)).items())]
    assert sum(x > 0 for x in gone) >= 7
    assert 0 < sum(transformed) < 60 * 100


def phrased(count):
    """Texts that all hold one phrase, each in other surroundings; every fifth one repeats a whole passage, too."""
    fill = prose(42, 2 * count, 60)
    passage = "p" + " ".join(prose(43, 3, 60))
    return [
        (i, f"{fill[2 * i]} this very phrase stands in every document {fill[2 * i + 1]}" + (passage if i % 5 == 0 else ""))
        for i in range(count)
    ]


def test_repeats_around_a_phrase_in_every_text(spark, monkeypatch):
    import numpy as np

    for name, value in {"ROUTE_BYTES": 3000, "PACK_BYTES": 4000, "HOT_SEGMENTS": 12, "LEAST_REPORTED": 2}.items():
        monkeypatch.setattr(repeats, name, value)
    texts = phrased(150)
    docs = documents(spark, texts)
    hot = repeats.hot_routes(docs, sum(len(t) for _, t in texts))
    assert len(hot)
    out = repeats.without_repeats(docs).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in out} == cut(texts)
    # most segments at one route: a third and more of the texts before, far fewer after
    data = np.frombuffer("".join(t for _, t in texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t.encode()) for _, t in texts])
    before, after = (repeats.segments(data, offsets, h) for h in (None, hot))
    most = [len(np.unique(s.head[s.route == r])) for s in (before, after) for r in [max(set(s.route.tolist()), key=s.route.tolist().count)]]
    assert most[0] >= 50 and most[1] <= 12


def test_repeats_across_packs_and_blocks(monkeypatch):
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(repeats, "PACK_BYTES", 3000)
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 2000)
    passages, pick = prose(5, 6, 60), random.Random(6)
    texts = [(i, " ".join([pick.choice(passages), t, pick.choice(passages)])) for i, t in enumerate(prose(7, 60))]
    batch = pa.record_batch([pa.array([i for i, _ in texts], pa.int64()), pa.array([0] * 60, pa.int32()), pa.array([t for _, t in texts])], ["id", "mark", "text"])
    gone = {i: bytearray(len(t.encode())) for i, t in texts}
    routes = collections.defaultdict(list)
    for part in repeats._routed(3)(iter([batch.slice(k, 7) for k in range(0, 60, 7)])):
        for route, block in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            routes[route].append(block)
    for blocks in routes.values():
        docs, _, doc, start, end = repeats._removed_runs(blocks)
        for i, s, e in zip(docs[doc], start, end):
            gone[int(i)][s:e] = b"\1" * int(e - s)
    assert {i: sum(x) for i, x in gone.items()} == {i: x[1] for i, x in cut(texts).items()}
    assert np.all([len(b) for b in routes.values()])


def test_prefix_bounds_match_brute_force():
    import numpy as np

    pick = random.Random(8)
    text = np.frombuffer(("".join(pick.choices("ab", k=300)) * 2 + "c" * 150 + "\0").encode(), np.uint8)
    order = repeats.suffix_order(text)
    padded = text.tobytes() + b"\0" * 200
    heads = [padded[p : p + 100] for p in order]
    assert heads == sorted(heads)
    bound = repeats.prefix_bounds(text, order)
    assert bound.tolist() == [True] + [a != b for a, b in zip(heads, heads[1:])]


def test_repeats_of_odd_rows(spark):
    out = repeats.without_repeats(documents(spark, ODD)).collect()
    assert len(out) == len(ODD)
    assert {(r["n_bytes"], r["n_removed"]) for r in out if r["doc_id"] in (1, 2, 5)} == {(0, 0), (1, 0)}
    assert next(r["n_removed"] for r in out if r["doc_id"] == 6) == 150_000 - 5


# lines


def test_repeated_lines_match_brute_force(spark):
    pick = random.Random(9)
    pool = [f"line {k}" for k in range(12)]
    texts = [(i, "\n".join(pick.choices(pool, k=pick.randint(1, 9)))) for i in range(80)]
    seen, expected = set(), {}
    for i, t in texts:
        own = t.split("\n")
        gone = set()
        for k in range(len(own) - 2):
            window = tuple(own[k : k + 3])
            if window in seen:
                gone |= {k, k + 1, k + 2}
            seen.add(window)
        expected[i] = (len(own), len(gone), "\n".join(x for k, x in enumerate(own) if k not in gone))
    out = lines.without_repeated_lines(documents(spark, texts)).collect()
    assert {r["doc_id"]: (r["n_lines"], r["n_removed"], r["kept_text"]) for r in out} == expected


def test_repeated_lines_of_odd_rows(spark):
    out = lines.without_repeated_lines(documents(spark, [*ODD, (7, "a\nb\nc"), (None, "a\nb\nc")])).collect()
    assert {(r["n_lines"], r["n_removed"], r["kept_text"]) for r in out if r["doc_id"] in (1, 2, 7)} == {(0, 0, None), (1, 0, ""), (3, 3, "")}


# token counts


def test_length_answers_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lengths, "RANGE", 7)
    sizes = [random.Random(10).randint(0, 60) for _ in range(200)]
    df = spark.createDataFrame([(n,) for n in sizes], "n bigint")
    answers = lengths.limit_answers(lengths.length_histogram(df, F.col("n")))
    for r in answers.collect():
        limit = r["length"]
        assert r["truncated_total"] == sum(min(n, limit) for n in sizes)
        assert (r["docs_cut"], r["docs_at_least"]) == (sum(n > limit for n in sizes), sum(n >= limit for n in sizes))
        assert r["tokens_at_least"] == sum(n for n in sizes if n >= limit) and r["total_tokens"] == sum(sizes)
    limits = {r["limit"]: (r["truncated_total"], r["docs_cut"]) for r in lengths.truncated_at(answers, [0, 13, 99]).collect()}
    assert limits == {x: (sum(min(n, x) for n in sizes), sum(n > x for n in sizes)) for x in (0, 13, 99)}
    shares = {r["share"]: r["length"] for r in lengths.length_quantiles(answers, [0.5, 1.0]).collect()}
    assert shares == {0.5: sorted(sizes)[99], 1.0: max(sizes)}


def test_token_counts_of_odd_rows(spark):
    docs = documents(spark, ODD)
    out = docs.select("doc_id", lengths.token_count("text").alias("n")).where("doc_id in (1, 2, 6)")
    assert {r["doc_id"]: r["n"] > 0 for r in out.collect()} == {1: False, 2: False, 6: True}


# chat


def test_preference_format(spark):
    turns = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", "x"), (1, 3, "assistant", "yes"),
        (2, 0, "user", "hi"), (2, 1, "assistant", "hello"), (2, 2, "user", "y"), (2, 3, "assistant", None),
        (3, 0, "system", "s"), (3, 1, "assistant", "abcd"), (3, 2, "user", "bye"), (4, 0, "user", "no reply"),
        (None, 0, "user", "hi"), (5, None, None, None), (2000, 0, "user", "hi"),
    ]
    conversations = spark.createDataFrame([(*t, 1) for t in turns], "conv_id bigint, turn bigint, role string, text string, pos int")
    out = {r["pair_id"]: r for r in chat.preference_format(chat.preference_sides(conversations)).collect()}
    assert set(out) == {1, 2, 3}
    assert (out[1]["rejected_id"], out[2]["rejected_id"], out[3]["rejected_id"]) == (2, 2000, None)
    mark = lambda role, text: f"<|im_start|>{role}\n{text}<|im_end|>\n"
    assert out[1]["prompt_turns"] == 2 and out[1]["prompt"] == mark("user", "hi") + mark("assistant", "hello")
    assert out[1]["chosen"] == mark("user", "x") + mark("assistant", "yes")
    start, end = map(int, out[1]["chosen_mask"].split("-"))
    assert out[1]["chosen"][start:end] == "yes<|im_end|>"
    assert out[2]["prompt_turns"] == 1 and out[2]["rejected"] == "" and out[2]["rejected_mask"] == ""
    assert out[3]["chosen"] == mark("assistant", "abcd") and out[3]["rejected"] == mark("assistant", "ab")


# quality


def test_map_of_identifiers_leaves_all_trusted_rows_in(spark, monkeypatch):
    docs = spark.range(40_000).select((F.col("id") * 7 - 9_000).alias("doc_id"), F.lit("t").alias("text"))
    trusted = docs.where("doc_id % 5 = 0").select("doc_id")
    left = quality.likely(docs, trusted)
    assert left.columns == docs.columns and left.join(trusted, "doc_id").count() == trusted.count()
    assert left.count() < 1.3 * trusted.count()
    assert quality.likely(docs, trusted.limit(0)).count() == 0
    monkeypatch.setattr(quality, "MOST_BITS", quality.MAP_BITS)
    assert quality.likely(docs, docs.select("doc_id")).count() == 40_000


def test_quality_leaves_the_columns_of_the_caller(spark):
    texts = list(enumerate(prose(36, 30)))
    docs = documents(spark, texts)
    names = ["own", "ngram_block", "symbols", "nll", "q_lang", "q_limit", "rest", "none", "map_part", "block"]
    docs = docs.select("doc_id", "lang", "text", *[F.lit(name).alias(name) for name in names])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id bigint, quality int, toxic int")
    out = quality.judged(docs, labels)
    names.remove("q_limit")
    assert out.columns == ["doc_id", "lang", "text", *names, "q_symbols", "q_perplexity", "q_limit", "q_kept"]
    assert rows(out.select("doc_id", "text", *names)) == sorted([(i, t, *names) for i, t in texts], key=repr)


def test_quality_keeps_clean_and_drops_junk(spark):
    docs, labels = table(spark, str(DATA), "documents"), table(spark, str(DATA), "labels")
    out = quality.judged(docs, labels).join(labels, "doc_id")
    got = {(r["quality"], r["q_kept"]): r["n"] for r in out.groupBy("quality", "q_kept").agg(F.count("*").alias("n")).collect()}
    assert got.get((1, False), 0) <= 0.05 * (got[1, True] + 1) and got[0, False] >= 0.6 * (got[0, False] + got.get((0, True), 0))


def test_quality_of_odd_rows(spark):
    docs = documents(spark, ODD)
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 0), (4, None, None)], "doc_id bigint, quality int, toxic int")
    assert all(r["q_kept"] for r in quality.judged(docs, labels).where("text is null or text = ''").collect())
    assert quality.judged(docs, labels.limit(0)).where("q_kept").count() == len(ODD)


def test_ngram_model_matches_brute_force(spark, monkeypatch):
    from math import log

    monkeypatch.setattr(ngrams, "BLOCK", 700)
    monkeypatch.setattr(ngrams, "BLOCKS_A_SALT", 1)
    trusted = prose(31, 40) + ["что за день сегодня", "何の日 𝒳 \0", "", None]
    own = [collections.Counter() for _ in range(5)]
    for t in trusted:
        line = "\U0010ffff" * 3 + (t or "")
        own[4].update(line[k - 3 : k + 1] for k in range(3, len(line)))
    for k in (3, 2, 1):
        own[k].update(x[1:] for x in own[k + 1])
    p, rest = [{} for _ in range(5)], [{} for _ in range(5)]
    for k in range(1, 5):
        n = [sum(c == i for c in own[k].values()) for i in range(5)]
        y = n[1] / (n[1] + 2 * n[2])
        d = [0.5, 1.0, 1.5]
        if all(n[1:]):
            d = [min(max(x, 0.05), i - 0.05) for i, x in ((1, 1 - 2 * y * n[2] / n[1]), (2, 2 - 3 * y * n[3] / n[2]), (3, 3 - 4 * y * n[4] / n[3]))]
        total, passed = collections.Counter(), collections.Counter()
        for g, c in own[k].items():
            total[g[:-1]] += c
            passed[g[:-1]] += d[min(c, 3) - 1]
        p[k] = {g: (c - d[min(c, 3) - 1]) / total[g[:-1]] for g, c in own[k].items()}
        rest[k] = {c: passed[c] / total[c] for c in total}

    def chance(g):
        under = chance(g[1:]) if len(g) > 1 else 1 / (len(own[1]) + 1)
        return p[len(g)].get(g, 0) + rest[len(g)].get(g[:-1], 1) * under

    texts = [*trusted, *prose(32, 20), "ждать 日 ?"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(2)
    model = ngrams.kneser_ney(ngrams.counts(spark.createDataFrame([(t,) for t in trusted], "text string")))
    got = {r["doc_id"]: (r["symbols"], r["nll"]) for r in ngrams.scored(docs, "text", model, ["doc_id"]).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        line = "\U0010ffff" * 3 + (t or "")
        assert got[i] == (len(t or ""), pytest.approx(sum(-log(chance(line[k - 3 : k + 1])) for k in range(3, len(line)))))


def test_rows_of_a_block_travel_whole_and_compressed(spark):
    texts = [*prose(37, 400), None, "", "何の日 𝒳 \0"]
    docs = spark.createDataFrame([(t, i, (i, [str(i)])) for i, t in enumerate(texts)], "text string, doc_id bigint, rest struct<a: bigint, b: array<string>>")
    docs = docs.repartition(3, "doc_id")
    packed = ngrams.packed_blocks(docs).toArrow()
    blocks = set(packed.column("block").to_pylist())
    assert len(blocks) > 1 and blocks == {r["block"] for r in ngrams.block_grams(docs).select("block").distinct().collect()}
    assert sum(map(len, packed.column("packed").to_pylist())) < 0.7 * sum(len((t or "").encode()) for t in texts)
    got = ngrams.unpacked(packed.column("packed")).sort_by("doc_id").to_pylist()
    assert got == [{"text": t, "doc_id": i, "rest": {"a": i, "b": [str(i)]}} for i, t in enumerate(texts)]


def test_quality_tells_letters_of_other_scripts_apart(spark):
    pick = random.Random(33)
    vocabulary = ["".join(pick.choices("абвгд", k=pick.randint(2, 6))) for _ in range(60)]
    clean = [" ".join(pick.choices(vocabulary, k=40)) for _ in range(60)]
    junk = ["".join(x if x == " " else chr(ord(x) + 15) for x in t) for t in clean[:10]]  # equal in classes by code % 15
    docs = documents(spark, list(enumerate(clean + junk)))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id bigint, quality int, toxic int")
    out = {r["doc_id"]: r["q_kept"] for r in quality.judged(docs, labels).collect()}
    assert not any(out[i] for i in range(60, 70)) and sum(out[i] for i in range(60)) >= 55


def test_quality_limit_is_the_quantile_itself(spark):
    docs = documents(spark, list(enumerate(prose(34, 100))))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(100)], "doc_id bigint, quality int, toxic int")
    out = quality.judged(docs, labels).withColumn("aside", F.pmod(F.xxhash64("doc_id"), F.lit(quality.HELD_OUT)) == 0).collect()
    assert {r["q_limit"] for r in out} == {max(r["q_perplexity"] for r in out if r["aside"])}


# toxicity


def test_toxicity_on_held_out_rows(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    out = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out")
    assert out.where("predicted = toxic").count() >= 0.9 * out.count()


def test_grammar_tells_patterns_apart():
    lexicon = toxicity.Lexicon(toxicity.seed_words(), {"achlich": 2.0})
    expected = {
        "what an idiot": {"insult"},
        "you idiot": {"insult aimed"},
        "that film is stupid": {"insult called"},
        "stupid, all of you": {"insult aimed"},
        "you are really stupid": {"insult aimed and called"},
        "he said: you are an idiot": {"insult aimed and called", "reported"},
        "you are not an idiot": {"insult aimed and called", "negated"},
        "not an idiot, an utter moron and loser": {"insult"},
        "hurt them now": {"threat aimed or intended"},
        "I will kill you": {"threat aimed and intended"},
        "we are going to destroy it": {"threat aimed or intended"},
        "to kill time": set(),
        "you. kill. will! hurt": set(),
        "achlichtz": {"insult"},
        "you a b c d idiot": {"insult"},
        "fine": set(),
    }
    sums = toxicity.clause_sums([*expected, None, ""], lexicon)
    got = [{toxicity.PATTERNS[k] for k in range(len(row)) if row[k]} for row in sums]
    assert got == [*expected.values(), set(), set()]
    # one weight for each clause, that of all words its patterns took
    assert toxicity.clause_sums(["idiot moron achlichtz time. idiot; kill idiot"], lexicon)[0].tolist() == [6.0] + [0.0] * 7
    assert toxicity.clause_sums(["kill you idiot"], lexicon)[0].tolist() == [0.0, 2.0, 0.0, 0.0, 2.0, 0.0, 0.0, 0.0]


def test_grammar_matches_a_brute_force_reading():
    """Clauses of random words, each pattern looked up among all words of the clause."""
    lexicon = toxicity.Lexicon(toxicity.seed_words(), {"zzz": 2.5})
    classes = {
        "i": ["idiot", "zzzab"], "t": ["kill", "hurt"], "g": ["you", "sie"], "c": ["is", "sind"],
        "w": ["will", "voy"], "n": ["not", "nie"], "r": ["said"], "o": ["stone", "blau", "42", "zz"],
    }
    pick, scope = random.Random(41), toxicity.SCOPE
    texts, expected = [], []
    for _ in range(3000):
        sums, text = [0.0] * 8, []
        for _ in range(pick.randint(1, 3)):
            kinds = pick.choices("itgcwnroooo", k=pick.randint(0, 9))
            words = [pick.choice(classes[k]) for k in kinds]
            text.append(" ".join(words) + pick.choice(".!?;\n"))
            kinds = [k for k, w in zip(kinds, words) if w != "42"]  # a number is no word
            words = [w for w in words if w != "42"]

            def near(place, kind, after=False, kinds=kinds):
                return kind in kinds[max(0, place - scope) : place] or after and kind in kinds[place + 1 : place + scope + 1]

            insults, threats = ([p for p, k in enumerate(kinds) if k == x] for x in "it")
            found = []
            if insults:
                found.append(2 * any(near(p, "c") for p in insults) + any(near(p, "g", True) for p in insults))
            aimed, meant = any(near(p, "g", True) for p in threats), any(near(p, "w") for p in threats)
            if aimed or meant:
                found.append(4 + (aimed and meant))
            if found and all(near(p, "n") for p in insults + threats):
                found.append(6)
            if found and "r" in kinds:
                found.append(7)
            for k in found:
                sums[k] += sum(2.5 if words[p] == "zzzab" else 1.0 for p in insults + threats * (aimed or meant))
        texts.append("".join(text))
        expected.append(sums)
    assert toxicity.clause_sums(texts, lexicon).tolist() == expected


def test_toxicity_of_odd_rows(spark):
    docs = documents(spark, ODD)
    labels = spark.createDataFrame([(1, 1, 0), (5, 1, 1), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    for some in (labels, labels.limit(0)):
        out = toxicity.toxicity(docs, some).collect()
        assert len(out) == len(ODD) and all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in out)


# near duplicates


def test_near_duplicates_match_brute_force(spark):
    pick, texts = random.Random(13), []
    for base in prose(14, 25, 60):
        own = base.split()
        for _ in range(4):
            copy = list(own)
            for _ in range(pick.randint(0, 4)):
                copy[pick.randrange(len(copy))] = "z%d" % pick.randint(0, 9)
            texts.append(" ".join(copy).upper() if pick.random() < 0.3 else " ".join(copy))
    texts = list(enumerate(texts))
    sets = {}
    for i, t in texts:
        w = t.lower().split()
        sets[i] = set(zip(w, w[1:])) if len(w) > 1 else {tuple(w)}
    least = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and least[a] < least[b]:
                    least[b], changed = least[a], True
    out = minhash.near_duplicates(documents(spark, texts), size=2)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out.collect()} == {i: (len(sets[i]), least[i]) for i in sets}


def test_near_duplicates_of_odd_rows(spark):
    out = minhash.near_duplicates(documents(spark, ODD), size=2).collect()
    assert len(out) == len(ODD)
    assert {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in out if r["doc_id"] in (1, 2, 3)} == {(i, 0, i, True) for i in (1, 2, 3)}
    assert next(r["n_shingles"] for r in out if r["doc_id"] == 6) == 1


def test_blocks_of_a_bucket_find_what_centres_miss(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 2)
    monkeypatch.setattr(minhash, "_star_pairs", lambda members: members.select(F.col("doc_id").alias("a"), F.col("doc_id").alias("b")).limit(0))
    monkeypatch.setattr(minhash, "_apart", lambda m, f, own=minhash._apart: own(m.withColumn("place", F.col("place") + 1), f))
    texts = [(i, " ".join(f"w{k}" for k in range(60)) + f" end{i}") for i in range(9)]
    out = minhash.near_duplicates(documents(spark, texts), size=2).collect()
    assert {r["component_id"] for r in out} == {0}


def test_components_of_chains_and_stars(spark):
    pick = random.Random(15)
    chain = list(range(100, 140))
    pick.shuffle(chain)
    links = list(zip(chain, chain[1:])) + [(1, k) for k in range(2, 30)] + [(50, 51), (51, 50), (60, 60), (None, 3), (70, None)]
    out = components.components(spark.createDataFrame(links, "a bigint, b bigint"))
    expected = {k: 100 for k in range(100, 140)} | {k: 1 for k in range(1, 30)} | {50: 50, 51: 50}
    assert {r["node"]: r["component"] for r in out.collect()} == expected
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# benchmark leaks


def test_leaks_are_found_at_any_place(spark):
    items = [(k, t) for k, t in enumerate(prose(16, 30, 60)) if len(t.split()) > 4] + [(90, None), (91, ""), (None, "a b c"), (92, "one two")]
    pick, texts, expected = random.Random(17), [], {}
    for i, t in enumerate(prose(18, 90, 80)):
        k, item = pick.choice(items[:-4])
        held = i % 3 == 0
        words = t.split()
        at = pick.randint(0, len(words))
        texts.append((i, "\n".join(words[:at] + [item.upper()] + words[at:]) if held else t))
        expected[i] = {k} if held else set()
    texts += [(200, None), (201, ""), (202, "so one  Two it is")]
    expected |= {200: set(), 201: set(), 202: {92}}
    bench = spark.createDataFrame([(*x, 1) for x in items], "item_id bigint, text string, leaks int")
    out = {r["doc_id"]: {x["item_id"] for x in r["leaks"]} for r in leaks.leaks(documents(spark, texts), bench).collect()}
    assert all(expected[i] <= out[i] for i in expected)
    plain = lambda t: " ".join((t or "").lower().split())
    # whatever else is found must be similar: the share of its words in order is high
    for i, t in texts:
        for k in out[i] - expected[i]:
            assert len(set(plain(t).split()) & set(plain(dict(items)[k]).split())) >= 0.7 * len(set(plain(dict(items)[k]).split()))
    assert leaks.leaks(documents(spark, texts), bench.limit(0)).where(F.size("leaks") > 0).count() == 0


def test_large_benchmark_takes_several_passes(spark, monkeypatch):
    monkeypatch.setattr(leaks, "PASS_WORDS", 100)
    items = [(k, t) for k, t in enumerate(prose(19, 20, 60)) if len(t.split()) > 4]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    assert len(list(leaks.passes(bench))) > 1
    out = leaks.leaks(documents(spark, items), bench).collect()
    assert all(r["doc_id"] in {x["item_id"] for x in r["leaks"]} for r in out)


# pieces


def test_pieces_are_the_best_path_and_decode_exactly(spark):
    vocab = pieces.vocabulary()
    words = ["▁hello", "▁hell", "▁helium", "▁日本", "▁x" * 1, "▁", "▁", "▁aaaaaaaaaaaaaaaaaaaaa"]

    def score(word):
        best = [0.0] + [float("-inf")] * len(word)
        for end in range(1, len(word) + 1):
            for start in range(end):
                found = vocab.scores.get(word[start:end])
                if found:
                    best[end] = max(best[end], best[start] + found[0])
            if word[end - 1] not in vocab.scores:
                best[end] = max(best[end], best[end - 1] + vocab.unknown)
        return best[-1]

    for word, ids in pieces.best_paths(words, vocab).items():
        unknown = sum(c not in vocab.scores for c in word)
        own = sum(vocab.scores[vocab.pieces[i]][0] for i in ids if i not in vocab.byte_of) + unknown * vocab.unknown
        assert own == pytest.approx(score(word))
    out = pieces.sentence_pieces(documents(spark, [*ODD, (8, "a  b ▁cs ")])).collect()
    assert all(r["exact"] for r in out) and {r["doc_id"]: r["n_pieces"] for r in out if r["doc_id"] in (1, 2)} == {1: 0, 2: 0}
    docs = documents(spark, ODD)
    back = docs.withColumn("ids", pieces.encoded("text")).withColumn("again", pieces.decoded("ids"))
    assert back.where(~F.col("again").eqNullSafe(F.col("text"))).count() == 0


def test_pieces_of_a_large_batch_take_little_memory(spark):
    class Table:
        """Keeps the function that a task runs over its batches."""

        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return run

    pick = random.Random(21)
    words = ["".join(pick.choices("abcdefghijklmnopqrstuvwxyzé", k=pick.randint(3, 9))) for _ in range(20_000)]
    texts = [" ".join(pick.choices(words, k=300)) for _ in range(4000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    pieces.vocabulary()
    run, seen = pieces.sentence_pieces(Table()), []
    tracemalloc.start()
    try:
        for out in run(iter([batch])):
            seen += out.column("doc_id").to_pylist()
            assert all(out.column("exact").to_pylist())
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # the words of the batch alone take more, each as a string of its own
    assert seen == list(range(len(texts))) and peak < 50 << 20


def test_pieces_do_not_depend_on_steps_or_what_is_remembered(monkeypatch):
    vocab, texts = pieces.vocabulary(), [*prose(22, 60), None, "", *prose(22, 60), " ", "日本 日本ü 日", *[t for _, t in ODD]]
    every = {w for t in texts if t for w in pieces._WORD.findall(pieces._marked(t))}
    best = pieces.best_paths(list(every), vocab)
    expected = [None if t is None else [i for w in pieces._WORD.findall(pieces._marked(t)) for i in best[w]] if t else [] for t in texts]
    for step, remembered in [(1, 1), (100, 500), (1 << 20, 1 << 20)]:
        monkeypatch.setattr(pieces, "STEP", step)
        monkeypatch.setattr(pieces, "REMEMBERED", remembered)
        paths, own, ids, held = pieces.Paths(vocab), [], [], 0
        for some, found in pieces.encode_batch(pa.array(texts, pa.string()), paths):
            own, ids = own + some, ids + [None if x is None else x.tolist() for x in found]
            held = max(held, len(paths.recent) + len(paths.older))
        assert own == texts and ids == expected
        assert remembered > 500 or held < len(every)
        assert [pieces.decode_ids(x, vocab) for x in ids] == texts
    assert list(pieces.encode_batch(pa.array([], pa.string()), pieces.Paths(vocab))) == []


# the whole


def test_empty_tables(spark):
    docs = documents(spark, [], SCHEMA)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id bigint, text string")
    turns = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    made = [
        digests.exact_duplicates(docs), repeats.without_repeats(docs), lines.without_repeated_lines(docs), quality.judged(docs, labels),
        lengths.limit_answers(lengths.length_histogram(docs, lengths.token_count("text"))), toxicity.toxicity(docs, labels),
        minhash.near_duplicates(docs), leaks.leaks(docs, bench), pieces.sentence_pieces(docs), chat.preference_format(chat.preference_sides(turns)),
    ]
    assert [df.count() for df in made] == [0] * len(made)


def test_pipeline_stages_only_drop_rows(spark):
    import corpus_pipeline

    docs, sf = table(spark, str(DATA), "documents").withColumn("row", F.lit("own")), str(DATA)
    before = rows(docs)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        left = rows(out)
        assert 0.5 * len(before) < len(left) <= len(before) and set(left) <= set(before)
        docs, before = spark.createDataFrame(out.collect(), docs.schema), left
    assert {r["doc_id"] for r in corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()} == {r[0] for r in before}


def test_pipeline_halves_a_table_given_twice(spark):
    import corpus_pipeline

    texts = [(1, "a b"), (2, "a b"), (3, None), (None, "x y"), (None, None), (4, "alone"), (None, "a b")]
    once = documents(spark, texts)
    out = corpus_pipeline.exact_stage(spark, once.unionAll(once).unionAll(once), "")
    assert out.columns == once.columns
    left = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)
    assert left == sorted([(2, "a b"), (3, None), (None, "x y"), (4, "alone")], key=repr)
    # rows that differ in another column only are one document, too
    other = once.where("doc_id = 4").withColumn("source", F.lit("t"))
    assert corpus_pipeline.exact_stage(spark, once.where("doc_id = 4").unionAll(other), "").select("source").collect() == [("t",)]


def test_pipeline_matches_brute_force_behind_its_first_stage(spark):
    """Exact and near duplicates, benchmark items and decoded texts of all documents that the quality stage kept."""
    import corpus_pipeline

    stages, sf = dict(corpus_pipeline.STAGES), str(DATA)
    first = stages["quality"](spark, table(spark, sf, "documents"), sf).collect()
    docs = spark.createDataFrame(first, table(spark, sf, "documents").schema)
    texts = {r["doc_id"]: r["text"] or "" for r in first}
    largest = {t: i for i, t in sorted(texts.items())}
    texts = {i: t for i, t in texts.items() if largest[t] == i}
    docs = stages["exact_duplicates"](spark, docs, sf)
    assert {r["doc_id"]: r["text"] or "" for r in docs.collect()} == texts

    def lowered(text):
        return [w for w in re.split("[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda x: x[0].lower(), text)) if w]

    def shingles_of(words, size=5):
        return {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()

    sets = {i: shingles_of(lowered(t)) for i, t in texts.items()}
    least, changed = {i: i for i in sets}, True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 80 * len(sets[a] | sets[b]) and least[a] < least[b]:
                    least[b], changed = least[a], True
    texts = {i: t for i, t in texts.items() if least[i] == i}
    docs = stages["near_duplicates"](spark, spark.createDataFrame(docs.collect(), docs.schema), sf)
    assert {r["doc_id"] for r in docs.collect()} == set(texts)

    items = [lowered(r["text"] or "") for r in table(spark, sf, "benchmark").collect()]
    held = {i for i, t in texts.items() for w in items if w and f" {' '.join(w)} " in f" {' '.join(lowered(t))} "}
    docs = stages["benchmark"](spark, spark.createDataFrame(docs.collect(), docs.schema), sf)
    left = {r["doc_id"] for r in docs.collect()}
    assert not left & held and left <= set(texts)
    # what goes beyond exact passages shares a run of an item's length with it: most of the item's words in a row of as many
    for i in set(texts) - left - held:
        words = lowered(texts[i])
        runs = ((set(w), set(words[k : k + len(w)])) for w in items if w for k in range(max(1, len(words) - len(w) + 1)))
        assert any(len(a & b) >= 0.7 * len(a) for a, b in runs)
    out = stages["sentence_pieces"](spark, spark.createDataFrame(docs.collect(), docs.schema), sf)
    back = out.withColumn("text", pieces.decoded("pieces")).collect()
    assert {r["doc_id"]: r["text"] or "" for r in back} == {i: texts[i] for i in left} and all(r["exact"] for r in back)
