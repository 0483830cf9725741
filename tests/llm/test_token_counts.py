"""Token counts against a slow byte-pair merge, and texts of one very long run."""

from __future__ import annotations

import base64
import random

import pytest
import regex
from test_corpus import documents, prose

from rankweave.llm import lengths

VOCABULARY = f"{lengths.TOKENIZERS}/byte_bpe_50k.tiktoken"
TEXTS = [
    *prose(71, 15), "I'll say it's 12345 o'clock,\tisn't it?!  \n\n x", "  a", " ", "\n\n\n", "a \u3000\u2003 b", "ünï 中国 游戏\x1c\x1d z", "x" * 300, "\r\n " * 40 + "end",
]


def merged(word, ranks):
    """Of all neighbours those that are the lowest entry of the vocabulary are joined first."""
    parts = [bytes([b]) for b in word]
    while True:
        known = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not known:
            return len(parts)
        i = min(known)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_counts_match_a_slow_merge(spark):
    with open(VOCABULARY, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    want = {i: sum(merged(w.encode(), ranks) for w in regex.findall(lengths.PATTERN, t)) for i, t in enumerate(TEXTS)}
    out = documents(spark, list(enumerate(TEXTS))).select("doc_id", lengths.token_count("text").alias("n"))
    assert {r["doc_id"]: r["n"] for r in out.collect()} == want


def test_texts_cut_around_long_runs_have_the_same_tokens(monkeypatch):
    monkeypatch.setattr(lengths, "LONG_RUN", 3)
    pick = random.Random(72)
    texts = ["".join(pick.choices("ab 1.\n\t\u2003\x85\x1c", [3, 3, 9, 1, 1, 3, 3, 2, 1, 1], k=60)) for _ in range(400)]
    own, encode = lengths.counter(VOCABULARY), lengths._encoding(VOCABULARY).encode_ordinary
    assert any(run for t in texts for _, run in lengths._pieces_of_long_runs(t))
    for text in [*texts, *TEXTS, "   ", "\n" * 50 + "a" + " " * 70]:
        assert "".join(x for x, _ in lengths._pieces_of_long_runs(text)) == text
        assert own(text) == len(encode(text))


@pytest.mark.parametrize("text", [" " * 1_000_000, "\n" * 1_000_000 + "end", "a" + "\r\n" * 700_000 + " b"])
def test_a_million_of_white_space(text):
    count = lengths.counter(VOCABULARY)
    assert 0 < count(text) <= len(text)
    assert count(text[:100_000]) == len(lengths._encoding(VOCABULARY).encode_ordinary(text[:100_000]))
