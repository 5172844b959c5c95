"""Ranked search against plain integers, with small tiles and blocks."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from tidemark.llm import lexical

WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]


def plain(docs, items, k=10):
    split = [(i, terms(t)) for i, t in docs]
    n_docs, n_words = sum(bool(w) for _, w in split), sum(len(w) for _, w in split)
    out = []
    for item, text in items:
        found = []
        for i, words in split:
            score = 0
            for term in set(terms(text)):
                tf = words.count(term)
                if tf:
                    df = sum(term in w for _, w in split)
                    m = 10 + 90 * len(words) * n_docs // n_words
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("small", [False, True])
def test_equals_plain_integers(spark, monkeypatch, small):
    rng = random.Random(7)
    words = [*"alpha Beta GAMMA delta É é x1 1x naïve ﬁ 中文 ÀB àb _ -".split(), "a`b", "c[d"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs = [(rng.randrange(40), text(rng.randrange(12))) for _ in range(90)]
    docs += [(100 + i, "copy of the alpha beta line") for i in range(30)]  # ties beyond the list
    docs += [(None, "alpha delta"), (None, None), (200, None), (201, ""), (202, "alpha " * 20_000), (203, "- _ `")]
    items = [(f"i{j}", text(6)) for j in range(9)] + [("i3", "beta beta"), (None, "delta"), ("none", None), ("empty", ""), ("unknown", "nowhere")]
    if small:
        # tiles and blocks far below the size of the tables; partitions of their own
        for name, value in (("ITEMS", 2), ("TERMS", 3), ("DOCS", 7)):
            monkeypatch.setattr(lexical, name, value)
    have = spark.createDataFrame([(*d, 1, "z") for d in docs], "doc_id long, text string, rank int, score string").repartition(5)
    asked = spark.createDataFrame([(*i, 1, 2) for i in items], "item_id string, text string, doc_id int, number int")
    got = lexical.rank(have, asked, block=10 if small else lexical.BLOCK)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(docs, items)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([("x", "a")], "item_id string, text string")
    assert lexical.rank(docs.where("false"), items).collect() == []
    assert lexical.rank(docs, items.where("false")).collect() == []
    assert lexical.rank(docs, spark.createDataFrame([("x", "--")], items.schema)).collect() == []
    assert lexical.rank(docs, items).collect() == [("x", 1, 1, lexical.rank(docs, items).first()["score"])]


def test_tiles_keep_sums_exact():
    """Sums far beyond 2^53 come out exact, as the span of a tile shrinks with the weights."""
    weights = np.full(50, 1 << 30, np.int64)
    span = lexical._span(weights)
    assert 1 <= span < 50 and span * (1 << 30) * lexical._IMPACT < 1 << 53
    tile = (np.array([0]), np.arange(50, dtype=np.int32), np.arange(50, dtype=np.int32), np.zeros(50, np.int32), np.full(50, float(1 << 30)))
    got = lexical._scores(tile, span, 50, 1, np.zeros(50, int), np.arange(50), np.full(50, 999_999))
    assert got.tolist() == [[50 * (1 << 30) * 999_999]]
