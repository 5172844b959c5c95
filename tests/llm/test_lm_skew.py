"""Scores of a corpus in which one pair and one text are everywhere."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import lm_score


def test_hashes_are_those_of_spark(spark):
    rows = [("hello", "wörld"), ("a", "\x02"), ("x" * 100, "naïve")]
    got = spark.createDataFrame(rows, "a string, b string").selectExpr("xxhash64(a) AS a", "xxhash64(b) AS b", "xxhash64(xxhash64(a), xxhash64(b)) AS p", "xxhash64(xxhash64(a)) AS w")
    for (a, b), r in zip(rows, got.collect()):
        words = lm_score.Words()
        ids, before, _ = words.block([f"{a.upper()} {b}"])
        assert before.tolist() == [0, ids[0]]
        words = words.hashes[ids]
        assert words.view(np.int64).tolist() == [r.a, r.b]
        assert lm_score.pair_hash(words[:1], words[1:]).view(np.int64)[0] == r.p
        assert lm_score.hash_long(words[:1], np.array([lm_score.SEED], np.uint64)).view(np.int64)[0] == r.w


@pytest.mark.parametrize("known,frequent", [(1 << 18, 2048), (3, 2), (1, 1)])
def test_frequent_pairs_are_joined_not_gathered(spark, monkeypatch, known, frequent):
    monkeypatch.setattr(lm_score, "KNOWN", known)
    monkeypatch.setattr(lm_score, "FREQUENT", frequent)
    texts = ["junk phrase here"] * 40 + [f"Junk phrase word{i % 7} \x02 word{i}" for i in range(60)] + ["junk phrase " * 50, "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    words = [(t or "").lower().split() for t in texts]
    pairs = Counter(p for w in words for p in zip(["\x02", *w], w))
    firsts = Counter(x for w in words if w for x in ["\x02", *w])
    total = sum(n for x, n in firsts.items() if x != "\x02")
    result = lm_score.score(docs)
    got = {r["doc_id"]: r for r in result.collect()}
    for k, w in enumerate(words):
        found = [(pairs[a, b], firsts[a], firsts[b]) for a, b in zip(["\x02", *w], w)]
        logs = [math.log(n / x) if n > 1 else math.log(0.4 * y / total) for n, x, y in found]
        assert (got[k]["n_words"], got[k]["n_backed_off"]) == (len(w), sum(n < 2 for n, _, _ in found))
        assert got[k]["mean_log_score"] is None if not w else abs(got[k]["mean_log_score"] - sum(logs) / len(w)) < 1e-5
    # no Python group gathers what one pair or document has
    assert "GroupsInArrow" not in result._jdf.queryExecution().toString()


def test_blocks_copy_only_new_words():
    """All that was known of a task's words was copied with every block of texts."""
    import numpy as np
    import pyarrow as pa

    from tidemark.llm import lm_score

    known = lm_score.Known(*(np.zeros(0, kind) for kind in (np.uint64, float, np.uint64, np.uint64, float)))
    words, held = lm_score.Words(known), []
    for k in range(200):
        words.block([" ".join(f"w{k}x{i}" for i in range(100))])
        if not any(words.hashes is h for h in held):
            held.append(words.hashes)
    assert len(held) < 10 and words.n == 20_001
    texts = [" ".join(f"w{(k * i) % 700}" for i in range(50)) for k in range(1_000)] + ["", None]
    rows = [r for b in lm_score._counter(iter([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])])) for r in b.to_pylist()]
    lists = [(t or "").split() for t in texts]
    assert sum(r["n"] for r in rows if r["second"] is None) == sum(map(len, lists)) + 1_000
    singles = sorted(r["n"] for r in rows if r["second"] is None)
    counts: dict = {}
    for word in [w for x in lists for w in x] + ["\x02"] * 1_000:
        counts[word] = counts.get(word, 0) + 1
    assert singles == sorted(counts.values())
    assert sum(r["n"] for r in rows if r["second"] is not None) == sum(map(len, lists))


def test_words_are_hashed_all_at_once(monkeypatch):
    """Python looked at every word of every text; now only at those of 32 bytes and more."""
    import random

    import pyarrow as pa
    from xxhash import xxh64_intdigest

    rng, called = random.Random(3), []
    texts = ["".join(rng.choice("aAbZ\u00c9\u20ac\U0001f600\x00\x1c\x85\xa0 \t\n\x0b\x0c\r") for _ in range(rng.randrange(90))) for _ in range(400)]
    texts += [None, "", " ", "\x02 \x02", " ".join("w" * k for k in range(1, 70))]
    lists = [(t or "").encode().lower().split() for t in texts]
    monkeypatch.setattr(lm_score, "xxh64_intdigest", lambda word, seed: called.append(word) or xxh64_intdigest(word, seed))
    words = lm_score.Words()
    for _ in range(2):
        ids, before, of = words.block(texts)
        assert words.hashes[ids].tolist() == [xxh64_intdigest(w, lm_score.SEED) for x in lists for w in x]
        assert words.hashes[before].tolist() == [xxh64_intdigest(w, lm_score.SEED) for x in lists for w in [b"\x02", *x][: len(x)]]
        assert of.tolist() == [k for k, x in enumerate(lists) for _ in x]
    assert words.n == len({w for x in lists for w in x} | {b"\x02"})
    assert all(len(w) >= 32 for w in called if w != lm_score.START)
    assert lm_score.hash_words(pa.array(["skip", "one", "", "two"]).slice(1, 2)).tolist() == [xxh64_intdigest(b"one", 42), xxh64_intdigest(b"", 42)]


def test_numbers_stay_when_the_places_grow():
    words = lm_score.Words()
    first = words.block([" ".join(f"a{k}" for k in range(5_000))])[0]
    words.block([" ".join(f"b{k}" for k in range(40_000))])
    assert words.block([" ".join(f"a{k}" for k in range(5_000))])[0].tolist() == first.tolist()
    assert len(words.places) >= 2 * words.n and words.n == 45_001


@pytest.mark.parametrize("block,held", [(1 << 22, 1 << 20), (64, 20), (1, 1)])
def test_each_text_is_split_once_for_its_joins(monkeypatch, block, held):
    """Every text was split again for each part of the joins; now all it looks up leaves in one pass."""
    import pyarrow as pa

    monkeypatch.setattr(lm_score, "_BLOCK", block, raising=False)
    monkeypatch.setattr(lm_score, "_HELD", held)
    texts = [" ".join(f"w{(k * i) % 37}" for i in range(k)) for k in range(30)] + [""]

    class Shared:
        value = lm_score.Known(*(np.zeros(0, kind) for kind in (np.uint64, float, np.uint64, np.uint64, float)))

    ids = pa.array(range(len(texts)), pa.int64())
    rows = pa.RecordBatch.from_arrays([ids, ids, pa.array(texts)], names=["r1", "r2", "text"])
    found = [r for b in lm_score._looked_up(Shared)(iter([rows])) for r in b.to_pylist()]
    for k, text in enumerate(texts):
        n = len(text.split())
        # a row for each pair and each word, and one of the text
        assert sorted(r["n"] for r in found if r["r1"] == k) == [0] * 2 * n + [n + 1]
