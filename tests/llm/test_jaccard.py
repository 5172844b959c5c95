"""Near-duplicates by exact shingle similarity, against all pairs."""

from __future__ import annotations

import random

import plain
import pytest

from tidemark.llm import jaccard, simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text: str | None) -> frozenset:
    words = (text or "").lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def alike(a: frozenset, b: frozenset) -> bool:
    return 5 * len(a & b) >= 4 * len(a | b)


def least_of_groups(docs: dict) -> dict:
    sets = {k: shingles(t) for k, t in docs.items()}
    return plain.groups(list(docs), lambda a, b: alike(sets[a], sets[b]))



def near_copies() -> dict:
    """Groups of copies with a few changed words, from far above the similarity to below it."""
    rng, texts = random.Random(3), ["", None, "Short one", "short ONE", "a b c d e"]
    for _ in range(12):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(20, 300))]
        for _ in range(14):
            words = list(base)
            for at in rng.sample(range(len(words)), rng.randrange(1 + len(words) // 25)):
                words[at] = f"new{rng.randrange(10**6)}"
            texts.append(" ".join(words))
    return dict(enumerate(texts))


@pytest.mark.parametrize("small", [jaccard.SMALL, 1])
def test_groups_equal_all_pairs(spark, small):
    docs = near_copies()
    want = least_of_groups(docs)
    assert 30 < len(set(want.values())) < len(docs) - 60
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(5)
    assert dict(map(tuple, jaccard.near_duplicates(frame, small=small).collect())) == want


def test_stage_drops_what_fingerprints_miss(spark):
    import corpus_pipeline

    rng, rows = random.Random(5), []
    for k in range(20):
        words = [f"w{rng.randrange(3000)}" for _ in range(200)]
        rows.append((2 * k, " ".join(words), "en", "a", 1))
        for at in (30, 90, 150):
            words[at] = f"new{k}"
        rows.append((2 * k + 1, " ".join(words), "en", "a", 1))
    docs = spark.createDataFrame(rows, SCHEMA)
    assert simhash.deduplicate(docs).count() > 20
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(0, 40, 2))


def test_stage_drops_what_only_fingerprints_link(spark):
    """Texts that repeat the same words and end differently: near by SimHash, not by different shingles."""
    import corpus_pipeline

    rng, rows = random.Random(6), []
    for k in range(6):
        base = [f"w{rng.randrange(3000)}" for _ in range(31)]
        for i in range(3):
            words = base * 80 + [f"x{rng.randrange(10**6)}" for _ in range(12)]
            rows.append((3 * k + i, " ".join(words), "en", "a", 1))
    # the first of the next pair is alike to the second by shingles, so both kinds of links make one group
    words = rows[1][1].split()
    rows.append((100, " ".join(words[:31] + words[-43:]), "en", "a", 1))
    docs = spark.createDataFrame(rows, SCHEMA)
    assert jaccard.deduplicate(docs).count() == 18
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    want = plain.near_duplicates([r[:2] for r in rows])
    assert len({c for _, _, c in want}) == 7
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 3, 6, 9, 12, 15]


@pytest.mark.parametrize("drop", [jaccard.deduplicate, simhash.deduplicate])
def test_a_key_of_several_texts_stays_in_each_group(spark, drop):
    words = [[f"{c}{i}" for i in range(40)] for c in "abc"]
    one, two, three = map(" ".join, words)
    rows = [(1, one), (5, one), (5, two), (7, two), (8, three), (8, one + " end"), (8, three), (1, three)]
    docs = spark.createDataFrame([(*r, "en", "a", 1) for r in rows], SCHEMA)
    got = sorted((r["doc_id"], r["text"]) for r in drop(docs).collect())
    assert got[:3] == [(1, one), (1, three), (5, two)] and len(got) == (3 if drop is jaccard.deduplicate else len(got))


def test_awkward_rows(spark):
    rows = [(1, "x y z"), (1, "x y z"), (None, "x y z"), (None, None), (2, "X  y\nz"), (3, None), (4, ""), (5, " \n")]
    docs = spark.createDataFrame([(*r, "en", "a", 1) for r in rows], SCHEMA)
    got = jaccard.near_duplicates(docs).collect()
    assert sorted(map(str, got)) == sorted(f"Row(doc_id={k}, component_id={1 if t and t.strip() else 3})" for k, t in rows)
    assert sorted(str(r["doc_id"]) for r in jaccard.deduplicate(docs).collect()) == ["1", "3", "None", "None"]
    assert jaccard.deduplicate(docs.where("doc_id = -1")).collect() == []


def pages_of_one_template(n: int, seed: int, own: int = 42) -> dict:
    """Texts that share most of their words, with a similarity of about 0.71 to one another."""
    rng = random.Random(seed)
    shared = [f"t{rng.randrange(10**6)}" for _ in range(205)]
    return {k: " ".join([*shared[:100], *(f"u{k}x{i}" for i in range(own)), *shared[100:]]) for k in range(n)}


def compared(spark, monkeypatch, docs: dict) -> tuple[dict, int]:
    """The groups, and how many pairs were compared shingle by shingle."""
    seen, real = [], jaccard._verified

    def counting(pairs, sets, similarity):
        seen.append(pairs.count())
        return real(pairs, sets, similarity)

    monkeypatch.setattr(jaccard, "_verified", counting)
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(5)
    return dict(map(tuple, jaccard.near_duplicates(frame).collect())), sum(seen)


def test_unlike_pages_of_a_template_are_not_all_compared(spark, monkeypatch):
    sizes = {}
    for n in (200, 400):
        docs = pages_of_one_template(n, 1)
        a, b = shingles(docs[0]), shingles(docs[1])
        assert 0.68 < len(a & b) / len(a | b) < 0.75
        groups, sizes[n] = compared(spark, monkeypatch, docs)
        monkeypatch.undo()
        assert groups == {k: k for k in docs}
    assert sizes[200] < 200 * 100 and sizes[400] < 2.6 * sizes[200]


def test_alike_pages_among_unlike_ones_are_found(spark, monkeypatch):
    """Pairs just above the similarity in a bucket of pages just below it, with sizes that differ."""
    docs, rng = pages_of_one_template(120, 2, own=30), random.Random(9)
    for k in range(0, 60, 3):
        words = docs[k].split()
        for at in rng.sample(range(len(words)), 3):
            words[at] = f"n{k}"
        docs[200 + k] = " ".join(words + [f"more{k}"] * rng.randrange(12))
    groups, _ = compared(spark, monkeypatch, docs)
    assert groups == least_of_groups(docs)
    assert 100 < len(set(groups.values())) < len(docs)


def test_prefix_join_misses_no_pair(spark):
    """Against all pairs, on sets of many sizes around the similarity, with every node open."""
    rng, docs = random.Random(4), {}
    for k in range(150):
        base = k // 10
        size, pool = rng.randrange(10, 60), random.Random(base)
        words = [f"b{base}w{pool.randrange(500)}" for _ in range(60)][:size]
        for at in rng.sample(range(size), rng.randrange(2)):
            words[at] = f"x{rng.randrange(5)}"
        docs[k] = " ".join(words)
    sets = {k: shingles(t) for k, t in docs.items()}
    ids: dict = {}
    rows = [(k, [ids.setdefault(x, len(ids)) for x in sorted(v)]) for k, v in sets.items()]
    nodes = spark.createDataFrame([(k, len(v), k) for k, v in sets.items()], "node long, n long, root long")
    found = spark.createDataFrame(rows, "node long, found array<long>")
    got = {tuple(r) for r in jaccard.prefix_pairs(nodes, found, 0.8).collect()}
    want = {(a, b) for a in docs for b in docs if a < b and alike(sets[a], sets[b])}
    assert len(want) > 50 and want <= got
