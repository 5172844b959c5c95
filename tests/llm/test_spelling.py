"""Spelling variants against a comparison of all pairs."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from tidemark.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counts(docs, slip=spelling.SLIP):
    n = Counter()
    for i, text in docs:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if slip and h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(docs, slip=spelling.SLIP):
    n = counts(docs, slip)
    near = {w: sorted((-n[x], x) for x in n if one_edit(w, x)) for w in n}
    form = {w: (found[0][1] if found and -found[0][0] >= 2 * n[w] else None) for w, found in near.items()}

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted(((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    stems = ["spelling", "variant", "aaaaa", "aaaaaa", "naïvely", "ÀÉÎÕÜ", "letters", "abcde", "×÷×÷×"]
    words = []
    for stem in stems:
        for _ in range(25):
            w = stem
            for _ in range(rng.randrange(3)):
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice("abéz") + w[at:], w[:at] + rng.choice("abÿ") + w[at + 1 :]])
            words.append(w)
    docs = [(i, " ".join(rng.choice(words) + rng.choice([" ", "-", "1", "中"]) for _ in range(60)) + " Spelling" * rng.randrange(6)) for i in range(40)]
    docs += [(None, "Spelling variant " * 5), (None, None), (7, ""), (7, None), (90, "z" * 70_000 + " " + "z" * 70_001), (91, ("z" * 70_000 + " ") * 3 + "z" * 70_001), (92, ("z" * 70_001 + " ") * 9)]
    return docs


@pytest.mark.parametrize("seed,tile", [(1, 512), (2, 4)])
def test_equals_all_pairs(spark, seed, tile):
    docs = corpus(seed)
    have = spark.createDataFrame([(*d, 1, "x", 2) for d in docs], "doc_id long, text string, n int, word string, m int").repartition(6)
    got = spelling.variants(have, slip=spelling.SLIP, tile=tile)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(docs)


def test_no_slips_and_nothing(spark):
    docs = corpus(3)
    have = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(map(tuple, spelling.variants(have).collect()), key=repr) == plain(docs, None)
    assert spelling.variants(have.where("false")).collect() == []
    assert spelling.variants(have.where("text IS NULL")).collect() == []


def test_a_large_bucket_is_cut(spark):
    """No tile holds many more words than asked for, and none gives out pairs."""
    words = spark.range(3000).selectExpr("concat('same', lpad(id, 4, '0')) AS word", "id + 3 AS n")
    letters = words.selectExpr("translate(word, '0123456789', 'abcdefghij') AS word", "n")
    found = spelling.near_words(letters, tile=50)
    got = {r["word"]: r["n_near"] for r in found.collect()}
    assert len(got) == 3000 and sum(got.values()) == sum(
        sum(9 if p else 2 for p in range(4)) for _ in range(3000)
    )
