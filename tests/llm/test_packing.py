"""Packing: ids against the library, whole documents, gapless places, and few sequences."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing
from tidemark.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, length int, piece string, _rid int, ids string"


def library():
    return Tokenizer.from_file(packing.default_path())


def test_encoder_equals_the_library():
    known, mine, rng = library(), packing.Encoder(packing.default_path()), random.Random(3)
    assert mine.ranks is not None
    letters = [*"ab Z01'’s t.,!?-_\n\t\r\xa0é中²½ßı́　​\x1c\x85😀", "'re", "'LL", "<|endoftext|>", "  ", "naïve"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    texts += [f"a{chr(c)}b {chr(c)} {chr(c)}{chr(c)}'{chr(c)}s" for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    for text in texts:
        got = np.frombuffer(mine.encode(text), "<u4").tolist()
        assert got == known.encode(text, add_special_tokens=False).ids, ascii(text)


def check(rows, texts, capacity=packing.CAPACITY):
    """Every document whole and in order, every sequence gapless; the number of sequences."""
    known = library()
    want = sorted(tuple(known.encode(t or "", add_special_tokens=False).ids) + (packing.END,) for _, t in texts)
    by_doc: dict = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    lengths = sorted(len(w) for w in want)
    assert sorted(r["length"] for r in rows) == sorted(n for w in lengths for n in [w % capacity] * bool(w % capacity) + [capacity] * (w // capacity))
    for k, text in {k: t for k, t in texts if sum(x == k for x, _ in texts) == 1}.items():
        ids, at = known.encode(text or "", add_special_tokens=False).ids + [packing.END], 0
        for i, r in enumerate(sorted(by_doc[k], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (i, at)
            part = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(part)
            at += r["length"]
        assert at == len(ids)
    bins: dict = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_query_packs_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rows = QUERIES["op11_packing"](spark, folder).collect()
    need = -(-sum(r["length"] for r in rows) // packing.CAPACITY)
    assert check(rows, texts) <= need + 1


def test_edges(spark):
    rows = [(1, "hello world", 7, "x", 3, "y"), (1, "hello world", 7, "x", 3, "y"), (2, "", 0, "", 0, ""), (3, None, None, None, None, None)]
    rows += [(None, "no key", 1, "", 1, ""), (None, "no key either", 1, "", 1, ""), (4, "long word " * 9000, 1, "", 1, ""), (5, "x" * 50_000, 1, "", 1, "")]
    rows += [(6 + i, "same", 1, "", 1, "") for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = packing.pack(docs).collect()
    n = check(got, [r[:2] for r in rows])
    assert n == -(-sum(r["length"] for r in got) // packing.CAPACITY)
    assert packing.pack(docs.where("false")).collect() == []


def test_groups_meet_again(spark):
    """What groups leave open is searched again, so small groups cost little."""
    rng = random.Random(5)
    rows = [(i, 0, 0, rng.randint(1, 700)) for i in range(3000)]
    cut = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long")
    got = packing.place(cut, group=500).collect()
    bins: dict = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert len(got) == 3000 and all(sum(n for _, n in b) <= 1024 for b in bins.values())
    assert len(bins) <= -(-sum(r[3] for r in rows) // 1024) + 4


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(i, "some words " * i) for i in range(60)], "doc_id long, text string")
    cut = packing.pieces(docs, capacity=64)
    placed = packing.place(cut, capacity=64).collect()
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(spark.createDataFrame(placed)).collect()}
    for r in placed:
        at = 4 * r["offset"]
        assert bytes(whole[r["sequence_id"]][at : at + 4 * r["length"]]) == bytes(r["ids"])


@pytest.mark.parametrize("low,high", [(1, 1023), (250, 520), (513, 1023), (1, 5), (340, 345)])
def test_exchanges_only_help(low, high):
    rng = random.Random(low)
    lengths = [rng.randint(low, high) for _ in range(400)]
    start = packing.best_fit(lengths, 1024)
    done = packing.exchange(start, lengths, 1024)
    assert sorted(i for b in done for i in b) == list(range(400))
    fills = [[sum(lengths[i] for i in b) for b in bins] for bins in (start, done)]
    assert max(fills[1]) <= 1024 and len(done) <= len(start)
    assert sum(f * f for f in fills[1]) >= sum(f * f for f in fills[0])


def test_exchanges_of_each_kind_empty_a_bin():
    lengths = [600, 424, 300, 724]  # a move fills two bins
    assert len(packing.exchange([[0], [1], [2, 3]], lengths, 1024)) == 2
    lengths = [500, 400, 524, 500, 100, 24]  # only an exchange makes room
    assert len(packing.exchange([[0, 1, 4], [2, 3], [5]], lengths, 1024)) == 2


def test_plain_words_are_merged_without_a_split():
    """The split was looked for again in chunks that are one word."""
    from tidemark.llm import packing

    words = packing.Encoder(packing.default_path())
    texts = ["plain Words only", " and more of THEM", "don", "x" * 39, "y" * 500, " a" * 50]
    want = [np.array(words.library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    words.ranks = words.library = object()
    assert [words.encode(t) for t in texts] == want
