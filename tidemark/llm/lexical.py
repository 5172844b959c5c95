"""Ranked lexical search by dense matrix products over blocks of terms, items and documents.

A document's share in the score of a term is an integer that depends on how often it has the term
and how long it is: its impact. The score is the sum of weight times impact over the terms of an
item, so the scores of many items and documents are one matrix product. Items are taken in tiles
with a vocabulary of their own terms only, documents in tiles of rows, the vocabulary in tiles
short enough that every partial sum of products stays below 2^53: float64 holds such integers
exactly, and what the tiles give is added up in 64-bit integers.

Texts are split once for each block of items, into the counts of those terms that the block has.
The best documents of an item are kept in the order of score and id tile by tile, then among the
tiles of a task, then by Spark over all tasks, so equal scores are resolved alike everywhere.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import UPPER, kind_of, settle

#: (item, term) pairs of one block of items; checked before its terms go to every task.
BLOCK = 400_000
ITEMS, TERMS, DOCS = 64, 2_048, 512
SALTS = 64
_IMPACT = 1_000_000  # no impact is as large
_EXACT = 1 << 53

#: Every byte that is no ASCII letter or digit and not part of a longer character ends a term.
_LETTERS = bytes(
    b + 32 if chr(b) in UPPER else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a whole text in UTF-8; only A-Z are put into lower case."""
    return (text or "").encode().translate(_LETTERS).split()


# -- counting -----------------------------------------------------------------


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        terms = [sorted(set(terms_of(t.as_py()))) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(terms, pa.list_(pa.binary()))], names=["key", "terms"])


def _blocks(listed: DataFrame, block: int) -> int:
    """Into how many blocks the items are dealt so that none but single items exceeds the bound."""
    n = -(-(listed.agg(F.sum(F.size("terms"))).first()[0] or 0) // block)
    while n > 1:
        sizes = listed.groupBy(_block_of(n)).agg(F.sum(F.size("terms")).alias("pairs"), F.count("*").alias("items"))
        if not sizes.where((F.col("pairs") > 2 * block) & (F.col("items") > 1)).count():
            break
        n *= 2
    return n


def _block_of(n: int):
    return F.pmod(F.xxhash64("number"), F.lit(n))


def _counter(shared):
    """Of each document: its number of terms, and which terms of the block it has how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(shared.value)}
        for batch in batches:
            sizes, ids, counts, ends = [], [], [], [0]
            for text in batch.column(1):
                terms = terms_of(text.as_py())
                found = Counter([i for i in map(number.get, terms) if i is not None])
                sizes.append(len(terms))
                ids += found.keys()
                counts += found.values()
                ends.append(len(ids))
            ends = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (ids, counts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), *lists], names=["key", "n", "terms", "counts"])

    return run


# -- ranking ------------------------------------------------------------------


def _tiles(items: list, weights: np.ndarray) -> list[tuple]:
    """(numbers of the items, their terms, row, column and weight of each entry), tile by tile."""
    out = []
    for at in range(0, len(items), ITEMS):
        mine = items[at : at + ITEMS]
        terms = sorted({t for _, listed in mine for t in listed})
        place = {t: i for i, t in enumerate(terms)}
        entries = [(place[t], j, weights[t]) for j, (_, listed) in enumerate(mine) for t in listed]
        rows, columns, values = zip(*entries)
        out.append((np.array([n for n, _ in mine], np.int64), np.array(terms, np.int32), np.array(rows, np.int32), np.array(columns, np.int32), np.array(values, np.float64)))
    return out


def _span(weights: np.ndarray) -> int:
    """Terms in a tile, few enough that no partial sum reaches 2^53."""
    return int(min(TERMS, max(1, (_EXACT - 1) // (int(weights.max(initial=1)) * _IMPACT))))


def _scores(tile: tuple, span: int, n_terms: int, n_docs: int, rows, terms, impacts) -> np.ndarray:
    """Scores of a tile of documents against a tile of items, as 64-bit integers."""
    numbers, own, at, column, weight = tile
    place = np.full(n_terms, -1, np.int32)
    place[own] = np.arange(len(own), dtype=np.int32)
    places = place[terms]
    known = places >= 0
    rows, places, impacts = rows[known], places[known], impacts[known]
    scores = np.zeros((n_docs, len(numbers)), np.int64)
    for low in range(0, len(own), span):
        high = min(low + span, len(own))
        within = (places >= low) & (places < high)
        documents = np.zeros((n_docs, high - low))
        documents[rows[within], places[within] - low] = impacts[within]
        part = (at >= low) & (at < high)
        items = np.zeros((high - low, len(numbers)))
        items[at[part] - low, column[part]] = weight[part]
        scores += (documents @ items).astype(np.int64)
    return scores


def _ranker(shared, n_terms: int, span: int, n_docs: int, n_words: int, k: int):
    """The best documents of each item in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles, best, kind = shared.value, {}, None
        for batch in batches:
            kind = batch.column(0).type
            # rows in the order of their ids, so that a stable sort by score resolves ties
            batch = batch.take(pc.sort_indices(batch.column(0), null_placement="at_end"))
            for low in range(0, len(batch), DOCS):
                part = batch.slice(low, DOCS)
                lists = part.column(2)
                ends = lists.offsets.to_numpy()
                rows = np.repeat(np.arange(len(part)), np.diff(ends))
                terms = lists.values.to_numpy()[ends[0] : ends[-1]]
                counts = part.column(3).values.to_numpy()[ends[0] : ends[-1]].astype(np.int64)
                lengths = 10 + 90 * part.column(1).to_numpy() * n_docs // n_words
                impacts = 1_000_000_000 * counts // (1000 * counts + 8 * lengths[rows])
                ids = part.column(0).to_pylist()
                for tile in tiles:
                    scores = _scores(tile, span, n_terms, len(part), rows, terms, impacts)
                    top = np.argsort(-scores, axis=0, kind="stable")[:k]
                    for j, number in enumerate(tile[0].tolist()):
                        kept = best.setdefault(number, [])
                        least = -kept[-1][0] if len(kept) == k else 1
                        new = [(-s, ids[i] is None, ids[i]) for i in top[:, j] if (s := int(scores[i, j])) >= least]
                        if new:
                            best[number] = sorted(kept + new, key=_order)[:k]
        if kind is not None:
            rows = [(n, i, -s) for n, kept in best.items() for s, _, i in kept]
            numbers, ids, scores = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(ids, kind), pa.array(scores, pa.int64())], names=["number", "key", "score"])

    return run


def _order(entry: tuple):
    score, missing, key = entry
    return (score, missing) if missing else (score, missing, key)


def _block_ranks(docs: DataFrame, items: DataFrame, k: int, kind: str) -> DataFrame:
    """(number, key, score): the candidates of one block of items from every task."""
    context = docs.sparkSession.sparkContext
    held = [(r["number"], [bytes(t) for t in r["terms"]]) for r in items.collect()]
    words = sorted({t for _, terms in held for t in terms})
    number = {t: i for i, t in enumerate(words)}
    counted = settle(
        docs.mapInArrow(_counter(context.broadcast(words)), f"key {kind}, n long, terms array<int>, counts array<int>"), "term-counts"
    )
    n_docs, n_words = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    having = counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    df = np.zeros(len(words), np.int64)
    for row in having:
        df[row["term"]] = row["count"]
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    tiles = _tiles([(n, [number[t] for t in terms]) for n, terms in held], weights)
    run = _ranker(context.broadcast(tiles), len(words), _span(weights), n_docs, max(1, n_words), k)
    return counted.where("n > 0").mapInArrow(run, f"number long, key {kind}, score long")


def rank(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """(item_key, rank, key, score): the ``k`` documents of the highest score for each item.

    Only scores above 0 count; equal scores come in the order of the document's key, a null key
    last. Null and empty texts have no terms: such documents are in no list and such items have
    none. Repeated rows are documents or items of their own, so an item key that repeats has a list
    for each of its rows. Other columns are ignored; empty tables give an empty result.

    Items go in blocks of at most ``block`` (item, term) pairs, twice that at the edge; only one
    block's terms and weights are held by the driver and sent to the tasks at a time.
    """
    kind = kind_of(docs, key)
    numbered = items.select(F.col(item_key).alias("item"), F.col(item_text).cast("string").alias("item_text"))
    numbered = settle(numbered.withColumn("number", F.monotonically_increasing_id()), "items")
    listed = numbered.select("number", "item_text").mapInArrow(_item_terms, "number long, terms array<binary>")
    listed = settle(listed.where(F.size("terms") > 0), "item-terms")
    mine = docs.select(F.col(key), F.col(text).cast("string"))
    n_blocks = _blocks(listed, block)
    parts = [_block_ranks(mine, listed.where(_block_of(n_blocks) == b), k, kind) for b in range(n_blocks)]
    if not parts:
        empty = docs.where("false").select(F.lit(0).cast("long").alias("number"), F.col(key).alias("key"), F.lit(0).cast("long").alias("score"))
        parts = [empty]
    found = reduce(DataFrame.unionByName, parts)
    order = [F.desc("score"), F.asc_nulls_last("key")]
    # first among some of the tasks, so that no task meets all candidates of an item
    salt = F.pmod(F.xxhash64("key", "score"), F.lit(SALTS))
    found = found.withColumn("salt", salt).withColumn("rank", F.row_number().over(Window.partitionBy("number", "salt").orderBy(*order))).where(F.col("rank") <= k)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("number").orderBy(*order))).where(F.col("rank") <= k)
    return found.join(numbered.select("number", "item"), "number").select(
        F.col("item").alias(item_key), "rank", F.col("key").alias(key), "score"
    )
