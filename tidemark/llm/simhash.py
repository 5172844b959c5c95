"""Near-duplicate texts by SimHash fingerprints and covering locality-sensitive hashing.

A fingerprint takes the majority of each bit over the hashes of all word shingles of a text. Two
texts are linked when their fingerprints differ in at most ``RADIUS`` bits; linked texts form
groups.

Covering hashing finds every such pair. Each bit position gets a vector of RADIUS + 1 bits, and
each non-zero vector v a mask of the positions whose vector has an odd overlap with v. The
vectors of RADIUS differing positions span a space too small to fill all RADIUS + 1 dimensions,
so some v is even on all of them: under the mask of that v the two fingerprints are equal.
31 masks of about 32 bits do for radius 4, with certainty and not with high probability.

Equal fingerprints are one node from the start, so a group of exact copies costs nothing here.
A bucket of many different fingerprints is cut by the masks of a second family of vectors, which
covers every pair too, and never falls to one task whole. Inside a bucket only the links of a
spanning forest are returned, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_digest

from tidemark.llm.common import fresh, kind_of, settle
from tidemark.llm.components import components

WORDS = 4
RADIUS = 4
SEED = 42
BITS = 64
#: Buckets with more different fingerprints are cut by the second family of masks.
BUCKET = 20_000
#: Runs up to this length are compared directly; longer ones are cut by a third family.
DIRECT = 1_000
_CHUNK = 100_000


def text_fingerprint(data: bytes, width: int = WORDS) -> int:
    """The fingerprint of one text in UTF-8, as a signed 64-bit number."""
    words = data.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words), initial=-1))[1:]
    starts = [0, *(e + 1 for e in ends)]
    ends = ends[width - 1 :] or [len(line)]
    votes = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(ends), _CHUNK):
        part = zip(starts[at : at + _CHUNK], ends[at : at + _CHUNK], strict=False)
        hashes = b"".join([xxh64_digest(line[s:e], SEED) for s, e in part])
        bits = np.unpackbits(np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(ends)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WORDS) -> DataFrame:
    """(key, fp) of every row, whole texts. A null or empty text has fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            prints = [text_fingerprint((t.as_py() or "").encode(), width) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints, pa.int64())], names=["key", "fp"]
            )

    return docs.select(F.col(key), F.col(text).cast("string")).mapInArrow(
        run, f"key {kind_of(docs, key)}, fp long"
    )


def _vectors(family: int) -> list[int]:
    """One non-zero vector for each bit; families pair the bits up differently."""
    step = (1, 37, 11)[family]
    space = 2 ** (RADIUS + 1) - 1
    return [1 + (i * step % BITS) % space for i in range(BITS)]


def masks(family: int = 0) -> list[int]:
    """The covering masks of one family, as unsigned numbers."""
    vectors = _vectors(family)
    return [
        sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2)
        for v in range(1, 2 ** (RADIUS + 1))
    ]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _keys(fp: Column, family: int) -> Column:
    return F.array(*[fp.bitwiseAND(F.lit(_signed(m)).cast("long")) for m in masks(family)])


def _spanning(values: np.ndarray, out: list) -> None:
    """Links from the first of each local group to its other members."""
    left = np.sort(values)
    while len(left) > 1:
        root, left = left[0], left[1:]
        open_ends = [root]
        while open_ends and len(left):
            near = np.bitwise_count(left ^ open_ends.pop()) <= RADIUS
            if near.any():
                found = left[near]
                out.append(np.column_stack([np.full(len(found), root), found]))
                open_ends.extend(found)
                left = left[~near]


def bucket_links(values: np.ndarray) -> np.ndarray:
    """A spanning forest of the links among different fingerprints of one bucket."""
    out: list = []
    if len(values) <= DIRECT:
        _spanning(values, out)
    else:
        for mask in masks(2):
            keys = values & np.uint64(mask)
            order = np.argsort(keys, kind="stable")
            cuts = np.flatnonzero(np.diff(keys[order])) + 1
            for run in np.split(values[order], cuts):
                if len(run) > 1:
                    _spanning(run, out)
    return np.concatenate(out) if out else np.zeros((0, 2), dtype=np.uint64)


def _links_of_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column(0)
        flat = column.values.to_numpy(zero_copy_only=False).view(np.uint64)
        offsets = column.offsets.to_numpy()
        found = [bucket_links(flat[s:e]) for s, e in zip(offsets[:-1], offsets[1:], strict=True)]
        pairs = np.concatenate(found or [np.zeros((0, 2), np.uint64)]).astype(np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.minimum(pairs[:, 0], pairs[:, 1])), pa.array(np.maximum(pairs[:, 0], pairs[:, 1]))],
            names=["a", "b"],
        )


def links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(a, b) with a < b: enough links among different fingerprints to reach every group whole.

    ``prints`` has one row for each different ``fp``.
    """
    # a settled table of few bytes has few files, but every row of it becomes 31
    prints = prints.repartition("fp")
    keyed = prints.select("fp", F.posexplode(_keys(F.col("fp"), 0)).alias("mask", "key"))
    large = (
        keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).where(F.col("n") > bucket).select("mask", "key")
    )
    large = settle(large, "large-buckets")
    small = keyed.join(large, ["mask", "key"], "left_anti")
    cut = keyed.join(large, ["mask", "key"], "left_semi").select(
        "fp", "mask", "key", F.posexplode(_keys(F.col("fp"), 1)).alias("mask2", "key2")
    )
    members = [
        small.groupBy("mask", "key").agg(F.collect_list("fp").alias("fps")),
        cut.groupBy("mask", "key", "mask2", "key2").agg(F.collect_list("fp").alias("fps")),
    ]
    groups = members[0].select("fps").unionByName(members[1].select("fps")).where(F.size("fps") > 1)
    return groups.mapInArrow(_links_of_buckets, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WORDS) -> DataFrame:
    """(key, fingerprint, component_id) for every row.

    The component id is the smallest key whose fingerprint is reachable over links of at most
    RADIUS differing bits, the row itself included. Null and empty texts share fingerprint 0 and
    are linked like any other. Repeated keys keep a row each; a null key counts as no candidate
    for the smallest one, and a group of null keys only has a null id. Other columns are ignored.
    An empty table gives an empty result.
    """
    rows = settle(fingerprints(docs, key, text, width), "fingerprints")
    prints = settle(rows.groupBy("fp").agg(F.min("key").alias("least")), "prints")
    roots = components(links(prints.select("fp")))
    named = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    group = named.join(least, "root").select("fp", "component_id")
    return rows.join(group, "fp").select(
        F.col("key").alias(key),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def row_of(key: str, text: str) -> Column:
    """What tells the rows of a table apart: a hash of key and text, as a key may stand at several texts."""
    return F.xxhash64(F.lit(1), F.col(key).cast("string"), F.coalesce(F.col(text).cast("string"), F.lit("")))


def row_links(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """(row, fp) of the different rows, and the links (a, b) among their fingerprints."""
    texts = docs.select(row_of(key, text).alias("row"), F.col(text).alias("text"))
    rows = settle(fingerprints(texts, "row", "text", width).withColumnRenamed("key", "row").dropDuplicates(["row"]), "fingerprints")
    prints = settle(rows.select("fp").distinct(), "prints")
    return rows, settle(links(prints), "links")


def keep_least(docs: DataFrame, groups: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Of each group the document with the smallest key, columns unchanged.

    ``groups`` has (row, group) with the group of every different ``row_of`` the documents. Of rows
    of a group that repeat its smallest key, the first by text and then by the other columns stays.
    """
    row, group, first = fresh(docs, "row", "group", "first")
    narrow = docs.where(F.col(key).isNotNull()).select(row_of(key, text).alias("row"), F.col(key).alias("key"))
    named = narrow.distinct().join(groups, "row")
    least = named.groupBy("group").agg(F.min("key").alias("key"))
    # a key that stands in several groups stays in those where it is the smallest
    stays = named.join(least, ["group", "key"]).select(F.col("row").alias(row), F.col("group").alias(group))
    rest = [text, *(c for c in docs.columns if c not in (key, text))]
    order = F.row_number().over(Window.partitionBy(group).orderBy(*rest))
    kept = docs.where(F.col(key).isNotNull()).withColumn(row, row_of(key, text)).join(stays, row)
    kept = kept.withColumn(first, order).where(F.col(first) == 1)
    return kept.select(*docs.columns).unionByName(docs.where(F.col(key).isNull()))


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay: of each group the one with the smallest key, columns unchanged.

    Of rows of a group that repeat that key, the first by text and then by the other columns stays.
    Rows without a key cannot be told apart and all stay.
    """
    rows, found = row_links(docs, key, text)
    roots = components(found).withColumnRenamed("node", "fp")
    groups = rows.join(roots, "fp", "left").select("row", F.coalesce("root", "fp").alias("group"))
    return keep_least(docs, settle(groups, "groups"), key, text)
