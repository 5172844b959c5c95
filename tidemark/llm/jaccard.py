"""Near-duplicate texts by the exact Jaccard similarity of their word shingles.

Two texts are linked when they share ``SIMILARITY`` of the different shingles of ``WORDS`` words that
either of them has; linked texts form groups. Texts with the same shingles are one node from the
start, so a group of exact copies costs nothing here.

Pairs to compare come from min-hashes in ``BANDS`` bands of ``ROWS``: two texts meet in a bucket if a
band agrees. A pair of similarity s stays apart with probability (1 - s**ROWS)**BANDS, which is 1.3e-7
at 0.8. Every pair that meets is compared shingle by shingle, unless its texts already belong to one
group: a bucket of up to ``SMALL`` texts pair by pair, a larger one by its first text with all others
and, while that leaves several groups, by its next 4 and 16. Which come first is the same in all
buckets, so texts that share most buckets meet the same few. A large group of near copies takes as
many comparisons as it has members, not their square.

What is still apart then, in buckets of more than one group, are texts that meet without being alike,
such as pages of one template. They are joined by their rarest shingles: two sets that are alike
enough must share one of the first few of their shingles in any common order, and in the order of
rarity, and with both sizes known, these are few. Pages that differ in more than the similarity
allows have them to themselves and never meet.
Members of the largest group at a shingle are joined to those of other groups only. That join
misses no pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_digest, xxh64_intdigest

from tidemark.llm.common import settle
from tidemark.llm.components import components
from tidemark.llm.simhash import keep_least, row_links, row_of

WORDS = 5
SIMILARITY = 0.8
BANDS = 40
ROWS = 5
SEED = 42
#: Buckets of up to so many texts are compared pair by pair.
SMALL = 8
#: How many texts of a larger bucket are compared with all others, round by round.
CENTRES = (1, 4, 16)
#: Sizes in one class differ by this factor at most.
CLASS = 1.05
_CHUNK = 512
_random = np.random.default_rng(SEED)
_FACTORS = _random.integers(0, 2**63, (BANDS * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIPS = _random.integers(0, 2**64, (BANDS * ROWS, 1), dtype=np.uint64)


def shingles(data: bytes, width: int = WORDS) -> np.ndarray:
    """The sorted hashes of the different shingles of one text in UTF-8."""
    words = data.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words), initial=-1))[1:]
    starts = [0, *(e + 1 for e in ends)]
    ends = ends[width - 1 :] or [len(line)]
    hashes = b"".join([xxh64_digest(line[s:e], SEED) for s, e in zip(starts, ends, strict=False)])
    return np.unique(np.frombuffer(hashes, dtype=">u8").astype(np.uint64))


def bands(hashes: np.ndarray) -> list[int]:
    """The bucket of each band of min-hashes; a text without words has none."""
    if not len(hashes):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), _CHUNK):
        least = np.minimum(least, ((hashes[at : at + _CHUNK] ^ _FLIPS) * _FACTORS).min(axis=1))
    keys = [xxh64_intdigest(band.tobytes(), i) for i, band in enumerate(least.reshape(BANDS, ROWS))]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def _body(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def _hashed(texts: DataFrame, width: int, whole: bool) -> DataFrame:
    """(row, node, n, found) of (row, text): the hash and number of its shingles, and they or its buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py().encode(), width) for t in batch.column(1)]
            nodes = np.array([xxh64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64).view(np.int64)
            found = [s.view(np.int64) if whole else bands(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(nodes), pa.array([len(s) for s in sets], pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                names=["row", "node", "n", "found"],
            )

    return texts.mapInArrow(run, "row long, node long, n long, found array<long>")


def _rooted(members: DataFrame, links: DataFrame | None) -> DataFrame:
    """Members with the smallest node that each reaches over the links."""
    if links is None:
        return members.withColumn("root", F.col("node"))
    roots = settle(components(links), "roots")
    return members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _pairs(left: DataFrame, right: DataFrame, similarity: float) -> DataFrame:
    """(a, b) with a < b that share a bucket, are in different groups and of sizes that allow a link."""
    x, y = left.alias("x"), right.alias("y")
    size = F.least("x.n", "y.n") >= F.greatest("x.n", "y.n") * similarity - 1e-6
    return (
        x.join(y, F.col("x.bucket") == F.col("y.bucket"))
        .where((F.col("x.root") != F.col("y.root")) & size)
        .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
        .distinct()
    )


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose shingles are alike enough."""
    one = sets.select(F.col("node").alias("a"), F.col("found").alias("left"))
    other = sets.select(F.col("node").alias("b"), F.col("found").alias("right"))
    both = pairs.join(one, "a").join(other, "b").withColumn("same", F.size(F.array_intersect("left", "right")))
    either = F.size("left") + F.size("right") - F.col("same")
    return both.where(F.col("same") >= either * similarity - 1e-6).select("a", "b")


def links(members: DataFrame, sets: DataFrame, similarity: float = SIMILARITY, small: int = SMALL) -> DataFrame:
    """(a, b) with a < b: enough links to reach every group whole.

    ``members`` has (bucket, node, n) and ``sets`` (node, found) with the shingles of each node.
    """
    sizes = settle(members.groupBy("bucket").agg(F.count("*").alias("size")), "sizes")
    members = settle(members.join(sizes, "bucket"), "members")
    few = _rooted(members.where(F.col("size") <= small), None)
    pairs = _pairs(few, few, similarity)
    members = members.where(F.col("size") > small).drop("size")
    found = None
    for centres in CENTRES:
        rooted = settle(_mixed(members, found), "open-buckets")
        if rooted.isEmpty() and found is not None:
            return found
        rank = F.row_number().over(Window.partitionBy("bucket").orderBy("node"))
        chosen = settle(rooted.withColumn("rank", rank).where(F.col("rank") <= centres).drop("rank"), "centres")
        more = _pairs(rooted, chosen, similarity)
        pairs = settle(more if pairs is None else pairs.unionByName(more).distinct(), "pairs")
        verified = settle(_verified(pairs, sets, similarity), "verified")
        found = verified if found is None else found.unionByName(verified)
        members = rooted.drop("root").join(chosen.select("bucket", "node"), ["bucket", "node"], "left_anti")
        pairs = None
    rest = settle(_mixed(members, found).select("node", "n", "root").distinct(), "rest")
    if rest.isEmpty():
        return found
    pairs = settle(prefix_pairs(rest, sets, similarity), "pairs")
    return found.unionByName(settle(_verified(pairs, sets, similarity), "verified"))


def _mixed(members: DataFrame, found: DataFrame | None) -> DataFrame:
    """Members with their groups, of the buckets that have more than one group."""
    rooted = settle(_rooted(members, found), "rooted")
    several = rooted.groupBy("bucket").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least < most")
    return rooted.join(several.select("bucket"), "bucket", "left_semi")


def prefix_pairs(nodes: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b) with a < b of different groups, all that may be alike enough, by their rarest shingles.

    ``nodes`` has (node, n, root). Of two sets of x and y shingles that are alike, at least
    s / (1 + s) * (x + y) are shared. So in one order of all shingles, one of the first
    x - that + 1 of the one stands among as many of the other, and no more than what follows it can
    be shared. Sizes are cut into classes, so that a class of partners bounds y from below.
    """
    share, ratio = similarity / (1 + similarity), math.log(CLASS)
    rows = sets.join(nodes, "node").select("node", "n", "root", F.explode("found").alias("shingle"))
    often = rows.groupBy("shingle").agg(F.count("*").alias("df"), F.min("root").alias("least"), F.max("root").alias("most"))
    often = often.where("df > 1").select("shingle", "df", (F.col("least") < F.col("most")).alias("mixed"))
    order = Window.partitionBy("node").orderBy(F.coalesce("df", F.lit(1)), "shingle")
    placed = rows.join(often, "shingle", "left").withColumn("place", F.row_number().over(order)).where("mixed")

    def size_class(n: Column) -> Column:
        return F.floor(F.log(n) / ratio + 1e-9).cast("int")

    own = size_class(F.col("n"))
    partners = F.sequence(size_class(F.greatest(F.ceil(F.col("n") * similarity - 1e-6), F.lit(1))), size_class(F.floor(F.col("n") / similarity + 1e-6)))
    least = F.greatest(F.lit(1), F.ceil(F.exp((F.col("other") - 1e-8) * ratio) - 1e-6), F.ceil(F.col("n") * similarity - 1e-6))
    first = F.col("n") - F.ceil(share * (F.col("n") + least) - 1e-6) + 1
    # no partner asks for a longer stretch than the smallest
    longest = F.col("n") - F.ceil(F.col("n") * similarity - 1e-6) + 1
    entries = placed.where(F.col("place") <= longest).withColumns({"own": own, "other": F.explode(partners)}).where(F.col("place") <= first)
    low, high = F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    entries = settle(entries.select("node", "n", "root", "shingle", "place", "own", "other", low, high), "prefixes")
    at = ["shingle", "low", "high"]
    largest = entries.groupBy(*at, "root").count().groupBy(*at).agg(F.max_by("root", F.struct("count", "root")).alias("largest"), F.count("*").alias("groups"))
    x = entries.join(largest.where("groups > 1"), at).where("root <> largest").alias("x")
    y = entries.alias("y")
    same = (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.own") == F.col("y.other")) & (F.col("x.other") == F.col("y.own"))
    left = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place")) + 1
    enough = left >= share * (F.col("x.n") + F.col("y.n")) - 1e-6
    met = x.join(y, same & (F.col("x.root") != F.col("y.root")) & enough)
    return met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def _grouped(hashed: DataFrame, texts: DataFrame, prints: tuple[DataFrame, DataFrame] | None, width: int, similarity: float, small: int) -> DataFrame:
    """(node, root) of the nodes that are linked with others.

    ``hashed`` has (row, node, n, found) with the bands of each, ``texts`` (row, text). ``prints`` are
    fingerprints (row, fp) and links (a, b) among them: rows that these link are of one group as well.
    """
    nodes = settle(hashed.groupBy("node").agg(F.min("row").alias("row"), F.max("n").alias("n"), F.max("found").alias("found")), "bands")
    exploded = nodes.select(F.explode("found").alias("bucket"), "node", "n")
    print_of = F.xxhash64("node")
    shared = (
        exploded.groupBy("bucket")
        .agg(F.count("*").alias("size"), F.bit_xor(print_of).alias("print"), F.min("node").alias("first"), F.max("node").alias("last"))
        .where("size > 1")
    )
    # buckets with the same texts are one
    shared = settle(shared.groupBy("size", "print", "first", "last").agg(F.min("bucket").alias("bucket")).select("bucket"), "buckets")
    members = settle(exploded.join(shared, "bucket"), "shared-buckets")
    met = settle(members.select("node").distinct().join(nodes.select("node", "row"), "node").select("row"), "met")
    sets = settle(_hashed(texts.join(met, "row", "left_semi"), width, True).dropDuplicates(["node"]).select("node", "found"), "sets")
    found = links(members, sets, similarity, small)
    return components(found if prints is None else found.unionByName(_print_links(hashed, *prints)))


def _print_links(hashed: DataFrame, prints: DataFrame, found: DataFrame) -> DataFrame:
    """(a, b) that tie nodes to their fingerprints, and those to each other; fingerprints are nodes by a hash."""
    as_node = lambda c: F.xxhash64(F.lit("fingerprint"), c)
    pairs = settle(prints.join(hashed.select("row", "node"), "row").select("fp", "node").distinct(), "fingerprint-nodes")
    several = pairs.groupBy("fp").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least < most").select("fp")
    matter = settle(several.unionByName(found.select(F.explode(F.array("a", "b")).alias("fp"))).distinct(), "linked-fingerprints")
    ties = pairs.join(matter, "fp", "left_semi").select("node", as_node("fp").alias("other"))
    ties = ties.unionByName(found.select(as_node("a").alias("node"), as_node("b").alias("other")))
    return settle(ties.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")), "fingerprint-links")


def _bucketed(docs: DataFrame, key: str, text: str, width: int) -> tuple[DataFrame, DataFrame]:
    """(row, text) of all rows, and what ``_hashed`` gives for the different ones, with bands."""
    texts = docs.select(row_of(key, text).alias("row"), _body(text).alias("text"))
    return texts, settle(_hashed(texts, width, False).dropDuplicates(["row"]), "shingles")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WORDS, similarity: float = SIMILARITY, small: int = SMALL
) -> DataFrame:
    """(key, component_id) for every row.

    The component id is the smallest key that the row reaches over links, itself included. Null and
    empty texts are alike. Repeated keys keep a row each; a null key counts as no candidate for the
    smallest one, and a group of null keys only has a null id. An empty table gives an empty result.
    """
    texts, hashed = _bucketed(docs, key, text, width)
    rows = settle(docs.select(F.col(key).alias("key"), row_of(key, text).alias("row")).join(hashed.select("row", "node"), "row"), "rows")
    least = settle(rows.groupBy("node").agg(F.min("key").alias("least")), "nodes")
    roots = _grouped(hashed, texts, None, width, similarity, small)
    named = least.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    group = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = settle(named.join(group, "root").select("node", "component_id"), "groups")
    return rows.join(named, "node").select(F.col("key").alias(key), "component_id")


def deduplicate(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WORDS, similarity: float = SIMILARITY, by_prints: bool = False
) -> DataFrame:
    """The documents that stay: of each group the one with the smallest key, columns unchanged.

    With ``by_prints`` the links of SimHash fingerprints count too, and groups go by either kind. Of
    rows of a group that repeat that key, the first by text and then by the other columns stays. Rows
    without a key cannot be told apart and all stay.
    """
    prints = row_links(docs, key, text) if by_prints else None
    texts, hashed = _bucketed(docs, key, text, width)
    roots = _grouped(hashed, texts, prints, width, similarity, SMALL)
    groups = hashed.select("row", "node").join(roots, "node", "left").select("row", F.coalesce("root", "node").alias("group"))
    return keep_least(docs, settle(groups, "groups"), key, text)
