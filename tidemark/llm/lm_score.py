"""Language-model scores by stupid backoff, from count tables joined to the n-grams of the texts.

The score of a word after another is the count of the pair over the count of the first, where the
pair is seen at least twice; else 0.4 times the share of the word. A text's score is the mean
logarithm over its words.

Tasks turn texts into the hashes of their words and pairs; Spark counts, joins and sums them. Every
word starts with what it scores when it backs off, and a pair that is seen often enough adds the
difference. So only such pairs are in a table, a small part of all there are, and a pair that finds
no row there needs none.

Words of the largest counts, ``KNOWN`` of them, and the seen pairs of the ``FREQUENT`` most frequent
ones go to every task: their number is bounded whatever the input. What they score is summed where
the text is read. All else is joined: the rows of a text that are left travel as one hash each. The
texts are joined in ``SLICES`` parts, each text in one, so that it is split once for all its joins and
the files of one part's shuffle are gone before the next. No word or pair that is left is frequent, so
no task of the join has much more to do than others.

Hashes have 64 bits. Among 10^12 different pairs in the table, a pair that is not there finds the row
of another one in 20 million times.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidemark.llm.common import discard, settle

BACKOFF = 0.4
CUTOFF = 2
KNOWN, FREQUENT = 1 << 18, 2_048
SLICES = 3
#: Stands before the first word of a text.
START = b"\x02"
SEED = 42
_HELD, _WIDE = 1 << 20, 1 << 31
_AT_ONCE = 1 << 22
#: Bytes of text in one block of texts.
_BLOCK = 1 << 22
_ROOM = 1 << 12
# The primes of XXH64.
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def hash_long(x: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """XXH64 of eight bytes each, as Spark hashes a long."""
    h = (seed + _P5 + np.uint64(8)) ^ (_turned(x * _P2, 31) * _P1)
    h = _turned(h, 27) * _P1 + _P4
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The hash of two word hashes, Spark's ``xxhash64(first, second)``."""
    return hash_long(second, hash_long(first, np.full(len(first), SEED, np.uint64)))


def hash_words(words: pa.Array) -> np.ndarray:
    """XXH64 of every word, as Spark hashes a string: the same step of all words at once."""
    words = words.cast(pa.large_binary())
    if not len(words):
        return np.zeros(0, np.uint64)
    _, offsets, data = words.buffers()
    at = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
    starts, lengths = at[:-1] - at[0], np.diff(at)
    # room for a read of eight bytes that begins in the last word
    held = np.zeros(at[-1] - at[0] + 8, np.uint8)
    if at[-1] > at[0]:
        held[:-8] = np.frombuffer(data, np.uint8)[at[0] : at[-1]]
    eight, four = (np.lib.stride_tricks.sliding_window_view(held, n) for n in (8, 4))
    h = np.uint64(SEED) + _P5 + lengths.astype(np.uint64)
    for done in (0, 8, 16):
        some = np.flatnonzero(lengths >= done + 8)
        read = eight[starts[some] + done].view("<u8").ravel()
        h[some] = _turned(h[some] ^ (_turned(read * _P2, 31) * _P1), 27) * _P1 + _P4
    some = np.flatnonzero(lengths & 4)
    read = four[starts[some] + (lengths[some] & ~7)].view("<u4").ravel().astype(np.uint64)
    h[some] = _turned(h[some] ^ (read * _P1), 23) * _P2 + _P3
    for k in range(3):
        some = np.flatnonzero((lengths & 3) > k)
        read = held[starts[some] + (lengths[some] & ~3) + k].astype(np.uint64)
        h[some] = _turned(h[some] ^ (read * _P5), 11) * _P1
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    h ^= h >> np.uint64(32)
    long = np.flatnonzero(lengths >= 32)
    h[long] = [xxh64_intdigest(w, SEED) for w in words.take(pa.array(long)).to_pylist()]
    return h


class Words:
    """Numbers for the words that a task meets, by their hashes, and what is known of each, by its number.

    A word's number gives its hash, Spark's ``xxhash64(word)``, and with ``known`` the logarithm of
    what it scores and its place among the most frequent words. Number 0 is the start of a text.
    Arrow splits a block of texts and finds its different words; only those are hashed and numbered.
    Numbers hold for one block of texts: when there are too many, all are given anew. The arrays
    have room for more words than the ``n`` there are, so a block copies only what is new.
    """

    def __init__(self, known: Known | None = None):
        self.known = known
        self.renew()

    @property
    def full(self) -> bool:
        return self.n > _HELD

    def renew(self) -> None:
        self.n = 0
        self.hashes = np.zeros(_ROOM, np.uint64)
        self.logs, self.ranks = np.zeros(_ROOM), np.zeros(_ROOM, np.int64)
        # the number of a word stands in the place that its hash begins with, or in the next free one
        self.places = np.full(4 * _ROOM, -1)
        self._numbers(np.array([xxh64_intdigest(START, SEED)], np.uint64))

    def _numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, all at once place by place; words that are new get the next ones."""
        if 2 * (self.n + len(hashes)) > len(self.places):
            held, self.n = self.hashes[: self.n].copy(), 0
            self.places = np.full(4 << (len(held) + len(hashes)).bit_length(), -1)
            # all keep the numbers they had
            had = np.argsort(self._placed(held))
            self.hashes[: self.n], taken = held, self.places >= 0
            self.places[taken] = had[self.places[taken]]
        begun, numbers = self.n, self._placed(hashes)
        if self.known is not None and self.n > begun:
            logs, ranks = self.known.of(self.hashes[begun : self.n])
            self.logs, self.ranks = self._with(self.logs, begun, logs), self._with(self.ranks, begun, ranks)
        return numbers

    def _placed(self, hashes: np.ndarray) -> np.ndarray:
        numbers, left = np.zeros(len(hashes), np.int64), np.arange(len(hashes))
        place = (hashes >> np.uint64(65 - len(self.places).bit_length())).astype(np.int64)
        while len(left):
            there = self.places[place[left]]
            # of the new words that meet in a free place one gets it, the others look there again
            new = left[there < 0]
            self.places[place[new]] = new
            new = new[self.places[place[new]] == new]
            self.places[place[new]] = self.n + np.arange(len(new))
            self.hashes = self._with(self.hashes, self.n, hashes[new])
            self.n += len(new)
            there = self.places[place[left]]
            same = self.hashes[there] == hashes[left]
            numbers[left[same]] = there[same]
            left = left[~same]
            place[left] = (place[left] + 1) % len(self.places)
        return numbers

    @staticmethod
    def _with(held: np.ndarray, begun: int, new: np.ndarray) -> np.ndarray:
        """The array with values for new words; twice as long when it has no room for them."""
        until = begun + len(new)
        if until > len(held):
            held = np.concatenate([held[:begun], np.zeros(2 * until - begun, held.dtype)])
        held[begun:until] = new
        return held

    def block(self, texts: pa.Array | list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of some texts: the number of each word, of the word before it, and its text's place."""
        if self.full:
            self.renew()
        if isinstance(texts, list):
            texts = pa.array(texts, pa.string())
        split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
        of = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
        words = split.flatten().dictionary_encode()
        kinds, at = words.dictionary, words.indices.to_numpy(zero_copy_only=False)
        # before and after white space at the ends of a text stands an empty word
        empty = pc.index(kinds, pa.scalar("", kinds.type)).as_py()
        if empty >= 0:
            here = at != empty
            kinds, at, of = pc.filter(kinds, pc.not_equal(kinds, "")), at[here], of[here]
            at = at - (at > empty)
        ids = self._numbers(hash_words(kinds))[at]
        before = np.zeros_like(ids)
        before[1:] = np.where(of[1:] == of[:-1], ids[:-1], 0)
        return ids, before, of


class Known:
    """What tasks know: logarithms of frequent words, and gains of pairs of the most frequent."""

    def __init__(self, words: np.ndarray, logs: np.ndarray, first: np.ndarray, second: np.ndarray, gains: np.ndarray):
        order = np.argsort(words)
        self.words, self.logs, self.ranks = words[order], logs[order], np.where(order < FREQUENT, order, -1)
        self.gains = np.full((min(FREQUENT, len(words)),) * 2, np.nan)
        self.gains[self.of(first)[1], self.of(second)[1]] = gains

    def of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of words, their logarithms, nan if not known, and their places among the most frequent, or -1."""
        if not len(self.words):
            return np.full(len(hashes), np.nan), np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        here = self.words[at] == hashes
        return np.where(here, self.logs[at], np.nan), np.where(here, self.ranks[at], -1)


def _blocks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """The rows in blocks of so much text, or of one row."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at, read = 0, 0
        while at < len(batch):
            until = max(at + 1, int(np.searchsorted(ends, read + _BLOCK, "right")))
            rows = batch.slice(at, until - at)
            yield rows, rows.column(column)
            at, read = until, ends[until - 1]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(first, second, n): how often each pair occurs, and with a null second each word."""
    words, counts, held, size, starts = Words(), np.zeros(0, np.int64), [], 0, 0

    def pairs() -> pa.RecordBatch:
        nonlocal counts
        found, n = np.unique(np.concatenate(held), return_counts=True)
        first, second = found // _WIDE, found % _WIDE
        more = np.bincount(second, n, words.n).astype(np.int64)
        more[: len(counts)] += counts
        counts = more
        return pa.RecordBatch.from_arrays([_signed(words.hashes[first]), _signed(words.hashes[second]), pa.array(n)], names=["first", "second", "n"])

    def singles() -> pa.RecordBatch:
        counts[0] += starts
        some = np.flatnonzero(counts)
        return pa.RecordBatch.from_arrays([_signed(words.hashes[some]), pa.nulls(len(some), pa.int64()), pa.array(counts[some])], names=["first", "second", "n"])

    for _, texts in _blocks(batches, 0):
        if held and (size >= _AT_ONCE or words.full):
            yield pairs()
            held, size = [], 0
        if words.full and len(counts):
            yield singles()
            counts, starts = np.zeros(0, np.int64), 0
        ids, before, of = words.block(texts)
        if len(ids):
            starts += 1 + (of[1:] != of[:-1]).sum()
            held.append(before * _WIDE + ids)
            size += len(ids)
    if held:
        yield pairs()
    if len(counts):
        yield singles()


def _split(words: Words, texts: pa.Array) -> tuple[np.ndarray, ...]:
    """Of some texts: what of each needs no join (words, sum, pairs), and the hashes to look up with
    the places of their texts."""
    known = words.known
    ids, before, of = words.block(texts)
    first, second, logs = words.ranks[before], words.ranks[ids], words.logs[ids]
    here = (first >= 0) & (second >= 0)
    gains = np.full(len(ids), np.nan)
    gains[here] = known.gains[first[here], second[here]]
    seen, rare = ~np.isnan(gains), np.isnan(logs)
    total = np.where(seen, gains, 0) + np.where(rare, 0, logs)
    pairs = pair_hash(words.hashes[before[~here]], words.hashes[ids[~here]])
    # a word's hash and a pair's are told apart by hashing the word's once more
    single = hash_long(words.hashes[ids[rare]], np.full(rare.sum(), SEED, np.uint64))
    n = len(texts)
    sums = np.bincount(of, minlength=n), np.bincount(of, total, n), np.bincount(of, seen, n).astype(np.int64)
    return *sums, np.concatenate([pairs, single]), np.concatenate([of[~here], of[rare]])


def _looked_up(shared):
    """Of each text, the hashes that are to be looked up, and a row of its own, with its number of
    words and one, and the sum and number of pairs that need no join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(shared.value)
        for rows, texts in _blocks(batches, 2):
            n, known, seen, what, of = _split(words, texts)
            order = np.argsort(of, kind="stable")
            what, of, zero = what[order], of[order], np.zeros(len(of), np.int64)
            ids = [rows.column(c).to_numpy() for c in (0, 1)]
            # any hash that differs from text to text, so that no task gets all of these rows
            what = np.concatenate([what, ids[0].view(np.uint64)])
            of = np.concatenate([of, np.arange(len(texts))])
            numbers = [np.concatenate(x) for x in zip([zero, zero.astype(float), zero], (n + 1, known, seen))]
            columns = [*(pa.array(x[of]) for x in ids), _signed(what), *map(pa.array, numbers)]
            yield pa.RecordBatch.from_arrays(columns, names=["r1", "r2", "what", "n", "known", "seen"])

    return run


def counts_of(docs: DataFrame, text: str = "text", cutoff: int = CUTOFF) -> DataFrame:
    """(first, second, n): the count of every pair that is seen often enough, by the hashes of its
    words, and of every word, with a null second. The start of a text counts as the word U+0002."""
    counted = docs.select(F.col(text).cast("string")).mapInArrow(_counter, "first long, second long, n long")
    # pairs of four million words are one row each already: to add up once more before the shuffle is in vain
    counted = counted.repartition("first", "second").groupBy("first", "second").agg(F.sum("n").alias("n"))
    return counted.where(F.col("second").isNull() | (F.col("n") >= cutoff))


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", cutoff: int = CUTOFF) -> DataFrame:
    """(key, n_words, n_backed_off, mean_log_score) of every row against the counts of all rows.

    Words are separated by ASCII white space and read with A-Z in lower case. Null and empty texts
    have no words and a null mean. Rows that repeat key and text count twice in the tables and get
    equal rows. A null key is kept, other columns are ignored, an empty table gives an empty result.
    """
    context = docs.sparkSession.sparkContext
    start = int(np.uint64(xxh64_intdigest(START, SEED)).view(np.int64))
    counted = settle(counts_of(docs, text, cutoff), "counts")
    counts = settle(counted.where("second IS NULL").select(F.col("first").alias("word"), "n"), "word-counts")
    words = counts.agg(F.sum(F.when(F.col("word") != start, F.col("n")))).first()[0] or 0
    share = BACKOFF / max(words, 1)
    top = counts.orderBy(F.desc("n"), "word").limit(KNOWN)
    frequent = top.orderBy(F.desc("n"), "word").limit(FREQUENT).select("word")
    one = counts.select(F.col("word").alias("first"), F.col("n").alias("n1"))
    two = counts.select(F.col("word").alias("second"), F.col("n").alias("n2"))
    gain = F.log(F.col("n") / F.col("n1")) - F.log(F.col("n2") * share)
    kinds = counted.where("second IS NOT NULL")
    frequent = settle(frequent, "frequent-words")
    by = [F.broadcast(frequent.select(F.col("word").alias(c), F.lit(True).alias(f"{c}_frequent"))) for c in ("first", "second")]
    found = kinds.join(one, "first").join(two, "second").join(by[0], "first", "left").join(by[1], "second", "left")
    # the words themselves are only needed of pairs that go to every task
    both = F.col("first_frequent") & F.col("second_frequent")
    gains = settle(
        found.select(F.xxhash64("first", "second").alias("what"), gain.alias("value"), *[F.when(both, F.col(c)).alias(c) for c in ("first", "second")]),
        "gains",
    )
    discard(counted)

    listed = top.toArrow()
    held = gains.where("first IS NOT NULL").select("first", "second", "value").toArrow()
    numbers = lambda table, name: table.column(name).to_numpy()
    known = Known(
        numbers(listed, "word").view(np.uint64),
        np.log(numbers(listed, "n") * share) if listed.num_rows else np.zeros(0),
        numbers(held, "first").view(np.uint64),
        numbers(held, "second").view(np.uint64),
        numbers(held, "value"),
    )
    shared = context.broadcast(known)

    rare = counts.join(F.broadcast(top.select("word")), "word", "left_anti")
    table = gains.select("what", "value", F.lit(1).alias("pair")).unionByName(
        rare.select(F.xxhash64("word").alias("what"), F.log(F.col("n") * share).alias("value"), F.lit(0).alias("pair"))
    )
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    named = F.coalesce(F.col(key).cast("string"), F.lit(""))
    ids = [F.xxhash64(F.lit(1), F.col(key).cast("string"), body).alias("r1"), F.xxhash64(F.lit(2), F.length(body), named, body).alias("r2")]
    texts = docs.select(*ids, body.alias("text"))
    sums = []
    for part in range(SLICES):
        mine = texts.where(F.pmod("r1", F.lit(SLICES)) == part)
        rows = mine.mapInArrow(_looked_up(shared), "r1 long, r2 long, what long, n long, known double, seen long")
        found = rows.join(table.hint("shuffle_hash"), "what", "left").groupBy("r1", "r2")
        found = found.agg(
            F.count_if(F.col("n") > 0).alias("copies"),
            F.sum("n").alias("n"),
            F.sum(F.col("seen") + F.coalesce("pair", F.lit(0))).alias("pairs"),
            F.sum(F.col("known") + F.coalesce("value", F.lit(0.0))).alias("value"),
        )
        sums.append(settle(found, "sums"))
    # rows that repeat key and text share their ids, and so their sums
    whole = reduce(DataFrame.unionByName, sums)
    n = F.expr("(n - copies) div copies")
    whole = whole.select("r1", "r2", n.alias("n"), F.expr("pairs div copies").alias("pairs"), (F.col("value") / F.col("copies")).alias("value"))
    return docs.select(*ids, F.col(key).alias("key")).join(whole, ["r1", "r2"]).select(
        F.col("key").alias(key),
        F.col("n").alias("n_words"),
        (F.col("n") - F.col("pairs")).alias("n_backed_off"),
        F.round(F.when(F.col("n") > 0, F.col("value") / F.col("n")), 6).alias("mean_log_score"),
    )
