"""Spelling variants: words that differ by one inserted, deleted or replaced letter, grouped.

Two words are one edit apart if the prefix and the suffix they share reach, together, the length
of the longer word less one. That is read off dense tiles: the words of two blocks as matrices of
code points, padded to one width, compared column by column from the front and from the back.

Which blocks meet follows from the same fact. Of a word of m letters, one edit leaves either the
first m div 2 or the other letters alone. So words of m and of m + 1 letters meet in a bucket
for each half that they share; a pair that shares both halves counts in the bucket of the first.
A bucket of many words is cut into blocks, and each pair of blocks is a tile of its own, so none
is met by one task whole. Tiles never give out pairs, only, for each word, how many words are near
it and which is the most frequent of them.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import settle

#: Words of a block, on average.
TILE = 512
LEAST_LENGTH, LEAST_COUNT = 5, 3
SLIP = 97
_HELD = 200_000
#: A-Z in lower case, a-z and U+00C0 to U+00FF as they are; all else ends a word.
_LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """The words of a whole text, one byte for each code point."""
    return (text or "").encode("latin-1", "replace").translate(_LETTERS).split()


def slipped(word: bytes, seed: int, slip: int) -> bytes:
    """The word as one document writes it: where its hash says so, one letter is left out."""
    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), seed)
    if h % slip:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    slip: int | None = None,
) -> DataFrame:
    """(word, n): words of enough letters that occur often enough over all documents.

    With ``slip``, of the words of a document each whose hash with the document's key it divides
    loses one letter before it is counted. Every task adds up its own words before the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for name, value in zip(batch.column(0), batch.column(1)):
                # a slip only shortens a word
                words = [w for w in words_of(value.as_py()) if len(w) >= least_length]
                if slip is None:
                    held.update(words)
                    continue
                seed = zlib.crc32(f"{name.as_py() or ''}:".encode())
                for word, n in Counter(words).items():
                    word = slipped(word, seed, slip)
                    if len(word) >= least_length:
                        held[word] += n
                if len(held) >= _HELD:
                    yield given(held)
                    held.clear()
        if held:
            yield given(held)

    def given(held: Counter) -> pa.RecordBatch:
        words = [w.decode("latin-1") for w in held]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

    rows = docs.select(F.col(key).cast("string"), F.col(text).cast("string"))
    counted = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_count)


# -- tiles --------------------------------------------------------------------


def _matrix(words: list[str], width: int) -> np.ndarray:
    """Code points of words, a row each, padded with zeros; in bytes where they fit."""
    points = np.array(words, f"U{width}").view(np.uint32).reshape(len(words), width)
    return points.astype(np.uint8) if points.max() < 256 else points


def _shared(a: np.ndarray, b: np.ndarray, la: int, lb: int, known: int, back: bool) -> np.ndarray:
    """Length of the common prefix, or suffix, of all pairs; the first ``known`` are equal."""
    n = np.full((len(a), len(b)), known, np.uint32 if la > 60_000 else np.uint16)
    live = np.ones((len(a), len(b)), bool)
    for j in range(known, la):
        x, y = (a[:, la - 1 - j], b[:, lb - 1 - j]) if back else (a[:, j], b[:, j])
        live &= x[:, None] == y[None, :]
        if not live.any():
            break
        n += live
    return n


def near_pairs(a: list[str], b: list[str], m: int, suffix: bool) -> np.ndarray:
    """Which words of ``a``, all of m letters, are one edit from which of ``b``, of m or m + 1.

    All share their first half, or with ``suffix`` their second; pairs that share both halves are
    then left to the first.
    """
    width = len(b[0])
    half = m // 2
    left, right = _matrix(a, m), _matrix(b, width)
    front = _shared(left, right, m, width, 0 if suffix else half, False)
    rear = _shared(left, right, m, width, m - half if suffix else 0, True)
    near = front + rear >= width - 1
    if width == m:
        near &= front < m
    return near & (front < half) if suffix else near


class _Found:
    """For each word how many near ones were seen, and the first of them by count and letters."""

    def __init__(self):
        self.near: dict[str, list] = {}

    def add(self, words: list[str], others: list[tuple], near: np.ndarray) -> None:
        """``others`` are in the order in which they are preferred."""
        counts, first = near.sum(axis=1), near.argmax(axis=1)
        for i in np.flatnonzero(counts).tolist():
            n, word = others[first[i]]
            seen = self.near.setdefault(words[i], [0, 0, ""])
            seen[0] += int(counts[i])
            if not seen[1] or (-n, word) < (-seen[1], seen[2]):
                seen[1:] = n, word

    def batch(self) -> pa.RecordBatch:
        rows = [(w, *x) for w, x in self.near.items()]
        word, near, n, best = zip(*rows) if rows else ((), (), (), ())
        return pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(near, pa.int64()), pa.array(n, pa.int64()), pa.array(best, pa.string())], names=["word", "n_near", "best_n", "best"])


def compare_tile(m: int, suffix: bool, members: list[tuple], i: int, j: int, found: _Found) -> None:
    """All near pairs between blocks i and j of one bucket; (word, n, block) are its members."""

    def listed(length: int, block: int) -> list[tuple]:
        return sorted(((n, w) for w, n, of in members if of == block and len(w) == length), key=lambda x: (-x[0], x[1]))

    short, long = {b: listed(m, b) for b in {i, j}}, {b: listed(m + 1, b) for b in {i, j}}
    # a row's tile may not grow with the length of its words
    step = max(1, min(TILE, (1 << 22) // (m + 1)))

    def meet(a: list[tuple], b: list[tuple], both: bool) -> None:
        for x in range(0, len(a), step):
            for y in range(0, len(b), step):
                left, right = a[x : x + step], b[y : y + step]
                near = near_pairs([w for _, w in left], [w for _, w in right], m, suffix)
                found.add([w for _, w in left], right, near)
                if both:
                    found.add([w for _, w in right], left, near.T)

    if i == j:
        meet(short[i], short[i], False)
        meet(short[i], long[i], True)
    else:
        meet(short[i], short[j], True)
        meet(short[i], long[j], True)
        meet(short[j], long[i], True)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = _Found()
        halves, lengths, firsts, seconds, lists = (batch.column(c) for c in range(5))
        ends, rows = lists.offsets.to_numpy(), lists.values
        words, counts, blocks = (rows.field(c).to_pylist() for c in range(3))
        for at, (m, suffix, i, j) in enumerate(zip(lengths.to_pylist(), halves.to_pylist(), firsts.to_pylist(), seconds.to_pylist())):
            s, e = ends[at], ends[at + 1]
            compare_tile(m, suffix, list(zip(words[s:e], counts[s:e], blocks[s:e])), i, j, found)
        yield found.batch()


def _buckets(words: DataFrame, least_length: int) -> DataFrame:
    """(m, suffix, half, word, n): every word in the buckets of its halves."""
    long = F.length("word")
    met = words.select("word", "n", F.explode(F.array(long, long - 1)).alias("m")).where(F.col("m") >= least_length)
    half = F.floor(F.col("m") / 2).cast("int")
    sides = F.array(
        F.struct(F.lit(False).alias("suffix"), F.expr("substring(word, 1, m div 2)").alias("half")),
        F.struct(F.lit(True).alias("suffix"), F.expr("right(word, m - m div 2)").alias("half")),
    )
    return met.withColumn("_at", half).select("word", "n", "m", F.inline(sides))


def near_words(words: DataFrame, least_length: int = LEAST_LENGTH, tile: int = TILE) -> DataFrame:
    """(word, n_near, best_n, best) of the words that have any near word.

    ``words`` has one row for each different word, of ``least_length`` letters at least.
    """
    met = _buckets(words, least_length)
    by = ["m", "suffix", "half"]
    # a bucket of one length's words only, or of one word, holds no pair
    sizes = met.groupBy(*by).agg(F.count("*").alias("size"), F.count_if(F.length("word") == F.col("m")).alias("short"))
    large = settle(sizes.where((F.col("size") > tile) & (F.col("short") > 0)), "large-buckets")
    many = F.greatest(F.lit(1), F.ceil(F.col("size") / tile)).cast("int")
    cut = met.join(large.select(*by, many.alias("blocks")), by, "left").fillna(1, ["blocks"])
    cut = cut.withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tiles = cut.withColumn("other", other).groupBy(
        *by, F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second")
    )
    member = F.struct(F.col("word"), F.col("n"), F.col("block"))
    filled = tiles.agg(F.collect_list(member).alias("members"), F.count_if(F.length("word") == F.col("m")).alias("short"))
    filled = filled.where((F.size("members") > 1) & (F.col("short") > 0)).select("suffix", "m", "first", "second", "members")
    found = filled.mapInArrow(_compare, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_best")).select(
        "word", "n_near", (-F.col("_best.less")).alias("best_n"), F.col("_best.word").alias("best")
    )


def _roots(steps: DataFrame) -> DataFrame:
    """(word, root): where following the forms ends. A form is more frequent than its word, so
    chains are short, and each round doubles how far a word looks."""
    reached = settle(steps.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = settle(reached.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots")
        if not moved.where("_moved").limit(1).count():
            return moved.select("word", "root")
        reached = moved.select("word", "root")


def variants(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    times: int = 2,
    slip: int | None = None,
    tile: int = TILE,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word.

    The form of a word is the most frequent word one edit away, of equally frequent ones the first
    in code-point order, if it is at least ``times`` as frequent; the root is where the forms end.
    Null and empty texts have no words and a null key is an empty one. Repeated rows are counted
    each; other columns are ignored. An empty table gives an empty result.
    """
    words = settle(word_counts(docs, key, text, least_length, least_count, slip), "words")
    near = near_words(words, least_length, tile)
    given = F.col("best_n") >= times * F.col("n")
    named = settle(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(given, F.col("best")).alias("form"), F.when(given, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(named.where("form IS NOT NULL").select("word", "form"))
    return named.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
