"""Best-fit packing of documents into sequences of a fixed length, improved by exchanges.

Every document is encoded and closed by an end token. One that is longer than a sequence is cut
into pieces of full length, of which the first may be shorter; a full piece is a sequence of its
own. So what is left to pack is at most one piece per document.

These pieces are dealt at random into groups of a bounded number. A group is packed best fit, the
longest first, and then searched: the least filled bin gives its pieces away, one or two at a
time, by a move into a gap or in exchange for one or two shorter pieces of a fuller bin. Every
step makes the sum of squared fills larger, so the search ends; a bin that has given all away is
gone. Once a group has no more bins than its tokens need, nothing is left to find.

What stays open in one group is a few bins, but there are many groups. So all bins that are not
full are dealt into new groups and searched once more, as whole bins, which can only do better.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tidemark.llm.common import kind_of, settle

CAPACITY = 1024
END = 2
#: Pieces that one task packs, on average.
GROUP = 8_192
_KNOWN = 1 << 19
_LONGEST_KNOWN = 40
_ROWS = 4_096
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Where the split of the tokenizer always has a border: around ASCII words and before spaces.
_CHUNK = re.compile(f" ?[A-Za-z]++(?![^\x00-\x7f])| ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
#: What the split leaves whole: there is nothing to look for before merging.
_WHOLE = re.compile(" ?[A-Za-z]+")
_FORMATS = [struct.Struct(f"<{n}I") for n in range(_LONGEST_KNOWN + 1)]
#: Letters, marks and digits up to here are told apart alike by both libraries.
_COMMON = re.compile("[\x00-\u024f]*")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of_letter() -> dict[str, int]:
    """The byte that each visible letter of a byte-level vocabulary stands for."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Ids as the library gives them, with the ids of frequent pieces remembered.

    A byte-level file without a normaliser is split where its own split has a border anyway, and
    the pieces are merged by ranks. Texts with strings of special tokens and files of any other
    kind go to the library whole.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = False
        with open(path, encoding="utf-8") as f:
            facts = json.load(f)
        self.special = [t["content"] for t in facts["added_tokens"]]
        self.ranks, self.merges = self._ranks(facts)
        self.known = lru_cache(_KNOWN)(self._merged)

    @staticmethod
    def _ranks(facts: dict) -> tuple[tiktoken.Encoding | None, tiktoken.Encoding | None]:
        """The merges behind the split of the file, and the same merges for texts that it leaves whole."""
        split, model = facts["pre_tokenizer"] or {}, facts["model"]
        plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
        rest = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
        if facts["normalizer"] or not plain or model["type"] != "BPE" or any(model.get(r) for r in rest):
            return None, None
        byte, special = _byte_of_letter(), {t["content"] for t in facts["added_tokens"]}
        ranks = {bytes(map(byte.__getitem__, t)): i for t, i in model["vocab"].items() if t not in special}
        made = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if made != sorted(made):  # ids are then no ranks
            return None, None
        import public_tokenizers

        made = [tiktoken.Encoding("pieces", pat_str=p, mergeable_ranks=ranks, special_tokens={}) for p in (public_tokenizers.PATTERN, "(?s).+")]
        return made[0], made[1]

    def _merged(self, chunk: str) -> bytes:
        if _WHOLE.fullmatch(chunk):
            ids = self.merges.encode_ordinary(chunk)
        elif _COMMON.fullmatch(chunk):
            ids = self.ranks.encode_ordinary(chunk)
        else:
            ids = self.library.encode(chunk, add_special_tokens=False).ids
        return _FORMATS[len(ids)].pack(*ids) if len(ids) < len(_FORMATS) else np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if self.ranks is None or any(s in text for s in self.special):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        known = self.known
        return b"".join([known(c) if len(c) <= _LONGEST_KNOWN else self._merged(c) for c in _CHUNK.findall(text)])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    return Encoder(path)


def pieces(
    docs: DataFrame,
    path: str | None = None,
    capacity: int = CAPACITY,
    end: int = END,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, piece, start, length, ids): every whole document, cut only where it is too long.

    ``ids`` is a binary column of little-endian unsigned 32-bit integers and ``start`` the number
    of ids of the document before the piece. A null or empty text is its end token alone. Repeated
    keys and null keys are documents of their own; other columns are ignored.
    """
    where = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(where)
        closing = np.array([end], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            for i, value in enumerate(batch.column(1)):
                ids = words.encode(value.as_py() or "") + closing
                n = len(ids) // 4
                cuts = [0, *range(n % capacity or min(n, capacity), n + 1, capacity)]
                for at, (low, high) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((i, at, low, high - low, ids[4 * low : 4 * high]))
                    if len(rows) == _ROWS:
                        yield made(batch, rows)
                        rows = []
            if rows:
                yield made(batch, rows)

    def made(batch: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
        of, at, low, length, ids = zip(*rows)
        columns = [batch.column(0).take(pa.array(of)), pa.array(at, pa.int32()), pa.array(low, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["key", "piece", "start", "length", "ids"])

    found = docs.select(F.col(key), F.col(text).cast("string")).mapInArrow(
        run, f"key {kind_of(docs, key)}, piece int, start long, length long, ids binary"
    )
    return found.withColumnRenamed("key", key)


# -- packing of one group -----------------------------------------------------


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Places of the pieces in each bin: the longest first, each where the least room is left."""
    bins: list[list[int]] = []
    room: dict[int, list[int]] = {}
    present = 0
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        length = lengths[i]
        fits = present >> length
        if fits:
            left = length + (fits & -fits).bit_length() - 1
            at = room[left].pop()
            if not room[left]:
                present &= ~(1 << left)
        else:
            left, at = capacity, len(bins)
            bins.append([])
        bins[at].append(i)
        left -= length
        if left:
            room.setdefault(left, []).append(at)
            present |= 1 << left
    return bins


class _Bin:
    """Pieces by length; bit n of ``ones`` is set for a piece of length n, of ``twos`` for a pair."""

    def __init__(self, members: list[int], lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.by: dict[int, list[int]] = {}
        for i in members:
            self.by.setdefault(lengths[i], []).append(i)
        self.count()

    def count(self) -> None:
        self.fill = sum(n * len(m) for n, m in self.by.items())
        self.gap = self.capacity - self.fill
        self.ones = sum(1 << n for n in self.by)
        self.twos = 0
        for n, members in self.by.items():
            others = self.ones if len(members) > 1 else self.ones & ~(1 << n)
            self.twos |= others << n

    def pair(self, total: int) -> list[int]:
        """Two lengths with that sum."""
        for n in sorted(self.by):
            rest = total - n
            if rest in self.by and (rest != n or len(self.by[n]) > 1):
                return [n, rest]
        raise ValueError(total)

    def swap(self, out: list[int], into: _Bin, back: list[int]) -> None:
        """Give pieces of these lengths to another bin and take others back."""
        for giver, taker, what in ((self, into, out), (into, self, back)):
            for n in what:
                piece = giver.by[n].pop()
                if not giver.by[n]:
                    del giver.by[n]
                taker.by.setdefault(n, []).append(piece)
        self.count()
        into.count()


class _Open:
    """Bins with a gap, by their gap, with the lengths that the bins of one gap have to offer."""

    def __init__(self, bins: list[_Bin]):
        self.bins: dict[int, list[_Bin]] = {}
        self.offers: dict[int, tuple[int, int]] = {}
        for b in bins:
            self.add(b)

    def add(self, b: _Bin) -> None:
        if b.gap:
            self.bins.setdefault(b.gap, []).append(b)
            self.offers.pop(b.gap, None)

    def remove(self, b: _Bin) -> None:
        if b.gap:
            self.bins[b.gap].remove(b)
            self.offers.pop(b.gap, None)
            if not self.bins[b.gap]:
                del self.bins[b.gap]

    def offered(self, gap: int) -> tuple[int, int]:
        if gap not in self.offers:
            ones = twos = 0
            for b in self.bins[gap]:
                ones, twos = ones | b.ones, twos | b.twos
            self.offers[gap] = ones, twos
        return self.offers[gap]

    def best(self, donor: _Bin) -> tuple[int, list[int], int, int, int] | None:
        """The step that takes most from the donor: (less, out, gap of the taker, back, kind)."""
        found = None
        outs = [[n] for n in donor.by]
        outs += [[m, n] for m in donor.by for n in donor.by if m < n or (m == n and len(donor.by[n]) > 1)]
        for gap in self.bins:
            ones, twos = self.offered(gap)
            for out in outs:
                given = sum(out)
                if given <= gap:
                    less, back, kind = given, 0, 0
                else:
                    # lengths from given - gap to given - 1 make room and are still shorter
                    low, within = given - gap, (1 << gap) - 1
                    one, two = ones >> low & within, twos >> low & within
                    if len(out) > 1 or not two:
                        two = 0
                    if not one and not two:
                        continue
                    first, second = (one & -one).bit_length() - 1 if one else gap, (two & -two).bit_length() - 1 if two else gap
                    back, kind = (low + first, 1) if first <= second else (low + second, 2)
                    less = given - back
                if found is None or (less, -gap) > (found[0], -found[2]):
                    found = less, out, gap, back, kind
        return found

    def taker(self, gap: int, back: int, kind: int) -> _Bin:
        return next(b for b in self.bins[gap] if kind == 0 or (b.ones if kind == 1 else b.twos) >> back & 1)


def exchange(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """The bins after moves and exchanges that make the sum of squared fills larger.

    In a pass every open bin is once the donor, the least filled first, and the takers are those
    that are fuller. Passes go on while one changes something and the tokens could do with fewer bins.
    """
    need = -(-sum(lengths) // capacity)
    held = [_Bin(b, lengths, capacity) for b in bins if b]
    changed = True
    while changed and len(held) > need:
        changed = False
        open_bins = _Open(held)
        for donor in sorted((b for b in held if b.gap), key=lambda b: b.fill):
            if not donor.gap:
                continue  # filled up meanwhile
            open_bins.remove(donor)
            while donor.by and (step := open_bins.best(donor)):
                _, out, gap, back, kind = step
                into = open_bins.taker(gap, back, kind)
                open_bins.remove(into)
                donor.swap(out, into, [] if kind == 0 else [back] if kind == 1 else into.pair(back))
                open_bins.add(into)
                changed = True
        held = [b for b in held if b.by]
    return [[i for n in sorted(b.by, reverse=True) for i in b.by[n]] for b in held]


# -- packing of a table -------------------------------------------------------


def _packer(capacity: int, start: bool, group: str):
    """Packs the rows of one group; with ``start`` off from the bins they are in."""

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("_rid")
        lengths = table.column("length").to_pylist()
        if start:
            bins = best_fit(lengths, capacity)
        else:
            known: dict[int, list[int]] = {}
            for i, b in enumerate(table.column("sequence_id").to_pylist()):
                known.setdefault(b, []).append(i)
            bins = list(known.values())
        bins = exchange(bins, lengths, capacity)
        sequence, offset, fill = (np.zeros(len(lengths), np.int64) for _ in range(3))
        rids = table.column("_rid").to_numpy()
        for members in bins:
            ends = np.cumsum([lengths[i] for i in members])
            sequence[members], fill[members] = rids[members].min(), ends[-1]
            offset[members[1:]] = ends[:-1]
        out = table.drop_columns([group, *(c for c in ("sequence_id", "offset", "_fill") if c in table.column_names)])
        for name, values in (("sequence_id", sequence), ("offset", offset), ("_fill", fill)):
            out = out.append_column(name, pa.array(values))
        return out

    return pack


def _packed(rows: DataFrame, by: str, n_groups: int, capacity: int, start: bool) -> DataFrame:
    kept = [f for f in rows.schema.fields if f.name not in ("sequence_id", "offset", "_fill")]
    schema = T.StructType([*kept, *(T.StructField(n, T.LongType()) for n in ("sequence_id", "offset", "_fill"))])
    dealt = rows.withColumn("_group", F.pmod(F.xxhash64(by), F.lit(n_groups)))
    return dealt.groupBy("_group").applyInArrow(_packer(capacity, start, "_group"), schema)


def place(cut: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """The rows of ``pieces`` with ``sequence_id`` and ``offset``, in as few sequences as it can.

    Columns besides ``length`` are passed through; leave ``ids`` out if only places are asked for,
    as what is here goes through a shuffle. A sequence id is the smallest number of its pieces. No
    piece may be longer than ``capacity`` or have no length. An empty table gives an empty result.
    """
    rows = settle(cut.withColumn("_rid", F.monotonically_increasing_id()), "pieces")
    short = rows.where(F.col("length") < capacity)
    full = rows.where(F.col("length") == capacity).withColumns({"sequence_id": F.col("_rid"), "offset": F.lit(0).cast("long")})
    n_groups = max(1, -(-short.count() // group))
    first = settle(_packed(short, "_rid", n_groups, capacity, True), "packed")
    if n_groups > 1:
        left = first.where(F.col("_fill") < capacity)
        again = _packed(left, "sequence_id", max(1, -(-left.count() // group)), capacity, False)
        first = first.where(F.col("_fill") == capacity).unionByName(again)
    return full.unionByName(first.drop("_fill")).drop("_rid")


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the packed sequences themselves, from placed pieces with ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(F.transform(parts, lambda p: p["ids"]), F.lit(b""), lambda a, b: F.concat(a, b))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset) of all pieces of all documents."""
    cut = pieces(docs, path, capacity, key=key, text=text)
    return place(cut.select(key, "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), capacity)
