"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

For every prefix of a word there is exactly one token that its encoding ends with. An automaton
with suffix links lists the tokens that end at each place of a word. Such a token is the last one
of that prefix if it is compatible with the last token of what stands before it: if merging would
never cross the border between the two. So each place stores one token, and following the stored
tokens back from the end gives the ids that merging would give, in time linear in the word.

Two tokens are compatible unless, while both are being put together from their parts, the part at
the right edge of the first and the part at the left edge of the second can merge before either
is used up. Parts merge in the order of their ranks and at equal ranks from left to right.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import kind_of

#: Stands for the end of a word inside the automaton.
END = "￿"
NEVER = 1 << 60
_KNOWN = 200_000
_KNOWN_CHUNKS = 600_000
_LONGEST_KNOWN = 64
_ROWS = 256
_FORMATS = [struct.Struct(f"<{n}I") for n in range(_LONGEST_KNOWN + 2)]
_SEPARATORS = re.compile("[\x1c-\x1f]")
_LATIN = re.compile("[\x00-\xff]*")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """The visible letter that stands for each byte: itself where it has one."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {**{b: chr(b) for b in visible}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


def _packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return _FORMATS[len(ids)].pack(*ids) if len(ids) < len(_FORMATS) else struct.pack(f"<{len(ids)}I", *ids)


class _Memory(dict):
    """What a function gave for a bounded number of keys, the recently used ones among them.

    When it is full it becomes the older half; keys used again move to the younger one. Long
    strings are not kept.
    """

    def __init__(self, work, known: int = _KNOWN):
        super().__init__()
        self.work, self.known, self.older = work, known, {}

    def __missing__(self, key):
        found = self.older.get(key)
        if found is None:
            found = self.work(key)
            if isinstance(key, str) and len(key) > _LONGEST_KNOWN:
                return found
        if len(self) >= self.known:
            self.older = dict(self)
            self.clear()
        self[key] = found
        return found


class Vocabulary:
    """The tokens of one file, the automaton over them, and the compatibility of pairs."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.mark = model.get("end_of_word_suffix") or ""
        ids: dict[str, int] = model["vocab"]
        self.library = Tokenizer.from_file(path)
        special = self.library.get_added_tokens_decoder()
        self.special = {t.content: i for i, t in special.items()}
        self.token_of = {i: t for t, i in ids.items()} | {i: t.content for i, t in special.items()}
        self.tokens = [self.token_of.get(i) for i in range(max(self.token_of) + 1)]
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank_of: dict[int, int] = {}
        self.pairs: dict[tuple[int, int], int] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            whole = ids[left + right]
            self.pairs[ids[left], ids[right]] = rank
            self.parts[whole], self.rank_of[whole] = (ids[left], ids[right]), rank
        self.whole = {}
        self.automaton = ahocorasick.Automaton()
        for token, i in ids.items():
            if token not in self.special and self.reachable(i):
                shape = token[: -len(self.mark)] + END if self.mark and token.endswith(self.mark) else token
                self.whole[shape] = i
                self.automaton.add_word(shape, (len(shape), i))
        self.automaton.make_automaton()
        self.edges: tuple[dict, dict] = {}, {}
        self.tested = _Memory(lambda pair: self.compatible(pair >> 20, pair & (1 << 20) - 1))
        self.words = _Memory(self.encode_word)
        self.chunks = _Memory(self.encode_chunk, _KNOWN_CHUNKS)
        self.letters = _byte_letters()
        self.by_byte = {b: letter for b, letter in self.letters.items() if letter != chr(b)}
        # letters and numbers up to U+00FF, where nothing has to be composed
        self.plain = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|[^\t-\r \x85\xa0a-z0-9ªµºß-öø-ÿ²³¹¼-¾]+")
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def _edge(self, token: int, side: int, used_up: int) -> list[tuple[int, int]]:
        """(part, rank at which it is used up) along the left (0) or right (1) edge of a token."""
        out = [(token, used_up)]
        while token in self.parts:
            out.append((self.parts[token][side], self.rank_of[token]))
            token = self.parts[token][side]
        return out

    def _crossed(self, first: int, second: int, until: int) -> bool:
        """Whether parts of both merge over the border, before a merge of rank ``until``."""
        for x, x_gone in self._edge(first, 1, until):
            for y, y_gone in self._edge(second, 0, until):
                rank = self.pairs.get((x, y))
                if rank is not None and rank < x_gone and rank <= y_gone and (rank != until):
                    return True
        return False

    def reachable(self, token: int) -> bool:
        """Whether merging the letters of a token ends with that token."""
        if token not in self.parts:
            return True
        left, right = self.parts[token]
        return not self._crossed(left, right, self.rank_of[token]) and self.reachable(left) and self.reachable(right)

    def _whole_edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The edge of a token that is never used up."""
        edge = self.edges[side].get(token)
        if edge is None:
            edge = self.edges[side][token] = self._edge(token, side, NEVER)
        return edge

    def compatible(self, first: int, second: int) -> bool:
        """Whether merging never crosses the border between two tokens."""
        pairs, right = self.pairs, self._whole_edge(second, 0)
        for x, x_gone in self._whole_edge(first, 1):
            for y, y_gone in right:
                rank = pairs.get((x, y))
                if rank is not None and rank < x_gone and rank <= y_gone:
                    return False
        return True

    def encode_word(self, word: str) -> bytes:
        """Packed ids of one word, given in byte letters."""
        shape = word + END if self.mark else word
        whole = self.whole.get(shape)
        if whole is not None:
            return _packed([whole])
        # the last token of each prefix, or -1, and where it starts
        last, back = [-1] * (len(shape) + 1), [0] * (len(shape) + 1)
        tested = self.tested
        for at, (length, token) in self.automaton.iter(shape):
            at += 1
            if last[at] < 0:
                start = at - length
                if start:
                    before = last[start]
                    if before < 0 or not tested[before << 20 | token]:
                        continue
                last[at], back[at] = token, start
        out, at = [], len(shape)
        while at:
            out.append(last[at])
            at = back[at]
        out.reverse()
        return _packed(out)

    def _encode_piece(self, piece: str) -> bytes:
        """Packed ids of a piece without special tokens."""
        if piece.isascii():
            lowered = piece.lower()
            words = [lowered] if lowered.isalpha() else self.plain.findall(lowered)
            if not piece.isprintable():
                words = ["".join(self.letters[b] for b in w.encode()) for w in words]
        elif _LATIN.fullmatch(piece):
            words = [w.encode().decode("latin-1").translate(self.by_byte) for w in self.plain.findall(piece.lower())]
        else:
            normal = self.library.normalizer.normalize_str(piece)
            words = [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]
        return b"".join([self.words[w] if len(w) <= _LONGEST_KNOWN else self.encode_word(w) for w in words])

    def encode_chunk(self, chunk: str) -> bytes:
        """Packed ids of a stretch of text; strings of special tokens become those tokens."""
        if not self.specials or "<" not in chunk:
            return self._encode_piece(chunk)
        pieces = self.specials.split(chunk)
        return b"".join([_packed([self.special[p]]) if p in self.special else self._encode_piece(p) for p in pieces])

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers.

        White space always ends a word, so what stands between it is encoded once and remembered.
        The separators U+001C to U+001F end words in one library only; texts with them go whole.
        """
        if _SEPARATORS.search(text):
            return self.encode_chunk(text)
        return b"".join(map(self.chunks.__getitem__, text.split()))

    def decode(self, packed: bytes) -> str:
        """The tokens of the ids with a space between them: the file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One per worker process and file."""
    return Vocabulary(path)


def round_trip(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, decoded) of every row, whole texts.

    ``ids`` is a binary column of little-endian unsigned 32-bit integers, ``decoded`` the text that
    those ids decode to. Null and empty texts have no ids and decode to an empty text. Repeated
    rows get a row each, other columns are ignored, an empty table gives an empty result.
    """
    where = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(where)
        for batch in batches:
            for at in range(0, len(batch), _ROWS):
                part = batch.slice(at, _ROWS)
                ids = [words.encode(t.as_py() or "") for t in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.binary()), pa.array(map(words.decode, ids), pa.string())],
                    names=["key", "ids", "decoded"],
                )

    found = docs.select(F.col(key), F.col(text).cast("string")).mapInArrow(
        run, f"key {kind_of(docs, key)}, ids binary, decoded string"
    )
    return found.withColumnRenamed("key", key)


def digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of the rows of ``round_trip``."""
    return found.select(
        key,
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
