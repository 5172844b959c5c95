"""Quality rules: fixed rules on counts, then a calibrated logistic regression on hashed n-grams.

The regression reads the words, the word pairs and the character triples of a text, hashed, each
kind weighted by the root of its share in the text. It is fitted on a bounded sample of labelled
rows; a fifth of that sample is left out of the fit and calibrates the margin to a probability by
a logistic curve. Texts are scored in Arrow batches against fixed thresholds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import kind_of
from tidemark.llm.fm_quality import probability
from tidemark.llm.labelled import labelled_sample

#: Labelled rows that the regression is fitted and calibrated on, at most.
SAMPLE = 4_000
KEEP = 0.5
MIN_WORDS = 50
MAX_REPEATED = 50
SLOTS = 1 << 16
#: Batches seen in the fit, as many for a small sample as for a large one.
STEPS = 600
BATCH = 64
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
_KNOWN_WORDS = 200_000


class _Codes(dict):
    """A 32-bit code of each word, with a bounded memory."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        code = self[word] = crc32(word)
        return code


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of three words that the text has twice or more, the first included."""
    n = len(words) - 2
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], dtype=np.int64)
    kinds = len(seen)
    pairs = ids[:-1] * kinds + ids[1:]
    if kinds >= 1 << 21:  # three ids no longer fit one number: number the pairs first
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * kinds + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = np.flatnonzero(windows[order][1:] == windows[order][:-1])
    hit = np.zeros(len(words), dtype=bool)
    for starts in (order[same], order[same + 1]):
        for k in range(3):
            hit[starts + k] = True
    return int(hit.sum())


def base_counts(data: bytes, words: list[bytes]) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words of a text in UTF-8."""
    inside = data.translate(None, SPACES)
    chars = int(np.count_nonzero((np.frombuffer(inside, np.uint8) & 0xC0) != 0x80))
    lines = [x for x in data.split(b"\n") if x.translate(None, SPACES)] if b"\n" in data else []
    return chars, len(data) - len(data.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


def _kind(hashes: np.ndarray, offset: int) -> tuple[np.ndarray, np.ndarray]:
    ordered = np.sort(hashes.astype(np.uint16), kind="stable")
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    counts = np.diff(np.append(first, len(ordered)))
    return ordered[first].astype(np.int32) + offset, np.sqrt(counts / len(ordered)).astype(np.float32)


def inputs(text: str, words: list[bytes], codes: dict) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a text: its words, word pairs and character triples."""
    parts = []
    if words:
        ids = np.fromiter(map(codes.__getitem__, words), np.uint32, len(words))
        parts.append(_kind(ids >> 16, 0))
        if len(words) > 1:
            parts.append(_kind((ids[:-1] * np.uint32(2654435761) ^ ids[1:] * np.uint32(2246822519)) >> 16, SLOTS))
    if len(text) > 2:
        c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        mixed = (c[:-2] * np.uint32(2654435761)) ^ (c[1:-1] * np.uint32(2246822519)) ^ (c[2:] * np.uint32(3266489917))
        parts.append(_kind((mixed ^ (mixed >> 13)) * np.uint32(668265263) >> 16, 2 * SLOTS))
    if not parts:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    return np.concatenate([a for a, _ in parts]), np.concatenate([v for _, v in parts])


@dataclass
class Rules:
    weights: np.ndarray
    slope: float
    shift: float

    def score(self, slots: np.ndarray, values: np.ndarray) -> float:
        margin = float(self.weights[slots] @ values) if len(slots) else 0.0
        return float(probability(np.float64(self.slope * margin + self.shift)))


def _calibrate(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve, with targets drawn in from 0 and 1 (Platt)."""
    ones, zeros = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    slope, shift = 1.0, float(np.log((ones + 1) / (zeros + 1)))
    for _ in range(100):
        p = probability(slope * margins + shift)
        w = np.maximum(p * (1 - p), 1e-9)
        step = np.linalg.solve(
            [[(w * margins * margins).sum() + 1e-3, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-3]],
            [((p - target) * margins).sum(), (p - target).sum()],
        )
        slope, shift = slope - float(np.clip(step[0], -1, 1)), shift - float(np.clip(step[1], -1, 1))
    return max(slope, 0.0), shift


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, steps: int = STEPS, seed: int = 11) -> Rules:
    """Fit and calibrate. Without both labels every text has the same score, the labels' share."""
    weights = np.zeros(3 * SLOTS)
    if not 0 < labels.sum() < len(labels):
        return Rules(weights, 1.0, float(np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    kept, learned = order[::5], np.delete(order, np.arange(0, len(order), 5))
    squares = np.full(len(weights), 1e-3)
    shift = 0.0
    for _ in range(-(-steps // max(1, len(learned) // BATCH))):
        for batch in np.array_split(rng.permutation(learned), max(1, len(learned) // BATCH)):
            sizes = [len(rows[i][0]) for i in batch]
            text = np.repeat(np.arange(len(batch)), sizes)
            slots = np.concatenate([rows[i][0] for i in batch])
            values = np.concatenate([rows[i][1] for i in batch])
            margins = np.bincount(text, weights[slots] * values, len(batch)) + shift
            wrong = (probability(margins) - labels[batch]) / max(1, len(batch))
            slope = np.bincount(slots, values * wrong[text], len(weights)) + 1e-6 * weights
            squares += slope * slope
            weights -= 0.3 * slope / np.sqrt(squares)
            shift -= 0.1 * wrong.sum()
    margins = np.array([weights[rows[i][0]] @ rows[i][1] if len(rows[i][0]) else 0.0 for i in kept])
    return Rules(weights.astype(np.float32), *_calibrate(margins, labels[kept]))


def _input_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codes = _Codes()
    for batch in batches:
        found = [inputs(t, t.encode().split(), codes) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("key_text"),
                batch.column("label"),
                pa.array([a.astype("<i4").tobytes() for a, _ in found], pa.binary()),
                pa.array([v.astype("<f4").tobytes() for _, v in found], pa.binary()),
            ],
            names=["key_text", "label", "slots", "values"],
        )


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", bound: int = SAMPLE) -> Rules:
    sample = labelled_sample(docs, labels, bound, key, text)
    rows = (
        sample.select("text", F.col("key").cast("string").alias("key_text"), "label")
        .mapInArrow(_input_rows, "key_text string, label int, slots binary, values binary")
        .collect()
    )
    rows.sort(key=lambda r: r["key_text"])
    pairs = [(np.frombuffer(r["slots"], "<i4"), np.frombuffer(r["values"], "<f4")) for r in rows]
    return fit(pairs, np.array([r["label"] for r in rows], dtype=np.float64))


def judge(docs: DataFrame, rules: Rules, key: str = "doc_id", text: str = "text", keep: float = KEEP) -> DataFrame:
    """Counts, the rules' verdict and the score of every row, whole texts.

    A null text has no words. Texts that fail the fixed rules are not kept whatever their score;
    the others are kept from a score of ``keep`` on. Repeated rows get equal rows, other columns
    are ignored, an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _Codes()
        for batch in batches:
            out = []
            for cell in batch.column(1):
                body = cell.as_py() or ""
                data = body.encode()
                words = data.split()
                counts = base_counts(data, words)
                failed = len(words) < MIN_WORDS or 100 * counts[3] > MAX_REPEATED * len(words)
                score = rules.score(*inputs(body, words, codes))
                out.append((len(words), *counts, failed, not failed and score >= keep, score))
            columns = list(zip(*out, strict=True)) if out else [()] * 8
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["key", *_NAMES],
            )

    schema = f"key {kind_of(docs, key)}, {', '.join(f'{n} long' for n in _NAMES[:5])}, base_failed boolean, kept boolean, score double"
    return docs.select(F.col(key), F.col(text).cast("string")).mapInArrow(run, schema).withColumnRenamed("key", key)


_NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"]
