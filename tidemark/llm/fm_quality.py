"""Document quality by a factorisation machine.

Inputs are the hashed words of a text (weights with unit norm), binned statistics of its structure,
and a metadata column. The machine adds a weight per input and, for every pair of inputs, the product
of two short vectors; with the sum-of-squares identity

    sum of <v_i, v_j> x_i x_j over i < j  =  half of (|sum v_i x_i|^2 - sum |v_i|^2 x_i^2)

a text is scored in time linear in its inputs. Fitting uses a bounded sample of labelled rows,
whose inputs (not texts) reach the driver; scoring runs in Arrow batches on the executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, kind_of
from tidemark.llm.labelled import labelled_sample

#: Labelled rows that the machine is fitted on, at most.
SAMPLE = 6_000
THRESHOLD = 0.7
WORD_SLOTS = 1 << 15
BINS = 12
FACTORS = 8
#: Batches seen in the fit, as many for a small sample as for a large one.
STEPS = 600
BATCH = 128
SYMBOLS = [b"#", b"$", b"%", b"&", b"*", b"|", b"!", b"<", b">", b"{", b"=", b"_", b".", b",", b"?", b":", b"@", b"-"]
UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
HIGH = bytes(range(128, 256))
#: log lengths, shares, symbol shares, and the metadata column last
STATISTICS = 12 + len(SYMBOLS) + 1
SLOTS = WORD_SLOTS + STATISTICS * BINS
_KNOWN_WORDS = 200_000


class _Slots(dict):
    """The slot of each word, with a bounded memory of what was worked out."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        slot = self[word] = crc32(word) % WORD_SLOTS
        return slot


def _share(part: float, whole: float) -> int:
    """A bin for a share from 0 to 1, finer near 0."""
    return min(BINS - 1, int(np.log2(1 + 2000 * part / whole))) if whole else 0


def _length(n: int) -> int:
    return min(BINS - 1, max(0, n).bit_length() * 2 // 3)


def inputs(data: bytes, n_chars: int | None, slots: dict) -> tuple[np.ndarray, np.ndarray]:
    """The slots and values of one text."""
    raw = data.split()
    low = data.lower().split()
    n, size = len(raw), len(data)
    lines = data.split(b"\n")
    full = [x for x in lines if x.strip()]
    bins = [
        _length(n),
        _length(len(full)),
        min(BINS - 1, n // max(1, len(full)) // 4),
        min(BINS - 1, int(size / n)) if n else 0,
        _share(n - len(set(low)), n),
        _share(len(full) - len(set(full)), len(full)),
        _share(size - len(data.translate(None, UPPER)), size),
        _share(size - len(data.translate(None, DIGITS)), size),
        _share(size - len(data.translate(None, HIGH)), size),
        _share(sum(len(w) == 1 for w in raw), n),
        _share(sum(len(w) > 20 for w in raw), n),
        _share(sum(w.isupper() for w in raw), n),
        *(_share(data.count(s), max(n, 1)) if s in data else 0 for s in SYMBOLS),
        BINS - 1 if n_chars is None else min(BINS - 2, _length(n_chars)),
    ]
    at = WORD_SLOTS + np.arange(STATISTICS) * BINS + np.minimum(bins, BINS - 1)
    if not n:
        return at, np.ones(STATISTICS, dtype=np.float32)
    words, counts = np.unique(np.fromiter(map(slots.__getitem__, low), np.int64, n), return_counts=True)
    values = np.sqrt(counts / n).astype(np.float32)
    return np.concatenate([words, at]), np.concatenate([values, np.ones(STATISTICS, dtype=np.float32)])


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def margins(self, slots: np.ndarray, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """One margin per text; a text's inputs lie from its start to the next."""
        x = values[:, None]
        vx = self.factors[slots] * x
        linear = np.add.reduceat(self.weights[slots] * values, starts)
        sums = np.add.reduceat(vx, starts, axis=0)
        squares = np.add.reduceat(vx * vx, starts, axis=0)
        return self.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1)


def probability(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, steps: int = STEPS, seed: int = 7) -> Machine:
    """Adaptive gradient descent on the log loss with a small decay. No rows: an even chance."""
    rng = np.random.default_rng(seed)
    prior = (labels.sum() + 1) / (len(labels) + 2)
    model = Machine(
        float(np.log(prior / (1 - prior))),
        np.zeros(SLOTS, dtype=np.float32),
        rng.normal(0, 0.02, (SLOTS, FACTORS)).astype(np.float32),
    )
    squared_w, squared_v, squared_b = np.full(SLOTS, 1e-2), np.full((SLOTS, FACTORS), 1e-2), 1e-2
    epochs = -(-steps // max(1, len(rows) // BATCH)) if 0 < labels.sum() < len(labels) else 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for batch in np.array_split(order, max(1, len(order) // BATCH)):
            sizes = [len(rows[i][0]) for i in batch]
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            slots = np.concatenate([rows[i][0] for i in batch])
            values = np.concatenate([rows[i][1] for i in batch])
            wrong = (probability(model.margins(slots, values, starts)) - labels[batch]) / len(batch)
            per = np.repeat(wrong, sizes)
            vx = model.factors[slots] * values[:, None]
            sums = np.repeat(np.add.reduceat(vx, starts, axis=0), sizes, axis=0)
            by = np.argsort(slots, kind="stable")
            used, first = np.unique(slots[by], return_index=True)
            grad_w = np.add.reduceat((per * values)[by], first) + 1e-5 * model.weights[used]
            grad_v = np.add.reduceat(((per * values)[:, None] * (sums - vx))[by], first, axis=0) + 1e-4 * model.factors[used]
            squared_w[used] += grad_w**2
            squared_v[used] += grad_v**2
            squared_b += wrong.sum() ** 2
            model.weights[used] -= 0.15 * grad_w / np.sqrt(squared_w[used])
            model.factors[used] -= 0.05 * grad_v / np.sqrt(squared_v[used])
            model.bias -= 0.05 * wrong.sum() / np.sqrt(squared_b)
    return model


def _input_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    slots = _Slots()
    for batch in batches:
        found = [inputs(t.encode(), n, slots) for t, n in zip(batch.column("text").to_pylist(), batch.column("n").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("key_text"),
                batch.column("label"),
                pa.array([a.astype("<i4").tobytes() for a, _ in found], pa.binary()),
                pa.array([v.astype("<f4").tobytes() for _, v in found], pa.binary()),
            ],
            names=["key_text", "label", "slots", "values"],
        )


def _metadata(docs: DataFrame, metadata: str | None):
    known = metadata is not None and metadata in docs.columns
    return (F.col(metadata).cast("long") if known else F.lit(None).cast("long")).alias("n")


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", metadata: str | None = "n_chars", bound: int = SAMPLE) -> Machine:
    """Fit on at most ``bound`` labelled rows outside the held-out fold."""
    sample = labelled_sample(docs, labels, bound, key, text, extra=(_metadata(docs, metadata),))
    rows = (
        sample.select("text", "n", F.col("key").cast("string").alias("key_text"), "label")
        .mapInArrow(_input_rows, "key_text string, label int, slots binary, values binary")
        .collect()
    )
    rows.sort(key=lambda r: r["key_text"])
    pairs = [(np.frombuffer(r["slots"], "<i4").astype(np.int64), np.frombuffer(r["values"], "<f4")) for r in rows]
    return fit(pairs, np.array([r["label"] for r in rows], dtype=np.float64))


def _scores(model: Machine, texts: pa.Array, sizes: pa.Array | None, slots: _Slots) -> np.ndarray:
    """The scores of a column of texts with their metadata, some hundred texts at a time."""
    out = [np.zeros(0)]
    for at in range(0, len(texts), 256):
        part = texts[at : at + 256]
        known = [None] * len(part) if sizes is None else [n.as_py() for n in sizes[at : at + 256]]
        found = [inputs(str(t.as_py() or "").encode(), n, slots) for t, n in zip(part, known, strict=True)]
        starts = np.concatenate([[0], np.cumsum([len(a) for a, _ in found])[:-1]])
        margins = model.margins(np.concatenate([a for a, _ in found]), np.concatenate([v for _, v in found]), starts)
        out.append(probability(margins.astype(np.float64)))
    return np.concatenate(out)


def score(docs: DataFrame, model: Machine, key: str = "doc_id", text: str = "text", metadata: str | None = "n_chars") -> DataFrame:
    """(key, score) for every row, whole texts.

    Scores depend on the text and the metadata column only. A null text counts as empty, an empty
    one gets the score of its statistics; null metadata have a bin of their own. Repeated rows get
    equal scores, other columns are ignored, an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = _Slots()
        for batch in batches:
            scores = _scores(model, batch.column(1), batch.column(2), slots)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["key", "score"])

    rows = docs.select(F.col(key), F.col(text).cast("string"), _metadata(docs, metadata))
    return rows.mapInArrow(run, f"key {kind_of(docs, key)}, score double").select(F.col("key").alias(key), "score")


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted) for every document."""
    scored = score(docs, train(docs, labels, key, text), key, text)
    return scored.select(
        key, held_out(F.col(key)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that the machine does not reject, columns unchanged."""
    model = train(docs, labels, key, text)
    schema = docs.schema
    place, meta = docs.columns.index(text), docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = _Slots()
        for batch in batches:
            keep = _scores(model, batch.column(place), None if meta is None else batch.column(meta), slots) >= THRESHOLD
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, schema)
