"""Text quality by a support vector machine on n-gram indicators scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm._labels import logistic, probability, remainder, training_texts
from tessera.llm._words import constants, mix, texts_of
from tessera.llm._work import Workspace, release, releasing

_U = np.uint64
#: Each kind of n-gram has this many hashed features.
BINS = 1 << 16
KINDS = 2
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Kinds of bytes that tell token shapes apart: small and capital letters, digits, letters beyond ASCII, each common mark.
_CLASS = np.full(256, 4, dtype=np.int64)
_CLASS[0x61:0x7B], _CLASS[0x41:0x5B], _CLASS[0x30:0x3A], _CLASS[0x80:] = 0, 1, 2, 3
for _i, _c in enumerate(b".,!|?:;-"):
    _CLASS[_c] = 5 + _i


def ngrams(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each kind of n-gram, (feature of each occurrence, occurrences per text): runs of three bytes, and of one to
    three token shapes. A shape is the classes of a token's first, second and last byte, whether it is one byte long,
    and whether it repeats the token before it."""
    byte = data.astype(np.int64)
    three = (byte[:-2] | (byte[1:-1] << 8) | (byte[2:] << 16)).astype(_U) if len(data) > 2 else np.empty(0, dtype=_U)
    three = (mix(three) & _U(BINS - 1)).astype(np.int64)
    keep = np.ones(len(three), dtype=bool)
    inner = offsets[1:-1]
    for back in (1, 2):
        at = inner - back
        keep[at[(at >= 0) & (at < len(keep))]] = False
    owner = np.searchsorted(offsets, np.flatnonzero(keep), side="right") - 1
    out = [(three[keep], np.bincount(owner, minlength=len(offsets) - 1))]

    black = ~_SPACE[data]
    first = black.copy()
    first[1:] &= ~black[:-1]
    at = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[at] = black[at]
    starts = np.flatnonzero(first)
    counts = np.diff(np.searchsorted(starts, offsets))
    if not len(starts):
        return [*out, (np.empty(0, dtype=np.int64), counts)]
    inside = data[black]
    begin = np.flatnonzero(first[black])
    sizes = np.diff(begin, append=len(inside))
    place = np.arange(len(inside)) - np.repeat(begin, sizes)
    hashes = np.add.reduceat((inside.astype(_U) + _U(1)) * constants(64, 9)[place & 63], begin)
    owner = np.repeat(np.arange(len(counts)), counts)
    same = np.zeros(len(starts), dtype=np.int64)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    kind = _CLASS[inside]
    shape = ((kind[begin] * 16 + kind[np.minimum(begin + 1, begin + sizes - 1)]) * 16 + kind[begin + sizes - 1]) * 4 + same * 2 + (sizes == 1)
    grams, owners, rolled = [], [], mix(shape.astype(_U) + _U(1))
    for n in range(3):
        if n:
            rolled = mix(rolled[:-1] + mix(shape[n:].astype(_U) + _U(n << 32)))
        whole = owner[n:] == owner[: len(owner) - n] if n else np.ones(len(owner), dtype=bool)
        grams.append((rolled[whole] & _U(BINS - 1)).astype(np.int64))
        owners.append(owner[: len(owner) - n][whole])
    order = np.argsort(np.concatenate(owners), kind="stable")
    return [*out, (np.concatenate(grams)[order], np.bincount(np.concatenate(owners), minlength=len(counts)))]


def indicators(column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, features present in each text) for runs of rows."""
    last = np.zeros(BINS, dtype=np.int64)
    # A run takes some seventy bytes of memory for each byte of its texts, in every worker of an executor.
    for start, data, offsets in texts_of(column, 250_000):
        texts: list[list[np.ndarray]] = [[] for _ in range(len(offsets) - 1)]
        for k, (grams, counts) in enumerate(ngrams(data, offsets)):
            ends = np.cumsum(counts)
            for text, end, n in zip(texts, ends.tolist(), counts.tolist(), strict=True):
                own = grams[end - n : end]
                nth = np.arange(n)
                last[own] = nth
                text.append(own[last[own] == nth] + k * BINS)
        yield start, [np.concatenate(x) for x in texts]


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """Log of how much likelier a feature is in a text of label 1 than in one of label 0."""
    ratio = np.zeros(KINDS * BINS)
    for label, sign in ((1, 1.0), (0, -1.0)):
        chosen = [r for r, y in zip(rows, labels, strict=True) if y == label]
        counts = np.bincount(np.concatenate(chosen), minlength=KINDS * BINS) if chosen else np.zeros(KINDS * BINS)
        ratio += sign * np.log((counts + smooth) / (len(chosen) + 2 * smooth))
    return ratio


def dual_coordinate_descent(rows: list[np.ndarray], scale: np.ndarray, signs: np.ndarray, *, cost: float = 1.0, epochs: int = 20, seed: int = 0) -> np.ndarray:
    """Weights of a linear machine with hinge loss over unit-length rows of scaled indicators.

    Each step moves one row's dual variable to its best value between 0 and
    ``cost`` and the weights with it; a pass that moves none by much ends it.
    """
    w, alpha = np.zeros(len(scale)), np.zeros(len(rows))
    values = [scale[r] for r in rows]
    lengths = [float(np.sqrt((v * v).sum())) or 1.0 for v in values]
    values = [v / n for v, n in zip(values, lengths, strict=True)]
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            v = values[i]
            if not len(v):
                continue
            slope = signs[i] * float(w[rows[i]] @ v) - 1
            new = min(max(alpha[i] - slope / float(v @ v), 0.0), cost)
            if new != alpha[i]:
                w[rows[i]] += (new - alpha[i]) * signs[i] * v
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3 * cost:
            break
    return w


@dataclass
class Model:
    """``plain`` sums to the margin of a text and ``square`` to its squared length, over the features present."""

    plain: np.ndarray
    square: np.ndarray
    calibration: np.ndarray
    prior: float

    def margins(self, rows: list[np.ndarray]) -> np.ndarray:
        sums = [(self.plain[r].sum(dtype=np.float64), self.square[r].sum(dtype=np.float64)) for r in rows]
        return np.array([a / np.sqrt(b) if b > 0 else 0.0 for a, b in sums])

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        out = probability(self.margins(rows)[:, None], self.calibration)
        return np.where([len(r) > 0 for r in rows], out, self.prior)


def fit(rows: list[np.ndarray], labels: np.ndarray, prior: float) -> Model:
    """Ratios and machine from four fifths of the rows, calibration from the rest, weighted to the share ``prior`` of label 1."""
    check = np.arange(len(rows)) % 5 == 4
    if len(set(labels[~check])) < 2 or len(set(labels[check])) < 2:
        flat = np.zeros(KINDS * BINS, dtype=np.float32)
        return Model(flat, flat, np.array([0.0, 0.0]), prior)
    train = [r for r, c in zip(rows, check, strict=True) if not c]
    scale = log_count_ratios(train, labels[~check])
    w = dual_coordinate_descent(train, scale, np.where(labels[~check] == 1, 1.0, -1.0))
    model = Model((w * scale).astype(np.float32), (scale * scale).astype(np.float32), np.zeros(2), prior)
    held, y = model.margins([r for r, c in zip(rows, check, strict=True) if c]), labels[check]
    weights = np.where(y == 1, prior / max(y.mean(), 1e-9), (1 - prior) / max(1 - y.mean(), 1e-9))
    model.calibration = logistic(held[:, None], y, weights)
    return model


def train(docs: DataFrame, labels: DataFrame, target: str, usable: Column, *, most: int = 3000) -> Model:
    """Fit on up to ``most`` documents of each label; what comes to the driver is their features, at most 131,072 numbers each."""
    texts = training_texts(docs, labels, target, usable, {0: most, 1: most})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, rows in indicators(batch.column(1)):
                part = batch.slice(start, len(rows))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array([r.astype(np.int32) for r in rows], pa.list_(pa.int32()))], names=["doc_id", "label", "features"])

    work = Workspace(docs.sparkSession, "nbsvm")
    chosen = texts.select("doc_id", "text", F.col("label").cast("int").alias("label"))
    sample = work.keep(chosen.mapInArrow(releasing(run), "doc_id long, label int, features array<int>"), "sample").toArrow().sort_by([("doc_id", "ascending")])
    share = labels.filter(usable).agg(F.avg(F.col(target).cast("double"))).first()[0]
    features = [x.values.to_numpy() for x in sample.column("features")]
    model = fit(features, sample.column("label").to_numpy(), 0.5 if share is None else float(share))
    del features, sample
    release()
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of every whole text; a text too short for any n-gram gets the share of label 1."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, rows in indicators(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(rows)), pa.array(shared.value.scores(rows))], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(releasing(run), "doc_id long, score double")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns kept, whose text scores 0.5 or more; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, rows in indicators(batch.column(at)):
                yield batch.slice(start, len(rows)).filter(pa.array(shared.value.scores(rows) >= 0.5))

    return docs.mapInArrow(releasing(run), docs.schema)


def classify(docs: DataFrame, labels: DataFrame, *, target: str = "quality", modulus: int = 3, held: int = 1, most: int = 3000) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Learns only from labelled ids whose crc32 modulo ``modulus`` is not
    ``held``, from at most ``most`` of each label. Null and empty texts get the
    share of label 1; without both labels every score is 0.5 or that share; a
    null doc_id is scored and not held out; repeated rows are each scored. Only
    doc_id and text of ``docs`` are read, only doc_id and the target of ``labels``.
    """
    model = train(docs, labels, target, remainder("doc_id", modulus) != held, most=most)
    out = F.coalesce(remainder("doc_id", modulus) == held, F.lit(False))
    return score(docs, model).select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
