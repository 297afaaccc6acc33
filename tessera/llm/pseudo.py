"""Masked pseudo-likelihood of texts under a bidirectional window network trained in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._words import constants, mix, texts_of, words
from tessera.llm._work import Workspace

_U = np.uint64
#: Greatest difference of two inputs to an exponential.
_MOST = 60.0


@dataclass(frozen=True)
class Shape:
    """The ``own`` most frequent words are classes of their own, the others share the rest of ``classes`` by how
    frequent they are; the network sees ``side`` words on either side through ``hidden`` units. With ``buckets`` set,
    words first fall into so many buckets by hash, which stand for words then.

    Classes are predicted in two steps, a group of classes of like frequency and a class in it, so that a word costs
    twice the root of their number and not all of it.
    """

    buckets: int | None = None
    classes: int = 256
    own: int = 192
    side: int = 2
    hidden: int = 32

    @property
    def groups(self) -> int:
        return int(np.ceil(np.sqrt(self.classes)))

    @property
    def leaves(self) -> int:
        """Classes of a group, as many in each but the last."""
        return -(-self.classes // self.groups)

    @property
    def sizes(self) -> list[tuple[int, ...]]:
        g, n = self.groups, self.leaves
        return [(2 * self.side, self.classes + 1, self.hidden), (self.hidden,), (self.hidden, g), (g,), (g, self.hidden, n), (g, n)]


@dataclass
class Vocabulary:
    """``of_bucket``: class of each word (row); ``within``: log share of the word in its class, by counts over all texts.

    ``hashes``, ascending, are the words that stand more than once in all texts; the row after them is any other
    word, which stands there once. Without them rows are buckets.
    """

    of_bucket: np.ndarray
    within: np.ndarray
    mass: np.ndarray
    hashes: np.ndarray | None = None

    def rows(self, hashes: np.ndarray, shape: Shape) -> np.ndarray:
        if self.hashes is None:
            return buckets(hashes, shape)
        if not len(self.hashes):
            return np.zeros(len(hashes), dtype=np.int64)
        distinct, back = np.unique(hashes, return_inverse=True)
        at = np.minimum(np.searchsorted(self.hashes, distinct), len(self.hashes) - 1)
        return np.where(self.hashes[at] == distinct, at, len(self.hashes))[back]


def buckets(hashes: np.ndarray, shape: Shape) -> np.ndarray:
    return (mix(hashes ^ constants(1, 11)[0]) % _U(shape.buckets)).astype(np.int64)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, back = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(back, counts, len(distinct)).astype(np.int64)


def count_words(docs: DataFrame, shape: Shape, most: int = 1_000_000) -> DataFrame:
    """word (its hash, or its bucket), n over every word of every text; each task sums its own before the shuffle."""

    def table(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        keys, counts = summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for _, data, offsets in texts_of(batch.column(0)):
                hashes = words(data, offsets)[0]
                keys = hashes if shape.buckets is None else buckets(hashes, shape).astype(_U)
                parts.append(np.unique(keys, return_counts=True))
                size += len(parts[-1][0])
                if size > most:
                    parts = [summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))]
                    if len(parts[0][0]) > most // 2:
                        yield table(parts)
                        parts = []
                    size = sum(len(x) for x, _ in parts)
        if parts:
            yield table(parts)

    return docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: np.ndarray, shape: Shape, hashes: np.ndarray | None = None) -> Vocabulary:
    """Of counts by bucket or, with ``hashes``, by word, the last count being that of all words that stand once."""
    order = np.lexsort((np.arange(len(counts)), -counts))
    if hashes is not None:
        order = np.append(order[order != len(counts) - 1], len(counts) - 1)
    of_bucket = np.empty(len(counts), dtype=np.int64)
    own = order[: shape.own]
    of_bucket[own] = np.arange(len(own))
    rest = order[shape.own :]
    # Neighbours by frequency share a class; each class has about as many occurrences.
    smooth = counts + 1.0 if hashes is None else np.maximum(counts, 1.0)
    share = (np.cumsum(smooth[rest]) - smooth[rest] / 2) / max(smooth[rest].sum(), 1.0)
    of_bucket[rest] = shape.own + np.minimum(share * (shape.classes - shape.own), shape.classes - shape.own - 1).astype(np.int64)
    mass = np.bincount(of_bucket, smooth, shape.classes)
    each = smooth.copy()
    if hashes is not None:
        each[-1] = 1.0
    return Vocabulary(of_bucket, np.log(each) - np.log(mass[of_bucket]), mass, hashes)


def count(docs: DataFrame, shape: Shape, work: Workspace) -> Vocabulary:
    """The counts of all words stay in a table; those that stand more than once, and the number of the others, come to the driver."""
    counted = work.keep(count_words(docs, shape), "counts")
    if shape.buckets is not None:
        found = counted.toArrow()
        counts = np.zeros(shape.buckets, dtype=np.int64)
        counts[found.column("word").to_numpy()] = found.column("n").to_numpy()
        return vocabulary(counts, shape)
    once = counted.filter("n = 1").count()
    found = counted.filter("n > 1").toArrow()
    hashes = found.column("word").to_numpy().view(_U)
    order = np.argsort(hashes)
    return vocabulary(np.append(found.column("n").to_numpy()[order], once), shape, hashes[order])


def start_parameters(shape: Shape, vocab: Vocabulary) -> list[np.ndarray]:
    rng = np.random.default_rng(3)
    embed, bias, out, base, leaf_out, leaf_base = (np.zeros(s, dtype=np.float32) for s in shape.sizes)
    embed += rng.normal(0, 0.3, embed.shape)
    out += rng.normal(0, 0.1, out.shape)
    leaf_out += rng.normal(0, 0.1, leaf_out.shape)
    n = np.zeros(leaf_base.size)
    n[: shape.classes] = vocab.mass + 1.0
    n = n.reshape(leaf_base.shape)
    base += np.log((n.sum(axis=1) + 1e-9) / n.sum())
    # Places behind the last class are never a target.
    leaf_base += np.where(n > 0, np.log(np.maximum(n, 1.0) / np.maximum(n.sum(axis=1, keepdims=True), 1.0)), -_MOST / 2)
    return [embed, bias, out, base, leaf_out, leaf_base]


def contexts(classes: np.ndarray, counts: np.ndarray, shape: Shape) -> np.ndarray:
    """The classes around each word, from left to right; beyond a text's ends stands a class of its own."""
    side, pad = shape.side, shape.classes
    owner = np.repeat(np.arange(len(counts)), counts)
    padded = np.full(len(classes) + side * (len(counts) + 1), pad, dtype=np.int64)
    at = np.arange(len(classes)) + side * (owner + 1)
    padded[at] = classes
    return np.stack([padded[at + d] for d in range(-side, side + 1) if d])


def hidden_units(parameters: list[np.ndarray], around: np.ndarray) -> np.ndarray:
    embed, bias = parameters[:2]
    total = embed[0][around[0]]
    for k in range(1, len(around)):
        total += embed[k][around[k]]
    total += bias
    return np.tanh(total, out=total)


def bounded(parameters: list[np.ndarray]) -> list[np.ndarray]:
    """Scaled so that no class's input can pass what exponentials of single precision hold."""
    embed, bias, out, base, leaf_out, leaf_base = parameters
    half = _MOST / 2

    def held(weights: np.ndarray) -> np.ndarray:
        return weights * np.float32(min(1.0, half / max(float(np.abs(weights).sum(axis=-2).max()), 1e-9)))

    return [embed, bias, held(out), np.clip(base, -half, half), held(leaf_out), np.clip(leaf_base, -half, half)]


def _shares(z: np.ndarray) -> np.ndarray:
    z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(axis=1, keepdims=True)
    return z


def _by_group(group: np.ndarray, groups: int) -> Iterator[tuple[int, np.ndarray]]:
    """(group, its rows) of each group that has any."""
    order = np.argsort(group, kind="stable")
    bounds = np.searchsorted(group[order], np.arange(groups + 1))
    for g in range(groups):
        if bounds[g] < bounds[g + 1]:
            yield g, order[bounds[g] : bounds[g + 1]]


def log_shares(parameters: list[np.ndarray], hidden: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log probability of each target class: of its group, and of the class in it."""
    _, _, out, base, leaf_out, leaf_base = parameters
    group, leaf = np.divmod(target, leaf_base.shape[1])
    z = hidden @ out + base
    found = z[np.arange(len(z)), group].astype(np.float64) - np.log(np.exp(z, out=z).sum(axis=1))
    for g, rows in _by_group(group, len(base)):
        z = hidden[rows] @ leaf_out[g] + leaf_base[g]
        found[rows] += z[np.arange(len(z)), leaf[rows]] - np.log(np.exp(z).sum(axis=1))
    return found


def train_step(parameters: list[np.ndarray], memory: list[np.ndarray], around: np.ndarray, target: np.ndarray, rate: float) -> None:
    """One adaptive gradient step on a batch of windows, in place."""
    embed, _, out, base, leaf_out, leaf_base = parameters
    hidden, n = hidden_units(parameters, around), np.float32(len(target))
    group, leaf = np.divmod(target, leaf_base.shape[1])
    z = _shares(hidden @ out + base)
    z[np.arange(len(z)), group] -= 1
    z /= n
    back, leaf_slope, leaf_base_slope = z @ out.T, np.zeros_like(leaf_out), np.zeros_like(leaf_base)
    for g, rows in _by_group(group, len(base)):
        own = hidden[rows]
        y = _shares(own @ leaf_out[g] + leaf_base[g])
        y[np.arange(len(y)), leaf[rows]] -= 1
        y /= n
        back[rows] += y @ leaf_out[g].T
        leaf_slope[g], leaf_base_slope[g] = own.T @ y, y.sum(axis=0)
    back *= 1 - hidden * hidden
    slope = np.zeros_like(embed)
    for k in range(len(around)):
        order = np.argsort(around[k], kind="stable")
        own = around[k][order]
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        slope[k][own[first]] = np.add.reduceat(back[order], first)
    slopes = (slope, back.sum(axis=0), hidden.T @ z, z.sum(axis=0), leaf_slope, leaf_base_slope)
    for p, m, g in zip(parameters, memory, slopes, strict=True):
        m += g * g
        p -= rate * g / np.sqrt(m + 1e-8)


def train_round(docs: DataFrame, parameters: list[np.ndarray], vocab: Vocabulary, shape: Shape, work: Workspace, turn: int, *, every: int, batch_size: int, rate: float) -> list[np.ndarray]:
    """Every task trains a copy on one in ``every`` words of its texts; the copies' mean, weighted by words, is the result.

    Which words these are moves on by one with each ``turn``. The copies are summed over the cluster in streams, so the driver gets a few
    sums whatever the input's size.
    """
    flat = np.concatenate([p.reshape(-1) for p in parameters])
    shared = docs.sparkSession.sparkContext.broadcast(vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [p.copy() for p in parameters]
        memory = [np.zeros_like(p) for p in own]
        seen, phase, left = 0, (TaskContext.get().partitionId() + turn) % every, []
        for batch in batches:
            for _, data, offsets in texts_of(batch.column(0)):
                hashes, counts = words(data, offsets)
                classes = shared.value.of_bucket[shared.value.rows(hashes, shape)]
                chosen = np.arange(phase, len(classes), every)
                left.append((contexts(classes, counts, shape)[:, chosen], classes[chosen]))
                around, target = (np.concatenate(x, axis=-1) for x in zip(*left, strict=True))
                cut = len(target) - len(target) % batch_size
                for i in range(0, cut, batch_size):
                    train_step(own, memory, around[:, i : i + batch_size], target[i : i + batch_size], rate)
                left, seen = [(around[:, cut:], target[cut:])], seen + cut
        for around, target in left:
            if len(target):
                train_step(own, memory, around, target, rate)
                seen += len(target)
        if seen:
            mean = np.concatenate([p.reshape(-1) for p in own]).astype(np.float32)
            yield pa.RecordBatch.from_pydict({"n": [float(seen)], "parameters": [mean.tobytes()]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weight = np.zeros(len(flat)), 0.0
        for batch in batches:
            for r in batch.to_pylist():
                total += r["n"] * np.frombuffer(r["parameters"], dtype=np.float32)
                weight += r["n"]
        if weight:
            yield pa.RecordBatch.from_pydict({"n": [weight], "parameters": [(total / weight).astype(np.float32).tobytes()]})

    copies = docs.select("text").mapInArrow(run, "n double, parameters binary")
    sums = work.keep(copies.repartition(8).mapInArrow(add, "n double, parameters binary"), f"round-{turn}").toArrow().to_pylist()
    if not sums:
        return parameters
    weight = sum(r["n"] for r in sums)
    mean = sum(r["n"] / weight * np.frombuffer(r["parameters"], dtype=np.float32).astype(np.float64) for r in sorted(sums, key=lambda r: r["parameters"]))
    parts = np.split(mean.astype(np.float32), np.cumsum([int(np.prod(s)) for s in shape.sizes])[:-1])
    return bounded([p.reshape(s) for p, s in zip(parts, shape.sizes, strict=True)])


@dataclass
class Model:
    shape: Shape
    vocab: Vocabulary
    parameters: list[np.ndarray]

    def log_probabilities(self, hashes: np.ndarray, counts: np.ndarray, piece: int = 16_384) -> np.ndarray:
        """Of each word, given the words on both sides."""
        row = self.vocab.rows(hashes, self.shape)
        classes = self.vocab.of_bucket[row]
        around, out = contexts(classes, counts, self.shape), self.vocab.within[row]
        for i in range(0, len(classes), piece):
            out[i : i + piece] += log_shares(self.parameters, hidden_units(self.parameters, around[:, i : i + piece]), classes[i : i + piece])
        return out


def train(docs: DataFrame, *, shape: Shape = Shape(), rounds: int = 1, every: int = 1, batch_size: int = 2048, rate: float = 0.05) -> Model:
    """Counts over all words, then ``rounds`` rounds of training on every word of every text (with ``every`` above 1, on one in so many)."""
    work = Workspace(docs.sparkSession, "pseudo")
    vocab = count(docs, shape, work)
    parameters = start_parameters(shape, vocab)
    for k in range(rounds):
        parameters = train_round(docs, parameters, vocab, shape, work, k, every=every, batch_size=batch_size, rate=rate)
    return Model(shape, vocab, bounded(parameters))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_words, log_likelihood (sum over words), mean_log_likelihood (null without words)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, data, offsets in texts_of(batch.column(1), 1_000_000):
                hashes, counts = words(data, offsets)
                owner = np.repeat(np.arange(len(counts)), counts)
                total = np.bincount(owner, shared.value.log_probabilities(hashes, counts), len(counts))
                mean = np.divide(total, counts, out=np.zeros(len(counts)), where=counts > 0)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(counts)), pa.array(counts), pa.array(total), pa.array(mean, mask=counts == 0)], names=["doc_id", "n_words", "log_likelihood", "mean_log_likelihood"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_words long, log_likelihood double, mean_log_likelihood double")


def score_documents(docs: DataFrame, **options) -> DataFrame:
    """Train on all texts and score each: doc_id, n_words, log_likelihood, mean_log_likelihood.

    Null, empty and wordless texts have likelihood 0 and a null mean; a null
    doc_id is scored; each of repeated rows is scored; an empty table gives no
    rows. Only doc_id and text are read.
    """
    return score(docs, train(docs, **options))
