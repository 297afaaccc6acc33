"""Toxicity by compression distance: how much shorter a window becomes with a dictionary of toxic text at hand."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm._labels import logistic, probability, remainder, training_texts
from tessera.llm._work import Workspace

#: Longest window in bytes; a longer run of bytes without space is cut into several.
MOST = 64
LEVEL = 16


def windows(text: str | None, words: int) -> list[bytes]:
    """Every run of so many words of a text, lower-cased, with a space before, between and after; a shorter text is one window."""
    tokens = [t[i : i + MOST] for t in (text or "").lower().encode().split() for i in range(0, len(t), MOST)]
    if words == 1 or len(tokens) <= words:
        return tokens if words == 1 else [b" ".join(tokens)] * bool(tokens)
    return [b" ".join(tokens[i : i + words]) for i in range(len(tokens) - words + 1)]


class Distance:
    """Bytes that a window loses when toxic text is at hand besides ordinary text.

    Both compressors hold the ordinary dictionary; one also holds the toxic
    one before it. A window is compressed behind a stretch of the ordinary
    dictionary, so that a short one is never stored as it is, which would hide
    the difference. Distances are remembered; the memory is emptied when full.
    """

    def __init__(self, ordinary: bytes, toxic: bytes, cache: int = 400_000) -> None:
        self.primer = ordinary[-96:-64]
        options = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        sizes = {"source_size": 2 * MOST, "dict_size": len(ordinary) + len(toxic)}
        setting = zstandard.ZstdCompressionParameters.from_level(LEVEL, **sizes, **options)
        self.compressors = []
        for content in (ordinary, toxic + ordinary):
            book = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            book.precompute_compress(compression_params=setting)
            self.compressors.append(zstandard.ZstdCompressor(dict_data=book, compression_params=setting))
        self.known: dict[bytes, int] = {}
        self.cache = cache

    def of(self, window: bytes) -> int:
        found = self.known.get(window)
        if found is None:
            if len(self.known) >= self.cache:
                self.known.clear()
            data = self.primer + b" " + window + b" "
            plain, toxic = (len(c.compress(data)) for c in self.compressors)
            found = self.known[window] = plain - toxic
        return found

    def features(self, text: str | None, words: int) -> list[float]:
        """Logs of one more than the number of windows that lose at least 2, 3, 4, 5 and 6 bytes, and the greatest loss."""
        lost = np.fromiter(map(self.of, windows(text, words)), dtype=np.int64)
        counts = [np.log1p(np.count_nonzero(lost >= n)) for n in (2, 3, 4, 5, 6)]
        return [*counts, float(np.clip(lost.max(initial=0), 0, 10))]


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    calibration: np.ndarray
    words: int


_DISTANCES: dict[tuple[bytes, bytes], Distance] = {}


def distance(ordinary: bytes, toxic: bytes) -> Distance:
    """One for each worker process and pair of dictionaries."""
    if (ordinary, toxic) not in _DISTANCES:
        _DISTANCES.clear()
        _DISTANCES[(ordinary, toxic)] = Distance(ordinary, toxic)
    return _DISTANCES[(ordinary, toxic)]


def trained(samples: list[bytes], size: int) -> bytes:
    """Content of a zstandard dictionary trained on the samples; if they are too few to train on, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples, level=3).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def usage(texts: DataFrame) -> DataFrame:
    """token, label, uses: in how many different surroundings (token before, token behind) a token stands; copies count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label in (0, 1):
                seen = set()
                for text, y in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                    if y == label:
                        tokens = [b"", *windows(text, 1), b""]
                        seen.update(zip(tokens[1:], tokens, tokens[2:], strict=False))
                seen.discard((b"", b"", b""))
                tokens = [x for x, _, _ in seen]
                around = [a + b" " + b for _, a, b in seen]
                yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.binary()), pa.array([label] * len(seen), pa.int32()), pa.array(around, pa.binary())], names=["token", "label", "around"])

    uses = texts.mapInArrow(run, "token binary, label int, around binary")
    return uses.select("token", "label", F.xxhash64("around").alias("around")).distinct().groupBy("token", "label").agg(F.count("*").alias("uses"))


def pieces(texts: DataFrame, words: int = 150) -> DataFrame:
    """Whole texts cut into pieces of so many words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                tokens = windows(text, 1)
                yield pa.RecordBatch.from_pydict({"piece": pa.array([b" " + b" ".join(tokens[i : i + words]) + b" " for i in range(0, len(tokens), words)], pa.binary())})

    return texts.mapInArrow(run, "piece binary")


def train(docs: DataFrame, labels: DataFrame, target: str, usable: Column, *, most: int, words: int, times: float = 20.0) -> Model:
    """Two dictionaries from up to ``most`` documents of each label, thresholds from other such documents.

    Toxic text is what toxic documents hold ``times`` as often as ordinary
    ones, in at least 3 different surroundings or, with many documents, twice
    the decimal logarithm of their number. The dictionaries have bounds of
    their own: the 2,000 such words with most uses, each given to the trainer
    40 times at most, and 3,000 pieces of 150 words of ordinary text, by hash. A
    quarter of the documents, by hashed id, is kept for calibration; their few
    features come to the driver.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "toxicity")
    texts = training_texts(docs, labels, target, usable, {0: 2 * most, 1: most})
    texts = work.keep(texts.select("doc_id", "text", F.col("label").cast("int").alias("label")).repartition(16), "texts")
    check = F.pmod(F.xxhash64("doc_id", F.lit("check")), F.lit(4)) == 0
    uses = work.keep(usage(texts.filter(~check).select("doc_id", "text", "label")), "uses")
    totals = {r.label: r.n for r in uses.groupBy("label").agg(F.sum("uses").alias("n")).collect()}
    share = labels.filter(usable).agg(F.avg(F.col(target).cast("double"))).first()[0]
    prior = 0.0 if share is None else float(share)
    flat = Model(b" " * 128, b" ", np.array([0.0] * 6 + [np.log((prior + 1e-6) / (1 - prior + 1e-6))]), words)
    if set(totals) != {0, 1}:
        return flat
    n_toxic = texts.filter(~check & (F.col("label") == 1)).count()
    at_least = max(3, round(2 * np.log10(n_toxic + 1)))
    wide = uses.groupBy("token").agg(*(F.coalesce(F.sum(F.when(F.col("label") == k, F.col("uses"))), F.lit(0)).alias(n) for k, n in ((1, "bad"), (0, "good"))))
    wide = wide.filter((F.col("bad") >= at_least) & ((F.col("bad") + 0.5) / totals[1] > times * (F.col("good") + 0.5) / totals[0]))
    found = wide.orderBy(F.desc("bad"), "token").limit(2000).collect()
    ordinary = pieces(texts.filter(~check & (F.col("label") == 0)).select("text")).orderBy(F.xxhash64("piece")).limit(3000).collect()
    if not found or not ordinary:
        return flat
    order = np.random.default_rng(0)
    spans = [b" " + bytes(r.token) + b" " for r in found for _ in range(min(r.bad, 40))]
    spans = [spans[i] for i in order.permutation(len(spans))]
    toxic = trained([b"".join(spans[i : i + 4]) for i in range(0, len(spans), 4)], 8192)
    missing = b"".join(x for r in reversed(found) if (x := b" " + bytes(r.token) + b" ") not in toxic)
    plain = trained([bytes(r.piece) for r in ordinary], 12_000)[-11_000:]
    plain = plain if len(plain) >= 128 else plain.rjust(128)
    model = Model(plain, missing + toxic, np.zeros(7), words)
    features = measure(texts.filter(check).select("doc_id", "text", "label"), model).orderBy("doc_id").toArrow()
    y = features.column("label").to_numpy().astype(float)
    if 0 < y.mean() < 1:
        x = np.array(features.column("features").to_pylist())
        weights = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
        model.calibration = logistic(x, y, weights, ridge=1e-3)
        return model
    return flat


def measure(texts: DataFrame, model: Model) -> DataFrame:
    """doc_id, label, features of (doc_id, text, label)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = distance(model.ordinary, model.toxic)
        for batch in batches:
            found = [d.features(x, model.words) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.float64()))], names=["doc_id", "label", "features"])

    return texts.mapInArrow(run, "doc_id long, label int, features array<double>")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = distance(model.ordinary, model.toxic)
        for batch in batches:
            found = np.array([d.features(x, model.words) for x in batch.column(1).to_pylist()]).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(probability(found, model.calibration))], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, *, target: str = "toxic", modulus: int = 5, held: int = 0, most: int = 3000, words: int = 1) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Learns only from labelled ids whose crc32 modulo ``modulus`` is not
    ``held``, from at most ``most`` toxic and twice as many ordinary documents.
    Null and empty texts have no window and score as a text without any toxic
    one; without toxic or ordinary labels every score is the share of label 1;
    a null doc_id is scored and not held out; repeated rows are each scored.
    Only doc_id and text of ``docs`` are read, only doc_id and the target of
    ``labels``.
    """
    model = train(docs, labels, target, remainder("doc_id", modulus) != held, most=most, words=words)
    out = F.coalesce(remainder("doc_id", modulus) == held, F.lit(False))
    return score(docs, model).select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
