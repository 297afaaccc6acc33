"""Token-id output: length-delimited binary records with masked checksums and a separate offset index.

A record is ``u64 length | u32 masked crc of those 8 bytes | payload | u32
masked crc of the payload``, all little-endian. The payload is ``u8 has_id |
i64 id | u8 bytes per token | token ids``. The index file beside it holds, per
record, ``u64 offset | u64 tokens``; it lets a reader take records in any order.
The checksum is CRC-32 rotated right by 15 bits plus a constant, so that a
checksum stored inside checksummed data stays distinct from its own.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm._work import Workspace, open_read, open_write, rename
from tessera.llm.bpe import batches, encoder, vocabulary

_HEAD, _SUM, _META = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<BqB")
INDEX = np.dtype([("offset", "<u8"), ("tokens", "<u8")])
MANIFEST = "part int, file string, n_docs long, n_tokens long, n_bytes long"


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = _HEAD.pack(len(payload))
    return b"".join((head, _SUM.pack(masked_crc(head)), payload, _SUM.pack(masked_crc(payload))))


def token_payload(key: int | None, width: int, ids: bytes) -> bytes:
    return _META.pack(key is not None, key or 0, width) + ids


def read_record(stream) -> tuple[int | None, np.ndarray] | None:
    """The id and tokens of the record at the stream's place; None at its end; ValueError if it is damaged."""
    head = stream.read(12)
    if not head:
        return None
    if len(head) < 12 or masked_crc(head[:8]) != _SUM.unpack(head[8:])[0]:
        raise ValueError("damaged record length")
    size = _HEAD.unpack(head[:8])[0]
    body = stream.read(size + 4)
    payload = body[:size]
    if len(body) < size + 4 or masked_crc(payload) != _SUM.unpack(body[size:])[0]:
        raise ValueError("damaged record payload")
    has_id, key, width = _META.unpack_from(payload)
    return key if has_id else None, np.frombuffer(payload, dtype=f"<u{width}", offset=_META.size)


def read_at(file: str, positions: list[int]) -> Iterator[tuple[int | None, np.ndarray]]:
    """Records of a file in the order asked for, found by its index."""
    with open_read(file + ".idx") as f:
        index = np.frombuffer(f.read(), dtype=INDEX)
    with open_read(file) as f:
        for p in positions:
            f.seek(int(index["offset"][p]))
            yield read_record(f)


def write_token_records(docs: DataFrame, out: str, *, tokenizer: str | None = None, end_id: int = 2, files: int | None = None) -> DataFrame:
    """Write the ids of every text, ascending by ``doc_id``, as record files in ``out``; return the manifest.

    Rows are dealt to files by ranges of ``doc_id`` and sorted inside them, so
    file order is id order and no task holds more than its file's rows. A task
    writes under its own name and renames at the end, so a repeated task leaves
    one file. Null text is empty (only ``end_id``); a null ``doc_id`` sorts
    first; rows that share an id stand beside each other, ordered by text; an
    empty table gives empty files. Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    path = tokenizer or vocabulary()
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
        .repartitionByRange(files, "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )

    def write(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, task = encoder(path), TaskContext.get()
        part = task.partitionId()
        name = f"{out}/part-{part:06d}.rec"
        mine = f"{out}/.part-{part:06d}-{task.taskAttemptId()}"
        place, n_tokens, index = 0, 0, []
        with open_write(mine) as f:
            for batch in rows:
                keys = batch.column(0).to_pylist()
                for a, texts in batches(batch.column(1)):
                    for key, ids in zip(keys[a : a + len(texts)], bpe.encode(texts, end_id), strict=True):
                        record = frame(token_payload(key, bpe.dtype.itemsize, ids))
                        f.write(record)
                        n = len(ids) // bpe.dtype.itemsize
                        index.append((place, n))
                        place += len(record)
                        n_tokens += n
        with open_write(mine + ".idx") as f:
            f.write(np.array(index, dtype=INDEX).tobytes())
        rename(mine + ".idx", name + ".idx")
        rename(mine, name)
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "file": [name], "n_docs": [len(index)], "n_tokens": [n_tokens], "n_bytes": [place]})

    return dealt.mapInArrow(write, MANIFEST)


def read_token_records(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """One row per record of the files in ``manifest``: doc_id, start (tokens before it), n_tokens, ids_crc32.

    Each file is read once, as a stream, by one task; every checksum is
    verified. Only the manifest, one row per file, is ordered in one place.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.select("part", "file", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    dealt = based.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))

    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for row in batch.to_pylist():
                start, out = row["base"], []
                with open_read(row["file"]) as f:
                    while (record := read_record(f)) is not None:
                        key, ids = record
                        out.append((key, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                        if len(out) == 20_000:
                            yield _digests(out)
                            out = []
                if out:
                    yield _digests(out)

    return dealt.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def token_record_digests(docs: DataFrame, **options) -> DataFrame:
    """Write the records of ``docs`` into a fresh folder and return what a reader finds in the files."""
    spark = docs.sparkSession
    work = Workspace(spark, "records")
    manifest = work.keep(write_token_records(docs, work.uri("files"), **options), "manifest")
    return read_token_records(spark, manifest)
