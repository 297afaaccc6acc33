"""Best-fit packing of documents into token sequences by the sum-of-squares rule."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._work import Workspace, releasing
from tessera.llm.bpe import batches, encoder, vocabulary

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PLACED = _PIECE + ", sequence_id long, offset long"


def cut_pieces(docs: DataFrame, *, capacity: int = 1024, tokenizer: str | None = None, end_id: int = 2) -> DataFrame:
    """Token pieces of every text (null: empty), each with ``end_id`` at its end.

    Only a document of more than ``capacity`` tokens is cut: into full pieces
    behind a first one that may be shorter. No shuffle; one pass over the texts.
    """
    path = tokenizer or vocabulary()

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        width = bpe.dtype.itemsize
        for batch in rows:
            keys = batch.column(0).to_pylist()
            for a, texts in batches(batch.column(1)):
                out = []
                for key, ids in zip(keys[a : a + len(texts)], bpe.encode(texts, end_id), strict=True):
                    wide = np.frombuffer(ids, dtype=bpe.dtype).astype("<u4").tobytes()
                    n = len(ids) // width
                    start, length, piece = 0, (n - 1) % capacity + 1, 0
                    while start < n:
                        out.append((key, piece, start, length, zlib.crc32(wide[4 * start : 4 * (start + length)])))
                        start, length, piece = start + length, capacity, piece + 1
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int32(), *[pa.int64()] * 3), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

        bpe.known.clear()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(releasing(cut), _PIECE)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item, items taken in the given order.

    Among the open bins that an item fits into it goes where the sum, over all
    residual gaps, of the squared count of open bins with that gap becomes
    smallest; of equals, to the smallest gap. A bin is opened only when none
    fits, for a sequence more is what packing is to avoid.
    """
    counts = np.zeros(capacity + 1, dtype=np.int64)
    held: dict[int, list[int]] = defaultdict(list)
    bins, offsets, opened = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i, size in enumerate(lengths.tolist()):
        fits = np.flatnonzero(counts[size:capacity])
        if len(fits):
            # Moving a bin from gap g to gap h changes the sum by 2 (N[h] - N[g] + 1); a bin that is full leaves it.
            change = 2 * (counts[fits] - counts[size + fits] + 1)
            if fits[0] == 0:
                change[0] = 1 - 2 * counts[size]
            left = int(fits[int(change.argmin())])
            gap = left + size
            counts[gap] -= 1
            at = held[gap].pop()
        else:
            gap, left, at, opened = capacity, capacity - size, opened, opened + 1
        if left:
            counts[left] += 1
            held[left].append(at)
        bins[i], offsets[i] = at, capacity - gap
    return bins, offsets


def pack(pieces: DataFrame, *, capacity: int = 1024, group_pieces: int = 32_768) -> DataFrame:
    """Give each piece a sequence and its place there.

    A full piece is a sequence alone. The rest is dealt evenly, by row number
    and not by any key, into groups of about ``group_pieces``, each packed by
    one task in descending length; a group ends with few open bins, so the loss
    against packing all at once is below one sequence in a thousand.
    """
    short = pieces.filter(F.col("length") < capacity)
    groups = max(1, short.count() // group_pieces)
    row = F.monotonically_increasing_id()
    alone = pieces.filter(F.col("length") >= capacity).withColumns({"sequence_id": -row - 1, "offset": F.lit(0).cast("long")})

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        group = int(rows["group"].iloc[0])
        rows = rows.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable").drop(columns="group")
        bins, offsets = sum_of_squares(rows["length"].to_numpy(), capacity)
        return rows.assign(sequence_id=bins + (group << 32), offset=offsets)

    dealt = short.withColumn("group", F.pmod(F.xxhash64(row), F.lit(groups)))
    return alone.unionByName(dealt.groupBy("group").applyInPandas(place, _PLACED))


def pack_documents(docs: DataFrame, *, capacity: int = 1024, tokenizer: str | None = None, end_id: int = 2, group_pieces: int = 32_768) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null text is an empty one and makes a piece of the end id alone; a null
    ``doc_id`` stays null; each of repeated rows is packed; an empty table
    gives no rows. Other columns of ``docs`` are not read.
    """
    work = Workspace(docs.sparkSession, "packing")
    pieces = work.keep(cut_pieces(docs, capacity=capacity, tokenizer=tokenizer, end_id=end_id), "pieces")
    return pack(pieces, capacity=capacity, group_pieces=group_pieces)
