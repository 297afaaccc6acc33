"""Archives of one gzip member with a plain tar inside: strict reading, reproducible writing."""

from __future__ import annotations

import gzip
import io
import tarfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tessera.errors import FindingError


def gunzip_one(data: bytes, *, most: int = 1 << 28, ratio: int = 1000) -> bytes:
    """The content of exactly one gzip member; length and checksum are verified by zlib, trailing bytes refused."""
    reader = zlib.decompressobj(31)
    try:
        out = reader.decompress(data, most + 1)
    except zlib.error as e:
        raise FindingError(f"damaged gzip: {e}") from None
    if len(out) > most or len(out) // max(1, len(data)) > ratio:
        raise FindingError("gzip unfolds into too much")
    if not reader.eof:
        raise FindingError("truncated gzip")
    if reader.unused_data:
        raise FindingError("bytes after the gzip member")
    return out


def members(data: bytes, *, most: int = 64) -> dict[str, bytes]:
    """Regular files of a tar by name. Links, devices, long-name records, paths that climb, repeats and lies about size are refused."""
    out: dict[str, bytes] = {}
    at = 0
    while at + 512 <= len(data):
        block = data[at : at + 512]
        if block == b"\0" * 512:
            if data[at:].strip(b"\0"):
                raise FindingError("bytes after the end of the tar")
            return out
        try:
            info = tarfile.TarInfo.frombuf(block, "utf-8", "strict")
        except (tarfile.HeaderError, UnicodeDecodeError) as e:
            raise FindingError(f"damaged tar header: {e}") from None
        if block[156:157] not in (b"0", b"\0"):
            raise FindingError(f"{info.name}: not a regular file")
        if info.name.startswith("/") or ".." in info.name.split("/") or not info.name:
            raise FindingError(f"{info.name}: path leaves the archive")
        if info.name in out or len(out) >= most:
            raise FindingError(f"{info.name}: repeated or one member too many")
        end = at + 512 + info.size
        if info.size < 0 or end > len(data):
            raise FindingError(f"{info.name}: size passes the archive's end")
        out[info.name] = data[at + 512 : end]
        at = at + 512 + -(-info.size // 512) * 512
    raise FindingError("tar has no end")


def pack(files: dict[str, bytes]) -> bytes:
    """A gzip of a tar that depends on nothing but names and contents: sorted, without times and owners."""
    buffer = io.BytesIO()
    with tarfile.open(fileobj=buffer, mode="w", format=tarfile.USTAR_FORMAT) as tar:
        for name in sorted(files):
            info = tarfile.TarInfo(name)
            info.size, info.mode, info.mtime = len(files[name]), 0o644, 0
            tar.addfile(info, io.BytesIO(files[name]))
    return gzip.compress(buffer.getvalue(), 6, mtime=0)


def read_archives(spark: SparkSession, path: str, *, expected: int = 2) -> DataFrame:
    """path, member, content, error of all archives below a path; a refused archive is one row with an error, never a failed task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    found = members(gunzip_one(content))
                    if len(found) != expected:
                        raise FindingError(f"{len(found)} members, not {expected}")
                    rows = [(path, k, v, None) for k, v in found.items()]
                except FindingError as e:
                    rows = [(path, None, None, str(e))]
                kinds = (pa.string(), pa.string(), pa.binary(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["path", "member", "content", "error"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "path string, member string, content binary, error string")
