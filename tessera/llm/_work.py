"""Tables and files that an operator keeps while it works, in the folder all executors share."""

from __future__ import annotations

import ctypes
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tessera.session import make_importable


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset a local folder on one machine, and an error on a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


class Workspace:
    """A fresh folder under :func:`shared_dir` for one run of one operator.

    ``keep`` writes a frame as Parquet and reads it again, which cuts its
    lineage: a lost executor costs the tasks in flight, never the steps before.
    The exchange files that the write needed go when it ends.
    ``drop`` deletes what is no longer read. The rest goes when the JVM ends.
    """

    def __init__(self, spark: SparkSession, name: str, options: dict[str, str] | None = None) -> None:
        """``options`` go to the Parquet writer."""
        make_importable(spark)
        self.spark = spark
        self.options = options or {}
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self._path(self.root)[1].deleteOnExit(self._path(self.root)[0])

    def _path(self, uri: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(uri)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def uri(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
        before = self.spark.conf.get(cleanup)
        self.spark.conf.set(cleanup, "true")
        try:
            df.write.options(**self.options).parquet(self.uri(name))
        finally:
            self.spark.conf.set(cleanup, before)
        return self.spark.read.schema(df.schema).parquet(self.uri(name))

    def drop(self, *names: str) -> None:
        for name in names:
            path, fs = self._path(self.uri(name))
            fs.delete(path, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Each name with as many underscores before it as it takes to be no column of the frame."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def release() -> None:
    """Give freed memory back to the system; the allocators would keep it for a process that may live long and need it no more."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def releasing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, a function of a task's batches, which gives back its memory at its end: workers wait for later tasks beside other ones and the JVM."""

    def whole(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release()

    return whole


def local_path(uri: str) -> str | None:
    """The path of a ``file:`` URI or plain path; None for any other store."""
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    return None if "://" in uri else uri


def open_write(uri: str):
    """A binary output stream; other stores than mounted folders go through pyarrow's file systems."""
    if (path := local_path(uri)) is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, "wb", buffering=1 << 20)
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    return store.open_output_stream(path)


def open_read(uri: str):
    """A seekable binary input stream."""
    if (path := local_path(uri)) is not None:
        return open(path, "rb", buffering=1 << 20)
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    return store.open_input_file(path)


def rename(source: str, target: str) -> None:
    """Put a finished file in its place at once, over what another attempt of the task left there."""
    if (path := local_path(source)) is not None:
        os.replace(path, local_path(target))
        return
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(source)
    store.move(path, fs.FileSystem.from_uri(target)[1])
