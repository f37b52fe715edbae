"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest object, in bytes, that an operator here broadcasts. Callers check before they broadcast.
BROADCAST_LIMIT = 64 << 20
#: Bytes of text that one Python-side block holds at most (a longer document forms a block of its own).
BLOCK_BYTES = 8 << 20
#: Byte table that lower-cases A-Z and nothing else.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: The separators of ``[^\x20\x09-\x0D]+`` are exactly what ``bytes.split()`` splits on.
WORD_RE = "[^\\x20\\x09-\\x0D]+"
SPACE_RE = "[\\x20\\x09-\\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a folder under the warehouse is used if all runs in one process
    (``local[*]``); a cluster without the setting is an error.
    """
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        where = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return where.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the application ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(p.getParent())
    fs.deleteOnExit(p)
    return path


#: Spark then removes a write's shuffle files when it has ended: nothing reads them again.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: the lineage ends there."""
    spark = df.sparkSession
    path = path or scratch(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def near(table: DataFrame, *columns: str) -> DataFrame:
    """A materialized table (or columns of it) as the hashed side of a join: broadcast if its
    files are below an eighth of BROADCAST_LIMIT, shuffled with the other side if not."""
    spark = table.sparkSession
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table._scratch)
    size = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()
    some = table.select(*columns) if columns else table
    return F.broadcast(some) if size <= BROADCAST_LIMIT // 8 else some.hint("shuffle_hash")


def release(*tables: DataFrame) -> None:
    """Remove :func:`materialize`'s files of tables that no pending plan reads any more."""
    for t in tables:
        drop_scratch(t.sparkSession, t._scratch)


#: Bytes of a row of a task's sketch.
PIECE = 1 << 16


def sum_sketch(df: DataFrame, run, size: int, *, either: bool = False) -> np.ndarray:
    """The sum (``either``: the bitwise or) of the arrays of ``size`` that ``run`` yields from the batches of each task of ``df``.

    Arrays travel in pieces, those of neighbouring tasks are combined first, and then the
    results: a task reads pieces of about the square root of the number of tasks. Sums come
    back in 64 bits, ``or`` in bytes; the size must be bounded by the caller.
    """
    wide = "u1" if either else "<u8"
    step = min(size, PIECE)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        for array in run(batches):
            pieces = array.astype(wide).reshape(-1, step)
            for i in np.flatnonzero(pieces.any(axis=1)).tolist():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([task], pa.int32()), pa.array([squeeze(pieces[i])], pa.binary())], ["piece", "task", "data"])

    def merge(table: pa.Table) -> pa.Table:
        total = np.zeros(step, wide)
        for x in table.column("data"):
            piece = expand(x.as_py(), wide)
            total = total | piece if either else total + piece
        return pa.Table.from_arrays([table.column("piece")[:1].combine_chunks(), table.column("task")[:1].combine_chunks(), pa.array([squeeze(total)], pa.binary())], ["piece", "task", "data"])

    schema = "piece int, task int, data binary"
    parts = df.mapInArrow(cut, schema)
    near = parts.groupBy("piece", F.floor(F.sqrt(F.col("task").cast("double"))).alias("near")).applyInArrow(merge, schema)
    out = np.zeros((size // step, step), wide)
    for r in near.groupBy("piece").applyInArrow(merge, schema).collect():
        out[r.piece] = expand(r.data, wide)
    return out.ravel()


def squeeze(values: np.ndarray) -> bytes:
    """Unsigned integers as compressed byte planes (high planes are mostly zeros)."""
    import zstandard

    values = np.ascontiguousarray(values)
    return zstandard.ZstdCompressor(level=1).compress(values.view("u1").reshape(-1, values.itemsize).T.tobytes())


def expand(packed: bytes, kind: str) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), "u1").reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a scratch path that no pending plan reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def file_bytes(path: str) -> bytes:
    """A vocabulary file, read on the driver; its size is checked before it is broadcast."""
    size = os.path.getsize(path)
    if size > BROADCAST_LIMIT:
        raise ValueError(f"{path} has {size} bytes; a vocabulary of at most {BROADCAST_LIMIT} can be broadcast")
    with open(path, "rb") as f:
        return f.read()


def text_blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches of at most ``limit`` bytes of column ``text`` (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = batch.column("text").nbytes
        if size <= limit or batch.num_rows == 1:
            yield batch
            continue
        import pyarrow.compute as pc

        sizes = np.nan_to_num(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype("f8")).astype("i8")
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        yield batch.slice(start)


_KEPT: dict[tuple, object] = {}


def kept(*key, build=None):
    """What a worker process keeps from task to task: one object, the last asked for.

    Workers serve one operator after another; each calls this first, so that none holds the
    memory of the one before it.
    """
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = build() if build else None
    return _KEPT[key]


def list_array(values: np.ndarray, lengths, kind: pa.DataType) -> pa.ListArray:
    """A list column from flat values and the length of each row."""
    offsets = np.zeros(len(lengths) + 1, "i4")
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def text_bytes(batch: pa.RecordBatch) -> list[bytes]:
    """The texts of a batch in UTF-8; null is empty."""
    column = batch.column("text").cast(pa.binary() if batch.column("text").type == pa.string() else pa.large_binary())
    return [x or b"" for x in column.to_pylist()]


class WordHash(dict):
    """word (bytes) -> 64-bit hash, remembered; forgets all when it holds ``limit`` words."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (bijective), so that sums of products spread over all bits."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """The hashes of all k-word windows of a hashed word sequence, in order.

    A sequence of fewer words gives one hash of the whole sequence; none gives none.
    """
    if not len(h):
        return h
    k = min(k, len(h))
    n = len(h) - k + 1
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = mix(out + h[i : i + n] + np.uint64(0x632BE59BD9B4E019))
    return out
