"""Helpers shared by the training-data operators: shared storage, Arrow blocks, hashing."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as the contracts define it: 0x20 and 0x09-0x0D.
SPACE_RE = r"[\x20\x09-\x0D]+"
#: UTF-8 bytes that one numpy pass works on; a longer document is a block of its own.
BLOCK_BYTES = 1 << 20

_made: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only where the session names none and runs on one machine (a test) a local folder is set.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        if held.isDefined():
            where = held.get()
        else:
            if spark.sparkContext.master.split("[")[0] != "local":
                raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
            where = "file://" + tempfile.mkdtemp(prefix="factweave-")
            spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path through the file system that Spark uses for it."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _clean() -> None:
    for spark, path in _made:
        try:
            remove(spark, path)
        except Exception:  # the session has ended: the folder's owner cleans up
            pass


atexit.register(_clean)


def scratch(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/factweave-{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read again: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("parquet.block.size", 16 << 20).parquet(path)  # a writer holds a row group in memory
    out = spark.read.schema(df.schema).parquet(path)
    out._stash = path
    return out


def drop_stash(df: DataFrame) -> None:
    """Free a stash that no later read needs."""
    path = getattr(df, "_stash", None)
    if path:
        remove(df.sparkSession, path)


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python some megabytes at a time, however long they are (a session's own lower limits stay)."""
    for key, most in (("spark.sql.execution.arrow.maxBytesPerBatch", 2 << 20), ("spark.sql.execution.arrow.maxRecordsPerBatch", 2000)):
        now = spark.conf.get(key).rstrip("bB")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def give_back() -> None:
    """Return a worker's freed memory to the system: idle workers stay alive between stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def fresh(df: DataFrame, name: str) -> str:
    """A column name made from ``name`` that ``df`` lacks."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name), F.lit(""))


# ---------------------------------------------------------------- byte blocks


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES, rows: int = 1024):
    """Yield (first row, buffer, offsets) for runs of rows of about ``limit`` bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    for first in range(0, len(column), rows):  # a slice at a time is copied
        part = column.slice(first, rows).cast(pa.large_binary()).fill_null(b"")
        n = len(part)
        _, offs, data = part.buffers()
        offs = np.frombuffer(offs, np.int64, n + 1, part.offset * 8)
        data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        at = 0
        while at < n:
            end = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
            yield first + at, data[offs[at] : offs[end]], offs[at : end + 1] - offs[at]
            at = end


_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_BASE = 0x9E3779B97F4A7C15 | 1
_table = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of a 64-bit hash: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * _M1
    h ^= h >> np.uint64(33)
    h = h * _M2
    return h ^ (h >> np.uint64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    if len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def spans_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of buf[start:end] for many spans in one pass (prefix sums of a polynomial)."""
    up, down = powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_table[buf] * up[: len(buf)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _M2)


def runs(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, none across a document's end, and each document's first run."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    edge = offs[1:-1]
    before[edge[edge < n]] = False
    after[edge[(edge > 0)] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


_byte = np.arange(256, dtype=np.uint8)
LOWER = np.where((_byte >= 65) & (_byte <= 90), _byte + 32, _byte).astype(np.uint8)
IS_SPACE = np.isin(_byte, [0x20, *range(0x09, 0x0E)])
