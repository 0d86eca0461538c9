"""Things all operators of this package share: working tables, bounded bitmaps, batches.

Working tables are Parquet under the folder that ``spark.checkpoint.dir`` names, which
driver and executors share, so a lost executor costs a re-read and no recomputation.
"""

from __future__ import annotations

import atexit
import ctypes
import gc
import tempfile
import uuid
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.runtime import make_importable

#: Fixed by the contracts: what separates words.
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"

_LEFT: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; where it is unset and all runs on this machine (tests), a folder of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is unset: working tables need a folder that driver and executors share")
        named = getattr(shared_folder, "own", None)
        if named is None:
            named = shared_folder.own = "file://" + tempfile.mkdtemp(prefix="linkloom-")
    return named.rstrip("/")


class Workspace:
    """Working tables of one call. ``drop`` removes one early, the rest goes when the driver ends."""

    def __init__(self, spark: SparkSession, name: str):
        make_importable(spark)
        small_batches(spark)
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        _LEFT.append((spark, self.root))

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str, **options) -> DataFrame:
        """Writes ``df`` and reads it again: a cut of the lineage that survives executors."""
        writer = df.write.mode("overwrite")
        for k, v in options.items():
            writer = writer.option(k, v)
        writer.parquet(self.path(name))
        return self.read(name, df)

    def read(self, name: str, like: DataFrame | None = None) -> DataFrame:
        reader = self.spark.read
        return (reader.schema(like.schema) if like is not None else reader).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            delete(self.spark, self.path(name))


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@atexit.register
def _clean() -> None:
    for spark, root in _LEFT:
        try:
            if spark.sparkContext._jsc is not None:
                delete(spark, root)
            elif root.startswith("file://"):
                import shutil

                shutil.rmtree(root.removeprefix("file://"), ignore_errors=True)
        except Exception:  # the JVM has gone: the folder's owner clears it
            pass


# --- memory of Python workers -----------------------------------------------------------

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of 1,000 rows in place of Spark's default of 10,000: whole texts are in them, in the JVM and in Python. Another setting stays."""
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, "1000")


def _lean() -> None:
    """What this worker frees goes back to the system, all of it after a task and large blocks at once; Arrow keeps none.

    Blocks up to 16 MB are reused within a task: mapping each anew costs more than filling it.
    """
    pa.set_memory_pool(pa.system_memory_pool())
    try:
        libc = ctypes.CDLL("libc.so.6")
        libc.mallopt(-3, 16 << 20)  # M_MMAP_THRESHOLD
        libc.mallopt(-1, 64 << 20)  # M_TRIM_THRESHOLD
    except (OSError, AttributeError):  # another C library: memory is kept for later batches
        pass


def _trim() -> None:
    gc.collect()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def lean_map(rows):
    """For mapInArrow: ``rows`` in a worker that holds on to no memory between tasks."""

    @wraps(rows)
    def work(batches):
        _lean()
        yield from rows(batches)
        _trim()

    return work


def lean_group(work):
    """For applyInArrow: likewise; memory is handed back after large groups."""

    @wraps(work)
    def lean(table: pa.Table) -> pa.Table:
        _lean()
        out = work(table)
        if table.nbytes > 1 << 20:
            _trim()
        return out

    return lean


def flat(column: pa.ChunkedArray, dtype) -> np.ndarray:
    """All bytes of a binary column, one value after the other, as numbers."""
    parts = []
    for x in column.chunks:
        if len(x) and x.buffers()[2] is not None:
            at = np.frombuffer(x.buffers()[1], np.int64 if pa.types.is_large_binary(x.type) else np.int32)
            lo, hi = int(at[x.offset]), int(at[x.offset + len(x)])
            parts.append(np.frombuffer(x.buffers()[2], np.uint8)[lo:hi])
    return np.concatenate(parts).view(dtype) if parts else np.zeros(0, dtype)


def words(text: Column) -> Column:
    """Array of the words of ``text``; null and blank texts have none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE + "+"))


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for each row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def estimated_bytes(df: DataFrame) -> int:
    """What the optimizer takes for the size of ``df``; no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


# --- a bounded set of keys, as bitmaps --------------------------------------------------

BITMAP_BITS = 32768


def bitmap(keys: DataFrame, key: str, bits: int = 1 << 26) -> DataFrame:
    """(slot, bits) of a one-hash Bloom filter over the long column ``key``.

    At most ``bits`` / 8 bytes whatever the number of keys (8 MB at the default), hence safe
    to broadcast. A full filter lets more rows through; it never loses one.
    """
    at = F.pmod(F.xxhash64(F.col(key)), F.lit(bits))
    return (
        keys.select(at.alias("at"))
        .groupBy(F.floor(F.col("at") / BITMAP_BITS).cast("int").alias("slot"))
        .agg(F.expr(f"bitmap_construct_agg(at % {BITMAP_BITS})").alias("bitmap"))
    )


def maybe_in(df: DataFrame, key: Column, filter_: DataFrame, bits: int = 1 << 26) -> DataFrame:
    """Adds boolean ``_ll_maybe``: false only where ``key`` is certainly not in the set."""
    filter_ = filter_.select(F.col("slot").alias("_bm_slot"), F.col("bitmap").alias("_bm_bits"))
    at = df.withColumn("_bm_at", F.pmod(F.xxhash64(key), F.lit(bits)))
    at = at.withColumn("_bm_slot", F.floor(F.col("_bm_at") / BITMAP_BITS).cast("int"))
    byte = F.expr(f"cast(conv(hex(substring(_bm_bits, cast((_bm_at % {BITMAP_BITS}) div 8 + 1 as int), 1)), 16, 10) as int)")
    hit = F.coalesce(byte.bitwiseAND(F.expr("shiftleft(1, cast(_bm_at % 8 as int))")) != 0, F.lit(False))
    return at.join(F.broadcast(filter_), "_bm_slot", "left").withColumn("_ll_maybe", hit).drop("_bm_slot", "_bm_at", "_bm_bits")
