"""What operators need of the cluster: this package on the workers' path, and tables written once in the shared folder."""

from __future__ import annotations

import atexit
import ctypes
import gc
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def make_importable(spark: SparkSession) -> None:
    """Puts the package's folder on the workers' path; a cluster without that folder ships the package with ``--py-files``."""
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in have:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, have)])


def reuse_blocks() -> None:
    """In a worker: blocks up to 16 MB are reused, since mapping each anew costs more than filling it."""
    try:
        libc = ctypes.CDLL("libc.so.6")
        libc.mallopt(-3, 16 << 20)  # M_MMAP_THRESHOLD
        libc.mallopt(-1, 64 << 20)  # M_TRIM_THRESHOLD
    except (OSError, AttributeError):  # another C library
        pass


def pieces(batches, rows: int = 512):
    """Arrow batches in a worker, ``rows`` at a time."""
    reuse_blocks()
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


_WRITTEN: list[tuple[SparkSession, str]] = []


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``df`` as a table in the folder that ``spark.checkpoint.dir`` names: what is read more than once is computed once, and outlives executors."""
    spark = df.sparkSession
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is unset: working tables need a folder that driver and executors share")
        if not hasattr(written, "own"):
            written.own = tempfile.mkdtemp(prefix="linkloom-")
            atexit.register(shutil.rmtree, written.own, True)
        shared = f"file://{written.own}"
    path = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _WRITTEN.append((spark, path))
    df.write.parquet(path, compression=codec)
    gc.collect()
    spark._jvm.System.gc()  # shuffle files of what is now a table go when the driver's heap is collected
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def discard(table: DataFrame) -> None:
    """Deletes what ``written`` has given, once nothing reads it any more."""
    _delete(table.sparkSession, table.written_at)
    _WRITTEN.remove((table.sparkSession, table.written_at))


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@atexit.register
def _clean() -> None:
    for spark, path in _WRITTEN:
        try:
            _delete(spark, path)
        except Exception:  # the JVM has gone: the folder's owner clears it
            pass
