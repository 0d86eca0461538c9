"""Sinks: list files, Parquet tables, chunk checkpoints with a manifest, and their merge."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.text import path_safe
from linkloom.operators.blocking import CANDIDATE_COLUMNS, BlockingConfig, build_candidates, chunks, normalized, pool_of
from linkloom.sources.readers import is_valid_table

FIXED = {"source1_entity_id", "candidate_entity_id", "candidate_rank"}


def write_text_table(df: DataFrame, path: str, single: bool = False) -> None:
    """Tab-separated with a header. ``single``: one file, which all rows then pass through one task for."""
    out = df.coalesce(1) if single else df
    out.write.mode("overwrite").options(sep="\t", header=True, quote='"', escape='"', emptyValue="").csv(path)


def write_table(df: DataFrame, path: str) -> None:
    """Parquet with zstd; an empty table is written with its schema."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def fingerprint(*parts) -> str:
    """Names a cache by what went into it."""
    return uuid.uuid5(uuid.NAMESPACE_OID, json.dumps(parts, sort_keys=True, default=str)).hex[:12]


def cached(spark: SparkSession, path: str, columns: set[str], make) -> DataFrame:
    """The table at ``path`` if it is valid, else what ``make`` gives, written there."""
    if not is_valid_table(spark, path, columns):
        write_table(make(), path)
    return spark.read.parquet(path)


def write_chunks(s1: DataFrame, s2: DataFrame, s3: DataFrame, folder: str, machine_id: int = 0, machines: int = 1, chunk_size: int = 25000, config: BlockingConfig = BlockingConfig()) -> DataFrame:
    """Candidates of this machine's chunks, a folder each under a fingerprint of the settings; finished chunks are skipped.

    Returns the manifest rows: country, chunk_id, machine_id, rows, candidate_rows, status,
    seconds, path. The chunk list is small: a row per ``chunk_size`` records.
    """
    spark = s1.sparkSession
    machines = max(1, machines)
    machine_id = min(max(0, machine_id), machines - 1)
    chunk_size = max(1, chunk_size)
    s1, s2, s3 = normalized(s1), normalized(s2), normalized(s3)
    dealt = chunks(s1, pool_of(s2, s3), chunk_size, machines)
    root = f"{folder}/{fingerprint(config, chunk_size)}"
    mine = dealt.where(F.col("machine_id") == machine_id).groupBy(path_safe(F.col("country")).alias("safe"), "country", "chunk_id").count().orderBy("chunk_id")
    manifest = []
    for r in mine.toLocalIterator():
        path = f"{root}/country={r['safe']}/chunk_{r['chunk_id']:06d}.parquet"
        row = {"country": r["country"], "chunk_id": r["chunk_id"], "machine_id": machine_id, "rows": r["count"], "candidate_rows": None, "seconds": None, "path": path}
        if is_valid_table(spark, path, FIXED):
            manifest.append(row | {"status": "skipped_existing"})
            continue
        began = time.time()
        ids = dealt.where(F.col("chunk_id") == r["chunk_id"]).select("country", "entity_id")
        own, pool2, pool3 = (df.where(F.col("country") == r["country"]) for df in (s1, s2, s3))  # weights are counted by country
        write_table(build_candidates(own.join(ids, ["country", "entity_id"], "left_semi"), pool2, pool3, config), path)
        manifest.append(row | {"status": "complete", "candidate_rows": spark.read.parquet(path).count(), "seconds": round(time.time() - began, 3)})
    schema = "country string, chunk_id long, machine_id int, rows long, candidate_rows long, status string, seconds double, path string"
    out = spark.createDataFrame([tuple(x[c.split()[0]] for c in schema.split(", ")) for x in manifest], schema)
    out.coalesce(1).write.mode("overwrite").json(f"{root}/manifest/machine={machine_id}")
    return out


def merge_chunks(spark: SparkSession, folder: str, out: str, expected_machines: int | None = None, require_all: bool = False, config: BlockingConfig = BlockingConfig(), chunk_size: int = 25000) -> DataFrame:
    """All finished chunks as one table. ``require_all``: a manifest of each of the expected machines must be there."""
    root = f"{folder}/{fingerprint(config, max(1, chunk_size))}"
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/country=*/chunk_*.parquet")
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    paths = sorted(str(x.getPath()) for x in found or [])
    if not paths:
        raise FileNotFoundError(f"no chunks under {root}")
    bad = [p for p in paths if not is_valid_table(spark, p, FIXED)]
    if bad:
        raise RuntimeError(f"unfinished chunks: {bad}")
    if require_all:
        names = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/manifest/machine=*")
        there = len(names.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(names) or [])
        if expected_machines is not None and there < expected_machines:
            raise RuntimeError(f"manifests of {there} machines, {expected_machines} expected")
    write_table(spark.read.parquet(*paths).select(*CANDIDATE_COLUMNS), out)
    return spark.read.parquet(out)
