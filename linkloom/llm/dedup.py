"""Exact deduplication by a stream with disk-backed keyed state.

Rows stream as (digest, identifier, length, locator). The state of a digest, in RocksDB and
never expired, holds how many rows had it and the row to keep with its locator: the file and
the row in it. A hot digest is folded on the map side first, so its state sees a row per task.
Where a digest was hit again the full texts are compared: all texts under a digest are equal
if the least and the greatest are, and both are aggregates that fold before the shuffle. If a
digest does hold different texts, its rows are grouped by the text itself.

Texts are equal when identical without the characters of ``[\\x20\\x09-\\x0D]``. Of equal texts
the row with most code points in its original text stays, then the smallest id, then the
first by locator. Defined results: null counts as empty; a null id comes after all others;
repeated rows form one group of which one row stays; an empty table gives an empty one; other
columns are ignored (``dedup_stage`` passes them on, whatever their names; ``_ll_`` is reserved).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.shared import SPACE, Workspace, bitmap, maybe_in

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else some MB of disk for each partition of the state, however small
}
LAST_ID = (1 << 63) - 1


def bare(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE + "+", "")


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(bare(text), 256))


def located(docs: DataFrame, ws: Workspace) -> DataFrame:
    """``docs`` with ``_ll_file`` (hash of the path) and ``_ll_at`` (row in the file); written down first if it isn't read from files."""
    with_place = lambda df: df.select("*", F.xxhash64("_metadata.file_path").alias("_ll_file"), F.col("_metadata.row_index").alias("_ll_at"))
    try:
        return with_place(docs)
    except AnalysisException:
        return with_place(ws.save(docs, "documents"))


def best() -> Column:
    """What orders rows of a group; the greatest stays."""
    return F.struct(F.col("length"), (-F.coalesce(F.col("doc_id"), F.lit(LAST_ID))).alias("id"), (-F.col("_ll_file").cast("decimal(20,0)")).alias("file"), (-F.col("_ll_at")).alias("at"))


def run_state(staged: DataFrame, path: str, ws: Workspace, bytes_per_batch: int) -> DataFrame:
    """(digest, keep, group_size) after all of ``path`` has gone through the stream."""
    spark = ws.spark
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        rows = spark.readStream.schema(staged.schema).option("maxBytesPerTrigger", bytes_per_batch).parquet(path)
        state = rows.groupBy("digest").agg(F.max(best()).alias("keep"), F.count(F.lit(1)).alias("group_size"))

        def put(batch: DataFrame, number: int) -> None:  # rerun after a failure, it writes the same folder again
            batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(ws.path(f"states/n={number}"))

        query = state.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", ws.path("stream")).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    schema = state.withColumn("batch", F.lit(0)).schema
    states = spark.read.schema(schema).parquet(ws.path("states")) if query.lastProgress else spark.createDataFrame([], schema)
    # a digest was told anew in each batch that had it
    return states.groupBy("digest").agg(F.max(F.struct("batch", "keep", "group_size")).alias("s")).select("digest", "s.keep", "s.group_size")


def dedup(placed: DataFrame, ws: Workspace, digest=digest_of, bytes_per_batch: int = 4 << 30) -> DataFrame:
    """A row per row of ``placed`` (from ``located``): doc_id, _ll_file, _ll_at, length, digest, keep, group_size."""
    staged = placed.select("doc_id", "_ll_file", "_ll_at", F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("length"), digest(F.col("text")).alias("digest"))
    staged = ws.save(staged, "staged")
    final = ws.save(run_state(staged, ws.path("staged"), ws, bytes_per_batch), "final")
    hits = final.where("group_size > 1")
    found = staged.join(final, "digest")

    # full bytes of the rows under each digest that was hit; a bitmap keeps other texts out of the shuffle
    place = F.xxhash64("_ll_file", "_ll_at")
    again = ws.save(staged.join(hits.select("digest"), "digest", "left_semi").select(place.alias("place")), "hits")
    texts = maybe_in(placed.select("text", "_ll_file", "_ll_at"), place, bitmap(again, "place")).where("_ll_maybe")
    texts = texts.select("_ll_file", "_ll_at", digest(F.col("text")).alias("digest"), bare(F.col("text")).alias("full"))
    differ = texts.groupBy("digest").agg(F.min("full").alias("a"), F.max("full").alias("b")).where("a <> b").select("digest")
    differ = ws.save(differ, "differ")
    if differ.isEmpty():
        return found
    apart = texts.join(differ, "digest", "left_semi").join(staged.select("doc_id", "_ll_file", "_ll_at", "length"), ["_ll_file", "_ll_at"])
    groups = apart.groupBy("digest", "full").agg(F.max(best()).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    apart = apart.join(groups, ["digest", "full"]).drop("full")
    return ws.save(found.join(differ, "digest", "left_anti").unionByName(apart.select(found.columns)), "found")


def is_kept() -> Column:
    return (F.col("keep.file") == -F.col("_ll_file").cast("decimal(20,0)")) & (F.col("keep.at") == -F.col("_ll_at"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stands for its text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    keep_id = F.when(F.col("keep.id") != -LAST_ID, -F.col("keep.id"))
    ws = Workspace(spark, "dedup")
    return dedup(located(docs, ws), ws).select(
        "doc_id", keep_id.alias("keep_id"), "group_size", is_kept().alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def dedup_stage(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts, with the columns of ``docs``.

    Rows alone in their group pass by the bitmap; only those that it may hold are shuffled.
    """
    ws = Workspace(docs.sparkSession, "dedup")
    placed = located(docs, ws)
    rows = ws.save(dedup(placed, ws).where("group_size > 1").select(F.xxhash64("_ll_file", "_ll_at").alias("place"), "_ll_file", "_ll_at", is_kept().alias("kept")), "groups")
    place = F.xxhash64("_ll_file", "_ll_at")
    marked = maybe_in(placed, place, bitmap(rows, "place"))
    dropped = rows.where("not kept").select("_ll_file", "_ll_at")
    sure = marked.where("not _ll_maybe").drop("_ll_maybe")
    rest = marked.where("_ll_maybe").drop("_ll_maybe").join(dropped, ["_ll_file", "_ll_at"], "left_anti")
    return sure.unionByName(rest.select(sure.columns)).select(*[F.col(f"`{c}`") for c in docs.columns])


OP5_SQL = r"""
with t as (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) as text_sha256, length(coalesce(text, '')) as n from documents),
r as (select *, count(*) over (partition by text_sha256) as group_size, first_value(doc_id) over w as keep_id, row_number() over w as k from t
      window w as (partition by text_sha256 order by n desc, doc_id nulls last))
select doc_id, keep_id, group_size, k = 1 as kept, text_sha256 from r
"""
