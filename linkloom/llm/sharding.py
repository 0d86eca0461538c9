"""Sharding: contiguous shards of near equal bytes, cut from global prefix sums.

Rows are range-partitioned in the given order, partition totals give each row the bytes ahead
of it, and the row goes to the shard in whose share of all bytes its middle lies. A group of
equal rows that a cut would part goes to one side whole, as long as it is at most a hundredth
of a shard; a larger one is split, because sizes come first.

Defined results: null text counts as empty (8 bytes); equal rows, repeated ids and null ids
take places next to each other; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.prefix import prefix_sums
from linkloom.llm.shared import Workspace


def shard_by_bytes(df: DataFrame, size: str, n_shards: int, order: list[Column], ws: Workspace, group: str | None = None, slack: float = 0.01) -> DataFrame:
    """Adds ``shard`` and ``slot`` (place in the shard, gapless from 0)."""
    df = ws.save(prefix_sums(df, order, size, ws, "placed"), "prefixed")
    total = df.agg(F.sum(size)).first()[0] or 1
    share = lambda middle: F.least(F.lit(n_shards - 1), F.floor(middle * n_shards / total)).cast("int")
    df = df.withColumn("shard", share(F.col("before") + F.col(size) / 2))
    if group is not None:
        # a cut parts one group at most, so at most n_shards - 1 rows are broadcast
        parted = df.groupBy(group).agg(F.min("shard").alias("_a"), F.max("shard").alias("_b"), F.sum(size).alias("_all"), F.min("before").alias("_at"))
        parted = parted.where((F.col("_a") < F.col("_b")) & (F.col("_all") <= slack * total / n_shards)).select(group, share(F.col("_at") + F.col("_all") / 2).alias("_whole"))
        df = df.join(F.broadcast(parted), group, "left").withColumn("shard", F.coalesce("_whole", "shard")).drop("_whole")
    first = df.groupBy("shard").agg(F.min("row").alias("_first"))  # a row per shard
    return df.join(F.broadcast(first), "shard").withColumn("slot", F.col("row") - F.col("_first")).drop("before", "row", "_first")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes; equal texts lie side by side."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).cast("long").alias("text_crc32"), F.md5(text.cast("binary")).alias("same")
    )
    out = shard_by_bytes(docs, "size", 24, [F.col("same"), F.col("doc_id")], Workspace(spark, "sharding"), group="same")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"))


#: The 256 entries of the checksum's table come from its rule; a text's bytes are then folded one by one.
OP8_SQL = r"""
with recursive entry(i, c, k) as (
    select i, i, 0 from range(256) r(i)
    union all
    select i, case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end, k + 1 from entry where k < 8),
entries as (select list(c order by i) as e from entry where k = 8),
sized as (select doc_id, coalesce(text, '') as t, strlen(coalesce(text, '')) + 8 as size, md5(coalesce(text, '')) as same from documents),
placed as (select *, row_number() over w - 1 as row, sum(size) over w - size as before, sum(size) over () as total from sized window w as (order by same, doc_id nulls first rows unbounded preceding)),
cut as (select *, least(23, floor((before + size / 2) * 24 / total)) as own from placed),
grouped as (select *, min(own) over g as lo, max(own) over g as hi, sum(size) over g as whole, min(before) over g as start from cut window g as (partition by same)),
dealt as (select *, case when lo < hi and whole <= 0.01 * total / 24 then least(23, floor((start + whole / 2) * 24 / total)) else own end as shard from grouped)
select doc_id, size::bigint as size,
    xor(coalesce(list_reduce(list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda h: ('0x' || h)::bigint), lambda s, b: xor(s // 256, e[xor(s % 256, b) + 1]), 4294967295::bigint), 4294967295::bigint), 4294967295::bigint) as text_crc32,
    'bytes' as law, shard::int as shard, (row - min(row) over (partition by shard))::bigint as slot, null::int as grown_shard
from dealt, entries
"""
