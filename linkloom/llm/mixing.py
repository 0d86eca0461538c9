"""Mixing sources to target weights by capped water-filling.

Sources share a budget of words by weight. A source whose share is above ``max_epochs`` times
its size is clamped there and the excess goes to the others by weight, until no share is above.
A source then gives each document whole repetitions (the integer part of share / size), and
the documents first in a seeded order once more, until the fraction is spent.

Defined results: a null text has size 0; a null source is a source of its own, last in order;
rows with the same id are taken alike (rows without one by their text); a source without words
gets the target 0; an empty table gives an empty one; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.llm.prefix import prefix_sums
from linkloom.llm.shared import Workspace, n_words

#: Bits of the seeded key, and of its leading part by which words are added up first.
KEY_BITS, LEAD_BITS = 60, 12


def seeded_key(seed: int) -> Column:
    """A long below 2**60 that orders documents at random, the same on each run and in SQL."""
    by = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("t"), F.coalesce(F.col("text"), F.lit(""))))
    return F.conv(F.substring(F.md5(F.concat(by, F.lit(f"|{seed}"))), 1, KEY_BITS // 4), 16, 10).cast("long")


def cycle_weights(cycle: list[float]) -> Callable[[Column], Column]:
    """Weights that repeat along the order of the sources."""
    return lambda place: F.element_at(F.array(*[F.lit(float(x)) for x in cycle]), (F.pmod(place, F.lit(len(cycle))) + 1).cast("int"))


def fill(sources: DataFrame, budget: float, max_epochs: float) -> float:
    """Words for each unit of weight once clamping has settled; one row reaches the driver each round."""
    cap = F.col("source_size") * max_epochs
    level = 0.0
    while True:
        clamped = cap <= F.col("weight") * level
        free, spent = sources.agg(F.sum(F.when(~clamped, F.col("weight"))), F.sum(F.when(clamped, cap))).first()
        if not free:
            return level
        now = (budget - (spent or 0.0)) / free
        if now <= level:
            return level
        level = now


def plan_mix(sized: DataFrame, weights: Callable[[Column], Column], ws: Workspace, budget_ratio: float, max_epochs: float) -> DataFrame:
    """A row per source: source_size, target, ``whole`` repetitions and ``cut``, the last key that gets one more.

    ``sized`` has source, size and key. Words are summed by source and leading bits of the key,
    so a hot source is cut in 4096 parts; only the part where the cut falls is ordered by row.
    """
    sources = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    sources = prefix_sums(sources, [F.col("source").asc_nulls_last()], "source_size", ws, "sources").withColumn("weight", weights(F.col("row"))).drop("before", "row")
    sources = ws.save(sources, "weighted")
    budget = budget_ratio * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level = fill(sources, budget, max_epochs)
    size = F.col("source_size")
    sources = sources.withColumn("target", F.least(size * F.lit(float(max_epochs)), F.col("weight") * level))
    sources = sources.withColumn("whole", F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("int"))
    sources = ws.save(sources.withColumn("need", F.col("target") - F.col("whole") * size), "targets")

    lead = F.shiftright("key", KEY_BITS - LEAD_BITS)
    parts = sized.groupBy("source", lead.alias("lead")).agg(F.sum("size").alias("words"))
    so_far = F.coalesce(F.sum("words").over(Window.partitionBy("source").orderBy("lead").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    need = sources.where("need > 0").select(F.col("source").alias("_source"), "need")
    same = F.col("source").eqNullSafe(F.col("_source"))
    at = parts.withColumn("ahead", so_far).join(need, same).where("ahead < need and need <= ahead + words").drop("source", "words")
    at = ws.save(at.withColumnRenamed("lead", "_lead"), "crossing")
    inside = sized.withColumn("lead", lead).join(at, same & (F.col("lead") == F.col("_lead")))
    run = Window.partitionBy("_source").orderBy("key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    tie = Window.partitionBy("_source", "key")
    inside = inside.withColumn("middle", F.col("ahead") + F.sum("size").over(run) - F.sum("size").over(tie) / 2)
    last = inside.groupBy("_source").agg(
        F.coalesce(F.max(F.when(F.col("middle") <= F.col("need"), F.col("key"))), F.shiftleft(F.first("_lead"), KEY_BITS - LEAD_BITS) - 1).alias("cut")
    )
    out = sources.join(last, same, "left").drop("_source", "weight", "need")
    return ws.save(out, "plan")


def times_taken() -> Column:
    return F.col("whole") + F.when(F.col("key") <= F.col("cut"), 1).otherwise(0)


def mix(docs: DataFrame, weights: Callable[[Column], Column], budget_ratio: float = 1.5, max_epochs: float = 2.0, seed: int = 3) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, size, key of every document; the plan by source)."""
    ws = Workspace(docs.sparkSession, "mixing")
    sized = ws.save(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), seeded_key(seed).alias("key")), "sized")
    return sized, plan_mix(sized, weights, ws, budget_ratio, max_epochs)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document a mix at weights 3, 1, 2 takes."""
    sized, plan = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"), cycle_weights([3, 1, 2]))
    plan = plan.withColumnRenamed("source", "_source")
    return sized.join(plan, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * times_taken()).cast("long").alias("taken")
    )


def mixing_stage(docs: DataFrame) -> DataFrame:
    """The rows of the mix: a document taken twice is there twice."""
    _, plan = mix(docs, cycle_weights([3, 1, 2]))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    keyed = docs.select(row, F.col("source").alias("_of"), seeded_key(3).alias("key"))
    plan = plan.select(F.col("source").alias("_source"), "whole", "cut")
    taken = keyed.join(plan, F.col("_of").eqNullSafe(F.col("_source"))).where(times_taken() > 0)
    taken = taken.select("_row", F.explode(F.array_repeat(F.lit(0), times_taken())).alias("_again"))
    return taken.select(*[F.col(f"_row.`{c}`") for c in docs.columns])


_LEVELS = 64
OP3_SQL = rf"""
with recursive d as (
  select doc_id, source, cast(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) as bigint) as size,
    cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), 't' || coalesce(text, '')) || '|3'), 1, 15) as bigint) as key
  from documents),
s0 as (select source, cast(sum(size) as bigint) as source_size from d group by source),
s as (select *, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 3.0 when 1 then 1.0 else 2.0 end::double as weight from s0),
b as (select 1.5::double * sum(source_size) as budget from s),
lv as (select 0 as i, 0.0::double as level
  union all
  select i + 1, (select coalesce((max(b.budget) - coalesce(sum(case when 2.0 * source_size <= weight * lv.level then 2.0 * source_size end), 0.0))
      / sum(case when 2.0 * source_size > weight * lv.level then weight end), lv.level) from s, b)
  from lv where i < {_LEVELS}),
t as (select *, least(2.0::double * source_size, weight * (select max(level) from lv)) as target from s),
n as (select *, case when source_size > 0 then floor(target / source_size) else 0 end as whole from t),
r as (select d.*, n.source_size, n.target, n.whole, n.target - n.whole * n.source_size as need,
    sum(size) over (partition by d.source order by key range between unbounded preceding and current row)
      - sum(size) over (partition by d.source, key) / 2.0 as middle
  from d join n on d.source is not distinct from n.source)
select doc_id, size, source_size, target, cast(size * (whole + case when need > 0 and middle <= need then 1 else 0 end) as bigint) as taken from r
"""
