"""Pair features: string, blocking, entity-relative, address and country features, 36 in all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions.similarity import KERNELS, kernels, text_features
from linkloom.functions.text import address_parts
from linkloom.operators.blocking import SCORES, normalized, pool_of
from linkloom.runtime import make_importable

TEXT = [*KERNELS, "levenshtein", "len_diff", "norm_len_diff", "token_count_diff", "exact_match"]
BLOCKING = [*SCORES.values(), "total_block_score", "candidate_rank"]
RELATIVE = ["block_score_diff", "block_score_ratio", "is_best_addr", "is_best_name"]
ADDRESS = ["unit_match", "unit_mismatch", "first_num_match", "first_num_mismatch", "num_overlap_count", "num_jaccard"]
FEATURE_COLUMNS = [*[f"name_{x}" for x in TEXT], *[f"addr_{x}" for x in TEXT], *BLOCKING, *RELATIVE, *ADDRESS, "country_match"]


def first_by_id(df: DataFrame, order: list) -> DataFrame:
    """One row an id: the first in ``order``."""
    rn = F.row_number().over(Window.partitionBy("entity_id").orderBy(*order))
    return df.withColumn("_rn", rn).where("_rn = 1").drop("_rn")


def flag(c: Column) -> Column:
    return F.when(c, 1.0).otherwise(0.0).cast("float")


def address_features(a: Column, b: Column) -> dict[str, Column]:
    """From raw addresses."""
    return part_features(address_parts(a), address_parts(b))


def part_features(a: Column, b: Column) -> dict[str, Column]:
    """From ``address_parts``."""
    ua, ub, na, nb, fa, fb = a["units"], b["units"], a["numbers"], b["numbers"], a["first_number"], b["first_number"]
    has_units = (F.size(ua) > 0) & (F.size(ub) > 0)
    both, either = F.size(F.array_intersect(na, nb)), F.size(F.array_union(na, nb))
    return {
        "unit_match": flag(has_units & F.arrays_overlap(ua, ub)),
        "unit_mismatch": flag(has_units & ~F.arrays_overlap(ua, ub)),
        "first_num_match": flag(F.coalesce(fa == fb, F.lit(False))),
        "first_num_mismatch": flag(F.coalesce(fa != fb, F.lit(False))),
        "num_overlap_count": both.cast("float"),
        "num_jaccard": F.when(either > 0, both / either).otherwise(0.0).cast("float"),
    }


def country_match(a: Column, b: Column) -> Column:
    x, y = (F.lower(F.trim(F.coalesce(c, F.lit("")))) for c in (a, b))
    return flag((x == y) & (x != ""))


def relative_features(df: DataFrame, group: str = "source1_entity_id") -> DataFrame:
    """Against the best of the record's candidates in ``df``, ties included."""
    w = Window.partitionBy(group)
    best = {c: F.max(c).over(w) for c in ("total_block_score", "address_idf_score", "name_idf_score")}
    total = F.col("total_block_score")
    df = df.withColumns({f"_{k}": v for k, v in best.items()})
    is_best = lambda c: flag((F.col(c) == F.col(f"_{c}")) & (F.col(f"_{c}") > 0))
    return df.withColumns({
        "block_score_diff": (F.col("_total_block_score") - total).cast("float"),
        "block_score_ratio": (total / F.greatest(F.col("_total_block_score"), F.lit(1e-4).cast("float"))).cast("float"),
        "is_best_addr": is_best("address_idf_score"),
        "is_best_name": is_best("name_idf_score"),
    }).drop(*[f"_{k}" for k in best])


def with_records(pairs: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    """Both records of each pair as structs ``a`` and ``b``; pairs without one fall out. Of rows that repeat an id the first as read counts, in the pool that of the earlier source."""
    make_importable(pairs.sparkSession)
    pool = pool if "src_priority" in pool.columns else pool.withColumn("src_priority", F.lit(0))
    record = ["business_name", "business_address", "country", "name_norm", "addr_norm"]
    row = F.monotonically_increasing_id()
    a = first_by_id(normalized(s1).withColumn("_row", row), ["_row"]).select(F.col("entity_id").alias("source1_entity_id"), F.struct(*record).alias("a"))
    b = first_by_id(normalized(pool).withColumn("_row", row), ["src_priority", "_row"]).select(F.col("entity_id").alias("candidate_entity_id"), F.struct(*record).alias("b"))
    return pairs.join(a, "source1_entity_id").join(b, "candidate_entity_id")


def compute_features(pairs: DataFrame, s1: DataFrame, s2: DataFrame, s3: DataFrame) -> DataFrame:
    """The 36 features of each pair, in their order, after the ids; ``label`` stays if there is one.

    Columns of blocking that ``pairs`` lacks are 0.
    """
    both = with_records(pairs, s1, pool_of(normalized(s2), normalized(s3)))
    for c in BLOCKING:
        both = both.withColumn(c, F.col(c).cast("float") if c in pairs.columns else F.lit(0.0).cast("float"))
    both = both.withColumn("_name", kernels(F.col("a.name_norm"), F.col("b.name_norm"))).withColumn("_addr", kernels(F.col("a.addr_norm"), F.col("b.addr_norm")))
    both = both.withColumns(
        text_features(F.col("a.name_norm"), F.col("b.name_norm"), "name", F.col("_name"))
        | text_features(F.col("a.addr_norm"), F.col("b.addr_norm"), "addr", F.col("_addr"))
        | address_features(F.col("a.business_address"), F.col("b.business_address"))
        | {"country_match": country_match(F.col("a.country"), F.col("b.country"))}
    )
    label = [F.col("label").cast("int").alias("label")] if "label" in pairs.columns else []
    return relative_features(both).select("source1_entity_id", "candidate_entity_id", *FEATURE_COLUMNS, *label)
