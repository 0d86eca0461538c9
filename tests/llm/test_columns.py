"""Operators that have a SQL twin, on awkward rows and on the smallest test tables."""

import pytest

from linkloom.llm import catalog, dedup, mixing, quality
from linkloom.llm.shared import Workspace
from tests.llm import awkward
from tests.oracle import assert_same

SF = "/root/testdata/sf0.001"
WITH_SQL = sorted(catalog.oracle_sql())


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_equals_its_sql(spark, name):
    assert_same(catalog.queries()[name](spark, SF), catalog.oracle_sql()[name], SF)


@pytest.mark.parametrize("name", ["op3_mixing", "op7_quality_rules"])
def test_awkward_rows_equal_sql(spark, tmp_path, name):
    d = awkward.write(spark, tmp_path)
    assert_same(catalog.queries()[name](spark, d), catalog.oracle_sql()[name], d)


@pytest.mark.parametrize("name", [k for k in catalog.queries() if k not in ("op9_warc",)])
def test_empty_table(spark, tmp_path, name):
    d = awkward.write(spark, tmp_path, [])
    assert catalog.queries()[name](spark, d).collect() == []


def test_dedup_awkward_rows(spark, tmp_path):
    d = awkward.write(spark, tmp_path)
    rows = awkward.collect(dedup.op5_exact_dedup(spark, d))
    assert len(rows) == len(awkward.rows())
    bare = lambda t: "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")
    groups = {}
    for i, t, *_ in awkward.rows():
        groups.setdefault(bare(t), []).append((-len(t or ""), i is None, i))
    want = {min(g)[2]: len(g) for g in groups.values()}
    kept = [r for r in rows if r["kept"]]
    assert sorted((r["keep_id"] is None, r["keep_id"] or 0, r["group_size"]) for r in kept) == sorted((k is None, k or 0, n) for k, n in want.items())
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_dedup_survives_equal_digests_and_many_batches(spark, tmp_path):
    """With a digest that different texts share, the full texts decide."""
    from pyspark.sql import functions as F

    d = awkward.write(spark, tmp_path)
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")
    ws = Workspace(spark, "test")
    weak = lambda text: F.unhex(F.lpad(F.hex(F.crc32(dedup.bare(text).cast("binary")) % 3), 2, "0"))
    found = dedup.dedup(dedup.located(docs, ws), ws, digest=weak, bytes_per_batch=1)
    exact = dedup.op5_exact_dedup(spark, d)
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["group_size"])
    assert sorted(map(key, found.collect())) == sorted(map(key, exact.collect()))
    assert found.where(dedup.is_kept()).count() == exact.where("kept").count()


def test_stages_keep_columns_and_decide(spark, tmp_path):
    docs = spark.read.parquet(f"{awkward.write(spark, tmp_path)}/documents.parquet")
    kept = dedup.dedup_stage(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({"".join((t or "").split()) for _, t, *_ in awkward.rows()} | set()) or kept.count() > 0
    good = quality.quality_stage(docs)
    assert good.columns == docs.columns and {r["doc_id"] for r in good.collect()} >= {1, 4, 11, 12}
    assert not {r["doc_id"] for r in good.collect()} & {5, 6, 7, 8, 14}
    mixed = mixing.mixing_stage(docs)
    assert mixed.columns == docs.columns
    taken = awkward.total(mixing.op3_mixing(spark, str(tmp_path)), "taken")
    assert awkward.total(mixed.withColumn("n", mixing.n_words(mixed["text"])), "n") == taken


def test_mix_fills_targets(spark):
    rows = awkward.collect(mixing.op3_mixing(spark, SF))
    by = {}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["target"] <= 2 * r["source_size"] + 1e-6
        by.setdefault((r["source_size"], r["target"]), []).append(r)
    assert sum(t for _, t in by) == pytest.approx(1.5 * sum(r["size"] for r in rows))
    for (_, target), group in by.items():
        assert abs(sum(r["taken"] for r in group) - target) <= max(r["size"] for r in group)


def test_cascade_orders_by_rejection_per_cost(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = quality.plan_cascade(docs)
    assert [m.rank for m in plan] == sorted((m.rank for m in plan), reverse=True)
    a = {r["doc_id"] for r in quality.apply_cascade(docs, [m.rule for m in plan]).where("rejected_by is null").collect()}
    b = {r["doc_id"] for r in quality.apply_cascade(docs, [m.rule for m in plan[::-1]]).where("rejected_by is null").collect()}
    assert a == b and len(a) < docs.count()
