import pytest
from pyspark.sql import functions as F

from linkloom import cli
from linkloom.operators import blocking as bl
from linkloom.operators import metrics as mt
from linkloom.operators import model as md
from linkloom.operators.features import FEATURE_COLUMNS
from linkloom.plans import fixtures as fx
from linkloom.plans import pipelines as pl
from linkloom.sources import readers, writers
from linkloom.streaming.blocking import stream_candidates

SF = "/root/testdata/sf0.001"


def same(a, b):
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_text_table(spark, tmp_path):
    (tmp_path / "t.tsv").write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\n1\tNA\t"12 ""Big"" Rd\nline2"\tnull\n2\t a b \t\tUS\n')
    rows = [tuple(r) for r in readers.load_source(spark, str(tmp_path / "t.tsv")).orderBy("entity_id").collect()]
    assert rows == [("1", "", '12 "Big" Rd\nline2', ""), ("2", " a b ", "", "US")]
    assert readers.read_text_table(spark, str(tmp_path / "t.tsv")).where("country is null").count() == 1


def test_bag_weights(spark):
    s1 = spark.createDataFrame([("a", "acme acme", "", "")], "entity_id string, business_name string, business_address string, country string")
    pool = spark.createDataFrame([("b", "acme acme", "", "")], s1.schema)
    [r] = bl.signal_scores(s1, pool, "name").collect()
    assert r["score"] == pytest.approx(2.37814, abs=1e-4)


def test_chunked_streamed_and_whole_blocking_agree(spark, tmp_path):
    s1, s2, s3 = fx.sources_a(spark, SF)
    whole = bl.build_candidates(s1, s2, s3)
    for m in range(2):
        out = writers.write_chunks(s1, s2, s3, str(tmp_path / "c"), m, 2, 15)
        assert out.where("status <> 'complete'").isEmpty()
    assert writers.write_chunks(s1, s2, s3, str(tmp_path / "c"), 0, 2, 15).where("status <> 'skipped_existing'").isEmpty()
    same(writers.merge_chunks(spark, str(tmp_path / "c"), str(tmp_path / "m"), 2, True, chunk_size=15), whole)
    with pytest.raises(RuntimeError):
        writers.merge_chunks(spark, str(tmp_path / "c"), str(tmp_path / "m"), 3, True, chunk_size=15)
    with pytest.raises(FileNotFoundError):
        writers.merge_chunks(spark, str(tmp_path / "none"), str(tmp_path / "m"))
    s1.repartition(3).write.parquet(str(tmp_path / "s1"))
    stream = spark.readStream.schema(s1.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "s1"))
    stream_candidates(stream, s2, s3, str(tmp_path / "o"), str(tmp_path / "k")).awaitTermination()
    same(spark.read.parquet(str(tmp_path / "o")).drop("batch"), whole)
    ranks = whole.groupBy("source1_entity_id").agg(F.max("candidate_rank").alias("m"), F.count("*").alias("n")).collect()
    assert all(r["m"] == r["n"] - 1 < 50 for r in ranks)


def test_train_save_load_infer(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    s1, s2, s3 = fx.sources_a(spark, sf)
    truth = fx.truth_a(spark, sf).groupBy("source1_entity_id").agg(F.array_join(F.collect_list("candidate_entity_id"), ",").alias("matched_entity_ids"))
    done = pl.train(s1, s2, s3, truth, str(tmp_path / "w"), bl.BlockingConfig(k=10), rounds=3, depth=3)
    assert done.ranks.first()["roc_auc"] > 0.8
    assert 0.1 <= done.threshold <= 0.99
    md.save(done.model, str(tmp_path / "model"), done.threshold, done.macro_f05, 10)
    fitted, meta = md.load(str(tmp_path / "model"))
    assert meta["features"] == FEATURE_COLUMNS and meta["k"] == 10
    lists, matches = pl.infer(s1, s2, s3, lambda df: md.score(fitted, df), str(tmp_path / "i"), meta["threshold"], bl.BlockingConfig(k=10))
    cand = {r[0]: set(r[1].split(",")) for r in lists.collect()}
    found = {r[0]: {x for x in r[1].split(",") if x} for r in matches.collect()}
    ids = {r[0] for r in s1.select("entity_id").collect()}
    assert set(cand) == set(found) == ids
    assert all(found[k] <= cand[k] for k in ids) and any(found.values())
    assert done.importances.agg(F.sum("splits")).first()[0] > 0


def test_subsample(spark, tmp_path):
    s1, s2, s3 = (x.select("entity_id", "business_name", "business_address", "country") for x in fx.sources_a(spark, SF))
    for i, s in enumerate((s1, s2, s3), 1):
        writers.write_text_table(s, str(tmp_path / f"d/train_source{i}.tsv"))
    truth = s1.select(F.col("entity_id").alias("source1_entity_id")).join(fx.truth_a(spark, SF).groupBy("source1_entity_id").agg(F.array_join(F.collect_list("candidate_entity_id"), ",").alias("matched_entity_ids")), "source1_entity_id", "left")
    writers.write_text_table(truth, str(tmp_path / "d/train_ground_truth.tsv"))
    pl.subsample_files(spark, str(tmp_path / "d"), str(tmp_path / "o"), 10)
    assert readers.load_source(spark, str(tmp_path / "o/train_source1.tsv")).count() == 10
    assert readers.load_source(spark, str(tmp_path / "o/train_source2.tsv")).count() == s2.count()


def test_macro_f_cases(spark):
    s = "source1_entity_id string, candidate_entity_id string"
    scored = spark.createDataFrame([("b", "x", 0.9), ("d", "x", 0.9), ("d", "y", 0.9), ("d", "q", 0.2)], s + ", proba double")
    truth = spark.createDataFrame([("c", "x"), ("d", "x"), ("d", "z")], s)
    ents = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "source1_entity_id string")
    r = mt.macro_f(scored, truth, ents, 0.5).first()
    assert tuple(r) == pytest.approx(((1 + 0 + 0 + 0.5) / 4, (1 + 0 + 0 + 0.5) / 4, (1 + 1 + 0 + 0.5) / 4))
    swept = {round(x["threshold"], 2): x["macro_f"] for x in mt.sweep(scored, truth, ents).collect()}
    assert swept[0.5] == pytest.approx(r["macro_f"]) and swept[0.95] == pytest.approx(0.5) and len(swept) == 90


def test_environment():
    env = cli.environment({"MACHINE_COUNT": "3", "MACHINE_ID": "9", "S1_CHUNK_SIZE": "x", "DISTRIBUTED_MODE": "Yes"})
    assert (env["enabled"], env["machine_id"], env["machine_count"], env["chunk_size"]) == (True, 2, 3, 25000)


def test_first_row_of_equal_ids(spark):
    """The first as read, whatever its name; in the pool the earlier source's."""
    from linkloom.operators import features as ft

    schema = "entity_id string, business_name string, business_address string, country string"
    rows = lambda *names: spark.createDataFrame([("x", n, "", "c") for n in names], schema).coalesce(1)
    pool = rows("zulu", "mike").withColumn("src_priority", F.lit(1)).unionByName(rows("yankee", "bravo").withColumn("src_priority", F.lit(0)))
    [r] = ft.with_records(spark.createDataFrame([("x", "x")], "source1_entity_id string, candidate_entity_id string"), rows("zeta", "alpha"), pool).collect()
    assert (r["a"]["business_name"], r["b"]["business_name"]) == ("zeta", "yankee")


def test_boosted_trees_learn_from_all_features(spark, monkeypatch):
    """The measures that run in Python are there for both texts, and rounds are those of ``fit``."""
    from linkloom.functions import similarity as sim
    from linkloom.plans import catalog

    seen, fit = {}, md.fit

    def spy(df, **settings):
        seen.update(settings, df=df, model=fit(df, **settings))
        return seen["model"]

    monkeypatch.setattr(md, "fit", spy)
    assert catalog.QUERIES["l1_l3_boosted_trees"][0](spark, SF).count() > 0
    records = fx.add_normalized(fx.records_a(spark, SF)).select("entity_id", "name_norm", "addr_norm").collect()
    texts = {r["entity_id"]: r for r in records}
    rows = seen["df"].collect()
    assert len(rows) > 100
    for r in rows:
        a, b = texts[r["source1_entity_id"]], texts[r["candidate_entity_id"]]
        for n in ("name", "addr"):
            for k, f in sim.KERNELS.items():
                assert r[f"{n}_{k}"] == pytest.approx(f(a[f"{n}_norm"], b[f"{n}_norm"]), abs=1e-4), (n, k)
    gbt = seen["model"].stages[-1]
    assert gbt.getMaxIter() == 40 and seen["model"].stages[0].getInputCols() == FEATURE_COLUMNS
