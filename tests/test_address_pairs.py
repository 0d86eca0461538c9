import random

from pyspark.sql import functions as F

from linkloom.functions import similarity as sim
from linkloom.plans import catalog


def test_jaro_winkler_of_many_pairs_equals_one_by_one():
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcd é€") for _ in range(r.choice([0, 1, 2, 3, 5, 9, 17, 40])))
    a, b = [word() for _ in range(5000)], [word() for _ in range(5000)]
    a, b = [*a, *a[:500], "x" * 300], [*b, *a[:500], "x" * 299]
    assert sim.jaro_winkler_all(a, b).tolist() == [sim.jaro_winkler(x, y) for x, y in zip(a, b, strict=True)]


def test_measures_are_computed_before_records_are_paired(spark):
    """Below the explosion of ids: once for each pair of different addresses."""
    for name, what in (("m6_levenshtein", "levenshtein("), ("m5_jaro_winkler", "jaro_winkler_alone("), ("x7_x10_address_features", "arrays_overlap(")):
        plan = catalog.QUERIES[name][0](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert 0 <= plan.index("explode(") < plan.index(what)


def test_token_ratios_of_many_pairs_equal_one_by_one():
    """Words shared, repeated and missing, lengths far apart, blanks alone, texts beyond a machine word."""
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdé€") for _ in range(r.choice([1, 2, 3, 5, 9])))
    some = [word() for _ in range(12)]
    text = lambda: r.choice(["", " "]).join(r.choice(some) + r.choice([" ", "  ", ""]) for _ in range(r.choice([0, 1, 2, 3, 6, 12])))
    a, b = [text() for _ in range(3000)], [text() for _ in range(3000)]
    a, b = [*a, "", " ", "x" * 70, "ab " * 200], [*b, "", "a", "x y" * 40, "ba"]
    a, b = [*a, *(f"Plot {i % 97}, Unit {i % 13} BUILDING Rd." for i in range(800))], [*b, *(f"Plot {i * 7 % 97}, Unit {i * 5 % 13}  Rd." for i in range(800))]
    got = sim.token_ratios_all(a, b)
    assert sim.lcs_all(a, b).tolist() == [sim.lcs(x, y) for x, y in zip(a, b, strict=True)]
    for k, f in (("token_sort", sim.token_sort), ("token_set", sim.token_set), ("w_ratio", sim.weighted_ratio)):
        want = [f(x, y) for x, y in zip(a, b, strict=True)]
        assert max(abs(x - y) for x, y in zip(got[k], want, strict=True)) < 1e-9, k


def test_token_ratios_are_computed_before_records_are_paired(spark):
    plan = catalog.QUERIES["m2_m3_m4_token_ratios"][0](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.index("explode(") < plan.index("token_kernels(")
    assert plan.count("ArrowEvalPython") == 1


def test_pairs_of_addresses_are_spread_over_tasks(spark):
    """A nation's addresses are few bytes, but their pairs are the work."""
    out = catalog.QUERIES["m2_m3_m4_token_ratios"][0](spark, "/root/testdata/sf0.01").select(F.spark_partition_id().alias("task")).groupBy("task").count().collect()
    assert len(out) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_ratios_of_long_texts_equal_one_by_one():
    """Texts of one to five words of 63 bits, at their edges and beyond 256 characters."""
    r = random.Random(5)
    text = lambda n: "".join(r.choice("abcdefg é") for _ in range(n))
    sizes = [0, 1, 62, 63, 64, 125, 126, 127, 189, 190, 252, 253, 256, 257, 300]
    a, b = (list(x) for x in zip(*[(text(m), text(n)) for m in sizes for n in sizes], strict=True))
    a, b = [*a, "x" * 126, "x" * 127, "x" * 250], [*b, "x" * 126, "x" * 200, "x" * 251]
    assert sim.lcs_all(a, b).tolist() == [sim.lcs(x, y) for x, y in zip(a, b, strict=True)]
    assert sim.partial_ratios_all(a[:120], b[:120]).tolist() == [sim.partial_ratio(x, y) for x, y in zip(a[:120], b[:120], strict=True)]


def test_kernels_of_many_pairs_equal_one_by_one(spark):
    r = random.Random(7)
    some = ["".join(r.choice("abcdé") for _ in range(r.choice([1, 3, 6, 11]))) for _ in range(20)]
    text = lambda: " ".join(r.choice(some) for _ in range(r.choice([0, 1, 2, 6, 12])))
    pairs = [(text(), text()) for _ in range(400)]
    rows = spark.createDataFrame([*pairs, (None, "a")], "a string, b string").select("a", "b", sim.kernels("a", "b").alias("k")).collect()
    assert len(rows) == len(pairs) + 1
    for x in rows:
        for k, f in sim.KERNELS.items():
            assert abs(x["k"][k] - f(x["a"] or "", x["b"] or "")) < 1e-9, (k, x)
