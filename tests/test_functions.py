import random

import pytest
from pyspark.sql import functions as F

from linkloom.functions import similarity as sim
from linkloom.functions import text as tx
from linkloom.operators import metrics as mt
from linkloom.operators.blocking import idf


def apply(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r["y"] for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


def test_names(spark):
    given = ["ABC Pvt. Ltd.", "Smith & Sons Co., LLC", "O'Neil-Corp", "Café_Inc Inc", "  ", None]
    want = ["abc private limited", "smith sons company limited liability company", "o neil corporation", "café_inc incorporated", "", ""]
    assert apply(spark, given, lambda c: tx.normalize(c, tx.LEGAL_FORMS)) == want


def test_addresses(spark):
    given = ["12, M.G. Rd., Opp. St. Mary's", "Ste#4 5th Ave/Blvd", "FL 3 Apt 2B"]
    want = ["12 m g road opposite street mary s", "suite 4 5th avenue boulevard", "floor 3 apartment 2b"]
    assert apply(spark, given, lambda c: tx.normalize(c, tx.ADDRESS_WORDS)) == want


@pytest.mark.parametrize(
    "given, units, numbers, first",
    [
        ("Flat No. 5, 12-14B MG Road", [], ["5", "12-14b"], "5"),
        ("Unit #7A, 3rd Floor, 221b Baker St", ["7a"], ["7a", "221b"], "7a"),
        ("plot no 12/3/4 sector 9", [], ["12/3", "4", "9"], "12/3"),
        ("No. 8 block road", ["8", "road"], ["8"], "8"),
        ("1st floor unit--5", ["unit--5"], ["5"], "5"),
        ("Shop: 12/A, Villa -9", ["12/a", "9"], ["12", "9"], "12"),
        ("Unit-No5", ["5"], [], None),
    ],
)
def test_address_parts(spark, given, units, numbers, first):
    [r] = apply(spark, [given], tx.address_parts)
    assert (sorted(r["units"]), sorted(r["numbers"]), r["first_number"]) == (sorted(units), sorted(numbers), first)


@pytest.mark.parametrize(
    "a, b, lcs, ratio, sort, set_, w",
    [
        ("acme pvt limited", "acme private ltd", 12, 75, 75, 75, 75),
        ("limited acme", "acme limited", 7, 58.3333, 100, 100, 95),
        ("acme acme ltd", "acme ltd", 8, 76.1905, 76.1905, 100, 90),
        ("abcd", "abxd", 3, 75, 75, 75, 75),
        ("acme foods private limited", "acme food private limited", 25, 98.0392, 98.0392, 98.0392, 98.0392),
        ("acme", "acme foods private limited", 4, 26.6667, 26.6667, 100, 90),
        ("mg road", "12 mg road pune", 7, 63.6364, 63.6364, 100, 90),
        ("", "", 0, 100, 100, 0, 0),
        ("", "acme", 0, 0, 0, 0, 0),
    ],
)
def test_similarity(spark, a, b, lcs, ratio, sort, set_, w):
    got = (sim.lcs(a, b), sim.ratio(a, b), sim.token_sort(a, b), sim.token_set(a, b), sim.weighted_ratio(a, b))
    assert got == pytest.approx((lcs, ratio, sort, set_, w), abs=1e-3)
    r = spark.createDataFrame([(a, b)], "a string, b string").select(sim.kernels("a", "b").alias("k")).first()["k"]
    assert (r["ratio"], r["w_ratio"]) == pytest.approx((ratio, w), abs=1e-3)


def test_lcs_against_table():
    rng = random.Random(3)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randint(0, 80))) for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        assert sim.lcs(a, b) == row[-1] == sim.lcs(b, a)


def test_jaro_winkler():
    assert sim.jaro_winkler("martha", "marhta") == pytest.approx(96.1111, abs=1e-3)
    assert sim.jaro_winkler("abcdefgh", "abzzzzzz") == pytest.approx(50, abs=1e-3)
    assert (sim.jaro_winkler("", ""), sim.jaro_winkler("", "a")) == (100, 0)


def test_levenshtein_idf_f_beta(spark):
    df = spark.createDataFrame([("kitten", "sitting"), ("", "")], "a string, b string")
    assert [r[0] for r in df.select(sim.levenshtein_share(F.col("a"), F.col("b"))).collect()] == pytest.approx([57.142857, 100])
    got = spark.createDataFrame([(4, 1), (4, 4), (1000, 9), (3, 5)], "n int, d int").select(idf(F.col("n"), F.col("d"))).collect()
    assert [r[0] for r in got] == pytest.approx([1.916291, 1, 5.60617, 0.594535], abs=1e-5)
    got = spark.createDataFrame([(0.5, 1.0), (1.0, 0.5), (2 / 3, 0.5)], "p double, r double").select(mt.f_beta(F.col("p"), F.col("r"))).collect()
    assert [r[0] for r in got] == pytest.approx([0.555556, 0.833333, 0.625], abs=1e-5)
