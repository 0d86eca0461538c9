import pytest

from linkloom.plans import catalog
from tests.oracle import assert_same

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [k for k, (_, sql) in catalog.QUERIES.items() if sql])
def test_query_equals_its_sql(spark, name):
    f, sql = catalog.QUERIES[name]
    assert_same(f(spark, SF), sql, SF)


@pytest.mark.parametrize("name", ["m2_m3_m4_token_ratios", "c5_pair_features"])
def test_features_stay_in_range(spark, name):
    rows = catalog.QUERIES[name][0](spark, SF).collect()
    assert rows
    for r in rows:
        assert all(v >= 0 for v in r.asDict().values() if isinstance(v, float))
        assert all(0 <= v <= 100.0001 for k, v in r.asDict().items() if k.endswith(("ratio", "token_sort", "token_set", "levenshtein", "jaro_winkler")))
