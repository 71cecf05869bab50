"""Property checks (hypothesis): locale-number round trip, key-or-name forms agree."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.operators import joins as J
from tests.naive import or_join_naive

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(st.integers(min_value=-10**12, max_value=10**12), min_size=1, max_size=20))
def test_locale_decimal_round_trip(spark, cents):
    df = spark.createDataFrame([(c / 100.0,) for c in cents], "x double")
    out = df.select("x", C.parse_decimal_br(C.format_decimal_br("x", 2)).alias("y")).collect()
    assert all(round(r.x, 2) == r.y for r in out)


keys = st.one_of(st.none(), st.integers(min_value=1, max_value=4))
names = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))


@SETTINGS
@given(st.lists(st.tuples(keys, names), min_size=1, max_size=8),
       st.lists(st.tuples(keys, names, st.integers(0, 5)), min_size=1, max_size=15))
def test_bag_and_set_forms(spark, left, right):
    l = spark.createDataFrame([(k, n, i) for i, (k, n) in enumerate(left)],
                              "k bigint, n string, lid int")
    r = spark.createDataFrame(right, "k bigint, n string, v int")
    pairs = [("k", "k"), ("n", "n")]
    bag = J.or_equi_join(l, r, pairs)
    assert Counter(map(tuple, bag.collect())) == Counter(
        map(tuple, or_join_naive(l, r, pairs).collect()))
    # the set form gives the same max per left row as the bag form
    s = J.or_equi_join(l, r, pairs, dedup=True)
    m1 = dict(map(tuple, bag.groupBy("lid").agg(F.max("v")).collect()))
    m2 = dict(map(tuple, s.groupBy("lid").agg(F.max("v")).collect()))
    assert m1 == m2
