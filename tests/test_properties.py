"""Property tests: exact distributed quantiles equal numpy's linear percentiles for random groupings, and
the keyed upsert equals a dictionary update, for random inputs."""
import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from statlayer.profile.stats import exact_quantiles
from statlayer.publish.warehouse import upsert

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

values = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]),
                            st.one_of(st.integers(-5, 5).map(float), st.floats(-1e6, 1e6, allow_nan=False))),
                  min_size=1, max_size=60)


@SETTINGS
@given(rows=values, parts=st.integers(1, 7))
def test_exact_quantiles_property(spark, rows, parts):
    df = spark.createDataFrame(rows, "g string, v double").repartition(parts)
    got = {r.g: (r.p25, r.p50, r.p75) for r in exact_quantiles(df, "v", ["g"]).collect()}
    for g in {k for k, _ in rows}:
        vals = np.array([v for k, v in rows if k == g])
        want = tuple(float(np.percentile(vals, q)) for q in (25, 50, 75))
        assert got[g] == pytest.approx(want, rel=1e-9, abs=1e-9)


records = st.dictionaries(st.integers(0, 30), st.integers(-100, 100), max_size=20)


@SETTINGS
@given(target=records, incoming=records)
def test_upsert_is_a_dictionary_update(spark, target, incoming):
    schema = "k int, v int"
    t = spark.createDataFrame(list(target.items()), schema)
    i = spark.createDataFrame(list(incoming.items()), schema)
    expected = dict(target)
    expected.update(incoming)
    assert dict((r.k, r.v) for r in upsert(t, i, ["k"]).collect()) == expected
    assert upsert(t, i, ["k"]).count() == len(expected)
