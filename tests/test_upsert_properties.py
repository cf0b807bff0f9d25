"""Property test: the Spark upsert equals a direct model of MERGE ... WHEN
MATCHED UPDATE SET * WHEN NOT MATCHED INSERT * on random inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pathcredit.operators import upsert

keys = st.one_of(st.none(), st.integers(min_value=0, max_value=6))
rows = st.lists(st.tuples(keys, st.text(alphabet="abc", min_size=1, max_size=2)), max_size=8)


def _model(target, source):
    matched = {k for k, _ in target if k is not None}
    counts = {}
    for k, _ in source:
        if k is not None and k in matched:
            counts[k] = counts.get(k, 0) + 1
    if any(n > 1 for n in counts.values()):
        return None  # MERGE raises
    source_keys = {k for k, _ in source if k is not None}
    return sorted(source + [(k, v) for k, v in target if k is None or k not in source_keys], key=repr)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=rows, source=rows)
def test_merge_matches_model(spark, target, source):
    schema = "k int, v string"
    expected = _model(target, source)
    t = spark.createDataFrame(target, schema)
    s = spark.createDataFrame(source, schema)
    if expected is None:
        try:
            upsert.merge(t, s, ["k"])
        except upsert.DuplicateSourceKeyError:
            return
        raise AssertionError("expected a duplicate-match error")
    got = sorted(((r.k, r.v) for r in upsert.merge(t, s, ["k"]).collect()), key=repr)
    assert got == expected
