"""Property tests (hypothesis) for the merge algebra."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pitchlake.operators import merge as M

rows = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 3)), max_size=8)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(tgt=rows, src=rows)
def test_upsert_is_idempotent_and_keeps_one_row_per_key(spark, tgt, src):
    t = spark.createDataFrame(list({k: (k, v) for k, v in tgt}.values()) or [(0, 0)], "k int, v int")
    s = spark.createDataFrame(src or [(1, 1)], "k int, v int")
    s = M.dedupe_source(s, ["k"], ["v"])
    once = M.merge_upsert(t, s, "k")
    twice = M.merge_upsert(once, s, "k")
    a = sorted(map(tuple, once.collect()))
    assert a == sorted(map(tuple, twice.collect()))
    assert len({k for k, _ in a}) == len(a)
    src_map = {r.k: r.v for r in s.collect()}
    for k, v in a:
        if k in src_map:
            assert v == src_map[k]
