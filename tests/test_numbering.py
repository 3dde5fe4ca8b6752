import random

from spillway.operators.numbering import sequence_within


def test_positions_match_brute_force_with_a_hot_group(spark):
    rnd = random.Random(7)
    rows = []
    seq = 0
    for _ in range(3000):
        seq += rnd.randint(1, 3)
        g = "hot" if rnd.random() < 0.4 else f"g{rnd.randint(0, 9)}"
        rows.append((g, seq))
    df = spark.createDataFrame(rows, "g string, seq long")
    got = {(r.g, r.seq): r.pos for r in sequence_within(df, ["g"], "seq", "pos", slice_width=37).collect()}
    expect = {}
    for g in {g for g, _ in rows}:
        for i, s in enumerate(sorted(s for gg, s in rows if gg == g)):
            expect[(g, s)] = i
    assert got == expect


def test_hot_group_is_split_over_slices(spark):
    df = spark.range(0, 5000).selectExpr("'hot' AS g", "id AS seq")
    out = sequence_within(df, ["g"], "seq", "pos", slice_width=100)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_slice" in plan  # the window is partitioned by (group, slice)
    assert sorted(r.pos for r in out.collect()) == list(range(5000))


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 10_000)), min_size=1, max_size=300,
                     unique_by=lambda r: r), width=st.integers(1, 500))
def test_positions_for_any_layout_and_slice_width(spark, rows, width):
    df = spark.createDataFrame(rows, "g string, seq long")
    got = {(r.g, r.seq): r.pos for r in sequence_within(df, ["g"], "seq", "pos", slice_width=width).collect()}
    expect = {}
    for g in {g for g, _ in rows}:
        for i, s in enumerate(sorted(s for gg, s in rows if gg == g)):
            expect[(g, s)] = i
    assert got == expect
