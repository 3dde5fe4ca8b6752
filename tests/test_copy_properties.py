"""Properties of destination offsets over random source layouts."""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import T0, make_log
from spillway.plans.copy import plan_copy_batch

layouts = st.lists(
    st.tuples(st.integers(0, 6), st.integers(0, 50), st.lists(st.integers(1, 3), min_size=1, max_size=40)),
    min_size=1, max_size=5, unique_by=lambda t: t[0])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(layout=layouts, n=st.integers(1, 7), base=st.integers(0, 1000))
def test_destination_offsets_unique_ordered_and_complete(spark, layout, n, base):
    rows = []
    for part, first, steps in layout:
        off = first
        for s in steps:  # offsets with gaps, as after compaction
            rows.append(("t", part, off, b"k", f"{part}:{off}".encode(), T0))
            off += s
    out = plan_copy_batch(make_log(spark, rows), n, base=base).records.collect()
    assert len(out) == len(rows)
    per_dst = defaultdict(list)
    for r in out:
        src_part, src_off = (int(x) for x in bytes(r.value).decode().split(":"))
        assert r.partition == (src_off + src_part) % n  # round robin
        assert r.offset >= base
        per_dst[r.partition].append((src_part, src_off, r.offset))
    for recs in per_dst.values():
        offs = [o for _, _, o in recs]
        assert len(offs) == len(set(offs))  # unique within a destination partition
        by_src = defaultdict(list)
        for sp, so, o in recs:
            by_src[sp].append((so, o))
        for pairs in by_src.values():  # order of a source partition is kept
            pairs.sort()
            assert [o for _, o in pairs] == sorted(o for _, o in pairs)
