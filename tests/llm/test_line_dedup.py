from collections import defaultdict

import pytest

from spillway.llm import line_dedup
from spillway.llm.common import Workspace
from tests.llm.helpers import clashing, documents, plain


def brute(rows, least):
    sites = defaultdict(set)
    for _, text, source in rows:
        for x in (text or "").split("\n"):
            if x.strip(" "):
                sites[x.strip(" ")].add(source)
    bad = {x for x, s in sites.items() if len(s) >= least}
    out = []
    for i, text, _ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if x.strip(" ") not in bad]
        solid = [x for x in lines if x.strip(" ")]
        out.append((i, len(solid), len(lines) - len(kept), "\n".join(kept)))
    return out


def rows_of(df):
    return [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]


def sort(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("wrap", [lambda d: d, clashing])
@pytest.mark.parametrize("least", [2, 3])
def test_cases(spark, wrap, least):
    extra = [(100 + i, f"own {i}\n  shared line\n\nown {i}\n{'two' if i < 2 else 'x'}", "en", None if i == 3 else f"p{i}", 0) for i in range(4)]
    docs = wrap(documents(spark).union(documents(spark, extra)))
    assert plain(line_dedup.remove_boilerplate(docs, Workspace(spark, "t"), min_sites=least)) == sort(brute(rows_of(docs), least))


def test_thresholds_are_exact_near_and_far(spark):
    """Lines on 1 to 60 sites, around a threshold of 30: estimates decide the far ones, exact counts the near ones."""
    rows = [(s * 100 + n, f"line {n}\nonly {s} {n}", "en", f"site{s}", 0) for n in range(1, 61, 3) for s in range(n)]
    rows += [(9000 + n, f"line {n}", "en", "site0", 0) for n in range(1, 61, 3)]
    docs = documents(spark, rows)
    assert plain(line_dedup.remove_boilerplate(docs, Workspace(spark, "t"), min_sites=30)) == sort(brute(rows_of(docs), 30))


def test_given_documents_and_empty(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = plain(line_dedup.remove_boilerplate(docs, Workspace(spark, "t"), min_sites=3))
    assert got == sort(brute(rows_of(docs), 3)) and any(r[2] for r in got)
    assert line_dedup.remove_boilerplate(documents(spark, []), Workspace(spark, "t")).count() == 0


def spread(n, sites):
    """`n` documents of one passage, the first ones on a site each and the rest on the last of them."""
    return [(f"a passage of {n} documents on {sites} sites\nown {n} {sites} {i}", f"src{min(i, sites - 1)}") for i in range(n)]


@pytest.mark.parametrize("texts", [
    [x for sites in range(1, 7) for x in spread(30, sites)],                           # a table of six sites
    [x for sites in range(1, 10) for x in spread(21, sites)] + [(f"hot {i}", "src0") for i in range(200)],  # a hot site
])
def test_registered_threshold_holds_for_few_sites_and_for_a_hot_one(spark, texts):
    docs = documents(spark, [(i, text, "en", source, 0) for i, (text, source) in enumerate(texts)])
    got = plain(line_dedup.remove_boilerplate(docs, Workspace(spark, "t")))
    assert got == sort(brute(rows_of(docs), 4)) and any(r[2] for r in got)
