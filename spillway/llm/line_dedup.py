"""Cross-site boilerplate removal: lines that stand on many sites go.

A line's spread is the number of distinct sites it stands on.  Sites are
sketched per line hash with HyperLogLog; sketches merge in the aggregation, on
the map side first, so a line that stands in a third of all documents costs one
small sketch per task.  Lines whose estimate is near the threshold get an exact
distinct count.  All of it is built-in Spark aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spillway.llm.common import Workspace, free_name, text_keys

MIN_SITES = 4       # a line on so many distinct sites is boilerplate, also where sites are few or one holds most rows
LG_K = 9            # 512 registers: relative standard error 1.04 / sqrt(512) = 4.6 %
NEAR = 0.25         # estimates within a quarter of the threshold (over five errors) are counted exactly


def line_key(line: Column) -> Column:
    """A line's identity: spaces (U+0020) at its ends don't count, as in the SQL; a tab or \\r does."""
    return F.xxhash64(F.trim(line))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _keys(text: Column) -> Column:
    """Hashes of a text's distinct lines; blank lines are no lines."""
    return F.array_distinct(F.transform(F.filter(_lines(text), lambda x: F.trim(x) != ""), line_key))


def boilerplate_lines(docs: DataFrame, site: str, min_sites: int, work: Workspace) -> DataFrame:
    """(line) hashes that stand on at least `min_sites` distinct sites; null is a site of its own."""
    site_key = F.coalesce(F.xxhash64(F.lit(1), F.col(site)), F.lit(0))
    seen = docs.select(site_key.alias("site"), F.explode(_keys(F.col("text"))).alias("line"))
    spread = seen.groupBy("line").agg(F.hll_sketch_agg("site", LG_K).alias("sketch"))
    rated = work.write(spread.select("line", F.hll_sketch_estimate("sketch").alias("sites"))
                       .where(F.col("sites") >= min_sites * (1 - NEAR)), "rated")
    clear = rated.where(F.col("sites") > min_sites * (1 + NEAR)).select("line")
    near = rated.where(F.col("sites") <= min_sites * (1 + NEAR)).select("line")
    exact = (seen.join(near, "line", "left_semi").distinct()  # at most one row per line, site and task is shuffled
             .groupBy("line").agg(F.count("*").alias("sites"))
             .where(F.col("sites") >= min_sites).select("line"))
    return clear.union(exact)


def remove_boilerplate(docs: DataFrame, work: Workspace, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """doc_id, n_lines, n_removed, text: every document without its boilerplate lines.

    Lines are split at \\n; all occurrences of a boilerplate line go, the other
    lines stay in order and joined by \\n.  n_lines counts lines that are not
    blank, repeats included.  Null texts come back as empty texts with no
    lines; blank lines are never removed; repeated rows stay rows; an empty
    table gives no rows.  Columns other than doc_id, text and `site` are not
    read.
    """
    rows = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.col(site).alias("site"))
    bad = work.write(boilerplate_lines(rows, "site", min_sites, work), "boilerplate")
    k1, k2 = text_keys(F.col("text"))
    # What goes from a text depends on the text alone: copies share one list.  It is written so
    # that the join below has two plain inputs, which Spark can split where copies crowd.
    hits = work.write(
        rows.select(k1.alias("k1"), k2.alias("k2"), F.explode(_keys(F.col("text"))).alias("line"))
            .join(bad, "line", "left_semi")
            .groupBy("k1", "k2").agg(F.collect_set("line").alias("drop")), "hits")
    joined = rows.withColumns({"k1": k1, "k2": k2}).join(hits, ["k1", "k2"], "left")
    drop = F.coalesce("drop", F.array().cast("array<bigint>"))
    goes = lambda x: (F.trim(x) != "") & F.array_contains(F.col("gone"), line_key(x))
    solid = F.size(F.filter(_lines(F.col("text")), lambda x: F.trim(x) != ""))
    return (joined.withColumn("gone", drop)
            .withColumn("left_lines", F.filter(_lines(F.col("text")), lambda x: ~goes(x)))
            .select("doc_id", solid.cast("long").alias("n_lines"),
                    (solid - F.size(F.filter("left_lines", lambda x: F.trim(x) != ""))).cast("long").alias("n_removed"),
                    F.array_join("left_lines", "\n").alias("text")))
