"""Mixing sources to target weights, cut at each source's exact word budget.

Every document gets a hash-random key.  Within a source, keys are range-split
into buckets; the buckets' word totals are prefix-summed, which finds the one
bucket that holds the source's cut; only that bucket's keys are prefix-summed
one by one.  Documents before the cut are taken once more than those behind
it, after as many whole epochs as the target holds.  No row is moved to decide:
the plan is one row per source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spillway.llm.common import Workspace, whole_row, words_of

BUCKET_BITS = 12  # a source's keys are range-split into 4,096 buckets
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0


def random_key(seed: int = 17) -> Column:
    """A uniform 64-bit key that depends on the document alone (equal rows have equal keys)."""
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.coalesce("text", F.lit("")))


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, key) of every document."""
    return docs.select("doc_id", "source", words_of(F.col("text")).alias("size"), random_key().alias("key"))


def targets(rows: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per source: source, source_size, n, target.

    Sources in code-point order, null last, weigh `weights` in turn and share
    `share` times all words.  A target stops at `most` times its source's
    words; the excess goes to the others by weight, again and again until none
    is above: in the end target = min(most * size, weight * level) for the one
    level that spends the whole share.  With sources ordered by
    most * size / weight that level follows from two prefix sums.  Runs on the
    table of sources (one row each), not on documents.
    """
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = (per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                 (rank % len(weights) + 1).cast("int")))
           .withColumn("cap", F.col("source_size") * F.lit(float(most)))
           .withColumn("ratio", F.col("cap") / F.col("weight")))
    order = Window.orderBy(F.col("ratio").asc(), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    capped = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    weights_left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum("source_size").over(every) * F.lit(float(share)) - capped) / weights_left
    # Behind the first source that stays under its cap the levels only fall: the largest is that source's.
    leveled = per.withColumn("level", level)
    common = F.max(F.when(F.col("ratio") > F.col("level"), F.col("level"))).over(every)
    return (leveled.withColumn("common", common)
            .select("source", "source_size", "n",
                    F.least("cap", F.coalesce(F.col("weight") * F.col("common"), F.col("cap"))).alias("target")))


def plan(rows: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per source: source, source_size, target, epochs, cut_key, cut_left, cut_rows.

    Each document is taken `epochs` times; those with key < cut_key once more;
    those with key = cut_key (`cut_rows` rows, more than one only for equal
    rows) share the last `cut_left` words.  cut_key is null if the epochs spend
    the target exactly.
    """
    per = targets(rows, weights, share, most)
    budget = F.round("target").cast("long")
    per = (per.withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("cast(round(target) as bigint) div source_size")).otherwise(F.lit(0)))
           .withColumn("rest", budget - F.col("epochs") * F.col("source_size")))
    bucket = F.shiftrightunsigned("key", 64 - BUCKET_BITS).cast("int")
    buckets = rows.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
    in_source = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    same = F.col("b.source").eqNullSafe(F.col("p.source"))
    cut = (buckets.withColumn("base", F.sum("words").over(in_source) - F.col("words")).alias("b")
           .join(per.alias("p"), same)
           .where("base <= rest and rest < base + words")
           .select(F.col("p.source").alias("source"), "bucket", "base", "rest"))  # at most one bucket per source
    keys = (rows.withColumn("bucket", bucket).alias("r")
            .join(cut.alias("c"), F.col("r.source").eqNullSafe(F.col("c.source")) & (F.col("r.bucket") == F.col("c.bucket")))
            .groupBy(F.col("c.source").alias("source"), "base", "rest", "key")
            .agg(F.sum("size").alias("words"), F.count("*").alias("cut_rows")))
    # signed order of the key within one bucket equals its unsigned order
    by_key = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    cuts = (keys.withColumn("before", F.col("base") + F.sum("words").over(by_key) - F.col("words"))
            .where("before <= rest and rest < before + words")
            .select("source", F.col("key").alias("cut_key"), (F.col("rest") - F.col("before")).alias("cut_left"), "cut_rows"))
    return (per.alias("p").join(cuts.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")), "left")
            .select("p.source", "source_size", "target", "epochs", "cut_key", "cut_left", "cut_rows"))


def _flip(key: Column) -> Column:
    """Signed order of the result is the unsigned order of the key."""
    return key.bitwiseXOR(F.lit(-(1 << 63)))


def _taken(size: Column, key: Column) -> Column:
    last = F.when(F.col("cut_key").isNull(), F.lit(0)) \
        .when(_flip(key) < _flip(F.col("cut_key")), size) \
        .when(key == F.col("cut_key"), F.least(size, F.expr("cut_left div cut_rows"))) \
        .otherwise(F.lit(0))
    return (F.col("epochs") * size + last).cast("long")


def mix(docs: DataFrame, work: Workspace, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
        most: float = MOST) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken.

    `taken`: words the mix takes, whole epochs plus what the cut leaves; a
    source's taken words equal its rounded target, less a few words where
    equal rows meet at the cut (they share evenly, rounded down).  Null text:
    size 0; a null source is a source of its own, the last one; a source
    without words has target 0; an empty table gives no rows.  Equal inputs
    give equal results.  Columns other than doc_id, text and source are not
    read.
    """
    rows = work.write(sized(docs), "sized")
    chosen = work.write(plan(rows, weights, share, most), "plan")
    # one row per source; Spark broadcasts it where its size allows
    return (rows.alias("r").join(chosen.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")))
            .select("r.doc_id", "r.source", "r.size", "source_size", "target", _taken(F.col("r.size"), F.col("r.key")).alias("taken")))


def mix_documents(docs: DataFrame, work: Workspace, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                  most: float = MOST) -> DataFrame:
    """The mix itself: the rows of `docs`, each as often as it is taken, all columns kept.

    Documents are not split: the one at a source's cut is taken once more if at
    least half of its words fit.  A document without words can't count against
    any budget and is taken once.
    """
    chosen = work.write(plan(work.write(sized(docs), "sized"), weights, share, most), "plan")
    whole = docs.select(whole_row(docs).alias("row"), words_of(F.col("text")).alias("size"), random_key().alias("key"))
    joined = whole.join(chosen.withColumnRenamed("source", "plan_source"),
                        F.col("row.source").eqNullSafe(F.col("plan_source")))
    last = _taken(F.col("size"), F.col("key")) - F.col("epochs") * F.col("size")
    times = F.when(F.col("size") == 0, F.lit(1)).otherwise(
        F.col("epochs") + F.when(last * 2 >= F.col("size"), F.lit(1)).otherwise(F.lit(0)))
    return (joined.withColumn("times", times.cast("int")).where("times > 0")
            .select("row", F.explode(F.array_repeat(F.lit(1), F.col("times"))).alias("copy"))
            .select("row.*"))
