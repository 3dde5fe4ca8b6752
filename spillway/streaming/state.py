"""The engine's state tables: reading them, and folding old batch folders.

Every batch adds one folder to `audit` and to `commits`.  After many batches
listing them costs more than reading them, so finished batches are folded: the
rows of the batches since the last fold are written to one folder
`<table>-folded/group=/generation=/level=0/from=/upto=`, and then the batch folders
are deleted.  `FAN_IN` folds of a level become one of the next, so a row is rewritten
once a level, storage grows with the rows, and a copy of any age has few folders.
Readers take the complete folds that no larger one covers and only batches behind
the last, so a crash between two steps shows nothing twice, and a batch that is
replayed although it was folded adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spillway.schema import AUDIT, COMMITS
from spillway.streaming import fs

TABLES = {"audit": AUDIT, "commits": COMMITS}


FAN_IN = 32
Fold = tuple[int, int, int, str]  # first batch, last batch, level, folder


def _folds(spark: SparkSession, root: str, table: str, group: str, generation: int) -> list[Fold]:
    """The complete folds of a generation that no larger one covers, in order."""
    base = fs.partition_folder(spark, f"{root}/{table}-folded", group=group, generation=generation)
    found: list[Fold] = []
    for level in map(int, fs.child_values(spark, base, "level")):
        for first in map(int, fs.child_values(spark, f"{base}/level={level}", "from")):
            for last in map(int, fs.child_values(spark, f"{base}/level={level}/from={first}", "upto")):
                folder = f"{base}/level={level}/from={first}/upto={last}"
                if fs.exists(spark, f"{folder}/_SUCCESS"):
                    found.append((first, last, level, folder))
    out: list[Fold] = []
    for one in sorted(found, key=lambda f: (f[0], -f[1])):
        if not out or one[0] > out[-1][1]:
            out.append(one)
    return out


def _all_folds(spark: SparkSession, root: str, table: str, group: str) -> dict[int, list[Fold]]:
    base = fs.partition_folder(spark, f"{root}/{table}-folded", group=group)
    found = {g: _folds(spark, root, table, group, g) for g in map(int, fs.child_values(spark, base, "generation"))}
    return {g: folds for g, folds in found.items() if folds}


def read_table(spark: SparkSession, root: str, table: str, group: str) -> DataFrame:
    """All rows of one group in a state table; no rows before its first batch."""
    schema: T.StructType = TABLES[table]
    folds = _all_folds(spark, root, table, group)
    rows = spark.createDataFrame([], schema)
    if fs.exists(spark, fs.partition_folder(spark, f"{root}/{table}", group=group)):
        live = spark.read.schema(schema).parquet(f"{root}/{table}").where(F.col("group") == group)
        for generation, done in folds.items():
            live = live.where((F.col("generation") != generation) | (F.col("batch_id") > done[-1][1]))
        rows = live.select(*schema.names)
    folders = [folder for done in folds.values() for *_, folder in done]
    if folders:
        # The folds' own columns name group, generation and batch; their folders' names are not read.
        rows = rows.unionByName(spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*folders).select(*schema.names))
    return rows


def _write_fold(rows: DataFrame, root: str, table: str, group: str, generation: int, level: int, first: int, last: int) -> None:
    if table == "commits":  # of many positions of a partition only the last counts
        rows = (rows.groupBy("group", "generation", "topic", "partition")
                .agg(F.max("next_offset").alias("next_offset"), F.max("batch_id").alias("batch_id"), F.max("at").alias("at"))
                .select(*COMMITS.names))
    path = fs.partition_folder(rows.sparkSession, f"{root}/{table}-folded", group=group, generation=generation, level=level,
                               **{"from": first}, upto=last)
    rows.coalesce(1).write.mode("overwrite").parquet(path)  # the rows of as many batches as one fold takes


def fold(spark: SparkSession, root: str, group: str, generation: int, least: int = 2) -> int | None:
    """Fold the batches of a generation that finished since the last fold, if there are `least` of them; the last one
    folded, or None.

    A batch is finished once its positions are in `commits`.  Run it where no
    batch of the generation runs, as the copy itself does between two batches.
    """
    folders = {t: fs.partition_folder(spark, f"{root}/{t}", group=group, generation=generation) for t in TABLES}
    live = {t: sorted(int(b) for b in fs.child_values(spark, f, "batch_id")) for t, f in folders.items()}
    done = {t: _folds(spark, root, t, group, generation) for t in TABLES}
    # A crash may have folded one table and not the other, or left folders of folded batches.
    new = {t: [b for b in live[t] if not done[t] or b > done[t][-1][1]] for t in TABLES}
    if len(live["commits"]) < least:
        return None
    upto = live["commits"][-1]
    for table in TABLES:
        first = done[table][-1][1] + 1 if done[table] else min(new[table], default=upto)
        if first <= upto:
            rows = (spark.read.schema(TABLES[table]).parquet(f"{root}/{table}")
                    .where((F.col("group") == group) & (F.col("generation") == generation) & F.col("batch_id").between(first, upto)))
            _write_fold(rows.select(*TABLES[table].names), root, table, group, generation, 0, first, upto)
        _merge(spark, root, table, group, generation)
    for table, batches in live.items():
        for b in batches:
            if b <= upto:
                fs.delete(spark, f"{folders[table]}/batch_id={b}")
    return upto


def _merge(spark: SparkSession, root: str, table: str, group: str, generation: int) -> None:
    """Make `FAN_IN` folds of a level one of the next, then delete what larger folds cover."""
    folds = _folds(spark, root, table, group, generation)
    for level in sorted({f[2] for f in folds}):
        these = [f for f in _folds(spark, root, table, group, generation) if f[2] == level]
        if len(these) >= FAN_IN:
            rows = spark.read.schema(TABLES[table]).option("recursiveFileLookup", "true").parquet(*(f[3] for f in these))
            _write_fold(rows, root, table, group, generation, level + 1, these[0][0], these[-1][1])
    kept = {f[3] for f in _folds(spark, root, table, group, generation)}
    base = fs.partition_folder(spark, f"{root}/{table}-folded", group=group, generation=generation)
    for level in fs.child_values(spark, base, "level"):
        for first in fs.child_values(spark, f"{base}/level={level}", "from"):
            for last in fs.child_values(spark, f"{base}/level={level}/from={first}", "upto"):
                folder = f"{base}/level={level}/from={first}/upto={last}"
                if folder not in kept:
                    fs.delete(spark, folder)
