"""Contiguous shards of nearly equal bytes, from global prefix sums of record sizes.

Records are put in one global order by a range partitioning.  Each partition's
total is summed, the totals are prefix-summed (one row per partition), and a
running sum inside each partition gives every record its global byte position.
The position, cut at equal targets, is the shard.  Only (key, size) columns are
moved; texts stay where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spillway.llm.common import Workspace, free_name

RECORD_OVERHEAD = 16  # bytes a record takes besides its text


def byte_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus the record's overhead."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(RECORD_OVERHEAD)).cast("long")


def text_crc32(text: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))


def manifest(docs: DataFrame, shards: int, work: Workspace) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard (0 to shards-1), slot.

    The global order is (doc_id, null ids last, text_crc32, size).  A record
    belongs to the shard in which the middle of its bytes falls, so a shard's
    bytes differ from the target by at most half a record at either end; a
    record longer than a target fills a shard alone and may leave the next
    empty.  slot counts a shard's records from 0 without gaps.  Null and empty
    texts have the overhead's size; repeated rows are records of their own, in
    any order among themselves; an empty table gives no rows; columns other
    than doc_id and text are not read.
    """
    order = [F.col("doc_id").asc_nulls_last(), F.col("text_crc32").asc(), F.col("size").asc(), F.col("tie").asc()]
    slim = docs.select("doc_id", byte_size(F.col("text")).alias("size"), text_crc32(F.col("text")).alias("text_crc32"),
                       F.monotonically_increasing_id().alias("tie"))
    # `part` depends on how this run cut the ranges: it is written down before it is used twice.
    placed = work.write(slim.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "placed")
    totals = placed.groupBy("part").agg(F.sum("size").alias("part_bytes"), F.count("*").alias("part_rows"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    bases = totals.select(
        "part", F.coalesce(F.sum("part_bytes").over(earlier), F.lit(0)).alias("byte_base"),
        F.coalesce(F.sum("part_rows").over(earlier), F.lit(0)).alias("row_base"),
        F.sum("part_bytes").over(Window.partitionBy()).alias("total"))
    inside = Window.partitionBy("part").orderBy(*order)
    before = F.col("byte_base") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    rows = (placed.join(F.broadcast(bases), "part")  # one row per range partition
            .withColumn("before", before)
            .withColumn("position", F.col("row_base") + F.row_number().over(inside) - 1)
            # floor(middle of the record / target), in integers of up to 38 digits
            .withColumn("shard", F.expr(f"cast(least(cast(2 * before + size as decimal(28,0)) * {int(shards)}"
                                        f" div cast(2 * total as decimal(28,0)), {int(shards) - 1}) as int)")))
    firsts = rows.groupBy("shard").agg(F.min("position").alias("first"))  # one row per shard
    return (rows.join(F.broadcast(firsts), "shard")
            .select("doc_id", "size", "text_crc32", "shard", (F.col("position") - F.col("first")).alias("slot")))


def cut_keys(rows: DataFrame) -> list[tuple]:
    """The first key of every shard that has records, in order: (shard, id is null, doc_id, crc). One row per shard."""
    key = F.struct(F.col("doc_id").isNull().alias("gone"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"),
                   F.col("text_crc32").alias("crc"))
    found = rows.groupBy("shard").agg(F.min(key).alias("k")).orderBy("shard").collect()
    return [(r["shard"], r["k"]["gone"], r["k"]["id"], r["k"]["crc"]) for r in found]


def shard_documents(docs: DataFrame, shards: int, work: Workspace) -> DataFrame:
    """`docs`, all columns, with the shard of each document.

    The shards are contiguous key ranges, so the texts are not moved: the cuts
    of `manifest` (one key per shard) decide row by row.  Rows equal in doc_id
    and text go to one shard.  The new column is `shard`, with underscores in
    front if the input has such a column; other columns stay as they are.
    """
    cuts = cut_keys(manifest(docs, shards, work))
    row = F.struct(F.col("doc_id").isNull().alias("gone"), F.coalesce(F.col("doc_id"), F.lit(0)).cast("long").alias("id"),
                   text_crc32(F.col("text")).alias("crc"))
    starts = F.array(*[F.struct(F.lit(gone).alias("gone"), F.lit(ident).cast("long").alias("id"),
                                F.lit(crc).cast("long").alias("crc")) for _, gone, ident, crc in cuts])
    numbers = F.array(*[F.lit(number) for number, *_ in cuts])
    # A fold carries the row's key along, so that it is computed once.
    before = F.aggregate(starts, F.struct(row.alias("key"), F.lit(0).alias("n")), lambda acc, s: F.struct(
        acc["key"].alias("key"), (acc["n"] + (s <= acc["key"]).cast("int")).alias("n")), lambda acc: acc["n"])
    shard = F.element_at(numbers, before) if cuts else F.lit(0)
    return docs.withColumn(free_name(docs, "shard"), shard.cast("int"))
