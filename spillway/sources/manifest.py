"""The manifest of a topic's file log: which folders hold which offsets.

A manifest is one small file of segments, each a folder with the offset range and
record count of its partitions.  Versions are written beside each other and appear
whole, by a rename; the highest one counts.  With it

* newest offsets (S4) and the folders of an offset range are looked up, without
  listing or scanning the topic;
* folders can be folded into larger ones: a reader that asks by offset
  (`spillway.sources.ranges`) never takes folded files for new records.

Where it is kept: beside the log (`<root>/_manifests/topic=<t>`), by the copy that
writes the log; for a log that nobody keeps one for, in the state of the copy that
reads it.  One process writes the manifest of one place.

Folding is log-structured: `FAN_IN` segments of a level become one of the next, so a
record is rewritten once a level and a log of n batches has at most about
`FAN_IN` * log(n) / log(`FAN_IN`) segments.  A folded folder is `<root>/_folded/...`, which
Spark's folder scans leave out; the folders it replaces go with the fold after it, so
readers that have just planned still find them.
"""

from __future__ import annotations

import dataclasses
import json
import threading
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spillway.schema import FILE_LOG_DATA
from spillway.streaming import fs

FAN_IN = 1000        # segments of one level that are folded into one
KEPT_VERSIONS = 5


@dataclasses.dataclass(frozen=True)
class Segment:
    path: str                                  # folder, from the log's root
    level: int                                 # 0: a batch as it was written
    parts: dict[int, tuple[int, int, int]]     # partition -> first offset, end (exclusive), records
    covers: tuple[tuple[str, int, int, int], ...]  # (group, generation, first batch, last batch)


@dataclasses.dataclass(frozen=True)
class Manifest:
    version: int = -1
    segments: tuple[Segment, ...] = ()
    retired: tuple[str, ...] = ()              # folders that the last fold replaced

    @property
    def newest(self) -> dict[int, int]:
        """Partition -> log-end offset."""
        ends: dict[int, int] = {}
        for s in self.segments:
            for p, (_, until, _) in s.parts.items():
                ends[p] = max(until, ends.get(p, 0))
        return ends

    def covered(self) -> dict[tuple[str, int], list[tuple[int, int]]]:
        found: dict[tuple[str, int], list[tuple[int, int]]] = {}
        for s in self.segments:
            for group, generation, first, last in s.covers:
                found.setdefault((group, generation), []).append((first, last))
        return found

    def text(self) -> str:
        return json.dumps({"version": self.version, "retired": self.retired, "newest": self.newest, "segments": [
            {"path": s.path, "level": s.level, "parts": s.parts, "covers": s.covers} for s in self.segments]})


def _parsed(text: str) -> Manifest:
    d = json.loads(text)
    return Manifest(d["version"], tuple(
        Segment(s["path"], s["level"], {int(p): tuple(v) for p, v in s["parts"].items()}, tuple(tuple(c) for c in s["covers"]))
        for s in d["segments"]), tuple(d["retired"]))


def _joined(covers) -> tuple[tuple[str, int, int, int], ...]:
    """Batch intervals, adjacent ones made one."""
    out: list[list] = []
    for group, generation, first, last in sorted(covers):
        if out and out[-1][:2] == [group, generation] and first <= out[-1][3] + 1:
            out[-1][3] = max(last, out[-1][3])
        else:
            out.append([group, generation, first, last])
    return tuple(tuple(c) for c in out)


class ManifestLog:
    """The manifest of one topic, kept in `folder`; `root` is the log."""

    def __init__(self, spark: SparkSession, root: str, topic: str, folder: str | None = None) -> None:
        self.spark, self.root, self.topic = spark, root.rstrip("/"), topic
        self.folder = folder or own_folder(spark, root, topic)
        self._lock = threading.RLock()

    # ---- versions ---------------------------------------------------------
    def _versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in fs.child_names(self.spark, self.folder) if n.endswith(".json"))

    def load(self) -> Manifest:
        versions = self._versions()
        return _parsed(fs.read_text(self.spark, f"{self.folder}/{versions[-1]:020d}.json")) if versions else Manifest()

    def _publish(self, now: Manifest) -> Manifest:
        fs.write_text(self.spark, f"{self.folder}/{now.version:020d}.json", now.text())
        for old in self._versions()[:-KEPT_VERSIONS]:
            fs.delete(self.spark, f"{self.folder}/{old:020d}.json")
        return now

    # ---- batches that were written ------------------------------------------
    def _new_batches(self, now: Manifest) -> list[tuple[str, int, int]]:
        """Batch folders of the log that no segment covers.  Lists folder names only."""
        covered, out = now.covered(), []
        base = fs.partition_folder(self.spark, self.root, topic=self.topic)
        for group in fs.child_values(self.spark, base, "group"):
            name = fs.unescaped(self.spark, group)
            for generation in map(int, fs.child_values(self.spark, f"{base}/group={group}", "generation")):
                spans = covered.get((name, generation), [])
                out += [(name, generation, b) for b in map(int, fs.child_values(
                    self.spark, f"{base}/group={group}/generation={generation}", "batch_id"))
                    if not any(first <= b <= last for first, last in spans)]
        return sorted(out)

    def refresh(self) -> Manifest:
        """Add the batches that came since; one small job over two columns of them."""
        with self._lock:
            return self._refreshed(self.load())

    def _refreshed(self, now: Manifest) -> Manifest:
        new = self._new_batches(now)
        if not new:
            return now
        folders = {b: fs.partition_folder(self.spark, "", topic=self.topic, group=b[0], generation=b[1], batch_id=b[2]).strip("/") for b in new}
        rows = (self.spark.read.schema(FILE_LOG_DATA).parquet(*(f"{self.root}/{f}" for f in folders.values()))
                .groupBy(F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("folder"), "partition")
                .agg(F.min("offset").alias("first"), F.max("offset").alias("last"), F.count("*").alias("n")).collect())  # one a batch and partition
        parts: dict[str, dict[int, tuple[int, int, int]]] = {}
        for r in rows:
            parts.setdefault("/".join(fs.unescaped(self.spark, r["folder"]).split("/")[-4:]), {})[r["partition"]] = (r["first"], r["last"] + 1, r["n"])
        added = [Segment(f, 0, parts.get(fs.unescaped(self.spark, f), {}), ((g, n, b, b),)) for (g, n, b), f in folders.items()]
        return self._publish(dataclasses.replace(now, version=now.version + 1, segments=(*now.segments, *added)))

    # ---- folding -----------------------------------------------------------
    def fold(self, least: int = FAN_IN, compression: str = "gzip") -> Manifest:
        """Fold the segments of every level that has `least` of them; then delete what the fold before replaced."""
        with self._lock:
            return self._folded(self.refresh(), least, compression)

    def _folded(self, now: Manifest, least: int, compression: str) -> Manifest:
        level = 0
        while any(s.level >= level for s in now.segments):
            these = [s for s in now.segments if s.level == level]
            level += 1
            if len(these) < least:
                continue
            path = f"_folded/topic={fs.escaped(self.spark, self.topic)}/{now.version + 1:020d}-{uuid.uuid4().hex[:8]}"
            # Small files are packed into tasks of maxPartitionBytes: no exchange.
            (self._read([s.path for s in these]).sortWithinPartitions("partition", "offset")
             .write.option("compression", compression).parquet(f"{self.root}/{path}"))
            parts: dict[int, tuple[int, int, int]] = {}
            for s in these:
                for p, (first, until, n) in s.parts.items():
                    a, b, c = parts.get(p, (first, until, 0))
                    parts[p] = (min(a, first), max(b, until), c + n)
            whole = Segment(path, level, parts, _joined(c for s in these for c in s.covers))
            gone = now.retired
            now = self._publish(Manifest(now.version + 1, (*(s for s in now.segments if s not in these), whole), tuple(s.path for s in these)))
            for folder in gone:
                fs.delete(self.spark, f"{self.root}/{folder}")
        return now

    # ---- reading -------------------------------------------------------------
    def _read(self, paths: list[str]) -> DataFrame:
        rows = self.spark.read.schema(FILE_LOG_DATA)
        return rows.parquet(*(f"{self.root}/{p}" for p in paths)) if paths else self.spark.createDataFrame([], FILE_LOG_DATA)

    def read_ranges(self, ranges: list[tuple[int, int, int]]) -> DataFrame:
        """TOPIC_LOG rows of (partition, from, until) ranges, one for each partition: only from folders that have some.

        The bounds reach the Parquet scan; the exact ranges are a small table (a row a partition).
        """
        wanted = {p: (a, b) for p, a, b in ranges if b > a}
        paths = [s.path for s in self.load().segments
                 if any(p in wanted and first < wanted[p][1] and until > wanted[p][0] for p, (first, until, _) in s.parts.items())]
        rows = self._read(paths).withColumn("topic", F.lit(self.topic))
        if wanted:
            bounds = ((F.col("offset") >= min(a for a, _ in wanted.values())) & (F.col("offset") < max(b for _, b in wanted.values()))
                      & (F.col("partition") >= min(wanted)) & (F.col("partition") <= max(wanted)))
            table = self.spark.createDataFrame([(p, a, b) for p, (a, b) in wanted.items()], "partition int, _from long, _until long")
            rows = rows.where(bounds).join(table, "partition").where("offset >= _from and offset < _until")
        return rows.select("topic", "partition", "offset", "key", "value", "timestamp")


def own_folder(spark: SparkSession, root: str, topic: str) -> str:
    """Where the writer of a log keeps its manifest."""
    return fs.partition_folder(spark, f"{root.rstrip('/')}/_manifests", topic=topic)


def kept_beside(spark: SparkSession, root: str, topic: str) -> bool:
    """Whether the log's writer keeps a manifest."""
    return fs.exists(spark, own_folder(spark, root, topic))


def folded_parts(spark: SparkSession, root: str, topic: str) -> tuple[list[str], Column | None]:
    """Folders of folded segments, and the condition of batch folders that they stand for (None without folds)."""
    folded = [s for s in ManifestLog(spark, root, topic).load().segments if s.level > 0] if kept_beside(spark, root, topic) else []
    condition = None
    for group, generation, first, last in (c for s in folded for c in s.covers):
        one = (F.col("group") == group) & (F.col("generation") == generation) & F.col("batch_id").between(first, last)
        condition = one if condition is None else condition | one
    return [f"{root.rstrip('/')}/{s.path}" for s in folded], condition
