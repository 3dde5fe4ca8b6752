"""A file log as a stream of offset ranges.

The stream's offsets are {partition: next offset}, as a broker's are; a batch has
one row for each partition with new records, its offset range, and `read_limit`
bounds the records of a batch.  The rows are a few numbers: the records themselves are
read by the batch, on executors, from the folders that the manifest names for the
ranges (`ManifestLog.read_ranges`).  A batch that is repeated asks for the same
offsets, whatever was written or folded in between.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from spillway.streaming import fs

FORMAT = "spillway_ranges"


def _source():
    """The data source class.  It is made here, without names of this package, so that a Python worker needs none."""
    import json

    from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

    class RangeReader(SimpleDataSourceStreamReader):
        def __init__(self, options):
            self.folder, self.limit = options["manifests"], int(options.get("limit") or 0)
            self.starts = json.loads(options.get("starts") or "{}")

        def initialOffset(self):
            return self.starts

        def _newest(self):
            from urllib.parse import quote

            import pyarrow.fs as pafs
            store, path = pafs.FileSystem.from_uri(quote(self.folder, safe="/:@"))
            files = sorted(f.path for f in store.get_file_info(pafs.FileSelector(path, allow_not_found=True)) if f.path.endswith(".json"))
            if not files:
                return {}
            with store.open_input_stream(files[-1]) as f:
                return json.loads(f.read().decode())["newest"]

        def read(self, start):
            new = {p: (int(start.get(p, 0)), int(end)) for p, end in self._newest().items()}
            new = {p: (a, b) for p, (a, b) in sorted(new.items(), key=lambda x: int(x[0])) if b > a}
            total = sum(b - a for a, b in new.values())
            if self.limit and total > self.limit:
                # In proportion to what waits; what rounding leaves over goes to the first partitions that have more.
                share = {p: (b - a) * self.limit // total for p, (a, b) in new.items()}
                over = self.limit - sum(share.values())
                for p, (a, b) in new.items():
                    more = min(over, b - a - share[p], 1)
                    share[p], over = share[p] + more, over - more
                new = {p: (a, a + share[p]) for p, (a, b) in new.items() if share[p]}
            rows = [(int(p), a, b) for p, (a, b) in new.items()]
            return iter(rows), {**start, **{p: b for p, (_, b) in new.items()}}

        def readBetweenOffsets(self, start, end):
            spans = ((int(p), int(start.get(p, 0)), int(b)) for p, b in end.items())
            return iter(sorted(s for s in spans if s[2] > s[1]))

        def commit(self, end):
            pass

    class Ranges(DataSource):
        @classmethod
        def name(cls):
            return "spillway_ranges"

        def schema(self):
            return "partition int, from_offset long, until_offset long"

        def simpleStreamReader(self, schema):
            return RangeReader(self.options)

    return Ranges


def read_range_stream(spark: SparkSession, manifests: str, starts: dict[int, int], limit: int | None = None) -> DataFrame:
    """A stream of (partition, from_offset, until_offset) over the log whose manifest is in the folder `manifests`.

    Partitions that `starts` doesn't name begin at 0."""
    spark.dataSource.register(_source())
    return (spark.readStream.format(FORMAT).option("manifests", fs.qualified(spark, manifests))
            .option("starts", json.dumps({str(p): int(o) for p, o in starts.items()})).option("limit", str(limit or 0)).load())
