"""Helpers of the operators: written intermediate tables and text keys."""

from __future__ import annotations

import hashlib
import io
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import spillway
from spillway.session import under_state
from spillway.streaming.fs import exists, qualified

BLANK_WORD = r"[^\x20\x09-\x0D]+"  # a word where the contracts define one


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers wherever they run: a zip in the state root, added once a session."""
    sc = spark.sparkContext
    folder, packed = Path(spillway.__file__).parent, io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for f in sorted(folder.rglob("*.py")):
            z.writestr(zipfile.ZipInfo(str(Path(folder.name) / f.relative_to(folder))), f.read_bytes())
    name = f"{folder.name}-{hashlib.sha256(packed.getvalue()).hexdigest()[:16]}.zip"
    if name in sc._python_includes:  # noqa: SLF001 - what addPyFile has added
        return
    uri = qualified(spark, under_state(spark, "llm", "code", name))
    if not exists(spark, uri):
        fs, path = pafs.FileSystem.from_uri(uri)
        own = f"{path}.{uuid.uuid4().hex}"
        fs.create_dir(str(Path(path).parent), recursive=True)
        with fs.open_output_stream(own) as out:
            out.write(packed.getvalue())
        fs.move(own, path)
    sc.addPyFile(uri)


class Workspace:
    """A fresh folder under the shared state root; tables written there survive lost executors."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        ship(spark)
        self.spark = spark
        self.root = under_state(spark, "llm", f"{name}-{uuid.uuid4().hex[:12]}")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table once and read it back: cuts lineage, fixes non-deterministic columns."""
        df.write.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))


def text_keys(text: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes: 128 bits that identify a text (null like empty)."""
    t = F.coalesce(text, F.lit(""))
    return F.xxhash64(t), F.xxhash64(F.lit(7), t)


def words_of(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in the text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(BLANK_WORD)), F.lit(0)).cast("long")


def whole_row(df: DataFrame) -> Column:
    """All columns of the input as one struct, so that no other column can clash with them."""
    return F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in df.columns))


def sorted_groups(batches, keys: int):
    """Groups of rows that agree in their first `keys` columns (whole numbers), from batches sorted by them.

    Yields one table a group; only the group at hand and one batch are held.
    """
    import numpy as np
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        now = (pa.concat_tables([held, now]) if held is not None else now).combine_chunks()
        new = np.zeros(now.num_rows - 1, bool)
        for c in range(keys):
            new |= np.diff(now.column(c).to_numpy()) != 0
        cuts = [0, *(np.flatnonzero(new) + 1)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield now.slice(a, b - a)
        held = now.slice(cuts[-1])
    if held is not None:
        yield held


def long_lists(values, offsets) -> pa.Array:
    """A list<long> column from flat uint64/int64 values and row offsets."""
    import numpy as np
    flat = pa.array(np.ascontiguousarray(values).view(np.int64))
    return pa.ListArray.from_arrays(pa.array(np.asarray(offsets, np.int32)), flat)


def free_name(df: DataFrame, wanted: str) -> str:
    """`wanted`, or with underscores in front if the input already has such a column (any case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted
