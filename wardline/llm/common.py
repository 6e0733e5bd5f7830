"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.session import checkpoint_dir, scratch_table_path

# ---- fixed values: the word pattern (everything between ASCII white space) ----
WORD = r"[^\x20\x09-\x0D]+"
# -------------------------------------------------------------------------------


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, as Spark reads it (any path that Spark can open)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from there."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder, under a name of its own, and read it back."""
    path = f"{scratch_table_path(df.sparkSession, name)}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


Batch = TypeVar("Batch")


def tidy(run: Callable[[Iterator[Batch]], Iterator[Batch]]) -> Callable[[Iterator[Batch]], Iterator[Batch]]:
    """A batch function that hands its memory back to the system when its task ends.

    Python workers live on from one stage to the next; without this, each keeps the most
    that any earlier stage took.
    """

    def tidied(batches: Iterator[Batch]) -> Iterator[Batch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def give_back() -> None:
    """Memory that this process no longer uses goes back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: nothing to do
        pass


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def word_count(col: str | Column) -> Column:
    """Words of a text as long; null and empty texts have none."""
    return F.regexp_count(text_or_empty(col), F.lit(WORD)).cast("long")


def digest(*parts: Column | str) -> Column:
    """Hex digest of the parts joined by ``:``; a seeded draw that any engine can redo."""
    cols = [F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("null")) for p in parts]
    return F.md5(F.concat_ws(":", *cols).cast("binary"))


def hex_fraction(hexdigest: Column, first: int = 0, digits: int = 13) -> Column:
    """``digits`` hex digits from position ``first`` as a number in [0, 1)."""
    return F.conv(F.substring(hexdigest, first + 1, digits), 16, 10).cast("double") / F.lit(float(16**digits))
