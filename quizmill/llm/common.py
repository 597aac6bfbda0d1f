"""Helpers shared by the corpus operators: tables, files, batches, components."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.components import components
from ..session import sent_if_few, ship_package, staged, unsent, work_dir
from ..sources.tables import table

__all__ = ["components", "map_frames", "open_fs", "sent_if_few", "slices", "staged", "table", "text_bytes", "unsent", "work_dir"]


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of all texts of a column, summed by Spark (sizes partitions from data, not from cores)."""
    return docs.select(F.sum(F.octet_length(column))).first()[0] or 0


def open_fs(path: str):
    """(pyarrow filesystem, path inside it) of a shared path such as ``file:/x``, ``hdfs://..`` or ``/x``."""
    from pyarrow import fs
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def slices(sizes: list[int], most: int) -> Iterator[slice]:
    """Consecutive slices whose sizes sum to about ``most`` at a time (one entry at least)."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield slice(start, len(sizes))


def map_frames(df: DataFrame, func: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """``mapInPandas`` with this package shipped to the workers."""
    ship_package(df.sparkSession)
    return df.mapInPandas(func, schema)


def apart(*needed: str):
    """For a stage (docs, ...) -> docs that reads the columns ``needed``: all others travel in one struct.

    So they come back as they were, whatever their names; none can meet a name
    that the stage uses inside.
    """
    def wrapped(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @functools.wraps(stage)
        def run(docs: DataFrame, *args, **options) -> DataFrame:
            quoted = lambda c: F.col("`" + c.replace("`", "``") + "`")
            others = [c for c in docs.columns if c not in needed]
            if not others:
                return stage(docs, *args, **options)
            packed = docs.select(*[c for c in docs.columns if c in needed], F.struct(*map(quoted, others)).alias("others"))
            out = stage(packed, *args, **options)
            return out.select(*[F.col("others").getField(c).alias(c) if c in others else F.col(c) for c in docs.columns])
        return run
    return wrapped


def add_columns(df: DataFrame, columns: list[str], func: Callable[[dict], dict], added: str) -> DataFrame:
    """All columns of ``df`` as they are, plus those of the DDL string ``added``.

    ``func`` gets the named columns of an Arrow batch as Python lists and
    returns lists for the added ones.  Works on Arrow batches, so other columns
    pass through unread, whatever their type.  Added names must be new.
    """
    import pyarrow as pa
    import pyarrow.compute as pc
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    ship_package(df.sparkSession)
    extra = StructType.fromDDL(added)
    types = [(f.name, f.type) for f in to_arrow_schema(extra)]

    def run(batches):
        for whole in batches:
            first = whole.column(columns[0])
            sizes = pc.fill_null(pc.binary_length(first), 0).to_pylist() if pa.types.is_string(first.type) else [64] * whole.num_rows
            for part in slices(sizes, 4 << 20):
                b = whole.slice(part.start, part.stop - part.start)
                out = func({c: b.column(c).to_pylist() for c in columns})
                yield pa.RecordBatch.from_arrays(b.columns + [pa.array(out[n], t) for n, t in types],
                                                 names=b.schema.names + [n for n, _ in types])

    return df.mapInArrow(run, StructType(df.schema.fields + extra.fields))
