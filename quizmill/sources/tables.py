"""Parquet table access for the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


PART_BYTES_CONF = "spark.quizmill.partBytes"
PART_BYTES = 64 << 20


def dealt(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` in as many partitions as their texts need at ``spark.quizmill.partBytes`` each (64 MB if unset).

    Row groups can't be split, so a scan may put far more text into one task.
    The rows are dealt anew only where the scan gives fewer partitions than the
    bytes ask for, at any size of the table; otherwise nothing moves.
    """
    wanted = _wanted(rows, column)
    return rows if rows.select(column).rdd.getNumPartitions() >= wanted else rows.repartition(wanted)


def _wanted(rows: DataFrame, column: str) -> int:
    part_bytes = int(rows.sparkSession.conf.get(PART_BYTES_CONF, str(PART_BYTES)))
    return -(-(rows.select(F.sum(F.octet_length(column))).first()[0] or 0) // part_bytes)


def dealt_by(rows: DataFrame, key: str, column: str) -> DataFrame:
    """``rows`` dealt by ``key``, in at least four times the partitions ``dealt`` asks for and those the session shuffles into.

    What is derived from a row keeps its key, so groups by that key (and more
    columns) are made where the rows are: a text moves once, and what it grows
    into (several times its size, hence the smaller parts) doesn't move.
    """
    wanted = max(4 * _wanted(rows, column), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(wanted, key)
