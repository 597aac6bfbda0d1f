"""Spark session helpers.

The library never creates a cluster session on its own: jobs take the
session they are given.  ``local_session`` exists for tests, benches and
the command line only.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import broadcast

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "quizmill") -> SparkSession:
    """Session for tests and local benches (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.quizmill.partBytes", str(4 << 20))
        .config("spark.driver.memory", os.environ.get("QUIZMILL_DRIVER_MEM", "16g"))
        .config(CHECKPOINT_CONF, tempfile.mkdtemp(prefix="quizmill-ckpt-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can read: the session's checkpoint folder.

    Order: ``spark.checkpoint.dir`` as the session names it, the folder the
    context was given by ``setCheckpointDir``, and only when neither is set a
    folder inside the warehouse, which is shared by definition.  Nothing the
    user has set is ever replaced.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_quizmill"
    return root.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Give the context a checkpoint folder if it has none; return the folder in use."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_root(spark))
    return sc.getCheckpointDir()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder (created by whoever writes to it first)."""
    return f"{shared_root(spark)}/quizmill/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back (cuts lineage)."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unsent(side: DataFrame) -> DataFrame:
    """``side`` of a join, never to be broadcast: both sides are dealt by their keys and merged.

    For sides that grow with the input.  Spark judges a table by the bytes of its
    files; ids take a fifteenth of that there of what they take in the driver that
    would collect, index and send them.
    """
    return side.hint("merge")


#: Keys of at most so many rows are sent to every task where they meet texts.
SENT_KEYS = 250_000


def sent_if_few(keys: DataFrame) -> DataFrame:
    """``keys`` (written already), broadcast while there are at most ``SENT_KEYS``, so that the texts they meet needn't move."""
    return broadcast(keys) if keys.count() <= SENT_KEYS else unsent(keys)


def existing(spark: SparkSession, path: str, schema: str, kind: str = "parquet") -> DataFrame:
    """What is stored at ``path``; no rows where nothing has been written yet."""
    try:
        return spark.read.format(kind).schema(schema).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``quizmill`` importable on every Python worker (once per application).

    Functions handed to ``mapInPandas`` are pickled by reference, so workers
    must be able to import the package.  The package folder is zipped and
    added with ``addPyFile``; Spark copies it to each executor.
    """
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # noqa: BLE001 - remote sessions ship code by their own means
        return
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="quizmill-code-"), "quizmill.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, names in os.walk(pkg):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(base, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(app)
