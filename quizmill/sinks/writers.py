"""Sinks: banks, reports and stage snapshots.

Banks and reports are partitioned by run, class and subject: a run replaces
only what it wrote itself under the same run id (so a retried run is safe) and
never touches what other runs wrote.  Readers take the latest run of each
chapter.  Snapshots only ever append.

``write_run`` writes all parts of a run below one folder and marks the run as
finished last, by one row in its table of runs.  ``read_finished`` shows finished
runs only, so a run that was stopped between two parts changes nothing for
readers, and repeating it under its id replaces what it left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import snapshot_name
from ..schemas import STAGES
from ..session import existing


def _write_run(rows: DataFrame, out: str, run_id: str) -> None:
    (rows.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id", "class_name", "subject_name").json(out))


def write_banks(banks: DataFrame, out: str, run_id: str) -> None:
    """One JSON bank per chapter, below its run, class and subject (A7); run ids ascend by time."""
    _write_run(banks.select("class_name", "subject_name", "chapter_id", "bank_json"), out, run_id)


def write_reports(reports: DataFrame, out: str, run_id: str) -> None:
    """Chapter verification reports (A8): rows with chapter_id, class_name and subject_name."""
    _write_run(reports, out, run_id)


def read_latest(spark: SparkSession, out: str, runs: DataFrame | None = None) -> DataFrame:
    """What the latest run that holds a chapter wrote for it: one row per chapter.  ``runs`` (run_id): only these count."""
    rows = spark.read.option("recursiveFileLookup", "false").json(out).withColumn("run_id", F.col("run_id").cast("string"))
    if runs is not None:
        rows = rows.join(runs.select("run_id").distinct(), "run_id", "left_semi")
    latest = rows.groupBy("chapter_id").agg(F.max("run_id").alias("run_id"))
    return rows.join(latest, ["chapter_id", "run_id"])


def snapshot_header(class_name: Column, subject_name: Column, chapter_name: Column, stage: Column,
                    ts_text: Column) -> Column:
    """Four-line header: Backup / Stage / Timestamp / a rule of 80 ``=``, then a blank line."""
    return F.concat(F.lit("Backup: "), class_name, F.lit(" - "), subject_name, F.lit(" - "), chapter_name,
                    F.lit("\nStage: "), stage, F.lit("\nTimestamp: "), ts_text,
                    F.lit("\n" + "=" * 80 + "\n\n"))


def snapshot_rows(banks: DataFrame, stage: str, run_ts: Column) -> DataFrame:
    """Snapshot records for one stage: file name, header and payload."""
    if stage not in STAGES:
        raise ValueError(f"unknown stage {stage!r}")
    ts_text = F.date_format(run_ts, "yyyyMMdd_HHmmss")
    st = F.lit(stage)
    return banks.select(
        "class_name", "subject_name", "chapter_name", st.alias("stage"), ts_text.alias("run_ts"),
        snapshot_name(F.col("class_name"), F.col("subject_name"), F.col("chapter_name"), st, run_ts).alias("file_name"),
        snapshot_header(F.col("class_name"), F.col("subject_name"), F.col("chapter_name"), st, ts_text).alias("header"),
        F.col("bank_json").alias("payload"))


def write_snapshots(rows: DataFrame, out: str, repeated: bool = False) -> None:
    """Append-only snapshot store, partitioned by stage and run time; ``repeated`` replaces what the same stage and time hold."""
    if repeated:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("stage", "run_ts").parquet(out)
    else:
        rows.write.mode("append").partitionBy("stage", "run_ts").parquet(out)


RUN_SCHEMA = "run_id string, run_ts string"


def write_run(parts: dict[str, DataFrame], root: str, run_ts: Column) -> str:
    """Write what ``plans.pipeline.build_banks`` gave as one run, and mark it as finished; returns the run's id.

    In order: the generated banks and their snapshot; the reports, where a model
    verified, and the snapshot of the verified stage; the final banks, which
    replace the generated ones, and their snapshot; the mark.  The id is the run's
    time, so ids ascend, and a run that is repeated with the same time replaces
    its own parts.
    """
    spark = parts["banks"].sparkSession
    run_id = spark.range(1).select(F.date_format(run_ts, "yyyyMMdd_HHmmss")).first()[0]
    banks, snapshots = f"{root}/banks", f"{root}/snapshots"

    def snapshot(rows: DataFrame, stage: str) -> None:
        write_snapshots(snapshot_rows(rows, stage, run_ts), snapshots, repeated=True)

    write_banks(parts["generated_banks"], banks, run_id)
    snapshot(parts["generated_banks"], STAGES[0])
    if "reports" in parts:
        write_reports(parts["reports"], f"{root}/reports", run_id)
    snapshot(parts["generated_banks"], STAGES[1])
    write_banks(parts["banks"], banks, run_id)
    snapshot(parts["banks"], STAGES[2])
    spark.createDataFrame([(run_id, run_id)], RUN_SCHEMA).write.mode("append").json(f"{root}/runs")
    return run_id


def finished_runs(spark: SparkSession, root: str) -> DataFrame:
    """(run_id): the runs marked as finished."""
    return existing(spark, f"{root}/runs", RUN_SCHEMA, "json").select("run_id").distinct()


def read_finished(spark: SparkSession, root: str, part: str = "banks") -> DataFrame:
    """``banks`` or ``reports`` of the latest finished run of each chapter."""
    return read_latest(spark, f"{root}/{part}", finished_runs(spark, root))
