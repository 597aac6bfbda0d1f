"""Ledger of model responses: what was paid for once is never asked again (K4).

The ledger is an append-only Parquet folder with a row per answered request,
keyed by request id and prompt digest (sha256 over the model's name and the
prompt).  A run asks only for requests without a good reply under their present
digest, so a changed prompt or model is asked anew, and so is a request whose
calls all failed.

A run may stop at any time.  Each task's replies become visible when that task
commits (the second algorithm of Hadoop's file committer), not when the whole job
ends: the next run asks exactly the requests of unfinished tasks.  ``per_task``
bounds what a stop can lose.  With a committer that publishes at the end of the
job only, a stopped run loses more, but nothing is ever recorded wrongly.

A request recorded several times (two runs at the same time) counts once: a good
reply goes before a failed one, then the smallest text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import existing, staged
from .infer import Backend, run_requests

KEYS = ["request_id", "prompt_digest"]
LEDGER_SCHEMA = "request_id string, prompt_digest string, attempt_count int, raw string, error string"
COMMIT_PER_TASK = ("mapreduce.fileoutputcommitter.algorithm.version", "2")


def prompt_digest(prompt: Column, model: str = "") -> Column:
    """Digest of everything that decides a reply; the model's name is set apart by its length."""
    return F.sha2(F.concat(F.lit(f"{len(model)}:{model}"), prompt), 256)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """One row per (request, digest): its good reply, else its last failure.  A missing ledger is an empty one."""
    return best_replies(existing(spark, ledger, LEDGER_SCHEMA))


def best_replies(rows: DataFrame) -> DataFrame:
    best = F.min(F.struct(F.col("raw").isNull().alias("failed"), "raw", "attempt_count", "error")).alias("best")
    return rows.groupBy(*KEYS).agg(best).select(*KEYS, "best.attempt_count", "best.raw", "best.error")


def pending(requests: DataFrame, replies: DataFrame) -> DataFrame:
    """Requests (with ``prompt_digest``) still to be asked, with the reason:
    ``new`` (never asked), ``changed`` (asked under another digest only) or ``failed``."""
    now = replies.select(*KEYS, F.col("raw").isNotNull().alias("good"))
    ever = replies.select("request_id").distinct().withColumn("known", F.lit(True))
    reason = F.when(F.col("good").isNotNull(), "failed").when(F.col("known"), "changed").otherwise("new")
    return (requests.join(now, KEYS, "left").where(~F.coalesce("good", F.lit(False))).join(ever, "request_id", "left")
            .withColumn("reason", reason).drop("good", "known"))


def ask(requests: DataFrame, backend_factory: Callable[[], Backend], ledger: str, model: str = "",
        validator: Callable[[str], None] | None = None, keep: list[str] | None = None, per_task: int = 200, **options) -> DataFrame:
    """Replies for all ``requests`` (request_id, prompt, ...): those in the ledger, and the rest from the backend, recorded.

    Returns request_id, the ``keep`` columns, attempt_count, raw and error like
    ``run_requests``; its other options may be given, too.
    """
    spark = requests.sparkSession
    asked = requests.withColumn("prompt_digest", prompt_digest(F.col("prompt"), model))
    keys = staged(asked.select(*KEYS), "request-keys")
    todo = staged(pending(keys, read_ledger(spark, ledger)).select(*KEYS), "requests-pending")
    (run_requests(asked.join(todo, KEYS, "left_semi"), backend_factory, validator, keep=["prompt_digest"], materialize=False,
                  per_task=per_task, count=todo.count(), **options)
     .select(*[f.split()[0] for f in LEDGER_SCHEMA.split(", ")])
     .write.mode("append").option(*COMMIT_PER_TASK).parquet(ledger))
    replies = staged(read_ledger(spark, ledger).join(keys, KEYS, "left_semi"), "replies")
    return (asked.select(*KEYS, *(keep or [])).join(replies, KEYS, "left")
            .select("request_id", *(keep or []), "attempt_count", "raw", "error"))
