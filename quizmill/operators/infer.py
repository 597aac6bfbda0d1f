"""Model calls as a partitioned batch job (K1-K5).

``run_requests`` maps a request table through a user backend with
``mapInPandas`` (Arrow batches).  The backend is built once per task, each
request is tried up to ``max_attempts`` times (clean + validate inside the
attempt), and failures are data: ``attempt_count`` and the last ``error``
are columns, never exceptions.  Request ids are deterministic, so a retried
or speculative task asks the same questions again.

Backend protocol: ``backend(batch: pd.DataFrame, attempt: int) -> list``
returning, per row, the raw response text or an Exception instance.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from ..schemas import BLOOMS, MAX_ATTEMPTS

RESULT_SCHEMA = "request_id string, attempt_count int, raw string, error string"

Backend = Callable[[pd.DataFrame, int], list]


def run_requests(requests: DataFrame, backend_factory: Callable[[], Backend],
                 validator: Callable[[str], None] | None = None, max_attempts: int = MAX_ATTEMPTS,
                 partitions: int | None = None, keep: list[str] | None = None,
                 materialize: bool = True, per_task: int = 2000, batch_rows: int = 200,
                 count: int | None = None) -> DataFrame:
    """Run every request through the backend; returns request_id, the
    ``keep`` columns, attempt_count, raw (last good response) and error
    (last failure).

    With ``materialize`` (default) the responses are written once to the
    shared folder before anything reads them, so downstream
    joins never call the backend twice and a lost executor does not replay
    model calls.  ``per_task`` requests make one task and ``batch_rows`` one
    backend call, so a task holds few prompts and replies at a time.  A backend
    that raises fails its batch for that attempt; one that returns fewer replies
    than requests fails those without a reply.  ``count`` is the number of
    requests, if it is known already.
    """
    from ..session import ship_package
    ship_package(requests.sparkSession)
    keep = list(keep or [])
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in requests.schema.fields if f.name in keep)
    schema = "request_id string, " + (kept + ", " if kept else "") + "attempt_count int, raw string, error string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        backend = backend_factory()
        for pdf in (b.iloc[k: k + batch_rows].reset_index(drop=True) for b in batches for k in range(0, len(b), batch_rows)):
            raw = [None] * len(pdf)
            err = [None] * len(pdf)
            tries = [0] * len(pdf)
            todo = list(range(len(pdf)))
            for attempt in range(1, max_attempts + 1):
                if not todo:
                    break
                try:
                    out = list(backend(pdf.iloc[todo].reset_index(drop=True), attempt))
                except Exception as e:  # noqa: BLE001 - failures are data
                    out = [e] * len(todo)
                out += [RuntimeError("no reply")] * (len(todo) - len(out))
                left = []
                for i, r in zip(todo, out):
                    tries[i] = attempt
                    try:
                        if isinstance(r, BaseException):
                            raise r
                        if not isinstance(r, str):
                            raise TypeError("reply is no text")
                        if validator is not None:
                            validator(r)
                        raw[i], err[i] = r, None
                    except Exception as e:  # noqa: BLE001 - failures are data
                        err[i] = f"{type(e).__name__}: {e}"
                        left.append(i)
                todo = left
            cols = {"request_id": pdf["request_id"]}
            cols.update({k: pdf[k] for k in keep})
            cols.update({"attempt_count": tries, "raw": [r if e is None else None for r, e in zip(raw, err)],
                         "error": err})
            yield pd.DataFrame(cols)

    # Requests are small in bytes but expensive to serve: AQE would coalesce
    # them into a few tasks, so they are dealt by id into tasks of a given
    # number of requests (an explicit count is never coalesced).
    n = partitions or max(1, -(-(requests.count() if count is None else count) // per_task))
    out = requests.repartition(n, "request_id").mapInPandas(run, schema)
    if materialize:
        from ..session import staged
        out = staged(out, "responses")
    return out


# ---------------------------------------------------------------------------
# Validators (the typed / free JSON checks done inside an attempt)
# ---------------------------------------------------------------------------

_FENCE_HEAD = re.compile(r"^(?:```json)?(?:```)?")
_CTRL = re.compile(r"[\x00-\x08\x0b-\x1f\x7f-\x9f]")


def clean_text(text: str) -> str:
    t = _FENCE_HEAD.sub("", text.strip(), count=1)
    if t.endswith("```"):
        t = t[:-3]
    return _CTRL.sub(" ", t).strip()


def json_validator(text: str) -> None:
    json.loads(clean_text(text))


def section_validator(qtype: str) -> Callable[[str], None]:
    def check(text: str) -> None:
        groups = json.loads(clean_text(text))[qtype]
        if len(groups) != 6 or any(not g["questions"] or g["bloom_taxonomy"] not in BLOOMS for g in groups):
            raise ValueError("section must have six non-empty level groups")
    return check
