"""Stand-in model backends for tests: deterministic replies made from the request itself."""

import json
import re
from collections.abc import Callable

import pandas as pd

from quizmill.operators.infer import Backend
from quizmill.schemas import BLOOMS


def template_backend() -> Backend:
    """Variation backend: five stems of the item's level filled with the
    question (the per-row form of ``extractive.template_variations``)."""
    from quizmill.operators.extractive import STEMS

    def call(batch: pd.DataFrame, attempt: int) -> list:
        return [json.dumps([s.replace("{q}", q) for s in STEMS[b]], ensure_ascii=False)
                for q, b in zip(batch["question"], batch["bloom"])]
    return call


_SPLIT = re.compile(r"(?<=[.!?])\s+")
_WORD = re.compile(r"[^\W_]+")


def extractive_section(qtype: str, topic: str, text: str, n: int) -> str:
    """One typed section built from the section's own sentences."""
    sents = [s.strip() for s in _SPLIT.split(text or "") if s.strip()]
    if not sents:
        raise ValueError("section has no sentences")
    keys = []
    for s in sents:
        ws = _WORD.findall(s)
        keys.append(max(ws, key=len) if ws else s)
    groups = []
    for li, level in enumerate(BLOOMS):
        qs = []
        for k in range(n):
            j = (li * n + k) % len(sents)
            s, key = sents[j], keys[j]
            masked = s.replace(key, "_____", 1)
            nxt = [sents[(j + d) % len(sents)] for d in range(1, 4)]
            if qtype == "MCQs":
                opts = list(dict.fromkeys([key, *(keys[(j + d) % len(keys)] for d in range(1, len(keys))), "one", "two", "three"]))[:4]
                qs.append({"question": f"Which word completes ({li * n + k + 1}): {masked}", "options": opts, "answer": key,
                           "explanation": s, "variations": []})
            elif qtype == "fill_in_the_blanks":
                qs.append({"question": f"{masked} ({li * n + k + 1})", "answer": key, "variations": []})
            elif qtype == "short_answer":
                qs.append({"question": f"Explain ({li * n + k + 1}): {s}", "reference_answer": " ".join([s] + nxt[:1] if len(sents) > 1 else [s, "That is all."]),
                           "variations": []})
            else:
                qs.append({"question": f"Discuss {topic}, part {li * n + k + 1}", "reference_points": nxt, "reference_answer": "",
                           "variations": []})
        groups.append({"bloom_taxonomy": level, "questions": qs})
    return json.dumps({qtype: groups}, ensure_ascii=False)


def extractive_backend() -> Backend:
    """Generation backend: typed sections from the request's section text."""
    def call(batch: pd.DataFrame, attempt: int) -> list:
        out = []
        for q, t, s, n in zip(batch["qtype"], batch["topic"], batch["section"], batch["questions_per_level"]):
            try:
                out.append(extractive_section(q, t, s, int(n)))
            except Exception as e:  # noqa: BLE001
                out.append(e)
        return out
    return call


def flaky(factory: Callable[[], Backend], fails: Callable[[pd.DataFrame], pd.Series]) -> Callable[[], Backend]:
    """Failure injection: row r fails its first ``fails(batch)[r]`` attempts."""
    def make() -> Backend:
        inner = factory()

        def call(batch: pd.DataFrame, attempt: int) -> list:
            out = inner(batch, attempt)
            n = fails(batch).tolist()
            return [RuntimeError(f"injected failure {attempt}") if attempt <= k else r for r, k in zip(out, n)]
        return call
    return make


def rule_verdict(topic: str, items_json: str) -> str:
    """Verification backend: a typed topic verdict from simple checks
    (MCQ answer among options, blank marker present, repeated question text
    within the topic).  Entries exist only for items with issues."""
    from quizmill.schemas import QTYPES, VERIFICATION_KEYS
    items = json.loads(items_json)
    seen: set[str] = set()
    out = {k: [] for k in VERIFICATION_KEYS.values()}
    worst = 0
    dup = False
    rank = {"low": 1, "medium": 2, "high": 3, "critical": 4}
    idx = {q: 0 for q in QTYPES}
    for it in items:
        q = it["qtype"]
        issues = []
        norm = (it.get("question") or "").strip().lower()
        if norm in seen:
            issues.append({"issue_type": "duplicate", "description": "repeated question", "severity": "critical"})
            dup = True
        seen.add(norm)
        if q == "MCQs" and it.get("answer") not in (it.get("options") or []):
            issues.append({"issue_type": "incorrect", "description": "answer not among options", "severity": "critical"})
        if q == "fill_in_the_blanks" and "_____" not in (it.get("question") or ""):
            issues.append({"issue_type": "incorrect", "description": "no blank marker", "severity": "critical"})
        if issues:
            out[VERIFICATION_KEYS[q]].append({"question_index": idx[q], "is_valid": False, "issues": issues,
                                              "suggestion": None})
            worst = max(worst, *(rank[i["severity"]] for i in issues))
        idx[q] += 1
    quality = "excellent" if worst == 0 else "good" if worst <= 2 else "fair" if worst == 3 else "poor"
    return json.dumps({"topic": topic, **out, "overall_quality": quality, "has_duplicates": dup})


def verdict_backend() -> Backend:
    def call(batch: pd.DataFrame, attempt: int) -> list:
        return [rule_verdict(t, j) for t, j in zip(batch["topic"], batch["items_json"])]
    return call
