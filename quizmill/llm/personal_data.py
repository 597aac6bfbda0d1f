"""Personal data: base patterns plus spans found by a semi-Markov conditional random field.

The base finds e-mail addresses, IP addresses, card and phone numbers by fixed
patterns (leftmost, non-overlapping, each kind by itself).  The model segments
the neighbourhood of digits and address signs: a segment is a run of tokens, at
most ``MOST_TOKENS`` long, scored as a whole (features of the span, not of its
tokens) for each kind; a dynamic program over the segment ends chooses
boundaries and kinds jointly; of equally good segmentations none goes before a
segment, a longer segment before a shorter, and the kind listed first.  Its weights are trained by maximum
likelihood on a bounded sample of zones (``training_zones``), some for each kind
of personal data and some without any, whose labels are the base spans, as they
stand and in rewritten forms that the patterns miss (no plus sign, "(at)", other
separators).  Model spans that touch no base span are added; base spans stay.

Nulls: a null text is an empty one; doc_id may be null or repeated, rows are
judged one by one.  Empty tables give no rows.  Offsets are code points, end
exclusive.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import add_columns, map_frames, staged, table

KINDS = ("email", "ip", "card", "phone")
MOST_TOKENS = 18
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: Starts only where a run of digits starts: from inside the run the pattern fails just the same.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SEED = re.compile(r"[0-9][0-9 ().+-]{5,}|@|[(\[]at[)\]]")
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|\s|.", re.S)
_CUES = tuple(re.compile(p + r"\W{0,3}$", re.I) for p in (r"mail|contact|write", r"\bip|host|addr\w*|server", r"card|visa|credit|pay\w*", r"tel|phone|call|mobile|fax|ring"))


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) << (k & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, by kind and start."""
    out = []
    last, at = 0, text.find("@")
    while at >= 0:
        before = text[last:at]
        local = len(before) - len(before.rstrip(_LOCAL))
        if local and (m := _DOMAIN.match(text, at + 1)):
            out.append(("email", at - local, m.end()))
            last = m.end()
        else:
            last = at + 1
        at = text.find("@", last)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append(("phone", *m.span()))
    return out


FEATURES = ("bias", "at sign", "at word", "dotted domain", "blank in name", "three dots", "parts to 255", "digits < 7", "digits 7-8", "digits 9-12", "digits 13-19", "digits > 19", "luhn",
            "plus", "bracket", "blank", "dash", "dot", "letters", "one run", "groups of 4", "3-4 ending", "joined left", "joined right", "odd edge",
            "cue mail", "cue host", "cue card", "cue phone")
_GROUPED = re.compile(r"(?:\d{4}[ .-]){3}\d{1,7}$")
_ENDING = re.compile(r"\d{3}[)]?[ .-]\d{3}[ .-]\d{4}$")
_DOTTED = re.compile(r"[A-Za-z0-9-]+(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]+)+$", re.I)
_AT_WORD = re.compile(r" ?[(\[]at[)\]] ?", re.I)


def features(text: str, start: int, end: int) -> list[float]:
    """What the model sees of one span."""
    s = text[start:end]
    digits = "".join(c for c in s if "0" <= c <= "9")
    n = len(digits)
    parts = s.split(".")
    quad = len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 for p in parts)
    sign = "@" if "@" in s else (m.group() if (m := _AT_WORD.search(s)) else "")
    before = text[max(0, start - 16):start]
    return [1, "@" in s, bool(sign) and sign != "@", bool(sign) and bool(_DOTTED.match(s.split(sign, 1)[1])), bool(sign) and " " in s.split(sign, 1)[0], s.count(".") == 3, quad and all(int(p) <= 255 for p in parts),
            n < 7, 7 <= n <= 8, 9 <= n <= 12, 13 <= n <= 19, n > 19, n > 0 and luhn(digits), s[0] == "+", "(" in s, " " in s, "-" in s, "." in s, any(c.isalpha() for c in s), s.isdigit(),
            bool(_GROUPED.match(s)), bool(_ENDING.search(s)), before[-1:].isalnum() or before[-1:] in ("_", "=", "/"), text[end:end + 1].isalnum() or text[end:end + 1] in ("_", "@", "="),
            not (s[-1].isalnum() and (s[0].isalnum() or s[0] in "+(")), *(bool(c.search(before)) for c in _CUES)]


def zones(text: str) -> list[list[tuple[int, int]]]:
    """Token spans around seeds; outside of them no segment but the empty kind is possible."""
    wide: list[list[int]] = []
    for m in _SEED.finditer(text):
        a, b = max(0, m.start() - 40), min(len(text), m.end() + 40)
        if wide and a <= wide[-1][1]:
            wide[-1][1] = b
        else:
            wide.append([a, b])
    return [[m.span() for m in _TOKEN.finditer(text, a, b)] for a, b in wide]


def candidates(text: str, tokens: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(first token, token behind the last) of the segments that may be of a kind."""
    out = []
    for i, (a, _) in enumerate(tokens):
        c = text[a]
        if not (c.isalnum() or c in "+("):
            continue
        digits = sign = 0
        for j in range(i, min(len(tokens), i + MOST_TOKENS)):
            x, y = tokens[j]
            t = text[x:y]
            if t == "\n" or (t.isspace() and text[x - 1].isspace()):
                break
            if t[0].isdigit():
                digits += y - x
            elif t == "@" or (t == "at" and text[x - 1] in "(["):
                sign += 1
            elif not sign and digits >= 7 and t[0].isalpha():
                break
            if (digits >= 7 or sign == 1) and t[-1].isalnum() and not (sign == 1 and t in ("@", "at")):
                out.append((i, j + 1))
    return out


def _forward(ends: list[list[int]], segments, scores: np.ndarray, n: int, best: bool):
    """Log-sum (or maximum and its way) over all segmentations of n tokens."""
    value, back = np.zeros(n + 1), [None] * (n + 1)
    for j in range(1, n + 1):
        options = [value[j - 1]]
        keys = [None]
        for k in ends[j]:
            for y in range(len(KINDS)):
                options.append(value[segments[k][0]] + scores[k, y])
                keys.append((k, y))
        if best:
            w = int(np.argmax(options))
            value[j], back[j] = options[w], keys[w]
        else:
            top = max(options)
            value[j] = top + np.log(np.sum(np.exp(np.array(options) - top)))
    return value, back


def decode(text: str, tokens, weights: np.ndarray) -> list[tuple[str, int, int]]:
    """The best segmentation of one zone: its spans of a kind."""
    segments = candidates(text, tokens)
    if not segments:
        return []
    scores = np.array([features(text, tokens[i][0], tokens[j - 1][1]) for i, j in segments], float) @ weights.T
    ends: list[list[int]] = [[] for _ in range(len(tokens) + 1)]
    for k, (_, j) in enumerate(segments):
        if scores[k].max() > 0:
            ends[j].append(k)
    _, back = _forward(ends, segments, scores, len(tokens), True)
    out, j = [], len(tokens)
    while j > 0:
        if back[j] is None:
            j -= 1
        else:
            k, y = back[j]
            i = segments[k][0]
            out.append((KINDS[y], tokens[i][0], tokens[segments[k][1] - 1][1]))
            j = i
    return out[::-1]


def _gradient(text: str, tokens, gold: set, weights: np.ndarray) -> np.ndarray | None:
    """Of the log likelihood of the gold segmentation of one zone."""
    segments = candidates(text, tokens)
    if not segments:
        return None
    feats = np.array([features(text, tokens[i][0], tokens[j - 1][1]) for i, j in segments], float)
    scores = feats @ weights.T
    n = len(tokens)
    ends: list[list[int]] = [[] for _ in range(n + 1)]
    for k, (_, j) in enumerate(segments):
        ends[j].append(k)
    alpha, _ = _forward(ends, segments, scores, n, False)
    turned = [(n - j, n - i) for i, j in segments]
    rends: list[list[int]] = [[] for _ in range(n + 1)]
    for k, (_, j) in enumerate(turned):
        rends[j].append(k)
    beta, _ = _forward(rends, turned, scores, n, False)
    first, behind = np.array([s[0] for s in segments]), np.array([s[1] for s in segments])
    share = np.exp(np.minimum(0, alpha[first][:, None] + scores + beta[n - behind][:, None] - alpha[n]))
    true = np.zeros_like(share)
    for k, (i, j) in enumerate(segments):
        for y, kind in enumerate(KINDS):
            true[k, y] = (kind, tokens[i][0], tokens[j - 1][1]) in gold
    return (true - share).T @ feats


def rewritten(text: str, spans: list, r: random.Random) -> tuple[str, list]:
    """The text with its base spans in forms that the patterns miss, and where those stand."""
    out, at, moved = [], 0, []
    size = 0
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        if a < at:
            continue
        s = text[a:b]
        if kind == "email":
            s = s.replace("@", r.choice([" (at) ", "(at)", " [at] ", "[at]"]))
        elif kind == "phone" and _ENDING.search(s):
            s = s[s.find("("):] if "(" in s else s.lstrip("+")
        elif kind == "card":
            digits = re.sub(r"\D", "", s)
            s = ".".join(digits[k:k + 4] for k in range(0, len(digits), 4))
        out += [text[at:a], s]
        size += a - at
        moved.append((kind, size, size + len(s)))
        size += len(s)
        at = b
    return "".join(out) + text[at:], moved


#: A text that may hold a kind of personal data, for the choice of training texts.
_MAY_HOLD = {"email": "@", "ip": r"[0-9]+(\.[0-9]+){3}", "card": r"[0-9]([ -]?[0-9]){12}", "phone": r"\+[0-9][ ().0-9-]{7}"}
#: Training: texts of each kind and of none, zones of a text, and tokens of a zone, at most.
TEXTS_OF_KIND = 75
ZONES_OF_TEXT = 20
ZONE_TOKENS = 200


def zone_texts(text: str, kind: str | None) -> list[str]:
    """The first zones that hold base spans of ``kind`` (``None``: any zones), each as a text of its own, cut at white space."""
    spans = sorted((a, b) for k, a, b in base_spans(text) if k == kind)
    ends, out = [b for _, b in spans], []
    for z in zones(text):
        for k in range(0, len(z), ZONE_TOKENS):
            a, b = z[k][0], z[min(len(z), k + ZONE_TOKENS) - 1][1]
            at = bisect_left(ends, a)
            if kind is None or (at < len(spans) and spans[at][0] < b):
                while a > 0 and not text[a - 1].isspace() and z[k][0] - a < 80:
                    a -= 1
                while b < len(text) and not text[b].isspace() and b - z[k][0] < 4000:
                    b += 1
                out.append(text[max(0, a - 20):b])
                if len(out) == ZONES_OF_TEXT:
                    return out
    return out


def training_zones(docs: DataFrame, texts_of_kind: int = TEXTS_OF_KIND) -> list[str]:
    """A bounded sample for ``train``: of each kind the zones of ``texts_of_kind`` texts that may hold it, and of as many that hold none.

    Texts are taken by the smallest hash, whatever their length; only hashes are
    compared, and only zones leave the tasks.  At most ``ZONES_OF_TEXT`` zones of a
    text and ``ZONE_TOKENS`` tokens of a zone are taken, so the sample has at most
    5 * texts_of_kind * ZONES_OF_TEXT zones, however many and long the texts are.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    may = {k: text.rlike(p) for k, p in _MAY_HOLD.items()}
    none = text.rlike("[0-9]")
    for c in may.values():
        none = none & ~c
    hashed = staged(docs.select(F.xxhash64("text").alias("h"), *[c.alias(k) for k, c in {**may, "none": none}.items()])
                    .where(" OR ".join([*KINDS, "none"])).distinct(), "personal-hashes")
    wanted = {k: {r.h for r in hashed.where(k).select("h").orderBy("h").limit(texts_of_kind).collect()} for k in [*KINDS, "none"]}
    every = sorted(set().union(*wanted.values()))
    taken = docs.select("text", F.xxhash64("text").alias("h")).where(F.col("h").isin(every)) if every else docs.select("text", F.lit(0).cast("long").alias("h")).limit(0)

    def run(frames):
        for frame in frames:
            found = {z for t, h in zip(frame["text"], frame["h"]) for k in wanted if h in wanted[k] for z in zone_texts(t, None if k == "none" else k)}
            yield pd.DataFrame({"zone": sorted(found)}, dtype=object)

    return sorted(r.zone for r in map_frames(taken, run, "zone string").distinct().collect())


def train(docs: DataFrame, texts_of_kind: int = TEXTS_OF_KIND, rounds: int = 8, seed: int = 10) -> np.ndarray:
    """Weights (kind x feature), fitted on ``training_zones``: as they stand, and in forms that the patterns miss."""
    r = random.Random(seed)
    examples = []
    for text in training_zones(docs, texts_of_kind):
        gold = base_spans(text)
        for t, spans in ((text, gold), rewritten(text, gold, r)) if gold else ((text, gold),):
            examples += [(t, z, {s for s in spans if z[0][0] <= s[1] and s[2] <= z[-1][1]}) for z in zones(t)]
    weights, power = np.zeros((len(KINDS), len(FEATURES))), np.full((len(KINDS), len(FEATURES)), 1e-6)
    weights[:, 0] = -2
    for _ in range(rounds):
        r.shuffle(examples)
        for t, z, gold in examples:
            g = _gradient(t, z, gold, weights)
            if g is not None:
                g -= 1e-4 * weights
                power += g * g
                weights += 0.5 * g / np.sqrt(power)
    return weights


def spans_of(text: str, weights: np.ndarray) -> tuple[list, list]:
    """(base spans, all spans) of one text, each by kind and start."""
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    starts, behind = [a for a, _ in taken], list(accumulate((b for _, b in taken), max))
    added = []
    for z in zones(text):
        for kind, a, b in decode(text, z, weights):
            before = bisect_left(starts, b)  # base spans that begin before b: one reaches over a, if any does
            if not before or behind[before - 1] <= a:
                added.append((kind, a, b))
    order = {k: i for i, k in enumerate(KINDS)}
    return base, sorted(base + added, key=lambda s: (order[s[0]], s[1], s[2]))


def find_personal_data(docs: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """``docs`` with _base and _spans: arrays of (kind, start, end)."""
    weights = train(docs) if weights is None else weights

    def find(cols):
        found = [spans_of(t, weights) if t else ([], []) for t in cols["text"]]
        as_rows = lambda spans: [{"kind": k, "start": a, "end": b} for k, a, b in spans]
        return {"_base": [as_rows(b) for b, _ in found], "_spans": [as_rows(s) for _, s in found]}

    span = "array<struct<kind:string,start:int,end:int>>"
    return add_columns(docs, ["text"], find, f"_base {span}, _spans {span}")


def op10_semi_markov_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text of ``documents``: counts and checksum of the base spans, and all spans."""
    found = find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
    count = lambda k: F.size(F.filter("_base", lambda s: s.kind == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *(count(k) for k in KINDS), F.sha2(joined("_base").cast("binary"), 256).alias("base_sha256"), joined("_spans").alias("spans"), F.size("_spans").cast("long").alias("n_spans"))
