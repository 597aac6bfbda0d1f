"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton over the words of all items is built once for each block of
items; training texts stream through it word by word, which keeps the longest
match ending at each word.  Where that match reaches the window length, the
last words are a window of an item and count as hit.

Words are the runs of letters and digits after lower-casing A-Z (any character
above U+007F counts as part of a word).  A window is ``window`` consecutive
words of an item; an item with fewer words, but not none, is one window.

Nulls: a null text has no words, a null item text no windows; an item with a
null item_id marks words but is neither counted nor listed.  Repeated items
count once by item_id; repeated documents are judged one by one.  Empty tables
give no rows (documents) or no hits (items).
"""

from __future__ import annotations

import pickle
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import add_columns, apart, staged, table

WINDOW = 10
#: Words of items in one automaton; more items make more automata, each held by workers alone.
BLOCK_WORDS = 100_000
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def lowered(text: str | None) -> bytes:
    return (text or "").encode().translate(_LOWER)


class ItemAutomaton:
    """Suffix automaton of several word sequences, with the items of each window."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.items: dict[int, set] = {}  # state of a full window -> items
        self.short: dict[int, list[tuple[int, str | None]]] = {}  # state -> short items that end there
        rows = [(i, [self.ids.setdefault(w, len(self.ids)) for w in _WORD.findall(lowered(t))]) for i, t in items]
        rows = [(i, words) for i, words in rows if words]
        for _, words in rows:
            last = 0
            for w in words:
                last = self._extend(last, w)
        pairs: set[int] = set()
        self.least = min([window, *(len(words) for _, words in rows)])
        for item, words in rows:
            pairs.update(a * len(self.ids) + b for a, b in zip(words, words[1:]))
            state = 0
            for k, w in enumerate(words):
                state = self.next[state][w]
                if k + 1 >= window:
                    self.items.setdefault(self._cut(state), set()).add(item)
            if len(words) < window:
                while self.length[self.link[state]] >= len(words):
                    state = self.link[state]
                self.short.setdefault(state, []).append((len(words), item))
        self.pairs = np.array(sorted(pairs), np.int64)

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            q = self.next[last][w]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, w, q)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p != -1 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p != -1:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return new

    def _split(self, p: int, w: int, q: int) -> int:
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p != -1 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _state(self, length: int, follow: dict, link: int) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _cut(self, state: int) -> int:
        """The state of the last ``window`` words of a longer match."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set, int]:
        """(word ranges that are windows, their items, longest match seen) of one text."""
        ids = np.array([self.ids.get(w, -1) for w in words], np.int64)
        hits, found, longest = [], set(), 0
        if not len(self.ids) or not len(ids):
            return hits, found, longest
        # matches can only lie where neighbouring words are neighbours in an item, too
        pair = ids[:-1] * len(self.ids) + ids[1:]
        at = np.minimum(np.searchsorted(self.pairs, pair), max(0, len(self.pairs) - 1))
        joined = (ids[:-1] >= 0) & (ids[1:] >= 0) & (self.pairs[at] == pair if len(self.pairs) else False)
        breaks = np.flatnonzero(~joined) + 1
        starts, ends = np.append(0, breaks), np.append(breaks, len(ids))
        long = (ends - starts >= self.least) & (ids[starts] >= 0)
        for s, e in zip(starts[long].tolist(), ends[long].tolist()):
            state = length = 0
            for k, w in enumerate(ids[s:e].tolist(), s):
                while state and w not in self.next[state]:
                    state = self.link[state]
                    length = self.length[state]
                if w in self.next[state]:
                    state = self.next[state][w]
                    length += 1
                longest = max(longest, length)
                if length >= self.window:
                    hits.append((k + 1 - self.window, k + 1))
                    found |= self.items[self._cut(state)]
                if self.short:
                    t = state
                    while t > 0:
                        for n, item in self.short.get(t, ()):
                            if n <= length:
                                hits.append((k + 1 - n, k + 1))
                                found.add(item)
                        t = self.link[t]
        return hits, found, longest


def _automata(items: DataFrame, window: int, block_words: int) -> list[DataFrame]:
    """One-row frames (automaton as bytes), one for each block of items; built by tasks, kept in the shared folder."""
    words = F.size(F.split(F.coalesce("text", F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    total = items.select(F.sum(words)).first()[0] or 0
    blocks = max(1, -(-total // block_words))

    def build(frame):
        import pandas as pd
        rows = [(None if pd.isna(i) else str(i), None if pd.isna(t) else t) for i, t in zip(frame["item_id"], frame["text"])]
        return pd.DataFrame({"block": [frame["block"][0]], "automaton": [pickle.dumps(ItemAutomaton(rows, window))]})

    from ..session import ship_package
    ship_package(items.sparkSession)
    keyed = items.select(F.col("item_id").cast("string").alias("item_id"), "text",
                         F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).alias("block"))
    made = staged(keyed.groupBy("block").applyInPandas(build, "block long, automaton binary"), "automata")
    return [made.where(F.col("block") == b) for b in range(blocks)]


def scan_documents(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with _words (count), _hit (word ranges hit, merged), _items (ids) and _longest (match length).

    One pass over the texts for each block of items; the automaton of a block
    (bounded by ``block_words``) is the only thing sent to every worker.
    """
    out = docs
    state = "_words long, _hit array<array<long>>, _items array<string>, _longest long"
    automata = _automata(items, window, block_words)
    for k, block in enumerate(automata):
        row = block.select("automaton").first()
        sent = docs.sparkSession.sparkContext.broadcast(bytes(row[0]) if row else pickle.dumps(ItemAutomaton([], window)))

        def scan(cols, sent=sent, first=k == 0):
            automaton = _loaded(sent)
            result = {"_words": [], "_hit": [], "_items": [], "_longest": []}
            for i, text in enumerate(cols["text"]):
                words = _WORD.findall(lowered(text))
                hits, found, longest = automaton.scan(words)
                found = {x for x in found if x is not None}
                if not first:
                    hits += cols["_hit"][i]
                    found |= set(cols["_items"][i])
                    longest = max(longest, cols["_longest"][i])
                result["_words"].append(len(words))
                result["_hit"].append(merged(hits))
                result["_items"].append(sorted(found))
                result["_longest"].append(longest)
            return result

        if k == 0:
            out = add_columns(out, ["text"], scan, state)
        else:
            names = ["_words", "_hit", "_items", "_longest"]
            before = out.withColumnsRenamed({n: "_before" + n for n in names})
            out = add_columns(before, ["text", *("_before" + n for n in names[1:])],
                              lambda c, f=scan: f({n.replace("_before", ""): v for n, v in c.items()}), state).drop(*("_before" + n for n in names))
        if len(automata) > 1:
            out = staged(out, "scanned")
    return out


_LOADED: dict = {}


def _loaded(sent) -> ItemAutomaton:
    if _LOADED.get("id") is not sent:
        _LOADED.update(id=sent, automaton=pickle.loads(sent.value))
    return _LOADED["automaton"]


def merged(ranges: list) -> list[list[int]]:
    """Union of half-open ranges, in order."""
    out: list[list[int]] = []
    for a, b in sorted(map(tuple, ranges)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def without_words(text: str | None, ranges: list) -> str | None:
    """``text`` without the words of the ranges and what stands between them."""
    if not ranges:
        return text
    low, raw, out, at = lowered(text), text.encode(), [], 0
    spans = [m.span() for m in _WORD.finditer(low)]
    for a, b in ranges:
        out.append(raw[at: spans[a][0]])
        at = spans[b - 1][1]
    return b"".join([*out, raw[at:]]).decode()


@apart("doc_id", "text", "n_chars")
def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, max_coverage: float = 0.0) -> DataFrame:
    """``docs`` without test items; same columns.

    A document whose share of hit words is over ``max_coverage`` goes as a
    whole; of the others the hit spans are cut out of ``text`` (and ``n_chars``
    follows, where there is one).  At 0.0 every contaminated document goes.
    """
    scanned = scan_documents(docs, items, window)
    share = F.aggregate("_hit", F.lit(0).cast("long"), lambda n, r: n + r[1] - r[0]) / F.greatest("_words", F.lit(1))
    kept = scanned.where(share <= max_coverage)
    if max_coverage > 0:
        kept = add_columns(kept, ["text", "_hit"], lambda c: {"_clean": [without_words(t, h) for t, h in zip(c["text"], c["_hit"])]}, "_clean string")
        kept = kept.withColumn("text", F.col("_clean"))
        if "n_chars" in docs.columns:
            kept = kept.withColumn("n_chars", F.when(F.size("_hit") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return kept.select(*docs.columns)


def op5_suffix_automaton_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of ``benchmark`` in every whole text of ``documents``: words hit and items found, by document."""
    scanned = scan_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("_hit", F.lit(0).cast("long"), lambda n, r: n + r[1] - r[0])
    return scanned.select("doc_id", F.col("_words").alias("n_words"), hit.alias("n_hit"), F.size("_items").cast("long").alias("n_items"),
                          F.sha2(F.array_join("_items", ",").cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))
