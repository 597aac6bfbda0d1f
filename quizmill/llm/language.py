"""Language identification as a mixture: which languages a document holds, and in which shares.

Each language is a smoothed distribution over hashed letter trigrams (of the
UTF-8 bytes of lower-cased words).  A document is a mixture of languages whose
unit is the word: expectation-maximisation estimates the shares from the words'
trigram likelihoods.  Languages enter one by one, the likeliest first, and one
is taken only if the log likelihood grows by more than a penalty per language
(half the logarithm of the number of words, times ``penalty``).

Learning uses rows with text and language whose crc32 of the doc_id, as text,
is not 0 modulo 5, and of these a hash sample of about ``most_rows`` a language
(a documented bound on the classifier's sample; predictions cover all rows).

Nulls: a null text, or one without a letter, is ``und`` with score 0; a null
doc_id is never held out nor learned from.  Without any row to learn from every
document is ``und``.  Rows are judged one by one, repeated ones too.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import add_columns, apart, map_frames, table

BUCKETS = 1 << 15
MOST_ROWS = 4000
UNKNOWN = "und"
#: Between trigrams drawn at random (0) and learned texts (1).
LEAST_FIT = 0.5
_LETTER = re.compile(r"[^\W\d_]")
#: ASCII characters that are no letters become blanks.
_BLANKS = bytes(b if chr(b).isalpha() or b > 127 else 32 for b in range(256))


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(trigram buckets, first trigram of each word, document of each word) of several texts."""
    raw = [t.lower().encode().translate(_BLANKS) for t in texts]
    a = np.frombuffer(b" " + b" ".join(raw) + b"  ", np.uint8)
    ends = np.cumsum([len(r) + 1 for r in raw])  # position of the blank behind each text
    middle = np.flatnonzero(a[1:-1] != 32) + 1
    x = a.astype(np.uint32)
    code = (x[middle - 1] << 16) | (x[middle] << 8) | x[middle + 1]
    bucket = (((code * np.uint32(2654435761)) >> np.uint32(8)) % np.uint32(BUCKETS)).astype(np.int32)
    first = np.flatnonzero(a[middle - 1] == 32)
    return bucket, first, np.searchsorted(ends, middle[first], side="right")


def learn(docs: DataFrame, most_rows: int = MOST_ROWS, smoothing: float = 0.5) -> tuple[list[str], np.ndarray]:
    """(languages, log probability of each bucket by language) from the rows to learn from."""
    rows = docs.select("text", "lang", F.crc32(F.col("doc_id").cast("string")).alias("crc")).where("text is not null and lang is not null and crc % 5 <> 0")
    per_lang = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one number a language
    share = F.lit(0.0)
    for lang, n in per_lang.items():
        share = F.when(F.col("lang") == lang, min(1.0, most_rows / n)).otherwise(share)
    taken = rows.where(F.pmod(F.xxhash64("crc"), F.lit(1_000_003)) < share * 1_000_003).select("lang", "text")

    def count(frames):
        import pandas as pd
        for frame in frames:
            for lang, texts in frame.groupby("lang")["text"]:
                n = np.bincount(trigrams(texts.tolist())[0], minlength=BUCKETS)
                yield pd.DataFrame({"lang": lang, "bucket": np.flatnonzero(n), "n": n[n > 0]})

    sums = map_frames(taken, count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect()
    langs = sorted({r.lang for r in sums})  # one row a language and bucket at most
    counts = np.full((len(langs), BUCKETS), smoothing)
    place = {lang: i for i, lang in enumerate(langs)}
    for r in sums:
        counts[place[r.lang], r.bucket] += r.n
    return langs, np.log(counts / counts.sum(axis=1, keepdims=True)).T.astype(np.float32)


def mixtures(texts: list[str], model: np.ndarray, steps: int = 6, penalty: float = 4.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts that hold a letter: shares of the languages (rows sum to 1), mean log likelihood of a trigram, and number of trigrams."""
    n_docs, n_langs = len(texts), model.shape[1]
    bucket, first, doc = trigrams(texts)
    like = np.add.reduceat(model[bucket], first, axis=0)
    top = like.max(axis=1)
    like -= top[:, None]
    like = np.exp(np.maximum(like, -30))  # a word's likelihood, relative to its best language
    doc_first = np.flatnonzero(np.diff(doc, prepend=-1))
    words = np.diff(np.append(doc_first, len(doc)))
    alone = np.add.reduceat(np.log(like), doc_first, axis=0)  # log likelihood by one language
    order = np.argsort(-alone, axis=1, kind="stable")
    rows = np.arange(n_docs)
    chosen = np.zeros((n_docs, n_langs), bool)
    chosen[rows, order[:, 0]] = True
    shares = chosen.astype(np.float64)
    value = alone[rows, order[:, 0]].astype(np.float64)
    active = np.ones(n_docs, bool)

    def fit(docs: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = np.flatnonzero(docs[doc])
        n = words[docs]
        starts = np.cumsum(n) - n
        own = np.repeat(np.arange(len(n)), n)
        x = like[w]
        pi = allowed / allowed.sum(axis=1, keepdims=True)
        for _ in range(steps):
            r = x * pi[own]
            total = r.sum(axis=1, keepdims=True)
            pi = np.add.reduceat(r / np.maximum(total, 1e-30), starts, axis=0) / n[:, None]
        total = (x * pi[own]).sum(axis=1)
        return pi, np.add.reduceat(np.log(np.maximum(total, 1e-30)), starts)

    for k in range(1, n_langs):
        if not active.any():
            break
        # the language that, beside those chosen, explains the words best left over
        left = like / np.maximum((like * shares[doc]).sum(axis=1, keepdims=True), 1e-9)
        gain = np.add.reduceat(np.minimum(left, 1e6), doc_first, axis=0)
        gain[chosen] = -1
        more = chosen.copy()
        more[rows, gain.argmax(axis=1)] = True
        pi, total = fit(active, more[active].astype(np.float64))
        better = total > value[active] + penalty * 0.5 * np.log(words[active] + 1) + 1e-9
        took = np.flatnonzero(active)[better]
        chosen[took], shares[took], value[took] = more[took], pi[better], total[better]
        active[:] = False
        active[took] = True
    n = np.add.reduceat(np.diff(np.append(first, len(bucket))), doc_first)
    return shares, (np.add.reduceat(top.astype(np.float64), doc_first) + value) / n, n


def fits(shares: np.ndarray, mean: np.ndarray, n: np.ndarray, model: np.ndarray) -> np.ndarray:
    """How well texts fit the languages found in them: about 1 as learned texts do, 0 as trigrams drawn at random.

    Both ends are expectations under the model.  Two standard errors of a mean
    of ``n`` trigrams are granted, so that short texts aren't judged by chance.
    """
    x = model.astype(np.float64)
    p = np.exp(x)
    own, any_, square = (p * x).sum(axis=0), x.mean(axis=0), (p * x * x).sum(axis=0)
    spread = np.sqrt(np.maximum(square - own * own, 0))
    return (mean + 2 * (shares @ spread) / np.sqrt(n) - shares @ any_) / np.maximum(shares @ (own - any_), 1e-9)


def identify(docs: DataFrame, langs: list[str], model: np.ndarray, penalty: float = 4.0) -> DataFrame:
    """``docs`` with _lang (largest share, or ``und``), _score (that share), _langs (languages found) and _fit (see ``fits``)."""
    names = np.array(langs, object)

    def run(cols):
        texts = cols["text"]
        out = {"_lang": [UNKNOWN] * len(texts), "_score": [0.0] * len(texts), "_langs": [[] for _ in texts], "_fit": [0.0] * len(texts)}
        at = [i for i, t in enumerate(texts) if t and langs and _LETTER.search(t)]
        if at:
            shares, mean, n = mixtures([texts[i] for i in at], model, penalty=penalty)
            fit = fits(shares, mean, n, model)
            best = shares.argmax(axis=1)
            for i, row, b, f in zip(at, shares, best, fit):
                out["_fit"][i] = float(f)
                out["_lang"][i], out["_score"][i] = names[b], float(min(1.0, row[b]))
                out["_langs"][i] = sorted(names[row > 0])
        return out

    return add_columns(docs, ["text"], run, "_lang string, _score double, _langs array<string>, _fit double")


@apart("doc_id", "text", "lang")
def keep_identified(docs: DataFrame, least_fit: float = LEAST_FIT) -> DataFrame:
    """The rows of ``docs`` that fit the languages found in them, be it one or several; same columns."""
    langs, model = learn(docs)
    return identify(docs, langs, model).where((F.col("_lang") != UNKNOWN) & (F.col("_fit") >= least_fit)).select(*docs.columns)


def op8_mixture_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every whole text of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    langs, model = learn(docs)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return identify(docs.select("doc_id", "text"), langs, model).select(
        "doc_id", held.alias("held_out"), F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"), F.array_join("_langs", ",").alias("languages"))
