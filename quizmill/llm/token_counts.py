"""Token counts through a digest cache: only texts never counted before are encoded.

The cache is a Parquet folder with a row for each (content digest, tokenizer
digest), in a directory per tokenizer digest.  A count is looked up by

    content digest    sha256 of the normalised text
    tokenizer digest  sha256 over library, its version, and the tokenizer file

so another vocabulary or library version never meets older counts.  A run joins
the digests of its texts to the stored counts, encodes each text it misses once,
and appends the new counts.  Copies of a text have one digest, so a group of
copies of any size costs one encoding and, on its way, one row a task.

Rows appended twice (two runs at the same time, or a job that ran again) hold the
same count and are read as one.

Normalising must not change a count: a null text becomes an empty one, which has
no tokens.  Ties and repeated rows: each row of the input gives one row.  Very
long texts are encoded whole.  An empty table gives no rows.  Other columns of
the input, whatever their names, are left out of the result.
"""

from __future__ import annotations

import hashlib
from importlib.metadata import version

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import existing
from .common import add_columns, staged, table, work_dir
from .encoding import encoder, read_tokenizer

CACHE_SCHEMA = "digest binary, n_tokens long, tokenizer string"
#: Setting that names a cache kept between runs; without it a run has its own in the shared folder.
CACHE_CONF = "spark.quizmill.tokenCache"


def tokenizer_digest(path: str) -> str:
    """Digest of everything that decides the ids: library, its version, file."""
    kind, content = read_tokenizer(path)
    library = {".json": "tokenizers", ".model": "sentencepiece"}[kind]
    return hashlib.sha256(f"{library} {version(library)}\n".encode() + content).hexdigest()


def cached_counts(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """(digest, n_tokens) of a tokenizer, each digest once; a cache that isn't there holds nothing."""
    return (existing(spark, cache, CACHE_SCHEMA).where(F.col("tokenizer") == tokenizer)
            .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))


def count_tokens(docs: DataFrame, tokenizer_path: str, cache: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of every row of ``docs``; new counts are in ``cache`` afterwards.

    Digests travel alone.  A text travels only if its digest misses: copies meet
    inside their task first, then one text of each digest is sent to be encoded.
    """
    spark = docs.sparkSession
    tokenizer = tokenizer_digest(tokenizer_path)
    kind, content = read_tokenizer(tokenizer_path)
    text = F.coalesce(F.col(text_column), F.lit(""))
    digest = F.unhex(F.sha2(text, 256))
    keys = staged(docs.select(F.col(id_column).alias("id"), digest.alias("digest"), F.octet_length(text).cast("long").alias("n_bytes")),
                  "count-keys")
    known = cached_counts(spark, cache, tokenizer)
    missing = staged(keys.select("digest").distinct().join(known, "digest", "left_anti"), "count-misses")
    # the join stands above the aggregate: Spark moves it below where the misses are few enough to be broadcast
    texts = (docs.select(digest.alias("digest"), text.alias("text")).groupBy("digest").agg(F.first("text").alias("text"))
             .join(missing, "digest", "left_semi"))

    def count(columns: dict) -> dict:
        counts, _ = encoder(kind, content).ids_of(columns["text"])
        return {"n_tokens": counts.tolist()}

    counted = add_columns(texts, ["text"], count, "n_tokens long")
    (counted.select("digest", "n_tokens", F.lit(tokenizer).alias("tokenizer"))
     .write.mode("append").partitionBy("tokenizer").parquet(cache))
    # staged, so that the rows of a text with very many copies can be dealt out in the join
    counts = staged(cached_counts(spark, cache, tokenizer).join(keys.select("digest").distinct(), "digest", "left_semi"), "count-found")
    return keys.join(counts, "digest").select(F.col("id").alias(id_column), "n_bytes", "n_tokens")


def op11_digest_token_counts(spark: SparkSession, sf_dir: str, most_tokens: int = 512) -> DataFrame:
    """Token counts of all documents with ``byte_bpe_50k.json``; the cache is the one the session names, else a new one."""
    import public_tokenizers
    cache = spark.conf.get(CACHE_CONF, None) or work_dir(spark, "token-cache")
    counts = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), cache)
    return counts.withColumn("over_limit", F.col("n_tokens") > most_tokens)
