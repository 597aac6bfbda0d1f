"""Token counts: against the library, and what the cache saves."""

import public_tokenizers
import pytest

from quizmill.llm import token_counts
from quizmill.llm.token_counts import CACHE_SCHEMA, count_tokens, tokenizer_digest

JSON = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", None, "One two, three.", "  blanks  around\n\tand lines ", "<|endoftext|> in a text", "Zwölf Boxkämpfer 🙂", "a " * 5000, "One two, three."]


def wanted(path, text):
    if path.endswith(".model"):
        import sentencepiece
        return len(sentencepiece.SentencePieceProcessor(model_file=path).encode(text or ""))
    from tokenizers import Tokenizer
    return len(Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids)


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "x", 5) for i, t in enumerate(texts)], "doc_id long, text string, digest string, n_tokens long")


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_are_those_of_the_library(spark, tmp_path, name):
    path = public_tokenizers.path(name)
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in count_tokens(docs_of(spark, TEXTS), path, str(tmp_path / "c")).collect()}
    assert got == {i: (len((t or "").encode()), wanted(path, t)) for i, t in enumerate(TEXTS)}


def test_only_misses_are_encoded_and_appended(spark, tmp_path):
    """The second run adds rows for its new text only; a stored count is taken as it stands, even a wrong one."""
    cache = str(tmp_path / "c")
    count_tokens(docs_of(spark, ["first", "second", "first"]), JSON, cache).collect()
    rows = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    assert rows.count() == 2
    marked = rows.selectExpr("digest", "n_tokens + 1000 AS n_tokens", "tokenizer").collect()
    other = str(tmp_path / "d")
    spark.createDataFrame(marked, CACHE_SCHEMA).write.partitionBy("tokenizer").parquet(other)
    got = {r.doc_id: r.n_tokens for r in count_tokens(docs_of(spark, ["second", "third", None]), JSON, other).collect()}
    assert got == {0: wanted(JSON, "second") + 1000, 1: wanted(JSON, "third"), 2: 0}
    assert spark.read.schema(CACHE_SCHEMA).parquet(other).count() == 4


def test_rows_appended_twice_are_one(spark, tmp_path):
    cache = str(tmp_path / "c")
    count_tokens(docs_of(spark, ["again"]), JSON, cache).collect()
    kept = spark.createDataFrame(spark.read.schema(CACHE_SCHEMA).parquet(cache).collect(), CACHE_SCHEMA)
    kept.write.mode("append").partitionBy("tokenizer").parquet(cache)
    assert [r.n_tokens for r in count_tokens(docs_of(spark, ["again", "again"]), JSON, cache).collect()] == [1, 1]


def test_another_tokenizer_or_version_never_meets_older_counts(spark, tmp_path, monkeypatch):
    cache, other = str(tmp_path / "c"), public_tokenizers.path("word_bpe_49k.json")
    text = "Unbelievable   spacing"
    count_tokens(docs_of(spark, [text]), JSON, cache).collect()
    assert [r.n_tokens for r in count_tokens(docs_of(spark, [text]), other, cache).collect()] == [wanted(other, text)]
    before = tokenizer_digest(JSON)
    monkeypatch.setattr(token_counts, "version", lambda library: "0.0")
    assert tokenizer_digest(JSON) != before


def test_empty_table(spark, tmp_path):
    assert count_tokens(docs_of(spark, ["x"]).where("doc_id < 0"), JSON, str(tmp_path / "c")).collect() == []
