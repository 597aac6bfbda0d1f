"""Token files: the encoder against the libraries, the word coding, and the files' round trip."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from quizmill.llm.encoding import Encoder, read_tokenizer
from quizmill.llm.token_files import END_ID, decode_block, encode_block, read_part, read_token_files, write_token_files

HOSTILE = ["a", "b", "é", "中", " ", "  ", "\n", "\t", ",", ".", "1", "'s", "'ll", " ", "　", "\x1c", " ", "<|endoftext|>", "🙂",
           "word", "The", " the", "\r\n", "!", "​", "_", "Ⅷ", "ª", "é"]


def hostile_texts(n, seed=1):
    draw = random.Random(seed)
    return ["", " ", "  a", "a  ", "a b", "a, b.", "word, word."] + [
        "".join(draw.choice(HOSTILE) for _ in range(draw.randint(0, 25))) for _ in range(n)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_encoder_gives_what_the_library_gives(name):
    path, texts = public_tokenizers.path(name), hostile_texts(3000)
    counts, ids = Encoder(*read_tokenizer(path)).ids_of(texts)
    if name.endswith(".model"):
        import sentencepiece
        wanted = sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)
    else:
        from tokenizers import Tokenizer
        wanted = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == [len(w) for w in wanted]
    assert ids.tolist() == [i for w in wanted for i in w]


def test_unknown_kind_of_file():
    with pytest.raises(ValueError, match="no library"):
        read_tokenizer("/nowhere/vocabulary.txt")


def test_block_coding_round_trip():
    draw = np.random.default_rng(3)
    for width in (1, 3, 15, 30, 59, 60, 63):
        ids = draw.integers(0, 1 << width, 777, dtype=np.uint64)
        assert (decode_block(encode_block(ids)) == ids).all()
    assert len(decode_block(encode_block(np.empty(0, np.uint64)))) == 0


def brute(rows, encode):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*encode(text or ""), END_ID]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("part_bytes", [400, 1 << 20])
def test_files_give_back_what_was_encoded(spark, tmp_path, part_bytes):
    """Nulls, empty and repeated rows, an extra column, several files."""
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(i, t) for i, t in enumerate(hostile_texts(150))] + [(None, "no id"), (1000, None), (1001, "twice"), (1001, "twice")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, part string")
    parts = write_token_files(docs, str(tmp_path / "t"), public_tokenizers.path("byte_bpe_50k.json"), part_bytes=part_bytes)
    got = [tuple(r) for r in read_token_files(str(tmp_path / "t"), parts).collect()]
    wanted = brute(rows, lambda t: tokenizer.encode(t, add_special_tokens=False).ids)
    assert sorted(got, key=lambda r: r[1]) == wanted


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    parts = write_token_files(docs, str(tmp_path / "t"), public_tokenizers.path("byte_bpe_50k.json"))
    assert read_token_files(str(tmp_path / "t"), parts).collect() == []


def test_a_part_written_twice_is_the_same_file(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string")
    path, tokenizer = str(tmp_path / "t"), public_tokenizers.path("byte_bpe_50k.json")
    first = write_token_files(docs, path, tokenizer).collect()
    before = (tmp_path / "t" / "part-000000.s8b").read_bytes()
    assert write_token_files(docs, path, tokenizer).collect() == first
    assert (tmp_path / "t" / "part-000000.s8b").read_bytes() == before
    assert [d for ids, _, _ in read_part(f"{path}/part-000000.s8b") for d in ids] == list(range(50))
