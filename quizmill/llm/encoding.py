"""Token ids of whole texts as the public libraries give them, in batches.

``ids_of`` gives the ids of many texts as one array plus a count for each text.
Files ending in ``.json`` go to tokenizers, ``.model`` to sentencepiece; nothing
is added, truncated or padded, and special strings inside a text are handled as
the library does by default.

For byte-level pre-tokenization without a normaliser the texts are cut first.
It always cuts before a blank that stands between two characters that aren't
white space, and between a letter and the comma or stop that ends such a piece.
So each different piece of a batch is encoded once and the ids are put together
by position.  Texts of other tokenizers go to the library whole.

Nulls must be replaced before.  An empty text has no ids.  A stretch without any
such blank, however long, is one piece.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CLEAN_BLANK = re.compile(r"(?<=\S) (?=\S)")
JOINED = 2000
#: Different pieces whose ids a task keeps; beyond that it starts anew.
KEPT = 1_000_000


def read_tokenizer(path: str) -> tuple[str, bytes]:
    """(kind, content) of a tokenizer file, to be sent to tasks: a few megabytes at most."""
    kind = os.path.splitext(path)[1]
    if kind not in (".json", ".model"):
        raise ValueError(f"no library for {path!r}: a .json or .model file is needed")
    with open(path, "rb") as f:
        return kind, f.read()


def spread(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs ``values[start: start + size]`` one after another."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(values)) < 1 << 31 else np.int64
    at = np.repeat((starts - (ends - sizes)).astype(kind), sizes)
    at += np.arange(total, dtype=kind)
    return values[at]


class Encoder:
    """One tokenizer inside a task."""

    def __init__(self, kind: str, content: bytes):
        self.byte_level = False
        if kind == ".model":
            from sentencepiece import SentencePieceProcessor
            model = SentencePieceProcessor(model_proto=content)
            self._library = lambda texts: model.encode(texts, num_threads=1)
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_str(content.decode())
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self._library = lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        told = json.loads(content)
        before = told.get("pre_tokenizer") or {}
        self.byte_level = (before.get("type") == "ByteLevel" and before.get("use_regex", True)
                           and not before.get("add_prefix_space") and not told.get("normalizer")
                           and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in told.get("added_tokens", [])))
        if self.byte_level:
            added = tokenizer.get_added_tokens_decoder()
            self._kept = pa.array([], pa.large_string()), np.empty(0, np.int64), np.empty(0, np.uint32)
            self._bytes = np.zeros(tokenizer.get_vocab_size(), np.int64)
            for token, i in tokenizer.get_vocab().items():  # one character of the vocabulary is one byte
                self._bytes[i] = len(token.encode()) if i in added else len(token)

    def whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(count of each text, ids of all) from the library, text by text."""
        lists = self._library(texts)
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        return counts, np.concatenate([np.asarray(x, np.uint32) for x in lists]) if lists else np.empty(0, np.uint32)

    def _pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for pieces that follow a blank: many are encoded as one text, whose ids are cut at known bytes."""
        counts, ids = [np.empty(0, np.int64)], [np.empty(0, np.uint32)]
        for k in range(0, len(pieces), JOINED):
            some = pieces[k: k + JOINED]
            _, got = self.whole([" " + " ".join(some.to_pylist())])
            ends = np.searchsorted(np.cumsum(self._bytes[got]), np.cumsum(pc.binary_length(some).to_numpy() + 1)) + 1
            counts.append(np.diff(ends, prepend=0))
            ids.append(got)
        return np.concatenate(counts), np.concatenate(ids)

    def _units(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(where in the kept pieces each of ``pieces`` is, their counts, their ids); only new ones are encoded."""
        known, counts, ids = self._kept
        if len(known) > KEPT:
            known, counts, ids = known[:0], counts[:0], ids[:0]
        found = pc.index_in(pieces, known)
        new = pieces.filter(found.is_null())
        more = self._pieces(new)
        self._kept = pa.concat_arrays([known, new]), np.concatenate([counts, more[0]]), np.concatenate([ids, more[1]])
        at = found.fill_null(-1).to_numpy().copy()
        at[at < 0] = len(known) + np.arange(len(new))
        return at, *self._kept[1:]

    def ids_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(count of each text, ids of all texts in order)."""
        if not self.byte_level or not texts:
            return self.whole(texts)
        lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        words = lists.flatten().dictionary_encode()
        unclean = pc.or_(pc.equal(words.dictionary, ""), pc.not_equal(pc.utf8_trim_whitespace(words.dictionary), words.dictionary)).to_numpy(False)
        starts = lists.offsets.to_numpy()
        beyond_blank = np.diff(starts) > 1
        odd = np.logical_or.reduceat(unclean[words.indices.to_numpy()], starts[:-1]) & beyond_blank
        order = None
        if odd.any():  # blanks beside other white space: cut these texts at the clean blanks only
            at = np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)])
            again = pa.array([CLEAN_BLANK.split(texts[i]) for i in np.flatnonzero(odd)], lists.type)
            lists = pa.concat_arrays([lists.filter(pa.array(~odd)), again])
            words, starts, order = lists.flatten().dictionary_encode(), lists.offsets.to_numpy(), np.argsort(at)
        counts, ids = self._assemble(lists.flatten(), words, starts)
        if order is not None:
            first = np.cumsum(counts) - counts
            counts, ids = counts[order], spread(ids, first[order], counts[order])
        return counts, ids

    def _assemble(self, flat: pa.Array, words: pa.Array, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = starts[:-1]
        follows = np.ones(len(flat), bool)
        follows[first] = False
        indices = words.indices.to_numpy()
        behind = np.zeros(len(words.dictionary), bool)
        behind[indices[follows]] = True
        needed = np.flatnonzero(behind)  # pieces behind a blank; a text's first piece is encoded as it stands
        pieces = words.dictionary.take(pa.array(needed))
        marked = pc.match_substring_regex(pieces, r"\p{L}[,.]$")
        mark = np.where(marked.to_numpy(False), pc.ends_with(pieces, ".").to_numpy(False).astype(np.int64), -1)
        stems = pc.if_else(marked, pc.utf8_slice_codeunits(pieces, 0, -1), pieces).dictionary_encode()
        unit_of, units, unit_ids = self._units(stems.dictionary)
        n_stems = len(units)
        more, more_ids = self.whole([",", ".", *flat.take(pa.array(first)).to_pylist()])
        sizes, values = np.concatenate([units, more]), np.concatenate([unit_ids, more_ids])
        begin = np.cumsum(sizes) - sizes
        # pieces as stem and mark, then texts as pieces
        stem = unit_of[stems.indices.to_numpy()].astype(np.int64)
        parts = np.stack([stem, n_stems + np.maximum(mark, 0)], 1).ravel()
        part_sizes = sizes[parts]
        part_sizes[1::2][mark < 0] = 0
        values = np.concatenate([spread(values, begin[parts], part_sizes), more_ids[int(more[:2].sum()):]])
        sizes = np.concatenate([part_sizes[::2] + part_sizes[1::2], more[2:]])
        begin = np.cumsum(sizes) - sizes
        place = np.zeros(len(words.dictionary), np.int64)
        place[needed] = np.arange(len(needed))
        unit = place[indices]
        unit[first] = len(needed) + np.arange(len(first))
        took = sizes[unit]
        return np.add.reduceat(took, first), spread(values, begin[unit], took)


_ENCODERS: dict[int, tuple[bytes, Encoder]] = {}


def encoder(kind: str, content: bytes) -> Encoder:
    """The worker's encoder for this tokenizer, built once."""
    key = hash((kind, content))
    if key not in _ENCODERS or _ENCODERS[key][0] != content:
        _ENCODERS.clear()
        _ENCODERS[key] = content, Encoder(kind, content)
    return _ENCODERS[key][1]
