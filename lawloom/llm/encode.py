"""Whole-text encoding with the tokenizers library and a bounded cache of words.

Both vocabularies split a text before every single space that stands between
two other characters, whatever surrounds it, so the pieces between such spaces
can be encoded one by one; texts with other white space around a space are cut
with a regular expression at the safe places only. A worker keeps the ids of
the pieces it has met, a bounded number of them (about 200 bytes each).
"""

from __future__ import annotations

import array
import itertools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE_ENTRIES = 400_000
LONG_PIECE = 64
JOINED = 256
#: The sign that stands for a space in vocabularies of bytes (a fixed value of that format).
SPACE_MARK = "\u0120"
#: A sign without case or decomposition, so no other text turns into it, and its entry with the word end (a fixed value of that format).
MARK = "\u20ac"
MARK_ENTRY = "\u00e2\u0124\u00ac</w>"
SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")


class CachedEncoder:
    """Ids of whole texts as little-endian bytes of ``width`` bytes an id."""

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.spaces_count = '"Split"' not in self.tokenizer.to_str()[:4000]
        self.width = 2 if self.tokenizer.get_vocab_size() < 65536 else 4
        self.code = "H" if self.width == 2 else "I"
        self.entries = entries
        self.cache: dict[str, bytes] = {}
        vocab = self.tokenizer.get_vocab()
        self.mark = None if self.spaces_count else vocab.get(MARK_ENTRY)
        self.opens = np.zeros(max(vocab.values(), default=0) + 1, bool)
        for token, i in vocab.items():
            self.opens[i] = token.startswith(SPACE_MARK)

    def _raw(self, texts: list[str]) -> list[bytes]:
        return [array.array(self.code, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _spaced(self, words: list[str]) -> list[bytes]:
        """Ids of each word after one space, for words without a space. JOINED words are encoded at once and cut where an id opens with the space."""
        out: list[bytes] = []
        for at in range(0, len(words), JOINED):
            part = words[at : at + JOINED]
            raw = self._raw([" " + " ".join(part)])[0]
            cut = (np.flatnonzero(self.opens[np.frombuffer(raw, self.code)]) * self.width).tolist()
            if len(cut) == len(part):
                out += [raw[i:j] for i, j in zip(cut, [*cut[1:], len(raw)], strict=True)]
            else:
                out += self._raw([" " + w for w in part])
        return out

    def _slow(self, text: str) -> bytes:
        parts = SAFE_CUT.split(text)
        if self.spaces_count:
            parts = [parts[0], *(" " + p for p in parts[1:])]
        return b"".join(self._raw(parts))

    def _after_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word of a vocabulary that drops white space. JOINED words are encoded at once, with MARK between them, and cut at its id."""
        marked = [w for w in words if MARK in w] if self.mark is not None else words
        own = dict(zip(marked, self._raw(marked), strict=True)) if marked else {}
        plain = [w for w in words if w not in own] if own else words
        out: list[bytes] = []
        for at in range(0, len(plain) if self.mark is not None else 0, JOINED):
            part = plain[at : at + JOINED]
            raw = self._raw([f" {MARK} ".join(part)])[0]
            cut = (np.flatnonzero(np.frombuffer(raw, self.code) == self.mark) * self.width).tolist()
            if len(cut) == len(part) - 1:
                out += [raw[i:j] for i, j in zip([0, *(c + self.width for c in cut)], [*cut, len(raw)], strict=True)]
            else:
                out += self._raw(part)
        if not own:
            return out
        own.update(zip(plain, out, strict=True))
        return [own[w] for w in words]

    def encode(self, texts: list[str] | pa.Array) -> list[bytes | memoryview]:
        """Ids of each text. The texts are cut, their words numbered and the ids put together in Arrow; Python sees each different word once."""
        texts = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).cast(pa.large_string())
        if not len(texts):
            return []
        pieces = pc.split_pattern(texts, " ")
        begin = pieces.offsets.to_numpy().astype(np.int64)
        coded = pieces.values.slice(begin[0], begin[-1] - begin[0]).dictionary_encode()
        begin -= begin[0]
        words, codes = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy().astype(np.int64)
        found = list(map(self.cache.get, words))
        good = [i for i, x in enumerate(found) if x is None and (w := words[i]) and not w[0].isspace() and not w[-1].isspace()]
        new = [words[i] for i in good]
        got = self._spaced(new) if self.spaces_count else self._after_words(new)
        for i, x in zip(good, got, strict=True):
            found[i] = x
        if len(self.cache) + len(new) > self.entries:
            self.cache = {}
        self.cache.update((w, x) for w, x in zip(new, got, strict=True) if len(w) <= LONG_PIECE)
        if self.spaces_count:  # the first piece has no space before it
            first, alone = [words[i] for i in codes[begin[:-1]].tolist()], (np.diff(begin) == 1).tolist()
            codes[begin[:-1]] = len(words) + np.arange(len(first))
            for w, x, one in zip(first, self._raw(first), alone, strict=True):
                found.append(x if w and not w[-1].isspace() or one and not w else None)
        whole = np.array([x is not None for x in found])[codes]
        bad = np.concatenate([[0], np.cumsum(~whole)])
        slow = bad[begin[1:]] > bad[begin[:-1]]
        ids = pa.array([x or b"" for x in found], pa.large_binary()).take(pa.array(codes))
        at, data = np.frombuffer(ids.buffers()[1], np.int64)[begin].tolist(), memoryview(ids.buffers()[2] or b"").cast("B")
        out: list[bytes | memoryview] = [data[i:j] for i, j in itertools.pairwise(at)]
        for i in np.flatnonzero(slow).tolist():
            out[i] = self._slow(texts[i].as_py())
        return out


_known: dict[str, CachedEncoder] = {}


def encoder(path: str, entries: int = CACHE_ENTRIES) -> CachedEncoder:
    """The worker's own encoder for ``path``, with a cache of at most ``entries`` pieces; kept from task to task."""
    if path not in _known:
        _known[path] = CachedEncoder(path)
    _known[path].entries = entries
    return _known[path]


def forget_words(path: str) -> None:
    """Drops the pieces that the worker's encoder for ``path`` has met; the encoder stays."""
    if path in _known:
        _known[path].cache = {}


def text_blocks(batch: pa.RecordBatch, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most`` bytes of text, or of one row, with empty texts for null ones."""
    text = pc.fill_null(batch.column("text"), "")
    batch = batch.set_column(batch.schema.get_field_index("text"), "text", text)
    block = np.cumsum(pc.binary_length(text).to_numpy().astype(np.int64)) // most
    edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
    for i, j in itertools.pairwise(edges):
        if i < j:
            yield batch.slice(i, j - i)


def encoded_rows(batch: pa.RecordBatch, path: str, end_id: int | None, entries: int = CACHE_ENTRIES) -> Iterator[tuple[object, np.ndarray]]:
    """(doc_id, ids as uint32) of each row; null text counts as empty."""
    enc = encoder(path, entries)
    kind = np.dtype("<u2" if enc.width == 2 else "<u4")
    for part in text_blocks(batch):
        for doc, raw in zip(part.column("doc_id").to_pylist(), enc.encode(part.column("text")), strict=True):
            got = np.frombuffer(raw, kind).astype("<u4")
            yield doc, got if end_id is None else np.append(got, np.uint32(end_id))
