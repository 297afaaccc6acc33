"""Byte-level BPE ids of whole texts, by the ``tokenizers`` library, each distinct pre-token encoded once."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE, _LETTER, _DIGIT, _MARK = 1, 2, 3, 4
_KIND = np.full(256, _MARK, dtype=np.uint8)
_KIND[[9, 10, 11, 12, 13]] = 0
_KIND[0x20] = _SPACE
_KIND[0x30:0x3A] = _DIGIT
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _KIND[0x80:] = _LETTER
_CONTRACTIONS = tuple(x.encode() for x in ("s", "t", "re", "ve", "m", "ll", "d"))


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself where it prints, else one from U+0100 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) if b in prints else chr(0x100 + others.index(b)) for b in range(256)}


def beyond(data: np.ndarray) -> np.ndarray:
    """Places of UTF-8 bytes of characters that are neither ASCII nor Latin letters, and of ``<|``."""
    found = (data == 0xC2) | (data >= 0xCA)
    found[:-1] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7)) | (data[:-1] == 0x3C) & (data[1:] == 0x7C)
    found[:-1] |= (data[:-1] == 0xC9) & (data[1:] > 0x8F)
    return np.flatnonzero(found)


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = texts.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def pre_tokens(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places where pre-tokens begin, in texts of ASCII and Latin letters that lie end to end.

    A pre-token is a run of letters, digits or other marks with at most one
    space before it, a contraction's ending, or white space: of a run of it the
    last character stands apart if more text follows, and joins that text if it
    is a space.
    """
    if not len(data):
        return np.empty(0, dtype=np.int64)
    kind = _KIND[data]
    black = kind >= _LETTER
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    edge = edge[:-1]
    first = edge.copy()
    before, here = kind[:-1], kind[1:]
    first[1:] |= black[1:] & (before != here) & (before != _SPACE)
    last = np.zeros(len(data), dtype=bool)
    last[:-1] = black[1:] & ~edge[1:]
    first[1:] |= ~black[1:] & (black[:-1] | last[1:])
    for at in np.flatnonzero(data == 0x27).tolist():
        if edge[at] or kind[at - 1] in (0, _LETTER, _DIGIT):
            tail = data[at + 1 : at + 3].tobytes()
            end = next((at + 1 + len(x) for x in _CONTRACTIONS if tail.startswith(x)), 0)
            if end and not edge[at + 1 : end].any():
                first[at + 1 : end] = False
                if end < len(data):
                    first[end] |= kind[end] == _LETTER
    return np.flatnonzero(first)


class BpeEncoder:
    """Texts to little-endian unsigned ids, 2 bytes each (4 if the vocabulary needs them).

    For vocabularies whose only preparation is the common byte-level pattern.
    Texts are cut into pre-tokens, whose ids do not depend on their
    surroundings, and the library encodes each distinct one; its ids are
    remembered. The memory is emptied when it holds ``cache`` entries, which
    bounds it and changes no result. Texts with characters beyond Latin, or
    with ``<|`` that may begin a special token, are encoded whole.
    """

    def __init__(self, path: str, cache: int = 200_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # Pre-tokens are handed over in the vocabulary's own letters, with the letter of a line break between them.
        # One tokenizer cuts either way in turn: a second one would hold the vocabulary once more, in every worker.
        self.plain, self.apart = self.tokenizer.pre_tokenizer, pre_tokenizers.Split("Ċ", "isolated")
        self.letters = _byte_letters()
        self.between = self.tokenizer.token_to_id("Ċ")
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.cache = cache
        self.known: dict[str, bytes] = {}

    def _direct(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str], block: int = 20_000) -> None:
        lines = [x for x in new if "\n" in x]
        self.known.update(zip(lines, self._direct(lines), strict=True))
        words = [x for x in new if "\n" not in x] if lines else new
        self.tokenizer.pre_tokenizer = self.apart
        try:
            for i in range(0, len(words), block):
                part = words[i : i + block]
                text = "\n".join(part).encode().decode("latin-1").translate(self.letters)
                ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=self.dtype)
                ends = (np.flatnonzero(ids == self.between) * ids.itemsize).tolist()
                if len(ends) != len(part) - 1:
                    raise ValueError("not a byte-level vocabulary")
                ids, size = ids.tobytes(), ids.itemsize
                self.known.update(zip(part, [ids[a:b] for a, b in zip([0, *(x + size for x in ends)], [*ends, len(ids)], strict=True)], strict=True))
        finally:
            self.tokenizer.pre_tokenizer = self.plain

    def encode(self, texts: pa.Array, end_id: int) -> list[bytes]:
        """The ids of each text (null: empty) with ``end_id`` after them."""
        end = np.array([end_id], dtype=self.dtype).tobytes()
        texts = texts.fill_null("")
        data, offsets = _bytes_of(texts)
        if not len(at := beyond(data)):
            return [x + end for x in self._latin(data, offsets)]
        whole = dict.fromkeys((np.searchsorted(offsets, at, side="right") - 1).tolist())
        whole = dict(zip(whole, self._direct(texts.take(pa.array([*whole])).to_pylist()), strict=True))
        rest = iter(self._latin(*_bytes_of(texts.take(pa.array([i for i in range(len(texts)) if i not in whole], pa.int64())))))
        return [(whole[i] if i in whole else next(rest)) + end for i in range(len(texts))]

    def _latin(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Each distinct pre-token is looked up once; the rest is gathering."""
        if len(self.known) > self.cache:
            self.known.clear()
        starts = pre_tokens(data, offsets)
        if not len(starts):
            return [b""] * (len(offsets) - 1)
        tokens = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data))
        coded = tokens.dictionary_encode()
        which, distinct = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        self._learn([x for x in distinct if x not in self.known])
        table = [self.known[x] for x in distinct]
        sizes = np.fromiter(map(len, table), np.int64, len(table)) // self.dtype.itemsize
        ids = np.frombuffer(b"".join(table), dtype=self.dtype)
        each = sizes[which]
        ends = np.cumsum(each)
        shift = (np.cumsum(sizes) - sizes)[which] - (ends - each)
        flat = ids[np.arange(ends[-1]) + np.repeat(shift, each)].tobytes()
        cuts = (np.append(0, ends)[np.searchsorted(starts, offsets)] * self.dtype.itemsize).tolist()
        return [flat[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


_ENCODERS: dict[str, BpeEncoder] = {}


def encoder(path: str) -> BpeEncoder:
    """One encoder for each worker process and vocabulary, which is read once for all tasks. A task that empties ``known`` at its end leaves no more than that."""
    if path not in _ENCODERS:
        _ENCODERS[path] = BpeEncoder(path)
    return _ENCODERS[path]


def batches(texts: pa.Array, most_bytes: int = 1_000_000) -> Iterator[tuple[int, pa.Array]]:
    """(first row, rows) of runs of texts with about so many bytes; a longer text is a run of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
        yield start, texts.slice(start, stop - start)
        start = stop
