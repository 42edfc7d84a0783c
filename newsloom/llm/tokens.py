"""Token ids of whole texts by the tokenizers library, with a memo of words.

`word_bpe` vocabularies drop white space, split at every change between letters,
single digits and other signs, lower-case, and end each such piece with a marked
token: the ids of a text are the ids of its pieces in a row. Pieces are found and
hashed (64 bits) in whole buffers with numpy; the tokenizer sees each distinct
piece once, and a gather puts the ids together. With its hash a piece has its length
and first bytes compared at every use; where they differ, the buffer's texts are
encoded one by one. Blank-separated chunks with
anything but ASCII and Latin-1 letters, digits and plain signs are pieces as a
whole, so the library's own rules hold for them.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa

from .common import ROLL, hash_spans, slices, text_buffers

END_ID = 2
SPACE, LETTER, DIGIT, SIGN, ODD = range(5)
_CLASS = np.full(256, ODD, np.uint8)
_CLASS[[32, 9, 10]] = SPACE
_CLASS[65:91] = _CLASS[97:123] = LETTER
_CLASS[48:58] = DIGIT
_CLASS[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "'<"]] = SIGN


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def marks_of(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The first eight bytes of each span, mixed with its length."""
    padded = np.append(raw, np.zeros(8, np.uint8))
    eight = np.ndarray(len(raw), "<u8", padded, strides=(1,))[begin]  # at any byte
    size = end - begin
    cut = (8 * np.maximum(0, 8 - size)).astype(np.uint64)
    return ((eight << cut) >> cut) * ROLL ^ size.astype(np.uint64)


class Encoder:
    def __init__(self, path: str, most_pieces: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.dtype = np.dtype("<u2") if max(vocab.values(), default=0) < 1 << 16 else np.dtype("<u4")
        self.ends = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.ends[[i for k, i in vocab.items() if k.endswith("</w>")]] = True
        self.most_pieces = most_pieces
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # ascending, with the place of each piece's ids in the pool
        self.at, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.mark = np.zeros(0, np.uint64)
        self.pool = np.zeros(0, self.dtype)

    def _ids(self, pieces: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of distinct pieces and how many each has: encoded as lines, cut after the tokens that end a piece."""
        out, sizes = [], []
        lines = [pieces[i : i + 128] for i in range(0, len(pieces), 128)]
        for line, e in zip(lines, self.tokenizer.encode_batch_fast([" ".join(x) for x in lines], add_special_tokens=False)):
            ids = np.array(e.ids, dtype=self.dtype)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(line):
                out.append(ids)
                sizes.append(np.diff(cuts, prepend=0))
            else:
                whole = self._whole(line)
                out += whole
                sizes.append(np.array([len(x) for x in whole], np.int64))
        return out, sizes

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, hashes: np.ndarray, marks: np.ndarray, plain: list[str], odd: list[str]) -> None:
        ids, sizes = self._ids(plain)
        whole = self._whole(odd)
        ids, sizes = ids + whole, np.concatenate([*sizes, np.array([len(x) for x in whole], np.int64)])
        at = len(self.pool) + np.cumsum(sizes) - sizes
        self.pool = np.concatenate([self.pool, *ids])
        order = np.argsort(hashes)
        where = np.searchsorted(self.hashes, hashes[order])
        self.hashes = np.insert(self.hashes, where, hashes[order])
        self.at, self.size = np.insert(self.at, where, at[order]), np.insert(self.size, where, sizes[order])
        self.mark = np.insert(self.mark, where, marks[order])

    def buffer(self, raw: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of each text of a buffer."""
        n = len(raw)
        if not n:
            return [np.zeros(0, self.dtype)] * (len(offsets) - 1)
        kind = _CLASS[raw]
        low = raw.copy()
        low[(raw >= 65) & (raw <= 90)] += 32
        lead = np.flatnonzero(raw[:-1] == 0xC3)
        second = raw[lead + 1]
        good = lead[(second >= 0x80) & (second <= 0xBF) & (second != 0x97) & (second != 0xB7)]
        kind[good] = kind[good + 1] = LETTER
        upper = good[raw[good + 1] <= 0x9E]
        low[upper + 1] += 32
        inner = offsets[(offsets > 0) & (offsets < n)]
        solid = kind != SPACE
        chunk = solid.copy()
        chunk[1:] &= ~solid[:-1]
        chunk[inner] = solid[inner]
        starts = np.flatnonzero(chunk)
        no = np.cumsum(chunk) - 1  # chunk of each solid byte
        odd_chunk = np.zeros(len(starts) + 1, bool)
        odd_chunk[no[kind == ODD]] = True
        odd = odd_chunk[no] & solid
        begin = chunk | (solid & ~odd & (kind == DIGIT))
        begin[1:] |= solid[1:] & solid[:-1] & ~odd[1:] & (kind[1:] != kind[:-1])
        low = np.where(odd, raw, low)
        after = np.append(begin[1:] | ~solid[1:], True)
        first, last = np.flatnonzero(begin), np.flatnonzero(solid & after) + 1
        hashes = hash_spans(low, first, last) ^ odd[first].astype(np.uint64)
        marks = marks_of(low, first, last)
        distinct, where, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.hashes) > self.most_pieces:
            self._forget()
        at = np.minimum(np.searchsorted(self.hashes, distinct), max(0, len(self.hashes) - 1))
        new = self.hashes[at] != distinct if len(self.hashes) else np.ones(len(distinct), bool)
        if new.any():
            w = where[new]
            is_odd = odd[first[w]]
            text = low.tobytes()
            names = [text[a:b].decode() for a, b in zip(first[w].tolist(), last[w].tolist())]
            h = distinct[new]
            m = marks[w]
            self._learn(np.r_[h[~is_odd], h[is_odd]], np.r_[m[~is_odd], m[is_odd]], [x for x, o in zip(names, is_odd) if not o], [x for x, o in zip(names, is_odd) if o])
            at = np.searchsorted(self.hashes, distinct)
        if (self.mark[at][back] != marks).any():  # two pieces with one hash
            whole = raw.tobytes()
            return self._whole([whole[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())])
        size = self.size[at][back]
        upto = np.concatenate(([0], np.cumsum(size)))
        ids = self.pool[np.repeat(self.at[at][back] - upto[:-1], size) + np.arange(upto[-1])]
        return np.split(ids, upto[np.searchsorted(first, offsets[1:-1])]) if len(offsets) > 2 else [ids]

    def column(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text of an Arrow column; null: none."""
        out: list[np.ndarray] = []
        for part in slices(pa.RecordBatch.from_arrays([texts], names=["text"]), "text"):
            out += self.buffer(*text_buffers(part.column(0)))
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        return [x.tobytes() for x in self.column(pa.array(texts, pa.string()))]


_kept: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    if path not in _kept:
        _kept[path] = Encoder(path)
    return _kept[path]


def with_end(ids: np.ndarray, end: int = END_ID) -> np.ndarray:
    return np.append(ids, np.array(end, ids.dtype))


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4", copy=False).tobytes())
