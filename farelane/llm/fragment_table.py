"""Encoding of forced-boundary fragments through a table of known fragments kept in arrays.

Texts are cut as in ``bpe``.  The table maps the 64-bit hash of a fragment to
its ids, so known fragments are found for a whole row group at once.  A new
fragment that is one word of Latin letters, after a blank or not, is a single
pre-token whatever its letters are; it goes to the library's model directly.
Any other goes through the whole tokenizer.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

from farelane.llm import textbytes as tb
from farelane.llm.bpe import BATCH_FRAGMENTS, CACHE_BYTES, _Codec, byte_of_char, gather

#: fragments the table holds; it starts again when it is full
TABLE_FRAGMENTS = 400_000
_LETTER = tb.byte_set((0x41, 0x5A), (0x61, 0x7A))
#: second bytes of the letters U+00C0 to U+00FF, without the two signs among them
_LATIN1 = tb.byte_set((0x80, 0x96), (0x98, 0xB6), (0xB8, 0xBF))


class TableCodec(_Codec):
    """``encode`` gives the same ids as the codec it extends."""

    def __init__(self, path: str):
        # a task has one core; the library's threads would only wait for each other
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        super().__init__(path)
        self.chars = {b: c for c, b in byte_of_char().items()}
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _encode_new(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids) of the given fragments."""
        lead = np.zeros(len(raw) + 1, bool)
        lead[1:] = raw == 0xC3
        letters = _LETTER[raw] | lead[1:] | (lead[:-1] & _LATIN1[raw])
        blank = raw[starts] == 0x20
        other = tb.prefix(~letters)
        word = (other[ends] - other[starts + blank] == 0) & (ends - starts > blank)
        data = raw.tobytes()
        ids: list[list[int]] = [[]] * len(starts)
        model = self.tokenizer.model
        for i in np.flatnonzero(word).tolist():
            ids[i] = [t.id for t in model.tokenize(data[starts[i] : ends[i]].decode("latin-1").translate(self.chars))]
        rest = np.flatnonzero(~word).tolist()
        for lo in range(0, len(rest), BATCH_FRAGMENTS):
            some = rest[lo : lo + BATCH_FRAGMENTS]
            for i, e in zip(some, self.tokenizer.encode_batch_fast([data[starts[i] : ends[i]].decode("utf-8") for i in some], add_special_tokens=False), strict=True):
                ids[i] = e.ids
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((x for y in ids for x in y), np.uint32, int(size.sum())), size

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, index of each row's first id)."""
        starts, first = self.fragments(raw, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        ends = np.append(starts[1:], len(raw))
        key, one, back = np.unique(tb.span_hashes(raw, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) > TABLE_FRAGMENTS:
            self._clear()
        slot = np.searchsorted(self.keys, key)
        known = np.zeros(len(key), bool)
        inside = slot < len(self.keys)
        known[inside] = self.keys[slot[inside]] == key[inside]
        new = np.flatnonzero(~known)
        at, size = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
        at[known], size[known] = self.at[slot[known]], self.size[slot[known]]
        flat = self.flat
        if len(new):
            ids, n = self._encode_new(raw, starts[one[new]], ends[one[new]])
            at[new], size[new] = len(flat) + tb.prefix(n)[:-1], n
            flat = np.concatenate([flat, ids])
            self._keep(key, at, size, flat, new[ends[one[new]] - starts[one[new]] <= CACHE_BYTES])
        return gather(flat, at[back], size[back]), tb.prefix(size[back])[first]

    def _keep(self, key: np.ndarray, at: np.ndarray, size: np.ndarray, flat: np.ndarray, new: np.ndarray) -> None:
        where = np.searchsorted(self.keys, key[new])
        self.keys = np.insert(self.keys, where, key[new])
        self.at = np.insert(self.at, where, len(self.flat) + tb.prefix(size[new])[:-1])
        self.size = np.insert(self.size, where, size[new])
        self.flat = np.concatenate([self.flat, gather(flat, at[new], size[new])])


@lru_cache(maxsize=1)
def table_codec(path: str) -> TableCodec:
    return TableCodec(path)
