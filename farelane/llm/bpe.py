"""Operator 7 - byte-pair encoding and decoding with forced boundaries.

A pair of neighbouring bytes that occurs inside no token of the vocabulary
can never be merged, so it marks a certain cut.  Texts are split at such cuts
(vectorised, on the raw bytes), each different fragment is encoded once, and
the ids of a text are the concatenation of the ids of its fragments.

A cut must also leave the pre-tokenisation of both sides unchanged.  The
pre-tokenizer of byte-level vocabularies ends a token before white space, lets
white space look one character ahead, and treats an apostrophe at the start of
a token specially.  Cuts are therefore only made before ASCII white space, or
between a visible ASCII byte and the first byte of a visible character other
than an apostrophe.  Special tokens are entries of the vocabulary, so no cut
falls inside them.

Defined results: a null text counts as empty and has no ids; rows keep their
order and number; an input column with the name of a new one is replaced.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from farelane.llm import textbytes as tb
from farelane.llm.frames import add_columns

#: fragments whose ids a task keeps; the cache starts again when it is full
CACHE_FRAGMENTS = 150_000
#: fragments handed to the tokenizer at once
BATCH_FRAGMENTS = 8192
#: longer fragments are encoded anew each time
CACHE_BYTES = 64


def byte_of_char() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def token_bytes(path: str) -> list[bytes]:
    """The bytes of every id of a byte-level vocabulary file, special tokens included."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    chars = byte_of_char()
    vocab = spec["model"]["vocab"]
    out = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]))
    for token, i in vocab.items():
        out[i] = bytes(chars[c] for c in token)
    for t in spec["added_tokens"]:
        out[t["id"]] = t["content"].encode()
    return out


def forced_cuts(tokens: list[bytes]) -> np.ndarray:
    """[left, right] -> True where a cut is certain and leaves pre-tokenisation as it is."""
    inside = np.zeros((256, 256), bool)
    for t in tokens:
        a = np.frombuffer(t, np.uint8)
        inside[a[:-1], a[1:]] = True
    visible = tb.byte_set((0x21, 0x7E))
    starts = visible.copy()
    starts[0xC2:0xF5] = True  # first bytes of longer characters; Unicode white space there is as good as any
    starts[0x27] = False
    safe = visible[:, None] & starts[None, :]
    safe[:, tb.SPACE] = True
    return safe & ~inside


class _Codec:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.cuts = forced_cuts(token_bytes(path))
        self.known: dict[bytes, bytes] = {}

    def fragments(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the fragments and the fragment index where each row begins."""
        cut = np.zeros(len(raw) + 1, bool)
        cut[1:-1] = self.cuts[raw[:-1], raw[1:]]
        cut[offsets[:-1]] = True
        starts = np.flatnonzero(cut[:-1])
        return starts, np.searchsorted(starts, offsets)

    def encode_all(self, fragments: list[bytes]) -> list[bytes]:
        """The ids of each fragment, as little-endian unsigned 32-bit integers."""
        out: list[bytes | None] = [self.known.get(f) for f in fragments]
        new = [i for i, ids in enumerate(out) if ids is None]
        if len(self.known) + len(new) > CACHE_FRAGMENTS:
            self.known.clear()
        for lo in range(0, len(new), BATCH_FRAGMENTS):
            some = new[lo : lo + BATCH_FRAGMENTS]
            texts = [fragments[i].decode("utf-8") for i in some]
            for i, e in zip(some, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                out[i] = np.array(e.ids, "<u4").tobytes()
                if len(fragments[i]) <= CACHE_BYTES and len(self.known) < CACHE_FRAGMENTS:
                    self.known[fragments[i]] = out[i]
        return out

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, index of each row's first id)."""
        starts, first = self.fragments(raw, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        ends = np.append(starts[1:], len(raw))
        key = tb.span_hashes(raw, starts, ends)
        _, one, back = np.unique(key, return_index=True, return_inverse=True)
        data = raw.tobytes()
        ids = self.encode_all([data[starts[i] : ends[i]] for i in one])
        size = np.array([len(x) for x in ids], np.int64) // 4
        at = tb.prefix(size)
        flat = np.frombuffer(b"".join(ids), "<u4")
        return gather(flat, at[back], size[back]), tb.prefix(size[back])[first]


def gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Concatenation of flat[start : start + size]."""
    where = tb.prefix(size)
    shift = np.repeat(start - where[:-1], size)
    return flat[np.arange(where[-1]) + shift]


@lru_cache(maxsize=2)
def codec(path: str) -> _Codec:
    return _Codec(path)


@lru_cache(maxsize=2)
def token_table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all tokens, where each begins, and their lengths."""
    tokens = token_bytes(path)
    size = np.array([len(t) for t in tokens], np.int64)
    return np.frombuffer(b"".join(tokens), np.uint8), tb.prefix(size), size


def encode(
    docs: DataFrame, tokenizer_path: str, text_col: str = "text", ids_col: str | None = "ids", count_col: str = "n_tokens"
) -> DataFrame:
    """Append the ids of each text (little-endian unsigned 32-bit integers, as binary) and their number.

    Without ``ids_col`` only the number is returned.
    """
    fields = [(count_col, T.LongType(), pa.int64())]
    if ids_col:
        fields.append((ids_col, T.BinaryType(), pa.binary()))

    def run(batch):
        own = codec(tokenizer_path)
        for lo, hi, raw, off in tb.text_groups(batch, text_col):
            ids, first = own.encode(raw, off)
            out = [np.diff(first)]
            if ids_col:
                data = ids.astype("<u4").tobytes()
                out.append([data[4 * a : 4 * b] for a, b in zip(first[:-1], first[1:], strict=True)])
            yield lo, hi, out

    return add_columns(docs, fields, run)


def decode(df: DataFrame, tokenizer_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Append the text that the ids stand for; bytes that are no UTF-8 become U+FFFD."""

    def run(batch):
        flat, at, size = token_table(tokenizer_path)
        for lo, hi, raw, off in tb.text_groups(batch, ids_col):
            ids = np.frombuffer(raw.tobytes(), "<u4")
            data = gather(flat, at[ids], size[ids]).tobytes()
            ends = tb.prefix(size[ids])[off // 4]
            yield lo, hi, [[data[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:], strict=True)]]

    return add_columns(df, [(text_col, T.StringType(), pa.string())], run)
