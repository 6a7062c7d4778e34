"""Operator 12 - fill-in-the-middle by a piece table.

A document is never rebuilt while it is worked on: it is a list of descriptors
(buffer, start, length) over two immutable buffers, its text and the sentinels.
Cutting splits a descriptor, an arrangement permutes descriptors and puts
sentinel descriptors between them, the inverse permutation restores the order.
Texts are made from descriptors only where somebody asks for the text itself;
digests read the descriptors one after the other.

Units are words with the white space before them, and one unit of trailing
white space.  Where a document is cut and whether it is rearranged follows from
a hash of seed and id alone, so a repeated task makes the same choice.

Defined results: a null text counts as empty; an empty text, and one that holds
a sentinel, stays plain (its sentinels could not be told from inserted ones); a
null id hashes as the empty string; repeated rows get equal results; an empty
table gives none; an input column with the name of a new one is replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.llm import textbytes as tb
from farelane.llm.frames import add_columns

SENTINELS = (b"<P>", b"<S>", b"<M>")
#: per cent of documents that are rearranged, and of these the share in suffix-first order
RATE, SPM_RATE = 50, 80

TEXT, MARKS = 0, 1
_MARKS = b"".join(SENTINELS)
#: order of the parts (0 prefix, 1 middle, 2 suffix) in each form, each after its sentinel
ARRANGEMENTS = {"psm": (0, 2, 1), "spm": (2, 0, 1)}
_SENTINEL_OF = {0: 0, 2: 1, 1: 2}

Piece = tuple[int, int, int]
_PIECES = T.ArrayType(T.StructType([T.StructField("buffer", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType())]))
_PIECES_ARROW = pa.list_(pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]))


def cut(pieces: list[Piece], at: int) -> tuple[list[Piece], list[Piece]]:
    """The descriptors before and after byte ``at`` of what they stand for."""
    left: list[Piece] = []
    for i, (buffer, start, length) in enumerate(pieces):
        if at < length:
            right = [(buffer, start + at, length - at), *pieces[i + 1 :]]
            return (left + [(buffer, start, at)] if at else left), right
        left.append((buffer, start, length))
        at -= length
    return left, []


def _sentinel(part: int) -> Piece:
    i = _SENTINEL_OF[part]
    return MARKS, sum(map(len, SENTINELS[:i])), len(SENTINELS[i])


def arrange(parts: tuple[list[Piece], ...], form: str) -> list[Piece]:
    """The parts in the order of a form, each after its sentinel; plain keeps them as they are."""
    if form == "plain":
        return [p for part in parts for p in part]
    return [p for i in ARRANGEMENTS[form] for p in (_sentinel(i), *parts[i])]


def restore(output: bytes, form: str) -> list[Piece]:
    """Descriptors over an output's own bytes that put the text together again."""
    whole = [(TEXT, 0, len(output))]
    if form == "plain":
        return whole
    parts: dict[int, list[Piece]] = {}
    rest, done = whole, 0
    order = ARRANGEMENTS[form]
    for i, part in enumerate(order):
        mark = SENTINELS[_SENTINEL_OF[part]]
        if output[done : done + len(mark)] != mark:
            raise ValueError("not an output of this form")
        end = output.index(SENTINELS[_SENTINEL_OF[order[i + 1]]], done) if i + 1 < len(order) else len(output)
        own, rest = cut(rest, end - done)
        _, parts[part] = cut(own, len(mark))
        done = end
    return [p for part in range(3) for p in parts[part]]


def stream(pieces: list[Piece], text: memoryview | bytes) -> Iterator[memoryview]:
    """The bytes that descriptors stand for, piece by piece."""
    buffers = (memoryview(text), memoryview(_MARKS))
    for buffer, start, length in pieces:
        yield buffers[buffer][start : start + length]


def digest(pieces: list[Piece], text: memoryview | bytes) -> str:
    h = hashlib.sha256()
    for part in stream(pieces, text):
        h.update(part)
    return h.hexdigest()


def choices(id_col: str = "doc_id", seed: int = 42) -> list[Column]:
    """The first four groups of eight hex digits of the hash of ``seed:id``, as integers."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(h, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def units(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of all units, and the index of each row's first one."""
    last = np.zeros(len(raw), bool)
    word = tb.NOT_SPACE[raw]
    last[:-1] = word[:-1] & ~word[1:]
    last[offsets[1:][offsets[1:] > offsets[:-1]] - 1] = True
    ends = np.flatnonzero(last) + 1
    return ends, np.searchsorted(ends, offsets, side="right")


_FIELDS = [
    ("n", T.LongType(), pa.int64()),
    ("form", T.StringType(), pa.string()),
    ("prefix_chars", T.LongType(), pa.int64()),
    ("middle_chars", T.LongType(), pa.int64()),
    ("pieces", _PIECES, _PIECES_ARROW),
]


def _with_choices(docs: DataFrame, id_col: str, seed: int) -> DataFrame:
    return docs.withColumn("__choice", F.array(*choices(id_col, seed)))


def _chosen(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index("__choice"))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, 4)


def _documents(batch: pa.RecordBatch, text_col: str, rate: int, spm_rate: int):
    """(first row, end row, [(text, n, form, prefix_chars, middle_chars, pieces)]) of row groups."""
    chosen = _chosen(batch)
    for lo, hi, raw, off in tb.text_groups(batch, text_col):
        ends, first = units(raw, off)
        counts = np.diff(first)
        h = chosen[lo:hi]
        one, two = h[:, 0] % (counts + 1), h[:, 1] % (counts + 1)
        places = np.concatenate([[0], ends])
        # the end of the row's k-th unit; k = 0 is the row's start
        at = [np.where(k == 0, off[:-1], places[first[:-1] + k]) - off[:-1] for k in (np.minimum(one, two), np.maximum(one, two))]
        chars = tb.prefix(tb.code_points(raw))
        n_chars = [chars[off[:-1] + x] - chars[off[:-1]] for x in at]
        data = memoryview(raw.tobytes())
        rows = []
        for i in range(hi - lo):
            text = data[off[i] : off[i + 1]]
            whole = [(TEXT, 0, len(text))] if len(text) else []
            form = "plain" if h[i, 2] % 100 >= rate else "spm" if h[i, 3] % 100 < spm_rate else "psm"
            if form != "plain" and (not len(text) or any(s in bytes(text) for s in SENTINELS)):
                form = "plain"
            if form == "plain":
                rows.append((text, counts[i], form, None, None, whole))
                continue
            before, suffix = cut(whole, int(at[1][i]))
            prefix, middle = cut(before, int(at[0][i]))
            rows.append((text, counts[i], form, n_chars[0][i], n_chars[1][i] - n_chars[0][i], arrange((prefix, middle, suffix), form)))
        yield lo, hi, rows


def rearrange(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """Append ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` and ``pieces``, the output as descriptors over text and sentinels."""

    def run(batch):
        for lo, hi, rows in _documents(batch, text_col, rate, spm_rate):
            _, n, form, prefix, middle, pieces = zip(*rows, strict=True)
            yield lo, hi, [n, form, prefix, middle, [[dict(zip(("buffer", "start", "length"), p, strict=True)) for p in x] for x in pieces]]

    return add_columns(_with_choices(docs, id_col, seed), _FIELDS, run).drop("__choice")


def render(df: DataFrame, text_col: str = "text", pieces_col: str = "pieces", output_col: str = "output") -> DataFrame:
    """Append the texts that descriptors stand for."""

    def run(batch):
        pieces = batch.column(batch.schema.get_field_index(pieces_col))
        for lo, hi, raw, off in tb.text_groups(batch, text_col):
            data = memoryview(raw.tobytes())
            lists = [[(p["buffer"], p["start"], p["length"]) for p in x or []] for x in pieces.slice(lo, hi - lo).to_pylist()]
            yield lo, hi, [[b"".join(stream(x, data[off[i] : off[i + 1]])).decode() for i, x in enumerate(lists)]]

    return add_columns(df, [(output_col, T.StringType(), pa.string())], run)


def unrender(df: DataFrame, output_col: str = "output", form_col: str = "form", restored_col: str = "restored") -> DataFrame:
    """Append the exact text, rebuilt from output and form alone."""

    def run(batch):
        forms = batch.column(batch.schema.get_field_index(form_col)).to_pylist()
        for lo, hi, raw, off in tb.text_groups(batch, output_col):
            data = raw.tobytes()
            outputs = [data[a:b] for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            yield lo, hi, [[b"".join(stream(restore(x, forms[lo + i]), x)).decode() for i, x in enumerate(outputs)]]

    return add_columns(df, [(restored_col, T.StringType(), pa.string())], run)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """As ``rearrange``, with the SHA-256 of the output and of the text restored from it instead of descriptors.

    The restored digest is taken from the output's bytes and the form, never
    from the text; only one output is in memory at a time.
    """
    fields = [*_FIELDS[:-1], ("output_sha256", T.StringType(), pa.string()), ("restored_sha256", T.StringType(), pa.string())]

    def run(batch):
        for lo, hi, rows in _documents(batch, text_col, rate, spm_rate):
            made, back = [], []
            for text, _, form, _, _, pieces in rows:
                made.append(digest(pieces, text))
                output = b"".join(stream(pieces, text))
                back.append(digest(restore(output, form), output))
            _, n, form, prefix, middle, _ = zip(*rows, strict=True)
            yield lo, hi, [n, form, prefix, middle, made, back]

    return add_columns(_with_choices(docs, id_col, seed), fields, run).drop("__choice")


#: DuckDB SQL over ``documents``
ORACLE_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
         sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), c AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS k1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS k2,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 50 THEN 'plain'
              WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM t
), p AS (
  SELECT *, array_to_string(u[1:least(k1, k2)], '') AS pre, array_to_string(u[least(k1, k2) + 1:greatest(k1, k2)], '') AS mid,
         array_to_string(u[greatest(k1, k2) + 1:], '') AS suf
  FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE '<P>' || pre || '<S>' || suf || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
