"""Operator 11 - token ids in binary files of directly addressable codes.

``write_tokens`` encodes texts and writes their ids, an end id after each, in
ascending order of the id column.  A file holds whole documents.  An id is
split into chunks of ``widths`` bits, lowest first; level 0 keeps the first
chunk of every id, level k the k-th chunk of the ids that are long enough, in
the same order.  A bitmap of each level says which ids go on, and a directory
holds the number of set bits before each block of ``RANK_BITS``.  The place of
an id on the next level is the number of set bits before it, so any id is read
with a few small reads, and a run of ids is one run on every level.

The rows are dealt by ranges of (id, text hash), so a repeated id cannot fill
one task, and a task writes a file whenever it holds ``FILE_TOKENS`` ids.  File
names are new in each attempt; the list of files is a table that Spark commits,
so files of lost or repeated attempts are never read.  First positions are
running sums over that list: within a task's files, then over tasks.

``read_documents`` reads whole files, ``lookup`` single positions: these are
joined with the files by blocks of positions, and only the bytes of the
positions asked for are read.

Defined results: a null text counts as empty, an empty text has the end id
alone; a null id comes first; rows with equal ids are ordered by text hash and
text, equal rows stay repeated; an empty table writes no file and reads as no
row; further columns are not stored.  The id column is an integer.  Positions
that are null, negative or past the end have no row in ``lookup``.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelane.llm import textbytes as tb
from farelane.llm.fragment_table import table_codec
from farelane.llm.frames import materialize, shared_dir

#: ids after which a task begins a new file
FILE_TOKENS = 1 << 22
#: bits that one entry of a rank directory covers
RANK_BITS = 512
#: positions in a block of the join of ``lookup``
LOOKUP_BLOCK = FILE_TOKENS
END_ID = 0

_MAGIC = b"FLTOK001"
_HEAD = struct.Struct("<8sQQQI12B")


def level_widths(n_ids: int) -> tuple[int, ...]:
    """Chunks of eight bits that hold every id below ``n_ids``."""
    return (8,) * max(1, -(-max(n_ids - 1, 1).bit_length() // 8))


def _pack(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bits of each value, one after the other."""
    low = (values & np.uint32((1 << width) - 1)).astype(np.uint8)
    if width == 8:
        return low.tobytes()
    return np.packbits(np.unpackbits(low[:, None], axis=1, bitorder="little", count=width).ravel(), bitorder="little").tobytes()


def build_file(ids: np.ndarray, sizes: np.ndarray, doc_ids: np.ndarray, n_null: int, widths: tuple[int, ...]) -> bytes:
    """The bytes of one file; the first ``n_null`` documents have no id.

    Layout, little-endian: header (magic, documents, ids, documents without an
    id, levels, widths), places of the sections, then the sections: document
    ids, first position of each document and the end, and per level its
    chunks, bitmap and rank directory (the last level has chunks alone).
    """
    if len(ids) and int(ids.max()) >> sum(widths):
        raise ValueError("an id is wider than all levels together")
    sections = [doc_ids.astype("<i8").tobytes(), tb.prefix(sizes).astype("<u8").tobytes()]
    rest = ids.astype(np.uint32)
    for k, width in enumerate(widths):
        sections.append(_pack(rest, width))
        if k == len(widths) - 1:
            break
        more = rest >> np.uint32(width)
        goes_on = more > 0
        bits = np.packbits(goes_on, bitorder="little")
        blocks = np.add.reduceat(goes_on, np.arange(0, len(goes_on), RANK_BITS), dtype=np.int64) if len(goes_on) else np.zeros(0, np.int64)
        sections += [bits.tobytes(), tb.prefix(blocks).astype("<u8").tobytes()]
        rest = more[goes_on]
    places = _HEAD.size + 8 * (len(sections) + 1) + tb.prefix(np.array([len(s) for s in sections]))
    head = _HEAD.pack(_MAGIC, len(sizes), len(ids), n_null, len(widths), *widths, *[0] * (12 - len(widths)))
    return b"".join([head, places.astype("<u8").tobytes(), *sections])


class TokenFile:
    """One file; ``fetch(offset, size)`` returns bytes of it."""

    def __init__(self, fetch: Callable[[int, int], bytes]):
        self.fetch = fetch
        magic, self.n_docs, self.n_tokens, self.n_null, levels, *widths = _HEAD.unpack(fetch(0, _HEAD.size))
        if magic != _MAGIC:
            raise ValueError("not a token file")
        self.widths = widths[:levels]
        self.places = np.frombuffer(fetch(_HEAD.size, 8 * (3 * levels + 2)), "<u8").tolist()

    def _section(self, i: int, dtype: str) -> np.ndarray:
        return np.frombuffer(self.fetch(self.places[i], self.places[i + 1] - self.places[i]), dtype)

    def doc_ids(self) -> np.ndarray:
        return self._section(0, "<i8")

    def doc_starts(self) -> np.ndarray:
        return self._section(1, "<u8").astype(np.int64)

    def _bits(self, section: int, lo: int, hi: int) -> np.ndarray:
        """Bits [lo, hi) of a section."""
        first = lo >> 3
        data = np.frombuffer(self.fetch(self.places[section] + first, ((hi + 7) >> 3) - first), np.uint8)
        return np.unpackbits(data, bitorder="little")[lo - 8 * first : hi - 8 * first]

    def _rank(self, level: int, at: int) -> int:
        """Set bits of a level's bitmap before a position."""
        block = at // RANK_BITS
        before = int(np.frombuffer(self.fetch(self.places[4 + 3 * level] + 8 * block, 8), "<u8")[0])
        return before + int(self._bits(3 + 3 * level, block * RANK_BITS, at).sum()) if at % RANK_BITS else before

    def read(self, lo: int, hi: int) -> np.ndarray:
        """The ids at positions [lo, hi) of this file."""
        out = np.zeros(hi - lo, np.uint32)
        where, shift = np.arange(hi - lo), 0
        for k, width in enumerate(self.widths):
            if hi <= lo:
                break
            if width == 8:
                chunk = np.frombuffer(self.fetch(self.places[2 + 3 * k] + lo, hi - lo), np.uint8)
            else:
                bits = self._bits(2 + 3 * k, lo * width, hi * width)
                chunk = np.packbits(bits.reshape(-1, width), axis=1, bitorder="little")[:, 0]
            out[where] |= chunk.astype(np.uint32) << np.uint32(shift)
            if k == len(self.widths) - 1:
                break
            goes_on = self._bits(3 + 3 * k, lo, hi) == 1
            lo = self._rank(k, lo)
            where, shift = where[goes_on], shift + width
            hi = lo + len(where)
        return out


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if ":" in path else (pafs.LocalFileSystem(), path)


def _whole(path: str) -> TokenFile:
    fs, name = _open(path)
    with fs.open_input_file(name) as f:
        data = f.read()
    return TokenFile(lambda at, size: data[at : at + size])


@lru_cache(maxsize=4)
def _by_place(path: str) -> TokenFile:
    fs, name = _open(path)
    f = fs.open_input_file(name)
    return TokenFile(lambda at, size: f.read_at(size, at))


class _Writer:
    """Collects encoded documents and writes a file when there are enough."""

    def __init__(self, folder: str, widths: tuple[int, ...]):
        from pyspark import TaskContext

        self.folder, self.widths, self.part, self.seq = folder, widths, TaskContext.get().partitionId(), 0
        self._empty()

    def _empty(self) -> None:
        self.ids, self.sizes, self.docs, self.n_null, self.n_tokens = [], [], [], 0, 0

    def add(self, ids: np.ndarray, sizes: np.ndarray, docs: pa.Array) -> None:
        self.ids.append(ids)
        self.sizes.append(sizes)
        self.docs.append(docs.fill_null(0).cast(pa.int64()).to_numpy(zero_copy_only=False))
        self.n_null += docs.null_count
        self.n_tokens += len(ids)

    def flush(self) -> Iterator[dict]:
        if not self.sizes:
            return
        sizes = np.concatenate(self.sizes)
        data = build_file(np.concatenate(self.ids), sizes, np.concatenate(self.docs), self.n_null, self.widths)
        path = f"{self.folder}/part-{self.part:06d}-{self.seq:06d}-{uuid.uuid4().hex[:12]}.tok"
        fs, name = _open(path)
        fs.create_dir(name.rsplit("/", 1)[0], recursive=True)
        with fs.open_output_stream(name) as f:
            f.write(data)
        yield {"part": self.part, "seq": self.seq, "path": path, "n_docs": len(sizes), "n_tokens": self.n_tokens, "n_bytes": len(data)}
        self.seq += 1
        self._empty()


_FILES = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64())])


def write_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int | None = END_ID,
    folder: str | None = None,
    partitions: int | None = None,
    file_tokens: int = FILE_TOKENS,
    widths: tuple[int, ...] | None = None,
) -> DataFrame:
    """Write the ids of all texts; returns the files: part, seq, path, n_docs, n_tokens, n_bytes, start.

    ``folder`` is a place that all executors share, by default a new one under
    the session's shared folder.  ``partitions`` is the number of id ranges, by
    default the session's number of shuffle partitions.
    """
    spark = docs.sparkSession
    folder = folder or shared_dir(spark, "tokens")
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        own = table_codec(tokenizer_path)
        out = _Writer(folder, widths or level_widths(max(own.tokenizer.get_vocab_size(), (end_id or 0) + 1)))
        for batch in batches:
            for lo, hi, raw, off in tb.text_groups(batch, "text"):
                ids, first = own.encode(raw, off)
                if end_id is not None:
                    ids, first = np.insert(ids, first[1:], end_id), first + np.arange(len(first))
                out.add(ids, np.diff(first), batch.column(0).slice(lo, hi - lo))
                if out.n_tokens >= file_tokens:
                    yield pa.RecordBatch.from_pylist(list(out.flush()), _FILES)
        yield pa.RecordBatch.from_pylist(list(out.flush()), _FILES)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text")).repartitionByRange(partitions, "id", "h").sortWithinPartitions("id", "h", "text")
    files = materialize(rows.select("id", "text").mapInArrow(run, "part int, seq int, path string, n_docs long, n_tokens long, n_bytes long"), "token_files")
    # one row per task: small whatever the number of documents
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_tokens")
    return files.withColumn("inside", inside).join(parts, "part").select(*files.columns, (F.col("before") + F.col("inside")).alias("start"))


def read_documents(files: DataFrame, id_col: str = "doc_id", with_ids: bool = True, partitions: int | None = None) -> DataFrame:
    """``id_col``, ``start``, ``n_tokens``, ``ids_crc32`` and, unless ``with_ids`` is false, ``ids`` (little-endian unsigned 32-bit integers)."""

    def run(batches):
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                file = _whole(path)
                starts, docs = file.doc_starts(), file.doc_ids()
                for group in range(0, file.n_docs, 1024):
                    at = starts[group : group + 1025]
                    ids = [file.read(a, b).astype("<u4").tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                    null = np.arange(group, group + len(ids)) < file.n_null
                    columns = [pa.array(docs[group : group + len(ids)], mask=null), pa.array(start + at[:-1]), pa.array(np.diff(at)), pa.array([zlib.crc32(x) for x in ids], pa.int64())]
                    if with_ids:
                        columns.append(pa.array(ids, pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [id_col, "start", "n_tokens", "ids_crc32", *["ids"] * with_ids]
    partitions = partitions or int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = f"`{id_col}` long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    return files.select("path", "start").repartition(partitions).mapInArrow(run, schema)


def lookup(files: DataFrame, positions: DataFrame, position_col: str = "position") -> DataFrame:
    """``position``, ``token_id`` of every position over all files; only the bytes needed are read."""

    def run(batches):
        for batch in batches:
            at = batch.column("at").to_pylist()
            ids = [int(_by_place(path).read(a, a + 1)[0]) for path, a in zip(batch.column("path").to_pylist(), at, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("position"), pa.array(ids, pa.int64())], names=["position", "token_id"])

    block = lambda c: F.floor(c / F.lit(LOOKUP_BLOCK)).cast("long")
    held = files.filter("n_tokens > 0").select("path", "start", "n_tokens")
    held = held.withColumn("block", F.explode(F.sequence(block(F.col("start")), block(F.col("start") + F.col("n_tokens") - 1))))
    asked = positions.select(F.col(position_col).cast("long").alias("position")).withColumn("block", block(F.col("position")))
    inside = (F.col("position") >= F.col("start")) & (F.col("position") < F.col("start") + F.col("n_tokens"))
    found = asked.join(held, "block").filter(inside)
    found = found.select("path", (F.col("position") - F.col("start")).alias("at"), "position").sortWithinPartitions("path", "at")
    return found.mapInArrow(run, "position long, token_id long")
