"""Operator 1 - benchmark decontamination by a prefix-filtered set join.

Benchmark items are cut into windows of ``WINDOW`` consecutive words (a shorter
item is one window) and each window into shingles.  A text contains a window
exactly only if it contains all its shingles, so a prefix of one shingle is
necessary; the rarest one over the whole corpus is taken, and windows with a
shingle that never occurs are dropped.  Documents are joined on the prefix
shingles, positional and length bounds place the window inside the document,
and the words themselves are compared.

How it runs: the corpus is scanned twice (counts of benchmark shingles, then
the occurrences of prefix shingles with their neighbouring words).  A bitmap
of fixed size lets a scan skip everything that is no benchmark shingle; false
positives only cost time.  Occurrences are salted by row before the join, so a
passage that a third of all documents share is spread over tasks.

Defined results: a null or word-less text has no words and no hits; an item
without words has no windows; a null item id is reported as the empty string;
items that share an id are one item; every input row of ``docs`` gives one
output row, repeated rows and null ids included.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelane.llm import bitmap
from farelane.llm import textbytes as tb
from farelane.llm.frames import arrow_map, materialize

WINDOW = 13
SHINGLE = 4
SALTS = 16


def _item_windows(items: DataFrame, id_col: str, text_col: str, window: int, shingle: int) -> DataFrame:
    """item_id, n (words), words (joined by spaces), size (of its shingles), shingles; distinct."""

    def run(batch):
        ids = batch.column(0).to_pylist()
        out = {k: [] for k in ("item_id", "n", "words", "size", "shingles")}
        for lo, hi, raw, off in tb.text_groups(batch, "text"):
            b, starts, ends, hashes, first = tb.words(raw, off, tb.ALNUM)
            data = b.tobytes()
            for r in range(hi - lo):
                a, z = int(first[r]), int(first[r + 1])
                if a == z:
                    continue
                n = min(window, z - a)
                size = min(shingle, n)
                _, _, sh = tb.shingles(hashes[a:z], np.array([0, z - a]), size)
                sh = sh.view(np.int64)
                own = [data[s:e].decode("utf-8", "replace") for s, e in zip(starts[a:z], ends[a:z], strict=True)]
                for i in range(z - a - n + 1):
                    out["item_id"].append(ids[lo + r] if ids[lo + r] is not None else "")
                    out["n"].append(n)
                    out["words"].append(" ".join(own[i : i + n]))
                    out["size"].append(size)
                    out["shingles"].append(sh[i : i + n - size + 1].tolist())
        types = [pa.string(), pa.int32(), pa.string(), pa.int32(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], names=list(out))

    src = items.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return arrow_map(src, run, "item_id string, n int, words string, size int, shingles array<bigint>").distinct()


def _shingle_counts(docs: DataFrame, text_col: str, sizes: list[int], bits) -> DataFrame:
    """How often each (size, benchmark shingle) occurs in the corpus."""

    def run(batch):
        for _, _, raw, off in tb.text_groups(batch, "text"):
            _, _, _, hashes, first = tb.words(raw, off, tb.ALNUM)
            for size in sizes:
                _, _, sh = tb.shingles(hashes, first, size)
                h, n = np.unique(sh[bitmap.listed(bits.value, sh)], return_counts=True)
                if len(h):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), size, np.int32)), pa.array(h.view(np.int64)), pa.array(n)], names=["size", "hash", "n"])

    parts = arrow_map(docs.select(F.col(text_col).alias("text")), run, "size int, hash bigint, n bigint")
    return parts.groupBy("size", "hash").agg(F.sum("n").alias("n"))


def _prefixes(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Each window that can occur with its rarest shingle and the place of that shingle."""
    each = windows.select("item_id", "n", "words", "size", F.posexplode("shingles").alias("at", "hash"))
    known = each.join(counts.withColumnRenamed("n", "times"), ["size", "hash"])
    best = known.groupBy("item_id", "words", "n", "size").agg(
        F.min(F.struct("times", "hash", "at")).alias("best"), F.count("*").alias("found")
    )
    return best.filter(F.col("found") == F.col("n") - F.col("size") + 1).select(
        "item_id", "words", "n", "size", F.col("best.hash").alias("hash"), F.col("best.at").alias("at")
    )


def _occurrences(docs: DataFrame, text_col: str, sizes: list[int], bits, window: int, carried: list[str]) -> DataFrame:
    """One row per document (``n_words`` and its ``doc`` columns), and one per occurrence of a listed shingle with the words around it."""
    src = docs.select(F.monotonically_increasing_id().alias("key"), F.col(text_col).alias("text"), F.struct(*carried).alias("doc"))
    names = ["key", "n_words", "size", "hash", "pos", "skip", "around"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.string()]

    def rows(columns, doc):
        arrays = [pa.nulls(len(doc), t) if c is None else pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays([*arrays, doc], names=[*names, "doc"])

    def run(batch):
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        doc = batch.column(2)
        for lo, hi, raw, off in tb.text_groups(batch, "text"):
            b, starts, ends, hashes, first = tb.words(raw, off, tb.ALNUM)
            yield rows([keys[lo:hi], np.diff(first), None, None, None, None, None], doc.slice(lo, hi - lo))
            data = None
            for size in sizes:
                at, row, sh = tb.shingles(hashes, first, size)
                hit = bitmap.listed(bits.value, sh)
                if not hit.any():
                    continue
                data = data or b.tobytes()
                at, row, sh = at[hit], row[hit], sh[hit]
                left = np.maximum(first[row], at - (window - size))
                right = np.minimum(first[row + 1], at + window)
                around = [
                    b" ".join([data[starts[i] : ends[i]] for i in range(x, y)]).decode("utf-8", "replace")
                    for x, y in zip(left.tolist(), right.tolist(), strict=True)
                ]
                size_of = np.full(len(at), size, np.int32)
                yield rows(
                    [keys[lo + row], None, size_of, sh.view(np.int64), at - first[row], (at - left).astype(np.int32), around],
                    pa.nulls(len(at), doc.type),
                )

    doc_type = src.schema["doc"].dataType.simpleString()
    return arrow_map(src, run, f"key bigint, n_words bigint, size int, hash bigint, pos bigint, skip int, around string, doc {doc_type}")


def _matches(occurrences: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Verified window occurrences: key, item_id, start, n."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    right = prefixes.select("item_id", "words", "n", "size", "hash", "at", salts)
    left = occurrences.filter(F.col("hash").isNotNull()).withColumn("salt", F.pmod(F.xxhash64("key", "pos"), F.lit(SALTS)).cast("int"))
    begin = F.col("skip") - F.col("at")
    around = F.split("around", " ")
    found = left.join(right, ["size", "hash", "salt"]).filter((begin >= 0) & (begin + F.col("n") <= F.size(around)))
    same = F.array_join(F.slice(around, begin + 1, F.col("n")), " ") == F.col("words")
    return found.filter(same).select("key", "item_id", (F.col("pos") - F.col("at")).alias("start"), "n").distinct()


def contamination(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    min_percent: int = 5,
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit`` (words inside occurrences), ``items`` (sorted ids) and ``contaminated``.

    A document is contaminated if words are hit and they are at least
    ``min_percent`` percent of its words.  Input columns with those names are
    replaced.  The columns of ``docs`` are written once; ``keep_text=False``
    leaves the text out.
    """
    sc = docs.sparkSession.sparkContext
    new = ("n_words", "n_hit", "items", "contaminated")
    carried = [c for c in docs.columns if c not in new and (keep_text or c != text_col)]
    windows = materialize(_item_windows(items, item_id, item_text, window, shingle), "item_windows")
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())  # at most ``shingle`` values
    listed = sc.broadcast(bitmap.collect(windows.select(F.explode("shingles").alias("hash")), "hash"))
    counts = materialize(_shingle_counts(docs, text_col, sizes, listed), "shingle_counts")
    prefixes = materialize(_prefixes(windows, counts), "prefixes")
    wanted = sc.broadcast(bitmap.collect(prefixes, "hash"))
    found = materialize(_occurrences(docs, text_col, sizes, wanted, window, carried), "occurrences")
    matches = materialize(_matches(found, prefixes), "matches")

    end = F.col("start") + F.col("n")
    before = Window.partitionBy("key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), end - F.greatest("start", F.coalesce(F.max(end).over(before), F.col("start"))))
    spans = matches.groupBy("key", "start").agg(F.max("n").alias("n"))
    hit = spans.select("key", fresh.alias("fresh")).groupBy("key").agg(F.sum("fresh").cast("long").alias("n_hit"))
    ids = matches.groupBy("key").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    totals = found.filter(F.col("hash").isNull()).select("key", "n_words", "doc")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return (
        totals.join(hit, "key", "left")
        .join(ids, "key", "left")
        .select(
            *[F.col("doc")[c].alias(c) for c in carried],
            "n_words",
            n_hit.alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            ((n_hit > 0) & (100 * n_hit >= min_percent * F.col("n_words"))).alias("contaminated"),
        )
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, in the columns of ``docs``."""
    names = [f"c{i}" for i in range(len(docs.columns))]  # no clash with the operator's own columns
    text = names[docs.columns.index(options.pop("text_col", "text"))]
    judged = contamination(docs.toDF(*names), items, text_col=text, **options)
    return judged.filter(~F.col("contaminated")).select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])
