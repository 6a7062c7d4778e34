"""Operator 5 - language-model scores from subword lattices.

A text is the sequence of its lower-cased words; a word is scored by the sum
over *all* its segmentations into pieces of an existing subword vocabulary,
computed by a forward recursion in log space.  The existing scores order the
pieces: a Zipf law over them gives the first weights, which are fitted to the
training documents by expected piece counts over the lattices (forward and
backward, ``rounds`` times).  Characters without a piece fall back to bytes.
An end symbol closes each text.

Each different word is segmented once, in a table that Spark builds from all
documents; its row carries the training count and the lattice probability.
Documents look up the ``FREQUENT`` most frequent words (a broadcast of that
fixed size) inside the scan, and only occurrences of rarer words are shuffled
to the table, so no frequent word makes a hot key.

Defined results: a null text counts as empty and has the end symbol only; a
null id is taken as the empty string for the split; without training
documents every count is 0 and the first weights are used; repeated rows count
and are scored each time.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.llm import textbytes as tb
from farelane.llm.frames import arrow_map, materialize

FREQUENT = 100_000
FOLDS, HELD_OUT = 5, 1
ROUNDS = 2
#: weight of the first distribution when piece counts are turned into probabilities
PRIOR_COUNT = 1000.0
#: longer words are walked position by position instead of in a block
BLOCK_WORD = 512
BLOCK_BYTES = 1 << 19
LOG10 = float(np.log(10.0))


class Vocabulary:
    """Pieces of a sentencepiece model with a table for looking up byte spans."""

    def __init__(self, model_path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces: dict[bytes, float] = {}
        for i in range(sp.get_piece_size()):
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i):
                continue
            text = sp.id_to_piece(i)
            piece = (" " + text[1:] if text[0] == "▁" else text).encode()
            if "▁" not in text[1:]:  # words hold no space
                pieces.setdefault(piece, sp.get_score(i))
        for b in range(256):
            pieces.setdefault(bytes([b]) + b"\xff\xff", min(pieces.values()) - 1)  # byte b as a piece of its own; no text contains it
        self.pieces = list(pieces)
        self.byte_piece = np.array([self.pieces.index(bytes([b]) + b"\xff\xff") for b in range(256)])
        rank = np.argsort(np.argsort(-np.array(list(pieces.values())), kind="stable"))
        weight = 1.0 / (rank + 2.7)
        self.prior = np.log(weight / weight.sum())
        size = np.array([len(p) for p in self.pieces])
        self.max_len = int(size[: -256 or None].max())
        ends = np.cumsum(size)
        h = tb.span_hashes(np.frombuffer(b"".join(self.pieces), np.uint8), ends - size, ends)
        order = np.argsort(h)
        self.hashes, self.ids = h[order], order
        self.bits = 20
        start = np.searchsorted(self.hashes >> np.uint64(64 - self.bits), np.arange((1 << self.bits) + 1, dtype=np.uint64))
        self.bucket = start.astype(np.int32)
        self.deepest = int(np.diff(start).max())

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """Piece ids of the hashes, -1 where there is none."""
        out = np.full(len(h), -1, np.int64)
        top = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        at, end = self.bucket[top], self.bucket[top + 1]
        todo = np.flatnonzero(at < end)
        for step in range(self.deepest):
            todo = todo[at[todo] + step < end[todo]]
            same = self.hashes[at[todo] + step] == h[todo]
            out[todo[same]] = self.ids[at[todo[same]] + step]
        return out

    def edges(self, b: np.ndarray, offsets: np.ndarray):
        """(start, end, piece) of all lattice edges; piece -1 is one character by its bytes.

        ``b`` holds the words one after the other, each after a space;
        positions are bytes, and an edge never leaves its word.
        """
        n = len(b)
        up, down = tb._powers(n + 1)
        c = np.zeros(n + 1, np.uint64)
        np.cumsum(tb._TABLE[b] * up[:n], out=c[1:])
        left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(n)
        at = np.flatnonzero(tb.code_points(b))
        lead = b[at]
        wide = np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))
        alone = np.ones(len(at), bool)  # characters without a piece
        starts, ends, found = [], [], []
        where, order = at, np.arange(len(at))
        for size in range(1, self.max_len + 1):
            keep = left[where] >= size
            where, order = where[keep], order[keep]
            if not len(where):
                break
            piece = self.lookup(tb.mix((c[where + size] - c[where]) * down[where]))
            hit = piece >= 0
            starts.append(where[hit])
            ends.append(where[hit] + size)
            found.append(piece[hit])
            single = hit & (wide[order] == size)
            alone[order[single]] = False
        starts.append(at[alone])
        ends.append(np.minimum(at + wide, at + left[at])[alone])
        found.append(np.full(int(alone.sum()), -1))
        return np.concatenate(starts), np.concatenate(ends), np.concatenate(found)


def _edge_scores(vocab: Vocabulary, logp: np.ndarray, b: np.ndarray, start, end, piece) -> np.ndarray:
    by_byte = np.zeros(len(b) + 1)
    np.cumsum(logp[vocab.byte_piece[b]], out=by_byte[1:])
    return np.where(piece >= 0, logp[piece], by_byte[end] - by_byte[start])


def _sweep(value: np.ndarray, source: np.ndarray, target: np.ndarray, score: np.ndarray, key: np.ndarray) -> None:
    """value[target] = logsumexp(value[source] + score), in the order of ``key``; equal keys have different targets."""
    order = np.argsort(key, kind="stable")
    source, target, score, key = source[order], target[order], score[order], key[order]
    cuts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(key)], strict=True):
        t = target[lo:hi]
        value[t] = np.logaddexp(value[t], value[source[lo:hi]] + score[lo:hi])


def word_lattices(vocab: Vocabulary, logp: np.ndarray, b: np.ndarray, offsets: np.ndarray, weights: np.ndarray | None = None):
    """Natural-log probability of each word, and with ``weights`` the expected counts of all pieces."""
    n_words = len(offsets) - 1
    start, end, piece = vocab.edges(b, offsets)
    score = _edge_scores(vocab, logp, b, start, end, piece)
    word = np.searchsorted(offsets, start, side="right") - 1
    local_start, local_end = start - offsets[word], end - offsets[word]
    node_of = offsets + np.arange(n_words + 1)  # a word of n bytes has n + 1 nodes
    source, target = start + word, end + word
    longest = int(np.diff(offsets).max()) + 1 if n_words else 1
    alpha = np.full(len(b) + n_words, -np.inf)
    alpha[node_of[:-1]] = 0.0
    _sweep(alpha, source, target, score, local_end * longest + local_start)
    last = node_of[1:] - 1
    total = alpha[last]
    if weights is None:
        return total, None
    beta = np.full(len(b) + n_words, -np.inf)
    beta[last] = 0.0
    _sweep(beta, target, source, score, (longest - local_start) * longest + local_end)
    mass = np.exp(alpha[source] + score + beta[target] - total[word]) * weights[word]
    known = piece >= 0
    counts = np.bincount(piece[known], weights=mass[known], minlength=len(vocab.pieces)).astype(np.float64)
    for s, e, m in zip(start[~known].tolist(), end[~known].tolist(), mass[~known].tolist(), strict=True):
        np.add.at(counts, vocab.byte_piece[b[s:e]], m)
    return total, counts


def _word_blocks(texts: list[str]):
    """Index ranges of words with the bytes and offsets that ``word_lattices`` takes; long words alone."""
    lo = 0
    while lo < len(texts):
        data, size, hi = [], 0, lo
        while hi < len(texts) and (hi == lo or size < BLOCK_BYTES):
            raw = b" " + texts[hi].encode()
            if len(raw) > BLOCK_WORD and hi > lo:
                break
            data.append(raw)
            size += len(raw)
            hi += 1
            if len(raw) > BLOCK_WORD:
                break
        yield lo, hi, np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in data])])
        lo = hi


def word_table(docs: DataFrame) -> DataFrame:
    """hash, word, c (occurrences in training documents) and c_all of every word of ``docs`` (columns text, held_out)."""

    def run(batch):
        held = batch.column(1).to_numpy(zero_copy_only=False)
        for lo, hi, raw, off in tb.text_groups(batch, "text"):
            b, starts, ends, hashes, first = tb.words(raw, off, tb.NOT_SPACE)
            if not len(hashes):
                continue
            train = np.repeat(~held[lo:hi].astype(bool), np.diff(first))
            h, one, back, n = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
            data = b.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(h.view(np.int64)),
                    pa.array([data[starts[i] : ends[i]].decode("utf-8", "replace") for i in one], pa.string()),
                    pa.array(np.bincount(back, weights=train, minlength=len(h)).astype(np.int64)),
                    pa.array(n.astype(np.int64)),
                ],
                names=["hash", "word", "c", "c_all"],
            )

    parts = arrow_map(docs.select("text", "held_out"), run, "hash bigint, word string, c bigint, c_all bigint")
    return parts.groupBy("hash", "word").agg(F.sum("c").alias("c"), F.sum("c_all").alias("c_all"))


def _expected_counts(words: DataFrame, model) -> np.ndarray:
    """Expected piece counts of the training words under the current weights; as many numbers as pieces reach the driver."""

    def run(batches):
        vocab, logp = model.value
        total = np.zeros(len(vocab.pieces))
        for batch in batches:
            texts, c = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for lo, hi, b, off in _word_blocks(texts):
                total += word_lattices(vocab, logp, b, off, c[lo:hi].astype(float))[1]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["piece", "n"])

    rows = words.filter("c > 0").select("word", "c").mapInArrow(run, "piece bigint, n double")
    out = np.zeros(len(model.value[0].pieces))
    for r in rows.groupBy("piece").agg(F.sum("n").alias("n")).collect():
        out[r["piece"]] = r["n"]
    return out


def fit(words: DataFrame, model_path: str, texts: int, rounds: int = ROUNDS) -> tuple[Vocabulary, np.ndarray, float]:
    """The vocabulary, the natural-log probabilities of its pieces after ``rounds`` of expected counts, and that of the end of one of ``texts`` texts."""
    vocab = Vocabulary(model_path)
    sc = words.sparkSession.sparkContext
    ends = max(texts, 1)
    total = PRIOR_COUNT + ends
    logp = vocab.prior + np.log(PRIOR_COUNT / total)
    for _ in range(rounds):
        counts = _expected_counts(words, sc.broadcast((vocab, logp))) + PRIOR_COUNT * np.exp(vocab.prior)
        total = counts.sum() + ends
        logp = np.log(counts / total)
    return vocab, logp, float(np.log(ends / total))


def _with_lattice(words: DataFrame, model) -> DataFrame:
    """hash, c, c_all, lp: the log10 probability of each word over its lattice."""

    def run(batch):
        vocab, logp = model.value
        texts = batch.column(1).to_pylist()
        out = np.zeros(len(texts))
        for lo, hi, b, off in _word_blocks(texts):
            out[lo:hi] = word_lattices(vocab, logp, b, off)[0] / LOG10
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(out)], names=["hash", "c", "c_all", "lp"])

    return arrow_map(words.select("hash", "word", "c", "c_all"), run, "hash bigint, c bigint, c_all bigint, lp double")


def _looked_up(docs: DataFrame, frequent) -> DataFrame:
    """Per document: number of words, the sums over frequent words, and the rarer words with their numbers."""
    fields = "key bigint, n_words bigint, known bigint, base double, lp double, rare array<bigint>, times array<bigint>"

    def run(batch):
        table = frequent.value
        keys = batch.column(0)
        doc = batch.column(2)
        for lo, hi, raw, off in tb.text_groups(batch, "text"):
            _, _, _, hashes, first = tb.words(raw, off, tb.NOT_SPACE)
            counts = np.diff(first)
            row = np.repeat(np.arange(hi - lo), counts)
            at = np.minimum(np.searchsorted(table["hash"], hashes), max(len(table["hash"]) - 1, 0))
            hit = table["hash"][at] == hashes if len(table["hash"]) else np.zeros(len(hashes), bool)
            sums = [np.bincount(row[hit], weights=table[c][at[hit]], minlength=hi - lo).astype(np.float64) for c in ("known", "base", "lp")]
            order = np.lexsort((hashes[~hit], row[~hit]))
            r, h = row[~hit][order], hashes[~hit][order]
            new = np.flatnonzero(np.append(True, (r[1:] != r[:-1]) | (h[1:] != h[:-1]))) if len(r) else np.zeros(0, np.int64)
            times = np.diff(np.append(new, len(r)))
            cut = pa.array(np.searchsorted(r[new], np.arange(hi - lo + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    keys.slice(lo, hi - lo),
                    pa.array(counts.astype(np.int64)),
                    pa.array(sums[0].astype(np.int64)),
                    pa.array(sums[1]),
                    pa.array(sums[2]),
                    pa.ListArray.from_arrays(cut, pa.array(h[new].view(np.int64))),
                    pa.ListArray.from_arrays(cut, pa.array(times.astype(np.int64))),
                    doc.slice(lo, hi - lo),
                ],
                names=["key", "n_words", "known", "base", "lp", "rare", "times", "doc"],
            )

    src = docs.select(F.monotonically_increasing_id().alias("key"), "text", F.struct(*[c for c in docs.columns if c != "text"]).alias("doc"))
    return arrow_map(src, run, f"{fields}, doc {src.schema['doc'].dataType.simpleString()}")


def _most_frequent(words: DataFrame, limit: int) -> DataFrame:
    """The words above a count that at most ``limit`` words exceed.

    The count comes from a histogram over classes of similar counts (about a
    thousand at most), so tasks send no more than the words themselves.
    """
    group = F.floor(F.log2("c_all") * 16)
    sizes = {r["g"]: r["n"] for r in words.groupBy(group.alias("g")).agg(F.count("*").alias("n")).collect()}
    least, taken = None, 0
    for g in sorted(sizes, reverse=True):
        taken += sizes[g]
        if taken > limit:
            break
        least = g
    return words.filter(F.lit(False) if least is None else group >= least)


def held_out(id_col: str) -> F.Column:
    """The documents that are not learned from: crc32 of the id as text, modulo ``FOLDS``."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def score(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, frequent: int = FREQUENT) -> DataFrame:
    """``id_col``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every row.

    ``base_score`` is the add-half word unigram, ``score`` the log10 probability
    of the text over all segmentations.
    """
    sc = docs.sparkSession.sparkContext
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), held_out(id_col).alias("held_out"))
    words = materialize(word_table(src), "words")
    n_train = src.filter(~F.col("held_out")).select(F.count("*")).first()[0]
    vocab, logp, end = fit(words, model_path, n_train, rounds)
    scored = materialize(_with_lattice(words, sc.broadcast((vocab, logp))), "scored_words")
    got = scored.agg(F.sum("c"), F.sum(F.when(F.col("c") > 0, 1).otherwise(0))).first()
    tokens, distinct = (got[0] or 0) + n_train, (got[1] or 0) + (n_train > 0)
    log_total = float(np.log10(tokens + 0.5 * (distinct + 1)))
    top = _most_frequent(scored, frequent).select("hash", "c", "lp").toArrow()
    h = top["hash"].to_numpy().view(np.uint64)
    order = np.argsort(h)
    c = top["c"].to_numpy()[order].astype(np.float64)
    table = {"hash": h[order], "known": (c > 0).astype(np.float64), "base": np.log10(c + 0.5), "lp": top["lp"].to_numpy()[order]}
    rows = materialize(_looked_up(src, sc.broadcast(table)), "looked_up")

    each = rows.select("key", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("key", F.col("w.rare").alias("hash"), F.col("w.times").alias("times"))
    some = each.join(scored, "hash").groupBy("key").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("r_known"),
        F.sum(F.col("times") * F.log10(F.col("c") + 0.5)).alias("r_base"),
        F.sum(F.col("times") * F.col("lp")).alias("r_lp"),
    )
    out = rows.drop("rare", "times").join(some, "key", "left")
    zero = F.lit(0.0)
    n = (F.col("n_words") + 1).cast("long")
    base = F.col("base") + F.coalesce("r_base", zero) + F.lit(float(np.log10(n_train + 0.5))) - n * F.lit(log_total)
    return out.select(
        F.col("doc.id").alias(id_col),
        F.col("doc.held_out").alias("held_out"),
        n.alias("n_tokens"),
        (F.col("known") + F.coalesce("r_known", F.lit(0)) + F.lit(int(n_train > 0))).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (F.col("lp") + F.coalesce("r_lp", zero) + F.lit(end / LOG10)).alias("score"),
    )
