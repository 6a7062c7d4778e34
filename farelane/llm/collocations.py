"""Operator 13 - phrase collocations through weighted acyclic automata of word sequences.

1. Every task counts the sequences of up to four words that begin at each word
   of its texts, as the automaton of its sorted sequences (``count_automaton``):
   the weight of a state is how often the sequence that leads to it occurs, so
   counts of one to four words are all in it.
2. The automata are cut at range bounds, blocks of one range meet in one task,
   and their weights are added range by range.  Bounds are whole sequences, not
   words, so a very common word or pair is spread over ranges like any other.
   A state on a bound has parts of its weight in several ranges; the first and
   last state of each length go out of every range and are added up once more.
3. The states of at least ``min_count`` form the automaton of phrases.  Phrases
   ask for the weights of their parts: questions are sent to the range of the
   part, where the range's automaton is read symbol by symbol.

Words are told apart by 64-bit hashes of (language, word); the words themselves
travel with the states of one word and are joined to the reported phrases only.
Range bounds come from a sample of ``SAMPLE_DOCS`` documents; they decide where
work is done and how large a range is, never what is counted.

Defined results: a null text counts as empty; a null language is ``und``; rows
with equal ids or texts count each; very long texts and words count in full;
ties are ordered by count and then by the phrase's bytes; an empty table gives
no row; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelane.llm import count_automaton as ca
from farelane.llm import textbytes as tb
from farelane.llm.bpe import gather
from farelane.llm.frames import materialize

MIN_COUNT = 30
TOP = 2000
#: a phrase goes if a longer one that holds it has at least this share of its count (numerator, denominator)
SHARE = (4, 5)
SCALE = 2_000_000

#: words that a task counts before it sends its automaton on
TASK_WORDS = 2_000_000
#: words, over all shards, that a range should hold
RANGE_WORDS = 2_000_000
SAMPLE_DOCS = 1500
SAMPLE_PATHS = 32

_CUT = tb.byte_set(*b".,;:!?", (0x0A, 0x0D))
_WORD = ~(_CUT | tb.byte_set(0x20, 0x09))
_KEYS = [f"s{i}" for i in range(1, ca.DEPTH + 1)]


def _words(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[str]]]:
    """(bytes, starts, ends, symbols, pieces, language of each word, languages) of row groups of (lang, text)."""
    codes = batch.column(0).dictionary_encode()
    langs = codes.dictionary.to_pylist()
    code = codes.indices.to_numpy(zero_copy_only=False)
    names = [x.encode() for x in langs]
    ends = tb.prefix(np.array([len(x) for x in names], np.int64))
    salts = tb.span_hashes(np.frombuffer(b"".join(names), np.uint8), ends[:-1], ends[1:])
    for lo, hi, raw, off in tb.text_groups(batch, "text"):
        b, starts, stops, hashes, first = tb.words(raw, off, _WORD)
        row = np.repeat(np.arange(hi - lo), np.diff(first))
        lang = code[lo:hi][row]
        symbols = np.maximum(tb.mix(hashes + salts[lang] * np.uint64(0xA24BAED4963EE407)), np.uint64(1))
        cuts = tb.prefix(_CUT[b])
        # row starts count as cuts too
        yield b, starts, stops, symbols, cuts[starts] + row, lang, langs


class _Shard:
    """Words of a task until their automaton is sent on."""

    def __init__(self):
        self.empty()

    def empty(self) -> None:
        self.bytes, self.spans, self.symbols, self.pieces, self.langs, self.names = [], [], [], [], [], {}
        self.n_words = self.n_bytes = self.last_piece = 0

    def add(self, b, starts, stops, symbols, pieces, lang, langs) -> None:
        if not len(starts):
            return
        self.bytes.append(b)
        self.spans.append((starts + self.n_bytes, stops - starts))
        self.symbols.append(symbols)
        pieces = pieces - pieces[0] + self.last_piece + 1
        self.pieces.append(pieces)
        own = np.array([self.names.setdefault(x, len(self.names)) for x in langs], np.int32)
        self.langs.append(own[lang])
        self.n_words += len(starts)
        self.n_bytes += len(b)
        self.last_piece = int(pieces[-1])

    def blocks(self, bounds: list[tuple[int, ...]]) -> Iterator[dict]:
        """One row per range that holds paths."""
        symbols = np.concatenate(self.symbols)
        vocab, ids, counts = ca.sorted_paths(symbols, np.concatenate(self.pieces))
        _, one = np.unique(symbols, return_index=True)  # an occurrence of each word, in the order of vocab
        starts = np.concatenate([s for s, _ in self.spans])[one]
        sizes = np.concatenate([n for _, n in self.spans])[one]
        langs = np.concatenate(self.langs)[one]
        text = np.concatenate(self.bytes)
        names = list(self.names)
        places = [0, *(ca.place_of(vocab, ids, b) for b in bounds), len(ids)]
        for r, (lo, hi) in enumerate(zip(places[:-1], places[1:], strict=True)):
            if lo == hi:
                continue
            block = ca.encode_block(vocab, ids[lo:hi], counts[lo:hi])
            head = np.unique(ids[lo:hi, 0]).astype(np.int64) - 1
            yield {
                "range": r,
                **block.__dict__,
                "words": gather(text, starts[head], sizes[head]).tobytes(),
                "word_sizes": sizes[head].astype("<u4").tobytes(),
                "word_langs": langs[head].astype("<u4").tobytes(),
                "langs": names,
            }


_BLOCK = "range int, symbols binary, shape binary, labels binary, weights binary, heavy binary, words binary, word_sizes binary, word_langs binary, langs array<string>"
_BLOCK_ARROW = pa.schema(
    [("range", pa.int32()), *((n, pa.binary()) for n in ("symbols", "shape", "labels", "weights", "heavy", "words", "word_sizes", "word_langs")), ("langs", pa.list_(pa.string()))]
)


def _sample_bounds(texts: DataFrame, partitions: int) -> list[tuple[int, ...]]:
    """Paths that cut the documents' paths into ranges of about ``RANGE_WORDS`` words, a multiple of ``partitions`` of them."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                for _, _, _, symbols, pieces, _, _ in _words(batch.slice(i, 1)):
                    n = len(symbols)
                    if not n:
                        continue
                    at = np.unique(np.linspace(0, n - 1, SAMPLE_PATHS).astype(np.int64))
                    columns = []
                    for k in range(ca.DEPTH):
                        on = np.minimum(at + k, n - 1)
                        columns.append(np.where((at + k < n) & (pieces[on] == pieces[at]), symbols[on], np.uint64(0)).view(np.int64))
                    yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(np.full(len(at), n / len(at)))], names=[*_KEYS, "weight"])

    n_docs = texts.count()
    if not n_docs:
        return []
    share = min(1.0, SAMPLE_DOCS / n_docs)
    sample = texts if share == 1.0 else texts.sample(fraction=share, seed=7)
    rows = sample.mapInArrow(run, ", ".join(f"{k} long" for k in _KEYS) + ", weight double").toArrow()
    if not rows.num_rows:
        return []
    keys = np.stack([rows.column(k).to_numpy().view(np.uint64) for k in _KEYS], axis=1)
    weights = rows.column("weight").to_numpy()
    order = np.lexsort(keys.T[::-1])
    keys, total = keys[order], np.cumsum(weights[order])
    wanted = partitions * max(1, int(np.ceil(total[-1] / share / RANGE_WORDS / partitions)))
    at = np.searchsorted(total, total[-1] * np.arange(1, wanted) / wanted)
    return sorted({tuple(int(x) for x in keys[i]) for i in at})


def _by_range(df: DataFrame, partitions: int, *order: str) -> DataFrame:
    return df.repartitionById(partitions, F.pmod(F.col("range"), F.lit(partitions)).cast("int")).sortWithinPartitions("range", *order)


_STATES = ", ".join(f"{k} long" for k in _KEYS) + ", f long, lang string, word string"


def _states(parts: list, words: dict[int, tuple[str, bytes]], min_count: int) -> Iterator[pa.RecordBatch]:
    """The frequent states of a range, the first and last of each length, and the words of each language (no symbol)."""
    vocab, ids, counts = ca.unite(parts)
    vocab = np.concatenate([np.zeros(1, np.uint64), vocab])
    totals: dict[str, int] = {}
    for level in range(1, ca.DEPTH + 1):
        first, weight = ca.states(ids, counts, level)
        if not len(first):
            continue
        if level == 1:
            for s, w in zip(vocab[ids[first, 0]].tolist(), weight.tolist(), strict=True):
                lang = words[s][0]
                totals[lang] = totals.get(lang, 0) + w
        out = weight >= min_count
        out[[0, -1]] = True
        first, weight = first[out], weight[out]
        keys = np.zeros((len(first), ca.DEPTH), np.uint64)
        keys[:, :level] = vocab[ids[first, :level]]
        heads = [words[s] for s in keys[:, 0].tolist()]
        yield pa.RecordBatch.from_arrays(
            [
                *(pa.array(keys[:, k].view(np.int64)) for k in range(ca.DEPTH)),
                pa.array(weight),
                pa.array([x for x, _ in heads]),
                pa.array([w.decode("utf-8", "replace") for _, w in heads] if level == 1 else [None] * len(heads), pa.string()),
            ],
            names=[*_KEYS, "f", "lang", "word"],
        )
    zero = pa.array(np.zeros(len(totals), np.int64))
    yield pa.RecordBatch.from_arrays(
        [zero, zero, zero, zero, pa.array(list(totals.values()), pa.int64()), pa.array(list(totals), pa.string()), pa.nulls(len(totals), pa.string())], names=[*_KEYS, "f", "lang", "word"]
    )


def sequence_counts(docs: DataFrame, bounds: list[tuple[int, ...]], partitions: int, text_col: str, lang_col: str, min_count: int) -> DataFrame:
    """``s1`` to ``s4`` (0 after the end), ``f``, ``lang``, ``word`` of all sequences that occur ``min_count`` times.

    The row without symbols holds the number of words of a language; ``word``
    is given for sequences of one word.
    """

    def count(batches):
        shard = _Shard()
        for batch in batches:
            for group in _words(batch):
                shard.add(*group)
                if shard.n_words >= TASK_WORDS:
                    for row in shard.blocks(bounds):
                        yield pa.RecordBatch.from_pylist([row], _BLOCK_ARROW)
                    shard.empty()
        if shard.n_words:
            for row in shard.blocks(bounds):
                yield pa.RecordBatch.from_pylist([row], _BLOCK_ARROW)

    def unite(batches):
        current, parts, words, pending = None, [], {}, 0
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if current is not None and row["range"] != current:
                    yield from _states(parts, words, min_count)
                    parts, words, pending = [], {}, 0
                current = row["range"]
                part = ca.decode_block(ca.Block(row["symbols"], row["shape"], row["labels"], row["weights"], row["heavy"]))
                head = part[0][np.unique(part[1][:, 0]).astype(np.int64) - 1].tolist()
                ends = np.cumsum(np.frombuffer(row["word_sizes"], "<u4")).tolist()
                for s, a, b, c in zip(head, [0, *ends], ends, np.frombuffer(row["word_langs"], "<u4").tolist(), strict=False):
                    if s not in words:
                        words[s] = (row["langs"][c], row["words"][a:b])
                parts.append(part)
                pending += len(part[1])
                if len(parts) > 1 and pending > 2 * RANGE_WORDS:  # a range far larger than foreseen is united step by step
                    parts = [ca.unite(parts)]
                    pending = 0
        if current is not None:
            yield from _states(parts, words, min_count)

    texts = docs.select(F.coalesce(lang_col, F.lit("und")).alias("lang"), F.coalesce(text_col, F.lit("")).alias("text"))
    blocks = _by_range(texts.mapInArrow(count, _BLOCK), partitions)
    parts = blocks.mapInArrow(unite, _STATES)
    # the language is part of the sum's key only where there are no symbols
    summed = parts.groupBy(*_KEYS, F.when(F.col("s1") == 0, F.col("lang")).alias("total_of")).agg(F.sum("f").alias("f"), F.max("lang").alias("lang"), F.max("word").alias("word"))
    return summed.filter((F.col("f") >= min_count) | (F.col("s1") == 0)).drop("total_of")


def _route(keys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The range of each sequence: the number of bounds that are not after it."""
    both = np.concatenate([bounds, keys])
    tie = np.concatenate([np.zeros(len(bounds), np.int8), np.ones(len(keys), np.int8)])
    order = np.lexsort((tie, *both.T[::-1]))
    before = np.cumsum(order < len(bounds))
    out = np.empty(len(both), np.int64)
    out[order] = before
    return out[len(bounds) :]


_ASK = [f"p{i}" for i in range(1, ca.DEPTH + 1)]
#: value columns: left and right part of each cut, and the largest count of a longer phrase
_PARTS = [f"{side}{k}" for k in range(1, ca.DEPTH) for side in ("l", "r")]


def part_counts(counts: DataFrame, bounds: list[tuple[int, ...]], partitions: int) -> DataFrame:
    """Per phrase (``s1`` to ``s4``): ``l1``, ``r1`` .. ``r3``, the counts of the parts of each cut, and ``longer``."""
    table = np.array(bounds, np.uint64).reshape(-1, ca.DEPTH)

    def ask(batches):
        """States as they are (slot -1), and a question for each part of a phrase (slot of the answer), in the range of the key."""
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy().view(np.uint64) for i in range(ca.DEPTH)], axis=1)
            f = batch.column(ca.DEPTH).to_numpy()
            length = (keys > 0).sum(axis=1)
            sets = [(keys, keys, np.full(len(keys), -1), f)]
            for k in range(1, ca.DEPTH):
                has = length > k
                whole = keys[has]
                left, right = np.zeros_like(whole), np.zeros_like(whole)
                left[:, :k] = whole[:, :k]
                right[:, : ca.DEPTH - k] = whole[:, k:]
                for side, part in enumerate((left, right)):
                    sets.append((part, whole, np.full(len(whole), 2 * (k - 1) + side), f[has]))
            part, whole, slot, f = (np.concatenate(x) for x in zip(*sets, strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(_route(part, table), pa.int32()),
                    *(pa.array(part[:, i].view(np.int64)) for i in range(ca.DEPTH)),
                    *(pa.array(whole[:, i].view(np.int64)) for i in range(ca.DEPTH)),
                    pa.array(slot, pa.int32()),
                    pa.array(f),
                ],
                names=["range", *_ASK, *_KEYS, "slot", "f"],
            )

    def answer(batches):
        """Within a range the states come before the questions."""
        current, states, lookup = None, [], None
        for batch in batches:
            at = batch.column(0).to_numpy()
            slots = batch.column(9).to_numpy()
            asked = np.stack([batch.column(i).to_numpy().view(np.uint64) for i in range(1, 1 + ca.DEPTH)], axis=1)
            f = batch.column(10).to_numpy()
            edges = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            for lo, hi in zip(edges, np.append(edges[1:], len(at)), strict=True):
                if at[lo] != current:
                    current, states, lookup = at[lo], [], None
                split = lo + int(np.searchsorted(slots[lo:hi], 0))
                if split > lo:
                    states.append((asked[lo:split], f[lo:split]))
                if split == hi:
                    continue
                if lookup is None:
                    known = [np.concatenate(x) for x in zip(*states, strict=True)] if states else [np.zeros((0, ca.DEPTH), np.uint64), np.zeros(0, np.int64)]
                    lookup = ca.Lookup(*known)
                found = lookup.find(asked[split:hi])
                yield pa.RecordBatch.from_arrays([*(batch.column(5 + i).slice(split, hi - split) for i in range(ca.DEPTH)), pa.array(slots[split:hi]), pa.array(found)], names=[*_KEYS, "slot", "value"])

    phrases = counts.filter("s1 <> 0").select(*_KEYS, "f")
    asked = phrases.mapInArrow(ask, "range int, " + ", ".join(f"{k} long" for k in (*_ASK, *_KEYS)) + ", slot int, f long")
    answers = _by_range(asked, partitions, "slot").mapInArrow(answer, ", ".join(f"{k} long" for k in _KEYS) + ", slot int, value long")
    values = [F.max(F.when(F.col("slot") == i, F.col("value"))).alias(c) for i, c in enumerate(_PARTS)]
    held = _held_phrases(phrases)
    both = answers.unionByName(held.select(*_KEYS, F.lit(len(_PARTS)).alias("slot"), F.col("f").alias("value")))
    return both.groupBy(*_KEYS).agg(*values, F.max(F.when(F.col("slot") == len(_PARTS), F.col("value"))).alias("longer"))


def _held_phrases(phrases: DataFrame) -> DataFrame:
    """The phrases of two or more words inside each longer phrase, with the longer one's count."""
    parts = []
    for size in range(2, ca.DEPTH):
        for at in range(ca.DEPTH - size + 1):
            inside = F.struct(*(F.col(_KEYS[at + i]).alias(k) if i < size else F.lit(0).cast("long").alias(k) for i, k in enumerate(_KEYS)))
            # it ends inside the phrase, and is not the phrase itself
            ends = F.col(_KEYS[at + size - 1]) != 0
            shorter = F.lit(True) if at else F.col(_KEYS[size]) != 0
            parts.append(F.when(ends & shorter, inside))
    return phrases.filter("s3 <> 0").select(F.explode(F.array(*parts)).alias("x"), "f").filter("x is not null").select("x.*", "f")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, top: int = TOP, partitions: int | None = None) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score`` of each language's best phrases."""
    partitions = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = _sample_bounds(docs.select(F.coalesce(lang_col, F.lit("und")).alias("lang"), F.coalesce(text_col, F.lit("")).alias("text")), partitions)
    counts = materialize(sequence_counts(docs, bounds, partitions, text_col, lang_col, min_count), "sequences")
    parts = part_counts(counts, bounds, partitions)
    phrases = counts.filter("s2 <> 0").select(*_KEYS, "lang", F.col("f").alias("a")).join(parts, _KEYS)

    # exact: the product may pass 64 bits
    scores = [F.expr(f"cast(cast({SCALE} as decimal(20, 0)) * cast(a as decimal(18, 0)) div (cast(l{k} as decimal(18, 0)) + r{k}) as bigint)") for k in range(1, ca.DEPTH)]
    cuts = F.array(*(F.when(F.col(f"l{k}").isNotNull(), F.struct(s.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))) for k, s in enumerate(scores, 1)))
    kept = F.col("longer").isNull() | (SHARE[1] * F.col("longer") < SHARE[0] * F.col("a"))
    scored = phrases.filter(kept).withColumn("cut", F.array_min(F.array_compact(cuts))).select(*_KEYS, "lang", "a", "cut.*")

    # ties are settled by the phrase: first all rows that may be among the best, then their words
    near = scored.withColumn("rank", F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))).filter(F.col("rank") <= top).drop("rank")
    near = materialize(near.select("*", F.xxhash64(*_KEYS).alias("phrase_id")), "near_top")
    words = counts.filter("s1 <> 0 and s2 = 0").select(F.col("s1").alias("symbol"), "word")
    spelled = near.select("phrase_id", *_KEYS, F.posexplode(F.filter(F.array(*_KEYS), lambda s: s != 0)).alias("place", "symbol")).join(words, "symbol")
    spelled = spelled.groupBy(*_KEYS).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    totals = counts.filter("s1 = 0").select("lang", F.col("f").alias("n"))
    best = near.join(spelled, _KEYS).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))).filter(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: DuckDB SQL over ``documents``
ORACLE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), starts AS (
  SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w
), grams AS (
  SELECT lang, size, array_to_string(ws[i:i + size - 1], ' ') AS phrase
  FROM starts, (VALUES (1), (2), (3), (4)) AS sizes(size) WHERE i + size - 1 <= len(ws)
), f AS (
  SELECT lang, size, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30
), totals AS (
  SELECT lang, count(*) AS n FROM starts GROUP BY lang
), cand AS (
  SELECT lang, size, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE size >= 2
), cuts AS (
  SELECT lang, size, phrase, a, k, array_to_string(ws[1:k], ' ') AS lp, array_to_string(ws[k + 1:], ' ') AS rp
  FROM (SELECT *, unnest(range(1, size)) AS k FROM cand)
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, l.a AS l, r.a AS r, CAST(2000000::HUGEINT * c.a // (l.a + r.a) AS BIGINT) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = c.lp JOIN f r ON r.lang = c.lang AND r.phrase = c.rp
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), held AS (
  SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, size - m + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS m FROM cand)) GROUP BY ALL
), best AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase) AS rank
  FROM lowest s LEFT JOIN held h ON h.lang = s.lang AND h.phrase = s.phrase
  WHERE h.longer IS NULL OR 100 * h.longer < 80 * s.a
)
SELECT b.lang, b.rank, b.phrase, b.a, b.l, b.r, t.n, b.score FROM best b JOIN totals t ON t.lang = b.lang WHERE b.rank <= 2000
"""
