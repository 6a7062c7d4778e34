"""Operator 10 - quality rules, line first.

Every line is judged on its own (punctuation, symbols, shouting, navigation,
repetition, boilerplate phrases), menus of one entry a line by the run of such lines; failing lines are removed; a document that
loses too large a share of its text is rejected.  Everything is computed over
whole texts, one pass, no shuffle.

Defined results: a null text counts as empty; a text without words has zero
counts and is rejected (fewer than ``min_words`` words); repeated input rows
give repeated output rows; an input column with the name of an output column
is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.llm import textbytes as tb
from farelane.llm.frames import add_columns

SYMBOLS = b"#*$%&|<>"
SEPARATORS = b"|>"
#: ends of sentences, and the closing marks that may follow, as whole characters
TERMINAL = ".!?:;\"')]}…”“’‘»«›‹。．！？：；）」』】》、；؟۔।॥։;།።។။"
#: Thai and Lao end sentences with a space; a line that ends in them has no open end
UNMARKED = (0x0E00, 0x0EFF)
#: marks that stand alone between the entries of a menu or a path
_DIVIDERS = np.array(sorted(int.from_bytes(c.encode(), "big") for c in "|>/»›·•→–—-"))
_TERMINAL = np.array(sorted({int.from_bytes(c.encode(), "big") for c in [*TERMINAL, *map(chr, range(UNMARKED[0], UNMARKED[1] + 1))]}))
BOILERPLATE = (
    b"all rights reserved",
    b"privacy policy",
    b"terms of use",
    b"terms of service",
    b"cookie policy",
    b"accept cookies",
    b"enable javascript",
    b"lorem ipsum",
    b"licensed under",
    b"click here",
    b"subscribe to",
    b"share this",
    b"powered by",
    b"copyright (c)",
)


#: ASCII punctuation between and after words, and the first bytes of characters of three and four bytes
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[list(b".,;:!?()\"")] = True
_PUNCTUATION[0xE0:] = True


@dataclass(frozen=True)
class Rules:
    """Thresholds of the line rules and of the document rule; shares are per word of the line."""

    min_words: int = 10
    max_repeat_percent: int = 20
    max_symbols: float = 0.5
    max_separators: float = 0.3
    max_exclamations: float = 0.3
    max_upper: float = 0.8
    upper_from_words: int = 5
    min_distinct: float = 0.25
    distinct_from_words: int = 12
    max_adjacent: float = 0.3
    adjacent_from_words: int = 8
    end_from_words: int = 40
    #: a line of at least so many words without any punctuation has no sentence structure
    plain_from_words: int = 25
    #: entries of a menu line between marks such as dots and arrows, and of a menu with one entry a line
    menu_separators: int = 3
    menu_entry_words: int = 4
    menu_run_lines: int = 6
    menu_line_words: int = 3
    boilerplate_words: int = 30
    max_lost: float = 0.45


def _line_spans(raw: np.ndarray, offsets: np.ndarray):
    """Starts, ends and rows of the \\n-separated lines; an empty text has one empty line."""
    cuts = np.flatnonzero(raw == 0x0A)
    starts = np.sort(np.concatenate([offsets[:-1], cuts + 1]), kind="stable")
    ends = np.sort(np.concatenate([cuts, offsets[1:]]), kind="stable")
    per = 1 + np.searchsorted(cuts, offsets[1:]) - np.searchsorted(cuts, offsets[:-1])
    return starts, ends, np.repeat(np.arange(len(per)), per), tb.prefix(per)


def _group(raw: np.ndarray, offsets: np.ndarray, rules: Rules) -> dict[str, np.ndarray]:
    n_rows = len(offsets) - 1
    _, starts, ends, hashes, first = tb.words(raw, offsets, tb.NOT_SPACE, lower=False)
    counts = np.diff(first)
    word_row = np.repeat(np.arange(n_rows), counts)
    point = tb.prefix(tb.code_points(raw))
    chars = point[ends] - point[starts]
    char_sum = tb.prefix(chars)

    flag = np.zeros(256, bool)
    flag[list(SYMBOLS)] = True
    symbol = tb.prefix(flag[raw])

    # windows of five words found twice or more in their text
    at, row, sh = tb.shingles(hashes, first, 5)
    key = tb.per_row(sh, row)
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    again = at[twice]
    edge = np.bincount(again, minlength=len(hashes) + 1) - np.bincount(np.minimum(again + 5, len(hashes)), minlength=len(hashes) + 1)
    repeated = tb.prefix(np.cumsum(edge[:-1]) > 0)

    # lines
    ls, le, line_row, line_first = _line_spans(raw, offsets)
    w0, w1 = np.searchsorted(starts, ls), np.searchsorted(starts, le)
    line_words = w1 - w0
    filled = np.flatnonzero(line_words)
    key = tb.per_row(tb.span_hashes(raw, ls, le)[filled], line_row[filled])
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(filled), bool)
    same[order[1:]] = key[order][1:] == key[order][:-1]
    dup = np.bincount(line_row[filled][same], minlength=n_rows)

    fails = _failing_lines(raw, ls, le, w0, w1, starts, ends, hashes, symbol, line_row, rules)
    line_chars = char_sum[w1] - char_sum[w0]
    lost = np.bincount(line_row, weights=np.where(fails, line_chars, 0), minlength=n_rows)
    word_chars = char_sum[first[1:]] - char_sum[first[:-1]]
    n_repeat = repeated[first[1:]] - repeated[first[:-1]]
    base_failed = (counts < rules.min_words) | (100 * n_repeat > rules.max_repeat_percent * counts)
    return {
        "n_words": counts,
        "word_chars": word_chars,
        "n_symbols": symbol[offsets[1:]] - symbol[offsets[:-1]],
        "n_dup_lines": dup,
        "n_repeat_words": n_repeat,
        "n_lines": np.diff(line_first),
        "n_failed_lines": np.bincount(line_row[fails], minlength=n_rows),
        "lost_chars": lost.astype(np.int64),
        "base_failed": base_failed,
        "kept": ~base_failed & (lost <= rules.max_lost * word_chars),
        "lines": (ls, le, line_first, fails),
    }


def _failing_lines(raw, ls, le, w0, w1, starts, ends, hashes, symbol, line_row, rules: Rules) -> np.ndarray:
    """True for each line that fails a rule; lines without words never fail (they hold no text)."""
    n = w1 - w0
    share = np.maximum(n, 1)
    full = n > 0

    def count(table: np.ndarray) -> np.ndarray:
        p = tb.prefix(table[raw])
        return p[le] - p[ls]

    symbols = symbol[le] - symbol[ls]
    seps = count(tb.byte_set(*SEPARATORS))
    shouts = count(tb.byte_set(ord("!")))
    upper, lower = count(tb.byte_set((65, 90))), count(tb.byte_set((97, 122)))

    different = _distinct(np.repeat(np.arange(len(ls)), n), hashes, len(ls))

    equal = np.zeros(len(hashes) + 1, bool)
    equal[1:-1] = hashes[1:] == hashes[:-1]
    equal[w0[full]] = False  # the first word of a line follows none
    equal = tb.prefix(equal[: len(hashes)])
    twice = equal[w1] - equal[w0]

    open_end = ~np.isin(_last_character(raw, ls, le), _TERMINAL)

    fails = symbols > rules.max_symbols * share
    fails |= seps > rules.max_separators * share
    fails |= shouts > rules.max_exclamations * share
    fails |= (n >= rules.upper_from_words) & (upper > rules.max_upper * (upper + lower))
    fails |= (n >= rules.distinct_from_words) & (different < rules.min_distinct * n)
    fails |= (n >= rules.adjacent_from_words) & (twice > rules.max_adjacent * n)
    fails |= (n >= rules.end_from_words) & open_end
    # no punctuation at all; letters of three and four bytes may hide marks of other scripts, so lines with them are left to the rule above
    marks = count(_PUNCTUATION)
    fails |= (n >= rules.plain_from_words) & open_end & (marks == 0)
    dividers = tb.prefix(np.isin(_short_words(raw, starts, ends), _DIVIDERS))
    dividers = dividers[w1] - dividers[w0]
    fails |= (dividers >= rules.menu_separators) & (n - dividers <= rules.menu_entry_words * (dividers + 1))
    fails |= _menu_runs(raw, starts, w0, n, open_end, line_row, rules)
    hits = _phrases(tb.LOWER[raw].tobytes())
    phrase = np.searchsorted(hits, le) > np.searchsorted(hits, ls)
    fails |= phrase & (n <= rules.boilerplate_words)
    return fails & full


def _short_words(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The bytes of each word of at most three, as one number; 0 for longer ones."""
    out = np.zeros(len(starts), np.int64)
    size = ends - starts
    for k in range(3):
        more = (size <= 3) & (size > k)
        out[more] = (out[more] << 8) | raw[starts[more] + k]
    return out


def _menu_runs(raw, starts, w0, n, open_end, line_row, rules: Rules) -> np.ndarray:
    """True for lines in runs of short title-like ones; lines without words do not end a run."""
    out = np.zeros(len(n), bool)
    full = np.flatnonzero(n)
    if not len(full):
        return out
    head = raw[starts[w0[full]]]
    entry = (n[full] <= rules.menu_line_words) & open_end[full] & ((head >= 65) & (head <= 90) | (head >= 0xC3))
    change = np.ones(len(full), bool)
    change[1:] = (entry[1:] != entry[:-1]) | (line_row[full][1:] != line_row[full][:-1])
    run = np.cumsum(change) - 1
    out[full] = entry & (np.bincount(run)[run] >= rules.menu_run_lines)
    return out


def _phrases(text: bytes) -> np.ndarray:
    """Sorted places of the boilerplate phrases."""
    found = []
    for phrase in BOILERPLATE:
        i = text.find(phrase)
        while i >= 0:
            found.append(i)
            i = text.find(phrase, i + 1)
    return np.array(sorted(found), np.int64)


def _distinct(line_of: np.ndarray, hashes: np.ndarray, n_lines: int) -> np.ndarray:
    """Number of different words of each line."""
    key = tb.per_row(hashes, line_of)
    order = np.argsort(key)
    new = np.ones(len(key), bool)
    new[1:] = key[order][1:] != key[order][:-1]
    return np.bincount(line_of[order][new], minlength=n_lines)


def _last_character(raw: np.ndarray, ls: np.ndarray, le: np.ndarray) -> np.ndarray:
    """The UTF-8 bytes, as one number, of each line's last character that is no white space (0 if there is none)."""
    solid = np.flatnonzero(tb.NOT_SPACE[raw])
    if not len(solid):
        return np.zeros(len(ls), np.int64)
    i = np.searchsorted(solid, le) - 1
    at = solid[np.maximum(i, 0)]
    out = np.zeros(len(ls), np.int64)
    more = (i >= 0) & (at >= ls)
    for k in range(4):  # from the last byte back to the first one of the character
        byte = raw[np.maximum(at - k, 0)].astype(np.int64)
        out[more] |= byte[more] << (8 * k)
        more = more & (byte >= 0x80) & (byte < 0xC0)
    return out


def _cleaned(raw: np.ndarray, offsets: np.ndarray, spans) -> list[str]:
    ls, le, line_first, fails = spans
    texts = []
    for r in range(len(offsets) - 1):
        lo, hi = line_first[r], line_first[r + 1]
        if not fails[lo:hi].any():
            texts.append(raw[offsets[r] : offsets[r + 1]].tobytes().decode("utf-8", "replace"))
        else:
            texts.append(b"\n".join(raw[ls[i] : le[i]].tobytes() for i in range(lo, hi) if not fails[i]).decode("utf-8", "replace"))
    return texts


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_failed_lines", "lost_chars")


def judge(docs: DataFrame, rules: Rules = Rules(), text_col: str = "text", clean_col: str | None = None) -> DataFrame:
    """``docs`` with the counts, ``base_failed``, ``kept`` and, in ``clean_col``, the text without its failing lines."""
    fields = [(c, T.LongType(), pa.int64()) for c in COUNTS]
    fields += [(c, T.BooleanType(), pa.bool_()) for c in ("base_failed", "kept")]
    if clean_col:
        fields.append((clean_col, T.StringType(), pa.string()))

    def run(batch):
        for lo, hi, raw, off in tb.text_groups(batch, text_col):
            g = _group(raw, off, rules)
            out = [g[c] for c in (*COUNTS, "base_failed", "kept")]
            yield lo, hi, out + ([_cleaned(raw, off, g["lines"])] if clean_col else [])

    return add_columns(docs, fields, run)


def filter_documents(docs: DataFrame, rules: Rules = Rules(), text_col: str = "text") -> DataFrame:
    """The documents that pass, without their failing lines, in the columns of ``docs``.

    ``n_chars``, where the table has it, is the new length of the text.
    """
    bare = docs.withColumn("__original", F.col(text_col))
    out = judge(bare, rules, "__original", clean_col=text_col).filter("kept")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
