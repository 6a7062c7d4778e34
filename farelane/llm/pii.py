"""Operator 2 - personal data by bootstrapped contextual extraction, with DataFrame functions only.

Four exact patterns give the base spans (email, ip, card, phone).  They are
the seeds of a bootstrap: loosely shaped candidates are read with the words
next to them, the lexical contexts are patterns, and Spark scores the
pattern-instance graph in rounds.  A pattern's confidence in a kind weighs its
different instances: seeds and, by their score, found ones speak for it,
instances of other kinds or of a shape that the kind cannot have speak against
it, and instances that are not known yet count ``DOUBT`` against it.  An
instance's score is the noisy-or of its patterns.  Instances that reach
``MIN_SCORE`` support patterns as seeds do in the next round, so contexts that
hold no seed are reached through found instances.  Those with a shape the kind
can have are added as spans.  Base spans always stay, and added ones never overlap them.

Spans count code points, ends are exclusive.  The scan writes only matches and
gap lengths; positions are running sums per row and kind.

Defined results: a null text counts as empty and has no spans; every input row
gives one output row, repeated rows and null ids included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelane.llm.frames import materialize

KINDS = ("email", "ip", "card", "phone")
#: what a text must hold for a kind to be looked for at all
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
# Possessive and anchored forms of the patterns of the contract, with the same leftmost matches in linear time: a match
# cannot begin inside a run of characters whose first position has failed, except right after another match (\G).
LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
CANDIDATE = (
    rf"(?:(?<!{LOCAL})|\G){LOCAL}++(?:@| ?[\[(]at[\])] ?)[A-Za-z0-9-]++(?:(?:\.| ?[\[(]dot[\])] ?)[A-Za-z0-9-]++)*+"
    r"|(?<![A-Za-z0-9])[+(]?[0-9][0-9 ().:/-]{4,}[0-9](?![A-Za-z0-9])"
)
CONTEXT_CHARS = 48
ROUNDS = 3
MIN_SEEDS = 3
MIN_CONFIDENCE = 0.8
MIN_SCORE = 0.8
#: weight of an instance that could be of a kind and is not known yet, against a pattern's confidence in the kind
DOUBT = 0.15


def _digits(c) -> F.Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: F.Column) -> F.Column:
    """Whether a digit string passes the Luhn check."""
    back = F.reverse(digits)

    def term(i):
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda acc, i: acc + term(i)) % 10 == 0


def valid(kind: str, match: F.Column) -> F.Column:
    """Whether a match of a kind's pattern is one."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        def small(part):
            bare = F.regexp_replace(part, "^0+", "")
            return F.when(F.length(bare) > 3, False).otherwise(F.coalesce(bare.try_cast("int"), F.lit(0)) <= 255)

        return F.forall(F.split(match, r"\.", -1), small)
    n = F.length(_digits(match))
    if kind == "card":
        return F.when((n >= 14) & (n <= 19), luhn(_digits(match))).otherwise(False)
    return (n >= 10) & (n <= 15)


def possible(kind: str, value: F.Column) -> F.Column:
    """Whether a candidate has a shape that the kind can have."""
    n = F.length(_digits(value))
    if kind == "email":
        return value.rlike(r"(?i)@|[\[(]at[\])]")
    plain = ~value.rlike(r"@|(?i)[\[(]at[\])]")
    if kind == "ip":
        return plain & value.rlike(r"^[0-9]{1,3}(?:[.:][0-9]{1,3}){3}$")
    if kind == "card":
        return plain & (n >= 12) & (n <= 19) & value.rlike(r"^[0-9][0-9 -]*[0-9]$")
    date = value.rlike(r"^(?:[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4})$")
    return plain & ~date & (n >= 7) & (n <= 15) & value.rlike(r"^[+(]?[0-9][0-9 ()./-]*[0-9]$")


def _found(text: F.Column, pattern: str, needs: F.Column) -> tuple[F.Column, F.Column]:
    """(matches, texts between them) of a pattern; there is one more gap than there are matches."""
    none = F.array().cast("array<string>")
    return (
        F.when(needs, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none),
        F.when(needs, F.split(text, pattern, -1)).otherwise(none),
    )


def _scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """rid, id, and per kind the matches and gap lengths; of the candidates also the words next to them."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    src = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"), text.alias("text"))
    digit = F.col("text").rlike("[0-9]")
    out = []
    for kind in KINDS:
        needs = digit if kind != "email" else F.lit(True)
        if NEEDS[kind]:
            needs = needs & F.contains("text", F.lit(NEEDS[kind]))
        found, gaps = _found(F.col("text"), PATTERNS[kind], needs)
        out.append(F.arrays_zip(found.alias("m"), F.transform(gaps, lambda g: F.length(g)).alias("g")).alias(kind))
    some = digit | F.contains("text", F.lit("@")) | F.col("text").rlike(r"[\[(]at[\])]")
    found, gaps = _found(F.col("text"), CANDIDATE, some)
    near = F.transform(
        gaps,
        lambda g: F.struct(
            F.length(g).alias("n"),
            F.regexp_extract_all(F.lower(F.substring(g, -CONTEXT_CHARS, CONTEXT_CHARS)), F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"), F.lit(0)).alias("left"),
            F.regexp_extract_all(F.lower(F.substring(g, 1, CONTEXT_CHARS)), F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"), F.lit(0)).alias("right"),
        ),
    )
    after = F.slice(near, 2, F.size(found))
    out.append(F.arrays_zip(found.alias("m"), near.alias("before"), after.alias("after")).alias("candidate"))
    return src.select("rid", "id", *out)


def _base(rows: DataFrame) -> DataFrame:
    """rid, kind, place (of the kind), start, end of the base spans."""
    parts = []
    for i, kind in enumerate(KINDS):
        each = rows.select("rid", F.lit(kind).alias("kind"), F.lit(i).alias("place"), F.posexplode(kind).alias("i", "x"))
        parts.append(each.filter(F.col("x.m").isNotNull()).select("rid", "kind", "place", "i", F.col("x.m").alias("m"), F.col("x.g").alias("g")))
    every = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    w = Window.partitionBy("rid", "place").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("g") + F.length("m")).over(w)
    spans = every.select("rid", "kind", "place", "m", end.alias("end")).withColumn("start", F.col("end") - F.length("m"))
    ok = F.lit(False)
    for kind in KINDS:
        ok = ok | ((F.col("kind") == kind) & valid(kind, F.col("m")))
    return spans.filter(ok).select("rid", "kind", "place", "start", "end")


def _candidates(rows: DataFrame) -> DataFrame:
    """rid, start, end, value, seed (the kind of a value that the base patterns accept) and patterns."""
    each = rows.select("rid", F.posexplode("candidate").alias("i", "x")).filter(F.col("x.m").isNotNull())
    each = each.select("rid", "i", F.col("x.m").alias("m"), F.col("x.before").alias("b"), F.col("x.after").alias("a"))
    w = Window.partitionBy("rid").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("b.n") + F.length("m")).over(w)
    whole = {k: rf"^(?:{PATTERNS[k]})$" for k in KINDS}
    seed = F.lit(None).cast("string")
    for kind in reversed(KINDS):
        seed = F.when(F.col("m").rlike(whole[kind]) & valid(kind, F.col("m")), F.lit(kind)).otherwise(seed)
    left, right = F.col("b.left"), F.col("a.right")
    one, two, nxt = F.try_element_at(left, F.lit(-1)), F.try_element_at(left, F.lit(-2)), F.try_element_at(right, F.lit(1))
    patterns = F.array_compact(
        F.array(
            F.concat(F.lit("L "), one),
            F.concat(F.lit("LL "), two, F.lit(" "), one),
            F.concat(F.lit("R "), nxt),
            F.concat(F.lit("LR "), one, F.lit(" _ "), nxt),
        )
    )
    value = F.lower(F.regexp_replace("m", r"[\s().-]", ""))
    return each.select("rid", "i", "m", (end - F.length("m")).alias("start"), end.alias("end"), value.alias("value"), seed.alias("seed"), patterns.alias("patterns"))


def _scores(found: DataFrame, rounds: int, min_seeds: int, min_confidence: float, min_score: float = MIN_SCORE) -> DataFrame:
    """value, kind, score of the instances that are no seeds."""
    about = [F.max(F.coalesce(F.col("seed") == k, F.lit(False))).alias(f"seed_{k}") for k in KINDS]
    about += [F.max(possible(k, F.col("m"))).alias(f"can_{k}") for k in KINDS]
    facts = found.groupBy("value").agg(*about, F.max(F.col("seed").isNotNull()).alias("known"))
    links = found.select("value", F.explode("patterns").alias("pattern")).distinct()
    edges = materialize(links.join(facts, "value"), "pii_edges")
    unknown = edges.filter(~F.col("known")).select("value", "pattern", *[f"can_{k}" for k in KINDS])
    scores = None
    for _ in range(rounds):
        every = edges
        if scores is not None:
            wide = scores.groupBy("value").agg(*[F.max(F.when(F.col("kind") == k, F.col("score"))).alias(f"score_{k}") for k in KINDS])
            every = edges.join(wide, "value", "left")
        sums = []
        for k in KINDS:
            seed, can = F.col(f"seed_{k}"), F.col(f"can_{k}")
            score = F.coalesce(F.col(f"score_{k}"), F.lit(0.0)) if scores is not None else F.lit(0.0)
            score = F.when(seed, 1.0).when(F.col("known") | ~can, 0.0).otherwise(score)
            against = F.when(seed, 0.0).when(F.col("known") | ~can, 1.0).otherwise(DOUBT * (1 - score))
            sums.append(F.struct(F.lit(k).alias("kind"), F.sum(score).alias("mass"), F.sum(against).alias("against"), F.sum((score >= min_score).cast("int")).alias("support")))
        judged = every.groupBy("pattern").agg(F.array(*sums).alias("kinds")).select("pattern", F.inline("kinds"))
        judged = judged.withColumn("confidence", F.col("mass") / (F.col("mass") + F.col("against") + 1))
        trusted = judged.filter((F.col("support") >= min_seeds) & (F.col("confidence") >= min_confidence)).select("pattern", "kind", "confidence")
        doubt = F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9))))
        fits = F.lit(False)
        for k in KINDS:
            fits = fits | ((F.col("kind") == k) & F.col(f"can_{k}"))
        scores = unknown.join(trusted, "pattern").filter(fits).groupBy("value", "kind").agg((1 - F.exp(doubt)).alias("score"))
        scores = materialize(scores, "pii_scores")
    return scores


def spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = ROUNDS,
    min_seeds: int = MIN_SEEDS,
    min_confidence: float = MIN_CONFIDENCE,
    min_score: float = MIN_SCORE,
) -> tuple[DataFrame, DataFrame]:
    """(rows: ``rid`` and ``id`` of every input row; spans: ``rid``, ``kind``, ``place``, ``start``, ``end``, ``added``)."""
    rows = materialize(_scan(docs, id_col, text_col), "pii_rows")
    base = materialize(_base(rows), "pii_base")
    found = materialize(_candidates(rows), "pii_candidates")
    scores = _scores(found, rounds, min_seeds, min_confidence, min_score).filter(F.col("score") >= min_score)
    new = found.filter(F.col("seed").isNull()).join(scores, "value")
    fits = F.lit(False)
    place = F.lit(0)
    for i, kind in enumerate(KINDS):
        fits = fits | ((F.col("kind") == kind) & possible(kind, F.col("m")))
        place = F.when(F.col("kind") == kind, i).otherwise(place)
    new = new.filter(fits).groupBy("rid", "start", "end").agg(F.max(F.struct("score", "kind")).alias("k"))
    new = new.select("rid", F.col("k.kind").alias("kind"), "start", "end").withColumn("place", place)
    over = base.select(F.col("rid").alias("r2"), F.col("start").alias("s2"), F.col("end").alias("e2"))
    new = new.join(over, (F.col("rid") == F.col("r2")) & (F.col("start") < F.col("e2")) & (F.col("s2") < F.col("end")), "left_anti")
    columns = ["rid", "kind", "place", "start", "end"]
    every = base.select(*columns, F.lit(False).alias("added")).union(new.select(*columns, F.lit(True).alias("added")))
    return rows.select("rid", "id"), every


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per input row: ``id_col``, the number of base spans of each kind, ``base`` and ``spans`` (``kind:start:end``, comma-joined)."""
    rows, found = spans(docs, id_col, text_col, **options)
    name = F.concat_ws(":", "kind", "start", "end")
    entry = F.struct("start", "place", "end", name.alias("name"))

    def joined(c):
        return F.array_join(F.transform(F.sort_array(c), lambda s: s["name"]), ",")

    per_row = found.groupBy("rid").agg(
        *[F.sum(F.when((F.col("kind") == k) & ~F.col("added"), 1).otherwise(0)).alias(f"n_{k}") for k in KINDS],
        F.sum(F.col("added").cast("int")).alias("n_added"),
        joined(F.collect_list(F.when(~F.col("added"), entry))).alias("base"),
        joined(F.collect_list(entry)).alias("spans"),
    )
    out = rows.join(per_row, "rid", "left")
    counts = [F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in (*KINDS, "added")]
    return out.select(F.col("id").alias(id_col), *counts, F.coalesce("base", F.lit("")).alias("base"), F.coalesce("spans", F.lit("")).alias("spans"))
