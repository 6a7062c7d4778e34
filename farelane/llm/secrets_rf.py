"""Operator 3 - secret scanning with a random forest against false positives, with DataFrame and Spark ML functions only.

Every long token of a text is a candidate, and so is a shorter value, or one
with other symbols, that is assigned to a secret-like name.  A random forest judges it by its
length, character transitions and classes, dictionary coverage (letters that
belong to words the corpus uses often enough), the path it comes from and the
words next to it.  It is trained from labelled findings: a table given by the
caller, or ``rule_labels``, which labels what is certain either way (vendor
prefixes and quoted assignments to secret-like names; plain words, numbers,
host names).  Only the training rows are bounded, by ``max_rows`` in the order
of a hash; the dictionary and the candidates cover all documents.

Defined results: a null text has no candidates; repeated rows give repeated
findings; without labels of both kinds the forest is skipped and the
probability is that of the rules (0.5 where they say nothing).
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.llm.frames import materialize

SECRET_NAME = r"(?:secret|token|passw(?:or)?d|passwd|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth|credential|bearer)"
#: a value that follows a secret-like name, of any characters when it is quoted; looked for only right after : or =
ASSIGNED = (
    r"(?<=[:= \t\"'])(?<=[:=][ \t]{0,4}[\"']?)(?<=(?i:%s)[\"']?[ \t]{0,4}[:=][ \t]{0,4}[\"']?)(?![A-Za-z][A-Za-z0-9+.-]{0,20}+://)"
    r"(?:(?<=\")[^\s\"]{4,}+(?=\")|(?<=')[^\s']{4,}+(?=')|[^\s\"'&;,<>()]{4,}+)" % SECRET_NAME
)
#: a long token anywhere; a name or a padded value ends before a further =
CANDIDATE = ASSIGNED + r"|(?<![A-Za-z0-9+/_.-])[A-Za-z0-9+/_.-]{16,}={0,2}(?![A-Za-z0-9+/_-])"
CERTAIN = r"^(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk[-_](?:live_)?[A-Za-z0-9]{24,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[0-9A-Za-z_-]{35}|eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}.*)$"
CONTEXT_CHARS = 40
MIN_WORD_COUNT = 5
MAX_TRAIN_ROWS = 20_000
TREES, DEPTH = 40, 8
LEFT_BUCKETS, RIGHT_BUCKETS, PATH_BUCKETS = 16, 8, 8
THRESHOLD = 0.5


def _candidates(docs: DataFrame, id_col: str, text_col: str, path_col: str | None) -> DataFrame:
    """rid, id, path, at (running number in the text), start, token, before, after of every candidate."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")
    src = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"), path.alias("path"), text.alias("text"))
    # columns of their own: inside the generator or its functions of elements the patterns would be matched again and again
    src = src.select("rid", "id", "path", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("found"), F.split("text", CANDIDATE, -1).alias("gaps"))
    src = src.filter(F.size("found") > 0)
    found = F.col("found")
    near = F.transform(
        "gaps",
        # a name before the value may be a candidate itself, so what goes before a value includes the candidate in front of it
        lambda g, i: F.struct(
            F.length(g).alias("n"),
            F.right(F.concat(F.coalesce(F.right(F.get(found, i - 1), F.lit(CONTEXT_CHARS)), F.lit("")), F.right(g, F.lit(CONTEXT_CHARS))), F.lit(CONTEXT_CHARS)).alias("before"),
            F.substring(g, 1, CONTEXT_CHARS).alias("after"),
        ),
    )
    zipped = F.arrays_zip(found.alias("token"), near.alias("gap"), F.slice(near, 2, F.size(found)).alias("next"))
    each = src.select("rid", "id", "path", F.posexplode(zipped).alias("at", "x")).filter(F.col("x.token").isNotNull())
    each = each.select("rid", "id", "path", "at", F.col("x.token").alias("token"), F.col("x.gap.n").alias("n"), F.col("x.gap.before").alias("before"), F.col("x.next.after").alias("after"))
    return materialize(each, "secret_candidates")


def _starts(each: DataFrame) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("rid").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("n") + F.length("token")).over(w)
    return each.withColumn("start", (end - F.length("token")).cast("long")).drop("n")


def _dictionary(docs: DataFrame, text_col: str, tokens: DataFrame, min_count: int) -> DataFrame:
    """word of the candidates' letter runs that occur at least ``min_count`` times as words of the corpus."""
    parts = tokens.select(F.explode(F.regexp_extract_all(F.lower("token"), F.lit("[a-z]{3,}"), F.lit(0))).alias("word")).distinct()
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(r"(?<![\p{L}\p{N}])[a-z]{3,}(?![\p{L}\p{N}])"), F.lit(0))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count).join(parts, "word").select("word")


def _features(each: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The candidates with one numeric column per feature."""
    tokens = each.select("token").distinct()
    runs = tokens.select("token", F.explode(F.regexp_extract_all(F.lower("token"), F.lit("[a-z]{3,}"), F.lit(0))).alias("word"))
    covered = runs.join(dictionary, "word").groupBy("token").agg(F.sum(F.length("word")).alias("covered"))
    t = F.col("token")
    n = F.length(t)

    def share(cls: str) -> F.Column:
        return F.length(F.regexp_replace(t, f"[^{cls}]", "")) / n

    shape = tokens.join(covered, "token", "left").select(
        "token",
        n.cast("double").alias("f_length"),
        ((F.size(F.regexp_extract_all(t, F.lit("[a-z]+|[A-Z]+|[0-9]+|[^a-zA-Z0-9]+"), F.lit(0))) - 1) / n).alias("f_transitions"),
        (F.size(F.array_distinct(F.split(t, ""))) / n).alias("f_distinct"),
        share("0-9").alias("f_digits"),
        share("A-Z").alias("f_upper"),
        share("a-z").alias("f_lower"),
        share("aeiouAEIOU").alias("f_vowels"),
        share("0-9a-fA-F").alias("f_hex"),
        (F.coalesce("covered", F.lit(0)) / n).alias("f_dictionary"),
    )
    left = F.regexp_extract(F.lower("before"), r"([\p{L}\p{N}_]+)[^\p{L}\p{N}_]*$", 1)
    right = F.regexp_extract(F.lower("after"), r"^[^\p{L}\p{N}_]*([\p{L}\p{N}_]+)", 1)

    def bucket(c, size):
        return F.pmod(F.xxhash64(c), F.lit(size)).cast("int")

    hot = [(F.col("__l") == i).cast("double").alias(f"f_left{i}") for i in range(LEFT_BUCKETS)]
    hot += [(F.col("__r") == i).cast("double").alias(f"f_right{i}") for i in range(RIGHT_BUCKETS)]
    hot += [(F.col("__p") == i).cast("double").alias(f"f_path{i}") for i in range(PATH_BUCKETS)]
    near = each.withColumn("__l", bucket(left, LEFT_BUCKETS)).withColumn("__r", bucket(right, RIGHT_BUCKETS)).withColumn("__p", bucket("path", PATH_BUCKETS))
    near = near.select(
        *each.columns,
        *hot,
        F.lower("before").rlike(rf"{SECRET_NAME}[\"' ]*$|{SECRET_NAME}[\"']?\s*[:=]\s*[\"']?$").cast("double").alias("f_name"),
        F.col("before").rlike(r"[:=]\s*[\"']?$").cast("double").alias("f_assigned"),
        F.col("before").rlike(r"[\"']$").cast("double").alias("f_quoted"),
    )
    return near.join(shape, "token")


def rule_labels(candidates: DataFrame) -> DataFrame:
    """``label``: 1 for certain secrets, 0 for certain false positives, null otherwise."""
    t = F.col("token")
    named = F.lower("before").rlike(rf"{SECRET_NAME}[\"']?\s*[:=]\s*[\"']?$") & t.rlike("[0-9]") & t.rlike("[A-Za-z]")
    plain = t.rlike(r"^[A-Za-z]+[.-]*$|^[0-9.-]+$|(?i)\.(?:com|org|net|example)\b") | t.rlike(r"^[A-Za-z]+(?:[-_./][A-Za-z]+)+[.-]*$")
    return candidates.withColumn("label", F.when(t.rlike(CERTAIN) | named, 1.0).when(plain, 0.0))


def train(labelled: DataFrame, max_rows: int = MAX_TRAIN_ROWS, trees: int = TREES, depth: int = DEPTH) -> PipelineModel | None:
    """A forest over the ``f_`` columns from rows with ``label`` 0 or 1; None unless both occur.

    At most ``max_rows`` rows of either label are used, the first by a hash of the token.
    """
    names = [c for c in labelled.columns if c.startswith("f_")]
    order = F.xxhash64("token", "rid", "at")
    parts = [labelled.filter(F.col("label") == x).orderBy(order).limit(max_rows) for x in (0.0, 1.0)]
    rows = materialize(parts[0].unionByName(parts[1]).select(*names, "label"), "secret_training")
    if rows.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=3, featuresCol="features", labelCol="label")
    model = Pipeline(stages=[VectorAssembler(inputCols=names, outputCol="features"), forest]).fit(rows)
    # the summary of the fit holds the session, which cannot go to tasks once any query of it has been observed
    jvm = rows.sparkSession.sparkContext._jvm
    model.stages[-1]._java_obj.setSummary(getattr(getattr(jvm.scala, "None$"), "MODULE$"))
    return model


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_col: str | None = "source",
    findings: DataFrame | None = None,
    max_rows: int = MAX_TRAIN_ROWS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """All candidates: ``id_col``, ``start``, ``end``, ``token``, ``probability``, ``is_secret``.

    ``findings`` (``token``, ``label`` 0 or 1) replaces the rules' labels.
    """
    each = _candidates(docs, id_col, text_col, path_col)
    dictionary = materialize(_dictionary(docs, text_col, each.select("token"), MIN_WORD_COUNT), "secret_dictionary")
    table = rule_labels(_features(_starts(each), dictionary))
    if findings is not None:
        given = findings.groupBy("token").agg(F.max(F.col("label").cast("double")).alias("given"))
        table = table.drop("label").join(given, "token", "left").withColumnRenamed("given", "label")
    table = materialize(table, "secret_features")
    model = train(table.filter(F.col("label").isNotNull()), max_rows)
    if model is None:
        judged = table.withColumn("probability", F.coalesce("label", F.lit(0.5)))
    else:
        judged = model.transform(table).withColumn("p", vector_to_array("probability")[1]).drop("probability").withColumnRenamed("p", "probability")
    end = F.col("start") + F.length("token")
    return judged.select(F.col("id").alias(id_col), "start", end.alias("end"), "token", "probability", (F.col("probability") >= threshold).alias("is_secret"))
