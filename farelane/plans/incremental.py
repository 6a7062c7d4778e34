"""Preparation stages that only do what is new.

A root folder holds immutable month folders and a log.  A run lists the source
files, compares them with the log and builds, stage by stage, the months whose
input is new or changed; each finished stage adds its months to the log, and at
the end one log row publishes which folder of each stage and month belongs
together.  A log row is one small file that Spark commits, so a reader sees the
old set of folders or the new one, never a mixture, and a run that was ended
between stages finds the finished ones in the log.

A month's input is known by the names, lengths and times of its files.  Where
these differ from the log, checksums of the files decide, so touched files with
the same bytes are not built again.  What a stage did also depends on its
version, its settings and the dimension tables; each is part of the key.

One run at a time writes to a root.  Folders that no published set names any
more are left in place for readers that still use an older set.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.constants import DEFAULT_SEED, FILE_MONTH, SAMPLE_ROWS_PER_MONTH
from farelane.functions.calendar import holiday_calendar
from farelane.ml import preprocess as P
from farelane.operators import sampling, schema
from farelane.plans.jobs import clean_and_build
from farelane.sources.monthly import MONTH_TOKEN

_LOG = "seq long, kind string, stage string, month string, key string, quick string, path string, payload string"
#: raise it when what a stage computes changes
STAGE_VERSIONS = {"features": "1", "splits": "1", "preprocess": "1"}
_ALL = "*"


def _digest(*parts) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()[:20]


def source_files(spark: SparkSession, src_dir: str) -> DataFrame:
    """``file_month``, ``path``, ``length``, ``modified`` of all parquet files below ``src_dir``; nothing is opened.

    The month is the last one named in the path, so flat files, a folder per
    file and hive folders are all understood.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(src_dir)
    months = F.expr(f"regexp_extract_all(path, '{MONTH_TOKEN}', 0)")
    month = F.when(F.size(months) > 0, F.element_at(months, -1)).otherwise(F.raise_error(F.concat(F.lit("no calendar month in "), F.col("path"))))
    return files.select(month.alias(FILE_MONTH), "path", "length", F.col("modificationTime").alias("modified"))


def checksums(spark: SparkSession, paths: Sequence[str]) -> dict[str, int]:
    """CRC-32 of each file, read in tasks (a file may have up to 2 GB)."""
    rows = spark.read.format("binaryFile").load(list(paths)).select("path", F.crc32("content").alias("crc")).collect()  # one row per file
    return {r["path"]: r["crc"] for r in rows}


def table_key(df: DataFrame) -> str:
    """Tells the contents of two small tables apart, whatever the order of their rows."""
    h = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
    return _digest(sorted(df.dtypes), tuple(df.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(F.shiftright(h, 20))).first()))


@dataclass
class Report:
    """What a run did: months built per stage, files read, and the published set."""

    built: dict[str, list[str]] = field(default_factory=dict)
    read_files: list[str] = field(default_factory=list)
    removed: list[str] = field(default_factory=list)
    published: dict = field(default_factory=dict)


class StageLog:
    """Append-only table of finished (stage, month) results and published sets."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.dir = spark, f"{root}/log"
        try:
            rows = spark.read.schema(_LOG).json(self.dir).orderBy("seq").collect()  # one row per stage and month, metadata only
        except AnalysisException:
            rows = []
        self.seq = max((r["seq"] for r in rows), default=0)
        self.done = {(r["stage"], r["month"], r["key"]): r["path"] for r in rows if r["kind"] == "done"}
        self.sources = {r["month"]: (r["quick"], r["key"]) for r in rows if r["kind"] == "source"}
        published = [json.loads(r["payload"]) for r in rows if r["kind"] == "published"]
        self.published: dict = published[-1] if published else {}
        columns = [r["payload"] for r in rows if r["kind"] == "schema"]
        self.schema: str | None = columns[0] if columns else None

    def add(self, rows: Sequence[dict]) -> None:
        """One commit: all rows or none."""
        if not rows:
            return
        names = [c.split()[0] for c in _LOG.split(", ")]
        self.seq += 1
        table = [tuple({"seq": self.seq, **r}.get(n) for n in names) for r in rows]
        self.spark.createDataFrame(table, _LOG).coalesce(1).write.mode("append").json(self.dir)
        for r in rows:
            if r["kind"] == "done":
                self.done[(r["stage"], r["month"], r["key"])] = r["path"]
            elif r["kind"] == "source":
                self.sources[r["month"]] = (r["quick"], r["key"])
            elif r["kind"] == "published":
                self.published = json.loads(r["payload"])
            elif r["kind"] == "schema":
                self.schema = r["payload"]


def _source_keys(spark: SparkSession, log: StageLog, src_dir: str) -> tuple[dict[str, str], dict[str, list[str]]]:
    """(content key, files) of each month; only months that look different from the log are read."""
    files: dict[str, list] = {}
    for r in source_files(spark, src_dir).orderBy("path").collect():  # one row per file, metadata only
        files.setdefault(r[FILE_MONTH], []).append(r)
    quick = {m: _digest([(r["path"], r["length"], str(r["modified"])) for r in rows]) for m, rows in files.items()}
    other = [m for m in sorted(files) if log.sources.get(m, (None,))[0] != quick[m]]
    crc = checksums(spark, [r["path"] for m in other for r in files[m]]) if other else {}
    keys = {m: log.sources[m][1] if m not in other else _digest([(r["path"], r["length"], crc[r["path"]]) for r in files[m]]) for m in files}
    log.add([{"kind": "source", "month": m, "quick": quick[m], "key": keys[m]} for m in other])
    return keys, {m: [r["path"] for r in rows] for m, rows in files.items()}


def _read_months(spark: SparkSession, log: StageLog, files: Mapping[str, Sequence[str]], months: Sequence[str]) -> DataFrame:
    """The months' rows with the columns of the first month ever read."""
    frames = [spark.read.parquet(*files[m]) for m in months]
    if log.schema is None:
        log.add([{"kind": "schema", "payload": frames[0].schema.json()}])
    reference = spark.createDataFrame([], T.StructType.fromJson(json.loads(log.schema)))
    return schema.normalize_columns([reference, *frames], tags={FILE_MONTH: [months[0], *months]})


def _new_folder(root: str, name: str) -> str:
    return f"{root}/{name}/{uuid.uuid4().hex[:12]}"


def _stage(spark: SparkSession, log: StageLog, report: Report, root: str, name: str, keys: Mapping[str, str], empty: set[str], build: Callable[[list[str]], DataFrame]) -> dict[str, str]:
    """Folder of each month, "" for a month without rows.

    Months without a finished result are built in one job and logged together;
    months in ``empty`` have no input rows.
    """
    todo = [m for m in sorted(keys) if (name, m, keys[m]) not in log.done]
    report.built[name] = todo
    folder: dict[str, str] = {}
    if set(todo) - empty:
        out = _new_folder(root, name)
        made = build([m for m in todo if m not in empty]).withColumn("month_dir", F.col(FILE_MONTH))
        made.write.partitionBy("month_dir").parquet(out)
        months = spark.read.schema(made.schema).parquet(out).select(F.col("month_dir").cast("string")).distinct().collect()  # one row per month
        folder = {r[0]: f"{out}/month_dir={r[0]}" for r in months}
    log.add([{"kind": "done", "stage": name, "month": m, "key": keys[m], "path": folder.get(m, "")} for m in todo])
    return {m: log.done[(name, m, keys[m])] for m in keys}


def read_folders(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """The rows of month folders; months without rows have none."""
    present = [f for f in folders if f]
    if not present:
        raise ValueError("no month holds rows")
    return spark.read.parquet(*present)


def read_published(spark: SparkSession, root: str, stage: str, months: Sequence[str] | None = None) -> DataFrame:
    """A stage's rows in the newest published set."""
    folders = StageLog(spark, root).published.get(stage, {})
    return read_folders(spark, [p for m, p in sorted(folders.items()) if months is None or m in months])


def incremental_preprocess_job(
    spark: SparkSession,
    root: str,
    src_dir: str,
    lookup: DataFrame,
    zones: DataFrame | None,
    holidays: DataFrame | None = None,
    sample_rows: Mapping[str, int | None] = SAMPLE_ROWS_PER_MONTH,
    seed: int = DEFAULT_SEED,
    key: str = "trip_id",
    fit: bool = True,
) -> Report:
    """The preparation stages over the months of ``src_dir`` that are new or changed; the rest is taken from ``root``.

    Features and samples depend on one month each; the feature pipeline is
    fitted again when any training month changed.  Months that left the source
    leave the published set.
    """
    holidays = holiday_calendar(spark) if holidays is None else holidays
    log, report = StageLog(spark, root), Report()
    contents, files = _source_keys(spark, log, src_dir)
    report.removed = sorted(set(log.published.get("features", {})) - set(contents))
    dims = [table_key(d) for d in (lookup, zones, holidays) if d is not None]

    def build_features(months: list[str]) -> DataFrame:
        trips = _read_months(spark, log, files, months)
        report.read_files = sorted(f for m in months for f in files[m])
        if key not in trips.columns:
            trips = trips.withColumn(key, F.xxhash64(*[F.col(c) for c in trips.columns]))
        return clean_and_build(trips, lookup, zones, holidays)

    feature_keys = {m: _digest(STAGE_VERSIONS["features"], contents[m], dims) for m in contents}
    features = _stage(spark, log, report, root, "features", feature_keys, set(), build_features)

    def build_splits(months: list[str]) -> DataFrame:
        return sampling.build_splits(read_folders(spark, [features[m] for m in months]), sample_rows, key, seed)

    split_keys = {m: _digest(STAGE_VERSIONS["splits"], feature_keys[m], dict(sample_rows), seed, key) for m in contents}
    splits = _stage(spark, log, report, root, "splits", split_keys, {m for m in contents if not features[m]}, build_splits)
    published: dict = {"features": features, "splits": splits}

    if fit:
        train_months = _train_months(spark, sorted(contents))
        fit_key = _digest(STAGE_VERSIONS["preprocess"], [split_keys[m] for m in train_months])
        report.built["preprocess"] = []
        if ("preprocess", _ALL, fit_key) not in log.done:
            train = read_folders(spark, [splits[m] for m in train_months]).where(F.col("split") == "train")
            path = P.save_preprocess(P.fit_preprocess(P.build_preprocess(), train), _new_folder(root, "preprocess"))
            log.add([{"kind": "done", "stage": "preprocess", "month": _ALL, "key": fit_key, "path": path}])
            report.built["preprocess"] = [_ALL]
        published["preprocess"] = log.done[("preprocess", _ALL, fit_key)]
    if published != log.published:
        log.add([{"kind": "published", "payload": json.dumps(published, sort_keys=True)}])
    report.published = published
    return report


def _train_months(spark: SparkSession, months: Sequence[str]) -> list[str]:
    if not months:
        return []
    rows = sampling.assign_split(spark.createDataFrame([(m,) for m in months], f"{FILE_MONTH} string")).filter("split = 'train'").collect()
    return sorted(r[FILE_MONTH] for r in rows)
