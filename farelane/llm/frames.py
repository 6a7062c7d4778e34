"""Small DataFrame helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.sources.sinks import materialize, shared_dir

__all__ = ["add_columns", "arrow_map", "discard", "materialize", "read_table", "shared_dir", "with_key"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_key(df: DataFrame, key: str) -> DataFrame:
    """A key for each row.  It is only stable once written, so callers materialise the result."""
    return df.withColumn(key, F.monotonically_increasing_id())


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote.

    Only for tables whose readers have all been written themselves, so that a
    lost executor never needs them again.
    """
    for table in tables:
        sc = table.sparkSession.sparkContext
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = sc._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` over single batches."""

    def run(batches):
        for batch in batches:
            yield from fn(batch)

    return df.mapInArrow(run, schema)


def add_columns(
    df: DataFrame, fields: list[tuple[str, T.DataType, pa.DataType]], fn: Callable[[pa.RecordBatch], Iterator[tuple[int, int, list]]]
) -> DataFrame:
    """Append columns that ``fn`` computes for row ranges of a batch.

    ``fn`` yields (first row, end row, one value list or array per field).  An
    input column with the name of a new one is replaced.
    """
    new = {name for name, _, _ in fields}
    kept = [f for f in df.schema.fields if f.name not in new]
    schema = T.StructType([*kept, *(T.StructField(n, t) for n, t, _ in fields)])
    names = [f.name for f in schema.fields]

    def run(batches):
        for batch in batches:
            old = [i for i, n in enumerate(batch.schema.names) if n not in new]
            for lo, hi, values in fn(batch):
                part = batch.slice(lo, hi - lo)
                made = [pa.array(v, type=t) if not isinstance(v, pa.Array) else v for v, (_, _, t) in zip(values, fields, strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in old), *made], names=names)

    return df.mapInArrow(run, schema)
