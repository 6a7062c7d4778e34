"""Trips from a file of one row group are dealt over all cores, and the split is known before the features."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from farelane.plans import catalog, ml_catalog
from farelane.sources import fixtures as fx


def _one_row_group(folder, n: int) -> str:
    keys = list(range(n))
    keys[:3] = [7, 7, None]  # repeated and missing keys stay rows of their own
    table = pa.table({"o_orderkey": pa.array(keys, pa.int64()), "o_custkey": pa.array([k % 1000 for k in range(n)], pa.int64()), "o_totalprice": pa.array([float(k % 9973) * 13.7 for k in range(n)])})
    pq.write_table(table, f"{folder}/orders.parquet", row_group_size=n)
    return str(folder)


def test_raw_trips_are_spread(spark, tmp_path):
    sf = _one_row_group(tmp_path, 400_000)
    trips = catalog._raw_trips(spark, sf)
    per_file = [r["count"] for r in trips.groupBy(F.input_file_name()).count().collect()]
    assert len(per_file) > 1 and max(per_file) < 0.75 * sum(per_file)
    whole = fx.load_trips(spark, sf)
    assert trips.exceptAll(whole).count() == 0 and whole.exceptAll(trips).count() == 0


def test_splits_before_features_give_the_same_rows(spark, tmp_path):
    from farelane.constants import IGNORE_SPLIT
    from farelane.operators import sampling

    sf = _one_row_group(tmp_path, 3000)
    after = sampling.assign_split(catalog._features(spark, sf, src=catalog._cleaned(spark, sf))).filter(F.col("split") != IGNORE_SPLIT)
    got = ml_catalog._splits(spark, sf)
    assert got.columns == after.columns
    assert got.exceptAll(after).count() == 0 and after.exceptAll(got).count() == 0
