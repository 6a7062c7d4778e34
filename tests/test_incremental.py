"""Incremental preparation: only new or changed months are read, finished stages are not repeated, sets switch at once."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from farelane.constants import FILE_MONTH
from farelane.ml import preprocess as P
from farelane.operators import sampling
from farelane.plans import incremental as I
from farelane.plans import jobs
from farelane.sources import fixtures as fx


@pytest.fixture(scope="module")
def months(spark, tmp_path_factory):
    """A folder of monthly raw files, and the dimension tables."""
    src = tmp_path_factory.mktemp("months")
    trips = fx.load_trips(spark, SF_SMALL)
    names = [r[0] for r in trips.select(FILE_MONTH).distinct().orderBy(FILE_MONTH).collect()][-8:]
    for m in names:
        trips.filter(F.col(FILE_MONTH) == m).drop(FILE_MONTH).coalesce(1).write.parquet(f"{src}/yellow_tripdata_{m}.parquet")
    return str(src), names, fx.fixture_zone_lookup(spark), fx.fixture_zones(spark)


def put(months, root, names):
    src = f"{root}/raw"
    for m in names:
        shutil.copytree(f"{months[0]}/yellow_tripdata_{m}.parquet", f"{src}/yellow_tripdata_{m}.parquet", dirs_exist_ok=True)
    return src


def run(spark, months, root, **kw):
    return I.incremental_preprocess_job(spark, f"{root}/out", f"{root}/raw", months[2], months[3], **kw)


def rows(spark, root, stage):
    df = I.read_published(spark, f"{root}/out", stage)
    return sorted(df.select(FILE_MONTH, "trip_id").collect())


def whole(spark, months, names):
    """The same stages over all months at once."""
    files = [f"{months[0]}/yellow_tripdata_{m}.parquet" for m in names]
    _, trips = jobs.read_raw_months(spark, files)
    feats = jobs.clean_and_build(trips, months[2], months[3], jobs.holiday_calendar(spark))
    return sorted(feats.select(FILE_MONTH, "trip_id").collect()), sorted(sampling.build_splits(feats, {"train": 20, "val": None, "test": 5}).select(FILE_MONTH, "trip_id").collect())


SMALL = {"sample_rows": {"train": 20, "val": None, "test": 5}}


def test_new_month_reads_that_month_only(spark, months, tmp_path, monkeypatch):
    names = months[1]
    put(months, tmp_path, names[:-1])
    first = run(spark, months, tmp_path, **SMALL)
    assert first.built["features"] == names[:-1] and first.built["preprocess"] == ["*"]
    put(months, tmp_path, names[-1:])
    scans = []
    real = I.clean_and_build

    def watched(trips, *a):
        scans.extend(trips.inputFiles())
        return real(trips, *a)

    monkeypatch.setattr(I, "clean_and_build", watched)
    opened = []
    real_crc = I.checksums
    monkeypatch.setattr(I, "checksums", lambda s, paths: (opened.extend(paths), real_crc(s, paths))[1])
    second = run(spark, months, tmp_path, **SMALL)
    assert second.built["features"] == second.built["splits"] == names[-1:]
    assert scans and all(names[-1] in f for f in scans + opened + second.read_files)
    feats, splits = whole(spark, months, names)
    assert rows(spark, tmp_path, "features") == feats and rows(spark, tmp_path, "splits") == splits
    # nothing new: nothing is done, and the published set stays
    third = run(spark, months, tmp_path, **SMALL)
    assert not any(third.built.values()) and third.published == second.published
    P.load_preprocess(third.published["preprocess"])


def test_touched_changed_and_removed_months(spark, months, tmp_path):
    names = months[1][-3:]
    src = put(months, tmp_path, names)
    first = run(spark, months, tmp_path, fit=False, **SMALL)
    part = next(f for f in os.listdir(f"{src}/yellow_tripdata_{names[0]}.parquet") if f.endswith(".parquet"))
    os.utime(f"{src}/yellow_tripdata_{names[0]}.parquet/{part}", (1, 1))
    touched = run(spark, months, tmp_path, fit=False, **SMALL)
    assert touched.built["features"] == [] and touched.published == first.published
    # other rows under the same name
    less = spark.read.parquet(f"{months[0]}/yellow_tripdata_{names[1]}.parquet").filter("trip_id % 2 = 0")
    less.coalesce(1).write.mode("overwrite").parquet(f"{src}/yellow_tripdata_{names[1]}.parquet")
    changed = run(spark, months, tmp_path, fit=False, **SMALL)
    assert changed.built["features"] == [names[1]]
    assert all(r["trip_id"] % 2 == 0 for r in rows(spark, tmp_path, "features") if r[FILE_MONTH] == names[1])
    # a month that left the source leaves the set; its folder stays for readers of the old one
    moved = tmp_path / "elsewhere"
    shutil.move(f"{src}/yellow_tripdata_{names[2]}.parquet", moved)
    gone = run(spark, months, tmp_path, fit=False, **SMALL)
    assert gone.removed == [names[2]] and names[2] not in {r[FILE_MONTH] for r in rows(spark, tmp_path, "features")}
    assert spark.read.parquet(changed.published["features"][names[2]]).count() > 0


def test_settings_and_dimensions_are_part_of_the_key(spark, months, tmp_path):
    names = months[1][-2:]
    put(months, tmp_path, names)
    run(spark, months, tmp_path, fit=False, **SMALL)
    other = run(spark, months, tmp_path, fit=False, sample_rows={"train": 3, "val": 3, "test": 3})
    assert other.built == {"features": [], "splits": names}
    zones = months[3].filter("LocationID <> 5")
    again = I.incremental_preprocess_job(spark, f"{tmp_path}/out", f"{tmp_path}/raw", months[2], zones, fit=False, **SMALL)
    assert again.built["features"] == names


def test_ended_run_repeats_no_finished_stage(spark, months, tmp_path, monkeypatch):
    names = months[1][-3:]
    put(months, tmp_path, names)

    def lost(*a, **kw):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(I.sampling, "build_splits", lost)
    with pytest.raises(RuntimeError):
        run(spark, months, tmp_path, fit=False, **SMALL)
    monkeypatch.undo()
    with pytest.raises(ValueError):  # nothing was published
        I.read_published(spark, f"{tmp_path}/out", "features")
    monkeypatch.setattr(I, "clean_and_build", lost)  # the features are not built again
    report = run(spark, months, tmp_path, fit=False, **SMALL)
    assert report.built == {"features": [], "splits": names}
    monkeypatch.undo()
    assert rows(spark, tmp_path, "features") == whole(spark, months, names)[0]


def test_readers_keep_the_old_set_until_the_new_one_is_published(spark, months, tmp_path, monkeypatch):
    names = months[1][-3:]
    put(months, tmp_path, names[:2])
    run(spark, months, tmp_path, fit=False, **SMALL)
    before = rows(spark, tmp_path, "splits")
    put(months, tmp_path, names[2:])
    seen = []
    real = I.StageLog.add

    def watched(self, entries):
        seen.append((entries[0]["kind"] if entries else None, rows(spark, tmp_path, "splits") == before))
        return real(self, entries)

    monkeypatch.setattr(I.StageLog, "add", watched)
    run(spark, months, tmp_path, fit=False, **SMALL)
    assert all(same for _, same in seen) and seen[-1][0] == "published"
    monkeypatch.undo()
    assert rows(spark, tmp_path, "splits") != before


def test_file_without_a_month(spark, months, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/raw/trips.parquet")
    with pytest.raises(Exception, match="no calendar month"):
        run(spark, months, tmp_path)
