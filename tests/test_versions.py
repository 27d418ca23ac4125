"""Tables that change together: all of a write or nothing."""

import pytest
from pyspark.sql import functions as F

from shelfwise.sources import versions


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "group")


def state(spark, folder, version=None):
    return {name: sorted(r.id for r in df.collect()) for name, df in versions.read_together(spark, folder, version).items()}


def test_a_broken_second_write_leaves_the_old_state(spark, folder):
    one = spark.range(3)
    assert versions.write_together({"hot": one, "potential": one}, folder) == 1
    broken = spark.range(5).select(F.when(F.col("id") < 9, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        versions.write_together({"hot": spark.range(7), "potential": broken}, folder)
    assert state(spark, folder) == {"hot": [0, 1, 2], "potential": [0, 1, 2]} and versions.versions(spark, folder) == [1]
    assert versions.write_together({"hot": spark.range(2)}, folder) == 2
    assert state(spark, folder) == {"hot": [0, 1], "potential": [0, 1, 2]}
    assert state(spark, folder, 1) == {"hot": [0, 1, 2], "potential": [0, 1, 2]}


def test_the_later_of_two_writers_is_refused(spark, folder, monkeypatch):
    versions.write_together({"hot": spark.range(1)}, folder)
    before = versions.versions(spark, folder)
    versions.write_together({"hot": spark.range(2)}, folder)
    monkeypatch.setattr(versions, "versions", lambda *_: before)
    with pytest.raises(versions.TakenVersion):
        versions.write_together({"hot": spark.range(9)}, folder)
    monkeypatch.undo()
    assert state(spark, folder) == {"hot": [0, 1]}


def test_empty_tables_old_versions_and_a_missing_folder(spark, folder):
    assert versions.versions(spark, folder) == [] and versions.read_together(spark, folder) == {}
    versions.write_together({"hot": spark.range(0), "potential": spark.range(1)}, folder)
    versions.write_together({"hot": spark.range(2)}, folder)
    held = versions.read_together(spark, folder)
    versions.write_together({"hot": spark.range(3)}, folder)
    assert held["hot"].count() == 2  # as it was read
    versions.drop_versions_before(spark, folder, 3)
    assert versions.versions(spark, folder) == [3] and state(spark, folder) == {"hot": [0, 1, 2], "potential": [0]}
    assert versions.read_together(spark, folder)["potential"].dtypes == [("id", "bigint")]
