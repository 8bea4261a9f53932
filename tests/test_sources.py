"""File round trips."""

import pytest

from stationflow.plans.fixture import WEEKDAY_SOURCE, Fixture
from stationflow.session import scratch_path, shared_dir
from stationflow.sources import readers, writers


@pytest.fixture(scope="module")
def tap_files(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("taps"))
    writers.write_taps(Fixture(spark, sf_dir).taps(), f"{path}/days")
    return f"{path}/days"


def test_other_file_types_are_left_out(spark, sf_dir, tap_files):
    with open(f"{tap_files}/notes.txt", "w") as f:
        f.write("not,a,tap,file\n")
    assert readers.read_taps(spark, tap_files).count() == Fixture(spark, sf_dir).taps().count()


def test_forecast_column_order(spark, sf_dir, tmp_path):
    forecast = Fixture(spark, sf_dir).weekday_rule()
    shuffled = forecast.select("outNums", "inNums", "endTime", "startTime", "stationID")
    writers.write_forecast(shuffled, str(tmp_path / "f"))
    back = readers.read_forecast(spark, str(tmp_path / "f"))
    assert back.exceptAll(forecast).count() == 0
    assert readers.read_template(spark, str(tmp_path / "f")).columns == ["stationID", "startTime", "endTime"]


def test_writing_a_day_leaves_the_others(spark, sf_dir, tmp_path):
    f, path = Fixture(spark, sf_dir), str(tmp_path / "slots")
    writers.write_slots(f.slots(), path)
    before = readers.read_slots(spark, path).count()
    writers.write_slots(f.slots([WEEKDAY_SOURCE]), path)
    assert readers.read_slots(spark, path).count() == before


def test_shared_folder_comes_from_the_session(spark):
    folder = shared_dir(spark)
    assert spark.sparkContext.getCheckpointDir() is not None
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(folder)
