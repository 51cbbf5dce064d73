import datetime

import pytest

from reviewlens.streaming import compact, latest_state, rating_updates, read_stream, run_available
from reviewlens.streaming.ratings import daily_ratings, monthly_ratings, read_state, update_state

SCHEMA = "product_id string, rating double, ts timestamp_ntz"


@pytest.fixture
def folder(spark, tmp_path):
    """Adds files to a stream's input one by one."""

    def add(name, rows):
        data = [(p, r, datetime.datetime.fromisoformat(t)) for p, r, t in rows]
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "staged" / name))
        for part in (tmp_path / "staged" / name).glob("part-*"):
            (tmp_path / "in").mkdir(exist_ok=True)
            part.rename(tmp_path / "in" / f"{name}.parquet")

    add.path = tmp_path
    return add


def run(spark, path, lateness="1 day"):
    schema = spark.createDataFrame([], SCHEMA).schema
    events = read_stream(spark, str(path / "in"), schema, files_per_batch=1)
    run_available(rating_updates(events, ["product_id"], lateness=lateness), f"{path}/out", f"{path}/checkpoint")
    return latest_state(spark, f"{path}/out", ["product_id"])


def test_state_grows_over_restarts(spark, folder, rows):
    folder("a", [("p", 4.0, "2024-01-01T10:00:00"), ("q", 1.0, "2024-01-01T11:00:00")])
    first = daily_ratings(run(spark, folder.path))
    assert rows(first.select("product_id", "avg_rating", "review_count")) == [("p", 4.0, 1), ("q", 1.0, 1)]
    folder("b", [("p", 2.0, "2024-01-01T12:00:00"), ("p", 5.0, "2024-01-02T00:00:00")])
    again = run(spark, folder.path)
    days = daily_ratings(again).selectExpr("product_id", "string(day) day", "avg_rating", "review_count")
    assert rows(days) == [("p", "2024-01-01", 3.0, 2), ("p", "2024-01-02", 5.0, 1), ("q", "2024-01-01", 1.0, 1)]
    months = monthly_ratings(again, ["product_id"]).selectExpr("product_id", "string(month) m", "review_count")
    assert rows(months) == [("p", "2024-01-01", 3), ("q", "2024-01-01", 1)]


def test_nothing_new_changes_nothing(spark, folder, rows):
    folder("a", [("p", 4.0, "2024-01-01T10:00:00")])
    before = rows(run(spark, folder.path))
    assert rows(run(spark, folder.path)) == before


def test_rows_behind_the_watermark_are_dropped(spark, folder, rows):
    folder("a", [("p", 4.0, "2024-01-10T10:00:00")])
    run(spark, folder.path)
    folder("b", [("p", 4.0, "2024-01-10T11:00:00")])
    run(spark, folder.path)
    folder("c", [("p", 1.0, "2024-01-01T00:00:00"), ("p", 2.0, "2024-01-10T12:00:00")])
    days = daily_ratings(run(spark, folder.path)).selectExpr("string(day) day", "review_count")
    assert rows(days) == [("2024-01-10", 3)]


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
def test_days_are_calendar_days_in_any_zone(spark, folder, rows, zone):
    folder("a", [("p", 4.0, "2024-01-01T00:30:00"), ("p", 2.0, "2024-01-01T23:30:00"), ("p", 1.0, "2024-01-02T01:00:00")])
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        days = daily_ratings(run(spark, folder.path)).selectExpr("string(day) day", "review_count")
        assert rows(days) == [("2024-01-01", 2), ("2024-01-02", 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_compacted_state_equals_the_whole_history(spark, folder, rows):
    folder("a", [("p", 4.0, "2024-01-01T10:00:00"), ("q", 3.0, "2024-01-01T10:00:00")])
    run(spark, folder.path)
    output, base, second = (str(folder.path / name) for name in ("out", "base", "second"))
    compact(spark, output, ["product_id"], base)
    folder("b", [("p", 2.0, "2024-01-01T12:00:00"), ("p", 5.0, "2024-01-02T00:00:00")])
    whole = rows(run(spark, folder.path))
    assert rows(latest_state(spark, output, ["product_id"], base)) == whole
    compact(spark, output, ["product_id"], second, base)
    later = latest_state(spark, output, ["product_id"], second)
    assert rows(later) == whole
    plan = later._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch" in plan


def test_a_run_rewrites_only_the_days_that_changed(spark, folder, rows):
    output, state = str(folder.path / "out"), str(folder.path / "state")

    def files():
        return {day.name: sorted(part.name for part in day.glob("part-*")) for day in (folder.path / "state").glob("day=*")}

    folder("a", [("p", 4.0, "2024-01-01T10:00:00"), ("q", 3.0, "2024-01-01T10:00:00"), ("p", 1.0, "2024-01-02T10:00:00")])
    run(spark, folder.path)
    assert update_state(spark, output, ["product_id"], state) > 0
    before = files()
    assert update_state(spark, output, ["product_id"], state) == 0 and files() == before
    folder("b", [("p", 2.0, "2024-01-02T12:00:00"), (None, 5.0, "2024-01-03T00:00:00")])
    whole = rows(run(spark, folder.path))
    update_state(spark, output, ["product_id"], state)
    after = files()
    assert after["day=2024-01-01"] == before["day=2024-01-01"] and after["day=2024-01-02"] != before["day=2024-01-02"]
    assert rows(read_state(spark, state), "product_id", "day", "rating_sum", "review_count") == whole
    folder("c", [("late", 1.0, "2024-01-01T00:00:00"), ("p", 3.0, "2024-01-05T12:00:00")])
    whole = rows(run(spark, folder.path))
    folder("d", [("late", 1.0, "2024-01-01T00:00:00"), ("p", 3.0, "2024-01-05T13:00:00")])
    assert len(rows(run(spark, folder.path))) == len(whole), "a row behind the watermark is dropped"
    assert rows(run(spark, folder.path)) == rows(finish_state(spark, output, state))


def finish_state(spark, output, state):
    update_state(spark, output, ["product_id"], state, keep=1)
    return read_state(spark, state).select("product_id", "day", "rating_sum", "review_count")


def test_a_run_cut_off_before_its_mark_is_made_good(spark, folder, rows, monkeypatch):
    from reviewlens.streaming import ratings as module

    output, state = str(folder.path / "out"), str(folder.path / "state")
    folder("a", [("p", 4.0, "2024-01-01T10:00:00")])
    run(spark, folder.path)

    def crash(*args):
        raise RuntimeError("cut off")

    monkeypatch.setattr(module, "replace", crash)
    with pytest.raises(RuntimeError):
        update_state(spark, output, ["product_id"], state)
    monkeypatch.undo()
    folder("b", [("p", 2.0, "2024-01-01T12:00:00")])
    whole = rows(run(spark, folder.path))
    assert update_state(spark, output, ["product_id"], state) >= 2
    assert rows(read_state(spark, state), "product_id", "day", "rating_sum", "review_count") == whole
