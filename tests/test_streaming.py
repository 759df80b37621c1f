from pyspark.sql import functions as F
from pyspark.sql import types as T
from stationkit.catalog.base import readings
from stationkit.plans.stored import fresh_path
from stationkit.schema import READINGS_SCHEMA
from stationkit.streaming import jobs

HOUR = 3600


def arrive(make_readings, folder, rows):
    make_readings(rows).drop("ts").coalesce(1).write.mode("append").parquet(folder)


def source(spark, folder):
    return jobs.read_files(spark, folder, READINGS_SCHEMA)


def test_windows_and_late_readings(spark, make_readings, tmp_path):
    folder, out = str(tmp_path / "in"), fresh_path(spark, "test-stream")
    arrive(make_readings, folder, [("a", "b", "O3", 1.0, 0), ("a", "b", "O3", 5.0, 20 * HOUR)])
    first = jobs.drain(jobs.stream_sliding(source(spark, folder)), out).collect()
    # Three windows cover the first reading; those of the last one are still open.
    assert {(r.mean_value, r.num_readings) for r in first} == {(1.0, 1)}
    assert len(first) == 3
    # A late reading for a closed window changes nothing; a new one moves time on.
    arrive(make_readings, folder, [("a", "b", "O3", 99.0, 60), ("a", "b", "O3", 7.0, 40 * HOUR)])
    second = jobs.drain(jobs.stream_sliding(source(spark, folder)), out).collect()
    assert sorted(r.mean_value for r in second) == [1.0] * 3 + [5.0] * 3


def test_ingest_drops_copies_across_batches_and_incomplete_rows(spark, make_readings, tmp_path):
    folder, out = str(tmp_path / "in"), fresh_path(spark, "test-stream")
    row = ("Lyon ", "A/B", "o3", 1.0, 60)
    arrive(make_readings, folder, [row, row, ("東京", "A", "o3", 1.0, 60)])
    jobs.drain(jobs.stream_ingest(source(spark, folder)), out)
    arrive(make_readings, folder, [row, ("lyon", "a b", "O3", 2.0, 60)])
    kept = jobs.drain(jobs.stream_ingest(source(spark, folder)), out).collect()
    assert sorted((r.city, r.location, r.pollutant, r.value) for r in kept) == [
        ("lyon", "a_b", "O3", 1.0), ("lyon", "a_b", "O3", 2.0)]


def test_stream_windows_equal_batch_windows_up_to_the_watermark(spark, tmp_path):
    rows = readings(spark, "/root/testdata/sf0.001")
    rows.repartition(1).write.parquet(str(tmp_path / "in"))
    found = jobs.drain(jobs.stream_sliding(source(spark, str(tmp_path / "in"))), fresh_path(spark, "t"))
    keys = ["city", "location", "pollutant"]
    batch = rows.groupBy(F.window("last_updated", "3 hours", "1 hour"), *keys).agg(
        F.avg("value").alias("mean_value")
    )
    closed = rows.agg(F.max("last_updated") - F.expr("interval 1 hour")).scalar()
    expected = batch.where(F.col("window.end") <= closed).select(
        F.col("window.end").alias("window_end"), *keys, F.round("mean_value", 6)
    )
    got = found.select("window_end", *keys, F.round("mean_value", 6))
    assert got.exceptAll(expected).count() == expected.exceptAll(got).count() == 0


def test_cleaning_of_arriving_lines_equals_the_batch(spark, tmp_path):
    """Raw CSV lines in two batches: range check, split labels, copies, and what cannot be read."""
    from stationkit.operators import clean
    from stationkit.schema import RAW_SCHEMA

    parsed = T.StructType([*RAW_SCHEMA.fields, T.StructField("_corrupt", T.StringType())])
    header = ";".join(RAW_SCHEMA.names)
    line = "FR;Paris;Site 1;0,0;{};src;µg/m³;{};{};France"
    first = [line.format("O3,CO", 40, "2024-01-01 10:00:00"), line.format("O3", 10000, "2024-01-01 10:01:00"),
             line.format("NO2", "not a number", "2024-01-01 10:02:00")]
    second = [line.format("CO", 40, "2024-01-01 10:00:00"), line.format("pm10", 5, "2024-01-01 10:00:00"),
              line.format("PM2.5", 5, "2024-01-01 11:00:00"), line.format("BC", 5, "no time")]
    folder, out = tmp_path / "in", fresh_path(spark, "checked")
    folder.mkdir()
    kept, lost = [], []
    for number, lines in enumerate((first, second)):
        (folder / f"{number}.csv").write_text("\n".join([header, *lines]) + "\n")
        stream = jobs.read_files(
            spark, str(folder), parsed, "csv", header=True, sep=";",
            columnNameOfCorruptRecord="_corrupt", mode="PERMISSIVE",
        )
        good, bad = jobs.drain_checked(stream, out)
        kept, lost = good.collect(), [r._corrupt for r in bad.collect()]
    assert len(kept) == 5 and sorted(lost) == sorted([first[2], second[3]])
    arrived = jobs.read_files(spark, f"{out}/good", RAW_SCHEMA, recursiveFileLookup="true")
    cleaned = jobs.drain(jobs.stream_clean(arrived))
    rows = spark.createDataFrame(kept, good.schema).select(*RAW_SCHEMA.names)
    expected = clean.clean_readings(rows)
    assert sorted(map(tuple, cleaned.collect())) == sorted(map(tuple, expected.collect()))
    assert sorted(r.pollutant for r in cleaned.collect()) == ["CO", "O3", "PM2_5"]


DAY = 86_400


def test_sessions_equal_episodes_over_two_batches(spark, make_readings, tmp_path):
    """A session that goes on in the second batch, one pause of exactly the gap, a late reading."""
    from stationkit.operators import temporal

    folder, out = str(tmp_path / "in"), fresh_path(spark, "sessions")
    first = [("a", "b", "O3", 1.0, DAY), ("a", "b", "O3", 2.0, DAY + 2 * HOUR), ("c", "d", "O3", 9.0, DAY),
             ("a", "b", "O3", 4.0, DAY + 4 * HOUR)]
    second = [("a", "b", "O3", 8.0, DAY + 6 * HOUR), ("a", "b", "O3", 8.0, DAY + 30 * HOUR)]
    arrive(make_readings, folder, first)
    session = lambda: jobs.stream_sessions(source(spark, folder), "2 hours")
    one = jobs.drain(session(), out).collect()
    assert [(r.city, r.num_readings) for r in one] == [("c", 1)]
    arrive(make_readings, folder, [*second, ("c", "d", "O3", 7.0, DAY + HOUR)])
    got = jobs.drain(session(), out)
    batch = temporal.episodes(make_readings([*first, *second]), 2 * HOUR)
    closed = batch.where(F.col("episode_end") < F.timestamp_seconds(F.lit(DAY + 27 * HOUR)))
    assert sorted(map(tuple, got.select(closed.columns).collect())) == sorted(map(tuple, closed.collect()))
    assert {r.num_readings for r in got.collect()} == {1, 4}


def test_calibrated_over_two_batches(spark, make_readings, tmp_path):
    """A calibration that comes after its reading, one too old, and a reading that never gets one."""
    folder, side, out = str(tmp_path / "in"), str(tmp_path / "side"), fresh_path(spark, "calibrated")

    def run(readings, calibrations):
        arrive(make_readings, folder, readings)
        arrive(make_readings, side, calibrations)
        marks = source(spark, side).select(
            "city", "location", F.col("last_updated").alias("calibrated_at"), F.col("value").alias("calibration")
        )
        joined = jobs.stream_calibrated(source(spark, folder), marks, "1 hour", "1 hour")
        return sorted((r.value, r.calibration or 0.0) for r in jobs.drain(joined, out).collect())

    assert run([("a", "b", "O3", 1.0, DAY), ("a", "x", "O3", 2.0, DAY), (None, "b", "O3", 3.0, DAY)],
               [("a", "b", "-", 10.0, DAY - 7200)]) == []
    assert run([("a", "b", "O3", 4.0, DAY + 1800)], [("a", "b", "-", 11.0, DAY - 1800)]) == [(1.0, 11.0), (4.0, 11.0)]
    late = run([("a", "b", "O3", 5.0, DAY + 9 * HOUR)], [("q", "q", "-", 0.0, DAY + 9 * HOUR)])
    assert late == [(1.0, 11.0), (2.0, 0.0), (3.0, 0.0), (4.0, 11.0)]


def watch_brute(rows, silence, stuck):
    """Silence and stuck alerts of whole series."""
    series, out = {}, []
    for c, l, p, v, t in sorted(rows, key=lambda r: (r[4], r[3])):  # noqa: E741
        series.setdefault((c, l, p), []).append((t, v))
    for key, own in series.items():
        run = 0
        for i, (t, v) in enumerate(own):
            if i and t - own[i - 1][0] > silence:
                out.append((*key, "silence", own[i - 1][0], t, own[i - 1][1]))
            run = run + 1 if i and own[i - 1][1] == v else 1
            if run == stuck:
                out.append((*key, "stuck", own[i - stuck + 1][0], t, v))
    return sorted(out)


def test_watch_over_batches(spark, make_readings, tmp_path):
    """Runs and silences that span batches are told once, as in one batch; late and quiet beside them."""
    import random

    from stationkit.streaming import watch

    rnd = random.Random(5)
    rows = sorted(
        ((rnd.choice("ab"), "x", rnd.choice(["O3", "CO"]), float(rnd.randrange(2)), DAY + 600 * i + rnd.randrange(600))
         for i in range(240) if rnd.random() < 0.6), key=lambda r: r[4],
    )
    folder, out = str(tmp_path / "in"), fresh_path(spark, "watch")
    for begin in range(0, len(rows), 50):
        part = rows[begin : begin + 50]
        if begin == 100:
            late = next(r for r in reversed(rows[:100]) if r[4] < rows[99][4] - 60)
            part = [*part, (*late[:3], 77.0, late[4] - 1)]
        arrive(make_readings, folder, part)
        got = jobs.drain(watch.watch(source(spark, folder), 3000.0, 3, "5 hours"), out)
    arrive(make_readings, folder, [("z", "z", "z", 1.0, 90 * DAY)])
    got = jobs.drain(watch.watch(source(spark, folder), 3000.0, 3, "5 hours"), out)
    seconds = [(F.unix_micros(c) / 1e6).cast("bigint").alias(c) for c in ("since", "until")]
    found = [tuple(r) for r in got.select("city", "location", "pollutant", "kind", *seconds, "value").collect()]
    assert sorted(r for r in found if r[3] in ("silence", "stuck")) == watch_brute(rows, 3000, 3)
    assert [r[6] for r in found if r[3] == "late"] == [77.0]
    last = {r[:3]: r[4] for r in rows}
    assert {r[:3]: r[4] for r in found if r[3] == "quiet" and r[4] == last[r[:3]]} == last


def test_watch_handles_rows_and_asks_a_new_series_for_no_timers():
    from unittest.mock import MagicMock

    from stationkit.streaming import watch

    series = watch.SeriesWatch(100, 2)
    series.handle, series.state = MagicMock(), MagicMock()
    series.state.get.return_value = None
    rows = [{"at": 7, "value": 1.0}, {"at": 3, "value": 1.0}, {"at": 500, "value": 2.0}]
    found = [tuple(r) for r in series.handleInputRows(("c", "l", "p"), iter(rows), None)]
    assert found == [("c", "l", "p", "stuck", 3, 7, 1.0), ("c", "l", "p", "silence", 7, 500, 1.0)]
    series.handle.listTimers.assert_not_called()
    series.state.update.assert_called_once_with((500, 2.0, 500, 1))


def test_watch_needs_two(spark):
    import pytest
    from stationkit.streaming import watch

    with pytest.raises(ValueError, match="stuck"):
        watch.watch(spark.createDataFrame([], READINGS_SCHEMA), 1.0, 1)
