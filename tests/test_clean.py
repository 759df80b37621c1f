import math

from pyspark.sql import functions as F
from stationkit.functions import text
from stationkit.operators import clean, quality
from stationkit.schema import RAW_SCHEMA
from stationkit.sources import files


def one(spark, value, function):
    df = spark.createDataFrame([(value,)], "t string")
    return df.select(function(F.col("t"))).first()[0]


def test_slug_drops_accents_and_joins_words(spark):
    assert one(spark, "Saint-Étienne / Côte  Chaude", text.slug) == "saint_tienne_cte_chaude"


def test_slug_strips_before_lowering(spark):
    # Lower-casing the Kelvin sign would give a plain k.
    assert one(spark, "Ka", text.slug) == "a"


def test_non_latin_name_becomes_null_and_is_dropped(spark, make_readings):
    rows = make_readings([("東京", "x", "O3", 1.0, 0), ("Paris", "x", "O3", 1.0, 0)])
    assert [r.city for r in clean.normal_rows(rows).collect()] == ["paris"]


def test_code(spark):
    assert one(spark, "PM2.5", text.code) == "PM2_5"
    assert one(spark, " o3 ", text.code) == "_O3_"


def test_split_happens_before_the_range_check(make_readings):
    rows = make_readings([("a", "b", "CO2, NO2,", 5.0, 0)])
    parts = clean.split_categories(rows)
    assert sorted(r.pollutant for r in parts.collect()) == ["CO2", "NO2"]
    assert [r.pollutant for r in clean.range_filter(parts).collect()] == ["NO2"]


def test_range_filter_limits_are_inclusive_and_labels_exact(make_readings):
    cases = [("PM10", 500.0), ("PM10", 500.01), ("PM10", -0.1), ("pm10", 5.0), ("CO", 50.0),
             ("CO", 60.0), ("PM10", 0.0), ("PM10", math.nan)]
    rows = make_readings([("a", "b", p, v, 0) for p, v in cases])
    kept = sorted((r.pollutant, r.value) for r in clean.range_filter(rows).collect())
    assert kept == [("CO", 50.0), ("PM10", 0.0), ("PM10", 500.0)]


def test_drop_missing_drops_null_and_nan(make_readings):
    rows = make_readings([("a", "b", "O3", v, 0) for v in (None, math.nan, 1.0)])
    assert [r.value for r in clean.drop_missing(rows).collect()] == [1.0]


def test_blank_handling(spark):
    df = spark.createDataFrame([("  ",), ("",), (None,), ("x",)], "t string")
    assert quality.missing_profile(df).collect() == [("t", 3)]
    assert [r.t for r in clean.blank_to_null(df).collect()] == [None, None, None, "x"]


def test_duplicates(spark):
    df = spark.createDataFrame([("A",), ("A",), ("A",), ("B",)], "t string")
    assert quality.duplicate_count(df).first() == (4, 2, 2)
    assert clean.dedupe(df).count() == 2


def test_min_group_rows_keeps_groups_of_three(make_readings):
    rows = make_readings(
        [("two", "x", "O3", 1.0, t) for t in range(2)]
        + [("three", "x", "O3", 1.0, t) for t in range(3)]
    )
    for limit in (None, 0):
        kept = clean.min_group_rows(rows, broadcast_bytes=limit)
        assert [r.city for r in kept.collect()] == ["three"] * 3


def test_drop_columns_ignores_missing_names(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert clean.drop_columns(df, ["b", "zzz"]).columns == ["a"]


def test_one_dedupe_equals_one_per_stage(spark):
    raw = spark.createDataFrame(
        [("FR", c, loc, "", p, "", "", v, None, "") for c, loc, p, v in [
            ("Lyon", "A", "O3", 1.0), ("LYON", "A", "O3", 1.0), ("Lyon", "A", "O3", 1.0),
            ("Lyon", " ", "O3", 1.0), ("Lyon", "A", "O3,NO2", 2.0), ("###", "A", "O3", 3.0),
            ("\t", "A", "O3", 4.0), ("東京", "A", "O3", 5.0), ("é ", "A", "O3", 6.0),
            ("Lyon", "A", "", 7.0), ("Lyon", "A", "O3", None), ("Lyon", "A", "O3", math.nan),
            (None, "A", "O3", 8.0), ("Lyon", "A", None, 9.0)]],
        RAW_SCHEMA,
    ).withColumn("Last Updated", F.timestamp_seconds(F.lit(60)))
    once = clean.clean_readings(raw)
    twice = clean.dedupe(clean.normal_rows(clean.ingest_clean(raw)))
    assert once.exceptAll(twice).count() == twice.exceptAll(once).count() == 0
    assert once.count() == 3


def test_early_name_test_equals_rewrite_then_drop(spark, make_readings):
    names = ["Lyon", "###", "\t", "東京", "é ", " ", "", None, "K", "a\u2014b", "1"]
    rows = make_readings([(n, "A", "O3", 1.0, 0) for n in names])
    late = clean.drop_missing(clean.blank_to_null(clean.normalize_text(rows)))
    early = clean.normal_rows(rows)
    assert sorted(r.city for r in early.collect()) == sorted(r.city for r in late.collect())
    stripped = rows.withColumn("city", text.ascii_only(F.col("city")))
    late = clean.drop_missing(clean.blank_to_null(stripped))
    early = rows.where(text.has_ascii(F.col("city"))).count()
    assert early == late.count()


def test_clean_result_has_no_missing_and_no_duplicates(spark):
    from stationkit.catalog.base import raw

    cleaned = clean.clean_readings(raw(spark, "/root/testdata/sf0.001")).cache()
    assert quality.duplicate_count(cleaned).first().duplicates == 0
    report = {r.measure: r.value for r in quality.quality_report(cleaned).collect()}
    assert report.pop("rows") > 0
    assert set(report.values()) == {0}


def test_unreadable_lines_are_quarantined(spark, tmp_path):
    (tmp_path / "in.csv").write_text(
        "Country Code;City;Location;Coordinates;Pollutant;Source Name;Unit;Value;Last Updated;"
        "Country Label\n"
        "FR;Lyon;A;0,0;O3;s;u;12.5;2024-01-01T00:00:00Z;France\n"
        "FR;Lyon;A;0,0;O3;s;u;abc;2024-01-01T00:00:00Z;France\n"
        "FR;Lyon;A;0,0;O3\n"
    )
    good, bad = files.read_csv_checked(spark, str(tmp_path))
    assert [r.Value for r in good.collect()] == [12.5]
    lines = sorted(r.line for r in bad.collect())
    assert len(lines) == 2
    assert ";abc;" in lines[1]


def test_inferred_schema_is_possible(spark, tmp_path):
    (tmp_path / "in.csv").write_text("a;b\n1;x\n")
    assert files.read_csv(spark, str(tmp_path), None).dtypes == [("a", "int"), ("b", "string")]


def test_cardinality_exact_and_approximate(make_readings):
    rows = make_readings([(f"c{i % 3}", f"l{i}", "O3", 1.0, 0) for i in range(30)])
    exact = dict(quality.cardinality(rows, ["city", "location"]).collect())
    assert exact == {"city": 3, "location": 30}
    about = dict(quality.cardinality(rows, ["city"], approximate=True).collect())
    assert about == {"city": 3}


def test_line_breaks_and_backslashes_survive_a_file(spark, tmp_path):
    texts = ["a\nb", "a\\nb", "\\", "\\\\n", "x;y\r\n\"q\" \\", "plain", "", None, "end\\"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    files.write_csv(df, str(tmp_path / "out"), escaped=True)
    assert files.escape_lines(df).where("t rlike '[\\r\\n]'").count() == 0
    got = files.read_csv(spark, str(tmp_path / "out"), df.schema, escaped=True).collect()
    assert {r.i: r.t for r in got} == {i: t or None for i, t in enumerate(texts)}
    back = files.unescape_lines(files.escape_lines(df)).collect()
    assert [r.t for r in back] == texts


def test_a_line_break_is_not_written_as_another_row(spark, tmp_path):
    import pytest

    df = spark.createDataFrame([("a\nb",)], "t string")
    with pytest.raises(Exception, match="line break"):
        files.write_csv(df, str(tmp_path / "out"))


def test_further_and_absent_columns(spark, tmp_path):
    """Columns nobody asks for do no harm; a needed one that is absent does."""
    import pytest

    header = "Extra;Pollutant;City;Location;Value;Last Updated;More"
    line = "1;O3;Paris;Site;{};2024-01-01 10:00:00;2"
    (tmp_path / "a.csv").write_text("\n".join([header, line.format(4), line.format("x")]) + "\n")
    rows = files.read_csv(spark, str(tmp_path)).collect()
    assert [(r.City, r.Value, r.Unit) for r in rows][0] == ("Paris", 4.0, None)
    good, bad = files.read_csv_checked(spark, str(tmp_path))
    assert good.columns == files.RAW_SCHEMA.names and good.count() == 1
    assert [r.line for r in bad.collect()] == [line.format("x")]
    (tmp_path / "a.csv").write_text(header.replace("City", "Town") + "\n" + line.format(4) + "\n")
    with pytest.raises(ValueError, match="City"):
        files.read_csv(spark, str(tmp_path))
