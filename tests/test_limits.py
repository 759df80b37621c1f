"""Header order, tables without usable columns, and PageRank that has not settled."""

import pytest

from stationkit.operators import graph, quality
from stationkit.schema import RAW_SCHEMA
from stationkit.sources import files


def write_lines(path, names):
    path.write_text(";".join(names) + "\n" + ";".join("1" if n == "Value" else f"<{n}>" for n in names) + "\n")


def test_columns_go_by_header_name(spark, tmp_path):
    names = list(reversed(RAW_SCHEMA.names))
    write_lines(tmp_path / "a.csv", names)
    row = files.read_csv(spark, str(tmp_path)).first()
    assert files.read_csv(spark, str(tmp_path)).columns == RAW_SCHEMA.names
    assert (row["City"], row["Location"]) == ("<City>", "<Location>")
    good, bad = files.read_csv_checked(spark, str(tmp_path))
    assert good.columns == RAW_SCHEMA.names and bad.columns == ["line"]
    assert good.count() + bad.count() == 1
    write_lines(tmp_path / "a.csv", [*names[:-1], "Other"])
    with pytest.raises(ValueError, match="does not name"):
        files.read_csv(spark, str(tmp_path))


def test_files_with_another_header_stop_the_read(spark, tmp_path):
    write_lines(tmp_path / "a.csv", RAW_SCHEMA.names)
    write_lines(tmp_path / "b.csv", list(reversed(RAW_SCHEMA.names)))
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, str(tmp_path)).collect()


def test_profiles_without_usable_columns(spark):
    assert quality.missing_profile(spark.range(3)).count() == 0
    assert quality.summary_stats(spark.sql("SELECT timestamp '2024-01-01' AS t")).count() == 0


def test_pagerank_settles_or_fails(spark):
    vertices = spark.range(1, 8).withColumnRenamed("id", "station_id")
    edges = spark.range(1, 7).selectExpr("id AS src", "id + 1 AS dst")
    with pytest.raises(RuntimeError, match="2 rounds"):
        graph.pagerank(vertices, edges, max_iter=2)
    assert graph.pagerank(vertices, edges).count() == 7
