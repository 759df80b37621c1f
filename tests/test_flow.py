from pyspark.sql import functions as F
from stationkit.catalog.base import raw
from stationkit.operators import clean
from stationkit.operators.features import FEATURE_COLUMNS
from stationkit.plans import flow
from stationkit.sources import files


def test_files_to_features(spark, tmp_path):
    source = raw(spark, "/root/testdata/sf0.001")
    spoiled = F.when(F.col("Pollutant") == "pm10", "n/a").otherwise(F.col("Value").cast("string"))
    files.write_csv(source.withColumn("Value", spoiled), str(tmp_path / "in"))
    done = flow.run(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    expected = clean.clean_readings(source)
    assert done.readings.select(expected.columns).exceptAll(expected).count() == 0
    assert done.quarantine.count() == source.where("Pollutant = 'pm10'").count()
    assert sorted(done.features.columns) == sorted(FEATURE_COLUMNS)
    assert done.features.count() == done.readings.count() == expected.count()


def test_partitioned_table_is_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_table(clean.clean_readings(raw(spark, "/root/testdata/sf0.001")), path)
    one = files.read_table(spark, path).where("pollutant = 'O3'").select("value")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pollutant" in plan
    assert "ReadSchema: struct<value:double>" in plan
