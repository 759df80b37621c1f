"""Ingestion, cleaning and quality queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationkit.catalog.base import RAW, READINGS, Query, r4, raw, readings, shown, table
from stationkit.functions import text
from stationkit.operators import clean, quality
from stationkit.plans.stored import fresh_path
from stationkit.schema import POLLUTANT_CAPS, RAW_SCHEMA, READING
from stationkit.sources import files

_CAPS = ", ".join(f"('{label}', {cap})" for label, cap in POLLUTANT_CAPS.items())
_ASCII = r"regexp_replace({0}, '[^\x00-\x7F]', '', 'g')"
_SLUG = (
    "trim(regexp_replace(lower(" + _ASCII + "), '[^a-z0-9]+', '_', 'g'), '_')"
)
_INGESTED = f"""{RAW}, caps(label, cap) AS (VALUES {_CAPS}),
stripped AS (
  SELECT {_ASCII.format("city")} AS city, {_ASCII.format("location")} AS location,
         unnest(string_split(pollutant, ',')) AS pollutant, value, last_updated
  FROM raw),
ingested AS (
  SELECT DISTINCT city, location, trim(pollutant) AS pollutant, value, last_updated
  FROM stripped JOIN caps ON label = trim(pollutant)
  WHERE trim(city) <> '' AND trim(location) <> '' AND value BETWEEN 0 AND cap)"""

_NORMAL = f"""{_SLUG.format("city")} AS city, {_SLUG.format("location")} AS location,
  regexp_replace(upper(pollutant), '[^A-Z0-9]', '_', 'g') AS pollutant"""
# The cleaned readings under the name of the given ones, for the queries of the whole chain.
CLEANED = f"""{_INGESTED},
readings AS (SELECT DISTINCT {_NORMAL}, value, last_updated FROM ingested)"""


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "csv")
    files.write_csv(raw(spark, folder), path)
    return shown(clean.to_readings(files.read_csv(spark, path)))


def corrupt_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Lines whose value is not a number end up in the quarantine, whole."""
    spoiled = F.when(F.col("Pollutant") == "pm10", "n/a").otherwise(F.col("Value").cast("string"))
    path = fresh_path(spark, "csv")
    files.write_csv(raw(spark, folder).withColumn("Value", spoiled), path)
    good, bad = files.read_csv_checked(spark, path)
    label = F.split("line", ";")[RAW_SCHEMA.names.index("Pollutant")]
    both = good.select(F.lit("good").alias("status"), F.col("Pollutant").alias("pollutant"))
    both = both.unionByName(bad.select(F.lit("bad").alias("status"), label.alias("pollutant")))
    return both.groupBy("status", "pollutant").agg(F.count(F.lit(1)).alias("rows"))


def ingest_clean(spark: SparkSession, folder: str) -> DataFrame:
    return shown(clean.ingest_clean(raw(spark, folder)))


def clean_readings(spark: SparkSession, folder: str) -> DataFrame:
    return shown(clean.clean_readings(raw(spark, folder)))


def blank_to_null(spark: SparkSession, folder: str) -> DataFrame:
    return shown(clean.blank_to_null(clean.to_readings(raw(spark, folder))))


def drop_missing(spark: SparkSession, folder: str) -> DataFrame:
    return shown(clean.drop_missing(clean.blank_to_null(clean.to_readings(raw(spark, folder)))))


def range_filter(spark: SparkSession, folder: str) -> DataFrame:
    return shown(clean.range_filter(clean.to_readings(raw(spark, folder))))


def split_explode(spark: SparkSession, folder: str) -> DataFrame:
    return shown(clean.split_categories(clean.to_readings(raw(spark, folder))))


def normalize_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return pages.select("page_id", text.slug(F.col("url")).alias("slug"))


def normalize_names(spark: SparkSession, folder: str) -> DataFrame:
    return shown(clean.normalize_text(clean.to_readings(raw(spark, folder))))


def normalize_code(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part")
    return parts.select("p_partkey", text.code(F.concat_ws(" ", "p_name", "p_brand")).alias("code"))


_LINE = ["l_suppkey", "l_quantity", "l_returnflag", "l_linestatus"]


def dedupe(spark: SparkSession, folder: str) -> DataFrame:
    return clean.dedupe(table(spark, folder, "lineitem").select(*_LINE))


def duplicate_count(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicate_count(table(spark, folder, "lineitem").select(*_LINE))


def min_group_rows(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return clean.min_group_rows(orders, "o_custkey", 12)


def preview(spark: SparkSession, folder: str) -> DataFrame:
    return shown(quality.preview(readings(spark, folder), 10, [F.desc("value"), "last_updated"]))


def schema_profile(spark: SparkSession, folder: str) -> DataFrame:
    return quality.schema_profile(table(spark, folder, "lineitem"))


def missing_profile(spark: SparkSession, folder: str) -> DataFrame:
    return quality.missing_profile(clean.to_readings(raw(spark, folder)))


def null_profile(spark: SparkSession, folder: str) -> DataFrame:
    return quality.null_profile(clean.blank_to_null(clean.to_readings(raw(spark, folder))))


def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_report(clean.to_readings(raw(spark, folder)))


def cardinality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.cardinality(readings(spark, folder), ["city", "location", "pollutant"])


def distinct_values(spark: SparkSession, folder: str) -> DataFrame:
    return quality.distinct_values(readings(spark, folder), "pollutant")


def summary_stats(spark: SparkSession, folder: str) -> DataFrame:
    return shown(quality.summary_stats(readings(spark, folder)))


def sink_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "table")
    rows = readings(spark, folder)
    files.write_table(rows, path)
    return shown(files.read_table(spark, path, rows.schema).select(*READING))


_FIVE = f"city, location, pollutant, {r4('value')}, last_updated"
_BLANKED = f"""{RAW}, blanked AS (
  SELECT nullif(trim(city), '') IS NULL AS no_city, city,
         CASE WHEN trim(location) <> '' THEN location END AS location,
         pollutant, value, last_updated FROM raw)"""
_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double",
    "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz",
}
_TYPE_CASE = " ".join(f"WHEN '{duck}' THEN '{ours}'" for duck, ours in _TYPES.items())
_STATS = " UNION ALL ".join(
    [
        f"""SELECT '{c}' AS "column", count({c}) AS count, NULL::DOUBLE AS mean,
        NULL::DOUBLE AS stddev, min({c}) AS min, max({c}) AS max FROM readings"""
        for c in ("city", "location", "pollutant")
    ]
    + [
        f"""SELECT 'value', count(value), {r4("avg(value)", "mean")},
        {r4("stddev_samp(value)", "stddev")}, min(value)::VARCHAR, max(value)::VARCHAR
        FROM readings"""
    ]
)


def _long(source: str, measures: dict[str, str], name: str, value: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{k}' AS "{name}", {e} AS "{value}" FROM {source}""" for k, e in measures.items()
    )


_NULLS = {f"{c}:null": f"count(*) FILTER ({c} IS NULL)" for c in READING}
_BLANKS = {
    f"{c}:blank": f"count(*) FILTER ({c} IS NULL OR trim({c}) = '')"
    for c in ("city", "location", "pollutant")
}

QUERIES = {
    "csv_roundtrip": Query(csv_roundtrip, f"WITH {RAW} SELECT {_FIVE} FROM raw"),
    "corrupt_rows": Query(
        corrupt_rows,
        f"""WITH {RAW} SELECT CASE WHEN pollutant = 'pm10' THEN 'bad' ELSE 'good' END AS status,
        pollutant, count(*) AS rows FROM raw GROUP BY ALL""",
    ),
    "ingest_clean": Query(ingest_clean, f"WITH {_INGESTED} SELECT {_FIVE} FROM ingested"),
    "clean_readings": Query(
        clean_readings,
        f"""WITH {_INGESTED} SELECT DISTINCT {_NORMAL}, {r4("value")}, last_updated FROM ingested""",
    ),
    "blank_to_null": Query(blank_to_null, f"WITH {_BLANKED} SELECT {_FIVE} FROM blanked"),
    "drop_missing": Query(
        drop_missing, f"WITH {_BLANKED} SELECT {_FIVE} FROM blanked WHERE location IS NOT NULL"
    ),
    "range_filter": Query(
        range_filter,
        f"""WITH {RAW}, caps(label, cap) AS (VALUES {_CAPS})
        SELECT {_FIVE} FROM raw JOIN caps ON label = pollutant WHERE value BETWEEN 0 AND cap""",
    ),
    "split_explode": Query(
        split_explode,
        f"""WITH {RAW} SELECT city, location, unnest(string_split(pollutant, ',')) AS pollutant,
        {r4("value")}, last_updated FROM raw""",
    ),
    "normalize_text": Query(
        normalize_text, f"SELECT page_id, {_SLUG.format('url')} AS slug FROM pages"
    ),
    "normalize_names": Query(
        normalize_names,
        f"""WITH {RAW} SELECT {_SLUG.format("city")} AS city,
        {_SLUG.format("location")} AS location,
        regexp_replace(upper(pollutant), '[^A-Z0-9]', '_', 'g') AS pollutant,
        {r4("value")}, last_updated FROM raw""",
    ),
    "normalize_code": Query(
        normalize_code,
        """SELECT p_partkey, regexp_replace(upper(p_name || ' ' || p_brand), '[^A-Z0-9]', '_', 'g')
        AS code FROM part""",
    ),
    "dedupe": Query(dedupe, f"SELECT DISTINCT {', '.join(_LINE)} FROM lineitem"),
    "duplicate_count": Query(
        duplicate_count,
        f"""SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_rows,
        CAST(sum(n) - count(*) AS BIGINT) AS duplicates
        FROM (SELECT count(*) AS n FROM lineitem GROUP BY {", ".join(_LINE)})""",
    ),
    "min_group_rows": Query(
        min_group_rows,
        """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey IN
        (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) >= 12)""",
    ),
    "preview": Query(
        preview,
        f"""WITH {READINGS}, top AS (
        SELECT * FROM readings ORDER BY value DESC, last_updated LIMIT 10)
        SELECT {_FIVE} FROM top""",
    ),
    "schema_profile": Query(
        schema_profile,
        f"""SELECT column_name AS name, CASE column_type {_TYPE_CASE} END AS type,
        CAST(row_number() OVER () - 1 AS INTEGER) AS position FROM (DESCRIBE lineitem)""",
    ),
    "missing_profile": Query(
        missing_profile,
        f"WITH {RAW} "
        + _long("raw", {k.split(":")[0]: v for k, v in _BLANKS.items()}, "column", "missing"),
    ),
    "null_profile": Query(
        null_profile,
        f"WITH {_BLANKED} "
        + _long("blanked", {k.split(":")[0]: v for k, v in _NULLS.items()}, "column", "nulls"),
    ),
    "quality_report": Query(
        quality_report,
        f"WITH {RAW} "
        + _long(
            "raw",
            {
                "rows": "count(*)",
                **_NULLS,
                **_BLANKS,
                "value:nan": "count(*) FILTER (isnan(value))",
            },
            "measure",
            "value",
        ),
    ),
    "cardinality": Query(
        cardinality,
        f"WITH {READINGS} "
        + _long(
            "readings",
            {c: f"count(DISTINCT {c})" for c in ("city", "location", "pollutant")},
            "column",
            "distinct_values",
        ),
    ),
    "distinct_values": Query(
        distinct_values, f"WITH {READINGS} SELECT DISTINCT pollutant FROM readings"
    ),
    "summary_stats": Query(summary_stats, f"WITH {READINGS} {_STATS}"),
    "sink_roundtrip": Query(sink_roundtrip, f"WITH {READINGS} SELECT {_FIVE} FROM readings"),
}
