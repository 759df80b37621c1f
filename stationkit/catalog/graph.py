"""Station graph queries, and the edge-list operators on suppliers and parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationkit.catalog.base import FEATURES, Query, r4, readings, shown, table
from stationkit.operators import alike, relations
from stationkit.operators import graph as ops
from stationkit.operators.features import global_index
from stationkit.plans.stored import store

# Stations are alike from this correlation of their daily values, over so many common days.
ALIKE = 0.5
LEVELS, LEVEL_STEP = 7, 80
MIN_OVERLAP = 5
PARTNERS = 3


def _levelled(spark: SparkSession, folder: str) -> DataFrame:
    """Readings with a level of their own for each station.

    The given values have the same distribution everywhere, so that all stations
    would be alike and no limit would exclude a pair.
    """
    level = F.substring("location", 2, 20).cast("bigint") % LEVELS
    return readings(spark, folder).withColumn("value", F.col("value") + level * LEVEL_STEP)


def _vertices(spark: SparkSession, folder: str) -> DataFrame:
    return store(ops.stations(global_index(_levelled(spark, folder))), "stations").df


def _given_vertices(spark: SparkSession, folder: str) -> DataFrame:
    """Stations numbered by the values as they are, of which nearly all are alike."""
    return store(ops.stations(global_index(readings(spark, folder))), "stations").df


def station_index(spark: SparkSession, folder: str) -> DataFrame:
    return shown(ops.station_index(global_index(_levelled(spark, folder))))


def stations(spark: SparkSession, folder: str) -> DataFrame:
    return shown(ops.stations(global_index(_levelled(spark, folder))))


def station_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return shown(ops.station_pairs(_given_vertices(spark, folder)))


def graph_edges(spark: SparkSession, folder: str) -> DataFrame:
    return shown(ops.graph_edges(_given_vertices(spark, folder)))


def degrees(spark: SparkSession, folder: str) -> DataFrame:
    return ops.band_degrees(_vertices(spark, folder))


def graph_size(spark: SparkSession, folder: str) -> DataFrame:
    return ops.graph_size(ops.band_degrees(_vertices(spark, folder)))


def pagerank(spark: SparkSession, folder: str) -> DataFrame:
    return shown(ops.band_pagerank(_vertices(spark, folder)).drop("avg_global_index"))


def pagerank_top(spark: SparkSession, folder: str) -> DataFrame:
    ranks = ops.band_pagerank(_vertices(spark, folder)).drop("avg_global_index")
    return shown(ops.pagerank_top(ranks))


def _supply(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Suppliers and parts as vertices, every line item as an edge."""
    edges = table(spark, folder, "lineitem").select(
        (F.col("l_suppkey") * 2).alias("src"),
        (F.col("l_partkey") * 2 + 1).alias("dst"),
        F.col("l_discount").alias("diff"),
    )
    suppliers = table(spark, folder, "supplier").select((F.col("s_suppkey") * 2).alias("station_id"))
    parts = table(spark, folder, "part").select((F.col("p_partkey") * 2 + 1).alias("station_id"))
    return suppliers.unionByName(parts), edges


def canonical_edges(spark: SparkSession, folder: str) -> DataFrame:
    return shown(ops.canonical_edges(_supply(spark, folder)[1]))


def edge_degrees(spark: SparkSession, folder: str) -> DataFrame:
    vertices, edges = _supply(spark, folder)
    return ops.degrees(vertices, ops.canonical_edges(edges))


def edge_pagerank(spark: SparkSession, folder: str) -> DataFrame:
    vertices, edges = _supply(spark, folder)
    return shown(ops.pagerank(vertices, ops.canonical_edges(edges)))


def _correlations(spark: SparkSession, folder: str, best: int | None = None) -> DataFrame:
    day = F.date_trunc("day", "last_updated")
    averages = relations.bucket_averages(
        _levelled(spark, folder), _vertices(spark, folder), day
    )
    return alike.correlated_stations(averages, ALIKE, MIN_OVERLAP, best=best)


def station_corr(spark: SparkSession, folder: str) -> DataFrame:
    return shown(_correlations(spark, folder))


def similar_stations(spark: SparkSession, folder: str) -> DataFrame:
    return shown(relations.similar_stations(_correlations(spark, folder, PARTNERS), PARTNERS))


def station_groups(spark: SparkSession, folder: str) -> DataFrame:
    return relations.station_groups(relations.hour_profiles(readings(spark, folder)))


_FEATURES = FEATURES.replace(
    "AS pollutant, value,", f"AS pollutant, value + user_id % {LEVELS} * {LEVEL_STEP} AS value,"
)
_NUMBERED = """indexed AS (
  SELECT city, location, avg(global_index) AS avg_global_index,
         CAST(round(avg(global_index) * 1000000000) AS BIGINT) AS units
  FROM features GROUP BY city, location),
stations AS (
  SELECT row_number() OVER (ORDER BY units NULLS LAST, city, location) - 1 AS station_id, *
  FROM indexed)"""
_STATIONS = f"{_FEATURES}, {_NUMBERED}"
_GIVEN_STATIONS = f"{FEATURES}, {_NUMBERED}"


def _edges(width: float) -> str:
    return f"""edges AS (
  SELECT a.station_id AS src, b.station_id AS dst, (b.units - a.units) / 1e9 AS diff
  FROM stations a JOIN stations b
    ON a.station_id < b.station_id AND abs(b.units - a.units) < {round(width * ops.UNITS)})"""


def _ranks(vertices: str, edges: str) -> str:
    """Rounds until no rank moves more than the tolerance, then scaled."""
    return f"""out AS (SELECT src, count(*) AS n FROM {edges} GROUP BY src),
rounds(step, id, rank) AS (
  SELECT 0, station_id, 1::DOUBLE FROM {vertices}
  UNION ALL
  SELECT x.step + 1, x.id, 0.15 + 0.85 * coalesce(sum(y.rank / out.n), 0)
  FROM rounds x LEFT JOIN {edges} e ON e.dst = x.id
    LEFT JOIN rounds y ON y.id = e.src LEFT JOIN out ON out.src = e.src
  WHERE x.step < 120 GROUP BY x.step, x.id),
moves AS (
  SELECT a.step, max(abs(a.rank - b.rank)) AS moved
  FROM rounds a JOIN rounds b ON a.id = b.id AND a.step = b.step + 1 GROUP BY a.step),
ranked AS (
  SELECT id AS station_id, rank * count(*) OVER () / sum(rank) OVER () AS pagerank
  FROM rounds WHERE step = (SELECT min(step) FROM moves WHERE moved <= 1e-4))"""


_SUPPLY = """vertices AS (
  SELECT s_suppkey * 2 AS station_id FROM supplier
  UNION ALL SELECT p_partkey * 2 + 1 FROM part),
links AS (
  SELECT least(l_suppkey * 2, l_partkey * 2 + 1) AS src,
         greatest(l_suppkey * 2, l_partkey * 2 + 1) AS dst, min(l_discount) AS diff
  FROM lineitem GROUP BY 1, 2)"""

_RANKED = f"""WITH RECURSIVE {_STATIONS}, {_edges(0.2)}, {_ranks("stations", "edges")},
named AS (SELECT station_id, city, location, pagerank FROM ranked JOIN stations USING (station_id))"""

_CORR = f"""{_STATIONS}, levels AS (
  SELECT station_id, pollutant, date_trunc('day', last_updated) AS bucket, avg(value) AS level
  FROM readings JOIN stations USING (city, location) GROUP BY ALL),
centred AS (
  SELECT *, level - avg(level) OVER s AS off, count(*) OVER s AS days,
         min(level) OVER s < max(level) OVER s AS varies
  FROM levels WINDOW s AS (PARTITION BY station_id, pollutant)),
scaled AS (
  SELECT *, off / sqrt(sum(off * off) OVER (PARTITION BY station_id, pollutant)) AS z
  FROM centred WHERE varies AND days >= {MIN_OVERLAP}),
correlated AS (
  SELECT a.station_id AS src, b.station_id AS dst, a.pollutant, sum(a.z * b.z) AS corr,
         count(*) AS overlap
  FROM scaled a JOIN scaled b ON a.pollutant = b.pollutant AND a.bucket = b.bucket
    AND a.station_id < b.station_id
  GROUP BY ALL HAVING count(*) >= {MIN_OVERLAP} AND sum(a.z * b.z) >= {ALIKE})"""

QUERIES = {
    "station_index": Query(
        station_index,
        f"WITH {_STATIONS} SELECT city, location, {r4('avg_global_index')} FROM stations",
    ),
    "stations": Query(
        stations,
        f"WITH {_STATIONS} SELECT station_id, city, location, {r4('avg_global_index')} FROM stations",
    ),
    "station_pairs": Query(
        station_pairs,
        f"""WITH {_GIVEN_STATIONS} SELECT a.city AS city1, a.location AS location1, b.city AS city2,
        b.location AS location2, {r4("abs(a.units - b.units) / 1e9", "diff")}
        FROM stations a JOIN stations b ON a.station_id <> b.station_id
        WHERE abs(a.units - b.units) < 200000000""",
    ),
    "graph_edges": Query(
        graph_edges,
        f"WITH {_GIVEN_STATIONS}, {_edges(0.2)} SELECT src, dst, {r4('diff')} FROM edges",
    ),
    "degrees": Query(
        degrees,
        f"""WITH {_STATIONS}, {_edges(0.2)},
        ends AS (SELECT src AS station_id FROM edges UNION ALL SELECT dst FROM edges)
        SELECT station_id, city, location,
        (SELECT count(*) FROM ends e WHERE e.station_id = s.station_id) AS degree
        FROM stations s""",
    ),
    "graph_size": Query(
        graph_size,
        f"""WITH {_STATIONS}, {_edges(0.2)} SELECT (SELECT count(*) FROM stations) AS vertices,
        (SELECT count(*) FROM edges) AS edges""",
    ),
    "pagerank": Query(
        pagerank, f"{_RANKED} SELECT station_id, city, location, {r4('pagerank')} FROM named"
    ),
    "pagerank_top": Query(
        pagerank_top,
        f"""{_RANKED}, top AS (SELECT * FROM named ORDER BY pagerank DESC, station_id LIMIT 10)
        SELECT station_id, city, location, {r4("pagerank")} FROM top""",
    ),
    "canonical_edges": Query(
        canonical_edges, f"WITH {_SUPPLY} SELECT src, dst, {r4('diff')} FROM links"
    ),
    "edge_degrees": Query(
        edge_degrees,
        f"""WITH {_SUPPLY},
        ends AS (SELECT src AS station_id FROM links UNION ALL SELECT dst FROM links)
        SELECT station_id, count(*) AS degree FROM ends JOIN vertices USING (station_id)
        GROUP BY station_id""",
    ),
    "edge_pagerank": Query(
        edge_pagerank,
        f"""WITH RECURSIVE {_SUPPLY}, {_ranks("vertices", "links")}
        SELECT station_id, {r4("pagerank")} FROM ranked""",
    ),
    "station_corr": Query(
        station_corr, f"WITH {_CORR} SELECT src, dst, pollutant, {r4('corr')}, overlap FROM correlated"
    ),
    "similar_stations": Query(
        similar_stations,
        f"""WITH {_CORR}, both_ways AS (
          SELECT src AS station_id, dst AS partner_id, pollutant, corr, overlap FROM correlated
          WHERE corr IS NOT NULL
          UNION ALL SELECT dst, src, pollutant, corr, overlap FROM correlated WHERE corr IS NOT NULL),
        ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY station_id, pollutant
          ORDER BY round(corr, 9) DESC, partner_id) AS INTEGER) AS rank FROM both_ways)
        SELECT station_id, partner_id, pollutant, {r4("corr")}, overlap, rank
        FROM ranked WHERE rank <= 3""",
    ),
    "station_groups": Query(station_groups),
}
