import pytest
from pyspark.sql import functions as F
from stationkit.operators import features, relations, reports
from stationkit.plans import flow


def wide(spark):
    a = (1.0, 2.0, 3.0, None, 5.0)
    b = (2.0, 4.5, None, 1.0, 9.0)
    return spark.createDataFrame(list(zip(a, b, strict=True)), "a double, b double")


def test_correlation_modes(spark):
    zero = relations.pollutant_corr(wide(spark)).first()
    assert (zero.pollutant_a, zero.pollutant_b) == ("a", "b")
    assert zero.corr == pytest.approx(0.7115, abs=1e-4)
    pairwise = relations.pollutant_corr(wide(spark), missing="pairwise").first()
    assert pairwise.corr == pytest.approx(0.9931, abs=1e-4)
    with pytest.raises(ValueError):
        relations.pollutant_corr(wide(spark), missing="drop")


def test_constant_column_has_no_correlation(spark):
    flat = wide(spark).withColumn("b", F.lit(3.0))
    for mode in ("zero", "pairwise"):
        assert relations.pollutant_corr(flat, missing=mode).first().corr is None


def test_pivot_finds_its_columns(make_readings):
    rows = make_readings([("a", "b", p, v, 0) for p, v in (("O3", 1.0), ("O3", 3.0), ("NO2", 4.0))])
    row = relations.pollutant_pivot(rows).first()
    assert (row.O3, row.NO2) == (2.0, 4.0)


def test_high_events_are_strictly_above(make_readings):
    rows = make_readings([("a", "b", "O3", v, 0) for v in (100.0, 100.1)])
    assert reports.high_events(rows).first().high_pollution_count == 1


def test_anomalies_on_both_sides(make_readings):
    values = [50.0] * 200 + [51.0] * 200 + [500.0, -400.0]
    found = reports.anomaly_3sigma(make_readings([("a", "b", "O3", v, 0) for v in values]))
    assert sorted(r.value for r in found.collect()) == [-400.0, 500.0]


def test_sorted_reports_break_ties_by_name(make_readings):
    rows = make_readings([(c, "x", "O3", 1.0, 0) for c in "cab"])
    assert [r.city for r in reports.station_exposure(rows).collect()] == ["a", "b", "c"]


def test_rollup_gives_the_same_reports(spark):
    from stationkit.catalog.base import readings

    dated = features.calendar_features(readings(spark, "/root/testdata/sf0.001"))
    derived = flow.reports_from_rollup(flow.rollup(dated))
    for name, direct in flow.reports_from_features(dated).items():

        def rounded(df, columns=direct.columns, types=dict(direct.dtypes)):
            return df.select(
                *(F.round(F.col(c) + 1e-7, 5).alias(c) if types[c] == "double" else F.col(c)
                  for c in columns)
            )

        assert rounded(direct).exceptAll(rounded(derived[name])).count() == 0, name
        assert direct.count() == derived[name].count()


def test_station_correlation_and_partners(spark):
    days = range(6)
    level = {0: [1, 2, 3, 4, 5, 6], 1: [2, 4, 6, 8, 10, 12], 2: [6, 5, 4, 3, 2, 1], 3: [1, 2]}
    rows = [(s, "O3", d, float(level[s][d])) for s in level for d in days if d < len(level[s])]
    averages = spark.createDataFrame(rows, "station_id bigint, pollutant string, bucket int, level double")
    pairs = spark.createDataFrame([(a, b) for a in range(4) for b in range(a + 1, 4)], "src bigint, dst bigint")
    found = relations.station_corr(averages, pairs)
    by_pair = {(r.src, r.dst): (round(r.corr, 6), r.overlap) for r in found.collect()}
    assert by_pair == {(0, 1): (1.0, 6), (0, 2): (-1.0, 6), (1, 2): (-1.0, 6)}
    best = relations.similar_stations(found, 1).collect()
    assert {(r.station_id, r.partner_id) for r in best} == {(0, 1), (1, 0), (2, 0)}


def test_station_correlation_without_broadcast(spark, monkeypatch):
    from stationkit.plans import keyed

    rows = [(s, "O3", d, float((s * 31 + d * d * 7) % 23)) for s in range(12) for d in range(9)]
    averages = spark.createDataFrame(rows, "station_id bigint, pollutant string, bucket int, level double")
    # Station 0 takes part in most pairs.
    pairs = spark.createDataFrame(
        [(0, b) for b in range(1, 12)] + [(3, 4), (4, 11)], "src bigint, dst bigint"
    )
    small = sorted(tuple(r) for r in relations.station_corr(averages, pairs).collect())
    monkeypatch.setattr(keyed, "BROADCAST_BYTES", 0)
    large = sorted(tuple(r) for r in relations.station_corr(averages, pairs).collect())
    assert [r[:3] + r[4:] for r in small] == [r[:3] + r[4:] for r in large]
    assert [r[3] for r in small] == pytest.approx([r[3] for r in large])


def test_partner_ranking_is_trimmed_before_the_shuffle(spark):
    rows = spark.createDataFrame([(0, 1, "O3", 0.5, 9)], "src bigint, dst bigint, pollutant string, corr double, overlap bigint")
    plan = relations.similar_stations(rows)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange")[1]


def test_station_groups_separate_opposite_days(spark):
    hours = [f"h{h:02d}" for h in range(24)]
    rows = []
    for i in range(20):
        high = range(12) if i % 2 else range(12, 24)
        levels = [10.0 + i / 100 if h in high else 1.0 for h in range(24)]
        levels[3] = None if i == 4 else levels[3]
        rows.append(("c", f"s{i}", *levels))
    schema = "city string, location string, " + ", ".join(f"{h} double" for h in hours)
    groups = relations.station_groups(spark.createDataFrame(rows, schema), k=2)
    sides = {}
    for r in groups.collect():
        sides.setdefault(int(r.location[1:]) % 2, set()).add(r.group)
    assert len(sides[0]) == len(sides[1]) == 1 and sides[0] != sides[1]


def test_long_correlation_equals_the_pivot(spark):
    """Sparse cells and a constant pollutant, both ways of counting what is absent."""
    import random

    rnd = random.Random(3)
    names = ["p", "q", "r", "s t"]
    rows = [(c, n, float(rnd.randrange(50)) if n != "r" else 4.0) for c in range(60) for n in names if rnd.random() < 0.6]
    levels = spark.createDataFrame([*rows, (None, "p", 1.0), (1, None, 1.0), (2, "q", None)], "cell int, pollutant string, level double")
    known = levels.na.drop().withColumnsRenamed({"cell": "city"}).withColumns({"location": F.lit("x"), "last_updated": F.lit(0)})
    wide = known.groupBy("city", "location", "last_updated").pivot("pollutant").agg(F.avg("level"))
    for missing in ("zero", "pairwise"):
        pairs = [
            {(r.pollutant_a, r.pollutant_b): r.corr and round(r.corr, 9) for r in df.collect()}
            for df in (relations.pollutant_corr(wide, missing=missing), relations.pollutant_corr_long(levels, missing))
        ]
        assert len(pairs[0]) == 6 and pairs[0] == pairs[1]
    one = levels.where("pollutant = 'p'")
    assert relations.pollutant_corr_long(one).count() == relations.pollutant_corr(wide.select("city", "location", "last_updated", "p")).count() == 0
