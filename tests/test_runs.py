import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lodestay import (Fitted, RuleError, analysis_run, drop_versions, inference_run, load_version, market_findings, prediction_run,
                      pricing_report, publish_version, score_rows, stream_refreshed, training_run, version_names)
from lodestay.errors import DataError
from lodestay.operators.market import market_overview, price_boxplot, price_histogram
from lodestay.rules import AMENITIES, Rules
from lodestay.sources.listings import (apartments_from_answers, available_cities, city_path, read_apartments, read_cities,
                                       read_csv, read_listings)
from lodestay.sources.reports import save_report
from lodestay.workload.fixture import ORDER, RULES, apartments, listings
from tests.compare import connect, differences

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.exists(SF), reason="no test tables")
SMALL_RULES = replace(RULES, category=replace(RULES.category, min_count=15))


def test_csv_reading(spark, tmp_path):
    path = tmp_path / "athens_listings.csv"
    path.write_text('id,price,room_type,amenities\n1,"$1,712.00",A,"[""Wifi"", ""TV""]"\n2,$50.00,B,"two\nlines"\n')
    df = read_csv(spark, str(path))
    assert df.columns == ["id", "price", "room_type", "amenities"] and df.count() == 2
    rows = read_listings(spark, str(path), ["id", "price", "amenities"]).orderBy("id").collect()
    assert rows[0].amenities == '["Wifi", "TV"]' and rows[1].amenities == "two\nlines"
    assert rows[0].id == 1 and rows[0].price == "$1,712.00" and rows[0].file_city == "athens"
    with pytest.raises(RuleError):
        read_csv(spark, str(tmp_path / "absent.csv"))
    with pytest.raises(RuleError, match="beds"):
        read_listings(spark, str(path), ["id", "beds"])
    cities = Rules().cities
    assert city_path("Athens", str(tmp_path)) == str(path)
    assert available_cities(spark, cities, str(tmp_path)) == ["Athens"]
    assert available_cities(spark, cities, str(tmp_path / "none")) == []
    with pytest.raises(RuleError):
        read_cities(spark, cities, str(tmp_path / "none"))


def test_apartment_answers(spark):
    df = apartments_from_answers(spark, {"bedrooms": 2, "accommodates": 4})
    assert df.columns == ["accommodates", "bedrooms"] and df.count() == 1
    with pytest.raises(RuleError, match="bedrooms"):
        apartments_from_answers(spark, {"bedrooms": None})
    table = spark.createDataFrame([(1, 2), (2, None)], "b int, a int")
    with pytest.raises(DataError, match="missing answer for a"):
        read_apartments(table)
    assert read_apartments(table, ["b"]).columns == ["a", "b"]


def test_save_report(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "x int")
    path = str(tmp_path / "report")
    save_report(df, path)
    assert save_report(df.union(df), path).endswith("/report")
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(RuleError):
        save_report(df, str(tmp_path / "no" / "folder"))


def test_market_tables(spark):
    df = spark.createDataFrame([("E", p, 10.0 * p) for p in (40.0, 60.0, 80.0, 100.0, 120.0, 140.0)] + [("P", None, 5.0)],
                               "room_type string, price double, estimated_revenue double")
    row = market_overview(df.filter("price IS NOT NULL")).first()
    assert (row.listings, row.price_median, row.price_q1, row.price_q3) == (6, 90.0, 65.0, 115.0)
    bins = price_histogram(df, nbins=5).orderBy("bin").collect()
    assert [r.n for r in bins] == [1, 1, 1, 1, 2] and (bins[0].bin_start, bins[-1].bin_end) == (40.0, 140.0)
    boxes = price_boxplot(df, 2).collect()
    assert [(r.room_type, r.n, r.low, r.median, r.high) for r in boxes] == [("E", 6, 40.0, 90.0, 140.0)]
    assert price_boxplot(df, 99).count() == 0


@pytest.fixture(scope="module")
def run(spark):
    df, fitted = training_run(listings(spark, SF), SMALL_RULES, order_by=ORDER, keep=("copy_order",))
    return df, fitted, analysis_run(df, SMALL_RULES)


@needs_data
def test_training_invariants(spark, run):
    df, _, _ = run
    raw = listings(spark, SF).count()
    rows = df.count()
    assert rows > 0.3 * raw and rows > 1000
    predictors = {p for m in SMALL_RULES.models for p in m.predictors}
    bad = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in predictors]).first()
    assert not any(bad.asDict().values())
    assert df.filter("price <= 0 OR estimated_revenue <= 0").count() == 0
    assert df.filter("isnan(occupancy_rate) OR isnan(ratio_occupancy_availability)").count() == 0
    for a in AMENITIES:
        assert sorted(r[0] for r in df.select(a).distinct().collect()) == [0, 1]


@needs_data
@pytest.mark.parametrize("column,message", [("accommodates", "accommodates"), ("amenities", "amenities")])
def test_training_reports_missing_values(spark, column, message):
    raw = listings(spark, SF)
    gap = raw.withColumn(column, F.when(F.col("room_type") != "Shared room", F.col(column)))
    with pytest.raises(DataError, match=message):
        training_run(gap, SMALL_RULES, order_by=ORDER, keep=("copy_order",))


@needs_data
def test_analysis_invariants(run):
    df, _, analysis = run
    train, test = analysis.train, analysis.test
    assert train.count() + test.count() == df.count()
    assert train.select("city", "id").intersect(test.select("city", "id")).count() == 0
    for r in df.groupBy("city").count().collect():
        assert test.filter(F.col("city") == r.city).count() == round(0.2 * r["count"])
    scores = {(r.city, r.model): r.r2_model_scale for r in analysis.scores.collect()}
    assert len(scores) == 15 and all(v > 0.4 for (_, m), v in scores.items() if m == "price")


@needs_data
def test_prediction_invariants(spark, run, tmp_path):
    _, fitted, analysis = run
    fitted.save(str(tmp_path / "fitted"))
    loaded = Fitted.load(spark, str(tmp_path / "fitted"))
    before = apartments(spark, SF)
    prepared = inference_run(before, loaded, SMALL_RULES)
    assert prepared.count() == before.count()
    bundle = prediction_run(prepared, analysis, SMALL_RULES)
    rows = bundle.collect()
    assert len(rows) == before.count()
    for r in rows:
        p = r.price_range
        assert p.lower <= p.median <= p.upper and p["mean"] >= p.median
        assert r.revenue.estimate == pytest.approx(p["mean"] * r.nights)
        assert (r.assessment.status is None) == (r.group == "new") == (r.revenue.lower is None)
        assert 1 <= len(r.comparables) <= 5
        distances = [c.distance_km for c in r.comparables]
        assert distances == sorted(distances)
        changes = [t.change for t in r.tips]
        assert changes == sorted(changes, reverse=True)
    report = pricing_report(bundle, SMALL_RULES)
    assert report.filter("size(tips) > 3").count() == 0
    assert report.filter("status IS NOT NULL AND message IS NULL").count() == 0
    with pytest.raises(DataError, match="listed or new"):
        prediction_run(prepared.withColumn("group", F.lit("old")), analysis, SMALL_RULES)
    with pytest.raises(RuleError, match="is_superhost"):
        inference_run(before.drop("is_superhost"), fitted, SMALL_RULES)


@needs_data
def test_stream_takes_a_new_fit_between_batches(spark, run, tmp_path):
    _, fitted, analysis = run
    root, feed, output = (str(tmp_path / n) for n in ("versions", "feed", "out"))
    source = apartments(spark, SF).filter("id < 60").withColumn("latitude", F.when(F.col("id") % 7 > 0, F.col("latitude")))
    with pytest.raises(RuleError, match="no version"):
        stream_refreshed(spark.readStream.schema(source.schema).parquet(str(tmp_path)), root, output=output, checkpoint=str(tmp_path / "c"))
    half = replace(analysis.fits, table=replace(analysis.fits.table, frame=analysis.fits.table.frame.withColumn("smearing", F.lit(0.5))))
    names = [publish_version(fitted, half, root)]
    assert version_names(spark, root) == names and load_version(spark, root, SMALL_RULES).name == names[0]
    source.filter("id < 30").write.parquet(feed)
    stream = stream_refreshed(spark.readStream.schema(source.schema).parquet(feed), root, output=output, checkpoint=str(tmp_path / "c"),
                              rules=SMALL_RULES, available_now=False)
    try:
        stream.processAllAvailable()
        names.append(publish_version(fitted, analysis.fits, root))
        source.filter("id >= 30").write.mode("append").parquet(feed)
        stream.processAllAvailable()
    finally:
        stream.stop()
    rejected = spark.read.parquet(f"{output}/rejected")
    assert {(r.id, r.reject_reason) for r in rejected.collect()} == {(r.id, "missing latitude") for r in source.filter("latitude IS NULL").collect()}
    for fits, part, name in ((half, "id < 30", names[0]), (analysis.fits, "id >= 30", names[1])):
        want = {r.id: r for r in score_rows(source, fitted, fits, SMALL_RULES).filter(part).filter("latitude IS NOT NULL").collect()}
        made = {r.id: r for r in spark.read.parquet(f"{output}/scored").filter(part).collect()}
        assert made.keys() == want.keys() and want
        for i, r in want.items():
            assert made[i].fit_version == name and made[i]["mean"] == pytest.approx(r["mean"]) and made[i].lower == pytest.approx(r.lower)
    with pytest.raises(RuleError, match="other predictors: price"):
        load_version(spark, root, replace(SMALL_RULES, models=tuple(replace(m, predictors=m.predictors[1:]) if m.name == "price" else m
                                                                    for m in SMALL_RULES.models)))
    with pytest.raises(RuleError, match="no version"):
        load_version(spark, root, SMALL_RULES, "000000000009-" + "0" * 32)
    # a version that was never finished has no name
    (tmp_path / "versions" / "state-unfinished").mkdir()
    assert drop_versions(spark, root, keep=1) == names[:1] and version_names(spark, root) == names[1:]
    assert load_version(spark, root, SMALL_RULES).name == names[1]


@needs_data
def test_findings(run):
    _, _, analysis = run
    sections = {r.section for r in market_findings(analysis, SMALL_RULES).collect()}
    assert {"overview", "model quality", "what drives the price", "in detail"} == sections


@needs_data
def test_one_city_without_key(spark):
    raw = listings(spark, SF).filter("city = 'EUROPE'").drop("city")
    one, fitted = training_run(raw, SMALL_RULES, by=(), city="EUROPE", order_by=ORDER, keep=("copy_order",))
    analysis = analysis_run(one, SMALL_RULES, by=())
    assert analysis.scores.count() == 3
    asked = apartments(spark, SF).filter("city = 'EUROPE' AND room_type = 'Entire home/apt'").drop("city")
    priced = prediction_run(inference_run(asked, fitted, SMALL_RULES), analysis, SMALL_RULES)
    assert priced.filter("price_range.median > 0").count() == asked.count()


QUICK = ("scan_cities", "dedupe_first", "missing_rules", "cap_values", "nearest_category", "split_exact", "ols_fit",
         "group_importance", "price_range", "training_run", "prediction_run_small", "stream_score", "stream_refreshed",
         "training_run_snapshots", "ols_fit_snapshots")


@needs_data
@pytest.mark.parametrize("name", QUICK)
def test_query_matches_sql(spark, name):
    import __spark_entry__ as entry

    got = entry.queries()[name](spark, SF).toPandas()
    assert differences(got, connect(SF).execute(entry.oracle_sql()[name]).df()) is None


def test_every_check_has_a_query():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
