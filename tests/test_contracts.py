"""Bad or unusual data: missing coordinates, long ids, shared keys, fractions, headers that differ."""

import pytest
from pyspark.sql import functions as F

from lodestay import DataError
from lodestay.functions.geo import haversine_km
from lodestay.operators.columns import set_types
from lodestay.operators.spatial import nearest_k
from lodestay.operators.split import split_exact
from lodestay.rules import City
from lodestay.sources.listings import read_cities, read_listings
from lodestay.sources.reports import save_report


def test_distance_of_missing_coordinates(spark):
    row = spark.range(1).select(haversine_km(F.lit(None).cast("double"), F.lit(23.7), F.lit(37.9), F.lit(23.7)).alias("km")).first()
    assert row.km is None


def test_ordered_split_of_long_ids(spark):
    ids = [9007199254740993 + 997 * 10 ** 15 + i for i in range(10)]
    df = spark.createDataFrame([(c, i) for c in ("x", "y") for i in ids], "city string, id long")
    for by in ((), ("city",)):
        part = df if by else df.where("city = 'x'").drop("city")
        marked = split_exact(part, 0.2, key=("id",), by=by, random_selection=False)
        assert sorted({r.id for r in marked.where("is_test").collect()}) == ids[8:]
        assert marked.where("is_test").count() == (4 if by else 2)


def test_nearest_needs_distinct_keys_and_coordinates(spark):
    points = spark.createDataFrame([(1, 40.0, 2.0), (2, 40.1, 2.1), (3, None, 2.0)], "pid int, latitude double, longitude double")
    asked = spark.createDataFrame([(7, 40.0, 2.0), (8, None, 2.0)], "qid int, latitude double, longitude double")
    found = nearest_k(asked, points, 2, query_key=["qid"], order_by=["pid"]).collect()
    assert sorted((r.qid, r.pid) for r in found) == [(7, 1), (7, 2)]
    with pytest.raises(DataError, match="two queries"):
        nearest_k(asked.unionAll(asked), points, 2, query_key=["qid"], order_by=["pid"])


def test_fractions_are_not_cut(spark):
    df = spark.createDataFrame([(3.0,), (None,)], "beds double")
    assert [r.beds for r in set_types(df, {"beds": "int"}).collect()] == [3, None]
    half = spark.createDataFrame([(3.5,)], "beds double")
    assert set_types(half, {"beds": "int"}, lenient=True).first().beds is None
    with pytest.raises(Exception, match="not a whole number"):
        set_types(half, {"beds": "int"}).collect()


def test_headers_that_differ(spark, tmp_path):
    (tmp_path / "rome_listings.csv").write_text("id,price,beds\n1,$10,2\n")
    (tmp_path / "oslo_listings.csv").write_text("beds,extra,id,price\n4,z,2,$20\n")
    paths = [str(tmp_path / f"{c}_listings.csv") for c in ("rome", "oslo")]
    got = read_listings(spark, paths, ["id", "price", "beds"]).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "$10", 2.0, "rome"), (2, "$20", 4.0, "oslo")]


def test_ordered_split_needs_every_key(spark):
    df = spark.createDataFrame([(i if i % 5 else None,) for i in range(100)], "id long")
    with pytest.raises(DataError, match="missing value in column id"):
        split_exact(df, 0.2, random_selection=False)
    assert split_exact(df.filter("id is not null"), 0.25, random_selection=False).filter("is_test").count() == 20


def test_random_split_follows_the_digest(spark, monkeypatch):
    """The same rows as a ranking of all, with brackets of a few rows."""
    import hashlib

    from lodestay.operators import split

    ranked = split.select_ranks
    monkeypatch.setattr(split, "select_ranks", lambda *a: ranked(*a, bracket_rows=5, cells=4))
    keys = [(g, i) for g in ("a", "b") for i in range(300)]
    df = spark.createDataFrame(keys, "city string, id int").repartition(5)
    marked = split_exact(df, 0.3, seed=9, by=["city"]).collect()
    for city in ("a", "b"):
        order = sorted(range(300), key=lambda i: hashlib.md5(f"{i}:9".encode()).hexdigest())
        assert sorted(r.id for r in marked if r.city == city and r.is_test) == sorted(order[210:])
    twice = spark.createDataFrame([(1,)] * 10 + [(2,)], "id int")
    assert split_exact(twice, 0.5, seed=1).filter("is_test").count() in (0, 1, 10)


def test_a_failed_report_leaves_the_old_one(spark, tmp_path):
    path = f"{tmp_path}/report"
    save_report(spark.range(5), path)
    broken = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") == 900, F.raise_error(F.lit("half way")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="half way"):
        save_report(broken, path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(5)) and [p.name for p in tmp_path.iterdir()] == ["report"]
    save_report(spark.read.parquet(path).filter("id > 2"), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [3, 4] and [p.name for p in tmp_path.iterdir()] == ["report"]


def test_cities_without_line_breaks_are_read_by_many_tasks(spark, tmp_path):
    lines = ["id,note,price"] + [f'{i},"a, ""quoted"" note",$1' for i in range(4000)]
    for city in ("Athens", "Madrid"):
        (tmp_path / f"{city.lower()}_listings.csv").write_text("\n".join(lines))
    cities = {c: City(0.0, 0.0, "EUR") for c in ("Athens", "Madrid", "Nowhere")}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        whole, split = (read_cities(spark, cities, str(tmp_path), ("id", "note"), multi_line=m) for m in (True, False))
        assert split.rdd.getNumPartitions() > whole.rdd.getNumPartitions()
        assert sorted(whole.collect()) == sorted(split.collect()) and split.groupBy("city").count().orderBy("city").collect() == [("Athens", 4000), ("Madrid", 4000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
