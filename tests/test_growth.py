"""Steps whose cost must not grow faster than their rows."""

import hashlib
from types import SimpleNamespace

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from lodestay.functions.text import parse_bathrooms
from lodestay.operators import split
from lodestay.operators.rows import dedupe_first
from lodestay.plans import scoring
from lodestay.sources.listings import read_listings
from lodestay.workload.cleaning import scan_cities
from lodestay.workload.fixture import FIXTURE_CITIES, listings


def _star_schema(spark, folder, cities):
    """Two order lines a city, and one whose city is missing."""
    names = [*cities, None]
    tables = {
        "region": ([(k, name) for k, name in enumerate(names)], "r_regionkey int, r_name string"),
        "nation": ([(k, f"n{k}", k) for k in range(len(names))], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(k + 1, k) for k in range(len(names))], "c_custkey long, c_nationkey int"),
        "orders": ([(k + 1, k + 1, "1-URGENT") for k in range(len(names))], "o_orderkey long, o_custkey long, o_orderpriority string"),
        "part": ([(1, 10), (2, 40)], "p_partkey long, p_size int"),
        "lineitem": ([(k + 1, line, line, 5, 3.0, 0.1, "N") for k in range(len(names)) for line in (1, 2)],
                     "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_tax double, l_returnflag string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_cities_are_written_in_one_pass_and_read_back_whole(spark, tmp_path, monkeypatch):
    folder, written = _star_schema(spark, tmp_path, FIXTURE_CITIES), []
    plain = DataFrameWriter.csv
    monkeypatch.setattr(DataFrameWriter, "csv", lambda self, path, *a, **b: (written.append(path), plain(self, path, *a, **b))[1])
    got = sorted((r.city, r.id, r.price) for r in scan_cities(spark, folder).collect())
    assert len(written) == 1
    assert got == sorted((r.city, r.id, r.price) for r in listings(spark, folder).filter("city IS NOT NULL").collect()) and len(got) == 10


def test_a_city_without_listings_leaves_an_empty_file(spark, tmp_path):
    some = list(FIXTURE_CITIES)[:2]
    got = scan_cities(spark, _star_schema(spark, tmp_path, some)).collect()
    assert sorted({r.city for r in got}) == sorted(some) and len(got) == 4


def test_the_city_is_looked_for_in_the_last_names_of_a_path(spark, tmp_path):
    folder = tmp_path / "north_listings.csv" / "new york_listings.csv"
    spark.createDataFrame([(1,), (2,)], "id long").write.option("header", True).csv(str(folder))
    rows = read_listings(spark, str(folder), ["id"])
    assert {r.file_city for r in rows.collect()} == {"new york"}
    assert "substring_index" in rows._jdf.queryExecution().optimizedPlan().toString()


def test_rows_are_sorted_by_numbers_before_texts(spark):
    df = spark.createDataFrame([("x", 1, 2), ("x", 1, 1), ("y", 1, 3), (None, None, 4), (None, None, 5)], "city string, id long, at int")
    kept = dedupe_first(df, ["city", "id"], ["at"])
    assert sorted(r.at for r in kept.collect()) == [1, 3, 4] and kept.columns == df.columns
    assert "Sort [id" in kept._jdf.queryExecution().executedPlan().toString()


def test_apartments_of_one_task_are_dealt_out_before_they_are_priced(spark, monkeypatch):
    class Seen(Exception):
        pass

    def price(prepared, *args, **options):
        raise Seen(prepared.rdd.getNumPartitions(), sorted(r.id for r in prepared.collect()))

    monkeypatch.setattr(scoring, "price_apartments", price)
    one = spark.createDataFrame([("x", k) for k in range(50)], "city string, id long").coalesce(1)
    with pytest.raises(Seen) as seen:
        scoring.prediction_run(one, SimpleNamespace(by=("city",)))
    assert seen.value.args == (int(spark.conf.get("spark.sql.shuffle.partitions")), list(range(50)))


def _split_in_python(rows, fraction, seed):
    """(group, key) -> is_test for whole groups in the order of digest and key; copies of a key have one side."""
    sides = {}
    for group in {g for g, _ in rows}:
        def order(k):
            return hashlib.md5((f"{seed}" if k is None else f"{k}:{seed}").encode()).hexdigest(), k is not None, k or 0
        own = sorted((k for g, k in rows if g == group), key=order)
        last = own[len(own) - round(fraction * len(own)) - 1]
        sides |= {(group, k): order(k) > order(last) for k in own}
    return sides


@pytest.mark.parametrize("cell_rows", [500_000, 3])
def test_random_split_reads_its_rows_twice_whatever_their_digests(spark, monkeypatch, cell_rows):
    rows = [(g, k) for g in ("a", "b", None) for k in [*range(400), None, *[7] * 50]]
    df = spark.createDataFrame(rows, "g string, k long")

    def narrowed_step_by_step(*_, **__):
        raise AssertionError("the digests were narrowed by approximate quantiles, several passes over all rows")

    monkeypatch.setattr(split, "select_ranks", narrowed_step_by_step)
    monkeypatch.setattr(split, "CELL_ROWS", cell_rows, raising=False)
    monkeypatch.setattr(split, "DIGITS", 1, raising=False)
    got = split.split_exact(df, 0.2, seed=42, key=["k"], by=["g"]).collect()
    assert len(got) == len(rows)
    assert {(r.g, r.k): r.is_test for r in got} == _split_in_python(rows, 0.2, 42)
    alone = split.split_exact(df.filter("g = 'a'"), 0.2, seed=42, key=["k"]).collect()
    assert {(r.g, r.k): r.is_test for r in alone} == _split_in_python([r for r in rows if r[0] == "a"], 0.2, 42)


def _operators(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_operators_over_wide_rows_work_by_small_projections(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(20).select("id", *[(F.col("id") % k).cast("double").alias(f"c{k}") for k in range(1, 40)]).write.parquet(path)
    wide = spark.read.parquet(path).filter("c3 > 0").withColumns({f"c{k}": F.col(f"c{k}") + k for k in range(1, 40)})
    assert "*(1)" not in _operators(wide) and "*(1)" in _operators(spark.read.parquet(path).filter("c3 > 0").select(F.col("c2") + 1))
    assert sorted(r.c39 for r in wide.select("c39").collect()) == sorted(float(k + 39) for k in range(20) if k % 3)


def test_bathroom_texts_are_read_without_a_pattern_or_an_exception_a_row(spark):
    want = {"3 baths": 3.0, "  1.5 shared": 1.5, "Half-bath": 0.5, "Private half-bath": 0.5, "Bathroom": None, "": None, "   ": None, "\t2 baths": None,
            "2\tbaths": 2.0, "1e1 baths": 10.0, "-2 baths": -2.0, "Infinity baths": float("inf"), "-inf": float("-inf"), "2d": 2.0, "0x1p3": 8.0,
            "2,5 baths": None, "information": None, "bath 2": None, "\u0663 baths": None, None: None}
    df = spark.createDataFrame([(t,) for t in want], "t string").select("t", parse_bathrooms(F.col("t")).alias("n"))
    assert {r.t: r.n for r in df.collect()} == want
    assert "split(" not in df._jdf.queryExecution().optimizedPlan().toString()
