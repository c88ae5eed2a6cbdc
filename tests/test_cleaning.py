import math

import pytest
from pyspark.sql import functions as F

from lodestay.errors import DataError, RuleError
from lodestay.functions.text import format_eur, parse_bathrooms
from lodestay.operators.columns import (convert_currency, label_terms, rename_columns, select_columns, set_types)
from lodestay.operators.missing import impute_group_median, missing_rules
from lodestay.operators.quantiles import group_quantiles
from lodestay.operators.rows import dedupe_first, drop_outliers, drop_zero, filter_plausible
from lodestay.rules import City, CurrencyRule, MissingRule, OutlierRule, PlausibilityRule


def column(df, name, order="id"):
    return [r[name] for r in df.orderBy(order).collect()]


def test_select_keeps_order_and_names_unknown(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert select_columns(df, ["c", "a"]).columns == ["c", "a"]
    with pytest.raises(RuleError, match="x, y"):
        select_columns(df, ["a", "x", "y"])


def test_rename_keeps_position(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rename_columns(df, {"a": "z"}).columns == ["z", "b"]
    assert rename_columns(df, {}).columns == ["a", "b"]
    with pytest.raises(RuleError, match="q"):
        rename_columns(df, {"a": "z", "q": "r"})


def test_set_types(spark):
    df = spark.createDataFrame([(1, " $1,250.00 ", 2), (2, None, None), (3, "  ", 4)], "id int, price string, beds int")
    typed = set_types(df, {"price": "double", "beds": "double"})
    assert column(typed, "price") == [1250.0, None, None]
    assert column(typed, "beds") == [2.0, None, 4.0]
    bad = spark.createDataFrame([(1, "abc")], "id int, price string")
    with pytest.raises(Exception, match="abc"):
        set_types(bad, {"price": "double"}).collect()
    assert column(set_types(bad, {"price": "double"}, lenient=True), "price") == [None]
    with pytest.raises(RuleError):
        set_types(df, {"nope": "double"})


def test_convert_currency(spark):
    rule = CurrencyRule(("price",), "EUR", {"USD": 0.89, "EUR": 1.0, "BAD": 0.0})
    df = spark.createDataFrame([(1, "A", 1712.0), (2, "B", 100.0), (3, "A", None)], "id int, city string, price double")
    assert column(convert_currency(df, rule, "USD"), "price") == [pytest.approx(1523.68), pytest.approx(89.0), None]
    cities = {"A": City(0, 0, "USD"), "B": City(0, 0, "EUR")}
    assert column(convert_currency(df, rule, cities=cities), "price") == [pytest.approx(1523.68), 100.0, None]
    for currency in ("XXX", "BAD"):
        with pytest.raises(RuleError):
            convert_currency(df, rule, currency)
    with pytest.raises(RuleError):
        convert_currency(df.drop("price"), rule, "USD")
    with pytest.raises(Exception, match="no currency for city"):
        convert_currency(df, rule, cities={"A": cities["A"]}).collect()


def test_format_eur(spark):
    df = spark.createDataFrame([(1, 1234567.0), (2, -1234.0), (3, 7.5), (4, 0.0)], "id int, x double")
    assert column(df.select("id", format_eur(F.col("x")).alias("t")), "t") == ["€1,234,567", "€-1,234", "€8", "€0"]
    assert column(df.select("id", format_eur(F.col("x"), 2).alias("t")), "t")[2] == "€7.50"


def test_labels(spark):
    df = spark.createDataFrame([("has_AC",), ("odd",)], "term string")
    labelled = label_terms(df, "term", {"has_AC": "Air conditioning"})
    assert column(labelled, "label", "term") == ["Air conditioning", "odd"]
    with pytest.raises(Exception, match="no label"):
        label_terms(df, "term", {"has_AC": "Air conditioning"}, required=True).collect()


def test_dedupe_first_and_composite_key(spark):
    df = spark.createDataFrame([(1, "x", 10, 1), (2, "x", 20, 2), (1, "y", 11, 3), (3, "x", 30, 4), (2, "x", 21, 5)],
                               "id int, city string, price int, at int")
    assert column(dedupe_first(df, ["id"], ["at"]), "price") == [10, 20, 30]
    assert dedupe_first(df, ["id", "city"], ["at"]).count() == 4
    plan = dedupe_first(df, ["id"], ["at"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # one before the shuffle: copies collapse on the map side


def test_drop_zero(spark):
    df = spark.createDataFrame([(1, 1.0, 1), (2, 0.0, 1), (3, -0.0, 1), (4, None, 0), (5, None, None)],
                               "id int, a double, b int")
    assert column(drop_zero(df, ["a"]), "id") == [1, 4, 5]
    assert column(drop_zero(df, ["a", "b"]), "id") == [1, 5]
    assert drop_zero(df, []).count() == 5


def test_group_median_imputation(spark):
    df = spark.createDataFrame(
        [(1, "E", 1.0), (2, "E", 3.0), (3, "E", None), (4, "P", None), (5, None, 7.0), (6, None, None)],
        "id int, room_type string, bedrooms double")
    assert column(impute_group_median(df, ["bedrooms"], "room_type"), "bedrooms") == [1.0, 3.0, 2.0, None, 7.0, 7.0]


def test_missing_rules_order_and_errors(spark):
    label = "Entire home/apt"
    df = spark.createDataFrame(
        [(1, label, None, "1 bath", 1.0), (2, label, 2.0, "Half-bath", None), (3, "Private room", None, "1.5 shared baths", None),
         (4, "Private room", 1.0, "Bathroom", None), (5, "Private room", 3.0, "0 baths", None)],
        "id int, room_type string, bedrooms double, bathrooms_text string, bathrooms double")
    out = missing_rules(df, [MissingRule("bedrooms", "impute_median_or_drop_entire_home"),
                             MissingRule("bathrooms", "fill_from_bathrooms_text")])
    assert [(r.id, r.bedrooms, r.bathrooms) for r in out.orderBy("id").collect()] == [
        (2, 2.0, 0.5), (3, 2.0, 1.5), (5, 3.0, 0.0)]
    # the first rule decides: after filling with zero nothing is left to drop
    filled = missing_rules(df, [MissingRule("bedrooms", "fill_zero"), MissingRule("bedrooms", "drop_row")])
    assert filled.count() == 5
    assert missing_rules(df, [MissingRule("bedrooms", "drop_row"), MissingRule("bedrooms", "fill_zero")]).count() == 3
    assert missing_rules(df, []).count() == 5
    with pytest.raises(RuleError, match="unknown missing value rule"):
        missing_rules(df, [MissingRule("bedrooms", "guess")])


def test_parse_bathrooms(spark):
    rows = [(1, "1.5 shared baths"), (2, "Half-bath"), (3, "Shared HALF-bath"), (4, "baths"), (5, ""), (6, None), (7, "0 baths")]
    df = spark.createDataFrame(rows, "id int, t string")
    assert column(df.select("id", parse_bathrooms(F.col("t")).alias("v")), "v") == [1.5, 0.5, 0.5, None, None, None, 0.0]


def test_outliers(spark):
    prices = [92.0, 95.0, 100.0, 105.0, 110.0, 100.0, 98.0, 102.0, 101.0, 10000.0]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(prices)], "id int, price double")
    for scale in ("log", "raw"):
        assert drop_outliers(df, OutlierRule(("price",), scale=scale)).count() == 9
    with pytest.raises(DataError):
        drop_outliers(df.unionByName(spark.createDataFrame([(99, 0.0)], df.schema)), OutlierRule(("price",)))
    with pytest.raises(DataError):
        drop_outliers(df.unionByName(spark.createDataFrame([(99, None)], df.schema)), OutlierRule(("price",), scale="raw"))
    for bad in (OutlierRule(("price",), method="z"), OutlierRule(("price",), scale="sqrt"), OutlierRule(("price",), action="cap")):
        with pytest.raises(RuleError):
            drop_outliers(df, bad)


def test_outliers_judged_on_full_table(spark):
    # b's outlier sits in a's outlier row or not: both columns are judged before any row goes
    rows = [(i, 100.0 + i, 50.0 + i) for i in range(10)] + [(10, 9999.0, 55.0), (11, 104.0, 9999.0)]
    df = spark.createDataFrame(rows, "id int, a double, b double")
    assert column(drop_outliers(df, OutlierRule(("a", "b"), scale="raw")), "id") == list(range(10))


def test_plausible(spark):
    rules = [PlausibilityRule("bedrooms", "accommodates", 1.0, 0.0), PlausibilityRule("bathrooms", "bedrooms", 1.0, 2.0)]
    df = spark.createDataFrame([(1, 2, 2, 4.0), (2, 2, 3, 1.0), (3, 4, 1, 3.5), (4, 4, 4, 6.0)],
                               "id int, accommodates int, bedrooms int, bathrooms double")
    assert column(filter_plausible(df, rules), "id") == [1, 4]
    assert filter_plausible(df, []).count() == 4
    missing = df.unionByName(spark.createDataFrame([(5, None, 1, 1.0)], df.schema))
    with pytest.raises(DataError, match="accommodates"):
        filter_plausible(missing, rules)


@pytest.mark.parametrize("bracket_rows", [10_000, 3])
def test_quantiles_match_numpy(spark, bracket_rows):
    import numpy as np

    rng = np.random.default_rng(7)
    data = {g: np.round(rng.lognormal(3, 2, n), 3) for g, n in (("hot", 3000), ("mid", 11), ("one", 1))}
    data["same"] = np.full(50, 4.25)
    rows = [(g, float(v)) for g, values in data.items() for v in values] + [("hot", None), ("empty", None), (None, 5.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r for r in group_quantiles(df, {"a": ("v", 0.25), "b": ("v", 0.5), "c": ("v", 0.995)}, ["g"],
                                           sizes={"n": "v"}, bracket_rows=bracket_rows).collect()}
    for g, values in data.items():
        assert [got[g].a, got[g].b, got[g].c] == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.995])), rel=1e-12)
        assert got[g].n == len(values)
    assert got[None].b == 5.0
    assert got["empty"].n == 0 and got["empty"].a is None
    single = group_quantiles(df, {"m": ("v", 0.5)}, bracket_rows=bracket_rows).first()
    everything = np.concatenate([*data.values(), [5.0]])
    assert math.isclose(single.m, float(np.median(everything)), rel_tol=1e-12)
    for approximate in (False, True):
        with pytest.raises(DataError, match="gap"):
            group_quantiles(df, {"m": ("v", 0.5)}, null_message="gap", approximate=approximate)


def test_a_hot_value_beside_many_others(spark):
    """A third of the rows hold one value, 250,000 others are distinct and spread over 300 powers of ten: copies are one row, brackets shrink by count."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(8)
    values = np.concatenate([np.full(125_000, 7.5), 10.0 ** rng.uniform(-150, 150, 250_000)])
    df = spark.createDataFrame(pd.DataFrame({"v": rng.permutation(values)})).repartition(8)
    asked = {f"q{i}": ("v", q) for i, q in enumerate((0.0, 0.1, 0.4, 0.6, 0.9999, 1.0))}
    got = group_quantiles(df, asked).first()
    assert [got[n] for n in asked] == pytest.approx([float(np.quantile(values, q)) for _, q in asked.values()], rel=1e-12)
