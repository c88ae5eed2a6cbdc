"""Reading listing snapshots and tables of apartments to score."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import RuleError, require_columns, require_rows
from ..rules import RELEVANT_COLUMNS, SUBSCORES, City

_TYPED = {
    "id": "bigint", "accommodates": "int", "beds": "double", "bedrooms": "double", "bathrooms": "double",
    "latitude": "double", "longitude": "double", "minimum_nights": "double", "estimated_occupancy_l365d": "int",
    "availability_365": "int", "review_scores_rating": "double", "number_of_reviews": "int",
    "reviews_per_month": "double", "estimated_revenue_l365d": "double", **{c: "double" for c in SUBSCORES},
}
FILE_SUFFIX = "_listings.csv"


def city_path(city: str, data_dir: str) -> str:
    """``<data_dir>/<city in lower case>_listings.csv``"""
    return f"{data_dir.rstrip('/')}/{city.lower()}{FILE_SUFFIX}"


def file_system_of(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    file_system, where = file_system_of(spark, path)
    return bool(file_system.exists(where))


def available_cities(spark: SparkSession, cities: Iterable[str], data_dir: str) -> list[str]:
    """Known cities that have a file, in alphabetical order."""
    return sorted(c for c in cities if path_exists(spark, city_path(c, data_dir)))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A CSV table with a header. Quotes are doubled inside quoted fields, which may span lines.

    Without a schema the types are inferred, which costs one extra read; give one for big inputs.
    """
    if not path_exists(spark, path):
        raise RuleError(f"no file at {path}")
    reader = (spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"'))
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_listings(spark: SparkSession, paths: str | list[str], columns: Iterable[str] = RELEVANT_COLUMNS,
                  multi_line: bool = True) -> DataFrame:
    """Listing files with their known columns typed and any other requested column as text.

    Columns are found by the header of each path, so files may differ in their order and in further columns; the
    parts of one folder share a header. ``price`` stays text. ``multi_line=False`` is for files whose quoted
    fields hold no line breaks: large ones are then read by many tasks.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    for path in paths:
        if not path_exists(spark, path):
            raise RuleError(f"no file at {path}")
    reader = (spark.read.option("header", True).option("multiLine", multi_line).option("quote", '"').option("escape", '"')
              .option("enforceSchema", False))
    columns = list(columns)
    alike: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        head = reader.csv(path)
        require_columns(head, columns, f"read_listings, {path}")
        alike.setdefault(tuple(head.columns), []).append(path)
    # the city's "file" may also be a folder of part files; no more than these two names are searched, for every row
    tail = F.substring_index(F.col("_metadata.file_path"), "/", -2)
    source = F.regexp_extract(F.url_decode(tail), f"([^/]*){FILE_SUFFIX}(/[^/]*)?$", 1)
    typed = [F.col(c).cast(_TYPED[c]).alias(c) if c in _TYPED else F.col(c) for c in columns]
    return reduce(DataFrame.unionByName, [reader.csv(same).select(*typed, source.alias("file_city")) for same in alike.values()])


def read_cities(spark: SparkSession, cities: Mapping[str, City], data_dir: str, columns: Iterable[str] = RELEVANT_COLUMNS,
                multi_line: bool = True) -> DataFrame:
    """The files of every available city as one table with a ``city`` column; ``columns`` and ``multi_line`` as in :func:`read_listings`."""
    found = available_cities(spark, cities, data_dir)
    if not found:
        raise RuleError(f"no listings file of a known city in {data_dir}")
    names = spark.createDataFrame([(c.lower(), c) for c in found], "file_city string, city string")
    listings = read_listings(spark, [city_path(c, data_dir) for c in found], columns, multi_line)
    return listings.join(F.broadcast(names), "file_city").drop("file_city")


def read_apartments(answers: DataFrame, required: Iterable[str] | None = None, strict: bool = True) -> DataFrame:
    """Apartments to score: columns in alphabetical order, no missing answer in a required column."""
    columns = list(required) if required is not None else list(answers.columns)
    require_columns(answers, columns, "read_apartments")
    require_rows(answers, {f"missing answer for {c}": F.col(c).isNull() for c in columns}, strict)
    return answers.select(*sorted(answers.columns))


def apartments_from_answers(spark: SparkSession, answers: Mapping[str, object]) -> DataFrame:
    """One apartment given as a mapping of answers."""
    for name in sorted(answers):
        if answers[name] is None:
            raise RuleError(f"missing answer for {name}")
    names = sorted(answers)
    return spark.createDataFrame([tuple(answers[n] for n in names)], names)
