"""Exact k nearest points per query row, without pairing a query with a whole group.

Points are summarised in nested cells (each level splits a cell 4 x 4), with a row count and a bounding box
per cell. Each query walks down from the coarse cells: a cell is dropped when even its nearest corner is
farther than a distance within which k points are already certain. Only the points of the last few
cells are compared one by one. A crowded spot is split by the finer levels, and copies at one coordinate
are cut to the first k in order, which no query can need more of.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import DataError, RuleError, require_columns
from ..functions.geo import box_distance_km, haversine_km
from ..sources.staging import stage
from .lookup import pin

MAX_LEVEL = 8
SPLIT_BITS = 2
LEAF_POINTS = 16
SLACK_KM = 2e-6


def _same(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[x] == right[y] for x, y in pairs])


def nearest_k(
    queries: DataFrame,
    points: DataFrame,
    k: int,
    *,
    query_key: Sequence[str],
    order_by: Sequence[str],
    scope: Sequence[str] = (),
    carry: Sequence[str] = (),
    latitude: str = "latitude",
    longitude: str = "longitude",
    round_km: int | None = None,
    leaf_points: int = LEAF_POINTS,
    max_level: int = MAX_LEVEL,
) -> DataFrame:
    """``query_key``, ``scope``, ``carry`` of the point, ``order_by``, ``distance_km``, ``rank`` (1 = nearest).

    Points compete within equal ``scope`` values. Equal distances are settled by ``order_by``; ``round_km``
    rounds distances to that many decimals (at most 6) first. Queries and points without coordinates have no
    neighbours; a ``query_key`` that two queries share is an error.
    """
    if k < 1:
        raise RuleError(f"{k} nearest rows were asked for, one is the least")
    if round_km is not None and not 0 <= round_km <= 6:
        raise RuleError("round_km must be between 0 and 6")
    query_key, scope, order_by = list(query_key), list(scope), list(order_by)
    carry = [c for c in carry if c not in scope and c not in order_by]
    require_columns(points, [*scope, *carry, *order_by, latitude, longitude], "nearest_k")
    require_columns(queries, [*query_key, *scope, latitude, longitude], "nearest_k")
    queries = queries.filter(F.col(latitude).isNotNull() & F.col(longitude).isNotNull())
    shared = queries.groupBy(*query_key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).collect()
    if shared:
        raise DataError(f"two queries have the key {', '.join(str(shared[0][c]) for c in query_key)}")
    slack = SLACK_KM if round_km is None else SLACK_KM + 2 * 10.0 ** -round_km

    lat, lon = F.col("__plat"), F.col("__plon")
    scale = float(2 ** (SPLIT_BITS * max_level))
    located = points.filter(F.col(latitude).isNotNull() & F.col(longitude).isNotNull()).select(
        *scope, *carry, *order_by, F.col(latitude).cast("double").alias("__plat"),
        F.col(longitude).cast("double").alias("__plon"))
    spot = Window.partitionBy(*scope, "__plat", "__plon").orderBy(*order_by)
    # multiplying by a power of two is exact, so a point and its cell always agree
    distinct_spots = stage(
        located.withColumn("__at", F.row_number().over(spot)).filter(F.col("__at") <= k)
        .withColumns({"__cy": F.floor(lat * scale), "__cx": F.floor(lon * scale)}), "spots")

    levels = F.sequence(F.lit(0), F.lit(max_level))
    finest = (distinct_spots.groupBy(*scope, "__cy", "__cx").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("__at") == 1).alias("spots"),
        F.min("__plat").alias("lat_lo"), F.max("__plat").alias("lat_hi"),
        F.min("__plon").alias("lon_lo"), F.max("__plon").alias("lon_hi")))
    nodes = stage(
        finest.withColumn("__level", F.explode(levels))
        .withColumns({"__cy": F.expr(f"shiftright(__cy, ({max_level} - __level) * {SPLIT_BITS})"),
                      "__cx": F.expr(f"shiftright(__cx, ({max_level} - __level) * {SPLIT_BITS})")})
        .groupBy(*scope, "__level", "__cy", "__cx")
        .agg(F.sum("n").alias("n"), F.sum("spots").alias("spots"), F.min("lat_lo").alias("lat_lo"),
             F.max("lat_hi").alias("lat_hi"), F.min("lon_lo").alias("lon_lo"), F.max("lon_hi").alias("lon_hi")),
        "cells")
    crowding = {r["__level"]: r["most"] for r in nodes.groupBy("__level").agg(F.max("spots").alias("most")).collect()}
    depth = next((lv for lv in range(max_level) if crowding.get(lv, 0) <= leaf_points), max_level)

    def cells(level: int) -> DataFrame:
        at = nodes.filter(F.col("__level") == level)
        return at.select(*[F.col(c).alias(f"__s_{c}") for c in scope], F.col("__cy").alias("cy"), F.col("__cx").alias("cx"),
                         F.shiftright("__cy", SPLIT_BITS).alias("py"), F.shiftright("__cx", SPLIT_BITS).alias("px"),
                         "n", "lat_lo", "lat_hi", "lon_lo", "lon_hi")

    in_scope = [(c, f"__s_{c}") for c in scope]
    # few queries grow into many candidate cells: keep them spread instead of letting them be coalesced
    spread = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    start = queries.repartition(spread, *query_key).select(*query_key, *scope, F.col(latitude).cast("double").alias("__qlat"),
                           F.col(longitude).cast("double").alias("__qlon"))
    low, high = box_distance_km(F.col("__qlat"), F.col("__qlon"), F.col("lat_lo"), F.col("lat_hi"), F.col("lon_lo"),
                                F.col("lon_hi"))
    own = [*start.columns]
    frontier = start if scope else start.withColumn("__all", F.lit(0))
    for level in range(depth + 1):
        below = cells(level)
        if level == 0:
            # one degree cells: at most 64,800 per scope and few in practice, so their size is checked first
            root = pin(below, "root-cells")
            below = (F.broadcast(root.frame) if root.small else root.frame).withColumn("__one", F.lit(0))
            condition = _same(frontier, below, in_scope or [("__all", "__one")])
        else:
            condition = _same(frontier, below, [*in_scope, ("__fy", "py"), ("__fx", "px")])
        per_query = Window.partitionBy(*query_key)
        nearer = per_query.orderBy("high_km").rangeBetween(Window.unboundedPreceding, 0)
        reached = (frontier.join(below, condition)
                   .select(*own, F.col("cy").alias("__fy"), F.col("cx").alias("__fx"), "n",
                           low.alias("low_km"), high.alias("high_km"))
                   .withColumn("sure", F.sum("n").over(nearer))
                   .withColumn("limit_km", F.min(F.when(F.col("sure") >= k, F.col("high_km"))).over(per_query)))
        frontier = reached.filter(F.col("limit_km").isNull() | (F.col("low_km") <= F.col("limit_km") + slack)
                                  ).select(*own, "__fy", "__fx")

    leaf = 2 ** (SPLIT_BITS * (max_level - depth))
    leaves = distinct_spots.select(
        *[F.col(c).alias(f"__s_{c}") for c in scope], *carry, *order_by, "__plat", "__plon",
        F.floor(F.col("__cy") / leaf).alias("cy"), F.floor(F.col("__cx") / leaf).alias("cx"))
    q = frontier.select(*[F.col(c).alias(f"__q_{c}") for c in query_key], *scope, "__qlat", "__qlon", "__fy", "__fx")
    km = haversine_km(F.col("__plat"), F.col("__plon"), F.col("__qlat"), F.col("__qlon"))
    pairs = q.join(leaves, _same(q, leaves, [*in_scope, ("__fy", "cy"), ("__fx", "cx")]))
    pairs = pairs.withColumn("distance_km", km if round_km is None else F.round(km, round_km))
    best = Window.partitionBy(*[f"__q_{c}" for c in query_key]).orderBy("distance_km", *order_by)
    ranked = pairs.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    point_names = {c: (f"point_{c}" if c in query_key else c) for c in [*order_by, *carry]}
    return ranked.select(*[F.col(f"__q_{c}").alias(c) for c in query_key],
                         *[c for c in scope if c not in query_key],
                         *[F.col(c).alias(a) for c, a in point_names.items()], "distance_km", "rank")


def nearest_category(queries: DataFrame, points: DataFrame, category: str = "district", *, query_key: Sequence[str],
                     by: Sequence[str] = (), order_by: Sequence[str] = ("id",), **options) -> DataFrame:
    """``query_key`` and the category of the nearest point (ties: first in ``order_by``)."""
    best = nearest_k(queries, points, 1, query_key=query_key, scope=by, carry=[category], order_by=order_by, **options)
    return best.select(*query_key, *[c for c in by if c not in query_key], category, "distance_km")
