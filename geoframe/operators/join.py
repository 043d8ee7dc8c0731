"""Joins: merged variables, nearest scenes, routing, missing work, alignment and mosaics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geoframe.functions.times import micros


def merged(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Outer merge of variables on shared coordinates, one value column each, by a single shuffle.

    All parts are stacked and grouped, which costs one exchange whatever their number; of repeated
    coordinates the largest value counts.
    """
    names = [next(c for c in p.columns if c not in keys) for p in parts]
    stacked = [p.select(*keys, *(F.col(n) if n == own else F.lit(None).cast(q.schema[n].dataType).alias(n) for n, q in zip(names, parts))) for own, p in zip(names, parts)]
    return reduce(DataFrame.unionByName, stacked).groupBy(*keys).agg(*(F.max(n).alias(n) for n in names))


def families(surface: DataFrame, levels: DataFrame, keys: list[str], how: str = "full_outer") -> DataFrame:
    """Variables without levels beside those on levels; kept apart in storage, joined for reading."""
    return surface.join(levels, keys, how)


def by_derived_key(products: dict[str, DataFrame], path: str, pattern: str) -> DataFrame:
    """Files of one instant, matched by the name without the part that tells products apart; instants that all products have.

    Each product is a name and its files; its columns come as name_column, so that none clash.
    """
    keyed = [df.select(F.regexp_replace(path, pattern, "").alias("instant"), *(F.col(c).alias(f"{name}_{c}") for c in df.columns)) for name, df in products.items()]
    return reduce(lambda a, b: a.join(b, "instant"), keyed)


def navigated(cells: DataFrame, navigation: DataFrame, keys: list[str]) -> DataFrame:
    """Cells with the coordinates of a fixed navigation table, which Spark broadcasts if it is small."""
    return cells.join(navigation, keys)


def nearest_in_hour(requests: DataFrame, scenes: DataFrame, keys: list[str], time: str = "time", path: str = "path") -> DataFrame:
    """For each request the scene nearest in time within the request's clock hour, the first path on ties; none if the hour is empty.

    Requests and scenes meet on their keys and hour, and one aggregation keeps the nearest: no window,
    no range join, and an hour's scenes bound the work of a request. Repeated requests are searched
    once and answered as often as they come.
    """
    asked = requests.groupBy(*requests.columns).agg(F.count("*").cast("int").alias("_times")).withColumn("_hour", F.date_trunc("hour", time))
    have = scenes.select(*keys, F.date_trunc("hour", time).alias("_hour"), F.col(time).alias("scene_time"), *(c for c in scenes.columns if c not in (*keys, time)))
    rest = [c for c in have.columns if c not in (*keys, "_hour", path)]
    apart = F.abs(micros(F.col("scene_time")) - micros(F.col(time)))
    best = asked.join(have, [*keys, "_hour"]).groupBy(*requests.columns, "_times").agg(F.min(F.struct(apart.alias("apart"), F.col(path), *rest)).alias("m"))
    each = best.withColumn("_time", F.explode(F.array_repeat(F.lit(0), F.col("_times"))))
    return each.select(*requests.columns, F.col(f"m.{path}").alias(path), *(F.col(f"m.{c}").alias(c) for c in rest), F.col("m.apart").alias("apart_us"))


def exact_slot(requests: DataFrame, scenes: DataFrame, minutes: int = 10, time: str = "time") -> DataFrame:
    """All scenes whose slot of so many minutes is that of the request."""
    slot = lambda c: F.floor(micros(F.col(c)) / (minutes * 60_000_000)).cast("long")
    return requests.withColumn("slot", slot(time)).join(scenes.withColumn("slot", slot(time)).drop(time), "slot")


def routed(requests: DataFrame, routes: DataFrame, position: str, time: str = "time") -> DataFrame:
    """requests with the satellite that served their position then; half-open ranges, which Spark broadcasts if the table is small."""
    r = routes.select(F.col(position).alias("_position"), "satellite", F.col("start").alias("_start"), F.col("end").alias("_end"))
    inside = (F.col(position) == F.col("_position")) & (F.col("_start").isNull() | (F.col(time) >= F.col("_start"))) & (F.col("_end").isNull() | (F.col(time) < F.col("_end")))
    return requests.join(r, inside).drop("_position", "_start", "_end")


def not_present(df: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(present.select(*keys), keys, "left_anti")


def existing(df: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(present.select(*keys), keys, "left_semi")


def aligned(df: DataFrame, key: str, time: str, values: list[str]) -> DataFrame:
    """Every key at every time that any key has, values null where there were none; of repeated times the first row by value counts.

    The result has keys x times rows by definition; the axes are distinct values.
    """
    axis = df.select(key).distinct().crossJoin(df.select(time).distinct())
    single = df.groupBy(key, time).agg(F.min(F.struct(*values)).alias("v")).select(key, time, *(F.col(f"v.{c}").alias(c) for c in values))
    return axis.join(single, [key, time], "left")


def paired_by_rank(left: DataFrame, right: DataFrame, group: list[str], left_order: list[str], right_order: list[str]) -> DataFrame:
    """Rows of two lists paired by position inside each group, for groups in which both have as many."""
    rank = lambda df, order: df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    n = lambda df, name: df.groupBy(*group).agg(F.count("*").alias(name))
    equal = n(left, "a").join(n(right, "b"), group).where("a = b").select(*group)
    return rank(left, left_order).join(rank(right, right_order), [*group, "rank"]).join(equal, group, "left_semi")


def crossed(*axes: DataFrame) -> DataFrame:
    """All combinations of small axes."""
    return reduce(DataFrame.crossJoin, axes)


def mosaic(tiles: list[DataFrame], order: list[str]) -> DataFrame:
    """Cells of all tiles; where they overlap, that of the earlier tile and then the first in order."""
    stacked = reduce(DataFrame.unionByName, (t.withColumn("_tile", F.lit(k)) for k, t in enumerate(tiles)))
    rest = [c for c in tiles[0].columns if c not in ("y", "x")]
    first = stacked.groupBy("y", "x").agg(F.min(F.struct("_tile", *order, *(c for c in rest if c not in order))).alias("m"))
    return first.select("y", "x", *(F.col(f"m.{c}").alias(c) for c in rest))


def filled(template: DataFrame, data: DataFrame, keys: list[str], fills: dict[str, object]) -> DataFrame:
    """Template axis with the data's values, and the fill value where there is none."""
    return template.join(data, keys, "left").withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()})
