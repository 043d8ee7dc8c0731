"""Projections, positional selection and the change between scene rows (arrays) and cell rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geoframe.sources.store import scratch


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Columns under their canonical names; names that df has not are ignored."""
    return df.withColumnsRenamed(names)


def single_variable(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The one column beside the keys, whatever its name, as ``name``."""
    others = [c for c in df.columns if c not in keys]
    if len(others) != 1:
        raise ValueError(f"one variable expected, found {others}")
    return df.select(*keys, F.col(others[0]).alias(name))


def height_suffixed(df: DataFrame, keys: list[str], variable: str, height: str, heights: list, value: str = "value") -> DataFrame:
    """One column variable_height for each of the listed heights; the height column goes."""
    wide = df.select(*keys, F.concat_ws("_", F.lit(variable), F.col(height).cast("string")).alias("name"), F.col(value).alias("value"))
    return wide.groupBy(*keys).pivot("name", [f"{variable}_{h}" for h in heights]).agg(F.first("value", ignorenulls=True))


def kept(df: DataFrame, names: list[str]) -> DataFrame:
    """The listed columns that df has, in that order."""
    return df.select([c for c in names if c in df.columns])


def without(df: DataFrame, *names: str) -> DataFrame:
    """df without the named columns; missing ones don't matter."""
    return df.drop(*names)


def without_auxiliary(df: DataFrame, dims: list[str], variables: list[str], keep: tuple[str, ...] = ("time",)) -> DataFrame:
    """Dimensions, variables and the coordinates to keep; other coordinates go."""
    return kept(df, [*dims, *(c for c in keep if c not in dims), *variables])


def without_arrays(df: DataFrame) -> DataFrame:
    """df without columns that carry a dimension of their own."""
    return df.drop(*(f.name for f in df.schema if f.dataType.typeName() in ("array", "map")))


def with_constants(df: DataFrame, **values: object) -> DataFrame:
    """df with scalar coordinates as columns."""
    return df.withColumns({k: v if isinstance(v, Column) else F.lit(v) for k, v in values.items()})


def first_per_key(df: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """One row for each key: the columns of its first row in a total order."""
    return df.groupBy(key).agg(F.min(F.struct(*order, *(F.col(c).alias(f"v_{c}") for c in columns))).alias("m")).select(key, *(F.col(f"m.v_{c}").alias(c) for c in columns))


def cells(df: DataFrame, payload: str, width: int) -> DataFrame:
    """Scene rows to cell rows (y, x, value); payload is row-major. Null scenes give no cells."""
    others = [c for c in df.columns if c != payload]
    flat = df.select(*others, F.posexplode(payload).alias("pos", "value"))
    return flat.select(*others, F.floor(F.col("pos") / width).cast("int").alias("y"), (F.col("pos") % width).cast("int").alias("x"), "value")


def scenes(df: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Cell rows to scene rows with a row-major payload; the inverse of cells for whole scenes."""
    return df.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("y", "x", F.col(value).alias("v")))), lambda s: s["v"]).alias("payload"))


def chunks(df: DataFrame, index: str, size: int, values: list[str], keys: list[str] | None = None) -> DataFrame:
    """Rows gathered to chunks of ``size`` consecutive indexes, each an array in order of index."""
    block = F.floor(F.col(index) / size).cast("long")
    return df.groupBy(*(keys or []), block.alias("chunk")).agg(F.array_sort(F.collect_list(F.struct(index, *values))).alias("rows"))


def transposed(payload: Column, height: int, width: int) -> Column:
    """Row-major payload of a height x width scene as that of the width x height one."""
    return F.transform(F.sequence(F.lit(0), F.lit(height * width - 1)), lambda k: F.get(payload, (k % height) * width + F.floor(k / height).cast("int")))


def padded_scene(payload: Column, height: int, width: int, to_height: int, to_width: int) -> Column:
    """Scene with null rows and columns at its end, up to fixed dimensions."""
    def at(k: Column) -> Column:
        y, x = F.floor(k / to_width).cast("int"), k % to_width
        return F.when((y < height) & (x < width), F.get(payload, y * width + x))

    return F.transform(F.sequence(F.lit(0), F.lit(to_height * to_width - 1)), at)


def axis_role(values: Column, time_length: int) -> Column:
    """Which dimension an unnamed axis is, by its size."""
    return F.when(F.size(values) == time_length, "time").when(F.size(values) == 2, "latitude_longitude").otherwise("index")


def ring(tile: Column, wide: bool = False) -> Column:
    """Ring of a full-disk tile by its number; the wide scheme begins at tile 1 and its last ring at 83."""
    first, last = (1, 83) if wide else (0, 82)
    return F.when(tile.between(first, 5), "top2").when(tile.between(6, 13), "top").when(tile.between(14, 73), "centre").when(tile.between(74, 81 if not wide else 82), "bottom").when(tile >= last, "bottom2")


def numbered(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """df with consecutive positions from 0 in a total order, without gathering it in one task.

    Rows are range-partitioned and written once with the number of their partition, since Spark would
    sample other ranges when it plans them again; counts of partitions, one row each, then give where
    each begins. Nulls come first.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, "numbered")
    held = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    held.write.parquet(path)
    ranged = spark.read.schema(held.schema).parquet(path)
    size = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    begin = size.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_begin"))
    inner = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return ranged.withColumn("_in", inner).join(F.broadcast(begin), "_part").withColumn(name, (F.col("_begin") + F.col("_in")).cast("long")).drop("_part", "_begin", "_in")


def blocks(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """df with the number of the block of ``size`` consecutive rows that each row is in."""
    return numbered(df, order).withColumn("block", F.floor(F.col("position") / size).cast("long"))


def truncated(df: DataFrame, order: list[str], multiple: int) -> DataFrame:
    """The first rows in order, as many as the largest multiple allows."""
    placed = numbered(df, order)
    total = placed.agg(F.count("*").alias("_total"))
    return placed.join(F.broadcast(total)).where(F.col("position") < F.floor(F.col("_total") / multiple) * multiple).drop("_total")


def padded(df: DataFrame, order: list[str], multiple: int, pads: dict[str, object]) -> DataFrame:
    """df and rows of pad values, so that their number is a multiple; columns without a pad value are null in these."""
    total = df.agg(F.count("*").alias("n"))
    lack = (multiple - F.col("n") % multiple) % multiple
    rows = total.where(lack > 0).select(F.explode(F.sequence(F.lit(1), lack.cast("int"))).alias("k"))
    made = rows.select(*(F.lit(pads.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema), F.lit(True).alias("is_pad"))
    return df.withColumn("is_pad", F.lit(False)).unionByName(made)


def first_of_group(df: DataFrame, group: list[str], order: list[str], count: int) -> DataFrame:
    """The first rows of each group, a top-k per group that Spark limits before the shuffle."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= count)


def extent(df: DataFrame, keys: list[str], axis: str, index: str, scale: float = 1.0) -> DataFrame:
    """Outer edges of an axis of pixel centres: half a pixel beyond the first and the last one, scaled, to 6 places.

    An axis of one pixel has no known width; both edges are its centre.
    """
    found = df.groupBy(*keys).agg(F.min_by(axis, index).alias("first"), F.max_by(axis, index).alias("last"), F.count("*").alias("n"))
    half = F.coalesce(F.try_divide(F.col("last") - F.col("first"), F.col("n") - 1), F.lit(0.0)) / 2
    return found.select(*keys, F.round((F.col("first") - half) * scale, 6).alias("low"), F.round((F.col("last") + half) * scale, 6).alias("high"))


def bounding_box(df: DataFrame, keys: list[str], latitude: str, longitude: str) -> DataFrame:
    """West, south, east and north ends of the cells of each key."""
    return df.groupBy(*keys).agg(F.min(longitude).alias("west"), F.min(latitude).alias("south"), F.max(longitude).alias("east"), F.max(latitude).alias("north"))
