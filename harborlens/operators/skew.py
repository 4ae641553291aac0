"""Per-key results where a few keys hold most rows, by compressing values before keys.

Rows are first counted by (key, value), which spreads a hot key over its values and combines on the map side; exact
counts, distinct counts, modes and percentiles of a key then come from its weighted values alone.

Defined cases
    * a null or blank key is no key and has no result; keys are taken as they stand, without trimming.
    * null values count as rows, but not as distinct values, modes or percentile points; a key with only nulls has null there.
    * modes that tie go to the smallest value; percentile p is the smallest value at or below which p of the weight lies.
    * value columns without a bound on their distinct values get counts and distinct counts only, never a window per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keyed(rows: DataFrame, keys: list[str], *values: str) -> DataFrame:
    """field, key_value and the value columns: each row once for every key column."""
    pairs = F.array(*[F.struct(F.lit(k).alias("field"), F.col(k).cast("string").alias("key_value")) for k in keys])
    return rows.select(F.explode(pairs).alias("k"), *values).select("k.field", "k.key_value", *values).where("trim(key_value) <> ''")


def compress(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """field, key_value, value, weight: how often each value occurs with each key."""
    return keyed(rows, keys, value).groupBy("field", "key_value", F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("weight"))


def totals(weighted: DataFrame) -> DataFrame:
    """field, key_value, n_rows, n_values from weighted values."""
    return weighted.groupBy("field", "key_value").agg(F.sum("weight").alias("n_rows"), F.count("value").alias("n_values"))


def modes(weighted: DataFrame) -> DataFrame:
    """field, key_value, mode."""
    best = F.max(F.when(F.col("value").isNotNull(), F.struct("weight", (-F.col("value")).alias("least"))))
    return weighted.groupBy("field", "key_value").agg((-best["least"]).alias("mode"))


def percentiles(weighted: DataFrame, **points: float) -> DataFrame:
    """field, key_value and a column per point. For columns of bounded domain: a key's window has its distinct values."""
    given = weighted.where("value is not null")
    key = Window.partitionBy("field", "key_value")
    running = given.withColumn("upto", F.sum("weight").over(key.orderBy("value"))).withColumn("all", F.sum("weight").over(key))
    return running.groupBy("field", "key_value").agg(*[F.min(F.when(F.col("upto") >= F.ceil(F.col("all") * F.lit(p)), F.col("value"))).alias(name) for name, p in points.items()])


def hot_keys(rows: DataFrame, keys: list[str], value: str, share: float) -> DataFrame:
    """field, key_value, n_rows of the keys held by at least that share of all rows (rows without a key count as rows)."""
    total = rows.count()  # from the files' footers
    return totals(compress(rows, keys, value)).where(F.col("n_rows") / F.lit(total) >= F.lit(share)).drop("n_values")


def profile(rows: DataFrame, keys: list[str], small: str, large: str) -> DataFrame:
    """n_rows, distinct counts of both value columns, and mode, median and 90th percentile of the one of bounded domain."""
    weighted = compress(rows, keys, small)
    wide = totals(compress(rows, keys, large)).select("field", "key_value", F.col("n_values").alias(f"n_{large}"))
    on = ["field", "key_value"]
    out = totals(weighted).withColumnRenamed("n_values", f"n_{small}").join(wide, on)
    out = out.join(modes(weighted).withColumnRenamed("mode", f"mode_{small}"), on, "left")
    return out.join(percentiles(weighted, **{f"p50_{small}": 0.5, f"p90_{small}": 0.9}), on, "left")
