"""How complete a day's collection is: counts per file, best attempt, pages, status.

Defined cases
    * a file reported as empty is complete; a percentage is a whole number, cut; a negative report (it couldn't be sized) gives a negative one.
    * of attempts that saved equally much the earlier one is the best.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def percentages(counts: DataFrame) -> DataFrame:
    """counts (reported, raw, dropped) with pct and drop_pct."""
    pct = F.when(F.col("reported") == 0, 100).otherwise(F.expr("raw * 100 div reported"))
    dropped = F.when(F.col("raw") == 0, 0).otherwise(F.expr("dropped * 100 div raw"))
    return counts.withColumn("pct", pct.cast("bigint")).withColumn("drop_pct", dropped.cast("bigint"))


def status(complete_from: int = 90, suspect_above: int = 30) -> Column:
    """2 nothing saved, 4 suspect, 3 partial, 0 complete: the first that holds."""
    partial = (F.col("reported") != 0) & (F.col("pct") < complete_from)
    return F.when(F.col("saved") == 0, 2).when(F.col("drop_pct") > suspect_above, 4).when(partial, 3).otherwise(0)


def script_status(complete_from: int = 90) -> Column:
    """The download script's: 1 the primary query brought nothing, 2 nothing kept, 3 partial, 0 complete."""
    partial = (F.col("reported") != 0) & (F.col("pct") < complete_from)
    return F.when(F.col("raw") == 0, 1).when(F.col("saved") == 0, 2).when(partial, 3).otherwise(0)


def best_attempt(attempts: DataFrame, key: str) -> DataFrame:
    """key, attempt, saved of the attempt that saved most."""
    best = F.max(F.struct("saved", (-F.col("attempt")).alias("early")))
    return attempts.groupBy(key).agg(best.alias("b")).select(key, (-F.col("b.early")).alias("attempt"), F.col("b.saved").alias("saved"))


def pages(totals: DataFrame, size: int = 100) -> DataFrame:
    """One row per page that a total needs: from 1 on, at least one."""
    last = F.greatest(F.ceil(F.col("total") / size), F.lit(1))
    return totals.withColumn("page", F.explode(F.sequence(F.lit(1).cast("bigint"), last.cast("bigint"))))
