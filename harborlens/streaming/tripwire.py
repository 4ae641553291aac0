"""The tripwire as a stream: each batch of files rolls the ledger.

Files may hold any days, so a batch is no run: the ledger keeps the day of each last banner time, and what the latest day decides
is read from the ledger after the last batch. The result doesn't follow the cut into batches.

The ledger is a table in the shared folder, one version per batch, and a pointer to the last; a batch that is run again after
a loss writes its own version again from the one before, so its result doesn't change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlens.operators import tripwire
from harborlens.session import file_system, read_text, replace_text, scratch_path


def roll_days(ledger: DataFrame, hits: DataFrame) -> DataFrame:
    """The ledger after all days of the hits, whatever days it holds already, as one aggregation."""
    days = hits.groupBy("ip").agg(
        F.min("date").alias("d_first"),
        F.max("date").alias("d_last"),
        F.array_distinct(F.flatten(F.collect_set("selectors"))).alias("d_selectors"),
        F.max(F.when(F.col("banner_ts").isNotNull(), F.struct("date", "banner_ts"))).alias("d_banner"),
    )
    none = F.array().cast("array<string>")
    return ledger.join(days, "ip", "full").select(
        "ip",
        F.least("first_seen", "d_first").alias("first_seen"),
        F.greatest("last_seen", "d_last").alias("last_seen"),
        F.array_sort(F.array_union(F.coalesce("selectors", none), F.coalesce("d_selectors", none))).alias("selectors"),
        F.greatest("last_banner", "d_banner").alias("last_banner"),
    )


STATE = "ip string, first_seen date, last_seen date, selectors array<string>, last_banner struct<date: date, banner_ts: timestamp_ntz>"


def _ledger(spark: SparkSession, root: str) -> DataFrame:
    """The version that the pointer names; an empty ledger where there is none yet."""
    name = read_text(spark, f"{root}/CURRENT")
    return spark.read.schema(STATE).parquet(f"{root}/{name}") if name else spark.createDataFrame([], STATE)


def stream_ledger(spark: SparkSession, path: str, selectors: tripwire.Selectors, state: str | None = None, files_a_batch: int = 1000) -> DataFrame:
    """ip, first_seen, last_seen, selectors, last_banner_ts, active after all files now in the folder.

    With a state folder a later call takes up where the last one ended and reads new files only; without, the run stands alone.
    """
    root = state or scratch_path(spark, "ledger")
    schema = spark.read.parquet(path).schema
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch)
    folder, _, name = path.rpartition("/")
    fs, jpath = file_system(spark, path)
    rows = source.option("pathGlobFilter", name).parquet(folder) if fs.getFileStatus(jpath).isFile() else source.parquet(path)

    def run(batch: DataFrame, n: int) -> None:
        before = spark.read.schema(STATE).parquet(f"{root}/v{n - 1}") if n else spark.createDataFrame([], STATE)
        roll_days(before, tripwire.flagged(tripwire.from_observations(batch), selectors, ["date"])).write.mode("overwrite").parquet(f"{root}/v{n}")
        replace_text(spark, f"{root}/CURRENT", f"v{n}")
        if n > 1:  # a batch that runs again needs the version before it, no older one
            fs.delete(file_system(spark, f"{root}/v{n - 2}")[1], True)

    stream = rows.writeStream.foreachBatch(run).option("checkpointLocation", f"{root}/progress").trigger(availableNow=True).start()
    stream.awaitTermination()
    out = _ledger(spark, root)
    last = out.agg(F.max("last_seen")).scalar()
    return out.select("ip", "first_seen", "last_seen", F.concat_ws("|", "selectors").alias("selectors"), F.col("last_banner.banner_ts").alias("last_banner_ts"), (F.col("last_seen") == last).alias("active"))
