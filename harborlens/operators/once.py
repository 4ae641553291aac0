"""Exactly one copy of each message that was delivered at least once.

Landing encodes: every message of the landed rows gets an exact dictionary code (shard, ordinal), known ones the code they
have. Delivering decides: batch by batch, in order, the first arrival of each code is kept whose bit is not set in the seen
bitmaps, and the new bits are united with them by renaming one small pointer file. The dictionary may hold codes that were
never delivered (a job died, a batch is still to come); only a bit says that a message was seen.

The dictionary is a bucketed table, so landing shuffles the new rows to the buckets and never the history. Codes are
positions within the tasks that write it: no window, no sort. A delivery writes the bitmaps of its new bits alone.

Defined cases
    * hash is read as a whole number (``" 12"``, ``"12.0"`` and ``12`` are one); text that is no whole number stands for itself.
    * null and ``None`` mean no hash; then ip, port and time identify the message (null ports are alike).
    * a row without banner_ts is like no other and is always kept.
    * an empty batch publishes an unchanged state; extra columns are carried along untouched.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlens.session import cut, file_system, read_text, replace_text, scratch_path, written

KEY = "message"
BITS_A_BITMAP = 32768
#: Rows that a bucket of the dictionary is laid out for, and delivered bitmaps from which on they are merged into one.
ROWS_A_BUCKET, MERGE_FROM = 1 << 20, 16
#: Batches that a table without a state is delivered in.
DELIVERIES = 2


def message_key() -> Column:
    """The identity of a message as one text: second, ip, and hash as a whole number, or port where there is no hash."""
    text = F.trim("hash")
    no_hash = F.col("hash").isNull() | (text == "None")
    whole = F.when(text.rlike(r"^[+-]?\d+(\.0*)?$"), F.split_part(text, F.lit("."), F.lit(1)).try_cast("decimal(38,0)").cast("string"))
    ip = F.coalesce("ip", F.lit(""))
    port = F.concat(F.lit("p"), F.coalesce(F.col("port").cast("string"), F.lit("")))
    seconds = F.unix_date(F.to_date("banner_ts")).cast("bigint") * 86400 + F.hour("banner_ts") * 3600 + F.minute("banner_ts") * 60 + F.second("banner_ts")
    return F.concat(F.hex(seconds), F.lit(":"), F.length(ip).cast("string"), F.lit(":"), ip, F.when(no_hash, port).otherwise(F.concat(F.lit("h"), F.coalesce(whole, text))))


@dataclass
class SeenState:
    """Under root: the dictionary, and per delivery its bitmaps. CURRENT names the deliveries in force."""

    spark: SparkSession
    root: str
    buckets: int | None = None

    @property
    def table(self) -> str:
        return f"seen_{hashlib.md5(self.root.encode()).hexdigest()}"

    def begin(self, rows: int) -> None:
        """Declares the dictionary. Its buckets, fixed once, divide the shuffle partitions, so that a bucket comes whole from one task."""
        known = read_text(self.spark, f"{self.root}/BUCKETS")
        if not known:
            partitions = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            most = max(1, rows // ROWS_A_BUCKET)
            known = str(self.buckets or max(d for d in range(1, min(most, partitions) + 1) if partitions % d == 0))
            replace_text(self.spark, f"{self.root}/BUCKETS", known)
        self.buckets = int(known)
        columns = f"{KEY} string, shard bigint, ordinal bigint, landing string, firsts array<bigint>"
        self.spark.sql(f"create table if not exists {self.table} ({columns}) using parquet clustered by ({KEY}) into {self.buckets} buckets location '{self.root}/dictionary'")

    def end(self) -> None:
        """Takes the dictionary out of the session's catalog; its files stay."""
        self.spark.sql(f"drop table if exists {self.table}")

    def dictionary(self) -> DataFrame:
        return self.spark.table(self.table)

    def has_codes(self) -> bool:
        fs, path = file_system(self.spark, f"{self.root}/dictionary")
        return fs.exists(path) and any(f.getPath().getName().endswith(".parquet") for f in fs.listStatus(path))

    def deliveries(self) -> list[str]:
        return [d for d in read_text(self.spark, f"{self.root}/CURRENT").split(",") if d]

    def bitmaps(self) -> DataFrame:
        """shard, bucket, bitmap: the union over all deliveries in force, which must be some."""
        parts = self.spark.read.schema("shard bigint, bucket bigint, bitmap binary").parquet(*[f"{self.root}/{d}" for d in self.deliveries()])
        return parts.groupBy("shard", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))

    def publish(self, bits: DataFrame) -> None:
        """Unites bits (shard, bucket, bit) with the bitmaps; the rename of the pointer is the commit point of a delivery."""
        before, name = self.deliveries(), f"bits-{uuid.uuid4().hex}"
        new = bits.groupBy("shard", "bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
        if len(before) >= MERGE_FROM:
            new = new.unionByName(self.bitmaps()).groupBy("shard", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
            before = []
        new.write.option("compression", "zstd").parquet(f"{self.root}/{name}")
        replace_text(self.spark, f"{self.root}/CURRENT", ",".join([*before, name]))


def land(rows: DataFrame, state: SeenState, batch: Column | None = None, batches: int = 1, n_rows: int | None = None) -> DataFrame:
    """shard, ordinal and the first arrival in each batch (an array) of every message of the rows.

    One aggregation by message, combined on the map side: a message delivered very often is one row per map task.
    """
    state.begin(rows.count() if n_rows is None else n_rows)  # the count of a table comes from the files' footers
    batch = F.lit(0) if batch is None else batch
    firsts = F.array(*[F.min(F.when(F.col("batch") == i, F.col("obs_id"))) for i in range(batches)])
    messages = rows.where("banner_ts is not null").select("obs_id", batch.alias("batch"), message_key().alias(KEY)).groupBy(KEY).agg(firsts.alias("firsts"))
    again = None
    if state.has_codes():
        both = cut(messages.join(state.dictionary().select(KEY, "shard", "ordinal"), KEY, "left"))
        again = both.where("shard is not null").select("shard", "ordinal", "firsts")
        messages = both.where("shard is null").select(KEY, "firsts").repartition(state.buckets, KEY)
    # a shard is one task of one landing, an ordinal the place in it; what the table holds once written is the code
    landing, stamp = uuid.uuid4().hex, time.time_ns() // 1_000_000
    numbered = messages.withColumn("at", F.monotonically_increasing_id())
    shard, ordinal = F.lit(stamp << 22) + F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    numbered.select(KEY, shard.alias("shard"), ordinal.alias("ordinal"), F.lit(landing).alias("landing"), "firsts").write.insertInto(state.table)
    coded = state.dictionary().where(F.col("landing") == landing).select("shard", "ordinal", "firsts")
    return coded if again is None else coded.unionByName(again)


def deliver(arrivals: DataFrame, state: SeenState, batch: int = 0) -> DataFrame:
    """obs_id of the arrivals to keep of a batch: those whose bit was not set. Sets their bits."""
    first = arrivals.select("shard", "ordinal", F.get("firsts", F.lit(batch)).alias("obs_id")).where("obs_id is not null")
    coded = first.select("shard", F.expr(f"ordinal div {BITS_A_BITMAP}").alias("bucket"), F.expr(f"ordinal % {BITS_A_BITMAP}").alias("bit"), "obs_id")
    if state.deliveries():
        octet = F.conv(F.hex(F.substring("bitmap", (F.expr("bit div 8") + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        coded = coded.join(state.bitmaps(), ["shard", "bucket"], "left").withColumn("octet", F.coalesce(octet, F.lit(0)))
        coded = coded.where(F.expr("shiftright(octet, cast(bit % 8 as int)) & 1") == 0).drop("bitmap", "octet")
    kept = written(coded, "kept")
    state.publish(kept.select("shard", "bucket", "bit"))
    return kept.select("obs_id")


def deliver_batch(rows: DataFrame, state: SeenState) -> DataFrame:
    """The obs_id of the rows with a banner_ts that a batch brings for the first time."""
    return deliver(land(rows, state), state)


def first_arrivals(rows: DataFrame, deliveries: int = DELIVERIES) -> DataFrame:
    """The obs_id of the arrivals to keep of a whole table, delivered in that many batches by order of obs_id, against a state of its own."""
    state = SeenState(rows.sparkSession, scratch_path(rows.sparkSession, "seen"))
    low, high, n = rows.agg(F.min("obs_id"), F.max("obs_id"), F.count(F.lit(1))).head()
    span = (high or 0) - (low or 0) + 1
    batch = F.floor((F.col("obs_id") - F.lit(low or 0)).cast("decimal(38,0)") * deliveries / F.lit(span)).cast("int") if span > 1 else F.lit(0)
    arrivals = land(rows, state, batch, deliveries, n)
    kept = [deliver(arrivals, state, i) for i in range(deliveries)]
    state.end()
    out = kept[0]
    for more in kept[1:]:
        out = out.unionByName(more)
    return out


def keep_once(rows: DataFrame) -> DataFrame:
    """rows without the copies."""
    kept = first_arrivals(rows)
    return rows.where("banner_ts is null").unionByName(rows.where("banner_ts is not null").join(kept, "obs_id", "left_semi").select(*rows.columns))


def copies(rows: DataFrame) -> DataFrame:
    """The obs_id of every row whose message arrived before. obs_id is unique, so the anti join has no hot key."""
    return rows.where("banner_ts is not null").select("obs_id").join(first_arrivals(rows), "obs_id", "left_anti")
