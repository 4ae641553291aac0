"""Daily archives: one gzipped file of JSON lines per day, as a source and a sink.

Defined cases
    * lines that are no JSON, and records without an address, are skipped; missing keys are null.
    * backups are no archives; the day is that of the file name.
    * a day written again keeps the file it replaces as ``<name>.backup.<seconds>``; a file that can't be moved is an error.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlens.functions.text import day_of_file
from harborlens.session import file_system, move

#: A fixed schema, so that no day is typed by what it happens to hold; a CVE's object stays text.
BANNER = """ip_str string, port int, transport string, asn string, org string, isp string, product string, version string, info string,
cpe23 array<string>, cpe array<string>, hostnames array<string>, domains array<string>, tags array<string>, `timestamp` string, hash string,
location struct<city:string,region_code:string,country_code:string>, _shodan struct<module:string>, vulns map<string,string>"""


def read_days(spark: SparkSession, folder: str, day: str = "*") -> DataFrame:
    """The banners of all archives of a folder, or of one day, with src_file and date.

    A gzipped file is one task, so the rows are spread before anything heavy follows.
    """
    rows = spark.read.schema(BANNER).option("pathGlobFilter", f"*events-{day}.json.gz").option("recursiveFileLookup", "true").json(folder)
    named = rows.withColumn("src_file", F.col("_metadata.file_name")).where("ip_str <> '' and not contains(src_file, '.backup')")
    return named.withColumn("cpe23", F.when(F.size(F.coalesce("cpe23", F.array())) > 0, F.col("cpe23")).otherwise(F.col("cpe"))).drop("cpe").withColumn("date", day_of_file(F.col("src_file")))


def write_days(banners: DataFrame, folder: str) -> None:
    """One gzipped file per src_file, written by Spark's committer and then named by the day.

    A day's rows meet in one task because the archive's format is one file a day.
    """
    keep = [c for c in banners.columns if c not in ("src_file", "rec_id", "date")]
    write_lines(banners.select("src_file", F.to_json(F.struct(*keep)).alias("value")), folder)


def write_lines(lines: DataFrame, folder: str) -> None:
    """src_file and value (a line) as gzipped files of those names. A file that is there already becomes a backup first."""
    spark, staged = lines.sparkSession, f"{folder}/_staged-{uuid.uuid4().hex}"
    rows = lines.select(F.col("src_file").alias("file"), "value").where("file is not null").repartition("file").sortWithinPartitions("file")
    rows.write.partitionBy("file").option("compression", "gzip").text(staged)
    fs, root = file_system(spark, staged)
    for part in [p.getPath() for p in fs.listStatus(root) if p.getPath().getName().startswith("file=")]:
        target = f"{folder}/{part.getName()[5:]}"
        if fs.exists(file_system(spark, target)[1]):
            move(spark, target, f"{target}.backup.{time.time_ns() // 1_000_000_000}.{uuid.uuid4().hex[:8]}")
        for file in fs.listStatus(part):
            if file.getPath().getName().endswith(".gz"):
                move(spark, file.getPath().toString(), target)
    fs.delete(root, True)
