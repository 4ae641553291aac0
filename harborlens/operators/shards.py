"""Address space cut in halves until no shard holds more than a threshold, from coarse prefixes to fine ones.

Each round counts the addresses still in question by a prefix STEP bits longer than the last, derives the lengths between from
these few counts, and asks on only for addresses under prefixes that hold more than the threshold. So an address is counted
once a round, and most drop out early; the last round's prefixes are whole addresses.

Defined cases
    * empty ranges have no shard; a single address above the threshold is a shard.
    * shards start from the two halves of IPv4 and from 2000::/3; other IPv6 addresses are in none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborlens.functions.network import bits
from harborlens.session import cut

STEP = 8
#: family: bits of an address, and the length that shards start from.
FAMILIES = {4: (32, 1), 6: (128, 3)}


def _family(keyed: DataFrame, family: int, threshold: int) -> list[DataFrame]:
    """family, prefix, length, n, round by round. keyed: key, rows; one row an address."""
    size, start = FAMILIES[family]
    out, left, low = [], keyed, start
    while low <= size:
        high = min(size, (low + STEP - 1) // STEP * STEP)
        counted = left.groupBy(F.substring("key", 1, high).alias("end")).agg(F.sum("rows").alias("n"))
        lengths = counted.select("n", F.explode(F.sequence(F.lit(low - (low > start)), F.lit(high))).alias("length"), "end")
        nodes = lengths.groupBy(F.expr("substring(end, 1, length)").alias("prefix"), "length").agg(F.sum("n").alias("n"))
        parents = nodes.select(F.col("prefix").alias("above"), F.col("n").alias("parent_n"))
        both = cut(nodes.where(F.col("length") >= low).withColumn("above", F.expr("substring(prefix, 1, length - 1)")).join(parents, "above", "left"))
        leaf = ((F.col("n") <= threshold) | (F.col("length") == size)) & ((F.col("length") == start) | (F.col("parent_n") > threshold))
        out.append(both.where(leaf).select(F.lit(family).alias("family"), "prefix", "length", "n"))
        heavy = both.where((F.col("length") == high) & (F.col("n") > threshold)).select(F.col("prefix").alias("heavy"))
        if high == size or heavy.isEmpty():
            break
        left = left.join(heavy, F.substring("key", 1, high) == F.col("heavy"), "left_semi")
        low = high + 1
    return out


def leaves(rows: DataFrame, threshold: int, ip: str = "ip") -> DataFrame:
    """family (4 or 6), prefix (bits), length, n. Rows are counted by address first."""
    counted = cut(rows.groupBy(ip).agg(F.count(F.lit(1)).alias("rows")).select(bits(F.col(ip)).alias("key"), "rows").where("key is not null"))
    parts = _family(counted.where(F.length("key") == 32), 4, threshold)
    parts += _family(counted.where((F.length("key") == 128) & F.col("key").startswith("001")), 6, threshold)
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out
