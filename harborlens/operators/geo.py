"""Addresses located in networks, and the gates that decide whether a banner is of the target region.

The join is an equi join: networks stand under the prefix lengths they have, and an address asks once per such length. The
longest network that holds the address wins. No address is compared with every network. A network shorter than KEY_BITS
stands under each of its parts that are up to SPREAD_BITS longer, so that the addresses of a large network don't meet in one key.

Defined cases
    * no address, and one outside all networks, has a null country and region.
    * a network without a length is one address; what is no network holds none.
    * equal networks with different places: the lesser (country, region) wins; unknown places are not the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborlens.functions.network import bits

#: Bits that the key of a network should have, by the bits of an address, and by how many a shorter one is made longer at most.
KEY_BITS, SPREAD_BITS = {32: 16, 128: 40}, 8


def key_bits(family: int, n: int) -> int:
    """Bits of the key under which networks of length n stand."""
    return n + min(SPREAD_BITS, max(0, KEY_BITS[family] - n))


def _keyed(networks: DataFrame) -> DataFrame:
    whole = bits(F.split_part("cidr", F.lit("/"), F.lit(1)))
    length = F.when(F.col("cidr").contains("/"), F.split_part("cidr", F.lit("/"), F.lit(2)).try_cast("int")).otherwise(F.length(whole))
    keyed = networks.select(F.length(whole).alias("family"), length.alias("n"), F.substring(whole, F.lit(1), length).alias("prefix"), "country", "region")
    return keyed.where("n between 0 and family")


def network_prefixes(networks: DataFrame) -> DataFrame:
    """family (bits of an address), n (length), prefix (the leading bits), place (country, region) from cidr, country, region."""
    return _keyed(networks).groupBy("family", "n", "prefix").agg(F.min(F.struct("country", "region")).alias("place"))


def locate(addresses: DataFrame, networks: DataFrame, ip: str = "ip") -> DataFrame:
    """The rows of addresses with country and region. Distinct addresses are located once, so a frequent one isn't hot."""
    prefixes = network_prefixes(networks)
    sizes = sorted((r.family, r.n) for r in _keyed(networks).select("family", "n").distinct().collect())  # at most 33 + 129 of them
    single = addresses.select(ip).distinct().withColumn("key", bits(F.col(ip))).where("key is not null")
    ask = lambda f, n: F.when(F.length("key") == f, F.struct(F.lit(n).alias("n"), F.substring("key", 1, key_bits(f, n)).alias("part")))
    none = F.array().cast("array<struct<n:int,part:string>>")
    asks = F.array_compact(F.array(*[ask(f, n) for f, n in sizes])) if sizes else none
    asked = single.select(ip, F.length("key").alias("family"), F.inline(asks))
    longer = F.lit(0)
    for f, n in sizes:
        longer = F.when((F.col("family") == f) & (F.col("n") == n), key_bits(f, n) - n).otherwise(longer)
    parts = F.when(longer == 0, F.array(F.lit(""))).otherwise(F.transform(F.sequence(F.lit(0), F.pow(F.lit(2), longer).cast("int") - 1), lambda i: F.lpad(F.bin(i.cast("bigint")), longer, "0")))
    stands = prefixes.select("family", "n", F.explode(parts).alias("rest"), "prefix", "place").select("family", "n", F.concat("prefix", "rest").alias("part"), "place")
    found = asked.join(stands, ["family", "n", "part"])
    best = found.groupBy(ip).agg(F.max_by("place", "n").alias("_located"))
    rest = [c for c in addresses.columns if c not in ("country", "region")]  # those of the networks take their place
    return addresses.select(*rest).join(best, ip, "left").select(*rest, F.col("_located.country").alias("country"), F.col("_located.region").alias("region"))


def is_place(country: Column, region: Column, target: tuple[str, str]) -> Column:
    return F.coalesce((country == target[0]) & (region == target[1]), F.lit(False))


def gates(located: DataFrame, target: tuple[str, str], name: str) -> DataFrame:
    """The rows with one flag per policy. located: banners with country and region of the networks, and location.

    primary: either source says so; primary_alone: the banner alone (no networks at hand); rescue: everything; store: primary, or
    the org names the region; tripwire_alone: everything (no networks at hand).
    """
    strict = is_place(F.col("country"), F.col("region"), target)
    banner = is_place(F.col("location.country_code"), F.col("location.region_code"), target)
    named = F.lower(F.coalesce("org", F.lit(""))).contains(name.lower())
    return located.withColumns({"in_target": strict, "keep_primary": strict | banner, "keep_primary_alone": banner, "keep_rescue": F.lit(True), "keep_store": strict | banner | named, "keep_tripwire_alone": F.lit(True)})
