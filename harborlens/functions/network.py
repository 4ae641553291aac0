"""Addresses as keys that sort and prefix like the addresses: bits of IPv4 and IPv6, in built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ipv4_number(ip: Column) -> Column:
    """The number of a dotted address, null for anything else."""
    part = F.split(ip, r"\.")
    number = sum((part[i].cast("bigint") * (1 << (24 - 8 * i)) for i in range(1, 4)), part[0].cast("bigint") * (1 << 24))
    return F.when(ip.rlike(r"^((25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(25[0-5]|2[0-4]\d|1?\d?\d)$"), number)


def _groups(text: Column) -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ":"))


def ipv6_hex(ip: Column) -> Column:
    """The 32 hexadecimal digits of an address in groups, with at most one ``::``; null for anything else."""
    halves = F.split(F.lower(ip), "::")
    head, tail = _groups(halves[0]), F.when(F.size(halves) == 2, _groups(F.get(halves, F.lit(1)))).otherwise(F.array().cast("array<string>"))
    missing = F.greatest(F.lit(8) - F.size(head) - F.size(tail), F.lit(0))
    full = F.concat(head, F.when(F.size(halves) == 2, F.array_repeat(F.lit("0"), missing)).otherwise(F.array().cast("array<string>")), tail)
    good = ip.rlike(r"^[0-9A-Fa-f:]+$") & ip.contains(":") & (F.size(halves) <= 2) & (F.size(full) == 8) & F.forall(full, lambda g: g.rlike("^[0-9a-f]{1,4}$"))
    return F.when(good, F.array_join(F.transform(full, lambda g: F.lpad(g, 4, "0")), ""))


def bits(ip: Column) -> Column:
    """32 or 128 characters 0 and 1; null where ip is no address."""
    four = F.lpad(F.bin(ipv4_number(ip)), 32, "0")
    digits = F.split(ipv6_hex(ip), "")
    six = F.array_join(F.transform(digits, lambda d: F.lpad(F.conv(d, 16, 2), 4, "0")), "")
    return F.coalesce(four, F.when(ipv6_hex(ip).isNotNull(), six))
