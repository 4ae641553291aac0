"""The triage brief as Markdown, from bounded results: one row a tier and at most `top` hosts of each."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborlens.operators.classify import TIERS

NONE = "—"


def _listed(name: str, most: int | None = None) -> Column:
    """An array as words with blanks between, or the dash."""
    words = F.array_join(F.slice(name, 1, most) if most else F.col(name), " ")
    return F.when(words == "", NONE).otherwise(words)


def _clipped(name: str, n: int) -> Column:
    return F.substring(F.coalesce(F.col(name), F.lit("")), 1, n)


def host_columns() -> list[tuple[str, bool, Column]]:
    """The brief's table of hosts: head of a column, whether it holds numbers, and the cell. Heads, widths and the dash are the format."""
    return [
        ("score", True, F.col("score").cast("string")), ("IP", False, F.col("ip")), ("org", False, _clipped("org", 24)), ("city", False, _clipped("city", 14)),
        ("KEV", False, _listed("kev", 3)), ("ICS", False, _listed("ics")), ("admin", False, _listed("admin")), ("DB", False, _listed("dbs")),
        ("EPSS", True, F.when(F.col("epss") > 0, F.round("epss", 3).cast("string")).otherwise(NONE)), ("reason", False, _clipped("reason", 28)),
    ]


def count_columns() -> list[tuple[str, Column]]:
    """Its table of tiers: head and what is counted."""
    return [("Hosts", F.lit(True)), ("w/ KEV CVE", F.size("kev") > 0), ("w/ exposed admin", F.size("admin") > 0), ("w/ ICS", F.size("ics") > 0)]


SIGNAL = "signal"


def _row(cells: Iterable[str]) -> str:
    return f"| {' | '.join(cells)} |"


def _head(columns: list[tuple[str, bool]]) -> list[str]:
    return [_row(name for name, _ in columns), "|" + "|".join("--:" if number else "---" for _, number in columns) + "|"]


def tier_counts(scored: DataFrame) -> DataFrame:
    """tier, a count per column, and the hosts with a signal."""
    counts = [F.count_if(condition).alias(name) for name, condition in count_columns()]
    return scored.groupBy("tier").agg(*counts, F.count_if(F.col("score") > 0).alias(SIGNAL))


def host_lines(scored: DataFrame, top: int) -> DataFrame:
    """tier, place, line: the hosts of the highest scores of each tier, ready to print; ties go by address."""
    place = F.row_number().over(Window.partitionBy("tier").orderBy(F.desc("score"), "ip"))
    chosen = scored.where("score > 0").withColumn("place", place).where(F.col("place") <= top)
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(cell, F.lit("")) for _, _, cell in host_columns()]), F.lit(" |"))
    return chosen.select("tier", "place", line.alias("line"))


def triage_markdown(scored: DataFrame, title: str, top: int = 15, honeypots: int = 0) -> str:
    """scored: one row per host with tier, reason, score, ip, org, city, kev, ics, admin, dbs, epss; honeypots: hosts left out of it.

    Counts and lines are made before anything comes to the driver.
    """
    counts = {r.tier: r.asDict() for r in tier_counts(scored).collect()}
    lines: dict[str, list[str]] = {}
    for r in host_lines(scored, top).orderBy("tier", "place").collect():
        lines.setdefault(r.tier, []).append(r.line)
    heads = [name for name, _ in count_columns()]
    number = lambda tier, name: f"{counts.get(tier, {}).get(name, 0):,}"
    total = sum(c["Hosts"] for c in counts.values())
    left_out = f" (+{honeypots:,} honeypot host(s) excluded)" if honeypots else ""
    blocks = [[f"# {title}"], [f"**{total:,} unique hosts** classified{left_out}. Findings are leads to verify."]]
    blocks.append(_head([("Tier", False), *[(name, True) for name in heads]]) + [_row([tier.replace("_", " "), *[number(tier, name) for name in heads]]) for tier in TIERS])
    for tier in (t for t in TIERS if t in counts):
        blocks.append([f"## {tier.replace('_', ' ').title()} {NONE} {number(tier, 'Hosts')} hosts ({number(tier, SIGNAL)} with a risk signal)"])
        blocks.append(_head([column[:2] for column in host_columns()]) + lines[tier] if tier in lines else ["_No signals in this tier._"])
    return "\n\n".join("\n".join(block) for block in blocks) + "\n"
