"""Continuous periods and gaps from overlapping spans, by dyadic blocks of days.

Each span of days is cut into its canonical dyadic blocks (at most two a level, found in closed form). Per entity the
distinct blocks are kept, those under an ancestor dropped, sibling pairs merged upward level by level, and the remaining
blocks, now few, coalesced where they touch. An entity's blocks are bounded by the calendar, not by its rows: equal
blocks fall together in the map-side part of the aggregation, so an entity holding a third of all rows is no problem.

Defined cases
    * rows with a null bound, last before first, or days_observed null or below 1 cover nothing.
    * an entity without a covering row has no output; repeated and nested rows change nothing; a null ip or port is an entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Days from 0001-01-01 lie below 2**22, so 22 levels hold every date.
LEVELS = 22
_EPOCH = 719162  # 1970-01-01 counted from 0001-01-01
_SHIFT = 1 << 24  # block code = level * _SHIFT + index


def dyadic_blocks(first: str, past: str) -> Column:
    """Codes of the canonical blocks of the days [first, past), both columns of day numbers >= 0."""
    bounds = F.expr(  # no block of a span is longer than the span
        f"transform(sequence(0L, cast(floor(log2({past} - {first})) as bigint)), l -> struct(l, shiftrightunsigned({first} + shiftleft(1L, int(l)) - 1, int(l)) as a, shiftrightunsigned({past}, int(l)) as b))"
    )
    return F.flatten(
        F.transform(
            bounds,
            lambda x: F.filter(
                F.array(F.when((x["a"] < x["b"]) & (x["a"] % 2 == 1), x["l"] * _SHIFT + x["a"]), F.when((x["a"] < x["b"]) & (x["b"] % 2 == 1), x["l"] * _SHIFT + x["b"] - 1)),
                lambda c: c.isNotNull(),
            ),
        )
    )


def _let(name: str, value: str, body: str) -> str:
    """body with value bound to name, so that it is made once and not once per mention."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _uncovered(blocks: str) -> str:
    """The blocks none of whose ancestors is among them; ancestors are looked for up to the level of the highest block."""
    level = f"x div {_SHIFT}"
    above = f"transform(sequence({level} + 1, top), l -> l * {_SHIFT} + shiftrightunsigned(x % {_SHIFT}, int(l - {level})))"
    return _let("top", f"array_max({blocks}) div {_SHIFT}", f"filter({blocks}, x -> {level} = top or not arrays_overlap({above}, {blocks}))")


def _merged(blocks: str) -> str:
    """Spans struct(s, e) of the blocks left after merging sibling pairs upward: a fold over the levels, each step with
    the sorted indices of its level (own blocks and pairs merged below); siblings stand side by side there."""
    level = f"array_sort(array_union(acc.up, transform(filter({blocks}, x -> x div {_SHIFT} = l), x -> x % {_SHIFT})))"
    pair = "x % 2 = 0 and coalesce(get(c, i + 1) = x + 1, false)"
    of_pair = f"({pair} or (x % 2 = 1 and coalesce(get(c, i - 1) = x - 1, false)))"
    step = (
        f"transform(array({level}), c -> named_struct("
        f"'up', transform(filter(c, (x, i) -> {pair}), x -> x div 2), "
        f"'done', concat(acc.done, transform(filter(c, (x, i) -> not {of_pair}), x -> struct(shiftleft(x, int(l)) as s, shiftleft(x + 1, int(l)) as e)))))[0]"
    )
    start = "named_struct('up', cast(array() as array<bigint>), 'done', cast(array() as array<struct<s:bigint,e:bigint>>))"
    top = f"least({LEVELS}, array_max({blocks}) div {_SHIFT} + cast(ceil(log2(size({blocks}))) as bigint))"  # pairs halve with each level
    return f"array_sort(aggregate(sequence(0L, {top}), {start}, (acc, l) -> {step}, acc -> acc.done))"


def periods(spans: DataFrame, entity: list[str], first: str = "first_seen", last: str = "last_seen", counted: str = "days_observed") -> DataFrame:
    """entity columns, kind (period or gap), from_day and to_day as dates."""
    valid = spans.where(F.col(first).isNotNull() & F.col(last).isNotNull() & (F.col(last) >= F.col(first)) & (F.col(counted) >= 1))
    days = valid.select(*entity, (F.unix_date(first).cast("long") + _EPOCH).alias("a"), (F.unix_date(last).cast("long") + _EPOCH + 1).alias("b"))
    blocks = days.select(*entity, F.explode(dyadic_blocks("a", "b")).alias("block")).groupBy(*entity).agg(F.collect_set("block").alias("blocks"))
    rows = (
        "concat(transform(s, (x, i) -> struct('period' as kind, x as f, e[i] - 1 as t)), "
        "filter(transform(s, (x, i) -> struct('gap' as kind, get(e, i - 1) as f, x - 1 as t)), x -> x.f is not null))"
    )
    rows = _let("e", "transform(filter(spans, (x, i) -> coalesce(get(spans, i + 1).s > x.e, true)), x -> x.e)", rows)
    rows = _let("s", "transform(filter(spans, (x, i) -> coalesce(get(spans, i - 1).e < x.s, true)), x -> x.s)", rows)
    rows = F.expr(_let("kept", _uncovered("blocks"), _let("spans", _merged("kept"), rows)))
    day = lambda c: F.date_from_unix_date((F.col(c) - _EPOCH).cast("int"))
    return blocks.select(*entity, F.inline(rows)).select(*entity, "kind", day("f").alias("from_day"), day("t").alias("to_day"))
