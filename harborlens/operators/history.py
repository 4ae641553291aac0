"""Full history of changing attributes from daily snapshots.

Consecutive snapshots meet in a null-safe full outer join that tells inserted, changed, unchanged and deleted states apart.
The change events carry valid_from, and ``lead`` over an entity's events gives valid_to. Numbering, join and ``lead`` all
stand on one distribution by entity: Spark's join operator would shuffle both sides again by (entity, snapshot), so the full
outer join is made by grouping the rows of both sides on that key, which is null-safe and needs no exchange there. An entity has at most one row per day once its day's row is chosen, so no entity is
hot after that aggregation, which combines on the map side.

Defined cases
    * partial snapshots: a day without a row says nothing, the last state stays in force until a day with another one.
    * complete snapshots: an entity without a row on a day of which there are rows is deleted; its version ends the day before.
    * attributes and entities are compared null-safely; ties of the ordering column are settled by the tie column.
    * no rows give no history; columns other than those named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FOREVER = "9999-12-31"


def day_states(rows: DataFrame, entity: list[str], day: str, latest_by: list[str], attributes: dict[str, Column]) -> DataFrame:
    """One row per entity and day: the attributes of the row that is greatest by latest_by (nulls lowest)."""
    best = F.max(F.struct(*[F.col(c).alias(f"by_{i}") for i, c in enumerate(latest_by)], *[v.alias(k) for k, v in attributes.items()]))
    return rows.groupBy(*entity, day).agg(best.alias("best")).select(*entity, day, *[F.col(f"best.{a}").alias(a) for a in attributes])


def _calendar(states: DataFrame, day: str) -> DataFrame:
    """at, snapshot: the days of which there are rows, numbered. As many as the calendar has, so one window holds them."""
    days = states.select(F.col(day).alias("at")).distinct()
    return days.withColumn("snapshot", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("at")))


def _outer(rows: DataFrame, key: str, number: str, state: str) -> DataFrame:
    """key, number, now, old: the full outer join of the rows with those of the number before, at most one of each; keys null-safe."""
    sides = F.array(F.struct(F.col(number).alias("at"), F.col(state).alias("now"), F.when(F.lit(False), F.col(state)).alias("old")), F.struct((F.col(number) + 1).alias("at"), F.when(F.lit(False), F.col(state)).alias("now"), F.col(state).alias("old")))
    return rows.select(key, F.inline(sides)).groupBy(key, F.col("at").alias(number)).agg(F.max("now").alias("now"), F.max("old").alias("old"))


def _events(states: DataFrame, entity: list[str], day: str, attributes: list[str], complete: bool) -> DataFrame:
    """entity (a struct, equal where its parts are equal or both null), at, state, event."""
    numbered = states.select(F.struct(*entity).alias("entity"), F.struct(day, *attributes).alias("state"))
    if complete:
        calendar = _calendar(states, day)
        numbered = numbered.join(calendar, F.col(f"state.{day}") == F.col("at")).drop("at")
    else:  # an entity's own days follow each other
        numbered = numbered.withColumn("snapshot", F.row_number().over(Window.partitionBy("entity").orderBy(f"state.{day}")))
    both = _outer(numbered, "entity", "snapshot", "state")
    alike = F.lit(True)
    for a in attributes:
        alike = alike & F.col(f"now.{a}").eqNullSafe(F.col(f"old.{a}"))
    event = F.when(F.col("old").isNull(), "inserted").when(F.col("now").isNull(), "deleted").when(alike, "unchanged").otherwise("changed")
    out = both.select("entity", "snapshot", F.coalesce("now", "old").alias("state"), event.alias("event"))
    if complete:  # after the last snapshot nothing is known to be gone: its number + 1 is no day
        return out.join(calendar, "snapshot").drop("snapshot")
    return out.where("event <> 'deleted'").withColumn("at", F.col(f"state.{day}")).drop("snapshot")


def differences(states: DataFrame, entity: list[str], day: str, attributes: list[str], complete: bool = False) -> DataFrame:
    """entity, day, attributes, event: how each snapshot differs from the one before.

    ``deleted`` occurs with complete snapshots, stands on the first day without the entity and carries its last attributes.
    """
    events = _events(states, entity, day, attributes, complete)
    return events.select(*[F.col(f"entity.{c}").alias(c) for c in entity], F.col("at").alias(day), *[F.col(f"state.{a}").alias(a) for a in attributes], "event")


def versions(states: DataFrame, entity: list[str], day: str, attributes: list[str], complete: bool = False) -> DataFrame:
    """entity, attributes, valid_from, valid_to: one row per period in which the attributes stayed the same."""
    changes = _events(states, entity, day, attributes, complete).where("event <> 'unchanged'")
    following = F.lead("at").over(Window.partitionBy("entity").orderBy("at"))
    periods = changes.withColumn("valid_to", F.coalesce(F.date_sub(following, 1), F.lit(FOREVER).cast("date"))).where("event <> 'deleted'")
    return periods.select(*[F.col(f"entity.{c}").alias(c) for c in entity], *[F.col(f"state.{a}").alias(a) for a in attributes], F.col("at").alias("valid_from"), "valid_to")
