"""Items of varying length in containers of fixed capacity, by length patterns fitted to the histogram of lengths.

Only the histogram (at most one count per length up to the capacity) comes to the driver. There, patterns of a few
documents that fill a container nearly whole are enumerated, their repeat counts fitted to the histogram by non-negative
least squares and rounded, and what they leave over is packed best-fit, whole groups of equal containers at a time. The
result is a table of intervals: the documents of length l with ranks from..to fill slot s of the containers from c on. Each
document then finds its place from its length and its rank among equal lengths; ranks are taken within salted shares, so a
length that a third of all documents have is no hot group.

Defined cases
    * an item above the capacity is cut into full containers and a rest, which is packed like any item; no other is cut.
    * items of null or zero size take no room: they have one row with piece 0, n_tokens 0 and no container.
    * equal items are placed by key order within their share; the result is the same for the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborlens.session import cut

#: Items of equal length that are numbered in one task; a length has as many shares as that needs.
ITEMS_A_SHARE = 1_000_000
#: Documents of a pattern at most, patterns kept for each longest length, and steps of the least-squares fit.
PATTERN_DOCS, PATTERNS_A_LENGTH, FIT_STEPS = 12, 8, 400


def enumerate_patterns(lengths: np.ndarray, capacity: int) -> list[tuple[tuple[int, int], ...]]:
    """Patterns ((length, copies), ...) of few documents: one long a, perhaps a b, and m copies of the longest c that fits.

    For each a, those that leave the least room are kept.
    """
    best_below = np.full(capacity + 1, 0, dtype=np.int64)  # the longest length up to each value
    best_below[lengths] = lengths
    best_below = np.maximum.accumulate(best_below)
    spread = np.unique(lengths[np.linspace(0, len(lengths) - 1, min(len(lengths), 24)).astype(int)])
    copies = np.arange(1, PATTERN_DOCS - 1)
    found: set[tuple[tuple[int, int], ...]] = set()
    for a in lengths.tolist():
        second = np.concatenate([[0], spread[(spread <= a) & (spread <= capacity - a)]])
        rest = capacity - a - second
        c = best_below[rest[:, None] // copies[None, :]]
        room = rest[:, None] - c * copies[None, :]
        order = np.argsort(room, axis=None, kind="stable")[:PATTERNS_A_LENGTH]
        for i, j in zip(*np.unravel_index(order, room.shape), strict=True):
            parts: dict[int, int] = {a: 1}
            for length, n in ((int(second[i]), 1), (int(c[i, j]), int(copies[j]))):
                if length:
                    parts[length] = parts.get(length, 0) + n
            found.add(tuple(sorted(parts.items(), reverse=True)))
    return sorted(found, reverse=True)


def fit_repeats(patterns: list[tuple[tuple[int, int], ...]], counts: np.ndarray) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - counts|, by accelerated projected gradient steps on the sparse A."""
    column = np.array([k for k, p in enumerate(patterns) for _ in p])
    row = np.array([length for p in patterns for length, _ in p])
    value = np.array([n for p in patterns for _, n in p], dtype=float)
    times = lambda x: np.bincount(row, value * x[column], minlength=len(counts))
    back = lambda r: np.bincount(column, value * r[row], minlength=len(patterns))
    v = np.ones(len(patterns))
    for _ in range(20):  # the largest singular value
        v = back(times(v))
        norm = np.linalg.norm(v)
        v /= norm
    step, x, y, t = 1 / norm, np.zeros(len(patterns)), np.zeros(len(patterns)), 1.0
    for _ in range(FIT_STEPS):
        new = np.maximum(0, y - step * back(times(y) - counts))
        following = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / following * (new - x), new, following
    return x


@dataclass
class Group:
    """n equal containers, each with these (length, copies) and this room."""

    parts: dict[int, int]
    n: int
    room: int


def plan(histogram: dict[int, int], capacity: int) -> list[Group]:
    """Groups of containers that hold every item of the histogram once."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        left[length] += n
    lengths = np.flatnonzero(left)
    if not len(lengths):
        return []
    patterns = enumerate_patterns(lengths, capacity)
    repeats = fit_repeats(patterns, left.astype(float))
    by_room: dict[int, list[Group]] = {}

    def keep(group: Group) -> None:
        if group.n:
            by_room.setdefault(group.room, []).append(group)

    for k in np.argsort(-repeats, kind="stable"):
        if (wanted := int(repeats[k] + 0.5)) == 0:
            break
        n = min(wanted, *(int(left[length]) // copies for length, copies in patterns[k]))
        if n:
            for length, copies in patterns[k]:
                left[length] -= n * copies
            keep(Group(dict(patterns[k]), n, capacity - sum(length * copies for length, copies in patterns[k])))
    # what is left over: longest first, each time into the fullest containers that still have the room
    for length in np.flatnonzero(left)[::-1].tolist():
        rest = int(left[length])
        for room in sorted(r for r in by_room if r >= length):
            while rest and by_room[room]:
                group, each = by_room[room].pop(), room // length
                each = min(each, rest)
                n = min(group.n, rest // each)
                keep(Group(group.parts | {length: group.parts.get(length, 0) + each}, n, room - each * length))
                keep(Group(group.parts, group.n - n, room))
                rest -= n * each
            if not rest:
                break
        if rest:
            each = capacity // length
            keep(Group({length: each}, rest // each, capacity - each * length))
            if rest % each:
                keep(Group({length: rest % each}, 1, capacity - rest % each * length))
    return [g for room in sorted(by_room) for g in by_room[room]]


def intervals(groups: list[Group]) -> np.ndarray:
    """Rows (length, first rank, copies, first container, offset), sorted: where the items of each length and rank go."""
    taken: dict[int, int] = {}
    rows, container = [], 0
    for group in groups:
        offset = 0
        for length in sorted(group.parts, reverse=True):
            copies = group.parts[length]
            rows.append((length, taken.get(length, 0), copies, container, offset))
            taken[length] = taken.get(length, 0) + copies * group.n
            offset += copies * length
        container += group.n
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pieces(sizes: DataFrame, capacity: int, key: str, size: str) -> DataFrame:
    """key, piece, start_token, n_tokens: an item as one piece, or cut where it alone exceeds the capacity."""
    n = F.coalesce(F.col(size), F.lit(0)).cast("bigint")
    last = F.greatest(F.expr(f"(coalesce({size}, 0) - 1) div {capacity}"), F.lit(0))
    cutted = sizes.select(key, n.alias("n"), F.explode(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"))).alias("piece"))
    start = F.col("piece") * capacity
    return cutted.select(key, "piece", start.alias("start_token"), F.least(F.lit(capacity), F.col("n") - start).cast("bigint").alias("n_tokens"))


def ranked(items: DataFrame, key: str, histogram: dict[int, int]) -> DataFrame:
    """rank of each piece among those of its length, from 0: the rank within its share plus the shares before."""
    per_length = items.sparkSession.createDataFrame([(length, n // ITEMS_A_SHARE + 1) for length, n in histogram.items()], "n_tokens bigint, shares bigint")
    salted = items.join(F.broadcast(per_length), "n_tokens")  # a row a length, so at most as many as the capacity
    salted = salted.withColumn("salt", F.pmod(F.xxhash64(key, "piece"), F.col("shares"))).drop("shares")
    shares = salted.groupBy("n_tokens", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("n_tokens").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = shares.select("n_tokens", "salt", before.alias("base"))
    within = F.row_number().over(Window.partitionBy("n_tokens", "salt").orderBy(key, "piece")) - 1
    return salted.withColumn("within", within).join(bases, ["n_tokens", "salt"]).withColumn("rank", F.col("within") + F.col("base")).drop("within", "base", "salt")


def pack(sizes: DataFrame, capacity: int, key: str = "doc_id", size: str = "n_tokens") -> DataFrame:
    """key, piece, start_token, n_tokens, container_id, offset."""
    all_pieces = cut(pieces(sizes, capacity, key, size))  # sizes are dear to make and read three times
    items = all_pieces.where("n_tokens > 0")
    counted = items.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect()  # at most `capacity` rows
    histogram = {r.n_tokens: r.n for r in counted}
    table = intervals(plan(histogram, capacity))
    shared = sizes.sparkSession.sparkContext.broadcast(table)  # follows the number of lengths, not of items
    schema = f"{key} bigint, piece bigint, start_token bigint, n_tokens bigint, container_id bigint, offset bigint"

    def place(batches):
        import pyarrow as pa

        rows = shared.value
        width = 1 << 40
        starts = rows[:, 0] * width + rows[:, 1]
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("n_tokens", "rank"))
            slot = rows[np.searchsorted(starts, length * width + rank, side="right") - 1]
            nth, copy = np.divmod(rank - slot[:, 1], slot[:, 2])
            columns = [batch.column(batch.schema.get_field_index(c)) for c in (key, "piece", "start_token", "n_tokens")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(slot[:, 3] + nth), pa.array(slot[:, 4] + copy * length)], names=[key, "piece", "start_token", "n_tokens", "container_id", "offset"])

    placed = ranked(items, key, histogram).select(key, "piece", "start_token", "n_tokens", F.col("rank").cast("bigint").alias("rank")).mapInArrow(place, schema)
    none = F.lit(None).cast("bigint")
    return placed.unionByName(all_pieces.where("n_tokens <= 0").withColumns({"container_id": none, "offset": none}))
