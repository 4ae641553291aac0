import random
from collections import Counter

import pytest

from harborlens.llm import packing


def first_fit_decreasing(sizes, capacity):
    rooms = []
    for s in sorted(sizes, reverse=True):
        for i, room in enumerate(rooms):
            if room >= s:
                rooms[i] -= s
                break
        else:
            rooms.append(capacity - s)
    return len(rooms)


@pytest.mark.parametrize("capacity,seed", [(64, 1), (512, 2), (2048, 3), (7, 4), (1, 5)])
def test_plan_holds_every_item_once(capacity, seed):
    rng = random.Random(seed)
    sizes = [min(capacity, max(1, int(rng.lognormvariate(4, 1)))) for _ in range(1500)]
    groups = packing.plan(Counter(sizes), capacity)
    used = Counter()
    for g in groups:
        assert 0 <= g.room == capacity - sum(a * n for a, n in g.parts.items())
        for a, n in g.parts.items():
            used[a] += n * g.n
    assert used == Counter(sizes)
    assert sum(g.n for g in groups) <= first_fit_decreasing(sizes, capacity) * 1.02 + 1


def test_pack(spark):
    rng = random.Random(6)
    sizes = [None, 0, 0, 100, 101, 250] + [rng.choice([30, 30, 30, 7, 99, 512]) for _ in range(800)]
    df = spark.createDataFrame([(i, s, i) for i, s in enumerate(sizes)], "doc_id bigint, n_tokens bigint, container_id int")
    placed = packing.pack(df, 100).collect()
    pieces, inside = Counter(), {}
    for r in placed:
        pieces[r.doc_id] += r.n_tokens
        if r.n_tokens:
            inside.setdefault(r.container_id, []).append((r.offset, r.offset + r.n_tokens))
        else:
            assert (r.piece, r.container_id) == (0, None)
    assert pieces == Counter({i: s or 0 for i, s in enumerate(sizes)})
    for spans in inside.values():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] <= 100 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert sorted(inside) == list(range(len(inside)))
    cut = [r for r in placed if r.doc_id == 5]
    assert sorted((r.piece, r.start_token, r.n_tokens) for r in cut) == [(0, 0, 100), (1, 100, 100), (2, 200, 50)]
    assert sum(1 for r in placed if r.doc_id == 3) == 1
    assert sorted(map(tuple, placed), key=repr) == sorted(map(tuple, packing.pack(df, 100).collect()), key=repr)


def test_shares_of_a_hot_length_change_no_rank_twice(spark, monkeypatch):
    monkeypatch.setattr(packing, "ITEMS_A_SHARE", 50)
    df = spark.range(1000).selectExpr("id as doc_id", "if(id % 3 = 0, 40L, 7L) as n_tokens")
    placed = packing.pack(df, 100).collect()
    assert len({(r.container_id, r.offset) for r in placed}) == 1000
    room = Counter()
    for r in placed:
        room[r.container_id] += r.n_tokens
    assert max(room.values()) <= 100 and len(room) <= 210  # 191 would do


def test_no_items(spark):
    df = spark.createDataFrame([], "doc_id bigint, n_tokens bigint")
    assert packing.pack(df, 100).isEmpty() and packing.plan({}, 100) == []
