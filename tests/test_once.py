from datetime import datetime

from harborlens.operators.once import SeenState, copies, deliver, deliver_batch, first_arrivals, keep_once, land
from harborlens.session import scratch_path

SCHEMA = "obs_id bigint, ip string, port int, hash string, banner_ts timestamp_ntz, shard string"


def at(second, micro=0):
    return datetime(2025, 9, 1, 0, 0, second, micro)


CASES = [
    (1, "a", 1, "12", at(1), "x"),
    (2, "a", 2, " 12.0", at(1, 500), "x"),  # a copy: the port doesn't matter, the hash is a number
    (3, "b", 1, "12", at(1), "x"),  # another ip
    (4, "a", 1, "12", at(2), "x"),  # another second
    (5, "a", 1, None, at(1), None),
    (6, "a", 1, "None", at(1, 9), None),  # a copy of 5
    (7, "a", 2, None, at(1), None),  # another port
    (8, "a", 1, "12", None, None),
    (9, "a", 1, "12", None, None),  # without time: like no other
    (10, "a", None, None, at(3), None),
    (11, "a", None, None, at(3), None),  # a copy: both without port
    (12, "a", 1, "-5", at(1), None),
    (13, "a", 1, "-5.0", at(1), None),
    (14, "a", 1, "5", at(1), None),
    (15, "c", 1, "", at(1), None),
    (16, "c", 1, "xyz", at(1), None),
    (17, "c", 1, "xyz", at(1), None),
    (18, "d", 1, "12.5", at(1), None),
    (19, "d", 1, "13", at(1), None),  # no copy: 12.5 is no whole number
]


KEPT = {1, 3, 4, 5, 7, 10, 12, 14, 15, 16, 18, 19}


def test_copies_and_kept_rows(spark, rows):
    df = spark.createDataFrame(CASES, SCHEMA)
    assert rows(copies(df)) == sorted([(2,), (6,), (11,), (13,), (17,)], key=repr)
    kept = keep_once(df)
    assert kept.columns == df.columns
    assert {r.obs_id for r in kept.collect()} == {c[0] for c in CASES} - {2, 6, 11, 13, 17}
    for n in (1, 2, 7):
        assert {r.obs_id for r in first_arrivals(df, n).collect()} == KEPT


def test_batches_give_the_same_as_one(spark):
    df = spark.createDataFrame(CASES, SCHEMA)
    state = SeenState(spark, scratch_path(spark, "seen"), buckets=3)
    kept = set()
    for low, high in ((0, 4), (4, 9), (9, 9), (9, 99)):
        batch = df.where(f"obs_id > {low} and obs_id <= {high}")
        kept |= {r.obs_id for r in deliver_batch(batch, state).collect()}
    assert kept == KEPT
    state.end()
    state = SeenState(spark, state.root)  # taken up again
    assert not deliver_batch(df, state).collect()  # a batch that arrives again brings nothing
    assert state.buckets == 3
    n = state.dictionary().count()
    assert n == state.bitmaps().selectExpr("sum(bitmap_count(bitmap))").head()[0] == len(kept)
    assert state.dictionary().groupBy("shard", "ordinal").count().where("count > 1").isEmpty()
    plan = state.dictionary().groupBy("message").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # the history lies by bucket
    state.end()


def test_the_bit_decides_and_not_the_dictionary(spark):
    df = spark.createDataFrame(CASES, SCHEMA)
    state = SeenState(spark, scratch_path(spark, "seen"))
    land(df, state)  # encoded, never delivered
    assert state.deliveries() == []
    arrivals = land(df, state)
    assert {r.obs_id for r in deliver(arrivals, state).collect()} == KEPT
    assert deliver(arrivals, state).isEmpty()
    state.end()


def test_many_deliveries_are_merged(spark, monkeypatch):
    monkeypatch.setattr("harborlens.operators.once.MERGE_FROM", 2)
    df = spark.createDataFrame(CASES, SCHEMA)
    state = SeenState(spark, scratch_path(spark, "seen"))
    kept = [r.obs_id for i in (1, 5, 10, 15, 99) for r in deliver_batch(df.where(f"obs_id < {i}"), state).collect()]
    assert sorted(kept) == sorted(KEPT) and len(state.deliveries()) <= 2
    state.end()


def test_a_batch_that_dies_leaves_the_state(spark, monkeypatch):
    df = spark.createDataFrame(CASES, SCHEMA)
    state = SeenState(spark, scratch_path(spark, "seen"))
    with monkeypatch.context() as m:
        m.setattr(SeenState, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError()))
        try:
            deliver_batch(df, state)
        except RuntimeError:
            pass
    assert state.deliveries() == []
    assert {r.obs_id for r in deliver_batch(df, state).collect()} == KEPT
    state.end()


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert copies(df).isEmpty() and keep_once(df).isEmpty()


def test_a_hot_message(spark):
    df = spark.range(1, 5001).selectExpr("id as obs_id", "'a' as ip", "1 as port", "'7' as hash", "timestamp_ntz'2025-01-01 00:00:00' as banner_ts")
    assert copies(df).count() == 4999
