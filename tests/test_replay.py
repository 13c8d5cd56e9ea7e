import random

import pytest
from pyspark.sql import functions as F

from changeflow.operators.nodes import as_nodes
from changeflow.operators.replay import final_status, keep_allowed, log_position, change_of, replay, replay_dirs

RECORDS = "change_id int, part int, path string, change_action string"
ACTIONS = ["Add", "Add Copy", "Delete", "Edit", "Replace Copy", "Other"]


def simulate(rows, before=()):
    """The rule itself, one record at a time."""
    status, allowed = dict(before), {}
    for change, part, path, action in sorted(rows):
        now = status.setdefault(path, 0)
        ok = True
        if action in ("Add", "Add Copy"):
            ok = now == 0
            status[path] = 1
        elif action == "Delete":
            ok = now == 1
            status[path] = 0
        elif action in ("Edit", "Replace Copy"):
            ok = now == 1
        allowed[change, part] = ok
    return allowed, status


def _random_log(seed, n=700):
    rng = random.Random(seed)
    slots = sorted({(rng.randrange(1, 90), rng.randrange(1, 15)) for _ in range(n)})
    # One file holds a third of all records.
    return [(c, p, "hot" if rng.random() < 0.34 else f"f{rng.randrange(25)}", rng.choice(ACTIONS)) for c, p in slots]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("carried", [False, True])
def test_replay_equals_simulation(spark, tiny_segments, seed, carried):
    rows = _random_log(seed)
    before = {f"f{i}": i % 2 for i in range(0, 30, 2)} | {"hot": 1} if carried else {}
    df = spark.createDataFrame(rows, RECORDS).repartition(4)
    previous = spark.createDataFrame(list(before.items()), "path string, status int") if carried else None
    allowed, status = simulate(rows, before)
    got = replay(df, previous).collect()
    assert {(r.change_id, r.part): r.allowed for r in got} == allowed and len(got) == len(rows)
    assert {r.path: r.status for r in final_status(df, previous).collect()} == status


@pytest.mark.parametrize("case", [
    (["Add", "Add"], [True, False]),
    (["Delete", "Add"], [False, True]),
    (["Edit", "Add", "Edit"], [False, True, True]),
    (["Add", "Delete", "Add", "Edit"], [True, True, True, True]),
    (["Other", "Replace Copy"], [True, False]),
])
def test_small_logs(spark, case):
    actions, expected = case
    df = spark.createDataFrame([(1, i, "p", a) for i, a in enumerate(actions, 1)], RECORDS)
    assert [r.allowed for r in replay(df).orderBy("part").collect()] == expected


def test_log_position_is_exact_at_the_limits(spark):
    top = 2**31 - 1
    df = spark.createDataFrame([(top, top), (top, 0), (1, top)], "c int, p int")
    rows = df.select("c", "p", log_position(F.col("c"), F.col("p")).alias("pos")).withColumn("back", change_of(F.col("pos")))
    assert all(r.back == r.c and r.pos == r.c * 2**31 + r.p for r in rows.collect())


@pytest.mark.parametrize("seed", range(4))
def test_directory_fast_path_equals_simulation(spark, seed):
    rng = random.Random(seed)
    rows = [(c, p, f"d{rng.randrange(9)}/", "Add") for c in range(1, 30) for p in range(1, 4)]
    rows += [(99, i, f"d{i}/", "Delete") for i in range(1, 12, 2)]
    before = {f"d{i}/": rng.randrange(2) for i in range(0, 12, 3)}
    df = spark.createDataFrame(rows, RECORDS)
    previous = spark.createDataFrame(list(before.items()), "path string, status int")
    allowed, _ = simulate(rows, before)
    got = {(r.change_id, r.part, r.path, r.change_action) for r in replay_dirs(df, previous).collect()}
    assert got == {r for r in rows if allowed[r[0], r[1]]}
    top = 2**31 - 1
    edge = spark.createDataFrame([(top, top, "d/", "Add")], RECORDS)
    assert [tuple(r) for r in replay_dirs(edge).collect()] == [(top, top, "d/", "Add")]


def test_keep_allowed_joins_headers_files_and_directories(spark):
    rows = [
        (1, 0, None, None, None), (1, 1, "t/", "Add", "dir"), (1, 2, "t/f", "Add", "file"),
        (2, 0, None, None, None), (2, 1, "t/", "Add", "dir"), (2, 2, "t/f", "Add", "file"),
        (3, 0, None, None, None), (3, 1, "t/", "Delete", "dir"), (3, 2, "/", "Delete", "dir"),
    ]
    df = as_nodes(spark.createDataFrame(rows, RECORDS + ", node_kind string"))
    kept = {(r.change_id, r.part) for r in keep_allowed(df).collect()}
    assert kept == {(1, 0), (1, 1), (1, 2), (2, 0), (3, 0), (3, 1)}


def test_replay_queries_store_only_what_replay_reads(spark, monkeypatch):
    from changeflow.queries import common, replays

    stored = {}
    stage = common.stage
    monkeypatch.setattr(common, "stage", lambda df, name: stored.update({name: df.columns}) or stage(df, name))
    records = replays._records(spark, "/root/testdata/sf0.001")
    narrow = ["change_id", "part", "path", "change_action", "node_kind"]
    assert records.columns == narrow and stored["replay-records"] == narrow and "node-records" not in stored
    whole = common.Log(spark, "/root/testdata/sf0.001").records.select(*narrow)
    assert sorted(map(tuple, records.collect())) == sorted(map(tuple, whole.collect()))
