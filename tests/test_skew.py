import random

import pytest
from pyspark.sql import functions as F

from changeflow.operators.numbering import identity_numbers, number_changes, number_rows, prefix_sum, serial_numbers
from changeflow.operators.skew import running, segment_of
from changeflow.options import Branch, MigrationOptions


def _log(spark, n=600):
    rng = random.Random(5)
    # A third of the rows share one key.
    rows = [("hot" if rng.random() < 0.34 else f"k{rng.randrange(40)}", i, rng.choice([None, None, 0, 1])) for i in range(n)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "key string, pos int, v int").repartition(5)


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_running_equals_brute_force(spark, tiny_segments, reuse):
    rows, df = _log(spark)
    sums, lasts = {}, {}
    for key in {r[0] for r in rows}:
        total, last = 0, None
        for _, pos, v in sorted((r for r in rows if r[0] == key), key=lambda r: r[1]):
            total += 1
            sums[key, pos], lasts[key, pos] = total, last
            last = v if v is not None else last
    segment = segment_of(F.col("pos"))
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    got = running(df, ["key"], ["pos"], segment, F.lit(1), "sum", "out").collect()
    assert {(r.key, r.pos): r.out for r in got} == sums and len(got) == len(rows)
    got = running(df, ["key"], ["pos"], segment, F.col("v"), "last", "out").collect()
    assert {(r.key, r.pos): r.out for r in got} == lasts and len(got) == len(rows)
    spark.conf.unset("spark.sql.exchange.reuse")


def test_prefix_sum_over_many_blocks(spark, tiny_segments):
    ids = random.Random(1).sample(range(1, 2**31 - 1), 300) + [2**31 - 1]
    df = spark.createDataFrame([(i, i % 3) for i in ids], "id int, w int")
    got = {r.id: r.s for r in prefix_sum(df, "id", F.col("w"), "s").collect()}
    total = 0
    for i in sorted(ids):
        total += i % 3
        assert got[i] == total


def test_prefix_sum_over_full_width_blocks(spark):
    ids = list(range(65_530, 65_545)) + [10**6, 2**31 - 1]
    df = spark.createDataFrame([(i,) for i in ids], "id int")
    got = {r.id: r.s for r in prefix_sum(df, "id", F.lit(1), "s").collect()}
    assert [got[i] for i in ids] == list(range(1, len(ids) + 1))


def test_numbering(spark):
    df = spark.createDataFrame([(5, True), (2, False), (9, True), (1, True)], "change_id int, kept boolean")
    numbers = lambda d: {r.change_id: r.revision for r in d.collect()}
    assert numbers(serial_numbers(df)) == {1: 1, 2: 0, 5: 2, 9: 3}
    assert numbers(serial_numbers(df, 100)) == {1: 101, 2: 0, 5: 102, 9: 103}
    assert numbers(identity_numbers(df)) == {1: 1, 2: 0, 5: 5, 9: 9}
    assert numbers(serial_numbers(df.withColumn("kept", F.lit(False)))) == {1: 0, 2: 0, 5: 0, 9: 0}
    assert numbers(serial_numbers(df.where("false"))) == {}
    own = MigrationOptions(
        (Branch("a", "b"),), numbering=lambda d, base: d.withColumn("revision", F.col("change_id") * 10 + base)
    )
    assert numbers(number_changes(df, own, 3))[5] == 53


def test_number_rows_counts_down_the_whole_frame(spark):
    names = [f"d{i:04d}/" for i in range(500)]
    random.Random(2).shuffle(names)
    df = spark.createDataFrame([(n,) for n in names], "path string").repartition(7)
    got = number_rows(df, [F.col("path").desc()], "part").collect()
    assert [r.path for r in sorted(got, key=lambda r: r.part)] == sorted(names, reverse=True)
    assert sorted(r.part for r in got) == list(range(1, 501))


def test_scratch_folders_can_be_dropped(spark):
    import os

    from changeflow import session

    held = list(getattr(spark.sparkContext, "_changeflow_scratch", []))
    spark.sparkContext._changeflow_scratch = []
    one = session.stage(spark.range(3), "kept")
    path = one.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    session.scratch_path(spark, "never-written")
    assert os.path.isdir(path) and one.count() == 3
    assert session.drop_scratch(spark) == 1 and not os.path.exists(path)
    assert session.drop_scratch(spark) == 0
    spark.sparkContext._changeflow_scratch = held
