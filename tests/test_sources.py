from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from changeflow import schema
from changeflow.operators.changes import in_range, last_per_key, late_changes
from changeflow.options import Branch, MigrationOptions
from changeflow.sources import legacy, nested
from changeflow.sources import state as tables
from changeflow.sources.state import load_state, merge_latest, save_run_meta, save_table
from changeflow.operators.numbering import prefix_sum
from changeflow.sources.tables import changes_touching, read_changelists, read_table
from changeflow.streaming import keyed_replay as keyed
from changeflow.streaming.replay_stream import ReplayState, flush_replay, migrate_stream, replay_stream

OPTIONS = MigrationOptions(branches=(Branch("//d/main/", "trunk/"), Branch("//d/rel/", "rel/")), from_change=1)


def test_range_bounds(spark):
    df = spark.range(1, 6).select(F.col("id").cast("int").alias("change_id"))
    assert [r[0] for r in in_range(df, 2, 4).collect()] == [3, 4]
    assert df.count() == in_range(df).count()
    assert late_changes(df, 3).first()[0] == 3


def test_repeated_ids_keep_the_last_row(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (2, "c", 2), (1, "d", 2)], "change_id int, v string, at int")
    assert {r.change_id: r.v for r in last_per_key(df, "change_id", "at").collect()} == {1: "b", 2: "c"}
    assert [r.v for r in read_changelists(df, OPTIONS, "at").collect()] == ["c"]


def test_changes_touching_several_branches_come_once(spark):
    changes = spark.createDataFrame([(i, "u", datetime(2024, 1, 1), "d") for i in (1, 2, 3)], schema.CHANGELISTS)
    files = spark.createDataFrame(
        [(2, 1, "//d/main/a", 1, "ADD", "text"), (2, 2, "//d/rel/a", 1, "ADD", "text"), (3, 1, "//x", 1, "ADD", "text")],
        schema.FILE_REVISIONS,
    )
    assert [r.change_id for r in changes_touching(changes, files, OPTIONS).collect()] == [2]


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "files")
    spark.createDataFrame([(2, 1, "//d/main/a", 1, "ADD", "text")], schema.FILE_REVISIONS).write.parquet(path)
    from changeflow.operators.changes import wanted_files

    files = in_range(read_table(spark, path, schema.FILE_REVISIONS), 1, 9)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = wanted_files(files, OPTIONS).select("svn_path")._jdf.queryExecution().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters"):]
    assert "StringStartsWith(depot_path,//d/main/)" in pushed and "GreaterThan(change_id,1)" in pushed
    assert "ReadSchema: struct<change_id:int,depot_path:string>" in pushed


def test_other_formats(spark, tmp_path):
    df = spark.createDataFrame([(1, 0)], schema.REVISION_MAP)
    for kind in ("orc", "json", "csv"):
        df.write.format(kind).save(str(tmp_path / kind))
        assert read_table(spark, str(tmp_path / kind), schema.REVISION_MAP, kind).collect() == df.collect()
    assert read_table(spark, df) is df


def test_old_state_files(spark, tmp_path):
    (tmp_path / "files").write_text("tmp/1/1\ntrunk/:Add\ntmp/1/2\ntrunk/a:b:Edit\ntmp/1/2\ntrunk/c:Delete\nodd")
    (tmp_path / "dirsUsage").write_text("trunk/\n2\n/\n-1\n")
    (tmp_path / "revisionByChangeListId").write_text("1\n1\n2\n0\n")
    (tmp_path / "changeLists").write_text("1\n2\n")
    (tmp_path / "fileStatuses").write_text("trunk/\n1\n")
    state = legacy.import_legacy_state(spark, str(tmp_path))
    rows = lambda name: sorted(tuple(r) for r in state[name].collect())
    assert rows("node_records") == [(1, 1, "trunk/", "Add"), (1, 2, "trunk/c", "Delete")]
    assert rows("dir_usage") == [("/", -1), ("trunk/", 2)]
    assert rows("revision_map") == [(1, 1), (2, 0)]
    assert rows("changes") == [(1,), (2,)]
    assert rows("path_status") == [("trunk/", 1)]


def test_old_dump_directory_is_assembled(spark, tmp_path):
    from test_jobs import HEADER, _dumps

    from changeflow.sinks.dump import write_dump

    root = tmp_path / "dump"
    parts = {"2/0": "r2;", "2/1": "edit;", "2/2": "junk;", "10/0": "r10;", "10/1": "again;", "10/2": "gone;", "2/ok": ""}
    for name, text in parts.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(text)
    actions = {"2/1": "t/f:Edit", "2/2": "t/a:b:Edit", "10/1": "t/f:Add", "10/2": "t/f:Delete"}
    (root / "files").write_text("".join(f"tmp/{k}\n{v}\n" for k, v in actions.items()))
    for name in ("dirsUsage", "revisionByChangeListId", "changeLists", "fileStatuses"):
        (root / name).write_text("")
    live = spark.createDataFrame([("t/f", 1)], schema.PATH_STATUS)
    # A path with a colon loses its action in the old format, and so its part is always kept.
    expected = {None: b"r2;junk;r10;again;gone;", live: b"r2;edit;junk;r10;gone;"}
    for i, (previous, body) in enumerate(expected.items()):
        out = str(tmp_path / f"out{i}")
        write_dump(legacy.assemble_parts(spark, str(root), OPTIONS, previous), out)
        assert _dumps(spark, out) == {0: HEADER + body}


def test_path_with_colon_in_old_records(spark):
    df = spark.createDataFrame([("k", "a:b:Edit")], "key string, value string")
    assert tuple(legacy.split_path_action(df).first()) == ("k", "a", "b")
    assert tuple(legacy.split_path_action(df, "corrected").first()) == ("k", "a:b", "Edit")


def test_lines_are_numbered_across_file_splits(spark, tmp_path):
    (tmp_path / "big").write_text("".join(f"{i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = legacy.read_lines(spark, str(tmp_path / "big"))
        assert spark.read.text(str(tmp_path / "big")).rdd.getNumPartitions() > 4
        assert all(r.line_no == int(r.value) + 1 for r in lines.collect())
        assert legacy.read_pairs(spark, str(tmp_path / "big")).where("key + 1 = value").count() == 2500
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_export_and_import_meet(spark, tmp_path):
    df = spark.createDataFrame([(i, i * 2) for i in range(200)], "change_id int, revision int").repartition(3)
    legacy.export_pairs(df, "change_id", "revision", str(tmp_path / "pairs"))
    got = legacy.read_pairs(spark, str(tmp_path / "pairs"))
    assert {int(r.key): int(r.value) for r in got.collect()} == {i: i * 2 for i in range(200)}
    legacy.export_list(df, "change_id", str(tmp_path / "list"))
    assert legacy.read_list(spark, str(tmp_path / "list")).count() == 200


def test_state_tables(spark, tmp_path):
    root = str(tmp_path)
    assert load_state(spark, root).run_id is None
    save_table(root, "r1", "revision_map", spark.createDataFrame([(1, 1)], schema.REVISION_MAP))
    # Without its run_meta row the run is not visible.
    assert load_state(spark, root).run_id is None
    save_run_meta(spark, root, "r1", 1, 1)
    save_run_meta(spark, root, "r2", 5, 3)
    state = load_state(spark, root)
    assert (state.run_id, state.last_change_id, state.last_revision) == ("r2", 5, 3)
    assert state.path_status.count() == 0
    assert load_state(spark, root, "r1").revision_map.count() == 1
    with pytest.raises(ValueError):
        load_state(spark, root, "none")
    old = spark.createDataFrame([("a", 1), ("b", 1)], schema.PATH_STATUS)
    new = spark.createDataFrame([("b", 0), ("c", 1)], schema.PATH_STATUS)
    assert {r.path: r.status for r in merge_latest(old, new, "path", "status").collect()} == {"a": 1, "b": 0, "c": 1}


def _out(spark, root):
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/out").collect()


def test_replay_stream_over_many_batches(spark, tmp_path):
    from test_replay import RECORDS, _random_log, simulate

    rows = _random_log(3, 200)
    root = str(tmp_path)
    allowed, status = simulate(rows)
    schema_ = spark.createDataFrame([], RECORDS).schema
    cuts = [0, 20, 45, 70, 99]
    for step, (low, high) in enumerate(zip(cuts, cuts[1:])):
        # The change at each boundary is split: its even parts come one batch later.
        arriving = [r for r in rows if low < r[0] + (r[0] in cuts[1:-1] and r[1] % 2 == 0) <= high]
        if step == 2:
            arriving.append((5, 999, "late", "Add"))
        spark.createDataFrame(arriving, RECORDS).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(schema_).parquet(f"{root}/in")
        replay_stream(stream, f"{root}/state", f"{root}/out", f"{root}/cp", compact_every=2).awaitTermination()
        if step == 1:  # the newest change is held back
            halves = {r[:2] for r in rows if r[0] == high}
            assert not halves & {(r.change_id, r.part) for r in _out(spark, root)}
    flush_replay(spark, schema_, f"{root}/state", f"{root}/out", 3, compact_every=2)
    got = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/out").collect()
    assert {(r.change_id, r.part): r.allowed for r in got} == allowed and len(got) == len(rows)
    state = ReplayState(spark, f"{root}/state", 2)
    assert {r.path: r.status for r in state.statuses(4).collect()} == status
    assert spark.read.parquet(f"{root}/state/seen/2").first().late_rows == 1


def test_replay_stream_goes_on_after_a_flush(spark, tmp_path):
    from test_replay import RECORDS, simulate

    root = str(tmp_path)
    rows = [(1, 1, "a", "Add"), (2, 1, "b", "Add"), (2, 2, "a", "Delete"), (3, 1, "a", "Edit"), (4, 1, "b", "Edit")]
    schema_ = spark.createDataFrame([], RECORDS).schema
    for batch, arriving in enumerate((rows[:3], [*rows[3:], (2, 3, "b", "Delete")])):
        spark.createDataFrame(arriving, RECORDS).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(schema_).parquet(f"{root}/in")
        replay_stream(stream, f"{root}/state", f"{root}/out", f"{root}/cp", compact_every=1).awaitTermination()
        flush_replay(spark, schema_, f"{root}/state", f"{root}/out", batch, compact_every=1)
    allowed, status = simulate(rows)
    got = _out(spark, root)
    assert {(r.change_id, r.part): r.allowed for r in got} == allowed and len(got) == len(rows)
    assert {r.path: r.status for r in ReplayState(spark, f"{root}/state", 1).statuses(2).collect()} == status
    assert spark.read.parquet(f"{root}/state/seen/1").first().late_rows == 1


def test_migrate_stream_runs_increments(spark, tmp_path):
    import test_jobs as jobs

    root = str(tmp_path)
    log = jobs._log(spark)
    for low, high in ((0, 2), (2, 3)):
        arriving = log.changelists.where((F.col("change_id") > low) & (F.col("change_id") <= high))
        arriving.write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(schema.CHANGELISTS).parquet(f"{root}/in")
        options = jobs.replace(jobs.OPTIONS, cleanup=False)
        migrate_stream(stream, log, options, f"{root}/s", f"{root}/out", f"{root}/cp").awaitTermination()
    assert jobs._dumps(spark, f"{root}/out/000000000")[0] == jobs.HEADER + jobs.R1 + jobs.R2
    assert jobs._dumps(spark, f"{root}/out/000000001")[0] == jobs.HEADER + jobs.R3
    assert load_state(spark, f"{root}/s").last_revision == 3


def test_layers_fold_by_size_and_the_newest_row_counts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "ROWS_PER_BUCKET", 40)
    now, want, written = tables.empty_state(spark, str(tmp_path)), {}, []
    sizes = [100, 3, 3, 10, 1, 0, 2, 60, 1]
    for step, size in enumerate(sizes):
        rows = [(f"p{(7 * step + k) % 120}", step) for k in range(size)]
        want.update(rows)
        layers = tables.add_layer(now, f"r{step}", "path_status", spark.createDataFrame(rows, schema.PATH_STATUS))
        written.append(layers[-1].rows)
        now = replace(now, layers={"path_status": layers})
        assert all(a.rows > tables.FOLD * b.rows for a, b in zip(layers, layers[1:]))
    assert {r.path: r.status for r in now.path_status.collect()} == want
    assert written[:6] == [100, 3, 6, 16, 1, 1] and now.layers["path_status"][0].buckets > 1
    asked = spark.createDataFrame([("p3",), ("p7",), ("none",)], "path string")
    found = now.lookup("path_status", asked)
    assert {r.path: r.status for r in found.collect()} == {p: want[p] for p in ("p3", "p7")}
    # A look-up names the folders it needs.
    plan = found._jdf.queryExecution().toString()
    assert "_bucket IN" in plan or "_bucket#" in plan
    newer = spark.createDataFrame([("p3", 77), ("p9", 78)], schema.PATH_STATUS)
    assert {r.path: r.status for r in now.lookup("path_status", asked, newer).collect()} == {"p3": 77, "p7": want["p7"]}


def test_keyed_state_replays_closed_changes_in_order(spark, tmp_path):
    root = str(tmp_path)
    steps = [
        [(1, 2, "a", "Delete"), (1, 1, "a", "Add"), (2, 1, "b", "Edit"), (3, 1, "a", "Edit")],
        [(3, 2, "a", "Add"), (4, 1, "b", "Add"), (2, 5, "b", "Add")],  # the last one is too late
        [(5, 1, "b", "Replace Copy"), (5, 2, "c", "Add Copy"), (6, 1, "b", "Delete")],
    ]
    seen = []
    for rows in steps:
        spark.createDataFrame(rows, keyed.ROWS).write.mode("append").parquet(f"{root}/in")
        source = spark.readStream.schema(spark.read.parquet(f"{root}/in").schema).parquet(f"{root}/in")
        keyed.keyed_replay(source, f"{root}/out", f"{root}/checkpoint").awaitTermination()
        seen.append({tuple(r) for r in spark.read.parquet(f"{root}/out").collect()})
    first = {(1, 1, "a", "Add", True), (1, 2, "a", "Delete", True), (2, 1, "b", "Edit", False)}
    second = {(3, 1, "a", "Edit", False), (3, 2, "a", "Add", True)}
    third = {(4, 1, "b", "Add", True), (5, 1, "b", "Replace Copy", True), (5, 2, "c", "Add Copy", True)}
    assert seen == [first, first | second, first | second | third]


def test_nested_changes_by_partition_filter_and_stream(spark, tmp_path):
    path = str(tmp_path / "nested")
    when = datetime(2024, 1, 2, 3, 4, 5, 678900)
    changes = [(i, f"u{i}" if i % 3 else None, when, f"text {i}\n\"é\"") for i in range(1, 31)]
    files = [(i, k, f"//d/main/f{k}", i, "EDIT", "text") for i in range(1, 31) if i % 4 for k in (1, 2)]
    changes_df = spark.createDataFrame(changes, schema.CHANGELISTS)
    files_df = spark.createDataFrame(files, schema.FILE_REVISIONS)
    first = (changes_df.where("change_id <= 20"), files_df.where("change_id <= 20"))
    assert nested.export_changes(*first, path, ids_per_file=10).agg(F.sum("changes")).first()[0] == 20

    def stream():
        query = (
            nested.stream_changes(spark, path).writeStream.format("parquet").option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return sorted(r.change_id for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert stream() == list(range(1, 21))
    nested.export_changes(changes_df.where("change_id > 20"), files_df, path, ids_per_file=10).collect()
    assert stream() == list(range(1, 31))
    whole = nested.read_changes(spark, path)
    assert sorted(tuple(r)[:4] for r in whole.collect()) == changes
    got = nested.files_of(whole).select(*schema.FILE_REVISIONS.names)
    assert sorted(map(tuple, got.collect())) == files
    some = whole.where("change_id > 9 and change_id <= 12 and username is not null and change_id <> 11")
    assert {r.change_id for r in some.collect()} == {10}
    reader = nested.ChangeReader(path)
    kept = list(reader.pushFilters([nested.GreaterThan(("change_id",), 9), nested.LessThanOrEqual(("change_id",), 12), nested.EqualTo(("username",), "u1")]))
    assert len(kept) == 1 and [(p.low, p.high) for p in reader.partitions()] == [(10, 12)] * 2
    assert whole.where("change_id > 100").count() == 0


def test_wide_ids_sum_up_in_order(spark):
    import random

    rng = random.Random(3)
    ids = sorted({rng.randint(-(1 << 62), 1 << 62) for _ in range(200)} | set(range(-40, 40)) | {(1 << 63) - 1, -(1 << 63)})
    rows = [(i, rng.randint(-5, 9)) for i in ids]
    got = prefix_sum(spark.createDataFrame(rows, "id long, n long").repartition(3), "id", F.col("n"), "upto").collect()
    total, want = 0, []
    for i, n in rows:
        total += n
        want.append((i, n, total))
    assert sorted(map(tuple, got)) == want
