import json
import os
from dataclasses import replace
from datetime import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from changeflow import schema
from changeflow.operators.publish import assign_splits
from changeflow.options import Branch, Hooks, MigrationOptions
from changeflow.plans import pipeline
from changeflow.sinks.dump import DumpWriter, read_manifest, read_segments, write_dump
from changeflow.sources import state as state_tables
from changeflow.sources.state import TABLES, load_state
from changeflow.sources.parts import discover_parts
from changeflow.sources.tables import ChangeLog, read_change_log

OPTIONS = MigrationOptions(
    branches=(Branch("//d/main/", "trunk/"), Branch("//d/rel/", "rel/")),
    cleanup_time="2024-02-01 00:00:00",
)
CHANGES = [
    (1, "ann", datetime(2024, 1, 1), "first"),
    (2, "bö", datetime(2024, 1, 2), "second"),
    (3, "ann", datetime(2024, 1, 3), "third"),
]
FILES = [
    (1, 1, "//d/main/a.txt", 1, "ADD", "text"),
    (2, 1, "//d/rel/a.txt", 1, "BRANCH", "text"),
    (2, 2, "//d/main/a.txt", 2, "EDIT", "x"),
    (3, 1, "//d/main/a.txt", 3, "DELETE", "text"),
]
CONTENT = [
    ("//d/main/a.txt", 1, b"A\n"), ("//d/rel/a.txt", 1, b"A\n"), ("//d/main/a.txt", 2, b"B\x00\xff"),
]
LINKS = [("//d/rel/a.txt", 1, 1, "branch from", "//d/main/a.txt", 1)]

R1 = b"""Revision-number: 1
Prop-content-length: 102
Content-length: 102

K 10
svn:author
V 3
ann
K 8
svn:date
V 27
2024-01-01T00:00:00.000000Z
K 7
svn:log
V 5
first
PROPS-END

Node-path: trunk/
Node-kind: dir
Node-action: add
Prop-content-length: 10
Content-length: 10

PROPS-END

Node-path: trunk/a.txt
Node-kind: file
Node-action: add
Text-content-length: 2
Text-content-md5: bf072e9119077b4e76437a93986787ef
Prop-content-length: 10
Content-length: 12

PROPS-END
A


"""
R2 = """Revision-number: 2
Prop-content-length: 103
Content-length: 103

K 10
svn:author
V 3
bö
K 8
svn:date
V 27
2024-01-02T00:00:00.000000Z
K 7
svn:log
V 6
second
PROPS-END

Node-path: rel/
Node-kind: dir
Node-action: add
Prop-content-length: 10
Content-length: 10

PROPS-END

Node-path: rel/a.txt
Node-kind: file
Node-action: add
Node-copyfrom-rev: 1
Node-copyfrom-path: trunk/a.txt

Node-path: trunk/a.txt
Node-kind: file
Node-action: change
Text-content-length: 3
Text-content-md5: b707a708dcf64743234a4f71bc456233
Prop-content-length: 37
Content-length: 40

K 14
svn:executable
V 2
on
PROPS-END
""".encode() + b"B\x00\xff\n\n"
R3 = b"""Revision-number: 3
Prop-content-length: 102
Content-length: 102

K 10
svn:author
V 3
ann
K 8
svn:date
V 27
2024-01-03T00:00:00.000000Z
K 7
svn:log
V 5
third
PROPS-END

Node-path: trunk/a.txt
Node-action: delete

"""
R4 = b"""Revision-number: 4
Prop-content-length: 139
Content-length: 139

K 10
svn:author
V 10
changeflow
K 8
svn:date
V 27
2024-02-01T00:00:00.000000Z
K 7
svn:log
V 33
Deleting Empty Parent Directories
PROPS-END

Node-path: trunk/
Node-action: delete

"""
HEADER = b"SVN-fs-dump-format-version: 1\n\n"


def _log(spark, files=FILES, changes=CHANGES, content=CONTENT, links=LINKS):
    return ChangeLog(
        spark.createDataFrame(changes, schema.CHANGELISTS),
        spark.createDataFrame(files, schema.FILE_REVISIONS),
        spark.createDataFrame([(p, r, bytearray(c), False) for p, r, c in content], schema.CONTENTS),
        spark.createDataFrame(links, schema.INTEGRATIONS),
    )


def _dumps(spark, out):
    files = {}
    for row in sorted(read_segments(spark, out).collect(), key=lambda r: (r.split_id, r.segment)):
        assert row.bytes == len(row.content)
        files[row.split_id] = files.get(row.split_id, b"") + bytes(row.content)
    return files


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("state"))
    return root, pipeline.build(_log(spark), OPTIONS, root, "r1")


@pytest.mark.parametrize("split_by,per_segment,expected", [
    (0, 100_000, {0: HEADER + R1 + R2 + R3 + R4}),
    (0, 1, {0: HEADER + R1 + R2 + R3 + R4}),
    (1, 100_000, {i: HEADER + r for i, r in enumerate((R1, R2, R3, R4), 1)}),
    (2, 3, {1: HEADER + R1 + R2, 2: HEADER + R3 + R4}),
])
def test_golden_dump(spark, tmp_path, built, split_by, per_segment, expected):
    root, build = built
    assert build.last_revision == 4 and build.cleanup_change == 4
    options = replace(OPTIONS, split_by=split_by, records_per_segment=per_segment)
    pipeline.publish(build, _log(spark), options, root, str(tmp_path / "out"))
    assert _dumps(spark, str(tmp_path / "out")) == expected


def test_dump_rerun_replaces_the_earlier_one(spark, tmp_path):
    out = str(tmp_path / "out")
    pipeline.run(_log(spark), replace(OPTIONS, split_by=1), str(tmp_path / "s"), "r1", out)
    pipeline.run(_log(spark), OPTIONS, str(tmp_path / "s"), "r2", out)
    assert list(_dumps(spark, out)) == [0]
    names = {r.file for r in read_manifest(spark, out).collect()}
    assert {n for n in os.listdir(out) if n.startswith("dump")} == names


def test_lengths_in_the_dump_add_up(spark, tmp_path):
    out = str(tmp_path / "out")
    pipeline.run(_log(spark), OPTIONS, str(tmp_path / "s"), "r1", out)
    data, seen = _dumps(spark, out)[0], 0
    while (at := data.find(b"Content-length: ")) >= 0:
        data = data[at + 16:]
        length, data = data.split(b"\n\n", 1)
        body = data[: int(length)]
        assert b"PROPS-END\n" in body
        data, seen = data[int(length):], seen + 1
        assert data.startswith(b"\n")
    assert seen == 8


MORE = [
    (1, 1, "//d/main/x/l", 1, "ADD", "symlink"), (1, 2, "//d/main/x/p", 1, "PURGE", "symlink"),
    (1, 3, "//d/main/x/q", 1, "ARCHIVE", "text"), (2, 1, "//d/main/x/l", 2, "EDIT", "symlink"),
    (2, 2, "//other/z", 1, "ADD", "text"), (3, 1, "//other/z", 2, "EDIT", "text"),
]


def test_symlinks_purges_rejects_and_skipped_changes(spark, tmp_path):
    content = [("//d/main/x/l", 1, b"to/a"), ("//d/main/x/l", 2, b"to/b")]
    log = _log(spark, files=MORE, content=content, links=[])
    options = replace(OPTIONS, skip_empty_cleanup=True)
    built = pipeline.run(log, options, str(tmp_path / "s"), "r1", str(tmp_path / "out"))
    data = _dumps(spark, str(tmp_path / "out"))[0]
    assert b"K 11\nsvn:special\nV 1\n*\nPROPS-END\nlink to/a\n\n" in data and b"link to/b" in data
    assert b"PROPS-END\nPlaceholder for file purged by Perforce.\n\n" in data
    assert b"Revision-number: 3" not in data and built.last_revision == 2
    rejected = built.rejects.collect()
    assert [(r.action, json.loads(r.context)["depot_path"]) for r in rejected] == [("ARCHIVE", "//d/main/x/q")]
    assert {r.change_id: r.revision for r in built.revisions.collect()} == {1: 1, 2: 2, 3: 0}
    with pytest.raises(ValueError):
        pipeline.build(log, replace(options, strict=True), str(tmp_path / "s"), "r2")


def test_missing_content_and_munging(spark, tmp_path):
    files = [(1, 1, "//d/main/a", 1, "ADD", "text"), (1, 2, "//d/main/b", 1, "ADD", "text"), (1, 3, "//d/main/c", 1, "ADD", "binary")]
    log = _log(spark, files=files, changes=CHANGES[:1], content=[("//d/main/a", 1, b"$Date$ \xff"), ("//d/main/c", 1, b"$Date$")], links=[])
    pipeline.run(log, replace(OPTIONS, munge_keywords=True), str(tmp_path / "s"), "r1", str(tmp_path / "out"))
    data = _dumps(spark, str(tmp_path / "out"))[0]
    assert b"\n$LastChangedDate$ \xff\n\n" in data and b"\n$Date$\n\n" in data
    assert b"get file contents: //d/main/b#1\n\n" in data


def test_increments_count_on_and_see_earlier_state(spark, tmp_path):
    root = str(tmp_path / "s")
    log = _log(spark)
    first = pipeline.run_incremental(log, replace(OPTIONS, to_change=2, cleanup=False), root, "r1")
    assert (first.summary["last_change_id"], first.last_revision) == (2, 2)
    second = pipeline.run_incremental(log, OPTIONS, root, "r2", str(tmp_path / "out"))
    # Only change 3 is new; its delete is legal because the file was live, and empties its directory.
    assert _dumps(spark, str(tmp_path / "out"))[0] == HEADER + R3 + R4
    assert second.last_revision == 4
    state = load_state(spark, root)
    assert (state.run_id, state.last_change_id, state.last_revision) == ("r2", 3, 4)
    assert {r.path: r.status for r in state.path_status.collect()} == {
        "trunk/": 0, "trunk/a.txt": 0, "rel/": 1, "rel/a.txt": 1,
    }
    assert {r.change_id: r.revision for r in state.revision_map.collect()} == {1: 1, 2: 2, 3: 3}
    assert pipeline.run_incremental(log, OPTIONS, root, "r3") is None


def test_copy_source_may_lie_in_an_earlier_run(spark, tmp_path):
    root = str(tmp_path / "s")
    log = _log(spark)
    pipeline.run_incremental(log, replace(OPTIONS, to_change=1, cleanup=False), root, "r1")
    pipeline.run_incremental(log, replace(OPTIONS, cleanup=False), root, "r2", str(tmp_path / "out"))
    assert b"Node-copyfrom-rev: 1\nNode-copyfrom-path: trunk/a.txt" in _dumps(spark, str(tmp_path / "out"))[0]


def test_increment_reads_only_its_own_contents(spark, tmp_path):
    root, out = str(tmp_path / "s"), str(tmp_path / "out")
    log = _log(spark)
    change = F.when(F.col("depot_path").contains("rel") | (F.col("rev") == 2), 2).otherwise(1)
    log = replace(log, contents=log.contents.withColumn("change_id", change))
    pipeline.run_incremental(log, replace(OPTIONS, to_change=1, cleanup=False), root, "r1")
    # The first run's bytes are gone by now; its fingerprints are in the state.
    later = replace(log, contents=log.contents.where("change_id > 1"))
    pipeline.run_incremental(later, replace(OPTIONS, cleanup=False), root, "r2", out)
    assert _dumps(spark, out)[0] == HEADER + R2 + R3
    assert load_state(spark, root).fingerprints.count() == 3


def test_restore_reuses_finished_changes(spark, tmp_path):
    root = str(tmp_path / "s")
    log = _log(spark)
    pipeline.build(log, replace(OPTIONS, to_change=2), root, "r1")
    before = spark.read.parquet(f"{root}/r1/completed").collect()
    built = pipeline.run(log, replace(OPTIONS, restore=True), root, "r1", str(tmp_path / "out"))
    assert _dumps(spark, str(tmp_path / "out"))[0] == HEADER + R1 + R2 + R3 + R4
    after = spark.read.parquet(f"{root}/r1/completed").collect()
    assert len(before) == 2 and len(after) == 3 and {r.change_id for r in after} == {1, 2, 3}
    # Other settings void the finished work.
    records = built.node_records.where("part > 0").count()
    again = pipeline.build(log, replace(OPTIONS, restore=True, semantics="corrected"), root, "r1")
    assert again.node_records.where("part > 0").count() == records


def test_corrected_usage_counts_kept_records_only(spark, tmp_path):
    files = [
        (1, 1, "//d/main/a", 1, "ADD", "text"), (2, 1, "//d/main/a", 2, "ADD", "text"),
        (3, 1, "//d/main/a", 3, "DELETE", "text"),
    ]
    log = _log(spark, files=files, content=[], links=[])
    for semantics, usage in (("faithful", 1), ("corrected", 0)):
        built = pipeline.build(log, replace(OPTIONS, semantics=semantics), str(tmp_path / semantics), "r1")
        assert [(r.path, r.usage) for r in built.usage.collect()] == [("trunk/", usage)]


def test_hooks_run_at_each_point(spark, tmp_path):
    hooks = Hooks(
        on_changelist=(lambda d: d.withColumn("username", F.upper("username")),),
        on_file=(lambda d: d.where("change_id <> 3"),),
        after_build=(lambda d: d.where("path <> 'rel/'"),),
        on_publish=(lambda d: d.where("change_id <> 2"),),
    )
    options = replace(OPTIONS, hooks=hooks, cleanup=False)
    pipeline.run(_log(spark), options, str(tmp_path / "s"), "r1", str(tmp_path / "out"))
    data = _dumps(spark, str(tmp_path / "out"))[0]
    assert b"ANN" in data and b"Revision-number: 2" not in data and b"delete" not in data
    assert spark.read.parquet(str(tmp_path / "s/r1/node_records/*")).where("path = 'rel/'").count() == 0


def test_splits_are_runs_of_changes(spark):
    df = spark.createDataFrame([(i * 10,) for i in range(1, 8)], "change_id int")
    got = {r.change_id: r.split_id for r in assign_splits(df, 3).collect()}
    assert got == {10: 1, 20: 1, 30: 1, 40: 2, 50: 2, 60: 2, 70: 3}


def test_giant_change_is_cut_into_segments(spark, tmp_path, tiny_segments):
    files = [(1, i, f"//d/main/f{i:03d}", 1, "ADD", "binary") for i in range(1, 61)]
    content = [(p, 1, f"text {p}".encode()) for _, _, p, *_ in files]
    log = _log(spark, files=files, changes=CHANGES[:1], content=content, links=[])
    out = str(tmp_path / "out")
    pipeline.run(log, replace(OPTIONS, records_per_segment=10, cleanup=False), str(tmp_path / "s"), "r1", out)
    rows = read_manifest(spark, out).collect()
    assert len(rows) >= 6 and max(r.records for r in rows) <= 13
    data = _dumps(spark, out)[0]
    assert [data.index(f"text //d/main/f{i:03d}".encode()) for i in range(1, 61)] == sorted(
        data.index(f"text //d/main/f{i:03d}".encode()) for i in range(1, 61)
    )


def test_tables_read_back_from_disk(spark, tmp_path):
    log = _log(spark)
    for name in ("changelists", "file_revisions", "contents", "integrations"):
        getattr(log, name).write.parquet(str(tmp_path / name))
    again = read_change_log(spark, str(tmp_path))
    assert again.contents.count() == 3 and again.file_revisions.schema == schema.FILE_REVISIONS


def test_part_files_with_number_names_only(spark, tmp_path):
    for name in ("10/0", "10/2", "9/1", "10/ok", "x/1", "meta-info"):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text("data")
    got = discover_parts(spark, str(tmp_path)).orderBy("change_id", "part").collect()
    assert [(r.change_id, r.part, r.length) for r in got] == [(9, 1, 4), (10, 0, 4), (10, 2, 4)]


def test_segments_are_bounded_in_bytes(spark, tmp_path, tiny_segments):
    files = [(1 + i % 3, 1 + i // 3, f"//d/main/f{i:03d}", 1, "ADD", "binary") for i in range(90)]
    content = [(p, 1, b"x" * (40_000 if i in (10, 50) else 100 + 7 * i)) for i, (_, _, p, *_) in enumerate(files)]
    log = _log(spark, files=files, content=content, links=[])
    out, whole = str(tmp_path / "out"), str(tmp_path / "whole")
    options = replace(OPTIONS, cleanup=False)
    pipeline.run(log, replace(options, bytes_per_segment=8_000), str(tmp_path / "s"), "r1", out)
    pipeline.run(log, options, str(tmp_path / "t"), "r1", whole)
    rows = read_manifest(spark, out).collect()
    long = [r for r in rows if r.bytes > 8_000]
    assert len(rows) > 8 and len(long) == 2 and all(r.records == 1 for r in long)
    assert _dumps(spark, out) == _dumps(spark, whole) and len(read_manifest(spark, whole).collect()) == 1


def _batch(rows):
    names = ["split_id", "segment", "change_id", "part", "record"]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)


def test_files_of_lost_attempts_are_swept(tmp_path):
    out = str(tmp_path / "out")
    rows = [(0, 0, 1, 0, b"a"), (0, 1, 1, 1, b"b"), (0, 2, 1, 2, b"c")]

    def fails():
        yield _batch(rows[:2])
        raise RuntimeError("lost")

    first = DumpWriter(out, "dump", True)
    with pytest.raises(RuntimeError):
        first.write(fails())
    assert os.listdir(out) == []
    first.write(iter([_batch(rows)]))  # an executor that dies after writing never reports
    message = first.write(iter([_batch(rows)]))
    first.commit([message, None])
    assert len(os.listdir(out)) == 4 and {e["file"] for e in message.entries} < set(os.listdir(out))
    # A second job under the same name that is stopped leaves the first one whole.
    second = DumpWriter(out, "dump", True)
    second.write(iter([_batch(rows)]))
    second.abort([None])
    assert len(os.listdir(out)) == 4
    # Appending keeps earlier files, replacing does not, and other names stay in any case.
    more = DumpWriter(out, "dump", False)
    more.commit([more.write(iter([_batch([(1, 7, 9, 0, b"z")])]))])
    other = DumpWriter(out, "dump-b", True)
    other.write(iter([_batch(rows[:1])]))
    assert len(os.listdir(out)) == 6
    last = DumpWriter(out, "dump", True)
    last.commit([last.write(iter([_batch(rows[:1])]))])
    assert len(os.listdir(out)) == 3


def test_a_failed_dump_leaves_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = spark.range(2_000).select(
        F.lit(0).alias("split_id"), (F.col("id") / 10).cast("long").alias("segment"), F.lit(1).alias("change_id"),
        F.col("id").cast("int").alias("part"), F.col("id").cast("string").cast("binary").alias("record"),
    )
    write_dump(rows.where("part < 100"), out)
    before = sorted(os.listdir(out))
    stopped = F.when(F.col("part") < 1_990, F.col("record")).otherwise(F.raise_error(F.lit("stopped")).cast("binary"))
    with pytest.raises(Exception, match="stopped"):
        write_dump(rows.withColumn("record", stopped), out)
    assert sorted(os.listdir(out)) == before


def test_runs_write_only_what_they_touch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(state_tables, "FOLD", 0)
    root = str(tmp_path / "s")
    log = _log(spark, files=[*FILES, *((1, 10 + i, f"//d/main/deep/f{i}", 1, "ADD", "text") for i in range(20))])
    options = replace(OPTIONS, cleanup=False)
    pipeline.run_incremental(log, replace(options, to_change=2), root, "r1")
    second = pipeline.run_incremental(log, options, root, "r2")
    state = load_state(spark, root)
    own = {n: spark.read.schema(TABLES[n]).parquet(f"{root}/{x[-1].folder}") for n, x in state.layers.items()}
    assert [tuple(r) for r in own["revision_map"].collect()] == [(3, 3)]
    assert [tuple(r) for r in own["path_status"].collect()] == [("trunk/a.txt", 0)]
    assert {tuple(r) for r in own["dir_usage"].collect()} == {("trunk/", 20)}
    assert {n: len(x) for n, x in state.layers.items()} == {n: 1 if n in ("fingerprints", "empty_dirs") else 2 for n in TABLES}
    assert {r.path: r.usage for r in second.usage.collect()} == {"trunk/": 20, "rel/": 1, "trunk/deep/": 20}


def test_restore_reads_no_finished_content(spark, tmp_path):
    root = str(tmp_path / "s")
    log = _log(spark)
    change = F.when(F.col("depot_path").contains("rel") | (F.col("rev") == 2), 2).otherwise(1)
    contents = log.contents.withColumn("change_id", change)
    contents.write.parquet(str(tmp_path / "contents"))
    contents = spark.read.parquet(str(tmp_path / "contents"))
    stops = replace(OPTIONS, cleanup=False, changes_per_step=1)

    def fail(records):
        seen.append(1)
        return records.where(F.raise_error(F.lit("stopped")).isNull()) if len(seen) == 2 else records

    seen = []
    with pytest.raises(Exception, match="stopped"):
        hooks = Hooks(after_build=(fail,))
        pipeline.build(replace(log, contents=contents), replace(stops, hooks=hooks), root, "r1")
    # All contents were hashed before the build stopped, so none is read again; nor are finished records made again.
    closed = contents.withColumn("content", F.raise_error(F.lit("content was read")).cast("binary"))
    restored = replace(stops, restore=True)
    built = pipeline.build(replace(log, contents=closed), restored, root, "r1")
    pipeline.publish(built, replace(log, contents=contents), restored, root, str(tmp_path / "out"))
    assert _dumps(spark, str(tmp_path / "out"))[0] == HEADER + R1 + R2 + R3
    # A step whose contents were not hashed is: here the third change, which has none, and a new range after it.
    assert len(spark.read.parquet(f"{root}/r1/hashed").collect()) == 3


def test_ranges_left_to_do():
    assert pipeline.without([(0, 10)], []) == [(0, 10)]
    assert pipeline.without([(0, 10)], [(2, 4), (6, 12)]) == [(0, 2), (4, 6)]
    assert pipeline.without([(0, 5), (5, 9)], [(0, 9)]) == []
    assert pipeline.without([(0, 5), (5, 9)], [(4, 6)]) == [(0, 4), (6, 9)]


def test_empty_directories_follow_zero_crossings(spark, tmp_path):
    root = str(tmp_path / "s")
    files = [
        (1, 1, "//d/main/a/x", 1, "ADD", "text"), (1, 2, "//d/main/b/y", 1, "ADD", "text"),
        (2, 1, "//d/main/a/x", 2, "DELETE", "text"), (3, 1, "//d/main/a/z", 1, "ADD", "text"),
        (3, 2, "//d/main/b/y", 2, "DELETE", "text"),
    ]
    log = _log(spark, files=files, content=[], links=[])
    want = {1: set(), 2: {"trunk/a/"}, 3: {"trunk/b/"}}
    for last, empty in want.items():
        built = pipeline.run_incremental(log, replace(OPTIONS, to_change=last, cleanup=False), root, f"r{last}")
        assert {r.path for r in built.usage.where("usage = 0").collect()} == empty
        assert {r.path for r in built.state.empty_dirs.where("empty = 1").collect()} == empty
    own = spark.read.parquet(f"{root}/{load_state(spark, root).layers['empty_dirs'][-1].folder}")
    assert {tuple(r) for r in own.collect()} >= {("trunk/a/", 0), ("trunk/b/", 1)}
