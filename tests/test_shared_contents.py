"""Contents that revisions share, and contents hashed in one pass."""

from dataclasses import replace

from pyspark.sql import functions as F
from test_jobs import HEADER, OPTIONS, R1, R2, R3, _dumps, _log

from changeflow import schema
from changeflow.operators import lineage, nodes, publish
from changeflow.plans import pipeline
from changeflow.sources.tables import SharedContents

KEYS = ["depot_path", "rev"]


def _shared(spark, prefix=False):
    refs = [
        ("//d/main/a.txt", 1, False, 7), ("//d/rel/a.txt", 1, False, 7), ("//d/main/a.txt", 2, False, 8),
        ("//d/main/gone.txt", 1, True, 7), ("//d/main/null.txt", 1, False, 9),
    ]
    blobs = [(7, b"A\n"), (8, b"B\x00\xff"), (9, None), (10, b"not named")]
    named = spark.createDataFrame(refs, "depot_path string, rev int, missing boolean, blob_id long")
    if prefix:
        named = named.withColumn("prefix", F.when(F.col("depot_path").contains("main"), F.lit(b"line\n")))
    return SharedContents(named, spark.createDataFrame(blobs, "blob_id long, content binary"))


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_shared_contents_equal_the_same_as_a_table(spark):
    asked = [("//d/main/a.txt", 1), ("//d/rel/a.txt", 1), ("//d/main/gone.txt", 1), ("//d/main/null.txt", 1), ("//d/none", 3)]
    asked = spark.createDataFrame(asked, "depot_path string, rev int")
    for prefix in (False, True):
        shared = _shared(spark, prefix)
        table = shared.table()
        assert table.schema.names == schema.CONTENTS.names and table.count() == 5
        assert _rows(lineage.fingerprints(shared)) == _rows(lineage.fingerprints(table))
        got = _rows(lineage.attach_content(asked, shared).select(*KEYS, "content"))
        assert got == _rows(lineage.attach_content(asked, table).select(*KEYS, "content"))
        bytes_of = {r[0]: bytes(r[2]) for r in got}
        assert bytes_of["//d/main/a.txt"] == (b"line\nA\n" if prefix else b"A\n")
        assert bytes_of["//d/none"] == b"Import Error: Failed to get file contents: //d/none#3"


def test_placeholders_read_no_contents(spark):
    rows = spark.createDataFrame([(1, 1), (2, 2)], "change_id int, part int").withColumn("content_form", F.lit("placeholder"))
    forms = nodes.as_nodes(rows).union(nodes.as_nodes(rows.withColumn("content_form", F.lit("raw"))))
    read = F.raise_error(F.lit("content was read")).cast("binary")
    contents = spark.createDataFrame([("a", 1, False)], "depot_path string, rev int, missing boolean").withColumn("content", read)
    got = publish.with_content(forms.where("content_form = 'placeholder'"), contents, OPTIONS).collect()
    assert {bytes(r.content) for r in got} == {b"Placeholder for file purged by Perforce."} and len(got) == 2


def test_a_job_over_shared_contents(spark, tmp_path):
    log = replace(_log(spark), contents=_shared(spark))
    options = replace(OPTIONS, cleanup=False)
    pipeline.run(log, options, str(tmp_path / "s"), "r", str(tmp_path / "out"))
    assert _dumps(spark, str(tmp_path / "out"))[0] == HEADER + R1 + R2 + R3
    by_change = F.when(F.col("depot_path").contains("rel") | (F.col("rev") == 2), 2).otherwise(1)
    dated = replace(log.contents, refs=log.contents.refs.withColumn("change_id", by_change))
    for last in (1, 3):
        step = replace(options, to_change=last)
        pipeline.run_incremental(replace(log, contents=dated), step, str(tmp_path / "t"), f"r{last}", str(tmp_path / f"out{last}"))
    assert _dumps(spark, str(tmp_path / "out1"))[0] == HEADER + R1
    assert _dumps(spark, str(tmp_path / "out3"))[0] == HEADER + R2 + R3


def test_contents_without_change_ids_are_hashed_in_one_pass(spark, tmp_path):
    root, log = str(tmp_path / "s"), _log(spark)
    steps = replace(OPTIONS, cleanup=False, changes_per_step=1)
    pipeline.build(log, replace(steps, to_change=1), root, "r")
    marks = spark.read.parquet(f"{root}/r/hashed").collect()
    assert [(m.low, m.high) for m in marks] == [(0, 1)]
    built = pipeline.build(log, replace(steps, restore=True), root, "r")
    marks = spark.read.parquet(f"{root}/r/hashed").collect()
    # Two more steps, both made by one pass over the contents.
    assert sorted((m.low, m.high) for m in marks) == [(0, 1), (1, 2), (2, 3)]
    assert len({m.batch for m in marks}) == 2
    prints = {(r.depot_path, r.rev) for r in spark.read.schema(schema.FINGERPRINTS).parquet(f"{root}/r/prints").collect()}
    assert prints == {("//d/main/a.txt", 1), ("//d/rel/a.txt", 1), ("//d/main/a.txt", 2)}
    assert {r.change_id for r in built.node_records.collect()} == {1, 2, 3}


def test_touching_ranges_are_joined():
    assert pipeline.joined([(4, 6), (0, 2), (2, 4), (8, 9), (5, 6)]) == [(0, 6), (8, 9)]
    assert pipeline.joined([]) == []


def test_digests_of_splits_are_those_of_their_files(spark, tmp_path):
    import hashlib

    from changeflow.sinks.dump import split_digests, write_dump

    rows = [(s, g, 10 * g + i, 0, f"{s}.{g}.{i}|".encode()) for s in (1, 2) for g in range(12) for i in range(3)]
    write_dump(spark.createDataFrame(rows, schema.DUMP_RECORDS), str(tmp_path / "dump"))
    want = {}
    for split in (1, 2):
        whole = b"".join(r[4] for r in rows if r[0] == split)
        want[split] = (36, len(whole), hashlib.md5(whole).hexdigest())
    digests = split_digests(spark, str(tmp_path / "dump"))
    assert {r.split_id: tuple(r)[1:] for r in digests.collect()} == want
    # No bytes are shuffled.
    assert "content" not in digests._jdf.queryExecution().toString()
