from changeflow import schema
from changeflow.operators import lineage
from changeflow.options import Branch, MigrationOptions
from changeflow.sources.tables import explode_files, explode_integrations

INTEGRATIONS = [
    # target, rev, seq, how, source, source rev
    ("a", 1, 1, "branch from", None, 5), ("a", 1, 2, "branch from", "s2", 6),
    ("b", 1, 1, "branch from", "s1", 0), ("b", 1, 2, "copy from", "s2", 7),
    ("c", 1, 1, "merge into", "s1", 3),
    ("d", 1, 1, "merge into", "s0", 9), ("d", 1, 2, "copy from", "s1", 4),
    ("e", 1, 1, "copy from", "s1", 0),
    ("g", 1, 3, "copy from", "s3", 2), ("g", 1, 2, "copy from", "s2", 8),
]


def _picks(spark, semantics):
    df = spark.createDataFrame(INTEGRATIONS, schema.INTEGRATIONS)
    return {r.to_path: (r.from_path, r.from_rev) for r in lineage.pick_sources(df, semantics).collect()}


def test_faithful_pick_may_mix_two_records(spark):
    assert _picks(spark, "faithful") == {"a": ("s2", 5), "b": ("s1", 7), "d": ("s1", 4), "g": ("s2", 8)}


def test_corrected_pick_uses_one_record(spark):
    assert _picks(spark, "corrected") == {"a": ("s2", 6), "b": ("s2", 7), "d": ("s1", 4), "g": ("s2", 8)}


def test_history_needs_one_entry_of_its_own_path(spark):
    row = "array<struct<how_from string, from_path string, end_from_rev int>>"
    one = [("copy from", "s", 1), ("merge into", "t", 2)]
    df = spark.createDataFrame(
        [("a", 1, "a", 1, one), ("b", 1, "b", 1, one), ("b", 1, "b", 2, one), ("c", 1, None, 1, one), ("d", 1, "x", 1, one)],
        f"asked_path string, asked_rev int, entry_path string, entry_rev int, integrations {row}",
    )
    got = lineage.single_history(df).collect()
    assert [(r.to_path, r.seq, r.how_from) for r in got] == [("a", 1, "copy from"), ("a", 2, "merge into")]


def test_missing_content_is_explained_per_revision(spark):
    rows = [("p", 1, bytearray(b"x"), False), ("p", 2, None, True), ("q", 2, None, True), ("r", 1, bytearray(b"x"), None)]
    df = spark.createDataFrame(rows, schema.CONTENTS)
    got = {(r.depot_path, r.rev): bytes(r.content) for r in lineage.load_content(df).collect()}
    assert got["p", 1] == got["r", 1] == b"x"
    assert got["p", 2].endswith(b"p#2") and got["p", 2] != got["q", 2]


OPTIONS = MigrationOptions(branches=(Branch("//d/main/", "trunk/"), Branch("//d/rel/", "rel/")))
FILES = [
    (1, 1, "//d/main/a", 1, "ADD", "text"),
    (1, 2, "//d/main/b", 1, "ADD", "text"),
    (2, 1, "//x/a", 1, "ADD", "text"),
    (3, 1, "//d/rel/a", 1, "BRANCH", "text"),     # same bytes: copy
    (3, 2, "//d/rel/b", 1, "BRANCH", "text"),     # other bytes: no copy
    (3, 3, "//d/rel/c", 1, "BRANCH", "text"),     # source outside the branches
    (3, 4, "//d/rel/d", 1, "BRANCH", "text"),     # source unknown
    (3, 5, "//d/rel/e", 1, "BRANCH", "text"),     # source in its own change
    (4, 1, "//d/rel/a", 2, "INTEGRATE", "text"),  # same bytes: copy
    (4, 2, "//d/rel/f", 1, "EDIT", "text"),       # not a candidate
]
LINKS = [
    ("//d/rel/a", 1, "//d/main/a", 1), ("//d/rel/b", 1, "//d/main/b", 1), ("//d/rel/c", 1, "//x/a", 1),
    ("//d/rel/d", 1, "//d/main/z", 1), ("//d/rel/e", 1, "//d/rel/a", 1), ("//d/rel/a", 2, "//d/main/a", 1),
    ("//d/rel/f", 1, "//d/main/a", 1),
]


def _copies(spark, semantics, hot=False):
    from dataclasses import replace

    from changeflow.operators.changes import mark_kept, wanted_files
    from changeflow.operators.numbering import serial_numbers

    options = replace(OPTIONS, semantics=semantics)
    files = spark.createDataFrame(FILES, schema.FILE_REVISIONS)
    content = [(p, r, bytearray(b"other" if p == "//d/rel/b" else b"same"), False) for _, _, p, r, _, _ in FILES]
    links = [(t, tr, 1, "branch from", s, sr) for t, tr, s, sr in LINKS]
    changes = files.select("change_id").distinct()
    wanted = wanted_files(files, options)
    revisions = serial_numbers(mark_kept(changes, wanted))
    got = lineage.resolve_copies(
        wanted, files, spark.createDataFrame(links, schema.INTEGRATIONS),
        lineage.fingerprints(spark.createDataFrame(content, schema.CONTENTS)), revisions, options,
    )
    return {(r.change_id, r.file_ord): (r.copy_from_path, r.copy_from_rev) for r in got.collect()}


def test_copies(spark):
    copies = {(3, 1): ("trunk/a", 1), (3, 5): ("rel/a", 2), (4, 1): ("trunk/a", 1)}
    assert _copies(spark, "faithful") == copies
    del copies[3, 5]
    assert _copies(spark, "corrected") == copies


def test_copies_with_every_key_hot(spark, tiny_segments):
    assert _copies(spark, "faithful") == {(3, 1): ("trunk/a", 1), (3, 5): ("rel/a", 2), (4, 1): ("trunk/a", 1)}


def test_nested_sources_explode_in_order(spark):
    changes = spark.createDataFrame(
        [(1, [("p", 3), ("q", 1)]), (2, [])], "change_id int, files array<struct<depot_path string, rev int>>"
    )
    assert [tuple(r) for r in explode_files(changes).collect()] == [(1, 1, "p", 3), (1, 2, "q", 1)]
    revisions = spark.createDataFrame(
        [("p", 3, [("copy from", "s", 1)])],
        "depot_path string, rev int, integrations array<struct<how_from string, from_path string, end_from_rev int>>",
    )
    assert [tuple(r) for r in explode_integrations(revisions).collect()] == [("p", 3, 1, "copy from", "s", 1)]
