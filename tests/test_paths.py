from pyspark.sql import functions as F

from changeflow.functions.paths import (
    ancestors_of, is_wanted, map_paths, map_prefix, parent_of, url_path,
)
from changeflow.options import Branch

PARENTS = {
    "/": [],
    "": [],
    "a": [],
    "a/": [],
    "/a/": ["/"],
    "a//b": ["a/", "a//"],
    " a/b ": ["a/"],
    "//depot/x/y": ["/", "//", "//depot/", "//depot/x/"],
    "\ta/b\n": ["a/"],
    "é/ü/ñ.txt": ["é/", "é/ü/"],
    "a:b/c": ["a:b/"],
    "trunk/x/y/": ["trunk/", "trunk/x/"],
}


def test_ancestors_and_parent(spark):
    df = spark.createDataFrame([(p,) for p in PARENTS], "p string")
    rows = df.select("p", ancestors_of(F.col("p")).alias("a"), parent_of(F.col("p")).alias("up")).collect()
    for row in rows:
        assert row.a == PARENTS[row.p], row.p
        assert row.up == (PARENTS[row.p][-1] if PARENTS[row.p] else None), row.p


def _mapped(spark, paths, branches):
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    rows = df.select("p", map_prefix(F.col("p"), branches).alias("m"), is_wanted(F.col("p"), branches).alias("w"))
    out = {r.p: r.m for r in rows.collect()}
    assert {r.p: r.w for r in rows.collect()} == {p: m is not None for p, m in out.items()}
    return out


def test_longest_prefix_wins_unless_priority_says_otherwise(spark):
    paths = ["//d/main/x/1", "//d/main/2", "//e/3"]
    plain = (Branch("//d/main", "T"), Branch("//d/main/x", "X"))
    assert _mapped(spark, paths, plain) == {"//d/main/x/1": "X/1", "//d/main/2": "T/2", "//e/3": None}
    forced = (Branch("//d/main", "T", 1), Branch("//d/main/x", "X", 2))
    assert _mapped(spark, paths, forced)["//d/main/x/1"] == "T/x/1"


def test_prefixes_have_no_boundary_and_may_map_to_nothing(spark):
    assert _mapped(spark, ["//d/mainline/x"], (Branch("//d/main", ""),)) == {"//d/mainline/x": "line/x"}


def test_no_break_space_becomes_two_characters(spark):
    assert _mapped(spark, ["//d/a\u00a0b"], (Branch("//d/", "t/"),)) == {"//d/a\u00a0b": "t/a\u00c2\u00a0b"}


def test_no_branches_map_nothing(spark):
    assert _mapped(spark, ["//d/a"], ()) == {"//d/a": None}


def test_branch_table_agrees_with_chain(spark):
    branches = tuple(Branch(f"//d/{'x' * (i % 5)}{i}", f"t{i}/", i % 3) for i in range(40))
    paths = [b.depot_prefix + "/f\u00a0" for b in branches] + ["//d/", "//d/1", "//d", "/", ""]
    df = spark.createDataFrame([(p, i) for i, p in enumerate(paths * 2)] + [(None, -1)], "p string, i int")
    rows = [(b.depot_prefix, b.target_prefix, b.priority) for b in branches]
    table = spark.createDataFrame(rows + [(*rows[0][:1], "zz", 9)], "depot_prefix string, target_prefix string, priority int")
    got = map_paths(df, table, "p", "m")
    want = df.select("p", "i", map_prefix(F.col("p"), branches).alias("m"))
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert {r.m for r in map_paths(df, table.limit(0), "p", "m").collect()} == {None}


def test_url_path(spark):
    df = spark.createDataFrame([("https://a.b/c/d?x=1#y",), ("http://a.b/#t",), ("a/b",)], "u string")
    assert [r[0] for r in df.select(url_path(F.col("u"))).collect()] == ["a.b/c/d", "a.b/", "a/b"]
