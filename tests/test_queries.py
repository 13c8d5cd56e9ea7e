"""Every registered query against its SQL, and against counts known beforehand."""

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as entry
from changeflow.queries import ORACLE, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(row[i]) for i in order) for row in rows)


def test_entry_without_the_training_data_operators(monkeypatch):
    monkeypatch.setattr(entry, "find_spec", lambda name: None)
    assert set(entry.queries()) == set(QUERIES) and set(entry.oracle_sql()) == set(ORACLE)


def test_entry_without_a_library_of_the_training_data_operators(monkeypatch):
    import sys

    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("changeflow.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "xxhash", None)
    assert set(entry.queries()) == set(QUERIES) and set(entry.oracle_sql()) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    checked = duck.execute(ORACLE[name])
    columns = [d[0] for d in checked.description]
    assert sorted(df.columns) == sorted(columns)
    assert _rows(df.columns, df.collect()) == _rows(columns, checked.fetchall())


def test_flagship_counts(spark):
    counts = {r.change_action: (r.allowed, r.denied) for r in entry.entry(spark).collect()}
    total = {k: sum(v) for k, v in counts.items()}
    assert total["Delete"] == 152
    assert total["Add"] + total["Add Copy"] == 142 + 153 + 14
    assert total["Edit"] + total["Replace Copy"] == 166 + 151


def test_replay_with_few_shared_contents_matches_known_counts(spark):
    """The known counts take four contents in all: revisions match when ``k % 4`` does."""
    from pyspark.sql import functions as F

    from changeflow.operators import lineage, nodes, replay
    from changeflow.queries.common import OPTIONS, Log

    log = Log(spark, SMALL)
    prints = log.revised.select(
        "depot_path", "rev", F.lit(1).alias("n_bytes"), (F.col("k") % 4).cast("string").alias("digest")
    )
    copies = lineage.resolve_copies(log.wanted, log.files, log.integrations, prints, log.revisions, OPTIONS)
    records = nodes.change_nodes(log.wanted, copies, OPTIONS).where("node_kind = 'file'")
    got = replay.replay(records).groupBy("change_action", "allowed").count().collect()
    assert {(r.change_action, r.allowed): r["count"] for r in got} == {
        ("Add", True): 127, ("Add", False): 155, ("Add Copy", True): 9, ("Add Copy", False): 18,
        ("Delete", True): 84, ("Delete", False): 68, ("Edit", True): 169, ("Edit", False): 124,
        ("Replace Copy", True): 15, ("Replace Copy", False): 9,
    }
    status = replay.final_status(records)
    assert status.where("status = 1").count() == 52
