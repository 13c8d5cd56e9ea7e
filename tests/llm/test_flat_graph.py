"""Near-duplicate embeddings against brute force, and recall of the search."""

import math

import numpy as np
import pytest

from changeflow.llm import flat_graph

SCHEMA = "vec_id long, embedding array<float>, label int, node long, weight string"


def brute(rows, least=0.98):
    def usable(v, label):
        good = label is not None and v and all(x is not None and math.isfinite(x) for x in v)
        return good and any(v)

    use = [i for i, (_, v, label) in enumerate(rows) if usable(v, label)]
    up, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in use:
        for b in use:
            if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.float32(rows[a][1]).astype(float), np.float32(rows[b][1]).astype(float)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least:
                    links[a] += 1
                    links[b] += 1
                    up[root(b)] = root(a)
    key = lambda d: (d is not None, d or 0)
    least_id = {}
    for i, r in enumerate(rows):
        least_id[root(i)] = min(least_id.get(root(i), key(r[0])), key(r[0]))
    out = []
    for i, r in enumerate(rows):
        k = least_id[root(i)]
        out.append((r[0], links[i], k[1] if k[0] else None, key(r[0]) == k))
    return sorted(out, key=repr)


def corpus():
    rng = np.random.default_rng(4)
    rows = []
    for i in range(220):
        base = rng.normal(size=16)
        rows.append((i, base.tolist(), int(i % 3)))
        for j in range(int(rng.integers(0, 4))):
            rows.append((1000 + 10 * i + j, (base + rng.normal(size=16) * rng.choice([0, 0.05, 0.15])).tolist(), int(i % 3)))
    core = rng.normal(size=16)
    rows += [(5000 + i, (core + rng.normal(size=16) * 0.08).tolist(), 1) for i in range(60)]
    nan, inf = float("nan"), float("inf")
    rows += [(9000, None, 1), (9001, [0.0] * 16, 1), (9002, [nan] + [1.0] * 15, 1), (9003, [inf] + [1.0] * 15, 1)]
    rows += [(9004, [None] + [1.0] * 15, 1), (9005, [], 1), (9006, core.tolist(), None), (9007, [1.0, 2.0], 1)]
    rows += [(9008, [2.0, 4.0], 1), (None, core.tolist(), 1), (3, rows[3][1], rows[3][2]), (9009, [-0.0, 1.0], 2), (9010, [0.0, 1.0], 2)]
    return rows


@pytest.mark.parametrize("block, per_shard", [(1_024, 1_500), (16, 60)])
def test_equals_brute_force(spark, monkeypatch, block, per_shard):
    monkeypatch.setattr(flat_graph, "BLOCK", block)
    monkeypatch.setattr(flat_graph, "PER_SHARD", per_shard)
    rows = corpus()
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    got = sorted(map(tuple, flat_graph.near_duplicates(frame).drop("recall").collect()), key=repr)
    want = brute(rows)
    if per_shard > 1_000:
        assert got == want
    else:  # several shards: no link may be wrong, and few may be missing
        assert [r[0] for r in got] == [r[0] for r in want]
        assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
        assert sum(r[1] for r in got) >= 0.95 * sum(r[1] for r in want)


def test_recall_on_given_vectors_with_near_copies(spark, monkeypatch):
    monkeypatch.setattr(flat_graph, "PER_SHARD", 150)
    rng = np.random.default_rng(9)
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    rows = [(r.vec_id, r.embedding, r.label) for r in given]
    for r in given[:400]:
        for k in range(int(rng.integers(1, 4))):
            near = np.asarray(r.embedding) + rng.normal(size=64) * rng.choice([0.01, 0.02, 0.03])
            rows.append((100_000 + 10 * r.vec_id + k, near.tolist(), r.label))
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    got = {r.vec_id: r for r in flat_graph.near_duplicates(frame).drop("recall").collect()}
    want = {r[0]: r for r in brute(rows)}
    assert all(got[i].n_links <= want[i][1] for i in want)
    assert sum(r.n_links for r in got.values()) >= 0.97 * sum(r[1] for r in want.values()) > 0
    _, nodes = flat_graph.nodes_of(frame, "vec_id", "embedding", "label")
    assert flat_graph.audit(nodes, flat_graph.found_links(nodes, 0.98)) >= 0.9


def test_too_little_recall_is_repaired(spark, monkeypatch):
    rng = np.random.default_rng(6)
    core = rng.normal(size=(40, 32))
    rows = [(100 * k + i, (c + rng.normal(size=32) * 0.02).tolist(), k % 2) for k, c in enumerate(core) for i in range(5)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    found = flat_graph.found_links
    # A search that finds nothing, as if all links lay between shards.
    monkeypatch.setattr(flat_graph, "found_links", lambda nodes, least: found(nodes, least).where("false"))
    got = flat_graph.near_duplicates(frame)
    assert {r.recall for r in got.collect()} == {1.0}
    assert sorted(map(tuple, got.drop("recall").collect()), key=repr) == brute(rows)
    _, nodes = flat_graph.nodes_of(frame, "vec_id", "embedding", "label")
    assert flat_graph.audit(nodes, flat_graph.found_links(nodes, 0.98)) == 0.0


def two_groups(size=60, dims=64):
    rng = np.random.default_rng(1)
    centre, apart = np.linalg.qr(rng.normal(size=(dims, 2)))[0].T
    rows = []
    for k, sign in enumerate((-1, 1)):
        core = centre + sign * 0.06 * apart
        rows += [(1000 * k + i, (core + rng.normal(size=dims) * 0.003).tolist(), 1) for i in range(size)]
    return rows


def test_links_between_tight_groups_larger_than_the_candidate_lists(spark):
    rows = two_groups()
    want = brute(rows)
    assert {r[1] for r in want} == {119} and {r[2] for r in want} == {0}  # every pair links
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    assert sorted(map(tuple, flat_graph.near_duplicates(frame).drop("recall").collect()), key=repr) == want


@pytest.mark.parametrize("least", [0.9, 0.98])
def test_search_finds_every_link_of_a_task(least):
    rng = np.random.default_rng(7)
    rows = [v for _, v, _ in two_groups(70, 16)] + rng.normal(size=(150, 16)).tolist()
    for spread in (0.02, 0.05, 0.1):
        rows += (np.asarray(rng.normal(size=16)) + rng.normal(size=(90, 16)) * spread).tolist()
    x = flat_graph.unit(np.asarray(rows))
    lists, crowded = flat_graph.prune(x, least)
    exact = x @ x.T >= least
    np.fill_diagonal(exact, False)
    assert 0 < crowded.sum() < len(x)
    assert not (exact & ~flat_graph.range_search(x, lists, least, crowded)).any()


def test_no_rows(spark):
    assert flat_graph.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
