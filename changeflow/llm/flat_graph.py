"""Near-duplicate embeddings by a robust-pruned flat graph.

1. Equal vectors of a label become one node with a weight.
2. Centroids are fitted to a bounded sample (``SAMPLE`` vectors). Every node joins the shards of its ``OVERLAP`` nearest
   centroids, within its label and length; all nodes are indexed.
3. In each shard every node's nearest ``CANDIDATES`` are pruned: a candidate goes when one kept before it is closer to
   it than the node is, by the factor ``ALPHA``; at most ``DEGREE`` stay. Lists of a node from all its shards are united.
   A node whose list had no room for all that lies within the search's reach is crowded, and enters its own list.
4. Each node searches the united graph within each of its shards: greedily from the shard's medoid to its own
   neighbourhood, then outward, over all nodes within ``reach``. Crowded nodes, and nodes whose search meets one, are
   compared with all members of the task instead. What is left has all its links among its candidates, and each of them
   was kept or has a kept node closer to it by ``ALPHA`` on the way, so no link within a task is missed.
5. Pairs found are checked in double precision. A pair that shares several shards counts in the least of them. Tasks
   write sums per node and a spanning forest, never the pairs, so a group of near copies costs no rows beyond its own.
6. ``audit`` compares a bounded number of nodes with all nodes of their label, over all shards; where the search found too
   little, all pairs are compared instead.

A shard of more than ``BLOCK`` nodes is cut into blocks that meet pairwise. Vectors that are null, zero, or hold null or
non-finite components, and rows with a null label, link with nothing; so do vectors of different lengths. Repeated rows
are vectors of their own. A null id is ordered before all others. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import column, ship, stage
from changeflow.llm.graph import components
from changeflow.llm.runs import Forest, blocked, whole_runs

SAMPLE = 20_000
PER_SHARD = 1_500
MOST_CENTROIDS = 4_096
OVERLAP = 3
CANDIDATES = 48
DEGREE = 24
ALPHA = 1.2
SLACK = 0.06
BLOCK = 1_024
EVERY = 100
AUDITED_NODES = 2_048
LEAST_RECALL = 0.9
NO_ID = -(1 << 63)


def nodes_of(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows (id, node or null) and nodes (node, label, size, weight, vec)."""
    v = F.col("_v")
    good = (
        F.col("_label").isNotNull()
        & v.isNotNull()
        & (F.size(v) > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists(v, lambda x: x != 0)
    )
    rows = vectors.select(
        F.coalesce(vectors[id_col].cast("long"), F.lit(NO_ID)).alias("id"),
        vectors[label_col].cast("string").alias("_label"),
        # Adding zero makes negative zeros positive, so equal vectors have equal bytes.
        F.transform(vectors[vector_col].cast("array<double>"), lambda x: x + F.lit(0.0)).alias("_v"),
    )
    node = F.when(F.coalesce(good, F.lit(False)), F.xxhash64("_label", F.size(v), v))
    rows = stage(rows.withColumn("node", node), "vectors")
    nodes = (
        rows.where(F.col("node").isNotNull())
        .groupBy("node")
        .agg(F.first("_label").alias("label"), F.first("_v").alias("vec"), F.count("*").alias("weight"), F.min("id").alias("id"))
        .withColumn("size", F.size("vec"))
    )
    return rows.select("id", "node"), stage(nodes, "vector-nodes")


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def centroids(nodes: DataFrame) -> np.ndarray:
    """k-means over a bounded sample: the nodes least by hash, of the most common length among them."""
    sample = nodes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("vec").toArrow().column("vec").to_pylist()
    if not sample:
        return np.zeros((0, 0))
    sizes, counts = np.unique([len(v) for v in sample], return_counts=True)
    x = unit(np.asarray([v for v in sample if len(v) == sizes[counts.argmax()]]))
    k = int(np.clip(nodes.count() // PER_SHARD, 1, min(MOST_CENTROIDS, len(x))))
    found = x[np.random.default_rng(5).choice(len(x), k, replace=False)]
    for _ in range(6):
        own = (x @ found.T).argmax(axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, own, x)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        found = np.where(length > 0, sums / np.where(length > 0, length, 1), found)
    return found


def shard_rows(nodes: DataFrame, found: np.ndarray) -> DataFrame:
    """A row per node and shard: (shard, shards, node, weight, vec), with block pairs."""
    shared = nodes.sparkSession.sparkContext.broadcast(found)  # at most MOST_CENTROIDS vectors

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = shared.value
        for batch in batches:
            vectors, near = column(batch, "vec").to_pylist(), []
            for v in vectors:
                if len(v) == centres.shape[1] and len(centres) > 1:
                    near.append(np.argsort(-(centres @ np.asarray(v)))[:OVERLAP].tolist())
                else:
                    near.append([0])
            yield batch.append_column("near", pa.array(near, pa.list_(pa.int64())))

    schema = "node long, label string, vec array<double>, weight long, id long, size int, near array<long>"
    placed = nodes.mapInArrow(assign, schema)
    shards = F.transform("near", lambda k: F.xxhash64("label", "size", k))
    placed = placed.withColumn("shards", shards).withColumn("shard", F.explode("shards"))
    return in_blocks(placed)


def in_blocks(placed: DataFrame) -> DataFrame:
    """Nodes of each shard in block pairs. Members are counted on ids alone, so a crowded shard's vectors meet no task."""
    placed = placed.select("shard", "shards", "node", "weight", "vec")
    members = placed.groupBy("shard").agg(F.count("*").alias("members"))
    return stage(blocked(placed.join(members, "shard"), "members", "node", BLOCK), "vector-shards")


def label_rows(nodes: DataFrame) -> DataFrame:
    """All nodes of a label and length as one shard, for comparison of all pairs in blocks."""
    shard = F.xxhash64("label", "size")
    return in_blocks(nodes.withColumn("shard", shard).withColumn("shards", F.array(shard)))


def reach(least: float) -> float:
    """Least cosine of the nodes that a search for ``least`` goes through.

    A pruned link is followed by way of nodes at most ``(1 + ALPHA ** -1)`` times as far off as the link is long.
    """
    return min(least - SLACK, 1 - (1 - least) * (1 + 1 / ALPHA) ** 2 - 1e-6)


def prune(x: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Neighbour lists (n, DEGREE) of unit vectors, unused places holding the node itself, and which are crowded."""
    n, within = len(x), 1 - reach(least)
    crowded = np.zeros(n, bool)
    keep = np.repeat(np.arange(n)[:, None], DEGREE, axis=1)
    width = min(CANDIDATES, n - 1)
    for start in range(0, n, 128):
        rows = np.arange(start, min(start + 128, n))
        if width < 1:
            break
        near = x[rows] @ x.T
        near[np.arange(len(rows)), rows] = -2
        best = np.argpartition(-near, width - 1, axis=1)[:, :width]
        best = np.take_along_axis(best, np.argsort(-np.take_along_axis(near, best, 1), axis=1, kind="stable"), 1)
        own = 1 - np.take_along_axis(near, best, 1)
        between = 1 - np.einsum("rik,rjk->rij", x[best], x[best], optimize=True)
        alive, filled = np.ones(best.shape, bool), np.zeros(len(rows), np.int64)
        for j in range(width):
            take = np.flatnonzero(alive[:, j] & (filled < DEGREE))
            keep[rows[take], filled[take]] = best[take, j]
            filled[take] += 1
            alive[take] &= ALPHA * between[take, j] > own[take]
        # What is still alive found no place; behind a full row of candidates there may be more.
        crowded[rows] = (alive & (own <= within)).any(axis=1) | ((width < n - 1) & (own[:, -1] <= within))
    return keep, crowded


def edges_of_shards(rows: DataFrame, least: float) -> DataFrame:
    """(node, near): pruned lists of every shard; crowded nodes are near themselves."""

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_runs(batches, ["shard", "_i", "_j"]):
            ids, vectors, out_a, out_b = table.column("node").to_numpy(), table.column("vec").to_pylist(), [], []
            for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                lists, crowded = prune(unit(np.asarray(vectors[low:high])), least)
                own = np.repeat(np.arange(high - low), DEGREE)
                real = lists.ravel() != own
                out_a.append(ids[low + own[real]])
                out_b.append(ids[low + lists.ravel()[real]])
                out_a.append(ids[low:high][crowded])
                out_b.append(ids[low:high][crowded])
            arrays = [pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))]
            yield pa.RecordBatch.from_arrays(arrays, ["node", "near"])

    dealt = rows.select("shard", "_i", "_j", "node", "vec").repartition("shard", "_i", "_j")
    return dealt.sortWithinPartitions("shard", "_i", "_j").mapInArrow(build, "node long, near long")


def range_search(x: np.ndarray, lists: np.ndarray, least: float, crowded: np.ndarray) -> np.ndarray:
    """Boolean (n, n): pairs within ``least`` cosine that the graph search reaches, for every node as a query.

    ``lists``: neighbours of each node, padded with the node itself. ``crowded`` nodes are compared with all.
    """
    n = len(x)
    through = reach(least)
    whole = crowded.copy()  # queries that a comparison with all members answers
    centre = unit(x.mean(axis=0, keepdims=True) + 1e-300)[0] if n else None
    here = np.full(n, int(np.argmax(x @ centre)))  # the medoid
    cosine = x @ x[here[0]]
    while True:
        near = lists[here]
        value = np.einsum("qd,qrd->qr", x, x[near], optimize=True)
        best = value.argmax(axis=1)
        better = value[np.arange(n), best] > cosine + 1e-12
        if not better.any():
            break
        here[better], cosine[better] = near[better, best[better]], value[better, best[better]]
    seen, found = np.zeros((n, n), bool), np.zeros((n, n), bool)
    own = np.flatnonzero(~whole)
    q = np.concatenate([own, own])
    at = np.concatenate([here[own], own])  # where the search ended, and the query's own place
    seen[q, at] = True
    met = crowded[at] & (np.einsum("kd,kd->k", x[q], x[at]) >= through)
    whole[q[met]] = True
    q, at = q[~whole[q]], at[~whole[q]]
    while len(q):
        next_q, next_at = [], []
        for part in np.array_split(np.arange(len(q)), len(q) // 50_000 + 1):
            a = np.repeat(q[part], lists.shape[1])
            b = lists[at[part]].ravel()
            new = ~seen[a, b]
            code = np.unique(a[new] * n + b[new])
            a, b = code // n, code % n
            seen[a, b] = True
            value = np.einsum("kd,kd->k", x[a], x[b])
            near = value >= through
            whole[a[near & crowded[b]]] = True
            found[a, b] |= value >= least - 1e-9
            next_q.append(a[near])
            next_at.append(b[near])
        q, at = np.concatenate(next_q), np.concatenate(next_at)
        q, at = q[~whole[q]], at[~whole[q]]
    for some in np.array_split(np.flatnonzero(whole), int(whole.sum()) // 512 + 1):
        found[some] = x[some] @ x.T >= least - 1e-9
    np.fill_diagonal(found, False)
    return found | found.T


def _padded(ids: np.ndarray, near: list[list[int]]) -> np.ndarray:
    """Lists as places within the shard; neighbours of other shards drop out, gaps hold the node itself."""
    place = {node: i for i, node in enumerate(ids.tolist())}
    inside = [[place[b] for b in own or [] if b in place] for own in near]
    width = max(1, max(map(len, inside)))
    return np.asarray([own + [i] * (width - len(own)) for i, own in enumerate(inside)])


def search(rows: DataFrame, lists: DataFrame, least: float) -> DataFrame:
    """Rows (a, b, links): with b null the links of node a; with b a spanning link."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "links"]
        for table, bounds in whole_runs(batches, ["shard", "_i", "_j"]):
            columns = [table.column(c).to_numpy() for c in ("shard", "_i", "_j", "_own", "node", "weight")]
            vectors, near, shards = (table.column(c).to_pylist() for c in ("vec", "near", "shards"))
            out = []
            for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if high - low < 2:
                    continue
                shard, i, j, own, ids, weight = (c[low:high] for c in columns)
                x = np.asarray(vectors[low:high])
                norm = np.linalg.norm(x, axis=1)
                crowded = np.asarray([k in (own or []) for k, own in zip(ids.tolist(), near[low:high], strict=True)])
                found = range_search(x / norm[:, None], _padded(ids, near[low:high]), least, crowded)
                a, b = np.nonzero(np.triu(found, 1))
                exact = np.einsum("kd,kd->k", x[a], x[b]) / (norm[a] * norm[b]) >= least
                a, b = a[exact], b[exact]
                # Count a pair in the least shard and the one block pair that both of its nodes call theirs.
                here = np.minimum(own[a], own[b]) == i[0]
                here &= np.maximum(own[a], own[b]) == j[0]
                wide = np.full((high - low, OVERLAP), shard[0])
                for k, s in enumerate(shards[low:high]):
                    wide[k, : len(s)] = s
                common = np.full(len(a), shard[0])
                for s in range(OVERLAP):
                    both = (wide[b] == wide[a, s][:, None]).any(axis=1)
                    common = np.where(both, np.minimum(common, wide[a, s]), common)
                here &= common == shard[0]
                links = np.bincount(a[here], weights=weight[b[here]], minlength=len(ids))
                links += np.bincount(b[here], weights=weight[a[here]], minlength=len(ids))
                out += [(int(ids[k]), None, int(links[k])) for k in np.flatnonzero(links).tolist()]
                forest = Forest(len(ids))
                for s, t in zip(a.tolist(), b.tolist(), strict=True):
                    if forest.union(s, t):
                        out.append((int(ids[s]), int(ids[t]), 0))
            values = list(zip(*out, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in values], names)

    met = rows.join(lists, "node", "left").repartition("shard", "_i", "_j").sortWithinPartitions("shard", "_i", "_j")
    schema = "a long, b long, links long"
    wanted = ["shard", "_i", "_j", "_own", "node", "weight", "vec", "near", "shards"]
    return stage(met.select(*wanted).mapInArrow(run, schema), "vector-links")


def found_links(nodes: DataFrame, least: float) -> DataFrame:
    ship(nodes.sparkSession)
    rows = shard_rows(nodes, centroids(nodes))
    lists = edges_of_shards(rows, least).groupBy("node").agg(F.collect_set("near").alias("near"))
    return search(rows, stage(lists, "vector-graph"), least)


def all_links(nodes: DataFrame, least: float) -> DataFrame:
    """The same rows by comparison of all pairs: every node is crowded, and a label is one shard."""
    lists = nodes.select("node", F.array("node").alias("near"))
    return search(label_rows(nodes), lists, least)


def link_sums(found: DataFrame) -> DataFrame:
    return found.where(F.col("b").isNull()).groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))


def audit(nodes: DataFrame, found: DataFrame, least: float = 0.98) -> float:
    """Share of the true links of audited nodes that were found, over all shards.

    Audited are nodes whose least id is divisible by ``EVERY``, at most ``AUDITED_NODES`` of them, least by hash, so their
    vectors may be sent to all tasks. Each is compared with every node of its label.
    """
    asked = nodes.where(F.pmod("id", F.lit(EVERY)) == 0).orderBy(F.xxhash64("node"), "node").limit(AUDITED_NODES)
    queries = asked.select("node", "label", "vec").toArrow()
    if not queries.num_rows:
        return 1.0
    ids = queries.column("node").to_numpy()
    by_kind: dict[tuple[str, int], list[int]] = {}
    vectors = queries.column("vec").to_pylist()
    for k, (label, v) in enumerate(zip(queries.column("label").to_pylist(), vectors, strict=True)):
        by_kind.setdefault((label, len(v)), []).append(k)
    kinds = {kind: (np.asarray(own), unit(np.asarray([vectors[k] for k in own]))) for kind, own in by_kind.items()}
    shared = nodes.sparkSession.sparkContext.broadcast((ids, kinds))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, kinds = shared.value
        true = np.zeros(len(ids), np.int64)
        for batch in batches:
            node, weight = column(batch, "node").to_numpy(), column(batch, "weight").to_numpy()
            labels, vecs = column(batch, "label").to_pylist(), column(batch, "vec").to_pylist()
            rows: dict[tuple[str, int], list[int]] = {}
            for k, (label, v) in enumerate(zip(labels, vecs, strict=True)):
                rows.setdefault((label, len(v)), []).append(k)
            for kind, own in rows.items():
                if kind in kinds:
                    at, x = kinds[kind]
                    hit = x @ unit(np.asarray([vecs[k] for k in own])).T >= least
                    hit &= ids[at][:, None] != node[own][None, :]
                    true[at] += hit @ weight[own]
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(true)], ["node", "links"])

    rows = nodes.select("node", "label", "vec", "weight")
    true = rows.mapInArrow(compare, "node long, links long").groupBy("node").agg(F.sum("links").alias("wanted")).where("wanted > 0")
    met = true.join(link_sums(found), "node", "left").withColumn("got", F.least(F.coalesce("links", F.lit(0)), "wanted"))
    sums = met.agg(F.sum("wanted"), F.sum("got")).first()
    return sums[1] / sums[0] if sums[0] else 1.0


def near_duplicates(
    vectors: DataFrame, least: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """(id, n_links, component_id, kept, recall) per row.

    ``recall`` is one value, what ``audit`` measured of the graph search. Below ``LEAST_RECALL`` all pairs of a label are
    compared in blocks instead, and measured again.
    """
    rows, nodes = nodes_of(vectors, id_col, vector_col, label_col)
    found = found_links(nodes, least)
    recall = audit(nodes, found, least)
    if recall < LEAST_RECALL:
        found = all_links(nodes, least)
        recall = audit(nodes, found, least)
    linked = components(found.where(F.col("b").isNotNull()).select("a", "b"))
    sums = link_sums(found)
    placed = nodes.select("node", "weight", "id").join(linked, "node", "left")
    placed = placed.withColumn("root", F.coalesce("component", "node")).join(sums, "node", "left")
    smallest = placed.groupBy("root").agg(F.min("id").alias("smallest"))
    per_node = placed.join(smallest, "root").select(
        F.col("node").alias("_node"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "smallest"
    )
    component = F.coalesce("smallest", "id")
    return rows.join(per_node, F.col("node") == F.col("_node"), "left").select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(component != NO_ID, component).alias("component_id"),
        (F.col("id") == component).alias("kept"),
        F.lit(float(recall)).alias("recall"),
    )
