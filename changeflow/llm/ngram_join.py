"""Similarity join of documents on sets of word n-grams by grouped prefixes.

1. Words are counted in ``RARITY_BUCKETS`` hash buckets over the whole corpus. The counts give one global order of
   shingles, those of rare words first; it steers load only, any order gives the same result.
2. Each document becomes a sorted set of 64-bit shingle hashes, of which its size, a digest, the prefix that any
   partner must share a shingle with, and counts by hash bucket are kept.
3. Documents with equal sets are one class. Classes with equal prefix and size, and equal counts by hash bucket, are one group.
4. Groups that share a prefix shingle meet. Pairs whose sizes or bucket counts rule the threshold out are dropped;
   bucket counts differ by no more than the sets do, so no link is lost. Of the rest each task passes on a spanning
   forest, which gives candidate components without writing pairs down. Groups are expanded to their classes.
5. The classes' sets are built again from text, and all pairs within a candidate component are compared exactly. Tasks
   write links per class and a spanning forest, never the pairs, so a group of near copies costs no rows beyond its own.

Lists and candidate components larger than a block are cut into blocks that meet pairwise in tasks of their own, so
no task holds more than two blocks.

Null and empty texts, and texts without words, have the empty set: size 0, linked with nothing. A text with fewer
words than ``width`` is one shingle. Repeated rows and ids are documents of their own; a null id is ordered before all
others, and a component whose least id is null has a null id. Extra columns are not read. Two different shingles
whose 64-bit hashes are equal would count as one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changeflow.llm.byte_pieces import IS_SPACE, text_bytes
from changeflow.llm.columns import same
from changeflow.llm.common import column, ship, stage, sub_batches
from changeflow.llm.graph import components
from changeflow.llm.runs import Forest, blocked, whole_runs

RARITY_BUCKETS = 1 << 16
COUNT_BUCKETS = 64
MOST_BUCKETS = 1 << 14
LIST_BLOCK = 2_048
SET_BLOCK = 512
SET_VALUES = 1 << 21  # shingles compared at once
TEXT_BYTES = 3 << 20  # of text that a task turns into arrays at once
NO_ID = -(1 << 63)
SPAN = 1 << 20  # bytes whose words are hashed at once
LONG_WORD = 512
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))

_tables: list[np.ndarray] = []


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * MIX[1]
    x = (x ^ (x >> np.uint64(32))) * MIX[2]
    return x ^ (x >> np.uint64(31))


def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64, and a random number for each byte, equal for A-Z and a-z."""
    if not _tables:
        of_byte = np.random.default_rng(17).integers(1, 1 << 63, 256, np.uint64)
        of_byte[ord("A") : ord("Z") + 1] = of_byte[ord("a") : ord("z") + 1]
        for base in (int(MIX[0]), pow(int(MIX[0]), -1, 1 << 64)):
            steps = np.full(SPAN + 1, base, np.uint64)
            steps[0] = 1
            _tables.append(np.cumprod(steps))
        _tables.append(of_byte)
    return tuple(_tables)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and 64-bit hash of every word ``[^\\x20\\x09-\\x0D]+`` of a batch, A-Z lowered.

    Words are stretches of the batch's bytes; their hashes are differences of running sums of (byte's number * power of
    its place), shifted to place 0. Very long words are hashed one by one.
    """
    data, bounds = text_bytes(texts)
    space = IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before, behind = np.ones(len(data), bool), np.ones(len(data), bool)
    before[1:], behind[:-1] = space[:-1], space[1:]
    starts = np.flatnonzero(~space & (before | edge[:-1]))
    ends = np.flatnonzero(~space & (behind | edge[1:])) + 1
    out, low = np.empty(len(starts), np.uint64), 0
    up, down, of_byte = _powers()
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(ends, starts[low] + SPAN, side="right")))
        first = starts[low]
        if ends[high - 1] - first <= SPAN:
            part = data[first : ends[high - 1]]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(of_byte[part] * up[: len(part)], out=sums[1:])
            a, b = starts[low:high] - first, ends[low:high] - first
            out[low:high] = mixed((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
        low = high
    for k in np.flatnonzero(ends - starts > LONG_WORD).tolist():
        out[k] = xxhash.xxh3_64_intdigest(data[starts[k] : ends[k]].tobytes().lower())
    return np.searchsorted(bounds, starts, side="right") - 1, out


def shingles(rows: np.ndarray, words: np.ndarray, n_rows: int, width: int, rarity: np.ndarray):
    """Distinct shingles of all rows, in the global order within each row: (row, hash), and set sizes."""
    weight = rarity[(words >> np.uint64(48)).astype(np.int64)].astype(np.uint64)
    counts = np.bincount(rows, minlength=n_rows)
    first = np.cumsum(counts) - counts
    length = np.minimum(counts, width)
    last = first + np.maximum(counts - width, 0)
    starts = np.arange(len(words))
    starts = starts[starts <= last[rows]]
    own = rows[starts]
    value, load = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)
    for k in range(width):
        within = k < length[own]
        at = np.minimum(starts + k, len(words) - 1)
        value = np.where(within, mixed(value + words[at] * MIX[0] + np.uint64(k + 1)), value)
        load += np.where(within, weight[at], np.uint64(0))
    order = np.lexsort((value, (own.astype(np.uint64) << np.uint64(24)) | load))
    own, value = own[order], value[order]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (value[1:] != value[:-1])
    own, value = own[new], value[new]
    return own, value, np.bincount(own, minlength=n_rows)


def fine_buckets(n: int, percent: int) -> int:
    """How many buckets tell unrelated sets of ``n`` shingles apart; 0 when ``COUNT_BUCKETS`` do.

    Counts of unrelated sets differ by about 1.13 * sqrt(n * buckets) in all; that has to be well above the difference
    that links are allowed. Too few buckets cost comparisons, never links.
    """
    allowed = 2 * n * (100 - percent) / (100 + percent)
    buckets = COUNT_BUCKETS
    while buckets < MOST_BUCKETS and 1.13 * (n * buckets) ** 0.5 < 1.3 * allowed:
        buckets *= 4
    return buckets if buckets > COUNT_BUCKETS else 0


def least_overlap(n, percent: int):
    return (percent * n + 99) // 100


def _lists(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(flat))


def word_rarity(docs: DataFrame) -> np.ndarray:
    """Weight of each hash bucket of words: the logarithm of its count. A fixed number of values at any size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(RARITY_BUCKETS, np.int64)
        for batch in sub_batches(batches, TEXT_BYTES):
            _, words = word_hashes(column(batch, "_text"))
            total += np.bincount((words >> np.uint64(48)).astype(np.int64), minlength=RARITY_BUCKETS)
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(total[full])], ["bucket", "n"])

    sums = docs.select("_text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = sums.toArrow()  # at most RARITY_BUCKETS rows
    counts = np.zeros(RARITY_BUCKETS)
    counts[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return np.minimum(np.log2(counts + 1) * 512, (1 << 16) - 1).astype(np.uint16)


def profiles(docs: DataFrame, rarity: np.ndarray, width: int, percent: int) -> DataFrame:
    """Narrow rows per document: n, set digest (d1, d2), prefix and its digest, bucket counts."""
    shared = docs.sparkSession.sparkContext.broadcast(rarity)  # of fixed size

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, TEXT_BYTES):
            rows, words = word_hashes(column(batch, "_text"))
            own, value, n = shingles(rows, words, batch.num_rows, width, shared.value)
            d1, d2 = np.zeros(batch.num_rows, np.uint64), np.zeros(batch.num_rows, np.uint64)
            full = np.flatnonzero(n)
            first = np.cumsum(n) - n
            if len(full):
                d1[full] = np.add.reduceat(value, first[full])
                d2[full] = np.add.reduceat(mixed(value ^ MIX[0]), first[full])
            p = np.where(n > 0, n - least_overlap(n, percent) + 1, 0)
            rank = np.arange(len(own)) - first[own]
            prefix = value[rank < p[own]]
            dp = np.zeros(batch.num_rows, np.uint64)
            if len(full):
                dp[full] = np.add.reduceat(mixed(prefix ^ MIX[1]), (np.cumsum(p) - p)[full])
            bucket = own * COUNT_BUCKETS + (value >> np.uint64(58)).astype(np.int64)
            counts = np.bincount(bucket, minlength=batch.num_rows * COUNT_BUCKETS)
            # One byte each, modulo 256; ``within_reach`` compares them so.
            marks = counts.astype(np.uint8).reshape(batch.num_rows, COUNT_BUCKETS)
            fine = [b""] * batch.num_rows
            for i in full.tolist():
                if buckets := fine_buckets(int(n[i]), percent):
                    shift = np.uint64(64 - (buckets.bit_length() - 1))
                    bucket = (value[first[i] : first[i] + n[i]] >> shift).astype(np.int64)
                    fine[i] = np.bincount(bucket, minlength=buckets).astype(np.uint8).tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "id"),
                    column(batch, "row_key"),
                    pa.array(n.astype(np.int64)),
                    pa.array(d1.view(np.int64)),
                    pa.array(d2.view(np.int64)),
                    pa.array(dp.view(np.int64)),
                    _lists(prefix.view(np.int64), p),
                    pa.array([m.tobytes() for m in marks], pa.binary()),
                    pa.array(fine, pa.binary()),
                ],
                ["id", "row_key", "n", "d1", "d2", "dp", "prefix", "marks", "fine"],
            )

    schema = "id long, row_key long, n long, d1 long, d2 long, dp long, prefix array<long>, marks binary, fine binary"
    return docs.mapInArrow(profile, schema)


def within_reach(n_a, n_b, marks_a, marks_b, percent: int) -> np.ndarray:
    """Whether pairs may link, judged by sizes and bucket counts; never false for a pair that links."""
    low, high = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    near = 100 * low >= percent * high
    # Links need 100 * common >= percent * union, so the sets differ in at most this many shingles.
    room = (n_a + n_b) * (100 - percent) // (100 + percent)
    at = np.flatnonzero(near)
    near[at] = least_gap(marks_a[at], marks_b[at]) <= room[at]
    return near


def least_gap(marks_a: np.ndarray, marks_b: np.ndarray) -> np.ndarray:
    """Least sum of differences that fits bucket counts known modulo 256."""
    gap = marks_a - marks_b
    return np.minimum(gap, np.uint8(0) - gap).sum(axis=1, dtype=np.int64)


def still_near(n_a, n_b, fine_a: list[bytes], fine_b: list[bytes], percent: int) -> np.ndarray:
    """The same check with the finer counts, for pairs of which both sets have them; at the coarser one's buckets."""
    near = np.ones(len(n_a), bool)
    sizes = np.asarray([(len(a), len(b)) for a, b in zip(fine_a, fine_b, strict=True)], np.int64).reshape(-1, 2)
    for pair in np.unique(sizes, axis=0):
        buckets = int(pair.min())
        if not buckets:
            continue
        at = np.flatnonzero((sizes == pair).all(axis=1))
        for some in np.array_split(at, len(at) * int(pair.max()) // (8 << 20) + 1):
            a, b = (_folded([f[i] for i in some.tolist()], buckets) for f in (fine_a, fine_b))
            near[some] = least_gap(a, b) <= (n_a[some] + n_b[some]) * (100 - percent) // (100 + percent)
    return near


def _folded(counts: list[bytes], buckets: int) -> np.ndarray:
    rows = np.frombuffer(b"".join(counts), np.uint8).reshape(len(counts), buckets, -1)
    return rows.sum(axis=2, dtype=np.uint8)


def candidate_edges(lists: DataFrame, percent: int) -> DataFrame:
    """Spanning edges (a, b) of groups that share a prefix shingle and are within reach."""

    def span(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Edges already implied by earlier ones of this task are not written again.
        place: dict[int, int] = {}
        written = Forest(0)
        for table, bounds in whole_runs(batches, ["token", "_i", "_j"]):
            ids, n = table.column("g").to_numpy(), table.column("n").to_numpy()
            marks = np.frombuffer(b"".join(table.column("marks").to_pylist()), np.uint8).reshape(-1, COUNT_BUCKETS)
            fine = table.column("fine").to_pylist()
            known, node = np.unique(ids, return_inverse=True)
            spots = np.fromiter((place.setdefault(i, len(place)) for i in known.tolist()), np.int64, len(known))
            written.up = np.append(written.up, np.arange(len(written.up), len(place)))
            # Start from what is connected already.
            roots = np.fromiter(map(written.root, spots.tolist()), np.int64, len(spots))
            _, first, group = np.unique(roots, return_index=True, return_inverse=True)
            forest = Forest(len(known))
            forest.up = np.minimum(first[group], np.arange(len(known)))
            end = np.repeat(bounds[1:], np.diff(bounds))
            a, step, out = np.arange(len(ids)), 1, []
            while len(a := a[a + step < end[a]]):
                flat = forest.flatten()
                some = a[flat[node[a]] != flat[node[a + step]]]
                b = some + step
                hit = within_reach(n[some], n[b], marks[some], marks[b], percent)
                some, b = some[hit], b[hit]
                hit = still_near(n[some], n[b], [fine[i] for i in some.tolist()], [fine[i] for i in b.tolist()], percent)
                for x, y in zip(node[some[hit]].tolist(), node[b[hit]].tolist(), strict=True):
                    if forest.union(x, y):
                        written.union(spots[x], spots[y])
                        out.append((known[x], known[y]))
                step += 1
            pairs = np.asarray(out, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    dealt = lists.repartition("token", "_i", "_j").sortWithinPartitions("token", "_i", "_j")
    return dealt.mapInArrow(span, "a long, b long")


def links_of(
    ids: np.ndarray, sets: list[np.ndarray], weight: np.ndarray, own: np.ndarray, block: tuple[int, int], percent: int
) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links of each set of one block pair, weighted by the other's documents, and a spanning forest of them.

    Two sets of one block meet in all of its block pairs; they count in the pair of the block with itself.
    """
    n = np.fromiter(map(len, sets), np.int64, len(sets))
    part = np.cumsum(n) // SET_VALUES  # so that two parts at a time fit
    forest, out, links = Forest(len(sets)), [], np.zeros(len(sets), np.int64)
    parts = [np.flatnonzero(part == k) for k in np.unique(part)]
    for i, mine in enumerate(parts):
        for theirs in parts[i:]:
            members = mine if theirs is mine else np.concatenate([mine, theirs])
            for a, b in _pairs_that_link(members, sets, n, own, block, len(mine), percent):
                links[a] += weight[b].sum()
                links[b] += weight[a]
                for x in b[forest.flatten()[b] != forest.root(a)].tolist():
                    if forest.union(a, x):
                        out.append((int(ids[a]), int(ids[x])))
    return links, out


def _pairs_that_link(members, sets, n, own, block, first: int, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each of the ``first`` members with all later members it links to; sets are bit rows over shingles that two hold."""
    values, code, often = np.unique(np.concatenate([sets[m] for m in members]), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(members)), n[members])
    shared = often > 1  # others are in no intersection
    dense = np.cumsum(shared) - 1
    keep = shared[code]
    row, code = row[keep], dense[code[keep]]
    bits = np.zeros((len(members), max(-(-int(shared.sum()) // 8), 1)), np.uint8)
    np.bitwise_or.at(bits, (row, code >> 3), np.uint8(1) << (code & 7).astype(np.uint8))
    chunk = max(1, (4 << 20) // bits.shape[1])
    size, side = n[members], own[members]
    for a in range(min(first, len(members) - 1)):
        # Pairs of the first part met before.
        b = np.arange(max(a + 1, first if first < len(members) else 0), len(members))
        here = (np.minimum(side[a], side[b]) == block[0]) & (np.maximum(side[a], side[b]) == block[1])
        b = b[here & (100 * np.minimum(size[a], size[b]) >= percent * np.maximum(size[a], size[b]))]
        for some in (b[i : i + chunk] for i in range(0, len(b), chunk)):
            common = np.bitwise_count(bits[a] & bits[some]).sum(axis=1, dtype=np.int64)
            good = some[100 * common >= percent * (size[a] + size[some] - common)]
            if len(good):
                yield members[a], members[good]


def exact_links(sets: DataFrame, percent: int) -> DataFrame:
    """Rows (a, b, links): with b null the links of class a in one block pair; with b a spanning link.

    ``sets``: class id ``c``, its documents ``w``, component ``cc``, block ``_own``, block pair ``_i``, ``_j``, and ``set``.
    """

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_runs(sub_batches(batches), ["cc", "_i", "_j"]):
            ids, weight, own, low_block, high_block = (table.column(c).to_numpy() for c in ("c", "w", "_own", "_i", "_j"))
            lists = table.column("set").combine_chunks()
            flat, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            counted, spanning = [], []
            for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if high - low > 1:
                    some = [flat[ends[k] : ends[k + 1]] for k in range(low, high)]
                    block = (int(low_block[low]), int(high_block[low]))
                    links, pairs = links_of(ids[low:high], some, weight[low:high], own[low:high], block, percent)
                    counted += [(int(ids[low + k]), None, int(links[k])) for k in np.flatnonzero(links).tolist()]
                    spanning += [(a, b, 0) for a, b in pairs]
            values = list(zip(*(counted + spanning), strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in values], ["a", "b", "links"])

    # Sets are long rows: more and smaller partitions than the default keep a task's batches small.
    parts = 4 * int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = sets.repartition(parts, "cc", "_i", "_j").sortWithinPartitions("cc", "_i", "_j")
    return dealt.select("c", "w", "cc", "_own", "_i", "_j", "set").mapInArrow(compare, "a long, b long, links long")


def with_sets(texts: DataFrame, rarity: np.ndarray, width: int) -> DataFrame:
    """Replace ``_text`` by the set of its shingles."""
    shared = texts.sparkSession.sparkContext.broadcast(rarity)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, TEXT_BYTES):
            rows, words = word_hashes(column(batch, "_text"))
            _, value, n = shingles(rows, words, batch.num_rows, width, shared.value)
            sets = _lists(value.view(np.int64), n)
            kept = [column(batch, name) for name in ("c", "w", "cc", "size")]
            yield pa.RecordBatch.from_arrays([*kept, sets], ["c", "w", "cc", "size", "set"])

    narrow = texts.select("c", "w", "cc", "size", "_text")
    return narrow.mapInArrow(build, "c long, w long, cc long, size long, set array<long>")


def ngram_components(
    docs: DataFrame, width: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, row_key, n_shingles, component_id, n_links) per document row; ``row_key`` tells rows with one id apart by text.

    ``n_links`` counts the other documents that a document links to.
    """
    ship(docs.sparkSession)
    texts = docs.select(
        F.coalesce(docs[id_col].cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(docs[text_col]).alias("row_key"),
        docs[text_col].alias("_text"),
    )
    rarity = word_rarity(texts)
    rows = stage(profiles(texts, rarity, width, percent), "ngram-profiles")
    full = rows.where("n > 0")
    # A class stands for all documents with one set; its row is read again for the comparison.
    classes = full.groupBy("n", "d1", "d2").agg(
        F.min(F.struct("id", "row_key")).alias("r"),
        F.count("*").alias("w"),
        F.first("dp").alias("dp"),
        F.first("marks").alias("marks"),
        F.first("fine").alias("fine"),
    )
    number = F.xxhash64("n", "d1", "d2").alias("c")
    classes = stage(classes.select(number, "n", "d1", "d2", "w", "r.*", "dp", "marks", "fine"), "ngram-classes")
    # Groups: classes with equal prefix and size, and equal bucket counts, so that one check holds for all members.
    alike = ["n", "dp", "marks", "fine"]
    groups = classes.groupBy(*alike).agg(F.min(F.struct("c", "id", "row_key")).alias("r"))
    groups = stage(groups.select(F.col("r.c").alias("g"), *alike, "r.id", "r.row_key"), "ngram-groups")
    # Prefixes move once, for one document of each group.
    named = groups.select("g", "n", F.col("id").alias("_id"), F.col("row_key").alias("_key"))
    prefixes = full.select("id", "row_key", "prefix").join(
        named, (F.col("id") == F.col("_id")) & (F.col("row_key") == F.col("_key"))
    )
    prefixes = prefixes.groupBy("id", "row_key", "g", "n").agg(F.first("prefix").alias("prefix"))
    # Lists are counted where they meet: rows are narrow, and move once by token.
    listed = prefixes.select("g", "n", F.explode("prefix").alias("token")).withColumn(
        "size", F.count("*").over(W.partitionBy("token"))
    )
    lists = blocked(listed.where("size > 1"), "size", "g", LIST_BLOCK).join(groups.select("g", "marks", "fine"), "g")
    near = components(stage(candidate_edges(lists, percent), "ngram-candidates"))
    grouped = classes.join(groups.select("g", *alike), alike).join(near, F.col("g") == F.col("node"), "left")
    component = F.coalesce("component", "g").alias("cc")
    placed = grouped.select("c", "w", F.col("id").alias("_id"), F.col("row_key").alias("_key"), component)
    sizes = placed.groupBy("cc").agg(F.count("*").alias("size")).where("size > 1")
    members = placed.join(sizes, "cc")
    members = stage(members, "ngram-members")
    read = (
        # Both sides grow with the corpus: the same plan at every size.
        texts.join(members.hint("merge"), (F.col("id") == F.col("_id")) & (F.col("row_key") == F.col("_key")))
        .groupBy("id", "row_key", "c", "w", "cc", "size")
        .agg(F.first("_text").alias("_text"))
    )
    sets = blocked(with_sets(read, rarity, width), "size", "c", SET_BLOCK)
    found = stage(exact_links(sets, percent), "ngram-links")
    linked = components(found.where("b is not null").select("a", "b"))
    sums = found.where("b is null").groupBy(F.col("a").alias("_a")).agg(F.sum("links").alias("links"))
    placed = classes.select("c", "n", "d1", "d2", "w", "id").join(linked, F.col("c") == F.col("node"), "left")
    placed = placed.join(sums, F.col("c") == F.col("_a"), "left").drop("_a")
    placed = placed.withColumn("root", F.coalesce("component", "c")).drop("node", "component")
    least = placed.groupBy("root").agg(F.min("id").alias("least"))
    of_set = placed.join(least, "root").select(
        F.col("n").alias("_n"), F.col("d1").alias("_d1"), F.col("d2").alias("_d2"), "least",
        (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("links"),
    )
    on = (F.col("n") == F.col("_n")) & (F.col("d1") == F.col("_d1")) & (F.col("d2") == F.col("_d2"))
    least_id = F.coalesce("least", "id")
    return rows.join(of_set, on, "left").select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias(id_col),
        "row_key",
        F.col("n").alias("n_shingles"),
        F.when(least_id != NO_ID, least_id).alias("component_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
    )


def keep_one(docs: DataFrame, width: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component: the one of its least id (of repeated rows one stays)."""
    found = ngram_components(docs, width, percent, id_col, text_col)
    kept = found.where(same(F.col(id_col), F.col("component_id")))
    # Rows that share an id but are not one component each keep their row; equal rows are one component.
    kept = kept.select(F.coalesce(id_col, F.lit(NO_ID)).alias("id"), F.col("row_key").alias("key")).distinct()
    # The row is one column from here on, so its names meet none of these.
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    keyed = docs.select(row, F.coalesce(docs[id_col].cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(docs[text_col]).alias("key"))
    # The join's partitioning also serves the removal of repeated rows: texts move once.
    return keyed.join(kept, ["id", "key"], "left_semi").dropDuplicates(["id", "key"]).select("row.*")
