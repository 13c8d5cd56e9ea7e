"""Language-model scores from a probabilistic suffix tree over words.

Words are lower-cased (A-Z) runs of non-space; every text ends with one end token. Words are counted over the whole
training part, and these counts have no limit. The tree's alphabet is the ``SYMBOLS`` most frequent words and a class
for all others; within the class a seen word has its share of the class, and all unseen words together have
the Good-Turing share of words seen once.

A context is a run of up to ``MOST_DEPTH`` symbols before a token. It becomes a state when it occurs ``LEAST_CONTEXT`` times
or more and its next-symbol distribution diverges from its parent's (the longest state among its shorter contexts) by
``DIVERGENCE`` nats or more. A state's distribution is its counts, where ``LEAST_COUNT`` or more, smoothed towards its
parent's (Witten-Bell). A token is scored by the longest suffix of what stands before it that is a state. The number of
states and counts has no limit.

1. Texts are turned into symbol codes once and staged in chunks of documents.
2. Every chunk sends its distinct windows (four symbols and the next) with their counts to buckets by the nearest symbol, so
   a bucket holds all that follows its contexts and grows its part of the tree level by level.
3. A context that occurs more than ``BUCKET`` times has buckets of its own, dealt by its next older symbol. Its own counts are
   summed up beforehand, at most one row per symbol, and given to its buckets. So are those of longer contexts, as long as
   they are that frequent.
4. Buckets return one number per window to the chunks, which sum them up per document.

Broadcast are the ``COUNTED`` most frequent words and the plan of buckets. Words beyond meet their exact counts in a join.

``base_score`` is the sum over tokens of log10((c + 1) / (N + V + 1)).

A null or empty text is just its end token. Repeated rows count and are scored each. A null id trains as id ``null``. With
nothing to train on every word is unseen. Extra columns are not read. Words are told apart by 64-bit
hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.llm.common import column, ship, stage, sub_batches
from changeflow.llm.ngram_join import MIX, mixed, word_hashes

SYMBOLS = (1 << 16) - 2
COUNTED = 1 << 18
LEAST_CONTEXT = 32
LEAST_COUNT = 2
DIVERGENCE = 0.05
MOST_DEPTH = 4
TEXT_BYTES = 3 << 20  # of text that a task turns into arrays at once
CHUNK_BYTES = 8 << 20  # of text that is encoded as one chunk
MERGED_ROWS = 2_000_000
WORDS = 1 << 18  # whose counts are looked up at once
BUCKET = 1 << 20  # tokens whose contexts are settled at once
BITS = 16  # of a symbol code
FRACTION = 2.0**34  # of log10 probabilities that buckets return
RETURNED = "chunk long, bucket long, rows long, data binary, distinct long, chances binary"
OTHER, START = 0, SYMBOLS + 1
END = np.uint64(0x9D5E0A11B3C7F24D)  # no word's hash, but for one chance in 2^64


@dataclass
class Level:
    """States of one context length: sorted contexts, their kept counts and types, and sorted transitions."""

    contexts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    kept: np.ndarray = field(default_factory=lambda: np.zeros(0))
    types: np.ndarray = field(default_factory=lambda: np.zeros(0))
    moves: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    counts: np.ndarray = field(default_factory=lambda: np.zeros(0))


@dataclass
class Model:
    tokens: int
    types: int
    words: np.ndarray  # sorted hashes of the most frequent words
    counts: np.ndarray
    codes: np.ndarray
    root: np.ndarray  # probability of each symbol code
    other: int  # tokens outside the alphabet
    unseen: float
    levels: list[Level] = field(default_factory=list)


def find(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of each value in a sorted table, -1 where it is absent."""
    if not len(table):
        return np.full(len(values), -1)
    distinct, back = np.unique(values, return_inverse=True)
    at = np.minimum(np.searchsorted(table, distinct), len(table) - 1)
    return np.where(table[at] == distinct, at, -1)[back]


def sequences(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every token, ends included."""
    rows, words = word_hashes(texts)
    ends = np.cumsum(np.bincount(rows, minlength=len(texts)))
    return np.insert(rows, ends, np.arange(len(texts))), np.insert(words, ends, END)


def follow(context, code, depth: int):
    """Key of a context of ``depth`` symbols with one more symbol behind it; exact up to four symbols in all."""
    if depth <= 3:
        return (context << np.uint64(BITS)) | code
    return mixed(np.atleast_1d(context) * MIX[0] + code)


def coded(model: Model, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place in the table of counted words (or -1), and symbol code."""
    at = find(model.words, words)
    return at, np.where(at >= 0, model.codes[at], OTHER) if len(model.codes) else np.zeros(len(words), np.int64)


def chances(model: Model, contexts: list[np.ndarray], codes: np.ndarray) -> np.ndarray:
    """Probability of each code by the longest state among its contexts of 1, 2, ... symbols."""
    p = model.root[codes]
    for depth, (level, context) in enumerate(zip(model.levels, contexts, strict=False), 1):
        at = find(level.contexts, context)
        hit = np.flatnonzero(at >= 0)
        state = at[hit]
        move = find(level.moves, follow(context[hit], codes[hit].astype(np.uint64), depth))
        count = np.where(move >= 0, level.counts[move], 0.0) if len(level.counts) else np.zeros(len(hit))
        p[hit] = (count + level.types[state] * p[hit]) / (level.kept[state] + level.types[state])
    return p


class Sums:
    """Counts per key of many small arrays, merged now and then, so a task hands on each key about once.

    ``carried`` are values that are equal for equal keys. Keys themselves are handed on if they have a name.
    """

    def __init__(self, names: list[str | None]) -> None:
        self.names, self.parts, self.rows = names, [], 0

    def add(self, keys: np.ndarray, *carried: np.ndarray) -> None:
        keys, first, counts = np.unique(keys, return_index=True, return_counts=True)
        self.parts.append((keys, counts, *(x[first] for x in carried)))
        self.rows += len(keys)

    def merged(self) -> list[np.ndarray]:
        keys, counts, *carried = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        return [keys[first], np.add.reduceat(counts[order], first), *(x[order[first]] for x in carried)]

    def drain(self, final: bool = False) -> Iterator[pa.RecordBatch]:
        """Merge when much has come in; hand everything on when that does not help or at the end."""
        if not self.rows or not (final or self.rows > MERGED_ROWS):
            return
        columns = self.merged()
        self.parts, self.rows = [], 0
        if not final and len(columns[0]) < MERGED_ROWS // 2:
            self.parts, self.rows = [tuple(columns)], len(columns[0])
        else:
            named = [(c.view(np.int64) if c.dtype == np.uint64 else c, n) for c, n in zip(columns, self.names, strict=True) if n]
            for start in range(0, len(columns[0]), 100_000):
                arrays = [pa.array(c[start : start + 100_000]) for c, _ in named]
                yield pa.RecordBatch.from_arrays(arrays, [n for _, n in named])


def threshold(counted: DataFrame, name: str, most: int, least: int) -> int:
    """A count, ``least`` or more, that at most ``most`` rows reach: the lowest of 64 steps per power of two that will do."""
    step = F.floor(F.log2(name) * 64)
    bins = counted.where(F.col(name) >= least).groupBy(step.alias("bin")).agg(F.count("*").alias("rows"), F.max(name).alias("top"))
    total, value = 0, None
    for r in sorted(bins.collect(), key=lambda r: -r.bin):  # at most 64 rows per power of two
        total += r["rows"]
        if total > most:
            return value if value is not None else r.top + 1
        value = max(least, int(np.ceil(2 ** (r.bin / 64) - 1e-9)))
    return least


def count_words(train: DataFrame) -> DataFrame:
    """(w, c): every word's hash and count."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(["w", "c"])
        for batch in sub_batches(batches, TEXT_BYTES):
            sums.add(sequences(column(batch, "_text"))[1])
            yield from sums.drain()
        yield from sums.drain(final=True)

    return train.select("_text").mapInArrow(count, "w long, c long").groupBy("w").agg(F.sum("c").alias("c"))


def alphabet(words: DataFrame) -> Model:
    total = words.agg(F.sum("c"), F.count("*")).first()
    tokens, types = total[0] or 0, total[1]
    least = threshold(words, "c", COUNTED, 1)
    table = words.where(F.col("c") >= least).toArrow()  # at most COUNTED rows
    w, c = table.column("w").to_numpy().view(np.uint64), table.column("c").to_numpy()
    order = np.lexsort((w, -c))
    codes = np.zeros(len(w), np.int64)
    codes[order[:SYMBOLS]] = np.arange(1, min(SYMBOLS, len(w)) + 1)
    by_hash = np.argsort(w)
    w, c, codes = w[by_hash], c[by_hash], codes[by_hash]
    root = np.zeros(START + 1)
    root[codes[codes > 0]] = c[codes > 0]
    other = tokens - int(root.sum())
    root[OTHER] = other + 1
    once = words.where("c = 1").count() - int(((c == 1) & (codes > 0)).sum())
    return Model(tokens, types, w, c, codes, root / (tokens + 1), other, (once + 0.5) / (other + 1))


def encode(rows: DataFrame, shared, size: int) -> DataFrame:
    """Texts as symbol codes, staged: one row per chunk of documents, so that later passes read no text.

    Lists hold per document: id, whether held out, number of tokens, known tokens, base score and score within the class of
    other words, the latter three without words that were not broadcast. These are in ``words``, sorted, with their number;
    ``which`` has one number per token of the class of others: 0, or 1 + the place of its word in ``words``.
    """

    def codes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in sub_batches(batches, CHUNK_BYTES):
            n = batch.num_rows
            place, hashes = sequences(column(batch, "_text"))
            at, codes = coded(m, hashes)
            counted = at >= 0
            count = np.where(counted, m.counts[at], 0) if len(m.counts) else np.zeros(len(at), np.int64)
            plain = counted & (codes == OTHER)
            share = np.log10((1 - m.unseen) * count[plain] / max(m.other, 1))
            base = np.log10((count[counted] + 1) / size)
            known = place[counted]
            rest, which = np.unique(hashes[~counted], return_inverse=True)
            others = np.zeros(len(codes), np.uint32)
            others[~counted] = which + 1
            lists = [
                column(batch, "_id"),
                column(batch, "_held"),
                pa.array(np.bincount(place, minlength=n)),
                pa.array(np.bincount(known, minlength=n)),
                pa.array(np.bincount(known, weights=base, minlength=n).astype(float)),
                pa.array(np.bincount(place[plain], weights=share, minlength=n).astype(float)),
            ]
            arrays = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]
            arrays.append(pa.array([len(rest)]))
            planes = ([codes.astype(np.uint16)], [others[codes == OTHER]], [steps(rest)])
            arrays += [pa.array([packed(x)], pa.binary()) for x in planes]
            names = ["ids", "held", "tokens", "known", "base", "share", "n_words", "codes", "which", "words"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = T.StructType([T.StructField("ids", T.ArrayType(rows.schema["_id"].dataType)), T.StructField("held", T.ArrayType(T.BooleanType()))])
    for name in ("tokens", "known", "base", "share"):
        schema.add(name, T.ArrayType(T.DoubleType() if name in ("base", "share") else T.LongType()))
    schema.add("n_words", T.LongType())
    for name in ("codes", "which", "words"):
        schema.add(name, T.BinaryType())
    chunks = rows.select("_id", "_held", "_text").mapInArrow(codes_of, schema)
    return stage(chunks.withColumn("chunk", F.monotonically_increasing_id()), "suffix-codes")


def steps(values: np.ndarray) -> np.ndarray:
    """Differences of sorted numbers, which are short; ``np.cumsum`` gives the numbers back."""
    return np.diff(values, prepend=values.dtype.type(0))


def packed(columns: list[np.ndarray]) -> bytes:
    """Numbers byte by byte, all lowest bytes first, compressed."""
    planes = [np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T for x in columns]
    return pa.compress(b"".join(p.tobytes() for p in planes), "zstd", asbytes=True)


def unpacked(data: bytes, rows: int, dtypes: list[type]) -> list[np.ndarray]:
    sizes = [np.dtype(t).itemsize for t in dtypes]
    raw, out, start = pa.decompress(data, rows * sum(sizes), "zstd", asbytes=True), [], 0
    for size, t in zip(sizes, dtypes, strict=True):
        planes = np.frombuffer(raw, np.uint8, rows * size, start * rows).reshape(size, rows)
        out.append(np.ascontiguousarray(planes.T).view(t).ravel())
        start += size
    return out


def windows(tokens: np.ndarray, codes: np.ndarray, start: int) -> np.ndarray:
    """The four symbols before each token, the nearest in the highest bits; ``start`` stands before a text's first token."""
    ends = np.cumsum(tokens)
    at = np.arange(len(codes)) - np.repeat(ends - tokens, tokens)
    out = np.zeros(len(codes), np.uint64)
    for d in range(1, MOST_DEPTH + 1):
        before = np.full(len(codes), start, np.uint64)
        before[d:] = codes[:-d] if len(codes) > d else codes[:0]
        before[at < d] = start
        out |= before << np.uint64(64 - BITS * d)
    return out


def last(windows: np.ndarray, depth: int) -> np.ndarray:
    """The context of the ``depth`` nearest symbols."""
    return windows >> np.uint64(64 - BITS * depth)


def chunk_tokens(row: dict, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, window and code of every token of a chunk."""
    tokens = np.asarray(row["tokens"], np.int64)
    codes = unpacked(row["codes"], int(tokens.sum()), [np.uint16])[0]
    return np.repeat(np.arange(len(tokens)), tokens), windows(tokens, codes, start), codes


@dataclass
class Heavy:
    """Contexts of one length that occur more often than a bucket may hold: each has ``parts`` buckets from ``first`` on."""

    keys: np.ndarray
    first: np.ndarray
    parts: np.ndarray


@dataclass
class Plan:
    """Where windows are settled, and the rules of the tree. Buckets go by the nearest symbol, then by heavy contexts."""

    root: np.ndarray
    start: int
    light: np.ndarray  # bucket of each nearest symbol
    least_context: int
    least_count: int
    divergence: float
    buckets: int
    heavy: list[Heavy] = field(default_factory=list)

    def bucket(self, windows: np.ndarray) -> np.ndarray:
        out = self.light[last(windows, 1)]
        for depth, heavy in enumerate(self.heavy, 1):
            at = np.minimum(np.searchsorted(heavy.keys, last(windows, depth)), len(heavy.keys) - 1)
            hit = np.flatnonzero(heavy.keys[at] == last(windows, depth))
            own = at[hit]
            following = mixed(last(windows[hit], min(depth + 1, MOST_DEPTH)) & np.uint64((1 << BITS) - 1))
            out[hit] = heavy.first[own] + (following % heavy.parts[own].astype(np.uint64)).astype(np.int64)
        return out

    def known(self, bucket: int) -> int:
        """Length of the heavy context whose chances a bucket is given."""
        return max((d for d, h in enumerate(self.heavy, 1) if np.any((h.first <= bucket) & (bucket < h.first + h.parts))), default=0)

    def distinct(self, before: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First token and bucket of each distinct (window, code), by bucket, window and code, and its place per token."""
        bucket = self.bucket(before)
        order = np.lexsort((codes, before, bucket))
        b, w, c = bucket[order], before[order], codes[order]
        new = np.append(True, (w[1:] != w[:-1]) | (c[1:] != c[:-1]))[: len(order)]
        back = np.empty(len(order), np.int64)
        back[order] = np.cumsum(new) - 1
        return order[new], b[new], back

    def add_heavy(self, keys: np.ndarray, counts: np.ndarray) -> Heavy:
        order = np.argsort(keys)
        parts = -(-counts[order] // BUCKET)
        self.heavy.append(Heavy(keys[order], self.buckets + np.cumsum(parts) - parts, parts))
        self.buckets += int(parts.sum())
        return self.heavy[-1]


def settle(plan: Plan, before, codes, counts, p, known: int, most: int = MOST_DEPTH, states: list | None = None) -> np.ndarray:
    """Chance of each of the distinct (window, code), sorted by window, of whole contexts longer than ``known`` up to ``most``.

    ``p`` is the chance by the shorter contexts. States found are added to ``states`` as (depth, window, kept, types, codes,
    counts) of their moves.
    """
    p, live = p.copy(), np.arange(len(codes))
    for depth in range(known + 1, most + 1):
        # Contexts too rare for a state have only rarer ones below, so they end here.
        own = last(before[live], depth)
        context = np.cumsum(np.append(False, own[1:] != own[:-1])[: len(own)])
        moves, first, back = np.unique(context << BITS | codes[live], return_index=True, return_inverse=True)
        n = np.bincount(back, weights=counts[live], minlength=len(moves))
        of = context[first]
        size = int(of[-1]) + 1 if len(of) else 0
        parent = p[live[first]]
        seen = np.maximum(n, 1)
        total = np.bincount(of, weights=n, minlength=size)
        types = np.bincount(of, weights=n > 0, minlength=size)
        gain = np.bincount(of, weights=np.where(n > 0, n * (np.log(seen) - np.log(parent)), 0.0), minlength=size)
        key = own[np.flatnonzero(np.append(True, own[1:] != own[:-1])[: len(own)])]
        often = total >= plan.least_context
        if depth > 1:  # more than one start says no more than one
            often &= (key & np.uint64((1 << 2 * BITS) - 1)) != np.uint64(plan.start << BITS | plan.start)
        state = often & (gain / np.maximum(total, 1) - np.log(np.maximum(total, 1)) >= plan.divergence)
        kept = np.where(n >= plan.least_count, n, 0.0)
        sums = np.bincount(of, weights=kept, minlength=size)
        better = np.where(state[of], (kept + types[of] * parent) / np.maximum(sums + types, 1)[of], parent)
        p[live] = better[back]
        if states is not None:
            for s in np.flatnonzero(state):
                mine = np.flatnonzero((of == s) & (kept > 0))
                states.append((depth, int(key[s]), float(sums[s]), int(types[s]), codes[live][first[mine]].tolist(), kept[mine].tolist()))
        live = live[often[context]]
    return p


def windows_by_bucket(encoded: DataFrame, shared) -> DataFrame:
    """(bucket, chunk, rows, data): distinct windows with their codes and counts in the training part, packed."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        for row in (r for b in batches for i in range(b.num_rows) for r in b.slice(i, 1).to_pylist()):
            place, before, codes = chunk_tokens(row, plan.start)
            first, bucket, back = plan.distinct(before, codes)
            train = ~np.asarray(row["held"], bool)
            counts = np.bincount(back, weights=train[place], minlength=len(first)).astype(np.uint32)
            before, codes = before[first], codes[first]
            cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)]), len(bucket))
            data = []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                data.append(packed([steps(before[a:b]), codes[a:b], counts[a:b]]))
            arrays = [pa.array(bucket[cuts[:-1]]), pa.array([row["chunk"]] * len(data), pa.int64()), pa.array(np.diff(cuts))]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(data, pa.binary())], ["bucket", "chunk", "rows", "data"])

    columns = encoded.select("chunk", "held", "tokens", "codes")
    return columns.mapInArrow(pack, "bucket long, chunk long, rows long, data binary")


def bucket_windows(table: pa.Table) -> tuple[list[int], list[int], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Chunks, their numbers of rows, distinct sorted windows, codes and counts of a bucket, and each row's place in these."""
    chunks, sizes = table.column("chunk").to_pylist(), table.column("rows").to_pylist()
    parts = []
    for data, rows in zip(table.column("data"), sizes, strict=True):
        before, codes, counts = unpacked(data.as_buffer(), rows, [np.uint64, np.uint16, np.uint32])
        parts.append((np.cumsum(before, dtype=np.uint64), codes, counts))
    before, codes, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((codes, before))
    w, c = before[order], codes[order]
    new = np.append(True, (w[1:] != w[:-1]) | (c[1:] != c[:-1]))
    at = np.flatnonzero(new)
    back = np.empty(len(order), np.int32)
    back[order] = np.cumsum(new) - 1
    return chunks, sizes, w[at], c[at].astype(np.int64), np.add.reduceat(counts[order].astype(np.int64), at), back


def heavy_moves(encoded: DataFrame, shared, depth: int, shorter: DataFrame) -> DataFrame:
    """(context, codes, n, p): what follows the heavy contexts of ``depth`` symbols, how often and with which chance; staged."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        keys = plan.heavy[depth - 1].keys
        for row in (r for b in batches for i in range(b.num_rows) for r in b.slice(i, 1).to_pylist()):
            place, before, codes = chunk_tokens(row, plan.start)
            context = last(before, depth)
            at = np.minimum(np.searchsorted(keys, context), len(keys) - 1)
            hit = np.flatnonzero(keys[at] == context)
            train = ~np.asarray(row["held"], bool)
            moves, back = np.unique(at[hit] << BITS | codes[hit], return_inverse=True)
            n = np.bincount(back, weights=train[place[hit]], minlength=len(moves)).astype(np.uint32)
            own, codes = moves >> BITS, (moves & (1 << BITS) - 1).astype(np.uint16)
            present, first = np.unique(own, return_index=True)
            cuts = np.append(first, len(own))
            data = [packed([codes[a:b], n[a:b]]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            arrays = [pa.array(keys[present].view(np.int64)), pa.array(np.diff(cuts)), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["context", "rows", "data"])

    def merge(table: pa.Table) -> pa.Table:
        size = len(shared.value.root)  # a row per symbol at most
        n, seen = np.zeros(size, np.int64), np.zeros(size, bool)
        for data, rows in zip(table.column("data"), table.column("rows").to_pylist(), strict=True):
            codes, counts = unpacked(data.as_buffer(), rows, [np.uint16, np.uint32])
            n[codes] += counts
            seen[codes] = True
        codes = np.flatnonzero(seen)
        lists = [pa.array([codes.astype(np.int32)], pa.list_(pa.int32())), pa.array([n[codes]], pa.list_(pa.int64()))]
        return pa.Table.from_arrays([table.column("context").slice(0, 1), *lists], ["context", "codes", "n"])

    def level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        for batch in (b.slice(i, 1) for b in batches for i in range(b.num_rows)):
            codes, n, less, p = (column(batch, c).flatten().to_numpy() for c in ("codes", "n", "less", "parent"))
            parent = np.zeros(len(plan.root))
            parent[less] = p
            before = np.full(len(codes), column(batch, "context").to_numpy().view(np.uint64)[0] << np.uint64(64 - BITS * depth))
            p = settle(plan, before, codes.astype(np.int64), n, parent[codes], depth - 1, depth)
            lists = [column(batch, "codes"), column(batch, "n"), pa.array([p], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([column(batch, "context"), *lists], ["context", "codes", "n", "p"])

    columns = encoded.select("chunk", "held", "tokens", "codes")
    moves = columns.mapInArrow(count, "context long, rows long, data binary").groupBy("context")
    moves = moves.applyInArrow(merge, "context long, codes array<int>, n array<long>")
    less = shorter.select(F.col("context").alias("_context"), F.col("codes").alias("less"), F.col("p").alias("parent"))
    met = moves.join(less, F.expr(f"shiftrightunsigned(context, {BITS})") == F.col("_context")).drop("_context")
    return stage(met.mapInArrow(level, "context long, codes array<int>, n array<long>, p array<double>"), "suffix-heavy")


def make_plan(model: Model, starts: int, most: int | None) -> Plan:
    """Nearest symbols in buckets of about ``most`` tokens each, or one bucket."""
    counts = np.zeros(START + 1, np.int64)
    counts[model.codes] = model.counts
    counts[OTHER], counts[START] = model.other, starts
    counts[end_code(model)] = 0  # nothing follows an end
    light = (np.cumsum(np.where(counts > most, 0, counts)) // most if most else np.zeros(len(counts))).astype(np.int64)
    plan = Plan(model.root, START, light, LEAST_CONTEXT, LEAST_COUNT, DIVERGENCE, int(light[-1]) + 1)
    if most and (counts > most).any():
        heavy = np.flatnonzero(counts > most)
        plan.add_heavy(heavy.astype(np.uint64), counts[heavy])
    return plan


def end_code(model: Model) -> int:
    at = int(find(model.words, np.asarray([END], np.uint64))[0])
    return int(model.codes[at]) if at >= 0 else OTHER


def heavy_chances(encoded: DataFrame, plan: Plan, end: int) -> DataFrame | None:
    """(bucket, codes, p): chances of the codes by the heavy context of a bucket. Adds longer heavy contexts to the plan."""
    spark, out, depth = encoded.sparkSession, None, len(plan.heavy)
    root = [(0, list(range(len(plan.root))), plan.root.tolist())]  # of the empty context
    shorter = spark.createDataFrame(root, "context long, codes array<int>, p array<double>")
    while depth and depth <= MOST_DEPTH and len(plan.heavy) == depth:
        heavy = plan.heavy[-1]
        shorter = heavy_moves(encoded, spark.sparkContext.broadcast(plan), depth, shorter)
        # A bucket holds a part of one context, so it gets that context's row of chances.
        bounds = [(int(k), int(f), int(n)) for k, f, n in zip(heavy.keys.view(np.int64), heavy.first, heavy.parts, strict=True)]
        parts = spark.createDataFrame(bounds, "context long, first long, parts long")
        buckets = F.explode(F.expr("sequence(first, first + parts - 1)")).alias("bucket")
        rows = shorter.join(parts, "context").select(buckets, F.col("codes").alias("known"), "p")
        out = rows if out is None else out.unionAll(rows)
        if depth < MOST_DEPTH:
            # A longer context occurs as often as the move that ends in its last symbol: tokens / BUCKET rows at most.
            moves = shorter.select("context", F.inline(F.arrays_zip(F.col("codes").alias("code"), F.col("n").alias("n"))))
            longer = moves.where((F.col("n") > BUCKET) & (F.col("code") != end)).toArrow()
            if longer.num_rows:
                code = longer.column("code").to_numpy().astype(np.uint64)
                keys = code << np.uint64(BITS * depth) | longer.column("context").to_numpy().view(np.uint64)
                plan.add_heavy(keys, longer.column("n").to_numpy())
        depth += 1
    return out


def learn(train: DataFrame, words: DataFrame) -> Model:
    """The whole tree in hand, for ``chances``: of a corpus whose tree fits the driver. ``scores`` does not collect it."""
    share = train.sparkSession.sparkContext.broadcast
    model = alphabet(words)
    rows = train.select(F.lit(0).alias("_id"), F.lit(False).alias("_held"), "_text")
    encoded = encode(rows, share(model), model.tokens + model.types + 1)
    shared = share(make_plan(model, train.count(), None))

    def states(table: pa.Table) -> pa.Table:
        _, _, before, codes, counts, _ = bucket_windows(table)
        found: list[tuple] = []
        settle(shared.value, before, codes, counts, shared.value.root[codes], 0, states=found)
        names = ["depth", "context", "kept", "types", "codes", "counts"]
        types = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64())]
        found = [(d, int(np.uint64(k).view(np.int64)), *r) for d, k, *r in found]
        return pa.table({n: pa.array([f[i] for f in found], t) for i, (n, t) in enumerate(zip(names, types, strict=True))})

    schema = "depth long, context long, kept double, types long, codes array<long>, counts array<double>"
    found = windows_by_bucket(encoded, shared).groupBy("bucket").applyInArrow(states, schema).collect()
    for depth in range(1, MOST_DEPTH + 1):
        at: dict[int, tuple] = {}
        for r in (r for r in found if r.depth == depth):
            nearest_first = [r.context >> BITS * (depth - 1 - i) & (1 << BITS) - 1 for i in range(depth)]
            at[sum(s << BITS * i for i, s in enumerate(nearest_first))] = r
        contexts = np.asarray(sorted(at), np.uint64)
        kept, types = (np.asarray([getattr(at[int(k)], n) for k in contexts], float) for n in ("kept", "types"))
        pairs = [(k, s, c) for k in contexts for s, c in zip(at[int(k)].codes, at[int(k)].counts, strict=True)]
        moves = follow(np.asarray([x[0] for x in pairs], np.uint64), np.asarray([x[1] for x in pairs], np.uint64), depth)
        order = np.argsort(moves)
        model.levels.append(Level(contexts, kept, types, moves[order], np.asarray([x[2] for x in pairs], float)[order]))
    return model


def returned(bucket: int, chunks: list[int], sizes: list[int], *columns: list) -> pa.Table:
    numbers = [pa.array(x, pa.int64()) for x in (chunks, [bucket] * len(chunks), sizes)]
    numbers += [pa.array(x, t) for x, t in zip(columns, (pa.binary(), pa.int64(), pa.binary()), strict=True)]
    return pa.Table.from_arrays(numbers, ["chunk", "bucket", "rows", "data", "distinct", "chances"])


def rest_counts(encoded: DataFrame, words: DataFrame, types: int) -> DataFrame:
    """Counts of the words that were not broadcast, for each chunk, which join by ranges of hashes; buckets are below 0."""
    parts = types // WORDS + 1

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            own = np.cumsum(unpacked(row["words"], row["n_words"], [np.uint64])[0], dtype=np.uint64)
            part = (own >> np.uint64(40)) * np.uint64(parts) >> np.uint64(24)
            present, first = np.unique(part, return_index=True)
            cuts = np.append(first, len(own))
            data = [packed([steps(own[a:b])]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            numbers = [pa.array(present.astype(np.int64)), pa.array([row["chunk"]] * len(data), pa.int64()), pa.array(np.diff(cuts))]
            yield pa.RecordBatch.from_arrays([*numbers, pa.array(data, pa.binary())], ["part", "chunk", "rows", "data"])

    def meet(asked: pa.Table, known: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return returned(0, [], [], [], [], [])
        w, c = known.column("w").to_numpy().view(np.uint64), known.column("c").to_numpy().astype(np.uint64)
        order = np.argsort(w)
        w, c, data = w[order], np.append(c[order], np.uint64(0)), []
        rows = asked.column("rows").to_pylist()
        for packed_words, n in zip(asked.column("data"), rows, strict=True):
            own = np.cumsum(unpacked(packed_words.as_buffer(), n, [np.uint64])[0], dtype=np.uint64)
            data.append(packed([c[find(w, own)]]))
        bucket = asked.column("part")[0].as_py() - parts
        return returned(bucket, asked.column("chunk").to_pylist(), rows, data, [0] * len(rows), [None] * len(rows))

    asked = encoded.select("chunk", "n_words", "words").where("n_words > 0")
    asked = asked.mapInArrow(deal, "part long, chunk long, rows long, data binary")
    known = words.select(F.expr(f"shiftright(shiftrightunsigned(w, 40) * {parts}L, 24)").alias("part"), "w", "c")
    return asked.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(meet, RETURNED)


def score_rows(docs: DataFrame, words: DataFrame, model: Model, starts: int) -> DataFrame:
    """(_id, _held, n_tokens, n_known, base, score) per document row."""
    share = docs.sparkSession.sparkContext.broadcast
    size = model.tokens + model.types + 1
    encoded = encode(docs, share(model), size)
    plan = make_plan(model, starts, BUCKET)
    bases = heavy_chances(encoded, plan, end_code(model))
    shared, other, unseen = share(plan), model.other, model.unseen

    def chances_of(table: pa.Table) -> pa.Table:
        plan, is_base = shared.value, table.column("data").is_null().to_numpy()
        bucket, rows = table.column("bucket")[0].as_py(), table.filter(pa.array(~is_base))
        if not rows.num_rows:
            return returned(bucket, [], [], [], [], [])
        chunks, sizes, before, codes, counts, back = bucket_windows(rows)
        p = plan.root
        if is_base.any():
            base, p = table.filter(pa.array(is_base)), p.copy()
            known, chance = (base.column(c).combine_chunks().flatten().to_numpy() for c in ("known", "p"))
            p[known] = chance
        value = -np.log10(settle(plan, before, codes, counts, p[codes], plan.known(bucket)))
        value = np.rint(value * FRACTION).astype(np.uint64)
        cuts, data, distinct, chances = np.append(0, np.cumsum(sizes)), [], [], []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            own, at = np.unique(value[back[a:b]], return_inverse=True)
            data.append(packed([at.astype(np.uint32)]))
            distinct.append(len(own))
            chances.append(packed([steps(own)]))
        return returned(bucket, chunks, sizes, data, distinct, chances)

    def sum_up(chunk: pa.Table, values: pa.Table) -> pa.Table:
        plan, row = shared.value, chunk.select(["tokens", "codes", "which"]).to_pylist()[0]
        place, before, codes = chunk_tokens(row, plan.start)
        _, _, back = plan.distinct(before, codes)
        value, count = [], [np.zeros(1, np.uint64)]
        for r in sorted(values.to_pylist(), key=lambda r: r["bucket"]):
            if r["bucket"] < 0:  # parts of the words, in order
                count.append(unpacked(r["data"], r["rows"], [np.uint64])[0])
            else:
                chances = np.cumsum(unpacked(r["chances"], r["distinct"], [np.uint64])[0])
                value.append(chances[unpacked(r["data"], r["rows"], [np.uint32])[0]])
        value = np.concatenate(value).astype(float)[back] / -FRACTION
        known, base, share = (chunk.column(c).combine_chunks().flatten().to_numpy() for c in ("known", "base", "share"))
        n = len(known)

        others = np.flatnonzero(codes == OTHER)
        which = unpacked(row["which"], len(others), [np.uint32])[0]
        at, c = place[others[which > 0]], np.concatenate(count)[which[which > 0]].astype(float)
        within = np.log10(np.where(c > 0, (1 - unseen) * c / max(other, 1), unseen))
        known = known + np.bincount(at[c > 0], minlength=n)
        base = base + np.bincount(at, weights=np.log10((c + 1) / size), minlength=n)
        score = share + np.bincount(at, weights=within, minlength=n) + np.bincount(place, weights=value, minlength=n)
        lists = [chunk.column(c).combine_chunks().flatten() for c in ("ids", "held", "tokens")]
        return pa.Table.from_arrays([*lists, *map(pa.array, (known, base, score))], ["_id", "_held", "n_tokens", "n_known", "base", "score"])

    parts = windows_by_bucket(encoded, shared)
    parts = parts.withColumns({"known": F.lit(None).cast("array<int>"), "p": F.lit(None).cast("array<double>")})
    if bases is not None:
        parts = parts.unionByName(bases, allowMissingColumns=True)
    values = parts.groupBy("bucket").applyInArrow(chances_of, RETURNED).unionAll(rest_counts(encoded, words, model.types))
    schema = T.StructType([T.StructField("_id", docs.schema["_id"].dataType), T.StructField("_held", T.BooleanType())])
    schema.add("n_tokens", T.LongType()).add("n_known", T.LongType()).add("base", T.DoubleType()).add("score", T.DoubleType())
    own = encoded.select("chunk", "ids", "held", "tokens", "known", "base", "share", "codes", "which")
    return own.groupBy("chunk").cogroup(values.groupBy("chunk")).applyInArrow(sum_up, schema)


def scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row; held-out rows do not train."""
    rows = docs.select(docs[id_col].alias("_id"), held_out.alias("_held"), docs[text_col].alias("_text"))
    ship(docs.sparkSession)
    train = rows.where(~F.col("_held"))
    words = stage(count_words(train), "suffix-words")
    model = alphabet(words)
    return score_rows(rows, words, model, train.count()).select(
        F.col("_id").alias(id_col),
        F.col("_held").alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
    )
