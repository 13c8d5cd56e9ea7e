"""Best-fit packing with a swap-based local search.

1. Documents become token ids, closed by an end id, and pieces: longer ones are cut from their end into pieces of the
   capacity, so only the first piece may be shorter.
2. Pieces are dealt by hash to groups of about ``GROUP`` pieces. In a task each group is packed best-fit, longest piece
   first. Then a local search takes the emptiest bin and gives its load away: a piece moves to a bin with room for it, or
   is exchanged for a smaller one, for two smaller ones, or with a second piece of its bin for one. Each exchange fills a
   fuller bin and so raises the sum of squared fills; a bin left empty is saved. It ends when the group needs no more
   bins than its tokens do, or no exchange is left.
3. The emptiest bins of each group, which hold most of its waste, are opened again, and their pieces are dealt to fewer
   groups with those of other groups, until one group is left or a round saves nothing. So groups cost no bins of their own.

Only narrow rows move (no ids), each round is a stored table, and groups are packed in a fixed order, so a lost executor
repeats its tasks with equal results.

A null text is an empty document: its end id alone. Empty tables give no rows. Repeated rows are pieces of their own.
Null ids stay null. Columns other than id and text are not read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.llm import tokenizing
from changeflow.llm.byte_pieces import ByteLevel, sums_between
from changeflow.llm.common import column, ship, stage, sub_batches
from changeflow.llm.runs import whole_runs
from changeflow.llm.token_counts import check_kind

GROUP = 50_000
# The emptiest bins that hold this share of a group's waste are packed again with those of other groups.
OPENED = 0.9
# The search looks at this many bins of equal room at a time, and ends after so many bins in a row that could not be emptied.
TARGETS = 8
PATIENCE = 256
BATCH_BYTES = 3 << 20

_coders: dict[int, ByteLevel] = {}


def piece_table(
    docs: DataFrame, tokenizer_file: str, capacity: int, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, key, piece, start, length, ids_crc32, ids) of every document; ``key`` tells repeated ids apart."""
    json_text = tokenizing.read_text(tokenizer_file)
    check_kind(json.loads(json_text))
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(json_text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = hash(shared.value)
        if code not in _coders:
            _coders[code] = ByteLevel(shared.value)
        for batch in sub_batches(batches, BATCH_BYTES):
            ids, counts = _coders[code](column(batch, "_text"))
            ids = np.insert(ids, np.cumsum(counts), end_id).astype(np.int32)
            counts = counts + 1
            pieces = -(-counts // capacity)
            row = np.repeat(np.arange(len(counts)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            first = counts - (pieces - 1) * capacity
            start = np.where(piece > 0, first[row] + (piece - 1) * capacity, 0)
            length = np.where(piece > 0, capacity, first[row])
            ends = np.append(0, np.cumsum(length))
            raw = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[a:b]) for a, b in zip((ends[:-1] * 4).tolist(), (ends[1:] * 4).tolist(), strict=True)]
            rows = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "id").take(rows),
                    column(batch, "key").take(rows),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start),
                    pa.array(length),
                    pa.array(crc, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)),
                ],
                [id_col, "key", "piece", "start", "length", "ids_crc32", "ids"],
            )

    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("key", T.LongType()),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
        ]
    )
    named = docs.select(docs[id_col].alias("id"), docs[text_col].alias("_text"))
    return named.withColumn("key", F.monotonically_increasing_id()).mapInArrow(cut, schema)


class Bins:
    """Bins of one group: their pieces, and which free lengths they have.

    Sets of lengths are integers with one bit per length, so the nearest fitting length is one shift away.
    """

    def __init__(self, lengths: list[int], capacity: int):
        self.capacity, self.lengths = capacity, lengths
        self.items: list[list[int]] = []
        self.free: list[int] = []
        self.by_free: list[set[int]] = [set() for _ in range(capacity + 1)]
        self.frees = 0

    def _file(self, b: int, free: int) -> None:
        self.free[b] = free
        self.by_free[free].add(b)
        self.frees |= 1 << free

    def _unfile(self, b: int) -> None:
        free = self.free[b]
        self.by_free[free].discard(b)
        if not self.by_free[free]:
            self.frees &= ~(1 << free)

    def change(self, b: int, out: tuple[int, ...] = (), new: tuple[int, ...] = ()) -> None:
        """Take the pieces ``out`` from a bin and put ``new`` in."""
        self._unfile(b)
        for piece in out:
            self.items[b].remove(piece)
        self.items[b] += new
        gone, come = sum(self.lengths[p] for p in out), sum(self.lengths[p] for p in new)
        self._file(b, self.free[b] + gone - come)

    def best_fit(self) -> None:
        """Pieces from long to short, each into the bin that it fills best, or a new one."""
        for piece in sorted(range(len(self.lengths)), key=lambda p: (-self.lengths[p], p)):
            length = self.lengths[piece]
            fitting = self.frees >> length
            if fitting:
                free = length + (fitting & -fitting).bit_length() - 1
                self.change(next(iter(self.by_free[free])), new=(piece,))
            else:
                self.items.append([piece])
                self.free.append(0)
                self._file(len(self.items) - 1, self.capacity - length)

    def least(self) -> int:
        return -(-sum(self.lengths) // self.capacity)

    def search(self) -> None:
        """Empty bins, emptiest first, while more are in use than the tokens need."""
        used, least, tried, failed = len(self.items), self.least(), set(), 0
        while used > least and failed < PATIENCE:
            source = self._emptiest(tried)
            if source is None:
                return
            while self.items[source]:
                if not self._give(source):
                    tried.add(source)
                    failed += 1
                    break
            else:
                used, failed = used - 1, 0
                self._unfile(source)

    def _emptiest(self, tried: set[int]) -> int | None:
        frees = self.frees & -2
        while frees:
            free = frees.bit_length() - 1
            frees ^= 1 << free
            left = self.by_free[free] - tried
            if left:
                return min(left)
        return None

    def _targets(self, source: int) -> Iterator[tuple[int, int]]:
        """Bins with room, but fuller than the source: those with most room first, a few of each."""
        frees = self.frees & ((1 << self.free[source] + 1) - 2)
        while frees:
            free = frees.bit_length() - 1
            frees ^= 1 << free
            for b in islice((b for b in self.by_free[free] if b != source), TARGETS):
                yield b, free

    def _give(self, source: int) -> bool:
        """The exchange that takes most from ``source``: one bin at least as full gains it."""
        lengths, own = self.lengths, self.items[source]
        best, plan = 0, None
        pairs = [(p, q) for i, p in enumerate(own) for q in own[i + 1 :]]
        most = max(lengths[p] for p in own) if own else 0
        for target, room in self._targets(source):
            if best >= room:
                break  # no later target has more room
            if most <= room:
                fits = max((p for p in own if lengths[p] <= room), key=lambda p: lengths[p])
                if lengths[fits] > best:
                    best, plan = lengths[fits], (target, (fits,), ())
            theirs = self.items[target]
            for p in own:  # one for one
                for q in theirs:
                    gain = lengths[p] - lengths[q]
                    if best < gain <= room:
                        best, plan = gain, (target, (p,), (q,))
            for p, q in pairs:  # two for one
                both = lengths[p] + lengths[q]
                if best < both <= room:
                    best, plan = both, (target, (p, q), ())
                for r in theirs:
                    gain = both - lengths[r]
                    if best < gain <= room:
                        best, plan = gain, (target, (p, q), (r,))
            for p in own:  # one for two
                if lengths[p] <= best:
                    continue
                for i, q in enumerate(theirs):
                    for r in theirs[i + 1 :]:
                        gain = lengths[p] - lengths[q] - lengths[r]
                        if best < gain <= room:
                            best, plan = gain, (target, (p,), (q, r))
        if plan is None:
            return False
        target, out, back = plan
        self.change(source, out, back)
        self.change(target, back, out)
        return True

    def opened(self, share: float) -> set[int]:
        """The emptiest bins that together hold ``share`` of the free room."""
        order = sorted((b for b, own in enumerate(self.items) if own and self.free[b]), key=lambda b: (-self.free[b], b))
        wanted, out = share * sum(self.free[b] for b in order), set()
        for b in order:
            if wanted <= 0:
                break
            out.add(b)
            wanted -= self.free[b]
        return out


def pack_group(lengths: list[int], capacity: int) -> Bins:
    bins = Bins(lengths, capacity)
    bins.best_fit()
    bins.search()
    return bins


def _pack_round(pool: DataFrame, capacity: int, round_no: int, groups: int, last: bool) -> DataFrame:
    """Rows of ``pool`` with their bin, the place in it, and whether the bin is opened again."""
    share = 0.0 if last else OPENED

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_runs(batches, ["_group"]):
            for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                rows = table.slice(low, high - low)
                bins = pack_group(rows.column("length").to_pylist(), capacity)
                opened = bins.opened(share)
                n = high - low
                bin_of, offset, again = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
                for b, own in enumerate(bins.items):
                    place = 0
                    for piece in own:
                        bin_of[piece], offset[piece], again[piece] = b, place, b in opened
                        place += bins.lengths[piece]
                group = rows.column("_group").to_numpy()
                # Round, group and bin take 6, 36 and 21 bits; a group has fewer bins than pieces.
                sequence = (round_no << 57) + (group << 21) + bin_of
                rows = rows.drop_columns(["_group"]).combine_chunks()
                for name, values in (("sequence_id", sequence), ("offset", offset), ("_again", again)):
                    rows = rows.append_column(name, pa.array(values))
                yield from rows.to_batches()

    fields = [*pool.schema.fields, *(T.StructField(c, T.LongType()) for c in ("sequence_id", "offset"))]
    schema = T.StructType([*fields, T.StructField("_again", T.BooleanType())])
    order = [F.desc("length"), "_mix", "key", "piece"]
    mixed = F.xxhash64("key", "piece", F.lit(round_no))
    dealt = pool.withColumn("_mix", mixed).withColumn("_group", F.pmod(F.shiftright("_mix", 8), F.lit(groups)))
    dealt = dealt.repartition(max(1, min(groups, 4_096)), "_group").sortWithinPartitions("_group", *order)
    return dealt.drop("_mix").mapInArrow(pack, schema)


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """Rows of ``pieces`` (key, piece, length, and others) with ``sequence_id`` and the ``offset`` there, gapless from 0."""
    ship(pieces.sparkSession)
    pool = pieces.withColumn("length", F.col("length").cast("long"))
    done, before, round_no = None, None, 0
    while True:
        n, tokens = pool.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
        groups = max(1, -(-n // GROUP))
        # A round that closes less than a fifth of its tokens will not gain much by another one.
        last = groups == 1 or before is not None and tokens > 0.8 * before
        packed = stage(_pack_round(pool, capacity, round_no, groups, last), "packed-pieces")
        kept = (packed if last else packed.where("not _again")).drop("_again")
        done = kept if done is None else done.unionByName(kept)
        if last:
            return done
        pool = packed.where("_again").drop("sequence_id", "offset", "_again")
        before, round_no = tokens, round_no + 1


def sequences(pieces: DataFrame, packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed training sequences; a sequence has at most ``capacity`` ids."""
    placed = packed.select("key", "piece", "sequence_id", "offset").join(pieces.select("key", "piece", "ids"), ["key", "piece"])
    rows = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return rows.select("sequence_id", F.flatten("parts.ids").alias("ids"))
