"""Removal of long repeated byte strings with a sparse enhanced suffix array.

A repeat is a string of ``LENGTH`` bytes that starts at two places, in one text or two; it is removed. Repeats of ``SHORT``
bytes are found by the same steps. They are not removed: a passage of some 50 words is often shorter than ``LENGTH``, and
``passage_words`` counts the words of those that hold enough.

1. Anchors: of all ``GRAM``-byte strings in a window of ``SHORT`` bytes the one with the least hash is an anchor.
   The choice depends on the window's bytes alone, so every repeat holds the same anchor at all its places.
2. Anchors whose bytes occur at one place only are dropped: keys with two places are found by an aggregate and joined back.
3. The suffixes at the anchors that remain are sorted within their group of equal ``GRAM`` bytes, which gives a suffix
   array restricted to anchors, with the lengths of common prefixes. A scan with a stack lists its common-prefix
   intervals; within each interval the occurrences are sorted by what stands to their left. Occurrences whose left
   and right extensions reach the length together form a repeat group, with all of its occurrences, not just neighbours.
   An anchor needs no more than ``REACH`` bytes on either side, as longer repeats hold further anchors; its groups all cover
   its own bytes, so one stretch per anchor and length is written.
4. Per text the found stretches are merged and cut out.

Equal texts are one text with a number of copies: of ``LENGTH`` bytes or more, such a text is removed whole. Anchors with
equal surroundings are compared once. A group of more than ``BLOCK`` different surroundings is cut into blocks that meet
pairwise, so no task holds more than two blocks.

Texts are compared as UTF-8 bytes; null is empty. Repeated rows and ids are texts at their own places. Extra columns are not
read. ``GRAM`` bytes are taken as equal when their 64-bit hashes are, texts when 128 bits of hash and length are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.llm.common import column, ship, stage, sub_batches
from changeflow.llm.runs import blocked, whole_runs

LENGTH = 400
SHORT = 256
GRAM = 112
REACH = LENGTH - GRAM
SHORT_REACH = SHORT - GRAM
BLOCK = 4_096
AROUND = ["r1", "r2", "pos", "key", "around", "n_left", "n_right", "left", "right"]
COVER = ["before", "behind", "short_before", "short_behind"]
PIECE = 1 << 20  # bytes of one text handled at once
BASE = 0x9E3779B97F4A7C15 | 1

_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, 1 << 16)
        inverse = pow(BASE, -1, 1 << 64)
        ones = np.ones(size, np.uint64)
        for name, base in (("up", BASE), ("down", inverse)):
            steps = ones * np.uint64(base)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
        _powers["bytes"] = np.random.default_rng(11).integers(1, 1 << 63, 256, np.uint64)
    return _powers["up"], _powers["down"], _powers["bytes"]


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """Least (or largest) of every ``width`` values in a row, by doubling."""
    size = 1
    while size * 2 <= width:
        values = best(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return best(values[: len(values) - rest], values[rest:]) if rest else values


def anchor_places(data: np.ndarray) -> np.ndarray:
    """Starts of the anchors of one text's bytes."""
    found = []
    for start in range(0, max(len(data) - SHORT + 1, 0), PIECE):
        piece = data[start : start + PIECE + SHORT - 1]
        up, down, of_byte = _power_tables(len(piece))
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(of_byte[piece] * up[: len(piece)], out=sums[1:])
        grams = (sums[GRAM:] - sums[:-GRAM]) * down[: len(piece) - GRAM + 1]
        grams = (grams ^ (grams >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        grams ^= grams >> np.uint64(32)
        width = SHORT_REACH + 1
        least = _sliding(grams, width, np.minimum)
        around = np.zeros(len(least) + 2 * (width - 1), np.uint64)
        around[width - 1 : len(around) - width + 1] = least
        found.append(start + np.flatnonzero(grams == _sliding(around, width, np.maximum)))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _texts(batch: pa.RecordBatch, name: str = "_text") -> list[memoryview]:
    values = column(batch, name).cast(pa.large_binary())
    return [memoryview(v.as_buffer()) if v.is_valid else memoryview(b"") for v in values]


def anchors(texts: DataFrame) -> DataFrame:
    """(r1, r2, pos, key) of every anchor; ``key`` is a hash of its ``GRAM`` bytes."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches):
            r1, r2, places, keys, rows = column(batch, "r1"), column(batch, "r2"), [], [], []
            for i, text in enumerate(_texts(batch)):
                if len(text) >= SHORT:
                    own = anchor_places(np.frombuffer(text, np.uint8))
                    places.append(own)
                    rows.append(np.full(len(own), i))
                    keys += [xxhash.xxh3_64_intdigest(text[p : p + GRAM]) for p in own.tolist()]
            at = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64))
            place = np.concatenate(places) if places else np.zeros(0, np.int64)
            key = np.asarray(keys, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [r1.take(at), r2.take(at), pa.array(place.astype(np.int64)), pa.array(key)], ["r1", "r2", "pos", "key"]
            )

    return texts.select("r1", "r2", "_text").mapInArrow(find, "r1 long, r2 long, pos long, key long")


def repeated(found: DataFrame) -> DataFrame:
    """Anchors whose bytes start at two places or more."""
    place = F.xxhash64("r1", "r2", "pos")
    # Folded per task before the shuffle, and a join that Spark can split: a key with most of the rows is not one task.
    several = found.groupBy("key").agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low <> high")
    return found.join(several.select("key"), "key", "left_semi")


def surroundings(placed: DataFrame) -> DataFrame:
    """(r1, r2, pos, key, around, n_left, n_right, left, right): what stands around each anchor.

    ``around`` is a digest of it. The bytes, ``left`` read backwards, are given once per task for each digest.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[tuple[int, int]] = set()
        for batch in sub_batches(batches):
            out: list[list] = [[] for _ in range(9)]
            rows = zip(
                column(batch, "r1").to_pylist(), column(batch, "r2").to_pylist(), _texts(batch), column(batch, "own"), strict=True
            )
            for r1, r2, text, own in rows:
                for a in own.as_py():
                    p, key = a["pos"], a["key"]
                    low, high = max(p - REACH, 0), min(p + LENGTH, len(text))
                    n_left, n_right = p - low, high - p - GRAM
                    digest = xxhash.xxh3_64_intdigest(text[low:high], n_left) - (1 << 63)
                    left = right = None
                    if (key, digest) not in given:
                        given.add((key, digest))
                        left, right = bytes(text[low:p])[::-1], bytes(text[p + GRAM : high])
                    for values, v in zip(out, (r1, r2, p, key, digest, n_left, n_right, left, right), strict=True):
                        values.append(v)
            kinds = [pa.int64()] * 7 + [pa.binary()] * 2
            arrays = [pa.array(v, k) for v, k in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, AROUND)

    kinds = ["long"] * 7 + ["binary"] * 2
    return placed.mapInArrow(cut, ", ".join(f"{c} {k}" for c, k in zip(AROUND, kinds, strict=True)))


def _matrix(values: pa.ChunkedArray) -> np.ndarray:
    """Byte strings as rows of 16-bit numbers: each byte plus one, then zeros."""
    values = values.combine_chunks()
    if isinstance(values, pa.ChunkedArray):
        values = values.chunk(0)
    ends = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    size = np.diff(ends)
    out = np.zeros((len(values), REACH), ">u2")
    row = np.repeat(np.arange(len(values)), size)
    out[row, np.arange(len(data)) - np.repeat(ends[:-1] - ends[0], size)] = data.astype(np.uint16) + 1
    return out


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of rows of two such matrices."""
    differ = (a != b) | (a == 0)
    return np.where(differ.any(axis=1), differ.argmax(axis=1), REACH)


def _order(matrix: np.ndarray, within: np.ndarray | None = None) -> np.ndarray:
    text = np.ascontiguousarray(matrix).view(f"S{2 * REACH}").ravel()
    return np.argsort(text, kind="stable") if within is None else np.lexsort((text, within))


def intervals(common: list[int]) -> Iterator[tuple[int, int, int]]:
    """Common-prefix intervals (first, last, length) of a suffix array, inner ones first.

    ``common[i]`` is the length that suffixes i and i + 1 share.
    """
    stack: list[tuple[int, int]] = []
    for i, length in enumerate([*common, -1]):
        first = i
        while stack and stack[-1][1] > length:
            first, inner = stack.pop()
            yield first, i, inner
        if length >= 0 and (not stack or stack[-1][1] < length):
            stack.append((first, length))


class Least:
    """Least value of any stretch of an array, by tables of stretches of 1, 2, 4, ... values."""

    def __init__(self, values: np.ndarray):
        self.tables = [values]
        while len(self.tables[-1]) > (half := 1 << (len(self.tables) - 1)):
            last = self.tables[-1]
            self.tables.append(np.minimum(last[:-half], last[half:]))

    def of(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Least of ``values[low:high]`` for stretches of one value or more."""
        level = np.frexp(high - low)[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(self.tables[k][low[at]], self.tables[k][high[at] - (1 << k)])
        return out


def repeat_groups(left: np.ndarray, right: np.ndarray, bounds: np.ndarray):
    """Rows of every repeat group, how far each reaches left of its anchor, and how far right behind it.

    A group is the part of a common-prefix interval whose members each share ``SHORT`` bytes with another member.
    """
    run = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    edge = run[1:] != run[:-1]
    by_right, by_left = _order(right, run), _order(left, run)
    common = np.where(edge, -1, _common(right[by_right[:-1]], right[by_right[1:]]))
    shared = Least(np.where(edge, 0, _common(left[by_left[:-1]], left[by_left[1:]])))
    rank = np.empty(len(run), np.int64)
    rank[by_left] = np.arange(len(run))
    found = np.asarray([x for x in intervals(common.tolist()) if x[2] >= 0], np.int64).reshape(-1, 3)
    size = found[:, 1] - found[:, 0] + 1
    for part in np.array_split(np.arange(len(found)), int(size.sum()) // 500_000 + 1):
        total = size[part]
        node = np.repeat(np.arange(len(part)), total)
        place = np.arange(total.sum()) + np.repeat(found[part, 0] - (np.cumsum(total) - total), total)
        rows = by_right[place]
        # Members of each interval by what stands to their left; neighbours then share most.
        order = np.lexsort((rank[rows], node))
        rows, node = rows[order], node[order]
        near = np.zeros(len(rows) + 1, np.int64)
        inner = np.flatnonzero(node[1:] == node[:-1])
        near[inner + 1] = shared.of(rank[rows[inner]], rank[rows[inner + 1]])
        reach, length = np.maximum(near[:-1], near[1:]), found[part, 2][node]
        good = reach + length >= SHORT_REACH
        yield rows[good], reach[good], length[good]


def reaches(around: DataFrame) -> DataFrame:
    """(key, around, before, behind, short_before, short_behind): how far repeats cover the bytes around such anchors.

    All repeat groups of an anchor cover its own bytes, so together they cover one stretch. Without repeats of ``LENGTH``
    bytes ``before`` and ``behind`` are -1.
    """

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_runs(batches, ["key", "_i", "_j"]):
            key, digest = table.column("key").to_numpy(), table.column("around").to_numpy()
            # Several tasks may have given the same bytes; rows are sorted by digest within a run.
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (digest[1:] != digest[:-1])
            new[bounds[:-1]] = True
            table, bounds = table.filter(pa.array(new)), np.append(0, np.cumsum(np.add.reduceat(new, bounds[:-1])))
            far = [np.full(table.num_rows, -1) for _ in COVER]
            for rows, reach, length in repeat_groups(_matrix(table.column("left")), _matrix(table.column("right")), bounds):
                long = reach + length >= REACH
                for values, of, v in zip(far, (long, long, ..., ...), (reach, length, reach, length), strict=True):
                    np.maximum.at(values, rows[of], v[of])
            hit = far[2] >= 0
            arrays = [key[new][hit], digest[new][hit], *(values[hit] for values in far)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["key", "around", *COVER])

    sizes = around.groupBy("key").agg(F.count_distinct("around").alias("size")).where(F.col("size") > BLOCK)
    bytes_of = around.where(F.col("left").isNotNull()).select("key", "around", "left", "right")
    sized = bytes_of.join(sizes, "key", "left").withColumn("size", F.coalesce("size", F.lit(1)))
    place = ["key", "_i", "_j"]
    dealt = blocked(sized, "size", "around", BLOCK).repartition(*place).sortWithinPartitions(*place, "around")
    return dealt.mapInArrow(scan, "key long, around long, " + ", ".join(f"{c} long" for c in COVER))


def stretches(around: DataFrame) -> DataFrame:
    """(r1, r2, start, end, short_start, short_end): the stretches around each anchor that repeats cover.

    ``start`` and ``end`` are those of repeats of ``LENGTH`` bytes, null if there are none.
    """
    known = reaches(around).groupBy("key", "around").agg(*(F.max(c).alias(c) for c in COVER))
    # Places with equal surroundings repeat each other as far as these go.
    places = around.groupBy("key", "around").agg(
        F.count("*").alias("n"), F.first("n_left").alias("n_left"), F.first("n_right").alias("n_right")
    )
    size = F.col("n_left") + F.col("n_right")
    several, several_short = (F.col("n") > 1) & (size >= REACH), (F.col("n") > 1) & (size >= SHORT_REACH)
    long = F.col("before") >= 0
    covers = (
        places.join(known, ["key", "around"], "left")
        .where(several_short | F.col("short_before").isNotNull())
        .select(
            "key",
            "around",
            F.when(several, F.col("n_left")).when(long, F.col("before")).alias("before"),
            F.when(several, F.col("n_right")).when(long, F.col("behind")).alias("behind"),
            F.when(several_short, F.col("n_left")).otherwise(F.col("short_before")).alias("short_before"),
            F.when(several_short, F.col("n_right")).otherwise(F.col("short_behind")).alias("short_behind"),
        )
    )
    return around.select("r1", "r2", "pos", "key", "around").join(covers, ["key", "around"]).select(
        "r1",
        "r2",
        (F.col("pos") - F.col("before")).alias("start"),
        (F.col("pos") + GRAM + F.col("behind")).alias("end"),
        (F.col("pos") - F.col("short_before")).alias("short_start"),
        (F.col("pos") + GRAM + F.col("short_behind")).alias("short_end"),
    )


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(docs[text_col], F.lit(""))
    size = F.octet_length(text).cast("long")
    return docs.select(
        docs[id_col].alias("_id"),
        text.alias("_text"),
        F.xxhash64(text).alias("r1"),
        F.shiftleft(size, 32).bitwiseXOR(F.crc32(text.cast("binary"))).alias("r2"),
    )


def repeat_stretches(texts: DataFrame) -> DataFrame:
    """Covered stretches of distinct texts; see ``stretches``."""
    places = repeated(stage(anchors(texts), "repeat-anchors"))
    # A set: equal texts give the same anchors.
    lists = places.groupBy("r1", "r2").agg(F.collect_set(F.struct("pos", "key")).alias("own"))
    # One row of each text.
    least = W.partitionBy("r1", "r2").orderBy(F.col("_id").asc_nulls_first())
    one = texts.select("r1", "r2", "_id").withColumn("k", F.row_number().over(least)).where("k = 1")
    lists = lists.join(one.select(F.col("r1"), F.col("r2"), F.col("_id").alias("_one")), ["r1", "r2"])
    on = (texts["r1"] == lists["r1"]) & (texts["r2"] == lists["r2"]) & texts["_id"].eqNullSafe(lists["_one"])
    placed = texts.join(lists, on).select(texts["r1"], texts["r2"], "_text", "own")
    return stretches(stage(surroundings(placed), "repeat-surroundings"))


def cut_out(text: memoryview, spans: list, whole: bool) -> tuple[bytes, int, int]:
    """Bytes that stay, bytes removed, runs removed."""
    n = len(text)
    if whole:
        return b"", n, 1
    kept, at, removed, runs, end = [], 0, 0, 0, -1
    for span in sorted((s["start"], s["end"]) for s in spans):
        if span[0] > end:
            runs += 1
        start = max(span[0], at)
        if span[1] > start:
            kept.append(text[at:start])
            removed += span[1] - start
            at = span[1]
        end = max(end, span[1])
    kept.append(text[at:])
    return b"".join(kept), removed, runs


def passage_size(text: memoryview, spans: list, whole: bool, least: int) -> int:
    """Words of a text in runs of covered bytes that hold ``least`` whole words or more."""
    runs: list[list[int]] = []
    for start, end in [(0, len(text))] if whole else sorted((s["start"], s["end"]) for s in spans):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end])
    total = 0
    for start, end in runs:
        n = len(bytes(text[start:end]).split())
        # Words that the run's ends cut.
        n -= sum(len(bytes(text[max(p - 1, 0) : p + 1]).strip()) == 2 for p in (start, end))
        total += n if n >= least else 0
    return total


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts_too: bool = False, passage_words: int | None = None
) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) per row; with ``texts_too`` also the kept bytes as ``kept``.

    With ``passage_words`` a last column ``n_passage_words`` counts the words ``[^\\x20\\x09-\\x0D]+`` in passages: runs of
    bytes covered by strings of ``SHORT`` bytes that also start elsewhere, which hold so many whole words or more.
    """
    ship(docs.sparkSession)
    texts = keyed(docs, id_col, text_col)
    long, short = F.struct("start", "end"), F.struct(F.col("short_start").alias("start"), F.col("short_end").alias("end"))
    spans = repeat_stretches(texts).groupBy("r1", "r2").agg(
        F.collect_set(F.when(F.col("start").isNotNull(), long)).alias("spans"), F.collect_set(short).alias("passages")
    )
    copies = texts.groupBy("r1", "r2").agg(F.count("*").alias("copies"))
    found = stage(
        copies.join(spans, ["r1", "r2"], "left").where("copies > 1 or spans is not null").select(
            F.col("r1").alias("_r1"), F.col("r2").alias("_r2"), "copies", "spans", "passages"
        ),
        "repeat-spans",
    )
    joined = texts.join(found, (F.col("r1") == F.col("_r1")) & (F.col("r2") == F.col("_r2")), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches):
            out = []
            rows = zip(
                _texts(batch), column(batch, "copies").to_pylist(), column(batch, "spans"), column(batch, "passages"), strict=True
            )
            for text, times, own, passages in rows:
                again = (times or 0) > 1
                kept, removed, runs = cut_out(text, own.as_py() or [], again and len(text) >= LENGTH)
                values = [len(text), removed, runs, hashlib.sha256(kept).hexdigest()]
                values += [kept] if texts_too else []
                if passage_words is not None:
                    values.append(passage_size(text, passages.as_py() or [], again and len(text) >= SHORT, passage_words))
                out.append(values)
            columns = zip(*out, strict=True)
            arrays = [column(batch, "_id"), *(pa.array(c, k) for c, k in zip(columns, arrow, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, [f.name for f in schema.fields])

    kinds = [("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType()), ("kept_sha256", T.StringType())]
    kinds += [("kept", T.BinaryType())] if texts_too else []
    kinds += [("n_passage_words", T.LongType())] if passage_words is not None else []
    arrow = [{"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[k.simpleString()] for _, k in kinds]
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *(T.StructField(*k) for k in kinds)])
    return joined.select("_id", "_text", "copies", "spans", "passages").mapInArrow(cut, schema)
