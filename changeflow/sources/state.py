"""State carried between runs: keyed tables in layers, newest layer first in authority.

A run adds one layer of its own rows to each table, in a new folder, and names all layers in its row of ``run_meta``.
Readers follow ``run_meta``, so a run that dies half-way leaves nothing a later run would see, and earlier runs stay
readable as they were.

Layers are folded by size: while the newest layer has at most ``FOLD`` times the rows of the new one, both become one.
So a table has a number of layers that grows with the logarithm of its rows, every row is rewritten that many times at
most, and what a run writes follows its own rows. Large layers are dealt to folders by a hash of the key, and a look-up
of few keys reads only their folders.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from changeflow import schema

TABLES = {
    "dir_usage": schema.DIR_USAGE,
    "empty_dirs": schema.EMPTY_DIRS,
    "path_status": schema.PATH_STATUS,
    "revision_map": schema.REVISION_MAP,
    "fingerprints": schema.FINGERPRINTS,
}
KEYS = {
    "dir_usage": ["path"],
    "empty_dirs": ["path"],
    "path_status": ["path"],
    "revision_map": ["change_id"],
    "fingerprints": ["depot_path", "rev"],
}
FOLD = 2
ROWS_PER_BUCKET = 1 << 20
MOST_BUCKETS = 1_024


@dataclass(frozen=True)
class Layer:
    """Rows of one folder below the state's root, unique by key; ``buckets`` is 0 when they are not dealt by key."""

    folder: str
    rows: int
    buckets: int = 0


@dataclass(frozen=True)
class State:
    """Tables as a run left them. The properties are whole tables; ``lookup`` reads what some keys need."""

    spark: SparkSession
    root: str
    run_id: str | None = None
    last_change_id: int = 0
    last_revision: int = 0
    layers: dict[str, tuple[Layer, ...]] = field(default_factory=dict)

    dir_usage = property(lambda self: self.table("dir_usage"))
    empty_dirs = property(lambda self: self.table("empty_dirs"))
    path_status = property(lambda self: self.table("path_status"))
    revision_map = property(lambda self: self.table("revision_map"))
    fingerprints = property(lambda self: self.table("fingerprints"))

    def table(self, name: str) -> DataFrame:
        frames = [_read_layer(self, name, layer) for layer in self.layers.get(name, ())]
        return latest(self.spark, name, frames)

    def lookup(self, name: str, keys: DataFrame, newer: DataFrame | None = None) -> DataFrame:
        """Rows of the keys in ``keys``; those of ``newer``, if given, go before all layers."""
        keys = keys.select(*KEYS[name]).distinct()
        frames = [_read_layer(self, name, layer, keys) for layer in self.layers.get(name, ())]
        if newer is not None:
            frames.append(newer.select(*TABLES[name].fieldNames()))
        return latest(self.spark, name, [f.join(keys, KEYS[name], "left_semi") for f in frames])


def empty_state(spark: SparkSession, root: str = "") -> State:
    return State(spark, root)


def latest(spark: SparkSession, name: str, frames: list[DataFrame]) -> DataFrame:
    """One row per key out of frames that are unique by key: the last frame that has it counts."""
    if len(frames) < 2:
        return frames[0] if frames else spark.createDataFrame([], TABLES[name])
    keys = KEYS[name]
    values = [c for c in TABLES[name].fieldNames() if c not in keys]
    rows = None
    for age, frame in enumerate(frames):
        aged = frame.select(*keys, F.struct(*values).alias("_values"), F.lit(age).alias("_age"))
        rows = aged if rows is None else rows.unionByName(aged)
    return rows.groupBy(*keys).agg(F.max_by("_values", "_age").alias("_values")).select(*keys, "_values.*")


def _bucket(name: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*KEYS[name]), F.lit(buckets)).cast("int").alias("_bucket")


def _read_layer(state: State, name: str, layer: Layer, keys: DataFrame | None = None) -> DataFrame:
    path = f"{state.root}/{layer.folder}"
    if not layer.buckets:
        return read_or_empty(state.spark, path, TABLES[name])
    with_bucket = StructType([*TABLES[name].fields, StructField("_bucket", IntegerType())])
    rows = state.spark.read.schema(with_bucket).parquet(path)
    if keys is not None:
        # At most MOST_BUCKETS numbers; they become a filter on folders.
        found = [r._bucket for r in keys.select(_bucket(name, layer.buckets)).distinct().collect()]
        rows = rows.where(F.col("_bucket").isin(found))
    return rows.drop("_bucket")


def _write_layer(state: State, run_id: str, name: str, df: DataFrame, about: int) -> Layer:
    """Write rows to a new folder; ``about`` is how many are expected."""
    folder = f"state/{name}/{run_id}-{uuid.uuid4().hex[:12]}"
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[name].fields]
    rows, buckets = df.select(columns), 0
    if about > ROWS_PER_BUCKET:
        buckets = min(MOST_BUCKETS, -(-about // ROWS_PER_BUCKET))
        rows = rows.withColumn("_bucket", _bucket(name, buckets)).repartition("_bucket")
    writer = rows.write.mode("overwrite")
    (writer.partitionBy("_bucket") if buckets else writer).parquet(f"{state.root}/{folder}")
    # Counts come from the files' footers.
    stored = state.spark.read.schema(TABLES[name]).parquet(f"{state.root}/{folder}").count()
    return Layer(folder, stored, buckets)


def add_layer(state: State, run_id: str, name: str, df: DataFrame) -> tuple[Layer, ...]:
    """Layers of a table after this run's rows (unique by key), which replace earlier ones of equal key."""
    layers = list(state.layers.get(name, ()))
    new = _write_layer(state, run_id, name, df, 0)
    if layers and not new.rows:
        return tuple(layers)
    folded, rows = [new], new.rows
    while layers and layers[-1].rows <= FOLD * rows:
        folded.insert(0, layers.pop())
        rows += folded[0].rows
    if len(folded) > 1 or rows > ROWS_PER_BUCKET:
        frames = [_read_layer(state, name, layer) for layer in folded]
        new = _write_layer(state, run_id, name, latest(state.spark, name, frames), rows)
    return (*layers, new)


def read_or_empty(spark: SparkSession, path: str, table_schema) -> DataFrame:
    try:
        return spark.read.schema(table_schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], table_schema)


def load_run_meta(spark: SparkSession, root: str) -> DataFrame:
    return read_or_empty(spark, f"{root.rstrip('/')}/run_meta", schema.RUN_META)


def load_state(spark: SparkSession, root: str, run_id: str | None = None) -> State:
    """State of the newest (or the named) run; empty if there is none yet."""
    root = root.rstrip("/")
    meta = load_run_meta(spark, root)
    if run_id is not None:
        meta = meta.where(F.col("run_id") == run_id)
    newest = meta.orderBy(F.desc("last_change_id"), F.desc("last_revision"), F.desc("run_id")).first()
    if newest is None:
        if run_id is not None:
            raise ValueError(f"no run {run_id!r} under {root}")
        return empty_state(spark, root)
    if newest.layers is None:
        # A run that kept whole tables in its own folder.
        found = {name: [(f"{newest.run_id}/{name}", 1 << 62, 0)] for name in TABLES}
    else:
        found = newest.layers
    layers = {name: tuple(Layer(*layer) for layer in own) for name, own in found.items()}
    return State(spark, root, newest.run_id, newest.last_change_id, newest.last_revision, layers)


def write_table(df: DataFrame, path: str, table_schema) -> DataFrame:
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in table_schema.fields]
    df.select(columns).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(table_schema).parquet(path)


def save_table(root: str, run_id: str, name: str, df: DataFrame) -> DataFrame:
    return write_table(df, f"{root.rstrip('/')}/{run_id}/{name}", TABLES[name])


def save_run_meta(
    spark: SparkSession,
    root: str,
    run_id: str,
    last_change_id: int,
    last_revision: int,
    layers: dict[str, tuple[Layer, ...]] | None = None,
) -> None:
    if layers is not None:
        layers = {name: [(x.folder, x.rows, x.buckets) for x in own] for name, own in layers.items()}
    row = spark.createDataFrame([(run_id, last_change_id, last_revision, layers)], schema.RUN_META)
    row.coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/run_meta")


def merge_latest(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """Union of two keyed tables in which the newer value of a key wins."""
    runs = old.select(key, value, F.lit(0).alias("_run")).unionByName(
        new.select(key, value, F.lit(1).alias("_run"))
    )
    return runs.groupBy(key).agg(F.max_by(value, "_run").alias(value))
