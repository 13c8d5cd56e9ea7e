"""Replay of records through path states."""

from pyspark.sql import functions as F

from changeflow.operators import replay
from changeflow.queries.common import Log
from changeflow.queries.registry import query
from changeflow.session import scratch_path
from changeflow.streaming.keyed_replay import ROWS, closing_row, keyed_replay
from changeflow.streaming.replay_stream import flush_replay, replay_stream


def _records(spark, sf_dir):
    return Log(spark, sf_dir).replay_records


@query("SELECT change_id, part, path, change_action, allowed FROM t_replayed WHERE node_kind = 'file'")
def replay_allowed(spark, sf_dir):
    return replay.replay(_records(spark, sf_dir).where(F.col("node_kind") == "file").drop("node_kind"))


@query("""
    SELECT change_action, count(*) FILTER (allowed) AS allowed, count(*) FILTER (NOT allowed) AS denied
    FROM t_replayed WHERE node_kind = 'file' GROUP BY change_action
""")
def replay_summary(spark, sf_dir):
    return (
        replay_allowed(spark, sf_dir)
        .groupBy("change_action")
        .agg(F.count_if("allowed").alias("allowed"), F.count_if(~F.col("allowed")).alias("denied"))
    )


@query("SELECT change_id, part, path, change_action, allowed FROM t_replayed")
def replay_with_directories(spark, sf_dir):
    return replay.replay(_records(spark, sf_dir).drop("node_kind"))


@query("""
    SELECT path, CAST(coalesce(arg_max(ev, (change_id, part)) FILTER (ev IS NOT NULL), 0) AS INTEGER) AS status
    FROM (SELECT *, CASE WHEN change_action IN ('Add', 'Add Copy') THEN 1
                         WHEN change_action = 'Delete' THEN 0 END AS ev FROM t_nodes)
    GROUP BY path
""")
def replay_final_status(spark, sf_dir):
    return replay.final_status(_records(spark, sf_dir))


CARRIED_SQL = "CASE WHEN CAST(regexp_extract(path, '/u([0-9]+)/', 1) AS INTEGER) % 3 = 0 THEN 1 ELSE 0 END"


@query(f"""
    SELECT change_id, part, path, change_action,
      CASE WHEN change_action IN ('Add', 'Add Copy') THEN before = 0 ELSE before = 1 END AS allowed
    FROM (SELECT *, coalesce(last_value(CASE WHEN change_action IN ('Add', 'Add Copy') THEN 1
                                             WHEN change_action = 'Delete' THEN 0 END IGNORE NULLS)
            OVER (PARTITION BY path ORDER BY change_id, part
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), {CARRIED_SQL}) AS before
          FROM t_nodes WHERE node_kind = 'file')
""")
def replay_with_carried_state(spark, sf_dir):
    log = Log(spark, sf_dir)
    user = F.regexp_extract("path", "/u([0-9]+)/", 1).cast("int")
    previous = log.wanted_events.select(F.col("svn_path").alias("path")).distinct()
    previous = previous.withColumn("status", F.when(user % 3 == 0, 1).otherwise(0))
    records = log.replay_records.where(F.col("node_kind") == "file").drop("node_kind")
    return replay.replay(records, previous)


@query("SELECT change_id, part, path, change_action FROM t_replayed WHERE node_kind = 'dir' AND allowed")
def dir_replay_fast_path(spark, sf_dir):
    records = _records(spark, sf_dir)
    return replay.replay_dirs(records.where(F.col("node_kind") == "dir"))


@query("SELECT change_id, part, path, change_action, allowed FROM t_replayed WHERE node_kind = 'file'")
def streaming_replay(spark, sf_dir):
    records = _records(spark, sf_dir).where(F.col("node_kind") == "file").drop("node_kind")
    last = records.agg(F.max("change_id").alias("last")).first().last
    root = scratch_path(spark, "replay-stream")
    # The change at each boundary comes in two halves, its even parts one step later than its odd ones.
    edges = [last * step // 3 for step in range(1, 3)]
    late_half = F.col("change_id").isin(edges) & (F.col("part") % 2 == 0)
    place = F.col("change_id") + F.when(late_half, 1).otherwise(0)
    for step in range(3):
        low, high = last * step // 3, last * (step + 1) // 3
        arriving = records.where((place > low) & ((place <= high) | F.lit(step == 2)))
        arriving.write.mode("append").parquet(f"{root}/in")
        source = spark.readStream.schema(records.schema).parquet(f"{root}/in")
        replay_stream(source, f"{root}/state", f"{root}/out", f"{root}/checkpoint").awaitTermination()
    flush_replay(spark, records.schema, f"{root}/state", f"{root}/out", 2)
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/out")


@query("SELECT change_id, part, path, change_action, allowed FROM t_replayed WHERE node_kind = 'file'")
def keyed_streaming_replay(spark, sf_dir):
    """The same in keyed state with timers, stopped and started again between arrivals."""
    records = _records(spark, sf_dir).where(F.col("node_kind") == "file").drop("node_kind")
    last = records.agg(F.max("change_id").alias("last")).first().last
    root = scratch_path(spark, "keyed-replay")
    edge = last // 2
    place = F.col("change_id") + F.when((F.col("change_id") == edge) & (F.col("part") % 2 == 0), 1).otherwise(0)
    for arriving in (records.where(place <= edge), records.where(place > edge).unionByName(closing_row(spark, last + 1))):
        arriving.write.mode("append").parquet(f"{root}/in")
        source = spark.readStream.schema(records.schema).parquet(f"{root}/in")
        keyed_replay(source, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(f"{ROWS}, allowed boolean").parquet(f"{root}/out")
