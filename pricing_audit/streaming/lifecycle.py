"""Contract states kept current over rows that arrive in any order.

Rows wait until the watermark (the latest time that arrived less ``delay``) has passed them and are then
judged in the order of their times, so the log is that of the batch operator whatever the order of
arrival. The state holds waiting rows and pending contracts only. It has two slots, as the summaries
have, so a replayed batch replaces itself. Rows behind the watermark go to the late feed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.lifecycle import OPEN, ROWS, judge
from .jobs import _run, _write_batch
from .summaries import _state


def stream_lifecycle(
    rows: DataFrame, path: str, checkpoint: str, limit: int, delay: int,
    available_now: bool = True, every: str = "1 minute",
) -> StreamingQuery:
    """Arriving rows (contract_id, status, at, seq) to the log, the state and the late feed under ``path``."""

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        held = _state(spark, f"{path}/state", batch_id)
        mark = held.filter("mark").first() if held is not None else None
        before = mark["watermark"] if mark is not None else None
        batch = batch.select(*ROWS).withColumn("at", F.col("at").cast("long")).persist()
        try:
            newest = batch.agg(F.max("at").alias("at")).first()["at"]
            known = [x for x in (before, None if newest is None else newest - delay) if x is not None]
            now = max(known, default=None)
            late = F.col("at").isNull()
            if before is not None:
                late = late | (F.col("at") < before)
            _write_batch(batch.filter(late), f"{path}/late", batch_id)
            waiting = batch.filter(~late).withColumn("flagged", F.lit(None).cast("boolean"))
            if held is not None:
                waiting = waiting.unionByName(held.filter("not mark").select(*OPEN))
            ripe = F.lit(False) if now is None else F.col("at") < now
            log, pending = judge(waiting.filter(ripe).repartition("contract_id"), limit, now)
            _write_batch(log, f"{path}/log", batch_id)
            state = pending.unionByName(waiting.filter(~ripe)).withColumns(
                {"watermark": F.lit(None).cast("long"), "mark": F.lit(False)}
            )
            marks = state.limit(0).unionByName(
                spark.createDataFrame([(now, True)], "watermark long, mark boolean"), allowMissingColumns=True
            )
            state = state.unionByName(marks).withColumn("batch_id", F.lit(batch_id).cast("long"))
            state.write.mode("overwrite").parquet(f"{path}/state/slot={batch_id % 2}")
        finally:
            batch.unpersist()

    return _run(rows, add, checkpoint, available_now, every)


def current_log(spark: SparkSession, path: str) -> DataFrame:
    """What has happened up to the watermark."""
    return spark.read.parquet(f"{path}/log").drop("batch_id")
