"""Windows kept current over arriving rows, closed by a watermark, late rows set apart.

The watermark is the latest time that arrived in earlier batches less ``delay``. A batch adds its rows to
the open windows and writes those that the new watermark closes: no row that is still accepted can reach
them, so a closed window never changes. Rows behind the watermark, and rows without a time, change no
window and are written to the late feed. The state is the open windows; as with the summaries it has two
slots, so a replayed batch finds the state before it and replaces its own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.windows import Kind
from .jobs import _run, _write_batch
from .summaries import _state


def stream_windows(
    rows: DataFrame, kind: Kind, path: str, checkpoint: str, delay: int,
    available_now: bool = True, every: str = "1 minute",
) -> StreamingQuery:
    """Arriving rows (the kind's keys, at, value; others are passed to the late feed) to closed windows,
    open windows and late rows under ``path``."""

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        held = _state(spark, f"{path}/open", batch_id)
        mark = held.filter("mark").first() if held is not None else None
        before = mark["watermark"] if mark is not None else None
        batch = batch.persist()
        try:
            newest = batch.agg(F.max(F.col("at").cast("long")).alias("at")).first()["at"]
            known = [x for x in (before, None if newest is None else newest - delay) if x is not None]
            now = max(known, default=None)
            late = F.col("at").isNull()
            if before is not None:
                late = late | (F.col("at") < before)
            _write_batch(batch.filter(late), f"{path}/late", batch_id)
            parts = kind.parts(batch.filter(~late)).select(*kind.columns)
            if held is not None:
                parts = parts.unionByName(held.filter("not mark").select(*kind.columns))
            closed = F.lit(False) if now is None else kind.end() <= now
            merged = kind.merge(parts.repartition(*kind.by)).withColumn("closed", closed).persist()
            try:
                _write_batch(merged.filter("closed").drop("closed"), f"{path}/closed", batch_id)
                marks = merged.limit(0).drop("closed").unionByName(
                    spark.createDataFrame([(now,)], "watermark long"), allowMissingColumns=True
                )
                state = merged.filter("not closed").drop("closed").withColumns(
                    {"watermark": F.lit(None).cast("long"), "mark": F.lit(False)}
                ).unionByName(marks.withColumn("mark", F.lit(True)))
                state = state.withColumn("batch_id", F.lit(batch_id).cast("long"))
                state.write.mode("overwrite").parquet(f"{path}/open/slot={batch_id % 2}")
            finally:
                merged.unpersist()
        finally:
            batch.unpersist()

    return _run(rows, add, checkpoint, available_now, every)


def current_windows(spark: SparkSession, path: str, kind: Kind) -> DataFrame:
    """Closed and open windows; ``closed`` tells them apart."""
    held = _state(spark, f"{path}/open")
    if held is None:
        raise ValueError("nothing has arrived yet")
    done = spark.read.parquet(f"{path}/closed").select(*kind.columns, F.lit(True).alias("closed"))
    return done.unionByName(held.filter("not mark").select(*kind.columns, F.lit(False).alias("closed")))


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows that came too late, with the batch they came in."""
    return spark.read.parquet(f"{path}/late")
