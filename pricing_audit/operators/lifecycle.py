"""Contract states with deadlines: legal changes, rejected ones, and contracts that became overdue.

A contract is pending or not. PENDING opens one that is not; any other status is an outcome and closes one
that is. Everything else is illegal and changes nothing. So after any row, legal or not, a contract is
pending just if the row says PENDING, and whether a row is legal shows from the one before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PENDING, OVERDUE = "PENDING", "OVERDUE"
CHANGE, REJECTED = "CHANGE", "REJECTED"
ROWS = ("contract_id", "status", "at", "seq")
OPEN = (*ROWS, "flagged")


def judge(rows: DataFrame, limit: int, now: int | None) -> tuple[DataFrame, DataFrame]:
    """The log (contract_id, at, status, seq, kind) of what happens before ``now`` and the contracts
    pending then (``OPEN`` columns).

    ``rows`` has ``ROWS``, all before ``now``, and ``flagged``: null for new rows, and for pending
    contracts of an earlier call whether they are known as overdue; these are not logged again. A contract
    pending for more than ``limit`` gets an OVERDUE row at its deadline, which a later outcome corrects; an
    outcome at the deadline is in time. Rows of one time count by seq, then status. Without ``now`` time
    has no end and every pending contract becomes overdue. Null statuses are outcomes; null times are the
    caller's to remove. Null ids are one contract.
    """
    order = Window.partitionBy("contract_id").orderBy("at", "seq", "status")
    opens = F.coalesce(F.col("status") == PENDING, F.lit(False))
    judged = rows.select(*OPEN, opens.alias("opens")).withColumn(
        "legal", F.col("opens") != F.coalesce(F.lag("opens").over(order), F.lit(False))
    )
    legal = judged.filter("legal").withColumn("next", F.lead("at").over(order))
    deadline = F.col("at") + limit
    passed = F.lit(True) if now is None else deadline < now
    overdue = F.col("opens") & passed & (F.col("next").isNull() | (F.col("next") > deadline))
    fresh = F.col("flagged").isNull()
    kinds = F.array_compact(F.array(
        F.when(fresh, F.struct("at", "status", F.lit(CHANGE).alias("kind"))),
        F.when(
            overdue & ~F.coalesce("flagged", F.lit(False)),
            F.struct(deadline.alias("at"), F.lit(OVERDUE).alias("status"), F.lit(OVERDUE).alias("kind")),
        ),
    ))
    happened = legal.select("contract_id", "seq", F.explode(kinds).alias("x")).select(
        "contract_id", "x.at", "x.status", "seq", "x.kind"
    )
    rejected = judged.filter("not legal").select("contract_id", "at", "status", "seq", F.lit(REJECTED).alias("kind"))
    pending = legal.filter("opens and next is null").select(
        *ROWS, (overdue | F.coalesce("flagged", F.lit(False))).alias("flagged")
    )
    return happened.unionByName(rejected), pending


def lifecycle_log(rows: DataFrame, limit: int, now: int | None = None) -> DataFrame:
    """The log of a whole table of ``ROWS``; rows at or after ``now`` and without a time are left out."""
    rows = rows.select(*ROWS).filter("at is not null")
    if now is not None:
        rows = rows.filter(F.col("at") < now)
    return judge(rows.withColumn("flagged", F.lit(None).cast("boolean")), limit, now)[0]


def latest_status(log: DataFrame) -> DataFrame:
    """Each contract's status after the log's legal rows: OVERDUE until an outcome corrects it."""
    # A contract that is overdue at the time of another row was so before it.
    order = F.struct("at", (F.col("kind") != OVERDUE).alias("after"), "seq")
    return log.filter(F.col("kind") != REJECTED).groupBy("contract_id").agg(
        F.max_by("status", order).alias("status"), F.max("at").alias("since"),
        F.count_if(F.col("kind") == OVERDUE).alias("times_overdue"),
    )
