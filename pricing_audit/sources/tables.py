"""Reading and writing tables: scans with declared schemas, appends, exports, counts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    For results that cost much and are used several times: what follows reads the files, so nothing
    is computed twice and a lost executor repeats only its own reads.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame, *by: str) -> DataFrame:
    """Give a scan of too few files enough partitions for text work, which costs far more than
    moving the text once. A scan that already fills the cluster is returned as it is; one whose rows lie
    in few of its partitions, as with a file that is a single row group, does not fill it.

    ``by`` may name a unique key, so that later grouping by it needs no further shuffle. For plain
    scans only: rows are counted from the files' footers.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        sizes = scan.groupBy(F.spark_partition_id().alias("p")).count()
        most, total = sizes.agg(F.max("count"), F.sum("count")).first()
        if total is None or most * cores <= 2 * total:
            return scan
    return scan.repartition(cores, *by)


@dataclass(frozen=True)
class TableNames:
    """Where the result tables live; every part is chosen at run time."""

    database: str
    prices: str = "extracted_prices"
    fees: str = "extracted_fees"
    truth_prices: str = "truth_prices"
    truth_fees: str = "truth_fees"

    def full(self, table: str) -> str:
        return f"{self.database}.{getattr(self, table)}" if self.database else getattr(self, table)


def read_named(spark: SparkSession, name: str) -> DataFrame:
    """Scan a table or view whose name is only known at run time, without building SQL text."""
    return spark.sql("SELECT * FROM IDENTIFIER(:name)", args={"name": name})


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None while nothing has been written there."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def append_rows(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), dedupe: Sequence[str] = ()
) -> None:
    """Add rows to a table; running twice adds them twice unless ``dedupe`` keys are given.
    Null keys count as equal."""
    rows = df
    if dedupe:
        rows = df.dropDuplicates(list(dedupe))
        present = read_if_exists(df.sparkSession, path)
        if present is not None:
            known = present.select(*[F.col(k).alias(f"__known_{k}") for k in dedupe])
            same = [F.col(k).eqNullSafe(F.col(f"__known_{k}")) for k in dedupe]
            rows = rows.join(known, same, "left_anti")
    writer = rows.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """Write a result as CSV with a header, one file per partition of ``df``."""
    df.write.mode("overwrite").option("header", True).csv(path)


def row_counts(**tables: DataFrame) -> DataFrame:
    counted = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)
