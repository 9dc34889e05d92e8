"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabforge.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read back: a short lineage
    that survives lost executors, and a table later steps read by column."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free(docs: DataFrame, *names: str) -> list[str]:
    """Names for columns of an operator's own, none of them a column of ``docs`` (Spark ignores case)."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def text_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Rows that go to Python at once, for operators that send whole texts there: bounds a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
