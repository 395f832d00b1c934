"""Work on samples as they arrive, each finished once however often the stream is stopped and started again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException


def finished(spark, out: str) -> DataFrame | None:
    """(sample): what the ledger under `out` lists; None before the first batch."""
    try:
        return spark.read.parquet(f"{out}/ledger").select("sample").distinct()
    except AnalysisException:
        return None


def results(spark, out: str) -> DataFrame:
    """The rows of all finished samples."""
    return spark.read.parquet(f"{out}/rows").drop("batch")


def work_through(samples: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Applies work to a stream of samples (sample, ...) batch by batch and writes its rows, with a ledger of the samples.

    A batch's rows and ledger go to partitions named by the stream's own id, which its checkpoint keeps, and the batch's number;
    they are overwritten if the batch comes again after a failure, rows first, so a sample is in the ledger only when its rows are
    there.  Samples that another batch has finished are passed over, also where a checkpoint was lost; a sample that is sent twice
    in a batch is worked on with all its rows.
    """
    spark = samples.sparkSession

    def batch(rows: DataFrame, number: int) -> None:
        own = f"{spark.read.json(f'{checkpoint}/metadata').first()['id']}-{number}"
        if finished(spark, out) is not None:
            others = spark.read.parquet(f"{out}/ledger").where(F.col("batch") != own).select("sample").distinct()
            rows = rows.join(others, "sample", "left_anti")
        rows = rows.persist()
        for name, df in (("rows", work(rows)), ("ledger", rows.select("sample").distinct())):
            df.write.mode("overwrite").parquet(f"{out}/{name}/batch={own}")
        rows.unpersist()

    return samples.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
