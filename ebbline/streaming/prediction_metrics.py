"""Running prediction metrics over a growing log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from ebbline.operators.prediction_log import MODEL, prediction_metrics


#: Folders of complete totals that stay: the latest, and the one that a reader may still be reading.
KEPT_BATCHES = 2


def complete_batches(spark: SparkSession, target: str) -> list[int]:
    """The batches below ``target`` whose write was finished, in order."""
    files, root = _files(spark, target)
    if not files.exists(root):
        return []
    names = [status.getPath().getName() for status in files.listStatus(root)]
    numbers = sorted(int(name.removeprefix("batch=")) for name in names if name.startswith("batch="))
    return [number for number in numbers if files.exists(_path(spark, f"{target}/batch={number}/_SUCCESS"))]


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def _files(spark: SparkSession, target: str):
    root = _path(spark, target)
    return root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), root


def retire_batches(spark: SparkSession, target: str, latest: int) -> None:
    """Remove what lies behind the last ``KEPT_BATCHES`` complete batches up to ``latest``; doing it again changes
    nothing."""
    files, _ = _files(spark, target)
    kept = [number for number in complete_batches(spark, target) if number <= latest][-KEPT_BATCHES:]
    for status in files.listStatus(_path(spark, target)):
        name = status.getPath().getName()
        if name.startswith("batch=") and kept and int(name.removeprefix("batch=")) < kept[0]:
            files.delete(status.getPath(), True)


def stream_prediction_metrics(
    log: DataFrame, target: str, checkpoint: str, by: tuple[str, ...] = MODEL
) -> DataStreamWriter:
    """Write the current totals to ``target`` after every batch.

    Totals have no end, so there is no watermark; state is one row per model.  Each batch writes the whole small
    result to a folder of its own, whose mark of success publishes it; a batch repeated after a failure writes
    the same rows to the same folder.  Older folders are then removed, but for the one before, so the target does not
    grow with the life of the stream; a crash in between leaves them to the next batch.  ``read_totals`` gives the
    latest.
    """

    def replace(totals: DataFrame, batch: int) -> None:
        totals.repartition(1).write.mode("overwrite").parquet(f"{target}/batch={batch}")
        retire_batches(totals.sparkSession, target, batch)

    return (
        prediction_metrics(log, by)
        .writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(replace)
    )


def read_totals(spark: SparkSession, target: str) -> DataFrame:
    """The totals after the last complete batch."""
    batches = complete_batches(spark, target)
    if not batches:
        raise ValueError(f"no complete totals at {target}")
    return spark.read.parquet(f"{target}/batch={batches[-1]}")


def run_available(writer: DataStreamWriter) -> None:
    """Process what is there and stop; the checkpoint lets the next call go on from here."""
    writer.trigger(availableNow=True).start().awaitTermination()
