"""Streaming aggregates whose refreshed result is kept as a Parquet folder.

The complete result of each micro-batch goes to a folder named after the batch, so
a batch repeated after a failure replaces itself and nothing passes the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeops import scratch


def guarded(
    write: Callable[[DataFrame, int], None], *guards: Callable[[], None]
) -> Callable[[DataFrame, int], None]:
    """A batch writer that first calls every guard; one that raises fails the stream.

    They are called again after the write, so that a change committed meanwhile does not
    wait for the next batch.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        for guard in guards:
            guard()
        write(batch, batch_id)
        for guard in guards:
            guard()

    return run


class RefreshedResult:
    """A streaming query and the place its latest complete result is found.

    ``state_partitions`` is the number of state stores when the session's shuffle
    width is more than the groups need; it is fixed by the first start. ``guards`` are
    called in every micro-batch before its result is written (``VersionedTable.guard``).
    """

    def __init__(
        self,
        result: DataFrame,
        path: str,
        checkpoint: str,
        state_partitions: int | None = None,
        guards: Sequence[Callable[[], None]] = (),
    ):
        self.guards = list(guards)
        self.result = result
        self.path = path.rstrip("/")
        self.checkpoint = checkpoint
        self.state_partitions = state_partitions

    def _writer(self) -> Callable[[DataFrame, int], None]:
        path = self.path

        def write(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
            # Readers may still be on the previous batch; anything older can go.
            scratch.delete(batch.sparkSession, f"{path}/batch={batch_id - 2}")

        return guarded(write, *self.guards)

    def start(self, **trigger) -> StreamingQuery:
        """Start refreshing; by default continuously, else as ``trigger`` says."""
        writer = (
            self.result.writeStream.outputMode("complete")
            .option("checkpointLocation", self.checkpoint)
            .foreachBatch(self._writer())
        )
        writer = writer.trigger(**trigger) if trigger else writer
        if self.state_partitions is None:
            return writer.start()
        # A query keeps the settings it was started with.
        conf = self.result.sparkSession.conf
        before = conf.get("spark.sql.shuffle.partitions")
        conf.set("spark.sql.shuffle.partitions", str(self.state_partitions))
        try:
            return writer.start()
        finally:
            conf.set("spark.sql.shuffle.partitions", before)

    def catch_up(self) -> DataFrame:
        """Take in everything there is, then return the result."""
        query = self.start(availableNow=True)
        query.awaitTermination()
        return self.latest()

    def latest(self) -> DataFrame:
        """The newest finished batch. Finished folders carry a success marker."""
        spark = self.result.sparkSession
        jvm = spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        done = [
            int(entry.getPath().getParent().getName().removeprefix("batch="))
            for entry in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch=*/_SUCCESS")) or []
        ]
        if not done:
            raise LookupError("no batch has finished yet")
        return spark.read.schema(self.result.schema).parquet(f"{self.path}/batch={max(done)}")


def sql_over_stream(stream: DataFrame, sql: str) -> DataFrame:
    """Ordinary SQL over a stream: ``{stream}`` stands for the view's name."""
    view = f"stream_{uuid.uuid4().hex}"
    stream.createOrReplaceTempView(view)
    return stream.sparkSession.sql(sql.format(stream=view))


def refreshed(
    spark: SparkSession,
    result: DataFrame,
    label: str,
    state_partitions: int | None = None,
    guards: Sequence[Callable[[], None]] = (),
) -> RefreshedResult:
    """A result refreshed into a folder of its own under the shared folder."""
    home = scratch.fresh(spark, label)
    return RefreshedResult(result, f"{home}/out", f"{home}/checkpoint", state_partitions, guards)


def running_sum(stream: DataFrame, by: str, value: str, name: str) -> DataFrame:
    return sql_over_stream(stream, f"SELECT {by}, sum({value}) AS {name} FROM {{stream}} GROUP BY {by}")


def running_rmse(stream: DataFrame, by: str, truth: str, prediction: str) -> DataFrame:
    """Error per scoring batch, in order; sorting needs the complete output mode."""
    return sql_over_stream(
        stream,
        f"SELECT {by}, sqrt(avg(({truth} - {prediction}) * ({truth} - {prediction}))) AS rmse "
        f"FROM {{stream}} GROUP BY {by} ORDER BY {by}",
    )


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    """Whether two results hold the same rows, counting duplicates."""
    sides = left.withColumn("_side", F.lit(1)).unionByName(right.withColumn("_side", F.lit(-1)))
    return sides.groupBy(*left.columns).agg(F.sum("_side").alias("n")).where("n <> 0").isEmpty()
