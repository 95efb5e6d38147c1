"""Running streams over files: bounded batches in, parquet out, state and progress in the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from ..plans import shared_dir

#: The session settings that start() makes: state on disk, which the stateful operators need, and bursts of one user combined
#: before the shuffle.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}
END_OF_TIME = "2262-01-01 00:00:00"  # the latest year that fits nanoseconds


def as_instant(local: Column) -> Column:
    """Zone-less time to the instant with that reading in UTC; watermarks need instants."""
    return F.from_utc_timestamp(local.cast("timestamp"), F.current_timezone())


def as_local(instant: Column) -> Column:
    """The reading of an instant in UTC, as a time without zone."""
    return F.to_utc_timestamp(instant, F.current_timezone()).cast("timestamp_ntz")


def read_events(spark: SparkSession, path: str, schema: StructType | str, bytes_per_batch: int = 128 << 20) -> DataFrame:
    """Parquet files as a stream, a bounded number of bytes per batch; zone-less times become instants."""
    raw = spark.readStream.schema(schema).option("maxBytesPerTrigger", bytes_per_batch).parquet(path)
    local = [f.name for f in raw.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return raw.withColumns({c: as_instant(F.col(c)) for c in local})


EachBatch = Callable[[DataFrame, int], DataFrame]


def start(stream: DataFrame, target: str, mode: str = "append", each_batch: EachBatch | None = None, **trigger) -> StreamingQuery:
    """Run a stream into parquet folders target/out/batch_id=N, one per batch.

    A batch that is run again replaces its folder, so a restart neither loses nor repeats rows.
    `each_batch` turns a batch into what is written; `trigger` is passed on, such as
    availableNow=True or processingTime="10 seconds".
    """
    for key, value in SETTINGS.items():
        stream.sparkSession.conf.set(key, value)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = each_batch(batch, batch_id) if each_batch else batch
        rows.write.mode("overwrite").parquet(f"{target}/out/batch_id={batch_id}")

    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", f"{target}/progress")
        .trigger(**trigger)
        .start()
    )


def late_rows(query: StreamingQuery) -> dict[int, int]:
    """Rows that came after the watermark and were left out, per batch of a query's recent progress.

    Operators that combine rows before the shuffle count the combined ones.
    """
    late: dict[int, int] = {}
    for progress in query.recentProgress:
        dropped = sum(state.numRowsDroppedByWatermark for state in progress.stateOperators)
        if dropped:
            late[progress.batchId] = late.get(progress.batchId, 0) + dropped
    return late


def with_clock(stream: DataFrame, ts: str = "ts") -> tuple[DataFrame, Callable[[], None]]:
    """The stream with a clock beside it, and what strikes it: one row at the end of time, null in all other columns.

    Operators hold rows until the watermark passes them. Once the data has ended, the struck clock moves the
    watermark past all of it. Its row has null keys; drain() leaves out what it may cause.
    """
    spark, folder = stream.sparkSession, shared_dir(stream.sparkSession, "clock")
    schema = StructType([StructField(f.name, f.dataType) for f in stream.schema.fields])
    spark.createDataFrame([], schema).write.parquet(folder)

    def strike() -> None:
        row = [(F.lit(END_OF_TIME) if f.name == ts else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
        spark.range(1).select(*row).write.mode("append").parquet(folder)

    return stream.unionByName(spark.readStream.schema(schema).parquet(folder)), strike


def drain(
    stream: DataFrame, mode: str = "append", each_batch: EachBatch | None = None, schema: StructType | None = None,
    strike: Callable[[], None] | None = None, key: str = "user_id", target: str | None = None,
) -> DataFrame:
    """Run a stream over all data present and return what it wrote, with a batch_id column.

    `schema` is that of the rows of each_batch. With `strike`, from with_clock, the stream goes on after the data
    until everything open is closed, and rows with a null `key` are left out.
    """
    spark = stream.sparkSession
    target = target or shared_dir(spark, "stream")
    start(stream, target, mode, each_batch, availableNow=True).awaitTermination()
    if strike:
        strike()
        start(stream, target, mode, each_batch, availableNow=True).awaitTermination()
    schema = StructType([*(schema or stream.schema).fields, StructField("batch_id", LongType())])
    try:
        rows = spark.read.schema(schema).parquet(f"{target}/out")
        return rows.where(F.col(key).isNotNull()) if strike else rows
    except AnalysisException as e:  # no data, so no batch
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
