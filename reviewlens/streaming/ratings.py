"""Running mean and count of ratings over a file stream.

State is one partial per key and day; days older than the watermark are
dropped from it, so it does not grow with the stream. Every micro-batch writes
the rows it changed under its own batch number. A batch that is run again after
a failure overwrites its own folder, and readers take the newest row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from reviewlens.functions import rated
from reviewlens.operators.ratings import finish, merge_partials
from reviewlens.session import written
from reviewlens.sinks.folders import Folders, current, replace

DAY = "day"


def read_stream(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files as they arrive in a folder (or under a glob)."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def rating_updates(
    events: DataFrame,
    keys: Sequence[str],
    time_col: str = "ts",
    rating_col: str = "rating",
    lateness: str = "1 day",
) -> DataFrame:
    """Partial state per key and day, updated as events arrive; later ones are dropped.

    Windows start at midnight UTC. Times are moved there and back by the
    session's zone, so that a day is a calendar day of the data in any zone.
    """
    zone = F.current_timezone()
    shown = F.from_utc_timestamp(F.col(time_col).cast("timestamp"), zone)
    present = events.filter(rated(F.col(rating_col)))
    timed = present.withColumn("_ts", shown).withWatermark("_ts", lateness)
    daily = timed.groupBy(*keys, F.window("_ts", "1 day").alias("_window")).agg(
        F.sum(rating_col).alias("rating_sum"), F.count(rating_col).alias("review_count")
    )
    day = F.to_utc_timestamp(F.col("_window.start"), zone).cast("date").alias(DAY)
    return daily.select(*keys, day, "rating_sum", "review_count")


def stream_ratings(updates: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Start the stream over all files present and write each batch's changes."""

    def write_batch(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/batch={number}")

    return (
        updates.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write_batch)
        .start()
    )


def run_available(updates: DataFrame, output: str, checkpoint: str) -> None:
    stream_ratings(updates, output, checkpoint).awaitTermination()


def _newest(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    state = F.struct("rating_sum", "review_count", "batch")
    newest = changes.groupBy(*keys, DAY).agg(F.max_by(state, "batch").alias("state"))
    return newest.select(*keys, DAY, "state.*")


def _changes(spark: SparkSession, output: str, base: str | None) -> DataFrame:
    """All changes, or a compacted table and the changes of later batches only."""
    changes = spark.read.parquet(output)
    if base is None:
        return changes
    compacted = spark.read.parquet(base)
    last = compacted.agg(F.max("compacted_to")).first()[0]
    later = changes if last is None else changes.filter(F.col("batch") > last)
    return later.unionByName(compacted.drop("compacted_to"))


def latest_state(
    spark: SparkSession, output: str, keys: Sequence[str], base: str | None = None
) -> DataFrame:
    """Newest partial state per key and day of everything written so far.

    With ``base``, a table from ``compact``, the batch folders it covers are
    not read again.
    """
    return _newest(_changes(spark, output, base), keys).drop("batch")


def compact(
    spark: SparkSession, output: str, keys: Sequence[str], target: str, base: str | None = None
) -> None:
    """Write the newest state to ``target``, so that readers need not go through old batches.

    ``base`` is an earlier compacted table to start from; ``target`` must be
    another folder. Batch folders up to the compacted one may then be removed.
    """
    last = spark.read.parquet(output).agg(F.max("batch")).first()[0]
    newest = _newest(_changes(spark, output, base).filter(F.col("batch") <= last), keys)
    newest.withColumn("compacted_to", F.lit(last)).write.mode("overwrite").parquet(target)


def update_state(spark: SparkSession, output: str, keys: Sequence[str], state: str, keep: int = 10) -> int:
    """Bring the table at ``state``, a folder per day, up to the newest batch; returns the batches taken in.

    Only batches that came since the last call are read, and only the days they changed are written anew,
    so a call costs what came, not what there is. The days are put together aside first and then replaced
    day by day. A call that is cut off is made good by the next: taking a batch in twice changes nothing.
    All but the last ``keep`` of the batches taken in are removed. Days without an updated key stay as they
    are; none is ever dropped.
    """
    folders, mark = Folders(spark, output), f"{state}/_taken"
    numbers = sorted(int(name[6:]) for name in folders.names(output) if name.startswith("batch="))
    at = current(spark, mark)
    done = spark.read.parquet(at).first()["batch"] if folders.exists(at) else -1
    new = [number for number in numbers if number > done]
    if new:
        reader = spark.read.option("basePath", output)
        changes = reader.parquet(*[f"{output}/batch={number}" for number in new])
        newest = changes
        if any(name.startswith(f"{DAY}=") for name in folders.names(state)):
            held = spark.read.schema(_state_schema(changes)).parquet(state)
            newest = changes.unionByName(held.join(changes.select(DAY).distinct(), DAY, "left_semi"))
        whole = written(_newest(newest, keys), "days")
        writer = whole.repartition(DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(DAY).parquet(state)
        replace(spark.createDataFrame([(new[-1],)], "batch bigint"), mark, lambda df, to: df.write.parquet(to))
    for number in numbers[:-keep]:
        if number <= done:
            folders.remove(f"{output}/batch={number}")
    return len(new)


def _state_schema(changes: DataFrame) -> StructType:
    return StructType([*(f for f in changes.schema.fields if f.name != DAY), changes.schema[DAY]])


def read_state(spark: SparkSession, state: str) -> DataFrame:
    """The table that ``update_state`` keeps: keys, day, rating_sum, review_count."""
    return spark.read.parquet(state).drop("batch")


def daily_ratings(state: DataFrame) -> DataFrame:
    return finish(state)


def monthly_ratings(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Days rolled up to calendar months at read time."""
    months = state.withColumn("month", F.trunc(DAY, "month"))
    return finish(merge_partials(months, [*keys, "month"]))
