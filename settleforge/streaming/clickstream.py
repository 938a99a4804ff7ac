"""The clickstream pipeline: JSON event files to valid events, marts and a report, in batch and as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: Fixed values.
EVENT_TYPES = ("page_view", "add_to_cart", "purchase")
FIELDS = ("event_type", "product_id", "timestamp", "user_id")
INTERVAL = "30 seconds"


def parse_events(files: DataFrame, text_col: str = "value", name_col: str = "source_file") -> DataFrame:
    """Each file's event, or the reason why it is bad.

    Adds event_type, user_id, product_id, event_timestamp (the wall clock as
    written; an offset is dropped) and ``reason`` (null for a valid event).
    """
    v = F.col("_v")
    kind = lambda f: F.coalesce(
        F.schema_of_variant(F.try_variant_get(v, f"$.{f}", "variant")), F.lit("ABSENT")
    )
    keys = F.coalesce(F.json_object_keys(F.to_json(v)), F.array().cast("array<string>"))
    stamp = F.try_variant_get(v, "$.timestamp", "string")
    wall = F.try_to_timestamp(F.regexp_replace(stamp, r"(Z|[+-]\d{2}:?\d{2})$", ""))
    iso = F.rlike(stamp, F.lit(r"\A\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?\z"))
    df = files.withColumn("_v", F.try_parse_json(text_col))
    reason = (
        F.when(v.isNull(), "INVALID_JSON")
        .when(~F.schema_of_variant(v).startswith("OBJECT"), "NOT_AN_OBJECT")
        .when(F.size(F.array_except(F.array(*[F.lit(f) for f in FIELDS]), keys)) > 0, "MISSING_FIELD")
        .when(
            (kind("event_type") != "STRING") | ~F.coalesce(
                F.try_variant_get(v, "$.event_type", "string").isin(*EVENT_TYPES), F.lit(False)
            ),
            "INVALID_EVENT_TYPE"
        )
        .when(
            (kind("user_id") != "BIGINT") | ~F.coalesce(F.try_variant_get(v, "$.user_id", "bigint") > 0, F.lit(False)),
            "INVALID_USER"
        )
        .when(~kind("product_id").isin("BIGINT", "VOID"), "INVALID_PRODUCT")
        .when((kind("timestamp") != "STRING") | ~iso | wall.isNull(), "INVALID_TIMESTAMP")
    )
    out = {
        "event_type": F.try_variant_get(v, "$.event_type", "string"),
        "user_id": F.try_variant_get(v, "$.user_id", "bigint"),
        "product_id": F.try_variant_get(v, "$.product_id", "bigint"), "event_timestamp": wall, "reason": reason
    }
    return df.withColumns(out).drop("_v")


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row a JSON file: value and source_file (its name)."""
    df = spark.read.option("wholetext", "true").option("pathGlobFilter", "*.json").text(folder)
    return df.select("value", F.col("_metadata.file_name").alias("source_file"))


def ingest(files: DataFrame, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(new valid events, bad files).  A file that is known already, or given twice, adds nothing."""
    parsed = parse_events(files)
    good = parsed.where("reason IS NULL").dropDuplicates(["source_file"])
    if known is not None:
        good = good.join(known.select("source_file"), "source_file", "left_anti")
    return good.select(
        "event_type", "user_id", "product_id", "event_timestamp", "source_file"
    ), parsed.where("reason IS NOT NULL").select("source_file", "reason", "value")


def cart_snapshot(events: DataFrame, start: Column, end: Column) -> DataFrame:
    """Cart additions of each user in [start, end)."""
    df = events.where(
        (F.col("event_type") == "add_to_cart") & (F.col("event_timestamp") >= start) & (F.col("event_timestamp") < end)
    )
    return df.groupBy("user_id").agg(F.count(F.lit(1)).alias("add_to_cart_count")).select(
        "user_id", start.alias("snapshot_hour"), "add_to_cart_count"
    )


def purchase_quantity(events: DataFrame, start: Column, end: Column) -> DataFrame:
    """Purchases in [start, end); one row also when there are none."""
    df = events.where(
        (F.col("event_type") == "purchase") & (F.col("event_timestamp") >= start) & (F.col("event_timestamp") < end)
    )
    return df.agg(
        F.count(F.lit(1)).cast("decimal(10,2)").alias("total_quantity")
    ).select(start.alias("operation_timestamp"), "total_quantity")


def upsert(mart: DataFrame | None, new: DataFrame, keys: list[str]) -> DataFrame:
    """The mart with the rows of ``new`` in place of those with their keys."""
    return new if mart is None else mart.join(new.select(*keys), keys, "left_anti").unionByName(new)


def has_purchases(quantity: DataFrame) -> bool:
    """Whether a report is due for the interval."""
    return not quantity.where("total_quantity > 0").isEmpty()


def report(quantity: DataFrame) -> DataFrame:
    """The report's lines of text."""
    return quantity.select(
        F.concat(
            F.lit("purchases at "), F.date_format("operation_timestamp", "yyyy-MM-dd HH:mm:ss"), F.lit(": "),
            F.col("total_quantity").cast("long").cast("string")
        ).alias("value")
    )


def windowed_marts(events: DataFrame, interval: str = INTERVAL) -> DataFrame:
    """Cart additions by user, and purchases, of every tumbling interval that has any."""
    df = events.where("event_type IN ('add_to_cart', 'purchase')")
    w = F.window("event_timestamp", interval)
    out = df.groupBy(
        w.alias("w"), "event_type", F.when(F.col("event_type") == "add_to_cart", F.col("user_id")).alias("user_id")
    ).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "event_type", "user_id", "n")


def interval_spine(days: DataFrame, interval: str = INTERVAL) -> DataFrame:
    """The starts of all intervals that begin on the days (day), as one column ``start``.

    Intervals count from the epoch, as those of ``window`` do.
    """
    n = F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {interval}"))
    first = lambda t: F.ceil(F.unix_micros(t) / n).cast("long")
    day = F.col("day").cast("timestamp")
    upto = first(day + F.expr("INTERVAL 1 DAY"))
    own = F.when(upto > first(day), F.sequence(first(day), upto - 1)).otherwise(F.array().cast("array<long>"))
    return days.select(F.explode(own).alias("k"), n.alias("n")).select(
        F.timestamp_micros(F.col("k") * F.col("n")).alias("start")
    )


def purchase_intervals(events: DataFrame, days: DataFrame, interval: str = INTERVAL) -> DataFrame:
    """(operation_timestamp, total_quantity) of every interval of the days, those without purchases with a zero."""
    w = F.window("event_timestamp", interval).alias("w")
    n = events.where("event_type = 'purchase'").groupBy(w).agg(F.count(F.lit(1)).alias("n"))
    df = interval_spine(days, interval).join(n.select(F.col("w.start").alias("start"), "n"), "start", "left")
    return df.select(
        F.col("start").alias("operation_timestamp"),
        F.coalesce("n", F.lit(0)).cast("decimal(10,2)").alias("total_quantity")
    )


def cart_intervals(events: DataFrame, interval: str = INTERVAL) -> DataFrame:
    """(user_id, snapshot_hour, add_to_cart_count) of every interval in which a user added to a cart."""
    df = events.where("event_type = 'add_to_cart'").groupBy(F.window("event_timestamp", interval).alias("w"), "user_id")
    return df.agg(F.count(F.lit(1)).alias("add_to_cart_count")).select(
        "user_id", F.col("w.start").alias("snapshot_hour"), "add_to_cart_count"
    )


class Mart:
    """A mart in one partition a day of intervals; writing replaces the partitions that it has rows for and no others."""

    def __init__(self, spark: SparkSession, path: str, time_col: str):
        self.spark, self.path, self.time_col = spark, path, time_col

    def write(self, rows: DataFrame) -> None:
        """Whole days of intervals; days that have no row among them stay as they are."""
        df = rows.withColumn("day", F.col(self.time_col).cast("date"))
        df.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "day"
        ).parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path).drop("day")

    def correct(
        self, late: DataFrame, events: DataFrame, build: Callable[[DataFrame, DataFrame], DataFrame]
    ) -> DataFrame:
        """Make the days of late events again, from all events of those days; returns the days.

        ``build`` gives the mart's rows from events and their days (day).
        """
        days = late.select(F.col("event_timestamp").cast("date").alias("day")).where("day IS NOT NULL").distinct()
        own = events.withColumn("day", F.col("event_timestamp").cast("date")).join(days, "day", "left_semi")
        self.write(build(own.drop("day"), days))
        return days


def write_report(spark: SparkSession, quantity: DataFrame, path: str) -> bool:
    """Write the report's lines as text where one is due; whether it was."""
    due = has_purchases(quantity)
    if due:
        report(quantity.where("total_quantity > 0")).write.mode("overwrite").text(path)
    return due


def cadence(every: str | None) -> dict:
    """The trigger of a stream: all that is there, then stop; or on and on at an interval."""
    return {"availableNow": True} if every is None else {"processingTime": every}


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
    return spark.read.parquet(path) if there else None


def stream(
    spark: SparkSession, folder: str, events_path: str, bad_path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Take up new files as they come; each file is ingested once, bad files are kept aside with their reason.

    The file source's checkpoint makes a restart go on where it stopped; an
    anti-join on the names makes a batch that is run again add nothing.
    ``every``: how often, such as "30 seconds"; without it the query ends when
    it has taken up what is there.
    """
    files = spark.readStream.format("text").option("wholetext", "true").option(
        "pathGlobFilter", "*.json"
    ).schema("value string").load(folder)
    files = files.select("value", F.col("_metadata.file_name").alias("source_file"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        good, bad = ingest(batch, _stored(s, events_path))
        known = _stored(s, bad_path)
        if known is not None:
            bad = bad.join(known.select("source_file"), "source_file", "left_anti")
        good.write.mode("append").parquet(events_path)
        bad.write.mode("append").parquet(bad_path)

    return files.writeStream.foreachBatch(sink).option(
        "checkpointLocation", checkpoint
    ).trigger(**cadence(every)).start()


def stream_marts(
    events: DataFrame, path: str, checkpoint: str, late: str = "10 minutes", interval: str = INTERVAL,
    every: str | None = None
) -> StreamingQuery:
    """Append the finished intervals of ``windowed_marts`` of a streaming frame of valid events to ``path``.

    An interval is finished when an event came in that is ``late`` after its end;
    events that come in later still are not counted, as a watermark has it.  For
    results that late events correct, recompute ``windowed_marts`` and ``upsert``.
    """
    out = windowed_marts(events.withWatermark("event_timestamp", late), interval)
    return out.writeStream.format("parquet").outputMode("append").option("path", path).option(
        "checkpointLocation", checkpoint
    ).trigger(**cadence(every)).start()


def generate(spark: SparkSession, n: int, seed: int = 1) -> DataFrame:
    """Random events as JSON text, for tests."""
    r = lambda k: F.rand(seed + k)
    types = F.array(*[F.lit(x) for x in EVENT_TYPES])
    row = F.struct(
        F.get(types, F.floor(r(0) * 3).cast("int")).alias("event_type"), (1 + F.floor(r(1) * 100)).alias("user_id"),
        F.when(r(2) < 0.8, 1 + F.floor(r(2) * 50)).alias("product_id"),
        F.date_format(
            F.timestamp_seconds(1_767_225_600 + F.floor(r(3) * 3600)), "yyyy-MM-dd'T'HH:mm:ss'Z'"
        ).alias("timestamp")
    )
    return spark.range(n).select(
        F.to_json(row, {"ignoreNullFields": "false"}).alias("value"),
        F.concat(F.lit("event-"), F.col("id").cast("string"), F.lit(".json")).alias("source_file")
    )
