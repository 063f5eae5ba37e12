"""File drops as streams: media manifests and the audit log."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vitrine.plans.changes import media_edges, media_intake
from vitrine.plans.model import Collection
from vitrine.sources.readers import clean_manifest, parse_audit_log


def manifest_stream(spark: SparkSession, folder: str, columns: list[str], glob: str = "*.step1.csv", late: str | None = None) -> DataFrame:
    """New manifests of a drop folder, as rows.

    With ``late``, a row that is delivered again, in whatever file, within that time of its first
    delivery is left out; files are placed in time by when they were written.
    """
    schema = ", ".join(f"`{n}` string" for n in columns)
    rows = spark.readStream.schema(schema).option("header", True).option("sep", "|").option("pathGlobFilter", glob).csv(folder)
    if late is None:
        return clean_manifest(rows)
    rows = rows.withColumn("_at", F.col("_metadata.file_modification_time"))
    rows = once_each(rows.withColumn("_line", line_key(*columns)), "_at", late, "_line")
    return clean_manifest(rows.drop("_at", "_line"))


def line_key(*columns: str):
    """A key of a row's content."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def once_each(rows: DataFrame, at: str, late: str, key: str) -> DataFrame:
    """Rows of a stream whose ``key`` was not there within ``late``; state is as large as what came in that time."""
    return rows.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def run_intake(c: Collection, rows: DataFrame, now: str, out: str, checkpoint: str) -> StreamingQuery:
    """Take in everything that has arrived, then stop.

    Each batch writes its rows and links into a folder of its own number, so a batch
    that is run again after a failure replaces itself.
    """

    def take_in(batch: DataFrame, number: int) -> None:
        intake = media_intake(c, batch, now)
        intake.write.mode("overwrite").parquet(f"{out}/rows/batch={number}")
        media_edges(intake).write.mode("overwrite").parquet(f"{out}/edges/batch={number}")

    return rows.writeStream.foreachBatch(take_in).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _actions(lines: DataFrame) -> DataFrame:
    actions = parse_audit_log(lines.withColumn("line", F.col("value")), "value", keep=("line",))
    return actions.withColumn("at", F.try_to_timestamp("logged_at", F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))).withColumn("line", F.sha2("line", 256))


def audit_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Actions of an append-only audit log, with the time they were logged at and the key of their line."""
    return _actions(spark.readStream.text(folder))


def recent_activity(actions: DataFrame, width: str = "1 hour", late: str = "1 day", once: str | None = None) -> DataFrame:
    """Actions per window and update type; what arrives later than ``late`` is left out.

    With ``once``, a column, actions that come again within ``late`` count once.
    """
    timed = actions.withWatermark("at", late) if once is None else once_each(actions, "at", late, once)
    return (
        timed
        .groupBy(F.window("at", width), "update_type")
        .agg(F.count("*").alias("n"))
        .select(F.col("window.start").alias("start"), "update_type", "n")
    )


def _written(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def run_audit(spark: SparkSession, folder: str, out: str, checkpoint: str, late: str = "1 day") -> tuple[DataFrame, DataFrame]:
    """Take in the lines that have arrived; ``(actions, late actions)``, every line of the log once in one of them.

    Lines within the watermark, and lines without a time, go to ``actions``, each once.  The watermark passes over what comes later:
    those lines are found as the ones that are in no output yet, and go to the side table.  Only files that came since the run before,
    and were there when this one began, are looked at again.
    """
    columns = ["action", "logged_at", "update_type", "uri", "username", "attrs", "line", "at"]
    marks = _written(spark, f"{out}/marks")
    since = None if marks is None else marks.agg(F.max("upto")).first()[0]
    arrived = F.col("_metadata.file_modification_time")
    upto = spark.read.format("binaryFile").load(folder).agg(F.max("modificationTime")).first()[0]
    run_to_table(once_each(audit_stream(spark, folder), "at", late, "line").select(*columns), f"{out}/actions", checkpoint).awaitTermination()
    done = spark.read.parquet(f"{out}/actions")
    aside = _written(spark, f"{out}/late")
    lines = spark.read.text(folder).filter(arrived <= F.lit(upto)).filter(F.lit(True) if since is None else arrived >= F.lit(since))
    seen = done.select("line") if aside is None else done.select("line").union(aside.select("line"))
    passed = _actions(lines).dropDuplicates(["line"]).join(seen, "line", "left_anti").select(*columns)
    passed.write.mode("append").parquet(f"{out}/late")
    spark.range(1).select(F.lit(upto).alias("upto")).write.mode("append").parquet(f"{out}/marks")
    return done, spark.read.parquet(f"{out}/late")


def run_to_table(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append finished rows to a table, then stop."""
    writer = rows.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
