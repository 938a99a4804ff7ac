"""Deliveries of daily reports: a data file and its manifest.

``X.json`` holds an array of rows, ``X.manifest.json`` what the sender says of
it; ``X.json.part`` and ``X.manifest.json.part`` mean that writing goes on.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identity import delivery_key
from ..schemas import FILE_SCHEMA_VERSION, REPORTS

MANIFEST_FIELDS = (
    "checksum_sha256", "entity_type", "filename", "report_date", "report_type", "row_count", "schema_version",
    "source_system"
)


class DeliveryError(ValueError):
    """A finished delivery is not what it claims to be."""


def publish_source_file(
    path: str | Path, rows: list[dict], report_type: str, report_date: str, *, source_system: str | None = None,
    entity_type: str | None = None, hook: Callable[[str], None] = lambda point: None
) -> Path:
    """Write a delivery: data first, manifest last, each under a part name; an existing delivery is never overwritten."""
    data, entity, system = Path(path), *REPORTS[report_type.lower()][:2]
    manifest = data.with_name(f"{data.stem}.manifest.json")
    if data.exists() or manifest.exists():
        raise FileExistsError(data)
    body = json.dumps(rows, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()
    said = {
        "filename": data.name, "source_system": source_system or system, "report_type": report_type,
        "report_date": report_date, "entity_type": entity_type or entity, "schema_version": FILE_SCHEMA_VERSION,
        "row_count": len(rows), "checksum_sha256": hashlib.sha256(body).hexdigest()
    }
    for target, content in ((data, body), (manifest, json.dumps(said, sort_keys=True).encode())):
        part = target.with_name(target.name + ".part")
        with open(part, "xb") as f:
            f.write(content)
            f.flush()
            os.fsync(f.fileno())
        hook(f"before_{'data' if target is data else 'manifest'}_rename")
        os.rename(part, target)
    return manifest


def _empty_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, content, modificationTime) of files without bytes; Spark's own listing leaves them out.

    Names are listed once on the driver, as for any scan of a folder; only the
    empty files' names are kept.
    """
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, files = [], fs.listFiles(root, True)
    while files.hasNext():
        f = files.next()
        if f.getLen() == 0 and ".json" in f.getPath().getName():
            found.append(
                (
                    f.getPath().toString(), bytearray(),
                    datetime.fromtimestamp(f.getModificationTime() / 1000, timezone.utc)
                )
            )
    return spark.createDataFrame(found, "path string, content binary, modificationTime timestamp")


def read_deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """One row a delivery: stem, data_bytes, manifest_bytes, writing (a part file is there, were it empty)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json*").option(
        "recursiveFileLookup", "true"
    ).load(folder)
    files = files.select("path", "content", "modificationTime").unionByName(_empty_files(spark, folder))
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"%20", " ")
    kind = F.when(F.endswith(name, F.lit(".part")), "part").when(
        F.endswith(name, F.lit(".manifest.json")), "manifest"
    ).when(F.endswith(name, F.lit(".json")), "data")
    one = files.select(
        F.regexp_replace("path", r"(\.manifest)?\.json(\.part)?$", "").alias("stem"), kind.alias("kind"), "content",
        "modificationTime"
    ).where("kind IS NOT NULL")
    return one.groupBy("stem").agg(
        F.max(F.when(F.col("kind") == "data", F.col("content"))).alias("data_bytes"),
        F.max(F.when(F.col("kind") == "manifest", F.col("content"))).alias("manifest_bytes"),
        F.coalesce(F.bool_or(F.col("kind") == "part"), F.lit(False)).alias("writing"),
        F.max("modificationTime").alias("modified_at"),
    )


def _manifest(v: Column, field: str) -> Column:
    return F.when(
        F.schema_of_variant(F.try_variant_get(v, f"$.{field}", "variant")) == "STRING",
        F.try_variant_get(v, f"$.{field}", "string")
    )


def gate(deliveries: DataFrame, versions: tuple[str, ...] = (FILE_SCHEMA_VERSION,)) -> DataFrame:
    """State (WAITING, REJECTED, READY) and reason of each delivery; the first reason in a fixed order."""
    m = F.col("_m")
    name = F.concat(F.element_at(F.split("stem", "/"), -1), F.lit(".json"))
    text = F.decode("data_bytes", "utf-8")
    df = deliveries.withColumns(
        {"_m": F.try_parse_json(F.decode("manifest_bytes", "utf-8")), "_d": F.try_parse_json(text)}
    )
    # Columns of steps of their own: what several conditions read is worked out once.
    df = df.withColumn("_rows", F.try_variant_get("_d", "$", "array<variant>"))
    rows = F.col("_rows")
    count_ok = F.schema_of_variant(F.try_variant_get(m, "$.row_count", "variant")) == "BIGINT"
    declared = F.when(count_ok, F.try_variant_get(m, "$.row_count", "bigint"))
    fields = [f for f in MANIFEST_FIELDS if f != "row_count"]
    whole = F.coalesce(
        (_manifest(m, "filename") == name) & (declared >= 0) & F.rlike(
            _manifest(m, "checksum_sha256"), F.lit(r"\A[0-9a-f]{64}\z")
        ),
        F.lit(False)
    )
    for f in fields:
        whole = whole & _manifest(m, f).isNotNull()
    df = df.withColumn("_objects", rows.isNotNull() & F.forall(
        rows, lambda x: F.coalesce(F.schema_of_variant(x).startswith("OBJECT"), F.lit(False))
    ))
    objects = F.col("_objects")
    r = lambda state, reason: F.struct(F.lit(state).alias("state"), F.lit(reason).alias("reason"))
    result = (
        F.when(F.col("writing"), r("WAITING", "TEMPORARY_FILE_PRESENT"))
        .when(F.col("manifest_bytes").isNull(), r("WAITING", "MANIFEST_MISSING"))
        .when(~whole, r("REJECTED", "INVALID_MANIFEST"))
        .when(~_manifest(m, "schema_version").isin(*versions), r("REJECTED", "UNSUPPORTED_SCHEMA_VERSION"))
        .when(F.col("data_bytes").isNull(), r("WAITING", "DATA_FILE_MISSING"))
        .when(F.sha2("data_bytes", 256) != _manifest(m, "checksum_sha256"), r("REJECTED", "CHECKSUM_MISMATCH"))
        .when(F.col("_d").isNull(), r("REJECTED", "INVALID_DATA_JSON"))
        .when(~objects, r("REJECTED", "INVALID_DATA_STRUCTURE"))
        .when(F.size(rows) != declared, r("REJECTED", "ROW_COUNT_MISMATCH"))
        .otherwise(r("READY", "VERIFIED"))
    )
    # Out of an explode of one element: filters on what it yields are not moved below it, where all of this would be done again.
    out = df.withColumn("_r", result).select(*deliveries.columns, "_m", F.explode(F.array(F.struct(
        F.col("_r.state").alias("state"), F.col("_r.reason").alias("reason"), name.alias("filename"),
        declared.alias("declared_row_count"),
        F.when(objects & (F.col("_r.state") != "WAITING"), F.transform(rows, lambda x: F.to_json(x))).alias("rows")
    ))).alias("_found")).select(*deliveries.columns, "_m", "_found.*")
    return out.withColumns({f: _manifest(m, f) for f in fields if f != "filename"}).drop("_m")


def judged(gated: DataFrame) -> DataFrame:
    """Finished deliveries with their key and ``fault`` (null: sound); a bad one does not keep the others back.

    A delivery has a key if it is sound, or if its rows can be read and only its
    checksum or row count is wrong; its checksum is then that of the bytes received.
    """
    report = F.lower("report_type")
    entity = F.create_map(*[F.lit(x) for k, (e, _, _) in REPORTS.items() for x in (k, e)])[report]
    system = F.create_map(*[F.lit(x) for k, (_, s, _) in REPORTS.items() for x in (k, s)])[report]
    disagree = F.coalesce((F.col("entity_type") != entity) | (F.lower("source_system") != system), F.lit(True))
    no_date = F.col("report_date").try_cast("date").isNull() | (F.length("report_date") != 10)
    outside = F.rlike("filename", F.lit(r"(^|[/\\])\.\.?([/\\]|$)|[/\\]"))
    fault = (
        F.when(F.col("state") == "REJECTED", F.col("reason"))
        .when(disagree, "REPORT_ENTITY_SOURCE_DISAGREE")
        .when(no_date, "INVALID_REPORT_DATE")
        .when(outside, "FILENAME_OUTSIDE_INBOX")
    )
    df = gated.where("state <> 'WAITING'").withColumn("fault", fault)
    df = df.withColumns(
        {
            "report_type": report, "report_date": F.col("report_date").try_cast("date"),
            "manifest_checksum": F.sha2("manifest_bytes", 256)
        }
    )
    parts = (
        "source_system", "report_type", "report_date", "entity_type", "filename", "schema_version", "checksum_sha256",
        "manifest_checksum"
    )
    known = ~(disagree | no_date | outside) & F.col("rows").isNotNull()
    kept = F.col("fault").isNull() | (F.col("fault").isin("CHECKSUM_MISMATCH", "ROW_COUNT_MISMATCH") & known)
    df = df.withColumn("_kept", kept).withColumn("checksum_sha256", F.sha2("data_bytes", 256))
    return df.withColumn(
        "delivery_key", F.when(F.col("_kept"), delivery_key(*[F.col(c) for c in parts]))
    ).drop("_kept")


def verify(gated: DataFrame) -> DataFrame:
    """Sound deliveries with their key; raises where a finished one is not.  ``judged`` returns faults as rows instead."""
    df = judged(gated)
    bad = df.where("fault IS NOT NULL").select("stem", "fault").take(5)
    if bad:
        raise DeliveryError(f"bad deliveries: {[tuple(b) for b in bad]}")
    return df.drop("fault")


def ingest_ready(deliveries: DataFrame, ingest: Callable[[DataFrame], object]) -> DataFrame:
    """Hand the sound deliveries on; returns the findings for all (stem, state, reason)."""
    found = gate(deliveries)
    done = judged(found)
    ingest(done.where("fault IS NULL").drop("fault"))
    bad = done.where("fault IS NOT NULL").select("stem", F.lit("REJECTED").alias("_s"), F.col("fault").alias("_f"))
    return found.join(bad, "stem", "left").select(
        "stem", F.coalesce("_s", "state").alias("state"), F.coalesce("_f", "reason").alias("reason")
    )
