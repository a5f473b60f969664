"""Text tables at the edge: feature, prediction and history CSVs, changed sets, JSON arrays, summaries.

Inside the engine tables are typed Parquet; these readers and writers are for exchange. Schemas are
given, never inferred, so that ids keep their zeros and scores stay doubles. Paths are those of any file system that Spark knows.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickloom.functions.expressions import text_or_null
from clickloom.operators.publish import score_text
from clickloom.operators.scoring import SCORES

from . import files

PREDICTIONS = "session_id string, " + ", ".join(f"{c} string" for c in SCORES)
LOG_COLUMNS = ["date", "device_type", "session_id", *SCORES, "ip", "user_agent"]


def read_json_array(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Rows of a file that holds one JSON array; empty where there is no readable file."""
    if not files.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").json(path)


def read_features(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """session_id and `columns` as doubles; empty where there is no file."""
    schema = "session_id string, " + ", ".join(f"`{c}` double" for c in columns)
    if not files.exists(spark, path):
        return spark.createDataFrame([], schema)
    header = spark.read.option("header", True).csv(path)
    return header.select(F.col("session_id"), *(F.expr(f"try_cast(`{c}` as double)").alias(c) if c in header.columns else F.lit(None).cast("double").alias(c) for c in columns))


def read_predictions(spark: SparkSession, path: str, required: bool = False) -> DataFrame:
    """session_id and both scores; missing score columns, empty text and the spellings of nothing are NULL."""
    if not files.exists(spark, path):
        if required:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], PREDICTIONS).withColumns({c: F.col(c).cast("double") for c in SCORES})
    raw = spark.read.option("header", True).csv(path)
    if "session_id" not in raw.columns:
        raise ValueError("predictions without session_id")
    return raw.select("session_id", *(text_or_null(F.col(c)).cast("double").alias(c) if c in raw.columns else F.lit(None).cast("double").alias(c) for c in SCORES))


def read_history(spark: SparkSession, folder: str) -> DataFrame:
    """All predictions_*.csv of a folder, with `file`; order (file, date) is that of the history."""
    if not any(re.fullmatch(r"predictions_.*\.csv", n) for n in files.names(spark, folder)):
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in [*LOG_COLUMNS, "file"]))
    raw = spark.read.option("header", True).csv(f"{folder}/predictions_*.csv").withColumn("file", F.col("_metadata.file_name"))
    return raw.select(*(F.col(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in [*LOG_COLUMNS, "file"]))


def read_changed(spark: SparkSession, path: str) -> tuple[DataFrame | None, bool]:
    """(changed sessions, full rebuild) of a document {full_rebuild, session_ids} or a bare list; (None, True) if unreadable.

    The ids stay in the document's row; null ones are left out.
    """
    if not files.exists(spark, path):
        return None, True
    body = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"))
    listed = F.coalesce(F.try_variant_get("v", "$", "array<string>"), F.try_variant_get("v", "$.session_ids", "array<string>"))
    found = body.select(listed.alias("ids"), F.coalesce(F.try_variant_get("v", "$.full_rebuild", "boolean"), F.lit(False)).alias("full"))
    head = found.select(F.col("ids").isNotNull().alias("good"), "full").first()
    if head is None or not head["good"]:
        return None, True
    return found.select(F.explode("ids").alias("session_id")).where("session_id is not null"), head["full"]


def write_changed(changed: DataFrame, path: str, full: bool = False) -> None:
    """The set in order. It names the sessions of one run of one device; at scale it stays a table, see `write_table`."""
    ids = [r[0] for r in changed.select("session_id").distinct().orderBy("session_id").toLocalIterator()]
    files.write(changed.sparkSession, path, json.dumps({"full_rebuild": full, "session_ids": ids}))


def write_table(df: DataFrame, path: str, by: str | None = None) -> None:
    """Parquet, overwritten, with partitions by a column such as device_type or site_id."""
    w = df.write.mode("overwrite")
    (w.partitionBy(by) if by else w).parquet(path)


def write_csv(df: DataFrame, path: str, order: str = "session_id") -> None:
    """One file with a header, in order; scores with ten significant digits. Only for exports that fit one task."""
    text = df.withColumns({c: score_text(F.col(c)) for c in SCORES if c in df.columns})
    text.orderBy(order).coalesce(1).write.mode("overwrite").option("header", True).option("emptyValue", "").option("nullValue", "").csv(path)


def write_delta(df: DataFrame, path: str) -> bool:
    """The changed rows as CSV; without any the old export goes. Returns whether there are rows."""
    some = not df.isEmpty()
    if some:
        write_csv(df, path)
    else:
        files.delete(df.sparkSession, path)
    return some


def write_summary(summary: DataFrame, path: str) -> dict:
    """The one row of metrics as a JSON document."""
    body = summary.first().asDict()
    files.write(summary.sparkSession, path, json.dumps(body))
    return body
