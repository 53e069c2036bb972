"""Job log files as a table.

Lines read ``time | LEVEL | logger | message | Context: {json}``; ERROR and DEBUG lines
carry an extra ``function:line`` field before the message, which starts with ``[TAG]``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- Fixed values: layout of a log line -----------------------------------------------
FIELD_END = r" \| "
CONTEXT_START = " | Context: "
PLACED_LEVELS = ("DEBUG", "ERROR")
TAG = r"^\[([A-Z]+)\]"


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    return parse_lines(spark.read.text(path))


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row per log record; stack-trace and other continuation lines are left out."""
    head = F.split(column, FIELD_END, 4)  # time, level, logger, the rest
    when = F.replace(F.get(head, F.lit(0)), F.lit(","), F.lit(".")).try_cast("timestamp_ntz")
    records = lines.select(
        when.alias("logged_at"),
        F.rtrim(F.get(head, F.lit(1))).alias("level"),
        F.rtrim(F.get(head, F.lit(2))).alias("logger"),
        F.get(head, F.lit(3)).alias("rest"),
    ).filter("logged_at is not null and rest is not null")

    placed = F.col("level").isin(*PLACED_LEVELS)
    body = F.split("rest", FIELD_END, 2)  # function:line, message
    place = F.when(placed, F.split(F.get(body, F.lit(0)), ":"))
    text = F.when(placed, F.get(body, F.lit(1))).otherwise(F.col("rest"))
    split_text = records.select(
        "logged_at",
        "level",
        "logger",
        F.rtrim(F.get(place, F.lit(0))).alias("function"),
        F.rtrim(F.get(place, F.lit(1))).try_cast("int").alias("line"),
        text.alias("text"),
    )
    message = F.substring_index("text", CONTEXT_START, 1)
    has_context = F.contains("text", F.lit(CONTEXT_START))
    return split_text.select(
        "logged_at",
        "level",
        "logger",
        "function",
        "line",
        message.alias("message"),
        F.when(has_context, F.from_json(F.substring_index("text", CONTEXT_START, -1), "map<string,string>")).alias(
            "context"
        ),
        F.nullif(F.regexp_extract(message, TAG, 1), F.lit("")).alias("tag"),
    )


def records_by_tag(records: DataFrame) -> DataFrame:
    """Records per day, level and tag."""
    return records.groupBy(F.to_date("logged_at").alias("day"), "level", "tag").agg(F.count("*").alias("records"))
