"""Failure records: class, wait and report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from metaloom.functions import text


def classify(failures: DataFrame, message: str = "message", stage: str = "detection") -> DataFrame:
    """Add reason, delay (seconds, for quota errors) to each failure."""
    given = F.col(message)
    return failures.withColumn("reason", text.failure_reason(given, stage)).withColumn(
        "delay", F.when(text.is_quota_error(given), text.retry_delay(given))
    )


def by_reason(classified: DataFrame) -> DataFrame:
    """Number of failures per reason with the reason's title.

    Counts only: the failures themselves stay rows (`report_rows`), since one reason may hold most of them.
    """
    return (
        classified.groupBy("reason")
        .agg(F.count("*").alias("n"))
        .withColumn("title", text.reason_title(F.col("reason")))
    )


def report_rows(classified: DataFrame, *keep: str) -> DataFrame:
    """The grouped report in long form, to be written in one folder per reason."""
    return classified.select("reason", text.reason_title(F.col("reason")).alias("title"), *keep)
