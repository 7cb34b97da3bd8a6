"""User directory reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.email import is_valid_email


def users(source: DataFrame) -> DataFrame:
    return source.select("user_id", "email", "name", "user_type")


def email_validity_by_user_type(directory: DataFrame) -> DataFrame:
    """Users and well-formed addresses per user type."""
    return directory.groupBy("user_type").agg(
        F.count("user_id").alias("total_count"),
        F.count_if(is_valid_email(F.col("email"))).alias("count_valid_emails"),
    )


def user_type_counts(directory: DataFrame) -> DataFrame:
    """Rows per user type, in SQL; the group without a type counts zero."""
    return directory.sparkSession.sql(
        "SELECT user_type, COUNT(user_type) AS total_count FROM {directory} GROUP BY user_type",
        directory=directory,
    )
