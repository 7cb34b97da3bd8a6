"""E-mail syntax check as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the accepted shape of an address. One newline may follow, hence
# no bare "$", which in Java would also accept other line ends.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\n?\z"


def is_valid_email(email: Column) -> Column:
    """True for a well-formed address, false otherwise and for null."""
    return F.coalesce(email.rlike(EMAIL_PATTERN), F.lit(False))
