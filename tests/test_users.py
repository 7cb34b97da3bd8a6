import re

import pytest
from frames import by
from pyspark.sql import functions as F

from tidemark.functions.email import is_valid_email
from tidemark.operators import users


@pytest.fixture
def directory(spark):
    return users.users(
        spark.createDataFrame(
            [
                (1, "a@b.co", "A", "host", 0),
                (2, "bad", "B", "host", 0),
                (3, None, "C", "guest", 0),
                (None, "d@e.org", "D", "guest", 0),
                (5, "f@g.net", "F", None, 0),
            ],
            "user_id int, email string, name string, user_type string, other int",
        )
    )


def test_projection(directory):
    assert directory.columns == ["user_id", "email", "name", "user_type"]


def test_email_shapes(spark):
    pattern = re.compile(r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$")
    emails = ["a@b.co", "a.b+c%d-e_f@x-y.z.info", "a@b", "a@b.c", "@b.co", "a b@c.de", "", "é@b.co",
              "a@b.co\n", "a@b.co\r", "a@b.co\n\n", " a@b.co", "a@@b.co"]
    df = spark.createDataFrame([(e,) for e in emails], "email string")
    found = df.select("email", is_valid_email(F.col("email")).alias("ok")).collect()
    assert {row["email"]: row["ok"] for row in found} == {
        email: pattern.match(email) is not None for email in emails
    }
    null = spark.sql("SELECT CAST(NULL AS STRING) AS email")
    assert null.select(is_valid_email(F.col("email"))).first()[0] is False


def test_valid_emails_per_type(directory):
    found = by(users.email_validity_by_user_type(directory), "user_type")
    assert {key: tuple(row.values())[1:] for key, row in found.items()} == {
        "host": (2, 1),
        "guest": (1, 1),
        None: (1, 1),
    }


def test_counts_per_type(directory):
    found = by(users.user_type_counts(directory), "user_type")
    assert {key: row["total_count"] for key, row in found.items()} == {
        "host": 2,
        "guest": 2,
        None: 0,
    }
