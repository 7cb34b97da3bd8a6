import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.session import shared_folder
from tidemark.sources import tables as tables_module
from tidemark.sources.tables import GOLD, Warehouse, date_spine, spine_of


@pytest.fixture
def days(spark):
    rows = [(dt.date(2024, 1, 1 + n % 2), n) for n in range(10)] + [(None, 99)]
    return spark.createDataFrame(rows, "day date, n int")


def test_save_replaces_and_reads_back(spark, tmp_path, days):
    tables = Warehouse(spark, str(tmp_path))
    tables.save(days, GOLD, "numbers")
    stored = tables.save(days.filter("n > 3"), GOLD, "numbers")
    assert sorted(row["n"] for row in stored.collect()) == [4, 5, 6, 7, 8, 9, 99]


def test_partitioned_table(spark, tmp_path, days):
    tables = Warehouse(spark, str(tmp_path))
    stored = tables.save(days, GOLD, "by_day", ("day",))
    assert len(list((tmp_path / "gold" / "by_day" / "data" / "_version=1").glob("day=*"))) == 3
    assert stored.filter("day IS NULL").first()["n"] == 99
    one_day = stored.filter("day = DATE '2024-01-01'")
    assert one_day.count() == 5
    assert "PartitionFilters: [isnotnull(day" in one_day._jdf.queryExecution().toString()
    tables.register_table(GOLD, "by_day")
    assert spark.table("gold.by_day").count() == 11


def test_an_interrupted_writer_leaves_the_table_as_it_was(spark, tmp_path, days, monkeypatch):
    tables = Warehouse(spark, str(tmp_path))
    before = tables.save(days, GOLD, "numbers")

    def lost(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as between_write_and_commit:
        between_write_and_commit.setattr(Warehouse, "_commit", lost)
        with pytest.raises(RuntimeError):
            tables.save(days.limit(2), GOLD, "numbers")
    with monkeypatch.context() as while_committing:
        while_committing.setattr(tables_module.Snapshot, "text", lost)
        with pytest.raises(RuntimeError):
            tables.append(days.limit(2), GOLD, "numbers")
    assert (tmp_path / "gold/numbers/data/_version=2").exists()  # nobody names it
    assert before.count() == tables.read(GOLD, "numbers").count() == 11
    assert tables.save(days.filter("n > 3"), GOLD, "numbers").count() == 7
    assert before.count() == 11  # a reader of the older version still has its files
    tables.save(tables.read(GOLD, "numbers").filter("n < 99"), GOLD, "numbers")  # read and replaced at once
    tables.expire(GOLD, "numbers", keep=1)
    assert tables.read(GOLD, "numbers").count() == 6
    assert [p.name for p in (tmp_path / "gold/numbers/data").iterdir()] == ["_version=3"]


def test_two_writers_do_not_replace_each_other(spark, tmp_path, days):
    tables = Warehouse(spark, str(tmp_path))
    tables.save(days, GOLD, "numbers")
    with pytest.raises(Exception, match="already exists"):
        tables._commit(GOLD, "numbers", tables.snapshot(GOLD, "numbers"))


def test_appended_rows_and_declared_columns(spark, tmp_path, days):
    tables = Warehouse(spark, str(tmp_path))
    schema = days.schema
    tables.declare(GOLD, "numbers", schema)
    assert tables.read(GOLD, "numbers").count() == 0 and tables.read(GOLD, "numbers").schema == schema
    tables.append(days, GOLD, "numbers", {"from": "a"})
    version = tables.snapshot(GOLD, "numbers").version
    assert tables.added_since(GOLD, "numbers", version).count() == 0
    tables.append(days.limit(3), GOLD, "numbers")
    assert tables.read(GOLD, "numbers").count() == 14
    assert tables.added_since(GOLD, "numbers", version).count() == 3
    assert tables.added_since(GOLD, "numbers", 0) is None
    assert tables.snapshot(GOLD, "numbers").notes == {"from": "a"}

    wider = schema.jsonValue()
    wider["fields"].insert(0, {"name": "note", "type": "string", "nullable": True, "metadata": {}})
    tables.declare(GOLD, "numbers", type(schema).fromJson(wider))
    tables.append(spark.sql("SELECT 'x' AS note, DATE '2024-01-05' AS day, 1 AS n"), GOLD, "numbers")
    table = tables.read(GOLD, "numbers")
    assert table.columns == ["note", "day", "n"] and table.count() == 15
    assert table.filter("note IS NULL").count() == 14
    tables.save(days, GOLD, "numbers")
    assert tables.added_since(GOLD, "numbers", version) is None  # rows were replaced


def test_replaced_days(spark, tmp_path, days):
    tables = Warehouse(spark, str(tmp_path))
    tables.save(days, GOLD, "by_day", ("day",))
    first, new = dt.date(2024, 1, 1), dt.date(2024, 1, 9)
    tables.replace_days(
        spark.createDataFrame([(first, 1000), (new, 2000)], days.schema), GOLD, "by_day", [first, new, None]
    )
    table = tables.read(GOLD, "by_day")
    rows = sorted(tuple(r) for r in table.collect())
    other = dt.date(2024, 1, 2)
    assert rows == sorted([(first, 1000), (new, 2000), *((other, n) for n in (1, 3, 5, 7, 9))])
    parts = tables.snapshot(GOLD, "by_day").parts
    assert sorted(p.split("/")[0] for p in parts) == ["_version=1", "_version=2", "_version=2"]
    assert "PartitionFilters: [isnotnull(day" in table.filter("day = DATE '2024-01-02'")._jdf.queryExecution().toString()
    tables.expire(GOLD, "by_day", keep=1)
    assert tables.read(GOLD, "by_day").count() == 7
    assert len(list((tmp_path / "gold/by_day/data/_version=1").glob("day=*"))) == 1
    tables.register_table(GOLD, "by_day")  # of one version again
    assert spark.table("gold.by_day").count() == 7


def test_spine_of_rows(spark, days):
    found = spine_of(days, F.col("day"), F.date_add("day", 2))
    assert [r[0].day for r in found.orderBy("spine_date").collect()] == [1, 2, 3, 4]
    assert spine_of(days.filter("day IS NULL"), F.col("day"), F.col("day")).count() == 0
    assert spine_of(days, F.col("day"), F.lit(dt.date(2023, 1, 1))).count() == 0


def test_sql_over_stored_tables(spark, tmp_path, days):
    tables = Warehouse(spark, str(tmp_path))
    tables.save(days, GOLD, "numbers")
    tables.register_view(GOLD, "numbers")
    assert spark.sql("SELECT count(*) FROM numbers").first()[0] == 11
    spark.catalog.dropTempView("numbers")

    tables.register_table(GOLD, "numbers", "some numbers", {"made.by": "it's us"})
    assert spark.table("gold.numbers").count() == 11
    described = {
        row["col_name"]: row["data_type"]
        for row in spark.sql("DESCRIBE TABLE EXTENDED gold.numbers").collect()
    }
    assert described["Comment"] == "some numbers"
    assert "made.by=it's us" in described["Table Properties"]
    tables.register_table(GOLD, "numbers")


def test_date_spine(spark):
    days = [row[0] for row in date_spine(spark, dt.date(2024, 2, 28), dt.date(2024, 3, 1)).collect()]
    assert [day.isoformat() for day in days] == [
        "2024-02-28", "2024-02-29", "2024-03-01",
    ]
    with pytest.raises(ValueError):
        date_spine(spark, dt.date(2024, 1, 2), dt.date(2024, 1, 1))


def test_shared_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark), shared_folder(spark)
    assert first.startswith(base) and first != second
