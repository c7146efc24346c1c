import datetime as dt
import os

import pytest
from featurespark import session
from featurespark.sources import files, jdbc, tables


def test_csv_skips_blank_lines_and_fails_on_bad_numbers(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("5.1,3.5,a\n4.9,3.0,b\n\n")
    got = files.scan_csv(spark, str(path), "x double, y double, c string").collect()
    assert [tuple(r) for r in got] == [(5.1, 3.5, "a"), (4.9, 3.0, "b")]
    path.write_text("5.1,oops,a\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|oops"):
        files.scan_csv(spark, str(path), "x double, y double, c string").collect()


def test_tsv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b", None), (2, "c", 0.5)], "k int, s string, x double")
    files.write_tsv(df, str(tmp_path / "out"))
    lines = [p.read_text().splitlines() for p in (tmp_path / "out").glob("part-*")]
    assert all(part[0] == "k\ts\tx" for part in lines)
    got = files.scan_tsv(spark, str(tmp_path / "out"), df.schema)
    assert sorted(got.collect()) == sorted(df.collect())


def test_append_keeps_types(spark):
    empty = tables.empty_table(spark, "game_id int, local_date date")
    more = spark.createDataFrame([(dt.date(2020, 1, 1), 5)], "local_date date, game_id long")
    got = tables.append_rows(empty, more)
    assert got.schema.simpleString() == "struct<game_id:int,local_date:date>"
    assert got.collect() == [(5, dt.date(2020, 1, 1))]


def test_materialised_tables(spark, tmp_path):
    three, five = spark.range(3), spark.range(5)
    path = str(tmp_path / "t")
    assert tables.create_table_if_absent(three, "t_absent", path).count() == 3
    assert tables.create_table_if_absent(five, "t_absent", path).count() == 3
    assert tables.replace_table(five, "t_absent", path).count() == 5
    spark.sql("DROP TABLE t_absent")


def test_preview_is_a_top_k(spark):
    df = tables.preview(tables.register_view(spark.range(100), "hundred"), ["id"], 3)
    assert [r["id"] for r in df.collect()] == [0, 1, 2]


def test_jdbc_options():
    options = jdbc.jdbc_options(
        "jdbc:x", table="t", partition_column="id", bounds=(0, 100), num_partitions=4
    )
    assert options == {
        "url": "jdbc:x", "dbtable": "t", "fetchsize": "10000", "partitionColumn": "id",
        "lowerBound": "0", "upperBound": "100", "numPartitions": "4",
    }
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x", table="t", query="q")
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x", query="q", partition_column="id")


def test_scratch_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    first, second = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert first.startswith(f"{folder}/x-") and second.startswith(f"{folder}/x-")
    assert first != second


def test_bounded_side(spark):
    small = session.bounded_side(spark.range(10), max_rows=10)
    assert small.count() == 10 and small.isLocal()
    large = session.bounded_side(spark.range(11), max_rows=10)
    assert large.count() == 11 and not large.isLocal()


def test_scratch_tables_are_removed(spark):
    with session.scratch_tables(spark):
        table = session.materialize(spark.range(3), "removed")
        files = table.inputFiles()
        assert table.count() == 3
    assert files and not any(os.path.exists(f.removeprefix("file:").removeprefix("//")) for f in files)
    assert session.materialize(spark.range(3), "kept").count() == 3


def test_readers_see_whole_versions(spark, tmp_path):
    path = str(tmp_path / "published")
    with pytest.raises(ValueError, match="nothing is published"):
        tables.published(spark, path)
    assert tables.publish(spark.range(3), path).count() == 3
    # A run that fails half way leaves the old version.
    bad = spark.range(2000).repartition(4).selectExpr("IF(id = 1999, raise_error('lost'), id) AS id")
    with pytest.raises(Exception, match="lost"):
        tables.publish(bad, path)
    assert sorted(r[0] for r in tables.published(spark, path).collect()) == [0, 1, 2]
    # A table may be made from its own old version.
    grown = tables.published(spark, path).union(spark.range(10, 12))
    assert tables.publish(grown, path).count() == 5
    assert tables.publish(spark.range(1), path, replace=False).count() == 5
    assert tables.published(spark, path).count() == 5


def test_the_first_writer_wins(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "raced")
    plain = tables._pointer
    calls = []

    def raced(spark_, path_):
        # Another writer publishes after this one has looked.
        calls.append(path_)
        if len(calls) == 1:
            found = plain(spark_, path_)
            tables.publish(spark_.range(7), path_)
            return found
        return plain(spark_, path_)

    monkeypatch.setattr(tables, "_pointer", raced)
    assert tables.publish(spark.range(2), path, replace=False).count() == 7
    assert len([p for p in (tmp_path / "raced").iterdir() if p.name.startswith("version-")]) == 1
