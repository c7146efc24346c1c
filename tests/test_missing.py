"""Missing values, odd values and arguments at their edges."""

import datetime as dt

import pytest
from featurespark import session
from featurespark.operators import assoc, charts, profile, regress, rolling, rows

NAN = float("nan")


def test_pearson_leaves_incomplete_pairs_out(spark):
    data = [(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (4.0, None), (NAN, 1.0), (None, 9.0)]
    df = spark.createDataFrame(data, "x double, y double")
    scores = {(r[0], r[1]): r[2] for r in assoc.corr_pairs(df, ["x", "y"]).collect()}
    assert scores["x", "y"] == scores["y", "x"] == 1.0


def test_logit_leaves_incomplete_rows_out(spark):
    data = [(float(i), int(i + i * 7 % 5 > 20)) for i in range(40)]
    whole = spark.createDataFrame(data, "x double, y int")
    gaps = data + [(float(i), None) for i in range(40)] + [(NAN, 1), (None, 0)]
    with_gaps = spark.createDataFrame(gaps, "x double, y int")
    a, b = (regress.logit_per_feature(d, "y", ["x"]).first() for d in (whole, with_gaps))
    assert b["n"] == 40
    assert b["z_value"] == pytest.approx(a["z_value"], rel=1e-9)
    with pytest.raises(ValueError, match="other than 0 and 1"):
        regress.logit_per_feature(spark.createDataFrame([(1.0, 2)], "x double, y int"), "y", ["x"])


def test_logit_of_many_predictors(spark):
    data = [tuple([*(float((i * (j + 3)) % 17) for j in range(70)), i % 2]) for i in range(60)]
    names = [f"x{j}" for j in range(70)]
    df = spark.createDataFrame(data, [*names, "y"])
    fits = regress.logit_per_feature(df, "y", names).collect()
    alone = regress.logit_per_feature(df, "y", ["x66"]).first()
    assert [r["feature"] for r in fits] == names
    assert fits[66]["z_value"] == pytest.approx(alone["z_value"], rel=1e-9)


def test_feature_label_split_keeps_rows(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, None, "b"), (3, 2.0, None)], "k int, x double, y string")
    assert rows.feature_label_split(df, "y", ["k"]).count() == 3
    assert rows.feature_label_split(df, "y", ["k"], missing="skip").count() == 2
    with pytest.raises(Exception, match="(?i)null"):
        rows.feature_label_split(df, "y", ["k"], missing="error").collect()


def test_stride_has_one_schema(spark):
    df = spark.range(5).withColumnRenamed("id", "k")
    got = [rows.stride_sample(df, ["k"], step) for step in (1, 2)]
    assert got[0].columns == got[1].columns == ["k", "row_index"]
    assert [g.count() for g in got] == [5, 3]


def test_latest_rows_are_ordered_either_way(spark, monkeypatch):
    day = dt.date(2020, 1, 1)
    data = [(i, i % 3, 1, 2, day + dt.timedelta(i)) for i in range(30)]
    data += [(30, None, 1, 2, day), (31, 1, 1, 2, None)]
    facts = spark.createDataFrame(data, "game_id int, batter int, hit int, atbat int, local_date date")
    few = rolling.rolling_avg_latest(facts, limit=12).collect()
    monkeypatch.setattr(rolling, "LOCAL_ROWS", 5)
    assert rolling.rolling_avg_latest(facts, limit=12).collect() == few
    assert [r["game_id"] for r in few] == list(range(31, 19, -1))


def test_rolling_reads_the_facts_once(spark):
    facts = spark.createDataFrame(
        [(1, 1, 1, 2, dt.date(2020, 1, 1)), (2, None, 1, 1, dt.date(2020, 1, 2))],
        "game_id int, batter int, hit int, atbat int, local_date date",
    )
    got = {r["game_id"]: r["last_100_days_atbats"] for r in rolling.rolling_avg(facts).collect()}
    assert got == {1: 0, 2: 0}


def test_box_keeps_the_null_group(spark):
    data = [("a", float(i)) for i in range(5)] + [(None, float(i)) for i in range(4)]
    df = spark.createDataFrame(data, "g string, x double")
    got = {r["g"]: r["q2"] for r in charts.box(df, "g", "x").collect()}
    assert got == {"a": 2.0, None: 1.5}


ODD = ["a.b", "A", "a", "`", "", "x", "y", "n", "null"]


def test_crosstab_of_odd_values(spark):
    df = spark.createDataFrame([(i % 2, v) for i, v in enumerate(ODD)], "x int, y string")
    got = {(r["x"], r["y"]): (r["n"], r["x_total"], r["y_total"]) for r in profile.crosstab(df, "x", "y").collect()}
    assert len(got) == 2 * len(ODD)
    assert all(got[i % 2, v] == (1, 5 - i % 2, 1) and got[1 - i % 2, v][0] == 0 for i, v in enumerate(ODD))


@pytest.mark.parametrize("kind", ["date", "double", "boolean", "decimal(5,2)"])
def test_crosstab_of_other_types(spark, kind):
    df = spark.sql(f"SELECT 'r' AS x, CAST(v AS {kind}) AS y FROM VALUES "
                   + ("('2020-01-02'), ('2020-01-03')" if kind == "date" else "('1'), ('0')") + " AS t(v)")
    assert {r["n"] for r in profile.crosstab(df, "x", "y").collect()} == {1}
    assert profile.crosstab_wide(df, "x", "y").first()[1:] == (1, 1)


def test_crosstab_wide_names(spark):
    df = spark.createDataFrame([("r", "a.b"), ("r", "`"), ("s", None)], "x string, y string")
    wide = profile.crosstab_wide(df, "x", "y")
    assert set(wide.columns) == {"x", "a.b", "`", "null"}
    assert {tuple(sorted(r.asDict().items())) for r in wide.collect()} == {
        (("`", 1), ("a.b", 1), ("null", 0), ("x", "r")),
        (("`", 0), ("a.b", 0), ("null", 1), ("x", "s")),
    }
    for values in (["A", "a"], ["x", "b"]):
        clash = spark.createDataFrame([("r", v) for v in values], "x string, y string")
        with pytest.raises(ValueError, match="clash"):
            profile.crosstab_wide(clash, "x", "y")
    many = spark.range(4).selectExpr("'r' AS x", "id AS y")
    with pytest.raises(ValueError, match="more than 3"):
        profile.crosstab_wide(many, "x", "y", max_values=3)
    assert profile.crosstab(many, "x", "y").count() == 4


def test_side_is_bounded_by_bytes(spark, monkeypatch):
    df = spark.range(4).selectExpr("id", "repeat('x', 1000) AS wide")
    monkeypatch.setattr(session, "LOCAL_BYTES", 2000)
    written = session.bounded_side(df)
    assert written.inputFiles() and written.count() == 4
    monkeypatch.setattr(session, "LOCAL_BYTES", 1 << 20)
    assert not session.bounded_side(df).inputFiles()


def scans(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_inputs_are_read_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(50).selectExpr("id % 3 AS c", "CAST(id AS DOUBLE) AS x").write.parquet(path)
    df = spark.read.parquet(path)
    counts = profile.class_counts(df, "c")
    counts.collect()
    assert scans(counts) == 0
    binary = rows.binarize(df, "c")
    binary.collect()
    # Both values come from one subquery, which its other uses share.
    assert "ReusedSubquery" in binary._jdf.queryExecution().executedPlan().toString()
