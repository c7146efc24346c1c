import datetime as dt
import random
import statistics

import pytest
from featurespark.operators import rolling
from pyspark.sql import functions as F

FACTS = "game_id int, batter int, hit int, atbat int, local_date date"


def facts(spark, rows):
    parsed = [(g, b, h, a, d and dt.date.fromisoformat(d)) for g, b, h, a, d in rows]
    return spark.createDataFrame(parsed, FACTS)


@pytest.fixture(scope="module")
def three_days(spark):
    return facts(
        spark,
        [
            (1, 1, 1, 1, "2020-01-01"),
            (2, 1, 2, 2, "2020-04-09"),
            (3, 1, 4, 4, "2020-04-10"),
        ],
    )


def hits(df):
    return {r["game_id"]: r["last_100_days_hits"] for r in df.collect()}


def test_strict_window_leaves_out_both_ends(three_days):
    assert hits(rolling.rolling_avg(three_days)) == {1: 0, 2: 1, 3: 2}
    assert hits(rolling.rolling_avg_latest(three_days)) == {1: 0, 2: 1, 3: 2}


def test_pair_sums_count_closed_windows(three_days):
    assert rolling.rolling_pair_sums(three_days).collect() == [(1, 11, 11)]


def test_rows_of_one_day(spark):
    df = facts(spark, [(1, 1, 1, 1, "2020-01-01"), (2, 1, 2, 2, "2020-01-01")])
    assert hits(rolling.rolling_avg(df)) == {1: 0, 2: 0}
    assert rolling.rolling_pair_sums(df).first()["sum_hits"] == 6


def test_rows_without_batter_or_date_keep_zero(spark):
    df = facts(
        spark,
        [
            (1, None, 5, 5, "2020-01-01"),
            (2, None, 5, 5, "2020-01-02"),
            (3, 1, 5, 5, None),
            (4, 1, 5, 5, "2020-01-01"),
            (5, 1, None, None, "2020-01-02"),
        ],
    )
    want = {1: 0, 2: 0, 3: 0, 4: 0, 5: 5}
    assert hits(rolling.rolling_avg(df)) == want
    assert hits(rolling.rolling_avg_latest(df)) == want


def test_instants_are_open_to_the_microsecond(spark):
    rows = [
        (1, 1, 1, 1, dt.datetime(2020, 1, 1, 10)),
        (2, 1, 2, 2, dt.datetime(2020, 4, 10, 9, 59, 59)),
        (3, 1, 4, 4, dt.datetime(2020, 4, 10, 10)),
        (4, None, 8, 8, dt.datetime(2020, 4, 10, 10)),
        (5, 1, 8, 8, None),
    ]
    df = spark.createDataFrame(rows, FACTS.replace("date date", "date timestamp"))
    assert hits(rolling.rolling_avg_instants(df)) == {1: 0, 2: 1, 3: 2, 4: 0, 5: 0}


def test_rewrites_equal_the_joins_they_replace(spark):
    rng = random.Random(7)
    start = dt.date(2020, 1, 1)
    rows = []
    for g in range(600):
        batter = 0 if rng.random() < 0.4 else rng.randrange(1, 12)
        day = start + dt.timedelta(days=rng.randrange(400))
        rows.append((g, batter, rng.randrange(5), rng.randrange(5, 9), day))
    df = spark.createDataFrame(rows, FACTS)
    strict = {}
    pairs = {}
    for g, b, _, _, d in rows:
        strict[g] = sum(h for _, b2, h, _, d2 in rows if b2 == b and 0 < (d - d2).days < 100)
        closed = sum(h for _, b2, h, _, d2 in rows if b2 == b and 0 <= (d - d2).days <= 100)
        pairs[b] = pairs.get(b, 0) + closed
    assert hits(rolling.rolling_avg(df)) == strict
    latest = sorted(strict, reverse=True)[:100]
    assert hits(rolling.rolling_avg_latest(df)) == {g: strict[g] for g in latest}
    assert hits(rolling.rolling_avg_latest(df, limit=30_000)) == strict
    instants = df.withColumn("local_date", F.col("local_date").cast("timestamp"))
    assert hits(rolling.rolling_avg_instants(instants)) == strict
    got = {r["batter"]: r["sum_hits"] for r in rolling.rolling_pair_sums(df).collect()}
    assert got == pairs
    df.createOrReplaceTempView("test_facts")
    sql = rolling.ROLLING_PAIR_SUMS_SQL.format(view="test_facts", days=100)
    assert {r["batter"]: r["sum_hits"] for r in spark.sql(sql).collect()} == pairs


def test_ratio_column(spark):
    rows = [(1, 1, 3), (2, 1, 0), (3, 1, None), (4, 1, -2), (5, 869, 2000)]
    df = spark.createDataFrame(rows, "batter int, hit int, atbat int")
    got = {r["batter"]: r["average"] for r in rolling.historic_avg(df).collect()}
    text = {k: None if v is None else str(v) for k, v in got.items()}
    assert text == {1: "0.333", 2: "0.000", 3: None, 4: None, 5: "0.435"}


@pytest.mark.parametrize(
    ("end", "inside", "outside"),
    [("2008-12-31", "2007-12-31", "2007-12-30"), ("2008-02-29", "2007-02-28", "2007-02-27")],
)
def test_annual_range_is_closed(spark, end, inside, outside):
    bc = spark.createDataFrame(
        [(1, 1, 1, 2), (2, 1, 1, 2), (3, 1, 1, 2)], "game_id int, batter int, hit int, atbat int"
    )
    days = [(1, end), (2, inside), (3, outside)]
    games = spark.createDataFrame(days, "game_id int, d string").select(
        "game_id", F.col("d").cast("date").alias("local_date")
    )
    assert rolling.annual_avg(bc, games, end).first()["total_hits"] == 2


def test_target_game(spark):
    bc = spark.createDataFrame(
        [(9, 1, 1, 2), (9, 2, 0, 0), (8, 1, 1, 2), (7, 1, 9, 9), (8, 3, 5, 5)],
        "game_id int, batter int, hit int, atbat int",
    )
    days = [(9, "2011-04-04"), (8, "2010-12-25"), (7, "2010-12-24")]
    games = spark.createDataFrame(days, "game_id int, d string").select(
        "game_id", F.col("d").cast("date").alias("local_date")
    )
    got = [tuple(r) for r in rolling.target_game_avg(bc, games, 9).collect()]
    assert got == [(1, 0.5), (2, None)]


def test_window_medians_and_games(spark):
    rng = random.Random(8)
    start = dt.date(2020, 1, 1)
    rows = [(rng.randrange(30), rng.choice([1, 1, 1, 2, None]), rng.choice([None, 0, 1, 2, 5, 9]), 1,
             rng.choice([None, *(start + dt.timedelta(days=rng.randrange(40)) for _ in range(9))])) for _ in range(400)]
    df = spark.createDataFrame(rows, "game_id int, batter int, hit int, atbat int, local_date date")
    got = {(r["batter"], r["local_date"]): (r["median_hits"], r["n_games"]) for r in rolling.rolling_window_stats(df, 6).collect()}
    want = {}
    for _, b, _, _, d in rows:
        if b is not None and d is not None:
            seen = [r for r in rows if r[1] == b and r[4] and d - dt.timedelta(days=6) <= r[4] <= d]
            hits = [r[2] for r in seen if r[2] is not None]
            want[b, d] = (statistics.median(hits) if hits else None, len({r[0] for r in seen}))
    assert got == want


def test_band_join_is_an_equi_join(spark):
    ends = spark.createDataFrame([(1, dt.date(2020, 1, 1))], "batter int, local_date date")
    seen = spark.createDataFrame([(1, dt.date(2019, 12, 31), 3)], "batter int, right_day date, hit int")
    joined = rolling.band_join(ends, seen, "batter", "local_date", 100)
    plan = joined._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "_span" in plan and joined.count() == 1


def test_window_stats_move_no_pairs(spark, monkeypatch):
    """A hundred days that each see a hundred others: no row is made for each pair."""

    def refused(*_):
        raise AssertionError("days and facts meet pair by pair")

    monkeypatch.setattr(rolling, "band_join", refused)
    start = dt.date(2020, 1, 1)
    rows = [(i, i % 3, i % 7, 1, start + dt.timedelta(days=i // 3)) for i in range(300)]
    # Seen again inside its window, and after it.
    rows += [(0, 0, None, 1, start + dt.timedelta(days=d)) for d in (50, 98)] + [(0, 9, 4, 1, d) for d in (start, start + dt.timedelta(days=400))]
    df = spark.createDataFrame(rows, "game_id int, batter int, hit int, atbat int, local_date date")
    got = {(r["batter"], r["local_date"]): (r["median_hits"], r["n_games"]) for r in rolling.rolling_window_stats(df, 60).collect()}
    assert len(got) == 302
    for (b, d), found in got.items():
        seen = [r for r in rows if r[1] == b and d - dt.timedelta(days=60) <= r[4] <= d]
        hits = [r[2] for r in seen if r[2] is not None]
        assert found == (statistics.median(hits) if hits else None, len({r[0] for r in seen}))
