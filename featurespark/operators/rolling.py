"""Historic, annual and rolling ratio metrics over (game, batter) facts.

``bc`` has ``game_id, batter, hit, atbat``; ``games`` has ``game_id, local_date``.
Rolling sums are additive, so facts are first reduced to one row per (batter, day). A window
partition then holds at most one row per calendar day, however many facts a batter has.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from featurespark.functions.ratio import plain_ratio, ratio_3
from featurespark.session import LOCAL_ROWS

DAY_MICROS = 86_400_000_000


def fact_join(bc: DataFrame, games: DataFrame) -> DataFrame:
    return bc.select("game_id", "batter", "hit", "atbat").join(
        games.select("game_id", "local_date"), "game_id"
    )


def _totals() -> list[Column]:
    return [F.sum("hit").alias("total_hits"), F.sum("atbat").alias("total_at_bats")]


def historic_avg(bc: DataFrame) -> DataFrame:
    out = bc.groupBy("batter").agg(*_totals())
    return out.withColumn("average", ratio_3(F.col("total_hits"), F.col("total_at_bats")))


def annual_avg(bc: DataFrame, games: DataFrame, year_end: dt.date | str) -> DataFrame:
    """Totals over the closed range from one year before ``year_end`` up to ``year_end``."""
    spark = bc.sparkSession
    out = spark.sql(
        """
        SELECT batter, SUM(hit) AS total_hits, SUM(atbat) AS total_at_bats
        FROM {bc} JOIN {games} USING (game_id)
        WHERE local_date BETWEEN add_months(CAST(:year_end AS DATE), -12)
                             AND CAST(:year_end AS DATE)
        GROUP BY batter
        """,
        args={"year_end": str(year_end)},
        bc=bc,
        games=games,
    )
    return out.withColumn(
        "annual_batting_average", ratio_3(F.col("total_hits"), F.col("total_at_bats"))
    )


def _daily(facts: DataFrame) -> DataFrame:
    return (
        facts.where(F.col("batter").isNotNull() & F.col("local_date").isNotNull())
        .groupBy("batter", "local_date")
        .agg(
            F.sum("hit").alias("hits"),
            F.sum("atbat").alias("bats"),
            F.count(F.lit(1)).alias("n_rows"),
        )
    )


def _with_rolling_ratio(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "rolling_average",
        ratio_3(F.col("last_100_days_hits"), F.col("last_100_days_atbats")),
    )


def rolling_avg(facts: DataFrame, days: int = 100) -> DataFrame:
    """Every (game, batter) row with its sums over the open interval (day - days, day).

    Rows without a batter or date get sums of 0.
    """
    window = (
        Window.partitionBy("batter")
        .orderBy(F.unix_date("local_date"))
        .rangeBetween(1 - days, -1)
    )
    dated = F.col("batter").isNotNull() & F.col("local_date").isNotNull()
    # Dealt once: the daily sums and the join share this exchange.
    known = facts.where(dated).repartition("batter", "local_date")
    daily = _daily(known).select(
        "batter",
        "local_date",
        F.sum("hits").over(window).alias("hits"),
        F.sum("bats").over(window).alias("bats"),
    )
    joined = known.join(daily, ["batter", "local_date"], "left").select(
        "game_id", "local_date", "batter", "hits", "bats"
    )
    # Rows without a key never meet in one task.
    undated = facts.where(~dated).select(
        "game_id", "local_date", "batter", F.lit(None).alias("hits"), F.lit(None).alias("bats")
    )
    out = joined.union(undated).select(
        "game_id",
        F.col("local_date").alias("game_date"),
        "batter",
        F.coalesce("hits", F.lit(0)).alias("last_100_days_hits"),
        F.coalesce("bats", F.lit(0)).alias("last_100_days_atbats"),
    )
    return _with_rolling_ratio(out)


def rolling_avg_latest(facts: DataFrame, days: int = 100, limit: int = 100) -> DataFrame:
    """The last ``limit`` rows by game id (ties: batter) with their rolling sums.

    The target rows are few by definition, so they are broadcast and the facts are reduced
    against them on the map side; no window over the whole table is needed. More rows than may
    be broadcast take the way over the window. Both ways return the rows in that order.
    """
    order = [F.desc_nulls_last("game_id"), F.asc_nulls_last("batter")]
    if limit > LOCAL_ROWS:
        return rolling_avg(facts, days).orderBy(*order).limit(limit)
    targets = (
        facts.orderBy(*order)
        .limit(limit)
        .select(
            F.monotonically_increasing_id().alias("row_id"),
            "game_id",
            F.col("local_date").alias("game_date"),
            F.col("batter").alias("target"),
        )
    )
    # Each target also meets its own row, so targets without history keep sums of 0.
    in_range = F.col("local_date").between(F.date_sub("game_date", days - 1), F.col("game_date"))
    same_gap = F.col("local_date").isNull() & F.col("game_date").isNull()
    counted = F.col("batter").isNotNull() & (F.col("local_date") < F.col("game_date"))
    sums = (
        facts.select("batter", "local_date", "hit", "atbat")
        .join(
            F.broadcast(targets),
            F.col("batter").eqNullSafe(F.col("target")) & (in_range | same_gap),
        )
        .groupBy("row_id", "game_id", "game_date", "target")
        .agg(
            F.sum(F.when(counted, F.col("hit"))).alias("hits"),
            F.sum(F.when(counted, F.col("atbat"))).alias("bats"),
        )
    )
    out = sums.select(
        "game_id",
        "game_date",
        F.col("target").alias("batter"),
        F.coalesce("hits", F.lit(0)).alias("last_100_days_hits"),
        F.coalesce("bats", F.lit(0)).alias("last_100_days_atbats"),
    )
    return _with_rolling_ratio(out).orderBy(*order)


def rolling_avg_instants(facts: DataFrame, days: int = 100, slot_seconds: int = 3600) -> DataFrame:
    """:func:`rolling_avg` for a TIMESTAMP ``local_date``: open at both ends to the microsecond.

    A sum over (t - days, t) is a difference of two running sums: up to but excluding t, and up
    to and including t - days. Running sums are built in two levels, totals per (batter, slot)
    and rows inside one slot, so no task holds all instants of a batter.
    """
    at = F.unix_micros("local_date").alias("at")
    instants = (
        facts.where(F.col("batter").isNotNull() & F.col("local_date").isNotNull())
        .groupBy("batter", at)
        .agg(F.sum("hit").alias("hits"), F.sum("atbat").alias("bats"))
    )
    marks = instants.select(
        "batter", "at", F.explode(F.array(F.lit(0), F.lit(days * DAY_MICROS))).alias("back"),
        "hits", "bats",
    ).select(
        "batter",
        F.col("at").alias("owner"),
        (F.col("at") - F.col("back")).alias("pos"),
        F.col("back") == 0,
        *(
            F.when(F.col("back") == 0, F.coalesce(c, F.lit(0))).otherwise(0).alias(c)
            for c in ("hits", "bats")
        ),
    ).toDF("batter", "owner", "pos", "is_fact", "hits", "bats")
    marks = marks.withColumn("slot", F.floor(F.col("pos") / (slot_seconds * 1_000_000)))

    before_slot = Window.partitionBy("batter").orderBy("slot").rowsBetween(
        Window.unboundedPreceding, -1
    )
    slots = marks.groupBy("batter", "slot").agg(
        F.sum("hits").alias("slot_hits"), F.sum("bats").alias("slot_bats")
    ).select(
        "batter",
        "slot",
        F.coalesce(F.sum("slot_hits").over(before_slot), F.lit(0)).alias("base_hits"),
        F.coalesce(F.sum("slot_bats").over(before_slot), F.lit(0)).alias("base_bats"),
    )
    in_slot = Window.partitionBy("batter", "slot").orderBy("pos")
    strictly_before = in_slot.rangeBetween(Window.unboundedPreceding, -1)
    up_to = in_slot.rangeBetween(Window.unboundedPreceding, 0)

    def running(c: str) -> Column:
        inside = F.when(F.col("is_fact"), F.coalesce(F.sum(c).over(strictly_before), F.lit(0)))
        return inside.otherwise(F.sum(c).over(up_to)).alias(f"in_{c}")

    inner = marks.select("batter", "owner", "slot", "is_fact", running("hits"), running("bats"))
    sign = F.when(F.col("is_fact"), 1).otherwise(-1)
    sums = inner.join(slots, ["batter", "slot"]).groupBy("batter", "owner").agg(
        F.sum(sign * (F.col("base_hits") + F.col("in_hits"))).alias("hits"),
        F.sum(sign * (F.col("base_bats") + F.col("in_bats"))).alias("bats"),
    )
    dated = F.col("batter").isNotNull() & F.col("local_date").isNotNull()
    known = facts.where(dated).withColumn("owner", F.unix_micros("local_date"))
    joined = known.join(sums, ["batter", "owner"], "left")
    # Rows without a key never meet in one task.
    undated = facts.where(~dated).withColumns({"hits": F.lit(None), "bats": F.lit(None)})
    columns = ["game_id", "local_date", "batter", "hits", "bats"]
    out = joined.select(*columns).union(undated.select(*columns)).select(
        "game_id",
        F.col("local_date").alias("game_date"),
        "batter",
        F.coalesce("hits", F.lit(0)).alias("last_100_days_hits"),
        F.coalesce("bats", F.lit(0)).alias("last_100_days_atbats"),
    )
    return _with_rolling_ratio(out)


def _span(day: str, days: int) -> Column:
    return F.floor(F.unix_date(day) / F.lit(days + 1))


def _seen_spans(right: DataFrame, days: int) -> DataFrame:
    """Rows of ``right`` with each ``_span`` from which their day may be seen: their own and the next."""
    copies = F.explode(F.array(F.lit(0), F.lit(1)))
    return right.withColumn("_copy", copies).withColumn("_span", _span("right_day", days) + F.col("_copy")).drop("_copy")


def band_join(left: DataFrame, right: DataFrame, key: str, day: str, days: int) -> DataFrame:
    """Rows of ``left`` with the rows of ``right`` of one key and the trailing window
    [day - days, day], both ends in; ``right`` has its day as ``right_day``.

    Days are cut into spans as long as the window. A row of ``right`` can only be seen from its own
    span and the next one, so it is copied to these two, and the rest is an equi-join by key and
    span: work per task is bounded by what one key has in two windows.
    """
    met = left.withColumn("_span", _span(day, days)).join(_seen_spans(right, days), [key, "_span"])
    inside = F.col("right_day").between(F.date_sub(F.col(day), days), F.col(day))
    return met.where(inside).drop("_span")


def rolling_window_stats(facts: DataFrame, days: int = 100) -> DataFrame:
    """``batter, local_date, median_hits, n_games``: what running sums cannot give.

    For every batter and day, the median of ``hit`` and the number of different games in the
    closed trailing window. Rows without batter or day are left out; a window without any hit value
    has a null median.

    Hits are counted by (batter, day, hit) and gathered in their order, one array for a batter and
    span of days (see :func:`band_join`), bounded by the days and different hits of two windows. A
    day reads its median off the array of its span, so nothing moves for each pair of a day and a
    hit. A game counts from a day it is seen until it is seen again or leaves the window: changes by
    day, summed up.
    """
    known = facts.where(F.col("batter").isNotNull() & F.col("local_date").isNotNull())
    ends = known.select("batter", "local_date").distinct()
    right_day = F.col("local_date").alias("right_day")

    values = known.where(F.col("hit").isNotNull()).groupBy("batter", right_day, "hit")
    values = _seen_spans(values.agg(F.count(F.lit(1)).alias("n")), days)
    in_order = F.sort_array(F.collect_list(F.struct("hit", "right_day", "n"))).alias("hits")
    by_span = values.groupBy("batter", "_span").agg(in_order)
    inside = F.filter(
        "hits", lambda x: x["right_day"].between(F.date_sub(F.col("local_date"), days), F.col("local_date"))
    )
    medians = ends.withColumn("_span", _span("local_date", days)).join(by_span, ["batter", "_span"], "left")
    medians = medians.select("batter", "local_date", _median(inside, facts.schema["hit"].dataType).alias("median_hits"))

    games = known.where(F.col("game_id").isNotNull()).select("batter", "game_id", "local_date").distinct()
    again = F.lead("local_date").over(Window.partitionBy("batter", "game_id").orderBy("local_date"))
    games = games.withColumn("gone", F.least(F.date_add(F.col("local_date"), days + 1), again))
    change = F.struct("local_date", F.lit(1).alias("change")), F.struct(F.col("gone").alias("local_date"), F.lit(-1).alias("change"))
    changes = games.select("batter", F.inline(F.array(*change)))
    changes = changes.groupBy("batter", "local_date").agg(F.sum("change").alias("change"))
    up_to = Window.partitionBy("batter").orderBy("local_date").rowsBetween(Window.unboundedPreceding, 0)
    # Days of facts and days of changes, one row each.
    days_of = medians.withColumn("is_end", F.lit(True)).join(changes, ["batter", "local_date"], "full")
    counted = days_of.withColumn("n_games", F.coalesce(F.sum("change").over(up_to), F.lit(0)))
    return counted.where("is_end").select("batter", "local_date", "median_hits", "n_games")


def _median(counted: Column, kind: DataType) -> Column:
    """The median of structs ``hit, n`` in the order of hits; null of none."""
    total = F.aggregate(counted, F.lit(0).cast("long"), lambda up_to, x: up_to + x["n"])
    none = F.lit(None).cast(kind)

    def walked(ends: Column) -> Column:
        low, high = F.floor((ends - 1) / 2), F.floor(ends / 2)

        def step(acc: Column, x: Column) -> Column:
            up_to = acc["up_to"] + x["n"]
            return F.struct(
                up_to.alias("up_to"),
                F.coalesce(acc["low"], F.when(up_to > low, x["hit"])).alias("low"),
                F.coalesce(acc["high"], F.when(up_to > high, x["hit"])).alias("high"),
            )

        start = F.struct(F.lit(0).cast("long").alias("up_to"), none.alias("low"), none.alias("high"))
        return F.aggregate(counted, start, step, lambda acc: (acc["low"] + acc["high"]) / 2)

    # As the element of an array the total is summed once.
    return F.transform(F.array(total), walked)[0]


def rolling_pair_sums(facts: DataFrame, days: int = 100) -> DataFrame:
    """Per batter, the total of all closed trailing windows [day - days, day] of its rows.

    Equal to joining every row with the batter's rows of the last ``days`` days and summing by
    batter: the window sum of a day counts once for each row of that day.
    """
    window = (
        Window.partitionBy("batter").orderBy(F.unix_date("local_date")).rangeBetween(-days, 0)
    )
    return (
        _daily(facts)
        .select(
            "batter",
            (F.col("n_rows") * F.sum("hits").over(window)).alias("hits"),
            (F.col("n_rows") * F.sum("bats").over(window)).alias("bats"),
        )
        .groupBy("batter")
        .agg(F.sum("hits").alias("sum_hits"), F.sum("bats").alias("sum_bats"))
    )


# The same computation as SQL text over a registered view of facts.
ROLLING_PAIR_SUMS_SQL = """
WITH daily AS (
  SELECT batter, local_date, SUM(hit) AS hits, SUM(atbat) AS bats, COUNT(*) AS n_rows
  FROM {view}
  WHERE batter IS NOT NULL AND local_date IS NOT NULL
  GROUP BY batter, local_date
), trailing AS (
  SELECT batter, n_rows * SUM(hits) OVER w AS hits, n_rows * SUM(bats) OVER w AS bats
  FROM daily
  WINDOW w AS (PARTITION BY batter ORDER BY unix_date(local_date)
               RANGE BETWEEN {days} PRECEDING AND CURRENT ROW)
)
SELECT batter, SUM(hits) AS sum_hits, SUM(bats) AS sum_bats FROM trailing GROUP BY batter
"""


def target_game_avg(bc: DataFrame, games: DataFrame, game_id: int, days: int = 100) -> DataFrame:
    """Ratio of each batter of one game over the ``days`` days up to game day, both ends in."""
    game_day = games.where(F.col("game_id") == game_id).agg(F.max("local_date")).scalar()
    players = bc.where(F.col("game_id") == game_id).join(
        games.select("game_id"), "game_id", "left_semi"
    )
    recent = games.where(
        F.col("local_date").between(F.date_sub(game_day.cast("date"), days), game_day)
    )
    return (
        fact_join(bc, recent)
        .join(players.select("batter").distinct(), "batter", "left_semi")
        .groupBy("batter")
        .agg(plain_ratio(F.sum("hit"), F.sum("atbat")).alias("batting_avg"))
        .orderBy(F.desc_nulls_last("batting_avg"), "batter")
    )
