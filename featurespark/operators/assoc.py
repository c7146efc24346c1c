"""Association between columns: Pearson r, correlation ratio, chi-square, V and T.

Pearson r leaves out pairs with a null or NaN. The other measures expect columns without missing
values (``rows.drop_missing``); the categorical ones count a null as the category ``'0'``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from itertools import combinations_with_replacement, product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurespark.operators import gram
from featurespark.session import bounded_side, unpivot_tuples

# Output rows one pass makes out of an input row; more pairs are spread over several passes.
PAIRS_PER_PASS = 64
# Parts into which the cells of one value are dealt when they meet their margin.
MARGIN_PARTS = 8


def batches(items: Sequence, size: int = PAIRS_PER_PASS) -> Iterable[Sequence]:
    return (items[i : i + size] for i in range(0, len(items), size))


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def pair_name(index: Column, pairs: Sequence[tuple[str, str]], side: int) -> Column:
    """The name of one side of pair number ``index`` (1-based)."""
    return F.element_at(F.array(*(F.lit(p[side]) for p in pairs)), index)


def empty_scores(df: DataFrame, columns: str = "score double") -> DataFrame:
    schema = f"predictor1 string, predictor2 string, {columns}"
    return df.sparkSession.createDataFrame([], schema)


def category(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("0"))


def corr_pairs(
    df: DataFrame, columns: Sequence[str], simplify: bool = False, digits: int | None = 5
) -> DataFrame:
    """``predictor1, predictor2, score`` for all ordered pairs, or one triangle and the diagonal.

    One scan, however many columns; a score is NULL if a side is constant among the pair's rows.
    """
    if not columns:
        return empty_scores(df)
    names = F.array(*map(F.lit, columns))
    upper = gram.correlations(df, columns).select(
        names[F.col("a")].alias("predictor1"), names[F.col("b")].alias("predictor2"), F.col("r").alias("score")
    )
    if digits is not None:
        upper = upper.withColumn("score", F.round("score", digits))
    if simplify:
        return upper.orderBy(F.desc_nulls_last("score"), "predictor1", "predictor2")
    return both_orders(upper)


def both_orders(upper: DataFrame) -> DataFrame:
    """Add (predictor2, predictor1) for every pair of two different columns."""
    a, b = F.col("predictor1"), F.col("predictor2")
    both = F.array(
        F.struct(a.alias("predictor1"), b.alias("predictor2")),
        F.struct(b.alias("predictor1"), a.alias("predictor2")),
    )
    return upper.select(F.inline(F.when(a == b, F.slice(both, 1, 1)).otherwise(both)), "score")


def score_matrix(scores: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows predictor2, one column per predictor1."""
    return scores.groupBy("predictor2").pivot("predictor1", list(columns)).agg(F.first("score"))


def correlation_ratio(
    df: DataFrame,
    continuous: Sequence[str],
    categorical: Sequence[str],
    digits: int | None = 5,
) -> DataFrame:
    """Eta of every continuous column (predictor1) grouped by every categorical (predictor2).

    One pass, run here, yields count, mean and variance per category; the total sum of squares
    is the sum of the parts between and within categories.
    """
    pairs = list(product(continuous, categorical))
    if not pairs:
        return empty_scores(df)
    parts = []
    for chunk in batches(list(categorical)):
        data = df.select(
            *(F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(continuous)),
            *(category(c).alias(f"g{i}") for i, c in enumerate(chunk)),
        )
        rows = data.unpivot(
            [f"x{i}" for i in range(len(continuous))],
            [f"g{i}" for i in range(len(chunk))],
            "predictor2",
            "category",
        )
        groups = rows.groupBy("predictor2", "category").agg(
            *(
                F.struct(
                    F.count(f"x{i}").alias("n"),
                    F.avg(f"x{i}").alias("mean"),
                    F.var_pop(f"x{i}").alias("var"),
                ).alias(f"g{i}")
                for i in range(len(continuous))
            )
        )
        parts.append(
            groups.select(
                F.element_at(
                    F.array(*(F.lit(c) for c in chunk)),
                    F.substring("predictor2", 2, 9).cast("int") + 1,
                ).alias("predictor2"),
                F.inline(
                    F.array(
                        *(
                            F.struct(F.lit(c).alias("predictor1"), f"g{i}.n", f"g{i}.mean", f"g{i}.var")
                            for i, c in enumerate(continuous)
                        )
                    )
                ),
            ).where(F.col("n") > 0)
        )
    groups = bounded_side(union_all(parts))
    pair = ["predictor1", "predictor2"]
    # As many rows as there are pairs of columns: a bound known from the plan.
    totals = groups.groupBy(*pair).agg(
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("total_mean")
    )
    gap = F.col("mean") - F.col("total_mean")
    sums = groups.join(F.broadcast(totals), pair).groupBy(*pair).agg(
        F.sum(F.col("n") * gap * gap).alias("between"),
        F.sum(F.col("n") * F.col("var")).alias("within"),
    )
    eta = F.when(F.col("between") == 0, 0.0).otherwise(
        F.sqrt(F.try_divide("between", F.col("between") + F.col("within")))
    )
    return sums.select(*pair, (eta if digits is None else F.round(eta, digits)).alias("score"))


def _join_margin(cells: DataFrame, margin: DataFrame, key: str, other: str) -> DataFrame:
    """Cells with the margin of their ``pair`` and ``key``.

    A column of few values against one of many has most cells under a few keys, so cells are dealt
    by a part of ``other`` too, and the margins, one row per value, are repeated for each part.
    """
    part = F.pmod(F.xxhash64(other), F.lit(MARGIN_PARTS)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(MARGIN_PARTS - 1)))
    dealt = cells.withColumn("_part", part)
    return dealt.join(margin.withColumn("_part", every), ["pair", key, "_part"]).drop("_part")


def contingency_stats(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Chi-square of every pair: ``predictor1, predictor2, n, r, c, chi2, chi2_yates``.

    One pass, run here, counts the non-empty cells; the rest works on those counts. An empty
    cell contributes its expected count, so empty cells are never made into rows. The two
    statistics differ for 2 x 2 tables only.
    """
    if not pairs:
        return empty_scores(df, "n bigint, r bigint, c bigint, chi2 double, chi2_yates double")
    parts = []
    for chunk in batches(list(pairs)):
        sides = dict.fromkeys(c for pair in chunk for c in pair)
        names = {c: f"g{i}" for i, c in enumerate(sides)}
        data = df.select(*(category(c).alias(name) for c, name in names.items()))
        groups = {str(i + 1): (names[a], names[b]) for i, (a, b) in enumerate(chunk)}
        cells = (
            unpivot_tuples(data, [], groups, ["v1", "v2"], "pair")
            .groupBy("pair", "v1", "v2")
            .agg(F.count(F.lit(1)).alias("o"))
            .select(F.col("pair").cast("int").alias("pair"), "v1", "v2", "o")
        )
        # Read several times below, so computed here once.
        cells = bounded_side(cells)
        rows = cells.groupBy("pair", "v1").agg(F.sum("o").alias("row_n"))
        cols = cells.groupBy("pair", "v2").agg(F.sum("o").alias("col_n"))

        def margin(side: DataFrame, total: str, size: str) -> DataFrame:
            return side.groupBy("pair").agg(
                F.count(F.lit(1)).alias(size),
                F.sum(F.lit(1.0) / F.col(total)).alias(f"{size}_inverse"),
            )

        # One row per pair of columns on each side.
        sizes = (
            cells.groupBy("pair")
            .agg(F.sum("o").alias("n"))
            .join(F.broadcast(margin(rows, "row_n", "r")), "pair")
            .join(F.broadcast(margin(cols, "col_n", "c")), "pair")
        )
        expected = F.col("row_n").cast("double") * F.col("col_n") / F.col("n")
        gap = F.abs(F.col("o") - F.col("e"))
        out = (
            _join_margin(_join_margin(cells, rows, "v1", "v2"), cols, "v2", "v1")
            .join(F.broadcast(sizes), "pair")
            .withColumn("e", expected)
            .groupBy("pair", "n", "r", "c", "r_inverse", "c_inverse")
            .agg(
                F.sum(gap * gap / F.col("e")).alias("filled"),
                F.sum("e").alias("filled_e"),
                F.count(F.lit(1)).alias("n_filled"),
                F.max(gap).alias("gap"),
            )
        )
        empty = F.when(
            F.col("n_filled") < F.col("r") * F.col("c"),
            F.greatest(F.col("n") - F.col("filled_e"), F.lit(0.0)),
        ).otherwise(0.0)
        out = out.withColumn("chi2", F.col("filled") + empty)
        # The four cells of a 2 x 2 table are equally far from their expected counts.
        reduced = F.col("gap") - F.least(F.lit(0.5), F.col("gap"))
        yates = reduced * reduced * F.col("n") * F.col("r_inverse") * F.col("c_inverse")
        is_2x2 = (F.col("r") == 2) & (F.col("c") == 2)
        parts.append(
            out.select(
                pair_name(F.col("pair"), chunk, 0).alias("predictor1"),
                pair_name(F.col("pair"), chunk, 1).alias("predictor2"),
                "n",
                "r",
                "c",
                "chi2",
                F.when(is_2x2, yates).otherwise(F.col("chi2")).alias("chi2_yates"),
            )
        )
    return union_all(parts)


def chi_square(df: DataFrame, pairs: Sequence[tuple[str, str]], yates: bool = False) -> DataFrame:
    """``predictor1, predictor2, n, r, c, chi2``."""
    stats = contingency_stats(df, pairs)
    chosen = F.col("chi2_yates" if yates else "chi2").alias("chi2")
    return stats.select("predictor1", "predictor2", "n", "r", "c", chosen)


def _association(
    df: DataFrame,
    columns: Sequence[str],
    bias_correction: bool,
    tschuprow: bool,
    simplify: bool,
) -> DataFrame:
    pairs = list(combinations_with_replacement(columns, 2))
    stats = contingency_stats(df, pairs)
    n, r, c = F.col("n"), F.col("r"), F.col("c")
    # Without bias correction a 2 x 2 table gets the continuity correction.
    phi2 = F.col("chi2" if bias_correction else "chi2_yates") / n
    dof = (r - 1) * (c - 1)
    if bias_correction:
        phi2 = F.greatest(F.lit(0.0), phi2 - F.try_divide(dof.cast("double"), n - 1))
        r = r - F.try_divide((r - 1) * (r - 1), n - 1)
        c = c - F.try_divide((c - 1) * (c - 1), n - 1)
    scale = F.sqrt((r - 1) * (c - 1)) if tschuprow else F.least(r - 1, c - 1)
    score = F.when((F.col("r") > 1) & (F.col("c") > 1), F.sqrt(F.try_divide(phi2, scale)))
    upper = stats.select("predictor1", "predictor2", score.alias("score"))
    if simplify:
        return upper.orderBy(F.desc_nulls_last("score"), "predictor1", "predictor2")
    return both_orders(upper)


def cramers_v(
    df: DataFrame, columns: Sequence[str], bias_correction: bool = True, simplify: bool = True
) -> DataFrame:
    """Cramér's V of all pairs of columns; NULL if a column has one category."""
    return _association(df, columns, bias_correction, False, simplify)


def tschuprows_t(
    df: DataFrame, columns: Sequence[str], bias_correction: bool = True, simplify: bool = True
) -> DataFrame:
    """Tschuprow's T of all pairs of columns; NULL if a column has one category."""
    return _association(df, columns, bias_correction, True, simplify)
