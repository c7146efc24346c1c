"""Whole analyses of one table, as named result tables.

The input is kept in memory and on disk while its tables are computed; each result comes back
evaluated, as a local table or, beyond a bounded size, a written one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from featurespark.operators import assoc, charts, knn, ml, msd, profile, regress, rolling, rows
from featurespark.operators.profile import CATEGORICAL, FeatureSpec
from featurespark.session import bounded_side

Report = dict[str, DataFrame]


def _evaluate(df: DataFrame, tables: Callable[[DataFrame], Report]) -> Report:
    data = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return {name: bounded_side(table) for name, table in tables(data).items()}
    finally:
        data.unpersist()


def rolling_report(
    bc: DataFrame, games: DataFrame, year_end: dt.date | str, game_id: int, days: int = 100
) -> Report:
    """Historic, annual, rolling and target-game averages."""
    return {
        "historic": rolling.historic_avg(bc),
        "annual": rolling.annual_avg(bc, games, year_end),
        "rolling": rolling.rolling_avg_latest(rolling.fact_join(bc, games), days),
        "target_game": rolling.target_game_avg(bc, games, game_id, days),
    }


def token_report(facts: DataFrame, days: int = 100) -> Report:
    """Rolling pair sums as tokens and term counts."""
    tokens = ml.metric_tokens(rolling.rolling_pair_sums(facts, days))
    words = ml.vocabulary(tokens, "tokens")
    vectors = ml.count_vectors(tokens, "tokens", "batter", words)
    return {"vocabulary": words, "vectors": vectors, "counts": ml.term_counts(tokens, "tokens", "batter")}


def pair_report(df: DataFrame, response: str, mode: str = msd.REFERENCE) -> Report:
    """Association and binned response differences of all pairs of predictors."""
    clean = rows.drop_missing(df)

    def tables(data: DataFrame) -> Report:
        spec = FeatureSpec.infer(data, response)
        cont, cat = spec.continuous, spec.categorical
        best_first = [F.desc_nulls_last("score"), "predictor1", "predictor2"]
        # Each score is computed once; tables and matrices derive from it.
        pearson, ratios, v = (
            bounded_side(scores)
            for scores in (
                assoc.corr_pairs(data, cont, simplify=True),
                assoc.correlation_ratio(data, cont, cat),
                assoc.cramers_v(data, cat),
            )
        )
        out = {
            "cont_cont_correlation": pearson.orderBy(*best_first),
            "cont_cat_correlation": ratios.orderBy(*best_first),
            "cat_cat_correlation": v.orderBy(*best_first),
        }
        if cont:
            out["cont_cont_matrix"] = assoc.score_matrix(assoc.both_orders(pearson), cont)
            out["cont_cat_matrix"] = assoc.score_matrix(ratios, cont)
        if cat:
            out["cat_cat_matrix"] = assoc.score_matrix(assoc.both_orders(v), cat)
        out.update(response_charts(data, spec))
        target = rows.binarize(data, response) if spec.response_kind == CATEGORICAL else data
        cells = {
            "cont_cont_ranking": msd.msd_2d_cont_cont(target, cont, response, mode),
            "cont_cat_ranking": msd.msd_2d_cont_cat(target, cont, cat, response),
            "cat_cat_ranking": msd.msd_2d_cat_cat(target, cat, response),
        }
        out.update({name: msd.msd_rank(table) for name, table in cells.items()})
        return out

    return _evaluate(clean, tables)


def response_charts(data: DataFrame, spec: FeatureSpec) -> Report:
    """The chart table of every predictor against the response, by the kinds of both."""
    response = spec.response
    out = {}
    for predictor in spec.predictors:
        categorical = predictor in spec.categorical
        if spec.response_kind == CATEGORICAL and categorical:
            chart = charts.density_heatmap(data, predictor, response, None, None)
        elif spec.response_kind == CATEGORICAL:
            chart = charts.violin_shape(data, response, predictor)
        elif categorical:
            chart = charts.histogram(data, response, predictor)
        else:
            chart = charts.scatter_points(data, predictor, response)
            out[f"{predictor}_trend"] = regress.ols_trend(data, predictor, response)
        out[f"{predictor}_chart"] = chart
    return out


def predictor_report(
    df: DataFrame,
    response: str,
    mode: str = msd.REFERENCE,
    num_trees: int = 100,
    max_depth: int = 30,
) -> Report:
    """Type, regression statistics, binned means and forest importance of numeric predictors.

    Columns that are not numeric are left out.
    """
    names = [
        f.name for f in df.schema if isinstance(f.dataType, NumericType) and f.name != response
    ]
    df = df.select(*names, response)

    def tables(data: DataFrame) -> Report:
        kinds = profile.boolean_columns(data)
        is_boolean = kinds.where(F.col("column_name") == response).first()["is_boolean"]
        target = rows.binarize(data, response) if is_boolean else data
        if is_boolean:
            stats = regress.logit_per_feature(target, response, names)
        else:
            stats = regress.with_ols_pvalues(regress.ols_per_feature(target, response, names))
        binned = bounded_side(msd.msd_1d(target, names, response, mode))
        return {
            "boolean": kinds.where(F.col("column_name") != response),
            "statistics": regress.formatted_stats(stats),
            "msd": binned,
            "msd_summary": msd.msd_1d_summary(binned),
            "msd_series": charts.msd_series(binned, mode),
            "importance": ml.forest_importance(
                target, names, response, is_boolean, num_trees, max_depth
            ),
        }

    return _evaluate(df, tables)


def class_report(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    label: str,
    step: int = 1,
    num_trees: int = 100,
    max_depth: int = 30,
) -> Report:
    """Summary statistics, class charts and in-sample predictions of a labelled table."""

    def tables(data: DataFrame) -> Report:
        sample = rows.stride_sample(data, [key], step)
        vectors = sample.select(key, label, F.array(*features).alias("_features"))
        return {
            "summary": profile.summary_stats(data, features),
            "quartiles": profile.quartiles(data, features),
            "classes": profile.class_counts(data, label),
            "box": charts.box(data, label, features[0]),
            "violin": charts.violin_shape(data, label, features[0]),
            "scatter": charts.scatter_points(data, features[0], features[-1], [label]),
            "density": charts.density_heatmap(data, features[0], features[-1]),
            "forest": ml.forest_classify(sample, features, label, [key], num_trees, max_depth),
            "neighbours": knn.knn_classify(vectors, key, "_features", label),
        }

    return _evaluate(df, tables)
