"""Every operator as a named query over the star-schema tables.

Results are rounded and cast here, so that they compare with the SQL of ``plans.oracles``;
the operators themselves return unrounded values.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations_with_replacement

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from featurespark.functions.pvalues import scientific_column
from featurespark.functions.ratio import ratio_3
from featurespark.operators import assoc, charts, knn, ml, msd, profile, regress, rolling, rows, sketches
from featurespark.plans import views
from featurespark.plans.views import CATEGORICAL, CONTINUOUS
from featurespark.session import bounded_side, materialize, over_cached, scratch_path
from featurespark.sources import files, tables

Query = Callable[[SparkSession, str], DataFrame]

YEAR_END = "1998-12-31"
TARGET_GAME = 7
SKETCH_DAYS = ("1994-03-01", "1996-02-29")
PREDICTORS = [c for c in CONTINUOUS if c != "l_extendedprice"]
_REGISTRY: dict[str, Query] = {}


def query(f: Query) -> Query:
    _REGISTRY[f.__name__] = f
    return f


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(
        *(
            F.round(f.name, digits).alias(f.name)
            if isinstance(f.dataType, (DoubleType, FloatType))
            else f.name
            for f in df.schema
        )
    )


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def as_double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling.fact_join(views.batter_counts(spark, sf_dir), views.games(spark, sf_dir))


# Rolling metrics


@query
def rolling_avg(spark, sf_dir):
    out = rolling.rolling_avg_latest(facts(spark, sf_dir))
    return as_double(as_text(out, "game_date"), "rolling_average")


@query
def rolling_avg_all(spark, sf_dir):
    out = rolling.rolling_avg(facts(spark, sf_dir))
    return as_double(as_text(out, "game_date"), "rolling_average")


@query
def rolling_avg_instants(spark, sf_dir):
    out = rolling.rolling_avg_instants(views.timed_facts(spark, sf_dir))
    return as_double(out.drop("game_date"), "rolling_average")


@query
def rolling_window_median(spark, sf_dir):
    """Median hits and different games in the closed window of 100 days."""
    return as_text(rolling.rolling_window_stats(facts(spark, sf_dir)), "local_date")


@query
def fact_join(spark, sf_dir):
    return as_text(facts(spark, sf_dir), "local_date")


@query
def historic_avg(spark, sf_dir):
    return as_double(rolling.historic_avg(views.batter_counts(spark, sf_dir)), "average")


@query
def annual_avg(spark, sf_dir):
    bc, games = views.batter_counts(spark, sf_dir), views.games(spark, sf_dir)
    return as_double(rolling.annual_avg(bc, games, YEAR_END), "annual_batting_average")


@query
def rolling_pairs_window(spark, sf_dir):
    return rolling.rolling_pair_sums(facts(spark, sf_dir))


@query
def rolling_pairs_sql(spark, sf_dir):
    tables.register_view(facts(spark, sf_dir), "rolling_facts")
    return spark.sql(rolling.ROLLING_PAIR_SUMS_SQL.format(view="rolling_facts", days=100))


@query
def target_game_avg(spark, sf_dir):
    bc, games = views.batter_counts(spark, sf_dir), views.games(spark, sf_dir)
    return rounded(rolling.target_game_avg(bc, games, TARGET_GAME))


# Sources, sinks and tables


@query
def scan_csv(spark, sf_dir):
    part = views.table(spark, sf_dir, "part")
    path = scratch_path(spark, "part-csv")
    part.write.csv(path)
    return files.scan_csv(spark, path, part.schema)


@query
def sink_tsv(spark, sf_dir):
    result = views.table(spark, sf_dir, "customer")
    path = scratch_path(spark, "customer-tsv")
    files.write_tsv(result, path)
    return files.scan_tsv(spark, path, result.schema)


@query
def typed_empty_union(spark, sf_dir):
    schema = "game_id int, batter int, hit int, atbat int, local_date date"
    empty = tables.empty_table(spark, schema)
    return as_text(tables.append_rows(empty, facts(spark, sf_dir)), "local_date")


@query
def ctas_replace(spark, sf_dir):
    path = scratch_path(spark, "ctas_replace")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    bc = views.batter_counts(spark, sf_dir)
    tables.replace_table(bc, name, path)
    return as_double(tables.replace_table(rolling.historic_avg(bc), name, path), "average")


@query
def ctas_if_absent(spark, sf_dir):
    path = scratch_path(spark, "ctas_if_absent")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    tables.create_table_if_absent(views.table(spark, sf_dir, "supplier"), name, path)
    return tables.create_table_if_absent(
        views.table(spark, sf_dir, "supplier").where("s_acctbal < 0"), name, path
    )


@query
def publish_replace(spark, sf_dir):
    path = scratch_path(spark, "publish_replace")
    bc = views.batter_counts(spark, sf_dir)
    tables.publish(bc, path)
    return as_double(tables.publish(rolling.historic_avg(bc), path), "average")


@query
def publish_if_absent(spark, sf_dir):
    path = scratch_path(spark, "publish_if_absent")
    suppliers = views.table(spark, sf_dir, "supplier")
    tables.publish(suppliers, path, replace=False)
    return tables.publish(suppliers.where("s_acctbal < 0"), path, replace=False)


@query
def preview(spark, sf_dir):
    bc = views.batter_counts(spark, sf_dir)
    return tables.preview(bc, [F.desc("game_id"), "batter"], 200)


# Rows


@query
def feature_label_split(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    data = views.table(spark, sf_dir, "part").select(
        "p_partkey", "p_size", "p_retailprice", "p_type"
    )
    split = rows.feature_label_split(data, "p_type", keep=["p_partkey"])
    values = vector_to_array("features")
    return split.select(
        "p_partkey", values[0].alias("f0"), values[1].alias("f1"), F.col("p_type").alias("label")
    )


@query
def stride_sample(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return rows.stride_sample(orders, ["o_orderkey"], 7)


@query
def dropna_any(spark, sf_dir):
    return rows.drop_missing(views.parts_with_gaps(spark, sf_dir))


@query
def fillna_zero(spark, sf_dir):
    return rows.fill_zero(views.parts_with_gaps(spark, sf_dir))


@query
def binarize_response(spark, sf_dir):
    data = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return rows.binarize(data, "o_orderstatus")


# Scalars


@query
def scalar_math(spark, sf_dir):
    li = views.table(spark, sf_dir, "lineitem")
    q, d = F.col("l_quantity"), F.col("l_discount")
    return li.select(
        "l_orderkey",
        F.round(F.sqrt(q), 5).alias("root"),
        F.round(F.pow(d, 2), 4).alias("squared"),
        F.round(F.abs(F.col("l_tax") - d), 3).alias("gap"),
        F.greatest(F.lit(0.0), q - 25).alias("over_25"),
        F.least(q, F.lit(25.0)).alias("up_to_25"),
        F.round(F.try_divide(F.col("l_tax"), d), 4).alias("ratio"),
        scientific_column("l_extendedprice").alias("price_text"),
        ratio_3(F.least(q, F.lit(25)).cast("int"), q.cast("int")).cast("double").alias("share"),
    )


@query
def scalar_date(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    return views.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.add_months(day, -12).cast("string").alias("year_before"),
        F.date_add(day, -100).cast("string").alias("days_before"),
        day.between(F.add_months(F.to_date(F.lit(YEAR_END)), -12), F.to_date(F.lit(YEAR_END)))
        .cast("int")
        .alias("in_year"),
    )


@query
def scalar_null(spark, sf_dir):
    return views.parts_with_gaps(spark, sf_dir).select(
        "p_partkey",
        F.coalesce("p_size", F.lit(0)).alias("size_or_0"),
        F.when(F.col("p_name").isNull(), "").otherwise(F.col("p_name")).alias("name_or_empty"),
    )


# Column profiles


@query
def summary_stats(spark, sf_dir):
    return profile.summary_stats(views.features(spark, sf_dir), CONTINUOUS)


@query
def quartiles(spark, sf_dir):
    data = views.features(spark, sf_dir).select(*CONTINUOUS)
    return rounded(over_cached(data, lambda d: profile.quartiles(d, CONTINUOUS)), 4)


@query
def quartiles_split(spark, sf_dir):
    """As ``quartiles``, with groups that are narrowed down before sorting."""
    data = views.features(spark, sf_dir).select(*CONTINUOUS)
    found = over_cached(data, lambda d: profile.quartiles(d, CONTINUOUS, sort_rows=1000))
    return rounded(found, 4)


@query
def class_counts_written(spark, sf_dir):
    """As ``class_counts``, with more classes than may go through the driver."""
    data = views.features(spark, sf_dir)
    return rounded(profile.class_counts(data, "p_type", max_rows=1))


@query
def class_counts(spark, sf_dir):
    return rounded(profile.class_counts(views.features(spark, sf_dir), "p_type"))


@query
def column_kinds(spark, sf_dir):
    return profile.column_kinds(views.features(spark, sf_dir))


@query
def column_kinds_sketched(spark, sf_dir):
    return sketches.column_kinds(views.features(spark, sf_dir))


@query
def boolean_columns_sketched(spark, sf_dir):
    out = sketches.boolean_columns(views.features(spark, sf_dir))
    return out.withColumn("is_boolean", F.col("is_boolean").cast("int"))


@query
def quartiles_sketched(spark, sf_dir):
    """Whether quartiles of two years, from sketches of days, lie within their rank error."""
    lines = views.table(spark, sf_dir, "lineitem").withColumn("day", F.col("l_shipdate").cast("date"))
    columns = ["l_quantity", "l_extendedprice", "l_discount"]
    stored = materialize(sketches.daily_quantile_sketches(lines, columns, "day"), "day-sketches")
    first, last = (F.lit(d).cast("date") for d in SKETCH_DAYS)
    found = sketches.quantiles_of_days(stored, [0.25, 0.5, 0.75], first, last)
    values = profile.unpivot(lines.where(F.col("day").between(first, last)), columns)
    below = _ranks(values, found)
    near = (F.col("less") <= (F.col("p") + sketches.RANK_ERROR) * F.col("n")) & (
        F.col("up_to") >= (F.col("p") - sketches.RANK_ERROR) * F.col("n")
    )
    return below.select("feature", "p", "n", near.cast("int").alias("within"))


def _ranks(values: DataFrame, found: DataFrame) -> DataFrame:
    """``feature, p, n, less, up_to``: how many values lie below each quantile, and up to it."""
    quantiles = bounded_side(found).withColumnRenamed("value", "quantile")
    return values.join(quantiles, "feature").groupBy("feature", "p").agg(
        F.max("n").alias("n"),
        F.count_if(F.col("value") < F.col("quantile")).alias("less"),
        F.count_if(F.col("value") <= F.col("quantile")).alias("up_to"),
    )


@query
def boolean_columns(spark, sf_dir):
    out = over_cached(views.features(spark, sf_dir), profile.boolean_columns)
    return out.withColumn("is_boolean", F.col("is_boolean").cast("int"))


@query
def contingency(spark, sf_dir):
    return profile.contingency(views.features(spark, sf_dir), "p_type", "p_size")


@query
def crosstab(spark, sf_dir):
    return profile.crosstab(views.table(spark, sf_dir, "documents"), "source", "lang")


@query
def crosstab_values(spark, sf_dir):
    return profile.crosstab(views.documents_with_odd_values(spark, sf_dir), "source", "odd")


@query
def crosstab_sparse(spark, sf_dir):
    cells, values = profile.crosstab_sparse(views.table(spark, sf_dir, "lineitem"), "l_returnflag", "l_partkey")
    return cells.join(values, "y_index").select("l_returnflag", "y_index", "l_partkey", "n", "x_total", "y_total")


@query
def crosstab_wide(spark, sf_dir):
    return profile.crosstab_wide(views.features(spark, sf_dir), "p_type", "l_linestatus")


# Association


@query
def corr_pairs(spark, sf_dir):
    return assoc.corr_pairs(views.features(spark, sf_dir), CONTINUOUS)


@query
def corr_pairs_missing(spark, sf_dir):
    data = views.features_with_gaps(spark, sf_dir)
    return assoc.corr_pairs(data, [*CONTINUOUS, "is_returned"])


@query
def corr_wide(spark, sf_dir):
    """All pairs of many columns with gaps."""
    return assoc.corr_pairs(views.wide(spark, sf_dir), views.WIDE, simplify=True)


@query
def corr_table(spark, sf_dir):
    return assoc.corr_pairs(views.features(spark, sf_dir), CONTINUOUS, simplify=True)


@query
def corr_matrix(spark, sf_dir):
    scores = assoc.corr_pairs(views.features(spark, sf_dir), CONTINUOUS)
    return assoc.score_matrix(scores, CONTINUOUS)


@query
def correlation_ratio(spark, sf_dir):
    return assoc.correlation_ratio(views.features(spark, sf_dir), CONTINUOUS, CATEGORICAL)


@query
def correlation_ratio_matrix(spark, sf_dir):
    scores = assoc.correlation_ratio(views.features(spark, sf_dir), CONTINUOUS, CATEGORICAL)
    return assoc.score_matrix(scores, CONTINUOUS)


def _category_pairs():
    return list(combinations_with_replacement(CATEGORICAL, 2))


@query
def chi2(spark, sf_dir):
    return rounded(assoc.chi_square(views.features(spark, sf_dir), _category_pairs()), 4)


@query
def chi2_yates(spark, sf_dir):
    pairs = [("quality", "toxic"), ("quality", "quality"), ("toxic", "toxic")]
    labels = views.table(spark, sf_dir, "labels")
    return rounded(assoc.chi_square(labels, pairs, yates=True))


def _labelled(spark, sf_dir):
    documents = views.table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return documents.join(views.table(spark, sf_dir, "labels"), "doc_id")


LABELLED = ["lang", "source", "quality", "toxic"]


@query
def cramers_v(spark, sf_dir):
    return rounded(assoc.cramers_v(views.features(spark, sf_dir), CATEGORICAL))


@query
def cramers_v_plain(spark, sf_dir):
    return rounded(
        assoc.cramers_v(views.features(spark, sf_dir), CATEGORICAL, bias_correction=False)
    )


@query
def cramers_v_labels(spark, sf_dir):
    return rounded(assoc.cramers_v(_labelled(spark, sf_dir), LABELLED, simplify=False))


@query
def cramers_v_labels_plain(spark, sf_dir):
    return rounded(assoc.cramers_v(_labelled(spark, sf_dir), LABELLED, bias_correction=False))


@query
def tschuprows_t(spark, sf_dir):
    return rounded(assoc.tschuprows_t(_labelled(spark, sf_dir), LABELLED))


@query
def tschuprows_t_plain(spark, sf_dir):
    return rounded(assoc.tschuprows_t(_labelled(spark, sf_dir), LABELLED, bias_correction=False))


# Regression


@query
def ols_per_feature(spark, sf_dir):
    fits = regress.ols_per_feature(views.features(spark, sf_dir), "l_extendedprice", PREDICTORS)
    return rounded(fits, 4).drop("r2")


@query
def ols_pvalues(spark, sf_dir):
    fits = regress.ols_per_feature(views.features(spark, sf_dir), "l_extendedprice", PREDICTORS)
    out = regress.with_ols_pvalues(fits)
    return out.select("feature", F.round("p_value", 6).alias("p_value"))


@query
def ols_trend(spark, sf_dir):
    return rounded(regress.ols_trend(views.features(spark, sf_dir), "l_discount", "l_tax"))


@query
def logit_per_feature(spark, sf_dir):
    fits = regress.logit_per_feature(views.features(spark, sf_dir), "is_returned", CONTINUOUS)
    return fits.select(
        "feature",
        "n",
        F.round("slope", 6).alias("slope"),
        F.round("intercept", 5).alias("intercept"),
        F.round("z_value", 4).alias("z_value"),
    )


@query
def logit_pvalues(spark, sf_dir):
    fits = regress.logit_per_feature(views.features(spark, sf_dir), "is_returned", CONTINUOUS)
    return fits.select("feature", F.round("p_value", 5).alias("p_value"))


@query
def logit_missing(spark, sf_dir):
    data = views.features_with_gaps(spark, sf_dir)
    fits = regress.logit_per_feature(data, "is_returned", CONTINUOUS)
    return fits.select(
        "feature",
        "n",
        F.round("slope", 6).alias("slope"),
        F.round("intercept", 5).alias("intercept"),
        F.round("z_value", 4).alias("z_value"),
    )


# Binned mean square differences


@query
def bin_edges(spark, sf_dir):
    return rounded(msd.bin_edges(views.features(spark, sf_dir), CONTINUOUS))


def _msd_1d(spark, sf_dir, **options):
    data = views.features(spark, sf_dir).select(*CONTINUOUS, "is_returned")
    return over_cached(data, lambda d: msd.msd_1d(d, CONTINUOUS, **options))


@query
def msd1d(spark, sf_dir):
    return rounded(_msd_1d(spark, sf_dir), 3)


@query
def msd1d_standard(spark, sf_dir):
    return rounded(_msd_1d(spark, sf_dir, response="is_returned", mode=msd.STANDARD))


@query
def msd1d_summary(spark, sf_dir):
    return rounded(msd.msd_1d_summary(_msd_1d(spark, sf_dir)), 3)


def _cont_cont(spark, sf_dir, mode):
    data = views.features(spark, sf_dir).select(*CONTINUOUS, "is_returned")
    return over_cached(
        data, lambda d: msd.msd_2d_cont_cont(d, CONTINUOUS, "is_returned", mode=mode)
    )


@query
def msd2d_cont_cont(spark, sf_dir):
    cells = _cont_cont(spark, sf_dir, msd.REFERENCE)
    return rounded(cells.withColumn("weighted_msd", F.col("weighted_msd") * 1e9))


@query
def msd2d_cont_cont_standard(spark, sf_dir):
    return rounded(_cont_cont(spark, sf_dir, msd.STANDARD), 8)


@query
def msd2d_cat_cont(spark, sf_dir):
    data = views.features(spark, sf_dir).drop("l_orderkey")
    return rounded(
        over_cached(
            data, lambda d: msd.msd_2d_cont_cat(d, CONTINUOUS, CATEGORICAL, "is_returned")
        ),
        8,
    )


@query
def msd2d_cat_cat(spark, sf_dir):
    data = views.features(spark, sf_dir).select(*CATEGORICAL, "is_returned")
    return rounded(
        over_cached(data, lambda d: msd.msd_2d_cat_cat(d, CATEGORICAL, "is_returned")), 8
    )


@query
def msd2d_rank(spark, sf_dir):
    def ranks(data):
        kinds = {
            "cont_cont": msd.msd_2d_cont_cont(data, CONTINUOUS, "is_returned", mode=msd.STANDARD),
            "cont_cat": msd.msd_2d_cont_cat(data, CONTINUOUS, CATEGORICAL, "is_returned"),
            "cat_cat": msd.msd_2d_cat_cat(data, CATEGORICAL, "is_returned"),
        }
        return assoc.union_all(
            [msd.msd_rank(cells).withColumn("kind", F.lit(k)) for k, cells in kinds.items()]
        )

    return rounded(over_cached(views.features(spark, sf_dir).drop("l_orderkey"), ranks), 8)


# Chart tables


@query
def chart_scatter(spark, sf_dir):
    return charts.scatter_points(views.features(spark, sf_dir), "l_discount", "l_extendedprice")


@query
def chart_scatter_sample(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders")
    return charts.scatter_sample(orders, "o_orderkey", "o_custkey", "o_totalprice", 1000)


@query
def chart_violin(spark, sf_dir):
    data = views.features(spark, sf_dir).select("l_returnflag", "l_extendedprice")
    return rounded(
        over_cached(data, lambda d: charts.violin_shape(d, "l_returnflag", "l_extendedprice")), 9
    )


@query
def chart_violin_quartiles(spark, sf_dir):
    data = views.features(spark, sf_dir).select("p_type", "l_extendedprice")
    return rounded(
        over_cached(data, lambda d: charts.violin_quartiles(d, "p_type", "l_extendedprice")), 4
    )


@query
def chart_violin_kde(spark, sf_dir):
    data = views.features(spark, sf_dir).select("l_returnflag", "l_extendedprice")
    curve = over_cached(data, lambda d: charts.violin_curve(d, "l_returnflag", "l_extendedprice"))
    return curve.withColumns({"x": F.round("x", 4), "density": F.round(F.col("density") * 1e6, 6)})


@query
def chart_box(spark, sf_dir):
    data = views.table(spark, sf_dir, "documents").select("lang", "n_chars")
    return rounded(over_cached(data, lambda d: charts.box(d, "lang", "n_chars")))


@query
def chart_density(spark, sf_dir):
    return charts.density_heatmap(views.features(spark, sf_dir), "l_quantity", "l_extendedprice")


@query
def chart_density_categories(spark, sf_dir):
    data = views.features(spark, sf_dir)
    return charts.density_heatmap(data, "p_type", "l_returnflag", None, None)


@query
def chart_histogram(spark, sf_dir):
    return rounded(
        charts.histogram(views.features(spark, sf_dir), "l_extendedprice", "l_returnflag"), 2
    )


@query
def chart_histogram_margins(spark, sf_dir):
    data = views.features(spark, sf_dir).select("l_returnflag", "l_extendedprice")
    out = over_cached(data, lambda d: charts.histogram_margins(d, "l_extendedprice", "l_returnflag"))
    return rounded(out.withColumn("height", F.round("height", 2)), 4)


@query
def chart_msd(spark, sf_dir):
    return rounded(charts.msd_series(_msd_1d(spark, sf_dir)), 3)


# Models


@query
def l2_normalize(spark, sf_dir):
    units = ml.normalize_rows(views.table(spark, sf_dir, "embeddings"), "embedding")
    values = units.select("vec_id", F.posexplode("unit").alias("pos", "value"))
    return rounded(values)


@query
def rf_classify(spark, sf_dir):
    scored = ml.forest_classify(
        views.table(spark, sf_dir, "embeddings"),
        "embedding",
        "label",
        keep=["vec_id"],
    )
    return scored.select("vec_id", "label", "predicted", F.array_max("probability").alias("share"))


def _importance_table(spark: SparkSession, sf_dir: str, response: str) -> DataFrame:
    data = views.features(spark, sf_dir)
    is_boolean = response == "is_returned"
    return ml.forest_importance(data, CONTINUOUS if is_boolean else PREDICTORS, response, is_boolean)


@query
def rf_importance(spark, sf_dir):
    return _importance_table(spark, sf_dir, "is_returned")


@query
def rf_importance_regression(spark, sf_dir):
    return _importance_table(spark, sf_dir, "l_extendedprice")


@query
def rf_classify_summary(spark, sf_dir):
    """Rows, rows with proper probabilities, rows predicted as their most probable class."""
    data = views.table(spark, sf_dir, "embeddings")
    classes = F.array_sort(F.collect_set(F.col("label").cast("string")))
    ordered = data.agg(classes).scalar()
    scored = ml.forest_classify(data, "embedding", "label")
    p = F.col("probability")
    total = F.aggregate(p, F.lit(0.0), lambda acc, x: acc + x)
    best = F.element_at(ordered, F.array_position(p, F.array_max(p)).cast("int"))
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.abs(total - 1) < 1e-9).alias("n_proper"),
        F.count_if(best == F.col("predicted")).alias("n_most_probable"),
    )


@query
def rf_classify_accuracy(spark, sf_dir):
    """Rows, rows of the largest class, and whether a full forest knows 19 of 20 rows it was fitted on.

    Probabilities are means of leaf shares over trees: hundredths for pure leaves.
    """
    scored = ml.forest_classify(views.table(spark, sf_dir, "embeddings"), "embedding", "label")
    right = F.col("predicted") == F.col("label").cast("string")
    per_class = scored.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(right).alias("n_right"),
        F.count_if(F.abs(F.aggregate("probability", F.lit(0.0), lambda a, x: a + x) - 1) < 1e-9).alias("n_proper"),
    )
    return per_class.agg(
        F.sum("n").alias("n_rows"),
        F.max("n").alias("n_majority"),
        F.sum("n_proper").alias("n_proper"),
        (F.sum("n_right") > F.max("n")).alias("beats_majority"),
        (20 * F.sum("n_right") >= 19 * F.sum("n")).alias("knows_its_rows"),
    )


@query
def rf_importance_summary(spark, sf_dir):
    """Features and the sum of their importances, for both kinds of response."""
    parts = [
        weights(spark, sf_dir).agg(
            F.lit(response).alias("response"),
            F.count(F.lit(1)).alias("n_features"),
            F.round(F.sum("importance"), 6).alias("total"),
        )
        for response, weights in (
            ("is_returned", rf_importance),
            ("l_extendedprice", rf_importance_regression),
        )
    ]
    return parts[0].unionByName(parts[1])


@query
def knn_classify(spark, sf_dir):
    data = views.table(spark, sf_dir, "embeddings")
    return knn.knn_classify(data, "vec_id", "embedding", "label", exclude_self=True)


@query
def knn_classify_blocks(spark, sf_dir):
    """As ``knn_classify``, with several cells and several blocks in each."""
    data = views.table(spark, sf_dir, "embeddings")
    return knn.knn_classify(
        data, "vec_id", "embedding", "label", exclude_self=True, block_rows=64, n_pivots=8
    )


@query
def knn_lsh(spark, sf_dir):
    """Queries, and whether bucketed projections find nine of ten of the exact neighbours."""
    data = views.table(spark, sf_dir, "embeddings")
    exact, approximate = (
        knn.nearest_neighbours(data, "vec_id", "embedding", "label", exclude_self=True, approximate=how)
        for how in (None, knn.Projections())
    )

    def ids(found: DataFrame) -> DataFrame:
        return found.select("id", F.explode("neighbours.id").alias("other"))

    hits = ids(approximate).withColumn("hit", F.lit(1))
    both = ids(exact).join(hits, ["id", "other"], "left")
    enough = 10 * F.count("hit") >= 9 * F.count(F.lit(1))
    return both.agg(F.count_distinct("id").alias("n_queries"), enough.cast("int").alias("recall_90"))


@query
def knn_classify_in_sample(spark, sf_dir):
    data = views.table(spark, sf_dir, "embeddings")
    return knn.knn_classify(data, "vec_id", "embedding", "label")


@query
def knn_proba(spark, sf_dir):
    data = views.table(spark, sf_dir, "embeddings")
    return rounded(
        knn.knn_probabilities(data, "vec_id", "embedding", "label", exclude_self=True)
    )


@query
def metric_tokens(spark, sf_dir):
    tokens = ml.metric_tokens(rolling.rolling_pair_sums(facts(spark, sf_dir)))
    return tokens.select("batter", F.posexplode("tokens").alias("pos", "token"))


@query
def vocabulary(spark, sf_dir):
    return ml.vocabulary(ml.metric_tokens(rolling.rolling_pair_sums(facts(spark, sf_dir))), "tokens")


@query
def count_vectors(spark, sf_dir):
    tokens = ml.metric_tokens(rolling.rolling_pair_sums(facts(spark, sf_dir)))
    return ml.count_vectors(tokens, "tokens", "batter", ml.vocabulary(tokens, "tokens"))


@query
def count_vectorize(spark, sf_dir):
    tokens = ml.metric_tokens(rolling.rolling_pair_sums(facts(spark, sf_dir)))
    return ml.term_counts(tokens, "tokens", "batter")
