"""Every registered query against its SQL counterpart, and the whole reports."""

import __spark_entry__ as contract
import pytest
from featurespark.operators.profile import FeatureSpec
from featurespark.plans import oracles, registry, reports, views
from oracle_check import connect, difference

SF_DIR = "/root/testdata/sf0.001"
NO_SQL = {"rf_classify", "rf_importance", "rf_importance_regression"}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_contract(spark):
    names = set(registry.all_queries())
    assert names - set(oracles.all_oracles()) == NO_SQL
    assert names <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() == 100


@pytest.mark.parametrize("name", sorted(set(registry.all_queries()) - NO_SQL))
def test_equals_sql(spark, con, name):
    df = contract.queries()[name](spark, SF_DIR)
    assert difference(df, con, contract.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(NO_SQL))
def test_runs(spark, name):
    assert contract.queries()[name](spark, SF_DIR).count() > 0


def test_pair_report(spark):
    data = views.features(spark, SF_DIR).drop("l_orderkey")
    tables = reports.pair_report(data, "l_returnflag")
    spec = FeatureSpec.infer(data, "l_returnflag")
    p, q = len(spec.continuous), len(spec.categorical)
    assert tables["cont_cont_ranking"].count() == p * (p + 1) // 2
    assert tables["cont_cat_ranking"].count() == p * q
    assert tables["cat_cat_ranking"].count() == q * (q + 1) // 2
    assert tables["cont_cat_matrix"].count() == q
    # A categorical predictor that determines the response is fully associated with itself only.
    assert tables["l_quantity_chart"].columns == ["l_returnflag", "bin", "n", "density"]


def test_pair_report_without_categories(spark):
    data = views.features(spark, SF_DIR).select("l_quantity", "l_tax", "l_extendedprice")
    tables = reports.pair_report(data, "l_extendedprice")
    assert tables["cat_cat_correlation"].count() == 0
    assert tables["cont_cat_ranking"].count() == 0
    assert tables["cont_cont_ranking"].count() == 3
    assert tables["l_tax_trend"].count() == 1


@pytest.mark.parametrize("response", ["is_returned", "l_extendedprice"])
def test_predictor_report(spark, response):
    data = views.features(spark, SF_DIR).select(*views.CONTINUOUS, "is_returned")
    tables = reports.predictor_report(data, response, num_trees=3, max_depth=3)
    assert tables["statistics"].count() == 5
    assert tables["msd"].count() == 50
    assert sum(r["importance"] for r in tables["importance"].collect()) == pytest.approx(1)


def test_class_report(spark):
    data = views.table(spark, SF_DIR, "part").select(
        "p_partkey", "p_size", "p_retailprice", "p_type"
    )
    tables = reports.class_report(
        data, "p_partkey", ["p_size", "p_retailprice"], "p_type", 2, num_trees=3, max_depth=3
    )
    n = data.count()
    assert tables["forest"].count() == tables["neighbours"].count() == (n + 1) // 2


def test_rolling_and_token_reports(spark):
    bc, games = views.batter_counts(spark, SF_DIR), views.games(spark, SF_DIR)
    tables = reports.rolling_report(bc, games, "1998-12-31", 7)
    assert all(t.count() > 0 for t in tables.values())
    from featurespark.operators.rolling import fact_join

    assert reports.token_report(fact_join(bc, games))["vectors"].count() > 0
