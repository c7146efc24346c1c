"""SQL counterparts of the registered queries, over the same tables."""

from __future__ import annotations

from itertools import combinations_with_replacement, product

from featurespark.plans.registry import LABELLED, PREDICTORS, SKETCH_DAYS, TARGET_GAME, YEAR_END
from featurespark.plans.views import CATEGORICAL, CONTINUOUS, WIDE, wide_expression

BC = """bc AS (
  SELECT l_orderkey AS game_id, l_suppkey AS batter,
    CAST(SUM(CASE WHEN l_linestatus = 'O' AND l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS INT) AS hit,
    CAST(SUM(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS INT) AS atbat
  FROM lineitem GROUP BY l_orderkey, l_suppkey)"""
GAMES = """games AS (
  SELECT o_orderkey AS game_id, CAST(o_orderdate AS DATE) AS local_date FROM orders)"""
FACTS = f"""{BC}, {GAMES}, facts AS (
  SELECT game_id, batter, hit, atbat, local_date FROM bc JOIN games USING (game_id))"""
FEATURES = """features AS (
  SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, p_retailprice,
    l_returnflag, l_linestatus, p_type, p_size,
    CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_returned
  FROM lineitem JOIN part ON p_partkey = l_partkey)"""
GAPS = """gaps AS (
  SELECT p_partkey,
    CASE WHEN p_partkey % 7 <> 0 THEN p_name END AS p_name,
    CASE WHEN p_partkey % 5 <> 0 THEN p_size END AS p_size,
    CASE WHEN p_partkey % 11 = 0 THEN CAST('NaN' AS DOUBLE)
         WHEN p_partkey % 3 <> 0 THEN p_retailprice END AS p_retailprice
  FROM part)"""
FEATURE_GAPS = f"""{FEATURES}, gapped AS (
  SELECT CASE WHEN r % 6 <> 0 THEN l_quantity END AS l_quantity,
    CASE WHEN r % 7 = 0 THEN CAST('NaN' AS DOUBLE) ELSE l_extendedprice END AS l_extendedprice,
    CASE WHEN r % 11 = 0 THEN CAST('NaN' AS DOUBLE) WHEN r % 5 <> 0 THEN l_discount END AS l_discount,
    l_tax, CASE WHEN r % 13 <> 0 THEN p_retailprice END AS p_retailprice,
    CASE WHEN r % 3 <> 0 THEN is_returned END AS is_returned
  FROM (SELECT *, l_orderkey + l_linenumber AS r FROM features))"""
ODD_DOCS = """odd_docs AS (
  SELECT source, (['a.b', 'A.B', '`', '', ' ', 'source', 'odd', 'n'])[doc_id % 8 + 1] AS odd
  FROM documents)"""
LABELLED_DOCS = """labelled AS (
  SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic
  FROM documents d JOIN labels l USING (doc_id))"""


def ratio_3(h: str, n: str) -> str:
    return (
        f"CASE WHEN {n} > 0 THEN CAST((2000 * CAST({h} AS BIGINT) + {n}) // (2 * {n}) AS DOUBLE)"
        f" / 1000 WHEN {n} = 0 THEN 0.0 END"
    )


def union(selects) -> str:
    return "\nUNION ALL\n".join(selects)


# Rolling metrics

_ROLLED = f"""{FACTS}, rolled AS (
  SELECT r1.game_id, r1.local_date AS game_date, r1.batter,
    CAST(COALESCE((SELECT SUM(hit) FROM facts r2 WHERE r2.batter = r1.batter
      AND r2.local_date > r1.local_date - 100 AND r2.local_date < r1.local_date), 0) AS BIGINT)
      AS last_100_days_hits,
    CAST(COALESCE((SELECT SUM(atbat) FROM facts r2 WHERE r2.batter = r1.batter
      AND r2.local_date > r1.local_date - 100 AND r2.local_date < r1.local_date), 0) AS BIGINT)
      AS last_100_days_atbats
  FROM {{source}} r1)"""
_ROLLED_OUT = f"""SELECT game_id, CAST(game_date AS VARCHAR) AS game_date, batter,
  last_100_days_hits, last_100_days_atbats,
  {ratio_3("last_100_days_hits", "last_100_days_atbats")} AS rolling_average FROM rolled"""
_INSTANTS = f"""WITH facts AS (
  SELECT event_id AS game_id, user_id AS batter, ts,
    CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS hit, 1 AS atbat FROM events),
rolled AS (
  SELECT r1.game_id, r1.batter, CAST(COALESCE(SUM(r2.hit), 0) AS BIGINT) AS last_100_days_hits,
    CAST(COALESCE(SUM(r2.atbat), 0) AS BIGINT) AS last_100_days_atbats
  FROM facts r1 LEFT JOIN facts r2 ON r2.batter = r1.batter
    AND r2.ts > r1.ts - INTERVAL 100 DAY AND r2.ts < r1.ts
  GROUP BY r1.game_id, r1.batter)
SELECT game_id, batter, last_100_days_hits, last_100_days_atbats,
  {ratio_3("last_100_days_hits", "last_100_days_atbats")} AS rolling_average FROM rolled"""
_PAIRS = f"""WITH {FACTS}
SELECT r1.batter, CAST(SUM(r2.hit) AS BIGINT) AS sum_hits, CAST(SUM(r2.atbat) AS BIGINT) AS sum_bats
FROM facts r1 JOIN facts r2 ON r1.batter = r2.batter
  AND r2.local_date BETWEEN r1.local_date - 100 AND r1.local_date
GROUP BY r1.batter"""
_TOTALS = """SELECT batter, CAST(SUM(hit) AS BIGINT) AS total_hits,
  CAST(SUM(atbat) AS BIGINT) AS total_at_bats FROM {source} GROUP BY batter"""
_HISTORIC = f"""WITH {BC}, t AS ({_TOTALS.format(source="bc")})
SELECT *, {ratio_3("total_hits", "total_at_bats")} AS average FROM t"""
_ANNUAL = f"""WITH {FACTS}, t AS ({_TOTALS.format(source=f'''facts
  WHERE local_date BETWEEN CAST(DATE '{YEAR_END}' - INTERVAL 1 YEAR AS DATE) AND DATE '{YEAR_END}' ''')})
SELECT *, {ratio_3("total_hits", "total_at_bats")} AS annual_batting_average FROM t"""
_TARGET = f"""WITH {FACTS}
SELECT batter, ROUND(SUM(hit) / NULLIF(CAST(SUM(atbat) AS DOUBLE), 0), 6) AS batting_avg FROM facts
WHERE batter IN (SELECT batter FROM facts WHERE game_id = {TARGET_GAME})
  AND local_date BETWEEN (SELECT local_date FROM games WHERE game_id = {TARGET_GAME}) - 100
  AND (SELECT local_date FROM games WHERE game_id = {TARGET_GAME})
GROUP BY batter"""
_TOKENS = f"""WITH sums AS ({_PAIRS}), tokens AS (
  SELECT batter, UNNEST([0, 1]) AS pos, UNNEST([COALESCE(CAST(batter AS VARCHAR), ''),
    COALESCE(CAST(ROUND(CAST(sum_hits AS DOUBLE) / NULLIF(sum_bats, 0), 3) AS VARCHAR), '')]) AS token
  FROM sums)"""


# Association


def _stats_2d(source: str, pairs) -> str:
    """Cells, margins and chi-square sums of every pair, empty cells included."""
    cells = union(
        f"SELECT '{a}' AS predictor1, '{b}' AS predictor2, CAST({a} AS VARCHAR) AS v1,"
        f" CAST({b} AS VARCHAR) AS v2, COUNT(*) AS o FROM {source} GROUP BY ALL"
        for a, b in pairs
    )
    return f"""cells AS ({cells}),
rs AS (SELECT predictor1, predictor2, v1, SUM(o) AS rn FROM cells GROUP BY ALL),
cs AS (SELECT predictor1, predictor2, v2, SUM(o) AS cn FROM cells GROUP BY ALL),
ns AS (SELECT predictor1, predictor2, SUM(o) AS n FROM cells GROUP BY ALL),
full_cells AS (SELECT predictor1, predictor2, v1, v2, CAST(n AS DOUBLE) AS n,
    COALESCE(o, 0) AS o, CAST(rn AS DOUBLE) * cn / n AS e
  FROM rs JOIN cs USING (predictor1, predictor2) JOIN ns USING (predictor1, predictor2)
  LEFT JOIN cells USING (predictor1, predictor2, v1, v2)),
stats AS (SELECT predictor1, predictor2, ANY_VALUE(n) AS n, COUNT(DISTINCT v1) AS r,
    COUNT(DISTINCT v2) AS c, SUM((o - e) * (o - e) / e) AS chi2_plain,
    SUM(POWER(ABS(o - e) - LEAST(0.5, ABS(o - e)), 2) / e) AS chi2_reduced
  FROM full_cells GROUP BY predictor1, predictor2),
chi AS (SELECT predictor1, predictor2, n, r, c, chi2_plain AS chi2,
    CASE WHEN r = 2 AND c = 2 THEN chi2_reduced ELSE chi2_plain END AS chi2_yates FROM stats)"""


def _association(with_source: str, source: str, columns, corrected: bool, tschuprow: bool, both: bool):
    pairs = list(product(columns, columns) if both else combinations_with_replacement(columns, 2))
    if corrected:
        phi2 = "GREATEST(0, chi2 / n - (r - 1) * (c - 1) / (n - 1))"
        rc, cc = "(r - (r - 1) * (r - 1) / (n - 1))", "(c - (c - 1) * (c - 1) / (n - 1))"
    else:
        phi2, rc, cc = "chi2_yates / n", "r", "c"
    scale = f"SQRT(({rc} - 1) * ({cc} - 1))" if tschuprow else f"LEAST({rc} - 1, {cc} - 1)"
    return f"""WITH {with_source}, {_stats_2d(source, pairs)}
SELECT predictor1, predictor2, ROUND(SQRT({phi2} / {scale}), 6) AS score FROM chi"""


def _eta(pairs) -> str:
    return union(
        f"""SELECT '{x}' AS predictor1, '{g}' AS predictor2, ROUND(SQRT(
  (SELECT SUM(n * POWER(m - (SELECT AVG({x}) FROM features), 2)) FROM
    (SELECT COUNT(*) AS n, AVG({x}) AS m FROM features GROUP BY {g}))
  / (SELECT VAR_POP({x}) * COUNT(*) FROM features)), 5) AS score"""
        for x, g in pairs
    )


# Regression


def _ols(response: str, predictors) -> str:
    return union(
        f"""SELECT '{x}' AS feature, n, sxy / sxx AS slope, icpt AS intercept,
  (sxy / sxx) / SQRT((syy - sxy * sxy / sxx) / (n - 2) / sxx) AS t_value FROM (
  SELECT REGR_COUNT({response}, {x}) AS n, REGR_SXX({response}, {x}) AS sxx,
    REGR_SYY({response}, {x}) AS syy, REGR_SXY({response}, {x}) AS sxy,
    REGR_INTERCEPT({response}, {x}) AS icpt FROM features)"""
        for x in predictors
    )


# Two-sided p-values as 1 - 2 * (integral of the density from 0 to |t|), by Simpson's rule.
_SIMPSON = "CASE WHEN i = 0 OR i = 4000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"


def _p_value(source: str, stat: str, density: str, digits: int) -> str:
    return f"""SELECT feature, ROUND(1 - 2 * ANY_VALUE(ABS({stat})) / 4000 / 3
    * SUM({_SIMPSON} * {density.format(u=f"(ABS({stat}) * i / 4000)")}), {digits}) AS p_value
FROM {source}, (SELECT UNNEST(RANGE(0, 4001)) AS i) GROUP BY feature"""


_T_DENSITY = (
    "EXP(LGAMMA((n - 1) / 2) - LGAMMA((n - 2) / 2) - 0.5 * LN((n - 2) * PI())"
    " - (n - 1) / 2 * LN(1 + {u} * {u} / (n - 2)))"
)
_NORMAL_DENSITY = "EXP(-0.5 * {u} * {u}) / SQRT(2 * PI())"


def _logit(response: str, predictors, iterations: int = 9, tables: str = FEATURES, source: str = "features") -> str:
    """Newton steps written out; the predictors are standardised first."""
    long = union(
        f"SELECT '{x}' AS feature, CAST({response} AS DOUBLE) AS y, {x} AS x FROM {source}"
        f" WHERE {response} IS NOT NULL AND {x} IS NOT NULL AND NOT isnan({x})"
        for x in predictors
    )
    out = f"""WITH {tables}, long AS MATERIALIZED ({long}),
shape AS MATERIALIZED (SELECT feature, COUNT(*) AS n, AVG(x) AS m, STDDEV_POP(x) AS s
  FROM long GROUP BY feature),
data AS MATERIALIZED (SELECT feature, y, (x - m) / s AS z FROM long JOIN shape USING (feature)),
b0 AS MATERIALIZED (SELECT feature, 0.0::DOUBLE AS a, 0.0::DOUBLE AS b, 0.0::DOUBLE AS se FROM shape)"""
    for i in range(iterations):
        out += f""",
b{i + 1} AS MATERIALIZED (
  SELECT feature, a + (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01) AS a,
    b + (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01) AS b,
    SQRT(h00 / (h00 * h11 - h01 * h01)) AS se
  FROM (SELECT feature, ANY_VALUE(a) AS a, ANY_VALUE(b) AS b, SUM(y - p) AS g0,
      SUM((y - p) * z) AS g1, SUM(p * (1 - p)) AS h00, SUM(p * (1 - p) * z) AS h01,
      SUM(p * (1 - p) * z * z) AS h11
    FROM (SELECT d.feature, y, z, a, b, 1 / (1 + EXP(-(a + b * z))) AS p
      FROM data d JOIN b{i} USING (feature)) GROUP BY feature))"""
    return out + f""", fit AS (SELECT feature, n, b / s AS slope, a - b * m / s AS intercept,
  b / se AS z_value FROM b{iterations} JOIN shape USING (feature))"""


# Binned mean square differences


def _edges(x: str) -> str:
    return f"(SELECT MIN({x}) AS lo, (MAX({x}) - MIN({x})) / 10 AS step FROM features)"


def _bin(x: str, lo: str, step: str, op: str) -> str:
    crossed = " + ".join(f"CAST({x} {op} {lo} + {step} * {i} AS INT)" for i in range(1, 10))
    return f"CASE WHEN {x} <= {lo} + {step} * 10 THEN {crossed} END"


def _msd_1d(response: str | None) -> str:
    parts = []
    for x in CONTINUOUS:
        measure = response or x
        parts.append(f"""SELECT '{x}' AS feature, bin, lo + step * bin AS lower,
  lo + step * (bin + 1) AS upper, COALESCE(median, 0) AS median, COALESCE(n, 0) AS count,
  COALESCE(bm, 0) AS bin_mean, pm AS pop_mean, COALESCE(POWER(bm - pm, 2), 0) AS msd,
  COALESCE(n / total, 0) AS pop_proportion, COALESCE(POWER(bm - pm, 2) * (n / total), 0) AS weighted_msd
FROM ((SELECT CAST(UNNEST(RANGE(0, 10)) AS INT) AS bin) CROSS JOIN {_edges(x)} CROSS JOIN
  (SELECT AVG({measure}) AS pm, CAST(COUNT(*) AS DOUBLE) AS total FROM features))
LEFT JOIN (SELECT {_bin(x, "lo", "step", ">=")} AS bin, COUNT(*) AS n, AVG({measure}) AS bm,
    MEDIAN({x}) AS median FROM features, {_edges(x)} GROUP BY 1) USING (bin)""")
    return f"WITH {FEATURES}, msd AS ({union(parts)})"


def _rounded(columns: dict[str, int | None]) -> str:
    return ", ".join(c if d is None else f"ROUND({c}, {d}) AS {c}" for c, d in columns.items())


_MSD_COLUMNS = ["lower", "upper", "median", "bin_mean", "pop_mean", "msd", "pop_proportion", "weighted_msd"]


def _msd_1d_out(digits: int) -> str:
    return _rounded({"feature": None, "bin": None, "count": None} | dict.fromkeys(_MSD_COLUMNS, digits))


def _cells_2d(pairs, left_binned: bool, right_binned: bool, scaled_down: bool) -> str:
    binned = {c: f"b_{c}" for c in CONTINUOUS}
    keyed = "SELECT features.*, " + ", ".join(
        _bin(c, f"e_{c}.lo", f"e_{c}.step", ">") + f" AS b_{c}" for c in CONTINUOUS
    ) + " FROM features, " + ", ".join(f"{_edges(c)} e_{c}" for c in CONTINUOUS)
    weight = "1 / (n * total)" if scaled_down else "n / total"
    parts = union(
        f"SELECT '{a}' AS predictor1, '{b}' AS predictor2,"
        f" CAST({binned[a] if left_binned else a} AS VARCHAR) AS bin1,"
        f" CAST({binned[b] if right_binned else b} AS VARCHAR) AS bin2, COUNT(*) AS n,"
        f" AVG(is_returned) AS bin_mean FROM keyed GROUP BY ALL"
        for a, b in pairs
    )
    return f"""SELECT predictor1, predictor2, bin1, bin2, n, bin_mean,
  POWER(bin_mean - pm, 2) AS msd, POWER(bin_mean - pm, 2) * ({weight}) AS weighted_msd
FROM ({f"WITH keyed AS MATERIALIZED ({keyed}) {parts}"}),
  (SELECT AVG(is_returned) AS pm, CAST(COUNT(*) AS DOUBLE) AS total FROM features)"""


_CONT_CONT = list(combinations_with_replacement(CONTINUOUS, 2))
_CONT_CAT = list(product(CONTINUOUS, CATEGORICAL))
_CAT_CAT = list(combinations_with_replacement(CATEGORICAL, 2))


def _cells_out(cells: str, digits: int, scale: str = "") -> str:
    return f"""WITH {FEATURES}, cells AS ({cells})
SELECT predictor1, predictor2, bin1, bin2, n, ROUND(bin_mean, {digits}) AS bin_mean,
  ROUND(msd, {digits}) AS msd, ROUND(weighted_msd{scale}, {digits}) AS weighted_msd FROM cells"""


def _rank() -> str:
    kinds = {
        "cont_cont": _cells_2d(_CONT_CONT, True, True, False),
        "cont_cat": _cells_2d(_CONT_CAT, True, False, False),
        "cat_cat": _cells_2d(_CAT_CAT, False, False, False),
    }
    return f"WITH {FEATURES} " + union(
        f"""SELECT predictor1, predictor2, ROUND(AVG(msd), 8) AS unweighted_msd,
  ROUND(AVG(weighted_msd), 8) AS weighted_msd, '{k}' AS kind FROM ({c}) GROUP BY ALL"""
        for k, c in kinds.items()
    )


# Nearest neighbours

_UNITS = """units AS (
  SELECT vec_id, label, CASE WHEN norm = 0 THEN v ELSE [x / norm FOR x IN v] END AS u
  FROM (SELECT vec_id, label, v, SQRT(list_inner_product(v, v)) AS norm
    FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)))"""


def _near(condition: str) -> str:
    return f"""WITH {_UNITS}, pairs AS (
  SELECT a.vec_id AS id, a.label, b.vec_id AS other, b.label AS other_label,
    ROUND(list_distance(a.u, b.u), 9) AS d
  FROM units a JOIN units b ON {condition}),
near AS (SELECT * FROM pairs
  QUALIFY ROW_NUMBER() OVER (PARTITION BY id ORDER BY d, other) <= 5),
weights AS (SELECT *, CASE WHEN MIN(d) OVER (PARTITION BY id) = 0
    THEN CAST(d = 0 AS INT) ELSE 1 / NULLIF(d, 0) END AS w FROM near),
votes AS (SELECT id, label, other_label, SUM(w) AS w FROM weights GROUP BY ALL)"""


_PREDICTED = """SELECT id, label, other_label AS predicted FROM votes
QUALIFY ROW_NUMBER() OVER (PARTITION BY id ORDER BY ROUND(w, 9) DESC, other_label) = 1"""


def _violin() -> str:
    x, group = "l_extendedprice", "l_returnflag"
    edges = f"(SELECT MIN({x}) AS lo, (MAX({x}) - MIN({x})) / 20 AS step FROM features)"
    crossed = " + ".join(f"CAST({x} >= lo + step * {i} AS INT)" for i in range(1, 20))
    return f"""binned AS (SELECT {group}, {x}, lo, step,
  CASE WHEN {x} <= lo + step * 20 THEN {crossed} END AS bin FROM features, {edges})"""


def _five(x: str) -> str:
    return ", ".join(
        f"QUANTILE_CONT(CAST({x} AS DOUBLE), {p}) AS q{i}"
        for i, p in enumerate((0, 0.25, 0.5, 0.75, 1))
    )


def _kinds() -> str:
    fixed = {c: "continuous" for c in CONTINUOUS}
    fixed |= {c: "categorical" for c in ("l_returnflag", "l_linestatus", "p_type")}
    counted = ["l_orderkey", "l_linenumber", "p_size", "is_returned"]
    return f"WITH {FEATURES} " + union(
        [f"SELECT '{c}' AS column_name, '{k}' AS kind" for c, k in fixed.items()]
        + [
            f"SELECT '{c}', CASE WHEN COUNT(DISTINCT {c}) / COUNT(*) <= 0.1"
            " THEN 'categorical' ELSE 'continuous' END FROM features"
            for c in counted
        ]
    )


ALL_FEATURES = [
    "l_orderkey", "l_linenumber", *CONTINUOUS, "l_returnflag", "l_linestatus", "p_type", "p_size",
    "is_returned",
]


def all_oracles() -> dict[str, str]:
    corr = union(
        f"SELECT '{a}' AS predictor1, '{b}' AS predictor2, ROUND(CORR({a}, {b}), 5) AS score FROM features"
        for a, b in product(CONTINUOUS, CONTINUOUS)
    )
    corr_upper = union(
        f"SELECT '{a}' AS predictor1, '{b}' AS predictor2, ROUND(CORR({a}, {b}), 5) AS score FROM features"
        for a, b in _CONT_CONT
    )
    matrix = ", ".join(f"MAX(score) FILTER (predictor1 = '{c}') AS {c}" for c in CONTINUOUS)
    labels_pairs = [("quality", "toxic"), ("quality", "quality"), ("toxic", "toxic")]
    ols = f"WITH {FEATURES}, fit AS ({_ols('l_extendedprice', PREDICTORS)})"
    logit = _logit("is_returned", CONTINUOUS)
    docs = (LABELLED_DOCS, "labelled", LABELLED)
    quartiles = (
        f"WITH {FEATURES}, q AS ("
        + union(f"SELECT '{c}' AS feature, {_five(c)} FROM features" for c in CONTINUOUS)
        + ") SELECT feature, " + ", ".join(f"ROUND(q{i}, 4) AS q{i}" for i in range(5)) + " FROM q"
    )
    class_counts = f"""WITH {FEATURES} SELECT p_type, COUNT(*) AS n,
  ROUND(COUNT(*) / (SELECT COUNT(*) FROM features), 6) AS share FROM features GROUP BY p_type"""
    cats = (FEATURES, "features", CATEGORICAL)
    return {
        "rolling_avg": "WITH "
        + _ROLLED.format(source="(SELECT * FROM facts ORDER BY game_id DESC, batter LIMIT 100)")
        + _ROLLED_OUT,
        "rolling_avg_all": "WITH " + _ROLLED.format(source="facts") + _ROLLED_OUT,
        "rolling_avg_instants": _INSTANTS,
        "fact_join": f"WITH {FACTS} SELECT * REPLACE (CAST(local_date AS VARCHAR) AS local_date) FROM facts",
        "rolling_window_median": f"""WITH {FACTS}
SELECT a.batter, CAST(a.local_date AS VARCHAR) AS local_date, MEDIAN(b.hit) AS median_hits,
  COUNT(DISTINCT b.game_id) AS n_games
FROM (SELECT DISTINCT batter, local_date FROM facts) a JOIN facts b ON a.batter = b.batter
  AND b.local_date BETWEEN a.local_date - 100 AND a.local_date
GROUP BY a.batter, a.local_date""",
        "historic_avg": _HISTORIC,
        "publish_replace": _HISTORIC,
        "publish_if_absent": "SELECT * FROM supplier",
        "annual_avg": _ANNUAL,
        "rolling_pairs_window": _PAIRS,
        "rolling_pairs_sql": _PAIRS,
        "target_game_avg": _TARGET,
        "scan_csv": "SELECT * FROM part",
        "sink_tsv": "SELECT * FROM customer",
        "typed_empty_union": f"""WITH {FACTS} SELECT CAST(game_id AS INT) AS game_id,
  CAST(batter AS INT) AS batter, hit, atbat, CAST(local_date AS VARCHAR) AS local_date FROM facts""",
        "ctas_replace": _HISTORIC,
        "ctas_if_absent": "SELECT * FROM supplier",
        "preview": f"WITH {BC} SELECT * FROM bc ORDER BY game_id DESC, batter LIMIT 200",
        "feature_label_split": """SELECT p_partkey, CAST(p_size AS DOUBLE) AS f0,
  p_retailprice AS f1, p_type AS label FROM part""",
        "stride_sample": """SELECT o_orderkey, o_custkey, o_totalprice, i AS row_index FROM (
  SELECT *, ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders) WHERE i % 7 = 0""",
        "dropna_any": f"""WITH {GAPS} SELECT * FROM gaps WHERE p_name IS NOT NULL
  AND p_size IS NOT NULL AND p_retailprice IS NOT NULL AND NOT ISNAN(p_retailprice)""",
        "fillna_zero": f"""WITH {GAPS} SELECT p_partkey, COALESCE(p_name, '0') AS p_name,
  COALESCE(p_size, 0) AS p_size, CASE WHEN p_retailprice IS NULL OR ISNAN(p_retailprice) THEN 0
  ELSE p_retailprice END AS p_retailprice FROM gaps""",
        "binarize_response": """SELECT o_orderkey, CASE WHEN o_orderstatus =
  (SELECT MIN(o_orderstatus) FROM orders) THEN 0 ELSE 1 END AS o_orderstatus FROM orders""",
        "scalar_math": f"""SELECT l_orderkey, ROUND(SQRT(l_quantity), 5) AS root,
  ROUND(POWER(l_discount, 2), 4) AS squared, ROUND(ABS(l_tax - l_discount), 3) AS gap,
  GREATEST(0.0, l_quantity - 25) AS over_25, LEAST(l_quantity, 25.0) AS up_to_25,
  ROUND(l_tax / NULLIF(l_discount, 0), 4) AS ratio,
  FORMAT('{{:.6e}}', l_extendedprice) AS price_text,
  {ratio_3("CAST(LEAST(l_quantity, 25) AS INT)", "CAST(l_quantity AS INT)")} AS share FROM lineitem""",
        "scalar_date": f"""SELECT o_orderkey,
  CAST(CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 YEAR AS DATE) AS VARCHAR) AS year_before,
  CAST(CAST(o_orderdate AS DATE) - 100 AS VARCHAR) AS days_before,
  CAST(CAST(o_orderdate AS DATE) BETWEEN CAST(DATE '{YEAR_END}' - INTERVAL 1 YEAR AS DATE)
    AND DATE '{YEAR_END}' AS INT) AS in_year FROM orders""",
        "scalar_null": f"""WITH {GAPS} SELECT p_partkey, COALESCE(p_size, 0) AS size_or_0,
  CASE WHEN p_name IS NULL THEN '' ELSE p_name END AS name_or_empty FROM gaps""",
        "summary_stats": f"WITH {FEATURES} "
        + union(
            f"SELECT '{c}' AS feature, ROUND(AVG({c}), 3) AS mean, ROUND(MIN({c}), 3) AS min,"
            f" ROUND(MAX({c}), 3) AS max FROM features"
            for c in CONTINUOUS
        ),
        "quartiles": quartiles,
        "quartiles_split": quartiles,
        "class_counts": class_counts,
        "class_counts_written": class_counts,
        "column_kinds": _kinds(),
        "column_kinds_sketched": _kinds(),
        "boolean_columns_sketched": f"WITH {FEATURES} "
        + union(
            f"SELECT '{c}' AS column_name, CAST(COUNT(DISTINCT {c}) = 2 AS INT) AS is_boolean FROM features"
            for c in ALL_FEATURES
        ),
        "quartiles_sketched": union(
            f"""SELECT '{c}' AS feature, CAST({p} AS DOUBLE) AS p, COUNT({c}) AS n, 1 AS "within" FROM lineitem
WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '{SKETCH_DAYS[0]}' AND DATE '{SKETCH_DAYS[1]}'"""
            for c in ("l_quantity", "l_extendedprice", "l_discount")
            for p in (0.25, 0.5, 0.75)
        ),
        "boolean_columns": f"WITH {FEATURES} "
        + union(
            f"SELECT '{c}' AS column_name, CAST(COUNT(DISTINCT {c}) = 2 AS INT) AS is_boolean FROM features"
            for c in ALL_FEATURES
        ),
        "contingency": f"WITH {FEATURES} SELECT p_type, p_size, COUNT(*) AS n FROM features GROUP BY ALL",
        "crosstab_sparse": """WITH cells AS (
  SELECT l_returnflag, l_partkey, COUNT(*) AS n FROM lineitem GROUP BY ALL)
SELECT l_returnflag, DENSE_RANK() OVER (ORDER BY l_partkey) - 1 AS y_index, l_partkey, n,
  CAST(SUM(n) OVER (PARTITION BY l_returnflag) AS BIGINT) AS x_total,
  CAST(SUM(n) OVER (PARTITION BY l_partkey) AS BIGINT) AS y_total FROM cells""",
        "crosstab": """SELECT source, lang, COUNT(d.doc_id) AS n, ANY_VALUE(x_total) AS x_total,
  ANY_VALUE(y_total) AS y_total
FROM (SELECT source, COUNT(*) AS x_total FROM documents GROUP BY source)
CROSS JOIN (SELECT lang, COUNT(*) AS y_total FROM documents GROUP BY lang)
LEFT JOIN documents d USING (source, lang) GROUP BY source, lang""",
        "crosstab_values": f"""WITH {ODD_DOCS} SELECT source, odd, COUNT(d.seen) AS n,
  ANY_VALUE(x_total) AS x_total, ANY_VALUE(y_total) AS y_total
FROM (SELECT source, COUNT(*) AS x_total FROM odd_docs GROUP BY source)
CROSS JOIN (SELECT odd, COUNT(*) AS y_total FROM odd_docs GROUP BY odd)
LEFT JOIN (SELECT *, 1 AS seen FROM odd_docs) d USING (source, odd) GROUP BY source, odd""",
        "crosstab_wide": f"""WITH {FEATURES} SELECT p_type,
  COUNT(*) FILTER (l_linestatus = 'F') AS F, COUNT(*) FILTER (l_linestatus = 'O') AS O
FROM features GROUP BY p_type""",
        "corr_pairs": f"WITH {FEATURES} {corr}",
        "corr_pairs_missing": f"WITH {FEATURE_GAPS} "
        + union(
            f"""SELECT '{a}' AS predictor1, '{b}' AS predictor2, ROUND(CORR({a}, {b}), 5) AS score
FROM gapped WHERE NOT isnan(CAST({a} AS DOUBLE)) AND NOT isnan(CAST({b} AS DOUBLE))"""
            for a, b in product([*CONTINUOUS, "is_returned"], repeat=2)
        ),
        "corr_wide": f"""WITH wide AS (
  SELECT {', '.join(f"{wide_expression(k)} AS {c}" for k, c in enumerate(WIDE))} FROM lineitem),
scores AS (SELECT {', '.join(f'ROUND(CORR({a}, {b}), 5) AS "{a}|{b}"' for a, b in combinations_with_replacement(WIDE, 2))}
  FROM wide)
SELECT split_part(pair, '|', 1) AS predictor1, split_part(pair, '|', 2) AS predictor2, score
FROM scores UNPIVOT INCLUDE NULLS (score FOR pair IN (COLUMNS(*)))""",
        "corr_table": f"WITH {FEATURES} {corr_upper}",
        "corr_matrix": f"""WITH {FEATURES}, scores AS ({corr})
SELECT predictor2, {matrix} FROM scores GROUP BY predictor2""",
        "correlation_ratio": f"WITH {FEATURES} {_eta(_CONT_CAT)}",
        "correlation_ratio_matrix": f"""WITH {FEATURES}, scores AS ({_eta(_CONT_CAT)})
SELECT predictor2, {matrix} FROM scores GROUP BY predictor2""",
        "chi2": f"""WITH {FEATURES}, {_stats_2d("features", _CAT_CAT)}
SELECT predictor1, predictor2, CAST(n AS BIGINT) AS n, r, c, ROUND(chi2, 4) AS chi2 FROM chi""",
        "chi2_yates": f"""WITH {_stats_2d("labels", labels_pairs)}
SELECT predictor1, predictor2, CAST(n AS BIGINT) AS n, r, c, ROUND(chi2_yates, 6) AS chi2 FROM chi""",
        "cramers_v": _association(*cats, True, False, False),
        "cramers_v_plain": _association(*cats, False, False, False),
        "cramers_v_labels": _association(*docs, True, False, True),
        "cramers_v_labels_plain": _association(*docs, False, False, False),
        "tschuprows_t": _association(*docs, True, True, False),
        "tschuprows_t_plain": _association(*docs, False, True, False),
        "ols_per_feature": f"""{ols} SELECT feature, n, ROUND(slope, 4) AS slope,
  ROUND(intercept, 4) AS intercept, ROUND(t_value, 4) AS t_value FROM fit""",
        "ols_pvalues": ols + _p_value("fit", "t_value", _T_DENSITY, 6),
        "ols_trend": f"""WITH {FEATURES} SELECT 'l_discount' AS feature,
  ROUND(REGR_SLOPE(l_tax, l_discount), 6) AS slope,
  ROUND(REGR_INTERCEPT(l_tax, l_discount), 6) AS intercept,
  ROUND(REGR_R2(l_tax, l_discount), 6) AS r2 FROM features""",
        "logit_per_feature": f"""{logit} SELECT feature, n, ROUND(slope, 6) AS slope,
  ROUND(intercept, 5) AS intercept, ROUND(z_value, 4) AS z_value FROM fit""",
        "logit_missing": _logit("is_returned", CONTINUOUS, 9, FEATURE_GAPS, "gapped")
        + """ SELECT feature, n, ROUND(slope, 6) AS slope,
  ROUND(intercept, 5) AS intercept, ROUND(z_value, 4) AS z_value FROM fit""",
        "logit_pvalues": logit + _p_value("fit", "z_value", _NORMAL_DENSITY, 5),
        "bin_edges": f"WITH {FEATURES} "
        + union(
            f"""SELECT '{c}' AS feature, bin, ROUND(lo + step * bin, 6) AS lower,
  ROUND(lo + step * (bin + 1), 6) AS upper
FROM (SELECT CAST(UNNEST(RANGE(0, 10)) AS INT) AS bin), {_edges(c)}"""
            for c in CONTINUOUS
        ),
        "msd1d": f"{_msd_1d(None)} SELECT {_msd_1d_out(3)} FROM msd",
        "msd1d_standard": f"{_msd_1d('is_returned')} SELECT {_msd_1d_out(6)} FROM msd",
        "msd1d_summary": f"""{_msd_1d(None)} SELECT feature,
  ROUND(AVG(msd) FILTER (msd <> 0), 3) AS msd,
  ROUND(AVG(weighted_msd) FILTER (weighted_msd <> 0), 3) AS weighted_msd FROM msd GROUP BY feature""",
        "msd2d_cont_cont": _cells_out(_cells_2d(_CONT_CONT, True, True, True), 6, " * 1e9"),
        "msd2d_cont_cont_standard": _cells_out(_cells_2d(_CONT_CONT, True, True, False), 8),
        "msd2d_cat_cont": _cells_out(_cells_2d(_CONT_CAT, True, False, False), 8),
        "msd2d_cat_cat": _cells_out(_cells_2d(_CAT_CAT, False, False, False), 8),
        "msd2d_rank": _rank(),
        "chart_scatter": f"WITH {FEATURES} SELECT l_discount AS x, l_extendedprice AS y FROM features",
        "chart_scatter_sample": """SELECT o_orderkey, o_custkey AS x, o_totalprice AS y FROM orders
ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 1000""",
        "chart_violin": f"""WITH {FEATURES}, {_violin()} SELECT l_returnflag, bin, COUNT(*) AS n,
  ROUND(COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY l_returnflag)
    / ((ANY_VALUE(lo) + ANY_VALUE(step) * 20 - ANY_VALUE(lo)) / 20), 9) AS density
FROM binned WHERE bin IS NOT NULL GROUP BY l_returnflag, bin""",
        "chart_violin_quartiles": f"""WITH {FEATURES}, q AS (
  SELECT p_type, {_five("l_extendedprice")} FROM features GROUP BY p_type)
SELECT p_type, {", ".join(f"ROUND(q{i}, 4) AS q{i}" for i in range(5))} FROM q""",
        "chart_box": f"""WITH q AS (SELECT lang, {_five("n_chars")} FROM documents GROUP BY lang)
SELECT lang, {", ".join(f"ANY_VALUE(q{i}) AS q{i}" for i in range(5))}, ANY_VALUE(q3 - q1) AS iqr,
  CAST(MIN(n_chars) FILTER (ok) AS DOUBLE) AS lower_whisker,
  CAST(MAX(n_chars) FILTER (ok) AS DOUBLE) AS upper_whisker, COUNT(*) FILTER (NOT ok) AS n_outliers
FROM (SELECT *, n_chars BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS ok
  FROM documents JOIN q USING (lang)) GROUP BY lang""",
        "chart_density": f"""WITH {FEATURES}
SELECT {_bin("l_quantity", "a.lo", "a.step", ">=")} AS x_cell,
  {_bin("l_extendedprice", "b.lo", "b.step", ">=")} AS y_cell, COUNT(*) AS n
FROM features, {_edges("l_quantity")} a, {_edges("l_extendedprice")} b GROUP BY 1, 2""",
        "chart_density_categories": f"""WITH {FEATURES}
SELECT p_type AS x_cell, l_returnflag AS y_cell, COUNT(*) AS n FROM features GROUP BY 1, 2""",
        "chart_histogram": f"""WITH {FEATURES}, {_violin()} SELECT l_returnflag, bin,
  ROUND(SUM(l_extendedprice), 2) AS height, COUNT(*) AS n
FROM binned WHERE bin IS NOT NULL GROUP BY l_returnflag, bin""",
        "chart_histogram_margins": f"""WITH {FEATURES}, {_violin()},
q AS (SELECT l_returnflag, {_five("l_extendedprice")} FROM features GROUP BY l_returnflag),
boxes AS (SELECT l_returnflag, {", ".join(f"ROUND(ANY_VALUE(q{i}), 4) AS q{i}" for i in range(5))},
  ROUND(ANY_VALUE(q3 - q1), 4) AS iqr, ROUND(MIN(l_extendedprice) FILTER (ok), 4) AS lower_whisker,
  ROUND(MAX(l_extendedprice) FILTER (ok), 4) AS upper_whisker, COUNT(*) FILTER (NOT ok) AS n_outliers
  FROM (SELECT *, l_extendedprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS ok
    FROM features JOIN q USING (l_returnflag)) GROUP BY l_returnflag),
bars AS (SELECT l_returnflag, bin, ROUND(SUM(l_extendedprice), 2) AS height, COUNT(*) AS n
  FROM binned WHERE bin IS NOT NULL GROUP BY l_returnflag, bin)
SELECT * FROM bars JOIN boxes USING (l_returnflag)""",
        "chart_msd": f"""{_msd_1d(None)} SELECT feature, bin, ROUND(median, 3) AS x,
  ROUND(bin_mean, 3) AS y, ROUND(lower, 3) AS center, count, ROUND(pop_mean, 3) AS pop_mean
FROM msd WHERE count > 0""",
        "l2_normalize": f"""WITH {_UNITS} SELECT vec_id,
  CAST(UNNEST(RANGE(0, LEN(u))) AS INT) AS pos, ROUND(UNNEST(u), 6) AS value FROM units""",
        "knn_classify": _near("a.vec_id <> b.vec_id") + _PREDICTED,
        "knn_classify_blocks": _near("a.vec_id <> b.vec_id") + _PREDICTED,
        "knn_lsh": "SELECT COUNT(*) AS n_queries, 1 AS recall_90 FROM embeddings",
        "rf_classify_summary": """SELECT COUNT(*) AS n_rows, COUNT(*) AS n_proper,
  COUNT(*) AS n_most_probable FROM embeddings""",
        "rf_classify_accuracy": """SELECT CAST(SUM(n) AS BIGINT) AS n_rows, MAX(n) AS n_majority,
  CAST(SUM(n) AS BIGINT) AS n_proper, TRUE AS beats_majority, TRUE AS knows_its_rows
FROM (SELECT label, COUNT(*) AS n FROM embeddings GROUP BY label)""",
        "rf_importance_summary": f"""WITH {FEATURES}
SELECT 'is_returned' AS response, {len(CONTINUOUS)} AS n_features, 1.0 AS total
FROM features HAVING COUNT(DISTINCT is_returned) > 1
UNION ALL SELECT 'l_extendedprice', {len(PREDICTORS)}, 1.0
FROM features HAVING COUNT(DISTINCT l_extendedprice) > 1""",
        "knn_classify_in_sample": _near("TRUE") + _PREDICTED,
        "knn_proba": _near("a.vec_id <> b.vec_id")
        + """SELECT id, other_label AS class,
  ROUND(w / SUM(w) OVER (PARTITION BY id), 6) AS probability FROM votes WHERE w > 0""",
        "metric_tokens": f"{_TOKENS} SELECT batter, CAST(pos AS INT) AS pos, token FROM tokens",
        "vocabulary": f"""{_TOKENS}, counted AS (SELECT token, COUNT(*) AS n FROM tokens GROUP BY token)
SELECT ROW_NUMBER() OVER (ORDER BY n DESC, token) - 1 AS "index", token, n FROM counted""",
        "count_vectors": f"""{_TOKENS}, words AS (
  SELECT token, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, token) - 1 AS "index" FROM tokens GROUP BY token)
SELECT batter, "index", CAST(COUNT(*) AS DOUBLE) AS n FROM tokens JOIN words USING (token)
GROUP BY ALL""",
        "chart_violin_kde": f"""WITH {FEATURES},
span AS (SELECT MIN(l_extendedprice) AS lo, (MAX(l_extendedprice) - MIN(l_extendedprice)) / 63 AS step FROM features),
placed AS (SELECT l_returnflag, (l_extendedprice - lo) / step AS place,
  LEAST(FLOOR((l_extendedprice - lo) / step), 62) AS l FROM features, span),
binned AS (
  SELECT l_returnflag, point, SUM(weight) AS weight FROM (
    SELECT l_returnflag, l AS point, 1 - (place - l) AS weight FROM placed
    UNION ALL SELECT l_returnflag, l + 1, place - l FROM placed) GROUP BY ALL),
moments AS (SELECT l_returnflag, COUNT(*) AS n,
  1.06 * STDDEV_SAMP(l_extendedprice) * POW(COUNT(*), -0.2) AS width FROM features GROUP BY ALL),
places AS (SELECT UNNEST(RANGE(64)) AS p)
SELECT l_returnflag, CAST(p AS INT) AS point, ROUND(ANY_VALUE(lo) + p * ANY_VALUE(step), 4) AS x,
  ROUND(SUM(weight * EXP(-POW((p - point) * step / width, 2) / 2) / (n * width * SQRT(2 * PI()))) * 1e6, 6) AS density
FROM binned JOIN moments USING (l_returnflag), places, span GROUP BY l_returnflag, p""",
        "count_vectorize": f"""{_TOKENS} SELECT batter, token, CAST(COUNT(*) AS DOUBLE) AS n
FROM tokens GROUP BY batter, token""",
    }
