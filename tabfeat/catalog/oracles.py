"""The same queries in SQL, for checking results against another engine."""

from __future__ import annotations

import numpy as np

from tabfeat.fixed_values import (
    EMAIL_STRICT, HIGHER_IS_BETTER, INVERSE_NORMAL, METRICS, PHONE_LOOSE, PHONE_STRICT, PII_KEYWORDS, RECOMMENDATIONS, SUMMARY,
)
from tabfeat.plans.search import drawn_trials

KEY = "l_orderkey, l_partkey, l_suppkey, l_linenumber, price_cents"
FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "line_no")
INTER = ("l_extendedprice", "l_discount", "l_quantity", "l_tax")
MODELS = ("list_price", "net_price", "typical_rate")

LINE = """line AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber::BIGINT AS l_linenumber,
         round(l_extendedprice * 100)::BIGINT AS price_cents,
         l_quantity, l_extendedprice, l_discount, l_tax, l_linenumber::DOUBLE AS line_no,
         l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge,
         l_extendedprice * l_discount AS discount_amount
  FROM lineitem)"""


def digest(purpose: str, key: str = KEY) -> str:
    return f"md5(concat_ws('|', {key}, '{purpose}-42'))"


LINE_NULL = f"""{LINE}, line_null AS (
  SELECT * EXCLUDE (rk) REPLACE (CASE WHEN rk > floor(0.05 * (SELECT count(*) FROM line)) THEN l_quantity END AS l_quantity)
  FROM (SELECT *, row_number() OVER (ORDER BY {digest('missing')}, {KEY}) AS rk FROM line))"""


def split_of(source: str) -> str:
    return f"""split_rows AS (
  SELECT * EXCLUDE (rk, n), CASE WHEN rk <= ceil(0.2 * n) THEN 'test'
         WHEN rk <= ceil(0.2 * n) + ceil(0.2 / (1 - 0.2) * (n - ceil(0.2 * n))) THEN 'val' ELSE 'train' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY {digest('split')}, {KEY}) AS rk, count(*) OVER () AS n FROM {source})),
train AS (SELECT * FROM split_rows WHERE split = 'train')"""


LINE_SPLIT = f"{LINE_NULL}, {split_of('line_null')}"
INTER_SPLIT = f"{LINE}, {split_of('line')}"


def hash_split(key: str) -> str:
    order = digest("split", key)
    return f"CASE WHEN {order} < '33333333' THEN 'test' WHEN {order} < '66666666' THEN 'val' ELSE 'train' END"


EVENTS = """evt AS (SELECT event_id, ts, value, hour(ts)::DOUBLE AS hour, day(ts)::DOUBLE AS day,
  user_id::DOUBLE AS "user", ln(1 + value) AS log_value FROM events)"""
ACCOUNTS = """acct AS (SELECT c_custkey, c_acctbal, c_nationkey::DOUBLE AS nation, c_mktsegment FROM customer)"""

PREDICTIONS = f"""{LINE}, pred_rows AS (
  SELECT m.model, {hash_split(KEY)} AS split, {KEY}, line_no, charge AS y,
         CASE m.model WHEN 'list_price' THEN l_extendedprice WHEN 'net_price' THEN l_extendedprice * (1 - l_discount)
              ELSE l_extendedprice * 0.988 END AS pred
  FROM line, (SELECT unnest(['list_price', 'net_price', 'typical_rate']) AS model) m)"""


def r(expr: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) + 0.0"


def rs(columns, digits: int = 6) -> str:
    return ", ".join(f"{r(c, digits)} AS {c}" for c in columns)


def measure_ctes(source: str, by: str, order: str) -> str:
    """CTE ``m`` with the ten metrics per group."""
    pairs = ", ".join(f"{m}" for m in METRICS)
    keys = " AND ".join(f"a.{c.strip()} = s.{c.strip()}" for c in by.split(","))
    return f"""a AS (
  SELECT {by}, avg(pow(y - pred, 2)) AS mse, sqrt(avg(pow(y - pred, 2))) AS rmse, avg(abs(y - pred)) AS mae,
    CASE WHEN var_pop(y) = 0 THEN CASE WHEN sum(pow(y - pred, 2)) = 0 THEN 1.0 ELSE 0.0 END
         ELSE 1 - sum(pow(y - pred, 2)) / (count(*) * var_pop(y)) END AS r2,
    coalesce(avg(abs((y - pred) / nullif(y, 0))) * 100, 'inf'::DOUBLE) AS mape,
    coalesce(avg(abs(y - pred) / nullif((abs(y) + abs(pred)) / 2, 0)) * 100, 'inf'::DOUBLE) AS smape,
    quantile_cont(abs(y - pred), 0.5) AS median_ae, max(abs(y - pred)) AS max_error,
    CASE WHEN var_pop(y) = 0 THEN CASE WHEN bool_and(abs(y - pred) <= 1e-8 + 1e-5 * abs(pred)) THEN 1.0 ELSE 0.0 END
         ELSE 1 - var_pop(y - pred) / var_pop(y) END AS explained_variance
  FROM {source} GROUP BY {by}),
s AS (SELECT {by}, avg(abs(y - before)) AS naive FROM
  (SELECT *, lag(y) OVER (PARTITION BY {by} ORDER BY {order}) AS before FROM {source}) GROUP BY {by}),
m AS (SELECT a.*, CASE WHEN naive > 0 THEN mae / naive ELSE 'inf'::DOUBLE END AS mean_absolute_scaled_error
  FROM a JOIN s ON {keys}),
long AS (UNPIVOT m ON {pairs} INTO NAME metric VALUE value)"""


def yeo_johnson(x: str, lam: str) -> str:
    return f"""CASE WHEN {x} >= 0 THEN CASE WHEN {lam} = 0 THEN ln(1 + {x}) ELSE (pow(1 + {x}, {lam}) - 1) / nullif({lam}, 0) END
      ELSE CASE WHEN {lam} = 2 THEN -ln(1 - ({x})) ELSE -(pow(1 - ({x}), 2 - {lam}) - 1) / nullif(2 - {lam}, 0) END END"""


def skewed(c: str, source: str) -> str:
    """Whether a column is positive with population skewness above 1."""
    return f"""(SELECT min({c}) > 0 AND avg(pow({c} - mu, 3)) / pow(avg(pow({c} - mu, 2)), 1.5) > 1
      FROM {source}, (SELECT avg({c}) AS mu FROM {source}))"""


def code(x: str, edges: str) -> str:
    return f"len(list_filter({edges}, lambda e: {x} > e))::BIGINT"


def inner_edges(x: str, bins: int) -> str:
    probs = ", ".join(repr(i / bins) for i in range(bins + 1))
    return f"list_sort(list_distinct(quantile_cont({x}, [{probs}])))[2:-2]"


def histogram(source: str, columns, bins: int) -> str:
    long = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS x FROM {source} WHERE {c} IS NOT NULL" for c in columns)
    return f"""v AS ({long}),
b AS (SELECT "column", min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / {bins} AS w FROM v GROUP BY 1),
c AS (SELECT "column", least(floor((x - lo) / w), {bins - 1})::BIGINT AS bin, count(*) AS n FROM v JOIN b USING ("column") GROUP BY 1, 2)
SELECT b."column", g.bin::BIGINT AS bin, {r('lo + g.bin * w')} AS "left",
  CASE WHEN g.bin = {bins - 1} THEN {r('hi')} ELSE {r('lo + (g.bin + 1) * w')} END AS "right", coalesce(c.n, 0) AS "count"
FROM b CROSS JOIN (SELECT unnest(range({bins})) AS bin) g LEFT JOIN c ON c."column" = b."column" AND c.bin = g.bin"""


ORACLES: dict[str, str] = {}
Q = ORACLES

# --- sources, sinks, previews -------------------------------------------------------------
Q["load_features"] = f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber::BIGINT AS l_linenumber,
  {rs(('l_quantity', 'l_discount', 'l_tax', 'l_extendedprice'))} FROM lineitem"""
Q["inject_missing"] = f"WITH {LINE_NULL} SELECT {KEY}, {rs(['l_quantity'])} FROM line_null"
Q["save_splits"] = f"""WITH {LINE_SPLIT} SELECT split, count(*) AS n_rows, sum(price_cents)::BIGINT AS cents,
  count(*) FILTER (l_quantity IS NULL) AS missing FROM split_rows GROUP BY split"""
Q["load_splits"] = f"WITH {LINE_SPLIT} SELECT {KEY}, {rs((*FEATURES, 'charge'))}, split FROM split_rows WHERE split = 'val'"
Q["preview_rows"] = f"WITH {LINE} SELECT {KEY}, {rs((*FEATURES, 'charge'))} FROM line ORDER BY {KEY} LIMIT 10"

# --- profiling ----------------------------------------------------------------------------
Q["data_info"] = f"""WITH {LINE_NULL} SELECT count(*) AS n_rows, 5::BIGINT AS n_features, '{','.join(FEATURES)}' AS feature_names,
  'charge' AS target_name, {r('min(charge)')} AS target_min, {r('max(charge)')} AS target_max,
  {', '.join(f'count(*) FILTER ({c} IS NULL) AS missing_{c}' for c in FEATURES)},
  'double,double,double,double,double' AS types FROM line_null"""
Q["missing_by_column"] = f"""WITH {LINE_NULL} SELECT * FROM ({' UNION ALL '.join(
    f'''SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS missing FROM line_null''' for c in (*FEATURES, 'charge'))})
WHERE missing > 0"""
Q["missing_total"] = f"""WITH {LINE_NULL} SELECT ({' + '.join(
    f'count(*) FILTER ({c} IS NULL)' for c in (*FEATURES, 'charge'))})::BIGINT AS missing FROM line_null"""
_corr = (*FEATURES, "charge")
Q["corr_matrix"] = f"WITH {LINE_NULL} " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {r(f'corr({a}, {b})')} AS r FROM line_null" for a in _corr for b in _corr)
Q["hist_target"] = f"WITH {LINE}, {histogram('line', ['charge'], 30)}"
Q["hist_features"] = f"WITH {LINE_NULL}, {histogram('line_null', FEATURES[:4], 20)}"

# --- splitting ----------------------------------------------------------------------------
Q["split_exact"] = f"WITH {LINE_SPLIT} SELECT {KEY}, split FROM split_rows"
Q["split_hash"] = f"WITH {LINE} SELECT {KEY}, {hash_split(KEY)} AS split FROM line"
Q["prepare_data"] = f"WITH {LINE_SPLIT} SELECT {KEY}, {rs(('l_quantity', 'charge'))}, split FROM split_rows"

# --- feature transformers -----------------------------------------------------------------
Q["impute_mean"] = f"""WITH {LINE_SPLIT} SELECT {KEY}, {', '.join(
    f"{r(f'coalesce({c}, (SELECT avg({c}) FROM train))')} AS {c}" for c in FEATURES)} FROM split_rows"""
Q["impute_median"] = f"""WITH {LINE_SPLIT} SELECT {KEY}, {', '.join(
    f"{r(f'coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM train))')} AS {c}" for c in FEATURES)} FROM split_rows"""
_evt = ("value", "hour", "day", '"user"')
Q["log_skewed"] = f"""WITH {EVENTS} SELECT event_id, {', '.join(
    f"{r(f'CASE WHEN {skewed(c, 'evt')} THEN ln(nullif(greatest({c}, 0), 0)) ELSE {c} END')} AS {c}"
    for c in _evt)} FROM evt"""
Q["power"] = f"WITH {EVENTS} SELECT event_id, {r('pow(value, 0.5)')} AS value, {r('pow(day, 0.5)')} AS day FROM evt"
_GRID = ", ".join(repr(i / 2) for i in range(-4, 5))
_LLF = f"""{ACCOUNTS}, cells AS (UNPIVOT (SELECT c_custkey, c_acctbal, nation FROM acct) ON c_acctbal, nation INTO NAME feature VALUE x),
psi AS (SELECT feature, lam, x, {yeo_johnson('x', 'lam')} AS y FROM cells, (SELECT unnest([{_GRID}]::DOUBLE[]) AS lam)),
llf AS (SELECT feature, lam, -0.5 * ln(var_pop(y)) + (lam - 1) * avg(sign(x) * ln(1 + abs(x))) AS llf FROM psi GROUP BY 1, 2)"""
Q["yeo_johnson_grid"] = f"WITH {_LLF} SELECT feature, lam, {r('llf')} AS llf FROM llf"
Q["yeo_johnson"] = f"""WITH {_LLF}, best AS (SELECT feature, arg_max(lam, llf) AS lam FROM llf GROUP BY 1),
la AS (SELECT lam AS la FROM best WHERE feature = 'c_acctbal'), lb AS (SELECT lam AS lb FROM best WHERE feature = 'nation')
SELECT c_custkey, {r(yeo_johnson('c_acctbal', 'la'))} AS c_acctbal, {r(yeo_johnson('nation', 'lb'))} AS nation FROM acct, la, lb"""
Q["bin_equal_freq"] = f"""WITH {LINE_SPLIT}, e AS (SELECT {', '.join(f'{inner_edges(c, 4)} AS e_{c}' for c in FEATURES)} FROM train)
SELECT {KEY}, {', '.join(f"CASE WHEN {c} IS NOT NULL THEN {code(c, f'e_{c}')} END AS {c}" for c in FEATURES)} FROM split_rows, e"""
Q["bin_equal_width"] = f"""WITH {EVENTS}, e AS (SELECT {', '.join(
    f"list_transform([1, 2, 3, 4], lambda i: min({c}) + (max({c}) - min({c})) * i / 5) AS e{i}" for i, c in enumerate(_evt))} FROM evt)
SELECT event_id, {', '.join(f"{code(c, f'e{i}')} AS {c}" for i, c in enumerate(_evt))} FROM evt, e"""


def _scaled(centre: str, width: str) -> str:
    cells = ", ".join(
        f"{r(f'({c} - (SELECT {centre.format(c=c)} FROM train)) / (SELECT coalesce(nullif({width.format(c=c)}, 0), 1) FROM train)')} AS {c}"
        for c in FEATURES)
    return f"WITH {LINE_SPLIT} SELECT {KEY}, {cells} FROM split_rows"


Q["scale_standard"] = _scaled("avg({c})", "stddev_pop({c})")
Q["scale_robust"] = _scaled("quantile_cont({c}, 0.5)", "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)")
Q["scale_minmax"] = _scaled("min({c})", "max({c}) - min({c})")
Q["cap_outliers"] = f"""WITH q AS (SELECT quantile_cont(n_chars, 0.25) AS a, quantile_cont(n_chars, 0.75) AS b FROM documents)
SELECT doc_id, {r('greatest(least(n_chars, b + 1.5 * (b - a)), a - 1.5 * (b - a))')} AS n_chars FROM documents, q"""

_PRUNABLE = ("l_quantity", "quantity_again", "always_one", "single", "l_tax", "tax_twice", "tax_gaps", "tax_gaps_again")
PRUNABLE = f"""{LINE}, p AS (SELECT l_quantity, l_quantity AS quantity_again, l_quantity * 0 + 1 AS always_one,
  (l_quantity = 1)::DOUBLE AS single, l_tax, l_tax * 2 AS tax_twice,
  CASE WHEN l_linenumber > 1 THEN l_tax END AS tax_gaps, CASE WHEN l_linenumber > 1 THEN l_tax END AS tax_gaps_again FROM line),
shares AS ({' UNION ALL '.join(f'''SELECT '{c}' AS "column", coalesce(max(n) FILTER (v IS NOT NULL), 0) / sum(n)::DOUBLE AS share
  FROM (SELECT {c} AS v, count(*) AS n FROM p GROUP BY 1)''' for c in _PRUNABLE)})"""
Q["drop_constant"] = f'WITH {PRUNABLE} SELECT "column", share < 0.95 AS kept FROM shares'
Q["majority_shares"] = f'WITH {PRUNABLE} SELECT "column", {r("share")} AS share FROM shares'
Q["drop_duplicates_cols"] = f"WITH {PRUNABLE} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {' AND '.join(
        [f'(SELECT count(*) FROM p WHERE {a} IS DISTINCT FROM {c}) > 0' for a in _PRUNABLE[:i]]) or 'true'} AS kept"""
    for i, c in enumerate(_PRUNABLE))


def poly_terms(columns) -> list[tuple[str, ...]]:
    return [(c,) for c in columns] + [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]


def poly(columns) -> str:
    return ", ".join(f"{' * '.join(t)} AS poly_{i}" for i, t in enumerate(poly_terms(columns)))


def mi(source: str, columns, target: str, bins: int = 16) -> str:
    """CTE ``mi`` with the score of every column of ``source``."""
    return f"""edges AS (SELECT {', '.join(f'{inner_edges(c, bins)} AS e_{c}' for c in (*columns, target))} FROM {source}),
codes AS ({' UNION ALL '.join(f'''SELECT '{c}' AS feature, {i}::BIGINT AS position, {code(c, f'e_{c}')} AS bx,
  {code(target, f'e_{target}')} AS yb FROM {source}, edges''' for i, c in enumerate(columns))}),
cnt AS (SELECT feature, position, bx, yb, count(*)::DOUBLE AS n FROM codes GROUP BY ALL),
part AS (SELECT *, sum(n) OVER (PARTITION BY feature) AS t, sum(n) OVER (PARTITION BY feature, bx) AS px,
  sum(n) OVER (PARTITION BY feature, yb) AS py FROM cnt),
mi AS (SELECT feature, position, greatest(sum(n / t * ln(n * t / (px * py))), 0) AS score FROM part GROUP BY 1, 2)"""


Q["poly_interactions"] = f"""WITH {LINE}, t AS (SELECT {KEY}, {poly(INTER)} FROM line)
SELECT {KEY}, {rs([f'poly_{i}' for i in range(10)])} FROM t"""
Q["mi_scores"] = f"WITH {LINE}, {mi('line', INTER, 'discount_amount')} SELECT feature, position, {r('score')} AS score FROM mi"
def beta_fraction(a: str, b: str, x: str) -> str:
    """The continued fraction of the incomplete beta function, 64 steps from the last to the first."""
    return f"""(1 / list_reduce(list_transform(range(64, 0, -1), lambda k: k::DOUBLE), lambda v, m: 1 + (CASE WHEN m % 2 = 0
      THEN (m / 2) * ({b} - m / 2) ELSE -({a} + (m - 1) / 2) * ({a} + {b} + (m - 1) / 2) END) * {x} / (({a} + m - 1) * ({a} + m)) / v, 1.0::DOUBLE))"""


Q["f_scores"] = f"""WITH {LINE}, s AS (""" + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, {i}::BIGINT AS position,
    pow(corr({c}, discount_amount), 2) / (1 - pow(corr({c}, discount_amount), 2)) * (count(*) - 2) AS score, (count(*) - 2) / 2 AS a FROM line"""
    for i, c in enumerate(INTER)) + f"""),
x AS (SELECT *, 2 * a / (2 * a + score) AS x, score / (2 * a + score) AS y, exp(a * ln(x) + ln(y) / 2 + lgamma(a + 0.5) - lgamma(a) - lgamma(0.5)) AS front FROM s)
SELECT feature, position, {r('score', 2)} AS score, {r(f"CASE WHEN x < (a + 1) / (a + 2.5) THEN front / a * {beta_fraction('a', '0.5', 'x')} ELSE 1 - 2 * front * {beta_fraction('0.5', 'a', 'y')} END")} AS p_value
FROM x"""
Q["select_mi"] = f"""WITH {LINE}, {mi('line', INTER, 'discount_amount')},
w AS (SELECT feature FROM mi ORDER BY score DESC, position LIMIT 2),
u AS (UNPIVOT (SELECT {KEY}, {', '.join(INTER)} FROM line) ON {', '.join(INTER)} INTO NAME feature VALUE value)
SELECT {KEY}, feature, {r('value')} AS value FROM u SEMI JOIN w USING (feature)"""

_basic = f"""{LINE_SPLIT},
imputed AS (SELECT {KEY}, split, {', '.join(f'coalesce({c}, (SELECT avg({c}) FROM train)) AS {c}' for c in FEATURES)} FROM split_rows),
itrain AS (SELECT * FROM imputed WHERE split = 'train'),
logged AS (SELECT {KEY}, split, {', '.join(
    f"CASE WHEN {skewed(c, 'itrain')} THEN ln(nullif(greatest({c}, 0), 0)) ELSE {c} END AS {c}" for c in FEATURES)} FROM imputed),
shaped AS (SELECT {KEY}, split, {', '.join(f"{yeo_johnson(c, '0.5')} AS {c}" for c in FEATURES)} FROM logged),
e AS (SELECT {', '.join(f'{inner_edges(c, 4)} AS e_{c}' for c in FEATURES)} FROM shaped WHERE split = 'train'),
binned AS (SELECT {KEY}, split, {', '.join(f"{code(c, f'e_{c}')} AS {c}" for c in FEATURES)} FROM shaped, e),
btrain AS (SELECT * FROM binned WHERE split = 'train')"""


def _standard(c: str) -> str:
    return f"({c} - (SELECT avg({c}) FROM btrain)) / (SELECT coalesce(nullif(stddev_pop({c}), 0), 1) FROM btrain)"


Q["basic_chain"] = f"WITH {_basic} SELECT {KEY}, split, {', '.join(f'{r(_standard(c))} AS {c}' for c in FEATURES)} FROM binned"

_POLY = [f"poly_{i}" for i in range(10)]
_advanced = f"""{INTER_SPLIT},
shaped AS (SELECT {KEY}, split, discount_amount, {', '.join(f"{yeo_johnson(c, '0.5')} AS {c}" for c in INTER)} FROM split_rows),
expanded AS (SELECT {KEY}, split, discount_amount, {poly(INTER)} FROM shaped),
xtrain AS (SELECT * FROM expanded WHERE split = 'train'),
{mi('xtrain', _POLY, 'discount_amount')},
w AS (SELECT feature, position, row_number() OVER (ORDER BY position) - 1 AS place FROM
  (SELECT * FROM mi ORDER BY score DESC, position LIMIT 4))"""
Q["advanced_chain"] = f"""WITH {_advanced},
u AS (UNPIVOT (SELECT {KEY}, split, {', '.join(_POLY)} FROM expanded) ON {', '.join(_POLY)} INTO NAME feature VALUE value),
q AS (SELECT feature, quantile_cont(value, 0.5) AS mid, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr
  FROM u WHERE split = 'train' GROUP BY 1)
SELECT {KEY}, feature, {r('(value - mid) / coalesce(nullif(iqr, 0), 1)')} AS value FROM u JOIN q USING (feature) SEMI JOIN w USING (feature)"""
Q["mi_importance"] = f"WITH {_advanced} SELECT feature, position, {r('score')} AS score FROM mi"
Q["feature_names"] = f"WITH {_advanced} SELECT place AS position, feature FROM w"
_names = ",".join(INTER)
Q["chain_info"] = f"""WITH {_advanced}, kept AS (SELECT string_agg(feature, ',' ORDER BY position) AS names, count(*) AS n FROM w)
SELECT pos::BIGINT AS pos, step, type, variables, n_output::BIGINT AS n_output FROM (VALUES
(0, 'impute', 'impute_median', '{_names}', 4), (1, 'drop_constant', 'drop_constant', '{_names}', 4),
(2, 'drop_duplicates', 'drop_duplicates_cols', '{_names}', 4), (3, 'yeo_johnson', 'yeo_johnson', '{_names}', 4),
(4, 'interact', 'poly_interactions', '{_names}', 10),
(5, 'select', 'select_mi', '{",".join(_POLY)}', (SELECT n FROM kept)),
(6, 'scale', 'scale_robust', (SELECT names FROM kept), (SELECT n FROM kept))) t(pos, step, type, variables, n_output)"""
Q["impute_categorical"] = f"""WITH {ACCOUNTS}, g AS (SELECT c_custkey, CASE WHEN nation >= 5 THEN c_mktsegment END AS v FROM acct),
top AS (SELECT v AS best FROM g WHERE v IS NOT NULL GROUP BY v ORDER BY count(*) DESC, v LIMIT 1)
SELECT c_custkey, coalesce(v, 'Missing') AS constant, coalesce(v, best) AS frequent FROM g, top"""
_segments = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
Q["encode_onehot"] = "SELECT c_custkey, " + ", ".join(
    f"(c_mktsegment = '{s}')::BIGINT AS \"c_mktsegment_{s}\"" for s in _segments) + " FROM customer"
Q["encode_ordinal"] = """WITH o AS (SELECT c_mktsegment, row_number() OVER (ORDER BY avg(c_acctbal), c_mktsegment) - 1 AS code
FROM customer GROUP BY 1) SELECT c_custkey, code FROM customer JOIN o USING (c_mktsegment)"""

# --- models -------------------------------------------------------------------------------
_fit = f"""{LINE_SPLIT}, f AS (SELECT regr_slope(charge, l_extendedprice) AS slope, regr_intercept(charge, l_extendedprice) AS intercept,
  covar_pop(l_extendedprice, charge) AS c, var_pop(l_extendedprice) AS v, count(*) AS n,
  avg(l_extendedprice) AS mx, avg(charge) AS my FROM train)"""
Q["fit_linear"] = f"WITH {_fit} SELECT 'linear_regression' AS model, {r('slope')} AS slope, {r('intercept', 4)} AS intercept FROM f"
_ridge = "c * n / (v * n + 1e12)"
Q["fit_ridge"] = f"WITH {_fit} SELECT 'ridge' AS model, {r(_ridge)} AS slope, {r(f'my - mx * {_ridge}', 4)} AS intercept FROM f"
_lasso = "sign(c) * greatest(abs(c) - 1e8, 0) / v"
Q["fit_lasso"] = f"WITH {_fit} SELECT 'lasso' AS model, {r(_lasso, 5)} AS slope, {r(f'my - mx * {_lasso}', 1)} AS intercept FROM f"
_net = "sign(c) * greatest(abs(c) - 1e8 * 0.5, 0) / (v + 1e8 * 0.5)"
Q["fit_elastic_net"] = f"WITH {_fit} SELECT 'elastic_net' AS model, {r(_net, 5)} AS slope, {r(f'my - mx * {_net}', 1)} AS intercept FROM f"
Q["predict"] = f"WITH {_fit} SELECT {KEY}, split, {r('charge')} AS y, {r('slope * l_extendedprice + intercept', 4)} AS pred FROM split_rows, f"
Q["score"] = f"""WITH {_fit} SELECT 'test' AS split, {r('1 - sum(pow(charge - (slope * l_extendedprice + intercept), 2)) / (count(*) * var_pop(charge))')} AS r2
FROM split_rows, f WHERE split = 'test'"""
_linear_rows = f"""p AS (SELECT 'linear_regression' AS model, split, {KEY}, charge AS y, slope * l_extendedprice + intercept AS pred
FROM split_rows, f)"""
Q["evaluate_model"] = f"""WITH {_fit}, {_linear_rows}, {measure_ctes('p', 'model, split', KEY)}
SELECT model, split, metric, {r('value', 3)} AS value FROM long"""
Q["run_single"] = f"""WITH {_basic},
x AS (SELECT {KEY}, b.split, {_standard('b.l_extendedprice').replace('avg(b.', 'avg(').replace('stddev_pop(b.', 'stddev_pop(')} AS x,
  charge FROM binned b JOIN split_rows USING ({KEY})),
f AS (SELECT regr_slope(charge, x) AS slope, regr_intercept(charge, x) AS intercept FROM x WHERE split = 'train'),
p AS (SELECT 'linear_regression_basic' AS model, split, {KEY}, charge AS y, slope * x + intercept AS pred FROM x, f),
{measure_ctes('p', 'model, split', KEY)}
SELECT model, split, metric, {r('value', 4)} AS value FROM long"""
_pairs = [(s, m) for s in ("test", "val") for m in METRICS]
Q["grid_comparison"] = f"""WITH {_basic},
x AS (SELECT {KEY}, b.split, {_standard('b.l_extendedprice').replace('avg(b.', 'avg(').replace('stddev_pop(b.', 'stddev_pop(')} AS x,
  charge FROM binned b JOIN split_rows USING ({KEY})),
f AS (SELECT avg(x) AS mx, avg(charge) AS my, covar_pop(x, charge) * count(*) AS c, var_pop(x) * count(*) AS v FROM x WHERE split = 'train'),
p AS (SELECT g.model, split, {KEY}, charge AS y, my + (x - mx) * c / (v + g.alpha) AS pred
  FROM x, f, (VALUES ('plain_basic', 0), ('shrunk_basic', 20000)) g(model, alpha)),
{measure_ctes('p', 'model, split', KEY)}
SELECT model, {', '.join(f"round(max(value) FILTER (split = '{s}' AND metric = '{m}'), 3) + 0.0 AS {s}_{m}" for s, m in _pairs)}
FROM long GROUP BY model"""
_cv = f"""{LINE}, folded AS (SELECT *, len(list_filter(['33333333', '66666666', '99999999', 'cccccccc'], lambda e: {digest('fold')} >= e))::BIGINT AS fold FROM line),
fits AS (SELECT k.fold, regr_slope(charge, l_extendedprice) AS slope, regr_intercept(charge, l_extendedprice) AS intercept
  FROM folded l JOIN (SELECT unnest(range(5)) AS fold) k ON l.fold <> k.fold GROUP BY 1),
scores AS (SELECT fold, -avg(pow(charge - (slope * l_extendedprice + intercept), 2)) AS score FROM folded JOIN fits USING (fold) GROUP BY 1)"""
Q["cross_validate"] = f"WITH {_cv} SELECT fold, {r('score', 2)} AS score FROM scores"
_trials = ", ".join(f"({i}, '{kind}', {0.0 if kind == 'linear_regression' else params['alpha']!r}, {params.get('l1_ratio', 1.0)!r})"
                    for i, kind, params in drawn_trials(100, ["linear_regression", "ridge", "lasso", "elastic_net"]))
Q["optimize"] = f"""WITH {_cv}, t(trial, family, alpha, ratio) AS (VALUES {_trials}),
f AS (SELECT k.fold, count(*) AS n, avg(l_extendedprice) AS mx, avg(charge) AS my, var_pop(l_extendedprice) AS xx, covar_pop(charge, l_extendedprice) AS xy
  FROM folded l JOIN (SELECT unnest(range(5)) AS fold) k ON l.fold <> k.fold GROUP BY 1),
h AS (SELECT fold, avg(l_extendedprice) AS hx, avg(charge) AS hy, var_pop(l_extendedprice) AS hxx, covar_pop(charge, l_extendedprice) AS hxy, var_pop(charge) AS hyy
  FROM folded GROUP BY 1),
b AS (SELECT *, CASE family WHEN 'linear_regression' THEN xy / xx WHEN 'ridge' THEN n * xy / (n * xx + alpha)
    ELSE sign(xy) * greatest(abs(xy) - alpha * (CASE family WHEN 'lasso' THEN 1 ELSE ratio END), 0)
         / (xx + (CASE family WHEN 'lasso' THEN 0 ELSE alpha * (1 - ratio) END)) END AS slope FROM t, f JOIN h USING (fold))
SELECT trial::BIGINT AS trial, family, fold, {r('-(hyy - 2 * slope * hxy + slope * slope * hxx + pow(hy - my - slope * (hx - mx), 2))', 1)} AS score FROM b"""
Q["cv_interval"] = f"""WITH {_cv}, s AS (SELECT count(*) AS n, avg(score) AS mean, stddev_samp(score) AS std FROM scores)
SELECT n, {rs(('mean', 'std'), 2)}, {r('mean - 2.776 * std / sqrt(n)', 2)} AS low, {r('mean + 2.776 * std / sqrt(n)', 2)} AS high FROM s"""
Q["fit_knn"] = f"""WITH x AS (SELECT p_partkey, p_size::DOUBLE AS p_size, p_partkey::DOUBLE AS part_no, p_retailprice,
  {hash_split('p_partkey')} AS split FROM part),
d AS (SELECT q.p_partkey, q.split, t.p_retailprice AS v, row_number() OVER (PARTITION BY q.p_partkey
  ORDER BY pow(q.p_size - t.p_size, 2) + pow(q.part_no - t.part_no, 2), t.p_partkey) AS rn
  FROM x q, x t WHERE t.split = 'train')
SELECT p_partkey, split, {r('avg(v)')} AS pred FROM d WHERE rn <= 5 GROUP BY 1, 2"""
Q["ensemble_mean"] = f"""WITH {PREDICTIONS} SELECT 'ensemble' AS model, split, {KEY}, {r('max(y)')} AS y, {r('avg(pred)')} AS pred
FROM pred_rows GROUP BY split, {KEY}"""

# --- metrics and evaluation ---------------------------------------------------------------
_measured = f"{PREDICTIONS}, {measure_ctes('pred_rows', 'model, split', KEY)}"
Q["pareto_trials"] = f"""WITH {_measured}, t AS (SELECT model, rmse, max_error, mape FROM m WHERE split = 'test')
SELECT model, {rs(('rmse', 'max_error', 'mape'))} FROM t a WHERE NOT EXISTS (SELECT 1 FROM t b
  WHERE b.rmse <= a.rmse AND b.max_error <= a.max_error AND b.mape <= a.mape
  AND (b.rmse <> a.rmse OR b.max_error <> a.max_error OR b.mape <> a.mape))"""
for _key, _metric in (
    ("m_mse", "mse"), ("m_rmse", "rmse"), ("m_mae", "mae"), ("m_r2", "r2"), ("m_mape", "mape"), ("m_smape", "smape"),
    ("m_median_ae", "median_ae"), ("m_max_error", "max_error"), ("m_explained_variance", "explained_variance"),
    ("m_mase", "mean_absolute_scaled_error"),
):
    Q[_key] = f"WITH {_measured} SELECT model, split, metric, {r('value', 4)} AS value FROM long WHERE metric = '{_metric}'"
Q["all_metrics"] = f"WITH {_measured} SELECT model, split, metric, {r('value', 4)} AS value FROM long"
Q["save_results"] = f"WITH {_measured} SELECT model, split, metric, {r('value')} AS value FROM long"
Q["load_results"] = f"WITH {PREDICTIONS} SELECT model, split, {KEY}, {rs(('y', 'pred'))} FROM pred_rows"
Q["metric_counts"] = f"""WITH {LINE_NULL}, p AS (
  SELECT CASE WHEN line_no > 3 THEN 'test' ELSE 'val' END AS split, l_quantity IS NOT NULL AND l_discount < 0.09 AS good FROM line_null)
SELECT 'net_price' AS model, split, count(*) FILTER (good) AS n, count(*) FILTER (NOT good) AS n_dropped FROM p GROUP BY split"""
Q["mase_by_time"] = f"""WITH {EVENTS}, s AS (SELECT abs(value - hour / 2) AS e,
  abs(value - lag(value) OVER (ORDER BY ts, event_id)) AS step FROM evt)
SELECT 'half_day' AS model, 'all' AS split, 'mean_absolute_scaled_error' AS metric, {r('avg(e) / avg(step)')} AS value FROM s"""


def compared(digits: int) -> str:
    cells = [f"{r(f'{t}.{m}', digits)} AS {s}_{m}" for s, t in (("test", "a"), ("val", "b")) for m in METRICS]
    return f"""WITH {_measured} SELECT a.model, {', '.join(cells)}
FROM (SELECT * FROM m WHERE split = 'test') a JOIN (SELECT * FROM m WHERE split = 'val') b ON a.model = b.model"""


Q["compare_models"] = compared(4)
Q["export_comparison"] = compared(6)
Q["best_model"] = f"WITH {_measured} " + " UNION ALL ".join(
    f"""(SELECT metric, model, {r('value', 4)} AS value FROM long WHERE split = 'test' AND metric = '{m}'
  ORDER BY long.value {'DESC' if m in HIGHER_IS_BETTER else 'ASC'}, model LIMIT 1)""" for m in METRICS)
Q["predictions_of"] = f"WITH {PREDICTIONS} SELECT model, split, {KEY}, {rs(('y', 'pred'))} FROM pred_rows WHERE model = 'net_price'"
_importance = f"""{LINE}, imp AS ({' UNION ALL '.join(
    [f"SELECT 'pearson' AS model, '{c}' AS feature, abs(corr({c}, charge)) AS importance FROM line" for c in FEATURES]
    + [f"SELECT 'quantity', '{c}', abs(corr({c}, l_quantity)) FROM line" for c in FEATURES if c != 'l_quantity'])}),
pivoted AS (SELECT feature, coalesce(max(importance) FILTER (model = 'pearson'), 0) AS pearson,
  coalesce(max(importance) FILTER (model = 'quantity'), 0) AS quantity FROM imp GROUP BY 1)"""
Q["importance_pivot"] = f"""WITH {_importance} SELECT feature, {rs(('pearson', 'quantity'))},
  {r('(pearson + quantity) / 2')} AS average FROM pivoted"""
Q["top_features"] = f"""WITH {_importance} SELECT feature, {r('(pearson + quantity) / 2')} AS average FROM pivoted
ORDER BY pearson + quantity DESC, feature LIMIT 3"""
Q["format_metrics"] = f"""WITH {_measured} SELECT model, split, metric, printf('%.2f', value) AS text FROM long
WHERE metric IN ('rmse', 'r2', 'mae')"""
_segmented = f"{PREDICTIONS}, {measure_ctes('pred_rows', 'model, split, line_no', KEY)}"
Q["group_metrics"] = f"""WITH {_segmented} SELECT model, split, metric, {r('min(value)', 3)} AS lowest, {r('max(value)', 3)} AS highest,
  count(*) AS segments, {r('max(value) - min(value)', 3)} AS spread FROM long GROUP BY 1, 2, 3"""

# --- quality, privacy, bias ---------------------------------------------------------------
_MESSY = ("l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", "sparse_tax", "always_one", "tail")
MESSY = """messy AS (SELECT l_returnflag, l_linestatus, l_linenumber, l_quantity,
  CASE WHEN l_linenumber >= 6 THEN l_tax END AS sparse_tax, l_quantity * 0 + 1 AS always_one,
  CASE WHEN l_linenumber = 7 THEN floor(l_extendedprice / 1000) * 1000 ELSE 50.0 END AS tail FROM lineitem)"""


def finding(check: str, severity: str, message: str, item: str = '"column"') -> str:
    return f"""'{check}' AS "check", {item} AS item, '{severity}' AS severity, '{message}' AS message"""


_missing = " UNION ALL ".join(f"""SELECT '{c}' AS "column", avg(({c} IS NULL)::INT) AS share FROM messy""" for c in _MESSY)
_high = f"""SELECT {finding('quality', 'warning', 'more than half of the values are missing')}, {r('share')} AS value
FROM ({_missing}) WHERE share > 0.5"""
_distinct = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS d, count({c})::DOUBLE AS n FROM messy""" for c in _MESSY)
_constant = f"SELECT {finding('quality', 'warning', 'at most one distinct value')}, n AS value FROM ({_distinct}) WHERE d <= 1"
_dup = f"""SELECT {finding('quality', 'info', 'rows equal to an earlier row', "'rows'")}, sum(n - 1)::DOUBLE AS value
FROM (SELECT count(*) AS n FROM messy GROUP BY {', '.join(_MESSY)}) HAVING sum(n - 1) > 0"""
_numeric = ("l_linenumber", "l_quantity", "sparse_tax", "always_one", "tail")
_out = " UNION ALL ".join(f"""SELECT '{c}' AS "column", count(*) FILTER ({c} < a - 1.5 * (b - a) OR {c} > b + 1.5 * (b - a)) AS outliers,
  count(*) AS n FROM messy, (SELECT quantile_cont({c}, 0.25) AS a, quantile_cont({c}, 0.75) AS b FROM messy)""" for c in _numeric)
_outliers = f"""SELECT {finding('quality', 'info', 'many values beyond the quartile fences')}, {r('outliers / n')} AS value
FROM ({_out}) WHERE outliers > n * 0.1"""
Q["q_high_missing"] = f"WITH {MESSY} {_high}"
Q["q_constant"] = f"WITH {MESSY} {_constant}"
Q["q_duplicate_rows"] = f"WITH {MESSY} {_dup}"
Q["q_duplicate_rows_hashed"] = Q["q_duplicate_rows"]
Q["q_outliers"] = f"WITH {MESSY} {_outliers}"
Q["q_outlier_shares"] = f"""WITH {MESSY} SELECT "column", outliers, {r('outliers / n')} AS share FROM ({_out})"""
Q["data_quality"] = f"WITH {MESSY} {_high} UNION ALL {_constant} UNION ALL {_dup} UNION ALL {_outliers}"
_doc_columns = ("doc_id", "text", "lang", "source", "n_chars")
Q["pii_columns"] = f"""SELECT {finding('privacy', 'failed', 'the column name suggests personal data')}, n AS value FROM ({' UNION ALL '.join(
    f'''SELECT '{c}' AS "column", count({c})::DOUBLE AS n FROM documents''' for c in _doc_columns)})
WHERE {' OR '.join(f"""contains(lower("column"), '{k}')""" for k in PII_KEYWORDS)}"""


def text_hits(message: str, condition: str) -> str:
    cells = " UNION ALL ".join(f"""SELECT '{c}' AS "column", count(*) FILTER ({condition.format(c=c)})::DOUBLE AS n FROM documents"""
                               for c in ("text", "lang", "source"))
    return f"SELECT {finding('privacy', 'failed', message)}, n AS value FROM ({cells}) WHERE n > 0"


def matches(pattern: str) -> str:
    escaped = pattern.replace("{", "{{").replace("}", "}}")
    return f"regexp_matches({{c}}, '{escaped}')"


_email, _phone = "values look like email addresses", "values look like phone numbers"
Q["pii_email"] = text_hits(_email, "contains({c}, '@')")
Q["pii_email_strict"] = text_hits(_email, matches(EMAIL_STRICT))
Q["pii_phone"] = text_hits(_phone, matches(PHONE_LOOSE))
Q["pii_phone_strict"] = text_hits(_phone, matches(PHONE_STRICT))
_privacy = f"""({Q['pii_columns']}) UNION ALL ({Q['pii_email']}) UNION ALL ({Q['pii_phone']})"""


def statuses(parts: dict[str, str]) -> str:
    """CTE ``status`` over findings given per check."""
    rows = " UNION ALL ".join(f"SELECT * FROM ({sql})" for sql in parts.values())
    asked = ", ".join(f"('{c}')" for c in parts)
    return f"""findings AS ({rows}), status AS (SELECT a."check", count(f."check") AS findings,
  CASE WHEN coalesce(bool_or(f.severity = 'failed'), false) THEN 'failed' WHEN count(f."check") > 0 THEN 'warning' ELSE 'passed' END AS status
  FROM (VALUES {asked}) a("check") LEFT JOIN findings f ON f."check" = a."check" GROUP BY 1)"""


Q["privacy_check"] = f"WITH {statuses({'privacy': _privacy})} SELECT * FROM status"
Q["mask_pii"] = f"""WITH t AS (SELECT doc_id, regexp_replace(regexp_replace(text, '{EMAIL_STRICT}', '[email]', 'g'),
  '{PHONE_STRICT}', '[phone]', 'g') AS text FROM documents)
SELECT doc_id, sha256('pepper' || doc_id) AS person, length(text) AS length, md5(text) AS digest FROM t"""
_bias_imp = f"""SELECT {finding('bias', 'warning', 'one feature dominates the predictions', 'model')}, {r('max(importance)')} AS value
FROM imp GROUP BY model HAVING max(importance) > 0.8 UNION ALL
SELECT {finding('bias', 'warning', 'importance is unevenly distributed', 'model')}, {r('stddev_pop(importance)')} AS value
FROM imp GROUP BY model HAVING stddev_pop(importance) > 0.3"""
Q["bias_importance"] = f"WITH {_importance} {_bias_imp}"
_narrow = f"""{PREDICTIONS}, narrow AS (SELECT model, y, pred FROM pred_rows UNION ALL
  SELECT 'flat', y, 50000 + pred / 100 FROM pred_rows WHERE model = 'net_price')"""
_range = f"""SELECT {finding('bias', 'warning', 'predictions span a limited range', 'model')},
{r('(max(pred) - min(pred)) / (max(y) - min(y))')} AS value FROM narrow GROUP BY model
HAVING max(pred) - min(pred) < 0.1 * (max(y) - min(y))"""
Q["bias_pred_range"] = f"WITH {_narrow} {_range}"
_both = _narrow + _importance.removeprefix(LINE)
Q["bias_check"] = f"WITH {_both} {_bias_imp} UNION ALL {_range}"
_one_doc = [(c, c) for c in _doc_columns] + [("one", "1.0")]
_doc_quality = f"""SELECT {finding('quality', 'warning', 'at most one distinct value')}, n AS value FROM ({' UNION ALL '.join(
    f'''SELECT '{c}' AS "column", count(DISTINCT {e}) AS d, count({e})::DOUBLE AS n FROM documents''' for c, e in _one_doc)}) WHERE d <= 1
UNION ALL SELECT {finding('quality', 'warning', 'more than half of the values are missing')}, share AS value FROM ({' UNION ALL '.join(
    f'''SELECT '{c}' AS "column", avg(({e} IS NULL)::INT) AS share FROM documents''' for c, e in _one_doc)}) WHERE share > 0.5
UNION ALL SELECT {finding('quality', 'info', 'rows equal to an earlier row', "'rows'")}, sum(n - 1)::DOUBLE AS value
FROM (SELECT count(*) AS n FROM documents GROUP BY {', '.join(_doc_columns)}) HAVING sum(n - 1) > 0
UNION ALL SELECT {finding('quality', 'info', 'many values beyond the quartile fences')}, outliers / n AS value FROM ({' UNION ALL '.join(
    f'''SELECT '{c}' AS "column", count(*) FILTER ({c} < a - 1.5 * (b - a) OR {c} > b + 1.5 * (b - a)) AS outliers, count(*) AS n
  FROM documents, (SELECT quantile_cont({c}, 0.25) AS a, quantile_cont({c}, 0.75) AS b FROM documents)''' for c in ('doc_id', 'n_chars'))})
WHERE outliers > n * 0.1"""
_safety = f"WITH {_both}, {statuses({'privacy': _privacy, 'quality': _doc_quality, 'bias': f'{_bias_imp} UNION ALL {_range}'})}"
Q["safety_status"] = f"{_safety} SELECT * FROM status"
Q["safety_rollup"] = f"""{_safety}, worst AS (SELECT max(CASE status WHEN 'error' THEN 4 WHEN 'failed' THEN 3 WHEN 'warning' THEN 2 ELSE 1 END) AS l FROM status)
SELECT CASE l WHEN 4 THEN 'error' WHEN 3 THEN 'failed' WHEN 2 THEN 'warning' ELSE 'passed' END AS overall_status,
CASE l WHEN 4 THEN '{SUMMARY['error']}' WHEN 3 THEN '{SUMMARY['failed']}' WHEN 2 THEN '{SUMMARY['warning']}' ELSE '{SUMMARY['passed']}' END AS summary
FROM worst"""
_advice = ", ".join(f"('{c}', {i}::BIGINT, '{t}')" for c, texts in RECOMMENDATIONS.items() for i, t in enumerate(texts))
Q["recommendations"] = f"""{_safety} SELECT "check", position, recommendation FROM status
JOIN (VALUES {_advice}) a("check", position, recommendation) USING ("check") WHERE findings > 0"""
Q["safety_report"] = f"""{_safety} SELECT status."check", any_value(status.status) AS status, any_value(findings) AS findings, count(position) AS recommendations
FROM status LEFT JOIN (VALUES {_advice}) a("check", position, recommendation) ON a."check" = status."check" AND findings > 0
GROUP BY status."check\""""

# --- plot data ----------------------------------------------------------------------------
Q["residuals"] = f"WITH {PREDICTIONS} SELECT model, split, {KEY}, {rs(('y', 'pred'))}, {r('y - pred')} AS residual FROM pred_rows"
Q["hist_residuals"] = f"""WITH {PREDICTIONS}, net AS (SELECT y - pred AS residual FROM pred_rows WHERE model = 'net_price'),
{histogram('net', ['residual'], 30)}"""
Q["qq_order"] = f"""WITH {PREDICTIONS} SELECT row_number() OVER (ORDER BY y - pred, {KEY}) AS rank, {r('y - pred')} AS ordered
FROM pred_rows WHERE model = 'net_price'"""
def polynomial(coefficients, x: str) -> str:
    value = repr(coefficients[0])
    for c in coefficients[1:]:
        value = f"({value} * {x} + {c!r})"
    return value


def inverse_normal(p: str) -> str:
    a, b, c, d, tail = (INVERSE_NORMAL[k] for k in ("a", "b", "c", "d", "tail"))
    t, q = f"sqrt(-2 * ln(least({p}, 1 - {p})))", f"({p} - 0.5)"
    outer = f"{polynomial(c, t)} / {polynomial((*d, 1.0), t)}"
    return f"""CASE WHEN {p} < {tail} THEN {outer} WHEN {p} > 1 - {tail} THEN -({outer})
      ELSE {polynomial(a, f'({q} * {q})')} * {q} / {polynomial((*b, 1.0), f'({q} * {q})')} END"""


def probability_plot(where: str) -> str:
    """CTE ``q`` with rank, ordered residual and normal quantile."""
    return f"""{PREDICTIONS}, o AS (SELECT row_number() OVER (ORDER BY y - pred, {KEY}) AS rank, y - pred AS ordered, count(*) OVER () AS n
  FROM pred_rows WHERE {where}),
p AS (SELECT *, CASE WHEN rank = n THEN pow(0.5, 1.0::DOUBLE / n) WHEN rank = 1 THEN 1 - pow(0.5, 1.0::DOUBLE / n) ELSE (rank - 0.3175::DOUBLE) / (n + 0.365::DOUBLE) END AS p FROM o),
q AS (SELECT rank, n, ordered, {inverse_normal('p')} AS theoretical FROM p)"""


Q["qq_points"] = f"""WITH {probability_plot("model = 'net_price'")} SELECT rank, {rs(('theoretical', 'ordered'))} FROM q"""
Q["qq_line"] = f"""WITH {probability_plot("model = 'net_price'")} SELECT {r('regr_slope(ordered, theoretical)')} AS slope,
  {r('regr_intercept(ordered, theoretical)')} AS intercept, {r('corr(ordered, theoretical)')} AS r FROM q"""
Q["qq_quantiles"] = f"""WITH {probability_plot("model = 'net_price' AND split = 'test'")} SELECT DISTINCT rank, {rs(('theoretical', 'ordered'))}
FROM q, (SELECT unnest(range(101)) AS k) WHERE rank = 1 + k * (n - 1) // 100 OR n <= 101"""
Q["radar_scores"] = f"""WITH {_measured}, t AS (SELECT * FROM m WHERE split = 'test')
SELECT model, {r('r2')} AS test_r2, {', '.join(
    f"{r(f'1 - ({c} - min({c}) OVER ()) / nullif(max({c}) OVER () - min({c}) OVER (), 0)')} AS test_{c}" for c in ('rmse', 'mae'))} FROM t"""
Q["metric_bars"] = f"""WITH {_measured} SELECT model, split, metric, {r('value', 4)} AS value FROM long
WHERE split = 'test' AND metric IN ('rmse', 'mae', 'r2')"""
Q["summary_counts"] = f"""WITH {_both}, {measure_ctes('pred_rows', 'model, split', KEY)}
SELECT (SELECT count(DISTINCT model) FROM long) AS experiments, (SELECT count(DISTINCT model) FROM long) AS models,
(SELECT count(DISTINCT feature) FROM imp) AS features, arg_min(model, rmse) AS best_model, {r('min(rmse)', 4)} AS best_rmse
FROM m WHERE split = 'test'"""
Q["identity_line"] = f"""WITH {PREDICTIONS} SELECT {r('least(min(y), min(pred))')} AS low, {r('greatest(max(y), max(pred))')} AS high FROM pred_rows"""
Q["shape_change"] = f"""WITH {_advanced} SELECT 'before' AS stage, count(*) AS n_rows, 4::BIGINT AS n_columns FROM split_rows
UNION ALL SELECT 'after', count(*), (SELECT count(*) FROM w)::BIGINT FROM expanded"""


# --- features and trees of the models -----------------------------------------------------

def _cosines(columns, components: int, gamma: float, seed: int) -> str:
    rng = np.random.default_rng(seed)
    directions = rng.normal(0.0, np.sqrt(2 * gamma), (components, len(columns))).tolist()
    phases = rng.uniform(0.0, 2 * np.pi, components).tolist()
    angles = [" + ".join([repr(b), *(f"({c} - mu_{c}) / sd_{c} * ({w!r})" for c, w in zip(columns, ws, strict=True))])
              for ws, b in zip(directions, phases, strict=True)]
    return ", ".join(f"{r(f'cos({a}) * sqrt(2.0 / {components})')} AS cos_{i}" for i, a in enumerate(angles))


Q["kernel_features"] = f"""WITH {INTER_SPLIT},
moments AS (SELECT {', '.join(f"avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}" for c in INTER)} FROM train)
SELECT {KEY}, {_cosines(INTER, 6, 0.25, 42)} FROM split_rows, moments"""


def grown(name: str, cells: str, features, depth: int) -> str:
    """CTE ``name``: the ``cells`` (n rows, sum s) with the mean ``fit`` of their leaf in the tree of best splits."""
    parts = [f"{name}_0 AS (SELECT *, 1 AS node FROM {cells})"]
    for k in range(depth):
        long = " UNION ALL ".join(
            f"SELECT node, '{c}' AS feature, {c} AS x, sum(n) AS n, sum(s) AS s FROM {name}_{k} GROUP BY node, {c}" for c in features)
        side = " ".join(f"WHEN b.feature = '{c}' AND c.{c} > b.x THEN 1" for c in features)
        parts.append(f"""{name}_best_{k} AS (
  SELECT node, feature, x, sl * sl / nl + (ss - sl) * (ss - sl) / (nn - nl) - ss * ss / nn AS gain
  FROM (SELECT *, sum(n) OVER (PARTITION BY node, feature ORDER BY x) AS nl, sum(s) OVER (PARTITION BY node, feature ORDER BY x) AS sl,
          sum(n) OVER (PARTITION BY node, feature) AS nn, sum(s) OVER (PARTITION BY node, feature) AS ss FROM ({long}))
  WHERE nl < nn QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature) = 1),
{name}_{k + 1} AS (SELECT c.* REPLACE (2 * c.node + CASE {side} ELSE 0 END AS node)
  FROM {name}_{k} c LEFT JOIN {name}_best_{k} b ON c.node = b.node)""")
    parts.append(f"{name} AS (SELECT *, sum(s) OVER (PARTITION BY node) / sum(n) OVER (PARTITION BY node) AS fit FROM {name}_{depth})")
    return ", ".join(parts)


_BY_DISCOUNT = f"{INTER_SPLIT}, cells AS (SELECT l_discount, count(*) AS n, sum(discount_amount) AS s FROM train GROUP BY l_discount)"
Q["tree_by_discount"] = f"""WITH {_BY_DISCOUNT}, {grown('tree', 'cells', ['l_discount'], 2)}
SELECT l_discount, {r('fit', 4)} AS pred FROM tree"""
Q["forest_by_discount"] = Q["tree_by_discount"]
# A round fits twice the residuals and adds a tenth of the result; the first one counts in full.
Q["boosting_by_discount"] = f"""WITH {_BY_DISCOUNT}, {grown('one', 'cells', ['l_discount'], 1)},
after_one AS (SELECT l_discount, n, s AS y, 2 * (s - n * fit) AS s, fit AS sofar FROM one), {grown('two', 'after_one', ['l_discount'], 1)},
after_two AS (SELECT l_discount, n, 2 * (y - n * (sofar + 0.1 * fit)) AS s, sofar + 0.1 * fit AS sofar FROM two),
{grown('three', 'after_two', ['l_discount'], 1)}
SELECT l_discount, {r('sofar + 0.1 * fit', 4)} AS pred FROM three"""
Q["tree_importance"] = f"""WITH {LINE_SPLIT},
cells AS (SELECT l_discount, l_tax, count(*) AS n, sum(charge) AS s FROM train GROUP BY l_discount, l_tax),
{grown('tree', 'cells', ['l_discount', 'l_tax'], 2)},
gains AS (SELECT feature, gain FROM tree_best_0 UNION ALL SELECT feature, gain FROM tree_best_1),
f AS (SELECT unnest(['l_discount', 'l_tax']) AS feature)
SELECT 'decision_tree' AS model, f.feature, {r('coalesce(sum(gain), 0) / (SELECT sum(gain) FROM gains)')} AS importance
FROM f LEFT JOIN gains ON f.feature = gains.feature GROUP BY f.feature"""
