"""DuckDB SQL for the registered queries (the correctness oracle).

Plain SQL over the driver's tables (registered as views), written apart from
the engine: nothing is imported from it, and chapter ranges and descriptions
are SQL literals. Small helpers below only splice repeated SQL fragments.

Means of columns with declared decimals are DECIMAL sums over counts, other
means are plain ``avg``. Rounding is that of a double's shortest decimal text,
half away from zero, as Spark's ``round`` does it.
"""

from __future__ import annotations


def _in(items) -> str:
    return ", ".join(f"'{i}'" if isinstance(i, str) else str(i) for i in items)


def mean_sql(value: str, cond: str = "TRUE", scale: int | None = 2) -> str:
    v = value if cond == "TRUE" else f"CASE WHEN {cond} THEN {value} END"
    if scale is None:
        return f"avg({v})"
    return f"(CAST(sum(CAST({v} AS DECIMAL(28,{scale}))) AS DOUBLE) / NULLIF(count({v}), 0))"


def rounded(x: str, digits: int = 2) -> str:
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def truthy_sql(x: str) -> str:
    return f"({x} IS NOT NULL AND {x} <> 0)"


def merge_sql(a: str, b: str) -> str:
    return (
        f"(CASE WHEN {truthy_sql(a)} AND {truthy_sql(b)} THEN ({a} + {b}) / 2 "
        f"WHEN {truthy_sql(a)} THEN {a} ELSE {b} END)"
    )


def f_to_c_sql(v: str) -> str:
    return f"(CASE WHEN {truthy_sql(v)} THEN ({v} - 32) * 5 / 9 END)"


def code_group_sql(code: str) -> str:
    return f"""(CASE
      WHEN starts_with({code}, 'E') THEN 20
      WHEN starts_with({code}, 'V') THEN 19
      ELSE (SELECT any_value(chapter) FROM (VALUES
        (1, 139, 1), (140, 239, 2), (240, 279, 3), (280, 289, 4), (290, 319, 5), (320, 389, 6),
        (390, 459, 7), (460, 519, 8), (520, 579, 9), (580, 629, 10), (630, 679, 11), (680, 709, 12),
        (710, 739, 13), (740, 759, 14), (780, 789, 15), (790, 796, 16), (797, 799, 17), (800, 999, 18)
      ) AS chapters(first, last, chapter)
      WHERE TRY_CAST(substring({code}, 1, 3) AS INTEGER) BETWEEN first AND last) END)"""


def code_sql(partkey: str, linenumber: str) -> str:
    digits = f"lpad(CAST({partkey} % 1000 AS VARCHAR), 3, '0')"
    return (
        f"(CASE WHEN {linenumber} = 1 THEN 'V' || {digits} WHEN {linenumber} = 2 THEN 'E' || {digits} "
        f"WHEN {linenumber} = 7 THEN NULL ELSE {digits} END)"
    )


COUNT_COLS = ", ".join(f"CAST(count_if(g = {i}) AS BIGINT) AS icd9_g{i}" for i in range(1, 21))
COUNT_NAMES = ", ".join(f"icd9_g{i}" for i in range(1, 21))

# Clinical roles over the driver tables (mirror of plans.driver).
ROLE_CTES = f"""
adm AS (
  SELECT o_custkey AS subject_id, o_orderkey AS hadm_id, o_orderdate AS admittime,
         CAST(o_orderstatus = 'F' AS INTEGER) AS hospital_expire_flag
  FROM orders),
stays AS (SELECT l_orderkey AS hadm_id, l_quantity AS los FROM lineitem),
pats AS (
  SELECT c_custkey AS subject_id,
         CAST(DATE '1900-01-01' + CAST((c_custkey * 37) % 30000 AS INTEGER) AS TIMESTAMP) AS dob,
         substring(c_mktsegment, 1, 1) AS gender
  FROM customer),
dx AS (
  SELECT o.o_custkey AS subject_id, {code_sql('l.l_partkey', 'l.l_linenumber')} AS icd9_code
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
counts AS (
  SELECT subject_id, {COUNT_COLS}
  FROM (SELECT subject_id, {code_group_sql('icd9_code')} AS g FROM dx WHERE icd9_code IS NOT NULL)
  GROUP BY subject_id),
ev AS (
  SELECT user_id AS subject_id, event_type AS itemid, value AS valuenum,
         CAST(value AS VARCHAR) AS value
  FROM events),
lab AS (
  SELECT o.o_custkey AS subject_id, l.l_returnflag || l.l_linestatus AS itemid,
         CAST(l.l_quantity AS VARCHAR) AS value
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
outp AS (
  SELECT o_custkey AS subject_id, o_orderpriority AS itemid,
         CAST(o_totalprice AS VARCHAR) AS value
  FROM orders)
"""


def _component(name: str, items, value: str, scale: int | None = 2) -> str:
    return f"{mean_sql(value, f'itemid IN ({_in(items)})', scale)} AS {name}"


NUM = "TRY_CAST(value AS DOUBLE)"

MEASURE_CTES = f"""
ch AS (
  SELECT subject_id,
    {_component('temp_f', ['click'], f_to_c_sql('valuenum'), None)},
    {_component('temp_c', ['view'], 'valuenum')},
    {_component('hr', ['purchase'], 'valuenum')},
    {_component('bp', ['signup', 'purchase'], 'valuenum')},
    {_component('coma', ['error'], 'valuenum')},
    {_component('fio0', ['signup'], NUM)},
    {_component('fio1', ['click', 'error'], NUM + ' / 100', 4)}
  FROM ev WHERE itemid IN ('click', 'view', 'purchase', 'signup', 'error')
  GROUP BY subject_id),
lb AS (
  SELECT subject_id,
    {_component('nitrogen', ['AF'], NUM)},
    {_component('wbc', ['NO', 'NF'], NUM)},
    {_component('bico', ['RF'], NUM)},
    {_component('sodium', ['RO', 'AO'], NUM)},
    {_component('potassium', ['NF'], NUM)},
    {_component('bilirubin', ['AO'], NUM)},
    {_component('po2', ['RF', 'RO'], NUM)}
  FROM lab GROUP BY subject_id),
op AS (
  SELECT subject_id, {_component('urine', ['1-URGENT', '2-HIGH'], NUM)}
  FROM outp WHERE itemid IN ('1-URGENT', '2-HIGH') GROUP BY subject_id),
m0 AS (
  SELECT ch.subject_id,
    {merge_sql('temp_f', 'temp_c')} AS temp_raw,
    {rounded('hr')} AS avg_heart_rate,
    {rounded('bp')} AS avg_bp,
    {rounded('coma')} AS avg_coma_scale,
    {rounded('urine')} AS avg_urine_output,
    {rounded('nitrogen')} AS avg_nitrogen,
    {rounded('wbc')} AS avg_wbc,
    {rounded('bico')} AS avg_bico,
    {rounded('sodium')} AS avg_sodium,
    {rounded('potassium')} AS avg_potassium,
    {rounded('bilirubin')} AS avg_bilirubin,
    po2,
    {rounded(merge_sql('fio0', 'fio1'))} AS fio2
  FROM ch JOIN lb ON ch.subject_id = lb.subject_id JOIN op ON ch.subject_id = op.subject_id),
m AS (
  SELECT subject_id, {rounded('temp_raw')} AS avg_temp, avg_heart_rate, avg_bp, avg_coma_scale,
    avg_urine_output, avg_nitrogen, avg_wbc, avg_bico, avg_sodium, avg_potassium, avg_bilirubin,
    {rounded('po2 / NULLIF(fio2, 0)')} AS pf_ratio
  FROM m0),
mc AS (
  SELECT * FROM m
  WHERE avg_temp IS NOT NULL AND avg_heart_rate IS NOT NULL AND avg_bp IS NOT NULL
    AND avg_coma_scale IS NOT NULL AND avg_urine_output IS NOT NULL AND avg_nitrogen IS NOT NULL
    AND avg_wbc IS NOT NULL AND avg_bico IS NOT NULL AND avg_sodium IS NOT NULL
    AND avg_potassium IS NOT NULL AND avg_bilirubin IS NOT NULL AND pf_ratio IS NOT NULL)
"""

AGE_SQL = """CAST(CASE WHEN age > 86 THEN 87 ELSE age END AS INTEGER)"""
AGE_LATERAL = """LATERAL (SELECT year(a.admittime) - year(p.dob)
   - CAST(month(a.admittime) * 100 + day(a.admittime) < month(p.dob) * 100 + day(p.dob) AS INTEGER) AS age)"""
GENDER_SQL = "CAST(CASE WHEN p.gender = 'M' THEN 0 ELSE 1 END AS INTEGER)"

STAY_FEATURES = f"""
WITH {ROLE_CTES}, {MEASURE_CTES}
SELECT a.subject_id, a.hadm_id, m.avg_temp, m.avg_heart_rate, m.avg_bp, m.avg_coma_scale,
  m.avg_urine_output, m.avg_nitrogen, m.avg_wbc, m.avg_bico, m.avg_sodium, m.avg_potassium,
  m.avg_bilirubin, m.pf_ratio, {GENDER_SQL} AS gender, s.los, {AGE_SQL} AS age,
  CAST(a.hospital_expire_flag AS INTEGER) AS expire_flag, {COUNT_NAMES}
FROM adm a
JOIN stays s ON a.hadm_id = s.hadm_id
JOIN pats p ON a.subject_id = p.subject_id
JOIN counts c ON a.subject_id = c.subject_id
JOIN mc m ON a.subject_id = m.subject_id,
{AGE_LATERAL}
WHERE s.los IS NOT NULL AND a.admittime IS NOT NULL AND p.dob IS NOT NULL
"""

SUBJECT_FEATURES = f"WITH {ROLE_CTES}, {MEASURE_CTES} SELECT * FROM mc"

BUCKETED_FEATURES = f"WITH {ROLE_CTES}, {MEASURE_CTES} SELECT mc.*, {COUNT_NAMES} FROM mc JOIN counts ON mc.subject_id = counts.subject_id"

MULTI_MEASURE_SELECT = f"""
ch AS (
  SELECT subject_id,
    {_component('temp_f', ['click'], f_to_c_sql('valuenum'), None)},
    {_component('temp_c', ['view'], 'valuenum')},
    {_component('hr', ['purchase'], 'valuenum')},
    {_component('bp', ['signup'], 'valuenum')},
    {_component('coma', ['error'], 'valuenum')},
    {_component('fio0', ['signup'], NUM)},
    {_component('fio1', ['click', 'error'], NUM + ' / 100', 4)},
    {_component('po2', ['purchase', 'view'], 'valuenum')}
  FROM ev WHERE itemid IN ('click', 'view', 'purchase', 'signup', 'error')
  GROUP BY subject_id),
mm AS (
  SELECT subject_id,
    {rounded(merge_sql('temp_f', 'temp_c'))} AS avg_temp,
    {rounded('hr')} AS avg_heart_rate,
    {rounded('bp')} AS avg_bp,
    {rounded('coma')} AS avg_coma_scale,
    {rounded('po2' + ' / NULLIF(' + rounded(merge_sql('fio0', 'fio1')) + ', 0)')} AS pf_ratio
  FROM ch)
"""

MULTI_MEASURE = f"WITH {ROLE_CTES}, {MULTI_MEASURE_SELECT} SELECT * FROM mm"

FEATURE_MERGE = f"""
WITH {ROLE_CTES},
ch AS (
  SELECT subject_id, {_component('hr', ['purchase'], 'valuenum')},
    {_component('bp', ['signup', 'view'], 'valuenum')}
  FROM ev WHERE itemid IN ('purchase', 'signup', 'view') GROUP BY subject_id),
op AS (
  SELECT subject_id, {_component('urine', ['1-URGENT', '2-HIGH'], NUM)},
    {_component('sodium', ['3-MEDIUM'], NUM)}
  FROM outp WHERE itemid IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY subject_id),
j AS (
  SELECT ch.subject_id,
    {rounded('hr')} AS avg_heart_rate,
    {rounded('bp')} AS avg_bp,
    {rounded('urine')} AS avg_urine_output,
    {rounded('sodium')} AS avg_sodium
  FROM ch JOIN op ON ch.subject_id = op.subject_id)
SELECT * FROM j
WHERE avg_heart_rate IS NOT NULL AND avg_bp IS NOT NULL AND avg_urine_output IS NOT NULL
  AND avg_sodium IS NOT NULL
"""

GROUP_MEAN = f"SELECT user_id, {mean_sql('value')} AS avg_value FROM events GROUP BY user_id"

GROUP_MEAN_ROUNDED = f"""
SELECT o_custkey, {rounded(mean_sql('o_totalprice'))} AS avg_totalprice FROM orders GROUP BY o_custkey
"""

OUTER_MERGE = f"""
WITH l AS (
  SELECT user_id AS subject_id, avg({f_to_c_sql('value')}) AS a
  FROM events WHERE event_type = 'click' GROUP BY user_id),
r AS (SELECT o_custkey AS subject_id, avg(o_totalprice / 10000) AS b FROM orders GROUP BY o_custkey)
SELECT coalesce(l.subject_id, r.subject_id) AS subject_id, {rounded(merge_sql('a', 'b'))} AS avg_temp
FROM l FULL OUTER JOIN r ON l.subject_id = r.subject_id
"""

RATIO_JOIN = f"""
WITH num AS (
  SELECT user_id AS subject_id, {mean_sql('value')} AS a
  FROM events WHERE event_type = 'purchase' GROUP BY user_id),
den AS (
  SELECT o.o_custkey AS subject_id,
    {rounded(mean_sql("(CASE WHEN l.l_linestatus = 'F' THEN l.l_discount ELSE 0.0 END)"))} AS b
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE l.l_returnflag = 'R' GROUP BY o.o_custkey)
SELECT num.subject_id, {rounded('a / NULLIF(b, 0)')} AS value_per_disc
FROM num JOIN den ON num.subject_id = den.subject_id
"""

COMPLETE_CASES = f"""
WITH ev AS (
  SELECT user_id AS subject_id, {rounded(mean_sql('value'))} AS avg_event_value FROM events GROUP BY user_id),
od AS (
  SELECT o_custkey AS subject_id, {rounded(mean_sql('o_totalprice'))} AS avg_order_value
  FROM orders GROUP BY o_custkey)
SELECT c.c_custkey AS subject_id, c.c_acctbal, ev.avg_event_value, od.avg_order_value
FROM customer c LEFT JOIN ev ON c.c_custkey = ev.subject_id LEFT JOIN od ON c.c_custkey = od.subject_id
WHERE c.c_acctbal IS NOT NULL AND NOT isnan(c.c_acctbal) AND ev.avg_event_value IS NOT NULL
  AND od.avg_order_value IS NOT NULL
"""

COHORT_JOIN = f"""
WITH {ROLE_CTES}
SELECT a.subject_id, a.hadm_id, a.admittime, a.hospital_expire_flag, s.los, p.dob, p.gender
FROM adm a JOIN stays s ON a.hadm_id = s.hadm_id JOIN pats p ON a.subject_id = p.subject_id
"""

COHORT_FEATURES = f"""
WITH {ROLE_CTES}
SELECT a.subject_id, a.hadm_id, {GENDER_SQL} AS gender, s.los, {AGE_SQL} AS age,
  CAST(a.hospital_expire_flag AS INTEGER) AS expire_flag, {COUNT_NAMES}
FROM adm a
JOIN counts c ON a.subject_id = c.subject_id
JOIN pats p ON a.subject_id = p.subject_id
JOIN stays s ON a.hadm_id = s.hadm_id,
{AGE_LATERAL}
"""

CODE_COUNTS = f"WITH {ROLE_CTES} SELECT * FROM counts"

COLLECT_CODES = """
SELECT o_custkey, list(o_orderpriority ORDER BY o_orderpriority) AS codes,
  list(n ORDER BY o_orderpriority) AS counts
FROM (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders
      WHERE o_orderpriority IS NOT NULL GROUP BY o_custkey, o_orderpriority)
GROUP BY o_custkey
"""

CODE_GROUP = f"""
SELECT l_orderkey, l_linenumber, icd9_code, CAST({code_group_sql('icd9_code')} AS INTEGER) AS icd9_group
FROM (SELECT l_orderkey, l_linenumber, {code_sql('l_partkey', 'l_linenumber')} AS icd9_code FROM lineitem)
"""

UNIT_CONVERT = f"""
SELECT event_id, {f_to_c_sql("(CASE WHEN event_type = 'error' THEN CAST(0 AS DOUBLE) ELSE value END)")} AS value_c
FROM events
"""

AGE_YEARS = f"""
WITH {ROLE_CTES}
SELECT a.hadm_id, a.subject_id, {AGE_SQL} AS age
FROM adm a JOIN pats p ON a.subject_id = p.subject_id, {AGE_LATERAL}
"""

BINARY_CODE = """
SELECT c_custkey,
  CAST(CASE WHEN NULLIF(substring(c_mktsegment, 1, 1), 'H') = 'M' THEN 0 ELSE 1 END AS INTEGER) AS sex_code
FROM customer
"""

SAFE_NUMERIC = """
SELECT p_partkey, TRY_CAST(substring(p_brand, 7) AS DOUBLE) AS brand_number,
  TRY_CAST(p_name AS DOUBLE) AS name_number, TRY_CAST(p_brand AS DOUBLE) AS brand_whole
FROM part
"""

ONE_HOT = """
SELECT p_partkey, p_type AS category, CAST(1 AS INTEGER) AS value FROM part WHERE p_type IS NOT NULL
"""


DESCRIBE_FEATURES = f"""
WITH {ROLE_CTES}, {MULTI_MEASURE_SELECT}
SELECT lf.feature, lf.subject_id, lf.value, d.description
FROM (UNPIVOT mm ON avg_temp, avg_heart_rate, avg_bp, avg_coma_scale, pf_ratio INTO NAME feature VALUE value) lf
JOIN (VALUES
  ('avg_temp', 'Body Temperature'),
  ('avg_heart_rate', 'Heart Rate'),
  ('avg_bp', 'Blood Pressure'),
  ('avg_coma_scale', 'Glasgow Coma Scale'),
  ('pf_ratio', 'PaO2 / FiO2 ratio')
) AS d(feature, description) ON lf.feature = d.feature
WHERE lf.value IS NOT NULL
"""

PROJECT_COLUMNS = "SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus FROM orders"
DERIVED_COLUMN = "SELECT l_orderkey, l_linenumber, l_discount, l_discount / 100 AS discount_fraction FROM lineitem"
ARRAY_TO_COLUMNS = (
    "SELECT vec_id, label, "
    + ", ".join(f"embedding[{i + 1}] AS e{i}" for i in range(64))
    + " FROM embeddings"
)
DROPNA_SUBSET = """
SELECT event_id, user_id, event_type
FROM (SELECT event_id, user_id, NULLIF(event_type, 'error') AS event_type FROM events)
WHERE event_type IS NOT NULL
"""
FILTER_ISIN = "SELECT event_id, user_id, event_type, value FROM events WHERE event_type IN ('click', 'view')"
FILTER_EQ = "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'"
FILTER_OR = (
    "SELECT event_id, user_id, event_type, value FROM events "
    "WHERE event_type = 'click' OR event_type = 'signup'"
)
CSV_SCAN = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"
CSV_INGEST = """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT'
"""
SPLIT_RANDOM = "SELECT event_id, user_id, count(*) AS n_sides FROM events GROUP BY event_id, user_id"
LEAF_MEANS = f"""
SELECT CAST(l_linenumber AS INTEGER) AS l_linenumber, {rounded('avg(l_quantity)', 6)} AS prediction, count(*) AS n
FROM lineitem GROUP BY l_linenumber
"""
LOGISTIC_MEAN = f"""
SELECT {rounded("avg(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0 END)", 4)} AS mean_probability, count(*) AS n
FROM lineitem
"""
FEATURES_ROUNDTRIP = (
    "SELECT l_orderkey, l_linenumber, l_quantity AS f0, l_extendedprice AS f1, "
    "l_discount AS f2, l_tax AS f3 FROM lineitem"
)
ASSEMBLE = (
    "SELECT l_orderkey, l_linenumber AS line, l_quantity AS a0, l_discount AS a1, l_tax AS a2, "
    "CAST(l_linenumber AS DOUBLE) AS a3 FROM lineitem"
)
SPLIT_BY_KEY = """
SELECT event_id, user_id,
  (('0x' || substring(md5(CAST(user_id AS VARCHAR)), 1, 8))::BIGINT % 100) < 70 AS is_train
FROM events
"""

DOC_PRED = """
p AS (
  SELECT CAST(l.quality AS DOUBLE) AS label,
         CAST(CAST(d.n_chars > 1000 AS INTEGER) AS DOUBLE) AS prediction
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)
"""
METRIC_ACCURACY = f"""
WITH {DOC_PRED}
SELECT CAST(sum(CAST(label = prediction AS INTEGER)) AS BIGINT) / count(*) AS accuracy FROM p
"""
CONFUSION_MATRIX = f"""
WITH {DOC_PRED}
SELECT label, prediction, count(*) AS n FROM p GROUP BY label, prediction
"""
PRECISION_RECALL_F1 = f"""
WITH {DOC_PRED},
cells AS (SELECT label, prediction, count(*) AS n FROM p GROUP BY label, prediction),
c AS (
  SELECT class, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(pr) AS BIGINT) AS predicted,
         CAST(sum(ac) AS BIGINT) AS actual
  FROM (SELECT label AS class, CASE WHEN label = prediction THEN n ELSE 0 END AS tp, 0 AS pr, n AS ac FROM cells
        UNION ALL
        SELECT prediction AS class, 0 AS tp, n AS pr, 0 AS ac FROM cells)
  GROUP BY class),
pr AS (
  SELECT class, tp, predicted, actual,
    CAST(tp AS DOUBLE) / NULLIF(CAST(predicted AS DOUBLE), 0) AS precision,
    CAST(tp AS DOUBLE) / NULLIF(CAST(actual AS DOUBLE), 0) AS recall
  FROM c)
SELECT *, 2 * precision * recall / NULLIF(precision + recall, 0) AS f1 FROM pr
"""
METRIC_REGRESSION = """
WITH p AS (SELECT l_extendedprice AS label, l_quantity * 1500 AS prediction FROM lineitem),
a AS (
  SELECT count(*) AS n, avg((prediction - label) * (prediction - label)) AS mse,
         avg(abs(prediction - label)) AS mae,
         sum((prediction - label) * (prediction - label)) AS ss_res,
         var_pop(label) * count(*) AS ss_tot
  FROM p)
SELECT round(sqrt(mse) * 100) / 100 AS rmse, round(mae * 100) / 100 AS mae,
  round((1.0 - ss_res / NULLIF(ss_tot, 0)) * 1000000) / 1000000 AS r2, n
FROM a
"""
ONE_FEATURE_FIT = """
SELECT 'intercept' AS term, round(regr_intercept(l_extendedprice, l_quantity) * 10000) / 10000 AS value
FROM lineitem
UNION ALL
SELECT 'l_quantity' AS term, round(regr_slope(l_extendedprice, l_quantity) * 10000) / 10000 AS value
FROM lineitem
"""

BAYES_TABLE = """
WITH s AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS class, count(*) AS n, sum(l_quantity::DOUBLE) AS l_quantity,
         sum(l_linenumber::DOUBLE) AS l_linenumber, sum(l_discount::DOUBLE) AS l_discount, sum(l_tax::DOUBLE) AS l_tax
  FROM lineitem GROUP BY 1),
w AS (
  SELECT class, ln(n + 1.0) - ln(sum(n) OVER () + count(*) OVER () * 1.0) AS prior,
         ln(l_quantity + l_linenumber + l_discount + l_tax + 4.0) AS total, l_quantity, l_linenumber, l_discount, l_tax
  FROM s),
u AS (
  SELECT class, '(prior)' AS feature, prior AS p FROM w
  UNION ALL SELECT class, 'l_quantity', ln(l_quantity + 1.0) - total FROM w
  UNION ALL SELECT class, 'l_linenumber', ln(l_linenumber + 1.0) - total FROM w
  UNION ALL SELECT class, 'l_discount', ln(l_discount + 1.0) - total FROM w
  UNION ALL SELECT class, 'l_tax', ln(l_tax + 1.0) - total FROM w)
SELECT class, feature, round(p, 6) AS log_probability FROM u
"""
FIRST_SPLIT = """
WITH r AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, * FROM lineitem),
l AS (
  SELECT y, 'l_linenumber' AS feature, l_linenumber::DOUBLE AS v FROM r
  UNION ALL SELECT y, 'l_quantity', l_quantity::DOUBLE FROM r
  UNION ALL SELECT y, 'l_discount', l_discount::DOUBLE FROM r
  UNION ALL SELECT y, 'l_tax', l_tax::DOUBLE FROM r
  UNION ALL SELECT y, 'l_extendedprice', l_extendedprice::DOUBLE FROM r),
c AS (SELECT feature, v, count(*) AS n, sum(y) AS pos FROM l GROUP BY 1, 2),
w AS (
  SELECT feature, v, sum(n) OVER up::DOUBLE AS nl, sum(pos) OVER up::DOUBLE AS pl,
         sum(n) OVER f::DOUBLE AS nt, sum(pos) OVER f::DOUBLE AS pt
  FROM c WINDOW up AS (PARTITION BY feature ORDER BY v ROWS UNBOUNDED PRECEDING), f AS (PARTITION BY feature)),
g AS (
  SELECT *, round((1.0::DOUBLE - (pt / nt) * (pt / nt) - (1.0::DOUBLE - pt / nt) * (1.0::DOUBLE - pt / nt))
    - nl / nt * (1.0::DOUBLE - (pl / nl) * (pl / nl) - (1.0::DOUBLE - pl / nl) * (1.0::DOUBLE - pl / nl))
    - (nt - nl) / nt * (1.0::DOUBLE - ((pt - pl) / (nt - nl)) * ((pt - pl) / (nt - nl)) - (1.0::DOUBLE - (pt - pl) / (nt - nl)) * (1.0::DOUBLE - (pt - pl) / (nt - nl))), 9) AS gain
  FROM w WHERE nl < nt)
SELECT feature, v AS threshold, nl::BIGINT AS n_left, (nt - nl)::BIGINT AS n_right, gain
FROM g QUALIFY row_number() OVER (PARTITION BY feature ORDER BY gain DESC, v) = 1
"""
ONE_HOT_VOCABULARY = """
SELECT p_partkey, p_type, dense_rank() OVER (ORDER BY p_type) - 1 AS type_index,
       (SELECT count(DISTINCT p_type) FROM part) AS size, 1::INTEGER AS hot, 1::INTEGER AS ones
FROM part WHERE p_type IS NOT NULL
"""
SPLIT_EXACT = """
SELECT CAST(floor(count(*) * 0.7 + 0.5) AS BIGINT) AS n_train, count(*) - CAST(floor(count(*) * 0.7 + 0.5) AS BIGINT) AS n_test,
       count(DISTINCT event_id) AS n_events, CAST(sum(event_id) AS BIGINT) AS sum_ids, CAST(sum(user_id) AS BIGINT) AS sum_users
FROM events
"""
MERGED_STATE = f"""
SELECT user_id AS subject_id,
  {rounded(mean_sql("value", "event_type = 'purchase'"))} AS avg_heart_rate,
  {rounded(mean_sql("value", "event_type IN ('signup', 'purchase')"))} AS avg_bp,
  {rounded(mean_sql("value", "event_type = 'error'"))} AS avg_coma_scale,
  {rounded(mean_sql("value", "event_type IN ('view', 'click')"))} AS avg_temp_c
FROM events WHERE event_type IN ('purchase', 'signup', 'error', 'view', 'click') GROUP BY user_id
"""
CSV_RESCUE = """
WITH f AS (
  SELECT 'p_name' AS column, p_name AS text FROM part WHERE p_name IS NOT NULL AND p_name <> '' AND try_cast(p_name AS DOUBLE) IS NULL
  UNION ALL SELECT 'p_brand', p_brand FROM part WHERE p_brand IS NOT NULL AND p_brand <> '' AND try_cast(p_brand AS BIGINT) IS NULL)
SELECT "column", count(*) AS n, count(DISTINCT text) AS n_texts, min(text) AS first_text FROM f GROUP BY 1
"""

ORACLE: dict[str, str] = {
    "bayes_table": BAYES_TABLE,
    "first_split": FIRST_SPLIT,
    "one_hot_vocabulary": ONE_HOT_VOCABULARY,
    "split_exact": SPLIT_EXACT,
    "merged_state": MERGED_STATE,
    "bucketed_features": BUCKETED_FEATURES,
    "csv_rescue": CSV_RESCUE,
    "stay_features": STAY_FEATURES,
    "subject_features": SUBJECT_FEATURES,
    "measures_chain": SUBJECT_FEATURES,
    "multi_measure": MULTI_MEASURE,
    "feature_merge": FEATURE_MERGE,
    "group_mean": GROUP_MEAN,
    "group_mean_rounded": GROUP_MEAN_ROUNDED,
    "outer_merge": OUTER_MERGE,
    "ratio_join": RATIO_JOIN,
    "complete_cases": COMPLETE_CASES,
    "cohort_join": COHORT_JOIN,
    "cohort_features": COHORT_FEATURES,
    "code_counts": CODE_COUNTS,
    "collect_codes": COLLECT_CODES,
    "code_group": CODE_GROUP,
    "unit_convert": UNIT_CONVERT,
    "age_years": AGE_YEARS,
    "binary_code": BINARY_CODE,
    "safe_numeric": SAFE_NUMERIC,
    "one_hot": ONE_HOT,
    "describe_features": DESCRIBE_FEATURES,
    "project_columns": PROJECT_COLUMNS,
    "derived_column": DERIVED_COLUMN,
    "array_to_columns": ARRAY_TO_COLUMNS,
    "dropna_subset": DROPNA_SUBSET,
    "filter_isin": FILTER_ISIN,
    "filter_eq": FILTER_EQ,
    "filter_or": FILTER_OR,
    "csv_scan": CSV_SCAN,
    "csv_ingest": CSV_INGEST,
    "split_random": SPLIT_RANDOM,
    "tree_leaf_means": LEAF_MEANS,
    "gbt_leaf_means": LEAF_MEANS,
    "forest_leaf_means": LEAF_MEANS,
    "logistic_mean": LOGISTIC_MEAN,
    "features_roundtrip": FEATURES_ROUNDTRIP,
    "assemble": ASSEMBLE,
    "split_by_key": SPLIT_BY_KEY,
    "metric_accuracy": METRIC_ACCURACY,
    "confusion_matrix": CONFUSION_MATRIX,
    "precision_recall_f1": PRECISION_RECALL_F1,
    "metric_regression": METRIC_REGRESSION,
    "reg_linear": ONE_FEATURE_FIT,
    "reg_glm": ONE_FEATURE_FIT,
}
