"""The named queries as plain SQL, for an independent engine.

Window features are written as self-joins on the row number, so they share
nothing with the frame arithmetic of the Spark side.
"""

from __future__ import annotations

import itertools
import math

import numpy as np

from acctpulse import schema
from acctpulse.plans import fixed
from acctpulse.plans.queries import CUSTOM_WINDOWS, HALF_TIME, ORDERS_HALF, PSEUDO_CONTRIBUTIONS

# Fixed values, written out here so that a wrong one in the product shows.
DESCR_CODES = {
    "ATM": 0, "Charges": 1, "Fund Transfer": 2, "GIRO": 3, "PayNow": 4, "Payment to IBT": 5,
}
INPUT_SOURCE_CODES = {"A": 0, "M": 1, "T": 2, "Z": 3}
DESCRIPTIONS = {
    "amount_zscore_account": "How far this amount is from the account's usual amount pattern (z-score).",
    "same_amount_frequency": "How often this exact amount has appeared before for this account.",
    "cumulative_amount_10min": "Total transacted amount within the last 10 minutes.",
    "descr_encoded": "Encoded transaction description/type used by the model.",
    "debit_credit_code_encoded": "Encoded debit/credit indicator used by the model.",
    "input_source_encoded": "Encoded transaction channel (for example teller vs online).",
    "hour_of_day": "Hour when the transaction occurred (0-23).",
    "is_business_hours": "Whether the transaction was during business hours on weekdays.",
    "txn_count_1s": "Number of account transactions in the past 1 second.",
    "txn_count_10s": "Number of account transactions in the past 10 seconds.",
    "txn_count_30s": "Number of account transactions in the past 30 seconds.",
    "time_since_last_txn": "Seconds since the previous transaction for this account.",
    "time_since_last_txn_same_amount": "Seconds since the last transaction with the same amount.",
    "time_since_last_txn_same_descr": "Seconds since the last transaction with the same description.",
    "avg_time_gap_last_5txn": "Average time gap between the last 5 transaction intervals.",
    "min_time_gap_last_10txn": "Smallest time gap among the last 10 transaction intervals.",
    "same_acct_amt_descr_count_10min": "Count of transactions with same account, amount, and description in 10 minutes.",
    "same_acct_amt_count_10min": "Count of transactions with same account and amount in 10 minutes.",
    "is_exact_duplicate_10min": "Flag indicating repeated identical amount+description in 10 minutes.",
    "duplicate_streak": "Current streak length of repeated duplicate-like transactions.",
    "dc_sign": "Transaction direction represented as numeric sign (debit/credit).",
    "dc_alternation_count_10txn": "How many debit/credit flips occurred in the last 10 transactions.",
    "reversal_count_10min": "Count of potential reversal-like transactions in the last 10 minutes.",
}
# End of fixed values.

K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
DESCR = (
    "CASE event_type WHEN 'click' THEN 'ATM' WHEN 'view' THEN 'GIRO' "
    "WHEN 'purchase' THEN 'PayNow' WHEN 'signup' THEN 'Fund Transfer' ELSE event_type END"
)


def _events(ts: str, amount: str) -> str:
    return f"""SELECT event_id AS seq,
  CAST(1000000000000000000 + user_id AS VARCHAR) AS account_number,
  {ts} AS posting_timestamp, CAST({amount} AS DECIMAL(18,2)) AS amount, {DESCR} AS descr,
  CASE WHEN {K} % 2 = 0 THEN 'D' ELSE 'C' END AS dc,
  substring('TZMAX', {K} % 5 + 1, 1) AS src, event_type, value FROM events"""


DENSE = _events("make_timestamp((epoch_us(ts) // 600000000) * 1000000)", "floor(value / 25) * 25")
HOT = f"SELECT * REPLACE (CASE WHEN seq % 3 = 0 THEN 'hot' ELSE account_number END AS account_number) FROM ({DENSE})"
SPARSE = _events("ts", "round(value, 2)")
SCORED = f"""SELECT *, 0.25 - value / 400 AS anomaly_score,
  CASE WHEN 0.25 - value / 400 < 0 THEN -1 ELSE 1 END AS anomaly_label,
  0.25 - value / 400 < 0 AS is_anomaly FROM ({DENSE})"""
NATION = """SELECT o_orderkey AS seq, CAST(c_nationkey AS VARCHAR) AS account_number,
  make_timestamp(datediff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) * 20000000)
    AS posting_timestamp,
  CAST(floor(o_totalprice / 50000) * 50000 AS DECIMAL(18,2)) AS amount,
  o_orderpriority AS descr,
  CASE o_orderstatus WHEN 'O' THEN 'D' WHEN 'F' THEN 'C' ELSE 'U' END AS dc,
  substring('TZMAX', CAST(o_orderkey % 5 + 1 AS INTEGER), 1) AS src
  FROM orders JOIN customer ON o_custkey = c_custkey"""
DEFECTIVE = f"""SELECT seq, account_number, posting_timestamp,
  CASE WHEN value < 2 THEN -1 ELSE amount END AS amount,
  CASE WHEN value BETWEEN 50 AND 52 THEN NULL ELSE descr END AS descr,
  CASE WHEN value > 100 THEN 'X' ELSE dc END AS dc, src FROM ({DENSE})"""


UNTIMELY = f"""SELECT seq, account_number,
  CASE WHEN value NOT BETWEEN 20 AND 22 OR value IS NULL THEN posting_timestamp END AS posting_timestamp,
  CASE WHEN value NOT BETWEEN 30 AND 31 OR value IS NULL THEN amount END AS amount,
  descr, dc, src FROM (SELECT d.*, e.value FROM ({DEFECTIVE}) d JOIN events e ON e.event_id = d.seq)"""
OUTCOME = f"""SELECT seq, CASE WHEN posting_timestamp IS NULL THEN 'missing posting_timestamp'
  WHEN amount IS NULL THEN 'missing transaction_ac_amount' WHEN descr IS NULL THEN 'missing descr'
  WHEN amount < 0 THEN 'negative amount' WHEN dc NOT IN ('D', 'C') THEN 'bad debit_credit_code'
  ELSE 'scored' END AS outcome, account_number FROM ({UNTIMELY})"""
SAME = "CAST(0 AS DOUBLE) AS difference, true AS same_flag"
TREES = f"""SELECT CAST(i AS INTEGER) AS tree, CAST(least(256, n) AS BIGINT) AS root_rows,
  CAST(least(256, n) AS BIGINT) AS leaf_rows, true AS depth_fits, true AS children_add_up
  FROM generate_series(0, 99) AS t(i), (SELECT count(*) AS n FROM ({DENSE}))"""


def _mean_path(n: float) -> float:
    """Mean steps of a search that fails among n rows: twice the harmonic number, less the part of the last."""
    if n <= 2:
        return float(max(0, n - 1))
    return 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def _num(x: float) -> str:
    """A literal that is a double, not a decimal."""
    return f"CAST('{x!r}' AS DOUBLE)"


def _path(tree, depth: int = 0) -> str:
    """A row's path length through a tree."""
    if isinstance(tree, int):
        return _num(depth + _mean_path(tree))
    feature, threshold, low, high = tree
    return f"(CASE WHEN {feature} > {threshold} THEN {_path(high, depth + 1)} ELSE {_path(low, depth + 1)} END)"


def _expected(tree, known: frozenset, depth: int = 0) -> str:
    """A row's mean path length where only the ``known`` features are known; parts weigh by their rows."""
    if isinstance(tree, int):
        return _num(depth + _mean_path(tree))
    feature, threshold, low, high = tree
    below, above = _expected(low, known, depth + 1), _expected(high, known, depth + 1)
    if feature in known:
        return f"(CASE WHEN {feature} > {threshold} THEN {above} ELSE {below} END)"
    share = fixed.rows_of(high) / fixed.rows_of(tree)
    return f"({_num(share)} * {above} + {_num(1 - share)} * {below})"


def _names(tree) -> set:
    return set() if isinstance(tree, int) else {tree[0]} | _names(tree[2]) | _names(tree[3])


def _shapley(feature: str) -> str:
    """The feature's Shapley value of the mean path length, over all sets of the other features of each tree."""
    terms = []
    for tree in fixed.TREES:
        others = sorted(_names(tree) - {feature})
        if feature not in _names(tree):
            continue
        n = len(others) + 1
        for size in range(n):
            weight = math.factorial(size) * math.factorial(n - 1 - size) / math.factorial(n) / len(fixed.TREES)
            for known in map(frozenset, itertools.combinations(others, size)):
                terms.append(f"{_num(weight)} * ({_expected(tree, known | {feature})} - {_expected(tree, known)})")
    return " + ".join(terms) or _num(0.0)


def _forest_scores(view: str) -> str:
    """CTEs up to ``v``: every feature row of ``view`` with its score by the fixed forest and its label."""
    mean = " + ".join(map(_path, fixed.TREES))
    return f"""{_features(view)},
s AS (SELECT *, -pow(2, -(({mean}) / {len(fixed.TREES)}) / {_mean_path(fixed.SAMPLES)!r}) AS raw FROM f),
v AS (SELECT *, raw - (SELECT quantile_cont(raw, 0.01) FROM s) AS score FROM s)"""


VERDICT = """round(score, 6) AS anomaly_score, CAST(CASE WHEN score < 0 THEN -1 ELSE 1 END AS BIGINT) AS anomaly_label,
  score < 0 AS is_anomaly"""


def _margin() -> str:
    """The fixed machine's margin: weighted cosines of random projections, drawn as its paper says."""
    draw = np.random.default_rng(fixed.SVM_SEED)
    n = len(fixed.SVM_WEIGHTS)
    w = draw.normal(scale=math.sqrt(2 * fixed.SVM_GAMMA), size=(len(fixed.SVM_SCALES), n))
    b = draw.uniform(0, 2 * math.pi, n)
    terms = []
    for k, weight in enumerate(fixed.SVM_WEIGHTS):
        inner = " + ".join(
            f"({name} - {_num(centre)}) / {_num(width)} * {_num(float(w[i, k]))}" for i, (name, centre, width) in enumerate(fixed.SVM_SCALES)
        )
        terms.append(f"{_num(weight * math.sqrt(2 / n))} * cos({inner} + {_num(float(b[k]))})")
    return " + ".join(terms)


def _codes(column: str, codes: dict[str, int]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in codes.items())
    return f"CAST(CASE {column} {whens} ELSE -1 END AS BIGINT)"


def _features(view: str, cap: int = 1000, windows: dict[str, int] | None = None) -> str:
    """CTE ``f`` with every feature of ``view``."""
    windows = windows or schema.VELOCITY_WINDOWS
    held = f"b.rn > a.rn - {cap}"
    recent = f"{held} AND b.us >= a.us - 600000000"
    velocity = ",\n  ".join(
        f"count(*) FILTER (WHERE {held} AND b.us >= a.us - {w * 1000000}) AS {n}"
        for n, w in windows.items()
    )
    gap_held = f"b.rn > a.rn - {cap - 1} AND b.rn > 1"
    return f"""WITH e AS ({view}),
r AS (SELECT seq, account_number, posting_timestamp, epoch_us(posting_timestamp) AS us,
  CAST(amount * 100 AS BIGINT) AS cents, coalesce(descr, 'nan') AS descr, src,
  CASE dc WHEN 'D' THEN 1 WHEN 'C' THEN -1 ELSE 0 END AS sgn,
  row_number() OVER (PARTITION BY account_number ORDER BY posting_timestamp, seq) AS rn FROM e),
g AS (SELECT *, us - lag(us) OVER w AS gap, CAST(sgn <> lag(sgn) OVER w AS INTEGER) AS flip
  FROM r WINDOW w AS (PARTITION BY account_number ORDER BY rn)),
j AS (SELECT a.seq,
  {velocity},
  max(b.us) FILTER (WHERE {held} AND b.rn < a.rn) AS last_us,
  max(b.us) FILTER (WHERE {held} AND b.rn < a.rn AND b.cents = a.cents) AS last_amount_us,
  max(b.us) FILTER (WHERE {held} AND b.rn < a.rn AND b.descr = a.descr) AS last_descr_us,
  CAST(sum(b.gap) FILTER (WHERE {gap_held} AND b.rn > a.rn - 5) AS DOUBLE) AS gap_sum,
  count(b.gap) FILTER (WHERE {gap_held} AND b.rn > a.rn - 5) AS gap_n,
  min(b.gap) FILTER (WHERE {gap_held} AND b.rn > a.rn - 10) AS gap_min,
  count(*) FILTER (WHERE {recent} AND b.cents = a.cents AND b.descr = a.descr) AS pairs,
  count(*) FILTER (WHERE {recent} AND b.cents = a.cents) AS same,
  max(b.rn) FILTER (WHERE b.cents <> a.cents OR b.descr <> a.descr) AS other_rn,
  coalesce(sum(b.flip) FILTER (WHERE {gap_held} AND b.rn > a.rn - 9), 0) AS flips,
  count(*) FILTER (WHERE {recent} AND b.cents = a.cents AND a.sgn <> 0 AND b.sgn = -a.sgn) AS rev,
  count(*) AS n, sum(b.cents) AS s1, sum(CAST(b.cents AS HUGEINT) * b.cents) AS s2,
  count(*) FILTER (WHERE b.cents = a.cents) AS freq,
  sum(b.cents) FILTER (WHERE {recent}) AS recent_cents
  FROM g a JOIN g b ON a.account_number = b.account_number AND b.rn <= a.rn GROUP BY a.seq),
f AS (SELECT g.seq, g.account_number, g.posting_timestamp, g.descr,
  {", ".join(windows)},
  coalesce((us - last_us) / 1000000.0::DOUBLE, 0.0::DOUBLE) AS time_since_last_txn,
  coalesce((us - last_amount_us) / 1000000.0::DOUBLE, 0.0::DOUBLE) AS time_since_last_txn_same_amount,
  coalesce((us - last_descr_us) / 1000000.0::DOUBLE, 0.0::DOUBLE) AS time_since_last_txn_same_descr,
  coalesce(gap_sum / (gap_n * 1000000.0::DOUBLE), 0.0::DOUBLE) AS avg_time_gap_last_5txn,
  coalesce(gap_min / 1000000.0::DOUBLE, 0.0::DOUBLE) AS min_time_gap_last_10txn,
  pairs AS same_acct_amt_descr_count_10min, same AS same_acct_amt_count_10min,
  CAST(pairs > 1 AS BIGINT) AS is_exact_duplicate_10min,
  CAST(rn - coalesce(other_rn, 0) AS BIGINT) AS duplicate_streak,
  CAST(sgn AS BIGINT) AS dc_sign, CAST(flips AS BIGINT) AS dc_alternation_count_10txn,
  rev AS reversal_count_10min,
  CASE WHEN n * s2 = s1 * s1 THEN 0.0::DOUBLE ELSE
    round(CAST(n * cents - s1 AS DOUBLE) / sqrt(CAST(n * s2 - s1 * s1 AS DOUBLE)), 6) END
    AS amount_zscore_account,
  freq AS same_amount_frequency,
  CAST(recent_cents AS DOUBLE) / 100 AS cumulative_amount_10min,
  {_codes("descr", DESCR_CODES)} AS descr_encoded,
  CAST(sgn = 1 AS BIGINT) AS debit_credit_code_encoded,
  {_codes("src", INPUT_SOURCE_CODES)} AS input_source_encoded,
  CAST(hour(posting_timestamp) AS BIGINT) AS hour_of_day,
  CAST(isodow(posting_timestamp) < 6 AND hour(posting_timestamp) BETWEEN 8 AND 17 AS BIGINT)
    AS is_business_hours,
  n AS txn_count, CAST(s1 AS DOUBLE) / 100 AS amount_sum, CAST(s2 AS DOUBLE) / 10000 AS amount_sq_sum,
  round(CAST(s1 AS DOUBLE) / 100 / n, 6) AS amount_mean,
  round(sqrt(CAST(n * s2 - s1 * s1 AS DOUBLE)) / n / 100, 6) AS amount_std,
  CAST(cents AS DOUBLE) / 100 AS amount, rn
  FROM g JOIN j ON g.seq = j.seq)
"""


def _neighbours(name: str, skip_self: bool) -> str:
    condition = "WHERE a.vec_id <> b.vec_id" if skip_self else ""
    return f"""{name} AS (SELECT * FROM (SELECT a.vec_id AS i, b.vec_id AS j,
  list_distance(a.v, b.v) AS d,
  row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS k
  FROM v a, v b {condition}) WHERE k <= 20)"""


LOF = f"""WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
{_neighbours("near", True)},
kd AS (SELECT i, max(d) AS kdist FROM near GROUP BY i),
dens AS (SELECT near.i, 1.0 / (avg(greatest(d, kdist)) + 1e-10) AS lrd
  FROM near JOIN kd ON kd.i = near.j GROUP BY near.i),
nof AS (SELECT near.i, -avg(o.lrd) / any_value(s.lrd) AS f
  FROM near JOIN dens o ON o.i = near.j JOIN dens s ON s.i = near.i GROUP BY near.i),
cut AS (SELECT quantile_cont(f, 0.01) AS c FROM nof),
{_neighbours("ask", False)},
mine AS (SELECT ask.i, 1.0 / (avg(greatest(d, kdist)) + 1e-10) AS lrd
  FROM ask JOIN kd ON kd.i = ask.j GROUP BY ask.i),
raw AS (SELECT ask.i, -avg(o.lrd) / any_value(m.lrd) - (SELECT c FROM cut) AS score
  FROM ask JOIN dens o ON o.i = ask.j JOIN mine m ON m.i = ask.i GROUP BY ask.i)
"""


def _half_up(value: str, digits: int) -> str:
    """Rounded half up on the decimal text of a double."""
    text = f"CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 18))"
    return f"CAST(round({text}, {digits}) AS DOUBLE)"


def _pseudo(limit: int) -> str:
    sql = {**PSEUDO_CONTRIBUTIONS, "amount": "CAST(amount AS DOUBLE)"}
    rows = " UNION ALL ".join(
        f"SELECT seq, '{name}' AS name, CAST({expr} AS DOUBLE) AS v FROM s"
        for name, expr in sql.items()
    )
    return f"""WITH s AS ({SCORED}), p AS ({rows}),
t AS (SELECT seq, name, {_half_up('v', 4)} AS contribution,
  row_number() OVER (PARTITION BY seq ORDER BY abs(v) DESC, name) - 1 AS pos FROM p)
SELECT * FROM t WHERE pos < {limit}"""


def _whole(columns: list[str]) -> str:
    return ", ".join(columns)


def statements() -> dict[str, str]:
    features = _whole(schema.FEATURE_COLUMNS)
    rate = "count(*) FILTER (WHERE is_anomaly)"
    half = f"TIMESTAMP '{HALF_TIME}'"
    typed = """SELECT seq, account_number, {ts} AS posting_timestamp,
  CAST(amount AS DOUBLE) AS transaction_ac_amount, descr, dc AS debit_credit_code,
  src AS input_source{more} FROM ({view})"""
    mixed = (
        "CASE WHEN dc = 'D' THEN date_trunc('second', posting_timestamp) "
        "ELSE posting_timestamp END"
    )
    out = {
        "flagship": f"""{_features(DENSE)} SELECT account_number, count(*) AS events,
  max(txn_count_30s) AS busiest_30s, max(cumulative_amount_10min) AS largest_10min,
  max(duplicate_streak) AS longest_streak FROM f GROUP BY account_number""",
        "read_csv": typed.format(ts=mixed, more="", view=SPARSE),
        "read_csv_narrow": typed.format(
            ts=mixed, more="", view=f"SELECT * REPLACE (row_number() OVER (ORDER BY seq) AS seq) FROM ({SPARSE})"
        ),
        "read_csv_wide": typed.format(
            ts=mixed, more=", CASE WHEN amount IS NULL THEN 'transaction_ac_amount' ELSE '' END AS bad_fields",
            view=f"SELECT * REPLACE (CASE WHEN descr <> 'error' THEN amount END AS amount) FROM ({SPARSE})"
        ),
        "save_model": TREES,
        "iforest_fit": TREES,
        **{
            name: f"{_forest_scores(DENSE)} SELECT seq, {VERDICT} FROM v"
            for name in ("load_model", "stream_score", "stream_batch_score")
        },
        "iforest_score": f"{_forest_scores(DENSE)} SELECT seq, account_number, {VERDICT}, true AS flag_is_sign FROM v",
        "ocsvm_score": f"""{_features(DENSE)}, s AS (SELECT seq, account_number, {_margin()} AS raw FROM f),
v AS (SELECT *, raw - (SELECT quantile_cont(raw, 0.01) FROM s) AS score FROM s)
SELECT seq, account_number, {VERDICT}, true AS flag_is_sign FROM v""",
        "ocsvm_fit": f"""SELECT CAST(256 AS BIGINT) AS components, count(*) AS n_rows,
  CAST(floor(0.01 * (count(*) - 1)) + 1 AS BIGINT) AS n_outside, true AS near_the_best FROM ({DENSE})""",
        "shap_topk": f"""{_forest_scores(DENSE)}, c AS (
  SELECT seq, unnest([{", ".join(f"{{'name': '{n}', 'value': CAST({_shapley(n)} AS DOUBLE)}}" for n in schema.FEATURE_COLUMNS)}]) AS e
  FROM v WHERE score < 0),
k AS (SELECT seq, row_number() OVER (PARTITION BY seq ORDER BY abs(e.value) DESC, e.name) AS place,
  e.name AS name, round(e.value, 4) AS value FROM c)
SELECT *, CAST(0 AS DOUBLE) AS unexplained, true AS all_features, (SELECT count(*) FROM f) AS n_rows,
  true AS flagged_are_explained, CAST(0 AS DOUBLE) AS largest_gap FROM k WHERE place <= 5""",
        "model_select": f"""SELECT kind, explains, count(*) AS n_rows,
  CAST(floor(0.01 * (count(*) - 1)) + 1 AS BIGINT) AS n_flagged
  FROM ({DENSE}), (VALUES ('IsolationForest', true), ('OneClassSVM', false)) AS k(kind, explains) GROUP BY ALL""",
        "state_reset": f"""{_features(DENSE)} SELECT seq, false AS is_late, same_amount_frequency, duplicate_streak,
  time_since_last_txn FROM f""",
        "require_columns": f"SELECT seq, 'descr,input_source' AS missed FROM ({DENSE})",
        "train_job": f"""SELECT count(*) FILTER (WHERE outcome = 'scored') AS n_rows,
  count(*) FILTER (WHERE outcome <> 'scored') AS rejected,
  count(DISTINCT account_number) FILTER (WHERE outcome = 'scored') AS accounts,
  CAST(floor(0.01 * (count(*) FILTER (WHERE outcome = 'scored') - 1)) + 1 AS BIGINT) AS anomalies,
  CAST(floor(0.01 * (count(*) FILTER (WHERE outcome = 'scored') - 1)) + 1 AS BIGINT) AS scored_anomalies,
  CAST(0 AS DOUBLE) AS stats_gap FROM ({OUTCOME})""",
        "batch_score_job": f"{_features(DENSE)} SELECT seq, "
        + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in schema.FEATURE_COLUMNS)
        + ", true AS goes_together FROM f",
        "batch_score_job_rejects": f"SELECT seq, outcome FROM ({OUTCOME})",
        "stream_score_rejects": f"SELECT seq, outcome FROM ({OUTCOME})",
        "late_rescored": f"""{_forest_scores(DENSE)}, m AS (SELECT account_number, max(posting_timestamp) AS newest
  FROM e WHERE descr <> 'PayNow' GROUP BY 1)
SELECT seq, {VERDICT} FROM v JOIN m ON m.account_number = v.account_number
  WHERE descr = 'PayNow' AND posting_timestamp < newest""",
        "read_parquet": typed.format(ts="posting_timestamp", more="", view=SPARSE),
        "select_cast_key": "SELECT CAST(user_id AS VARCHAR) AS account_number, event_id, value FROM events",
        "write_scored_csv": f"""SELECT '="' || account_number || '"' AS account_number, seq,
  anomaly_score, is_anomaly FROM ({SCORED})""",
        "text_guard": f"""SELECT seq, '="' || account_number || '"' AS guarded FROM ({DENSE})""",
        "write_training_snapshot": typed.format(
            ts="posting_timestamp", more=", CAST(0 AS BIGINT) AS is_anomaly", view=DENSE
        ),
        "stream_source": typed.format(ts="posting_timestamp", more="", view=DENSE),
        "alert_sink": f"SELECT seq, account_number, anomaly_score, is_anomaly FROM ({SCORED}) WHERE is_anomaly",
        "validate_split": f"""SELECT seq, CASE WHEN descr IS NULL THEN 'missing descr'
  WHEN amount < 0 THEN 'negative amount' WHEN dc NOT IN ('D', 'C') THEN 'bad debit_credit_code'
  ELSE 'valid' END AS reject_reason FROM ({DEFECTIVE})""",
        "bad_timestamp_sample": f"""SELECT seq, 'not a time ' || seq AS posting_timestamp
  FROM ({SPARSE}) WHERE descr = 'error' ORDER BY seq LIMIT 5""",
        "passthrough_cols": f"""{_features(DENSE)} SELECT f.seq, e.event_type AS posting_mode,
  e.src AS input_source, txn_count_30s FROM f JOIN e ON e.seq = f.seq""",
        "ordered_vector": f"{_features(DENSE)} "
        + " UNION ALL ".join(
            f"SELECT seq, CAST({i} AS BIGINT) AS pos, CAST({c} AS DOUBLE) AS feature_value FROM f"
            for i, c in enumerate(schema.FEATURE_COLUMNS)
        ),
        "fill_missing": f"""SELECT seq, CASE WHEN value < 10 THEN 0.0 WHEN value < 15 THEN -1.0
  ELSE value END AS x, CASE WHEN value < 15 THEN 0.0 ELSE value END AS y FROM ({DENSE})""",
        "label_to_flag": f"SELECT seq, anomaly_label = -1 AS flag FROM ({SCORED})",
        "anomaly_filter": f"SELECT seq, account_number, anomaly_score FROM ({SCORED}) WHERE is_anomaly",
        "add_constant_label": f"SELECT seq, CAST(0 AS BIGINT) AS is_anomaly FROM ({DENSE})",
        "window_lookup": f"""WITH e AS ({DENSE}), h AS (
  SELECT a.seq AS ask_id, b.seq, row_number() OVER (PARTITION BY a.seq
    ORDER BY b.posting_timestamp DESC, b.seq DESC) AS newest_rank
  FROM e a JOIN e b ON a.account_number = b.account_number
  AND b.posting_timestamp BETWEEN a.posting_timestamp - INTERVAL 60 SECOND AND a.posting_timestamp)
SELECT * FROM h WHERE newest_rank <= 1000""",
        "state_asof_lookup": f"""{_features(DENSE)}, u AS (SELECT *,
  row_number() OVER (PARTITION BY account_number ORDER BY posting_timestamp DESC, seq DESC) AS back
  FROM f WHERE posting_timestamp <= {half})
SELECT account_number, txn_count, amount_sum,
  (SELECT round(avg(CAST(f.amount AS DOUBLE)), 6) FROM f WHERE f.account_number = u.account_number
    AND f.posting_timestamp <= {half}) AS amount_mean,
  (SELECT round(stddev_pop(CAST(f.amount AS DOUBLE)), 6) FROM f
    WHERE f.account_number = u.account_number AND f.posting_timestamp <= {half}) AS amount_std,
  posting_timestamp AS last_posting, amount AS last_amount, descr AS last_descr, duplicate_streak AS current_streak
  FROM u WHERE back = 1""",
        "state_at_times": f"""{_features(DENSE)}, asks AS (
  SELECT seq AS ask_id, account_number, 'after' AS which, posting_timestamp + INTERVAL 90 SECOND AS asked_at FROM e
  UNION ALL SELECT seq, account_number, 'before', posting_timestamp - INTERVAL 2000 SECOND FROM e)
SELECT ask_id, a.account_number, which, asked_at, count(f.seq) AS txn_count, sum(amount) AS amount_sum,
  round(avg(CAST(amount AS DOUBLE)), 6) AS amount_mean,
  round(stddev_pop(CAST(amount AS DOUBLE)), 6) AS amount_std, max(posting_timestamp) AS last_posting,
  arg_max(amount, (posting_timestamp, seq)) AS last_amount, arg_max(descr, (posting_timestamp, seq)) AS last_descr,
  arg_max(duplicate_streak, (posting_timestamp, seq)) AS current_streak
  FROM asks a LEFT JOIN f ON f.account_number = a.account_number AND f.posting_timestamp <= a.asked_at
  GROUP BY ask_id, a.account_number, which, asked_at""",
        "map_lookup": f"SELECT seq, descr, {_codes('descr', DESCR_CODES)} AS code FROM ({DENSE})",
        "score_summary": f"""SELECT count(*) AS total_transactions, {rate} AS anomalies_detected,
  {rate} / greatest(count(*), 1) AS anomaly_rate FROM ({SCORED})""",
        "distinct_accounts": f"SELECT count(DISTINCT account_number) AS accounts FROM ({DENSE})",
        "distinct_accounts_growing": """SELECT count(DISTINCT o_custkey) AS accounts, true AS same_in_one_pass,
  true AS within_error FROM orders""",
        "score_stats": f"""SELECT round(avg(anomaly_score), 9) AS score_mean,
  round(stddev_pop(anomaly_score), 9) AS score_std,
  min(anomaly_score) AS score_min, max(anomaly_score) AS score_max FROM ({SCORED})""",
        "train_anomaly_rate": f"""SELECT count(*) AS n, {rate} AS anomalies,
  100.0::DOUBLE * {rate} / greatest(count(*), 1) AS anomaly_pct FROM ({SCORED})""",
        "label_summary": f"""SELECT count(*) AS n_rows, {rate} AS anomalies,
  round({rate} / count(*) * 100, 9) AS anomaly_pct,
  count(DISTINCT account_number) AS accounts FROM ({SCORED})""",
        "account_breakdown": f"""SELECT account_number, count(*) AS total, {rate} AS anomalies,
  round(avg(anomaly_score), 9) AS avg_score, CAST(sum(amount) AS DOUBLE) AS total_amount,
  round({rate} / count(*) * 100, 1) AS anomaly_rate,
  '...' || right(account_number, 4) AS account_display
  FROM ({SCORED}) GROUP BY account_number""",
        "dashboard_metrics": f"""SELECT count(*) AS total, count(*) - {rate} AS normal,
  {rate} AS anomalies, round({rate} / count(*) * 100, 1) AS anomaly_rate,
  CAST(2 AS BIGINT) AS batches, count(*) AS rows_timed, true AS latency_known FROM ({SCORED})""",
        "model_reload": f"""SELECT seq, CAST(CASE WHEN posting_timestamp < TIMESTAMP '{HALF_TIME}' THEN 1 ELSE 2 END AS BIGINT)
  AS model_version, {SAME} FROM ({DENSE})""",
        "phase_counts": """SELECT count(*) FILTER (WHERE event_type = 'click') AS n_click,
  count(*) FILTER (WHERE event_type = 'view') AS n_view,
  count(*) FILTER (WHERE event_type = 'purchase') AS n_purchase FROM events""",
        "score_histogram": f"""WITH s AS ({SCORED}), b AS (SELECT min(anomaly_score) AS lo,
  max(anomaly_score) AS hi FROM s)
SELECT is_anomaly, CAST(least(floor((anomaly_score - lo) / (hi - lo) * 30) + 1, 30) AS BIGINT) AS bin,
  count(*) AS n FROM s, b GROUP BY ALL""",
        "contamination_threshold": f"""WITH s AS ({SCORED}), q AS (
  SELECT quantile_cont(anomaly_score, 0.01) AS t FROM s)
SELECT round(any_value(t), 9) AS threshold, count(*) FILTER (WHERE anomaly_score < t) AS n_below FROM s, q""",
        "state_stats": f"""SELECT count(*) AS accounts_tracked,
  CAST(sum(least(n, 60)) AS BIGINT) AS total_records
  FROM (SELECT account_number, count(*) AS n FROM ({DENSE}) GROUP BY 1)""",
        "hour_of_day": f"SELECT seq, CAST(hour(posting_timestamp) AS BIGINT) AS hour_of_day FROM ({SPARSE})",
        "is_business_hours": f"""SELECT seq, CAST(isodow(posting_timestamp) < 6 AND hour(posting_timestamp) BETWEEN 8 AND 17 AS BIGINT)
    AS is_business_hours FROM ({SPARSE})""",
        "velocity_custom": f"{_features(DENSE, windows=CUSTOM_WINDOWS)} SELECT seq, {_whole(list(CUSTOM_WINDOWS))} FROM f",
        "last_n_rows": f"""SELECT account_number, seq, newest_rank FROM (SELECT *,
  row_number() OVER (PARTITION BY account_number ORDER BY posting_timestamp DESC, seq DESC)
  AS newest_rank FROM ({DENSE})) WHERE newest_rank <= 7""",
        "capped_history": f"""SELECT account_number, seq FROM (SELECT *,
  row_number() OVER (PARTITION BY account_number ORDER BY posting_timestamp DESC, seq DESC) AS back
  FROM ({DENSE})) WHERE back <= 40""",
        "retention_filter": f"""SELECT seq, account_number FROM ({DENSE})
  WHERE posting_timestamp >= {half} - INTERVAL 600 SECOND""",
        "retention_counts": f"""WITH e AS (SELECT account_number,
  posting_timestamp < {half} - INTERVAL 600 SECOND AS stale FROM ({DENSE})),
p AS (SELECT account_number, count(*) FILTER (WHERE stale) AS pruned,
  count(*) FILTER (WHERE NOT stale) AS kept FROM e GROUP BY 1)
SELECT CAST(sum(pruned) AS BIGINT) AS rows_pruned, CAST(sum(kept) AS BIGINT) AS rows_kept,
  count(*) FILTER (WHERE kept = 0) AS accounts_dropped FROM p""",
        "running_account_stats": f"""{_features(DENSE)} SELECT seq, account_number, txn_count,
  amount_sum, amount_sq_sum, amount_mean, amount_std FROM f""",
        "arrival_index": f"SELECT seq, account_number, row_number() OVER (ORDER BY seq) AS arrival FROM ({DENSE})",
        "feature_table": f"{_features(DENSE)} SELECT seq, account_number, posting_timestamp, {features} FROM f",
        "feature_table_capped": f"{_features(NATION, 5)} SELECT seq, {features} FROM f",
        "feature_table_split": f"{_features(NATION, 5)} SELECT seq, {features} FROM f",
        "feature_table_continued": f"""{_features(NATION, 5)} SELECT seq, {features} FROM f
  WHERE posting_timestamp >= TIMESTAMP '{ORDERS_HALF}'""",
        "sort_account_time": f"SELECT account_number, posting_timestamp, seq FROM ({DENSE}) ORDER BY ALL",
        "sort_by_score": f"SELECT seq, anomaly_score FROM ({SCORED}) ORDER BY anomaly_score, seq",
        "latest_50": f"""SELECT seq, account_number, anomaly_score, is_anomaly FROM ({SCORED})
  ORDER BY seq DESC LIMIT 50""",
        "latest_anomaly": f"""SELECT seq, account_number, anomaly_score FROM ({SCORED})
  WHERE is_anomaly ORDER BY seq DESC LIMIT 1""",
        "topn_contributions": _pseudo(5),
        "topn_names": f"""WITH top AS ({_pseudo(5)})
SELECT seq, string_agg(name, ',' ORDER BY pos) AS names FROM top GROUP BY seq""",
        "top3_chips": f"""WITH top AS ({_pseudo(3)})
SELECT seq, pos, name || ': ' || printf('%+.3f', {_half_up("contribution", 3)}) AS chip FROM top""",
        "union_by_name": f"""SELECT seq, account_number, descr, CAST(NULL AS DOUBLE)
  AS transaction_ac_amount FROM ({DENSE}) UNION ALL
SELECT seq, account_number, NULL, CAST(amount AS DOUBLE) FROM ({NATION})""",
        "parse_mixed_ts": f"SELECT seq, {mixed} AS posting_timestamp FROM ({SPARSE})",
        "epoch_seconds": "SELECT event_id AS seq, epoch_us(ts) / 1000000.0::DOUBLE AS epoch FROM events",
        "dc_sign": f"""SELECT seq, CAST(CASE dc WHEN 'D' THEN 1 WHEN 'C' THEN -1 ELSE 0 END AS BIGINT)
  AS dc_sign FROM ({NATION})""",
        "encodings": f"""SELECT seq, {_codes("descr", DESCR_CODES)} AS descr_encoded,
  CAST(dc = 'D' AS BIGINT) AS debit_credit_code_encoded,
  {_codes("src", INPUT_SOURCE_CODES)} AS input_source_encoded FROM ({DEFECTIVE})""",
        "round_outputs": f"""SELECT seq, {_half_up("anomaly_score", 6)} AS score_6,
  CAST(amount AS DOUBLE) AS amount_2, {_half_up("anomaly_score * 1.7::DOUBLE", 4)} AS contribution_4
  FROM ({SCORED})""",
        "mask_account": f"SELECT seq, '...' || right(account_number, 4) AS masked FROM ({DENSE})",
        "clock_text": f"SELECT seq, strftime(posting_timestamp, '%H:%M:%S') AS clock FROM ({DENSE})",
        "format_amount": f"SELECT seq, '$' || printf('%,.2f', CAST(amount AS DOUBLE)) AS amount_text FROM ({DENSE})",
        "format_score": f"""SELECT seq, printf('%+.4f', {_half_up("anomaly_score", 4)}) AS score_text
  FROM ({SCORED})""",
        "channel_label": f"""SELECT seq, CASE src WHEN 'T' THEN 'Teller' WHEN 'Z' THEN 'Online'
  ELSE src END AS channel FROM ({DENSE})""",
        "feature_description": _descriptions(),
        "result_json": f"""SELECT seq, '{{"seq":' || seq || ',"account_number":"' || account_number ||
  '","descr":"' || descr || '","anomaly_label":' || anomaly_label || ',"is_anomaly":' ||
  CASE WHEN is_anomaly THEN 'true' ELSE 'false' END || '}}' AS json FROM ({SCORED})""",
        "lof_fit": f"""{LOF} SELECT kd.i AS seq, round(kdist, 6) AS k_distance, round(lrd, 6) AS density
  FROM kd JOIN dens ON dens.i = kd.i""",
        "lof_score": f"""{LOF} SELECT i AS seq, round(score, 6) AS anomaly_score,
  CAST(CASE WHEN score < 0 THEN -1 ELSE 1 END AS BIGINT) AS anomaly_label FROM raw""",
        "stream_features": f"{_features(DENSE)} SELECT seq, account_number, posting_timestamp, {features} FROM f",
        "warm_start": f"{_features(DENSE)} SELECT seq, {features} FROM f WHERE posting_timestamp >= {half}",
        "late_data": f"""WITH e AS ({DENSE}), m AS (SELECT account_number, max(posting_timestamp) AS newest
  FROM e WHERE descr <> 'PayNow' GROUP BY 1)
SELECT seq, coalesce(descr = 'PayNow' AND posting_timestamp < newest, FALSE) AS is_late
  FROM e LEFT JOIN m ON m.account_number = e.account_number""",
        "state_retention": f"""WITH e AS ({DENSE}), w AS (
  SELECT max(posting_timestamp) FILTER (posting_timestamp < TIMESTAMP '{HALF_TIME}') - INTERVAL 10 MINUTE AS mark,
    max(posting_timestamp) - INTERVAL 10 MINUTE AS last_mark FROM e),
a AS (SELECT account_number, min(posting_timestamp) FILTER (posting_timestamp >= TIMESTAMP '{HALF_TIME}') AS later,
  max(posting_timestamp) AS newest FROM e GROUP BY 1),
k AS (SELECT account_number, count(*) AS n FROM e JOIN a USING (account_number) CROSS JOIN w
  WHERE newest + INTERVAL 10 MINUTE > last_mark
    AND (later IS NULL OR posting_timestamp >= least(mark, later) - INTERVAL 10 MINUTE) GROUP BY 1)
SELECT count(*) AS accounts_tracked, CAST(coalesce(sum(least(n, 1000)), 0) AS BIGINT) AS total_records FROM k""",
        "stream_hot_account": f"""{_features(HOT)} SELECT seq, {', '.join(schema.FEATURE_COLUMNS)} FROM f""",
        "late_bounded": f"""WITH e AS ({DENSE}), m AS (SELECT account_number, max(posting_timestamp) AS newest
  FROM e WHERE descr <> 'PayNow' GROUP BY 1),
w AS (SELECT max(posting_timestamp) - INTERVAL 10 MINUTE AS mark,
  max(posting_timestamp) FILTER (posting_timestamp < TIMESTAMP '{HALF_TIME}') - INTERVAL 20 MINUTE AS gone
  FROM e WHERE descr <> 'PayNow')
SELECT seq, coalesce(descr = 'PayNow'
    AND posting_timestamp < CASE WHEN newest > coalesce(gone, newest - INTERVAL 1 SECOND) THEN newest ELSE mark END,
  FALSE) AS is_late FROM e LEFT JOIN m ON m.account_number = e.account_number CROSS JOIN w""",
        "state_inspect": f"""SELECT count(*) AS accounts_tracked,
  CAST(sum(least(n, 1000)) AS BIGINT) AS total_records
  FROM (SELECT account_number, count(*) AS n FROM ({DENSE}) GROUP BY 1)""",
    }
    for name in schema.FEATURE_COLUMNS:
        if name not in ("hour_of_day", "is_business_hours", "dc_sign"):
            out[name] = f"{_features(DENSE)} SELECT seq, {name} FROM f"
    return out


def _descriptions() -> str:
    names = list(DESCRIPTIONS)
    pick = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names))
    texts = " ".join(
        "WHEN '{}' THEN '{}'".format(n, t.replace("'", "''"))
        for n, t in DESCRIPTIONS.items()
    )
    return f"""WITH n AS (SELECT seq, CASE WHEN descr = 'error' THEN 'server_error_event'
  ELSE CASE seq % {len(names)} {pick} END END AS name FROM ({DENSE}))
SELECT seq, name, CASE name {texts} ELSE 'Server Error Event' END AS description FROM n"""
