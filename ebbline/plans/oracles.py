"""DuckDB SQL that gives the same rows as the registered queries of the same name."""

from __future__ import annotations

from ebbline.columns import FEATURE_COLUMNS, NON_NEGATIVE_FEATURES, NUMERIC_FEATURES, STRING_FEATURES
from ebbline.operators.tuning import SEARCH_SPACE, sample_settings

PARSE = "strptime({0}, '%m-%d-%Y %H:%M:%S')"

RAW = """
raw_users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id,
    'user' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
    strftime(DATE '2022-01-01' + CAST(c_custkey % 600 AS INT), '%m-%d-%Y') || ' 08:00:00' AS creation_date,
    strftime(DATE '2023-10-01' + CAST((c_custkey * 7) % 120 AS INT), '%m-%d-%Y') || ' 21:30:00' AS last_activity_date,
    lower(c_mktsegment) AS firstname, upper(c_mktsegment) AS lastname,
    'addr ' || CAST(c_custkey AS VARCHAR) AS address,
    CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'WEBAPP'
         WHEN c_mktsegment = 'FURNITURE' THEN 'PHONE' ELSE 'MOBILE' END AS canal,
    CASE WHEN c_custkey % 23 = 0 THEN ' ' WHEN c_nationkey < 10 THEN 'FR' WHEN c_nationkey < 18 THEN 'USA'
         ELSE 'SPAIN' END AS country,
    CAST(c_custkey % 2 AS VARCHAR) AS gender,
    CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE CAST((c_custkey * 13) % 11 AS VARCHAR) END AS age_group,
    CASE WHEN (c_custkey * 2654435761) % 100 < (CASE WHEN c_acctbal < 3000 THEN 60 ELSE 25 END)
         THEN '1' ELSE '0' END AS churn
  FROM customer),
raw_orders AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id,
    CASE WHEN o_custkey % 10 = 0 THEN 'x' ELSE '' END || CAST(o_custkey AS VARCHAR) AS user_id,
    CAST(CAST(trunc(o_totalprice) AS INT) AS VARCHAR) AS amount, CAST(l.n AS VARCHAR) AS item_count,
    strftime(CAST(o_orderdate AS DATE) + CAST(8035 AS INT), '%m-%d-%Y') || ' 12:00:00' AS transaction_date
  FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) l
    ON l_orderkey = o_orderkey),
raw_events AS (
  SELECT CASE WHEN event_id % 101 = 0 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS event_id,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS user_id,
    CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS session_id,
    CASE event_id % 4 WHEN 0 THEN ' iOS ' WHEN 1 THEN 'ANDROID' WHEN 2 THEN 'other' ELSE NULL END AS platform,
    ' ' || upper(event_type) AS action,
    strftime(ts, '%m-%d-%Y %H:%M:%S') AS date
  FROM events)"""

SILVER = f"""{RAW},
silver_users AS (
  SELECT id AS user_id, sha1(email) AS email, {PARSE.format('creation_date')} AS creation_date,
    {PARSE.format('last_activity_date')} AS last_activity_date,
    upper(firstname[1]) || lower(firstname[2:]) AS firstname, upper(lastname[1]) || lower(lastname[2:]) AS lastname,
    address, canal, country, CAST(gender AS INT) AS gender, CAST(age_group AS INT) AS age_group,
    CAST(churn AS INT) AS churn
  FROM raw_users),
silver_orders AS (
  SELECT CAST(amount AS INT) AS amount, id AS order_id, user_id, CAST(item_count AS INT) AS item_count,
    {PARSE.format('transaction_date')} AS creation_date
  FROM raw_orders),
silver_events AS (
  SELECT event_id, user_id, session_id, coalesce(lower(trim(platform)), 'unknown') AS platform,
    coalesce(lower(trim(action)), 'unknown') AS action, {PARSE.format('date')} AS event_time
  FROM raw_events WHERE event_id IS NOT NULL AND user_id IS NOT NULL)"""

AGGREGATES = f"""{SILVER},
per_orders AS (
  SELECT user_id, count(order_id) AS order_count, CAST(sum(amount) AS BIGINT) AS total_amount,
    avg(amount) AS avg_order_amount, CAST(sum(item_count) AS BIGINT) AS total_items,
    max(creation_date) AS last_transaction
  FROM silver_orders GROUP BY user_id),
per_events AS (
  SELECT user_id, count(event_id) AS event_count, count(DISTINCT session_id) AS session_count,
    first(platform ORDER BY event_time, platform) AS platform, max(event_time) AS last_event
  FROM silver_events GROUP BY user_id)"""

GOLD = f"""{AGGREGATES},
gold AS (
  SELECT user_id, age_group, gender, canal, country, coalesce(order_count, 0) AS order_count,
    coalesce(total_amount, 0) AS total_amount, coalesce(avg_order_amount, 0.0) AS avg_order_amount,
    coalesce(total_items, 0) AS total_items, coalesce(event_count, 0) AS event_count,
    coalesce(session_count, 0) AS session_count, coalesce(platform, 'unknown') AS platform,
    CAST(datediff('day', CAST(creation_date AS DATE), DATE '2024-02-01') AS INT) AS days_since_creation,
    CAST(datediff('day', CAST(last_activity_date AS DATE), DATE '2024-02-01') AS INT) AS days_since_last_activity,
    CAST(datediff('day', CAST(last_transaction AS DATE), DATE '2024-02-01') AS INT) AS days_since_last_transaction,
    CAST(datediff('day', CAST(last_event AS DATE), DATE '2024-02-01') AS INT) AS days_since_last_event,
    churn
  FROM silver_users LEFT JOIN per_orders USING (user_id) LEFT JOIN per_events USING (user_id))"""

ROUNDED_FEATURES = ", ".join(
    f"round({name}, 4) AS {name}" if name == "avg_order_amount" else name for name in FEATURE_COLUMNS
)


def _query(base: str, body: str, *more: str) -> str:
    return f"WITH {','.join([base, *more])}\n{body}"


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# Silver and gold

DIRTY_ORDERS = """
dirty AS (
  SELECT CASE WHEN CAST(id AS BIGINT) % 13 = 0 THEN 'n/a' ELSE amount END AS amount, id, user_id, item_count,
    CASE WHEN CAST(id AS BIGINT) % 11 = 0 THEN '2024-01-01' ELSE transaction_date END AS transaction_date
  FROM raw_orders),
permissive AS (
  SELECT TRY_CAST(amount AS INT) AS amount, id AS order_id, user_id, TRY_CAST(item_count AS INT) AS item_count,
    try_strptime(transaction_date, '%m-%d-%Y %H:%M:%S') AS creation_date,
    amount AS raw_amount, item_count AS raw_items, transaction_date AS raw_date
  FROM dirty)"""

PARSE_LOSSES = _union(
    [
        f"SELECT '{column}' AS \"column\", count(*) FILTER (WHERE {raw} IS NOT NULL AND {column} IS NULL)"
        " AS lost_values FROM permissive"
        for column, raw in (("creation_date", "raw_date"), ("amount", "raw_amount"), ("item_count", "raw_items"))
    ]
)

PER_EVENTS_KNOWN = """
SELECT user_id, count(event_id) AS event_count, count(DISTINCT session_id) AS session_count,
  first(platform ORDER BY event_time, platform) FILTER (WHERE platform <> 'unknown') AS platform,
  max(event_time) AS last_event
FROM silver_events GROUP BY user_id"""

# Exploration and quality

RAW_COLUMNS = {
    "users": ["id", "email", "creation_date", "last_activity_date", "firstname", "lastname", "address", "canal",
              "country", "gender", "age_group", "churn"],
    "orders": ["id", "user_id", "amount", "item_count", "transaction_date"],
    "events": ["event_id", "user_id", "session_id", "platform", "action", "date"],
}


def _row_texts(dataset: str) -> str:
    fields = ", ".join(f"coalesce({name}, '<null>')" for name in RAW_COLUMNS[dataset])
    key = RAW_COLUMNS[dataset][0]
    return (
        f"SELECT '{dataset}' AS dataset, {key} AS row_id, concat_ws('|', {fields}) AS fields FROM raw_{dataset}"
    )


def _missing(dataset: str, column: str) -> str:
    absent = f"({column} IS NULL OR lower(trim({column})) IN ('', 'null', 'none', 'nan', 'na', 'n/a'))"
    return (
        f"SELECT '{dataset}' AS dataset, '{column}' AS \"column\", count(*) FILTER (WHERE {absent}) AS missing_count,"
        f" round(count(*) FILTER (WHERE {absent}) / count(*), 4) AS missing_share FROM raw_{dataset}"
    )


def _distinct(dataset: str, columns: list[str]) -> str:
    return _union(
        [f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_values FROM raw_{dataset}" for c in columns]
    )


QUALITY = _union(
    [
        "SELECT 'table_not_empty' AS rule, CAST(count(*) = 0 AS BIGINT) AS violations FROM gold",
        "SELECT 'id_not_null', count(*) FILTER (WHERE user_id IS NULL) FROM gold",
        "SELECT 'id_unique', count(user_id) - count(DISTINCT user_id) FROM gold",
        "SELECT 'label_present', CAST(count(churn) = 0 AS BIGINT) FROM gold",
        "SELECT 'label_binary', count(*) FILTER (WHERE churn NOT IN (0, 1)) FROM gold",
        "SELECT 'label_not_null', count(*) FILTER (WHERE churn IS NULL) FROM gold",
        "SELECT 'no_direct_identifier', CAST(0 AS BIGINT)",
    ]
)

SCORING_ROWS = f"""
scoring_rows AS (
  SELECT * REPLACE (CASE WHEN CAST(user_id AS BIGINT) % 10 = 3 THEN -order_count - 1 ELSE order_count END
    AS order_count) FROM gold),
checked AS (
  SELECT *, concat_ws(',', {', '.join(f"CASE WHEN {n} < 0 THEN '{n} < 0' END" for n in NON_NEGATIVE_FEATURES)})
    AS reasons FROM scoring_rows)"""

ALIGNED = "SELECT user_id, " + ", ".join(
    f"nullif(trim({name}), '') AS {name}"
    if name in STRING_FEATURES
    else f"round(CAST({name} AS DOUBLE), 4) AS {name}"
    for name in FEATURE_COLUMNS
) + " FROM gold"


# Drift


def _psi(features: list[str], reference: str, current: str) -> str:
    """Population stability per feature: quantile edges of the reference, shares of both sides per bin."""
    long = _union(
        [
            f"SELECT '{name}' AS feature, '{side}' AS side, CAST({name} AS DOUBLE) AS x FROM {table}"
            f" WHERE {name} IS NOT NULL"
            for name in features
            for side, table in (("reference", reference), ("current", current))
        ]
    )
    by_count = " ".join(
        f"WHEN {q} THEN quantile_cont(x, [{', '.join(repr(step / q) for step in range(q + 1))}])"
        for q in range(2, 11)
    )
    return f"""
long AS ({long}),
sizes AS (SELECT feature, least(10, count(DISTINCT x)) AS q FROM long WHERE side = 'reference' GROUP BY feature),
edges AS (
  SELECT feature, list_sort(list_distinct(CASE min(q) {by_count} END)) AS e
  FROM long JOIN sizes USING (feature) WHERE side = 'reference' AND q >= 2 GROUP BY feature),
numbered AS (
  SELECT feature, side, len(list_filter(e[2:len(e) - 1], lambda k: k < x)) AS bin
  FROM long JOIN edges USING (feature)),
bins AS (
  SELECT feature, bin, count(*) FILTER (WHERE side = 'reference') AS r,
    count(*) FILTER (WHERE side = 'current') AS c FROM numbered GROUP BY feature, bin),
totals AS (SELECT feature, sum(r) AS rt, sum(c) AS ct FROM bins GROUP BY feature),
shares AS (
  SELECT feature, greatest(r / rt, 1e-6) AS r, greatest(c / ct, 1e-6) AS c
  FROM bins JOIN totals USING (feature) WHERE rt > 0 AND ct > 0),
psi AS (SELECT feature, sum((c - r) * ln(c / r)) AS psi FROM shares GROUP BY feature),
features AS (SELECT unnest([{', '.join(f"'{name}'" for name in features)}]) AS feature),
report AS (
  SELECT feature, psi, CAST(len(e) - 1 AS INT) AS n_bins
  FROM features LEFT JOIN psi USING (feature) LEFT JOIN edges USING (feature))"""


PSI_SIDES = """
before AS (SELECT l_quantity, l_extendedprice, l_discount FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-06-01'),
after AS (
  SELECT l_quantity * CAST(1.1 AS DOUBLE) AS l_quantity, l_extendedprice * CAST(1.1 AS DOUBLE) AS l_extendedprice,
    l_discount * CAST(1.1 AS DOUBLE) AS l_discount
  FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-06-01')"""

GOLD_HALVES = """
even AS (SELECT * FROM gold WHERE CAST(user_id AS BIGINT) % 2 = 0),
odd AS (SELECT * FROM gold WHERE CAST(user_id AS BIGINT) % 2 <> 0)"""

DRIFT_STATUS = """
SELECT feature, round(psi, 6) AS psi, n_bins,
  CASE WHEN psi IS NULL THEN 'not_evaluable' WHEN psi < 0.10 THEN 'stable' WHEN psi < 0.25 THEN 'warning'
    ELSE 'drift' END AS status
FROM report"""

# Splits, metrics and preprocessing

HASH_ORDER = """
hashed AS (SELECT user_id, churn, md5('42:' || user_id) AS h FROM gold),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY churn ORDER BY h, user_id) AS place,
    ntile(3) OVER (PARTITION BY churn ORDER BY h, user_id) AS third FROM hashed)"""

SPLIT_SIZES = """
classes AS (SELECT churn, count(*) AS n FROM gold GROUP BY churn),
wanted AS (
  SELECT churn, n, sum(n) OVER () AS total,
    sum(n) OVER () - CAST(ceil(CAST(0.2 AS DOUBLE) * sum(n) OVER ()) AS BIGINT) AS train_total FROM classes),
ideal AS (SELECT *, CAST(n AS DOUBLE) / total * train_total AS share FROM wanted),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY floor(share) - share, churn) AS pos,
    train_total - sum(CAST(floor(share) AS BIGINT)) OVER () AS spare FROM ideal),
sizes AS (SELECT churn, n - CAST(floor(share) AS BIGINT) - CASE WHEN pos <= spare THEN 1 ELSE 0 END AS test_n
  FROM ranked)"""

# Folds of the train part: the first two thirds of what remains of a class in hash order, and so on.
TRAIN_FOLDS = """
trained AS (
  SELECT churn, ntile(3) OVER (PARTITION BY churn ORDER BY h, user_id) - 1 AS fold
  FROM placed JOIN sizes USING (churn) WHERE place > test_n),
fits AS (
  SELECT CAST(f AS INT) AS fold, count(*) AS fit_rows, CAST(sum(churn) AS BIGINT) AS fit_ones
  FROM trained JOIN (VALUES (0), (1), (2)) folds(f) ON fold <> f GROUP BY f)"""

_SETTINGS = ", ".join(
    "(" + ", ".join([str(number), *(f"'{value}'" for value in setting.values())]) + ")"
    for number, setting in enumerate(sample_settings())
)

BINARY_SCORES = """
scored AS (SELECT quality AS label, floor(n_chars / 200) AS score FROM labels JOIN documents USING (doc_id)),
by_score AS (SELECT score, count(*) FILTER (WHERE label = 1) AS p, count(*) AS n FROM scored GROUP BY score),
running AS (
  SELECT score, p, n, sum(p) OVER (ORDER BY score DESC) AS tp, sum(n) OVER (ORDER BY score DESC) AS k FROM by_score),
ranking AS (
  SELECT sum(p) AS positives, sum(n - p) AS negatives,
    sum((n - p) * (tp - p / 2)) / (sum(p) * sum(n - p)) AS roc_auc, sum(p * tp / k) / sum(p) AS pr_auc FROM running)"""

EVALUATION = """
cells AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE label = 1 AND score >= 5) AS tp,
    count(*) FILTER (WHERE label = 0 AND score >= 5) AS fp, count(*) FILTER (WHERE label = 1 AND score < 5) AS fn,
    count(*) FILTER (WHERE label = 0 AND score < 5) AS tn FROM scored)"""

STATISTICS = _union(
    [
        f"SELECT '{name}' AS feature, round(m, 4) AS median, round(avg(coalesce(x, m)), 4) AS mean,"
        f" round(stddev_pop(coalesce(x, m)), 4) AS std FROM (SELECT CAST({name} AS DOUBLE) AS x,"
        f" median(CAST({name} AS DOUBLE)) OVER () AS m FROM gold) GROUP BY m"
        for name in NUMERIC_FEATURES
    ]
)

MODES = _union(
    [
        f"SELECT * FROM (SELECT '{name}' AS feature, {name} AS mode FROM gold WHERE {name} IS NOT NULL"
        f" GROUP BY {name} ORDER BY count(*) DESC, {name} LIMIT 1)"
        for name in STRING_FEATURES
    ]
)

CATEGORIES = {
    "canal": ["MOBILE", "PHONE", "WEBAPP"],
    "country": [" ", "FR", "SPAIN", "USA"],
    "platform": ["android", "ios", "other", "unknown"],
}


def _dictionary() -> str:
    """The number of each text feature's category, nulls being the most frequent one."""
    numbered = ", ".join(
        f"numbers_{name} AS (SELECT {name}, row_number() OVER (ORDER BY {name}) - 1 AS number, count(*) AS entries"
        f" FROM gold WHERE {name} IS NOT NULL GROUP BY {name})"
        for name in STRING_FEATURES
    )
    values = ", ".join(
        f"{name}.number AS index_{name}, {name}.number AS one_of_{name}" for name in STRING_FEATURES
    )
    joins = " ".join(
        f"LEFT JOIN numbers_{name} {name} ON {name}.{name} = coalesce(gold.{name},"
        f" (SELECT {name} FROM numbers_{name} ORDER BY entries DESC, {name} LIMIT 1))"
        for name in STRING_FEATURES
    )
    return f"""
{numbered}
SELECT user_id, {values} FROM gold {joins}"""


def _one_hot() -> str:
    modes = ", ".join(
        f"(SELECT {name} FROM gold WHERE {name} IS NOT NULL GROUP BY {name} ORDER BY count(*) DESC, {name} LIMIT 1)"
        f" AS mode_{name}"
        for name in STRING_FEATURES
    )
    medians = ", ".join(f"median(CAST({name} AS DOUBLE)) AS median_{name}" for name in NUMERIC_FEATURES)
    filled = ", ".join(f"coalesce(CAST({n} AS DOUBLE), median_{n}) AS {n}" for n in NUMERIC_FEATURES)
    texts = ", ".join(f"coalesce({name}, mode_{name}) AS {name}" for name in STRING_FEATURES)
    scaled = ", ".join(
        f"round(({n} - avg({n}) OVER ()) / coalesce(nullif(stddev_pop({n}) OVER (), 0), 1), 4) + 0.0 AS {n}"
        for n in NUMERIC_FEATURES
    )
    one_hot = ", ".join(
        f"CASE WHEN {name} = '{value}' THEN 1.0 ELSE 0.0 END AS \"{name}={value}\""
        for name, values in CATEGORIES.items()
        for value in values
    )
    return f"""
fills AS (SELECT {medians}, {modes} FROM gold),
filled AS (SELECT user_id, {filled}, {texts} FROM gold, fills)
SELECT user_id, {scaled}, {one_hot} FROM filled"""


# Runs

RUNS = """
runs AS (
  SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'random_forest' WHEN '2-HIGH' THEN 'random_forest_tuned'
      ELSE 'dummy' END AS run_name, o_orderkey AS run_id, o_orderdate AS start_time,
    CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'RUNNING' ELSE 'FAILED' END AS status,
    ((o_orderkey * 7907) % 10000) / 10000 AS accuracy, ((o_orderkey * 7901) % 10000) / 10000 AS "precision",
    ((o_orderkey * 7883) % 10000) / 10000 AS recall, ((o_orderkey * 7879) % 10000) / 10000 AS f1,
    ((o_orderkey * 7877) % 10000) / 10000 AS roc_auc, ((o_orderkey * 7919) % 10000) / 10000 AS pr_auc,
    CASE WHEN o_orderpriority = '2-HIGH' THEN ((o_orderkey * 7873) % 10000) / 10000 END AS cv_pr_auc,
    CASE o_orderkey % 4 WHEN 0 THEN '200' WHEN 1 THEN '300' WHEN 2 THEN '500' END AS n_estimators,
    CASE o_orderkey % 3 WHEN 0 THEN '8' WHEN 1 THEN '12' END AS max_depth,
    CASE o_orderkey % 2 WHEN 0 THEN 'sqrt' END AS max_features
  FROM orders),
latest AS (
  SELECT * FROM runs WHERE status = 'FINISHED' AND run_name IN ('random_forest', 'random_forest_tuned')
  QUALIFY row_number() OVER (PARTITION BY run_name ORDER BY start_time DESC, run_id DESC) = 1),
base AS (SELECT * FROM latest WHERE run_name = 'random_forest'),
tuned AS (SELECT * FROM latest WHERE run_name = 'random_forest_tuned'),
decision AS (SELECT t.pr_auc > b.pr_auc AS tuned_wins, b.run_id AS baseline_run_id, t.run_id AS tuned_run_id,
  b.pr_auc AS baseline_pr_auc, t.pr_auc AS tuned_pr_auc, t.cv_pr_auc AS cv_pr_auc FROM base b, tuned t)"""

METRIC_NAMES = ["accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc"]

RUN_METRICS = _union(
    [f"SELECT run_name, '{name}' AS metric, \"{name}\" AS value FROM latest" for name in METRIC_NAMES]
)

TUNING_PARAMETERS = _union(
    [
        f"SELECT run_name, '{name}' AS parameter, coalesce({name}, 'nicht protokolliert') AS value FROM latest"
        for name in ("n_estimators", "max_depth", "max_features")
    ]
    + [
        f"SELECT run_name, '{name}' AS parameter, 'nicht protokolliert' AS value FROM latest"
        for name in ("min_samples_leaf", "min_samples_split", "class_weight")
    ]
)

MODEL_SELECTION = f"""
SELECT 'pr_auc' AS primary_metric, w.run_name AS selected_model, w.run_id AS selected_run_id, baseline_run_id,
  tuned_run_id, baseline_pr_auc, tuned_pr_auc, round(tuned_pr_auc - baseline_pr_auc, 6) AS pr_auc_difference,
  d.cv_pr_auc, {', '.join(f'w."{name}" AS selected_{name}' for name in METRIC_NAMES)}
FROM decision d JOIN latest w ON w.run_id = CASE WHEN tuned_wins THEN tuned_run_id ELSE baseline_run_id END"""

SELECTED_RUN = """
SELECT o_orderkey AS run_id, o_orderdate AS start_time, CAST(o_custkey AS VARCHAR) AS param_selected_run_id
FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '3-MEDIUM'
ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1"""

SELECTED_ARTIFACT = """
SELECT l_orderkey * 10 + l_linenumber AS model_id, CASE WHEN l_linenumber % 2 = 1 THEN l_orderkey END AS source_run_id,
  CASE WHEN l_linenumber % 2 = 0 THEN l_orderkey END AS run_id, 'READY' AS status, l_shipdate AS creation_time
FROM lineitem JOIN decision ON l_orderkey = CASE WHEN tuned_wins THEN tuned_run_id ELSE baseline_run_id END
WHERE l_returnflag <> 'A' ORDER BY l_shipdate DESC, model_id DESC LIMIT 1"""

# Scored output

SCORED_PAIR = """
numbers AS (SELECT user_id, CAST(user_id AS BIGINT) AS n FROM gold),
pair AS (
  SELECT user_id, ((n * 37) % 101) / 100 AS a,
    CASE WHEN n % 50 = 0 THEN 1 - ((n * 37) % 101) / 100 ELSE ((n * 37) % 101) / 100 END AS b FROM numbers),
classes AS (SELECT *, CAST(a >= 0.5 AS INT) AS ca, CAST(b >= 0.5 AS INT) AS cb FROM pair)"""

PREDICTION_RULES = _union(
    [
        "SELECT 'class_is_binary' AS rule, count(*) FILTER (WHERE cb NOT IN (0, 1)) AS violations FROM classes",
        "SELECT 'probability_in_range', count(*) FILTER (WHERE NOT b BETWEEN 0 AND 1) FROM classes",
        "SELECT 'probability_present', count(*) FILTER (WHERE b IS NULL) FROM classes",
    ]
)

# Prediction log

LOG = """
log AS (
  SELECT CAST(event_id AS VARCHAR) AS request_id, event_type <> 'error' AS ok, value AS latency_ms,
    CASE WHEN event_type <> 'error' THEN value / 500 END AS churn_probability,
    CASE WHEN event_type <> 'error' THEN CAST(value >= 250 AS INT) END AS prediction, ts
  FROM events)"""

LOG_RECORDS = """
SELECT round(churn_probability, 6) AS churn_probability, CASE WHEN NOT ok THEN 'RuntimeError' END AS error_type,
  'prediction' AS event, round(latency_ms, 2) AS latency_ms, 'churn_model' AS model_name, '1' AS model_version,
  prediction, request_id, CASE WHEN ok THEN 'success' ELSE 'failed' END AS status,
  ts AS timestamp
FROM log"""

METRICS = """
SELECT 'churn_model' AS model_name, '1' AS model_version, count(*) AS total_requests,
  count(*) FILTER (WHERE ok) AS successful_predictions, count(*) FILTER (WHERE NOT ok) AS failed_predictions,
  count(*) FILTER (WHERE prediction = 1) AS predicted_churn_count,
  round(count(*) FILTER (WHERE prediction = 1) / count(*) FILTER (WHERE ok), 6) AS predicted_churn_rate,
  round(sum(churn_probability) / count(*) FILTER (WHERE ok), 6) AS average_churn_probability,
  round(avg(latency_ms), 2) AS average_latency_ms, max(ts) AS last_request_at
FROM log"""

ORACLES: dict[str, str] = {
    "gold_features": _query(GOLD, f"SELECT user_id, {ROUNDED_FEATURES}, churn FROM gold"),
    "silver_users": _query(SILVER, "SELECT * FROM silver_users"),
    "silver_orders": _query(SILVER, "SELECT * FROM silver_orders"),
    "silver_events": _query(SILVER, "SELECT * FROM silver_events"),
    "silver_orders_permissive": _query(
        RAW, "SELECT amount, order_id, user_id, item_count, creation_date FROM permissive", DIRTY_ORDERS
    ),
    "parse_losses": _query(RAW, PARSE_LOSSES, DIRTY_ORDERS),
    "orders_per_user": _query(
        AGGREGATES, "SELECT * REPLACE (round(avg_order_amount, 4) AS avg_order_amount) FROM per_orders"
    ),
    "events_per_user": _query(AGGREGATES, "SELECT * FROM per_events"),
    "events_per_user_known_platform": _query(SILVER, PER_EVENTS_KNOWN),
    "raw_round_trip": _query(RAW, _union([_row_texts(name) for name in RAW_COLUMNS])),
    "raw_parse_losses": (
        "SELECT 'users' AS dataset, CAST(0 AS BIGINT) AS lost_lines"
        " UNION ALL SELECT 'orders', count(*) FILTER (WHERE o_orderkey % 17 = 0) FROM orders"
        " UNION ALL SELECT 'events', count(*) FILTER (WHERE event_id % 19 = 0) FROM events"
    ),
    "batch_scores_check": _query(
        GOLD,
        "SELECT count(*) AS scored_rows, CAST(sum(CAST(user_id AS BIGINT)) AS BIGINT) AS id_sum,"
        " CAST(0 AS BIGINT) AS violations FROM checked WHERE reasons = ''",
        SCORING_ROWS,
    ),
    "validated_sample_check": _query(
        GOLD, "SELECT least(100, count(*)) AS sample_size, CAST(1 AS DOUBLE) AS prediction_agreement FROM gold"
    ),
    "validated_model_identity": _query(
        GOLD,
        "SELECT 'logistic_regression' AS model_name, true AS is_recorded_run, CAST(0.5 AS DOUBLE) AS threshold,"
        " least(100, count(*)) AS sample_size FROM gold",
    ),
    "logistic_optimality": _query(
        GOLD,
        "SELECT count(*) AS train_rows, CAST(sum(churn) AS BIGINT) AS positives, CAST(0 AS DOUBLE) AS largest_mean_gradient"
        " FROM placed JOIN sizes USING (churn) WHERE place > test_n",
        HASH_ORDER,
        SPLIT_SIZES,
    ),
    "tuning_results_check": _query(
        GOLD,
        "SELECT CAST(20 AS BIGINT) AS settings, CAST(0 AS BIGINT) AS wrong_means, CAST(0 AS BIGINT) AS impossible_scores,"
        " CAST(0 AS BIGINT) AS below_chance, CAST(0 AS BIGINT) AS wrong_ranks, CAST(20 AS BIGINT) AS distinct_settings"
        " FROM gold HAVING count(*) > 0",
    ),
    "sampled_settings": _query(
        GOLD,
        f"SELECT setting, {', '.join(f'param_{name}' for name in SEARCH_SPACE)}, fold, fit_rows, fit_ones"
        f" FROM (VALUES {_SETTINGS}) s(setting, {', '.join(f'param_{name}' for name in SEARCH_SPACE)}) CROSS JOIN fits",
        HASH_ORDER,
        SPLIT_SIZES,
        TRAIN_FOLDS,
    ),
    "forest_check": _query(
        GOLD,
        "SELECT CAST(250 AS BIGINT) AS trees, CAST(0 AS BIGINT) AS too_deep, CAST(0 AS BIGINT) AS not_binary,"
        " count(*) AS train_rows, CAST(sum(churn) AS BIGINT) AS train_ones, true AS beats_chance"
        " FROM placed JOIN sizes USING (churn) WHERE place > test_n",
        HASH_ORDER,
        SPLIT_SIZES,
    ),
    "bounded_forest_check": _query(
        GOLD,
        "SELECT CAST(sum(n) // 2 AS BIGINT) AS forest_rows, CAST(round(sum(ones) * 0.5) AS BIGINT) AS forest_ones"
        " FROM (SELECT count(*) AS n, sum(churn) AS ones FROM placed JOIN sizes USING (churn) WHERE place > test_n)",
        HASH_ORDER,
        SPLIT_SIZES,
    ),
    "model_runs_check": _query(
        GOLD,
        "SELECT run_name, 'FINISHED' AS status, test_rows, test_ones, 0 AS wrong_metrics FROM"
        " (SELECT count(*) AS test_rows, CAST(sum(churn) AS BIGINT) AS test_ones FROM placed JOIN sizes USING (churn) WHERE place <= test_n)"
        " CROSS JOIN (VALUES ('dummy'), ('logistic_regression'), ('random_forest')) r(run_name)",
        HASH_ORDER,
        SPLIT_SIZES,
    ),
    "scoring_outcomes": _query(
        GOLD,
        "SELECT CASE WHEN reasons = '' THEN 'success' ELSE 'failed' END AS status,"
        " CASE WHEN reasons <> '' THEN 'ValueError' END AS error_type, 'logistic_regression' AS model_name,"
        " count(*) AS requests, count(*) FILTER (WHERE reasons = '') AS probabilities FROM checked GROUP BY 1, 2",
        SCORING_ROWS,
    ),
    "ranked_settings": (
        "WITH scores AS (SELECT o_orderkey % 20 AS setting,"
        " CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) % 7 / 10.0 AS mean_test_score FROM orders GROUP BY 1)"
        " SELECT setting, CAST(mean_test_score AS DOUBLE) AS mean_test_score,"
        " CAST(rank() OVER (ORDER BY mean_test_score DESC) AS INT) AS rank_test_score FROM scores"
    ),
    "table_round_trip": _query(
        SILVER,
        _union(
            [
                f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}"
                for name in ("silver_users", "silver_orders", "silver_events")
            ]
        ),
    ),
    "profile_users": _query(RAW, _distinct("users", ["id", "email", "country", "churn"])),
    "profile_orders": _query(RAW, _distinct("orders", ["id", "user_id"])),
    "churn_counts": _query(RAW, "SELECT churn, count(*) AS row_count FROM raw_users GROUP BY churn"),
    "platform_counts": _query(RAW, "SELECT platform, count(*) AS row_count FROM raw_events GROUP BY platform"),
    "action_counts": _query(RAW, "SELECT action, count(*) AS row_count FROM raw_events GROUP BY action"),
    "countries": _query(RAW, "SELECT DISTINCT country FROM raw_users"),
    "event_key_profile": _query(
        RAW,
        "SELECT count(*) AS row_count, count(DISTINCT event_id) AS distinct_keys,"
        " count(*) FILTER (WHERE event_id IS NULL) AS missing_keys FROM raw_events",
    ),
    "users_like": _query(RAW, "SELECT * FROM raw_users WHERE contains(email, '48')"),
    "missing_profile": _query(
        RAW, _union([_missing(dataset, column) for dataset, names in RAW_COLUMNS.items() for column in names])
    ),
    "missing_profile_numbers": _query(
        GOLD,
        'SELECT "column", missing_count, round(missing_count / CAST(n AS DOUBLE), 4) AS missing_share FROM ('
        + " UNION ALL ".join(
            f"SELECT '{name}' AS \"column\", count(*) FILTER (WHERE {name} IS NULL"
            + (" OR CAST(user_id AS BIGINT) % 7 = 3" if name == "avg_order_amount" else "")
            + ") AS missing_count, count(*) AS n FROM gold"
            for name in NUMERIC_FEATURES
        )
        + ")",
    ),
    "quality_rules": _query(GOLD, QUALITY),
    "scoring_rows_rejected": _query(
        GOLD, "SELECT user_id, order_count, reasons FROM checked WHERE reasons <> ''", SCORING_ROWS
    ),
    "aligned_input": _query(GOLD, ALIGNED),
    "psi_lineitem": (
        f"WITH {PSI_SIDES},{_psi(['l_quantity', 'l_extendedprice', 'l_discount'], 'before', 'after')}"
        "\nSELECT feature, round(psi, 6) AS psi, n_bins FROM report"
    ),
    "drift_report": _query(GOLD, DRIFT_STATUS, GOLD_HALVES, _psi(NUMERIC_FEATURES, "even", "odd")),
    "stratified_split": _query(
        GOLD,
        "SELECT user_id, churn, place <= test_n AS is_test FROM placed JOIN sizes USING (churn)",
        HASH_ORDER,
        SPLIT_SIZES,
    ),
    "stratified_folds": _query(GOLD, "SELECT user_id, churn, CAST(third - 1 AS INT) AS fold FROM placed", HASH_ORDER),
    "class_weights": _query(
        GOLD,
        "SELECT churn AS label, count(*) AS entries, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6)"
        " AS weight FROM gold GROUP BY churn",
    ),
    "ranking_metrics": (
        f"WITH {BINARY_SCORES}\nSELECT CAST(positives AS BIGINT) AS positives, CAST(negatives AS BIGINT) AS negatives,"
        " round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc FROM ranking"
    ),
    "evaluation_metrics": (
        f"WITH {BINARY_SCORES},{EVALUATION}\nSELECT round((tp + tn) / n, 6) AS accuracy,"
        " round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS \"precision\","
        " round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,"
        " round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1,"
        " round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc FROM cells, ranking"
    ),
    "impute_scale_stats": _query(GOLD, STATISTICS),
    "category_modes": _query(GOLD, MODES),
    "one_hot_features": f"WITH {GOLD},{_one_hot()}",
    "one_hot_dictionary": f"WITH {GOLD},{_dictionary()}",
    "prior_baseline": _query(
        GOLD,
        "SELECT user_id, CAST(avg(churn) OVER () > 0.5 AS INT) AS prediction,"
        " round(avg(churn) OVER (), 6) AS churn_probability,"
        " CASE WHEN avg(churn) OVER () > 0.5 THEN 'Churn' ELSE 'Kein Churn' END AS label_text FROM gold",
    ),
    "latest_runs": f"WITH {RUNS}\nSELECT run_name, run_id, start_time, status, pr_auc FROM latest",
    "run_comparison": (
        f"WITH {RUNS}\nSELECT run_name, run_id, start_time, "
        + ", ".join(f'round("{name}", 4) AS "{name}"' for name in [*METRIC_NAMES, "cv_pr_auc"])
        + " FROM latest"
    ),
    "run_metrics": f"WITH {RUNS}\n{RUN_METRICS}",
    "tuning_parameters": f"WITH {RUNS}\n{TUNING_PARAMETERS}",
    "model_selection": f"WITH {RUNS}\n{MODEL_SELECTION}",
    "selected_run": SELECTED_RUN,
    "selected_artifact": f"WITH {RUNS}\n{SELECTED_ARTIFACT}",
    "top_sample": _query(
        GOLD,
        f"SELECT user_id, {ROUNDED_FEATURES}, churn, CAST(row_number() OVER (ORDER BY user_id) AS INT) AS sample_row"
        " FROM gold ORDER BY user_id LIMIT 100",
    ),
    "agreement": _query(
        GOLD,
        "SELECT count(*) AS paired_ids, CAST(0 AS BIGINT) AS unmatched_rows, CAST(0 AS BIGINT) AS repeated_ids,"
        " avg(CAST(ca = cb AS INT)) AS prediction_agreement FROM classes",
        SCORED_PAIR,
    ),
    "score_summary": _query(
        GOLD,
        "SELECT count(*) AS sample_size, min(b) AS minimum_probability, max(b) AS maximum_probability,"
        " CAST(sum(cb) AS BIGINT) AS predicted_churners FROM classes",
        SCORED_PAIR,
    ),
    "prediction_rules": _query(GOLD, PREDICTION_RULES, SCORED_PAIR),
    "prediction_log_records": f"WITH {LOG}{LOG_RECORDS}",
    "prediction_metrics": f"WITH {LOG}{METRICS}",
    "prediction_metrics_stream": f"WITH {LOG}{METRICS}",
}
