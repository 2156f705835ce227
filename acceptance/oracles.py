"""The same results in plain SQL for DuckDB, over the whole tables."""

from __future__ import annotations

EVENT_TS = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts"
EVENT_COLUMNS = f"event_id, user_id, event_type, value, {EVENT_TS}"

HASH = (
    "CAST(concat('0x', substr(md5(concat_ws('-', l_orderkey, l_linenumber, l_partkey)), 1, 8)) AS BIGINT)"
)
SIGNAL = "(l_quantity * 0.3::DOUBLE + l_discount * 40::DOUBLE - l_tax * 20::DOUBLE)"
DEVIATION = f"({SIGNAL} + ({HASH} % 100) / 50::DOUBLE - 1::DOUBLE)"
PART = f"CASE WHEN {HASH} % 10000 < 8000 THEN 'train' ELSE 'test' END"
LINE_KEYS = "l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey"
LINE_FEATURES = "l_quantity, l_discount, l_tax"


def bands(prediction: str) -> str:
    """Risk columns of a prediction."""
    return f"""
        CASE WHEN {prediction} >= 8 THEN 0.95::DOUBLE WHEN {prediction} >= 5 THEN 0.80::DOUBLE
             WHEN {prediction} >= 2 THEN 0.55::DOUBLE ELSE 0.25::DOUBLE END AS risk_score,
        CASE WHEN {prediction} >= 5 THEN 'HIGH' WHEN {prediction} >= 2 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
        CASE WHEN {prediction} >= 5 THEN 'High Risk' WHEN {prediction} >= 2 THEN 'Moderate Risk'
             ELSE 'Low Risk' END AS risk_classification"""


def least_squares(where: str = "true") -> str:
    """Common table expressions ending in ``ols(intercept, w1, w2, w3)``: normal equations by Cramer's rule."""
    return f"""
    lines AS (SELECT *, {DEVIATION} AS y FROM lineitem),
    moments AS (
        SELECT avg(l_quantity) AS m1, avg(l_discount) AS m2, avg(l_tax) AS m3, avg(y) AS my,
            var_pop(l_quantity) AS a11, var_pop(l_discount) AS a22, var_pop(l_tax) AS a33,
            covar_pop(l_quantity, l_discount) AS a12, covar_pop(l_quantity, l_tax) AS a13,
            covar_pop(l_discount, l_tax) AS a23,
            covar_pop(l_quantity, y) AS b1, covar_pop(l_discount, y) AS b2, covar_pop(l_tax, y) AS b3
        FROM lines WHERE {where}
    ),
    determinants AS (
        SELECT *,
            a11 * (a22 * a33 - a23 * a23) - a12 * (a12 * a33 - a23 * a13) + a13 * (a12 * a23 - a22 * a13) AS d,
            b1 * (a22 * a33 - a23 * a23) - a12 * (b2 * a33 - a23 * b3) + a13 * (b2 * a23 - a22 * b3) AS d1,
            a11 * (b2 * a33 - a23 * b3) - b1 * (a12 * a33 - a23 * a13) + a13 * (a12 * b3 - b2 * a13) AS d2,
            a11 * (a22 * b3 - b2 * a23) - a12 * (a12 * b3 - b2 * a13) + b1 * (a12 * a23 - a22 * a13) AS d3
        FROM moments
    ),
    ols AS (
        SELECT d1 / d AS w1, d2 / d AS w2, d3 / d AS w3,
            my - d1 / d * m1 - d2 / d * m2 - d3 / d * m3 AS intercept
        FROM determinants
    )"""


def stump(rows: str, label: str) -> str:
    """The split of ``rows`` with the least squared error of ``label``: feature, threshold, means on both sides."""
    sums = "OVER (PARTITION BY feature ORDER BY v)"
    return f"""(
        SELECT feature, (v + above) / 2 AS threshold, s / n AS low, (sum_all - s) / (n_all - n) AS high FROM (
            SELECT feature, v, lead(v) {sums} AS above, sum(n) {sums} AS n, sum(s) {sums} AS s,
                sum(n) OVER (PARTITION BY feature) AS n_all, sum(s) OVER (PARTITION BY feature) AS sum_all
            FROM (
                SELECT feature, v, count(*) AS n, sum(y) AS s FROM (
                    SELECT 1 AS feature, l_quantity AS v, {label} AS y FROM {rows}
                    UNION ALL SELECT 2, l_discount, {label} FROM {rows}
                    UNION ALL SELECT 3, l_tax, {label} FROM {rows}
                ) GROUP BY feature, v
            )
        ) WHERE above IS NOT NULL
        ORDER BY s * s / n + (sum_all - s) * (sum_all - s) / (n_all - n) DESC LIMIT 1
    )"""


def fall(tree: str) -> str:
    """What a stump says of a row."""
    value = f"CASE {tree}.feature WHEN 1 THEN l_quantity WHEN 2 THEN l_discount ELSE l_tax END"
    return f"(CASE WHEN {value} <= {tree}.threshold THEN {tree}.low ELSE {tree}.high END)"


FITTED = "(intercept + w1 * l_quantity + w2 * l_discount + w3 * l_tax)"


def metrics(label: str, prediction: str, digits: int) -> str:
    error = f"({label} - {prediction})"
    return f"""
        round(sqrt(avg({error} * {error})), {digits}) + 0.0 AS rmse,
        round(avg(abs({error})), {digits}) + 0.0 AS mae,
        round(1 - sum({error} * {error}) / (var_pop({label}) * count(*)), {digits}) + 0.0 AS r2"""



def scores(where: str = "true") -> str:
    """All line items scored by the least-squares model of those that ``where`` chooses."""
    return f"""
    WITH {least_squares(where)}, scored AS (SELECT lines.*, {FITTED} AS pred FROM lines, ols)
    SELECT {LINE_KEYS}, {LINE_FEATURES}, round(pred, 4) + 0.0 AS delivery_deviation_pred, {bands('pred')}
    FROM scored"""


SCORES = scores()

GAPPY = """(
    SELECT event_id,
        CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 = 0 THEN 'NaN'::DOUBLE ELSE value END AS value,
        CASE WHEN event_id % 13 <> 0 THEN event_type END AS event_type
    FROM events
)"""
HAS_VALUE = "value IS NOT NULL AND NOT isnan(value)"

K = "CAST(json_extract_string(props, '$.k') AS DOUBLE)"
DIRTY = f"""
    CASE event_id % 6 WHEN 1 THEN 'nan' WHEN 5 THEN 'number' ELSE 'null' END AS k_state,
    CASE WHEN event_id % 6 = 5 THEN {K} END AS k"""

PREDICTED = "(SELECT event_id, value / 10::DOUBLE AS delivery_deviation_pred FROM events)"
BANDED = f"SELECT event_id, delivery_deviation_pred, {bands('delivery_deviation_pred')} FROM {PREDICTED}"

ORACLES: dict[str, str] = {
    "binary_to_text": "SELECT event_id, json_extract_string(props, '$.k') AS text FROM events",
    "parse_event_json": f"SELECT event_id, {K} AS k FROM events",
    "parse_dirty_json": f"SELECT event_id, {DIRTY} FROM events",
    "publish_round_trip": f"SELECT {EVENT_COLUMNS} FROM events",
    "csv_scan": f"SELECT {EVENT_COLUMNS} FROM events",
    "csv_mixed_headers": f"""
        SELECT * REPLACE (CASE WHEN event_id % 3 <> 2 THEN event_type END AS event_type)
        FROM (SELECT {EVENT_COLUMNS} FROM events)""",
    "drop_incomplete_all": f"SELECT * FROM {GAPPY} WHERE {HAS_VALUE} AND event_type IS NOT NULL",
    "drop_incomplete_subset": f"SELECT * FROM {GAPPY} WHERE {HAS_VALUE}",
    "cast_features": """
        SELECT event_id,
            TRY_CAST(CASE WHEN event_id % 5 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS value
        FROM events""",
    "row_count": f"SELECT count(*) AS n FROM {GAPPY} WHERE {HAS_VALUE} AND event_type IS NOT NULL",
    "risk_bands": BANDED,
    "critical_alerts": f"SELECT * FROM ({BANDED}) WHERE severity = 'HIGH'",
    "threshold_filter": f"SELECT * FROM {PREDICTED} WHERE delivery_deviation_pred >= 5",
    "run_ids": """
        SELECT event_id, event_type, strftime(ts, '%Y%m%d_%H%M%S') AS run_id,
            '/models/' || event_type || '_' || strftime(ts, '%Y%m%d_%H%M%S') AS model_path
        FROM events""",
    "local_relation": f"""
        SELECT severity, event_id,
            CAST(CASE severity WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 8 ELSE 72 END AS BIGINT) AS hours
        FROM ({BANDED})""",
    "regression_quality": f"""
        SELECT count(*) AS n, {metrics('y', 'p', 6)}
        FROM (SELECT {DEVIATION} AS y, {SIGNAL} AS p FROM lineitem)""",
    "leaderboard": f"""
        WITH lines AS (SELECT *, {DEVIATION} AS y FROM lineitem)
        SELECT 'Constant' AS name, {metrics('y', '8::DOUBLE', 6)} FROM lines
        UNION ALL SELECT 'Quantity', {metrics('y', '(l_quantity * 0.3::DOUBLE)', 6)} FROM lines
        UNION ALL SELECT 'Signal', {metrics('y', SIGNAL, 6)} FROM lines
        UNION ALL SELECT 'SignalAgain', {metrics('y', SIGNAL, 6)} FROM lines""",
    "best_by_rmse": f"""
        WITH lines AS (SELECT *, {DEVIATION} AS y FROM lineitem),
        measured AS (
            SELECT 0 AS place, 'Constant' AS name, {metrics('y', '8::DOUBLE', 6)} FROM lines
            UNION ALL SELECT 1, 'Quantity', {metrics('y', '(l_quantity * 0.3::DOUBLE)', 6)} FROM lines
            UNION ALL SELECT 2, 'Signal', {metrics('y', SIGNAL, 6)} FROM lines
            UNION ALL SELECT 3, 'SignalAgain', {metrics('y', SIGNAL, 6)} FROM lines
        )
        SELECT name, rmse FROM measured ORDER BY rmse, place LIMIT 1""",
    "hash_split": f"SELECT l_orderkey, l_linenumber, l_partkey, {PART} AS part FROM lineitem",
    "random_split_whole": """
        SELECT count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys, sum(l_quantity) AS quantity, true AS share_kept
        FROM lineitem""",
    "assembled_features": """
        SELECT l_orderkey, l_linenumber, l_partkey,
            l_quantity AS feature_0, l_discount AS feature_1, l_tax AS feature_2
        FROM lineitem""",
    "spread_and_hold": "SELECT event_id, value, (SELECT count(*) FROM events) AS n FROM events",
    "ols_coefficients": f"""
        WITH {least_squares()}
        SELECT 'intercept' AS term, round(intercept, 5) + 0.0 AS weight FROM ols
        UNION ALL SELECT 'l_quantity', round(w1, 5) + 0.0 FROM ols
        UNION ALL SELECT 'l_discount', round(w2, 5) + 0.0 FROM ols
        UNION ALL SELECT 'l_tax', round(w3, 5) + 0.0 FROM ols""",
    "ols_test_predictions": f"""
        WITH {least_squares(f"{PART} = 'train'")}
        SELECT {LINE_FEATURES}, round({FITTED}, 4) + 0.0 AS prediction FROM lines, ols WHERE {PART} = 'test'""",
    "ols_leaderboard": f"""
        WITH {least_squares(f"{PART} = 'train'")}
        SELECT 'LinearRegression' AS name, {metrics('y', FITTED, 5)} FROM lines, ols WHERE {PART} = 'test'""",
    "model_leaderboard": """
        SELECT unnest(['LinearRegression', 'RandomForest', 'GBT']) AS name, unnest([true, false, false]) AS is_best,
            true AS finds_signal""",
    "lot_split_table": f"SELECT {LINE_FEATURES}, round({DEVIATION}, 6) + 0.0 AS deviation FROM lineitem",
    "forest_stump_predictions": f"""
        WITH lines AS (SELECT *, {DEVIATION} AS y FROM lineitem), tree AS {stump('lines', 'y')}
        SELECT {LINE_FEATURES}, round({fall('tree')}, 4) + 0.0 AS prediction FROM lines, tree""",
    # the second stump is fitted on twice the residual, the loss's slope, and counts a tenth
    "boosted_stump_predictions": f"""
        WITH lines AS (SELECT *, {DEVIATION} AS y FROM lineitem), tree AS {stump('lines', 'y')},
        residuals AS (SELECT lines.*, {fall('tree')} AS guess, 2 * (y - {fall('tree')}) AS slope FROM lines, tree),
        second AS {stump('residuals', 'slope')}
        SELECT {LINE_FEATURES}, round(guess + 0.1::DOUBLE * {fall('second')}, 4) + 0.0 AS prediction
        FROM residuals, second""",
    "model_pointer": f"""
        WITH {least_squares()}
        SELECT 'LinearRegression' AS model_name,
            round(sqrt(avg((y - {FITTED}) * (y - {FITTED}))), 5) + 0.0 AS rmse, true AS path_named_by_run
        FROM lines, ols""",
    "published_if_better": " UNION ALL ".join(
        f"""SELECT '{name}' AS name, rmse, {published} AS published, '{current}' AS current FROM (
            WITH {least_squares(where)} SELECT {metrics('y', FITTED, 5)} FROM lines, ols)"""
        for name, where, published, current in (
            ("R", "l_returnflag = 'R'", "true", "R"),
            ("ANR", "true", "true", "ANR"),
            ("A", "l_returnflag = 'A'", "false", "ANR"),
        )
    ),
    "latest_model_scores": SCORES,
    "stream_ingest": f"SELECT {EVENT_COLUMNS} FROM events",
    "stream_ingest_malformed": f"SELECT {DIRTY} FROM events",
    "rejected_messages": f"""
        SELECT CASE event_id % 8 WHEN 1 THEN 'nan' WHEN 7 THEN 'number' ELSE 'null' END AS k_state,
            CASE WHEN event_id % 8 = 7 THEN {K} END AS k,
            CASE event_id % 8 WHEN 0 THEN 'not json' WHEN 3 THEN '' WHEN 4 THEN '[' || props || ']'
                WHEN 5 THEN '{{"k": "five"}}' WHEN 6 THEN '  ' END AS text,
            CASE event_id % 8 WHEN 0 THEN 'malformed' WHEN 3 THEN 'empty' WHEN 4 THEN 'malformed'
                WHEN 5 THEN 'mistyped' WHEN 6 THEN 'empty' ELSE 'message' END AS kind
        FROM events""",
    "stream_restart": f"SELECT {EVENT_COLUMNS} FROM events",
    "stream_reprocess": f"""
        SELECT {EVENT_COLUMNS}, CAST(version AS BIGINT) AS version
        FROM events, (SELECT unnest([1, 2]) AS version)""",
    "stream_score_predictions": SCORES,
    "stream_score_alerts": f"SELECT * FROM ({SCORES}) WHERE severity = 'HIGH'",
    "stream_fan_out_agreement": f"""
        SELECT count(*) AS n_alerts, CAST(0 AS BIGINT) AS n_unmatched FROM ({SCORES}) WHERE severity = 'HIGH'""",
    "bounded_replay": f"""
        SELECT * REPLACE (CASE WHEN event_id % 3 = 1 THEN value + 1000 ELSE value END AS value), event_id % 3 AS batch_id
        FROM (SELECT {EVENT_COLUMNS} FROM events)""",
    "model_change_scores": f"""
        SELECT * FROM ({SCORES}) WHERE l_orderkey % 2 = 0
        UNION ALL SELECT * FROM ({scores("l_returnflag = 'R'")}) WHERE l_orderkey % 2 <> 0""",
    "batch_counts": f"""
        SELECT n + orders.orders AS read, lacking + orders.orders AS incomplete, n - lacking AS scored, critical,
            CAST(3 AS BIGINT) AS batches, true AS agree
        FROM (
            SELECT count(*) AS n, count(*) FILTER (l_partkey % 5 = 0) AS lacking,
                count(*) FILTER (l_partkey % 5 <> 0 AND severity = 'HIGH') AS critical
            FROM ({SCORES})
        ), (SELECT count(*) AS orders FROM orders) AS orders""",
    "schema_evolution": """
        SELECT event_id, value, NULL::VARCHAR AS event_type FROM events
        UNION ALL SELECT event_id, value, event_type FROM events""",
    "stream_schema_evolution": """
        SELECT event_id, value, NULL::VARCHAR AS event_type FROM events
        UNION ALL SELECT event_id, value, event_type FROM events""",
    "widened_column": """
        SELECT event_id, floor(value)::DOUBLE AS value, NULL::VARCHAR AS event_type FROM events
        UNION ALL SELECT event_id, value, NULL FROM events
        UNION ALL SELECT event_id, value, event_type FROM events""",
    "finished_tables_join": """
        SELECT n_name, count(*) AS n_lines, sum(l_quantity) AS quantity
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey < 5 GROUP BY n_name""",
    "registered_table": "SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate) FROM orders",
    "registered_table_limit": "SELECT event_id, event_type, value FROM events ORDER BY event_id LIMIT 10",
    "registered_predictions": f"SELECT severity, count(*) AS n FROM ({SCORES}) GROUP BY severity",
    "parameterised_sql": "SELECT event_id, value FROM events WHERE event_type = 'error' AND value >= 50",
    "named_sql": "SELECT event_id, value AS shown FROM events WHERE event_type IN ('error', 'click')",
    "rebalanced_append": "SELECT event_id, value, event_type FROM events",
    "sql_join": """
        SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS n_lines, sum(l_quantity) AS quantity
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderpriority""",
    "sql_group_by": """
        SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS quantity
        FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    "sql_window": """
        SELECT o_custkey, o_orderkey, o_totalprice FROM (
            SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS place
            FROM orders
        ) WHERE place = 1""",
}
