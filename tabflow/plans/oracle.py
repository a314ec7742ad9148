"""DuckDB SQL for the correctness oracle.

Each statement restates a query of ``tabflow.plans.catalog`` directly in SQL
over the driver's views (``orders``, ``customer``, ``events``, ...), written
from the operator's definition (ROW_NUMBER where we avoid one, EXISTS where we
use a join), so the two sides are independent formulations. Floats are
rounded to 6 digits on both sides where the engines sum in different orders
(single IEEE operations such as one division are left unrounded: they are
bit-identical, and rounding would only add half-way ties); integer sums are
cast to BIGINT.
"""

from __future__ import annotations

from tabflow.operators.model import BASELINE_PARAMS, PRODUCTION_PARAMS
from tabflow.plans import fixtures as fx

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
STATUSES = ["F", "O", "P"]


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _onehot_sql(col: str, values: list[str]) -> str:
    out = []
    for v in values:
        name = f"{col}_{v}".replace(" ", "").replace("(", "-").replace(")", "")
        out.append(f'CAST(CASE WHEN {col} = {_q(v)} THEN 1 ELSE 0 END AS BIGINT) AS "{name}"')
    return ",\n  ".join(out)


def bucket_sql(seed: int, key: str) -> str:
    return f"CAST(('0x' || substr(md5('{seed}' || ':' || CAST(({key}) AS VARCHAR)), 1, 8)) AS BIGINT)"


SCORED = """
  SELECT d.doc_id, d.lang, l.toxic, l.quality AS label,
         CAST(d.n_chars > 1000 AS INTEGER) AS prediction, CAST(d.n_chars AS DOUBLE) AS score
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""

ORDERS_NULLED = """
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS o_totalprice,
         o_orderdate,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS o_orderpriority
  FROM orders
"""

RUNS = f"""
  SELECT CAST(o_orderkey AS VARCHAR) AS run_id, CAST(o_custkey AS VARCHAR) AS experiment_id,
         o_orderpriority AS run_name,
         CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'RUNNING' WHEN 'P' THEN 'FAILED' END AS status,
         o_orderdate AS end_time,
         o_totalprice / {fx.METRIC_SCALE} AS test_accuracy_score,
         1.0 - o_totalprice / {fx.METRIC_SCALE} AS val_f1_score,
         (o_custkey % 13) = 0 AS deleted
  FROM orders
"""

_TAG_LIST = "[" + ", ".join(_q(k) for k in fx.TAG_KEYS) + "]"

EVENTS = f"""
  SELECT event_id AS seq, 'm' || CAST(user_id % 10 AS VARCHAR) AS name, user_id AS version,
         CASE WHEN event_type = 'signup' THEN 'tag' ELSE 'stage' END AS kind,
         CASE WHEN event_type = 'signup' THEN NULL
              ELSE CASE event_type WHEN 'view' THEN 'None' WHEN 'click' THEN 'Staging'
                                   WHEN 'purchase' THEN 'Production' WHEN 'error' THEN 'Archived' END END AS to_stage,
         (event_type <> 'signup' AND event_id % 3 = 0 AND event_type IN ('click', 'purchase')) AS archive_existing,
         CASE WHEN event_type = 'signup' THEN {_TAG_LIST}[k % 8 + 1] END AS key,
         CASE WHEN event_type <> 'signup' THEN NULL
              WHEN k % 8 IN (0, 1, 3, 4) THEN CASE WHEN value >= 5 THEN '1' ELSE '0' END
              WHEN k % 8 = 2 THEN CASE WHEN value >= 5 THEN 'pass' ELSE 'fail' END
              WHEN k % 8 = 5 THEN CASE WHEN value >= 10 THEN {_q(fx.RELEASE_OK)} ELSE {_q(fx.RELEASE_RECHECK)} END
              WHEN k % 8 = 6 THEN substr({_q(fx.DESCRIPTION_TEXT)}, 1, k % 40)
              ELSE {_q(fx.COMMENT_TEXT)} END AS value
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
"""

STAGES = f"""
  ev AS ({EVENTS}),
  st AS (SELECT * FROM ev WHERE kind = 'stage'),
  own AS (SELECT name, version, to_stage AS own_stage, seq AS stage_seq FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY name, version ORDER BY seq DESC) AS rn FROM st) WHERE rn = 1),
  reg AS (SELECT name, version, MIN(seq) AS registered_seq FROM ev GROUP BY name, version),
  stages AS (
    SELECT r.name, r.version,
           CASE WHEN o.own_stage IS NULL THEN 'None'
                WHEN EXISTS (SELECT 1 FROM st a WHERE a.archive_existing AND a.name = r.name
                             AND a.to_stage = o.own_stage AND a.version <> r.version AND a.seq > o.stage_seq)
                THEN 'Archived' ELSE o.own_stage END AS stage,
           COALESCE(o.stage_seq, r.registered_seq) AS stage_seq
    FROM reg r LEFT JOIN own o ON o.name = r.name AND o.version = r.version),
  tags AS (SELECT name, version, key, value FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY name, version, key ORDER BY seq DESC) AS rn
            FROM ev WHERE kind = 'tag') WHERE rn = 1)
"""


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["one_hot"] = f"""
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate,
  {_onehot_sql('o_orderstatus', STATUSES)},
  {_onehot_sql('o_orderpriority', PRIORITIES)}
FROM orders"""
    q["label_map"] = """
SELECT o_orderkey, CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS INTEGER) AS churn FROM orders"""
    q["drop_nulls"] = """
SELECT * FROM (
  SELECT o_orderkey, o_totalprice, CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS INTEGER) AS churn
  FROM orders) WHERE churn IS NOT NULL AND o_totalprice IS NOT NULL"""
    q["build_features"] = f"""
SELECT o_orderkey, o_custkey,
  CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS INTEGER) AS churn,
  o_totalprice, o_orderdate,
  {_onehot_sql('o_orderpriority', PRIORITIES)}
FROM orders WHERE o_orderstatus IN ('F', 'O')"""
    q["feature_table"] = q["build_features"]
    q["to_double"] = """
SELECT o_orderkey, TRY_CAST(o_orderpriority AS DOUBLE) AS priority_num,
       TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS priority_digit
FROM orders"""
    q["impute_mean"] = f"""
WITH t AS ({ORDERS_NULLED})
SELECT o_orderkey, ROUND(COALESCE(o_totalprice, (SELECT AVG(o_totalprice) FROM t)), 6) AS o_totalprice FROM t"""
    q["fill_constant"] = f"""
WITH t AS ({ORDERS_NULLED})
SELECT o_orderkey, COALESCE(o_orderpriority, '') AS o_orderpriority FROM t"""
    q["impute_mode"] = f"""
WITH t AS ({ORDERS_NULLED}),
m AS (SELECT o_totalprice AS v FROM t WHERE o_totalprice IS NOT NULL
      GROUP BY o_totalprice ORDER BY COUNT(*) DESC, o_totalprice LIMIT 1)
SELECT o_orderkey, COALESCE(o_totalprice, (SELECT v FROM m)) AS o_totalprice FROM t"""
    q["standardize"] = """
SELECT c_custkey,
  ROUND((c_acctbal - (SELECT AVG(c_acctbal) FROM customer)) / (SELECT STDDEV_POP(c_acctbal) FROM customer), 6) AS c_acctbal
FROM customer"""
    q["impute_mean_merged"], q["impute_mode_merged"], q["standardize_merged"] = q["impute_mean"], q["impute_mode"], q["standardize"]
    q["drop_label_key"] = f"""
SELECT * EXCLUDE (o_orderkey, churn, o_orderdate) FROM ({q["build_features"]})"""
    numbered = lambda c: f"SELECT v, ROW_NUMBER() OVER (ORDER BY substr(md5(v), 1, 8), v) - 1 AS i FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM orders WHERE {c} IS NOT NULL)"
    q["encode_categories"] = f"""
WITH a AS ({numbered("o_custkey")}), b AS ({numbered("o_orderpriority")}), n AS (SELECT COUNT(*) AS n FROM a)
SELECT o_orderkey, a.i AS customer_place, b.i + n.n AS priority_place, n.n + (SELECT COUNT(*) FROM b) AS n_features
FROM orders LEFT JOIN a ON a.v = CAST(o_custkey AS VARCHAR) LEFT JOIN b ON b.v = o_orderpriority, n"""
    # the model queries: what holds whatever the trees are
    line_bucket = bucket_sql(0, "l_orderkey || ':' || l_linenumber")
    q["train_production_facts"] = f"""
SELECT split, COUNT(*) AS n, CAST(SUM(label) AS BIGINT) AS positives, 1 AS covered, 1 AS areas
FROM (SELECT CASE WHEN {line_bucket} < 858993459 THEN 'test' ELSE 'train' END AS split,
             CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label FROM lineitem)
GROUP BY split"""
    q["score_facts"] = """
SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, COUNT(*) AS n, CAST(0 AS BIGINT) AS n_null, COUNT(*) AS n_probable
FROM lineitem GROUP BY 1"""
    q["score_stream_facts"] = """
SELECT l_linenumber, COUNT(*) AS n, COUNT(*) AS n_scored FROM lineitem GROUP BY 1"""
    q["hash_text_facts"] = """
SELECT p_type, COUNT(*) AS n, 1 AS most, 1 AS least, 0 AS spread FROM part GROUP BY 1"""
    sampled = f"""
SELECT row_key, CAST(4 AS BIGINT) AS n_features, 1 AS adds_up FROM (
  SELECT row_key FROM (SELECT l_orderkey || ':' || l_linenumber AS row_key FROM lineitem WHERE {line_bucket} < 858993459)
  GROUP BY row_key HAVING COUNT(*) = 1 ORDER BY {bucket_sql(1, 'row_key')}, row_key LIMIT %d)"""
    q["shapley_facts"] = sampled % 1
    q["kernel_shapley_facts"] = sampled % 5
    q["booster_leaves"] = f"""
SELECT CAST(tree AS INTEGER) AS tree, n, 1 AS few, 1 AS filled
FROM range({PRODUCTION_PARAMS['n_estimators']}) t(tree), (SELECT COUNT(*) AS n FROM lineitem WHERE {line_bucket} >= 858993459)"""
    q["score_function"] = """
SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, COUNT(*) AS n, CAST(0 AS BIGINT) AS n_different FROM lineitem GROUP BY 1"""
    l1, l2, smooth = (PRODUCTION_PARAMS[k] for k in ("lambda_l1", "lambda_l2", "path_smooth"))
    least, rate = PRODUCTION_PARAMS["min_child_samples"], PRODUCTION_PARAMS["learning_rate"]
    output = lambda g, h, n: f"(-SIGN({g}) * GREATEST(ABS({g}) - {l1}, 0) / ({h} + {l2}) * ({n} / {smooth}) / ({n} / {smooth} + 1))"
    gain = lambda g, h, w: f"(-(2 * SIGN({g}) * GREATEST(ABS({g}) - {l1}, 0) * {w} + ({h} + {l2}) * {w} * {w}))"
    # every cut of every feature; the root's gradients add up to 0, and so do its output and gain
    q["booster_split"] = f"""
WITH r AS (SELECT CAST(l_quantity AS DOUBLE) AS l_quantity, l_discount, l_tax, CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS y FROM lineitem),
u AS (SELECT 'l_quantity' AS f, 0 AS k, l_quantity AS v, y FROM r UNION ALL SELECT 'l_discount', 1, l_discount, y FROM r UNION ALL SELECT 'l_tax', 2, l_tax, y FROM r),
a AS (SELECT f, k, v, COUNT(*) AS n, SUM(y) AS s FROM u GROUP BY f, k, v),
c AS (SELECT f, k, v, LEAD(v) OVER o AS above, CAST(SUM(n) OVER o AS DOUBLE) AS nl, SUM(s) OVER o AS sl,
        CAST(SUM(n) OVER (PARTITION BY f) AS DOUBLE) AS nt, SUM(s) OVER (PARTITION BY f) AS st FROM a WINDOW o AS (PARTITION BY f ORDER BY v)),
d AS (SELECT *, nt - nl AS nr, st / nt AS p, nl * st / nt - sl AS gl, (nt - nl) * st / nt - (st - sl) AS gr FROM c WHERE above IS NOT NULL),
e AS (SELECT *, nl * p * (1 - p) AS hl, nr * p * (1 - p) AS hr FROM d WHERE nl >= {least} AND nr >= {least}),
w AS (SELECT *, {output("gl", "hl", "nl")} AS wl, {output("gr", "hr", "nr")} AS wr FROM e),
x AS (SELECT *, {gain("gl", "hl", "wl")} + {gain("gr", "hr", "wr")} AS gain FROM w)
SELECT f AS feature, ROUND((v + above) / 2, 6) AS threshold, ROUND(gain, 3) AS gain, CAST(nl AS BIGINT) AS n_left, ROUND(wl * {rate}, 6) AS left_value,
       CAST(nr AS BIGINT) AS n_right, ROUND(wr * {rate}, 6) AS right_value
FROM x ORDER BY gain DESC, k, v LIMIT 1"""
    least, rate = BASELINE_PARAMS["min_child_weight"], BASELINE_PARAMS["learning_rate"]
    # every row starts at a probability of 1/2: a gradient of 1/2 - y and a hessian of 1/4
    q["baseline_split"] = f"""
WITH r AS (SELECT CAST(l_quantity AS DOUBLE) AS l_quantity, l_discount, l_tax, CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS y FROM lineitem),
u AS (SELECT 'l_quantity' AS f, 0 AS k, l_quantity AS v, y FROM r UNION ALL SELECT 'l_discount', 1, l_discount, y FROM r UNION ALL SELECT 'l_tax', 2, l_tax, y FROM r),
a AS (SELECT f, k, v, COUNT(*) AS n, SUM(0.5 - y) AS g FROM u GROUP BY f, k, v),
c AS (SELECT f, k, v, LEAD(v) OVER o AS above, SUM(n) OVER o AS nl, SUM(g) OVER o AS gl,
        SUM(n) OVER (PARTITION BY f) AS nt, SUM(g) OVER (PARTITION BY f) AS gt FROM a WINDOW o AS (PARTITION BY f ORDER BY v)),
d AS (SELECT *, nt - nl AS nr, gt - gl AS gr, nl / 4.0 + 1 AS hl, (nt - nl) / 4.0 + 1 AS hr FROM c WHERE above IS NOT NULL),
x AS (SELECT *, gl * gl / hl + gr * gr / hr - gt * gt / (nt / 4.0 + 1) AS gain FROM d WHERE hl - 1 >= {least} AND hr - 1 >= {least})
SELECT f AS feature, ROUND((v + above) / 2, 6) AS threshold, ROUND(CAST(gain AS DOUBLE), 3) AS gain, CAST(nl AS BIGINT) AS n_left, ROUND(CAST(-gl / hl * {rate} AS DOUBLE), 6) AS left_value,
       CAST(nr AS BIGINT) AS n_right, ROUND(CAST(-gr / hr * {rate} AS DOUBLE), 6) AS right_value
FROM x ORDER BY gain DESC, k, v LIMIT 1"""
    q["train_baseline_facts"] = f"""
SELECT CAST(SUM(CEIL(0.25 * n)) AS BIGINT) AS val_n, CAST(SUM(CASE WHEN label = 1 THEN CEIL(0.25 * n) ELSE 0 END) AS BIGINT) AS val_positives,
       CAST({BASELINE_PARAMS["n_estimators"]} AS BIGINT) AS n_trees, CAST(0 AS BIGINT) AS n_light
FROM (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, COUNT(*) AS n FROM lineitem GROUP BY 1)"""
    q["hash_signed"] = """
SELECT p_partkey, p_type, 1 AS n_slots, CAST((b % 2147483648) % 4096 AS INTEGER) AS slot, CASE WHEN b >= 2147483648 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END AS value
FROM (SELECT p_partkey, p_type, CAST('0x' || substr(md5(COALESCE(p_type, '')), 1, 8) AS BIGINT) AS b FROM part)"""
    q["hash_split"] = f"""
SELECT c_custkey, bucket, CASE WHEN bucket < 858993459 THEN 'test' ELSE 'train' END AS split
FROM (SELECT c_custkey, {bucket_sql(0, 'c_custkey')} AS bucket FROM customer)"""
    q["stratified_split"] = f"""
SELECT doc_id, quality, CASE WHEN rn <= CEIL(0.25 * n) THEN 'test' ELSE 'train' END AS split
FROM (SELECT doc_id, quality,
        ROW_NUMBER() OVER (PARTITION BY quality ORDER BY {bucket_sql(520692802, 'doc_id')}, doc_id) AS rn,
        COUNT(*) OVER (PARTITION BY quality) AS n
      FROM labels)"""
    q["sample_n"] = f"""
SELECT * FROM customer ORDER BY {bucket_sql(0, 'c_custkey')}, c_custkey LIMIT 100"""
    q["smoke_rows"] = """
SELECT * FROM customer ORDER BY c_custkey LIMIT 10"""
    q["flag_correct"] = f"""
SELECT doc_id, label, prediction, CASE WHEN label = prediction THEN 1 ELSE 0 END AS accurate FROM ({SCORED})"""
    q["accuracy"] = f"""
SELECT COUNT(*) AS n, CAST(SUM(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS BIGINT) AS n_correct,
       ROUND(AVG(CASE WHEN label = prediction THEN 1 ELSE 0 END), 6) AS accuracy
FROM ({SCORED})"""
    q["slice_accuracy"] = f"""
SELECT toxic, lang, acc, obs, ROUND(acc / obs, 6) AS pct_acc FROM (
  SELECT toxic, lang, CAST(SUM(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS BIGINT) AS acc, COUNT(*) AS obs
  FROM ({SCORED}) WHERE toxic IS NOT NULL AND lang IS NOT NULL GROUP BY toxic, lang)"""
    q["slice_gate"] = f"""
SELECT CASE WHEN COUNT(*) = 0 THEN 'none' WHEN MIN(pct) > 0.55 THEN 'pass' ELSE 'fail' END AS demo_test,
       COUNT(*) AS n_slices, ROUND(MIN(pct), 6) AS min_pct_acc
FROM (SELECT SUM(CASE WHEN label = prediction THEN 1 ELSE 0 END) / COUNT(*) AS pct
      FROM ({SCORED}) WHERE toxic IS NOT NULL AND lang IS NOT NULL GROUP BY toxic, lang)"""
    q["binary_metrics"] = f"""
SELECT n, tp, fp, tn, fn,
  ROUND((tp + tn) / n, 6) AS accuracy_score,
  ROUND(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision_score,
  ROUND(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall_score,
  ROUND(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1_score
FROM (SELECT COUNT(*) AS n,
        CAST(SUM(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
        CAST(SUM(CASE WHEN label <> 1 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
        CAST(SUM(CASE WHEN label <> 1 AND prediction <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
        CAST(SUM(CASE WHEN label = 1 AND prediction <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn
      FROM ({SCORED}))"""
    curve = f"""
WITH s AS (SELECT score, CAST(SUM(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS pos,
                  CAST(SUM(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS DOUBLE) AS neg
           FROM ({SCORED}) WHERE score IS NOT NULL GROUP BY score),
c AS (SELECT *, SUM(pos) OVER (ORDER BY score DESC) AS tp, SUM(neg) OVER (ORDER BY score DESC) AS fp FROM s),
p AS (SELECT *, tp / (tp + fp) AS prec,
             LAG(tp / (tp + fp)) OVER (ORDER BY score DESC) AS prev_prec FROM c)"""
    q["roc_auc"] = curve + """
SELECT ROUND(SUM(neg * (tp - pos / 2.0)) / (SUM(pos) * SUM(neg)), 6) AS roc_auc FROM p"""
    q["pr_auc"] = curve + """
SELECT ROUND(SUM(pos * (prec + COALESCE(prev_prec, prec)) / 2.0) / SUM(pos), 6) AS pr_auc FROM p"""
    shares = f"SELECT *, score / (score + 1000.0) AS p FROM ({SCORED})"
    loss = "-AVG(CASE WHEN label = 1 THEN LN(LEAST(GREATEST(p, 1e-15), 1 - 1e-15)) ELSE LN(1 - LEAST(GREATEST(p, 1e-15), 1 - 1e-15)) END)"
    q["log_loss"] = f"""
SELECT COUNT(*) AS n, ROUND({loss}, 6) AS log_loss FROM ({shares})"""
    q["evaluate"] = f"""
WITH r AS ({shares}),
s AS (SELECT lang, p, CAST(SUM(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS pos, CAST(SUM(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS DOUBLE) AS neg
      FROM r WHERE p IS NOT NULL GROUP BY lang, p),
c AS (SELECT *, SUM(pos) OVER o AS tp, SUM(neg) OVER o AS fp FROM s WINDOW o AS (PARTITION BY lang ORDER BY p DESC)),
k AS (SELECT *, tp / (tp + fp) AS prec, LAG(tp / (tp + fp)) OVER (PARTITION BY lang ORDER BY p DESC) AS prev FROM c),
a AS (SELECT lang, ROUND(CASE WHEN SUM(pos) * SUM(neg) > 0 THEN SUM(neg * (tp - pos / 2.0)) / (SUM(pos) * SUM(neg)) END, 6) AS roc_auc,
             ROUND(CASE WHEN SUM(pos) > 0 THEN SUM(pos * (prec + COALESCE(prev, prec)) / 2.0) / SUM(pos) END, 6) AS pr_auc FROM k GROUP BY lang),
m AS (SELECT lang, COUNT(*) AS n, {loss} AS loss,
        CAST(COUNT(*) FILTER (label = 1 AND prediction = 1) AS BIGINT) AS tp, CAST(COUNT(*) FILTER (label <> 1 AND prediction = 1) AS BIGINT) AS fp,
        CAST(COUNT(*) FILTER (label <> 1 AND prediction <> 1) AS BIGINT) AS tn, CAST(COUNT(*) FILTER (label = 1 AND prediction <> 1) AS BIGINT) AS fn
      FROM r GROUP BY lang)
SELECT m.lang, n, tp, fp, tn, fn, ROUND((tp + tn) / n, 6) AS accuracy_score,
  ROUND(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision_score, ROUND(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall_score,
  ROUND(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1_score, ROUND(loss, 6) AS log_loss, roc_auc, pr_auc
FROM m JOIN a ON m.lang IS NOT DISTINCT FROM a.lang"""
    q["log_runs"] = f"""
SELECT run_id, status, end_time, deleted, test_accuracy_score, run_name FROM ({RUNS})"""
    q["select_run"] = f"""
SELECT run_id, end_time, test_accuracy_score FROM ({RUNS})
WHERE status = 'FINISHED' AND NOT deleted AND run_name = {_q(fx.RUN_NAME)} AND test_accuracy_score > 0.78
ORDER BY end_time DESC, run_id DESC LIMIT 1"""
    q["leaderboard"] = f"""
SELECT run_id, run_name, val_f1_score FROM ({RUNS})
WHERE status = 'FINISHED' AND NOT deleted ORDER BY val_f1_score DESC, run_id LIMIT 10"""
    q["versions"] = f"""
WITH ev AS ({EVENTS})
SELECT name, version, registered_seq,
       ROW_NUMBER() OVER (PARTITION BY name ORDER BY registered_seq, version) AS version_number
FROM (SELECT name, version, MIN(seq) AS registered_seq FROM ev GROUP BY name, version)"""
    q["current_stage"] = f"""
WITH {STAGES}
SELECT name, version, stage, stage_seq FROM stages"""
    q["latest_versions"] = f"""
WITH {STAGES}
SELECT name, stage, MAX(version) AS version FROM stages GROUP BY name, stage"""
    q["current_tags"] = f"""
WITH {STAGES}
SELECT name, version, key, value FROM tags"""
    q["current_stage_increment"], q["current_tags_increment"] = q["current_stage"], q["current_tags"]
    q["model_tags"] = f"""
SELECT name, key, arg_max(value, seq) AS value FROM ({EVENTS}) WHERE kind = 'tag' AND key IN ('description', 'comment') GROUP BY name, key"""
    q["find_release"] = f"""
WITH {STAGES}
SELECT t.name, MAX(t.version) AS version FROM tags t JOIN stages s ON s.name = t.name AND s.version = t.version
WHERE t.key = 'overall status' AND t.value = {_q(fx.RELEASE_OK)} AND s.stage = 'Staging'
GROUP BY t.name"""
    q["gate"] = f"""
WITH {STAGES}
SELECT g.name, g.version, g.n_checks, g.rejected,
       CASE WHEN g.rejected THEN {_q(fx.RELEASE_RECHECK)} ELSE {_q(fx.RELEASE_OK)} END AS overall_status,
       CASE WHEN g.rejected THEN 'Archived' ELSE COALESCE(s.stage, 'None') END AS next_stage
FROM (SELECT name, version, COUNT(*) AS n_checks, BOOL_OR(value IN ('0', 'fail')) AS rejected
      FROM tags WHERE key IN ('predicts', 'has_signature', 'demo_test', 'has_description', 'has_artifacts')
      GROUP BY name, version) g
LEFT JOIN stages s ON s.name = g.name AND s.version = g.version"""
    q["check_key"] = """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber
HAVING COUNT(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL"""
    q["check_key_documents"] = """
SELECT doc_id, COUNT(*) AS n FROM documents GROUP BY doc_id HAVING COUNT(*) > 1 OR doc_id IS NULL"""
    q["check_schema"] = """
SELECT * FROM (VALUES
  ('c_custkey', 'bigint', 'bigint', 'ok', (SELECT COUNT(*) - COUNT(c_custkey) FROM customer),
   (SELECT COUNT(*) FROM customer WHERE c_custkey IS NOT NULL AND TRY_CAST(c_custkey AS BIGINT) IS NULL)),
  ('c_name', 'string', 'string', 'ok', (SELECT COUNT(*) - COUNT(c_name) FROM customer),
   (SELECT COUNT(*) FROM customer WHERE c_name IS NOT NULL AND TRY_CAST(c_name AS VARCHAR) IS NULL)),
  ('c_nationkey', 'bigint', 'int', 'wrong_type', (SELECT COUNT(*) - COUNT(c_nationkey) FROM customer),
   (SELECT COUNT(*) FROM customer WHERE c_nationkey IS NOT NULL AND TRY_CAST(c_nationkey AS BIGINT) IS NULL)),
  ('c_acctbal', 'double', 'double', 'ok', (SELECT COUNT(*) - COUNT(c_acctbal) FROM customer),
   (SELECT COUNT(*) FROM customer WHERE c_acctbal IS NOT NULL AND TRY_CAST(c_acctbal AS DOUBLE) IS NULL)),
  ('c_phone', 'string', NULL, 'missing', NULL, NULL),
  ('c_mktsegment', NULL, 'string', 'extra', NULL, NULL)
) AS t(column_name, expected_type, actual_type, status, nulls, bad_values)"""
    q["check_description"] = """
SELECT doc_id, CAST(COALESCE(length(text), 0) > 20 AS INTEGER) AS has_description FROM documents"""
    q["append_predictions"] = f"""
SELECT doc_id, label, prediction, CASE WHEN lang IN ('en', 'de') THEN 'b1' ELSE 'b2' END AS batch_id
FROM ({SCORED})"""
    q["csv_round_trip"] = """
SELECT * FROM customer"""
    q["external_table"] = """
SELECT * FROM customer"""
    q["csv_inferred"] = """
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"""
    q["check_predicts"] = """
SELECT COUNT(*) AS n, COUNT(*) AS n_predicted, 1 AS predicts FROM lineitem"""
    return q
