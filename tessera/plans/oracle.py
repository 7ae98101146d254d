"""Independent ANSI-SQL (DuckDB dialect) statements of the catalogue queries.

Each statement reads the registered views (region, nation, customer, ...) and
recomputes the query from scratch with plain SQL (window functions and
``quantile_cont`` where the Spark side uses distributed operators). Column
names equal the Spark side. ``R(x, d)`` rounding is written out as
``floor(x * 1e<d> + 0.5) / 1e<d>`` on both sides.
"""
from __future__ import annotations


def R(x: str, d: int) -> str:
    return f"(floor(({x}) * 1e{d} + 0.5) / 1e{d})"


def R6(x: str) -> str:
    return R(x, 6)


AS_OF_ORDERS = "TIMESTAMP '2001-12-31'"
SEGS = ["Champions", "Loyal Customers", "Potential Loyalists", "At Risk", "Lost Customers"]

RFM = f"""
rfm_a AS (
  SELECT o_custkey AS customer_id,
         CAST(date_diff('day', max(o_orderdate), {AS_OF_ORDERS}) AS INTEGER) AS recency_days,
         count(*) AS frequency,
         {R('sum(o_totalprice)', 2)} AS monetary_total,
         {R('avg(o_totalprice)', 2)} AS monetary_avg,
         coalesce({R('stddev_samp(o_totalprice)', 2)}, 0.0) AS monetary_std
  FROM orders GROUP BY o_custkey),
rfm_e AS (
  SELECT quantile_cont(recency_days::DOUBLE, [0.2, 0.4, 0.6, 0.8]) AS r,
         quantile_cont(frequency::DOUBLE, [0.2, 0.4, 0.6, 0.8]) AS f,
         quantile_cont(monetary_total::DOUBLE, [0.2, 0.4, 0.6, 0.8]) AS m FROM rfm_a),
rfm_s AS (
  SELECT a.*,
    CAST(5 - (recency_days > r[1])::INT - (recency_days > r[2])::INT - (recency_days > r[3])::INT
           - (recency_days > r[4])::INT AS DOUBLE) AS recency_score,
    CAST(1 + (frequency > f[1])::INT + (frequency > f[2])::INT + (frequency > f[3])::INT
           + (frequency > f[4])::INT AS DOUBLE) AS frequency_score,
    CAST(1 + (monetary_total > m[1])::INT + (monetary_total > m[2])::INT + (monetary_total > m[3])::INT
           + (monetary_total > m[4])::INT AS DOUBLE) AS monetary_score
  FROM rfm_a a CROSS JOIN rfm_e),
rfm AS (
  SELECT *, CASE WHEN rfm_score >= 4.5 THEN 'Champions' WHEN rfm_score >= 3.5 THEN 'Loyal Customers'
                 WHEN rfm_score >= 2.5 THEN 'Potential Loyalists' WHEN rfm_score >= 1.5 THEN 'At Risk'
                 ELSE 'Lost Customers' END AS customer_segment
  FROM (SELECT *, (recency_score + frequency_score + monetary_score) / 3.0::DOUBLE AS rfm_score FROM rfm_s))
"""

# Sessions (6 h gap, ties by event_id) and the behaviour table.
BEH = f"""
ev_g AS (
  SELECT user_id, ts, event_id, event_type,
         CASE WHEN lag(ts) OVER w IS NULL OR ts > lag(ts) OVER w + INTERVAL '6' HOUR THEN 1 ELSE 0 END AS ns
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
ev_k AS (
  SELECT *, sum(ns) OVER (PARTITION BY user_id ORDER BY ts, event_id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM ev_g),
sess AS (
  SELECT user_id, sid, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_events,
         date_diff('microsecond', min(ts), max(ts)) AS duration_us
  FROM ev_k GROUP BY user_id, sid),
beh_s AS (
  SELECT user_id, count(*) AS n_sessions, avg(duration_us) / 60e6 AS avg_session_duration,
         avg(n_events::DOUBLE) AS pages_per_session,
         count_if(n_events = 1) / count(*) AS bounce_rate
  FROM sess GROUP BY user_id),
beh_e AS (
  SELECT user_id, count(*) AS n_events, count_if(event_type = 'purchase') AS purchases,
         count_if(event_type = 'view') AS views, count_if(event_type = 'click') / count(*) AS email_open_rate,
         count_if(event_type = 'signup') AS social_media_engagement,
         count_if(event_type = 'error') AS support_tickets,
         count(DISTINCT event_type) AS product_categories_visited
  FROM events GROUP BY user_id),
behavior AS (
  SELECT e.user_id AS customer_id, e.n_events, s.n_sessions, s.avg_session_duration, s.pages_per_session,
         s.bounce_rate,
         1.0::DOUBLE - CASE WHEN purchases + views = 0 THEN NULL
                            ELSE purchases::DOUBLE / (purchases + views)::DOUBLE END AS cart_abandonment_rate,
         e.email_open_rate, e.social_media_engagement, e.support_tickets, e.product_categories_visited
  FROM beh_e e JOIN beh_s s USING (user_id)),
beh AS (
  SELECT *, CASE WHEN engagement_score - support_tickets * 0.5 IS NULL THEN NULL
                 ELSE greatest(0.0, engagement_score - support_tickets * 0.5) END AS satisfaction_score,
         product_categories_visited / 8.0::DOUBLE AS interest_diversity,
         cart_abandonment_rate * 0.4 + bounce_rate * 0.3 + (1.0::DOUBLE - email_open_rate) * 0.2
           + (support_tickets / 5.0::DOUBLE) * 0.1 AS churn_risk_score
  FROM (SELECT *, avg_session_duration * 0.3 + pages_per_session * 0.2 + (1.0::DOUBLE - bounce_rate) * 0.2
                  + email_open_rate * 0.2 + social_media_engagement * 0.1 AS engagement_score FROM behavior))
"""

CUST = f"""
first_order AS (SELECT o_custkey AS customer_id, min(o_orderdate) AS registration_date FROM orders GROUP BY 1),
customers AS (
  SELECT c.c_custkey AS customer_id, CAST(18 + c.c_custkey % 70 AS INTEGER) AS age,
         c.c_mktsegment AS gender, n.n_name AS city, f.registration_date
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN first_order f ON f.customer_id = c.c_custkey),
cust_feat0 AS (
  SELECT *, CAST(date_diff('day', registration_date, {AS_OF_ORDERS}) AS INTEGER) AS days_since_registration,
         CASE WHEN age > 0 AND age <= 25 THEN '18-25' WHEN age > 25 AND age <= 35 THEN '26-35'
              WHEN age > 35 AND age <= 50 THEN '36-50' WHEN age > 50 AND age <= 65 THEN '51-65'
              WHEN age > 65 AND age <= 100 THEN '65+' END AS age_group,
         CAST(dense_rank() OVER (ORDER BY gender) - 1 AS INTEGER) AS gender_encoded,
         CAST(dense_rank() OVER (ORDER BY city) - 1 AS INTEGER) AS city_encoded
  FROM customers),
cust_feat AS (
  SELECT *, CASE WHEN max(days_since_registration) OVER () = 0 THEN NULL
                 ELSE days_since_registration::DOUBLE / (max(days_since_registration) OVER ())::DOUBLE
            END AS loyalty_score
  FROM cust_feat0)
"""

NUM = ["age", "days_since_registration", "loyalty_score", "recency_days", "frequency", "monetary_total",
       "monetary_avg", "rfm_score", "engagement_score", "satisfaction_score", "interest_diversity",
       "churn_risk_score"]

JOINED = f"""
joined AS (
  SELECT cf.customer_id, cf.age, cf.days_since_registration, cf.loyalty_score, cf.gender_encoded, cf.city_encoded,
         r.recency_days, r.frequency, r.monetary_total, r.monetary_avg, r.rfm_score, r.customer_segment,
         b.engagement_score, b.satisfaction_score, b.interest_diversity, b.churn_risk_score,
         CASE WHEN coalesce(b.churn_risk_score > 0.6, false)::INT + coalesce(r.recency_days > 90, false)::INT
                   + coalesce(r.rfm_score < 2.0, false)::INT >= 2 THEN 1 ELSE 0 END AS target_churn
  FROM cust_feat cf LEFT JOIN rfm r ON r.customer_id = cf.customer_id
  LEFT JOIN beh b ON b.customer_id = cf.customer_id),
filled AS (
  SELECT customer_id, gender_encoded, city_encoded, customer_segment, target_churn,
         {', '.join(f'coalesce({c}, 0)::DOUBLE AS {c}' for c in NUM)}
  FROM joined),
scaled AS (
  SELECT customer_id, gender_encoded, city_encoded, customer_segment, target_churn,
         {', '.join(f"({c} - avg({c}) OVER ()) / CASE WHEN coalesce(stddev_pop({c}) OVER (), 0) = 0 THEN 1.0 ELSE stddev_pop({c}) OVER () END AS {c}" for c in NUM)}
  FROM filled)
"""

ONE_HOT = ", ".join(f"coalesce(customer_segment = '{s}', false) AS \"segment_{s}\"" for s in SEGS)

SEGCUST = """
seg_cust AS (
  SELECT r.customer_id, r.rfm_score, r.recency_days, r.frequency, r.monetary_total, r.monetary_avg,
         r.customer_segment AS segment, b.churn_risk_score AS churn_risk, b.satisfaction_score,
         b.interest_diversity
  FROM rfm r LEFT JOIN beh b ON b.customer_id = r.customer_id)
"""

SEG_INSIGHTS = f"""
segs AS (SELECT * FROM (VALUES {', '.join(f"({i}, '{s}')" for i, s in enumerate(SEGS))}) t(segment_order, segment)),
seg_agg AS (
  SELECT segment, count(*) AS n, avg(rfm_score) AS rfm, avg(monetary_total) AS mon, avg(frequency) AS freq,
         avg(recency_days) AS rec, avg(churn_risk) AS churn, avg(satisfaction_score) AS sat
  FROM seg_cust GROUP BY segment),
seg_ins AS (
  SELECT s.segment_order, s.segment, coalesce(a.n, 0) AS count,
         {R('coalesce(a.n, 0)::DOUBLE / (SELECT count(*) FROM seg_cust)::DOUBLE * 100', 2)} AS percentage,
         {R('a.rfm', 2)} AS avg_rfm_score, {R('a.mon', 2)} AS avg_monetary, {R('a.freq', 2)} AS avg_frequency,
         {R('a.rec', 1)} AS avg_recency, {R('a.churn', 3)} AS churn_risk, {R('a.sat', 1)} AS satisfaction
  FROM segs s LEFT JOIN seg_agg a USING (segment))
"""

LOG = """
plog AS (
  SELECT event_id AS prediction_id, ts, event_type AS model_name,
         CASE WHEN value > 50 THEN 1 ELSE 0 END AS prediction,
         0.5 + 0.5 * least(value, 100.0) / 100.0 AS confidence, value AS processing_time
  FROM events)
"""

HOURLY = LOG + """,
ph AS (
  SELECT date_trunc('hour', ts) AS hour_ts, count(*) AS c, sum(prediction) AS p, avg(confidence) AS avg_confidence,
         avg(processing_time) AS processing_time FROM plog GROUP BY 1),
grid AS (
  SELECT unnest(generate_series(min(date_trunc('hour', ts)), max(date_trunc('hour', ts)), INTERVAL 1 HOUR)) AS hour_ts
  FROM plog),
hourly AS (
  SELECT g.hour_ts, coalesce(c, 0) AS predictions_count, coalesce(p, 0)::BIGINT AS positive_predictions,
         coalesce(c, 0) - coalesce(p, 0)::BIGINT AS negative_predictions, avg_confidence, processing_time,
         CASE WHEN coalesce(c, 0) = 0 THEN NULL ELSE coalesce(p, 0)::DOUBLE / c::DOUBLE END AS positive_rate
  FROM grid g LEFT JOIN ph USING (hour_ts))
"""

HEATMAP = """
heat AS (
  SELECT dayname(hour_ts) AS day_of_week,
         CASE WHEN hour(hour_ts) > 0 AND hour(hour_ts) <= 6 THEN 'Night'
              WHEN hour(hour_ts) > 6 AND hour(hour_ts) <= 12 THEN 'Morning'
              WHEN hour(hour_ts) > 12 AND hour(hour_ts) <= 18 THEN 'Afternoon'
              WHEN hour(hour_ts) > 18 AND hour(hour_ts) <= 24 THEN 'Evening' END AS hour_group,
         avg_confidence
  FROM hourly),
heatmap AS (SELECT day_of_week, hour_group, avg(avg_confidence) AS avg_confidence
            FROM heat WHERE hour_group IS NOT NULL GROUP BY 1, 2)
"""

PROFILE = f"""
profile AS (
  SELECT CAST(hour(hour_ts) AS INTEGER) AS hour, {R('avg(predictions_count)', 2)} AS predictions_count,
         {R('avg(positive_rate)', 2)} AS positive_rate, {R('avg(avg_confidence)', 2)} AS avg_confidence
  FROM hourly GROUP BY 1)
"""

SCORED = """
scored AS (
  SELECT m.model_name, m.model_seq, d.doc_id, l.quality AS label,
         CASE m.model_name
           WHEN 'length' THEN d.n_chars / (d.n_chars + 1000.0::DOUBLE)
           WHEN 'alpha_share' THEN length(regexp_replace(d.text, '[^A-Za-z]', '', 'g'))::DOUBLE
                                   / greatest(length(d.text), 1)::DOUBLE
           ELSE 1.0::DOUBLE - length(regexp_replace(d.text, '[^A-Z]', '', 'g'))::DOUBLE
                              / greatest(length(d.text), 1)::DOUBLE END AS score
  FROM documents d JOIN labels l USING (doc_id)
  CROSS JOIN (VALUES ('length', 0), ('alpha_share', 1), ('upper_free_share', 2)) m(model_name, model_seq)),
scored_p AS (SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction FROM scored),
cm AS (
  SELECT model_name, min(model_seq) AS model_seq, count(*) AS n,
         count_if(label = 1 AND prediction = 1) AS tp, count_if(label = 0 AND prediction = 1) AS fp,
         count_if(label = 1 AND prediction = 0) AS fn, count_if(label = 0 AND prediction = 0) AS tn
  FROM scored_p GROUP BY model_name),
auc_g AS (SELECT model_name, score, count_if(label = 1) AS p, count_if(label = 0) AS n
          FROM scored_p GROUP BY model_name, score),
auc_w AS (SELECT model_name, p, n,
                 coalesce(sum(n) OVER (PARTITION BY model_name ORDER BY score
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b
          FROM auc_g),
auc AS (SELECT model_name, CASE WHEN sum(p) * sum(n) = 0 THEN NULL
                                ELSE sum(p * (b + n / 2.0))::DOUBLE / (sum(p) * sum(n))::DOUBLE END AS roc_auc
        FROM auc_w GROUP BY model_name),
perf AS (
  SELECT cm.model_name, cm.model_seq, cm.n,
         CASE WHEN n = 0 THEN 0.0 ELSE (tp + tn)::DOUBLE / n::DOUBLE END AS accuracy,
         CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp::DOUBLE / (tp + fp)::DOUBLE END AS precision,
         CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp::DOUBLE / (tp + fn)::DOUBLE END AS recall,
         CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE (2 * tp)::DOUBLE / (2 * tp + fp + fn)::DOUBLE END AS f1,
         auc.roc_auc
  FROM cm LEFT JOIN auc USING (model_name))
"""

DAILY_ALL = """
daily_all AS (SELECT CAST(ts AS DATE) AS day, avg(confidence) AS daily_accuracy, count(*) AS daily_volume
              FROM plog GROUP BY 1),
trend_all AS (
  SELECT avg(CASE WHEN a <= 7 THEN daily_accuracy END) AS first_mean,
         avg(CASE WHEN d <= 7 THEN daily_accuracy END) AS last_mean
  FROM (SELECT *, row_number() OVER (ORDER BY day) AS a, row_number() OVER (ORDER BY day DESC) AS d FROM daily_all)),
trend_all2 AS (SELECT last_mean - first_mean AS accuracy_trend,
                      CASE WHEN last_mean < first_mean THEN 'declining' ELSE 'stable' END AS trend_accuracy
               FROM trend_all)
"""

PERF_REPORT = f"""
best AS (SELECT model_name AS best_model, roc_auc AS best_roc_auc FROM perf
         ORDER BY coalesce(roc_auc, 0.0) DESC, model_seq ASC LIMIT 1),
report0 AS (
  SELECT b.best_model, b.best_roc_auc, (SELECT count(*) FROM perf) AS models_compared,
         {R('(b.best_roc_auc - 0.85) * 100', 2)} AS vs_baseline,
         {R('(b.best_roc_auc - (SELECT min(roc_auc) FROM perf)) * 100', 2)} AS vs_worst,
         t.trend_accuracy, (SELECT avg(confidence) FROM plog) AS avg_confidence
  FROM best b CROSS JOIN trend_all2 t),
report AS (
  SELECT best_model, {R('best_roc_auc', 4)} AS best_roc_auc, models_compared, vs_baseline, vs_worst, trend_accuracy,
         {R('avg_confidence', 3)} AS avg_confidence,
         CAST(coalesce(trend_accuracy = 'declining', false)::INT + coalesce(avg_confidence < 0.8, false)::INT
              + coalesce(vs_baseline > 10, false)::INT AS INTEGER) AS recommendations_count,
         CAST(coalesce(trend_accuracy = 'declining', false)::INT AS INTEGER) AS high_priority_issues,
         avg_confidence AS raw_conf
  FROM report0)
"""

ALERTS = f"""
dv AS (SELECT CAST(ts AS DATE) AS day, count(*) AS v FROM plog GROUP BY 1),
alert_m AS (
  SELECT (SELECT avg(churn_risk) FROM seg_cust) AS avg_churn_risk,
         (SELECT avg(confidence) FROM plog) AS avg_confidence,
         (SELECT accuracy_trend FROM trend_all2) AS accuracy_trend,
         (SELECT max(CASE WHEN day = (SELECT max(day) FROM dv) THEN v END)::DOUBLE
                 / avg(CASE WHEN day < (SELECT max(day) FROM dv) THEN v END) FROM dv) AS volume_ratio,
         (SELECT count_if(segment = 'Loyal Customers' AND interest_diversity < 0.5) FROM seg_cust)::DOUBLE
           AS opportunity_customers,
         (SELECT count_if(churn_risk > 0.7) FROM seg_cust) AS affected_customers,
         (SELECT coalesce(sum(CASE WHEN churn_risk > 0.7 THEN monetary_total END), 0.0) FROM seg_cust)
           AS estimated_revenue_impact,
         (SELECT coalesce(sum(CASE WHEN segment = 'Loyal Customers' AND interest_diversity < 0.5
                                   THEN monetary_avg END), 0.0) FROM seg_cust) AS potential_revenue),
rules AS (SELECT * FROM (VALUES
    (1, 'churn_risk', 'avg_churn_risk', '>', 0.7::DOUBLE, 'high', 'High Churn Risk Detected'),
    (2, 'model_confidence', 'avg_confidence', '<', 0.75::DOUBLE, 'medium', 'Low Model Confidence'),
    (3, 'performance_decline', 'accuracy_trend', '<', -0.05::DOUBLE, 'high', 'Model Performance Declining'),
    (4, 'volume_spike', 'volume_ratio', '>', 1.5::DOUBLE, 'medium', 'Unusual Prediction Volume'),
    (5, 'business_opportunity', 'opportunity_customers', '>', 0.0::DOUBLE, 'low', 'Business Opportunity: Cross Sell'))
  t(rule_no, type, metric, op, threshold, severity, title)),
mlong AS (
  SELECT 'avg_churn_risk' AS metric, avg_churn_risk::DOUBLE AS value, * FROM alert_m UNION ALL
  SELECT 'avg_confidence', avg_confidence::DOUBLE, * FROM alert_m UNION ALL
  SELECT 'accuracy_trend', accuracy_trend::DOUBLE, * FROM alert_m UNION ALL
  SELECT 'volume_ratio', volume_ratio::DOUBLE, * FROM alert_m UNION ALL
  SELECT 'opportunity_customers', opportunity_customers::DOUBLE, * FROM alert_m),
alerts AS (
  SELECT printf('ALERT_%03d', r.rule_no) AS alert_id, r.rule_no, r.type, r.severity, r.title, r.metric,
         {R6('m.value')} AS metric_value, r.threshold,
         CASE WHEN r.type = 'churn_risk' THEN m.affected_customers END AS affected_customers,
         CASE WHEN r.type = 'churn_risk' THEN {R('m.estimated_revenue_impact', 2)} END AS estimated_revenue_impact,
         CASE WHEN r.type = 'business_opportunity' THEN CAST(m.value AS BIGINT) END AS opportunity_size,
         CASE WHEN r.type = 'business_opportunity' THEN {R('m.potential_revenue', 2)} END AS potential_revenue
  FROM mlong m JOIN rules r USING (metric)
  WHERE coalesce(CASE WHEN r.op = '>' THEN m.value > r.threshold WHEN r.op = '<' THEN m.value < r.threshold END,
                 false))
"""

ROI = """
roi_t AS (SELECT (SELECT sum(l_extendedprice * l_discount) FROM lineitem) AS C,
                 (SELECT sum(units * unit_value) FROM (
                     SELECT count(*) AS units, avg(l_extendedprice * (1.0 - l_discount)) AS unit_value
                     FROM lineitem GROUP BY l_linestatus)) AS B)
"""

LINES_DEDUPE = """
dd AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                 ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS rn
    FROM lineitem) WHERE rn = 1)
"""

LINE_T = """
line_t AS (SELECT quantile_cont(l_extendedprice, 0.99) AS ta, quantile_cont(l_quantity, 0.95) AS tq FROM lineitem)
"""

DRIFT_COLS = ["recent_positive_rate", "recent_avg_confidence", "historical_positive_rate",
              "historical_avg_confidence", "positive_rate_drift", "confidence_drift"]


DRIFT_ROWS = """
, r AS (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY ts DESC, prediction_id DESC) AS rn FROM plog),
d0 AS (
  SELECT model_name, count(*) AS n_predictions,
         avg(CASE WHEN rn <= 100 THEN prediction END) AS rp, avg(CASE WHEN rn <= 100 THEN confidence END) AS rc,
         avg(CASE WHEN rn > 100 THEN prediction END) AS hp, avg(CASE WHEN rn > 100 THEN confidence END) AS hc
  FROM r GROUP BY model_name),
d1 AS (
  SELECT model_name, n_predictions, CASE WHEN n_predictions >= 100 THEN 'success' ELSE 'warning' END AS status,
         CASE WHEN n_predictions >= 100 THEN rp END AS recent_positive_rate,
         CASE WHEN n_predictions >= 100 THEN rc END AS recent_avg_confidence,
         CASE WHEN n_predictions >= 100 THEN hp END AS historical_positive_rate,
         CASE WHEN n_predictions >= 100 THEN hc END AS historical_avg_confidence
  FROM d0),
d2 AS (SELECT *, abs(recent_positive_rate - historical_positive_rate) AS positive_rate_drift,
              abs(recent_avg_confidence - historical_avg_confidence) AS confidence_drift FROM d1),
d3 AS (SELECT *, coalesce(positive_rate_drift > 0.1 OR confidence_drift > 0.1, false) AS det FROM d2)
SELECT model_name, n_predictions, status, """ + ", ".join(f"{R6(c)} AS {c}" for c in DRIFT_COLS) + """,
       CASE WHEN n_predictions >= 100 THEN det END AS drift_detected,
       CASE WHEN n_predictions < 100 THEN NULL WHEN det AND positive_rate_drift > 0.2 THEN 'high'
            WHEN det THEN 'medium' ELSE 'low' END AS drift_severity
FROM d3"""

DRIFT_ADVICE = """
, r AS (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY ts DESC, prediction_id DESC) AS rn FROM plog),
d AS (
  SELECT model_name, count(*) AS n,
         avg(CASE WHEN rn <= 100 THEN prediction END) AS rp, avg(CASE WHEN rn <= 100 THEN confidence END) AS rc,
         avg(CASE WHEN rn > 100 THEN prediction END) AS hp, avg(CASE WHEN rn > 100 THEN confidence END) AS hc
  FROM r GROUP BY model_name),
f AS (SELECT model_name, n >= 100 AND coalesce(abs(rp - hp) > 0.1 OR abs(rc - hc) > 0.1, false) AS det,
             CASE WHEN n >= 100 THEN rc END AS rc FROM d)
SELECT model_name, 'Model drift detected - consider retraining' AS recommendation FROM f WHERE det
UNION ALL SELECT model_name, 'Investigate data quality changes' FROM f WHERE det
UNION ALL SELECT model_name, 'Review feature distribution shifts' FROM f WHERE det
UNION ALL SELECT model_name, 'Low confidence scores - consider model ensemble' FROM f WHERE rc < 0.7"""

SHIFTING_LOG = """
plog AS (
  SELECT event_id AS prediction_id, ts, event_type AS model_name,
         CASE WHEN value > day(ts) * 4.0::DOUBLE THEN 1 ELSE 0 END AS prediction,
         CASE WHEN event_id % 7 <> 0 THEN 1.0::DOUBLE - day(ts) / 60.0::DOUBLE END AS confidence FROM events)
"""

HOLDERS = """
holders AS (
  SELECT c_custkey AS customer_id, CAST(c_custkey % 120 AS INTEGER) AS age,
         lower(n_name || '''s o''er-' || c_mktsegment) AS city, n_name, c_mktsegment, c_acctbal AS amount
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)
"""


# Profiles from views and errors only.
BROWSING = "browsing AS (SELECT * FROM events WHERE event_type IN ('view', 'error')),"
BROWSING_BEH = BROWSING + BEH.replace("FROM events", "FROM browsing")
BROWSING_BEFORE_BEH = BROWSING_BEH.replace("'error')", "'error') AND ts < TIMESTAMP '2024-01-10'", 1)

# The shifting log with the last day's rows three times.
BURSTING_LOG = SHIFTING_LOG.replace("FROM events", "FROM events CROSS JOIN range(1, 4) copies(n) "
                                                   "WHERE n = 1 OR CAST(ts AS DATE) = DATE '2024-01-30'")


def _w(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


ORACLE_SQL: dict[str, str] = {
    "rfm_features": _w(RFM) + "SELECT customer_id, recency_days, frequency, monetary_total, monetary_avg, "
                              "monetary_std, recency_score, frequency_score, monetary_score, rfm_score, "
                              "customer_segment FROM rfm",
    "stream_rollup": _w(LOG) + f"""
    SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, model_name,
           count(*) AS predictions_count, sum(prediction)::BIGINT AS positive_predictions,
           count(*) - sum(prediction)::BIGINT AS negative_predictions, {R6('avg(confidence)')} AS avg_confidence,
           {R6('avg(processing_time)')} AS processing_time,
           {R6('sum(prediction)::DOUBLE / count(*)::DOUBLE')} AS positive_rate
    FROM plog GROUP BY 1, 2, 3""",
    "stream_drift": _w(LOG) + f""", base AS (
      SELECT model_name, avg(prediction::DOUBLE) AS bp, avg(confidence) AS bc FROM plog
      WHERE ts < TIMESTAMP '2024-01-10' GROUP BY 1),
    win AS (
      SELECT time_bucket(INTERVAL 6 HOUR, ts) - k * INTERVAL 6 HOUR AS window_start, model_name, count(*) AS n,
             avg(prediction::DOUBLE) AS p, avg(confidence) AS c
      FROM plog CROSS JOIN (VALUES (0), (1), (2), (3)) v(k) WHERE ts >= TIMESTAMP '2024-01-10' GROUP BY 1, 2),
    d AS (SELECT *, abs(p - bp) AS pd, abs(c - bc) AS cd FROM win JOIN base USING (model_name))
    SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, model_name, n, {R6('pd')} AS positive_rate_drift,
           {R6('cd')} AS confidence_drift, pd > 0.1 OR cd > 0.1 AS drift_detected,
           CASE WHEN (pd > 0.1 OR cd > 0.1) AND pd > 0.2 THEN 'high' WHEN pd > 0.1 OR cd > 0.1 THEN 'medium'
                ELSE 'low' END AS drift_severity
    FROM d""",
    "stream_alerts": _w(RFM, BROWSING_BEFORE_BEH, SEGCUST, SHIFTING_LOG) + f""", hist AS (
      SELECT avg(n) AS base FROM (SELECT count(*) AS n FROM plog WHERE ts < TIMESTAMP '2024-01-10'
                                  GROUP BY date_trunc('hour', ts))),
    later AS (SELECT ts, confidence * 0.99::DOUBLE AS confidence FROM plog WHERE ts >= TIMESTAMP '2024-01-10'),
    hours AS (SELECT date_trunc('hour', ts) AS window_start, avg(confidence) AS c, count(*) / (SELECT base FROM hist) AS r
              FROM later GROUP BY 1),
    days AS (SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS window_start, avg(confidence) AS acc FROM later GROUP BY 1),
    trend AS (SELECT window_start, avg(acc) OVER (ORDER BY window_start ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
                       - avg(CASE WHEN nth <= 7 THEN acc END) OVER (ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS t
              FROM (SELECT *, row_number() OVER (ORDER BY window_start) AS nth FROM days)),
    active AS (SELECT DISTINCT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS window_start, user_id AS customer_id
               FROM events WHERE ts >= TIMESTAMP '2024-01-10'),
    crowd AS (SELECT window_start, avg(churn_risk) AS churn,
                     count_if(segment = 'Loyal Customers' AND interest_diversity < 0.5)::DOUBLE AS chances
              FROM active JOIN seg_cust USING (customer_id) GROUP BY 1)
    SELECT window_start, CAST(2 AS INTEGER) AS rule_no, 'model_confidence' AS type, 'medium' AS severity,
           'Low Model Confidence' AS title, {R('c', 9)} AS value, 0.75::DOUBLE AS threshold FROM hours WHERE c < 0.75
    UNION ALL
    SELECT window_start, 4, 'volume_spike', 'medium', 'Unusual Prediction Volume', {R('r', 9)}, 1.5::DOUBLE
    FROM hours WHERE r > 1.5
    UNION ALL
    SELECT window_start, 3, 'performance_decline', 'high', 'Model Performance Declining', {R('t', 9)}, -0.05::DOUBLE
    FROM trend WHERE t < -0.05
    UNION ALL
    SELECT window_start, 1, 'churn_risk', 'high', 'High Churn Risk Detected', {R('churn', 9)}, 0.7::DOUBLE
    FROM crowd WHERE churn > 0.7
    UNION ALL
    SELECT window_start, 5, 'business_opportunity', 'low', 'Business Opportunity: Cross Sell', chances, 0.0::DOUBLE
    FROM crowd WHERE chances > 0""",
    "stream_drift_last_rows": _w(SHIFTING_LOG) + DRIFT_ROWS,
    "stream_rfm": f"""
    SELECT o_custkey AS customer_id, max(o_orderdate) AS last_purchase, count(*) AS frequency,
           {R('sum(o_totalprice)', 2)} AS monetary_total FROM orders GROUP BY 1""",
    "stream_sessions": _w(BEH) + "SELECT user_id, session_start, session_end, n_events FROM sess",
    "stream_dedupe": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    "stratified_split": _w(RFM, BEH, CUST, JOINED) + """, sh AS (
      SELECT customer_id, target_churn::DOUBLE AS label, substr(md5(customer_id::VARCHAR || ':36'), 1, 13) AS h1,
             substr(md5(customer_id::VARCHAR || ':37'), 1, 13) AS h2 FROM joined),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h1, customer_id) - 1 AS r,
                      count(*) OVER (PARTITION BY label) AS n FROM sh),
    cut AS (SELECT *, CASE WHEN r < floor(n * 0.8::DOUBLE + 0.5) THEN 'train' ELSE 'test' END AS split FROM ranked)
    SELECT customer_id, label, split,
           CAST((row_number() OVER (PARTITION BY label, split ORDER BY h2, customer_id) - 1) % 5 AS INTEGER) AS fold
    FROM cut""",
    "rfm_aggregate": _w(RFM) + "SELECT * FROM rfm_a",
    "rfm_scores": _w(RFM) + "SELECT customer_id, recency_score, frequency_score, monetary_score FROM rfm",
    "rfm_segments": _w(RFM) + "SELECT customer_id, rfm_score, customer_segment FROM rfm",
    "segment_distribution": _w(RFM) + "SELECT customer_segment, count(*) AS count FROM rfm "
                                      "WHERE customer_segment IS NOT NULL GROUP BY 1",
    "clean_dedupe": _w(LINES_DEDUPE) + "SELECT * FROM dd",
    "clean_transactions": _w(LINES_DEDUPE) + "SELECT * FROM dd WHERE l_extendedprice > 0 AND l_quantity > 0",
    "clean_report": _w(LINES_DEDUPE, CUST) + """
SELECT 'transactions' AS dataset, (SELECT count(*) FROM lineitem) AS original_rows,
       (SELECT count(*) FROM dd WHERE l_extendedprice > 0 AND l_quantity > 0) AS cleaned_rows,
       (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM dd WHERE l_extendedprice > 0 AND l_quantity > 0)
         AS removed_rows
UNION ALL
SELECT 'customers', (SELECT count(*) FROM customers),
       (SELECT count(DISTINCT customer_id) FILTER (WHERE age BETWEEN 18 AND 100) FROM customers),
       (SELECT count(*) FROM customers)
         - (SELECT count(DISTINCT customer_id) FILTER (WHERE age BETWEEN 18 AND 100) FROM customers)""",
    "anomaly_counts": _w(LINE_T) + f"""
SELECT count(*) AS total_records, count_if(l_extendedprice > ta) AS high_amount_count,
       count_if(l_quantity > tq) AS high_quantity_count, {R6('max(ta)')} AS high_amount_threshold,
       {R6('max(tq)')} AS high_quantity_threshold
FROM lineitem CROSS JOIN line_t""",
    "reject_table": """
SELECT CASE WHEN event_id % 7 = 0 THEN left(line, length(line) - 1) ELSE line END AS record,
       CASE WHEN event_id % 7 = 0 OR event_type = 'error' THEN 'malformed' WHEN floor(value) < 1 THEN 'value_below_one' END AS reason
FROM (SELECT *, '{"event_id":' || event_id || ',"ts":"' || CASE WHEN event_type = 'error' THEN 'not a time'
      ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END || '","value":' || floor(value)::BIGINT || '}' AS line FROM events)""",
    "score_calibration": _w(SCORED, """
stat AS (SELECT model_name, avg(score) AS mean, stddev_pop(score) AS std, sum(label) AS n1, count(*) - sum(label) AS n0
         FROM scored GROUP BY model_name),
zs AS (SELECT model_name, (score - mean) / std AS z, CASE WHEN label = 1 THEN (n1 + 1.0::DOUBLE) / (n1 + 2) ELSE 1.0::DOUBLE / (n0 + 2) END AS t
       FROM scored JOIN stat USING (model_name)),
newton AS (
  SELECT model_name, 0 AS i, 0.0::DOUBLE AS a, 0.0::DOUBLE AS b FROM stat
  UNION ALL
  SELECT model_name, i + 1, a - (hbb * ga - hab * gb) / (haa * hbb - hab * hab), b - (haa * gb - hab * ga) / (haa * hbb - hab * hab)
  FROM (SELECT model_name, i, a, b, sum((p - t) * z) AS ga, sum(p - t) AS gb, sum(p * (1 - p) * z * z) AS haa,
               sum(p * (1 - p) * z) AS hab, sum(p * (1 - p)) AS hbb
        FROM (SELECT n.*, zs.z, zs.t, 1 / (1 + exp(-(n.a * zs.z + n.b))) AS p FROM newton n JOIN zs USING (model_name) WHERE n.i < 20)
        GROUP BY model_name, i, a, b)),
curve AS (SELECT model_name, a / std AS slope, b - a / std * mean AS intercept FROM newton JOIN stat USING (model_name) WHERE i = 20),
prob AS (SELECT *, 1 / (1 + exp(-(slope * score + intercept))) AS p FROM scored JOIN curve USING (model_name))
""").replace("WITH ", "WITH RECURSIVE ", 1) + f"""
SELECT model_name, least(floor(p * 10), 9)::INTEGER AS bin, count(*) AS n, {R6('avg(p)')} AS mean_probability,
       {R6('avg(label::DOUBLE)')} AS observed_rate, {R6('avg((p - label) * (p - label))')} AS brier,
       {R('max(slope)', 4)} AS slope, {R('max(intercept)', 4)} AS intercept FROM prob GROUP BY 1, 2""",
    "anomaly_rows": _w(LINE_T) + """
SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity, l_extendedprice > ta AS amount_anomaly,
       l_quantity > tq AS quantity_anomaly
FROM lineitem CROSS JOIN line_t WHERE l_extendedprice > ta OR l_quantity > tq""",
    "fk_orphans": """
SELECT count(*) AS total_rows, count_if(c.c_custkey IS NULL) AS orphan_rows
FROM orders o LEFT JOIN (SELECT DISTINCT c_custkey FROM customer) c ON o.o_custkey = c.c_custkey""",
    "tenure": _w(CUST) + "SELECT customer_id, registration_date, days_since_registration FROM cust_feat",
    "label_encode": _w(CUST) + "SELECT customer_id, city, city_encoded FROM cust_feat",
    "customer_features": _w(CUST) + f"""
SELECT customer_id, age, gender, city, registration_date, days_since_registration, age_group, gender_encoded,
       city_encoded, {R6('loyalty_score')} AS loyalty_score FROM cust_feat""",
    "banding": """
SELECT p_partkey, p_size,
       CASE WHEN p_size > 0 AND p_size <= 25 THEN '18-25' WHEN p_size > 25 AND p_size <= 35 THEN '26-35'
            WHEN p_size > 35 AND p_size <= 50 THEN '36-50' WHEN p_size > 50 AND p_size <= 65 THEN '51-65'
            WHEN p_size > 65 AND p_size <= 100 THEN '65+' END AS size_band
FROM part""",
    "sessions": _w(BEH) + "SELECT user_id, session_start, session_end, n_events FROM sess",
    "user_behavior": _w(BEH) + f"""
SELECT customer_id, n_events, n_sessions, {R6('avg_session_duration')} AS avg_session_duration,
       {R6('pages_per_session')} AS pages_per_session, {R6('bounce_rate')} AS bounce_rate,
       {R6('cart_abandonment_rate')} AS cart_abandonment_rate, {R6('email_open_rate')} AS email_open_rate,
       social_media_engagement, support_tickets, product_categories_visited FROM behavior""",
    "behavioral_features": _w(BEH) + f"""
SELECT customer_id, {R6('engagement_score')} AS engagement_score, {R6('satisfaction_score')} AS satisfaction_score,
       {R6('interest_diversity')} AS interest_diversity, {R6('churn_risk_score')} AS churn_risk_score FROM beh""",
    "overall_metrics": _w(RFM, BEH, SEGCUST) + f"""
SELECT count(*) AS total_customers, {R('avg(monetary_total)', 2)} AS avg_customer_value,
       {R('avg(frequency)', 1)} AS avg_purchase_frequency, {R('avg(churn_risk)', 3)} AS overall_churn_risk,
       {R('avg(satisfaction_score)', 1)} AS customer_satisfaction FROM seg_cust""",
    "join_features": _w(RFM, BEH, CUST, JOINED) + f"""
SELECT customer_id, days_since_registration, recency_days, frequency, rfm_score, customer_segment,
       {R6('engagement_score')} AS engagement_score, {R6('churn_risk_score')} AS churn_risk_score FROM joined""",
    "churn_label": _w(RFM, BEH, CUST, JOINED) + "SELECT customer_id, target_churn FROM joined",
    "target_distribution": _w(RFM, BEH, CUST, JOINED) + "SELECT target_churn, count(*) AS count FROM joined GROUP BY 1",
    "scaled_features": _w(RFM, BEH, CUST, JOINED) + "SELECT customer_id, "
                       + ", ".join(f"{R6(c)} AS {c}" for c in NUM) + " FROM scaled",
    "one_hot": _w(RFM, BEH, CUST, JOINED) + f"SELECT customer_id, {ONE_HOT} FROM scaled",
    "ml_dataset": _w(RFM, BEH, CUST, JOINED) + "SELECT " + ", ".join(f"{R6(c)} AS {c}" for c in NUM)
                  + f", gender_encoded, city_encoded, target_churn, customer_id, {ONE_HOT} FROM scaled",
    "segment_insights": _w(RFM, BEH, SEGCUST, SEG_INSIGHTS) + "SELECT * EXCLUDE (segment_order) FROM seg_ins",
    "top_insights": _w(RFM, BEH, SEGCUST, SEG_INSIGHTS) + """
SELECT * FROM (SELECT 'revenue' AS insight_type, segment, avg_monetary AS value FROM seg_ins
               ORDER BY avg_monetary DESC NULLS LAST, segment_order LIMIT 1)
UNION ALL
SELECT * FROM (SELECT 'risk', segment, churn_risk FROM seg_ins WHERE churn_risk > 0.6
               ORDER BY churn_risk DESC, segment_order LIMIT 1)
UNION ALL
SELECT * FROM (SELECT 'opportunity', segment, avg_frequency FROM seg_ins
               ORDER BY avg_frequency ASC NULLS LAST, segment_order LIMIT 1)""",
    "hourly_rollup": _w(HOURLY) + f"""
SELECT hour_ts, predictions_count, positive_predictions, negative_predictions,
       {R6('avg_confidence')} AS avg_confidence, {R6('processing_time')} AS processing_time,
       {R6('positive_rate')} AS positive_rate FROM hourly""",
    "hourly_profile": _w(HOURLY, PROFILE) + "SELECT * FROM profile",
    "current_stats": _w(HOURLY) + f"""
SELECT CAST(coalesce(sum(CASE WHEN CAST(hour_ts AS DATE) = DATE '2024-01-30' THEN predictions_count END), 0) AS BIGINT)
         AS total_predictions_today,
       {R('avg(CASE WHEN CAST(hour_ts AS DATE) = DATE ' + "'2024-01-30'" + ' THEN avg_confidence END)', 3)}
         AS avg_confidence_today,
       {R('avg(CASE WHEN CAST(hour_ts AS DATE) = DATE ' + "'2024-01-30'" + ' THEN positive_rate END)', 3)}
         AS positive_rate_today,
       {R('avg(processing_time)', 2)} AS avg_processing_time FROM hourly""",
    "confidence_heatmap": _w(HOURLY, HEATMAP) + f"SELECT day_of_week, hour_group, {R6('avg_confidence')} AS avg_confidence FROM heatmap",
    "confidence_histogram": _w(HOURLY) + f"""
, rng AS (SELECT min(avg_confidence) AS lo, max(avg_confidence) AS hi FROM hourly),
binned AS (SELECT CAST(CASE WHEN (hi - lo) / 20.0 = 0 THEN 0
                       ELSE least(floor((avg_confidence - lo) / ((hi - lo) / 20.0)), 19) END AS INTEGER) AS bin, lo, hi
           FROM hourly CROSS JOIN rng WHERE avg_confidence IS NOT NULL)
SELECT bin, {R6('max(lo) + bin * (max(hi) - max(lo)) / 20.0')} AS bin_lo,
       {R6('max(lo) + (bin + 1) * (max(hi) - max(lo)) / 20.0')} AS bin_hi, count(*) AS count
FROM binned GROUP BY bin""",
    "dashboard_summary": _w(HOURLY, HEATMAP, PROFILE) + """
SELECT (SELECT count(*) FROM hourly) AS total_predictions_analyzed,
       (SELECT strftime(min(hour_ts), '%Y-%m-%d') FROM hourly) AS date_from,
       (SELECT strftime(max(hour_ts), '%Y-%m-%d') FROM hourly) AS date_to,
       (SELECT hour FROM profile ORDER BY predictions_count DESC NULLS LAST, hour LIMIT 1) AS peak_hour,
       (SELECT day_of_week FROM heatmap GROUP BY day_of_week ORDER BY avg(avg_confidence) DESC NULLS LAST,
               day_of_week LIMIT 1) AS best_confidence_day""",
    "prediction_summary": _w(LOG) + f"""
SELECT model_name, count(*) AS total_samples, count_if(prediction = 1) AS positive_predictions,
       count_if(prediction <> 1) AS negative_predictions, {R6('avg(prediction::DOUBLE)')} AS positive_rate,
       {R6('avg(confidence)')} AS avg_confidence FROM plog GROUP BY model_name""",
    "realtime_summary": _w(LOG) + f"""
SELECT model_name, total_predictions, duration_seconds,
       {R('CASE WHEN duration_seconds = 0 THEN NULL ELSE total_predictions / duration_seconds END', 2)}
         AS predictions_per_second,
       {R('pr', 4)} AS positive_rate, {R('c', 4)} AS avg_confidence
FROM (SELECT model_name, count(*) AS total_predictions,
             (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS duration_seconds,
             avg(prediction::DOUBLE) AS pr, avg(confidence) AS c FROM plog GROUP BY model_name)""",
    "sample_predictions": _w(LOG) + f"""
SELECT model_name, sample_rank, prediction_id, ts, prediction, {R6('confidence')} AS confidence
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY model_name ORDER BY ts, prediction_id) AS INTEGER)
                  AS sample_rank FROM plog) WHERE sample_rank <= 10""",
    "confidence": f"""
SELECT event_id AS prediction_id, event_type AS model_name, {R6('least(value, 100.0) / 100.0')} AS prob_positive,
       {R6('greatest(1.0 - least(value, 100.0) / 100.0, least(value, 100.0) / 100.0)')} AS confidence
FROM events""",
    "binary_metrics": _w(SCORED) + f"""
SELECT model_name, n, {R('accuracy', 4)} AS accuracy, {R('precision', 4)} AS precision, {R('recall', 4)} AS recall,
       {R('f1', 4)} AS f1 FROM perf""",
    "roc_auc": _w(SCORED) + f"SELECT model_name, {R6('roc_auc')} AS roc_auc FROM auc",
    "confusion_matrix": _w(SCORED) + """
SELECT model_name, tn AS true_negative, fp AS false_positive, fn AS false_negative, tp AS true_positive FROM cm""",
    "prediction_stats": _w(SCORED) + f"""
SELECT model_name, count_if(prediction = 1) AS positive_predictions, count_if(prediction = 0) AS negative_predictions,
       {R6('avg(prediction::DOUBLE)')} AS positive_rate, {R6('avg(label::DOUBLE)')} AS actual_positive_rate,
       count(*) AS test_samples FROM scored_p GROUP BY model_name""",
    "select_best_model": _w(SCORED) + f"""
SELECT model_name, {R('accuracy', 4)} AS accuracy, {R('precision', 4)} AS precision, {R('recall', 4)} AS recall,
       {R('f1', 4)} AS f1, {R('roc_auc', 4)} AS roc_auc
FROM perf ORDER BY coalesce(roc_auc, 0.0) DESC, model_seq ASC LIMIT 1""",
    "model_comparison": _w(SCORED) + f"""
SELECT model_name, {R('coalesce(accuracy, 0.0)', 4)} AS accuracy, {R('coalesce(f1, 0.0)', 4)} AS f1,
       {R('coalesce(roc_auc, 0.0)', 4)} AS roc_auc,
       model_name = (SELECT model_name FROM perf ORDER BY coalesce(roc_auc, 0.0) DESC, model_seq LIMIT 1) AS is_best
FROM perf""",
    "rule_label": """
WITH e AS (SELECT vec_id, embedding[1]::DOUBLE AS x0, embedding[2]::DOUBLE AS x1, embedding[3]::DOUBLE AS x2
           FROM embeddings),
s AS (SELECT vec_id,
        (x0 - avg(x0) OVER ()) / CASE WHEN coalesce(stddev_pop(x0) OVER (), 0) = 0 THEN 1 ELSE stddev_pop(x0) OVER () END AS x0,
        (x1 - avg(x1) OVER ()) / CASE WHEN coalesce(stddev_pop(x1) OVER (), 0) = 0 THEN 1 ELSE stddev_pop(x1) OVER () END AS x1,
        (x2 - avg(x2) OVER ()) / CASE WHEN coalesce(stddev_pop(x2) OVER (), 0) = 0 THEN 1 ELSE stddev_pop(x2) OVER () END AS x2
      FROM e)
SELECT vec_id, """ + f"{R6('x0')} AS x0, {R6('x1')} AS x1, {R6('x2')} AS x2, " + """
       CAST(((x0 > 0.5 AND x1 < -0.2) OR x2 > 1.0) AS INTEGER) AS rule_label FROM s""",
    "drift": _w(LOG) + DRIFT_ROWS,
    "drift_shifted": _w(SHIFTING_LOG) + DRIFT_ROWS,
    "accuracy_trend": _w(LOG) + f"""
, daily AS (SELECT model_name, CAST(ts AS DATE) AS day, avg(confidence) AS daily_accuracy FROM plog GROUP BY 1, 2),
t AS (SELECT model_name, count(*) AS days,
             avg(CASE WHEN a <= 7 THEN daily_accuracy END) AS first_mean,
             avg(CASE WHEN d <= 7 THEN daily_accuracy END) AS last_mean
      FROM (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY day) AS a,
                      row_number() OVER (PARTITION BY model_name ORDER BY day DESC) AS d FROM daily)
      GROUP BY model_name)
SELECT model_name, days, {R6('first_mean')} AS first_mean, {R6('last_mean')} AS last_mean,
       {R6('last_mean - first_mean')} AS accuracy_trend,
       CASE WHEN last_mean < first_mean THEN 'declining' ELSE 'stable' END AS trend_accuracy FROM t""",
    "kpis": _w(LOG) + f"""
, daily AS (SELECT model_name, CAST(ts AS DATE) AS day, avg(confidence) AS daily_accuracy, count(*) AS daily_volume
            FROM plog GROUP BY 1, 2)
SELECT model_name, {R('avg(CASE WHEN d <= 7 THEN daily_accuracy END)', 3)} AS model_reliability,
       CAST(trunc(avg(daily_volume)) AS BIGINT) AS throughput
FROM (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY day DESC) AS d FROM daily)
GROUP BY model_name""",
    "performance_report": _w(SCORED, LOG, DAILY_ALL, PERF_REPORT) + "SELECT * EXCLUDE (raw_conf) FROM report",
    "performance_recommendations": _w(SCORED, LOG, DAILY_ALL, PERF_REPORT) + """
SELECT 'high' AS priority, 'model_retraining' AS type, 'Model accuracy is declining - schedule retraining' AS description,
       'Prevents further performance degradation' AS impact FROM report WHERE trend_accuracy = 'declining'
UNION ALL SELECT 'medium', 'model_ensemble', 'Consider ensemble methods to improve confidence', 'Higher prediction reliability'
FROM report WHERE raw_conf < 0.8
UNION ALL SELECT 'low', 'deployment', 'Excellent model performance - ready for production scaling', 'Business value realization'
FROM report WHERE vs_baseline > 10""",
    "confidence_heatmap_all_hours": _w(HOURLY) + f"""
SELECT dayname(hour_ts) AS day_of_week,
       CASE WHEN hour(hour_ts) <= 6 THEN 'Night' WHEN hour(hour_ts) <= 12 THEN 'Morning'
            WHEN hour(hour_ts) <= 18 THEN 'Afternoon' ELSE 'Evening' END AS hour_group,
       {R6('avg(avg_confidence)')} AS avg_confidence FROM hourly GROUP BY 1, 2""",
    "stream_hourly_view": _w(HOURLY) + f"""
SELECT hour_ts, predictions_count, positive_predictions, negative_predictions, {R('avg_confidence', 12)} AS avg_confidence,
       {R('processing_time', 12)} AS processing_time, {R('positive_rate', 12)} AS positive_rate FROM hourly""",

    "business_alerts": _w(RFM, BEH, SEGCUST, LOG, DAILY_ALL, ALERTS) + "SELECT * FROM alerts",
    "alert_summary": _w(RFM, BEH, SEGCUST, LOG, DAILY_ALL, ALERTS) + f"""
SELECT count(*) AS total_alerts, count_if(severity = 'high') AS high_priority,
       count_if(severity = 'medium') AS medium_priority, count_if(severity = 'low') AS low_priority,
       count_if(type = 'business_opportunity') AS business_opportunities,
       {R('coalesce(sum(coalesce(estimated_revenue_impact, 0.0) + coalesce(potential_revenue, 0.0)), 0.0)', 2)}
         AS total_revenue_impact,
       count_if(severity = 'high') > 0 AS requires_immediate_action FROM alerts""",
    "roi_summary": _w(ROI) + f"""
SELECT {R('C', 2)} AS total_costs, {R('B', 2)} AS total_benefits, {R('(B - C) / C * 100', 2)} AS roi_percentage,
       {R('B - C', 2)} AS net_benefit, {R('CASE WHEN B > 0 THEN C / (B / 3.0) END', 1)} AS payback_period_months,
       {R('B / C', 2)} AS benefit_cost_ratio,
       CASE WHEN (B - C) / C * 100 > 0 THEN 'positive' ELSE 'negative' END AS roi_status,
       CASE WHEN (B - C) / C * 100 > 200 THEN 'excellent' WHEN (B - C) / C * 100 > 100 THEN 'good'
            WHEN (B - C) / C * 100 > 50 THEN 'acceptable' ELSE 'poor' END AS investment_grade
FROM roi_t""",
    "roi_sensitivity": _w(ROI) + f"""
SELECT s.scenario, {R('B * s.m', 2)} AS total_benefits, {R('(B * s.m - C) / C * 100', 2)} AS roi_percentage,
       {R('B * s.m - C', 2)} AS net_benefit
FROM roi_t CROSS JOIN (VALUES ('conservative', 0.7::DOUBLE), ('realistic', 1.0::DOUBLE),
                              ('optimistic', 1.3::DOUBLE)) s(scenario, m)""",
    "roi_projection": _w(ROI) + f"""
, p AS (SELECT CAST(month AS INTEGER) AS month, month * (B / 3.0) AS cb, C + month * (C * 0.3 / 3.0) AS cc
        FROM roi_t CROSS JOIN range(1, 13) t(month))
SELECT month, {R('cb', 2)} AS cumulative_benefits, {R('cc', 2)} AS cumulative_costs,
       {R('(cb - cc) / cc * 100', 2)} AS cumulative_roi, cb >= cc AS break_even FROM p""",
    "success_rate": """
SELECT count(*) AS total_steps, count_if(event_type <> 'error') AS successful_steps,
       coalesce(count_if(event_type <> 'error')::DOUBLE / nullif(count(*), 0)::DOUBLE * 100, 0.0) AS success_rate
FROM events""",
    "log_families": """
SELECT CASE WHEN contains(event_type, 'data_collection') THEN 'data_collection'
            WHEN contains(event_type, 'feature_engineering') THEN 'feature_engineering'
            WHEN contains(event_type, 'model_training') THEN 'model_training'
            WHEN contains(event_type, 'prediction') THEN 'prediction'
            WHEN event_type IN ('customer_insights', 'roi_analysis') THEN 'business_intelligence'
            ELSE 'other' END AS family,
       count(*) AS steps, count_if(event_type <> 'error') AS successes
FROM events GROUP BY 1""",
    "step_families": """
SELECT CASE event_type WHEN 'click' THEN 'data_collection' WHEN 'signup' THEN 'feature_engineering'
            WHEN 'view' THEN 'model_training' WHEN 'purchase' THEN 'prediction' WHEN 'error' THEN 'business_intelligence'
            ELSE 'other' END AS family, count(*) AS steps, count_if(value >= 10) AS successes
FROM events GROUP BY 1""",
    "clean_customers": _w(HOLDERS) + """
SELECT customer_id, age, upper(n_name[1]) || lower(n_name[2:]) || '''S O''Er-' || upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS city,
       amount FROM holders WHERE age BETWEEN 18 AND 100""",
    "positive_balances": _w(HOLDERS) + "SELECT customer_id, amount FROM holders WHERE amount > 0",
    "parse_times": """
SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS transaction_date FROM events""",
    "rejected_times": "SELECT count(*) AS total_rows, count_if(event_type = 'error') AS rejected_rows FROM events",
    "fk_orphans_of_positive": """
SELECT count(*) AS total_rows, count_if(c_custkey IS NULL) AS orphan_rows
FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey""",
    "orphan_orders": """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
    "clean_report_customers": _w(HOLDERS) + """
SELECT 'customers' AS dataset, count(*) AS original_rows, count_if(age BETWEEN 18 AND 100 AND amount > 0) AS cleaned_rows,
       count(*) - count_if(age BETWEEN 18 AND 100 AND amount > 0) AS removed_rows FROM holders""",
    "alert_texts": _w(RFM, BEH, SEGCUST, LOG, DAILY_ALL, ALERTS) + """
SELECT alert_id, type, CASE type
  WHEN 'churn_risk' THEN printf('Average churn risk is %.1f%%, above threshold of %.1f%%', metric_value * 100, threshold * 100)
  WHEN 'model_confidence' THEN printf('Model confidence is %.1f%%, below threshold of %.1f%%', metric_value * 100, threshold * 100)
  WHEN 'performance_decline' THEN printf('Model accuracy dropped by %.1f%% recently', abs(metric_value) * 100)
  WHEN 'volume_spike' THEN printf('Prediction volume is %.1fx normal levels', metric_value)
  ELSE 'Identified ' || opportunity_size || ' customers for cross_sell campaigns' END AS description FROM alerts""",
    "alert_actions": _w(RFM, BEH, SEGCUST, LOG, DAILY_ALL, ALERTS) + """
SELECT alert_id, type, CAST(a.n AS INTEGER) AS action_no, a.action FROM alerts JOIN (VALUES
  ('churn_risk', 0, 'Launch retention campaign immediately'),
  ('churn_risk', 1, 'Offer personalized discounts to high-risk customers'),
  ('churn_risk', 2, 'Contact high-value customers personally'),
  ('model_confidence', 0, 'Review recent training data quality'),
  ('model_confidence', 1, 'Consider model retraining'), ('model_confidence', 2, 'Implement ensemble methods'),
  ('performance_decline', 0, 'Investigate data drift'),
  ('performance_decline', 1, 'Schedule immediate model retraining'),
  ('performance_decline', 2, 'Review feature engineering pipeline'),
  ('volume_spike', 0, 'Monitor system performance'), ('volume_spike', 1, 'Check for data quality issues'),
  ('volume_spike', 2, 'Verify business events causing spike'),
  ('business_opportunity', 0, 'Launch targeted cross_sell campaign'),
  ('business_opportunity', 1, 'Personalize offers based on customer segments'),
  ('business_opportunity', 2, 'Track campaign performance')) a(type, n, action) USING (type)""",
    "alert_measures": _w(RFM, BEH, SEGCUST, LOG, DAILY_ALL, ALERTS) + """
SELECT alert_id, type, CASE type WHEN 'model_confidence' THEN 'Reduced prediction reliability'
         WHEN 'performance_decline' THEN 'Potential for incorrect business decisions'
         WHEN 'volume_spike' THEN 'May require scaling' END AS impact,
       CASE WHEN type = 'model_confidence' THEN (SELECT count_if(confidence < 0.75) FROM plog) END AS affected_predictions,
       CASE WHEN type = 'performance_decline' THEN printf('%.1f%%', abs(metric_value) * 100) END AS performance_drop,
       CASE WHEN type = 'volume_spike' THEN printf('%.0f%%', (metric_value - 1) * 100) END AS volume_increase
FROM alerts""",
    "insight_texts": _w(RFM, BEH, SEGCUST, SEG_INSIGHTS) + """
SELECT * FROM (SELECT 'revenue' AS insight_type, segment || ' segment generates highest revenue' AS insight,
         '€' || format('{:,}', CAST(trunc(avg_monetary) AS BIGINT)) || substr(printf('%.2f', avg_monetary - trunc(avg_monetary)), 2)
           || ' average per customer' AS value, 'Focus retention efforts on this segment' AS action
       FROM seg_ins ORDER BY avg_monetary DESC NULLS LAST, segment_order LIMIT 1)
UNION ALL
SELECT * FROM (SELECT 'risk', segment || ' segment has high churn risk',
         printf('%.1f%%', churn_risk * 100) || ' average churn probability', 'Implement immediate retention campaigns'
       FROM seg_ins WHERE churn_risk > 0.6 ORDER BY churn_risk DESC, segment_order LIMIT 1)
UNION ALL
SELECT * FROM (SELECT 'opportunity', segment || ' segment has low purchase frequency',
         printf('%.1f', avg_frequency) || ' purchases on average', 'Target with engagement campaigns'
       FROM seg_ins ORDER BY avg_frequency ASC NULLS LAST, segment_order LIMIT 1)""",
    "roi_drivers": f"""
SELECT category, {R('benefit', 2)} AS benefit,
       'Category ' || category || ': €' || format('{{:,}}', CAST(round_even(benefit, 0) AS BIGINT)) AS driver
FROM (SELECT l_linestatus AS category, count(*) * avg(l_extendedprice * (1.0 - l_discount)) AS benefit
      FROM lineitem GROUP BY 1)""",
    "report_lookup": _w(RFM, BEH, SEGCUST, LOG, DAILY_ALL, ALERTS) + """
SELECT alert_id, type, severity, metric_value FROM alerts WHERE alert_id = 'ALERT_001'""",
    "alerts_of_severity": _w(RFM, BEH, SEGCUST, LOG, DAILY_ALL, ALERTS) + """
SELECT alert_id, type, severity FROM alerts WHERE severity = 'high'""",
    "run_log_tail": """
SELECT ts AS timestamp, event_type AS step, CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status
FROM events ORDER BY ts DESC, event_type, status LIMIT 5""",
    "run_log_io": """
SELECT count(*) AS total_steps, count_if(event_type <> 'error') AS successful_steps,
       coalesce(count_if(event_type <> 'error')::DOUBLE / nullif(count(*), 0)::DOUBLE * 100, 0.0) AS success_rate
FROM events""",
    "drift_recommendations": _w(LOG) + DRIFT_ADVICE,
    "drift_advice": _w(SHIFTING_LOG) + DRIFT_ADVICE,
    "roi_recommendations": _w(ROI) + """
, s AS (SELECT floor((B - C) / C * 100 * 1e2 + 0.5) / 1e2 AS roi FROM roi_t)
SELECT recommendation FROM s, (VALUES
  (1, 'Excellent ROI - recommend scaling the initiative'), (1, 'Consider expanding to additional use cases'),
  (1, 'Allocate more resources for faster deployment'),
  (2, 'Positive ROI - continue with current plan'), (2, 'Focus on optimizing high-impact areas'),
  (2, 'Monitor performance closely'),
  (3, 'Review cost structure and benefit assumptions'), (3, 'Consider alternative approaches or technologies'),
  (3, 'Reassess timeline and milestones')) t(band, recommendation)
WHERE band = CASE WHEN roi > 100 THEN 1 WHEN roi > 50 THEN 2 ELSE 3 END""",
}

# The alert statements again over the bindings on which every rule fires.
_ONE, _ALL = _w(RFM, BEH, SEGCUST, LOG, DAILY_ALL, ALERTS), _w(RFM, BROWSING_BEH, SEGCUST, BURSTING_LOG, DAILY_ALL, ALERTS)
ORACLE_SQL |= {f"{k.removeprefix('business_')}_all_rules": ORACLE_SQL[k].replace(_ONE, _ALL)
               for k in ("business_alerts", "alert_texts", "alert_actions", "alert_measures", "alert_summary")}
_HISTORY = "run_id, alert_id, rule_no, type, severity, metric_value"
ORACLE_SQL["alert_history"] = f"""
SELECT {_HISTORY} FROM (SELECT '2024-01-30' AS run_id, * FROM ({ORACLE_SQL['business_alerts']}))
UNION ALL
SELECT {_HISTORY} FROM (SELECT '2024-01-31' AS run_id, * REPLACE (printf('ALERT_%03d',
    (SELECT count(*) FROM ({ORACLE_SQL['business_alerts']})) + rule_no) AS alert_id) FROM ({ORACLE_SQL['alerts_all_rules']}))"""
ORACLE_SQL["dashboard_overview"] = f"SELECT * FROM ({ORACLE_SQL['dashboard_summary']}) CROSS JOIN ({ORACLE_SQL['current_stats']})"


def _count_filter(sql: str) -> str:
    """Write ``count_if(cond)`` as ``count(*) FILTER (WHERE cond)`` (BIGINT, like Spark's count_if)."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j] + f"(count(*) FILTER (WHERE {sql[j + len(key):k - 1]}))")
        i = k


ORACLE_SQL["rolling_thresholds"] = ORACLE_SQL["anomaly_counts"]
ORACLE_SQL = {k: _count_filter(v) for k, v in ORACLE_SQL.items()}
