"""DuckDB SQL twins of the registered queries (independent formulations:
brute force or textbook definitions, not the Spark plan re-typed)."""
from __future__ import annotations

PRED = """
SELECT concat('M', cast(m AS varchar)) AS model, cast(l_suppkey % 20 AS int) AS repeat,
       l_suppkey AS group_id, y AS y_true,
       cast(w*10*y + floor(cast((100-w)*h AS double)/100) AS bigint) / cast(1000 AS double) AS proba
FROM (SELECT m, 10+5*m AS w, l_suppkey, CASE WHEN l_quantity > 35 THEN 1 ELSE 0 END AS y,
             (l_orderkey*7919 + l_linenumber*104729 + l_partkey*31 + m*15485863) % 1000 AS h
      FROM lineitem CROSS JOIN (VALUES (1),(2),(3),(4),(5),(6),(7)) AS v(m)) q
"""

GRID91 = "(SELECT i, CASE WHEN i = 90 THEN 0.95 ELSE round(0.05 + i*0.01, 12) END AS t FROM range(0, 91) g(i))"

# brute force: every prediction against every grid point, integer thousandths
BEST_THRESHOLD = f"""
WITH pred AS ({PRED}),
g AS {GRID91},
f AS (
  SELECT model, repeat, i, t,
         sum(CASE WHEN y_true = 1 AND cast(round(proba*1000) AS bigint) >= cast(round(t*1000) AS bigint) THEN 1 ELSE 0 END) AS tp,
         sum(CASE WHEN y_true = 0 AND cast(round(proba*1000) AS bigint) >= cast(round(t*1000) AS bigint) THEN 1 ELSE 0 END) AS fp,
         sum(CASE WHEN y_true = 1 AND cast(round(proba*1000) AS bigint) <  cast(round(t*1000) AS bigint) THEN 1 ELSE 0 END) AS fn
  FROM pred CROSS JOIN g GROUP BY model, repeat, i, t),
s AS (SELECT model, repeat, i, t,
             CASE WHEN 2*tp+fp+fn = 0 THEN 0.0 ELSE 2.0*tp/(2*tp+fp+fn) END AS f1 FROM f),
r AS (SELECT *, row_number() OVER (PARTITION BY model, repeat ORDER BY f1 DESC, i) AS rn FROM s)
SELECT model, repeat, round(t, 9) AS threshold, round(f1, 9) AS f1 FROM r WHERE rn = 1
"""


def metrics_sql(pred_cte: str, ypred_expr: str, digits: int | None = 9) -> str:
    """Nine metrics from textbook definitions: confusion sums, mid-rank AUC,
    average precision over distinct scores."""
    return f"""
WITH pred AS ({pred_cte}),
d AS (SELECT *, {ypred_expr} AS y_pred FROM pred),
conf AS (
  SELECT model, repeat,
         sum(y_true*y_pred) AS tp, sum((1-y_true)*y_pred) AS fp,
         sum(y_true*(1-y_pred)) AS fn, sum((1-y_true)*(1-y_pred)) AS tn,
         avg((proba-y_true)*(proba-y_true)) AS brier
  FROM d GROUP BY model, repeat),
rk AS (
  SELECT model, repeat, y_true,
         rank() OVER (PARTITION BY model, repeat ORDER BY proba)
           + (count(*) OVER (PARTITION BY model, repeat, proba) - 1) / 2.0 AS midrank
  FROM pred),
auc AS (
  SELECT model, repeat, sum(y_true) AS p, sum(1-y_true) AS n,
         CASE WHEN sum(y_true) = 0 OR sum(1-y_true) = 0 THEN NULL ELSE
           (sum(CASE WHEN y_true = 1 THEN midrank ELSE 0 END) - sum(y_true)*(sum(y_true)+1)/2.0)
           / (cast(sum(y_true) AS double) * sum(1-y_true)) END AS roc_auc
  FROM rk GROUP BY model, repeat),
sc AS (SELECT model, repeat, proba, sum(y_true) AS pos, sum(1-y_true) AS neg FROM pred GROUP BY model, repeat, proba),
cu AS (SELECT *, sum(pos) OVER (PARTITION BY model, repeat ORDER BY proba DESC) AS cp,
                 sum(neg) OVER (PARTITION BY model, repeat ORDER BY proba DESC) AS cn FROM sc),
ap AS (SELECT model, repeat,
              CASE WHEN sum(pos) = 0 THEN NULL ELSE sum(pos * cp / (cp + cn)) / sum(pos) END AS pr_auc
       FROM cu GROUP BY model, repeat),
m AS (
  SELECT c.model, c.repeat,
    (tp+tn)*1.0/(tp+tn+fp+fn) AS accuracy,
    CASE WHEN tp+fp = 0 THEN 0.0 ELSE tp*1.0/(tp+fp) END AS precision,
    CASE WHEN tp+fn = 0 THEN 0.0 ELSE tp*1.0/(tp+fn) END AS recall,
    CASE WHEN 2*tp+fp+fn = 0 THEN 0.0 ELSE 2.0*tp/(2*tp+fp+fn) END AS f1,
    ((CASE WHEN tp+fn+fp > 0 THEN 2.0*tp/(2*tp+fp+fn) ELSE 0 END)
     + (CASE WHEN tn+fp+fn > 0 THEN 2.0*tn/(2*tn+fp+fn) ELSE 0 END))
     / ((CASE WHEN tp+fn+fp > 0 THEN 1 ELSE 0 END) + (CASE WHEN tn+fp+fn > 0 THEN 1 ELSE 0 END)) AS macro_f1,
    a.roc_auc, ap.pr_auc,
    ((CASE WHEN tp+fn > 0 THEN tp*1.0/(tp+fn) ELSE 0 END) + (CASE WHEN tn+fp > 0 THEN tn*1.0/(tn+fp) ELSE 0 END))
     / ((CASE WHEN tp+fn > 0 THEN 1 ELSE 0 END) + (CASE WHEN tn+fp > 0 THEN 1 ELSE 0 END)) AS balanced_accuracy,
    brier
  FROM conf c JOIN auc a USING (model, repeat) JOIN ap USING (model, repeat))
SELECT model, repeat, {_r("accuracy", digits)}, {_r("precision", digits)},
       {_r("recall", digits)}, {_r("f1", digits)}, {_r("macro_f1", digits)},
       {_r("roc_auc", digits)}, {_r("pr_auc", digits)},
       {_r("balanced_accuracy", digits)}, {_r("brier", digits)}
FROM m
"""


def _r(c: str, digits: int | None) -> str:
    return f"round({c}, {digits}) AS {c}" if digits is not None else c


NINE_METRICS = metrics_sql(PRED, "CASE WHEN cast(round(proba*1000) AS bigint) >= 500 THEN 1 ELSE 0 END")

# Metrics at each cell's best threshold (threshold chosen on the same cell)
PRED_AT_BEST = f"""
SELECT p.model, p.repeat, p.group_id, p.y_true, p.proba, b.threshold
FROM ({PRED}) p JOIN ({BEST_THRESHOLD}) b USING (model, repeat)
"""
METRICS_LONG = metrics_sql(
    PRED_AT_BEST, "CASE WHEN cast(round(proba*1000) AS bigint) >= cast(round(threshold*1000) AS bigint) THEN 1 ELSE 0 END")


SQL = {
    "nine_metrics": NINE_METRICS,
    "best_threshold": BEST_THRESHOLD,
    "metrics_long": METRICS_LONG,
}

# ---------------------------------------------------------------- report / stats
METRICS = "(" + metrics_sql(
    PRED_AT_BEST, "CASE WHEN cast(round(proba*1000) AS bigint) >= cast(round(threshold*1000) AS bigint) THEN 1 ELSE 0 END",
    digits=None) + ")"
_MCOLS = "accuracy, precision, recall, f1, macro_f1, roc_auc, pr_auc, balanced_accuracy, brier"
PRED_MODELS = [f"M{i}" for i in range(1, 8)]

METRIC_SUMMARY = f"""
WITH u AS (UNPIVOT {METRICS} ON {_MCOLS} INTO NAME metric VALUE value),
s AS (SELECT model, metric, avg(value) AS mean, stddev_samp(value) AS std,
             count(DISTINCT repeat) AS n_repeats FROM u GROUP BY model, metric)
SELECT model, metric, round(mean, 9) AS mean, round(std, 9) AS std, n_repeats,
       printf('%.3f ± %.3f', mean, std) AS display FROM s
"""

METRIC_PIVOT = "SELECT repeat, " + ", ".join(
    f"round(max(CASE WHEN model = '{m}' THEN macro_f1 END), 9) AS {m}" for m in PRED_MODELS
) + f" FROM {METRICS} t GROUP BY repeat"

BEST_RUN = f"""
SELECT model, repeat, macro_f1 FROM {METRICS} t ORDER BY macro_f1 DESC, repeat, model LIMIT 1
"""

# explicit ordinal form (ties → first model by name)
BEST_WORST = f"""
WITH u AS (UNPIVOT {METRICS} ON {_MCOLS} INTO NAME metric VALUE value),
s AS (SELECT model, metric, avg(value) AS mean FROM u GROUP BY model, metric),
g AS (SELECT *, CASE WHEN metric = 'brier' THEN -mean ELSE mean END AS good FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY good DESC, model) AS rb,
                row_number() OVER (PARTITION BY metric ORDER BY good ASC, model) AS rw FROM g)
SELECT metric,
       max(CASE WHEN rb = 1 THEN model END) AS best_model, round(max(CASE WHEN rb = 1 THEN mean END), 9) AS best_mean,
       max(CASE WHEN rw = 1 THEN model END) AS worst_model, round(max(CASE WHEN rw = 1 THEN mean END), 9) AS worst_mean
FROM r GROUP BY metric
"""

MODEL_RANKING = f"""
WITH s AS (SELECT model, avg(macro_f1) AS mean, stddev_samp(macro_f1) AS std FROM {METRICS} t GROUP BY model)
SELECT model, round(mean, 9) AS mean, round(std, 9) AS std,
       row_number() OVER (ORDER BY mean DESC, model) AS rank,
       round(greatest(0.0, min(mean) OVER () - 0.1), 9) AS axis_min,
       round(least(1.0, max(mean) OVER () + 0.1), 9) AS axis_max
FROM s
"""

LEARNING_CURVE = f"""
SELECT model, repeat,
  round(avg(macro_f1) OVER (PARTITION BY model ORDER BY repeat ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 9) AS running_mean,
  round(stddev_samp(macro_f1) OVER (PARTITION BY model ORDER BY repeat ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 9) AS running_std
FROM {METRICS} t
"""

BOX_STATS = f"""
WITH q AS (SELECT model, quantile_cont(macro_f1, 0.25) AS q1, quantile_cont(macro_f1, 0.5) AS median,
                  quantile_cont(macro_f1, 0.75) AS q3, avg(macro_f1) AS mean,
                  min(macro_f1) AS min, max(macro_f1) AS max FROM {METRICS} t GROUP BY model)
SELECT q.model, round(q1, 9) AS q1, round(median, 9) AS median, round(q3, 9) AS q3, round(mean, 9) AS mean,
       round(min, 9) AS min, round(max, 9) AS max,
       round(min(CASE WHEN macro_f1 >= q1 - 1.5*(q3-q1) THEN macro_f1 END), 9) AS whisker_lo,
       round(max(CASE WHEN macro_f1 <= q3 + 1.5*(q3-q1) THEN macro_f1 END), 9) AS whisker_hi,
       count(CASE WHEN macro_f1 < q1 - 1.5*(q3-q1) OR macro_f1 > q3 + 1.5*(q3-q1) THEN 1 END) AS n_outliers
FROM {METRICS} t JOIN q USING (model)
GROUP BY q.model, q1, median, q3, mean, min, max
"""

IDEAL_QUADRANT = f"""
WITH s AS (SELECT model, avg(macro_f1) AS mean, stddev_samp(macro_f1) AS std FROM {METRICS} t GROUP BY model),
m AS (SELECT median(mean) AS mm, median(std) AS ms FROM s),
f AS (SELECT s.*, (mean >= mm AND std <= ms) AS ideal,
             row_number() OVER (ORDER BY std, model) AS rs FROM s, m)
SELECT model, round(mean, 9) AS mean, round(std, 9) AS std, ideal FROM f
WHERE CASE WHEN (SELECT bool_or(ideal) FROM f) THEN ideal ELSE rs <= 4 END
"""

TOP3_PLUS_NAMED = f"""
WITH s AS (SELECT model, avg(macro_f1) AS mean FROM {METRICS} t GROUP BY model),
r AS (SELECT *, row_number() OVER (ORDER BY mean DESC, model) AS rank FROM s)
SELECT model, round(mean, 9) AS mean, rank FROM r WHERE rank <= 3 OR model = 'M1'
"""

RANK_SLICES = f"""
WITH s AS (SELECT model, avg(roc_auc) AS auc, avg(macro_f1) AS mf1, stddev_samp(macro_f1) AS sd FROM {METRICS} t GROUP BY model),
r AS (SELECT model,
        row_number() OVER (ORDER BY auc DESC, model) AS auc_desc, row_number() OVER (ORDER BY auc ASC, model) AS auc_asc,
        row_number() OVER (ORDER BY sd ASC, model) AS sd_asc, row_number() OVER (ORDER BY sd DESC, model) AS sd_desc,
        row_number() OVER (ORDER BY mf1 DESC, model) AS f1_desc, row_number() OVER (ORDER BY mf1 ASC, model) AS f1_asc FROM s)
SELECT model, 'top3_auc' AS slice FROM r WHERE auc_desc <= 3
UNION ALL SELECT model, 'bottom2_auc' FROM r WHERE auc_asc <= 2
UNION ALL SELECT model, 'most_stable4' FROM r WHERE sd_asc <= 4
UNION ALL SELECT model, 'least_stable4' FROM r WHERE sd_desc <= 4
UNION ALL SELECT model, 'runners_up' FROM r WHERE f1_desc BETWEEN 2 AND 4
UNION ALL SELECT model, 'second_worst' FROM r WHERE f1_asc = 2
"""

AUC_LEGEND = f"""
SELECT model, round(avg(roc_auc), 9) AS auc_mean, round(stddev_pop(roc_auc), 9) AS auc_std,
       round(avg(pr_auc), 9) AS ap_mean, round(stddev_pop(pr_auc), 9) AS ap_std
FROM {METRICS} t GROUP BY model
"""

FRIEDMAN = f"""
WITH v AS (SELECT repeat, model, macro_f1 AS v FROM {METRICS} t),
r AS (SELECT *, rank() OVER (PARTITION BY repeat ORDER BY v) + (count(*) OVER (PARTITION BY repeat, v) - 1) / 2.0 AS r FROM v),
rs AS (SELECT model, sum(r) AS R, count(*) AS nb FROM r GROUP BY model),
s AS (SELECT sum(R*R) AS ssbn, count(*) AS k, max(nb) AS n FROM rs),
ti AS (SELECT sum(t*t*t - t) AS tie_sum FROM (SELECT count(*) AS t FROM v GROUP BY repeat, v)),
x AS (SELECT (12.0/(k*n*(k+1)) * ssbn - 3.0*n*(k+1)) / (1 - tie_sum / (k*(k*k-1)*n)) AS statistic,
             k - 1 AS df, k, n, cast(tie_sum AS double) AS tie_sum FROM s, ti)
SELECT round(statistic, 9) AS statistic, df, k, n, round(tie_sum, 9) AS tie_sum,
       round(exp(-statistic/2) * list_sum(list_transform(range(0, df // 2),
             lambda i: pow(statistic/2, i) / cast(factorial(cast(i AS integer)) AS double))), 9) AS p_value
FROM x
"""

_WILCOXON_BASE = f"""
WITH RECURSIVE dp(k, c) AS (
  SELECT 0, [1.0::DOUBLE]
  UNION ALL
  SELECT k + 1, list_transform(range(0, (k+1)*(k+2)//2 + 1),
           lambda s: coalesce(c[s+1], 0) + CASE WHEN s >= k+1 THEN coalesce(c[s-k], 0) ELSE 0 END)
  FROM dp WHERE k < 50),
m AS (SELECT * FROM {METRICS} t),
d AS (SELECT a.model AS model_a, b.model AS model_b, a.repeat, round(a.macro_f1 - b.macro_f1, 12) AS d
      FROM m a JOIN m b ON a.repeat = b.repeat AND a.model < b.model),
nz AS (SELECT *, abs(d) AS ad FROM d WHERE d <> 0),
rk AS (SELECT *, rank() OVER (PARTITION BY model_a, model_b ORDER BY ad)
                 + (count(*) OVER (PARTITION BY model_a, model_b, ad) - 1) / 2.0 AS r FROM nz),
sums AS (SELECT model_a, model_b, count(*) AS n,
                sum(CASE WHEN d > 0 THEN r ELSE 0 END) AS w_plus, sum(CASE WHEN d < 0 THEN r ELSE 0 END) AS w_minus
         FROM rk GROUP BY model_a, model_b),
ties AS (SELECT model_a, model_b, cast(sum(t*t*t - t) AS double) AS tie_sum, max(t) AS max_tie
         FROM (SELECT model_a, model_b, ad, count(*) AS t FROM nz GROUP BY ALL) GROUP BY model_a, model_b),
zer AS (SELECT model_a, model_b, cast(sum(CASE WHEN d = 0 THEN 1 ELSE 0 END) AS bigint) AS n_zero FROM d GROUP BY model_a, model_b),
tst AS (SELECT z.model_a, z.model_b, coalesce(n, 0) AS n, z.n_zero,
               CASE WHEN coalesce(n, 0) = 0 THEN NULL ELSE least(w_plus, w_minus) END AS statistic,
               (z.n_zero = 0 AND coalesce(max_tie, 0) <= 1 AND coalesce(n, 0) <= 50) AS exact,
               coalesce(tie_sum, 0) AS tie_sum
        FROM zer z LEFT JOIN sums USING (model_a, model_b) LEFT JOIN ties USING (model_a, model_b)),
zz AS (SELECT *, CASE WHEN n*(n+1)*(2*n+1)/24.0 - tie_sum/48.0 > 0
                      THEN (statistic - n*(n+1)/4.0) / sqrt(n*(n+1)*(2*n+1)/24.0 - tie_sum/48.0) ELSE 0 END AS z FROM tst),
apx AS (SELECT model_a, model_b,
               2 * sum(CASE WHEN i = 0 OR i = 24000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
                       * exp(-0.5 * (abs(z) + i*0.0005) * (abs(z) + i*0.0005))) * 0.0005 / 3 / sqrt(2*pi()) AS p
        FROM zz CROSS JOIN range(0, 24001) g(i) WHERE NOT exact AND n > 0 GROUP BY model_a, model_b),
pv AS (SELECT zz.model_a, zz.model_b, zz.n, zz.n_zero, zz.statistic, zz.exact,
              CASE WHEN zz.n = 0 THEN 1.0
                   WHEN zz.exact THEN least(1.0, 2 * list_sum(list_slice(dp.c, 1, cast(floor(zz.statistic) AS bigint) + 1)) / pow(2, zz.n))
                   ELSE apx.p END AS p_value
       FROM zz LEFT JOIN dp ON dp.k = zz.n LEFT JOIN apx USING (model_a, model_b)),
bf AS (SELECT *, least(1.0, p_value * count(*) OVER ()) AS p_bonferroni FROM pv)
"""

WILCOXON_PAIRS = _WILCOXON_BASE + """
SELECT model_a, model_b, n, n_zero, round(statistic, 9) AS statistic, exact, round(p_value, 9) AS p_value,
       round(p_bonferroni, 9) AS p_bonferroni, p_bonferroni < 0.05 AS significant FROM bf
"""

SIGNIFICANT_PAIRS = _WILCOXON_BASE + """
SELECT count(*) AS n_pairs, cast(sum(CASE WHEN p_bonferroni < 0.05 THEN 1 ELSE 0 END) AS bigint) AS n_significant FROM bf
"""

SQL.update({
    "metric_summary": METRIC_SUMMARY,
    "metric_pivot": METRIC_PIVOT,
    "best_run": BEST_RUN,
    "best_worst_per_metric": BEST_WORST,
    "model_ranking": MODEL_RANKING,
    "learning_curve": LEARNING_CURVE,
    "box_stats": BOX_STATS,
    "ideal_quadrant": IDEAL_QUADRANT,
    "top3_plus_named": TOP3_PLUS_NAMED,
    "rank_slices": RANK_SLICES,
    "auc_legend": AUC_LEGEND,
    "friedman": FRIEDMAN,
    "wilcoxon_pairs": WILCOXON_PAIRS,
    "significant_pairs": SIGNIFICANT_PAIRS,
})

# ---------------------------------------------------------------- data + splits
WIDE = """(SELECT vec_id AS row_id, CASE WHEN label < 3 THEN 1 ELSE 0 END AS label,
  concat(CASE WHEN label < 3 THEN 'P_' ELSE 'N_' END, cast(vec_id % 23 AS varchar)) AS patient_id,
  CASE WHEN (vec_id // 23) % 2 = 0 THEN 'Right' ELSE 'Left' END AS side FROM embeddings)"""

WIDE_LONG = """(SELECT vec_id AS row_id, CASE WHEN label < 3 THEN 1 ELSE 0 END AS label,
       concat(CASE WHEN label < 3 THEN 'P_' ELSE 'N_' END, cast(vec_id % 23 AS varchar)) AS patient_id,
       CASE WHEN (vec_id // 23) % 2 = 0 THEN 'Right' ELSE 'Left' END AS side,
       j AS feature_idx,
       CASE WHEN (vec_id*31+j) % 97 = 0 THEN NULL
            WHEN (vec_id*17+j) % 211 = 0 THEN cast('Infinity' AS double)
            ELSE cast(embedding[j] AS double) END AS value
FROM embeddings CROSS JOIN (SELECT unnest(range(1, 65)) j))"""

UNION_SOURCES = f"""
SELECT row_id, patient_id, label, side FROM {WIDE} w
"""

INF_TO_NULL = f"""
SELECT cast(feature_idx AS integer) AS feature_idx,
       count(*) FILTER (WHERE value IS NULL OR isinf(value)) AS n_missing,
       count(*) FILTER (WHERE isinf(value)) AS n_replaced,
       round(sum(CASE WHEN isinf(value) THEN NULL ELSE value END), 9) AS finite_sum
FROM {WIDE_LONG} l GROUP BY feature_idx
"""

ONE_HOT_SIDE = f"""
SELECT row_id, CASE WHEN side = 'Left' THEN 1 ELSE 0 END AS side_Left,
       CASE WHEN side = 'Right' THEN 1 ELSE 0 END AS side_Right FROM {WIDE} w
"""

MIXED = "(SELECT cast(user_id AS varchar) AS group_id, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS label FROM events)"

INTEGRITY_OVERLAP = f"""
SELECT group_id FROM {MIXED} a WHERE label = 0
INTERSECT
SELECT group_id FROM {MIXED} b WHERE label = 1
"""

INTEGRITY_MIXED = f"""
SELECT group_id, count(DISTINCT label) AS n_labels FROM {MIXED} m GROUP BY group_id HAVING count(DISTINCT label) > 1
"""

GROUP_SIZE_DEVIANTS = f"""
WITH s AS (SELECT patient_id, count(*) AS n_rows FROM {WIDE} w GROUP BY patient_id),
f AS (SELECT n_rows, count(*) AS f FROM s GROUP BY n_rows),
m AS (SELECT n_rows AS mode_size FROM f ORDER BY f DESC, n_rows LIMIT 1)
SELECT patient_id, n_rows, mode_size FROM s, m WHERE n_rows <> mode_size
"""

CLASS_DISTRIBUTION = f"""
SELECT label, count(*) AS n, count(DISTINCT patient_id) AS n_groups,
       round(count(*) * 100.0 / sum(count(*)) OVER (), 9) AS pct
FROM {WIDE} w GROUP BY label
"""


def split_sql(groups_sql: str, group: str = "patient_id", repeats: int = 20) -> str:
    return f"""
WITH g AS (SELECT DISTINCT {group} FROM {groups_sql} src),
r AS (SELECT {group}, cast(repeat AS integer) AS repeat FROM g CROSS JOIN range(0, {repeats}) t(repeat)),
k1 AS (SELECT *, row_number() OVER (PARTITION BY repeat
                   ORDER BY md5(concat('42', ':', cast(repeat AS varchar), ':', {group})), {group}) AS pos1,
                 count(*) OVER (PARTITION BY repeat) AS gn FROM r),
t AS (SELECT repeat, {group}, pos1 <= ceil(0.2::DOUBLE * gn) AS is_test FROM k1),
k2 AS (SELECT repeat, {group}, row_number() OVER (PARTITION BY repeat
                   ORDER BY md5(concat(cast(42 + repeat AS varchar), ':', cast(repeat AS varchar), ':', {group})), {group}) AS pos2,
              count(*) OVER (PARTITION BY repeat) AS rn FROM t WHERE NOT is_test)
SELECT repeat, {group}, 'test' AS split FROM t WHERE is_test
UNION ALL
SELECT repeat, {group}, CASE WHEN pos2 <= ceil(0.125::DOUBLE * rn) THEN 'val' ELSE 'train' END FROM k2
"""


GROUP_SPLIT = split_sql(WIDE)

NESTED_VAL_SPLIT = f"""
SELECT repeat, split, count(*) AS n_groups FROM ({GROUP_SPLIT}) s GROUP BY repeat, split
"""

GROUPS_TALL = "(SELECT cast(l_suppkey AS varchar) AS group_id, CASE WHEN l_quantity > 35 THEN 1 ELSE 0 END AS label FROM lineitem)"

GROUPS_TALL_SPLIT = f"""
WITH a AS ({split_sql(GROUPS_TALL, 'group_id')})
SELECT a.repeat, a.split, count(DISTINCT a.group_id) AS n_groups, count(*) AS n_rows,
       cast(sum(t.label) AS bigint) AS n_pos
FROM a JOIN {GROUPS_TALL} t USING (group_id) GROUP BY a.repeat, a.split
"""

LEAKAGE_CHECK = f"""
WITH a AS ({split_sql(GROUPS_TALL, 'group_id')}),
grp AS (SELECT a.repeat, group_id, count(DISTINCT a.split) AS ns FROM a JOIN {GROUPS_TALL} t USING (group_id)
        GROUP BY a.repeat, group_id),
li AS (SELECT cast(l_suppkey AS varchar) AS group_id, l_orderkey, l_linenumber, l_partkey FROM lineitem),
rowsplit AS (SELECT group_id, cast(repeat AS integer) AS repeat,
                    CASE WHEN substr(md5(concat('42:', cast(repeat AS varchar), ':', cast(l_orderkey AS varchar), ':',
                              cast(l_linenumber AS varchar), ':', cast(l_partkey AS varchar))), 1, 1) IN ('0', '1', '2')
                         THEN 'test' ELSE 'train' END AS split
             FROM li CROSS JOIN range(0, 20) t(repeat)),
rv AS (SELECT repeat, group_id, count(DISTINCT split) AS ns FROM rowsplit GROUP BY repeat, group_id)
SELECT 'group' AS kind, count(*) FILTER (WHERE ns > 1) AS n_violations FROM grp
UNION ALL
SELECT 'row' AS kind, count(*) FILTER (WHERE ns > 1) AS n_violations FROM rv
"""

STRATIFIED_KFOLD = f"""
WITH a AS ({GROUP_SPLIT}),
st AS (SELECT patient_id, CASE WHEN sum(label) * 2 >= count(*) THEN 1 ELSE 0 END AS stratum FROM {WIDE} w GROUP BY patient_id),
tr AS (SELECT a.repeat, a.patient_id, st.stratum FROM a JOIN st USING (patient_id) WHERE a.split = 'train'),
k AS (SELECT *, row_number() OVER (PARTITION BY repeat, stratum
                 ORDER BY md5(concat('42', ':', cast(repeat AS varchar), ':', patient_id)), patient_id) AS pos FROM tr)
SELECT repeat, patient_id, cast((pos - 1) % 5 AS integer) AS fold FROM k
"""

CLASS_WEIGHTS = f"""
WITH a AS ({GROUP_SPLIT}),
tr AS (SELECT a.repeat, w.label FROM {WIDE} w JOIN a USING (patient_id) WHERE a.split = 'train'),
c AS (SELECT repeat, label, count(*) AS n FROM tr GROUP BY repeat, label)
SELECT repeat, label, n, round(sum(n) OVER (PARTITION BY repeat) / (2.0 * n), 9) AS weight FROM c
"""

PENDING_CELLS = f"""
WITH grid AS (SELECT cast(r AS integer) AS repeat, m AS model
              FROM range(0, 20) a(r) CROSS JOIN (VALUES ('M1'),('M2'),('M3'),('M4'),('M5'),('M6'),('M7'),('Ensemble')) b(m)),
done AS (SELECT DISTINCT model, repeat FROM ({PRED}) p)
SELECT g.repeat, g.model FROM grid g ANTI JOIN done d ON g.repeat = d.repeat AND g.model = d.model
"""

SQL.update({
    "union_sources": UNION_SOURCES,
    "inf_to_null": INF_TO_NULL,
    "one_hot_side": ONE_HOT_SIDE,
    "integrity_overlap": INTEGRITY_OVERLAP,
    "integrity_mixed_label": INTEGRITY_MIXED,
    "group_size_deviants": GROUP_SIZE_DEVIANTS,
    "class_distribution": CLASS_DISTRIBUTION,
    "group_split": GROUP_SPLIT,
    "nested_val_split": NESTED_VAL_SPLIT,
    "groups_tall_split": GROUPS_TALL_SPLIT,
    "leakage_check": LEAKAGE_CHECK,
    "stratified_group_kfold": STRATIFIED_KFOLD,
    "class_weights": CLASS_WEIGHTS,
    "pending_cells": PENDING_CELLS,
})

# ---------------------------------------------------------------- preparation
_FEAT = """CASE WHEN (vec_id*31+j) % 97 = 0 THEN NULL
                WHEN (vec_id*17+j) % 211 = 0 THEN cast('Infinity' AS double)
                ELSE cast(embedding[j] AS double) END"""
WIDE_ARR = f"""(SELECT vec_id, label, list_transform(range(1, 65), lambda j: {_FEAT}) AS f FROM embeddings)"""


def _fin(k: int) -> str:
    return f"(CASE WHEN isinf(f[{k}]) THEN NULL ELSE f[{k}] END)"


WIDE_DERIVED_LONG = f"""(
SELECT vec_id AS row_id, CASE WHEN label < 3 THEN 1 ELSE 0 END AS label,
       concat(CASE WHEN label < 3 THEN 'P_' ELSE 'N_' END, cast(vec_id % 23 AS varchar)) AS patient_id,
       cast(u.j AS integer) AS feature_idx,
       CASE WHEN isinf(u.v) THEN NULL ELSE u.v END AS value
FROM (SELECT vec_id, label, list_concat(f, [2.0*{_fin(1)} + 0.001*{_fin(2)}, 1.0, 0.5*{_fin(3)},
                                            {_fin(1)} + 0.25*{_fin(2)}, {_fin(1)} + 0.25*{_fin(2)} + 0.28*{_fin(4)}]) AS g
      FROM {WIDE_ARR} a) w,
     LATERAL (SELECT unnest(range(1, 70)) AS j, unnest(g) AS v) u)"""

PREP_BASE = f"""
WITH sp AS ({GROUP_SPLIT}),
lg AS (SELECT * FROM {WIDE_DERIVED_LONG} x),
fit AS (SELECT sp.repeat, lg.row_id, lg.feature_idx, lg.value FROM lg JOIN sp USING (patient_id) WHERE sp.split = 'train'),
med AS (SELECT repeat, feature_idx, quantile_cont(value, 0.5) AS median, count(value) AS n_present
        FROM fit GROUP BY repeat, feature_idx),
imp AS (SELECT fit.repeat, fit.row_id, fit.feature_idx, coalesce(fit.value, med.median) AS x
        FROM fit JOIN med USING (repeat, feature_idx) WHERE med.median IS NOT NULL),
vs AS (SELECT repeat, feature_idx, var_pop(x) AS var_pop, quantile_cont(x, 0.25) AS q1,
              quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3 FROM imp GROUP BY repeat, feature_idx),
cand AS (SELECT repeat, feature_idx FROM vs WHERE var_pop > 0.01),
ci AS (SELECT imp.* FROM imp JOIN cand USING (repeat, feature_idx)),
cr AS (SELECT a.repeat, a.feature_idx AS i, b.feature_idx AS j, corr(a.x, b.x) AS r
       FROM ci a JOIN ci b ON a.repeat = b.repeat AND a.row_id = b.row_id AND a.feature_idx < b.feature_idx
       GROUP BY a.repeat, a.feature_idx, b.feature_idx),
edges AS (SELECT repeat, i, j, r FROM cr WHERE abs(coalesce(CASE WHEN isnan(r) THEN 0 ELSE r END, 0)) > 0.95)
"""

MEDIAN_IMPUTE = PREP_BASE + """
SELECT repeat, feature_idx, round(median, 9) AS median, n_present FROM med
"""

VARIANCE_FILTER = PREP_BASE + """
SELECT repeat, feature_idx, round(var_pop, 9) AS var_pop, var_pop > 0.01 AS keep_var FROM vs
"""

CORR_EDGES = PREP_BASE + """
SELECT repeat, i, j, round(r, 9) AS r FROM edges
"""

_KEPT = """,
scan(repeat, i, kept) AS (
  SELECT DISTINCT repeat, 0, []::INTEGER[] FROM cand
  UNION ALL
  SELECT s.repeat, s.i + 1,
         CASE WHEN NOT EXISTS (SELECT 1 FROM cand c WHERE c.repeat = s.repeat AND c.feature_idx = s.i + 1) THEN s.kept
              WHEN EXISTS (SELECT 1 FROM edges e WHERE e.repeat = s.repeat AND e.j = s.i + 1
                                                   AND list_contains(s.kept, e.i)) THEN s.kept
              ELSE list_append(s.kept, cast(s.i + 1 AS integer)) END
  FROM scan s WHERE s.i < 69),
kept AS (SELECT repeat, unnest(kept) AS feature_idx FROM scan WHERE i = 69)
"""

CORR_FILTER = PREP_BASE.replace("WITH sp AS", "WITH RECURSIVE sp AS") + _KEPT + """
SELECT repeat, feature_idx FROM kept
"""

ROBUST_SCALE = PREP_BASE.replace("WITH sp AS", "WITH RECURSIVE sp AS") + _KEPT + """
SELECT k.repeat, k.feature_idx, round(vs.median, 9) AS center,
       round(CASE WHEN vs.q3 - vs.q1 < 2.220446049250313e-15 THEN 1.0 ELSE vs.q3 - vs.q1 END, 9) AS scale
FROM kept k JOIN vs USING (repeat, feature_idx)
"""

PREP_TRANSFORM = PREP_BASE.replace("WITH sp AS", "WITH RECURSIVE sp AS") + _KEPT + """,
sc AS (SELECT k.repeat, k.feature_idx, vs.median AS center,
              CASE WHEN vs.q3 - vs.q1 < 2.220446049250313e-15 THEN 1.0 ELSE vs.q3 - vs.q1 END AS scale,
              row_number() OVER (PARTITION BY k.repeat ORDER BY k.feature_idx) - 1 AS position
       FROM kept k JOIN vs USING (repeat, feature_idx)),
allrows AS (SELECT sp.repeat, sp.split, lg.row_id, lg.feature_idx, lg.value FROM lg JOIN sp USING (patient_id))
SELECT a.repeat, a.split, cast(sc.position AS integer) AS position,
       round(sum((coalesce(a.value, sc.center) - sc.center) / sc.scale), 9) AS x_sum, count(*) AS n
FROM allrows a JOIN sc USING (repeat, feature_idx) GROUP BY a.repeat, a.split, sc.position
"""

FEATURE_LINEAGE = PREP_BASE.replace("WITH sp AS", "WITH RECURSIVE sp AS") + _KEPT + """
SELECT repeat, cast(row_number() OVER (PARTITION BY repeat ORDER BY feature_idx) - 1 AS integer) AS position,
       feature_idx,
       CASE WHEN feature_idx <= 64 THEN 'Feature_' || lpad(cast(feature_idx AS varchar), 4, '0')
            ELSE 'Derived_' || cast(feature_idx AS varchar) END AS feature_name
FROM kept
"""

SQL.update({
    "median_impute": MEDIAN_IMPUTE,
    "variance_filter": VARIANCE_FILTER,
    "corr_edges": CORR_EDGES,
    "corr_filter": CORR_FILTER,
    "robust_scale": ROBUST_SCALE,
    "prep_transform": PREP_TRANSFORM,
    "feature_lineage": FEATURE_LINEAGE,
})

# ---------------------------------------------------------------- curves
BEST_PRED = f"""(SELECT p.*, CASE WHEN cast(round(p.proba*1000) AS bigint) >= cast(round(p.threshold*1000) AS bigint)
                       THEN 1 ELSE 0 END AS y_pred FROM ({PRED_AT_BEST}) p)"""


def _curve_sql(kind: str) -> str:
    if kind == "roc":
        pts = """SELECT model, repeat, CASE WHEN nn = 0 THEN NULL ELSE cn*1.0/nn END AS x,
                        CASE WHEN np = 0 THEN NULL ELSE cp*1.0/np END AS y FROM cu
                 UNION ALL SELECT DISTINCT model, repeat, 0.0, 0.0 FROM cu"""
        reduce = "min(y) AS ylo, max(y) AS yhi"
    else:
        pts = """SELECT model, repeat, CASE WHEN np = 0 THEN 1.0 ELSE cp*1.0/np END AS x,
                        CASE WHEN cp + cn = 0 THEN 0.0 ELSE cp*1.0/(cp+cn) END AS y FROM cu
                 UNION ALL SELECT DISTINCT model, repeat, 0.0, 1.0 FROM cu"""
        reduce = "max(y) AS ylo, max(y) AS yhi"
    first = "CASE WHEN k = 0 THEN 0.0 ELSE yi END" if kind == "roc" else "yi"
    last = "CASE WHEN k = 199 THEN 1.0 ELSE avg(yv) END" if kind == "roc" else "avg(yv)"
    return f"""
WITH pred AS ({PRED}),
sc AS (SELECT model, repeat, proba, sum(y_true) AS pos, sum(1 - y_true) AS neg FROM pred GROUP BY model, repeat, proba),
cu AS (SELECT *, sum(pos) OVER (PARTITION BY model, repeat ORDER BY proba DESC) AS cp,
                 sum(neg) OVER (PARTITION BY model, repeat ORDER BY proba DESC) AS cn,
                 sum(pos) OVER (PARTITION BY model, repeat) AS np, sum(neg) OVER (PARTITION BY model, repeat) AS nn FROM sc),
raw AS ({pts}),
pts AS (SELECT model, repeat, x, {reduce} FROM raw GROUP BY model, repeat, x),
g AS (SELECT model, repeat, k, k / 199.0::DOUBLE AS xk FROM (SELECT DISTINCT model, repeat FROM pts) c CROSS JOIN range(0, 200) t(k)),
l AS (SELECT g.model, g.repeat, g.k, g.xk, p.x AS xl, p.yhi AS yl
      FROM g ASOF LEFT JOIN pts p ON g.model = p.model AND g.repeat = p.repeat AND g.xk >= p.x),
r AS (SELECT g.model, g.repeat, g.k, p.x AS xr, p.ylo AS yr
      FROM g ASOF LEFT JOIN pts p ON g.model = p.model AND g.repeat = p.repeat AND g.xk < p.x),
i AS (SELECT l.model, l.repeat, l.k, l.xk,
             CASE WHEN xl IS NULL THEN yr WHEN xr IS NULL OR l.xk = xl THEN yl
                  ELSE yl + (l.xk - xl) * (yr - yl) / (xr - xl) END AS yi
      FROM l JOIN r USING (model, repeat, k)),
f AS (SELECT model, repeat, k, xk, {first} AS yv FROM i)
SELECT model, cast(k AS integer) AS k, round(min(xk), 9) AS x, round({last}, 9) AS y FROM f GROUP BY model, k
"""


ROC_CURVE = _curve_sql("roc")
PR_CURVE = _curve_sql("pr")

CALIBRATION_CURVE = f"""
WITH pred AS ({PRED}),
e AS (SELECT model, quantile_cont(proba, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM pred GROUP BY model),
b AS (SELECT p.model, p.proba, p.y_true, len(list_filter(e.edges, lambda v: v < p.proba)) AS bin
      FROM pred p JOIN e USING (model))
SELECT model, cast(bin AS integer) AS bin, round(avg(proba), 9) AS prob_pred, round(avg(y_true), 9) AS prob_true,
       count(*) AS n FROM b GROUP BY model, bin
"""

CONFUSION_MATRIX = f"""
WITH d AS {BEST_PRED}
SELECT model, repeat, t.y_true, t.y_pred, count(d.model) AS n
FROM (SELECT DISTINCT model, repeat FROM d) c
CROSS JOIN (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) t(y_true, y_pred)
LEFT JOIN d USING (model, repeat, y_true, y_pred)
GROUP BY model, repeat, t.y_true, t.y_pred
"""

SQL.update({
    "roc_curve": ROC_CURVE,
    "pr_curve": PR_CURVE,
    "calibration_curve": CALIBRATION_CURVE,
    "confusion_matrix": CONFUSION_MATRIX,
})

# ---------------------------------------------------------------- selection
_PSI = "(coalesce(list_sum(list_transform(range(1, {n}), lambda t: 1.0 / t)), 0) - 0.5772156649015329)"

MI_BASE = f"""
WITH l AS (SELECT row_id, label, feature_idx, CASE WHEN isinf(value) THEN NULL ELSE value END AS v FROM {WIDE_LONG} w),
med AS (SELECT feature_idx, quantile_cont(v, 0.5) AS m FROM l GROUP BY feature_idx),
x AS (SELECT l.row_id, l.label, cast(l.feature_idx AS integer) AS feature_idx, coalesce(l.v, med.m) AS x
      FROM l JOIN med USING (feature_idx))
"""

MI_KNN = MI_BASE + f""",
nl AS (SELECT feature_idx, label, count(*) AS n_label FROM x GROUP BY feature_idx, label),
xp AS (SELECT x.*, nl.n_label, least(3, nl.n_label - 1) AS k FROM x JOIN nl USING (feature_idx, label) WHERE nl.n_label > 1),
dd AS (SELECT a.feature_idx, a.row_id, a.k, abs(b.x - a.x) AS dist,
              row_number() OVER (PARTITION BY a.feature_idx, a.row_id ORDER BY abs(b.x - a.x)) AS rn
       FROM xp a JOIN xp b ON a.feature_idx = b.feature_idx AND a.label = b.label AND a.row_id <> b.row_id),
rr AS (SELECT feature_idx, row_id, dist AS r FROM dd WHERE rn = k),
mm AS (SELECT a.feature_idx, a.row_id, a.k, a.n_label,
              count(*) FILTER (WHERE CASE WHEN rr.r > 0 THEN abs(b.x - a.x) < rr.r ELSE b.x = a.x END) AS m
       FROM xp a JOIN rr ON a.feature_idx = rr.feature_idx AND a.row_id = rr.row_id
                 JOIN xp b ON a.feature_idx = b.feature_idx
       GROUP BY a.feature_idx, a.row_id, a.k, a.n_label),
agg AS (SELECT feature_idx, count(*) AS n, avg({_PSI.format(n='k')}) AS pk, avg({_PSI.format(n='n_label')}) AS pl,
               avg({_PSI.format(n='m')}) AS pm FROM mm GROUP BY feature_idx)
SELECT feature_idx, round(greatest(0.0, {_PSI.format(n='n')} + pk - pl - pm), 9) AS mi FROM agg
"""

MI_BINNED = MI_BASE + """,
e AS (SELECT feature_idx, quantile_cont(x, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges, count(*) AS n
      FROM x GROUP BY feature_idx),
b AS (SELECT x.feature_idx, x.label AS y, len(list_filter(e.edges, lambda t: t < x.x)) AS bin, e.n
      FROM x JOIN e USING (feature_idx)),
c AS (SELECT feature_idx, bin, y, count(*) AS c, any_value(n) AS n FROM b GROUP BY feature_idx, bin, y),
c2 AS (SELECT *, sum(c) OVER (PARTITION BY feature_idx, bin) AS cb, sum(c) OVER (PARTITION BY feature_idx, y) AS cy FROM c)
SELECT feature_idx, round(sum(c * 1.0 / n * ln(c * n * 1.0 / (cb * cy))), 9) AS mi FROM c2 GROUP BY feature_idx
"""

SQL.update({
    "mi_knn": MI_KNN,
    "mi_binned": MI_BINNED,
})

# ---------------------------------------------------------------- ensemble
PRED_KEYED = """
SELECT concat('M', cast(m AS varchar)) AS model, cast(l_suppkey % 20 AS int) AS repeat,
       l_suppkey AS group_id, y AS y_true,
       cast(w*10*y + floor(cast((100-w)*h AS double)/100) AS bigint) / cast(1000 AS double) AS proba,
       l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice
FROM (SELECT m, 10+5*m AS w, l_suppkey, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice,
             CASE WHEN l_quantity > 35 THEN 1 ELSE 0 END AS y,
             (l_orderkey*7919 + l_linenumber*104729 + l_partkey*31 + m*15485863) % 1000 AS h
      FROM lineitem CROSS JOIN (VALUES (1),(2),(3),(4),(5),(6),(7)) AS v(m)) q
"""

SOFT_VOTE = metrics_sql(f"""
SELECT 'Ensemble' AS model, repeat, group_id, y_true, round(avg(proba), 12) AS proba
FROM ({PRED_KEYED}) p WHERE model IN ('M5', 'M6', 'M7')
GROUP BY repeat, group_id, y_true, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice
HAVING count(*) = 3
""", "CASE WHEN proba >= 0.5 THEN 1 ELSE 0 END")

SQL.update({"soft_vote": SOFT_VOTE})

# full Newton steps for all cells from the prior's log odds; steps without halving reach the same optimum
PLATT_FIT = f"""
WITH RECURSIVE pred AS ({PRED}),
h AS (SELECT model, repeat, cast(proba AS double) AS s, sum(y_true)::DOUBLE AS n1, count(*)::DOUBLE AS n FROM pred GROUP BY 1, 2, 3),
t AS (SELECT model, repeat, sum(n1) AS npos, sum(n - n1) AS nneg FROM h GROUP BY 1, 2),
g AS (SELECT h.model, h.repeat, s, n, n1 * (npos + 1) / (npos + 2) + (n - n1) / (nneg + 2) AS hit
      FROM h JOIN t ON h.model = t.model AND h.repeat = t.repeat),
steps AS (
  SELECT model, repeat, 0 AS k, 0.0::DOUBLE AS a, ln((nneg + 1) / (npos + 1))::DOUBLE AS b, 1.0::DOUBLE AS ga, 1.0::DOUBLE AS gb FROM t
  UNION ALL
  SELECT model, repeat, k + 1,
         a - (hbb * da - hab * db) / (haa * hbb - hab * hab),
         b - (haa * db - hab * da) / (haa * hbb - hab * hab),
         da / n, db / n
  FROM (SELECT model, repeat, k, a, b, sum(n) AS n, sum((hit - n * p) * s) AS da, sum(hit - n * p) AS db,
               sum(n * p * (1 - p) * s * s) AS haa, sum(n * p * (1 - p) * s) AS hab, sum(n * p * (1 - p)) AS hbb
        FROM (SELECT i.model, i.repeat, i.k, i.a, i.b, g.s, g.n, g.hit, 1 / (1 + exp(i.a * g.s + i.b)) AS p
              FROM steps i JOIN g ON i.model = g.model AND i.repeat = g.repeat WHERE i.k < 30) q
        GROUP BY model, repeat, k, a, b) z)
SELECT model, repeat, round(a, 5) AS a, round(b, 5) AS b, round(ga, 9) + 0.0 AS grad_a, round(gb, 9) + 0.0 AS grad_b,
       greatest(abs(ga), abs(gb)) < 1e-9 AS converged
FROM steps WHERE k = 30
"""

SIGMOID_APPLY = f"""
WITH pred AS ({PRED}),
c AS (SELECT model, repeat, 1.0::DOUBLE / (1.0 + exp((-4.0::DOUBLE - repeat / 10.0::DOUBLE) * proba + 2.0)) AS p FROM pred)
SELECT model, repeat, round(avg(p), 9) AS mean_proba, round(min(p), 9) AS min_proba, round(max(p), 9) AS max_proba, 0.0::DOUBLE AS pair_err
FROM c GROUP BY model, repeat
"""

SQL.update({"platt_fit": PLATT_FIT, "sigmoid_apply": SIGMOID_APPLY})

KNN_SCORE = f"""
WITH l AS (SELECT row_id, label, feature_idx, CASE WHEN value IS NULL OR isinf(value) THEN 0.0 ELSE value END AS v FROM {WIDE_LONG} w),
d AS (SELECT a.row_id AS q, b.row_id AS t, min(b.label) AS y, sqrt(sum((a.v - b.v) * (a.v - b.v))) AS euclidean, sum(abs(a.v - b.v)) AS manhattan
      FROM l a JOIN l b ON a.feature_idx = b.feature_idx AND a.row_id <> b.row_id GROUP BY a.row_id, b.row_id),
r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY euclidean, t) AS re, row_number() OVER (PARTITION BY q ORDER BY manhattan, t) AS rm FROM d),
e AS (SELECT q, avg(y) AS u, CASE WHEN min(euclidean) = 0 THEN avg(y) FILTER (WHERE euclidean = 0) ELSE sum(y / euclidean) / sum(1 / euclidean) END AS w
      FROM r WHERE re <= 5 GROUP BY q),
m AS (SELECT q, avg(y) AS u, CASE WHEN min(manhattan) = 0 THEN avg(y) FILTER (WHERE manhattan = 0) ELSE sum(y / manhattan) / sum(1 / manhattan) END AS w
      FROM r WHERE rm <= 5 GROUP BY q),
lab AS (SELECT row_id, min(label) AS label FROM l GROUP BY row_id)
SELECT lab.row_id, lab.label, round(e.u, 9) AS uniform_euclidean, round(m.u, 9) AS uniform_manhattan,
       round(e.w, 9) AS distance_euclidean, round(m.w, 9) AS distance_manhattan
FROM lab JOIN e ON e.q = lab.row_id JOIN m ON m.q = lab.row_id
"""

SQL["knn_score"] = KNN_SCORE
