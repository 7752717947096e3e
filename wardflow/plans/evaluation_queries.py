"""Queries of the evaluation, survival, comparison and result operators."""

import uuid

from pyspark.sql import functions as F

from ..functions.segments import shared_folder
from ..operators import comparison as M, evaluation as E, survival as V
from .registry import cte, query

# Oracles use pairwise counting for AUC and unrolled Newton steps for the fits.
SRC = "(SELECT *, 1.0::DOUBLE AS one FROM predictions)"


def auc_sql(keys: str, source: str = SRC, w: str = "weights", score: str = "pred_probs") -> str:
    k = f"{keys}, " if keys else ""
    on = " AND ".join(f"a.{c.strip()} = b.{c.strip()}" for c in keys.split(",")) if keys else "TRUE"
    sel = ", ".join(f"a.{c.strip()} AS {c.strip()}" for c in keys.split(",")) + ", " if keys else ""
    grp = "GROUP BY " + ", ".join(f"a.{c.strip()}" for c in keys.split(",")) if keys else ""
    return f"""SELECT {sel}sum(a.{w} * b.{w} * CASE WHEN a.{score} > b.{score} THEN 1.0 WHEN a.{score} = b.{score} THEN 0.5 ELSE 0.0 END) / sum(a.{w} * b.{w}) AS auc FROM {source} a JOIN {source} b ON {on} WHERE a.labels = 1 AND b.labels = 0 {grp}"""


def rank_auc_sql(keys: str, source: str, w: str, score: str = "pred_probs") -> str:
    """AUC from running sums over distinct scores, for many strata."""
    return f"""SELECT {keys}, sum(pos * (upto - neg / 2)) / nullif(sum(pos) * sum(neg), 0) AS auc FROM (SELECT *, sum(neg) OVER (PARTITION BY {keys} ORDER BY s) AS upto FROM (
      SELECT {keys}, {score} AS s, sum({w} * labels)::DOUBLE AS pos, sum({w} * (1 - labels))::DOUBLE AS neg FROM {source} q GROUP BY {keys}, {score}) c) r GROUP BY {keys}"""


def ap_sql(keys: str, w: str = "weights") -> str:
    k = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys}" if keys else ""
    own = f"{part} ORDER BY pred_probs DESC"
    grp = f"GROUP BY {keys}" if keys else ""
    return f"""SELECT {k}sum(pos / p * tp / (tp + fp)) FILTER (WHERE pos > 0) AS auprc, sum(pos / p * tp / (tp + pi / (1 - pi) * fp)) FILTER (WHERE pos > 0) AS auprc_calibrated FROM (
      SELECT *, sum(pos) OVER ({own}) AS tp, sum(neg) OVER ({own}) AS fp, sum(pos) OVER ({part}) AS p, sum(ones) OVER ({part}) / sum(cnt) OVER ({part}) AS pi FROM (
       SELECT {k}pred_probs, sum({w} * labels) AS pos, sum({w} * (1 - labels)) AS neg, sum(labels) AS ones, count(*) AS cnt FROM {SRC} s GROUP BY {k}pred_probs) q) z {grp}"""


def mean_sql(keys: str, w: str = "weights", source: str = SRC) -> str:
    k = f"{keys}, " if keys else ""
    return f"""SELECT {k}sum({w} * (pred_probs - labels) ** 2) / sum({w}) AS brier, sum({w} * -(labels * ln(pred_probs) + (1 - labels) * ln(1 - pred_probs))) / sum({w}) AS loss_bce, sum({w} * pred_probs) / sum({w}) AS mean_prediction,
      sum({w} * pred_probs) FILTER (WHERE labels = 1) / sum({w}) FILTER (WHERE labels = 1) AS mean_prediction_1, sum({w} * pred_probs) FILTER (WHERE labels = 0) / sum({w}) FILTER (WHERE labels = 0) AS mean_prediction_0,
      sum({w} * labels) / sum({w}) AS outcome_rate FROM {source} s {'GROUP BY ' + keys if keys else ''}"""


def long_sql(keys: str, w: str = "weights", metrics=E.METRICS) -> str:
    using = f"me LEFT JOIN ap USING ({keys}) LEFT JOIN au USING ({keys})" if keys else "me, ap, au"
    k = f"{keys}, " if keys else ""
    filled = "coalesce(auc, -1.0) AS auc, coalesce(auprc, 0.0) AS auprc, CASE WHEN auc IS NULL THEN -1.0 ELSE auprc_calibrated END AS auprc_calibrated"
    head = f"WITH au AS ({auc_sql(keys, w=w)}), ap AS ({ap_sql(keys, w)}), me AS ({mean_sql(keys, w)}), wide AS (SELECT * REPLACE ({filled}) FROM {using}) "
    return head + " UNION ALL ".join(f"SELECT {k}'{m}' AS metric, CAST({m} AS DOUBLE) AS performance FROM wide" for m in metrics)


R = lambda df, *cols: df.select(*[F.round(c, 6).alias(c) if c in cols else c for c in df.columns])
ROUND = lambda sql, *cols: f"SELECT * REPLACE ({', '.join(f'round({c}, 6) AS {c}' for c in cols)}) FROM ({sql}) rr"


@query("evl_01_metrics_by_stratum", ROUND(long_sql("grp"), "performance"))
def _(t):
    return R(E.evaluate(t.predictions, ["grp"], "weights"), "performance")


@query("evl_02_groups_and_overall", ROUND(f"""SELECT * FROM ({long_sql('grp')}) a UNION ALL SELECT 'overall' AS grp, metric, performance FROM ({long_sql('')}) b
  UNION ALL SELECT 'min', metric, min(performance) FROM ({long_sql('grp')}) c GROUP BY metric UNION ALL SELECT 'max', metric, max(performance) FROM ({long_sql('grp')}) d GROUP BY metric""", "performance"))
def _(t):
    return R(E.evaluate_groups(t.predictions, [], "grp", "weights"), "performance")


@query("evl_03_auroc", ROUND(auc_sql("site", w="one"), "auc") + " UNION ALL SELECT site, -1.0 FROM predictions GROUP BY site HAVING min(labels) = max(labels)")
def _(t):
    return R(E.ranking_metrics(t.predictions, ["site"]).select("site", "auc"), "auc")


@query("evl_04_average_precision", ROUND(f"SELECT grp, coalesce(auprc, 0.0) AS auprc FROM ({ap_sql('grp', 'one')}) x", "auprc"))
def _(t):
    return R(E.ranking_metrics(t.predictions, ["grp"]).select("grp", "auprc"), "auprc")


@query("evl_05_calibrated_average_precision", ROUND(f"SELECT g.grp, CASE WHEN y.auc IS NULL THEN -1.0 ELSE x.auprc_calibrated END AS auprc_calibrated FROM (SELECT DISTINCT grp FROM predictions) g LEFT JOIN ({ap_sql('grp')}) x USING (grp) LEFT JOIN ({auc_sql('grp')}) y USING (grp)", "auprc_calibrated"))
def _(t):
    return R(E.ranking_metrics(t.predictions, ["grp"], "weights").select("grp", "auprc_calibrated"), "auprc_calibrated")


@query("evl_06_brier_and_log_loss", ROUND(f"SELECT grp, brier, loss_bce FROM ({mean_sql('grp')}) x", "brier", "loss_bce"))
def _(t):
    return R(E.mean_metrics(t.predictions, ["grp"], "weights").select("grp", "brier", "loss_bce"), "brier", "loss_bce")


def edges_sql(quantile: bool, n: int, unit: bool = False) -> str:
    if quantile:
        return f"SELECT quantile_cont(pred_probs, [{', '.join(str(i / n) for i in range(n + 1))}]) AS e FROM predictions"
    if unit:
        return f"SELECT [{', '.join(str(i / n) for i in range(n + 1))}]::DOUBLE[] AS e"
    lo, hi = "min(pred_probs)", "max(pred_probs)"
    return f"SELECT [{', '.join(f'{lo} + ({hi} - {lo}) * {i / n}' for i in range(n + 1))}]::DOUBLE[] AS e FROM predictions"


def bins_sql(quantile: bool, n: int, unit: bool = False, op: str = "<") -> str:
    return f"SELECT p.*, len(list_filter(e[2:{n}], lambda x: x {op} pred_probs)) AS bin_id FROM predictions p, ({edges_sql(quantile, n, unit)}) q"


def ece_sql(quantile: bool, n: int) -> str:
    parts = {"abs": "sum(abs(p - y) * c) / sum(c)", "squared": "sum((p - y) ** 2 * c) / sum(c)", "rmse": "sqrt(sum((p - y) ** 2 * c) / sum(c))", "signed": "sum((p - y) * c) / sum(c)"}
    base = f"(SELECT bin_id, avg(pred_probs) AS p, avg(labels) AS y, count(*) AS c FROM ({bins_sql(quantile, n)}) b GROUP BY 1) z"
    return " UNION ALL ".join(f"SELECT '{v}' AS variant, {quantile} AS quantile, {x} AS performance FROM {base}" for v, x in parts.items())


@query("evl_07_expected_calibration_error", ROUND(ece_sql(False, 10) + " UNION ALL " + ece_sql(True, 10), "performance"))
def _(t):
    preds = t.stored("predictions", lambda t: t.predictions)
    frames = [E.expected_calibration_error(preds, [], 10, v, q).select(F.lit(v).alias("variant"), F.lit(q).alias("quantile"), "performance")
              for q in (False, True) for v in ("abs", "squared", "rmse", "signed")]
    return R(E.union_all(frames), "performance")


@query("evl_08_pointwise_calibration_error", ROUND(f"""SELECT sqrt(sum((pred_probs - rate) ** 2 * weights) / sum(weights)) AS performance FROM (SELECT *, sum(labels * weights) OVER (PARTITION BY bin_id) / sum(weights) OVER (PARTITION BY bin_id) AS rate FROM ({bins_sql(False, 10)}) b) z""", "performance"))
def _(t):
    return R(E.pointwise_calibration_error(t.predictions, [], "weights", 10, "rmse"), "performance")


TRANSFORMS = {None: "pred_probs", "logit": "ln(pred_probs / (1 - pred_probs))", "log": "ln(pred_probs)", "c_log_log": "ln(-ln(1 - pred_probs))"}


def fit_sql(key: str, name, w: str = "weights", steps: int = 12, source: str = "predictions") -> str:
    """Newton steps written out; returns CTE text ending in ``fit<steps>(key, a, b, converged)``."""
    x = TRANSFORMS[name]
    text = [f"d AS (SELECT {key} AS k, {x} AS x, {w} AS w, labels AS y FROM {source})", "fit0 AS (SELECT DISTINCT k, 0.0::DOUBLE AS a, 0.0::DOUBLE AS b FROM d)"]
    for i in range(steps):
        text.append(f"""s{i} AS (SELECT k, any_value(a) AS a, any_value(b) AS b, sum(w * (y - p)) AS ga, sum(w * (y - p) * x) AS gb, sum(w * p * (1 - p)) AS haa, sum(w * p * (1 - p) * x) AS hab, sum(w * p * (1 - p) * x * x) AS hbb
          FROM (SELECT d.*, a, b, 1 / (1 + exp(-(a + b * x))) AS p FROM d JOIN fit{i} USING (k)) q GROUP BY k)""")
        text.append(f"""fit{i + 1} AS (SELECT k, a + da AS a, b + db AS b, greatest(abs(da), abs(db)) < 1e-7 AS converged FROM (SELECT *, (hbb * ga - hab * gb) / (haa * hbb - hab * hab) AS da,
          (haa * gb - hab * ga) / (haa * hbb - hab * hab) AS db FROM s{i}) t)""")
    return ", ".join(text)


DENS = "1 / (1 + exp(-(a + b * x)))"


@query("evl_09_absolute_calibration_error", ROUND(" UNION ALL ".join(f"""SELECT * FROM (WITH {fit_sql('grp', n)} SELECT '{n or 'raw'}' AS transform, k AS grp, sum(w * abs({DENS} - pr)) / sum(w) AS performance, bool_and(converged) AS converged
  FROM (SELECT grp AS k, {x} AS x, weights AS w, pred_probs AS pr FROM predictions) q JOIN fit12 USING (k) GROUP BY k) t{i}""" for i, (n, x) in enumerate(TRANSFORMS.items())), "performance"))
def _(t):
    return R(E.absolute_calibration_errors(t.predictions, ["grp"], "weights", tuple(TRANSFORMS)).drop("status"), "performance")


@query("evl_09_absolute_calibration_error_bins", ROUND(f"""SELECT sum(weights * abs(rate - pred_probs)) / sum(weights) AS performance, TRUE AS converged FROM (SELECT *, sum(labels * weights) OVER (PARTITION BY bin_id) / sum(weights) OVER (PARTITION BY bin_id) AS rate FROM ({bins_sql(True, 10, op='<=')}) b) z""", "performance"))
def _(t):
    return R(E.absolute_calibration_error(t.predictions, [], "weights", model="bin"), "performance")


@query("evl_10_threshold_calibration_error", ROUND(f"WITH {fit_sql('grp', 'logit')} SELECT k AS grp, th AS threshold, 1 / (1 + exp(-(a + b * ln(th / (1 - th))))) - th AS performance, converged FROM fit12, (VALUES (0.1::DOUBLE), (0.3::DOUBLE)) v(th)", "performance"))
def _(t):
    return R(E.threshold_calibration_error(t.predictions, [0.1, 0.3], ["grp"], "weights"), "performance")


@query("evl_11_relative_calibration_error", ROUND(f"""SELECT g.grp, g.rce, g.ace, g.converged FROM (WITH {fit_sql('grp', 'logit')}, o AS (SELECT a AS a0, b AS b0, converged AS c0 FROM (WITH {fit_sql("'all'", 'logit')} SELECT a, b, converged FROM fit12) oo)
  SELECT k AS grp, sum(w * abs({DENS} - 1 / (1 + exp(-(a0 + b0 * x))))) / sum(w) AS rce, sum(w * abs({DENS} - pr)) / sum(w) AS ace, bool_and(converged AND c0) AS converged FROM (SELECT grp AS k, {TRANSFORMS['logit']} AS x, weights AS w, pred_probs AS pr FROM predictions) q JOIN fit12 USING (k), o GROUP BY k) g""", "rce", "ace"))
def _(t):
    return R(E.relative_calibration_error(t.predictions, "grp", "weights", compute_ace=True), "rce", "ace")


@query("evl_12_calibration_curve", f"""WITH {fit_sql('grp', 'logit')} SELECT k AS grp, round(s, 6) AS score, round(1 / (1 + exp(-(a + b * ln(s / (1 - s))))), 6) AS calibration_density, converged FROM fit12, (SELECT 1e-4 + i * ((1 - 2e-4) / 999) AS s FROM range(0, 1000) r(i)) g""")
def _(t):
    return R(E.calibration_curve(t.predictions, ["grp"], "weights"), "score", "calibration_density")


def curve_sql(n: int, quantile: bool) -> str:
    return f"""SELECT {n} AS n_bins, {quantile} AS quantile, bin_id, prob_true, prob_pred, n, sum(abs(prob_true - prob_pred) * n) OVER () / sum(n) OVER () AS ece FROM (SELECT bin_id, avg(labels) AS prob_true, avg(pred_probs) AS prob_pred, count(*) AS n FROM ({bins_sql(quantile, n, True)}) b GROUP BY 1) z"""


@query("evl_13_calibration_bins", ROUND(" UNION ALL ".join(f"SELECT * FROM ({curve_sql(n, q)}) c{n}{int(q)}" for n in (5, 10) for q in (False, True)), "prob_true", "prob_pred", "ece"))
def _(t):
    frames = [E.calibration_bins(t.predictions, [], n, q).select(F.lit(n).alias("n_bins"), F.lit(q).alias("quantile"), "bin_id", "prob_true", "prob_pred", "n", "ece")
              for n in (5, 10) for q in (False, True)]
    return R(E.union_all(frames), "prob_true", "prob_pred", "ece")


TH = "(VALUES (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE)) v(threshold)"
_ratio = lambda a, b: f"coalesce(sum(weights) FILTER (WHERE {a}), 0) / sum(weights) FILTER (WHERE {b})"
cte("thr", f"""SELECT grp, threshold, {_ratio('pred_probs >= threshold AND labels = 1', 'labels = 1')} AS recall, {_ratio('pred_probs >= threshold AND labels = 1', 'pred_probs >= threshold')} AS precision,
  {_ratio('pred_probs < threshold AND labels = 0', 'labels = 0')} AS specificity, {_ratio('pred_probs >= threshold AND labels = 0', 'labels = 0')} AS fpr, {_ratio('pred_probs >= threshold', 'TRUE')} AS positive_rate FROM predictions, {TH} GROUP BY 1, 2""")


@query("evl_14_threshold_metrics", ROUND("SELECT grp, threshold, recall, precision, specificity FROM thr", "recall", "precision", "specificity"))
def _(t):
    return R(E.threshold_metrics(t.predictions, [0.25, 0.5, 0.75], ["grp"], "weights").select("grp", "threshold", "recall", "precision", "specificity"), "recall", "precision", "specificity")


@query("evl_15_mean_predictions", ROUND(f"SELECT grp, mean_prediction, mean_prediction_1, mean_prediction_0, outcome_rate FROM ({mean_sql('grp')}) x", "mean_prediction", "mean_prediction_1", "mean_prediction_0", "outcome_rate"))
def _(t):
    cols = ["mean_prediction", "mean_prediction_1", "mean_prediction_0", "outcome_rate"]
    return R(E.mean_metrics(t.predictions, ["grp"], "weights").select("grp", *cols), *cols)


@query("evl_16_one_versus_all", ROUND(f"SELECT grp, a.metric, a.performance - b.performance AS performance FROM ({long_sql('grp')}) a JOIN ({long_sql('')}) b USING (metric)", "performance"))
def _(t):
    return R(E.one_versus_all(t.predictions, "grp", [], "weights"), "performance")


def xauc_sql(label: int, excluding: bool) -> str:
    mine, other = ("a", "b") if label == 1 else ("b", "a")
    cond = f"{mine}.grp = g.grp" + (f" AND {other}.grp <> g.grp" if excluding else "")
    return f"""SELECT g.grp, sum(a.weights * b.weights * CASE WHEN a.pred_probs > b.pred_probs THEN 1.0 WHEN a.pred_probs = b.pred_probs THEN 0.5 ELSE 0.0 END) / sum(a.weights * b.weights) AS v
      FROM (SELECT DISTINCT grp FROM predictions) g, predictions a, predictions b WHERE a.labels = 1 AND b.labels = 0 AND {cond} GROUP BY 1"""


@query("evl_17_cross_auc", ROUND(f"""SELECT grp, coalesce(x1.v, -1) AS xauc_1, coalesce(x0.v, -1) AS xauc_0, coalesce(e1.v, -1) AS xauc_1_excluding, coalesce(e0.v, -1) AS xauc_0_excluding FROM (SELECT DISTINCT grp FROM predictions) g
  LEFT JOIN ({xauc_sql(1, False)}) x1 USING (grp) LEFT JOIN ({xauc_sql(0, False)}) x0 USING (grp) LEFT JOIN ({xauc_sql(1, True)}) e1 USING (grp) LEFT JOIN ({xauc_sql(0, True)}) e0 USING (grp)""",
       "xauc_1", "xauc_0", "xauc_1_excluding", "xauc_0_excluding"))
def _(t):
    return R(E.cross_auc(t.predictions, "grp", "weights"), "xauc_1", "xauc_0", "xauc_1_excluding", "xauc_0_excluding")


EMD = "SELECT grp, sum(step * abs(coalesce(gw, 0) / gt - aw / at_)) AS emd FROM (SELECT g.grp, s.step, s.v, (SELECT sum(weights) FROM p WHERE grp = g.grp AND pred_probs <= s.v) AS gw, (SELECT sum(weights) FROM p WHERE grp = g.grp) AS gt, (SELECT sum(weights) FROM p WHERE pred_probs <= s.v) AS aw, (SELECT sum(weights) FROM p) AS at_ FROM (SELECT DISTINCT grp FROM p) g, s WHERE step IS NOT NULL) z GROUP BY 1"


@query("evl_18_earth_movers", ROUND(" UNION ALL ".join(f"SELECT '{n}' AS scope, grp, emd FROM (WITH p AS (SELECT * FROM predictions WHERE {w}), s AS (SELECT v, lead(v) OVER (ORDER BY v) - v AS step FROM (SELECT DISTINCT pred_probs AS v FROM p) q) {EMD}) {n}x" for n, w in (("every", "TRUE"), ("positive", "labels = 1"))), "emd"))
def _(t):
    a = E.earth_movers(t.predictions, "grp", "weights").select(F.lit("every").alias("scope"), "grp", "emd")
    b = E.earth_movers(t.predictions, "grp", "weights", 1).select(F.lit("positive").alias("scope"), "grp", "emd")
    return R(a.unionByName(b), "emd")


# ---- bootstrap -----------------------------------------------------------------

#: Replicates of the comparisons and of the curves.
NB, CURVES = 1000, 10
H15 = lambda k: f"CAST('0x' || substr(md5({k}), 1, 15) AS BIGINT)"


def draws_sql(unit: str, source: str, strata: str = "", seed: int = 0, n_boot: int = NB) -> str:
    k = f"{strata}, " if strata else ""
    part = f"PARTITION BY {strata}" if strata else ""
    s_text = f"CAST({strata} AS VARCHAR) || '|' || " if strata else ""
    using = f"({strata}, rk)" if strata else "(rk)"
    return f"""SELECT boot_id, {k}{unit}, draws FROM (SELECT b AS boot_id, {k}{H15(f"'{seed}|' || CAST(b AS VARCHAR) || '|' || {s_text}CAST(rk AS VARCHAR)")} % n AS rk, count(*) AS draws FROM (
       SELECT *, row_number() OVER ({part} ORDER BY md5('{seed}|' || CAST({unit} AS VARCHAR))) - 1 AS rk, count(*) OVER ({part}) AS n FROM (SELECT DISTINCT {k}{unit} FROM {source}) u) r, range(0, {n_boot}) x(b) GROUP BY ALL) d
      JOIN (SELECT {k}{unit}, row_number() OVER ({part} ORDER BY md5('{seed}|' || CAST({unit} AS VARCHAR))) - 1 AS rk FROM (SELECT DISTINCT {k}{unit} FROM {source}) u) m USING {using}"""


cte("boots", draws_sql("person_id", "predictions", "labels"))


@query("evl_19_bootstrap_draws", "SELECT * FROM boots")
def _(t):
    return E.boot_counts(t.predictions, NB, ["labels"])


cte("stack", "SELECT *, 'model' AS arm FROM predictions UNION ALL SELECT * REPLACE (base_probs AS pred_probs), 'base' AS arm FROM predictions")
BROWS = "(SELECT s.*, draws * weights AS bw, boot_id FROM stack s JOIN boots USING (person_id, labels))"
cte("bootres", f"SELECT arm, boot_id, 'auc' AS metric, auc AS performance FROM ({rank_auc_sql('arm, boot_id', BROWS, 'bw')}) a UNION ALL SELECT arm, boot_id, 'brier', sum(bw * (pred_probs - labels) ** 2) / sum(bw) FROM {BROWS} z GROUP BY 1, 2")


@query("evl_19_bootstrap_evaluate", ROUND("""SELECT arm, metric, part, quantile_cont(value, 0.025) AS CI_lower, quantile_cont(value, 0.5) AS CI_med, quantile_cont(value, 0.975) AS CI_upper FROM (
   SELECT arm, metric, 'comparator' AS part, performance AS value FROM bootres UNION ALL SELECT a.arm, a.metric, 'baseline', b.performance FROM bootres a JOIN bootres b USING (metric, boot_id) WHERE b.arm = 'base'
   UNION ALL SELECT a.arm, a.metric, 'delta', a.performance - b.performance FROM bootres a JOIN bootres b USING (metric, boot_id) WHERE b.arm = 'base') q GROUP BY 1, 2, 3""", "CI_lower", "CI_med", "CI_upper"))
def _(t):
    arms = F.array(F.struct(F.lit("model").alias("arm"), F.col("pred_probs").alias("_s")), F.struct(F.lit("base").alias("arm"), F.col("base_probs").alias("_s")))
    stacked = t.predictions.select("*", F.inline(arms)).withColumn("pred_probs", F.col("_s")).drop("_s")
    out = E.bootstrap_evaluate(stacked, NB, ["arm"], ["labels"], "weights", experiment="arm", baseline="base")
    return R(out, "CI_lower", "CI_med", "CI_upper")


cte("cboots", draws_sql("person_id", "predictions", "labels", n_boot=CURVES))
CROWS = "(SELECT p.*, c.draws * p.weights AS bw, c.boot_id FROM predictions p JOIN cboots c USING (person_id, labels))"


@query("evl_20_bootstrap_calibration_curve", ROUND(f"""SELECT grp, score, quantile_cont(v, 0.025) AS CI_lower, quantile_cont(v, 0.5) AS CI_med, quantile_cont(v, 0.975) AS CI_upper, count(*) AS n_converged
  FROM (WITH {fit_sql("grp || '|' || boot_id", 'logit', 'bw', source=CROWS)} SELECT string_split(k, '|')[1] AS grp, s AS score, 1 / (1 + exp(-(a + b * ln(s / (1 - s))))) AS v FROM fit12,
   (SELECT 1e-4 + i * ((1 - 2e-4) / 999) AS s FROM range(0, 1000) r(i)) g WHERE converged) z GROUP BY 1, 2""", "score", "CI_lower", "CI_med", "CI_upper"))
def _(t):
    out = E.bootstrap_calibration_curve(t.predictions, CURVES, ["grp"], ["labels"], "weights", points=1000)
    return R(out, "score", "CI_lower", "CI_med", "CI_upper")


@query("evl_21_group_rates", ROUND("SELECT grp, threshold, recall AS tpr, fpr, positive_rate, precision FROM thr WHERE threshold = 0.5", "tpr", "fpr", "positive_rate", "precision"))
def _(t):
    out = E.threshold_metrics(t.predictions, [0.5], ["grp"], "weights").withColumnRenamed("recall", "tpr").drop("specificity")
    return R(out, "tpr", "fpr", "positive_rate", "precision")


@query("evl_22_baselined_loss", ROUND(f"SELECT grp, auc, loss_bce + outcome_rate * ln(outcome_rate) + (1 - outcome_rate) * ln(1 - outcome_rate) AS baselined_loss FROM ({auc_sql('grp')}) a JOIN ({mean_sql('grp')}) m USING (grp)", "auc", "baselined_loss"))
def _(t):
    return R(E.baselined(t.predictions, "grp", "weights"), "auc", "baselined_loss")


@query("evl_23_size_adjustments", ROUND("SELECT grp, sqrt(sum(weights) / (SELECT sum(weights) FROM predictions)) AS adjustment, 1 / sqrt(sum(weights) / (SELECT sum(weights) FROM predictions)) AS reciprocal FROM predictions GROUP BY 1", "adjustment", "reciprocal"))
def _(t):
    return R(E.size_adjustments(t.predictions, "grp", "weights"), "adjustment", "reciprocal")


# ---- survival ------------------------------------------------------------------

cte("surv", """SELECT v.visit_occurrence_id AS row_id, CAST(date_diff('hour', visit_start_datetime, visit_end_datetime) AS DOUBLE) AS hours, CASE WHEN discharge_to_concept_id = 4216643 THEN 1 ELSE 0 END AS event FROM visit_occurrence v WHERE visit_concept_id IN (9201, 262)""")
cte("surv_edges", "SELECT list_sort(list_distinct(list_concat([0.0, 'inf'::DOUBLE], quantile_cont(hours, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0])))) AS e FROM surv WHERE event = 1")
cte("surv_bin", "SELECT s.*, len(list_filter(e, lambda x: x <= hours)) - 1 AS time_bin FROM surv s, surv_edges")
cte("haz", "SELECT row_id, b AS bin, -2 + ((row_id * 7 + b * 3) % 11) / 5.0 AS logit FROM surv, range(0, 7) r(b)")


def survival_rows(t):
    v = t.visit_occurrence.where(F.col("visit_concept_id").isin(9201, 262))
    from ..functions.timeunits import diff_hours

    rows = v.select(F.col("visit_occurrence_id").alias("row_id"), diff_hours("visit_end_datetime", "visit_start_datetime").cast("double").alias("hours"),
                    (F.col("discharge_to_concept_id") == 4216643).cast("int").alias("event"))
    return V.time_bin(rows, "hours", V.time_edges(rows.where("event = 1"), "hours", 5))


def hazards(t):
    rows = t.visit_occurrence.where(F.col("visit_concept_id").isin(9201, 262)).select(F.col("visit_occurrence_id").alias("row_id"))
    bins = rows.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(6))))
    return bins.withColumn("logit", -2 + ((F.col("row_id") * 7 + F.col("bin") * 3) % 11) / 5.0)


@query("srv_01_time_bins", "SELECT * FROM surv_bin")
def _(t):
    return survival_rows(t)


@query("srv_01_unique_edges", """SELECT s.*, len(list_filter(e, lambda x: x <= hours)) - 1 AS time_bin FROM surv s, (SELECT list_distinct(list_concat([0.0], list(DISTINCT hours))) AS e FROM surv WHERE event = 1) q""")
def _(t):
    rows = survival_rows(t).drop("time_bin")
    return V.time_bin_unique(rows, rows.where("event = 1"), "hours")


@query("srv_02_survival_at_times", ROUND("SELECT s.row_id, exp(sum(-ln(1 + exp(logit)))) AS survival FROM surv_bin s JOIN haz h ON h.row_id = s.row_id AND h.bin <= s.time_bin GROUP BY 1", "survival"))
def _(t):
    return R(V.survival_at(V.survival_curve(hazards(t)), survival_rows(t)), "survival")


@query("srv_03_discrete_time_loss", ROUND("SELECT avg(l) AS loss FROM (SELECT s.row_id, sum(CASE WHEN h.bin = s.time_bin AND event = 1 THEN ln(1 + exp(-logit)) ELSE ln(1 + exp(logit)) END) AS l FROM surv_bin s JOIN haz h ON h.row_id = s.row_id AND h.bin <= s.time_bin GROUP BY 1) q", "loss"))
def _(t):
    return R(V.discrete_time_loss(hazards(t), survival_rows(t)), "loss")


# ---- comparison of models ------------------------------------------------------

cte("al", """SELECT row_id AS prediction_id, task, labels, t AS treatment, c AS control FROM (SELECT row_id, unnest(['quality', 'toxic', 'mixed']) AS task, unnest([labels, other_label, CASE WHEN row_id % 3 = 0 THEN NULL ELSE greatest(labels - other_label, 0) END]) AS labels,
  unnest([pred_probs, pred_probs * 0.5 + base_probs * 0.5, pred_probs]) AS t, unnest([base_probs, base_probs, base_probs * 0.9 + pred_probs * 0.1]) AS c FROM predictions) q WHERE labels IS NOT NULL""")


def aligned(t):
    p, b, w = F.col("pred_probs"), F.col("base_probs"), F.col("row_id")
    task = lambda n, y, a, c: F.struct(F.lit(n).alias("task"), y.cast("int").alias("labels"), a.alias("t"), c.alias("c"))
    mixed = F.when(w % 3 != 0, F.greatest(F.col("labels") - F.col("other_label"), F.lit(0)))
    rows = t.predictions.select(F.col("row_id").alias("prediction_id"), F.inline(F.array(
        task("quality", F.col("labels"), p, b), task("toxic", F.col("other_label"), p * 0.5 + b * 0.5, b), task("mixed", mixed, p, b * 0.9 + p * 0.1))))
    pick = lambda c: rows.select("prediction_id", "task", F.col(c).alias("value"))
    return M.align(pick("t"), pick("c"), rows.select("prediction_id", "task", "labels"))


cte("bal", f"SELECT a.*, boot_id, draws FROM al a JOIN ({draws_sql('prediction_id', 'al', seed=444)}) d USING (prediction_id)")
cte("bauc", f"""SELECT boot_id, task, x.auc AS treatment, y.auc AS control FROM ({rank_auc_sql('boot_id, task', 'bal', 'draws', 'treatment')}) x JOIN ({rank_auc_sql('boot_id, task', 'bal', 'draws', 'control')}) y USING (boot_id, task)""")
cte("tdraw", f"""SELECT boot_id, task, times FROM (SELECT b AS boot_id, {H15("'444|task|' || CAST(b AS VARCHAR) || '|' || CAST(i AS VARCHAR)")} % 3 AS i, count(*) AS times FROM range(0, {NB}) x(b), range(0, 3) y(i) GROUP BY ALL) d
  JOIN (SELECT task, row_number() OVER (ORDER BY task) - 1 AS i FROM (SELECT DISTINCT task FROM al) q) m USING (i)""")
cte("mdiff", "SELECT boot_id, sum((treatment - control) * times) / sum(times) AS diff FROM bauc JOIN tdraw USING (boot_id, task) GROUP BY 1")
cte("fullsc", f"""SELECT task, x.auc AS treatment, y.auc AS control FROM (SELECT task, auc FROM ({auc_sql('task', '(SELECT *, 1.0 AS one FROM al)', 'one', 'treatment')}) u) x JOIN (SELECT task, auc FROM ({auc_sql('task', '(SELECT *, 1.0 AS one FROM al)', 'one', 'control')}) v) y USING (task)""")
cte("rdiff", "SELECT boot_id, sum((treatment - control) * times) / sum(times) AS diff FROM fullsc JOIN tdraw USING (task) GROUP BY 1")
_sum = lambda src, share: f"SELECT 2 * least(avg({share}), 1 - avg({share})) AS p_value, avg(diff) AS mean_diff, quantile_cont(diff, 0.025) AS CI_lower, quantile_cont(diff, 0.975) AS CI_upper FROM {src}"
SUP = "CASE WHEN diff <= 0 THEN 1.0 ELSE 0.0 END"
NON = "CASE WHEN diff < -0.05 * (SELECT avg(control) FROM fullsc) THEN 1.0 WHEN diff = -0.05 * (SELECT avg(control) FROM fullsc) THEN 0.5 ELSE 0.0 END"
STATS = ("p_value", "mean_diff", "CI_lower", "CI_upper")


@query("stt_01_multi_bootstrap", ROUND("SELECT * FROM mdiff", "diff"))
def _(t):
    return R(M.multi_bootstrap(aligned(t), NB), "diff")


@query("stt_02_superiority", ROUND(_sum("mdiff", SUP), *STATS))
def _(t):
    return R(M.superiority(M.multi_bootstrap(aligned(t), NB)), *STATS)


@query("stt_03_noninferiority", ROUND(_sum("mdiff", NON), *STATS))
def _(t):
    rows = aligned(t)
    return R(M.noninferiority(M.multi_bootstrap(rows, NB), M.task_scores(rows)), *STATS)


@query("stt_04_task_bootstrap", "SELECT 'superiority' AS test, * FROM (" + ROUND(_sum("rdiff", SUP), *STATS) + ") a UNION ALL SELECT 'noninferiority', * FROM (" + ROUND(_sum("rdiff", NON), *STATS) + ") b")
def _(t):
    scores = M.task_scores(aligned(t))
    diffs = M.durable(M.task_bootstrap(scores, scores, NB))
    a = R(M.superiority(diffs), *STATS).select(F.lit("superiority").alias("test"), *STATS)
    return a.unionByName(R(M.noninferiority(diffs, scores), *STATS).select(F.lit("noninferiority").alias("test"), *STATS))


@query("stt_05_aligned_predictions", ROUND("SELECT * FROM al", "treatment", "control"))
def _(t):
    return R(aligned(t), "treatment", "control")


@query("res_01_wide_predictions", "SELECT prediction_id, " + ", ".join(f"max(round(treatment, 6)) FILTER (WHERE task = '{n}') AS {n}" for n in ("quality", "toxic", "mixed")) + " FROM al GROUP BY 1")
def _(t):
    return M.wide_predictions(aligned(t).select("prediction_id", "task", F.round("treatment", 6).alias("value")), ["quality", "toxic", "mixed"])


@query("res_02_result_table", ROUND("SELECT metric, avg(performance) AS mean, quantile_cont(performance, 0.25) AS q25, quantile_cont(performance, 0.5) AS median, quantile_cont(performance, 0.75) AS q75 FROM (" + long_sql("grp") + ") z GROUP BY 1", "mean", "q25", "median", "q75"))
def _(t):
    return R(M.result_table(E.evaluate(t.predictions, ["grp"], "weights"), ["metric"]), "mean", "q25", "median", "q75")


@query("res_03_row_set_difference", """SELECT person_id, 'left' AS side FROM (SELECT person_id FROM person EXCEPT SELECT person_id FROM death) a UNION ALL SELECT person_id, 'right' FROM (SELECT person_id FROM death EXCEPT SELECT person_id FROM person) b""")
def _(t):
    return M.row_set_difference(t.person.select("person_id"), t.death.select("person_id"))


@query("res_01_collated_files", "SELECT 'long' AS run, grp AS model, metric, performance FROM (" + ROUND(long_sql("grp"), "performance") + ") a UNION ALL SELECT 'short', grp, metric, performance FROM (" + ROUND(long_sql("grp", "one"), "performance") + ") b")
def _(t):
    """Result files of two runs, written apart with their tags in the path and collated."""
    path = f"{shared_folder(t.spark)}/results-{uuid.uuid4().hex}"
    for run, weight in (("long", "weights"), ("short", None)):
        found = R(E.evaluate(t.predictions, ["grp"], weight), "performance").withColumnRenamed("grp", "model")
        found.write.partitionBy("model").option("header", True).csv(f"{path}/run={run}")
    return M.collate(t.spark, path, "metric string, performance double, run string, model string").select("run", "model", "metric", "performance")
