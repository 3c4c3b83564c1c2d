"""Queries on profiles, features, models, metrics and explanations."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart import schemas as S
from sparkmart.functions import encode as N
from sparkmart.operators import explain, features, metrics, models
from sparkmart.operators import profiling as P
from sparkmart.plans.catalogue import VIEWS, register
from sparkmart.plans.oracle_base import sql_list
from sparkmart.plans.workspace import Workspace
from sparkmart.session import scratch_folder

KEY = "module_presentation_student_week_id"


def profiled(w: Workspace) -> DataFrame:
    """The training presentation, which is what gets profiled and fitted on."""
    return w.train_frame().filter(F.col("code_presentation") == models.TRAIN)


VIEWS["profiled"] = "SELECT * FROM train WHERE code_presentation = '2013B'"

# -------------------------------------------------------------------- profiling

register(
    "e01_class_balance",
    lambda w: P.class_balance(profiled(w)).select("label", "n", F.round("rate", 6).alias("rate")),
    """SELECT CASE WHEN final_result = 'Fail' THEN 1 ELSE 0 END AS label, count(*) AS n,
         round(count(*) / sum(count(*)) OVER (), 6) AS rate FROM profiled GROUP BY 1""",
)
_TRAIN_COLUMNS = [*S.FEATURE_TYPES, "final_result"]
register(
    "e02_missing_values",
    lambda w: P.missing_values(profiled(w)).withColumn("missing_rate", F.round("missing_rate", 6)),
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) - count({c}) AS missing,
            round((count(*) - count({c})) / count(*), 6) AS missing_rate FROM profiled"""
        for c in _TRAIN_COLUMNS
    ),
)
register(
    "e03_category_counts",
    lambda w: P.category_counts(profiled(w)),
    "SELECT *, count(*) OVER (PARTITION BY column_name) AS cardinality FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n FROM profiled GROUP BY {c}"
        for c in S.CATEGORICALS
    )
    + ")",
)


def _rounded(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if c in columns else F.col(c) for c in df.columns])


register(
    "e04_describe",
    lambda w: _rounded(P.describe(profiled(w)), ["mean", "std", "q25", "q50", "q75"]),
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS "count", round(avg({c}), 6) AS mean,
            round(stddev_samp({c}), 6) AS std, min({c}) AS "min", round(quantile_cont({c}, 0.25), 6) AS q25,
            round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75, max({c}) AS "max"
            FROM profiled"""
        for c in S.PROFILE_NUMERIC
    ),
)
register(
    "e05_box_statistics",
    lambda w: P.box_statistics(profiled(w)),
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, q25, q50, q75,
            (SELECT min({c}) FROM profiled WHERE {c} BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25)) AS whisker_low,
            (SELECT max({c}) FROM profiled WHERE {c} BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25)) AS whisker_high,
            (SELECT count(*) FROM profiled WHERE {c} NOT BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25)) AS outliers
            FROM (SELECT CAST(quantile_cont({c}, 0.25) AS DOUBLE) AS q25, CAST(quantile_cont({c}, 0.5) AS DOUBLE) AS q50,
                         CAST(quantile_cont({c}, 0.75) AS DOUBLE) AS q75 FROM profiled)"""
        for c in S.PROFILE_NUMERIC
    ),
)
register(
    "e06_histogram",
    lambda w: P.histogram(profiled(w)),
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CAST(CASE WHEN high > low THEN least(floor(({c} - low) * 20 / (high - low)), 19)
            ELSE 0 END AS INTEGER) AS bin, count(*) AS n
            FROM profiled, (SELECT min({c}) AS low, max({c}) AS high FROM profiled) GROUP BY ALL"""
        for c in S.PROFILE_NUMERIC
    ),
)


def _code_sql(column: str) -> str:
    if column == "final_result":
        return "CASE WHEN final_result = 'Fail' THEN 1 ELSE 0 END AS final_result"
    if column in P.ENCODED:
        return f"nullif(list_position([{sql_list(P.ENCODED[column])}], {column}), 0) - 1 AS {column}"
    return column


VIEWS["coded"] = f"SELECT {', '.join(_code_sql(c) for c in P.CORRELATED)} FROM profiled"


def _ranks_sql(columns: list[str], where: str) -> str:
    ranks = ", ".join(
        f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in columns
    )
    return f"SELECT {ranks} FROM coded WHERE {where}"


_COMPLETE = [c for c in P.CORRELATED if c != "imd_band"]
VIEWS["ranks_complete"] = _ranks_sql(_COMPLETE, "true")
VIEWS["ranks_known"] = _ranks_sql(P.CORRELATED, "imd_band IS NOT NULL")
VIEWS["spearman_matrix"] = " UNION ALL ".join(
    f"""SELECT '{a}' AS column_1, '{b}' AS column_2, round(CASE WHEN isnan(r) THEN NULL ELSE r END, 6) AS r
        FROM (SELECT corr({a}, {b}) AS r FROM {'ranks_known' if 'imd_band' in (a, b) else 'ranks_complete'})"""
    for a, b in combinations(P.CORRELATED, 2)
)


def _matrix(w: Workspace) -> DataFrame:
    return P.spearman(profiled(w)).withColumn("r", F.round("r", 6))


register("e07_spearman_matrix", _matrix, "SELECT * FROM spearman_matrix")
register(
    "e08_correlation_bands",
    lambda w: P.correlation_bands(_matrix(w)),
    """SELECT CASE WHEN column_1 = 'final_result' THEN column_2 ELSE column_1 END AS column_name, r,
         CASE WHEN abs(r) >= 0.7 THEN 'very strong' WHEN abs(r) >= 0.5 THEN 'strong' WHEN abs(r) >= 0.3 THEN 'medium'
              WHEN abs(r) >= 0.1 THEN 'weak' ELSE 'very weak' END AS band
       FROM spearman_matrix WHERE 'final_result' IN (column_1, column_2)""",
)
register(
    "o03_strong_pairs",
    lambda w: P.strong_pairs(_matrix(w)),
    """SELECT column_1, column_2, r, CASE WHEN abs(r) >= 0.9 THEN 'very strong' ELSE 'strong' END AS band
       FROM spearman_matrix WHERE abs(r) >= 0.7""",
)

# --------------------------------------------------------------------- features

VIEWS["engineered"] = """
SELECT *, CAST(row_number() OVER (PARTITION BY id_student, code_module, code_presentation, block ORDER BY week_no)
         - CASE WHEN block > 0 THEN 1 ELSE 0 END AS BIGINT) AS inactive_streak_weeks
FROM (SELECT *, CAST(coalesce(click_count_week - lag(click_count_week) OVER s, 0) AS DOUBLE) AS click_delta_1w,
        CASE WHEN coursework_due_count_to_week > 0
             THEN coursework_overdue_count_to_week / coursework_due_count_to_week ELSE 0.0 END AS coursework_overdue_rate,
        sum(CASE WHEN click_count_week <> 0 THEN 1 ELSE 0 END) OVER s AS block
      FROM train WINDOW s AS (PARTITION BY id_student, code_module, code_presentation ORDER BY week_no))"""


def _engineered(w: Workspace) -> DataFrame:
    return features.build_features(w.train_frame())


register(
    "f01_engineered_features",
    lambda w: _engineered(w).select(
        KEY, "click_delta_1w", F.col("inactive_streak_weeks").cast("bigint").alias("inactive_streak_weeks"),
        F.round("coursework_overdue_rate", 6).alias("coursework_overdue_rate"),
    ),
    f"""SELECT {KEY}, click_delta_1w, inactive_streak_weeks, round(coursework_overdue_rate, 6) AS coursework_overdue_rate
        FROM engineered""",
)
register(
    "f01_not_finite",
    lambda w: features.not_finite(_engineered(w)),
    " UNION ALL ".join(
        f"""SELECT '{c} not finite' AS "check", count(*) FILTER ({c} IS NULL OR NOT isfinite(CAST({c} AS DOUBLE))) AS violations
            FROM engineered""" for c in S.ENGINEERED
    ),
)
register(
    "w04_click_change",
    lambda w: _engineered(w).select(KEY, "click_delta_1w"),
    f"SELECT {KEY}, click_delta_1w FROM engineered",
)
register(
    "w05_inactive_streak",
    lambda w: _engineered(w).select(
        KEY, F.col("inactive_streak_weeks").cast("bigint").alias("inactive_streak_weeks")
    ),
    f"SELECT {KEY}, inactive_streak_weeks FROM engineered",
)
register(
    "p27_zero_safe_ratio",
    lambda w: w.predict_frame().select(
        KEY,
        F.round(
            N.ratio_or_zero(F.col("coursework_late_count_to_week"), F.col("coursework_submitted_count_to_week")), 6
        ).alias("late_rate"),
    ),
    f"""SELECT {KEY}, round(CASE WHEN coursework_submitted_count_to_week > 0
          THEN coursework_late_count_to_week / coursework_submitted_count_to_week ELSE 0.0 END, 6) AS late_rate
        FROM predict""",
)
_INPUTS = features.FULL.columns
register(
    "f02_model_columns",
    lambda w: w.train_frame().select(*_INPUTS),
    f"SELECT {', '.join(_INPUTS)} FROM train",
)


def _inputs(w: Workspace, feature_set: features.FeatureSet, frame: DataFrame) -> tuple[DataFrame, list[str]]:
    """Fitted on the training presentation, applied to all rows."""
    train = frame.filter(F.col("code_presentation") == models.TRAIN)
    fitted = features.fit_preprocessor(train, feature_set)
    return fitted.transform(frame), fitted.names


def _group(w: Workspace, prefix: str) -> DataFrame:
    """One group of model inputs per row, named by plain column names."""
    df, names = _inputs(w, features.FULL, w.train_frame())
    wanted = [n for n in names if n.startswith(prefix)]
    return df.select(
        KEY, *[F.round(f"`{n}`", 6).alias(n.split("__")[1].lower().replace(" ", "_")) for n in wanted]
    )


_MEANS = {
    c: f"(SELECT avg(nullif(list_position([{sql_list(v)}], {c}), 0) - 1) FROM profiled)" for c, v in S.ORDINALS.items()
}
_SEEN = "(SELECT DISTINCT {c} AS v FROM profiled)"
_ONE_HOT = ", ".join(
    # A region that the fixture's training presentation never holds gets no column.
    f"CASE WHEN region = '{r}' THEN 1.0 ELSE 0.0 END AS \"region_{r.lower().replace(' ', '_')}\"" for r in S.REGIONS
)
_BINARY = "CASE WHEN gender = 'M' THEN 1.0 ELSE 0.0 END AS gender_m, CASE WHEN disability = 'Y' THEN 1.0 ELSE 0.0 END AS disability_y"


def _one_hot(w: Workspace) -> DataFrame:
    """One-hot columns as (feature, label) sums, which need no fixed category list."""
    df, names = _inputs(w, features.FULL, w.train_frame())
    wanted = [n for n in names if n.startswith("categorical__")]
    totals = df.groupBy("code_presentation").agg(*[F.sum(f"`{n}`").alias(n) for n in wanted])
    long = totals.unpivot(["code_presentation"], [f"`{n}`" for n in wanted], "feature", "rows")
    return long.select("code_presentation", "feature", F.col("rows").cast("bigint").alias("rows"))


register(
    "f03_one_hot",
    _one_hot,
    """SELECT t.code_presentation, 'categorical__' || k.name AS feature,
         count(*) FILTER (k.v = CASE k.c WHEN 'gender' THEN t.gender WHEN 'region' THEN t.region ELSE t.disability END) AS rows
       FROM train t, (
         SELECT c, v, c || '_' || v AS name FROM (
           SELECT c, v, row_number() OVER (PARTITION BY c ORDER BY v) AS i, count(*) OVER (PARTITION BY c) AS k
           FROM (SELECT DISTINCT 'gender' AS c, gender AS v FROM profiled UNION SELECT 'region', region FROM profiled
                 UNION SELECT 'disability', disability FROM profiled))
         WHERE k <> 2 OR i = 2) k
       GROUP BY ALL""",
)
register(
    "f04_f05_ordinal_and_missing",
    lambda w: _group(w, "ordinal__"),
    f"SELECT {KEY}, "
    + ", ".join(
        f"round(CAST(coalesce(nullif(list_position([{sql_list(v)}], {c}), 0) - 1, {_MEANS[c]}) AS DOUBLE), 6) AS {c}"
        for c, v in S.ORDINALS.items()
    )
    + ", CASE WHEN imd_band IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS missingindicator_imd_band FROM train",
)
register(
    "f06_standardised_numbers",
    lambda w: _group(w, "numeric__"),
    f"SELECT {KEY}, "
    + ", ".join(
        f"""round(({c} - (SELECT avg({c}) FROM profiled)) / (SELECT coalesce(nullif(stddev_pop({c}), 0), 1) FROM profiled), 6)
            AS {c}""" for c in S.MODEL_NUMERIC
    )
    + " FROM train",
)


def _assembled(w: Workspace, feature_set: features.FeatureSet, frame: DataFrame) -> DataFrame:
    """Vector length and position-weighted sum per row of the assembled features."""
    train = models.labelled(frame).filter(F.col("code_presentation") == models.TRAIN)
    fitted = features.fit_preprocessor(train, feature_set)
    vectors = models.vectors(models.labelled(frame), fitted)
    from pyspark.ml.functions import vector_to_array

    values = vector_to_array("features")
    return vectors.select("week_no", "label", F.size(values).alias("width"), F.round(
        F.aggregate(values, F.lit(0.0), lambda a, b: a + b), 4).alias("total"))


register("f07_assembled_vectors", lambda w: _assembled(w, features.FULL, w.train_frame()))
register("f08_basic_vectors", lambda w: _assembled(w, features.BASIC, w.train_frame()))
register("f08_extended_vectors", lambda w: _assembled(w, features.EXTENDED, _engineered(w)))

# ---------------------------------------------------------- metrics on a fixed score

# The score used to check metrics against SQL.
FIXED_INTERCEPT = -1.0
FIXED_WEIGHTS = {
    "coursework_overdue_count_to_week": 0.6,
    "active_day_count_to_week": -0.02,
    "coursework_submitted_count_to_week": -0.03,
}


def fixed_score(frame: DataFrame) -> DataFrame:
    """Label and a score that needs no fitting, rounded to six decimals."""
    margin = F.lit(FIXED_INTERCEPT)
    for column, weight in FIXED_WEIGHTS.items():
        margin = margin + F.lit(weight) * F.col(column)
    score = F.round(1 / (1 + F.exp(-margin)), 6)
    return frame.withColumn("score", score).withColumn(
        "label", N.target_code(F.col("final_result")) if "final_result" in frame.columns else F.lit(None)
    )


_MARGIN = " + ".join(f"{weight} * {column}" for column, weight in FIXED_WEIGHTS.items())
_SCORE = f"round(1 / (1 + exp(-(CAST({FIXED_INTERCEPT} AS DOUBLE) + {_MARGIN}))), 6)"
VIEWS["scored"] = (
    f"SELECT *, {_SCORE} AS score, CASE WHEN final_result = 'Fail' THEN 1 ELSE 0 END AS label FROM train"
)
VIEWS["held_out"] = "SELECT * FROM scored WHERE code_presentation = '2013J'"


def scored(w: Workspace) -> DataFrame:
    return fixed_score(w.train_frame())


def held_out(w: Workspace) -> DataFrame:
    return scored(w).filter(F.col("code_presentation") == models.VALIDATION)


_METRICS = [
    "fail_rate", "recall_fail", "precision_fail", "f1_fail", "f2_fail", "average_precision", "accuracy", "brier_score",
]


def metrics_sql(view: str, slices: list[str]) -> str:
    """All metrics per slice of a view with label and score."""
    keys = "".join(f"{c}, " for c in slices)
    partition = f"PARTITION BY {', '.join(slices)}" if slices else ""
    group = f"GROUP BY {', '.join(slices)}" if slices else ""
    using = f"USING ({', '.join(slices)})" if slices else "ON true"
    return f"""
SELECT {keys}sample_count, round(pos / sample_count, 6) AS fail_rate,
  round(coalesce(tp / nullif(pos, 0), 0), 6) AS recall_fail,
  round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision_fail,
  round(coalesce(2 * tp / nullif(2 * tp + fp + pos - tp, 0), 0), 6) AS f1_fail,
  round(coalesce(5 * tp / nullif(5 * tp + fp + 4 * (pos - tp), 0), 0), 6) AS f2_fail,
  round(coalesce(ap, 0), 6) AS average_precision,
  round((tp + sample_count - pos - fp) / sample_count, 6) AS accuracy, round(brier, 6) AS brier_score
FROM (SELECT {keys}count(*) AS sample_count, sum(label) AS pos, count(*) FILTER (score >= 0.5 AND label = 1) AS tp,
        count(*) FILTER (score >= 0.5 AND label = 0) AS fp, avg((score - label) ** 2) AS brier FROM {view} {group})
JOIN (SELECT {keys}sum(pos * (cum_pos / cum_n)) / nullif(sum(pos), 0) AS ap
      FROM (SELECT {keys}score, sum(label) AS pos, sum(sum(label)) OVER o AS cum_pos, sum(count(*)) OVER o AS cum_n
            FROM {view} GROUP BY {keys}score WINDOW o AS ({partition} ORDER BY score DESC))
      {group}) {using}"""


register(
    "k01_metric_inputs",
    lambda w: metrics.input_problems(held_out(w)),
    """SELECT 'label' AS "check", count(*) FILTER (label IS NULL OR label NOT IN (0, 1)) AS violations FROM held_out
       UNION ALL SELECT 'score', count(*) FILTER (score IS NULL OR score NOT BETWEEN 0 AND 1) FROM held_out
       UNION ALL SELECT 'threshold', 0""",
)
for _name, _slices in (
    ("k02_k04_overall_metrics", []),
    ("k08_metrics_by_week", ["week_no"]),
    ("k09_metrics_by_module", ["code_module"]),
    ("k03_metrics_by_presentation", ["code_presentation"]),
):
    _view = "scored" if _slices == ["code_presentation"] else "held_out"
    register(
        _name,
        lambda w, s=_slices, v=_view: _rounded(
            metrics.evaluate(scored(w) if v == "scored" else held_out(w), s), _METRICS
        ),
        metrics_sql(_view, _slices),
    )
register(
    "k05_confusion_matrix",
    lambda w: metrics.confusion(held_out(w)),
    "SELECT label, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS predicted, count(*) AS n FROM held_out GROUP BY ALL",
)
_CURVE = """SELECT score, sum(sum(label)) OVER o AS cum_pos, sum(count(*)) OVER o AS cum_n, sum(sum(label)) OVER () AS pos
            FROM held_out GROUP BY score WINDOW o AS (ORDER BY score DESC)"""
register(
    "k06_precision_recall_curve",
    lambda w: _rounded(metrics.precision_recall_curve(held_out(w)), ["precision", "recall"]),
    f"""SELECT score AS threshold, round(cum_pos / cum_n, 6) AS precision, round(cum_pos / pos, 6) AS recall FROM ({_CURVE})
        UNION ALL SELECT NULL, 1.0, 0.0""",
)
register(
    "w07_cumulative_counts_by_score",
    lambda w: metrics.ranked_scores(scored(w), ["code_presentation"]),
    """SELECT code_presentation, score, count(*) AS n, CAST(sum(label) AS BIGINT) AS pos,
         CAST(sum(count(*)) OVER o AS BIGINT) AS cum_n, CAST(sum(sum(label)) OVER o AS BIGINT) AS cum_pos
       FROM scored GROUP BY code_presentation, score
       WINDOW o AS (PARTITION BY code_presentation ORDER BY score DESC)""",
)
register(
    "k07_calibration",
    lambda w: _rounded(metrics.calibration(held_out(w)), ["mean_score", "observed_rate"]),
    """SELECT CAST(len(list_filter(edges, lambda e: e < score)) AS INTEGER) AS bin, count(*) AS n,
         round(avg(score), 6) AS mean_score, round(avg(label), 6) AS observed_rate
       FROM held_out, (SELECT quantile_cont(score, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM held_out)
       GROUP BY ALL""",
)
VIEWS["sweep"] = """
SELECT t / 100.0 AS threshold, coalesce(tp / nullif(pos, 0), 0) AS recall_fail,
  coalesce(tp / nullif(tp + fp, 0), 0) AS precision_fail,
  coalesce(2 * tp / nullif(2 * tp + fp + pos - tp, 0), 0) AS f1_fail,
  coalesce(5 * tp / nullif(5 * tp + fp + 4 * (pos - tp), 0), 0) AS f2_fail
FROM (SELECT t, sum(label) AS pos, count(*) FILTER (score >= t / 100.0 AND label = 1) AS tp,
        count(*) FILTER (score >= t / 100.0 AND label = 0) AS fp
      FROM held_out, range(1, 100) AS r(t) GROUP BY t)"""
_RATES = ["recall_fail", "precision_fail", "f1_fail", "f2_fail"]
_RATES_SQL = ", ".join(f"round({c}, 6) AS {c}" for c in _RATES)
register(
    "k10_threshold_sweep",
    lambda w: _rounded(metrics.threshold_sweep(held_out(w)), _RATES),
    f"SELECT CAST(threshold AS DOUBLE) AS threshold, {_RATES_SQL} FROM sweep",
)
register(
    "o02_best_threshold",
    lambda w: _rounded(
        metrics.best_threshold(metrics.threshold_sweep(held_out(w)), least_precision=0.3), _RATES
    ),
    f"""SELECT CAST(threshold AS DOUBLE) AS threshold, {_RATES_SQL} FROM sweep WHERE precision_fail >= 0.3
        ORDER BY sweep.f2_fail DESC, sweep.recall_fail DESC, threshold LIMIT 1""",
)


def _inverted(df: DataFrame) -> DataFrame:
    return df.withColumn("score", F.round(1 - F.col("score"), 6))


VIEWS["inverted"] = "SELECT * REPLACE (round(1 - score, 6) AS score) FROM held_out"
register(
    "k11_model_comparison",
    lambda w: _rounded(
        metrics.compare({"score": held_out(w), "inverted": _inverted(held_out(w))}), _METRICS
    ),
    f"""SELECT 'score' AS model, * FROM ({metrics_sql('held_out', [])})
        UNION ALL SELECT 'inverted' AS model, * FROM ({metrics_sql('inverted', [])})""",
)
register(
    "p25_risk_label",
    lambda w: fixed_score(w.predict_frame()).select(KEY, N.risk_label(F.col("score")).alias("predict_result")),
    f"SELECT {KEY}, CASE WHEN {_SCORE} >= 0.5 THEN 'Fail' ELSE 'Not Fail' END AS predict_result FROM predict",
)
register(
    "p26_rounded_and_text_values",
    lambda w: fixed_score(w.predict_frame()).select(
        KEY, F.round("score", 4).alias("score"), F.col("imd_band").alias("imd_band"),
        F.col("studied_credits").cast("string").alias("studied_credits"),
    ),
    f"SELECT {KEY}, CAST(CAST(CAST({_SCORE} AS DECIMAL(18,6)) AS DECIMAL(18,4)) AS DOUBLE) AS score, imd_band, CAST(studied_credits AS VARCHAR) AS studied_credits FROM predict",
)

# ------------------------------------------------------------------------ models

register(
    "l01_most_frequent_baseline",
    lambda w: _rounded(
        metrics.evaluate(
            models.most_frequent(profiled(w), w.train_frame().filter(F.col("code_presentation") == models.VALIDATION))
        ),
        _METRICS,
    ),
    metrics_sql(
        "(SELECT label, (SELECT CAST(mode(label) AS DOUBLE) FROM scored WHERE code_presentation = '2013B') AS score FROM held_out)",
        [],
    ),
)
register(
    "l05_class_weights",
    lambda w: models.class_weights(models.labelled(profiled(w))).select(
        F.col("label").cast("int").alias("label"), F.round("weight", 6).alias("weight")
    ),
    """SELECT CASE WHEN final_result = 'Fail' THEN 1 ELSE 0 END AS label,
         round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight FROM profiled GROUP BY 1""",
)


def _overfit_fixed(w: Workspace) -> DataFrame:
    frame = w.train_frame()
    splits = {
        "Train": frame.filter(F.col("code_presentation") == models.TRAIN),
        "Validation": frame.filter(F.col("code_presentation") == models.VALIDATION),
    }
    scorers = {"score": fixed_score, "inverted": lambda df: _inverted(fixed_score(df))}
    return _rounded(
        models.overfit_table(scorers, splits), ["average_precision", "f1_fail", "brier_score"]
    )


VIEWS["trained_on"] = "SELECT * FROM scored WHERE code_presentation = '2013B'"
VIEWS["trained_on_inverted"] = "SELECT * REPLACE (round(1 - score, 6) AS score) FROM trained_on"
register(
    "l08_overfit_table",
    _overfit_fixed,
    " UNION ALL ".join(
        f"""SELECT '{m}' AS model, '{s}' AS split, average_precision, f1_fail, brier_score FROM ({metrics_sql(v, [])})"""
        for m, s, v in (
            ("score", "Train", "trained_on"), ("score", "Validation", "held_out"),
            ("inverted", "Train", "trained_on_inverted"), ("inverted", "Validation", "inverted"),
        )
    ),
)


def _evaluated(
    w: Workspace, setting: models.Setting, feature_set: features.FeatureSet = features.FULL,
    slices: list[str] | None = None, final: bool = False,
) -> DataFrame:
    """Fit on train (or train and validation) and evaluate on validation (or test)."""
    frame = w.train_frame()
    if feature_set is features.EXTENDED:
        frame = features.build_features(frame)
    train, validation, test = models.temporal_split(frame)
    fitted_on = train.unionByName(validation) if final else train
    model = models.fit(fitted_on, setting, feature_set)
    result = models.scored(model, models.labelled(test if final else validation))
    return _rounded(metrics.evaluate(result, slices), _METRICS)


register("l02_logistic_basic", lambda w: _evaluated(w, models.LogisticSetting(), features.BASIC))
register("l02_logistic_full", lambda w: _evaluated(w, models.LogisticSetting()))
register("l02_logistic_extended", lambda w: _evaluated(w, models.LogisticSetting(), features.EXTENDED))
register("l02_logistic_tuned", lambda w: _evaluated(w, models.LOGISTIC_TUNED))
register("l03_random_forest", lambda w: _evaluated(w, models.ForestSetting()))
register("l04_boosted_trees", lambda w: _evaluated(w, models.BoostingSetting()))
register("l09_final_model_by_week", lambda w: _evaluated(w, models.BOOSTING_TUNED, slices=["week_no"], final=True))


def _search_table(w: Workspace, settings: list[models.Setting]) -> DataFrame:
    train, validation, _ = models.temporal_split(w.train_frame())
    found = models.search(train, validation, settings, parallelism=8)
    rows = [(str(setting), float(f2), rank) for rank, (setting, f2) in enumerate(found, start=1)]
    return w.spark.createDataFrame(rows, "setting string, f2_fail double, rank int")


register("l06_logistic_grid", lambda w: _search_table(w, models.logistic_grid()))

# ------------------------------------------------------------------ explanations

register(
    "o09_seeded_sample",
    lambda w: explain.seeded_sample(w.train_frame(), KEY, explain.DEMO_ROWS).select(KEY),
    f"SELECT {KEY} FROM train ORDER BY md5(CAST({KEY} AS VARCHAR) || ':42'), {KEY} LIMIT 1000",
)

# A linear model over encoded, ordinal and numeric inputs.
LINEAR = {
    "categorical__gender_M": 0.15,
    "categorical__disability_Y": 0.25,
    "ordinal__imd_band": -0.05,
    "ordinal__missingindicator_imd_band": 0.4,
    "numeric__active_day_count_to_week": -0.7,
    "numeric__coursework_overdue_count_to_week": 0.9,
}


def _linear_parts(w: Workspace) -> tuple[features.Preprocessor, list[features.Feature], dict[str, Column]]:
    """Preprocessing, features and contributions of the fixed linear model against the sampled background."""
    train = profiled(w)
    fitted = features.fit_preprocessor(train)
    used = [f for f in fitted.features if f.full_name in LINEAR]
    background = fitted.transform(explain.seeded_sample(train, KEY, explain.BACKGROUND_ROWS))
    means = explain.background_means(background, list(LINEAR))
    return fitted, used, explain.linear_contributions(LINEAR, means)


def linear_explained(w: Workspace) -> DataFrame:
    """Predict rows with fixed linear contributions."""
    fitted, used, contributions = _linear_parts(w)
    scored_rows = fixed_score(fitted.transform(w.predict_frame()))
    return scored_rows.withColumn(
        "factors", explain.top_factors(used, [contributions[f.full_name] for f in used])
    ).withColumn("contribution_sum", sum(contributions.values(), F.lit(0.0)))


def _standard(column: str) -> str:
    return (
        f"({column} - (SELECT avg({column}) FROM profiled)) / (SELECT stddev_pop({column}) FROM profiled)"
    )


_IMD = f"nullif(list_position([{sql_list(S.IMD_BANDS)}], imd_band), 0) - 1"
_LINEAR_INPUTS = {
    "gender_M": "CASE WHEN gender = 'M' THEN 1.0 ELSE 0.0 END",
    "disability_Y": "CASE WHEN disability = 'Y' THEN 1.0 ELSE 0.0 END",
    "imd_band": f"coalesce({_IMD}, {_MEANS['imd_band']})",
    "missingindicator_imd_band": "CASE WHEN imd_band IS NULL THEN 1.0 ELSE 0.0 END",
    "active_day_count_to_week": _standard("active_day_count_to_week"),
    "coursework_overdue_count_to_week": _standard("coursework_overdue_count_to_week"),
}
_LINEAR_COLUMNS = ", ".join(f'{sql} AS "x_{name}"' for name, sql in _LINEAR_INPUTS.items())
VIEWS["linear_background"] = (
    f"SELECT {_LINEAR_COLUMNS} FROM (SELECT * FROM profiled "
    f"ORDER BY md5(CAST({KEY} AS VARCHAR) || ':42'), {KEY} LIMIT 100)"
)
VIEWS["linear_rows"] = f"SELECT *, {_SCORE} AS score, {_LINEAR_COLUMNS} FROM predict"
_VALUES = {
    "gender_M": "CAST(CAST(x_gender_M AS INTEGER) AS VARCHAR)",
    "disability_Y": "CAST(CAST(x_disability_Y AS INTEGER) AS VARCHAR)",
    "imd_band": "imd_band",
    "missingindicator_imd_band": "CAST(CAST(x_missingindicator_imd_band AS INTEGER) AS VARCHAR)",
    "active_day_count_to_week": "CAST(active_day_count_to_week AS VARCHAR)",
    "coursework_overdue_count_to_week": "CAST(coursework_overdue_count_to_week AS VARCHAR)",
}
VIEWS["linear_factors"] = " UNION ALL ".join(
    f"""SELECT {KEY}, {i} AS position, '{name}' AS factor_name, {_VALUES[name]} AS factor_value,
        CAST({weight} AS DOUBLE) * (x_{name} - (SELECT avg(x_{name}) FROM linear_background)) AS contribution
        FROM linear_rows"""
    for i, (name, weight) in enumerate(zip(_LINEAR_INPUTS, LINEAR.values()))
)
VIEWS["linear_top"] = f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY abs(contribution) DESC, position) AS factor_rank
               FROM linear_factors) WHERE factor_rank <= 3"""

register(
    "x02_linear_contributions",
    lambda w: linear_explained(w).select(KEY, F.round("contribution_sum", 6).alias("contribution_sum")),
    f"SELECT {KEY}, round(sum(contribution), 6) AS contribution_sum FROM linear_factors GROUP BY 1",
)


def _top_rows(w: Workspace) -> DataFrame:
    _, child = explain.prediction_tables(linear_explained(w))
    return child.select(
        F.col("prediction_id"), "factor_name", "factor_value", "factor_rank",
        F.col("shap_value").cast("double").alias("shap_value"),
    )


_TOP_SQL = f"""
SELECT {KEY} AS prediction_id, factor_name, factor_value, CAST(factor_rank AS INTEGER) AS factor_rank,
       round(contribution, 4) AS shap_value FROM linear_top"""
register("x03_top_factors", _top_rows, _TOP_SQL)
register(
    "w06_top_k_per_row",
    lambda w: _top_rows(w).groupBy("factor_name", "factor_rank").agg(F.count("*").alias("n")),
    f"SELECT factor_name, factor_rank, count(*) AS n FROM ({_TOP_SQL}) GROUP BY ALL",
)
register(
    "x04_factor_values",
    lambda w: _top_rows(w).groupBy("factor_name", "factor_value").agg(F.count("*").alias("n")),
    f"SELECT factor_name, factor_value, count(*) AS n FROM ({_TOP_SQL}) GROUP BY ALL",
)
register(
    "s14_x05_predictions",
    lambda w: explain.prediction_tables(linear_explained(w))[0].withColumn(
        "risk_probability", F.col("risk_probability").cast("double")
    ),
    f"""SELECT {KEY} AS prediction_id, {KEY}, CAST(CAST(CAST(score AS DECIMAL(18,6)) AS DECIMAL(5,4)) AS DOUBLE) AS risk_probability,
          CASE WHEN score >= 0.5 THEN 'Fail' ELSE 'Not Fail' END AS predict_result FROM linear_rows""",
)


def _fitted_predictions(w: Workspace, setting: models.Setting, rows: DataFrame | None = None) -> DataFrame:
    """Fit, save, reload, score the predict frame (or other rows) and explain every row."""
    from sparkmart.plans import pipeline

    train, validation, _ = models.temporal_split(w.train_frame())
    used = train.unionByName(validation)
    folder = scratch_folder(w.spark, "artifact")
    preprocessor = features.fit_preprocessor(used)
    sample = explain.seeded_sample(used, KEY, explain.BACKGROUND_ROWS)
    pipeline.save_artifact(
        w.spark, folder, models.fit(used, setting), preprocessor,
        models.vectors(models.labelled(sample), preprocessor), {"setting": str(setting)},
    )
    artifact = pipeline.load_artifact(w.spark, folder)
    return explain.explain_pipeline(
        artifact["model"], artifact["model_folder"], artifact["preprocessor"], artifact["background"],
        w.predict_frame() if rows is None else rows,
    )


def _explained_rows(w: Workspace, setting: models.Setting) -> DataFrame:
    return explain.prediction_tables(_fitted_predictions(w, setting))[1]


register(
    "x01_s15_scored_predictions",
    lambda w: explain.prediction_tables(_fitted_predictions(w, models.LogisticSetting()))[0],
)
register("x02_boosted_tree_factors", lambda w: _explained_rows(w, models.BOOSTING_TUNED))
register("x02_forest_factors", lambda w: _explained_rows(w, models.ForestSetting()))


def _demo_rows(w: Workspace) -> DataFrame:
    """A seeded sample of the test presentation."""
    test = w.train_frame().filter(F.col("code_presentation") == models.TEST)
    return explain.seeded_sample(test, KEY, explain.DEMO_ROWS)


def _demo_of_formula(w: Workspace) -> DataFrame:
    """The sample with the linear model of fixed weights and its three strongest factors."""
    fitted, used, contributions = _linear_parts(w)
    factors = explain.top_factors(used, [contributions[f.full_name] for f in used])
    rows = fixed_score(fitted.transform(_demo_rows(w))).withColumn("factors", factors)
    return _demo_table(rows)


def _demo_table(rows: DataFrame) -> DataFrame:
    """Probability, label and factors, one column each, of explained rows."""
    factors = [
        F.col("factors")[i][part].alias(f"factor_{i + 1}_{name}")
        for i in range(explain.TOP_FACTORS)
        for part, name in (("factor_name", "name"), ("factor_value", "value"), ("contribution", "shap"))
    ]
    label = N.risk_label(F.col("score")).alias("prediction")
    return rows.select(KEY, F.col("score").alias("probability_fail"), label, *factors)


VIEWS["demo_rows"] = (
    f"SELECT *, {_LINEAR_COLUMNS} FROM scored WHERE code_presentation = '2014B' "
    f"ORDER BY md5(CAST({KEY} AS VARCHAR) || ':42'), {KEY} LIMIT 1000"
)
VIEWS["demo_factors"] = VIEWS["linear_factors"].replace("FROM linear_rows", "FROM demo_rows")
VIEWS["demo_top"] = f"""
SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY abs(contribution) DESC, position) AS factor_rank FROM demo_factors"""
_DEMO_FACTORS = ", ".join(
    f"max(CASE WHEN factor_rank = {i} THEN {value} END) AS factor_{i}_{name}"
    for i in (1, 2, 3)
    for value, name in (("factor_name", "name"), ("factor_value", "value"), ("round(contribution, 4)", "shap"))
)
register(
    "x06_demo_sample",
    _demo_of_formula,
    f"""SELECT d.{KEY}, score AS probability_fail, CASE WHEN score >= 0.5 THEN 'Fail' ELSE 'Not Fail' END AS prediction, f.* EXCLUDE ({KEY})
        FROM demo_rows d JOIN (SELECT {KEY}, {_DEMO_FACTORS} FROM demo_top GROUP BY {KEY}) f ON f.{KEY} = d.{KEY}""",
)
# The same with the boosted model and the kept settings.
register("x06_demo_boosted", lambda w: _demo_table(_fitted_predictions(w, models.BOOSTING_TUNED, _demo_rows(w))))
