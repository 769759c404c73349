"""Features, model metrics, scoring."""

from datetime import date

from pyspark.sql import functions as F

from catalog.registry import query, rounded
from catalog.sql import ACTIVATION, CURRENT_SPINE, FEATURES, SCORED, SPINE, chain, reasons
from catalog.stream import new_folder
from catalog.usage import dim_of
from subsight.operators import evaluation as ev
from subsight.operators import features as ft
from subsight.operators import models as ml
from subsight.operators import scoring as sc
from subsight.operators.activation import account_activation
from subsight.plans.training import stored_scorer, train_and_store
from subsight.schemas import CATEGORICAL_FEATURES, FEATURE_COLUMNS, NUMERIC_FEATURES
from subsight.session import stable

_TRAINING = chain(SPINE, ACTIVATION, FEATURES)
_TRAINING_SCORED = chain(_TRAINING, SCORED)
_CURRENT = chain(CURRENT_SPINE, ACTIVATION, FEATURES)
_CURRENT_SCORES = chain(_CURRENT, SCORED, reasons())


def features_of(d, snapshots=None):
    snapshots = ft.prediction_spine(d.subscriptions, d.invoices) if snapshots is None else snapshots
    activation = account_activation(d.accounts, d.stored_events)
    return ft.churn_features(snapshots, d.accounts, d.stored_events, d.invoices, activation)


def stored_features_of(d):
    """Features written once, since training and evaluation read them often."""
    return stable(features_of(d))


def stored_held_out_of(d):
    """Validation and test rows alone, from all events and invoices, written once."""
    _, validation, test = ev.temporal_split(ft.prediction_spine(d.subscriptions, d.invoices))
    held_out = validation.union(test)
    features = stable(features_of(d, held_out))
    return [features.where(F.col("prediction_date") == F.lit(day)) for day in ft.prediction_dates(held_out)]


def current_of(d, as_of=None):
    activation = account_activation(d.accounts, d.stored_events)
    return ft.current_scoring_features(dim_of(d), d.stored_events, d.invoices, activation, as_of)


def with_score(features):
    """The deterministic score the check SQL uses; it has many ties."""
    mixed = (
        F.col("account_id").cast("bigint") * 37 + F.month("prediction_date") * 11 + F.col("events_last_30d") * 7
    ) % 101
    return features.withColumn("churn_probability", F.least(F.lit(1.0), mixed.cast("double") / 100.0))


def scored_of(d):
    return with_score(features_of(d))


def scores_of(d):
    return sc.score_frame(with_score(current_of(d)))


@query("prediction_spine", "SELECT * FROM spine", SPINE)
def _(d):
    return ft.prediction_spine(d.subscriptions, d.invoices)


@query("churn_features", "SELECT * FROM features", _TRAINING)
def _(d):
    return features_of(d)


@query("current_scoring_features", "SELECT * EXCLUDE (churn_label) FROM features", _CURRENT)
def _(d):
    return current_of(d)


@query(
    "training_dataset",
    """SELECT account_id, prediction_date, plan, monthly_revenue, churn_label FROM features
       ORDER BY prediction_date, account_id""",
    _TRAINING,
)
def _(d):
    return ft.training_dataset(features_of(d)).select(
        "account_id", "prediction_date", "plan", "monthly_revenue", "churn_label"
    )


@query(
    "training_summary",
    """SELECT count(*) AS total_rows, CAST(sum(churn_label) AS BIGINT) AS churn_rows,
              CAST(count(*) - sum(churn_label) AS BIGINT) AS non_churn_rows,
              CAST(sum(churn_label) AS DOUBLE) / count(*) AS churn_rate,
              min(prediction_date) AS first_prediction_date, max(prediction_date) AS last_prediction_date
       FROM features""",
    _TRAINING,
)
def _(d):
    return ft.training_summary(features_of(d))


@query(
    "leakage_check",
    """SELECT b.account_id, b.prediction_date,
              CASE WHEN CAST(b.latest_event_at AS DATE) > b.prediction_date THEN 'event after cutoff'
                   WHEN b.latest_invoice_date > b.prediction_date THEN 'invoice after cutoff'
                   WHEN s.cancellation_date <= b.prediction_date THEN 'already cancelled'
                   ELSE 'label differs' END AS problem
       FROM (SELECT account_id, prediction_date,
                    CASE WHEN CAST(account_id AS BIGINT) % 7 = 1 THEN CAST(prediction_date + 1 AS TIMESTAMP)
                         ELSE latest_event_at END AS latest_event_at,
                    CASE WHEN CAST(account_id AS BIGINT) % 7 IN (1, 2) THEN prediction_date + 3
                         ELSE latest_invoice_date END AS latest_invoice_date,
                    CASE WHEN CAST(account_id AS BIGINT) % 7 = 3 THEN 1 - churn_label ELSE churn_label END AS churn_label
             FROM features) AS b JOIN subscriptions AS s USING (account_id)
       WHERE CAST(b.latest_event_at AS DATE) > b.prediction_date OR b.latest_invoice_date > b.prediction_date
          OR s.cancellation_date <= b.prediction_date
          OR (b.churn_label = 1) <> coalesce(s.cancellation_date - b.prediction_date BETWEEN 1 AND 30, FALSE)""",
    _TRAINING,
)
def _(d):
    """Features of some accounts are bent, so that there is something to find."""
    part, on = F.col("account_id").cast("bigint") % 7, F.col("prediction_date")
    bent = features_of(d).withColumns(
        {
            "latest_event_at": F.when(part == 1, F.date_add(on, 1).cast("timestamp")).otherwise(F.col("latest_event_at")),
            "latest_invoice_date": F.when(part.isin(1, 2), F.date_add(on, 3)).otherwise(F.col("latest_invoice_date")),
            "churn_label": F.when(part == 3, 1 - F.col("churn_label")).otherwise(F.col("churn_label")),
        }
    )
    return ft.leakage_check(bent, d.subscriptions)


# --- evaluation -------------------------------------------------------------------


@query(
    "temporal_split",
    """SELECT CASE WHEN place = 1 THEN 'test' WHEN place = 2 THEN 'validation' ELSE 'train' END AS split,
              count(*) AS row_count, min(prediction_date) AS first_date, max(prediction_date) AS last_date
       FROM (SELECT prediction_date, dense_rank() OVER (ORDER BY prediction_date DESC) AS place FROM spine) AS placed
       GROUP BY 1""",
    SPINE,
)
def _(d):
    return ev.split_periods(ft.prediction_spine(d.subscriptions, d.invoices))


_CUTS = """
cuts AS (
    SELECT cut, 2.0::DOUBLE * tp / nullif(predicted + positives, 0) AS f1,
           coalesce(CAST(tp AS DOUBLE) / nullif(predicted, 0), 0) AS precision
    FROM (
        SELECT c.cut,
               (SELECT count(*) FROM scored WHERE churn_probability >= c.cut AND churn_label = 1) AS tp,
               (SELECT count(*) FROM scored WHERE churn_probability >= c.cut) AS predicted,
               (SELECT count(*) FROM scored WHERE churn_label = 1) AS positives
        FROM (SELECT DISTINCT churn_probability AS cut FROM scored
              UNION SELECT 0.0::DOUBLE UNION SELECT 1.0::DOUBLE) AS c
    ) AS counted
)"""


@query(
    "choose_threshold",
    'SELECT cut AS threshold, f1, precision FROM cuts ORDER BY f1 DESC, precision DESC, cut DESC LIMIT 1',
    chain(_TRAINING_SCORED, _CUTS),
)
def _(d):
    return ev.choose_threshold(scored_of(d))


_LIFT = """
placed AS (
    SELECT churn_label, row_number() OVER (ORDER BY churn_probability DESC, account_id, prediction_date) AS place,
           count(*) OVER () AS everyone FROM scored
),
lift AS (
    SELECT count(*) AS row_count, count(*) FILTER (place <= ceil(everyone * 0.1::DOUBLE)) AS top_count,
           CAST(coalesce(sum(churn_label) FILTER (place <= ceil(everyone * 0.1::DOUBLE)), 0) AS BIGINT) AS top_positives
    FROM placed
)"""


@query(
    "top_decile_lift",
    """SELECT row_count, top_count, top_positives,
              round((CAST(top_positives AS DOUBLE) / top_count)
                  / ((SELECT sum(churn_label) FROM scored)::DOUBLE / row_count), 9) AS top_decile_lift
       FROM lift""",
    chain(_TRAINING_SCORED, _LIFT),
)
def _(d):
    keyed = scored_of(d).withColumn("tie", F.struct("account_id", "prediction_date"))
    return rounded(ev.top_decile_lift(keyed, tie_break="tie"), "top_decile_lift")


@query(
    "evaluate_scores",
    """SELECT round((SELECT sum(CAST(hits AS DOUBLE) * running_hits / running_rows)
                     FROM (SELECT hits, sum(hits) OVER up AS running_hits, sum(level_rows) OVER up AS running_rows
                           FROM (SELECT churn_probability AS p, sum(churn_label) AS hits, count(*) AS level_rows
                                 FROM scored GROUP BY 1) AS levels
                           WINDOW up AS (ORDER BY p DESC)) AS steps)
                    / (SELECT sum(churn_label) FROM scored), 9) AS pr_auc,
              (SELECT round(avg(CASE WHEN g.churn_probability > b.churn_probability THEN 1.0::DOUBLE
                               WHEN g.churn_probability = b.churn_probability THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END), 9)
               FROM scored AS g JOIN scored AS b ON g.churn_label = 1 AND b.churn_label = 0) AS roc_auc,
              tn AS true_negatives, fp AS false_positives, fn AS false_negatives, tp AS true_positives,
              CAST(tp AS DOUBLE) / (tp + fp) AS precision, CAST(tp AS DOUBLE) / (tp + fn) AS recall,
              2.0::DOUBLE * tp / (2 * tp + fp + fn) AS f1, 0.5::DOUBLE AS decision_threshold,
              round((CAST(top_positives AS DOUBLE) / top_count) / ((tp + fn)::DOUBLE / row_count), 9) AS top_decile_lift
       FROM (SELECT count(*) FILTER (churn_probability < 0.5 AND churn_label = 0) AS tn,
                    count(*) FILTER (churn_probability >= 0.5 AND churn_label = 0) AS fp,
                    count(*) FILTER (churn_probability < 0.5 AND churn_label = 1) AS fn,
                    count(*) FILTER (churn_probability >= 0.5 AND churn_label = 1) AS tp FROM scored) AS cells, lift""",
    chain(_TRAINING_SCORED, _LIFT),
)
def _(d):
    keyed = scored_of(d).withColumn("tie", F.struct("account_id", "prediction_date"))
    return rounded(ev.evaluate_scores(keyed, 0.5, tie_break="tie"), "pr_auc", "roc_auc", "top_decile_lift")


def _is_probability(name):
    """Trained scores have no SQL form; that they are scores has."""
    return F.coalesce(F.col(name).between(0, 1), F.lit(False))


_TEST_ROWS = """SELECT account_id, prediction_date, churn_label, TRUE AS scored FROM features
    WHERE prediction_date = (SELECT max(prediction_date) FROM features)"""


def _test_rows(d, kind):
    train, _, test = ev.temporal_split(stored_features_of(d))
    scored = ml.predict(ml.fit(kind, train), test)
    return scored.select(
        "account_id", "prediction_date", "churn_label", _is_probability("churn_probability").alias("scored")
    )


@query("logistic_model", _TEST_ROWS, _TRAINING)
def _(d):
    """Test-date rows with a probability of the logistic model."""
    return _test_rows(d, ml.LOGISTIC)


# the training dates are all but the last two
_TRAINING_ROWS = """train AS (SELECT * FROM features WHERE prediction_date NOT IN
    (SELECT DISTINCT prediction_date FROM features ORDER BY 1 DESC LIMIT 2))"""


@query(
    "logistic_optimality",
    f"SELECT unnest([{', '.join(repr(c) for c in [*NUMERIC_FEATURES, 'intercept'])}]) AS input, TRUE AS optimal"
    + "".join(
        f" UNION ALL SELECT DISTINCT '{c}=' || {c}, TRUE FROM train WHERE {c} IS NOT NULL UNION ALL SELECT '{c}=', TRUE"
        for c in CATEGORICAL_FEATURES
    ),
    chain(_TRAINING, _TRAINING_ROWS),
)
def _(d):
    """The slope of the balanced loss along every coefficient, summed over the training rows, is next to nothing."""
    train, _, _ = ev.temporal_split(stored_features_of(d))
    slopes = ml.logistic_gradient(ml.fit(ml.LOGISTIC, train), train)
    return slopes.select("input", (F.abs("gradient") < 1e-4).alias("optimal"))


@query("boosted_trees_model", _TEST_ROWS, _TRAINING)
def _(d):
    """Test-date rows with a probability of the boosted trees."""
    return _test_rows(d, ml.BOOSTED_TREES)


@query(
    "boosted_tree_leaves",
    """SELECT tree, (SELECT count(*) FROM train) AS row_count, TRUE AS at_most_15_leaves, TRUE AS at_least_8_rows
       FROM (SELECT unnest(range(200)) AS tree) AS trees""",
    chain(_TRAINING, _TRAINING_ROWS),
)
def _(d):
    """Training rows by tree over all its leaves, and the two bounds on leaves."""
    train, _, _ = ev.temporal_split(stored_features_of(d))
    model = ml.fit(ml.BOOSTED_TREES, train)
    prepared = train
    for stage in model.stages[:-1]:
        prepared = stage.transform(prepared)
    leaves = model.stages[-1].leaf_rows(prepared)
    return leaves.groupBy("tree").agg(
        F.sum("row_count").alias("row_count"),
        (F.count("*") <= 15).alias("at_most_15_leaves"),
        (F.min("row_count") >= 8).alias("at_least_8_rows"),
    )


def _results_of(d):
    """Metrics of two deterministic scores on the last two dates, one of them told a part of the truth."""
    validation, test = stored_held_out_of(d)
    results = None
    for split, frame in (("validation", validation), ("test", test)):
        base = with_score(frame)
        told = base.withColumn("churn_probability", F.least(F.lit(1.0), F.col("churn_probability") + F.col("churn_label") * 0.25))
        for model, role, scored in ((ml.LOGISTIC, "baseline", base), (ml.BOOSTED_TREES, "challenger", told)):
            row = ev.evaluate_scores(scored, 0.5).select(F.lit(model).alias("model"), F.lit(role).alias("role"), F.lit(split).alias("split"), "*")
            results = row if results is None else results.unionByName(row)
    return results


_RESULTS = """
held AS (
    SELECT CASE WHEN place = 1 THEN 'test' ELSE 'validation' END AS split, account_id, churn_label, churn_probability
    FROM (SELECT *, dense_rank() OVER (ORDER BY prediction_date DESC) AS place FROM scored) AS placed WHERE place <= 2
),
judged AS (
    SELECT split, 'logistic_regression' AS model, 'baseline' AS role, account_id, churn_label, churn_probability AS p FROM held
    UNION ALL
    SELECT split, 'boosted_trees', 'challenger', account_id, churn_label,
           least(1.0::DOUBLE, churn_probability + churn_label * 0.25::DOUBLE) FROM held
),
steps AS (
    SELECT model, role, split, hits, sum(hits) OVER up AS running_hits, sum(level_rows) OVER up AS running_rows
    FROM (SELECT model, role, split, p, sum(churn_label) AS hits, count(*) AS level_rows FROM judged GROUP BY ALL) AS levels
    WINDOW up AS (PARTITION BY model, split ORDER BY p DESC)
),
precisions AS (
    SELECT model, role, split, coalesce(sum(CAST(hits AS DOUBLE) * running_hits / running_rows) / nullif(sum(hits), 0), 0) AS pr_auc
    FROM steps GROUP BY ALL
),
lifts AS (
    SELECT model, split, coalesce(
        (CAST(sum(churn_label) FILTER (place <= ceil(everyone * 0.1::DOUBLE)) AS DOUBLE) / max(ceil(everyone * 0.1::DOUBLE)))
            / nullif(CAST(sum(churn_label) AS DOUBLE) / max(everyone), 0), 0) AS top_decile_lift
    FROM (SELECT *, row_number() OVER (PARTITION BY model, split ORDER BY p DESC, account_id) AS place,
                 count(*) OVER (PARTITION BY model, split) AS everyone FROM judged) AS placed
    GROUP BY ALL
),
results AS (SELECT * FROM precisions JOIN lifts USING (model, split))"""


@query(
    "select_model",
    """SELECT (SELECT model FROM results WHERE split = 'validation' ORDER BY top_decile_lift DESC, pr_auc DESC, model DESC LIMIT 1)
                  AS selected_model,
              round(gain, 9) AS relative_pr_gain, round(lift, 9) AS challenger_lift, lift >= 2 OR gain >= 0.2 AS target_met
       FROM (SELECT coalesce((max(pr_auc) FILTER (role = 'challenger') - max(pr_auc) FILTER (role = 'baseline'))
                        / nullif(max(pr_auc) FILTER (role = 'baseline'), 0), 0) AS gain,
                    max(top_decile_lift) FILTER (role = 'challenger') AS lift
             FROM results WHERE split = 'test') AS compared""",
    chain(_TRAINING_SCORED, _RESULTS),
)
def _(d):
    """The choice between two scored models by validation lift and precision."""
    return rounded(ev.select_model(_results_of(d)), "relative_pr_gain", "challenger_lift")


@query(
    "training_artifacts",
    """SELECT 'periods' AS artifact, CASE WHEN place = 1 THEN 'test' WHEN place = 2 THEN 'validation' ELSE 'train' END
              || ' from ' || min(prediction_date) || ' to ' || max(prediction_date) AS name, count(*) AS size
       FROM (SELECT prediction_date, dense_rank() OVER (ORDER BY prediction_date DESC) AS place FROM spine) AS placed
       GROUP BY least(place, 3), CASE WHEN place = 1 THEN 'test' WHEN place = 2 THEN 'validation' ELSE 'train' END
       UNION ALL SELECT 'importance', unnest(["""
    + ", ".join(f"'{c}'" for c in FEATURE_COLUMNS)
    + """]), 20
       UNION ALL SELECT 'scores', account_id, count(*) FROM spine
       WHERE prediction_date = (SELECT max(prediction_date) FROM spine) GROUP BY account_id""",
    SPINE,
)
def _(d):
    """A stored training run read back, and test rows scored by its saved model."""
    folder, features = new_folder(d.spark, "training"), stored_features_of(d)
    train_and_store(features, folder, "run-1")
    scored = stored_scorer(d.spark, folder, "run-1")(ev.temporal_split(features)[2])
    period = F.concat_ws(" ", "split", F.lit("from"), F.col("first_date").cast("string"), F.lit("to"), F.col("last_date").cast("string"))
    parts = [
        d.spark.read.parquet(f"{folder}/periods/run-1").select(F.lit("periods"), period, "row_count"),
        d.spark.read.parquet(f"{folder}/importance/run-1").select(F.lit("importance"), "feature", "repeats"),
        scored.where(_is_probability("churn_probability")).groupBy("account_id").agg(F.count("*").alias("n")).select(F.lit("scores"), "account_id", "n"),
    ]
    return parts[0].union(parts[1]).union(parts[2]).toDF("artifact", "name", "size")


@query(
    "permutation_importance",
    "SELECT unnest([" + ", ".join(f"'{c}'" for c in FEATURE_COLUMNS) + "]) AS feature, CAST(20 AS BIGINT) AS repeats, TRUE AS measured",
)
def _(d):
    """Every feature is shuffled twenty times; a loss lies within one of zero."""
    train, _, test = ev.temporal_split(stored_features_of(d))
    found = ml.permutation_importance(ml.fit(ml.LOGISTIC, train), test)
    sound = F.col("importance_mean").between(-1, 1) & F.col("importance_std").between(0, 1)
    return found.select("feature", "repeats", F.coalesce(sound, F.lit(False)).alias("measured"))


@query(
    "shuffled_partners",
    """SELECT repeat, count(*) AS row_count, count(*) AS partners, CAST(0 AS BIGINT) AS lowest, count(*) - 1 AS highest
       FROM spine, (SELECT unnest(range(1, 21)) AS repeat) AS repeats
       WHERE prediction_date = (SELECT max(prediction_date) FROM spine) GROUP BY repeat""",
    SPINE,
)
def _(d):
    """Each of twenty repeats pairs all test rows by a permutation."""
    _, _, test = ev.temporal_split(stored_features_of(d))
    partnered = ml.shuffled_partners(test.select("account_id", "prediction_date"), 20)
    return partnered.groupBy(F.col("repeat").cast("bigint").alias("repeat")).agg(
        F.count("*").alias("row_count"),
        F.countDistinct("partner").alias("partners"),
        F.min("partner").alias("lowest"),
        F.max("partner").alias("highest"),
    )


@query(
    "run_metrics_table",
    """SELECT 'run-1' AS run_id, model, split, unnest(['pr_auc', 'top_decile_lift']) AS metric,
              round(unnest([pr_auc, top_decile_lift]), 9) AS value FROM results""",
    chain(_TRAINING_SCORED, _RESULTS),
)
def _(d):
    """Metrics of two scored models in long form."""
    results = _results_of(d).select("model", "split", "pr_auc", "top_decile_lift")
    return rounded(ml.run_metrics_table(results, "run-1"), "value")


# --- scoring ------------------------------------------------------------------------


@query(
    "risk_bucket",
    """SELECT account_id, prediction_date, churn_probability,
              CASE WHEN churn_probability < 0.3 THEN 'Low' WHEN churn_probability < 0.6 THEN 'Medium' ELSE 'High' END
                  AS risk_bucket FROM scored""",
    _TRAINING_SCORED,
)
def _(d):
    return scored_of(d).select(
        "account_id", "prediction_date", "churn_probability", sc.risk_bucket(F.col("churn_probability")).alias("risk_bucket")
    )


@query(
    "risk_reasons",
    "SELECT account_id, prediction_date, top_reason_1, top_reason_2, top_reason_3 FROM scores",
    chain(_TRAINING_SCORED, reasons()),
)
def _(d):
    return sc.with_reasons(features_of(d)).select(
        "account_id", "prediction_date", "top_reason_1", "top_reason_2", "top_reason_3"
    )


@query("score_accounts", "SELECT * FROM scores", _CURRENT_SCORES)
def _(d):
    return sc.in_rank_order(scores_of(d))


@query(
    "score_with_model",
    """SELECT account_id, prediction_date, monthly_revenue, top_reason_1, top_reason_2, top_reason_3,
              TRUE AS scored, TRUE AS bucketed FROM scores""",
    _CURRENT_SCORES,
)
def _(d):
    """Active accounts scored by a trained logistic model; reasons do not depend on it."""
    train, _, _ = ev.temporal_split(stored_features_of(d))
    scores = sc.score_accounts(ml.fit(ml.LOGISTIC, train), current_of(d))
    bucketed = F.col("risk_bucket") == sc.risk_bucket(F.col("churn_probability"))
    return scores.select(
        "account_id", "prediction_date", "monthly_revenue", "top_reason_1", "top_reason_2", "top_reason_3",
        _is_probability("churn_probability").alias("scored"), bucketed.alias("bucketed"),
    )


_ANSWER = """SELECT account_id, churn_probability AS churn_score, risk_bucket, prediction_date, monthly_revenue,
    concat_ws(' | ', top_reason_1, top_reason_2, top_reason_3) AS top_reasons FROM scores"""


@query(
    "rank_accounts",
    _ANSWER + " ORDER BY churn_probability DESC, monthly_revenue DESC, account_id LIMIT 20",
    _CURRENT_SCORES,
)
def _(d):
    return sc.rank_accounts(scores_of(d))


@query(
    "rank_accounts_in_bucket",
    _ANSWER + " WHERE risk_bucket = 'Medium' ORDER BY churn_probability DESC, account_id LIMIT 10",
    _CURRENT_SCORES,
)
def _(d):
    return sc.rank_accounts(scores_of(d), bucket="Medium", limit=10, tie="account")


@query("account_risk", _ANSWER + " WHERE account_id = '2'", _CURRENT_SCORES)
def _(d):
    return sc.account_risk(scores_of(d), " 2 ")


@query(
    "risk_summary",
    """SELECT count(*) AS scored_accounts, count(*) FILTER (risk_bucket = 'High') AS high_risk_accounts,
              count(*) FILTER (risk_bucket = 'Medium') AS medium_risk_accounts,
              count(*) FILTER (risk_bucket = 'Low') AS low_risk_accounts,
              coalesce(sum(monthly_revenue) FILTER (risk_bucket = 'High'), 0) AS high_risk_monthly_revenue
       FROM scores""",
    _CURRENT_SCORES,
)
def _(d):
    return sc.risk_summary(scores_of(d))


_BROKEN_SCORES = """
broken AS (
    SELECT account_id, CASE WHEN risk_bucket = 'High' THEN churn_probability + 1 ELSE churn_probability END AS p,
           CASE WHEN risk_bucket = 'Low' THEN 'None' ELSE risk_bucket END AS bucket FROM scores
    UNION ALL SELECT account_id, churn_probability, risk_bucket FROM scores WHERE risk_bucket = 'Medium'
)"""


@query(
    "validate_scores",
    """SELECT 'probability_range' AS rule, count(*) AS violations FROM broken WHERE p NOT BETWEEN 0 AND 1
       UNION ALL SELECT 'risk_bucket', count(*) FROM broken WHERE bucket NOT IN ('Low', 'Medium', 'High')
       UNION ALL SELECT 'duplicate_account', count(*) FROM
           (SELECT account_id FROM broken GROUP BY 1 HAVING count(*) > 1) AS repeated""",
    chain(_CURRENT_SCORES, _BROKEN_SCORES),
)
def _(d):
    """Checks on scores that are broken in three known ways."""
    scores = scores_of(d)
    bad = scores.withColumns(
        {
            "churn_probability": F.col("churn_probability") + F.when(F.col("risk_bucket") == "High", 1).otherwise(0),
            "risk_bucket": F.when(F.col("risk_bucket") == "Low", "None").otherwise(F.col("risk_bucket")),
        }
    )
    return sc.validate_scores(bad.unionByName(scores.where("risk_bucket = 'Medium'")))


@query(
    "scoring_as_of_date",
    "SELECT account_id, prediction_date, events_last_30d, monthly_revenue FROM features",
    chain(
        """spine AS (SELECT account_id, DATE '2024-09-15' AS prediction_date, subscription_start_date, cancellation_date
           FROM subscriptions WHERE subscription_status = 'active')""",
        ACTIVATION,
        FEATURES,
    ),
)
def _(d):
    """Scoring features on a date of choice instead of the latest event date."""
    return current_of(d, date(2024, 9, 15)).select("account_id", "prediction_date", "events_last_30d", "monthly_revenue")
