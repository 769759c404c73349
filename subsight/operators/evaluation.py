"""Exact ranking and threshold metrics for scored rows.

Everything is derived from one table of counts per distinct score, so tied
scores are treated as one step and the cost after the first aggregation follows
the number of distinct scores.  Running totals are distributed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subsight.functions.expr import ratio, ratio_or_zero
from subsight.functions.ranking import running_totals
from subsight.session import stable


class TooFewDates(ValueError):
    """A temporal split needs at least three prediction dates."""


def with_split(frame: DataFrame, date: str = "prediction_date") -> DataFrame:
    """Add ``split``: last date is test, the one before validation, the rest train."""
    test = frame.agg(F.max(date)).scalar()
    validation = frame.where(F.col(date) < test).agg(F.max(date)).scalar()
    return frame.withColumn(
        "split",
        F.when(F.col(date) == test, "test").when(F.col(date) == validation, "validation").otherwise("train"),
    )


def split_periods(frame: DataFrame, date: str = "prediction_date") -> DataFrame:
    """Row count and date range of each split."""
    return (
        with_split(frame, date)
        .groupBy("split")
        .agg(F.count("*").alias("row_count"), F.min(date).alias("first_date"), F.max(date).alias("last_date"))
    )


def temporal_split(frame: DataFrame, date: str = "prediction_date") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train, validation, test).  Only the three latest dates reach the driver."""
    latest = [row[0] for row in frame.select(date).distinct().orderBy(F.desc(date)).limit(3).collect()]
    if len(latest) < 3:
        raise TooFewDates("a temporal split needs three prediction dates or more")
    test, validation, _ = latest
    return (
        frame.where(F.col(date) < F.lit(validation)),
        frame.where(F.col(date) == F.lit(validation)),
        frame.where(F.col(date) == F.lit(test)),
    )


def score_counts(
    scored: DataFrame, score: str = "churn_probability", label: str = "churn_label", keys: Sequence[str] = ()
) -> DataFrame:
    """Rows and positives per distinct score (and key)."""
    return scored.groupBy(*keys, F.col(score).alias("score")).agg(
        F.count("*").alias("n"), F.sum(F.col(label)).cast("bigint").alias("positives")
    )


def ranked_counts(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Counts with running totals from the highest score down."""
    return running_totals(counts, [F.col("score").desc()], {"cum_n": "n", "cum_positives": "positives"}, keys)


def _f1(tp: Column, predicted: Column, positives: Column) -> Column:
    return ratio_or_zero(2 * tp, predicted + positives)


def choose_threshold(
    scored: DataFrame, score: str = "churn_probability", label: str = "churn_label", keys: Sequence[str] = ()
) -> DataFrame:
    """Cut-off with the best F1, then precision, then the highest cut-off.

    Candidates are all scores and the two ends 0 and 1.  A row is predicted
    positive when its score reaches the cut-off.
    """
    # stored: read for the levels and for whether there are any
    counts = stable(score_counts(scored, score, label, keys))
    # The two ends take part as empty score levels.
    ends = (
        counts.select(*keys).distinct()
        if keys
        else counts.agg(F.count("*").alias("_n")).where("_n > 0").select()
    )
    ends = ends.select(
        *keys,
        F.explode(F.array(F.lit(0.0), F.lit(1.0))).alias("score"),
        F.lit(0).cast("bigint").alias("n"),
        F.lit(0).cast("bigint").alias("positives"),
    )
    levels = (
        counts.unionByName(ends).groupBy(*keys, "score").agg(F.sum("n").alias("n"), F.sum("positives").alias("positives"))
    )
    ranked = ranked_counts(levels, keys)
    # the running total at the lowest score is the number of positives
    totals = ranked.groupBy(*keys).agg(F.max("cum_positives").alias("total"))
    joined = ranked.join(totals, list(keys)) if keys else ranked.withColumn("total", totals.scalar())
    candidate = F.struct(
        _f1(F.col("cum_positives"), F.col("cum_n"), F.col("total")).alias("f1"),
        ratio_or_zero(F.col("cum_positives"), F.col("cum_n")).alias("precision"),
        F.col("score").alias("threshold"),
    )
    best = joined.groupBy(*keys).agg(F.max(candidate).alias("best"))
    return best.select(*keys, "best.threshold", "best.f1", "best.precision")


def top_decile_lift(
    scored: DataFrame,
    score: str = "churn_probability",
    label: str = "churn_label",
    tie_break: str = "account_id",
    share: float = 0.10,
) -> DataFrame:
    """Positive rate of the top tenth (rounded up) over the overall rate.

    Ties at the boundary are settled by ``tie_break``.  The top tenth grows
    with the data, so rows get a distributed global position and no sort is
    collected.  Zero when there are no positives.
    """
    rows = scored.select(
        F.col(score).alias("score"),
        F.col(label).cast("bigint").alias("label"),
        F.col(tie_break).alias("tie"),
        F.lit(1).cast("bigint").alias("one"),
    )
    placed = running_totals(rows, [F.col("score").desc(), F.col("tie").asc()], {"position": "one"})
    total = placed.agg(F.max("position")).scalar()
    top = F.greatest(F.lit(1).cast("bigint"), F.ceil(total * F.lit(share)))
    in_top = F.col("position") <= top
    top_rate = ratio(F.sum(F.when(in_top, F.col("label"))), F.count(F.when(in_top, F.lit(1))))
    overall = ratio(F.sum("label"), F.count("*"))
    return placed.agg(
        F.count("*").alias("row_count"),
        F.count(F.when(in_top, F.lit(1))).alias("top_count"),
        F.coalesce(F.sum(F.when(in_top, F.col("label"))), F.lit(0)).cast("bigint").alias("top_positives"),
        F.coalesce(top_rate / F.nullif(overall, F.lit(0.0)), F.lit(0.0)).alias("top_decile_lift"),
    )


def ranking_metrics(
    scored: DataFrame,
    score: str = "churn_probability",
    label: str = "churn_label",
    keys: Sequence[str] = (),
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """Step-wise average precision and ROC-AUC with average ranks for ties.

    ``cuts`` are any scores that deal the rows of a key evenly; with them rows
    are ranked between cuts, see :func:`_ranked_between`, with the same result.
    """
    if cuts is None:
        ranked = ranked_counts(score_counts(scored, score, label, keys), keys)
    else:
        ranked = _ranked_between(scored, score, label, keys, cuts)
    n, tp = F.col("n").cast("double"), F.col("positives").cast("double")
    cum_n, cum_tp = F.col("cum_n").cast("double"), F.col("cum_positives").cast("double")
    negatives = n - tp
    # pairs ranked rightly: negatives strictly below a positive, half of the tied ones
    sums = ranked.groupBy(*keys).agg(
        F.max("cum_n").alias("row_count"),
        F.max("cum_positives").alias("positives"),
        F.sum(tp * cum_tp / cum_n).alias("precision_steps"),
        F.sum(tp * (cum_n - cum_tp - negatives / 2.0)).alias("pairs_missed"),
    )
    p = F.col("positives").cast("double")
    rest = (F.col("row_count") - F.col("positives")).cast("double")
    return sums.select(
        *keys,
        "row_count",
        "positives",
        F.coalesce(F.col("precision_steps") / F.nullif(p, F.lit(0.0)), F.lit(0.0)).alias("pr_auc"),
        ((p * rest - F.col("pairs_missed")) / F.nullif(p * rest, F.lit(0.0))).alias("roc_auc"),
    )


def _ranked_between(scored: DataFrame, score: str, label: str, keys: Sequence[str], cuts: Sequence[float]) -> DataFrame:
    """Scores with a positive and the lowest ones of each stretch, with running totals per key.

    Rows are shuffled once, by key and stretch between two cuts, and ranked
    there.  Scores without a positive add nothing to the metrics but their
    count, so few rows are stored and read again to add what stands above a
    stretch.  Cuts share out the work only: any list gives the same totals.
    """
    ends = F.array(*[F.lit(float(c)) for c in sorted(set(cuts))])
    stretch = F.size(F.filter(ends, lambda cut: cut < F.col("score"))) if cuts else F.lit(0)
    rows = scored.select(*keys, F.col(score).alias("score"), F.col(label).cast("bigint").alias("_label"))
    dealt = rows.withColumn("_stretch", stretch).repartition(*keys, "_stretch")
    levels = dealt.groupBy(*keys, "_stretch", "score").agg(F.count("*").alias("n"), F.sum("_label").alias("positives"))
    inside = Window.partitionBy(*keys, "_stretch").orderBy(F.desc("score"))
    ranked = levels.withColumns(
        {
            "cum_n": F.sum("n").over(inside),
            "cum_positives": F.sum("positives").over(inside),
            "_last": F.lead(F.lit(1)).over(inside).isNull(),
        }
    )
    kept = stable(ranked.where((F.col("positives") > 0) | F.col("_last")))
    # one row per key and stretch
    above = Window.partitionBy(*keys).orderBy(F.desc("_stretch")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = kept.where("_last").select(
        *keys,
        "_stretch",
        *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"_above_{c}") for c in ("cum_n", "cum_positives")],
    )
    joined = kept.join(offsets, [*keys, "_stretch"])
    return joined.select(
        *keys, "score", "n", "positives", *[(F.col(c) + F.col(f"_above_{c}")).alias(c) for c in ("cum_n", "cum_positives")]
    )


def threshold_metrics(
    scored: DataFrame,
    threshold: Column | float = 0.5,
    score: str = "churn_probability",
    label: str = "churn_label",
) -> DataFrame:
    """Confusion matrix, precision, recall and F1; zero where undefined."""
    cut = F.lit(threshold) if isinstance(threshold, (int, float)) else threshold
    predicted = F.col(score) >= cut
    actual = F.col(label) == 1
    cells = scored.agg(
        F.count(F.when(~predicted & ~actual, F.lit(1))).alias("true_negatives"),
        F.count(F.when(predicted & ~actual, F.lit(1))).alias("false_positives"),
        F.count(F.when(~predicted & actual, F.lit(1))).alias("false_negatives"),
        F.count(F.when(predicted & actual, F.lit(1))).alias("true_positives"),
    )
    tp, fp, fn = F.col("true_positives"), F.col("false_positives"), F.col("false_negatives")
    return cells.select(
        "*",
        ratio_or_zero(tp, tp + fp).alias("precision"),
        ratio_or_zero(tp, tp + fn).alias("recall"),
        ratio_or_zero(2 * tp, 2 * tp + fp + fn).alias("f1"),
        cut.cast("double").alias("decision_threshold"),
    )


def evaluate_scores(
    scored: DataFrame,
    threshold: Column | float = 0.5,
    score: str = "churn_probability",
    label: str = "churn_label",
    tie_break: str = "account_id",
) -> DataFrame:
    """All metrics of one scored set in one row.

    The scored rows are read three times, so they are stored first.
    """
    tie = F.col(tie_break).alias("_tie")
    scored = stable(scored.select(F.col(score).alias("_score"), F.col(label).alias("_label"), tie))
    score, label, tie_break = "_score", "_label", "_tie"
    # one-row results, attached as scalars
    ranking = ranking_metrics(scored, score, label).select(F.struct("pr_auc", "roc_auc")).scalar()
    lift = top_decile_lift(scored, score, label, tie_break).select("top_decile_lift").scalar()
    cells = threshold_metrics(scored, threshold, score, label)
    return cells.withColumns(
        {"pr_auc": ranking.getField("pr_auc"), "roc_auc": ranking.getField("roc_auc"), "top_decile_lift": lift}
    )


def select_model(results: DataFrame) -> DataFrame:
    """Model with the best validation lift, then validation average precision.

    ``results`` has one row per model and split.  The gain over the baseline is
    reported on the test split, which plays no part in the choice.
    """
    chosen = (
        results.where("split = 'validation'")
        .agg(F.max_by("model", F.struct("top_decile_lift", "pr_auc", "model")).alias("selected_model"))
        .scalar()
    )
    test = results.where("split = 'test'")

    def of(role, metric):
        return F.max(F.when(F.col("role") == role, F.col(metric)))

    gain = F.coalesce(
        (of("challenger", "pr_auc") - of("baseline", "pr_auc")) / F.nullif(of("baseline", "pr_auc"), F.lit(0.0)),
        F.lit(0.0),
    )
    return test.agg(
        gain.alias("relative_pr_gain"), of("challenger", "top_decile_lift").alias("challenger_lift")
    ).select(
        chosen.alias("selected_model"),
        "relative_pr_gain",
        "challenger_lift",
        ((F.col("challenger_lift") >= 2) | (F.col("relative_pr_gain") >= 0.20)).alias("target_met"),
    )
