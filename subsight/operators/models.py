"""Churn models on Spark ML: training, comparison and permutation importance."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import (
    Imputer,
    OneHotEncoder,
    OneHotEncoderModel,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subsight.functions.ranking import running_totals
from subsight.operators.evaluation import (
    choose_threshold,
    evaluate_scores,
    ranking_metrics,
    select_model,
    temporal_split,
)
from subsight.operators.trees import BestFirstBoosting, BestFirstModel
from subsight.schemas import CATEGORICAL_FEATURES, FEATURE_COLUMNS, LABEL, NUMERIC_FEATURES
from subsight.session import shared_folder, stable

LOGISTIC = "logistic_regression"
BOOSTED_TREES = "boosted_trees"


def with_balanced_weights(train: DataFrame, label: str = LABEL) -> DataFrame:
    """Weight each class by rows / (2 * rows of the class)."""
    rows, positives = train.agg(F.count("*"), F.coalesce(F.sum(label), F.lit(0))).first()
    if not 0 < positives < rows:
        raise ValueError("Training needs rows of both classes")
    weight = F.when(F.col(label) == 1, rows / (2.0 * positives)).otherwise(rows / (2.0 * (rows - positives)))
    return train.withColumn("class_weight", weight)


def _filled(name: str) -> str:
    return f"{name}__in"


def _input_stage(train: DataFrame) -> SQLTransformer:
    """Numerics as double and categories with NULL replaced by the mode.

    A numeric that is NULL in every training row, which has no median, is 0
    wherever it is NULL.
    """
    modes = train.agg(
        *[F.mode(c, True).alias(c) for c in CATEGORICAL_FEATURES], *[F.count(c).alias(c) for c in NUMERIC_FEATURES]
    ).first()
    quoted = {c: (modes[c] or "").replace("\\", "\\\\").replace("'", "\\'") for c in CATEGORICAL_FEATURES}
    numbers = {c: f"CAST({c} AS DOUBLE)" if modes[c] else f"COALESCE(CAST({c} AS DOUBLE), 0D)" for c in NUMERIC_FEATURES}
    parts = [f"{number} AS {_filled(c)}" for c, number in numbers.items()]
    parts += [f"COALESCE({c}, '{quoted[c]}') AS {_filled(c)}" for c in CATEGORICAL_FEATURES]
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def _median_stage() -> Imputer:
    """Medians to within 0.1 % of the ranks, as Spark computes them."""
    columns = [_filled(c) for c in NUMERIC_FEATURES]
    return Imputer(strategy="median", inputCols=columns, outputCols=[f"{c}_imputed" for c in columns])


def _index_stage() -> StringIndexer:
    columns = [_filled(c) for c in CATEGORICAL_FEATURES]
    return StringIndexer(inputCols=columns, outputCols=[f"{c}_index" for c in columns], handleInvalid="keep")


_IMPUTED = [f"{_filled(c)}_imputed" for c in NUMERIC_FEATURES]
_INDEXED = [f"{_filled(c)}_index" for c in CATEGORICAL_FEATURES]


def logistic_pipeline(train: DataFrame, max_iter: int = 1000) -> Pipeline:
    """Median-imputed, standardised numerics and one-hot categories.

    The penalty equals an L2 strength of one on the summed loss; Spark averages
    the loss over the weights, hence one over the row count.
    """
    encoded = [f"{c}_hot" for c in _INDEXED]
    rows = max(train.count(), 1)
    return Pipeline(
        stages=[
            _input_stage(train),
            _median_stage(),
            VectorAssembler(inputCols=_IMPUTED, outputCol="numeric"),
            StandardScaler(inputCol="numeric", outputCol="scaled", withMean=True, withStd=True),
            _index_stage(),
            # the last index is "unseen" and becomes the all-zero vector
            OneHotEncoder(inputCols=_INDEXED, outputCols=encoded, handleInvalid="keep", dropLast=True),
            VectorAssembler(inputCols=["scaled", *encoded], outputCol="features"),
            LogisticRegression(
                featuresCol="features",
                labelCol=LABEL,
                weightCol="class_weight",
                maxIter=max_iter,
                regParam=1.0 / rows,
                standardization=False,
            ),
        ]
    )


def tree_pipeline(train: DataFrame, max_iter: int = 200, step_size: float = 0.05) -> Pipeline:
    """Boosted trees of 15 leaves, grown best first, at least 8 rows per leaf."""
    return Pipeline(
        stages=[
            _input_stage(train),
            _median_stage(),
            _index_stage(),
            VectorAssembler(inputCols=[*_IMPUTED, *_INDEXED], outputCol="features"),
            BestFirstBoosting(
                featuresCol="features",
                labelCol=LABEL,
                weightCol="class_weight",
                maxIter=max_iter,
                stepSize=step_size,
                maxLeaves=15,
                minRows=8,
            ),
        ]
    )


def fit(kind: str, train: DataFrame, **settings) -> PipelineModel:
    build = {LOGISTIC: logistic_pipeline, BOOSTED_TREES: tree_pipeline}[kind]
    # Training passes over its input many times: keep it for the duration.
    rows = train.select(*FEATURE_COLUMNS, LABEL).persist()
    try:
        weighted = with_balanced_weights(rows)
        return _as_stored(build(weighted, **settings).fit(weighted))
    finally:
        rows.unpersist()


def _as_stored(model: PipelineModel) -> PipelineModel:
    """The pipeline with its logistic model saved and loaded again.

    A freshly fitted one goes to the tasks with its training summary and so
    with the session, which cannot be sent once any query of it was observed.
    """
    *before, last = model.stages
    if not isinstance(last, LogisticRegressionModel):
        return model
    path = f"{shared_folder(SparkSession.active())}/model-{uuid.uuid4().hex}"
    last.write().save(path)
    return PipelineModel([*before, LogisticRegressionModel.load(path)])


def predict(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Input columns plus ``churn_probability``."""
    scored = model.transform(features)
    return scored.select(*features.columns, vector_to_array("probability")[1].alias("churn_probability"))


def measure(model: PipelineModel, name: str, validation: DataFrame, test: DataFrame) -> DataFrame:
    """Metrics on validation and test; the cut-off is chosen on validation only."""
    scored_validation = predict(model, validation.select("account_id", *FEATURE_COLUMNS, LABEL)).persist()
    scored_test = predict(model, test.select("account_id", *FEATURE_COLUMNS, LABEL)).persist()
    try:
        threshold = choose_threshold(scored_validation).first()["threshold"]
        role = "baseline" if name == LOGISTIC else "challenger"
        rows = None
        for split, scored in (("validation", scored_validation), ("test", scored_test)):
            row = evaluate_scores(scored, threshold).select(
                F.lit(name).alias("model"), F.lit(role).alias("role"), F.lit(split).alias("split"), "*"
            )
            rows = row if rows is None else rows.unionByName(row)
        # two rows; evaluated here because the scored sets are released below
        return scored_test.sparkSession.createDataFrame(rows.collect(), rows.schema)
    finally:
        scored_validation.unpersist()
        scored_test.unpersist()


def train_and_compare(
    features: DataFrame, tree_iterations: int = 200
) -> tuple[dict[str, PipelineModel], DataFrame, DataFrame]:
    """Fit both models on the early dates; return models, metrics and the choice.

    Give it stored features (see ``export_training_set``): they are read often.
    """
    train, validation, test = temporal_split(features)
    fitted = {
        LOGISTIC: fit(LOGISTIC, train),
        BOOSTED_TREES: fit(BOOSTED_TREES, train, max_iter=tree_iterations),
    }
    results = None
    for name, model in fitted.items():
        measured = measure(model, name, validation, test)
        results = measured if results is None else results.unionByName(measured)
    return fitted, results, select_model(results)


def run_metrics_table(results: DataFrame, run_id: str) -> DataFrame:
    """Finite metrics in long form: run, model, split, metric, value."""
    names = [n for n, kind in results.dtypes if kind in ("double", "bigint", "int")]
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names]))
    return (
        results.select(F.lit(run_id).alias("run_id"), "model", "split", pairs.alias("m"))
        .select("run_id", "model", "split", "m.metric", "m.value")
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
    )


def logistic_gradient(model: PipelineModel, train: DataFrame) -> DataFrame:
    """Gradient of the penalised balanced loss at a fitted logistic model.

    One row per coefficient: ``input`` (column, or column=category) and
    ``gradient``, and one for the intercept.  All are near zero at the optimum
    and nowhere else, the loss being strictly convex, so this tells a fitted
    model from any other.  Sums run over the training rows in one aggregation.
    """
    fitted = model.stages[-1]
    indexer = next(stage for stage in model.stages if isinstance(stage, StringIndexerModel))
    names = list(NUMERIC_FEATURES)
    for column, labels in zip(CATEGORICAL_FEATURES, indexer.labelsArray):
        names += [f"{column}={label}" for label in labels]
        names.append(f"{column}=")  # neither of them
    weighted = with_balanced_weights(train.select(*FEATURE_COLUMNS, LABEL))
    error = F.col("class_weight") * (vector_to_array("probability")[1] - F.col(LABEL))
    scored = model.transform(weighted).select(
        error.alias("error"), "class_weight", F.concat(vector_to_array("features"), F.array(F.lit(1.0))).alias("x")
    )
    summed = (
        scored.select("error", "class_weight", F.posexplode("x").alias("place", "value"))
        .groupBy("place")
        .agg((F.sum(F.col("error") * F.col("value")) / F.sum("class_weight")).alias("slope"))
    )
    held = [*(float(c) for c in fitted.coefficients), 0.0]
    size = len(held) - 1
    if len(names) < size:
        raise ValueError("more coefficients than inputs")
    penalty = fitted.getOrDefault("regParam")
    rows = [(i, [*names[:size], "intercept"][i], penalty * held[i]) for i in range(size + 1)]
    parts = train.sparkSession.createDataFrame(rows, "place int, input string, shrinkage double")
    return parts.join(summed, "place").select("input", (F.col("slope") + F.col("shrinkage")).alias("gradient"))


#: Steps a walk back into the range may take.  The square holds fewer than
#: 2 * sqrt(n) + 2 surplus places and a walk meets each at most once; for large
#: n the chance of this many in a row is below 1e-70.
_WALK = 64


def keyed_permutation(position: Column, total: int, *key: Column, rounds: int = 6) -> Column:
    """Place of ``position`` (from 0) in a permutation of ``total`` places chosen by ``key``.

    A Feistel network on the two digits of the position in base ceil(sqrt(total))
    permutes the square of that base; places beyond the total walk on until they
    fall below it.  Every row computes its own place: no sort, no shuffle.
    """
    side = F.lit(max(isqrt(max(total, 1) - 1) + 1, 1)).cast("bigint")

    def spread(place: Column) -> Column:
        high, low = F.floor(place / side).cast("bigint"), F.pmod(place, side)
        for number in range(rounds):
            high, low = low, F.pmod(high + F.pmod(F.xxhash64(*key, F.lit(number), low), side), side)
        return high * side + low

    once = spread(position)
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(_WALK)), once, lambda place, _: F.when(place < total, place).otherwise(spread(place))
    )
    return F.when(once < total, once).otherwise(walked)


#: Rows of a shuffled column, about, that are ranked by one task at a time.
_STRETCH_ROWS = 20_000
#: Stretches of a shuffled column at most; with more rows they are longer.
_STRETCHES = 100


def shuffled_partners(rows: DataFrame, repeats: int, seed: int = 42) -> DataFrame:
    """``rows`` once per repeat with a dense ``position`` and the ``partner`` to borrow from.

    Positions (from 0) follow a hash of account and date; in each repeat the
    partners are an independent permutation of the positions.
    """
    counted = rows.withColumn("one", F.lit(1).cast("bigint"))
    shuffle_key = F.xxhash64(F.lit(seed), F.col("account_id"), F.col("prediction_date"))
    placed = running_totals(counted, [shuffle_key, F.col("account_id")], {"position": "one"}).drop("one")
    repeated = placed.withColumn("position", F.col("position") - 1).withColumn(
        "repeat", F.explode(F.sequence(F.lit(1), F.lit(repeats)))
    )
    partner = keyed_permutation(F.col("position"), rows.count(), F.lit(seed), F.col("repeat"))
    return repeated.withColumn("partner", partner)


def _places_of(model: PipelineModel) -> dict[str, list[int]]:
    """Places of the model's input vector that are made of each column."""
    hot = next((stage for stage in model.stages if isinstance(stage, OneHotEncoderModel)), None)
    widths = [1] * len(NUMERIC_FEATURES)
    # unseen categories have a place of their own, of which the last is left out
    widths += [1] * len(CATEGORICAL_FEATURES) if hot is None else [int(size) for size in hot.categorySizes]
    found, first = {}, 0
    for column, width in zip((*NUMERIC_FEATURES, *CATEGORICAL_FEATURES), widths):
        found[column] = list(range(first, first + width))
        first += width
    return found


#: Rows scored at a time: what the parts of a model add to them stays in the processor's cache.
_SCORED_AT_ONCE = 2_000


def _swapper(last: Model, swaps: Sequence[Sequence[int]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Scores of each row with each of ``swaps``, places of its vector taken from its donor.

    A model is a sum of parts, terms or trees, under the logistic function.
    Only parts that read a swapped place are worked out again; the sum runs
    over all parts in one order, so that equal inputs have equal scores.
    """
    if isinstance(last, BestFirstModel):
        make = last.parts
    else:
        weights, bias = np.array(last.coefficients.toArray()), last.intercept

        def make():
            terms = [lambda x, i=i: weights[i] * x[i] for i in range(len(weights))]
            return (lambda x: x), [*terms, lambda x: np.full(x.shape[1], bias)], [*({i} for i in range(len(weights))), set()]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prepare, parts, reads = make()
        again = [[k for k, read in enumerate(reads) if not read.isdisjoint(swap)] for swap in swaps]

        def chances(vectors):
            size = len(vectors[0])
            own, donor = (prepare(np.asarray(v.flatten()).reshape(size, -1).T) for v in vectors)
            added = np.stack([part(own) for part in parts])
            mixed = own.copy()
            for swap, changed in zip(swaps, again):
                swap = [place for place in swap if place < len(own)]
                mixed[swap] = donor[swap]
                kept = added[changed]
                for k in changed:
                    added[k] = parts[k](mixed)
                yield 1.0 / (1.0 + np.exp(-added.sum(axis=0)))
                added[changed], mixed[swap] = kept, own[swap]

        for whole in batches:
            for first in range(0, whole.num_rows, _SCORED_AT_ONCE):
                batch = whole.slice(first, _SCORED_AT_ONCE)
                size = batch.num_rows
                scores = np.concatenate(list(chances((batch.column(0), batch.column(1)))))
                repeat, label = (np.tile(np.asarray(batch.column(i), np.int32), len(swaps)) for i in (2, 3))
                columns = (np.repeat(np.arange(len(swaps), dtype=np.int32), size), repeat, label, scores)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["feature", "repeat", LABEL, "churn_probability"])

    return score


def permutation_importance(
    model: PipelineModel,
    held_out: DataFrame,
    repeats: int = 20,
    seed: int = 42,
    features: Sequence[str] = FEATURE_COLUMNS,
) -> DataFrame:
    """Mean and deviation of the loss in average precision per shuffled column.

    All shuffles are one DataFrame keyed by (feature, repeat).  In each repeat a
    row borrows the column value of its partner under an independent
    permutation, which costs one equi-join for all columns and repeats.  What
    comes before the model itself treats every column on its own, so it is
    applied to the rows once and the values it made of a column are swapped.
    """
    before, last = PipelineModel(model.stages[:-1]), model.stages[-1]
    rows = before.transform(held_out.select("account_id", "prediction_date", *FEATURE_COLUMNS, LABEL)).select(
        "account_id", "prediction_date", LABEL, vector_to_array("features").alias("x")
    )
    partnered = shuffled_partners(rows, repeats, seed)
    donors = partnered.where("repeat = 1").select(F.col("position").alias("partner"), F.col("x").alias("donor"))
    pairs = partnered.join(donors, "partner").select("x", "donor", "repeat", LABEL)
    places = _places_of(model)
    scored = pairs.mapInArrow(
        _swapper(last, [places[f] for f in features]), f"feature int, repeat int, {LABEL} int, churn_probability double"
    )
    unchanged = rows.select("x", F.col("x").alias("donor"), F.lit(0).alias("repeat"), LABEL)
    known = stable(unchanged.mapInArrow(_swapper(last, [[]]), scored.schema).drop("feature", "repeat"))
    shares = min(max(-(-known.count() // _STRETCH_ROWS), 1), _STRETCHES)
    cuts = known.approxQuantile("churn_probability", [i / shares for i in range(1, shares)], 0.1 / shares) if shares > 1 else []
    precision = ranking_metrics(scored, keys=("feature", "repeat"), cuts=cuts)
    precision = precision.withColumn("feature", F.element_at(F.array(*[F.lit(f) for f in features]), F.col("feature") + 1))
    baseline = ranking_metrics(known).select("pr_auc").scalar()
    return precision.groupBy("feature").agg(
        F.avg(baseline - F.col("pr_auc")).alias("importance_mean"),
        F.stddev_pop(baseline - F.col("pr_auc")).alias("importance_std"),
        F.count("*").alias("repeats"),
    )
