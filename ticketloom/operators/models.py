"""Training, validation, search and scoring of the two ticket classifiers with Spark ML."""

from __future__ import annotations

import math
import random
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.functions import vectors
from ticketloom.operators.aggregates import balanced_weights
from ticketloom.operators.joins import attach_class_weight
from ticketloom.operators.metrics import classification_report
from ticketloom.operators.ordering import hash_fraction
from ticketloom.session import cut_lineage

# The space hyper-parameters are drawn from.
SEARCH_SPACE = {
    "max_depth": ("choice", [3, 4, 5, 6, 7, 8]),
    "learning_rate": ("loguniform", 0.01, 0.3),
    "n_estimators": ("choice", [50, 100, 150, 200]),
    "min_child_weight": ("choice", [1, 3, 5, 7]),
    "subsample": ("uniform", 0.6, 1.0),
    "colsample_bytree": ("uniform", 0.6, 1.0),
}


def encode_label(df: DataFrame, col: str, out: str = "label") -> DataFrame:
    """Adds the position of each class in ascending order, from 0."""
    return _indexer(df, col, out).transform(df)


def _indexer(df: DataFrame, col: str, out: str):
    return StringIndexer(inputCol=col, outputCol=out, stringOrderType="alphabetAsc", handleInvalid="error").fit(df)


def class_index(df: DataFrame, col: str) -> DataFrame:
    """(class, index): the table behind ``encode_label``."""
    labels = _indexer(df, col, "__index").labels
    return df.sparkSession.createDataFrame(list(zip(labels, range(len(labels)))), "class string, index int")


def estimator(kind: str = "boosted", weighted: bool = False, **params):
    """A Spark classifier for the given parameters, by the names of the search space.

    'forest' and 'logistic' are multiclass; 'boosted' is one-vs-rest over boosted trees, whose scores
    ``predict`` turns into probabilities.
    """
    weight = {"weightCol": "weight"} if weighted else {}
    depth = int(params.get("max_depth", 6))
    trees = int(params.get("n_estimators", 20))
    seed = int(params.get("seed", 42))
    sample = float(params.get("subsample", 1.0))
    columns = str(params.get("colsample_bytree", "auto"))
    leaf = int(params.get("min_child_weight", 1))
    if kind == "logistic":
        return LogisticRegression(maxIter=int(params.get("max_iter", 50)), regParam=float(params.get("reg", 0.01)), **weight)
    if kind == "boosted":
        tree = GBTClassifier(
            maxDepth=depth, maxIter=trees, stepSize=float(params.get("learning_rate", 0.1)), seed=seed,
            subsamplingRate=sample, featureSubsetStrategy=columns if columns != "auto" else "all",
            minInstancesPerNode=leaf,
        )
        return OneVsRest(classifier=tree, parallelism=4, **weight)
    return RandomForestClassifier(
        maxDepth=depth, numTrees=trees, seed=seed, subsamplingRate=sample,
        featureSubsetStrategy=columns, minInstancesPerNode=leaf, **weight,
    )


def train_classifier(
    train: DataFrame, target: str, kind: str = "boosted", balanced: bool = False, features: str = "features", **params
) -> PipelineModel:
    """Classifier with its label encoder; ``balanced`` weighs rows by their class."""
    data = train.where(F.col(target).isNotNull())
    indexer = _indexer(data, target, "label")
    labelled = indexer.transform(data)
    if balanced:
        labelled = attach_class_weight(labelled, balanced_weights(data, target), target)
    fit = estimator(kind, balanced, **params)
    fit.setFeaturesCol(features)
    if kind != "boosted":
        fit.setProbabilityCol("probability")
    model = fit.fit(labelled)
    decoder = IndexToString(inputCol="prediction", outputCol=f"predicted_{target}", labels=indexer.labels)
    return PipelineModel([model, decoder])


def predict(model: PipelineModel, df: DataFrame, target: str) -> DataFrame:
    """Adds ``predicted_<target>`` and ``confidence_<target>``, the probability of the predicted class."""
    scored = class_probabilities(model, df, "__p")
    label = vectors.arg_max_label(F.col("__p"), model.stages[-1].getLabels())
    return scored.select(
        *df.columns, label.alias(f"predicted_{target}"), F.array_max("__p").alias(f"confidence_{target}")
    )


def class_probabilities(model: PipelineModel, df: DataFrame, out: str = "probabilities") -> DataFrame:
    """Adds the probabilities of the model's classes, in the order of its labels.

    Boosted trees score each class against the rest; a margin m stands for odds of exp(2 m), and the
    classes' shares are made to add up to one.
    """
    scored = model.transform(df)
    if "probability" in scored.columns:
        return scored.select(*df.columns, vector_to_array("probability").alias(out))
    share = F.transform(vector_to_array("rawPrediction"), lambda m: 1.0 / (1.0 + F.exp(-2.0 * m)))
    total = F.aggregate("__share", F.lit(0.0), lambda s, x: s + x)
    one = scored.select(*df.columns, share.alias("__share"))
    return one.select(*df.columns, F.transform("__share", lambda x: x / total).alias(out))


def predict_batch(df: DataFrame, models: dict[str, PipelineModel]) -> DataFrame:
    """Scores every target in turn over a table with a ``features`` vector."""
    for target, model in models.items():
        df = predict(model, df, target)
    return df


def evaluate(model: PipelineModel, test: DataFrame, target: str) -> DataFrame:
    """Classification report on held-out rows."""
    return classification_report(predict(model, test, target), target, f"predicted_{target}")


def _evaluator() -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(metricName="weightedFMeasure", labelCol="label")


FOLDS, HOLDOUT = "folds", "holdout"


def validation_parts(
    df: DataFrame, target: str, validation: str = FOLDS, k: int = 3, share: float = 0.2, seed: int = 42, id_col: str = "id"
) -> DataFrame:
    """Labelled rows with the ``part`` they validate: one of ``k`` folds, or 0 for the held-out share and NULL."""
    # not the hash by which samples are drawn: those hold the rows with the smallest ones
    place = hash_fraction(id_col, f"fold-{seed}")
    part = F.floor(place * k).cast("int") if validation == FOLDS else F.when(place < share, 0)
    return encode_label(df.where(F.col(target).isNotNull()), target).withColumn("part", part)


def cross_validate(
    df: DataFrame, target: str, k: int = 3, kind: str = "boosted", balanced: bool = False,
    seed: int = 42, id_col: str = "id", **params,
) -> float:
    """Mean weighted F1 over ``k`` folds; a row's fold follows from its id."""
    return random_search(df, target, [params], k, kind, balanced, seed, id_col, parallelism=1).first()["score"]


#: Parameters of the search space that only some kinds of model have.
ONLY_BOOSTED = {"learning_rate"}


def draw_params(n: int, seed: int = 42, space: dict = SEARCH_SPACE, kind: str = "boosted") -> list[dict]:
    """``n`` reproducible parameter sets, of the parameters that models of this kind use."""
    space = {name: rule for name, rule in space.items() if kind == "boosted" or name not in ONLY_BOOSTED}
    rng = random.Random(seed)

    def one(rule):
        if rule[0] == "choice":
            return rng.choice(rule[1])
        if rule[0] == "loguniform":
            return math.exp(rng.uniform(math.log(rule[1]), math.log(rule[2])))
        return rng.uniform(rule[1], rule[2])

    return [{name: one(rule) for name, rule in space.items()} for _ in range(n)]


def random_search(
    df: DataFrame, target: str, sets: list[dict] | int, k: int = 3, kind: str = "boosted",
    balanced: bool = False, seed: int = 42, id_col: str = "id", parallelism: int = 4,
    validation: str = FOLDS, share: float = 0.2,
) -> DataFrame:
    """(run_id, params, score, parts) for each parameter set, scored by weighted F1.

    ``validation`` is 'folds' (the mean over ``k``) or 'holdout' (the held-out ``share``). With ``balanced``, rows
    are weighted by their class in the part that is trained on. ``parts`` tells the rows trained and validated on
    and the score of each fit.
    """
    if isinstance(sets, int):
        sets = draw_params(sets, seed, kind=kind)
    marked = cut_lineage(validation_parts(df, target, validation, k, share, seed, id_col))
    parts = []
    for part in range(k if validation == FOLDS else 1):
        held = F.col("part").eqNullSafe(part)
        train, valid = marked.where(~held), marked.where(held)
        if balanced:
            train = cut_lineage(attach_class_weight(train, balanced_weights(train, target), target))
        parts.append((part, train, valid, train.count(), valid.count()))

    def measured(job) -> tuple:
        params, (part, train, valid, n_train, n_valid) = job
        score = _evaluator().evaluate(estimator(kind, balanced, **params).fit(train).transform(valid))
        return part, n_train, n_valid, float(score)

    with ThreadPoolExecutor(parallelism) as pool:
        found = list(pool.map(measured, [(params, part) for params in sets for part in parts]))
    rows = []
    for i, params in enumerate(sets):
        own = found[i * len(parts) : (i + 1) * len(parts)]
        score = sum(x[3] for x in own) / len(own)
        rows.append((f"run-{i:03d}", {name: str(v) for name, v in params.items()}, score, own))
    part = "struct<part:int,n_train:bigint,n_valid:bigint,score:double>"
    return df.sparkSession.createDataFrame(rows, f"run_id string, params map<string,string>, score double, parts array<{part}>")


def save_model(model: PipelineModel, path: str) -> None:
    """Classifier and decoder together, in Spark's own format."""
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    return PipelineModel.load(path)
