"""Click models: boosted trees, random forests, scoring and serving.

Trainers pass over their samples several times, and served lists are read once per kind of
user; both are written once, so that what makes them runs once.
"""

from __future__ import annotations

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunecrate.functions import measures, vectors
from tunecrate.operators.filters import split_by_key
from tunecrate.operators.lists import ITEM, USER
from tunecrate.operators.ranking_windows import top_n
from tunecrate.session import cut_lineage


def as_samples(df: DataFrame, features: str = "features") -> DataFrame:
    """Array features to the vector type, at the model border only."""
    return df.withColumn(features, array_to_vector(F.col(features)))


def gbdt_train(samples: DataFrame, params: str, seed: int = 12345, subsample: float = 0.5) -> GBTClassificationModel:
    """Boosted trees on (label, features array). params: ``iterations_depth_rate``, e.g. ``200_6_0.05``."""
    iterations, depth, rate = params.split("_")
    trainer = GBTClassifier(
        maxIter=int(iterations), maxDepth=int(depth), stepSize=float(rate), maxBins=32,
        subsamplingRate=subsample, seed=seed,
    )
    return trainer.fit(as_samples(cut_lineage(samples)))


def boosted_rounds(samples: DataFrame, rounds: int = 15, depth: int = 5, eta: float = 1.0, seed: int = 1) -> GBTClassificationModel:
    """Boosting with step 1.0 and depth 5; the L2 leaf penalty has no Spark counterpart."""
    return gbdt_train(samples, f"{rounds}_{depth}_{eta}", seed, subsample=1.0)


def gbdt_score(df: DataFrame, model: GBTClassificationModel, out: str = "prob") -> DataFrame:
    """Adds ``margin`` (weighted tree sum) and ``prob`` = sigmoid(margin)."""
    scored = model.transform(as_samples(df.withColumn("_array", F.col("features"))))
    margin = vector_to_array("rawPrediction").getItem(1)
    kept = scored.select(*[F.col("_array").alias("features") if c == "features" else F.col(c) for c in df.columns],
                         margin.alias("margin"))
    return kept.withColumn(out, measures.sigmoid(F.col("margin")))


def train_and_hold_out(samples: DataFrame, params: str, key: str, seed: int = 12345, train: float = 0.8) -> tuple[GBTClassificationModel, DataFrame]:
    """Model on the seeded training part and the scored hold-out part."""
    fit_on, held = split_by_key(samples, train, seed, key)
    model = gbdt_train(fit_on, params, seed)
    return model, gbdt_score(held, model)


def rank_serve(
    lists: DataFrame, user_vectors: DataFrame, item_vectors: DataFrame, model: GBTClassificationModel, n: int
) -> DataFrame:
    """(user_id, item_id): top ``n`` per user by predicted probability.

    Users without features keep their whole list. lists: long form (user_id, item_id).
    """
    with_user = cut_lineage(lists.select(USER, ITEM)).join(user_vectors.select(USER, F.col("features").alias("_u")), USER, "left")
    plain = with_user.where(F.col("_u").isNull()).select(USER, ITEM)
    pairs = (
        with_user.where(F.col("_u").isNotNull())
        .join(item_vectors.select(ITEM, F.col("features").alias("_v")), ITEM)
        .select(USER, ITEM, vectors.joined(F.col("_u"), F.col("_v")).alias("features"))
    )
    scored = gbdt_score(pairs, model).select(USER, ITEM, F.round("prob", 9).alias("prob"))
    best = top_n(scored, [USER], [F.desc("prob"), F.col(ITEM)], n, "rank")
    return plain.unionByName(best.select(USER, ITEM))


def _forest_pipeline(trees: int, depth: int, impurity: str, categories: int, seed: int) -> Pipeline:
    return Pipeline(
        stages=[
            StringIndexer(inputCol="label", outputCol="indexedLabel", stringOrderType="alphabetAsc"),
            VectorIndexer(inputCol="features", outputCol="indexedFeatures", maxCategories=categories, handleInvalid="keep"),
            RandomForestClassifier(
                labelCol="indexedLabel", featuresCol="indexedFeatures", numTrees=trees,
                maxDepth=min(depth, 30), impurity=impurity, seed=seed,
            ),
        ]
    )


def rf_train(
    samples: DataFrame, trees: int = 100, depth: int = 10, impurity: str = "entropy", categories: int = 2, seed: int = 1
) -> PipelineModel:
    """Label index, feature index, forest. Depth is limited to 30 by Spark."""
    return _forest_pipeline(trees, depth, impurity, categories, seed).fit(as_samples(cut_lineage(samples)))


def rf_score(df: DataFrame, model: Model, keys: list[str]) -> DataFrame:
    """(keys, prob): probability of the second (positive) class."""
    scored = model.transform(as_samples(df))
    return scored.select(*keys, vector_to_array("probability").getItem(1).alias("prob"))


def rf_score_split(
    pairs: DataFrame, user_vectors: DataFrame, item_vectors: DataFrame, model: Model
) -> tuple[DataFrame, DataFrame]:
    """(scored pairs, pairs of users without a profile)."""
    pairs = cut_lineage(pairs)
    users = user_vectors.select(USER, F.col("features").alias("_u"))
    scorable = (
        pairs.join(users, USER)
        .join(item_vectors.select(ITEM, F.col("features").alias("_v")), ITEM)
        .select(USER, ITEM, vectors.joined(F.col("_u"), F.col("_v")).alias("features"))
    )
    return rf_score(scorable, model, [USER, ITEM]), pairs.join(users, USER, "left_anti")


def rf_pair_rank(
    samples: DataFrame, pairs: DataFrame, n: int = 18, trees: int = 100, depth: int = 10, seed: int = 1
) -> DataFrame:
    """(a, b, prob, rank): candidate pairs ranked by a forest trained on click labels."""
    model = rf_train(samples.select("label", "features"), trees, depth, "entropy", 2, seed)
    scored = rf_score(pairs, model, ["a", "b"]).withColumn("prob", F.round("prob", 9))
    return top_n(scored, ["a"], [F.desc("prob"), F.col("b")], n, "rank")


def rf_test_error(
    samples: DataFrame, key: str, trees: int = 100, depth: int = 50, seed: int = 1, train: float = 0.7
) -> tuple[PipelineModel, float]:
    """Forest and its share of wrong labels on the held-out part."""
    fit_on, held = split_by_key(samples, train, seed, key)
    model = rf_train(fit_on, trees, depth, "gini", 2, seed)
    predicted = model.transform(as_samples(held))
    accuracy = MulticlassClassificationEvaluator(
        labelCol="indexedLabel", predictionCol="prediction", metricName="accuracy"
    ).evaluate(predicted)
    return model, 1.0 - accuracy


def rf_grid_cv(samples: DataFrame, grid: str, folds: int, seed: int = 1) -> DataFrame:
    """(trees, depth, impurity, auc): k-fold AUC per setting. grid: ``20,50=5,10=gini,entropy``."""
    trees, depths, impurities = grid.split("=")
    pipeline = _forest_pipeline(20, 5, "gini", 2, seed)
    forest = pipeline.getStages()[2]
    maps = (
        ParamGridBuilder()
        .addGrid(forest.numTrees, [int(x) for x in trees.split(",")])
        .addGrid(forest.maxDepth, [int(x) for x in depths.split(",")])
        .addGrid(forest.impurity, impurities.split(","))
        .build()
    )
    evaluator = BinaryClassificationEvaluator(labelCol="indexedLabel", rawPredictionCol="probability")
    fitted = CrossValidator(
        estimator=pipeline, estimatorParamMaps=maps, evaluator=evaluator, numFolds=folds, seed=seed
    ).fit(as_samples(samples))
    rows = [
        (m[forest.numTrees], m[forest.maxDepth], m[forest.impurity], float(auc))
        for m, auc in zip(maps, fitted.avgMetrics)
    ]
    return samples.sparkSession.createDataFrame(rows, "trees int, depth int, impurity string, auc double")
