"""Splits, metrics, regressors, text classifiers and clustering on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import LDA, KMeans
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    HashingTF,
    Normalizer,
    StopWordsRemover,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions import text as tx
from ledgerleaf.functions.words import STOP_WORDS
from ledgerleaf.operators.corpus import content_tokens
from ledgerleaf.operators.topics import class_terms
from ledgerleaf.session import checkpointed


# --- splits -----------------------------------------------------------------------

def hash_bucket(key: Column, buckets: int = 100) -> Column:
    """A stable pseudo-random bucket that depends on the key only."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % buckets


def split_parts(df: DataFrame, key: str, train: int = 64, validation: int = 16) -> DataFrame:
    """Adds ``part``: train / validation / test in percent; equal keys stay together."""
    bucket = hash_bucket(F.col(key))
    part = F.when(bucket < train, "train").when(bucket < train + validation, "validation").otherwise("test")
    return df.withColumn("part", part)


# --- classification metrics ----------------------------------------------------------

def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def classification_scores(counts: DataFrame) -> DataFrame:
    """``rows, accuracy, mcc`` of a confusion table; the correlation is the multiclass one."""
    rows = counts.agg(F.sum("n").alias("s"), F.sum(F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0)).alias("c"))
    by_label = counts.groupBy(F.col("label").alias("k")).agg(F.sum("n").alias("truth"))
    by_guess = counts.groupBy(F.col("predicted").alias("k")).agg(F.sum("n").alias("guess"))
    sides = by_label.join(by_guess, "k", "full").fillna(0, subset=["truth", "guess"])
    products = sides.agg(
        F.sum(F.col("truth") * F.col("guess")).alias("tp"),
        F.sum(F.col("truth") * F.col("truth")).alias("tt"),
        F.sum(F.col("guess") * F.col("guess")).alias("pp"),
    )
    tp, tt, pp = (products.select(c).scalar() for c in ("tp", "tt", "pp"))
    s, c = F.col("s").cast("double"), F.col("c").cast("double")
    spread = F.sqrt(s * s - pp) * F.sqrt(s * s - tt)
    mcc = F.when(spread == 0, F.lit(0.0)).otherwise((c * s - tp) / spread)
    return rows.select(F.col("s").alias("rows"), F.try_divide(c, s).alias("accuracy"), mcc.alias("mcc"))


# --- regression -----------------------------------------------------------------------

def regressors(seed: int = 42) -> dict[str, Estimator]:
    """The compared regressors; nearest neighbour is :func:`ledgerleaf.operators.search.nearest`."""
    columns = {"featuresCol": "features", "labelCol": "scaled", "predictionCol": "scaled_prediction"}
    return {
        "linear": LinearRegression(**columns),
        "random_forest": RandomForestRegressor(numTrees=20, maxDepth=5, seed=seed, **columns),
        "gradient_boosting": GBTRegressor(maxIter=10, maxDepth=3, seed=seed, **columns),
        "decision_tree": DecisionTreeRegressor(maxDepth=5, seed=seed, **columns),
    }


class ScaledTargetModel:
    """A regressor whose target was mapped onto 0 … 1 for the fit; predictions come back unscaled."""

    def __init__(self, pipeline: PipelineModel, low: float, high: float):
        self.pipeline, self.low, self.high = pipeline, low, high

    def transform(self, df: DataFrame) -> DataFrame:
        scored = self.pipeline.transform(df)
        return scored.withColumn("prediction", F.col("scaled_prediction") * (self.high - self.low) + self.low)


def fit_scaled(train: DataFrame, features: Sequence[str], target: str, estimator: Estimator) -> ScaledTargetModel:
    """Fit on the min-max scaled target; only the two extremes come to the driver."""
    low, high = train.agg(F.min(target), F.max(target)).first()
    width = (high - low) or 1.0
    scaled = train.withColumn("scaled", (F.col(target) - low) / width)
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    return ScaledTargetModel(Pipeline(stages=[assembler, estimator]).fit(scaled), low, low + width)


def fitted_in_parallel(jobs: Sequence[tuple], parallelism: int = 4) -> list[ScaledTargetModel]:
    """``fit_scaled(*job)`` for several independent small fits at a time, as a cross-validator runs its folds."""
    with ThreadPool(parallelism) as pool:
        return pool.map(inheritable_thread_target(lambda job: fit_scaled(*job)), jobs)


def one_feature_line(df: DataFrame, keys: Sequence[str], target: str, feature: str) -> DataFrame:
    """``keys, slope, intercept`` of the least-squares line per group, in one grouped aggregate."""
    return df.groupBy(*keys).agg(
        F.regr_slope(target, feature).alias("slope"), F.regr_intercept(target, feature).alias("intercept")
    )


def fold_summary(scores: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Mean and population deviation of each metric over the folds."""
    return scores.groupBy(*keys).agg(
        *[F.avg(m).alias(f"{m}_mean") for m in metrics], *[F.stddev_pop(m).alias(f"{m}_std") for m in metrics]
    )


# --- text classification ------------------------------------------------------------------

def with_tokens(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn("tokens", tx.tokens(F.col(text)))


def text_features(size: int = 1 << 14) -> list:
    """Stages from tokens to weighted feature vectors."""
    return [
        StopWordsRemover(inputCol="tokens", outputCol="content", stopWords=STOP_WORDS),
        HashingTF(inputCol="content", outputCol="tf", numFeatures=size),
        IDF(inputCol="tf", outputCol="features"),
    ]


def fit_text_classifier(train: DataFrame, label: str, size: int = 1 << 14) -> PipelineModel:
    """Multinomial text classifier; classes are numbered alphabetically."""
    indexer = StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc", handleInvalid="keep")
    logistic = LogisticRegression(maxIter=20, regParam=0.01)
    return Pipeline(stages=[indexer, *text_features(size), logistic]).fit(train)


# --- topics by clustering ---------------------------------------------------------------------

def topic_model(docs: DataFrame, k: int, top: int = 10, cells: int = 1 << 16, seed: int = 100):
    """Corpus-wide latent topics: ``topic, rank, token, weight`` and the fitted stages.

    Every word counts: words are filed in ``cells`` cells by hash, and a topic's cell is called
    by its most frequent word, so that neither the model nor the driver grows with the vocabulary.
    """
    content = F.filter("tokens", lambda w: ~w.isin(STOP_WORDS))
    filed = F.transform(content, lambda w: F.pmod(F.xxhash64(w), F.lit(cells)).cast("string"))
    prepared = checkpointed(with_tokens(docs).select(content.alias("content"), filed.alias("filed")))
    stages = [
        CountVectorizer(inputCol="filed", outputCol="features", vocabSize=cells, minDF=1.0),
        LDA(k=k, seed=seed, optimizer="online", maxIter=10),
    ]
    model = Pipeline(stages=stages).fit(prepared)
    described = model.stages[1].describeTopics(top)
    rows = described.select("topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("i", "t"))
    # Both tables are bounded by parameters: the cells, and k times the leading terms.
    numbers = docs.sparkSession.createDataFrame(list(enumerate(model.stages[0].vocabulary)), "index int, cell string")
    leading = rows.join(numbers, F.col("t.termIndices") == F.col("index"))
    words = prepared.select(F.explode(F.arrays_zip("filed", "content")).alias("w")).select(
        F.col("w.filed").alias("cell"), F.col("w.content").alias("token")
    )
    counts = words.join(F.broadcast(leading.select("cell").distinct()), "cell").groupBy("cell", "token").agg(
        F.count("*").alias("n")
    )
    names = counts.groupBy("cell").agg(F.max_by("token", F.struct("n", "token")).alias("token"))
    named = leading.join(names, "cell")
    return named.select("topic", (F.col("i") + 1).alias("rank"), "token", F.col("t.termWeights").alias("weight")), model


def fit_clusters(docs: DataFrame, k: int, size: int = 256, seed: int = 42) -> PipelineModel:
    """Hashed TF-IDF embedding, unit length, then k-means; ``tokens`` of :func:`with_tokens` are taken as they are."""
    stages = [
        *text_features(size)[:2],
        IDF(inputCol="tf", outputCol="weighted"),
        Normalizer(inputCol="weighted", outputCol="features"),
        KMeans(k=k, seed=seed, maxIter=10, featuresCol="features", predictionCol="cluster"),
    ]
    return Pipeline(stages=stages).fit(docs if "tokens" in docs.columns else with_tokens(docs))


def centre_distance(model: PipelineModel, scored: DataFrame) -> DataFrame:
    """Adds ``distance`` of each row to its cluster centre; there are k centres, a parameter."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.stages[-1].clusterCenters())]
    centres = scored.sparkSession.createDataFrame(rows, "cluster int, _centre array<double>")
    met = scored.join(F.broadcast(centres), "cluster")
    gaps = F.zip_with(vector_to_array("features"), "_centre", lambda a, b: (a - b) * (a - b))
    distance = F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda s, v: s + v))
    return met.withColumn("distance", distance).drop("_centre")


def with_outliers(scored: DataFrame, known: DataFrame | None = None, share: float = 0.05) -> DataFrame:
    """Adds ``topic``: the cluster, or −1 beyond the distance to their centre that the ``share`` of the rows of
    ``known`` (``scored`` itself by default) exceed."""
    border = (scored if known is None else known).agg(F.percentile_approx("distance", F.lit(1 - share), F.lit(10000)).alias("b")).scalar()
    return scored.withColumn("topic", F.when(F.col("distance") > border, F.lit(-1)).otherwise(F.col("cluster")))


def topic_info(assigned: DataFrame, top: int = 3) -> DataFrame:
    """``topic, n, name``: size and leading terms of each topic."""
    counts = content_tokens(assigned, "topic").groupBy("topic", "token").agg(F.count("*").alias("n"))
    leading = class_terms(counts, "topic", top)
    ordered = F.array_sort(F.collect_list(F.struct("rank", "token")))
    names = leading.groupBy("topic").agg(F.array_join(F.transform(ordered, lambda x: x["token"]), "_").alias("name"))
    sizes = assigned.groupBy("topic").agg(F.count("*").alias("n"))
    return sizes.join(names, "topic", "left").select("topic", "n", "name")

