"""Splits, regressions, cross-validation, classifiers and topic models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerleaf.functions import text as tx
from ledgerleaf.operators import density, frame, learn, series, vectors
from ledgerleaf.operators.documents import polarity
from ledgerleaf.operators.search import nearest
from ledgerleaf.plans.derived import SQL_BILLED_ORDERS, SQL_MONTHLY, billed_months, in_millions, month_totals, monthly_series
from ledgerleaf.plans.documents import sql_polarity
from ledgerleaf.plans.registry import query
from ledgerleaf.plans.series import KEY, rounded
from ledgerleaf.session import checkpointed, shared_dir

# --- splits --------------------------------------------------------------------------

MD5_BUCKET = "CAST(('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 8)) AS BIGINT) % 100"


@query(
    "m01_hash_split",
    f"""SELECT doc_id, CASE WHEN b < 64 THEN 'train' WHEN b < 80 THEN 'validation' ELSE 'test' END AS part
        FROM (SELECT doc_id, {MD5_BUCKET.format(k='doc_id')} AS b FROM documents)""",
)
def _(t):
    return learn.split_parts(t.documents.select("doc_id"), "doc_id")


SQL_FOLDS = f"""{SQL_MONTHLY}, sized AS (SELECT *, COUNT(*) OVER (PARTITION BY series_id) AS n FROM monthly),
  spread AS (SELECT *, CAST(f AS INTEGER) AS fold, n - (6 - f) * (n // 6) AS first_test, n // 6 AS size
             FROM sized, generate_series(1, 5) AS g(f)),
  folds AS (SELECT series_id, ts, t, amount, n_requests, n_orgs, fold,
              CASE WHEN t <= first_test THEN 'train' ELSE 'test' END AS part
            FROM spread WHERE t <= first_test + size)"""


@query("m03_expanding_folds", f"WITH {SQL_FOLDS} SELECT series_id, ts, fold, part FROM folds")
def _(t):
    return series.expanding_folds(monthly_series(t), KEY).select("series_id", "ts", "fold", "part")


# --- regressors -----------------------------------------------------------------------

def panel(t):
    """Monthly rows per segment and nation with regression features and a stable ``vec_id``."""
    monthly = in_millions(billed_months(t).groupBy("c_mktsegment", "c_nationkey", "ts").agg(*month_totals("o_custkey")))
    keyed = series.with_time_index(monthly, ["c_mktsegment", "c_nationkey"], "ts")
    parts = series.split_last(keyed, ["c_mktsegment", "c_nationkey"])
    return parts.withColumns(
        {
            "month": F.month("ts").cast("double"),
            "year": F.year("ts").cast("double"),
            "vec_id": F.concat_ws("-", "c_mktsegment", "c_nationkey", "ts"),
        }
    )


FEATURES = ["n_requests", "n_orgs", "month", "year"]
SQL_PANEL = f"""{SQL_BILLED_ORDERS}, pm AS (
    SELECT c_mktsegment, c_nationkey, last_day(day) AS ts, CAST(SUM(billed) AS DOUBLE) / 1e6 AS amount,
           COUNT(*) AS n_requests, COUNT(DISTINCT o_custkey) AS n_orgs FROM billed_orders GROUP BY ALL),
  panel AS (SELECT *, month(ts) AS month, year(ts) AS year,
      CASE WHEN ROW_NUMBER() OVER (PARTITION BY c_mktsegment, c_nationkey ORDER BY ts DESC) <= 12
           THEN 'test' ELSE 'train' END AS part,
      c_mktsegment || '-' || c_nationkey || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS vec_id
    FROM pm)"""

SQL_SCALED_LINE = f"""{SQL_MONTHLY}, m AS (SELECT series_id, MIN(amount) AS lo, MAX(amount) AS hi FROM monthly GROUP BY series_id),
  s AS (SELECT *, (amount - lo) / (hi - lo) AS y FROM monthly JOIN m USING (series_id)),
  l AS (SELECT series_id, regr_slope(y, n_requests) AS slope, regr_intercept(y, n_requests) AS intercept
        FROM s GROUP BY series_id)"""


@query(
    "m04_line_on_scaled_target",
    f"""WITH {SQL_SCALED_LINE} SELECT series_id, ts, round((slope * n_requests + intercept) * (hi - lo) + lo, 6) AS predicted
        FROM s JOIN l USING (series_id)""",
)
def _(t):
    """Target scaled per series, fitted, predicted and scaled back."""
    whole = Window.partitionBy(*KEY)
    scaled = monthly_series(t).withColumns({"lo": F.min("amount").over(whole), "hi": F.max("amount").over(whole)})
    scaled = scaled.withColumn("y", (F.col("amount") - F.col("lo")) / (F.col("hi") - F.col("lo")))
    fitted = scaled.join(learn.one_feature_line(scaled, KEY, "y", "n_requests"), KEY)
    line = F.col("slope") * F.col("n_requests") + F.col("intercept")
    predicted = frame.min_max_restored(line, F.col("lo"), F.col("hi"))
    return fitted.select("series_id", "ts", F.round(predicted, 6).alias("predicted"))


def predictions_of(t, name):
    rows = checkpointed(panel(t))
    train, test = rows.where("part = 'train'"), rows.where("part = 'test'")
    model = learn.fit_scaled(train, FEATURES, "amount", learn.regressors()[name])
    return model.transform(test)


def _regressor(name, kind):
    @query(name)
    def _(t):
        scored = predictions_of(t, kind)
        return scored.select("c_mktsegment", "c_nationkey", "ts", F.col("amount").alias("actual"), "prediction")


_regressor("m04_linear_regression", "linear")
_regressor("m05_random_forest", "random_forest")
_regressor("m07_gradient_boosting", "gradient_boosting")
_regressor("m08_decision_tree", "decision_tree")


@query(
    "m06_nearest_neighbour",
    f"""WITH {SQL_PANEL}, d AS (SELECT q.vec_id AS query_id, e.amount, ROW_NUMBER() OVER (PARTITION BY q.vec_id ORDER BY
            (q.n_requests - e.n_requests) ** 2 + (q.n_orgs - e.n_orgs) ** 2 + (q.month - e.month) ** 2
            + (q.year - e.year) ** 2, e.vec_id) AS r
          FROM panel q JOIN panel e ON q.part = 'test' AND e.part = 'train')
        SELECT query_id, round(amount, 8) AS predicted FROM d WHERE r = 1""",
)
def _(t):
    rows = panel(t).select("vec_id", "part", "amount", F.array(*[F.col(f).cast("double") for f in FEATURES]).alias("vector"))
    rows = checkpointed(rows)
    train = rows.where("part = 'train'")
    found = nearest(train.select("vec_id", "vector"), "vec_id", rows.where("part = 'test'"), "vec_id", k=1)
    joined = found.join(train.select("vec_id", "amount"), "vec_id")
    return joined.select("query_id", F.round("amount", 8).alias("predicted"))


SQL_FOLD_SCORES = f"""{SQL_FOLDS}, lines AS (
    SELECT series_id, fold, regr_slope(amount, n_requests) AS slope, regr_intercept(amount, n_requests) AS intercept
    FROM folds WHERE part = 'train' GROUP BY ALL),
  err AS (SELECT series_id, fold, amount, amount - slope * n_requests - intercept AS e
          FROM folds JOIN lines USING (series_id, fold) WHERE part = 'test'),
  scores AS (SELECT series_id, fold, AVG(abs(e)) AS mae, AVG(e * e) AS mse, sqrt(AVG(e * e)) AS rmse,
                    1 - AVG(e * e) / VAR_POP(amount) AS r2 FROM err GROUP BY ALL)"""
METRICS = ["mae", "mse", "rmse", "r2"]


@query(
    "m09_cross_validation",
    f"WITH {SQL_FOLD_SCORES} SELECT series_id, "
    + ", ".join(f"round(AVG({m}), 6) AS {m}_mean, round(STDDEV_POP({m}), 6) AS {m}_std" for m in METRICS)
    + " FROM scores GROUP BY series_id",
)
def _(t):
    """Every fold is fitted once; all metrics come from one aggregate over its predictions."""
    folds = series.expanding_folds(monthly_series(t), KEY)
    keys = ["series_id", "fold"]
    lines = learn.one_feature_line(folds.where("part = 'train'"), keys, "amount", "n_requests")
    tested = folds.where("part = 'test'").join(lines, keys)
    tested = tested.withColumn("predicted", F.col("slope") * F.col("n_requests") + F.col("intercept"))
    scores = series.accuracy(tested, keys, "amount", "predicted")
    summary = learn.fold_summary(scores, KEY, METRICS)
    return rounded(summary, *[f"{m}_{s}" for m in METRICS for s in ("mean", "std")])


@query("m09_model_comparison")
def _(t):
    """The five regressors over the same expanding folds of the panel."""
    keys = ["c_mktsegment", "c_nationkey"]
    rows = checkpointed(series.expanding_folds(panel(t).drop("part"), keys, folds=5))
    sides = {
        fold: [rows.where((F.col("fold") == fold) & (F.col("part") == part)) for part in ("train", "test")]
        for fold in range(1, 6)
    }
    plan = [(fold, name, estimator) for fold in sides for name, estimator in learn.regressors().items()]
    models = learn.fitted_in_parallel([(sides[fold][0], FEATURES, "amount", e) for fold, _, e in plan])
    scored = []
    for (fold, name, _), model in zip(plan, models):
        one = model.transform(sides[fold][1])
        scored.append(one.select(F.lit(name).alias("model"), "fold", "amount", "prediction"))
    for train, test in sides.values():
        vector = F.array(*[F.col(f).cast("double") for f in FEATURES]).alias("vector")
        found = nearest(train.select("vec_id", vector), "vec_id", test.select("vec_id", vector), "vec_id", k=1)
        known = train.select("vec_id", F.col("amount").alias("prediction"))
        asked = test.select(F.col("vec_id").alias("query_id"), "fold", "amount")
        one = found.join(known, "vec_id").join(asked, "query_id")
        scored.append(one.select(F.lit("nearest").alias("model"), "fold", "amount", "prediction"))
    predicted = scored[0]
    for one in scored[1:]:
        predicted = predicted.unionByName(one)
    scores = series.accuracy(predicted, ["model", "fold"], "amount", "prediction")
    return learn.fold_summary(scores, ["model"], METRICS)


@query("m10_actual_and_predicted")
def _(t):
    scored = predictions_of(t, "linear")
    return scored.select("vec_id", F.col("amount").alias("actual"), F.col("prediction").alias("predicted"))


@query("m11_scaled_target_model")
def _(t):
    scored = predictions_of(t, "decision_tree")
    return scored.select("vec_id", "scaled_prediction", "prediction")


# --- classifiers -------------------------------------------------------------------------

SQL_GUESSED = f"""guessed AS (SELECT toxic AS label, CAST({sql_polarity('text')} < 0 AS INTEGER) AS predicted
    FROM documents JOIN labels USING (doc_id)),
  counts AS (SELECT label, predicted, COUNT(*) AS n FROM guessed GROUP BY ALL)"""


def guessed(t):
    """Labelled documents with the lexicon's guess."""
    scored = t.texts.select("doc_id", (polarity(F.col("text")) < 0).cast("int").alias("predicted"))
    return scored.join(t.labels.select("doc_id", F.col("toxic").alias("label")), "doc_id")


@query("m12_confusion", f"WITH {SQL_GUESSED} SELECT * FROM counts")
def _(t):
    return learn.confusion(guessed(t), "label", "predicted")


@query(
    "m12_accuracy_and_correlation",
    f"""WITH {SQL_GUESSED}, a AS (SELECT SUM(n)::DOUBLE AS s, SUM(n) FILTER (label = predicted)::DOUBLE AS c FROM counts),
          x AS (SELECT label AS k, SUM(n)::DOUBLE AS truth FROM counts GROUP BY label),
          y AS (SELECT predicted AS k, SUM(n)::DOUBLE AS guess FROM counts GROUP BY predicted),
          p AS (SELECT SUM(COALESCE(truth, 0) * COALESCE(guess, 0)) AS tp, SUM(truth * truth) AS tt, SUM(guess * guess) AS pp
                FROM x FULL JOIN y USING (k))
        SELECT CAST(s AS BIGINT) AS rows, round(c / s, 6) AS accuracy,
               round((c * s - tp) / (sqrt(s * s - pp) * sqrt(s * s - tt)), 6) AS mcc FROM a, p""",
)
def _(t):
    return rounded(learn.classification_scores(learn.confusion(guessed(t), "label", "predicted")), "accuracy", "mcc")


def labelled(t, label):
    docs = t.texts.select("doc_id", "text").join(t.labels.select("doc_id", F.col(label).cast("string").alias("class")), "doc_id")
    return checkpointed(learn.with_tokens(learn.split_parts(docs, "doc_id")))


def part_scores(scored):
    correct = F.avg((F.col("label") == F.col("prediction")).cast("double"))
    return scored.groupBy("part").agg(F.count("*").alias("n"), correct.alias("accuracy"))


@query("d04_trained_sentiment")
def _(t):
    """A classifier fitted on the training part, scored on every part."""
    rows = labelled(t, "toxic")
    model = learn.fit_text_classifier(rows.where("part = 'train'"), "class", 1 << 12)
    return part_scores(model.transform(rows))


@query("d04_classifier_metrics")
def _(t):
    rows = labelled(t, "toxic")
    model = learn.fit_text_classifier(rows.where("part = 'train'"), "class", 1 << 12)
    return learn.classification_scores(learn.confusion(model.transform(rows.where("part = 'test'")), "label", "prediction"))


@query("d05_service_classifier")
def _(t):
    """Missing texts dropped, rare classes bucketed, cleaned, split and classified."""
    docs = t.texts.select("doc_id", "text", "lang").dropna()
    docs = frame.rare_bucketed(docs, "lang", 108, "class").drop("lang")
    cleaned = docs.withColumn("text", tx.apply_rules(F.col("text"), tx.CLASSIFIER_TEXT))
    rows = checkpointed(learn.with_tokens(learn.split_parts(cleaned, "doc_id")))
    model = learn.fit_text_classifier(rows.where("part = 'train'"), "class", 1 << 12)
    return part_scores(model.transform(rows))


@query("m13_saved_classifier")
def _(t):
    """The fitted stages saved to the shared folder, loaded again and used on the test rows."""
    rows = labelled(t, "quality")
    model = learn.fit_text_classifier(rows.where("part = 'train'"), "class", 1 << 12)
    path = shared_dir(t.spark, "classifier")
    model.write().save(path)
    scored = PipelineModel.load(path).transform(rows.where("part = 'test'"))
    return scored.select("doc_id", "class", "prediction", vector_to_array("probability")[0].alias("p0"))


# --- topics over the corpus --------------------------------------------------------------

@query("d10_corpus_topics")
def _(t):
    ranked, _model = learn.topic_model(t.texts, k=5)
    return ranked


def clustered(t, *keep):
    """The fitted clusters, and ``keep…, cluster, distance`` of every document, scored once."""
    docs = checkpointed(learn.with_tokens(t.texts.select("text")))
    model = learn.fit_clusters(docs, k=8)
    scored = learn.centre_distance(model, model.transform(docs))
    return model, checkpointed(scored.select(*keep, "cluster", "distance"))


@query("d13_cluster_topics")
def _(t):
    return learn.topic_info(learn.with_outliers(clustered(t, "text")[1]).select("topic", "text"))


@query("d14_topics_of_new_texts")
def _(t):
    """Texts the model was not fitted on, in its topics or in none (-1), counted per line."""
    model, known = clustered(t)
    turns = learn.with_tokens(t.conversations.select("conv_id", "turn", "role", "text"))
    placed = learn.with_outliers(learn.centre_distance(model, model.transform(turns)), known)
    return placed.groupBy("role", "topic").agg(F.count("*").alias("n"))


VECTOR_SIZE = 16


def dense_topics(t):
    """Learned vectors of words and texts, and the topics that are dense among them."""
    docs = checkpointed(t.texts.select(F.col("doc_id").alias("id"), "text"))
    words = checkpointed(vectors.word_vectors(docs, size=VECTOR_SIZE))
    texts = vectors.text_vectors(docs, words, VECTOR_SIZE, "id")
    assigned, topics = density.fit_topics(docs.select("id").join(texts, "id", "left"), 5, 10)
    return docs, words, assigned, topics


@query("d13_density_topics")
def _(t):
    """Topics of any number by density, -1 for none: size and leading terms."""
    docs, _words, assigned, _topics = dense_topics(t)
    return learn.topic_info(docs.join(assigned, "id").select("topic", "text"))


@query("d14_density_topics_of_new_texts")
def _(t):
    """Texts that the topics were not fitted on, placed by the same distances, counted per line."""
    _docs, words, _assigned, topics = dense_topics(t)
    turns = t.conversations.select(F.concat_ws("-", "conv_id", "turn").alias("id"), "role", "text")
    texts = vectors.text_vectors(turns, words, VECTOR_SIZE, "id")
    placed = density.place_vectors(topics, turns.select("id").join(texts, "id", "left"))
    return turns.join(placed, "id").groupBy("role", "topic").agg(F.count("*").alias("n"))


@query("v02_word_vectors")
def _(t):
    """Words with the length of their learned vectors."""
    found = vectors.word_vectors(t.texts, size=VECTOR_SIZE)
    squares = F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)
    return found.select("token", F.size("x").alias("width"), F.round(F.sqrt(squares), 4).alias("length"))
