"""Goal-probability models with ``pyspark.ml``.

``fit`` is the only eager step; scoring, the xG column and feature
importances stay DataFrames.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC,
                                       LogisticRegression, MultilayerPerceptronClassifier,
                                       NaiveBayes, RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.schemas import FEATURES

MODELS = ("logistic", "rf", "mlp", "gbt", "dt", "svm", "nb")


def assembler(features: list[str] | None = None, out: str = "features_vector",
              handle_invalid: str = "error") -> VectorAssembler:
    """M1.  A null feature is an error (published; a shot without a frame has
    a null ``players_inside_area``, see the ``missing_frame`` option of the
    pipeline).  ``handle_invalid='skip'`` leaves such rows out, from training
    and from scoring, and ``'keep'`` carries them as NaN: both must be asked for."""
    return VectorAssembler(inputCols=list(FEATURES if features is None else features),
                           outputCol=out, handleInvalid=handle_invalid)


def random_split(df: DataFrame, train_size: float = 0.8, seed: int = 42):
    """M2, published: ``randomSplit`` (depends on the input partitioning)."""
    return df.randomSplit([train_size, 1 - train_size], seed=seed)


def hash_bucket(key: str = "id", seed: int = 42, buckets: int = 10000):
    """Bucket of a row from the first 32 bits of md5('key:seed'): any SQL
    engine gives the same."""
    text = F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % buckets


def with_side(df: DataFrame, train_size: float = 0.8, key: str = "id", seed: int = 42, buckets: int = 10000,
              out: str = "side") -> DataFrame:
    """M2 as a column: ``train`` or ``test`` (one plan for both sides)."""
    return df.withColumn(out, F.when(hash_bucket(key, seed, buckets) < int(round(train_size * buckets)), "train")
                         .otherwise("test"))


def hash_split(df: DataFrame, train_size: float = 0.8, key: str = "id", seed: int = 42,
               buckets: int = 10000):
    """M2, stable: a row's side depends on its key only, so repartitioning,
    retries and lost executors never move a row between train and test.
    Write or persist ``df`` first if both sides are used: each runs its plan."""
    sided = with_side(df, train_size, key, seed, buckets, "_side")
    return tuple(sided.filter(F.col("_side") == s).drop("_side") for s in ("train", "test"))


def make_estimator(model_type: str = "logistic", label_col: str = "goal",
                   features_col: str = "features_vector", layers: list[int] | None = None,
                   num_trees: int | None = None, max_iter: int = 100, seed: int | None = None):
    """One estimator per model name; unknown names raise."""
    if model_type == "logistic":
        return LogisticRegression(featuresCol=features_col, labelCol=label_col, maxIter=max_iter)
    if model_type == "rf":
        kw = {"seed": seed} if seed is not None else {}
        return RandomForestClassifier(featuresCol=features_col, labelCol=label_col,
                                      numTrees=num_trees or 100, **kw)
    if model_type == "mlp":
        if layers is None:
            raise ValueError("an MLP needs its layer sizes")
        return MultilayerPerceptronClassifier(featuresCol=features_col, labelCol=label_col,
                                              maxIter=max_iter, layers=layers, blockSize=128, seed=1234)
    if model_type == "gbt":
        kw = {"seed": seed} if seed is not None else {}
        return GBTClassifier(featuresCol=features_col, labelCol=label_col, maxIter=max_iter, **kw)
    if model_type == "dt":
        kw = {"seed": seed} if seed is not None else {}
        return DecisionTreeClassifier(featuresCol=features_col, labelCol=label_col, maxDepth=5, **kw)
    if model_type == "svm":
        return LinearSVC(featuresCol=features_col, labelCol=label_col, maxIter=max_iter)
    if model_type == "nb":
        return NaiveBayes(featuresCol=features_col, labelCol=label_col, modelType="multinomial")
    raise ValueError(f"no such model: {model_type!r}; known are {', '.join(MODELS)}")


def train(train_df: DataFrame, model_type: str = "logistic", features: list[str] | None = None,
          label_col: str = "goal", handle_invalid: str = "error", cache: bool = True, **kw) -> PipelineModel:
    """Assembler + estimator fitted as one pipeline (eager)."""
    feats = list(FEATURES if features is None else features)
    if model_type == "mlp" and kw.get("layers") is None:
        raise ValueError("an MLP needs its layer sizes")
    est = make_estimator(model_type, label_col=label_col, **kw)
    pipe = Pipeline(stages=[assembler(feats, handle_invalid=handle_invalid), est])
    if not cache:
        return pipe.fit(train_df)
    # Iterative estimators scan the training set once per iteration: keep the
    # (already pruned) training columns on the executors, spilling to disk,
    # instead of re-running the feature plan each time.
    data = train_df.select(*dict.fromkeys(feats + [label_col])).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return pipe.fit(data)
    finally:
        data.unpersist()


def goal_probability(predictions: DataFrame, prob_col: str = "probability", out: str = "xG",
                     scale: int = 10) -> DataFrame:
    """Probability of class 1 as a double (``scale`` dp) and an int
    ``prediction``.  Models without probabilities (linear SVM) get no xG
    column: their margin is not a probability."""
    df = predictions
    if prob_col in df.columns:
        df = df.withColumn(out, F.round(vector_to_array(prob_col)[1], scale))
    if "prediction" in df.columns:
        df = df.withColumn("prediction", F.col("prediction").cast("int"))
    return df


def score(model: PipelineModel, test_df: DataFrame) -> DataFrame:
    return goal_probability(model.transform(test_df))


def feature_importance(model: PipelineModel, spark=None) -> DataFrame:
    """(feature, importance) ordered by importance, names taken from
    the fitted assembler.  Trees give importances, linear models their
    coefficients; other models raise.  The values are model parameters (one
    per feature) that already live on the driver."""
    stages = model.stages
    names = stages[0].getInputCols()
    m = stages[-1]
    if hasattr(m, "featureImportances"):
        values = m.featureImportances.toArray().tolist()
    elif hasattr(m, "coefficients"):
        values = m.coefficients.toArray().tolist()
    else:
        raise ValueError(f"{type(m).__name__} has neither importances nor coefficients")
    if len(values) != len(names):
        raise ValueError("feature count does not match the model")
    from pyspark.sql import SparkSession

    spark = spark or SparkSession.getActiveSession()
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"))


def moment_check(predictions: DataFrame, features: list[str], label_col: str = "goal", prob_col: str = "xG",
                 tolerance: float = 1e-3) -> DataFrame:
    """Certificate of a fitted logistic model on its own training rows: at the
    maximum of the likelihood the gradient vanishes, that is, every feature has
    the same mean weighted by the predicted probability as by the label.  One
    aggregate; a row ``feature, observed, fitted, holds`` for each feature and for
    the intercept (``1``).  ``tolerance`` is relative to the feature's scale."""
    p, y = F.col(prob_col).cast("double"), F.col(label_col).cast("double")
    terms = {"1": F.lit(1.0), **{f: F.col(f).cast("double") for f in features}}
    sums = predictions.agg(*[F.avg(e * x).alias(f"{k}{i}") for i, x in enumerate(terms.values()) for k, e in (("y", y), ("p", p))],
                           *[F.sqrt(F.avg(x * x)).alias(f"s{i}") for i, x in enumerate(terms.values())])
    row = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"y{i}").alias("observed"), F.col(f"p{i}").alias("fitted"),
                             F.col(f"s{i}").alias("scale")) for i, f in enumerate(terms)])
    return sums.select(F.inline(row)).select("feature", "observed", "fitted",
                                             (F.abs(F.col("observed") - F.col("fitted")) <= tolerance * F.col("scale")).alias("holds"))


def naive_bayes_table(model: PipelineModel, spark=None) -> DataFrame:
    """The fitted log probabilities of a multinomial naive Bayes model:
    ``label, feature, log_probability`` (feature ``1``: the class prior)."""
    from pyspark.sql import SparkSession

    spark = spark or SparkSession.getActiveSession()
    names, m = model.stages[0].getInputCols(), model.stages[-1]
    theta, prior = m.theta.toArray(), m.pi.toArray()
    rows = [(int(k), f, float(v)) for k in range(theta.shape[0]) for f, v in zip(["1", *names], [prior[k], *theta[k]])]
    return spark.createDataFrame(rows, "label int, feature string, log_probability double")


def leaf_check(predictions: DataFrame, label_col: str = "goal", prob_col: str = "xG", tolerance: float = 1e-9) -> DataFrame:
    """Certificate of a fitted decision tree on its own training rows: in each
    leaf the predicted probability is the share of positives.  Leaves of equal
    probability are one row: ``probability, rows, holds``."""
    return predictions.groupBy(F.col(prob_col).alias("probability")).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(F.col(label_col).cast("double")).alias("share")) \
        .select("probability", "rows", (F.abs(F.col("share") - F.col("probability")) <= tolerance).alias("holds"))
