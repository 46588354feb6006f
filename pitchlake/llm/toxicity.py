"""Toxicity severity by cumulative-link ordinal regression (operator 10).

P(grade > k) = logistic(w . x - theta_k): one weight vector shared by all
thresholds, x the presence of vocabulary features in the whole text: words,
and beginnings of four to six characters of longer words, which stand for the
many forms of one stem.  The fit is Spark's logistic regression over one row
per labelled text and threshold (the row's target is "grade > k", its threshold
an indicator feature), which is the all-threshold form of the model; an L1
penalty keeps the weights sparse, so that long clean texts do not add up to a
toxic one.  Rows weigh so that grade 0 and the rest count alike.

The vocabulary is learned: at most ``vocabulary`` features that are commoner
above grade 0, by a G-test of at least ``evidence``; without any, every text
has the same odds.  The fit uses at most ``per_grade`` texts of each grade,
chosen by a hash of doc_id outside the held-out fold.  Expected severity is the
sum of P(grade > k); the predicted grade is the number of thresholds with P of
one half or more.

Null and empty texts have no words and get the grade of an empty text; rows
without a label are predicted all the same; without labels, or with one grade
only, every text has that grade (0 without labels); labels of unknown
documents are ignored; a doc_id labelled twice counts with each label.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import held_out, sample_by_class

PER_GRADE = 3000
VOCABULARY = 4096
MIN_TEXTS = 5
EVIDENCE = 30.0


# fixed values: word characters, and the lengths of beginnings
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BEGINNINGS = (4, 5, 6)


def text_features(text: str | None) -> set[str]:
    """The words of a text, in lower case, and their beginnings (marked by ~)."""
    words = set(WORD.findall((text or "").lower()))
    return words | {w[:k] + "~" for k in BEGINNINGS for w in words if len(w) > k}


class Model:
    """``grades`` in order; ``theta`` for each step between them."""

    def __init__(self, grades: list[int], index: dict[str, int], weights: np.ndarray, theta: np.ndarray):
        self.grades, self.theta = grades, theta
        self.weight = {w: float(weights[i]) for w, i in index.items() if weights[i]}

    def predict(self, text: str | None) -> tuple[int, float]:
        """(grade, expected severity)"""
        if not len(self.theta):
            return self.grades[0], float(self.grades[0])
        z = sum(map(self.weight.get, text_features(text) & self.weight.keys()))
        p = 1 / (1 + np.exp(-(z - self.theta)))
        steps = np.diff(self.grades)
        return self.grades[int((p >= 0.5).sum())], float(self.grades[0] + (p * steps).sum())


def sample(docs: DataFrame, graded: DataFrame, per_grade: int) -> DataFrame:
    """grade, features of at most ``per_grade`` learnable texts a grade."""
    known = graded.select("doc_id", "grade").where("doc_id is not null and grade is not null").where(~held_out()).distinct()
    chosen = sample_by_class(known, "grade", per_grade)
    # bounded: per_grade rows a grade
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")) \
        .join(F.broadcast(chosen), "doc_id").select("grade", "text")

    def featured(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("grade"), pa.array([sorted(text_features(t.as_py())) for t in b.column("text")], pa.list_(pa.string()))],
                names=["grade", "features"])

    return texts.mapInArrow(featured, "grade int, features array<string>")


def fit(docs: DataFrame, graded: DataFrame, per_grade: int = PER_GRADE, vocabulary: int = VOCABULARY,
        evidence: float = EVIDENCE, penalty: float = 2e-4, iterations: int = 60) -> Model:
    """Fit on ``docs`` (doc_id, text) and ``graded`` (doc_id, grade)."""
    rows = sample(docs, graded, per_grade).persist()
    try:
        number = {r[0]: r[1] for r in rows.groupBy("grade").count().collect()}
        grades = sorted(number)
        if len(grades) < 2:
            return Model(grades or [0], {}, np.zeros(0), np.zeros(0))
        low, high = number[grades[0]], sum(number.values()) - number[grades[0]]
        share = rows.select(F.explode("features").alias("feature"), (F.col("grade") > grades[0]).cast("int").alias("up")) \
            .groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.sum("up").alias("up")).where(F.col("n") >= MIN_TEXTS)
        # G-test of the feature against "above grade 0", for features that speak for it
        cells = [(F.col("up"), high * F.col("n")), (F.col("n") - F.col("up"), low * F.col("n")),
                 (high - F.col("up"), high * (low + high - F.col("n"))), (low - F.col("n") + F.col("up"), low * (low + high - F.col("n")))]
        g = sum((F.when(seen > 0, 2 * seen * F.log(seen * (low + high) / due)).otherwise(0.0) for seen, due in cells), F.lit(0.0))
        top = share.where(F.col("up") * (low + high) > F.col("n") * high).withColumn("g", g).where(F.col("g") >= evidence) \
            .orderBy(F.desc("g"), "feature").limit(vocabulary).select("feature").collect()
        index = {r[0]: i for i, r in enumerate(top)}
        steps, v = len(grades) - 1, len(index)

        def vector(features, k):
            at = {index[w] for w in features if w in index}
            if k:
                at.add(v + k - 1)
            return Vectors.sparse(v + steps - 1 or 1, sorted(at), [1.0] * len(at))

        each = rows.select("grade", "features", F.explode(F.array(*[F.lit(k) for k in range(steps)])).alias("k")) \
            .select((F.col("grade") > F.element_at(F.array(*[F.lit(g) for g in grades]), F.col("k") + 1))
                    .cast("double").alias("label"), F.udf(vector, VectorUDT())("features", "k").alias("features"),
                    F.when(F.col("grade") > grades[0], 0.5 / high).otherwise(0.5 / low).alias("weight"))
        m = LogisticRegression(maxIter=iterations, regParam=penalty, elasticNetParam=1.0, weightCol="weight",
                               standardization=False).fit(each)
        w = m.coefficients.toArray()
        theta = np.maximum.accumulate(-(m.intercept + np.concatenate([[0.0], w[v:v + steps - 1]])))
        return Model(grades, index, w, theta)
    finally:
        rows.unpersist()


def predictions(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, severity, expected_severity, toxic of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .withColumn("held_out", held_out()).select("doc_id", "held_out", "text")

    def predict(batches):
        m = shared.value
        for b in batches:
            found = [m.predict(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array([g for g, _ in found], pa.int32()),
                 pa.array([e for _, e in found], pa.float64()), pa.array([g > m.grades[0] for g, _ in found], pa.bool_())],
                names=["doc_id", "held_out", "severity", "expected_severity", "toxic"])

    return rows.mapInArrow(
        predict, "doc_id long, held_out boolean, severity int, expected_severity double, toxic boolean")


def severity_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 not toxic, 1 toxic in a text of good quality, 2 toxic
    and of low quality.  Labels with a null verdict are left out; a null
    quality counts as good."""
    return labels.where("toxic is not null").select(
        "doc_id", F.when(F.col("toxic") == 0, 0).when(F.coalesce("quality", F.lit(1)) == 0, 2).otherwise(1)
        .cast("int").alias("grade"))
