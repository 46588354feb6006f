"""Hierarchical language identification (operator 1).

A text is first given a language family, then a language of that family; both
steps are one-versus-one linear support vector machines over hashed letter
1- to 3-grams (non-letters are one separator, letters are lower-cased, counts
are scaled to length one).  The machines are fitted by Spark on at most
``per_language`` labelled texts of each language, chosen by a hash of doc_id
among the rows outside the held-out fold; prediction reads whole texts.

Score: probability of the family times that of the language in it, each from
the logistic function of the margins.  Null texts and texts without a letter
get ``und`` with score 0.  Without labelled rows every text is ``und``; with
one language every text with a letter gets it, score 1.  Ties go to the first
name.  Repeated rows are predicted each (and learned from once, as a doc_id is
sampled once for each of its languages); long texts are read whole, block by
block; an empty table gives no rows; other columns are ignored, or carried by
:func:`keep_identified`.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import held_out, sample_by_class

PER_LANGUAGE = 800
BITS = 13
BLOCK = 1 << 20
SLOPE = 4.0
UNDETERMINED = "und"

# fixed values: families of common languages; any other is a family of its own
FAMILIES = {
    "da": "germanic", "de": "germanic", "en": "germanic", "nl": "germanic", "no": "germanic", "sv": "germanic",
    "ca": "romance", "es": "romance", "fr": "romance", "it": "romance", "pt": "romance", "ro": "romance",
    "bg": "slavic", "cs": "slavic", "pl": "slavic", "ru": "slavic", "sk": "slavic", "uk": "slavic",
}


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Code point to lower-cased code point; 0 where it is no letter."""
    table = np.zeros(0x110000, dtype=np.uint64)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            table[c] = ord(ch.lower()[0])
    return table


def features(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """(indices, values) of a text, or None if it has no letter."""
    if not text:
        return None
    codes = letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")]
    if not codes.any():
        return None
    counts = np.zeros(1 << BITS, dtype=np.int64)
    before, carried = True, np.zeros(0, dtype=np.uint64)  # what the block before left: a gap at its end, its last two codes
    for at in range(0, len(codes), BLOCK):
        c = codes[at:at + BLOCK]
        gap = c == 0
        keep = ~gap | ~np.concatenate([[before], gap[:-1]])
        before, first = bool(gap[-1]), len(carried)
        c = np.concatenate([carried, c[keep] + np.uint64(1)])
        carried = c[-2:]
        g = c
        for n in range(1, 4):
            if n > 1:
                g = g[:-1] * np.uint64(0x100000001B3) + c[n - 1:]
            new = g[max(0, first - n + 1):]
            h = (new * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)) * np.uint64(0xBF58476D1CE4E5B9)
            counts += np.bincount((h >> np.uint64(64 - BITS)).astype(np.int64), minlength=1 << BITS)
    at = np.flatnonzero(counts)
    x = counts[at].astype(np.float64)
    return at, x / np.sqrt((x * x).sum())


class OneVersusOne:
    """Linear machines for all pairs of classes; margins above 0 are for the first."""

    def __init__(self, classes: list[str], machines: list[tuple[np.ndarray, float]]):
        self.classes, self.pairs = classes, list(combinations(range(len(classes)), 2))
        self.weights = np.array([w for w, _ in machines]).reshape(len(machines), 1 << BITS)
        self.bias = np.array([b for _, b in machines])

    def predict(self, at: np.ndarray, x: np.ndarray) -> tuple[str, float]:
        if not self.pairs:
            return self.classes[0], 1.0
        p = 1 / (1 + np.exp(-SLOPE * (self.weights[:, at] @ x + self.bias)))
        votes = np.zeros(len(self.classes))
        for (i, j), q in zip(self.pairs, p):
            votes[i] += q
            votes[j] += 1 - q
        best = int(votes.argmax())
        return self.classes[best], float(votes[best] / (len(self.classes) - 1))


class Model:
    def __init__(self, family_of: dict[str, str], families: OneVersusOne | None, languages: dict[str, OneVersusOne]):
        self.family_of, self.families, self.languages = family_of, families, languages

    def predict(self, text: str | None) -> tuple[str, float]:
        f = features(text) if self.families else None
        if f is None:
            return UNDETERMINED, 0.0
        family, p = self.families.predict(*f)
        lang, q = self.languages[family].predict(*f)
        return lang, min(1.0, max(0.0, p * q))


def sample(docs: DataFrame, per_language: int) -> DataFrame:
    """label, features of at most ``per_language`` learnable rows a language."""
    known = docs.where("lang is not null and text is not null").where(~held_out()).select("doc_id", F.col("lang").alias("label"))
    chosen = sample_by_class(known, "label", per_language).distinct()
    # bounded: per_language rows for each language
    texts = docs.where("text is not null").select("doc_id", "text", "lang") \
        .join(F.broadcast(chosen), "doc_id").where("lang = label").select("label", "text")

    def vector(text):
        f = features(text)
        return None if f is None else Vectors.sparse(1 << BITS, f[0], f[1])

    # not deterministic for the optimiser, so that it runs once a row and after the join
    made = F.udf(vector, VectorUDT()).asNondeterministic()
    return texts.select("label", made("text").alias("features")).where("features is not null")


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, families: dict[str, str] = FAMILIES,
        iterations: int = 30) -> Model:
    """Fit from ``text`` and non-null ``lang`` of the rows outside the held-out fold."""
    rows = sample(docs, per_language).persist()
    try:
        langs = sorted(r[0] for r in rows.select("label").distinct().collect())
        family_of = {x: families.get(x, x) for x in langs}

        def machines(classes: list[str], of) -> OneVersusOne:
            out = []
            for a, b in combinations(classes, 2):
                part = rows.withColumn("c", of).where(F.col("c").isin(a, b)) \
                    .select((F.col("c") == a).cast("double").alias("label"), "features")
                m = LinearSVC(maxIter=iterations, regParam=1e-4, standardization=False).fit(part)
                out.append((m.coefficients.toArray(), m.intercept))
            return OneVersusOne(classes, out)

        names = sorted(set(family_of.values()))
        of = F.col("label")
        if family_of:
            pairs = [F.lit(v) for kv in family_of.items() for v in kv]
            of = F.element_at(F.create_map(*pairs), F.col("label"))
        return Model(family_of, machines(names, of) if names else None,
                     {f: machines([x for x in langs if family_of[x] == f], F.col("label")) for f in names})
    finally:
        rows.unpersist()


def predictions(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep``, then lang_pred and score, of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, F.col("text").cast("string").alias("_text"))
    schema = rows.select(*keep, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def predict(batches):
        m = shared.value
        for b in batches:
            found = [m.predict(t.as_py()) for t in b.column(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(len(keep))), pa.array([x for x, _ in found], pa.string()),
                 pa.array([s for _, s in found], pa.float64())], names=[*keep, "lang_pred", "score"])

    return rows.mapInArrow(predict, schema)


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE, families: dict[str, str] = FAMILIES) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    model = fit(docs, per_language, families)
    rows = docs.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("held_out", held_out())
    return predictions(rows, model, ["doc_id", "held_out"])


def keep_identified(docs: DataFrame, min_score: float = 0.3, per_language: int = PER_LANGUAGE) -> DataFrame:
    """The documents whose language can be told: ``und`` and scores below
    ``min_score`` go.  Columns are unchanged."""
    model = fit(docs, per_language)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def tell(batches):
        m = shared.value
        for b in batches:
            found = (m.predict(t.as_py()) for t in b.column(at))
            yield b.filter(pa.array([x != UNDETERMINED and s >= min_score for x, s in found], pa.bool_()))

    return docs.mapInArrow(tell, docs.schema)
