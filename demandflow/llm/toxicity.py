"""Operator 10: a toxicity score from gradient-boosted trees over dense features, with isotonic calibration.

A lexicon of words and word beginnings is learned from a bounded sample of labelled
documents. Every text becomes a dozen numbers: how dense words of the lexicon are, plainly
and behind obfuscation, how near to an address in the second person, and the rates of capitals,
punctuation and obfuscated words. Trees are boosted on one part of the sample, and their
output is calibrated on the other.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandflow.llm.common import text_of
from demandflow.llm.labelled import fold, sample
from demandflow.session import materialize, ship_package

FOLDS, HELD_OUT = 4, 2
PER_CLASS = 3000  # labelled documents of each class at most
TERMS = 400  # of the lexicon at most
PREFIXES = range(3, 7)  # letters of the word beginnings that are tried
MIN_ODDS = 2.2  # natural logarithm of the odds of a term
REACH = 48  # characters between a term and an address that count as near
TREES, DEPTH = 24, 4
CALIBRATION = 3  # every third document of the sample calibrates

LETTER = r"\p{L}+"
# Addresses in the second person in the languages of the corpus; fixed values.
SECOND_PERSON = "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch ti tus usted ustedes vosotros"
# Characters that stand for letters; fixed values.
LOOKALIKES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l", "*": None, "_": None, "-": None, ".": None})
OBFUSCATED = re.compile(r"[^\W\d_]+(?:[0-9@$*!|_.-]+[^\W\d_]+)+")

NAMES = (
    "log_words", "word_density", "log_words_found", "terms_found", "stem_density", "log_stems_found", "weight_density",
    "largest_weight", "hidden_density", "near_second_person", "second_person_rate", "capital_rate", "exclamation_rate",
    "punctuation_rate", "obfuscation_rate",
)


@dataclass(frozen=True)
class Lexicon:
    """Terms with their log odds; those that end in ``*`` are beginnings of words."""

    weights: dict[str, float]


def learned(texts: DataFrame) -> Lexicon:
    """The terms that mark the toxic documents of the sample best, counted once per document."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(LETTER), F.lit(0)))
    starts = F.array(*[F.when(F.length("word") > n, F.concat(F.substring("word", 1, n), F.lit("*"))) for n in PREFIXES])
    both = F.concat(F.array("word"), F.array_compact(starts))
    terms = (
        texts.select("doc_id", "label", F.explode(words).alias("word"))
        .where(F.length("word") >= 3)
        .select("doc_id", "label", F.explode(both).alias("term"))
        .distinct()
        .groupBy("term")
        .agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("other"))
    )
    sizes = texts.agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("o")).first()
    toxic, other = sizes["t"] or 0, sizes["o"] or 0
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("other") + 0.5) / (other + 1))
    least = max(2, math.ceil(0.004 * toxic))
    best = (
        terms.withColumn("odds", odds)
        .where((F.col("odds") >= MIN_ODDS) & (F.col("toxic") >= least))
        .orderBy((F.col("odds") * F.sqrt("toxic")).desc(), "term")
        .limit(TERMS)
    )
    return Lexicon({r["term"]: r["odds"] for r in best.select("term", "odds").collect()})


class Reader:
    """The features of texts, by one pass of an automaton over the lower-case text."""

    def __init__(self, lexicon: Lexicon) -> None:
        self.automaton = ahocorasick.Automaton()
        entries: dict[str, list[tuple[str, bool, float]]] = {}
        for term, weight in lexicon.weights.items():
            entries.setdefault(term.rstrip("*"), []).append((term, not term.endswith("*"), weight))
        for word in SECOND_PERSON.split():
            entries.setdefault(word, []).append(("", True, 0.0))
        for text, uses in entries.items():
            self.automaton.add_word(text, (len(text), uses))
        self.automaton.make_automaton()

    def hits(self, lower: str) -> tuple[list[tuple[int, str, float]], list[int]]:
        """(place, term, weight) of the terms at beginnings of words, and the places of addresses in order."""
        terms, addresses = [], []
        for end, (n, uses) in self.automaton.iter(lower):
            start = end - n + 1
            if start and lower[start - 1].isalpha():
                continue
            closed = end + 1 == len(lower) or not lower[end + 1].isalpha()
            for term, whole, weight in uses:
                if closed == whole:
                    terms.append((start, term, weight)) if term else addresses.append(start)
        return terms, sorted(addresses)

    def features(self, text: str) -> list[float]:
        data = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8), minlength=256)
        words, size = max(1, len(text.split())), max(1, len(text))
        terms, addresses = self.hits(text.lower())
        whole = [t for t in terms if not t[1].endswith("*")]
        stems = {t[0] for t in terms if t[1].endswith("*")}
        hidden = OBFUSCATED.findall(text)
        plain = " ".join(w.translate(LOOKALIKES) for w in hidden).lower()
        found_hidden = len(self.hits(plain)[0]) if hidden else 0
        near = sum(bisect_right(addresses, t[0] + REACH) > bisect_left(addresses, t[0] - REACH) for t in terms)
        weights = [t[2] for t in terms]
        marks = data[33:48].sum() + data[58:65].sum() + data[91:97].sum() + data[123:127].sum()
        return [
            math.log(words),
            len(whole) / words,
            math.log1p(len(whole)),
            math.log1p(len({t[1] for t in terms})),
            len(stems) / words,
            math.log1p(len(stems)),
            sum(weights) / words,
            max(weights, default=0.0),
            found_hidden / words,
            math.log1p(near),
            len(addresses) / words,
            float(data[65:91].sum()) / size,
            float(data[33]) / size,
            float(marks) / size,
            len(hidden) / words,
        ]


def featured(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, the features of the whole text, and label where ``docs`` has one."""
    extra = ["label"] if "label" in docs.columns else []
    texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), text_of(docs).alias("text"), *extra)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(lexicon)
        for batch in batches:
            values = pa.array([reader.features(t.as_py()) for t in batch.column(1)], pa.list_(pa.float64()))
            others = [batch.column(i) for i in range(2, batch.num_columns)]
            yield pa.RecordBatch.from_arrays([batch.column(0), values, *others], ["doc_id", "features", *extra])

    schema = "doc_id bigint, features array<double>" + (", label int" if extra else "")
    return texts.mapInArrow(read, schema).withColumn("features", array_to_vector("features"))


@dataclass
class Model:
    lexicon: Lexicon
    trees: GBTClassificationModel
    calibration: IsotonicRegressionModel

    def scored(self, rows: DataFrame) -> DataFrame:
        """``rows`` with their calibrated score."""
        boosted = raw_score(self.trees, rows).drop("features").withColumnRenamed("raw", "features")
        return self.calibration.transform(boosted)


def raw_score(trees: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    columns = ["rawPrediction", "probability", "prediction"]
    return trees.transform(rows).withColumn("raw", vector_to_array("probability")[1]).drop(*columns)


def fitted(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model | None:
    """Lexicon, trees and calibration of a bounded sample; none if one of its parts lacks a class."""
    texts = sample(docs, labels, label, FOLDS, HELD_OUT, PER_CLASS)
    part = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(CALIBRATION)) == 0
    classes = texts.groupBy(part.alias("part")).agg(F.countDistinct("label").alias("n")).collect()
    if len(classes) < 2 or any(r["n"] < 2 for r in classes):
        return None
    lexicon = learned(texts.where(~part))
    rows = materialize(
        featured(texts, lexicon).select("doc_id", vector_to_array("features").alias("features"), "label"), "toxic_features"
    )
    vectors = rows.withColumn("features", array_to_vector("features")).withColumn("label", F.col("label").cast("double"))
    few = vectors.coalesce(4)  # a few thousand rows of a dozen numbers
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=3, stepSize=0.2).fit(few.where(~part))
    outside = raw_score(trees, few.where(part)).drop("features").withColumnRenamed("raw", "features")
    return Model(lexicon, trees, IsotonicRegression(predictionCol="score").fit(outside))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    The score is the calibrated probability of the label 1, from the whole text alone; a null or empty text has
    zero rates and is scored like others. Equal texts get equal scores. Without labels of both kinds every score is 0. A null
    doc_id is not held out. An empty table gives no rows; other columns are not looked at.
    """
    ship_package(docs.sparkSession)
    model = fitted(docs, labels)
    if model is None:
        scored = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), F.lit(0.0).alias("score"))
    else:
        scored = model.scored(featured(docs.select("doc_id", "text"), model.lexicon))
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )
