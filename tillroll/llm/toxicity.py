"""Toxicity scores: boosted trees over dense features of a text, calibrated by isotonic regression."""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import map_batches, stored

#: Words by which a text speaks to someone, in English, German, French and Spanish.
SECOND_PERSON = frozenset(
    "you your yours u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos tú ti usted ustedes".split()
)
_WORD = re.compile(r"[^\W_]+(?:[*@$'][^\W_]+)*")
#: Letters with digits or symbols inside, or a letter three times in a row.
_ODD = re.compile(r"[^\W\d_]+[\d*@$#%]+[^\W\d_]|([^\W\d_])\1\1")
_PLAIN = str.maketrans("0134578@$", "oieastbas")
_PREFIXES = (4, 5, 6)
#: Words between a term of the lexicon and a second person at most.
_NEAR = 5
_REMEMBERED, _REMEMBERED_LENGTH = 500_000, 64
#: Rows that a task hands over at once.
_ROWS_AT_ONCE = 1000
FEATURES = (
    "hit_density hits hit_weight hit_most hit_kinds second_person hit_near_second_person capitals capital_words "
    "punctuation exclamations odd_words words word_length"
).split()


def _classes() -> np.ndarray:
    """For each code point: 1 upper-case letter, 2 other letter, 3 punctuation or symbol, 0 what is left."""
    kinds = {"Lu": 1, "Lt": 1} | dict.fromkeys(("Ll", "Lm", "Lo"), 2)
    out = np.zeros(0x3000, np.uint8)
    for code in range(len(out)):
        kind = unicodedata.category(chr(code))
        out[code] = kinds.get(kind, 3 if kind[0] in "PS" else 0)
    return out


_CLASSES = _classes()


def terms(word: str) -> list[str]:
    """What a lexicon can know of a word: itself, its plain spelling if digits or symbols stand in it, its beginnings."""
    plain = word.translate(_PLAIN) if not word.isalpha() else word
    return [plain, *(f"{plain[:n]}-" for n in _PREFIXES if len(plain) > n)]


class Lexicon(dict):
    """Weight by word, 0 for most; made from the weights of terms and remembered."""

    def __init__(self, weights: dict[str, float]) -> None:
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        weight = max([self.weights.get(t, 0.0) for t in terms(word)])
        if len(word) <= _REMEMBERED_LENGTH:
            if len(self) >= _REMEMBERED:
                self.clear()
            self[word] = weight
        return weight

    def __reduce__(self):
        return Lexicon, (self.weights,)


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """Values of ``FEATURES``; an empty or null text has zeros."""
    text = text or ""
    words = _WORD.findall(text.lower())
    n = max(1, len(words))
    weights = [lexicon[w] for w in words]
    hits = [i for i, w in enumerate(weights) if w]
    people = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = 0
    if hits and people:
        at = np.searchsorted(people, hits)
        spots = np.array([-(1 << 40), *people, 1 << 40])
        near = int(((np.array(hits) - spots[at] <= _NEAR) | (spots[at + 1] - np.array(hits) <= _NEAR)).sum())
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    counts = np.bincount(_CLASSES[np.minimum(codes, len(_CLASSES) - 1)], minlength=4) if len(codes) else np.zeros(4)
    letters = max(1, int(counts[1] + counts[2]))
    hit_weights = [weights[i] for i in hits]
    loud = sum([w.isupper() and len(w) > 1 for w in text.split()]) if counts[1] > 1 else 0
    return [
        len(hits) / n,
        math.log1p(len(hits)),
        sum(hit_weights) / math.sqrt(n),
        max(hit_weights, default=0.0),
        math.log1p(len({words[i] for i in hits})),
        len(people) / n,
        near / n,
        float(counts[1]) / letters,
        loud / n,
        float(counts[3]) / max(1, len(codes)),
        (text.count("!") + text.count("?")) / n,
        len(_ODD.findall(text)) / n,
        math.log1p(len(words)),
        sum(map(len, words)) / n,
    ]


def with_features(rows: DataFrame, weights: dict[str, float], keep_text: bool = False) -> DataFrame:
    """``rows`` with ``text`` replaced by the features, or followed by them."""
    kept = [c for c in rows.columns if c != "text"]
    schema = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept] + ["text string"] * keep_text
    rows = rows.select(*kept, F.col("text").cast("string"))
    kept += ["text"] * keep_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(weights)
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS_AT_ONCE):
                part = batch.slice(start, _ROWS_AT_ONCE)
                values = [features(t.as_py(), lexicon) for t in part.columns[-1]]
                columns = np.array(values, np.float64).reshape(len(values), len(FEATURES)).T
                arrays = [*part.columns[: len(kept)], *map(pa.array, columns)]
                yield pa.RecordBatch.from_arrays(arrays, [*kept, *FEATURES])

    return map_batches(rows, run, ", ".join(schema + [f"{f} double" for f in FEATURES]))


def mine(rows: DataFrame, least_docs: int = 4, least_weight: float = 2.0, max_terms: int = 20_000) -> dict[str, float]:
    """Lexicon of ``text, toxic``: terms whose smoothed log-odds of toxic texts exceed those of all by ``least_weight``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1), strict=True):
                found = {t for w in set(_WORD.findall((text.as_py() or "").lower())) for t in terms(w)}
                flags = np.full(len(found), toxic.as_py(), np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(flags)], ["term", "toxic"])

    counted = map_batches(rows.select("text", F.col("toxic").cast("int")), run, "term string, toxic int")
    counted = counted.groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic"))
    n, toxic = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    usual = math.log((toxic + 0.5) / (n - toxic + 0.5))
    weight = F.log((F.col("toxic") + 0.5) / (F.col("n") - F.col("toxic") + 0.5)) - usual
    chosen = counted.withColumn("weight", weight).where(f"n >= {least_docs} AND weight >= {least_weight}")
    return {r.term: r.weight for r in chosen.orderBy(F.desc("weight"), "term").limit(max_terms).collect()}


@dataclass
class Model:
    """Lexicon, trees and calibration; with ``constant`` set, the score of every text."""

    weights: dict[str, float]
    trees: GBTClassificationModel | None = None
    calibration: IsotonicRegressionModel | None = None
    constant: float = 0.0


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)


def _margin(trees: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    return trees.transform(rows).withColumn("margin", vector_to_array("rawPrediction")[1])


def remainder(doc_id: str = "doc_id") -> Column:
    """``crc32(doc_id as text) mod 5``; rows with 0 are held out."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000, seed: int = 7) -> Model:
    """A model from at most ``max_rows`` labelled documents that are not held out.

    The rows are those of smallest hash among ``labels(doc_id, toxic)``; equal texts count once. Half of them (by hash of
    the text) give the lexicon, three tenths the trees, two tenths the calibration, so that no step learns from texts that
    the step before has seen. If a part lacks a class, all rows serve for all; if all lack one, the score is constant.
    """
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id"))
    known = known.agg(F.max("toxic").cast("int").alias("toxic")).where(remainder("id") != 0)
    # max_rows is the bound of what is broadcast
    known = F.broadcast(known.orderBy(F.xxhash64("id"), "id").limit(max_rows))
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.join(known, "id").withColumn("part", F.pmod(F.xxhash64("text"), F.lit(10)))
    first = rows.groupBy("text").agg(F.min(F.struct("id", "toxic", "part")).alias("first"))
    rows = stored(first.select("first.*", "text"), "labelled")
    counts = {(r.part, r.toxic): r.n for r in rows.groupBy("part", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    splits = [range(0, 5), range(5, 8), range(8, 10)]
    if any(sum(counts.get((p, c), 0) for p in split) < 5 for split in splits for c in (0, 1)):
        splits = [range(10)] * 3
    positive, every = sum(n for (_, c), n in counts.items() if c), sum(counts.values())
    if not 0 < positive < every:
        return Model({}, constant=(positive + 0.5) / (every + 1) if every else 0.0)
    weights = mine(rows.where(F.col("part").isin(list(splits[0]))))
    made = stored(with_features(rows.where(F.col("part").isin(list(splits[1]) + list(splits[2]))), weights), "features")
    made = _assembled(made.orderBy("id").coalesce(1))  # at most max_rows rows of numbers
    trees = GBTClassifier(labelCol="toxic", maxIter=25, maxDepth=3, stepSize=0.2, minInstancesPerNode=5, seed=seed)
    trees = trees.fit(made.where(F.col("part").isin(list(splits[1]))))
    margins = _margin(trees, made.where(F.col("part").isin(list(splits[2]))))
    calibration = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="score")
    calibration = calibration.fit(margins.select("margin", F.col("toxic").cast("double").alias("label")))
    return Model(weights, trees, calibration)


def _scored(rows: DataFrame, model: Model, keep_text: bool = False) -> DataFrame:
    """``row``, ``text`` if it is kept, and ``score`` of ``row, text``."""
    if model.trees is None:
        scored = rows.withColumn("score", F.lit(float(model.constant)))
    else:
        made = _assembled(with_features(rows, model.weights, keep_text))
        scored = model.calibration.transform(_margin(model.trees, made))
    bounded = F.greatest(F.lit(0.0), F.least(F.lit(1.0), "score")).alias("score")
    return scored.select("row", *["text"] * keep_text, bounded)


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every row and ``score``, from 0 to 1. Only ``text`` enters the score.

    Null and empty texts are scored as texts without words. Repeated rows are scored alike; no rows give none.
    """
    rows = docs.select(F.struct(*keep).alias("row"), F.col("text").cast("string").alias("text"))
    return _scored(rows, model).select("row.*", "score")


def judge(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, by a model of the labels that are not held out."""
    scored = score(docs, fit(docs, labels), ["doc_id"])
    return scored.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(remainder() == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, as they are."""
    # a text goes to Python and back once, not beside a row that holds it as well
    others = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("row")
    rows = docs.select(others, F.col("text").cast("string").alias("text"))
    scored = _scored(rows, fit(docs, labels), keep_text=True).where(F.col("score") < threshold)
    text = F.col("text").cast(docs.schema["text"].dataType).alias("text")
    return scored.select(*(text if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns))
