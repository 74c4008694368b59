"""Toxicity of texts: gradient-boosted trees over dense features, isotonic calibration."""

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authweave.llm.tables import lean, small_batches, stored

SAMPLE = 20_000  # labelled rows the model is fitted on, about; scoring covers all rows
TREES, DEPTH = 15, 3
CANDIDATES = 50_000  # units the lexicon is chosen from, at most
SUPPORT = 5  # toxic documents of the sample an entry occurs in, at least
OFTEN = 5  # occurrences that count in one text
STEMS = (3, 4, 5, 6, 7, 8)  # lengths of word beginnings that can be entries
STRONG = 3.0  # weight from which an entry alone says much
NEAR = 5  # words between an entry and a second-person word that is near it
KNOWN = 200_000  # words whose entry a task remembers
THRESHOLD = 0.3

# Second-person words of the languages of the corpus.
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves u ur du dich dir dein deine deiner deinen deinem ihr euch "
    "euer eure sie ihnen tu te toi ton ta tes vous votre vos tú ti contigo usted ustedes vosotros "
    "vos os tus".split()
)
# Characters that stand for letters in disguised words.
DISGUISE = str.maketrans({
    "@": "a", "4": "a", "3": "e", "0": "o", "1": "i", "!": "i", "|": "l", "$": "s", "5": "s",
    "7": "t", "+": "t", "8": "b",
})
FEATURES = (
    "entry_density entry_weight strong_density strong_log entry_log distinct_log strongest near_share second_density "
    "disguised_entry_density capitals shouted_words punctuation exclamations repeated_marks "
    "disguised_words symbols digits words_log word_length"
).split()

WORD = re.compile(r"[^\W_]+(?:[@$!*0-9]+[^\W_]+)*")
DISGUISED = re.compile(r"[^\W\d_]+[@$!*|+0-9]+[^\W\d_]+")
REPEATED = re.compile(r"([!?.*#$%&])\1")


def plain(word: str) -> str:
    """The word with look-alike characters read as letters and stars left out."""
    return word.translate(DISGUISE).replace("*", "")


def units(word: str) -> Iterator[str]:
    """What a word can match in the lexicon: itself and its beginnings."""
    yield word
    for size in STEMS:
        if len(word) > size:
            yield word[:size] + "-"


def occurrences(text: str) -> Counter:
    """How often each unit occurs in a text; at most OFTEN, so that no text decides alone."""
    words = Counter(plain(w) for w in WORD.findall(text.lower()))
    found: Counter = Counter()
    for word, number in words.items():
        for unit in units(word):
            found[unit] += number
    return Counter({unit: min(number, OFTEN) for unit, number in found.items()})


def lexicon(labelled: DataFrame) -> dict[str, float]:
    """Words and word beginnings by the log of how much commoner they are in toxic texts.

    Counted over distinct texts of the training sample: units that at least SUPPORT (and
    0.2 %) of the toxic texts hold, at most CANDIDATES, then those units in the other texts.
    Kept are units commoner by a factor of 3 and beyond chance.
    """
    texts = labelled.select("text", "toxic").groupBy("text").agg(F.max("toxic").alias("toxic"))
    sizes = texts.withColumn("words", F.size(F.split("text", r"\s+"))).groupBy("toxic").agg(
        F.count("*").alias("texts"), F.sum("words").alias("words")
    )
    totals = {row.toxic: row for row in sizes.collect()}
    if len(totals) < 2:
        return {}

    def counter(wanted: set[str] | None):
        def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held, number = Counter(), Counter()
            for frame in frames:
                for text in frame["text"]:
                    found = occurrences(text)
                    if wanted is not None:
                        found = Counter({u: found[u] for u in found.keys() & wanted})
                    held.update(found.keys())
                    number.update(found)
            rows = [(unit, held[unit], number[unit]) for unit in held]
            yield pd.DataFrame(rows, columns=["unit", "texts", "n"])  # of type object when empty
        return count

    def counted(kind: int, wanted: set[str] | None) -> DataFrame:
        return (
            texts.where(F.col("toxic") == kind).select("text")
            .mapInPandas(lean(counter(wanted)), "unit string, texts long, n long")
            .groupBy("unit").agg(F.sum("texts").alias("texts"), F.sum("n").alias("n"))
        )

    support = max(SUPPORT, 0.002 * totals[1].texts)
    toxic = {
        row.unit: row.n for row in
        counted(1, None).where(F.col("texts") >= support)
        .orderBy(F.desc("texts"), "unit").limit(CANDIDATES).collect()
    }
    clean = {row.unit: row.n for row in counted(0, set(toxic)).collect()}
    share = totals[1].words / totals[0].words
    found = {}
    for unit, number in toxic.items():
        expected = (clean.get(unit, 0) + 0.5) * share
        weight = math.log((number + 0.5) / (expected + 0.5))
        if weight >= math.log(3) and number - expected >= 4 * math.sqrt(expected + 1):
            found[unit] = weight
    return found


class Features:
    """Dense features of texts, given a lexicon."""

    def __init__(self, entries: dict[str, float]):
        self.entries = entries
        self.known: dict[str, float] = {}

    def _weight(self, word: str) -> float:
        found = max((self.entries.get(u, 0.0) for u in units(word)), default=0.0)
        if len(self.known) >= KNOWN:
            self.known.clear()
        self.known[word] = found
        return found

    def of(self, text: str) -> list[float]:
        words = WORD.findall(text)
        n = max(1, len(words))
        lower = text.lower()
        known, hits, second, disguised_hits = self.known, [], [], 0
        for place, word in enumerate(WORD.findall(lower)):
            weight = known.get(word)
            if weight is None:
                weight = self._weight(word)
            if not weight and not word.isalpha():
                weight = self._weight(plain(word))
                disguised_hits += weight > 0
            if weight:
                hits.append((place, weight, word))
            if word in SECOND_PERSON:
                second.append(place)
        weights = [w for _, w, _ in hits]
        strong = [w for w in weights if w >= STRONG]
        near = 0
        if hits and second:
            places = np.array(second)
            at = np.array([p for p, _, _ in hits])
            right = np.searchsorted(places, at)
            gap = np.minimum(
                np.abs(places[np.minimum(right, len(places) - 1)] - at),
                np.abs(places[np.maximum(right - 1, 0)] - at),
            )
            near = int((gap <= NEAR).sum())
        letters = sum(map(len, words)) or 1
        size = len(text) or 1
        raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        number = np.bincount(raw, minlength=256)
        upper = int(number[65:91].sum())
        marks = int(number[33:48].sum() + number[58:65].sum() + number[91:97].sum() + number[123:127].sum())
        symbols = int(number[[35, 36, 37, 38, 42, 43, 64, 94, 124, 126]].sum())
        return [
            len(hits) / n, sum(weights) / n, len(strong) / n, math.log1p(len(strong)),
            math.log1p(len(hits)),
            math.log1p(len({w for _, _, w in hits})), max(weights, default=0.0),
            near / (len(hits) or 1), len(second) / n, disguised_hits / n,
            upper / letters, sum(w.isupper() and len(w) > 1 for w in words) / n if upper else 0.0,
            marks / size, int(number[33]) / size, len(REPEATED.findall(text)) / n,
            len(DISGUISED.findall(text)) / n if symbols or number[48:58].any() else 0.0,
            symbols / size, int(number[48:58].sum()) / size, math.log1p(len(words)),
            letters / n if words else 0.0,
        ]


def with_features(rows: DataFrame, entries: dict[str, float]) -> DataFrame:
    @F.pandas_udf("array<double>")
    def dense(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from lean(scored)(texts)

    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        made = Features(entries)
        for part in texts:
            yield pd.Series([made.of(text) for text in part])

    return rows.withColumn("_features", array_to_vector(dense(F.coalesce("text", F.lit("")))))


class ToxicityModel:
    """A lexicon, boosted trees and their calibration; or a constant, where labels are too few."""

    def __init__(
        self, entries: dict[str, float], trees: GBTClassificationModel | None,
        curve: IsotonicRegressionModel | None, base: float,
    ):
        self.entries, self.trees, self.curve, self.base = entries, trees, curve, base

    def score(self, rows: DataFrame) -> DataFrame:
        """Adds score, between 0 and 1; a null text is scored as an empty one.

        A row's own columns travel in one struct, so none of them meets a column of the models.
        """
        rows = rows.drop("score")
        if self.trees is None:
            return rows.withColumn("score", F.lit(self.base))
        margin = vector_to_array("rawPrediction")[1]
        judged = self.trees.transform(with_features(rows.select(F.struct("*").alias("_row"), "text"), self.entries))
        judged = self.curve.transform(judged.withColumn("_margin", margin))
        return judged.select("_row.*", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "_score")).alias("score"))


def fit(labelled: DataFrame) -> ToxicityModel:
    """From rows of text, toxic (0 or 1) and part (any whole number).

    At most about SAMPLE rows are used, drawn by a hash of the text, so that copies of a text
    are drawn together. Rows with an odd part calibrate: trees are fitted on the others.
    """
    rows = labelled.where("text is not null and toxic in (0, 1)").select("text", "toxic", "part")
    n = rows.count()
    if n > SAMPLE:
        rows = rows.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < 1_000_000 * SAMPLE // n)
    rows = stored(rows.repartition(6, F.xxhash64("text")), "labelled")
    totals = dict(rows.groupBy("toxic").count().collect())
    toxic, both = totals.get(1, 0), sum(totals.values())
    base = toxic / both if both else 0.0
    fitted = rows.where("part % 2 = 0")
    entries = lexicon(fitted) if 0 < toxic < both else {}
    kinds = fitted.select("toxic").distinct().count()
    left = rows.where("part % 2 != 0")
    if kinds < 2 or left.select("toxic").distinct().count() < 2:
        return ToxicityModel({}, None, None, base)
    dense = stored(
        with_features(rows, entries).select(
            F.col("_features"), F.col("toxic").cast("double").alias("label"), "part"
        ),
        "features",
    )
    trees = GBTClassifier(
        featuresCol="_features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7
    ).fit(dense.where("part % 2 = 0"))
    held = trees.transform(dense.where("part % 2 != 0")).select(
        vector_to_array("rawPrediction")[1].alias("_margin"), "label"
    )
    curve = IsotonicRegression(
        featuresCol="_margin", labelCol="label", predictionCol="_score"
    ).fit(held)
    return ToxicityModel(entries, trees, curve, base)


def part_of(key: Column) -> Column:
    """crc32 of the id as text, modulo 4; 2 marks rows whose labels are never learned."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(4))


def train(documents: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Learns from labelled documents outside the held-out quarter.

    Repeated labels of an id count as toxic if one of them is. Parts 0 and 1 grow trees (they
    are told apart from part 3, which calibrates).
    """
    known = (
        labels.where("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
        .where(part_of(F.col("doc_id")) != 2)
    )
    labelled = documents.select("doc_id", "text").join(known, "doc_id")
    odd = F.when(part_of(F.col("doc_id")) == 3, 1).otherwise(0)
    return fit(labelled.select("text", "toxic", odd.alias("part")))


def judge(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """All documents with held_out, score and predicted (1 from `threshold` on) added.

    Every row is scored over its whole text, in one pass without a shuffle. Null and empty
    texts are scored as empty, rows without an id are not held out, repeated rows stay
    repeated, and columns of these three names are replaced; any other column is kept, whatever
    its name. Without labels of both kinds the score is the share of toxic ones (0 without
    any); an empty table of documents gives no rows. A text of any length is scored whole.
    """
    small_batches(documents.sparkSession)
    rows = documents.drop("held_out", "score", "predicted")
    held = F.coalesce(part_of(F.col("doc_id")) == 2, F.lit(False))
    return train(documents, labels).score(rows).withColumns({
        "held_out": held, "predicted": (F.col("score") >= threshold).cast("int"),
    })
