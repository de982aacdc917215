"""Operator 1: toxicity by gradient-boosted trees with isotonic calibration.

Texts become dense features: densities of a learned lexicon (words and word stems that
labelled toxic texts hold far more often than clean ones), how close its words stand to
second-person words, capitals, punctuation, and obfuscated spellings of lexicon words.
Trees are boosted on them, and an isotonic fit on rows the trees have not seen turns
their margin into a probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, crc_mod, release, schema_of, written

WORD = re.compile(r"\w+")
TOKEN = re.compile(r"[^\s\w]*\w[^\s]*")
#: Second-person words of the languages served.
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch sie tu te toi ton ta tes vous votre vos usted ustedes ti tus vosotros".split())
#: Characters written in place of letters.
LOOKALIKE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": None, ".": None, "-": None, "_": None})
STEMS = (4, 5, 6)
FEATURES = ("words", "lexicon_count", "lexicon_density", "stem_count", "stem_density", "weight_density", "weight_max", "weight_total", "near_second_person", "second_person", "capitals", "shouting", "punctuation", "exclamations", "obfuscated")


@dataclass(frozen=True)
class ToxicityConfig:
    """``sample_rows`` bounds the labelled rows of either class that the model is fitted
    on; ``lexicon_size`` bounds the learned words and stems."""

    sample_rows: int = 8000
    lexicon_size: int = 4000
    least_lift: float = 4.0
    near: int = 3
    trees: int = 20
    depth: int = 3
    threshold: float = 0.7


def units(word: str) -> list[str]:
    """A word and its stems, stems marked by their length."""
    return [word, *(f"{n}:{word[:n]}" for n in STEMS if len(word) > n)]


def labelled_sample(docs: DataFrame, labels: DataFrame, train: Column, cfg: ToxicityConfig) -> DataFrame:
    """At most about ``sample_rows`` random training rows of each class, with ``toxic``
    and ``weight`` (the rows of its class that each stands for)."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(train)
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = {k: min(1.0, cfg.sample_rows / n) for k, n in sizes.items()}
    rate = F.when(F.col("toxic") == 1, share.get(1, 1.0)).otherwise(share.get(0, 1.0))
    picked = known.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("toxic")), F.lit(1 << 20)) < rate * (1 << 20))
    picked = picked.withColumn("weight", 1 / rate).limit(3 * cfg.sample_rows)
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")


def learn_lexicon(sample: DataFrame, cfg: ToxicityConfig) -> dict[str, float]:
    """Units whose document frequency in toxic texts exceeds that in clean ones both by
    ``least_lift`` and beyond chance (likelihood ratio above 2 ln of the units tried)."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        seen: tuple[Counter[str], Counter[str]] = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                seen[toxic].update({u for w in set(WORD.findall((text or "").lower())) for u in units(w)})
        for toxic in (0, 1):
            n = list(seen[toxic].values())
            yield pa.RecordBatch.from_arrays([pa.array(list(seen[toxic]), pa.string()), pa.array([toxic] * len(n), pa.int32()), pa.array(n, pa.int64())], ["unit", "toxic", "n"])

    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return {}
    table = sample.select("text", "toxic").mapInArrow(count, "unit string, toxic int, n long").groupBy("unit")
    table = table.agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("c"))
    t, c, total = F.col("t"), F.col("c"), F.col("t") + F.col("c")
    base = sizes[1] / (sizes[0] + sizes[1])
    ratio = t * F.log(F.greatest(t, F.lit(1e-9)) / (total * base)) + c * F.log(F.greatest(c, F.lit(1e-9)) / (total * (1 - base)))
    lift = (t / sizes[1]) / ((c + 0.5) / sizes[0])
    table = written(table)
    tried = table.count()
    best = table.where(t >= 3).withColumns({"ratio": 2 * ratio, "lift": lift}).where((F.col("lift") >= cfg.least_lift) & (F.col("ratio") >= 2 * math.log(max(tried, 2))))
    lexicon = {r["unit"]: math.log(r["lift"]) for r in best.orderBy(F.desc("ratio"), "unit").limit(cfg.lexicon_size).collect()}
    release(table)
    return lexicon


class Features:
    """Dense features of a text for a lexicon; words are looked up once and remembered."""

    def __init__(self, lexicon: dict[str, float], near: int, limit: int = 500_000):
        self.lexicon, self.near, self.limit = lexicon, near, limit
        self.memo: dict[str, tuple[bool, float]] = {}

    def of_word(self, word: str) -> tuple[bool, float]:
        """(in the lexicon as a word, greatest weight of it or its stems)."""
        found = self.memo.get(word)
        if found is None:
            if len(self.memo) > self.limit:
                self.memo.clear()
            found = self.memo[word] = (word in self.lexicon, max([self.lexicon.get(u, 0.0) for u in units(word)]))
        return found

    def of_text(self, text: str) -> list[float]:
        words = WORD.findall(text.lower())
        n = max(1, len(words))
        counts = Counter(words)
        hits = {w: k for w, k in counts.items() if self.of_word(w)[1] > 0}
        exact = sum(k for w, k in hits.items() if self.of_word(w)[0])
        weight = sum(k * self.of_word(w)[1] for w, k in hits.items())
        person = sum(counts[w] for w in SECOND_PERSON if w in counts)
        close = 0
        if hits and person:
            at = np.flatnonzero(np.fromiter((w in hits for w in words), bool, len(words)))
            who = np.flatnonzero(np.fromiter((w in SECOND_PERSON for w in words), bool, len(words)))
            right = np.searchsorted(who, at)
            gap = np.minimum(np.abs(who[np.minimum(right, len(who) - 1)] - at), np.abs(who[np.maximum(right - 1, 0)] - at))
            close = int((gap <= self.near).sum())
        kinds = np.bincount(np.frombuffer(text.encode(), dtype=np.uint8), minlength=256)
        letters = max(1, int(kinds[65:91].sum() + kinds[97:123].sum()))
        marks = int(kinds[33:48].sum() + kinds[58:65].sum())
        caps = int(kinds[65:91].sum())
        shouting = sum(1 for w in text.split() if len(w) > 2 and w.isupper()) if caps > 0.1 * letters else 0
        obfuscated = 0
        if kinds[48:58].sum() or kinds[36] or kinds[64] or kinds[42]:
            for token in TOKEN.findall(text.lower()):
                if not token.isalpha() and (plain := token.translate(LOOKALIKE).strip(",;:?\"'()")) != token and plain.isalpha():
                    obfuscated += plain in self.lexicon and not WORD.search(token)[0] in self.lexicon
        stems = sum(hits.values())
        best = max((self.of_word(w)[1] for w in hits), default=0.0)
        return [math.log1p(len(words)), math.log1p(exact), exact / n, math.log1p(stems), stems / n, weight / n, best, math.log1p(weight), close / n, person / n, caps / letters, shouting / n, marks / max(1, len(text)), int(kinds[33]) / n, obfuscated / n]


def with_features(df: DataFrame, lexicon: dict[str, float], cfg: ToxicityConfig, keep: tuple[str, ...]) -> DataFrame:
    def featurise(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        made = Features(lexicon, cfg.near)
        for batch in batches:
            x = np.array([made.of_text(t or "") for t in batch.column("text").to_pylist()], dtype=np.float64).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *(pa.array(x[:, j]) for j in range(len(FEATURES)))], [*keep, *FEATURES])

    chosen = df.select(*map(column, dict.fromkeys([*keep, "text"])))
    return chosen.mapInArrow(featurise, schema_of(chosen, keep, ", ".join(f"{f} double" for f in FEATURES)))


def score_toxicity(docs: DataFrame, labels: DataFrame, train: Column, cfg: ToxicityConfig = ToxicityConfig(), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``toxicity``, a calibrated probability from 0 to 1.

    Learns from ``toxic`` of ``labels`` (doc_id, toxic 0/1; the larger of repeated ones)
    where ``train``, a condition on doc_id, holds, on bounded random samples of each
    class. Whole texts are scored; null texts as empty ones. Without rows of both classes
    there is nothing to learn: every score is the toxic share of what there is, else 0.
    Repeated rows score alike; an empty table gives no rows. No other column is an input.
    """
    sample = written(labelled_sample(docs, labels, train, cfg))
    lexicon = learn_lexicon(sample, cfg)
    rows = written(with_features(sample, lexicon, cfg, ("doc_id", "toxic", "weight")).coalesce(4))
    release(sample)
    assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="_features")
    rows = assemble.transform(rows).withColumn("_label", F.col("toxic").cast("double"))
    calibrate = crc_mod("doc_id", 10) < 3
    parts = rows.groupBy(calibrate.alias("c")).agg(F.min("toxic"), F.max("toxic"), F.sum("toxic")).collect()
    if len(parts) < 2 or any(r[1] != 0 or r[2] != 1 for r in parts):
        share = rows.agg(F.sum(F.col("toxic") * F.col("weight")) / F.sum("weight")).first()[0] if parts else 0.0
        return docs.select(*map(column, keep), F.lit(float(share or 0.0)).alias("toxicity"))
    positives = sum(r[3] for r in parts if not r["c"])
    trees = GBTClassifier(featuresCol="_features", labelCol="_label", maxIter=cfg.trees, maxDepth=cfg.depth, stepSize=0.3, maxBins=64, minInstancesPerNode=max(2, min(20, positives // 10)), seed=7, cacheNodeIds=False)
    boosted = trees.fit(rows.where(~calibrate).select("_features", "_label").cache())
    margin = lambda df: boosted.transform(df).withColumn("_margin", vector_to_array("rawPrediction")[1])
    fitted = IsotonicRegression(featuresCol="_margin", labelCol="_label", weightCol="weight", predictionCol="toxicity").fit(margin(rows.where(calibrate)).select("_margin", "_label", "weight"))
    scored = fitted.transform(margin(assemble.transform(with_features(docs, lexicon, cfg, keep))))
    order = 1 / (1 + F.exp(-2 * F.col("_margin")))  # tells apart what the fit's flat steps hold
    calibrated = F.greatest(F.lit(0.0), F.least(F.lit(1.0), "toxicity"))
    return scored.select(*map(column, keep), (0.98 * calibrated + 0.02 * order).alias("toxicity"))


def op1_toxicity(docs: DataFrame, labels: DataFrame, cfg: ToxicityConfig = ToxicityConfig()) -> DataFrame:
    held_out = crc_mod("doc_id", 3) == 1
    scored = score_toxicity(docs, labels, ~held_out, cfg)
    return scored.select("doc_id", held_out.alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= cfg.threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, cfg: ToxicityConfig = ToxicityConfig()) -> DataFrame:
    """Documents that score below the threshold, columns and texts as given."""
    # numbered names can't clash with those of features, and the text travels once
    numbered = [c if c in ("doc_id", "text") else f"column_{k}" for k, c in enumerate(docs.columns)]
    scored = score_toxicity(docs.toDF(*numbered), labels, crc_mod("doc_id", 3) != 1, cfg, tuple(numbered))
    return scored.where(F.col("toxicity") < cfg.threshold).select(*numbered).toDF(*docs.columns)
