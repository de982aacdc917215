"""Operator 7: language identification by nearest centroids.

A text is a normalised TF-IDF vector of hashed letter n-grams (1 to 3 UTF-8 bytes of the
lower-cased text). Each language has a few centroids (spherical k-means); the language of
the most similar centroid wins, and a text further from it than nearly all training texts
is flagged as rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, given_names, plain, renamed, schema_of

LETTER = re.compile(r"[^\W\d_]")
#: Bytes that count as text: ASCII letters and all of multi-byte characters.
_KEEP = np.array([chr(b).isalpha() if b < 128 else True for b in range(256)])
_FOLD = np.where(_KEEP, np.arange(256), 32).astype(np.uint32)


@dataclass(frozen=True)
class LanguageConfig:
    """``sample_rows`` bounds the labelled rows that the classifier is fitted on, shared
    out evenly among the languages; each language has ``least_rows`` of them at least (all
    its rows, if fewer), however many languages there are. Up to ``broadcast_languages``
    of them, which is counted, their shares are broadcast; beyond that they are joined."""

    dims: int = 4096
    sample_rows: int = 4000
    least_rows: int = 20
    broadcast_languages: int = 10_000
    clusters: int = 4
    rounds: int = 8
    reject_quantile: float = 0.002
    sharpness: float = 25.0


@dataclass(frozen=True)
class LanguageModel:
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    languages: tuple[str, ...]
    radius: np.ndarray


def ngram_counts(texts: list[str], dims: int, block_bytes: int = 1 << 20) -> Iterable[tuple[int, np.ndarray]]:
    """Yields (first text, count matrix) for runs of texts of about ``block_bytes``; a
    longer text is counted whole, in a run of its own."""
    raw = [t.lower().encode() for t in texts]
    lo = 0
    while lo < len(raw):
        hi, total = lo + 1, len(raw[lo])
        while hi < len(raw) and hi - lo < 256 and total + len(raw[hi]) <= block_bytes:
            total += len(raw[hi])
            hi += 1
        x = _FOLD[np.frombuffer(b"".join([b" %b  " % r for r in raw[lo:hi]]) + b"  ", dtype=np.uint8)]
        row = np.repeat(np.arange(hi - lo), [len(r) + 3 for r in raw[lo:hi]])
        a, b, c = x[:-2], x[1:-1], x[2:]
        some = a != 32
        codes = np.concatenate(
            [
                (row * dims + (a * np.uint32(2654435761) >> np.uint32(20)) % dims)[some],
                (row * dims + ((a * np.uint32(257) + b) * np.uint32(2246822519) >> np.uint32(15)) % dims)[some | (b != 32)],
                (row * dims + (((a * np.uint32(257) + b) * np.uint32(257) + c) * np.uint32(3266489917) >> np.uint32(13)) % dims)[(b != 32) & (some | (c != 32))],
            ]
        )
        yield lo, np.bincount(codes, minlength=(hi - lo) * dims).reshape(hi - lo, dims)
        lo = hi


def normalised(rows: np.ndarray) -> np.ndarray:
    length = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 0)


def tf(counts: np.ndarray) -> np.ndarray:
    return np.log1p(counts.astype(np.float32))


def clustered(rows: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Spherical k-means with farthest-first seeds; at most ``k`` centroids."""
    seeds = [normalised(rows.mean(axis=0, keepdims=True))[0]]
    near = rows @ seeds[0]
    while len(seeds) < min(k, len(rows)):
        seeds.append(rows[int(near.argmin())])
        near = np.maximum(near, rows @ seeds[-1])
    centres = np.stack(seeds)
    for _ in range(rounds):
        nearest = (rows @ centres.T).argmax(axis=1)
        sums = np.stack([rows[nearest == j].sum(axis=0) if (nearest == j).any() else centres[j] for j in range(len(centres))])
        centres = normalised(sums)
    return centres


def training_sample(docs: DataFrame, train: Column, cfg: LanguageConfig) -> pd.DataFrame:
    """A bounded random sample of training rows, about the same for each language."""
    fit = docs.where(train & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = fit.groupBy("lang").agg(F.count("*").alias("n"))
    languages = sizes.count()
    if not languages:
        return pd.DataFrame({"lang": [], "counts": []})
    each = max(cfg.least_rows, cfg.sample_rows // languages)
    shares = sizes.select(F.col("lang").alias("of"), F.least(F.lit(1.0), F.lit(float(each)) / F.col("n")).alias("share"))
    if languages <= cfg.broadcast_languages:
        shares = F.broadcast(shares)
    at = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("language")), F.lit(1 << 20))
    picked = fit.select("lang", "text", at.alias("at")).join(shares, F.col("lang") == F.col("of")).where(F.col("at") < F.col("share") * (1 << 20))

    def featurise(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            counts = [bytes(r) for _, m in ngram_counts(texts, cfg.dims) for r in m.astype(np.uint32)]
            lettered = [LETTER.search(t) is not None for t in texts]
            out = pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(counts, pa.binary())], ["lang", "counts"])
            yield out.filter(pa.array(lettered, pa.bool_()))

    rows = picked.select("lang", "text").mapInArrow(featurise, "lang string, counts binary")
    return rows.toArrow().to_pandas()


def fit_language_model(docs: DataFrame, train: Column, cfg: LanguageConfig = LanguageConfig()) -> LanguageModel | None:
    """Fits on a bounded sample of the rows where ``train`` holds; ``None`` without any."""
    sample = training_sample(docs, train, cfg)
    if sample.empty:
        return None
    sample = sample.sort_values(["lang", "counts"], ignore_index=True)
    weights = tf(np.frombuffer(b"".join(sample["counts"]), dtype=np.uint32).reshape(len(sample), cfg.dims))
    idf = (np.log((1 + len(weights)) / (1 + (weights > 0).sum(axis=0))) + 1).astype(np.float32)
    vectors = normalised(weights * idf)
    languages = tuple(sorted(sample["lang"].unique()))
    centres = [clustered(vectors[(sample["lang"] == lang).to_numpy()], cfg.clusters, cfg.rounds) for lang in languages]
    centroids = np.concatenate(centres)
    owner = np.repeat(np.arange(len(languages)), [len(c) for c in centres])
    similar = vectors @ centroids.T
    nearest = similar.argmax(axis=1)
    best = similar.max(axis=1)
    radius = np.array([1 - np.quantile(best[nearest == j], cfg.reject_quantile) if (nearest == j).any() else 2.0 for j in range(len(centroids))])
    return LanguageModel(idf, centroids, owner, languages, radius)


def identify_language(docs: DataFrame, train: Column, cfg: LanguageConfig = LanguageConfig(), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``lang_pred``, ``score`` (softmax over languages of the best
    cosine, 0 to 1), ``similarity`` (that cosine) and ``rejected`` (further from its
    centroid than nearly all training texts of it).

    Learns from ``text`` and non-null ``lang`` of the rows where ``train`` holds. A null
    text, or one without a letter, is ``und`` with score 0 and rejected; so is every text
    when there is nothing to learn from. Whole texts count, however long. Equal
    similarities: the alphabetically first language. Repeated rows are each predicted.
    """
    model = fit_language_model(docs, train, cfg)

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            n = len(texts)
            pred, score, cosine, far = np.full(n, "und", dtype=object), np.zeros(n), np.zeros(n), np.ones(n, dtype=bool)
            if model is not None and n:
                lettered = np.fromiter((LETTER.search(t) is not None for t in texts), dtype=bool, count=n)
                for lo, counts in ngram_counts(texts, cfg.dims):
                    similar = normalised(tf(counts) * model.idf) @ model.centroids.T
                    by_language = np.stack([similar[:, model.owner == j].max(axis=1) for j in range(len(model.languages))], axis=1)
                    e = np.exp(cfg.sharpness * (by_language - by_language.max(axis=1, keepdims=True)))
                    best, at = by_language.argmax(axis=1), slice(lo, lo + len(counts))
                    pred[at] = np.array(model.languages, dtype=object)[best]
                    score[at] = (e / e.sum(axis=1, keepdims=True)).max(axis=1)
                    cosine[at] = similar.max(axis=1)
                    far[at] = 1 - similar.max(axis=1) > model.radius[similar.argmax(axis=1)]
                pred[~lettered], score[~lettered], cosine[~lettered], far[~lettered] = "und", 0.0, 0.0, True
            added = {"lang_pred": pa.array(pred, pa.string()), "score": pa.array(score), "similarity": pa.array(cosine), "rejected": pa.array(far)}
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *added.values()], [*kept, *added])

    chosen, kept = renamed(docs, keep, "text"), plain(keep)
    return given_names(chosen.mapInArrow(predict, schema_of(chosen, kept, "lang_pred string, score double, similarity double, rejected boolean")), keep)


def op7_language_id(docs: DataFrame) -> DataFrame:
    held_out = crc_mod("doc_id", 3) == 1
    pred = identify_language(docs, ~held_out)
    return pred.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "similarity", "rejected")
