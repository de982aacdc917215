"""Operator 4: benchmark decontamination by size-partitioned MinHash containment search.

A test item with n shingles that a document contains to ``threshold`` misses at most
(1 - threshold) n of them. Items are partitioned by size; each partition's upper bound u
fixes how many of an item's least-hashed shingles make its MinHash sketch:
floor((1 - threshold) u) + 1. A document with none of the sketch can't contain the item,
however long it is, so the sketch finds every candidate; the share of the sketch that a
document holds estimates the containment, and exact shingle containment decides.

Documents meet sketches by hash in a join. A bit map of the sketches' hashes, of a size that
has a bound, travels with the tasks and keeps nearly all other shingles out of the join; up to
a number that is checked, so do the sorted hashes themselves, which keep out the rest.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, schema_of, written

WORD = re.compile(r"\w+")
Shingle = tuple[str, ...]
BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class ContainmentConfig:
    """``least_words``: shorter items are reported but drop no document, as a run of a few
    words is found by chance. The bit map has ``bits_per_hash`` bits for each hash of a
    sketch and ``most_bits`` at most, and up to ``most_hashes`` hashes travel with it;
    beyond these more shingles go to the join, none less.
    ``group`` bounds the candidate items that are checked with a text at a time."""

    width: int = 5
    threshold: float = 0.8
    least_words: int = 5
    bits_per_hash: int = 64
    most_bits: int = 1 << 26
    most_hashes: int = 1 << 21
    group: int = 256


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def shingles(words: list[str], width: int) -> set[Shingle]:
    """Distinct shingles; fewer words than ``width``: the whole sequence; none: none."""
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def sketch_size(n: int, threshold: float) -> int:
    """For an item of n shingles, by the upper bound of its partition (powers of two)."""
    upper = 1 << max(0, n - 1).bit_length()
    return min(n, upper - math.ceil(threshold * upper - 1e-9) + 1)


class WordHashes(dict):
    """Hashes of words, remembered for a while."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> int:
        if len(self) > self.limit:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def run_hashes(words: list[str], width: int, memo: WordHashes) -> np.ndarray:
    """Hashes of all runs of ``width`` words."""
    if len(words) < width:
        return np.zeros(0, np.uint64)
    h = np.array([memo[w] for w in words], np.uint64)
    out = np.zeros(len(h) - width + 1, np.uint64)
    for j in range(width):
        out = out * BASE + h[j : len(h) - width + 1 + j]
    out ^= out >> np.uint64(29)
    return out * np.uint64(0xBF58476D1CE4E5B9)


def item_sketches(items: DataFrame, cfg: ContainmentConfig) -> DataFrame:
    """(key, words, width, size, h): the least hashes of each item's shingles, by the size of
    its partition; ``width`` is that of its shingles, ``size`` the sketch's."""

    def sketch(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            out: list[tuple[int, int, int, int, int]] = []
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = words_of(text)
                if not words:
                    continue
                width = min(len(words), cfg.width)
                h = np.unique(run_hashes(words, width, memo))
                h = h[: sketch_size(len(h), cfg.threshold)]
                out += [(key, len(words), width, len(h), x) for x in h.view(np.int64).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], pa.int64()) for j in range(5)], ["key", "words", "width", "size", "h"])

    return items.select("key", "text").mapInArrow(sketch, "key long, words long, width long, size long, h long")


def bit_map(sketches: DataFrame, cfg: ContainmentConfig) -> tuple[np.ndarray, np.ndarray | None]:
    """A bit for each hash of the sketches, by its high bits, of a power of two of bits; and
    the distinct hashes in order, None if there are too many."""
    n = sketches.count()
    exact = np.unique(sketches.select("h").distinct().toArrow().column("h").to_numpy().view(np.uint64)) if n <= cfg.most_hashes else None
    bits = min(cfg.most_bits, 1 << max(16, (cfg.bits_per_hash * n - 1).bit_length()))
    shift = 64 - bits.bit_length() + 1
    at = F.shiftrightunsigned("h", shift)
    words = sketches.groupBy(F.shiftright(at, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {shift}) & 63 as int))")).alias("held")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("held").to_numpy()
    return out.view(np.uint64), exact


def hit_documents(docs: DataFrame, keep: tuple[str, ...], widths: list[int], filters: tuple[np.ndarray, np.ndarray | None]) -> DataFrame:
    """``keep_0`` ..., ``text`` and ``hashes`` of the documents that hold a run of words whose
    hash is in the bit map, with those hashes."""
    kept = tuple(f"keep_{k}" for k in range(len(keep)))
    shift, held = np.uint64(64 - (64 * len(filters[0])).bit_length() + 1), docs.sparkSession.sparkContext.broadcast(filters)

    def search(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        memo, (table, exact) = WordHashes(), held.value
        for batch in batches:
            row, found = [], []
            for r, text in enumerate(batch.column("text").to_pylist()):
                words = words_of(text)
                h = np.concatenate([run_hashes(words, w, memo) for w in widths])
                at = h >> shift
                h = h[(table[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1]
                if exact is not None and len(h):
                    h = h[exact[np.minimum(np.searchsorted(exact, h), len(exact) - 1)] == h]
                if len(h):
                    row.append(r)
                    found.append(np.unique(h).view(np.int64))
            made = [*(batch.column(c).take(pa.array(row, pa.int64())) for c in (*kept, "text")), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(made, [*kept, "text", "hashes"])

    chosen = docs.select(*(column(c).alias(k) for c, k in zip(keep, kept, strict=True)), "text")
    return chosen.mapInArrow(search, schema_of(chosen, (*kept, "text"), "hashes array<long>"))


def _holds(words: list[str], short: Shingle) -> bool:
    return any(tuple(words[i : i + len(short)]) == short for i in range(len(words) - len(short) + 1))


CANDIDATES = "array<struct<item_id:bigint,words:bigint,estimate:double,item:string>>"
FOUND = "item_id long, item_words long, item_shingles long, found long, estimate double"


def find_contained(docs: DataFrame, benchmark: DataFrame, cfg: ContainmentConfig = ContainmentConfig(), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``item_id``, ``item_words``, ``item_shingles``, ``found``,
    ``estimate`` (share of the item's sketch) and ``containment`` for each document and each
    benchmark item (item_id, text) whose shingles it holds to ``threshold`` or more.

    Shingles are of ``width`` words (runs of letters, digits, underscores; lower-cased);
    an item of fewer words counts as one shingle, to be found as a run of words. Null,
    empty or wordless texts and items never match. Repeated documents are each reported;
    an item listed twice with one text counts once. Empty tables give no rows.
    """
    kept = tuple(f"keep_{k}" for k in range(len(keep)))
    named = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null").dropDuplicates()
    items = written(named.withColumn("key", F.monotonically_increasing_id()))
    sketches = written(item_sketches(items, cfg))
    widths = sorted(r["width"] for r in sketches.select("width").distinct().collect())
    if not widths:
        return docs.select(*map(column, keep), "text").limit(0).select(*map(column, keep), *[F.lit(0).cast(t).alias(n) for n, t in (x.split() for x in FOUND.split(", "))], F.lit(0.0).alias("containment"))
    hits = written(hit_documents(docs, keep, widths, bit_map(sketches, cfg)).withColumn("row", F.monotonically_increasing_id()))
    met = hits.select("row", F.explode("hashes").alias("h")).join(sketches, "h").groupBy("row", "key").agg(F.max("words").alias("words"), (F.count("*") / F.max("size")).alias("estimate"))
    many = met.groupBy("row").agg(F.ceil(F.count("*") / cfg.group).cast("int").alias("groups"))
    dealt = met.join(many, "row").withColumn("part", F.pmod(F.xxhash64("key"), F.col("groups"))).join(items.select("key", "item_id", F.col("text").alias("item")), "key")
    grouped = dealt.groupBy("row", "part").agg(F.collect_list(F.struct("item_id", "words", "estimate", "item")).cast(CANDIDATES).alias("candidates"))

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for r, (text, candidates) in enumerate(zip(batch.column("text").to_pylist(), batch.column("candidates").to_pylist(), strict=True)):
                words = words_of(text)
                own = shingles(words, cfg.width)
                for c in candidates:
                    wanted = shingles(words_of(c["item"]), cfg.width)
                    found = len(wanted & own) if c["words"] >= cfg.width else int(_holds(words, next(iter(wanted))))
                    if found >= cfg.threshold * len(wanted) - 1e-9:
                        out.append((r, c["item_id"], c["words"], len(wanted), found, c["estimate"]))
            row = pa.array([x[0] for x in out], pa.int64())
            made = [pa.array([x[j] for x in out], pa.int64() if j < 5 else pa.float64()) for j in range(1, 6)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(row) for c in kept), *made], [*kept, "item_id", "item_words", "item_shingles", "found", "estimate"])

    both = hits.drop("hashes").join(grouped, "row")
    checked = both.mapInArrow(verify, schema_of(both, kept, FOUND))
    return checked.select(*(F.col(k).alias(c) for k, c in zip(kept, keep, strict=True)), "item_id", "item_words", "item_shingles", "found", "estimate", (F.col("found") / F.col("item_shingles")).alias("containment"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, cfg: ContainmentConfig = ContainmentConfig()) -> DataFrame:
    """Documents that contain no benchmark item of ``least_words`` words or more, columns and
    texts as given; rows without doc_id pass. Shorter items are only reported, by
    ``find_contained``."""
    found = find_contained(docs, benchmark, cfg).where(F.col("item_words") >= cfg.least_words)
    gone = written(found.select("doc_id").distinct())
    return docs.join(gone, "doc_id", "left_anti").select(*map(column, docs.columns))
