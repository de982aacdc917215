"""Operator 2: language-model scores by a class-based bigram model (Brown classes).

Exchange clustering assigns units to classes so that the likelihood of class bigrams
grows. Units are the most frequent training words, buckets of all others by their ending,
and the end of a text. Then every word beyond the units gets a class of its own, by the
classes that stand before and after it anywhere in the training texts. With all classes
set, class transitions are counted anew over the whole corpus. A text's probability is the
product of smoothed class transitions and smoothed word emissions.

Counts and classes of the frequent words, a bounded number, travel with the tasks. Those
of all others meet the texts in a join, so nothing that grows with the corpus is held
whole. Texts are split into words once; later passes read their numbers.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, crc_mod, release, runs, schema_of, written

#: In word numbers: the end of a text.
NONE = 0xFFFFFFFF


@dataclass(frozen=True)
class BrownConfig:
    """``head_words`` bounds the words whose counts travel with the tasks, ``unit_words``
    (at most that) those that are exchanged one by one; others are exchanged by bucket of
    ending and get their own class afterwards. Exchange ends after ``passes``, or when one
    gains less than ``settled`` of the likelihood. ``alpha`` smooths emissions, ``kappa``
    transitions."""

    classes: int = 32
    head_words: int = 131_072
    unit_words: int = 16_384
    buckets: int = 512
    ending: int = 3
    passes: int = 6
    settled: float = 2e-4
    alpha: float = 0.5
    kappa: float = 8.0

    @property
    def units(self) -> int:
        return self.unit_words + self.buckets + 1

    @property
    def end(self) -> int:
        return self.units - 1


def words_of(text: str | None) -> list[bytes]:
    """Words of a whole text: A-Z lower-cased, split at ASCII white space; null: none."""
    return (text or "").encode().lower().split()


def word_counts(docs: DataFrame, flush: int = 400_000) -> DataFrame:
    """(word, n) over all texts, without the ends."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                seen.update(words_of(text))
                if len(seen) > flush:
                    yield _counted(seen)
                    seen = Counter()
        yield _counted(seen)

    return docs.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _counted(seen: Counter[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])


def word_hash(word: bytes) -> int:
    """The hash that Spark's xxhash64 gives."""
    return xxhash.xxh64_intdigest(word, 42)


def packed(numbers: np.ndarray) -> bytes:
    """Word numbers of a text byte by byte, as their high bytes are mostly zeros."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()


class Units:
    """Numbers of words: ranks of frequent ones, and the unit that each word belongs to."""

    def __init__(self, head: list[bytes], cfg: BrownConfig):
        self.cfg = cfg
        self.rank = {w: i for i, w in enumerate(head)}
        self.of_rank = np.array([i if i < cfg.unit_words else self.bucket(w) for i, w in enumerate(head)] or [0], np.uint16)

    def bucket(self, word: bytes) -> int:
        return self.cfg.unit_words + zlib.crc32(word[-self.cfg.ending :]) % self.cfg.buckets

    def numbers(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
        """Of a text: each word's rank, or ``head_words`` plus its place among the text's rare
        words; the units, with the end's; the rare words and their units."""
        get, most = self.rank.get, self.cfg.head_words
        found = np.array([get(w, -1) for w in words], np.int64)
        deep = np.flatnonzero(found < 0)
        rare: dict[bytes, int] = {}
        found[deep] = [most + rare.setdefault(words[i], len(rare)) for i in deep.tolist()]
        units = np.append(self.of_rank[np.minimum(found, len(self.of_rank) - 1)], np.uint16(self.cfg.end))
        endings = np.array([self.bucket(w) for w in rare], np.uint16)
        units[deep] = endings[found[deep] - most]
        return found, units, list(rare), endings


def encoded(docs: DataFrame, learn: Column, units: Units, keep: tuple[str, ...]) -> DataFrame:
    """A row for each text: ``keep_0`` ..., ``learn``, word numbers and units as bytes, its
    rare words and their units."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 512):
                batch = whole.slice(lo, 512)
                numbered = [units.numbers(words_of(t)) for t in batch.column("text").to_pylist()]
                made = [pa.array([packed(n) for n, *_ in numbered], pa.binary()), pa.array([x[1].tobytes() for x in numbered], pa.binary()), pa.array([x[2] for x in numbered], pa.list_(pa.binary())), pa.array([x[3].tobytes() for x in numbered], pa.binary())]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *made], [*kept, "words", "units", "rare", "endings"])

    kept = (*(f"keep_{k}" for k in range(len(keep))), "learn")
    chosen = docs.select(*(column(c).alias(k) for c, k in zip(keep, kept, strict=False)), learn.alias("learn"), "text")
    return chosen.mapInArrow(encode, schema_of(chosen, kept, "words binary, units binary, rare array<binary>, endings binary")).withColumn("row", F.monotonically_increasing_id())


def neighbour_counts(rows: DataFrame, classes: np.ndarray, cfg: BrownConfig) -> tuple[np.ndarray, np.ndarray]:
    """(units x classes) counts of the class before, and of the class after, each unit;
    at most that many numbers, whatever the corpus."""
    size = cfg.units * cfg.classes
    end = cfg.end

    def count(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        before, after = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            u = np.concatenate(([end], np.frombuffer(b"".join(batch.column("units").to_pylist()), np.uint16))).astype(np.int64)
            c = classes[u]
            before += np.bincount(u[1:] * cfg.classes + c[:-1], minlength=size)
            after += np.bincount(u[:-1] * cfg.classes + c[1:], minlength=size)
        at = np.flatnonzero(before + after)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(before[at]), pa.array(after[at])], ["at", "b", "a"])

    found = rows.select("units").mapInArrow(count, "at long, b long, a long").groupBy("at").agg(F.sum("b").alias("b"), F.sum("a").alias("a")).toArrow()
    before, after = np.zeros(size, np.int64), np.zeros(size, np.int64)
    at = found.column("at").to_numpy()
    before[at], after[at] = found.column("b").to_numpy(), found.column("a").to_numpy()
    return before.reshape(-1, cfg.classes), after.reshape(-1, cfg.classes)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-12))


def likelihood(transitions: np.ndarray) -> float:
    """Class part of the log likelihood; what words add is the same for any classes."""
    return float(_xlogx(transitions).sum() - _xlogx(transitions.sum(axis=1)).sum() - _xlogx(transitions.sum(axis=0)).sum())


def exchange(before: np.ndarray, after: np.ndarray, classes: np.ndarray, movable: np.ndarray) -> np.ndarray:
    """One pass of exchange clustering: each movable unit in turn goes to the class where
    the likelihood of class bigrams is greatest, given where all others are now. A unit's
    neighbours count under the classes that they had when the pass began."""
    k = before.shape[1]
    classes = classes.copy()
    n = np.zeros((k, k))
    np.add.at(n, classes, after.astype(float))
    out, into = n.sum(axis=1), n.sum(axis=0)
    for u in movable:
        left, right, mass_in, mass_out = before[u], after[u], before[u].sum(), after[u].sum()
        if not mass_in and not mass_out:
            continue
        a = classes[u]
        n[a] -= right
        n[:, a] -= left
        out[a] -= mass_out
        into[a] -= mass_in
        np.maximum(n, 0, out=n)
        gain = (_xlogx(n + right) - _xlogx(n)).sum(axis=1) + (_xlogx(n.T + left) - _xlogx(n.T)).sum(axis=1)
        gain -= _xlogx(out + mass_out) - _xlogx(out) + _xlogx(into + mass_in) - _xlogx(into)
        b = int(gain.argmax())
        if gain[b] <= gain[a] + 1e-9:
            b = a
        n[b] += right
        n[:, b] += left
        out[b] += mass_out
        into[b] += mass_in
        classes[u] = b
    return classes


def smoothed(transitions: np.ndarray, tokens: np.ndarray, cfg: BrownConfig) -> np.ndarray:
    """log10 of transition probabilities, drawn to the classes' shares of all tokens."""
    prior = (tokens + 1) / (tokens + 1).sum()
    return np.log10((transitions + cfg.kappa * prior) / (transitions.sum(axis=1, keepdims=True) + cfg.kappa))


def exchanged(rows: DataFrame, cfg: BrownConfig) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The units' classes, class transitions and tokens of each class."""
    classes = (np.arange(cfg.units) % cfg.classes).astype(np.int64)
    best, kept = -np.inf, None
    for step in range(cfg.passes + 1):
        before, after = neighbour_counts(rows, classes, cfg)
        transitions, tokens = np.zeros((cfg.classes, cfg.classes)), np.zeros(cfg.classes)
        np.add.at(transitions, classes, after.astype(float))
        np.add.at(tokens, classes, before.sum(axis=1).astype(float))
        now, gained = likelihood(transitions), kept is None or likelihood(transitions) - best > cfg.settled * abs(best)
        if kept is None or now > best:
            best, kept = now, (classes, transitions, tokens)
        if step == cfg.passes or not gained:
            break
        busy = np.argsort(-(before.sum(axis=1) + after.sum(axis=1)), kind="stable")
        classes = exchange(before, after, classes, busy if step == 0 else busy[step % 2 :: 2])
    return kept


def own_classes(rows: DataFrame, head: list[bytes], classes: np.ndarray, transitions: np.ndarray, tokens: np.ndarray, cfg: BrownConfig) -> DataFrame:
    """(h, class): of every training word beyond the units, by hash, the class under which
    its neighbours are likeliest. Pairs of classes around a word are counted over the whole
    corpus, in each batch first. No word of them is a hot key: beyond ``unit_words`` more
    frequent ones it has at most that part of all tokens."""
    k, end = cfg.classes, np.array([NONE], np.uint32)
    of_head = np.array([word_hash(w) for w in head] or [0], np.uint64)

    def around(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            c = classes[np.concatenate(([cfg.end], np.frombuffer(b"".join(batch.column("units").to_pylist()), np.uint16)))]
            raw, rare = batch.column("words").to_pylist(), batch.column("rare").to_pylist()
            number = np.concatenate([x for r in raw for x in (unpacked(r), end)])
            at = np.flatnonzero((number >= cfg.unit_words) & (number != NONE))
            first = np.cumsum([0, *map(len, rare)])[:-1]
            text = np.repeat(np.arange(len(raw)), [len(r) // 4 + 1 for r in raw])[at]
            deep = number[at] >= cfg.head_words
            of_rare = np.array([word_hash(w) for r in rare for w in r], np.uint64)
            h = np.zeros(len(at), np.uint64)
            h[~deep] = of_head[number[at][~deep]]
            h[deep] = of_rare[first[text[deep]] + number[at][deep] - cfg.head_words]
            code = c[at] * k + c[at + 2]
            order = np.lexsort((code, h))
            cut = np.unique(np.concatenate((runs(h[order]), runs(code[order]))))[:-1] if len(at) else at
            n = np.diff(np.append(cut, len(at)))
            yield pa.RecordBatch.from_arrays([pa.array(h[order][cut].view(np.int64)), pa.array(code[order][cut].astype(np.int32)), pa.array(n, pa.int64())], ["h", "code", "n"])

    log = smoothed(transitions, tokens, cfg)
    gain = (log[:, None, :] + log.T[None, :, :] - np.log10(tokens + 1)).reshape(k * k, k)  # [before, after] by class

    def choose(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        held: tuple[int, np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            h, code, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("h", "code", "n"))
            cut = runs(h)
            sums, names = np.add.reduceat(gain[code] * n[:, None], cut[:-1]), h[cut[:-1]]
            if held is not None and held[0] == names[0]:
                sums[0] += held[1]
            elif held is not None:
                names, sums = np.append(held[0], names), np.vstack([held[1], sums])
            held = (names[-1], sums[-1])
            if len(names) > 1:
                yield pa.RecordBatch.from_arrays([pa.array(names[:-1]), pa.array(sums[:-1].argmax(axis=1).astype(np.int32))], ["h", "class"])
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held[0]], pa.int64()), pa.array([int(held[1].argmax())], pa.int32())], ["h", "class"])

    counted = rows.select("units", "words", "rare").mapInArrow(around, "h long, code int, n long")
    return counted.repartition("h").sortWithinPartitions("h").mapInArrow(choose, "h long, class int")


@dataclass(frozen=True)
class Lexicon:
    """Counts and classes of the frequent words and of the units."""

    counts: np.ndarray
    classes: np.ndarray
    of_units: np.ndarray
    end_count: int
    train_tokens: int
    vocabulary: int


CLASSED = "n_tokens long, n_known long, base double, emitted double, classes binary"


def classed(rows: DataFrame, rare: DataFrame, lexicon: Lexicon, kept: tuple[str, ...], cfg: BrownConfig) -> DataFrame:
    """Each text with the class of every token and what doesn't depend on classes' totals.
    ``rare`` (word, n, class) meets the texts' rare words in a join; one that was not learned
    has count 0 and the class of its ending."""
    log_base, end_class = np.log10(lexicon.train_tokens + 1.0 * (lexicon.vocabulary + 1)), lexicon.of_units[cfg.end]

    def settle(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 512):
                batch = whole.slice(lo, 512)
                out: list[tuple] = []
                for words, endings, met in zip(*(batch.column(c).to_pylist() for c in ("words", "endings", "met")), strict=True):
                    number = unpacked(words)
                    n, c = np.zeros(len(number), np.int64), np.full(len(number) + 1, end_class)
                    deep = number >= cfg.head_words
                    n[~deep] = lexicon.counts[number[~deep]]
                    c[:-1][~deep] = lexicon.classes[number[~deep]]
                    if len(endings):
                        own = lexicon.of_units[np.frombuffer(endings, np.uint16)]
                        seen = np.zeros(len(own), np.int64)
                        if met:
                            at = [m["at"] for m in met]
                            seen[at], own[at] = [m["n"] for m in met], [m["class"] for m in met]
                        place = number[deep] - cfg.head_words
                        n[deep], c[:-1][deep] = seen[place], own[place]
                    known = int((n > 0).sum()) + (lexicon.end_count > 0)
                    base = np.log10(n + 1.0).sum() + np.log10(lexicon.end_count + 1.0) - (len(n) + 1) * log_base
                    emitted = np.log10(n + cfg.alpha).sum() + np.log10(lexicon.end_count + cfg.alpha)
                    out.append((len(n) + 1, known, float(base), float(emitted), c.astype(np.uint8).tobytes()))
                made = [pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary()), strict=True)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *made], [*kept, "n_tokens", "n_known", "base", "emitted", "classes"])

    pairs = rows.select("row", F.posexplode("rare").alias("at", "word")).join(rare, "word")
    met = pairs.groupBy("row").agg(F.collect_list(F.struct("at", "n", "class")).alias("met"))
    both = rows.drop("rare", "units").join(met, "row", "left")
    return both.mapInArrow(settle, schema_of(both, kept, CLASSED))


def class_counts(rows: DataFrame, first: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Transitions between classes, each text starting from the end's, and tokens of each."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        sums = np.zeros(k * k, np.int64)
        for batch in batches:
            c = np.concatenate(([first], np.frombuffer(b"".join(batch.column("classes").to_pylist()), np.uint8))).astype(np.int64)
            sums += np.bincount(c[:-1] * k + c[1:], minlength=k * k)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k)), pa.array(sums)], ["code", "n"])

    transitions = np.zeros(k * k)
    for r in rows.select("classes").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).collect():
        transitions[r["code"]] = r["n"]
    transitions = transitions.reshape(k, k)
    return transitions, transitions.sum(axis=0)


def score_corpus(docs: DataFrame, learn: Column, cfg: BrownConfig = BrownConfig(), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``,
    ``score`` (log10 of the text's probability) and ``perplexity`` of each text, by a model
    of the texts of the rows where ``learn`` holds.

    The end of a text is a token and the class that every text starts from. A word that
    was not learned has count 0 in the class of its ending, whose unknown word it is. A
    null or empty text is its end alone. Repeated rows score alike; an empty table gives
    no rows; a model of no texts gives uniform scores.
    """
    k, train = cfg.classes, docs.where(learn)
    counts = written(word_counts(train))
    total, kinds = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    texts = train.count()
    top = counts.orderBy(F.desc("n"), "word").limit(cfg.head_words).toArrow()
    top = top.take(pa.array(np.lexsort((np.arange(len(top)), -top.column("n").to_numpy()))))
    head = top.column("word").to_pylist()
    kept = (*(f"keep_{j}" for j in range(len(keep))), "learn")
    rows = written(encoded(docs, F.coalesce(learn, F.lit(False)), Units(head, cfg), keep), "zstd")
    of_units, transitions, tokens = exchanged(rows.where("learn"), cfg)
    own = written(own_classes(rows.where("learn"), head, of_units, transitions, tokens, cfg))

    of_head = of_units[Units(head, cfg).of_rank][: len(head)]
    ranks = np.arange(min(cfg.unit_words, len(head)), len(head))
    if len(ranks):
        named = docs.sparkSession.createDataFrame(pa.table({"h": np.array([word_hash(head[r]) for r in ranks], np.uint64).view(np.int64), "rank": ranks}))
        found = own.join(F.broadcast(named), "h").select("rank", "class").toArrow()
        of_head[found.column("rank").to_numpy()] = found.column("class").to_numpy()
    types = np.bincount(of_head[: cfg.unit_words], minlength=k).astype(float)
    for r in own.groupBy("class").count().collect():
        types[r["class"]] += r["count"]
    types[of_units[cfg.end]] += texts > 0

    lexicon = Lexicon(top.column("n").to_numpy(), of_head, of_units, texts, int(total) + texts, int(kinds) + (texts > 0))
    least = int(lexicon.counts[-1]) if len(head) else 0
    rare = written(counts.where(F.col("n") <= least).withColumn("h", F.xxhash64("word")).join(own, "h").select("word", "n", "class"))
    release(counts, own)
    final = written(classed(rows, rare, lexicon, kept, cfg))
    release(rows, rare)
    first = int(of_units[cfg.end])
    transitions, tokens = class_counts(final.where("learn"), first, k)
    log_transition, log_total = smoothed(transitions, tokens, cfg), np.log10(tokens + cfg.alpha * (types + 1))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = batch.column("classes").to_pylist()
            c = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
            begin = np.cumsum([0, *map(len, raw)])[:-1]
            before = np.concatenate(([first], c[:-1]))
            before[begin] = first
            sums = np.add.reduceat(log_transition[before, c] - log_total[c], begin)
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in outcome), pa.array(sums + batch.column("emitted").to_numpy(zero_copy_only=False))], [*outcome, "score"])

    outcome = (*kept[:-1], "n_tokens", "n_known", "base")
    scored = final.mapInArrow(score, schema_of(final, outcome, "score double"))
    named = [F.col(k).alias(c) for k, c in zip(kept, keep, strict=False)]
    return scored.select(*named, "n_tokens", "n_known", F.lit(lexicon.train_tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))


def op2_brown_lm(docs: DataFrame, cfg: BrownConfig = BrownConfig()) -> DataFrame:
    held_out: Column = crc_mod("doc_id", 7) == 2
    scored = score_corpus(docs, ~held_out, cfg)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")
