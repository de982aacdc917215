"""Operator 11: spelling variants by range searches in k-d trees over letter counts.

One edit changes letter counts by one letter more (the longer word), one less, or one of
each; so a word's neighbours of its own length and of one letter more or less lie in a small
box around its counts, at an L1 distance of two at most. Words of a length have a k-d tree.
Its upper part, fitted on a bounded sample of words, cuts the space into leaves that tasks
hold; a word is sent to its own leaf, and as a query to each leaf that its box meets in the
trees of the three lengths. In a task a second tree over the leaf's own counts is searched by
all queries of a batch at once. What is in the box is compared letter by letter.

The sample only decides where cuts lie, never what is found: a leaf that holds more words
than a task should is dealt out in blocks, and its queries go to all of them. What a query
finds in a leaf leaves it as one row (count and best), so that nothing grows with a hub.

Words are strings of code points up to U+00FF. Null texts have no words.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, written

LETTERS = r"[A-Za-zÀ-ÿ]+"
#: Words that a task counts before it hands on what it has.
COUNTED = 300_000


@dataclass(frozen=True)
class SpellingConfig:
    """Words of ``least_letters`` and ``least_count`` occurrences; a form is ``ratio`` times
    as frequent. ``noise``: a run is stripped of one letter where it divides the crc32 of
    ``<doc_id>:<run>``; 0 for none. ``leaf_bytes`` bounds the letters of a leaf, ``leaf_words``
    its words, ``sample_words`` the words on which cuts are fitted, ``bucket`` the words
    that are compared one by one."""

    least_letters: int = 5
    least_count: int = 3
    ratio: int = 2
    noise: int = 97
    leaf_words: int = 8_000
    leaf_bytes: int = 4_000_000
    sample_words: int = 200_000
    bucket: int = 24


def count_words(docs: DataFrame, config: SpellingConfig) -> DataFrame:
    """word, n: runs of letters of whole texts, A-Z lower-cased, with the noise of the
    configuration, that have the length and count. A document without id has empty text for
    it. Counts are added up in tasks before they are shuffled."""
    noise, least = config.noise, config.least_letters

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        find, total = re.compile(LETTERS).findall, Counter()

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = Counter(find((text or "").encode().lower().decode()))  # bytes are lower-cased in A-Z only
                if noise:
                    head = zlib.crc32(f"{doc}:".encode())
                    for word in [w for w in own if zlib.crc32(w.encode(), head) % noise == 0]:
                        h = zlib.crc32(word.encode(), head) % len(word)
                        total[word[:h] + word[h + 1 :]] += own.pop(word)
                total.update(own)
                if len(total) > COUNTED:
                    yield rows()
        if total:
            yield rows()

    chosen = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.col("text").cast("string").alias("text"))
    counts = chosen.mapInArrow(counted, "word string, n long").where(F.length("word") >= least)
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= config.least_count)


def letters_of(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def counts_of(letters: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """Letter counts, a row for each word, a column for each letter of the alphabet."""
    return np.stack([(letters == a).sum(axis=1, dtype=np.int32) for a in alphabet], axis=1) if len(alphabet) else np.zeros((len(letters), 0), np.int32)


class Tree:
    """A k-d tree over letter counts. A node is (letter, value, low, high): counts up to
    ``value`` go low; or the number of a leaf."""

    def __init__(self, letters: np.ndarray, most: int):
        self.leaves: list[np.ndarray] = []
        self.root = self._cut(letters, np.arange(len(letters)), most, np.unique(letters))

    def _cut(self, letters: np.ndarray, own: np.ndarray, most: int, alphabet: np.ndarray):  # noqa: ANN202
        if len(own) > most:
            counts = counts_of(letters[own], alphabet)
            mid = np.partition(counts, len(own) // 2, axis=0)[len(own) // 2]
            best = []
            for value in (mid - 1, mid):
                low = (counts <= value).sum(axis=0)
                best.append((np.minimum(low, len(own) - low), value))
            score = np.stack([b[0] for b in best])
            k, j = np.unravel_index(np.argmax(score), score.shape)
            if score[k, j]:
                value = int(best[k][1][j])
                low = counts[:, j] <= value
                return int(alphabet[j]), value, self._cut(letters, own[low], most, alphabet), self._cut(letters, own[~low], most, alphabet)
        self.leaves.append(own)
        return len(self.leaves) - 1

    def search(self, letters: np.ndarray, more: int, less: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, numbers of the words whose box meets it); a box allows ``more`` letters of
        one kind above the word's counts, and ``less`` below them."""
        n = len(letters)
        todo = [(self.root, np.arange(n), np.full(n, more, np.int8), np.full(n, less, np.int8))]
        while todo:
            node, own, up, down = todo.pop()
            if not len(own):
                continue
            if isinstance(node, int):
                yield node, own
                continue
            letter, value, low, high = node
            count = (letters[own] == letter).sum(axis=1)
            for child, apart, up_cost in ((low, count - value, False), (high, value + 1 - count, True)):
                apart = np.maximum(apart, 0)
                left = (up if up_cost else down) - apart
                ok = left >= 0
                todo.append((child, own[ok], left[ok] if up_cost else up[ok], down[ok] if up_cost else left[ok]))


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of words (rows of letters, ``b`` of the same length or one letter longer)
    differ by exactly one edit."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    head = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(axis=1)
    tail = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= a.shape[1]


#: Query and point of a pair of lengths: letters more and less of the point.
SHIFTS = {-1: (0, 1), 0: (1, 1), 1: (1, 0)}


def search_leaf(points: np.ndarray, tree: Tree, queries: np.ndarray, cells: int = 4_000_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query number, point number) of one edit; all points have one length, and so
    have all queries."""
    shift = points.shape[1] - queries.shape[1]
    more, less = SHIFTS[shift]
    for leaf, own in tree.search(queries, more, less):
        members = tree.leaves[leaf]
        step = max(1, cells // (len(members) * points.shape[1]))
        for k in range(0, len(own), step):
            q, p = np.repeat(own[k : k + step], len(members)), np.tile(members, len(own[k : k + step]))
            a, b = (queries[q], points[p]) if shift >= 0 else (points[p], queries[q])
            hit = one_edit(a, b)
            yield q[hit], p[hit]


def fit_trees(words: DataFrame, config: SpellingConfig) -> dict[int, Tree]:
    """A tree for each length of the sample; its leaves stand for about ``leaf_words`` of all
    words. The sample is the words of least hash, ``sample_words`` at most."""
    total = words.count()
    share = min(1.0, config.sample_words / max(total, 1) / 1.2)
    some = words if share == 1.0 else words.where(F.pmod(F.xxhash64("word"), F.lit(1_000_000)) < int(share * 1_000_000))
    rows = some.where(F.length("word") <= 200).select("word").limit(config.sample_words).toPandas()["word"].sort_values().tolist()
    by: dict[int, list[str]] = {}
    for w in rows:
        by.setdefault(len(w), []).append(w)
    return {n: Tree(letters_of(some), max(1, int(share * min(config.leaf_words, config.leaf_bytes // n)))) for n, some in by.items()}


def dealt(words: DataFrame, trees: dict[int, Tree], config: SpellingConfig) -> DataFrame:
    """Points and queries by task: size, leaf, block, kind (0 a point, 1 a query), word, n. A
    length without a tree is one leaf; a leaf is dealt in blocks by a hash of the word."""

    def routed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, n = np.array(batch.column("word").to_pylist(), object), batch.column("n").to_numpy(zero_copy_only=False)
            size = np.array([len(w) for w in word], np.int64)
            for length in np.unique(size):
                own = np.flatnonzero(size == length)
                letters = letters_of(word[own].tolist())
                for shift, (more, less) in SHIFTS.items():
                    tree = trees.get(int(length) + shift)
                    legs = [(1, leaf, some) for leaf, some in tree.search(letters, more, less)] if tree else [(1, 0, np.arange(len(own)))]
                    if shift == 0:
                        legs += [(0, leaf, some) for leaf, some in tree.search(letters, 0, 0)] if tree else [(0, 0, np.arange(len(own)))]
                    for kind, leaf, some in legs:
                        rows = own[some]
                        fixed = [pa.array(np.full(len(rows), v, np.int32)) for v in (length + shift, leaf, kind)]
                        yield pa.RecordBatch.from_arrays([*fixed, pa.array(word[rows], pa.string()), pa.array(n[rows])], ["size", "leaf", "kind", "word", "n"])

    rows = written(words.select("word", "n").mapInArrow(routed, "size int, leaf int, kind int, word string, n long"))
    most = F.greatest(F.lit(1), F.least(F.lit(config.leaf_words), F.floor(config.leaf_bytes / F.col("size"))))
    sizes = rows.where("kind = 0").groupBy("size", "leaf").agg(F.count("*").alias("held")).withColumn("blocks", F.ceil(F.col("held") / most / 2).cast("int")).drop("held")
    each = rows.join(sizes, ["size", "leaf"])
    block = F.when(F.col("kind") == 0, F.array(F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    return each.withColumn("block", F.explode(block)).drop("blocks")


def near_words(words: DataFrame, config: SpellingConfig | None = None) -> DataFrame:
    """word, n_near, form, form_n of the words (word, n) that differ from another by exactly
    one inserted, deleted or replaced letter: how many such there are and the one with the
    largest n, then the first in code-point order."""
    config = config or SpellingConfig()
    trees = fit_trees(words, config)
    bucket = config.bucket

    def searched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, points, tree = None, [], [], None
        names: np.ndarray = np.zeros(0, object)
        counts = place = np.zeros(0, np.int64)
        for batch in batches:
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("size", "leaf", "block", "kind")]
            word, n = batch.column("word").to_pylist(), batch.column("n").to_pylist()
            cut = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
            for a, b in zip([0, *cut], [*cut, len(word)], strict=True):
                if a == b:
                    continue
                *leaf, kind = (int(c[a]) for c in cols)
                if leaf != key:
                    key, held, tree = leaf, [], None
                if kind == 0:
                    held += zip(word[a:b], n[a:b], strict=True)
                    continue
                if not held:
                    continue
                if tree is None:
                    points = letters_of([w for w, _ in held])
                    names, counts = np.array([w for w, _ in held], object), np.array([x for _, x in held], np.int64)
                    place = np.argsort(np.argsort(names))
                    tree = Tree(points, bucket)
                yield from best_of(word[a:b], points, tree, names, counts, place)

    def best_of(word: list[str], points: np.ndarray, tree: Tree, names: np.ndarray, counts: np.ndarray, place: np.ndarray) -> Iterator[pa.RecordBatch]:
        size = np.array([len(w) for w in word])
        for length in np.unique(size):
            some = [word[k] for k in np.flatnonzero(size == length)]
            pairs = [*search_leaf(points, tree, letters_of(some))]
            q, p = (np.concatenate(x) for x in zip(*pairs, strict=True)) if pairs else (np.zeros(0, int), np.zeros(0, int))
            if not len(q):
                continue
            order = np.lexsort((place[p], -counts[p], q))
            q, p = q[order], p[order]
            first = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1])))
            times = np.diff([*first, len(q)])
            yield pa.RecordBatch.from_arrays([pa.array([some[k] for k in q[first]]), pa.array(times), pa.array(names[p[first]], pa.string()), pa.array(counts[p[first]])], ["word", "n_near", "form", "form_n"])

    keys = ("size", "leaf", "block")
    found = dealt(words, trees, config).repartition(*keys).sortWithinPartitions(*keys, "kind").mapInArrow(searched, "word string, n_near long, form string, form_n long")
    best = F.min_by(F.struct("form", "form_n"), F.struct(-F.col("form_n"), "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("word", "n_near", "best.*")


def roots(forms: DataFrame, rounds: int = 64) -> DataFrame:
    """word, root of the pointers (word, form): the last word of each chain, by doubling. A
    form is more frequent than its word, so chains end."""
    now = written(forms.select("word", F.col("form").alias("root")))
    for _ in range(rounds):
        far = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = written(now.select("word", "root").join(far, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        release(now)
        now = after
        if not now.where("moved").limit(1).count():
            return now.select("word", "root")
    raise RuntimeError("chains did not end")


def spelling_variants(words: DataFrame, config: SpellingConfig | None = None) -> DataFrame:
    """word, n, n_near, form, form_n and root of each of the words (word, n): its form is the
    most frequent near word if that is ``ratio`` times as frequent."""
    config = config or SpellingConfig()
    near = words.join(near_words(words, config), "word", "left")
    often = F.col("form_n") >= config.ratio * F.col("n")
    shaped = written(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(often, F.col("form")).alias("form"), F.when(often, F.col("form_n")).alias("form_n")))
    ends = roots(shaped.where("form is not null"))
    return shaped.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op11_spelling(docs: DataFrame) -> DataFrame:
    """Each word of the documents with its form, root and near words."""
    config = SpellingConfig()
    return spelling_variants(written(count_words(docs, config)), config).select("word", "form", "root", "n", "n_near", "form_n")
