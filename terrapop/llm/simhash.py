"""Operator 9: SimHash near-duplicates by pigeonring filtering.

Two fingerprints at a distance of T bits or less, seen as a ring of m segments, have a
start segment from which every chain of l consecutive segments differs in at most l T / m
bits. Chains that break this budget prune a pair before its whole distance is counted.

Two uses. ``links`` joins all 64-bit fingerprints at 3 or fewer differing bits: of eight
8-bit segments the chain of five then has its first two equal and at most one bit of
difference among the other three, so fingerprints that agree on four of the five segments
of some chain are candidates. ``drop_near_duplicates`` links documents whose sets of
five-word shingles have a Jaccard similarity of 0.8 or more. At that similarity about 15 %
of a SimHash's bits differ, so its fingerprints have 256 bits in a ring of sixteen
segments, 80 may differ, and segments alone can't be keys: with 5 bits of 16 free nearly
all pairs share one. Candidates meet by a shared shingle of the n/5 + 1 least-hashed ones
of either, which no pair of that similarity lacks; chains and distance prune them, and
the whole sets decide.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, fresh, given_names, plain, renamed, runs, schema_of, written
from .graph import components

SEED, BITS, SEGMENTS = 42, 64, 8
#: Of the fingerprints of documents: words of 64 bits, segments of 16 bits, and the bits
#: that may differ in all. At similarity 0.8 more differ in fewer than one pair of a
#: million (binomial estimate: 5 standard deviations, for the shortest texts too).
WIDE, RING, LOOSE = 4, 16, 80
WIDTH, CHUNK = 5, 500
#: Members of a cluster that one task compares: two blocks.
BLOCK = 256


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 of each ``width``-word shingle of a whole text in turn, words split at ASCII
    white space and A-Z lower-cased; a shorter text is one shingle, no words: none."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1])).tolist()
    last = (ends - 1).tolist()[min(width, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, last, strict=False)], np.uint64)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes (a row each, of some words) have each bit, highest first."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(len(hashes), -1), axis=1)
    whole = len(bits) // 255 * 255
    # sums of 255 bits fit a byte
    counts = bits[:whole].reshape(-1, 255, bits.shape[1]).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return counts + bits[whole:].sum(axis=0, dtype=np.uint8)


def fingerprint(text: str | None, width: int = 3) -> int:
    """SimHash of the ``width``-word shingles of a whole text; no words: 0. Unsigned."""
    hashes = shingle_hashes(text, width)
    return int.from_bytes(np.packbits(2 * bit_counts(hashes.reshape(-1, 1)) > len(hashes)).tobytes(), "big") if len(hashes) else 0


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), width: int = 3) -> DataFrame:
    """``keep`` columns and ``fp``, the fingerprint as a signed 64-bit integer."""

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, width) for t in batch.column("text").to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(fps)], [*kept, "fp"])

    chosen, kept = renamed(docs, keep, "text"), plain(keep)
    return given_names(chosen.mapInArrow(hashed, schema_of(chosen, kept, "fp long")), keep)


def chain_masks() -> list[tuple[np.uint64, np.uint64]]:
    """For each start segment and each of the chain's last three: (mask of the four
    segments that must agree, mask of the one that may differ in one bit)."""
    seg = [np.uint64(0xFF) << np.uint64(8 * i) for i in range(SEGMENTS)]
    out = []
    for i in range(SEGMENTS):
        chain = [(i + j) % SEGMENTS for j in range(5)]
        for loose in chain[2:]:
            out.append((np.bitwise_or.reduce([seg[j] for j in chain if j != loose]), seg[loose]))
    return out


def forest(values: np.ndarray, loose: np.uint64, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges of a spanning forest of the links among the distinct fingerprints of a
    bucket: each found value is compared only with those not yet reached."""
    left = values
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = left ^ queue[-1]
            near = np.bitwise_count(x & loose) <= 1
            near[near] = np.bitwise_count(x[near]) <= most
            if near.any():
                found = left[near]
                yield np.full(len(found), queue[-1]), found
                left = left[~near]
                queue.pop()
                queue.extend(found)
            else:
                queue.pop()


def links(fps: DataFrame, most: int = 3) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) that connect all that lie
    within ``most`` differing bits, by way of chain keys: linear in a bucket's size, never
    all pairs of it."""
    if most > 3:
        raise ValueError("the chains hold for distances up to 3")
    masks = chain_masks()

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False)
            u = fp.view(np.uint64)
            for k, (agree, _) in enumerate(masks):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fp), k, np.int32)), pa.array((u & agree).view(np.int64)), pa.array(fp)], ["k", "part", "fp"])

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        held = [np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)]
        empty = (np.zeros(0, np.int32),)
        for arrays in _with_end(batches):
            cols = [np.concatenate(x) for x in zip(held, arrays, strict=True)] if arrays else held
            cut = runs_of_two(cols[0], cols[1])
            stop = len(cut) - (2 if arrays else 1)
            heads = cut[: stop + 1]
            a: list[np.ndarray] = []
            b: list[np.ndarray] = []
            for j in np.flatnonzero(np.diff(heads) > 1):
                values = cols[2][heads[j] : heads[j + 1]].view(np.uint64)
                for x, y in forest(values, masks[cols[0][heads[j]]][1], most):
                    a.append(x)
                    b.append(y)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.uint64).view(np.int64)) for x in (a, b)], ["a", "b"])
            held = [c[heads[-1] :] for c in cols] if arrays else empty

    def _with_end(batches: Iterable[pa.RecordBatch]) -> Iterator[list[np.ndarray] | None]:
        for batch in batches:
            yield [batch.column(c).to_numpy(zero_copy_only=False) for c in ("k", "part", "fp")]
        yield None

    def runs_of_two(k: np.ndarray, part: np.ndarray) -> np.ndarray:
        if not len(k):
            return np.zeros(1, np.int64)
        return np.unique(np.concatenate((runs(k), runs(part))))

    keys = fps.select("fp").mapInArrow(keyed, "k int, part long, fp long")
    return keys.repartition("k", "part").sortWithinPartitions("k", "part").mapInArrow(scan, "a long, b long")


def near_duplicate_components(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), width: int = 3, most: int = 3) -> DataFrame:
    """``keep`` columns, ``fp`` and ``component_id``: the smallest ``doc_id`` that links of
    ``most`` or fewer differing bits reach, the document itself included.

    Equal fingerprints are joined once as one node, so that copies cost nothing. Null and
    wordless texts have fingerprint 0 and link like any other. Repeated rows share their
    component; rows without doc_id take their component's smallest, null if it has none.
    """
    prints = written(fingerprints(docs, tuple(dict.fromkeys([*keep, "doc_id"])), width))
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = written(components(links(nodes, most)))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(labels, "fp").select(*map(column, keep), "fp", "component_id")


def op9_simhash(docs: DataFrame) -> DataFrame:
    found = near_duplicate_components(docs)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# Documents by exact similarity


def name_of(found: np.ndarray) -> int:
    """One signed number for equal sets."""
    return xxhash.xxh3_64_intdigest(found.tobytes(), SEED) - 2**63


def wide_fingerprint(found: np.ndarray) -> np.ndarray:
    """SimHash of a set of shingles, of ``WIDE`` words; no shingles: 0."""
    if not len(found):
        return np.zeros(WIDE, np.uint64)
    mixed = found[:, None] * np.array([1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
    mixed[:, 1:] ^= mixed[:, 1:] >> np.uint64(32)
    mixed[:, 1:] *= np.uint64(0xFF51AFD7ED558CCD)
    mixed[:, 1:] ^= mixed[:, 1:] >> np.uint64(33)
    return np.packbits(2 * bit_counts(mixed) > len(found)).view(">u8").astype(np.uint64)


def in_budget(fps: np.ndarray, to: np.ndarray, chain: int = 3) -> np.ndarray:
    """Which of the wide fingerprints keep the ring's budgets to ``to``: from some segment
    all chains of up to ``chain`` segments stay within their share, and then the whole
    distance within ``LOOSE``."""
    x = fps ^ to
    apart = np.bitwise_count(x.view(np.uint16)).astype(np.int16)  # a column for each of the RING segments
    share, good, cumulative = LOOSE // RING, np.ones(apart.shape, bool), np.zeros(apart.shape, np.int16)
    for step in range(chain):
        cumulative += np.roll(apart, -step, axis=1)
        good &= cumulative <= share * (step + 1)
    near = good.any(axis=1)
    near[near] = apart[near].sum(axis=1) <= LOOSE
    return near


def close(n: np.ndarray, fps: np.ndarray, size: int, to: np.ndarray) -> np.ndarray:
    """Which sets of sizes ``n`` may be similar to the one of ``size``."""
    near = 5 * np.minimum(n, size) >= 4 * np.maximum(n, size)
    near[near] = in_budget(fps[near], to)
    return near


FINGERPRINT = ", ".join(f"f{k} long" for k in range(WIDE))


def marks(docs: DataFrame) -> DataFrame:
    """doc_id, node (equal sets are one), n, fingerprint and the least n/5 + 1 hashes."""

    def made(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            node, n, fps, least = [], [], [], []
            for text in batch.column("text").to_pylist():
                found = np.unique(shingle_hashes(text, WIDTH))
                node.append(name_of(found))
                n.append(len(found))
                fps.append(wide_fingerprint(found))
                least.append(found[: len(found) // 5 + 1].tobytes())
            words = np.array(fps, np.uint64).reshape(-1, WIDE).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(node, pa.int64()), pa.array(n, pa.int64()), *(pa.array(words[:, k].copy()) for k in range(WIDE)), pa.array(least, pa.binary())], ["doc_id", "node", "n", *(f"f{k}" for k in range(WIDE)), "least"])

    chosen = docs.select("doc_id", "text")
    return chosen.mapInArrow(made, schema_of(chosen, ("doc_id",), f"node long, n long, {FINGERPRINT}, least binary"))


def similar_forest(node: np.ndarray, n: np.ndarray, fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges of a spanning forest of the candidates of a bucket."""
    node, first = np.unique(node, return_index=True)
    n, fps = n[first], fps[first]
    left = np.arange(len(node))
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = close(n[left], fps[left], n[x], fps[x])
            if near.any():
                found = left[near]
                yield np.full(len(found), node[x]), node[found]
                left = left[~near]
                queue.extend(found)


def candidates(marked: DataFrame) -> DataFrame:
    """Edges (a, b) of nodes that connect all that may be similar: linear in a bucket's
    size where its members are alike, never all pairs of it."""
    names = ["h", "node", "n", *(f"f{k}" for k in range(WIDE))]

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                least = [np.frombuffer(x, np.int64) for x in batch.column("least").to_pylist()]
                times = [len(x) for x in least]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(least)), *(pa.array(np.repeat(batch.column(c).to_numpy(zero_copy_only=False), times)) for c in names[1:])], names)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * len(names)
        for batch in _filled(batches):
            cols = held if batch is None else [np.concatenate((h, batch.column(c).to_numpy(zero_copy_only=False))) for h, c in zip(held, names, strict=True)]
            cuts = runs(cols[0])
            heads = cuts if batch is None else cuts[:-1]
            node, n, fps = cols[1], cols[2], np.stack(cols[3:], axis=1).view(np.uint64)
            long = np.diff(heads)
            i = heads[:-1][long == 2]
            i = i[node[i] != node[i + 1]]
            i = i[5 * np.minimum(n[i], n[i + 1]) >= 4 * np.maximum(n[i], n[i + 1])]
            i = i[in_budget(fps[i], fps[i + 1])]
            pairs = [(node[i], node[i + 1])]
            for j in np.flatnonzero(long > 2):
                a, b = heads[j], heads[j + 1]
                pairs += similar_forest(node[a:b], n[a:b], fps[a:b])
            if sum(len(x) for x, _ in pairs):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*pairs, strict=True)], ["a", "b"])
            held = [c[heads[-1] :] for c in cols]

    keys = marked.where("n > 0").select(*names[1:], "least").mapInArrow(keyed, f"h long, node long, n long, {FINGERPRINT}")
    return keys.repartition("h").sortWithinPartitions("h").mapInArrow(scan, "a long, b long")


def _filled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    for batch in batches:
        if batch.num_rows:
            yield batch
    yield None


def exact_forest(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Edges that connect all sets of similarity 0.8 or more: each found set is compared
    only with those not yet reached."""
    size = np.array([len(x) for x in sets])
    ids, each = np.unique(np.concatenate(sets), return_inverse=True)
    owner, own = np.repeat(np.arange(len(sets)), size), np.split(each, np.cumsum(size)[:-1])
    flag, reached = np.zeros(len(ids), bool), np.zeros(len(sets), bool)
    edges = []
    for first in range(len(sets)):
        if reached[first]:
            continue
        reached[first], queue = True, [first]
        while queue and len(owner):
            left = ~reached[owner]
            owner, each = owner[left], each[left]
            x = queue.pop()
            flag[own[x]] = True
            shared = np.bincount(owner[flag[each]], minlength=len(sets))
            flag[own[x]] = False
            found = np.flatnonzero((9 * shared >= 4 * (size + size[x])) & ~reached).tolist()
            edges += [(x, y) for y in found]
            reached[found] = True
            queue += found
    return edges


def in_blocks(members: DataFrame, size: int) -> DataFrame:
    """Members (node, root) of clusters with the pairs of blocks (``lo``, ``hi``) that they
    belong to: a cluster of more than ``size`` is cut into blocks, and each two of them
    meet in a task of their own. A small cluster is one block."""
    sizes = members.groupBy("root").agg(F.ceil(F.count("*") / size).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: (b != F.col("own")) | (F.col("blocks") == 1))
    dealt = members.join(sizes, "root").withColumn("own", own).withColumn("other", F.explode(others))
    return dealt.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")}).drop("own", "other", "blocks")


def similar_links(texts: DataFrame) -> DataFrame:
    """Edges (a, b) between nodes of a cluster (columns root, lo, hi, node, text) by whole
    sets, for each pair of blocks."""

    def decided(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        group, held = None, {}
        for batch in _filled(batches):
            edges: list[tuple[int, int]] = []
            rows = [(None,) * 5] if batch is None else zip(*(batch.column(c).to_pylist() for c in ("root", "lo", "hi", "node", "text")), strict=True)
            for *of, node, text in rows:
                if of != group:
                    if len(held) > 1:
                        names = list(held)
                        edges += [(names[x], names[y]) for x, y in exact_forest(list(held.values()))]
                    group, held = of, {}
                if node is not None and node not in held and name_of(found := np.unique(shingle_hashes(text, WIDTH))) == node:
                    held[node] = found
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*edges, strict=True)], ["a", "b"])

    keys = ("root", "lo", "hi")
    return texts.select(*keys, "node", "text").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(decided, "a long, b long")


def _rooted(named: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(marks of all rows, nodes with the root of their component). Wordless texts are equal."""
    marked = written(marks(named))
    nodes = marked.groupBy("node").agg(F.min("doc_id").alias("first"))
    clusters = written(components(candidates(marked))).withColumnRenamed("root", "cluster")
    members = in_blocks(nodes.join(clusters, "node").select("node", F.col("cluster").alias("root"), F.col("first").alias("doc_id")), BLOCK)
    # a doc_id may be repeated with another text, so a node is known by its own rows
    texts = named.select("doc_id", "text").join(members, "doc_id")
    roots = written(components(similar_links(texts)))
    return marked, nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def similar_components(docs: DataFrame) -> DataFrame:
    """doc_id and ``component_id``: the smallest doc_id that links of documents reach.
    Wordless texts are equal."""
    marked, rooted = _rooted(docs)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return marked.select("doc_id", "node").join(rooted.join(least, "root").select("node", "component_id"), "node").select("doc_id", "component_id")


def with_node(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with the name of each text's set of shingles in the column ``name``."""
    keep = tuple(docs.columns)
    chosen, kept = renamed(docs, keep, F.col("text").alias("whole_text")), plain(keep)

    def named(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            nodes = [name_of(np.unique(shingle_hashes(t, WIDTH))) for t in batch.column("whole_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(nodes, pa.int64())], [*kept, "node"])

    return given_names(chosen.mapInArrow(named, schema_of(chosen, kept, "node long")).withColumnRenamed("node", name), keep)


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest
    doc_id, of several texts of that doc_id one. Columns and texts are as given.

    Rows are told apart by doc_id and set of shingles, so that a doc_id that is repeated with
    another text neither loses it nor keeps a copy with it; of rows that are alike in both
    one stays. Rows without doc_id pass; null, empty and wordless texts are one group; an
    empty table gives no rows.
    """
    named = docs.where("doc_id is not null")
    marked, rooted = _rooted(named)
    firsts = rooted.groupBy("root").agg(F.min(F.struct("first", "node")).alias("rep")).select(F.col("rep.first").alias("doc_id"), "rep.node")
    repeated = marked.groupBy("doc_id").agg((F.count("*") > 1).alias("repeated"))
    kept = written(firsts.join(repeated, "doc_id"))
    passed = named.join(kept.where("not repeated").select("doc_id"), "doc_id", "left_semi").select(*map(column, docs.columns))
    if kept.where("repeated").limit(1).count():
        node = fresh(docs, "shingle_set")
        several = kept.where("repeated").select("doc_id", F.col("node").alias(node))
        told = with_node(named.join(several.select("doc_id").distinct(), "doc_id", "left_semi").select(*map(column, docs.columns)), node)
        passed = passed.unionByName(told.join(several, ["doc_id", node], "left_semi").dropDuplicates(["doc_id", node]).select(*map(column, docs.columns)))
    return passed.unionByName(docs.where("doc_id is null"))
