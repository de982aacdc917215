"""Operator 3: exact removal of repeated 50-byte strings, by suffix buckets over a cover.

Suffixes are not sorted whole. A cover sample of positions is chosen so that two equal
strings of 50 bytes always hold a sample at one and the same offset (the property a
difference cover gives, here by content: the least-hashed 20-gram of each window). Samples
are ranked first: by their 20-gram, which names the suffix bucket, and by a fingerprint of
all bytes for which the sample stands. Buckets are sorted one at a time in separate tasks;
ties of any length are resolved by those ranks. Only where a bucket holds unlike contexts
are the single 50-byte prefixes of its suffixes compared, bucket by bucket again.

Before each shuffle, equal strings in a task are reduced to the earliest document; the
others are known to be repeats already. So one very common string costs a row a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import runs, written

U64 = np.uint64
BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class SubstringConfig:
    """``length`` bytes make a repeat; samples are ``gram`` bytes; ``flush`` samples are
    held by a task at a time, and a bucket is sorted whole, so there is one at least for
    each ``bucket_bytes`` of text. ``cover`` is ``content`` (least-hashed grams) or ``position``
    (the difference cover modulo 31, for strings of 50 bytes and grams of 20)."""

    length: int = 50
    gram: int = 20
    flush: int = 1_000_000
    bucket_bytes: int = 16_000_000
    cover: str = "content"

    @property
    def window(self) -> int:
        return self.length - self.gram + 1


@lru_cache(maxsize=4)
def _powers(which: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo 2**64, and a random number per byte."""
    base = BASE[which]
    up = np.ones(size, U64)
    down = np.ones(size, U64)
    up[1:], down[1:] = U64(base), U64(pow(base, -1, 1 << 64))
    return np.multiply.accumulate(up), np.multiply.accumulate(down), np.random.default_rng(which).integers(1, 1 << 63, 256, dtype=U64)


class Prints:
    """Fingerprints of any substrings of one text, from prefix sums."""

    def __init__(self, raw: np.ndarray, which: int):
        size = 1 << max(17, int(len(raw) + 1).bit_length())
        up, self.down, table = _powers(which, size)
        self.sums = np.concatenate((np.zeros(1, U64), np.cumsum(table[raw] * up[: len(raw)], dtype=U64)))

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        x = (self.sums[stop] - self.sums[start]) * self.down[start]
        return _mixed(x)

    def all_of(self, width: int) -> np.ndarray:
        return _mixed((self.sums[width:] - self.sums[:-width]) * self.down[: len(self.sums) - width])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(31))) * U64(0xBF58476D1CE4E5B9)
    return x ^ (x >> U64(29))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while 2 * step <= width:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    rest = width - step
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


@dataclass
class Samples:
    """The cover of one text: sample ``at`` stands for the strings that start in
    [``low``, ``high``]; together these are all starts, in a cover by content each once."""

    at: np.ndarray
    low: np.ndarray
    high: np.ndarray
    hash: np.ndarray
    prints: Prints


#: A perfect difference set modulo 31. For any two places, some distance
#: below 31 leads from both to a place of these residues.
MODULUS, RESIDUES = 31, (1, 5, 11, 24, 25, 27)


def samples(raw: np.ndarray, cfg: SubstringConfig) -> Samples:
    prints = Prints(raw, 0)
    h = prints.all_of(cfg.gram)
    if cfg.cover == "position":
        if cfg.length - cfg.gram + 1 < MODULUS:
            raise ValueError("the cover needs strings of 30 bytes more than a gram")
        at = (np.arange(0, len(h), MODULUS)[:, None] + np.array(RESIDUES)).ravel()
        at = at[at < len(h)]
        low, high = np.maximum(at - MODULUS + 1, 0), np.minimum(at, len(raw) - cfg.length)
        some = low <= high
        return Samples(at[some], low[some], high[some], h[at[some]], prints)
    bits = U64(max(28, int(len(h)).bit_length()))
    order = ((h >> bits) << bits) | np.arange(len(h), dtype=U64)
    least = _sliding_min(order, cfg.window) & ((U64(1) << bits) - U64(1))
    cut = runs(least)
    at = least[cut[:-1]].astype(np.int64)
    return Samples(at, cut[:-1], cut[1:] - 1, h[at], prints)


def contexts(s: Samples, cfg: SubstringConfig, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each sample: a fingerprint of every byte that its strings touch and of where
    they lie, and two 16-bit ones of the 35 bytes that end and start with it: a string
    that holds the sample holds one of the two whole."""
    print_ = s.prints.of(s.low, s.high + cfg.length)
    whole = _mixed(print_ + (s.at - s.low).astype(U64) * U64(BASE[1]) + (s.high - s.low).astype(U64) * U64(BASE[0]))
    more = (cfg.length - cfg.gram) // 2
    left = s.prints.of(np.maximum(s.at - more, 0), s.at + cfg.gram) & U64(0xFFFF)
    right = s.prints.of(s.at, np.minimum(s.at + cfg.gram + more, size)) & U64(0xFFFF)
    return whole, (left << U64(16) | right).astype(np.uint32)


PACKED = "bucket int, docs binary, rows binary, who binary, key binary, tie binary, side binary, pos binary, old binary"
PACKED_TYPES = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in ("docs", "rows", "who", "key", "tie", "side", "pos", "old"))])


def planes(x: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of each number, byte by byte: zeros and repeats compress."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1)[:, :width].T).tobytes()


def from_planes(raw: bytes, width: int, kind: type) -> np.ndarray:
    flat = np.frombuffer(raw, np.uint8).reshape(width, -1)
    out = np.zeros((flat.shape[1], np.dtype(kind).itemsize), np.uint8)
    out[:, :width] = flat.T
    return out.view(kind).ravel()


class Packer:
    """Gathers (document, key, tie, side, position) of many texts and gives them out as a
    few binary rows for each bucket; equal (key, tie) of a later document are only noted
    as ``old``, their positions known to be repeats."""

    def __init__(self, buckets: int, flush: int):
        self.buckets, self.flush = buckets, flush
        self.parts: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, doc: int, row: int, key: np.ndarray, tie: np.ndarray, side: np.ndarray, pos: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append((doc, row, key, tie, side, pos))
        self.held += len(pos)
        if self.held >= self.flush:
            yield from self.out()

    def out(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        docs, rows = (np.array([p[j] for p in self.parts], np.int64) for j in (0, 1))
        who = np.repeat(np.arange(len(self.parts), dtype=np.uint32), [len(p[5]) for p in self.parts])
        key, tie, side, pos = (np.concatenate([p[j] for p in self.parts]) for j in (2, 3, 4, 5))
        self.parts, self.held = [], 0
        order, later = earliest_first(key, tie, docs[who])
        old = np.zeros(len(key), bool)
        old[order[later]] = True
        bucket = (key % U64(self.buckets)).astype(np.int32)
        order = np.lexsort((who, bucket))
        cut = runs(bucket[order])
        out = []
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            i = order[a:b]
            own, local = np.unique(who[i], return_inverse=True)
            new, gone = ~old[i], old[i]
            word = local.astype(np.uint32)
            out.append((int(bucket[i[0]]), docs[own].tobytes(), rows[own].tobytes(), planes(np.concatenate((word[new], word[gone])), 4), (key[i[new]] >> U64(32)).astype(np.uint32).tobytes(), planes(tie[i[new]], 7), side[i[new]].tobytes(), planes(np.concatenate((pos[i[new]], pos[i[gone]])).astype(np.uint32), 4), np.uint32(new.sum()).tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), PACKED_TYPES.types, strict=True)], schema=PACKED_TYPES)


def earliest_first(key: np.ndarray, tie: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (key, tie, doc), and which places of it hold a later document than the
    first of their (key, tie)."""
    order = np.lexsort((doc, tie, key))
    k, t, d = key[order], tie[order], doc[order]
    cut = np.concatenate(([True], (k[1:] != k[:-1]) | (t[1:] != t[:-1]))) if len(k) else np.zeros(0, bool)
    first = d[np.flatnonzero(cut)][np.cumsum(cut) - 1] if len(k) else d
    return order, d > first


NOTES = "doc_id long, row long, whole binary, part binary"
NOTES_TYPES = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("whole", pa.binary()), ("part", pa.binary())])


def notes(doc: np.ndarray, row: np.ndarray, pos: np.ndarray, kind: np.ndarray) -> pa.RecordBatch:
    """One row for each document: positions of kind 0 (``whole``) and 1 (``part``)."""
    if not len(doc):
        return pa.RecordBatch.from_pylist([], schema=NOTES_TYPES)
    order = np.lexsort((pos, kind, row, doc))
    doc, row, pos, kind = doc[order], row[order], pos[order].astype(np.uint32), kind[order]
    cut = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (row[1:] != row[:-1]))))
    stop = np.append(cut[1:], len(doc)).astype(np.int64)
    split = [a + int(np.searchsorted(kind[a:b], 1)) for a, b in zip(cut, stop, strict=True)]
    whole = [pos[a:m].tobytes() for a, m in zip(cut, split, strict=True)]
    part = [pos[m:b].tobytes() for m, b in zip(split, stop, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(doc[cut]), pa.array(row[cut]), pa.array(whole, pa.binary()), pa.array(part, pa.binary())], schema=NOTES_TYPES)


def sorted_buckets(packed: DataFrame, with_parts: bool) -> DataFrame:
    """Sorts one bucket at a time. A later document's sample with the context of an
    earlier one's is a ``whole`` repeat. With parts: samples whose bucket neighbours (the
    same gram, another context) agree on one side may be repeats in part."""

    def sort(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for r in batch.to_pylist():
                if held and held[0]["bucket"] != r["bucket"]:
                    yield bucket(held)
                    held = []
                held.append(r)
        if held:
            yield bucket(held)

    def bucket(rows: list[dict]) -> pa.RecordBatch:
        docs, ids, pos, key, tie, side, olddoc, oldrow, oldpos = ([] for _ in range(9))
        for r in rows:
            n = int(np.frombuffer(r["old"], np.uint32)[0])
            who, p = from_planes(r["who"], 4, np.uint32), from_planes(r["pos"], 4, np.uint32)
            d, i = np.frombuffer(r["docs"], np.int64)[who], np.frombuffer(r["rows"], np.int64)[who]
            for to, x in ((docs, d[:n]), (ids, i[:n]), (pos, p[:n]), (olddoc, d[n:]), (oldrow, i[n:]), (oldpos, p[n:])):
                to.append(x)
            key.append(np.frombuffer(r["key"], np.uint32))
            tie.append(from_planes(r["tie"], 7, U64))
            side.append(np.frombuffer(r["side"], np.uint32))
        doc, row, at, k, t, s = map(np.concatenate, (docs, ids, [p.astype(np.int64) for p in pos], key, tie, side))
        order, later = earliest_first(k, t, doc)
        kind = np.where(later, 0, 2)
        if with_parts:
            places, sides = edges(k[order], doc[order], s[order], later)
            kind[places] = 1
            at[order[places]] = at[order[places]] << 2 | sides
        use = kind < 2
        o = order[use]
        return notes(
            np.concatenate([doc[o], *olddoc]), np.concatenate([row[o], *oldrow]), np.concatenate([at[o], *oldpos]), np.concatenate([kind[use], np.zeros(sum(map(len, oldpos)), kind.dtype)])
        )

    def edges(k: np.ndarray, doc: np.ndarray, side: np.ndarray, later: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places, none of them whole repeats, that share gram and a side with a sample of
        another document, and which: 1 the left, 2 the right, 3 both."""
        new = np.flatnonzero(~later)
        hit = np.zeros(len(new), np.int64)
        for bit, half in ((1, side[new] >> np.uint32(16)), (2, side[new] & np.uint32(0xFFFF))):
            g = k[new].astype(U64) << U64(16) | half
            o = np.lexsort((doc[new], g))
            cut = runs(g[o])
            many = doc[new][o[cut[:-1]]] != doc[new][o[cut[1:] - 1]] if len(new) else np.zeros(0, bool)
            hit[o] |= bit * np.repeat(many, np.diff(cut))
        return new[hit > 0], hit[hit > 0]

    return packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(sort, NOTES)


RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
STEP = f"doc_id long, row long, starts binary, {RESULT}, kind int, {PACKED}"


def removed(raw: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Bytes covered by strings of ``length`` that begin where ``starts`` is true."""
    edge = np.zeros(len(raw) + 1, np.int32)
    at = np.flatnonzero(starts)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + length, -1)
    return np.cumsum(edge[:-1]) > 0


def digest(raw: np.ndarray, gone: np.ndarray) -> tuple[int, int, int, str]:
    spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (len(gone) > 0 and gone[0]))
    return len(raw), int(gone.sum()), spans, hashlib.sha256(raw[~gone].tobytes()).hexdigest()


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode(), np.uint8)


def remove_repeats(docs: DataFrame, cfg: SubstringConfig = SubstringConfig(), with_text: bool = False) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, ``n_bytes``, ``n_removed``,
    ``n_spans``, ``kept_sha256``.

    A byte goes if a string of ``cfg.length`` bytes covers it that also starts in a
    document with a smaller doc_id. Null texts are empty; texts shorter than the length
    stay whole. Rows that share a doc_id never make each other's bytes go; rows without
    doc_id neither lose bytes nor count. Strings are compared by fingerprints of 94 or
    more bits. Repeated rows give a row each; an empty table gives none.
    """
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("row", F.xxhash64("text"))
    size = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // cfg.bucket_bytes))

    def sample(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        packer = Packer(buckets, cfg.flush)
        for batch in batches:
            for doc, text, row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "row")), strict=True):
                raw = _bytes(text)
                if doc is None or len(raw) < cfg.length:
                    continue
                s = samples(raw, cfg)
                yield from packer.add(doc, row, s.hash, *contexts(s, cfg, len(raw)), s.at)
        yield from packer.out()

    told = sorted_buckets(chosen.mapInArrow(sample, PACKED), True)
    told = told.groupBy("doc_id", "row").agg(F.collect_list("whole").alias("whole"), F.collect_list("part").alias("part"))
    told = written(told)

    def step(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        packer = Packer(buckets, cfg.flush)
        for batch in batches:
            rows: list[dict] = []
            for r in batch.to_pylist():
                raw = np.frombuffer(zstandard.decompress(r["zip"]), np.uint8)
                starts = np.zeros(max(0, len(raw) - cfg.length + 1), bool)
                whole, part = (np.frombuffer(b"".join(r[c] or []), np.uint32) for c in ("whole", "part"))
                maybe = np.zeros(0, np.int64)
                if len(whole) or len(part):
                    s = samples(raw, cfg)
                    mark = np.zeros(len(starts) + 1, np.int32)
                    i = np.searchsorted(s.at, np.unique(whole))
                    np.add.at(mark, s.low[i], 1)
                    np.add.at(mark, s.high[i] + 1, -1)
                    starts = np.cumsum(mark[:-1]) > 0
                    part = np.unique(part)
                    i, side = np.searchsorted(s.at, part >> 2), part & 3
                    more = (cfg.length - cfg.gram) // 2
                    first = np.where(side & 1, s.low[i], np.maximum(s.low[i], s.at[i] + cfg.gram + more - cfg.length))
                    last = np.where(side & 2, s.high[i], np.minimum(s.high[i], s.at[i] - more))
                    maybe = np.concatenate([np.zeros(0, np.int64), *(np.arange(a, b + 1) for a, b in zip(first, last, strict=True))])
                    if cfg.cover == "position":
                        maybe = np.unique(maybe)
                    if len(maybe):
                        key, tie = s.prints.of(maybe, maybe + cfg.length), Prints(raw, 1).of(maybe, maybe + cfg.length)
                        for out in packer.add(r["doc_id"], r["row"], key, tie, np.zeros(len(maybe), np.uint32), maybe):
                            yield _packed_step(out)
                base = {"doc_id": r["doc_id"], "row": r["row"]}
                if len(maybe):
                    rows.append(base | {"starts": zstandard.compress(np.packbits(starts).tobytes()), "kind": 1})
                else:
                    n, gone, spans, sha = digest(raw, removed(raw, starts, cfg.length))
                    rows.append(base | {"n_bytes": n, "n_removed": gone, "n_spans": spans, "kept_sha256": sha, "kind": 0})
            yield pa.RecordBatch.from_pylist(rows, schema=STEP_TYPES)
        for out in packer.out():
            yield _packed_step(out)

    def squeeze(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            zipped = [zstandard.compress(t.encode()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), pa.array(zipped, pa.binary())], ["doc_id", "row", "zip"])

    squeezed = chosen.mapInArrow(squeeze, "doc_id long, row long, zip binary")
    stepped = written(squeezed.join(told, ["doc_id", "row"], "left").mapInArrow(step, STEP))
    final = stepped.where("kind = 0").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    again = sorted_buckets(stepped.where("kind = 2").select(*PACKED_TYPES.names), False)
    again = again.groupBy("doc_id", "row").agg(F.collect_list("whole").alias("whole"))
    pending = stepped.where("kind = 1").select("doc_id", "row", "starts").dropDuplicates(["doc_id", "row"]).join(again, ["doc_id", "row"], "left")
    pending = squeezed.join(pending, ["doc_id", "row"]).select("doc_id", "row", "zip", "starts", "whole")

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                raw = np.frombuffer(zstandard.decompress(r["zip"]), np.uint8)
                starts = np.unpackbits(np.frombuffer(zstandard.decompress(r["starts"]), np.uint8), count=len(raw) - cfg.length + 1).astype(bool)
                starts[np.frombuffer(b"".join(r["whole"] or []), np.uint32)] = True
                rows.append((r["doc_id"], *digest(raw, removed(raw, starts, cfg.length))))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(),) * 4 + (pa.string(),), strict=False)] if rows else [pa.array([], t) for t in (pa.int64(),) * 4 + (pa.string(),)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return final.unionByName(pending.mapInArrow(finish, f"doc_id long, {RESULT}"))


STEP_TYPES = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("starts", pa.binary()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kind", pa.int32()), *PACKED_TYPES])


def _packed_step(batch: pa.RecordBatch) -> pa.RecordBatch:
    n = len(batch)
    fill = [pa.nulls(n, f.type) for f in STEP_TYPES][: len(STEP_TYPES) - len(PACKED_TYPES) - 1]
    return pa.RecordBatch.from_arrays([*fill, pa.array(np.full(n, 2, np.int32)), *batch.columns], schema=STEP_TYPES)
