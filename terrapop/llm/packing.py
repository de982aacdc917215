"""Operator 5: packing token sequences by Karmarkar-Karp multiway differencing.

Documents are tokenised and cut into pieces. Whole-window pieces are windows of their own;
the pieces of the remainders are dealt into blocks, and each block is divided into
near-equal windows by differencing. The window count of a block rises until none exceeds
the capacity.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import given_names, plain, renamed, schema_of, written


@dataclass(frozen=True)
class PackConfig:
    """``tokenizer`` is the path of a tokenizer file; ``end_id`` closes each document.

    ``cut`` is the longest piece of a remainder; ``block_windows`` the windows that one
    task balances at a time.
    """

    tokenizer: str
    end_id: int = 1
    capacity: int = 2048
    cut: int = 512
    block_windows: int = 512
    cached_words: int = 1_000_000


class WordEncoder:
    """Ids of texts, word by word, for tokenizers that never join across ASCII white space.

    Texts are split and their words numbered as Arrow arrays, so that only different words
    of a group of texts are looked up. A word of plain Latin letters between punctuation is
    that punctuation and its run of letters, whatever the case of A-Z; runs are remembered,
    up to ``limit`` of them, then all are forgotten. Other words are remembered as they are,
    up to as many. New runs are encoded many at a time: each ends in exactly one id that
    closes a word.
    """

    MARKS = r"""[-.,!?;:*#%$&@"()\[\]{}/\\|+=~^_`]*"""  # no apostrophe, which takes letters with it
    FORM = f"^(?P<before>{MARKS})(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<after>{MARKS})$"
    GROUP_BYTES = 1 << 23

    def __init__(self, path: str, limit: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        most = max(vocabulary.values())
        self.kind = np.uint16 if most <= 0xFFFF else np.uint32
        self.closes = np.zeros(most + 1, dtype=bool)
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.limit = limit
        self.known: dict[bytes, bytes] = {}
        self.pieces: dict[bytes, bytes] = {}
        self.marks: dict[bytes, bytes] = {}

    def _ids(self, text: bytes) -> bytes:
        (found,) = self.tokenizer.encode_batch_fast([text.decode()], add_special_tokens=False)  # no places in the text
        return np.array(found.ids, dtype=self.kind).tobytes()

    def _ids_of_each(self, texts: list[bytes]) -> list[bytes]:
        return [self._ids(t) for t in texts]

    def _ids_of_runs(self, runs: list[bytes]) -> list[bytes]:
        size, found = np.dtype(self.kind).itemsize, []
        for lo in range(0, len(runs), 500):
            some = runs[lo : lo + 500]
            all_ids = self._ids(b" ".join(some))
            ends = np.flatnonzero(self.closes[np.frombuffer(all_ids, self.kind)]) + 1
            if len(ends) == len(some) and ends[-1] * size == len(all_ids):
                at = [0, *(ends * size).tolist()]
                found += [all_ids[a:b] for a, b in zip(at, at[1:], strict=False)]
            else:
                found += self._ids_of_each(some)
        return found

    def _remembered(self, memory: dict[bytes, bytes], texts: pa.Array, learn: Callable[[list[bytes]], list[bytes]]) -> pa.Array:
        """Ids of each of ``texts``, as bytes: from ``memory``, or learned and kept there."""
        numbered = texts.dictionary_encode()
        unlike = numbered.dictionary.cast(pa.large_binary()).to_pylist()
        new = [t for t in unlike if t not in memory]
        if len(memory) + len(new) > self.limit:
            memory.clear()
            new = unlike
        memory.update(zip(new, learn(new), strict=True))
        return pa.array(map(memory.__getitem__, unlike), pa.large_binary(), size=len(unlike)).take(numbered.indices)

    def _ids_of_words(self, words: pa.Array) -> pa.Array:
        """Ids of each of ``words``, which are all different, as bytes."""
        parts = pc.extract_regex(words, self.FORM)
        shaped = parts.is_valid()
        before, letters, after = parts.filter(shaped).flatten()
        joined = pc.binary_join_element_wise(
            self._remembered(self.marks, before, self._ids_of_each),
            self._remembered(self.pieces, pc.ascii_lower(letters), self._ids_of_runs),  # the tokenizer lowers the rest
            self._remembered(self.marks, after, self._ids_of_each),
            pa.scalar(b"", pa.large_binary()),
        )
        others = self._remembered(self.known, words.filter(pc.invert(shaped)), self._ids_of_each)
        first = shaped.to_numpy(zero_copy_only=False)
        place = np.where(first, np.cumsum(first) - 1, len(joined) + np.cumsum(~first) - 1)
        return pa.concat_arrays([joined, others]).take(pa.array(place))

    def _groups(self, texts: pa.Array, group: int) -> Iterator[pa.Array]:
        """At most ``group`` texts at a time, of ``GROUP_BYTES`` unless one is longer."""
        ends = np.cumsum(pc.binary_length(texts).to_numpy())
        lo = 0
        while lo < len(texts):
            done = ends[lo - 1] if lo else 0
            hi = max(lo + 1, min(lo + group, int(np.searchsorted(ends, done + self.GROUP_BYTES, side="right"))))
            yield texts.slice(lo, hi - lo)
            lo = hi

    def encode(self, texts: pa.Array | list[str], group: int = 1 << 14) -> Iterator[np.ndarray]:
        """Ids of each text (null: empty), as unsigned integers of 16 bits, or 32 for large vocabularies."""
        given = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        for some in self._groups(given.cast(pa.large_string()).fill_null(""), group):
            split = pc.ascii_split_whitespace(some)
            numbered = split.flatten().dictionary_encode()
            ids = self._ids_of_words(numbered.dictionary).take(numbered.indices)
            lengths = np.concatenate(([0], np.cumsum(pc.binary_length(ids).to_numpy()))) // np.dtype(self.kind).itemsize
            bounds = lengths[np.concatenate(([0], np.cumsum(pc.list_value_length(split).to_numpy())))]
            flat = np.frombuffer(ids.buffers()[2] or b"", dtype=self.kind, count=lengths[-1])
            for a, b in zip(bounds, bounds[1:], strict=False):
                yield flat[a:b]


_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


def encoder(path: str, limit: int) -> WordEncoder:
    """One encoder for each Python worker, as workers serve many tasks."""
    if (path, limit) not in _ENCODERS:
        _ENCODERS[path, limit] = WordEncoder(path, limit)
    return _ENCODERS[path, limit]


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Karmarkar-Karp multiway: item numbers of each of ``windows`` near-equal groups.

    A partial division is a descending list of (sum, items), zeros left out. The two with
    the largest differences merge, the largest groups of one with the smallest of the
    other. Ties go by item number, so that the result is fixed by the input.
    """
    heap: list[tuple[int, int, list[tuple[int, list[int]]]]] = [(-s, i, [(s, [i])]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    tick = len(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        over = len(a) + len(b) - windows
        if over <= 0:
            merged = a + b
        else:
            joined = [(x[0] + y[0], x[1] + y[1]) for x, y in zip(a[len(a) - over :], reversed(b[len(b) - over :]), strict=True)]
            merged = a[: len(a) - over] + joined + b[: len(b) - over]
        merged.sort(key=lambda x: -x[0])
        low = merged[-1][0] if len(merged) == windows else 0
        if low:
            merged = [(s - low, items) for s, items in merged]
        heapq.heappush(heap, (-merged[0][0], tick, merged))
        tick += 1
    return [items for _, items in heap[0][2]] if heap else []


def divide(sizes: list[int], capacity: int) -> list[list[int]]:
    """Groups of at most ``capacity``: the fewest windows first, more while one is over."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        groups = differencing(sizes, windows)
        if max((sum(sizes[i] for i in g) for g in groups), default=0) <= capacity:
            return groups
        windows += max(1, windows // 400)


PIECE = "start long, length long, ids_crc32 long, doc_tokens long, piece_key long"


def token_pieces(docs: DataFrame, cfg: PackConfig, keep: tuple[str, ...], with_ids: bool) -> DataFrame:
    """``keep`` columns (plain names) and pieces of each document: whole windows, then what remains cut at ``cfg.cut``."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        words = encoder(cfg.tokenizer, cfg.cached_words)
        key = TaskContext.get().partitionId() << 33
        for batch in batches:
            row, start, length, crc, total, ids = [], [], [], [], [], []
            for r, found in enumerate(words.encode(batch.column("text"))):
                own = np.append(found, found.dtype.type(cfg.end_id)).astype("<u4")
                whole = len(own) // cfg.capacity * cfg.capacity
                bounds = [*range(0, whole, cfg.capacity), *range(whole, len(own), cfg.cut), len(own)]
                for a, b in zip(bounds, bounds[1:], strict=False):
                    row.append(r)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(own[a:b].tobytes()))
                    total.append(len(own))
                    if with_ids:
                        ids.append(own[a:b].astype(np.int32))
            names = [*keep, "start", "length", "ids_crc32", "doc_tokens", "piece_key", *["ids"] * with_ids]
            kept = [batch.column(c).take(pa.array(row, pa.int64())) for c in keep]
            made = [pa.array(x, pa.int64()) for x in (start, length, crc, total, np.arange(key, key + len(row)))]
            key += len(row)
            yield pa.RecordBatch.from_arrays([*kept, *made, *[pa.array(ids, pa.list_(pa.int32()))] * with_ids], names)

    chosen = docs.select(*keep, "text")
    return chosen.mapInArrow(cut, schema_of(chosen, keep, PIECE + ", ids array<int>" * with_ids))


def pack_documents(docs: DataFrame, cfg: PackConfig, keep: tuple[str, ...] = ("doc_id",), with_ids: bool = False) -> DataFrame:
    """One row for each piece: ``keep`` columns, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset`` and, if asked for, ``ids``.

    A null or empty text is its end id alone. Whole texts are packed, however long; a
    piece never exceeds ``cfg.cut`` unless it fills a window. Repeated rows are packed
    once each. An empty table gives no rows. Blocks are dealt by a hash of the piece's
    own number, so no source or document is one task's load.
    """
    kept = plain(keep)
    pieces = written(token_pieces(renamed(docs, keep, "text"), cfg, kept, with_ids))
    rest = F.col("length") < cfg.capacity
    tokens = pieces.where(rest).agg(F.sum("length")).first()[0] or 0
    blocks = max(1, -(-tokens // (cfg.block_windows * cfg.capacity)))
    columns = [*kept, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids]

    def balance(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["length", "piece_key"], ascending=[False, True], ignore_index=True)
        groups = divide(block["length"].tolist(), cfg.capacity)
        sequence, offset = np.zeros(len(block), np.int64), np.zeros(len(block), np.int64)
        lengths = block["length"].to_numpy()
        for k, items in enumerate(groups):
            sequence[items] = (int(block["block"].iloc[0]) << 24) + k
            offset[items] = np.cumsum(lengths[items]) - lengths[items]
        return block.assign(sequence_id=sequence, offset=offset).drop(columns="block")

    dealt = pieces.where(rest).withColumn("block", F.pmod(F.xxhash64("piece_key"), F.lit(blocks)))
    balanced = dealt.groupBy("block").applyInPandas(balance, schema_of(pieces, tuple(pieces.columns), "sequence_id long, offset long"))
    whole = pieces.where(~rest).withColumn("sequence_id", F.lit(1 << 62) + F.col("piece_key")).withColumn("offset", F.lit(0).cast("long"))
    return given_names(balanced.select(*columns).unionByName(whole.select(*columns)), keep)
