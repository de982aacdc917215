"""Operator 12: byte-level BPE encoding and decoding by longest matches and backtracking.

The bytes of a piece of text are mapped to Latin-1, one character a byte, and one pass of an
Aho-Corasick automaton gives the longest token that starts at each place. From left to right
the longest one is taken that may stand beside the token before it; where none may, the place
is marked dead and the token before it gives way to its longest proper prefix. A sequence of
tokens is what the merges make if and only if each two neighbours are, and a place is marked
dead once at most, so the work is linear in the bytes. Whether two tokens may be neighbours
is told by undoing their merges, latest first, and remembered.

A text is cut by the pattern of the vocabulary first; a piece that is a token itself is that
token. Null texts are empty; texts without a token have an empty list of ids.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, given_names, plain, renamed, schema_of

#: Texts of more characters are cut a part at a time; characters of a batch of results.
LONG, SLICE = 1_000_000, 4_000_000


@dataclass(frozen=True)
class CoderConfig:
    """``ranks`` is the path of a file of lines "base64 rank"; ``pattern`` cuts texts into
    pieces. ``cached_bytes`` bounds the pieces that a worker remembers, ``cached_pairs`` the
    neighbours."""

    ranks: str
    pattern: str
    cached_bytes: int = 64_000_000
    cached_pairs: int = 1_000_000


class ByteCoder:
    """Encoder and decoder of one vocabulary. Ranks are the ids and the order of merges: the
    bytes come first, and no token before those that it is merged from (else ValueError)."""

    def __init__(self, config: CoderConfig):
        import regex

        self.config = config
        with open(config.ranks, "rb") as f:
            rank = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        singles = [i for b, i in rank.items() if len(b) == 1]
        self.base = max(singles, default=-1) + 1
        if len(singles) != 256 or self.base != 256:
            raise ValueError("the ranks 0 to 255 must be the bytes")
        self.rank = rank
        self.token = {i: b for b, i in rank.items()}
        self.find = regex.compile(config.pattern)
        self.first_newer, self.newer, self.find_newer = _newer_letters(config.pattern)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.known: dict[str, bytes] = {}
        self.held = 0
        self._learn_merges()
        self._build()

    def _learn_merges(self) -> None:
        """The two tokens that each token is merged from: the only two that make it up and
        may be neighbours while the merges before it are known. A token without such two
        is never merged, and only stands for a piece that equals it."""
        self.merged: dict[tuple[int, int], int] = {}
        self.left, self.right = {}, {}
        made = set(range(self.base))
        for i in sorted(self.token):
            b = self.token[i]
            for cut in range(1, len(b)):
                a, c = self.rank.get(b[:cut]), self.rank.get(b[cut:])
                if a in made and c in made and self._apart(a, c):
                    self.merged[a, c], self.left[i], self.right[i] = i, a, c
                    made.add(i)
                    break
            if i not in made and self._merges_to(b) == [b]:
                raise ValueError(f"rank {i} comes before the ranks that it is merged from")

    def _merges_to(self, b: bytes) -> list[bytes]:
        """What plain merging makes of the bytes, the lowest rank first."""
        parts = [b[k : k + 1] for k in range(len(b))]
        while len(parts) > 1:
            rank, k = min((self.rank.get(parts[k] + parts[k + 1], 1 << 62), k) for k in range(len(parts) - 1))
            if rank not in self.token:
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def _apart(self, a: int, b: int) -> bool:
        """Whether merges keep the tokens apart. The token of the later merge is undone, and
        what then stood at the border must not have merged before that. Of equal ranks the
        left one is merged first."""
        limit = 1 << 62
        while True:
            if (m := self.merged.get((a, b))) is not None and m < limit:
                return False
            if max(a, b) < self.base:
                return True
            if a > b:
                limit, a = a, self.right[a]
            else:
                limit, b = b + 1, self.left[b]

    def _build(self) -> None:
        import ahocorasick

        usable = {b: i for b, i in self.rank.items() if i < self.base or i in self.left}
        self.automaton = ahocorasick.Automaton()
        for b, i in usable.items():
            self.automaton.add_word(b.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.size = {i: len(b) for b, i in usable.items()}
        self.shorter = {i: next((usable[b[:k]] for k in range(len(b) - 1, 0, -1) if b[:k] in usable), -1) for b, i in usable.items()}

    def neighbours(self, a: int, b: int) -> bool:
        found = self.pairs.get((a, b))
        if found is None:
            if len(self.pairs) >= self.config.cached_pairs:
                self.pairs.clear()
            found = self.pairs[a, b] = self._apart(a, b)
        return found

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        if (whole := self.rank.get(piece)) is not None:
            return [whole]
        n, size, shorter = len(piece), self.size, self.shorter
        longest = [-1] * n
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            longest[end - size[token] + 1] = token  # a longer one of that start ends later
        dead, at, ids = bytearray(n + 1), 0, []
        token = longest[0] if n else -1
        while at < n:
            while token >= 0 and (dead[at + size[token]] or ids and not self.neighbours(ids[-1], token)):
                token = shorter[token]
            if token >= 0:
                ids.append(token)
                at += size[token]
                token = longest[at] if at < n else -1
            else:
                dead[at] = 1
                token = ids.pop()
                at -= size[token]
        return ids

    def _has_newer(self, text: str) -> bool:
        """Most texts are told by their highest code point; the rest are searched."""
        if self.newer is None or not text or text.isascii():
            return False
        return np.frombuffer(text.encode("utf-32-le"), np.uint32).max() >= self.first_newer and self.newer.search(text) is not None

    def _parts(self, text: str) -> Iterator[list[str]]:
        find = self.find_newer if self._has_newer(text) else self.find
        if len(text) <= LONG:
            yield find.findall(text)
            return
        matches = (m.group() for m in find.finditer(text))
        while part := list(islice(matches, LONG // 4)):
            yield part

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text, as 32-bit integers."""
        out = []
        for pieces in self._parts(text or ""):
            for p in set(pieces).difference(self.known):
                ids = np.array(self.encode_piece(p.encode()), np.int32).tobytes()
                self.known[p] = ids
                self.held += 150 + len(p) + len(ids)
            out.append(b"".join(map(self.known.__getitem__, pieces)))
            if self.held > self.config.cached_bytes:
                self.known.clear()
                self.held = 0
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


def _ranges(points: list[int]) -> str:
    """Ascending code points as the inside of a character class."""
    first = [c for c, before in zip(points, [-1, *points], strict=False) if c != before + 1]
    last = [c for c, after in zip(points, [*points[1:], -1], strict=True) if c != after - 1]
    return "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in zip(first, last, strict=True))


def _newer_letters(pattern: str):  # noqa: ANN202
    """What finds letters and numbers that the Unicode tables here have and the tokenizer's
    library doesn't yet, and the pattern without them; None if there are none; the first is the least of them. A
    vocabulary of bytes and pairs (last byte of a character, letter or digit) shows
    whether that library keeps the two in a piece."""
    import unicodedata

    import regex
    import tiktoken

    pairs = [bytes([0x80 + k, mate]) for k in range(64) for mate in b"a1"]
    probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks={bytes([b]): b for b in range(256)} | {p: 256 + k for k, p in enumerate(pairs)}, special_tokens={})
    young = "".join(chr(c) for c in range(0x80, 0x40000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) == "Cn")
    new = [[c for c in regex.findall(kind, young) if len(probe.encode_ordinary(c + mate)) > len(c.encode())] for kind, mate in ((r"\p{L}", "a"), (r"\p{N}", "1"))]
    if not any(new):
        return 0, None, None
    letters, numbers = (_ranges([*map(ord, some)]) or "\\U0010FFFF" for some in new)
    cut = pattern.replace(r"\p{L}", rf"[\p{{L}}--[{letters}]]").replace(r"\p{N}", rf"[\p{{N}}--[{numbers}]]")
    return min(map(ord, new[0] + new[1])), re.compile("[" + letters + numbers + "]"), regex.compile("(?V1)" + cut)


_CODERS: dict[CoderConfig, ByteCoder] = {}


def coder(config: CoderConfig) -> ByteCoder:
    """One coder for each Python worker, as workers serve many tasks."""
    if config not in _CODERS:
        _CODERS[config] = ByteCoder(config)
    return _CODERS[config]


def _slices(batch: pa.RecordBatch, sizes: list[int]) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``SLICE`` units of size each, a row at least."""
    start, total = 0, 0
    for k, n in enumerate(sizes):
        if total and total + n > SLICE:
            yield batch.slice(start, k - start)
            start, total = k, 0
        total += n
    if start < len(sizes):
        yield batch.slice(start)


def encode_documents(docs: DataFrame, config: CoderConfig, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns ``keep`` and ``ids`` (array of int): the tokens of each whole text. A row
    for each row, repeated ones too; a null or empty text has none. The file of ranks is
    read by the workers."""
    kept = plain(keep)

    def encoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = coder(config).encode
        for whole in batches:
            for batch in _slices(whole, [len(t or "") for t in whole.column("text").to_pylist()]):
                ids = [encode(t) for t in batch.column("text").to_pylist()]
                ends = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32)))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), lists], [*kept, "ids"])

    chosen = renamed(docs, keep, column(text).cast("string").alias("text"))
    return given_names(chosen.mapInArrow(encoded, schema_of(chosen, kept, "ids array<int>")), keep)


def decode_documents(encoded: DataFrame, config: CoderConfig, keep: tuple[str, ...] = ("doc_id",), ids: str = "ids") -> DataFrame:
    """The columns ``keep`` and ``decoded`` (binary): the bytes of each list of ids. Null is
    an empty list; an id that isn't in the vocabulary is an error."""
    kept = plain(keep)

    def decoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = coder(config).decode
        for whole in batches:
            sizes = np.diff(whole.column("ids").offsets.to_numpy()).tolist() if whole.num_rows else []
            for batch in _slices(whole, sizes):
                lists = batch.column("ids")
                values, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
                texts = [decode(values[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(texts, pa.binary())], [*kept, "decoded"])

    chosen = renamed(encoded, keep, F.coalesce(column(ids).cast("array<int>"), F.array().cast("array<int>")).alias("ids"))
    return given_names(chosen.mapInArrow(decoded, schema_of(chosen, kept, "decoded binary")), keep)


def op12_byte_bpe(docs: DataFrame, config: CoderConfig) -> DataFrame:
    """Digests of the ids of each whole text and of what they decode to."""
    encoded = encode_documents(docs, config)
    both = decode_documents(encoded, config, keep=("doc_id", "ids"))
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
