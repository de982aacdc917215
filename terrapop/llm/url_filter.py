"""Operator 10: URL rules by a bit-parallel wildcard automaton.

All glob patterns are packed side by side into the bits of a few 64-bit words, one bit
for each "this many symbols consumed" state. One Shift-And step per URL byte moves every
pattern of every URL of the batch at once.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, given_names, plain, renamed, schema_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A host (with all its subdomains) and a path prefix that are allowed or blocked."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


#: The rules of the query.
RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)
#: Globs that block a URL which no rule fits. ``*`` stays within one
#: segment, ``**`` crosses slashes, ``?`` is one byte other than a slash.
BLOCK_GLOBS = ("**/wp-login.php**", "**/cgi-bin/**", "**/adserver/**", "*.onion/**")

ANY, SEGMENT, ONE = "any", "segment", "one"


def parse_glob(glob: str) -> list[int | str]:
    """Symbols of a glob: byte values, and ``ANY``, ``SEGMENT`` or ``ONE`` wildcards."""
    out: list[int | str] = []
    i, raw = 0, glob.encode()
    while i < len(raw):
        if raw[i : i + 2] == b"**":
            out.append(ANY)
            i += 2
            continue
        out.append({ord("*"): SEGMENT, ord("?"): ONE}.get(raw[i], raw[i]))
        i += 1
    return out


def rule_symbols(rule: Rule) -> list[int | str]:
    """``*.host/path**`` over ``.host/path``: the leading dot makes the host itself and
    each of its subdomains look alike."""
    return [SEGMENT, *f".{rule.host}{rule.path}".encode(), ANY]


class ShiftAnd:
    """Multiword Shift-And masks for patterns that must match a whole string."""

    def __init__(self, patterns: Sequence[list[int | str]]):
        widths = [1 + sum(s not in (ANY, SEGMENT) for s in p) for p in patterns]
        total = sum(widths)
        self.words = max(1, -(-total // 64))
        eat = np.zeros((256, self.words * 64), dtype=bool)
        stay = np.zeros_like(eat)
        first = np.zeros(self.words * 64, dtype=bool)
        self.accept = np.zeros(len(patterns), dtype=np.int64)
        no_slash = np.arange(256) != ord("/")
        at = 0
        for k, (pattern, width) in enumerate(zip(patterns, widths, strict=True)):
            first[at] = True
            state = at
            for s in pattern:
                if s == ANY:
                    stay[:, state] = True
                elif s == SEGMENT:
                    stay[no_slash, state] = True
                else:
                    state += 1
                    eat[no_slash if s == ONE else s, state] = True
            self.accept[k] = state
            at += width
        self.eat, self.stay, self.first = self._pack(eat), self._pack(stay), self._pack(first[None])[0]

    def _pack(self, bits: np.ndarray) -> np.ndarray:
        weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
        return (bits.reshape(len(bits), self.words, 64) * weights).sum(axis=2, dtype=np.uint64)

    def match(self, texts: Sequence[bytes], block: int = 4096) -> np.ndarray:
        """A row for each text and a column for each pattern: whether it matches."""
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        order = np.argsort(-lengths, kind="stable")
        out = np.zeros((len(texts), len(self.accept)), dtype=bool)
        word, bit = self.accept // 64, (self.accept % 64).astype(np.uint64)
        for lo in range(0, len(order), block):
            rows = order[lo : lo + block]
            lens = lengths[rows]
            joined = np.frombuffer(b"".join(texts[i] for i in rows), dtype=np.uint8)
            starts = np.concatenate(([0], np.cumsum(lens)[:-1]))
            state = np.tile(self.first, (len(rows), 1))
            live = len(rows)
            for t in range(int(lens[0]) if len(lens) else 0):
                live = int(np.searchsorted(-lens[:live], -t, side="left"))
                c = joined[starts[:live] + t]
                d = state[:live]
                moved = d << np.uint64(1)
                if self.words > 1:
                    moved[:, 1:] |= d[:, :-1] >> np.uint64(63)
                state[:live] = (moved & self.eat[c]) | (d & self.stay[c])
            out[rows] = (state[:, word] >> bit) & np.uint64(1)
        return out


def with_host_path(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``: host after the first ``://`` up to ``/``, ``?``, ``#``
    or the end, A-Z lower-cased; then path up to ``?``, ``#`` or the end. Null, or no
    ``://``: both empty."""
    u = F.coalesce(F.col(url), F.lit(""))
    rest = F.when(F.instr(u, "://") > 0, F.expr(f"substring(coalesce(`{url}`, ''), instr(coalesce(`{url}`, ''), '://') + 3)")).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, "^([^/?#]*)", 1)
    return df.withColumn("host", F.translate(raw, UPPER, LOWER)).withColumn("path", F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    block_globs: Sequence[str] = BLOCK_GLOBS,
    keep: Sequence[str] = ("page_id",),
    url: str = "url",
) -> DataFrame:
    """Verdict for every URL.

    Returns ``keep`` columns, ``host``, ``path``, ``rule`` (the longest fitting rule, else
    null) and ``verdict``: the rule's, else ``block`` if one of ``block_globs`` matches
    ``.host/path``, else ``allow``. Only the URL column is read. A null or malformed URL
    has empty host and path, so that nothing fits: ``allow``. Rules of equal length: the
    earlier listed wins. Repeated rows are each judged; an empty table gives no rows.
    """
    ranked = sorted(rules, key=lambda r: -len(r.name))
    automaton = ShiftAnd([*map(rule_symbols, ranked), *map(parse_glob, block_globs)])
    names = np.array([*(r.name for r in ranked), None], dtype=object)
    verdicts = np.array([*(r.verdict for r in ranked), "allow"], dtype=object)
    n = len(ranked)

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            hit = automaton.match([f".{h}{p}".encode() for h, p in zip(hosts, paths, strict=True)])
            fits = np.column_stack([hit[:, :n], np.ones(len(hit), dtype=bool)])
            which = fits.argmax(axis=1)
            verdict = verdicts[which].copy()
            verdict[(which == n) & hit[:, n:].any(axis=1)] = "block"
            added = {"rule": pa.array(names[which], pa.string()), "verdict": pa.array(verdict, pa.string())}
            yield pa.RecordBatch.from_arrays([*batch.columns, *added.values()], [*batch.schema.names, *added])

    parsed = with_host_path(renamed(pages, keep, column(url).alias("url"))).select(*plain(keep), "host", "path")
    return given_names(parsed.mapInArrow(judge, schema_of(parsed, tuple(parsed.columns), "rule string, verdict string")), keep)
