"""Operator 13: a trie of conversations by recursion on half depths (van Emde Boas).

Conversations are sequences of turns, one row a turn. A block of turns is cut at half depth:
the prefixes that end at the cut have names, and a turn below the cut is named by the cut's
name and its own name among the turns below. The upper trie and all lower forests are named
in the same step, and halves of 1, 2, 4, ... turns double until they fill a block; blocks are
then turns of a shorter sequence, named by the same recursion. Names are 128-bit digests, so
that equal prefixes of any conversations meet. Totals go the other way: from the smallest
halves on, what lies below a cut is grafted onto every turn above it.

A node is owned by its smallest member, and the nodes that a conversation owns are the lower
part of its path. So the total of a node's subtree is the sum, over its members, of what they
own from that depth on: one row for each turn, whatever the depth, and sums by name that are
combined before the shuffle. No conversation and no node is ever held whole.

Rows without ``conv_id`` belong to no conversation. Turns come by ``turn``, null first, equal
ones by role and text; repeated rows are turns of their own. Null role or text is empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import release, written

#: Turns of a block; characters of joined ids that travel as one piece.
BLOCK, PIECE = 256, 65_536
WORD = r"[^\x20\x09-\x0D]+"


def digest(*parts: Column) -> Column:
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def _long(x: int | None) -> Column:
    return F.lit(x).cast("long")


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), symbol (digest of role and text) and tokens (words of the text)
    of every turn. A range sort cuts the turns anywhere, within a conversation too; the
    places before a cut are added from a table of a row for each conversation and part."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    ranged = turns.withColumn("start", F.substring("role", 1, 64)).repartitionByRange("conv_id", "turn", "start").sortWithinPartitions("conv_id", "turn", "role", "text")
    symbol = digest(F.length("role").cast("string").cast("binary"), F.lit(":").cast("binary"), F.col("role").cast("binary"), F.col("text").cast("binary"))
    rows = written(ranged.select("conv_id", F.monotonically_increasing_id().alias("at"), symbol.alias("symbol"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("tokens")))
    part = F.shiftright("at", 33).alias("part")
    parts = rows.groupBy("conv_id", part).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = parts.select("conv_id", "part", (before - F.col("first") + 1).alias("shift"))
    return rows.withColumn("part", part).join(offsets, ["conv_id", "part"]).select("conv_id", (F.col("at") + F.col("shift")).alias("pos"), "symbol", "tokens")


def with_shared_heads(turns: DataFrame, every: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Each conversation c rebuilt: the first h turns of conversation c - c % ``every``, then
    its own after the first h, h = crc32(decimal c) % ``heads``. Returns its turns (conv_id,
    depth, symbol, tokens) and all conversations (conv_id, n), turnless ones too."""
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string").cast("binary")) % heads).alias("h")
    sizes = written(turns.groupBy("conv_id").agg(F.count("*").alias("own")))
    base = sizes.select(c.alias("base"), F.least("own", F.lit(heads - 1)).alias("base_n"))
    convs = written(sizes.select("conv_id", "own", (c - c % every).alias("base"), h).join(base, "base", "left").withColumn("head", F.least("h", F.coalesce("base_n", F.lit(0)))))
    first = turns.where((c % every == 0) & (F.col("pos") < heads)).withColumnRenamed("conv_id", "base")
    head = convs.where("head > 0").select("conv_id", "base", "h").join(first, "base").where("pos <= h").select("conv_id", F.col("pos").alias("depth"), "symbol", "tokens")
    tail = turns.join(convs.select("conv_id", "h", "head"), "conv_id").where("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("head")).alias("depth"), "symbol", "tokens")
    release(sizes)
    return head.unionByName(tail), convs.select("conv_id", (F.col("head") + F.greatest(F.lit(0), F.col("own") - F.col("h"))).alias("n"))


def _in_blocks(rows: DataFrame, block: int) -> DataFrame:
    at = F.col("depth") - 1
    return rows.withColumns({"block": F.floor(at / block), "off": at % block}).repartition("conv_id", "block")


def _halves(longest: int, block: int) -> Iterator[tuple[int, Window]]:
    """Half sizes from 1 on, each with the window over the two halves of a cut."""
    half = 1
    while half < min(longest, block):
        yield half, Window.partitionBy("conv_id", "block", F.floor(F.col("off") / (2 * half)))
        half *= 2


def prefix_names(rows: DataFrame, longest: int, block: int = BLOCK) -> DataFrame:
    """``rows`` (conv_id, depth, symbol, ...) with ``name`` in place of symbol: the digest of
    the whole sequence from depth 1. ``longest`` is the greatest depth."""
    named = _in_blocks(rows.withColumnRenamed("symbol", "name"), block)
    for half, over in _halves(longest, block):
        place = F.col("off") % (2 * half)
        cut = F.max(F.when(place == half - 1, F.col("name"))).over(over)
        named = named.withColumn("cut", cut).withColumn("name", F.when(place >= half, digest(F.col("cut"), F.col("name"))).otherwise(F.col("name"))).drop("cut")
    if longest <= block:
        return named.drop("block", "off")
    named = written(named)
    ends = named.where(F.col("off") == block - 1).select("conv_id", (F.col("block") + 1).alias("depth"), F.col("name").alias("symbol"))
    above = prefix_names(ends, -(-longest // block), block).select("conv_id", F.col("depth").alias("block"), F.col("name").alias("cut"))
    return named.join(above, ["conv_id", "block"], "left").withColumn("name", F.when(F.col("cut").isNull(), F.col("name")).otherwise(digest(F.col("cut"), F.col("name")))).drop("cut", "block", "off")


def suffix_totals(rows: DataFrame, values: tuple[str, ...], longest: int, block: int = BLOCK) -> DataFrame:
    """``rows`` (conv_id, depth, ``values``, ...) with each value summed from its depth to the
    end of the conversation: what lies below a cut is added above it."""
    summed = _in_blocks(rows, block)
    for half, over in _halves(longest, block):
        place = F.col("off") % (2 * half)
        below = {f"below_{c}": F.max(F.when(place == half, F.col(c))).over(over) for c in values}
        summed = summed.withColumns(below).withColumns({c: F.when(place < half, F.col(c) + F.coalesce(f"below_{c}", F.lit(0))).otherwise(F.col(c)) for c in values}).drop(*below)
    if longest <= block:
        return summed.drop("block", "off")
    summed = written(summed)
    tops = summed.where("off = 0").select("conv_id", (F.col("block") + 1).alias("depth"), *values)
    below = suffix_totals(tops, values, -(-longest // block), block).select("conv_id", (F.col("depth") - 2).alias("block"), *[F.col(c).alias(f"below_{c}") for c in values])
    return summed.join(below, ["conv_id", "block"], "left").withColumns({c: F.col(c) + F.coalesce(f"below_{c}", F.lit(0)) for c in values}).drop("block", "off", *[f"below_{c}" for c in values])


def joined_digests(members: DataFrame) -> DataFrame:
    """depth, name and ``ends_sha256`` of the members' (depth, name, conv_id) decimal ids,
    ascending and joined by commas. A digest has one order: a range sort cuts the ids of a
    node anywhere, each part joins its own to pieces, and pieces stream through the hash."""

    def joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, ids, size = None, None, [], 0

        def piece() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.binary()), pa.array([first], pa.int64()), pa.array([",".join(ids)])], ["depth", "name", "first", "piece"])

        for batch in batches:
            for depth, name, conv in zip(*(batch.column(c).to_pylist() for c in ("depth", "name", "conv_id")), strict=True):
                if ids and ((depth, name) != key or size > PIECE):
                    yield piece()
                    ids, size = [], 0
                if not ids:
                    key, first = (depth, name), conv
                ids.append(str(conv))
                size += len(ids[-1]) + 1
        if ids:
            yield piece()

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("depth", "name", "piece")), strict=True))
        out: list[tuple[int, bytes, str]] = []
        for (depth, name), some in groupby(rows, key=lambda r: r[:2]):
            sha, comma = hashlib.sha256(), b""
            for r in some:
                sha.update(comma + r[2].encode())
                comma = b","
            out.append((depth, name, sha.hexdigest()))
            if len(out) == 10_000:
                yield _rows(out)
                out = []
        if out:
            yield _rows(out)

    def _rows(out: list[tuple[int, bytes, str]]) -> pa.RecordBatch:
        depth, name, sha = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(depth, pa.int64()), pa.array(name, pa.binary()), pa.array(sha)], ["depth", "name", "ends_sha256"])

    order = ("depth", "name", "conv_id")
    pieces = members.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(joined, "depth long, name binary, first long, piece string")
    return pieces.repartition("depth", "name").sortWithinPartitions("depth", "name", "first").mapInArrow(hashed, "depth long, name binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv_id, depth, symbol, tokens) and the root.

    ``convs`` (conv_id, n) has every conversation with its number of turns. Columns: name
    (32 hex digits; of the root: null), conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256. No conversations: no rows.
    """
    longest, n_convs, top = convs.agg(F.coalesce(F.max("n"), F.lit(0)), F.count("*"), F.min("conv_id")).first()
    paths = written(prefix_names(turns, longest, block))
    tops = written(paths.groupBy("depth", "name").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("tokens").alias("tokens")))
    over = paths.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
    linked = written(tops.join(over, ["conv_id", "depth"], "left"))
    children = linked.where("depth > 1").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    above = tops.select((F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nodes = written(linked.join(children, ["depth", "name"], "left").na.fill(0, ["n_children"]).join(above, ["depth", "parent"], "left").drop("parent"))
    owned = nodes.select("conv_id", "depth", ((F.col("n_convs") - 1) * F.col("tokens")).alias("saved_tokens"), (F.col("n_children") == 0).cast("long").alias("n_leaves"))
    values = ("saved_tokens", "n_leaves")
    weighed = paths.select("conv_id", "depth", "name").join(owned, ["conv_id", "depth"], "left").na.fill(0, list(values))
    totals = suffix_totals(weighed, values, longest, block).groupBy("depth", "name").agg(*[F.sum(c).alias(c) for c in values])
    last = convs.where("n > 0").select("conv_id", F.col("n").alias("depth")).join(paths.select("conv_id", "depth", "name"), ["conv_id", "depth"])
    at_root = convs.where("n = 0").select("conv_id", _long(0).alias("depth"), F.lit(b"").alias("name"))
    ends = written(joined_digests(written(last.unionByName(at_root))))
    full = written(nodes.join(totals, ["depth", "name"]))
    first = full.where("depth = 1").agg(F.count("*").alias("n_children"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in values])
    leaves = F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).cast("long")
    no_name, columns = F.lit(b""), ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    root = first.select(no_name.alias("name"), _long(top).alias("conv_id"), _long(0).alias("depth"), _long(None).alias("parent_conv_id"), _long(n_convs).alias("n_convs"), "n_children", leaves.alias("n_leaves"), "saved_tokens").where("n_convs > 0")
    below = full.withColumn("parent_conv_id", F.when(F.col("depth") == 1, _long(top)).otherwise(F.col("parent_conv_id"))).select("name", *columns)
    every = below.unionByName(root).join(ends, ["depth", "name"], "left")
    return every.select(F.nullif(F.lower(F.hex("name")), F.lit("")).alias("name"), *columns, F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def op13_prefix_trie(conversations: DataFrame) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    turns = written(ordered_turns(conversations))
    return prefix_trie(*with_shared_heads(turns)).drop("name")
