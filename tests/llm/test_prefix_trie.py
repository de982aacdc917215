"""The trie of conversations against plain loops."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from terrapop.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, depth int, name string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 9, "clash") for r in rows], SCHEMA)


def rebuilt(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    turns = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, v in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = turns.get(c - c % 20, [])[:h] + v[h:]
    return out


def plain(rows):
    convs = rebuilt(rows)
    members = defaultdict(list)
    for c, v in convs.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    kids = defaultdict(list)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    words = lambda k: len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) or 1
        saved[k] = (len(members[k]) - 1) * words(k) + sum(saved[x] for x in kids[k])
    ends = lambda k: hashlib.sha256(",".join(map(str, sorted(c for c in members[k] if len(convs[c]) == len(k)))).encode()).hexdigest()
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else -1, len(m), len(kids[k]), leaves[k], saved[k], ends(k)) for k, m in members.items())


def found(nodes):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in nodes.collect())


def random_rows(rng, convs, most, symbols):
    rows = []
    for c in convs:
        for t in range(rng.randint(0, most)):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "assistant", None]), rng.choice(symbols)))
    return rows


def test_random_conversations(spark):
    rng = random.Random(13)
    symbols = ["a", "a b", "", None, "x y z", " \t\n", "a  b\x0bc"]
    rows = random_rows(rng, [c for c in range(70) if c != 40], 5, symbols)
    rows += [(None, 1, "user", "lost")] + rows[:5] + [(c, t, "user", f"turn {t}") for c in (100, 101, 121, 140, 141) for t in range(6)]
    assert found(pt.op13_prefix_trie(frame(spark, rows))) == plain(rows)


@pytest.mark.parametrize("block", [2, 4, 256])
def test_long_conversations(spark, block):
    """Blocks of a few turns, so that the recursion goes down several times."""
    rng = random.Random(block)
    shared = [(rng.choice("ur"), rng.choice(["a", "b c"])) for _ in range(37)]
    rows = [(c, t, *x) for c, n in ((20, 37), (21, 33), (22, 37), (23, 12), (25, 1), (47, 37)) for t, x in enumerate(shared[:n] + [("z", str(c % 2))] * (c % 3))]
    turns = pt.written(pt.ordered_turns(frame(spark, rows)))
    assert found(pt.prefix_trie(*pt.with_shared_heads(turns), block=block)) == plain(rows)


def test_empty_and_turnless(spark):
    assert pt.op13_prefix_trie(frame(spark, []).limit(0)).count() == 0
    assert pt.op13_prefix_trie(frame(spark, [(None, 0, "a", "b")])).count() == 0
    c = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 4 and c % 20)
    assert found(pt.op13_prefix_trie(frame(spark, [(c, 0, None, None)]))) == [(c, 0, -1, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_pieces_of_a_large_node(spark, monkeypatch):
    """Many ids of one node, cut into pieces and parts, stream through one digest."""
    monkeypatch.setattr(pt, "PIECE", 50)
    ids = random.Random(1).sample(range(10**6), 5000)
    members = spark.createDataFrame([(3, b"n", c) for c in ids] + [(1, b"n", 7)], "depth long, name binary, conv_id long").repartition(5)
    got = {(r.depth, bytes(r.name)): r.ends_sha256 for r in pt.joined_digests(members).collect()}
    assert got == {(3, b"n"): hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest(), (1, b"n"): hashlib.sha256(b"7").hexdigest()}


def test_names_tell_turns_apart(spark):
    rows = [(1, 0, "a:", "b"), (2, 0, "a", ":b"), (3, 0, "", "a:b")]
    assert pt.ordered_turns(frame(spark, rows)).select("symbol").distinct().count() == 3
    assert pt.ordered_turns(frame(spark, rows)).agg(F.max("pos")).first()[0] == 1
