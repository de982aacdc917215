"""Spelling variants against plain loops."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrapop.llm import spelling as sp


def variants(w):
    return {w[:i] + w[i + 1 :] for i in range(len(w))}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return abs(len(a) - len(b)) == 1 and (a in variants(b) or b in variants(a))


def plain(words, ratio=2):
    """word: (n, n_near, form, form_n, root) of a dict of counts."""
    near = {w: [x for x in words if abs(len(x) - len(w)) < 2 and one_edit(w, x)] for w in words}
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (n, len(near[w]), form[w], words[form[w]] if form[w] else None, root(w)) for w, n in words.items()}


def found(spark, words, config=None):
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in sp.spelling_variants(df, config).collect()}


def random_words(rng, many, letters, lo=1, hi=8):
    return {"".join(rng.choice(letters) for _ in range(rng.randint(lo, hi))): rng.choice([1, 2, 3, 4, 8, 9, 20, 50]) for _ in range(many)}


@pytest.mark.parametrize("config", [sp.SpellingConfig(), sp.SpellingConfig(leaf_words=20, bucket=3, sample_words=150), sp.SpellingConfig(leaf_words=7, bucket=1, sample_words=40, leaf_bytes=40)])
def test_random_words(spark, config):
    rng = random.Random(11)
    words = random_words(rng, 500, "abcé") | random_words(rng, 200, "abcdefghÿ×", 5, 12)
    assert found(spark, words, config) == plain(words)


def test_anagrams_in_blocks(spark):
    """A class of equal counts, which no cut divides, is dealt in blocks; nothing is lost."""
    rng = random.Random(3)
    words = {"".join(rng.sample("aabbccddee", 10)): rng.randint(1, 9) for _ in range(300)}
    words |= {w[:3] + "x" + w[4:]: 30 for w in list(words)[:60]} | {w[:5] + "q" + w[5:]: 2 for w in list(words)[:60]}
    assert found(spark, words, sp.SpellingConfig(leaf_words=10, bucket=4)) == plain(words)


def test_long_words_and_hub(spark):
    long = "ab" * 30_000
    words = {long: 10, long + "c": 3, long[:-1] + "c": 4, "é" * 700: 3, "é" * 701: 6}
    words |= {"hubword"[:i] + c + "hubword"[i + 1 :]: 3 for i in range(7) for c in "xyzåæç"} | {"hubword": 9}
    assert found(spark, words) == plain(words)


def test_no_words(spark):
    assert found(spark, {}) == {}
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sp.op11_spelling(docs).count() == 0


def test_tree_finds_every_box():
    rng = np.random.default_rng(5)
    points = rng.integers(97, 103, (800, 6), dtype=np.uint8)
    tree = sp.Tree(points, 9)
    assert sorted(np.concatenate(tree.leaves)) == list(range(800))
    for shift in (-1, 0, 1):
        queries = rng.integers(97, 103, (200, 6 - shift), dtype=np.uint8)
        got = {(int(a), int(b)) for q, p in sp.search_leaf(points, tree, queries, cells=3000) for a, b in zip(q, p, strict=True)}
        text = lambda x: x.tobytes().decode("latin-1")
        assert got == {(i, j) for i, q in enumerate(queries) for j, p in enumerate(points) if one_edit(text(q), text(p))}


EDGE = [None, "", "  ", "?!", "Übung ÜBUNG übung naïve NAÏVE naive", "word " * 4000, "same words here same words here", "same words here same words here", "a" * 5000 + " x", "don't stop-motion_x9y łódź", "line\nliner\r\nlines"]


def test_documents(spark):
    """Nulls, empty, long and repeated texts, documents without id, clashing columns."""
    import re

    rng = random.Random(2)
    texts = EDGE + [" ".join(rng.choice(["letter", "letters", "lettre", "Better", "bitter", "bitten", "kitten", "mitten"]) for _ in range(200)) for _ in range(60)]
    rows = [(None if k in (3, 7) else k, t, "clash", 1) for k, t in enumerate(texts)] * 2
    total = Counter()
    for doc, text, *_ in rows:
        for w in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), w)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            total[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 97 == 0 else w] += 1
    words = {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}
    df = spark.createDataFrame(rows, "doc_id long, text string, word string, n int")
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in sp.op11_spelling(df).collect()}
    assert got == plain(words) and any(v[2] for v in got.values())


def test_counts_handed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(sp, "COUNTED", 3)
    docs = spark.createDataFrame([(k, "first second third fourth first") for k in range(7)], "doc_id long, text string")
    got = {r.word: r.n for r in sp.count_words(docs, sp.SpellingConfig(noise=0)).collect()}
    assert got == {"first": 14, "second": 7, "third": 7, "fourth": 7}


def test_chains(spark):
    n = 40
    forms = spark.createDataFrame([(f"w{k:02d}", f"w{k + 1:02d}") for k in range(n)] + [("a", "w39"), ("b", "c")], "word string, form string")
    got = {r.word: r.root for r in sp.roots(forms).collect()}
    assert got == {f"w{k:02d}": "w40" for k in range(n)} | {"a": "w40", "b": "c"}
    assert defaultdict(int, got) and sp.roots(forms.where(F.lit(False))).count() == 0
