"""The near_dedup stage against brute-force Jaccard similarity of five-word shingles."""

import random

import corpus_pipeline
from terrapop.llm import simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n):
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def slow_sets(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def slow_roots(texts):
    sets = [slow_sets(t) for t in texts]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            if sets[a] == sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) > 0:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return [find(i) for i in range(len(sets))]


def some_texts():
    rng = random.Random(21)
    passage = words(rng, 40)
    texts = []
    for n in (6, 9, 14, 30, 60, 120, 400, 1500):
        for _ in range(4):
            base = words(rng, n) + passage * (n == 60)
            for changes in (0, 0, 1, 2, max(1, n // 60), n // 45, n // 35, n // 25, n // 10):
                w = list(base)
                for _ in range(changes):
                    w[rng.randrange(len(w))] = f"c{rng.randrange(10**6)}"
                texts.append(" ".join(w[: len(w) - rng.randrange(2)]))
    texts += [" ".join(words(rng, 50) + passage) for _ in range(60)]
    near = words(rng, 130)
    texts += [" ".join([*near[:k], "x" + str(k), *near[k + 1 :]]) for k in range(100)]
    rng.shuffle(texts)
    return texts + [None, "", "  ", "one", "ONE", "a b", "a b c d e", "a b c d e f", "word " * 3000, "word " * 20, "École ÉCOLE"]


def test_near_dedup_stage_against_brute_force(spark):
    texts = some_texts()
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOCS)
    want = slow_roots(texts)
    got = {r.doc_id: r.component_id for r in simhash.similar_components(df).collect()}
    assert got == dict(enumerate(want))
    more = df.union(df.limit(3)).union(spark.createDataFrame([(None, texts[0], "en", "s", 1)], DOCS))
    kept = corpus_pipeline.near_dedup(spark, more, "")
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(set(want))
    assert kept.where("doc_id is null").count() == 1 and kept.columns == df.columns
    assert corpus_pipeline.near_dedup(spark, df.limit(0), "").count() == 0


def test_similar_below_the_bound_stays(spark):
    rng = random.Random(22)
    base = words(rng, 104)  # 100 shingles; k changes far apart leave 100 - 5 k
    texts = [" ".join(base)] + [" ".join(f"c{i}" if i in range(10, 10 + 10 * k, 10) else w for i, w in enumerate(base)) for k in (2, 3)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], DOCS)
    assert [round(len(slow_sets(texts[0]) & slow_sets(t)) / len(slow_sets(texts[0]) | slow_sets(t)), 2) for t in texts[1:]] == [0.82, 0.74]
    # the last shares 85 of 100 with the second (25 of 30 changes in common), so the chain holds it
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, df, "").collect()) == [0]
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, df.where("doc_id <> 1"), "").collect()) == [0, 2]


def test_large_clusters_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 7)
    texts = some_texts()
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: r.component_id for r in simhash.similar_components(df).collect()}
    assert got == dict(enumerate(slow_roots(texts)))


def test_repeated_ids_of_unlike_texts(spark):
    """Rows of one doc_id with unlike texts: unique ones stay, copies of earlier ones go."""
    rng = random.Random(31)
    t, u, v = (" ".join(words(rng, 60)) for _ in range(3))
    near = u.rsplit(" ", 1)[0] + " end"

    def kept(rows):
        df = spark.createDataFrame([(i, x, "en", "s", 1) for i, x in rows], DOCS)
        return sorted((r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, df, "").collect())

    assert kept([(2, t), (5, t), (5, u)]) == sorted([(2, t), (5, u)])
    assert kept([(5, u), (5, v)]) == sorted([(5, u), (5, v)])
    assert kept([(5, u), (5, u), (5, v), (6, v), (6, t)]) == sorted([(5, u), (5, v), (6, t)])
    assert len(kept([(5, u), (5, near)])) == 1 and len(kept([(5, None), (5, ""), (7, t)])) == 2
    assert kept([(4, v), (5, u), (5, near), (3, near)]) == sorted([(3, near), (4, v)])


def test_repeated_ids_keep_all_columns(spark):
    df = spark.createDataFrame([(5, "a b c d e f", 1), (5, "g h i j k l", 2), (6, "g h i j k l", 3)], "doc_id long, text string, shingle_set int")
    got = simhash.drop_near_duplicates(df)
    assert got.columns == df.columns and sorted(map(tuple, got.collect())) == [(5, "a b c d e f", 1), (5, "g h i j k l", 2)]
