"""Extra columns of any name, and texts of some megabytes, in all operators and stages."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from terrapop.llm import ann, brown_lm, decontam, language_id, line_dedup, packing, simhash, substrings, toxicity, url_filter

ODD = ("my col", "a.b", "a-b", "`tick", "_text", "_gone", "_row", "_label", "_features", "lines_removed", "words", "row", "n", "h", "fp", "node", "root", "learn", "gone_lines", "item_id", "toxicity", "keep_0", "key", "seq")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def with_odd(df):
    odd = [F.lit(f"of {c}").alias(c) for c in ODD]
    return df.select(*df.columns, *odd)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(40)
    texts = [" ".join(f"w{rng.randrange(300)}" for _ in range(60)) + (" vileword you vileword" if i % 4 == 0 else "") for i in range(120)] + [None, "", "x"]
    at = tmp_path_factory.mktemp("odd")
    spark.createDataFrame([(i, t, "en" if i % 2 else "de", "s", len(t or "")) for i, t in enumerate(texts)], DOCS).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(120)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(0, texts[5])], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at)


@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES])
def test_stages_keep_odd_columns(spark, tables, stage):
    docs = with_odd(spark.read.parquet(f"{tables}/documents.parquet"))
    out = dict(corpus_pipeline.STAGES)[stage](spark, docs, tables)
    rows = out.collect()
    assert rows
    if stage != "packing":
        assert out.columns == docs.columns
        assert all(tuple(r)[5:] == tuple(f"of {c}" for c in ODD) for r in rows)
        plain = dict(corpus_pipeline.STAGES)[stage](spark, spark.read.parquet(f"{tables}/documents.parquet"), tables)
        assert sorted((r.doc_id, r.text or "") for r in plain.collect()) == sorted((r.doc_id, r.text or "") for r in rows)


def test_operators_take_odd_columns(spark, tables):
    docs = with_odd(spark.read.parquet(f"{tables}/documents.parquet"))
    labels, bench = (spark.read.parquet(f"{tables}/{n}.parquet") for n in ("labels", "benchmark"))
    n = docs.count()
    assert toxicity.op1_toxicity(docs, labels).count() == n
    assert brown_lm.op2_brown_lm(docs).count() == n
    assert substrings.remove_repeats(docs).count() == n
    found = decontam.find_contained(docs, bench, keep=("doc_id", "a.b", "`tick")).collect()
    assert [(r[0], r[1], r[2]) for r in found] == [(5, "of a.b", "of `tick")]
    pieces = packing.pack_documents(docs, packing.PackConfig(public_tokenizers.path("word_bpe_49k.json")), keep=("doc_id", "my col", "a.b"))
    assert {r[1] for r in pieces.collect()} == {"of my col"}
    assert language_id.op7_language_id(docs).count() == n
    assert line_dedup.op8_line_dedup(docs).count() == n
    assert simhash.op9_simhash(docs).count() == n
    vectors = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(30)], "vec_id long, embedding array<float>")
    assert ann.op6_ann(with_odd(vectors)).count() == 40
    pages = spark.createDataFrame([(1, "http://example.com/en/")], "page_id long, url string")
    assert url_filter.judge_urls(with_odd(pages)).first().verdict == "block"


def test_texts_of_megabytes(spark):
    rng = random.Random(41)
    lines = [" ".join(f"w{rng.randrange(4000)}" for _ in range(12)) for _ in range(20_000)]
    long = "\n".join(lines + lines)
    assert len(long) > 2_000_000
    df = spark.createDataFrame([(1, long), (2, long), (3, "short text of a few words")], "doc_id long, text string").withColumn("lang", F.lit("en"))
    out = {r.doc_id: r for r in line_dedup.op8_line_dedup(df).collect()}
    # a line may also lie within a word of another one by chance
    assert 20_000 <= out[1].lines_removed <= 20_100 and out[2].lines_removed == 40_000
    gone = {r.doc_id: r for r in substrings.remove_repeats(df).collect()}
    assert gone[1].n_removed == 0 and gone[2].n_removed == gone[2].n_bytes
    near = simhash.drop_near_duplicates(df)
    assert sorted(r.doc_id for r in near.collect()) == [1, 3]
    scored = {r.doc_id: r for r in brown_lm.op2_brown_lm(df).collect()}
    assert scored[1].n_tokens == 480_001 and scored[1].score == scored[2].score
    item = spark.createDataFrame([(9, lines[7000])], "item_id long, text string")
    assert sorted(r.doc_id for r in decontam.find_contained(df, item).collect()) == [1, 2]
    assert {r.lang_pred for r in language_id.op7_language_id(df).collect()} <= {"en", "und"}
