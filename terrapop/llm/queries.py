"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .ann import op6_ann
from .brown_lm import op2_brown_lm
from .byte_bpe import CoderConfig, op12_byte_bpe
from .common import table
from .decontam import find_contained
from .language_id import op7_language_id
from .line_dedup import op8_line_dedup
from .packing import PackConfig, pack_documents
from .prefix_trie import op13_prefix_trie
from .simhash import op9_simhash
from .spelling import op11_spelling
from .substrings import remove_repeats
from .toxicity import op1_toxicity
from .url_filter import judge_urls

Query = Callable[[SparkSession, str], DataFrame]


def q10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def q7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_language_id(table(spark, sf_dir, "documents"))


def q5(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), PackConfig(public_tokenizers.path("word_bpe_49k.json")))


def q9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_simhash(table(spark, sf_dir, "documents"))


def q1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def q2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_brown_lm(table(spark, sf_dir, "documents"))


def q6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_ann(table(spark, sf_dir, "embeddings"))


def q4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("estimate")


def q8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_line_dedup(table(spark, sf_dir, "documents"))


def q3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def q12(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return op12_byte_bpe(table(spark, sf_dir, "documents"), CoderConfig(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN))


def q13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_prefix_trie(table(spark, sf_dir, "conversations"))


def q11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_spelling(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_toxicity": q1,
    "op2_brown_lm": q2,
    "op3_suffix_dedup": q3,
    "op4_decontam": q4,
    "op5_packing": q5,
    "op6_ann": q6,
    "op7_language_id": q7,
    "op8_line_dedup": q8,
    "op9_simhash": q9,
    "op10_url_filter": q10,
    "op11_spelling": q11,
    "op12_byte_bpe": q12,
    "op13_prefix_trie": q13,
}

URL_SQL = r"""
WITH p AS (SELECT page_id, CASE WHEN position('://' IN coalesce(url, '')) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
 h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
 r AS (SELECT *, concat('.', host, path) AS u, CASE
   WHEN ends_with(concat('.', host), '.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
   WHEN ends_with(concat('.', host), '.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
   WHEN ends_with(concat('.', host), '.net') AND starts_with(path, '/es/') THEN 'net/es/'
   WHEN ends_with(concat('.', host), '.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
   WHEN ends_with(concat('.', host), '.com') AND starts_with(path, '/') THEN 'com/' END AS rule FROM h)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN u LIKE '%/wp-login.php%' OR u LIKE '%/cgi-bin/%' OR u LIKE '%/adserver/%' OR regexp_matches(u, '^[^/]*\.onion/') THEN 'block' ELSE 'allow' END AS verdict FROM r"""

#: Every byte as two hex digits; starts of strings (by a 64-bit hash) that an earlier document
#: holds; bytes within 49 places after such a start are gone.
SUBSTRING_SQL = """
WITH n AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(length(hex(encode(coalesce(text, '')))) / 2 AS BIGINT) AS n FROM documents),
 c AS (SELECT doc_id, n, c, substr(h, 2 * c + 1, 2 * 549) AS h FROM (SELECT *, unnest(range(0, n, 500)) AS c FROM n)),
 g AS (SELECT doc_id, i, hash(substr(h, 2 * (i - c) + 1, 100)) AS g FROM (SELECT *, unnest(range(c, greatest(c, least(c + 500, n - 49)))) AS i FROM c)),
 r AS (SELECT doc_id, i FROM g JOIN (SELECT g, min(doc_id) AS f FROM g GROUP BY g HAVING count(*) > 1) e USING (g) WHERE f < doc_id),
 b AS (SELECT k.doc_id, k, x, count(r.i) OVER (PARTITION BY k.doc_id ORDER BY k ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) > 0 AS gone
   FROM (SELECT doc_id, k, substr(h, 2 * (k - c) + 1, 2) AS x FROM (SELECT *, unnest(range(c, least(c + 500, n))) AS k FROM c WHERE doc_id IN (SELECT doc_id FROM r))) k LEFT JOIN r ON r.doc_id = k.doc_id AND r.i = k),
 s AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE gone AND NOT was) AS n_spans, string_agg(x, '' ORDER BY k) FILTER (WHERE NOT gone) AS kept
   FROM (SELECT *, coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY k), false) AS was FROM b) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(CASE WHEN s.doc_id IS NULL THEN h ELSE coalesce(kept, '') END)) AS kept_sha256 FROM n LEFT JOIN s USING (doc_id)"""

#: Runs of words of documents and items as text, met by equality.
CONTAINED_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM documents WHERE text IS NOT NULL),
 b AS (SELECT item_id, text, w, len(w) AS words, least(len(w), 5) AS width FROM (SELECT DISTINCT item_id, text, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL) WHERE len(w) > 0),
 s AS (SELECT DISTINCT item_id, text, words, width, array_to_string(w[i:i + width - 1], ' ') AS s FROM (SELECT *, unnest(range(1, words - width + 2)) AS i FROM b)),
 r AS (SELECT DISTINCT doc_id, width, array_to_string(w[i:i + width - 1], ' ') AS s FROM (SELECT doc_id, w, width, unnest(range(1, CAST(len(w) AS BIGINT) - width + 2)) AS i FROM d, (SELECT DISTINCT width FROM b))),
 m AS (SELECT doc_id, item_id, text, words, count(*) AS found FROM s JOIN r USING (width, s) GROUP BY ALL)
SELECT doc_id, item_id, words AS item_words, n AS item_shingles, found, found / n AS containment FROM m JOIN (SELECT item_id, text, count(*) AS n FROM s GROUP BY ALL) t USING (item_id, text) WHERE found >= 0.8 * n - 1e-9"""

#: Lines without one word each, met by equality and place.
LINES_SQL = """
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, unnest(range(0, len(string_split(text, chr(10))))) AS p FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
 f AS (SELECT trim(raw, ' ') AS line, min(struct_pack(d := doc_id, p := p)) AS place FROM l WHERE trim(raw, ' ') <> '' GROUP BY 1),
 w AS (SELECT line, place, string_split(line, ' ') AS w, len(string_split(line, ' ')) AS n FROM f),
 v AS (SELECT line, place, n, i, array_to_string(list_concat(w[1:i - 1], w[i + 1:n]), ' ') AS s FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM w WHERE n >= 5)),
 near AS (SELECT a.line FROM v a JOIN (SELECT s, i, n, min(place) AS place FROM v GROUP BY s, i, n) b ON a.s = b.s AND a.i = b.i AND a.n = b.n AND b.place < a.place
   UNION SELECT v.line FROM v JOIN w ON v.s = w.line AND v.n = w.n + 1 AND w.place < v.place UNION SELECT w.line FROM v JOIN w ON v.s = w.line AND v.n = w.n + 1 AND v.place < w.place),
 k AS (SELECT doc_id, p, raw, f.line IS NOT NULL AND (struct_pack(d := doc_id, p := p) > f.place OR near.line IS NOT NULL) AS gone FROM l LEFT JOIN f ON f.line = trim(raw, ' ') LEFT JOIN near ON near.line = f.line),
 t AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS lines_removed, coalesce(string_agg(raw, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '') AS text FROM k GROUP BY doc_id)
SELECT d.doc_id, coalesce(lines_removed, 0) AS lines_removed, CASE WHEN d.text IS NOT NULL THEN length(t.text) END AS n_chars, sha256(coalesce(t.text, '')) AS text_sha256 FROM documents d LEFT JOIN t USING (doc_id)"""

#: crc32 of text over a table of 256 steps; ``{bytes}`` is its list of bytes.
CRC_TABLE = "(SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM (SELECT unnest(range(0, 256)) AS i))"
CRC = "xor(list_reduce(list_concat([4294967295], {bytes}), lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1])), 4294967295)"

#: A prefix is the digests of its turns in a row; subtrees by the prefixes of each node's first member.
TRIE_SQL = rf"""
WITH o AS (SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p FROM conversations WHERE conv_id IS NOT NULL),
 c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {CRC.format(bytes="list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM o), {CRC_TABLE}),
 m AS (SELECT c.conv_id, 0 AS part, p, r, x FROM c JOIN o ON o.conv_id = c.base AND p <= h UNION ALL SELECT conv_id, 1, p, r, x FROM c JOIN o USING (conv_id) WHERE p > h),
 d AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, p) AS d, sha256(r) || sha256(x) AS s, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS t FROM m),
 k AS (SELECT conv_id, d, t, string_agg(s, '') OVER (PARTITION BY conv_id ORDER BY d) AS k FROM d UNION ALL SELECT conv_id, 0, 0, '' FROM c),
 n AS (SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(t) AS t FROM k GROUP BY d, k),
 g AS (SELECT n.*, u.k AS up FROM n LEFT JOIN k u ON u.conv_id = n.conv_id AND u.d = n.d - 1),
 f AS (SELECT g.*, p.conv_id AS parent_conv_id, coalesce(q.n, 0) AS n_children FROM g LEFT JOIN n p ON p.d = g.d - 1 AND p.k = g.up LEFT JOIN (SELECT d - 1 AS d, up AS k, count(*) AS n FROM g WHERE d > 0 GROUP BY ALL) q ON q.d = g.d AND q.k = g.k),
 s AS (SELECT k.d, k.k, count(*) FILTER (WHERE n_children = 0) AS n_leaves, CAST(sum((n_convs - 1) * f.t) AS BIGINT) AS saved_tokens FROM f JOIN k ON k.conv_id = f.conv_id AND k.d <= f.d GROUP BY k.d, k.k),
 e AS (SELECT d, k, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ends FROM k WHERE (conv_id, d) IN (SELECT (conv_id, max(d)) FROM k GROUP BY conv_id) GROUP BY d, k)
SELECT f.conv_id, f.d AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256 FROM f JOIN s USING (d, k) LEFT JOIN e USING (d, k)"""

UTF8 = "flatten(list_transform(string_split(doc || ':' || w, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END))"

#: Words of one edit have a string in common once a letter is left out of either or both.
SPELLING_SQL = rf"""
WITH RECURSIVE r AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
 h AS (SELECT w, k, {CRC.format(bytes=UTF8)} AS h FROM (SELECT doc, w, count(*) AS k FROM r GROUP BY doc, w), {CRC_TABLE}),
 v AS (SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, CAST(h % length(w) AS BIGINT)) || substr(w, CAST(h % length(w) AS BIGINT) + 2) ELSE w END AS word, CAST(sum(k) AS BIGINT) AS n FROM h GROUP BY 1),
 u AS MATERIALIZED (SELECT word, n FROM v WHERE length(word) >= 5 AND n >= 3),
 x AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS s FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM u)),
 p AS (SELECT a.word, b.word AS near, b.n AS near_n FROM x a JOIN x b ON a.s = b.s AND a.i = b.i AND a.word <> b.word UNION SELECT x.word, u.word, u.n FROM x JOIN u ON x.s = u.word UNION SELECT u.word, x.word, x.n FROM x JOIN u ON x.s = u.word),
 b AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS form, max(near_n) AS form_n FROM p GROUP BY word),
 f AS MATERIALIZED (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * n THEN form END AS form, CASE WHEN form_n >= 2 * n THEN form_n END AS form_n FROM u LEFT JOIN b USING (word)),
 c AS (SELECT word, word AS at FROM f UNION ALL SELECT c.word, f.form FROM c JOIN f ON f.word = c.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n FROM f JOIN c USING (word) JOIN f e ON e.word = c.at WHERE e.form IS NULL"""

ORACLE_SQL: dict[str, str] = {"op3_suffix_dedup": SUBSTRING_SQL, "op4_decontam": CONTAINED_SQL, "op8_line_dedup": LINES_SQL, "op10_url_filter": URL_SQL, "op11_spelling": SPELLING_SQL, "op13_prefix_trie": TRIE_SQL}
