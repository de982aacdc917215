"""Operator 8: line deduplication by a deletion-neighbourhood join, in native Spark only.

Lines are compared by words. Equal lines share a hash. The edit bound follows the length:
one word for each ``words_per_edit`` words of the longer line, one word in all. Lines
within one word of each other (one changed, left out or put in) share a deletion variant:
the line without its i-th word. Lines that can have such a partner at all agree on their
first or last half, which a count of half-line keys tells before any variant is made.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, fresh, release, written


@dataclass(frozen=True)
class LineConfig:
    """Two lines are near if they differ by at most one word in ``words_per_edit`` of the
    longer one (a similarity of 0.8 or more at 5), and by one word in all. ``filter_bits``
    is the size of the bit map that spares moving the texts of other lines."""

    words_per_edit: int = 5
    filter_bits: int = 1 << 23


def numbered_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, line): every line that isn't blank; line ends are newlines."""
    lines = docs.where("doc_id is not null and text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return lines.where(F.trim("line") != "")


def line_key(line: Column) -> Column:
    """128 bits that stand for a line, blanks at its ends left out."""
    return F.struct(F.xxhash64(F.trim(line)).alias("h1"), F.xxhash64(F.lit("second"), F.trim(line)).alias("h2"))


def words(line: Column) -> Column:
    """Words of a line are what single blanks part."""
    return F.split(F.trim(line), " ")


def word_count(line: Column) -> Column:
    text = F.trim(line)
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1


def half_keys(line: Column, n: Column) -> Column:
    """Keys of a line's halves for its own word count and for one less, so that a line and
    the same line with one more word meet. Odd keys are of first halves."""
    text = F.trim(line)

    def of(s: Column) -> list[Column]:
        half = F.floor(s / 2).cast("int")
        first, last = F.call_function("substring_index", text, F.lit(" "), half), F.call_function("substring_index", text, F.lit(" "), half - s)
        return [F.xxhash64(s, first).bitwiseOR(1), F.xxhash64(s, last).bitwiseAND(-2)]

    return F.array(*of(n), *of(n - 1))


def without(w: Column, n: Column, i: Column) -> Column:
    return F.concat(F.slice(w, F.lit(1), i - 1), F.slice(w, i + 1, F.greatest(n - i, F.lit(0))))


def joined_bits(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x))


def place_key(w: Column) -> Column:
    """64 bits that stand for words at their places: their hashes joined bitwise."""
    return joined_bits(F.transform(w, lambda x, j: F.xxhash64(j, x)))


def variant_keys(w: Column, low: Column, high: Column) -> Column:
    """(i, v) for i from ``low`` to ``high``: ``place_key`` of the words without the i-th.

    Leaving a word out moves the later ones down by one place, so a key is that of all words
    moved down, joined with the moves undone before i. These are summed by blocks of about
    the root of their number: n words take n times that root of steps, not n squared.
    """
    block = F.ceil(F.sqrt(F.size(w))).cast("int")
    undone = F.transform(w, lambda x, j: F.xxhash64(j, x).bitwiseXOR(F.xxhash64(j - 1, x)))
    down = joined_bits(F.transform(w, lambda x, j: F.xxhash64(j - 1, x)))

    def keys(s: Column) -> Column:
        starts = F.transform(F.sequence(F.lit(0), F.floor((F.size(w) - 1) / block).cast("int")), lambda k: s["down"].bitwiseXOR(joined_bits(F.slice(s["undone"], F.lit(1), k * block))))

        def key(before: Column, i: Column) -> Column:
            k = F.floor((i - 1) / block).cast("int")
            own = joined_bits(F.slice(s["undone"], k * block + 1, F.pmod(i - 1, block)))
            return F.get(before, k).bitwiseXOR(own).bitwiseXOR(F.xxhash64(i - 2, F.get(w, i - 1)))

        # arrays of one value bind it to a name, so that it is made once a line
        return F.flatten(F.transform(F.array(starts), lambda before: F.transform(F.sequence(low, high), lambda i: F.struct(i.alias("i"), key(before, i).alias("v")))))

    return F.flatten(F.transform(F.array(F.struct(undone.alias("undone"), down.alias("down"))), keys))


def bit_filter(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """One row with a bit map of ``bits`` bits (a fixed size) that has a bit for each key."""
    at = F.pmod(F.col(key), F.lit(bits))
    word = F.shiftright(at, 6).cast("int")
    bit = F.expr(f"shiftleft(1L, cast(pmod(`{key}`, 64) as int))")
    held = keys.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("held"))
    every = keys.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("word")).join(held, "word", "left")
    ordered = F.sort_array(F.collect_list(F.struct("word", F.coalesce("held", F.lit(0).cast("long")).alias("held"))))
    return every.agg(F.transform(ordered, lambda x: x["held"]).alias("map"))


def removed_lines(docs: DataFrame, cfg: LineConfig = LineConfig()) -> DataFrame:
    """(doc_id, pos, h1) of the lines that an earlier line makes superfluous.

    Earlier is the smaller (doc_id, pos). A line goes if an earlier one is equal or lies
    within the edit bound of the longer of the two. Texts are moved only for lines that
    share a half with another.
    """
    seen = numbered_lines(docs).withColumns({"k": line_key(F.col("line")), "at": F.struct("doc_id", "pos")})
    counted = seen.withColumn("n", word_count(F.col("line")))
    # a line one word short of the bound can still meet a longer one
    halves_of = F.when(F.col("n") >= cfg.words_per_edit - 1, half_keys(F.col("line"), F.col("n")))
    first = written(counted.withColumn("halves", halves_of).groupBy("k.h1", "k.h2").agg(F.min("at").alias("first"), F.count("*").alias("copies"), F.any_value("halves").alias("halves")))

    halves = first.where("halves is not null").select(F.col("h1").alias("id"), F.explode("halves").alias("key"))
    shared = halves.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a <> b").select("key")
    left = F.col("key").bitwiseAND(1) == 1
    sides = halves.join(shared, "key", "left_semi").groupBy("id").agg(F.bool_or(left).alias("from_left"), F.bool_or(~left).alias("from_right"))
    sided = written(first.withColumn("id", F.col("h1")).join(sides, "id").select("id", "first.doc_id", "first.pos", "from_left", "from_right"))

    word = (F.shiftright(F.pmod("k.h1", F.lit(cfg.filter_bits)), 6) + 1).cast("int")
    hit = F.getbit(F.element_at(bit_filter(sided, "id", cfg.filter_bits).scalar(), word), F.pmod("k.h1", F.lit(64)).cast("int")) == 1
    maybe = seen.where(hit).select("doc_id", "pos", F.trim("line").alias("line"))
    able = written(maybe.join(sided, ["doc_id", "pos"]).select(F.struct("doc_id", "pos").alias("at"), words(F.col("line")).alias("w"), "from_left", "from_right"))

    release(sided)
    n = F.size("w")
    low = F.when(F.col("from_right"), F.lit(1)).otherwise(F.floor((n - 1) / 2).cast("int") + 1)
    high = F.when(F.col("from_left"), n).otherwise(F.floor(n / 2).cast("int") + 1)
    variants = able.select("at", F.explode(variant_keys(F.col("w"), low, high)).alias("d"))
    variants = written(variants.select("at", "d.i", "d.v"))

    # One word changed: equal variants at one place. The earliest of them is within one
    # word of all the others.
    changed = variants.groupBy("v", "i").agg(F.min("at").alias("ref"), F.count("*").alias("c")).where("c > 1").drop("c")
    pairs = variants.join(changed, ["v", "i"]).where("at > ref").select("at", "ref", "i")
    # One word more or less: a whole line equals a longer line's variant, or all variants of
    # a run of one word; a pair is checked once.
    longer = variants.join(able.select(place_key(F.col("w")).alias("v"), F.col("at").alias("short")), "v")
    after = longer.where("at > short").groupBy("at", F.col("short").alias("ref")).agg(F.min("i").alias("i"))
    before = longer.where("at < short").groupBy("short").agg(F.min(F.struct("at", "i")).alias("m")).select(F.col("short").alias("at"), F.col("m.at").alias("ref"), F.col("m.i").alias("i"))

    checked = pairs.unionByName(after).unionByName(before).join(able.select("at", F.col("w").alias("w1")), "at").join(able.select(F.col("at").alias("ref"), F.col("w").alias("w2")), "ref")
    n1, n2, w1, w2, i = F.size("w1"), F.size("w2"), F.col("w1"), F.col("w2"), F.col("i")
    within = (
        F.when(n1 == n2, without(w1, n1, i) == without(w2, n2, i))
        .when(n1 == n2 + 1, without(w1, n1, i) == w2)
        .when(n2 == n1 + 1, without(w2, n2, i) == w1)
        .otherwise(False)
    )
    near = checked.where(within & (F.greatest(n1, n2) >= cfg.words_per_edit)).select("at").distinct()

    again = first.where("copies > 1").select("h1", "h2", F.col("first").alias("kept_at"))
    copies = seen.select("k.h1", "k.h2", "at").join(again, ["h1", "h2"]).where("at > kept_at").select("at.doc_id", "at.pos", "h1")
    return copies.unionByName(near.join(first.select(F.col("first").alias("at"), "h1"), "at").select("at.doc_id", "at.pos", "h1"))


def dedup_lines(docs: DataFrame, cfg: LineConfig = LineConfig(), count: str | None = "lines_removed") -> DataFrame:
    """``docs`` without superfluous lines, with the number of them in a column ``count``
    (none: no such column; one of that name in ``docs`` is replaced).

    Other columns stay as given, ``n_chars`` excepted, which follows the text. Blank lines
    stay. A text whose lines all go is empty, a null text null; rows without doc_id pass
    untouched. Rows that repeat a doc_id count as one document: lines at one place don't
    make each other superfluous. A very long text is split and joined in its row, in time
    proportional to its lines.
    """
    gone, places, left = fresh(docs, "gone_lines"), fresh(docs, "gone_places"), fresh(docs, "left_over")
    found = removed_lines(docs, cfg).groupBy("doc_id").agg(F.collect_list(F.struct("pos", "h1")).alias(gone))
    lines = F.split("text", "\n")
    # The split is bound to a name once: an array of one array. A place counts only if the
    # line there is the one meant, as rows may repeat a doc_id with other texts.
    own = F.flatten(F.transform(F.array(lines), lambda x: F.transform(F.filter(gone, lambda g: F.xxhash64(F.trim(F.get(x, g["pos"]))) == g["h1"]), lambda g: g["pos"])))
    hit = F.col(gone).isNotNull() & F.col("text").isNotNull()
    joined = docs.join(found, "doc_id", "left").withColumn(places, F.when(hit, F.array_distinct(own)))
    every = F.sequence(F.lit(0), F.size(lines) - 1)
    kept = F.flatten(F.transform(F.array(lines), lambda x: F.transform(F.array_except(every, places), lambda i: F.get(x, i))))
    out = joined.withColumn(left, F.when(hit, F.array_join(kept, "\n")).otherwise(F.col("text")))
    swap = {"text": F.col(left).alias("text"), "n_chars": F.length(left).cast("long").alias("n_chars")}
    removed = [] if count is None else [F.when(F.col(places).isNull(), F.lit(0)).otherwise(F.size(places)).alias(count)]
    return out.select(*[swap.get(c, column(c)) for c in docs.columns if c != count], *removed)


def op8_line_dedup(docs: DataFrame) -> DataFrame:
    out = dedup_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", "lines_removed", F.length("text").cast("long").alias("n_chars"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
