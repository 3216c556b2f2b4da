"""Line dedup by deletion neighbourhoods (native: DataFrame expressions only).

Lines are compared by their words (split at white space).  A line of any words goes
if an earlier one has the same words; one of at least ``min_words`` words also goes if
an earlier one lies within one word edit of it (a word replaced, inserted or deleted).
``exact_words`` leaves lines of fewer words alone.  A line of fewer words
that holds a sign of a script without spaces between words (Chinese, Japanese, Thai
and others) is compared by its characters, each counted as a word.  Earlier means
the smaller (doc_id, line number).

1. Every line gets a 128-bit hash; equal lines are one class with its earliest
   place, a map-side aggregate, so a line that a third of all documents hold is one
   row per task.
2. Of two lines within one edit, one half is untouched: they share their first or
   last ``s // 2`` words, s the smaller word count.  Classes that share such a half
   with no other class cannot have a partner and are left out of step 3.
3. Each other class emits its deletion variants as hashed keys (each word left out
   once, and itself).  Equal variants meet: lines that agree with the same position
   left out meet their earliest one, a line meets the lines it is a variant of.
   Each line meets one line per key, so a family of m similar lines gives about m
   rows and never m * m.
4. Pairs that met are verified on their words, and the later line of each goes with
   all its copies; the earliest stays.
5. The lines are read again to place what goes, and the texts to cut it out.  Filters of a
   fixed size keep lines and documents that lose nothing out of both shuffles.

A variant's key is a sum over its words of a hash of (word, place), built from
running totals, so a line of n words costs about n, not n * n.

Defined results: a null text has no lines and stays null; rows with a null doc_id
have no place in the order, they stay as they are and remove nothing; rows that
repeat an id are one document where their texts are equal and otherwise ordered by
text hash; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postline.llm.common import cut, discard, let, read_table, running_totals
from postline.operators.bloom import KeyFilter

MIN_WORDS = 8
EXACT_WORDS = 1
KEY_MASK = (1 << 40) - 1  # sums of such hashes stay in 63 bits up to 8 million words


BLANKS = "\t\r\x0b\x0c\xa0"
# Fixed value: signs of scripts that put no spaces between words.
UNSPACED = (r"[\x{0E00}-\x{0EFF}\x{0F00}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{4DBF}"
            r"\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}]")


def canonical(line: Column) -> Column:
    """The words of a line with single spaces between them.

    The rewriting functions are slow, so each runs only on a line that needs it.
    """
    odd = F.contains(line, F.lit(BLANKS[0]))
    for c in BLANKS[1:]:
        odd = odd | F.contains(line, F.lit(c))
    plain = let(F.when(odd, F.translate(line, BLANKS, " " * len(BLANKS))).otherwise(line), F.trim)
    return let(plain, lambda x: F.when(F.contains(x, F.lit("  ")), F.regexp_replace(x, " {2,}", " ")).otherwise(x))


def _n_words(line: Column) -> Column:
    return F.when(line == "", 0).otherwise(
        F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1)


def _units(line: Column, min_words: int) -> Column:
    """(line, n): the words or characters that a line is compared by, joined with single spaces, and their number."""
    pair = lambda x, n: F.struct(x.alias("line"), n.alias("n"))
    apart = lambda x: let(F.array_join(F.split(F.replace(x, F.lit(" "), F.lit("")), ""), " "), lambda y: pair(y, _n_words(y)))
    return let(canonical(line), lambda x: let(_n_words(x), lambda n: F.when(
        (n < min_words) & x.rlike(UNSPACED), apart(x)).otherwise(pair(x, n))))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                       F.col(text_col).alias("text")).where("doc_id is not null and text is not null")


def _half_keys(line: Column, n: Column) -> Column:
    """Hashes of the first and of the last s // 2 words, for s = n and s = n - 1 (the same for odd n)."""
    def keys(less: int) -> list[Column]:
        words = F.floor((n - less) / 2).cast("int")
        half = lambda side: F.xxhash64(words * side, F.call_function("substring_index", line, F.lit(" "), words * side))
        return [half(1), half(-1)]
    return F.when(n % 2 == 1, F.array(*keys(0))).otherwise(F.array(*keys(0), *keys(1)))


def _occurrences(docs: DataFrame, id_col: str, text_col: str, min_words: int, exact_words: int) -> DataFrame:
    """(doc_id, text_hash, line_no, h1, h2, halves): every line that is judged; no halves where only equal lines count."""
    counted = lambda line: _units(line, min_words)
    lines = _texts(docs, id_col, text_col).select(
        "doc_id", "text_hash", F.posexplode(F.transform(F.split("text", "\n", -1), counted)).alias("line_no", "x"))
    line = F.col("x.line")
    return lines.where(F.col("x.n") >= max(1, min(min_words, exact_words))).select(
        "doc_id", "text_hash", "line_no", F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(7), line).alias("h2"),
        F.when(F.col("x.n") >= min_words, _half_keys(line, F.col("x.n"))).alias("halves"))


def _variants(words: Column) -> tuple[Column, Column]:
    """The key of a line's own words, and the array of the keys with one word left out."""
    value = lambda w, place: F.xxhash64(w, place).bitwiseAND(F.lit(KEY_MASK))
    here = F.transform(words, lambda w, i: value(w, i))
    moved = F.transform(words, lambda w, i: value(w, i - 1))
    total = lambda x: F.aggregate(x, F.lit(0).cast("bigint"), lambda a, b: a + b)
    # words before the gap keep their place, those after it move up by one
    keys = let(here, lambda a: let(moved, lambda b: let(total(b), lambda tb: F.transform(
        F.arrays_zip(running_totals(a).alias("before"), running_totals(b).alias("upto"), b.alias("own")),
        lambda x: x["before"] + tb - x["upto"] - x["own"]))))
    return total(here), keys


def _close(a: Column, b: Column) -> Column:
    """Whether two word arrays are within one edit of each other."""
    same = F.size(a) == F.size(b)
    replaced = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda ok: ~F.coalesce(ok, F.lit(False)))) <= 1

    def without_one(longer: Column, shorter: Column) -> Column:
        m = F.size(shorter)
        agree = F.zip_with(F.slice(longer, F.lit(1), m), shorter, lambda x, y: x == y)
        first = F.array_position(agree, False)  # 0: all agree, the last word is the extra one
        return F.when(first == 0, F.lit(True)).otherwise(
            F.slice(longer, (first + 1).cast("int"), (m - first + 1).cast("int"))
            == F.slice(shorter, first.cast("int"), (m - first + 1).cast("int")))

    return (F.when(same, replaced)
            .when(F.size(a) == F.size(b) + 1, without_one(a, b))
            .when(F.size(b) == F.size(a) + 1, without_one(b, a)).otherwise(False))


def near_lines(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """(h1, h2) of the classes that have an earlier class within one edit."""
    halves = classes.select("h1", F.explode(F.array_distinct("halves")).alias("half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("n")).where("n > 1").select("half")
    # by h1 alone: a class more than needed does no harm here
    wanted = halves.join(shared, "half", "left_semi").select("h1").distinct()
    places = (classes.join(wanted, "h1", "left_semi")
              .groupBy("first.doc_id", "first.text_hash")
              .agg(F.collect_list(F.struct("first.line_no", "h1", "h2")).alias("wanted")))
    # the words of a class come from its earliest place; a repeated row gives them twice
    places = cut(places, "line-places")
    key = [F.col("doc_id"), F.col("text_hash")]
    lines = (KeyFilter(places, key).may_meet(_texts(docs, id_col, text_col), key).join(places, ["doc_id", "text_hash"])
             .select("doc_id", "text_hash", F.split("text", "\n", -1).alias("lines"), F.explode("wanted").alias("w"))
             .select(F.struct("doc_id", F.col("w.line_no").alias("line_no"), "text_hash").alias("first"), "w.h1", "w.h2",
                     F.split(_units(F.get("lines", F.col("w.line_no")), min_words)["line"], " ").alias("words"))
             .dropDuplicates(["h1", "h2"]))
    own, gaps = _variants(F.col("words"))
    lines = cut(lines.withColumns({"own": own, "gaps": gaps}), "lines")
    # the earliest place names a class, and orders it
    n, who = F.size("words"), F.col("first").alias("who")
    whole = lines.select(F.xxhash64("own", n).alias("key"), who)
    parts = lines.select(F.posexplode("gaps").alias("place", "gap"), (n - 1).alias("n"), who).select(
        F.xxhash64("gap", "n").alias("key"), "place", "who")
    meeting = parts.groupBy("key", "place").agg(F.min("who").alias("early"), F.count("*").alias("met")).where("met > 1")
    replaced = parts.join(meeting, ["key", "place"]).where("early < who").select(F.col("who").alias("late"), "early")
    inserted = whole.withColumnRenamed("who", "other").join(parts, "key").select(
        F.greatest("who", "other").alias("late"), F.least("who", "other").alias("early"))
    pairs = replaced.union(inserted).distinct()
    late = lines.select(F.col("first").alias("late"), "h1", "h2", F.col("words").alias("late_words"))
    early = lines.select(F.col("first").alias("early"), F.col("words").alias("early_words"))
    near = cut(pairs.join(late, "late").join(early, "early")
               .where(_close(F.col("late_words"), F.col("early_words"))).select("h1", "h2").distinct(), "near-lines")
    discard(places, lines)
    return near


def lines_to_remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                    exact_words: int = EXACT_WORDS) -> DataFrame:
    """(doc_id, text_hash, gone): the numbers of the lines that go, in order, per document text."""
    # read twice rather than written: hashes do not compress, and the second pass needs no half keys
    seen = _occurrences(docs, id_col, text_col, min_words, exact_words)
    place = F.struct("doc_id", "line_no", "text_hash")
    classes = cut(seen.groupBy("h1", "h2").agg(
        F.min(place).alias("first"), F.count("*").alias("copies"), F.first("halves").alias("halves")), "line-classes")
    near = near_lines(docs, classes.where("halves is not null"), id_col, text_col, min_words)
    judged = cut(classes.select("h1", "h2", "first", "copies").join(near.withColumn("near", F.lit(True)), ["h1", "h2"], "left")
                 .where("near or copies > 1").select("h1", "h2", "first", F.coalesce("near", F.lit(False)).alias("near")), "judged-lines")
    discard(classes, near)
    again = KeyFilter(judged, [F.col("h1"), F.col("h2")]).may_meet(seen.drop("halves"), [F.col("h1"), F.col("h2")])
    gone = again.join(judged, ["h1", "h2"]).where(F.col("near") | (place != F.col("first")))
    return gone.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("line_no")).alias("gone"))


def _mask(gone: Column) -> Column:
    """One byte per line up to the last that goes: '1' for those that go."""
    steps = F.transform(gone, lambda g, k: F.concat(
        F.repeat(F.lit("0"), g - F.when(k > 0, F.get(gone, k - 1) + 1).otherwise(0)), F.lit("1")))
    return F.array_join(steps, "").cast("binary")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                count_col: str | None = None, exact_words: int = EXACT_WORDS) -> DataFrame:
    """``docs`` with the text less its repeated lines; ``count_col`` names a column for how many went."""
    gone = cut(lines_to_remove(docs, id_col, text_col, min_words, exact_words).select(
        F.col("doc_id").alias("_dedup_id"), F.col("text_hash").alias("_dedup_hash"), _mask(F.col("gone")).alias("_dedup_mask"),
        F.size("gone").alias("_dedup_gone")), "lines-gone")
    own = [F.col(id_col).cast("long"), F.xxhash64(text_col)]
    losing = KeyFilter(gone, [F.col("_dedup_id"), F.col("_dedup_hash")])
    # documents that lose nothing stay where they are, only the others are shuffled
    joined = losing.may_meet(docs, own).join(gone, (own[0] == F.col("_dedup_id")) & (own[1] == F.col("_dedup_hash")), "left")
    goes = lambda i: F.coalesce(F.substring(F.col("_dedup_mask"), i + 1, 1) == F.lit(b"1"), F.lit(False))
    kept = F.array_join(F.filter(F.split(F.col(text_col), "\n", -1), lambda _line, i: ~goes(i)), "\n")
    out = joined.withColumn(text_col, F.when(F.col("_dedup_mask").isNull(), F.col(text_col)).otherwise(kept))
    whole = losing.meets_none(docs, own)
    if count_col:
        out = out.withColumn(count_col, F.coalesce("_dedup_gone", F.lit(0)))
        whole = whole.withColumn(count_col, F.lit(0))
    return out.drop("_dedup_id", "_dedup_hash", "_dedup_mask", "_dedup_gone").unionByName(whole)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` after line dedup, its text as a digest."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, count_col="lines_gone").select(
        "doc_id", "lines_gone", F.length("text").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))
