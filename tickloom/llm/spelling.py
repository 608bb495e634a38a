"""Groups of spelling variants by permuterm rotations.

A word is marked with a terminator and rotated by every one of its places. A rotation that begins right after place i
ends with the code point at i, so all words that differ from it there share the rest of it as a prefix, and the word
that lacks it has that prefix as a whole rotation. So one sorted group of rotations with an equal prefix holds words
that are near by one replacement, each of them near by a deletion to the one word that is the prefix itself. The
alphabet has ``len(LETTERS)`` code points, so a group has at most one word more: no group grows with the corpus.

A pair of words meets once: a replacement has one place, and of a run of equal code points only the first may be deleted.

Defined cases: a null text has no words; a null doc_id counts as empty text in the checksum; rows that repeat count each
time; ties of two forms go to the smaller word in code-point order; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.store import Workspace

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = LOWER + "".join(map(chr, range(0xC0, 0x100)))
END = "$"


def _cut(word: str, at: str | Column) -> Column:
    """The word without its code point at a place, from 0."""
    return F.concat(F.expr(f"substring({word}, 1, {at})"), F.expr(f"substring({word}, {at} + 2)"))


def vocabulary(docs: DataFrame, typo: int = 199, length: int = 6, least: int = 5) -> DataFrame:
    """word and n, for words of at least ``length`` code points and ``least`` occurrences.

    Of the runs whose checksum ``typo`` divides, one code point is deleted.
    """
    lowered = F.translate(F.col("text"), UPPER, LOWER)
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))).alias("run"))
    h = F.crc32(F.concat("doc", F.lit(":"), "run"))
    word = F.when(F.col("h") % typo == 0, _cut("run", "int(h % length(run))")).otherwise(F.col("run"))
    return (
        runs.withColumn("h", h).select(word.alias("word")).where(F.length("word") >= length)
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    )


def rotations(words: DataFrame) -> DataFrame:
    """prefix, last, word and n of every rotation of each marked word.

    ``last`` is the code point that the prefix leaves out, null where the prefix is the whole rotation. ``first`` says
    that it is the first of a run of equal ones.
    """
    size = F.length("word")
    places = words.withColumn("i", F.explode(F.sequence(F.lit(0), size)))
    whole = places.select(
        F.concat(F.expr("substring(word, i + 1)"), F.lit(END), F.expr("substring(word, 1, i)")).alias("prefix"),
        F.lit(None).cast("string").alias("last"), F.lit(True).alias("first"), "word", "n")
    left = places.where(F.col("i") < size).select(
        F.concat(F.expr("substring(word, i + 2)"), F.lit(END), F.expr("substring(word, 1, i)")).alias("prefix"),
        F.expr("substring(word, i + 1, 1)").alias("last"),
        ((F.col("i") == 0) | (F.expr("substring(word, i, 1)") != F.expr("substring(word, i + 1, 1)"))).alias("first"),
        "word", "n")
    return whole.unionByName(left)


def neighbours(words: DataFrame) -> DataFrame:
    """word, other and other_n for every two words that are one edit apart, each way and once.

    One shuffle brings a prefix's rotations together, in sorted order; groups of one go at once.
    """
    groups = (
        rotations(words).groupBy("prefix")
        .agg(F.sort_array(F.collect_list(F.struct("last", "first", "word", "n"))).alias("words"))
        .where(F.size("words") > 1)
    )

    def near(one: Column, other: Column) -> Column:
        replaced = one["last"].isNotNull() & other["last"].isNotNull()
        return (one["word"] != other["word"]) & (replaced | (one["first"] & other["first"]))

    one = groups.select("words", F.explode("words").alias("one"))
    found = one.select("one", F.explode(F.filter("words", lambda other: near(F.col("one"), other))).alias("other"))
    return found.select(
        F.col("one.word").alias("word"), F.col("other.word").alias("other"), F.col("other.n").alias("other_n"))


def variants(docs: DataFrame, times: int = 5, **options) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the vocabulary.

    A form is the near word that occurs most, if it occurs ``times`` as often; a root is where forms lead to.
    """
    space = Workspace(docs.sparkSession, "spelling")
    words = space.save(vocabulary(docs, **options), "words")
    best = neighbours(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    enough = -F.col("best.less") >= times * F.col("n")
    known = space.save(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("best.other")).alias("form"),
            F.when(enough, -F.col("best.less")).alias("form_n")), "forms")
    return known.join(_roots(known, space), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(known: DataFrame, space: Workspace) -> DataFrame:
    """word and root of the words with a form. Each round doubles the steps taken; forms occur ever more, so it ends."""
    steps = space.save(known.where("form is not null").select("word", F.col("form").alias("root")), "roots_0")
    k = 0
    while True:
        k += 1
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        new = space.save(
            steps.join(on, "root", "left").select(
                "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), f"roots_{k}")
        steps = new.select("word", "root")
        if new.where("moved").isEmpty():
            return steps
