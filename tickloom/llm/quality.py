"""Quality rules whose cutoffs limit false rejection, in DataFrame functions only.

Three ratios of a text can reject it: symbols to letters, repeated lines to lines, and words in repeated eight-word
windows to words. For every stratum (a language) and rule, the cutoffs of a fixed grid are tested on the labelled
documents of good quality. Each rule may reject the same share p of them, ``risk`` divided by the number of rules. With n
good documents and k above the cutoff, the hypothesis that more than p of good documents lie above it is given up if
P(Binomial(n, p) <= k) is at most ``error`` divided by the number of tests, over all strata, rules and cutoffs
(Bonferroni). The lowest cutoff that passes is used; a rule with none rejects nothing in that stratum. So with
probability 1 - ``error``, in every stratum all rules together reject at most ``risk`` of the good documents. The grid is
fixed beforehand, so all labels are a holdout.

Base checks come first: fewer than 20 words, or over 30 % of words in repeated windows.

Defined cases: a null or empty text has no words and fails the base checks; a document without a language is in the
stratum of those; contradicting labels of a document count as bad; without labels no rule rejects; rows that repeat a
doc_id are judged alike; a row without doc_id is judged, but no label reaches it; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.store import Workspace

SEPARATORS = r"[\x20\x09-\x0D]+"
WINDOW = 8
#: Cutoffs by rule, tried from the lowest; fixed values.
GRID = {
    "symbols": (0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.5),
    "lines": (0.05, 0.1, 0.2, 0.3, 0.5, 0.7),
    "repeats": (0.02, 0.05, 0.1, 0.15, 0.2, 0.25),
}


def counts(docs: DataFrame) -> DataFrame:
    """doc_id, stratum, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words of each row."""
    text = F.coalesce("text", F.lit(""))
    inner = F.regexp_replace(text, rf"^{SEPARATORS}|{SEPARATORS}$", "")
    words = docs.select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("stratum"), text.alias("text"), inner.alias("inner"),
    ).select(
        "doc_id", "stratum",
        F.length(F.regexp_replace("inner", SEPARATORS, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.when(F.col("inner") == "", F.array().cast("array<string>")).otherwise(F.split("inner", SEPARATORS)).alias("words"),
    )
    size = F.size("words")
    windows = F.when(
        size >= WINDOW, F.transform(F.sequence(F.lit(1), size - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("words", i, WINDOW))),
    ).otherwise(F.array().cast("array<bigint>"))
    hashed = words.select(
        "doc_id", "stratum", size.cast("long").alias("n_words"), "word_chars", "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("windows"),
    )
    # where windows repeat, in order of window and place, so that equal ones are neighbours
    places = hashed.withColumn("places", F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.array_sort(F.transform("windows", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    found = F.array_sort(F.transform(F.filter("places", lambda e, j: (
        (e["x"] == F.get("places", j - 1)["x"]) | (e["x"] == F.get("places", j + 1)["x"]))), lambda e: e["i"]))
    covered = F.aggregate(
        found, F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")))["n"]
    return places.select(
        "doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def ratios() -> dict[str, Column]:
    return {
        "symbols": F.col("n_symbols") / F.greatest("word_chars", F.lit(1)),
        "lines": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "repeats": F.col("n_repeat_words") / F.greatest("n_words", F.lit(1)),
    }


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """ln P(Binomial(n, p) <= k), by summing its terms as logarithms."""
    def add(a, i):
        term = a["term"] + F.log((n - i + 1) / i) + math.log(p / (1 - p))
        top = F.greatest(term, a["sum"])
        return F.struct(term.alias("term"), (top + F.log1p(F.exp(F.least(term, a["sum"]) - top))).alias("sum"))

    first = n * math.log1p(-p)
    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(steps, F.struct(first.alias("term"), first.alias("sum")), add)["sum"]


def cutoffs(measured: DataFrame, labels: DataFrame, space: Workspace, risk: float = 0.02, error: float = 0.05) -> DataFrame:
    """stratum and, by rule, the cutoff that is used there, or null."""
    marked = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    good = measured.join(marked.where("quality = 1").select("doc_id"), "doc_id")
    tests = [(rule, cut) for rule, grid in GRID.items() for cut in grid]
    ratio = ratios()
    tally = good.where(~base_failed()).groupBy("stratum").agg(
        F.count("*").alias("n"),
        F.array(*(F.struct(
            F.lit(rule).alias("rule"), F.lit(float(cut)).alias("cut"),
            F.sum((ratio[rule] > cut).cast("long")).alias("k")) for rule, cut in tests)).alias("tests"))
    tally = space.save(tally, "tally")
    least = math.log(error / (len(tests) * max(1, tally.count())))
    each = risk / len(GRID)  # a verdict is any rule's, so that shares add up
    rows = tally.select("stratum", "n", F.inline("tests")).where(F.col("k") < F.col("n") * each)
    passed = rows.where(binomial_tail(F.col("n"), F.col("k"), each) <= least)
    return passed.groupBy("stratum").agg(
        *(F.min(F.when(F.col("rule") == rule, F.col("cut"))).alias(f"cut_{rule}") for rule in GRID))


def judge(docs: DataFrame, labels: DataFrame, risk: float = 0.02, error: float = 0.05) -> DataFrame:
    """One row per row of ``docs``: doc_id, the counts, base_failed, kept."""
    space = Workspace(docs.sparkSession, "quality")
    measured = space.save(counts(docs), "counts")
    chosen = space.save(cutoffs(measured, labels, space, risk, error), "cutoffs")
    over = [F.coalesce(ratio > F.col(f"cut_{rule}"), F.lit(False)) for rule, ratio in ratios().items()]
    rejected = over[0] | over[1] | over[2]
    return measured.join(chosen, "stratum", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), (~base_failed() & ~rejected).alias("kept"))
