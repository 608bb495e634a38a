"""Spelling variants against brute force: all pairs by edit distance, roots step by step."""

import collections
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from oracle import connect, differences
from tickloom.llm import queries, spelling

DOCS = "doc_id long, text string, word string, n long, root string, prefix string"
COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")
pytestmark = pytest.mark.usefixtures("shared")


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def expected(rows, typo=199):
    count = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % typo == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out, key=repr)


def made(spark, rows):
    return spark.createDataFrame([(i, t, "w", 1, "r", "p") for i, t in rows], DOCS).repartition(3)


def got(frame):
    return sorted((tuple(row[c] for c in COLUMNS) for row in frame.collect()), key=repr)


def corpus():
    rng = np.random.default_rng(3)
    stems = ["banana", "bananna", "bannana", "bananas", "banané", "aaaaaa", "aaaaaaa", "aaaaab", "öffnung", "×÷×÷×÷", "Öffnung",
             "planet", "planets", "planete", "plÀnet"]
    weight = 1.0 / np.arange(1, len(stems) + 1) ** 3
    rows = []
    for k in range(400):
        own = list(rng.choice(stems, 30, p=weight / weight.sum()))
        for j in range(len(own)):
            if rng.random() < 0.15:
                at = rng.integers(0, len(own[j]))
                own[j] = own[j][:at] + str(rng.choice(list("abàéxyz"))) * int(rng.integers(0, 2)) + own[j][at + 1:]
        rows.append((k, " ".join(own)))
    return rows + [(None, None), (None, "Planet planet " * 9), (5, ""), (5, " \n\t"), (6, "x" * 200_000 + " 12345 日本 " * 50),
                   (7, "planet-planet_planet " * 3000), (7, "planet-planet_planet " * 3000)]


@pytest.mark.parametrize("typo", [199, 3])
def test_variants_equal_brute_force(spark, typo):
    want = expected(corpus(), typo)
    found = spelling.variants(made(spark, corpus()), typo=typo)
    assert found.columns == list(COLUMNS) and got(found) == want
    assert any(root not in (word, form) for word, form, root, *_ in want) or typo == 3
    assert any(form for _, form, *_ in want)


def test_ties_and_chains(spark):
    counts = {"abcdef": 5, "abcdeg": 25, "abcdeh": 25, "abcdegh": 125, "abcdexgh": 700, "zzzzzz": 24, "zzzzzzz": 5}
    rows = [(None, " ".join([w] * n)) for w, n in counts.items()]
    found = {r.word: r for r in spelling.variants(made(spark, rows), typo=1 << 40).collect()}
    assert found["abcdef"].form == "abcdeg" and found["abcdef"].root == "abcdexgh" and found["abcdef"].n_near == 2
    assert found["zzzzzzz"].form is None and found["zzzzzzz"].n_near == 1 and found["zzzzzz"].root == "zzzzzz"


def test_every_near_pair_is_met_once(spark):
    rng = np.random.default_rng(4)
    words = sorted({"".join(rng.choice(list("ab"), rng.integers(6, 9))) for _ in range(300)})
    table = spark.createDataFrame([(w, 9) for w in words], "word string, n long")
    found = sorted((r.word, r.other) for r in spelling.neighbours(table).collect())
    assert found == sorted((a, b) for a in words for b in words if one_edit(a, b))


def test_no_group_outgrows_the_alphabet(spark):
    words = ["aaa" + c + "aaa" for c in spelling.LETTERS] + ["aaaaaa"]
    table = spark.createDataFrame([(w, 9) for w in words], "word string, n long")
    largest = spelling.rotations(table).groupBy("prefix").count().agg(F.max("count")).first()[0]
    assert largest == len(spelling.LETTERS) + 1 == 91


def test_nothing_in_nothing_out(spark):
    assert spelling.variants(made(spark, []).limit(0)).isEmpty()
    assert spelling.variants(made(spark, [(1, None), (2, "")])).isEmpty()


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    name = "op11_permuterm_spelling"
    assert differences(queries.QUERIES[name](spark, folder), connect(folder), queries.ORACLE[name]) == []
