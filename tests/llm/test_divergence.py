"""Source divergence against brute force over every term."""

import collections
import re

import numpy as np
import pytest

from oracle import connect, differences
from tickloom.llm import divergence, queries

DOCS = "doc_id long, text string, lang string, source string, term string, n long, block long, item string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
COLUMNS = ("lang", "source", "part", "item", "value", "rank")
pytestmark = pytest.mark.usefixtures("shared")


def expected(rows, least=3, top=200):
    docs, whole = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    groups = collections.defaultdict(collections.Counter)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        own = collections.Counter(TERM.findall(low))
        docs[lang].update(own.keys())
        whole[lang].update(own)
        groups[lang, source].update(own)
    out = []
    for lang in docs:
        kept = sorted(t for t, d in docs[lang].items() if d >= least)

        def shares(count):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10 ** 9 * (count[t] + 1) // (n + len(kept)) for t in kept}

        sources = [s for x, s in groups if x == lang]
        p, base = {s: shares(groups[lang, s]) for s in sources}, shares(whole[lang])
        for s in sources:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            terms = [((p[s][t] - base[t]) ** 2 // base[t], t) for t in kept if groups[lang, s][t] and p[s][t] > base[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(found[:most], 1)]
    return sorted(out)


def corpus(sources=9, seed=1):
    rng = np.random.default_rng(seed)
    words = ["alpha", "Beta", "gamma", "délta", "ÉPSILON", "épsilon", "zeta", "日本", "eta", "theta", " ", "a1b", "i_j", "K@L"]
    rows = []
    for k in range(160):
        own = rng.choice(words, rng.integers(0, 40), p=rng.dirichlet(np.ones(len(words))))
        rows.append((k % 50, " ".join(own), ["en", "fr", None][k % 3], f"s{rng.integers(0, sources)}" if k % 7 else None))
    return rows + [(None, None, "en", "none"), (None, "", "xx", "a"), (1, "12 34", "xx", "b"), (2, "lonely", "yy", "a"),
                   (3, "gamma " * 20_000, "en", "long"), (3, "gamma " * 20_000, "en", "long"), (4, "\x00\x7f only", "zz", "\x00")]


def made(spark, rows):
    return spark.createDataFrame([(*r, "t", 1, 2, "i") for r in rows], DOCS).repartition(3)


def got(frame):
    return sorted(tuple(row[c] for c in COLUMNS) for row in frame.collect())


def test_audit_equals_brute_force(spark):
    found = divergence.audit(made(spark, corpus()))
    assert found.columns == list(COLUMNS) and got(found) == expected(corpus())


def test_many_blocks_and_bundles(spark, monkeypatch):
    """Pairs within and across bundles, terms in several blocks, and only the first terms."""
    monkeypatch.setattr(divergence, "BLOCK", 3)
    monkeypatch.setattr(divergence, "BUNDLE", 2)
    rows = corpus(sources=12, seed=2)
    assert got(divergence.audit(made(spark, rows), top=2)) == expected(rows, top=2)


def test_nothing_kept(spark):
    rows = [(1, "one", "en", "a"), (2, "two", "en", "b"), (3, None, "en", "c")]
    assert got(divergence.audit(made(spark, rows))) == expected(rows)
    assert [r[4] for r in expected(rows)] == [0] * 6
    assert divergence.audit(made(spark, rows).limit(0)).isEmpty()


def test_shares_are_exact_for_large_counts():
    rng = np.random.default_rng(5)
    for whole in (1, 7, 10 ** 9 + 7, 9 * 10 ** 15):
        count = rng.integers(0, whole, 200)
        assert divergence.shares(count, whole).tolist() == [1 + 10 ** 9 * (c + 1) // whole for c in count.tolist()]


def test_a_pair_is_priced_over_every_term():
    rng = np.random.default_rng(6)
    for _ in range(100):
        size = int(rng.integers(1, 40))
        p, q = (rng.integers(0, 3, size) * rng.integers(0, 2, size) for _ in range(2))
        wholes = [int(x.sum()) + size for x in (p, q)]
        dense = [divergence.shares(x, w) for x, w in zip((p, q), wholes)]
        sparse = [(np.flatnonzero(x), d[x > 0], divergence.shares(np.zeros(1, int), w)[0]) for x, d, w in zip((p, q), dense, wholes)]
        want = tuple(int(divergence.gaps(a, b).sum()) for a, b in (dense, dense[::-1]))
        assert divergence.priced(*sparse, size) == want


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    name = "op12_source_divergence"
    assert differences(queries.QUERIES[name](spark, folder), connect(folder), queries.ORACLE[name]) == []
