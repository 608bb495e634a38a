"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm import bpe_automaton, language
from tickloom.llm.differencing import pack_evenly
from tickloom.llm.divergence import audit
from tickloom.llm.near_dup import near_duplicates
from tickloom.llm.packing import pack_documents
from tickloom.llm.passages import passage_classes
from tickloom.llm.pii import Detector, detect
from tickloom.llm.quality import judge
from tickloom.llm.spelling import variants
from tickloom.llm.store import ready
from tickloom.llm.suffix_dedup import remove_repeats
from tickloom.llm.topk import search
from tickloom.llm.warc import archived


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = language.profiles(docs.where("doc_id is not null").where(~language.held_out()))
    return language.identify(docs, known).select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def byte_vocabulary() -> tuple:
    """The 50k byte-level vocabulary, for ``tokens.Tokens``; its one special token is read as such."""
    path = public_tokenizers.path
    return path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, (("<|endoftext|>", 50256),), path("byte_bpe_50k.json")


def packed(docs: DataFrame) -> DataFrame:
    """Documents in sequences of 2048."""
    return pack_documents(docs, byte_vocabulary())


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op2_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return detect(docs, Detector().fit(docs))


def op7_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op1_risk_controlled_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_maxscore_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))


def op5_warc_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages"))


def op4_compact_window_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_classes(table(spark, sf_dir, "documents"))


def op11_permuterm_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


def op13_karmarkar_karp_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_evenly(table(spark, sf_dir, "documents"), byte_vocabulary())


QUERIES = {
    "op4_compact_window_passages": op4_compact_window_passages,
    "op5_warc_capture_index": op5_warc_capture_index,
    "op10_maxscore_top_k": op10_maxscore_top_k,
    "op1_risk_controlled_quality": op1_risk_controlled_quality,
    "op7_bpe_automaton": op7_bpe_automaton,
    "op2_pii_boosting": op2_pii_boosting,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op6_rank_order_language": op6_rank_order_language,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op11_permuterm_spelling": op11_permuterm_spelling,
    "op12_source_divergence": op12_source_divergence,
    "op13_karmarkar_karp_packing": op13_karmarkar_karp_packing,
}

ORACLE: dict[str, str] = {
    "op1_risk_controlled_quality": r"""
        WITH texts AS (SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t FROM documents),
        parts AS (
            SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
                list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
            FROM texts
        ), places AS (
            SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS g FROM parts, unnest(range(1, len(words) - 6)) AS u(i)
        ), again AS (SELECT doc_id, i FROM places QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
        covered AS (
            SELECT doc_id, CAST(sum(step) AS BIGINT) AS n FROM (
                SELECT doc_id, least(8, i - coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), i - 8)) AS step FROM again)
            GROUP BY doc_id
        ), counts AS (
            SELECT doc_id, stratum, CAST(len(words) AS BIGINT) AS n_words,
                CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
                CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                CAST(len(lines) AS BIGINT) AS n_lines,
                CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                coalesce(covered.n, 0) AS n_repeat_words
            FROM parts LEFT JOIN covered USING (doc_id)
        ), rated AS (
            SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
                n_symbols / greatest(word_chars, 1) AS symbols, n_dup_lines / greatest(n_lines, 1) AS lines,
                n_repeat_words / greatest(n_words, 1) AS repeats
            FROM counts
        ), grid AS (
            SELECT 'symbols' AS rule, unnest([0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.5]::DOUBLE[]) AS cut
            UNION ALL SELECT 'lines', unnest([0.05, 0.1, 0.2, 0.3, 0.5, 0.7]::DOUBLE[])
            UNION ALL SELECT 'repeats', unnest([0.02, 0.05, 0.1, 0.15, 0.2, 0.25]::DOUBLE[])
        ), good AS (
            SELECT rated.* FROM rated JOIN (
                SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1) USING (doc_id)
            WHERE NOT base_failed
        ), tally AS (
            SELECT stratum, rule, cut, count(*) AS n,
                count(*) FILTER (CASE rule WHEN 'symbols' THEN symbols WHEN 'lines' THEN lines ELSE repeats END > cut) AS k
            FROM good, grid GROUP BY ALL
        ), passed AS (
            SELECT stratum, rule, cut FROM tally, unnest(range(0, k + 1)) AS u(i) WHERE k < n * (0.02 / 3)
            GROUP BY stratum, rule, cut, n, k
            HAVING sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.02 / 3) + (n - i) * ln(1 - 0.02 / 3)))
                <= 0.05 / ((SELECT count(*) FROM grid) * (SELECT count(DISTINCT stratum) FROM tally))
        ), chosen AS (
            SELECT stratum, min(cut) FILTER (rule = 'symbols') AS a, min(cut) FILTER (rule = 'lines') AS b,
                min(cut) FILTER (rule = 'repeats') AS c
            FROM passed GROUP BY stratum
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            NOT base_failed AND NOT coalesce(symbols > a, false) AND NOT coalesce(lines > b, false)
                AND NOT coalesce(repeats > c, false) AS kept
        FROM rated LEFT JOIN chosen USING (stratum)
    """,
    "op10_maxscore_top_k": """
        WITH parts AS (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), flat AS (SELECT r, vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM parts),
        scores AS (
            SELECT q.r AS q, c.r AS c, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
            FROM flat q JOIN flat c ON q.d = c.d AND q.r <> c.r
            WHERE q.vec_id % 100 = 0 GROUP BY ALL
        ), ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
                vec_id, score FROM scores
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op11_permuterm_spelling": r"""
        WITH RECURSIVE codes AS (
            SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
                lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)) AS code
        ), runs AS (
            SELECT doc, run, count(*) AS c FROM (
                SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, unnest(regexp_extract_all(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
                FROM documents) GROUP BY ALL
        ), bytes AS (
            SELECT run, c, code, list_transform(range(1, length(h), 2), lambda i:
                16 * (strpos('0123456789ABCDEF', h[i]) - 1) + strpos('0123456789ABCDEF', h[i + 1]) - 1) AS b
            FROM (SELECT *, hex(doc || ':' || run) AS h FROM runs), codes
        ), sums AS (
            SELECT run, c, xor(list_reduce(list_prepend(4294967295, b),
                lambda x, y: xor(x // 256, code[xor(x % 256, y) + 1])), 4294967295) AS h
            FROM bytes
        ), words AS (
            SELECT word, CAST(sum(c) AS BIGINT) AS n FROM (
                SELECT c, CASE WHEN h % 199 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word
                FROM sums)
            WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5
        ), cut AS (
            SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest FROM words, unnest(range(1, length(word) + 1)) AS u(i)
        ), pairs AS (
            SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b USING (i, rest) WHERE a.word <> b.word
            UNION SELECT cut.word, words.word, words.n FROM cut JOIN words ON cut.rest = words.word
            UNION SELECT words.word, cut.word, cut.n FROM cut JOIN words ON cut.rest = words.word
        ), best AS (
            SELECT word, count(*) AS n_near, max(other_n) AS best_n FROM pairs GROUP BY word
        ), forms AS (
            SELECT word, min(other) AS form, best_n AS form_n
            FROM pairs JOIN best USING (word) JOIN words USING (word)
            WHERE other_n = best_n AND best_n >= 5 * words.n GROUP BY word, best_n
        ), steps AS (
            SELECT word, form AS root, 1 AS k FROM forms
            UNION ALL SELECT steps.word, forms.form, k + 1 FROM steps JOIN forms ON steps.root = forms.word
        ), roots AS (SELECT word, arg_max(root, k) AS root FROM steps GROUP BY word)
        SELECT word, form, coalesce(root, word) AS root, n, coalesce(n_near, 0) AS n_near, form_n
        FROM words LEFT JOIN best USING (word) LEFT JOIN forms USING (word) LEFT JOIN roots USING (word)
    """,
    "op12_source_divergence": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        ), tokens AS (
            SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
        ), kept AS (
            SELECT lang, term, count(*) AS n FROM tokens GROUP BY lang, term HAVING count(DISTINCT r) >= 3
        ), groups AS (SELECT DISTINCT lang, source FROM docs),
        langs AS (
            SELECT lang, count(kept.n) AS v, coalesce(sum(kept.n), 0) AS whole
            FROM (SELECT DISTINCT lang FROM groups) LEFT JOIN kept USING (lang) GROUP BY lang
        ), own AS (
            SELECT lang, source, term, count(*) AS n FROM tokens SEMI JOIN kept USING (lang, term) GROUP BY ALL
        ), sizes AS (
            SELECT lang, source, coalesce(sum(own.n), 0) AS whole FROM groups LEFT JOIN own USING (lang, source) GROUP BY ALL
        ), shares AS (
            SELECT lang, sizes.source, term, coalesce(own.n, 0) AS n,
                1 + CAST(1000000000 * (coalesce(own.n, 0) + 1) AS HUGEINT) // CAST(sizes.whole + v AS HUGEINT) AS p,
                1 + CAST(1000000000 * (kept.n + 1) AS HUGEINT) // CAST(langs.whole + v AS HUGEINT) AS q
            FROM sizes JOIN langs USING (lang) JOIN kept USING (lang) LEFT JOIN own USING (lang, source, term)
        ), gaps AS (
            SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
            FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ), pairs AS (
            SELECT lang, a.source, b.source AS item, coalesce(value, 0) AS value
            FROM groups a JOIN groups b USING (lang) LEFT JOIN gaps ON gaps.lang = a.lang AND gaps.source = a.source
                AND gaps.item = b.source
            WHERE a.source <> b.source
        ), parts AS (
            SELECT lang, source, 'pair' AS part, item, value FROM pairs
            UNION ALL
            SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q
        ), ranked AS (
            SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
                CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
            FROM parts
        )
        SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
    """,
}
