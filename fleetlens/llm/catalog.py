"""The registered queries of this subpackage, and their SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetlens.llm import (
    chat, contamination, fill_middle, html_text, lexical_search, near_duplicates, neighbours, packing, quality,
    quality_rules as rules, repeats, secret_scan, toxicity as toxic,
)
from fleetlens.llm.tables import read_table

#: A conversation that the chat query adds to the table, and what both its turns say.
ADDED_ID, ADDED_TEXT = -7, "\\### Assistant: </turn> ok"


def vocabulary() -> str:
    """Place of the public byte-level vocabulary on this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(read_table(spark, sf_dir, "pages"))


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated_passages(read_table(spark, sf_dir, "documents"))


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    added = spark.range(2).select(
        F.lit(ADDED_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(ADDED_TEXT).alias("text"))
    return chat.chat_digests(table.unionByName(added), vocabulary()).drop("n_tokens", "n_loss_tokens")


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), vocabulary())


def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(read_table(spark, sf_dir, "documents"))


def secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(read_table(spark, sf_dir, "documents"))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(fill_middle.fill_in_middle(read_table(spark, sf_dir, "documents")))


def lexical_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_benchmark_decontamination": benchmark_decontamination,
    "op2_html_extraction": html_extraction,
    "op3_toxicity": toxicity,
    "op4_nearest_neighbours": nearest_neighbours,
    "op5_suffix_array_dedup": suffix_array_dedup,
    "op6_quality_classifier": quality_classifier,
    "op7_chat_formatting": chat_formatting,
    "op8_best_fit_packing": best_fit_packing,
    "op9_minhash_near_dedup": minhash_near_dedup,
    "op10_secret_scans": secret_scans,
    "op11_quality_rules": quality_rules,
    "op12_fill_in_middle": fill_in_middle,
    "op13_lexical_search": lexical_ranking,
}


def _rules_sql() -> str:
    """Counts by joins and lists, estimation as a recursive query with one row of chances per round."""
    names = list(rules.RULES)
    votes = ", ".join(
        f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END AS {name}" for name, (bad, good) in rules.RULES.items())
    odds = " + ".join(
        f"CASE {name} WHEN 1 THEN ln(on_good[{k}] / (1 - on_bad[{k}])) WHEN -1 THEN ln((1 - on_good[{k}]) / on_bad[{k}]) "
        "ELSE 0 END" for k, name in enumerate(names, 1))
    chance = f"(coalesce(sum({{weight}}) FILTER ({{name}} = {{right}}), 0) + {rules.PSEUDO} * {{start}}) / " \
             f"(coalesce(sum({{weight}}) FILTER ({{name}} <> 0), 0) + {rules.PSEUDO})"
    on_good = ", ".join(chance.format(weight="n * p", name=f"q.{name}", right=1, start=rules.START_RIGHT_ON_GOOD) for name in names)
    on_bad = ", ".join(chance.format(weight="n * (1 - p)", name=f"q.{name}", right=-1, start=rules.START_RIGHT_ON_BAD) for name in names)
    quoted = ", ".join(f"'{word}'" for word in rules.COMMON)
    marks = rules.SYMBOLS.replace("$", r"\$")
    return rf"""
WITH RECURSIVE parts AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
    FROM documents),
windows AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x
            FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM parts)),
twice AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, x) > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range(3) t(k) GROUP BY r),
counts AS (
    SELECT doc_id, len(w) AS n_words,
           length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
           length(t) - length(regexp_replace(t, '[{marks}]', '', 'g')) AS n_symbols,
           len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
           len(ls) AS n_lines, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_capitals,
           length(regexp_replace(t, '[^a-z]', '', 'g')) AS n_small,
           (length(t) - length(replace(t, '!!', ''))) // 2 AS n_shouts,
           len(list_filter(ls, lambda l: regexp_matches(l, '^[\x20\x09]*[-*]'))) AS n_bullets,
           len(list_filter(w, lambda x: lower(x) IN ({quoted}))) AS n_common,
           len(list_filter(w, lambda x: regexp_matches(x, '[{marks}]'))) AS n_marked,
           len(list_filter(w, lambda x: regexp_matches(x, '{rules.PLAIN}'))) AS n_plain,
           len(list_filter(w, lambda x: right(x, 1) IN ('.', '!', '?'))) AS n_ends
    FROM parts LEFT JOIN covered USING (r)),
votes AS (SELECT *, {votes} FROM counts),
patterns AS (SELECT {', '.join(names)}, count(*) AS n FROM votes GROUP BY ALL),
trust AS (
    SELECT 0 AS round, {rules.START_GOOD}::DOUBLE AS good,
           list_value({', '.join([f'{rules.START_RIGHT_ON_GOOD}::DOUBLE'] * len(names))}) AS on_good,
           list_value({', '.join([f'{rules.START_RIGHT_ON_BAD}::DOUBLE'] * len(names))}) AS on_bad
    UNION ALL
    SELECT round + 1, (sum(n * p) + {rules.PSEUDO * rules.START_GOOD}) / (sum(n) + {rules.PSEUDO}),
           list_value({on_good}), list_value({on_bad})
    FROM (SELECT *, 1 / (1 + exp(-(ln(good / (1 - good)) + {odds}))) AS p FROM trust, patterns
          WHERE round < {rules.ROUNDS}) q GROUP BY round),
last AS (SELECT * FROM trust WHERE round = {rules.ROUNDS})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {rules.BASE_FAILED} AS base_failed,
       NOT ({rules.BASE_FAILED}) AND 1 / (1 + exp(-(ln(good / (1 - good)) + {odds}))) >= {rules.DECISION} AS kept
FROM votes, last
"""


_ESCAPED = r"replace(replace(%s, '\', '\\'), '<|', '<\|')"
SQL: dict[str, str] = {
    # The control strings of a turn have 8 + 8 + 7 characters.
    "op7_chat_formatting": rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT {ADDED_ID}, 0, 'user', '{ADDED_TEXT}' UNION ALL SELECT {ADDED_ID}, 1, 'assistant', '{ADDED_TEXT}'),
talks AS (
    SELECT conv_id, count(*) AS n_turns,
           string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS every,
           coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS learned,
           CAST(sum(23 + length({_ESCAPED % 'role'}) + length({_ESCAPED % 'text'})) AS BIGINT) AS formatted_chars
    FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(every) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
       formatted_chars
FROM talks
""",
    "op9_minhash_near_dedup": r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
sets AS (
    SELECT doc_id, CASE
        WHEN len(w) >= 3 THEN list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)])
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS shingles
    FROM texts),
shingles AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
links AS (
    SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reached AS (
    SELECT doc_id AS node, doc_id AS other FROM documents
    UNION SELECT l.y, r.other FROM reached r JOIN links l ON l.x = r.node),
named AS (SELECT node, min(other) AS component_id FROM reached GROUP BY node)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, c.component_id, c.component_id = s.doc_id AS kept
FROM sets s JOIN named c ON c.node = s.doc_id
""",
    "op11_quality_rules": _rules_sql(),
    "op12_fill_in_middle": rf"""
WITH hashed AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
           sha256('{fill_middle.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents),
chosen AS (
    SELECT doc_id, t, u, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS c1,
           ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS c2, ('0x' || h[17:24])::BIGINT % 100 AS c3,
           ('0x' || h[25:32])::BIGINT % 100 AS c4
    FROM hashed),
cut AS (
    SELECT doc_id, t, n, array_to_string(u[1:least(c1, c2)], '') AS p,
           array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS m, array_to_string(u[greatest(c1, c2) + 1:], '') AS s,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c3 >= {fill_middle.RATE}
                THEN 'plain' WHEN c4 < {fill_middle.SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form
    FROM chosen)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM cut
""",
    "op13_lexical_search": r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents),
items AS (
    SELECT item_id, term, count(*) AS times FROM (
        SELECT item_id, unnest(regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
corpus AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM docs WHERE len(w) > 0),
postings AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM docs) GROUP BY ALL),
weights AS (
    SELECT term, floor(1000 * ln((2.0 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight
    FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), corpus),
norms AS (SELECT r, doc_id, 75 + (25 * len(w) * n_docs) // n_terms AS m FROM docs, corpus WHERE len(w) > 0),
scores AS (
    SELECT item_id, r, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
    FROM items JOIN postings USING (term) JOIN weights USING (term) JOIN norms USING (r) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 20
""",
}
