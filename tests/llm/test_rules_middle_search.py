"""Quality rules, fill-in-the-middle and ranked search, against SQL and plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import catalog, fill_middle, lexical_search, quality_rules

SMALL = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, n_words string, kept string, output string, score string"
ODD = [(1, None), (2, ""), (3, "\n\n \t"), (4, "one"), (5, "a b\nc"), (5, "a b\nc"), (6, "É é  x\n" * 3), (None, "lost id"),
       (7, "x y z " * 40), (8, "no end\nof line"), (9, "has <S> in it\n"), (10, "line\n" * 5000 + "end"),
       (11, "\U0001f600 \U0001f600\n" * 3000), (12, "<"), (13, "<P\n><S\n>")]


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "clash", "clash", "clash", "clash") for i, t in rows], DOCS)


@pytest.mark.parametrize("name", ["op11_quality_rules", "op12_fill_in_middle", "op13_lexical_search"])
def test_same_rows_as_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    theirs = connection.execute(catalog.SQL[name])
    columns = [d[0] for d in theirs.description]
    mine = catalog.QUERIES[name](spark, SMALL)
    assert mine.columns == columns
    rows = sorted(map(tuple, mine.collect()))
    assert rows and rows == sorted(theirs.fetchall())


# --- quality rules -----------------------------------------------------------------------------------

def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(covered))


def test_counts_equal_brute_force(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices(["a ", "b ", "cc ", "\n", "# ", "\t", "é|", "x\n"], k=rng.randrange(60))) for _ in range(200)]
    docs = docs_of(spark, ODD + [(100 + k, t) for k, t in enumerate(texts)] + [(999, "w " * 60_000), (998, "")])
    got = quality_rules.with_counts(docs).select("text", "_counts.*").collect()
    assert len(got) == len(ODD) + 202
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base_counts(r.text)


def test_estimation_equals_plain_numbers(spark):
    rng, names = np.random.default_rng(5), list(quality_rules.RULES)
    votes = rng.choice([-1, 0, 1], size=(300, len(names)), p=[0.2, 0.3, 0.5])
    patterns = spark.createDataFrame([(list(map(int, v)), 1) for v in votes], "votes array<int>, n long")
    trust = quality_rules.estimate(patterns, rounds=4)
    good, right, bad = 0.8, np.full(len(names), 0.9), np.full(len(names), 0.5)
    for _ in range(4):
        odds = math.log(good / (1 - good)) + (votes == 1) @ np.log(right / (1 - bad)) + (votes == -1) @ np.log((1 - right) / bad)
        p = 1 / (1 + np.exp(-odds))
        good = (p.sum() + 5 * 0.8) / (len(p) + 5)
        right = ((votes == 1).T @ p + 5 * 0.9) / ((votes != 0).T @ p + 5)
        bad = ((votes == -1).T @ (1 - p) + 5 * 0.5) / ((votes != 0).T @ (1 - p) + 5)
    assert np.allclose([trust.good, *trust.on_good, *trust.on_bad], [good, *right, *bad])


def test_rules_take_odd_rows(spark):
    docs = docs_of(spark, ODD)
    rows = quality_rules.quality_rules(docs).collect()
    assert len(rows) == len(ODD) and all(0 <= r.posterior <= 1 for r in rows)
    assert all(r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words) for r in rows)
    assert all(not (r.base_failed and r.kept) for r in rows)
    assert quality_rules.quality_rules(docs.limit(0)).collect() == []
    kept = quality_rules.without_poor(docs)
    assert kept.columns == docs.columns
    assert sorted(r.text for r in kept.collect()) == sorted(
        t for (_, t), r in zip(ODD, quality_rules.quality_rules(docs).collect()) if r.kept)


def test_rules_agree_with_labels_they_never_saw(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{name}.parquet") for name in ("documents", "labels"))
    judged = quality_rules.quality_rules(docs).where("not base_failed").join(labels, "doc_id")
    wrong = judged.where(F.col("kept") != (F.col("quality") == 1)).count()
    assert wrong <= 0.01 * judged.count()


def test_no_python_in_the_rules(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    plan = quality_rules.without_poor(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- fill-in-the-middle ------------------------------------------------------------------------------

def plain_middle(doc_id, text, rate=100):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 50:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_cuts_equal_plain_python_for_any_block():
    rng = random.Random(11)
    for k in range(400):
        text = "".join(rng.choices(["a", "\n", "é", "\U0001f600", "<", "bc\n"], k=rng.randrange(70)))
        data = np.frombuffer(text.encode(), np.uint8)
        for block in (1, 2, 3, 7, 4096):
            n, form, p, m, out = fill_middle.rearrange(data, k, block=block)
            assert (n, form, p, m, out.decode()) == plain_middle(k, text)
            lines, units = fill_middle.Lines(data, block), re.findall(r"[^\n]*\n|[^\n]+", text)
            for cut in range(n + 1):
                head = "".join(units[:cut])
                assert lines.cut(cut) == (len(head.encode()), len(head))


def test_middle_takes_odd_rows(spark):
    docs = docs_of(spark, ODD)
    rows = fill_middle.fill_in_middle(docs, rate=60).collect()
    assert sorted(map(repr, ((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in rows))) == sorted(
        repr((i, *plain_middle(i, t, 60))) for i, t in ODD)
    back = fill_middle.fill_in_middle(docs).select(fill_middle.read_back(F.col("output"), F.col("form")).alias("t")).collect()
    assert sorted(r.t for r in back) == sorted(t or "" for _, t in ODD)
    assert fill_middle.digests(fill_middle.fill_in_middle(docs.limit(0))).collect() == []


# --- ranked search -----------------------------------------------------------------------------------

def plain_ranking(docs, items, top=20):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    bag = lambda t: Counter(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(lower)))
    bags = [(i, b) for i, b in ((i, bag(t)) for i, t in docs) if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(term for _, b in bags for term in b)
    wanted = {}
    for i, t in set(items):
        wanted.setdefault(i, Counter()).update(bag(t))
    out = []
    for item, terms in wanted.items():
        scored = []
        for doc, b in bags:
            m = 75 + (25 * sum(b.values()) * n_docs) // n_terms
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 12 * m))
                for t, times in terms.items() if t in b)
            if score > 0:
                scored.append((-score, doc is not None, doc or 0, doc))
        out += [(item, k, s[3], -s[0]) for k, s in enumerate(sorted(scored)[:top], 1)]
    return sorted(map(repr, out))


def test_ranking_equals_brute_force(spark, monkeypatch):
    rng, words = random.Random(2), ["the", "The", "of", "é", "É", "x1", "漢字", "a", "b", "c", "zz", "-", "!"]
    docs = ODD + [(100 + k % 90, " ".join(rng.choices(words, k=rng.randrange(30)))) for k in range(300)]
    items = [(k, " ".join(rng.choices(words, k=rng.randrange(12)))) for k in range(25)] + [
        (3, "more of the x1"), (3, "more of the x1"), (None, "zz the"), (50, None), (51, ""), (52, "unseen"), (53, "the " * 9)]
    table = docs_of(spark, docs).repartition(3)
    asked = spark.createDataFrame([(i, t, "clash", "clash") for i, t in items], "item_id long, text string, rank string, score string")
    expected = plain_ranking(docs, items)
    for terms, block in ((1 << 16, 2048), (20, 16)):  # one batch, then several batches and blocks
        monkeypatch.setattr(lexical_search, "BATCH_TERMS", terms)
        monkeypatch.setattr(lexical_search, "BLOCK_DOCS", block)
        got = lexical_search.rank_documents(table, asked).collect()
        assert sorted(repr(tuple(r)) for r in got) == expected
    assert lexical_search.rank_documents(table.limit(0), asked).collect() == []
    assert lexical_search.rank_documents(table, asked.limit(0)).collect() == []


def test_shared_sets_are_summed_once():
    rng = random.Random(4)
    common, items = list(range(8)), []
    for _ in range(40):
        items.append({t: 1 for t in rng.sample(common, 6)} | {rng.randrange(8, 500): rng.randrange(1, 3) for _ in range(5)})
    plan = lexical_search.share_terms(items)
    leaves = [{leaf: 1} for leaf in plan.leaves]
    for x, y in plan.pairs:
        assert not set(leaves[x]) & set(leaves[y])
        leaves.append({**leaves[x], **leaves[y]})
    for item, nodes in zip(items, plan.items):
        assert Counter(leaf for node in nodes for leaf in leaves[node]) == Counter(item.items())
    assert plan.additions() < 0.75 * sum(map(len, items))
    assert lexical_search.share_terms([]).items == [] and lexical_search.share_terms([{}]).items == [[]]


def test_terms_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(lexical_search, "hash_spans", lambda lower, starts, ends: (ends - starts).astype(np.uint64))
    vocabulary = lexical_search.Vocabulary(["aa", "bb", "c", "dd"])
    import pyarrow as pa
    lower, starts, ends, _ = lexical_search.term_spans(pa.array(["dd c xx aa BB e", "dd"]))
    found = [vocabulary.terms[k] if k >= 0 else None for k in vocabulary.find(lower, starts, ends)]
    assert found == ["dd", "c", None, "aa", "bb", None, "dd"]
