"""Operators over whole tables: contamination, neighbours, repeats, packing, near duplicates, the pipeline."""

from __future__ import annotations

import collections
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from fleetlens.llm import catalog, contamination, near_duplicates, neighbours, packing, repeats
from fleetlens.llm.components import components

SMALL = "/root/testdata/sf0.01"
LOWER = {c: c + 32 for c in range(65, 91)}


def table_of(spark, name):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def made_docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def prose(rng, count):
    return [f"w{rng.randrange(400)}" for _ in range(count)]


def joined(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_paths_and_stars(spark):
    rng = random.Random(1)
    pairs = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 260)] + [
        (rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)] + [(5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(
        [*pairs, (None, 3), pairs[0]], "a long, b long")).collect()}
    linked = [(a, b) for a, b in pairs if a != b]
    nodes = {x for p in linked for x in p}
    assert got == joined(linked, nodes)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# --- contamination -----------------------------------------------------------------------------------

def brute_overlaps(docs, items):
    word = re.compile(r"[a-z0-9\x80-\U0010ffff]+")
    out = set()
    for doc_id, text in docs:
        words = word.findall((text or "").lower())
        for item_id, item_text in items:
            item = word.findall((item_text or "").lower())
            for shift in range(-len(item), len(words)):
                low, high = max(0, -shift), min(len(item), len(words) - shift)
                span = min(contamination.SPAN, len(item))
                for b in range(low, high - span + 1):
                    same = [item[i] == words[i + shift] for i in range(b, b + span)]
                    if sum(same) < span - int(span * contamination.TOLERANCE):
                        continue
                    if any(all(k == "0" or same[at + i] for i, k in enumerate(mask))
                           for mask in contamination.MASKS for at in range(span - len(mask) + 1)):
                        out.add((doc_id, item_id))
    return out


def test_contamination_equals_brute_force(spark):
    rng = random.Random(4)
    items = [(k, " ".join(prose(rng, n))) for k, n in enumerate([5, 8, 9, 12, 13, 20, 60])] + [(99, None), (98, "")]
    docs = []
    for k in range(60):
        words = prose(rng, 30)
        item = rng.choice(items[:7])[1].split()
        part = item[rng.randrange(max(1, len(item) - 14)):]
        part = [f"x{rng.randrange(10**6)}" if rng.random() < 0.08 else w for w in part]
        docs.append((k, " ".join(words[:15] + part + words[15:])))
    docs += [(100, None), (101, ""), (102, items[1][1]), (102, items[1][1]), (None, items[5][1])]
    frame = made_docs(spark, docs).withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame(items + [(3, items[3][1])], "item_id long, text string")
    got = [(r.doc_id, r.item_id) for r in contamination.contaminated(frame, bench).collect()]
    expected = {p for p in brute_overlaps(docs, items) if p[0] is not None}
    assert len(got) == len(set(got)) and set(got) == expected and len(expected) > 10
    kept = contamination.without_contaminated(frame, bench).collect()
    assert {r.doc_id for r in kept} == {d for d, _ in docs} - {d for d, _ in expected}
    assert contamination.contaminated(frame.limit(0), bench).collect() == []
    assert contamination.contaminated(frame, bench.limit(0)).collect() == []


# --- neighbours --------------------------------------------------------------------------------------

def brute_nearest(vectors, queries, count):
    out = {}
    for q in queries:
        x = np.array(vectors[q])
        scores = [(-(x @ np.array(v)) / (np.linalg.norm(x) * np.linalg.norm(v)), k) for k, v in vectors.items() if k != q]
        out[q] = [k for s, k in sorted((round(s, 12), k) for s, k in scores)[:count]]
    return out


def test_neighbours_recall_and_scores(spark):
    rows = catalog.QUERIES["op4_nearest_neighbours"](spark, SMALL).collect()
    vectors = {r.vec_id: r.embedding for r in table_of(spark, "embeddings").collect()}
    expected = brute_nearest(vectors, [k for k in vectors if k % 50 == 0], 5)
    found = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: r["rank"]):
        found[r.query_id].append(r.vec_id)
        x, y = np.array(vectors[r.query_id]), np.array(vectors[r.vec_id])
        assert np.isclose(r.score, x @ y / np.sqrt((x @ x) * (y @ y)), atol=1e-12)
    assert found.keys() == expected.keys() and all(len(v) == 5 for v in found.values())
    assert np.mean([len(set(found[q]) & set(expected[q])) / 5 for q in expected]) >= 0.85


def test_neighbours_with_ties_copies_and_bad_vectors(spark):
    rng = np.random.default_rng(2)
    good = {k: rng.normal(size=4).tolist() for k in range(40)}
    good |= {k: [1.0, 2.0, 3.0, 4.0] for k in range(100, 160)}
    bad = [(200, None), (201, [0.0] * 4), (202, [1.0, None, 1.0, 1.0]), (203, [float("nan")] * 4),
           (204, [float("inf"), 1.0, 1.0, 1.0]), (205, [1.0]), (None, [1.0, 1.0, 1.0, 1.0]), (206, [])]
    frame = spark.createDataFrame([*good.items(), *list(good.items())[:5], *bad], "vec_id long, embedding array<double>"
                                  ).withColumn("rank", F.lit("clash"))
    found = collections.defaultdict(list)
    for r in sorted(neighbours.nearest(frame, frame, success=1 - 1e-9).collect(), key=lambda r: r["rank"]):
        found[r.query_id].append(r.vec_id)
    assert found == brute_nearest(good, good, 5)
    few = frame.where("vec_id in (1, 2, 100)")
    assert {r.query_id: r.vec_id for r in neighbours.nearest(few, few).where("rank = 2").collect()}.keys() == {1, 2, 100}
    assert neighbours.nearest(frame.limit(0), frame.limit(0)).collect() == []


# --- repeats -----------------------------------------------------------------------------------------

def brute_repeats(docs, length):
    places = collections.Counter()
    for _, text in set(docs):
        words = spaced(text)
        places.update(tuple(words[k:k + length]) for k in range(len(words) - length + 1))
    copies = collections.Counter(text for _, text in set(docs))
    out = set()
    for doc_id, text in set(docs):
        words, end = spaced(text), None
        for k in range(len(words) - length + 1):
            if places[tuple(words[k:k + length])] > 1 or copies[text] > 1:
                if end is not None and k <= end:
                    end = k + length
                    continue
                if end is not None:
                    out.add((doc_id, start, end))
                start, end = k, k + length
        if end is not None:
            out.add((doc_id, start, end))
    return out


@pytest.mark.parametrize("length", [20, 50])
def test_repeats_equal_brute_force(spark, length):
    rng = random.Random(9)
    passages = [prose(rng, n) for n in (length - 1, length, length + 1, 70, 120)]
    docs = []
    for k in range(50):
        words = prose(rng, rng.randrange(60))
        for _ in range(rng.randrange(3)):
            passage = list(rng.choice(passages))
            if rng.random() < 0.4:
                passage[rng.randrange(len(passage))] = f"new{k}"
            words += passage + prose(rng, rng.randrange(40))
        docs.append((k, " ".join(words)))
    docs += [(60, docs[0][1]), (61, docs[0][1]), (62, "a " * 200), (63, ""), (63, ""), (1, docs[1][1])]
    frame = made_docs(spark, docs + [(70, None), (None, docs[2][1])]).withColumn("start", F.lit("clash"))
    got = [(r.doc_id, r.start, r.end) for r in repeats.repeated_passages(frame, length).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_repeats(docs, length)
    assert repeats.repeated_passages(frame.limit(0), length).collect() == []


# --- packing -----------------------------------------------------------------------------------------

def plain_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(catalog.vocabulary())
    return [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_special_tokens_in_texts_are_one_id():
    ids = np.frombuffer(packing.encode("a <|endoftext|> b", catalog.vocabulary()), "<u4").tolist()
    assert ids == plain_ids(["a <|endoftext|> b"])[0] and len(ids) == 4


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|", "|>", "a", " ", "\n", "é", "漢", "endoftext"]), max_size=8).map("".join))
def test_token_ids_with_special_tokens(text):
    assert packing.encode(text, catalog.vocabulary()) == np.array(plain_ids([text])[0], "<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab 'st\n\t\r  é²½ĀɏÀ×÷·_019.,!-\x1c\x85\xa0 漢́\U0001f600<|endoftext|>", max_size=30))
def test_token_ids_are_those_of_the_tokenizer(text):
    assert packing.encode(text, catalog.vocabulary()) == np.array(plain_ids([text])[0], "<u4").tobytes()


def check_packed(rows, docs, capacity):
    ids = {d: np.array([*i, 0], "<u4") for (d, _), i in zip(docs, plain_ids([t or "" for _, t in docs]))}
    pieces = collections.defaultdict(list)
    bins = collections.defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        bins[r.sequence_id].append(r)
    assert pieces.keys() == ids.keys()
    for doc_id, own in pieces.items():
        own.sort(key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and len(own) == -(-len(ids[doc_id]) // capacity)
        assert all(r.length == capacity for r in own[1:])
        at = 0
        for r in own:
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[doc_id][at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids[doc_id])
    for own in bins.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(bins), -(-sum(map(len, ids.values())) // capacity)


def test_packing_query(spark):
    docs = [(r.doc_id, r.text) for r in table_of(spark, "documents").collect()]
    used, least = check_packed(catalog.QUERIES["op8_best_fit_packing"](spark, SMALL).collect(), docs, packing.CAPACITY)
    assert used <= 1.01 * least + 1


def test_packing_of_odd_rows_in_many_blocks(spark):
    rng = random.Random(5)
    docs = [(k, " ".join(prose(rng, rng.randrange(30)))) for k in range(300)] + [(900, None), (901, ""), (902, "a " * 500)]
    frame = made_docs(spark, docs).withColumn("piece", F.lit("clash"))
    rows = packing.pack(frame, catalog.vocabulary(), capacity=64, block_size=50).collect()
    used, least = check_packed(rows, docs, 64)
    assert used <= 1.06 * least + 2
    twice = packing.pack(made_docs(spark, [(1, "x y"), (1, "x y"), (None, "z")]), catalog.vocabulary()).collect()
    assert len(twice) == 3 and len({r.sequence_id for r in twice}) == 1 and len({r.offset for r in twice}) == 3
    assert packing.pack(frame.limit(0), catalog.vocabulary()).collect() == []


def test_crossover_keeps_every_item_once():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 100, 200).tolist()
    best = packing.evolve(sizes, 128, [], 3, population=4, generations=4)
    assert sorted(i for b in best for i in b) == list(range(200))
    assert all(sum(sizes[i] for i in b) <= 128 for b in best)
    child = packing.cross(best, packing.evolve(sizes, 128, [], 4), sizes, 128, rng)
    assert sorted(i for b in child for i in b) == list(range(200))


# --- near duplicates ---------------------------------------------------------------------------------

def brute_components(docs, size, percent):
    sets = collections.defaultdict(set)
    for doc_id, text in docs:
        words = spaced(text)
        grams = {tuple(words[k:k + size]) for k in range(len(words) - size + 1)} or ({tuple(words)} if words else set())
        sets[doc_id] |= grams
    nodes = sorted(sets)
    pairs = []
    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                pairs.append((a, b))
    return joined(pairs, nodes), sets


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, size, percent):
    rng = random.Random(size)
    docs = []
    for base in range(25):
        words = prose(rng, rng.choice([1, 2, 4, 40, 150]))
        for copy in range(rng.randrange(1, 14)):
            edited = [f"e{rng.randrange(10**6)}" if rng.random() < 0.02 * (copy % 5) else w for w in words]
            docs.append((len(docs), " ".join(edited)))
    docs += [(1000, None), (1001, ""), (1002, " \n "), (1003, docs[0][1].upper())]
    frame = made_docs(spark, docs + [(3, docs[3][1]), (None, docs[0][1])]).withColumn("component_id", F.lit("clash"))
    rows = near_duplicates.near_duplicates(frame, size, percent).collect()
    component, sets = brute_components(docs, size, percent)
    assert len(rows) == len(docs) + 2
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (
                len(sets[r.doc_id]), component[r.doc_id], component[r.doc_id] == r.doc_id)
    assert near_duplicates.near_duplicates(frame.limit(0), size, percent).collect() == []


def crowd_of_pairs(pairs):
    """Texts alike at 0.80, each at 0.856 with one partner."""
    common = [f"c{k}" for k in range(160)]
    return [(2 * p + side, " ".join([*common, *[f"p{p}_{k}" for k in range(6)], *[f"u{p}_{side}_{k}" for k in range(14)]]))
            for p in range(pairs) for side in (0, 1)]


def groups_with_strangers(groups, size):
    """Groups alike at 0.97, each with a last text alike to its texts at 0.837, but to one of them at 0.862."""
    docs = []
    for g in range(groups):
        common = [f"c{g}_{k}" for k in range(200)]
        own = [[f"u{g}_{m}_{k}" for k in range(3)] for m in range(size)]
        texts = [common + words for words in own] + [common[:190] + own[g % size] + [f"s{g}_{k}" for k in range(21)]]
        docs += [(g * (size + 1) + m, " ".join(words)) for m, words in enumerate(texts)]
    return docs


def test_crowded_regions_are_searched_whole(spark):
    rows = near_duplicates.near_duplicates(made_docs(spark, crowd_of_pairs(150)), 1, 85).collect()
    assert {r.doc_id: r.component_id for r in rows} == {d: d // 2 * 2 for d in range(300)}


def test_partners_behind_the_closest_are_confirmed(spark):
    rows = near_duplicates.near_duplicates(made_docs(spark, groups_with_strangers(20, 60)), 1, 85).collect()
    assert {r.doc_id: r.component_id for r in rows} == {d: d // 61 * 61 for d in range(20 * 61)}


def test_near_duplicates_of_the_table(spark):
    docs = [(r.doc_id, r.text) for r in table_of(spark, "documents").collect()]
    component, _ = brute_components(docs, 3, 85)
    rows = catalog.QUERIES["op9_minhash_near_dedup"](spark, SMALL).collect()
    assert {r.doc_id: r.component_id for r in rows} == component


# --- the pipeline ------------------------------------------------------------------------------------

def test_pipeline_stages(spark):
    docs = table_of(spark, "documents")
    seen, columns = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, seen, SMALL)
        assert after.columns == columns, name
        before = {r.doc_id: r.text for r in seen.collect()}
        left = {r.doc_id: r.text for r in after.collect()}
        assert left.keys() <= before.keys()
        if name == "minhash_near_dedup":
            component, _ = brute_components(list(before.items()), 5, 80)
            assert left.keys() == {d for d in before if component[d] == d}
        if name == "benchmark_decontamination":
            assert 0 < len(before) - len(left) < len(before) / 5
        if name == "secret_scans":
            assert left.keys() == before.keys() and any(left[d] != before[d] for d in left)
        seen = spark.createDataFrame(after.collect(), docs.schema)
    rows = corpus_pipeline.STAGES[-1][1](spark, seen, SMALL).collect()
    check_packed(rows, [(r.doc_id, r.text) for r in seen.collect()], packing.CAPACITY)
