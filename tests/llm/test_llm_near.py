"""N-gram and embedding near-duplicates against brute force, and components."""

import math
import random
import re

import numpy as np
import pytest

from tierloom.llm import embedding_dedup, ngram_join
from tierloom.llm.components import components
from tierloom.llm.ngram_join import forest_of, least_matches
from tierloom.llm.words import shingle_hashes, word_hashes


def reached(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def brute_documents(rows):
    """class and number of links of each row, by comparing the shingle sets of all pairs."""
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words]
        runs = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
        sets.append(runs)
    links = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])
    ]
    class_of = reached(range(len(rows)), links)
    out = []
    for i, (id_, _) in enumerate(rows):
        ids = [rows[k][0] for k in class_of if class_of[k] == class_of[i] and rows[k][0] is not None]
        out.append((id_, min(ids) if ids and sets[i] else id_, sum(i in link for link in links)))
    return out


def documents(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows, passage = [], " ".join(rng.choices(words, k=60))
    for _ in range(40):
        own = rng.choices(words, k=rng.choice([3, 5, 30, 80, 200]))
        rows.append(" ".join(own))
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            near = own[:]
            for _ in range(rng.choice([0, 1, 2, 4, 8])):
                near[rng.randrange(len(near))] = rng.choice(words)
            rows.append(rng.choice([" ", "\n", "\t "]).join(near))
        if rng.random() < 0.3:
            rows.append(passage + " " + " ".join(rng.choices(words, k=80)))
    rows += ["Only Four words here", "only four WORDS here", "x", "x", None, "", " \n", "é é é é é é", "É é é é é é", "word " * 3000, "word " * 3001]
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_documents_as_by_brute_force(spark, seed):
    rows = documents(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = ngram_join.similar_documents(df).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in got) == sorted(brute_documents(rows))
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)


def test_a_large_group_is_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "GROUP_BLOCK", 8)
    monkeypatch.setattr(ngram_join, "TEXT_BLOCK", 8)
    rng = random.Random(5)
    base = [f"a{i}" for i in range(60)]
    rows = []
    for i in range(60):
        near = base[:]
        for k in range(rng.choice([1, 2, 3])):
            near[rng.randrange(60)] = f"b{i}.{k}"
        rows.append((i, " ".join(near)))
    got = ngram_join.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in got) == sorted(brute_documents(rows))


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    text = "one two three four five six seven"
    rows = [(1, text, "n"), (1, text, "n"), (None, text, "n"), (None, "alone in this table of few rows", "m"), (None, None, "m"), (2, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, node string").withColumnRenamed("node", "key").selectExpr("*", "key AS class_id", "key AS row")
    got = sorted(ngram_join.similar_documents(df).collect(), key=str)
    assert [tuple(r) for r in sorted(got, key=lambda r: (r.n_links, r.doc_id or 0, r.class_id or 0))] == [
        (None, None, 0, True), (None, None, 0, True), (2, 2, 0, True), (None, 1, 2, False), (1, 1, 2, True), (1, 1, 2, True),
    ]
    left = ngram_join.deduplicated(df)
    assert left.columns == df.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in left.collect()) == [(0, ""), (0, "alone in this table of few rows"), (1, text), (2, "")]


def test_no_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.similar_documents(empty).collect() == []
    assert ngram_join.deduplicated(empty).collect() == []


def test_words_and_runs():
    texts = ["A b\tc", "", "a B c", "ab c", "é É", "one two three four five six"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    words, counts = word_hashes(data, offsets)
    assert counts.tolist() == [3, 0, 3, 2, 2, 6]
    assert words[:3].tolist() == words[3:6].tolist() and words[5] == words[7] and words[8] != words[9]
    runs, n = shingle_hashes(words, counts, 5)
    assert n.tolist() == [1, 0, 1, 1, 1, 2]
    assert runs[0] == runs[1] and len(set(runs.tolist())) == 5


def test_pruning_keeps_pairs_at_the_threshold():
    least = least_matches(0.8, 1e-6)
    assert list(least) == sorted(least)
    for look, m in zip(ngram_join.LOOKS, least):
        lost = sum(math.comb(look, k) * 0.8**k * 0.2 ** (look - k) for k in range(m))
        assert lost < 1e-5


def test_forest_joins_chains():
    near = lambda i, others: np.abs(others - i) == 3
    first = forest_of(12, near)
    assert [int(x) for x in first] == [i % 3 for i in range(12)]


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 150)] + [(7, 7), (None, 3)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(41)} | {k: 100 for k in range(100, 150)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_vectors(rows):
    use = []
    for id_, v, label in rows:
        good = v is not None and label is not None and len(v) and all(c is not None and math.isfinite(c) for c in v) and any(v)
        use.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if good else None)
    links = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if use[i] is not None and use[j] is not None and rows[i][2] == rows[j][2] and len(use[i]) == len(use[j]) and use[i] @ use[j] >= 0.98
    ]
    class_of = reached(range(len(rows)), links)
    return [(rows[i][0], sum(i in link for link in links), min(rows[k][0] for k in class_of if class_of[k] == class_of[i])) for i in range(len(rows))]


def test_vectors_as_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    rng = np.random.default_rng(3)
    vectors = []
    for k in range(30):
        center = rng.normal(size=24)
        for _ in range(int(rng.choice([1, 2, 5, 40], p=[0.5, 0.2, 0.25, 0.05]))):
            vectors.append(((center + rng.normal(size=24) * 0.12 * np.linalg.norm(center) / 24**0.5).tolist(), k % 3))
    vectors += [([1.0, 0.0], 1), ([1.0, 0.01], 1), ([0.0] * 24, 1), (None, 1), (vectors[0][0], None), ([float("nan")] * 24, 0), ([None] * 24, 0), ([], 0)]
    vectors += [vectors[1], vectors[1]]
    rows = [(i, v, label) for i, (v, label) in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS node", "2 AS id")
    got = embedding_dedup.similar_vectors(df).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == sorted(brute_vectors(rows))
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_no_vectors(spark):
    assert embedding_dedup.similar_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


def test_more_vectors_get_longer_buckets():
    shapes = [embedding_dedup.shape(n) for n in (0, 100, 10**6, 10**10)]
    assert shapes == sorted(shapes)
    for bits, tables in shapes:
        assert (1 - embedding_dedup.same_cell(0.2) ** bits) ** tables <= 1e-4
