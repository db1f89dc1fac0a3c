"""Encoding, fingerprints, language, toxicity and language-model scores on small fixtures."""

import hashlib
import math
import random
import re
import types
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tierloom.llm import bpe, fingerprints, language, lm, toxicity
from tierloom.llm.common import fold_of, stored
from tierloom.llm.queries import BPE_VOCABULARY, PIECE_VOCABULARY

CASES = [
    None, "", " \n\t", "Hello, World! it's 2024 we'll", "<|endoftext|>a<|startoftext|> b<|endoftext|", "ΑΣ ΣΑΣ İstanbul ß", "a\x1cb c", "é ́x",
    "x" * 3000, "ab" * 700 + "'s", "日本語テキスト 123４", "né à　la", "🙂🙂 !!! ...", "the " * 2000,
]


def hexed(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_encoding_as_the_library_does(spark):
    library = Tokenizer.from_file(BPE_VOCABULARY)
    rng = random.Random(1)
    alphabet = "abcdeé ÀñÑß'.,!0189 \n<|>́中"
    texts = CASES + ["".join(rng.choices(alphabet, k=rng.randrange(1, 200))) for _ in range(300)]
    df = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").selectExpr("*", "1 AS n_tokens", "2 AS ids")
    for row in bpe.encoded(df, BPE_VOCABULARY, with_ids=True).collect():
        ids = library.encode(texts[row.doc_id] or "", add_special_tokens=False).ids
        assert row.ids == ids, texts[row.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hexed(" ".join(map(str, ids)))
        assert row.decoded_sha256 == hexed(library.decode(ids, skip_special_tokens=False))


def test_short_and_long_words_are_merged_alike():
    with open(BPE_VOCABULARY, encoding="utf-8") as file:
        vocabulary = bpe.Vocabulary(file.read())
    rng = random.Random(2)
    words = [bytes(rng.choices(b"aehinorst\xc3\xa9", k=rng.randrange(1, 65))) for _ in range(400)]
    for word, ids in bpe.encode_words(vocabulary, words).items():
        assert ids == bpe.encode_long(vocabulary, word)


def test_an_encoder_that_forgets_encodes_alike(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED", 3)
    with open(BPE_VOCABULARY, encoding="utf-8") as file:
        encoder = bpe.Encoder(bpe.Vocabulary(file.read()))
    before = None
    for _ in range(3):
        now = [[encoder.ids[c] for c in chunks] for chunks in encoder.chunks(["some words and <|endoftext|> more words"])]
        assert before in (None, now)
        before = now


@pytest.mark.parametrize("ranges", [1 << 20, 200])
def test_fingerprints_as_by_brute_force(spark, monkeypatch, ranges):
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", ranges)
    rng = random.Random(4)
    texts = ["".join(rng.choices("abcdefgh é🙂", k=rng.choice([0, 1, 3, 40, 700, 5000]))) for _ in range(60)] + [None, "x" * 50_000]
    rows = [(3 * i - 20, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).selectExpr("*", "1 AS place", "'p' AS print")
    got = {r.doc_id: r for r in fingerprints.fingerprints(df).collect()}
    assert len(got) == len(rows)
    for i, (id_, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        n = len(text) // 4
        changed = (text[: len(text) - n] if n else text) + following[:n]
        r = got[id_]
        own, other, next_ = (fingerprints.fingerprint(t.encode()) for t in (text, changed, following))
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(text), hexed(changed), own, other)
        assert (r.near_edited, r.near_next) == (fingerprints.likeness(own, other), fingerprints.likeness(own, next_))


def test_fingerprints_of_repeated_rows_null_ids_one_row_and_none(spark):
    schema = "doc_id long, text string"
    rows = [(None, "n" * 9), (1, "a" * 8), (1, "a" * 8), (2, "b" * 8)]
    got = sorted(fingerprints.fingerprints(spark.createDataFrame(rows, schema)).collect(), key=lambda r: r.doc_id or 0)
    assert [r.edited_sha256 for r in got] == [hexed("n" * 7 + "aa"), hexed("a" * 8), hexed("a" * 6 + "bb"), hexed("b" * 6 + "nn")]
    only, = fingerprints.fingerprints(spark.createDataFrame([(5, "abcdefgh")], schema)).collect()
    assert only.edited_sha256 == hexed("abcdefab") and only.near_next == 1
    assert fingerprints.fingerprints(spark.createDataFrame([], schema)).collect() == []


def test_rows_without_id_and_repeated_rows_fill_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", 2000)
    written = []

    def kept(df, purpose):
        written.append(stored(df, purpose))
        return written[-1]

    monkeypatch.setattr(fingerprints, "stored", kept)
    rows = [(None, f"text {i} " + "w" * 50) for i in range(200)] + [("same", "of one text " * 5)] * 200 + [(f"id{i:03}", f"other {i} " * 6) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id string, text string").repartition(5)
    got = fingerprints.fingerprints(df)
    assert got.schema["doc_id"].dataType.simpleString() == "string"
    got = got.collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    same = [r.edited_sha256 for r in got if r.doc_id == "same"]
    text = "of one text " * 5
    assert same.count(hexed(text[:45] + text[:15])) == 199
    ends = Counter(r.id for r in written[0].where("is_first").collect())
    assert ends[None] > 3 and ends["same"] > 3
    by_id = sorted((r for r in got if r.doc_id and r.doc_id != "same"), key=lambda r: r.doc_id)
    for (id_, own), (_, following), r in zip(rows[400:], rows[401:], by_id):
        n = len(own) // 4
        assert (r.doc_id, r.edited_sha256) == (id_, hexed(own[: len(own) - n] + following[:n]))


def test_likeness():
    rng = random.Random(6)
    prose = lambda n: " ".join("".join(rng.choices("etaoinshr", k=rng.randrange(2, 9))) for _ in range(n)).encode()
    a, b = prose(900), prose(900)
    near = a[:2000] + prose(10) + a[2050:]
    of = fingerprints.fingerprint
    assert fingerprints.likeness(of(a), of(a)) == 1
    assert fingerprints.likeness(of(a), of(near)) > 0.7
    assert fingerprints.likeness(of(a), of(b)) < 0.2
    assert fingerprints.likeness(of(a), of(a + a[:300])) > 0.6
    assert fingerprints.likeness(of(a), of(b"")) == 0 and of(b"") == "3::"
    lcs = lambda x, y: fingerprints._common(x, y)
    for _ in range(50):
        x, y = ("".join(rng.choices("abcd", k=rng.randrange(1, 20))) for _ in "xy")
        table = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i, c in enumerate(x):
            for j, d in enumerate(y):
                table[i + 1][j + 1] = table[i][j] + 1 if c == d else max(table[i][j + 1], table[i + 1][j])
        assert lcs(x, y) == table[-1][-1]


def all_segmentations(word, probability, longest):
    """Sum over all ways to cut ``word``, by recursion."""
    if not word:
        return 1.0
    total = 0.0
    for n in range(1, min(longest, len(word)) + 1):
        p = probability.get(word[:n], language.OUTSIDE if n == 1 else 0.0)
        if p:
            total += p * all_segmentations(word[n:], probability, longest)
    return total


def test_words_are_summed_over_all_segmentations():
    pieces = language.Pieces(PIECE_VOCABULARY)
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECE_VOCABULARY)
    names = sorted({p for p in map(model.id_to_piece, range(model.get_piece_size())) if p == p.lower() and (p.lstrip("▁").isalpha() or p == "▁")})
    longest = max(map(len, names))
    assert pieces.longest == longest and pieces.count == len(names) == 22_240
    rng = np.random.default_rng(1)
    table = np.append(rng.random(len(names)), [0, language.OUTSIDE])
    probability = dict(zip(names, table))
    for word in ["the", "straße", "zürich", "日本", "a" * 12, "information", "responsibilities"]:
        lattice = language._lattice(pieces, [word])
        _, logs = language.forward(lattice, table[:, None])
        want = all_segmentations("▁" + word, probability, longest)
        assert logs[-1, 0, 0] == pytest.approx(math.log(want), rel=1e-9)
        into = np.zeros(len(table))
        language.expected(lattice, table, np.array([3.0]), into)
        length = sum(n * len(names[i]) for i, n in enumerate(into[:-2])) + into[-1]
        assert length == pytest.approx(3 * (len(word) + 1), rel=1e-9)


def test_long_words_are_scaled():
    pieces = language.Pieces(PIECE_VOCABULARY)
    table = np.full((pieces.count + 2, 2), 1e-4)
    table[-2:] = [[0, 0], [1e-7, 1e-7]]
    _, logs = language.forward(language._lattice(pieces, ["ab" * 3000]), table)
    assert np.isfinite(logs).all() and (logs[-1] < -5000).all()


def test_long_words_teach_as_short_ones_do(monkeypatch):
    pieces = language.Pieces(PIECE_VOCABULARY)
    rng = np.random.default_rng(2)
    table = np.append(rng.random(pieces.count), [0, language.OUTSIDE])
    for word in ["information" * 4, "straßenbahn日" * 3]:
        lattice = language._lattice(pieces, [word, word])
        whole, by_steps = np.zeros(len(table)), np.zeros(len(table))
        language.expected(lattice, table, np.array([2.0, 1.0]), whole)
        with monkeypatch.context() as patch:
            patch.setattr(language, "UNSCALED", 1000)
            language.expected(lattice, table, np.array([2.0, 1.0]), by_steps)
        assert np.allclose(whole, by_steps, rtol=1e-9)
    into = np.zeros(len(table))
    language.expected(language._lattice(pieces, ["z" * 3000]), table, np.array([1.0]), into)
    assert np.isfinite(into).all() and into.sum() > 0


def test_language_of_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held_out = fold_of("doc_id", 4) == 2
    model = language.train(docs.where(~held_out), PIECE_VOCABULARY)
    got = docs.select("doc_id", "lang").join(language.predicted(docs, model, PIECE_VOCABULARY), "doc_id").where(held_out).collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.95
    cases = spark.createDataFrame([(1, None), (2, ""), (3, "123 !!"), (None, "the and of"), (5, "x" * 100_000)], "doc_id long, text string").selectExpr("*", "1 AS score", "2 AS row")
    found = {r.doc_id: r for r in language.predicted(cases, model, PIECE_VOCABULARY).collect()}
    assert [found[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and found[1].score == 0
    assert found[None].lang_pred == "en" and 0 < found[5].score <= 1
    whole = language.predicted(cases, model, PIECE_VOCABULARY, whole=True)
    assert whole.select("row.*").columns == cases.columns and whole.count() == 5
    none = language.train(docs.where("false"), PIECE_VOCABULARY)
    assert {r.lang_pred for r in language.predicted(cases, none, PIECE_VOCABULARY).collect()} == {"und"}
    assert language.predicted(cases.where("false"), model, PIECE_VOCABULARY).collect() == []


def toxic_fixture():
    """Three of ten texts are toxic; a third of those by invented words only, which all begin alike."""
    rng = random.Random(9)
    clean = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in "lnrst"]
    rows, labels = [], []
    for i in range(600):
        words = rng.choices(clean, k=rng.randrange(20, 60))
        toxic = i % 10 < 3
        if toxic:
            bad = [f"zozox{rng.choice(clean)}" for _ in range(3)] if i % 10 == 0 else rng.choices(["idiot", "moron", "scum", "loser"], k=3)
            for w in bad:
                words.insert(rng.randrange(len(words)), w)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_of_held_out_texts(spark):
    rows, truth = toxic_fixture()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, y in truth if i % 2] + [(9999, 1), (None, 1)], "doc_id long, toxic int")
    labels = labels.union(spark.createDataFrame([(i, y) for i, y in truth if i % 4 == 0], "doc_id long, toxic int"))
    model = toxicity.fit(docs, toxicity.labelled(docs, labels))
    got = {r.doc_id: r for r in toxicity.scored(docs, model).collect()}
    unseen = [(i, y) for i, y in truth if i % 4 == 2]
    assert np.mean([got[i].predicted == y for i, y in unseen]) > 0.98
    good, bad = zip(*model.accuracy)
    assert max(good) < 0.2 and max(bad) > 0.5 and len(model.parents) == toxicity.VOTERS
    cases = spark.createDataFrame([(1, None), (2, ""), (None, "you idiot moron scum"), (4, "bal " * 30_000)], "doc_id long, text string").selectExpr("*", "1 AS score", "1 AS row")
    found = {r.doc_id: r for r in toxicity.scored(cases, model).collect()}
    assert [found[i].predicted for i in (1, 2, 4)] == [0, 0, 0] and found[None].predicted == 1
    assert toxicity.scored(cases, model, whole=True).select("row.*").columns == cases.columns
    assert toxicity.scored(docs.where("false"), model).collect() == []


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a quiet day"), (2, "you idiot")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = dict(toxicity.scored(docs, toxicity.fit(docs, toxicity.labelled(docs, none))).select("doc_id", "predicted").collect())
    assert got == {1: 0, 2: 1}
    assert toxicity.fit(docs.where("false"), toxicity.labelled(docs.where("false"), none)) is not None


def test_an_id_that_very_many_rows_repeat_is_one_labelled_text(spark):
    rows, truth = toxic_fixture()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, y in truth if i % 4 != 2], "doc_id long, toxic int")
    hot = spark.range(50_000).selectExpr("0L AS doc_id", "CASE WHEN id % 2 = 0 THEN concat('idiot scum ', id) ELSE 'idiot moron' END AS text")
    sample = toxicity.labelled(docs.union(hot), labels, most=300)
    assert sample.count() == 300
    assert toxicity.labelled(docs.union(hot), labels).count() == labels.count()
    names = docs.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    assert toxicity.labelled(names, labels.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))).count() == labels.count()
    model = toxicity.fit(docs.union(hot), toxicity.labelled(docs.union(hot), labels))
    got = {r.doc_id: r.predicted for r in toxicity.scored(docs, model).collect()}
    assert np.mean([got[i] == y for i, y in truth if i % 4 == 2]) > 0.95


def test_only_near_copies_stand_for_each_other(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randrange(9, 14))) for _ in range(3000)]
    passage = rng.choices(words, k=30)
    different = [" ".join(rng.choices(words, k=60) + passage + rng.choices(words, k=60)) for _ in range(200)]
    long = rng.choices(words, k=400)
    copies = [" ".join([*long[:i], "changed", *long[i + 1 :]]) for i in range(100)]
    texts = different + copies + ["same beginning1", "same beginning2", "", "only"]
    sample = spark.createDataFrame([(t, 1) for t in texts] + [("only", 0), ("only", 1)], "text string, toxic int").repartition(3)
    left = toxicity.distinct_texts(sample).collect()
    kept = {(r.text, r.toxic) for r in left}
    assert len(kept) == len(left) and {(t, 1) for t in different} <= kept and {("only", 0), ("only", 1), ("", 1), ("same beginning1", 1)} <= kept
    assert len(kept & {(t, 1) for t in copies}) == 1
    assert toxicity.distinct_texts(sample.where("false")).collect() == []


def test_votes_as_by_brute_force():
    """Every voter by its definition: entries are looked for one after the other in every word."""
    rng = random.Random(8)
    lexicon = toxicity.Lexicon({"scumbag": 3.0, "moron": 2.6, "vile": 4.0}, {"zozo": 3.0, "zozox": 3.5, "wretch": 2.7})
    some = ["You", "are", "an", "IDIOT", "moron", "vile", "zozoxing", "zozo", "zo", "wretched", "sh*t", "tonto", "imbécile", "trottel", "day", "WHAT", "EVER", "NOW!!!", "fine?!", "@@@", "é", "7"]
    for _ in range(300):
        text = " ".join(rng.choices(some, k=rng.randrange(0, 12)))
        words = {w.lower() for w in re.split(r"[\W\d_]+", text) if w}
        want = 0
        for i, insults in enumerate(toxicity.INSULTS):
            want |= any(w in insults for w in words) << i
        for i, pattern in enumerate(toxicity.PATTERNS):
            want |= (pattern.search(text) is not None) << (4 + i)
        for entry in lexicon.words:
            want |= (entry in words) << (8 + sum(map(ord, entry)) % 3)
        for entry in lexicon.beginnings:
            want |= any(w.startswith(entry) for w in words) << (11 + sum(map(ord, entry)) % 3)
        assert lexicon.votes(text)[0] == want


def test_posterior_of_the_label_model_as_by_enumeration():
    """Given its tree and the votes' shares, the posterior is Bayes' rule over the two classes, row by row."""
    rng = np.random.default_rng(4)
    y = rng.random(3000) < 0.25
    votes = sum(np.where(rng.random(3000) < np.where(y, 0.6, 0.1), 1 << i, 0) for i in range(4))
    patterns, counts = np.unique(votes, return_counts=True)
    model, known = toxicity.LabelModel(patterns), np.full(len(patterns), -1)
    before = toxicity.LabelModel(patterns).fit(counts.astype(float), known, rounds=3)
    after = model.fit(counts.astype(float), known, rounds=4)
    for row, pattern in enumerate(patterns):
        joint = []
        for c in (0, 1):
            mass = counts * (before if c else 1 - before)
            p = (mass.sum() + 1) / (counts.sum() + 2)
            for i, parent in enumerate(model.parents):
                cell = lambda v, u: 0.25 + mass[((patterns >> i & 1) == v) & ((patterns >> parent & 1) == u if parent >= 0 else True)].sum()
                if parent >= 0:
                    u = pattern >> parent & 1
                    p *= cell(pattern >> i & 1, u) / (cell(0, u) + cell(1, u))
                else:
                    on, off = mass[(patterns >> i & 1) == 1].sum(), mass[(patterns >> i & 1) == 0].sum()
                    p *= ((on if pattern >> i & 1 else off) + 0.5) / (on + off + 1.0)
            joint.append(p)
        assert after[row] == pytest.approx(joint[1] / sum(joint), rel=1e-6)


def test_correlated_voters_count_less():
    rng = np.random.default_rng(5)
    n = 4000
    y = rng.random(n) < 0.3
    votes = np.zeros(n, np.int64)
    for i in range(3):
        votes |= np.where(rng.random(n) < np.where(y, 0.7, 0.1), 1 << i, 0)
    same = rng.random(n) < np.where(y, 0.6, 0.2)
    for i in range(3, 8):
        votes |= np.where(same, 1 << i, 0)
    known = np.where(np.arange(n) < 400, y.astype(int), -1)
    rows, counts = np.unique(np.stack([votes, known]), axis=1, return_counts=True)
    model = toxicity.LabelModel(rows[0])
    posterior = model.fit(counts.astype(float), rows[1])
    of = dict(zip(map(tuple, rows.T.tolist()), posterior))
    guess = np.array([of[int(v), -1] > 0.5 for v in votes[400:]])
    votes, same, y, n = votes[400:], same[400:], y[400:], n - 400
    odds = np.full(n, math.log(0.3 / 0.7)) + np.where(same, math.log(0.6 / 0.2), math.log(0.4 / 0.8))
    for i in range(3):
        odds += np.where(votes >> i & 1, math.log(0.7 / 0.1), math.log(0.3 / 0.9))
    assert (guess == y).mean() > ((odds > 0) == y).mean() - 0.03  # the best there can be, knowing all of the above
    assert sum(p in range(3, 8) for p in model.parents[3:8]) >= 4


def test_scores_of_texts(spark, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 300)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(-1, None), (-2, ""), (-3, " \t"), (None, "The the unseenword unseenword"), (-4, "The"), (-4, "The")], "doc_id long, text string")
    docs = docs.union(extra).selectExpr("*", "1 AS base", "2 AS n")
    train = docs.where((fold_of("doc_id", 7) != 2) & F.col("doc_id").isNotNull())
    counts = lm.counted(train)
    model = lm.trained(train, counts, rounds=1)
    got = lm.scored(docs, counts, model).collect()
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    tokens = lambda t: re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode())) + [None]
    known = Counter(t for r in train.collect() for t in tokens(r.text))
    n, v = sum(known.values()), len(known)
    want = sorted((r.doc_id is None, r.doc_id or 0, len(tokens(r.text)), sum(known[t] > 0 for t in tokens(r.text)), round(sum(math.log10((known[t] + 1) / (n + v + 1)) for t in tokens(r.text)), 6)) for r in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert {r.train_tokens for r in got} == {n}
    assert all(r.score < 0 for r in got)
    held = [r for r in got if r.doc_id is not None and r.doc_id not in {t.doc_id for t in train.select("doc_id").collect()}]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_probabilities_of_all_classes_sum_to_one(spark):
    rng = np.random.default_rng(0)
    noise = rng.random(lm.CLASSES)
    model = lm.normalised(lm.started(noise / noise.sum()))
    every = np.arange(lm.CLASSES)
    for before, second in ((lm.START, lm.START), (5, lm.START), (7, 1000)):
        logs = model.logs(every, np.full(lm.CLASSES, before), np.full(lm.CLASSES, second))
        assert np.exp(logs).sum() == pytest.approx(1, abs=1e-9)
    before, second = lm.contexts(np.array([4, 0, 0, 5, 6, 0]), np.array([2, 1, 3]))
    assert before.tolist() == [lm.START, 4, lm.START, lm.START, 5, 6]
    assert second.tolist() == [lm.START, lm.START, lm.START, lm.START, lm.START, 5]


def test_weights_are_updated_once_for_2048_tokens(monkeypatch):
    import pyspark

    sizes = []
    monkeypatch.setattr(lm.Trainer, "step", lambda self, token, before, second: sizes.append(len(token)))
    monkeypatch.setattr(pyspark.TaskContext, "get", lambda: types.SimpleNamespace(partitionId=lambda: 0))
    noise = np.full(lm.CLASSES, 1 / lm.CLASSES)
    run = lm._trained(lm.started(noise).flat(), noise, 0)
    classes = np.array([1] * 8191 + [lm.END], np.int16).tobytes()
    list(run(iter([pa.RecordBatch.from_arrays([pa.array([classes], pa.binary())], ["classes"])])))
    assert sizes == [2048] * 4


def test_scores_without_training_texts_or_documents(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    counts = lm.counted(docs.where("false"))
    model = lm.trained(docs.where("false"), counts, rounds=1)
    got = lm.scored(docs, counts, model).orderBy("doc_id").collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got] == [(3, 0, 0, 0.0), (1, 0, 0, 0.0)]
    assert lm.scored(docs.where("false"), counts, model).collect() == []
    assert public_tokenizers.path("x")
