"""Packing, conversation repair and collocations against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tierloom.llm import collocations, conversations, packing

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, ids string, `group` long, place int, n string"


# packing -----------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(BYTE_BPE)


ODD_TEXTS = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a   b", "a \nb", "a\n b", "a\n\n b", "\n \n", "x\t y", " \n", "\n ", "it's we'll 12 3½ --", "a  b  c",
    "<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|>b <|endoftext", "　 全角 文字", "é \U0001f600 x", "՘ z", "tab\tend\t", " lead", "trail ", "é" * 5, "a\x1c b", "\x85 x",
]


def test_ids_are_the_library_s(tokenizer):
    parts = packing._parts_of(BYTE_BPE)
    rng = random.Random(5)
    made = ["".join(rng.choice(["a", "Wort", " ", " ", "  ", "\n", "\t", ".", "’s", "'s", "7", " ", "ß", "<|endoftext|>"]) for _ in range(rng.randrange(30))) for _ in range(400)]
    for text in ODD_TEXTS + made:
        ids = np.frombuffer(packing.token_bytes(text, parts), "<u4").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_long_texts_are_tokenised_in_steps(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "STEP", 7)
    text = "some words of a text, and more. " * 20 + "end"
    assert np.frombuffer(packing.token_bytes(text, packing._parts_of(BYTE_BPE)), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def plain_first_fit(lengths, size):
    free, out = [], []
    for n in lengths:
        place = next((i for i, f in enumerate(free) if f >= n), len(free))
        if place == len(free):
            free.append(size)
        free[place] -= n
        out.append(place)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_the_tree_finds_the_first_that_fits(seed):
    rng = random.Random(seed)
    lengths = sorted((rng.randrange(1, 65) for _ in range(rng.randrange(1, 200))), reverse=True)
    assert packing.first_fit(lengths, 64) == plain_first_fit(lengths, 64)


@pytest.mark.parametrize("lengths", [[], [64], [1], [40] * 9, [33] * 64, list(range(64, 0, -1))])
def test_one_gap_in_a_group(lengths):
    fill, seen = Counter(), defaultdict(list)
    for piece, start, n, number, offset in packing.packed_group(lengths, 64):
        assert n > 0 and offset == fill[number]
        fill[number] += n
        seen[piece].append((start, n))
    assert sum(f < 64 for f in fill.values()) <= 1 and max(fill.values(), default=0) <= 64
    for piece, n in enumerate(lengths):
        upto = 0
        for start, some in sorted(seen[piece]):
            assert start == upto
            upto += some
        assert upto == n


def checked_pieces(rows, docs, tokenizer, size):
    """Every id in one piece, sequences without gaps."""
    wanted = Counter((i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [0])) for i, t in docs)
    by_sequence = defaultdict(list)
    ids_of = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert len(ids) == r.length
        ids_of[r.id, r.doc_tokens].append((r.start, ids))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= size
    for (i, total), pieces in ids_of.items():
        mine = Counter({ids: c for (d, ids), c in wanted.items() if d == i and len(ids) == total})
        if sum(mine.values()) == 1:
            assert sum((ids for _, ids in sorted(pieces)), []) == list(next(iter(mine)))
        assert sum(len(ids) for _, ids in pieces) == total * sum(mine.values())
    assert {k[0] for k in ids_of} == {i for i, _ in docs}
    return [sum(n for _, n in pieces) for pieces in by_sequence.values()]


def test_documents_are_packed_whole(spark, tokenizer):
    rng = random.Random(1)
    docs = [(i, " ".join(rng.choice(["alpha", "beta.", "Γάμμα", "12"]) for _ in range(rng.randrange(120)))) for i in range(300)]
    docs += [(None, None), (1000, ""), (1001, None), (1002, "long " * 5000)] + [(7777, "the same row")] * 200
    rows = [(i, t, "en", "x", 1, 2, "y") for i, t in docs]
    result = packing.packed(spark.createDataFrame(rows, DOCS).repartition(4), BYTE_BPE, size=64, group_tokens=2000)
    fills = checked_pieces(result.collect(), docs, tokenizer, 64)
    groups = -(-sum(fills) // 2000)
    assert sum(f < 64 for f in fills) <= groups + 1


def test_packing_nothing(spark):
    assert packing.packed(spark.createDataFrame([], DOCS), BYTE_BPE).collect() == []


def test_packing_keeps_the_type_of_ids(spark):
    result = packing.packed(spark.createDataFrame([("a", "text"), ("b", None)], "doc_id string, text string"), BYTE_BPE)
    assert {r.id for r in result.collect()} == {"a", "b"}


# conversations ------------------------------------------------------------------------------------------------------

CONVERSATIONS = "conv_id long, turn long, role string, text string, conv string, chunk string, h1 string"
WHITE = " \t\n\x0b\x0c\r"


def brute_damage(rows):
    out = []
    for c, t, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(c, t, role, text)] * (2 if kind == 3 else 1)
    return out


def brute_report(rows):
    """All fields of one conversation, by a plain search over suffixes."""
    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.strip(WHITE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    emit = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    @lru_cache(None)
    def best(i, state, inserted):
        options = []
        if i == len(rows) and state in ("", "a"):
            options.append((0, "", ()))
        if inserted < 3:
            cost, audit, lines = best(i, emit[state], inserted + 1)
            options.append((cost + 3, "I" + audit, ((names[emit[state]], ""), *lines)))
        if i < len(rows):
            _, _, role, text = rows[i]
            cost, audit, lines = best(i + 1, state, 0)
            options.append((cost + 4, "D" + audit, lines))
            if faults[i] not in ("blank", "duplicate"):
                cut = 3 * (faults[i] == "truncated")
                cost, audit, lines = best(i + 1, emit[state], 0)
                options.append((cost + 3 + cut, "R" + audit, ((names[emit[state]], text), *lines)))
                initial = role[:1]
                if initial == emit[state] or (state == "" and initial == "s"):
                    cost, audit, lines = best(i + 1, initial, 0)
                    options.append((cost + cut, "K" + audit, ((role, text), *lines)))
        return min(options, default=(10**9, "", ()))

    cost, audit, lines = best(0, "", 0)
    turns = {r[1] for r in rows if r[1] is not None}
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:])]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(p not in ("su", "ua", "au") for p in pairs), "cost": cost, "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest(),
    }


def brute_reports(original, rows, key):
    out = {}
    for conv in {r[0] for r in original}:
        mine = sorted((r for r in rows if r[0] == conv), key=key)
        out[conv] = brute_report(mine) if mine else {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    return out


def conversation_rows(rng, conversations_, most):
    rows = []
    for c in range(conversations_):
        for t in range(rng.randrange(1, most)):
            role = rng.choice(["user", "user", "assistant", "assistant", "system", "tool", "", None, "unicorn"])
            text = rng.choice(["Yes.", "No", "What now?", "", " \t", None, "so!  ", "a . b", f"reply {rng.randrange(9)}."])
            rows.append((c if c else None, None if t == 3 else t + 2 * (t > 4), role, text))
    return rows


@pytest.mark.parametrize("chunk,passes", [(4096, 4), (2, 4), (1, 0), (3, 1)])
def test_reports_equal_brute_force(spark, chunk, passes):
    rows = conversation_rows(random.Random(chunk), 60, 12)
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], CONVERSATIONS)
    report, _ = conversations.repaired(conversations.damaged(df), chunk=chunk, passes=passes)
    found = {r.conv: r.asDict() for r in report.collect()}
    damaged = brute_damage(rows)
    wanted = brute_reports(rows, damaged, lambda r: (r[1] is not None, r[1] or 0))
    for conv, want in wanted.items():
        if any(r[0] == conv for r in damaged):
            assert {k: found[conv][k] for k in want} == want, conv


@pytest.mark.parametrize("role", ["user", "assistant", "both"])
def test_costs_that_never_converge(spark, role):
    rows = [(1, t, role if role != "both" else ("user" if t % 2 else "assistant"), f"text {t}.") for t in range(37)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = brute_report(rows)
    for passes in (0, 2, 50):
        report, lines = conversations.repaired(df, chunk=2, passes=passes)
        found = report.collect()[0].asDict()
        assert {k: found[k] for k in want} == want
    roles = "".join(r.role[0] for r in lines.orderBy("chunk", "seq").collect())
    assert re.fullmatch("(s?(ua)+)?", roles)


def test_repeated_rows_of_a_long_conversation(spark):
    rows = [(1, 0, "user", "Hello.")] * 60 + [(1, 1, "assistant", "Hi.")] * 3 + [(1, 2, "user", "Hello.")] * 20
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    found = conversations.repaired(df)[0].collect()[0]
    want = brute_report(rows)
    assert {k: found[k] for k in want} == want


def test_every_conversation_is_reported(spark):
    rows = [(c, t, "user", "Hm.") for c in range(40) for t in range(1)] + [(None, 0, "user", "x.")]
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], CONVERSATIONS)
    found = {r.conv_id: r.asDict() for r in conversations.audited(df, conversations.damaged(df)).collect()}
    wanted = brute_reports(rows, brute_damage(rows), lambda r: r[1])
    assert any(w["audit"] == "" for w in wanted.values())
    assert found == {c: {"conv_id": c, **w} for c, w in wanted.items()}
    empty = df.limit(0)
    assert conversations.audited(empty, conversations.damaged(empty)).collect() == []


def test_conversation_ids_of_text(spark):
    df = spark.createDataFrame([("a", 0, "user", "Hi."), ("a", 1, "assistant", "Ho.")], "conv_id string, turn int, role string, text string")
    assert [(r.conv_id, r.audit) for r in conversations.audited(df, df).collect()] == [("a", "KK")]


# collocations -------------------------------------------------------------------------------------------------------


def brute_collocations(docs, least, top):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i : i + k])) for k in range(1, 6) for i in range(len(words) - k + 1))
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    inside = defaultdict(int)
    for (lang, w), a in candidates.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                inside[lang, w[i : i + k]] = max(inside[lang, w[i : i + k]], a)
    rows = defaultdict(list)
    for (lang, w), a in candidates.items():
        score, _, l, r = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        if inside[lang, w] < a:
            rows[lang].append((-score, -a, " ".join(w).encode(), l, r))
    return {(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, found in rows.items() for i, (s, a, p, l, r) in enumerate(sorted(found)[:top])}


def made_docs(rng, size):
    words = ["alpha", "Beta", "gamma", "délta", "E", "zeta-eta", "ß", "中文", "o'neill", "x"]
    fixed = "the quick brown fox jumps over the lazy dog and runs far away from here"
    docs = []
    for i in range(size):
        parts = []
        for _ in range(rng.randrange(12)):
            parts.append(rng.choice([fixed, fixed[: rng.randrange(len(fixed))], " ".join(rng.choices(words, k=rng.randrange(14)))]))
        text = "".join(p + rng.choice([". ", ", ", "\n", "\r\n", " ", "  \t", "!? ", "\x0b"]) for p in parts)
        docs.append((rng.choice(["en", "fr", None, "und"]), rng.choice([text] * 9 + [None, ""])))
    return docs + [("en", "same same same same same same same same same " * 9)] * 30


@pytest.mark.parametrize("period,bits", [(32, 26), (2, 15), (5, 16)])
def test_collocations_equal_brute_force(spark, period, bits):
    docs = made_docs(random.Random(period), 250)
    df = spark.createDataFrame([(i, t, lang, "x", 1, 2, "y") for i, (lang, t) in enumerate(docs)], DOCS).repartition(4)
    found = collocations.collocations(df, least=12, top=150, period=period, bits=bits).collect()
    assert {tuple(r) for r in found} == brute_collocations(docs, 12, 150)
    assert len(found) == len({(r.lang, r.rank) for r in found})


def test_chunks_hold_every_phrase_once():
    rng = random.Random(3)
    texts = [t for _, t in made_docs(rng, 60)]
    for period in (1, 3, 1000):
        counts = Counter()
        for i, closed, chunk, n in collocations.chunks_of(texts, period):
            words = re.findall(rb"[^ \n]+[ \n]", chunk)
            assert len(words) == n
            for k in range(n if closed else n - collocations.OVERLAP):
                for size in range(1, 6):
                    if k + size <= n and not any(w.endswith(b"\n") for w in words[k : k + size - 1]):
                        counts[i, size] += 1
        for i, text in enumerate(texts):
            pieces = [len(re.findall(r"[^\x20\x09]+", p)) for p in re.split("[.,;:!?\n-\r]", text or "")]
            for size in range(1, 6):
                assert counts[i, size] == sum(max(0, p - size + 1) for p in pieces)


def test_equal_passages_are_cut_alike():
    passage = " ".join(f"w{k}" for k in range(400))
    one = {c for _, closed, c, _ in collocations.chunks_of([passage]) if not closed}
    two = {c for _, closed, c, _ in collocations.chunks_of(["other words before " + passage + " and after"]) if not closed}
    assert len(one & two) >= len(one) - 2


def test_no_collocations(spark):
    for rows in ([], [(1, None, None, "x", 1, 2, "y"), (2, " .,\n", "en", "x", 1, 2, "y")]):
        assert collocations.collocations(spark.createDataFrame(rows, DOCS)).collect() == []
