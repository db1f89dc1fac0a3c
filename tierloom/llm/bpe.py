"""Byte-pair encoding and decoding with a public vocabulary, by a segment tree over the ranks of adjacent pairs.

The leaves of the tree are the ranks of a word's adjacent pairs, each with its place; an inner node holds the smaller
of its two. The root is so the leftmost pair of lowest rank. Merging it changes three leaves (the pair that is gone and
its two neighbours) and the nodes above them, a logarithmic number, until the root holds no pair. Short words are done
many at a time, a row of one array each; long ones alone.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.llm.common import slices_by_bytes

#: The splitting pattern and white space of the vocabulary's pre-tokenizer.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
#: Characters that str.split() takes for white space and the pre-tokenizer does not.
NO_SPACE = "\x1c\x1d\x1e\x1f"
#: Words of up to so many bytes are done together, and so many at once.
SHORT, TOGETHER = 64, 8192
#: Entries of a task's cache of encoded chunks, and their longest length.
CACHED, CACHED_LENGTH = 400_000, 64
NO_PAIR = np.int32(2**30)


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself if printable in Latin-1, else one from 256 on."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b if b in kept else extra))
        extra += b not in kept
    return out


class Vocabulary:
    """Ids, merges and special tokens of a tokenizer file with byte-level symbols and a word-end suffix."""

    def __init__(self, text: str):
        file = json.loads(text)
        model = file["model"]
        suffix = model["end_of_word_suffix"]
        ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.tokens = {i: t for t, i in [*ids.items(), *self.special.items()]}
        symbols = byte_characters()
        self.inner = np.array([ids[c] for c in symbols], np.int32)
        self.last = np.array([ids[c + suffix] for c in symbols], np.int32)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = {(ids[a], ids[b]): r for r, (a, b) in reversed([*enumerate(merges)])}
        self.merged = np.array([ids[a + b] for a, b in merges], np.int32)
        pairs = np.array([(a << 20) | b for a, b in self.rank], np.int64)
        order = np.argsort(pairs)
        self.pairs = pairs[order]
        self.ranks = np.array([*self.rank.values()], np.int32)[order]
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, NO_PAIR where it does not merge."""
        keys = (a.astype(np.int64) << 20) | b
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where(self.pairs[at] == keys, self.ranks[at], NO_PAIR)


def encode_long(vocabulary: Vocabulary, word: bytes) -> list[int]:
    """Ids of one word of any length."""
    n = len(word)
    symbols = [*vocabulary.inner[np.frombuffer(word, np.uint8)].tolist()]
    symbols[-1] = int(vocabulary.last[word[-1]])
    none = (int(NO_PAIR), n)
    size = 1 << max(0, n - 1).bit_length()
    tree = [none] * (2 * size)
    rank, merged = vocabulary.rank, vocabulary.merged
    for i in range(n - 1):
        r = rank.get((symbols[i], symbols[i + 1]))
        if r is not None:
            tree[size + i] = (r, i)
    for k in range(size - 1, 0, -1):
        tree[k] = min(tree[2 * k], tree[2 * k + 1])

    def put(i: int, value: tuple[int, int]) -> None:
        k = size + i
        tree[k] = value
        while k > 1:
            k >>= 1
            value = min(tree[2 * k], tree[2 * k + 1])
            if tree[k] == value:
                break
            tree[k] = value

    after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
    while tree[1] is not none and tree[1][0] < NO_PAIR:
        r, i = tree[1]
        gone = after[i]
        symbols[i] = int(merged[r])
        following = after[i] = after[gone]
        put(gone, none)
        symbols[gone] = -1
        if following < n:
            before[following] = i
        r = rank.get((symbols[i], symbols[following])) if following < n else None
        put(i, none if r is None else (r, i))
        if (previous := before[i]) >= 0:
            r = rank.get((symbols[previous], symbols[i]))
            put(previous, none if r is None else (r, previous))
    return [s for s in symbols if s >= 0]


def encode_short(vocabulary: Vocabulary, words: list[bytes]) -> list[list[int]]:
    """Ids of words of at most ``SHORT`` bytes, all merged in step."""
    n = len(words)
    lengths = np.array([len(w) for w in words])
    size = max(2, 1 << int(lengths.max() - 1).bit_length())
    shift = size.bit_length() - 1
    inside = np.arange(size)[None, :] < lengths[:, None]
    data = np.zeros((n, size), np.uint8)
    data[inside] = np.frombuffer(b"".join(words), np.uint8)
    symbols = np.where(inside, vocabulary.inner[data], np.int32(-1))
    every = np.arange(n)
    symbols[every, lengths - 1] = vocabulary.last[data[every, lengths - 1]]
    # one more column on each side of the links: place `size` is "none after", -1 wraps to it
    after = np.tile(np.arange(1, size + 2, dtype=np.int32), (n, 1))
    after = np.where(after < lengths[:, None], after, size).astype(np.int32)
    before = np.tile(np.arange(-1, size, dtype=np.int32), (n, 1))
    tree = np.full((n, 2 * size), NO_PAIR, np.int32)
    ranks = vocabulary.ranks_of(symbols[:, :-1], np.maximum(symbols[:, 1:], 0))
    ranks = np.where(inside[:, 1:] & (ranks < NO_PAIR), (ranks << shift) | np.arange(size - 1, dtype=np.int32), NO_PAIR)
    tree[:, size : 2 * size - 1] = ranks
    level = size
    while level > 1:
        tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
        level //= 2

    def put(rows: np.ndarray, places: np.ndarray, values: np.ndarray) -> None:
        k = places + size
        tree[rows, k] = values
        while k[0] > 1:
            values = np.minimum(values, tree[rows, k ^ 1])
            k = k >> 1
            tree[rows, k] = values

    rows = np.flatnonzero(tree[:, 1] < NO_PAIR)
    while len(rows):
        root = tree[rows, 1]
        at, rank = root & (size - 1), root >> shift
        gone = after[rows, at]
        now = vocabulary.merged[rank]
        symbols[rows, at] = now
        symbols[rows, gone] = -1
        following = after[rows, gone]
        after[rows, at] = following
        before[rows, following] = at
        put(rows, gone, np.full(len(rows), NO_PAIR))
        has = following < size
        right = np.where(has, symbols[rows, np.where(has, following, 0)], 0)
        r = vocabulary.ranks_of(now, right)
        put(rows, at, np.where(has & (r < NO_PAIR), (r << shift) | at, NO_PAIR).astype(np.int32))
        previous = before[rows, at]
        has = previous >= 0
        if has.any():
            some, place = rows[has], previous[has]
            r = vocabulary.ranks_of(symbols[some, place], now[has])
            put(some, place, np.where(r < NO_PAIR, (r << shift) | place, NO_PAIR).astype(np.int32))
        rows = rows[tree[rows, 1] < NO_PAIR]
    kept = symbols >= 0
    flat = symbols[kept].tolist()
    ends = np.cumsum(kept.sum(axis=1)).tolist()
    return [flat[a:b] for a, b in zip([0, *ends], ends)]


def encode_words(vocabulary: Vocabulary, words: Iterable[bytes]) -> dict[bytes, list[int]]:
    out: dict[bytes, list[int]] = {}
    short: dict[int, list[bytes]] = {}
    for word in words:
        if len(word) > SHORT:
            out[word] = encode_long(vocabulary, word)
        else:
            short.setdefault((len(word) - 1).bit_length(), []).append(word)
    for same in short.values():
        for k in range(0, len(same), TOGETHER):
            some = same[k : k + TOGETHER]
            out.update(zip(some, encode_short(vocabulary, some)))
    return out


class Encoder:
    """Encodes texts as the tokenizers library does, remembering the chunks between white space it has met."""

    def __init__(self, vocabulary: Vocabulary, with_ids: bool = False):
        self.vocabulary = vocabulary
        self.with_ids = with_ids
        self.ids: dict[str, str] = {}
        self.binary: dict[str, bytes] = {}
        self.decoded: dict[str, str] = {}
        for token, i in vocabulary.special.items():
            self._keep("\n" + token, [i])

    def _keep(self, chunk: str, ids: list[int]) -> None:
        self.ids[chunk] = " ".join(map(str, ids))
        if self.with_ids:
            self.binary[chunk] = np.array(ids, np.int32).tobytes()
        self.decoded[chunk] = decode(self.vocabulary, ids)

    def _chunks(self, text: str) -> list[str]:
        """Parts between white space; a special token is a part of its own, told from text by a line end before it."""
        special = self.vocabulary.split_special
        if special and "<|" in text:
            parts = special.split(text)
            if len(parts) > 1:
                return [c for k, part in enumerate(parts) for c in (["\n" + part] if k % 2 else self._chunks(part))]
        if any(c in text for c in NO_SPACE):
            return [c for c in SPACE.split(text) if c]
        return text.split()

    def chunks(self, texts: list[str]) -> list[list[str]]:
        """Chunks of each text, all of them known from now on."""
        if len(self.ids) > CACHED:
            for kept in (self.ids, self.binary, self.decoded):
                special = {k: v for k, v in kept.items() if k[0] == "\n"}
                kept.clear()
                kept.update(special)
        split = [self._chunks(t) for t in texts]
        known = self.ids
        new = {c for chunks in split for c in chunks if c not in known}
        pieces = {c: [p.encode("utf-8") for p in PIECES.findall(normalized(c))] for c in new}
        words = encode_words(self.vocabulary, {p for ps in pieces.values() for p in ps})
        for c, ps in pieces.items():
            self._keep(c, [i for p in ps for i in words[p]])
        return split

    def forget_long(self) -> None:
        for c in [c for c in self.ids if len(c) > CACHED_LENGTH]:
            del self.ids[c], self.decoded[c]
            self.binary.pop(c, None)


def normalized(chunk: str) -> str:
    """Composed and lowered; every character is lowered by itself."""
    if chunk.isascii():
        return chunk.lower()
    return unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()


def decode(vocabulary: Vocabulary, ids: Iterable[int]) -> str:
    """The tokens of ``ids`` joined by one space, as a tokenizer file without a decoder does."""
    return " ".join([vocabulary.tokens[i] for i in ids])


@functools.lru_cache(maxsize=2)
def _vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        return Vocabulary(file.read())


@functools.lru_cache(maxsize=2)
def _shipped(name: str) -> Vocabulary:
    return _vocabulary(SparkFiles.get(name))


OUTPUT = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _encoded(name: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(_shipped(name), with_ids)
        hexed = lambda s: hashlib.sha256(s.encode("utf-8")).hexdigest()
        for batch in batches:
            for start, stop in slices_by_bytes(batch.column(1)):
                split = encoder.chunks([t or "" for t in batch.column(1).slice(start, stop - start).to_pylist()])
                counts, ids_hash, text_hash, ids = [], [], [], []
                for chunks in split:
                    joined = " ".join([encoder.ids[c] for c in chunks])
                    counts.append(joined.count(" ") + 1 if joined else 0)
                    ids_hash.append(hexed(joined))
                    text_hash.append(hexed(" ".join([encoder.decoded[c] for c in chunks])))
                    if with_ids:
                        ids.append(b"".join([encoder.binary[c] for c in chunks]))
                out = [batch.column(0).slice(start, stop - start), pa.array(counts, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())]
                names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                    out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)
                encoder.forget_long()

    return run


def encoded(docs: DataFrame, vocabulary_path: str, id_column: str = "doc_id", text_column: str = "text", with_ids: bool = False) -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256`` (and ``ids array<int>``) for every row of ``docs``.

    Encodes whole texts with the tokenizer file at ``vocabulary_path`` (on the driver; Spark ships it), without added
    special tokens; those that stand in a text are their own ids. Then decodes the ids again.

    * NULL, empty and blank texts have no tokens: count 0 and the hashes of the empty string.
    * Long texts, and long words, are encoded whole. Repeated rows and NULL ids give a row each.
    * Other columns are ignored.
    """
    name = vocabulary_path.rsplit("/", 1)[-1]
    docs.sparkSession.sparkContext.addFile(vocabulary_path)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    out = rows.mapInArrow(_encoded(name, with_ids), OUTPUT + (", ids array<int>" if with_ids else ""))
    return out.withColumnRenamed("id", id_column)
