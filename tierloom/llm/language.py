"""Language of texts by segmentation-marginalised unigrams.

Each language has probabilities for the pieces of a fixed public vocabulary. The probability of a word is the sum over all ways to
cut it into pieces, by the forward algorithm; that of a text is the product over its words. Piece probabilities are
learned by expectation-maximisation over the word counts of each language, which stay distributed.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tierloom.llm.common import carried, slices_by_bytes, stored
from tierloom.llm.words import mix

LETTERS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
#: Rounds of expectation-maximisation; added to the count of each piece.
ROUNDS, ADDED = 2, 0.1
#: Pieces in the vocabulary that a character outside it is as likely as one of.
OUTSIDE = 1e-7
#: Characters of the words that are cut together.
TOGETHER = 100_000
#: Characters up to which probabilities of words need no scaling.
UNSCALED = 32
#: Pieces of up to so many characters end nearly everywhere; longer ones are looked for word by word.
FREQUENT = 2
CACHED = 300_000
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: Low bits of a hash that tell most strings which are no piece.
_SEEN_BITS = 20
_SEEN_MASK = np.uint64((1 << _SEEN_BITS) - 1)


class Pieces:
    """Lower-case pieces of letters of the vocabulary, found by the hash of their characters."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = (model.id_to_piece(i) for i in range(model.get_piece_size()))
        chosen = sorted({p for p in every if p == p.lower() and (p.lstrip("▁").isalpha() or p == "▁")})
        hashes = np.array([_hash(p) for p in chosen], np.uint64)
        order = np.argsort(hashes)
        self.count, self.hashes, self.number = len(chosen), hashes[order], order.astype(np.int32)
        self.longest = max(map(len, chosen))
        self._seen = np.zeros(1 << _SEEN_BITS, bool)
        self._seen[(hashes & _SEEN_MASK).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each piece, ``count`` for none."""
        found = np.full(hashes.shape, self.count, np.int32)
        likely = np.nonzero(self._seen[(hashes & _SEEN_MASK).astype(np.int64)])
        some = hashes[likely]
        at = np.minimum(np.searchsorted(self.hashes, some), self.count - 1)
        found[likely] = np.where(self.hashes[at] == some, self.number[at], self.count)
        return found


def _hash(piece: str) -> int:
    h = np.zeros(1, np.uint64)
    for c in piece:
        h = h * _FACTOR + np.uint64(ord(c) + 1)
    return int(mix(h + np.uint64(len(piece)))[0])


def _lattice(pieces: Pieces, words: list[str]) -> list[np.ndarray]:
    """For each piece length, the piece that ends at each character of each word; words of one length."""
    codes = np.frombuffer("".join("▁" + w for w in words).encode("utf-32-le"), np.uint32).reshape(len(words), -1).astype(np.uint64) + np.uint64(1)
    out, h = [], np.zeros_like(codes)
    for size in range(1, min(pieces.longest, codes.shape[1]) + 1):
        h[:, 1:] = h[:, :-1]
        h[:, 0] = 0
        h = h * _FACTOR + codes
        found = np.full(codes.shape, pieces.count, np.int32)
        found[:, size - 1 :] = pieces.find(mix(h[:, size - 1 :] + np.uint64(size)))
        out.append(found)
    # a character that is no piece is one of its own; its place in the tables comes after "none"
    out[0] = np.where(out[0] == pieces.count, pieces.count + 1, out[0])
    return out


def forward(lattice: list[np.ndarray], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of the first t characters of each word in each language, over all ways to cut them, for every t.

    ``table`` is [piece, language]; its last two rows are those of no piece (0) and of an unknown character. Returns [t, word, language] and
    the logarithms; probabilities of words longer than ``UNSCALED`` are scaled to 1 step by step, as they would vanish.
    """
    n, length = lattice[0].shape
    scaled = length > UNSCALED
    sums = np.zeros((length + 1, n, table.shape[1]))
    logs = np.zeros((length + 1, n, table.shape[1])) if scaled else None
    sums[0] = 1
    ending = _ending(lattice, len(table) - 2)
    for t in range(1, length + 1):
        for size, rows, found in ending(t):
            term = sums[t - size][rows] * table[found]
            sums[t][rows] += term * np.exp(logs[t - size][rows] - logs[t - 1][rows]) if scaled else term
        if scaled:
            logs[t] = logs[t - 1] + np.log(sums[t])
            sums[t] = 1
    return sums, logs if scaled else np.log(sums)


def _ending(lattice: list[np.ndarray], none: int):
    """For a place t, the sizes of pieces that end there, with the words that have one and its number."""
    there = [(found != none).any(axis=0).tolist() for found in lattice]

    def at(t: int) -> Iterator[tuple[int, np.ndarray | slice, np.ndarray]]:
        for size in range(1, min(t, len(lattice)) + 1):
            if there[size - 1][t - 1]:
                found = lattice[size - 1][:, t - 1]
                if size <= FREQUENT:
                    yield size, slice(None), found
                else:
                    rows = np.flatnonzero(found != none)
                    yield size, rows, found[rows]

    return at


def expected(lattice: list[np.ndarray], table: np.ndarray, counts: np.ndarray, into: np.ndarray) -> None:
    """Add to ``into`` how often each piece is expected in words that occur ``counts`` times; one language's ``table``.

    Goes back over the words with the expected number of cuts at each place, of which a piece takes its share. Shares are
    ratios of neighbouring forward sums, so words of any length need no further scaling.
    """
    n, length = lattice[0].shape
    logs = forward(lattice, table[:, None])[1][:, :, 0]
    cuts = np.zeros((length + 1, n))
    cuts[length] = counts
    ending = _ending(lattice, len(table) - 2)
    for t in range(length, 0, -1):
        for size, rows, found in ending(t):
            share = cuts[t][rows] * table[found] * np.exp(logs[t - size][rows] - logs[t][rows])
            cuts[t - size][rows] += share
            into += np.bincount(found, weights=share, minlength=len(into))


def by_length(words: list[str]) -> Iterator[list[int]]:
    """Indexes of words of equal length, no more than ``TOGETHER`` characters at a time."""
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w), []).append(i)
    for length, rows in groups.items():
        step = max(1, TOGETHER // (length + 1))
        for k in range(0, len(rows), step):
            yield rows[k : k + step]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word counts of each language, a part of the texts at a time."""
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for start, stop in slices_by_bytes(batch.column(1), 16 << 20):
            counts: dict[str, Counter] = {}
            for lang, text in zip(langs[start:stop], batch.column(1).slice(start, stop - start)):
                counts.setdefault(lang, Counter()).update(LETTERS.findall((text.as_py() or "").lower()))
            for lang, words in counts.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(words), pa.string()), pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], ["lang", "word", "n"]
                )


@functools.lru_cache(maxsize=2)
def _pieces(name: str) -> Pieces:
    return Pieces(SparkFiles.get(name))


def _expectations(name: str, tables: dict[str, np.ndarray] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(name)
        first = np.full(pieces.count + 2, 1 / pieces.count)
        first[-2:] = 0, OUTSIDE
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, words, counts = (c.to_pylist() for c in batch.columns)
            rows: dict[str, list[tuple[str, int]]] = {}
            for lang, word, n in zip(langs, words, counts):
                rows.setdefault(lang, []).append((word, n))
            for lang, pairs in rows.items():
                into = sums.setdefault(lang, np.zeros(pieces.count + 2))
                table = tables[lang] if tables else first
                for some in by_length([w for w, _ in pairs]):
                    expected(_lattice(pieces, [pairs[i][0] for i in some]), table, np.array([pairs[i][1] for i in some], np.float64), into)
        for lang, total in sums.items():
            some = np.flatnonzero(total[: pieces.count])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some, pa.int32()), pa.array(total[some])], ["lang", "piece", "n"])

    return run


def train(docs: DataFrame, vocabulary_path: str, text_column: str = "text", lang_column: str = "lang", rounds: int = ROUNDS) -> dict[str, tuple[float, np.ndarray]]:
    """For each language of ``docs``, its share of them and its piece probabilities. Rows without language or text teach nothing.

    Words of any length are learned from whole, by all pieces. The driver holds the vocabulary once for each language.
    """
    name = vocabulary_path.rsplit("/", 1)[-1]
    docs.sparkSession.sparkContext.addFile(vocabulary_path)
    rows = docs.select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    words = rows.mapInArrow(_counted, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = stored(words, "words")
    shares = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not shares:
        return {}
    size = Pieces(vocabulary_path).count
    tables = None
    for _ in range(rounds):
        counts = words.mapInArrow(_expectations(name, tables), "lang string, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
        learned = {lang: np.full(size + 2, ADDED) for lang in shares}
        for lang, some in counts.toPandas().groupby("lang"):
            learned[lang][some["piece"].to_numpy()] += some["n"].to_numpy()
        tables = {}
        for lang, n in learned.items():
            n[:size] /= n[:size].sum()
            n[size:] = 0, OUTSIDE
            tables[lang] = n
    total = sum(shares.values())
    return {lang: (shares[lang] / total, tables[lang]) for lang in sorted(shares)}


def _predicted(name: str, model: dict[str, tuple[float, np.ndarray]]):
    langs = [*model]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(name)
        table = np.stack([model[lang][1] for lang in langs], axis=1) if langs else np.zeros((pieces.count + 2, 0))
        prior = np.log([model[lang][0] for lang in langs])
        known: dict[str, int] = {}
        logs = np.zeros((1024, len(langs)))
        for batch in batches:
            for start, stop in slices_by_bytes(batch.column(1)):
                texts = batch.column(1).slice(start, stop - start).to_pylist()
                found = [LETTERS.findall(t.lower()) if t else [] for t in texts]
                if len(known) > CACHED:
                    known = {}
                new = [*{w for words in found for w in words if w not in known}]
                if len(known) + len(new) > len(logs):
                    logs = np.concatenate([logs, np.zeros((len(known) + len(new), len(langs)))])
                for some in by_length(new):
                    rows = np.arange(len(known), len(known) + len(some))
                    logs[rows] = forward(_lattice(pieces, [new[i] for i in some]), table)[1][-1]
                    known.update((new[i], row) for i, row in zip(some, rows.tolist()))
                best, score = [], []
                for words in found:
                    if not words or not langs:
                        best.append(UNKNOWN)
                        score.append(0.0)
                        continue
                    text = prior + logs[[known[w] for w in words]].sum(axis=0)
                    share = np.exp(text - text.max())
                    k = int(np.argmax(share))
                    best.append(langs[k])
                    score.append(float(share[k] / share.sum()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, stop - start), pa.array(best, pa.string()), pa.array(score, pa.float64())], [batch.schema.names[0], "lang_pred", "score"]
                )

    return run


def predicted(
    docs: DataFrame, model: dict[str, tuple[float, np.ndarray]], vocabulary_path: str, id_column: str = "doc_id", text_column: str = "text", whole: bool = False
) -> DataFrame:
    """``id, lang_pred, score`` for every row of ``docs``: the likeliest language of the whole text and its posterior probability.

    Words are runs of letters, lowered. Texts that are NULL or hold no letter, and all texts if the model knows no language, are
    ``und`` with score 0. Of equally likely languages the first by name wins. Repeated rows and NULL ids give a row each; other columns are
    ignored, or with ``whole`` handed on inside ``row``, which takes the id's place.
    """
    name = vocabulary_path.rsplit("/", 1)[-1]
    docs.sparkSession.sparkContext.addFile(vocabulary_path)
    kept, field = carried(docs, id_column, whole)
    schema = StructType([field, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return docs.select(kept, F.col(text_column).alias("_text")).mapInArrow(_predicted(name, model), schema)
