"""Scores of texts by a log-bilinear language model trained with noise-contrastive estimation.

Every word has a class: the most frequent words one each, all others a class by their ending. The model predicts a token's
class from the classes of the two tokens before it, as the product of a weighted sum of their vectors with the class's vector;
within a class, words have smoothed relative frequencies. Classes are few, so all contexts are normalised by batched matrix
products, and the probabilities of tokens are proper ones over any words, with one share for all unseen words of a class.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierloom.llm.common import binary_bytes, slices_by_bytes, stored

#: Classes: the text's end, then words of their own, then word endings. Bytes of an ending.
OWN, ENDINGS, ENDING = 895, 128, 3
CLASSES = 1 + OWN + ENDINGS
END, START = 0, CLASSES
#: Words whose counts are broadcast: so many at most, of so many bytes at most. Others meet their counts in a join.
FREQUENT, FREQUENT_BYTES = 131_072, 32
#: Vector length, tokens of a step, noise classes of a step, step size, passes over the training texts.
SIZE, STEP, NOISE, RATE, ROUNDS = 24, 2048, 64, 0.1, 2
SEED = 3
#: Bytes of classes that are mixed in training and scored together, two for each token.
SLICE = 1 << 19
#: Bins of the counts' histogram in each doubling.
BINS = 64


def _tokens(text: str | None) -> list[bytes]:
    """Words, A-Z lowered; both steps look at ASCII alone."""
    return text.encode("utf-8").lower().split() if text else []


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, stop in slices_by_bytes(batch.column(0), 8 << 20):
            counts: Counter = Counter()
            for text in batch.column(0).slice(start, stop - start):
                counts.update(_tokens(text.as_py()))
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])


@dataclass
class Counts:
    """What the training texts hold."""

    words: DataFrame
    tokens: int
    distinct: int
    ends: int
    #: Of each class, words in the training texts and distinct ones; 0 and 0 for classes of one token.
    inside: np.ndarray
    frequent: list[tuple[bytes, int]]

    def own(self) -> list[bytes]:
        return [w for w, _ in self.frequent[:OWN]]

    def unit(self) -> int:
        """What counts are divided by in the base score."""
        return self.tokens + self.distinct + 1


class _Endings(dict):
    """Class of each ending; the first 100,000 met are remembered."""

    def __missing__(self, end: bytes) -> int:
        value = 1 + OWN + zlib.crc32(end) % ENDINGS
        if len(self) < 100_000:
            self[end] = value
        return value


_endings = _Endings()


def ending(word: bytes) -> int:
    return _endings[word[-ENDING:]]


def counted(train: DataFrame, text_column: str = "text") -> Counts:
    """Counts of all words of ``train``, as a stored table; the driver has totals and the frequent words."""
    texts = train.select(F.col(text_column).alias("text"))
    words = stored(texts.mapInArrow(_counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    ends = texts.count()
    bins = F.floor(F.log2(F.col("n").cast("double")) * BINS).cast("int")
    short = words.where(F.octet_length("word") <= FREQUENT_BYTES).withColumn("bin", bins)
    left, least = FREQUENT, None
    for row in sorted(short.groupBy("bin").agg(F.count("*").alias("words")).collect(), reverse=True):
        left -= row["words"]
        if left < 0:
            break
        least = row["bin"]
    frequent = [] if least is None else [(bytes(r["word"]), r["n"]) for r in short.where(F.col("bin") >= least).select("word", "n").collect()]
    frequent.sort(key=lambda x: (-x[1], x[0]))
    own = [w for w, _ in frequent[:OWN]]
    place = F.crc32(F.expr(f"substring(word, -{ENDING}, {ENDING})")) % ENDINGS
    others = words.where(~F.col("word").isin(own)) if own else words
    inside = np.zeros((CLASSES, 2), np.int64)
    for row in others.groupBy(place.alias("place")).agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():
        inside[1 + OWN + row["place"]] = row["n"], row["words"]
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    return Counts(words, total + ends, distinct + (ends > 0), ends, inside, frequent)


@dataclass
class Weights:
    context: np.ndarray  # [class or start, size]
    target: np.ndarray  # [class, size]
    bias: np.ndarray  # [class]
    places: np.ndarray  # [2, size]

    def flat(self) -> np.ndarray:
        """One row for each vector, the bias in a column of its own."""
        rows = np.vstack([self.context, self.target, self.places])
        extra = np.zeros((len(rows), 1))
        extra[len(self.context) : len(self.context) + CLASSES, 0] = self.bias
        return np.hstack([rows, extra])

    @staticmethod
    def of(flat: np.ndarray) -> Weights:
        a, b = CLASSES + 1, 2 * CLASSES + 1
        return Weights(flat[:a, :SIZE].copy(), flat[a:b, :SIZE].copy(), flat[a:b, SIZE].copy(), flat[b:, :SIZE].copy())


def started(noise: np.ndarray) -> Weights:
    rng = np.random.default_rng(SEED)
    vectors = rng.normal(0, 0.1, (2 * CLASSES + 1, SIZE))
    return Weights(vectors[: CLASSES + 1], vectors[CLASSES + 1 :], np.log(noise), np.ones((2, SIZE)))


def contexts(classes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes one and two before each token; texts follow each other, each of one token at least."""
    firsts = np.cumsum(lengths) - lengths
    before, second = np.empty_like(classes), np.empty_like(classes)
    before[1:], second[2:] = classes[:-1], classes[:-2]
    before[firsts] = START
    second[firsts] = START
    after = firsts[lengths > 1] + 1
    second[after] = START
    return before, second


def _summed(rows: np.ndarray, gradients: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(rows, kind="stable")  # by radix, as rows are 16-bit numbers
    ordered = rows.take(order)
    at = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return ordered.take(at), np.add.reduceat(gradients.take(order, axis=0), at, axis=0)


class Trainer:
    """Noise-contrastive estimation in steps of ``STEP`` tokens, which share their noise; step sizes by Adagrad."""

    def __init__(self, weights: Weights, noise: np.ndarray, seed: int):
        parts = (weights.context, weights.target, weights.bias, weights.places)
        self.w, self.rng = Weights(*(x.astype(np.float32) for x in parts)), np.random.default_rng([SEED, seed])
        self.log_noise = (np.log(noise) + math.log(NOISE)).astype(np.float32)
        self.cumulated = np.cumsum(noise)
        self.squares = Weights(*(np.full(x.shape, 1e-2, np.float32) for x in parts))

    def step(self, token: np.ndarray, before: np.ndarray, second: np.ndarray) -> None:
        w = self.w
        noise = np.minimum(np.searchsorted(self.cumulated, self.rng.random(NOISE)), CLASSES - 1).astype(np.int16)
        one, two = w.context.take(before, axis=0), w.context.take(second, axis=0)
        predicted = one * w.places[0] + two * w.places[1]
        vectors, others = w.target.take(token, axis=0), w.target.take(noise, axis=0)
        lift = w.bias - self.log_noise
        real = np.einsum("ij,ij->i", predicted, vectors) + lift.take(token)
        false = predicted @ others.T
        false += lift.take(noise)
        up = 1 / (1 + np.exp(np.clip(real, -30, 30)))
        np.clip(false, -30, 30, out=false)
        np.negative(false, out=false)
        np.exp(false, out=false)
        false += 1
        down = np.divide(-1, false, out=false)
        toward = down @ others
        vectors *= up[:, None]
        toward += vectors
        rows, n = np.concatenate([token, noise]), len(token)
        gradients = np.empty((len(rows), SIZE + 1), np.float32)
        np.multiply(predicted, up[:, None], out=gradients[:n, :-1])
        gradients[:n, -1] = up
        gradients[n:, :-1] = down.T @ predicted
        gradients[n:, -1] = down.sum(axis=0)
        names, total = _summed(rows, gradients)
        self._move("target", names, total[:, :-1])
        self._move("bias", names, total[:, -1])
        names, total = _summed(np.concatenate([before, second]), np.vstack([toward * w.places[0], toward * w.places[1]]))
        self._move("context", names, total)
        self._move("places", np.arange(2), np.stack([np.einsum("ij,ij->j", toward, x) for x in (one, two)]))

    def _move(self, name: str, rows: np.ndarray, gradient: np.ndarray) -> None:
        gradient = gradient * np.float32(16 / STEP)
        squares = getattr(self.squares, name)
        squares[rows] += gradient * gradient
        getattr(self.w, name)[rows] += np.float32(RATE) * gradient / np.sqrt(squares[rows])


def _encoded(counts_unit: int, ends: int, inside: np.ndarray, frequent: list[tuple[bytes, int]]):
    """The classes of each text's tokens, what their counts add to both scores, and the words whose counts are elsewhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, endings = {w: i + 1 for i, (w, _) in enumerate(frequent)}, _Endings()
        n = np.array([ends, *(c for _, c in frequent)], np.float64)
        classes = np.array([END, *(1 + i if i < OWN else ending(w) for i, (w, _) in enumerate(frequent))], np.int16)
        base = np.log10((n + 1) / counts_unit)
        within = np.where(classes > OWN, np.log10((n + 1) / (inside.sum(axis=1)[classes] + 1)), 0.0)
        seen = n > 0
        for batch in batches:
            for start, stop in slices_by_bytes(batch.column(3)):
                token: list[int] = []
                place: list[int] = []
                lengths, rare = [], []
                for text in batch.column(3).slice(start, stop - start):
                    words = _tokens(text.as_py())
                    ids = [known.get(w, -1) for w in words]
                    others = [w for w, i in zip(words, ids) if i < 0]
                    place += ids
                    place.append(0)
                    token += [endings[w[-ENDING:]] for w in others]
                    lengths.append(len(words) + 1)
                    rare.append(list(Counter(others).items()))
                at = np.array(place)
                has, at = at >= 0, np.maximum(at, 0)
                ordered = classes[at]
                ordered[~has] = token
                size = np.array(lengths)
                firsts = np.cumsum(size) - size
                bounds = pa.py_buffer((np.concatenate([[0], np.cumsum(size)]) * ordered.itemsize).astype(np.int32).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(c.slice(start, stop - start) for c in batch.columns[:3]),
                        pa.array(size, pa.int64()),
                        pa.array(np.add.reduceat(has & seen[at], firsts, dtype=np.int64)),
                        pa.array(np.add.reduceat(np.where(has, base[at], 0), firsts)),
                        pa.array(np.add.reduceat(np.where(has, within[at], 0), firsts)),
                        pa.Array.from_buffers(pa.binary(), len(size), [None, bounds, pa.py_buffer(ordered.tobytes())]),
                        _pairs(rare),
                    ],
                    ["id", "key", "trains", "n_tokens", "n_known", "base", "within", "classes", "rare"],
                )

    return run


def encoded(docs: DataFrame, counts: Counts, id_column: str = "doc_id", text_column: str = "text", trains: Column | None = None) -> DataFrame:
    """Every text of ``docs`` as classes of tokens, split and looked up this once; stored. Training takes the rows where ``trains``, by default all."""
    rows = docs.select(
        F.col(id_column).cast("long").alias("id"), F.xxhash64(id_column, text_column).alias("key"),
        (F.lit(True) if trains is None else trains).alias("trains"), F.col(text_column).alias("text"),
    )
    schema = (
        "id long, key long, trains boolean, n_tokens long, n_known long, base double, within double, classes binary, "
        "rare array<struct<word: binary, times: long>>"
    )
    return stored(rows.mapInArrow(_encoded(counts.unit(), counts.ends, counts.inside, counts.frequent), schema), "encoded")


def _classes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The classes of all texts in a row, and how many each has."""
    data, bounds = binary_bytes(column)
    return data.view(np.int16), np.diff(bounds) // 2


def _trained(flat: np.ndarray, noise: np.ndarray, round_: int):
    """Train on the texts of a task; hand on the sum of what each text's tokens vote for, one row for each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        trainer = Trainer(Weights.of(flat), noise, TaskContext.get().partitionId() * ROUNDS + round_)
        seen = 0
        for batch in batches:
            for start, stop in slices_by_bytes(batch.column(0), SLICE):
                token, lengths = _classes(batch.column(0).slice(start, stop - start))
                before, second = contexts(token, lengths)
                order = trainer.rng.permutation(len(token))
                for k in range(0, len(order), STEP):
                    some = order[k : k + STEP]
                    trainer.step(token[some], before[some], second[some])
                seen += len(token)
        if seen:
            out = trainer.w.flat().astype(np.float64) * seen
            columns = [pa.array(np.arange(len(out), dtype=np.int32)), *(pa.array(out[:, j]) for j in range(SIZE + 1)), pa.array(np.full(len(out), float(seen)))]
            yield pa.RecordBatch.from_arrays(columns, ["row", *(f"v{j}" for j in range(SIZE + 1)), "tokens"])

    return run


@dataclass
class Model:
    weights: Weights
    #: Log of the sum over all classes, for each pair of classes before.
    norms: np.ndarray

    def logs(self, token: np.ndarray, before: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Natural logarithms of the probabilities of classes in their contexts."""
        w = self.weights
        predicted = w.context[before] * w.places[0] + w.context[second] * w.places[1]
        return np.einsum("ij,ij->i", predicted, w.target[token]) + w.bias[token] - self.norms[before, second]


def normalised(weights: Weights) -> Model:
    norms = np.empty((CLASSES + 1, CLASSES + 1))
    # exp(a + b + c) of the class, the one before and the one before that: a product of three factors for each class
    low, high = np.log(np.finfo(float).tiny) / 4, np.log(np.finfo(float).max) / 4
    parts = [(weights.context * place) @ weights.target.T for place in weights.places]
    if all(low < x.min() and x.max() < high for x in (*parts, weights.bias)):
        one, two = (np.exp(x) for x in parts)
        return Model(weights, np.log((one * np.exp(weights.bias)) @ two.T))
    for i in range(CLASSES + 1):
        scores = parts[1] + parts[0][i] + weights.bias
        most = scores.max(axis=1)
        norms[i] = most + np.log(np.exp(scores - most[:, None]).sum(axis=1))
    return Model(weights, norms)


def trained(train: DataFrame, counts: Counts, text_column: str = "text", rounds: int = ROUNDS) -> Model:
    """Train on all of ``train``; see :func:`trained_on`."""
    return trained_on(encoded(train.select(F.lit(0).alias("id"), F.col(text_column).alias("text")), counts, "id", "text"), counts, rounds)


def trained_on(coded: DataFrame, counts: Counts, rounds: int = ROUNDS) -> Model:
    """Train on the encoded texts that train. In each round, tasks train on their texts from common weights, which are then averaged
    by tokens; the sum runs as an aggregation, so the driver has one set of weights whatever the number of tasks. Which texts a task
    has depends on the files of the encoded table, so scores may differ a little with another partitioning of the input."""
    noise = np.zeros(CLASSES)
    noise[END] = counts.ends
    for i, (_, n) in enumerate(counts.frequent[:OWN]):
        noise[1 + i] = n
    noise += counts.inside[:, 0]
    noise = (noise + 1) / (noise + 1).sum()
    flat = started(noise).flat()
    texts = coded.where("trains").select("classes")
    names = [f"v{j}" for j in range(SIZE + 1)]
    schema = "row int, " + ", ".join(f"{n} double" for n in names) + ", tokens double"
    for k in range(rounds):
        sums = texts.mapInArrow(_trained(flat, noise, k), schema).groupBy("row").agg(*[(F.sum(n) / F.sum("tokens")).alias(n) for n in names])
        mean = sums.toPandas().sort_values("row")
        if len(mean):
            flat = mean[names].to_numpy()
    return normalised(Weights.of(flat))


def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices_by_bytes(batch.column(6), SLICE):
                part = batch.slice(start, stop - start)
                token, size = _classes(part.column(6))
                sums = np.add.reduceat(model.logs(token, *contexts(token, size)), np.cumsum(size) - size) / math.log(10)
                score = pa.array(sums + part.column(5).to_numpy())
                yield pa.RecordBatch.from_arrays([*part.columns[:5], score], ["id", "key", "n_tokens", "n_known", "base", "score"])

    return run


def _pairs(rare: list[list[tuple[bytes, int]]]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rare])]).astype(np.int32)
    words = pa.array([w for r in rare for w, _ in r], pa.binary())
    times = pa.array([n for r in rare for _, n in r], pa.int64())
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([words, times], ["word", "times"]))


def scored(docs: DataFrame, counts: Counts, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``.

    ``score`` is the model's log10 probability of the whole text and its end, ``base_score`` that of smoothed relative frequencies,
    ``n_known`` the tokens that stand in the training texts. NULL, empty and blank texts are their end alone. Repeated rows and NULL
    ids give a row each. Other columns are ignored. Without training texts every token is unseen.
    """
    return scored_from(encoded(docs, counts, id_column, text_column), counts, model, id_column)


def scored_from(coded: DataFrame, counts: Counts, model: Model, id_column: str = "doc_id") -> DataFrame:
    """:func:`scored` for texts that are encoded already.

    Words that are not frequent meet their counts in a join; Spark may split those that one text set has very often.
    """
    schema = "id long, key long, n_tokens long, n_known long, base double, score double"
    heads = coded.select("id", "key", "n_tokens", "n_known", "base", "within", "classes").mapInArrow(_scored(model), schema).withColumn("rows", F.lit(1))
    rare = coded.select("id", "key", F.explode("rare").alias("r")).select("id", "key", "r.word", "r.times")
    rare = rare.join(counts.words, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    inside = F.array(*[F.lit(int(x) + 1) for x in counts.inside.sum(axis=1)[1 + OWN :]])
    place = (F.crc32(F.expr(f"substring(word, -{ENDING}, {ENDING})")) % ENDINGS).cast("int")
    rare = rare.select(
        "id", "key", F.lit(0).cast("long").alias("n_tokens"), F.when(F.col("n") > 0, F.col("times")).otherwise(0).alias("n_known"),
        (F.col("times") * F.log10((F.col("n") + 1) / F.lit(counts.unit()))).alias("base"),
        (F.col("times") * F.log10((F.col("n") + 1) / F.get(inside, place))).alias("score"), F.lit(0).alias("rows"),
    )
    # rows that repeat an id and its text are summed together, and given out again as often as they are there
    whole = heads.unionByName(rare).groupBy("id", "key").agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "score", "rows")])
    whole = whole.withColumn("again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return whole.select(
        F.col("id").alias(id_column), F.expr("n_tokens div rows").alias("n_tokens"), F.expr("n_known div rows").alias("n_known"),
        F.lit(counts.tokens).cast("long").alias("train_tokens"), (F.col("base") / F.col("rows")).alias("base_score"), (F.col("score") / F.col("rows")).alias("score"),
    )
