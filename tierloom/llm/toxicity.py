"""Toxicity by weak supervision: many noisy voters, a generative model of them, and a linear classifier.

Voters are fixed lexicons, lexicons learned from labelled texts (whole words, and beginnings of words), and patterns.
A tree-shaped generative model, fitted by expectation-maximisation over the votes on all texts, gives each voter its
accuracy under either class and its correlation with one other voter. Its posterior labels train a logistic regression.
"""

from __future__ import annotations

import dataclasses
import functools
import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tierloom.llm.common import carried, shuffle_partitions, slices_by_bytes, stored
from tierloom.llm.words import mix

#: Labelled texts, in the order of a hash of their ids, that lexicons and classifier are fitted on; all if there are fewer.
MAX_LABELLED = 20_000
LETTERS = re.compile(r"[^\W\d_]+")
#: Lengths of the beginnings of words that may be entries, entries of each kind, and lexicons they are dealt to.
BEGINNINGS = (4, 5, 6)
ENTRIES, LEXICONS = 400, 3
#: Least share of the toxic texts, and number of them, that hold an entry; least weight (a log odds ratio) of an entry.
SUPPORT, LEAST, WEIGHT = 0.015, 4, 2.5
ROUNDS, STEPS, PENALTY = 8, 60, 1e-2
#: MinHash values that tell near copies among labelled texts: bands, values in each, least share that agrees.
BANDS, BAND, ALIKE = 8, 4, 0.7

#: Common insults of four languages, one lexicon each.
INSULTS = (
    frozenset("idiot idiots moron morons stupid dumb loser losers trash scum pathetic worthless disgusting clown fool imbecile jerk bastard bitch asshole dumbass crap shit fuck fucking".split()),
    frozenset("idiot idioten dumm dummkopf blöd blödmann trottel depp arschloch scheiße abschaum versager widerlich erbärmlich wertlos schwachkopf hurensohn".split()),
    frozenset("idiot idiote imbécile crétin débile stupide connard connasse salaud ordure minable pathétique dégoûtant merde abruti raté nul".split()),
    frozenset("idiota imbécil estúpido estúpida tonto tonta basura escoria patético inútil asqueroso payaso perdedor mierda cabrón gilipollas".split()),
)
#: Patterns: insults spoken to someone, masked swearing, shouting, marks of anger.
PATTERNS = (
    re.compile(r"\byou(?:'re| are)? (?:an? |such an? |all )?(?:\w+ ){0,2}(?:idiot|moron|loser|fool|clown|trash|scum|pathetic|worthless|disgusting|stupid)", re.I),
    re.compile(r"\b[a-z]+\*+[a-z]*\b|[@#$%]{3,}", re.I),
    re.compile(r"(?:\b[A-Z]{3,}\b\W+){6}"),
    re.compile(r"!{3,}|\?!"),
)
#: What a text must have for each pattern, which is quicker to see.
NEEDED = (
    lambda text, words: "you" in words,
    lambda text, words: any(c in text for c in "*@#$%"),
    lambda text, words: True,
    lambda text, words: "!" in text,
)
VOTERS = len(INSULTS) + len(PATTERNS) + 2 * LEXICONS
FEATURES = 2 * VOTERS + 6


@dataclasses.dataclass
class Lexicon:
    """Entries with their weights, and the voter each belongs to."""

    words: dict[str, float] = dataclasses.field(default_factory=dict)
    beginnings: dict[str, float] = dataclasses.field(default_factory=dict)

    def __post_init__(self):
        self.heads = {w[: BEGINNINGS[0]] for w in self.beginnings}

    def votes(self, text: str) -> tuple[int, np.ndarray]:
        """Bits of the voters that call ``text`` toxic, and the features of the classifier."""
        found = LETTERS.findall(text.lower())
        distinct = set(found)
        hits = np.zeros(VOTERS)
        for i, words in enumerate(INSULTS):
            hits[i] = len(distinct & words)
        base = len(INSULTS)
        for i, (pattern, needed) in enumerate(zip(PATTERNS, NEEDED)):
            hits[base + i] = needed(text, distinct) and pattern.search(text) is not None
        base += len(PATTERNS)
        word_weight = top = beginning_weight = 0.0
        n_words = n_beginnings = 0
        for w in distinct & self.words.keys():
            weight = self.words[w]
            hits[base + _voter(w)] += 1
            word_weight, top, n_words = word_weight + weight, max(top, weight), n_words + 1
        base += LEXICONS
        likely = [w for w in distinct if w[: BEGINNINGS[0]] in self.heads]
        for size in BEGINNINGS:
            for w in {w[:size] for w in likely if len(w) >= size} & self.beginnings.keys():
                hits[base + _voter(w)] += 1
                beginning_weight, n_beginnings = beginning_weight + self.beginnings[w], n_beginnings + 1
        bits = sum(1 << i for i in range(VOTERS) if hits[i])
        rest = [math.log1p(word_weight), math.log1p(beginning_weight), top / 10, math.log1p(n_words), math.log1p(n_beginnings), math.log1p(len(found)) / 10]
        return bits, np.concatenate([hits > 0, np.log1p(hits), rest])


def _voter(entry: str) -> int:
    return sum(map(ord, entry)) % LEXICONS


@dataclasses.dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray
    accuracy: list[tuple[float, float]]
    parents: list[int]


def labelled(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic", most: int = MAX_LABELLED) -> DataFrame:
    """``text, toxic`` of at most ``most`` labelled texts, chosen by a hash of their ids.

    Of differing labels of one id the larger counts. An id has one text here, however many rows repeat it: that with the smallest hash.
    NULL texts, labels and ids are left out.
    """
    chosen = labels.where(F.col(label_column).isNotNull() & F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("id"))
    chosen = chosen.agg(F.max(label_column).cast("int").alias("toxic")).orderBy(F.xxhash64("id"), "id").limit(most)
    # at most ``most`` pairs of an id and a number: bounded, so broadcast
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).where("text IS NOT NULL")
    rows = rows.join(F.broadcast(chosen), "id").groupBy("id", "toxic").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("first"))
    return rows.select("first.text", "toxic")


@functools.lru_cache(maxsize=1 << 17)
def hash_of(word: str) -> int:
    """64 bits of the whole word."""
    return int.from_bytes(hashlib.blake2b(word.encode("utf-8"), digest_size=8).digest(), "little")


def signature(words: list[str]) -> np.ndarray:
    """MinHash values of the runs of three words (of the words, if there are only two); texts without words have zeros."""
    hashes = np.array([hash_of(w) for w in words], np.uint64)
    if len(hashes) > 2:
        hashes = mix(hashes[:-2] * np.uint64(3) + hashes[1:-1] * np.uint64(5) + hashes[2:] * np.uint64(7))
    if not len(hashes):
        return np.zeros(BANDS * BAND, np.int32)
    least = np.full(BANDS * BAND, np.iinfo(np.uint64).max, np.uint64)
    seeds = mix(np.arange(1, BANDS * BAND + 1, dtype=np.uint64))[:, None]
    for k in range(0, len(hashes), 1 << 14):
        np.minimum(least, mix(seeds + hashes[k : k + (1 << 14)]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, stop in slices_by_bytes(batch.column(0)):
            part = batch.slice(start, stop - start)
            values = np.concatenate([signature(LETTERS.findall(t.as_py().lower())) for t in part.column(0)])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(values) + 1, BANDS * BAND), pa.int32()), pa.array(values))
            yield pa.RecordBatch.from_arrays([*part.columns, lists], ["text", "toxic", "signature"])


def distinct_texts(sample: DataFrame) -> DataFrame:
    """``text, toxic`` of the sample without near copies: of texts of one label, those that resemble one with a smaller hash go.

    Two texts meet if they share the ``BAND`` values of one of ``BANDS`` bands, and resemble each other if ``ALIKE`` of all their MinHash
    values agree, which texts with but a passage in common do not. Each text is compared with the first one of its bands alone; near
    copies that miss each other both stay.
    """
    single = sample.repartition(shuffle_partitions(sample.sparkSession), "text", "toxic").distinct()
    signed = single.mapInArrow(_signed, "text string, toxic int, signature array<int>")
    signed = stored(signed.withColumn("key", F.xxhash64("text")), "signatures")
    bands = signed.select("toxic", "key", "signature", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band"))
    bands = bands.withColumn("values", F.slice("signature", F.col("band") * BAND + 1, BAND))
    group = ["toxic", "band", "values"]
    firsts = bands.groupBy(*group).agg(F.min(F.struct("key", "signature")).alias("first"))
    agree = F.aggregate(F.zip_with("signature", "first.signature", lambda a, b: (a == b).cast("int")), F.lit(0), lambda x, y: x + y)
    copies = bands.join(firsts, group).where((F.col("first.key") < F.col("key")) & (agree >= ALIKE * BANDS * BAND)).select("toxic", "key").distinct()
    return signed.join(copies, ["toxic", "key"], "left_anti").select("text", "toxic")


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and other texts each word and each beginning of a word stands."""
    for batch in batches:
        for start, stop in slices_by_bytes(batch.column(0), 8 << 20):
            counts = (Counter(), Counter())
            for text, toxic in zip(batch.column(0).slice(start, stop - start).to_pylist(), batch.column(1).slice(start, stop - start).to_pylist()):
                words = set(LETTERS.findall(text.lower()))
                into = counts[1 if toxic else 0]
                into.update("w" + w for w in words)
                for size in BEGINNINGS:
                    into.update({"b" + w[:size] for w in words if len(w) >= size})
            for toxic, some in enumerate(counts):
                n = list(some.values())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(some), pa.string()), pa.array(n if toxic else [0] * len(n), pa.int64()), pa.array([0] * len(n) if toxic else n, pa.int64())],
                    ["entry", "bad", "good"],
                )


def lexicon_of(sample: DataFrame) -> Lexicon:
    """The entries that tell toxic texts from others; near copies of a text count once."""
    single = distinct_texts(sample)
    n_bad, n_good = single.agg(F.coalesce(F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)), F.lit(0)), F.coalesce(F.sum(F.when(F.col("toxic") == 1, 0).otherwise(1)), F.lit(0))).first()
    counts = single.mapInArrow(_entries, "entry string, bad long, good long").groupBy("entry").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    weight = F.log((F.col("bad") + 0.5) / (n_bad + 1.0)) - F.log((F.col("good") + 0.5) / (n_good + 1.0))
    useful = counts.where(F.col("bad") >= max(LEAST, SUPPORT * n_bad)).select("entry", weight.alias("weight"), (weight * F.col("bad")).alias("gain")).where(F.col("weight") >= WEIGHT)
    kinds = []
    for kind in ("w", "b"):
        some = useful.where(F.col("entry").startswith(kind)).orderBy(F.desc("gain"), "entry").limit(ENTRIES)
        kinds.append({r["entry"][1:]: float(r["weight"]) for r in some.collect()})
    return Lexicon(*kinds)


def _voted(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for text in batch.column(0):
                counts[lexicon.votes(text.as_py() or "")[0]] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], ["votes", "n"])

    return run


class LabelModel:
    """P(class) times, for each voter, P(vote | class, vote of its parent voter).

    The parents form the tree of greatest mutual information given the class, so correlated voters do not count twice.
    """

    def __init__(self, votes: np.ndarray):
        self.bits = (votes[:, None] >> np.arange(VOTERS)) & 1

    def fit(self, weight: np.ndarray, known: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
        """Posterior probability of class 1 of each row; ``known`` is the label of rows that have one, else -1."""
        bits, labels = self.bits, np.maximum(known, 0)
        start = np.where(bits.any(axis=1), 0.9, 0.02)
        posterior = np.where(known >= 0, np.where(labels == 1, 0.95, 0.02), start)
        for k in range(rounds):
            # rows without a label join when the labelled ones have told what the votes are worth
            counted = weight * (known >= 0) if k == 0 and (known >= 0).any() else weight
            classes = np.stack([1 - posterior, posterior]) * counted
            prior = (classes.sum(axis=1) + 1) / (classes.sum() + 2)
            # counts of (class, vote i, vote j), for all pairs of voters
            on = np.einsum("cn,ni,nj->cij", classes, bits, bits)
            one = np.einsum("cii->ci", on)
            whole = classes.sum(axis=1)[:, None, None]
            cells = np.stack([whole - one[:, :, None] - one[:, None, :] + on, one[:, None, :] - on, one[:, :, None] - on, on], axis=-1) + 0.25
            cells = cells.reshape(2, VOTERS, VOTERS, 2, 2)
            p = cells / cells.sum(axis=(3, 4), keepdims=True)
            gain = (p * np.log(p / (p.sum(axis=4, keepdims=True) * p.sum(axis=3, keepdims=True)))).sum(axis=(3, 4))
            self.parents = _tree((gain * prior[:, None, None]).sum(axis=0))
            # how far given labels can be trusted
            has = known >= 0
            trust = np.zeros((2, 2))
            for c in (0, 1):
                for label in (0, 1):
                    trust[c, label] = classes[c, has & (labels == label)].sum() + (20 if c == label else 1)
            trust /= trust.sum(axis=1, keepdims=True)
            logs = np.log(prior)[:, None] + np.where(has, np.log(trust)[:, labels], 0)
            for i, parent in enumerate(self.parents):
                table = cells[:, parent, i] if parent >= 0 else np.repeat(cells[:, i, i].sum(axis=1)[:, None], 2, axis=1)
                table = table / table.sum(axis=2, keepdims=True)
                above = bits[:, parent] if parent >= 0 else np.zeros(len(bits), np.int64)
                logs = logs + np.log(table[:, above, bits[:, i]])
            posterior = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
            self.accuracy = [(float(one[0, i] / max(whole[0, 0, 0], 1)), float(one[1, i] / max(whole[1, 0, 0], 1))) for i in range(VOTERS)]
        return posterior


def _tree(gain: np.ndarray) -> list[int]:
    """Parent of each voter in the tree of greatest total gain, -1 for the root."""
    parents, best, source = [-1] * len(gain), gain[0].copy(), np.zeros(len(gain), np.int64)
    inside = np.zeros(len(gain), bool)
    inside[0] = True
    for _ in range(len(gain) - 1):
        i = int(np.argmax(np.where(inside, -1, best)))
        parents[i], inside[i] = int(source[i]), True
        closer = gain[i] > best
        best[closer], source[closer] = gain[i][closer], i
    return parents


def _featured(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [lexicon.votes(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1].tolist() for r in rows], pa.list_(pa.float64())), batch.column(1)], ["votes", "features", "toxic"]
            )

    return run


def fit(docs: DataFrame, sample: DataFrame, text_column: str = "text") -> Model:
    """Learn from all ``docs`` (votes) and the labelled ``sample`` (text, toxic); without labelled texts the fixed voters decide alone.

    Counts of vote patterns of all texts come to the driver: at most 2 ** VOTERS of them, in practice some hundreds. So do
    the votes and features of the sample, whose size is bounded.
    """
    sample = stored(sample.repartition(shuffle_partitions(docs.sparkSession), "text"), "labelled")
    lexicon = lexicon_of(sample)
    seen = docs.select(F.col(text_column).alias("text")).mapInArrow(_voted(lexicon), "votes long, n long").groupBy("votes").agg(F.sum("n").alias("n")).toPandas()
    own = sample.mapInArrow(_featured(lexicon), "votes long, features array<double>, toxic int").toPandas()
    given = own.groupby(["votes", "toxic"]).size().reset_index(name="n")
    # a labelled text is also among all texts; it counts there as one without a label
    votes = np.concatenate([seen["votes"].to_numpy(np.int64), given["votes"].to_numpy(np.int64)])
    weight = np.concatenate([seen["n"].to_numpy(np.float64), given["n"].to_numpy(np.float64)])
    known = np.concatenate([np.full(len(seen), -1), given["toxic"].to_numpy(np.int64)])
    labels = LabelModel(votes)
    posterior = labels.fit(weight, known) if len(votes) else np.zeros(0)
    soft = {(int(v), int(k)): float(p) for v, k, p in zip(votes, known, posterior)}
    if len(own):
        x = np.stack(own["features"].to_numpy())
        y = np.array([soft[int(v), int(t)] for v, t in zip(own["votes"], own["toxic"])])
    else:
        x = np.array([lexicon.votes(t)[1] for t in ["", *sorted(INSULTS[0])]])
        y = np.array([0.0] + [1.0] * (len(x) - 1))
    return Model(lexicon, _regressed(x, y), getattr(labels, "accuracy", []), getattr(labels, "parents", []))


def _regressed(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a ridge-penalised logistic regression on soft labels, the constant last; Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.full(x.shape[1], PENALTY * len(x) / 100 + 1e-3)
    penalty[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w = w + step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w


def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for text in batch.column(1):
                z = float(model.lexicon.votes(text.as_py() or "")[1] @ model.weights[:-1] + model.weights[-1])
                scores.append(1 / (1 + math.exp(-max(-500.0, min(500.0, z)))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], [batch.schema.names[0], "score"])

    return run


def scored(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", whole: bool = False) -> DataFrame:
    """``id, score, predicted`` for every row of ``docs``: whole texts, NULL as the empty one.

    Repeated rows and NULL ids give a row each. Other columns are ignored, or with ``whole`` handed on inside ``row``, which takes the
    id's place.
    """
    kept, field = carried(docs, id_column, whole)
    out = docs.select(kept, F.col(text_column).alias("_text")).mapInArrow(_scored(model), StructType([field, StructField("score", DoubleType())]))
    return out.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
