"""Join of documents whose word shingles have a Jaccard similarity of at least a threshold.

Candidates come from bands of MinHash values. In a band's group, MinHash values are compared a few at a time, and a
pair is dropped as soon as the posterior probability that its similarity reaches the threshold falls
below a tolerance. What is left is verified on the exact shingle sets. No pairs are ever rows: a group hands on
a spanning forest of its surviving pairs, and links are counted where they are verified.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierloom.llm.common import grouped, shuffle_partitions, slices_by_bytes, stored, utf8_bytes
from tierloom.llm.components import components
from tierloom.llm.words import mix, shingle_hashes, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
#: MinHash values of a document: 32 bands of 4. A pair at 0.8 is missed by all bands with probability 5e-8.
BANDS, ROWS = 32, 4
VALUES = BANDS * ROWS
#: Posterior probability under which a pair is dropped, and after how many values it is looked at.
TOLERANCE = 1e-6
LOOKS = (16, 32, 64, 128)
#: Members of a candidate group, and of a class to be verified, that are in memory together.
GROUP_BLOCK, TEXT_BLOCK = 1024, 256
#: Shingles of a block that are counted by one matrix product.
COLUMNS = 8192


@functools.lru_cache(maxsize=None)
def least_matches(threshold: float, tolerance: float) -> tuple[int, ...]:
    """For each look, the least number of equal values with which a pair goes on.

    With a uniform prior and m of n values equal, the posterior of the similarity is Beta(m + 1, n - m + 1); the
    probability that it reaches ``threshold`` is that of at most m successes in n + 1 trials. Only the low
    byte of a value is kept, so unequal values agree once in 256; this only lets more pairs on.
    """
    out = []
    for n in LOOKS:
        tail = 0.0
        for m in range(n + 1):
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                break
        out.append(m)
    return tuple(out)


@functools.lru_cache(maxsize=None)
def _functions() -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * VALUES + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
    return seeds[:VALUES] | np.uint64(1), seeds[VALUES:]


def _min_values(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """MinHash values, a row for each text that has shingles."""
    starts = (np.cumsum(counts) - counts)[counts > 0]
    out = np.zeros((len(starts), VALUES), np.uint64)
    factors, terms = _functions()
    for j in range(VALUES):
        out[:, j] = np.minimum.reduceat(shingles * factors[j] + terms[j], starts)
    return out


SIGNATURES = "id long, key long, check int, node binary, short long, sig binary, bands array<long>"


def _signatures(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = np.uint64(0xC2B2AE3D27D4EB4F)
        for batch in batches:
            texts = batch.column(3)
            for start, stop in slices_by_bytes(texts):
                n = stop - start
                words, counts = word_hashes(*utf8_bytes(texts.slice(start, n)))
                shingles, runs = shingle_hashes(words, counts, size)
                node, short, sig, bands = [None] * n, [None] * n, [None] * n, [None] * n
                full = np.flatnonzero(counts > 0)
                if len(full):
                    firsts = (np.cumsum(counts) - counts)[full]
                    places = np.arange(len(words), dtype=np.uint64) - np.repeat(firsts, counts[full]).astype(np.uint64)
                    high = mix(np.add.reduceat(mix(words + places * step), firsts) + counts[full].astype(np.uint64))
                    low = mix(np.add.reduceat(mix(words ^ mix(places + step)), firsts))
                    both = np.stack([high, low], axis=1).astype(">u8")
                    values = _min_values(shingles, runs)
                    kept = mix(values).astype(np.uint8)
                    keys = np.zeros((len(full), BANDS), np.uint64)
                    for r in range(ROWS):
                        keys = mix(keys * step + values[:, r::ROWS])
                    keys = keys ^ (np.arange(BANDS, dtype=np.uint64) * step)
                    keys = keys.view(np.int64)
                    for k, i in enumerate(full):
                        node[i], short[i], sig[i], bands[i] = both[k].tobytes(), high[k].view(np.int64), kept[k].tobytes(), keys[k]
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(start, n) for c in batch.columns[:3]), pa.array(node, pa.binary()), pa.array(short, pa.int64()), pa.array(sig, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    ["id", "key", "check", "node", "short", "sig", "bands"],
                )

    return run


class _Forest:
    """Which members are joined already."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def join(self, i: int, others: np.ndarray) -> None:
        names = np.unique(self.of[others])
        to = min(int(self.of[i]), int(names[0]))
        self.of[np.isin(self.of, names) | (self.of == self.of[i])] = to


def forest_of(n: int, like) -> np.ndarray:
    """For each of ``n`` members, the first member of its component under ``like(i, others) -> bool array``.

    Pairs that are joined already are not looked at, so a group of copies costs little more than one pass.
    """
    forest = _Forest(n)
    for i in range(n - 1):
        others = np.flatnonzero(forest.of != forest.of[i])
        if len(others) == 0 and not forest.of.any():
            break
        others = others[others > i] if i else others
        if len(others):
            found = others[like(i, others)]
            if len(found):
                forest.join(i, found)
    return forest.of


def survivors(sigs: np.ndarray, i: int, others: np.ndarray, needed: tuple[int, ...]) -> np.ndarray:
    """Which of ``others`` may be as similar to member ``i`` as the threshold asks for."""
    alive = np.arange(len(others))
    equal = np.zeros(len(others), np.int64)
    done = 0
    for look, least in zip(LOOKS, needed):
        equal[alive] += (sigs[others[alive], done:look] == sigs[i, done:look]).sum(axis=1)
        alive = alive[equal[alive] >= least]
        done = look
        if len(alive) == 0:
            break
    out = np.zeros(len(others), dtype=bool)
    out[alive] = True
    return out


def _joined(threshold: float):
    """Edges of a spanning forest of the pairs of each group that survive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        needed = least_matches(threshold, TOLERANCE)
        a: list[bytes] = []
        b: list[bytes] = []
        for group in grouped(batches, ["band", "i", "j"]):
            nodes = group.column("node").to_pylist()
            if len(nodes) < 2:
                continue
            sigs = np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint8).reshape(len(nodes), VALUES)
            if len(nodes) == 2:
                first = [0, int(~survivors(sigs, 0, np.array([1]), needed)[0] & 1)]
            else:
                first = forest_of(len(nodes), lambda i, others: survivors(sigs, i, others, needed))
            for k, to in enumerate(first):
                if k != to:
                    a.append(nodes[k])
                    b.append(nodes[to])
            if len(a) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])
                a, b = [], []
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return run


def in_blocks(df: DataFrame, size: str, of: str, block: int) -> DataFrame:
    """Each row once for every pair of blocks (i, j) it belongs to; ``size`` is the size of its group.

    Rows are dealt to ``size / block`` blocks by a hash of ``of``. Every two rows of a group meet, in one pair of
    blocks if they are of different blocks. Within a block they meet in each of its pairs; (i, i) is the one to count.
    """
    blocks = F.ceil(F.col(size) / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64(of), blocks).cast("int")
    df = df.withColumn("_blocks", blocks).withColumn("_own", own)
    df = df.withColumn("_other", F.explode(F.expr("sequence(0, _blocks - 1)")))
    return df.select(
        *[c for c in df.columns if c not in ("_blocks", "_own", "_other")],
        F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"), F.col("_own").alias("own"),
    )


def _linked(size: int, threshold: float):
    """Links and spanning edges of the verified pairs of each block or pair of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["class", "i", "j"]):
            if group.num_rows < 2:
                continue
            group = group.combine_chunks()
            i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
            nodes = group.column("node").to_pylist()
            weights = np.array(group.column("copies").to_pylist(), np.int64)
            own = np.array(group.column("own").to_pylist(), np.int64)
            sets, texts = [], pa.chunked_array(group.column("text")).combine_chunks()
            for start, stop in slices_by_bytes(texts):
                shingles, runs = shingle_hashes(*word_hashes(*utf8_bytes(texts.slice(start, stop - start))), size)
                sets += [np.unique(x) for x in np.split(shingles, np.cumsum(runs)[:-1])]
            like = similar(sets, threshold)
            if i != j:
                like &= own[:, None] != own[None, :]
            np.fill_diagonal(like, False)
            links = like @ weights
            first = forest_of(len(nodes), lambda k, others: like[k, others])
            some = np.flatnonzero(links)
            if len(some):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([nodes[k] for k in some], pa.binary()), pa.array(links[some]), pa.array([nodes[first[k]] for k in some], pa.binary())],
                    ["node", "links", "to"],
                )

    return run


def similar(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs of sets have a Jaccard similarity of at least ``threshold``; the sets are sorted and unique."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    if n == 2:
        common = np.zeros((2, 2), np.int64)
        common[0, 1] = common[1, 0] = len(np.intersect1d(*sets, assume_unique=True))
    else:
        every, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(n), sizes)
        shared = often[column] > 1
        place = np.cumsum(often > 1) - 1
        row, column = row[shared], place[column[shared]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        common = np.zeros((n, n), np.float64)
        for start in range(0, int((often > 1).sum()), COLUMNS):
            lo, hi = np.searchsorted(column, [start, start + COLUMNS])
            has = np.zeros((n, min(COLUMNS, int((often > 1).sum()) - start)), np.float32)
            has[row[lo:hi], column[lo:hi] - start] = 1
            common += has @ has.T
        common = common.astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - common
    # whole numbers on both sides: 4 common of 5 is exactly 0.8
    return common * 10**9 >= np.int64(round(threshold * 10**9)) * union


def _keys(id_column: str, text_column: str) -> list[Column]:
    """Two hashes that tell rows of different ids or texts apart."""
    return [F.xxhash64(id_column, text_column).alias("key"), F.hash(text_column, id_column).alias("check")]


def deduplicated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **parameters) -> DataFrame:
    """One row of each class of ``similar_documents``, that of the smallest id, with all its columns.

    Of rows that repeat an id and its text one stays.
    """
    kept = classified(docs, id_column, text_column, **parameters).where("kept").select("key", "check").distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *_keys(id_column, text_column))
    return rows.join(kept, ["key", "check"], "left_semi").dropDuplicates(["key", "check"]).select("row.*")


def similar_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """``id, class_id, n_links, kept`` for every row of ``docs``; see ``classified``."""
    return classified(docs, id_column, text_column, shingle, threshold).drop("key", "check")


def classified(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """``id, key, check, class_id, n_links, kept`` for every row of ``docs``.

    Words are runs of characters other than ASCII white space, A-Z lowered; a document is the set of its runs of
    ``shingle`` words, or the whole of a shorter text. Two documents are linked if the Jaccard similarity of these
    sets is at least ``threshold``. ``n_links`` counts the other rows linked directly, ``class_id`` is the smallest id
    reachable by links, ``kept`` is true for one text of each class (that of the smallest id). ``key`` and ``check`` are hashes of id and text.

    * Equal texts are one text with a number of copies, however many there are.
    * NULL, empty and blank texts have no shingles and are linked with nothing: each is a class, and kept.
    * Rows that repeat an id and its text are copies of each other; all of them carry ``kept``. A NULL id
      leads a class only if the class has no other; then rows of one of its texts are kept.
    * Long texts are compared whole. Other columns are ignored, so their names cannot clash.

    Signatures, candidate edges and components are tables in the shared folder.
    """
    width = shuffle_partitions(docs.sparkSession)
    text = F.col(text_column)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), *_keys(id_column, text_column), text.alias("text"))
    signed = stored(rows.mapInArrow(_signatures(shingle), SIGNATURES), "signatures")
    worded = signed.where("node IS NOT NULL")
    texts = worded.groupBy("node").agg(
        F.count("*").alias("copies"), F.min("id").alias("least_id"), F.min(F.struct("key", "check")).alias("pick"),
        F.min("short").alias("short"), F.min("sig").alias("sig"), F.min("bands").alias("bands"),
    )
    texts = stored(texts, "texts")

    # two numbers for each band of each text; signatures follow only into groups of at least two
    entries = texts.select("short", F.explode("bands").alias("band"))
    met = entries.groupBy("band").agg(F.count("*").alias("members")).where("members > 1")
    grouped_texts = entries.join(met, "band").join(texts.select("short", "node", "sig"), "short")
    blocks = in_blocks(grouped_texts, "members", "node", GROUP_BLOCK)
    candidates = (
        blocks.select("band", "i", "j", "node", "sig").repartition(width, "band", "i", "j")
        .sortWithinPartitions("band", "i", "j").mapInArrow(_joined(threshold), "a binary, b binary")
    )
    near = stored(components(candidates), "near")

    size = near.groupBy("component").agg(F.count("*").alias("members"))
    members = near.join(stored(size, "sizes"), "component").join(texts.select("node", "copies", "pick.*"), "node")
    members = members.select(F.col("component").alias("class"), "members", "node", "copies", "key", "check")
    # a join by shuffle at every size: the texts of classes are as many as there are copies in the corpus
    full = rows.select("key", "check", "text").join(members.hint("merge"), ["key", "check"]).dropDuplicates(["key", "check"])
    blocks = in_blocks(full, "members", "node", TEXT_BLOCK)
    linked = (
        blocks.select("class", "i", "j", "own", "node", "copies", "text").repartition(width, "class", "i", "j")
        .sortWithinPartitions("class", "i", "j").mapInArrow(_linked(shingle, threshold), "node binary, links long, to binary")
    )
    linked = stored(linked, "linked")
    links = linked.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(linked.select(F.col("node").alias("a"), F.col("to").alias("b")))
    about = texts.select("node", "copies", "least_id").join(links, "node", "left").join(classes, "node", "left")
    return with_classes(signed.select("id", "key", "check", "node"), about, id_column)


def with_classes(rows: DataFrame, about: DataFrame, id_column: str) -> DataFrame:
    """``id, key, check, class_id, n_links, kept`` of ``rows`` (id, key, check, node), from ``about`` (node, copies, least_id, links, component).

    Both sides of the joins are stored tables, so Spark deals them out itself and may split a node or class that
    holds much of all rows.
    """
    about = stored(
        about.select(
            "node", "least_id", F.coalesce("component", "node").alias("class"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
        ),
        "about",
    )
    lead = F.min(F.struct(F.col("least_id").isNull().alias("none"), F.col("least_id").alias("class_id"), F.col("node").alias("lead")))
    leads = stored(about.groupBy("class").agg(lead.alias("least")).select("class", "least.class_id", "least.lead"), "leads")
    about = stored(about.join(leads, "class").select("node", "links", "class_id", (F.col("node") == F.col("lead")).alias("leads")), "about")
    return rows.join(about, "node", "left").select(
        F.col("id").alias(id_column), "key", "check",
        F.when(F.col("links").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        (F.col("links").isNull() | F.col("leads") & F.col("id").eqNullSafe(F.col("class_id"))).alias("kept"),
    )
