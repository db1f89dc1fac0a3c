"""Phrases whose words stand together more often than by chance, mined over a prefix-free parse.

Texts are cut where the hash of four words in a row hits a trigger, so that equal passages are cut alike wherever they stand.
A chunk ends with the four words that begin the next one: every run of up to five words lies in the chunk that holds its
first word before those four, and is counted there alone. The distinct chunks and how often each occurs are the dictionary;
phrases are counted inside it, times the frequency of their chunk.

Counting is by length of phrase, and a phrase can be frequent only if both phrases of one word less in it are. What is frequent
is handed on as a bitmap of hashes of fixed size. Wrong positives of the bitmap, or of a hash, only cost work: the last pass counts
by the phrases themselves.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.llm.common import shuffle_partitions, slices_by_bytes, stored
from tierloom.llm.words import mix, word_hashes
from tierloom.session import new_table_path

#: Words of a phrase; occurrences of a candidate; candidates reported of a language.
LONGEST, LEAST, TOP = 5, 100, 2000
#: Words of a trigger, which chunks share, and one in how many is one.
OVERLAP, PERIOD = LONGEST - 1, 32
#: Bits of a bitmap of frequent hashes, as a power of two. Larger corpora prune better with more.
BITS = 26
#: Bits of a bitmap's bucket, as Spark has them. Bytes of text, and counted hashes, that a task holds.
BUCKET, HELD_BYTES, HELD = 1 << 15, 32 << 20, 2_000_000
_RUN = 0xA24BAED4963EE407
UNKNOWN = "und"

_BREAKS = b".,;:!?\n\x0b\x0c\r"
_AS = bytes(10 if b in _BREAKS else 32 if b in b" \t" else b + 32 if 65 <= b <= 90 else b for b in range(256))


def runs(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each place on; the last ``n - 1`` places have none."""
    size = max(0, len(words) - n + 1)
    if n == 1:
        return words
    total = np.zeros(size, np.uint64)
    for k in range(n):
        total += words[k : k + size] * np.uint64(pow(_RUN, k + 1, 2**64))
    return mix(total)


def chunks_of(texts: list[str | None], period: int = PERIOD) -> Iterator[tuple[int, bool, bytes, int]]:
    """``text, closed, chunk, words`` for each chunk of each text. Words end with a space, or a line end if their piece ends too.

    ``closed`` chunks end their text, and all their words begin phrases; in others the last four do not.
    """
    raw = "\n".join(t or "" for t in texts).encode("utf-8").translate(_AS) + b"\n"
    data = np.frombuffer(raw, np.uint8)
    lengths = np.array([len(t.encode("utf-8")) if t else 0 for t in texts])
    gap = (data == 32) | (data == 10)
    starts = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
    if len(starts) == 0:
        return
    ends = np.flatnonzero(gap & np.concatenate([[False], ~gap[:-1]]))
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    breaks = lines[np.concatenate([starts[1:], [len(data)]])] > lines[ends]
    text = np.searchsorted(np.cumsum(lengths + 1), starts, side="right")
    keep = ~gap
    keep[ends] = True
    marked = data.copy()
    marked[ends] = np.where(breaks, 10, 32)
    plain = marked[keep]
    size = ends - starts + 1
    upto = np.cumsum(size)
    hashes = word_hashes(plain, np.array([0, len(plain)]))[0]
    last = np.flatnonzero(np.concatenate([text[1:] != text[:-1], [True]]))
    begins = np.concatenate([[0], last[:-1] + 1])
    cut = np.zeros(len(starts), bool)
    trigger = np.flatnonzero(runs(hashes, OVERLAP) % np.uint64(period) == 0)
    cut[trigger[text[trigger] == text[np.minimum(trigger + OVERLAP - 1, len(text) - 1)]]] = True
    cut[begins] = True
    firsts = np.flatnonzero(cut)
    following = np.concatenate([firsts[1:], [len(starts)]])
    closed = np.concatenate([text[firsts[1:]] != text[firsts[:-1]], [True]])
    stops = np.where(closed, following, following + OVERLAP)
    whole = plain.tobytes()
    at, to = (upto - size)[firsts], upto[stops - 1] - 1
    for i, c, a, z, n in zip(text[firsts].tolist(), closed.tolist(), at.tolist(), to.tolist(), (stops - firsts).tolist()):
        yield i, c, whole[a:z] + b"\n", n


def _parsed(period: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        held = 0

        def out() -> pa.RecordBatch:
            langs, closed, chunks, words = zip(*counts)
            columns = [pa.array(langs, pa.string()), pa.array(closed), pa.array(chunks, pa.binary()), pa.array(words, pa.int32()), pa.array(counts.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["lang", "closed", "chunk", "words", "freq"])

        for batch in batches:
            for start, stop in slices_by_bytes(batch.column(1)):
                langs = batch.column(0).slice(start, stop - start).to_pylist()
                for i, c, chunk, n in chunks_of(batch.column(1).slice(start, stop - start).to_pylist(), period):
                    counts[langs[i], c, chunk, n if c else n - OVERLAP] += 1
                    held += len(chunk)
                if held > HELD_BYTES // 2:
                    yield out()
                    counts.clear()
                    held = 0
        if counts:
            yield out()

    return run


def dictionary(docs: DataFrame, lang_column: str = "lang", text_column: str = "text", period: int = PERIOD) -> DataFrame:
    """``lang, closed, chunk, words, freq``: distinct chunks of each language, how many words begin phrases in them, and how often they occur; stored."""
    texts = docs.select(F.coalesce(F.col(lang_column).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_column).alias("text"))
    parsed = texts.mapInArrow(_parsed(period), "lang string, closed boolean, chunk binary, words int, freq long")
    counted = parsed.groupBy("lang", "closed", "chunk", "words").agg(F.sum("freq").alias("freq"))
    path = new_table_path(docs.sparkSession, "chunks")
    counted.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(counted.schema).parquet(path)


class Words:
    """The words of some chunks: hashes with their language, how many follow to the end of their piece, weights."""

    def __init__(self, langs: list[str], closed: np.ndarray, chunks: list[bytes], freq: np.ndarray):
        self.raw = b"".join(chunks)
        data = np.frombuffer(self.raw, np.uint8)
        self.ends = np.flatnonzero((data == 32) | (data == 10))
        self.starts = np.concatenate([[0], self.ends[:-1] + 1])
        upto = np.searchsorted(self.ends, np.cumsum([len(c) for c in chunks]))
        size = np.diff(np.concatenate([[0], upto]))
        self.chunk = np.repeat(np.arange(len(chunks)), size)
        names = {name: int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little") for name in set(langs)}
        salt = np.array([names[name] for name in langs], np.uint64)
        self.hashes = mix(word_hashes(data, np.array([0, len(data)]))[0] ^ salt[self.chunk])
        stops = np.flatnonzero(data[self.ends] == 10)
        place = np.arange(len(self.ends))
        self.left = stops[np.searchsorted(stops, place)] - place + 1
        self.begins = closed[self.chunk] | (place < upto[self.chunk] - OVERLAP)
        self.weights = freq[self.chunk]

    def phrases(self, n: int) -> np.ndarray:
        """Places where a phrase of ``n`` words begins that is counted here."""
        return np.flatnonzero(self.begins & (self.left >= n))


def marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bitmap has each hash."""
    at = hashes & np.uint64(len(bits) * 8 - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _of(batch: pa.RecordBatch, start: int, stop: int) -> tuple[list[str], Words]:
    part = batch.slice(start, stop - start)
    langs = part.column(0).to_pylist()
    return langs, Words(langs, np.array(part.column(1).to_pylist(), bool), part.column(2).to_pylist(), np.array(part.column(3).to_pylist(), np.int64))


def summed(keys: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the sums of each, and a place of each in the input."""
    if len(keys) == 0:
        return keys, sums, np.zeros(0, np.int64)
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    at = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return ordered[at], np.add.reduceat(sums[order], at), order[at]


class Tally:
    """Sums of hashes, brought together whenever as many wait as are summed, and ``HELD`` at least."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.keys, self.sums = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.more = 0

    def add(self, keys: np.ndarray, sums: np.ndarray) -> None:
        self.waiting.append((keys, sums))
        self.more += len(keys)
        if self.more > max(HELD, len(self.keys)):
            self.settle()

    def settle(self) -> None:
        if self.waiting:
            keys, sums = (np.concatenate(x) for x in zip((self.keys, self.sums), *self.waiting))
            self.keys, self.sums, _ = summed(keys, sums)
            self.waiting, self.more = [], 0

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        self.settle()
        out = self.keys, self.sums
        self.clear()
        return out


def _counted(n: int, frequent, buckets: int):
    """Sums of the hashes of phrases of ``n`` words, packed by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()

        def out() -> pa.RecordBatch:
            keys, sums = tally.taken()
            bucket = ((keys >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            ends = np.cumsum(np.bincount(bucket, minlength=buckets))
            full = np.flatnonzero(np.diff(np.concatenate([[0], ends])))
            spans = [(int(ends[b - 1]) if b else 0, int(ends[b])) for b in full]
            keys, sums = keys[order], sums[order]
            packed = [pa.array([x[a:z].tobytes() for a, z in spans], pa.binary()) for x in (keys, sums)]
            return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), *packed], ["bucket", "keys", "sums"])

        for batch in batches:
            for start, stop in slices_by_bytes(batch.column(2)):
                words = _of(batch, start, stop)[1]
                at = words.phrases(n)
                if n > 1:
                    shorter = runs(words.hashes, n - 1)
                    bits = np.frombuffer(frequent.value, np.uint8)
                    had = marked(bits, shorter)
                    at = at[had[at] & had[at + 1]]
                tally.add(*summed(runs(words.hashes, n)[at], words.weights[at])[:2])
            if len(tally.keys) > 2 * HELD:
                yield out()
        yield out()

    return run


def _frequent(least: int):
    """Hashes of a bucket that are counted ``least`` times; a task has one bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for batch in batches:
            for keys, sums in zip(batch.column(1), batch.column(2)):
                tally.add(np.frombuffer(keys.as_py(), np.uint64), np.frombuffer(sums.as_py(), np.int64))
        keys, sums = tally.taken()
        keys = keys[sums >= least].view(np.int64)
        for start in range(0, len(keys), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(keys[start : start + (1 << 16)])], ["key"])

    return run


def frequent_bits(chunks: DataFrame, n: int, shorter, least: int = LEAST, bits: int = BITS) -> bytes:
    """Bitmap of the hashes of phrases of ``n`` words that are counted ``least`` times in ``chunks``."""
    buckets = shuffle_partitions(chunks.sparkSession)
    rows = chunks.select("lang", "closed", "chunk", "freq")
    packed = rows.mapInArrow(_counted(n, shorter, buckets), "bucket int, keys binary, sums binary")
    keys = packed.repartitionById(buckets, F.col("bucket")).mapInArrow(_frequent(least), "key long")
    place = keys.select(F.col("key").bitwiseAND((1 << bits) - 1).alias("at"))
    maps = place.groupBy(F.expr(f"at div {BUCKET}").alias("bucket")).agg(F.bitmap_construct_agg(F.col("at") % BUCKET).alias("map"))
    out = np.zeros(max(1, (1 << bits) // BUCKET), dtype=f"V{BUCKET // 8}")
    for row in maps.collect():  # one row for each bucket of the bitmap
        out[row["bucket"]] = bytes(row["map"])
    return out.tobytes()[: (1 << bits) // 8]


def _phrases(frequent):
    """Phrases whose hash is frequent, with their sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = [np.frombuffer(b.value, np.uint8) for b in frequent]
        for batch in batches:
            for start, stop in slices_by_bytes(batch.column(2), HELD_BYTES // 8):
                langs, words = _of(batch, start, stop)
                found: list[tuple[np.ndarray, ...]] = []
                for n, has in enumerate(bits, 1):
                    at = words.phrases(n)
                    keys = runs(words.hashes, n)[at]
                    some = marked(has, keys)
                    at = at[some]
                    _, sums, which = summed(keys[some], words.weights[at])
                    found.append((at[which], sums, np.full(len(which), n)))
                at, sums, size = (np.concatenate(x) for x in zip(*found))
                spans = zip(words.starts[at].tolist(), words.ends[at + size - 1].tolist())
                lang = pa.array(langs, pa.string()).dictionary_encode().take(pa.array(words.chunk[at]))
                raw = words.raw
                yield pa.RecordBatch.from_arrays(
                    [lang.cast(pa.string()), pa.array([raw[a:z] for a, z in spans], pa.binary()), pa.array(size, pa.int32()), pa.array(sums)], ["lang", "phrase", "size", "f"]
                )

    return run


def counted(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, lang_column: str = "lang", text_column: str = "text", period: int = PERIOD, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """Stored tables of all phrases of 1 to ``longest`` words that occur ``least`` times in a language, ``lang, phrase, size, f``,
    and of the words of each language, ``lang, n``."""
    spark = docs.sparkSession
    chunks = dictionary(docs, lang_column, text_column, period)
    totals = stored(chunks.groupBy("lang").agg(F.sum(F.col("words") * F.col("freq")).alias("n")), "totals")
    frequent: list = []
    for n in range(1, longest + 1):
        frequent.append(spark.sparkContext.broadcast(frequent_bits(chunks, n, frequent[-1] if frequent else None, least, bits)))
    rows = chunks.select("lang", "closed", "chunk", "freq").mapInArrow(_phrases(frequent), "lang string, phrase binary, size int, f long")
    exact = rows.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    phrases = stored(exact.select("lang", F.col("phrase").cast("string").alias("phrase"), "size", "f"), "phrases")
    for b in frequent:
        b.destroy()
    return phrases, totals


def collocations(
    docs: DataFrame, least: int = LEAST, top: int = TOP, lang_column: str = "lang", text_column: str = "text", period: int = PERIOD, bits: int = BITS
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` phrases of 2 to 5 words by score.

    A phrase occurs ``a`` times, at least ``least``; of its cuts in two that with the least ``floor(1000 * a * n / (l * r))`` counts,
    where the parts occur ``l`` and ``r`` times and the language has ``n`` words, and the first of equals. Phrases that lie in
    a longer candidate as frequent as they are left out. A-Z are lowered; pieces end at ``.,;:!?`` and line ends.

    A NULL language is ``und``; NULL, empty and blank texts have no words. Repeated rows count as often as they are there. Other
    columns are ignored, whatever their names. An empty table gives no rows. Scores are exact up to 10^15 words.
    """
    phrases, totals = counted(docs, LONGEST, least, lang_column, text_column, period, bits)
    longer = phrases.where("size >= 2").select("lang", "phrase", F.col("f").alias("a"), "size", F.split("phrase", " ").alias("w"))

    def part(start, size):
        return F.array_join(F.slice("w", start, size), " ")

    cuts = longer.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "cut", part(F.lit(1), F.col("cut")).alias("left"), part(F.col("cut") + 1, F.col("size") - F.col("cut")).alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(phrases.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    wide = "cast({} as decimal(18, 0))".format
    scored = cuts.join(totals, "lang").withColumn("score", F.expr(f"({wide('1000 * a')} * {wide('n')}) div ({wide('l')} * {wide('r')})"))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("b")).select("lang", "phrase", "a", "n", "b.score", "b.l", "b.r")
    inner = longer.where("size >= 3").withColumn("size2", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    inner = inner.withColumn("start", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("size2") + 1)))
    around = inner.select("lang", part(F.col("start"), F.col("size2")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    kept = best.join(around, ["lang", "phrase"], "left").where(F.col("around").isNull() | (F.col("around") < F.col("a")))
    ranked = kept.selectExpr("*", "row_number() over (partition by lang order by score desc, a desc, phrase) as rank").where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
