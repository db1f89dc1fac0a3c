"""Packing of documents into sequences of fixed length, by first-fit decreasing in random groups.

A document's token ids and a closing id are cut into whole sequences and a tail. Whole sequences stand alone. Tails are dealt
into random groups, each of which one task packs: in descending length, a tail goes into the first sequence with room for it,
which a tournament tree over the free places of all sequences finds in logarithmic time. Then the emptiest sequences of the
group are taken apart to fill the gaps of the others, so that at most one sequence of a group is left with a gap.
"""

from __future__ import annotations

import json
import os
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from tierloom.llm.common import grouped, shuffle_partitions, stored
from tierloom.llm.words import mix

#: Places of a sequence; the id that closes a document; tokens of tails that a task packs together.
SIZE, CLOSING, GROUP_TOKENS = 1024, 0, 1 << 20
SEED = 11
#: Bytes of an id. Texts of more characters are split in steps. Parts whose ids a worker remembers. Bytes of ids in a batch.
WIDTH, STEP, REMEMBERED, BATCH_BYTES = 4, 1 << 20, 500_000, 4 << 20


#: The first character that may be a letter to one Unicode version and none to another.
UNSURE = "\u0530"


#: Pre-tokens of byte-level tokenizers, as the libraries have them.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_level(layout: dict) -> bool:
    """Whether the tokenizer works on bytes, pre-tokens beginning at single spaces, and changes no text before."""
    before = layout["pre_tokenizer"] or {}
    plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    special = any(" " in t["content"] or t["content"].isalpha() or t["lstrip"] or t["rstrip"] for t in layout["added_tokens"])
    return bool(plain and not special and layout["normalizer"] is None and layout["model"]["type"] == "BPE")


def _byte_symbols() -> dict[int, str]:
    """The character that stands for each byte: itself if it prints, otherwise one from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(others)}


def _merger(layout: dict):
    """The same merges by ranks of byte strings, which take a short part much faster; ``None`` if ranks do not order the merges."""
    import tiktoken

    symbols = {c: b for b, c in _byte_symbols().items()}
    ids, merges = layout["model"]["vocab"], layout["model"]["merges"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
    if any(ids.get(a + b) != 256 + k for k, (a, b) in enumerate(pairs)) or any(ids.get(c, 256) > 255 for c in symbols):
        return None
    added = {t["content"] for t in layout["added_tokens"]}
    ranks = {bytes(symbols[c] for c in token): i for token, i in ids.items() if token not in added}
    return tiktoken.Encoding("merges", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})


class _Parts(dict):
    """Ids of the parts of texts that begin at a space, as bytes, remembered; ``None`` for parts that do not stand alone.

    Byte-level merges never cross the border of a pre-token, and a space before anything but white space begins one. A part
    that is empty, or begins or ends with white space besides that space, may lie in a longer run of white space. Parts of common
    scripts without special tokens are merged by ranks; their ids are the tokenizer's. What comes first stays remembered, later
    parts for a while.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            layout = json.load(file)
        self.byte_level = _byte_level(layout)
        self.merger = _merger(layout) if self.byte_level else None
        self.special = [t["content"][:2] for t in layout["added_tokens"]]
        self.later: dict[str, bytes | None] = {}

    def encoded(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def alone(self, part: str, before: str = "") -> bytes | None:
        """Ids of a part with what stands before it."""
        if not part or part[0].isspace() or part[-1].isspace():
            return None
        if self.merger and max(part) < UNSURE and not any(mark in part for mark in self.special):
            return array("I", self.merger.encode_ordinary(before + part)).tobytes()
        return self.encoded(before + part)

    def __missing__(self, part: str) -> bytes | None:
        if part in self.later:
            return self.later[part]
        value = self.alone(part, " ")
        if len(self) < REMEMBERED:
            self[part] = value
        else:
            if len(self.later) >= REMEMBERED // 2:
                self.later.clear()
            self.later[part] = value
        return value


_known: dict[str, _Parts] = {}


def _parts_of(path: str) -> _Parts:
    if path not in _known:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task for each core
        _known[path] = _Parts(path)
    return _known[path]


def token_bytes(text: str | None, parts: _Parts) -> bytes:
    """Ids of a whole text, four little-endian bytes each; the library's own for a text with runs of white space, and for
    tokenizers of another kind."""
    if not text:
        return b""
    if not parts.byte_level:
        return parts.encoded(text)
    out = []
    try:
        at = 0
        while at < len(text):
            stop = text.find(" ", at + STEP)
            stop = len(text) if stop < 0 else stop
            pieces = text[at:stop].split(" ")
            if at == 0:
                out.append(parts.alone(pieces[0]))
            out.append(b"".join(map(parts.__getitem__, pieces[1:])))
            at = stop
        return b"".join(out)
    except TypeError:  # a part that does not stand alone
        return parts.encoded(text)


def _tokenized(path: str, size: int, closing: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = _parts_of(path)
        end = np.array([closing], "<u4").tobytes()
        task = np.uint64(TaskContext.get().partitionId())
        repeated: Counter = Counter()
        for batch in batches:
            rows: list[tuple[int, int, int, int, bytes]] = []
            held = 0

            def out(rows):
                which, place, total, start, ids = zip(*rows)
                columns = [batch.column(0).take(pa.array(which)), pa.array(place, pa.int64()), pa.array(total, pa.int64()), pa.array(start, pa.int64())]
                return pa.RecordBatch.from_arrays([*columns, pa.array([len(x) // WIDTH for x in ids], pa.int32()), pa.array(ids, pa.binary())], names)

            for i, (key, text) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2))):
                ids = token_bytes(text.as_py(), parts) + end
                with np.errstate(over="ignore"):
                    salt = np.array([repeated[key]], np.uint64) * np.uint64(0x9E3779B97F4A7C15) + task * np.uint64(0xD6E8FEB86659FD93)
                    place = int(mix(mix(salt + np.uint64(SEED)) ^ np.uint64(key & 0xFFFFFFFFFFFFFFFF))[0] >> np.uint64(1))
                repeated[key] += 1
                total = len(ids) // WIDTH
                for start in range(0, total, size):
                    rows.append((i, place, total, start, ids[start * WIDTH : (start + size) * WIDTH]))
                held += len(ids)
                if held > BATCH_BYTES:
                    yield out(rows)
                    rows, held = [], 0
            if rows:
                yield out(rows)

    return run


def tokenized(docs: DataFrame, vocabulary_path: str, size: int = SIZE, closing: int = CLOSING, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, place, total, start, n, ids``: a row for each whole sequence and each tail of every document.

    ``ids`` are four little-endian bytes each. ``place`` is a random number of the document that stays the same when its task runs
    again: it depends on id, text, how many equal rows of the input partition came before, and the number of that partition.
    """
    fields = [StructField("id", docs.schema[id_column].dataType), StructField("place", LongType()), StructField("total", LongType()), StructField("start", LongType()), StructField("n", IntegerType()), StructField("ids", BinaryType())]
    rows = docs.select(F.col(id_column).alias("id"), F.xxhash64(id_column, text_column).alias("key"), F.col(text_column).alias("text"))
    return rows.mapInArrow(_tokenized(vocabulary_path, size, closing, [f.name for f in fields]), StructType(fields))


def first_fit(lengths: list[int], size: int) -> list[int]:
    """The sequence of each piece, taken in the given order: the first with room for it. A tournament tree holds, for each
    sequence and each pair of subtrees, the most free places; sequences not begun yet are free altogether."""
    leaves = 1 << max(0, (len(lengths) - 1)).bit_length()
    free = [size] * (2 * leaves)
    chosen = []
    for n in lengths:
        node = 1
        while node < leaves:
            node *= 2
            if free[node] < n:
                node += 1
        chosen.append(node - leaves)
        free[node] -= n
        while node > 1:
            node //= 2
            most = max(free[2 * node], free[2 * node + 1])
            if free[node] == most:
                break
            free[node] = most
    return chosen


def packed_group(lengths: list[int], size: int) -> list[tuple[int, int, int, int, int]]:
    """``piece, from, n, sequence, offset`` for descending ``lengths`` of at most ``size``. Sequences are numbered from 0."""
    bins: list[list[tuple[int, int, int]]] = [[] for _ in range(len(lengths))]
    fill = [0] * len(lengths)
    for piece, number in enumerate(first_fit(lengths, size)):
        bins[number].append((piece, 0, lengths[piece]))
        fill[number] += lengths[piece]
    gaps = sorted((b for b in range(len(bins)) if 0 < fill[b] < size), key=lambda b: (-fill[b], b))
    full, empty = 0, len(gaps) - 1
    while full < empty:
        to, source = gaps[full], gaps[empty]
        piece, start, n = bins[source].pop()
        some = min(n, size - fill[to])
        bins[to].append((piece, start, some))
        fill[to] += some
        fill[source] -= some
        if some < n:
            bins[source].append((piece, start + some, n - some))
        full += fill[to] == size
        empty -= fill[source] == 0
    out = []
    for number, pieces in enumerate(b for b in bins if b):
        offset = 0
        for piece, start, n in pieces:
            out.append((piece, start, n, number, offset))
            offset += n
    return out


def _packed(size: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["group"]):
            group = group.combine_chunks()
            at = np.array(packed_group(group["n"].to_pylist(), size), np.int64)
            which, start, n, number, offset = at.T
            data = group["ids"].to_pylist()
            ids = [data[i][a * WIDTH : (a + b) * WIDTH] for i, a, b in zip(which.tolist(), start.tolist(), n.tolist())]
            base = group["group"][0].as_py() << 24
            take = pa.array(which)
            columns = [
                group["id"].combine_chunks().take(take), pa.array(group["start"].to_numpy()[which] + start), pa.array(n), pa.array(ids, pa.binary()),
                pa.array(group["total"].to_numpy()[which]), pa.array(2 * (base + number) + 1), pa.array(offset),
            ]
            yield from pa.Table.from_arrays(columns, names).to_batches(max_chunksize=2048)

    return run


def packed(
    docs: DataFrame, vocabulary_path: str, size: int = SIZE, closing: int = CLOSING, group_tokens: int = GROUP_TOKENS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``id, start, length, ids, doc_tokens, sequence_id, offset``: where each piece of each document stands.

    ``ids`` holds the piece's token ids, four little-endian bytes each; ``start`` counts the document's ids before the piece,
    ``doc_tokens`` all of them, the closing one included. Every id is in one piece; the pieces of a sequence follow each other
    without a gap from 0 and hold ``size`` ids together, except in one sequence of each group of about ``group_tokens``.

    NULL, empty and blank texts are tokens as the tokenizer has them and the closing id. NULL ids and repeated rows give pieces of
    their own; repeated rows are dealt over all groups. A text of any length is cut where it is tokenised, so that only tails,
    of less than a sequence, are shuffled. Other columns are ignored, whatever their names. An empty table gives no rows.
    """
    spark: SparkSession = docs.sparkSession
    pieces = stored(tokenized(docs, vocabulary_path, size, closing, id_column, text_column), "tokens")
    tails = pieces.where(F.col("n") < size)
    groups = max(1, -(-(tails.agg(F.sum("n")).first()[0] or 0) // group_tokens))
    tasks = min(groups, max(shuffle_partitions(spark), groups // 16))
    fields = [
        StructField("id", docs.schema[id_column].dataType), StructField("start", LongType()), StructField("length", LongType()), StructField("ids", BinaryType()),
        StructField("doc_tokens", LongType()), StructField("sequence_id", LongType()), StructField("offset", LongType()),
    ]
    dealt = tails.withColumn("group", F.col("place") % groups).repartitionById(tasks, (F.col("group") % tasks).cast("int"))
    ordered = dealt.sortWithinPartitions("group", F.desc("n"), "place", "id", "ids")
    rest = ordered.mapInArrow(_packed(size, [f.name for f in fields]), StructType(fields))
    whole = pieces.where(F.col("n") == size).select(
        "id", "start", F.col("n").cast("long").alias("length"), "ids", F.col("total").alias("doc_tokens"),
        (2 * F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    return whole.unionByName(rest)
