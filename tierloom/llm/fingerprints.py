"""Context-triggered piecewise hashes of documents, and how alike two of them are.

A hash of the last seven bytes ends a chunk wherever it fits the block size; every chunk gives one character of the
signature. The block size follows the length, so that a signature has some 64 characters, and a second
signature at twice the block size makes fingerprints of neighbouring block sizes comparable.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tierloom.llm.common import stored
from tierloom.llm.words import mix

WINDOW = 7
LENGTH = 64
LEAST_BLOCK = 3
#: Signatures without a common run of so many characters (or of the whole shorter one) are not alike at all.
COMMON = 4
#: Bytes of text in a range of neighbouring documents.
RANGE_BYTES = 16 << 20
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_REPEATS = re.compile(r"(.)\1{3,}")
_STEP = np.uint64(0x9E3779B97F4A7C15)
_STEP_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


@functools.lru_cache(maxsize=None)
def _values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64))


@functools.lru_cache(maxsize=None)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _STEP, np.uint64), np.full(size, _STEP_BACK, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def fingerprint(data: bytes) -> str:
    """``block size:signature:signature at twice the block size``; ``3::`` of no bytes."""
    n = len(data)
    if n == 0:
        return f"{LEAST_BLOCK}::"
    values = _values()[np.frombuffer(data, np.uint8)]
    up, down = _powers(1 << n.bit_length())
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up[:n], out=total[1:])
    first = np.maximum(np.arange(1, n + 1) - WINDOW, 0)
    rolling = mix((total[1:] - total[first]) * down[first]) >> np.uint64(11)

    def signature(block: int, most: int) -> tuple[str, int]:
        ends = np.flatnonzero(rolling % np.uint64(block) == np.uint64(block - 1)) + 1
        found = len(ends)
        ends = ends[: most - 1]  # as in the published scheme, the last character covers all that is left
        if len(ends) == 0 or ends[-1] < n:
            ends = np.append(ends, n)
        starts = np.concatenate([[0], ends[:-1]])
        chunks = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        return ALPHABET[(chunks >> np.uint64(58)).astype(np.int64)].tobytes().decode(), found

    block = LEAST_BLOCK
    while block * LENGTH < n:
        block *= 2
    while True:
        own, found = signature(block, LENGTH)
        if block == LEAST_BLOCK or found >= LENGTH // 2:
            break
        block //= 2
    return f"{block}:{own}:{signature(2 * block, LENGTH // 2)[0]}"


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row of the table being the bits of one number."""
    full = (1 << len(a)) - 1
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _alike(a: str, b: str) -> float:
    """1 less the edit distance (insertions and deletions) over the greatest there can be."""
    a, b = _REPEATS.sub(r"\1\1\1", a), _REPEATS.sub(r"\1\1\1", b)
    run = min(COMMON, len(a), len(b))
    if run == 0:
        return 0.0
    if {a[i : i + run] for i in range(len(a) - run + 1)}.isdisjoint(b[i : i + run] for i in range(len(b) - run + 1)):
        return 0.0
    return 2 * _common(a, b) / (len(a) + len(b))


def likeness(x: str, y: str) -> float:
    """0 to 1. Equal fingerprints have 1; those whose block sizes differ by more than a factor of 2 have 0."""
    if x == y:
        return 1.0
    (a, a1, a2), (b, b1, b2) = x.split(":"), y.split(":")
    a, b = int(a), int(b)
    if a == b:
        return max(_alike(a1, b1), _alike(a2, b2))
    if a == 2 * b:
        return _alike(a1, b2)
    if b == 2 * a:
        return _alike(a2, b1)
    return 0.0


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter of characters replaced by as many of the beginning of ``following``."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


RESULT = [("n_chars", LongType()), ("edited_sha256", StringType()), ("fingerprint", StringType()), ("edited_fingerprint", StringType()), ("near_edited", DoubleType()), ("near_next", DoubleType())]
#: What is known of a range's first and last row, which meet the rows of other ranges: the range, which of the two, the text.
EDGE = [("range", IntegerType()), ("is_first", BooleanType()), ("text", StringType())]


def _result(text: str, own: str, following: str, following_print: str) -> tuple:
    """The columns of ``RESULT`` for a text and the one after it."""
    changed = edited(text, following).encode("utf-8")
    print_ = fingerprint(changed)
    return len(text), hashlib.sha256(changed).hexdigest(), own, print_, likeness(own, print_), likeness(own, following_print)


def _in_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of the rows of a sorted range, each with the one after it; its first and last row are handed on as edges."""
    range_ = TaskContext.get().partitionId()
    last: tuple | None = None
    ids: pa.DataType | None = None
    for batch in batches:
        ids, out = batch.schema.types[0], []
        for id_, text in zip(*(batch.column(i) for i in (0, 1))):
            text = text.as_py()
            own = fingerprint(text.encode("utf-8"))
            if last is None:
                out.append((id_, None, None, own, None, None, None, range_, True, text))
            else:
                out.append((last[0], *_result(*last[1:], text, own), None, None, None))
            last = id_, text, own
        yield _batch(out, ids)
    if last is not None:
        yield _batch([(last[0], None, None, last[2], None, None, None, range_, False, last[1])], ids)


def _at_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of the last rows of ranges: id, text, fingerprint, next text, its fingerprint."""
    for batch in batches:
        out = [(row[0], *_result(*(v.as_py() for v in row[1:]))) for row in zip(*batch.columns)]
        yield _batch(out, batch.schema.types[0])


def _batch(rows: list[tuple], ids: pa.DataType) -> pa.RecordBatch:
    kinds = [ids, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.bool_(), pa.string()]
    columns = list(zip(*rows)) or [()] * (1 + len(RESULT))
    names = ["id", *(name for name, _ in RESULT + EDGE)][: len(columns)]
    own = pa.array([v.as_py() for v in columns[0]], ids)
    return pa.RecordBatch.from_arrays([own, *(pa.array(c, k) for c, k in zip(columns[1:], kinds[1:]))], names)


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprint of every text and of its edited text, and the likeness to the edited and to the next one.

    The next document is the one with the next larger id, the first one after the last; rows of one id follow each
    other by the hash of their text. NULL ids come first. NULL is the empty text. A single row is its own next. Texts are
    hashed whole. Other columns are ignored. Ids may be of any type that can be ordered, and keep it.

    Texts are shuffled once, to ranges of id, hash of the text and place in the input, so that rows of one id (or none), or that
    repeat it with their text, fill as many ranges as their size asks for. The input's partitions must reread alike. Only the first and last row of each
    range leave it: the last one meets the first one of the next range in a join of one row for each range.
    """
    kind = docs.schema[id_column].dataType
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    rows = rows.select("id", F.xxhash64("text").alias("key"), F.monotonically_increasing_id().alias("place"), "text")
    n_bytes = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    order = [F.asc_nulls_first("id"), F.asc("key"), F.asc("place")]
    ranged = rows.repartitionByRange(max(1, -(-n_bytes // RANGE_BYTES)), *order).sortWithinPartitions(*order).select("id", "text")

    result = [StructField("id", kind), *(StructField(*column) for column in RESULT)]
    edge = [StructField(*column) for column in EDGE]
    found = stored(ranged.mapInArrow(_in_range, StructType(result + edge)), "fingerprints")

    firsts, lasts = found.where("is_first"), found.where("NOT is_first")
    in_order = Window.orderBy("range")  # one number for each range
    follows = firsts.select("range").select(
        "range", F.coalesce(F.lead("range").over(in_order), F.min("range").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("next")
    )
    following = firsts.select(F.col("range").alias("next"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print"))
    pairs = lasts.join(follows, "range").join(following, "next").select("id", "text", "fingerprint", "next_text", "next_print")
    inside = found.where("is_first IS NULL").select(*(field.name for field in result))
    out = inside.unionByName(pairs.mapInArrow(_at_edges, StructType(result)))
    return out.withColumnRenamed("id", id_column)
