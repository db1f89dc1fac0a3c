"""Repair of the turn structure of conversations at the least cost, by a Viterbi search in parallel chunks.

Rows are ordered by range, so that a long conversation lies in many partitions, and cut into chunks. Each chunk runs backward
from a speculative vector of costs, one for each state that may follow it. Fix-up passes rerun the chunks whose successor
turned out to begin with other costs, until all vectors differ from the ones they were run with only by constants; where costs
never converge, as in long runs of one role, the rest is stitched from the chunks' transfer costs. With the right costs at its
end, each chunk is traced forward, taking the alphabetically least edit that leads to the least cost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from tierloom.llm.common import shuffle_partitions, stored

#: Distinct rows of a chunk; fix-up passes before the rest is stitched.
CHUNK, PASSES = 4096, 4
#: Costs of edits, and of a truncated row that stays.
RETITLE, DELETE, INSERT, CUT = 3, 4, 3, 3
#: States: nothing yet, after a system row, a user row, an assistant row.
BEGUN, SYSTEM, USER, ASSISTANT = range(4)
#: The state after the user or assistant row that may follow each state; what keeping a row of a role initial leads to.
NEXT = (USER, USER, ASSISTANT, USER)
KEPT = {(BEGUN, "s"): SYSTEM, (BEGUN, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ROLES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = ("su", "ua", "au")
FAR = 1 << 40
SPACE, NOT_SPACE = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with faults: by the crc32 of ``conv:turn`` modulo 20, 0 is dropped, 1 loses its text, 2 its sentence ends, 3 stands twice, 4 becomes the user's.

    NULLs in role and text, and in the text that is hashed, are one space.
    """
    as_text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn)]
    kind = F.crc32(F.concat(as_text[0], F.lit(":"), as_text[1]).cast("binary")) % 20
    filled = rows.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(role, F.lit(" ")).alias("role"), F.coalesce(text, F.lit(" ")).alias("text"), kind.alias("kind"))
    broken = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    changed = filled.where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), broken.alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(0))).otherwise(F.array(F.lit(0)))).alias("again"),
    )
    return changed.drop("again")


def closed(a: int, b: int, c: int, d: int) -> tuple[int, int, int, int]:
    """Costs of the states when rows may be inserted first."""
    c, d = min(c, INSERT + d), min(d, INSERT + c)
    return min(a, INSERT + c), min(b, INSERT + c), c, d


ENDED = closed(0, FAR, FAR, 0)
Live = tuple[str, bool]


def before(row: Live, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs before a row, from those after it."""
    initial, cut = row
    stay = CUT if cut else 0
    best = []
    for state in range(4):
        cost = min(DELETE + after[state], RETITLE + stay + after[NEXT[state]])
        kept = KEPT.get((state, initial))
        best.append(cost if kept is None else min(cost, stay + after[kept]))
    return closed(*best)


def level(costs: tuple[int, ...]) -> tuple[int, ...]:
    """The vector up to a constant."""
    least = min(costs)
    return tuple(min(c - least, FAR) for c in costs)


def backward(rows: list[Live], end: tuple[int, ...]) -> list[tuple[int, ...]]:
    """Costs before each row and after the last, each up to a constant of its own pair with the next."""
    costs = [tuple(end)]
    for row in reversed(rows):
        costs.append(before(row, costs[-1]))
    costs.reverse()
    return costs


def transfer(rows: list[Live]) -> list[list[int]]:
    """The cost of getting from each state before the rows to each state after them."""
    ends = [backward(rows, closed(*(0 if q == state else FAR for q in range(4))))[0] for state in range(4)]
    return [[min(ends[to][state], FAR) for to in range(4)] for state in range(4)]


def traced(rows: list[Live], costs: list[tuple[int, ...]], state: int, last: bool) -> tuple[list[tuple[str, int]], int]:
    """Edits in order, each with the state it leads to, and the last state; ``last`` ends the conversation."""
    edits = []
    for i, row in enumerate(rows):
        initial, cut = row
        stay = CUT if cut else 0
        while True:
            cost, after = costs[i][state], costs[i + 1]
            if cost == DELETE + after[state]:
                edits.append(("D", state))
                break
            if cost == INSERT + costs[i][NEXT[state]]:
                state = NEXT[state]
                edits.append(("I", state))
                continue
            kept = KEPT.get((state, initial))
            if kept is not None and cost == stay + after[kept]:
                state = kept
                edits.append(("K", state))
            else:
                state = NEXT[state]
                edits.append(("R", state))
            break
    while last and state not in (BEGUN, ASSISTANT):
        state = NEXT[state]
        edits.append(("I", state))
    return edits, state


# A chunk's rows as they are stored: distinct rows in order with how often each is there.
ROW = StructType([
    StructField("turn", LongType()), StructField("h1", LongType()), StructField("h2", LongType()), StructField("initial", StringType()),
    StructField("blank", BooleanType()), StructField("earlier", BooleanType()), StructField("cut", BooleanType()), StructField("m", LongType()),
])


def live_rows(rows: list[dict]) -> list[Live]:
    return [(r["initial"], r["cut"]) for r in rows if not r["blank"] and not r["earlier"]]


def _chunks(chunk: int, fields: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        conv, rows, found = None, [], []

        def summed() -> dict:
            inside = sum(r["m"] - 1 + (i > 0 and rows[i - 1]["initial"] + r["initial"] not in LEGAL) for i, r in enumerate(rows))
            return {
                "conv": conv, "chunk": number, "rows": rows, "start": list(level(backward(live_rows(rows), ENDED)[0])),
                "first": rows[0]["initial"], "last": rows[-1]["initial"], "illegal": inside, "blank": sum(r["m"] for r in rows if r["blank"]),
                "duplicate": sum(r["m"] - (not r["earlier"]) for r in rows if not r["blank"]), "truncated": sum(r["cut"] for r in rows if not r["blank"] and not r["earlier"]),
            }

        def out(schema) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(found, schema)

        schema = None
        for batch in batches:
            if schema is None:
                row = pa.struct([batch.schema.field(n) for n in fields])
                narrow = [("first", pa.string()), ("last", pa.string()), *((n, pa.int64()) for n in ("illegal", "blank", "duplicate", "truncated"))]
                schema = pa.schema([("conv", batch.schema.field("conv").type), ("chunk", pa.int64()), ("rows", pa.list_(row)), ("start", pa.list_(pa.int64())), *narrow])
            for r in batch.to_pylist():
                name = r.pop("conv")
                if rows and (name != conv or len(rows) >= chunk):
                    found.append(summed())
                    number += 1
                    rows = []
                conv = name
                rows.append(r)
            if len(found) >= 2048:
                yield out(schema)
                found.clear()
        if rows:
            found.append(summed())
        if found:
            yield out(schema)

    return run


def _rerun(row: dict) -> dict:
    return {"chunk": row["chunk"], "again": list(level(backward(live_rows(row["rows"]), tuple(row["next"]))[0]))}


def _transferred(row: dict) -> dict:
    flat = [c for costs in transfer(live_rows(row["rows"])) for c in costs]
    return {"conv": row["conv"], "chunk": row["chunk"], "costs": flat}


def _left(row: dict) -> dict:
    live = live_rows(row["rows"])
    costs = backward(live, tuple(row["end"]))
    return {"conv": row["conv"], "chunk": row["chunk"], "exits": [traced(live, costs, state, False)[1] for state in range(4)]}


def _stitched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs at the end of each chunk, last chunks first."""
    conv, costs = object(), ENDED
    for batch in batches:
        ends = []
        for row in batch.to_pylist():
            if row["conv"] != conv:
                conv, costs = row["conv"], ENDED
            ends.append({"chunk": row["chunk"], "right": list(level(costs))})
            t = row["costs"]
            costs = level(tuple(min(t[4 * q + r] + costs[r] for r in range(4)) for q in range(4)))
        if ends:
            yield pa.RecordBatch.from_pylist(ends)


def _entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state each chunk begins in, first chunks first."""
    conv, state = object(), BEGUN
    for batch in batches:
        begins = []
        for row in batch.to_pylist():
            if row["conv"] != conv:
                conv, state = row["conv"], BEGUN
            begins.append({"chunk": row["chunk"], "entry": state})
            state = row["exits"][state]
        if begins:
            yield pa.RecordBatch.from_pylist(begins)


def _edited(row: dict) -> dict:
    rows, live = row["rows"], live_rows(row["rows"])
    edits = iter(traced(live, backward(live, tuple(row["end"])), row["entry"], row["is_last"])[0])
    audit, lines, cost = [], [], 0

    def emit(edit: str, state: int, source: dict | None) -> None:
        role = ROLES[state] if edit in "IR" else None
        at = source or {"turn": None, "h1": None, "h2": None}
        lines.append({"seq": len(lines), "turn": at["turn"], "h1": at["h1"], "h2": at["h2"], "role": role, "inserted": edit == "I"})

    for r in rows:
        forced = r["m"]
        if not r["blank"] and not r["earlier"]:
            forced -= 1
            for edit, state in edits:
                audit.append(edit)
                cost += {"D": DELETE, "I": INSERT, "K": 0, "R": RETITLE}[edit]
                if edit == "I":
                    emit(edit, state, None)
                    continue
                if edit != "D":
                    emit(edit, state, r)
                    cost += CUT if r["cut"] else 0
                break
        audit.append("D" * forced)
        cost += DELETE * forced
    for edit, state in edits:
        audit.append(edit)
        cost += INSERT
        emit(edit, state, None)
    return {"conv": row["conv"], "chunk": row["chunk"], "audit": "".join(audit), "cost": cost, "lines": lines}


def _typed(kernel, types: list[tuple[str, str]], df: DataFrame) -> DataFrame:
    """``df`` through ``kernel`` row by row; the conversation's type is that of ``df``."""
    schema = StructType([StructField(n, df.schema["conv"].dataType if t == "conv" else _type(t)) for n, t in types])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema, prefers_large_types=False)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                yield pa.RecordBatch.from_pylist([kernel(r) for r in batch.slice(start, 512).to_pylist()], arrow)

    return df.mapInArrow(run, schema)


def _type(ddl: str):
    return {"long": LongType(), "int": IntegerType(), "string": StringType(), "costs": ArrayType(LongType()), "lines": ArrayType(StructType.fromDDL("seq int, turn bigint, h1 bigint, h2 bigint, role string, inserted boolean"))}[ddl]


def hashed(rows: DataFrame) -> DataFrame:
    """Rows with 128 bits that stand for role and text."""
    return rows.withColumn("h1", F.xxhash64("role", "text")).withColumn("h2", F.xxhash64(F.lit(7), "text", "role"))


def chunked(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Stored chunks of the rows of ``conv, turn, role, text``, in the order of conversations and turns. Chunk numbers ascend in that order.

    Equal rows of a turn are one row with a count before anything is shuffled by order, and texts are left behind as 128 bits.
    """
    fault = [
        F.substring("role", 1, 1).alias("initial"), (~F.col("text").rlike(NOT_SPACE)).alias("blank"), (~F.col("text").rlike(rf"[.!?]{SPACE}*\z")).alias("cut"),
    ]
    distinct = hashed(rows).groupBy("conv", "turn", "h1", "h2", *fault).agg(F.count("*").alias("m"))
    firsts = distinct.where(~F.col("blank")).groupBy(F.col("conv").alias("c"), F.col("h1").alias("a"), F.col("h2").alias("b")).agg(F.min(F.struct("turn")).alias("f"))
    seen = distinct.join(firsts, F.col("conv").eqNullSafe(F.col("c")) & (F.col("h1") == F.col("a")) & (F.col("h2") == F.col("b")), "left")
    earlier = ~F.col("blank") & ~F.col("turn").eqNullSafe(F.col("f.turn"))
    flat = seen.select("conv", "turn", "h1", "h2", "initial", "blank", earlier.alias("earlier"), F.col("cut"), "m")
    order = ["conv", "turn", "h1", "h2"]
    ranged = flat.repartitionByRange(shuffle_partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    narrow = [StructField("first", StringType()), StructField("last", StringType()), *(StructField(n, LongType()) for n in ("illegal", "blank", "duplicate", "truncated"))]
    schema = StructType([StructField("conv", rows.schema["conv"].dataType), StructField("chunk", LongType()), StructField("rows", ArrayType(ROW)), StructField("start", ArrayType(LongType())), *narrow])
    return stored(ranged.mapInArrow(_chunks(chunk, ROW.names), schema), "chunks")


def settled(chunks: DataFrame, passes: int = PASSES) -> DataFrame:
    """``conv, chunk, end``: the right costs after each chunk, up to a constant; stored."""
    in_order = Window.partitionBy("conv").orderBy("chunk")
    ended = F.array(*[F.lit(c).cast("long") for c in level(ENDED)])
    state = chunks.select("conv", "chunk", "start", ended.alias("end"))
    for _ in range(passes):
        state = stored(state.withColumn("next", F.lead("start").over(in_order)), "costs")
        stale = state.where(F.col("next").isNotNull() & (F.col("next") != F.col("end")))
        if stale.isEmpty():
            return state.select("conv", "chunk", "end")
        again = _typed(_rerun, [("chunk", "long"), ("again", "costs")], chunks.select("conv", "chunk", "rows").join(stale.select("chunk", "next"), "chunk"))
        state = state.join(again, "chunk", "left").select("conv", "chunk", F.coalesce("again", "start").alias("start"), F.coalesce("next", "end").alias("end"))
    state = stored(state.withColumn("next", F.lead("start").over(in_order)), "costs")
    unsettled = state.groupBy("conv").agg(F.max(F.col("next").isNotNull() & (F.col("next") != F.col("end"))).alias("open")).where("open").select(F.col("conv").alias("c"))
    left = chunks.select("conv", "chunk", "rows").join(unsettled, F.col("conv").eqNullSafe(F.col("c")), "left_semi")
    costs = _typed(_transferred, [("conv", "conv"), ("chunk", "long"), ("costs", "costs")], left)
    right = costs.repartition("conv").sortWithinPartitions("conv", F.desc("chunk")).mapInArrow(_stitched, "chunk long, right array<bigint>")
    return stored(state.join(right, "chunk", "left").select("conv", "chunk", F.coalesce("right", "end").alias("end")), "costs")


def edited(chunks: DataFrame, ends: DataFrame) -> DataFrame:
    """``conv, chunk, audit, cost, lines, …``: each chunk's edits, and the lines that it leaves; stored."""
    in_order = Window.partitionBy("conv").orderBy("chunk")
    placed = ends.select("conv", "chunk", "end", F.lead("chunk").over(in_order).isNull().alias("is_last"), F.lag("chunk").over(in_order).isNull().alias("is_first"))
    rows = chunks.select("chunk", "rows")
    several = placed.where(~(F.col("is_first") & F.col("is_last"))).join(rows, "chunk")
    exits = _typed(_left, [("conv", "conv"), ("chunk", "long"), ("exits", "costs")], several.select("conv", "chunk", "rows", "end"))
    entries = exits.repartition("conv").sortWithinPartitions("conv", "chunk").mapInArrow(_entered, "chunk long, entry long")
    begun = placed.join(rows, "chunk").join(entries, "chunk", "left").select("conv", "chunk", "rows", "end", "is_last", F.coalesce("entry", F.lit(BEGUN)).alias("entry"))
    return stored(_typed(_edited, [("conv", "conv"), ("chunk", "long"), ("audit", "string"), ("cost", "long"), ("lines", "lines")], begun), "edits")


def _named(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    return rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))])


def repaired_lines(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """``conv, chunk, seq, role, text``: the repaired conversations; lines are in the order of ``chunk, seq``."""
    lines = edits.select("conv", "chunk", F.explode("lines").alias("l")).select("conv", "chunk", "l.*")
    texts = hashed(rows).dropDuplicates(["conv", "turn", "h1", "h2"]).select(F.col("conv").alias("c"), F.col("turn").alias("t"), F.col("h1").alias("a"), F.col("h2").alias("b"), F.col("role").alias("old"), "text")
    same = F.col("conv").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t")) & (F.col("h1") == F.col("a")) & (F.col("h2") == F.col("b"))
    kept = lines.where("not inserted").join(texts, same).select("conv", "chunk", "seq", F.coalesce("role", "old").alias("role"), "text")
    return kept.unionByName(lines.where("inserted").select("conv", "chunk", "seq", "role", F.lit("").alias("text")))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, digest = None, None
    schema = None
    for batch in batches:
        schema = schema or pa.schema([batch.schema.field("conv"), ("repaired_sha256", pa.string())])
        done = []
        for name, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "role", "text"))):
            if digest is None or name != conv:
                if digest is not None:
                    done.append({"conv": conv, "repaired_sha256": digest.hexdigest()})
                conv, digest = name, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        yield pa.RecordBatch.from_pylist(done, schema)
    if digest is not None:
        yield pa.RecordBatch.from_pylist([{"conv": conv, "repaired_sha256": digest.hexdigest()}], schema)


def repaired(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", chunk: int = CHUNK, passes: int = PASSES
) -> tuple[DataFrame, DataFrame]:
    """A report of each conversation, and the repaired lines.

    The report has ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``; lines are those of
    :func:`repaired_lines`. Rows are taken by turn, NULL first; rows of one turn by a hash of role and text, equal ones next to
    each other. NULL roles and texts are one space, NULL conversations are one conversation, an empty table has no report.
    Other columns are ignored.

    A conversation of any length is split over tasks, but for its digest: its repaired texts pass through one task, a row at a
    time, as SHA-256 has no other way.
    """
    named = _named(rows, conv, turn, role, text)
    chunks = chunked(named, chunk)
    edits = edited(chunks, settled(chunks, passes))
    in_order = Window.partitionBy("conv").orderBy("chunk")
    joint: Column = F.concat(F.lag("last").over(in_order), F.col("first"))
    faults = chunks.select("conv", "chunk", "blank", "duplicate", "truncated", (F.col("illegal") + F.coalesce((~joint.isin(*LEGAL)).cast("long"), F.lit(0))).alias("illegal"))
    counts = faults.groupBy("conv").agg(*[F.sum(n).alias(n) for n in ("blank", "duplicate", "truncated", "illegal")])
    audits = edits.groupBy("conv").agg(F.sum("cost").alias("cost"), F.sort_array(F.collect_list(F.struct("chunk", "audit"))).alias("a")).select("conv", "cost", F.array_join("a.audit", "").alias("audit"))
    turns = named.select("conv", "turn").groupBy("conv", "turn").agg(F.count("*")).groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps")
    )
    lines = repaired_lines(named, edits)
    digest_type = StructType([StructField("conv", named.schema["conv"].dataType), StructField("repaired_sha256", StringType())])
    digests = lines.repartition("conv").sortWithinPartitions("conv", "chunk", "seq").select("conv", "role", "text").mapInArrow(_digests, digest_type)
    report = turns
    for part in (counts, audits, digests):
        other = part.withColumnRenamed("conv", "c")
        report = report.join(other, report["conv"].eqNullSafe(other["c"]), "left").drop("c")
    empty = hashlib.sha256(b"").hexdigest()
    return report.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.lit(empty))), lines


def audited(original: DataFrame, rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The report of ``rows``, with every conversation of ``original``; those without rows have zeros and an empty audit."""
    report, _ = repaired(rows, conv, turn, role, text)
    every = original.select(F.col(conv).alias("id")).distinct()
    full = every.join(report, F.col("id").eqNullSafe(F.col("conv")), "left")
    numbers = [F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return full.select(F.col("id").alias(conv), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
