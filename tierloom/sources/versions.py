"""Tables in versions, each published whole.

A table is a folder. Every load writes its files into a new folder under ``data`` and, when the job has ended well, one small
manifest under ``_manifests``; the manifest with the highest number is the table. A load that ends half way leaves no
manifest, so that readers go on seeing the version before, and nothing that is being read is ever removed by a load.

A manifest also has the schema and the rows that were counted while they were written, so that counting a table, or
telling the rows a gate held back, reads no data.
"""

from __future__ import annotations

import datetime
import json
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Column and partition folder that tell the outcomes of a split load apart.
OUTCOME = "load_outcome"
PASSED, HELD_BACK = "passed", "held_back"


class PublishConflict(RuntimeError):
    """Another load published the same version first; the rows of this one are not in the table."""


@dataclass(frozen=True)
class Version:
    """What a manifest says."""

    number: int
    folder: str
    rows: int
    seconds: float
    committed: str
    schema: str
    outcomes: dict[str, int] = field(default_factory=dict)

    def struct(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))


class _Folder:
    """Hadoop's file system, whichever the path is in."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._path = path.rstrip("/")
        self._fs = self.at().getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def at(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self._path, *parts]))

    def names(self, part: str) -> dict[str, float]:
        """Names in a folder, with the seconds since they were last changed."""
        if not self._fs.exists(self.at(part)):
            return {}
        return {s.getPath().getName(): time.time() - s.getModificationTime() / 1000 for s in self._fs.listStatus(self.at(part))}

    def read(self, *parts: str) -> str:
        stream = self._fs.open(self.at(*parts))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, text: str, *parts: str) -> None:
        """A new file; fails where there is one."""
        stream = self._fs.create(self.at(*parts), False)
        try:
            stream.write(text.encode("utf-8"))
        finally:
            stream.close()

    def delete(self, *parts: str) -> None:
        self._fs.delete(self.at(*parts), True)


def _manifest(number: int) -> str:
    return f"{number:020d}.json"


def _numbers(folder: _Folder) -> list[int]:
    return sorted(int(name.removesuffix(".json")) for name in folder.names("_manifests") if name.endswith(".json") and not name.startswith("."))


def _loaded(folder: _Folder, number: int) -> Version | None:
    """The version of a manifest; ``None`` for one whose writer was lost before it was whole."""
    try:
        return Version(**json.loads(folder.read("_manifests", _manifest(number))))
    except json.JSONDecodeError:
        return None


def versions(spark: SparkSession, path: str) -> list[Version]:
    """All versions of the table at ``path``, oldest first."""
    folder = _Folder(spark, path)
    return [v for n in _numbers(folder) if (v := _loaded(folder, n))]


def current(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """The newest version, or the one of that number."""
    folder = _Folder(spark, path)
    for n in [number] if number is not None else reversed(_numbers(folder)):
        if (number is None or n in _numbers(folder)) and (version := _loaded(folder, n)):
            return version
    raise FileNotFoundError(f"{path} has no version" + ("" if number is None else f" {number}"))


def publish(
    df: DataFrame,
    path: str,
    columns: Sequence[str] | None = None,
    partition_by: Sequence[str] = (),
    outcomes: Mapping[str, Column] | None = None,
) -> Version:
    """Store ``df`` as the next version of the table at ``path``; rows are counted while they are written.

    ``columns`` fixes which are stored and in which order. ``outcomes`` splits the rows in the same write: each row goes to
    the first outcome whose condition holds, in a partition of its own, and each is counted. Rows that meet none fail the load.

    Raises :class:`PublishConflict` if another load published meanwhile.
    """
    spark, folder = df.sparkSession, _Folder(df.sparkSession, path)
    number = max(_numbers(folder), default=0) + 1
    chosen = df.select(*columns) if columns else df
    if outcomes:
        outcome = F.raise_error(F.lit("a row has no outcome")).cast("string")
        for name, condition in reversed(outcomes.items()):
            outcome = F.when(condition, F.lit(name)).otherwise(outcome)
        chosen = chosen.withColumn(OUTCOME, outcome)
        partition_by = (OUTCOME, *partition_by)
    counts = Observation()
    kinds = [F.count_if(F.col(OUTCOME) == name).alias(f"n{i}") for i, name in enumerate(outcomes or ())]
    began, data = time.perf_counter(), f"data/{uuid.uuid4().hex}"
    chosen.observe(counts, F.count(F.lit(1)).alias("rows"), *kinds).write.partitionBy(*partition_by).parquet(f"{path.rstrip('/')}/{data}")
    found = counts.get
    last = [f for f in chosen.schema if f.name in partition_by]  # partition columns come last when they are read
    schema = StructType([f for f in chosen.schema if f.name not in partition_by] + sorted(last, key=lambda f: list(partition_by).index(f.name)))
    version = Version(
        number, data, found["rows"], time.perf_counter() - began, datetime.datetime.now(datetime.UTC).isoformat(), schema.json(),
        {name: found[f"n{i}"] for i, name in enumerate(outcomes or ())},
    )
    try:
        folder.create(json.dumps(version.__dict__), "_manifests", _manifest(number))
    except Exception as error:
        if number in _numbers(folder):
            raise PublishConflict(f"version {number} of {path} was published by another load") from error
        raise
    return version


def read_version(spark: SparkSession, path: str, number: int | None = None, outcome: str | None = None) -> DataFrame:
    """The newest version, or the one of that number; with ``outcome``, only rows of that outcome, without the column.

    The result goes on reading this version whatever is published later, until the version is expired.
    """
    version = current(spark, path, number)
    rows = spark.read.schema(version.struct()).parquet(f"{path.rstrip('/')}/{version.folder}")
    return rows if outcome is None else rows.where(F.col(OUTCOME) == outcome).drop(OUTCOME)


def expire(spark: SparkSession, path: str, keep: int = 2, grace: float = 86_400) -> list[int]:
    """Remove all but the newest ``keep`` versions, and what ended loads have left that never published; the numbers removed.

    Manifests go first, so that no reader finds one without its data. A folder without a manifest is removed only if nothing
    changed in it for ``grace`` seconds: a load may be writing it.
    """
    if keep < 1:
        raise ValueError("the newest version cannot expire")
    folder = _Folder(spark, path)
    known = versions(spark, path)
    old, kept = known[:-keep], known[-keep:]
    for version in old:
        folder.delete("_manifests", _manifest(version.number))
    for version in old:
        folder.delete(version.folder)
    named = {v.folder for v in kept}
    for name, age in folder.names("data").items():
        if f"data/{name}" not in named and age > grace:
            folder.delete("data", name)
    return [v.number for v in old]


def recorded_counts(spark: SparkSession, paths: Mapping[str, str], prefix: str = "") -> DataFrame:
    """``table_name, row_count, version`` of the newest versions, as counted when they were written; reads manifests alone."""
    lines = [(prefix + name, v.rows, v.number) for name, path in paths.items() for v in [current(spark, path)]]
    return spark.createDataFrame(lines, "table_name string, row_count bigint, version int")

