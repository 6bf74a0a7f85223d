"""Tables that are replaced by one commit: immutable version folders, and commits that say which of them are current.

A writer puts new files into a folder of its own and then adds one small commit file. Readers take the folders of the
newest commit, so they see the old table or the new one and never a part; a plan that reads a table goes on reading its
version while the same table is replaced. A failed writer leaves a folder that no commit names. Commits hold one entry
per value of the partition column (periods, months, days), not per file.

Two writers that start from one commit both want the next number; the second fails. This needs a file system whose rename
does not replace, such as HDFS.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_COMMITS = "_commits"
_VERSION = "version"


class PublishConflict(RuntimeError):
    """Another writer has published since the commit that this one started from."""


@dataclass(frozen=True)
class Part:
    """Where the rows of one partition value are, and in which layout (the schema of its version folder)."""

    version: str
    layout: str


@dataclass(frozen=True)
class Commit:
    number: int = 0
    parts: dict[str, Part] = field(default_factory=dict)
    layouts: dict[str, str] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)


def counted(df: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    """The rows, and a function that tells after they are written how many there were, without a second pass."""
    seen = Observation()

    def rows() -> int:
        # the optimizer takes the counting out of a plan that it finds to be empty, and only then
        return seen.get["rows"] if seen._jo.getRow().size() else 0

    return df.observe(seen, F.count(F.lit(1)).alias("rows")), rows


class Folder:
    """The few file operations needed, through the file system that Spark itself uses for the path."""

    def __init__(self, spark: SparkSession, path: str):
        self.path, self._jvm, self._conf = path.rstrip("/"), spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _fs(self):
        return self._at("").getFileSystem(self._conf)

    def names(self, name: str = "") -> list[str]:
        at = self._at(name)
        return sorted(s.getPath().getName() for s in self._fs().listStatus(at)) if self._fs().exists(at) else []

    def exists(self, name: str) -> bool:
        return self._fs().exists(self._at(name))

    def size(self, name: str = "") -> int:
        """Bytes of a file, or of all files of a folder."""
        return self._fs().getContentSummary(self._at(name)).getLength()

    def text(self, name: str) -> str:
        stream = self._fs().open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def delete(self, name: str = "") -> None:
        self._fs().delete(self._at(name), True)

    def put_new(self, name: str, text: str) -> bool:
        """Write a whole file under a name that nobody has taken; False if it is taken."""
        aside = self._at(f"{name.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
        stream = self._fs().create(aside, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if self.exists(name) or not self._fs().rename(aside, self._at(name)):
            self._fs().delete(aside, False)
            return False
        return True


class Published:
    """A table in one folder. column: the text column by whose values parts of it are replaced, None for whole tables."""

    def __init__(self, spark: SparkSession, path: str, column: str | None = None):
        self.spark, self.path, self.column, self.folder = spark, path.rstrip("/"), column, Folder(spark, path)

    # ---- commits

    def commit_numbers(self) -> list[int]:
        return [int(n.split(".")[0]) for n in self.folder.names(_COMMITS) if n.endswith(".json") and n[0] != "."]

    def current(self, number: int | None = None) -> Commit:
        """The newest commit, or an older one by its number."""
        numbers = self.commit_numbers()
        if number is None:
            number = max(numbers, default=0)
        if not number:
            return Commit()
        found = json.loads(self.folder.text(f"{_COMMITS}/{number:012d}.json"))
        return Commit(number, {k: Part(*v) for k, v in found["parts"].items()}, found["layouts"], found["notes"])

    def _publish(self, before: Commit, after: Commit) -> Commit:
        used = {p.layout for p in after.parts.values()} or set(after.layouts)  # an empty table keeps its schema
        after = replace(after, number=before.number + 1, layouts={k: v for k, v in after.layouts.items() if k in used})
        text = json.dumps({"parts": {k: [p.version, p.layout] for k, p in after.parts.items()}, "layouts": after.layouts, "notes": after.notes})
        if not self.folder.put_new(f"{_COMMITS}/{after.number:012d}.json", text):
            raise PublishConflict(f"{self.path}: commit {after.number} exists")
        return after

    # ---- reading

    def read(self, number: int | None = None, schema: T.StructType | None = None) -> DataFrame:
        """The table as of a commit. Parts whose layouts differ are brought to `schema` (default: the newest part's)."""
        commit = self.current(number)
        by_layout: dict[str, list[str]] = {}
        for value, part in commit.parts.items():
            by_layout.setdefault(part.layout, []).append(
                f"{self.path}/{_VERSION}={part.version}" + (f"/{self.column}={_escaped(self.spark, value)}" if self.column else ""))
        schemas = {k: T.StructType.fromJson(json.loads(v)) for k, v in commit.layouts.items()}
        if not schemas and schema is None:
            raise ValueError(f"{self.path}: no such table")
        newest = max(commit.parts.values(), key=lambda p: p.version).layout if commit.parts else next(reversed(schemas), None)
        wanted = schema or schemas[newest]
        if not by_layout:
            return self.spark.createDataFrame([], wanted)
        return reduce(DataFrame.unionByName, [
            typed(self.spark.read.option("basePath", self.path).schema(_with(schemas[k], _VERSION)).parquet(*sorted(set(paths))).drop(_VERSION), wanted)
            for k, paths in by_layout.items()])

    # ---- writing

    def _written(self, df: DataFrame, spread: bool = True) -> tuple[str, str, dict[str, str], int, list[str]]:
        """Write rows to a new version folder in one pass, counted on the way: (version, layout, layouts, rows, values).

        spread: shuffle the rows by value first, or every task writes a file for every value that it meets. Without it rows of
        few values are written where they are, and wide lines are not shuffled for the write alone.
        """
        version = f"{max(self.commit_numbers(), default=0) + 1:012d}-{uuid.uuid4().hex[:8]}"
        rows, count = counted(df)
        if spread:
            rows = rows.hint("rebalance", F.col(self.column)) if self.column else rows.hint("rebalance")
        writer = rows.write.partitionBy(self.column) if self.column else rows.write
        writer.parquet(f"{self.path}/{_VERSION}={version}")
        name = f"layout-{uuid.uuid5(uuid.NAMESPACE_OID, df.schema.json()).hex[:12]}"
        found = [_unescaped(self.spark, n.split("=", 1)[1]) for n in self.folder.names(f"{_VERSION}={version}") if "=" in n] if self.column else [""]
        return version, name, {name: json.dumps(df.schema.jsonValue())}, count(), found

    def refresh(self, df: DataFrame, notes: dict | None = None, spread: bool = True) -> int:
        """Replace the whole table, also by rows that are read from it. Returns the number of rows."""
        before = self.current()
        version, layout, layouts, rows, values = self._written(df, spread)
        self._publish(before, Commit(parts={v: Part(version, layout) for v in values}, layouts=layouts, notes=notes or {}))
        return rows

    def replace(self, df: DataFrame, values: Iterable[str], notes: dict | None = None, spread: bool = True) -> int:
        """Replace the parts of these values, in one commit; a value without rows becomes empty, the others stay.

        A row of any other value fails the job, before anything is published. Returns the number of rows.
        """
        before, values = self.current(), [str(v) for v in values]
        inside = F.coalesce(F.col(self.column).isin(*values), F.lit(False))
        checked = F.when(inside, F.col(self.column)).otherwise(F.raise_error(F.concat(
            F.lit(f"{self.column} is not among the replaced values: "), F.coalesce(F.col(self.column).cast("string"), F.lit("null")))))
        version, layout, layouts, rows, written = self._written(df.withColumn(self.column, checked), spread)
        parts = {v: p for v, p in before.parts.items() if v not in values} | {v: Part(version, layout) for v in written}
        self._publish(before, Commit(parts=parts, layouts=before.layouts | layouts, notes=before.notes | (notes or {})))
        return rows

    def drop(self) -> None:
        """Publish that there is no table; readers of older commits are not disturbed."""
        self._publish(self.current(), Commit())

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete the version folders that none of the last `keep` commits names, and older commits."""
        numbers = sorted(self.commit_numbers())
        kept = {p.version for n in numbers[-keep:] for p in self.current(n).parts.values()}
        gone = [n for n in self.folder.names() if n.startswith(f"{_VERSION}=") and n.split("=", 1)[1] not in kept]
        for name in gone:
            self.folder.delete(name)
        for n in numbers[:-keep]:
            self.folder.delete(f"{_COMMITS}/{n:012d}.json")
        return gone


def _escaped(spark: SparkSession, value: str) -> str:
    """A partition value as Spark writes it in a folder name."""
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def _unescaped(spark: SparkSession, name: str) -> str:
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(name)


def _with(schema: T.StructType, column: str) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(column, T.StringType())])


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a schema in its types; a value that does not fit fails the job, a missing column is null."""
    given, out = {f.name: f.dataType for f in df.schema.fields}, []
    for f in schema.fields:
        if f.name not in given:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif given[f.name] == f.dataType:
            out.append(F.col(f.name))
        else:
            cast = F.col(f.name).try_cast(f.dataType)
            failed = F.raise_error(F.concat(F.lit(f"{f.name}: value does not fit: "), F.col(f.name).cast("string")))
            out.append(F.when(F.col(f.name).isNotNull() & cast.isNull(), failed).otherwise(cast).alias(f.name))
    return df.select(*out)


# ---- two-hop landing ------------------------------------------------------------------------------------------

def _marks(df: DataFrame, column: str) -> dict[str, str]:
    """Per value of a column (rows without one have no mark): rows and two order-free sums of hashes, which tell whether its rows have changed."""
    others = sorted(df.columns)
    found = df.groupBy(column).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*others).cast("decimal(38,0)")).cast("string").alias("a"),
        F.bit_xor(F.xxhash64(F.lit(1), *others)).alias("b"))
    return {r[column]: f"{r['n']}/{r['a']}/{r['b']}" for r in found.filter(F.col(column).isNotNull()).collect()}


def land(source: DataFrame, zone: Published) -> int:
    """First hop: the source as it is becomes the new version of the landing zone, with a mark for each of its months."""
    before = zone.current()
    version, layout, layouts, rows, values = zone._written(source)
    commit = Commit(parts={v: Part(version, layout) for v in values}, layouts=layouts)
    staged = zone.spark.read.option("basePath", zone.path).schema(_with(source.schema, _VERSION)).parquet(f"{zone.path}/{_VERSION}={version}")
    zone._publish(before, replace(commit, notes={"marks": _marks(staged.drop(_VERSION), zone.column)}))
    return rows


def advance(zone: Published, target: Published, first: str) -> list[str]:
    """Second hop: the target takes the months from `first` on that are new or have changed, and gives up those that left.

    Which months these are is known from the commits alone, so a second run without a new landing reads and writes
    nothing. A month that comes late, or late rows of an old month, are taken as any other. Returns the months replaced.
    """
    landed = {m: mark for m, mark in zone.current().notes.get("marks", {}).items() if m >= first}
    taken = target.current().notes.get("marks", {})
    changed = sorted(m for m in landed.keys() | taken.keys() if landed.get(m) != taken.get(m))
    if changed:
        rows = zone.read()
        target.replace(rows.filter(F.col(zone.column).isin(*changed) & (F.col(zone.column) >= first)), changed, {"marks": landed})
    return changed
