"""Tables as snapshot folders behind a pointer.

A table is a folder with two hidden folders in it::

    <path>/_snapshots/<load>/...    data, written once and never changed
    <path>/_commits/<n>.json        what the table consists of from commit n on

A commit names the data folders that make up the table, the load that wrote each, the rows of
each, the table's columns, and the high mark of its incremental loads. It is written under
another name and renamed in one step, and the rename fails if the number is taken. So a
reader sees the table before or after a commit, never between; a write that dies leaves a
folder that no commit names; the bookmark moves together with the rows it stands for; and the
second of two writers that began at the same commit is refused. On a store whose rename
isn't atomic, writers of one table must take turns.

Folders that no recent commit names are deleted by :meth:`SnapshotTable.retain` alone, so
a reader that began before a replacement finishes on what it began with.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .writers import write_observed


class CommitConflict(RuntimeError):
    """Another writer has committed since this one read the table."""


@dataclass(frozen=True)
class Part:
    """One data folder of a table: a load's rows, or one kind of them."""

    folder: str
    rows: int
    load_id: str
    kind: str = ""


@dataclass(frozen=True)
class Commit:
    number: int
    schema: str
    parts: tuple[Part, ...]
    load_id: str
    rows_loaded: int
    high: str | None = None
    loads: dict = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(p.rows for p in self.parts)


class SnapshotTable:
    """Reads and commits one table below ``path``; nothing is cached between calls."""

    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet"):
        self.spark, self.path, self.fmt = spark, path.rstrip("/"), fmt

    # -- the pointer

    def _hadoop(self, below: str):
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{below}" if below else self.path)
        return target, target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        """The commits there are, oldest first."""
        folder, fs = self._hadoop("_commits")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def commit(self, number: int | None = None) -> Commit | None:
        """Commit ``number``, or the latest; ``None`` if the table has none."""
        if number is None:
            found = self.numbers()
            if not found:
                return None
            number = found[-1]
        file, fs = self._hadoop(f"_commits/{number:012d}.json")
        stream = fs.open(file)
        try:
            raw = json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Commit(**{**raw, "parts": tuple(Part(**p) for p in raw["parts"])})

    def exists(self) -> bool:
        return bool(self.numbers())

    def plain(self) -> bool:
        """The path is an ordinary folder of files, which no write through this class has touched."""
        folder, fs = self._hadoop("")
        return bool(fs.exists(folder)) and not self.begun()

    def adopt(self, mark: str | None = None) -> Commit:
        """Make an ordinary folder a snapshot table, by one copy of its rows; ``mark``: the column whose
        greatest value becomes the high mark. Plain readers of the folder go on to see the old files."""
        rows = self.spark.read.format(self.fmt).load(self.path)
        high = rows.agg(F.max(F.col(mark)).cast("string").alias("high")).first()["high"] if mark else None
        return self.replace(rows, high=high)

    def begun(self) -> bool:
        """A write has begun, whether or not it was ever committed."""
        folder, fs = self._hadoop("_snapshots")
        return bool(fs.exists(folder))

    def _publish(self, commit: Commit) -> Commit:
        body = json.dumps({**commit.__dict__, "parts": [p.__dict__ for p in commit.parts]})
        draft, fs = self._hadoop(f"_commits/.draft-{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(body.encode()))
        out.close()
        final, _ = self._hadoop(f"_commits/{commit.number:012d}.json")
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), conf).rename(draft, final, none)
        except Exception as e:
            fs.delete(draft, False)
            if fs.exists(final):
                raise CommitConflict(f"{self.path}: commit {commit.number} was taken by another writer") from e
            raise
        return commit

    # -- reading

    def read(self, number: int | None = None, kind: str | None = None) -> DataFrame:
        """The table as of a commit (the latest); ``kind`` reads only such parts."""
        at = self.commit(number)
        if at is None:
            raise FileNotFoundError(f"{self.path} has no commit")
        schema = StructType.fromJson(json.loads(at.schema))
        folders = [f"{self.path}/_snapshots/{p.folder}" for p in at.parts if kind is None or p.kind == kind]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.format(self.fmt).schema(schema).load(folders)

    # -- writing

    def _write(self, df: DataFrame, folder: str, metrics: dict[str, Column], partition_by: list[str] | None) -> dict:
        """Write a folder and count it again from what can be read back."""
        target = f"{self.path}/_snapshots/{folder}"
        got = write_observed(df, target, self.fmt, "errorifexists", partition_by, metrics)
        found = self.spark.read.format(self.fmt).schema(df.schema).load(target).count() if got["rows_loaded"] else 0
        if found != got["rows_loaded"]:
            raise RuntimeError(f"wrote {got['rows_loaded']} rows but {found} read back; the table is unchanged")
        return got

    def replace(self, df: DataFrame, load_id: str | None = None, *, drop_null_columns: bool = False,
                high: str | None = None, partition_by: list[str] | None = None, expected_rows: int | None = None,
                kind: str = "", after: Commit | None = None) -> Commit:
        """The table becomes ``df``, which may read the table. One write.

        ``after``: the commit that ``df`` was made from; refused if another one has come since.

        ``drop_null_columns`` leaves columns without any value out of the table's columns (P11),
        counted while writing; an empty table keeps all.
        """
        before = self._since(after)
        folder = load_id = load_id or uuid.uuid4().hex
        folder = f"{folder}-{uuid.uuid4().hex[:8]}"
        counts = {f"c{i}": F.count(F.col(f"`{c}`")) for i, c in enumerate(df.columns)} if drop_null_columns else {}
        got = self._write(df, folder, counts, partition_by)
        n = int(got["rows_loaded"])
        if expected_rows is not None and n != expected_rows:
            raise RuntimeError(f"wrote {n} rows, expected {expected_rows}; the table is unchanged")
        fields = [f for i, f in enumerate(df.schema.fields) if not counts or n == 0 or got[f"c{i}"] > 0]
        return self._publish(Commit(before.number + 1 if before else 1, StructType(fields).json(),
                                    (Part(folder, n, load_id, kind),) if n else (), load_id, n, high,
                                    before.loads if before else {}))

    def _since(self, after: Commit | None) -> Commit | None:
        before = self.commit()
        if after is not None and before != after:
            raise CommitConflict(f"{self.path}: another writer has committed since commit {after.number}")
        return before

    def append(self, df: DataFrame, load_id: str | None = None, *, mark: str | None = None, kind: str = "",
               loads: dict[str, int] | None = None, after: Commit | None = None) -> Commit:
        """Add ``df``; with ``mark``, a column, the high mark moves to its greatest value.

        New columns join the table's columns; rows written before have null there. A load without
        rows changes nothing and returns the latest commit.
        """
        before = self._since(after)
        load_id = load_id or uuid.uuid4().hex
        folder = f"{load_id}-{uuid.uuid4().hex[:8]}"
        got = self._write(df, folder, {"high": F.max(F.col(mark)).cast("string")} if mark else {}, None)
        n = int(got["rows_loaded"])
        if n == 0 and before is not None:
            return replace(before, load_id=load_id, rows_loaded=0)
        schema = StructType.fromJson(json.loads(before.schema)) if before else StructType()
        known = {f.name.lower(): f for f in schema.fields}
        for f in df.schema.fields:
            if f.name.lower() not in known:
                schema = schema.add(f.name, f.dataType, True)
            elif known[f.name.lower()].dataType != f.dataType:
                raise ValueError(f"{self.path}: column {f.name} is {known[f.name.lower()].dataType.simpleString()}, not {f.dataType.simpleString()}")
        highs = [h for h in (before.high if before else None, got.get("high")) if h is not None]
        parts = (before.parts if before else ()) + ((Part(folder, n, load_id, kind),) if n else ())
        return self._publish(Commit(before.number + 1 if before else 1, schema.json(), parts, load_id, n,
                                    max(highs, default=None), {**(before.loads if before else {}), **(loads or {})}))

    def restate(self, df: DataFrame, by: str, replaced: list[str], load_id: str | None = None) -> Commit:
        """Write ``df`` in one pass into one part for each value of the string column ``by``, and
        let these take the place of the parts of the kinds ``replaced``; all other parts stay as
        they are. The column ``by`` isn't stored in the rows; it is a part's kind."""
        before = self.commit()
        load_id = load_id or uuid.uuid4().hex
        folder = f"{load_id}-{uuid.uuid4().hex[:8]}"
        self._write(df, folder, {}, [by])
        rows = df.drop(by)
        back = self.spark.read.format(self.fmt).schema(df.schema).load(f"{self.path}/_snapshots/{folder}")
        counts = {r[by]: r["count"] for r in back.groupBy(by).count().collect()}
        new = tuple(Part(f"{folder}/{by}={k}", n, load_id, k) for k, n in sorted(counts.items()))
        kept = tuple(p for p in before.parts if p.kind not in replaced) if before else ()
        return self._publish(Commit(before.number + 1 if before else 1, rows.schema.json(), kept + new, load_id,
                                    sum(counts.values()), before.high if before else None, before.loads if before else {}))

    def retain(self, commits: int = 2) -> int:
        """Forget all but the latest ``commits`` commits and delete the folders that none of
        them names; returns how many folders went. Not while a write to the table is under way."""
        numbers = self.numbers()
        if not numbers:
            return 0
        keep = numbers[-max(1, commits):]
        named = {p.folder.split("/")[0] for n in keep for p in self.commit(n).parts}
        for n in numbers:
            if n not in keep:
                file, fs = self._hadoop(f"_commits/{n:012d}.json")
                fs.delete(file, False)
        folder, fs = self._hadoop("_snapshots")
        gone = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName() not in named] if fs.exists(folder) else []
        for path in gone:
            fs.delete(path, True)
        return len(gone)
