"""Tables as versioned Parquet snapshots.

``<root>/version=<n>.<kind>[.<token>]/`` holds one commit. A ``base`` is the whole table,
an ``upsert`` holds rows that replace or extend what lower versions say, and a ``fold`` takes
the place of the upserts since the base. A commit counts once Spark has left ``_SUCCESS`` in
its folder, so a failed write is never read. There is one writer at a time, and versions are
never changed in place.

Keyed tables keep one more column in their files, the place of a row in the order of its
source (a run, or a file of a run). Readers do not see it; a row never replaces one whose
place is later, so it does not matter how the source is cut into upserts.

``_spans/`` keeps what the write of a commit observed: its rows, and the least and greatest
place among them. An upsert whose places all follow those held is decided by these alone,
without a look at the rows of the table; another one reads the commits with later places.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweir.errors import DuplicateSourceKey, SchemaConflict
from lakeweir.functions.values import blank_to_null
from lakeweir.operators.upsert import ambiguous_keys, key_summary, keep_newest
from lakeweir.sources import storage

BASE, UPSERT, FOLD = "base", "upsert", "fold"
FOLD_AFTER = 8
COMPACTED = "compacted"  # token of a base that holds what the commits before it say
ORDER = "_source_order"
_FOLDER = re.compile(r"version=(\d+)\.(base|upsert|fold)(?:\.(.+))?")
_VERSION, _ORIGIN = "__version", "__origin"


@dataclass(frozen=True)
class Commit:
    version: int
    kind: str
    token: str | None
    path: str


@dataclass(frozen=True)
class Span:
    """What a commit holds: rows, those without a place in the source order, and the least and
    greatest place."""

    rows: int
    unplaced: int
    first: str | None
    last: str | None


@dataclass(frozen=True)
class Table:
    """A snapshot table. ``schema`` may be None for tables that are only overwritten; with a
    schema, the table has keys. After ``fold_after`` upserts they become one."""

    spark: SparkSession
    root: str
    schema: T.StructType | None = None
    keys: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    fold_after: int = FOLD_AFTER

    def __post_init__(self):
        if self.schema is not None and not self.keys:
            raise ValueError(f"the table {self.root} needs its key columns")

    # -- commits -----------------------------------------------------------------------

    def _folders(self) -> list[Commit]:
        found = []
        for name in storage.child_folders(self.spark, self.root):
            match = _FOLDER.fullmatch(name)
            if match:
                path = f"{self.root.rstrip('/')}/{name}"
                found.append(Commit(int(match[1]), match[2], match[3], path))
        return sorted(found, key=lambda commit: commit.version)

    def _finished(self, commit: Commit) -> bool:
        return storage.exists(self.spark, f"{commit.path}/_SUCCESS")

    def live(self, until: int | None = None) -> list[Commit]:
        """The newest finished base, and what is finished after it and not folded, oldest
        first; ``until`` ignores later versions."""
        found: list[Commit] = []
        for commit in reversed(self._folders()):
            if until is not None and commit.version > until:
                continue
            folded = any(later.kind == FOLD for later in found)
            if commit.kind != BASE and folded or not self._finished(commit):
                continue
            found.insert(0, commit)
            if commit.kind == BASE:
                return found
        return []

    def exists(self) -> bool:
        return bool(self.live())

    def newest(self) -> Commit | None:
        """The last finished commit."""
        commits = self.live()
        return commits[-1] if commits else None

    def has_token(self, token: str) -> bool:
        return any(c.token == token and self._finished(c) for c in self._folders())

    # -- reading -----------------------------------------------------------------------

    def stored_schema(self) -> T.StructType:
        """The schema found in the files of the live commits: the first that is not the
        declared one, if any. Partition columns have their declared type."""
        declared = {field.name: field for field in self.schema}
        for commit in self.live():
            try:
                found = self.spark.read.parquet(commit.path).schema
            except AnalysisException:  # a partitioned commit without rows has no files
                continue
            fields = [
                declared.get(f.name, f) if f.name in self.partition_by else f
                for f in found
                if f.name != ORDER
            ]
            if {f.name: f.dataType for f in fields} != {f.name: f.dataType for f in self.schema}:
                return T.StructType(fields)
        return self.schema

    def _published_schema(self, commit: Commit) -> T.StructType | None:
        """The schema kept when ``commit`` was written; partition values have no type else."""
        kept = storage.read_text(self.spark, self._schema_path(commit.path))
        return None if kept is None else T.StructType.fromJson(json.loads(kept))

    def _schema_path(self, path: str) -> str:
        folder, name = path.rsplit("/", 1)
        return f"{folder}/_schemas/{name}"

    def _scan(self, commit: Commit) -> DataFrame:
        schema = self.schema or self._published_schema(commit)
        if schema is None:
            return self.spark.read.parquet(commit.path)
        # partition columns come last in a scan; restore the declared order
        return self.spark.read.schema(schema).parquet(commit.path).select(*schema.names)

    def read_snapshot(self) -> DataFrame:
        """The current rows."""
        base, *changes = self.live() or [None]
        if base is None:
            raise FileNotFoundError(f"no finished snapshot under {self.root}")
        if not changes:
            return self._scan(base)
        return self._resolved(base, changes).select(*self.schema.names)

    def _resolved(self, base: Commit | None, changes: Sequence[Commit]) -> DataFrame:
        """The newest rows of each key, with the columns of the files."""
        changed = self._union(changes)
        rows = changed if base is None else self._versioned(base).unionByName(changed)
        # only the changes can replace rows, so only their keys are grouped
        return keep_newest(rows, self.keys, _VERSION, changed, [_ORIGIN]).select(
            *self.schema.names, ORDER
        )

    def changed_since(self, version: int) -> tuple[DataFrame, DataFrame] | None:
        """The current rows that came after ``version``, and the rows of then whose place they
        took. None where the commits do not tell: the table was overwritten, or folders of
        commits are gone.

        The table of then is read for the rows of the changed keys only, and only those are
        grouped; a few changes are broadcast to the scan.
        """
        later = [c for c in self._folders() if c.version > version]
        rewritten = any(c.kind == BASE and c.token != COMPACTED for c in later)
        gaps = [c.version for c in later] != [*range(version + 1, version + 1 + len(later))]
        before = self.live(version)
        if rewritten or gaps or not before or before[-1].version != version:
            return None
        changes = [c for c in later if c.kind == UPSERT and self._finished(c)]
        if not changes:
            none = self._versioned(before[0]).select(*self.schema.names).limit(0)
            return none, none
        came = self._resolved(None, changes).select(*self.schema.names)
        held = self._union(before).join(
            came.select(*self.keys).distinct(), list(self.keys), "left_semi"
        )
        # later commits of then may have replaced earlier ones
        left = keep_newest(held, self.keys, _VERSION, None, [_ORIGIN])
        return came, left.select(*self.schema.names)

    def _union(self, commits: Sequence[Commit]) -> DataFrame:
        rows = self._versioned(commits[0])
        for commit in commits[1:]:
            rows = rows.unionByName(self._versioned(commit))
        return rows

    def _versioned(self, commit: Commit) -> DataFrame:
        """The rows with their version and the file block they come from, which spreads
        rows without a key and costs no column to read."""
        block = F.concat("_metadata.file_name", F.col("_metadata.file_block_start").cast("string"))
        return (
            self.spark.read.schema(T.StructType([*self.schema]).add(ORDER, "string"))
            .parquet(commit.path)
            .select(
                *self.schema.names,
                ORDER,
                F.lit(commit.version).alias(_VERSION),
                block.alias(_ORIGIN),
            )
        )

    # -- writing -----------------------------------------------------------------------

    def _write(self, df: DataFrame, kind: str, token: str | None) -> Commit:
        folders = self._folders()
        version = folders[-1].version + 1 if folders else 0
        suffix = f".{token}" if token else ""
        path = f"{self.root.rstrip('/')}/version={version:08d}.{kind}{suffix}"
        if self.schema is None:
            storage.write_text(self.spark, self._schema_path(path), df.schema.json())
        elif ORDER not in df.columns:
            df = df.withColumn(ORDER, F.lit(None).cast("string"))
        if self.partition_by:
            for name in self.partition_by:
                if isinstance(df.schema[name].dataType, T.StringType):
                    # a partition folder cannot tell '' from NULL
                    df = df.withColumn(name, blank_to_null(F.col(name)))
            # unlike repartition(), a rebalance lets AQE split a partition value that
            # holds a large share of the rows over several tasks and files
            df = df.hint("rebalance", *self.partition_by)
        seen = Observation()
        keyed = self.schema is not None
        writer = df.observe(seen, *_span_of(df)).write if keyed else df.write
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(path)
        if keyed:
            storage.write_text(self.spark, self._span_path(path), json.dumps(seen.get))
        return Commit(version, kind, token, path)

    def _span_path(self, path: str) -> str:
        folder, name = path.rsplit("/", 1)
        return f"{folder}/_spans/{name}"

    def span(self, commit: Commit) -> Span:
        """What the write of ``commit`` observed; read from its rows where that was lost."""
        kept = storage.read_text(self.spark, self._span_path(commit.path))
        if kept is not None:
            return Span(**json.loads(kept))
        rows = self._versioned(commit)
        found = Span(**rows.agg(*_span_of(rows)).first().asDict())
        storage.write_text(self.spark, self._span_path(commit.path), json.dumps(asdict(found)))
        return found

    def init_table(self) -> None:
        """Create the table with its declared schema and no rows, if it is not there."""
        if not self.exists():
            self.write_snapshot(self.spark.createDataFrame([], self.schema))

    def write_snapshot(self, df: DataFrame, token: str | None = None) -> Commit:
        """Publish ``df`` as the whole table."""
        return self._write(df, BASE, token)

    def overwrite(
        self,
        df: DataFrame,
        evolve: bool = False,
        skip_if_empty: bool = False,
        token: str | None = None,
    ) -> Commit | None:
        """Replace all rows; ``evolve`` lets the new rows bring or miss columns."""
        if skip_if_empty and df.isEmpty():
            return None
        if self.exists():
            df = _fit(df, self.read_snapshot().schema, evolve)
        return self.write_snapshot(df, token)

    def upsert(self, source: DataFrame, token: str | None = None) -> Commit | None:
        """Merge ``source`` by key, as a commit of its own size that the next read resolves.

        Rows whose key the table holds from a later place in the source order (the column
        ``ORDER``, where ``source`` has it) are dropped. A ``token`` that is already committed
        makes the call a no-op.

        ``source`` is read several times: pass a written relation.
        """
        if self.schema is None:
            raise ValueError(f"upserts of {self.root} need its schema and key columns")
        if token is not None and self.has_token(token):
            return None
        order = F.col(ORDER) if ORDER in source.columns else F.lit(None).cast("string")
        source = source.select(*self.schema.names, order.alias(ORDER))
        commits = self.live()
        if len(commits) < 2 and not (commits and self.span(commits[0]).rows):
            return self.write_snapshot(source, token)
        hits, first = key_summary(source, self.keys, ORDER)
        if hits > 1:
            self._refuse_ambiguous(source)
        commit = self._write(self._without_late(source, commits, first), UPSERT, token)
        self._fold()
        return commit

    def _without_late(
        self, source: DataFrame, commits: Sequence[Commit], first: str | None
    ) -> DataFrame:
        """``source`` without the rows whose key the table holds from a later place; its least
        place is ``first``."""
        spans = [self.span(commit) for commit in commits]
        ahead = [
            commit
            for commit, span in zip(commits, spans, strict=True)
            if first is not None and span.last is not None and span.last > first
        ]
        if not ahead:
            return source
        placed = [i for i, span in enumerate(spans) if span.last is not None]
        if any(span.unplaced for span in spans[placed[0] + 1 :]):
            # a later row without a place has taken the place away from its key
            held = self._resolved(commits[0], commits[1:])
        else:
            # places of a key only rise, so its highest one is that of its current row
            held = self._union(ahead)
        later = held.where(F.col(ORDER) > first).select(*self.keys, F.col(ORDER).alias("__held"))
        late = source.select(*self.keys, ORDER).join(later, list(self.keys))
        late = late.where(F.col("__held") > F.col(ORDER)).select(*self.keys, ORDER).distinct()
        return source.join(late, [*self.keys, ORDER], "left_anti").select(*source.columns)

    def _fold(self) -> None:
        """Make one commit of the changes since the base, once there are many."""
        _, *changes = self.live()
        if len(changes) > self.fold_after:
            self._write(self._resolved(None, changes), FOLD, None)

    def compact(self) -> Commit | None:
        """Rewrite the table as a new base, if anything changed since the last one."""
        base, *changes = self.live()
        return self._write(self._resolved(base, changes), BASE, COMPACTED) if changes else None

    def _refuse_ambiguous(self, source: DataFrame) -> None:
        # the target is only scanned when the source has duplicate keys at all
        clash = ambiguous_keys(self.read_snapshot(), source, self.keys).first()
        if clash is not None:
            raise DuplicateSourceKey(
                f"several source rows carry {clash.asDict()}, a key of {self.root}"
            )


def _span_of(df: DataFrame) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(ORDER).isNull()).alias("unplaced"),
        F.min(ORDER).alias("first"),
        F.max(ORDER).alias("last"),
    ]


def _fit(df: DataFrame, published: T.StructType, evolve: bool) -> DataFrame:
    old = {field.name: field.dataType for field in published}
    new = {field.name: field.dataType for field in df.schema}
    changed = sorted(name for name in old.keys() & new.keys() if old[name] != new[name])
    if changed:
        raise SchemaConflict(f"columns change their type: {', '.join(changed)}")
    if old.keys() != new.keys() and not evolve:
        raise SchemaConflict(f"columns differ: {', '.join(sorted(old.keys() ^ new.keys()))}")
    return df.select(
        *[
            F.col(f"`{name}`") if name in new else F.lit(None).cast(old[name]).alias(name)
            for name in [*old, *[name for name in new if name not in old]]
        ]
    )


def read_snapshot(
    spark: SparkSession, root: str, schema: T.StructType | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    return Table(spark, root, schema, tuple(keys)).read_snapshot()
