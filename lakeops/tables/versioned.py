"""Tables with a history, kept as append-only Parquet folders.

``rows/_version=N/_gen=G``   rows first written by version N, with ``_row_id`` unique
                             inside the version and, for a rewritten row, the identity
                             of the row it replaces. Generation 0 is new data; higher
                             generations are copies made by maintenance.
``removed/_version=N``       identities of the rows version N retired.
``history/version=N``        one row per version, written last. Readers follow only what
                             is listed here, so a failed write stays invisible.
``maintenance/seq=K``        one row per vacuum.

A table made with ``partition_by`` has a folder level for each of those columns below
``_gen``; a filter on them lists and reads only the folders it names, removals or not.

A version descends from ``parent``; it holds the rows of every version on its line of
descent minus the rows removed on it. Overwrite and optimize start a new line (no
parent); restore continues an old one, so it moves no data. One writer is assumed.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops import scratch
from lakeops.operators import dml
from lakeops.operators.layout import clustered, sort_tasks, target_tasks
from lakeops.operators.sizing import BROADCAST_ROWS, fits_broadcast
from lakeops.operators.skew import join_one_per_key
from lakeops.sinks.files import open_files
from lakeops.sources.files import file_inventory, literal_rows

LONG, LONGS = T.LongType(), T.ArrayType(T.LongType())
ROW_COLUMNS = [T.StructField(n, LONG) for n in ("_row_id", "_old_version", "_old_row_id")]
PLACE_COLUMNS = [T.StructField("_version", LONG), T.StructField("_gen", T.IntegerType())]
REMOVED_SCHEMA = "_origin long, _row_id long"
HISTORY_SCHEMA = (
    T.StructType()
    .add("ts", T.TimestampType())
    .add("operation", T.StringType())
    .add("params", T.MapType(T.StringType(), T.StringType()))
    .add("schema", T.StringType())
    .add("rows_added", LONG)
    .add("rows_removed", LONG)
    .add("parent", LONG)
    .add("gen", T.IntegerType())
    .add("touched", LONGS)
    .add("partition_by", T.ArrayType(T.StringType()))
)
MAINTENANCE_SCHEMA = (
    T.StructType()
    .add("ts", T.TimestampType())
    .add("horizon", LONG)
    .add("applied", LONGS)
    .add("rewritten", LONGS)
    .add("emptied", LONGS)
)
# Operations after which rows a stream has passed on are no longer the table's.
REPLACING = ("UPDATE", "MERGE", "OVERWRITE", "RESTORE")
RESERVED = {"_row_id", "_old_version", "_old_row_id", "_version", "_gen", "_hits", "_new", "_match"}
MIN_RETENTION_HOURS = 168
# What replaced rows have as their old version when all rows were, and the row id that a
# restore writes for streams. No real version or row is negative.
WHOLE_TABLE = MARKER = -1


class VersionNotAvailable(LookupError):
    """The version never existed, or a vacuum has removed it."""


class CommitConflict(RuntimeError):
    """Another writer took the version number."""


class RowsReplaced(RuntimeError):
    """Rows that a stream has passed on were replaced, or an old version was restored."""


def _allowed(refused: Column, message: str) -> Column:
    return F.when(refused, F.raise_error(F.lit(message)).cast("boolean")).otherwise(True)


def _folder_value(name: str, kind: T.DataType) -> Column:
    """A partition value that is read back as it was written."""
    if not isinstance(kind, (T.StringType, T.VarcharType, T.CharType)):
        return F.col(name)
    message = F.lit(f"partition column {name} holds an empty string, which a folder name cannot tell from null")
    return F.when(F.col(name) == "", F.raise_error(message).cast("string")).otherwise(F.col(name))


@dataclass
class Commit:
    version: int
    parent: int | None
    gen: int
    rows_added: int
    rows_removed: int
    touched: list[int]
    schema: str
    partition_by: list[str] = field(default_factory=list)

    @property
    def columns(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


@dataclass
class Snapshot:
    """What a version is made of. Small: one entry per commit on its line."""

    version: int
    schema: T.StructType
    line: list[Commit]
    gens: dict[int, int] = field(default_factory=dict)
    applied: set[int] = field(default_factory=set)

    @property
    def partition_by(self) -> list[str]:
        return self.line[-1].partition_by

    @property
    def versions(self) -> set[int]:
        return {c.version for c in self.line}

    @property
    def live_rows(self) -> int:
        root = self.line[0]
        return root.rows_added + sum(c.rows_added - c.rows_removed for c in self.line[1:])

    @property
    def removals(self) -> list[Commit]:
        """Commits whose removals a reader still has to apply."""
        return [c for c in self.line[1:] if c.touched and c.version not in self.applied]


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._log: dict[int, Commit] = {}
        self._past: list = []

    # -- reading -----------------------------------------------------------

    def history(self) -> DataFrame:
        """One row per version."""
        log = self.spark.read.schema(
            T.StructType(HISTORY_SCHEMA.fields + [T.StructField("version", T.LongType())])
        )
        return log.parquet(f"{self.path}/history")

    def current_version(self) -> int:
        return max(self._commits())

    def version_at(self, moment: datetime) -> int:
        """The version that was current at a point in time."""
        if moment.tzinfo is None:
            moment = moment.replace(tzinfo=timezone.utc)
        version = self.history().where(F.col("ts") <= F.lit(moment)).agg(F.max("version")).first()[0]
        if version is None:
            raise VersionNotAvailable(f"{self.path} has no version at {moment}")
        return version

    def as_of(self, version: int | None = None, timestamp: datetime | None = None) -> DataFrame:
        """The table at a version or time; the current one by default."""
        if timestamp is not None:
            version = self.version_at(timestamp)
        state = self._snapshot(version)
        return self._live(state).select(state.schema.names)

    def read(self) -> DataFrame:
        return self.as_of()

    def stream(
        self, on_change: str = "error", max_files: int | None = None, from_version: int | None = None
    ) -> DataFrame:
        """The rows of a version, then new rows as later versions commit them.

        It starts from the current version, whatever rewrites came before it. A later
        process that goes on with the same checkpoint states that ``from_version`` again.
        Later deletions are not followed. Rows that replace older ones (update, upsert,
        overwrite) and a restore are no additions: ``on_change`` says whether they fail the
        stream, are skipped or are passed on (a restore passes on nothing). A vacuum that
        rewrites folders the stream reads fails it: what it has not seen may be gone.
        The schema is that of the start; a later column needs a restart.

        A filter on the stream may be pushed to the files and hide replaced rows, and a
        restore writes none: the rows alone cannot tell. The writer of the stream therefore
        calls ``guard`` in every micro-batch (``streaming.aggregates`` does it for guards it
        is given).
        """
        if on_change not in ("error", "skip", "emit"):
            raise ValueError(on_change)
        state = self._snapshot(from_version)
        gens = {v: g for v, g in state.gens.items() if v in state.versions}
        if from_version is not None and any(g > 1 for g in gens.values()):
            raise VersionNotAvailable(f"a vacuum rewrote rows of version {from_version}; start anew")
        fields = T.StructType(state.schema.fields + ROW_COLUMNS + PLACE_COLUMNS)
        reader = self.spark.readStream.schema(fields).option("basePath", f"{self.path}/rows")
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        # Folders neither part of the start nor new are pruned by their names.
        rows = reader.parquet(f"{self.path}/rows/_version=*/_gen=*")
        version, gen, later = F.col("_version"), F.col("_gen"), F.col("_version") > state.version
        started = F.lit(False)
        for g in sorted(set(gens.values())):
            started = started | ((gen == g) & version.isin([v for v, own in gens.items() if own == g]))
        moved = (gen > 1) & ~started & (later | version.isin(sorted(gens)))
        rows = rows.where(started | moved | (later & (gen == 0)))
        rows = rows.where(_allowed(moved, "stream: a vacuum rewrote its rows; start it anew"))
        replaces = later & F.col("_old_version").isNotNull()
        if on_change == "skip":
            rows = rows.where(~replaces)
        elif on_change == "error":
            rows = rows.where(_allowed(replaces, "stream: rows were replaced; restart with on_change='skip' or 'emit'"))
        rows = rows.where(F.col("_row_id") != MARKER)
        if state.removals:
            rows = rows.join(self._removed(state.removals), ["_version", "_row_id"], "left_anti")
        return rows.select(state.schema.names)

    def guard(self, on_change: str = "error", from_version: int | None = None) -> Callable[[], None]:
        """A check for the batch writer of a stream with the same arguments.

        It reads the history since the stream's start, one row a version, and raises
        ``RowsReplaced`` after an update, upsert or overwrite that replaced rows, or a
        restore. Only ``on_change="error"`` checks anything.
        """
        start = self._snapshot(from_version).version
        path = self.path
        replaced = (F.col("rows_removed") > 0) | F.col("operation").isin("OVERWRITE", "RESTORE")

        def check() -> None:
            if on_change != "error":
                return
            later = VersionedTable(self.spark, path).history().where(F.col("version") > start)
            found = later.where(F.col("operation").isin(*REPLACING) & replaced).orderBy("version").first()
            if found is not None:
                raise RowsReplaced(
                    f"version {found.version} of {path} ({found.operation}) replaced rows of a running stream; "
                    "restart it, or pass on_change='skip' or 'emit'"
                )

        return check

    def diff(self, before: int, after: int) -> DataFrame:
        """Rows in one version and not in the other, with ``change`` added or removed.

        Rows are matched by identity. Versions only one side descends from are read
        whole, shared ones only through the other side's removals.
        """
        old, new = self._snapshot(before), self._snapshot(after)
        shared = old.versions & new.versions
        schema = dml.evolved_schema(old.schema, new.schema, True)

        def only_in(side: Snapshot, other: Snapshot, change: str) -> DataFrame:
            live = self._live(side)
            own = live.where(~F.col("_version").isin(sorted(shared))) if shared else live
            parts = [own]
            dropped = [c for c in other.removals if c.version not in side.versions]
            touched = {v for c in dropped for v in c.touched} & shared
            if touched:
                gone = self._removed(dropped)
                parts.append(
                    live.where(F.col("_version").isin(sorted(touched))).join(
                        gone, ["_version", "_row_id"], "left_semi"
                    )
                )
            rows = [dml.conform(p.select(side.schema.names), schema) for p in parts]
            out = rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])
            return out.select(F.lit(change).alias("change"), *schema.names)

        return only_in(new, old, "added").unionByName(only_in(old, new, "removed"))

    def files(self, version: int | None = None) -> DataFrame:
        """The data files a version reads, with their sizes."""
        state = self._snapshot(version)
        paths = self._row_paths(state, state.versions)
        if not paths:
            return self.spark.createDataFrame([], "path string, size_bytes long, _version int, _gen int")
        base = f"{self.path}/rows"
        found = file_inventory(self.spark, *[f"{base}/{p}" for p in paths], base=base)
        kinds = [F.col(c).cast(state.schema[c].dataType).alias(c) for c in state.partition_by]
        return found.select("path", "size_bytes", "_version", "_gen", *kinds)

    def file_ranges(self, columns: Sequence[str]) -> DataFrame:
        """One row per data file of the current version: its rows, the partition values, and
        ``min_c`` and ``max_c`` of the columns, which decide whether a filter reads it."""
        state = self._snapshot()
        rows = self._read_rows(state.schema, self._row_paths(state, state.versions))
        keys = [F.col("_metadata.file_path").alias("path"), *state.partition_by]
        bounds = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
        return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *bounds)

    def detail(self) -> DataFrame:
        """Format, version, row count, file count and bytes of the current version.

        ``pending_removals`` rows are filtered out by every read; when they are many,
        optimize is due.
        """
        state = self._snapshot()
        return self.files().agg(
            F.lit("parquet").alias("format"),
            F.lit(state.version).cast("long").alias("version"),
            F.lit(state.live_rows).cast("long").alias("num_rows"),
            F.lit(sum(c.rows_removed for c in state.removals)).cast("long").alias("pending_removals"),
            F.count(F.lit(1)).alias("num_files"),
            F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("long").alias("size_bytes"),
            F.lit(",".join(state.partition_by)).alias("partition_columns"),
            F.count_distinct(F.struct(*state.partition_by)).alias("num_partitions")
            if state.partition_by
            else F.lit(0).cast("long").alias("num_partitions"),
        )

    # -- writing -----------------------------------------------------------

    @classmethod
    def create(
        cls, spark: SparkSession, path: str, df: DataFrame, partition_by: Sequence[str] = ()
    ) -> VersionedTable:
        """Version 0 from a query; also how a Parquet folder becomes a versioned table.

        ``partition_by`` columns become folder levels of every later version too. As in any
        partitioned Parquet folder an empty string cannot be told from null there, so
        writing one is an error.
        """
        table = cls(spark, path)
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
        by = list(partition_by)
        unknown = set(by) - set(schema.names)
        if unknown or len(set(by)) < len(by) or len(by) == len(schema):
            raise dml.SchemaMismatch(f"cannot partition by {by}")
        for name in by:
            if isinstance(schema[name].dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
                raise dml.SchemaMismatch(f"cannot partition by {name}: {schema[name].dataType.simpleString()}")
        table._commit("CREATE", None, schema, rows=df, fresh=True, partition_by=by)
        return table

    def append(self, df: DataFrame, merge_schema: bool = False) -> int:
        state = self._snapshot()
        schema = dml.evolved_schema(state.schema, df.schema, merge_schema)
        return self._commit("APPEND", state, schema, rows=dml.conform(df, schema))

    def insert(self, rows: Iterable[tuple]) -> int:
        state = self._snapshot()
        return self._commit(
            "INSERT", state, state.schema, rows=literal_rows(self.spark, rows, state.schema)
        )

    def overwrite(self, df: DataFrame, merge_schema: bool = False) -> int:
        """Replace the content. Starts a new line, so old rows are retired unread."""
        state = self._snapshot()
        schema = dml.evolved_schema(state.schema, df.schema, merge_schema)
        rows = dml.conform(df, schema).withColumn("_old_version", F.lit(WHOLE_TABLE).cast("long"))
        return self._commit("OVERWRITE", state, schema, rows=rows, fresh=True)

    def delete(self, predicate: Column) -> int:
        """Record the identities of matching rows; no row is rewritten.

        Identities are few bytes from many tasks, so they are gathered into few files.
        """
        state = self._snapshot()
        gone = self._live(state).where(predicate).select(F.col("_version").alias("_origin"), "_row_id")
        params = {"predicate": str(predicate)}
        return self._commit("DELETE", state, state.schema, removed=gone.hint("rebalance"), params=params)

    def update(
        self, predicate: Column, assignments: dict[str, Column | object], gather: bool = False
    ) -> int:
        """Write new forms of matching rows only.

        By default each task writes its own, without a shuffle. ``gather`` is for
        predicates few rows meet: it shuffles those rows into few files.
        """
        state = self._snapshot()
        values = dml.assigned(state.schema, assignments)
        changed = self._live(state).where(predicate).select(
            *[values.get(c, F.col(c)).alias(c) for c in state.schema.names], *self._replaced()
        )
        changed = changed.hint("rebalance") if gather else changed
        return self._commit("UPDATE", state, state.schema, rows=changed, params={"predicate": str(predicate)})

    def merge(self, source: DataFrame, on: Sequence[str]) -> int:
        """Upsert. The source is written down first, so both uses of it agree and
        its size is known exactly."""
        state = self._snapshot()
        staging = f"{self.path}/staging/_version={state.version + 1}"
        dml.aligned(source, state.schema).write.mode("overwrite").parquet(staging)
        staged = self.spark.read.schema(state.schema).parquet(staging)
        small = fits_broadcast(staged)
        live = self._live(state)
        changed = (
            join_one_per_key(live, dml.one_per_key(staged, on), on, "inner", small)
            .where(dml.matched_flag())
            .select(*[F.col("_new")[c].alias(c) for c in state.schema.names], *self._replaced())
        )
        new = dml.unmatched_source(live, staged, on, small).select(
            *state.schema.names,
            F.lit(None).cast("long").alias("_old_version"),
            F.lit(None).cast("long").alias("_old_row_id"),
        )
        written = changed.unionByName(new).hint("rebalance")
        version = self._commit("MERGE", state, state.schema, rows=written, params={"on": ",".join(on)})
        scratch.delete(self.spark, staging)
        return version

    def restore(self, version: int) -> int:
        """Make an old version current again. Writes a history row and no data, but for a
        marker that only streams look at."""
        old, state = self._snapshot(version), self._snapshot()
        number = state.version + 1
        done = self._commit("RESTORE", old, old.schema, params={"to": str(version)}, number=number)
        # The marker's file starts a micro-batch, whose guard then finds the history row.
        marker = literal_rows(self.spark, [(MARKER, WHOLE_TABLE, None)], T.StructType(ROW_COLUMNS))
        marker.write.mode("overwrite").parquet(f"{self.path}/rows/_version={number}/_gen=0")
        return done

    def optimize(self, cluster_by: Sequence[str] = (), target_bytes: int = 128 * 1024 * 1024) -> int:
        """Same rows in few, optionally clustered, files with removals applied.

        In a partitioned table files are laid out inside each partition; several cluster
        columns of any ordered type are laid along one curve.
        """
        state = self._snapshot()
        within = set(cluster_by) & set(state.partition_by)
        if within:
            raise ValueError(f"{sorted(within)} are folders already; cluster by other columns")
        size = self.files().agg(F.coalesce(F.sum("size_bytes"), F.lit(0))).first()[0]
        tasks = target_tasks(size, target_bytes)
        if state.partition_by or cluster_by:
            tasks = max(tasks, sort_tasks(state.live_rows, state.schema))
        laid = clustered(self._live(state), state.partition_by, cluster_by, tasks, ["_version", "_row_id"])
        return self._commit(
            "OPTIMIZE", state, state.schema, rows=laid.select(state.schema.names), fresh=True, gen=1,
            params={"cluster_by": ",".join(cluster_by)}, placed=True,
        )

    def vacuum(self, retain_hours: float = MIN_RETENTION_HOURS, force: bool = False) -> int:
        """Delete what no version younger than the retention needs.

        Folders no retained version descends from are dropped whole. Folders that
        hold retired rows are rewritten without them; all others are left alone.
        Returns the oldest version that stays readable.
        """
        if retain_hours < MIN_RETENTION_HOURS and not force:
            raise ValueError(
                f"retention of {retain_hours} h is below {MIN_RETENTION_HOURS} h; pass force=True to allow it"
            )
        now = datetime.now(timezone.utc)
        cutoff = now - timedelta(hours=retain_hours)
        commits, past = self._commits(), self._maintenance()
        seq = len(past) + 1
        gens = self._gens(commits, past)
        done = {v for m in past for v in m.applied}
        old = self.history().where(F.col("ts") <= F.lit(cutoff)).agg(F.max("version")).first()[0]
        horizon = max([m.horizon for m in past] + [old if old is not None else min(commits)])

        needed: set[int] = set()
        shared: list[set[int]] = []
        for version in (v for v in commits if v >= horizon):
            parent = commits[version].parent
            if parent is None or parent < horizon:
                line = self._line(commits, version)
                shared.append({c.version for c in line[1:] if c.touched})
                needed.update(c.version for c in line)
            needed.add(version)
        # Removals that every retained version shares can be applied for good.
        everywhere = set.intersection(*shared)
        apply = [commits[v] for v in sorted(everywhere - done)]
        rewrite = {v for c in apply for v in c.touched} & needed & set(gens)
        left = self._rewrite_without(apply, rewrite, gens, seq + 1)

        self._write_row(
            f"{self.path}/maintenance/seq={seq}",
            (now, horizon, sorted(everywhere | done), sorted(left), sorted(rewrite - left)),
            MAINTENANCE_SCHEMA,
        )
        for version in commits:
            if version not in needed:
                scratch.delete(self.spark, f"{self.path}/rows/_version={version}")
            elif version in rewrite:
                scratch.delete(self.spark, f"{self.path}/rows/_version={version}/_gen={gens[version]}")
            if version in everywhere or version not in needed:
                scratch.delete(self.spark, f"{self.path}/removed/_version={version}")
        return horizon

    # -- inside ------------------------------------------------------------

    def _rewrite_without(
        self, apply: list[Commit], rewrite: set[int], gens: dict[int, int], gen: int
    ) -> set[int]:
        """Copy the given versions' rows without removed ones; versions still holding rows."""
        left: set[int] = set()
        by_schema: dict[str, list[int]] = {}
        for version in sorted(rewrite):
            by_schema.setdefault(self._log[version].schema, []).append(version)
        for text, versions in by_schema.items():
            schema = T.StructType.fromJson(json.loads(text))
            rows = self._read_rows(schema, [f"_version={v}/_gen={gens[v]}" for v in versions])
            kept = rows.join(self._removed(apply), ["_version", "_row_id"], "left_anti")
            folders = ["_version", "_gen", *self._log[versions[0]].partition_by]
            # One folder's rows meet in few tasks, large ones in several.
            out = kept.withColumn("_gen", F.lit(gen)).select(rows.columns).hint("rebalance", *folders)
            (
                out.write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(*folders)
                .parquet(f"{self.path}/rows")
            )
            left.update(v for v in versions if self._exists(f"rows/_version={v}/_gen={gen}"))
        return left

    def _exists(self, relative: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{relative}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def _move(self, source: str, target: str) -> None:
        paths = self.spark._jvm.org.apache.hadoop.fs.Path
        old, new = paths(source), paths(target)
        fs = new.getFileSystem(self.spark._jsc.hadoopConfiguration())
        fs.delete(new, True)
        fs.mkdirs(new.getParent())
        if not fs.rename(old, new):
            raise OSError(f"cannot move {source} to {target}")

    def _write_row(self, path: str, row: tuple, schema: T.StructType) -> None:
        literal_rows(self.spark, [row], schema).write.mode("errorifexists").parquet(path)

    def _commits(self) -> dict[int, Commit]:
        """All commits. History rows never change and versions are consecutive, so
        what was read before stays valid while the next folder does not exist."""
        if self._log and not self._exists(f"history/version={max(self._log) + 1}"):
            return self._log
        if not self._exists("history"):
            raise VersionNotAvailable(f"{self.path} has no versions")
        known = max(self._log, default=-1)
        news = self.history().where(F.col("version") > known).orderBy("version").collect()
        for r in news:
            self._log[r.version] = Commit(
                r.version, r.parent, r.gen, r.rows_added, r.rows_removed, list(r.touched), r.schema, list(r.partition_by or [])
            )
        return self._log

    def _maintenance(self) -> list:
        if self._exists(f"maintenance/seq={len(self._past) + 1}"):
            schema = T.StructType(MAINTENANCE_SCHEMA.fields + [T.StructField("seq", LONG)])
            log = self.spark.read.schema(schema).parquet(f"{self.path}/maintenance")
            self._past = log.orderBy("seq").collect()
        return self._past

    @staticmethod
    def _gens(commits: dict[int, Commit], past: list) -> dict[int, int]:
        """Where each version's rows are now; versions without rows are left out."""
        gens = {v: c.gen for v, c in commits.items() if c.rows_added}
        for entry in past:
            gens.update({v: entry.seq + 1 for v in entry.rewritten})
            for version in entry.emptied:
                gens.pop(version, None)
        return gens

    @staticmethod
    def _line(commits: dict[int, Commit], version: int) -> list[Commit]:
        line = [commits[version]]
        while line[-1].parent is not None:
            line.append(commits[line[-1].parent])
        return line[::-1]

    def _snapshot(self, version: int | None = None) -> Snapshot:
        commits, past = self._commits(), self._maintenance()
        if version is None:
            version = max(commits)
        if version not in commits:
            raise VersionNotAvailable(f"{self.path} has no version {version}")
        if any(version < m.horizon for m in past):
            raise VersionNotAvailable(f"version {version} of {self.path} was vacuumed")
        return Snapshot(
            version,
            commits[version].columns,
            self._line(commits, version),
            self._gens(commits, past),
            {v for m in past for v in m.applied},
        )

    def _row_paths(self, state: Snapshot, versions: Iterable[int]) -> list[str]:
        return [f"_version={v}/_gen={state.gens[v]}" for v in sorted(versions) if v in state.gens]

    def _read_rows(self, schema: T.StructType, relative: list[str]) -> DataFrame:
        full = T.StructType(schema.fields + ROW_COLUMNS + PLACE_COLUMNS)
        base = f"{self.path}/rows"
        if not relative:
            return self.spark.createDataFrame([], full)
        # Named folders only: nothing else is listed, and a column added later
        # than a folder was written reads as null without a schema merge.
        reader = self.spark.read.schema(full).option("basePath", base)
        return reader.parquet(*[f"{base}/{r}" for r in relative])

    def _removed(self, commits: list[Commit]) -> DataFrame:
        """Identities the given commits retired; a broadcast side when few enough.

        Two longs a row, and the count is on record.
        """
        paths = [f"{self.path}/removed/_version={c.version}" for c in commits]
        gone = (
            self.spark.read.schema(REMOVED_SCHEMA)
            .parquet(*paths)
            .select(F.col("_origin").alias("_version"), "_row_id")
        )
        return F.broadcast(gone) if sum(c.rows_removed for c in commits) <= BROADCAST_ROWS else gone

    def _live(self, state: Snapshot) -> DataFrame:
        """Rows of a snapshot with their identity.

        Versions nobody removed rows from are read straight; only the others meet
        the removals.
        """
        removals = state.removals
        touched = {v for c in removals for v in c.touched} & state.versions
        clean = self._row_paths(state, state.versions - touched)
        dirty = self._row_paths(state, touched)
        if not dirty:
            return self._read_rows(state.schema, clean)
        rest = self._read_rows(state.schema, dirty).join(
            self._removed(removals), ["_version", "_row_id"], "left_anti"
        )
        return self._read_rows(state.schema, clean).unionByName(rest) if clean else rest

    @staticmethod
    def _replaced() -> list[Column]:
        return [F.col("_version").alias("_old_version"), F.col("_row_id").alias("_old_row_id")]

    def _commit(
        self,
        operation: str,
        state: Snapshot | None,
        schema: T.StructType,
        rows: DataFrame | None = None,
        removed: DataFrame | None = None,
        params: dict[str, str] | None = None,
        fresh: bool = False,
        gen: int = 0,
        number: int | None = None,
        partition_by: list[str] | None = None,
        placed: bool = False,
    ) -> int:
        """Write a version's folders, then its history row.

        Rows of a partitioned table are gathered by folder first, unless they are
        ``placed`` already.

        Rows wait in ``staging`` and are moved just before the history row, so that a
        stream does not meet the rows of a write that failed.

        The removals of an update or upsert are read back from the rows written, so
        the two always agree.
        """
        clash = RESERVED & {n.lower() for n in schema.names}
        if clash:
            raise dml.SchemaMismatch(f"reserved column names: {sorted(clash)}")
        by = state.partition_by if state is not None else list(partition_by or [])
        if number is None:
            number = 0 if state is None else state.version + 1
        if self._exists(f"history/version={number}"):
            raise CommitConflict(f"version {number} of {self.path} already exists")
        rows_path = f"{self.path}/rows/_version={number}/_gen={gen}"
        waiting = f"{self.path}/staging/rows_version={number}"
        removed_path = f"{self.path}/removed/_version={number}"
        live = 0 if state is None else state.live_rows
        added = gone = 0
        touched: list[int] = []

        if rows is not None:
            for name in ("_old_version", "_old_row_id"):
                if name not in rows.columns:
                    rows = rows.withColumn(name, F.lit(None).cast("long"))
            if by:
                rows = rows.withColumns({c: _folder_value(c, schema[c].dataType) for c in by})
                rows = rows if placed else rows.hint("rebalance", *by)
            rows = rows.withColumn("_row_id", F.monotonically_increasing_id())
            writer = rows.write.mode("overwrite")
            with open_files(self.spark):
                (writer.partitionBy(*by) if by else writer).parquet(waiting)
            written = self.spark.read.schema(T.StructType(ROW_COLUMNS)).parquet(waiting)
            added, gone, touched = written.agg(
                F.count(F.lit(1)), F.count("_old_version"), F.collect_set("_old_version")
            ).first()
            removed = (
                written.where(F.col("_old_version").isNotNull())
                .select(F.col("_old_version").alias("_origin"), F.col("_old_row_id").alias("_row_id"))
                .hint("rebalance")
            )
        elif removed is not None:
            removed.write.mode("overwrite").parquet(removed_path)
            gone, touched = (
                self.spark.read.schema(REMOVED_SCHEMA)
                .parquet(removed_path)
                .agg(F.count(F.lit(1)), F.collect_set("_origin"))
                .first()
            )
        if fresh:
            gone = live
        # A change that reaches every row also starts a new line: readers of it
        # never look at the old rows or the removals.
        root = fresh or (gone == live and gone > 0)
        if gone and not root and rows is not None:
            removed.write.mode("overwrite").parquet(removed_path)
        if rows is not None:
            self._move(waiting, rows_path)
        parent = None if root or state is None else state.version
        touched = [] if root else sorted(touched)
        text = schema.json()
        row = (datetime.now(timezone.utc), operation, list((params or {}).items()), text, added, gone, parent, gen, touched, by)
        self._write_row(f"{self.path}/history/version={number}", row, HISTORY_SCHEMA)
        self._log[number] = Commit(number, parent, gen, added, gone, touched, text, by)
        return number
