"""Parquet table sinks: plain writes, CSV export, and versioned tables.

A ``VersionedTable`` keeps its data partitioned (for sales: by year) under
``data/v=<n>/<attempt>/`` and a manifest per version at ``_manifest/v=<n>/``
that maps every live partition to the folder holding it.  An upsert rewrites
only the partitions it touches into a new folder and then commits the new
manifest; readers of the previous version are never disturbed, a failed job
leaves no visible manifest, and replaying a batch id already committed is a
no-op.  Each attempt writes to a folder of its own and the manifest file is
moved into place only if no other writer has committed that version: of two
writers that start from one version, the second fails.  All paths go through
the Hadoop file system of the table, so any shared storage works.
"""

from __future__ import annotations

import datetime as _dt
import decimal
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART = "_part"
# Write tasks that one partition (a year) is spread over, at most.
WRITE_SPLITS = 64
_NULL_PART = "__HIVE_DEFAULT_PARTITION__"
# Manifest rows: kind "part" (partition -> folder, with per-partition maxima
# of the mark columns) or kind "stream" (newest batch id a stream committed).
_MANIFEST_SCHEMA = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("part", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("marks", T.StringType()),
    T.StructField("stream", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])

class CommitConflict(RuntimeError):
    """Another writer has committed the version this one was about to."""


@dataclass
class Manifest:
    version: int = 0
    parts: dict = field(default_factory=dict)     # part value -> (location, {column: max})
    streams: dict = field(default_factory=dict)   # stream name -> newest committed batch id


def _encode_marks(marks: dict) -> str:
    out = {}
    for col, value in marks.items():
        if isinstance(value, _dt.datetime):
            out[col] = ["ts", value.isoformat()]
        elif isinstance(value, _dt.date):
            out[col] = ["date", value.isoformat()]
        elif value is not None:
            out[col] = ["num", str(value)]
    return json.dumps(out, sort_keys=True)


def _decode_marks(text: str | None) -> dict:
    out = {}
    for col, (kind, value) in json.loads(text or "{}").items():
        out[col] = (_dt.datetime.fromisoformat(value) if kind == "ts" else
                    _dt.date.fromisoformat(value) if kind == "date" else decimal.Decimal(value))
    return out


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Materialise a model (``overwrite``) or append to a bronze table."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_bronze(df: DataFrame, path: str, source_mode: str) -> None:
    """``full`` replaces the table, anything else appends to it."""
    write_table(df, path, "overwrite" if source_mode == "full" else "append")


def export_csv(df: DataFrame, path: str) -> None:
    """One headered CSV file of a report (the mart: a row per group).

    The report's last aggregation keeps its own parallelism; only its rows
    meet in the one writing task.
    """
    df.repartition(1).write.mode("overwrite").option("header", True).csv(path)


def report_to_pandas(spark: SparkSession, path: str, where: str | None = None):
    """The stored mart report (a row per group), filtered in Spark, as pandas."""
    report = VersionedTable(spark, path).read()
    return (report if where is None else report.where(where)).toPandas()


class VersionedTable:
    """Partitioned Parquet table with copy-on-write of touched partitions."""

    def __init__(self, spark: SparkSession, path: str, partition: Callable[[], Column] | None = None,
                 cluster_by: list[str] | None = None, marks: list[str] | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.partition = partition or (lambda: F.lit("all"))
        # Columns (the table key) whose hash spreads a partition over write
        # tasks, and by which each file is sorted.
        self.cluster_by = list(cluster_by or [])
        # Columns whose maximum the manifest keeps per partition, so a
        # high-water mark needs no scan of the table.
        self.marks = list(marks or [])

    # -- manifest ---------------------------------------------------------
    def _manifest_dir(self) -> str:
        return f"{self.path}/_manifest"

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return jvm, root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def incoming_path(self) -> str:
        """A new folder for rows on their way into the table."""
        return f"{self.path}/_incoming/{uuid.uuid4().hex}"

    def delete(self, path: str) -> None:
        jvm, fs = self._fs()
        fs.delete(jvm.org.apache.hadoop.fs.Path(path), True)

    def _children(self, path: str) -> list[str]:
        """Paths directly below ``path`` (none if it does not exist)."""
        jvm, fs = self._fs()
        p = jvm.org.apache.hadoop.fs.Path(path)
        return [st.getPath().toString() for st in fs.listStatus(p)] if fs.exists(p) else []

    def _versions(self) -> list[int]:
        """Committed versions, from the names of the manifest folders only."""
        return sorted(int(c.rsplit("v=", 1)[1]) for c in self._children(self._manifest_dir()) if "/v=" in c)

    def manifest(self, version: int | None = None) -> Manifest | None:
        """The newest committed manifest (or that of ``version``; None if it is
        gone), read fresh: another writer may have committed since.  Callers
        needing several lookups read it once and pass it on."""
        versions = self._versions()
        if version is not None and version not in versions:
            return None
        if not versions:
            return Manifest()
        out = Manifest(versions[-1] if version is None else version)
        rows = self.spark.read.schema(_MANIFEST_SCHEMA).json(f"{self._manifest_dir()}/v={out.version}").collect()
        for r in rows:  # one row per partition / stream
            if r["kind"] == "part":
                out.parts[r["part"]] = (r["location"], _decode_marks(r["marks"]))
            elif r["kind"] == "stream":
                out.streams[r["stream"]] = r["batch_id"]
        return out

    def version(self) -> int:
        return self.manifest().version

    def last_batch_id(self, stream: str | None = None) -> int | None:
        """Newest batch id committed by ``stream`` (ids are per stream)."""
        return self.manifest().streams.get(stream)

    def taken(self, batch_id: int | None, stream: str | None, manifest: Manifest | None = None) -> bool:
        """Whether ``stream`` has committed ``batch_id`` already."""
        newest = (manifest or self.manifest()).streams.get(stream)
        return batch_id is not None and newest is not None and batch_id <= newest

    def mark(self, column: str, default=None, manifest: Manifest | None = None):
        """Maximum of a mark column over the whole table, from the manifest."""
        manifest = manifest or self.manifest()
        values = [mk[column] for _, mk in manifest.parts.values() if mk.get(column) is not None]
        return max(values) if values else default

    def _commit(self, version: int, parts: dict, streams: dict) -> None:
        rows = [("part", p, loc, _encode_marks(mk), None, None) for p, (loc, mk) in parts.items()]
        rows += [("stream", None, None, None, s, b) for s, b in streams.items()]
        if not rows:
            rows = [("empty", None, None, None, None, None)]
        names = _MANIFEST_SCHEMA.fieldNames()
        text = "".join(json.dumps(dict(zip(names, r))) + "\n" for r in rows)
        jvm, fs = self._fs()
        Path = jvm.org.apache.hadoop.fs.Path
        ready = Path(f"{self._manifest_dir()}/_ready-{uuid.uuid4().hex}")
        folder = Path(f"{self._manifest_dir()}/v={version}")
        fs.mkdirs(ready)
        out = fs.create(Path(ready, "manifest.json"), False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(fs.makeQualified(ready), fs.makeQualified(folder), options)  # never replaces
        except Exception as exc:
            if fs.exists(folder):
                fs.delete(ready, True)
                raise CommitConflict(f"version {version} of {self.path} was committed by another writer") from exc
            raise

    # -- read -------------------------------------------------------------
    def read(self, with_part: bool = False, manifest: Manifest | None = None) -> DataFrame | None:
        """The current version (``manifest``: one already read)."""
        manifest = manifest or self.manifest()
        if not manifest.parts:
            return None
        by_version: dict[str, list[str]] = {}
        for loc, _ in manifest.parts.values():
            by_version.setdefault(loc.rsplit("/", 1)[0], []).append(loc)
        out = None
        for base, locs in sorted(by_version.items()):
            df = self.spark.read.option("basePath", base).parquet(*locs)
            df = df.withColumn(PART, F.col(PART).cast("string"))
            out = df if out is None else out.unionByName(df)
        return out if with_part else out.drop(PART)

    def read_newer(self, column: str, value, manifest: Manifest | None = None) -> DataFrame | None:
        """Rows that can have ``column > value``: only partitions whose
        recorded maximum of ``column`` exceeds ``value`` are read (the caller
        still applies the row filter)."""
        m = manifest or self.manifest()
        keep = {p: v for p, v in m.parts.items() if v[1].get(column) is None or v[1][column] > value}
        if not keep:
            return None
        return self.read(manifest=Manifest(m.version, keep, m.streams))

    # -- maintenance ------------------------------------------------------
    def vacuum(self, keep_versions: int = 2) -> list[str]:
        """Delete data and manifest folders no longer referenced by the newest
        ``keep_versions`` manifests (readers of those versions are safe).

        Works through the Hadoop file system of the table path, so it applies
        to whatever shared storage the cluster uses.  Returns deleted paths.
        """
        jvm, fs = self._fs()
        versions = self._versions()
        if len(versions) <= keep_versions:
            return []
        keep = versions[len(versions) - keep_versions:]
        live = {loc.rsplit("/", 1)[0].split("/data/", 1)[1]
                for v in keep for loc, _ in self.manifest(v).parts.values()}
        deleted = []
        for d in self._children(f"{self.path}/data"):
            if int(d.rsplit("v=", 1)[1]) >= keep[0]:
                continue
            for attempt in self._children(d):
                if attempt.split("/data/", 1)[1] not in live:
                    fs.delete(jvm.org.apache.hadoop.fs.Path(attempt), True)
                    deleted.append(attempt)
        for v in versions[:len(versions) - keep_versions]:
            mdir = f"{self._manifest_dir()}/v={v}"
            fs.delete(jvm.org.apache.hadoop.fs.Path(mdir), True)
            deleted.append(mdir)
        return deleted

    # -- write ------------------------------------------------------------
    def _write_version(self, df: DataFrame, version: int) -> dict:
        """Write ``df`` (with the partition column) as version ``version``;
        return {partition value: (folder, marks)} of what was written."""
        target = f"{self.path}/data/v={version}/{uuid.uuid4().hex[:12]}"
        if self.cluster_by:
            # By hash: one evaluation of ``df`` (a range exchange would sample
            # it first), and a partition that holds most rows is still split.
            df = df.repartition(F.col(PART), F.pmod(F.xxhash64(*self.cluster_by), F.lit(WRITE_SPLITS)))
            df = df.sortWithinPartitions(PART, *self.cluster_by)
        df.write.partitionBy(PART).parquet(target)
        folders: dict[str | None, str] = {}
        for child in self._children(target):
            name = child.rsplit("/", 1)[1]
            if name.startswith(f"{PART}="):
                value = unquote(name.split("=", 1)[1])
                folders[None if value == _NULL_PART else value] = f"{target}/{name}"
        if not folders:
            return {}
        marks: dict[str | None, dict] = {}
        if self.marks:
            # Per-partition maxima over the rewritten partitions only (the
            # mark columns of this version's files), one row per partition.
            stats = self.spark.read.parquet(target).groupBy(F.col(PART).cast("string").alias("p")).agg(
                *[F.max(c).alias(c) for c in self.marks]).collect()
            marks = {r["p"]: {c: r[c] for c in self.marks} for r in stats}
        return {p: (loc, marks.get(p, {})) for p, loc in folders.items()}

    def overwrite(self, df: DataFrame, batch_id: int | None = None, stream: str | None = None) -> int:
        """Replace the whole table with ``df`` as a new version."""
        m = self.manifest()
        written = self._write_version(df.withColumn(PART, self.partition().cast("string")), m.version + 1)
        streams = dict(m.streams)
        if stream is not None and batch_id is not None:
            streams[stream] = batch_id
        self._commit(m.version + 1, written, streams)
        return m.version + 1

    def upsert(self, incoming: DataFrame, key: str,
               combine: Callable[[DataFrame, DataFrame], DataFrame],
               batch_id: int | None = None, stream: str | None = None, stored: bool = False) -> int:
        """Merge ``incoming`` with ``combine(current_rows_of_touched_partitions, incoming)``.

        Touched partitions = partitions of the incoming rows, plus partitions
        holding existing rows with an incoming key (a key can move partition
        when its partitioning column changes).  Both sets are collected as
        partition values only, bounded by the partition count.  A batch id
        the stream already committed is skipped (replay is a no-op).
        ``stored``: ``incoming`` is read from files, so it is not written here.
        """
        m = self.manifest()
        if self.taken(batch_id, stream, m):
            return m.version
        current = self.read(with_part=True, manifest=m)
        if current is None:
            first = combine(None, incoming) if _accepts_none(combine) else incoming
            return self.overwrite(first, batch_id, stream)
        # The increment is used several times (touched partitions, key
        # broadcast, merge): write it once to the table's shared folder.
        kept = None if stored else self.incoming_path()
        if kept:
            incoming.write.parquet(kept)
            incoming = self.spark.read.schema(incoming.schema).parquet(kept)
        try:
            inc = incoming.withColumn(PART, self.partition().cast("string"))
            from terrace.operators.joins import checked_broadcast
            keys, _ = checked_broadcast(incoming.select(key).distinct())
            moved = current.join(keys, key, "left_semi").select(PART)
            touched = {r[0] for r in inc.select(PART).union(moved).distinct().collect()}
            touched_nonnull = [t for t in touched if t is not None]
            cond = F.col(PART).isin(*touched_nonnull) if touched_nonnull else F.lit(False)
            if None in touched:
                cond = cond | F.col(PART).isNull()
            old = current.where(cond).drop(PART)
            merged = combine(old, incoming).withColumn(PART, self.partition().cast("string"))
            written = self._write_version(merged, m.version + 1)
        finally:
            if kept:
                self.delete(kept)
        # Untouched partitions keep their folders (and marks).
        parts = {p: v for p, v in m.parts.items() if p not in touched}
        parts.update(written)
        streams = dict(m.streams)
        if stream is not None and batch_id is not None:
            streams[stream] = batch_id
        self._commit(m.version + 1, parts, streams)
        return m.version + 1


def _accepts_none(fn: Callable) -> bool:
    return getattr(fn, "accepts_empty", False)
