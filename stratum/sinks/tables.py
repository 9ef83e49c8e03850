"""Key-bucketed Parquet tables with one small manifest per version.

A table is a folder::

    <path>/stratum_write=<id>/stratum_bucket=<b>/part-*.parquet   rows of one write
    <path>/_manifest/<version>.json                               one per committed version

A manifest holds the schema, the bucketing, notes of the writer and one entry per
data folder of its version with the folder's size, so the current state is read
from one small file: no listing of data, no footers, and a table without rows is
a table.

Every write puts its rows into folders with an id of its own and then publishes
the manifest of the next version, which names exactly the folders that count.
Publishing is a compare-and-set: the finished manifest is given the fixed name of
its version by an operation that fails if that name exists (a hard link on local
and network file systems, a rename without overwrite elsewhere). So a version
that was once committed is never replaced; of two writers of one version the
second raises ``ConcurrentWriteError``, and its rows are named by no manifest.
The store must offer one of the two atomically, as HDFS and POSIX folders do.

* ``overwrite`` - the manifest names the new folders only.
* ``append``    - the folders of the current version and the new ones; a bucket
  with more than ``MOST_FOLDERS`` of them is rewritten as one in the same commit,
  so many small appends leave neither ever more folders nor a growing manifest.
* ``upsert``    - the source rows are written first; they show which buckets are
  touched. Rows of those buckets whose key is not in the source are written
  anew, folders of all other buckets stay as they are, so the cost follows the
  touched buckets, not the table. Null keys never match, as with an equality
  merge condition, unless ``match_nulls`` is set.
* ``combine``   - the touched buckets are replaced by a function of their stored
  rows and the source rows.
"""

from __future__ import annotations

import json
import operator
import os
import re
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any, NamedTuple
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from stratum.operators.lookup import fits_broadcast

BUCKET = "stratum_bucket"
_WRITE, _MANIFEST = "stratum_write", "_manifest"
MOST_FOLDERS = 16  # folders of a bucket that appends may leave
SLOT_BYTES = 16 << 20  # stored bytes of a bucket that an upsert with many keys gives one task at least
CODEC = "zstd"  # of stored rows: packs tighter than Spark's default
_MANIFEST_FILE = re.compile(r"(\d+)\.json$")


class DuplicateSourceKeyError(ValueError):
    """Two source rows would update the same target row."""


class ConcurrentWriteError(RuntimeError):
    """Another writer committed the version this write was based on."""


class Folder(NamedTuple):
    """A data folder; ``batch`` names the source batch whose rows alone it holds."""
    bucket: int
    path: str
    bytes: int
    batch: int | None = None


@dataclass(frozen=True)
class State:
    """One committed version, its data folders, and what its writer noted."""
    version: int
    buckets: int
    schema: StructType
    folders: tuple[Folder, ...]
    notes: dict[str, Any] = field(default_factory=dict)

    @property
    def bytes(self) -> int:
        return sum(f.bytes for f in self.folders)


def _fs(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """The store's file system and the path in it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(at)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    fs, at = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def folder_bytes(spark: SparkSession, path: str) -> int:
    fs, at = _fs(spark, path)
    return fs.getContentSummary(at).getLength() if fs.exists(at) else 0


def _manifest_path(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/{_MANIFEST}/{version}.json"


def _link(spark: SparkSession, draft: Any, target: Any) -> None:
    """Atomic on local and network file systems: a hard link needs a free name."""
    own, name = (unquote(urlparse(p.toUri().toString()).path) for p in (draft, target))
    os.link(own, name)


def _rename(spark: SparkSession, draft: Any, target: Any) -> None:
    """Atomic in stores such as HDFS: a rename without overwrite."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.NONE
    try:
        hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, target, options)
    except Py4JJavaError as exc:
        if exc.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            raise FileExistsError(str(target)) from exc
        raise


def _publish(spark: SparkSession, text: str, path: str, write: str) -> bool:
    """Give ``text`` the name ``path``; False if the name is taken."""
    fs, target = _fs(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{write}")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    try:
        (_link if fs.getUri().getScheme() == "file" else _rename)(spark, draft, target)
    except FileExistsError:
        return False
    finally:
        fs.delete(draft, False)
    return True


def state(spark: SparkSession, path: str, version: int | None = None) -> State | None:
    """The current version (or the one asked for); None without it."""
    if version is None:
        found = [int(m[1]) for n in list_names(spark, f"{path.rstrip('/')}/{_MANIFEST}") if (m := _MANIFEST_FILE.fullmatch(n))]
        if not found:
            return None
        version = max(found)
    fs, at = _fs(spark, _manifest_path(path, version))
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        got = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return State(version, got["buckets"], StructType.fromJson(got["schema"]), tuple(Folder(*f) for f in got["folders"]), got["notes"])


def table_exists(spark: SparkSession, path: str) -> bool:
    return state(spark, path) is not None


def current_bytes(spark: SparkSession, path: str) -> int:
    """Size of the data files that the current version names."""
    now = state(spark, path)
    return now.bytes if now else 0


def read_folders(spark: SparkSession, path: str, schema: StructType, folders: Sequence[str], with_bucket: bool = False) -> DataFrame:
    """Rows of some data folders. The schema is known, so no footer is read for
    it; columns that a folder lacks are null. Value folders (``order_year=``)
    inside become columns and prune on filters."""
    bucket = [F.col(BUCKET).cast("int").alias(BUCKET)] if with_bucket else []
    if not folders:
        return spark.createDataFrame([], schema).withColumn(BUCKET, F.lit(0)).select(*[F.col(f"`{n}`") for n in schema.names], *bucket)
    root = path.rstrip("/")
    return (spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/{f}" for f in folders])
            .select(*[F.col(f"`{n}`") for n in schema.names], *bucket))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    now = state(spark, path)
    if now is None:
        raise FileNotFoundError(f"no table at {path}")
    return read_state(spark, path, now)


def read_state(spark: SparkSession, path: str, at: State, buckets: Iterable[int] | None = None) -> DataFrame:
    """Rows of a version, or of some of its buckets."""
    own = None if buckets is None else set(buckets)
    return read_folders(spark, path, at.schema, [f.path for f in at.folders if own is None or f.bucket in own])


def changes(spark: SparkSession, path: str, since: State, columns: Sequence[str] | None = None,
            shown: Sequence[str] | None = None) -> DataFrame | None:
    """Distinct rows (of ``columns``) that the current version has more or fewer
    of than ``since``; None if nothing was written. Reads only the folders that
    one of the two versions names; rows that were merely rewritten cancel out.
    Where one version only adds folders to the other's, all their rows count and
    nothing is compared. ``shown``: only these columns of the rows."""
    now = state(spark, path)
    if now.version == since.version:
        return None
    names = list(columns or now.schema.names)
    kept = [F.col(f"`{c}`") for c in shown or names]
    both = {f.path for f in now.folders} & {f.path for f in since.folders}
    parts = []
    for at, sign in ((now, 1), (since, -1)):
        own = [f.path for f in at.folders if f.path not in both]
        if not own:
            continue
        rows = read_folders(spark, path, at.schema, own)
        parts.append(rows.select(*[F.col(f"`{c}`") if c in at.schema.names else F.lit(None).cast(now.schema[c].dataType).alias(c) for c in names],
                                 F.lit(sign).alias("__sign")))
    if len(parts) < 2:
        return (parts[0] if parts else read_folders(spark, path, now.schema, [])).select(*kept).distinct()
    net = parts[0].union(parts[1]).groupBy(*[F.col(f"`{c}`") for c in names]).agg(F.sum("__sign").alias("__net"))
    rows = net.where(F.col("__net") != 0).select(*kept)
    return rows.distinct() if shown else rows


def read_added(spark: SparkSession, path: str, since: State | None) -> DataFrame:
    """Rows in folders that the current version names and ``since`` did not."""
    now = state(spark, path)
    if now is None:
        raise FileNotFoundError(f"no table at {path}")
    old = {f.path for f in since.folders} if since else set()
    return read_folders(spark, path, now.schema, [f.path for f in now.folders if f.path not in old])


def register_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Expose the table's current state under ``name`` for ``spark.read.table``
    and SQL in this session; register again after a write."""
    df = read_table(spark, path)
    df.createOrReplaceTempView(name)
    return df


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    if buckets <= 1 or not keys:
        return F.lit(0)
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def write_rows(df: DataFrame, path: str, write: str, keys: Sequence[str], buckets: int,
                partition_by: Sequence[str] = (), batch: int | None = None, laid_out: bool = False) -> list[Folder]:
    """Write rows into folders of this write. A frame that has a bucket column
    already keeps it; ``laid_out``: each task holds rows of few buckets already."""
    spark = df.sparkSession
    out = df if BUCKET in df.columns else df.withColumn(BUCKET, bucket_of(keys, buckets))
    if buckets > 1 and not laid_out:
        # Without this every write task would open a file in every bucket
        # (tasks x buckets small files). REBALANCE lets AQE gather each
        # bucket's rows into tasks of the advisory size and split a hot
        # bucket over several tasks instead of writing it from one.
        out = out.hint("rebalance", BUCKET, *partition_by)
    name = f"{_WRITE}={write}"
    out.write.option("compression", CODEC).partitionBy(BUCKET, *partition_by).parquet(f"{path.rstrip('/')}/{name}")
    fs, root = _fs(spark, f"{path.rstrip('/')}/{name}")
    found = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith(f"{BUCKET}=")]  # one per bucket written
    return sorted(Folder(int(p.getName().split("=")[1]), f"{name}/{p.getName()}", fs.getContentSummary(p).getLength(), batch) for p in found)


def merge_folders(spark: SparkSession, path: str, schema: StructType, folders: list[Folder], buckets: int,
                  partition_by: Sequence[str] = (), most: int = MOST_FOLDERS) -> list[Folder]:
    """``folders`` with those of a bucket written as one, where it has more than
    ``most`` (folders of an open batch stay apart)."""
    per: dict[int, list[Folder]] = {}
    for f in folders:
        if f.batch is None:
            per.setdefault(f.bucket, []).append(f)
    old = {f for own in per.values() if len(own) > most for f in own}
    if not old:
        return folders
    rows = read_folders(spark, path, schema, [f.path for f in old], with_bucket=True)
    return [f for f in folders if f not in old] + write_rows(rows, path, f"{uuid.uuid4().hex}m", (), max(buckets, 2), partition_by)


def _commit(spark: SparkSession, path: str, new: State, write: str) -> int:
    text = json.dumps({"buckets": new.buckets, "schema": new.schema.jsonValue(), "folders": new.folders, "notes": new.notes})
    if not _publish(spark, text, _manifest_path(path, new.version), write):
        raise ConcurrentWriteError(f"version {new.version} of {path} was committed by another writer")
    return new.version


def commit(spark: SparkSession, path: str, base: State | None, folders: Sequence[Folder], schema: StructType | None = None,
           buckets: int | None = None, notes: dict[str, Any] | None = None) -> int:
    """The version after ``base`` with these folders; what is not given stays as in ``base``."""
    return _commit(spark, path, State(base.version + 1 if base else 1, buckets or (base.buckets if base else 1), schema or base.schema, tuple(folders),
                                      notes if notes is not None else (base.notes if base else {})), uuid.uuid4().hex)


def _widened(old: StructType, new: StructType) -> StructType:
    """The table's columns, then those that are new; a column keeps its type."""
    known = {f.name: f for f in old.fields}
    for f in new.fields:
        if f.name in known and f.dataType != known[f.name].dataType:
            raise ValueError(f"column {f.name} is {known[f.name].dataType.simpleString()} in the table, not {f.dataType.simpleString()}")
    return StructType([*old.fields, *(f for f in new.fields if f.name not in known)])


def write_table(df: DataFrame, path: str, mode: str = "overwrite", keys: Sequence[str] = (),
                buckets: int = 1, partition_by: Sequence[str] = (), notes: dict[str, Any] | None = None) -> int:
    """Replace the table (``overwrite``) or add rows to it (``append``).
    ``keys`` / ``buckets`` set the bucketing when the table is created; an
    append reuses the table's bucketing. ``partition_by`` adds value folders
    (e.g. a year) inside every bucket, so filters on those columns prune
    files; every write to a table must use the same ``partition_by``. ``notes``
    are kept with the version (an append without any keeps the table's).
    Returns the version written."""
    if mode not in ("overwrite", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = df.sparkSession
    write = uuid.uuid4().hex
    now = state(spark, path)
    version = now.version + 1 if now else 1
    if mode == "append" and now:
        if now.buckets > 1 and not keys:
            raise ValueError("append to a bucketed table needs its key columns")
        schema = _widened(now.schema, df.schema)
        added = write_rows(df, path, write, keys, now.buckets, partition_by)
        folders = merge_folders(spark, path, schema, [*now.folders, *added], now.buckets, partition_by)
        return _commit(spark, path, State(version, now.buckets, schema, tuple(folders), now.notes if notes is None else notes), write)
    n = buckets if keys else 1
    folders = write_rows(df, path, write, keys, n, partition_by)
    return _commit(spark, path, State(version, n, df.schema, tuple(folders), notes or {}), write)


def _check_unique(rows: DataFrame, keys: Sequence[str]) -> None:
    dup = rows.where(_all_present(keys)).groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise DuplicateSourceKeyError(f"several source rows share key {dup[0].asDict()}")


def _all_present(keys: Sequence[str]) -> Column:
    return reduce(operator.and_, [F.col(k).isNotNull() for k in keys])


def _in_place_unmatched(stored: DataFrame, own: DataFrame, keys: Sequence[str], buckets: int, slots: int, match_nulls: bool) -> DataFrame:
    """Stored rows whose key is not among ``own``, with their bucket, each task
    holding whole slots of buckets: the shuffle that brings stored rows and keys
    together is the one that the write needs. A key's rows meet in one task; rows
    whose null key matches nothing are dealt by their other values."""
    place = F.hash(*keys)
    if not match_nulls:
        own = own.where(_all_present(keys))
        plain = [f.name for f in stored.schema.fields if not isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType))]
        place = F.when(_all_present(keys), place).otherwise(F.hash(*[F.col(f"`{c}`") for c in plain]))
    marked = (stored.withColumn("__own", F.lit(False))
              .unionByName(own.select(*keys).distinct().withColumn("__own", F.lit(True)), allowMissingColumns=True)
              .withColumns({BUCKET: bucket_of(keys, buckets), "__slot": F.pmod(place, F.lit(slots))}))
    group = [BUCKET, "__slot"] if buckets > 1 else ["__slot"]
    met = F.max("__own").over(Window.partitionBy(*group, *keys))
    rest = marked.repartition(*group).withColumn("__met", met).where(~F.col("__met"))
    return rest.select(*[F.col(f"`{c}`") for c in stored.columns], BUCKET)


def upsert(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str],
           check_unique: bool = True, buckets: int = 1, partition_by: Sequence[str] = (),
           notes: dict[str, Any] | None = None, match_nulls: bool = False) -> int:
    """Update matched rows, insert new ones, keep the rest, rewriting only
    the buckets the source touches. Creates the table (with ``buckets``
    buckets over ``keys``) when it does not exist. Returns the version.

    ``match_nulls``: a null key equals a null key (without it, a row with a null
    key is inserted by every merge that brings it).

    The source is evaluated once: its rows are written as they are to count in
    the new version, and everything else is decided from what was written. Keys
    that fit a broadcast (measured) are sent to the stored rows; otherwise both
    meet in the shuffle that lays the kept rows out, so these move once either way."""
    write = uuid.uuid4().hex
    now = state(spark, path)
    n = now.buckets if now else (buckets if keys else 1)
    schema = _widened(now.schema, source.schema) if now else source.schema
    new = write_rows(source, path, write, keys, n, partition_by)
    written = read_folders(spark, path, source.schema, [f.path for f in new])
    if check_unique:
        _check_unique(written, keys)
    folders = new
    if now:
        touched = {f.bucket for f in new}
        hit = [f for f in now.folders if f.bucket in touched]
        folders = [f for f in now.folders if f.bucket not in touched] + new
        if hit:
            stored = read_folders(spark, path, now.schema, [f.path for f in hit])
            few = fits_broadcast(written.select(*keys))
            if few:
                own = written.select(*[F.col(k).alias(f"__{k}") for k in keys])
                same = [stored[k].eqNullSafe(own[f"__{k}"]) if match_nulls else stored[k] == own[f"__{k}"] for k in keys]
                kept = stored.join(F.broadcast(own), reduce(operator.and_, same), "left_anti")
            else:
                slots = buckets_for(sum(f.bytes for f in hit) // len(touched), SLOT_BYTES)
                kept = _in_place_unmatched(stored, written, keys, n, slots, match_nulls)
            folders += write_rows(kept, path, f"{write}k", keys, n, partition_by, laid_out=not few)
    version = now.version + 1 if now else 1
    kept_notes = now.notes if now and notes is None else notes or {}
    return _commit(spark, path, State(version, n, schema, tuple(folders), kept_notes), write)


def replace_by_keys(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str],
                    buckets: int = 1, partition_by: Sequence[str] = (), notes: dict[str, Any] | None = None,
                    match_nulls: bool = False) -> int:
    """Replace every target row sharing a key with the source rows of that
    key (e.g. all lines of an order), keep the other target rows."""
    return upsert(spark, path, source, keys, check_unique=False, buckets=buckets,
                  partition_by=partition_by, notes=notes, match_nulls=match_nulls)


def combine(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], rule: Callable[[DataFrame], DataFrame],
            buckets: int = 1, notes: dict[str, Any] | None = None) -> int:
    """Replace each bucket that the source touches by ``rule`` of its stored rows
    and the source rows together. The source is evaluated once."""
    write = uuid.uuid4().hex
    now = state(spark, path)
    n = now.buckets if now else buckets
    new = write_rows(source, path, f"{write}s", keys, n)
    touched = {f.bucket for f in new}
    held = [f for f in now.folders if f.bucket in touched] if now else []
    both = read_folders(spark, path, now.schema if now else source.schema, [f.path for f in (*held, *new)])
    folders = [f for f in now.folders if f.bucket not in touched] if now else []
    if new:
        folders += write_rows(rule(both), path, write, keys, n)
    schema = now.schema if now else source.schema
    return _commit(spark, path, State(now.version + 1 if now else 1, n, schema, tuple(folders), now.notes if now and notes is None else notes or {}), write)


def buckets_for(size_bytes: int, bytes_per_bucket: int = 1 << 30) -> int:
    """Bucket count giving about ``bytes_per_bucket`` per bucket: an upsert
    then rewrites whole buckets of roughly that size, whatever the table's."""
    return max(1, -(-size_bytes // bytes_per_bucket))
