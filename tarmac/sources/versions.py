"""Tables whose contents change in one step: versions of files, named by a manifest.

A table's folder holds ``data/`` (files of all versions) and ``manifests/``.  A
manifest lists the folders or files that make up one version, and is put in
place whole, under a new name, after everything it lists is written.  Readers
take the newest manifest, so they see the old table or the new one and never a
part of either; a query may read the table that it overwrites, and a failed
write changes nothing.  Nothing is renamed but the manifest, so this holds on
object stores too.

``overwrite`` writes with Spark's own Parquet writer and replaces the table, or
only the partitions that occur in the new rows (``dynamic``).  The data source
``staged`` (see ``tarmac.sources.staged``) publishes the same manifests.
``vacuum`` removes versions that are no longer wanted.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

FORMAT = "versioned"
_VERSION = "tarmac_version"
_ABSOLUTE = re.compile(r"/|[A-Za-z][A-Za-z0-9+.-]*:")


@dataclass
class Manifest:
    """One version: ``parts`` maps a partition (``date=2024-01-01``, '' without partitions)
    to the folders or files of its rows, relative to the table's folder."""

    number: int
    schema: str
    partition_by: list[str] = field(default_factory=list)
    parts: dict[str, list[str]] = field(default_factory=dict)

    @property
    def file_name(self) -> str:
        return f"{self.number:012d}-{uuid.uuid4().hex}.json"

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> Manifest:
        return cls(**json.loads(text))


class _Files:
    """A table's folder through Hadoop's file systems, i.e. wherever Spark can read."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark.sparkContext._jvm
        self.root = self.jvm.org.apache.hadoop.fs.Path(root)
        self.fs = self.root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.root, name)

    def names(self, folder: str, folders: bool = False) -> list[str]:
        path = self.at(folder)
        if not self.fs.exists(path):
            return []
        return sorted(x.getPath().getName() for x in self.fs.listStatus(path) if not folders or x.isDirectory())

    def read(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """Write a file that appears with all its contents or not at all."""
        hidden = self.at(f"{name.rpartition('/')[0]}/.{uuid.uuid4().hex}")
        stream = self.fs.create(hidden, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self.fs.rename(hidden, self.at(name)):
            self.fs.delete(hidden, False)
            raise OSError(f"could not publish {name}")

    def delete(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


def _newest(names: list[str]) -> list[str]:
    return [x for x in sorted(names, reverse=True) if x.endswith(".json") and not x.startswith(".")]


def newest_manifest(spark: SparkSession, root: str) -> Manifest | None:
    files = _Files(spark, root)
    names = _newest(files.names("manifests"))
    return Manifest.from_json(files.read(f"manifests/{names[0]}")) if names else None


def publish(spark: SparkSession, root: str, manifest: Manifest) -> None:
    _Files(spark, root).put(f"manifests/{manifest.file_name}", manifest.to_json())


def read_table(spark: SparkSession, root: str) -> DataFrame:
    """The newest version, with the schema it was written with."""
    manifest = newest_manifest(spark, root)
    if manifest is None:
        raise FileNotFoundError(f"no version of a table in {root}")
    schema = StructType.fromJson(json.loads(manifest.schema))
    listed = [p for part in manifest.parts.values() for p in part]
    paths = [p if _ABSOLUTE.match(p) else f"{root.rstrip('/')}/{p}" for p in listed]
    if not paths:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    if manifest.partition_by:
        reader = reader.option("basePath", f"{root.rstrip('/')}/data")
    return reader.parquet(*paths).select(*schema.names)


def _partitions(files: _Files, folder: str, depth: int) -> list[str]:
    """The partition folders below ``folder``, as ``a=1/b=2``."""
    found = [""]
    for _ in range(depth):
        found = [f"{p}/{n}".lstrip("/") for p in found for n in files.names(f"{folder}/{p}", folders=True) if "=" in n]
    return found


def overwrite(
    df: DataFrame,
    root: str,
    partition_by: Sequence[str] | None = None,
    dynamic: bool = False,
    options: dict[str, str] | None = None,
    remove: Callable[[str], bool] | None = None,
) -> Manifest:
    """Make ``df`` the table's contents, or with ``dynamic`` those of the partitions in ``df``.

    ``df`` may read the table itself.  With ``dynamic`` a partition of which
    ``df`` has no row stays as it is, unless ``remove`` says of its name
    (``date=2024-01-01``) that it goes.  Two writers at once are not serialised:
    the last one to publish wins.
    """
    spark, partition_by = df.sparkSession, list(partition_by or [])
    files, old = _Files(spark, root), newest_manifest(spark, root)
    if dynamic and not partition_by:
        raise ValueError("a dynamic overwrite needs partition columns")
    if dynamic and old is not None and old.partition_by != partition_by:
        raise ValueError(f"the table is partitioned by {old.partition_by}, not {partition_by}")
    schema = StructType([df.schema[c] for c in [*[c for c in df.columns if c not in partition_by], *partition_by]])
    number = old.number + 1 if old is not None else 1
    folder = f"data/{_VERSION}={number:012d}-{uuid.uuid4().hex}"
    writer = df.write.options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{root.rstrip('/')}/{folder}")
    new = {p: [f"{folder}/{p}".rstrip("/")] for p in _partitions(files, folder, len(partition_by))}
    stay = {p: v for p, v in old.parts.items() if remove is None or not remove(p)} if dynamic and old is not None else {}
    parts = {**stay, **new}
    manifest = Manifest(number, schema.json(), partition_by, parts)
    publish(spark, root, manifest)
    return manifest


def vacuum(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Remove all but the newest ``keep`` manifests, and the data that those kept don't name.

    Not to be run while a writer is at work, whose data no manifest names yet,
    or while a reader still reads an older version.  Files in a staging folder
    outside the table are left alone.  Returns what was removed.
    """
    files = _Files(spark, root)
    names = _newest(files.names("manifests"))
    kept = [Manifest.from_json(files.read(f"manifests/{n}")) for n in names[: max(keep, 1)]]
    used = {p for m in kept for part in m.parts.values() for p in part}
    gone = [f"manifests/{n}" for n in names[max(keep, 1) :]]
    for folder in (f"data/{n}" for n in files.names("data")):
        if not any(p == folder or p.startswith(folder + "/") for p in used):
            gone.append(folder)
        elif folder not in used and not any(p.endswith(".parquet") for p in used if p.startswith(folder + "/")):
            depth = kept[0].partition_by
            gone += [f"{folder}/{p}" for p in _partitions(files, folder, len(depth)) if f"{folder}/{p}" not in used]
    for name in gone:
        files.delete(name)
    return gone
