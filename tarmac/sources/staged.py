"""A staged sink: tasks write files to a staging folder, one commit publishes them.

``df.write.format("staged").mode("overwrite" | "append").save(table folder)``.
Each task writes one Parquet file under the staging folder, named by the write
and the attempt.  ``commit`` runs once, after every task has succeeded: it puts
a manifest in place (``tarmac.sources.versions``) that names exactly the files of
the attempts that Spark committed, so a task that ran twice leaves no duplicate,
and removes what other attempts left.  ``abort`` removes the whole write; the
table stays as it was.  (A task that ends after the abort may leave a file that
no manifest names; ``vacuum`` removes it.)  ``read_table`` of ``versions`` reads
the result.

Option ``staging`` is a folder (a bucket's URI, say) for the files; the default
is the table's own ``data``.  Files are written through Arrow's file systems, so
addresses are paths or URIs that these know.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import suppress
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tarmac.session import ship_package
from tarmac.sources.versions import Manifest

FORMAT = "staged"


@dataclass
class Staged(WriterCommitMessage):
    """A task's file and its rows."""

    file: str
    rows: int


class StagedWriter(DataSourceArrowWriter):
    """One write; tasks and the commit work on copies of it that share ``write_id``."""

    def __init__(self, root: str, staging: str | None, schema: StructType, overwrite: bool):
        self.root, self.schema, self.overwrite = root.rstrip("/"), schema, overwrite
        self.write_id = uuid.uuid4().hex
        self.inside = staging is None
        self.folder = f"{self.root}/data/staged-{self.write_id}" if self.inside else f"{staging.rstrip('/')}/{self.write_id}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        fs, folder = pafs.FileSystem.from_uri(self.folder)
        fs.create_dir(folder, recursive=True)
        name, rows = f"part-{uuid.uuid4().hex}.parquet", 0
        schema = to_arrow_schema(self.schema)
        try:
            with pq.ParquetWriter(f"{folder}/{name}", schema, filesystem=fs, compression="zstd") as out:
                for batch in iterator:
                    columns = [c.cast(f.type) for c, f in zip(batch.columns, schema, strict=True)]
                    out.write_batch(pa.RecordBatch.from_arrays(columns, schema=schema))
                    rows += batch.num_rows
        except BaseException:
            with suppress(FileNotFoundError):
                fs.delete_file(f"{folder}/{name}")
            raise
        return Staged(name, rows)

    def _newest(self, fs: pafs.FileSystem, folder: str) -> Manifest | None:
        found = fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
        names = [x.path for x in found if x.is_file and x.base_name.endswith(".json") and not x.base_name.startswith(".")]
        if not names:
            return None
        with fs.open_input_file(max(names, key=lambda p: p.rpartition("/")[2])) as f:
            return Manifest.from_json(f.read().decode())

    def commit(self, messages: list[Staged | None]) -> None:
        files = [m.file for m in messages if m is not None and m.rows]
        kept = {m.file for m in messages if m is not None and m.rows}
        fs, folder = pafs.FileSystem.from_uri(self.folder)
        for x in fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True)):
            if x.base_name not in kept:  # of attempts that Spark did not commit, or without rows
                fs.delete_file(x.path)
        table, own = pafs.FileSystem.from_uri(self.root)
        old = self._newest(table, f"{own}/manifests")
        if old is not None and old.partition_by:
            raise ValueError("the table is partitioned; write it with versions.overwrite")
        base = f"data/staged-{self.write_id}" if self.inside else self.folder
        before = [] if old is None or self.overwrite else old.parts.get("", [])
        parts = {"": [*before, *(f"{base}/{f}" for f in files)]}
        manifest = Manifest((old.number if old else 0) + 1, self.schema.json(), [], parts)
        table.create_dir(f"{own}/manifests", recursive=True)
        hidden = f"{own}/manifests/.{self.write_id}"
        with table.open_output_stream(hidden) as f:
            f.write(manifest.to_json().encode())
        table.move(hidden, f"{own}/manifests/{manifest.file_name}")

    def abort(self, messages: list[Staged | None]) -> None:
        fs, folder = pafs.FileSystem.from_uri(self.folder)
        with suppress(FileNotFoundError):
            fs.delete_dir(folder)


class StagedSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> StagedWriter:
        return StagedWriter(self.options["path"], self.options.get("staging"), schema, overwrite)


def register(spark: SparkSession) -> None:
    ship_package(spark)
    spark.dataSource.register(StagedSink)
