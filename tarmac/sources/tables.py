"""Named-table scans and the overwrite sink, format chosen by configuration.

Parquet is the default.  Any Spark data source works the same way: a
warehouse connector (``format='bigquery'`` with a ``table`` option), JDBC with
a partitioned read, ORC, Delta/Iceberg when their jars are on the classpath.
Three formats are this package's own: ``copy_dump`` (``sources.dump``, reading),
``versioned`` (``sources.versions``: overwritten in one step, by partition if
wanted) and ``staged`` (``sources.staged``: files staged by tasks, published by
one commit).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType, TimestampNTZType

from tarmac.schemas import COORDINATES, DOMAIN_SCHEMAS
from tarmac.sources import staged, versions


@dataclass(frozen=True)
class TableSource:
    """Where and how a named table is read or written.

    ``location`` is a path template (``{name}`` is replaced by the table
    name) for path-based formats, or ``None`` when the options alone name
    the table (warehouse connectors, JDBC).  ``names`` gives a table's stored
    name where it is another (``{"segments": "segments_v1"}``), and
    ``table_options`` options of single tables, e.g. a JDBC read's partition
    column, which no two tables need share.
    """

    format: str = "parquet"
    location: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    table_option: str | None = None  # option key that carries the table name
    table_template: str = "{name}"
    names: Mapping[str, str] = field(default_factory=dict)
    table_options: Mapping[str, Mapping[str, str]] = field(default_factory=dict)

    def stored_name(self, name: str) -> str:
        return self.names.get(name, name)

    def reader_options(self, name: str) -> dict[str, str]:
        opts = {**self.options, **self.table_options.get(name, {})}
        if self.table_option:
            opts[self.table_option] = self.table_template.format(name=self.stored_name(name))
        return opts

    def path(self, name: str) -> str | None:
        return None if self.location is None else self.location.format(name=self.stored_name(name))


def warehouse_source(
    dataset: str, fmt: str = "bigquery", staging_bucket: str | None = None, names: Mapping[str, str] | None = None
) -> TableSource:
    """Connector-backed tables addressed as ``<dataset>.<table>``.

    ``staging_bucket`` is passed through for connectors that stage writes.
    """
    opts = {"temporaryGcsBucket": staging_bucket} if staging_bucket else {}
    return TableSource(format=fmt, options=opts, table_option="table", table_template=f"{dataset}.{{name}}", names=names or {})


def jdbc_partitions(column: str, lower_bound: int | str, upper_bound: int | str, num_partitions: int) -> dict[str, str]:
    """Options that read ONE table in ``num_partitions`` parallel range slices of ``column``."""
    return {
        "partitionColumn": column,
        "lowerBound": str(lower_bound),
        "upperBound": str(upper_bound),
        "numPartitions": str(num_partitions),
    }


def jdbc_source(
    url: str,
    partitions: Mapping[str, Mapping[str, str]] | None = None,
    names: Mapping[str, str] | None = None,
    fetch_size: int = 10_000,
    extra: Mapping[str, str] | None = None,
) -> TableSource:
    """Tables of a JDBC database.

    Without partitions Spark reads a JDBC table in ONE task; give each large
    fact table its own (``{"segments": jdbc_partitions("flight_id", 1, 10**9, 512)}``),
    since no column is common to all seven.
    """
    opts = {"url": url, "fetchsize": str(fetch_size), **(extra or {})}
    return TableSource(format="jdbc", options=opts, table_option="dbtable", names=names or {}, table_options=partitions or {})


def _as_declared(name: str, own: DataType, declared: DataType) -> Column:
    """A column as its declared type.  Texts may be a point, ``(lon,lat)``, or a time
    with an offset from UTC, which is taken to the session's time zone."""
    if isinstance(own, StringType) and declared == COORDINATES:
        parts = F.split(F.regexp_replace(name, r"[()\s]", ""), ",")
        return F.when(F.col(name).isNotNull(), F.struct(*[parts[i].cast("double").alias(f.name) for i, f in enumerate(declared.fields)]))
    if isinstance(own, StringType) and isinstance(declared, TimestampNTZType):
        has_offset = F.col(name).rlike(r":\d\d(\.\d+)? ?([+-]\d\d(:?\d\d)?|Z)$")
        return F.when(has_offset, F.col(name).cast("timestamp").cast(declared)).otherwise(
            F.when(~has_offset, F.col(name)).cast(declared)
        )
    return F.col(name).cast(declared)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The declared columns of ``df``, cast to their declared types.

    The scan keeps the source's own schema (amounts may be doubles, times
    text); columns that already fit are not touched, so filters on them still
    reach the scan.
    """
    own = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            F.col(f.name) if own.get(f.name) == f.dataType else _as_declared(f.name, own.get(f.name), f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def load_table(
    spark: SparkSession,
    name: str,
    source: TableSource = TableSource(),
    schema: StructType | None = None,
) -> DataFrame:
    """Scan a named table, with its columns as ``schema`` declares them if given.
    Nothing is read until an action; the scan only materialises the columns and
    rows the downstream plan asks for."""
    reader = spark.read.format(source.format).options(**source.reader_options(name))
    if source.format == "copy_dump" and schema is not None:  # reads the wanted columns only
        reader = reader.schema(StructType([StructField(f.name, StringType()) for f in schema.fields]))
    path = source.path(name)
    if source.format in (versions.FORMAT, staged.FORMAT):
        df = versions.read_table(spark, path)
    else:
        df = reader.load(path) if path is not None else reader.load()
    return df if schema is None else conform(df, schema)


def load_domain_tables(spark: SparkSession, source: TableSource) -> dict[str, DataFrame]:
    """The seven domain tables by name, cast to their declared types."""
    return {name: load_table(spark, name, source, schema) for name, schema in DOMAIN_SCHEMAS.items()}


def overwrite_table(
    df: DataFrame,
    name: str,
    source: TableSource,
    partition_by: list[str] | None = None,
    dynamic: bool = False,
) -> None:
    """Replace a named table with ``df`` (Spark's commit protocol makes the
    write task-retry safe), or with ``dynamic`` the partitions that ``df`` has.

    Path formats are replaced in place: a reader may meet the table half gone,
    and ``df`` must not read it.  The formats ``versioned`` and ``staged`` change
    tables in one step.
    """
    path, options = source.path(name), source.reader_options(name)
    if source.format == versions.FORMAT:
        versions.overwrite(df, path, partition_by, dynamic, options)
        return
    writer = df.write.format(source.format).mode("overwrite").options(**options)
    if source.format == staged.FORMAT:
        if partition_by:
            raise ValueError("the staged sink writes tables without partitions")
        staged.register(df.sparkSession)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if path is not None:
        writer.save(path)
    else:
        writer.save()
