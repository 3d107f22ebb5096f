"""Reading the seven domain tables and writing the mart."""

from tarmac.sources.binding import DOMAIN_TABLES, bind_domain_tables, read_driver_table
from tarmac.sources.dump import dump_source, find_sections, write_dump
from tarmac.sources.tables import (
    TableSource,
    conform,
    jdbc_partitions,
    jdbc_source,
    load_domain_tables,
    load_table,
    overwrite_table,
    warehouse_source,
)

__all__ = [
    "DOMAIN_TABLES",
    "TableSource",
    "bind_domain_tables",
    "conform",
    "dump_source",
    "find_sections",
    "jdbc_partitions",
    "jdbc_source",
    "load_domain_tables",
    "load_table",
    "overwrite_table",
    "read_driver_table",
    "warehouse_source",
    "write_dump",
]
