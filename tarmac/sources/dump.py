"""Tables of a plain-text relational dump, read in parallel without a database.

A dump holds a table's rows between a line ``COPY schema.table (columns) FROM
stdin;`` and a line ``\\.``: one row a line, fields separated by tabs, ``\\N`` for
NULL, backslash escapes.  Only the end line is unambiguous (a row that looks
like it is written ``\\\\.``), so the sections are found in two steps:

1. ``find_sections`` scans byte ranges of the files in parallel.  A range reports
   the end lines, and the COPY lines that would open a section, for either
   state it may begin in; these few lines are put in order and read as opened
   and closed sections.
2. The data source ``copy_dump`` cuts the wanted table's sections into byte ranges.
   A row belongs to the range that holds its first byte: a reader skips to the
   first row that begins in its range and reads on to the end of the last.

A dump is one file, or a folder of files that are dumps of their own.  Files
are opened by Arrow's file systems, so their address is a path or a URI that
these know.  Compressed files can't be cut and are refused.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from functools import reduce
from operator import or_

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as csv
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from tarmac.session import ship_package
from tarmac.sources.tables import TableSource

FORMAT = "copy_dump"
RANGE_BYTES = 64 << 20
_PIECE = 4 << 20

# Fixed values -- the lines that open and close a section, and the escapes of its fields.
_OPEN = re.compile(rb"^COPY (\S+) \((.*)\) FROM stdin;$")
_CLOSE = b"\\."
_NULL = "\\N"
_ESCAPES = {"b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v"}
_ESCAPE = re.compile(r"\\([0-7]{1,3}|x[0-9A-Fa-f]{1,2}|.)", re.S)


@dataclass(frozen=True)
class Section:
    """One table's rows in a file: bytes ``start`` to ``end`` (of its last newline)."""

    file: str
    table: str
    columns: list[str]
    start: int
    end: int


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def dump_files(path: str) -> list[tuple[str, int]]:
    """(address, bytes) of the dump's files, in name order."""
    fs, own = _file_system(path)
    prefix = path[: len(path) - len(own)] if path.endswith(own) else ""
    info = fs.get_file_info(own)
    if info.type == pafs.FileType.Directory:
        found = [x for x in fs.get_file_info(pafs.FileSelector(own, recursive=False)) if x.is_file]
        found = [x for x in found if not x.base_name.startswith((".", "_"))]
    elif info.is_file:
        found = [info]
    else:
        raise FileNotFoundError(path)
    packed = [x.path for x in found if x.extension in ("gz", "zip", "bz2", "zst", "xz")]
    if packed:
        raise ValueError(f"compressed dumps can't be cut into ranges: {packed}")
    return sorted((prefix + x.path, x.size) for x in found)


def _lines(file: str, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(position, line without its newline) of the lines that begin in bytes start to end - 1."""
    fs, own = _file_system(file)
    with fs.open_input_file(own) as f:
        at = max(start - 1, 0)
        f.seek(at)
        rest, skip = b"", start > 0  # the byte before tells whether a line begins at ``start``
        while True:
            data = f.read(_PIECE)
            lines = (rest + data).split(b"\n")
            rest = lines.pop() if data else b""
            for line in lines:
                if not skip:
                    if at >= end:
                        return
                    if line or data:
                        yield at, line
                skip = False
                at += len(line) + 1
            if not data or (at >= end and not skip):
                return


def _marks(file: str, start: int, end: int) -> Iterator[tuple[int, int, bytes]]:
    """(position, length, line) of the range's end lines, and of the COPY lines that
    are the first one in the range or the first one after an end line."""
    closed = True
    for at, line in _lines(file, start, end):
        if line == _CLOSE:
            closed = True
            yield at, len(line), line
        elif closed and line.startswith(b"COPY ") and _OPEN.match(line):
            closed = False
            yield at, len(line), line


def _column_names(text: str) -> list[str]:
    return [quoted.replace('""', '"') or plain for quoted, plain in re.findall(r'"((?:[^"]|"")*)"|([^\s,]+)', text)]


def _table_name(text: str) -> str:
    return _column_names(text.replace(".", ","))[-1]


def find_sections(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> list[Section]:
    """The dump's sections in order of file and position.

    What comes to the driver is the opening and closing lines of sections: at
    most two lines a section and one a range.
    """
    ship_package(spark)
    files = dump_files(path)
    cuts = [(f, lo, min(lo + range_bytes, size)) for f, size in files for lo in range(0, size, range_bytes)]
    if not cuts:
        return []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = [(row["file"], *m) for m in _marks(row["file"], row["lo"], row["hi"])]
                names = ("file", "at", "size", "line")
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary())
                yield pa.record_batch([pa.array([x[i] for x in found], k) for i, k in enumerate(kinds)], names)

    ranges = spark.createDataFrame(cuts, "file string, lo long, hi long")
    ranges = ranges.repartition(min(len(cuts), 4 * spark.sparkContext.defaultParallelism))
    marks = ranges.mapInArrow(run, "file string, at long, size long, line binary").toArrow().to_pylist()
    out, opened, file = [], None, None
    for mark in sorted(marks, key=lambda x: (x["file"], x["at"])):
        if mark["file"] != file:
            file, opened = mark["file"], None
        begin = _OPEN.match(mark["line"])
        if begin is None and opened is not None:
            out.append(Section(file, *opened, mark["at"]))
            opened = None
        elif begin is not None and opened is None:
            table, columns = begin[1].decode(), begin[2].decode()
            opened = (_table_name(table), _column_names(columns), mark["at"] + mark["size"] + 1)
    return out


@dataclass
class _Range(InputPartition):
    file: str
    columns: list
    start: int
    end: int
    lo: int
    hi: int


def _unescape(value: str) -> str:
    def one(m: re.Match) -> str:
        code = m[1]
        if code[0] in "01234567":
            return chr(int(code, 8) & 255)
        if code[0] == "x" and len(code) > 1:
            return chr(int(code[1:], 16))
        return _ESCAPES.get(code, code)

    return _ESCAPE.sub(one, value)


def _plain(column: pa.Array) -> pa.Array:
    """The column with its backslash escapes resolved; most columns have none."""
    escaped = pc.fill_null(pc.match_substring(column, "\\"), False)
    if not pc.any(escaped).as_py():
        return column
    resolved = pa.array([None if x is None else _unescape(x) for x in pc.filter(column, escaped).to_pylist()], pa.string())
    return pc.replace_with_mask(column, escaped, resolved)


class _DumpReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.wanted = [f.name for f in schema.fields]
        self.sections = [Section(**x) for x in json.loads(options["sections"])]
        self.range_bytes = int(options.get("rangeBytes", RANGE_BYTES))

    def partitions(self) -> list[_Range]:
        return [
            _Range(s.file, s.columns, s.start, s.end, lo, min(lo + self.range_bytes, s.end))
            for s in self.sections
            for lo in range(s.start, s.end, self.range_bytes)
        ] or [_Range("", [], 0, 0, 0, 0)]

    def _rows(self, part: _Range) -> Iterator[bytes]:
        """Whole rows that begin in the range, as pieces of bytes."""
        fs, own = _file_system(part.file)
        with fs.open_input_file(own) as f:
            at = part.lo
            if at > part.start:  # skip the row that began before
                at -= 1
                f.seek(at)
                while True:
                    data = f.read(min(_PIECE, part.end - at))
                    cut = data.find(b"\n")
                    if cut >= 0 or not data:
                        at += cut + 1 if cut >= 0 else 0
                        break
                    at += len(data)
                if cut < 0:
                    return
            f.seek(at)
            rest = b""
            while at < part.hi or rest:
                data = f.read(min(_PIECE, part.end - at - len(rest)))
                if not data:
                    break
                rest += data
                last = rest.rfind(b"\n") + 1
                if at + last > part.hi:  # the last row is the one that holds the range's last byte
                    last = rest.find(b"\n", max(part.hi - at - 1, 0)) + 1
                    if last:
                        yield rest[:last]
                        return
                    continue
                if last:
                    yield rest[:last]
                    at, rest = at + last, rest[last:]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        if not partition.columns:
            return
        parse = csv.ParseOptions(delimiter="\t", quote_char=False, escape_char=False, ignore_empty_lines=False)
        convert = csv.ConvertOptions(
            column_types=dict.fromkeys(partition.columns, pa.string()),
            include_columns=self.wanted,
            include_missing_columns=True,
            null_values=[_NULL],
            strings_can_be_null=True,
        )
        for rows in self._rows(partition):
            read = csv.ReadOptions(column_names=partition.columns, block_size=len(rows) + 1, use_threads=False)
            table = csv.read_csv(pa.BufferReader(rows), read, parse, convert)
            for batch in table.to_batches():
                columns = [_plain(c.cast(pa.string())) for c in batch.columns]
                yield pa.RecordBatch.from_arrays(columns, names=self.wanted)


class CopyDump(DataSource):
    """``spark.read.format("copy_dump")``: options ``sections`` (JSON) and ``rangeBytes``; all columns are text."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        sections = json.loads(self.options["sections"])
        names = list(dict.fromkeys(c for s in sections for c in s["columns"]))
        return StructType([StructField(c, StringType()) for c in names])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _DumpReader(schema, self.options)


def dump_source(
    spark: SparkSession, path: str, names: dict[str, str] | None = None, range_bytes: int = RANGE_BYTES
) -> TableSource:
    """The dump's tables as a ``TableSource``: ``load_table`` reads one of them by its name in the dump.

    ``names`` gives a table's name in the dump where it is another.
    """
    spark.dataSource.register(CopyDump)
    by_table: dict[str, list[dict]] = {}
    for s in find_sections(spark, path, range_bytes):
        by_table.setdefault(s.table, []).append(asdict(s))
    names = names or {}
    own = {stored: name for name, stored in names.items()}
    options = {own.get(t, t): {"sections": json.dumps(s), "rangeBytes": str(range_bytes)} for t, s in by_table.items()}
    return TableSource(format=FORMAT, names=names, table_options=options)


def _field(f: StructField) -> Column:
    """A column as the text of a dump's field."""
    if isinstance(f.dataType, StructType):
        parts = [F.col(f"{f.name}.{x.name}").cast("string") for x in f.dataType.fields]
        missing = reduce(or_, [p.isNull() for p in parts], F.col(f.name).isNull())
        return F.when(missing, F.lit(_NULL)).otherwise(F.concat(F.lit("("), F.concat_ws(",", *parts), F.lit(")")))
    text = F.col(f.name).cast("string")
    for char, code in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(char), F.lit(code))
    return F.coalesce(text, F.lit(_NULL))


def write_dump(df: DataFrame, path: str, table: str, mode: str = "append") -> None:
    """Add the rows of ``df`` to a dump folder, one file a partition, each with a section of its own.

    A struct of two numbers is written as a point, ``(x,y)``.
    """
    ship_package(df.sparkSession)
    head = f"COPY public.{table} ({', '.join(df.columns)}) FROM stdin;"

    def wrap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.record_batch({"value": pa.array([head], pa.string())})
        for batch in batches:
            yield pa.record_batch({"value": batch.column(0)})
        yield pa.record_batch({"value": pa.array([_CLOSE.decode()], pa.string())})

    rows = df.select(F.concat_ws("\t", *[_field(f) for f in df.schema.fields]).alias("value"))
    rows.mapInArrow(wrap, "value string").write.mode(mode).text(path)
