"""The plain-text dump: sections found in ranges, rows cut at their boundaries."""

import os
import uuid

import pytest

from tarmac import daily_airport_mart
from tarmac.schemas import DOMAIN_SCHEMAS
from tarmac.session import checkpoint_dir
from tarmac.sources import load_domain_tables, load_table
from tarmac.sources.dump import dump_files, dump_source, find_sections, write_dump

from .edge_fixture import edge_tables

DUMP = """--
-- a dump
SET client_encoding = 'UTF8';
COPY bookings.people (id, name, "odd ""col") FROM stdin;
1\tplain\tx
2\t\\N\ttab\\tinside
3\t\t\\\\N is text
4\tline\\nbreak \\\\. end\t\\x41\\101\\q
5\tCOPY a.b (c) FROM stdin;\tñ
\\.

COPY bookings.one (word) FROM stdin;
COPY fake.table (x) FROM stdin;

\\\\.
last
\\.
CREATE INDEX x;
COPY bookings.none (a, b) FROM stdin;
\\.
COPY bookings.people (id, name, "odd ""col") FROM stdin;
6\tagain\t\\N
\\.
"""
PEOPLE = [
    ("1", "plain", "x"),
    ("2", None, "tab\tinside"),
    ("3", "", "\\N is text"),
    ("4", "line\nbreak \\. end", "AAq"),
    ("5", "COPY a.b (c) FROM stdin;", "ñ"),
    ("6", "again", None),
]


@pytest.fixture
def folder(spark):
    path = os.path.join(checkpoint_dir(spark).replace("file:", ""), "dump", uuid.uuid4().hex)
    os.makedirs(path)
    return path


@pytest.mark.parametrize("range_bytes", [1, 7, 40, 1 << 20])
def test_rows_are_cut_at_any_byte(spark, folder, range_bytes):
    with open(f"{folder}/dump.sql", "w", encoding="utf-8", newline="") as f:
        f.write(DUMP)
    source = dump_source(spark, f"{folder}/dump.sql", range_bytes=range_bytes)
    people = load_table(spark, "people", source)
    assert people.columns == ["id", "name", 'odd "col']
    assert sorted(map(tuple, people.collect())) == PEOPLE
    assert sorted(r.word for r in load_table(spark, "one", source).collect()) == ["", "COPY fake.table (x) FROM stdin;", "\\.", "last"]
    none = load_table(spark, "none", source)
    assert none.columns == ["a", "b"] and none.collect() == []


def test_sections_are_the_same_in_any_ranges(spark, folder):
    with open(f"{folder}/dump.sql", "w", encoding="utf-8", newline="") as f:
        f.write(DUMP)
    whole = find_sections(spark, folder)
    assert [s.table for s in whole] == ["people", "one", "none", "people"]
    for n in (3, 16, 64):
        assert find_sections(spark, folder, n) == whole


def test_seven_tables_equal_the_given_ones(spark, folder):
    tables = edge_tables(spark)
    for name, df in tables.items():
        write_dump(df.repartition(3), folder, "dep" if name == "departures" else name)
    source = dump_source(spark, folder, names={"departures": "dep"}, range_bytes=64)
    back = load_domain_tables(spark, source)
    for name, df in tables.items():
        assert back[name].schema == DOMAIN_SCHEMAS[name]
        assert sorted(map(tuple, back[name].collect()), key=str) == sorted(map(tuple, df.collect()), key=str), name
    order = ("aircrafts_data", "airports_data", "bookings", "departures", "seats", "segments", "tickets")
    got = daily_airport_mart(*(back[n] for n in order)).collect()
    assert got == daily_airport_mart(*(tables[n] for n in order)).collect()


def test_only_wanted_columns_are_converted(spark, folder):
    with open(f"{folder}/dump.sql", "w", encoding="utf-8", newline="") as f:
        f.write(DUMP)
    source = dump_source(spark, folder)
    frame = spark.read.format("copy_dump").options(**source.reader_options("people")).schema("name string, missing string").load()
    assert sorted(map(tuple, frame.collect()), key=str) == sorted([(n, None) for _, n, _ in PEOPLE], key=str)


def test_times_with_an_offset(spark, folder):
    with open(f"{folder}/dump.sql", "w") as f:
        f.write("COPY x.bookings (book_ref, book_date, total_amount) FROM stdin;\nA\t2017-07-16 02:35:00+03\t1.50\nB\t2017-07-16 02:35:00\t\\N\n\\.\n")
    rows = load_table(spark, "bookings", dump_source(spark, folder), DOMAIN_SCHEMAS["bookings"]).collect()
    assert {r.book_ref: str(r.book_date) for r in rows} == {"A": "2017-07-15 23:35:00", "B": "2017-07-16 02:35:00"}


def test_compressed_or_missing_dumps_are_refused(folder):
    open(f"{folder}/a.sql.gz", "w").close()
    with pytest.raises(ValueError):
        dump_files(folder)
    with pytest.raises(FileNotFoundError):
        dump_files(folder + "/nothing")
