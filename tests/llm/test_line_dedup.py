"""Site-relative line dedup against SQL, and hand-made sites."""

import pytest
from pyspark.sql import functions as F

from tarmac.llm import line_dedup as L

from ..conftest import SF_ORACLE, SF_SMALL
from .sql import compare

SCHEMA = "page_id long, url string, html string"


@pytest.mark.parametrize("sf_dir", [SF_SMALL, SF_ORACLE])
def test_query_equals_sql(spark, sf_dir):
    compare(spark, "op9_line_dedup", sf_dir)


def site(host, n, start=0):
    head = "<head><title>no line</title></head><nav>Home</nav>"
    return [
        (start + i, f"https://{host}/p{i}?x#y", f"<html>{head}<p>Own text {i}, of  page {i}.</p><p>{'shared by a third' if i % 3 == 0 else 'x' * i}</p><footer>&copy; {host}</footer>")
        for i in range(n)
    ]


def run(spark, pages, **more):
    return {r.page_id: r for r in L.without_boilerplate(spark.createDataFrame(pages, SCHEMA), **more).collect()}


def test_lines_above_the_ratio_go(spark):
    rows = run(spark, site("Big.example.com", 30) + site("small.example.org", 5, 100))
    assert rows[4].text == "Own text 4, of page 4.\nxxxx" and rows[4].n_dropped == 2 and rows[4].host == "big.example.com"
    assert rows[3].text == "Own text 3, of page 3."  # a third of the pages is above a quarter
    assert rows[101].n_dropped == 2 and rows[101].text == "Own text 1, of page 1.\nx"  # a host of 5 pages is judged too


def test_a_line_of_one_page_stays(spark):
    rows = run(spark, site("one.example.org", 1) + site("two.example.org", 2, 10))
    assert rows[0].n_dropped == 0 and rows[0].text.endswith("© one.example.org")
    assert rows[10].text == "Own text 0, of page 0.\nshared by a third" and rows[11].text == "Own text 1, of page 1.\nx"


def test_lines_go_at_every_scale(spark):
    """The given tables have small hosts only; the SQL check would hold without any dropped line too."""
    assert L.op9_line_dedup(spark, SF_SMALL).agg(F.sum("n_dropped")).first()[0] > 0


def test_long_pages_of_unclosed_markup(spark):
    import time

    pad = "word " * 20_000  # beyond LONG
    odd = ["<" * 1_000_000, "<script>" * 100_000 + "end", "<!-- " * 200_000 + "end", "<div " * 200_000, "<head>" * 100_000 + "</head>end", "</p" * 300_000]
    pages = [(i, f"http://e{i}.com", html) for i, html in enumerate(odd)]
    pages.append((9, "http://e.com", f"{pad}<script>a</script>b<style>c<p>d</STYLE >e<script>f<header>g<!-- h --><!-- i > j <p k"))
    began = time.time()
    rows = run(spark, pages)
    assert time.time() - began < 60
    assert rows[0].text == odd[0] and rows[1].text == "end" and rows[2].text == ("<!-- " * 200_000 + "end").strip()
    assert rows[4].text == "end" and rows[3].text == odd[3].strip()
    short = run(spark, [(9, "http://e.com", pages[-1][2].removeprefix(pad))])
    assert rows[9].text == pad + short[9].text


def test_the_same_line_is_judged_by_host(spark):
    pages = site("a.com", 20) + [(100 + i, f"http://b.com/{i}", f"<p>Home</p><p>only {i}</p>" if i == 0 else f"<p>only {i}</p>") for i in range(20)]
    rows = run(spark, pages)
    assert "Home" not in rows[1].text and rows[100].text == "Home\nonly 0"


def test_edge_cases(spark):
    odd = [
        (1, None, "<p>kept, no host</p>"),
        (2, "not a url", "<p>kept</p>"),
        (3, "http://c.com/", None),
        (4, "http://c.com/", ""),
        (5, "http://c.com/", "<script>var x = '<p>no</p>'</script><!-- no --> one&amp;lt; <br> two\n\t three <b>in</b>line"),
        (5, "http://c.com/", "<p>again"),
        (None, "http://user@c.com:80/", "<p>x</p>" * 5000),
    ]
    frame = spark.createDataFrame(odd, SCHEMA).withColumns({"lines": F.lit("q"), "boilerplate": F.lit(1)})
    out = L.without_boilerplate(frame, prefix="_")
    assert out.columns == ["page_id", "url", "lines", "boilerplate", "_host", "_n_lines", "_n_dropped", "_text"]
    rows = {(r.page_id, r._n_lines): r for r in out.collect()}
    assert len(rows) == len(odd)
    assert rows[1, 1]._text == "kept, no host" and rows[2, 1]._host is None and rows[3, 0]._text == "" == rows[4, 0]._text
    assert rows[5, 2]._text == "one&lt;\ntwo three inline" and rows[None, 5000]._host == "c.com"
    assert L.without_boilerplate(spark.createDataFrame([], SCHEMA)).collect() == []


def test_repeats_within_a_page_count_once(spark):
    pages = [(i, "http://d.com", "<p>twice</p><p>twice</p>" if i < 5 else f"<p>{i}</p>") for i in range(20)]
    rows = run(spark, pages)
    assert rows[0].text == "twice\ntwice"  # 5 of 20 pages is not above a quarter
    pages = [(i, "http://d.com", "<p>twice</p><p>twice</p>" if i < 6 else f"<p>{i}</p>") for i in range(20)]
    assert run(spark, pages)[0].n_dropped == 2
