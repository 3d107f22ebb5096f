"""Boilerplate lines by their frequency within a site.

A page's lines are the texts between its block-level tags, white space
collapsed.  Pages are grouped by host; a line is boilerplate there if the share
of the host's pages that hold it exceeds ``RATIO`` and it is on ``LEAST`` of them
at least.

Everything is built-in DataFrame functions.  Lines are counted by 64-bit hash,
once a page and summed before they are shuffled; a host has fewer boilerplate
lines than ``1 / RATIO`` times the lines of its average page, so the list that
its pages are joined with stays short however many pages it has.  The time for
a page is linear in its length, unclosed markup included.  The host's
totals and lists are written tables, so a hot host is split by the skew join.

Defined results: a null or empty page has no lines and the text ''; a page
without a host keeps all lines; a line that repeats within a page counts once
for it and is kept or dropped in all its places; repeated pages each count;
empty tables give no rows; extra columns are ignored or, by
``without_boilerplate``, kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.tables import table, written

RATIO = 0.25
#: Pages a line must be on, whatever its host's size: a page alone has no boilerplate.
LEAST = 2
#: Characters from which a page's unclosed markup is set apart first (results are the same).
LONG = 1 << 16

# Fixed patterns: what is not text, tags that end a line, and the entities decoded.
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
_ELEMENTS = ("script", "style", "noscript", "template", "head")
_NOT_TEXT = "(?is)<!--.*?-->|" + "|".join(rf"<{x}\b.*?</{x}\s*>" for x in _ELEMENTS)
_LINE_TAGS = (
    r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|header|hr|html|li|main|nav|ol|p|"
    r"pre|section|table|td|th|tr|ul)\b[^>]*>"
)
_TAGS = r"<[^>]*>"
_SIGN = "\uffff"  # not a character
_SPACE = r"[\x20\x09-\x0D]+"
_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&copy;": "©", "&middot;": "·", "&amp;": "&"}


def host_of(url: Column) -> Column:
    """The host of a URL, lower-cased; null if it has none."""
    host = F.lower(F.regexp_extract(url, _HOST, 1))
    return F.when(host != "", host)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _marked(html: Column) -> Column:
    """``html`` with a sign after each ``<`` that opens what is never closed.

    A pattern that looks for the end of each of them reads the rest of the page
    again and again.  The sign keeps it from trying; nothing else can match.
    """

    def step(opened: str, close: str):
        sign = rf"(?i)<(?={opened})"
        signed = lambda h, r: F.concat(F.substring(h, F.lit(1), F.length(h) - F.length(r)), F.regexp_replace(r, sign, "<" + _SIGN))
        return lambda h: _let(F.regexp_replace(h, rf"(?is)\A.*{close}", ""), lambda r: signed(h, r))

    for opened, close in (("!--", "-->"), *((x, rf"</{x}\s*>") for x in _ELEMENTS)):
        html = _let(html, step(opened, close))
    return html


def _spaced(text: Column) -> Column:
    return F.regexp_replace(text, _SPACE, " ")


def _without_tags(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, _LINE_TAGS, "\n"), _TAGS, "")


def _text_of_long(html: Column) -> Column:
    """As for other pages, in time linear in the page's length."""
    text = F.replace(F.regexp_replace(_marked(html), _NOT_TEXT, "\n"), F.lit("<" + _SIGN), F.lit("<"))

    def without_tags(t: Column) -> Column:  # none ends after the last ">"
        end = F.substring_index(t, ">", -1)
        return _let(end, lambda e: F.concat(_without_tags(F.substring(t, F.lit(1), F.length(t) - F.length(e))), e))

    return _let(_spaced(text), without_tags)


def lines_of(html: Column) -> Column:
    """The lines of a page, in order, without empty ones."""
    html = F.coalesce(html, F.lit(""))
    plain = _without_tags(_spaced(F.regexp_replace(html, _NOT_TEXT, "\n")))
    text = F.when(F.length(html) > LONG, _text_of_long(html)).otherwise(plain)
    for entity, sign in _ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(sign))
    return F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(_spaced(x))), lambda x: x != "")


def boilerplate(pages: DataFrame) -> DataFrame:
    """host, pages and boilerplate (hashes of its lines), from rows host, lines; hosts with any."""
    sites = pages.filter(F.col("host").isNotNull())
    totals = written(sites.groupBy("host").agg(F.count("*").alias("pages")).filter(F.col("pages") >= LEAST), "lines-hosts")
    each = sites.select("host", F.explode(F.array_distinct(F.transform("lines", lambda x: F.xxhash64(x)))).alias("line"))
    often = each.groupBy("host", "line").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST)
    # Not a join of two aggregates: both sides are dealt by host anew and can be split.
    found = often.join(totals, "host").filter(F.col("n") > RATIO * F.col("pages"))
    return found.groupBy("host").agg(F.first("pages").alias("pages"), F.collect_list("line").alias("boilerplate"))


def without_boilerplate(pages: DataFrame, url: str = "url", html: str = "html", prefix: str = "") -> DataFrame:
    """``pages`` less ``html``, with host, n_lines, n_dropped and text (the kept lines) appended."""
    names = {x: f"{prefix}{x}" for x in ("host", "n_lines", "n_dropped", "text", "lines", "boilerplate", "of")}
    rest = [c for c in pages.columns if c != html]
    lines = pages.select(*rest, host_of(F.col(url)).alias(names["host"]), lines_of(F.col(html)).alias(names["lines"]))
    lines = written(lines, "lines")  # read twice below; cutting pages into lines is most of the work
    sites = lines.select(F.col(names["host"]).alias("host"), F.col(names["lines"]).alias("lines"))
    lists = written(boilerplate(sites), "lines-boilerplate").select(
        F.col("host").alias(names["of"]), F.col("boilerplate").alias(names["boilerplate"])
    )
    joined = lines.join(lists, F.col(names["host"]) == F.col(names["of"]), "left")
    drop = F.coalesce(F.col(names["boilerplate"]), F.array().cast("array<bigint>"))
    kept = F.filter(names["lines"], lambda x: ~F.array_contains(drop, F.xxhash64(x)))
    out = joined.withColumn(names["text"], kept)
    n = F.size(names["lines"]).cast("long")
    return out.select(
        *rest,
        names["host"],
        n.alias(names["n_lines"]),
        (n - F.size(names["text"])).alias(names["n_dropped"]),
        F.array_join(names["text"], "\n").alias(names["text"]),
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_boilerplate(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def _sql() -> str:
    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    text = f"regexp_replace(regexp_replace(coalesce(html, ''), {quoted(_NOT_TEXT)}, chr(10), 'g'), {quoted(_SPACE)}, ' ', 'g')"
    text = f"regexp_replace(regexp_replace({text}, {quoted(_LINE_TAGS)}, chr(10), 'g'), {quoted(_TAGS)}, '', 'g')"
    for entity, sign in _ENTITIES.items():
        text = f"replace({text}, {quoted(entity)}, {quoted(sign)})"
    return f"""
WITH split AS (
  SELECT row_number() OVER () AS rid, page_id, url, nullif(lower(regexp_extract(url, {quoted(_HOST)}, 1)), '') AS host,
         list_filter(list_transform(string_split({text}, chr(10)),
                                    lambda x: trim(regexp_replace(x, {quoted(_SPACE)}, ' ', 'g'))), lambda x: x <> '') AS lines
  FROM pages
), totals AS (
  SELECT host, count(*) AS pages FROM split WHERE host IS NOT NULL GROUP BY host
), each AS (
  SELECT rid, host, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM split
), often AS (
  SELECT host, line, count(DISTINCT rid) AS n FROM each WHERE host IS NOT NULL GROUP BY host, line
), bad AS (
  SELECT o.host, o.line FROM often o JOIN totals t ON o.host = t.host WHERE n >= {LEAST} AND n > {RATIO} * pages
), kept AS (
  SELECT rid, string_agg(e.line, chr(10) ORDER BY i) AS text, count(*) AS n
  FROM each e LEFT JOIN bad b ON e.host = b.host AND e.line = b.line WHERE b.line IS NULL GROUP BY rid
)
SELECT page_id, url, host, len(lines)::BIGINT AS n_lines, (len(lines) - coalesce(n, 0))::BIGINT AS n_dropped, coalesce(text, '') AS text
FROM split s LEFT JOIN kept k ON s.rid = k.rid
"""


SQL = _sql()
