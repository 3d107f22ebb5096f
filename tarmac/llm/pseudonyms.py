"""Personal data replaced by format-preserving Feistel pseudonyms.

Candidates are found by one pattern, validated by kind, and permuted within
their format by a keyed Feistel network: the same value has the same pseudonym
in every document, different values of a kind and length have different ones,
and the key's holder can undo them.  A card number stays a valid card number,
an address an address, a date a date.  A Feistel network works on a pair of
numbers below p and q, so domains of the size p * q are permuted exactly and
nothing has to be tried again:

* card (13 to 19 digits with a valid check digit): all digits but the check
  digit, which is computed anew.  In a run of groups of digits, an unbroken
  number and groups of a card's usual lengths come first, longer ones before
  shorter ones; then other groups, likewise; what is left over of the run is
  searched for the kinds above.  Next to other numbers a run can so be read in
  another way once its card is replaced, and ``back`` then can't undo it.  A
  run ends after 64 groups and another one begins;
* phone (international, or national with an area code): all digits after the
  country code;
* ssn (with valid groups): 898 * 99 areas and groups by 9999 serials;
* ip (four octets): 65536 by 65536;
* date (a real day as 2024-02-29, 29/02/2024 or 29.02.2024): the day within
  its cycle of 400 years, 189 by 773 days;
* email (of a local part of at most 64 characters; of a longer one its end):
  the letters and digits of the local part (A-Z count as a-z), as numbers of
  base 36; signs and the domain stay;
* secret (a named password, token or key, or a cloud access key): its letters
  and digits, likewise, in pieces of 22.

Everything is built-in DataFrame functions.  Defined results: a null text stays
null; an empty text, and any candidate that isn't valid, stays as it is;
repeated rows are treated alike; empty tables give no rows; other columns are
kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.tables import table

#: The key of the registered query; a real run passes its own secret.
KEY = "tarmac pseudonyms"
ROUNDS = 8

# Fixed patterns of candidates, in the order in which they are tried.
PATTERNS: dict[str, str] = {
    # The lengths of real addresses bound it: neither time nor stack grow with a long run of letters or labels.
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,126}",
    "secret": r"(?<![A-Za-z0-9])(?:(?i:password|passwd|token|secret|api_?key)\s?[=:]\s?[\"']?[A-Za-z0-9]{8,}|AKIA[0-9A-Z]{16}(?![A-Za-z0-9]))",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\) ?|\d{3}[ .-])\d{3}[ .-]?\d{4}(?!\w)",
    "ip": r"(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\w]|\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "date": r"(?<![\w/.-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\w/-])",
    # A run of groups, which may hold more than a card; not into an address, a phone or a date with dots or slashes.
    "card": r"(?<![\w-])(?=\d(?:[ -]?\d){12})\d++(?!\w)(?:[ -](?!\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4}"
    # At most 64 groups are one run, so that the time for a long table of numbers is linear.
    r"|\d{3}(?:\.\d{3}[ .-]?|[ -]\d{3}\.)\d{4}(?!\w))\d++(?!\w|-(?!\d))){0,63}+(?![\w-])",
}
#: Cards within such a run at any group: unbroken, and in groups as they are printed.
_CARDS = [r"(\d{13,19})"] + [
    "((?:" + "|".join(shape.replace("S", sign) for sign in " -") + "))"
    for shape in (r"\d{4}(?:S\d{4}){3}S\d{1,3}", r"\d{4}(?:S\d{4}){3}", r"\d{4}S\d{6}S\d{5}", r"\d{4}S\d{6}S\d{4}", r"\d{4}(?:S\d{4}){2}S\d{1,3}")
]
ANY = "|".join(PATTERNS.values())
#: The days of 400 years, as a product.
_CYCLE_P, _CYCLE_Q = 189, 773
_PIECE = 22


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _long(x) -> Column:
    return (x if isinstance(x, Column) else F.lit(x)).cast("long")


def _feistel(a: Column, b: Column, p: Column, q: Column, tag: Column, key: str, back: bool = False) -> Column:
    """The struct (a, b) permuted: a stays below p, b below q; ``back`` undoes it."""

    def noise(i: Column, half: Column) -> Column:
        text = F.concat_ws("|", F.lit(key), tag, i.cast("string"), half.cast("string"))
        return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")

    start = F.struct(_long(a).alias("a"), _long(b).alias("b"), _long(p).alias("p"), _long(q).alias("q"))
    if back:
        rounds = F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1))
        step = lambda s, i: F.struct(
            F.pmod(s["b"] - noise(i, s["a"]) % s["q"], s["q"]).alias("a"), s["a"].alias("b"), s["q"].alias("p"), s["p"].alias("q")
        )
    else:
        rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
        step = lambda s, i: F.struct(
            s["b"].alias("a"), ((s["a"] + noise(i, s["b"]) % s["p"]) % s["p"]).alias("b"), s["q"].alias("p"), s["p"].alias("q")
        )
    return F.aggregate(rounds, start, step)


def permute_symbols(symbols: Column, base: int, tag: str, key: str, back: bool = False) -> Column:
    """A string of digits of ``base`` (lower case) permuted among those of its length.

    The two halves are numbers; up to 18 decimal digits or 11 of base 36 each.
    """
    n = F.length(symbols)
    u = F.floor(n / 2).cast("int")
    number = lambda x: F.coalesce(F.conv(F.when(x != "", x).otherwise("0"), base, 10), F.lit("0")).cast("decimal(38,0)").cast("long")
    power = lambda k: F.element_at(F.array([F.lit(base**i).cast("long") for i in range((18 if base == 10 else 11) + 1)]), k + 1)
    text = lambda x, k: F.lpad(F.lower(F.conv(x.cast("string"), 10, base)), k, "0")
    done = _feistel(
        number(F.substring(symbols, F.lit(1), u)), number(F.substring(symbols, u + 1, n - u)), power(u), power(n - u),
        F.concat(F.lit(f"{tag}|"), n.cast("string")), key, back,
    )
    return F.when(n == 0, symbols).otherwise(
        _let(done, lambda s: F.concat(F.when(u > 0, text(s["a"], u)).otherwise(""), text(s["b"], n - u)))
    )


def _refill(template: Column, symbols: Column, kind: str) -> Column:
    """``template`` with its characters of class ``kind`` replaced by ``symbols`` in turn."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    step = lambda s, c: F.when(
        c.rlike(kind), F.struct(F.concat(s["out"], F.substring(symbols, s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at"))
    ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at")))
    return F.aggregate(F.split(template, ""), start, step)["out"]


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """Sum of the digits from the right, those at places of parity ``doubled`` doubled."""
    value = lambda c, i: F.when(
        i % 2 == doubled, F.when(2 * c.cast("int") > 9, 2 * c.cast("int") - 9).otherwise(2 * c.cast("int"))
    ).otherwise(c.cast("int"))
    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), value), F.lit(0), lambda a, x: a + x)


def _card(m: Column, key: str, back: bool) -> Column:
    def done(digits: Column) -> Column:
        body = F.substring(digits, F.lit(1), F.length(digits) - 1)
        new = permute_symbols(body, 10, "card", key, back)
        full = _let(new, lambda b: F.concat(b, F.pmod(-_luhn_sum(b, 0), F.lit(10)).cast("string")))
        return F.when(_luhn_sum(digits, 1) % 10 == 0, _refill(m, full, "[0-9]"))

    return _let(_digits(m), done)


def _card_run(m: Column, key: str, back: bool) -> Column:
    """Struct (kinds, text) of a run of groups of digits."""
    valid = lambda c: (c != "") & (_luhn_sum(_digits(c), 1) % 10 == 0)
    part = lambda card, text: F.struct(F.lit(card).alias("card"), text.alias("text"))

    def cut(parts: Column, c: Column) -> Column:
        def split(s: Column) -> Column:
            at = F.when(s["card"], 0).otherwise(F.regexp_instr(s["text"], F.concat(F.lit(r"(?<!\d)"), c, F.lit(r"(?!\d)"))))
            rest = F.substring(s["text"], at + F.length(c), F.length(s["text"]))
            return F.when(at > 0, F.array(part(False, F.substring(s["text"], F.lit(1), at - 1)), part(True, c), part(False, rest))).otherwise(F.array(s))

        return F.flatten(F.transform(parts, split))

    def other_groups(text: Column) -> Column:
        """The longest valid beginning or end of each candidate of 13 to 19 digits in any groups."""
        found = F.regexp_extract_all(text, F.lit(r"(?<!\d)(\d(?:[ -]?\d){12,18})(?!\d)"), F.lit(1))
        tries = lambda c: F.array(
            *[F.regexp_extract(c, x, 1) for n in range(18, 11, -1) for x in (rf"^(\d(?:[ -]?\d){{{n}}})(?!\d)", rf"(?<!\d)(\d(?:[ -]?\d){{{n}}})$")]
        )
        return F.flatten(F.transform(found, lambda c: F.slice(F.filter(tries(c), valid), 1, 1)))

    printed = F.concat(*[F.regexp_extract_all(m, F.lit(rf"(?<!\d)(?={c}(?!\d))"), F.lit(1)) for c in _CARDS])
    first = F.aggregate(F.filter(printed, valid), F.array(part(False, m)), cut)
    others = lambda parts: F.flatten(F.transform(parts, lambda s: F.when(s["card"], F.array().cast("array<string>")).otherwise(other_groups(s["text"]))))
    parts = _let(first, lambda x: F.aggregate(others(x), x, cut))
    kinds = {k: _KINDS[k] for k in ("phone", "ssn", "date")}
    pattern = "|".join(PATTERNS[k] for k in kinds)

    def rest(text: Column) -> Column:
        found = F.transform(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)), lambda x: _pseudonym(x, key, back, kinds))
        return _let(found, lambda x: F.struct(F.flatten(x["kinds"]).alias("kinds"), _joined(text, pattern, x).alias("text")))

    done = F.transform(
        parts,
        lambda s: F.when(s["card"], F.struct(F.array(F.lit("card")).alias("kinds"), _card(s["text"], key, back).alias("text"))).otherwise(rest(s["text"])),
    )
    return _let(done, lambda x: F.struct(F.flatten(x["kinds"]).alias("kinds"), F.array_join(x["text"], "").alias("text")))


def _phone(m: Column, key: str, back: bool) -> Column:
    country = F.regexp_extract(m, r"^\+\d{1,3}(?=[ .(-])", 0)
    rest = F.substring(m, F.length(country) + 1, F.length(m))
    return F.concat(country, _let(rest, lambda r: _refill(r, permute_symbols(_digits(r), 10, "phone", key, back), "[0-9]")))


def _ip(m: Column, key: str, back: bool) -> Column:
    def done(o: Column) -> Column:
        new = _feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536), F.lit("ip"), key, back)
        parts = lambda s: F.concat_ws(".", *[x.cast("string") for half in ("a", "b") for x in (F.shiftright(s[half], 8), s[half] % 256)])
        return F.when(F.forall(o, lambda x: x < 256), _let(new, parts))

    return _let(F.transform(F.split(m, r"\."), lambda x: x.cast("int")), done)


def _ssn(m: Column, key: str, back: bool) -> Column:
    area, group, serial = (F.substring(m, i, n).cast("int") for i, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    place = F.when(area > 666, area - 2).otherwise(area - 1)  # 898 areas
    new = _feistel(place * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999), F.lit("ssn"), key, back)

    def text(s: Column) -> Column:
        at = F.floor(s["a"] / 99)
        named = F.when(at >= 665, at + 2).otherwise(at + 1)
        return F.concat_ws("-", *[F.lpad(x.cast("string"), n, "0") for x, n in ((named, 3), (s["a"] % 99 + 1, 2), (s["b"] + 1, 4))])

    return F.when(valid, _let(new, text))


def _date(m: Column, key: str, back: bool) -> Column:
    sign = F.substring(m, 3, 1)
    form = F.when(sign == "/", "dd/MM/yyyy").when(sign == ".", "dd.MM.yyyy").otherwise("yyyy-MM-dd")
    iso = F.when(
        sign.isin("/", "."), F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 4, 2), F.substring(m, 1, 2))
    ).otherwise(m)
    days = F.datediff(F.try_to_date(iso, "yyyy-MM-dd"), F.lit("1600-01-01").cast("date"))
    cycle = _CYCLE_P * _CYCLE_Q

    def done(d: Column) -> Column:
        inside = F.pmod(d, F.lit(cycle))
        new = _feistel(F.floor(inside / _CYCLE_Q), inside % _CYCLE_Q, F.lit(_CYCLE_P), F.lit(_CYCLE_Q), F.lit("date"), key, back)
        day = lambda s: F.date_add(F.lit("1600-01-01").cast("date"), (d - inside + s["a"] * _CYCLE_Q + s["b"]).cast("int"))
        return F.when(d.isNotNull() & (F.substring(iso, 1, 4) >= "1600"), _let(new, lambda s: F.when(form == "dd/MM/yyyy", F.date_format(day(s), "dd/MM/yyyy")).when(form == "dd.MM.yyyy", F.date_format(day(s), "dd.MM.yyyy")).otherwise(F.date_format(day(s), "yyyy-MM-dd"))))

    return _let(days, done)


def _letters(m: Column, tag: str, key: str, back: bool) -> Column:
    """The letters and digits of ``m``, permuted as base 36 in pieces of ``_PIECE``."""
    symbols = F.regexp_replace(F.lower(m), "[^a-z0-9]", "")
    pieces = F.regexp_extract_all(symbols, F.lit(f"(.{{1,{_PIECE}}})"), F.lit(1))
    return F.array_join(F.transform(pieces, lambda x: permute_symbols(x, 36, tag, key, back)), "")


def _email(m: Column, key: str, back: bool) -> Column:
    local = F.substring_index(m, "@", 1)
    new = _refill(F.lower(local), _letters(local, "email", key, back), "[a-z0-9]")
    return F.concat(new, F.lit("@"), F.substring_index(m, "@", -1))


def _secret(m: Column, key: str, back: bool) -> Column:
    name = F.regexp_extract(m, r"^(?:AKIA|[A-Za-z_]+\s?[=:]\s?[\"']?)", 0)
    rest = F.substring(m, F.length(name) + 1, F.length(m))
    new = _letters(rest, "secret", key, back)
    return F.concat(name, F.when(name == "AKIA", F.upper(new)).otherwise(new))


_KINDS = {"email": _email, "secret": _secret, "phone": _phone, "ip": _ip, "ssn": _ssn, "date": _date}


def _pseudonym(m: Column, key: str, back: bool, kinds: dict = _KINDS) -> Column:
    """Struct (kinds, text) of one candidate; no kinds leave it as it is."""
    tried = []
    for kind, make in kinds.items():
        whole = m.rlike(f"^(?:{PATTERNS[kind]})$")
        made = F.when(whole, make(m, key, back))
        tried.append(F.when(made.isNotNull(), F.struct(F.array(F.lit(kind)).alias("kinds"), made.alias("text"))))
    if kinds is _KINDS:
        tried.append(F.when(m.rlike(f"^(?:{PATTERNS['card']})$"), _card_run(m, key, back)))
    return F.coalesce(*tried, F.struct(F.array().cast("array<string>").alias("kinds"), m.alias("text")))


def _joined(text: Column, pattern: str, found: Column) -> Column:
    """``text`` with the texts of ``found`` in place of its candidates."""
    pieces = F.split(text, pattern, -1)  # between the candidates; one more than candidates
    return F.array_join(F.zip_with(pieces, found["text"], lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")


def pseudonymise(docs: DataFrame, key: str = KEY, text: str = "text", found: str = "pseudonyms", back: bool = False) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and a column ``found`` of its kinds, in order.

    ``back=True`` undoes the replacement (emails and secrets come back lower-cased).
    """
    new = F.transform(F.regexp_extract_all(F.col(text), F.lit(f"({ANY})"), F.lit(1)), lambda m: _pseudonym(m, key, back))
    joined = _joined(F.col(text), ANY, F.col(found))
    has = F.col(text).rlike("[0-9@]|[=:]")
    out = docs.withColumn(found, F.when(has, new))
    changed = F.when(F.size(F.col(found)) > 0, joined).otherwise(F.col(text))
    kinds = F.flatten(F.col(found)["kinds"])
    return out.withColumn(text, changed).withColumn(found, F.coalesce(kinds, F.array().cast("array<string>")))


def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the text with pseudonyms, and how many of each kind it has."""
    docs = pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("pseudonyms", lambda x: x == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in PATTERNS]
    return docs.select("doc_id", "text", F.size("pseudonyms").cast("long").alias("n_pseudonyms"), *counts)
