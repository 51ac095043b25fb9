"""Format-preserving pseudonyms for personal numbers, dates and addresses.

Built-in functions only. A text is split at one pattern's matches; each match is
validated and, if valid, its value is permuted by a keyed Feistel network whose
halves are lists of residues (each position with a radix of its own), then
written back into the match's own layout. A permutation never merges two values
and gives equal values equal pseudonyms in every document and layout.

* card: 13 to 19 digits, Luhn; first digit kept, check digit computed anew
* iban: ISO 7064 mod 97; country and letters kept, check digits computed anew
* ssn: area 001-899 but 666, group 01-99, serial 0001-9999
* phone: 10 to 15 digits with separators, or 8 to 15 after a plus; country code kept; digits 0-1 and 2-9 stay apart where an area or
  exchange begins
* ip: four octets
* date: a calendar day of 1900 to 2099, year-month-day or with the year last
  (month first if that is a day, else day first); 73049 = 17 * 4297 days
* email: letters and digits of the local part, by case; the domain tweaks it

A match that does not validate as a whole is searched for values within it that
begin and end at its separators (a card before its expiry, CVV or year, an IBAN
before a word). Anything that does not validate stays. The key is a parameter; who has it can
undo the permutation. Short values have few images, so a one-letter mailbox may
map to itself. Defined cases: null stays null, an empty text stays empty, repeated
rows get equal results, very long texts are taken whole, an empty table gives no rows,
extra columns pass through unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cut import free_prefix

KINDS = ("email", "iban", "date", "ssn", "ip", "card", "phone")

PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![A-Za-z0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "date": r"(?<![0-9A-Za-z./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}([./-])[0-9]{1,2}\1[0-9]{4})(?![0-9A-Za-z]|[./-][0-9])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9])",
    "ip": r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9A-Za-z]|\.[0-9])",
    "card": r"(?<![0-9A-Za-z-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z]|-[0-9])",
    # area, exchange and line first: a number after them is none of theirs
    "phone": r"(?<![0-9A-Za-z])(?:(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z]|[.-][0-9])|(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){2,4})(?![0-9A-Za-z]|-[0-9])",
}
#: Within a match: cards written as one run, in fours, or as four, six and the rest.
_CARD_LAYOUT = r"^(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?:\1[0-9]{1,3})?|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5})$"
#: Within a match: phones of area, exchange and line, or after a plus.
_PHONE_LAYOUT = r"^(?:\+|(?:1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}$)"
#: Length of an IBAN by country; others are held to 15 characters and mod 97.
IBAN_LENGTHS = {n: c.split() for n, c in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items()}
_ANY = "|".join(f"(?:{PATTERNS[k].replace(chr(92) + '1', chr(92) + 'k<sep>').replace('([./-])', '(?<sep>[./-])')})"
                for k in KINDS)
_ROUNDS = 8
_EPOCH, _LAST, _A, _B = "1900-01-01", "2099-12-31", 17, 4297


def _let(value: Column, body) -> Column:
    """``body`` over a value computed once."""
    return F.transform(F.array(value), body)[0]


def _feistel(values: Column, radices: Column, tweak: Column, key: str) -> Column:
    """Permutes a list of residues; position j stays below its radix."""
    half = F.floor(F.size(values) / 2).cast("int")
    rest = F.size(values) - half

    def turn(s: Column, i: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), tweak, i.cast("string"),
                                    F.array_join(F.transform(s["r"], lambda x: x.cast("string")), ",")), 512)
        moved = _let(digest, lambda h: F.transform(s["l"], lambda x, j: F.pmod(
            x + F.conv(F.substring(h, 1 + 8 * (j % 16), F.lit(8)), 16, 10).cast("long"),
            F.get(s["rl"], j))))
        return F.struct(s["r"].alias("l"), moved.alias("r"), s["rr"].alias("rl"), s["rl"].alias("rr"))

    start = F.struct(F.slice(values, 1, half).alias("l"), F.slice(values, half + 1, rest).alias("r"),
                     F.slice(radices, 1, half).alias("rl"), F.slice(radices, half + 1, rest).alias("rr"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(_ROUNDS)), start, turn, lambda s: F.concat(s["l"], s["r"]))


def _digits(m: Column) -> Column:
    return F.transform(F.regexp_extract_all(m, F.lit("[0-9]"), F.lit(0)), lambda x: x.cast("long"))


def _all(values: Column, radix: int) -> Column:
    return F.transform(values, lambda _: F.lit(radix).cast("long"))


def _write_digits(m: Column, digits: Column) -> Column:
    """``m`` with its digits replaced, in order."""
    chars = F.regexp_extract_all(m, F.lit("(?s)."), F.lit(0))
    zero = F.struct(F.lit("").alias("out"), F.lit(0).alias("k"))
    return F.aggregate(chars, zero, lambda s, c: F.when(
        c.rlike("[0-9]"), F.struct(F.concat(s["out"], F.get(digits, s["k"]).cast("string")).alias("out"),
                                   (s["k"] + 1).alias("k")))
        .otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["k"].alias("k"))), lambda s: s["out"])


def _luhn(digits: Column, doubled: int) -> Column:
    """Luhn sum mod 10; ``doubled`` is the parity, from the right, of doubled places."""
    return F.aggregate(F.transform(F.reverse(digits), lambda x, j: F.when(
        j % 2 == doubled, F.when(x > 4, 2 * x - 9).otherwise(2 * x)).otherwise(x)),
        F.lit(0).cast("long"), lambda a, x: a + x) % 10


def _card(m: Column, key: str) -> Column:
    def valid(d):
        middle = F.slice(d, 2, F.size(d) - 2)
        body = F.concat(F.slice(d, 1, 1), _feistel(middle, _all(middle, 10), F.lit("card"), key))
        phone_first = m.rlike("^[0-9]{3}[ -][0-9]{3}[ -][0-9]{4}[ -]")
        return F.when((F.get(d, F.lit(0)) > 0) & (_luhn(d, 1) == 0) & ~phone_first, _let(body, lambda b: _write_digits(
            m, F.concat(b, F.array((10 - _luhn(b, 0)) % 10)))))
    return _let(_digits(m), valid)


def _mod97(chars: Column) -> Column:
    return F.aggregate(chars, F.lit(0).cast("long"), lambda a, c: F.when(
        c.rlike("[0-9]"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))


def _iban(m: Column, key: str) -> Column:
    def chars(x):
        return F.regexp_extract_all(x, F.lit("[A-Z0-9]"), F.lit(0))

    def turned(x):  # the account first, then the country and the check digits
        return F.concat(F.slice(x, 5, F.size(x) - 4), F.slice(x, 1, 4))

    def valid(c):
        digits = _digits(m)
        body = _feistel(F.slice(digits, 3, F.size(digits) - 2),
                        _all(F.slice(digits, 3, F.size(digits) - 2), 10), F.lit("iban"), key)

        def finish(b):
            draft = _write_digits(m, F.concat(F.array(F.lit(0).cast("long"), F.lit(0).cast("long")), b))
            check = 98 - _mod97(turned(chars(draft)))
            return _let(check, lambda k: _write_digits(m, F.concat(F.array(F.floor(k / 10), k % 10), b)))
        country, right = F.substring(m, 1, 2), F.size(c) >= 15
        for n, countries in IBAN_LENGTHS.items():
            right = F.when(country.isin(*countries), F.size(c) == n).otherwise(right)
        return F.when(right & (_mod97(turned(c)) == 1), _let(body, finish))
    return _let(chars(m), valid)


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.substring(m, a, n).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    values = F.array(F.when(area > 666, area - 2).otherwise(area - 1), group - 1, serial - 1)
    radices = F.array(*[F.lit(x).cast("long") for x in (898, 99, 9999)])

    def finish(v):
        a = F.get(v, F.lit(0)) + 1
        return F.concat_ws("-", F.lpad(F.when(a >= 666, a + 1).otherwise(a).cast("string"), 3, "0"),
                           F.lpad((F.get(v, F.lit(1)) + 1).cast("string"), 2, "0"),
                           F.lpad((F.get(v, F.lit(2)) + 1).cast("string"), 4, "0"))
    ok = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    return F.when(ok, _let(_feistel(values, radices, F.lit("ssn"), key), finish))


def _ip(m: Column, key: str) -> Column:
    def valid(v):
        ok = F.forall(v, lambda x: x < 256)
        return F.when(ok, F.array_join(F.transform(
            _feistel(v, _all(v, 256), F.lit("ip"), key), lambda x: x.cast("string")), "."))
    return _let(F.transform(F.split(m, r"\."), lambda x: x.cast("long")), valid)


def _phone(m: Column, key: str) -> Column:
    code = F.when(m.startswith("+"), F.length(F.regexp_extract(m, r"^\+([0-9]{1,3}?)(?:[ .(-]|(?<=^\+[17])|(?<=^\+[0-9]{2})(?=[0-9]{4}))", 1))) \
        .otherwise(0)

    def valid(d):
        rest = F.slice(d, code + 1, F.size(d) - code)

        def permuted(x):
            # area and exchange of a ten-digit number begin with 2-9: both ranges stay
            lead = lambda j: (F.size(x) == 10) & j.isin(0, 3)
            low = F.transform(x, lambda v, j: F.when(lead(j) & (v > 1), v - 2).otherwise(v))
            radix = F.transform(x, lambda v, j: F.when(lead(j), F.when(v > 1, 8).otherwise(2)).otherwise(10).cast("long"))
            moved = _feistel(low, radix, F.lit("phone"), key)
            return F.zip_with(x, moved, lambda v, w: F.struct(v.alias("v"), w.alias("w"))), lead

        def finish(x):
            pairs, lead = permuted(x)
            out = F.transform(pairs, lambda p, j: F.when(lead(j) & (p["v"] > 1), p["w"] + 2).otherwise(p["w"]))
            return _write_digits(m, F.concat(F.slice(d, 1, code), out))
        plain = F.size(d).between(10, 15) & m.rlike("[^0-9]")
        more = m.rlike(r"^(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4} ")
        return F.when((plain | (m.startswith("+") & F.size(d).between(8, 15))) & ~more, _let(rest, finish))
    return _let(_digits(m), valid)


def _date(m: Column, key: str) -> Column:
    iso = m.rlike("^[0-9]{4}-")
    parts = F.transform(F.split(m, "[./-]"), lambda x: x.cast("int"))

    def valid(p):
        a, b, c = (F.get(p, F.lit(i)) for i in range(3))
        month_first = F.when(iso, F.lit(None)).otherwise(F.try_to_date(
            F.format_string("%04d-%02d-%02d", c, a, b), "yyyy-MM-dd"))
        day = F.when(iso, F.try_to_date(F.format_string("%04d-%02d-%02d", a, b, c), "yyyy-MM-dd")) \
            .otherwise(F.coalesce(month_first, F.try_to_date(F.format_string("%04d-%02d-%02d", c, b, a), "yyyy-MM-dd")))
        n = F.datediff(day, F.lit(_EPOCH).cast("date")).cast("long")
        moved = _feistel(F.array(F.floor(n / _B), n % _B), F.array(F.lit(_A).cast("long"), F.lit(_B).cast("long")),
                         F.lit("date"), key)

        def finish(v):
            new = F.date_add(F.lit(_EPOCH).cast("date"), (F.get(v, F.lit(0)) * _B + F.get(v, F.lit(1))).cast("int"))
            # a day-first date must not read as a month-first one: it keeps its layout all the same
            y, mo, d = F.date_format(new, "yyyy"), F.date_format(new, "MM"), F.date_format(new, "dd")
            sep = F.regexp_extract(m, "[./-]", 0)
            return F.when(iso, F.concat_ws("-", y, mo, d)) \
                .when(month_first.isNotNull(), F.concat(mo, sep, d, sep, y)).otherwise(F.concat(d, sep, mo, sep, y))
        ok = day.between(F.lit(_EPOCH).cast("date"), F.lit(_LAST).cast("date"))
        return F.when(ok, _let(moved, finish))
    return _let(parts, valid)


def _email(m: Column, key: str) -> Column:
    local, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    base = lambda c: F.when(c.rlike("[a-z]"), 97).when(c.rlike("[A-Z]"), 65).otherwise(48)

    def finish(c):
        signs = F.filter(c, lambda x: x.rlike("[A-Za-z0-9]"))
        values = F.transform(signs, lambda x: (F.ascii(x) - base(x)).cast("long"))
        radices = F.transform(signs, lambda x: F.when(x.rlike("[0-9]"), 10).otherwise(26).cast("long"))
        moved = _feistel(values, radices, F.concat(F.lit("email"), F.lower(domain)), key)
        zero = F.struct(F.lit("").alias("out"), F.lit(0).alias("k"))
        return _let(moved, lambda v: F.aggregate(c, zero, lambda s, x: F.when(
            x.rlike("[A-Za-z0-9]"), F.struct(F.concat(s["out"], F.char(F.get(v, s["k"]) + base(x))).alias("out"),
                                             (s["k"] + 1).alias("k")))
            .otherwise(F.struct(F.concat(s["out"], x).alias("out"), s["k"].alias("k"))),
            lambda s: F.concat(s["out"], F.lit("@"), domain)))
    return _let(F.regexp_extract_all(local, F.lit("(?s)."), F.lit(0)), finish)


_RULES = {"email": _email, "iban": _iban, "date": _date, "ssn": _ssn, "ip": _ip, "card": _card, "phone": _phone}


def _inner(m: Column, key: str) -> Column:
    """Struct of a match no rule accepts as a whole, with the valid values in it
    replaced, and their number: its groups are taken from the left, the longest run
    of them that validates first, and what follows is searched again. Numbers without
    check digits take no group of one that has them."""
    groups = F.regexp_extract_all(m, F.lit("[^ .-]+|[ .-]+"), F.lit(0))

    def value(c: Column, kind: str, layout: str) -> Column:
        return F.when(c.rlike(layout) & c.rlike(f"^(?:{PATTERNS[kind]})$"), _RULES[kind](c, key))

    def at(g: Column) -> Column:
        # groups and separators take turns, so a run that ends with a group has an odd length
        runs = F.flatten(F.transform(F.sequence(F.lit(0), F.size(g) - 1), lambda s: F.transform(
            F.sequence(F.size(g) - s, F.lit(1), F.lit(-1)), lambda n: F.struct(
                s.alias("s"), n.alias("n"), F.array_join(F.slice(g, s + 1, n), "").alias("c")))))
        runs = F.filter(runs, lambda r: (r["n"] % 2 == 1) & r["c"].rlike("^[^ .-].*[^ .-]$")
                        & F.length(r["c"]).between(10, 42))
        made = F.filter(F.transform(runs, lambda r: F.struct(
            r["s"].alias("s"), r["n"].alias("n"),
            F.coalesce(value(r["c"], "iban", "^[A-Z]{2}[0-9]{2}"), value(r["c"], "card", _CARD_LAYOUT)).alias("sure"),
            F.coalesce(value(r["c"], "ssn", "^[0-9]{3}-"), value(r["c"], "phone", _PHONE_LAYOUT)).alias("loose"))),
            lambda r: r["sure"].isNotNull() | r["loose"].isNotNull())
        made = _let(made, lambda all_: F.transform(F.filter(all_, lambda r: r["sure"].isNotNull() | ~F.exists(
            all_, lambda q: q["sure"].isNotNull() & (q["s"] < r["s"] + r["n"]) & (r["s"] < q["s"] + q["n"]))),
            lambda r: F.struct(r["s"].alias("s"), r["n"].alias("n"), F.coalesce(r["sure"], r["loose"]).alias("new"))))
        start = F.struct(F.lit("").alias("out"), F.lit(0).alias("pos"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(made, start, lambda a, r: F.when(r["s"] >= a["pos"], F.struct(
            F.concat(a["out"], F.array_join(F.slice(g, a["pos"] + 1, r["s"] - a["pos"]), ""), r["new"]).alias("out"),
            (r["s"] + r["n"]).alias("pos"), (a["n"] + 1).alias("n"))).otherwise(a),
            lambda a: F.struct(F.concat(a["out"], F.array_join(F.slice(g, a["pos"] + 1, F.size(g)), "")).alias("v"),
                               a["n"].alias("n")))
    return _let(groups, at)


def replaced(text: Column, key: str) -> Column:
    """Struct of the pseudonymised text and the number of replacements."""
    def one(m: Column) -> Column:
        # the first kind whose whole pattern the match has and whose rule accepts it
        whole = F.coalesce(*[F.when(m.rlike(f"^(?:{PATTERNS[k]})$"), _RULES[k](m, key)) for k in KINDS])
        return _let(whole, lambda w: F.when(w.isNotNull(), F.struct(w.alias("v"), F.lit(1).cast("long").alias("n")))
                    .when(m.rlike("[0-9A-Z][ .-]") & ~m.contains("@"), _inner(m, key))
                    .otherwise(F.struct(m.alias("v"), F.lit(0).cast("long").alias("n"))))

    matches = F.regexp_extract_all(text, F.lit(_ANY), F.lit(0))
    both = F.transform(matches, one)
    gaps = F.split(text, _ANY, -1)

    def join(b: Column) -> Column:
        filled = F.concat(F.transform(b, lambda x: x["v"]), F.array(F.lit("")))
        return F.struct(F.array_join(F.zip_with(gaps, filled, lambda g, v: F.concat(g, v)), "").alias("text"),
                        F.aggregate(b, F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("n"))
    return F.when(text.rlike("[0-9@]"), _let(both, join)) \
        .otherwise(F.struct(text.alias("text"), F.lit(0).cast("long").alias("n")))


def pseudonymise(docs: DataFrame, key: str = "tidewell", count: str | None = None) -> DataFrame:
    """``docs`` with ``text`` pseudonymised and ``n_chars``, if there, following it;
    ``count`` names a column for the number of replacements, last, in place of one of
    that name if there is one."""
    own = free_prefix(docs.columns, "made_")
    made = docs.withColumn(own, replaced(F.col("text").cast("string"), key))
    out = [F.col(f"{own}.text").alias("text") if c == "text"
           else F.length(f"{own}.text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
           else F.col(f"`{c}`") for c in docs.columns if not count or c.lower() != count.lower()]
    if count:
        out.append(F.col(f"{own}.n").alias(count))
    return made.select(*out)
