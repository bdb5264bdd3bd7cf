"""Format-preserving Feistel pseudonyms for personal numbers and dates (built-in functions only).

Numbers and dates that pass their format's check are replaced by a keyed permutation of
their own format, so equal values get equal pseudonyms in every document and different
values different ones:

* card: 13-19 digits with a valid check digit (Luhn); the payload is permuted and the check
  digit made anew, so pseudonyms are valid too; separators stay. A longer run of digit groups, or
  one whose check fails, is searched for cards among its neighbouring groups;
* phone: +country (area) exchange-line and other international numbers of 8 to 15 digits, and
  national ones as (ddd) ddd-dddd, ddd-ddd-dddd or ddd.ddd.dddd, with 1 before them or not; the digits
  after the country code are permuted, so +1 and national spellings of a number stay equal;
* iban: two letters, two check digits (modulo 97) and the account, in groups of four or not; the
  account's digits are permuted, letters stay, the check digits are made anew;
* ssn: ddd-dd-dddd with a valid area, group and serial; permuted among valid numbers;
* ip: dotted quads of 0-255; the 32 bits are permuted;
* date: valid calendar dates of 1900-2099 as yyyy-mm-dd, yyyy/mm/dd, dd.mm.yyyy, dd/mm/yyyy, or mm/dd/yyyy where the day is
  above 12 (dd/mm otherwise). Days of the month above 12 are permuted among themselves, and so are the others, in every
  spelling: equal dates stay equal, and mm/dd stays told from dd/mm.

Dates, numbers, addresses and telephone numbers after a blank end a run of digits before them. IPv6
addresses, national numbers of bare digits or blanks, cards with dots and dates with one digit or a two-digit year
have no format here and stay.

The permutation is a generalised (unbalanced) Feistel network on Z_a x Z_b, a*b being
the format's size: odd rounds add a keyed SHA-256 of one half to the other modulo a, even
rounds modulo b. It is a bijection for any a and b; dates walk its cycles to the next day of their kind. E-mail
addresses have no number format; their local part becomes a keyed hash under the same key
(`email`), linked but not permuted.

The text is cut at the matches of one pattern and put together again within its row: no
shuffle, nothing collected. Edge cases: NULL text stays NULL, empty stays empty, texts of
any length are processed whole; invalid numbers and dates stay as they are; repeated rows
give repeated rows; a NULL doc_id stays NULL; columns other than doc_id and text are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
#: Formats found in texts, as alternatives of one Java pattern; the first that fits wins.
_DAY = r"(?:0[1-9]|[12][0-9]|3[01])"
_MONTH = r"(?:0[1-9]|1[0-2])"
#: What ends a run of digit groups: a date, number, address or telephone number that begins there.
_STOP = (rf"(?<![0-9-])(?:(?:19|20)[0-9]{{2}}-{_MONTH}-{_DAY}(?![0-9])|[0-9]{{2}}\.[0-9]{{2}}\.[0-9]{{4}}(?![0-9])|[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}(?![0-9])"
         r"|(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])|[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9-])"
         r"|[0-9]{3}\.[0-9]{3}\.[0-9]{4}(?![0-9])|[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9]))")
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}([./])[0-9]{2}\1[0-9]{4})(?![0-9])",
    "phone": (r"\+[0-9]{1,3} \([0-9]{3}\) [0-9]{3}-[0-9]{4}(?![0-9])|(?<![0-9+])\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
              r"|(?<![0-9+])\+(?!1[^0-9]?[0-9])[1-9](?:[ .-]?\(?[0-9]\)?){7,14}(?![0-9])"
              r"|(?<![0-9A-Za-z])(?:1[ .-])?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}(?![0-9-])"
              r"|(?<![0-9A-Za-z.-])(?:1-)?[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9-])"
              r"|(?<![0-9A-Za-z.-])(?:1\.)?[0-9]{3}\.[0-9]{3}\.[0-9]{4}(?!\.?[0-9])"),
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": rf"(?<![0-9])(?=[0-9](?:[ -]?(?!{_STOP})[0-9]){{12}})[0-9](?:[ -]?(?!{_STOP})[0-9])*+",
}
#: A run of digit groups, as the card pattern takes them.
RUN = r"[0-9](?:[ -]?[0-9])*+"
#: Country codes of one and two digits; the others have three.
SHORT_CODES = r"^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Days from 1900-01-01 to 2099-12-31, and their factors 17 * 4297.
DAY_FACTORS = (17, 4297)
#: Steps along a cycle of days to one of the same kind (each ends it with a chance of 0.4 or 0.6).
STEPS = 96
#: Valid numbers: 898 areas (001-899 without 666) * 99 groups, and 9999 serials.
SSN_FACTORS = (898 * 99, 9999)


def prf(key: str, *parts: Column) -> Column:
    """60 keyed bits of the parts, as a long."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts]), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _div(x: Column, y: Column) -> Column:
    """Whole quotient of non-negative longs."""
    return F.floor((x - F.pmod(x, y)).cast("decimal(20,0)") / y.cast("decimal(20,0)")).cast("long")


def feistel(value: Column, a: Column, b: Column, tweak: Column, key: str, rounds: int = ROUNDS) -> Column:
    """A keyed permutation of 0 .. a*b-1."""
    init = F.struct(_div(value, b).alias("l"), F.pmod(value, b).cast("long").alias("r"))

    def step(s, i):
        odd = i % 2 == 1
        half = F.when(odd, s["r"]).otherwise(s["l"])
        f = prf(key, tweak, i, half)
        return F.struct(F.when(odd, F.pmod(s["l"] + F.pmod(f, a), a)).otherwise(s["l"]).alias("l"),
                        F.when(odd, s["r"]).otherwise(F.pmod(s["r"] + F.pmod(f, b), b)).alias("r"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), init, step, lambda s: s["l"] * b + s["r"])


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _pow10(n: Column) -> Column:
    return F.rpad(F.lit("1"), n.cast("int") + 1, "0").cast("long")


def permute_digits(digits: Column, kind: str, key: str) -> Column:
    """A digit string of up to 36 digits, permuted among the strings of its length (two halves of
    at most 18 digits each are the Feistel halves)."""
    n = F.length(digits)
    u = F.floor(n / 2).cast("int")
    a, b = _pow10(u), _pow10(n - u)
    init = F.struct(F.concat(F.lit("0"), F.substring(digits, F.lit(1), u)).cast("long").alias("l"),
                    F.substring(digits, u + 1, n).cast("long").alias("r"))

    def step(s, i):
        odd = i % 2 == 1
        f = prf(key, F.lit(kind), n, i, F.when(odd, s["r"]).otherwise(s["l"]))
        return F.struct(F.when(odd, F.pmod(s["l"] + F.pmod(f, a), a)).otherwise(s["l"]).alias("l"),
                        F.when(odd, s["r"]).otherwise(F.pmod(s["r"] + F.pmod(f, b), b)).alias("r"))

    out = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), init, step,
                      lambda s: F.concat(F.lpad(s["l"].cast("string"), u, "0"), F.lpad(s["r"].cast("string"), n - u, "0")))
    return out


def luhn_digit(payload: Column) -> Column:
    """The check digit of a payload of digits."""
    ds = F.reverse(F.filter(F.split(payload, ""), lambda c: c != ""))
    total = F.aggregate(F.transform(ds, lambda c, i: F.when(i % 2 == 1, c.cast("int")).otherwise(
        c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0))), F.lit(0), lambda x, y: x + y)
    return F.pmod(10 - F.pmod(total, F.lit(10)), F.lit(10)).cast("string")


def _fill(shape: Column, digits: Column) -> Column:
    """shape with its digits replaced in order."""
    init = F.struct(F.lit("").alias("out"), F.lit(1).alias("i"))
    return F.aggregate(
        F.split(shape, ""), init,
        lambda s, c: F.when(c.rlike("[0-9]"), F.struct(F.concat(s["out"], F.substring(digits, s["i"], F.lit(1))).alias("out"),
                                                       (s["i"] + 1).alias("i")))
        .otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["i"].alias("i"))), lambda s: s["out"])


def _card(m: Column, key: str) -> Column:
    d = _digits(m)
    payload = F.substring(d, F.lit(1), F.length(d) - 1)
    new = permute_digits(payload, "card", key)
    return F.when(luhn_digit(payload) == F.right(d, F.lit(1)), _fill(m, F.concat(new, luhn_digit(new))))


def _let(x: Column, f) -> Column:
    """f(x) with x computed once."""
    return F.element_at(F.transform(F.array(x), f), 1)


def _run(run: Column, key: str) -> Column:
    """struct(text, n) of one run of digit groups: the whole where it is a card, else every card that
    neighbouring groups make up. Groups of four to six digits or one group alone, beginning as cards
    do, go before other spellings that overlap them; among those the longest from the left."""
    groups, gaps = F.regexp_extract_all(run, F.lit("[0-9]+"), F.lit(0)), F.split(run, "[0-9]+", -1)
    n_digits = F.length(_digits(run))

    def search(parts):
        size = F.size(parts)

        def from_group(p, i):
            def grow(s, q):
                here = F.concat(s["text"], F.when(s["text"] == "", "").otherwise(q["gap"]), q["group"])
                count = s["n"] + F.length(q["group"])
                whole = F.when(count.between(13, 19), _card_ok(_digits(here)))
                return F.struct(here.alias("text"), count.alias("n"), (s["k"] + 1).alias("k"),
                                F.when(whole, s["k"] + 1).otherwise(s["best"]).alias("best"),
                                F.when(whole, here).otherwise(s["found"]).alias("found"))
            zero = F.struct(F.lit("").alias("text"), F.lit(0).alias("n"), F.lit(0).alias("k"), F.lit(0).alias("best"), F.lit("").alias("found"))
            return F.aggregate(F.slice(parts, i + 1, F.lit(19)), zero, grow,
                               lambda s: F.struct(s["best"].alias("k"), s["found"].alias("text"), s["found"].rlike(CARD_SHAPE).alias("shaped")))

        def choose(found):
            def walk(s, i):
                c = F.get(found, i)
                rival = F.exists(F.slice(found, i + 2, F.greatest(c["k"] - 1, F.lit(0))), lambda x: x["shaped"])
                take = (i >= s["next"]) & (c["k"] > 0) & (c["shaped"] | ~rival)
                return F.struct(F.when(take, i + c["k"]).otherwise(s["next"]).alias("next"),
                                F.when(take, F.concat(s["at"], F.array(i))).otherwise(s["at"]).alias("at"))
            zero = F.struct(F.lit(0).alias("next"), F.array().cast("array<int>").alias("at"))
            return F.aggregate(F.sequence(F.lit(0), size - 1), zero, walk, lambda s: _let(s["at"], lambda at: F.struct(
                F.array_join(F.transform(F.concat(at, F.array(size)), lambda a, j: F.concat(
                    _joined(parts, F.when(j == 0, 0).otherwise(F.get(at, j - 1) + F.get(found, F.get(at, j - 1))["k"]), a),
                    F.when(a < size, F.concat(F.get(parts, a)["gap"], _card(F.get(found, a)["text"], key))).otherwise(""))), "").alias("text"),
                F.size(at).alias("n"))))
        return _let(F.transform(parts, from_group), choose)
    parts = F.transform(F.filter(F.arrays_zip(gaps.alias("gap"), groups.alias("group")), lambda x: x["group"].isNotNull()),
                        lambda x: F.struct(x["gap"].alias("gap"), x["group"].alias("group")))
    whole = F.when(n_digits.between(13, 19), _card(run, key))
    return (F.when(whole.isNotNull(), F.struct(whole.alias("text"), F.lit(1).alias("n")))
            .when((n_digits < 13) | ~run.rlike("[ -]"), F.struct(run.alias("text"), F.lit(0).alias("n")))
            .otherwise(_let(parts, search)))


#: Cards as they are printed: groups of four to six digits (the last may be shorter) or one group, from 2 to 6.
CARD_SHAPE = r"^[2-6](?:[0-9]{12,18}|[0-9]{3}(?:[ -][0-9]{4}){2}[ -][0-9]{1,4}(?:[ -][0-9]{1,3})?|[0-9]{3}[ -][0-9]{6}[ -][0-9]{4,5})$"


def _card_ok(d: Column) -> Column:
    return luhn_digit(F.substring(d, F.lit(1), F.length(d) - 1)) == F.right(d, F.lit(1))


def _joined(parts: Column, a: Column, b: Column) -> Column:
    """The text of the groups a .. b-1, each after its gap."""
    return F.array_join(F.transform(F.slice(parts, a + 1, F.greatest(b - a, F.lit(0))), lambda x: F.concat(x["gap"], x["group"])), "")


def _runs(m: Column, key: str) -> Column:
    """struct(text, n): a match with the cards in its digit runs replaced; NULL where there is none."""
    runs = F.transform(F.regexp_extract_all(m, F.lit(RUN), F.lit(0)), lambda r: _run(r, key))
    out = _let(runs, lambda rs: F.struct(
        F.array_join(F.transform(F.arrays_zip(F.split(m, RUN, -1).alias("gap"), rs.alias("r")),
                                 lambda z: F.concat(z["gap"], F.coalesce(z["r"]["text"], F.lit("")))), "").alias("text"),
        F.aggregate(rs, F.lit(0), lambda x, r: x + r["n"]).alias("n")))
    return _let(out, lambda o: F.when(o["n"] > 0, o))


def _phone(m: Column, key: str) -> Column:
    d = _digits(m)
    code = F.when(m.rlike(r"^\+[0-9]{1,3} \([0-9]{3}\) [0-9]{3}-[0-9]{4}$") | ~m.startswith("+"), F.length(d) - 10) \
        .when(d.rlike(SHORT_CODES), F.when(d.rlike("^[17]"), 1).otherwise(2)).otherwise(3)
    return _let(code, lambda c: _fill(m, F.concat(F.substring(d, F.lit(1), c), permute_digits(F.substring(d, c + 1, F.length(d)), "phone", key))))


def _mod97(x: Column) -> Column:
    """Remainder of an IBAN's characters, letters as 10 to 35."""
    def step(r, c):
        v = F.ascii(c)
        return F.when(v >= 65, F.pmod(r * 100 + v - 55, F.lit(97))).otherwise(F.pmod(r * 10 + v - 48, F.lit(97)))
    return F.aggregate(F.filter(F.split(x, ""), lambda c: c != ""), F.lit(0), step)


def _iban(m: Column, key: str) -> Column:
    x = F.replace(m, F.lit(" "), F.lit(""))
    bban, country = F.substring(x, F.lit(5), F.length(x)), F.substring(x, 1, 2)
    ok = F.length(x).between(15, 34) & (F.length(_digits(bban)) >= 2) & (_mod97(F.concat(bban, F.substring(x, 1, 4))) == 1)

    def made(new):
        check = F.lpad((98 - _mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
        return _fill(m, F.concat(check, _digits(new)))
    return F.when(ok, _let(_fill(bban, permute_digits(_digits(bban), "iban", key)), made))


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.substring(m, i, n).cast("long") for i, n in ((1, 3), (5, 2), (8, 4)))
    ok = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    i = ((area - F.when(area > 666, 2).otherwise(1)) * 99 + group - 1) * 9999 + serial - 1
    p = feistel(i, F.lit(SSN_FACTORS[0]).cast("long"), F.lit(SSN_FACTORS[1]).cast("long"), F.lit("ssn"), key)
    s, ag = F.pmod(p, F.lit(9999)), _div(p, F.lit(9999))
    a, g = _div(ag, F.lit(99)) + 1, F.pmod(ag, F.lit(99)) + 1
    a = a + F.when(a >= 666, 1).otherwise(0)
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    return F.when(ok, F.concat_ws("-", pad(a, 3), pad(g, 2), pad(s + 1, 4)))


def _ip(m: Column, key: str) -> Column:
    q = F.transform(F.split(m, r"\."), lambda x: x.cast("long"))
    i = F.aggregate(q, F.lit(0).cast("long"), lambda x, y: x * 256 + y)
    p = feistel(i, F.lit(65536).cast("long"), F.lit(65536).cast("long"), F.lit("ip"), key)
    parts = [F.pmod(F.shiftright(p, n), F.lit(256)).cast("string") for n in (24, 16, 8, 0)]
    return F.when(F.forall(q, lambda x: x <= 255), F.concat_ws(".", *parts))


def _date(m: Column, key: str) -> Column:
    first, second = F.substring(m, 1, 2), F.substring(m, 4, 2)
    iso, us = F.substring(m, 5, 1).isin("-", "/"), (F.substring(m, 3, 1) == "/") & (second.cast("int") > 12)
    year, span = F.substring(m, 7, 4), DAY_FACTORS[0] * DAY_FACTORS[1]
    norm = F.when(iso, F.replace(m, F.lit("/"), F.lit("-"))).when(us, F.concat_ws("-", year, first, second)).otherwise(F.concat_ws("-", year, second, first))
    origin = F.lit("1900-01-01").cast("date")
    day = F.datediff(F.try_to_timestamp(norm, F.lit("yyyy-MM-dd")).cast("date"), origin).cast("long")
    date_of = lambda d: F.date_add(origin, d.cast("int"))
    permuted = lambda d: feistel(d, F.lit(DAY_FACTORS[0]).cast("long"), F.lit(DAY_FACTORS[1]).cast("long"), F.lit("date"), key)
    # days of the month above 12 go to such days and others to others, so that mm/dd is told from dd/mm: on along the cycle
    late = lambda d: F.dayofmonth(date_of(d)) > 12
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), permuted(day),
                         lambda d, _: F.when(late(d) == late(day), d).otherwise(permuted(d)))

    def shown(p):
        out, sep = F.date_format(date_of(p), "yyyy-MM-dd"), F.substring(m, 3, 1)
        y, mm, dd = F.substring(out, 1, 4), F.substring(out, 6, 2), F.substring(out, 9, 2)
        return F.when(iso, F.replace(out, F.lit("-"), F.substring(m, 5, 1))).when(us, F.concat(mm, sep, dd, sep, y)).otherwise(F.concat(dd, sep, mm, sep, y))
    return F.when(day.between(0, span - 1), _let(walked, shown))


def _email(m: Column, key: str) -> Column:
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(m)), 256)
    return F.concat(F.lit("u"), F.substring(digest, 1, 16), F.lit("@"), F.substring_index(m, "@", -1))


def kind_of(m: Column) -> Column:
    """The format of one match of ANY."""
    return (F.when(m.contains("@"), "email").when(m.startswith("+") | m.contains("("), "phone")
            .when(m.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"), "ip")
            .when(m.rlike(r"^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}([./])[0-9]{2}\2[0-9]{4})$"), "date")
            .when(m.rlike(r"^(1[.-])?[0-9]{3}([.-])[0-9]{3}\2[0-9]{4}$"), "phone")
            .when(m.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn").when(m.rlike("^[A-Z]"), "iban").otherwise("card"))


def pseudonym(m: Column, key: str) -> Column:
    """struct(kind, new, n) of one match: n values replaced; new is NULL where the format's check fails."""
    def one(kind):
        return lambda new: F.struct(F.lit(kind).alias("kind"), new.alias("new"), F.when(new.isNotNull(), 1).otherwise(0).alias("n"))
    cards = lambda: _let(_runs(m, key), lambda r: F.struct(
        F.lit("card").alias("kind"), r["text"].alias("new"), F.coalesce(r["n"], F.lit(0)).alias("n")))
    k = kind_of(m)
    out = F.when(k == "email", _let(_email(m, key), one("email")))
    for kind, f in (("phone", _phone), ("ip", _ip), ("date", _date), ("ssn", _ssn)):
        out = out.when(k == kind, _let(f(m, key), one(kind)))
    iban = _let(F.when(k == "iban", _iban(m, key)), lambda x: F.when(x.isNotNull(), one("iban")(x)).otherwise(cards()))
    return out.otherwise(iban)


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """One row a document: doc_id, text with pseudonyms, and how many were replaced by kind."""
    t = F.col("text")
    hit = F.regexp_like(t, F.lit(ANY))
    found = docs.select("doc_id", "text", F.when(hit, F.regexp_extract_all(t, F.lit(ANY), F.lit(0))).alias("m"))
    named = found.select("doc_id", "text", "m", F.transform("m", lambda m: pseudonym(m, key)).alias("p"))
    parts = F.arrays_zip(F.split(t, ANY, -1).alias("gap"), F.col("m"), F.col("p"))
    text = F.when(F.col("p").isNull(), t).otherwise(F.array_join(F.transform(parts, lambda z: F.concat(
        z["gap"], F.coalesce(z["p"]["new"], z["m"], F.lit("")))), ""))
    return named.select("doc_id", text.alias("text"), *[_replaced(k).alias(f"n_{k}") for k in PATTERNS])


def _replaced(kind: str) -> Column:
    """How many values of a kind were replaced."""
    done = F.aggregate("p", F.lit(0), lambda s, x: s + F.when(x["kind"] == kind, x["n"]).otherwise(0))
    return F.when(F.col("p").isNull(), F.lit(0)).otherwise(done).cast("long")
