"""Format-preserving pseudonyms for personal numbers and dates, in DataFrame expressions only.

Validated values are permuted within their format by a keyed Feistel network over a
product of two residue rings, which is a bijection of exactly the valid values: equal
values get equal pseudonyms in every document, different values stay different, and a
card number keeps a valid check digit, a date stays a date. E-mail names get a keyed
name instead. The key is a parameter; whoever has it can undo the permutations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table

ROUNDS = 8

#: fixed values: what each kind looks like (Java regular expressions)
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}"
IP = rf"(?<![\d.]){OCTET}(?:\.{OCTET}){{3}}(?!\.?\d)"
DATE_ISO = r"(?<![\d/.-])\d{4}-\d{1,2}-\d{1,2}(?![\d/-])"
DATE_YEAR = r"(?<![\d/.-])\d{4}/\d{1,2}/\d{1,2}(?![\d/-])"
DATE_SLASH = r"(?<![\d/.-])\d{1,2}/\d{1,2}/\d{4}(?![\d/-])"
DATE_DOT = r"(?<![\d/.-])\d{1,2}\.\d{1,2}\.\d{4}(?![\d/-])"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
PHONE = (r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[ .-]\d{4}(?!\d)"
         r"|(?<![\w+])(?<!\d[ -])[2-9]\d{2} [2-9]\d{2} \d{4}(?![ -]?\d)"
         r"|(?<![\w+])\+\d{1,3}[ .-]?\d{3}[ .-]?\d{3}[ .-]?\d{4}(?!\d)")
#: other plans: a plus sign and 8 to 15 digits
PHONE_ABROAD = r"(?<![\w+])\+[1-9](?:[ .()-]{0,2}\d){7,14}(?!\d)"
#: country codes of one and two digits; the others have three
COUNTRY = r"^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
#: groups of digits, at least 13 in all, that may hold card numbers between other digits
RUN = r"(?<!\d)(?<!\d[.-])(?=\d(?:[ -]?\d){12})\d++(?!\.\d)(?:[ -]\d++(?!\.\d))*+"
ANY = "|".join((EMAIL, IP, DATE_ISO, DATE_YEAR, DATE_SLASH, DATE_DOT, SSN, PHONE, PHONE_ABROAD))

#: fixed values: days from 1800-01-01 to 2199-12-31, one Gregorian cycle, as a product
DATE_A, DATE_B, DATE_FIRST = 189, 773, "1800-01-01"
#: fixed values: valid social security numbers: areas 1-899 without 666, groups 1-99, serials 1-9999
SSN_A, SSN_B = 898 * 99, 9999
#: fixed values: numbers whose area and exchange begin with 2-9: 800 * 800 * 10,000
PHONE_RING = 80_000
IP_RING = 65_536


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _prf(key: Column, tag: str, n: Column, value: Column, modulus: Column) -> Column:
    """A keyed pseudo-random number below ``modulus``: 60 bits of SHA-256."""
    inner = F.sha2(F.concat(key, F.lit(f"|{tag}|"), n.cast("string"), F.lit("|"), value.cast("string")).cast("binary"), 256)
    outer = F.sha2(F.concat(key, F.lit("|"), inner).cast("binary"), 256)
    return F.conv(F.substring(outer, 1, 15), 16, 10).cast("long") % modulus


def feistel(rank: Column, a: Column, b: Column, key: Column, tag: str, rounds: int = ROUNDS) -> Column:
    """The keyed permutation of 0 .. a * b - 1; ``rounds`` is even."""
    start = F.struct(F.floor(rank / b).cast("long").alias("l"), (rank % b).cast("long").alias("r"))
    # rank is below 2**53 in every use, so the quotient floors right
    return _let(_network(start, a, b, key, tag, rounds), lambda acc: acc["l"] * b + acc["r"])


def _network(start: Column, a: Column, b: Column, key: Column, tag: str, rounds: int = ROUNDS) -> Column:
    """The rounds on a struct (l below a, r below b); the rings change sides in every round."""
    def step(acc: Column, n: Column) -> Column:
        ring = F.when(n % 2 == 1, a).otherwise(b)
        return F.struct(acc["r"].alias("l"), ((acc["l"] + _prf(key, tag, n, acc["r"], ring)) % ring).alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step)


def digits_of(s: Column) -> Column:
    return F.regexp_replace(s, r"\D", "")


def _refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, in order, by ``digits``."""
    begin = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def step(acc: Column, c: Column) -> Column:
        is_digit = c.between("0", "9")
        return F.struct(F.concat(acc["out"], F.when(is_digit, F.substr(digits, acc["at"], F.lit(1))).otherwise(c)).alias("out"),
                        (acc["at"] + is_digit.cast("int")).alias("at"))
    return F.aggregate(F.split(shape, ""), begin, step, lambda acc: acc["out"])


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """The Luhn sum; the digit at distance ``doubled`` (0 or 1) from the end is the first that is doubled."""
    def step(acc: Column, x: Column) -> Column:
        two = x["d"] * 2
        return acc + F.when(x["k"] % 2 == doubled, F.when(two > 9, two - 9).otherwise(two)).otherwise(x["d"])
    back = F.transform(F.split(F.reverse(digits), ""), lambda c, k: F.struct(c.cast("int").alias("d"), k.alias("k")))
    return F.aggregate(back, F.lit(0), step)


def luhn_valid(digits: Column) -> Column:
    return _luhn_sum(digits, 1) % 10 == 0


def _card(m: Column, key: Column) -> Column:
    """A valid card number: first digit kept, the others permuted, check digit made valid again."""
    def permuted(d: Column) -> Column:
        n = F.length(d) - 2
        half = F.floor(n / 2).cast("int")
        a, b = F.pow(F.lit(10.0), n - half).cast("long"), F.pow(F.lit(10.0), half).cast("long")
        # two halves go through the network as one pair, so 17 digits fit into long arithmetic
        left, right = F.substr(d, F.lit(2), n - half).cast("long"), F.substr(d, n - half + 2, half).cast("long")
        new = _network(F.struct(left.alias("l"), right.alias("r")), a, b, key, "card")
        body = _let(new, lambda x: F.concat(F.substr(d, F.lit(1), F.lit(1)),
                                            F.lpad(x["l"].cast("string"), n - half, F.lit("0")),
                                            F.lpad(x["r"].cast("string"), half, F.lit("0"))))
        return _let(body, lambda x: F.concat(x, ((10 - _luhn_sum(x, 0) % 10) % 10).cast("string")))
    return _let(digits_of(m), lambda d: _refill(m, permuted(d)))


def _cards(run: Column, key: Column) -> Column:
    """(text, n) of a match of :data:`RUN`: valid numbers of 13 to 19 digits in whole groups are replaced.

    Of overlapping ones the longest counts, then the first.
    """
    def span(parts: Column, i: Column, n: Column) -> Column:
        """The text of ``n`` groups from group ``i`` on; groups and separators alternate."""
        return F.array_join(F.slice(parts, 2 * i + 1, 2 * n - 1), "")

    def longest(parts: Column, i: Column, k: Column) -> Column:
        """(groups, digits) of the longest valid number that begins with group ``i``."""
        sizes = F.transform(F.sequence(F.least(k - i, F.lit(19)), F.lit(1), F.lit(-1)), lambda n: F.struct(
            n.alias("n"), digits_of(span(parts, i, n)).alias("d")))
        good = F.filter(sizes, lambda x: F.when(F.length(x["d"]).between(13, 19), luhn_valid(x["d"])).otherwise(False))
        return _let(F.get(good, F.lit(0)), lambda x: F.struct(F.coalesce(x["n"], F.lit(0)).alias("n"),
                                                              F.coalesce(F.length(x["d"]), F.lit(0)).alias("len")))

    def scan(z: Column) -> Column:
        parts, best = z["parts"], z["best"]

        def step(acc: Column, i: Column) -> Column:
            own = F.get(best, i)
            longer = F.exists(F.slice(best, i + 2, F.greatest(own["n"] - 1, F.lit(0))), lambda x: x["len"] > own["len"])
            gap = F.coalesce(F.get(parts, 2 * i - 1), F.lit(""))
            take = (own["n"] > 0) & ~longer
            return (F.when(i < acc["next"], acc)
                    .when(take, F.struct(F.concat(acc["text"], gap, _card(span(parts, i, own["n"]), key)).alias("text"),
                                         (i + own["n"]).alias("next"), (acc["n"] + 1).alias("n")))
                    .otherwise(F.struct(F.concat(acc["text"], gap, F.get(parts, 2 * i)).alias("text"),
                                        (i + 1).alias("next"), acc["n"].alias("n"))))
        begin = F.struct(F.lit("").alias("text"), F.lit(0).alias("next"), F.lit(0).alias("n"))
        return F.aggregate(F.sequence(F.lit(0), F.size(best) - 1), begin, step,
                           lambda acc: F.struct(acc["text"].alias("text"), acc["n"].alias("n")))
    parts = F.regexp_extract_all(run, F.lit(r"\d+|[ -]"), F.lit(0))
    return _let(parts, lambda p: _let((F.size(p) + 1).cast("int"), lambda k2: _let(
        F.struct(p.alias("parts"), F.transform(F.sequence(F.lit(0), F.floor(k2 / 2).cast("int") - 1),
                                               lambda i: longest(p, i, F.floor(k2 / 2).cast("int"))).alias("best")), scan)))


def _cards_between(piece: Column, key: Column) -> Column:
    """(text, n): ``piece`` with its card numbers replaced, and how many there were."""
    runs = F.transform(F.regexp_extract_all(piece, F.lit(RUN), F.lit(0)), lambda r: _cards(r, key))
    return _let(runs, lambda new: F.struct(
        F.array_join(F.flatten(F.zip_with(F.split(piece, RUN), F.concat(F.transform(new, lambda x: x["text"]), F.array(F.lit(""))),
                                          lambda p, m: F.array(p, m))), "").alias("text"),
        F.aggregate(new, F.lit(0), lambda acc, x: acc + x["n"]).alias("n")))


def _phone(m: Column, key: Column) -> Column:
    def number(d: Column) -> Column:
        own = F.right(d, F.lit(10))
        area, office, line = (F.substring(own, p, n).cast("long") for p, n in ((1, 3), (4, 3), (7, 4)))
        valid = (area >= 200) & (office >= 200)
        rank = F.when(valid, ((area - 200) * 800 + office - 200) * 10000 + line).otherwise(own.cast("long"))
        ring = F.when(valid, F.lit(PHONE_RING)).otherwise(F.lit(100_000)).cast("long")

        def back(x: Column) -> Column:
            # a number outside the plan is permuted among all ten-digit strings
            area2, office2 = F.floor(x / 8_000_000) + 200, F.floor(x / 10_000) % 800 + 200
            return F.when(valid, F.concat(area2.cast("string"), office2.cast("string"),
                                          F.lpad((x % 10_000).cast("string"), 4, "0"))).otherwise(
                F.lpad(x.cast("string"), 10, "0"))
        new = _let(feistel(rank, ring, ring, key, "phone"), back)
        return F.concat(F.substr(d, F.lit(1), F.length(d) - 10), new)
    return _refill(m, _let(digits_of(m), number))


def _phone_abroad(m: Column, key: Column) -> Column:
    """The country code kept, the rest permuted among the strings of its length."""
    def number(d: Column) -> Column:
        code = F.regexp_extract(d, COUNTRY, 0)
        own = F.substr(d, F.length(code) + 1, F.length(d))
        n = F.length(own)
        half = F.floor(n / 2).cast("int")
        a, b = F.pow(F.lit(10.0), n - half).cast("long"), F.pow(F.lit(10.0), half).cast("long")
        pair = F.struct(F.substr(own, F.lit(1), n - half).cast("long").alias("l"),
                        F.substr(own, n - half + 1, half).cast("long").alias("r"))
        return _let(_network(pair, a, b, key, "abroad"), lambda x: F.concat(
            code, F.lpad(x["l"].cast("string"), n - half, F.lit("0")), F.lpad(x["r"].cast("string"), half, F.lit("0"))))

    def ten(d: Column) -> Column:
        return F.length(d) - F.length(F.regexp_extract(d, COUNTRY, 0)) == 10
    # ten digits after the country code are one number however they are grouped
    return _let(digits_of(m), lambda d: F.when(ten(d), _phone(m, key)).otherwise(_refill(m, number(d))))


def _ip(m: Column, key: Column) -> Column:
    part = F.split(m, r"\.")
    rank = sum((F.get(part, F.lit(k)).cast("long") * (256 ** (3 - k)) for k in range(4)), F.lit(0).cast("long"))
    ring = F.lit(IP_RING).cast("long")
    return _let(feistel(rank, ring, ring, key, "ip"),
                lambda x: F.concat_ws(".", *[(F.floor(x / (256 ** (3 - k))) % 256).cast("long").cast("string") for k in range(4)]))


def _ssn(m: Column, key: Column) -> Column:
    area, group, serial = (F.substring(m, p, n).cast("long") for p, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area.between(1, 899)) & (area != 666) & (group > 0) & (serial > 0)
    rank = ((area - F.when(area > 666, 2).otherwise(1)) * 99 + group - 1) * SSN_B + serial - 1

    def back(x: Column) -> Column:
        a = F.floor(x / (99 * SSN_B))
        return F.concat_ws("-", F.lpad((a + F.when(a >= 665, 2).otherwise(1)).cast("string"), 3, "0"),
                           F.lpad((F.floor(x / SSN_B) % 99 + 1).cast("string"), 2, "0"),
                           F.lpad((x % SSN_B + 1).cast("string"), 4, "0"))
    new = _let(feistel(rank, F.lit(SSN_A).cast("long"), F.lit(SSN_B).cast("long"), key, "ssn"), back)
    return F.when(valid, new).otherwise(m)


def _date(m: Column, form: str, key: Column) -> Column:
    day = F.try_to_date(m, form)
    rank = F.datediff(day, F.lit(DATE_FIRST).cast("date")).cast("long")
    new = feistel(rank, F.lit(DATE_A).cast("long"), F.lit(DATE_B).cast("long"), key, "date")
    ok = day.isNotNull() & (F.date_format(day, form) == m) & rank.between(0, DATE_A * DATE_B - 1)
    return F.when(ok, F.date_format(F.date_add(F.lit(DATE_FIRST).cast("date"), new.cast("int")), form)).otherwise(m)


def _padded_date(m: Column, forms: tuple[str, ...], key: Column) -> Column:
    """The first of ``forms`` that fits; a day or month of one digit is read, and written, without leading zeros."""
    full = F.regexp_replace(m, r"(?<!\d)(\d)(?!\d)", "0$1")
    new = _date(full, forms[-1], key)
    for form in forms[-2::-1]:
        new = F.when(_date(full, form, key) != full, _date(full, form, key)).otherwise(new)
    return F.when(full == m, new).when(new == full, m).otherwise(F.regexp_replace(new, r"(?<!\d)0(\d)(?!\d)", "$1"))


def _email(m: Column, key: Column) -> Column:
    return F.concat(F.lit("u"), F.substring(F.sha2(F.concat(key, F.lit("|email|"), F.lower(m)).cast("binary"), 256), 1, 16),
                    F.lit("@example.invalid"))


def pseudonym(m: Column, key: Column) -> Column:
    """The pseudonym of one match of :data:`ANY`; what is not valid stays as it is."""
    return (F.when(F.contains(m, F.lit("@")), _email(m, key))
            .when(m.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"), _ip(m, key))
            .when(m.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), _padded_date(m, ("yyyy-MM-dd",), key))
            .when(m.rlike(r"^\d{4}/\d{1,2}/\d{1,2}$"), _padded_date(m, ("yyyy/MM/dd",), key))
            .when(m.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), _padded_date(m, ("dd/MM/yyyy", "MM/dd/yyyy"), key))
            .when(m.rlike(r"^\d{1,2}\.\d{1,2}\.\d{4}$"), _padded_date(m, ("dd.MM.yyyy",), key))
            .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), _ssn(m, key))
            .when(m.rlike(rf"^(?!(?:{PHONE})$)\+"), _phone_abroad(m, key))
            .otherwise(_phone(m, key)))


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the personal values in ``text_col`` replaced, and ``n_replaced`` added.

    E-mail addresses, IPv4 addresses, dates (yyyy-MM-dd, yyyy/MM/dd, dd/MM/yyyy, MM/dd/yyyy,
    dd.MM.yyyy in 1800 to 2199, days and months also of one digit), US social security
    numbers, telephone numbers of ten digits with or without a country code (grouped by
    spaces alone only inside the numbering plan), others of 8 to 15 digits with a plus sign, and card numbers of 13 to 19 digits with a valid check
    digit, also between other groups of digits. Values that fail their validation stay.
    Not looked for, as too many other numbers look like them: ten or nine digits in a row,
    social security numbers grouped by spaces, years of two digits, dates with month names,
    IBANs and IPv6 addresses.

    All other columns pass through; repeated rows get the same text. Null text stays
    null with 0 replaced, an empty table gives an empty result. ``n_replaced`` must not
    be a column yet.
    """
    if "n_replaced" in docs.columns:
        raise ValueError("docs has a column n_replaced")
    k = F.lit(key)
    text = F.col(f"`{text_col}`")
    found = F.when(text.rlike(r"[0-9@]"), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    others = [F.col(f"`{c}`") for c in docs.columns]
    staged = docs.select(F.struct(*others).alias("row"), found.alias("found"), text.rlike(RUN).alias("runs"))
    old = F.col("row")[text_col]
    hit = (F.size("found") > 0) | F.col("runs")
    staged = staged.select("row", "found", F.when(hit, F.transform("found", lambda m: pseudonym(m, k))).alias("new"),
                           F.when(hit, F.split(old, ANY)).alias("rest"), "runs")
    staged = staged.select("row", "found", "new", F.when(F.col("runs"), F.transform("rest", lambda p: _cards_between(p, k)))
                           .otherwise(F.transform("rest", lambda p: F.struct(p.alias("text"), F.lit(0).alias("n")))).alias("rest"))
    joined = F.array_join(F.flatten(F.zip_with("rest", F.concat("new", F.array(F.lit(""))), lambda p, m: F.array(p["text"], m))), "")
    n = (F.size(F.filter(F.arrays_zip("found", "new"), lambda x: x["found"] != x["new"]))
         + F.aggregate("rest", F.lit(0), lambda acc, p: acc + p["n"]))
    return staged.select(*[F.when(F.col("new").isNull(), old).otherwise(joined).alias(c) if c == text_col
                           else F.col("row")[c].alias(c) for c in docs.columns],
                         F.when(F.col("new").isNull(), 0).otherwise(n).cast("long").alias("n_replaced"))


def op8_feistel_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its pseudonymised text; the key here is a fixed demonstration key."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs, key="demonstration key, not a secret").select("doc_id", "n_replaced", "text")
