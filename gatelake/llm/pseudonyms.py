"""Format-preserving pseudonyms for personal numbers, dates and addresses.

Recognised values are replaced by a keyed Feistel permutation within their own
format, so equal values stay equal across documents and no table is kept. The
network works on lists of small numbers with a modulus each (digits, letters,
octets, parts of a day number): halves are added to in turn, by hash values of
the other half, element by element modulo its base.

A value is replaced only if it is valid for its kind, and by a valid one:

* ``card``: 13 to 19 digits that end in their Luhn digit; all but the last are
  permuted, the last is the new Luhn digit;
* ``date``: valid dates (``2001-02-03``, ``03.02.2001``, ``02/03/2001``) of the
  400 years from 1800, 146,097 days = 189 x 773, map to valid dates;
* ``ip``: four octets up to 255;  ``id`` (``123-45-6789``): area 001 to 899 but 666,
  group and serial not zero;  ``phone``: ten digits with a country code or brackets, else
  only if area and exchange start with 2 to 9, which they then keep to; the country
  code stays;  ``email``: letters and digits of the local part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatelake.llm.common import bind, free_names

ROUNDS = 8
KINDS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}",
    "phone": r"(?:\+1[ .-]?)?\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|\+1[ .-]?\d{3}[ .-]\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4}",
    "date": r"\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4}",
    "ip": r"(?<!\d\.)\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.\d)",
    "id": r"\d{3}-\d{2}-\d{4}",
    "card": r"\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5}",
}
_EDGE = r"(?<![A-Za-z0-9])", r"(?![A-Za-z0-9])"
ANY = f"(?:(?<![A-Za-z0-9]){KINDS['email']}|{_EDGE[0]}(?:" + "|".join(v for k, v in KINDS.items() if k != "email") + f"){_EDGE[1]})"


def permute(values: Column, bases: Column, key: str, tweak: str) -> Column:
    """Feistel permutation of ``values`` (each below its base) under ``key``; bijective for every list of bases."""
    def network(v: Column, b: Column, half: Column) -> Column:
        def turn(acc: Column, r: Column) -> Column:
            front = (r % 2) == 0
            seen = F.when(front, F.slice(acc, half + 1, F.size(acc) - half)).otherwise(F.slice(acc, 1, half))
            text = F.concat_ws("|", F.lit(key), F.lit(tweak), r.cast("string"), F.size(acc).cast("string"), F.array_join(seen, ","))

            def add(h: Column) -> Column:
                def one(x: Column, i: Column) -> Column:
                    part = F.conv(F.substring(h, (i % 16) * 4 + 1, F.lit(4)), 16, 10).cast("int")
                    return F.when((i < half) == front, F.pmod(x + part, F.get(b, i))).otherwise(x)

                return F.transform(acc, one)

            return bind(F.sha2(text, 256), add)

        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), v, turn)

    return bind(values, lambda v: bind(bases, lambda b: bind(F.floor(F.size(v) / 2).cast("int"), lambda half: network(v, b, half))))


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def permute_text(s: Column, key: str, tweak: str) -> Column:
    """Letters and digits of ``s`` permuted within their own class; everything else stays in place."""

    def base_of(c: Column) -> Column:
        return F.when(c.rlike("^[0-9]$"), 10).when(c.rlike("^[A-Za-z]$"), 26).otherwise(1)

    def zero_of(c: Column) -> Column:
        return F.when(c.rlike("^[0-9]$"), 48).when(c.rlike("^[a-z]$"), 97).when(c.rlike("^[A-Z]$"), 65).otherwise(0)

    def one(chars: Column) -> Column:
        """A single character is two digits of its number, so that the network has two halves."""
        c = F.get(chars, 0)
        n, part = (F.ascii(c) - zero_of(c)).cast("int"), F.floor(base_of(c) / 2).cast("int")
        pair = permute(F.array(F.floor(n / part).cast("int"), n % part), F.array(F.lit(2), part), key, tweak)
        return F.when(zero_of(c) > 0, bind(pair, lambda m: F.chr((F.get(m, 0) * part + F.get(m, 1) + zero_of(c)).cast("bigint")))).otherwise(c)

    def run(chars: Column) -> Column:
        values = F.transform(chars, lambda c: F.when(zero_of(c) > 0, F.ascii(c) - zero_of(c)).otherwise(0).cast("int"))
        bases = F.transform(chars, lambda c: base_of(c).cast("int"))
        back = lambda c, v: F.when(zero_of(c) > 0, F.chr((v + zero_of(c)).cast("bigint"))).otherwise(c)
        return F.array_join(F.zip_with(chars, permute(values, bases, key, tweak), back), "")

    return bind(_chars(s), lambda chars: F.when(F.size(chars) == 1, one(chars)).otherwise(run(chars)))


def _digits(s: Column) -> Column:
    return F.transform(_chars(F.regexp_replace(s, "[^0-9]", "")), lambda c: c.cast("int"))


def _filled(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced in turn."""

    def run(new: Column) -> Column:
        step = lambda acc, c: F.when(
            c.rlike("^[0-9]$"), F.struct((acc["i"] + 1).alias("i"), F.concat(acc["t"], F.get(new, acc["i"]).cast("string")).alias("t"))
        ).otherwise(F.struct(acc["i"].alias("i"), F.concat(acc["t"], c).alias("t")))
        return F.aggregate(_chars(shape), F.struct(F.lit(0).alias("i"), F.lit("").alias("t")), step, lambda acc: acc["t"])

    return bind(digits, run)


def luhn_digit(digits: Column) -> Column:
    """Check digit that follows ``digits``."""
    n = F.size(digits)
    doubled = F.transform(digits, lambda d, i: F.when((n - i) % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d))
    return F.pmod(-F.aggregate(doubled, F.lit(0), lambda a, d: a + d), F.lit(10))


def _luhn_valid(d: Column) -> Column:
    return F.element_at(d, -1) == luhn_digit(F.slice(d, 1, F.size(d) - 1))


def _card(s: Column, key: str) -> Column:
    def run(d: Column) -> Column:
        body = F.slice(d, 1, F.size(d) - 1)
        moved = permute(body, F.transform(body, lambda _: F.lit(10)), key, "card")
        last = lambda m: F.array(luhn_digit(m).cast("int"))
        return _filled(s, bind(moved, lambda m: F.concat(m, last(m))))

    return bind(_digits(s), run)


def _leads(i: Column) -> Column:
    """Places of ten digits where area and exchange start."""
    return (i == 0) | (i == 3)


def _phone_valid(s: Column) -> Column:
    return s.rlike(r"^(\+1|\()") | s.rlike(r"^[2-9]\d\d.[2-9]")


def _phone(s: Column, key: str) -> Column:
    """The last ten digits are permuted; the first of area and exchange stays in 2 to 9, or in 0 and 1."""

    def moved(tail: Column) -> Column:
        least = lambda i: F.when(_leads(i) & (F.get(tail, i) >= 2), 2).otherwise(0)
        bases = F.transform(tail, lambda x, i: F.when(~_leads(i), 10).when(x >= 2, 8).otherwise(2))
        values = F.transform(tail, lambda x, i: x - least(i))
        return bind(permute(values, bases, key, "phone"), lambda m: F.transform(m, lambda x, i: x + least(i)))

    def run(d: Column) -> Column:
        return _filled(s, F.concat(F.slice(d, 1, F.size(d) - 10), bind(F.slice(d, F.size(d) - 9, 10), moved)))

    return bind(_digits(s), run)


def _id_parts(s: Column) -> Column:
    """Area, group and serial of ``123-45-6789`` numbered from 0 among the valid ones; null if one is not valid."""
    area, group, serial = (x.try_cast("int") for x in (F.substring(s, 1, 3), F.substring(s, 5, 2), F.substring(s, 8, 4)))
    valid = (area >= 1) & (area <= 899) & (area != 666) & (group >= 1) & (serial >= 1)
    return F.when(valid, F.array(area - F.when(area > 666, 2).otherwise(1), group - 1, serial - 1))


def _id(s: Column, key: str) -> Column:
    def written(m: Column) -> Column:
        area = F.get(m, 0) + F.when(F.get(m, 0) >= 665, 2).otherwise(1)
        return F.format_string("%03d-%02d-%04d", area, F.get(m, 1) + 1, F.get(m, 2) + 1)

    return bind(permute(_id_parts(s), F.array(F.lit(898), F.lit(99), F.lit(9999)), key, "id"), written)


def _octets(s: Column) -> Column:
    return F.transform(F.split(s, "\\."), lambda o: o.cast("int"))


def _ip(s: Column, key: str) -> Column:
    o = _octets(s)
    return F.when(F.forall(o, lambda v: v <= 255), F.array_join(permute(o, F.transform(o, lambda _: F.lit(256)), key, "ip"), "."))


def _valid(y: Column, m: Column, d: Column) -> Column:
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    last = F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)
    return (y >= 1800) & (y < 2200) & (m >= 1) & (m <= 12) & (d >= 1) & (d <= last)


def _date_parts(s: Column) -> Column:
    """Year, month, day and layout of a valid date, else null. A slashed date is month first where that is valid."""
    n = lambda a, b: F.substring(s, a, b).try_cast("int")
    iso, dots = s.rlike("^\\d{4}-"), s.rlike("^\\d{2}\\.")
    y, a, b = F.when(iso, n(1, 4)).otherwise(n(7, 4)), F.when(iso, n(6, 2)).otherwise(n(1, 2)), F.when(iso, n(9, 2)).otherwise(n(4, 2))

    def run(p: Column) -> Column:
        y, a, b = (F.get(p, i) for i in range(3))
        as_is = lambda layout: F.array(y, a, b, F.lit(layout))
        swapped = lambda layout: F.array(y, b, a, F.lit(layout))
        ab, ba = _valid(y, a, b), _valid(y, b, a)
        return F.when(iso, F.when(ab, as_is(0))).when(dots, F.when(ba, swapped(1))).otherwise(F.when(ab, as_is(2)).when(ba, swapped(3)))

    return bind(F.array(y, a, b), run)


def _date(s: Column, key: str) -> Column:
    def run(p: Column) -> Column:
        zero = F.lit("1800-01-01").cast("date")
        day = F.datediff(F.make_date(F.get(p, 0), F.get(p, 1), F.get(p, 2)), zero)
        parts = bind(day, lambda n: F.array(F.floor(n / 773).cast("int"), (n % 773).cast("int")))
        moved = permute(parts, F.array(F.lit(189), F.lit(773)), key, "date")
        layout = F.get(p, 3)

        def written(d: Column) -> Column:
            text = F.when(layout == 0, F.date_format(d, "yyyy-MM-dd")).when(layout == 1, F.date_format(d, "dd.MM.yyyy"))
            return text.when(layout == 2, F.date_format(d, "MM/dd/yyyy")).otherwise(F.date_format(d, "dd/MM/yyyy"))

        return bind(bind(moved, lambda v: F.date_add(zero, F.get(v, 0) * 773 + F.get(v, 1))), written)

    return bind(_date_parts(s), lambda p: F.when(p.isNotNull(), run(p)))


def _email(s: Column, key: str) -> Column:
    return F.concat(permute_text(F.substring_index(s, "@", 1), key, "email"), F.lit("@"), F.substring_index(s, "@", -1))


def kind_of(s: Column) -> Column:
    """Kind of a matched value; null for one that fails its validation (it stays as it is)."""
    is_date = s.rlike(f"^(?:{KINDS['date']})$")
    is_ip = s.rlike(f"^(?:{KINDS['ip']})$")
    kind = F.when(F.contains(s, F.lit("@")), "email").when(s.rlike(f"^(?:{KINDS['phone']})$"), F.when(_phone_valid(s), "phone"))
    kind = kind.when(is_date, F.when(_date_parts(s).isNotNull(), "date"))
    kind = kind.when(is_ip, F.when(F.forall(_octets(s), lambda v: v <= 255), "ip"))
    kind = kind.when(s.rlike(f"^(?:{KINDS['id']})$"), F.when(_id_parts(s).isNotNull(), "id"))
    return kind.otherwise(bind(_digits(s), lambda d: F.when(_luhn_valid(d), "card")))


def pseudonym(s: Column, kind: Column, key: str) -> Column:
    """The replacement of a value of a known kind; the value itself where the kind is null."""
    out = F.when(kind == "email", _email(s, key)).when(kind == "phone", _phone(s, key)).when(kind == "date", _date(s, key))
    return F.coalesce(out.when(kind == "ip", _ip(s, key)).when(kind == "id", _id(s, key)).when(kind == "card", _card(s, key)), s)


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with the personal values of ``text`` replaced, and ``n_replaced`` and ``kinds`` (kind of each, in order).

    Null texts stay null with no values; everything outside the values is unchanged;
    repeated rows change alike. Columns named ``n_replaced`` or ``kinds`` are replaced,
    others may have any names. An empty table gives no rows.
    """
    held = free_names(docs, "_found")[0]
    t = F.col(text)
    found = F.when(t.rlike(ANY), F.regexp_extract_all(t, F.lit(ANY), F.lit(0)))
    base = docs.withColumn(held, found)
    gaps = F.split(t, ANY, -1)
    new = F.transform(held, lambda s: bind(kind_of(s), lambda k: pseudonym(s, k, key)))
    # gap, value, gap, value, ..., gap
    joined = F.array_join(F.zip_with(gaps, new, lambda g, v: F.concat(g, F.coalesce(v, F.lit("")))), "")
    kinds = F.filter(F.transform(held, kind_of), lambda k: k.isNotNull())
    out = base.withColumns({
        "kinds": F.coalesce(F.when(F.col(held).isNotNull(), kinds), F.array().cast("array<string>")),
        text: F.when(F.col(held).isNull(), t).otherwise(joined),
    })
    return out.withColumn("n_replaced", F.size("kinds").cast("bigint")).drop(held)
