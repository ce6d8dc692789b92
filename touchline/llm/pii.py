"""Keyed pseudonyms for personal data, in built-in functions only.

A value is found by its form and kept only if it is valid (check digit, ranges of its
parts). It is replaced by another valid value of the same form: a Feistel network permutes
all values of that form, and its round function is a hash with the key. A permutation maps
equal values to equal ones and different values to different ones, so records stay linked
across documents, and nothing has to be collected or joined for that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
DEFAULT_KEY = "touchline-pseudonyms"

#: Forms of what is looked for; which one a match is, is told by its shape.
#: An address is looked for from the start of its first part on, so a long run of letters is walked once; of a
#: domain, which stays, only so many parts matter.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){0,30}\.[A-Za-z]{2,}"
#: Ten digits with or without +1, and a plus with a country code and 7 to 15 digits in all.
PHONE = (r"\+1 \(\d{3}\) \d{3}-\d{4}(?!\d)|(?<![\d.-])[2-9]\d{2}-[2-9]\d{2}-\d{4}(?![\d-])"
         r"|(?<![\w.+-])(?:\+?1[ .-]?)?(?:\([2-9]\d{2}\) ?|[2-9]\d{2}[.-])[2-9]\d{2}[.-]\d{4}(?![\w-]|\.\d)"
         r"|(?<![\w+])\+[1-9](?:[ .-]?\(?\d\)?){6,14}(?!\w|[.-]\d)")
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
DATE = (r"(?<![\d-])\d{4}-\d{2}-\d{2}(?![\d-])|(?<![\d/])\d{2}/\d{2}/\d{4}(?![\d/])"
        r"|(?<![\w.])\d{2}\.\d{2}\.\d{4}(?!\w|\.\d)")
CARD = r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])"
IP = r"(?<![\w.-])(?:\d{1,3}\.){3}\d{1,3}(?![\w-]|\.\d)"
IBAN = r"(?<!\w)[A-Z]{2}\d{13,32}(?!\w)"
FORMS = "|".join([PHONE, SSN, DATE, IP, IBAN])
#: Where a card may start and end beside other numbers, and its written groupings; the longer form of a start apart.
EDGES = r"(?<![\w.]|[^\d]-|^-)", r"(?!\w|-(?!\d))"
GROUPED = [r"\d{13,19}|\d{4}([ -])(?:\d{4}\2\d{4}\2\d{4}|\d{6}\2\d{4,5}|\d{3}\2\d{3}\2\d{3})", r"\d{4}([ -])\d{4}\2\d{4}\2\d{4}\2\d{1,3}"]
#: An IBAN in groups of four with whatever groups of digits follow it.
PRINTED = r"(?<!\w)[A-Z]{2}\d{2}(?: \d{4}){2,7}(?: \d{1,4})?(?!\w)"
COUNTRY = r"^\+(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
#: Days 1800-01-01 to 2199-12-31: 400 years repeat, 146,097 days, 189 x 773.
FIRST_DAY, LAST_DAY, WEEKS, DAYS = "1800-01-01", "2199-12-31", 189, 773
#: Of these, 88,497 = 9 x 9,833 come after the twelfth of their month.
LATE_WEEKS, LATE_DAYS, FIRST_DAYS = 9, 9833, 12


def _noise(key: str, form: str, round_no: Column, other: Column) -> Column:
    """A number from 0 to 2^52 that the key, form, round and other half decide."""
    told = F.concat_ws("|", F.lit(key), F.lit(form), round_no.cast("string"), other.cast("string"))
    return F.conv(F.substring(F.sha2(told, 256), 1, 13), 16, 10).cast("long")


def feistel(left: Column, right: Column, left_size: Column, right_size: Column, key: str, form: str) -> Column:
    """Struct (l, r): the image of (left, right) under a keyed permutation of left_size x right_size.

    Rounds add noise of one half to the other, modulo its size; each can be undone.
    """
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    def step(s: Column, i: Column) -> Column:
        moved = F.pmod(s["l"] + F.pmod(_noise(key, form, i, s["r"]), left_size), left_size)
        return F.struct(
            F.when(i % 2 == 0, moved).otherwise(s["l"]).alias("l"),
            F.when(i % 2 == 0, s["r"]).otherwise(F.pmod(s["r"] + F.pmod(_noise(key, form, i, s["l"]), right_size), right_size)).alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _number(digits: Column) -> Column:
    return F.coalesce(F.expr("0L") + F.when(F.length(digits) > 0, digits).otherwise(F.lit("0")).cast("long"), F.lit(0).cast("long"))


def _padded(number: Column, width: Column | int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _power(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + F.lit(1), F.lit("0")).cast("long")


def permute_digits(digits: Column, key: str, form: str) -> Column:
    """A string of up to 36 digits to another of the same length."""
    def body(d: Column) -> Column:
        half = F.floor(F.length(d) / 2).cast("int")
        rest = F.length(d) - half
        image = feistel(_number(F.substring(d, F.lit(1), half)), _number(F.substring(d, half + F.lit(1), rest)),
                        _power(half), _power(rest), key, form)
        return let(image, lambda x: F.concat(F.when(half > 0, F.lpad(x["l"].cast("string"), half, F.lit("0"))).otherwise(F.lit("")),
                                             F.lpad(x["r"].cast("string"), rest, F.lit("0"))))
    return F.when(F.length(digits) > 0, let(digits, body)).otherwise(digits)


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a number whose last digit is the check digit."""
    places = F.split(F.reverse(digits), "")
    return F.aggregate(
        F.transform(F.filter(places, lambda d: d != ""), lambda d, i: let(d.cast("int") * F.when(i % 2 == 1, 2).otherwise(1), lambda x: F.when(x > 9, x - 9).otherwise(x))),
        F.lit(0), lambda a, b: a + b)


def _fill(shape: Column, chars: Column) -> Column:
    """``shape`` with its digits replaced, in order, by those of ``chars``."""
    step = lambda s, c: F.struct(
        F.concat(s["t"], F.when(c.rlike("[0-9]"), F.substring(chars, s["i"], F.lit(1))).otherwise(c)).alias("t"),
        (s["i"] + F.when(c.rlike("[0-9]"), 1).otherwise(0)).alias("i"))
    start = F.struct(F.lit("").alias("t"), F.lit(1).alias("i"))
    return F.aggregate(F.filter(F.split(shape, ""), lambda c: c != ""), start, step)["t"]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def card(value: Column, key: str) -> Column:
    """13 to 19 digits with a Luhn check digit: the issuer's first digit stays, the check digit is made anew."""
    def body(d: Column) -> Column:
        moved = F.concat(F.substring(d, 1, 1), permute_digits(F.substring(d, F.lit(2), F.length(d) - 2), key, "card"))
        return let(moved, lambda m: F.concat(m, F.pmod(-luhn_sum(F.concat(m, F.lit("0"))), F.lit(10)).cast("string")))
    return let(_digits(value), lambda d: F.when((luhn_sum(d) % 10 == 0) & ~d.rlike("^0+$"), _fill(value, body(d))))


def phone(value: Column, key: str) -> Column:
    """Area, exchange and line of a ten-digit number; both first digits stay in 2 to 9, or in 0 to 1. A leading 1 or +1 stays.

    Of other countries' numbers the code and the first digit after it stay.
    """
    def body(d: Column) -> Column:
        area, exchange, line = (_number(F.substring(d, a, n)) for a, n in ((1, 3), (4, 3), (7, 4)))
        low = lambda n: F.when(n < 200, 0).otherwise(200)
        many = lambda n: F.when(n < 200, 200).otherwise(800)
        image = feistel(area - low(area), (exchange - low(exchange)) * 10_000 + line,
                        many(area), many(exchange) * 10_000, key, "phone")
        return let(image, lambda x: F.concat(
            _padded(x["l"] + low(area), 3), _padded(F.floor(x["r"] / 10_000) + low(exchange), 3), _padded(x["r"] % 10_000, 4)))
    prefix = F.regexp_extract(value, r"^\+1|^1(?=[ .-]?[(2-9])", 0)
    ten = let(F.substring(value, F.length(prefix) + F.lit(1), F.length(value)),
              lambda v: F.when(F.length(_digits(v)) == 10, F.concat(prefix, _fill(v, body(_digits(v))))))
    def abroad(code: Column) -> Column:
        digits = F.substring(_digits(value), F.length(code) + F.lit(1), F.lit(15))
        return let(digits, lambda d: _fill(value, F.concat(code, F.substring(d, 1, 1), permute_digits(F.substring(d, F.lit(2), F.length(d)), key, "abroad"))))
    return F.coalesce(ten, let(F.regexp_extract(value, COUNTRY, 1), abroad))


def ssn(value: Column, key: str) -> Column:
    """Area 001-899 without 666, group 01-99, serial 0001-9999."""
    def body(d: Column) -> Column:
        area, group, serial = (_number(F.substring(d, a, n)) for a, n in ((1, 3), (4, 2), (6, 4)))
        valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
        image = feistel(area - F.when(area > 666, 2).otherwise(1), (group - 1) * 9999 + serial - 1,
                        F.lit(898), F.lit(99 * 9999), key, "ssn")
        made = let(image, lambda x: F.concat_ws("-", _padded(x["l"] + F.when(x["l"] >= 665, 2).otherwise(1), 3),
                                                _padded(F.floor(x["r"] / 9999) + 1, 2), _padded(x["r"] % 9999 + 1, 4)))
        return F.when(valid, made)
    return let(_digits(value), body)


def ip(value: Column, key: str) -> Column:
    """Four numbers from 0 to 255 without leading zeros."""
    def body(p: Column) -> Column:
        n = F.transform(p, lambda x: x.cast("int"))
        valid = F.forall(p, lambda x: (x.cast("int") <= 255) & ((F.length(x) == 1) | ~x.startswith("0")))
        image = feistel(n[0] * 256 + n[1], n[2] * 256 + n[3], F.lit(65_536), F.lit(65_536), key, "ip")
        made = let(image, lambda x: F.concat_ws(".", *(y.cast("string") for y in (
            F.floor(x["l"] / 256), x["l"] % 256, F.floor(x["r"] / 256), x["r"] % 256))))
        return F.when(valid, made)
    return let(F.split(value, r"\."), body)


def date(value: Column, key: str) -> Column:
    """A real day from 1800 to 2199, written year-month-day, day.month.year or month/day/year or, if only that is one, day/month/year.

    The first three share one permutation of all days. What is only day/month/year has a day after the twelfth and is permuted
    among such days, so that no two dates with slashes get one pseudonym.
    """
    first = F.lit(FIRST_DAY).cast("date")

    def moved(day: Column, pattern: str) -> Column:
        at = F.datediff(day, first)
        image = feistel(F.floor(at / DAYS), at % DAYS, F.lit(WEEKS), F.lit(DAYS), key, "date")
        made = let(image, lambda x: F.date_format(F.date_add(first, (x["l"] * DAYS + x["r"]).cast("int")), pattern))
        return F.when(day.between(first, F.lit(LAST_DAY).cast("date")), made)

    def late(day: Column) -> Column:
        """Permuted by its number among the days after the twelfth: each month so far has twelve others."""
        starts = lambda month: F.datediff(F.add_months(first, month), first) - FIRST_DAYS * month
        at = F.datediff(day, first) - FIRST_DAYS * ((F.year(day) - 1800) * 12 + F.month(day))
        image = feistel(F.floor(at / LATE_DAYS), at % LATE_DAYS, F.lit(LATE_WEEKS), F.lit(LATE_DAYS), key, "late date")

        def written(n: Column) -> Column:
            # a month has 16 to 19 such days, 88,497 in 4,800 months: the guess is off by less than two
            guess = F.floor(n * 4800 / (LATE_WEEKS * LATE_DAYS)).cast("int")
            months = F.filter(F.transform(F.sequence(F.lit(-2), F.lit(2)), lambda o: guess + o), lambda m: starts(m) <= n)
            return let(F.array_max(months), lambda m: F.date_format(
                F.date_add(F.add_months(first, m), (n - starts(m) + FIRST_DAYS).cast("int")), "dd/MM/yyyy"))

        made = let(image, lambda x: let(x["l"] * LATE_DAYS + x["r"], written))
        return F.when(day.between(first, F.lit(LAST_DAY).cast("date")) & (F.dayofmonth(day) > FIRST_DAYS), made)

    part = lambda a, n: F.substring(value, a, n)
    day = lambda y, m, d: F.try_to_timestamp(F.concat_ws("-", y, m, d), F.lit("yyyy-MM-dd")).cast("date")
    iso, us, eu = day(part(1, 4), part(6, 2), part(9, 2)), day(part(7, 4), part(1, 2), part(4, 2)), day(part(7, 4), part(4, 2), part(1, 2))
    return F.when(value.contains("-"), moved(iso, "yyyy-MM-dd")).when(value.contains("."), moved(eu, "dd.MM.yyyy")).otherwise(F.coalesce(moved(us, "MM/dd/yyyy"), late(eu)))


def _rest(number: Column) -> Column:
    """A string of digits modulo 97."""
    return F.aggregate(F.filter(F.split(number, ""), lambda c: c != ""), F.lit(0), lambda a, c: (a * 10 + c.cast("int")) % 97)


def _country(code: Column) -> Column:
    return F.concat(*((F.ascii(F.substring(code, i, 1)) - 55).cast("string") for i in (1, 2)))


def is_iban(value: Column) -> Column:
    """Whether the check digits of a country and digits, without spaces, are right."""
    return _rest(F.concat(F.substring(value, F.lit(5), F.length(value)), _country(value), F.substring(value, 3, 2))) == 1


def iban(value: Column, key: str) -> Column:
    """Country and digits; the account is permuted and the two check digits are made anew (modulo 97). Spaces stay."""
    def body(v: Column) -> Column:
        country, account = F.substring(v, 1, 2), F.substring(v, F.lit(5), F.length(v))
        made = let(permute_digits(account, key, "iban"), lambda a: F.concat(
            _padded(98 - _rest(F.concat(a, _country(country), F.lit("00"))), 2), a))
        return F.when(is_iban(v), _fill(value, made))
    return let(F.replace(value, F.lit(" "), F.lit("")), body)


def is_card(value: Column) -> Column:
    return let(_digits(value), lambda d: (luhn_sum(d) % 10 == 0) & ~d.rlike("^0+$"))


def checked(text: Column) -> Column:
    """Valid cards and printed IBANs of a text as they are written, whatever numbers stand beside them; longer ones first."""
    found = [F.regexp_extract_all(text, F.lit(f"{EDGES[0]}(?=({g}){EDGES[1]})"), F.lit(1)) for g in GROUPED]
    grouped, loose = F.filter(F.concat(*found), is_card), F.filter(F.regexp_extract_all(text, F.lit(CARD), F.lit(0)), is_card)
    # digits in any grouping count as a whole, unless a card as it is usually written is among them
    cards = let(grouped, lambda g: F.concat(g, F.filter(loose, lambda v: ~F.exists(g, lambda x: v.contains(x)))))
    printed = F.transform(F.regexp_extract_all(text, F.lit(PRINTED), F.lit(0)), lambda v: F.split(v, " "))
    shorter = F.flatten(F.transform(printed, lambda g: F.transform(F.sequence(F.lit(3), F.size(g)), lambda n: F.array_join(F.slice(g, F.lit(1), n), " "))))
    ibans = F.filter(shorter, lambda v: let(F.replace(v, F.lit(" "), F.lit("")), lambda d: (F.length(d) >= 15) & is_iban(d)))
    both = F.array_distinct(F.concat(cards, ibans))
    by_length = F.array_sort(F.transform(both, lambda v: F.struct((-F.length(v)).alias("n"), v.alias("v"))))
    return F.transform(by_length, lambda x: x["v"])


def forms(text: Column) -> Column:
    """The pattern of all that is looked for in a text: its checked values as they are, everything else by form."""
    listed = let(checked(text), lambda c: F.when(F.size(c) > 0, F.concat(
        F.lit(f"{EDGES[0]}(?:"), F.array_join(c, "|"), F.lit(f"){EDGES[1]}|"))).otherwise(F.lit("")))
    many = text.rlike(r"\d(?:[ -]?\d){12}")
    return F.concat(F.lit(EMAIL + "|"), F.when(many, listed).otherwise(F.lit("")), F.lit(FORMS))


def email(value: Column, key: str) -> Column:
    """The part before the @; each letter and digit moves within its kind, the rest and the domain stay."""
    def shifted(half: Column, other: Column, round_no: int) -> Column:
        def one(noise: Column, c: Column, i: Column) -> Column:
            by = F.conv(F.substring(noise, F.pmod(i, F.lit(63)) * 2 + 1, F.lit(2)), 16, 10).cast("int")
            turn = lambda first, n: F.char(F.pmod(F.ascii(c) - first + by, F.lit(n)) + first)
            return (F.when(c.rlike("[a-z]"), turn(97, 26)).when(c.rlike("[A-Z]"), turn(65, 26)).when(c.rlike("[0-9]"), turn(48, 10)).otherwise(c))
        letters = F.filter(F.split(half, ""), lambda c: c != "")
        # named once: the hash of a long part would else be made again for each of its letters
        return let(F.sha2(F.concat_ws("|", F.lit(key), F.lit(f"mail{round_no}"), other), 512),
                   lambda noise: F.array_join(F.transform(letters, lambda c, i: one(noise, c, i)), ""))
    local = F.substring_index(value, "@", 1)
    half = F.floor((F.length(local) + 1) / 2).cast("int")
    state = F.struct(F.substring(local, F.lit(1), half).alias("l"), F.substring(local, half + F.lit(1), F.length(local)).alias("r"))
    for i in range(4):
        state = let(state, lambda s: F.struct(
            (s["l"] if i % 2 else shifted(s["l"], s["r"], i)).alias("l"),
            (shifted(s["r"], s["l"], i) if i % 2 else s["r"]).alias("r")))
    return let(state, lambda s: F.concat(s["l"], s["r"], F.substring(value, F.length(local) + F.lit(1), F.length(value))))


def pseudonym(value: Column, key: str) -> Column:
    """The valid value of the same form that stands for ``value``; ``value`` itself when it is not valid."""
    bare = r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"
    made = (
        F.when(value.contains("@"), email(value, key))
        .when(value.rlike(r"^\+|^(1[ .-]?)?(\([0-9]{3}\) ?|[2-9][0-9]{2}[.-])[2-9][0-9]{2}[.-][0-9]{4}$"), phone(value, key))
        .when(value.rlike(bare), ssn(value, key))
        .when(value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$|^[0-9]{2}([/.])[0-9]{2}\1[0-9]{4}$"), date(value, key))
        .when(value.rlike(r"^([0-9]{1,3}[.]){3}[0-9]{1,3}$"), ip(value, key))
        .when(value.rlike("^[A-Z]"), iban(value, key))
        .otherwise(card(value, key)))
    return F.coalesce(made, value)


def hidden(text: Column, key: str) -> Column:
    """Struct (text, found): the text with pseudonyms, and how many values were replaced."""
    def body(s: Column) -> Column:
        pieces = F.zip_with(s["b"], s["f"], lambda b, v: F.concat(b, F.coalesce(v, F.lit(""))))
        changed = F.zip_with(s["m"], s["f"], lambda a, b: (a != b).cast("int"))
        return F.struct(F.array_join(pieces, "").alias("text"),
                        F.aggregate(changed, F.lit(0), lambda a, b: a + b).cast("long").alias("found"))
    def parts(pattern: Column) -> Column:
        matches = F.regexp_extract_all(text, pattern, F.lit(0))
        return let(matches, lambda m: F.struct(F.split(text, pattern).alias("b"), m.alias("m"),
                                               F.transform(m, lambda v: pseudonym(v, key)).alias("f")))
    plain = F.struct(text.alias("text"), F.lit(0).cast("long").alias("found"))
    # nothing that is looked for does without a digit or an @
    return F.when(text.rlike("[0-9@]"), let(let(forms(text), parts), body)).otherwise(plain)


def pseudonymise(docs: DataFrame, key: str = DEFAULT_KEY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, text, n_replaced) for every row; a null text stays null.

    Equal values get equal pseudonyms wherever they stand. Values that only look like
    personal data (no check digit, no such day) stay as they are, and so does the text
    around. E-mail domains and IBANs with letters in the account stay by design. The time for a text grows with its
    length, also without spaces. Rows are treated one by one: repeated rows stay equal, an empty table gives an
    empty one, further columns are ignored.
    """
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).select(
        "id", hidden(F.col("text"), key).alias("h"))
    return found.select(F.col("id").alias(id_col), F.col("h.text").alias(text_col),
                        F.coalesce("h.found", F.lit(0).cast("long")).alias("n_replaced"))


def without_pii(docs: DataFrame, key: str = DEFAULT_KEY, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """All rows and columns of ``docs``, the text with pseudonyms and ``length_col`` (if there) its new length."""
    text = hidden(F.col(text_col).cast("string"), key)["text"]
    out = docs.withColumn(text_col, text)
    if length_col in docs.columns:
        kind = dict(docs.dtypes)[length_col]
        out = out.withColumn(length_col, F.when(F.col(text_col).isNotNull(), F.length(text_col).cast(kind)).otherwise(F.col(length_col)))
    return out
