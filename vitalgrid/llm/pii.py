"""Format-preserving pseudonyms for personal data (DataFrame functions only).

Card numbers (Luhn), phone numbers, social security numbers (areas, groups and serials that are given
out), IPv4 addresses (octets without leading zeros) and calendar dates are validated and then permuted by a keyed Feistel network inside their own format: the result is again
a valid card, phone, number, address or date with the same separators, equal values stay equal in
all documents, and different values stay different.  Whoever has the key can invert it.  E-mail
addresses and long hexadecimal secrets have no such finite format worth keeping; they get a keyed
hash of the same kind, equal for equal values.

Cards are looked for in whole runs of digit groups, so that a number beside a card (a security code, an
expiry date, a counter) hides neither.  Where a run leaves several readings the inverse may read it
differently; a card written in one group, or evenly with no such group beside it, always comes back.

Digits that do not validate (a 16-digit number that fails Luhn, 31 February, security number 000-12-3456)
are left alone.  Phone numbers with a country code have no rule in common but their length; ten-digit
numbers written without one follow the North American plan before and after.

Defined results: null text stays null with zero counts; the empty text stays empty; texts of any
length are handled whole; repeated rows give repeated results; further columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.llm.common import fresh, let

ROUNDS = 8
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
EMAIL = r"(?<![\w.%+\p{L}\p{M}-])[\w.%+\p{L}\p{M}-]++@[0-9\p{L}\p{M}-]++(?:\.[0-9\p{L}\p{M}-]+)*\.\p{L}{2,}"
SECRET = r"(?<![0-9A-Za-z])[0-9a-fA-F]{32,128}+(?![0-9A-Za-z])"
PHONE = r"\+\d{1,3}[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
#: Ten digits of the North American plan: area and exchange begin with 2 to 9; with one kind of separator or none.
DOMESTIC = r"(?<![\d(.-])(?:(?:\([2-9]\d{2}\) ?|[2-9]\d{2}-)[2-9]\d{2}-\d{4}(?![\d-])|[2-9]\d{2}\.[2-9]\d{2}\.\d{4}(?!\.?\d)|[2-9]\d{2}[2-9]\d{6}(?![\d-]|\.\d))"
ADDRESS = rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\.?\d)"
ISO_DATE = r"(?<![\d-])\d{4}-\d{2}-\d{2}(?![\d-])"
DAY_FIRST = r"(?<![\d/])\d{2}/\d{2}/\d{4}(?![\d/])"
#: Areas 000, 666 and from 900 on, group 00 and serial 0000 are never given out.
SSN = r"(?<![\d-])(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\d-])"
#: Nine digits without hyphens, where the text before says what they are.
BARE_SSN = r"(?<!\d)(?=(?!000|666|9)\d{3}(?!00)\d{2}(?!0000)\d{4}(?!\d))(?<=(?i:ssn|social security|security n)[^\d\n]{0,16})\d{9}"
#: Between the groups of a run: one blank or hyphen that no date, security number, phone or address follows, or
#: a full stop before four digits.
GAP = rf"(?:[ -](?!{ADDRESS}|{ISO_DATE}|{DAY_FIRST}|{SSN}|{DOMESTIC})|\.(?=\d{{4}}(?!\d)))"
#: A run of digit groups with 13 digits or more, in which cards are looked for.
CARD = rf"(?<!\d)(?<!\d\.)(?=\d(?:(?:{GAP})?\d){{12}})\d++(?:{GAP}\d++)*+"
#: Sizes of the groups of cards that are written evenly, with one kind of separator.
EVEN = ("4,4,4,4", "4,6,5")
ANY = "|".join((EMAIL, SECRET, PHONE, DOMESTIC, ADDRESS, ISO_DATE, DAY_FIRST, SSN, BARE_SSN, CARD))
#: Groups of a card that is not written evenly, at most; rows of many short numbers are none.
LOOSE_GROUPS = 6
#: Dates of two Gregorian cycles of 400 years are permuted among themselves: 2 * 146097 = 378 * 773 days.
FIRST_DAY, DAYS = "1600-01-01", (378, 773)
#: Of them, those after the twelfth of their month: 2 * 88497 = 18 * 9833.
LATE_DAYS, LATE_IN_MONTH = (18, 9833), 176994 / 9600


def feistel(a: Column, b: Column, size_a: Column, size_b: Column, key: Column, kind: str, inverse: bool = False) -> Column:
    """Struct ``a, b``: the pair permuted among all pairs below ``size_a`` and ``size_b``."""

    key = F.lit(key) if isinstance(key, str) else key

    def pseudo(i: Column, x: Column, size: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", key, F.lit(kind), size_a, size_b, i, x), 256)
        return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), size)

    def forward(s: Column, i: Column) -> Column:
        mixed = F.pmod(s["a"] + pseudo(i, s["b"], s["m"]), s["m"])
        return F.struct(s["b"].alias("a"), mixed.alias("b"), s["n"].alias("m"), s["m"].alias("n"))

    def back(s: Column, i: Column) -> Column:
        mixed = F.pmod(s["b"] - pseudo(i, s["a"], s["n"]), s["n"])
        return F.struct(mixed.alias("a"), s["a"].alias("b"), s["n"].alias("m"), s["m"].alias("n"))

    start = F.struct(*[x.cast("long").alias(n) for x, n in ((a, "a"), (b, "b"), (size_a, "m"), (size_b, "n"))])
    rounds = F.array(*[F.lit(i) for i in (range(ROUNDS - 1, -1, -1) if inverse else range(ROUNDS))])
    return F.aggregate(rounds, start, back if inverse else forward)


def permute_digits(digits: Column, key: Column, kind: str, inverse: bool = False) -> Column:
    """A string of two to 20 digits, permuted among those of its length."""
    n = F.length(digits)
    u = F.floor(n / 2).cast("int")
    v = n - u
    ten = F.lit(10)
    start = F.struct(F.substring(digits, F.lit(1), u).cast("long").alias("a"), F.substring(digits, u + 1, v).cast("long").alias("b"))
    mixed = feistel(start["a"], start["b"], F.pow(ten, u).cast("long"), F.pow(ten, v).cast("long"), key, kind, inverse)
    return let(mixed, lambda s: F.concat(F.lpad(s["a"].cast("string"), u, "0"), F.lpad(s["b"].cast("string"), v, "0")))


def luhn_sum(digits: Column, double_last: bool) -> Column:
    """Luhn sum; ``double_last`` when the check digit is still missing."""
    reverse = F.transform(F.split(F.reverse(digits), ""), lambda x: F.coalesce(x.try_cast("int"), F.lit(0)))
    odd = 0 if double_last else 1
    parts = F.transform(
        reverse, lambda x, i: F.when(i % 2 == odd, F.when(x > 4, 2 * x - 9).otherwise(2 * x)).otherwise(x)
    )
    return F.aggregate(parts, F.lit(0), lambda s, x: s + x)


def into_format(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, one after the other, by ``digits``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def step(s: Column, c: Column) -> Column:
        digit = c.rlike(r"^\d$")
        return F.struct(
            F.concat(s["out"], F.when(digit, F.substring(digits, s["at"], F.lit(1))).otherwise(c)).alias("out"),
            (s["at"] + digit.cast("int")).alias("at"),
        )

    return F.aggregate(F.split(shape, ""), start, step, lambda s: s["out"])


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, r"\D", "")


def _card(m: Column, key: Column, inverse: bool) -> Column:
    """A valid card with its digits permuted."""

    def body(d: Column) -> Column:
        head = permute_digits(F.substring(d, F.lit(1), F.length(d) - 1), key, "card", inverse)
        full = let(head, lambda h: F.concat(h, F.pmod(10 - luhn_sum(h, True) % 10, F.lit(10)).cast("string")))
        return let(full, lambda x: into_format(m, x))

    return let(_digits(m), body)


def _spans(groups: Column, marks: Column) -> Column:
    """The cards in a run of digit groups: first and last group, none overlapping, in order.

    Whole groups of 13 to 19 digits and even cards come before any other groups (at most ``LOOSE_GROUPS``, no full stop
    between them) with 13 to 19 digits together, of which longer ones are tried first. Only spans that pass Luhn count.
    """
    n = F.size(groups)

    def ends(i: Column, fits, last: Column) -> Column:
        """The last group of the longest valid span from group ``i``, or -1."""

        def valid(j: Column) -> Column:
            part = F.slice(groups, i + 1, j - i + 1)
            digits = F.array_join(part, "")
            return fits(part, i, j) & F.length(digits).between(13, 19) & (luhn_sum(digits, False) % 10 == 0)

        return F.coalesce(F.get(F.filter(F.sequence(last, i, F.lit(-1)), valid), 0), F.lit(-1))

    def strict(part: Column, i: Column, j: Column) -> Column:
        sizes = F.array_join(F.transform(part, lambda g: F.length(g).cast("string")), ",")
        return (i == j) | (sizes.isin(*EVEN) & (F.size(F.array_distinct(F.slice(marks, i + 1, j - i))) == 1))

    def loose(first: Column) -> Column:
        def free(part: Column, i: Column, j: Column) -> Column:
            dotted = F.array_contains(F.slice(marks, i + 1, j - i), ".")
            return ~dotted & ~F.exists(F.slice(first, i + 1, j - i + 1), lambda x: x >= 0)

        return F.transform(
            first, lambda x, i: F.when(x >= 0, x).otherwise(ends(i, free, F.least(i + LOOSE_GROUPS - 1, n - 1)))
        )

    def chosen(end: Column) -> Column:
        spans = F.filter(F.transform(end, lambda j, i: F.struct(i.alias("i"), j.alias("j"))), lambda s: s["j"] >= 0)
        start = F.array().cast("array<struct<i:int,j:int>>")
        return F.aggregate(
            spans, start, lambda c, s: F.when(s["i"] > F.coalesce(F.get(c, F.size(c) - 1)["j"], F.lit(-1)), F.concat(c, F.array(s))).otherwise(c)
        )

    first = F.transform(groups, lambda g, i: ends(i, strict, F.least(i + 3, n - 1)))
    return let(let(first, loose), chosen)


def _cards(m: Column, key: Column, inverse: bool) -> Column:
    """A run of digit groups with its cards permuted: ``new``, ``found``, ``replaced``."""

    def rewrite(groups: Column, marks: Column) -> Column:
        n = F.size(groups)

        def text(i: Column, j: Column) -> Column:
            """Groups ``i`` to ``j`` as they stand, each with the separator after it."""
            part = F.slice(groups, i + 1, F.greatest(j - i + 1, F.lit(0)))
            return F.array_join(F.transform(part, lambda g, k: F.concat(g, F.coalesce(F.get(marks, i + k), F.lit("")))), "")

        def joined(spans: Column) -> Column:
            def piece(s: Column, k: Column) -> Column:
                after = F.when(k > 0, F.get(spans, k - 1)["j"] + 1).otherwise(0)
                mark = F.coalesce(F.get(marks, s["j"]), F.lit(""))
                own = let(text(s["i"], s["j"]), lambda c: _card(F.substring(c, F.lit(1), F.length(c) - F.length(mark)), key, inverse))
                return F.concat(text(after, s["i"] - 1), own, mark)

            rest = text(F.coalesce(F.get(spans, F.size(spans) - 1)["j"], F.lit(-1)) + 1, n - 1)
            new = F.concat(F.array_join(F.transform(spans, piece), ""), rest)
            return let(new, lambda x: _result(m, x, F.size(spans)))

        return let(_spans(groups, marks), joined)

    both = F.struct(
        F.regexp_extract_all(m, F.lit(r"\d+"), F.lit(0)).alias("g"), F.regexp_extract_all(m, F.lit("[ .-]"), F.lit(0)).alias("s")
    )
    return let(both, lambda b: rewrite(b["g"], b["s"]))


def _result(m: Column, new: Column, values: Column) -> Column:
    """What is known of a match: a run that holds no card counts as found if a card has as many digits."""
    one = (F.length(_digits(m)) < 20) | m.rlike(rf"^(?:{SECRET})$")
    return F.struct(
        new.alias("new"), F.greatest(values, one.cast("int")).alias("found"), F.when(new != m, values).otherwise(0).alias("replaced")
    )


def _phone(m: Column, key: Column, inverse: bool) -> Column:
    def body(d: Column) -> Column:
        code = F.length(d) - 10
        own = permute_digits(F.substring(d, code + 1, F.lit(10)), key, "phone", inverse)
        return let(F.concat(F.substring(d, F.lit(1), code), own), lambda x: into_format(m, x))

    return let(_digits(m), body)


def _domestic(m: Column, key: Column, inverse: bool) -> Column:
    """A ten-digit number, permuted among those of its plan."""

    def body(d: Column) -> Column:
        area, exchange, line = (F.substring(d, i, n).cast("long") for i, n in ((1, 3), (4, 3), (7, 4)))
        mixed = feistel((area - 200) * 800 + exchange - 200, line, F.lit(640_000), F.lit(10_000), key, "domestic", inverse)
        parts = lambda s: F.format_string("%03d%03d%04d", F.floor(s["a"] / 800) + 200, s["a"] % 800 + 200, s["b"])
        return let(let(mixed, parts), lambda x: into_format(m, x))

    return let(_digits(m), body)


def _ssn(m: Column, key: Column, inverse: bool) -> Column:
    """A security number, permuted among the 898 areas, 99 groups and 9999 serials that are given out."""

    def body(d: Column) -> Column:
        area, group, serial = (F.substring(d, i, n).cast("long") for i, n in ((1, 3), (4, 2), (6, 4)))
        place = (area - 1 - (area > 666).cast("long")) * 99 + group - 1
        mixed = feistel(place, serial - 1, F.lit(898 * 99), F.lit(9999), key, "ssn", inverse)

        def parts(s: Column) -> Column:
            at = F.floor(s["a"] / 99)
            return F.format_string("%03d%02d%04d", at + 1 + (at >= 665).cast("long"), s["a"] % 99 + 1, s["b"] + 1)

        return let(let(mixed, parts), lambda x: into_format(m, x))

    return let(_digits(m), body)


def _address(m: Column, key: Column, inverse: bool) -> Column:
    def body(p: Column) -> Column:
        low = [F.get(p, i).cast("long") for i in range(4)]
        size = F.lit(65536)
        mixed = feistel(low[0] * 256 + low[1], low[2] * 256 + low[3], size, size, key, "address", inverse)
        parts = lambda s: [F.floor(s["a"] / 256), s["a"] % 256, F.floor(s["b"] / 256), s["b"] % 256]
        return let(mixed, lambda s: F.concat_ws(".", *[x.cast("string") for x in parts(s)]))

    return let(F.split(m, r"\."), body)


def _date(m: Column, pattern: str, key: Column, inverse: bool) -> Column:
    a, b = DAYS
    first = F.lit(FIRST_DAY).cast("date")

    def body(day: Column) -> Column:
        n = F.date_diff(day, first)
        mixed = feistel(F.floor(n / b), n % b, F.lit(a), F.lit(b), key, "date", inverse)
        moved = let(mixed, lambda s: F.date_format(F.date_add(first, (s["a"] * b + s["b"]).cast("int")), pattern))
        return F.when(day.isNull() | (n < 0) | (n >= a * b), m).otherwise(moved)

    return let(F.try_to_timestamp(m, F.lit(pattern)).cast("date"), body)


def _month_first(m: Column, key: Column, inverse: bool) -> Column:
    """A date that can only be read with its month first, permuted among those: the ones after the twelfth of a month."""
    a, b = LATE_DAYS
    first = F.lit(FIRST_DAY).cast("date")
    before = lambda month: F.date_diff(F.add_months(first, month), first) - 12 * month  # noqa: E731  late days before it

    def dated(s: Column) -> Column:
        at = (s["a"] * b + s["b"]).cast("int")
        near = F.floor(at / LATE_IN_MONTH).cast("int")  # right but for one month
        month = F.element_at(F.filter(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: near + d), lambda k: (k >= 0) & (before(k) <= at)), -1)
        return let(month, lambda k: F.date_format(F.date_add(F.add_months(first, k), (at - before(k)).cast("int") + 12), "MM/dd/yyyy"))

    def body(day: Column) -> Column:
        month = (F.year(day) - 1600) * 12 + F.month(day) - 1
        n = before(month) + F.day(day) - 13
        mixed = feistel(F.floor(n / b), n % b, F.lit(a), F.lit(b), key, "month first", inverse)
        return F.when(day.isNull() | (F.day(day) < 13) | (F.year(day) < 1600) | (F.year(day) >= 2400), m).otherwise(let(mixed, dated))

    return let(F.try_to_timestamp(m, F.lit("MM/dd/yyyy")).cast("date"), body)


def pseudonym(m: Column, key: Column, inverse: bool = False) -> Column:
    """The pseudonym of one matched value other than a card, or the value itself if it does not validate."""
    whole = lambda p: m.rlike(rf"^(?:{p})$")
    keyed = F.sha2(F.concat(key, F.lit("|"), F.lower(m)), 512)
    return (
        F.when(m.contains("@"), F.concat(F.lit("user-"), F.substring(keyed, 1, 16), F.lit("@example.invalid")))
        .when(whole(SECRET) & m.rlike("[a-fA-F]"), F.substring(keyed, F.lit(1), F.length(m)))
        .when(whole(PHONE), _phone(m, key, inverse))
        .when(whole(ADDRESS), _address(m, key, inverse))
        .when(whole(ISO_DATE), _date(m, "yyyy-MM-dd", key, inverse))
        .when(m.rlike(r"^(?:0\d|1[0-2])/(?:1[3-9]|[23]\d)/\d{4}$"), _month_first(m, key, inverse))
        .when(whole(DAY_FIRST), _date(m, "dd/MM/yyyy", key, inverse))
        .when(whole(DOMESTIC), _domestic(m, key, inverse))
        .when(whole(SSN) | m.rlike(r"^\d{9}$"), _ssn(m, key, inverse))
        .otherwise(m)
    )


def pseudonymize(docs: DataFrame, key: str, *, text: str = "text", inverse: bool = False) -> DataFrame:
    """``docs`` with ``text`` rewritten and ``n_found`` (values matched) and ``n_replaced`` added.

    Columns of these two names are replaced, all others pass through.  The key is a row of a local table that meets all
    others, so that it stands in no expression and no plan's text shows it.
    """
    t = F.col(text)
    maybe = t.rlike("[0-9@]")
    found = F.when(maybe, F.regexp_extract_all(t, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))
    held, made, secret = fresh(docs, "_found", "_new", "_secret")
    keys = docs.sparkSession.createDataFrame([(key,)], f"{secret} string")  # one row
    out, key = docs.withColumn(held, found).join(F.broadcast(keys)), F.col(secret)
    run = lambda m: m.rlike(r"^\d[\d .-]*$") & (F.length(_digits(m)) >= 13)
    other = lambda m: let(pseudonym(m, key, inverse), lambda x: _result(m, x, F.lit(1)))
    out = out.withColumn(made, F.transform(held, lambda m: F.when(run(m), _cards(m, key, inverse)).otherwise(other(m))))
    joined = F.array_join(
        F.zip_with(F.split(t, ANY, -1), made, lambda p, r: F.concat(p, F.coalesce(r["new"], F.lit("")))), ""
    )
    total = lambda name: F.aggregate(made, F.lit(0), lambda a, x: a + x[name])
    return out.withColumns({
        text: F.when(F.size(held) > 0, joined).otherwise(t),
        "n_found": F.coalesce(total("found"), F.lit(0)).cast("long"),
        "n_replaced": F.coalesce(total("replaced"), F.lit(0)).cast("long"),
    }).drop(held, made, secret)


#: Key of the query and of the tests; a real run passes its own secret.
DEMO_KEY = "demo-key"


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pseudonymize(docs, DEMO_KEY).select("doc_id", "text", "n_found", "n_replaced")
