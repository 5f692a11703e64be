"""Format-preserving pseudonyms for personal data, by keyed Feistel permutations.

Every kind of value has a finite domain written as pairs (l, r) with l < a and r < b.  Eight rounds add
a keyed hash of one half to the other, modulo its size, which permutes exactly that domain; no value
leaves its format and no two values meet, so equal values stay linked over all documents and
different ones stay apart.

kind    | found if                                                  | domain
card    | 12 to 19 digits, plain, in fours or 4-6-5; valid or not    | all but the last digit; the last keeps its
        |                                                            | distance from the Luhn digit, so valid stays valid
phone   | international or bracketed number, or 3-3-4 digits with dashes, dots or blanks | the last ten digits; country code kept
ssn     | ddd-dd-dddd with a valid area, group and serial            | all valid ones
ip      | four octets                                                | all addresses
date    | yyyy-mm-dd, mm/dd/yyyy, dd/mm/yyyy (dd > 12) or dd.mm.yyyy of a real day | the 72,900 days of its era; eras begin at 1900-01-01
email   | local part and domain                                      | local part by keyed digest, domain kept
secret  | 16 characters or more after token, secret, password, api key | keyed digest of the same length

Dates from 1700-05-29 to 2298 (three eras) count as real days.  Digits are put back into
the value's own punctuation.  All of it is column expressions over the row's text: matches and the text
between them come from one pattern, so the plan is a scan and a projection.

Cases: a null text stays null; an empty text stays empty; values that fail their check stay as they
are; the same value gives the same pseudonym anywhere; further columns are kept; rows are neither added nor lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillwarden.llm.shared import unused

# Fixed patterns of the formats.
OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# the label may be the end of a longer name: access_token, aws_secret_key
SECRET_LABEL = (
    r"(?i:(?<![A-Za-z0-9])(?:api[ _-]?key|secret|token|password|passwd)(?:[_-](?:access[_-])?(?:key|token|id))?\b"
    r"[\"']?\s{0,3}[:=]\s{0,3}[\"']?)"
)
# of any length; a full stop after it is not part of it
SECRET_VALUE = r"[A-Za-z0-9+/_-][A-Za-z0-9+/_.=~%-]{14,}[A-Za-z0-9+/_=~%-]"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,6}[A-Za-z]{2,24}",
    "secret": SECRET_LABEL + SECRET_VALUE,
    "date": (
        r"(?<![0-9/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})"
        r"(?![0-9/-]|\.[0-9])"
    ),
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": (
        r"(?<![0-9])(?:\+?[0-9]{1,3}[ .-]?)?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
        r"|(?<![0-9.-])[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"
        r"|\+[0-9]{1,3}(?:[ .-][0-9]{2,4}){2,5}(?![0-9])"
        r"|\+[0-9]{8,15}(?![0-9])"
    ),
    "ip": rf"(?<![0-9.])(?:{OCTET}\.){{3}}{OCTET}(?![0-9]|\.[0-9])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{12,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z])",
}
ANY = "|".join(PATTERNS.values())

ROUNDS = 8
ERA = 270  # an era has 270 * 270 days
ERA_START = "1900-01-01"
DATE_STEPS = 64
LUHN_DOUBLED = "0246813579"  # digit sum of twice a digit


def _keyed(key: str, *parts: Column | str) -> Column:
    columns = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.sha2(F.concat_ws("|", F.lit(key), *columns), 256)


def _number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def permuted(left: Column, right: Column, a: Column | int, b: Column | int, key: str, tweak: Column | str) -> Column:
    """The pair (l, r), l < a and r < b, after the Feistel rounds, as a struct."""
    a, b = (x if isinstance(x, Column) else F.lit(x) for x in (a, b))

    def one_round(state: Column, r: Column) -> Column:
        even = F.struct(
            F.pmod(state.l + _number(_keyed(key, tweak, r, state.r)), a.cast("long")).alias("l"), state.r.alias("r")
        )
        odd = F.struct(
            state.l.alias("l"), F.pmod(state.r + _number(_keyed(key, tweak, r, state.l)), b.cast("long")).alias("r")
        )
        return F.when(r % 2 == 0, even).otherwise(odd)

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.array(*(F.lit(i) for i in range(ROUNDS))), start, one_round)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _refilled(value: Column, digits: Column) -> Column:
    """The value with its digits replaced in order."""

    def place(i: Column) -> Column:
        c = F.substring(value, i, F.lit(1))
        nth = F.length(_digits(F.substring(value, F.lit(1), i)))
        return F.when(c.between("0", "9"), F.substring(digits, nth, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), place), "")


def _permuted_digits(digits: Column, key: str, tweak: str) -> Column:
    """All digit strings of one length among themselves."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    rest = n - half
    # a leading 0 in front of either half keeps the cast valid where a half is empty
    left = F.concat(F.lit("0"), F.substring(digits, F.lit(1), half)).cast("long")
    right = F.concat(F.lit("0"), F.substring(digits, half + 1, rest)).cast("long")
    size_a, size_b = F.pow(F.lit(10.0), half).cast("long"), F.pow(F.lit(10.0), rest).cast("long")
    pair = permuted(left, right, size_a, size_b, key, F.concat(F.lit(tweak), n.cast("string")))
    return F.concat(F.lpad(pair.l.cast("string"), half, "0"), F.lpad(pair.r.cast("string"), rest, "0"))


def luhn_digit(payload: Column) -> Column:
    """The check digit that follows a string of digits."""

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(payload, -i, F.lit(1)).cast("int")
        doubled = F.substring(F.lit(LUHN_DOUBLED), digit + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, doubled).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(1), F.length(payload)), F.lit(0), add)
    return F.pmod(10 - total % 10, F.lit(10))


def _card(value: Column, key: str) -> Column:
    digits = _digits(value)
    n = F.length(digits)
    payload = F.substring(digits, F.lit(1), n - 1)
    distance = F.substring(digits, n, F.lit(1)).cast("int") - luhn_digit(payload)
    moved = _permuted_digits(payload, key, "card")
    # one struct field read three times: the permutation is evaluated once
    last = F.transform(
        F.array(moved), lambda p: F.concat(p, F.pmod(luhn_digit(p) + distance, F.lit(10)).cast("string"))
    )
    return _refilled(value, last[0])


def _phone(value: Column, key: str) -> Column:
    digits = _digits(value)
    n = F.length(digits)
    kept = F.greatest(n - 10, F.lit(0))
    moved = _permuted_digits(F.substring(digits, kept + 1, n - kept), key, "phone")
    return _refilled(value, F.concat(F.substring(digits, F.lit(1), kept), moved))


def _ip(value: Column, key: str) -> Column:
    octets = F.split(value, r"\.")
    of = [octets[i].cast("int") for i in range(4)]
    pair = permuted(of[0] * 256 + of[1], of[2] * 256 + of[3], 65536, 65536, key, "ip")
    parts = F.transform(
        F.array(pair),
        lambda p: F.concat_ws(".", *(F.floor(x).cast("string") for x in (p.l / 256, p.l % 256, p.r / 256, p.r % 256))),
    )
    return parts[0]


def _ssn(value: Column, key: str) -> Column:
    area, group, serial = (F.substring(value, *at).cast("int") for at in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    index = area - 1 - F.when(area > 666, 1).otherwise(0)
    pair = permuted(index * 99 + group - 1, serial - 1, 898 * 99, 9999, key, "ssn")

    def write(p: Column) -> Column:
        new = F.floor(p.l / 99) + 1
        new = new + F.when(new >= 666, 1).otherwise(0)
        return F.concat(
            F.lpad(new.cast("string"), 3, "0"), F.lit("-"),
            F.lpad((p.l % 99 + 1).cast("string"), 2, "0"), F.lit("-"),
            F.lpad((p.r + 1).cast("string"), 4, "0"),
        )

    return F.when(valid, F.transform(F.array(pair), write)[0]).otherwise(value)


def _date_as(value: Column, pattern: str, key: str, day_after: int = 0) -> Column:
    """Null unless the value is a day of one of the three eras in this format.

    With ``day_after`` the days of the month above it are permuted among themselves: the permutation is
    repeated until it reaches one, which takes more than DATE_STEPS times for no day in practice.
    """
    day = F.datediff(F.try_to_timestamp(value, F.lit(pattern)).cast("date"), F.to_date(F.lit(ERA_START)))
    era = F.floor(day / (ERA * ERA)).cast("int")
    inside = F.pmod(day, F.lit(ERA * ERA))
    tweak = F.concat(F.lit("date"), era.cast("string"))

    def date_of(p: Column) -> Column:
        moved = era * (ERA * ERA) + (p.l * ERA + p.r).cast("int")
        return F.date_add(F.to_date(F.lit(ERA_START)), moved.cast("int"))

    if day_after:
        start = F.struct(
            F.floor(inside / ERA).cast("long").alias("l"), (inside % ERA).cast("long").alias("r"), F.lit(False).alias("done")
        )

        def step(state: Column, _: Column) -> Column:
            pair = F.array(permuted(state.l, state.r, ERA, ERA, key, tweak))
            ended = lambda p: F.struct(p.l.alias("l"), p.r.alias("r"), (F.dayofmonth(date_of(p)) > day_after).alias("done"))
            return F.when(state.done, state).otherwise(F.transform(pair, ended)[0])

        pair = F.aggregate(F.sequence(F.lit(1), F.lit(DATE_STEPS)), start, step)
    else:
        pair = permuted(F.floor(inside / ERA), inside % ERA, ERA, ERA, key, tweak)
    new = F.date_format(date_of(pair), pattern)
    return F.when(day.isNotNull() & era.between(-1, 1), new)


def _date(value: Column, key: str) -> Column:
    by_mark = (
        F.when(F.substring(value, 5, 1) == "-", _date_as(value, "yyyy-MM-dd", key))
        .when(F.substring(value, 3, 1) == "/", _slash_date(value, key))
        .otherwise(_date_as(value, "dd.MM.yyyy", key))
    )
    return F.coalesce(by_mark, value)


def _slash_date(value: Column, key: str) -> Column:
    """mm/dd, or dd/mm where the first number is above 12; neither kind becomes the other."""
    day_first = F.substring(value, 1, 2) > "12"
    return F.when(day_first, _date_as(value, "dd/MM/yyyy", key, day_after=12)).otherwise(_date_as(value, "MM/dd/yyyy", key))


def _email(value: Column, key: str) -> Column:
    local = F.concat(F.lit("u"), F.substring(_keyed(key, "email", F.lower(value)), 1, 16))
    return F.concat(local, F.lit("@"), F.substring_index(value, "@", -1))


def _secret(value: Column, key: str) -> Column:
    old = F.regexp_extract(value, f"^{SECRET_LABEL}({SECRET_VALUE})$", 1)
    size = F.length(old)
    counters = F.sequence(F.lit(0), F.floor((size - 1) / 64).cast("int"))
    # an array of one element: the digest of the whole secret is worked out once
    stream = F.transform(
        F.array(_keyed(key, "secret", old)),
        lambda d: F.array_join(F.transform(counters, lambda i: _keyed(key, "secret", i, d)), ""),
    )[0]
    new = F.substring(stream, F.lit(1), size)
    new = F.when(old == F.upper(old), F.upper(new)).otherwise(new)
    return F.concat(F.substring(value, F.lit(1), F.length(value) - size), new)


_WRITERS = {
    "email": _email, "secret": _secret, "date": _date, "ssn": _ssn, "phone": _phone, "ip": _ip, "card": _card,
}


def _replaced(value: Column, key: str) -> Column:
    """Kind and pseudonym of one match."""
    kind = F.lit(None).cast("string")
    new = value
    for name in reversed(PATTERNS):
        is_kind = value.rlike(f"^(?:{PATTERNS[name]})$")
        kind = F.when(is_kind, F.lit(name)).otherwise(kind)
        new = F.when(is_kind, _WRITERS[name](value, key)).otherwise(new)
    return F.struct(kind.alias("kind"), new.alias("value"), (new != value).alias("changed"))


def pseudonymised(docs: DataFrame, key: str, found: str = "found") -> DataFrame:
    """The rows with their text rewritten, and ``found``: the kinds of the values replaced, in order."""
    text = F.col("text").cast("string")
    # every pattern needs one of these characters; most texts of prose end at this cheap look
    matches = F.when(text.rlike("[0-9@=:]") & text.rlike(ANY), F.transform(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)),
                                                  lambda m: _replaced(m, key)))
    columns = docs.columns
    matches_name = unused(docs, "matches")
    with_matches = docs.withColumn(matches_name, matches)
    hits = F.col(matches_name)
    between = F.split(text, ANY, -1)
    pieces = F.zip_with(between, hits, lambda gap, hit: F.concat(gap, F.coalesce(hit["value"], F.lit(""))))
    rewritten = F.when(hits.isNull(), text).otherwise(F.array_join(pieces, ""))
    kinds = F.coalesce(
        F.transform(F.filter(hits, lambda h: h["changed"]), lambda h: h["kind"]), F.array().cast("array<string>")
    )
    return with_matches.select(
        *(rewritten.alias(c) if c == "text" else F.col(f"`{c}`") for c in columns if c != found), kinds.alias(found)
    )
