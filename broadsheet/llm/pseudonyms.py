"""Format-preserving pseudonyms for personal data, as column expressions only.

Candidates are found by one linear pattern, validated (checksum, calendar,
number ranges), and replaced by the value that a keyed Feistel permutation of the
value's own domain assigns to them. A permutation has no collisions, so equal
values stay equal in every document and different values stay different; a card
keeps its grouping and a valid check digit, a date stays a date between 1900 and
2099, an address keeps its domain.

The domain of each kind is a product of two ranges, and rounds alternate between
adding a keyed hash of one coordinate to the other, each modulo its range:

    card     the digits between the first and the check digit
    phone    area code x (exchange, line); numbers whose first digits are both 2-9, those of
             areas 000-199 and those of exchanges 000-199 are three domains of their own
    intl     digits after the country's first two
    ssn      valid areas x (group, serial)
    ipv4     two octets x two octets
    date     17 x 4,297 days, the 73,049 days of 1900-01-01 to 2099-12-31
    iban     digits of the account; its check digits are computed anew
    email    digits, lower-case and upper-case letters of the local part
    secret   letters and digits of keys, passwords and tokens

Candidates that fail validation stay as they are. Nothing is shuffled.

A card or an account may stand beside other digits or capitals. Their candidates are
whole runs of groups; every cut of a run is validated and the longest valid one wins (a
card in a cut has at most eight groups, and a valid unbroken account wins over longer
cuts). What is left of the run is searched again, inside the run: the work grows with the
length of a text, and with the square of the values in one unbroken run of numbers.

Phone numbers count with separators, or compact behind a plus; ten or more bare digits
do not. Dates count as yyyy-mm-dd, yyyy/mm/dd, m/d/yyyy, d.m.yyyy (one or two digits in
the latter two), "January 5, 2024" and "5 January 2024" (English names or their first
three letters, comma optional); day-first dates with slashes and two-digit years do not.
Unpadded dates and named months may change their length, as addresses of hosts do.

Defined cases: a null text stays null, with no replacements; an empty text stays
empty; rows repeated in full give equal rows; an empty table gives an empty
result; other columns pass through unchanged whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import fresh

ROUNDS = 8

MONTH = (
    "(?i:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?"
    "|sep(?:tember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
)

# fixed: the forms of candidate values; every repetition is bounded or possessive
FORMS = {
    "secret": r"(?<![A-Za-z0-9_])(?i:password|passwd|pwd|token|secret|api_key|apikey) ?[=:] ?\"?[A-Za-z0-9]{8,64}(?![A-Za-z0-9])",
    "key": r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}",
    "phone": (
        r"(?<![0-9A-Za-z+])(?:\+1(?:[ .()/-]{0,2}[0-9]){10}"
        r"|(?:\+?1[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4})(?![0-9A-Za-z])"
    ),
    "intl": (
        r"(?<![0-9A-Za-z+])\+[2-9](?:[0-9]{7,14}(?![0-9A-Za-z])"
        r"|(?:[ .()/-]{0,2}[0-9]){7,14}(?![0-9A-Za-z]))"
    ),
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "iso_date": r"(?<![0-9A-Za-z-])(?:19|20)[0-9]{2}-[01][0-9]-[0-3][0-9](?![0-9-])",
    "ymd_date": r"(?<![0-9A-Za-z/])(?:19|20)[0-9]{2}/[01][0-9]/[0-3][0-9](?![0-9A-Za-z/])",
    "us_date": r"(?<![0-9A-Za-z/])[01]?[0-9]/[0-3]?[0-9]/(?:19|20)[0-9]{2}(?![0-9A-Za-z/])",
    "eu_date": r"(?<![0-9A-Za-z.])[0-3]?[0-9]\.[01]?[0-9]\.(?:19|20)[0-9]{2}(?!\.?[0-9A-Za-z])",
    "name_date": rf"(?<![0-9A-Za-z]){MONTH} [0-3]?[0-9],? (?:19|20)[0-9]{{2}}(?![0-9A-Za-z])",
    "day_date": rf"(?<![0-9A-Za-z])[0-3]?[0-9] {MONTH},? (?:19|20)[0-9]{{2}}(?![0-9A-Za-z])",
    "ipv4": r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9A-Za-z])",
}
IBAN = r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
CARD = r"[0-9](?:[ -]?[0-9]){12,18}"
# a run of groups ends where a value of another kind starts
OTHERS = "|".join(FORMS[k] for k in ("secret", "key", "email", "phone", "ssn", "iso_date", "ymd_date", "us_date", "eu_date", "day_date", "ipv4"))
FORMS["iban"] = (
    r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){8})[A-Z]{2}[0-9]{2}[A-Z0-9]{0,31}+(?![A-Za-z0-9])"
    rf"(?: (?!{OTHERS})[A-Z0-9]{{1,31}}+(?![A-Za-z0-9]))*+"
)
FORMS["card"] = (
    r"(?<![0-9A-Za-z.-])(?=[0-9](?:[ -]?[0-9]){12})[0-9]++(?![A-Za-z])"
    rf"(?:(?: (?!{OTHERS})|-)[0-9]++(?![A-Za-z]))*+"
)
CARD_GROUPS = 8  # of a card that is cut out of a run
IBAN_GROUPS = 9
ORDER = ("secret", "key", "email", "iban", *[k for k in FORMS if k not in ("secret", "key", "email", "iban")])
FORMS = {k: FORMS[k] for k in ORDER}


def _first_of(*kinds: str) -> str:
    """The named forms, in the order of all."""
    return "|".join(f"(?:{FORMS[k]})" for k in FORMS if k in kinds)


# forms by their first character, so that most places of a text are passed over at once;
# none that starts with a letter or digit follows another
ANY = (
    "(?<![0-9A-Za-z])(?:"
    f"(?=[A-Za-z])(?:{_first_of('secret', 'key', 'email', 'iban', 'name_date')})"
    f"|(?=[0-9])(?:{_first_of(*(k for k in FORMS if k not in ('secret', 'key', 'iban', 'intl', 'name_date')))}))"
    f"|(?=[+(._%-])(?:{_first_of('email', 'phone', 'intl')})"
)
# how dates are read; they are written in the first pattern that gives them back
DATES = {
    "iso_date": ["yyyy-MM-dd"], "ymd_date": ["yyyy/MM/dd"],
    "us_date": ["MM/dd/yyyy", "M/d/yyyy"], "eu_date": ["dd.MM.yyyy", "d.M.yyyy"],
    "name_date": ["MMMM d, yyyy", "MMMM d yyyy", "MMM d, yyyy", "MMM d yyyy"],
    "day_date": ["d MMMM yyyy", "d MMMM, yyyy", "d MMM yyyy", "d MMM, yyyy"],
}
FIRST_DAY = "1900-01-01"
DAYS = (17, 4297)  # their product is the number of days of 1900 to 2099


def _long(text: Column) -> Column:
    return F.concat(F.lit("0"), text).cast("long")


def _power(radix: int, n: Column, most: int) -> Column:
    return F.get(F.array(*[F.lit(radix**k).cast("long") for k in range(most + 1)]), n)


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


class Permuter:
    """Keyed permutations of product ranges."""

    def __init__(self, key: str):
        self.key = key

    def _noise(self, tweak: Column, r: Column, x: Column) -> Column:
        said = F.concat_ws("|", F.lit(self.key), tweak, r.cast("string"), x.cast("string"))
        return F.conv(F.substring(F.sha2(said, 256), 1, 15), 16, 10).cast("long")

    def pair(self, a: Column, b: Column, m: Column, n: Column, tweak: Column) -> Column:
        """Struct ``a, b`` of the place in [0, m) x [0, n) that (a, b) is moved to."""
        start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))

        def turn(at: Column, r: Column) -> Column:
            a = F.when(r % 2 == 0, (at["a"] + self._noise(tweak, r, at["b"])) % m).otherwise(at["a"])
            b = F.when(r % 2 == 0, at["b"]).otherwise((at["b"] + self._noise(tweak, r, at["a"])) % n)
            return F.struct(a.alias("a"), b.alias("b"))

        return F.aggregate(F.array(*[F.lit(r) for r in range(ROUNDS)]), start, turn)

    def digits(self, text: Column, radix: int, half: int, kind: str) -> Column:
        """Permute a string over the first ``radix`` of 0-9a-z, in blocks of at most two halves."""
        def number(x: Column) -> Column:
            return F.conv(F.concat(F.lit("0"), x), radix, 10).cast("long")

        def written(x: Column, size: Column) -> Column:
            return F.lpad(F.lower(F.conv(x.cast("string"), 10, radix)), size, F.lit("0"))

        def block(whole: Column, k: Column) -> Column:
            def move(part: Column) -> Column:
                n = F.length(part)
                left = F.floor(n / 2).cast("int")
                right = n - left
                moved = self.pair(
                    number(F.substr(part, F.lit(1), left)), number(F.substr(part, left + 1, right)),
                    _power(radix, left, half), _power(radix, right, half),
                    F.concat_ws("/", F.lit(kind), k.cast("string"), n.cast("string")),
                )
                return _let(moved, lambda at: F.concat(written(at["a"], left), written(at["b"], right)))

            return _let(F.substr(whole, k * (2 * half) + 1, F.lit(2 * half)), move)

        def blocks(whole: Column) -> Column:
            last = F.ceil(F.length(whole) / (2 * half)).cast("int") - 1
            joined = F.array_join(F.transform(F.sequence(F.lit(0), last), lambda k: block(whole, k)), "")
            return F.when(F.length(whole) == 0, F.lit("")).otherwise(joined)

        return _let(text, blocks)


def _refill(template: Column, symbols: str, new: Column) -> Column:
    """The template with its characters of the class ``symbols`` replaced in order by ``new``."""
    start = F.struct(F.lit("").alias("s"), F.lit(0).alias("k"))

    def step(acc: Column, c: Column) -> Column:
        taken = c.rlike(symbols)
        put = F.when(taken, F.substr(new, acc["k"] + 1, F.lit(1))).otherwise(c)
        return F.struct(F.concat(acc["s"], put).alias("s"), (acc["k"] + F.when(taken, 1).otherwise(0)).alias("k"))

    chars = F.filter(F.split(template, ""), lambda c: c != "")
    return F.aggregate(chars, start, step, lambda acc: acc["s"])


def _only(text: Column, others: str) -> Column:
    return F.regexp_replace(text, others, "")


def _span(items: Column, i: Column, k: Column, between: str) -> Column:
    """``k`` items of an array from its ``i``-th, joined; a slice would copy the whole array first."""
    return F.array_join(F.transform(F.sequence(i, i + k - 1), lambda j: F.get(items, j - 1)), between)


def _luhn(digits: Column) -> Column:
    """Luhn sum of a digit string."""
    def step(acc: Column, c: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.struct((acc["s"] + F.when(acc["k"], twice).otherwise(d)).alias("s"), (~acc["k"]).alias("k"))

    start = F.struct(F.lit(0).alias("s"), F.lit(False).alias("k"))
    chars = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    return F.aggregate(chars, start, step, lambda acc: acc["s"])


def _mod97(iban: Column) -> Column:
    """Remainder of an IBAN without blanks, its first four characters moved to the end."""
    moved = F.concat(F.substr(iban, F.lit(5), F.length(iban)), F.substr(iban, F.lit(1), F.lit(4)))

    def step(acc: Column, c: Column) -> Column:
        v = F.conv(c, 36, 10).cast("int")
        return (acc * F.when(v > 9, 100).otherwise(10) + v) % 97

    return F.aggregate(F.filter(F.split(moved, ""), lambda c: c != ""), F.lit(0), step)


def _is(x: Column, kind: str) -> Column:
    return x.rlike("^(?:" + FORMS[kind] + ")$")


def _replacements(p: Permuter) -> list[Callable[[Column], tuple[Column, Column]]]:
    """Per kind: whether a candidate is a valid value of it, and its pseudonym."""

    def card(x):
        def new(d):
            inner = p.digits(F.substr(d, F.lit(2), F.length(d) - 2), 10, 18, "card")
            body = F.concat(F.substr(d, F.lit(1), F.lit(1)), inner)
            check = lambda b: (10 - _luhn(F.concat(b, F.lit("0"))) % 10) % 10
            return _let(body, lambda b: F.concat(b, check(b).cast("string")))

        def cut(groups):
            n = F.size(groups)

            def window(i, k):
                value = _only(_span(groups, i, k, ""), "^[ -]")
                size = F.length(_only(value, "[^0-9]"))
                return F.struct(size.alias("size"), (-i).alias("i"), k.alias("k"), value.alias("value"))

            def ends(i):
                last = n - i + 1
                short = F.transform(F.sequence(F.lit(1), F.least(last, F.lit(CARD_GROUPS))), lambda k: window(i, k))
                whole = F.array(window(F.lit(1), n))
                return F.when((i == 1) & (n > CARD_GROUPS) & (n < 20), F.concat(short, whole)).otherwise(short)

            def is_card(w):
                return w["value"].rlike(f"^{CARD}$") & (_luhn(_only(w["value"], "[^0-9]")) % 10 == 0)

            def split(w):
                head = F.array_join(F.slice(groups, F.lit(1), -w["i"] - 1), "")
                gap = F.regexp_extract(F.get(groups, -w["i"] - 1), "^[ -]?", 0)
                value = _refill(w["value"], "[0-9]", _let(_only(w["value"], "[^0-9]"), new))
                tail = F.array_join(F.slice(groups, w["k"] - w["i"], n), "")
                return _cut(F.concat(head, gap), value, tail)

            windows = F.flatten(F.transform(F.sequence(F.lit(1), n), lambda i: F.filter(ends(i), is_card)))
            return F.transform(F.slice(F.sort_array(windows, asc=False), 1, 1), split)

        found = F.get(_let(F.regexp_extract_all(x, F.lit("[ -]?[0-9]+"), F.lit(0)), cut), F.lit(0))
        return _is(x, "card"), F.coalesce(found, _cut(x, F.lit(None).cast("string"), F.lit("")))

    def phone(x):
        def new(d):
            ten = F.substring(d, -10, 10)
            area, rest = _long(F.substr(ten, F.lit(1), F.lit(3))), _long(F.substr(ten, F.lit(4), F.lit(7)))
            low, usual = area < 200, (area >= 200) & (rest >= 2_000_000)
            first, second = F.when(low, 0).otherwise(200), F.when(usual, 2_000_000).otherwise(0)
            m = F.when(low, 200).otherwise(800)
            n = F.when(low, 10_000_000).when(usual, 8_000_000).otherwise(2_000_000)
            tweak = F.when(low, "phone/area").when(usual, "phone").otherwise("phone/exchange")
            moved = p.pair(area - first, rest - second, m, n, tweak)
            head = F.when(F.length(d) > 10, "1").otherwise("")
            return _let(
                moved,
                lambda at: F.concat(
                    head, F.lpad((at["a"] + first).cast("string"), 3, "0"), F.lpad((at["b"] + second).cast("string"), 7, "0")
                ),
            )

        return _is(x, "phone"), _refill(x, "[0-9]", _let(_only(x, "[^0-9]"), new))

    def intl(x):
        def new(d):
            return F.concat(F.substr(d, F.lit(1), F.lit(2)), p.digits(F.substr(d, F.lit(3), F.length(d)), 10, 18, "intl"))

        return _is(x, "intl"), _refill(x, "[0-9]", _let(_only(x, "[^0-9]"), new))

    def ssn(x):
        area, group, serial = (_long(F.substr(x, F.lit(a), F.lit(n))) for a, n in ((1, 3), (5, 2), (8, 4)))
        valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
        place = area - 1 - F.when(area > 666, 1).otherwise(0)
        moved = p.pair(place, (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), F.lit("ssn"))

        def written(at):
            new_area = at["a"] + 1 + F.when(at["a"] >= 665, 1).otherwise(0)
            return F.concat_ws(
                "-",
                F.lpad(new_area.cast("string"), 3, "0"),
                F.lpad((F.floor(at["b"] / 9999) + 1).cast("string"), 2, "0"),
                F.lpad((at["b"] % 9999 + 1).cast("string"), 4, "0"),
            )

        return _is(x, "ssn") & valid, _let(moved, written)

    def ipv4(x):
        o = [_long(F.split_part(x, F.lit("."), F.lit(k))) for k in (1, 2, 3, 4)]
        valid = (o[0] < 256) & (o[1] < 256) & (o[2] < 256) & (o[3] < 256)
        moved = p.pair(o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65_536), F.lit(65_536), F.lit("ipv4"))

        def written(at):
            octets = [v for h in ("a", "b") for v in (F.floor(at[h] / 256), at[h] % 256)]
            return F.concat_ws(".", *[v.cast("string") for v in octets])

        return _is(x, "ipv4") & valid, _let(moved, written)

    def date(x):
        days = {
            (kind, f): F.when(_is(x, kind), F.try_to_date(x, f)) for kind, forms in DATES.items() for f in forms
        }
        m, n = DAYS
        first = F.lit(FIRST_DAY).cast("date")

        def new(place):
            moved = p.pair(F.floor(place / n), place % n, F.lit(m), F.lit(n), F.lit("date"))
            return _let(moved, lambda at: F.date_add(first, (at["a"] * n + at["b"]).cast("int")))

        def written(moved):
            out = F.coalesce(*[F.when(d.isNotNull(), F.date_format(moved, f)) for (_, f), d in days.items()])
            return F.when(x == F.upper(x), F.upper(out)).when(x == F.lower(x), F.lower(out)).otherwise(out)

        day = F.coalesce(*days.values())
        return day.isNotNull(), _let(_let(F.datediff(day, first).cast("long"), new), written)

    def iban(x):
        def whole(bare):
            country = F.substr(bare, F.lit(1), F.lit(2))

            def filled(account):
                new = _refill(account, "[0-9]", p.digits(_only(account, "[^0-9]"), 10, 18, "iban"))
                check = lambda v: (98 - _mod97(F.concat(country, F.lit("00"), v))).cast("string")
                return _let(new, lambda v: F.concat(country, F.lpad(check(v), 2, "0"), v))

            return _let(F.substr(bare, F.lit(5), F.length(bare)), filled)

        def is_iban(value):
            return value.rlike(f"^{IBAN}$") & (_mod97(_only(value, " ")) == 1)

        def cut(groups):
            n = F.size(groups)
            none = F.lit(None).cast("string")
            join = lambda i, k: F.array_join(F.slice(groups, i, k), " ")

            def windows(i):
                def window(k):
                    # the first start wins, there an unbroken account, then the longest
                    return F.struct(i.alias("i"), F.when(k == 1, 0).otherwise(n + 1 - k).alias("rank"), k.alias("k"), _span(groups, i, k, " ").alias("value"))

                ks = F.sequence(F.lit(1), F.least(n - i + 1, F.lit(IBAN_GROUPS)))
                starts = F.get(groups, i - 1).rlike("^[A-Z]{2}[0-9]{2}")
                return F.filter(F.transform(F.filter(ks, lambda k: starts), window), lambda w: is_iban(w["value"]))

            def split(w):
                head = F.concat(join(F.lit(1), w["i"] - 1), F.when(w["i"] > 1, " ").otherwise(""))
                value = _refill(w["value"], "[^ ]", _let(_only(w["value"], " "), whole))
                return _cut(head, value, F.substr(x, F.length(head) + F.length(w["value"]) + 1, F.length(x)))

            def without(k):
                # no account in the run; a card can start at the first group of digits
                head = F.when(k > 0, join(F.lit(1), k - 1)).otherwise(x)
                return _cut(head, none, F.substr(x, F.length(head) + 1, F.length(x)))

            found = F.array_min(F.flatten(F.transform(F.sequence(F.lit(1), n), windows)))
            digits = F.array_position(F.transform(groups, lambda g: g.rlike("^[0-9]+$")), True).cast("int")
            return _let(found, lambda w: F.when(w.isNull(), _let(digits, without)).otherwise(split(w)))

        return _is(x, "iban"), _let(F.split(x, " "), cut)

    lowers, uppers = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    base26 = "0123456789abcdefghijklmnop"

    def letters(x, kind):
        """Digits, lower-case and upper-case letters, each class permuted in its own places."""
        def low(x):
            new = p.digits(F.translate(_only(x, "[^a-z]"), lowers, base26), 26, 12, kind + "/a")
            return _let(_refill(x, "[a-z]", F.translate(new, base26, lowers)), up)

        def up(x):
            new = p.digits(F.translate(_only(x, "[^A-Z]"), uppers, base26), 26, 12, kind + "/A")
            return _refill(x, "[A-Z]", F.translate(new, base26, uppers))

        def number(x):
            return _let(_refill(x, "[0-9]", p.digits(_only(x, "[^0-9]"), 10, 18, kind)), low)

        return _let(x, number)

    def email(x):
        local = F.split_part(x, F.lit("@"), F.lit(1))
        return _is(x, "email"), F.concat_ws("@", letters(local, "email"), F.split_part(x, F.lit("@"), F.lit(2)))

    def secret(x):
        def new(value):
            is_hex = value.rlike("^[0-9a-f]+$")
            moved = F.when(is_hex, p.digits(value, 16, 15, "hex")).otherwise(letters(value, "secret"))
            return F.concat(F.substr(x, F.lit(1), F.length(x) - F.length(value)), moved)

        return _is(x, "secret"), _let(F.regexp_extract(x, "([A-Za-z0-9]+)$", 1), new)

    def key(x):
        tail = F.lower(F.substr(x, F.lit(5), F.lit(16)))
        return _is(x, "key"), F.concat(F.lit("AKIA"), F.upper(p.digits(tail, 36, 11, "key")))

    def alone(made):
        """A candidate that is one value: all of it is replaced, or nothing."""
        def cut(x):
            valid, new = made(x)
            return valid, _cut(F.lit(""), new, F.lit(""))

        return cut

    return [*map(alone, [secret, key, email]), iban, *map(alone, [phone, intl, ssn, date, ipv4]), card]


def _cut(head: Column, new: Column, tail: Column) -> Column:
    """A candidate as text before a value, the value's pseudonym (null for none) and text behind it."""
    return F.struct(head.alias("head"), new.alias("new"), tail.alias("tail"))


def _swap(x: Column, p: Permuter) -> Column:
    """The cut of a candidate; one without a valid value is all head."""
    out = _cut(x, F.lit(None).cast("string"), F.lit(""))
    for made in reversed(_replacements(p)):
        valid, cut = made(x)
        out = F.when(valid, cut).otherwise(out)
    return out


def _part(text: Column, n: Column, todo: Column) -> Column:
    return F.struct(text.alias("text"), n.cast("int").alias("n"), todo.alias("todo"))


def _search(text: Column, p: Permuter) -> Column:
    """Parts of a text, in order; what is left of runs that were cut is to do."""
    def parts(piece, cut):
        said = F.concat(piece, F.coalesce(cut["head"], F.lit("")))
        new, left = F.coalesce(cut["new"], F.lit("")), F.coalesce(cut["tail"], F.lit(""))
        n = cut["new"].isNotNull().cast("int")
        again = F.array(
            _part(piece, F.lit(0), F.lit(False)), _part(cut["head"], F.lit(0), cut["new"].isNotNull()),
            _part(new, n, F.lit(False)), _part(left, F.lit(0), F.lit(True)),
        )
        is_cut = (left != "") | (cut["new"].isNotNull() & (cut["head"] != ""))
        return F.when(is_cut, again).otherwise(F.array(_part(F.concat(said, new), n, F.lit(False))))

    old = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    # the pieces between the candidates, one more than candidates
    return F.flatten(F.zip_with(F.split(text, ANY, -1), F.transform(old, lambda x: _swap(x, p)), parts))


def _resolve(candidate: Column, p: Permuter) -> Column:
    """A candidate with its values replaced, and how many there were."""

    def turn(parts, _):
        again = F.flatten(F.transform(parts, lambda s: F.when(s["todo"], _search(s["text"], p)).otherwise(F.array(s))))
        return F.when(F.exists(parts, lambda s: s["todo"]), again).otherwise(parts)

    start = F.array(_part(candidate, F.lit(0), F.lit(True)))
    # what is left of a run lacks two digits at least, so all is done after so many turns
    digits = F.length(candidate) - F.length(F.translate(candidate, "0123456789", ""))
    parts = F.aggregate(F.sequence(F.lit(1), F.floor(digits / 2).cast("int") + 2), start, turn)

    def whole(found):
        n = F.aggregate(found, F.lit(0), lambda k, s: k + s["n"])
        return F.struct(F.array_join(F.transform(found, lambda s: s["text"]), "").alias("text"), n.alias("n"))

    return _let(parts, whole)


def pseudonymise(
    df: DataFrame, key: str, text: str = "text", count: str | None = None
) -> DataFrame:
    """Replace the personal data in a text column; ``count`` names a column for the number of replacements."""
    made = fresh(df, "_made")
    p = Permuter(key)
    # the text is searched once; what repeats, repeats inside one candidate
    old = F.regexp_extract_all(F.col(text), F.lit(ANY), F.lit(0))
    rows = df.withColumn(made, F.transform(old, lambda x: _resolve(x, p)))
    # the pieces between the candidates, one more than candidates
    joined = F.zip_with(F.split(F.col(text), ANY, -1), F.col(made), lambda piece, x: F.concat(piece, F.coalesce(x["text"], F.lit(""))))
    changed = F.aggregate(F.col(made), F.lit(0), lambda n, x: n + x["n"])
    columns = {text: F.when(F.coalesce(changed, F.lit(0)) > 0, F.array_join(joined, "")).otherwise(F.col(text))}
    out = [columns.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns]
    if count:
        out.append(F.when(F.col(text).isNull(), 0).otherwise(changed).cast("long").alias(count))
    return rows.select(*out)
