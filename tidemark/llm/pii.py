"""Format-preserving pseudonyms for personal numbers, dates and addresses.

Every validated value is replaced by another of the same format, by a keyed Feistel
permutation of all values of that format: equal values get equal pseudonyms in every
document, different values different ones, and separators stay where they are.

| kind  | validated by               | permuted                                                |
|-------|----------------------------|---------------------------------------------------------|
| card  | 13-19 digits, Luhn sum     | all digits but the last, which is the new Luhn digit    |
| iban  | remainder by 97            | digits of the account part; new check digits            |
| ssn   | area, group, serial ranges | index of (area, group, serial)                          |
| ip    | four numbers up to 255     | the 32-bit address                                      |
| phone | shape, 7-15 digits         | digits after the country code                           |
| date  | calendar, 1900-2099        | day number                                              |
| email | shape                      | letters and digits of the local part, in lower case     |

All of it is Spark SQL expressions over the text itself: one pattern cuts the text
into matches and the pieces between them; nothing is shuffled.

Defined cases: a null text stays null, an empty one empty; a value that fails its
check stays; text outside matches is kept as it is; repeated rows give repeated
rows; other columns are not read by ``pseudonyms``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
DATE_ISO = r"(?<![0-9A-Za-z-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9A-Za-z-])"
DATE_DAY = r"(?<![0-9A-Za-z./])[0-9]{2}([./])[0-9]{2}\1[0-9]{4}(?![0-9A-Za-z/])"
IP = r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])"
SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
CARD = r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z])"
PHONE = (r"(?<![0-9A-Za-z+])(?:\+[0-9]{8,15}|(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4})"
         r"(?![0-9A-Za-z])")
#: In the order in which they are tried at one place; a card is tried before a phone, which is a shorter stretch of digits.
KINDS = {"email": EMAIL, "iban": IBAN, "date_iso": DATE_ISO, "date_day": DATE_DAY, "ip": IP, "ssn": SSN, "card": CARD, "phone": PHONE}
ANY = "|".join(p.replace(r"([./])", r"(?<point>[./])").replace(r"\1", r"\k<point>") for p in KINDS.values())


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _round_value(key: Column, tweak: Column, turn: Column, value: Column) -> Column:
    """60 pseudo-random bits of a round, from a keyed digest."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", key, tweak, turn.cast("string"), value.cast("string")), 256), 1, 15), 16, 10).cast("long")


def feistel(left: Column, right: Column, a: Column, b: Column, key: Column, tweak: Column) -> Column:
    """Permute (left, right) with left < a and right < b: rounds change one side by a keyed value of the other, in turn."""

    def turn(state, i):
        first = i % 2 == 0
        new_left = F.when(first, F.pmod(state["l"] + F.pmod(_round_value(key, tweak, i, state["r"]), a), a)).otherwise(state["l"])
        new_right = F.when(first, state["r"]).otherwise(F.pmod(state["r"] + F.pmod(_round_value(key, tweak, i, state["l"]), b), b))
        return F.struct(new_left.alias("l"), new_right.alias("r"))

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _then(value: Column, use) -> Column:
    """``use`` of a value that is evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _permuted_text(digits: Column, base: int, key: Column, tweak: Column) -> Column:
    """Permute a string of digits of the given base (10 or 36), keeping its length; empty stays empty."""
    n = F.length(digits)
    high = F.ceil(n / 2).cast("int")

    def number(c: Column) -> Column:
        return F.when(F.length(c) == 0, F.lit(0).cast("long")).otherwise(F.conv(c, base, 10).cast("long"))

    def size(k: Column) -> Column:
        return F.round(F.pow(F.lit(float(base)), k)).cast("long") if base != 10 else F.rpad(F.lit("1"), k + 1, "0").cast("long")

    left, right = F.substring(digits, F.lit(1), high), F.substring(digits, high + 1, n - high)
    done = feistel(number(left), number(right), size(high), size(n - high), key, F.concat_ws("/", tweak, n.cast("string")))
    text = lambda v, k: F.when(k == 0, F.lit("")).otherwise(F.lower(F.lpad(F.conv(v.cast("string"), 10, base), k, "0")))
    return F.when(n == 0, digits).otherwise(_then(done, lambda d: F.concat(text(d["l"], high), text(d["r"], n - high))))


def _into(shape: Column, values: Column, member: str) -> Column:
    """Put the characters of ``values`` in the places of ``shape`` that belong to the class ``member``."""
    place = lambda i: F.length(F.regexp_replace(F.substring(shape, F.lit(1), i), f"[^{member}]", ""))
    one = lambda i: F.substring(shape, i, F.lit(1))
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(shape)), lambda i: F.when(one(i).rlike(f"[{member}]"), F.substring(values, place(i), F.lit(1))).otherwise(one(i))), "")


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of digits whose last one is doubled first."""
    backwards = F.split(F.reverse(digits), "")
    values = F.transform(backwards, lambda d, i: F.when(i % 2 == 0, d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)).otherwise(d.cast("int")))
    return F.aggregate(values, F.lit(0), lambda s, v: s + v)


def _luhn_digit(body: Column) -> Column:
    return F.pmod(10 - F.pmod(_luhn_sum(body), F.lit(10)), F.lit(10)).cast("string")


def _remainder97(text: Column) -> Column:
    """Remainder by 97 of letters (10-35) and digits read as one number."""
    ordinal = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    clean = F.split(F.regexp_replace(text, " ", ""), "")
    return F.aggregate(clean, F.lit(0), lambda s, c: F.pmod(s * F.when(c.rlike("[0-9]"), 10).otherwise(100) + ordinal(c), F.lit(97)))


def _card(m: Column, key: Column) -> Column:
    digits = _digits(m)
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    fresh = _then(_permuted_text(body, 10, key, F.lit("card")), lambda b: F.concat(b, _luhn_digit(b)))
    return F.when(_luhn_digit(body) == F.right(digits, F.lit(1)), _then(fresh, lambda f: _into(m, f, "0-9"))).otherwise(m)


def _iban(m: Column, key: Column) -> Column:
    account = F.substring(m, F.lit(5), F.length(m) - 4)
    country = F.substring(m, F.lit(1), F.lit(2))
    moved = lambda part, check: F.concat(part, country, check)
    fresh = _then(_permuted_text(_digits(account), 10, key, F.concat(F.lit("iban"), country)), lambda d: _into(account, d, "0-9"))
    renewed = _then(fresh, lambda part: F.concat(country, F.lpad((98 - _remainder97(moved(part, F.lit("00")))).cast("string"), 2, "0"), part))
    return F.when(_remainder97(moved(account, F.substring(m, F.lit(3), F.lit(2)))) == 1, renewed).otherwise(m)


def _ssn(m: Column, key: Column) -> Column:
    area, group, serial = (F.split(m, "-")[i].cast("int") for i in range(3))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    index = (area - 1 - F.when(area > 666, 1).otherwise(0)) * 99 + group - 1
    done = feistel(index, serial - 1, F.lit(898 * 99).cast("long"), F.lit(9999).cast("long"), key, F.lit("ssn"))

    def written(d: Column) -> Column:
        rank = F.floor(d["l"] / 99) + 1
        new_area = rank + F.when(rank >= 666, 1).otherwise(0)
        pad = lambda v, n: F.lpad(v.cast("string"), n, "0")
        return F.concat_ws("-", pad(new_area, 3), pad(d["l"] % 99 + 1, 2), pad(d["r"] + 1, 4))

    return F.when(valid, _then(done, written)).otherwise(m)


def _ip(m: Column, key: Column) -> Column:
    parts = F.transform(F.split(m, r"\."), lambda p: p.cast("long"))
    half = F.lit(1 << 16).cast("long")
    done = feistel(parts[0] * 256 + parts[1], parts[2] * 256 + parts[3], half, half, key, F.lit("ip"))
    octets = lambda d: F.concat_ws(".", *((F.floor(v / 256) if high else v % 256).cast("string") for v in (d["l"], d["r"]) for high in (True, False)))
    return F.when(F.forall(parts, lambda p: p <= 255), _then(done, octets)).otherwise(m)


def _phone(m: Column, key: Column) -> Column:
    code = F.regexp_extract(m, r"^\+[0-9]{1,3}(?=[ .(-])", 0)
    rest = F.substring(m, F.length(code) + 1, F.length(m))
    digits = _digits(rest)
    valid = F.length(digits).between(7, 15)
    return F.when(valid, F.concat(code, _then(_permuted_text(digits, 10, key, F.lit("phone")), lambda d: _into(rest, d, "0-9")))).otherwise(m)


def _date(m: Column, key: Column, pattern: str) -> Column:
    day = F.try_to_date(m, pattern)
    index = F.date_diff(day, F.lit("1900-01-01").cast("date")).cast("long")
    # 1900-01-01 to 2099-12-31 are 73,049 = 319 * 229 days
    done = feistel(F.floor(index / 229), index % 229, F.lit(319).cast("long"), F.lit(229).cast("long"), key, F.lit("date"))
    fresh = _then(done, lambda d: F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), (d["l"] * 229 + d["r"]).cast("int")), pattern))
    return F.when(day.isNotNull() & index.between(0, 73_048), fresh).otherwise(m)


def _email(m: Column, key: Column) -> Column:
    local, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    plain = F.regexp_replace(F.lower(local), "[^a-z0-9]", "")
    blocks = F.regexp_extract_all(plain, F.lit("[a-z0-9]{1,20}"), F.lit(0))
    fresh = F.array_join(F.transform(blocks, lambda b, i: _permuted_text(b, 36, key, F.concat(F.lit("email"), i.cast("string")))), "")
    return F.concat(_then(fresh, lambda f: _into(local, f, "A-Za-z0-9")), F.lit("@"), domain)


def _pseudonym(m: Column, key: Column) -> Column:
    """The pseudonym of one match."""
    is_kind = lambda pattern: m.rlike(f"^(?:{pattern})$")
    # digits at both ends and no other start decide between the kinds that digits may form
    card = F.when(is_kind(CARD) & (_luhn_digit(F.substring(_digits(m), F.lit(1), F.length(_digits(m)) - 1)) == F.right(_digits(m), F.lit(1))), _card(m, key))
    return (F.when(is_kind(EMAIL), _email(m, key)).when(is_kind(IBAN), _iban(m, key))
            .when(is_kind(DATE_ISO), _date(m, key, "yyyy-MM-dd"))
            .when(is_kind(DATE_DAY), F.when(F.contains(m, F.lit("/")), _date(m, key, "dd/MM/yyyy")).otherwise(_date(m, key, "dd.MM.yyyy")))
            .when(is_kind(IP), _ip(m, key)).when(is_kind(SSN), _ssn(m, key))
            .otherwise(F.coalesce(card, F.when(is_kind(PHONE), _phone(m, key)).otherwise(m))))


def pseudonyms(documents: DataFrame, key: str) -> DataFrame:
    """doc_id, n_found (values of a known shape), n_replaced (values that changed) and the new text of every row."""
    secret = F.lit(key)
    matches = F.when(F.col("text").rlike("[0-9@]"), F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))
    found = documents.select("doc_id", "text", matches.alias("matches"))
    fresh = F.transform("matches", lambda m: _pseudonym(m, secret))
    replaced = found.select("doc_id", "text", "matches", F.when(F.size("matches") > 0, fresh).otherwise(F.col("matches")).alias("fresh"))
    changed = F.size(F.filter(F.zip_with("matches", "fresh", lambda m, f: m != f), lambda c: c)).cast("long")
    pieces = F.split("text", ANY, -1)
    joined = F.array_join(F.zip_with(pieces, F.col("fresh"), lambda p, f: F.concat(p, F.coalesce(f, F.lit("")))), "")
    return replaced.select("doc_id", F.size("matches").cast("long").alias("n_found"), changed.alias("n_replaced"),
                           F.when(F.size("matches") > 0, joined).otherwise(F.col("text")).alias("text"))
