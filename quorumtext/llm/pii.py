"""PII pseudonyms: validated numbers and dates, keyed-permuted within their format by Feistel networks.

Only DataFrame functions are used. A text without a digit passes through untouched. Found
values are cut out with one pattern, each is validated, and valid ones are replaced by a
keyed bijection of their own format, so equal values get equal pseudonyms in every document
and different values different ones:

* card: 13 to 19 digits, bare or in groups (4-4-4-4 with a last group shorter or one more of
  1 to 3, 4-6-5, 4-6-4) with one kind of separator, Luhn sum right. In a longer run of
  groups each stretch that is a card is one, the longest first; the rest stays. All
  digits but the last are permuted, the last is set so that the sum is right again.
* ipv4: four numbers up to 255. The 32 bits are permuted.
* phone: +1 (ddd) ddd-dddd and alike. The ten digits are permuted; sign, code, separators stay.
* date: yyyy-mm-dd that the calendar has, 1800 to 2199, by itself or before T and a time. The 146097 days are permuted.
* email: letters and digits before the @ are permuted, each within its kind; case, dots and
  the domain stay.

Digit and letter strings: eight rounds, in turn each half's characters are moved around
their alphabet by a keystream, the SHA-256 of key, kind, round and the other half, so every
round can be undone and the whole is a permutation. Numbers: the same with two halves of
a mixed radix.

Edge cases: a null text stays null; an empty one stays empty; values that fail validation
stay as they are; a document may hold any number of values; extra columns are passed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorumtext.runtime import unused

KEY = "quorumtext"
ROUNDS = 8

# What is looked for, in this order. Java regular expressions.
CARD = r"(?<![0-9A-Za-z.+-])[0-9](?:[0-9]{12,18}|[0-9]{3}(?:([ -])[0-9]{4})(?:\1[0-9]{4})+(?:\1[0-9]{1,3})?|[0-9]{3}([ -])[0-9]{6}\2[0-9]{4,5}(?:\2[0-9]{1,4})?)(?![0-9A-Za-z]|[.-][0-9])"
CARD_GROUPS = r"^[0-9]{4}(?:([ -])[0-9]{4}\1[0-9]{4}\1(?:[0-9]{1,4}|[0-9]{4}\1[0-9]{1,3})|([ -])[0-9]{6}\2[0-9]{4,5})$"  # of one card
IPV4 = r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9A-Za-z]|\.[0-9])"
PHONE = r"(?<![0-9A-Za-z])\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9A-Za-z])"
DATE = r"(?<![0-9A-Za-z-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?!(?![Tt][0-9]{2}(?![0-9]))[0-9A-Za-z-])"
EMAIL = r"(?<![0-9A-Za-z._%+-])[0-9A-Za-z][0-9A-Za-z._%+-]{0,63}@(?:[0-9A-Za-z](?:[0-9A-Za-z-]{0,61}[0-9A-Za-z])?\.){1,8}[A-Za-z]{2,24}(?![0-9A-Za-z])"
FOUND = "|".join((EMAIL, PHONE, DATE, CARD, IPV4))

_LETTERS, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
_FIRST_DAY, _DAYS = "1800-01-01", 146097  # four hundred years of the calendar, 189 * 773


def _stream(key: str, kind: str, turn: Column, other: Column, block: Column) -> Column:
    """64 hex digits that depend on all of these."""
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), block.cast("string"), other), 256)


def _shifted(own: Column, other: Column, turn: Column, key: str, kind: str) -> Column:
    """Each letter and digit of ``own`` moved within its alphabet by the keystream of ``other``."""

    def move(i: Column) -> Column:
        c = F.substr(own, i + 1, F.lit(1))
        by = F.conv(F.substr(_stream(key, kind, turn, other, F.floor(i / 16)), (i % 16) * 4 + 1, F.lit(4)), 16, 10).cast("int")
        digit, letter = F.instr(F.lit(_DIGITS), c), F.instr(F.lit(_LETTERS), F.lower(c))
        low = F.substr(F.lit(_LETTERS), (letter - 1 + by) % 26 + 1, F.lit(1))
        moved = F.when(c == F.lower(c), low).otherwise(F.upper(low))
        return F.when(digit > 0, F.substr(F.lit(_DIGITS), (digit - 1 + by) % 10 + 1, F.lit(1))).when(letter > 0, moved).otherwise(c)

    n = F.char_length(own)
    return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), move), "")).otherwise(own)


def permute_string(value: Column, key: str, kind: str) -> Column:
    """Keyed permutation of ASCII strings of one shape: letters stay letters (case too), digits digits, the rest itself."""
    n = F.char_length(value)
    half = F.floor((n + 1) / 2).cast("int")
    state = F.struct(F.substr(value, F.lit(1), half).alias("l"), F.substr(value, half + 1, n).alias("r"))

    def one_round(s: Column, turn: Column) -> Column:
        even = turn % 2 == 0
        return F.struct(F.when(even, _shifted(s["l"], s["r"], turn, key, kind)).otherwise(s["l"]).alias("l"), F.when(even, s["r"]).otherwise(_shifted(s["r"], s["l"], turn, key, kind)).alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), state, one_round, lambda s: F.concat(s["l"], s["r"]))


def permute_number(value: Column, left: int, right: int, key: str, kind: str) -> Column:
    """Keyed permutation of 0 .. left * right - 1."""
    state = F.struct(F.floor(value / right).cast("long").alias("l"), (value % right).cast("long").alias("r"))

    def drawn(other: Column, turn: Column) -> Column:
        return F.conv(F.substr(_stream(key, kind, turn, other.cast("string"), F.lit(0)), F.lit(1), F.lit(12)), 16, 10).cast("long")

    def one_round(s: Column, turn: Column) -> Column:
        even = turn % 2 == 0
        return F.struct(F.when(even, (s["l"] + drawn(s["r"], turn)) % left).otherwise(s["l"]).alias("l"), F.when(even, s["r"]).otherwise((s["r"] + drawn(s["l"], turn)) % right).alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), state, one_round, lambda s: s["l"] * right + s["r"])


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a string of digits whose last one is not doubled."""
    n = F.char_length(digits)

    def part(i: Column) -> Column:
        d = F.ascii(F.substr(digits, n - i, F.lit(1))) - 48
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), part), F.lit(0), lambda a, x: a + x)


def _only_digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, in order, by ``digits``."""
    step = lambda s, c: F.when(c.rlike("^[0-9]$"), F.struct(F.concat(s["out"], F.substr(digits, s["n"], F.lit(1))).alias("out"), (s["n"] + 1).alias("n"))).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["n"].alias("n")))
    return F.aggregate(F.split(shape, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("n")), step, lambda s: s["out"])


def kind_of(value: Column) -> Column:
    """email, phone, date, ipv4 or card if ``value`` is valid as such, else null."""
    day = F.try_to_date(value, "yyyy-MM-dd")
    parts = F.split(value, r"\.")
    return (
        F.when(value.contains("@"), F.lit("email"))
        .when(value.startswith("+"), F.lit("phone"))
        .when(value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.when(day.between(F.lit(_FIRST_DAY).cast("date"), F.lit("2199-12-31").cast("date")), F.lit("date")))
        .when(value.contains("."), F.when(F.forall(parts, lambda p: p.try_cast("int") <= 255), F.lit("ipv4")))
        .when(F.char_length(_only_digits(value)).between(13, 19) & (luhn_sum(_only_digits(value)) % 10 == 0), F.lit("card"))
    )


def pseudonym(value: Column, key: str = KEY) -> Column:
    """The pseudonym of a valid value, in its format; other values as they are."""
    kind = kind_of(value)
    at = F.instr(value, "@")
    mail = F.concat(permute_string(F.substr(value, F.lit(1), at - 1), key, "email"), F.substr(value, at, F.char_length(value)))
    digits = _only_digits(value)
    phone = _refill(F.substr(value, F.lit(3), F.char_length(value)), permute_string(F.substr(digits, F.lit(2), F.lit(10)), key, "phone"))
    days = F.datediff(F.try_to_date(value, "yyyy-MM-dd"), F.lit(_FIRST_DAY).cast("date"))
    date = F.date_format(F.date_add(F.lit(_FIRST_DAY).cast("date"), permute_number(days, 189, 773, key, "date").cast("int")), "yyyy-MM-dd")
    number = F.aggregate(F.split(value, r"\."), F.lit(0).cast("long"), lambda a, p: a * 256 + p.cast("long"))
    shuffled = F.array(permute_number(number, 65536, 65536, key, "ipv4"))
    address = F.element_at(F.transform(shuffled, lambda x: F.concat_ws(".", F.floor(x / 16777216).cast("string"), (F.floor(x / 65536) % 256).cast("string"), (F.floor(x / 256) % 256).cast("string"), (x % 256).cast("string"))), 1)
    body = F.array(permute_string(F.substr(digits, F.lit(1), F.char_length(digits) - 1), key, "card"))
    card = F.element_at(F.transform(body, lambda x: _refill(value, F.concat(x, ((F.lit(10) - luhn_sum(F.concat(x, F.lit("0"))) % 10) % 10).cast("string")))), 1)
    return F.when(kind == "email", mail).when(kind == "phone", F.concat(F.lit("+1"), phone)).when(kind == "date", date).when(kind == "ipv4", address).when(kind == "card", card).otherwise(value)


def parts_of(value: Column) -> Column:
    """A run of digit groups as the cards in it, the other groups and the separators; other values as one part."""
    groups, gap = F.split(value, "[ -]"), F.regexp_extract(value, "[ -]", 0)
    n = F.size(groups)
    none = F.array().cast("array<string>")

    def step(s: Column, i: Column) -> Column:
        stretch = lambda k: F.replace(F.array_join(F.slice(groups, i + 1, F.lit(k) if isinstance(k, int) else k), " "), F.lit(" "), gap)
        fits = lambda k: (i + k <= n) & stretch(k).rlike(CARD_GROUPS) & (kind_of(stretch(k)) == "card")
        size = F.when(fits(5), 5).when(fits(4), 4).when(fits(3), 3).otherwise(1)
        put = F.transform(F.array(size), lambda k: F.struct((i + k).cast("int").alias("to"), F.concat(s["out"], F.when(i > 0, F.array(gap)).otherwise(none), F.array(stretch(k))).alias("out")))
        return F.when(i < s["to"], s).otherwise(F.element_at(put, 1))

    start = F.struct(F.lit(0).alias("to"), none.alias("out"))
    run = F.aggregate(F.sequence(F.lit(0), n - 1), start, step, lambda s: s["out"])
    return F.when(value.rlike("^[0-9]{4}[ -][0-9 -]*$") & ~value.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), run).otherwise(F.array(value))


def pseudonymise(docs: DataFrame, text: str = "text", key: str = KEY) -> DataFrame:
    """``docs`` with its texts' values replaced and ``pii``, the number of each kind (a column of that name is replaced)."""
    found, new = (unused(docs.columns, c) for c in ("found", "new"))
    had = docs.withColumn(found, F.when(F.col(text).rlike("[0-9@]"), F.regexp_extract_all(F.col(text), F.lit(FOUND), F.lit(0))).otherwise(F.array().cast("array<string>")))
    some = F.size(found) > 0
    swapped = had.withColumn(new, F.transform(F.transform(found, parts_of), lambda v: F.struct(F.transform(v, kind_of).alias("kinds"), F.array_join(F.transform(v, lambda x: pseudonym(x, key)), "").alias("value"))))
    pieces = F.zip_with(F.split(F.col(text), FOUND, -1), F.col(new), lambda p, n: F.concat(p, F.coalesce(n["value"], F.lit(""))))
    count = lambda k: F.size(F.filter(F.flatten(f"{new}.kinds"), lambda n: n == k)).alias(k)
    kinds = F.struct(*[count(k) for k in ("card", "ipv4", "phone", "date", "email")])
    return swapped.withColumns({text: F.when(some, F.array_join(pieces, "")).otherwise(F.col(text)), "pii": kinds}).drop(found, new)


def op7_pii(spark, sf_dir: str) -> DataFrame:
    """All documents with pseudonyms, and what was replaced."""
    from quorumtext.runtime import table

    out = pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "text", *[F.col(f"pii.{k}").alias(f"n_{k}") for k in ("card", "ipv4", "phone", "date", "email")])
