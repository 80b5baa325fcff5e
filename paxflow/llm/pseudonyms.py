"""Personal data: format-preserving Feistel pseudonyms, in DataFrame operations only.

Values are found by one pattern, validated (a card number by its check digit, a date by the calendar,
an address or a number by its ranges) and replaced by a keyed permutation within their format, so a
value becomes another valid value of its kind, equal values become equal pseudonyms in every document,
and whoever has the key can go back. A number ``x = a * B + b`` is split in its two digits and each is
moved, in turn, by a keyed hash of the other: an alternating Feistel network over ``Z_A x Z_B``, which
is a permutation for any two sizes. Names and secrets are moved letter by letter within their class of
characters, each half by a keyed hash of the other.

Repetitions of groups in the patterns are bounded, so a long text does not make the matcher recurse.
Names in scripts beyond Latin-1 have no class to move in and stay; they are not counted as replaced.

Everything happens inside a row: texts are split at the matches, the matches are rewritten, and the
two are joined again. There is no shuffle, so no key can be hot.

| kind | validated by | permuted | kept |
| email | shape | letters and digits of the name | domain, other characters |
| card | 16 digits, Luhn | the 9 digits after the issuer | issuer; the check digit is made anew |
| phone | +country (area) exchange-number | area, exchange, number | country, punctuation |
| ip | four numbers up to 255 | all four | |
| ssn | area, group and serial ranges | all three | punctuation |
| date | the calendar, 1800-01-01 to 2199-12-31 | the day | punctuation, order |
| secret | 20 or more hexadecimal digits, letters and digits, one case | all | |

Defined results: a null text stays null and an empty one empty; repeated rows are treated alike; an
empty table gives an empty result; other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paxflow.llm.common import fresh
from paxflow.llm.quality import let

ROUNDS = 6

# The shapes, and the sizes of the two digits that a value is split in.
SHAPES = {
    "email": r"[\p{L}0-9][\p{L}0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}",
    "phone": r"\+[1-9][0-9]{0,2} ?\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}",
    "card": r"[0-9]{16}",
    "ip": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "date": r"[0-9]{4}-[0-9]{2}-[0-9]{2}",
    "secret": r"(?=[A-Fa-f]*[0-9])(?=[0-9]*[A-Fa-f])(?:[0-9a-f]{20,}|[0-9A-F]{20,})",
}
ORDER = ("email", "phone", "date", "ssn", "card", "ip", "secret")
BEFORE, AFTER = r"(?<![\p{L}0-9_])(?<![0-9][.-])", r"(?![\p{L}0-9_])(?![.-][0-9])"
PATTERN = f"{BEFORE}(?:{'|'.join(SHAPES[k] for k in ORDER)}){AFTER}"
CARD = (10**5, 10**4)
PHONE = (1000, 10**7)
IP = (1 << 16, 1 << 16)
SSN = (898, 99 * 9999)
DATE = (189, 773)
FIRST_DAY = "1800-01-01"
#: First code and number of the lower and upper letters and digits of Latin-1.
CLASSES = ((97, 26), (65, 26), (48, 10), (223, 24), (248, 8), (192, 23), (216, 7))
# End of fixed values.


def keyed(key: str, kind: str, turn: Column, value: Column) -> Column:
    """60 bits of a keyed hash."""
    told = F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), value.cast("string"), F.lit(key))
    return F.conv(F.substring(F.sha2(told, 256), 1, 15), 16, 10).cast("long")


def permuted(value: Column, sizes: tuple[int, int], key: str, kind: str, back: bool = False) -> Column:
    """A permutation of 0 to ``sizes[0] * sizes[1] - 1``; ``back`` undoes it."""
    one, two = (F.lit(x).cast("long") for x in sizes)
    sign = F.lit(-1 if back else 1).cast("long")

    def turn(s: Column, i: Column) -> Column:
        a = F.pmod(s["a"] + sign * F.pmod(keyed(key, kind, i, s["b"]), one), one)
        b = F.pmod(s["b"] + sign * F.pmod(keyed(key, kind, i, s["a"]), two), two)
        even = i % 2 == 0
        return F.struct(
            F.when(even, a).otherwise(s["a"]).alias("a"), F.when(even, s["b"]).otherwise(b).alias("b")
        )

    start = F.struct((value.cast("long") / two).cast("long").alias("a"), (value.cast("long") % two).alias("b"))
    return F.aggregate(turns(back), start, turn, lambda s: s["a"] * two + s["b"])


def moved(part: Column, by: Column, turn: Column, key: str, kind: str, sign: int) -> Column:
    """Each character of ``part`` moved within its class by a keyed hash of ``by``, which is digested
    once, and its place."""

    def one(c: Column, i: Column, digest: Column) -> Column:
        code = F.ascii(c)
        place = F.concat_ws(".", turn.cast("string"), i.cast("string"))

        def step(k: Column) -> Column:
            if kind == "secret":  # one class: the sixteen digits, in the order of their values
                digit = F.when(code > 57, code - 87).otherwise(code - 48)
                new = F.pmod(digit + sign * F.pmod(k, F.lit(16)), F.lit(16))
                return F.when(c == "", c).otherwise(F.lower(F.hex(new)))
            out = c
            for first, n in CLASSES:
                new = F.lit(first) + F.pmod(code - first + sign * F.pmod(k, F.lit(n)), F.lit(n))
                out = F.when(code.between(first, first + n - 1), F.char(new)).otherwise(out)
            return out

        return let(keyed(key, kind, place, digest), step)

    def all_of(digest: Column) -> Column:
        return F.array_join(F.transform(F.split(part, ""), lambda c, i: one(c, i, digest)), "")

    return let(F.sha2(by.cast("binary"), 256), all_of)


def permuted_string(value: Column, key: str, kind: str, back: bool = False) -> Column:
    """A permutation of the strings of the same length and classes of characters."""
    sign = -1 if back else 1
    half = (F.length(value) / 2).cast("int")

    def turn(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        a = moved(s["a"], s["b"], i, key, kind, sign)
        b = moved(s["b"], s["a"], i, key, kind, sign)
        return F.struct(
            F.when(even, a).otherwise(s["a"]).alias("a"), F.when(even, s["b"]).otherwise(b).alias("b")
        )

    start = F.struct(
        F.substr(value, F.lit(1), half).alias("a"),
        F.substr(value, half + 1, F.length(value)).alias("b"),
    )
    return F.aggregate(turns(back), start, turn, lambda s: F.concat(s["a"], s["b"]))


def turns(back: bool) -> Column:
    if back:
        return F.sequence(F.lit(ROUNDS - 1), F.lit(0), F.lit(-1))
    return F.sequence(F.lit(0), F.lit(ROUNDS - 1))


def check_sum(digits: Column) -> Column:
    """Luhn's sum of a card number's digits, every second one doubled from the first on."""
    return F.aggregate(
        F.transform(
            F.split(digits, ""),
            lambda c, i: F.when(c == "", 0)
            .when(i % 2 == 1, c.cast("int"))
            .when(c.cast("int") > 4, 2 * c.cast("int") - 9)
            .otherwise(2 * c.cast("int")),
        ),
        F.lit(0),
        lambda a, x: a + x,
    )


def number(text: Column, start: int, length: int) -> Column:
    return F.substring(text, start, length).cast("long")


def padded(value: Column, length: int) -> Column:
    return F.lpad(value.cast("string"), length, "0")


def card(m: Column, key: str, back: bool) -> Column:
    body = F.concat(F.substring(m, 1, 6), padded(permuted(number(m, 7, 9), CARD, key, "card", back), 9))
    made = let(body, lambda x: F.concat(x, F.pmod(-check_sum(x), F.lit(10)).cast("string")))
    return F.when(check_sum(m) % 10 == 0, made)


def phone(m: Column, key: str, back: bool) -> Column:
    def made(digits: Column) -> Column:
        new = permuted(F.right(digits, F.lit(10)).cast("long"), PHONE, key, "phone", back)
        return let(
            new,
            lambda v: F.concat(
                F.substring_index(m, "(", 1),
                F.lit("("),
                padded((v / PHONE[1]).cast("long"), 3),
                F.regexp_extract(m, r"\)( ?)", 0),
                padded((v % PHONE[1] / 10_000).cast("long"), 3),
                F.lit("-"),
                padded(v % 10_000, 4),
            ),
        )

    return let(F.regexp_replace(m, "[^0-9]", ""), made)


def ip(m: Column, key: str, back: bool) -> Column:
    def made(n: Column) -> Column:
        value = F.aggregate(n, F.lit(0).cast("long"), lambda a, x: a * 256 + x)
        new = permuted(value, IP, key, "ip", back)
        octets = lambda v: [F.shiftright(v, k).bitwiseAND(F.lit(255)) for k in (24, 16, 8, 0)]
        made = let(new, lambda v: F.concat_ws(".", *[x.cast("string") for x in octets(v)]))
        return F.when(F.array_max(n) <= 255, made)

    return let(F.transform(F.split(m, r"\."), lambda x: x.cast("long")), made)


def ssn(m: Column, key: str, back: bool) -> Column:
    area, group, serial = number(m, 1, 3), number(m, 5, 2), number(m, 8, 4)
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    value = place * SSN[1] + (group - 1) * 9999 + serial - 1

    def made(v: Column) -> Column:
        a = (v / SSN[1]).cast("long")
        return F.concat_ws(
            "-",
            padded(F.when(a >= 665, a + 2).otherwise(a + 1), 3),
            padded((v % SSN[1] / 9999).cast("long") + 1, 2),
            padded(v % 9999 + 1, 4),
        )

    return F.when(valid, let(permuted(value, SSN, key, "ssn", back), made))


def date(m: Column, key: str, back: bool) -> Column:
    day = F.try_to_date(m, "yyyy-MM-dd")
    value = F.datediff(day, F.lit(FIRST_DAY).cast("date")).cast("long")
    new = permuted(value, DATE, key, "date", back)
    made = F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), new.cast("int")), "yyyy-MM-dd")
    return F.when((value >= 0) & (value < DATE[0] * DATE[1]), made)


def email(m: Column, key: str, back: bool) -> Column:
    name = F.substring_index(m, "@", 1)
    return F.concat(permuted_string(name, key, "email", back), F.lit("@"), F.substring_index(m, "@", -1))


def secret(m: Column, key: str, back: bool) -> Column:
    new = permuted_string(F.lower(m), key, "secret", back)
    return F.when(m == F.lower(m), new).otherwise(F.upper(new))


def pseudonym(m: Column, key: str, back: bool = False) -> Column:
    """The value that takes the place of a match; null if it is not valid or would stay as it is."""
    out = secret(m, key, back)
    for kind, made in (("ip", ip), ("card", card), ("ssn", ssn), ("date", date), ("phone", phone), ("email", email)):
        out = F.when(m.rlike(f"^(?:{SHAPES[kind]})$"), made(m, key, back)).otherwise(out)
    return let(out, lambda new: F.when(new != m, new))


def replace_values(
    docs: DataFrame, key: str, text_column: str = "text", back: bool = False
) -> tuple[DataFrame, str]:
    """``docs`` with its texts rewritten, and the name of a new column that counts the values that
    changed. ``key`` is the caller's secret: whoever has it can go back.

    ``back`` turns pseudonyms made with the same key into the values they stand for.
    """
    count = fresh(docs, "n_values")
    text = F.col(f"`{text_column}`")
    found = F.transform(F.regexp_extract_all(text, F.lit(PATTERN), 0), lambda m: F.struct(m.alias("m"), pseudonym(m, key, back).alias("new")))
    pieces = F.split(text, PATTERN)
    made = F.struct(
        F.array_join(F.zip_with(pieces, F.transform(found, lambda x: F.coalesce(x["new"], x["m"])), lambda p, m: F.concat(p, F.coalesce(m, F.lit("")))), "").alias("text"),
        F.size(F.filter(found, lambda x: x["new"].isNotNull())).cast("long").alias("n"),
    )
    own = fresh(docs, "rewritten")
    plain = F.struct(text.alias("text"), F.lit(0).cast("long").alias("n"))
    out = docs.withColumn(own, F.when(text.rlike("[0-9@]"), made).otherwise(plain))
    columns = [F.col(f"{own}.text").alias(c) if c == text_column else F.col(f"`{c}`") for c in docs.columns]
    return out.select(*columns, F.col(f"{own}.n").alias(count)), count
