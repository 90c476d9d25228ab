"""Personal data: validated numbers, dates and addresses become pseudonyms of their format.

Method. Every value goes through a keyed Feistel network whose state is the value itself:
the two halves shift each other, round by round, by amounts taken from SHA-256 of the
key, the kind, the round and the other half. That permutes the values of a format, so
equal values get equal pseudonyms in every document, different values get different
ones, and the key's owner can turn them back.

- Text values (mail, phone, card, bank account): each character moves within its own
  class (digits, small letters, capitals), so the format stays. Phone digits 0-1 and 2-9
  are classes of their own, so that area codes stay valid. Check digits of cards (Luhn)
  and of bank accounts (mod 97) are computed anew. Cards and accounts are permuted without
  their separators and written back between them, so that a number has one pseudonym
  however it is grouped; an account in small letters has that of its capitals.
- Ranged values (IPv4 address, social security number, date): the value is a number below
  ``a * b``; quotient and remainder are the halves. 1800-2199 has 146,097 = 189 * 773 days.
  A day has one pseudonym in all layouts: days after the 12th of a month go to such days and
  the others to others, so that what tells ``25/12`` from ``12/25`` stays.

In a run of digit groups a card starts at the run's first group or at one that begins with
3 to 6, as payment cards do, has four digits or more in its first group, and is the longest
run of whole groups of 13 to 19 digits with a Luhn check digit. One that begins inside an
earlier one is left out.

Values that fail validation (no Luhn check digit, an octet over 255, the 30th of
February, a date outside 1800-2199) are not personal data by these rules and stay.

Everything is built-in functions; each row is judged alone, nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.shared import session, unused

ROUNDS = 8

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++){1,8}"
IPV4 = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])"
PHONE = (
    r"\+[1-9](?:[ .()-]{0,2}[0-9]){7,14}(?![0-9])"
    r"|(?<![0-9(-])\([2-9][0-9]{2}\) ?[0-9]{3}-[0-9]{4}(?![0-9-])"
    r"|(?<![0-9-])[2-9][0-9]{2}-[0-9]{3}-[0-9]{4}(?![0-9-])"
)
IBAN = (
    r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])"
    r"|(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,4})?(?![A-Za-z0-9])"
    r"|(?<![A-Za-z0-9])[a-z]{2}[0-9]{2}[a-z0-9]{11,30}(?![A-Za-z0-9])"
    r"|(?<![A-Za-z0-9])[a-z]{2}[0-9]{2}(?: [a-z0-9]{4}){2,7}(?: [a-z0-9]{1,4})?(?![A-Za-z0-9])"
)
DATE = (
    r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])"
    r"|(?<![0-9./])[0-9]{2}\.[0-9]{2}\.[0-9]{4}(?![0-9])"
    r"|(?<![0-9./])[0-9]{2}/[0-9]{2}/[0-9]{4}(?![0-9])"
    r"|(?<![0-9./])[0-9]{4}/[0-9]{2}/[0-9]{2}(?![0-9/])"
)
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
# A whole run of digit groups, up to a blank or hyphen before another kind of value.
CARD = rf"(?<![0-9])[0-9](?:(?:[ -](?!{DATE}|{SSN}|{PHONE}))?[0-9]){{12,}}+(?![0-9])"
CARD_GROUPS = 19  # no card has more digits, nor more groups
ANY = "|".join([EMAIL, IPV4, PHONE, IBAN, DATE, SSN, CARD])

DIGITS = [("0", "9")]
LETTERS = [("0", "9"), ("a", "z"), ("A", "Z")]
PHONE_DIGITS = [("0", "1"), ("2", "9")]

FIRST_DAY, DAYS = "1800-01-01", (189, 773)


def _digest(key: str, kind: str, turn: Column, half: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), half), 256)


def _shift(part: Column, digest: Column, classes: list[tuple[str, str]]) -> Column:
    """Move each character within its class by a byte of the digest."""

    def moved(c: Column, j: Column) -> Column:
        amount = F.conv(F.substr(digest, (j % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int")
        out = c
        for low, high in classes:
            first, size = ord(low), ord(high) - ord(low) + 1
            out = F.when(
                c.between(low, high), F.char(((F.ascii(c) - first + amount) % size) + first)
            ).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(part, ""), moved), "")


def permute_text(
    value: Column, key: str, kind: str, classes: list[tuple[str, str]] = LETTERS
) -> Column:
    """Feistel over the characters: a permutation of all texts of the value's format."""
    half = F.floor(F.length(value) / 2).cast("int")

    def turn(state: Column, i: Column) -> Column:
        left, right = F.substr(state, F.lit(1), half), F.substr(state, half + 1)
        return F.when(
            i % 2 == 0, F.concat(_shift(left, _digest(key, kind, i, right), classes), right)
        ).otherwise(F.concat(left, _shift(right, _digest(key, kind, i, left), classes)))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), value, turn)


def permute_number(value: Column, key: str, kind: str, a: int, b: int) -> Column:
    """Feistel over a whole number below ``a * b``."""

    def turn(state: Column, i: Column) -> Column:
        left, right = F.floor(state / b).cast("bigint"), state % b
        amount = lambda half: F.conv(
            F.substr(_digest(key, kind, i, half.cast("string")), F.lit(1), F.lit(12)), 16, 10
        ).cast("bigint")
        return F.when(i % 2 == 0, ((left + amount(right)) % a) * b + right).otherwise(
            left * b + (right + amount(left)) % b
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), value.cast("bigint"), turn)


def _luhn_sum(digits: Column, first_doubled: int) -> Column:
    """Luhn sum of digits from the right; ``first_doubled``: 1 leaves the last one plain."""

    def worth(c: Column, j: Column) -> Column:
        d = c.cast("int")
        double = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(j % 2 == first_doubled, double).otherwise(d)

    return F.aggregate(
        F.transform(F.split(F.reverse(digits), ""), worth), F.lit(0), lambda s, x: s + x
    )


def _only_digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _longest(value: Column, least: int, border: str, valid, moved) -> Column:
    """The longest valid prefix that ends at a border, moved, and the rest; else the value."""
    ends = F.filter(
        F.sequence(F.lit(least), F.greatest(F.length(value), F.lit(least))),
        lambda k: F.substr(value, k, F.lit(2)).rlike(border) & valid(F.substr(value, F.lit(1), k)),
    )
    return F.transform(
        F.array(F.array_max(ends)),
        lambda k: F.when(k.isNull(), value).otherwise(
            F.concat(moved(F.substr(value, F.lit(1), k)), F.substr(value, k + 1))
        ),
    )[0]


def _laid_out(plain: Column, template: Column) -> Column:
    """The characters of ``plain`` in the places that are no blank or hyphen in the template."""
    placed = F.aggregate(
        F.split(template, ""),
        F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda s, c: F.when(
            c.isin(" ", "-"), F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"))
        ).otherwise(
            F.struct(
                F.concat(s["out"], F.substr(plain, s["at"], F.lit(1))).alias("out"),
                (s["at"] + 1).alias("at"),
            )
        ),
    )
    return placed["out"]


def _card(value: Column, key: str) -> Column:
    """The cards of a run of digit groups, moved; all else stays. Groups see 18 neighbours each."""
    groups = F.regexp_extract_all(value, F.lit("[0-9]+[ -]?"), F.lit(0))

    def last(x: Column, g: Column, of: Column) -> Column:
        """Number of the last group of the longest card that starts at group ``g``, or null."""

        def ends_card(e: Column) -> Column:
            digits = _only_digits(F.array_join(F.slice(of, g + 1, e - g + 1), ""))
            return F.length(digits).between(13, 19) & (_luhn_sum(digits, 1) % 10 == 0)

        starts = x.rlike("^[0-9]{4}") & ((g == 0) | x.rlike("^[3-6]"))
        until = F.least(g + CARD_GROUPS - 1, F.size(of) - 1)
        return F.when(starts, F.array_max(F.filter(F.sequence(g, until), ends_card)))

    def written(x: Column, g: Column, of: Column, ends: Column) -> Column:
        """The group, or the whole card in place of its first group."""
        before = F.sequence(F.greatest(g - CARD_GROUPS, F.lit(0)), g)
        first = F.filter(before, lambda s: F.coalesce(F.get(ends, s) >= g, F.lit(False)))
        # A card counts if no other reaches over its first group.
        counted = F.filter(
            first,
            lambda s: ~F.exists(
                F.sequence(F.greatest(s - CARD_GROUPS, F.lit(0)), s),
                lambda r: (r < s) & F.coalesce(F.get(ends, r) >= s, F.lit(False)),
            ),
        )
        whole = F.array_join(F.slice(of, g + 1, F.get(ends, g) - g + 1), "")
        return (
            F.when(F.size(counted) == 0, x)
            .when(F.get(counted, F.lit(0)) == g, _moved_card(whole, key))
            .otherwise(F.lit(""))
        )

    # One name for the groups and one for the ends, so that neither is worked out per group.
    return F.transform(
        F.array(groups),
        lambda of: F.transform(
            F.array(F.transform(of, lambda x, g: last(x, g, of))),
            lambda ends: F.when(
                F.exists(ends, lambda e: e.isNotNull()),
                F.array_join(F.transform(of, lambda x, g: written(x, g, of, ends)), ""),
            ).otherwise(value),
        )[0],
    )[0]


def _moved_card(value: Column, key: str) -> Column:
    """All digits but the first and the check digit move; then the check digit is set."""

    def moved(digits: Column) -> Column:
        body = F.concat(
            F.substr(digits, F.lit(1), F.lit(1)),
            permute_text(F.substr(digits, F.lit(2), F.length(digits) - 2), key, "card", DIGITS),
        )
        check = lambda b: (F.lit(10) - _luhn_sum(b, 0) % 10) % 10
        return F.transform(F.array(body), lambda b: F.concat(b, check(b).cast("string")))[0]

    return F.transform(F.array(moved(_only_digits(value))), lambda x: _laid_out(x, value))[0]


def _mod_97(value: Column) -> Column:
    """The account number, country and check digits last, as a number modulo 97."""
    value = F.upper(F.replace(value, F.lit(" "), F.lit("")))
    turned = F.concat(F.substr(value, F.lit(5)), F.substr(value, F.lit(1), F.lit(4)))
    return F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda s, c: F.when(c.between("0", "9"), (s * 10 + F.ascii(c) - 48) % 97).otherwise(
            (s * 100 + F.ascii(c) - 55) % 97
        ),
    )


def _iban(value: Column, key: str) -> Column:
    """The longest run of whole groups that is an account; blanks and what follows stay."""

    def valid(x: Column) -> Column:
        plain = F.replace(x, F.lit(" "), F.lit(""))
        return F.length(plain).between(15, 34) & (_mod_97(x) == 1)

    def moved(x: Column) -> Column:
        plain = F.upper(F.replace(x, F.lit(" "), F.lit("")))
        country = F.substr(plain, F.lit(1), F.lit(2))
        whole = F.transform(
            F.array(permute_text(F.substr(plain, F.lit(5)), key, "iban")),
            lambda body: F.concat(
                country,
                F.lpad((F.lit(98) - _mod_97(F.concat(country, F.lit("00"), body))).cast("string"), 2, "0"),
                body,
            ),
        )
        cased = F.transform(whole, lambda w: F.when(x == F.upper(x), w).otherwise(F.lower(w)))
        return F.transform(cased, lambda w: _laid_out(w, x))[0]

    found = _longest(value, 15, "^[A-Za-z0-9](?: |$)", valid, moved)
    rest = F.substr(value, F.lit(6))  # a word like an account's first may precede a card
    return F.when((found == value) & rest.rlike(f"^(?:{CARD})$"),
        F.concat(F.substr(value, F.lit(1), F.lit(5)), _card(rest, key))).otherwise(found)


def _phone(value: Column, key: str) -> Column:
    """The country code stays: the digits up to the first separator, or the first one."""
    code = F.regexp_extract(value, r"^(?:\+[0-9]{1,3}(?=[ .()-])|\+1|\+[0-9])", 0)
    rest = F.substr(value, F.length(code) + 1)
    return F.concat(code, permute_text(rest, key, "phone", PHONE_DIGITS))


def _email(value: Column, key: str) -> Column:
    """The local part moves, the domain stays."""
    local = F.regexp_extract(value, "^[^@]+", 0)
    return F.concat(
        permute_text(local, key, "email"), F.substr(value, F.length(local) + 1)
    )


def _ipv4(value: Column, key: str) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda x: x.cast("bigint"))
    number = F.aggregate(parts, F.lit(0).cast("bigint"), lambda s, x: s * 256 + x)
    moved = permute_number(number, key, "ipv4", 1 << 16, 1 << 16)
    # The network permutes numbers; octets are read off once.
    octets = F.transform(
        F.array(moved),
        lambda n: F.concat_ws(
            ".", *[(F.shiftright(n, 24 - 8 * k) % 256).cast("string") for k in range(4)]
        ),
    )
    return F.when(F.exists(parts, lambda x: x > 255), value).otherwise(octets[0])


def _ssn(value: Column, key: str) -> Column:
    """Areas 001-899 without 666, groups 01-99, serials 0001-9999."""
    area, group, serial = (
        F.substr(value, F.lit(at), F.lit(n)).cast("bigint") for at, n in ((1, 3), (5, 2), (8, 4))
    )
    number = ((area - 1 - (area > 666).cast("int")) * 99 + group - 1) * 9999 + serial - 1
    moved = permute_number(number, key, "ssn", 898 * 99, 9999)

    def text(n: Column) -> Column:
        place = F.floor(n / (99 * 9999)).cast("bigint") + 1
        return F.format_string(
            "%03d-%02d-%04d",
            place + (place >= 666).cast("int"),
            F.floor(n / 9999).cast("bigint") % 99 + 1,
            n % 9999 + 1,
        )

    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    return F.when(valid, F.transform(F.array(moved), text)[0]).otherwise(value)


def _date(value: Column, key: str) -> Column:
    a, b = DAYS
    first = F.lit(FIRST_DAY).cast("date")

    def late(n: Column) -> Column:
        return F.dayofmonth(F.date_add(first, n.cast("int"))) > 12

    def moved(day: Column) -> Column:
        """Repeated until days after the 12th meet one again, and the others one of theirs."""
        step = lambda n: permute_number(n, key, "date", a, b)
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(64)),
            step(day),
            lambda n, _: F.when(late(n) == late(day), n).otherwise(step(n)),
        ).cast("int")

    def written_as(layout: str) -> Column:
        return F.transform(
            F.array(F.datediff(F.try_to_date(value, layout), first)),
            lambda day: F.when(
                day.between(0, a * b - 1), F.date_format(F.date_add(first, moved(day)), layout)
            ).otherwise(value),
        )[0]

    return (
        F.when(value.contains("-"), written_as("yyyy-MM-dd"))
        .when(value.contains("."), written_as("dd.MM.yyyy"))
        .when(value.rlike("^[0-9]{4}/"), written_as("yyyy/MM/dd"))
        .when(F.try_to_date(value, "MM/dd/yyyy").isNotNull(), written_as("MM/dd/yyyy"))
        .otherwise(written_as("dd/MM/yyyy"))
    )


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one matched value; the value itself where validation fails."""
    whole = lambda pattern: value.rlike(f"^(?:{pattern})$")
    return (
        F.when(value.contains("@"), _email(value, key))
        .when(whole(IPV4), _ipv4(value, key))
        .when(whole(PHONE), _phone(value, key))
        .when(whole(IBAN), _iban(value, key))
        .when(whole(DATE), _date(value, key))
        .when(whole(SSN), _ssn(value, key))
        .otherwise(_card(value, key))
    )


def pseudonymise(
    docs: DataFrame, key: str, text: str = "text", count: str | None = None
) -> DataFrame:
    """The rows with personal data in ``text`` replaced; all columns stay as they are.

    ``count`` names an added column with the number of values replaced. Null texts stay
    null (count 0), empty ones empty; texts of any length are read whole; rows are judged
    each for itself, so ties and repeated rows stay; a clashing column of the name
    ``count`` is replaced.
    """
    session(docs)
    source = F.col(f"`{text}`")
    values = F.regexp_extract_all(source, F.lit(ANY), F.lit(0))
    between = F.split(source, ANY, -1)

    def replaced(found: Column) -> Column:
        return F.array_join(
            F.flatten(
                F.zip_with(between, found, lambda b, v: F.array(b, F.coalesce(v, F.lit(""))))
            ),
            "",
        )

    has = source.rlike("[0-9@]")  # all kinds hold one of these; most texts hold none
    names = [c for c in docs.columns if c != count]
    values_name = unused(docs, "_found_values")
    marked = docs.select(
        *[F.col(f"`{c}`") for c in names],
        F.when(has, F.transform(values, lambda v: F.struct(v.alias("old"), pseudonym(v, key).alias("new"))))
        .alias(values_name),
    )
    found = F.col(values_name)
    out = [
        F.when(F.size(found) > 0, replaced(F.transform(found, lambda x: x["new"])))
        .otherwise(source)
        .alias(text)
        if c == text
        else F.col(f"`{c}`")
        for c in names
    ]
    if count is not None:
        changed = F.size(F.filter(found, lambda x: x["old"] != x["new"]))
        out.append(F.greatest(F.coalesce(changed, F.lit(0)), F.lit(0)).cast("bigint").alias(count))
    return marked.select(*out)


def with_length(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """The same rows; where there is a column of text lengths, it follows the texts."""
    if length not in docs.columns:
        return docs
    kind = docs.schema[length].dataType
    return docs.withColumn(length, F.coalesce(F.char_length(text).cast(kind), F.col(length)))
