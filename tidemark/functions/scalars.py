"""Ingest expressions: keys, urls, dates, salaries, lists and enums.

Everything here builds a Column from Columns, so plans stay inside code
generation. Casts are ``try_`` casts: under ANSI mode a bad value is null, not a
failed job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_MAX = 2**31 - 1
VND_PER_USD = 25_000.0

# How many monthly amounts one amount of a period makes, and the
# least monthly amount that can be a salary.
PERIODS = {"MONTHLY": 1.0, "YEARLY": 1 / 12, "WEEKLY": 52 / 12, "DAILY": 22.0, "HOURLY": 176.0}
FLOOR = {"VND": 2_000_000, "USD": 80}


def first_filled(*values: Column) -> Column:
    """The first value that is neither null nor blank, trimmed."""
    return F.coalesce(*[F.nullif(F.trim(v), F.lit("")) for v in values])


def natural_key(url: Column) -> Column:
    """Hex SHA-256 of the url; null for a null url."""
    return F.sha2(url, 256)


def stamp(clock: Column) -> Column:
    return F.date_format(clock, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def canonical_url(url: Column, policy: str = "bare") -> Column:
    """``bare`` drops query and fragment, ``no_query`` the query and what
    follows, ``keep`` nothing."""
    cut = {"bare": "[?#].*$", "no_query": r"\?.*$"}
    return url if policy == "keep" else F.regexp_replace(url, cut[policy], "")


def host(url: Column) -> Column:
    """Authority in lower case without a leading ``www.``; port kept."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), r"^www\.", "")


def days_since(day: Column, today: Column, clamp: bool = False, prefix: bool = False) -> Column:
    """Days from an ISO date to ``today``; null if unparseable. ``prefix`` reads
    the first ten characters of a timestamp, ``clamp`` floors at 0."""
    whole = F.when(F.length(day) >= 10, F.substring(day, 1, 10)) if prefix else F.when(day.rlike(r"^\d{4}-\d{2}-\d{2}$"), day)
    days = F.datediff(today, F.try_to_timestamp(whole, F.lit("yyyy-MM-dd")).cast("date"))
    return F.when(days < 0, 0).otherwise(days) if clamp else days


def days_since_epoch_ms(millis: Column, now: Column) -> Column:
    """Whole days since an epoch in milliseconds; null if in the future."""
    days = F.floor((now.cast("double") - millis / 1000) / 86_400)
    return F.when((days >= 0) & (days <= INT_MAX), days.cast("int"))


def years_of(months: Column) -> Column:
    return F.floor(months / 12).cast("int")


def bounded_int(value: Column) -> Column:
    """A positive int, truncated; null if unparseable or beyond 32 bits."""
    number = F.floor(value.try_cast("double"))
    return F.when((number > 0) & (number <= INT_MAX), number.cast("int"))


def to_usd(amount: Column, currency: Column, rate: float = VND_PER_USD) -> Column:
    """Whole USD, halves to even; null unless positive."""
    value = amount.try_cast("double")
    usd = F.bround(value / F.when(F.upper(currency) == "USD", 1.0).otherwise(F.lit(rate)))
    return F.when(value > 0, usd.cast("int"))


@dataclass(frozen=True)
class Salary:
    """Columns of a classified salary."""

    kind: Column
    low: Column
    high: Column

    def struct(self) -> Column:
        return F.struct(self.kind.alias("salary_type"), self.low.alias("salary_min"), self.high.alias("salary_max"))


def classify_salary(low: Column, high: Column, single: Column | None = None, equal_is_fixed: bool = True) -> Salary:
    """Type and bounds. ``single`` is used when both bounds are missing.
    Sources differ on equal bounds: FIXED, or still a RANGE."""
    if single is not None:
        alone = low.isNull() & high.isNull()
        low, high = F.when(alone, single).otherwise(low), F.when(alone, single).otherwise(high)
        fixed = (low == high) if equal_is_fixed else alone
    else:
        fixed = (low == high) if equal_is_fixed else F.lit(False)
    both = low.isNotNull() & high.isNotNull()
    kind = (
        F.when(both & fixed, "FIXED").when(both, "RANGE").when(low.isNotNull(), "FROM")
        .when(high.isNotNull(), "UP_TO").otherwise("NEGOTIABLE")
    )
    return Salary(kind, low, high)


def salary_by_period(low: Column, high: Column, period: Column, currency: Column) -> Salary:
    """Monthly amounts in the stated currency; implausible ones are dropped."""
    pairs = [x for name, factor in PERIODS.items() for x in (F.lit(name), F.lit(factor))]
    factor = F.try_element_at(F.create_map(*pairs), F.upper(F.coalesce(period, F.lit(""))))
    least = F.when(F.upper(currency) == "USD", FLOOR["USD"]).otherwise(FLOOR["VND"])

    def monthly(amount: Column) -> Column:
        value = F.bround(amount.try_cast("double") * factor)
        return F.when((amount.try_cast("double") > 0) & value.between(1, INT_MAX) & (value >= least), value.cast("int"))

    a, b = monthly(low), monthly(high)
    both = a.isNotNull() & b.isNotNull()
    kind = (
        F.when(both & (b > a), "RANGE").when(both, "FIXED").when(a.isNotNull(), "FROM")
        .when(b.isNotNull(), "UP_TO").otherwise("NEGOTIABLE")
    )
    return Salary(kind, a, b)


def salary_of_text(text: Column) -> Column:
    """struct(low, high, currency) from a displayed salary: numbers lose their
    separators, a million word scales them, direction words leave one bound."""
    shown = F.lower(text)
    usd = F.contains(shown, F.lit("usd")) | F.contains(text, F.lit("$"))
    million = shown.rlike(r"(?iuU)\b(tr|tr\.|triệu|trieu|million)\b")
    scale = F.when(~usd & million, 1e6).otherwise(1.0)
    numbers = F.filter(
        F.transform(
            F.regexp_extract_all(text, F.lit(r"\d[\d.,]*"), F.lit(0)),
            lambda x: bounded_int(F.regexp_replace(x, "[.,]", "").try_cast("double") * scale),
        ),
        lambda x: x.isNotNull(),
    )
    two, one = F.slice(numbers, 1, 2), F.get(numbers, 0)
    up = F.contains(shown, F.lit("trên")) | F.contains(shown, F.lit("từ"))
    down = F.contains(shown, F.lit("đến")) | F.contains(shown, F.lit("tới")) | F.contains(shown, F.lit("dưới"))
    many = F.size(numbers) >= 2
    return F.struct(
        F.when(many, F.array_min(two)).when(up | ~down, one).alias("low"),
        F.when(many, F.array_max(two)).when(~up, one).alias("high"),
        F.when(F.size(numbers) > 0, F.when(usd, "USD").otherwise("VND")).alias("currency"),
    )


# The words by which sources state where work is done, in the
# order in which they are tried.
ARRANGEMENT_WORDS = {"at office": "AT_OFFICE", "remote": "REMOTE", "hybrid": "HYBRID"}
ARRANGEMENT_PHRASES = {
    "HYBRID": r"\bhybrid\b|làm việc kết hợp|kết hợp tại nhà",
    "REMOTE": r"\bfully\s+remote\b|\b100\s*%\s*remote\b|\bremote(?:ly)?\s+(?:work|working|job|position|role)\b"
    r"|\bwork(?:ing)?\s+(?:remotely|from\s+home)\b|\bwfh\b|làm việc từ xa|làm việc tại nhà|làm việc online",
}


def arrangement_by_words(text: Column, words: dict[str, str] | None = None, default: str = "AT_OFFICE") -> Column:
    """The value of the first word, in the order given, that the text holds."""
    found = F.lit(None).cast("string")
    for word, value in reversed((words or ARRANGEMENT_WORDS).items()):
        found = F.when(F.contains(F.lower(text), F.lit(word)), value).otherwise(found)
    return F.coalesce(found, F.lit(default))


def arrangement_by_phrases(text: Column) -> Column:
    found = F.lit("AT_OFFICE")
    for value, pattern in reversed(ARRANGEMENT_PHRASES.items()):
        found = F.when(text.rlike(f"(?iuU){pattern}"), value).otherwise(found)
    return found


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def csv_items(text: Column, distinct: bool = True) -> Column:
    items = F.filter(F.transform(F.split(text, ","), collapse), lambda x: x != "")
    return F.coalesce(F.array_distinct(items) if distinct else items, F.array().cast("array<string>"))


def bullet_lines(text: Column) -> Column:
    """Lines without the bullets around them; empty lines dropped."""
    strip = lambda x: F.trim(F.trim(x, F.lit(" -•*\t\r")))
    return F.filter(F.transform(F.split(text, "\n"), strip), lambda x: x != "")


def unclip(snippet: Column, marker: str) -> Column:
    """Markup and runs of space out; clipped text ends in ``marker``."""
    plain = collapse(F.regexp_replace(snippet, "<[^>]+>", " "))
    clipped = plain.rlike(r"…|\.\.\.\s*$")
    cut = F.trim(F.regexp_replace(plain, r"…|\.\.\.\s*$", ""))
    return F.nullif(F.when(clipped, F.concat(cut, F.lit(" " + marker))).otherwise(plain), F.lit(""))


# Publisher labels of level and kind.
LEVELS = {"beginner": "INTRO", "intermediate": "WORKING", "advanced": "DEEP"}
KINDS = {"module": "MODULE", "learningPath": "LEARNING_PATH"}


def mapped(value: Column, table: dict[str, str], default: str = "UNKNOWN") -> Column:
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), F.lit(default))


def or_empty(items: Column, kind: str = "string") -> Column:
    """An empty array where there is none."""
    return F.coalesce(items, F.array().cast(f"array<{kind}>"))


def first_nonempty(*lists: Column) -> Column:
    """The first array that has an item, else an empty one."""
    return or_empty(F.coalesce(*[F.when(F.size(x) > 0, x) for x in lists]))
