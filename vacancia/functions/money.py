"""Pay expressions. Amounts are DECIMAL(18,2); each function returns a struct."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vacancia.functions.text import col, first_match, strip

AMOUNT = "decimal(18,2)"
RATE = "decimal(18,6)"  # of an amount that is still multiplied
HOURS_PER_YEAR = 2080  # fixed value

# Frequency words, tried in this order.
FREQUENCY_WORDS = (
    ("biweekly", ("biweekly", "bi-weekly")),
    ("annually", ("annually", "annual", "yearly")),
    ("monthly", ("monthly",)),
    ("weekly", ("weekly",)),
    ("daily", ("daily",)),
    ("hourly", ("hourly",)),
)

# Range shapes in order, and whether the amounts are hourly.
RANGE_PATTERNS = (
    (r"\$?([\d,]+\.?\d*)\s*-\s*\$?([\d,]+\.?\d*)\s*(?:USD|per\s+year|annually|/year)", False),
    (r"\$?([\d,]+\.?\d*)\s*-\s*\$?([\d,]+\.?\d*)\s*(?:/hour|per\s+hour|hourly)", True),
    (r"Salary\s+Range:?\s*\$?([\d,]+\.?\d*)\s*-\s*\$?([\d,]+\.?\d*)", False),
)

# Shapes of the wide extractor in order: (pattern, is a range, is hourly).
TYPED_PATTERNS = (
    (r"\$([0-9,.]+)\s*[-–]\s*\$([0-9,.]+)\s*(?:per\s+year|annually|/year)", True, False),
    (r"\$([0-9,.]+)\s*[-–]\s*\$([0-9,.]+)", True, False),
    (r"\$([0-9.]+)\s*[-–]\s*\$([0-9.]+)\s*(?:per\s+hour|/hour|hourly)", True, True),
    (r"salary.*?\$([0-9,.]+)\s*(?:to|-)\s*\$([0-9,.]+)", True, False),
    (r"\$([0-9,.]+)\s*(?:per\s+year|annually|/year)", False, False),
    (r"\$([0-9.]+)\s*(?:per\s+hour|/hour|hourly)", False, True),
)

# Shape of a pay-grade line and of an ``A to B`` range.
GRADE_PATTERN = r"(?i)Grade:?\s*\S+\s*\(([^)]+)\)"
TO_PATTERN = r"(?i)\$?([\d,]+)\s+to\s+\$?([\d,]+)"

# Frequency terms of the parser that does not need a dollar sign.
HOURLY_TERMS = ("hourly", "per hour", "/hour", "hr")
ANNUAL_TERMS = ("annually", "per year", "/year", "annual")


def amount(text: Column, kind: str = AMOUNT) -> Column:
    return F.regexp_replace(text, "[$,]", "").try_cast(kind)


def _any(low: Column, words) -> Column:
    out = F.lit(False)
    for word in words:
        out = out | low.contains(word)
    return out


def pay_frequency(text: Column | str) -> Column:
    low = F.lower(col(text))
    out = F.lit(None).cast("string")
    for name, words in reversed(FREQUENCY_WORDS):
        out = F.when(_any(low, words), name).otherwise(out)
    return out


def _pay(minimum: Column, maximum: Column, frequency: Column) -> Column:
    return F.struct(
        minimum.cast(AMOUNT).alias("minimum"),
        maximum.cast(AMOUNT).alias("maximum"),
        frequency.cast("string").alias("frequency"),
    )



def parse_pay(text: Column | str) -> Column:
    """(minimum, maximum, frequency) of a text such as ``$15.00 Hourly``.

    Only amounts with ``$`` count; a single amount leaves the maximum NULL.
    """
    found = F.regexp_extract_all(col(text), F.lit(r"(\$[\d,]+(?:\.\d+)?)"), F.lit(1))
    numbers = F.filter(F.transform(found, lambda x: amount(x)), lambda x: x.isNotNull())
    return _pay(F.get(numbers, 0), F.get(numbers, 1), pay_frequency(text))


def _both(low: Column, high: Column) -> Column:
    return F.when(low.isNotNull() & high.isNotNull(), F.struct(low.alias("minimum"), high.alias("maximum")))


def annual_range(text: Column | str) -> Column:
    """(minimum, maximum) per year. Hourly ranges count 2080 hours, and are rounded last.

    A shape whose amounts cannot be read gives way to the next shape.
    """
    picks = []
    for pattern, hourly in RANGE_PATTERNS:
        low = amount(F.regexp_extract(col(text), "(?i)" + pattern, 1), RATE)
        high = amount(F.regexp_extract(col(text), "(?i)" + pattern, 2), RATE)
        if hourly:
            low, high = low * HOURS_PER_YEAR, high * HOURS_PER_YEAR
        picks.append(_both(low.cast(AMOUNT), high.cast(AMOUNT)))
    return F.coalesce(*picks)


def to_range(text: Column | str) -> Column:
    """(minimum, maximum) of ``$A to $B``."""
    return _both(
        amount(F.regexp_extract(col(text), TO_PATTERN, 1)),
        amount(F.regexp_extract(col(text), TO_PATTERN, 2)),
    )


def grade_pay(text: Column | str) -> Column:
    """Pay of a ``Grade: H-5 ($a - $b)`` line, hourly by convention; NULL without amounts."""
    pay = parse_pay(first_match(text, GRADE_PATTERN))
    return F.when(
        pay["minimum"].isNotNull(), _pay(pay["minimum"], pay["maximum"], F.lit("hourly"))
    )


def loose_pay(text: Column | str) -> Column:
    """Range or single amount (then minimum = maximum), dollar sign optional."""
    text = F.nullif(col(text), F.lit(""))
    bare = strip(F.regexp_replace(text, "[$,]", ""))
    low = F.lower(text)
    frequency = F.when(_any(low, HOURLY_TERMS), "Hourly").when(_any(low, ANNUAL_TERMS), "Annually")
    shape = r"(\d+(?:\.\d+)?)\s*-\s*(\d+(?:\.\d+)?)"
    first = amount(F.regexp_extract(bare, shape, 1))
    second = amount(F.regexp_extract(bare, shape, 2))
    single = amount(F.regexp_extract(bare, r"(\d+(?:\.\d+)?)", 1))
    return _pay(F.coalesce(first, single), F.coalesce(second, single), frequency)


def typed_pay(text: Column | str) -> Column:
    """(minimum, maximum, type) by six shapes in order, whole dollars.

    Hourly amounts are annualised only under 100; ``competitive`` and ``doe`` override
    the type. A single amount is the whole number that was written.
    """
    text = col(text)
    picks = []
    for pattern, is_range, hourly in TYPED_PATTERNS:
        pattern = "(?is)" + pattern
        first = amount(F.regexp_extract(text, pattern, 1))
        last = amount(F.regexp_extract(text, pattern, 2)) if is_range else first
        if hourly:
            scale = F.when(first < 100, HOURS_PER_YEAR).otherwise(1)
            first, last = first * scale, last * scale
        value = F.struct(
            first.cast("bigint").alias("minimum"), last.cast("bigint").alias("maximum"),
            F.lit("hourly" if hourly else "annual").alias("type"),
        )
        picks.append(F.when(text.rlike(pattern), value))
    found = F.coalesce(*picks)
    kind = (
        F.when(text.rlike("(?i)competitive"), "competitive")
        .when(text.rlike(r"(?i)doe|depends\s+on\s+experience"), "doe")
        .otherwise(found["type"])
    )
    return F.struct(found["minimum"].alias("minimum"), found["maximum"].alias("maximum"), kind.alias("type"))


def trailing_pay(text: Column | str) -> Column:
    """``17.00 - 18.00 Hourly`` or ``17.00 Hourly``, in dollars; other pay in whole dollars."""
    bare = F.regexp_replace(col(text), "[$,]", "")
    shape = r"(?i)(\d+\.?\d*)\s*-\s*(\d+\.?\d*)\s+(Hourly|Annual|Monthly|Weekly)"
    single = r"(?i)(\d+\.?\d*)\s+(Hourly|Annual|Monthly|Weekly)"
    is_range = bare.rlike(shape)
    frequency = F.initcap(
        F.when(is_range, F.regexp_extract(bare, shape, 3)).otherwise(first_match(bare, single, 2))
    )
    low = F.when(is_range, F.regexp_extract(bare, shape, 1)).otherwise(first_match(bare, single, 1))
    high = F.when(is_range, F.regexp_extract(bare, shape, 2)).otherwise(first_match(bare, single, 1))

    def dollars(c: Column) -> Column:
        c = c.try_cast(AMOUNT)
        return F.when(frequency == "Hourly", c).otherwise(F.floor(c).cast(AMOUNT))

    return _pay(dollars(low), dollars(high), frequency)


def single_amount_pay(minimum: Column | str, maximum: Column | str, pay_amount: Column | str,
                      frequency: Column | str) -> Column:
    """A lone pay amount stands in for a missing maximum; frequency in lower case."""
    top = F.nullif(col(maximum).cast(AMOUNT), F.lit(0).cast(AMOUNT))
    return _pay(col(minimum), F.coalesce(top, col(pay_amount).cast(AMOUNT)), F.lower(col(frequency)))
