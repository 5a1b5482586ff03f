"""Pay: every parser returns a compensation struct, or null where there is none."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacancia.functions.text import first_match, let, non_empty, rx, strip
from vacancia.lookups import lookup
from vacancia.schema import COMPENSATION_DDL, compensation

# Pay periods per year.
PERIODS_PER_YEAR = {"hourly": 2080, "daily": 260, "weekly": 52, "monthly": 12}

# Unit words of structured sources.
BOARD_UNITS = {"DAY": "daily", "YEAR": "yearly", "HOUR": "hourly", "WEEK": "weekly", "MONTH": "monthly"}
TIER_UNITS = {
    "YEAR": "yearly", "YEARLY": "yearly", "MONTH": "monthly", "MONTHLY": "monthly",
    "HOUR": "hourly", "HOURLY": "hourly", "WEEK": "weekly", "WEEKLY": "weekly",
}
LISTING_UNITS = {
    "ANNUAL": "yearly", "YEAR": "yearly", "HOUR": "hourly", "YEARLY": "yearly",
    "MONTHLY": "monthly", "WEEKLY": "weekly", "DAILY": "daily", "HOURLY": "hourly",
}
CONTRACT_UNITS = {
    "per annum": "yearly", "per month": "monthly", "per week": "weekly", "per day": "daily",
    "per hour": "hourly",
}


def _none() -> Column:
    return F.lit(None).cast(COMPENSATION_DDL)


def _number(text: Column) -> Column:
    """Digits with thousands separators as a double; null when malformed."""
    return F.replace(text, F.lit(","), F.lit("")).try_cast("double")


def _whole(value: Column) -> Column:
    """Truncate towards zero, stay a double."""
    return value.try_cast("bigint").cast("double")


def extract_salary(
    text: Column,
    annual: bool = False,
    lower_limit: int = 1_000,
    upper_limit: int = 700_000,
    hourly_threshold: int = 350,
    monthly_threshold: int = 30_000,
) -> Column:
    """First dollar range in free text.

    The interval follows from the lower bound; both bounds must fall in the same band and, made
    annual, inside the limits. With ``annual`` the amounts are annual while the interval stays as
    found.
    """
    amount = r"(\d+(?:,\d+)?(?:\.\d+)?)([kK]?)"
    pattern = rx(rf"\${amount}\s*[-—–]\s*\$?{amount}")

    def bounds(found: Column) -> Column:
        thousands = F.when(
            F.concat(F.regexp_extract(found, pattern, 2), F.regexp_extract(found, pattern, 4)) != "",
            1000.0,
        ).otherwise(1.0)
        return F.struct(
            (_whole(_number(F.regexp_extract(found, pattern, 1))) * thousands).alias("lo"),
            (_whole(_number(F.regexp_extract(found, pattern, 3))) * thousands).alias("hi"),
        )

    def judged(b: Column) -> Column:
        lo, hi = b["lo"], b["hi"]
        interval = (
            F.when(lo < hourly_threshold, "hourly")
            .when(lo < monthly_threshold, "monthly")
            .otherwise("yearly")
        )
        factor = F.when(lo < hourly_threshold, 2080.0).when(lo < monthly_threshold, 12.0).otherwise(1.0)
        same_band = (
            F.when(lo < hourly_threshold, hi < hourly_threshold)
            .when(lo < monthly_threshold, hi < monthly_threshold)
            .otherwise(F.lit(True))
        )
        fits = (
            same_band
            & (lo * factor).between(lower_limit, upper_limit)
            & (hi * factor).between(lower_limit, upper_limit)
            & (lo < hi)
        )
        times = factor if annual else F.lit(1.0)
        return F.when(fits, compensation(interval, lo * times, hi * times, F.lit("USD")))

    # One search over the text; the groups are read off the short match.
    return F.when(
        F.contains(text, F.lit("$")),
        let(first_match(text, pattern, 0), lambda m: F.when(m.isNotNull(), let(bounds(m), judged))),
    )


def parse_currency_number(text: Column) -> Column:
    """A number in either decimal convention, rounded to cents."""

    def parsed(kept: Column) -> Column:
        tail = F.right(kept, F.lit(3))
        head = F.regexp_replace(F.left(kept, F.length(kept) - F.length(tail)), "[.,]", "")
        decimal = F.when(F.contains(tail, F.lit(".")), tail).otherwise(
            F.replace(tail, F.lit(","), F.lit("."))
        )
        return F.bround(F.concat(head, decimal).try_cast("double"), 2)

    return let(F.regexp_replace(text, "[^-0-9.,]", ""), parsed)


def linkedin_salary(text: Column) -> Column:
    """``$a - $b`` of a search card; the interval is not stated."""
    clean = strip(text)
    parts = F.split(clean, "-")
    low = _whole(parse_currency_number(F.get(parts, F.lit(0))))
    high = _whole(parse_currency_number(F.get(parts, F.lit(1))))
    sign = F.left(clean, F.lit(1))
    currency = F.when(sign == "$", "USD").otherwise(sign)
    return F.when(
        low.isNotNull() & high.isNotNull(),
        compensation(F.lit(None), low, high, currency),
    )


def indian_salary(text: Column) -> Column:
    """``a-b Lacs`` or ``a-b Cr`` in rupees; the interval is not stated."""
    pattern = rx(r"^(\d+(?:\.\d+)?)\s*-\s*(\d+(?:\.\d+)?)\s*(Lacs|Lakh|Cr)", ignore_case=True)

    def money(clean: Column) -> Column:
        unit = F.when(F.lower(F.regexp_extract(clean, pattern, 3)) == "cr", 1e7).otherwise(1e5)
        low = _whole(F.regexp_extract(clean, pattern, 1).try_cast("double") * unit)
        high = _whole(F.regexp_extract(clean, pattern, 2).try_cast("double") * unit)
        return F.when(clean.rlike(pattern), compensation(F.lit(None), low, high, F.lit("INR")))

    return let(strip(text), money)


def _first_numbers(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"[\d,]+(?:\.\d+)?"), F.lit(0))


def seek_salary(label: Column, country: Column | None = None) -> Column:
    """Interval by key word (yearly unless said), first one or two numbers."""

    def parsed(text: Column) -> Column:
        interval = (
            F.when(text.rlike("per hour|hourly|/hr"), "hourly")
            .when(text.rlike("per day|daily"), "daily")
            .when(text.rlike("per month|monthly"), "monthly")
            .when(text.rlike("per week|weekly"), "weekly")
            .otherwise("yearly")
        )
        home = F.lit("AUD") if country is None else (
            F.when(country == "new zealand", "NZD").otherwise("AUD")
        )
        currency = (
            F.when(text.rlike(r"nz\$|nzd"), "NZD").when(text.rlike(r"a\$|aud"), "AUD").otherwise(home)
        )
        amounts = F.filter(F.transform(_first_numbers(text), _number), lambda a: a.isNotNull())
        return let(
            amounts,
            lambda a: F.when(
                F.size(a) > 0,
                compensation(
                    interval,
                    F.get(a, F.lit(0)),
                    F.coalesce(F.get(a, F.lit(1)), F.get(a, F.lit(0))),
                    currency,
                ),
            ),
        )

    return let(F.lower(strip(label)), parsed)


def irish_salary(label: Column) -> Column:
    """Euro pay; one malformed number voids the whole text."""

    def parsed(text: Column) -> Column:
        interval = (
            F.when(text.rlike("per hour|p/h|/hr"), "hourly")
            .when(text.rlike("per month|p/m|/month"), "monthly")
            .when(text.rlike("per week|p/w|/week"), "weekly")
            .when(text.rlike("per day|p/d|/day"), "daily")
            .otherwise("yearly")
        )
        numbers = F.transform(_first_numbers(F.regexp_replace(text, "[€$£]", "")), _number)
        return let(
            numbers,
            lambda a: F.when(
                (F.size(a) > 0)
                & ~F.exists(a, lambda v: v.isNull())
                & ~text.isin("negotiable", "competitive", "not disclosed"),
                compensation(
                    interval,
                    F.get(a, F.lit(0)),
                    F.coalesce(F.get(a, F.lit(1)), F.get(a, F.lit(0))),
                    F.lit("EUR"),
                ),
            ),
        )

    return let(F.lower(strip(label)), parsed)


def _positive(value: Column) -> Column:
    amount = value.try_cast("double")
    return F.when(amount > 0, amount)


def reed_salary_details(low: Column, high: Column, salary_type: Column, currency: Column) -> Column:
    """Pay of a detail record that states its period (yearly unless known)."""
    unit = lookup(CONTRACT_UNITS, strip(F.lower(F.coalesce(salary_type, F.lit("")))))
    lo, hi = _positive(low), _positive(high)
    return F.when(
        lo.isNotNull() | hi.isNotNull(),
        compensation(
            F.coalesce(unit, F.lit("yearly")), lo, hi, F.coalesce(non_empty(currency), F.lit("GBP"))
        ),
    )


def reed_salary_search(low: Column, high: Column, currency: Column | None = None) -> Column:
    """Pay of a search record: the period is guessed from the size of the amount."""
    lo, hi = _positive(low), _positive(high)
    reference = F.coalesce(lo, hi)
    interval = F.when(reference < 350, "hourly").when(reference < 1000, "daily").otherwise("yearly")
    money = F.lit("GBP") if currency is None else F.coalesce(non_empty(currency), F.lit("GBP"))
    return F.when(reference.isNotNull(), compensation(interval, lo, hi, money))


def indeed_compensation(comp: Column) -> Column:
    """Stated pay, else the board's estimate; unknown units are no pay."""
    base = F.coalesce(comp["baseSalary"], comp["estimated"]["baseSalary"])
    interval = lookup(BOARD_UNITS, F.upper(base["unitOfWork"]))
    currency = F.when(comp["estimated"].isNotNull(), comp["estimated"]["currencyCode"]).otherwise(
        comp["currencyCode"]
    )
    return F.when(
        interval.isNotNull(),
        compensation(interval, _whole(base["range"]["min"]), _whole(base["range"]["max"]), currency),
    )


def glassdoor_compensation(header: Column) -> Column:
    """10th to 90th percentile of the adjusted pay."""
    period, pay = header["payPeriod"], header["payPeriodAdjustedPay"]
    return F.when(
        (F.length(period) > 0) & pay.isNotNull(),
        compensation(
            lookup(LISTING_UNITS, period),
            F.floor(pay["p10"]),
            F.floor(pay["p90"]),
            F.coalesce(header["payCurrency"], F.lit("USD")),
        ),
    )


def ashby_compensation(comp: Column) -> Column:
    """First tier only; yearly unless its unit is known."""
    tier = F.get(comp["compensationTiers"], F.lit(0))
    unit = lookup(TIER_UNITS, F.upper(tier["interval"]))
    return F.when(
        tier["min"].isNotNull() | tier["max"].isNotNull(),
        compensation(
            F.coalesce(unit, F.lit("yearly")),
            tier["min"],
            tier["max"],
            F.coalesce(tier["currencyCode"], F.lit("USD")),
        ),
    )


def jsonld_compensation(salary: Column) -> Column:
    """schema.org ``baseSalary``; yearly unless its unit is known."""
    value = salary["value"]
    low, high = value["minValue"].try_cast("double"), value["maxValue"].try_cast("double")
    unit = lookup(BOARD_UNITS, F.upper(value["unitText"]))
    return F.when(
        low.isNotNull() | high.isNotNull(),
        compensation(
            F.coalesce(unit, F.lit("yearly")), low, high, F.coalesce(salary["currency"], F.lit("USD"))
        ),
    )


def smartrecruiters_compensation(comp: Column) -> Column:
    """Always read as yearly."""
    low, high = comp["min"].try_cast("double"), comp["max"].try_cast("double")
    return F.when(
        low.isNotNull() | high.isNotNull(),
        compensation(F.lit("yearly"), low, high, F.coalesce(comp["currency"], F.lit("USD"))),
    )


def zip_compensation(interval: Column, low: Column, high: Column, currency: Column) -> Column:
    """Always a struct, even when nothing is stated."""
    return compensation(
        F.when(interval == "annual", "yearly").otherwise(interval), _whole(low), _whole(high), currency
    )


def annualize(comp: Column) -> Column:
    """Yearly amounts where interval and both bounds are known and non-zero."""
    factor = lookup(PERIODS_PER_YEAR, comp["interval"]).cast("double")
    due = factor.isNotNull() & (comp["min_amount"] != 0) & (comp["max_amount"] != 0)
    return F.when(
        due,
        compensation(
            F.lit("yearly"), comp["min_amount"] * factor, comp["max_amount"] * factor, comp["currency"]
        ),
    ).otherwise(comp)
