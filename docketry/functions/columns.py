"""Column expressions of the cleaning rules; all stay in JVM code generation."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketry import model


def code_to_int(code: Column) -> Column:
    """Text to int; a fraction is cut off, anything else that is no number is null.

    The second form is only evaluated where the plain cast gives null.
    """
    whole = F.regexp_replace(code, r"\.\d*\s*$", "")
    return F.coalesce(code.try_cast("int"), whole.try_cast("int"))


def strict_date(text: Column) -> Column:
    """A date only where the text is yyyy-MM-dd and names a real day."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))


def gender(text: Column) -> Column:
    return (
        F.when(text.startswith("1"), "female").when(text.startswith("0"), "male").otherwise("unknown")
    )


def possible(filing: Column, decision: Column) -> Column:
    """True for a filed case that was not decided before it was filed."""
    return filing.isNotNull() & F.coalesce(decision >= filing, F.lit(True))


def is_resolved(decision: Column) -> Column:
    return decision.isNotNull().cast("int")


def age_days(filing: Column, decision: Column, as_of: date) -> Column:
    """Days until the decision, or until `as_of` while the case is pending."""
    return F.datediff(F.coalesce(decision, F.lit(as_of)), filing)


def delay_category(age: Column) -> Column:
    rule = F
    for name, bound in model.DELAY_BOUNDS:
        rule = rule.when(age < bound, name)
    return rule.otherwise(model.DELAY_REST)


def span_days(first: Column, last: Column) -> Column:
    return F.datediff(last, first)


def coded(text: Column, codes: dict[str, int]) -> Column:
    """The code of a text, null for a text that has none."""
    rule = F
    for name, code in codes.items():
        rule = rule.when(text == name, code)
    return rule.otherwise(None)


def unit_hash(*parts: Column) -> Column:
    """A number in [0, 1) that depends on nothing but the given columns.

    Unlike rand() it gives the same value when a lost task is run again.
    """
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
