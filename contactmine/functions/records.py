"""Record-level rules: sentinel, location check, de-dup key, card text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from contactmine.functions.phones import PHONE_PATTERNS, phone_digits
from contactmine.functions.text import WS, let, text_lines, text_or, trim_ws
from contactmine.schema import MISSING


def na_or(col: Column) -> Column:
    """Stripped text, or ``N/A`` for NULL and blank."""
    return text_or(col.cast("string"), MISSING)


def checked_location(col: Column) -> Column:
    """``City, ST`` of at most 80 characters, else ``N/A``."""
    return let(
        na_or(col),
        lambda s: F.when(
            (F.length(s) <= 80) & s.rlike(rf"^[^,]+,[{WS}]*[A-Za-z]{{2}}$"), s
        ).otherwise(F.lit(MISSING)),
    )


def dedup_key(
    full_name: Column,
    phone_number: Column,
    company: Column,
    fold_country_code: bool = False,
) -> Column:
    """Name, phone digits and company, or name and company where the phone is blank.

    A phone that was filled with the sentinel is not blank: it leaves an empty
    middle part. ``fold_country_code`` drops a leading 1 from 11 digits.
    """

    def low(c: Column) -> Column:
        return F.lower(trim_ws(F.coalesce(c, F.lit(""))))

    phone = trim_ws(F.coalesce(phone_number, F.lit("")))
    digits = phone_digits(phone)
    if fold_country_code:
        digits = F.regexp_replace(digits, r"^1(?=[0-9]{10}$)", "")
    return F.when(
        phone == "", F.concat_ws("|", low(full_name), low(company))
    ).otherwise(F.concat_ws("|", low(full_name), digits, low(company)))


def parse_card(text: Column) -> Column:
    """``struct<name, company, phone>`` of a listing card.

    The name is line 1, the company line 2 unless it is or begins like a
    phone, the phone the first match anywhere. A miss is NULL.
    """
    phone = F.nullif(trim_ws(F.regexp_extract(text, PHONE_PATTERNS[0], 0)), F.lit(""))
    return let(
        F.struct(text_lines(text).alias("lines"), phone.alias("phone")),
        lambda c: F.struct(
            F.get(c["lines"], F.lit(0)).alias("name"),
            let(
                F.get(c["lines"], F.lit(1)),
                lambda line: F.when(
                    (line != F.coalesce(c["phone"], F.lit(MISSING)))
                    & ~line.rlike(r"^\(?\d{3}\)?"),
                    line,
                ),
            ).alias("company"),
            c["phone"].alias("phone"),
        ),
    )
