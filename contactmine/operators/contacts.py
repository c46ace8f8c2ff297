"""Contact tables: normalise, label, de-duplicate, combine."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from contactmine.functions.records import checked_location, dedup_key, na_or
from contactmine.functions.text import trim_ws
from contactmine.schema import CONTACT_FIELDS, MISSING, OUTPUT_LABELS


def normalise(contacts: DataFrame) -> DataFrame:
    """Sentinel for missing fields, checked location; other columns stay."""
    rules = {name: na_or(F.col(name)) for name in CONTACT_FIELDS}
    rules["location"] = checked_location(F.col("location"))
    return contacts.withColumns(rules)


def strip_all(df: DataFrame) -> DataFrame:
    """Strip every string column."""
    texts = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    return df.withColumns({name: trim_ws(F.col(name)) for name in texts})


def with_dedup_key(contacts: DataFrame, fold_country_code: bool = False) -> DataFrame:
    return contacts.withColumn(
        "dedup_key",
        dedup_key(
            F.col("full_name"), F.col("phone_number"), F.col("company"), fold_country_code
        ),
    )


def deduplicate(
    contacts: DataFrame,
    order: str = "ingest_ord",
    scope: Sequence[str] = (),
    fold_country_code: bool = False,
    keep_unidentified: bool = False,
) -> DataFrame:
    """The first row of each key, by an explicit order column.

    Spark applies ``row_number() = 1`` before the shuffle as well, so a key
    that holds a third of the rows sends one row per task. With
    ``keep_unidentified`` rows without name, phone and company stay apart.
    """
    keyed = with_dedup_key(contacts, fold_country_code)
    parts = [*scope, "dedup_key"]
    if keep_unidentified:
        nameless = (
            (F.col("full_name") == MISSING)
            & (F.col("phone_number") == MISSING)
            & (F.col("company") == MISSING)
        )
        keyed = keyed.withColumn("_alone", F.when(nameless, F.col(order)))
        parts.append("_alone")
    tie = [name for name in CONTACT_FIELDS if name in contacts.columns and name != order]
    window = Window.partitionBy(*parts).orderBy(order, *tie)
    return (
        keyed.withColumn("_rn", F.row_number().over(window))
        .filter(F.col("_rn") == 1)
        .select(*contacts.columns)
    )


def clean(contacts: DataFrame, **options) -> DataFrame:
    """Normalise, strip and de-duplicate."""
    return deduplicate(strip_all(normalise(contacts)), **options)


def labelled(contacts: DataFrame, headers: Mapping[str, str] | None = None) -> DataFrame:
    """The seven output columns under their labels; ``headers`` renames labels for one source."""
    out = contacts.select(
        *[F.col(name).alias(label) for name, label in OUTPUT_LABELS.items()]
    )
    return out.withColumnsRenamed(dict(headers)) if headers else out


def union_regions(parts: Sequence[DataFrame]) -> DataFrame:
    """All regions of a source, nothing removed."""
    return functools.reduce(lambda a, b: a.unionByName(b), parts)


def union_sources(by_source: Mapping[str, DataFrame]) -> DataFrame:
    """All sources side by side, told apart by ``source``."""
    return union_regions(
        [df.withColumn("source", F.lit(name)) for name, df in by_source.items()]
    )


def mask(contacts: DataFrame) -> DataFrame:
    """Hash e-mail addresses and phone numbers, for outputs that must not show them."""

    def hashed(name: str):
        return F.when(F.col(name) == MISSING, F.col(name)).otherwise(F.sha2(name, 256))

    return contacts.withColumns(
        {"email": hashed("email"), "phone_number": hashed("phone_number")}
    )
