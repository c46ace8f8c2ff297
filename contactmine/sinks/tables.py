"""Outputs: a delimited file, and tables with one tab (partition) per source."""

from __future__ import annotations

from collections.abc import Mapping
from urllib.parse import quote

from pyspark.sql import DataFrame, functions as F

from contactmine.operators.contacts import labelled

FULL = "full"
PARTIAL = "partial"
APPEND_ONLY = "append_only"


def write_csv(
    contacts: DataFrame,
    path: str,
    headers: Mapping[str, str] | None = None,
    write_empty: bool = True,
) -> bool:
    """Labelled columns with a header line; says whether anything was written."""
    if not write_empty and contacts.isEmpty():
        return False
    (
        labelled(contacts, headers)
        .write.mode("overwrite")
        .option("header", True)
        .option("quoteAll", False)
        .option("escape", '"')
        .csv(path)
    )
    return True


def tab_path(table: str, source: str) -> str:
    return f"{table.rstrip('/')}/source={quote(source, safe='')}"


def _as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def replace_tab(rows: DataFrame, table: str, source: str) -> None:
    """Replace one source's rows, all values as strings; other sources stay."""
    _as_text(rows).write.mode("overwrite").parquet(tab_path(table, source))


def clear_tab(rows: DataFrame, table: str, source: str) -> None:
    """Empty one source's tab and keep its columns."""
    replace_tab(rows.limit(0), table, source)


def append_to_tab(rows: DataFrame, table: str, source: str) -> None:
    """Add rows to a tab; the table comes into being with the first write."""
    _as_text(rows).write.mode("append").parquet(tab_path(table, source))


def replace_tabs(rows: DataFrame, table: str) -> None:
    """Replace the tabs of all sources present in ``rows`` in one job."""
    texts = _as_text(rows)
    (
        texts.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("source")
        .parquet(table)
    )


def begin_run(rows: DataFrame, table: str, source: str, mode: str) -> None:
    """A full run starts from an empty tab, others add to what is there."""
    if mode == FULL:
        clear_tab(rows, table, source)


def finish_run(cleaned: DataFrame, table: str, source: str, mode: str) -> None:
    """A full run ends by replacing the tab with the de-duplicated rows."""
    if mode == FULL:
        replace_tab(cleaned, table, source)
