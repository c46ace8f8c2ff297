"""Token counts: lengths only, from Arrow batches balanced by bytes.

Texts are taken in slices of about the same number of bytes, not rows, and cut at
boundaries the tokenizer itself always respects (``pieces``), so that a very long
text costs no more at once than many short ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from contactmine.llm.pieces import PieceEncoder
from contactmine.llm.textbytes import slices


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text: str = "text",
    limit: int = 512,
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit``: one row per row of ``docs``.

    ``tokenizer`` is the path of a byte-level BPE file, readable on all executors.
    Counts are those of the whole text without added special tokens; special
    strings inside texts count as the library has them. Null is empty: 0 bytes,
    0 tokens. Repeated rows and null ids are rows like any other; other columns
    are ignored; an empty table gives an empty table.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder.of(tokenizer, "byte")
        for batch in batches:
            for low, high, part in slices(batch.column(1)):
                tokens = encoder.counts(part)
                yield pa.record_batch(
                    [
                        batch.column(0).slice(low, high - low),
                        pa.array(np.diff(part.offsets)),
                        pa.array(tokens),
                        pa.array(tokens > limit),
                    ],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("doc_id"), F.col(text)).mapInArrow(
        count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
