"""Token counts of whole texts, by rank-synchronous merging of batched pre-tokens (see ``bpe``)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cobasket.llm.arrow import pieces, texts
from cobasket.llm.bpe import WordBpe


def count_tokens(rows: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limit: int = 2048) -> DataFrame:
    """Per row of ``rows``: ``key``, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    Each text is counted where it was read; nothing is shuffled. ``tokenizer`` is the path of a
    word-level BPE file that every executor can read. Nulls: a null text is empty (0 bytes, 0 tokens), a null
    key stays null. Long texts are taken in steps cut at blanks. Repeated rows give repeated results, and
    an empty table an empty result; other columns, whatever their names, aren't read.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(tokenizer)
        for batch in pieces(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("n_bytes"), pa.array(bpe.count(texts(batch, "text")), pa.int64())],
                names=["key", "n_bytes", "n_tokens"],
            )

    narrow = rows.select(F.col(key).alias("key"), F.col(text).alias("text"), text_bytes(F.col(text)).alias("n_bytes"))
    kind = narrow.schema["key"].dataType.simpleString()
    counted = narrow.mapInArrow(count, f"key {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes; a null text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
