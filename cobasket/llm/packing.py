"""Harmonic packing of tokenized documents into sequences of fixed capacity.

Lengths fall into reciprocal-capacity classes: class j takes lengths in (capacity/(j+1), capacity/j] and fills
each of its bins with exactly j of them, so a piece's bin follows from its number within its class alone and
every worker fills its own bins. Documents are cut as little as that allows: above the capacity into full
sequences and a rest, and a rest only if it would leave more than ``slack`` of its place empty. Then its
head fills a place of the next class and its tail, which is far shorter, is looked at in the same way; no
rest makes more than four pieces. A length of class j fills more than j/(j+1) of its place, so
those under ``slack`` times the capacity stay whole. What is left over in the last bins of the classes, of which
there are fewer than twice the capacity's square root, is put together first-fit, longest first.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from cobasket.llm.arrow import pieces, texts
from cobasket.llm.bpe import WordBpe
from cobasket.llm.numbering import numbered
from cobasket.llm.storage import written

# Part of a place that a piece may leave empty.
SLACK = 1 / 16


def cuts(tokens: int, capacity: int, slack: float = SLACK) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of a document's pieces: full ones, then those of the rest, longest first.

    Every piece fills at least ``1 - slack`` of a place of its class, ``capacity // (capacity // length)`` tokens.
    """
    length, rest = [capacity] * (tokens // capacity), tokens % capacity
    while rest:
        places = capacity // rest
        head = rest
        if rest < (1 - slack) * (capacity // places):
            # A place of the next class. It may stay empty by ``slack`` too, so that the tail isn't tiny.
            most = capacity // (places + 1)
            least = max(capacity // (places + 2) + 1, math.ceil((1 - slack) * most))
            head = max(least, min(most, rest - int(slack * most)))
        length.append(head)
        rest -= head
    out = np.array(length, dtype=np.int64)
    return np.cumsum(out) - out, out


def token_pieces(
    rows: DataFrame,
    tokenizer: str,
    capacity: int = 4096,
    end_id: int = 2,
    key: str = "doc_id",
    text: str = "text",
    slack: float = SLACK,
) -> DataFrame:
    """Tokenize and cut every text, ``end_id`` appended, where it was read.

    Per piece: ``key``, ``start``, ``length``, ``ids_crc32`` of its ids as little-endian 32-bit numbers,
    ``doc_tokens`` and the ``ids`` themselves. Nulls: a null text is empty and gives one piece, its end id; a
    null key stays null. A long text is tokenized whole, alone if need be. Repeated rows give repeated pieces, an empty
    table none, and other columns, whatever their names, aren't read.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(tokenizer)
        for batch in pieces(batches, "text"):
            owner, starts, lengths, checks, totals, flat = [], [], [], [], [], []
            for row, ids in enumerate(bpe.encode(texts(batch, "text"))):
                ids = np.append(ids, end_id).astype("<i4")
                start, length = cuts(len(ids), capacity, slack)
                raw = memoryview(ids.tobytes())
                checks += [zlib.crc32(raw[4 * s : 4 * (s + n)]) for s, n in zip(start.tolist(), length.tolist(), strict=True)]
                owner.append(np.full(len(start), row))
                totals.append(np.full(len(start), len(ids)))
                starts.append(start)
                lengths.append(length)
                flat.append(ids)
            lengths = np.concatenate(lengths)
            ends = np.r_[0, np.cumsum(lengths)].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").take(pa.array(np.concatenate(owner))),
                    pa.array(np.concatenate(starts)),
                    pa.array(lengths),
                    pa.array(np.array(checks, dtype=np.int64)),
                    pa.array(np.concatenate(totals).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(flat))),
                ],
                names=["key", "start", "length", "ids_crc32", "doc_tokens", "ids"],
            )

    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")
    narrow = rows.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = narrow.schema["key"].dataType.simpleString()
    schema = f"key {kind}, start long, length long, ids_crc32 long, doc_tokens long, ids array<int>"
    return narrow.mapInArrow(cut, schema).withColumnRenamed("key", key)


def pack(pieces_: DataFrame, capacity: int = 4096, key: str = "doc_id") -> DataFrame:
    """Give every piece its ``sequence_id`` (gapless from 0) and ``offset``.

    ``pieces_`` is written as a table once. Per class, pieces are numbered over all workers, and j in
    a row fill a bin. The last bin of a class, if partly filled, is taken apart; these pieces are at most the sum
    of all classes' j - 1, some 20,000 at a capacity of 4096 however many rows there are, and one task
    puts them first-fit into further sequences. Ties and repeated rows are packed each on its own, also where all
    rows are alike; null keys are kept and an empty table gives an empty result.
    """
    columns = pieces_.columns
    fits = (F.lit(capacity) / F.col("length")).cast("long")
    # Numbered once, in the table, so that rows alike in all else can be dealt out too.
    table = written(pieces_.withColumn("_fits", fits).withColumn("_copy", F.monotonically_increasing_id()), "pieces")
    placed = numbered(table, "_fits", [key, "start", "ids_crc32", "doc_tokens", "_copy"], "_number")
    ordered = Window.orderBy("_class")
    # One row per class, so at most 2 * sqrt(capacity) rows.
    classes = (
        table.groupBy(F.col("_fits").alias("_class"))
        .agg(F.floor(F.count("*") / F.first("_fits")).alias("_full"))
        .withColumn("_first", F.sum("_full").over(ordered.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_full"))
        .withColumn("_total", F.sum("_full").over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    )
    binned = placed.withColumn("_bin", F.floor(F.col("_number") / F.col("_fits"))).join(
        F.broadcast(classes), F.col("_fits") == F.col("_class")
    )
    before = Window.partitionBy("_fits", "_bin").orderBy("_number").rowsBetween(Window.unboundedPreceding, -1)
    full = binned.filter(F.col("_bin") < F.col("_full")).select(
        *columns,
        (F.col("_first") + F.col("_bin")).cast("long").alias("sequence_id"),
        F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long").alias("offset"),
    )

    def first_fit(left: pa.Table) -> pa.Table:
        left = left.sort_by([("length", "descending"), ("_fits", "ascending"), ("_number", "ascending")])
        sequence, offset, used = [], [], np.zeros(left.num_rows, dtype=np.int64)
        for length in left.column("length").to_pylist():
            at = int(np.argmax(used + length <= capacity))
            sequence.append(at)
            offset.append(int(used[at]))
            used[at] += length
        numbers = pc.add(pa.array(sequence, pa.int64()), left.column("_total"))
        return left.select(columns).append_column("sequence_id", numbers).append_column("offset", pa.array(offset, pa.int64()))

    rest = binned.filter(F.col("_bin") >= F.col("_full")).select(*columns, "_fits", "_number", "_total")
    return full.unionByName(rest.groupBy("_total").applyInArrow(first_fit, full.schema))


def pack_documents(
    rows: DataFrame, tokenizer: str, capacity: int = 4096, key: str = "doc_id", text: str = "text", slack: float = SLACK
) -> DataFrame:
    """The packing plan of whole documents: ``token_pieces`` without ids, then ``pack``; their docstrings say what odd rows give."""
    return pack(token_pieces(rows, tokenizer, capacity, key=key, text=text, slack=slack).drop("ids"), capacity, key)
