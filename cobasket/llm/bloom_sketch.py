"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests.

A text's paragraphs are cut into pieces, at sentence ends and after six words at most, pieces without enough
blanks once more where their own characters say so, and hashed to 64-bit
digests (the n-th copy of a piece with seed n, so that copies count). A sketch hashes every digest into one cell of each of three
tables; a cell holds a count, the XOR of its digests and the XOR of their check values. Subtracting two
sketches cell by cell leaves the digests that only one version has, and peeling recovers them: a cell
with a count of 1 or -1 and a matching check value shows a digest, whose removal lays others bare. Where
too many differ for the size, peeling gets stuck, and the pair is sketched again with four times the
cells. Whole batches are sketched, subtracted and peeled together, as flat arrays.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from cobasket.llm.arrow import BYTES, pieces, texts

TABLES = 3
# Cells of a fingerprint, and of the sketches of one step.
CELLS = 24
STEP_CELLS = 1 << 21
# Up to five words that end no sentence, and one more, all in one line.
_PIECES = re.compile(r"(?:\S*[^\s.!?][^\S\n]+){0,5}\S+")
# Longest piece in code points, and how many bits of a hash make a mark in longer ones: one in 16 code points.
LONG, MARK_BITS = 96, 4
# Odd multipliers that spread a digest over the tables and make its check value.
_SPREAD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)


def _cut_long(piece: str) -> list[str]:
    """A piece of more than ``LONG`` code points cut where two neighbours hash to a mark, and after ``LONG`` without one.

    Marks depend on the text around them alone, so an edit changes the pieces beside it and no others. The
    first of several marks in a row counts.
    """
    codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    mixed = (codes[:-1] * _SPREAD[0]) ^ (codes[1:] * _SPREAD[1])
    mark = ((mixed * _SPREAD[2]) >> np.uint64(64 - MARK_BITS)) == 0
    mark[1:] &= ~mark[:-1].copy()
    edges = np.r_[0, np.flatnonzero(mark) + 1, len(codes)].tolist()
    return [piece[i : min(i + LONG, end)] for begin, end in pairwise(edges) for i in range(begin, end, LONG)]


def digests(text: str) -> np.ndarray:
    """The distinct paragraph digests of a text; blank lines have none."""
    seen: dict[str, int] = {}
    found = set()
    for piece in chain.from_iterable(_cut_long(p) if len(p) > LONG else (p,) for p in _PIECES.findall(text)):
        copy = seen.get(piece, 0)
        seen[piece] = copy + 1
        found.add(xxhash.xxh64_intdigest(piece.encode("utf-8", "surrogatepass"), copy))
    return np.fromiter(found, dtype=np.uint64, count=len(found))


def _cell(keys: np.ndarray, table: int, width: int) -> np.ndarray:
    return (((keys * _SPREAD[table]) >> np.uint64(32)) % np.uint64(width)).astype(np.int64) + table * width


def _check(keys: np.ndarray) -> np.ndarray:
    return (keys ^ (keys >> np.uint64(29))) * _SPREAD[3]


class Sketches:
    """Sketches of ``cells`` cells each, in flat arrays; ``owner`` says which sketch a digest goes to."""

    def __init__(self, number: int, cells: int):
        self.cells, self.width = cells, cells // TABLES
        self.count = np.zeros(number * cells, dtype=np.int64)
        self.keys = np.zeros(number * cells, dtype=np.uint64)
        self.checks = np.zeros(number * cells, dtype=np.uint64)

    def add(self, keys: np.ndarray, owner: np.ndarray, sign: np.ndarray | int) -> None:
        check = _check(keys)
        for table in range(TABLES):
            at = owner * self.cells + _cell(keys, table, self.width)
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.keys, at, keys)
            np.bitwise_xor.at(self.checks, at, check)

    def subtract(self, other: Sketches) -> Sketches:
        out = Sketches(0, self.cells)
        out.count, out.keys, out.checks = self.count - other.count, self.keys ^ other.keys, self.checks ^ other.checks
        return out

    def take(self, numbers: np.ndarray) -> Sketches:
        out = Sketches(0, self.cells)
        for name in ("count", "keys", "checks"):
            setattr(out, name, getattr(self, name).reshape(-1, self.cells)[numbers].ravel())
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sketch, digest and sign of all that is recovered, and which sketches came out empty.

        All digests that lie bare are taken out of all sketches at once, until none is left. Works in place.
        """
        owners, keys, signs = [], [], []
        while True:
            bare = np.flatnonzero(np.abs(self.count) == 1)
            key, place = self.keys[bare], bare % self.cells
            real = _check(key) == self.checks[bare]
            real &= np.any([_cell(key, t, self.width) == place for t in range(TABLES)], axis=0)
            bare = bare[real]
            if not len(bare):
                break
            owner, key, sign = bare // self.cells, self.keys[bare], self.count[bare]
            order = np.lexsort((key, owner))
            owner, key, sign = owner[order], key[order], sign[order]
            once = np.r_[True, (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])]
            owner, key, sign = owner[once], key[once], sign[once]
            self.add(key, owner, -sign)
            owners.append(owner)
            keys.append(key)
            signs.append(sign)
        clean = ~(self.count.astype(bool) | self.keys.astype(bool)).reshape(-1, self.cells).any(axis=1)
        if not owners:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), clean
        return np.concatenate(owners), np.concatenate(keys), np.concatenate(signs), clean

    def text(self, number: int, size: int) -> str:
        """Sketch ``number``, of ``size`` digests, as a string."""
        at = slice(number * self.cells, (number + 1) * self.cells)
        raw = np.uint32(size).tobytes() + self.count[at].astype("<i4").tobytes()
        raw += self.keys[at].astype("<u8").tobytes() + (self.checks[at] >> np.uint64(32)).astype("<u4").tobytes()
        return base64.b64encode(raw).decode()


def sketch(sets: list[np.ndarray], cells: int = CELLS) -> Sketches:
    out = Sketches(len(sets), cells)
    if sets:
        out.add(np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets]), 1)
    return out


def differences(
    old: list[np.ndarray], new: list[np.ndarray], first: Sketches | None = None
) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Per pair of digest sets: those only in ``old``, those only in ``new``, and the cells it took.

    ``first`` may hold the difference of the pairs' fingerprints, if these are made already.
    """
    out: list[tuple[np.ndarray, np.ndarray, int]] = [(np.zeros(0, np.uint64),) * 2 + (0,)] * len(old)
    left, cells, made = np.arange(len(old)), CELLS, first
    while len(left):
        stuck = []
        step = max(1, STEP_CELLS // cells)
        for begin in range(0, len(left), step):
            part = left[begin : begin + step]
            if made is None:
                diff = sketch([old[i] for i in part], cells).subtract(sketch([new[i] for i in part], cells))
            else:
                diff = made.take(part)
            owner, key, sign, clean = diff.peel()
            order = np.argsort(owner, kind="stable")
            owner, key, sign = owner[order], key[order], sign[order]
            edges = np.searchsorted(owner, np.arange(len(part) + 1))
            for number, i in enumerate(part):
                if clean[number]:
                    mine = slice(edges[number], edges[number + 1])
                    out[i] = (key[mine][sign[mine] > 0], key[mine][sign[mine] < 0], cells)
            stuck.append(part[~clean])
        left, cells, made = np.concatenate(stuck), cells * 4, None
    return out


def likeness(size_a: int, size_b: int, differing: int) -> float:
    """Shared over all digests of two sets; two empty sets are alike."""
    return 1.0 if size_a + size_b == 0 else (size_a + size_b - differing) / (size_a + size_b + differing)


def paragraph_changes(rows: DataFrame, key: str, old: str, new: str) -> DataFrame:
    """Which paragraph digests two versions of a text don't share.

    Per row: ``key``, ``removed`` and ``added`` (sorted hex digests), ``cells`` of the sketch that could be
    peeled and ``likeness``. A null version is empty.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "old"):
            a, b = ([digests(x) for x in texts(batch, name)] for name in ("old", "new"))
            found = differences(a, b)
            hexed = [[sorted(f"{int(x):016x}" for x in f[side]) for f in found] for side in (0, 1)]
            alike = [likeness(len(x), len(y), len(f[0]) + len(f[1])) for x, y, f in zip(a, b, found, strict=True)]
            yield pa.RecordBatch.from_pydict(
                {
                    "key": batch.column("key"),
                    "removed": pa.array(hexed[0], pa.list_(pa.string())),
                    "added": pa.array(hexed[1], pa.list_(pa.string())),
                    "cells": pa.array([f[2] for f in found], pa.int64()),
                    "likeness": pa.array(alike, pa.float64()),
                }
            )

    narrow = rows.select(F.col(key).alias("key"), F.col(old).alias("old"), F.col(new).alias("new"))
    kind = narrow.schema["key"].dataType.simpleString()
    schema = f"key {kind}, removed array<string>, added array<string>, cells long, likeness double"
    return narrow.mapInArrow(compare, schema).withColumnRenamed("key", key)


def with_edits(rows: DataFrame, key: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """Fingerprint every text, its edited form and its successor, and how alike they are.

    The edited text has its last quarter of code points (floor) replaced by the first as many, or all, of
    the next row's text, in ascending ``key`` (nulls first, equal keys by text); the first row follows the last.
    Returns ``key``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``
    and ``near_next``. A null text is empty; a single row follows itself; an empty table gives no rows.

    Keys are cut into ``parts`` ranges (four times the session's shuffle partitions by default) at their quantiles. A range
    also gets the first row of the next one, so each is worked through in order, alone, as a stream.
    """
    spark = rows.sparkSession
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    narrow = rows.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    marks = narrow.select("key").dropna().approxQuantile("key", [i / parts for i in range(1, parts)], 1 / (8 * parts))
    bounds = np.unique(np.array(marks, dtype=np.float64))

    @F.pandas_udf("long")
    def range_of(keys: pd.Series) -> pd.Series:
        # Doubles round alike for marks and keys, so ranges follow the order of the keys.
        number = np.searchsorted(bounds, keys.to_numpy(dtype=np.float64, na_value=np.nan), side="right")
        return pd.Series(np.where(keys.isna().to_numpy(), -1, number))

    # One row per range, at most ``parts`` + 1.
    firsts = narrow.select("key", range_of("key").alias("range")).groupBy("range").agg(F.min("key").alias("first"))
    firsts = sorted((r["range"], r["first"]) for r in firsts.collect())
    schema = (
        "key long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    before = [(firsts[i - 1][0], first) for i, (_, first) in enumerate(firsts)]  # the range before the first is the last
    ahead = spark.createDataFrame(before, "range long, first long")
    placed = narrow.select("key", "text", range_of("key").alias("own")).join(
        F.broadcast(ahead), F.col("key").eqNullSafe(F.col("first")), "left"
    )
    place = F.struct(F.col("own").alias("range"), F.lit(False).alias("ahead"))
    earlier = F.when(F.col("range").isNotNull(), F.struct("range", F.lit(True).alias("ahead")))
    places = placed.select("key", "text", F.explode(F.array_compact(F.array(place, earlier))).alias("place"))
    ordered = (
        places.select("place.range", "place.ahead", "key", "text")
        .repartition("range")
        .sortWithinPartitions("range", "ahead", "key", "text")
    )
    return ordered.mapInArrow(_follow, schema).withColumnRenamed("key", key)


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Give each row the text after it and compare them, in groups of bounded size."""
    held, group, size = None, [], 0
    for batch in pieces(batches, "text"):
        ranges, aheads, keys = (batch.column(n).to_pylist() for n in ("range", "ahead", "key"))
        for range_, ahead, key, text in zip(ranges, aheads, keys, texts(batch, "text"), strict=True):
            if held and held[0] == range_:
                group.append((held[1], held[2], text))
                size += len(text)
                if len(group) >= 512 or size > BYTES:
                    yield _compared(group)
                    group, size = [], 0
            held = None if ahead else (range_, key, text)
    if group:
        yield _compared(group)


def _compared(group: list[tuple[int, str, str]]) -> pa.RecordBatch:
    import hashlib

    edited = []
    for _, text, next_ in group:
        cut = len(text) // 4
        edited.append(text[: len(text) - cut] + next_[:cut])
    own: list[np.ndarray] = []
    follow: list[np.ndarray] = []
    for i, (_, text, next_) in enumerate(group):  # a row's text is mostly the successor of the one before
        own.append(follow[-1] if i and group[i - 1][2] is text else digests(text))
        follow.append(digests(next_))
    changed = [digests(t) for t in edited]
    a, b, c = sketch(own), sketch(changed), sketch(follow)
    near = [
        [likeness(len(x), len(y), len(f[0]) + len(f[1])) for x, y, f in zip(own, other, differences(own, other, a.subtract(s)), strict=True)]
        for other, s in ((changed, b), (follow, c))
    ]
    return pa.RecordBatch.from_pydict(
        {
            "key": pa.array([k for k, _, _ in group], pa.int64()),
            "n_chars": pa.array([len(t) for _, t, _ in group], pa.int64()),
            "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited],
            "fingerprint": [a.text(i, len(x)) for i, x in enumerate(own)],
            "edited_fingerprint": [b.text(i, len(x)) for i, x in enumerate(changed)],
            "near_edited": pa.array(near[0], pa.float64()),
            "near_next": pa.array(near[1], pa.float64()),
        }
    )
