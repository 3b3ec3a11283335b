"""Aligning two tokenizations of the same texts by pointer jumping.

Both tokenizers cut a text's bytes into tokens. Every token points to the token of the other side that reaches
farthest to the right among those it overlaps, which is the one that holds its last byte; where both end together,
the second side's token is the end of its group and points to itself. Pointers only go right, so doubling them for
all tokens of a batch at once (a token's new successor is its successor's successor) ends after the logarithm of the
longest chain, and every token then knows the last token of its group.

How often two ids are linked is counted over all documents. A task counts its documents in batches of bounded size, so
that what is exchanged is a row per pair and batch, not per pair and document; the counts come back to each batch
as one vector, in which the documents' links are looked up by position.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cobasket.llm.arrow import pieces, texts
from cobasket.llm.storage import written
from cobasket.operators.lookup import look_up

# Distinct (document, pair) entries per batch, and characters of chunks held before a task's store starts anew.
ENTRIES, HELD_CHARS = 1 << 20, 1 << 24
# A space between two characters that are not white space: no token of either side goes across its left edge.
_CUT = re.compile(r"(?<=\S) (?=\S)")


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies, back to the byte.

    Printable Latin-1 characters stand for themselves, the other bytes for the characters from 256 on, in order.
    """
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """A byte-level BPE file; texts get a space in front."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            content = json.load(f)
        symbols, entries = byte_symbols(), dict(content["model"]["vocab"])
        self.bytes_of = [b""] * (1 + max([*entries.values(), *(t["id"] for t in content["added_tokens"])]))
        for entry, number in entries.items():
            self.bytes_of[number] = bytes(symbols[c] for c in entry) if all(c in symbols for c in entry) else entry.encode()

    def encode(self, chunks: list[str]) -> list[list[int]]:
        return [x.ids for x in self.library.encode_batch([" " + c for c in chunks], add_special_tokens=False)]


class Pieces:
    """A sentencepiece model, which puts a space in front by itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=path)
        byte = re.compile(r"<0x([0-9A-F]{2})>")
        names = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.bytes_of = [
            bytes([int(byte.fullmatch(n)[1], 16)]) if byte.fullmatch(n) else n.replace("▁", " ").encode() for n in names
        ]

    def encode(self, chunks: list[str]) -> list[list[int]]:
        return self.library.encode(chunks, num_threads=1)


@cache
def tokenizer(path: str) -> ByteLevel | Pieces:
    return ByteLevel(path) if path.endswith(".json") else Pieces(path)


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``first`` and the ``count - 1`` numbers after it, for all, one after the other."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - count), count)


class Side:
    """The tokens of numbered chunks in one tokenizer, and gathered for any list of chunks."""

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        self.length_of = np.array([len(b) for b in self.tokenizer.bytes_of], dtype=np.int64)
        self.ids, self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, chunks: list[str]) -> list[bool]:
        """Number further chunks; whether the tokens of each spell it, with its space."""
        found = self.tokenizer.encode(chunks)
        count = np.array([len(x) for x in found], dtype=np.int64)
        self.first = np.r_[self.first, len(self.ids) + np.cumsum(count) - count]
        self.count = np.r_[self.count, count]
        self.ids = np.r_[self.ids, np.array([i for x in found for i in x], dtype=np.int64)]
        of = self.tokenizer.bytes_of
        return [b"".join([of[i] for i in x]) == b" " + c.encode() for x, c in zip(found, chunks, strict=True)]

    def gather(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the chunks one after the other, and how many each has."""
        count = self.count[chunks]
        return self.ids[_ranges(self.first[chunks], count)], count


class Chunks:
    """Both tokenizations of texts, put together from chunks that hardly ever are new."""

    def __init__(self, path_a: str, path_b: str):
        self.paths = path_a, path_b
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.chars = 0
        self.sides = tuple(Side(p) for p in self.paths)
        self.spelt = np.zeros(0, bool)

    def encode(self, batch: list[str]) -> tuple[np.ndarray, tuple[tuple[np.ndarray, np.ndarray], ...]]:
        """Which texts both sides spell (never empty ones), and per side the ids of these and their number by text."""
        if self.chars > HELD_CHARS:
            self.clear()
        cut = [_CUT.split(x) for x in batch]
        fresh = list(dict.fromkeys(c for x in cut for c in x if c not in self.numbers))
        if fresh:
            self.numbers.update(zip(fresh, range(len(self.numbers), len(self.numbers) + len(fresh)), strict=True))
            self.chars += sum(map(len, fresh)) + 16 * len(fresh)
            spelt = [side.add(fresh) for side in self.sides]
            self.spelt = np.r_[self.spelt, np.all(spelt, axis=0)]
        sizes = np.array([len(x) for x in cut], dtype=np.int64)
        number = self.numbers
        chunks = np.array([number[c] for x in cut for c in x], dtype=np.int64)
        text = np.repeat(np.arange(len(batch)), sizes)
        wrong = np.zeros(len(batch), dtype=bool)
        wrong[text[~self.spelt[chunks]]] = True
        wrong |= np.array([not x for x in batch], dtype=bool)
        chunks, text = chunks[~wrong[text]], text[~wrong[text]]
        found = []
        for side in self.sides:
            ids, count = side.gather(chunks)
            found.append((ids, np.bincount(text, weights=count, minlength=len(batch)).astype(np.int64)))
        return ~wrong, tuple(found)


def groups_of(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every token of both sides, numbered from 0 from left to right.

    Tokens are given by where they end, ascending; both sides begin at 0 and end together.
    """
    n, ends = len(end_a), np.concatenate([end_a, end_b])
    to = np.concatenate([n + np.searchsorted(end_b, end_a), np.searchsorted(end_a, end_b)])
    last = np.flatnonzero(ends[to] == ends)
    last = last[last >= n]
    to[last] = last
    while True:
        further = to[to]
        if np.array_equal(further, to):
            break
        to = further
    number = np.zeros(len(end_b), dtype=np.int64)
    number[last - n] = 1
    group = (np.cumsum(number) - 1)[to - n]
    return group[:n], group[n:]


def links_of(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (a, b) of all tokens that share a byte."""
    reach = np.searchsorted(end_b, end_a)
    begin = np.r_[0, reach[:-1] + (end_b[reach[:-1]] == end_a[:-1])] if len(end_a) else reach
    count = reach - begin + 1
    return np.repeat(np.arange(len(end_a)), count), _ranges(begin, count)


def _spelt_out(ids: tuple[np.ndarray, np.ndarray], groups: tuple[np.ndarray, np.ndarray], names: list[np.ndarray], tokens: np.ndarray) -> list[str]:
    """Every text's groups as ``a1,a2|b1;a3|b2``; ``tokens`` has the number of tokens of each text."""
    (a, b), (of_a, of_b) = ids, groups
    many = int(of_b[-1]) + 1 if len(of_b) else 0
    in_a, in_b = np.bincount(of_a, minlength=many), np.bincount(of_b, minlength=many)
    out = np.empty(len(a) + len(b), dtype=object)
    last_a = np.r_[of_a[1:] != of_a[:-1], True][: len(a)]
    last_b = np.r_[of_b[1:] != of_b[:-1], True][: len(b)]
    # Tokens in order of their group, the first side's before the second's.
    out[np.arange(len(a)) + (np.cumsum(in_b) - in_b)[of_a]] = names[0][2 * a + last_a]
    out[np.arange(len(b)) + np.cumsum(in_a)[of_b]] = names[1][2 * b + last_b]
    parts, ends = out.tolist(), np.cumsum(tokens).tolist()
    return ["".join(parts[begin:end])[:-1] for begin, end in zip([0, *ends[:-1]], ends, strict=True)]


class _Batch:
    """Documents of one batch, until their links are counted."""

    def __init__(self):
        self.rows: list[pa.RecordBatch] = []
        self.pairs: list[np.ndarray] = []
        self.links: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.entries = 0

    def add(self, rows: pa.RecordBatch, pairs: np.ndarray, links: np.ndarray, sizes: np.ndarray) -> None:
        self.rows.append(rows)
        self.pairs.append(pairs)
        self.links.append(links)
        self.sizes.append(sizes)
        self.entries += len(pairs) + len(sizes)

    def finished(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """The distinct pairs with the number of documents that hold them, and the documents with their pairs by position."""
        number = uuid.uuid4().int >> 65
        distinct, slots, counts = np.unique(np.concatenate(self.pairs), return_inverse=True, return_counts=True)
        yield _record(schema, len(distinct), batch=np.full(len(distinct), number), slot=np.arange(len(distinct)), pair=distinct, documents=counts)
        at = 0
        for rows, pairs, links, sizes in zip(self.rows, self.pairs, self.links, self.sizes, strict=True):
            ends = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
            mine = {n: rows.column(n) for n in rows.schema.names}
            mine["slots"] = pa.ListArray.from_arrays(ends, pa.array(slots[at : at + len(pairs)].astype(np.int32)))
            mine["links"] = pa.ListArray.from_arrays(ends, pa.array(links.astype(np.int32)))
            yield _record(schema, rows.num_rows, batch=np.full(rows.num_rows, number), **mine)
            at += len(pairs)


def _record(schema: pa.Schema, rows: int, **columns) -> pa.RecordBatch:
    """A record batch of the schema; columns that aren't given are null."""
    arrays = [
        (x if isinstance(x := columns[f.name], pa.Array) else pa.array(x)).cast(f.type) if f.name in columns else pa.nulls(rows, f.type)
        for f in schema
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def measured(rows: DataFrame, path_a: str, path_b: str, key: str, text: str, with_groups: bool) -> DataFrame:
    """One table of documents (``key`` to ``links``, ``slot`` null) and of the pairs of each batch (``slot``, ``pair``, ``documents``)."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = Chunks(path_a, path_b)
        size_b = len(chunks.sides[1].length_of)
        # Every id as text with what follows it: within and at the end of a group's part.
        names = [
            np.array([f"{i}{end}" for i in range(len(side.length_of)) for end in (",", stop)], dtype=object)
            for side, stop in zip(chunks.sides, "|;", strict=True)
        ]
        held, schema = _Batch(), None
        for batch in pieces(batches, "text"):
            if schema is None:
                fields = [("batch", pa.int64()), ("slot", pa.int32()), ("pair", pa.int64()), ("documents", pa.int64())]
                fields += [("key", batch.schema.field("key").type)] + [(n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")]
                fields += [("groups", pa.string()), ("slots", pa.list_(pa.int32())), ("links", pa.list_(pa.int32()))]
                schema = pa.schema(fields)
            content = texts(batch, "text")
            good, ((a, n_a), (b, n_b)) = chunks.encode(content)
            end_a, end_b = (np.cumsum(s.length_of[i]) for s, i in zip(chunks.sides, (a, b), strict=True))
            groups = groups_of(end_a, end_b)
            at_a, at_b = links_of(end_a, end_b)
            text_a = np.repeat(np.arange(len(content)), n_a)
            n_groups = np.bincount(np.repeat(np.arange(len(content)), n_b)[np.r_[groups[1][1:] != groups[1][:-1], True][: len(b)]], minlength=len(content))
            spelt = _spelt_out((a, b), groups, names, n_a + n_b)
            if not with_groups:
                spelt = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in spelt]
            # Distinct pairs of every text, with their number of links.
            base = len(chunks.sides[0].length_of) * size_b
            entries, links = np.unique(text_a[at_a] * base + a[at_a] * size_b + b[at_b], return_counts=True)
            found = pa.RecordBatch.from_pydict(
                {
                    "key": batch.column("key"),
                    "n_a": pa.array(n_a),
                    "n_b": pa.array(n_b),
                    "n_groups": pa.array(n_groups),
                    "n_links": pa.array(np.bincount(text_a[at_a], minlength=len(content))),
                    "groups": pa.array(spelt, pa.string()),
                }
            )
            held.add(found, entries % base, links, np.bincount(entries // base, minlength=len(content)))
            if held.entries >= ENTRIES:
                yield from held.finished(schema)
                held = _Batch()
        if held.rows:
            yield from held.finished(schema)

    narrow = rows.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = narrow.schema["key"].dataType.simpleString()
    longs = "n_a long, n_b long, n_groups long, n_links long"
    schema = f"batch long, slot int, pair long, documents long, key {kind}, {longs}, groups string, slots array<int>, links array<int>"
    return narrow.mapInArrow(measure, schema)


def corpus_counts(pairs: DataFrame, size_b: int) -> DataFrame:
    """(``pair``, ``count``, ``best``): documents that link each pair, and whether no pair of its first id has more.

    ``pairs`` has (``pair``, ``documents``), a row per pair and batch.
    """
    counts = written(pairs.groupBy("pair").agg(F.sum("documents").alias("count")), "pair-counts")
    counts = counts.withColumn("first", F.floor(F.col("pair") / F.lit(size_b)))
    most = counts.groupBy("first").agg(F.max("count").alias("most"))
    return look_up(counts, most, ["first"]).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def _summed(rows: DataFrame) -> DataFrame:
    """Per document the links that are best and the sum of their counts, from rows in order of batch and position."""
    plain = [f for f in rows.schema.fields if f.name in ("key", "n_a", "n_b", "n_groups", "n_links", "groups")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain) + ", n_best long, count_sum long"

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts, best = None, [], []
        vector = None
        for batch in batches:
            numbers = batch.column("batch").to_numpy()
            pairs = batch.column("slot").is_valid().to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.r_[True, (numbers[1:] != numbers[:-1]) | (pairs[1:] != pairs[:-1])]) if len(numbers) else []
            for begin, end in zip(edges, [*edges[1:], len(numbers)], strict=True):
                part = batch.slice(begin, end - begin)
                if numbers[begin] != now:
                    now, counts, best, vector = numbers[begin], [], [], None
                if pairs[begin]:
                    counts.append(part.column("count").to_numpy())
                    best.append(part.column("best").to_numpy(zero_copy_only=False))
                    continue
                if vector is None:
                    whole = np.concatenate(counts or [np.zeros(0, np.int64)])
                    vector = whole, np.concatenate(best or [np.zeros(0, bool)])
                slots, links = (part.column(n).flatten().to_numpy().astype(np.int64) for n in ("slots", "links"))
                offsets = part.column("slots").offsets.to_numpy().astype(np.int64)
                offsets -= offsets[0]
                sums = []
                for value in (vector[1][slots] * links, vector[0][slots] * links):
                    total = np.r_[0, np.cumsum(value)]
                    sums.append(pa.array(total[offsets[1:]] - total[offsets[:-1]]))
                names = [f.name for f in plain]
                yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + sums, names=[*names, "n_best", "count_sum"])

    return rows.mapInArrow(apply, schema)


def align(rows: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", with_groups: bool = False) -> DataFrame:
    """Per row: ``key``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and the groups.

    ``path_a`` and ``path_b`` are tokenizer files that every executor can read, byte-level BPE (.json) or sentencepiece
    (.model). Groups are the parts between byte offsets where tokens of both end; ``groups`` has them in full, as
    ``a1,a2|b1;a3|b2,b3``, or, unless ``with_groups``, ``groups_sha256`` their digest. A link is a pair of tokens that share
    a byte; a pair of ids counts the documents in which it is linked, whatever their number of links.

    Null and empty texts, and those that either side does not spell byte by byte, have no tokens: zeros and no groups ('').
    A null key stays null. Long texts are aligned whole, one at a time. Repeated rows give repeated results and count each as a
    document. Ties for an id's highest count are all best. An empty table gives no rows; other columns aren't read,
    whatever their names.
    """
    table = written(measured(rows, path_a, path_b, key, text, with_groups), "alignments")
    size_b = len(tokenizer(path_b).bytes_of)
    pairs = table.where(F.col("slot").isNotNull()).select("batch", "slot", "pair", "documents")
    counts = corpus_counts(pairs.select("pair", "documents"), size_b)
    vectors = look_up(pairs.select("batch", "slot", "pair"), counts, ["pair"]).select("batch", "slot", "count", "best")
    documents = table.where(F.col("slot").isNull()).drop("pair", "documents")
    both = vectors.unionByName(documents, allowMissingColumns=True)
    # A batch's vector lies in front of its documents.
    placed = both.repartition("batch").sortWithinPartitions("batch", F.col("slot").asc_nulls_last())
    groups = F.col("groups") if with_groups else F.col("groups").alias("groups_sha256")
    return _summed(placed).select(F.col("key").alias(key), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", groups)
