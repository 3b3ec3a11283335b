"""SimHash fingerprints and their near-duplicate components, by multi-index hashing.

Fingerprints of 64 bits are cut into segments. Two fingerprints with at most ``radius`` differing bits
differ in at most radius/segments bits in one segment at least, so every fingerprint enumerates the
small Hamming ball around each of its segments and looks the values up in the table of all segments.
What meets at a table entry is verified by the complete distance.

Copies share a fingerprint and count once. At an entry, a search from each fingerprint through those
not yet reached gives a forest of true links with at most one link per fingerprint, so that a group of
n near copies gives n links, not n^2. Entries with many fingerprints are cut into blocks, searched by different tasks.
The search goes in three steps: among equal segments within blocks, then within the balls, then across blocks. What links
have joined, over all entries, is one in the next step: entries whose members are one are done, and in the others a link is made
for two groups, not for two members.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from cobasket.llm.arrow import pieces, texts
from cobasket.llm.components import components
from cobasket.llm.names import unused
from cobasket.llm.storage import written
from cobasket.operators.lookup import look_up

BITS = 64
# Hashes whose bits are counted together.
STEP = 1 << 16
# Members of the smallest block that an entry is cut into.
BLOCK = 128


def simhash(text: str, words: int = 3, seed: int = 42) -> int:
    """The fingerprint of a text: a bit is 1 if set in over half of its shingles' hashes.

    A-Z are lower-cased and words are runs of anything but ASCII white space. A text of fewer words is one
    shingle; a text without words has fingerprint 0.
    """
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    size = min(words, len(found))
    shingles = map(b" ".join, zip(*(found[i:] for i in range(size)), strict=False))
    count = len(found) - size + 1
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=seed), shingles), dtype="<u8", count=count)
    ones = np.zeros(BITS, dtype=np.int64)
    for begin in range(0, count, STEP):
        part = hashes[begin : begin + STEP].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << b for b in np.flatnonzero(2 * ones > count).tolist()))


def fingerprints(
    rows: DataFrame,
    key: str,
    text: str,
    names: tuple[str, ...],
    measure: Callable[[str], tuple[int, ...]],
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Per row: ``key``, ``extra`` columns, and what ``measure`` makes of its text as (signed) longs; nothing is shuffled."""

    def hash_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text"):
            prints = np.array([measure(x) for x in texts(batch, "_text")], dtype=np.uint64).view(np.int64)
            kept = [n for n in batch.schema.names if n != "_text"]
            columns = [batch.column(n) for n in kept] + [pa.array(c) for c in prints.reshape(-1, len(names)).T.copy()]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *names])

    narrow = rows.select(
        F.col(key).alias("_key"), *[c.alias(n) for n, c in (extra or {}).items()], F.col(text).alias("_text")
    )
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema if f.name != "_text"]
    schema += [f"{n} long" for n in names]
    return narrow.mapInArrow(hash_texts, ", ".join(schema)).withColumnRenamed("_key", key)


def _segments(count: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment."""
    edges = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _signed(bits: int) -> int:
    """64 bits as a long."""
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def _forest(prints: np.ndarray, own: np.ndarray, joined: np.ndarray, blocks: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that join, step by step, all ``joined`` groups with members within ``radius`` bits; places in ``prints``.

    Members that only asked for this entry aren't compared with each other: they meet at entries of their own.
    Of two blocks, only members across them are compared.
    """
    across = blocks[0] != blocks[-1] or bool((blocks != blocks[0]).any())
    _, group = np.unique(joined, return_inverse=True)
    order = np.argsort(group, kind="stable")
    edges = np.searchsorted(group[order], np.arange(int(group.max()) + 2))
    links, left, waiting = [], np.ones(len(edges) - 1, dtype=bool), len(edges) - 1
    for seed in range(len(left)):
        if not left[seed]:
            continue
        left[seed], waiting = False, waiting - 1
        reached = order[edges[seed] : edges[seed + 1]].tolist()
        while reached and waiting:
            at = reached.pop()
            fresh = left[group]
            if not own[at]:
                fresh &= own
            if across:
                fresh &= blocks != blocks[at]
            others = np.flatnonzero(fresh)
            others = others[np.bitwise_count(prints[others] ^ prints[at]) <= radius]
            if len(others):
                found, first = np.unique(group[others], return_index=True)
                left[found], waiting = False, waiting - len(found)
                links.extend((at, x) for x in others[first].tolist())
                for g in found.tolist():
                    reached.extend(order[edges[g] : edges[g + 1]].tolist())
    return links


def _entries(prints: DataFrame, radius: int, segments: int) -> DataFrame:
    """(``entry``, ``own``, ``node``, ``fingerprint``): what meets at each value of each segment that is in the table."""
    own, ball = [], []
    for number, (low, width) in enumerate(_segments(segments)):
        part = F.shiftrightunsigned("fingerprint", low).bitwiseAND(F.lit(_signed((1 << width) - 1)))
        masks = [sum(1 << b for b in bits) for r in range(1, radius // segments + 1) for bits in combinations(range(width), r)]
        segment = prints.select(F.lit(number).alias("segment"), part.alias("entry"), "node", "fingerprint")
        own.append(segment.withColumn("own", F.lit(True)))
        if masks:
            mask = F.explode(F.array(*[F.lit(_signed(m)).cast("long") for m in masks])).alias("mask")
            asked = F.col("entry").bitwiseXOR(F.col("mask")).alias("asked")
            # Of two values in each other's ball, the larger asks for the smaller.
            probes = segment.select("segment", "entry", "node", "fingerprint", mask).select("segment", "entry", asked, "node", "fingerprint")
            ball.append(probes.where("asked < entry").drop("entry").withColumnRenamed("asked", "entry"))
    table = members = reduce(DataFrame.union, own)
    for probes in ball:
        met = probes.join(table.select("segment", "entry"), ["segment", "entry"], "left_semi")
        members = members.union(met.select("segment", "entry", "node", "fingerprint", F.lit(False).alias("own")))
    members = written(members, "segments")
    many = members.groupBy("segment", "entry").agg(F.count("*").alias("n")).where("n > 1")
    # Blocks grow with the square root of an entry, so both their number and their size stay moderate.
    blocks = F.ceil(F.col("n") / F.greatest(F.lit(float(BLOCK)), 4 * F.sqrt("n"))).cast("long")
    met = look_up(members, many.select("segment", "entry", blocks.alias("blocks")), ["segment", "entry"])
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block")
    return met.select(F.xxhash64("segment", "entry").alias("entry"), "own", "node", "fingerprint", "blocks", block)


def similar_links(prints: DataFrame, radius: int = 3, segments: int = 2) -> DataFrame:
    """Links (``a``, ``b``) between nodes that connect all within ``radius`` bits.

    ``prints`` is read more than once and has long columns: ``node``, distinct, and ``fingerprint``. Not every near pair is
    a link, but any near pair is connected by links, whose number grows with that of nodes.
    """
    met = written(_entries(prints, radius, segments), "entries")
    inside = F.xxhash64("entry", "block")
    links = written(_searched(met.where("own").withColumn("joined", F.col("node")).withColumn("meeting", inside), radius), "links")
    links = links.union(written(_searched(_apart(met, links).withColumn("meeting", inside), radius), "links"))
    large = _apart(met.where("blocks > 1"), links)
    large = large.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).where("other <> block")
    across = large.withColumn("meeting", F.xxhash64("entry", F.least("block", "other"), F.greatest("block", "other")))
    return links.union(_searched(across, radius))


def _apart(met: DataFrame, links: DataFrame) -> DataFrame:
    """The members of entries that ``links`` haven't made one yet, with what they are ``joined`` to."""
    roots = components(links).withColumnRenamed("node", "_node")
    rooted = met.join(roots, F.col("node") == F.col("_node"), "left").withColumn("joined", F.coalesce("root", "node"))
    rooted = written(rooted.drop("_node", "root"), "joined")
    open_ = rooted.groupBy("entry").agg(F.min("joined").alias("low"), F.max("joined").alias("high")).where("low <> high")
    return look_up(rooted, open_.select("entry"), ["entry"])


def _searched(met: DataFrame, radius: int) -> DataFrame:
    """Links (``a``, ``b``) of ``node`` values that :func:`_forest` finds among the rows of every ``meeting``.

    The rows of a meeting are in order of ``joined``: searches start from the least, so that meetings of much the same members
    give much the same links.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last, left, right = None, [], []

        def link() -> None:
            table = pa.Table.from_batches(held)
            nodes, prints, joined, blocks = (table.column(n).to_numpy() for n in ("node", "fingerprint", "joined", "block"))
            for a, b in _forest(prints.view(np.uint64), table.column("own").to_numpy(), joined, blocks, radius):
                left.append(int(nodes[a]))
                right.append(int(nodes[b]))
            held.clear()

        def links() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})
            left.clear()
            right.clear()
            return out

        for batch in batches:
            values = batch.column("meeting").to_numpy()
            edges = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
            for begin, end in zip(edges.tolist(), [*edges[1:].tolist(), len(values)], strict=True):
                if values[begin] != last and held:
                    link()
                held.append(batch.slice(begin, end - begin))
                last = values[begin]
            if len(left) > 10_000:
                yield links()
        if held:
            link()
        yield links()

    narrow = met.select("meeting", "node", "fingerprint", "own", "joined", "block")
    return narrow.repartition("meeting").sortWithinPartitions("meeting", "joined", "node").mapInArrow(search, "a long, b long")


def near_components(prints: DataFrame, name: Column, links: DataFrame) -> DataFrame:
    """(``node``, ``first``): the least ``name``, an expression over ``prints``, in the component of every node.

    ``prints`` has ``node`` and is read more than once; ``links`` join nodes. Rows of one node belong together.
    """
    distinct = written(prints.groupBy("node").agg(F.min(name).alias("_least")), "nodes")
    roots = components(links).withColumnRenamed("node", "_node")
    rooted = distinct.join(roots, F.col("node") == F.col("_node"), "left").select(
        "node", "_least", F.coalesce("root", "node").alias("_root")
    )
    named = rooted.groupBy("_root").agg(F.min("_least").alias("first"))
    return look_up(rooted.select("node", "_root"), named, ["_root"]).select("node", "first")


def _linked(made: DataFrame, radius: int) -> DataFrame:
    distinct = written(made.select("node", F.col("node").alias("fingerprint")).distinct(), "prints")
    return similar_links(distinct, radius)


def near_duplicates(rows: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, radius: int = 3) -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    Fingerprints of at most ``radius`` differing bits are linked, equal ones and those of texts without words too; a
    component is named by its smallest key. Null texts are empty. Null keys are kept but never name a component (one of null
    keys alone has a null name); repeated rows are kept. Long texts are hashed whole, one at a time. An empty table gives no
    rows; other columns aren't read, whatever their names.
    """

    def measure(content: str) -> tuple[int, ...]:
        return (simhash(content, words),)

    made = written(fingerprints(rows, key, text, ("node",), measure), "fingerprints")
    found = look_up(made, near_components(made, F.col(key), _linked(made, radius)), ["node"])
    return found.select(key, F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), F.col("first").alias("component_id"))


def keep_one_each(rows: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, radius: int = 3) -> DataFrame:
    """One row of each component of ``near_duplicates``, with all its columns: that with the smallest key.

    Rows of equal keys are told apart, and the choice among them is made, by a hash of all columns, so it doesn't depend on the
    order of rows; of rows repeated whole one stays. A null key comes after all others. Null texts are empty, and they form
    one component with all texts of fingerprint zero. An empty table stays empty; columns of any name are kept as they are.
    """
    content = [F.to_json(F.struct(c)) if "map<" in kind else F.col(c) for c, kind in rows.dtypes]
    mark = {"_mark": F.xxhash64(*content), "_mark2": F.xxhash64(F.lit(2), *content)}

    def measure(content: str) -> tuple[int, ...]:
        return (simhash(content, words),)

    made = written(fingerprints(rows, key, text, ("node",), measure, mark), "fingerprints")
    first = F.struct(F.col(key).isNull().alias("last"), F.col(key).alias("key"), *mark)
    kept = near_components(made, first, _linked(made, radius)).select("first.*").distinct()
    one, two = (unused(rows, n) for n in ("_one", "_two"))
    kept = kept.select(F.col("_mark").alias(one), F.col("_mark2").alias(two))
    marked = rows.withColumns({one: mark["_mark"], two: mark["_mark2"]})
    return marked.join(kept, [one, two]).dropDuplicates([one, two]).drop(one, two)
