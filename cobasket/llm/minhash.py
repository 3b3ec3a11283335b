"""Near duplicates by exact similarity of word shingles, found by tensored banding of few minima.

A text's set is that of its distinct word shingles. Minima over the set come in two small collections of ``GROUPS``
groups each; the key of table (i, j) joins group i of the one with group j of the other, so that GROUPS^2 tables, whose
keys depend on 2 x DEPTH minima each, need 2 x GROUPS x DEPTH minima only. A pair of similarity s misses every table
with a chance of about 2 (1 - s^DEPTH)^GROUPS: at 0.8, two in a hundred thousand.

Sets that share a table key are candidates, and all of these are decided by the whole sets, without comparing all pairs:

1. Every candidate is compared with one neighbour, that which most of its tables have as their least member. Members
   of a group of near copies mostly have the same one, so n copies cost n comparisons and give n links.
2. Tables whose members all came together are settled. Members of the others are searched exactly: sets that
   tables connect lie in one cluster, large clusters are cut into blocks by volume, and in every pair of blocks sets of different
   groups are compared until all pairs are known or joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from cobasket.llm.arrow import pieces, texts
from cobasket.llm.components import components
from cobasket.llm.storage import written
from cobasket.operators.lookup import look_up

GROUPS, DEPTH = 16, 3
# Odd multipliers of the minima, made from a fixed seed, and hashes taken together.
MULTIPLIERS = np.random.default_rng(12).integers(0, 1 << 63, 2 * GROUPS * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
STEP = 1024
# Most shingles per block of a cluster, and blocks that a cluster of less is cut into, to be searched by several tasks.
VOLUME, BLOCKS = 1 << 20, 12


def shingle_set(text: str, words: int = 4) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; fewer words are one shingle, no words none.

    A-Z are lower-cased and words are runs of anything but ASCII white space.
    """
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    size = min(words, len(found))
    shingles = set(map(b" ".join, zip(*(found[i:] for i in range(size)), strict=False)))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, shingles), dtype=np.uint64, count=len(shingles)))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least value of every hash function over a set."""
    least = np.full(len(MULTIPLIERS), np.iinfo(np.uint64).max, dtype=np.uint64)
    for begin in range(0, len(hashes), STEP):
        mixed = MULTIPLIERS[:, None] * hashes[None, begin : begin + STEP]
        mixed ^= mixed >> np.uint64(29)
        np.minimum(least, mixed.min(axis=1), out=least)
    return least


def bands(least: np.ndarray) -> np.ndarray:
    """One long per group of minima, first those of one collection, then those of the other."""
    parts = [xxhash.xxh64_intdigest(part.tobytes(), seed=i) for i, part in enumerate(least.reshape(2 * GROUPS, DEPTH))]
    return np.array(parts, dtype=np.uint64).view(np.int64)


def signatures(rows: DataFrame, key: str, text: str, row: Column, words: int) -> DataFrame:
    """(``key``, ``row``, ``node``, ``n_shingles``, ``bands``) of every row; ``node`` is a hash of the set, null for an empty one."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            sets = [shingle_set(x, words) for x in texts(batch, "text")]
            nodes = [np.uint64(xxhash.xxh64_intdigest(s.tobytes())).view(np.int64) if len(s) else None for s in sets]
            values = [bands(minima(s)) for s in sets if len(s)]
            sizes = np.array([2 * GROUPS if len(s) else 0 for s in sets])
            flat = np.concatenate(values) if values else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("row"),
                    pa.array(nodes, pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(flat)),
                ],
                names=["key", "row", "node", "n_shingles", "bands"],
            )

    narrow = rows.select(F.col(key).alias("key"), row.alias("row"), F.col(text).alias("text"))
    kind = narrow.schema["key"].dataType.simpleString()
    return narrow.mapInArrow(measure, f"key {kind}, row long, node long, n_shingles long, bands array<long>")


def table_members(sets: DataFrame) -> DataFrame:
    """(``table``, ``node``) for the tensored keys that several of the distinct (``node``, ``bands``) share.

    A key can only be shared where both its groups are, so keys are formed of shared groups alone.
    """
    single = sets.select("node", F.posexplode("bands").alias("group", "value"))
    shared = single.groupBy("group", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    left = F.when(F.col("group") < GROUPS, F.col("value"))
    right = F.when(F.col("group") >= GROUPS, F.col("value"))
    # At most GROUPS values each.
    found = look_up(single, shared, ["group", "value"]).groupBy("node").agg(F.collect_list(left).alias("left"), F.collect_list(right).alias("right"))
    keys = found.select("node", "right", F.explode("left").alias("l")).select("node", "l", F.explode("right").alias("r"))
    return keys.select(F.xxhash64("l", "r").alias("table"), "node")


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _groups(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.Table]:
    """The rows of each value of ``name``, by which the batches are sorted."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        values = batch.column(name).to_numpy()
        edges = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]).tolist() if len(values) else []
        for begin, end in zip(edges, [*edges[1:], len(values)], strict=True):
            if held and values[begin] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(begin, end - begin))
            last = values[begin]
    if held:
        yield pa.Table.from_batches(held)


def _links(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found, strict=True) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _spread(met: DataFrame) -> DataFrame:
    """Meetings over all shuffle partitions: they are few bytes and much work, so partitions shouldn't be merged by bytes."""
    return met.repartition(int(met.sparkSession.conf.get("spark.sql.shuffle.partitions")), "meeting")


def neighbours(members: DataFrame) -> DataFrame:
    """(``node``, ``meetings`` of (``first``, ``part``)): where a candidate meets the neighbour that most of its tables begin with.

    The members of one neighbour are dealt out in parts of about a thousand, and the neighbour goes to each.
    """
    first = members.groupBy("table").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    met = look_up(members, first.select("table", "first"), ["table"]).where("node > first")
    often = met.groupBy("node", "first").agg(F.count(F.lit(1)).alias("tables"))
    best = F.max(F.struct("tables", (-F.col("first")).alias("least"), "first"))["first"]
    chosen = written(often.groupBy("node").agg(best.alias("first")), "neighbours")
    sizes = chosen.groupBy("first").agg(F.ceil(F.count(F.lit(1)) / 1000.0).cast("long").alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts")).alias("part")
    asked = look_up(chosen, sizes, ["first"]).select("node", "first", part)
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
    both = asked.union(sizes.select(F.col("first").alias("node"), "first", every))
    return both.groupBy("node").agg(F.collect_list(F.struct("first", "part")).alias("meetings"))


def candidate_texts(rows: DataFrame, made: DataFrame, met: DataFrame, text: str, row: Column) -> DataFrame:
    """(``node``, ``n_shingles``, ``meetings``, ``text``) with one text for each candidate of ``met``.

    The row that stands for a set is chosen before any text moves; rows repeated whole are dropped where they meet.
    """
    chosen = made.groupBy("node").agg(F.min("row").alias("row"), F.min("n_shingles").alias("n_shingles"))
    asked = look_up(met, chosen, ["node"])
    found = look_up(rows.select(row.alias("row"), F.col(text).alias("text")), asked, ["row"])
    return found.dropDuplicates(["row", "node"]).drop("row")


def links_to_neighbours(contents: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (``a``, ``b``) of candidates to the one neighbour that they meet."""
    met = contents.select("node", F.inline("meetings"), "text")
    met = met.select(F.xxhash64("first", "part").alias("meeting"), "first", "node", "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, centre, found = None, None, []
        for batch in batches:
            for piece in pieces(iter([batch]), "text"):
                columns = [piece.column(n).to_pylist() for n in ("meeting", "first", "node")]
                for meeting, first, node, text in zip(*columns, texts(piece, "text"), strict=True):
                    own = shingle_set(text, words)
                    if node == first:
                        now, centre = meeting, own
                    elif meeting == now and _similar(own, centre, percent):
                        found.append((first, node))
            yield _links(found)
            found = []

    placed = _spread(met).sortWithinPartitions("meeting", (F.col("node") != F.col("first")).cast("int"))
    return placed.mapInArrow(compare, "a long, b long")


def search(sets: list[np.ndarray], nodes: np.ndarray, roots: np.ndarray, blocks: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between members of different ``roots`` until no unjoined pair is left to compare.

    With two ``blocks`` only pairs across them are compared. What is rejected is compared with all others still. An index of
    the sets that hold each shingle counts what one set shares with all others at once.
    """
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    sizes = np.array([len(x) for x in sets])
    begins = np.cumsum(sizes) - sizes
    holders = np.repeat(np.arange(len(sets)), sizes)[np.argsort(ids, kind="stable")]
    many = np.bincount(ids)
    first = np.cumsum(many) - many
    across = bool((blocks != blocks[0]).any())
    _, group = np.unique(roots, return_inverse=True)
    order = np.argsort(group, kind="stable")
    edges = np.searchsorted(group[order], np.arange(int(group.max()) + 2))
    left, waiting, found = np.ones(len(edges) - 1, dtype=bool), len(edges) - 1, []
    for seed in range(len(left)):
        if not left[seed]:
            continue
        left[seed], waiting = False, waiting - 1
        reached = order[edges[seed] : edges[seed + 1]].tolist()
        while reached and waiting:
            at = reached.pop()
            mine = ids[begins[at] : begins[at] + sizes[at]]
            mine = mine[many[mine] > 1]
            shared = np.bincount(holders[_ranges(first[mine], many[mine])], minlength=len(sets))
            near = left[group] & (100 * shared >= percent * (sizes[at] + sizes - shared))
            if across:
                near &= blocks != blocks[at]
            others = np.flatnonzero(near)
            if len(others):
                joined, one = np.unique(group[others], return_index=True)
                left[joined], waiting = False, waiting - len(joined)
                found.extend((int(nodes[at]), int(nodes[x])) for x in others[one].tolist())
                for g in joined.tolist():
                    reached.extend(order[edges[g] : edges[g + 1]].tolist())
    return found


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``first`` and the ``count - 1`` numbers after it, for all, one after the other."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - count), count)


def links_between_groups(members: DataFrame, roots: DataFrame, contents: DataFrame, words: int, percent: int, volume: int = VOLUME) -> DataFrame:
    """Links (``a``, ``b``) that connect all similar sets in tables whose members have different ``roots``."""
    rooted = members.join(roots.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left")
    rooted = written(rooted.select("table", "node", F.coalesce("root", "node").alias("root")), "rooted")
    open_ = rooted.groupBy("table").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min("node").alias("first"))
    mixed = look_up(rooted, open_.where("low <> high").select("table", "first"), ["table"])
    mixed = written(mixed.select("node", "root", "first").distinct(), "mixed")
    clusters = written(components(mixed.select("node", "first")), "clusters").toDF("node", "cluster")
    nodes = mixed.select("node", F.col("root").alias("joined")).distinct()
    found = look_up(contents.select("node", "text"), look_up(nodes, clusters, ["node"]), ["node"])
    sizes = look_up(clusters, contents.select("node", "n_shingles"), ["node"])
    whole, fine = (F.ceil(F.sum("n_shingles") / float(v)) for v in (volume, volume / 16))
    sizes = sizes.groupBy("cluster").agg(F.greatest(whole, F.least(fine, F.lit(BLOCKS))).cast("long").alias("blocks"))
    met = look_up(found, sizes, ["cluster"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    meeting = F.xxhash64("cluster", F.least("block", "other"), F.greatest("block", "other")).alias("meeting")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, "meeting"):
            if len(table) > 1:
                sets = [shingle_set(x or "", words) for x in table.column("text").to_pylist()]
                columns = (table.column(n).to_numpy() for n in ("node", "joined", "block"))
                yield _links(search(sets, *columns, percent))

    placed = _spread(met.select(meeting, "node", "joined", "block", "text")).sortWithinPartitions("meeting", "node")
    return placed.mapInArrow(compare, "a long, b long")


def near_duplicates(rows: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, percent: int = 80) -> DataFrame:
    """Per row: ``key``, ``n_shingles``, ``component_id`` and ``kept`` (the row names its component).

    Two rows are linked if their sets of ``words``-word shingles share ``percent`` of their union or more, compared whole; a
    component is named by its smallest key. Null and empty texts, and those without words, have an empty set and are
    components of their own. Equal sets are one node. Null keys never name a component (one of null keys alone has
    a null name, and none of them is kept); repeated rows give repeated results. Long texts are shingled whole, one at a
    time. An empty table gives no rows; other columns aren't read. Sets and shingles are told by 64-bit hashes.
    """
    row = F.xxhash64(F.col(key), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    made = written(signatures(rows, key, text, row, words), "signatures")
    sets = made.where(F.col("node").isNotNull())
    copies = written(sets.groupBy("node").agg(F.min("key").alias("least"), F.first("bands").alias("bands")), "sets")
    members = written(table_members(copies.select("node", "bands")), "members")
    contents = written(candidate_texts(rows, sets, neighbours(members), text, row), "contents")
    close = written(links_to_neighbours(contents, words, percent), "links")
    more = links_between_groups(members, components(close), contents, words, percent)
    roots = components(close.union(written(more, "links")))
    rooted = copies.select("node", "least").join(roots.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left")
    rooted = rooted.select("node", "least", F.coalesce("root", "node").alias("root"))
    names = rooted.groupBy("root").agg(F.min("least").alias("name"))
    of_node = look_up(rooted.select("node", "root"), names, ["root"]).select("node", "name")
    found = look_up(made.select("key", "n_shingles", "node"), of_node, ["node"], "left")
    component = F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("name")).alias("component_id")
    kept = F.coalesce(F.col("key") == F.col("component_id"), F.lit(False)).alias("kept")
    return found.select("key", "n_shingles", component).select(F.col("key").alias(key), "n_shingles", "component_id", kept)
