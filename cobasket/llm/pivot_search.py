"""Exact top-k search by inner product with a pivot table.

Every vector's distances to some pivots are computed once. By the triangle inequality the largest
difference between a query's and a candidate's pivot distances bounds their distance from below and,
with their norms, their inner product from above. Candidates are evaluated in the order of that bound, and
as soon as the next bound is under the query's k-th best score, all the rest are out: the result is exact.

Vectors are integers, so scores are. Every row is a candidate of its own, told by a number beside its key. Candidates lie in
blocks where they were read. Queries come in batches of bounded bytes, one after the other, each fetched and broadcast to all blocks; a task carries its k best per query from
block to block, and only those leave it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cobasket.llm.storage import written

# Vectors per block, and bytes of queries per broadcast batch.
BLOCK, BATCH_BYTES = 4096, 8 << 20
# Norms up to which inner products are exact in doubles.
EXACT = float(1 << 52)


def quantized(rows: DataFrame, key: str, vector: str, scale: int = 1024) -> DataFrame:
    """(``key``, ``dim``, ``vector`` of floor(scale * x)), without null keys and null or non-finite vectors."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    whole = F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    usable = rows.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & finite)
    return usable.select(F.col(key).cast("long").alias("key"), F.size(vector).alias("dim"), whole.alias("vector"))


def choose_pivots(vectors: DataFrame, pivots: int, sample: int) -> dict[int, np.ndarray]:
    """Per dimension up to ``pivots`` far-apart vectors of the ``sample`` with the smallest key hashes."""
    drawn = vectors.orderBy(F.xxhash64("key"), "key").limit(sample).collect()
    chosen = {}
    for dim in {r["dim"] for r in drawn} - {0}:
        pool = np.unique(np.array([r["vector"] for r in drawn if r["dim"] == dim], dtype=np.float64), axis=0)
        at, far = [0], np.full(len(pool), np.inf)
        while len(at) < min(pivots, len(pool)):
            far = np.minimum(far, np.sqrt(((pool - pool[at[-1]]) ** 2).sum(axis=1)))
            at.append(int(far.argmax()))
        chosen[dim] = pool[at]
    return chosen


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def _with_distances(vectors: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Add each vector's squared norm and its row of the pivot table."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                for begin in range(0, part.num_rows, BLOCK):
                    piece = part.slice(begin, BLOCK)
                    x = _matrix(piece.column("vector"), dim).astype(np.float64)
                    table = np.stack(
                        [np.sqrt(((x - p) ** 2).sum(axis=1)) for p in pivots.get(dim, np.zeros((0, dim)))] or [np.zeros(len(x))], axis=1
                    )
                    distances = pa.ListArray.from_arrays(
                        pa.array(np.arange(len(x) + 1, dtype=np.int32) * table.shape[1]), pa.array(table.ravel())
                    )
                    arrays = [piece.column(n) for n in ("row", "key", "dim", "vector")] + [distances, pa.array((x * x).sum(axis=1))]
                    yield pa.RecordBatch.from_arrays(arrays, names=["row", "key", "dim", "vector", "distances", "norm"])

    return vectors.mapInArrow(measure, "row long, key long, dim int, vector array<long>, distances array<double>, norm double")


class _Best:
    """The k best (score, key) of one query so far."""

    def __init__(self, k: int):
        self.k = k
        self.scores = np.zeros(0, dtype=np.int64)
        self.keys = np.zeros(0, dtype=np.int64)

    def least(self) -> float:
        return float(self.scores[-1]) if len(self.scores) >= self.k else -np.inf

    def add(self, scores: np.ndarray, keys: np.ndarray) -> None:
        scores, keys = np.concatenate([self.scores, scores]), np.concatenate([self.keys, keys])
        first = np.lexsort((keys, -scores))[: self.k]
        self.scores, self.keys = scores[first], keys[first]


def _evaluate(query: dict, block: dict, best: _Best) -> None:
    """Take in the candidates of a block, in the order of their bounds, until none can matter."""
    q, x = query["vector"], block["vectors"]
    bounded = max(query["norm"], block["most"]) < EXACT
    if not bounded:  # too large for doubles: no bounds, whole numbers
        mine = block["rows"] != query["row"]
        best.add(x[mine] @ q, block["keys"][mine])
        return
    apart = np.zeros(len(x))
    for column, distance in zip(block["distances"], query["distances"], strict=True):
        np.maximum(apart, np.abs(column - distance), out=apart)
    # A little slack for the rounding of square roots; scores are whole numbers.
    apart = np.maximum(apart * (1 - 1e-9) - 1e-6, 0.0)
    most = (query["norm"] + block["norms"] - apart * apart) / 2 + 1e-3
    left = np.flatnonzero((most >= best.least()) & (block["rows"] != query["row"]))
    left = left[np.argsort(-most[left], kind="stable")]
    begin, step = 0, 4 * best.k
    while begin < len(left) and most[left[begin]] >= best.least():
        part = left[begin : begin + step]
        best.add((block["floats"][part] @ query["floats"]).astype(np.int64), block["keys"][part])
        begin, step = begin + len(part), step * 2


def _search(candidates: DataFrame, queries: list, k: int) -> DataFrame:
    """The k best per query and task, for one batch of queries."""
    packs: dict[int, list[dict]] = {}
    for row in queries:
        vector = np.array(row["vector"], dtype=np.int64)
        query = {"row": row["row"], "key": row["key"], "norm": row["norm"], "vector": vector, "floats": vector.astype(np.float64)}
        packs.setdefault(row["dim"], []).append(query | {"distances": np.array(row["distances"])})
    shared = candidates.sparkSession.sparkContext.broadcast(packs)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packs = shared.value
        best: dict[tuple[int, int], _Best] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in set(np.unique(dims).tolist()) & set(packs):
                part = batch.filter(pa.array(dims == dim))
                x = _matrix(part.column("vector"), dim)
                table = part.column("distances").flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
                rows, keys, norms = (part.column(n).to_numpy() for n in ("row", "key", "norm"))
                for begin in range(0, len(x), BLOCK):
                    at = slice(begin, begin + BLOCK)
                    block = {"rows": rows[at], "keys": keys[at], "vectors": x[at], "floats": x[at].astype(np.float64), "norms": norms[at]}
                    block |= {"distances": np.ascontiguousarray(table[at].T), "most": float(norms[at].max())}
                    for number, query in enumerate(packs[dim]):
                        _evaluate(query, block, best.setdefault((dim, number), _Best(k)))
        for (dim, number), found in best.items():
            yield pa.RecordBatch.from_pydict(
                {
                    "query_row": pa.array(np.full(len(found.keys), packs[dim][number]["row"]), pa.int64()),
                    "query_id": pa.array(np.full(len(found.keys), packs[dim][number]["key"]), pa.int64()),
                    "vec_id": pa.array(found.keys),
                    "score": pa.array(found.scores),
                }
            )

    return candidates.mapInArrow(search, "query_row long, query_id long, vec_id long, score long")


def top_k(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 100, k: int = 10, pivots: int = 32, sample: int = 1024) -> DataFrame:
    """The ``k`` best candidates of every row whose key is divisible by ``every``: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Candidates are all rows but the query's own; ties go to the smaller key, and fewer candidates than ``k`` are all
    returned. Rows of a repeated key are candidates, and queries, each on its own. Null keys, null vectors and vectors with
    null or non-finite components take no part; vectors of different lengths aren't compared, and two empty ones score 0.
    Other columns aren't read, whatever their names. An empty table gives no rows. Pivots come from a bounded sample; they
    change the work, not the result.
    """
    numbers = quantized(rows, key, vector).withColumn("row", F.monotonically_increasing_id())
    vectors = written(numbers.select("row", "key", "dim", "vector"), "vectors")
    table = written(_with_distances(vectors, choose_pivots(vectors, pivots, sample)), "pivot-table")
    asked = table.where(F.col("key") % every == 0)
    size = asked.agg(F.sum(8 * (F.col("dim") + F.size("distances") + 4))).first()[0] or 0
    batches = -(-size // BATCH_BYTES) or 1
    found = None
    for number in range(batches):
        mine = asked.where(F.pmod(F.xxhash64("row"), F.lit(batches)) == number).collect()  # about BATCH_BYTES
        best = _ranked(_search(table, mine, k), k)
        best = written(best, "batch") if batches > 1 else best
        found = best if found is None else found.union(best)
    return found


def _ranked(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
