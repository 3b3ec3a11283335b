"""Toxicity of texts by a factorization machine over hashed terms.

Terms are the distinct words of a text and the beginnings of longer words, hashed; a text's features are
which terms it has. Besides a weight, every term has a vector, and each pair of terms in a text adds the
product of its vectors, so that pairs such as an insult and a group mention count beyond their sum.

Training: a bounded sample of labelled rows is drawn by hash, half of each class; of near copies in it
(equal minima of several hashes over their terms) one stays, else their words would seem telling. Terms are
counted per class over the sample on the cluster, and those that a likelihood ratio test finds to depend on
the class are kept, with those that only pairs show: the joint presence of two common terms is tested too.
The driver gets only these and the common terms of the sampled rows. The intercept is then corrected to the
classes' shares among all labelled rows, so that scores are probabilities.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from cobasket.llm.arrow import ROWS, pieces, texts
from cobasket.llm.storage import written

_WORDS = re.compile(r"[^\W\d_]+")
# Lengths of word beginnings that are terms of their own.
BEGINNINGS = (4, 5, 6)
# Odd multipliers for the minima that tell near copies.
MIXERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
# Chunks of very long texts, cut at blanks.
STEP_CHARS = 1 << 20
# Words whose hashes or places a task keeps, some 500 bytes each.
CACHED = 1 << 16


def term_hashes(word: str, bits: int) -> tuple[int, ...]:
    """Hashes of a word and its beginnings."""
    shift = 64 - bits
    own = xxhash.xxh64_intdigest(word, 1) >> shift
    return (own, *(xxhash.xxh64_intdigest(word[:n], 2) >> shift for n in BEGINNINGS if len(word) >= n))


def words_of(text: str) -> set[str]:
    """The distinct words of a text, lower-cased; letters of any script."""
    found: set[str] = set()
    begin = 0
    while begin < len(text):
        end = begin + STEP_CHARS
        cut = text.find(" ", end) if end < len(text) else -1
        end = cut if cut >= 0 else len(text)
        found.update(_WORDS.findall(text[begin:end].lower()))
        begin = end
    return found


@dataclass
class FactorizationMachine:
    """Score of a set of terms: bias, weights of terms, and products of the terms' vectors for pairs."""

    terms: np.ndarray  # sorted hashes
    bits: int
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def margins(self, at: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        """``at`` are places in ``terms``, ``row`` says which text each belongs to, in order."""
        linear = np.bincount(row, self.weights[at], rows)
        v = self.vectors[at]
        total = np.stack([np.bincount(row, c, rows) for c in v.T], axis=1)
        own = np.bincount(row, (v * v).sum(axis=1), rows)
        return self.bias + linear + 0.5 * ((total * total).sum(axis=1) - own)

    def margins_in_parts(self, at: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        """The same, a few texts at a time, as the vectors of all their terms would take many times the places."""
        parts = [np.zeros(0)]
        for begin in range(0, rows, ROWS):
            first, last = np.searchsorted(row, [begin, begin + ROWS])
            parts.append(self.margins(at[first:last], row[first:last] - begin, min(ROWS, rows - begin)))
        return np.concatenate(parts)

    def fit(self, at: np.ndarray, row: np.ndarray, label: np.ndarray, steps: int, seed: int, rate: float = 0.03, ridge: float = 2e-2) -> None:
        """Adam on logistic loss over shuffled mini-batches of texts, ``steps`` of them at least; ``row`` ascends."""
        draw, rows = np.random.default_rng(seed), len(label)
        starts = np.searchsorted(row, np.arange(rows + 1))
        state = [np.zeros_like(self.weights) for _ in range(2)] + [np.zeros_like(self.vectors) for _ in range(2)]
        step, bias_state = 0, [0.0, 0.0]
        while step < steps:
            order = draw.permutation(rows)
            for begin in range(0, rows, 256):
                batch = order[begin : begin + 256]
                sizes = starts[batch + 1] - starts[batch]
                mine = np.repeat(np.arange(len(batch)), sizes)
                places = at[np.repeat(starts[batch] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())]
                v = self.vectors[places]
                total = np.stack([np.bincount(mine, c, len(batch)) for c in v.T], axis=1)
                error = 1 / (1 + np.exp(-self.margins(places, mine, len(batch)))) - label[batch]
                error /= len(batch)
                grad_w = np.bincount(places, error[mine], len(self.weights)) + ridge * self.weights / 2000
                pull = error[mine][:, None] * (total[mine] - v)
                grad_v = np.stack([np.bincount(places, c, len(self.weights)) for c in pull.T], axis=1) + ridge * self.vectors
                step += 1
                self.weights -= _adam(state[0:2], grad_w, step, rate)
                self.vectors -= _adam(state[2:4], grad_v, step, rate)
                bias_state[0] = 0.9 * bias_state[0] + 0.1 * error.sum()
                bias_state[1] = 0.999 * bias_state[1] + 0.001 * error.sum() ** 2
                self.bias -= rate * bias_state[0] / (1 - 0.9**step) / (np.sqrt(bias_state[1] / (1 - 0.999**step)) + 1e-8)

    def calibrate(self, margins: np.ndarray, label: np.ndarray) -> None:
        """Scale and shift the margins so that they fit the labels, smoothed by one row of either class.

        The penalties of training hold the margins of sure cases too close to zero.
        """
        ones, zeros = label.sum(), (1 - label).sum()
        wanted = np.where(label == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
        scale, shift = 1.0, 0.0
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(scale * margins + shift, -30, 30)))
            rest, weight = wanted - p, p * (1 - p) + 1e-9
            gradient = np.array([(rest * margins).sum(), rest.sum()])
            cross = (weight * margins).sum()
            curvature = np.array([[(weight * margins**2).sum() + 1e-3, cross], [cross, weight.sum() + 1e-3]])
            step = np.linalg.solve(curvature, gradient)
            step *= min(1.0, 0.5 / (np.abs(step).max() + 1e-12))
            scale, shift = scale + step[0], shift + step[1]
        scale = max(scale, 0.1)
        self.weights *= scale
        self.vectors *= np.sqrt(scale)
        self.bias = self.bias * scale + shift

    def scores(self, contents: list[str]) -> np.ndarray:
        """Probability that each text is toxic."""
        at: list[int] = []
        sizes = []
        for content in contents:
            mine: set[int] = set()
            mine.update(*map(self._places, words_of(content)))
            at.extend(sorted(mine))
            sizes.append(len(mine))
        row = np.repeat(np.arange(len(contents)), sizes)
        return 1 / (1 + np.exp(-self.margins(np.array(at, dtype=np.int64), row, len(contents))))

    def ready(self) -> FactorizationMachine:
        """Prepare for scoring: words are looked up once per task, and few of them matter."""
        place = {int(t): i for i, t in enumerate(self.terms)}

        @lru_cache(maxsize=CACHED)
        def places(word: str) -> tuple[int, ...]:
            return tuple(place[t] for t in term_hashes(word, self.bits) if t in place)

        self._places = places
        return self


def _adam(state: list[np.ndarray], gradient: np.ndarray, step: int, rate: float) -> np.ndarray:
    state[0] += 0.1 * (gradient - state[0])
    state[1] += 0.001 * (gradient * gradient - state[1])
    return rate * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.999**step)) + 1e-8)


def _minima(terms: list[int]) -> str:
    """Minima of four hashes over the terms, alike for texts that share nearly all of them."""
    if not terms:
        return ""
    mixed = np.array(terms, dtype=np.uint64)[:, None] * np.array(MIXERS, dtype=np.uint64)
    return ",".join(map(str, (mixed >> np.uint64(16)).min(axis=0).tolist()))


def _terms(rows: DataFrame) -> np.ndarray:
    return np.sort(rows.select("term").toArrow()["term"].to_numpy())


def _sampled(sample: DataFrame, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels of the sampled rows by key; and places in ``terms`` of what they have of these, with the rows' numbers."""
    wanted = F.broadcast(sample.sparkSession.createDataFrame([(int(t),) for t in terms], "term long"))
    of_rows = sample.select("key", F.explode("terms").alias("term")).join(wanted, "term").groupBy("key").agg(F.sort_array(F.collect_set("term")).alias("own"))
    data = sample.select("key", "label").join(of_rows, "key", "left").select("key", "label", F.coalesce("own", F.array().cast("array<long>")).alias("own"))
    table = data.toArrow().sort_by("key").combine_chunks()
    found = table["own"].combine_chunks()
    row = np.repeat(np.arange(table.num_rows), np.diff(found.offsets.to_numpy()))
    return table["label"].to_numpy().astype(float), np.searchsorted(terms, found.flatten().to_numpy()), row


def _ratio(in_1: np.ndarray, in_0: np.ndarray, ones: float, zeros: float) -> np.ndarray:
    """G of a feature that ``in_1`` and ``in_0`` rows of the classes have."""
    total, n = ones + zeros, in_1 + in_0
    result = np.zeros(np.shape(n))
    for part, of_class in ((in_1, ones), (in_0, zeros)):
        for seen, rows in ((part, n), (of_class - part, total - n)):
            result += 2 * seen * np.log(np.maximum(seen, 1) * total / (np.maximum(rows, 1) * of_class))
    return result


def telling_pairs(common: np.ndarray, at: np.ndarray, row: np.ndarray, label: np.ndarray, gain: float) -> np.ndarray:
    """The terms of pairs whose joint presence has a G that exceeds those of both its terms by ``gain``; ``row`` ascends.

    So terms stay that say nothing alone, while a telling term doesn't take along whatever stands beside it.
    """
    place = np.full(int(max(at.max(initial=-1), common.max(initial=-1))) + 2, -1)
    place[common] = np.arange(len(common))
    # How many rows of each class have both terms, added up over a few rows at a time; whole numbers are exact in single precision.
    together = np.zeros((2, len(common), len(common)), np.float32)
    for begin in range(0, len(label), ROWS):
        first, last = np.searchsorted(row, [begin, begin + ROWS])
        of = place[at[first:last]]
        has = np.zeros((min(ROWS, len(label) - begin), len(common)), np.float32)
        has[row[first:last][of >= 0] - begin, of[of >= 0]] = 1
        is_1 = label[begin : begin + ROWS] == 1
        for part, own in zip(together, (has[is_1], has[~is_1]), strict=True):
            for at_once in range(0, len(common), 256):
                part[at_once : at_once + 256] += own[:, at_once : at_once + 256].T @ own
    ones, zeros = label.sum(), (1 - label).sum()
    alone = _ratio(together[0].diagonal(), together[1].diagonal(), ones, zeros)
    found = np.zeros(len(common), bool)
    for begin in range(0, len(common), 64):
        block = slice(begin, begin + 64)
        both = _ratio(together[0, block].astype(float), together[1, block].astype(float), ones, zeros)
        more = both - np.maximum(alone[block, None], alone[None, :]) >= gain
        found[block] |= more.any(axis=1)
        found |= more.any(axis=0)
    return common[found]


def held_out(key: Column) -> Column:
    """Rows whose labels must not be learnt from: a quarter, by the CRC of the key as text."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(
    rows: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    sample_per_class: int = 5000, bits: int = 40, factors: int = 6, steps: int = 600, significance: float = 20.0,
    pair_terms: int = 2048, pair_significance: float = 40.0, seed: int = 11,
) -> FactorizationMachine:
    """Train on at most ``sample_per_class`` rows of each class, those with the smallest key hash.

    ``labels`` has ``key`` and ``label`` (0 or 1); null labels or keys and held-out keys are left out, and keys labelled more
    than once count by their largest label. Features are the terms whose likelihood ratio statistic G is ``significance``
    or more, and those of pairs that tell at least ``pair_significance`` more than either term does; pairs are sought
    among the ``pair_terms`` terms that most sampled rows have. Without labelled rows every score is 0.5; without
    one of the classes every score is the share of class 1, smoothed.
    """
    spark = rows.sparkSession
    known = labels.select(F.col(key).cast("long").alias("key"), F.col(label).cast("int").alias("label")).dropna()
    known = known.where(~held_out(F.col("key"))).groupBy("key").agg(F.max("label").alias("label"))
    shares = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    ones, zeros = shares.get(1, 0), shares.get(0, 0)
    prior = float(np.log((ones + 0.5) / (zeros + 0.5)))
    drawn: list = []
    for value in (0, 1):
        of_class = known.where(F.col("label") == value).orderBy(F.xxhash64("key", F.lit(seed)), "key")
        drawn += [(r["key"], value) for r in of_class.limit(sample_per_class).collect()]
    none = FactorizationMachine(np.zeros(0, np.int64), bits, prior, np.zeros(0), np.zeros((0, factors)))
    if not ones or not zeros:
        return none

    def hash_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = lru_cache(maxsize=CACHED)(lambda word: term_hashes(word, bits))
        for batch in pieces(batches, "text"):
            found, alike = [], []
            for content in texts(batch, "text"):
                mine: set[int] = set()
                mine.update(*map(hashes, words_of(content)))
                found.append(sorted(mine))
                alike.append(_minima(found[-1]))
            columns = [batch.column("key"), batch.column("label"), pa.array(found, pa.list_(pa.int64())), pa.array(alike)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "label", "terms", "alike"])

    # At most 2 * sample_per_class keys.
    chosen = F.broadcast(spark.createDataFrame(drawn, "key long, label int"))
    narrow = rows.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).join(chosen, "key")
    hashed = narrow.select("key", "label", "text").mapInArrow(hash_terms, "key long, label int, terms array<long>, alike string")
    hashed = written(hashed, "terms")
    once = hashed.groupBy("alike").agg(F.min("key").alias("key"))
    sample = hashed.join(once, ["alike", "key"], "left_semi").dropDuplicates(["key"])
    size = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if not size.get(0) or not size.get(1):
        return none
    counts = (
        sample.select("label", F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(F.sum("label").cast("double").alias("in_1"), F.sum(1 - F.col("label")).cast("double").alias("in_0"))
    )
    total = size[0] + size[1]
    cells = [
        (F.col(f"in_{c}") if has else size[c] - F.col(f"in_{c}"), F.col("n") if has else total - F.col("n"), size[c])
        for c in (0, 1)
        for has in (True, False)
    ]
    parts = [F.when(seen > 0, 2 * seen * F.ln(seen * total / (rows_ * of_class))).otherwise(0.0) for seen, rows_, of_class in cells]
    counts = counts.withColumn("n", F.col("in_0") + F.col("in_1")).withColumn("ratio", sum(parts[1:], parts[0]))
    counts = written(counts.select("term", "n", "ratio"), "term_counts")
    telling = _terms(counts.where(F.col("ratio") >= significance))
    common = _terms(counts.orderBy(F.col("n").desc(), "term").limit(pair_terms))
    seen = np.union1d(telling, common)
    label_of, at, row = _sampled(sample, seen)
    kept = np.union1d(telling, seen[telling_pairs(np.searchsorted(seen, common), at, row, label_of, pair_significance)])
    place = np.searchsorted(kept, seen)
    wanted = np.isin(seen, kept)[at]
    at, row = place[at[wanted]], row[wanted]
    start = np.random.default_rng(seed).normal(0, 0.05, (len(kept), factors))
    of_sample = float(np.log(label_of.sum() / (len(label_of) - label_of.sum())))
    machine = FactorizationMachine(kept, bits, of_sample, np.zeros(len(kept)), start)
    machine.fit(at, row, label_of, steps, seed)
    machine.calibrate(machine.margins_in_parts(at, row, len(label_of)), label_of)
    machine.bias += prior - of_sample
    return machine


def score(rows: DataFrame, machine: FactorizationMachine, key: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """Per row: ``key``, ``held_out``, ``score`` and ``predicted`` (1 from ``threshold`` on).

    Only the text decides; a null or empty one gets the score of no terms. Nothing is shuffled. Null keys stay null and
    aren't held out; repeated rows give repeated results and an empty table none; long texts are scored whole; other
    columns aren't read.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine.ready()
        for batch in pieces(batches, "text"):
            found = pa.array(machine.scores(texts(batch, "text")))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("held_out"), found], names=["key", "held_out", "score"])

    narrow = rows.select(F.col(key).alias("key"), held_out(F.col(key)).alias("held_out"), F.col(text).alias("text"))
    kind = narrow.schema["key"].dataType.simpleString()
    scored = narrow.mapInArrow(judge, f"key {kind}, held_out boolean, score double")
    return scored.select(F.col("key").alias(key), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def reject(rows: DataFrame, machine: FactorizationMachine, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """``rows`` without those whose text scores ``threshold`` or more; all columns as they were.

    A null or empty text gets the score of no terms, and so stays unless most texts are toxic.
    """

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine.ready()
        for batch in pieces(batches, text):
            yield batch.filter(pa.array(machine.scores(texts(batch, text)) < threshold))

    return rows.mapInArrow(keep, rows.schema)
