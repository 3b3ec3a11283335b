"""Personal data in texts: candidates, boosted trees, calibrated thresholds.

1. *Generators* of high recall propose spans, overlapping ones too: the four base patterns, and looser ones
   for addresses written with "at" and "dot", number groups with and without a country code, and dotted groups.
2. *Features* describe the format of a span (lengths, separators, grouping, share of digits) and its context
   (neighbouring characters, the words before). The anchors of the base rules, "+" and "@", are masked, so
   that the trees learn what such data look like rather than the rule itself. A base rule that ran on into a
   neighbouring number, and failed, is thus made up for.
3. *Boosted trees*, one set per kind, are trained on the candidates of all texts:
   positive are base spans, also beside other numbers, and rewritten forms of them, negative are
   candidates that no base rule takes, and spoilt forms. Equal examples are counted first; the cluster then adds up
   histograms, a job per level of a tree of every kind, so the driver sees sums alone.
4. The *threshold* of each kind is the lowest one that reaches the wanted precision on candidates
   held out from training; a kind that can't reach it adds nothing.

Spans that a base rule finds always stay. Added spans don't overlap them or each other.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import accumulate, pairwise, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cobasket.llm.arrow import pieces, texts
from cobasket.llm.boosting import BINS, BoostedTrees
from cobasket.llm.storage import written

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, str, int]  # start, kind, end

_LOCAL = string.ascii_letters + string.digits + "._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    values = [int(c) for c in reversed(digits)]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses: an address begins with all local characters before its "@"."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = free + len(text[free:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        free = domain.end() if domain else at + 1
        if domain:
            yield start, free
        at = text.find("@", free)


def _small_parts(span: str) -> bool:
    return all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in span.split("."))


def base_spans(text: str) -> list[Span]:
    """The spans of the four base rules, by start and then kind; kinds may overlap each other."""
    found: list[Span] = []
    if "@" in text:
        found += [(a, "email", b) for a, b in _emails(text)]
    if _ANY_DIGIT.search(text):
        found += [(m.start(), "ip", m.end()) for m in _IP.finditer(text) if _small_parts(m[0])]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = _NOT_DIGIT.sub("", m[0])
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), "card", m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                    found.append((m.start(), "phone", m.end()))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


_ANY_DIGIT = re.compile(r"[0-9]")
# Whatever _LOOSE_EMAIL can match holds one of these.
_ANY_AT = re.compile(r"@|\bat\b", re.IGNORECASE)
# Loose forms of any length. Runs are matched whole, from their beginning only, so long ones cost linear time.
_LOOSE_EMAIL = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\s?(?:@|\(at\)|\[at\]|\bat\b)\s?[A-Za-z0-9-]++"
    r"(?:\s?(?:\.|\(dot\)|\[dot\]|\bdot\b)\s?[A-Za-z0-9-]{2,}+)++",
    re.IGNORECASE,
)
_LOOSE_IP = re.compile(r"(?<![0-9.])[0-9]{1,3}+(?:\s?(?:\.|\[\.\]|\(\.\))\s?[0-9]{1,3}+){3}(?![0-9])")
# What may stand between the groups of digits of one number, and how many digits a number has.
_BETWEEN = re.compile(r"[ ()./-]+")
DIGITS = {"phone": (9, 15), "card": (13, 19)}
_LOOSE_CARD = re.compile(r"(?<![0-9])(?:[0-9]{13,19}+|[0-9]{4}(?:[ -][0-9]{4}){3})(?![0-9])")


def candidates(text: str) -> list[Span]:
    """Spans that may be personal data, beyond the base rules; overlapping ones included."""
    found: list[Span] = []
    if _ANY_AT.search(text):
        found += [(m.start(), "email", m.end()) for m in _LOOSE_EMAIL.finditer(text)]
    if _ANY_DIGIT.search(text):
        found += [(m.start(), "ip", m.end()) for m in _LOOSE_IP.finditer(text)]
        found += [(m.start(), "card", m.end()) for m in _LOOSE_CARD.finditer(text)]
        found += _numbers_in_runs(text)
    return sorted(dict.fromkeys(found))  # mostly in order already


def _numbers_in_runs(text: str) -> list[Span]:
    """From every group of digits on, up to the end of every group that makes as many digits as a kind has.

    Only the digits bound a span, neither its groups nor what stands between them. All groups are handled at once.
    """
    groups = [m.span() for m in re.finditer(r"[0-9]++", text)]
    sizes = [b - a for a, b in groups]
    if sum(sizes) < min(least for least, _ in DIGITS.values()):
        return []
    starts = []
    for begin, _ in groups:
        start = begin
        for sign in "(+":
            if text[start - 1 : start] == sign:
                start -= 1
        if text[start - 1 : start].isalnum():
            start = begin if start < begin else -1  # the sign belongs to what stands before it, or the group does
        starts.append(start)
    number = len(groups)
    ends = np.array([b for _, b in groups])
    open_end = np.array([not text[b : b + 1].isalnum() for _, b in groups])
    # Per group: the digits up to its end, and the last group of its run of numbers.
    digits = np.cumsum(sizes)
    breaks = [i for i, (a, b) in enumerate(pairwise(groups)) if not _BETWEEN.fullmatch(text, a[1], b[0])] + [number - 1]
    last = np.array(breaks)[np.searchsorted(breaks, np.arange(number))]
    found = []
    for kind, (least, most) in DIGITS.items():
        first = np.searchsorted(digits, digits - sizes + least)
        behind = np.minimum(np.searchsorted(digits, digits - sizes + most, side="right"), last + 1)
        count = np.where(np.array(starts) >= 0, np.maximum(behind - first, 0), 0)
        owner = np.repeat(np.arange(number), count)
        end = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + first[owner]
        owner, end = owner[open_end[end]], end[open_end[end]]
        found += zip(np.array(starts)[owner].tolist(), repeat(kind), ends[end].tolist())
    return found


# Words that introduce personal data, per kind.
_CUES = {
    "email": re.compile(r"mail|contact|write|send|kontakt|correo|courriel|address", re.IGNORECASE),
    "ip": re.compile(r"\bip\b|host|server|addr|login|from", re.IGNORECASE),
    "card": re.compile(r"card|visa|master|amex|credit|payment|karte|carte|tarjeta", re.IGNORECASE),
    "phone": re.compile(r"phone|call|tel|fax|mobile|cell|handy|numero|contact", re.IGNORECASE),
}
_OTHER_CUES = re.compile(r"\bid\b|isbn|order|invoice|version|date|serial|token|ref\b|total|page|doi", re.IGNORECASE)
CONTEXT = 24


def features(text: str, start: int, kind: str, end: int) -> list[float]:
    """Format and context of a span, without the anchors of the base rules."""
    span = text[start:end]
    bare = span.lstrip("+")
    groups = re.findall(r"[0-9]+", bare)
    digits = "".join(groups)
    sizes = [len(g) for g in groups]
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    left, right = before[-1:] or " ", after[:1] or " "
    year = any(len(g) == 4 and g[:2] in ("19", "20") for g in groups)
    values = [int(g[:4]) for g in groups]
    words = re.findall(r"[a-z]+", bare.lower())
    return [
        float(len(digits)),
        float(len(groups)),
        float(max(sizes, default=0)),
        float(min(sizes, default=0)),
        float(sizes[0] if sizes else 0),
        float(sizes[-1] if sizes else 0),
        float(len(set(sizes)) == 1),
        float(len(set(digits)) if digits else 0),
        float(bare.count("-")),
        float(bare.count(" ")),
        float(bare.count(".")),
        float(bare.count("/")),
        float("(" in bare and ")" in bare),
        float(bare.count("(") == bare.count(")")),
        float(year),
        float(max(values, default=0) <= 255),
        float(int(digits[:1] or 0)),
        float(bool(digits) and luhn(digits)),
        float(sum(len(w) for w in words)),
        float(len(words)),
        float(len(words[-1]) if words else 0),
        float(left.isspace() or left in "([<\"'"),
        float(right.isspace() or right in ".,;:)]>\"'!?"),
        float(left.isalnum()),
        float(bool(_CUES[kind].search(before))),
        float(bool(_OTHER_CUES.search(before))),
        float(before.count("=") + before.count("#") + before.count("$")),
        float(sum(c.isdigit() for c in before)),
        float(sum(c.isdigit() for c in after)),
    ]


def _forms(span: str, kind: str, draw: random.Random) -> list[tuple[str, int]]:
    """Rewritten forms of a base span (1) and spoilt ones (0)."""
    digits = _NOT_DIGIT.sub("", span)
    made_up = "".join(draw.choice(string.digits) for _ in digits)
    if kind == "email":
        at = draw.choice((" at ", " (at) ", "(at)", " [at] ", "[at]", " @ "))
        dot = draw.choice((" dot ", "(dot)", " [dot] ", "[dot]", "."))
        name, domain = span.split("@", 1)
        return [(name + at + domain.replace(".", dot), 1), (f"{name.split('.')[0]} at {domain.split('.')[0]}.5", 0)]
    if kind == "ip":
        dot = draw.choice(("[.]", "(.)", " . "))
        spoilt = ".".join(str(draw.randint(0, 20)) for _ in range(4))
        return [(span.replace(".", dot), 1), (f"{draw.randint(256, 999)}." + spoilt.split(".", 1)[1], 0)]
    if kind == "card":
        groups = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        last = draw.randint(1, 9) + int(digits[-1])
        spoilt = digits[:-1] + str(last % 10)  # one digit off never passes the check sum
        return [(draw.choice((".", "/", " - ")).join(groups), 1), (spoilt[:11] + "-" + spoilt[11:], 0), (spoilt, 0)]
    country, local = digits[:-10], digits[-10:]
    shaped = draw.choice(("({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "({}){}-{}", "{} {} {}"))
    national = shaped.format(local[:3], local[3:6], local[6:])
    date = f"{draw.randint(1980, 2030)}-{draw.randint(1, 12):02}-{draw.randint(1, 28):02} {draw.randint(0, 23):02}"
    return [(national, 1), (f"00{country or 1} {national}", 1), (date, 0), (made_up, 0), (f"{made_up[:5]}.{made_up[5:]}", 0)]


@dataclass
class PersonalDataModel:
    """Boosted trees and the threshold of each kind that could be trained."""

    trees: dict[str, BoostedTrees] = field(default_factory=dict)
    thresholds: dict[str, float] = field(default_factory=dict)

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """The base spans, and all spans: base and added ones."""
        base = base_spans(text)
        starts, ends = [b[0] for b in base], list(accumulate((b[2] for b in base), max))
        fresh = [s for s in candidates(text) if s[1] in self.trees and not _meets(starts, ends, s)]
        if not fresh:
            return base, base
        scored: list[tuple[float, Span]] = []
        for kind, trees in self.trees.items():
            mine = [s for s in fresh if s[1] == kind]
            if mine:
                chance = trees.predict(np.array([features(text, *s) for s in mine]))
                scored += [(p, s) for p, s in zip(chance.tolist(), mine, strict=True) if p >= self.thresholds[kind]]
        added: list[Span] = []
        starts, ends = [], []
        for _, span in sorted(scored, key=lambda x: (-x[0], x[1])):
            if not _meets(starts, ends, span):
                at = bisect_left(starts, span[0])
                starts.insert(at, span[0])
                ends.insert(at, span[2])
                added.append(span)
        return base, sorted(base + added, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def _meets(starts: list[int], ends: list[int], span: Span) -> bool:
    """Whether a span overlaps one of others; both lists are in order."""
    before = bisect_left(starts, span[2])
    return before > 0 and ends[before - 1] > span[0]


def _examples(text: str, draw: random.Random) -> Iterator[tuple[str, int, list[float]]]:
    """Kind, label and features of the candidates of one text and of forms made from its base spans."""
    base = base_spans(text)
    for start, kind, end in base:
        yield kind, 1, features(text, start, kind, end)
        for form, label in _forms(text[start:end], kind, draw):
            changed = text[max(0, start - CONTEXT) : start] + form + text[end : end + CONTEXT]
            at = min(start, CONTEXT)
            yield kind, label, features(changed, at, kind, at + len(form))
        # The same span right behind and right before another number.
        number = f"{draw.randint(200, 999)}-{draw.randint(1000, 9999)}"
        beside = f"({number[:3]}) {number} {text[start:end]} {number}.{draw.randint(1, 99)}"
        at = beside.index(text[start:end])
        yield kind, 1, features(beside, at, kind, at + end - start)
        # What runs on from the span into a number, amid what really stands around it.
        around = text[max(0, start - CONTEXT) : start] + text[start:end] + f" {number}" + text[end : end + CONTEXT]
        at = min(start, CONTEXT)
        stop = at + end - start
        merged = [s for s in candidates(around) if s[1] == kind and at <= s[0] < stop < s[2]]
        for span in draw.sample(merged, min(3, len(merged))):
            yield kind, 0, features(around, *span)
    starts, ends = [b[0] for b in base], list(accumulate((b[2] for b in base), max))
    for start, kind, end in candidates(text):
        if not _meets(starts, ends, (start, kind, end)):
            yield kind, 0, features(text, start, kind, end)


# Where features, small whole numbers all, are cut into bins.
EDGES = (*range(20), 22, 25, 29, 34, 40, 50, 64, 96, 128, 256)
FEATURES = 29
# Examples passed on at a time.
EXAMPLES = 50_000
# Up to so many counted examples, the driver adds them up itself, which spares a job per level.
FEW = 50_000
# Scores are counted by this part of one to set thresholds, a power of two, so that the borders are exact.
GRID = 1 << 14

Examples = dict[tuple[int, str, int, bytes], int]  # digest, kind, label, bins; how often


def _example_rows(found: Examples) -> pa.RecordBatch:
    digest, kind, label, bins = zip(*found, strict=True)
    columns = [pa.array(digest, pa.int64()), pa.array(kind, pa.string()), pa.array(label, pa.int32()), pa.array(bins, pa.binary())]
    return pa.RecordBatch.from_arrays([*columns, pa.array(found.values(), pa.int64())], names=["digest", "kind", "label", "bins", "n"])


def counted_examples(rows: DataFrame, text: str = "text", seed: int = 7) -> DataFrame:
    """``(kind, held, label, bins, n)``: how often each example of a kind comes up in all texts that hold a digit or an "@".

    ``bins`` has a byte per feature. A quarter of the texts, by their hash, is held out. Copies are one text, null texts don't count.
    """

    def examine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            found: Examples = Counter()
            for digest, content in zip(batch.column("digest").to_pylist(), texts(batch, "text"), strict=True):
                for kind, label, values in _examples(content, random.Random(digest ^ seed)):
                    found[digest, kind, label, bytes(bisect_left(EDGES, v) for v in values)] += 1
                if len(found) >= EXAMPLES:
                    yield _example_rows(found)
                    found = Counter()
            if found:
                yield _example_rows(found)

    holding = rows.select(F.col(text).alias("text")).where(F.col("text").rlike("[0-9@]"))
    hashed = holding.select(F.xxhash64("text", F.lit(seed)).alias("digest"), "text")
    found = hashed.mapInArrow(examine, "digest long, kind string, label int, bins binary, n long")
    # Copies of a text give the same examples, the drawn ones too, as often each.
    once = found.groupBy("digest", "kind", "label", "bins").agg(F.max("n").alias("n"))
    held = (F.pmod("digest", F.lit(4)) == 0).alias("held")
    return once.groupBy("kind", held, "label", "bins").agg(F.sum("n").alias("n"))


def _by_kind(batch: pa.RecordBatch, kinds: Iterable[str]) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray]]:
    """Kind, bins, labels and counts of the examples of each of the ``kinds``."""
    kind = np.array(batch.column("kind").to_pylist())
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, FEATURES)
    label, n = batch.column("label").to_numpy(), batch.column("n").to_numpy()
    for own in kinds:
        mine = kind == own
        if mine.any():
            yield own, bins[mine], label[mine], n[mine]


def _added_up(batches: Iterable[pa.RecordBatch], trees: dict[str, BoostedTrees]) -> dict[str, np.ndarray]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        for kind, bins, label, n in _by_kind(batch, trees):
            total[kind] = total.get(kind, 0) + trees[kind].sums(bins, label, n)
    return total


def _level_sums(examples: DataFrame, trees: dict[str, BoostedTrees]) -> dict[str, np.ndarray]:
    """The sums over all examples by which the trees of every kind grow a level."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, sums in _added_up(batches, trees).items():
            flat = sums.reshape(2, -1)
            cell = np.flatnonzero(flat.any(axis=0))
            yield pa.RecordBatch.from_pydict({"kind": [kind] * len(cell), "cell": cell, "g": flat[0, cell], "h": flat[1, cell]})

    parts = examples.mapInArrow(add_up, "kind string, cell long, g long, h long")
    level = next(iter(trees.values())).level
    sums = {kind: np.zeros((2, 2**level * FEATURES * BINS), np.int64) for kind in trees}
    # At most all cells of the histograms of all kinds.
    for kind, cell, g, h in parts.groupBy("kind", "cell").agg(F.sum("g"), F.sum("h")).collect():
        sums[kind][:, cell] = g, h
    return {kind: flat.reshape(2, 2**level, FEATURES, BINS) for kind, flat in sums.items()}


def _thresholds(held: DataFrame, trees: dict[str, BoostedTrees], precision: float) -> dict[str, float]:
    """The lowest score of each kind from which on the wanted precision holds, a half at least; none, if it never does."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, bins, label, n in _by_kind(batch, trees):
                step = np.floor(trees[kind].predict_binned(bins) * GRID).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"kind": [kind] * len(n), "step": step, "right": n * label, "n": n})

    counts = held.mapInArrow(count, "kind string, step long, right long, n long")
    # At most as many rows a kind as there are steps.
    steps = counts.groupBy("kind", "step").agg(F.sum("right"), F.sum("n")).collect()
    found = {}
    for own in trees:
        right = n = 0
        for _, step, more_right, more in sorted((r for r in steps if r[0] == own), key=lambda r: -r[1]):
            right, n = right + more_right, n + more
            if right >= precision * n:
                found[own] = max(0.5, step / GRID)
    return found


def train(rows: DataFrame, text: str = "text", precision: float = 0.995, seed: int = 7) -> PersonalDataModel:
    """Train on the candidates of all texts, of which a quarter is held out to set thresholds.

    The model doesn't depend on partitioning. Copies are one text, null texts don't count, and without enough candidates
    of a kind the model adds none of it. Examples are counted in a table in the shared folder.
    """
    counted = written(counted_examples(rows, text, seed), "examples")
    counts = {tuple(r[:3]): r[3] for r in counted.groupBy("kind", "held", "label").agg(F.sum("n")).collect()}
    edges = [np.array(EDGES, float)] * FEATURES
    trees = {}
    for kind in KINDS:
        wrong, right, held_right = (counts.get((kind, *at), 0) for at in ((False, 0), (False, 1), (True, 1)))
        if wrong and right and held_right and wrong + right + held_right + counts.get((kind, True, 0), 0) >= 40:
            trees[kind] = BoostedTrees().begin(edges, right / (wrong + right))
    if not trees:
        return PersonalDataModel()
    learnt = counted.where(~F.col("held"))
    few = learnt.toArrow().to_batches() if learnt.count() <= FEW else None
    for _ in range(max(t.trees * t.depth for t in trees.values())):
        for kind, sums in (_level_sums(learnt, trees) if few is None else _added_up(few, trees)).items():
            trees[kind].split(sums)
    thresholds = _thresholds(counted.where("held"), trees, precision)
    return PersonalDataModel({k: t for k, t in trees.items() if k in thresholds}, thresholds)


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def find(rows: DataFrame, model: PersonalDataModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, base spans per kind (``n_email`` and so on), ``base_sha256`` and all ``spans``.

    Texts are searched whole where they were read. Null texts are empty and have none, null keys stay null, repeated
    rows give repeated results and an empty table none; other columns, whatever their names, aren't read.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            found = [model.spans(x) for x in texts(batch, "text")]
            counts = {f"n_{k}": pa.array([sum(s[1] == k for s in base) for base, _ in found], pa.int64()) for k in KINDS}
            yield pa.RecordBatch.from_pydict(
                {"key": batch.column("key")}
                | counts
                | {
                    "base_sha256": [hashlib.sha256(listed(base).encode()).hexdigest() for base, _ in found],
                    "spans": [listed(spans) for _, spans in found],
                }
            )

    narrow = rows.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = narrow.schema["key"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    found = narrow.mapInArrow(search, f"key {kind}, {counts}, base_sha256 string, spans string")
    return found.withColumnRenamed("key", key)


def redact(rows: DataFrame, model: PersonalDataModel, text: str = "text") -> DataFrame:
    """``rows`` with every span in ``text`` replaced by its kind, as in "[EMAIL]"; overlapping spans together.

    All rows and columns are kept, repeated rows and clashing names too; a null text stays null, an empty table empty.
    """

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            at = batch.schema.get_field_index(text)
            clean = [x if x is None else _redacted(x, model.spans(x)[1]) for x in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(clean, batch.schema.field(at).type))

    return rows.mapInArrow(replace, rows.schema)


def _redacted(text: str, spans: list[Span]) -> str:
    out, done = [], 0
    for start, kind, end in spans:
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join(out) + text[done:]
