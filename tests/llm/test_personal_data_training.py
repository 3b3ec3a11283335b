"""Training of the personal-data model on all texts."""

import random
from bisect import bisect_left
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("cobasket.llm")

from cobasket.llm import personal_data  # noqa: E402
from cobasket.llm.boosting import BoostedTrees  # noqa: E402


def test_all_candidates_of_all_texts_count(spark):
    many = " ; ".join(f"{n}-555-{n + 1000}" for n in range(100, 160))
    contents = [f"call +1 555 {n:03} {n * 7 % 10000:04} or ann.{n}@example.org" for n in range(4300)] + [many]
    rows = spark.createDataFrame([(x,) for x in [*contents, *contents[:50], None, "", "none"]], "body string").repartition(5)
    digests = rows.selectExpr("body", "xxhash64(body, 7) AS digest").distinct().where("body RLIKE '[0-9@]'").collect()
    expected = Counter()
    for content, digest in digests:
        for kind, label, values in personal_data._examples(content, random.Random(digest ^ 7)):
            expected[kind, digest % 4 == 0, label, bytes(bisect_left(personal_data.EDGES, v) for v in values)] += 1
    found = personal_data.counted_examples(rows, "body").collect()
    assert {(r["kind"], r["held"], r["label"], bytes(r["bins"])): r["n"] for r in found} == expected
    # More than any sample of 4,000 texts or 40 candidates a text had.
    assert len(digests) == 4301 and sum(1 for _ in personal_data._examples(many, random.Random(1))) > 40


def test_trees_grow_from_sums_of_parts():
    draw = np.random.default_rng(2)
    x = draw.integers(0, 9, (900, 4)).astype(float)
    y = ((x[:, 0] > 4) ^ (x[:, 2] > 3)).astype(int)
    weight = draw.integers(1, 5, 900)
    whole = BoostedTrees(trees=6).fit(x, y, weight)
    parts = BoostedTrees(trees=6).begin(whole.edges, float(np.average(y, weights=weight)))
    binned = parts._binned(x)
    for _ in range(18):
        parts.split(sum(parts.sums(binned[i::3], y[i::3], weight[i::3]) for i in (2, 0, 1)))
    assert (parts.predict(x) == whole.predict(x)).all()
    assert ((whole.predict(x) > 0.5) == y).mean() > 0.95


def test_model_is_the_same_in_any_layout(spark, monkeypatch):
    contents = [f"call +1 555 {n:03} {n * 7 % 10000:04} or ann.{n}@mail.example.org, order {n * 7919}-{n * 31}" for n in range(300)]
    rows = spark.createDataFrame([(x,) for x in contents], "text string")
    one = personal_data.train(rows.coalesce(1))
    monkeypatch.setattr(personal_data, "FEW", 0)  # the cluster adds up
    other = personal_data.train(rows.repartition(7))
    assert one.thresholds == other.thresholds and one.thresholds
    for kind, trees in one.trees.items():
        assert all((a == b).all() for s, t in zip(trees.splits, other.trees[kind].splits, strict=True) for a, b in zip(s, t, strict=True))
