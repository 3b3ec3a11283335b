import math

import pytest
from pyspark.sql import functions as F

from cobasket.functions.scores import bound, similarity_level
from cobasket.operators.documents import suggestion_documents, result_arrays
from cobasket.operators.ranking import best_per_item, normalised, ranked_similar, scored
from cobasket.schemas import SUGGESTIONS
from cobasket.tuning import ORDER_TUNING, PURCHASE_TUNING, Tuning
from tests.helpers import EDGE_TYPES, rows


def _level(spark, nmf, freq_rec, freq_ref, *args):
    df = spark.createDataFrame([(nmf, freq_rec, freq_ref)], "nmf double, c long, r long")
    return df.select(similarity_level(F.col("nmf"), F.col("c"), F.col("r"), *args)).first()[0]


@pytest.mark.parametrize(
    "nmf, freq_rec, freq_ref, expected",
    [
        (0.4, 1000, 5, 0.004792475380452137),
        (0.4, 20, 5, 0.023635874718219315),
        (8 / 3, 3, 4, 1.070322),
        (8 / 3, 4, 3, 1.347304),
    ],
)
def test_similarity_level(spark, nmf, freq_rec, freq_ref, expected):
    assert _level(spark, nmf, freq_rec, freq_ref, 0.2, 2) == pytest.approx(expected, rel=1e-6)


def test_similarity_level_survives_extremes(spark):
    assert _level(spark, 1.0, 0, 5) is None
    assert _level(spark, 1.0, 5, 0) is None
    assert _level(spark, 1e9, 1, 10**12) > 0


def test_bound(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1e12,), (None,)], "v double")
    zero, one, huge, null = (r[0] for r in df.select(bound(F.col("v"))).collect())
    assert zero == 0.0 and null is None
    assert one == pytest.approx(1 / (1 + 1 / math.log1p(1)))
    assert 0.9 < huge < 1


def _directed(spark, edges):
    return spark.createDataFrame([("c1", ref, rec, 3, nmf, 4, 5) for ref, rec, nmf in edges], EDGE_TYPES)


def test_rank_ties_go_to_the_higher_id_in_byte_order(spark):
    edges = _directed(spark, [("A", "9", 1.0), ("A", "10", 1.0), ("A", "é", 1.0), ("A", "B", 2.0)])
    ranked = ranked_similar(edges, 0.2, 2, 3)
    assert rows(ranked, "rank", "item_rec") == [(1, "B"), (2, "é"), (3, "9")]


def test_normalised_score_is_relative_to_the_best(spark):
    edges = _directed(spark, [("A", "B", 2.0), ("A", "C", 1.0), ("B", "C", 0.5)])
    found = {(r.item_ref, r.item_rec): (r.asl, r.nsl) for r in ranked_similar(edges, 0.2, 2, 40).collect()}
    assert found["A", "B"][1] == 1.0 and found["B", "C"][1] == 1.0
    assert found["A", "C"][1] == pytest.approx(found["A", "C"][0] / found["A", "B"][0])


def test_the_cut_does_not_change_the_maximum(spark):
    edges = scored(_directed(spark, [("A", f"r{n}", 1.0 + n) for n in range(9)]), 0.2, 2)
    cut = {r.item_rec: r.nsl for r in normalised(best_per_item(edges, 2)).collect()}
    whole = {r.item_rec: r.nsl for r in normalised(best_per_item(edges, 100)).collect()}
    assert cut == {k: whole[k] for k in ("r8", "r7")}


def test_result_arrays_are_in_rank_order_and_need_no_exchange(spark):
    edges = _directed(spark, [("A", "9", 1.0), ("A", "10", 1.0), ("A", "B", 2.0)]).repartition(4)
    arrays = result_arrays(ranked_similar(edges, 0.2, 2, 40))
    assert [r.rec for r in arrays.first().results] == ["B", "9", "10"]
    plan = arrays._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_documents_have_the_declared_schema(spark):
    edges = _directed(spark, [("A", "B", 2.0)])
    tuning = PURCHASE_TUNING.with_overrides(min_amf="3", alpha="1")
    documents = suggestion_documents(result_arrays(ranked_similar(edges, 1, 2, 40)), tuning)
    names = lambda t: t.simpleString()  # noqa: E731  (nullability aside)
    assert names(documents.schema) == names(SUGGESTIONS)
    row = documents.first()
    assert (row.client, row["product"]) == ("c1", "A")
    assert row.tuning.asDict() == {"nmf": 0.4, "alpha": 1.0, "adjust": 2.0, "amf": 3.0}
    assert row.results[0].asDict() | {"asl": 0} == {
        "rec": "B", "amf": 3, "nmf": 2.0, "freq_rec": 5, "freq_ref": 4, "asl": 0, "nsl": 1.0,
    }


def test_tuning_defaults_and_overrides():
    assert (PURCHASE_TUNING.alpha, ORDER_TUNING.alpha) == (0.2, 0.1)
    assert PURCHASE_TUNING == Tuning(0.2, 2.0, 2.1, 0.4, 40, 1000)
    assert PURCHASE_TUNING.with_overrides(max_similar="5", min_nmf="0.5") == Tuning(0.2, 2.0, 2.1, 0.5, 5, 1000)
    with pytest.raises(ValueError, match="unknown tuning"):
        PURCHASE_TUNING.with_overrides(beta=1)
