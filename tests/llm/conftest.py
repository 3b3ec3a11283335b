"""Odd and empty tables on disk."""

import pytest
from odd_rows import CLASHING, DOCUMENTS, INSULTS, document_rows, page_rows, vector_rows


def _write_all(spark, folder, documents, pages, vectors):
    frame = spark.createDataFrame(documents, DOCUMENTS)
    frame = frame.selectExpr("*", *[f"'odd' AS {name}" for name in CLASHING])
    frame.repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(r[0], 1, int(any(x in (r[1] or "") for x in INSULTS))) for r in documents if r[0] is not None]
    labels += [(None, 1, 1), (3, None, None), (999_999, 0, 1)] if documents else []
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    page_frame = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'odd' AS path", "1 AS first")
    page_frame.repartition(3).write.parquet(f"{folder}/pages.parquet")
    vector_frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").selectExpr("*", "'odd' AS key", "2 AS dim")
    vector_frame.repartition(3).write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def odd_tables(spark, tmp_path_factory):
    return _write_all(spark, tmp_path_factory.mktemp("odd"), document_rows(), page_rows(), vector_rows())


@pytest.fixture(scope="session")
def empty_tables(spark, tmp_path_factory):
    return _write_all(spark, tmp_path_factory.mktemp("empty"), [], [], [])
