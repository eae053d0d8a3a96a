"""The model and search queries over whole texts, which have no SQL twin, on the smallest tables."""

import pytest

import __spark_entry__ as entry


def rows(spark, folder, name):
    return entry.queries()[f"{name}_whole_text"](spark, folder).collect()


def test_every_document_is_predicted(spark, folder):
    found = rows(spark, folder, "train_and_predict")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id").collect()
    assert sorted(r["Id"] for r in found) == sorted(r["doc_id"] for r in docs)
    assert {r["Category"] for r in found} <= {"0", "1"}


@pytest.mark.parametrize("name", ["oob_curve", "oob_curve_csv"])
def test_curve_over_the_texts(spark, folder, name):
    found = {r["n"]: r["oob_score"] for r in rows(spark, folder, name)}
    assert sorted(found) == [3, 4, 5, 6, 7, 8] and all(0.7 < v < 1 for v in found.values())


def test_more_terms_tell_more(spark, folder):
    found = {r["k"]: r["score"] for r in rows(spark, folder, "sweep_selected_terms")}
    assert sorted(found) == [1, 50, 200] and found[200] > found[1]


@pytest.mark.parametrize("name", ["grid_search", "randomized_search", "evolutionary_search"])
def test_candidates_over_the_texts(spark, folder, name):
    found = rows(spark, folder, name)
    assert len(found) >= 2 and min(r["rank"] for r in found) == 1
    assert all('"k":"100"' in r["params"].replace(" ", "") and 0.2 < r["mean_score"] <= 1 for r in found)
