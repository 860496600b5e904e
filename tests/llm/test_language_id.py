import numpy as np

from salescube.llm import language_id
from tests.llm.samples import frame


def test_held_out_accuracy(spark):
    path = "/root/testdata/sf0.01"
    found = language_id.op3_language_id(spark, path)
    truth = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "lang")
    right, total = found.where("held_out").join(truth, "doc_id").selectExpr("count_if(lang = lang_pred)", "count(*)").first()
    assert total > 200 and right / total > 0.97
    assert found.where("score < 0 or score > 1").count() == 0


def test_profile_is_the_sum_of_bound_letters():
    runs, rows = language_id.letter_runs(["Ab.", "", "b"])
    a, b, space = (language_id.letter_vector(p, 64).astype(int) for p in (ord("a"), ord("b"), 0))
    want = np.roll(space, 2) * np.roll(a, 1) * b + np.roll(a, 2) * np.roll(b, 1) * space
    got = language_id.profiles(rows, runs, 3, 64)
    assert (got[0] == want).all() and not got[1].any() and (got[2] == np.roll(space, 2) * np.roll(b, 1) * space).all()


def test_defined_cases(spark):
    empty = language_id.train(frame(spark, []).select("text", "lang"))
    rows = [(1, None), (2, ""), (3, "123 !!"), (4, "the word"), (None, "el gato"), (4, "the word")]
    assert {(r.lang_pred, r.score) for r in language_id.predict(frame(spark, rows), empty).collect()} == {("und", 0.0)}
    taught = spark.createDataFrame([("the cat and the dog", "en"), ("el gato y el perro", "es"), ("teaches nothing", None), (None, "fr")], "text string, lang string")
    got = {(r.doc_id, r.lang_pred) for r in language_id.predict(frame(spark, rows), language_id.train(taught)).collect()}
    assert got == {(1, "und"), (2, "und"), (3, "und"), (4, "en"), (None, "es")}
    assert language_id.predict(frame(spark, []), empty).count() == 0


def test_ties_go_to_the_first_language():
    prototypes = language_id.Prototypes(["aa", "bb"], np.ones((2, 64)))
    assert prototypes.predict(["word"])[0] == ["aa"]
