import numpy as np

from salescube.llm import toxicity
from tests.llm.samples import frame


def test_held_out_texts_with_toxic_words_are_found(spark):
    path = "/root/testdata/sf0.1"
    found = toxicity.op2_toxicity(spark, path).where("held_out").select("doc_id", "score", "predicted")
    labels = spark.read.parquet(f"{path}/labels.parquet").select("doc_id", "toxic")
    rows = found.join(labels, "doc_id").collect()
    score, truth = np.array([r.score for r in rows]), np.array([r.toxic for r in rows])
    assert truth.sum() > 100
    called = np.array([r.predicted for r in rows]) == 1
    assert (called == (score >= 0.7)).all() and ((0 <= score) & (score <= 1)).all()
    # about half of the toxic labels stand on texts without a toxic word; precision shows that clean texts are left alone
    assert truth[called].mean() > 0.95 and called[truth == 1].mean() > 0.45


def test_dictionary_holds_the_distinctive_words():
    rng = np.random.default_rng(3)
    vocabulary = ["".join(rng.choice(list("abcdef"), 5)) for _ in range(300)]
    plain = [" ".join(rng.choice(vocabulary, 60)) for _ in range(400)]
    bad = [t + " " + " ".join(rng.choice(["nastyword", "vileword"], 3)) for t in plain[:60]]
    model = toxicity.fit([t.encode() for t in plain[60:] + bad], [0] * 340 + [1] * 60)
    assert b"nastyword" in model.toxic and b"nastyword" not in model.ordinary
    fresh = " ".join(rng.choice(vocabulary, 40))
    assert model.score((fresh + " vileword! " + fresh + " NASTYWORD vileword").encode()) > 0.7 > model.score(fresh.encode())


def test_defined_cases(spark):
    none = toxicity.train(frame(spark, [(1, "text")]), spark.createDataFrame([], "doc_id long, toxic int"))
    rows = [(1, None), (2, ""), (3, "some text"), (None, "some text"), (3, "some text")]
    assert [r.score for r in toxicity.scored(frame(spark, rows), none).collect()] == [0.0] * 5
    one = toxicity.train(frame(spark, rows), spark.createDataFrame([(3, 1), (1, None)], "doc_id long, toxic int"))
    assert {r.predicted for r in toxicity.scored(frame(spark, rows), one).collect()} == {1}
    assert toxicity.clean(frame(spark, rows), none).columns == frame(spark, []).columns
    assert toxicity.clean(frame(spark, rows), none).count() == 5 and toxicity.clean(frame(spark, rows), one).count() == 0
    assert toxicity.scored(frame(spark, []), none).count() == 0
    both = toxicity.fit([b"", b"a b c", b"x y"], [0, 0, 1])
    assert 0 <= both.score(b"") <= 1


def test_small_training_samples_find_held_out_texts(spark):
    path = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{path}/labels.parquet").select("doc_id", "toxic")
    rows = toxicity.op2_toxicity(spark, path).where("held_out").join(labels, "doc_id").collect()
    called = [r.toxic for r in rows if r.predicted]
    assert len(called) >= 0.45 * sum(r.toxic for r in rows) and sum(called) > 0.9 * len(called)
    # a word in 20 of 49 toxic and 0 of 335 ordinary texts is significant, one in a single toxic text is not
    toxic = [[b"vile"] * (i < 20) + [b"once"] * (i == 0) + [b"a"] for i in range(49)]
    assert toxicity.distinctive_words(toxic, [[b"a"]] * 335) == [b"vile"]


def test_toxic_phrases_of_common_words_are_found():
    rng = np.random.default_rng(5)
    vocabulary = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(200)]
    phrases = [list(rng.choice(vocabulary, 8, replace=False)) for _ in range(3)]

    def text(marked):
        out = list(rng.choice(vocabulary, 60))
        for phrase in phrases:  # the same words in either class, in the phrase's order in toxic texts only
            out += phrase if marked else list(rng.permutation(phrase))
        return " ".join(out).encode()

    labels = [i % 4 == 0 for i in range(400)]
    model = toxicity.fit([text(y) for y in labels], [int(y) for y in labels])
    assert model.toxic.removesuffix(model.ordinary).strip() == b""
    assert sum(model.score(text(True)) >= 0.7 for _ in range(50)) >= 45 and sum(model.score(text(False)) >= 0.7 for _ in range(50)) <= 2


def test_calibration_does_not_follow_the_sample(spark):
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(rng.choice(list("abcdefgh"), 30))) for i in range(420)]  # labels that no text explains
    labels = spark.createDataFrame([(i, int(i % 21 == 0)) for i in range(420)], "doc_id long, toxic int")
    scores = [np.mean([r.score for r in toxicity.scored(frame(spark, rows), toxicity.train(frame(spark, rows), labels, n)).collect()]) for n in (20, 400)]
    assert all(abs(s - 1 / 21) < 0.04 for s in scores)


def test_fragments_shorter_than_the_tested_runs_gain_nothing():
    rng = np.random.default_rng(8)
    plain = [bytes(rng.choice(list(b"abcdefgh"), 7)) for _ in range(900)]
    content = b" " + b" ".join(plain[:300]) + b" "
    model = toxicity.Model(content, b" qyzwxuv kjzqvwy " + content, (content, content))
    parts = [b"qyzwx", b"yzwxu", b"zqvwy", b"kjzqv"]  # five bytes of a listed word, in words of their own
    text = b" ".join(w[:1] + parts[i % 4] + w[1:2] for i, w in enumerate(plain[300:]))
    assert model.measures(text)[1:4] == [0.0, 0.0, 0.0]
    assert model.measures(b"qyzwxuv " + text)[1] > 0
