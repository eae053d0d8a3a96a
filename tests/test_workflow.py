"""Reading, writing, training, predicting, saving and streaming."""

import random

import pytest
from pyspark.sql import functions as F

from labelloom.operators import classifiers as C
from labelloom.operators import tuning as TU
from labelloom.operators.features import Branch
from labelloom.plans import config
from labelloom.plans import workflow as W
from labelloom.sources import articles as A
from labelloom.sources import sinks as K
from labelloom.streaming.scoring import score_stream

WORDS = [Branch("words", "Text", "words", (1, 1))]
SMALL = {"score": "chi2", "k": 30, "n_estimators": 15, "max_depth": 5}


@pytest.fixture(scope="module")
def docs(spark):
    dice = random.Random(11)
    rows = []
    for i in range(240):
        kind = "abb"[i % 3]
        words = [f"{kind}{kind}{dice.randrange(9)}" if dice.random() < 0.4 else
                 f"w{dice.randrange(60)}" for _ in range(12)]
        rows.append((i, " ".join(words), kind))
    return spark.createDataFrame(rows, "Id long, Text string, Category string").cache()


@pytest.fixture(scope="module")
def model(docs):
    return W.train(docs, SMALL, WORDS)


@pytest.fixture(scope="module")
def vectors(docs, model):
    return TU.with_label(model.features.transform(docs), model.classes).select(
        "Id", "label", "features").cache()


def test_csv_round_trip(spark, tmp_path):
    rows = [(1, 'He said "no", twice', "line one\nline two", "a"), (2, "", "α-β; x, y", None),
            (3, "plain", "back\\slash", "b")]
    df = spark.createDataFrame(rows, "Id long, Title string, Abstract string, Category string")
    K.write_dataset(df, str(tmp_path / "data"))
    back = A.read_articles(spark, str(tmp_path / "data"))
    assert back.schema["Id"].dataType.simpleString() == "bigint"
    got = sorted(tuple(r) for r in A.fill_missing(back, keep_null_label=True).collect())
    assert got == [tuple("" if v is None else v for v in r) for r in rows]
    assert A.detect_shape(back) == "binary"


def test_other_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "t;u", ["k", "l"], 3)],
                               "Id long, Category string, Terms string, Keywords array<string>, x int")
    K.write_predictions(df, str(tmp_path / "p"))
    assert spark.read.csv(str(tmp_path / "p"), header=True).columns == ["Id", "Category"]
    K.write_side_table(df, str(tmp_path / "s"))
    assert A.read_side_table(spark, str(tmp_path / "s")).first()["Keywords"] == "k;l"
    curve = spark.createDataFrame([(25, 0.5)], "n int, oob_score double")
    K.write_oob_curve(curve, str(tmp_path / "o"), "parquet")
    assert spark.read.parquet(str(tmp_path / "o")).columns == ["n", "oob_score"]
    table = TU.candidate_table(spark, [{"k": 1}])
    K.write_search_results(table, str(tmp_path / "r"))
    assert '"k"' in spark.read.options(header=True, escape='"').csv(str(tmp_path / "r")).first()["params"]


def test_shapes_and_labels(spark, docs):
    assert A.detect_shape(docs) == "multi-class" and A.text_column("binary") == "Abstract"
    assert A.whitelist(docs.withColumn("extra", F.lit(1))).columns == docs.columns
    with pytest.raises(ValueError):
        A.detect_shape(docs.drop("Text").withColumn("Subtitle_Text", F.lit("")))
    features, label = A.split_label(docs)
    assert "Category" not in features.columns and label.columns == ["Id", "Category"]
    assert A.split_label(features)[1] is None
    nulls = spark.createDataFrame([(1, None, None)], "Id long, Text string, Category string")
    assert tuple(A.fill_missing(nulls).first()) == (1, "", None)


def test_preprocess(spark):
    docs = spark.createDataFrame([(1, "The Cats, 12 of them!")], "Id long, Text string")
    assert W.preprocess(docs, ["the", "of"]).first()["Tokens"] == "cats;them"
    assert "the" not in W.preprocess(docs).first()["Tokens"].split(";")


def test_enrich_needs_titles(docs):
    with pytest.raises(ValueError):
        W.enrich(docs, docs)


def test_model_beats_the_majority(docs, model):
    both = docs.join(model.predict(docs.drop("Category"))
                     .withColumnRenamed("Category", "p"), "Id")
    assert both.filter("Category = p").count() / 240 > 0.9


def test_saved_model_predicts_the_same(spark, docs, model, tmp_path):
    model.save(str(tmp_path / "m"))
    again = W.LabelModel.load(spark, str(tmp_path / "m"))
    assert sorted(map(tuple, again.predict(docs).collect())) == sorted(
        map(tuple, model.predict(docs).collect()))
    assert again.classes == ["a", "b"] and again.params == model.params


def test_repeated_ids_are_refused(docs):
    with pytest.raises(ValueError):
        W.train(docs.union(docs.limit(1)), SMALL, WORDS)


def test_score(docs):
    out = W.score(docs, {**SMALL, "classifier": "random_forest"}, WORDS, importance=True, oob=True)
    assert out.scored.count() == 60 and out.accuracy > 0.8
    assert out.report.count() == 3 and out.metrics.count() == 3
    top = out.importances.orderBy("rank").collect()
    assert [r["rank"] for r in top] == list(range(1, len(top) + 1))
    assert all(a["importance"] >= b["importance"] for a, b in zip(top, top[1:]))
    assert abs(sum(r["importance"] for r in top) - 1) < 1e-9
    assert [r["n"] for r in out.oob.orderBy("n").collect()] == [15]


def test_tune_methods(docs):
    space = {"k": [20], "max_depth": [1, 5], "n_estimators": [5]}
    params, found = W.tune(docs, "grid", "f1_macro", WORDS, space=space)
    assert found.table.count() == 2 and params["k"] == 20
    leaky, _ = W.tune(docs, "randomized", "roc_auc", WORDS, positive="a", space=space,
                      settings={"folds": 2, "n_iter": 1}, leak_free=False)
    assert leaky["n_estimators"] == 5
    fixed, nothing = W.tune(docs)
    assert nothing is None and fixed["k"] == 750 and fixed["n_estimators"] == 1200


def test_configuration():
    assert [b.name for b in config.branches("multi-class")] == ["tokens", "text_words", "text_chars"]
    assert [b.ngrams for b in config.branches("binary", ("title_words", "abstract_chars"))] == [
        (1, 2), (1, 3), (3, 9)]
    assert config.SWEEP[0] == 100000 and config.SWEEP[-1] == 1400000


def accuracy(df):
    return df.select(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]


def test_random_threshold_trees(spark, vectors, tmp_path, monkeypatch):
    fitted = C.RandomThresholdTrees(9, 6).fit(vectors)
    assert accuracy(fitted.transform(vectors)) > 0.8
    fitted.save(str(tmp_path / "e"))
    again = C.Ensemble.load(spark, str(tmp_path / "e"))
    assert sorted(r["prediction"] for r in again.transform(vectors).collect()) == sorted(
        r["prediction"] for r in fitted.transform(vectors).collect())
    monkeypatch.setattr(C, "MEMBERS_PER_PLAN", 4)
    assert sorted(map(str, again.transform(vectors).select("Id", "prediction").collect())) == sorted(
        map(str, fitted.transform(vectors).select("Id", "prediction").collect()))


@pytest.mark.parametrize("base", [C.random_forest, C.extra_trees])
def test_boosting(vectors, base):
    one = C.BoostedTrees(base, 1, 2, 1).fit(vectors)
    many = C.BoostedTrees(base, 6, 2, 2, stage_every=2).fit(vectors)
    assert all(w > 0 for w in many.weights)
    assert accuracy(many.transform(vectors)) >= accuracy(one.transform(vectors))


def test_out_of_bag(spark, vectors, monkeypatch):
    monkeypatch.setattr(C, "MEMBERS_PER_PLAN", 4)
    drawn = vectors.select(*[C.bag_weight(t).alias(f"t{t}") for t in range(20)]).collect()
    flat = [w for r in drawn for w in r]
    assert abs(sum(flat) / len(flat) - 1) < 0.1
    assert abs(sum(w == 0 for w in flat) / len(flat) - 0.368) < 0.03
    bagged = C.BaggedTrees(6, 5)
    votes = bagged.votes(bagged.fit(vectors), vectors)
    assert votes.count() == 240 * 6 * 2
    assert votes.filter("vote > 0").join(
        vectors.select("Id", F.posexplode(F.array(*[C.bag_weight(t) for t in range(6)]))
                       .alias("tree", "w")), ["Id", "tree"]).filter("w > 0").count() == 0
    running = C.cumulative_votes(votes).groupBy("Id", "class").agg(
        F.max("votes_so_far").alias("m"), F.sum("vote").alias("s"))
    assert running.filter("abs(m - s) > 1e-9").count() == 0
    curve = {r["n"]: r["oob_score"] for r in bagged.oob_curve(vectors, 2).collect()}
    assert sorted(curve) == [2, 3, 4, 5, 6] and curve[6] > 0.6


def test_stream(spark, docs, model, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    raw = docs.select(F.col("Id").alias("n"), "Text")
    raw.repartition(3).write.parquet(source)
    for _ in range(2):
        score_stream(spark, model, source, raw.schema, target, str(tmp_path / "cp"),
                     prepare=lambda df: df.withColumnRenamed("n", "Id")).awaitTermination()
    got = spark.read.parquet(target).select("Id", "Category")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, model.predict(docs).collect()))


def test_depths_beyond_the_deepest_are_refused():
    with pytest.raises(ValueError, match="max_depth"):
        C.extra_trees(5, 40)
    assert C.extra_trees(5, None).getMaxDepth() == C.DEEPEST
    assert W.parameters("binary")["max_depth"] == C.DEEPEST
    assert TU.effective({"max_depth": [2, None, 30]}) == {"max_depth": [2, 30]}


def test_default_branches_leave_out_stop_words():
    from labelloom.functions import text as T
    words = {b.name: set(b.stop_words) for b in config.branches("multi-class")}["text_words"]
    assert words == set(T.default_stop_words()) and "the" in words


def test_repeated_ids_keep_their_tokens(spark):
    docs = spark.createDataFrame([(1, "car mice"), (1, "ran other")], "Id long, Text string")
    known = spark.createDataFrame([("mice", ["mouse"]), ("ran", ["run"])], "token string, out array<string>")
    rows = sorted(r["Tokens"] for r in W.preprocess(docs, ["the"], known).collect())
    assert rows == ["car;mouse", "run;other"]
    with pytest.raises(ValueError, match="unique"):
        W.score(docs.withColumn("Category", F.lit("a")))


def test_curve_in_the_row_equals_the_window_form(spark):
    from pyspark.ml.feature import VectorAssembler
    rows = [(i, float(i % 7), float(i % 3), float(i % 2)) for i in range(60)]
    table = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        spark.createDataFrame(rows, "Id long, a double, b double, label double")).select("Id", "label", "features")
    trees = C.BaggedTrees(7, 3)
    ensemble = trees.fit(table)
    want = {r["n"]: r["oob_score"] for r in C.curve(trees.votes(ensemble, table), table, range(2, 8)).collect()}
    got = {r["n"]: r["oob_score"] for r in trees.oob_curve(table, 2).collect()}
    assert got.keys() == want.keys() and all(abs(got[n] - want[n]) < 1e-12 for n in want)
