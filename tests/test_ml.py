"""Model steps on separable rule-labelled data (embedding dims 0-2, z-scored)."""
import os
import tempfile

from pyspark.sql import functions as F

from tessera.functions.columns import rule_label
from tessera.operators.stats import standard_scale
from tessera.plans import ml
from tests.conftest import SF_SMALL


def _data(spark):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select(
        "vec_id", *[F.col("embedding")[i].cast("double").alias(f"x{i}") for i in range(3)])
    scaled, _ = standard_scale(emb, ["x0", "x1", "x2"])
    ds = scaled.withColumn("y", rule_label(F.col("x0"), F.col("x1"), F.col("x2")))
    return ml.prepare_training(spark, ds, ["x0", "x1", "x2"], "y", key="vec_id", folds=2)


def test_split_is_80_20_per_class_and_folds_are_even(spark):
    d = _data(spark)
    by = {(r["label"], r["split"]): r["count"] for r in d.groupBy("label", "split").count().collect()}
    for y in (0.0, 1.0):
        tot = by[y, "train"] + by[y, "test"]
        assert by[y, "train"] == int(0.8 * tot + 0.5)
    folds = {}
    for r in d.groupBy("label", "split", "fold").count().collect():
        folds.setdefault((r["label"], r["split"]), []).append(r["count"])
    assert all(max(f) - min(f) <= 1 for f in folds.values())


def test_split_does_not_depend_on_ranges_or_partitions(spark, monkeypatch):
    from tessera.operators import ordered
    rows = spark.range(500).select(F.col("id").alias("customer_id"), (F.col("id") % 3 == 0).cast("double").alias("label"))
    want = {r.customer_id: (r.split, r.fold) for r in ml.kfold(ml.stratified_split(rows, "label"), 5).collect()}
    cut = ordered.ordered_prefix_sum
    monkeypatch.setattr(ml, "ordered_prefix_sum", lambda *a, **k: cut(*a, **k, rows_per_range=20))
    got = ml.kfold(ml.stratified_split(rows.repartition(7), "label"), 5)
    assert {r.customer_id: (r.split, r.fold) for r in got.collect()} == want


def test_fit_does_not_depend_on_input_partitions(spark):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select(
        "vec_id", *[F.col("embedding")[i].cast("double").alias(f"x{i}") for i in range(3)])
    emb = emb.withColumn("y", (F.col("x0") + F.col("x1") > 0).cast("int"))
    forest = ml.RandomForestClassifier(labelCol="label", numTrees=5, maxDepth=ml.FOREST_DEPTH, seed=1)
    fits = [forest.fit(ml.prepare_training(spark, emb.repartition(n), ["x0", "x1", "x2"], "y", key="vec_id", folds=2))
            for n in (1, 8)]
    assert fits[0].featureImportances == fits[1].featureImportances
    assert max(t.depth for t in fits[0].trees) > 5


def test_train_evaluate_save_load_score(spark):
    d = _data(spark)
    models, perf = ml.train_models(d, key="vec_id", cv_folds=2, names=["logistic_regression", "random_forest"])
    rows = {r["model_name"]: r for r in perf.collect()}
    assert set(rows) == {"logistic_regression", "random_forest"}
    assert rows["random_forest"]["roc_auc"] > 0.9 and rows["random_forest"]["cv_mean"] > 0.85
    ev = ml.evaluate_model(models["random_forest"], d, "random_forest", key="vec_id").first()
    assert ev["true_negative"] + ev["false_positive"] + ev["false_negative"] + ev["true_positive"] == \
        d.where("split = 'test'").count()
    path = tempfile.mkdtemp(prefix="model-", dir="/tmp")
    ml.save_model(spark, models["random_forest"], "random_forest", {"roc_auc": rows["random_forest"]["roc_auc"]},
                  os.path.join(path, "rf"))
    loaded, meta = ml.load_model(spark, os.path.join(path, "rf"))
    assert meta["model_name"] == "random_forest"
    a = ml.score_batch(models["random_forest"], d, "rf", key="vec_id").select("vec_id", "prediction")
    b = ml.score_batch(loaded, d, "rf", key="vec_id").select("vec_id", "prediction")
    assert a.exceptAll(b).count() == 0
    one = ml.predict_single(spark, models["random_forest"], [0.0, 0.0, 2.0])
    assert one["prediction"] == 1 and 0.5 <= one["confidence"] <= 1.0


def test_grid_of_forests_grows_each_tree_once(spark, monkeypatch):
    train = _data(spark).where("split = 'train'").cache()
    common = dict(labelCol="label", featuresCol="features", seed=3)
    fits, fit = [], ml.RandomForestClassifier._fit
    monkeypatch.setattr(ml.RandomForestClassifier, "_fit", lambda self, d: fits.append(
        (self.getNumTrees(), self.getMaxDepth(), self.getMinInstancesPerNode())) or fit(self, d))
    monkeypatch.setitem(ml.PARAM_GRIDS, "random_forest", {"numTrees": [2, 5], "maxDepth": [30, 2, 25], "minInstancesPerNode": [1, 4]})
    model, summary = ml.tune_model(_data(spark), "random_forest", folds=2, key="vec_id")
    # a fold: 2 and 3 more trees, of depth 30 and 2, 2 leaf sizes (no tree reaches 25); then the best setting as one forest
    assert len(fits) == 2 * 2 * 2 * 2 + 1 and {f[:2] for f in fits[:-1]} == {(2, 30), (3, 30), (2, 2), (3, 2)}
    assert model.getNumTrees == fits[-1][0] and summary.first()["best_cv_score"] > 0.9
    # what is shared is the forest that the setting's own fit gives
    grid = ml.GridForest(**common)
    maps = [{grid.numTrees: n, grid.maxDepth: d} for n in (2, 5) for d in (30, 25, 2)]
    got = dict(grid.fitMultiple(train, maps))
    for j, m in enumerate(maps):
        assert sum(p.getNumTrees for p in got[j].parts) == m[grid.numTrees]
        plain = ml.RandomForestClassifier(**common, numTrees=2, maxDepth=m[grid.maxDepth]).fit(train)
        body = [x.toDebugString.split("\n", 1)[1] for x in (*plain.trees, *got[j].parts[0].trees)]
        assert body[:2] == body[2:]
    # and its score is the mean over all its trees
    whole = got[3].transform(train).select("vec_id", "rawPrediction").orderBy("vec_id").limit(20).collect()
    of_parts = [p.transform(train).orderBy("vec_id").limit(20).collect() for p in got[3].parts]
    for i, r in enumerate(whole):
        assert abs(r.rawPrediction - sum(p[i].rawPrediction[1] for p in of_parts)) < 1e-9
    train.unpersist()


def test_limited_forests_are_cut_from_the_deep_one(spark, monkeypatch):
    """Only the deepest limit's trees are grown; what is cut from them is what a fit with the limit gives."""
    train = _data(spark).where("split = 'train'").cache()
    flipped = train.withColumn("label", F.when(F.col("vec_id") % 7 == 0, 1 - F.col("label")).otherwise(F.col("label"))).cache()  # deep trees
    grown, fit_java = [], ml.RandomForestClassifier._fit_java
    monkeypatch.setattr(ml.RandomForestClassifier, "_fit_java", lambda self, d: grown.append((self.getMaxDepth(), self.getCacheNodeIds())) or fit_java(self, d))
    monkeypatch.setattr(ml, "DEEP_TREES", 3)  # the first forest is deeper, so the next ones keep their rows' nodes
    grid = ml.GridForest(labelCol="label", featuresCol="features", seed=3)
    maps = [{grid.numTrees: n, grid.maxDepth: d, grid.minInstancesPerNode: m} for n, m in ((3, 1), (8, 4)) for d in (30, 7, 2)]
    got = dict(grid.fitMultiple(flipped, maps))
    assert sorted(grown) == [(30, False), (30, True), (30, True)]
    for j, m in enumerate(maps):
        assert [p.getNumTrees for p in got[j].parts] == [3, 5][:1 + (m[grid.numTrees] == 8)]
        for i, part in enumerate(got[j].parts):
            plain = ml.RandomForestClassifier(labelCol="label", featuresCol="features", seed=3 + i, numTrees=[3, 5][i],
                                              maxDepth=m[grid.maxDepth], minInstancesPerNode=m[grid.minInstancesPerNode])
            want = plain.fit(flipped)
            assert part.getMaxDepth() == m[grid.maxDepth] or max(t.depth for t in part.trees) <= m[grid.maxDepth]
            assert [t.toDebugString.split("\n", 1)[1] for t in part.trees] == [t.toDebugString.split("\n", 1)[1] for t in want.trees]
            raw = [[r.rawPrediction for r in x.transform(flipped).orderBy("vec_id").select("rawPrediction").collect()] for x in (part, want)]
            assert raw[0] == raw[1]
    assert max(t.depth for t in got[0].parts[0].trees) > 9
    train.unpersist(), flipped.unpersist()
