import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tests.fixtures import transactions
from txgraph.ml.attribution import attributions
from txgraph.ml.ensemble import MeanProbability
from txgraph.ml.score import score_matrix
from txgraph.ml.train import boosted_trees, importances, second_member, split_matrix, train_model, two_members
from txgraph.operators.features import feature_matrix, graph_features, with_labels
from txgraph.operators.graph import with_window_graph
from txgraph.plans.pipeline import drift_check, load_and_score, notebook_analysis, retrain, run_pipeline, weekly_rings
from txgraph.schema import ALL_FEATURES, GRAPH_FEATURES, ModelParams
from txgraph.sinks.lake import write_model
from txgraph.sources.artifacts import read_metadata

FAST = ModelParams(trees=4, depth=3)


def planted(spark, n=600, seed=11):
    """Amounts say nothing; fraud sits on accounts that share three devices."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        fraud = rng.random() < 0.15
        account = f"F{rng.randrange(15)}" if fraud else f"A{rng.randrange(200)}"
        device = f"X{rng.randrange(3)}" if fraud else f"D{account[1:]}"
        merchant = f"M{rng.randrange(4)}" if fraud else f"M{rng.randrange(60)}"
        rows.append((f"T{i:05d}", account, device, merchant, rng.randrange(1, 200), i * 20, int(fraud)))
    return transactions(spark, rows)


@pytest.fixture(scope="module")
def labelled(spark):
    tx = with_window_graph(planted(spark), 1440)
    features = graph_features(tx)
    return with_labels(feature_matrix(tx, features), tx).cache()


@pytest.fixture(scope="module")
def trained(labelled):
    return train_model(labelled, FAST)


def test_split_is_stratified_and_stable(labelled):
    split = split_matrix(labelled, FAST)
    per_class = {
        r.is_fraud: (r.test, r.n)
        for r in split.groupBy("is_fraud")
        .agg(F.count_if("is_test").alias("test"), F.count("*").alias("n"))
        .collect()
    }
    for test, n in per_class.values():
        assert test == -(-n // 4)
    again = split_matrix(labelled.repartition(7), FAST)
    assert split.select("tx_id", "is_test").exceptAll(again.select("tx_id", "is_test")).isEmpty()


def test_graph_features_lift_auc(trained):
    assert trained.auc_graph > 0.8
    assert trained.auc_uplift > 0
    assert trained.n_train + trained.n_test == 600
    assert trained.importance[0][0] in GRAPH_FEATURES
    gains = [g for _, _, g in trained.importance]
    assert gains == sorted(gains, reverse=True)


def test_scores_and_attribution(labelled, trained):
    scores = score_matrix(labelled, trained.model)
    assert scores.where("raw_score < 0 or raw_score > 1").isEmpty()
    few = labelled.orderBy("tx_id").limit(20)
    shares = attributions(few, trained.model, labelled, ALL_FEATURES)
    assert shares.count() == 20 * len(ALL_FEATURES)
    # Structurally constant features explain nothing.
    assert shares.where("feature = 'account_clustering_coef' and contribution <> 0").isEmpty()
    assert not shares.where("contribution <> 0").isEmpty()


def test_two_members_in_one_saved_pipeline(spark, labelled, trained, tmp_path):
    """Fitted, scored, saved, loaded and streamed as one model; its score is the members' mean."""
    train = split_matrix(labelled, FAST).where("not is_test")
    forest = second_member(ALL_FEATURES, FAST).fit(train)
    pair = train_model(labelled, FAST, build=two_members)
    one = score_matrix(labelled, trained.model).withColumnRenamed("raw_score", "a")
    two = score_matrix(labelled, forest).withColumnRenamed("raw_score", "b")
    both = score_matrix(labelled, pair.model)
    joined = both.join(one, "tx_id").join(two, "tx_id")
    assert joined.count() == 600
    assert joined.where("abs(raw_score - (a + b) / 2) > 1e-12").isEmpty()
    assert score_matrix(labelled, trained.model, forest).exceptAll(both).isEmpty()
    gains = {name: g for name, _, g in pair.importance}
    apart = [dict((n, g) for n, _, g in importances(m, ALL_FEATURES)) for m in (trained.model, forest)]
    assert gains == pytest.approx({n: (apart[0][n] + apart[1][n]) / 2 for n in gains})
    assert sum(gains.values()) == pytest.approx(1.0) and pair.auc_uplift > 0
    path = write_model(pair.model, str(tmp_path), "20240101T000000Z")
    again = PipelineModel.load(path)
    assert score_matrix(labelled, again).exceptAll(both).isEmpty()
    labelled.drop("is_fraud").write.parquet(f"{tmp_path}/matrix")
    live = spark.readStream.schema(labelled.drop("is_fraud").schema).parquet(f"{tmp_path}/matrix")
    query = (
        score_matrix(live, again)
        .writeStream.format("memory").queryName("pair").option("checkpointLocation", f"{tmp_path}/ck")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.table("pair").exceptAll(both).isEmpty() and spark.table("pair").count() == 600


def test_mean_probability_leaves_missing_members_out(spark):
    rows = spark.sql(
        "SELECT * FROM VALUES ('x', array(0.8D, 0.2D), array(0.4D, 0.6D)), ('y', array(0.8D, 0.2D), null),"
        " ('z', null, null) AS t(tx_id, p, q)"
    ).select(
        "tx_id", *[F.when(F.col(c).isNotNull(), array_to_vector(c)).alias(c) for c in ("p", "q")]
    )
    mean = MeanProbability(inputCols=["p", "q"], outputCol="probability").transform(rows)
    got = {r.tx_id: r.probability and round(r.probability[1], 9) for r in mean.collect()}
    assert got == {"x": 0.4, "y": 0.2, "z": None}


def test_batch_pipeline_writes_everything(spark, tmp_path):
    out = str(tmp_path / "lake")
    summary = run_pipeline(
        planted(spark), out, FAST, batch_size=200, window_minutes=240, stamp="20240101T000000Z",
        build=two_members,
    )
    assert summary["transactions_scored"] == 600
    assert summary["auc_uplift"] > 0 and len(summary["top_features"]) == 10
    scores = spark.read.parquet(f"{out}/scores")
    assert scores.where("dt = '20240101T000000Z'").count() == 600
    assert set(r.decision for r in scores.select("decision").distinct().collect()) <= {
        "approve", "challenge", "decline",
    }
    rings = spark.read.json(f"{out}/rings")
    assert rings.count() >= 1 and rings.where("size < 3").isEmpty()
    # A ring's record holds its accounts and merchants; these rings fit one page.
    assert rings.where("size(accounts) <> size or page <> 0").isEmpty()
    assert rings.where("size(merchants) = n_nodes - n_devices - size").count() == rings.count()
    cases = spark.read.json(f"{out}/narratives")
    assert 0 < cases.count() <= 10
    text = cases.first().narrative
    assert text.startswith("Fraud Investigation Summary") and "Graph evidence:" in text
    progress = spark.read.json(f"{out}/progress")
    assert progress.count() == 3
    meta = read_metadata(spark, f"{out}/model_metadata/dt=20240101T000000Z")
    assert meta.first().feature_names and meta.first().auc_graph > 0.8
    tx = planted(spark)
    matrix = feature_matrix(with_window_graph(tx, 1440), graph_features(with_window_graph(tx, 1440)))
    again = load_and_score(tx, matrix, summary["model_path"])
    assert again.count() == 600
    assert isinstance(PipelineModel.load(summary["model_path"]), PipelineModel)


def test_scheduled_jobs(spark, labelled, tmp_path):
    tx = planted(spark)
    result = retrain(labelled.drop("is_fraud"), tx, str(tmp_path), FAST, "20240102T000000Z")
    assert result["auc_uplift"] > 0
    report = weekly_rings(tx, str(tmp_path), "20240102T000000Z")
    assert report.count() <= 25
    assert spark.read.json(f"{tmp_path}/weekly_rings").count() == report.count()
    scores = tx.select((F.col("amount") / 200).alias("fraud_score"))
    row = drift_check(scores, scores).first()
    assert row.psi == pytest.approx(0.0) and row.verdict == "stable"
    shifted = scores.select((F.col("fraud_score") * 0.5).alias("fraud_score"))
    assert drift_check(scores, shifted).first().verdict.startswith("significant-drift")


def test_notebook_analysis(spark):
    result = notebook_analysis(planted(spark, 300), FAST)
    assert result["training"].auc_graph > 0.7
    assert result["separation"].count() == 15
    assert result["rings"].count() <= 10
    assert result["profile"]["numeric"].count() == 2


def test_model_pipeline_uses_all_parameters():
    stage = boosted_trees(ALL_FEATURES, ModelParams()).getStages()[-1]
    assert (stage.getMaxIter(), stage.getMaxDepth(), stage.getStepSize()) == (300, 6, 0.1)
    assert (stage.getSubsamplingRate(), stage.getFeatureSubsetStrategy()) == (0.9, "0.9")
