"""End-to-end invariants of the cleaning job, training and scoring (sf0.001)."""

import pytest
from pyspark.sql import functions as F

from tabforge.operators import metrics as M
from tabforge.operators.store import CONFUSION_FIELDS, RUN_FIELDS, Conflict, Registry, Runs, names
from tabforge.plans import cleaning, training
from tabforge.plans.bundle import Bundle
from tabforge.session import scratch_path
from tabforge.sources import io as IO
from tabforge.sources.fixtures import listings
from tabforge.streaming.score import Served, explode_requests, read_request_lines, score_batch, score_stream

SF = "/root/testdata/sf0.001"


def test_cleaning_job_invariants(spark):
    train, test, fit = cleaning.run(listings(spark, SF))
    # no host on both sides, no leakage columns, no nulls left in numeric / text columns after the fill
    g = lambda d: {r[0] for r in d.select("host_id").distinct().collect()}
    assert not (g(train) & g(test))
    assert "estimated_occupancy_l365d" not in train.columns and "availability_365" not in train.columns
    filled = [c for c in fit.fill]
    nulls = train.select(*[F.count_if(F.col(c).isNull()).alias(c) for c in filled]).first().asDict()
    assert all(v == 0 for v in nulls.values()), nulls
    assert len(fit.vocabulary) == 20
    assert sum(c.startswith("amenity_") for c in train.columns) == 20


def test_probabilities_sum_to_one_and_beat_chance(spark):
    p = training.prepare(spark, SF)
    pred = training.fit_logreg(p).predict(p.test, p.enc.classes).cache()
    sums = pred.select((F.col("p_high") + F.col("p_low") + F.col("p_mid") + F.col("p_zero")).alias("s"))
    assert sums.agg(F.max(F.abs(F.col("s") - 1))).first()[0] < 1e-9
    # the fit weights classes evenly, so chance is a quarter of every class
    assert M.summary_metrics(pred).first()["bal_acc"] > 0.25 and pred.count() == p.clean_test.count()


def trained(spark):
    raw = cleaning.null_tokens_to_null(listings(spark, SF))
    p = training.prepare(spark, SF, raw)
    root = scratch_path(spark, "models")
    assert training.train_job(spark, p, root, {"logreg": training.fit_logreg}) == 1
    return raw, p, root


def test_served_class_is_the_class_of_the_test_split(spark):
    raw, p, root = trained(spark)
    served = Served(spark, root, training.MODEL_NAME)
    version, bundle = served.current()
    assert version == 1 and served.current()[1] is bundle
    held = raw.join(p.test.select(F.col("row_id").alias("id")), "id", "left_semi")
    want = {str(r.row_id): r.pred for r in training.fit_logreg(p).predict(p.test, p.enc.classes).collect()}
    inputs = bundle.fit.inputs
    full = IO.requests_from(held, scratch_path(spark, "req"), inputs=inputs, complete=True)
    rows = score_batch(explode_requests(read_request_lines(spark, full, inputs), inputs), bundle).collect()
    assert {r.id: r.pred_label for r in rows} == want and all(r.defaulted == [] for r in rows)
    # an incomplete request takes defaults and says which
    part = IO.requests_from(held.select("id", "room_type", "price"), scratch_path(spark, "req"), inputs=inputs)
    rows = score_batch(explode_requests(read_request_lines(spark, part, inputs), inputs, "2002-01-01"), bundle).collect()
    assert len(rows) == len(want) and all("accommodates" in r.defaulted and "room_type" not in r.defaulted for r in rows)


def test_promotion_between_two_micro_batches(spark):
    raw, p, root = trained(spark)
    inputs = p.fit.inputs
    src = scratch_path(spark, "req")
    IO.requests_from(raw.limit(60).repartition(3), src, inputs=inputs, complete=True)
    out, ck = scratch_path(spark, "scored"), scratch_path(spark, "ckpt")
    other = Runs(spark, root)
    majority = training.fit_random_forest(p, num_trees=1, max_depth=0)
    other.evaluate("stump-1", "stump", majority.predict(p.test, p.enc.classes), lambda f: Bundle(p.fit, p.enc, majority).write(spark, f))

    def promote(epoch):
        if epoch == 0:
            assert Registry(spark, root).promote(training.MODEL_NAME, other.table().where("run_id = 'stump-1'")) == 2

    score_stream(spark, src, out, ck, Served(spark, root, training.MODEL_NAME), files_per_batch=1, after_batch=promote)
    got = spark.read.parquet(out)
    by_version = {r["model_version"]: r["labels"] for r in got.groupBy("model_version").agg(F.countDistinct("p_high").alias("labels")).collect()}
    assert set(by_version) == {1, 2} and by_version[2] == 1 and got.count() == 60
    registry = {r["version"]: r["stage"] for r in Registry(spark, root).table().collect()}
    assert registry == {1: "Archived", 2: "Production"}
    score_stream(spark, src, out, ck, Served(spark, root, training.MODEL_NAME))   # nothing new: no row twice
    assert spark.read.parquet(out).count() == 60


def test_lost_races_fail_cleanly(spark):
    root = scratch_path(spark, "models")
    registry, runs = Registry(spark, root), Runs(spark, root)
    assert registry.table().count() == 0 and registry.production("m") is None and runs.table().count() == 0
    assert registry.register("m", "a", "runs/a/model", "Production", after=0) == 1
    before = sorted(names(spark, registry.root))
    with pytest.raises(Conflict):
        registry.register("m", "b", "runs/b/model", after=0)   # somebody read before that change
    assert sorted(names(spark, registry.root)) == before and registry.production("m")["run_id"] == "a"
    best = spark.createDataFrame([("c", "model")], "run_id string, model_name string")
    assert registry.promote("m", best) == 2
    assert {r["version"]: (r["stage"], r["run_id"]) for r in registry.table().collect()} == {1: ("Archived", "a"), 2: ("Production", "c")}
    row = spark.createDataFrame([("a", "x", 0.5, 1.0, 0.4, 0.4, 0.6)], RUN_FIELDS)
    counts = spark.createDataFrame([("high", "low", 3)], CONFUSION_FIELDS)
    assert runs.append(row, counts) == "a"
    with pytest.raises(Conflict):
        runs.append(row, counts)
    assert runs.table().count() == 1 and runs.confusion("a").first()["n"] == 3


def test_cross_validation_covers_every_row_once(spark):
    p = training.prepare(spark, SF)
    got = training.cross_validate(p, {"logreg": lambda rows: training.fit_logreg(p, rows), "forest": lambda rows: training.fit_random_forest(p, rows, 5, 3)}, k=3).collect()
    assert {r.model_name for r in got} == {"logreg", "forest"} and all(r.rows == p.train.count() and r.folds == 3 for r in got)
    assert all(0.25 <= r.bal_acc_mean <= 1 and 0 <= r.f1_mean <= 1 for r in got)


def test_list_text_is_parsed_once(spark, monkeypatch):
    """The vocabulary and the columns made from it read the parsed lists; serving still parses text."""
    from tabforge.functions import lists
    from tabforge.operators import tokens
    calls = []
    for module in (lists, tokens):
        real = module.parse_list_text
        monkeypatch.setattr(module, "parse_list_text", lambda *a, real=real, **k: calls.append(1) or real(*a, **k))
    rows = [(i, i % 7, "$5.00", 30.0, text) for i, text in enumerate([' [" Wifi ", "TV\\n"] ', "{Wifi,'tv'}", "wifi, \t\"Pool\" ", None, "  "] * 8)]
    raw = spark.createDataFrame(rows, "id long, host_id long, price string, estimated_occupancy_l365d double, amenities string").withColumns(
        {"neighbourhood_cleansed": F.lit("n"), "room_type": F.lit("r")})
    train, test, fit = cleaning.run(raw)
    assert len(calls) == 1 and fit.vocabulary[:1] == ["wifi"]
    got = {r["id"]: r for r in train.unionByName(test).collect()}
    assert len(got) == 40 and got[0]["amenities_count"] == got[1]["amenities_count"] == got[2]["amenities_count"] == 2
    assert got[3]["amenities_count"] == got[4]["amenities_count"] == 0 and got[0]["amenity_wifi"] == got[2]["amenity_pool"] == 1
    assert "amenities" not in train.columns and "__items" not in train.columns
    again = {r["id"]: r for r in cleaning.apply(cleaning.clean_rows(raw), fit).collect()}
    assert all(again[i]["amenities_count"] == r["amenities_count"] for i, r in got.items())


def test_requests_with_ids_are_not_hashed(spark, tmp_path):
    lines = ['{"data": [{"id": "a", "beds": 1.0}, {"id": "b"}]}', '{"data": [{"beds": 2.0}, {"id": "c"}]}']
    (tmp_path / "r.json").write_text("\n".join(lines))
    raw = read_request_lines(spark, str(tmp_path))
    out = explode_requests(raw)
    text = raw.select(F.input_file_name().alias("f"), F.sha2(F.to_json("data"), 256).alias("t"), F.posexplode("data").alias("p", "r"))
    keys = text.where("r.id is null").select(F.sha2(F.concat_ws("|", "f", "t", F.col("p").cast("string")), 256)).collect()
    assert sorted(r["id"] for r in out.select("id").collect()) == sorted(["a", "b", "c", *[k[0] for k in keys]]) and len(keys) == 1
    assert "WHEN exists(data" in out._jdf.queryExecution().optimizedPlan().toString()   # only lines that need it


def test_training_and_requests_read_one_written_table(spark, monkeypatch):
    from tabforge.plans import catalog_models as C

    class Seen(Exception):
        pass

    def prepare(spark, sf, raw):
        raise Seen(raw)

    monkeypatch.setattr(C.training, "prepare", prepare)
    with pytest.raises(Seen) as e:
        C._trained(spark, SF)
    raw = e.value.args[0]
    assert raw.dtypes == cleaning.null_tokens_to_null(listings(spark, SF)).dtypes
    assert raw.inputFiles() and not [f for f in raw.inputFiles() if SF in f]


def test_write_features_shuffles_no_vectors(spark):
    """The loaded encoder and the training one meet on the same row, not through a join of both tables."""
    from tabforge.plans import catalog_models as C
    out = C.q_write_features(spark, SF)
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.count() and not out.where("not same_features or same_features is null").count()
