"""Model surface (ML1-ML6) and batch scoring with fallback (ML5)."""

from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import ml
from tidemark.sources.fixtures import v_events
from tidemark.sources.tables import Tables

from .conftest import MEDIUM


def test_train_evaluate_predict(spark):
    f = ml.daily_features(v_events(Tables(spark, MEDIUM)))
    train, test = ml.split(f, ["tenant_id", "event_date"])
    assert train.count() + test.count() == f.count()
    model = ml.train_logistic(train)
    m = ml.evaluate(model, test).first()
    assert m.roc_auc > 0.5 and 0 <= m.accuracy <= 1 and m.log_loss > 0
    p = ml.predict(model, f.where(F.col("event_date") == F.lit("2024-01-15").cast("date"))).collect()
    assert len(p) == 20 and all(0 <= r.probability <= 1 for r in p)


def test_one_class(spark):
    """AUC is null without both classes, and such a training set is refused."""
    one = spark.createDataFrame([(1, 1, 0.9), (1, 0, 0.2)], "label int, prediction int, probability double")
    m = ml.metrics(one).first()
    assert m.roc_auc is None and m.accuracy == 0.5 and m.log_loss > 0
    none = ml.metrics(one.where("label = 2")).first()
    assert none.roc_auc is None and none.accuracy is None
    f = ml.daily_features(v_events(Tables(spark, MEDIUM)), unit=["tenant_id", "user_id"])
    assert 0 < f.where("purchased = 1").count() < f.count()
    with pytest.raises(ValueError, match="both classes"):
        ml.train_logistic(f.where("purchased = 1"))


def test_auc_against_all_pairs(spark):
    rows = [(int(i * 7 % 5 < 2), 0, (i * 37 % 11) / 10) for i in range(200)]
    got = ml.metrics(spark.createDataFrame(rows, "label int, prediction int, probability double")).first().roc_auc
    pos, neg = ([p for y, _, p in rows if y == k] for k in (1, 0))
    want = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
    assert abs(got - want) < 1e-12


def test_feature_info_median(spark):
    df = spark.createDataFrame([(float(x), "a" if x % 2 else None) for x in range(1, 11)], "x double, c string")
    r = {x.feature: x for x in ml.feature_info(df, ["x"], ["c"]).collect()}
    assert (r["x"].min, r["x"].max, r["x"].median, r["x"].mean) == (1.0, 10.0, 5.0, 5.5)
    assert r["c"].nulls == 5 and r["c"].distinct_values == 1


def test_scoring_primary_and_fallback(spark):
    rows = [(1, "please refund my invoice"), (2, "the service is down"), (3, "x" * 30_000), (4, None)]
    df = spark.createDataFrame(rows, "msg_id long, text string")
    out = {r.msg_id: r for r in ml.score_batch(df, "text", "msg_id").collect()}
    assert out[1].label == "billing" and out[2].label == "outage"
    assert all(r.path == "primary" and r.reason is None for r in out.values())   # size is no failure
    assert out[1].input_tokens == 4 and out[1].output_tokens == 1

    def broken(_: pd.Series) -> pd.Series:
        raise RuntimeError("primary down")

    out2 = {r.msg_id: r for r in ml.score_batch(df, "text", "msg_id", primary=broken).collect()}
    assert all(r.path == "fallback" and r.reason == "RuntimeError: primary down" for r in out2.values())
    assert out2[1].label == "billing" and out2[4].label == "other"

    def picky(t: pd.Series) -> pd.Series:
        if t.str.contains("down").any():
            raise ValueError("cannot take this")
        return ml.keyword_scorer(t)

    out3 = {r.msg_id: r for r in ml.score_batch(df, "text", "msg_id", primary=picky).collect()}
    assert [k for k, r in out3.items() if r.path == "fallback"] == [2] and out3[2].label == "outage"
