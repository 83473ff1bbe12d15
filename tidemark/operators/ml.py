"""Batch model training, evaluation and scoring on MLlib (ML1-ML6), and
batch scoring with a primary and a fallback path (ML5).

Feature rows are built with DataFrame aggregates (one row per unit and day,
by default a tenant's); training and scoring are MLlib pipelines, distributed
over the feature rows.  The purchase label of the reference's model is visible
through the event-type counts it is built from (the label leaks);
``daily_features(drop_leaky=True)`` removes that column.  Where every tenant
buys something every day the label has one class, and the unit must be finer.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .sequence import rank_values

EVENT_TYPES = ["click", "view", "signup", "error", "purchase"]
NUMERIC = ["events", "n_click", "n_view", "n_signup", "n_error", "amount", "active_hours"]


def daily_features(events: DataFrame, drop_leaky: bool = True, unit: Sequence[str] = ("tenant_id",)) -> DataFrame:
    """Feature rows per unit and day and the label ``purchased`` (any purchase)."""
    aggs = [F.count(F.lit(1)).alias("events"), F.sum("amount").alias("amount"),
            F.countDistinct(F.hour("ts")).alias("active_hours"),
            F.max((F.col("event_type") == "purchase").cast("int")).cast("double").alias("purchased")]
    aggs += [F.count_if(F.col("event_type") == t).alias(f"n_{t}") for t in EVENT_TYPES if t != "purchase"]
    d = events.groupBy(*unit, "event_date").agg(*aggs)
    d = d.withColumn("dow", F.dayofweek("event_date"))
    if not drop_leaky:
        d = d.withColumn("n_purchase_leak", F.col("purchased"))
    return d


def split(df: DataFrame, keys: Sequence[str], train_pct: int = 80) -> tuple[DataFrame, DataFrame]:
    """Deterministic hash split (reruns agree, no driver-side sampling)."""
    b = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(100))
    return df.where(b < train_pct), df.where(b >= train_pct)


def with_balanced_weights(df: DataFrame, label: str = "purchased") -> DataFrame:
    """Class weights n / (2 * n_class): each class contributes equally.
    Rows of one class only teach nothing and are refused."""
    n, pos = df.agg(F.count(F.lit(1)), F.count_if(F.col(label) == 1)).first()
    if not 0 < pos < n:
        raise ValueError(f"label {label}: {pos} of {n} rows are positive; both classes are needed")
    return df.withColumn("weight", F.when(F.col(label) == 1, n / (pos * 2.0)).otherwise(n / ((n - pos) * 2.0)))


def train_logistic(train: DataFrame, label: str = "purchased", numeric: Sequence[str] = NUMERIC,
                   max_iter: int = 25) -> PipelineModel:
    """ML1: StringIndexer + OneHotEncoder (tenant, weekday) + VectorAssembler
    + LogisticRegression with balanced class weights."""
    idx = StringIndexer(inputCols=["tenant_id"], outputCols=["tenant_ix"], handleInvalid="keep")
    ohe = OneHotEncoder(inputCols=["tenant_ix", "dow"], outputCols=["tenant_vec", "dow_vec"], handleInvalid="keep")
    vec = VectorAssembler(inputCols=[*numeric, "tenant_vec", "dow_vec"], outputCol="features", handleInvalid="keep")
    lr = LogisticRegression(labelCol=label, weightCol="weight", maxIter=max_iter, regParam=0.01)
    return Pipeline(stages=[idx, ohe, vec, lr]).fit(with_balanced_weights(train, label))


def evaluate(model: PipelineModel, test: DataFrame, label: str = "purchased") -> DataFrame:
    """ML2: ``metrics`` of a model's predictions."""
    p = F.element_at(vector_to_array(F.col("probability")), 2)
    return metrics(model.transform(test).select(F.col(label).alias("label"), "prediction", p.alias("probability")))


def metrics(scored: DataFrame) -> DataFrame:
    """ROC AUC, accuracy, weighted precision and recall, f1 and log loss (one
    row) of rows ``(label, prediction, probability)``, by SQL over one pass.

    The scores are histogrammed with their labels; AUC is the share of
    (positive, negative) pairs ranked right, ties half, from running sums over
    the distinct scores, cut into ranges of the score.  Without both classes
    AUC is null; without rows all measures are."""
    pred = scored.select(F.col("label").cast("int").alias("y"), F.col("prediction").cast("int").alias("z"),
                         F.col("probability").cast("double").alias("p"))
    h = pred.groupBy("y", "z", "p").agg(F.count(F.lit(1)).alias("n"))
    pos, neg = F.sum(F.col("n") * F.col("y")), F.sum(F.col("n") * (1 - F.col("y")))
    scores = h.groupBy("p").agg(pos.alias("pos"), neg.alias("neg")).withColumn("cut", F.floor(F.col("p") * 1024))
    cuts = scores.groupBy("cut").agg(F.sum("neg").alias("cn"))
    cuts = cuts.select(F.col("cut").alias("c"), (F.sum("cn").over(Window.orderBy("cut")) - F.col("cn")).alias("before"))
    inside = F.sum("neg").over(Window.partitionBy("cut").orderBy("p")) - F.col("neg")
    auc = (scores.withColumn("inside", inside).join(cuts, F.col("cut") == F.col("c"))
           .agg(F.try_divide(F.sum(F.col("pos") * (F.col("before") + F.col("inside") + F.col("neg") / 2)),
                            F.sum("pos") * F.sum("neg")).alias("roc_auc")))
    q = F.greatest(F.lit(1e-15), F.least(F.lit(1 - 1e-15), F.when(F.col("y") == 1, F.col("p")).otherwise(1 - F.col("p"))))
    cell = lambda y, z: F.sum(F.when((F.col("y") == y) & (F.col("z") == z), F.col("n")).otherwise(0))
    m = h.agg(cell(1, 1).alias("tp"), cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"),
              (-F.sum(F.col("n") * F.log(q)) / F.sum("n")).alias("log_loss"))
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    total = tp + tn + fp + fn
    div = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    p1, p0, r1, r0 = div(tp, tp + fp), div(tn, tn + fn), div(tp, tp + fn), div(tn, tn + fp)
    weigh = lambda a1, a0: F.try_divide(a1 * (tp + fn) + a0 * (tn + fp), total)
    f = lambda p, r: div(2 * p * r, p + r)
    m = m.select(F.try_divide(tp + tn, total).alias("accuracy"), weigh(p1, p0).alias("precision"), weigh(r1, r0).alias("recall"),
                 weigh(f(p1, r1), f(p0, r0)).alias("f1"), "log_loss")
    return m.select(auc.scalar().alias("roc_auc"), "accuracy", "precision", "recall", "f1", "log_loss")


def feature_info(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """ML3: per feature: min, max, mean, median (nearest rank), stddev,
    distinct count and null count.

    The features are unpivoted into (feature, value) rows, so one grouped
    aggregate computes every numeric feature's statistics in a single pass,
    and one value histogram (grouped by feature) gives all medians."""
    num = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
                                        for c in numeric])).alias("x")).select("x.*")
    stats = num.groupBy("feature").agg(
        F.min("value").alias("min"), F.max("value").alias("max"), F.round(F.avg("value"), 6).alias("mean"),
        F.round(F.stddev_samp("value"), 6).alias("stddev"), F.countDistinct("value").alias("distinct_values"),
        F.count_if(F.col("value").isNull()).alias("nulls"))
    med = rank_values(num, ["feature"], "value", {"median": F.greatest(F.lit(1), F.ceil(F.col("n") * 0.5))})
    out = stats.join(med.select("feature", "median"), "feature", "left").select(
        "feature", "min", "max", "mean", "median", "stddev", "distinct_values", "nulls")
    if categorical:
        cat = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"))
                                            for c in categorical])).alias("x")).select("x.*")
        none = F.lit(None).cast("double")
        cs = cat.groupBy("feature").agg(F.countDistinct("value").alias("distinct_values"),
                                        F.count_if(F.col("value").isNull()).alias("nulls"))
        out = out.unionByName(cs.select("feature", none.alias("min"), none.alias("max"), none.alias("mean"),
                                        none.alias("median"), none.alias("stddev"), "distinct_values", "nulls"))
    return out


def predict(model: PipelineModel, features: DataFrame, keys: Sequence[str] = ("tenant_id", "event_date")) -> DataFrame:
    """ML4: label and probability of the positive class."""
    p = model.transform(features)
    return p.select(*keys, F.col("prediction").alias("predicted_label"),
                    F.element_at(vector_to_array(F.col("probability")), 2).alias("probability"))


# ---- ML5: batch scoring with primary and fallback paths ----------------------

# Fixed keyword lists of the local, deterministic default scorer.
TICKET_KEYWORDS = {
    "billing": ["invoice", "bill", "payment", "charge", "refund", "facture", "paiement"],
    "outage": ["down", "error", "outage", "fail", "panne", "erreur"],
    "account": ["login", "password", "account", "compte", "mot de passe"],
}


def keyword_scorer(texts: pd.Series) -> pd.Series:
    """Default primary scorer: first category whose keyword occurs."""
    low = texts.fillna("").str.lower()
    out = pd.Series(["other"] * len(low), index=low.index, dtype=object)
    for cat, words in reversed(list(TICKET_KEYWORDS.items())):
        pat = "|".join(re.escape(w) for w in words)
        out = out.where(~low.str.contains(pat, regex=True), cat)
    return out


def first_word_scorer(texts: pd.Series) -> pd.Series:
    """Default fallback classifier (cheap, always available): the category
    that the first keyword of the text belongs to."""
    where = {w: cat for cat, words in TICKET_KEYWORDS.items() for w in words}
    pat = "(" + "|".join(re.escape(w) for w in sorted(where, key=len, reverse=True)) + ")"
    return texts.fillna("").str.lower().str.extract(pat, expand=False).map(where).fillna("other").astype(object)


def score_batch(df: DataFrame, text: str, key: str, primary: Callable[[pd.Series], pd.Series] = keyword_scorer,
                fallback: Callable[[pd.Series], pd.Series] = first_word_scorer) -> DataFrame:
    """ML5: score every row with the primary scorer.  Rows whose call fails
    go to the fallback, whatever their size: a failing batch is tried again
    row by row, so one bad row does not take the others with it.  Each row
    records its path, the reason of a failure and the tokens (white-space
    words) in and out."""
    def one(fn, t):
        out = fn(t)
        if len(out) != len(t):
            raise ValueError("the scorer must give one label per row")
        return list(out)

    def run(it):
        for pdf in it:
            t = pdf[text].fillna("")
            why: list[str | None] = [None] * len(t)
            try:
                label = one(primary, t)
            except Exception:  # noqa: BLE001 - the scorer is the caller's; every failure is recorded
                label = [None] * len(t)
                for i in range(len(t)):
                    try:
                        label[i] = one(primary, t.iloc[i:i + 1])[0]
                    except Exception as e:  # noqa: BLE001
                        why[i] = f"{type(e).__name__}: {e}"
            failed = [i for i, w in enumerate(why) if w is not None]
            if failed:
                for i, x in zip(failed, one(fallback, t.iloc[failed])):
                    label[i] = x
            yield pd.DataFrame({key: pdf[key], "label": label, "path": ["primary" if w is None else "fallback" for w in why],
                                "reason": why, "input_tokens": t.str.split().str.len().astype("int64"),
                                "output_tokens": [len(str(x).split()) for x in label]})

    kind = dict(df.dtypes)[key]
    return df.select(key, text).mapInPandas(
        run, f"{key} {kind}, label string, path string, reason string, input_tokens long, output_tokens long")


# ---- ML6: other model families (thin wrappers) --------------------------------

def train_linear(df: DataFrame, label: str, numeric: Sequence[str]):
    """ML6: linear regression on numeric features."""
    vec = VectorAssembler(inputCols=list(numeric), outputCol="features")
    return Pipeline(stages=[vec, LinearRegression(labelCol=label, maxIter=20)]).fit(df)


def train_kmeans(df: DataFrame, numeric: Sequence[str], k: int = 4, seed: int = 7):
    """ML6: k-means clustering of feature rows."""
    vec = VectorAssembler(inputCols=list(numeric), outputCol="features")
    return Pipeline(stages=[vec, KMeans(k=k, seed=seed)]).fit(df)


def train_gbt(df: DataFrame, label: str, numeric: Sequence[str], seed: int = 7):
    """ML6: gradient-boosted trees classifier."""
    vec = VectorAssembler(inputCols=list(numeric), outputCol="features")
    return Pipeline(stages=[vec, GBTClassifier(labelCol=label, maxIter=5, maxDepth=4, seed=seed)]).fit(df)


def train_als(df: DataFrame, user: str, item: str, rating: str, seed: int = 7):
    """ML6: implicit-feedback matrix factorisation (ALS)."""
    return ALS(userCol=user, itemCol=item, ratingCol=rating, implicitPrefs=True, rank=4, maxIter=5,
               seed=seed, coldStartStrategy="drop").fit(df)
