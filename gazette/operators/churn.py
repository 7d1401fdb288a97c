"""Churn features, exact stratified split, model, scoring.

Everything stays a DataFrame; training and scoring are ``pyspark.ml`` (JVM),
so no rows are pulled into one process.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.buckets import hash60
from ..functions.constants import SUBSCRIPTION_CODE, SUBSCRIPTION_CODE_DEFAULT
from ..functions.dates import boundary_diff
from ..functions.rules import churn_rule_score, engagement_segment, risk_segment
from ..session import materialize
from . import ranking

FEATURES = ["days_since_login", "articles_read_30d", "tenure_months", "avg_session_sec",
            "paywall_bounces_30d", "sub_type_enc"]


def subscription_code(col) -> "F.Column":
    """M2: ordinal code, unknown or NULL -> default (2)."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for k, v in SUBSCRIPTION_CODE.items():
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr.otherwise(F.lit(SUBSCRIPTION_CODE_DEFAULT))


def churn_features(subscribers: DataFrame, as_of, keep: list | None = None) -> DataFrame:
    """M1 + M2: recency days, reads, tenure months (calendar), session, bounces, label.

    ``keep`` passes further subscriber columns through.
    """
    as_of_d = F.lit(str(as_of)).cast("date")
    return subscribers.select(
        "user_id",
        F.datediff(as_of_d, F.to_date("last_login")).cast("long").alias("days_since_login"),
        "articles_read_30d",
        boundary_diff("month", F.col("start_date"), as_of_d).alias("tenure_months"),
        "avg_session_sec",
        "paywall_bounces_30d",
        "subscription_type",
        "segment",
        F.col("churn_flag").cast("int").alias("churned"),
        subscription_code("subscription_type").alias("sub_type_enc"),
        *(keep or []),
    )


def model_inputs(features: DataFrame) -> DataFrame:
    """NULL features -> 0 (as the training frame's fillna(0))."""
    return features.fillna(0, subset=FEATURES)


def rule_scores(features: DataFrame, keep: list | None = None, digits: int = 6) -> DataFrame:
    """M11 + M12: fixed-formula churn score, its risk segment and the segment rule.

    NULL inputs of the score count as 0; the segment uses the unrounded score.
    """
    zero = F.lit(0).cast("long")
    score = churn_rule_score(*[F.coalesce(c, zero) for c in ("days_since_login", "articles_read_30d", "paywall_bounces_30d")])
    return features.select(
        "user_id", "churned", *(keep or []),
        F.round(score, digits).alias("churn_score"),
        risk_segment(score).alias("risk_segment"),
        engagement_segment("articles_read_30d", "days_since_login").alias("engagement_segment"),
    )


def stratified_split(df: DataFrame, label: str, test_fraction: float = 0.2, seed: int = 42,
                     key: str = "user_id", buckets_bits: int = 20) -> DataFrame:
    """M3: exact, deterministic stratified split.

    Rows are ordered inside each label by a 60-bit hash of ``(key, seed)``
    (ties by key); the first ``ceil(fraction * n_label)`` are ``test``.

    No task sorts a whole label: the hash's top ``buckets_bits`` bits form
    order-preserving buckets; a per-label histogram of bucket counts (at most
    2^bits rows per label) yields, by a running sum, how many rows precede
    each bucket.  Only the one bucket per label that holds the cut is ranked
    row by row; it is a uniform hash range, so it stays small.  Rows without a
    label are a class of their own.
    """
    h = hash60(F.col(key), f"seed{seed}")
    rows = df.withColumn("_h", h).withColumn("_b", F.shiftright(F.col("_h"), 60 - buckets_bits))
    frac = Fraction(test_fraction).limit_denominator(1_000_000)
    w = Window.partitionBy(label).orderBy("_b")
    hist = (rows.groupBy(label, "_b").agg(F.count("*").alias("_n"))
            .withColumn("_before", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)))
            .withColumn("_tot", F.sum("_n").over(Window.partitionBy(label)))
            # ceil(n * p / q) in exact integer arithmetic
            .withColumn("_k", F.expr(f"(_tot * {frac.numerator} + {frac.denominator - 1}) div {frac.denominator}"))
            .select(label, "_b", F.coalesce("_before", F.lit(0).cast("long")).alias("_before"), "_n", "_k"))
    # buckets wholly below or above the cut need no ranks; one bucket per label holds it; NULL is a label
    hist = hist.withColumnsRenamed({label: "_label", "_b": "_bucket"})
    placed = rows.join(hist, rows[label].eqNullSafe(hist["_label"]) & rows["_b"].eqNullSafe(hist["_bucket"])) \
        .drop("_label", "_bucket")
    cut = (F.col("_before") < F.col("_k")) & (F.col("_before") + F.col("_n") > F.col("_k"))
    rank = F.row_number().over(Window.partitionBy(label, "_b").orderBy("_h", key))
    whole = placed.where(~cut).withColumn("split", F.when(F.col("_before") < F.col("_k"), "test").otherwise("train"))
    split = placed.where(cut).withColumn("split", F.when(F.col("_before") + rank <= F.col("_k"), "test")
                                         .otherwise("train"))
    return whole.unionByName(split).drop("_h", "_b", "_before", "_k", "_n")


def assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=FEATURES, outputCol="features")


def gbt(max_iter: int = 100, max_depth: int = 5, step_size: float = 0.1,
        subsampling_rate: float = 0.8, seed: int = 42) -> GBTClassifier:
    """M4: gradient-boosted trees, 100 trees of depth 5, lr 0.1, 0.8 subsample."""
    return GBTClassifier(featuresCol="features", labelCol="churned", maxIter=max_iter,
                         maxDepth=max_depth, stepSize=step_size, subsamplingRate=subsampling_rate,
                         seed=seed)


def gbt_pipeline(**kw) -> Pipeline:
    """The unfitted two-stage pipeline (assembler + trees)."""
    return Pipeline(stages=[assembler(), gbt(**kw)])


TRAIN_ROWS = 250_000  # training rows of a partition


def train_partitions(rows: int) -> int:
    """Partitions of a training set: 8 up to two million rows, then one per ``TRAIN_ROWS``."""
    return max(8, -(-rows // TRAIN_ROWS))


def train(split_df: DataFrame, partitions: int | None = None, key: str = "user_id", **kw) -> PipelineModel:
    """Fit on the ``train`` rows; returns ``PipelineModel([assembler, trees])``.

    Each tree is grown on a sample that Spark draws per partition, so the
    layout is part of the model: rows go to ``partitions`` partitions by their
    key and are sorted within, whatever the input's layout or the number of
    cores.  Their number follows from the row count alone
    (``train_partitions``), so equal data give an equal model.  Rows without a
    label are not trained on.
    """
    asm = assembler()
    rows = split_df.where((F.col("split") == "train") & F.col("churned").isNotNull())
    partitions = partitions or train_partitions(rows.count())
    vec = asm.transform(model_inputs(rows)) \
        .select(key, "features", "churned").repartition(partitions, key).sortWithinPartitions(key) \
        .select("features", "churned").persist()
    try:
        return PipelineModel(stages=[asm, gbt(**kw).fit(vec)])
    finally:
        vec.unpersist()


def score(model: PipelineModel, features: DataFrame, as_served: bool = False) -> DataFrame:
    """M9: probability (rounded 4) and risk segment on the unrounded value.

    ``as_served=True`` reproduces the serving function, which fixes the
    subscription code to 2 whatever the subscriber's type.
    """
    f = model_inputs(features)
    if as_served:
        f = f.withColumn("sub_type_enc", F.lit(SUBSCRIPTION_CODE_DEFAULT))
    out = model.transform(f)
    p = vector_to_array("probability")[1]
    return out.select(*features.columns, F.round(p, 4).alias("churn_probability"),
                      risk_segment(p).alias("risk_segment"))


def roc_auc(model: PipelineModel, split_df: DataFrame) -> float:
    """M5: ROC AUC on the test split, every distinct score a step of the curve (no binning)."""
    test = model_inputs(split_df.where(F.col("split") == "test"))
    pred = model.transform(test)
    return BinaryClassificationEvaluator(labelCol="churned", rawPredictionCol="rawPrediction",
                                         metricName="areaUnderROC", numBins=0).evaluate(pred)


def classification_report(pred: DataFrame, label: str = "churned", prediction: str = "prediction",
                          names: dict | None = None) -> DataFrame:
    """M6: precision, recall, F1 and support per class from one confusion pass."""
    names = names or {0: "Active", 1: "Churned"}
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    zero = F.lit(0).cast("long")
    sums = pred.agg(*[
        a for c in names for a in (
            F.count_if((y == c) & (p == c)).alias(f"tp{c}"),
            F.count_if(p == c).alias(f"pp{c}"),
            F.count_if(y == c).alias(f"s{c}"))
    ])
    per_class = F.inline(F.array(*[
        F.struct(F.lit(nm).alias("class"), F.coalesce(F.col(f"tp{c}"), zero).alias("tp"),
                 F.coalesce(F.col(f"pp{c}"), zero).alias("pp"), F.coalesce(F.col(f"s{c}"), zero).alias("s"))
        for c, nm in names.items()]))
    t = sums.select(per_class)
    tp, pp, s = F.col("tp"), F.col("pp"), F.col("s")
    prec = F.when(pp > 0, tp / pp).otherwise(F.lit(0.0))
    rec = F.when(s > 0, tp / s).otherwise(F.lit(0.0))
    f1 = F.when(prec + rec > 0, F.lit(2.0) * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    return t.select("class", F.round(prec, 6).alias("precision"), F.round(rec, 6).alias("recall"),
                    F.round(f1, 6).alias("f1"), s.alias("support"))


def feature_importance(model: PipelineModel) -> DataFrame:
    """M7: importances of the fitted trees, most important first."""
    from pyspark.sql import SparkSession

    imps = model.stages[-1].featureImportances.toArray().tolist()  # one value per feature
    df = SparkSession.getActiveSession().createDataFrame([(f, float(v)) for f, v in zip(FEATURES, imps)], "feature string, importance double")
    return df.orderBy(F.desc("importance"), F.asc("feature"))


def permutation_importance(features: DataFrame, score, columns: list, label: str = "churned", key: str = "user_id",
                           seed: int = 42) -> DataFrame:
    """M7 for any score: how much the squared error grows when one feature is shuffled between rows.

    ``score`` is an expression over the features, or a function from a frame to
    a frame with a ``score`` column.  A feature is shuffled by a shift in the
    order of a 60-bit hash of key and feature name (the last row takes the
    first's value), so the shuffle is a fixed permutation that any engine
    reproduces.  Rows are sorted over the cluster once per feature; losses are
    sums, one row per feature.  Returns ``feature, base_loss, permuted_loss,
    importance``; rows without a label take no part.
    """
    rows = materialize(features.where(F.col(label).isNotNull()), "importance-rows")
    scored = score if callable(score) else (lambda df: df.withColumn("score", score))

    def loss(df: DataFrame, name: str) -> DataFrame:
        error = F.pow(F.col(label).cast("double") - F.col("score"), 2)
        return scored(df).agg(F.avg(error).alias(name))

    out = None
    for c in columns:
        order = [hash60(F.col(key), f"perm{seed}:{c}"), F.col(key)]
        one = loss(ranking.permuted(rows, c, order, "importance-shift"), "permuted_loss").withColumn("feature", F.lit(c))
        out = one if out is None else out.unionByName(one)
    base = loss(rows, "base_loss").first()[0]
    return out.select("feature", F.lit(base).cast("double").alias("base_loss"), "permuted_loss",
                      (F.col("permuted_loss") - F.lit(base).cast("double")).alias("importance"))


def tree_nodes(model: PipelineModel) -> dict:
    """The fitted trees as flat arrays, one entry per node of all trees.

    ``feature`` (-1: a leaf), ``threshold``, ``left``, ``right`` (places of the
    children), ``value`` (a leaf's prediction); ``root`` and ``weight`` have one
    entry per tree.  Their size follows the number of trees and their depth.
    """
    trees = model.stages[-1]
    out = {"feature": [], "threshold": [], "left": [], "right": [], "value": [], "root": [],
           "weight": [float(w) for w in trees.treeWeights], "depth": 0}
    for tree in trees.trees:
        out["root"].append(len(out["feature"]))
        out["depth"] = max(out["depth"], tree.depth)
        todo = [(tree._call_java("rootNode"), None, None)]
        while todo:
            node, parent, side = todo.pop()
            here = len(out["feature"])
            if parent is not None:
                out[side][parent] = here
            inner = node.getClass().getSimpleName() == "InternalNode"
            split = node.split() if inner else None
            out["feature"].append(split.featureIndex() if inner else -1)
            out["threshold"].append(split.threshold() if inner else 0.0)
            out["value"].append(node.prediction())
            out["left"].append(-1)
            out["right"].append(-1)
            if inner:
                todo += [(node.rightChild(), here, "right"), (node.leftChild(), here, "left")]
    return out


def save_model(model: PipelineModel, path: str) -> str:
    """M8: persist the fitted pipeline (shared storage)."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def at_risk_topn(scored: DataFrame, subscribers: DataFrame, n: int = 10,
                 segment: str = "HIGH") -> DataFrame:
    """Subscribers in a risk segment with the highest lifetime value."""
    cols = ["user_id", "subscription_type", "ltv_estimated_eur", "churn_probability", "risk_segment"]
    if set(cols) <= set(scored.columns):  # the score kept them: no join
        j = scored.select(*cols)
    else:
        s = subscribers.select(*cols[:3])
        j = s.join(scored.select("user_id", "churn_probability", "risk_segment"), "user_id")
    return (j.where(F.col("risk_segment") == segment)
            .orderBy(F.desc("ltv_estimated_eur"), F.asc("user_id")).limit(n))
