"""Model fitting (MLD-5, MLD-6, MLD-13) with ``pyspark.ml``.

The reference fits boosted trees on a pandas frame on the driver.  Here the fixed setting is a
``Pipeline`` of ``VectorAssembler`` + ``GBTClassifier`` fitted on the distributed training split; the
random search, whose space has L1 and L2 penalties and columns per tree, grows all settings and
folds together (``models/boosting``) and is scored on probabilities (D20).
"""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.functions.hashing import unit_hash
from sparkmart.session import shared_dir

# fixed values: the reference's search space (xgboost names)
SEARCH_SPACE = {
    "n_estimators": [25, 50],
    "max_depth": [2, 3],
    "learning_rate": [0.01, 0.1],
    "subsample": [0.6, 0.8],
    "colsample_bytree": [0.6, 0.8],
    "gamma": [0, 0.1],
    "min_child_weight": [1, 3, 5],
    "reg_alpha": [0, 0.1, 1],
    "reg_lambda": [1, 1.5, 2],
}
FIXED_PARAMS = {"n_estimators": 100, "max_depth": 5}

# xgboost name -> GBTClassifier param of the fixed setting; reg_alpha / reg_lambda have no counterpart there
PARAM_MAP = {
    "n_estimators": "maxIter",
    "max_depth": "maxDepth",
    "learning_rate": "stepSize",
    "subsample": "subsamplingRate",
    "colsample_bytree": "featureSubsetStrategy",
    "gamma": "minInfoGain",
    "min_child_weight": "minInstancesPerNode",
}


def gbt_params(xgb_params: Mapping[str, object]) -> dict[str, object]:
    out = {}
    for k, v in xgb_params.items():
        if k not in PARAM_MAP:
            continue
        name = PARAM_MAP[k]
        if name == "featureSubsetStrategy":
            v = str(float(v))
        elif name in ("maxIter", "maxDepth", "minInstancesPerNode"):
            v = int(v)
        else:
            v = float(v)
        out[name] = v
    return out


def make_pipeline(feature_cols: Sequence[str], label_col: str = "label", seed: int = 88, **gbt_kwargs):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    assembler = VectorAssembler(inputCols=list(feature_cols), outputCol="features", handleInvalid="error")
    gbt = GBTClassifier(featuresCol="features", labelCol=label_col, seed=seed, **gbt_kwargs)
    return Pipeline(stages=[assembler, gbt]), gbt


def train_gbt(train: DataFrame, feature_cols: Sequence[str], label_col: str = "label",
              params: Mapping[str, object] | None = None, seed: int = 88):
    """MLD-5: boosted trees with fixed parameters (default 100 trees, depth 5)."""
    pipe, _ = make_pipeline(feature_cols, label_col, seed, **gbt_params(params or FIXED_PARAMS))
    return pipe.fit(train.withColumn(label_col, F.col(label_col).cast("double")))


def mapped_space(space: Mapping[str, Sequence]) -> dict[str, Sequence]:
    """The part of a search space that ``GBTClassifier`` can act on."""
    return {k: v for k, v in space.items() if k in PARAM_MAP}


def sample_space(space: Mapping[str, Sequence], n_iter: int, seed: int = 42) -> list[dict]:
    """Distinct random draws from a discrete space (at most its size), reproducible by seed."""
    keys = list(space)
    total = 1
    for k in keys:
        total *= len(space[k])
    rng = random.Random(seed)
    seen, draws = set(), []
    while len(draws) < min(n_iter, total):
        d = tuple(rng.randrange(len(space[k])) for k in keys)
        if d not in seen:
            seen.add(d)
            draws.append({k: space[k][i] for k, i in zip(keys, d)})
    return draws


def random_search(train: DataFrame, feature_cols: Sequence[str], label_col: str = "label",
                  space: Mapping[str, Sequence] | None = None, n_iter: int = 100, folds: int = 3,
                  seed: int = 42, key_col: str = "loan_id", max_bins: int = 32):
    """MLD-6: ``n_iter`` distinct settings of the whole space x ``folds``-fold CV, AUC on probabilities (D20).

    Returns ``(best_pipeline_model, results)``: the best setting fitted on all rows, and a small
    DataFrame with one row per draw: its setting and the mean AUC over the folds.  All settings and
    folds grow in the same passes (``models/boosting``).  A row's fold is a hash of ``key_col``, so folds
    are the same for every setting and on a rerun.
    """
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import VectorAssembler

    from sparkmart.models import boosting
    from sparkmart.models.metrics import roc_auc

    space = space or SEARCH_SPACE
    draws = sample_space(space, n_iter, seed)
    spark: SparkSession = train.sparkSession
    shared_dir(spark)
    fold = F.least(F.floor(unit_hash(key_col, seed) * folds), F.lit(folds - 1)).cast("int")
    rows = train.select(key_col, *feature_cols, label_col).withColumn("_fold", fold).checkpoint(eager=True)
    growth = boosting.grow(rows, feature_cols, label_col, draws, key_col, "_fold", folds, max_bins=max_bins)
    scored = growth.held_out().withColumn("draw", F.floor(F.col("model") / folds).cast("int"))
    aucs = roc_auc(scored, "score", "label", ["draw", "fold"]).groupBy("draw").agg(F.avg("auc").alias("auc"))
    mean = {r["draw"]: r["auc"] for r in aucs.collect()}  # n_iter rows
    won = max(range(len(draws)), key=lambda i: (mean.get(i) or 0.0, -i))
    model = boosting.fit(rows, feature_cols, label_col, draws[won], key_col)
    best = PipelineModel(stages=[VectorAssembler(inputCols=list(feature_cols), outputCol="features", handleInvalid="error"), model])
    out = [(i, *[float(d[k]) for k in space], mean.get(i)) for i, d in enumerate(draws)]
    schema = "draw int, " + ", ".join(f"{k} double" for k in space) + ", mean_cv_auc double"
    return best, spark.createDataFrame(out, schema)


def run_record(spark: SparkSession, model_name: str, train_date, sizes: Mapping[str, int],
               results: Mapping[str, float], params: Mapping[str, object]) -> DataFrame:
    """MLD-13: one metrics-log row describing a training run."""
    row = {"model_name": model_name, "train_date": str(train_date),
           **{f"rows_{k}": int(v) for k, v in sizes.items()},
           **{k: float(v) for k, v in results.items()},
           "params": ";".join(f"{k}={v}" for k, v in sorted(params.items()))}
    return spark.createDataFrame([row]).withColumns({
        "train_date": F.to_date("train_date"), "created_at": F.current_timestamp()})
