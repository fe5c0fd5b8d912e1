"""Train -> score -> monitor jobs (PIP-14, PIP-15, PIP-16).

The model artefact is one ``PipelineModel``: a ``SQLTransformer`` that scales with the
training statistics (population std, null -> 0 after scaling, D21), the assembler and the
boosted trees.  Scoring needs nothing but that folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.models.metrics import f1_accuracy, roc_auc
from sparkmart.models.monitor import monitor
from sparkmart.models.scale import fit_scaler
from sparkmart.models.score import score
from sparkmart.models.split import assign_windows, stratified_split
from sparkmart.models.train import FIXED_PARAMS, gbt_params, random_search, run_record
from sparkmart.operators.calendar import window_bounds
from sparkmart.operators.filters import range_with_fallback
from sparkmart.operators.joins import attach_features, inner_with_suffixes
from sparkmart.sources.readers import read_window
from sparkmart.sources.writers import append_rows, save_model, write_predictions


def scaling_stage(stats: dict[str, tuple[float, float]]):
    from pyspark.ml.feature import SQLTransformer

    parts = [f"coalesce((CAST(`{c}` AS DOUBLE) - ({m!r})) / ({s!r}), 0.0) AS `{c}__z`" for c, (m, s) in stats.items()]
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def training_frame(labels: DataFrame, features: DataFrame, keys: Sequence[str], train_date,
                   oot_months: int = 2, train_months: int = 12) -> DataFrame:
    """MLD-1/2: labels LEFT JOIN features, tagged with the train/test and OOT windows."""
    return assign_windows(attach_features(labels, features, keys), train_date, "snapshot_date",
                          oot_months, train_months)


def train_job(spark: SparkSession, labels: DataFrame, features: DataFrame, feature_cols: Sequence[str],
              train_date, model_path: str, metrics_root: str | None = None, keys=("Customer_ID", "snapshot_date"),
              model_name: str = "credit_model", search: bool = True, n_iter: int = 100, ratio: float = 0.8,
              key_col: str = "loan_id", params: dict | None = None):
    """PIP-14: windows -> stratified split -> scaling fitted on train -> (search or fixed) GBT ->
    AUC/Gini on train, test and OOT, F1/accuracy on test -> model + run record."""
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    # only the two windows are read and joined: the bounds reach both sides' scans
    bounds = window_bounds(F.lit(str(train_date)).cast("date"))
    used = F.col("snapshot_date").between(bounds["train_start"], bounds["oot_end"])
    features = features.where(used) if "snapshot_date" in keys else features
    df = training_frame(labels.where(used), features, keys, train_date).withColumn("label", F.col("label").cast("double"))
    tt = stratified_split(df.where(F.col("window_name") == "train_test"), key_col, "label", ratio, seed=88)
    train = tt.where(F.col("split") == "train")
    stats = fit_scaler(train, feature_cols)
    scaler = scaling_stage(stats)
    zcols = [f"{c}__z" for c in feature_cols]
    if search:
        best, results = random_search(scaler.transform(train), zcols, "label", n_iter=n_iter, folds=3, key_col=key_col)
        fitted = PipelineModel(stages=[scaler, *best.stages])
        draws = results.collect()  # n_iter rows
        params = {f"draw_{r['draw']}_cv_auc": r["mean_cv_auc"] for r in draws}
        won = max(draws, key=lambda r: (r["mean_cv_auc"], -r["draw"])).asDict()
        params |= {f"best_{k}": v for k, v in won.items()}
    else:
        params = dict(params or FIXED_PARAMS)
        gbt = GBTClassifier(featuresCol="features", labelCol="label", seed=88, **gbt_params(params))
        fitted = Pipeline(stages=[scaler, VectorAssembler(inputCols=zcols, outputCol="features"), gbt]).fit(train)
    save_model(fitted, model_path)

    scored = score(fitted, tt.unionByName(df.where(F.col("window_name") == "oot").withColumn("split", F.lit("oot"))),
                   [key_col, "split", "label"], model_name)
    # three metric passes read the scored rows: materialise them once in the shared folder
    # (reliable checkpoint) instead of recomputing joins, split and model transform each time
    from sparkmart.session import shared_dir
    shared_dir(spark)
    scored = scored.checkpoint(eager=True)
    aucs = {r["split"]: r["auc"] for r in roc_auc(scored, "score", "label", ["split"]).collect()}
    fa = f1_accuracy(scored.where(F.col("split") == "test"), "score", "label").first()
    seen = scored.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("rate")).collect()
    sizes = {r["split"]: r["n"] for r in seen}
    results = {f"auc_{k}": v for k, v in aucs.items() if v is not None}
    results.update({f"gini_{k}": round(2 * v - 1, 3) for k, v in aucs.items() if v is not None})
    results.update({f"positive_rate_{r['split']}": r["rate"] for r in seen})
    results.update({"f1_score": fa["f1_score"], "accuracy": fa["accuracy"]})
    record = run_record(spark, model_name, train_date, sizes, results, {str(k): v for k, v in params.items()})
    record = record.withColumns(bounds)
    if metrics_root:
        append_rows(record, metrics_root)
    return fitted, record


def simple_train_job(spark: SparkSession, labels: DataFrame, features: DataFrame, feature_cols: Sequence[str], start, end,
                     model_path: str, metrics_root: str | None = None, keys=("Customer_ID", "snapshot_date"), date_col: str = "snapshot_date",
                     model_name: str = "credit_model", ratio: float = 0.75, key_col: str = "loan_id"):
    """PIP-14, the simpler form: ``[start, end)`` of both stores (FLT-4), inner join (JON-4), 75/25 split
    stratified by label (MLD-3), scaling fitted on train (MLD-4), the fixed model (MLD-5), AUC, F1 and
    accuracy on test (MLD-7/8), model saved and one metrics row appended (SNK-8/9).  Returns both."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    from sparkmart.session import shared_dir

    labels, features = (range_with_fallback(df, date_col, start, end) for df in (labels, features))
    df = inner_with_suffixes(labels, features, keys).withColumn("label", F.col("label").cast("double"))
    shared_dir(spark)
    # the split, the scaler, the model and the metrics all read the joined rows: write them once
    rows = stratified_split(df.select(key_col, "label", *feature_cols), key_col, "label", ratio, seed=42).checkpoint(eager=True)
    train = rows.where(F.col("split") == "train")
    stats = fit_scaler(train, feature_cols)
    gbt = GBTClassifier(featuresCol="features", labelCol="label", seed=88, **gbt_params(FIXED_PARAMS))
    assembler = VectorAssembler(inputCols=[f"{c}__z" for c in feature_cols], outputCol="features")
    fitted = Pipeline(stages=[scaling_stage(stats), assembler, gbt]).fit(train)
    save_model(fitted, model_path)
    scored = score(fitted, rows.where(F.col("split") == "test"), [key_col, "label"], model_name).checkpoint(eager=True)
    sizes = {r["split"]: r["n"] for r in rows.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    fa = f1_accuracy(scored, "score", "label").first()
    auc = roc_auc(scored, "score", "label").first()
    out = spark.createDataFrame(
        [(model_name, auc["auc"] if auc else None, fa["f1_score"], fa["accuracy"], sizes.get("train", 0), sizes.get("test", 0), str(start), str(end))],
        "model_name string, auc_score double, f1_score double, accuracy double, rows_train long, rows_test long, start_date string, end_date string"
    ).withColumns({"start_date": F.to_date("start_date"), "end_date": F.to_date("end_date"), "created_at": F.current_timestamp()})
    if metrics_root:
        append_rows(out, metrics_root)
    return fitted, out


def score_job(spark: SparkSession, model_path: str, features: DataFrame, keys: Sequence[str], model_name: str,
              predictions_root: str | None = None, start=None, end=None) -> DataFrame:
    """PIP-15 / MLD-10/11: score every snapshot of the window in one transform; write by model + snapshot."""
    from sparkmart.sources.writers import load_model

    if start is not None or end is not None:
        d = F.col("snapshot_date")
        if start is not None:
            features = features.where(d >= F.lit(start).cast("date"))
        if end is not None:
            features = features.where(d <= F.lit(end).cast("date"))
    preds = score(load_model(model_path), features, list(keys), model_name)
    if predictions_root:
        write_predictions(preds, predictions_root)
    return preds


def monitor_job(spark: SparkSession, predictions_root: str, labels: DataFrame, keys: Sequence[str],
                metrics_root: str | None = None, model_name: str | None = None) -> DataFrame:
    """PIP-16 / MLD-12: realised-label metrics per model and snapshot, appended to the metrics log."""
    preds = read_window(spark, predictions_root)
    if model_name is not None:
        preds = preds.where(F.col("model_name") == model_name)
    out = monitor(preds, labels, keys).withColumn("created_at", F.current_timestamp())
    if metrics_root:
        append_rows(out, metrics_root)
    return out
