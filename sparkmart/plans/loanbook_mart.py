"""Daily loan-book mart: four silver processors, gold processors, label store and feature store.

PIP-8 (silver processors), PIP-9 (silver dispatch + write), PIP-10 (gold processors),
PIP-11 (grade label store), PIP-12 (feature store).  Keys are ``(member_id, snapshot_date)``.
Means, modes and vocabularies are fitted on one window (default: the requested one), not on all
snapshots (D10).  With a ``stages_root`` they are saved there as ``pyspark.ml`` stages at first use; later
windows are imputed and encoded by the saved ones, so all windows of a store have one schema.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.functions.dates import to_date_col
from sparkmart.models.stages import CategoryEncoder, MeanImputer, ModeImputer, fit_or_load
from sparkmart.operators.clean import fill_constant, missing_flags, normalise_text_cols
from sparkmart.operators.encode import binary_flag, ordinal_map
from sparkmart.operators.features import months_since, tenure_years, term_number, whole_months_since
from sparkmart.operators.joins import outer_chain
from sparkmart.operators.labels import grade_labels
from sparkmart.operators.schema import cast_to_double, enforce_schema, schema_audit
from sparkmart.sources.readers import read_csv, read_window
from sparkmart.sources.writers import write_snapshots

KEYS = ["member_id", "snapshot_date"]

# fixed values: column lists of the loan-book extracts
CREDIT_DROP = ["last_credit_pull_d", "mths_since_last_record", "mths_since_last_major_derog",
               "mths_since_recent_bc_dlq", "mths_since_recent_revol_delinq", "sec_app_chargeoff_within_12_mths",
               "sec_app_collections_12_mths_ex_med", "sec_app_mths_since_last_major_derog"]
CREDIT_FILL_MODE = ["inq_last_6mths", "acc_now_delinq", "delinq_2yrs", "pub_rec", "collections_12_mths_ex_med",
                    "chargeoff_within_12_mths", "tax_liens", "pub_rec_bankruptcies", "delinq_amnt"]
CREDIT_FILL_NEG1 = ["inq_last_12m", "num_tl_op_past_12m", "inq_fi", "mths_since_last_delinq",
                    "mths_since_recent_inq", "mths_since_rcnt_il", "mths_since_recent_bc", "num_tl_120dpd_2m",
                    "num_tl_30dpd", "num_tl_90g_dpd_24m", "num_accts_ever_120_pd"]
CREDIT_FILL_ZERO = ["mort_acc"]
CREDIT_INTS = ["mort_acc", "num_tl_op_past_12m", "inq_last_6mths", "inq_last_12m", "inq_fi",
               "mths_since_last_delinq", "mths_since_recent_inq", "mths_since_rcnt_il", "mths_since_recent_bc",
               "acc_now_delinq", "delinq_2yrs", "pub_rec", "collections_12_mths_ex_med", "chargeoff_within_12_mths",
               "tax_liens", "pub_rec_bankruptcies", "num_tl_120dpd_2m", "num_tl_30dpd", "num_tl_90g_dpd_24m",
               "num_accts_ever_120_pd", "delinq_amnt", "mort_acc_missing"]

DEMO_DROP = ["annual_inc_joint", "verification_status_joint", "sec_app_earliest_cr_line", "sec_app_inq_last_6mths",
             "sec_app_mort_acc", "sec_app_open_acc", "sec_app_revol_util", "sec_app_open_act_il",
             "sec_app_num_rev_accts"]
DEMO_STRINGS = ["emp_title", "emp_length", "home_ownership", "verification_status", "zip_code", "addr_state",
                "application_type"]

FIN_DROP = ["dti_joint", "revol_bal_joint"]
FIN_FLAG = ["all_util", "il_util", "bc_util"]
FIN_FILL_ZERO = ["revol_util", "total_rev_hi_lim", "tot_coll_amt", "tot_cur_bal", "avg_cur_bal", "all_util",
                 "max_bal_bc", "open_acc", "total_acc", "open_acc_6m", "open_act_il", "open_il_12m", "open_il_24m",
                 "open_rv_12m", "open_rv_24m", "acc_open_past_24mths", "num_actv_bc_tl", "num_actv_rev_tl",
                 "num_rev_accts", "num_rev_tl_bal_gt_0", "num_il_tl", "num_bc_tl", "num_op_rev_tl", "num_sats",
                 "num_bc_sats", "total_cu_tl"]
FIN_FILL_NEG1 = ["il_util", "bc_util", "total_bal_il", "total_bal_ex_mort", "total_bc_limit",
                 "total_il_high_credit_limit", "tot_hi_cred_lim", "mo_sin_old_il_acct", "mo_sin_old_rev_tl_op",
                 "mo_sin_rcnt_rev_tl_op", "mo_sin_rcnt_tl", "bc_open_to_buy", "percent_bc_gt_75", "pct_tl_nvr_dlq"]
FIN_DOUBLES = ["dti", "revol_bal", "revol_util", "total_rev_hi_lim", "tot_coll_amt", "tot_cur_bal", "avg_cur_bal",
               "all_util", "max_bal_bc", "il_util", "bc_util", "total_bal_il", "total_bal_ex_mort", "total_bc_limit",
               "total_il_high_credit_limit", "tot_hi_cred_lim", "bc_open_to_buy", "percent_bc_gt_75",
               "pct_tl_nvr_dlq"]
FIN_INTS = ["open_acc", "total_acc", "open_acc_6m", "open_act_il", "open_il_12m", "open_il_24m", "open_rv_12m",
            "open_rv_24m", "acc_open_past_24mths", "mo_sin_old_il_acct", "mo_sin_old_rev_tl_op",
            "mo_sin_rcnt_rev_tl_op", "mo_sin_rcnt_tl", "num_actv_bc_tl", "num_actv_rev_tl", "num_rev_accts",
            "num_rev_tl_bal_gt_0", "num_il_tl", "num_bc_tl", "num_op_rev_tl", "num_sats", "num_bc_sats",
            "total_cu_tl", "all_util_missing", "il_util_missing", "bc_util_missing"]

TERMS_DROP = ["url", "desc", "title", "hardship_flag", "hardship_type", "hardship_reason", "hardship_status",
              "deferral_term", "hardship_amount", "hardship_start_date", "hardship_end_date",
              "payment_plan_start_date", "hardship_length", "hardship_dpd", "hardship_loan_status",
              "orig_projected_additional_accrued_interest", "hardship_payoff_balance_amount",
              "hardship_last_payment_amount", "debt_settlement_flag_date", "settlement_status", "settlement_date",
              "settlement_amount", "settlement_percentage", "settlement_term", "out_prncp", "out_prncp_inv",
              "total_pymnt", "total_pymnt_inv", "total_rec_prncp", "total_rec_int", "total_rec_late_fee",
              "recoveries", "collection_recovery_fee", "last_pymnt_d", "next_pymnt_d", "last_pymnt_amnt",
              "policy_code"]
TERMS_FLAGS = {"pymnt_plan": "y", "debt_settlement_flag": "Y", "initial_list_status": "w",
               "disbursement_method": "Cash"}
TERMS_DOUBLES = ["loan_amnt", "funded_amnt", "funded_amnt_inv", "int_rate", "installment"]
TERMS_STRINGS = ["id", "term", "grade", "sub_grade", "loan_status", "pymnt_plan", "purpose", "initial_list_status",
                 "disbursement_method", "debt_settlement_flag"]
GRADE_CODES = {"A": 0, "B": 1, "C": 2, "D": 3, "E": 4, "F": 5, "G": 6}

DEMO_OHE = ["home_ownership", "verification_status", "addr_state", "application_type"]
TERMS_OHE = ["term", "loan_status", "pymnt_plan", "purpose", "initial_list_status", "disbursement_method",
             "debt_settlement_flag"]
GOLD_DEMO_OHE = ["home_ownership", "verification_status", "application_type"]
GOLD_TERMS_OHE = ["purpose", "loan_status"]
EMP_TITLE_TOP = 10


def _keys(df: DataFrame) -> DataFrame:
    return df.withColumns({"member_id": F.col("member_id").cast("string"),
                           "snapshot_date": F.col("snapshot_date").try_cast("date")})


def _present(df: DataFrame, cols: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in cols if c in have]


# ---- silver processors (PIP-8) -------------------------------------------------------------

def _stage_path(stages_root: str | None, name: str) -> str | None:
    return f"{stages_root.rstrip('/')}/{name}" if stages_root else None


def silver_credit_history(df: DataFrame, fit_df: DataFrame | None = None, stages_root: str | None = None) -> DataFrame:
    df = _keys(df).drop(*CREDIT_DROP)
    df = enforce_schema(df, {c: "int" for c in CREDIT_INTS}, strict=False)
    df = missing_flags(df, ["mort_acc"]) if "mort_acc" in df.columns else df
    cr = to_date_col("earliest_cr_line", "MMM-yyyy")
    df = df.withColumns({"earliest_cr_line": cr,
                         "months_since_earliest_cr_line": months_since(cr, F.col("snapshot_date"))})
    mode_cols = _present(df, CREDIT_FILL_MODE)
    fit = df if fit_df is None else enforce_schema(_keys(fit_df), {c: "int" for c in mode_cols}, strict=False)
    df = fit_or_load(df.sparkSession, _stage_path(stages_root, "credit_modes"), [ModeImputer(settings={"cols": mode_cols})], fit).transform(df)
    df = fill_constant(df, {c: -1 for c in _present(df, CREDIT_FILL_NEG1)})
    return fill_constant(df, {c: 0 for c in _present(df, CREDIT_FILL_ZERO)})


def silver_demographic(df: DataFrame) -> DataFrame:
    df = _keys(df).drop(*DEMO_DROP)
    df = enforce_schema(df, {c: "string" for c in DEMO_STRINGS if c in df.columns} | {"annual_inc": "double"},
                        strict=False)
    df = normalise_text_cols(df, ["emp_title"])
    return fill_constant(df, {c: "MISSING" for c in _present(df, ["emp_length", "home_ownership"])})


def silver_financial(df: DataFrame, fit_df: DataFrame | None = None, stages_root: str | None = None) -> DataFrame:
    df = _keys(df).drop(*FIN_DROP)
    types = {c: "double" for c in FIN_DOUBLES} | {c: "int" for c in FIN_INTS if not c.endswith("_missing")}
    df = enforce_schema(df, types, strict=False)
    df = missing_flags(df, _present(df, FIN_FLAG))
    fit = df if fit_df is None else enforce_schema(_keys(fit_df), types, strict=False)
    means = MeanImputer(settings={"cols": _present(df, ["dti"])})
    df = fit_or_load(df.sparkSession, _stage_path(stages_root, "financial_means"), [means], fit).transform(df)
    df = fill_constant(df, {c: 0 for c in _present(df, FIN_FILL_ZERO)})
    return fill_constant(df, {c: -1 for c in _present(df, FIN_FILL_NEG1)})


def silver_loan_terms(df: DataFrame) -> DataFrame:
    df = _keys(df).drop(*TERMS_DROP)
    df = enforce_schema(df, {c: "double" for c in TERMS_DOUBLES} | {c: "string" for c in TERMS_STRINGS},
                        strict=False)
    return df.withColumns({c: binary_flag(c, v) for c, v in TERMS_FLAGS.items() if c in df.columns})


SILVER = {"credit_history": silver_credit_history, "demographic": silver_demographic,
          "financial": silver_financial, "loan_terms": silver_loan_terms}


def silver_processing(raw: dict[str, DataFrame], output_root: str, dates: Iterable | None = None,
                      fit_dates: Iterable | None = None, stages_root: str | None = None) -> dict[str, int]:
    """PIP-9: run each processor over the window and write it partitioned by snapshot, sorted by key.

    ``raw`` maps category -> raw frame (e.g. ``read_csv`` of each extract).  Imputation
    statistics come from ``stages_root`` if saved there, else from ``fit_dates`` (default: the same
    window).  Returns the rows written per category.
    """
    written = {}
    for category, proc in SILVER.items():
        if category not in raw:
            continue
        df = _keys(raw[category])
        if dates is not None:
            df = df.where(F.col("snapshot_date").isin([F.lit(d).cast("date") for d in dates]))
        fit = df
        if fit_dates is not None:
            fit = _keys(raw[category]).where(F.col("snapshot_date").isin([F.lit(d).cast("date") for d in fit_dates]))
        out = proc(df, fit, stages_root) if category in ("credit_history", "financial") else proc(df)
        written[category] = write_snapshots(out, f"{output_root.rstrip('/')}/{category}", sort_by=("member_id",))
    return written


def read_extracts(spark: SparkSession, data_dir: str) -> dict[str, DataFrame]:
    """The extracts ``features_{category}.csv`` that a directory holds, every column as text; the
    processors give the columns their types."""
    from sparkmart.operators.encode import _path_exists

    raw = {}
    for category in SILVER:
        path = f"{data_dir.rstrip('/')}/features_{category}.csv"
        if _path_exists(spark, path):
            header = spark.read.option("header", True).csv(path).columns  # the first line only
            raw[category] = read_csv(spark, path, ", ".join(f"`{c}` string" for c in header))
    return raw


def silver_from_directory(spark: SparkSession, data_dir: str, output_root: str, dates: Iterable | None = None,
                          fit_dates: Iterable | None = None, stages_root: str | None = None) -> dict[str, int]:
    """PIP-9 from a directory of CSV extracts; an extract that is not there is an error."""
    raw = read_extracts(spark, data_dir)
    missing = [c for c in SILVER if c not in raw]
    if missing:
        raise FileNotFoundError(f"no extract of {missing} in {data_dir}")
    return silver_processing(raw, output_root, dates, fit_dates, stages_root)


# ---- gold processors (PIP-10) --------------------------------------------------------------

def gold_credit_history(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Drop the raw date; return the frame and its schema audit (PRJ-11) as data."""
    df = df.drop("earliest_cr_line")
    return df, schema_audit(df, keys=KEYS)


def gold_demographic(df: DataFrame, stages_root: str | None = None) -> DataFrame:
    df = df.drop("emp_title", "emp_length", "addr_state", "zip_code")
    stages = [CategoryEncoder.over(_present(df, GOLD_DEMO_OHE))]
    return fit_or_load(df.sparkSession, _stage_path(stages_root, "gold_demographic"), stages, df).transform(df)


def gold_financial(df: DataFrame) -> DataFrame:
    return cast_to_double(df, KEYS)


def gold_loan_terms(df: DataFrame, stages_root: str | None = None) -> DataFrame:
    df = df.drop("issue_d", "sub_grade").withColumns({
        "term": term_number("term"), "grade": ordinal_map("grade", GRADE_CODES)})
    stages = [CategoryEncoder.over(_present(df, GOLD_TERMS_OHE))]
    return fit_or_load(df.sparkSession, _stage_path(stages_root, "gold_loan_terms"), stages, df).transform(df)


def gold_processing(spark: SparkSession, silver_root: str, gold_root: str, start=None, end=None, dates: Iterable | None = None,
                    stages_root: str | None = None) -> DataFrame | None:
    """PIP-10: the four gold processors over the window; returns the credit-history audit."""
    audit = None
    procs = {"credit_history": gold_credit_history, "demographic": gold_demographic,
             "financial": gold_financial, "loan_terms": gold_loan_terms}
    for category, proc in procs.items():
        df = read_window(spark, f"{silver_root.rstrip('/')}/{category}", start, end, dates)
        out = proc(df, stages_root) if category in ("demographic", "loan_terms") else proc(df)
        if isinstance(out, tuple):
            out, audit = out
        write_snapshots(out, f"{gold_root.rstrip('/')}/{category}", sort_by=("member_id",))
    return audit


# ---- label store and feature store (PIP-11, PIP-12) ----------------------------------------

def gold_label_store(spark: SparkSession, silver_root: str, output_path: str, start=None, end=None) -> None:
    """PIP-11: ``(id, snapshot_date, grade)`` for loans with a grade, partitioned by snapshot."""
    terms = read_window(spark, f"{silver_root.rstrip('/')}/loan_terms", start, end)
    write_snapshots(grade_labels(terms, "id", "grade"), output_path)


def fs_credit(df: DataFrame) -> DataFrame:
    df = enforce_schema(_keys(df), {c: "int" for c in CREDIT_INTS}, strict=False)
    cr = F.col("earliest_cr_line")
    cr = F.coalesce(cr.try_cast("date"), to_date_col(cr, "MMM-yyyy"))
    return (df.withColumn("months_since_earliest_cr", whole_months_since(cr, F.col("snapshot_date")))
              .drop("earliest_cr_line"))


def fs_demographic(df: DataFrame, k: int = EMP_TITLE_TOP, stages_root: str | None = None) -> DataFrame:
    df = enforce_schema(_keys(df), {c: "string" for c in DEMO_STRINGS} | {"annual_inc": "double"}, strict=False)
    df = normalise_text_cols(df, ["emp_title"])  # normalise before counting (D16)
    if "emp_length" in df.columns:
        df = df.withColumn("emp_length", tenure_years("emp_length"))
    cols = ["emp_title", *_present(df, DEMO_OHE)]
    stages = [CategoryEncoder.over(cols, top={"emp_title": k}, names={c: f"{c}_ohe_{{}}" for c in cols})]
    df = fit_or_load(df.sparkSession, _stage_path(stages_root, "store_demographic"), stages, df).transform(df)
    return df.drop("earliest_cr_line", "zip_code")


def fs_financial(df: DataFrame) -> DataFrame:
    types = {c: "double" for c in FIN_DOUBLES} | {c: "int" for c in FIN_INTS}
    return enforce_schema(_keys(df), types, strict=False)


def fs_loan_terms(df: DataFrame, stages_root: str | None = None) -> DataFrame:
    df = enforce_schema(_keys(df), {c: "double" for c in TERMS_DOUBLES} | {c: "string" for c in TERMS_STRINGS},
                        strict=False)
    stages = [CategoryEncoder.over(_present(df, TERMS_OHE), drop_last=False)]
    df = fit_or_load(df.sparkSession, _stage_path(stages_root, "store_loan_terms"), stages, df).transform(df)
    return df.drop("issue_d", "id", "grade", "sub_grade")


def feature_store(spark: SparkSession, silver_root: str, output_path: str | None = None, start=None, end=None,
                  dates: Iterable | None = None, drop_keys: bool = False, stages_root: str | None = None) -> DataFrame:
    """PIP-12: four engineered categories, full outer on ``(member_id, snapshot_date)``.

    Keys are kept unless ``drop_keys`` (D18); the window is optional (D17).  The store is partitioned by
    snapshot while it has its keys.
    """
    def load(cat):
        return read_window(spark, f"{silver_root.rstrip('/')}/{cat}", start, end, dates)

    frames = [fs_loan_terms(load("loan_terms"), stages_root), fs_demographic(load("demographic"), stages_root=stages_root),
              fs_financial(load("financial")), fs_credit(load("credit_history"))]
    out = outer_chain(frames, KEYS, drop_keys=drop_keys)
    if output_path:
        write_snapshots(out, output_path, partition_cols=() if drop_keys else ("snapshot_date",))
    return out
