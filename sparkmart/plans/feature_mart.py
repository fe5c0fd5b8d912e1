"""Monthly feature mart: attributes, financials, clickstream and loans -> gold feature store.

PIP-3 (attributes), PIP-4 (clickstream), PIP-5 (financials), PIP-6 (gold features).
Dirty numeric text is cleaned first and cast after (D2/D3); vocabularies for the one-hot and
multi-hot columns are stored beside the gold store and grow with each window (D12), so all its
snapshots share one schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.functions.text import slug, strip_to_decimal, strip_to_digits
from sparkmart.operators.clean import cap_with_flag, dedupe_keys, null_sentinels
from sparkmart.operators.encode import (
    VocabularyTooLarge, count_values, multi_hot, one_hot, ordinal_map, split_list, update_vocabularies,
)
from sparkmart.operators.features import guarded_ratio, history_months, valid_flag
from sparkmart.operators.joins import left_chain
from sparkmart.operators.schema import enforce_schema
from sparkmart.sources.readers import read_csv, read_window
from sparkmart.sources.writers import write_snapshots

KEYS = ["Customer_ID", "snapshot_date"]

# fixed values: sentinels and codes of the source extracts
OCCUPATION_SENTINEL = "_______"
PAYMENT_BEHAVIOUR_SENTINEL = "!@9#%8"
CREDIT_MIX_SENTINEL = "_"
MIN_AMOUNT_SENTINEL = "NM"
CREDIT_MIX_CODES = {"Bad": 0, "Standard": 1, "Good": 2}
MIN_AMOUNT_CODES = {"No": 0, "Yes": 1}
LOAN_COUNT_CAP = 20
AGE_RANGE = (18, 100)

CLICK_TYPES = {**{f"fe_{i}": "int" for i in range(1, 21)}, "Customer_ID": "string", "snapshot_date": "date"}

FIN_TYPES = {
    "Customer_ID": "string", "Monthly_Inhand_Salary": "double", "Num_Bank_Accounts": "int",
    "Num_Credit_Card": "int", "Interest_Rate": "int", "Type_of_Loan": "string", "Delay_from_due_date": "int",
    "Num_Credit_Inquiries": "double", "Credit_Mix": "string", "Outstanding_Debt": "double",
    "Credit_Utilization_Ratio": "double", "Credit_History_Age": "string", "Payment_of_Min_Amount": "string",
    "Total_EMI_per_month": "double", "Payment_Behaviour": "string", "Monthly_Balance": "double",
    "snapshot_date": "date",
}


def silver_attributes(df: DataFrame) -> DataFrame:
    """PIP-3: Age digits-only and 18..100 (null dropped), Occupation sentinel -> ``Unknown``, PII dropped."""
    out = df.withColumns({
        "Age": strip_to_digits("Age"),
        "Occupation": F.coalesce(F.when(F.col("Occupation") != OCCUPATION_SENTINEL, F.col("Occupation")),
                                 F.lit("Unknown")),
        "snapshot_date": F.col("snapshot_date").try_cast("date"),
        "Customer_ID": F.col("Customer_ID").cast("string"),
    })
    out = out.where(F.col("Age").between(*AGE_RANGE))
    return out.drop("Name", "SSN")


def silver_clickstream(df: DataFrame) -> DataFrame:
    """PIP-4: ``fe_1..fe_20`` to int."""
    return enforce_schema(df, CLICK_TYPES, strict=True)


def silver_financials(df: DataFrame) -> DataFrame:
    """PIP-5: clean dirty numerics, cap loan count, ordinal codes, credit-history months, ratios."""
    out = enforce_schema(df, FIN_TYPES, strict=False)
    out = out.withColumns({
        "Annual_Income": strip_to_decimal("Annual_Income"),
        "Amount_invested_monthly": strip_to_decimal("Amount_invested_monthly"),
        "Changed_Credit_Limit": strip_to_decimal("Changed_Credit_Limit"),
        "Num_of_Loan": strip_to_digits("Num_of_Loan"),
        "Num_of_Delayed_Payment": strip_to_digits("Num_of_Delayed_Payment"),
    })
    out = null_sentinels(out, {"Payment_Behaviour": [PAYMENT_BEHAVIOUR_SENTINEL],
                               "Credit_Mix": [CREDIT_MIX_SENTINEL],
                               "Payment_of_Min_Amount": [MIN_AMOUNT_SENTINEL]})
    out = cap_with_flag(out, "Num_of_Loan", LOAN_COUNT_CAP, "Num_of_Loan_Overcap_Flag")
    out = out.withColumns({
        "Credit_Mix": ordinal_map("Credit_Mix", CREDIT_MIX_CODES),
        "Payment_of_Min_Amount": ordinal_map("Payment_of_Min_Amount", MIN_AMOUNT_CODES),
        "credit_history_yrs": F.regexp_extract("Credit_History_Age", r"(\d+)\s+Years?", 1).try_cast("int"),
        "credit_history_mths": F.regexp_extract("Credit_History_Age", r"(\d+)\s+Months?", 1).try_cast("int"),
        "Credit_History_in_Months": history_months("Credit_History_Age"),
    })
    out = out.withColumns({
        "Debt_to_income": guarded_ratio("Outstanding_Debt", "Annual_Income"),
        "Loan_to_income": guarded_ratio("Total_EMI_per_month", "Monthly_Inhand_Salary"),
        "Investment_rate": guarded_ratio("Amount_invested_monthly", "Monthly_Inhand_Salary"),
        "Delayed_payment_ratio": guarded_ratio("Num_of_Delayed_Payment", "Num_of_Loan"),
    })
    return out.drop("Credit_History_Age", "Changed_Credit_Limit")


def _value_counts(attributes: DataFrame, financials: DataFrame, strip_and: bool) -> DataFrame:
    """Counts of the three encoded columns: one scan of the attributes, one of the financials."""
    types = split_list(F.col("Type_of_Loan"), strip_and=strip_and)
    return count_values(attributes, ["Occupation"]).unionByName(
        count_values(financials, ["Payment_Behaviour"], {"Type_of_Loan": types}))


def gold_features(loans: DataFrame, attributes: DataFrame, financials: DataFrame, clickstream: DataFrame,
                  strip_and: bool = False, max_values: int | None = None,
                  vocabulary: DataFrame | None = None) -> DataFrame:
    """PIP-6: loans LEFT JOIN encoded attributes LEFT JOIN encoded financials LEFT JOIN clickstream.

    The encoded columns are those of ``vocabulary`` (column, value), or of the values at hand without
    one.  All three right sides are made unique on ``(Customer_ID, snapshot_date)`` (D15), before they are widened.
    Empty strings never get a column (D14).
    """
    attrs = dedupe_keys(attributes.withColumn("Has_Valid_Age", valid_flag("Age")), KEYS)
    fin = dedupe_keys(financials, KEYS)
    if vocabulary is None:
        vocabulary = _value_counts(attributes, financials, strip_and)
    names: dict[str, list] = {"Occupation": [], "Payment_Behaviour": [], "Type_of_Loan": []}
    rows = vocabulary.select("column", "value")
    for r in (rows if max_values is None else rows.limit(3 * max_values + 1)).collect():
        names[r["column"]].append(r["value"])  # they become column names
    for c, values in names.items():
        values.sort()
        if max_values is not None and len(values) > max_values:
            raise VocabularyTooLarge(f"{c}: more than {max_values} distinct values")
    attrs = one_hot(attrs, "Occupation", names["Occupation"])
    fin = one_hot(fin, "Payment_Behaviour", names["Payment_Behaviour"], prefix="payment_behaviour")
    fin = multi_hot(fin, "Type_of_Loan", names["Type_of_Loan"], prefix="loan_type", strip_and=strip_and)
    return left_chain(loans, [(attrs, KEYS, True), (fin, KEYS, True), (dedupe_keys(clickstream, KEYS), KEYS, True)])


# ---- layer jobs over stored tables (bronze -> silver -> gold), one job per layer per window ----

SOURCES = ("attributes", "financials", "clickstream")


def _text_schema(cols) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in cols])


# raw extracts are read as text (dirty numerics stay strings until cleaned, D2)
RAW_SCHEMAS = {
    "attributes": _text_schema(["Customer_ID", "Name", "Age", "SSN", "Occupation", "snapshot_date"]),
    "financials": _text_schema([
        "Customer_ID", "Annual_Income", "Monthly_Inhand_Salary", "Num_Bank_Accounts", "Num_Credit_Card",
        "Interest_Rate", "Num_of_Loan", "Type_of_Loan", "Delay_from_due_date", "Num_of_Delayed_Payment",
        "Changed_Credit_Limit", "Num_Credit_Inquiries", "Credit_Mix", "Outstanding_Debt", "Credit_Utilization_Ratio",
        "Credit_History_Age", "Payment_of_Min_Amount", "Total_EMI_per_month", "Amount_invested_monthly",
        "Payment_Behaviour", "Monthly_Balance", "snapshot_date"]),
    "clickstream": _text_schema([f"fe_{i}" for i in range(1, 21)] + ["Customer_ID", "snapshot_date"]),
}

SILVER_FNS = {"attributes": silver_attributes, "financials": silver_financials, "clickstream": silver_clickstream}


def bronze(spark: SparkSession, sources: dict[str, str], bronze_root: str, start=None, end=None) -> None:
    """Land each CSV extract's snapshots in ``[start, end]`` as partitioned Parquet (text columns)."""
    for name, path in sources.items():
        raw = read_csv(spark, path, RAW_SCHEMAS[name]).withColumn("snapshot_date", F.try_to_date("snapshot_date"))
        if start is not None:
            raw = raw.where(F.col("snapshot_date") >= F.lit(start).cast("date"))
        if end is not None:
            raw = raw.where(F.col("snapshot_date") <= F.lit(end).cast("date"))
        write_snapshots(raw, f"{bronze_root.rstrip('/')}/{name}")


def silver(spark: SparkSession, bronze_root: str, silver_root: str, start=None, end=None) -> None:
    """PIP-3/4/5 over the window: one job per subject table."""
    for name in SOURCES:
        df = read_window(spark, f"{bronze_root.rstrip('/')}/{name}", start, end)
        write_snapshots(SILVER_FNS[name](df), f"{silver_root.rstrip('/')}/{name}", sort_by=("Customer_ID",))


def vocabulary_path(gold_root: str) -> str:
    """Where a gold store's vocabularies live: beside it, so that they are no snapshot of it."""
    return gold_root.rstrip("/") + "_vocabulary"


def gold(spark: SparkSession, silver_root: str, loans_root: str, gold_root: str, start=None, end=None,
         strip_and: bool = False) -> None:
    """PIP-6 over the window.  The store's vocabularies take in the window's new values first, so a later
    window keeps every column of the earlier ones (D12); ``read_gold`` reads all windows as one schema."""
    def load(root):
        return read_window(spark, root, start, end)

    loans = load(loans_root)
    parts = {n: load(f"{silver_root.rstrip('/')}/{n}") for n in SOURCES}
    counts = _value_counts(parts["attributes"], parts["financials"], strip_and)
    vocabulary = update_vocabularies(counts, vocabulary_path(gold_root))
    out = gold_features(loans, parts["attributes"], parts["financials"], parts["clickstream"], strip_and=strip_and,
                        vocabulary=vocabulary)
    write_snapshots(out, gold_root, sort_by=("Customer_ID",))


def read_gold(spark: SparkSession, gold_root: str, start=None, end=None) -> DataFrame:
    """The gold store with the columns of all its windows.  A row written before a value was known has
    0 in that value's column if its side was found (another column of the side's encoding is not null)."""
    df = read_window(spark, gold_root, start, end, merge_schema=True)
    prefixes = {"Occupation": "Occupation", "Payment_Behaviour": "payment_behaviour", "Type_of_Loan": "loan_type"}
    groups: dict[str, list] = {}
    for r in spark.read.parquet(vocabulary_path(gold_root)).select("column", "value").collect():
        name = f"{prefixes[r['column']]}_{slug(r['value'])}"
        if name in df.columns and name not in groups.setdefault(r["column"], []):
            groups[r["column"]].append(name)
    filled = {c: F.when(F.coalesce(*[F.col(f"`{x}`") for x in cols]).isNotNull(), F.coalesce(F.col(f"`{c}`"), F.lit(0)))
              for cols in groups.values() for c in cols}
    return df.withColumns(filled)
