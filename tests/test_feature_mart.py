"""Monthly feature mart: attributes, financials, clickstream, gold features (FIXTURES.md §1.2-1.4)."""

import datetime as dt

from pyspark.sql import functions as F

from sparkmart.plans import feature_mart as fm

SNAP = "2023-01-01"


def test_attributes_age_and_occupation(spark):
    rows = [("A1", "n", "s", "23", "Teacher"), ("A2", "n", "s", "23_", "_______"), ("A3", "n", "s", "-25", None),
            ("A4", "n", "s", "17", "x"), ("A5", "n", "s", "101", "x"), ("A6", "n", "s", "", "x"),
            ("A7", "n", "s", None, "x"), ("A8", "n", "s", "18", "Media-Manager X"), ("A9", "n", "s", "100", "y")]
    df = spark.createDataFrame([(*r, SNAP) for r in rows],
                               "Customer_ID string, Name string, SSN string, Age string, Occupation string, "
                               "snapshot_date string")
    out = {r["Customer_ID"]: r for r in fm.silver_attributes(df).collect()}
    assert set(out) == {"A1", "A2", "A3", "A8", "A9"}
    assert out["A2"]["Age"] == 23 and out["A3"]["Age"] == 25  # D2 fixed, D5 kept
    assert out["A2"]["Occupation"] == "Unknown" and out["A3"]["Occupation"] == "Unknown"
    assert "Name" not in fm.silver_attributes(df).columns and "SSN" not in fm.silver_attributes(df).columns


def _fin(spark, rows):
    cols = ["Customer_ID", "Annual_Income", "Amount_invested_monthly", "Num_of_Loan", "Num_of_Delayed_Payment",
            "Credit_Mix", "Payment_of_Min_Amount", "Payment_Behaviour", "Credit_History_Age", "Type_of_Loan",
            "Changed_Credit_Limit", "Outstanding_Debt", "Monthly_Inhand_Salary", "Total_EMI_per_month"]
    full = [(*r, "_", "100.0", "1000.0", "10.0", SNAP) for r in rows]
    return spark.createDataFrame(full, ", ".join(f"{c} string" for c in cols) + ", snapshot_date string")


def test_financials_cleaning(spark):
    rows = [
        ("F1", "34847.84", "__10000__", "3_", "7", "Bad", "No", "!@9#%8", "22 Years and 1 Months",
         "Auto Loan, Home Loan, and Payday Loan"),
        ("F2", "34847.84_", "1.5", "20", "x", "Standard", "Yes", "Low_spent_Small", "1 Year", None),
        ("F3", "", "2", "967", "4", "Good", "NM", "High_spent_Large", "NA", "Auto Loan"),
        ("F4", None, None, None, None, "_", "other", None, None, ""),
    ]
    out = {r["Customer_ID"]: r for r in fm.silver_financials(_fin(spark, rows)).collect()}
    assert out["F1"]["Annual_Income"] == 34847.84 and out["F2"]["Annual_Income"] == 34847.84  # D3 fixed
    assert out["F3"]["Annual_Income"] is None
    assert out["F1"]["Amount_invested_monthly"] == 10000.0
    assert (out["F1"]["Num_of_Loan"], out["F1"]["Num_of_Loan_Overcap_Flag"]) == (3, 0)
    assert (out["F2"]["Num_of_Loan"], out["F2"]["Num_of_Loan_Overcap_Flag"]) == (20, 0)
    assert (out["F3"]["Num_of_Loan"], out["F3"]["Num_of_Loan_Overcap_Flag"]) == (20, 1)
    assert (out["F4"]["Num_of_Loan"], out["F4"]["Num_of_Loan_Overcap_Flag"]) == (None, 0)
    assert [out[k]["Credit_Mix"] for k in ("F1", "F2", "F3", "F4")] == [0, 1, 2, None]
    assert [out[k]["Payment_of_Min_Amount"] for k in ("F1", "F2", "F3", "F4")] == [0, 1, None, None]
    assert out["F1"]["Payment_Behaviour"] is None
    assert [out[k]["Credit_History_in_Months"] for k in ("F1", "F2", "F3", "F4")] == [265, 12, 0, 0]  # D4 fixed
    assert abs(out["F1"]["Debt_to_income"] - 100.0 / (34847.84 + 1)) < 1e-12


def test_gold_features_encodings_and_joins(spark):
    loans = spark.createDataFrame([("L1", "F1", SNAP), ("L2", "F2", SNAP), ("L3", "ZZ", SNAP)],
                                  "loan_id string, Customer_ID string, snapshot_date string") \
        .selectExpr("loan_id", "Customer_ID", "CAST(snapshot_date AS DATE) AS snapshot_date")
    attrs = spark.createDataFrame([("F1", "n", "s", "30", "Media-Manager X", SNAP), ("F2", "n", "s", "40", "", SNAP)],
                                  "Customer_ID string, Name string, SSN string, Age string, Occupation string, "
                                  "snapshot_date string")
    attrs = fm.silver_attributes(attrs)
    rows = [("F1", "1", "1", "1", "1", "Bad", "No", "Low_spent_Small", "1 Year",
             "Auto Loan, Home Loan, and Payday Loan"),
            ("F2", "1", "1", "1", "1", "Bad", "No", "High-spent Large", "1 Year", None)]
    fin = fm.silver_financials(_fin(spark, rows))
    click = spark.createDataFrame([("F1", SNAP, 1), ("F1", SNAP, 2)], "Customer_ID string, snapshot_date string, fe_1 int")
    click = click.selectExpr("Customer_ID", "CAST(snapshot_date AS DATE) AS snapshot_date", "fe_1")
    gold = fm.gold_features(loans, attrs, fin, click)
    out = {r["loan_id"]: r.asDict() for r in gold.collect()}
    assert gold.count() == 3  # clickstream duplicates do not fan out (D15)
    assert out["L1"]["Occupation_media_manager_x"] == 1
    assert "Occupation_" not in gold.columns  # empty string gets no column (D14)
    assert out["L1"]["loan_type_and_payday_loan"] == 1  # D13 kept by default
    assert out["L2"]["loan_type_auto_loan"] == 0
    assert out["L2"]["payment_behaviour_high_spent_large"] == 1
    assert out["L1"]["Has_Valid_Age"] == 1
    assert out["L3"]["Has_Valid_Age"] is None  # no attributes row for ZZ
    assert out["L1"]["fe_1"] == 1


def test_feature_mart_layers(spark, tmp_root, local_tmp):
    """Bronze -> silver -> gold from CSV extracts over a window; same columns for every snapshot (D12)."""
    import os

    def csv(name, header, rows):
        p = os.path.join(local_tmp, f"{name}.csv")
        with open(p, "w") as f:
            f.write(",".join(header) + "\n")
            for r in rows:
                f.write(",".join("" if v is None else str(v) for v in r) + "\n")
        return p

    attrs = csv("attributes", ["Customer_ID", "Name", "Age", "SSN", "Occupation", "snapshot_date"],
                [("C1", "n", "30", "s", "Teacher", "2023-01-01"), ("C2", "n", "40_", "s", "Lawyer", "2023-02-01"),
                 ("C3", "n", "50", "s", "Doctor", "2022-12-01")])
    fin_cols = fm.RAW_SCHEMAS["financials"].fieldNames()
    def fin_row(cid, snap, beh, types):
        vals = {c: None for c in fin_cols}
        vals.update({"Customer_ID": cid, "snapshot_date": snap, "Payment_Behaviour": beh, "Annual_Income": "1000.5_",
                     "Num_of_Loan": "3", "Outstanding_Debt": "10", "Credit_History_Age": "1 Year"})
        vals["Type_of_Loan"] = f'"{types}"'
        return tuple(vals[c] for c in fin_cols)
    fins = csv("financials", fin_cols, [fin_row("C1", "2023-01-01", "Low", "Auto Loan, Home Loan"),
                                        fin_row("C2", "2023-02-01", "High", "Home Loan")])
    clicks = csv("clickstream", [f"fe_{i}" for i in range(1, 21)] + ["Customer_ID", "snapshot_date"],
                 [tuple(range(1, 21)) + ("C1", "2023-01-01")])
    root = tmp_root
    fm.bronze(spark, {"attributes": attrs, "financials": fins, "clickstream": clicks}, f"{root}/bronze",
              "2023-01-01", "2023-12-01")
    fm.silver(spark, f"{root}/bronze", f"{root}/silver")
    loans = spark.createDataFrame([("L1", "C1", "2023-01-01"), ("L2", "C2", "2023-02-01")],
                                  "loan_id string, Customer_ID string, snapshot_date string") \
        .withColumn("snapshot_date", F.to_date("snapshot_date"))
    from sparkmart.sources.writers import write_snapshots
    write_snapshots(loans, f"{root}/loans")
    fm.gold(spark, f"{root}/silver", f"{root}/loans", f"{root}/gold")
    gold = spark.read.parquet(f"{root}/gold")
    rows = {r["loan_id"]: r for r in gold.collect()}
    assert set(rows) == {"L1", "L2"}
    assert rows["L2"]["Occupation_lawyer"] == 1 and rows["L1"]["Occupation_lawyer"] == 0
    assert rows["L1"]["loan_type_auto_loan"] == 1 and rows["L2"]["loan_type_auto_loan"] == 0
    assert rows["L1"]["payment_behaviour_low"] == 1 and rows["L1"]["fe_20"] == 20
    assert rows["L2"]["Age"] == 40 and rows["L2"]["Annual_Income"] == 1000.5
    assert "Occupation_doctor" not in gold.columns  # outside the window

    # a second window with other categories keeps the columns of the first, and both read as one schema
    second = {"attributes": [("C4", "n", "20", "s", "Doctor", "2024-01-01")], "financials": [fin_row("C4", "2024-01-01", "Mid", "Student Loan")],
              "clickstream": [tuple(range(1, 21)) + ("C4", "2024-01-01")]}
    headers = {"attributes": ["Customer_ID", "Name", "Age", "SSN", "Occupation", "snapshot_date"], "financials": fin_cols,
               "clickstream": [f"fe_{i}" for i in range(1, 21)] + ["Customer_ID", "snapshot_date"]}
    fm.bronze(spark, {n: csv(n + "2", headers[n], rows) for n, rows in second.items()}, f"{root}/bronze")
    fm.silver(spark, f"{root}/bronze", f"{root}/silver", "2024-01-01", "2024-01-01")
    more = spark.createDataFrame([("L4", "C4", "2024-01-01"), ("L5", "none", "2024-01-01")],
                                 "loan_id string, Customer_ID string, snapshot_date string")
    write_snapshots(more.withColumn("snapshot_date", F.to_date("snapshot_date")), f"{root}/loans")
    fm.gold(spark, f"{root}/silver", f"{root}/loans", f"{root}/gold", "2024-01-01", "2024-01-01")
    both = fm.read_gold(spark, f"{root}/gold")
    rows = {r["loan_id"]: r for r in both.collect()}
    assert set(rows) == {"L1", "L2", "L4", "L5"}
    assert rows["L4"]["Occupation_doctor"] == 1 and rows["L4"]["Occupation_lawyer"] == 0
    assert rows["L1"]["Occupation_doctor"] == 0 and rows["L1"]["loan_type_student_loan"] == 0
    assert rows["L5"]["Occupation_doctor"] is None  # no attributes row
    assert set(gold.columns) <= set(both.columns)
