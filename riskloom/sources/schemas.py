"""Schemas of the four feeds and of the monitoring stores. Raw feeds are read as text."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and silver types of the feeds, in file order.
LEDGER = {
    "loan_id": "string",
    "Customer_ID": "string",
    "loan_start_date": "date",
    "tenure": "int",
    "installment_num": "int",
    "loan_amt": "double",
    "due_amt": "double",
    "paid_amt": "double",
    "overdue_amt": "double",
    "balance": "double",
    "snapshot_date": "date",
}
CLICK_COLUMNS = [f"fe_{i}" for i in range(1, 21)]
CLICKSTREAM = {**dict.fromkeys(CLICK_COLUMNS, "int"), "Customer_ID": "string", "snapshot_date": "date"}
ATTRIBUTES = {
    "Customer_ID": "string",
    "Name": "string",
    "Age": "int",
    "SSN": "string",
    "Occupation": "string",
    "snapshot_date": "date",
}
FINANCIALS = {
    "Customer_ID": "string",
    "Annual_Income": "double",
    "Monthly_Inhand_Salary": "double",
    "Num_Bank_Accounts": "int",
    "Num_Credit_Card": "int",
    "Interest_Rate": "int",
    "Num_of_Loan": "int",
    "Type_of_Loan": "string",
    "Delay_from_due_date": "int",
    "Num_of_Delayed_Payment": "int",
    "Changed_Credit_Limit": "double",
    "Num_Credit_Inquiries": "int",
    "Credit_Mix": "int",
    "Outstanding_Debt": "double",
    "Credit_Utilization_Ratio": "double",
    "Credit_History_Age": "int",
    "Payment_of_Min_Amount": "boolean",
    "Total_EMI_per_month": "double",
    "Amount_invested_monthly": "double",
    "Payment_Behaviour": "int",
    "Monthly_Balance": "double",
    "snapshot_date": "date",
}
FEEDS = {
    "ledger": LEDGER,
    "clickstream": CLICKSTREAM,
    "attributes": ATTRIBUTES,
    "financials": FINANCIALS,
}

PSI_PAYLOAD = T.StructType(
    [
        T.StructField("month", T.StringType()),
        T.StructField("overall", T.DoubleType()),
        T.StructField("psi", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("status", T.StringType()),
    ]
)

BASELINE_DOCUMENT = (
    "numeric map<string, struct<edges: array<double>, p_ref: array<double>>>, "
    "categorical map<string, struct<p_ref: map<string, double>>>"
)


def raw_schema(feed: str) -> T.StructType:
    """All-text schema of a feed: dirty values are parsed later, never inferred."""
    return T.StructType([T.StructField(c, T.StringType()) for c in FEEDS[feed]])
