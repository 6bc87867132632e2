"""Lending feeds derived from the driver's tables, once for Spark and once as SQL text.

Both definitions use the same arithmetic. Amounts become text through integers, because
engines print doubles differently. Dirty values follow the catalogue in FIXTURES.md.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.arrears import add_arrears
from riskloom.operators.cleaning import clean_attributes, clean_clickstream, clean_financials


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def month_of(c: str) -> Column:
    return F.trunc(F.col(c).cast("date"), "MM")


# --- Spark side ----------------------------------------------------------------------------


def ledger(spark: SparkSession, sf: str) -> DataFrame:
    items, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    q, price = F.col("l_quantity"), F.col("l_extendedprice")
    due = F.when(q == 50, F.lit(0.0)).when(q != 49, F.try_divide(price, q))
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").cast("string").alias("loan_id"),
        F.col("o_custkey").cast("string").alias("Customer_ID"),
        F.col("o_orderdate").cast("date").alias("loan_start_date"),
        F.lit(7).alias("tenure"),
        F.col("l_linenumber").alias("installment_num"),
        F.col("o_totalprice").alias("loan_amt"),
        due.alias("due_amt"),
        (price * (1 - F.col("l_discount"))).alias("paid_amt"),
        F.when(F.col("l_returnflag") == "R", price * F.col("l_discount")).otherwise(0.0).alias("overdue_amt"),
        (F.col("o_totalprice") - price).alias("balance"),
        month_of("l_shipdate").alias("snapshot_date"),
    )


def silver_ledger(spark: SparkSession, sf: str) -> DataFrame:
    return add_arrears(ledger(spark, sf))


def ledger_text(spark: SparkSession, sf: str) -> DataFrame:
    """Raw text rows of the ledger feed with a few unparsable fields."""
    items, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    line = F.col("l_linenumber")
    money = _money(cents, 100, 2)
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").cast("string").alias("loan_id"),
        F.col("o_custkey").cast("string").alias("Customer_ID"),
        F.when(line == 6, "not a date")
        .otherwise(F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM-dd"))
        .alias("loan_start_date"),
        F.when(line == 5, "7.0").when(line == 4, "").otherwise("7").alias("tenure"),
        F.concat(line.cast("string"), F.when(line == 7, "x").otherwise("")).alias("installment_num"),
        money.alias("loan_amt"),
        F.when(line == 3, "1.2.3").otherwise(money).alias("due_amt"),
        money.alias("paid_amt"),
        F.when(line == 2, F.concat(F.lit("-"), money)).otherwise(money).alias("overdue_amt"),
        F.when(line == 1, F.lit(None)).otherwise(money).alias("balance"),
        F.date_format(month_of("l_shipdate"), "yyyy-MM-dd").alias("snapshot_date"),
    )


def clicks(spark: SparkSession, sf: str) -> DataFrame:
    counted = table(spark, sf, "orders").groupBy(
        F.col("o_custkey").alias("k"), month_of("o_orderdate").alias("snapshot_date")
    ).agg(
        F.count("*").cast("int").alias("n"),
        F.floor(F.sum(F.col("o_totalprice").cast("decimal(18,2)"))).cast("int").alias("spent"),
    )
    return counted.select(
        F.col("k").cast("string").alias("Customer_ID"),
        F.col("n").alias("fe_1"),
        (F.col("spent") - 100000).alias("fe_2"),
        *[(F.col("n") * i - 5).alias(f"fe_{i}") for i in range(3, 21)],
        "snapshot_date",
    )


def clicks_text(spark: SparkSession, sf: str) -> DataFrame:
    typed = clicks(spark, sf)
    text = {f"fe_{i}": F.col(f"fe_{i}").cast("string") for i in range(1, 21)}
    dirty = F.col("Customer_ID").cast("bigint") % 11 == 0
    text["fe_3"] = F.concat(text["fe_3"], F.when(dirty, "x").otherwise(""))
    text["snapshot_date"] = F.date_format("snapshot_date", "yyyy-MM-dd")
    return typed.withColumns(text)


def silver_clicks(spark: SparkSession, sf: str) -> DataFrame:
    return clean_clickstream(clicks(spark, sf))


def clicks_daily(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "events")
        .groupBy(F.col("user_id").cast("string").alias("Customer_ID"), F.col("ts").cast("date").alias("snapshot_date"))
        .agg(F.count("*").cast("int").alias("fe_1"))
    )


def attrs_text(spark: SparkSession, sf: str) -> DataFrame:
    k, name = F.col("c_custkey"), F.col("c_name")
    age = (F.lit(20) + k % 90).cast("string")
    ssn = F.concat_ws("-", _digits(k, 3), _digits(k, 2), _digits(k, 4))
    return table(spark, sf, "customer").select(
        k.cast("string").alias("Customer_ID"),
        F.when(k % 23 == 0, F.lit(None))
        .when(k % 7 == 0, F.concat(F.lit('"'), name, F.lit(" ")))
        .when(k % 7 == 1, F.replace(name, F.lit("#"), F.lit(" O'Neil-")))
        .when(k % 7 == 2, F.col("c_mktsegment"))
        .otherwise(name)
        .alias("Name"),
        F.when(k % 25 == 2, "")
        .when(k % 5 == 0, F.concat(age, F.lit("_")))
        .when(k % 5 == 1, F.concat(F.lit("-"), age))
        .otherwise(age)
        .alias("Age"),
        F.when(k % 17 == 0, "#F%$D@*&8")
        .when(k % 19 == 0, F.concat(ssn, F.lit("0")))
        .otherwise(ssn)
        .alias("SSN"),
        F.when(k % 13 == 0, "_______")
        .when(k % 13 == 1, "Media_Manager")
        .otherwise(F.col("c_mktsegment"))
        .alias("Occupation"),
        _feature_month(k).alias("snapshot_date"),
    )


def attrs(spark: SparkSession, sf: str) -> DataFrame:
    return clean_attributes(attrs_text(spark, sf))


def fins_text(spark: SparkSession, sf: str) -> DataFrame:
    spent = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k")).agg(
        F.count("*").alias("n"), F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("c")
    )
    rows = table(spark, sf, "customer").join(spent, F.col("c_custkey") == F.col("k"), "left")
    rows = rows.select(
        F.col("c_custkey").alias("k"), "c_mktsegment", F.coalesce("n", F.lit(0)).alias("n"),
        F.coalesce("c", F.lit(0)).alias("c"),
    )
    k, n, c = F.col("k"), F.col("n"), F.col("c")
    text = lambda x: x.cast("string")
    level = lambda size, names: F.get(F.array(*map(F.lit, names)), (k % size).cast("int"))
    behaviours = [
        "Low_spent_Small_value_payments", "Low_spent_Medium_value_payments",
        "Low_spent_Large_value_payments", "High_spent_Small_value_payments",
        "High_spent_Medium_value_payments", "High_spent_Large_value_payments", "!@9#%8",
    ]
    months = F.concat(text(k % 30), F.lit(" Years and "), text(k % 12), F.lit(" Months"))
    return rows.select(
        text(k).alias("Customer_ID"),
        F.concat(_money(c, 100, 2), F.when(k % 9 == 0, "_").otherwise("")).alias("Annual_Income"),
        F.when(k % 29 != 0, _fraction(c, 1200, c % 1000, 3)).alias("Monthly_Inhand_Salary"),
        F.concat(text(k % 14), F.when(k % 6 == 0, "_").otherwise("")).alias("Num_Bank_Accounts"),
        text(n % 13).alias("Num_Credit_Card"),
        F.when(k % 50 == 0, "99999999999").otherwise(text(k % 40 + 1)).alias("Interest_Rate"),
        F.when(k % 20 == 0, "-100").when(k % 20 == 1, "1496").when(k % 20 == 2, "_")
        .otherwise(F.concat(text(k % 9), F.when(k % 4 == 0, "_").otherwise("")))
        .alias("Num_of_Loan"),
        F.when(k % 5 != 0, F.col("c_mktsegment")).alias("Type_of_Loan"),
        F.when(k % 10 == 0, F.concat(F.lit("-"), text(k % 7))).otherwise(text(k % 60)).alias("Delay_from_due_date"),
        F.when(k % 33 == 0, "").otherwise(F.concat(text(k % 50), F.when(k % 3 == 0, "_").otherwise("")))
        .alias("Num_of_Delayed_Payment"),
        F.when(k % 15 == 0, "_")
        .otherwise(F.concat(F.when(k % 11 == 0, "-").otherwise(""), text(k % 30), F.lit("."), _digits(k, 2)))
        .alias("Changed_Credit_Limit"),
        text(k % 40).alias("Num_Credit_Inquiries"),
        level(4, ["Bad", "Standard", "Good", "_"]).alias("Credit_Mix"),
        F.concat(F.when(k % 8 == 0, "-").otherwise(""), _fraction(c, 700, 2 * (k % 5000), 4)).alias("Outstanding_Debt"),
        F.concat(text(k % 30 + 20), F.lit("."), _digits(k * 37, 5)).alias("Credit_Utilization_Ratio"),
        F.when(k % 16 == 0, "NA").when(k % 45 == 0, F.concat(months, F.lit(" x")))
        .when(k % 46 == 0, F.concat(F.lit("x "), months)).when(k % 47 != 0, months)
        .alias("Credit_History_Age"),
        level(3, ["Yes", "No", "NM"]).alias("Payment_of_Min_Amount"),
        _fraction(c, 9000, k % 1000, 3).alias("Total_EMI_per_month"),
        F.when(k % 21 == 0, "__10000__").otherwise(_fraction(c, 5000, k % 100, 2)).alias("Amount_invested_monthly"),
        level(7, behaviours).alias("Payment_Behaviour"),
        F.when(k % 31 == 0, "__-333333333333333333333333333__").when(k % 37 == 0, "_")
        .when(k % 41 == 0, "1.2.3").otherwise(_fraction(c, 8000, k % 100, 2))
        .alias("Monthly_Balance"),
        _feature_month(k).alias("snapshot_date"),
    )


def fins(spark: SparkSession, sf: str) -> DataFrame:
    return clean_financials(fins_text(spark, sf))


def scores(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions of all months: one row per order."""
    return table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("Customer_ID"),
        month_of("o_orderdate").alias("snapshot_date"),
        F.lit("credit_model_1996_01_01").alias("model_name"),
        (F.col("o_totalprice") / 500000).alias("model_predictions"),
    )


def score_baseline(spark: SparkSession, sf: str) -> DataFrame:
    """Baseline predictions: the first year of data."""
    rows = scores(spark, sf).where(F.col("snapshot_date") < F.lit("1996-01-01").cast("date"))
    return rows.withColumnRenamed("model_predictions", "prediction")


def order_features(spark: SparkSession, sf: str) -> DataFrame:
    """Mixed-type features with nulls, for feature drift."""
    orders = table(spark, sf, "orders")
    key = F.col("o_orderkey")
    return orders.select(
        F.col("o_custkey").cast("string").alias("Customer_ID"),
        month_of("o_orderdate").alias("snapshot_date"),
        F.when(key % 19 != 0, F.col("o_totalprice")).alias("amount"),
        (F.col("o_custkey") % 37).cast("int").alias("tier"),
        F.when(key % 23 != 0, F.col("o_orderpriority")).alias("priority"),
        F.concat(F.lit("B"), (F.col("o_custkey") % 70).cast("string")).alias("branch"),
    )


def monitored(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly scoring inputs and scores; ``util_rate`` grows with the years."""
    orders = table(spark, sf, "orders")
    years = F.year(F.col("o_orderdate").cast("date")) - 1995
    score = F.col("o_totalprice") / 500000
    return orders.select(
        F.col("o_custkey").cast("string").alias("Customer_ID"),
        month_of("o_orderdate").alias("snapshot_date"),
        score.alias("score"),
        (score * ((years + 20) / 20)).alias("util_rate"),
        (F.col("o_custkey") % 60 + 20).cast("int").alias("age"),
        F.col("o_orderpriority").alias("priority"),
    )


def monitored_baseline(spark: SparkSession, sf: str) -> DataFrame:
    return monitored(spark, sf).where(F.col("snapshot_date") < F.lit("1996-01-01").cast("date"))


def labels_silver(spark: SparkSession, sf: str, dpd: int = 30, mob: int = 3) -> DataFrame:
    from riskloom.operators.arrears import label_store

    return label_store(silver_ledger(spark, sf), dpd, mob)


def registry_view(spark: SparkSession, sf: str) -> DataFrame:
    """One model version per order year."""
    year = F.year(F.col("o_orderdate").cast("date"))
    return (
        table(spark, sf, "orders").groupBy(year.alias("y")).agg(F.count("*").alias("row_count"))
        .select(F.concat(F.lit("credit_model_"), F.col("y").cast("string"), F.lit("_01_01")).alias("model_version"),
                "y", "row_count")
    )


def baselines_view(spark: SparkSession, sf: str) -> DataFrame:
    """Baselines exist for the even years."""
    return registry_view(spark, sf).where("y % 2 = 0").select(
        "model_version", F.concat("model_version", F.lit("_psi_ref_preds")).alias("baseline")
    )


def activations_view(spark: SparkSession, sf: str) -> DataFrame:
    """Activation events of the odd years and of one version that does not exist."""
    events = registry_view(spark, sf).where("y % 2 = 1").select(
        "model_version", F.make_date("y", F.lit(2), F.lit(1)).alias("activated_at")
    )
    ghost = events.agg(F.max("activated_at")).select(
        F.lit("credit_model_2099_01_01").alias("model_version"),
        F.date_add("max(activated_at)", 400).alias("activated_at"),
    )
    return events.unionByName(ghost)


def _digits(k: Column, width: int) -> Column:
    return F.lpad((k % 10**width).cast("string"), width, "0")


def _fraction(c: Column, divisor: int, decimals: Column, width: int) -> Column:
    whole = F.floor(c / divisor).cast("bigint").cast("string")
    return F.concat(whole, F.lit("."), F.lpad(decimals.cast("string"), width, "0"))


def _money(c: Column, divisor: int, width: int) -> Column:
    return _fraction(c, divisor, c % divisor, width)


def _feature_month(k: Column) -> Column:
    return F.add_months(F.lit("1995-01-01").cast("date"), (k % 72).cast("int"))


# --- SQL side ------------------------------------------------------------------------------

_MONEY = "CAST({c} // 100 AS VARCHAR) || '.' || lpad(CAST({c} % 100 AS VARCHAR), 2, '0')"
_ITEM_MONEY = _MONEY.format(c="CAST(ROUND(l_extendedprice * 100) AS BIGINT)")
_FEATURE_MONTH = "CAST(DATE '1995-01-01' + to_months(CAST({k} % 72 AS INTEGER)) AS DATE)"
_MONTHS = "CAST(k % 30 AS VARCHAR) || ' Years and ' || CAST(k % 12 AS VARCHAR) || ' Months'"
_SSN = (
    "lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || '-' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0')"
    " || '-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0')"
)
_CLICK_FEATURES = ", ".join(f"n * {i} - 5 AS fe_{i}" for i in range(3, 21))
_CLEAN_CLICKS = ", ".join(f"CASE WHEN fe_{i} < 0 THEN 0 ELSE fe_{i} END AS fe_{i}" for i in range(1, 21))


def _currency(c: str) -> str:
    return f"ROUND(TRY_CAST(regexp_replace({c}, '[^0-9.]', '', 'g') AS DOUBLE), 3) AS {c}"


def _integer(c: str, cap: int | None = None) -> str:
    number = f"TRY_CAST(regexp_replace({c}, '[^0-9]', '', 'g') AS INTEGER)"
    if cap is not None:
        number = f"CASE WHEN {number} > {cap} THEN {cap} ELSE {number} END"
    return f"{number} AS {c}"


def _float(c: str) -> str:
    return f"TRY_CAST(regexp_replace({c}, '[^0-9.]', '', 'g') AS DOUBLE) AS {c}"


VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "ledger": (
        (),
        """
SELECT CAST(l_orderkey AS VARCHAR) AS loan_id, CAST(o_custkey AS VARCHAR) AS "Customer_ID",
  CAST(o_orderdate AS DATE) AS loan_start_date, 7 AS tenure, l_linenumber AS installment_num,
  o_totalprice AS loan_amt,
  CASE WHEN l_quantity = 50 THEN 0 WHEN l_quantity <> 49 THEN l_extendedprice / NULLIF(l_quantity, 0) END AS due_amt,
  l_extendedprice * (1 - l_discount) AS paid_amt,
  CASE WHEN l_returnflag = 'R' THEN l_extendedprice * l_discount ELSE 0 END AS overdue_amt,
  o_totalprice - l_extendedprice AS balance,
  CAST(date_trunc('month', l_shipdate) AS DATE) AS snapshot_date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    ),
    "silver_ledger": (
        ("ledger",),
        """
SELECT d.*, CAST(CASE WHEN overdue_amt > 0 THEN datediff('day', first_missed_date, snapshot_date) ELSE 0 END AS INTEGER) AS dpd
FROM (
  SELECT m.*, CASE WHEN installments_missed > 0
    THEN CAST(snapshot_date - to_months(installments_missed) AS DATE) END AS first_missed_date
  FROM (
    SELECT loan_id, "Customer_ID", loan_start_date, tenure, installment_num, loan_amt,
      COALESCE(due_amt, 0) AS due_amt, paid_amt, overdue_amt, balance, snapshot_date,
      installment_num AS mob,
      COALESCE(CAST(ceil(overdue_amt / NULLIF(due_amt, 0)) AS INTEGER), 0) AS installments_missed
    FROM ledger) AS m) AS d""",
    ),
    "ledger_text": (
        (),
        f"""
SELECT CAST(l_orderkey AS VARCHAR) AS loan_id, CAST(o_custkey AS VARCHAR) AS "Customer_ID",
  CASE WHEN l_linenumber = 6 THEN 'not a date' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS loan_start_date,
  CASE WHEN l_linenumber = 5 THEN '7.0' WHEN l_linenumber = 4 THEN '' ELSE '7' END AS tenure,
  CAST(l_linenumber AS VARCHAR) || CASE WHEN l_linenumber = 7 THEN 'x' ELSE '' END AS installment_num,
  {_ITEM_MONEY} AS loan_amt,
  CASE WHEN l_linenumber = 3 THEN '1.2.3' ELSE {_ITEM_MONEY} END AS due_amt,
  {_ITEM_MONEY} AS paid_amt,
  CASE WHEN l_linenumber = 2 THEN '-' ELSE '' END || {_ITEM_MONEY} AS overdue_amt,
  CASE WHEN l_linenumber <> 1 THEN {_ITEM_MONEY} END AS balance,
  strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') AS snapshot_date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    ),
    "clicks": (
        (),
        f"""
SELECT CAST(k AS VARCHAR) AS "Customer_ID", n AS fe_1, spent - 100000 AS fe_2, {_CLICK_FEATURES}, snapshot_date
FROM (SELECT o_custkey AS k, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date,
    CAST(count(*) AS INTEGER) AS n,
    CAST(floor(sum(CAST(o_totalprice AS DECIMAL(18,2)))) AS INTEGER) AS spent
  FROM orders GROUP BY 1, 2) AS o""",
    ),
    "silver_clicks": (
        ("clicks",),
        f"""SELECT "Customer_ID", {_CLEAN_CLICKS}, snapshot_date FROM clicks""",
    ),
    "clicks_daily": (
        (),
        """
SELECT CAST(user_id AS VARCHAR) AS "Customer_ID", CAST(ts AS DATE) AS snapshot_date,
  CAST(count(*) AS INTEGER) AS fe_1
FROM events GROUP BY 1, 2""",
    ),
    "attrs_text": (
        (),
        f"""
SELECT CAST(c_custkey AS VARCHAR) AS "Customer_ID",
  CASE WHEN c_custkey % 23 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN '"' || c_name || ' '
    WHEN c_custkey % 7 = 1 THEN replace(c_name, '#', ' O''Neil-')
    WHEN c_custkey % 7 = 2 THEN c_mktsegment ELSE c_name END AS "Name",
  CASE WHEN c_custkey % 25 = 2 THEN '' WHEN c_custkey % 5 = 0 THEN CAST(20 + c_custkey % 90 AS VARCHAR) || '_'
    WHEN c_custkey % 5 = 1 THEN '-' || CAST(20 + c_custkey % 90 AS VARCHAR)
    ELSE CAST(20 + c_custkey % 90 AS VARCHAR) END AS "Age",
  CASE WHEN c_custkey % 17 = 0 THEN '#F%$D@*&8' WHEN c_custkey % 19 = 0 THEN {_SSN} || '0' ELSE {_SSN} END AS "SSN",
  CASE WHEN c_custkey % 13 = 0 THEN '_______' WHEN c_custkey % 13 = 1 THEN 'Media_Manager'
    ELSE c_mktsegment END AS "Occupation",
  {_FEATURE_MONTH.format(k="c_custkey")} AS snapshot_date
FROM customer""",
    ),
    "attrs": (
        ("attrs_text",),
        """
SELECT "Customer_ID", trim(regexp_replace("Name", '[^A-Za-z .''-]', '', 'g')) AS "Name",
  CASE WHEN TRY_CAST(regexp_replace("Age", '[^0-9]', '', 'g') AS INTEGER) BETWEEN 0 AND 100
    THEN TRY_CAST(regexp_replace("Age", '[^0-9]', '', 'g') AS INTEGER) END AS "Age",
  CASE WHEN regexp_matches("SSN", '^[0-9]{3}-[0-9]{2}-[0-9]{4}$') THEN "SSN" END AS "SSN",
  CASE "Occupation" WHEN '_______' THEN NULL WHEN 'Media_Manager' THEN 'Media Manager' ELSE "Occupation" END AS "Occupation",
  snapshot_date
FROM attrs_text""",
    ),
    "fins_text": (
        (),
        f"""
SELECT CAST(k AS VARCHAR) AS "Customer_ID",
  CAST(c // 100 AS VARCHAR) || '.' || lpad(CAST(c % 100 AS VARCHAR), 2, '0') || CASE WHEN k % 9 = 0 THEN '_' ELSE '' END AS "Annual_Income",
  CASE WHEN k % 29 <> 0 THEN CAST(c // 1200 AS VARCHAR) || '.' || lpad(CAST(c % 1000 AS VARCHAR), 3, '0') END AS "Monthly_Inhand_Salary",
  CAST(k % 14 AS VARCHAR) || CASE WHEN k % 6 = 0 THEN '_' ELSE '' END AS "Num_Bank_Accounts",
  CAST(n % 13 AS VARCHAR) AS "Num_Credit_Card",
  CASE WHEN k % 50 = 0 THEN '99999999999' ELSE CAST(k % 40 + 1 AS VARCHAR) END AS "Interest_Rate",
  CASE WHEN k % 20 = 0 THEN '-100' WHEN k % 20 = 1 THEN '1496' WHEN k % 20 = 2 THEN '_'
    ELSE CAST(k % 9 AS VARCHAR) || CASE WHEN k % 4 = 0 THEN '_' ELSE '' END END AS "Num_of_Loan",
  CASE WHEN k % 5 <> 0 THEN c_mktsegment END AS "Type_of_Loan",
  CASE WHEN k % 10 = 0 THEN '-' || CAST(k % 7 AS VARCHAR) ELSE CAST(k % 60 AS VARCHAR) END AS "Delay_from_due_date",
  CASE WHEN k % 33 = 0 THEN '' ELSE CAST(k % 50 AS VARCHAR) || CASE WHEN k % 3 = 0 THEN '_' ELSE '' END END AS "Num_of_Delayed_Payment",
  CASE WHEN k % 15 = 0 THEN '_' ELSE CASE WHEN k % 11 = 0 THEN '-' ELSE '' END || CAST(k % 30 AS VARCHAR) || '.'
    || lpad(CAST(k % 100 AS VARCHAR), 2, '0') END AS "Changed_Credit_Limit",
  CAST(k % 40 AS VARCHAR) AS "Num_Credit_Inquiries",
  CASE k % 4 WHEN 0 THEN 'Bad' WHEN 1 THEN 'Standard' WHEN 2 THEN 'Good' ELSE '_' END AS "Credit_Mix",
  CASE WHEN k % 8 = 0 THEN '-' ELSE '' END || CAST(c // 700 AS VARCHAR) || '.' || lpad(CAST(2 * (k % 5000) AS VARCHAR), 4, '0') AS "Outstanding_Debt",
  CAST(k % 30 + 20 AS VARCHAR) || '.' || lpad(CAST((k * 37) % 100000 AS VARCHAR), 5, '0') AS "Credit_Utilization_Ratio",
  CASE WHEN k % 16 = 0 THEN 'NA' WHEN k % 45 = 0 THEN {_MONTHS} || ' x' WHEN k % 46 = 0 THEN 'x ' || {_MONTHS}
    WHEN k % 47 <> 0 THEN {_MONTHS} END AS "Credit_History_Age",
  CASE k % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'NM' END AS "Payment_of_Min_Amount",
  CAST(c // 9000 AS VARCHAR) || '.' || lpad(CAST(k % 1000 AS VARCHAR), 3, '0') AS "Total_EMI_per_month",
  CASE WHEN k % 21 = 0 THEN '__10000__' ELSE CAST(c // 5000 AS VARCHAR) || '.' || lpad(CAST(k % 100 AS VARCHAR), 2, '0') END AS "Amount_invested_monthly",
  CASE k % 7 WHEN 0 THEN 'Low_spent_Small_value_payments' WHEN 1 THEN 'Low_spent_Medium_value_payments'
    WHEN 2 THEN 'Low_spent_Large_value_payments' WHEN 3 THEN 'High_spent_Small_value_payments'
    WHEN 4 THEN 'High_spent_Medium_value_payments' WHEN 5 THEN 'High_spent_Large_value_payments'
    ELSE '!@9#%8' END AS "Payment_Behaviour",
  CASE WHEN k % 31 = 0 THEN '__-333333333333333333333333333__' WHEN k % 37 = 0 THEN '_' WHEN k % 41 = 0 THEN '1.2.3'
    ELSE CAST(c // 8000 AS VARCHAR) || '.' || lpad(CAST(k % 100 AS VARCHAR), 2, '0') END AS "Monthly_Balance",
  {_FEATURE_MONTH.format(k="k")} AS snapshot_date
FROM (SELECT c_custkey AS k, c_mktsegment, COALESCE(n, 0) AS n, COALESCE(c, 0) AS c
  FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n,
      CAST(sum(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS c
    FROM orders GROUP BY o_custkey) AS o ON c_custkey = o_custkey) AS s""",
    ),
    "fins_typed": (
        ("fins_text",),
        f"""
SELECT "Customer_ID", {_currency("Annual_Income")}, {_currency("Monthly_Inhand_Salary")},
  {_integer("Num_Bank_Accounts", 10)}, {_integer("Num_Credit_Card", 10)}, {_integer("Interest_Rate", 34)},
  {_integer("Num_of_Loan", 9)}, "Type_of_Loan", {_integer("Delay_from_due_date")},
  {_integer("Num_of_Delayed_Payment", 47)}, {_float("Changed_Credit_Limit")}, {_integer("Num_Credit_Inquiries", 26)},
  CASE "Credit_Mix" WHEN 'Bad' THEN 0 WHEN 'Standard' THEN 1 WHEN 'Good' THEN 2 END AS "Credit_Mix",
  {_currency("Outstanding_Debt")}, {_float("Credit_Utilization_Ratio")},
  CASE WHEN regexp_matches("Credit_History_Age", '^[0-9]+ Years and [0-9]+ Months')
    THEN TRY_CAST(regexp_extract("Credit_History_Age", '^([0-9]+) Years', 1) AS INTEGER) * 12
      + TRY_CAST(regexp_extract("Credit_History_Age", 'and ([0-9]+) Months', 1) AS INTEGER) END AS "Credit_History_Age",
  CASE "Payment_of_Min_Amount" WHEN 'Yes' THEN true WHEN 'No' THEN false END AS "Payment_of_Min_Amount",
  {_currency("Total_EMI_per_month")}, {_currency("Amount_invested_monthly")},
  CASE "Payment_Behaviour" WHEN 'Low_spent_Small_value_payments' THEN 0 WHEN 'Low_spent_Medium_value_payments' THEN 1
    WHEN 'Low_spent_Large_value_payments' THEN 2 WHEN 'High_spent_Small_value_payments' THEN 3
    WHEN 'High_spent_Medium_value_payments' THEN 4 WHEN 'High_spent_Large_value_payments' THEN 5 END AS "Payment_Behaviour",
  {_currency("Monthly_Balance")}, snapshot_date
FROM fins_text""",
    ),
    "fins": (
        ("fins_typed",),
        """
SELECT *, "Num_Bank_Accounts" + "Num_Credit_Card" + "Num_of_Loan" AS "Num_Fin_Pdts",
  CAST("Num_of_Loan" AS DOUBLE) / ("Num_Bank_Accounts" + "Num_Credit_Card" + 1) AS "Loans_per_Credit_Item",
  "Outstanding_Debt" / ("Monthly_Inhand_Salary" + 1) AS "Debt_to_Salary",
  "Total_EMI_per_month" / ("Monthly_Inhand_Salary" + 1) AS "EMI_to_Salary",
  "Monthly_Inhand_Salary" - "Total_EMI_per_month" AS "Repayment_Ability",
  "Delay_from_due_date" * "Num_of_Loan" AS "Loan_Extent"
FROM fins_typed""",
    ),
    "scores": (
        (),
        """
SELECT CAST(o_custkey AS VARCHAR) AS "Customer_ID", CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date,
  'credit_model_1996_01_01' AS model_name, o_totalprice / 500000 AS model_predictions
FROM orders""",
    ),
    "score_baseline": (
        ("scores",),
        """
SELECT "Customer_ID", snapshot_date, model_name, model_predictions AS prediction
FROM scores WHERE snapshot_date < DATE '1996-01-01'""",
    ),
    "order_features": (
        (),
        """
SELECT CAST(o_custkey AS VARCHAR) AS "Customer_ID", CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date,
  CASE WHEN o_orderkey % 19 <> 0 THEN o_totalprice END AS amount, CAST(o_custkey % 37 AS INTEGER) AS tier,
  CASE WHEN o_orderkey % 23 <> 0 THEN o_orderpriority END AS priority,
  'B' || CAST(o_custkey % 70 AS VARCHAR) AS branch
FROM orders""",
    ),
    "monitored": (
        (),
        """
SELECT CAST(o_custkey AS VARCHAR) AS "Customer_ID", CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date,
  o_totalprice / 500000 AS score, (o_totalprice / 500000) * ((year(o_orderdate) - 1995 + 20) / 20) AS util_rate,
  CAST(o_custkey % 60 + 20 AS INTEGER) AS age, o_orderpriority AS priority
FROM orders""",
    ),
    "label_rows": (
        ("silver_ledger",),
        """
SELECT loan_id, "Customer_ID", CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label, '30dpd_3mob' AS label_def, snapshot_date
FROM silver_ledger WHERE mob = 3""",
    ),
    "registry": (
        (),
        """
SELECT 'credit_model_' || CAST(year(o_orderdate) AS VARCHAR) || '_01_01' AS model_version,
  CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS row_count
FROM orders GROUP BY 1, 2""",
    ),
    "baselines": (
        ("registry",),
        "SELECT model_version, model_version || '_psi_ref_preds' AS baseline FROM registry WHERE y % 2 = 0",
    ),
    "activations": (
        ("registry",),
        """
SELECT model_version, make_date(y, 2, 1) AS activated_at FROM registry WHERE y % 2 = 1
UNION ALL
SELECT 'credit_model_2099_01_01', CAST(max(make_date(y, 2, 1)) + 400 AS DATE) FROM registry WHERE y % 2 = 1""",
    ),
}


def with_views(body: str, names: Sequence[str]) -> str:
    """``body`` with the named views and everything they need as common table expressions."""
    needed: list[str] = []

    def visit(name: str) -> None:
        for parent in VIEWS[name][0]:
            visit(parent)
        if name not in needed:
            needed.append(name)

    for name in names:
        visit(name)
    if not needed:
        return body
    parts = ",\n".join(f"{name} AS ({VIEWS[name][1].strip()})" for name in needed)
    for head in ("WITH RECURSIVE ", "WITH "):
        if body.startswith(head):
            return f"{head}{parts},\n{body[len(head):]}"
    return f"WITH {parts}\n{body}"
