"""Credit roles played by the star-schema test tables.

Every function reads whole tables. Money is whole cents, so its sums are exact in any order.
Days and months are negative offsets from AS_OF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2002-01-01"
EVENTS_AS_OF = "2024-02-01"
HALF = "2024-01-16"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(column: str) -> Column:
    return F.expr(f"floor({column} * 100 + 0.5D)")


def cent_share(column: str, percent: str) -> Column:
    """Percent (SQL text, a whole number) of the cents of a column, rounded half up."""
    return F.expr(f"(floor({column} * 100 + 0.5D) * ({percent}) + 50) div 100")


def percent_of(column: str) -> str:
    return f"floor({column} * 100 + 0.5D)"


def _days(x: Column, as_of: str = AS_OF) -> Column:
    return F.datediff(x, F.to_date(F.lit(as_of)))


def _months(x: Column) -> Column:
    return (F.year(x) - 2002) * 12 + F.month(x) - 1


def previous_application(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    s, k, price = F.col("o_orderstatus"), F.col("o_orderpriority"), cents("o_totalprice")
    return o.select(
        F.col("o_orderkey").alias("SK_ID_PREV"),
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.when(s == "O", "Approved").when(s == "F", "Refused").otherwise("Canceled").alias("NAME_CONTRACT_STATUS"),
        F.when(k.isin("1-URGENT", "2-HIGH"), "Cash loans").when(k == "3-MEDIUM", "Consumer loans")
        .otherwise("Revolving loans").alias("NAME_CONTRACT_TYPE"),
        price.alias("AMT_APPLICATION"),
        F.when(s == "P", 0).otherwise(price).alias("AMT_CREDIT"),
        F.when(s != "F", cent_share("o_totalprice", "8")).alias("AMT_ANNUITY"),
        _days(F.col("o_orderdate")).alias("DAYS_DECISION"),
    )


def bureau(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as external credits: most applicants have none."""
    e = table(spark, sf_dir, "events")
    kind, value = F.col("event_type"), cents("value")
    part = lambda percent: cent_share("value", percent)
    active = kind.isin("purchase", "signup")
    day = _days(F.col("ts"), EVENTS_AS_OF)
    return e.select(
        F.col("user_id").alias("SK_ID_CURR"),
        F.col("event_id").alias("SK_ID_BUREAU"),
        F.when(active, "Active").when(kind == "error", "Bad debt").otherwise("Closed").alias("CREDIT_ACTIVE"),
        kind.alias("CREDIT_TYPE"),
        value.alias("AMT_CREDIT_SUM"),
        F.when(active, part("40")).when(kind != "error", F.lit(0)).alias("AMT_CREDIT_SUM_DEBT"),
        F.when(kind == "error", part("10")).otherwise(F.lit(0)).alias("AMT_CREDIT_SUM_OVERDUE"),
        F.when(kind == "purchase", part("5")).alias("AMT_ANNUITY"),
        (day * 40).alias("DAYS_CREDIT"),
        F.when(active, day * 40 + 365).alias("DAYS_CREDIT_ENDDATE"),
        day.alias("DAYS_CREDIT_UPDATE"),
        F.when(kind == "error", F.floor("value").cast("int")).otherwise(0).alias("CREDIT_DAY_OVERDUE"),
    )


def bureau_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem")
    f, s = F.col("l_returnflag"), F.col("l_linestatus")
    status = (
        F.when((s == "F") & (f == "R"), F.least("l_linenumber", F.lit(5)).cast("string"))
        .when((s == "F") & (f == "A"), "C").when((s == "F") & (f == "N"), "X").otherwise("0")
    )
    return l.select(
        F.col("l_orderkey").alias("SK_ID_BUREAU"), _months(F.col("l_shipdate")).alias("MONTHS_BALANCE"),
        status.alias("STATUS"),
    )


def installments(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem")
    unpaid = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O")
    due, price = _days(F.col("l_shipdate")), cents("l_extendedprice")
    paid = cent_share("l_extendedprice", f"100 - {percent_of('l_discount')}")
    return l.select(
        F.col("l_orderkey").alias("SK_ID_PREV"),
        due.alias("DAYS_INSTALMENT"),
        F.when(~unpaid, due + F.col("l_quantity").cast("int") - 25).alias("DAYS_ENTRY_PAYMENT"),
        price.alias("AMT_INSTALMENT"),
        F.when(~unpaid, paid).alias("AMT_PAYMENT"),
    )


def pos_cash(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem")
    q = F.col("l_quantity").cast("int")
    return l.select(
        F.col("l_orderkey").alias("SK_ID_PREV"),
        _months(F.col("l_shipdate")).alias("MONTHS_BALANCE"),
        F.when(F.col("l_linestatus") == "F", "Completed").otherwise("Active").alias("NAME_CONTRACT_STATUS"),
        F.greatest(q - 40, F.lit(0)).alias("SK_DPD"),
        F.greatest(q - 45, F.lit(0)).alias("SK_DPD_DEF"),
        F.col("l_linenumber").cast("double").alias("CNT_INSTALMENT_FUTURE"),
    )


def credit_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem")
    q, price = F.col("l_quantity").cast("int"), cents("l_extendedprice")
    share = lambda percent: cent_share("l_extendedprice", percent)
    return l.select(
        F.col("l_orderkey").alias("SK_ID_PREV"),
        _months(F.col("l_shipdate")).alias("MONTHS_BALANCE"),
        price.alias("AMT_BALANCE"),
        F.when(F.col("l_returnflag") != "R", q * 1000).otherwise(0).alias("AMT_CREDIT_LIMIT_ACTUAL"),
        share(percent_of("l_discount")).alias("AMT_DRAWINGS_CURRENT"),
        F.col("l_linenumber").alias("CNT_DRAWINGS_CURRENT"),
        share(percent_of("l_tax")).alias("AMT_PAYMENT_CURRENT"),
        share("4").alias("AMT_INST_MIN_REGULARITY"),
        F.greatest(q - 42, F.lit(0)).alias("SK_DPD"),
    )


def application(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One applicant per customer: the target is a negative balance, features come from the order history."""
    o = table(spark, sf_dir, "orders")
    s, k, price, day = F.col("o_orderstatus"), F.col("o_orderpriority"), cents("o_totalprice"), _days(F.col("o_orderdate"))
    urgent = k == "1-URGENT"
    n = F.count(F.lit(1))

    def mean_if(p: Column) -> Column:
        x = F.when(p, price)
        return F.when(F.count(x) > 0, F.sum(x).cast("double") / F.count(x) / 50000000.0)

    per = o.groupBy("o_custkey").agg(
        (F.sum(price).cast("double") / 100).alias("AMT_INCOME_TOTAL"),
        (F.max(price).cast("double") / 100).alias("AMT_CREDIT"),
        (F.min(price).cast("double") / 100).alias("AMT_ANNUITY"),
        (F.max(F.when(s == "F", price)).cast("double") / 100).alias("AMT_GOODS_PRICE"),
        F.nullif(F.count_if(urgent), F.lit(0)).alias("CNT_FAM_MEMBERS"),
        (F.min(day) * 6 - 6570).alias("DAYS_BIRTH"),
        F.coalesce(F.max(F.when(urgent, day)), F.lit(365243)).alias("DAYS_EMPLOYED"),
        F.min(day).alias("DAYS_REGISTRATION"),
        F.max(day).alias("DAYS_ID_PUBLISH"),
        F.max(F.when(s == "P", day)).alias("DAYS_LAST_PHONE_CHANGE"),
        mean_if(urgent).alias("EXT_SOURCE_1"),
        mean_if(s == "F").alias("EXT_SOURCE_2"),
        mean_if(s == "P").alias("EXT_SOURCE_3"),
        F.when(F.count_if(urgent) > 0, 1).otherwise(0).alias("FLAG_DOCUMENT_2"),
        F.when(F.count_if(k == "2-HIGH") > 0, 1).otherwise(0).alias("FLAG_DOCUMENT_3"),
        F.when(F.count_if(k == "5-LOW") > 0, 1).otherwise(0).alias("FLAG_DOCUMENT_4"),
        F.when(n > 10, 1).otherwise(0).alias("REG_REGION_NOT_LIVE_REGION"),
        F.when(F.count_if(s == "P") > F.count_if(s == "F"), 1).otherwise(0).alias("REG_CITY_NOT_WORK_CITY"),
        F.count_if(day >= -365).alias("AMT_REQ_CREDIT_BUREAU_YEAR"),
        F.nullif(F.count_if(day >= -200), F.lit(0)).alias("AMT_REQ_CREDIT_BUREAU_MON"),
        F.max(F.when(urgent, s)).alias("OCCUPATION_TYPE"),
    )
    c = table(spark, sf_dir, "customer")
    # nations and regions are fixed lists of 25 and 5 rows
    nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"))
    region = F.broadcast(table(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    base = c.join(nation, c["c_nationkey"] == nation["n_nationkey"]).join(
        region, nation["n_regionkey"] == region["r_regionkey"]
    ).select(
        F.col("c_custkey").alias("SK_ID_CURR"),
        F.when(F.col("c_acctbal") < 0, 1).otherwise(0).alias("TARGET"),
        F.col("c_mktsegment").alias("NAME_INCOME_TYPE"),
        F.col("n_name").alias("NAME_HOUSING_TYPE"),
        F.col("r_name").alias("NAME_EDUCATION_TYPE"),
        F.when(F.col("c_nationkey") < 12, "M").otherwise("F").alias("CODE_GENDER"),
    )
    return base.join(per, base["SK_ID_CURR"] == per["o_custkey"], "left").drop("o_custkey")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as scored accounts: an outcome, three model scores in (0, 1), exposure and segments."""
    l = table(spark, sf_dir, "lineitem")
    sat = lambda x, half: x / (x + F.lit(half))
    year = F.year("l_shipdate")
    return l.select(
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("TARGET"),
        sat(F.col("l_extendedprice"), 50000.0).alias("PRED_CHAMPION"),
        sat(F.col("l_quantity"), 25.0).alias("PRED_XGB"),
        sat(F.col("l_tax"), 0.04).alias("PRED_LGB"),
        F.col("l_extendedprice").alias("EAD"),
        F.col("l_linestatus").alias("CODE_GENDER"),
        F.when(year < 1997, "early").when(year < 2000, "middle").otherwise("late").alias("AGE_BAND"),
        F.when(F.col("l_linenumber") > 1, F.col("l_linenumber").cast("string")).alias("INCOME_BAND"),
    )


SCORES = {"champion": "PRED_CHAMPION", "xgb": "PRED_XGB", "lgb": "PRED_LGB"}
SEGMENTS = ["CODE_GENDER", "AGE_BAND", "INCOME_BAND"]


def event_halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Drift pair: events before and after the middle of the month."""
    e = table(spark, sf_dir, "events").select(
        "ts", "value", F.col("user_id").alias("user"), F.hour("ts").alias("hour"), F.length("props").alias("props_len"),
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("spend"),
    )
    cut = F.to_timestamp_ntz(F.lit(f"{HALF} 00:00:00"))
    return e.where(F.col("ts") < cut).drop("ts"), e.where(F.col("ts") >= cut).drop("ts")


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests_of(table(spark, sf_dir, "orders"))


def requests_of(o: DataFrame) -> DataFrame:
    """Orders as scoring requests, with values that break every kind of rule."""
    price, day = F.col("o_totalprice"), _days(F.col("o_orderdate"))
    s = F.col("o_orderstatus")
    part = lambda share, kind="decimal(12,2)": (
        (price.cast("decimal(8,2)") * F.lit(share).cast("decimal(8,7)")).cast(kind).cast("string")
    )
    return o.select(
        F.col("o_orderkey").alias("request_id"),
        F.floor(-day / 25).cast("int").cast("string").alias("age"),
        F.when(price > 20000, price - 20000.0).otherwise(-price).cast("decimal(12,2)").cast("string").alias("income"),
        price.cast("decimal(12,2)").cast("string").alias("loan_amount"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", part("0.0625"))
        .otherwise(F.when(day > -1000, "unknown")).alias("annuity"),
        F.when(s != "O", part("0.75")).alias("goods_price"),
        F.when(s == "O", "Higher education").when(s == "F", "Lower secondary").alias("education_type"),
        F.when(s == "P", part("0.0000025", "decimal(8,4)")).alias("ext_source_2"),
        F.floor(-day / 500).cast("int").cast("string").alias("bureau_loan_count"),
        F.floor(-day / 900).cast("int").cast("string").alias("active_credits"),
        part("0.125").alias("total_debt"),
    )


ACCOUNT_FEATURES = ["price", "quantity", "discount", "tax"]
ACCOUNT_CATEGORIES = ["status", "line"]


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as labelled rows with numeric and text features, NULLs among both."""
    l = table(spark, sf_dir, "lineitem")
    return l.select(
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("TARGET"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("quantity"),
        F.nullif("l_discount", F.lit(0.0)).alias("discount"), F.col("l_tax").alias("tax"),
        F.col("l_linestatus").alias("status"),
        F.when(F.col("l_linenumber") > 1, F.col("l_linenumber").cast("string")).alias("line"),
    )


APPLICANT_NUMERIC = [
    "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "CNT_FAM_MEMBERS", "DAYS_BIRTH",
    "DAYS_ID_PUBLISH", "DAYS_LAST_PHONE_CHANGE", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3",
    "AMT_REQ_CREDIT_BUREAU_YEAR",
]
APPLICANT_TEXT = ["NAME_INCOME_TYPE", "NAME_HOUSING_TYPE", "NAME_EDUCATION_TYPE", "CODE_GENDER", "OCCUPATION_TYPE"]
