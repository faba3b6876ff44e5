"""Explicit schemas of the relational inputs (columns the plans name; others are read as they come)."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType()}


def _schema(text: str) -> T.StructType:
    fields = []
    for part in text.split(","):
        name, kind = part.split()
        fields.append(T.StructField(name, _TYPES[kind], True))
    return T.StructType(fields)


# Column names and types of the child tables.
TABLES: dict[str, T.StructType] = {
    "bureau": _schema(
        "SK_ID_CURR long, SK_ID_BUREAU long, CREDIT_ACTIVE string, CREDIT_TYPE string, AMT_CREDIT_SUM double,"
        "AMT_CREDIT_SUM_DEBT double, AMT_CREDIT_SUM_OVERDUE double, AMT_ANNUITY double, DAYS_CREDIT int,"
        "DAYS_CREDIT_ENDDATE double, DAYS_CREDIT_UPDATE int, CREDIT_DAY_OVERDUE int"
    ),
    "bureau_balance": _schema("SK_ID_BUREAU long, MONTHS_BALANCE int, STATUS string"),
    "previous_application": _schema(
        "SK_ID_PREV long, SK_ID_CURR long, NAME_CONTRACT_TYPE string, NAME_CONTRACT_STATUS string,"
        "AMT_APPLICATION double, AMT_CREDIT double, AMT_ANNUITY double, DAYS_DECISION int"
    ),
    "installments_payments": _schema(
        "SK_ID_PREV long, DAYS_INSTALMENT double, DAYS_ENTRY_PAYMENT double, AMT_INSTALMENT double, AMT_PAYMENT double"
    ),
    "POS_CASH_balance": _schema(
        "SK_ID_PREV long, MONTHS_BALANCE int, CNT_INSTALMENT_FUTURE double, NAME_CONTRACT_STATUS string, SK_DPD int,"
        "SK_DPD_DEF int"
    ),
    "credit_card_balance": _schema(
        "SK_ID_PREV long, MONTHS_BALANCE int, AMT_BALANCE double, AMT_CREDIT_LIMIT_ACTUAL double,"
        "AMT_DRAWINGS_CURRENT double, CNT_DRAWINGS_CURRENT double, AMT_PAYMENT_CURRENT double,"
        "AMT_INST_MIN_REGULARITY double, SK_DPD int"
    ),
}
BASE_TABLE = "application_train"
SKIPPED_FILES = ("HomeCredit_columns_description", "sample_submission")
