"""Raw tables to the applicant feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import encoding, features, history
from ..sources import buckets, readers, writers
from ..sources.schemas import BASE_TABLE


def history_aggregates(
    bureau: DataFrame | None = None, bureau_balance: DataFrame | None = None,
    previous_application: DataFrame | None = None, installments_payments: DataFrame | None = None,
    pos_cash_balance: DataFrame | None = None, credit_card_balance: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The history aggregates whose inputs are given."""
    out = {}
    if bureau is not None:
        out["bureau"] = history.bureau_history(bureau)
        if bureau_balance is not None:
            out["bb"] = history.bureau_balance_history(bureau_balance, bureau)
    loans = previous_application
    if loans is not None:
        below = history.loan_rows(loans, credit_card_balance, installments_payments, pos_cash_balance)
        if below is not None:
            out |= history.loan_tables(below)
        out["prev"] = history.previous_application_history(loans)
    return out


def feature_table(base: DataFrame, aggregates: dict[str, DataFrame]) -> DataFrame:
    """Merged and finished features."""
    return finished_features(history.merge_features(base, aggregates))


BUCKETS = 200  # of a store; every table of a store has the same number


def store_histories(
    base: DataFrame, store: str, bureau: DataFrame | None = None, bureau_balance: DataFrame | None = None,
    previous_application: DataFrame | None = None, installments_payments: DataFrame | None = None,
    pos_cash_balance: DataFrame | None = None, credit_card_balance: DataFrame | None = None, count: int = BUCKETS,
) -> None:
    """Tables dealt by applicant: base, credits and loans as they are, the tables below them reduced to a row per applicant or month.

    A loan with any number of payments adds to a row here, so a bucket grows with applicants, not with their history.
    """
    frames = {"base": base, "bureau": bureau, "prev": previous_application}
    if bureau is not None and bureau_balance is not None:
        frames["accounts"] = history.account_rows(bureau_balance, bureau)
    if previous_application is not None:
        frames["loans"] = history.loan_rows(previous_application, credit_card_balance, installments_payments, pos_cash_balance)
    buckets.write_store({k: v for k, v in frames.items() if v is not None}, store, history.APPLICANT, count)


def merge_stored(spark: SparkSession, store: str) -> DataFrame:
    """The merged features of a store: every grouping and join is by the key the tables are dealt by."""
    made = {
        "bureau": lambda df: {"bureau": history.bureau_history(df)}, "accounts": lambda df: {"bb": history.account_history(df)},
        "loans": history.loan_tables, "prev": lambda df: {"prev": history.previous_application_history(df)},
    }
    tables = buckets.open_store(spark, store)
    return history.merge_features(tables["base"], {name: x for k, f in made.items() if k in tables for name, x in f(tables[k]).items()})


def finished_features(merged: DataFrame) -> DataFrame:
    """Derive, flag and impute, encode, cross, then keep numbers only; the order matters."""
    df = features.derived_features(merged)
    df = features.impute_median(features.missing_flags(df))
    df = encoding.frequency_encode(df, features.string_columns(df))
    df = features.cross_table_features(df)
    return features.numeric_only(df)


_CHILDREN = ("bureau", "bureau_balance", "previous_application", "installments_payments", "pos_cash_balance", "credit_card_balance")


def build_features(spark: SparkSession, raw_dir: str, out_path: str, fmt: str = "parquet", store: str | None = None) -> DataFrame:
    """Folder of raw tables to the stored feature table; with ``store`` by way of tables dealt by applicant, which are kept."""
    tables = {k.lower(): v for k, v in readers.load_views(spark, raw_dir).items()}
    children = {name: tables[name] for name in _CHILDREN if name in tables}
    if store:
        store_histories(tables[BASE_TABLE], store, **children)
        df = finished_features(merge_stored(spark, store))
    else:
        df = feature_table(tables[BASE_TABLE], history_aggregates(**children))
    writers.write_table(df, out_path, fmt)
    return df
