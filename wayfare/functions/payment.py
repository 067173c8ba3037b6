"""Credit and cash flags over numeric codes and over JSON payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Payment codes and their spellings in text.
CREDIT = (1, "credit")
CASH = (2, "cash")


def code_is(column: str, payment: tuple[int, str]) -> str:
    return f"coalesce({column} = {payment[0]}, false)"


def variant_is(payload: str, payment: tuple[int, str]) -> str:
    """True for the whole number of a payment or for its word in any case.

    The number as text ("1") and a fractional literal (2.0) match neither.
    """
    code, text = payment
    return f"""CASE schema_of_variant({payload})
        WHEN 'BIGINT' THEN try_variant_get({payload}, '$', 'bigint') = {code}
        WHEN 'STRING' THEN lower(try_variant_get({payload}, '$', 'string')) = '{text}'
        ELSE false END"""


def with_payment_flags(trips: DataFrame) -> DataFrame:
    """Add ``is_credit`` and ``is_cash`` unless the source already set them."""
    if {"is_credit", "is_cash"} <= set(trips.columns):
        return trips
    return trips.selectExpr(
        "*",
        f"{code_is('payment_type', CREDIT)} AS is_credit",
        f"{code_is('payment_type', CASH)} AS is_cash",
    )
