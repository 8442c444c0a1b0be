"""The composite claim workflows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions import columns as fx
from ..operators.clean import (
    code_category,
    count_non_null,
    drop_columns,
    drop_high_missing,
    drop_missing_rows,
    encode_age,
    encode_gender,
    fill_missing,
    filter_non_negative,
    merge_categories,
)
from ..operators.features import FeatureState, fit_vocabulary, one_hot_transform
from ..operators.scale import fit_scalers, transform_scalers
from .claims_view import AMOUNTS

# Columns dropped before encoding.
FIRST_DROPS = [
    "FROM_YEAR", "ADM_YR", "DIS_YR", "SERVICES_KEY", "SV_LINE", "MEMBER_STATE", "INSURANCE_TYPE", "CPT_MOD1", "CPT_MOD2",
    "ICD_10_OR_HIGHER", "QTY", "AMT_COPAY", "AMT_PREPAID", "INPATIENT_FLAG", "UTILS", "CLAIM_STATUS_ORIG", "ADMIT_HOUR",
    "DISCHARGE_HOUR", "CLAIM_ADJUSTMENT_LOGIC", "IMPUTED_SERVICE_KEY",
]

# Columns dropped after encoding.
FINAL_DROPS = [
    "CLAIM_ID_KEY", "MEMBER_COUNTY", "SERV_PROV_CW_KEY", "MR_LINE_CASE_KEY", "Proc_Code_letters", "COVERAGE_CLASS", "LOB", "POS",
    "BILL_PROV_CW_KEY", "CS_CLAIM_ID_KEY", "ICD_DIAG_02",
]

# Model columns.
DUMMY_COLUMNS = ["FORM_TYPE", "SV_STAT", "PRODUCT_TYPE", "ICD_Category"]
TARGET = "AMT_PAID"


def clean_claims(
    df: DataFrame,
    missing_threshold: int | None = None,
    first_drops: Sequence[str] = FIRST_DROPS,
    final_drops: Sequence[str] = FINAL_DROPS,
) -> DataFrame:
    """Raw claim lines to model-ready rows.

    Only the null counts need a pass of their own; the rest is one projection and one filter.
    """
    primary = "ICD_DIAG_01_PRIMARY_categories"
    df = count_non_null(df)
    df, _ = drop_high_missing(df, missing_threshold, keep_columns=["CLIENT_LOS"])
    return (
        df.transform(drop_columns, first_drops)
        .transform(encode_gender)
        .transform(encode_age)
        .transform(code_category, "PROC_CODE", "Proc_Code_letters")
        .transform(code_category, "ICD_DIAG_01_PRIMARY", primary)
        .transform(fill_missing, {"CLIENT_LOS": 0})
        .transform(drop_columns, final_drops)
        .transform(merge_categories, primary)
        .transform(filter_non_negative, AMOUNTS)
        .transform(drop_missing_rows)
    )


def feature_rows(df: DataFrame) -> DataFrame:
    """Cleaned and encoded rows, still with categories: the row-wise half of ``feature_notebook``."""
    return (
        df.transform(fill_missing, {"CLIENT_LOS": 0})
        .transform(filter_non_negative, AMOUNTS)
        .transform(drop_missing_rows)
        .transform(encode_gender)
        .transform(encode_age)
        .transform(code_category, "ICD_DIAG_01_PRIMARY", "ICD_Category")
        .transform(drop_columns, ["CLAIM_ID_KEY"])
    )


def feature_notebook(df: DataFrame, target: str = TARGET) -> tuple[DataFrame, FeatureState]:
    """Clean, encode, dummies, log of the billed amount, z-scores; the target is kept as it is.

    Dummies stay 0/1; every other numeric column but the target is scaled.
    """
    rows = feature_rows(df)
    vocabulary = fit_vocabulary(rows, DUMMY_COLUMNS)
    plain = [c for c in rows.columns if c not in vocabulary]
    wide = one_hot_transform(rows, vocabulary)
    if "AMT_BILLED" in wide.columns:
        wide = wide.withColumn("AMT_BILLED_log", fx.log1p_clipped(fx.quoted("AMT_BILLED")))
        plain.append("AMT_BILLED_log")
    numeric = [c for c in fx.numeric_columns(wide.select(*[fx.quoted(c) for c in plain])) if c != target]
    scalers = fit_scalers(wide, numeric, "zscore")
    out = transform_scalers(wide, scalers) if scalers else wide
    names = [c for c in out.columns if c != target]
    state = FeatureState(scalers, vocabulary, names)
    return out.select(*[fx.quoted(c) for c in names], *([fx.quoted(target)] if target in out.columns else [])), state


def etl_min_clean(df: DataFrame) -> DataFrame:
    """The minimal load rule: paid and billed present and not negative."""
    return df.dropna(subset=["AMT_PAID", "AMT_BILLED"]).filter("AMT_PAID >= 0 AND AMT_BILLED >= 0")
