"""Scoring requests: fixed-vocabulary features and predictions with an interval."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import columns as fx

# Request fields and what stands for a missing one.
REQUEST_DEFAULTS = {
    "amt_billed": 0.0,
    "amt_deduct": 0.0,
    "amt_coins": 0.0,
    "age": 45,
    "gender_code": 0,
    "client_los": 0.0,
    "form_type": "P",
    "sv_stat": "P",
    "product_type": "PPO",
    "icd_category": "Z",
}

# Numeric features and the request field each one comes from.
NUMERIC_FEATURES = {
    "AMT_BILLED": "amt_billed",
    "AMT_DEDUCT": "amt_deduct",
    "AMT_COINS": "amt_coins",
    "Age": "age",
    "Gender_Code": "gender_code",
    "CLIENT_LOS": "client_los",
}

# Dummy features, request field and vocabulary.
DUMMY_FEATURES = {
    "FORM_TYPE": ("form_type", ["I", "O", "P"]),
    "SV_STAT": ("sv_stat", ["D", "P", "R"]),
    "PRODUCT_TYPE": ("product_type", ["HMO", "POS", "PPO"]),
    "ICD_Category": ("icd_category", ["E", "F", "I", "J", "K", "M", "Z"]),
}

# Assumed relative standard error and normal 95 % quantile of the interval.
RELATIVE_ERROR = "0.15"
NORMAL_95 = "1.96"


def _field(df: DataFrame, name: str) -> Column:
    default = F.lit(REQUEST_DEFAULTS[name])
    return F.coalesce(fx.quoted(name), default) if name in df.columns else default


def score_features(df: DataFrame, feature_names: Sequence[str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """The 23 request features, or the named ones in their order with 0 for unknown names."""
    features = {name: _field(df, source).cast("double") for name, source in NUMERIC_FEATURES.items()}
    features["AMT_BILLED_log"] = F.log1p(features["AMT_BILLED"])
    for name, (source, values) in DUMMY_FEATURES.items():
        for value in values:
            features[f"{name}_{value}"] = (_field(df, source) == value).cast("int")
    names = list(feature_names or features)
    return df.select(*[fx.quoted(c) for c in keep], *[features.get(n, F.lit(0)).alias(n) for n in names])


def with_interval(df: DataFrame, prediction: str = "prediction", model_version: str = "unknown") -> DataFrame:
    """Add predicted_amount, confidence_interval and model_version, rounded to cents.

    Amounts are computed as decimals, so that rounding does not depend on binary fractions.
    """
    raw = fx.quoted(prediction).cast("decimal(20,6)")
    amount = F.greatest(F.lit(0).cast("decimal(20,6)"), raw)
    amount = F.when(raw.isNotNull(), amount)
    spread = amount * F.lit(NORMAL_95).cast("decimal(3,2)") * F.lit(RELATIVE_ERROR).cast("decimal(3,2)")
    low = F.greatest(F.lit(0).cast("decimal(30,10)"), (amount - spread).cast("decimal(30,10)"))
    low = F.when(raw.isNotNull(), low)
    return df.withColumns(
        {
            "predicted_amount": amount.cast("decimal(18,2)"),
            "confidence_interval": F.struct(
                low.cast("decimal(18,2)").alias("lower"), (amount + spread).cast("decimal(18,2)").alias("upper")
            ),
            "model_version": F.lit(model_version),
        }
    )


def score_batch(model, df: DataFrame, keep: Sequence[str] = (), model_version: str = "unknown") -> DataFrame:
    """Requests in, predictions out. The model's own feature list decides the columns."""
    extra = [f"__keep_{i}" for i in range(len(keep))]
    kept = df.withColumns({e: fx.quoted(c) for e, c in zip(extra, keep)}) if keep else df
    features = score_features(kept, model.feature_names, extra)
    scored = with_interval(model.transform(features), "prediction", model_version)
    return scored.select(
        *[F.col(e).alias(c) for e, c in zip(extra, keep)], "predicted_amount", "confidence_interval", "model_version"
    )
