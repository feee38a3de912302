"""Behaviour profiles, model features and the feature pipelines."""

from __future__ import annotations

from pyspark.ml.feature import (
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardrisk.operators.sampling import user_split
from cardrisk.operators.sizing import MAX_BROADCAST_ROWS, fits_broadcast, left_join_dim, narrow_rows

# ---- fixed values: model inputs and request defaults ---------------------------------------
CATEGORICAL = ["use_chip", "merchant_state", "device_os", "error_type"]
NUMERIC = [
    "amount_abs", "amount_log", "is_refund", "hour", "day", "minute", "month", "mcc",
    "error_flag", "vpn_flag", "geo_missing", "hw_missing", "device_merchant_distance_km",
    "is_online", "is_foreign_or_unknown", "is_night", "user_amount_mean", "user_amount_std",
    "user_txn_count", "amount_vs_user_mean", "amount_zscore", "mcc_frequency", "day_of_week",
    "is_weekend", "day_of_year", "amount_capped", "is_outlier", "imputed_city",
    "imputed_state", "imputed_zip",
]
PROFILE_FEATURES = [
    "user_amount_mean", "user_amount_std", "user_txn_count", "amount_vs_user_mean",
    "amount_zscore", "mcc_frequency",
]
MAX_LABELS = 1_000
REQUEST_DEFAULTS = {
    "hour": 12, "day": 15, "month": 6, "minute": 0, "mcc": 5411, "merchant_state": "CA",
    "use_chip": "Chip Transaction", "device_os": "Android", "error_type": "NONE",
    "vpn_flag": 0, "is_online": 0, "device_merchant_distance_km": 5.0,
}
# --------------------------------------------------------------------------------------------


def user_stats(df: DataFrame, fit_on: str = "all") -> DataFrame:
    """Mean, sample deviation and count of each user's amounts; no per-row window."""
    rows = user_split(df)[0] if fit_on == "train" else df
    return rows.groupBy("user").agg(
        F.avg("amount_abs").alias("user_amount_mean"),
        F.coalesce(F.stddev_samp("amount_abs"), F.lit(0.0)).alias("user_amount_std"),
        F.count(F.lit(1)).alias("user_txn_count"),
    )


def mcc_frequency(df: DataFrame, fit_on: str = "all") -> DataFrame:
    rows = user_split(df)[0] if fit_on == "train" else df
    return rows.groupBy("mcc").agg(F.count(F.lit(1)).alias("mcc_frequency"))


def join_profiles(df: DataFrame, users: DataFrame, mccs: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Left joins to both profiles. Hand in materialised profiles: their size is checked.

    Profiles are four numbers a key at most, so some millions of keys are broadcast before the rows,
    ten times as wide, have to be shuffled.
    """
    for dim, key, weight in ((users, "user", "user_txn_count"), (mccs, "mcc", "mcc_frequency")):
        df = left_join_dim(df, dim, key, weight=weight, max_rows=narrow_rows(dim) if max_rows is None else max_rows, narrow=True)
    return df


def join_profiles_stream(stream: DataFrame, users: DataFrame, mccs: DataFrame) -> DataFrame:
    """Stream-static form: a micro-batch is small, so only the static side's size matters."""
    for dim, key in ((users, "user"), (mccs, "mcc")):
        stream = stream.join(F.broadcast(dim) if fits_broadcast(dim) else dim, key, "left")
    return stream


def prune_profile(profile: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The profile's rows for some keys. The keys are what is sent around; the profile stays where it is."""
    return profile.join(F.broadcast(keys), key, "left_semi")


def join_profiles_batch(
    batch: DataFrame, users: DataFrame, mccs: DataFrame, max_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Profiles joined to one micro-batch, which should be persisted; profiles should be written tables.

    A profile that is too large for a broadcast is cut down to the batch's own keys first, so
    it is scanned but not shuffled. A batch with more keys than that joins like any table.
    """
    for dim, key, weight in ((users, "user", "user_txn_count"), (mccs, "mcc", "mcc_frequency")):
        if not fits_broadcast(dim, max_rows):
            keys = batch.select(key).filter(F.col(key).isNotNull()).distinct()
            if not fits_broadcast(keys, MAX_BROADCAST_ROWS):
                batch = left_join_dim(batch, dim, key, weight=weight, max_rows=max_rows, narrow=True)
                continue
            dim = prune_profile(dim, keys, key)
        batch = batch.join(F.broadcast(dim), key, "left")
    return batch


def user_relative_features(df: DataFrame) -> DataFrame:
    """Amount against the user's own history; 0 where there is none."""
    mean, amount = F.col("user_amount_mean"), F.col("amount_abs")
    derived = df.withColumns(
        {
            "amount_vs_user_mean": amount / (mean + 1.0),
            "amount_zscore": (amount - mean) / (F.col("user_amount_std") + 1.0),
        }
    )
    return derived.fillna(0.0, subset=PROFILE_FEATURES)


def build_features(df: DataFrame, users: DataFrame, mccs: DataFrame) -> DataFrame:
    return user_relative_features(join_profiles(df, users, mccs))


def class_weighted(df: DataFrame, ratio: float, label: str = "is_fraud") -> DataFrame:
    weight = F.when(F.col(label) == 1, F.lit(float(ratio))).otherwise(F.lit(1.0))
    return df.withColumn("class_weight", weight)


def indexers(categorical: list[str] = CATEGORICAL) -> list[StringIndexer]:
    """One indexer for all columns, so that one pass counts all their labels."""
    outputs = [f"{c}_idx" for c in categorical]
    return [StringIndexer(inputCols=categorical, outputCols=outputs, handleInvalid="keep")]


def frequent_labels(train: DataFrame, column: str, most: int = MAX_LABELS) -> list[str]:
    """The ``most`` most frequent values of a column, ties by value; nulls are no label."""
    counted = train.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return [str(r[0]) for r in counted.orderBy(F.desc("n"), column).limit(most).collect()]


def bounded_indexers(
    train: DataFrame, categorical: list[str] = CATEGORICAL, most: int = MAX_LABELS
) -> list[StringIndexerModel]:
    """An index of each column's frequent labels; rarer, unseen and null ones share one more.

    The driver, the model and the bins of a tree hold at most ``most`` labels a column, however
    many values it has. Columns with fewer values are indexed as MLlib would.
    """
    return [
        StringIndexerModel.from_labels(
            frequent_labels(train, c, most), inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep"
        )
        for c in categorical
    ]


def tree_feature_names(numeric: list[str] = NUMERIC, categorical: list[str] = CATEGORICAL) -> list[str]:
    return numeric + [f"{c}_idx" for c in categorical]


def tree_stages(numeric: list[str] = NUMERIC, categorical: list[str] = CATEGORICAL) -> list:
    names = tree_feature_names(numeric, categorical)
    return [VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")]


def linear_stages(numeric: list[str] = NUMERIC, categorical: list[str] = CATEGORICAL) -> list:
    """One-hot and scaled by deviation only: centring would make the one-hot block dense."""
    encoder = OneHotEncoder(
        inputCols=[f"{c}_idx" for c in categorical],
        outputCols=[f"{c}_ohe" for c in categorical],
        handleInvalid="keep",
        dropLast=True,
    )
    assembler = VectorAssembler(
        inputCols=numeric + [f"{c}_ohe" for c in categorical],
        outputCol="features_raw",
        handleInvalid="keep",
    )
    scaler = StandardScaler(inputCol="features_raw", outputCol="features", withStd=True, withMean=False)
    return [encoder, assembler, scaler]


def request_features(requests: DataFrame) -> DataFrame:
    """Serving features of sparse scoring requests; only ``amount`` must be there."""
    if "amount" not in requests.columns:
        raise ValueError("scoring requests need an amount")
    defaults = {
        c: F.coalesce(F.col(c), F.lit(v)) if c in requests.columns else F.lit(v)
        for c, v in REQUEST_DEFAULTS.items()
    }
    filled = requests.withColumns(defaults)
    amount, hour, state = F.col("amount"), F.col("hour"), F.col("merchant_state")
    return filled.withColumns(
        {
            "amount_abs": F.abs(amount),
            "amount_log": F.log1p(F.abs(amount)),
            "is_refund": (amount < 0).cast("int"),
            "error_flag": (F.upper("error_type") != "NONE").cast("int"),
            "geo_missing": F.lit(0),
            "hw_missing": F.lit(0),
            "is_foreign_or_unknown": (F.length(F.trim(state)) != 2).cast("int"),
            "is_night": ((hour < 6) | (hour >= 22)).cast("int"),
            "merchant_state": F.upper(state),
        }
    )


def fill_missing_features(df: DataFrame, features: list[str], categorical: list[str] = CATEGORICAL) -> DataFrame:
    """Exactly the features a model expects: absent ones are UNKNOWN or 0."""

    def absent(name: str):
        return F.lit("UNKNOWN") if name in categorical else F.lit(0)

    kept = [c for c in df.columns if c not in features]
    return df.select(
        *kept, *[F.col(c) if c in df.columns else absent(c).alias(c) for c in features]
    )
