"""Location lookup, distance, outlier and channel features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardrisk.functions import cleaning as C
from cardrisk.operators.clean import clean_rows, to_silver, with_dates
from cardrisk.operators.sizing import left_join_dim
from cardrisk.schemas import PARTITION_COLUMNS
from cardrisk.session import materialise

# ---- fixed values: approximate centroid (latitude, longitude) of each state --------------
STATE_CENTROIDS = {
    "AL": (32.806671, -86.791130), "AK": (61.370716, -152.404419),
    "AZ": (33.729759, -111.431221), "AR": (34.969704, -92.373123),
    "CA": (36.116203, -119.681564), "CO": (39.059811, -105.311104),
    "CT": (41.597782, -72.755371), "DE": (39.318523, -75.507141),
    "DC": (38.897438, -77.026817), "FL": (27.766279, -81.686783),
    "GA": (33.040619, -83.643074), "HI": (21.094318, -157.498337),
    "ID": (44.240459, -114.478828), "IL": (40.349457, -88.986137),
    "IN": (39.849426, -86.258278), "IA": (42.011539, -93.210526),
    "KS": (38.526600, -96.726486), "KY": (37.668140, -84.670067),
    "LA": (31.169546, -91.867805), "ME": (44.693947, -69.381927),
    "MD": (39.063946, -76.802101), "MA": (42.230171, -71.530106),
    "MI": (43.326618, -84.536095), "MN": (45.694454, -93.900192),
    "MS": (32.741646, -89.678696), "MO": (38.456085, -92.288368),
    "MT": (46.921925, -110.454353), "NE": (41.125370, -98.268082),
    "NV": (38.313515, -117.055374), "NH": (43.452492, -71.563896),
    "NJ": (40.298904, -74.521011), "NM": (34.840515, -106.248482),
    "NY": (42.165726, -74.948051), "NC": (35.630066, -79.806419),
    "ND": (47.528912, -99.784012), "OH": (40.388783, -82.764915),
    "OK": (35.565342, -96.928917), "OR": (44.572021, -122.070938),
    "PA": (40.590752, -77.209755), "RI": (41.680893, -71.511780),
    "SC": (33.856892, -80.945007), "SD": (44.299782, -99.438828),
    "TN": (35.747845, -86.692345), "TX": (31.054487, -97.563461),
    "UT": (40.150032, -111.862434), "VT": (44.045876, -72.710686),
    "VA": (37.769337, -78.169968), "WA": (47.400902, -121.490494),
    "WV": (38.491226, -80.954453), "WI": (44.268543, -89.616508),
    "WY": (42.755966, -107.302490), "PR": (18.220833, -66.590149),
}
DEFAULT_CENTROID = (39.833333, -98.583333)
ZIP_SPREAD_DEGREES = 1.2
DEFAULT_P99 = 1000.0
P99_ACCURACY = 10_000
# The largest size there is: a rank error of about one in ten thousand.
SKETCH_SIZE = 65_535
# ------------------------------------------------------------------------------------------


def dedupe_lookup(lookup: DataFrame) -> DataFrame:
    """One row per ZIP; the smallest state wins when a ZIP has several."""
    rest = F.struct("state", "latitude", "longitude")
    return (
        lookup.filter(F.col("zip").isNotNull())
        .groupBy("zip")
        .agg(F.min(rest).alias("_first"))
        .select("zip", "_first.*")
    )


def join_zip(df: DataFrame, lookup: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Adds merchant_lat and merchant_lon; null where the ZIP is unknown."""
    places = materialise(
        dedupe_lookup(lookup).select(
            "zip", F.col("latitude").alias("merchant_lat"), F.col("longitude").alias("merchant_lon")
        )
    )
    limit = {} if max_rows is None else {"max_rows": max_rows}
    return left_join_dim(df, places, "zip", **limit)


def with_distance(df: DataFrame) -> DataFrame:
    km = C.haversine_km(*[F.col(c) for c in ("device_lat", "device_lon", "merchant_lat", "merchant_lon")])
    return df.withColumn("device_merchant_distance_km", km)


def amount_overview(raw: DataFrame, p: float = 0.99) -> tuple[int, float]:
    """Row count and sketched amount quantile (relative rank error 1e-4) from one pass."""
    amounts = raw.select(C.clean_amount(F.col("amount")).alias("amount"))
    rows, found = amounts.agg(
        F.count(F.lit(1)), F.percentile_approx("amount", p, P99_ACCURACY)
    ).first()
    return rows, DEFAULT_P99 if found is None else float(found)


def sketch_amounts(raw: DataFrame) -> DataFrame:
    """file_path, rows and a KLL sketch of the amounts of each input file; ``raw`` comes straight from a scan.

    Sketches merge, so a table of them can be kept and only new files be read later.
    """
    amounts = raw.select(
        F.col("_metadata.file_path").alias("file_path"), C.clean_amount(F.col("amount")).alias("amount")
    )
    return amounts.groupBy("file_path").agg(
        F.count(F.lit(1)).alias("rows"), F.kll_sketch_agg_double("amount", F.lit(SKETCH_SIZE)).alias("sketch")
    )


def refresh_sketches(raw: DataFrame, kept: DataFrame | None) -> DataFrame:
    """The kept sketches, and those of the files that have none yet; the file names prune the scan."""
    if kept is None:
        return sketch_amounts(raw)
    known = [r[0] for r in kept.select("file_path").collect()]
    return kept.unionByName(sketch_amounts(raw.filter(~F.col("_metadata.file_path").isin(known))))


def sketched_quantile(sketches: DataFrame, p: float = 0.99) -> tuple[int, float]:
    """Rows and quantile of all files together."""
    merged = sketches.agg(F.sum("rows").alias("rows"), F.kll_merge_agg_double("sketch").alias("sketch"))
    rows, found = merged.select(
        F.coalesce("rows", F.lit(0)), F.when(F.col("rows") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(p)))
    ).first()
    return rows, DEFAULT_P99 if found is None else float(found)


def cap_outliers(df: DataFrame, threshold: Column | float, amount: str = "amount") -> DataFrame:
    bound = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return df.withColumns(C.outlier_features(F.col(amount), bound))


def build_silver(raw: DataFrame, lookup: DataFrame, p99: float | None = None, gather: bool = False) -> DataFrame:
    """Raw rows to the 43-column cleaned table, one row out for each row in.

    Without a given threshold one extra pass over the amount column finds it. ``gather`` brings
    each month together for ``write_silver`` while rows are narrow: all that can be worked out
    of a row's own columns is added after that shuffle.
    """
    cleaned = clean_rows(raw)
    if p99 is None:
        _, p99 = amount_overview(raw)
    placed = join_zip(cleaned, lookup)
    if gather:
        placed = placed.hint("rebalance", *[F.col(c) for c in PARTITION_COLUMNS])
    located = with_distance(placed)
    amount = F.col("amount")
    featured = located.withColumns(
        {
            **C.amount_features(amount),
            **C.outlier_features(amount, F.lit(float(p99))),
            **C.channel_flags(F.col("merchant_city"), F.col("merchant_state"), F.col("hour")),
        }
    )
    return to_silver(with_dates(featured))


def centroid_table(spark) -> DataFrame:
    rows = [(state, lat, lon) for state, (lat, lon) in STATE_CENTROIDS.items()]
    return spark.createDataFrame(rows, "state string, centroid_lat double, centroid_lon double")


def attach_centroid(df: DataFrame, state: str = "state") -> DataFrame:
    """Centroid of the row's state, or of the contiguous states when it is not one of them."""
    table = centroid_table(df.sparkSession).withColumnRenamed("state", "_state")
    # 52 fixed rows, so the broadcast cannot grow.
    joined = df.join(F.broadcast(table), F.upper(F.col(state)) == F.col("_state"), "left").drop("_state")
    lat, lon = DEFAULT_CENTROID
    return joined.withColumns(
        {
            "centroid_lat": F.coalesce("centroid_lat", F.lit(lat)),
            "centroid_lon": F.coalesce("centroid_lon", F.lit(lon)),
        }
    )


def zip_offset(zip_code: Column) -> tuple[Column, Column]:
    """Latitude and longitude shift within the spread, fixed by the ZIP's MD5."""

    def shift(start: int) -> Column:
        word = F.conv(F.substring(F.md5(zip_code), start, 8), 16, 10).cast("bigint")
        return (word / F.lit(4294967295.0) * 2 - 1) * ZIP_SPREAD_DEGREES

    return shift(1), shift(9)


def build_zip_lookup(raw: DataFrame) -> DataFrame:
    """ZIP table from the distinct (zip, state) pairs of raw transactions."""
    pairs = (
        raw.filter(F.col("zip").isNotNull())
        .select(
            F.trim("zip").alias("raw_zip"),
            F.coalesce(F.trim("merchant_state"), F.lit("")).alias("raw_state"),
        )
        .distinct()
    )
    whole = F.substring_index("raw_zip", ".", 1)
    padded = F.when(F.length(whole) < 5, F.lpad(whole, 5, "0")).otherwise(whole)
    first = (
        pairs.groupBy(padded.alias("zip"))
        .agg(F.min(F.struct("raw_zip", "raw_state")).alias("_first"))
        .select("zip", F.upper("_first.raw_state").alias("state"))
    )
    north, east = zip_offset(F.col("zip"))
    return attach_centroid(first).select(
        "zip",
        "state",
        F.round(F.col("centroid_lat") + north, 6).alias("latitude"),
        F.round(F.col("centroid_lon") + east, 6).alias("longitude"),
    )
