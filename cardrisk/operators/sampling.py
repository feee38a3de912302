"""Repeatable samples and splits. A row's fate depends on its content and the seed only, so
reruns, retries and other file layouts give the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardrisk.functions.sampling_hash import content_key, digest_fraction, row_digest
from cardrisk.operators.sizing import fits_broadcast, heavy_keys
from cardrisk.session import materialise

NEGATIVES_PER_POSITIVE = 60
HOLDOUT_MODULUS = 5
COPIES_PER_TASK_ROW = 100_000
RADIX_DIGITS = 4

# ---- fixed values: the columns of the serving sample -------------------------------------
SERVING_COLUMNS = [
    "amount_abs", "amount_log", "is_refund", "hour", "day", "month", "minute", "mcc",
    "error_flag", "vpn_flag", "geo_missing", "hw_missing", "device_merchant_distance_km",
    "is_online", "is_foreign_or_unknown", "is_night", "use_chip", "merchant_state",
    "device_os", "error_type", "user", "is_fraud",
]
FLOAT_COLUMNS = ["amount_abs", "amount_log", "device_merchant_distance_km"]
INT_COLUMNS = [
    "hour", "day", "month", "minute", "mcc", "error_flag", "vpn_flag", "geo_missing",
    "hw_missing", "is_online", "is_foreign_or_unknown", "is_night", "is_refund", "is_fraud",
]
# ------------------------------------------------------------------------------------------


def sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Spark's own Bernoulli sample; cheapest, but tied to the file layout."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def _expand(groups: DataFrame, columns: list[str]) -> DataFrame:
    """``_keep`` copies of every row. Large numbers are dealt out to many tasks first."""
    per = COPIES_PER_TASK_ROW
    dealt = (
        groups.filter("_keep > 0")
        .selectExpr(*columns, "_keep", f"explode(sequence(0L, (_keep - 1) div {per})) AS _chunk")
        .hint("rebalance")
    )
    return dealt.selectExpr(
        *columns, f"explode(sequence(1L, least({per}L, _keep - _chunk * {per}))) AS _copy"
    ).drop("_copy")


def sample_by_hash(df: DataFrame, fraction: float, key: Column | None = None, seed: int = 42) -> DataFrame:
    """Keeps the rows whose digest lies in the first ``fraction`` of all digests: a filter.

    Copies share their digest, so they are kept or left out together, except those of a key
    with more than a thousandth of all rows, found by a sketch: of its ``n`` copies it keeps
    ``n * fraction``, rounded by hash, since one such key would tip the whole sample.
    """
    key = content_key(df.columns) if key is None else key
    digest = row_digest(key, seed)
    below = digest_fraction(digest) < fraction
    heavy = heavy_keys(df.select(digest.alias("digest")), "digest")
    if not heavy:
        return df.filter(below)
    is_heavy = digest.isin(list(heavy))
    examples = df.filter(is_heavy).groupBy(digest.alias("_digest"), *df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    keep = F.floor(F.col("_copies") * F.lit(float(fraction)) + digest_fraction(F.col("_digest")))
    kept = _expand(examples.withColumn("_keep", F.least(keep, F.col("_copies"))), df.columns)
    return df.filter(~is_heavy & below).unionByName(kept)


def sample_copies_by_hash(df: DataFrame, fraction: float, key: Column | None = None, seed: int = 42) -> DataFrame:
    """Keeps ``fraction`` of the rows; of ``n`` copies of any row it keeps ``n * fraction``, rounded by hash.

    A row that has no copies is kept or left out by a filter. Which rows have copies is told by
    64-bit hashes of the rows, the only thing that all rows send through a shuffle; rows that
    may have copies are then counted by content.
    """
    key = content_key(df.columns) if key is None else key
    row_hash = F.xxhash64(*df.columns)
    copied = materialise(
        df.groupBy(row_hash.alias("_hash")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_hash")
    )
    u = digest_fraction(row_digest(key, seed))
    share = F.lit(float(fraction))
    many = not fits_broadcast(copied)
    known = copied if many else F.broadcast(copied)
    hashed = df.withColumn("_hash", row_hash)
    single = hashed.filter(F.floor(share + u) >= 1).join(known, "_hash", "left_anti").drop("_hash")
    repeated = hashed.join(known, "_hash", "left_semi").drop("_hash")
    groups = repeated.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    keep = F.least(F.floor(F.col("_copies") * share + u), F.col("_copies"))
    return single.unionByName(_expand(groups.withColumn("_keep", keep), df.columns))


def _boundary(digests: DataFrame, n: int) -> tuple[str | None, int, bool]:
    """Where the first ``n`` digests end: (prefix, how many of its digests belong, whether that is all of them).

    Radix selection: a histogram over the next leading digits of those digests that share
    the boundary's prefix so far, at most 65,536 counts a pass. Once no more digests than that
    are left they are counted one by one. None where all digests belong.
    """
    length, prefix, need = None, "", n
    while True:
        rest = digests.filter(F.col("digest").startswith(prefix)) if prefix else digests
        digit = F.substring("digest", len(prefix) + 1, RADIX_DIGITS)
        found = sorted((r[0], r[1]) for r in rest.groupBy(digit.alias("digit")).agg(F.count(F.lit(1))).collect())
        if not prefix and sum(c for _, c in found) <= need:
            return None, 0, True
        for digits, count in found:
            if count >= need:
                break
            need -= count
        prefix += digits
        if count == need:
            return prefix, need, True
        if length is None:
            length = digests.select(F.length("digest")).first()[0]
        if len(prefix) >= length:
            return prefix, need, False
        if count <= 16**RADIX_DIGITS:
            last = digests.filter(F.col("digest").startswith(prefix))
            for digest, copies in sorted((r[0], r[1]) for r in last.groupBy("digest").agg(F.count(F.lit(1))).collect()):
                if copies >= need:
                    return digest, need, copies == need
                need -= copies


def take_by_hash(df: DataFrame, n: int, key: Column | None = None, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all when there are fewer): those that come first in hash order.

    Rows with one key go by the digest of their whole content. Two narrow scans find the
    digest at which the sample ends; the sample is then a filter of the table, which is neither
    shuffled nor written. Only where the boundary falls among copies of one row is that row
    repeated as often as there is room.
    """
    if n <= 0:
        return df.limit(0)
    content = row_digest(content_key(df.columns), seed)
    digest = content if key is None else F.concat(row_digest(key, seed), content)
    last, room, whole = _boundary(df.select(digest.alias("digest")), n)
    if last is None:
        return df
    place = F.substring(digest, 1, len(last))
    if whole:
        return df.filter(place <= last)
    copy = df.filter(place == last).limit(1).withColumn("_keep", F.lit(room).cast("long"))
    return df.filter(place < last).unionByName(_expand(copy, df.columns))


def class_counts(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(F.col(label) == 1).alias("positives")
    )


def class_ratio(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Negatives per positive: the weight a positive row gets."""
    return class_counts(df, label).select(
        "total_rows",
        "positives",
        (
            (F.col("total_rows") - F.col("positives")) / F.greatest(F.col("positives"), F.lit(1))
        ).alias("class_ratio"),
    )


def keep_fraction(df: DataFrame, negatives_per_positive: float, label: str = "is_fraud") -> float:
    counts = class_counts(df, label).first()
    negatives = counts.total_rows - counts.positives
    return min(1.0, counts.positives * negatives_per_positive / max(negatives, 1))


def stratified_sample(
    df: DataFrame,
    negatives_per_positive: float = NEGATIVES_PER_POSITIVE,
    label: str = "is_fraud",
    key: Column | str | None = None,
    seed: int = 42,
    by_copies: bool = False,
) -> DataFrame:
    """Every positive, and negatives at the fraction that gives the wanted ratio.

    When ``key`` is the name of a column unique per row (see ``read_silver(row_id=True)``)
    each row is sampled by itself; else by its content, see ``sample_by_hash``, or with
    ``by_copies`` so that the ratio holds among the copies of every row, see
    ``sample_copies_by_hash``.
    """
    fraction = keep_fraction(df, negatives_per_positive, label)
    positive, negative = F.col(label) == 1, F.col(label) == 0
    if isinstance(key, str):
        below = digest_fraction(row_digest(F.col(key).cast("string"), seed)) < fraction
        return df.filter(positive | (negative & below))
    draw = sample_copies_by_hash if by_copies else sample_by_hash
    return df.filter(positive).unionByName(draw(df.filter(negative), fraction, key, seed))


def cap_rows(
    df: DataFrame,
    max_rows: int,
    label: str = "is_fraud",
    key: Column | None = None,
    seed: int = 42,
    min_negatives: int = 1000,
) -> DataFrame:
    """At most about ``max_rows`` rows, by cutting negatives only."""
    counts = class_counts(df, label).first()
    if counts.total_rows <= max_rows:
        return df
    room = max(max_rows - counts.positives, min_negatives)
    negatives = take_by_hash(df.filter(F.col(label) == 0), room, key, seed)
    return df.filter(F.col(label) == 1).unionByName(negatives)


def is_holdout(user: Column | str = "user", modulus: int = HOLDOUT_MODULUS) -> Column:
    user = F.col(user) if isinstance(user, str) else user
    return user % modulus == 0


def with_split(df: DataFrame, modulus: int = HOLDOUT_MODULUS) -> DataFrame:
    return df.withColumn("is_holdout", is_holdout("user", modulus))


def user_split(df: DataFrame, modulus: int = HOLDOUT_MODULUS) -> tuple[DataFrame, DataFrame]:
    """Train and holdout frames that share no user."""
    return df.filter(~is_holdout("user", modulus)), df.filter(is_holdout("user", modulus))


def split_report(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Rows, positives, rate and class ratio of each side, from one pass."""
    sides = with_split(df).groupBy("is_holdout").agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(F.col(label) == 1).alias("positives")
    )
    return sides.select(
        F.when(F.col("is_holdout"), "holdout").otherwise("train").alias("split"),
        "total_rows",
        "positives",
        F.round(F.lit(100.0) * F.col("positives") / F.col("total_rows"), 4).alias("rate_pct"),
        F.round(
            (F.col("total_rows") - F.col("positives")) / F.greatest(F.col("positives"), F.lit(1)), 3
        ).alias("class_ratio"),
    )


def sample_metadata(full: DataFrame, sampled: DataFrame, negatives_per_positive: float, label: str = "is_fraud") -> DataFrame:
    """What was sampled from what: one row."""
    side = F.when(is_holdout("user"), "test").otherwise("train")
    pos = F.col(label) == 1
    whole = full.agg(
        F.count(F.lit(1)).alias("full_rows"),
        F.count_if(pos).alias("full_fraud"),
        *[F.lit(0).cast("bigint").alias(c) for c in ("train_rows", "train_fraud", "test_rows", "test_fraud")],
    )
    parts = sampled.agg(
        F.lit(0).cast("bigint").alias("full_rows"),
        F.lit(0).cast("bigint").alias("full_fraud"),
        F.count_if(side == "train").alias("train_rows"),
        F.count_if((side == "train") & pos).alias("train_fraud"),
        F.count_if(side == "test").alias("test_rows"),
        F.count_if((side == "test") & pos).alias("test_fraud"),
    )
    merged = whole.unionByName(parts)
    summed = merged.agg(*[F.sum(c).alias(c) for c in merged.columns])
    negatives = F.col("full_rows") - F.col("full_fraud")
    return summed.select(
        "*",
        F.lit(negatives_per_positive).cast("int").alias("negatives_per_positive"),
        F.round(
            F.least(
                F.lit(1.0),
                F.col("full_fraud") * F.lit(float(negatives_per_positive)) / F.greatest(negatives, F.lit(1)),
            ),
            6,
        ).alias("legit_keep_fraction"),
        F.round(
            (F.col("train_rows") - F.col("train_fraud")) / F.greatest(F.col("train_fraud"), F.lit(1)), 3
        ).alias("scale_pos_weight"),
        F.lit("user % 5 == 0").alias("split_rule"),
    )


def pool_sample(
    raw: DataFrame,
    n: int,
    holdout: bool,
    key: Column | None = None,
    seed: int = 7,
    modulus: int = HOLDOUT_MODULUS,
) -> DataFrame:
    """``n`` rows of one side of the split, spread over the whole source by hash order.

    Rows without a readable user or a finite amount cannot be placed and are left out.
    """
    user = F.col("user").try_cast("double").try_cast("bigint")
    amount = F.regexp_replace(F.trim("amount"), "[$,]", "").try_cast("double")
    usable = raw.filter(user.isNotNull() & (F.abs(amount) < float("inf")))
    side = is_holdout(user, modulus)
    return take_by_hash(usable.filter(side if holdout else ~side), n, key, seed)


def drop_features(df: DataFrame, names: list[str]) -> DataFrame:
    return df.drop(*names)


def fill_model_input(df: DataFrame, categorical: list[str]) -> DataFrame:
    """Categoricals to UNKNOWN, every other null to 0."""
    present = [c for c in categorical if c in df.columns]
    return df.fillna("UNKNOWN", subset=present).fillna(
        0, subset=[c for c in df.columns if c not in present]
    )


def downcast(df: DataFrame) -> DataFrame:
    """32-bit numbers for export."""
    narrow = {c: F.col(c).cast("float") for c in FLOAT_COLUMNS if c in df.columns}
    narrow.update({c: F.col(c).cast("int") for c in INT_COLUMNS if c in df.columns})
    return df.withColumns(narrow)
