"""Reproducible train/test splits."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsengine.constants import SPLIT_SEED, TRAIN_SHARE

_BUCKETS = 10_000


def in_training(keys: Sequence[str], share: float = TRAIN_SHARE, seed: int = SPLIT_SEED) -> Column:
    """Whether a row's keys fall into the training share.

    The answer depends on the key values and the seed only: not on partitions,
    retries or row order, and any SQL engine with MD5 can repeat it. Rows that
    share their keys stay on one side.
    """
    if not 0 <= share <= 1:
        raise ValueError("share must be between 0 and 1")
    text = F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys))
    # 60 bits of the digest: non-negative, and far more than the buckets need.
    digest = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")
    return F.pmod(digest, F.lit(_BUCKETS)) < round(share * _BUCKETS)


def hash_split(
    df: DataFrame,
    keys: Sequence[str] = ("city_name", "date"),
    share: float = TRAIN_SHARE,
    seed: int = SPLIT_SEED,
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows of ``df``."""
    chosen = in_training(keys, share, seed)
    return df.filter(chosen), df.filter(~chosen)
