"""Samples that repeat: they depend on keys and a seed, not on how rows are laid out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom.functions import columns as X
from clickloom.functions.quantiles import exact_quantiles


def client_sample(
    df: DataFrame, share: float = C.SAMPLE_SHARE, client: str = C.CLIENT_COLUMN, seed: int = C.SEED
) -> DataFrame:
    """All rows of a random share of clients; rows without a client are left out.

    A pure filter: no list of sampled clients, no join, no shuffle.
    """
    known = df.filter(F.col(client).isNotNull())
    return known if share >= 1.0 else known.filter(X.hash_share(client, seed=seed) < share)


def rows_of_clients(df: DataFrame, clients: DataFrame, client: str = C.CLIENT_COLUMN) -> DataFrame:
    """Rows whose client is in the given list."""
    return df.join(clients.select(client), client, "left_semi")


def row_sample(df: DataFrame, share: float, seed: int = C.SEED, keys: Sequence[str] = ()) -> DataFrame:
    """Bernoulli sample of rows.

    With keys a row is in the sample by the digest of its keys, so the sample is the same for any layout of the
    files; without them Spark draws by the place of the row.
    """
    if keys:
        return df.filter(X.hash_share(*keys, seed=seed) < share)
    return df.sample(withReplacement=False, fraction=share, seed=seed)


def balanced_set(
    df: DataFrame,
    target: str,
    keys: Sequence[str],
    negatives_per_positive: int = 3,
    seed: int = C.SEED,
) -> DataFrame:
    """All rows of class 1 and exactly so many times as many of class 0, chosen by hashed key.

    The cut-off hash is an exact quantile, so no global sort and no limit on a
    single task is needed. ``keys`` have to tell rows apart.
    """
    sizes = df.agg(
        F.count(F.when(F.col(target) == 1, 1)).alias("ones"),
        F.count(F.when(F.col(target) == 0, 1)).alias("zeros"),
    ).first()
    ones = df.filter(F.col(target) == 1)
    zeros = df.filter(F.col(target) == 0)
    wanted = sizes["ones"] * negatives_per_positive
    if wanted >= sizes["zeros"]:
        return ones.unionByName(zeros)
    if wanted == 0:
        return ones
    place = X.hash_share(*keys, seed=seed)
    # the quantile halfway between the last wanted place and the next one
    share = (wanted - 0.5) / (sizes["zeros"] - 1)
    places = zeros.select(place.alias("place"))
    cut = exact_quantiles(places, [], "place", [share], distinct=sizes["zeros"]).first()["quantiles"][0]
    return ones.unionByName(zeros.filter(place < cut))
