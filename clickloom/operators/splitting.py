"""Train, validation and test sets without shared clients."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom.functions import columns as X
from clickloom.session import stage

log = logging.getLogger(__name__)

SPLITS = ["train", "val", "test"]
SLICE_CLIENTS = 50_000
_LAST_SEEN = ["visit_date", "visit_time", "session_id"]


def client_labels(df: DataFrame, client: str, target: str | None) -> DataFrame:
    """One row per client with the label of its last row (by date, time and session)."""
    if target is None:
        return df.select(client).distinct().withColumn("label", F.lit(0).cast("string"))
    order = [c for c in _LAST_SEEN if c in df.columns] or [target]
    last = F.max_by(F.col(target).cast("string"), F.struct(*order))
    return df.groupBy(client).agg(F.coalesce(last, F.lit("")).alias("label"))


def _positions(clients: DataFrame, total: int) -> DataFrame:
    """``clients`` with ``position``: 0, 1, ... in the order of label, place and key column.

    Places are spread evenly, so slices of them hold about ``SLICE_CLIENTS`` clients whatever the labels are; each
    slice is ranked by a task of its own. Starts are sums over one row per label and slice.
    """
    slices = max(1, total // SLICE_CLIENTS)
    key = clients.columns[0]
    cut = clients.withColumn("slice", F.floor(F.col("place") * slices))
    counts = stage(cut.groupBy("label", "slice").agg(F.count(F.lit(1)).alias("n")), "slices")
    labels = counts.groupBy("label").agg(F.sum("n").alias("n"))
    before = W.orderBy("label").rowsBetween(W.unboundedPreceding, -1)  # one row per label
    labels = labels.select("label", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("label_start"))
    inside = W.partitionBy("label").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("label", "slice", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("slice_start"))
    starts = starts.join(labels, "label").select("label", "slice", (F.col("label_start") + F.col("slice_start")).alias("start"))
    number = F.row_number().over(W.partitionBy("label", "slice").orderBy("place", key)) - 1
    ranked = cut.withColumn("number", number).join(starts, ["label", "slice"])
    return ranked.select(*clients.columns, (F.col("start") + F.col("number")).alias("position"))


def _picked(position: Column, share: float) -> Column:
    """Whether a position is one of those that spread a share evenly over all positions."""
    return F.floor((position + 1) * share) > F.floor(position * share)


def group_split(
    df: DataFrame,
    client: str = C.CLIENT_COLUMN,
    target: str | None = C.TARGET_COLUMN,
    test_size: float = C.TEST_SIZE,
    val_size: float = C.VAL_SIZE,
    seed: int = C.SEED,
) -> DataFrame:
    """The frame with a ``split`` column; all rows of a client share one split.

    Clients are ordered by class and, within it, by a seeded hash; test clients
    are spread evenly over that order, and validation clients over the rest. Every
    class gives its share up to one client, however many classes there are, and
    the sizes of the sets are exact. The result does not depend on the layout of
    the data. Where a set would have fewer clients than there are classes, or a
    class has one client only, classes are not looked at. Rows without a client
    are left out.
    """
    if test_size + val_size >= 1.0:
        raise ValueError("test_size and val_size together must stay below 1")
    if client not in df.columns:
        raise ValueError(f"grouping column {client} is missing")
    stratified = target if target and target in df.columns else None
    known = df.filter(F.col(client).isNotNull())
    clients = client_labels(known, client, stratified).withColumn("place", X.hash_share(client, seed=seed))
    # one row per client, written once: the cuts and the final join both read it
    clients = stage(clients, "clients")
    sizes = clients.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.min("n"), F.sum("n"), F.count("n")).first()
    total, classes = sizes[1] or 0, sizes[2]
    too_small = any(share > 0 and total * share < classes for share in (test_size, val_size))
    if classes > 1 and (sizes[0] < 2 or too_small):
        log.warning("too few clients for %s classes: splitting without strata", classes)
        clients = clients.withColumn("label", F.lit(""))
    placed = _positions(clients.select(client, "label", "place"), total)
    rest = F.col("position") - F.floor(F.col("position") * test_size)
    split = F.when(_picked(F.col("position"), test_size), "test").when(_picked(rest, val_size / (1 - test_size)), "val").otherwise("train")
    clients = stage(placed.select(client, split.alias("split")), "client-splits")
    return known.join(clients, client)


def three_frames(split: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train, val, test) of a frame with a ``split`` column; a set of size 0 is an empty frame."""
    train, val, test = (split.filter(F.col("split") == s).drop("split") for s in SPLITS)
    return train, val, test


def leaking_clients(split: DataFrame, client: str = C.CLIENT_COLUMN) -> DataFrame:
    """Clients found in more than one split; empty when all is well."""
    return split.groupBy(client).agg(F.count_distinct("split").alias("n_splits")).filter("n_splits > 1")


def shared_clients(a: DataFrame, b: DataFrame, client: str = C.CLIENT_COLUMN) -> DataFrame:
    """Clients of both frames."""
    return a.select(client).intersect(b.select(client))


def assert_no_leakage(split: DataFrame, client: str = C.CLIENT_COLUMN) -> None:
    if not leaking_clients(split, client).isEmpty():
        raise ValueError("a client is in more than one split")


def split_sizes(split: DataFrame, client: str = C.CLIENT_COLUMN, target: str = C.TARGET_COLUMN) -> DataFrame:
    """Rows, clients and class share per split."""
    per_client = split.groupBy("split", client).agg(F.count(F.lit(1)).alias("n"), F.sum(target).alias("ones"))
    return per_client.groupBy("split").agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_clients"),
        (F.sum("ones") / F.sum("n")).alias("target_share"),
    )
