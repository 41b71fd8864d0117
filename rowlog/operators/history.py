"""Time travel over the change table: table state at an instant, row
history, bootstrap from a snapshot plus later changes.

Order is log order, never time: changes of one transaction share a
timestamp. Keys are not in the log, so callers name key columns (and types);
they are read from the images."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowlog.functions.images import image_col, once, parsed
from rowlog.functions.text import op_class, padded_seq
from rowlog.operators.gtid import after_gtid_set
from rowlog.operators.workload import log_order, log_order_struct


def key_columns(changes: DataFrame, keys: dict) -> DataFrame:
    """Add key columns read from the post-image (delete: the deleted row)."""
    return changes.select("*", _key("data", keys).alias("_k")).select("*", "_k.*").drop("_k")


def _key(image: str, keys: dict):
    """The key columns of an image, parsed once, as a struct (its fields are null without an image)."""
    return once(parsed(image), lambda v: F.struct(*[image_col(image, k, t, v).alias(k) for k, t in keys.items()]))


def keyed_changes(changes: DataFrame, keys: dict) -> DataFrame:
    """One row per (key, change). A key-changing UPDATE also emits a delete
    of the old key, ordered just before the upsert."""
    changes = changes.withColumns({"_old_k": _key("old", keys), "_new_k": _key("data", keys)})
    old_k, new_k = F.col("_old_k"), F.col("_new_k")
    op = op_class("event")
    moved = (F.col("event") == "EXT_UPDATE_ROWS") & ~old_k.eqNullSafe(new_k)
    items = F.when(
        moved,
        F.array(
            F.struct(old_k.alias("k"), F.lit("delete").alias("op"), F.lit(0).alias("sub")),
            # the new key did not exist before: an upsert with no usable pre-image
            F.struct(new_k.alias("k"), F.lit("write").alias("op"), F.lit(1).alias("sub")),
        ),
    ).otherwise(F.array(F.struct(new_k.alias("k"), op.alias("op"), F.lit(1).alias("sub"))))
    x = changes.select("*", log_order_struct().alias("_o"), F.explode(items).alias("_it"))
    return x.select(
        *[F.col("_it.k").getField(k).alias(k) for k in keys],
        F.col("_it.op").alias("op"),
        F.struct(F.col("_o"), F.col("_it.sub").alias("sub")).alias("_ord"),
        "data",
        "old",
        "timestamp",
    )


def state_at(changes: DataFrame, keys: dict, ts_ms: int, use_preimage: bool = False) -> DataFrame:
    """Rows of one table as of instant `ts_ms`: per key the last change at or
    before it; deleted keys are gone. With `use_preimage`, keys first seen in
    an update/delete after the instant take that change's pre-image (the log
    does not reach back far enough to see their insert)."""
    if not use_preimage:  # later changes don't matter: the scan drops them
        changes = changes.where(F.col("timestamp") <= F.lit(ts_ms))
    k = keyed_changes(changes, keys)
    before = F.col("timestamp") <= F.lit(ts_ms)
    last_before = F.max(F.when(before, F.struct("_ord", "op", "data")))
    first_after = F.min(F.when(~before, F.struct("_ord", "op", "old")))
    g = k.groupBy(*keys).agg(last_before.alias("_lb"), first_after.alias("_fa"))
    lb, fa = F.col("_lb"), F.col("_fa")
    data = F.when(lb.isNotNull(), F.when(lb.getField("op") != "delete", lb.getField("data")))
    if use_preimage:
        pre = F.when(lb.isNull() & fa.getField("op").isin("update", "delete"), fa.getField("old"))
        data = F.coalesce(data, pre)
    return g.select(*keys, data.alias("data")).where(F.col("data").isNotNull())


HISTORY_BUCKET = 1 << 26  # log bytes of one file per history bucket


def row_history(changes: DataFrame, keys: dict, bucket: int = HISTORY_BUCKET) -> DataFrame:
    """Every version of every key in log order, with the previous version. An
    update that changes the key ends the old key (a version without data)
    and begins the new one.

    A key's history is split into buckets of (server, file, position range).
    Version numbers and previous images are computed inside each bucket, and
    a per-bucket summary (version count, last image) is rolled forward over
    the buckets of the key and joined back. A key changed in a third of all
    rows is then many bounded sorts, not one task."""
    kk = list(keys)
    # One struct key: struct equality matches null key fields, so the join
    # back is a plain equi-join and keeps the local side's partitioning.
    if "old" not in changes.columns:
        changes = changes.withColumn("old", F.lit(None).cast("string"))
    changes = changes.withColumns({"_old_k": _key("old", keys), "_new_k": _key("data", keys)})
    old_k, new_k = F.col("_old_k"), F.col("_new_k")
    moved = (F.col("event") == "EXT_UPDATE_ROWS") & F.col("old").isNotNull() & ~old_k.eqNullSafe(new_k)

    def version(key, data, sub):
        return F.struct(key.alias("k"), data.alias("data"), F.lit(sub).alias("sub"))

    one, gone = version(new_k, F.col("data"), 1), version(old_k, F.lit(None).cast("string"), 0)
    each = changes.select(
        "server_id", "binarylog", "event", "position", "row_idx", F.expr(f"position div {bucket}").alias("_hb"),
        F.explode(F.when(moved, F.array(gone, one)).otherwise(F.array(one))).alias("_v"))
    part = ["_kk", "server_id", "binarylog", "_hb"]
    order = ["position", "row_idx", "_sub"]
    wl = Window.partitionBy(*part).orderBy(*order)
    local = each.select(
        F.col("_v.k").alias("_kk"), *part[1:], "event", "position", "row_idx", F.col("_v.sub").alias("_sub"), F.col("_v.data").alias("data"),
    ).select("*", F.row_number().over(wl).alias("_rn"), F.lag("data").over(wl).alias("_lag"))
    # max_by skips no nulls inside a struct, so a key that ended carries null.
    summ = local.groupBy(*part).agg(
        F.count(F.lit(1)).alias("_n"),
        F.max_by(F.struct("data"), F.struct(*order)).getField("data").alias("_last"),
    )
    wk = Window.partitionBy("_kk").orderBy("server_id", padded_seq("binarylog"), "binarylog", "_hb")
    carry = summ.select(
        *part,
        F.coalesce(F.sum("_n").over(wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.lag("_last").over(wk).alias("_prev_last"),
    )
    j = local.join(carry, part, "inner")
    return j.select(
        *[F.col("_kk").getField(k).alias(k) for k in kk],
        (F.col("_before") + F.col("_rn")).cast("int").alias("version"),
        "event",
        "binarylog",
        "position",
        "data",
        F.when(F.col("_rn") == 1, F.col("_prev_last")).otherwise(F.col("_lag")).alias("prev_data"),
    )


def bootstrap(snapshot: DataFrame, changes: DataFrame, intervals: DataFrame, keys: dict, ts_ms: int | None = None) -> DataFrame:
    """Snapshot rows (keys + `data`) taken at an executed GTID set, plus the
    changes not in that set, folded to the current (or `ts_ms`) state. The
    snapshot sorts before every change of its key."""
    later = after_gtid_set(changes, intervals)
    k = keyed_changes(later, keys)
    low = F.struct(
        F.struct(
            F.lit(None).cast("long").alias("s"), F.lit(None).cast("string").alias("p"), F.lit(None).cast("string").alias("b"),
            F.lit(None).cast("long").alias("pos"), F.lit(None).cast("int").alias("r"),
        ).alias("_o"),
        F.lit(0).alias("sub"),
    )
    snap = snapshot.select(*keys, F.lit("write").alias("op"), low.alias("_ord"), "data",
                           F.lit(None).cast("string").alias("old"), F.lit(None).cast("long").alias("timestamp"))
    allk = snap.unionByName(k)
    if ts_ms is not None:
        allk = allk.where(F.col("timestamp").isNull() | (F.col("timestamp") <= ts_ms))
    g = allk.groupBy(*keys).agg(F.max(F.struct("_ord", "op", "data")).alias("_l"))
    return g.select(*keys, F.when(F.col("_l.op") != "delete", F.col("_l.data")).alias("data")).where(
        F.col("data").isNotNull()
    )
