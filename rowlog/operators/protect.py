"""Protection: table allow/deny lists, redaction of row images and SQL texts,
and encryption of the columns with row values."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowlog.functions.fingerprint import fingerprint
from rowlog.functions.images import json_string
from rowlog.functions.text import table_key_of

# What holds row values: the images, and the SQL text.
CLEAR_COLUMNS = ("data", "old", "changed", "query")


def filter_tables(df: DataFrame, allow=None, deny=None, regex: bool = False) -> DataFrame:
    """Keep tables on the allow list and off the deny list (`db.table` names,
    or patterns with regex=True). Names match exactly; on a lake with a
    `table_key` partition column an allow list prunes directories as well.
    Rows without a table are on no list."""
    table = F.col("table")

    def hit(names) -> Column:
        if regex:
            return table.rlike("^(?:" + "|".join(f"(?:{p})" for p in names) + ")$")
        return table.isin(*names)

    if allow:
        if "table_key" in df.columns and not regex:
            df = df.where(F.col("table_key").isin(*sorted({table_key_of(n) for n in allow})))
        df = df.where(hit(allow))
    if deny:
        df = df.where(~F.coalesce(hit(deny), F.lit(False)))
    return df


def redact_rows(events: DataFrame, policy: dict) -> DataFrame:
    """Apply a redaction policy to the images of row events before their JSON is built.

    policy: {"db.table": {"column": "hash" | "null" | "drop"}}. "hash"
    replaces the cell by the JSON string of its SHA-256, "null" by JSON null,
    "drop" removes the column from the names and every image. A statement can
    name any value and its text is carried to later rows, so under a policy
    every SQL text is replaced by its shape. The policy is a small driver-side
    dict, compiled into expressions (no join)."""
    if not policy:
        return events
    table = F.concat(F.col("db"), F.lit("."), F.col("tbl"))
    names = F.col("column_names")
    new_names = names
    for t, cols in policy.items():
        drops = [c for c, a in cols.items() if a == "drop"]
        if drops:
            new_names = F.when(table == t, F.filter(names, lambda n: ~n.isin(*drops))).otherwise(new_names)

    def fix(cells: Column) -> Column:
        out = cells
        for t, cols in policy.items():
            cell = _cell_rule(names, cols)
            drops = [c for c, a in cols.items() if a == "drop"]
            t_cells = F.transform(cells, cell)
            if drops:
                kept = F.filter(
                    F.transform(t_cells, lambda v, i: F.struct(v.alias("v"), F.element_at(names, i + 1).alias("n"))),
                    lambda x: ~x["n"].isin(*drops),
                )
                t_cells = F.transform(kept, lambda x: x["v"])
            out = F.when(table == t, t_cells).otherwise(out)
        return out

    image = F.struct(fix(F.col("image.before")).alias("before"), fix(F.col("image.after")).alias("after"))
    events = events.withColumn("image", image).withColumn("column_names", new_names)  # the images first, by the old names
    if "last_query" in events.columns:
        shape = F.col("query_fingerprint") if "query_fingerprint" in events.columns else fingerprint("last_query")
        events = events.withColumn("last_query", shape)
    return events


def _cell_rule(names: Column, cols: dict):
    def cell(v, i):
        n = F.element_at(names, i + 1)
        r = v
        for c, a in cols.items():
            if a == "hash":
                r = F.when(n == c, F.when(v.isNotNull(), json_string(F.sha2(v, 256)))).otherwise(r)
            elif a == "null":
                r = F.when(n == c, F.lit(None).cast("string")).otherwise(r)
        return r

    return cell


def _key(key: Column) -> Column:
    if not isinstance(key, Column):
        raise TypeError("the key must be a column, such as key_table.scalar(): a literal would show in plans and event logs")
    return key


def encrypt_images(df: DataFrame, key: Column, cols=CLEAR_COLUMNS) -> DataFrame:
    """AES-GCM encrypt the columns with row values (base64 text); keys and
    metadata stay clear. `key` is an expression, e.g. the scalar subquery of
    a one-row table in protected storage, so it is in no plan."""
    for c in (c for c in cols if c in df.columns):
        df = df.withColumn(c, F.base64(F.aes_encrypt(F.col(c), _key(key), F.lit("GCM"))))
    return df


def decrypt_images(df: DataFrame, key: Column, cols=CLEAR_COLUMNS) -> DataFrame:
    for c in (c for c in cols if c in df.columns):
        df = df.withColumn(c, F.try_aes_decrypt(F.unbase64(F.col(c)), _key(key), F.lit("GCM")).cast("string"))
    return df
