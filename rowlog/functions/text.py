"""Scalar text helpers: GTID parts, strict number parse, log-file names, table keys.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""
from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowlog.schema import UNKNOWN_TABLE

ZEROS10 = "0000000000"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_long(c) -> Column:
    """Strict base-10 long parse: optional sign and digits only, else null.

    `try_cast` alone accepts surrounding blanks; the anchored pattern rejects
    them, and overflow still falls to null through `try_cast`.
    """
    c = _c(c)
    return F.when(c.rlike(r"\A[+-]?[0-9]+\z"), c.try_cast("bigint"))


def gtid_uuid(c) -> Column:
    """Text before the first ':'; null when there is none or it is at index 0."""
    c = _c(c)
    return F.when(F.instr(c, ":") > 1, F.substring_index(c, ":", 1))


def gtid_txn_text(c) -> Column:
    """Everything after the first ':'; null when nothing follows it."""
    c = _c(c)
    i = F.instr(c, ":")
    return F.when((i > 0) & (i < F.length(c)), F.substr(c, i + 1))


def gtid_txn(c) -> Column:
    return parse_long(gtid_txn_text(c))


def padded_seq(name) -> Column:
    """Trailing numeric segment of a log file name, zero-padded to 10 digits.

    No dot, a trailing dot or a non-numeric tail give ten zeros; numbers longer
    than ten digits are kept whole (so this is a format, not an lpad).
    """
    name = _c(name)
    tail = F.substring_index(name, ".", -1)
    num = parse_long(F.when(F.instr(name, ".") > 0, tail))
    # format_string renders null as text, so test first
    return F.when(num.isNotNull(), F.format_string("%010d", num)).otherwise(F.lit(ZEROS10))


def file_base(name) -> Column:
    """File name without its last '.suffix' (whole name when there is no dot)."""
    name = _c(name)
    tail = F.substring_index(name, ".", -1)
    return F.when(
        F.instr(name, ".") > 0, F.substr(name, F.lit(1), F.length(name) - F.length(tail) - 1)
    ).otherwise(name)


def output_name(name, server_id) -> Column:
    """`<base>.<server_id>.<padded seq>`: unique across servers, sorts in log order."""
    return F.concat_ws(".", file_base(name), _c(server_id).cast("string"), padded_seq(name))


def table_key(c) -> Column:
    """File-safe table name: chars outside [a-zA-Z0-9._-] become '_';
    null or blank (control characters count as blank) becomes 'unknown_table'."""
    c = _c(c)
    return F.when(c.isNull() | c.rlike(r"\A[\x00-\x20]*\z"), F.lit(UNKNOWN_TABLE)).otherwise(
        F.regexp_replace(c, r"[^a-zA-Z0-9._-]", "_")
    )


def table_key_of(name: str | None) -> str:
    """`table_key` of a literal name."""
    if name is None or not name.strip("".join(map(chr, range(0x21)))):
        return UNKNOWN_TABLE
    return re.sub(r"[^a-zA-Z0-9._-]", "_", name)


def qualified_table(db, tbl) -> Column:
    return F.concat(_c(db), F.lit("."), _c(tbl))


def op_class(event) -> Column:
    """write / update / delete from an event name, by lower-case substring."""
    e = F.lower(_c(event))
    return (
        F.when(e.contains("write") | e.contains("insert"), F.lit("write"))
        .when(e.contains("update"), F.lit("update"))
        .when(e.contains("delete"), F.lit("delete"))
    )


def change_pk(uuid_, txn, server_id, binarylog, position, counter) -> Column:
    """Surrogate key `uuid:txn:server:file:position:counter`; nulls print as 'null'."""
    parts = [uuid_, txn, server_id, binarylog, position, counter]
    return F.concat_ws(":", *[F.coalesce(_c(p).cast("string"), F.lit("null")) for p in parts])
