"""Input (decoded event log) and output (row changes) contracts."""
from __future__ import annotations

from pyspark.sql import types as T

# The event types a closed log may contain (anything else aborts
# a conversion), the three row-event types that are exported, and the marker
# events that drive the per-file state.
ALLOWED_EVENT_TYPES = (
    "FORMAT_DESCRIPTION",
    "PREVIOUS_GTIDS",
    "GTID",
    "QUERY",
    "ROWS_QUERY",
    "TABLE_MAP",
    "EXT_UPDATE_ROWS",
    "EXT_WRITE_ROWS",
    "EXT_DELETE_ROWS",
    "ROTATE",
    "XID",
)
ROW_EVENT_TYPES = ("EXT_WRITE_ROWS", "EXT_UPDATE_ROWS", "EXT_DELETE_ROWS")
FIRST_POSITION = 4  # start offset of the first event in a log file
UNKNOWN_TABLE = "unknown_table"

# A log file: events are ordered by `seq` inside it.
FILE = ("server_id", "binarylog")

ROW_IMAGE = T.StructType(
    [
        T.StructField("before", T.ArrayType(T.StringType()), True),
        T.StructField("after", T.ArrayType(T.StringType()), True),
    ]
)

RAW_SCHEMA = T.StructType(
    [
        T.StructField("server_id", T.LongType(), False),
        T.StructField("binarylog", T.StringType(), False),
        T.StructField("seq", T.LongType(), False),
        T.StructField("next_position", T.LongType(), False),
        T.StructField("event_type", T.StringType(), False),
        T.StructField("timestamp", T.LongType(), False),
        T.StructField("gtid", T.StringType(), True),
        T.StructField("previous_gtids", T.StringType(), True),
        T.StructField("next_binlog", T.StringType(), True),
        T.StructField("query", T.StringType(), True),
        T.StructField("table_id", T.LongType(), True),
        T.StructField("db", T.StringType(), True),
        T.StructField("tbl", T.StringType(), True),
        T.StructField("column_names", T.ArrayType(T.StringType()), True),
        T.StructField("rows", T.ArrayType(ROW_IMAGE), True),
    ]
)
RAW_COLUMNS = tuple(f.name for f in RAW_SCHEMA.fields)

# Output of a conversion, column order fixed.
CHANGE_COLUMNS = (
    "binarylog",
    "position",
    "gtid_position",
    "gtid",
    "gtid_uuid",
    "gtid_txn",
    "server_id",
    "timestamp",
    "timestamp_string",
    "event",
    "table",
    "query",
    "query_fingerprint",
    "query_hash",
    "data",
    "old",
    "changed",
    "columns",
)
CHANGE_SCHEMA = T.StructType(
    [
        T.StructField("binarylog", T.StringType(), True),
        T.StructField("position", T.LongType(), True),
        T.StructField("gtid_position", T.StringType(), True),
        T.StructField("gtid", T.StringType(), True),
        T.StructField("gtid_uuid", T.StringType(), True),
        T.StructField("gtid_txn", T.LongType(), True),
        T.StructField("server_id", T.LongType(), False),
        T.StructField("timestamp", T.LongType(), False),
        T.StructField("timestamp_string", T.TimestampType(), False),
        T.StructField("event", T.StringType(), True),
        T.StructField("table", T.StringType(), True),
        T.StructField("query", T.StringType(), True),
        T.StructField("query_fingerprint", T.StringType(), True),
        T.StructField("query_hash", T.StringType(), True),
        T.StructField("data", T.StringType(), True),
        T.StructField("old", T.StringType(), True),
        T.StructField("changed", T.StringType(), True),
        T.StructField("columns", T.StringType(), True),
    ]
)
# Internal columns kept next to the 18 exported ones.
INTERNAL_COLUMNS = ("row_idx", "seq", "segment", "counter", "table_key", "log_seq")
