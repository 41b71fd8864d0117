"""The conversion job: decoded events -> `changes`, and the whole job from an
event table to a lake with audit and statistics.

Plan shape:

    raw -> [type gate] -> narrow projection -> sequencing (see
        operators.sequence; its narrow state is written once)
    row events of the sequence
        + table map on (file, segment, table id)
        dealt by (file, place), a range of numbers
        + SQL text and fingerprint on (file, place, query_seq)
        + row images, one row each, on (file, place, seq)
        -> JSON image/diff expressions -> changes

Only narrow rows are sorted. The raw events are read once for the narrow
columns; images, table maps and SQL texts are disjoint columns of disjoint
event types, each read once, and a text is fingerprinted once, not per row.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rowlog.functions.text import qualified_table, table_key
from rowlog.operators.explode import image_rows, with_names
from rowlog.operators.protect import redact_rows
from rowlog.operators.sequence import DEFAULT_BUCKET, by_place, outside_texts, resolve_table_maps, sequence_events, with_images, with_query_text
from rowlog.operators.stats import event_type_counts, file_summary, table_op_counts
from rowlog.schema import ROW_EVENT_TYPES
from rowlog.session import written
from rowlog.sinks import manifest
from rowlog.sinks.parquet import audited, read_lake, write_by_table, write_logs, write_stats
from rowlog.sources.raw import assert_event_types, raw_events


def sequenced(
    raw: DataFrame,
    method: str = "carry",
    bucket_size: int = DEFAULT_BUCKET,
    query_scope: str = "file",
    gate: bool = True,
    store: bool = True,
) -> DataFrame:
    ev = assert_event_types(raw) if gate else raw
    return sequence_events(ev, method=method, bucket_size=bucket_size, query_scope=query_scope, store=store)


def build_changes(
    raw: DataFrame,
    method: str = "carry",
    bucket_size: int = DEFAULT_BUCKET,
    query_scope: str = "file",
    missing: str = "fail",
    fingerprints: bool = True,
    strict: bool = False,
    gate: bool = True,
    store: bool = True,
    redact: dict | None = None,
    seq: DataFrame | None = None,
) -> DataFrame:
    """The changes of `raw`. The sequence is computed (and, stored, written)
    while this is called; `seq` gives one that is there already."""
    if seq is None:
        seq = sequenced(raw, method, bucket_size, query_scope, gate, store)
    rows = by_place(resolve_table_maps(seq, raw, missing))
    outside = outside_texts(seq.where(F.col("event_type").isin(*ROW_EVENT_TYPES)))
    if store:
        outside = written(outside, "outside-texts")
    rows = with_query_text(rows, raw, fingerprints, outside, all_inside=store and outside.isEmpty())
    if redact:  # the policy may change the names
        rows = with_names(redact_rows(with_images(rows, raw), redact))
    else:
        rows = with_images(with_names(rows), raw)
    return image_rows(rows, strict=strict)


@dataclass
class Conversion:
    """What a conversion wrote: the lake and its reports. `rows` is the number
    of rows that went into the writer, observed as they went."""

    root: str
    rows: int
    audit: DataFrame
    event_type_counts: DataFrame
    table_op_counts: DataFrame
    file_summary: DataFrame


SEQUENCE_OPTIONS = ("method", "bucket_size", "query_scope", "gate", "store")


def convert(spark: SparkSession, src: str, dst: str, by_file: bool = True, replace: str | None = None, fmt: str = "parquet", **opts) -> Conversion:
    """Event table `src` -> change lake `dst`, audit and statistics (under
    `dst/_stats`). Events without row changes leave an empty lake that can be
    read. Events are sequenced once, and changes made once: the audit counts
    rows expected from the sequence, rows observed on their way into the
    writer, and rows in the files as the snapshot's list has them."""
    raw = raw_events(spark, src, fmt, with_file_size=True, with_log_size=True)
    events = raw.drop("file_size", "log_size")
    seq = sequenced(events, **{k: v for k, v in opts.items() if k in SEQUENCE_OPTIONS})
    if opts.get("method", "carry") != "carry" or not opts.get("store", True):
        seq = written(seq, "sequence")  # read twice below
    seen = Observation()
    changes = build_changes(events, seq=seq, **opts).observe(seen, F.count(F.lit(1)).alias("rows"))
    if by_file:
        generation = write_logs(changes, dst, replace or "touched")
        files = manifest.live(spark, dst).where(F.col("generation") == generation)
        ops = ("writes", "updates", "deletes")
        got = files.groupBy("table_key").agg(F.sum("rows").alias("written_rows"), *(F.sum(op).alias(op) for op in ops))
        counts = got.select("table_key", *ops, sum(F.col(op) for op in ops).alias("total")).orderBy(F.desc("total"), "table_key")
    else:
        write_by_table(changes, dst, replace=replace)
        lake = read_lake(spark, dst)
        got = lake.groupBy("table_key").agg(F.count(F.lit(1)).alias("written_rows"))
        counts = table_op_counts(lake)
    mapped = resolve_table_maps(seq.where(F.col("event_type").isin("TABLE_MAP", *ROW_EVENT_TYPES)), events, opts.get("missing", "fail"))
    expected = mapped.groupBy(table_key(qualified_table("db", "tbl")).alias("table_key")).agg(F.sum("n_rows").alias("expected_rows"))
    reports = {
        "audit": audited(expected.where("expected_rows > 0"), got.select("table_key", "written_rows")),
        "event_type_counts": event_type_counts(events),
        "table_op_counts": counts,
        "file_summary": file_summary(raw),
    }
    write_stats(dst, **reports)
    # Of an empty plan nothing is observed.
    rows = 0 if got.where("written_rows > 0").isEmpty() else seen.get["rows"]
    return Conversion(dst, rows, **{k: spark.read.schema(df.schema).parquet(f"{dst.rstrip('/')}/_stats/{k}") for k, df in reports.items()})
