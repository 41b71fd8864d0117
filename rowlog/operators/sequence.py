"""Per-file log state, attached to every event.

The decoder reads a log file front to back and keeps running state: the start
offset of each event (previous event's end), the open transaction (set by a
GTID event, cleared after an XID), the transaction segment (GTID count), the
last SQL text and the number of row images already exported. Here that state
is a set of window results over (file, seq):

    position      = previous event's next_position (4 for the first event)
    txn_gtid      = GTID of the open transaction, as seen *before* this event
    txn_position  = start offset of that GTID event (text)
    segment       = number of GTID events up to and including this one
    query_seq     = seq of the last SQL-text event up to this one (never
                    reset, or per transaction with query_scope="txn")
    rows_before   = row images of earlier row events in the file

Only narrow columns take part: SQL texts, table maps and row images stay
where they are, and are joined by (file, seq) pointers afterwards.

Two physical forms compute the same columns:

* ``method="window"``: one ordered window per file. Simple, but a file is one
  task, so one huge file is one huge sort.
* ``method="carry"`` (default): a scan split into seq buckets. Each
  (file, bucket) runs the window locally; the local state is written once to
  the shared folder (``store=False`` leaves it lazy), a per-bucket summary of
  it is rolled forward over the buckets of a file, and the carry-in is joined
  back on (file, bucket). No task ever holds more than one bucket of a file.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowlog.functions.fingerprint import fingerprint, query_hash
from rowlog.schema import FILE, FIRST_POSITION, ROW_EVENT_TYPES
from rowlog.session import written

SEQ_COLUMNS = ("position", "txn_gtid", "txn_position", "segment", "query_seq", "rows_before")
NARROW = ("seq", "next_position", "event_type", "timestamp", "gtid", "table_id")
DEFAULT_BUCKET = 1 << 20
PLACE_BUCKET = 1 << 16  # numbers of a log whose rows, images and texts meet in one task

_UNB = Window.unboundedPreceding
_CUR = Window.currentRow


def _is(t: str) -> Column:
    return F.col("event_type") == t


def _is_gtid() -> Column:
    return _is("GTID").cast("long")


def _n_rows() -> Column:
    """Row images carried by an event (0 for non-row events)."""
    is_row = F.col("event_type").isin(*ROW_EVENT_TYPES)
    return F.when(is_row, F.coalesce(F.size("rows"), F.lit(0))).otherwise(F.lit(0)).cast("long")


def _marker(pos: Column) -> Column:
    """Transaction marker: GTID opens (gtid, its offset), XID closes."""
    return F.when(
        _is("GTID"),
        F.struct(F.lit(1).alias("k"), F.col("gtid").alias("g"), pos.cast("long").alias("p")),
    ).when(
        _is("XID"),
        F.struct(F.lit(0).alias("k"), F.lit(None).cast("string").alias("g"), F.lit(None).cast("long").alias("p")),
    )


def narrow(events: DataFrame) -> DataFrame:
    """The sequencing input: fixed narrow columns and the number of row images."""
    return events.select(*FILE, *NARROW, _n_rows().alias("n_rows"))


def sequence_events(
    events: DataFrame,
    method: str = "carry",
    bucket_size: int = DEFAULT_BUCKET,
    query_scope: str = "file",
    store: bool = True,
) -> DataFrame:
    """The narrow columns of every raw event, with SEQ_COLUMNS attached."""
    if query_scope not in ("file", "txn"):
        raise ValueError("query_scope must be 'file' or 'txn'")
    ev = narrow(events)
    if method == "window":
        return _by_window(ev, query_scope)
    if method == "carry":
        return _by_carry(ev, int(bucket_size), query_scope, store)
    raise ValueError(f"unknown method {method!r}")


def _text_seq() -> Column:
    """The seq of an event with SQL text."""
    return F.when(_is("ROWS_QUERY"), F.col("seq"))


def _query_mark(segment: str) -> Column:
    """The seq of an event with SQL text, and its segment."""
    return F.when(_text_seq().isNotNull(), F.struct(F.col(segment).alias("s"), F.col("seq").alias("q")))


def _query_seq(mark: Column, query_scope: str) -> Column:
    if query_scope == "file":
        return mark
    return F.when(mark.getField("s") == F.col("segment"), mark.getField("q"))


def _by_window(ev: DataFrame, query_scope: str) -> DataFrame:
    w = Window.partitionBy(*FILE).orderBy("seq")
    before = w.rowsBetween(_UNB, -1)
    upto = w.rowsBetween(_UNB, _CUR)
    s1 = ev.select(
        "*",
        F.lag("next_position", 1, FIRST_POSITION).over(w).alias("position"),
        F.sum(_is_gtid()).over(upto).alias("segment"),
        F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("rows_before"),
    )
    m = F.last(_marker(F.col("position")), ignorenulls=True).over(before)
    q = F.last(_text_seq() if query_scope == "file" else _query_mark("segment"), ignorenulls=True).over(upto)
    return _finish(s1.select("*", m.alias("_m"), q.alias("_qm")), query_scope)


def _finish(df: DataFrame, query_scope: str) -> DataFrame:
    m = F.col("_m")
    return df.select(
        *FILE, *NARROW, "n_rows", "position", "segment", "rows_before",
        F.when(m.getField("k") == 1, m.getField("g")).alias("txn_gtid"),
        F.when(m.getField("k") == 1, m.getField("p").cast("string")).alias("txn_position"),
        _query_seq(F.col("_qm"), query_scope).alias("query_seq"),
    )


def _by_carry(ev: DataFrame, bucket: int, query_scope: str, store: bool) -> DataFrame:
    # Events without a place in a log (null file or seq) belong to no bucket.
    ev = ev.withColumn("_b", F.expr(f"seq div {bucket}")).dropna(subset=[*FILE, "_b"])
    wl = Window.partitionBy(*FILE, "_b").orderBy("seq")
    before, upto = wl.rowsBetween(_UNB, -1), wl.rowsBetween(_UNB, _CUR)
    # A text's segment counts only where texts end with their transaction.
    by_txn = query_scope == "txn"
    moved = _moved if by_txn else (lambda q: q)

    # 1. bucket-local state, up to and with each event, written once. A frame
    # is a pass over the bucket: what was before an event is taken in one, and
    # the event's own share is added to it.
    own = _is_gtid()
    gtids = F.sum(own).over(before)
    l1 = ev.select(
        "*",
        F.last("next_position").over(before).alias("_lag_np"),
        F.lead(F.lit(1)).over(wl).isNull().alias("_end"),
        F.coalesce(gtids + own, gtids, own).alias("_seg_l"),
        F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("_rows_l"),
        *([] if by_txn else [F.coalesce(_text_seq(), F.last(_text_seq(), ignorenulls=True).over(before)).alias("_q_l")]),
    )
    marker = _marker(F.col("_lag_np"))
    local = l1.select(
        "*",
        F.last(marker, ignorenulls=True).over(before).alias("_m_l"),
        *([F.last(_query_mark("_seg_l"), ignorenulls=True).over(upto).alias("_q_l")] if by_txn else []),
    )
    if store:
        local = written(local, "sequence")

    # 2. one summary row per (file, bucket), the state after its last event,
    # rolled forward over the file
    summary = local.where("_end").select(
        *FILE, "_b", "next_position", F.coalesce(marker, F.col("_m_l")).alias("_m_u"), "_seg_l",
        (F.col("_rows_l") + F.col("n_rows")).alias("rows"), "_q_l")
    ws = Window.partitionBy(*FILE).orderBy("_b")
    ws_before = ws.rowsBetween(_UNB, -1)
    s1 = summary.select(
        "*",
        F.lag("_b").over(ws).isNull().alias("_first"),
        F.lag("next_position").over(ws).alias("_carry_np"),
        F.coalesce(F.sum("_seg_l").over(ws_before), F.lit(0)).alias("_carry_seg"),
        F.coalesce(F.sum("rows").over(ws_before), F.lit(0)).alias("_carry_rows"),
    )
    s2 = s1.withColumn("_rm", _settled(F.col("_m_u"))).withColumn("_rq", moved(F.col("_q_l")))
    carry = s2.select(
        *FILE, "_b", "_first", "_carry_np", "_carry_seg", "_carry_rows",
        F.last("_rm", ignorenulls=True).over(ws_before).alias("_carry_m"),
        F.last("_rq", ignorenulls=True).over(ws_before).alias("_carry_q"),
    ).where(~F.col("_first")).drop("_first")

    if store:
        carry = written(carry, "carry")

    # 3. carry-in joined back on (file, bucket). A file's first bucket has
    # none, so the carry side is small: a row for each full bucket, not each file.
    none = F.lit(0).cast("long")
    j = local.join(carry, [*FILE, "_b"], "left").withColumns({
        "_carry_seg": F.coalesce("_carry_seg", none), "_carry_rows": F.coalesce("_carry_rows", none)})
    first = F.lit(FIRST_POSITION).cast("long")
    out = j.withColumns({
        "position": F.coalesce(F.col("_lag_np"), F.col("_carry_np"), first),
        "segment": F.col("_carry_seg") + F.col("_seg_l"),
        "rows_before": F.col("_carry_rows") + F.col("_rows_l"),
        "_m": F.coalesce(_settled(F.col("_m_l")), F.col("_carry_m")),
        "_qm": F.coalesce(moved(F.col("_q_l")), F.col("_carry_q")),
    })
    return _finish(out, query_scope)


def _settled(m: Column) -> Column:
    """A local marker with its offset: that of a bucket's first event is the
    end of the bucket before."""
    p = F.coalesce(m.getField("p"), F.col("_carry_np"), F.lit(FIRST_POSITION).cast("long"))
    return F.when(m.isNotNull(), F.struct(m.getField("k").alias("k"), m.getField("g").alias("g"), p.alias("p")))


def _moved(q: Column) -> Column:
    """A local SQL-text mark with its segment counted from the file's start."""
    return F.when(q.isNotNull(), F.struct((F.col("_carry_seg") + q.getField("s")).alias("s"), q.getField("q").alias("q")))


def by_place(df: DataFrame) -> DataFrame:
    """Deal rows that have a `seq` to tasks by (file, `_place`), a range of
    numbers. Images and SQL texts, joined by place and number, then meet the
    rows where they are: the rows move once, and no task has more than a few
    ranges, whatever share of a log one statement has."""
    return df.withColumn("_place", _place("seq")).repartition(*FILE, "_place")


def _place(seq: str) -> Column:
    return F.expr(f"{seq} div {PLACE_BUCKET}")


def with_images(seq: DataFrame, raw: DataFrame) -> DataFrame:
    """One row for each row image (`image`, numbered `row_idx`) of each row
    event; events without images give none. `seq` is `by_place`. The images of
    an event are taken apart before they move: where only the rows are wanted,
    as for counts, their cells stay behind."""
    images = raw.where(F.col("event_type").isin(*ROW_EVENT_TYPES)).select(
        *FILE, _place("seq").alias("_place"), "seq", F.posexplode("rows").alias("row_idx", "image"))
    return seq.join(images, [*FILE, "_place", "seq"], "inner").drop("_place")


def outside_texts(seq: DataFrame) -> DataFrame:
    """The SQL texts that events of other places point to, with these places.
    A place has at most one such text, the one its log had when the place
    began, so they are few; where places hold whole logs, none."""
    place = _place("seq")
    outside = seq.where(place != _place("query_seq")).select(*FILE, "query_seq", place.alias("place"))
    return outside.groupBy(*FILE, "query_seq").agg(F.collect_set("place").alias("places"))


def with_query_text(
    seq: DataFrame, raw: DataFrame, fingerprints: bool = False, outside: DataFrame | None = None, all_inside: bool = False,
) -> DataFrame:
    """Attach the SQL text that `query_seq` points to (`last_query`), and with
    fingerprints its shape and hash, computed once for each SQL-text event and
    place. Texts are joined in the place of the rows that point to them;
    `outside_texts` (which `outside` gives, if they are known) are copied.
    The rows keep their `_place`."""
    if "_place" not in seq.columns:
        seq = seq.withColumn("_place", _place("seq"))
    texts = raw.where(_is("ROWS_QUERY")).select(*FILE, F.col("seq").alias("query_seq"), F.col("query").alias("last_query"))
    own = _place("query_seq")
    if all_inside:
        texts = texts.withColumn("_place", own)
    else:
        texts = texts.join(F.broadcast(outside_texts(seq) if outside is None else outside), [*FILE, "query_seq"], "left")
        every = F.concat(F.array(own), F.coalesce("places", F.array().cast("array<bigint>")))
        texts = texts.select(*FILE, "query_seq", "last_query", F.explode(every).alias("_place"))
    if fingerprints:
        texts = texts.withColumn("query_fingerprint", fingerprint("last_query")).withColumn("query_hash", query_hash("query_fingerprint"))
    return seq.join(texts, [*FILE, "_place", "query_seq"], "left")


def resolve_table_maps(seq: DataFrame, raw: DataFrame, missing: str = "fail") -> DataFrame:
    """Attach the table map to each row event: the *last* TABLE_MAP with the
    same table id in the event's GTID segment, even one after the row event
    (the dictionary is replaced only at GTID and read after the whole pass).

    The sequence gives each (file, segment, table_id) the seq of its last map;
    names and columns are joined from the raw events by that pointer. A hot
    key is split by AQE's skew join instead of pinning one task. missing:
    "fail" raises on a row event without a map, "null" keeps it with null
    table and images.
    """
    if missing not in ("fail", "null"):
        raise ValueError("missing must be 'fail' or 'null'")
    key = [*FILE, "segment", "table_id"]
    last = seq.where(_is("TABLE_MAP")).groupBy(*key).agg(F.max("seq").alias("map_seq"))
    maps = raw.where(_is("TABLE_MAP")).select(*FILE, F.col("seq").alias("map_seq"), F.struct("db", "tbl", "column_names").alias("map"))
    # Maps meet their last pointers before the rows do, so the rows move once.
    last = last.join(maps, [*FILE, "map_seq"], "left").select(*key, "map")
    rows = seq.where(F.col("event_type").isin(*ROW_EVENT_TYPES))
    j = rows.join(last, key, "left")
    mp = F.col("map")
    if missing == "fail":
        at = F.concat_ws(":", "binarylog", F.col("position").cast("string"))
        mp = F.when(mp.isNull(), F.raise_error(F.concat(F.lit("no table map for table id "), F.col("table_id").cast("string"), F.lit(" at "), at))).otherwise(mp)
    return j.select(
        *[c for c in j.columns if c != "map"],
        mp.getField("db").alias("db"),
        mp.getField("tbl").alias("tbl"),
        mp.getField("column_names").alias("column_names"),
    )
