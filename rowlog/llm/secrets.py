"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Base kinds (assign, access, hex) are found by fixed patterns. On top of them
the method proposes `token` candidates: long runs of key characters that mix
letters and digits and touch no base span. Every candidate value, base ones
included, is hashed, and the hashes are aggregated over the whole corpus by
distinct repositories and owners. A value that many owners hold is a widely
copied example; one that stays with few owners is a live-looking credential.
`token` spans are reported only when live-looking; base spans always stay.

Positions come from cutting a text at its matches: the lengths of the pieces
and of the matches, summed up, give code-point offsets.

Scale: texts are read once, and only spans and hashes go on. Ownership is
counted in two partial aggregations ((hash, repository, owner), then hash),
so a value in a third of all documents is one small row per task. Verdicts
return to the spans by a plain equi-join that adaptive execution may split
on a hot value.

Edge cases: null and empty texts have no spans; a null owner or repository
counts as one unnamed owner or repository; repeated doc_ids are rows of
their own.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowlog.llm.common import landed

# The base kinds, in order, and their patterns. Groups: whole match 0, value.
KINDS = ("assign", "access", "hex", "token")


def _either(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_KEYWORDS = "|".join(map(_either, ("password", "passwd", "secret", "token", "api_?key")))
PATTERNS = {
    "assign": rf"""({_KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]{16,}",  # a run under 20 characters holds no longer one
    "hex": "[0-9a-f]{24,}",
    "token": "[A-Za-z0-9+/_=-]{20,}",
}
SHORTEST_ASSIGN = 6
# A value held by at least this many owners is an example.
EXAMPLE_OWNERS = 3

SPAN = "struct<start:int,kind:int,end:int,value:string>"


def _spans(text: Column, kind: str) -> Column:
    """array<SPAN> of a pattern's matches, in order."""
    pattern = PATTERNS[kind]
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if kind == "assign" else whole
    pieces = F.split(text, pattern, -1)
    found = F.arrays_zip(F.transform(pieces, F.length).alias("gap"), whole.alias("m"), value.alias("v"))
    order = F.lit(KINDS.index(kind))
    state = F.aggregate(
        F.filter(found, lambda x: x["m"].isNotNull()),
        F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + F.length(x["m"])).alias("at"),
            F.array_append(acc["out"], F.struct(
                (acc["at"] + x["gap"]).alias("start"), order.alias("kind"),
                (acc["at"] + x["gap"] + F.length(x["m"])).alias("end"), x["v"].alias("value"))).alias("out"),
        ),
    )["out"]
    return F.when(text.rlike(pattern), state).otherwise(F.array().cast(f"array<{SPAN}>"))


def candidates(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo_cols: tuple[str, ...]) -> DataFrame:
    """row_id, doc_id, owner, repo, base (kept base spans), tokens (proposed spans)."""
    null = F.lit("\0")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(owner_col).cast("string"), null).alias("owner"),
        F.concat_ws("/", *(F.coalesce(F.col(c).cast("string"), null) for c in repo_cols)).alias("repo"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    text = F.col("text")
    found = rows.select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id", "owner", "repo",
        _spans(text, "assign").alias("assign"), _spans(text, "access").alias("access"),
        _spans(text, "hex").alias("hex"), _spans(text, "token").alias("token"),
    )
    base = F.array_sort(F.concat(F.filter("assign", lambda s: F.length(s["value"]) >= SHORTEST_ASSIGN), F.col("access"), F.col("hex")))
    mixed = F.filter("token", lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]"))
    return found.withColumn("base", base).withColumn("mixed", mixed).select(
        "row_id", "doc_id", "owner", "repo", "base",
        F.filter("mixed", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))).alias("tokens"),
    )


def ownership(cands: DataFrame, example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """value_hash -> n_docs, n_repos, n_owners, live, over all candidates of the corpus."""
    per = cands.groupBy("value_hash", "repo", "owner").agg(F.count("*").alias("n"))
    return per.groupBy("value_hash").agg(
        F.sum("n").alias("n_found"), F.countDistinct("repo").alias("n_repos"), F.countDistinct("owner").alias("n_owners"),
    ).withColumn("live", F.col("n_owners") < example_owners)


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
    repo_cols: tuple[str, ...] = ("source", "lang"), example_owners: int = EXAMPLE_OWNERS,
) -> DataFrame:
    """One row per document: doc_id, base and spans (arrays of start, kind,
    end, value; `spans` holds `base` and the live tokens), n_live, n_example."""
    rows = landed(candidates(docs, id_col, text_col, owner_col, repo_cols), "secrets")
    each = rows.select(
        "row_id", "owner", "repo", F.explode(F.concat("base", "tokens")).alias("s"),
    ).withColumn("value_hash", F.sha2(F.col("s.value").cast("binary"), 256))
    judged = each.select("row_id", "s", "value_hash").join(
        ownership(each, example_owners).select("value_hash", "live"), "value_hash")
    per_row = judged.groupBy("row_id").agg(
        F.collect_list(F.when(F.col("live") & (F.col("s.kind") == KINDS.index("token")), F.col("s"))).alias("added"),
        F.count(F.when(F.col("live"), 1)).alias("n_live"), F.count(F.when(~F.col("live"), 1)).alias("n_example"),
    )
    none = F.array().cast(f"array<{SPAN}>")
    return rows.join(per_row, "row_id", "left").select(
        "doc_id", "base", F.array_sort(F.concat("base", F.coalesce("added", none))).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_example", F.lit(0)).alias("n_example"),
    )


def _text(spans: str) -> Column:
    kind = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kind, s["kind"] + 1), s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long")

    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(_text("base").cast("binary"), 256).alias("base_sha256"), _text("spans").alias("spans"), "n_live", "n_example",
    )
