"""URL filter: rules first, then gradient-boosted trees, in DataFrame functions only.

URLs that a rule decides are the labelled ones. Boosted trees of depth
`DEPTH` learn from them, on lexical features (length, depth, digit ratio,
entropy, parameters, hyphens, and how often labelled hosts of the same
suffix are blocked), and judge the rest.

Fitting reads at most `max_rows` labelled URLs (a documented bound, taken by
hash of the id). Each level of a tree is one aggregation, the gradient
histogram by (node, feature, bin), of which the driver sees at most
nodes x features x bins rows. The model is an expression of nested
conditions, so scoring stays in generated code, without any shuffle. Suffix
statistics cover all labelled URLs; suffixes are hashed to SUFFIX_BUCKETS
buckets, so the broadcast table has a fixed bound.

Edge cases: a null url, or one without "://", has an empty host and path,
no rule, and is judged by the model like any other; without labelled URLs of
both verdicts the smoothed share of blocked ones decides.
"""
from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowlog.llm.common import ascii_lower, landed

# Fixed values: (verdict, host, path prefix).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
MAX_ROWS = 20_000
TREES, DEPTH, RATE, BINS, RIDGE = 10, 3, 0.4, 16, 1.0
SUFFIX_BUCKETS = 1024
SMOOTH = 20.0
FEATURES = ["f_length", "f_host_length", "f_depth", "f_digits", "f_entropy", "f_params", "f_hyphens", "f_labels", "f_suffix", "f_suffix2"]


def parsed(pages: DataFrame, id_col: str, url_col: str) -> DataFrame:
    """page_id, url, host, path."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.substring("url", at + 3, F.length("url"))).otherwise(F.lit(""))
    rows = rows.withColumn("rest", F.coalesce(rest, F.lit("")))
    return rows.select(
        "page_id", "url",
        ascii_lower(F.regexp_extract("rest", r"\A([^/?#]*)", 1)).alias("host"),
        F.regexp_extract("rest", r"\A[^/?#]*([^?#]*)", 1).alias("path"),
    )


def decided(rows: DataFrame, rules=RULES) -> DataFrame:
    """Adds rule (its text, or null) and ruled (block or allow, or null)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, host, path in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):  # the longest is tested first
        fits = ((F.col("host") == host) | F.endswith("host", F.lit(f".{host}"))) & F.startswith("path", F.lit(path))
        rule, verdict = F.when(fits, F.lit(host + path)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rows.withColumn("rule", rule).withColumn("ruled", verdict)


def _suffix_bucket(labels: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(labels), F.substring_index("host", ".", -labels)), F.lit(SUFFIX_BUCKETS)).cast("int")


def _entropy(c: Column) -> Column:
    n = F.length(c).cast("double")
    share = F.transform(F.array_distinct(F.split(c, "")), lambda x: F.when(x == "", F.lit(0.0)).otherwise(
        (n - F.length(F.replace(c, x))) / n))
    return F.when(n > 0, F.aggregate(share, F.lit(0.0), lambda a, p: F.when(p > 0, a - p * F.log2(p)).otherwise(a))).otherwise(F.lit(0.0))


def lexical(rows: DataFrame) -> DataFrame:
    url = F.coalesce("url", F.lit(""))
    n = F.length(url)
    count = lambda c, x: (F.length(c) - F.length(F.replace(c, F.lit(x)))).cast("double")
    query = F.when(F.instr(url, "?") > 0, F.substring_index(url, "?", -1)).otherwise(F.lit(""))
    return rows.withColumns({
        "f_length": n.cast("double"),
        "f_host_length": F.length("host").cast("double"),
        "f_depth": count(F.col("path"), "/"),
        "f_digits": F.length(F.regexp_replace(url, "[^0-9]", "")) / F.greatest(n, F.lit(1)),
        "f_entropy": _entropy(url),
        "f_params": F.when(query == "", F.lit(0.0)).otherwise(count(query, "&") + 1),
        "f_hyphens": count(F.col("host"), "-"),
        "f_labels": count(F.col("host"), "."),
        "s1": _suffix_bucket(1), "s2": _suffix_bucket(2),
    })


@dataclass
class Tree:
    """Inner nodes (feature, cut, left, right); leaves are values."""
    node: tuple | float

    def value(self) -> Column:
        def walk(n) -> Column:
            if not isinstance(n, tuple):
                return F.lit(float(n))
            return F.when(F.col(n[0]) <= F.lit(float(n[1])), walk(n[2])).otherwise(walk(n[3]))

        return walk(self.node)


@dataclass
class Model:
    base: float
    prior: float
    suffixes: DataFrame | None = None
    trees: list[Tree] = field(default_factory=list)

    def margin(self) -> Column:
        out = F.lit(self.base)
        for t in self.trees:
            out = out + t.value()
        return out


def suffix_statistics(labelled: DataFrame) -> tuple[DataFrame, float, int, int]:
    """(level, bucket) -> smoothed share of blocked URLs; the whole share; counts."""
    each = labelled.select("y", F.explode(F.array(
        F.struct(F.lit(0).alias("level"), F.lit(0).alias("bucket")),
        F.struct(F.lit(1).alias("level"), F.col("s1").alias("bucket")),
        F.struct(F.lit(2).alias("level"), F.col("s2").alias("bucket")))).alias("s"))
    counts = landed(each.groupBy("s.level", "s.bucket").agg(F.count("*").alias("n"), F.sum("y").alias("blocked")), "suffixes")
    total = counts.where("level = 0").first()
    n, blocked = (total["n"], int(total["blocked"])) if total else (0, 0)
    prior = (blocked + 1) / (n + 2)
    table = counts.where("level > 0").withColumn("share", (F.col("blocked") + SMOOTH * prior) / (F.col("n") + SMOOTH))
    return table.select("level", "bucket", "share"), prior, n, blocked


def with_suffixes(rows: DataFrame, suffixes: DataFrame | None, prior: float) -> DataFrame:
    if suffixes is None:
        return rows.withColumn("f_suffix", F.lit(prior)).withColumn("f_suffix2", F.lit(prior))
    for level, name in ((1, "f_suffix"), (2, "f_suffix2")):
        # At most SUFFIX_BUCKETS rows: a proven bound for the broadcast.
        part = suffixes.where(F.col("level") == level).select(F.col("bucket").alias(f"s{level}"), F.col("share").alias(name))
        rows = rows.join(F.broadcast(part), f"s{level}", "left").withColumn(name, F.coalesce(name, F.lit(prior)))
    return rows


def _grow(data: DataFrame, cuts: dict[str, list[float]], trees: list[Tree], base: float) -> Tree:
    """One tree by levels; each level is one aggregation over the sample."""
    p = 1 / (1 + F.exp(-Model(base, 0.5, None, trees).margin()))
    rows = data.select("y", *FEATURES, p.alias("p")).select(
        *FEATURES, (F.col("y") - F.col("p")).alias("g"), (F.col("p") * (1 - F.col("p"))).alias("h"))
    bins = F.array(*(
        F.struct(F.lit(i).alias("f"), sum((F.col(name) > F.lit(c)).cast("int") for c in cuts[name]).alias("b") if cuts[name] else F.lit(0).alias("b"))
        for i, name in enumerate(FEATURES)))
    splits: dict[int, tuple[str, float]] = {}
    values: dict[int, float] = {}

    def place(node: int) -> Column:
        if node not in splits:
            return F.lit(node)
        name, cut = splits[node]
        return F.when(F.col(name) <= F.lit(cut), place(2 * node)).otherwise(place(2 * node + 1))

    for level in range(DEPTH + 1):
        each = rows.select(place(1).alias("node"), "g", "h", F.explode(bins).alias("x"))
        hist: dict[int, dict[int, dict[int, tuple[float, float]]]] = {}
        for r in each.groupBy("node", "x.f", "x.b").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():
            hist.setdefault(r["node"], {}).setdefault(r["f"], {})[r["b"]] = (r["g"], r["h"])
        for node in sorted(hist):
            if node < 2 ** level:
                continue
            g, h = (math.fsum(x[k] for x in hist[node][0].values()) for k in range(2))
            values[node] = RATE * g / (h + RIDGE)
            best = None
            for f, name in enumerate(FEATURES):
                gl = hl = 0.0
                for b in range(len(cuts[name])):
                    dg, dh = hist[node][f].get(b, (0.0, 0.0))
                    gl, hl = gl + dg, hl + dh
                    gain = gl ** 2 / (hl + RIDGE) + (g - gl) ** 2 / (h - hl + RIDGE) - g ** 2 / (h + RIDGE)
                    if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                        best = (gain, name, cuts[name][b])
            if best is not None and level < DEPTH:
                splits[node] = best[1:]
        if not any(2 ** level <= n < 2 ** (level + 1) for n in splits):
            break

    def tree(node: int):
        if node not in splits:
            return values.get(node, 0.0)
        return (*splits[node], tree(2 * node), tree(2 * node + 1))

    return Tree(tree(1))


def fit(rows: DataFrame, max_rows: int = MAX_ROWS, trees: int = TREES) -> Model:
    """The model for `lexical` rows with `ruled`."""
    labelled = rows.where("ruled is not null").withColumn("y", (F.col("ruled") == "block").cast("int"))
    suffixes, prior, n, blocked = suffix_statistics(labelled.select("y", "s1", "s2"))
    base = math.log(prior / (1 - prior))
    if not blocked or blocked == n:
        return Model(base, prior)
    chosen = labelled.orderBy(F.xxhash64("page_id", "url"), "page_id").limit(max_rows)
    data = landed(with_suffixes(chosen, suffixes, prior).select("y", *FEATURES), "url-sample")
    q = [i / BINS for i in range(1, BINS)]
    found = data.agg(*(F.percentile_approx(f, q, 1000).alias(f) for f in FEATURES)).first()
    cuts = {f: sorted(set(found[f])) for f in FEATURES}
    model = Model(base, prior, suffixes)
    for _ in range(trees):
        model.trees.append(_grow(data, cuts, model.trees, base))
    return model


def judge(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, max_rows: int = MAX_ROWS, trees: int = TREES,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score (blocked
    share the model expects; the verdict of URLs without a rule)."""
    rows = lexical(decided(parsed(pages, id_col, url_col), rules))
    model = fit(rows, max_rows, trees)
    scored = with_suffixes(rows, model.suffixes, model.prior).withColumn("score", 1 / (1 + F.exp(-model.margin())))
    verdict = F.coalesce("ruled", F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
