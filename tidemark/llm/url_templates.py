"""URL filters: explicit host and path rules, and a tree of path templates.

For the pages no rule decides, each host's paths form a tree.  Level by level,
to the end of the deepest path,
segments that vary are generalised into a wildcard (its file extension stays),
and literal branches that statistics cannot tell from their siblings, by their
labels or by how many paths end in them, are merged.  A template is rejected
when its labelled purity is low, smoothed towards that of all labelled pages
(but not below one half: rules list the bad more often than the good, and a
template without labels is no evidence).  The labels are the verdicts of the
rules.

All steps are aggregates and joins on (host, node, segment); no host is ever
gathered in one task.  A level reads only the pages whose paths go on, and a
stretch that all pages of a node share is passed in one step.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import run_folder

MAX_DEPTH = 8               # levels the SQL check spells out; judge() has no such bound
MIN_KINDS = 8               # children a varying position has at least
RARE_SHARE = 20             # a varying child has at most one in so many of its parent's pages
CHI_SQUARE = 3.84           # siblings within this of the pooled share are alike (5 %)
PRIOR_WEIGHT = 4.0          # labelled pages that the prior counts for
LEAST_PRIOR = 0.5
REJECT_BELOW = 0.5
MAX_RULES = 1000            # the rules are part of the plan; more belong in a table
ANY, ALIKE = "*", "~"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str            # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def parse_rules(lines: list[str]) -> list[Rule]:
    """``"block example.org/es/"`` and the like; a host without a path gets ``/``."""
    out = []
    for line in lines:
        verdict, place = line.split(" ", 1)
        host, slash, path = place.partition("/")
        if verdict not in ("allow", "block"):
            raise ValueError(f"unknown verdict in rule {line!r}")
        out.append(Rule(verdict, host.translate(str.maketrans(_UPPER, _LOWER)), "/" + path))
    return out


def with_parts(pages: DataFrame) -> DataFrame:
    """``(page_id, host, path)``; both are empty where the url is null or has no ``://``."""
    rest = F.when(F.instr("url", "://") > 0,
                  F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    parts = pages.select("page_id", F.coalesce(rest, F.lit("")).alias("rest"))
    raw = F.regexp_extract("rest", r"^[^/?#]*", 0)
    return parts.select(
        "page_id", F.translate(raw, _UPPER, _LOWER).alias("host"),
        F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1).alias("path"))


def matching_rule(rules: list[Rule], what: str) -> Column:
    """``name`` or ``verdict`` of the longest rule that fits ``host`` and ``path``;
    of rules equally long, one that blocks."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    found = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.verdict == "block", r.name)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) \
            & F.col("path").startswith(r.path)
        found = F.when(fits, getattr(r, what)).otherwise(found)
    return found


def _alike(part: Column, whole: Column, all_part: Column, all_whole: Column) -> Column:
    """Whether a share is within chance of the pooled one (two-proportion test)."""
    pooled = all_part / all_whole
    spread = pooled * (1 - pooled) * (1 / whole + 1 / all_whole)
    gap = part / whole - pooled
    return F.when((whole == 0) | (all_whole == 0) | (all_part == 0) | (all_part == all_whole),
                  True).otherwise(gap * gap <= CHI_SQUARE * spread)


def _opaque(key: str) -> Column:
    """The same text, hidden from the planner's partitioning (see ``common.unaligned``)."""
    return F.concat(F.col(key), F.lit("")).alias(key)


def _grow(live: DataFrame) -> DataFrame:
    """Move the first of the segments each page has left (``segs``) as a label to
    its node; where a node has one child only, with the segments that all of the
    child's pages go on with."""
    first, more = F.get("segs", F.lit(0)), F.expr("slice(segs, 2, size(segs))")
    live = live.withColumn("seg", first)
    one = live.select(
        "host", "node", "seg", F.lit(1).cast("long").alias("n"),
        (F.col("label") == 1).cast("long").alias("good"),
        (F.col("label") == 0).cast("long").alias("bad"),
        (F.size("segs") == 1).cast("long").alias("ends"), more.alias("more")).fillna(0)
    counts = [F.sum(c).alias(c) for c in ("n", "good", "bad", "ends")]
    kids = one.groupBy("host", "node", "seg").agg(
        *counts, F.min("more").alias("low"), F.max("more").alias("high"))
    pool = kids.groupBy("host", "node").agg(
        F.count("*").alias("kinds"),
        *[F.sum(c).alias(f"all_{c}") for c in ("n", "good", "bad", "ends")]).select(
        "host", _opaque("node"), "kinds", *[f"all_{c}" for c in ("n", "good", "bad", "ends")])
    c = F.col
    varies = (c("kinds") >= MIN_KINDS) & (c("n") * RARE_SHARE <= c("all_n"))
    alike = _alike(c("good"), c("good") + c("bad"), c("all_good"), c("all_good") + c("all_bad")) \
        & _alike(c("ends"), c("n"), c("all_ends"), c("all_n"))
    extension = F.regexp_extract("seg", r"\.[A-Za-z0-9]{1,5}$", 0)
    # What the smallest and the largest start with, all between them start with.
    differ = F.expr("array_position(zip_with(low, high, (a, b) -> a <=> b), false)").cast("int")
    same = F.when(c("kinds") > 1, 0).when(differ > 0, differ - 1).otherwise(F.size("low"))
    label = F.when(varies, F.concat(F.lit(ANY), extension)).when(
        (c("kinds") > 1) & alike, F.lit(ALIKE)).otherwise(
        F.concat_ws("/", F.array("seg"), F.slice("low", F.lit(1), same)))
    named = kids.join(pool, ["host", "node"]).select(
        "host", "node", _opaque("seg"), label.alias("to"), (same + 1).alias("taken"))
    return live.join(named, ["host", "node", "seg"]).select(
        "page_id", "host", "path", "label", "rule",
        F.expr("slice(segs, taken + 1, size(segs))").alias("segs"),
        F.concat(c("node"), F.lit("/"), c("to")).alias("node"))


def _grown(rows: DataFrame) -> DataFrame:
    """``rows`` with the whole template as ``node``.  Each level is written to a
    folder of its own; a page is done in the level that leaves it no segments."""
    spark, folder = rows.sparkSession, run_folder(rows.sparkSession, "url-rows")
    levels = [f"{folder}/0"]
    rows.write.parquet(levels[0])
    while True:
        last = spark.read.schema(rows.schema).parquet(levels[-1])
        if not last.agg(F.max(F.size("segs"))).first()[0]:
            break
        levels.append(f"{folder}/{len(levels)}")
        _grow(last.where(F.size("segs") > 0)).write.parquet(levels[-1])
    return spark.read.schema(rows.schema).parquet(*levels).where(F.size("segs") == 0)


def judge(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """``(page_id, host, path, rule, template, verdict)``, a row per page.

    Null urls and urls without ``://`` have an empty host and path.  Pages of
    templates without labels are allowed.  Null and repeated ids are judged row
    by row; an empty table gives no rows; further columns are ignored."""
    parts = with_parts(pages)
    by_rule = matching_rule(rules, "verdict")
    rows = _grown(parts.select(
        "page_id", "host", "path",
        F.when(by_rule == "allow", 1).when(by_rule == "block", 0).alias("label"),
        matching_rule(rules, "name").alias("rule"),
        F.when(F.col("path") == "", F.array().cast("array<string>")).otherwise(
            F.split(F.expr("substring(path, 2)"), "/", -1)).alias("segs"),
        F.lit("").alias("node")))
    first = rows.agg(F.sum(F.col("label")), F.count("label")).first()
    prior = max(LEAST_PRIOR, first[0] / first[1]) if first[1] else 1.0
    good, labelled = F.sum(F.col("label")), F.count("label")
    purity = (F.coalesce(good, F.lit(0)) + PRIOR_WEIGHT * prior) / (labelled + PRIOR_WEIGHT)
    reject = rows.groupBy("host", "node").agg((purity < REJECT_BELOW).alias("reject")).select(
        "host", _opaque("node"), "reject")
    verdict = F.when(F.col("label") == 1, "allow").when(F.col("label") == 0, "block").when(
        F.col("reject"), "block").otherwise("allow")
    return rows.join(reject, ["host", "node"]).select(
        "page_id", "host", "path", "rule", F.col("node").alias("template"),
        verdict.alias("verdict"))
