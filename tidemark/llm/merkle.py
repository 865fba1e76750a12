"""Merkle manifest of a dataset as a content-addressed DAG.

Every row is a leaf; the leaves of a group (a language) form a tree of runs of
``FANOUT`` nodes, and the groups' subroots form one more tree up to the root.
The store holds records ``digest -> children``, each ``SEGMENT`` levels deep and
found by nothing but its digest.  Proofs come from descent: all leaf requests
start at the root, requests with a common rank prefix travel as one, and at
each record a request's rank digits select a child while the unselected
children of its runs are collected.  The path, collected from the top, is
reversed for folding.

Ranks come from a range partitioning and per-partition counts, so no group is
ordered in one task however many rows it has; a record is built from at most
``FANOUT ** SEGMENT`` nodes.  DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged
from tidemark.operators.joins import broadcast_if_small

FANOUT = 2          # nodes of a run, which become one node
SEGMENT = 8         # levels held by one record
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_DIVISOR = 7


def digest_of(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenated texts."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field_text(value: Column) -> Column:
    """A field inside a leaf: ``-`` for null, else its size in bytes, ``:`` and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**changed: Column) -> Column:
    """A row's leaf digest; ``changed`` replaces the value of a field."""
    return digest_of(*[field_text(changed.get(c, F.col(c))) for c in FIELDS])


def group_key(lang: Column) -> Column:
    """A group as text that sorts as the groups do: null first, then by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), lang), F.lit("-"))


def ranked(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``rank`` (from 0, by ``order``) and ``n``, the rows of the group.

    Rows that ``order`` does not tell apart are spread over partitions by where
    they stood in the input."""
    keys = [group, *order, "_at"]
    place = F.monotonically_increasing_id()
    rows = staged(rows.withColumn("_at", place)
                  .repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_at")
                  .withColumns({"_part": F.shiftright(place, 33),
                                "_place": place.bitwiseAND(F.lit((1 << 33) - 1))}), name)
    counts = rows.groupBy("_part", group).agg(F.min("_place").alias("_first"),
                                              F.count("*").alias("_n"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", group, "_first",
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                            F.sum("_n").over(whole).alias("n"))
    return rows.join(broadcast_if_small(offsets), ["_part", group]).withColumn(
        "rank", F.col("_place") - F.col("_first") + F.col("_before")).drop(
        "_part", "_place", "_first", "_before")


# ---- building the store -----------------------------------------------------------------
def _parents(nodes: Column, fanout: int) -> Column:
    last = F.ceil(F.size(nodes) / fanout).cast("int") - 1
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.sha2(
        F.array_join(F.slice(nodes, i * fanout + 1, fanout), "").cast("binary"), 256))


def _records(nodes: DataFrame, fanout: int, segment: int) -> DataFrame:
    """``(grp, rank, n, digest, levels)`` of the nodes above ``nodes(grp, rank, n,
    digest)``, ``segment`` levels up, or at the top of a group that ends before:
    the levels below the new node, lowest first."""
    width = fanout ** segment
    block = nodes.groupBy("grp", F.floor(F.col("rank") / width).alias("rank"), "n").agg(
        F.array_sort(F.collect_list(F.struct("rank", "digest"))).alias("run"))
    ended = lambda levels: (F.col("n") <= width) & (F.size(F.element_at(levels, -1)) == 1)
    levels = F.aggregate(
        F.sequence(F.lit(1), F.lit(segment)), F.array(F.col("run.digest")),
        lambda acc, _k: F.when(ended(acc), acc).otherwise(
            F.concat(acc, F.array(_parents(F.element_at(acc, -1), fanout)))))
    return block.select("grp", "rank", "n", levels.alias("levels")).select(
        "grp", "rank", F.ceil(F.col("n") / width).alias("n"),
        F.element_at(F.element_at("levels", -1), 1).alias("digest"),
        F.expr("slice(levels, 1, size(levels) - 1)").alias("levels"))


def build(nodes: DataFrame, fanout: int = FANOUT, segment: int = SEGMENT,
          name: str = "merkle") -> tuple[DataFrame, list[DataFrame]]:
    """The top node ``(grp, digest)`` of every group of ``nodes(grp, rank, n,
    digest)``, and the store's records ``(digest, levels)``, each digest once."""
    tops = nodes.where("n = 1").select("grp", "digest")
    stores = []
    rest = nodes.where("n > 1")
    while not rest.isEmpty():
        made = staged(_records(rest, fanout, segment), f"{name}-nodes")
        stores.append(staged(made.groupBy("digest").agg(
            F.any_value("levels").alias("levels")), f"{name}-records"))
        above = made.select("grp", "rank", "n", "digest")
        tops = tops.unionByName(above.where("n = 1").select("grp", "digest"))
        rest = above.where("n > 1")
    return tops, stores


# ---- descent ------------------------------------------------------------------------------
STEP = "struct<before:string,after:string>"     # unselected children of a run


def _segment_path(fanout: int, digit: Column) -> Column:
    """The steps from a record's node down to its child ``digit``, top first."""
    def step(k: Column) -> Column:
        at = F.floor(digit / F.pow(F.lit(float(fanout)), k)).cast("int")
        run = F.slice(F.element_at("levels", k + 1), at - at % fanout + 1, fanout)
        own = at % fanout
        return F.struct(F.array_join(F.slice(run, 1, own), "").alias("before"),
                        F.array_join(F.slice(run, own + 2, fanout), "").alias("after"))
    return F.transform(F.sequence(F.size("levels") - 1, F.lit(0), F.lit(-1)), step)


def descend(start: DataFrame, requests: DataFrame, stores: list[DataFrame],
            fanout: int = FANOUT, segment: int = SEGMENT) -> DataFrame:
    """Every row of ``requests(grp, rank, n, ...)`` with ``digest`` (the leaf found
    at its rank), ``path`` (steps from the root, top first) and what ``start(grp,
    digest, path, root, ...)`` holds for its group.  A digest without a record
    ends the job."""
    width = fanout ** segment
    kept = [c for c in start.columns if c not in ("grp", "digest", "path")]
    here = start.withColumn("prefix", F.lit(0).cast("long"))
    for s in range(len(stores) - 1, -1, -1):
        span = width ** s
        wants = requests if s == 0 else requests.select(
            "grp", "n", F.floor(F.col("rank") / span).cast("long").alias("rank")).distinct()
        wants = wants.withColumn("prefix", F.floor(F.col("rank") / width).cast("long"))
        # A group of fewer nodes has no record on this level: its requests pass.
        found = here.join(stores[s], "digest", "left")
        digit = (F.col("rank") % width).cast("int")
        met = wants.join(found, ["grp", "prefix"])
        active = F.col("n") > span
        lost = F.raise_error(F.concat(F.lit("no record of digest "), F.col("digest")))
        levels = F.when(active & F.col("levels").isNull(), lost.cast(
            "array<array<string>>")).otherwise(F.col("levels"))
        met = met.withColumn("levels", levels)
        here = met.select(
            *[c for c in wants.columns if c not in ("prefix", "rank", "n")],
            *(["rank", "n"] if s == 0 else [F.col("rank").alias("prefix")]), *kept,
            F.when(active, F.element_at(F.element_at("levels", 1), digit + 1))
            .otherwise(F.col("digest")).alias("digest"),
            F.when(active, F.concat("path", _segment_path(fanout, digit)))
            .otherwise(F.col("path")).alias("path"))
    if not stores:
        here = requests.join(here.drop("prefix"), "grp")
    return here


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and the steps of ``path`` (top first) lead to."""
    return F.aggregate(F.reverse(path), leaf, lambda acc, s: F.sha2(
        F.concat(s["before"], acc, s["after"]).cast("binary"), 256))


def proof_text(path: Column) -> Column:
    """The unselected children of a path, from the leaf's level up."""
    return F.array_join(F.transform(F.reverse(path), lambda s: F.concat(
        s["before"], s["after"])), "")


# ---- the dataset's manifest -----------------------------------------------------------------
@dataclass
class Manifest:
    """``leaves(grp, doc_id, leaf, rank, n, ...)``, ``root(grp, digest)`` (one row, none
    for an empty table), ``groups(all, grp, rank, n, digest)`` and the two stores."""
    leaves: DataFrame
    groups: DataFrame
    root: DataFrame
    leaf_stores: list[DataFrame]
    group_stores: list[DataFrame]
    fanout: int
    segment: int


def manifest(docs: DataFrame, extra: dict[str, Column] | None = None, fanout: int = FANOUT,
             segment: int = SEGMENT) -> Manifest:
    """The manifest of ``docs(doc_id, source, lang, n_chars, text)``.

    Leaves ascend by id (null first), equal ids by digest; repeated rows are
    leaves of their own.  A null field differs from an empty one; null ``lang``
    is a group; an empty table has no root.  ``extra``: further columns made from
    the rows, carried by the leaves; other columns of ``docs`` are ignored."""
    own = docs.select(*[F.col(f"`{c}`") for c in FIELDS])
    rows = staged(own.select(group_key(F.col("lang")).alias("grp"), "doc_id",
                             leaf_digest().alias("leaf"),
                             *[c.alias(k) for k, c in (extra or {}).items()]), "merkle-rows")
    leaves = staged(ranked(rows, "grp", ["doc_id", "leaf"], "merkle-order"), "merkle-leaves")
    tops, leaf_stores = build(leaves.select("grp", "rank", "n", F.col("leaf").alias("digest")),
                              fanout, segment)
    groups = staged(ranked(tops.select(F.lit("").alias("all"), "grp", "digest"), "all", ["grp"],
                           "merkle-groups"), "merkle-groups")
    nodes = groups.select(F.col("all").alias("grp"), "rank", "n", "digest")
    root, group_stores = build(nodes, fanout, segment, "merkle-top")
    return Manifest(leaves, groups, root, leaf_stores, group_stores, fanout, segment)


def prove(m: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """For every requested leaf (rows of ``m.leaves``; all by default): its columns with
    ``digest`` (the leaf found), ``subroot``, ``root`` and ``path`` (top first)."""
    start = m.root.select("grp", "digest", F.expr(f"CAST(array() AS array<{STEP}>)").alias("path"),
                          F.col("digest").alias("root"))
    asked = m.groups.select(F.col("all").alias("grp"), F.col("grp").alias("name"), "rank", "n")
    at_groups = descend(start, asked, m.group_stores, m.fanout, m.segment)
    begin = at_groups.select(F.col("name").alias("grp"), "digest", "path", "root",
                             F.col("digest").alias("subroot"))
    return descend(begin, m.leaves if requests is None else requests, m.leaf_stores,
                   m.fanout, m.segment)


def tampered_leaf() -> Column:
    """The leaf of a row after tampering: one more character claimed, for ids whose
    CRC-32 the divisor divides (a null id counts as the empty text); else null."""
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return F.when((crc % TAMPER_DIVISOR == 0) & F.col("n_chars").isNotNull(),
                  leaf_digest(n_chars=F.col("n_chars") + 1))


def verify(docs: DataFrame) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` per row of
    ``docs`` after the tampering of ``tampered_leaf``."""
    m = manifest(docs, {"tampered": tampered_leaf()})
    proven = prove(m)
    true_leaf = F.when(F.col("digest") == F.col("leaf"), F.col("leaf")).otherwise(F.raise_error(
        F.concat(F.lit("another leaf in the place of "), F.col("leaf"))).cast("string"))
    return proven.select(
        "doc_id", true_leaf.alias("leaf"), "subroot", "root",
        F.sha2(proof_text(F.col("path")).cast("binary"), 256).alias("proof_sha256"),
        fold(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
