"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

1. Base patterns find emails, IP addresses, card and phone numbers; failing checks
   (parts up to 255, Luhn, digit counts) drop a match.
2. Other words with digits or an at sign are candidates: identifiers that the base
   patterns do not know.  What stands before a match is its lexical pattern: two
   words (a line's start counts as one), or a word and a label glued to the match.
3. Patterns and identifiers form a graph, weighted by occurrences.  A pattern is as
   reliable for a kind as its share of known identifiers among all that follows it,
   ordinary words included; a candidate is accepted by the reliabilities of the
   patterns it occurs in, and then counts as known for other patterns.  This goes on
   until no candidate is added.
4. Every place of an accepted candidate is a span of its kind.

Texts are scanned twice: for the matches, which are kept with their contexts (one
narrow row per document, so that nothing later depends on the texts), and for how
often the contexts in question are followed by any word.  The graph is aggregated
by (context, kind, value) before any join, and join keys are hidden from the
planner, so that a hot context or value can be split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged

KINDS = ("email", "ip", "card", "phone")
CANDIDATE = "candidate"

MIN_VALUES = 3          # different known identifiers of a pattern
THRESHOLD = 0.75        # reliability that accepts
MIN_RELIABILITY = 0.5   # below it a pattern says nothing
UNKNOWN_WEIGHT = 0.25   # of a candidate not yet accepted, among a pattern's failures
CONTEXT_CHARS = 100     # searched for the two words before a match
FILTER_WORDS = 4096     # 64-bit words of the filter of contexts

# The kinds' patterns.  They find what the plain patterns of the same
# shape find, but begin only where a match can and never go back, so that a long
# text costs one pass.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # A word with a digit or an at sign, and number words after it.
    CANDIDATE: (r"(?<![^\x20\x09-\x0D])(?=[^\x20\x09-\x0D]*?(?:[0-9@]|[(\[]at[)\]]))[^\x20\x09-\x0D]++"
                r"(?:\x20[0-9().+/-]++(?=[,;:!?]*+(?![^\x20\x09-\x0D])))*+"),
}
HITS = ("array<struct<kind:string,nth:int,before:int,value:string,lead:int,ok:boolean,"
        "context:string>>")
_NEEDS = {"email": "@", "ip": ".", "phone": "+"}       # character without which none is there
_OCTET = "0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
# What a candidate of a kind looks like, and how many digits (or masks) it has.
SHAPES = {
    "email": (r"^[^\x20@]+(?:@|[(\[]at[)\]])[^\x20@]+$", 0, 1 << 30),
    "ip": (r"^[0-9A-Fa-f]{1,4}(?:[.:][0-9A-Fa-f]{0,4}){3,7}$", 2, 32),
    "card": (r"^[0-9xX*#][0-9xX*#.\x20-]+$", 12, 19),
    "phone": (r"^[0-9().+/\x20-]+$", 7, 15),
}
_LABEL = r"^(?:[^\x20:=]*+[:=])?+(?:(?!\([0-9]+\))[\"'(\[{<])*+"   # glued in front of a candidate
_TAIL = r"[\"')\]}>:;,.!?*|]+$"                             # and behind it


# ---- matches -------------------------------------------------------------------------------
def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    each = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    doubled = F.transform(each, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    n = F.length(_digits(value))
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.when(n.between(14, 19), _luhn(_digits(value))).otherwise(F.lit(False))
    return n.between(10, 15) if kind == "phone" else F.lit(True)


def identity(kind: str, value: Column) -> Column:
    """What makes two spellings the same identifier."""
    if kind in ("card", "phone"):
        return _digits(value)
    return F.lower(value)


def _plain(text: Column) -> Column:
    """Lower-case words with single blanks between them; a line's start is a word."""
    blanks = F.regexp_replace(text, r"[\x20\x09\x0B-\x0D]++", " ")
    return F.lower(F.regexp_replace(blanks, r"(?: ?\n)++ ?", " \n "))


def _context(gap: Column, nth: Column, label: Column) -> Column:
    """The two words before a match, the last one glued to it where no blank follows;
    null where the text since the last match does not hold two whole words."""
    whole = F.when(nth == 0, F.concat(F.lit("\n "), gap)).otherwise(gap)
    near = F.concat(F.right(whole, F.lit(CONTEXT_CHARS)), label)
    cut = (F.length(whole) > CONTEXT_CHARS) | ((nth > 0) & ~gap.rlike(r"^[\x20\x09-\x0D]"))
    words = F.filter(F.split(_plain(near), " "), lambda w: w != "")
    enough = F.size(words) >= F.when(cut, 3).otherwise(2)
    glue = F.when(near.rlike(r"[\x20\x09-\x0D]$"), " ").otherwise("")
    return F.when(enough, F.concat(F.array_join(F.slice(words, -2, 2), " "), glue))


def _hits(text: Column, kind: str) -> Column:
    """All matches of a kind: ``kind, nth, before`` (code points since the last match),
    ``value, lead`` (code points of the label in it), ``ok, context``."""
    pattern = F.lit(PATTERNS[kind])
    zipped = F.arrays_zip(F.split(text, PATTERNS[kind], -1),
                          F.regexp_extract_all(text, pattern, F.lit(0)))

    def hit(z: Column, nth: Column) -> Column:
        gap, value = z["0"], z["1"]
        label = F.regexp_extract(value, _LABEL, 0) if kind == CANDIDATE else F.lit("")
        valid = F.lit(True) if kind == CANDIDATE else _valid(kind, value)
        return F.struct(F.lit(kind).alias("kind"), nth.alias("nth"), F.length(gap).alias("before"),
                        value.alias("value"), F.length(label).alias("lead"), valid.alias("ok"),
                        _context(gap, nth, label).alias("context"))

    found = F.transform(F.slice(zipped, F.lit(1), F.size(zipped) - 1), hit)
    there = text.contains(_NEEDS[kind]) if kind in _NEEDS else F.lit(True)
    return F.when(there, found).otherwise(F.array()).cast(HITS)



def matches(docs: DataFrame) -> DataFrame:
    """``(row, doc_id, hits)`` per row of ``docs``, written to the shared folder."""
    text = F.col("text")
    every = F.concat(*[_hits(text, k) for k in (*KINDS, CANDIDATE)])
    worth = text.rlike(r"[0-9@]|[(\[]at[)\]]")
    return staged(docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        F.when(worth, every).otherwise(F.array().cast(HITS)).alias("hits")), "pii-matches")


def spans(found: DataFrame) -> DataFrame:
    """``(row, kind, start, end, value, context)`` of the valid matches, and of the
    candidates that no valid match touches; code points, end exclusive."""
    each = found.select("row", F.inline("hits"))
    upto = Window.partitionBy("row", "kind").orderBy("nth")
    placed = each.withColumn("stop", F.sum(F.col("before") + F.length("value")).over(upto)).where("ok")
    candidate = F.col("kind") == CANDIDATE
    tail = F.length(F.regexp_extract("value", _TAIL, 0))
    inner = F.expr("substring(value, lead + 1, length(value) - lead)")
    trimmed = placed.select(
        "row", "kind", (F.col("stop") - F.length("value") + F.col("lead")).alias("start"),
        F.when(candidate, F.col("stop") - tail).otherwise(F.col("stop")).alias("end"),
        F.when(candidate, F.regexp_replace(inner, _TAIL, "")).otherwise(F.col("value")).alias("value"),
        "context").where("start < end")
    # A candidate goes where a valid match before it reaches into it, or one starts in it.
    before = Window.partitionBy("row").orderBy("start", "end", "kind").rowsBetween(
        Window.unboundedPreceding, -1)
    after = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("end"), F.desc("kind")).rowsBetween(
        Window.unboundedPreceding, -1)
    reach = F.max(F.when(~candidate, F.col("end"))).over(before)
    begin = F.min(F.when(~candidate, F.col("start"))).over(after)
    marked = trimmed.withColumns({"_reach": reach, "_begin": begin})
    free = F.coalesce(F.col("_reach") <= F.col("start"), F.lit(True)) & F.coalesce(
        F.col("_begin") >= F.col("end"), F.lit(True))
    return marked.where(~candidate | free).drop("_reach", "_begin")


# ---- the graph -------------------------------------------------------------------------------
def _fits(kind: str) -> Column:
    pattern, low, high = SHAPES[kind]
    marks = F.length(F.regexp_replace("value", r"[^0-9xX*#]" if kind == "card" else "[^0-9]", ""))
    return F.col("value").rlike(pattern) & marks.between(low, high)


def identifiers(items: DataFrame) -> DataFrame:
    """``items`` with ``kind`` and ``id``: a candidate once for every kind it may be of;
    ``known`` tells the valid matches apart."""
    candidate = F.col("kind") == CANDIDATE
    maybe = F.array(*[F.when(F.when(candidate, _fits(k)).otherwise(F.col("kind") == k), F.struct(
        F.lit(k).alias("kind"), identity(k, F.col("value")).alias("id"))) for k in KINDS])
    each = F.inline(F.filter(maybe, lambda x: x.isNotNull()))
    return items.select("row", "start", "end", "context", (~candidate).alias("known"), each)


def _bit(context: Column) -> tuple[Column, Column]:
    """The word and the bit of a context in the filter."""
    h = F.xxhash64(context)
    return (F.pmod(h, F.lit(FILTER_WORDS)).cast("int"),
            F.pmod(F.shiftright(h, 32), F.lit(64)).cast("int"))


def _maybe(contexts: DataFrame):
    """A test that every one of ``contexts`` passes and few others do: a bitmap of fixed
    size, however many contexts there are."""
    word, bit = _bit(F.col("context"))
    bits = [0] * FILTER_WORDS
    for r in contexts.select(word.alias("w"), F.call_function(
            "shiftleft", F.lit(1).cast("long"), bit).alias("b")).groupBy("w").agg(
            F.bit_or("b").alias("b")).collect():
        bits[r.w] = r.b
    bitmap = F.split(F.lit(",".join(map(str, bits))), ",").cast("array<bigint>")    # folded once

    def test(context: Column) -> Column:
        word, bit = _bit(context)
        return F.call_function("shiftright", F.get(bitmap, word), bit).bitwiseAND(1) == 1
    return test


def followers(docs: DataFrame, contexts: DataFrame) -> DataFrame:
    """``(context, n)``: how often contexts are followed by a word, in all texts; for each
    of ``contexts``, and maybe others.  Counted before any join."""
    words = F.filter(F.split(_plain(F.concat(F.lit("\n "), F.col("text"))), " "), lambda w: w != "")

    def pairs(w: Column) -> Column:
        n = F.greatest(F.size(w) - 2, F.lit(0))
        return F.zip_with(F.slice(w, F.lit(1), n), F.slice(w, F.lit(2), n),
                          lambda a, b: F.concat(a, F.lit(" "), b, F.lit(" ")))

    # The words are bound once, by a one-element array.
    every = docs.where("text is not null").select(
        F.explode(F.flatten(F.transform(F.array(words), pairs))).alias("context"))
    return every.where(_maybe(contexts)(F.col("context"))).groupBy("context").agg(
        F.count("*").alias("n"))


def graph(docs: DataFrame, items: DataFrame, ids: DataFrame) -> DataFrame:
    """``(context, kind, id, n, known, total)``: the edges between contexts of at least
    ``MIN_VALUES`` different values and the identifiers in them; ``total``: all that
    follows the context."""
    own = items.where("context is not null")
    sizes = own.groupBy("context", "value").agg(F.count("*").alias("n")).groupBy("context").agg(
        F.count("*").alias("values"), F.sum("n").alias("items")).where(F.col("values") >= MIN_VALUES)
    sizes = staged(sizes, "pii-contexts")
    after = followers(docs, sizes.where("context like '% '"))
    totals = sizes.join(after, "context", "left").select(
        F.concat("context", F.lit("")).alias("context"),
        F.greatest("items", F.coalesce("n", F.lit(0))).alias("total"))
    edges = ids.where("context is not null").groupBy("context", "kind", "id", "known").agg(
        F.count("*").alias("n"))
    return staged(edges.join(totals, "context"), "pii-graph")


def reliabilities(edges: DataFrame, known: DataFrame) -> DataFrame:
    """``(context, kind, reliability)`` of the patterns, given ``known(kind, id)``."""
    named = known.select("kind", F.concat("id", F.lit("")).alias("id"), F.lit(True).alias("yes"))
    marked = edges.join(named, ["kind", "id"], "left").withColumn("yes", F.col("yes").isNotNull())
    hits = F.sum(F.when(F.col("yes"), F.col("n")).otherwise(0))
    unknown = F.sum(F.when(~F.col("yes"), F.col("n")).otherwise(0))
    # The values are told apart before the shuffle by context: an id has one row a context.
    each = marked.groupBy("context", "kind").agg(
        hits.alias("hits"), unknown.alias("unknown"), F.max("total").alias("total"),
        F.count_if("yes").alias("values"))
    failures = F.greatest(F.col("total") - F.col("hits") - F.col("unknown"), F.lit(0))
    return each.where(F.col("values") >= MIN_VALUES).select("context", "kind", (
        F.col("hits") / (F.col("hits") + failures + UNKNOWN_WEIGHT * F.col("unknown") + 1))
        .alias("reliability")).where(F.col("reliability") >= MIN_RELIABILITY)


def accepted(edges: DataFrame, known: DataFrame) -> DataFrame:
    """``(kind, id, score)`` of the candidates whose patterns vouch for them: one minus the
    product of what their patterns lack."""
    sure = reliabilities(edges, known).select(
        F.concat("context", F.lit("")).alias("context"), "kind", "reliability")
    return (edges.where("not known").join(sure, ["context", "kind"]).groupBy("kind", "id").agg(
        (1 - F.exp(F.sum(F.log1p(-F.col("reliability"))))).alias("score"))
        .where(F.col("score") >= THRESHOLD))


def bootstrap(edges: DataFrame) -> DataFrame:
    """``(kind, id, score)`` of all candidates accepted in the end.

    Accepted candidates count as known in the next round, which can only raise
    reliabilities; the rounds end when none is added."""
    seeds = edges.where("known").select("kind", "id").distinct()
    found, n = None, 0
    while True:
        known = seeds if found is None else seeds.unionByName(found.select("kind", "id")).distinct()
        found = staged(accepted(edges, known), "pii-accepted")
        now = found.count()
        if now <= n:
            return found
        n = now


# ---- the result ------------------------------------------------------------------------------
def _joined(picked: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(picked), lambda s: F.concat_ws(
        ":", F.get(kinds, s["order"]), s["start"], s["end"])), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base, spans)`` per row of ``docs``: the
    counts and spans of the base patterns, and all spans, as ``kind:start:end`` in code
    points, by start, then kind, joined by commas.

    A null or empty text has no spans (empty texts); null and repeated ids stay; equal
    rows give equal results; an empty table gives no rows; further columns are
    ignored."""
    rows = docs.select("doc_id", "text")
    found = matches(rows)
    items = staged(spans(found), "pii-items")
    ids = identifiers(items)
    chosen = bootstrap(graph(rows, items, ids)).select(
        "kind", F.concat("id", F.lit("")).alias("id"), "score")
    order = {k: i for i, k in enumerate(KINDS)}
    number = lambda c: F.array_position(F.array(*[F.lit(k) for k in KINDS]), c).cast("int") - 1
    # A candidate of two kinds is of the one that is surer, or listed first.
    added = ids.where("not known").join(chosen, ["kind", "id"]).groupBy("row", "start", "end").agg(
        F.max(F.struct("score", (-number(F.col("kind"))).alias("rank"))).alias("best")).select(
        "row", "start", "end", (-F.col("best.rank")).alias("order"), F.lit(False).alias("known"))
    own = items.where(F.col("kind") != CANDIDATE).select(
        "row", "start", "end", number(F.col("kind")).alias("order"), F.lit(True).alias("known"))
    span = F.struct("start", "order", "end")
    per_row = own.unionByName(added).groupBy("row").agg(
        *[F.count_if(F.col("known") & (F.col("order") == i)).alias(f"n_{k}") for k, i in order.items()],
        F.collect_list(F.when(F.col("known"), span)).alias("base"), F.collect_list(span).alias("spans"))
    return found.select("row", "doc_id").join(per_row, "row", "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in KINDS],
        F.coalesce(_joined(F.col("base")), F.lit("")).alias("base"),
        F.coalesce(_joined(F.col("spans")), F.lit("")).alias("spans"))
