"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from tidemark.llm import line_rules as lr
from tidemark.llm import merkle as mk
from tidemark.llm import url_templates as ut
from tidemark.llm.queries import URL_RULES

WORD = r"[^\x20\x09-\x0D]+"


def _any_of(chars: str) -> str:
    return "[" + "".join("\\" + c if c in r"\]^-[" else c for c in chars) + "]"


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _count(column: str, chars: str) -> str:
    none = _any_of(chars).replace("[", "[^", 1)
    return f"length(regexp_replace({column}, {_quoted(none)}, '', 'g'))"


OP9 = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '{WORD}') AS ws FROM d),
g AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS times
  FROM (SELECT rid, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
        FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w))),
rep AS (
  SELECT rid, count(DISTINCT i + k) AS n
  FROM g, (SELECT unnest([0, 1, 2]) AS k) WHERE times > 1 GROUP BY rid),
l AS (
  SELECT rid, pos, line, regexp_extract_all(line, '{WORD}') AS lw
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line,
               unnest(range(len(string_split(t, chr(10))))) AS pos FROM d)),
f AS (
  SELECT rid, row_number() OVER (PARTITION BY rid, line ORDER BY pos) AS nth, chars,
         CASE WHEN 100 * syms > {lr.MAX_SYMBOL_PERCENT} * chars THEN true
              WHEN n < {lr.MIN_OPEN_WORDS} AND NOT closed THEN true
              WHEN seps >= {lr.MIN_SEPARATORS} AND n <= {lr.MAX_ITEM_WORDS} * (seps + 1) THEN true
              ELSE n <= {lr.MAX_BOILERPLATE_WORDS} AND said END AS fails
  FROM (SELECT rid, pos, line, len(lw) AS n,
               list_sum(list_transform(lw, lambda x: length(x))) AS chars,
               {_count("line", lr.SYMBOLS)} AS syms, {_count("line", lr.SEPARATORS)} AS seps,
               regexp_matches(line, {_quoted(_any_of(lr.TERMINAL) + _any_of(lr.CLOSING)
                                             + r"*[ \t\n\x0b\x0c\r]*\z")}) AS closed,
               regexp_matches(lower(line), {_quoted("|".join(
                   p.replace("(", r"\(").replace(")", r"\)") for p in lr.BOILERPLATE))}) AS said
        FROM l WHERE len(lw) > 0)),
ls AS (
  SELECT rid, count(*) FILTER (WHERE nth > 1) AS n_dup,
         coalesce(sum(chars) FILTER (WHERE fails), 0) AS lost FROM f GROUP BY rid),
m AS (
  SELECT doc_id, len(ws) AS n_words,
         coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
         {_count("t", lr.SYMBOLS)} AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines,
         coalesce(rep.n, 0) AS n_repeat_words, coalesce(lost, 0)::BIGINT AS lost_chars
  FROM d JOIN w USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN ls USING (rid)),
b AS (
  SELECT *, n_words < {lr.MIN_WORDS}
            OR 100 * n_repeat_words > {lr.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND 100 * lost_chars <= {lr.MAX_LOST_PERCENT} * word_chars AS kept FROM b
"""

def _op2() -> str:
    """The template tree, one pair of CTEs per level (a page ends at its own depth)."""
    rules = sorted(ut.parse_rules(URL_RULES),
                   key=lambda r: (-len(r.name), r.verdict != "block", r.name))

    def rule(what: str) -> str:
        return "CASE " + " ".join(
            f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) "
            f"AND starts_with(path, '{r.path}') THEN '{getattr(r, what)}'" for r in rules) + " END"

    def alike(part: str, whole: str, all_part: str, all_whole: str) -> str:
        share = f"({all_part}::DOUBLE / {all_whole})"
        gap = f"({part}::DOUBLE / {whole} - {share})"
        return (f"({whole} = 0 OR {all_whole} = 0 OR {all_part} = 0 OR {all_part} = {all_whole} OR "
                f"{gap} * {gap} <= {ut.CHI_SQUARE} * ({share} * (1 - {share}) "
                f"* (1::DOUBLE / {whole} + 1::DOUBLE / {all_whole})))")

    levels = []
    for d in range(ut.MAX_DEPTH):
        levels.append(f"""
k{d} AS (
  SELECT host, node, seg, count(*) AS n, count(*) FILTER (WHERE label = 1) AS good,
         count(label) AS m, count(*) FILTER (WHERE len(segs) = {d + 1}) AS ends
  FROM (SELECT *, segs[{d + 1}] AS seg FROM r{d} WHERE len(segs) > {d}) GROUP BY ALL),
l{d} AS (
  SELECT host, node, seg,
    CASE WHEN kinds >= {ut.MIN_KINDS} AND n * {ut.RARE_SHARE} <= an
           THEN '{ut.ANY}' || regexp_extract(seg, '\\.[A-Za-z0-9]{{1,5}}$')
         WHEN kinds > 1 AND {alike("good", "m", "agood", "am")}
              AND {alike("ends", "n", "aends", "an")} THEN '{ut.ALIKE}'
         ELSE seg END AS label_to
  FROM (SELECT *, count(*) OVER w AS kinds, sum(n) OVER w AS an, sum(good) OVER w AS agood,
               sum(m) OVER w AS am, sum(ends) OVER w AS aends
        FROM k{d} WINDOW w AS (PARTITION BY host, node))),
r{d + 1} AS (
  SELECT rid, page_id, r.host, path, rule, label, segs,
         CASE WHEN label_to IS NULL THEN r.node ELSE r.node || '/' || label_to END AS node
  FROM r{d} r LEFT JOIN l{d} l
    ON r.host = l.host AND r.node = l.node AND segs[{d + 1}] = l.seg)""")
    return f"""
WITH u AS (
  SELECT row_number() OVER () AS rid, page_id,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
p AS (
  SELECT rid, page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), '{ut._UPPER}', '{ut._LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r0 AS (
  SELECT rid, page_id, host, path, {rule("name")} AS rule,
         CASE {rule("verdict")} WHEN 'allow' THEN 1 WHEN 'block' THEN 0 END AS label,
         CASE WHEN path = '' THEN []::VARCHAR[]
              ELSE string_split(substr(path, 2), '/')[:{ut.MAX_DEPTH}] END AS segs, '' AS node
  FROM p),{",".join(levels)},
t AS (
  SELECT *, (coalesce(sum(label) OVER w, 0) + {ut.PRIOR_WEIGHT} * coalesce(greatest(
               {ut.LEAST_PRIOR}, (sum(label) OVER ())::DOUBLE / nullif(count(label) OVER (), 0)),
               1))
            / (count(label) OVER w + {ut.PRIOR_WEIGHT}) AS purity
  FROM r{ut.MAX_DEPTH} WINDOW w AS (PARTITION BY host, node))
SELECT page_id, host, path, rule, node AS template,
       CASE WHEN label = 1 THEN 'allow' WHEN label = 0 THEN 'block'
            WHEN purity < {ut.REJECT_BELOW} THEN 'block' ELSE 'allow' END AS verdict
FROM t
"""


OP4 = """
WITH p AS (
  SELECT row_number() OVER () AS rid, page_id, url, coalesce(html, '') AS h FROM pages),
q AS (
  SELECT *, strlen(h)::BIGINT AS payload_bytes, sha256(h) AS payload_digest FROM p),
r AS (
  SELECT *, row_number() OVER w AS nth, first_value(page_id) OVER w AS lead
  FROM q WINDOW w AS (PARTITION BY payload_digest
                      ORDER BY page_id NULLS LAST, coalesce(url, ''), rid))
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND nth > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND nth > 1 THEN lead END AS refers_to
FROM r
"""


def _leaf(n_chars: str = "n_chars") -> str:
    def field(c):
        return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    fields = (n_chars if c == "n_chars" else c for c in mk.FIELDS)
    return "sha256(" + " || ".join(map(field, fields)) + ")"


# CRC-32 of the id's text, bit by bit; 3988292384 is its reversed polynomial.
_CRC = """xor(4294967295::BIGINT, list_reduce(
    list_prepend(4294967295::BIGINT, [ord(c)::BIGINT FOR c IN
        regexp_extract_all(coalesce(CAST(doc_id AS VARCHAR), ''), '.')]),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0::BIGINT FOR i IN range(8)]),
                               lambda x, _: xor(x >> 1, (x & 1) * 3988292384::BIGINT))))"""


def _tree(name: str, source: str) -> str:
    """All levels of the trees over ``source(grp, nodes)``; in ``<name>_at`` the nodes
    of the levels that have a parent."""
    return f"""
{name}(grp, k, nodes) AS (
  SELECT grp, 0, nodes FROM {source}
  UNION ALL
  SELECT grp, k + 1, [sha256(nodes[i] || coalesce(nodes[i + 1], ''))
                      FOR i IN range(1, len(nodes) + 1, 2)]
  FROM {name} WHERE len(nodes) > 1),
{name}_at AS (
  SELECT grp, k, unnest(nodes) AS node, unnest(range(len(nodes))) AS pos
  FROM {name} WHERE len(nodes) > 1)"""


def _steps(rows: str, tree: str) -> str:
    """For each of ``rows(id, grp, pos)`` its levels' siblings: before it (L), after it
    (R) or none."""
    return f"""
SELECT x.id, own.k, CASE WHEN s.node IS NULL THEN '-' WHEN s.pos < own.pos THEN 'L' ELSE 'R' END
       || coalesce(s.node, '') AS step
FROM {rows} x JOIN {tree}_at own ON own.grp = x.grp AND own.pos = x.pos >> own.k
LEFT JOIN {tree}_at s ON s.grp = own.grp AND s.k = own.k AND s.pos = xor(own.pos, 1)"""


OP12 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS grp, {_leaf()} AS leaf,
         CASE WHEN {_CRC} % {mk.TAMPER_DIVISOR} = 0 AND n_chars IS NOT NULL
              THEN {_leaf("(n_chars + 1)")} END AS tampered
  FROM documents),
r AS MATERIALIZED (
  SELECT *, row_number() OVER () AS id,
         row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM d),
own AS (SELECT grp, list(leaf ORDER BY pos) AS nodes FROM r GROUP BY grp),
{_tree("low", "own")},
sub AS (SELECT grp AS id, '' AS grp, nodes[1] AS subroot, row_number() OVER (ORDER BY grp) - 1 AS pos
        FROM low WHERE len(nodes) = 1),
subs AS (SELECT '' AS grp, list(subroot ORDER BY pos) AS nodes FROM sub),
{_tree("high", "subs")},
above AS (SELECT id, list(step ORDER BY k) AS steps FROM ({_steps("sub", "high")}) GROUP BY id),
below AS (SELECT id, list(step ORDER BY k) AS steps FROM ({_steps("r", "low")}) GROUP BY id),
p AS (
  SELECT r.doc_id, r.leaf, r.tampered, sub.subroot,
         (SELECT nodes[1] FROM high WHERE len(nodes) = 1) AS root,
         list_concat(coalesce(b.steps, []), coalesce(a.steps, [])) AS steps
  FROM r JOIN sub ON sub.id = r.grp LEFT JOIN below b ON b.id = r.id
  LEFT JOIN above a ON a.id = r.grp),
f AS (
  SELECT *, list_reduce(list_prepend(coalesce(tampered, leaf), steps),
                        lambda x, s: sha256(CASE s[1] WHEN 'L' THEN s[2:] || x
                                            WHEN 'R' THEN x || s[2:] ELSE x END)) AS folded_root
  FROM p)
SELECT doc_id, leaf, subroot, root,
       sha256(array_to_string([s[2:] FOR s IN steps], '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM f
"""

SQL: dict[str, str] = {
    "op2_url_filters": _op2(),
    "op4_warc_archive": OP4,
    "op9_quality_rules": OP9,
    "op12_merkle_manifest": OP12,
}
