"""Edits of JSON text that leave everything else byte for byte as it was.

Records are open: they may hold any legal JSON, with repeated keys, numbers of any
size or spelling, and keys in any order.  Parsing and writing them again would
change all that, so the operators find the few members they need in the text
itself, with regular expressions inside Spark's own functions.  The expressions
never go back (all their loops are possessive), so a long record costs one pass.

Of a repeated key the last member counts, as in Spark's JSON parser.  Keys may be
written with ``\\u`` escapes.  Objects and arrays may be nested ``DEPTH`` deep;
members below that depth are not found.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

DEPTH = 48
_WS = r"[ \t\r\n]*+"
_STRING = r'"(?:[^"\\]++|\\.)*+"'


def _nested(depth: int) -> str:
    inner = "" if depth == 1 else "|" + _nested(depth - 1)
    return r'[{\[](?:[^"{}\[\]]++|' + _STRING + inner + r")*+[}\]]"


_VALUE = f'(?:{_STRING}|{_nested(DEPTH)}|[^ \\t\\r\\n,"{{}}\\[\\]]++)'
_MEMBER = f"{_WS}{_STRING}{_WS}:{_WS}{_VALUE}{_WS}"


def _key(name: str) -> str:
    """A key in quotes, each letter as it is or escaped."""
    def letter(c: str) -> str:
        digits = "".join(f"[{d}{d.upper()}]" if d.isalpha() else d for d in f"{ord(c):04x}")
        return f"(?:{c}|\\\\u{digits})"
    return '"' + "".join(map(letter, name)) + '"'


def _before(name: str) -> str:
    """From the start of an object to the value of its last member ``name``."""
    key = f"{_WS}{_key(name)}{_WS}:"
    others = f"(?:(?!{key}){_MEMBER},)*+"
    again = f"(?:{others}{key}{_WS}{_VALUE}{_WS},(?={others}{key}))*+"
    return rf"{_WS}\{{{again}{others}{key}{_WS}"


def _plainly(name: str) -> str:
    """The same where the key is there once and nothing is escaped: one pass."""
    return rf'{_WS}\{{(?:(?!{_WS}"{name}"){_MEMBER},)*+{_WS}"{name}"{_WS}:{_WS}'


def once(text: Column, name: str) -> Column:
    """Whether a text holds ``name`` in quotes exactly once."""
    key = F.lit(f'"{name}"')
    find = lambda start: F.call_function("locate", key, text, start)
    first = find(F.lit(1))
    return (first > 0) & (find(first + 1) == 0)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` refers to it: a
    generator shares no work between the places where one expression stands."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def member(text: Column, name: str) -> Column:
    """The text of the value of an object's member; null where it has none."""
    def find(t: Column) -> Column:
        plain = ~t.contains("\\")
        value = lambda before: F.get(F.regexp_extract_all(
            t, F.lit(f"(?s)^{before}({_VALUE})"), F.lit(1)), F.lit(0))
        return F.when(plain & ~t.contains(f'"{name}"'), F.lit(None)).when(
            plain & once(t, name), value(_plainly(name))).otherwise(value(_before(name)))

    return let(text, find)


def members(text: Column) -> Column:
    """The texts of all members of an object, in order; of anything else none."""
    return F.regexp_extract_all(
        text, F.lit(rf"(?s)(?:^{_WS}\{{|\G,)({_MEMBER})"), F.lit(1))


def elements(text: Column) -> Column:
    """The texts of all elements of an array, in order; of anything else none."""
    return F.regexp_extract_all(
        text, F.lit(rf"(?s)(?:^{_WS}\[|\G,){_WS}({_VALUE}){_WS}"), F.lit(1))


def key_of(member_text: Column) -> Column:
    """The key of a member's text, escapes resolved."""
    def resolved(raw: Column) -> Column:
        plain = F.substr(raw, F.lit(2), F.length(raw) - 2)
        return F.when(raw.contains("\\"), F.get_json_object(
            F.concat(F.lit('{"k":'), raw, F.lit("}")), "$.k")).otherwise(plain)

    return let(F.regexp_extract(member_text, f"(?s)^{_WS}({_STRING})", 1), resolved)


def with_member(text: Column, path: tuple[str, ...], value: Column) -> Column:
    """``text`` with the value at ``path`` replaced by the JSON text ``value``, or put
    first into the innermost object where it has no such member.  A text without
    the objects that lead there stays as it is."""
    plain = ~text.contains("\\")
    for name in path:
        plain = plain & once(text, name)
    before = F.regexp_extract(F.when(plain, text), f"(?s)^{''.join(map(_plainly, path))}", 0)

    def put(found: Column) -> Column:
        rest = F.substr(text, F.length(found) + 1, F.length(text))
        return F.when(F.length(found) > 0, F.concat(found, F.regexp_replace(
            rest, F.lit(f"(?s)^{_VALUE}"), _literal(value)))).otherwise(_with_last(text, path, value))

    return let(before, put)


def _with_last(text: Column, path: tuple[str, ...], value: Column) -> Column:
    """The same for texts with repeated, escaped or missing keys."""
    *outer, name = path
    way = "".join(map(_before, outer))
    replaced = F.regexp_replace(text, F.lit(f"(?s)^({way}{_before(name)}){_VALUE}"),
                                F.concat(F.lit("$1"), _literal(value)))
    key = f"{_WS}{_key(name)}{_WS}:"
    lacks = f"(?!(?:(?!{key}){_MEMBER},)*+{key})"
    start = rf"{_WS}\{{"
    new = F.concat(F.lit(f'$1"{name}":'), _literal(value))
    empty = F.regexp_replace(replaced, F.lit(rf"(?s)^({way}{start})(?={_WS}\}})"), new)
    return F.regexp_replace(empty, F.lit(rf'(?s)^({way}{start})(?={_WS}"){lacks}'),
                            F.concat(new, F.lit(",")))


def _literal(value: Column) -> Column:
    """``value`` as the replacement of a pattern: no group references in it."""
    return F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))
