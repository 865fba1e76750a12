"""Line-first quality rules.

Each line is judged by itself: punctuation, navigation and boilerplate rules.
Lines that fail are taken out; a document is rejected when a base check fails
or when the lines taken out held too much of its text.
"""

from __future__ import annotations

import re
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50         # words in repeated 3-word windows
MAX_LOST_PERCENT = 30           # word characters in lines taken out
MIN_OPEN_WORDS = 10             # shorter lines must end in terminal punctuation
MAX_SYMBOL_PERCENT = 10         # symbols among a line's word characters
MIN_SEPARATORS = 3              # of a navigation line
MAX_ITEM_WORDS = 3              # between its separators, on average
MAX_BOILERPLATE_WORDS = 40      # longer lines are prose that mentions a phrase

# White space, counted symbols, line ends, separators, phrases.
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
TERMINAL = ".!?:;…。！？"
CLOSING = "\"')]}»”’"
SEPARATORS = "|»›·•>"
BOILERPLATE = (
    "all rights reserved", "accept cookies", "click here", "cookie policy", "copyright (c)",
    "enable javascript", "licensed under", "log in", "lorem ipsum", "powered by",
    "privacy policy", "read more", "sign up", "skip to content", "spdx-license-identifier",
    "subscribe to", "terms of use",
)
_PHRASE = re.compile("|".join(map(re.escape, BOILERPLATE)))

RESULT = StructType([
    StructField("n_words", LongType()), StructField("word_chars", LongType()),
    StructField("n_symbols", LongType()), StructField("n_dup_lines", LongType()),
    StructField("n_repeat_words", LongType()), StructField("base_failed", BooleanType()),
    StructField("n_lines_removed", LongType()), StructField("lost_chars", LongType()),
    StructField("kept", BooleanType()), StructField("text", StringType())])


def _symbols(text: str) -> int:
    return sum(map(text.count, SYMBOLS))


def line_fails(line: str) -> str | None:
    """The name of the first rule a line breaks; a line without a word breaks none."""
    words = line.translate(_TO_BLANK).split(" ")
    n = len(words) - words.count("")
    if not n:
        return None
    chars = sum(map(len, words))
    if 100 * _symbols(line) > MAX_SYMBOL_PERCENT * chars:
        return "punctuation"
    if n < MIN_OPEN_WORDS and not line.rstrip(SPACE).rstrip(CLOSING).endswith(tuple(TERMINAL)):
        return "punctuation"
    separators = sum(map(line.count, SEPARATORS))
    if separators >= MIN_SEPARATORS and n <= MAX_ITEM_WORDS * (separators + 1):
        return "navigation"
    if n <= MAX_BOILERPLATE_WORDS and _PHRASE.search(line.lower()):
        return "boilerplate"
    return None


_TO_BLANK = {ord(c): " " for c in SPACE}


def repeated_words(words: list, window: int = 3) -> int:
    """Words that lie in a window of three found at least twice."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number = count()
    ids: dict = {}
    row = np.fromiter((ids[w] if w in ids else ids.setdefault(w, next(number)) for w in words),
                      np.int64, len(words))
    code = row[:n]
    for k in range(1, window):      # compressed before each step, so it never overflows
        if k > 1 and len(ids) > 1 << 20:
            code = np.unique(code, return_inverse=True)[1]
        code = code * len(ids) + row[k:n + k]
    order = np.argsort(code, kind="stable")
    run = code[order]
    same = run[1:] == run[:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for k in range(window):
        covered[k:n + k] |= twice
    return int(covered.sum())


def judge_text(text: str | None) -> tuple:
    """The fields of ``RESULT`` for one text; null is the empty text."""
    text = text or ""
    words = text.encode().split()
    n_words = len(words)
    word_chars = len(text) - sum(map(text.count, SPACE))
    repeat = repeated_words(words)
    seen: set[str] = set()
    kept_lines, n_dup, removed, lost = [], 0, 0, 0
    for line in text.split("\n"):
        if line.strip(SPACE):
            n_dup += line in seen
            seen.add(line)
        if line_fails(line):
            removed += 1
            lost += len(line) - sum(map(line.count, SPACE))
        else:
            kept_lines.append(line)
    failed = n_words < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * n_words
    kept = not failed and 100 * lost <= MAX_LOST_PERCENT * word_chars
    return (n_words, word_chars, _symbols(text), n_dup, repeat, failed, removed, lost, kept,
            "\n".join(kept_lines))


@F.arrow_udf(RESULT)
def _judge(texts: pa.Array) -> pa.Array:
    kind = to_arrow_schema(RESULT)
    columns = list(zip(*map(judge_text, texts.to_pylist()))) or [[] for _ in kind]
    return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind)],
                                      kind.names)


# Marked so that a later filter on the verdict does not run the rules twice.
_judge = _judge.asNondeterministic()


def judge(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` as the struct ``doc``, and its verdict ``rules``
    (fields of ``RESULT``; ``rules.text`` is the text without failing lines).

    Null and empty texts have no words and fail the word count; ids may be null
    or repeated, rows are judged one by one; other columns stay in ``doc`` and
    cannot clash; an empty table gives no rows."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                       _judge("text").alias("rules"))


def clean(docs: DataFrame) -> DataFrame:
    """The documents that stay, in the columns of ``docs``, their failing lines
    removed; ``n_chars``, where present, follows the new text."""
    judged = judge(docs).where("rules.kept")
    new = {"text": F.col("rules.text"),
           "n_chars": F.length("rules.text").cast(dict(docs.dtypes).get("n_chars", "bigint"))}
    return judged.select(*[(new[c] if c in new else F.col(f"doc.`{c}`")).alias(c)
                           for c in docs.columns])
