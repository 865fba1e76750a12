from __future__ import annotations

import random

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = ("the of and stone river light window paper garden winter market signal copper velvet "
         "harbor lantern meadow timber canyon orchard saddle thunder whisper marble anchor").split()


def sentence_text(seed: int, n: int = 90) -> str:
    r = random.Random(seed)
    return ". ".join(" ".join(r.choice(WORDS) + str(r.randint(0, 99)) for _ in range(9))
                     for _ in range(n // 9)) + "."


def doc(i, text, lang="en", source="s"):
    return (i, text, lang, source, None if text is None else len(text))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows and clashing columns."""
    long_text = "\n".join(sentence_text(s) for s in range(400))
    rows = [doc(1, sentence_text(1)), doc(1, sentence_text(1)), doc(2, sentence_text(1)),
            doc(3, None), doc(4, ""), doc(None, sentence_text(5000)), doc(None, None, None, None),
            doc(6, " \n\t "), doc(7, "x" * 200_000), doc(8, long_text, None),
            doc(9, "中文 \U0001f44d <|endoftext|> \x00 " * 30), doc(10, "!!! ### 123", "de")]
    extra = [c + " string" for c in ("key", "digest", "fp", "score", "ids", "r", "kept", "nth")]
    return spark.createDataFrame([r + ("z",) * len(extra) for r in rows],
                                 DOC_SCHEMA + ", " + ", ".join(extra))


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(autouse=True)
def _prepared(spark):
    from tidemark.llm.common import prepare
    prepare(spark)
