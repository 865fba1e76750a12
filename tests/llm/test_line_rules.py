from __future__ import annotations

import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import sentence_text
from tidemark.llm import line_rules as lr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_counts(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [s for s in (text or "").split("\n") if WORD.search(s)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab é|#\n\t\x1c　.", max_size=60))
def test_base_counts(text):
    assert lr.judge_text(text)[:5] == slow_counts(text)


def test_line_verdicts():
    assert lr.line_fails("") is None and lr.line_fails(" \t") is None
    assert lr.line_fails("Home | About | Contact | Help | Login | Register | News | Faq | "
                         "Jobs | Press.") in ("navigation", "punctuation")
    assert lr.line_fails("A · b · c · d · e f g h i j k.") == "navigation"
    assert lr.line_fails("no end here") == "punctuation"
    assert lr.line_fails('He said "it ends."') is None
    assert lr.line_fails("All rights reserved.") == "boilerplate"
    assert lr.line_fails("one %%% two &&& three ### four ***.") == "punctuation"
    assert lr.line_fails("word " * 12) is None


def test_documents(spark, odd_docs, no_docs):
    good = sentence_text(1)
    judged = lr.judge(odd_docs).select("doc.doc_id", "doc.text", "rules").collect()
    assert len(judged) == odd_docs.count()
    for r in judged:
        assert tuple(r.rules)[:5] == slow_counts(r.text)
        assert r.rules.base_failed == (r.rules.n_words < 50
                                       or 100 * r.rules.n_repeat_words > 50 * r.rules.n_words)
    kept = {r.doc_id for r in judged if r.rules.kept}
    assert {1, 2, 8, None} <= kept and not {3, 4, 6, 7, 9, 10} & kept
    docs = spark.createDataFrame([(1, good + "\nAll rights reserved.\nmenu", "q")],
                                 "doc_id long, text string, kept string")
    out = lr.clean(docs).collect()
    assert [(r.doc_id, r.text, r.kept) for r in out] == [(1, good, "q")]
    lost = spark.createDataFrame([(1, good + "\n" + "a | b | c | d | e\n" * 90)],
                                 "doc_id long, text string")
    assert lr.clean(lost).count() == 0
    assert lr.clean(no_docs).count() == 0 and lr.clean(no_docs).columns == no_docs.columns
    assert lr.clean(odd_docs).columns == odd_docs.columns
