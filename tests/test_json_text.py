"""Edits of JSON text against a parser that keeps pairs."""

from __future__ import annotations

import json
import random

from pyspark.sql import functions as F

from tidemark.functions import json_text as jt

KEYS = ["common", "is_new", "mid", "ts", "a", "", "x y", "é", "com\\u006don", "\\u0069s_new", 'q\\"{']
ATOMS = ["1", "1.10", "1e400", "-0.0", "true", "null", '"s"', '"{[,]}"', r'"\\"', r'"\""', '"common"',
         '"is_new"', "[]", "{}", "123456789012345678901234567890"]


def value(r, depth):
    kind = r.random()
    if depth and kind < 0.35:
        return obj(r, depth - 1)
    if depth and kind < 0.5:
        return "[" + r.choice([",", " , "]).join(value(r, depth - 1) for _ in range(r.randint(0, 3))) + "]"
    return r.choice(ATOMS)


def obj(r, depth):
    blank = lambda: r.choice(["", "", " ", "\n\t"])
    return "{" + ",".join(f'{blank()}"{r.choice(KEYS)}"{blank()}:{blank()}{value(r, depth)}{blank()}'
                          for _ in range(r.randint(0, 6))) + "}"


def pairs(text):
    """Objects as lists of pairs, numbers as they are written."""
    return json.loads(text, object_pairs_hook=lambda p: ("obj", p), parse_float=lambda x: ("n", x),
                      parse_int=lambda x: ("n", x))


def last(p, key):
    found = [v for k, v in p[1] if k == key] if isinstance(p, tuple) and p[0] == "obj" else []
    return found[-1:] or None


def edited(p):
    """What a rewrite of ``common.is_new`` leads to."""
    if not last(p, "common") or not (isinstance(last(p, "common")[0], tuple)
                                     and last(p, "common")[0][0] == "obj"):
        return p
    at = max(i for i, (k, _) in enumerate(p[1]) if k == "common")
    inner = list(p[1][at][1][1])
    places = [i for i, (k, _) in enumerate(inner) if k == "is_new"]
    if places:
        inner[places[-1]] = ("is_new", "$1\\")
    else:
        inner.insert(0, ("is_new", "$1\\"))
    return ("obj", [*p[1][:at], ("common", ("obj", inner)), *p[1][at + 1:]])


def test_random_objects(spark):
    r = random.Random(11)
    texts = [obj(r, 3) for _ in range(3000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    t = F.col("t")
    rows = df.select(
        "i", jt.member(t, "common").alias("common"), jt.member(t, "ts").alias("ts"),
        jt.members(t).alias("members"), F.transform(jt.members(t), jt.key_of).alias("keys"),
        jt.elements(F.concat(F.lit("[ "), t, F.lit(', 1.10 ,"a]" ]'))).alias("elements"),
        jt.with_member(t, ("common", "is_new"), F.lit(json.dumps("$1\\"))).alias("new")).collect()
    for row in rows:
        text = texts[row.i]
        p = pairs(text)
        for name in ("common", "ts"):
            want = last(p, name)
            assert (row[name] is None) == (want is None), text
            assert want is None or pairs(row[name]) == want[0], text
        assert row.keys == [k for k, _ in p[1]], text
        assert ",".join(row.members) == text.strip()[1:-1] or not row.members, text
        assert row.elements == [text, "1.10", '"a]"'], text
        assert pairs(row.new) == edited(p), text


def test_whole_records_keep_all_bytes(spark):
    texts = [
        '{"common":{"mid":"a","is_new":"1"},"k":1,"k":2,"n":1.10,"big":1e400,"ts":5}',
        ' { "ts" : 5 , "common" : { "is_new" : 1 , "z" : [ 1.0 ] } , "common":{ "mid":"b" } } ',
        '{"ts":5,"common":null}', '{"ts":5}', '{"common":{}}',
        '{"x":{"common":{"is_new":"7"}},"common":{"is_new":"7"}}',
        '{"common":{"x":{"is_new":"7"}}}', "[" * 30 + "]" * 30,
        '{"deep":' + "[" * 40 + "]" * 40 + ',"common":{"is_new":"7"}}']
    want = [
        '{"common":{"mid":"a","is_new":"0"},"k":1,"k":2,"n":1.10,"big":1e400,"ts":5}',
        ' { "ts" : 5 , "common" : { "is_new" : 1 , "z" : [ 1.0 ] } , "common":{"is_new":"0", "mid":"b" } } ',
        texts[2], texts[3], '{"common":{"is_new":"0"}}',
        '{"x":{"common":{"is_new":"7"}},"common":{"is_new":"0"}}',
        '{"common":{"is_new":"0","x":{"is_new":"7"}}}', texts[7],
        '{"deep":' + "[" * 40 + "]" * 40 + ',"common":{"is_new":"0"}}']
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    got = df.select("i", jt.with_member(F.col("t"), ("common", "is_new"), F.lit('"0"')).alias("n"))
    assert [r.n for r in got.orderBy("i").collect()] == want


def test_long_texts(spark):
    many = "{" + ",".join(f'"k{i}":{i}' for i in range(30_000)) + ',"common":{"is_new":"9"}}'
    text = '{"s":"' + "x" * 1_000_000 + '","common":{"is_new":"9"}}'
    df = spark.createDataFrame([(many,), (text,), ("{" * 100_000,), ("{\"a\":" * 50_000,)], "t string")
    got = df.select(jt.with_member(F.col("t"), ("common", "is_new"), F.lit('"0"')).alias("n")).collect()
    assert got[0].n == many.replace('"9"', '"0"') and got[1].n == text.replace('"9"', '"0"')
    assert got[2].n == "{" * 100_000


def test_work_grows_with_the_depth_of_a_path(spark):
    df = spark.createDataFrame([('{"k\\\\":1,"a":{"a":{"a":7}}}',)], "t string")

    def found(depth):
        value = F.col("t")
        for _ in range(depth):
            value = jt.member(value, "a")
        return df.select(F.inline(F.array(F.struct(value.alias("v")))))

    def patterns(depth):
        return found(depth)._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract")

    assert [found(d).first().v for d in (1, 2, 3)] == ['{"a":{"a":7}}', '{"a":7}', "7"]
    assert patterns(3) == 3 * patterns(1)
    keys = df.select(F.inline(F.array(F.struct(jt.key_of(F.col("t")).alias("k")))))
    assert keys._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract") == 1
