"""Text functions against plain Python on small fixtures."""

import html
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from quarry.functions import ids
from quarry.functions import text as tx

SAMPLES = ["", "  a 　 b\t\nc ", "x<br/>y<p class='a'>z</p>\r\nq\rr", "&amp;lt;b&amp;gt; &quot;hi&quot; <i>t</i>\x07\x7f\x85", "a < b && c", "ＡＢＣ 123 ß", " pad ", None]
TAGS = re.compile(tx.ANY_TAG)


def one(spark, values, expr):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, x string")
    return [r.y for r in rows.select("k", expr.alias("y")).orderBy("k").collect()]


def clean_reference(v):
    if v is None:
        return None
    if "&" in v or "<" in v:
        for _ in range(3):
            v = html.unescape(v)
        v = TAGS.sub("", re.sub(tx.BREAK_TAG, "\n", v))
    v = re.sub("\r\n?", "\n", v).replace("\t", " ")
    return "".join(c for c in v if c == "\n" or not (ord(c) < 32 or 127 <= ord(c) < 160)).strip()


@pytest.mark.parametrize("every", [False, True])
def test_clean(spark, every):
    assert one(spark, SAMPLES, tx.clean("x", all_entities=every)) == [clean_reference(v) for v in SAMPLES]


def test_clean_rounds(spark):
    assert one(spark, ["&amp;lt;b"], tx.clean("x", 1)) == ["&lt;b"]


def test_squeeze_and_strip(spark):
    assert one(spark, SAMPLES, tx.squeeze("x")) == [" ".join((v or "").split()) for v in SAMPLES]
    assert one(spark, SAMPLES[:-1], tx.strip("x")) == [v.strip() for v in SAMPLES[:-1]]


def test_canonical(spark):
    got = one(spark, ["身份证", " 身 份 证 ", "ＡＢＣ123", "", None], tx.canonical("x"))
    assert got == ["身份证", "身份证", "abc123", "", ""]


def test_scoring_form_and_tokens(spark):
    assert len(set(one(spark, ["材料：Ａ，Ｂ。；", "材料:A,B.;"], tx.scoring_normal("x")))) == 1
    assert one(spark, ["excel表格式xlsx", "a,b.c;"], tx.tokens("x")) == [["excel", "表", "格", "式", "xlsx"], ["a", "b", "c"]]


def test_bag_f1(spark):
    rows = spark.createDataFrame([(list("abcde"), list("abcd")), ([], []), (["a"], []), (["a", "a"], ["a"])], "p array<string>, g array<string>")
    assert [round(r.f, 9) for r in rows.select(tx.bag_f1(F.col("p"), F.col("g")).alias("f")).collect()] == [round(8 / 9, 9), 1.0, 0.0, round(2 / 3, 9)]


def test_split_values(spark):
    assert one(spark, ["a, b、a;;c ", "镇（乡、街道）级"], tx.split_values("x")) == [["a", "b", "c"], ["镇（乡", "街道）级"]]
    assert one(spark, ["镇（乡、街道）级"], tx.split_values("x", tx.SEPARATORS_NO_DUN)) == [["镇（乡、街道）级"]]


def test_small_functions(spark):
    assert one(spark, ["PT19M48.888S", "PT1H", "x", None], tx.iso_seconds("x")) == [1188.888, 3600.0, 0.0, 0.0]
    assert one(spark, ["5", "5工作日", ""], tx.with_unit("x", F.lit("工作日"))) == ["5个工作日", "5工作日", ""]
    assert one(spark, ['{"b":1,"a":[2]}', "x"], tx.canonical_json("x")) == ['{"a": [2], "b": 1}', None]
    assert one(spark, ["```json\n[1, 2]\n```", "no"], tx.json_array_text("x")) == ["[1, 2]", None]
    assert one(spark, ["abc", "abcd"], tx.cut("x", 3)) == ["abc", "abc…"]
    assert one(spark, ["a"], tx.numbered(F.array(F.lit("p"), F.lit("q")))) == ["1. p\n2. q"]


def test_ids(spark):
    assert one(spark, ["a b/c", "", "__"], ids.safe_component("x"))[0] == "a_b_c"
    import hashlib

    assert one(spark, [""], ids.safe_component("x")) == [hashlib.sha1(b"").hexdigest()[:16]]
    assert one(spark, ["x"], ids.ordinal_id("x", "P", F.lit(123))) == ["x#P123"]
    assert one(spark, ["x"], ids.hashed_id("LC", "x", F.lit("y"))) == ["LC-" + hashlib.md5(b"x|y").hexdigest()[:24]]


def test_nfkc_matches_python(spark):
    values = ["ﬁ ①", "Ⅷ", "ｶﾞ"]
    assert one(spark, values, tx.canonical("x")) == [re.sub(r"\s+", "", unicodedata.normalize("NFKC", v)).casefold() for v in values]
