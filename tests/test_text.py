"""Edge rows for the text functions (FIXTURES §D) and property tests
against a plain-Python statement of each rule."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from dossier.functions import text as T
from dossier.functions.states import decode_state
from dossier.operators.entities import normalise


def one(spark, expr, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr).collect()]


def test_title_case(spark):
    assert one(spark, T.title_case("s"), [("ßen weiß",)], "s string") == ["ßen weiß".title()]
    got = one(spark, T.title_case("s"), [("o'neil smith-jones 3rd",), ("",), (None,)], "s string")
    assert got == ["O'Neil Smith-Jones 3Rd", "", None]


def test_decode_state(spark):
    got = one(spark, decode_state("s"), [(" al ",), ("AL",), ("zz",), (None,), ("\tny\n",)], "s string")
    assert got == ["Alabama", "AL", "zz", None, "New York"]


def test_normalise_full_name(spark):
    df = spark.createDataFrame([(0, "0", "Ann", None, None, None, 1990, "al")],
                               "row long, candid string, first string, middle string, last string, "
                               "suffix string, min_year int, sab string")
    r = normalise(df).first()
    assert (r["full"], r["first"], r["middle"], r["state"]) == ("ann", "ann", None, "Alabama")


def test_keyword_excerpt_edges(spark):
    rows = [("abc def", "zz"), ("abc def", None), ("abc def", ""), ("blacksmith x", "smith"),
            ("a  b c", "a"), ("smith a accessibility b", "smith"),
            (" ".join(["smith"] + ["w"] * 399 + ["accessibility", "z"]), "smith"),
            ("x smith\n  \n y", "smith")]
    got = one(spark, T.keyword_excerpt("t", "p"), rows, "t string, p string")
    assert got[:6] == ["", "", "", "smith x", "a  b c", "smith a accessibility"]
    assert got[6] == " ".join(["smith"] + ["w"] * 399)      # stop word at 401: plain cap
    assert got[7] == "smith y"


def test_cascade(spark):
    rows = [("john met jim", None, "jim", "x"), ("john met jim", "met", "jim", "x"), ("none", "a", "b", "c")]
    df = spark.createDataFrame(rows, "t string, last string, first string, middle string")
    out = df.select(T.cascade_excerpt("t", "last", "first", "middle").alias("e"),
                    T.cascade_level("t", "last", "first", "middle").alias("l")).collect()
    assert [(r.e, r.l) for r in out] == [("jim", "first"), ("met jim", "last"), ("", "none")]


def test_html_to_text(spark):
    html = ('<!DOCTYPE html><html><head><title>T&amp;itle</title><script>var t="</p>";</script>'
            '<style>p{}</style></head><body><!-- hidden --><p>Hello <b>World</b><p>&amp;lt; &quot;x&quot;'
            '</body></html>')
    assert one(spark, T.html_to_text("h"), [(html,)], "h string") == ['t&itle hello world &lt; "x"']


def test_parse_list_literal(spark):
    got = one(spark, T.parse_list_literal("s"), [("['a', 'b']",), ("[]",), ("['x,y']",)], "s string")
    assert got == [["a", "b"], [""], ["x", "y"]]


def test_recover_excerpt(spark):
    got = one(spark, T.recover_excerpt("s"),
              [("no markers",), ("a text: one text: two If any desired x If any desired y",)], "s string")
    assert got == ["no markers", "two "]


def test_null_tokens(spark):
    vals = ["N/A", "NA", "NULL", "None", "nan", "n/a", "", " N/A ", "kept"]
    got = one(spark, T.null_tokens("s"), [(v,) for v in vals], "s string")
    assert got == [None] * 8 + ["kept"]


def excerpt_spec(text, phrase, max_words=400, stop="accessibility"):
    """Plain statement of the excerpt rule."""
    if not phrase or text is None or phrase not in text:
        return ""
    t = re.sub(r"[ \t\n\r\f]*\n[ \t\n\r\f]*", " ", text[text.index(phrase):])
    words = t.split(" ")
    head = words[:max_words]
    n = head.index(stop) + 1 if stop in head else max_words
    return " ".join(words[:n])


ALPHA = st.sampled_from(list("ab \n\t") + ["cd", "accessibility", "é"])


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.lists(ALPHA, max_size=60).map("".join),
                          st.sampled_from(["a", "b", "cd", "b a", "é", ""])), min_size=1, max_size=40))
def test_excerpt_property(spark, pairs):
    got = one(spark, T.keyword_excerpt("t", "p", max_words=7), pairs, "t string, p string")
    assert got == [excerpt_spec(t, p, max_words=7) for t, p in pairs]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from(list("abC' -3.é")), max_size=20).map("".join), min_size=1, max_size=40))
def test_title_case_property(spark, words):
    got = one(spark, T.title_case("s"), [(w,) for w in words], "s string")
    assert got == [w.title() for w in words]


def test_html_by_expected_strings(spark):
    cases = {
        "<p>Jos&eacute; &#8217;s &#x27;x&#X27; a&mdash;b</p>": "josé ’s 'x' a—b",
        "a<script>var x = '<b>';": "a",
        "a<style>p{}": "a",
        'x <a title="a>b" href=\'c>d\'>link</a> y': "x link y",
        "1 < 2 and 3 > 2": "1 < 2 and 3 > 2",
        "&amp;lt; &lt;b&gt; &nosuch; &#0; &#xD800; &#99999999; & &": "&lt; <b> &nosuch; &#0; &#xd800; &#99999999; & &",
        "<!-- <p>no</p> -->yes<!DOCTYPE html>": "yes",
        "<p title='it>left": "left",
        "a&nbsp;  b\n\nc": "a b c",
        "&copy;2020 R&amp;D &#128512;": "©2020 r&d \U0001f600",
        "": "", "<br>": "",
    }
    df = spark.createDataFrame([(k,) for k in cases], "h string")
    got = {r.h: r.t for r in df.select("h", T.html_to_text("h").alias("t")).collect()}
    assert got == cases


def test_space_is_that_of_python(spark):
    chars = [chr(c) for c in range(0x3100) if c != 10]
    df = spark.createDataFrame([(i, c + "x" + c, "a" + c + "\n" + c + "b") for i, c in enumerate(chars)], "i int, s string, n string")
    got = df.select("i", T.strip("s").alias("s"), F.regexp_replace("n", T.NEWLINE_SPACE, " ").alias("n")).collect()
    import re
    for r in got:
        c = chars[r.i]
        assert r.s == (c + "x" + c).strip(), hex(ord(c))
        assert r.n == re.sub(r"\s*\n\s*", " ", "a" + c + "\n" + c + "b"), hex(ord(c))


def test_pdf_sources_are_their_first_pages(spark):
    rows = [("http://x/a.pdf", "One\fTwo\fThree\fFour"), ("http://x/b.pdf?c", "Only"), ("http://x/d", "<p>Page</p>"), ("u.pdf", None)]
    df = spark.createDataFrame(rows, "url string, html string")
    got = [r.t for r in df.select(T.source_text("url", "html").alias("t")).collect()]
    assert got == ["one two three", "only", "page", None]
