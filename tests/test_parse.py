"""Reply parsing edge rows (FIXTURES §D)."""

from dossier.operators.parse import birth_year, parse_replies

VALID = ('{"College Major": "math", "Undergraduate Institution": "u", '
         '"Highest Degree and Institution": "ba", "Work History": "w", "Confidence Level": "80"}')


def parse(spark, replies):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(replies)], "i int, response string")
    return {r.i: r for r in parse_replies(df).collect()}


def test_valid_missing_extra(spark):
    out = parse(spark, [VALID, '{"College Major": "x"}', VALID[:-1] + ', "Party": "d", "Aa": "1"}', "{}"])
    assert out[0].parsed and out[0].college_major == "math" and out[0].confidence_int == 80
    assert out[1].parsed and out[1].work_history == "" and out[1].confidence == ""
    assert out[2].parsed and out[2].extra_keys == "Aa,Party"
    assert out[3].parsed and out[3].college_major == ""


def test_rejected(spark):
    bad = ["[]", '""', "5", "null", '{"College Major": "x"', '```json\n{"a": "b"}\n```',
           "{'College Major': 'x'}", '{"a": "b"} tail', ""]
    out = parse(spark, bad)
    assert [out[i].parsed for i in range(len(bad))] == [False] * len(bad)


def test_newline_and_duplicates(spark):
    out = parse(spark, ['{"Work History": "a\nb"}', '{"College Major": "a", "College Major": "b"}'])
    assert out[0].work_history == "ab"
    assert out[1].college_major == "b"   # last duplicate wins


def test_nested_value_kept_as_json(spark):
    out = parse(spark, ['{"Work History": ["a", "b"]}'])
    assert out[0].work_history == '["a","b"]'


def test_birth_year(spark):
    df = spark.createDataFrame([("1956",), ("Graduated in 1970",), ("N/A",), ("born 1940, graduated 1962",)],
                               "r string")
    assert [r[0] for r in df.select(birth_year("r")).collect()] == [1956, 1948, None, 1940]


def test_malformed_replies_are_not_parsed(spark):
    import json
    texts = ['{"a":"x"} {"b":"y"}', '{"a":"x"} tail}', '{"a":"x"}}', '{"a":"x"},{"b":"y"}', "[]", '""', "[{}]", "{",
             '{"a":"x"}', '{}', '{"a":NaN}', '{"a":-Infinity, "b":1}', '{"a":"x","a":"y"}', ' {"a": {"b": [1]}} ',
             '{"a": ": NaN, "}', '{"a":1,}', "NaN"]

    def strict(text):
        try:
            return isinstance(json.loads(text), dict)
        except ValueError:
            return False
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, response string")
    got = {r.i: r.parsed for r in parse_replies(df).collect()}
    assert got == {i: strict(t) for i, t in enumerate(texts)}


def test_failure_queue_is_one_defined_row_per_key(spark):
    from dossier.operators import rerun as R
    dead = spark.createDataFrame([("1", "prompt", "b"), ("1", "prompt", "a"), ("2", "prompt", "c"), ("3", "parse", "d")],
                                 "candid string, stage string, reason string")
    done = spark.createDataFrame([("2",), ("2",)], "candid string")
    assert [tuple(r) for r in R.failure_queue(dead, done).collect()] == [("1", "prompt", "a")]
