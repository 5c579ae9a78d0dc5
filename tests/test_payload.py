import json

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from brontide.functions import exact_json, payload as P
from brontide.operators import logs as L

# payload -> log text
TEXTS = [
    (None, ""),
    ("plain text", "plain text"),
    ("{not json", "{not json"),
    ('"s"', "s"),
    ("null", ""),
    ("5", "5"),
    ("true", "true"),
    ("[]", ""),
    ('["a", "b", ""]', "a\nb"),
    ('["a", 1]', "a\n1"),
    ('{"content": "x"}', "x"),
    ('{"body": "late", "message": "early"}', "early"),
    ('{"content": "", "log": "y"}', "y"),
    ('{"content": null, "message": ["p", {"text": "q"}]}', "p\nq"),
    ('{"data": {"text": "deep"}}', "deep"),
    ('{"content": 5}', "5"),
    ('{"x": "u", "n": 1, "y": ["v", {"data": "w"}]}', "u\nv\nw"),
    ('{"n": 1, "a": true}', '{"a":true,"n":1}'),
    ('{"message": ""}', '{"message":""}'),
    ("{}", "{}"),
    ('[[["z"]], {"n": 1}]', 'z\n{"n":1}'),
    ('[{"message": "m1"}, {"message": "m2"}, null]', "m1\nm2"),
    ('"[1, 2]"', "[1, 2]"),
    ('{"content": "{\\"a\\": 1}"}', '{"a": 1}'),
    ('{"content": "a", "content": "b"}', "b"),
    (' \n\t{"content": "a", "content": "b"}', "b"),
    ('{"content": "\\u00e9\\n"}', "é\n"),
    ("[" * 50 + '"deep"' + "]" * 50, "deep"),
    ("[" * 100_000 + "]" * 100_000, ""),
    ('{"content": ' * 3_000 + '"hello"' + "}" * 3_000, "hello"),
    ('{"content": ' * 3_000 + '"hello"' + "}" * 2_999, '{"content": ' * 3_000 + '"hello"' + "}" * 2_999),
    ('{"n": ' + "9" * 5_000 + ', "a": 0.12345678901234567890}', '{"a":0.1234567890123456789,"n":' + "9" * 5_000 + "}"),
    ('["ok", NaN]', '["ok", NaN]'),
    ("5 workers started", "5 workers started"),
    ('{"content": "a"} and more', '{"content": "a"} and more'),
    ('{"content": "a"}\n{"content": "b"}', '{"content": "a"}\n{"content": "b"}'),
    ('["a"], ["b"]', '["a"], ["b"]'),
    ("1] [", "1] ["),
    ('{"content": "\\ud800!", "content": "\\udfff?"}', "??"),
    ('{"content": "x\\ud800\\ud83d\\ude00\\\\ud800"}', "x?\U0001f600\\ud800"),
    ('{"content": 1.0}', "1"), ("-0.0", "0"), ("1e-7", "0.0000001"),
    ('"no end', '"no end'),
]


def test_extract_log_text(spark):
    df = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(TEXTS)], "i int, j string")
    for row in L.extract_log_text(df, "j").collect():
        assert row["text"] == TEXTS[row["i"]][1], TEXTS[row["i"]][0]


def test_jvm_and_python_agree(spark):
    """Where the JVM decides, Python would say the same."""
    df = spark.createDataFrame([(p,) for p, _ in TEXTS if p is not None], "p string")
    rows = df.select("p", P.regular_text("p").alias("t")).collect()
    assert sum(r["t"] is not None for r in rows) > 10
    for row in rows:
        if row["t"] is not None:
            assert row["t"] == P._payload_text(row["p"])


def test_decode_payload(spark):
    cases = [("application/json; charset=utf-8", '{"content":"a"}', "a"),
             ("text/plain", '{"content":"a"}', '{"content":"a"}'), (None, "q", "q"),
             ("application/json", "no json", "no json"), ("text/plain", None, ""),
             ("application/json", None, "")]
    df = spark.createDataFrame(cases, "content_type string, body string, expected string")
    for row in L.decode_payload(df).collect():
        assert row["text"] == row["expected"]


@pytest.mark.parametrize("payload, items", [
    ('[{"a": 1}, 2, "x", {"b": 2}]', [{"a": 1}, {"b": 2}]),
    ('{"task_instances": 5, "tasks": [{"c": 1}]}', [{"c": 1}]),
    ('{"task_instances": [], "tasks": [{"c": 1}]}', []),
    ('{"items": "[{}]"}', []), ('{"results": [[1], {"d": null}]}', [{"d": None}]),
    ("x", []), (None, []), ("{}", []),
    ('{"tasks": [{"a": 1}], "tasks": [{"b": 2}, {"c": 3}]}', [{"b": 2}, {"c": 3}]),
    ('{"tasks": [{"n": 123456789012345678901234567890123456789012345}]}', [{"n": 123456789012345678901234567890123456789012345}]),
    ('{"tasks": [{"a": 1}, {"b": 2}], "deep": ' + "[" * 1_500 + "]" * 1_500 + "}", [{"a": 1}, {"b": 2}]),
    ('[{"a": "' + "x" * 20_000_000 + '"}]', [{"a": "x" * 20_000_000}]),
])
def test_explode_task_instances(spark, payload, items):
    df = spark.createDataFrame([(payload,)], "payload string")
    rows = sorted(L.explode_task_instances(df).collect())
    assert [json.loads(r["task_instance"]) for r in rows] == items
    assert [r["item_no"] for r in rows] == list(range(len(items)))


@pytest.mark.parametrize("payload, url", [
    ('{"url": "u", "log_url": "v"}', "u"), ('{"url": "", "externalLogUrl": "v"}', "v"),
    ('{"url": 5, "logUrl": "v"}', "v"), ('"http://x"', "http://x"), ("http://x", "http://x"),
    ('{"url": "", "url": "u"}', "u"), ('{"url": "u", "d": ' + "[" * 3_000 + "]" * 3_000 + "}", "u"),
    ('"ftp://x"', None), ("ftp://x", None), ('["http://x"]', None), ("{}", None), (None, None)])
def test_external_log_url(spark, payload, url):
    df = spark.createDataFrame([(payload,)], "payload string")
    assert df.select(P.external_log_url("payload")).first()[0] == url


NUMBERS = [("1.0", "1"), ("-0.0", "0"), ("-0", "0"), ("0e5", "0"), ("1e-7", "0.0000001"), ("1E400", "1" + "0" * 400), ("1e401", "1E401"), ("-2.50e-500", "-2.5E-500"),
           ("123456789012345.0", "123456789012345"), ("1234567890123456", "1234567890123456"), ("0.10", "0.1"), ("1.5e3", "1500"),
           ("12345678901234567890.5", "12345678901234567890.5"), ("123456789012345678901234567890123456789", "123456789012345678901234567890123456789")]


def _texts(value) -> st.SearchStrategy:
    return st.tuples(st.sampled_from(["", " ", "\n"]), value, st.sampled_from(["", "  "])).map("".join)


_NUMBER_TEXTS = st.from_regex(r"-?(0|[1-9][0-9]{0,40})(\.[0-9]{1,40})?([eE][-+]?[0-9]{1,3})?", fullmatch=True)
_STRING_TEXTS = st.lists(st.sampled_from(["a", "é", "\U0001f600", "\uffff", "\\n", "\\u001f", "\\ud800", "\\udc00", "\\ud83d\\ude00", '\\"', "\\\\", "\x7f", "\u2028", "1e5"]),
                         max_size=4).map(lambda x: f'"{"".join(x)}"')
_JSON_TEXTS = st.recursive(_NUMBER_TEXTS | _STRING_TEXTS | st.sampled_from(["null", "true", "false"]), lambda x: (
    st.lists(_texts(x), max_size=3).map(lambda v: f"[{','.join(v)}]")
    | st.lists(st.tuples(_STRING_TEXTS, _texts(x)), max_size=3).map(lambda v: "{" + ",".join(f"{k}:{w}" for k, w in v) + "}")), max_leaves=8)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_texts(_JSON_TEXTS | st.tuples(_JSON_TEXTS, st.sampled_from([" x", ",1", "]", " {}"])).map("".join)), min_size=20, max_size=60))
def test_both_readers_give_one_form(spark, texts):
    """Whatever the JVM decides by itself is what the exact reading gives, byte for byte."""
    df = spark.createDataFrame([(t,) for t in texts], "p string")
    for r in df.select("p", P._parsed("p", "to_json(j)").alias("r")).select("p", "r.ask", "r.regular").collect():
        try:
            exact = exact_json.dumps(exact_json.loads(r["p"]))
        except ValueError:
            exact = None
        if r["ask"] is None:
            assert r["regular"] == exact, r["p"]
    for r in L.normalize_json_source(df.selectExpr("p", "p as raw_json")).collect():
        try:
            exact = exact_json.dumps(exact_json.loads(r["p"]))
        except ValueError:
            exact = exact_json.dumps(r["p"])
        assert r["raw_json"] == exact and exact_json.dumps(exact_json.loads(exact)) == exact


def test_canonical_json(spark):
    deep, long = "[" * 20_000 + "]" * 20_000, "123456789012345678901234567890123456789012345"
    cases = [(None, "{}"), ('{"b": 1, "a": [1, 2]}', '{"a":[1,2],"b":1}'), ("oops", '"oops"'), ('say "hi"', '"say \\"hi\\""'),
             ('{"a": 1, "a": 2}', '{"a":2}'), (f'{{"n": {long}}}', f'{{"n":{long}}}'), (f" {deep}", deep),
             ('{"open', '"{\\"open"'), ('{"a":1} xyz', '"{\\"a\\":1} xyz"'), ("5 workers", '"5 workers"'), ("null x", '"null x"')]
    cases += [(f'{{"b":{n}{more}, "a":1}}', f'{{"a":1,"b":{form}{more}}}') for more in ("", ',"id":1234567890123456', ',"l":[1]', ',"z":' + "9" * 60)
              for n, form in NUMBERS]
    cases += [('{"\U0001f600":1,"\uffff":2}', '{"\U0001f600":1,"\uffff":2}'), ('{"\U0001f600":1,"\uffff":2,"a":1,"a":2}', '{"a":2,"\U0001f600":1,"\uffff":2}'),
              ('{"a":"\\u001f\\/\\u00e9"}', '{"a":"\\u001F/é"}'), ('{"a":"\\u001f\\/\\u00e9","n":1e0}', '{"a":"\\u001F/é","n":1}'),
              ('{"k\\ud800":"\\udc00v"}', '{"k?":"?v"}'), ('{"k\\ud800":"\\udc00v","a":1,"a":2}', '{"a":2,"k?":"?v"}')]
    df = spark.createDataFrame(cases, "raw_json string, expected string")
    for row in L.normalize_json_source(df).collect():
        assert row["raw_json"] == row["expected"]
        assert row["content_size_bytes"] == len(row["expected"].encode())


def test_route_sources(spark):
    rows = [(0, "t", "c", None), (1, None, "c", '{"a":1}'), (2, "", None, '{"a":1}'), (3, None, None, None)]
    df = spark.createDataFrame(rows, "i int, raw_text string, raw_content string, raw_json string")
    found = {r["i"]: (r["content_type"], r["raw_content"], r["raw_json"], r["line_count"])
             for r in L.route_sources(df).collect()}
    assert found == {0: ("TEXT", "t", None, 1), 1: ("TEXT", "c", None, 1), 2: ("TEXT", "", None, 0),
                     3: ("JSON", None, "{}", None)}


def test_normalize_attempt(spark):
    df = spark.createDataFrame([("0", "-1"), ("3", "2"), (None, None)], "try_number string, map_index string")
    assert [tuple(r) for r in L.normalize_attempt(df).collect()] == [
        (1, -1, False), (3, 2, True), (1, None, False)]


def test_unknown_category_fails(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "c string")
    assert L.require_allowed(df, "c", ["a", "b"]).count() == 3
    assert [r["c"] for r in L.invalid_categories(df, "c", ["a"]).collect()] == ["b"]
    with pytest.raises(Exception, match="unknown c: b"):
        L.require_allowed(df, "c", ["a"]).collect()


def test_long_text_is_not_parsed(spark):
    """A log of 140 MB passes, declared as plain text or as JSON."""
    text = F.repeat(F.lit("0123456789"), 14_000_000)
    json_text = F.concat(F.lit('{"message": "'), text, F.lit('"}'))
    plain = spark.range(1, numPartitions=1).select(F.lit("text/plain").alias("content_type"), text.alias("body"))
    coded = spark.range(1, numPartitions=1).select(F.lit("application/json").alias("content_type"), json_text.alias("body"))
    for df in (plain, coded):
        assert L.decode_payload(df).select(F.length("text")).first()[0] == 140_000_000


@settings(max_examples=200, deadline=None)
@given(st.recursive(st.none() | st.booleans() | st.integers() | st.text() | st.floats(allow_nan=False, allow_infinity=False),
                    lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text(), x, max_size=4), max_leaves=20))
def test_flat_reader_and_writer(value):
    text = json.dumps(value)
    assert exact_json._loads_flat(text) == exact_json.loads(text)
    assert exact_json.dumps(exact_json._loads_flat(text)) == exact_json.dumps(exact_json.loads(text))
    assert json.loads(exact_json.dumps(json.loads(text))) == json.loads(text)


@pytest.mark.parametrize("text", ["", "[", "[1", "[1,", "[1 2]", "{1:2}", '{"a" 1}', '{"a":1', "tru", "1 1", "[]]", '"a', "01", "[,]"])
def test_flat_reader_refuses(text):
    with pytest.raises(ValueError):
        exact_json._loads_flat(text)


def test_unreadable_payloads(spark):
    cases = [('{"a": 1', True), ("[1,", True), ('"open', True), ('{"a": 1, "a": 2}', False), ("plain", False), (None, False),
             ("[" * 3_000 + "]" * 3_000, False), ('{"ok": 1}', False)]
    df = spark.createDataFrame(cases, "payload string, bad boolean")
    assert [r["payload"] for r in L.unreadable_payloads(df).collect()] == [p for p, bad in cases if bad]
