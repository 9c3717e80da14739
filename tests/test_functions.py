"""Column functions against values worked out by hand, or by Python's own json and hmac."""

import hashlib
import hmac
import json
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tracewell.functions import hashing, redact, sizing, text, url


def php_size(value) -> int:
    return len(json.dumps(value, separators=(",", ":")).replace("/", "\\/"))


def test_truncation_counts_the_suffix(apply):
    out = apply(lambda c: text.truncate_with_suffix(c, 20), ["x" * 20, "x" * 21, "é" * 30, None])
    assert out == ["x" * 20, "xxxxx... (truncated)", "ééééé... (truncated)", None]


@pytest.mark.parametrize(
    "name,valid",
    [("cart_viewed", True), ("abc", True), ("ab", False), ("a" * 50, True), ("a" * 51, False), ("Cart", False),
     ("9cart", False), ("_cart", False), ("cart-viewed", False), ("cart viewed", False), ("cart\n", False), (None, False)],
)
def test_event_names(apply, name, valid):
    assert apply(text.valid_event_name, [name]) == [valid]


def test_utf8_cut_never_splits_a_character(apply):
    samples = ["abc", "aé€😀b", "😀😀😀", "éééé", ""]
    for limit in range(4, 9):
        wanted = [s.encode()[:limit].decode(errors="ignore") for s in samples]
        assert apply(lambda c: text.cut_utf8(c, limit), samples) == wanted


def test_dates(apply):
    out = apply(text.is_date, ["2024-01-01T00:00:00+00:00", "2024-01-01", "2024-13-01", "soon", "", "2024-01-01 10:00", None])
    assert out == [True, True, False, False, False, True, False]
    spelled = [
        "Mon, 01 Jan 2024 10:00:00 +0000", "Mon, 01 Jan 2024 10:00:00 GMT", "2024/01/01", "2024.1.31 10:30", "1 January 2024", "1-Feb-2024",
        "January 1, 2024", "Jan 1st 2024", "1/31/2024",
    ]
    assert all(apply(text.is_date, spelled))
    assert not any(apply(text.is_date, ["2024/02/30", "31/1/2024", "2024/1.31", "99 January 2024", "January 2024", "2024/01/01x", "2024-02-30"]))


def test_long_keys_hide_no_secret(apply):
    texts = ["w" * n + "password=abc, next" for n in (0, 63, 64, 65, 5000)]
    assert all("abc" not in r and r.endswith(", next") for r in apply(redact.redact_text, texts))
    keys = ["\\n" + "x" * n + "password" + '\\"' + "y" * n for n in (0, 499, 501, 100_000)]
    assert apply(redact.redact_json, ['{"%s":"s3","b":1}' % k for k in keys]) == ['{"%s":"[REDACTED]","b":1}' % k for k in keys]


def test_json_sizes(apply):
    samples = ["", "plain", "a/b", 'quote " and \\', "tab\t\n\r\b\f\x01", "é€", "😀", "x" * 1000]
    assert apply(sizing.json_bytes, samples) == [php_size(s) for s in samples]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=("Cs",)), max_size=40), min_size=1, max_size=20))
def test_json_sizes_of_any_text(apply, samples):
    samples = [s.replace("\x7f", "") for s in samples]
    assert apply(sizing.json_bytes, samples) == [php_size(s) for s in samples]


def test_sizes_are_measured_in_one_replace_of_the_text(apply):
    """What needs one byte is taken out in whole runs; a text without floats is searched for them only in what is left."""
    values = ["a/é日😀 12 3e", "3f12e4ab", "x1.5", "1.5/2", "_2.5", "7.", ""]
    shown = [json.dumps({"k": v, "f": [1.25, 3], "h": f"{v}2e7"}, ensure_ascii=False) for v in values]
    assert apply(sizing.json_text_bytes, shown) == [len(json.dumps(json.loads(t)).replace("/", "\\/")) for t in shown]
    left = apply(lambda c: F.regexp_replace(c, sizing._ONE_BYTE, ""), ["abc 12 3e", "é1", "a/b", "1.5", '{"a":12e4}'])
    assert left == ["", "é", "/", "1", "12"]


def test_sizes_of_plain_texts_need_no_search_of_the_text(spark):
    """One-byte texts without escapes are measured by their bytes, slashes and the numbers between their strings."""
    texts = ['{"a":"%s","f":[%s, -%s]}' % (s, f, f) for s in ("", "1.50", "a/b 2.0", "[1.0,", "é/1.0", 'q\\"1.0,\\"', "3e5")
             for f in ("1.25", "1200.0", "0.0", "0.0012", "7", "12345.5e0", "1.50", "100.0e-1", "123456789012345.5")]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")

    def php(t):
        made = json.loads(t)
        shown = ",".join(printed(x) if isinstance(x, float) else str(x) for x in made["f"])
        spaces = t.split('"f"')[1].count(" ")
        return len(json.dumps(made["a"]).replace("/", "\\/")) + len('{"a":,"f":[]}') + len(shown) + spaces

    got = [r[0] for r in rows.orderBy("i").select(sizing.json_text_bytes("t")).collect()]
    assert got == [php(t) for t in texts]
    assert rows.limit(1).select(sizing.json_text_bytes(F.lit(None).cast("string"))).first()[0] is None
    hashes = spark.createDataFrame([('{"h":"' + "9e3" * 40 + '"}',)], "t string")
    assert hashes.select(sizing.json_text_bytes("t")).first()[0] == 128


def test_patterns_ask_for_first_letters_and_single_characters():
    """Most places in a text begin no fragment; classes of single characters are one look each."""
    assert redact._alternatives(("token", "api-key", "")) == r"(?=[ta])(?:token|api\-key)"
    assert redact._alternatives(()) == ""
    assert r"\s" not in redact.URL_SHAPE and r"\s" not in redact.QUERY_SHAPE


def test_whole_floats_print_without_fraction(spark):
    row = spark.sql("""SELECT parse_json('{"a":1000.0e0,"b":"v 1.0,","c":[2.0e0,2.5e0]}') AS v""")
    assert row.select(sizing.json_text_bytes(F.to_json("v"))).first()[0] == len('{"a":1000,"b":"v 1.0,","c":[2,2.5]}')


def printed(x):
    """A float as the encoder prints it, from the fewest digits."""
    sign, exact = "-" if str(x)[0] == "-" else "", Decimal(repr(abs(x)))
    digits = "".join(map(str, exact.as_tuple().digits))
    p, digits = len(digits) + exact.as_tuple().exponent, digits.rstrip("0")
    if not digits:
        return sign + "0"
    if p < -3 or p > 17:
        return f"{sign}{digits[0]}.{digits[1:] or '0'}e{'-' if p < 1 else '+'}{abs(p - 1)}"
    if p <= 0:
        return f"{sign}0.{'0' * -p}{digits}"
    return sign + digits[:p].ljust(p, "0") + ("." + digits[p:] if len(digits) > p else "")


def test_floats_of_all_magnitudes(spark):
    import random
    import struct

    rng = random.Random(4)
    values = [0.0, -0.0, 1.0, 1e7, 1e15, 1e16, 1e17, 1e18, 1e25, 1.5e-7, 1e-3, 1e-4, 1e-5, 0.5, -2.5, 123456.789, 5e-324, 2.0e-3, 8.41e21, 1e23, 2.0**-44,
              1.7976931348623157e308, 2.2250738585072014e-308, 9007199254740993.0, 0.1 + 0.2, 1 / 3, 99999999999999990.0, 9.999999999999999e22]
    while len(values) < 3000:
        x = struct.unpack("d", rng.randbytes(8))[0]
        values += [v for v in (x, rng.uniform(-1, 1) * 10 ** rng.randint(-8, 20), round(rng.uniform(0, 1000), 2)) if v == v and abs(v) < 1.8e308]
    rows = spark.createDataFrame([(i, v, '{"a":[%r,"1.0E9",%r]}' % (v, v)) for i, v in enumerate(values)], "i int, v double, t string")
    made = F.to_json(F.struct(F.array("v", "v").alias("a")))
    for r in rows.select("v", "t", made.alias("j"), sizing.json_text_bytes("t").alias("n"), sizing.json_text_bytes(made).alias("m")).collect():
        want = len(printed(r.v))
        assert r.m == 2 * want + len('{"a":[,]}'), (r.v, r.j)
        assert r.n == 2 * want + len('{"a":[,"1.0E9",]}'), (r.v, r.t)


def test_cap_is_inclusive(spark):
    row = spark.sql("""SELECT parse_json('{"a":"é"}') AS v""")
    assert row.select(F.to_json(sizing.cap_bytes(F.col("v"), 14, "big"))).first()[0] == '{"a":"é"}'
    assert row.select(F.to_json(sizing.cap_bytes(F.col("v"), 13, "big"))).first()[0] == '{"_truncated":"big"}'


@pytest.mark.parametrize("salt", ["s", "k" * 64, "long" * 40, "sälz"])
def test_hmac(apply, salt):
    samples = ["", "abc", "é😀", "x" * 200]
    wanted = [hmac.new(salt.encode(), s.encode(), hashlib.sha256).hexdigest() for s in samples]
    assert apply(lambda c: hashing.hmac_sha256(c, salt), samples) == wanted


def test_fingerprints(spark):
    rows = spark.sql("SELECT '10.0.0.1' AS ip, repeat('u', 150) AS ua, timestamp_ntz'2024-05-06 23:59:59' AS ts")
    got = rows.select(
        hashing.session_hash(F.col("ip"), F.col("ua"), F.col("ts"), "s"),
        hashing.session_hash(F.lit(None).cast("string"), F.lit(None).cast("string"), F.col("ts"), "s"),
        hashing.user_agent_hash(F.lit(""), "s"),
        hashing.visit_hash(F.lit(""), "s"),
    ).first()
    digest = lambda v: hmac.new(b"s", v.encode(), hashlib.sha256).hexdigest()
    assert list(got) == [digest("10.0.0.1|" + "u" * 100 + "|2024-05-06"), digest("||2024-05-06"), "", None]


REDACTED_TEXT = {
    "Connection failed with password=hunter2 for user": "Connection failed with password=[REDACTED] for user",
    "Error: failed with api_key=sk_1 at app.js:1:1": "Error: failed with api_key=[REDACTED] at app.js:1:1",
    "bin/worker sync --token=abc": "bin/worker sync --token=[REDACTED]",
    '{"api_key":"sk_live","status":"error"}': '{"api_key":[REDACTED],"status":"error"}',
    'token = "a b" next': "token = [REDACTED] next",
    'secret: "a\\"b" x': "secret: [REDACTED] x",
    "Authorization: Bearer abc.def rest": "Authorization: [REDACTED] rest",
    'password="never closed here': "password=[REDACTED]",
    "MY_API_KEY=1;foo=2": "MY_API_KEY=[REDACTED];foo=2",
    "nothing to see, key=1": "nothing to see, key=1",
    "": "",
}


def test_redact_text(apply):
    assert apply(redact.redact_text, list(REDACTED_TEXT)) == list(REDACTED_TEXT.values())


def test_redaction_of_long_runs_is_linear(apply):
    long = "a" * 200_000 + " token=x"
    assert apply(redact.redact_text, [long, '"' + "\\n" * 50_000 + '" secret=' + '"' + "\\n" * 50_000 + '" end']) == [
        "a" * 200_000 + " token=[REDACTED]",
        '"' + "\\n" * 50_000 + '" secret=[REDACTED] end',
    ]


REDACTED_URLS = {
    "https://app.test/checkout?token=x&page=2": "https://app.test/checkout?token=[REDACTED]&page=2",
    "https://a/cb#access_token=1&expires_in=2": "https://a/cb#access_token=[REDACTED]&expires_in=2",
    "/x?a=1&API_KEY=2#section-token": "/x?a=1&API_KEY=[REDACTED]#section-token",
    "https://u/?a=b&user[password]=1&c=": "https://u/?a=b&user[password]=[REDACTED]&c=",
    "/x?signature=1&token=2&q=token": "/x?signature=[REDACTED]&token=[REDACTED]&q=token",
    "/token=1/x": "/token=1/x",
    "?token=": "?token=[REDACTED]",
    "/plain": "/plain",
}


def test_redact_url(apply):
    assert apply(redact.redact_url, list(REDACTED_URLS)) == list(REDACTED_URLS.values())


REDACTED_PATHS = {
    "https://app.test/reset/abc123?page=2": "https://app.test/reset/[REDACTED]?page=2",
    "/reset/abc123?next=https://app.test/abc123": "/reset/[REDACTED]?next=https://app.test/abc123",
    "//abc123/abc123/p": "//abc123/[REDACTED]/p",
    "/app#/reset/abc123": "/app#/reset/[REDACTED]",
    "/app#/reset/abc123?x=abc123": "/app#/reset/[REDACTED]?x=abc123",
    "/abc1234/abc123x": "/abc1234/abc123x",
    "https://abc123/": "https://abc123/",
}


def test_redact_url_path(apply):
    assert apply(lambda c: redact.redact_url_path(c, ["abc123"]), list(REDACTED_PATHS)) == list(REDACTED_PATHS.values())
    assert apply(lambda c: redact.redact_url_path(c, None), ["/abc123"]) == ["/abc123"]


NESTED = [
    (
        {"api_token": "x", "nested": {"password": ["h", {"a": 1}], "plan": "pro"}, "endpoint": "https://api.test/v1?api_key=leaked&page=2"},
        {"api_token": "[REDACTED]", "nested": {"password": "[REDACTED]", "plan": "pro"}, "endpoint": "https://api.test/v1?api_key=[REDACTED]&page=2"},
    ),
    ({"link": "/reset/abc123?next=/account"}, {"link": "/reset/[REDACTED]?next=/account"}),
    ({"prose": "see https://a.b/?token=1 now", "json": '{"token":1}', "pair": "token=1"}, None),
    ([{"Authorization": None}, "token", 3.5, True, None], [{"Authorization": "[REDACTED]"}, "token", 3.5, True, None]),
    ({"a,\"token": {"b": "x]}"}, "c": "token"}, {"a,\"token": "[REDACTED]", "c": "token"}),
    ({"quoted": 'he said "/x?token=1" twice', "tail": '\\'}, None),
    ({"/x?token=1": "/x?token=1"}, {"/x?token=1": "[REDACTED]"}),
    ({"list": ["/x?token=1", ["/y?secret=2&z=3"]]}, {"list": ["/x?token=[REDACTED]", ["/y?secret=[REDACTED]&z=3"]]}),
    ({}, None),
    ("text", None),
]


def test_redact_nested(spark):
    rows = spark.createDataFrame([(json.dumps(before),) for before, _ in NESTED], "j string")
    out = rows.select(F.to_json(redact.redact_variant(F.parse_json("j"), secrets=["abc123"]))).collect()
    assert [json.loads(r[0]) for r in out] == [before if after is None else after for before, after in NESTED]


def deep(value, depth, limit, marker):
    if depth >= limit:
        return marker
    if isinstance(value, dict):
        return {k: deep(v, depth + 1, limit, marker) for k, v in value.items()}
    if isinstance(value, list):
        return [deep(v, depth + 1, limit, marker) for v in value]
    return value


_JSON = st.recursive(
    st.none() | st.booleans() | st.integers(-9, 9) | st.sampled_from(["x", "a\"b", "[", "}", ",:", "\\"]),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.sampled_from(["k", "l\"", "m:", "n{"]), inner, max_size=3),
    max_leaves=12,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_JSON, min_size=1, max_size=15))
def test_depth_limit_on_any_json(apply, values):
    out = apply(lambda c: redact.sanitize_depth_json(F.to_json(F.parse_json(c)), 3), [json.dumps(v) for v in values])
    assert [json.loads(o) for o in out] == [deep(v, 0, 3, "[Max depth exceeded]") for v in values]


def request(spark, **context):
    """A context that keeps its order; `createDataFrame` of a dict does not."""
    entries = [F.lit(x) for pair in context.items() for x in pair]
    made = F.create_map(*entries) if entries else F.create_map().cast("map<string,string>")
    return spark.range(1).select(made.alias("c"))


@pytest.mark.parametrize(
    "context,error_url,event_url",
    [
        ({"HTTP_HOST": "a.test", "REQUEST_URI": "/x", "HTTPS": "on"}, "https://a.test/x", "https://a.test/x"),
        ({"HTTP_HOST": "", "SERVER_NAME": "b.test", "REQUEST_URI": "/x"}, "/x", "http://b.test/x"),
        ({"HTTP_HOST": "a.test", "HTTPS": "OFF", "REQUEST_SCHEME": "HTTPS"}, "http://a.test", "https://a.test/"),
        ({"SERVER_NAME": "s", "SERVER_PORT": "443"}, "http://s", "https://s/"),
        ({}, None, None),
    ],
)
def test_the_two_url_rules(spark, context, error_url, event_url):
    row = request(spark, **context).select(url.error_request_url(F.col("c")), url.event_request_url(F.col("c"))).first()
    assert list(row) == [error_url, event_url]


def test_headers(spark):
    context = {"HTTP_ACCEPT": "a", "CONTENT_TYPE": "x", "SERVER_NAME": "s", "HTTP_X_TOKEN": "t", "HTTP_CONTENT_TYPE": "y",
               "HTTP_REFERER": "/r?token=1", "HTTP_USER_AGENT": "u" * 600}
    headers = request(spark, **context).select(url.mask_headers(url.request_headers(F.col("c"))).alias("h")).first().h
    got = {h["name"]: h["values"] for h in headers}
    assert got.pop("user-agent")[0].endswith("... (truncated)")
    assert got == {"accept": ["a"], "content-type": ["y"], "x-token": ["***"], "referer": ["/r?token=[REDACTED]"]}
    assert request(spark, SERVER_NAME="x").select(url.request_headers(F.col("c"))).first()[0] is None
    many = {f"HTTP_X{i}": "1" for i in range(60)}
    assert request(spark, **many).select(F.size(url.mask_headers(url.request_headers(F.col("c"))))).first()[0] == 50


@pytest.mark.parametrize(
    "context,allowed",
    [
        ({"HTTP_HOST": "a.test"}, True),
        ({"HTTP_HOST": "A.test:443", "HTTP_ORIGIN": "https://a.TEST"}, True),
        ({"HTTP_HOST": "a.test", "HTTP_ORIGIN": "https://a.test:8443"}, False),
        ({"HTTP_HOST": "a.test", "HTTP_ORIGIN": "null"}, False),
        ({"HTTP_HOST": "a.test", "HTTP_ORIGIN": "", "HTTP_REFERER": "http://a.test/page?x=1"}, True),
        ({"HTTP_HOST": "a.test", "HTTP_ORIGIN": "https://full.test"}, True),
        ({"HTTP_HOST": "a.test", "HTTP_ORIGIN": "http://full.test"}, False),
        ({"HTTP_HOST": "a.test", "HTTP_ORIGIN": "http://bare.test:8443"}, True),
    ],
)
def test_origins(spark, context, allowed):
    listed = ("https://full.test", "bare.test:8443", "")
    assert request(spark, **context).select(url.origin_allowed(F.col("c"), listed)).first()[0] is allowed
