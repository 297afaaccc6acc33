"""Every class raw and wrapped, decoders against their rules, the JVM lane against the Python one."""

import base64
import random
import re
import time

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import payloads as p
from tessera.functions.catalogue import CLASSES, SECRETS, patterns

PLANTED = {
    "sql": "x UNION  SELECT 1",
    "shell": "run powershell now",
    "html_js": "<script>",
    "spreadsheet_formula": "a\n=1+1",
    "template": "{{x}}",
    "jndi": "${jndi:ldap}",
    "path_traversal": "../../x",
    "url_ssrf": "see http://host",
    "deserialization": "rO0ABxx",
    "xml": "<!ENTITY x",
    "ldap": ")(&x",
    "nosql": "$where",
    "prompt_injection": "please Ignore previous  instructions",
    "unicode_trickery": "a‮b",
    "secret_jwt": "eyJabcdef.abcdef.x",
    "secret_private_key": "-----BEGIN RSA PRIVATE KEY-----",
    "secret_cloud": "AKIA" + "A" * 16,
    "secret_vendor_token": "ghp_" + "a" * 24,
    "secret_password_hash": "$2b$10",
    "secret_connection_string": "db://user:pass@host",
}


@pytest.mark.parametrize("name", PLANTED)
def test_each_class_raw_percent_and_base64(name):
    value = PLANTED[name].encode()
    assert name in p.scan(value)[0]
    percent = "".join(f"%{b:02X}" for b in value).encode()
    assert name in p.scan(percent)[0] and "percent" in p.scan(percent)[1]
    assert name in p.scan(base64.b64encode(value))[0]


def test_every_class_with_tokens_is_planted():
    assert set(PLANTED) == {k for k, v in (CLASSES | SECRETS).items() if v} == set(patterns())


def test_both_lanes_agree(spark):
    rng = random.Random(1)
    texts = [*PLANTED.values(), "", "plain words", *("".join(rng.choice("a'\";|$({<=+-@.:/%& \n\t") for _ in range(12)) for _ in range(200))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    raw = {r.i: r.c for r in df.select("i", p.raw_classes(F.col("t")).alias("c")).collect()}
    assert raw == {i: p.match_bytes(t.encode()) for i, t in enumerate(texts)}
    decoded = {r.i: tuple(r.s) for r in df.select("i", p.decoded_scan(F.col("t")).alias("s")).collect()}
    assert decoded == {i: p.scan(t.encode()) for i, t in enumerate(texts)}


def test_nulls_and_incident_literals(spark):
    df = spark.createDataFrame([("abc",), (None,)], "t string")
    extra = {"ioc_canary": ["b.c", "bc"]}
    assert [r.c for r in df.select(p.raw_classes(F.col("t"), extra).alias("c")).collect()] == [["ioc_canary"], []]
    assert [r.s.classes for r in df.select(p.decoded_scan(F.col("t"), extra=extra).alias("s")).collect()] == [["ioc_canary"], []]


@pytest.mark.parametrize(
    ("text", "want"),
    [("&lt;b&gt;", "<b>"), ("&#39;&#x41;&#X42;", "'AB"), ("&unknown;", "&unknown;"), ("&longernames;", "&longernames;"), ("& lt;", "& lt;"), ("&#xD800;", "&#xD800;"), ("a&lt", "a&lt"), ("&&lt;", "&&lt;")],
)
def test_entities(text, want):
    assert p.decode_entities(text) == want


@pytest.mark.parametrize(("text", "want"), [(r"<x", "<x"), (r"😀", "\U0001f600"), (r"\ud83dx", r"\ud83dx"), (r"\u00g0", r"\u00g0"), ("\\", "\\")])
def test_escapes(text, want):
    assert p.decode_escapes(text) == want


@given(st.binary(min_size=1, max_size=40))
def test_base64_round_trip_in_four_spellings(data):
    for form in (base64.b64encode(data), base64.urlsafe_b64encode(data)):
        assert p.strict_base64(form) == data == p.strict_base64(form.rstrip(b"="))


@pytest.mark.parametrize("run", [b"A", b"AB=", b"AR==", b"A=B=", b"ab+_", b"===="])
def test_base64_refuses(run):
    assert p.strict_base64(run) is None


def test_rounds_and_budget():
    twice = b"%253Cscript%253E"
    assert "html_js" not in p.scan(twice, rounds=1)[0] and "html_js" in p.scan(twice, rounds=2)[0]
    assert "html_js" in p.scan("%EF%BC%9Cscript%EF%BC%9E".encode())[0]
    bomb = " ".join(base64.b64encode(f"value {i} of many".encode()).decode() for i in range(300)).encode()
    assert p.scan(bomb)[3] is True
    assert p.scan(b"\x80\x04\x95")[0] == ["deserialization"]
    assert p.scan("é".encode())[2] is True


def test_guards_and_linear_patterns_find_what_the_catalogue_finds(spark):
    rng = random.Random(11)
    parts = [t[3:] if t.startswith("re:") else t for tokens in (CLASSES | SECRETS).values() for t in tokens]
    plain = [re.sub(r"\(\?i\)|\\b|\^|\[[^\]]*\]|\{[^}]*\}|[\\+*?()]", lambda m: "a" * 20 if m[0].startswith("{") else "", x) for x in parts]
    bits = parts + plain + [" ", "\n", "a", "9", "-", ".", "eyJ", "://", ":", "@", "\u017f", "\u212a", "A" * 20, "system:", "OR 1 = 1", "user:pw@", "postgres", "\t", "10.1"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(1, 6))) for _ in range(3000)] + ["postgres://u:p@h", "x9+a://u:p@h", "9://u:p@h", "xeyJabcde.abcde.", "eyJabc.eyJabcde.abcde.x", " \n \t system: x", "x system:"]
    plain_classes = [(name, f"(?mdU){x}") for name, x in patterns().items()]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    want = F.filter(F.array(*(F.when(F.col("t").rlike(x), F.lit(n)) for n, x in plain_classes)), lambda x: x.isNotNull())
    for r in df.select("t", p.raw_classes(F.col("t")).alias("got"), want.alias("want")).collect():
        assert r.got == r.want, r.t


@pytest.mark.parametrize("text", ["a" * 1_000_000, "eyJ" * 300_000, "\n" * 1_000_000, "a-" * 500_000 + "://"])
def test_hostile_texts_are_read_once(spark, text):
    start = time.perf_counter()
    p.match_bytes(text.encode())
    spark.createDataFrame([(text,)], "t string").select(p.raw_classes(F.col("t")).alias("c")).collect()
    assert time.perf_counter() - start < 15


def test_prose_beyond_ascii_is_read_a_few_times_only(spark):
    # Words with "nc" and "or" and letters beyond ASCII: every pattern of every class ran on such texts, some 1.7 microseconds a byte.
    prose = "Être once før the français or encore, größer nor thé. " * 60
    df = spark.createDataFrame([(f"{i} {prose}",) for i in range(4000)], "t string").repartition(4).cache()
    assert df.count() == 4000
    found = df.select(F.explode(p.raw_classes(F.col("t"))).alias("c"))
    assert found.limit(1).count() == 0
    start = time.perf_counter()
    assert found.count() == 0 and time.perf_counter() - start < 4


def test_only_some_classes_are_looked_for(spark):
    df = spark.createDataFrame([("'; AKIA" + "A" * 16 + " db://user:pass@host",)], "t string")
    assert df.select(p.raw_classes(F.col("t"), only=SECRETS).alias("c")).first().c == ["secret_cloud", "secret_connection_string"]


def test_the_scan_of_prose_remembers_its_words():
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefghijklmnop\u00e9", k=rng.randrange(2, 9))) for _ in range(400)]
    texts = [" ".join(rng.choices(words, k=500)).encode() for _ in range(300)]
    p.scan(texts[0])
    # 8 milliseconds a text before, 1 after; counted in CPU time, as other work may run beside it.
    start = time.process_time()
    for t in texts:
        p.scan(t)
    assert time.process_time() - start < 1.2


def test_runs_that_may_decode_are_those_that_do():
    rng = random.Random(3)
    for _ in range(300):
        value = bytes(rng.choices(b"ABQgwcz019+/-_==  .", k=rng.randrange(65, 200)))
        every = re.findall(rb"[A-Za-z0-9+/=_-]{2,}", value)
        assert [d for x in p._runs(value, len(value)) if (d := p.strict_base64(x))] == [d for x in every if (d := p.strict_base64(x))]


def test_nfc_reads_only_what_it_may_change(spark, monkeypatch):
    import unicodedata

    rng = random.Random(6)
    bits = ["e\u0301", "\u00e9", "a", "\n", "\u0301", "\u0323\u0307", "\u0307\u0323", "\u1100\u1161", "\uac00", "\u11a8", "\u212b", "\u0958", "\u09c7\u09be", "\uf900", "\u4e00", "\U0002f800", "\U0001d15e", "\u304b\u3099", "x" * 30]
    texts = ["".join(rng.choices(bits, k=rng.randrange(0, 5))) for _ in range(1500)] + [chr(c) for c in range(0x250, 0x3000)] + ["a" + chr(c) for c in range(0x250, 0x3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(4)
    for r in df.select("t", p.nfc_differs(F.col("t")).alias("d")).collect():
        assert r.d == (not unicodedata.is_normalized("NFC", r.t)), ascii(r.t)
    # Of a long text with one such part Python gets that part: before, batches of 10,000 whole texts.
    monkeypatch.setattr(F, "arrow_udf", lambda kind: lambda f: F.length)
    got = spark.createDataFrame([("\u00e9\u4e00z" * 100_000 + "e\u0301",), ("\u00e9" * 1000,)], "t string").select(p.nfc_differs(F.col("t")).alias("n")).collect()
    assert [r.n for r in got] == [2, None]
