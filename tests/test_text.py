"""Text functions against plain Python."""

from __future__ import annotations

import hashlib
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ticketloom import constants as K
from ticketloom.functions import labels, text, vectors

STRINGS = [
    "plain", "  two  spaces ", "tag <b>bold</b> end", "tag <a\nhref=x> stays", "no break", "vt\u000bsep",
    "fs\u001csep", "call 555-123-4567 now", "x ٠١٢-٣٤٥-٦٧٨٩ y", "éaccess", "sécurité access", "emoji 🙂 ok", "İ", "   ",
    "", "a b", "line\r\nbreak", "<tel>", "12-34", "a < b > c", "tab\there", "trail \n", "\u0085x",
]


def python_clean(t: str) -> str:
    t = re.sub(r"<.*?>", "", t)
    t = re.sub(r"\s+", " ", t).strip()
    return re.sub(r"\d{3}-\d{3}-\d{4}", "<tel>", t)


def python_flag(t: str, words: list[str]) -> int:
    return int(re.search(r"\b(" + "|".join(words) + r")\b", t, re.I) is not None)


def column(spark, values, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[1] for r in rows.select("i", expr(F.col("t"))).orderBy("i").collect()]


def test_clean_text(spark):
    assert column(spark, STRINGS, text.clean_text) == [python_clean(t) for t in STRINGS]
    assert column(spark, [None], text.clean_text) == [""]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=" \t\n \u001c<>/ab5-.é٣", max_size=40), min_size=1, max_size=30))
def test_clean_text_random(spark, values):
    assert column(spark, values, text.clean_text) == [python_clean(t) for t in values]


WORDS = ["access", "éaccess", "accessé", "Access!", "ACCESS", "acceſs", "ac_cess", "access_", "1access", "hack\nmalware",
         "unhacked", "", "paſſword", "LOGİN", "logın", "security.", "x-security-y", "breach²"]


def test_flags_match_python(spark):
    got = column(spark, WORDS, lambda c: labels.keyword_flags(c)[2])
    assert got == [python_flag(t, K.KEYWORDS["security"]) for t in WORDS]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=" .-_9é", max_size=2), min_size=20, max_size=60), st.data())
def test_flags_random(spark, glue, data):
    words = [data.draw(st.sampled_from(["vpn", "VPN", "wifi", "lan", "plan", "router", "connects"])) for _ in glue]
    values = [a + w + b for a, w, b in zip(glue, words, reversed(glue))]
    got = column(spark, values, lambda c: labels.keyword_flags(c)[0])
    assert got == [python_flag(t, K.KEYWORDS["network"]) for t in values]


@pytest.mark.parametrize(
    ("topic", "sentence", "expected"),
    [
        ("network", "VPN not working", 1),
        ("network", "WiFi connection issue", 1),
        ("network", "Internet is slow", 1),
        ("network", "My screen is broken", 0),
        ("software", "Cannot install Office", 1),
        ("software", "App keeps crashing", 1),
        ("software", "Need to update Windows", 1),
        ("software", "My keyboard is broken", 0),
        ("printer", "My printer is not printing", 1),
        ("printer", "printing", 0),
        ("security", "I forgot my password and cannot login", 1),
    ],
)
def test_topics(spark, topic, sentence, expected):
    place = list(K.KEYWORDS).index(topic)
    assert column(spark, [sentence], lambda c: labels.keyword_flags(c)[place]) == [expected]


def test_serving_features(spark):
    (got,) = column(spark, ["My VPN connection is not working on my laptop"], labels.serving_features)
    assert len(got) == 8
    assert got[0] == 45 and got[1] == pytest.approx(36.0) and got[2] == 0.8
    assert got[3:] == [1, 0, 0, 1, 0]


def test_null_text_has_no_flags(spark):
    rows = spark.createDataFrame([(None,)], "t string")
    assert list(rows.select(*labels.keyword_flags(F.col("t"))).first()) == [0] * 5
    assert list(rows.select(*labels.substring_flags(F.col("t"))).first()) == [0] * 5


def test_intent_order_and_length(spark):
    cases = {
        "Merci, c'est parfait": "gratitude", "Ça marche, super": "success", "Super": "positive", "OK": "confirmation",
        "ok but it still does not work at all": None, "my mouse is dead": None,
    }
    assert column(spark, list(cases), text.intent_of) == list(cases.values())


def test_normalize_newlines(spark):
    values = ["a\n\n\n\nb", "a\nb\n\n  \n\nc ", "", "x"]
    assert column(spark, values, text.normalize_newlines) == [
        "<p>a</p><p>b</p>", "<p>a<br>b</p><p>c</p>", "", "<p>x</p>",
    ]


def test_small_helpers(spark):
    assert column(spark, ["éa🙂", None], text.text_hash) == [hashlib.sha256("éa🙂".encode()).hexdigest(), None]
    assert column(spark, ["abcdef", "abc"], lambda c: text.ellipsize(c, 3)) == ["abc...", "abc"]
    assert column(spark, ["run/1 é:x-y_z"], text.sanitize_id) == ["run_1_é_x-y_z"]
    assert column(spark, ["  ", " a ", "x" * 5001, None], text.valid_query) == [None, "a", None, None]
    assert column(spark, ["short", None, "x" * 20], text.lang_guard) == ["unknown", "unknown", None]
    assert column(spark, ["20240131_060000", "nonsense"], lambda c: text.ts_parse(c).cast("string")) == [
        "2024-01-31 06:00:00", None,
    ]
    assert column(spark, ["hello world a é1"], text.tokens) == [["hello", "world", "é1"]]
    assert column(spark, [None], lambda c: text.combine_text(c, c)) == [" "]


def test_urgency(spark):
    values = ["critical", "high", "medium", "low", "very_low", None]
    assert column(spark, values, labels.map_urgency) == ["high", "high", "medium", "low", "low", "low"]


def test_refined_queue_order(spark):
    flags = ["network", "printer", "security", "hardware", "software"]
    rows = [
        (*(1, 1, 1, 1, 1), "Product Support", K.SECURITY_QUEUE),
        (*(1, 1, 0, 1, 1), "x", K.HARDWARE_QUEUE),
        (*(1, 0, 0, 0, 1), "x", K.NETWORK_QUEUE),
        (*(0, 0, 0, 0, 0), "Product Support", K.SOFTWARE_QUEUE),
        (*(0, 0, 0, 0, 0), "Service Outages and Maintenance", K.OUTAGE_QUEUE),
        (*(0, 0, 0, 0, 0), None, K.GENERAL_QUEUE),
    ]
    df = spark.createDataFrame(rows, ", ".join(f"has_{f} int" for f in flags) + ", queue string, want string")
    got = df.select(labels.refine_queue(F.col("queue")).alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]
    apart = df.select(labels.refine_queue(F.col("queue"), merge_printer=False)).collect()
    assert apart[1][0] == K.PRINTER_QUEUE


def test_vectors(spark):
    df = spark.createDataFrame([([1.0, 0.0], [0.0, 2.0]), ([1.0, 1.0], [2.0, 2.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<float>")
    got = [r[0] for r in df.select(vectors.cosine_distance(F.col("a"), F.col("b"))).collect()]
    assert got[0] == pytest.approx(1.0) and got[1] == pytest.approx(0.0) and got[2] is None
    back = df.select(vectors.parse_vector(vectors.vector_text(F.col("a"))).alias("x"), "a").collect()
    assert all(r.x == r.a for r in back)
    best = df.select(vectors.arg_max_label(F.col("a"), ["p", "q"])).collect()
    assert [r[0] for r in best] == ["p", "p", "p"]
