"""Fixed cases, edge rows, and a plain-Python model of the rules run beside the column expressions."""

import json
import random
import re
from datetime import datetime, timezone

from pyspark.sql import functions as F

from broadsheet.config import ValidationConfig
from broadsheet.functions.dates import from_time_parts, parse_published, rfc3339, rfc3339_seconds
from broadsheet.functions.html import sanitize_html
from broadsheet.functions.text import unicode_trim
from broadsheet.functions.urls import clean_link, link_error
from broadsheet.operators.validate import check_texts, read_routed, reason_counts, split_valid, validate, verdict_json, write_routed

NOW = datetime(2024, 6, 1, tzinfo=timezone.utc)
def as_of():
    return F.lit("2024-06-01 00:00:00").cast("timestamp")
GOOD = {
    "title": "Harbour bridge reopens",
    "link": "https://daily.test/city/bridge",
    "description": "Traffic returned on Thursday.",
    "published": "2023-09-14T06:45:10Z",
    "source": "Daily Test",
}
SCHEMA = "title string, link string, description string, published string, source string"


def column(spark, texts, expr):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in df.select("i", expr(F.col("t")).alias("v")).orderBy("i").collect()]


def verdicts(spark, rows, cfg=ValidationConfig()):
    df = spark.createDataFrame([tuple({**GOOD, **r}.values()) for r in rows], SCHEMA).coalesce(1)
    return [r.verdict for r in validate(df, as_of(), cfg).select("verdict").collect()]


# ---- plain-Python model -----------------------------------------------------------

SPACES = "".join(chr(c) for c in [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])


def model_html(text):
    text = re.sub(r"<script[^>]*>.*?</script>", "", text)
    text = re.sub(r"on\w+[" + SPACES + r"]*=", "data-removed=", text)
    text = re.sub(r"<[^>]*>", "", text)
    for entity, char in (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'")):
        text = text.replace(entity, char)
    return text.strip(SPACES)


def model_date(text):
    if not text.strip(SPACES):
        return NOW
    forms = [
        (r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d", "%Y-%m-%d %H:%M:%S"),
        (r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", "%Y-%m-%dT%H:%M:%SZ"),
    ]
    for pattern, form in forms:
        if re.fullmatch(pattern, text, re.ASCII):
            try:
                return datetime.strptime(text, form).replace(tzinfo=timezone.utc)
            except ValueError:
                return None
    if re.fullmatch(r"[A-Za-z]{3}, \d\d [A-Za-z]{3} \d{4} \d\d:\d\d:\d\d [+-]\d{4}", text, re.ASCII):
        try:
            parsed = datetime.strptime(text, "%a, %d %b %Y %H:%M:%S %z")
        except ValueError:
            return None
        return parsed.astimezone(timezone.utc) if parsed.strftime("%a").lower() == text[:3].lower() else None
    if re.fullmatch(r"\d{4}-\d\d-\d\d[Tt ]\d\d:\d\d:\d\d(\.\d{1,6})?([Zz]|[+-]\d\d:\d\d)", text, re.ASCII):
        try:
            return datetime.fromisoformat(text.upper()).astimezone(timezone.utc)
        except ValueError:
            return None
    return None


# ---- cases -------------------------------------------------------------------------


def test_verdicts(spark):
    accepted = [
        {},
        {"published": "Thu, 14 Sep 2023 09:45:10 +0300"},
        {"published": "2023-09-14 06:45:10"},
        {"link": "http://daily.test:8080/city/?page=7&lang=de"},
        {"title": "7"},
        {"title": "t" * 500},
        {"description": "Cars <em>and</em> trams <br/>again"},
        {"description": None},
    ]
    refused = [
        {"published": "a week ago"},
        {"published": "2023-09-31T06:45:10Z"},
        {"published": "1987-03-05T08:00:00Z"},
        {"published": "1999-12-31T23:59:59Z"},
        {"published": "2041-07-20T10:00:00Z"},
        {"link": "bridge, page two"},
        {"link": "gopher://daily.test/1"},
        {"title": " "},
        {"title": "t" * 501},
        {"title": None},
        {"description": "d" * 5001},
        {"source": " \t"},
    ]
    assert all(v.success for v in verdicts(spark, accepted))
    assert not any(v.success for v in verdicts(spark, refused))


def test_cleaned_fields(spark):
    rows = [
        {"link": "http://daily.test:8080/city/?page=7&lang=de"},
        {"description": "<script src=a.js>run(1)</script><div>Cars &amp; trams</div>"},
        {"description": "Cars <em>and</em> trams", "title": "\u00a0Bridge\n"},
    ]
    a, b, c = [v.validated_article for v in verdicts(spark, rows)]
    assert a.link == "http://daily.test:8080/city/"
    assert b.description == "Cars & trams"
    assert (c.description, c.title, c.published) == ("Cars and trams", "Bridge", "2023-09-14T06:45:10+00:00")


def test_wider_limits_allow_future_dates(spark):
    cfg = ValidationConfig(700, 9000, allow_future_dates=True, min_year=1980)
    rows = [{"published": "2041-07-20T10:00:00Z"}, {"published": "1987-03-05T08:00:00Z"}, {"title": "t" * 700}, {"description": "d" * 9000}]
    assert all(v.success for v in verdicts(spark, rows, cfg))


def test_first_error_wins(spark):
    bad = {"title": "", "link": "x", "description": "d" * 6000, "published": "x", "source": ""}
    fixes = [("title", "t"), ("link", GOOD["link"]), ("description", ""), ("published", ""), ("source", "s")]
    rows, now = [dict(bad)], dict(bad)
    for field, value in fixes:
        now = {**now, field: value}
        rows.append(now)
    codes = [v.error_code for v in verdicts(spark, rows)]
    assert codes == ["title_empty", "url_invalid", "description_too_long", "date_invalid", "source_empty", None]


def test_lengths_count_bytes_or_characters(spark):
    rows = [{"title": "ж" * 250}, {"title": "ж" * 251}, {"title": "😀" * 125}, {"title": "😀" * 126}]
    assert [v.success for v in verdicts(spark, rows)] == [True, False, True, False]
    by_chars = ValidationConfig(length_unit="chars")
    assert [v.success for v in verdicts(spark, rows, by_chars)] == [True] * 4


def test_error_texts(spark):
    rows = [
        {"title": "a" * 501},
        {"link": " "},
        {"link": "nope"},
        {"published": "2030-01-01T12:00:00.5+03:00"},
        {"published": "1999-12-31T23:59:59Z"},
        {"published": "01/31/2024"},
        {"source": ""},
    ]
    assert [v.error for v in verdicts(spark, rows)] == [
        "Title is too long (max 500 characters)",
        "Invalid URL: URL is empty",
        "Invalid URL: nope",
        "Date is in the future: 2030-01-01T09:00:00.500+00:00",
        "Date is too old (before 2000): 1999-12-31T23:59:59+00:00",
        "Invalid date format: 01/31/2024",
        "Field validation failed: Source cannot be empty",
    ]


HTML = [
    "<script>alert('xss')</script><p>Hello</p>",
    "<SCRIPT>kept</SCRIPT>",
    "<script>\nspans lines</script>text",
    "confusion = x",
    "&amp;lt;b&amp;gt;",
    "a < b and c > d",
    "<<<<<<",
    "<a onclick = 'x'>y</a>",
    "<img src=x onerror=alert(1)>",
    "ончас=1 onчас=1",
    "\u3000\u00a0 padded \u2028",
    "&quot;&#39;&nbsp;",
    "<script>a</script><script>b",
    "</script><script>",
    "on=1 on =2 one\u00a0=3",
    "tail > only",
    "",
]


def test_sanitize_html(spark):
    assert column(spark, HTML, sanitize_html) == [model_html(t) for t in HTML]


def test_sanitize_html_random(spark):
    rng = random.Random(7)
    parts = ["<script", ">", "</script>", "<", "on", "x", "=", " ", "\n", "&amp;", "&lt;", "gt;", "é", "\u00a0", "$1", "\\"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(1500)]
    assert column(spark, texts, sanitize_html) == [model_html(t) for t in texts]


def test_sanitize_is_linear_on_open_brackets(spark):
    assert column(spark, ["<" * 300_000], lambda c: F.length(sanitize_html(c))) == [300_000]


DATES = [
    "2024-01-01T12:00:00Z", "2024-01-01 12:00:00", "Mon, 01 Jan 2024 12:00:00 +0300", "Tue, 01 Jan 2024 12:00:00 +0300",
    "mon, 01 jan 2024 12:00:00 -0130", "Mon, 01 Jan 2024 12:00:00 GMT", "01/31/2024", "31.01.2024",
    "2024-01-01T12:00:00.5+03:00", "2024-01-01T12:00:00.123456Z", " 2024-01-01T12:00:00Z ", "2024-01-01", "12:00:00",
    "2024-02-30T00:00:00Z", "2024-01-01T25:00:00Z", "2024-01-01T12:00:00", "2024-01-01 12:00:00.5", "", " \u00a0\n",
    "2024-01-01t12:00:00z", "2024-01-01 12:00:00+01:00", "Thu, 29 Feb 2024 23:59:59 +0000", "Wed, 29 Feb 2023 00:00:00 +0000",
    "Foo, 01 Jan 2024 12:00:00 +0000", "Mon, 01 Foo 2024 12:00:00 +0000", "2024-01-01T12:00:00Z\n", "x2024-01-01T12:00:00Z",
]


def test_dates(spark):
    got = column(spark, DATES, lambda c: F.unix_micros(parse_published(c, as_of())))
    want = [model_date(t) for t in DATES]
    assert got == [None if w is None else round(w.timestamp() * 1e6) for w in want]


def test_dates_lenient(spark):
    texts = ["Mon, 01 Jan 2024 12:00:00 GMT", "01/31/2024", "31.01.2024", "31/01/2024", "not a date"]
    got = column(spark, texts, lambda c: rfc3339(parse_published(c, as_of(), "lenient")))
    day = "2024-01-31T00:00:00+00:00"
    assert got == ["2024-01-01T12:00:00+00:00", day, day, None, None]


def test_dates_do_not_depend_on_the_session_zone(spark):
    texts = DATES[:9]
    utc = column(spark, texts, lambda c: F.unix_micros(parse_published(c, as_of())))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert column(spark, texts, lambda c: F.unix_micros(parse_published(c, as_of()))) == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_time_texts(spark):
    ts = spark.sql("select timestamp'2024-01-01 12:00:00.120' as t, array(2024, 1, 2, 3, 4, 5, 0, 1, 0) as p")
    row = ts.select(rfc3339(F.col("t")).alias("a"), rfc3339_seconds(F.col("t")).alias("b"), rfc3339(from_time_parts(F.col("p"))).alias("c")).first()
    assert tuple(row) == ("2024-01-01T12:00:00.120+00:00", "2024-01-01T12:00:00Z", "2024-01-02T03:04:05+00:00")


def test_links(spark):
    cases = [
        ("https://example.com/news", "https://example.com/news"),
        ("https://EXAMPLE.com:443", "https://example.com/"),
        ("http://example.com:443/x", "http://example.com:443/x"),
        ("http://example.com:080/x#f", "http://example.com/x"),
        ("https://a.b/x?q=1#f", "https://a.b/x"),
        ("https://a.b?q=/x", "https://a.b/"),
        ("https://a.b/x/../y/./z/..", "https://a.b/y/"),
        ("https://a.b/../..", "https://a.b/"),
        ("https://a.b/новости", "https://a.b/%D0%BD%D0%BE%D0%B2%D0%BE%D1%81%D1%82%D0%B8"),
        ('https://a.b/"q"', "https://a.b/%22q%22"),
        ("https://u:p@A.b/x", "https://u:p@a.b/x"),
        ("https://a.b\\c", "https://a.b/c"),
        ("https://a.b/%7Ex", "https://a.b/%7Ex"),
        ("https://[::1]:8080/x", "https://[::1]:8080/x"),
        ("https://a.b/news\n", None),
        (" https://a.b/", None),
        ("https://a.b:99999/", None),
        ("https://a.b:x/", None),
        ("https://a<b/", None),
        ("HTTPS://a.b/", None),
        ("https:///x", None),
        ("https://.a", None),
        ("https://a.b/x/%2E%2e/y", "https://a.b/y"),
        ("https://a.b:/x", "https://a.b/x"),
        ("https://a.b:65535/x", "https://a.b:65535/x"),
        ("https://a.b:65536/x", None),
        ("https://u@:80/x", None),
        ("https://a.b/..x/.y", "https://a.b/..x/.y"),
        ("https://a.b/x..", "https://a.b/x.."),
    ]
    got = column(spark, [u for u, _ in cases], lambda c: F.when(link_error(c).isNull(), clean_link(c)))
    assert list(zip([u for u, _ in cases], got)) == cases


def test_unicode_trim(spark):
    texts = [SPACES + "x" + SPACES, SPACES, "a b", "\u200bx\u200b", ""]
    assert column(spark, texts, unicode_trim) == [t.strip(SPACES) for t in texts]


def test_split_keeps_other_columns_and_all_rows(spark):
    df = spark.createDataFrame(
        [(1, *GOOD.values()), (2, *{**GOOD, "title": ""}.values()), (3, *{**GOOD, "published": "x"}.values())],
        f"id int, {SCHEMA}",
    )
    valid, invalid = split_valid(df, as_of())
    assert [(r.id, r.published) for r in valid.collect()] == [(1, "2023-09-14T06:45:10+00:00")]
    assert sorted((r.id, r.error_code) for r in invalid.collect()) == [(2, "title_empty"), (3, "date_invalid")]
    assert {r.outcome: r.n for r in reason_counts(df, as_of()).collect()} == {"valid": 1, "title_empty": 1, "date_invalid": 1}
    everything, nothing = split_valid(df, as_of(), enabled=False)
    assert (everything.count(), nothing.count()) == (3, 0)


def test_verdict_json(spark):
    df = spark.createDataFrame([tuple(GOOD.values()), tuple({**GOOD, "title": ""}.values())], SCHEMA).coalesce(1)
    good, bad = [json.loads(r.j) for r in validate(df, as_of()).select(verdict_json().alias("j")).collect()]
    assert good == {"success": True, "validated_article": {**GOOD, "published": "2023-09-14T06:45:10+00:00"}}
    assert bad == {"success": False, "error": "Title is empty or too short"}


def test_checked_texts_give_the_same_verdicts(spark):
    now = F.lit("2024-06-01 00:00:00").cast("timestamp")
    rows = [(i, t, f"https://x.test/{i}" if i % 5 else "ftp://x", d, p, "s" if i % 4 else " ") for i, (t, d, p) in enumerate(
        (t, d, p) for t in ("A title", "", None, "x" * 501) for d in ("<b>one</b> &amp; two", None, "y" * 5001) for p in ("2024-01-01T00:00:00Z", "soon", None))]
    df = spark.createDataFrame(rows, "id long, title string, link string, description string, published string, source string")
    df = df.withColumns({"error": F.lit("mine"), "valid_title": F.lit("mine"), "success": F.lit("mine")})
    plain, checked = validate(df, now), validate(check_texts(df), now)
    assert plain.columns == [*df.columns, "verdict"] and {r["error"] for r in plain.collect()} == {"mine"}
    said = lambda x: sorted((r["id"], r["verdict"]) for r in x.collect())
    assert said(plain) == said(checked) and len({r["verdict"]["error_code"] for r in plain.collect()}) >= 5


def test_routed_rows_equal_the_split(spark, folder):
    now = F.lit("2024-06-01 00:00:00").cast("timestamp")
    rows = [(i, f" Title {i} ", f"https://x.test/{i}", "<i>d</i>", "2024-01-01T00:00:00Z" if i % 3 else "soon", "s") for i in range(30)]
    df = spark.createDataFrame(rows, "id long, title string, link string, description string, published string, source string")
    want = split_valid(df, now)
    for n, given in enumerate((df, check_texts(df))):
        write_routed(given, f"{folder}/{n}", now)
        got = read_routed(spark, f"{folder}/{n}", given.schema)
        for g, w in zip(got, want, strict=True):
            assert g.columns == w.columns and sorted(g.collect()) == sorted(w.collect())
    assert [r.count() for r in got] == [20, 10]
