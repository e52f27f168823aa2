"""Edge rows from FIXTURES.md for parsing, windows, cleaning, labels, records."""

from pyspark.sql import functions as F

from reviewguard.functions.labels import normalize_label
from reviewguard.functions.text import clean_for_storage, ngrams, tokens
from reviewguard.operators import augment as A
from reviewguard.operators import windows as W
from reviewguard.operators.wire import stream_events


def _wire(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_strict_event_time_and_bad_json(spark):
    vals = [
        '{"review_id":"a","user_id":"u1","product_id":"p1","rating":2,"timestamp":"2024-01-01 10:00:00.123","label":1}',
        '{"review_id":"b","user_id":"u1","product_id":"p1","rating":3,"timestamp":"2024-01-01 10:00:00"}',
        '{"review_id":"c","user_id":"u1","product_id":"p1","rating":3,"timestamp":"2024-01-01 10:00:00.123456"}',
        '{"review_id":"d","user_id":"u1","product_id":"p1","rating":3,"timestamp":"2024-01-01"}',
        'not json at all',
        '{"review_id":"e","user_id":"u1","product_id":"p1","rating":"x","timestamp":"2024-01-01 11:00:00.000","label":"1"}',
    ]
    from reviewguard.operators.wire import reject_counts
    c = reject_counts(_wire(spark, vals)).first()
    assert (c.received, c.accepted, c.malformed, c.bad_time) == (6, 2, 1, 3)
    rows = {r.review_id: r for r in stream_events(_wire(spark, vals)).collect()}
    assert set(rows) == {"a", "e"}          # only exactly three fraction digits survive
    assert rows["a"].label == "1" and rows["e"].label == "1"
    assert rows["e"].rating is None          # rating as text -> null, never an error
    assert len(rows["a"].anonymous_user_id) == 12


def test_window_edges_and_null_rating(spark):
    schema = ("review_id string, user_id string, product_id string, rating double, source string, "
              "event_time string, anonymous_user_id string")
    rows = [
        ("1", "u", "p1", 3.0, "amazon", "2024-01-01 10:59:59.999", "x"),
        ("2", "u", "p2", 2.0, "amazon", "2024-01-01 10:10:00", "x"),
        ("3", "u", "p3", 1.0, "synthetic_spam", "2024-01-01 10:20:00", "x"),
        ("4", "u", "p1", None, "amazon", "2024-01-01 10:30:00", "x"),    # null rating is never low
        ("5", "u", "p1", 3.5, "amazon", "2024-01-01 10:40:00", "x"),     # above the cut
        ("6", "u", "p1", 1.0, "amazon", "2024-01-01 11:00:00", "x"),     # boundary: next window
        ("7", "v", "p9", 2.0, "amazon", "2024-01-01 10:00:00", "x"),
    ]
    df = spark.createDataFrame(rows, schema).withColumn("event_time", F.to_timestamp_ntz("event_time"))
    out = {(r.user_id, str(r.window_start)): r for r in W.user_windows(df, W.V2).collect()}
    a = out[("u", "2024-01-01 10:00:00")]
    assert (a.low_rating_reviews_by_user_5m, a.distinct_products, a.source_spam_label) == (3, 3, 1)
    assert (a.burst_detected, a.suspicious_user_flag) == (1, 1)
    b = out[("u", "2024-01-01 11:00:00")]
    assert (b.low_rating_reviews_by_user_5m, b.burst_detected, b.suspicious_user_flag) == (1, 0, 0)
    v1 = {(r.user_id, str(r.window_start)): r for r in W.user_windows(df, W.V1).collect()}
    assert v1[("u", "2024-01-01 10:00:00")].low_rating_reviews_by_user_5m == 2   # rating <= 2 only
    assert "source_spam_label" not in W.user_windows(df, W.V1).columns


def test_clean_for_storage_and_ngrams(spark):
    df = spark.createDataFrame([("Great&amp;cheap <br/>item &lt;b&gt;bold&lt;/b&gt; 5*",), ("<p></p>  !!",),
                                (None,), ("&amp;lt;",)], "t string")
    got = [r[0] for r in df.select(clean_for_storage("t")).collect()]
    assert got == ["great cheap item bold 5", None, None, "lt"]
    ent = spark.createDataFrame([("caf&eacute; &#65;&#x42; &amp;lt;i&amp;gt;",)], "t string")
    assert ent.select(clean_for_storage("t")).first()[0] == "caf ab lt i gt"
    t = spark.createDataFrame([("a b c d",), ("a b",)], "s string").select(ngrams(tokens("s"), 3).alias("g"))
    assert [r.g for r in t.collect()] == [["a b c", "b c d"], []]


def test_entities_equal_full_decoding(spark):
    """Every name with and without its semicolon, numbers of all kinds, and random mixtures equal the standard library's decoding."""
    import html
    import random
    from html.entities import html5

    from reviewguard.functions.entities import decode_entities

    r = random.Random(3)
    texts = [f"a&{n}b &{n}" for n in html5] + [f"&{n.rstrip(';')}x" for n in html5]
    texts += [f"&#{n}; &#x{n:X} &#0{n}x" for n in [*range(0, 300), 0x2028, 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDD0, 0xFDEF, 0xFDF0, 0xFFFD, 0xFFFE, 0xFFFF, 0x10000, 0x1F600, 0x1FFFE, 0x10FFFD, 0x10FFFF, 0x110000, 9999999, 99999999, 10 ** 20]]
    texts += ["", "&", "&&", "&;", "&#;", "&#x;", "&#xg", "&amp;lt;", "&notit; &notin; &notinx;", "caf&eacute; &#65;&#x42;c &mdash; ok", "&" + "x" * 40 + ";", "&AMP;&Amp;", "&#x00000000041;", "&lt", "&ltx&gt"]
    bits = ["&", "amp", ";", "#", "x", "41", "lt", " ", "eacute", "not", "\n", "é", "😀", "0", "notin"]
    texts += ["".join(r.choices(bits, k=r.randrange(1, 9))) for _ in range(2000)]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    got = df.select("t", decode_entities(F.col("t")).alias("d")).collect()
    bad = [(x.t, x.d, html.unescape(x.t)) for x in got if x.t is not None and x.d != html.unescape(x.t)]
    assert not bad, bad[:10]
    assert [x.d for x in got if x.t is None] == [None]


def test_pages_are_fully_decoded(spark):
    """250 of 250 pages, and none of them by the SQL twin alone: the cleaner spelled out in Python."""
    import html
    import re

    from conftest import SF
    from reviewguard.plans.catalog import QUERIES

    def clean(t):
        t = re.sub(r"<.*?>", " ", html.unescape(t)).lower()
        return re.sub(r"\s+", " ", re.sub(r"[^a-z0-9\s]", " ", t)).strip() or None
    want = {x.page_id: clean(x.html) for x in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert {x.page_id: x.clean_text for x in QUERIES["clean_text_pages"](spark, SF).collect()} == want and len(want) == 250


def test_label_words_and_numbers(spark):
    df = spark.createDataFrame([(" Deceptive",), ("pos",), ("NEG ",), ("1",), ("0.0",), ("maybe",), (None,)],
                               "label string")
    assert [r[0] for r in df.select(normalize_label(df)).collect()] == [1.0, 0.0, 1.0, 1.0, 0.0, None, None]
    alt = spark.createDataFrame([("Yes",), ("false",), ("truthful",), ("2",)], "is_fake string")
    assert [r[0] for r in alt.select(normalize_label(alt)).collect()] == [1.0, 0.0, 0.0, 2.0]


def test_valid_records_and_injection(spark):
    cols = "review_id string, user_id string, product_id string, rating double, review_text string, " \
           "timestamp string, label double, source string"
    rows = [("r1", "u1", "p1", 1.0, "t", "ts", None, "amazon"), ("r2", " ", "p1", 1.0, "t", "ts", None, "amazon"),
            ("r3", "u3", None, 1.0, "t", "ts", None, "amazon"), ("r4", "u4", "p4", 1.0, "\t", "ts", None, "amazon")]
    df = spark.createDataFrame(rows, cols)
    assert [r.review_id for r in A.valid_records(df).collect()] == ["r1"]
    many = spark.range(20000).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("review_id"),
                                     F.lit("u").alias("user_id"), F.lit("p").alias("product_id"),
                                     F.lit(5.0).alias("rating"), F.lit("t").alias("review_text"),
                                     F.lit("2024-01-01 00:00:00.000").alias("timestamp"),
                                     F.lit(1.0).alias("label"), F.lit("amazon").alias("source"))
    inj = A.inject_spam(many, 0.12)
    share = inj.agg(F.avg((F.col("source") == "synthetic_spam").cast("double"))).first()[0]
    assert abs(share - 0.12) < 0.01
    again = {r.review_id: r.user_id for r in A.inject_spam(many, 0.12).collect()}
    assert again == {r.review_id: r.user_id for r in inj.collect()}     # deterministic on replay
    spam = inj.filter("source = 'synthetic_spam'").collect()
    assert all(r.label == 1.0 and r.rating in (1.0, 2.0, 3.0) for r in spam)
    assert all(r.timestamp[:13] in A.SUSPICIOUS_HOURS and len(r.timestamp) == 23 for r in spam)


def test_observed_counters_equal_the_aggregate(spark):
    from pyspark.sql import Observation
    rows = A.inject_spam(spark.range(3000).select(F.col("id").cast("string").alias("review_id"), F.lit("amazon").alias("source")), 0.2)
    seen = Observation("counters")
    assert A.observe_counts(rows, seen).filter("review_id < '5'").count() < 3000
    assert seen.get == A.counts(rows).first().asDict() and seen.get["sent"] == 3000 and 400 < seen.get["injected_rows"] < 800


def test_lenient_time_option(spark):
    vals = ['{"review_id":"b","user_id":"u1","product_id":"p1","rating":3,"timestamp":"2024-01-01 10:00:00"}',
            '{"review_id":"d","user_id":"u1","product_id":"p1","rating":3,"timestamp":"2024-01-01"}']
    assert stream_events(_wire(spark, vals)).count() == 0
    assert stream_events(_wire(spark, vals), lenient=True).count() == 2


def test_bloom_state_prior_only(spark):
    import uuid

    from reviewguard.session import scratch_path
    from reviewguard.streaming import bloom_state
    from reviewguard.streaming.batches import read_batch

    root = scratch_path(spark, f"bloom-{uuid.uuid4().hex}")
    b0 = spark.createDataFrame([("alice",)], "user_id string")
    b1 = spark.createDataFrame([("bob",)], "user_id string")
    bloom_state.update(b0, root, 0)
    bloom_state.update(b1, root, 1)
    bloom_state.update(b1, root, 1)  # replay
    from reviewguard.operators import bloom as B
    probe = spark.createDataFrame([("alice",), ("bob",)], "user_id string")
    with_own = {r.user_id: r.bloom_seen_before for r in B.might_contain(probe, read_batch(spark, root, 1)).collect()}
    prior = {r.user_id: r.bloom_seen_before for r in B.might_contain(probe, bloom_state.before(spark, root, 1)).collect()}
    assert with_own == {"alice": 1, "bob": 1}
    assert prior["alice"] == 1 and prior["bob"] == 0
