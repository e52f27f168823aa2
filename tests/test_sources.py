import gzip
import json
import os
import tempfile

from pyspark.sql import functions as F

from reviewguard.operators import ingest as I
from reviewguard.sources import readers as Rd
from reviewguard.sources import sinks as Sk


def test_read_reviews_jsonl_gzip_and_standardize(spark):
    d = tempfile.mkdtemp(prefix="rg-src-")
    rows = [
        {"user_id": "A1", "parent_asin": "P1", "rating": 5, "title": "Great", "text": "Nice <br/>item &amp; more",
         "timestamp": 1588687728923},
        {"user_id": "A2", "parent_asin": "P2", "rating": "x", "title": " ", "text": "Bad!!", "timestamp": 1588687728000},
        {"user_id": "A3", "parent_asin": "P3", "rating": 1, "title": "", "text": "  ", "timestamp": None},
        {"user_id": "A4", "parent_asin": "P1", "rating": 2, "title": "great", "text": "nice item more",
         "timestamp": 1588687729001},
    ]
    p = os.path.join(d, "reviews.jsonl.gz")
    with gzip.open(p, "wt") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")
    raw = Rd.read_reviews(spark, p)
    raw = Rd.present_columns(raw, [c for c in raw.columns if not c.startswith("_")])
    assert "reviewerID" not in raw.columns and "user_id" in raw.columns
    std = I.standardize_marketplace(raw, ["_file", "_row"]).orderBy("review_id").collect()
    # row 3 has no text; row 4 duplicates row 1's cleaned text -> first kept
    assert [r.review_id for r in std] == ["amz_0", "amz_1"]
    assert std[0].review_text == "great nice item more"
    assert std[1].rating is None and std[1].review_text == "bad"
    # milliseconds detected from the column max, 3 fraction digits printed
    assert std[0].timestamp == "2020-05-05 14:08:48.923"
    assert std[1].timestamp == "2020-05-05 14:08:48.000"


def test_read_reviews_csv_binds_columns_by_header(spark):
    d = tempfile.mkdtemp(prefix="rg-csv-")
    p = os.path.join(d, "reviews.csv")
    with open(p, "w") as f:
        f.write("extra,asin,reviewerID,overall,reviewText,unixReviewTime\n"
                'x,B01,U1,4,"good\nthing, said ""he""",1588687728\n'
                "y,B02,U2,nan,,1588687729\n"
                "z,B03,U3,1e400,plain,1e30\n")
    raw = Rd.read_reviews(spark, p)
    assert "extra" not in raw.columns
    raw = Rd.present_columns(raw, [c for c in raw.columns if not c.startswith("_")])
    rows = {r.reviewerID: r for r in raw.collect()}
    assert len(rows) == 3 and rows["U1"].asin == "B01" and rows["U1"].reviewText == 'good\nthing, said "he"'
    std = I.standardize_marketplace(raw, ["_file", "_row"]).orderBy("review_id").collect()
    assert [(r.user_id, r.product_id, r.rating, r.review_text) for r in std] == [
        ("U1", "B01", 4.0, "good thing said he"), ("U3", "B03", None, "plain")]


def test_labelled_text_tree(spark):
    root = tempfile.mkdtemp(prefix="rg-tree-")
    for sub, name, text in [("deceptive_from_x/fold1", "a.txt", "Fake stay"), ("truthful_y", "b.txt", "Real stay"),
                            ("other", "c.txt", "skip me"), ("deceptive_z", "d.md", "not txt")]:
        os.makedirs(os.path.join(root, sub), exist_ok=True)
        with open(os.path.join(root, sub, name), "wb") as f:
            f.write(text.encode() + b"\xff\n")
    df = Rd.read_labelled_text_tree(spark, root)
    got = sorted((r.label, r.text[:9]) for r in df.collect())
    assert got == [(0, "Real stay"), (1, "Fake stay")]


def test_first_available_and_feature_batches(spark):
    d = tempfile.mkdtemp(prefix="rg-fb-")
    assert Rd.first_available(spark, [os.path.join(d, "missing"), d]) == d
    df = spark.createDataFrame([("u1", ["p2", "p1"])], "user_id string, product_ids array<string>")
    Sk.write_feature_batch(df, 0, d)
    Sk.write_feature_batch(df.withColumn("user_id", F.lit("u2")), 1, d)
    Sk.write_feature_batch(df.withColumn("user_id", F.lit("u2")), 1, d)  # replay
    back = Rd.read_feature_batches(spark, d).orderBy("batch_id").collect()
    assert [(r.user_id, r.product_ids_str, r.batch_id) for r in back] == [("u1", "p1,p2", 0), ("u2", "p1,p2", 1)]


def test_wire_sink_roundtrip(spark):
    from reviewguard.operators.wire import stream_events
    d = tempfile.mkdtemp(prefix="rg-wire-")
    df = spark.createDataFrame(
        [("r1", "u1", "p1", 2.0, "t", "2024-01-01 10:00:00.123", 1.0, "amazon"),
         ("r2", "u2", "p1", None, "t", "2024-01-01 10:00:00", None, "amazon")],
        "review_id string, user_id string, product_id string, rating double, review_text string, "
        "timestamp string, label double, source string")
    Sk.to_wire(df, "text", os.path.join(d, "out"))
    back = spark.read.text(os.path.join(d, "out"))
    ev = stream_events(back).collect()
    # the second row has no fraction digits: strict parse drops it
    assert [(r.review_id, r.label) for r in ev] == [("r1", "1")]


def test_hash_ids_keep_the_same_rows(spark):
    from conftest import SF
    from reviewguard.sources import raw as R
    a = I.standardize_marketplace(R.raw_marketplace_docs(spark, SF), ["_ord"])
    b = I.standardize_marketplace(R.raw_marketplace_docs(spark, SF), ["_ord"], id_mode="hash")
    cols = ["user_id", "product_id", "rating", "review_text", "timestamp"]
    assert sorted(a.select(*cols).collect(), key=repr) == sorted(b.select(*cols).collect(), key=repr)
    assert b.select("review_id").distinct().count() == b.count()
