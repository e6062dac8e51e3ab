import hashlib
import json

from pyspark.sql import functions as F

from reviewlens import config as cfg
from reviewlens.functions import coerce as co
from reviewlens.operators import conform
from reviewlens.sources import raw, tables


def test_layouts_only_name_unified_fields():
    for lay in cfg.LAYOUTS.values():
        assert set(lay.fields) <= set(cfg.MAPPED_FIELDS)
        assert len(set(lay.bonus_keys)) == len(lay.bonus)


def test_paths(one):
    item = F.try_parse_json("j")
    row = ('{"date": {"published": "2024-01"}, "answers": ["likes", "dislikes"], "n": null}',)
    got = one("j string", row, *[co.get_path(item, p) for p in ("date.published", "answers.0", "answers.7", "missing.key", "n", "date.published.x")])
    assert got == ["2024-01", "likes", None, None, None, None]


def test_coercion(one):
    f, i = co.to_float(F.col("t")), co.to_int(F.col("t"))
    cases = {"4.5/5": (4.55, 455), "-1": (1.0, 1), "1.2.3": (None, 123), "4.0": (4.0, 40), "n/a": (None, None), "": (None, None)}
    for text, want in cases.items():
        assert tuple(one("t string", (text,), f, i)) == want
    for text, want in {"Verified": True, "YES": True, "1": True, "no": False, None: None}.items():
        assert one("t string", (text,), co.to_bool(F.col("t"))) == [want]


def test_dates_one_by_one(one):
    cases = {
        "2024-01-01T22:00:00.123-05:00": "2024-01-02", "2024-01-01T10:00:00Z": "2024-01-01", "2024-01-01": "2024-01-01",
        "junk": None, None: None,
    }
    for text, want in cases.items():
        assert one("t string", (text,), co.to_utc_date(F.col("t")).cast("string")) == [want]


RAW_A = {
    "id": "", "answers": ["Liked it", "Hated it"], "score": 5, "name": "Ann B.", "role": "User", "segment": "small-business",
    "location": {"country": "Poland", "primary": "EMEA", "region": "Europe"}, "date": {"published": "2022-08-18T09:05:00.496-05:00"},
    "switched_from": {"products": [{"id": "1", "name": "Old One"}, {"id": "2"}, {"name": "Old Two"}], "reason": ""},
    "helpful": 0, "source": {"type": "g2gives"}, "title": "T", "product_id": 7,
}


def unified(spark, *items):
    rows = [(a, "xero", "2024-06-01T00:00:00+00:00", json.dumps(j)) for a, j in items]
    text = spark.createDataFrame(rows, "source_actor string, product_key string, scraped_at string, item_json string")
    good = conform.accepted(conform.with_reject_reason(text)).drop("item_json")
    return conform.unify(good, conform.products(spark))


def test_unify(spark):
    row = unified(spark, ("jupri", RAW_A)).first()
    seed = "XRO-ACC-001|Ann B.|2022-08-18T09:05:00.496-05:00|Liked it|Hated it"
    assert row.review_id == "hash-" + hashlib.sha256(seed.encode()).hexdigest()[:16]
    assert (row.product_id, row.product_name, row.source_platform) == ("XRO-ACC-001", "Xero", "g2")
    assert (row.likes, row.dislikes, row.recommendations, row.use_case) == ("Liked it", "Hated it", None, None)
    assert row.overall_rating == 5.0 and row.extraction_confidence == 1.0
    bonus = json.loads(row.bonus_data)
    assert list(bonus) == ["title", "helpful", "type", "switched_from", "product_id", "region", "primary"]
    assert set(cfg.UNIFIED_FIELDS) <= set(row.asDict())


def test_null_fields_hash_as_none(spark):
    row = unified(spark, ("jupri", {"name": "X"})).first()
    seed = "XRO-ACC-001|X|None|None|None"
    assert row.review_id == "hash-" + hashlib.sha256(seed.encode()).hexdigest()[:16]
    assert row.extraction_confidence == 0.0 and row.bonus_data == "{}"


def test_platform_per_record(spark):
    items = [("focused_vanguard", {"id": str(n), "sourcePlatform": p}) for n, p in enumerate(["G2", "Capterra", "TrustPilot", None])]
    got = {r.review_id: r.source_platform for r in unified(spark, *items).collect()}
    assert got == {"0": "g2", "1": "capterra", "2": "trustpilot", "3": "multi"}


def test_bonus_columns(spark):
    cases = [
        (json.dumps({"type": "g2_incentivized", "switched_from": [{"name": "A"}, {"x": 1}]}), (True, "A", None)),
        (json.dumps({"switched_from": {"products": [], "reason": "why"}}), (False, None, "why")),
        ("[1, 2]", (False, None, None)),
        ("{broken", (False, None, None)),
        (None, (False, None, None)),
    ]
    df = spark.createDataFrame([(str(n), c[0]) for n, c in enumerate(cases)], "review_id string, bonus_data string")
    rows = {r.review_id: r for r in conform.flatten_bonus(df).collect()}
    for n, (_, want) in enumerate(cases):
        r = rows[str(n)]
        assert (r.is_incentivized, r.switched_from_product, r.switched_from_reason) == want


def test_meta_keeps_first_copy_in_order(spark):
    rows = [("a", "late", 2), ("a", "first", 1), ("b", "only", 3)]
    df = spark.createDataFrame(rows, "review_id string, reviewer_name string, seq int")
    got = conform.build_meta(df, "seq")
    assert got.columns == ["review_id", "reviewer_name"]
    assert sorted(map(tuple, got.collect())) == [("a", "first"), ("b", "only")]


def test_quarantine(spark):
    rows = [("jupri", "{"), ("jupri", "[1]"), ("other", "{}"), ("jupri", "{}")]
    checked = conform.with_reject_reason(spark.createDataFrame(rows, "source_actor string, item_json string"))
    assert [r.reject_reason for r in checked.collect()] == ["bad_json", "not_object", "unknown_source", None]


def test_raw_files(spark, tmp_path):
    folder = tmp_path / "jupri"
    folder.mkdir()
    write = lambda name, value: (folder / name).write_text(value, encoding="utf-8")
    write("xero_20240101_000000.json", json.dumps([{"id": "old"}], indent=2))
    write("xero_20240201_000000.json", json.dumps([{"id": "1", "location": "text"}, {"id": "2", "location": {"country": "PL"}}], indent=2))
    write("certinia_20240101_000000.json", "\n  " + json.dumps({"id": "object, not an array"}))
    write("acumatica_20240101_000000.json", '[{"id": "cut')
    good, rejected = raw.read_raw(spark, str(tmp_path))
    ids = sorted(r[0] for r in good.select(F.try_variant_get("item", "$.id", "string")).collect())
    assert ids == ["1", "2", "old"]
    reasons = {r.file_path.rsplit("/", 1)[-1].split("_")[0]: r.reject_reason for r in rejected.collect()}
    assert reasons == {"certinia": "not_array", "acumatica": "bad_json"}
    newest = raw.read_latest(spark, str(tmp_path))
    assert sorted(r[0] for r in newest.select(F.try_variant_get("item", "$.id", "string")).collect()) == ["1", "2"]
    assert newest.count() == 2 and good.count() == 3
    files = raw.inventory(spark, str(tmp_path), product="xero").collect()
    assert {(f.source_actor, f.product_key, f.run_ts) for f in files} == {
        ("jupri", "xero", "20240101_000000"), ("jupri", "xero", "20240201_000000"),
    }


def test_union_csv(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.csv").write_text('id,text\n1,"two\nlines, and ""quotes"""\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text("id,extra\n2,x\n3,\n", encoding="utf-8")
    (tmp_path / "out.csv").write_text("id,own\n9,skip\n", encoding="utf-8")
    (tmp_path / "none.csv").write_text("", encoding="utf-8")
    (tmp_path / "empty.csv").write_text("\n\n", encoding="utf-8")
    (tmp_path / "c.csv").write_text('"x, y",id,id\n5,6,7\n', encoding="utf-8")
    df = tables.union_csv(spark, str(tmp_path), skip="out.csv")
    assert df.columns == ["id", "text", "extra", "x, y", "id_2"]
    assert sorted(map(tuple, df.collect())) == [
        ("1", 'two\nlines, and "quotes"', "", "", ""), ("2", "", "x", "", ""), ("3", "", "", "", ""), ("6", "", "", "5", "7"),
    ]
    assert [r.file_path.rsplit("/", 1)[-1] for r in tables.csv_without_header(spark, str(tmp_path), skip="out.csv").collect()] == ["empty.csv"]
