"""Array files read by byte ranges against the same files read whole."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reviewlens.sources import raw

ITEMS = [
    {"id": 1, "t": 'brace } and quote " and \\ back'}, {"id": 2, "n": {"a": [{"b": "]"}, {}], "c": {}}}, {}, {"id": 3, "t": "{[\\\"}]\n ünï }}"},
    {"t": "}" * 50}, {"id": 4, "t": "\\"}, {"a": [[], [{}], ["}"]]},
]

FILES = {
    "plain": json.dumps(ITEMS), "pretty": json.dumps(ITEMS, indent=2), "raw": json.dumps(ITEMS * 40, ensure_ascii=False), "none": "[]", "blank": " [ \n ] ",
    "bom": "﻿" + json.dumps(ITEMS[:2]), "scalars": '[1, "}", {"a": 1}, null, [2, {"b": "]"}], {"c": 3}, "x", [4]]', "numbers": "[1, 2]",
    "cut": '[{"id": 1}, {"id": "cut', "cut2": '[{"id": 1}, {"id": 2}', "object": '{"id": 1}', "comma": '[{"a": 1},]', "commas": '[{"a": 1},, {"b": 1}]',
    "missing": '[{"a": 1} {"b": 1}]', "wrong": '[{"a": [1}, {"b": 2}]]', "word": "hello", "open": '[{"a": "x}, {"b": 1}]',
}


def land(folder, files):
    for name, text in files.items():
        (folder / f"src={name}").mkdir(parents=True, exist_ok=True)
        (folder / f"src={name}" / f"{name}_20240101_000000.json").write_text(text, encoding="utf-8")


def seen(spark, path, split_above):
    rows = raw.read_files(spark, str(path), split_above=split_above).selectExpr("file_path", "transform(items, i -> to_json(i)) AS items", "reject_reason").collect()
    out = {}
    for r in rows:
        items, reasons = out.setdefault(r.file_path.rsplit("/", 1)[-1].split("_2024")[0], ([], set()))
        items += r["items"] or []
        reasons |= {r.reject_reason} - {None}
    return {k: (sorted(i), sorted(x)) for k, (i, x) in out.items()}


@pytest.mark.parametrize("size", [7, 64, 1 << 20])
def test_same_items_as_whole_files(spark, tmp_path, size):
    land(tmp_path, FILES)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    whole = seen(spark, tmp_path, 1 << 40)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        ranges = seen(spark, tmp_path, -1)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert ranges == whole
    assert len(whole["raw"][0]) == 40 * len(ITEMS) and whole["cut"] == ([], ["bad_json"]) and whole["object"] == ([], ["not_array"])


value = st.recursive(
    st.none() | st.booleans() | st.integers(-9, 9) | st.text(alphabet='a}{][",\\\n', max_size=6),
    lambda v: st.lists(v, max_size=3) | st.dictionaries(st.text(alphabet='k}"\\', max_size=3), v, max_size=3), max_leaves=6,
)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.lists(value, max_size=6), min_size=8, max_size=8))
def test_any_array(spark, tmp_path_factory, arrays):
    folder = tmp_path_factory.mktemp("arrays")
    land(folder, {f"f{n}": json.dumps(a, ensure_ascii=n % 2 == 0, indent=n % 3 or None) for n, a in enumerate(arrays)})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "11")
    try:
        ranges = seen(spark, folder, -1)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert ranges == seen(spark, folder, 1 << 40)


def test_a_large_file_is_many_tasks(spark, tmp_path):
    land(tmp_path, {"big": json.dumps([{"id": n, "t": "x}" * (n % 50)} for n in range(5000)])})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(32 << 10))
    try:
        from reviewlens.sources import json_ranges

        assert json_ranges.pieces(spark, str(tmp_path), 1000).rdd.getNumPartitions() > 5
        assert raw.read_raw(spark, str(tmp_path), split_above=1000)[0].selectExpr("count(DISTINCT variant_get(item, '$.id', 'int'))").first()[0] == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_pieces_are_not_written_before_they_are_joined(spark, tmp_path):
    """Only the chunks reach the scratch folder; the pieces used to be written, too."""
    from reviewlens.session import scratch_paths

    land(tmp_path, {"raw": FILES["raw"]})
    before = set(scratch_paths(spark))
    assert raw.read_files(spark, str(tmp_path), split_above=10).count() > 1
    with_pieces = [p for p in scratch_paths(spark) if p not in before]
    assert [p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in with_pieces] == ["json-chunks"]
    planned = raw.json_ranges.chunks(raw.json_ranges.located(raw.json_ranges.pieces(spark, str(tmp_path), 10)))
    assert planned.count() == spark.read.parquet(with_pieces[0]).count()
