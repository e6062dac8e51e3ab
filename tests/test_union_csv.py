"""Union of CSV files: headers as records, one scan for all layouts."""

import csv
import random

import pytest

from reviewlens.sources import tables


def plain_union(paths):
    """The rule, file by file: columns in first-seen order over sorted paths, missing cells empty."""
    order, parts = [], []
    for path in sorted(paths):
        with open(path, encoding="utf-8-sig", newline="") as f:
            records = [r for r in csv.reader(f) if r]
        if not records:
            continue
        names = tables.header_names(",".join('"' + c.replace('"', '""') + '"' for c in records[0]))
        order += [n for n in names if n not in order]
        parts += [dict(zip(names, r)) for r in records[1:]]
    return order, sorted(tuple(p.get(n, "") for n in order) for p in parts)


def same(spark, base):
    df = tables.union_csv(spark, str(base))
    columns, rows = plain_union([str(p) for p in base.rglob("*.csv")])
    assert df.columns == columns
    assert sorted(map(tuple, df.collect())) == rows


def test_headers_over_lines(spark, tmp_path):
    files = {
        "a.csv": '"one\nname",id,"x, ""y"""\n5,6,7\n8,"two\nlines",\n',
        "b.csv": '\r\n\r\nid,"one\nname"\r\n1,2\r\n3,4\r\n',
        "c.csv": '"x, ""y"""\n"only, one"\n',
        "d.csv": "x,y\n1,2\n",  # two names, unlike the one quoted name of e
        "e.csv": '"x,y"\n3\n',
        "f.csv": "ID,id,id\n1,2,3\n",  # case matters, repeats get a number
        "g.csv": "﻿id\n9\n",
        "h.csv": "id,extra\n",  # no rows, but a column
        "i.csv": "id\n1,cut\n",
        "j.csv": "id,z\n1\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text, encoding="utf-8", newline="")
    same(spark, tmp_path)
    assert tables.csv_without_header(spark, str(tmp_path)).collect() == []


def test_names_that_spark_uses_itself(spark, tmp_path):
    (tmp_path / "a.csv").write_text("file_path,layout,cells,places\n1,2,3,4\n")
    (tmp_path / "b.csv").write_text("c0,a.b,`t`,_metadata,record,\n1,2,3,4,5,6\n")
    same(spark, tmp_path)


def test_many_layouts_in_one_plan(spark, tmp_path):
    rng = random.Random(7)
    names = [f"n{k}" for k in range(60)]
    for k in range(300):
        own = rng.sample(names, rng.randint(1, 8))
        lines = [own] + [[f"{k}-{r}-{c}" for c in own] for r in range(rng.randint(1, 3))]
        (tmp_path / f"{k % 7}").mkdir(exist_ok=True)
        (tmp_path / f"{k % 7}" / f"{k}.csv").write_text("".join(",".join(line) + "\n" for line in lines))
    same(spark, tmp_path)
    plan = tables.union_csv(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Union" not in plan  # one scan, however many layouts


def test_a_large_layout_table_is_joined(spark, tmp_path, monkeypatch):
    from reviewlens.operators import lookup

    monkeypatch.setattr(lookup, "KNOWN_BYTES", 0)
    monkeypatch.setattr(lookup, "MAX_BYTES", 1)
    for k in range(12):
        (tmp_path / f"{k}.csv").write_text(f"id,own{k % 5}\n{k},x\n{k},\n")
    same(spark, tmp_path)


def test_a_header_that_never_ends(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,"' + "long " * 40_000)
    (tmp_path / "b.csv").write_text("id\n1\n")
    (tmp_path / "c.csv").write_text("  \n1\n")
    df = tables.union_csv(spark, str(tmp_path))
    assert df.columns == ["id"] and [r.id for r in df.collect()] == ["1"]
    left = [r.file_path.rsplit("/", 1)[-1] for r in tables.csv_without_header(spark, str(tmp_path)).collect()]
    assert sorted(left) == ["a.csv", "c.csv"]


def test_no_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n")
    with pytest.raises(FileNotFoundError):
        tables.union_csv(spark, str(tmp_path))
