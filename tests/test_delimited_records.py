"""Delimited files of several headers in one read."""

import csv
import io
import random

import eventflow as ef

HEADERS = [["id", "a", "b"], ["b", "id"], ["id", "x y", "a"], ["a", "id", "b", "c"], ["id"]]


def line(values, delimiter=","):
    out = io.StringIO()
    csv.writer(out, delimiter=delimiter, lineterminator="").writerow(values)
    return out.getvalue()


def test_files_of_five_headers(spark, tmp_path):
    rng, want = random.Random(1), {}
    for f in range(200):
        names = HEADERS[f % 5]
        rows = []
        for i in range(rng.randrange(6)):
            row = {n: rng.choice(["v", 'say "hi"', "a,b", " x ", "é"]) for n in names} | {"id": f"{f}-{i}"}
            want[row["id"]] = row
            rows.append(line([row[n] for n in names]))
        (tmp_path / f"f{f}.csv").write_text("\n".join([*([""] if f > 99 else []), line(names), *rows, "  "]) + "\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "bom.csv").write_text("﻿id,a\nbom,1\n")
    out = ef.read_delimited_records(spark, str(tmp_path))
    rows = {r.fields["id"]: r.fields for r in out.collect()}
    assert rows.pop("bom") == {"id": "bom", "a": "1"} and rows == want
    columns = ef.read_delimited_records(spark, str(tmp_path), columns=["id", "c"])
    each = ef.read_delimited(spark, [str(tmp_path / f"f{f}.csv") for f in range(10)]).select("id", "c")
    few = sorted((r.id, r.c or "") for r in columns.collect() if r.id.split("-")[0] in map(str, range(10)))
    assert few == sorted((r.id, r.c or "") for r in each.collect())


def test_bad_lines_and_empty_values(spark, tmp_path):
    (tmp_path / "f.tsv").write_text('a\tb\n1\t2\n3\n4\t5\t6\n\t""\n"open\t7\n')
    rows = [(r.fields["a"], r.fields["b"], r._raw, bool(r._error)) for r in ef.read_delimited_records(spark, str(tmp_path), "\t").collect()]
    assert rows == [("1", "2", None, False), ("3", None, "3", True), ("4", "5", "4\t5\t6", True), (None, "", None, False), ("open\t7", None, '"open\t7', True)]


def test_large_files_in_pieces(spark, tmp_path):
    for f, names in enumerate(HEADERS[:2]):
        (tmp_path / f"{f}.csv").write_text("\n".join([line(names), *[line([f"{n}{i}" for n in names]) for i in range(5000)]]))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        out = ef.read_delimited_records(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 2
        rows = out.collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    got = sorted((r._file[-5], r.fields["id"], r.fields["b"], r._error or "") for r in rows)
    assert got == sorted((str(f), f"id{i}", f"b{i}", "") for f in (0, 1) for i in range(5000))
