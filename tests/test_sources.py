"""Files in and out."""

import csv
import datetime as dt
import io
import math
import os

import pytest
from pyspark.sql import functions as F

from longitab.plans import instruments as IN
from longitab.sources import bundle, delimited, files


def write(path, text, newline=""):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline=newline) as f:
        f.write(text)
    return str(path)


def test_export_scan(spark, tmp_path):
    text = '﻿id,note,day,score\r\n1,"a ""b"", c",2024-01-31,1.5\r\n2,,,\r\n3,"",NA,bad\r\n4,NA,2024-02-30,7\r\n'
    path = write(tmp_path / "export.csv", text)
    df = delimited.read_export(spark, path, "id INT, note STRING, day DATE, score DOUBLE")
    got = [tuple(r) for r in df.orderBy("seq").collect()]
    day = dt.date(2024, 1, 31)
    assert [g[:4] for g in got] == [(1, 'a "b", c', day, 1.5), (2, None, None, None), (3, None, None, None), (4, "NA", None, 7.0)]
    assert sorted(g[4] for g in got) == [g[4] for g in got]
    assert delimited.read_export(spark, path).columns == ["id", "note", "day", "score", "seq"]


def test_na_tokens_and_line_breaks(spark, tmp_path):
    path = write(tmp_path / "t.csv", 'id,x,y\n1,NA,"two\nlines"\nNA,b,\n')
    df = delimited.read_table(spark, path, "id INT, x STRING, y STRING")
    assert [tuple(r) for r in df.collect()] == [(1, None, "two\nlines"), (None, "b", None)]


def test_several_files_need_an_order(spark, tmp_path):
    write(tmp_path / "e" / "a.csv", "id,visit\n1,2\n")
    write(tmp_path / "e" / "b.csv", "id,visit\n1,1\n")
    with pytest.raises(ValueError, match="order"):
        delimited.read_export(spark, str(tmp_path / "e"), "id INT, visit INT")
    df = delimited.read_export(spark, str(tmp_path / "e"), "id INT, visit INT", order=F.col("visit"))
    assert sorted(r.seq for r in df.collect()) == [1, 2]


def test_wrong_header_is_noticed(spark, tmp_path):
    path = write(tmp_path / "h.csv", "a,b\n1,2\n")
    with pytest.raises(Exception):
        delimited.read_csv(spark, path, "b INT, a INT").collect()


@pytest.mark.parametrize("null", ["NA", ""])
def test_csv_sink(spark, tmp_path, null):
    df = spark.createDataFrame([(1, "a,b", dt.date(2024, 1, 2)), (2, None, None)], "id int, x string, d date")
    delimited.write_csv(df.coalesce(1), str(tmp_path / "out"), null)
    part = next(p for p in (tmp_path / "out").iterdir() if p.name.startswith("part-"))
    assert part.read_text() == f'id,x,d\n1,"a,b",2024-01-02\n2,{null},{null}\n'


def test_line_breaks_survive_a_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "two\nlines, \"quoted\""), (2, "one\r\nmore"), (3, None)], "id int, x string")
    delimited.write_csv(df, str(tmp_path / "o"))
    back = {r.id: r.x for r in delimited.read_table(spark, str(tmp_path / "o"), df.schema).collect()}
    assert back[1] == "two\nlines, \"quoted\"" and back[3] is None
    assert back[2].split() == ["one", "more"]


def test_splittable_scan_gives_the_same(spark, tmp_path):
    path = write(tmp_path / "s.csv", "id,x\n" + "".join(f"{i},v{i}\n" for i in range(500)))
    one = delimited.read_export(spark, path, "id INT, x STRING", multiline=False)
    rows = [r.id for r in one.orderBy("seq").collect()]
    assert rows == list(range(500))
    assert rows == [r.id for r in delimited.read_export(spark, path, "id INT, x STRING").orderBy("seq").collect()]


def test_bundle_writes_only_what_is_asked(spark, tmp_path):
    df = spark.createDataFrame([(1, None)], "id int, x string")
    written = bundle.write_bundle({"a": df, "b": df}, str(tmp_path / "b"), only=["b", "c"])
    assert written == ["b"] and not (tmp_path / "b" / "a").exists()
    assert bundle.read_bundle(spark, str(tmp_path / "b"), "b", schema=df.schema).collect() == df.collect()
    bundle.write_bundle({"p": df}, str(tmp_path / "b"), fmt="parquet")
    assert bundle.read_bundle(spark, str(tmp_path / "b"), "p", "parquet").collect() == df.collect()


BODY = "l2\nl3\nl4\nl5\nTIME N-M  ANGLE\n"


@pytest.fixture
def folder(tmp_path):
    one = "Doe, Jo\n" + BODY
    write(tmp_path / "d" / "x" / "P_101_LEFT.txt", one + " 1  10.5 3\n\n 2 -20 3\n")
    write(tmp_path / "d" / "x" / "P_101_right_T4.txt", one + "1\t7 3\n")
    write(tmp_path / "d" / "P_102_LEFT_T12.txt", one + "1 x 3\n")            # not a number
    write(tmp_path / "d" / "P_103_RIGHT.txt", "Solo\nl2\n")                   # cut short
    write(tmp_path / "d" / "notes_Right.txt", one + "1 NA 3\n2 4 3\n")        # no id, a gap
    write(tmp_path / "d" / "P_104_LEFT_T4.txt", one)                          # no rows
    write(tmp_path / "d" / "Labview" / "P_105_LEFT.txt", one + "1 2 3\n")     # excluded folder
    write(tmp_path / "d" / "P_106_LEFT.csv", one + "1 2 3\n")                 # other kind
    return str(tmp_path / "d")


def test_inventory_and_names(spark, folder):
    found = files.list_files(spark, folder, r".txt", "Labview|desktop saves")
    meta = {r.name: r for r in IN.path_metadata(found, "P").collect()}
    assert sorted(meta) == ["P_101_LEFT", "P_101_right_T4", "P_102_LEFT_T12", "P_103_RIGHT", "P_104_LEFT_T4", "notes_Right"]
    r = meta["P_101_right_T4"]
    assert (r.id, r.side, r.timepoint, r.correct_name) == (101, "right", "m4", "P_101_RIGHT_T4")
    assert meta["P_102_LEFT_T12"].timepoint == "m12" and meta["P_101_LEFT"].timepoint == "m0"
    assert meta["notes_Right"].id is None and meta["notes_Right"].correct_name == "P_NA_RIGHT"
    plan = {r.current_path.rsplit("/", 1)[1]: r.correct_path.rsplit("/", 1)[1]
            for r in IN.rename_plan(IN.path_metadata(found, "P")).collect()}
    assert plan == {"P_101_right_T4.txt": "P_101_RIGHT_T4.txt", "notes_Right.txt": "P_NA_RIGHT.txt"}


def test_contents(spark, folder):
    texts = files.read_whole(spark, folder).filter(F.col("file").rlike("txt$") & ~F.col("file").rlike("Labview"))
    got = {r.file.rsplit("/", 1)[1]: (r.quad, r.hs) for r in files.extremes(texts).collect()}
    assert got == {"P_101_LEFT.txt": (10.5, 20.0), "P_101_right_T4.txt": (7.0, 7.0), "notes_Right.txt": (None, None),
                   "P_104_LEFT_T4.txt": (-math.inf, math.inf)}
    names = {r.file.rsplit("/", 1)[1]: (r.surname, r.firstname) for r in files.with_names(texts).collect()}
    assert names["P_103_RIGHT.txt"] == ("Solo", None) and names["P_101_LEFT.txt"] == ("Doe", "Jo")


def test_missing_files(spark, rows):
    expected = spark.createDataFrame([(1, "m0"), (2, "m0"), (3, "m4"), (None, "m4")], "id int, timepoint string")
    found = spark.createDataFrame([(1, "m0", "left"), (1, "m0", "right"), (2, "m0", "left"), (None, "m4", None)],
                                  "id int, timepoint string, side string")
    assert rows(IN.missing_files(expected, found), "id", "timepoint", "side") == [
        (2, "m0", "right"), (3, "m4", "both"), (None, "m4", None)]


AWKWARD = ["plain", "", "two\nlines", "a \"b\"", ",", "\n", "\r\nx", "NA", "\n\n", "\"", "\"\n\"", " lead", "tr\n ", "x" * 60, "7", "xx"]


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "150", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def awkward(seed, n, end):
    import csv
    import io
    import random
    rnd = random.Random(seed)
    out = io.StringIO()
    w = csv.writer(out, lineterminator=end)
    w.writerow(["id", "x", "y", "k"])
    for i in range(n):
        w.writerow([i, rnd.choice(AWKWARD), rnd.choice(AWKWARD), rnd.choice(["1", "", "xx", "2.5", "NA"])])
    return out.getvalue()


@pytest.mark.parametrize("seed,end", [(1, "\n"), (2, "\r\n"), (3, "\n")])
def test_parallel_read_equals_one_task(spark, tmp_path, small_splits, seed, end):
    text = awkward(seed, 120, end)
    path = write(tmp_path / "big.csv", text + (end * 2 if seed == 3 else ""))  # with empty lines at the end
    ddl = "id INT, x STRING, y STRING, k INT"
    one = delimited.read_export(spark, path, ddl)
    many = delimited.read_export(spark, path, ddl, split_bytes=0)
    assert spark.read.text(path).rdd.getNumPartitions() > 5 and one.rdd.getNumPartitions() == 1
    want = [tuple(r)[:4] for r in one.orderBy("seq").collect()]
    got = many.orderBy("seq").collect()
    assert [tuple(r)[:4] for r in got] == want and [r["id"] for r in got] == list(range(120))
    assert [r["seq"] for r in got] == list(range(120))


def test_rejects_are_counted_and_listed(spark, tmp_path, small_splits):
    path = write(tmp_path / "r.csv", 'id,k,day,x\n1,xx,2024-02-30,a\n2,,NA,"b\nb"\n3,7,2024-01-01,\nfour,8,,c\n')
    for split in (0, 1 << 20):
        table, rejects, counts = delimited.read_checked(spark, path, "id INT, k INT, day DATE, x STRING", ("", "NA"), split_bytes=split)
        got = [tuple(r)[1:] for r in table.orderBy("seq").collect()]
        assert got == [(1, None, None, "a"), (2, None, None, "b\nb"), (3, 7, dt.date(2024, 1, 1), None), (None, 8, None, "c")]
        seqs = [r["seq"] for r in table.orderBy("seq").collect()]
        assert sorted(tuple(r) for r in rejects.collect()) == [
            (seqs[0], "day", "2024-02-30"), (seqs[0], "k", "xx"), (seqs[3], "id", "four")]
        assert counts == {"id": 1, "k": 1, "day": 1}
    by_day = delimited.read_checked(spark, path, "id INT, k INT, day DATE, x STRING", order=F.col("k"))
    assert {r["seq"] for r in by_day.table.collect()} == {None, 7, 8}
    assert {(r["seq"], r["column"]) for r in by_day.rejects.collect()} == {(None, "k"), (None, "day"), (8, "id")}


def test_parallel_read_checks_the_header(spark, tmp_path):
    path = write(tmp_path / "h.csv", "\ufeffa,b\n1,2\n")
    with pytest.raises(ValueError, match="header"):
        delimited.read_csv(spark, path, "b INT, a INT", split_bytes=0)
    assert [tuple(r) for r in delimited.read_csv(spark, path, "a INT, b INT", split_bytes=0).collect()] == [(1, 2)]
    empty = write(tmp_path / "e.csv", "a,b\n")
    assert delimited.read_csv(spark, empty, "a INT, b INT", split_bytes=0).isEmpty()


def test_parts_follow_each_other_by_name(spark, tmp_path, small_splits):
    text = awkward(4, 90, "\n")
    path = str(tmp_path / "parts")
    one = write(tmp_path / "one.csv", text)
    ddl = "id INT, x STRING, y STRING, k INT"
    want = [tuple(r)[:4] for r in delimited.read_export(spark, one, ddl).orderBy("seq").collect()]
    head, *rows_ = list(csv.reader(io.StringIO(text, newline="")))
    for name, some in {"part-2": rows_[70:], "part-0": rows_[:7], "part-1": [], "part-11": rows_[7:70]}.items():
        out = io.StringIO()
        csv.writer(out, lineterminator="\n").writerows([head, *some])
        write(tmp_path / "parts" / f"{name}.csv", out.getvalue())
    write(tmp_path / "parts" / "part-12.csv", "")
    got = delimited.read_export(spark, path, ddl, by_name=True).orderBy("seq").collect()
    assert [r["seq"] for r in got] == list(range(90)) and [tuple(r)[:4] for r in got] == want
    checked = delimited.read_checked(spark, path, ddl, by_name=True)
    bad = [r["seq"] for r in checked.rejects.where("column = 'k'").orderBy("seq").collect()]
    assert bad == [i for i, r in enumerate(rows_) if r[3] in ("xx", "NA", "2.5")]
    with pytest.raises(ValueError, match="order"):
        delimited.read_export(spark, path, ddl)


def test_an_export_is_as_many_parts_as_its_texts_need(spark, tmp_path, monkeypatch):
    from queries import from_documents
    texts = [(i, f"a\n\"{i}\"" + "x" * 1000, "s", i) for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, source string, n_chars long").repartition(3)
    monkeypatch.setattr(from_documents, "PART_BYTES", 50_000)
    monkeypatch.setattr(from_documents, "fresh_path", lambda _: str(tmp_path / "out"))
    got = [tuple(r) for r in from_documents.scan_csv_split(lambda _: docs).orderBy("seq").collect()]
    assert got == [(i, t, s, n if n % 3 else None, i) for i, t, s, n in texts]
    sizes = [f.stat().st_size for f in (tmp_path / "out").glob("part-*")]
    assert len(sizes) > 5 and max(sizes) < 150_000


def test_rejects_come_from_all_parts(spark, tmp_path, monkeypatch):
    from queries import from_documents
    docs = spark.createDataFrame([(i, "x" * 1000, i) for i in range(200)], "doc_id long, text string, n_chars long")
    monkeypatch.setattr(from_documents, "PART_BYTES", 50_000)
    monkeypatch.setattr(from_documents, "fresh_path", lambda _: str(tmp_path / "out"))
    got = [tuple(r) for r in from_documents.csv_rejects(lambda _: docs).orderBy("seq").collect()]
    assert got == [(i, "n_chars", f"no. {i}") for i in range(0, 200, 3)]
    assert len(list((tmp_path / "out").glob("part-*"))) == 5
