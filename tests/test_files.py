import gzip

import pytest
from pyspark.sql import functions as F

from vitrine.sources import readers as rd
from vitrine.sources import sinks as sk
from vitrine.sources.versions import PublishedTable
from vitrine.streaming import streams as sm


def put(path, text):
    path.write_bytes(text.encode())
    return str(path)


def test_record_export(spark, tmp_path, rows):
    path = put(tmp_path / "x.csv", "id\tname@@1\tA\r\nB@@2\tC\tD@@3\t@@(3 rows)@@\n")
    good, bad = rd.read_record_export(spark, path)
    assert good.columns == ["id", "name"]
    assert rows(good) == [("1", "A  B"), ("3", "")] and rows(bad) == [("2\tC\tD",)]


def test_manifest(spark, tmp_path):
    path = put(tmp_path / "m.csv", "name|objectnumber|approvedforweb\r\na.jpg|1.1|on\r\nb.jpg||\r\n")
    got = [r.asDict() for r in rd.read_manifest(spark, path).orderBy("name").collect()]
    assert set(got[0]) == set(rd.MANIFEST_FIELDS)
    assert got[0]["approvedforweb"] == "on" and got[1]["objectnumber"] == "" and got[1]["handling"] == ""


def test_lists_and_pairs(spark, tmp_path, rows):
    assert rows(rd.read_keyword_list(spark, put(tmp_path / "l", "Not here\tx\n#On loan\n\n"))) == [("#On loan",), ("Not here",)]
    assert rd.read_pairs(spark, put(tmp_path / "p", "a,b\n\nc,d\n")) == [("a", "b"), ("c", "d")]


def test_scanner_lines(spark, rows):
    df = spark.createDataFrame([('"M","A 1" ',), ('"M","A 1"',), ("x",), ("",)], "value string")
    assert rows(rd.parse_scanner_lines(df)) == [('"M","A 1"', ["M", "A 1"])]


SPEC = ["#\tnote", "header\t\tName", "field\t1\tid\tID\tid" + "\t" * 12, "field\t2\tobj\tObject\tobj_s\t\t\t\t\t2\t\t\t\t\t\t2\tx", "field\t3\tnum\tNo.\tnum_s\t\t\t\t\t1\t\t\t\t\t\t1\tx"]


def test_field_spec(spark, tmp_path, rows):
    spec = rd.read_field_spec(spark, put(tmp_path / "s", "\n".join(SPEC)))
    assert spec.count() == 3 and sk.facet_fields(spec) == ["obj_s", "num_s"]
    df = spark.createDataFrame([("1", "vase", "n9")], "id string, obj_s string, num_s string")
    assert sk.project_by_spec(df, spec, "inCSV").columns == ["num", "obj"]
    assert sk.project_by_spec(df, spec, "inCSV", labels=True).columns == ["No.", "Object"]


def test_audit_round_trip(spark, tmp_path):
    path = str(tmp_path / "log")
    df = spark.createDataFrame([("1", "a=b\nc"), ("2", None)], "id string, note string")
    for _ in range(2):
        sk.append_audit(sk.audit_rows(df, "PUT", "edit", "objects", "me", "2024-01-01T00:00:00Z", ["id", "note"]), path)
    log = rd.read_audit_log(spark, path)
    assert log.count() == 4
    assert {r["attrs"]["id"]: r["attrs"]["note"] for r in log.collect()} == {"1": "a=b c", "2": ""}


def test_suffix_schema():
    copies, multi = sk.suffix_schema(["id", "a_s", "b_ss", "c_txt", "blob_ss"])
    assert copies == [("a_s", "a_txt"), ("b_ss", "b_txt"), ("c_txt", "c_s"), ("blob_ss", "blob_txt")] and multi == ["b_ss"]


def test_replace_load(spark, tmp_path):
    path = str(tmp_path / "index")
    first = spark.createDataFrame([("1", "x|y", "b1,b2"), ("2", "", "")], "id string, t_ss string, blob_ss string")
    sk.replace_load(first, path)
    sk.replace_load(first.filter("id = '1'"), path)
    row = PublishedTable(spark, path, "id").read().collect()
    assert len(row) == 1 and row[0]["t_ss"] == ["x", "y"] and row[0]["t_txt"] == ["x", "y"] and row[0]["blob_ss"] == ["b1", "b2"]


def test_write_delimited(spark, tmp_path):
    df = spark.createDataFrame([("1", 'say "x", y')], "id string, t string").coalesce(1)
    target = sk.write_delimited(df, str(tmp_path / "out"), "r1", ["t"], sep=",", quote_all=True, compression="gzip")
    (part,) = [p for p in (tmp_path / "out" / "run=r1").iterdir() if p.name.endswith(".gz")]
    assert gzip.open(part, "rt").read() == '"t"\n"say ""x"", y"\n'
    assert sk.write_delimited(df, str(tmp_path / "out"), "r2") != target
    with pytest.raises(Exception):
        sk.write_delimited(df, str(tmp_path / "out"), "r1")


def test_audit_stream_picks_up_new_files(spark, tmp_path):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    line = "POST\t2024-01-0{0}T0{0}:00:00Z\tmove\tu\tme\tid={0}\n"
    put(tmp_path / "in" / "a", "#skip\n" + line.format(1) + line.format(1))
    run = lambda: sm.run_to_table(sm.recent_activity(sm.audit_stream(spark, folder)), out, state).awaitTermination()
    run()
    put(tmp_path / "in" / "b", line.format(4))
    run()
    got = spark.read.parquet(out).select(F.date_format("start", "MM-dd HH").alias("s"), "update_type", "n").collect()
    assert [tuple(r) for r in got] == [("01-01 01", "move", 2)]


def test_audit_tabs_and_repeated_keys(spark, tmp_path):
    path = str(tmp_path / "audit")
    df = spark.createDataFrame([("a", "x\ty")], "id string, note string")
    sk.append_audit(sk.audit_rows(df, "PUT", "edit", "objects", "me", "2024-01-01T00:00:00Z", ["id", "note"]), path)
    assert [r["attrs"] for r in rd.read_audit_log(spark, path).collect()] == [{"id": "a", "note": "x y"}]
    line = spark.createDataFrame([("PUT\tt\tedit\tu\tme\tk=1\tj=0\tk=2\tno cell",)], "value string")
    assert rd.parse_audit_log(line).first()["attrs"] == {"k": "2", "j": "0"}


def test_a_redelivered_manifest_counts_once(spark, tmp_path, rows):
    folder, out, state = (str(tmp_path / n) for n in ("drop", "out", "state"))
    (tmp_path / "drop").mkdir()
    text = "name|objectnumber\na.jpg|1.1\nb.jpg|1.2\n"

    def run():
        stream = sm.manifest_stream(spark, folder, ["name", "objectnumber"], "*.csv", late="1 day").select("name", "objectnumber")
        sm.run_to_table(stream, out, state).awaitTermination()

    put(tmp_path / "drop" / "a.csv", text)
    run()
    put(tmp_path / "drop" / "b.csv", text + "c.jpg|1.3\n")
    run()
    assert rows(spark.read.parquet(out)) == [("a.jpg", "1.1"), ("b.jpg", "1.2"), ("c.jpg", "1.3")]


def test_late_lines_go_to_the_side_table(spark, tmp_path):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    line = "POST\t2024-01-{0:02}T00:00:00Z\tmove\tu\tme\tid={0}\n"
    put(tmp_path / "in" / "a", line.format(9) + line.format(9) + "#note\n" + line.format(10) + "POST\tno time\tmove\tu\tme\tid=x\n")
    sm.run_audit(spark, folder, out, state)
    put(tmp_path / "in" / "b", line.format(10) + line.format(2) + line.format(2) + line.format(11))
    sm.run_audit(spark, folder, out, state)
    put(tmp_path / "in" / "c", line.format(2) + line.format(3))
    actions, aside = sm.run_audit(spark, folder, out, state)
    assert sorted(r["attrs"]["id"] for r in actions.collect()) == ["10", "11", "9", "x"]
    assert sorted(r["attrs"]["id"] for r in aside.collect()) == ["2", "3"]
