import hashlib

from pyspark.sql import functions as F

from quillfold.plans.inspect import formatted, uses_python
from quillfold.sources import io
from quillfold.sources.tables import load

SF = "/root/testdata/sf0.001"


def test_strict_read_routes_rejects(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"batch_id": "b1", "items": [{"document_id": "d1", "files": [{"path": "a.pdf", "size": 3}]}, {"document_id": "d2", "files": []}]}\nnot json\n{"batch_id": "b2", "items": 7}\n')
    ok, bad = io.read_strict(spark, str(tmp_path), io.MANIFEST)
    assert [r["batch_id"] for r in ok.collect()] == ["b1"] and bad.count() == 2
    rows = io.manifest_files(ok).collect()
    assert [(r["idx"], r["document_id"], r["path"]) for r in rows] == [(0, "d1", "a.pdf"), (1, "d2", None)]


def test_uploads_against_declarations(spark, tmp_path):
    files = {"a.pdf": b"junk %PDF-1.7 rest", "b.png": b"\x89PNG\r\n\x1a\n123", "c.gif": b"GIF89a...", "d.bin": b"text"}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)

    def row(name, kind, size=None, sha=None):
        data = files.get(name, b"")
        return (name, sha or hashlib.sha256(data).hexdigest(), len(data) if size is None else size, kind)

    declared = spark.createDataFrame([row("a.pdf", "application/pdf"), row("b.png", "image/jpeg"), row("c.gif", "image/gif", size=1), row("d.bin", "application/octet-stream", sha="0" * 64), row("e.pdf", "application/pdf")], "path string, sha256 string, size long, media_type string")
    got = {r["path"]: r["error"] for r in io.uploads(spark, str(tmp_path), declared).collect()}
    assert got == {"a.pdf": None, "b.png": "MEDIA_TYPE", "c.gif": "SIZE", "d.bin": "DIGEST", "e.pdf": "MISSING"}


def test_first_writer_wins(spark, tmp_path):
    store = str(tmp_path / "store")
    first = spark.createDataFrame([("k1", b"x", 2), ("k1", b"y", 1), ("k2", b"z", 1)], "key string, content binary, at int")
    assert {(r["key"], bytes(r["content"])) for r in io.put_once(spark, store, first, "key", "at").collect()} == {("k1", b"y"), ("k2", b"z")}
    again = spark.createDataFrame([("k2", b"new", 0), ("k3", b"n", 0)], "key string, content binary, at int")
    assert [r["key"] for r in io.put_once(spark, store, again, "key", "at").collect()] == ["k3"]
    held = spark.read.parquet(store)
    assert [r["key"] for r in io.list_prefix(held, "k").collect()] == ["k1", "k2", "k3"]
    wanted = spark.createDataFrame([("k1", hashlib.sha256(b"y").hexdigest()), ("k2", "0" * 64), ("k9", "0" * 64)], "key string, sha256 string")
    assert {r["key"]: r["error"] for r in io.read_registered(held, wanted).collect()} == {"k1": None, "k2": "DIGEST", "k9": "MISSING"}


def test_report_sinks(spark):
    df = spark.createDataFrame([(1, "a", None)], "n int, s string, z string")
    assert io.markdown(df) == "| n | s | z |\n| --- | --- | --- |\n| 1 | a |  |"
    assert io.as_log_lines(df, trace_id="t1").first()[0] == '{"n":1,"s":"a","trace_id":"t1"}'


def test_filters_and_columns_reach_the_scan(spark):
    df = load(spark, SF, "orders").where("o_orderstatus = 'O'").select("o_orderkey")
    text = formatted(df)
    assert "EqualTo(o_orderstatus,O)" in text and "o_totalprice" not in text.split("ReadSchema")[1].splitlines()[0]
    assert not uses_python(df) and df.where(F.col("o_orderkey") < 0).count() == 0
