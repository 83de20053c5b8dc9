"""Many texts in one file, and the job that extracts new ones."""

import os

import pytest
from pyspark.sql import functions as F

from waybill.operators.extract import extract_loads
from waybill.operators.ingest import extract_new_texts, extract_with_status
from waybill.sources import files, sinks

ODD = ["", " ", "a\nb\r\nc", "\r", "é\u2028\U0001f600", "\ufefftwo", "x" * 100_000, "same", "same"]


def packed(spark, rows, path, *partitions, **options):
    df = spark.createDataFrame(rows, "text string, source string")
    sinks.write_packed_texts(df, path, *partitions, **options)


@pytest.mark.parametrize("split_bytes", [20_000, 128 << 20])
def test_packed_texts_round_trip(spark, tmp_path, split_bytes):
    texts = [f"text {i}\n" + "word " * (i % 90) for i in range(3000)] + ODD
    packed(spark, [(t, "A" if i % 50 else "B") for i, t in enumerate(texts)], str(tmp_path / "in"), "source")
    assert sum(name.endswith(".txt") for _, _, found in os.walk(tmp_path / "in") for name in found) < 20
    conf = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(conf)
    spark.conf.set(conf, split_bytes)
    try:
        rows = files.scan_packed_texts(spark, str(tmp_path / "in")).collect()
    finally:
        spark.conf.set(conf, before)
    want = sorted((t, "A" if i % 50 else "B") for i, t in enumerate(texts))
    assert sorted((r.text, r.source) for r in rows) == want
    assert all(f"/source={r.source}/" in r.source_file and r.unreadable is None for r in rows)


def test_other_separators_nulls_and_empty_tables(spark, tmp_path):
    packed(spark, [("a\fb", "A"), (None, "A"), ("c", None)], str(tmp_path / "in"), separator="\x1e")
    rows = files.scan_packed_texts(spark, str(tmp_path / "in"), separator="\x1e").collect()
    assert sorted(r.text for r in rows) == ["", "a\fb", "c"]
    packed(spark, [], str(tmp_path / "none"))
    assert files.scan_packed_texts(spark, str(tmp_path / "none")).count() == 0


def test_texts_with_the_separator_are_refused(spark, tmp_path):
    with pytest.raises(Exception, match="a text holds the separator"):
        packed(spark, [("a", "A"), ("b\fc", "A")], str(tmp_path / "in"))


def test_unreadable_texts_leave_their_neighbours(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_bytes(b"good\f\xffbad\f\xc3\xa9\f")
    (tmp_path / "in" / "b.md").write_bytes(b"no text file")
    rows = files.scan_packed_texts(spark, str(tmp_path / "in")).collect()
    found = {(r.text, None if r.unreadable is None else bytes(r.unreadable)) for r in rows}
    assert found == {("good", None), (None, b"\xffbad"), ("é", None)}


def test_job_extracts_each_text_once(spark, tmp_path):
    place, out, progress = (str(tmp_path / name) for name in ("in", "out", "progress"))

    def arrive(name, content):
        folder = tmp_path / "in" / "source=A"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(content)

    def run(n):
        texts = files.stream_packed_texts(spark, place, partitions="source string")
        return extract_new_texts(texts.withColumn("run", F.lit(n)), out, progress)

    arrive("1.txt", b"Trip # 11\nTotal Carrier Pay: $1,200.50\f\f\xff Trip # 12\f")
    assert run(1) == 3
    arrive("2.txt", b"Trip # 13\f")
    assert run(2) == 1
    assert run(3) == 0
    got = spark.read.parquet(out)
    rows = sorted((r.status, r.run, r.loadConfirmationNumber, r.error or "") for r in got.collect())
    assert rows == [("empty", 1, "", ""), ("failed", 1, "", "text not readable"), ("ok", 1, "11", ""), ("ok", 2, "13", "")]
    assert bytes(got.filter("status = 'failed'").first().unreadable) == b"\xff Trip # 12"
    assert {name for name in os.listdir(out) if "=" in name} == {"status=ok", "status=empty", "status=failed"}
    # The stream's rows are those of a batch over the same files.
    batch = extract_with_status(files.scan_packed_texts(spark, place)).drop("processed_at")
    assert got.select(*batch.columns).exceptAll(batch).isEmpty() and batch.count() == got.count()
    good = files.scan_packed_texts(spark, place).filter("text <> ''")
    plain = extract_loads(good).drop("processed_at")
    assert got.filter("status = 'ok'").select(*plain.columns).exceptAll(plain).isEmpty()


def test_failed_run_leaves_no_rows(spark, tmp_path):
    place, out, progress = (str(tmp_path / name) for name in ("in", "out", "progress"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text("Trip # 11\fTrip # 12\f")
    texts = files.stream_packed_texts(spark, place)
    lost = F.when(F.col("text").contains("12"), F.raise_error(F.lit("lost"))).otherwise(F.col("text"))
    with pytest.raises(Exception, match="lost"):
        extract_new_texts(texts.withColumn("text", lost), out, progress)
    assert extract_new_texts(texts, out, progress) == 2
    loads = spark.read.parquet(out)
    assert sorted(r.loadConfirmationNumber for r in loads.collect()) == ["11", "12"]
