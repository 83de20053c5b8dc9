"""Tables that are replaced, files that are set aside, streams and lookups."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from waybill.operators import validate as V
from waybill.operators.status import split_status
from waybill.sources import files, sinks
from waybill.sources.schema import TABLE_FIELDS


@pytest.fixture
def table():
    return f"t_{uuid.uuid4().hex}"


def parts(path):
    return [name for name in os.listdir(path) if name.startswith("part-")]


def test_replaced_table_keeps_columns(spark, table, tmp_path):
    first = spark.createDataFrame([(1, "a", 1.5)], "id int, old string, Price double")
    sinks.replace_table(first, table, str(tmp_path))
    sinks.replace_table(spark.createDataFrame([(2.5, 2, True)], "price double, id int, new boolean"), table, str(tmp_path))
    assert spark.table(table).columns == ["id", "old", "Price", "new"]
    assert [tuple(r) for r in spark.table(table).collect()] == [(2, None, 2.5, True)]
    sinks.replace_table(spark.createDataFrame([], "id int"), table, str(tmp_path))
    assert spark.table(table).columns == ["id", "old", "Price", "new"] and spark.table(table).count() == 0


def test_failed_write_leaves_the_table(spark, table, tmp_path):
    sinks.replace_table(spark.range(5).toDF("id"), table, str(tmp_path))
    broken = spark.range(10).select(F.when(F.col("id") > 8, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        sinks.replace_table(broken.withColumn("new", F.lit(1)), table, str(tmp_path))
    assert spark.table(table).columns == ["id"] and spark.table(table).count() == 5
    # A table may be replaced by what is read from it.
    sinks.replace_table(spark.table(table).filter("id > 2"), table, str(tmp_path))
    assert sorted(r.id for r in spark.table(table).collect()) == [3, 4]


def test_other_types_are_refused(spark, table, tmp_path):
    sinks.replace_table(spark.range(5).toDF("id"), table, str(tmp_path))
    with pytest.raises(sinks.SchemaConflict, match="id: string, stored bigint"):
        sinks.replace_table(spark.createDataFrame([("x",)], "id string"), table, str(tmp_path))
    with pytest.raises(sinks.SchemaConflict, match="case"):
        sinks.replace_table(spark.range(1).select("id", F.col("id").alias("ID")), table, str(tmp_path))
    assert spark.table(table).count() == 5


def test_loads_are_declared_with_comments(spark, table, tmp_path):
    sinks.replace_loads(spark.createDataFrame([("a", "x")], "source_file string, extra string"), table, str(tmp_path))
    stored = spark.table(table)
    assert stored.columns == [*TABLE_FIELDS, "extra"]
    assert stored.schema["carrier_mc"].metadata["comment"] == "motor carrier number"


def test_files_have_the_size_asked_for(spark, table, tmp_path):
    rows = spark.range(0, 200_000, 1, 16).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    conf = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(conf)
    small = sinks.replace_table(rows, table, str(tmp_path), file_bytes=2 << 20)
    large = sinks.replace_table(rows, table, str(tmp_path), file_bytes=1 << 30)
    assert len(parts(large)) == 1 and 4 <= len(parts(small)) <= 16
    assert spark.conf.get(conf) == before


def test_unreadable_files_are_set_aside(spark, tmp_path):
    for name, content in {"a.txt": b"good", "b.txt": b"\xff\xfebad", "d.txt": "é".encode()}.items():
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_bytes(content)
    docs = files.scan_text_files(spark, str(tmp_path / "in"), keep_unreadable=True)
    counts = sinks.write_by_status(docs, str(tmp_path / "out")).get
    assert counts == {"n_documents": 3, "n_ok": 2, "n_empty": 0, "n_failed": 1}
    good, rest = split_status(spark.read.parquet(str(tmp_path / "out")))
    assert sorted(r.text for r in good.collect()) == ["good", "é"]
    failed = rest.filter("status = 'failed'").first()
    assert bytes(failed.unreadable) == b"\xff\xfebad" and failed.text is None and failed.error
    assert {name for name in os.listdir(tmp_path / "out") if "=" in name} == {"status=ok", "status=failed"}
    assert "unreadable" not in files.scan_text_files(spark, str(tmp_path / "in")).columns


def test_stream_reads_only_new_files(spark, tmp_path):
    place, out, progress = (str(tmp_path / name) for name in ("in", "out", "progress"))

    def arrive(name, text):
        folder = tmp_path / "in" / "source=A"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(text)

    def run(n):
        rows = files.stream_text_files(spark, place, partitions="source string").withColumn("run", F.lit(n))
        return sinks.append_stream(rows, out, progress)

    arrive("1.txt", "one")
    arrive("2.md", "no text file")
    assert run(1) == 1
    arrive("3 4.txt", "three")
    arrive("5.txt", "five")
    assert run(2) == 2
    assert run(3) == 0
    got = spark.read.parquet(out)
    assert sorted((r.text, r.run) for r in got.collect()) == [("five", 2), ("one", 1), ("three", 2)]
    whole = files.scan_text_files(spark, place)
    assert got.drop("run").select(*whole.columns).exceptAll(whole).isEmpty()
    assert got.filter("source = 'A'").count() == 3


def scanned_rows(df):
    """Rows that the scans of a query gave, once it has run."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.executedPlan().collectLeaves() if "Adaptive" in plan.getClass().getName() else plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def golden(spark, *keys):
    return V.golden_records(spark, [{V.KEY: key, "totalCarrierPay": "1"} for key in keys])


@pytest.mark.parametrize("case_sensitive", [False, True])
def test_lookup_leaves_data_out(spark, tmp_path, case_sensitive):
    # Keys without order in every file, so that only the filters tell the files apart.
    key = F.concat(F.lit("K"), F.sha2(F.col("id").cast("string"), 256))
    loads = spark.range(0, 40_000, 1, 8).select(key.alias(V.KEY), F.lit("1").alias("totalCarrierPay"), F.lit("s").alias("source_file"))
    path = str(tmp_path / "lookup")
    V.write_lookup(loads, path)
    known = loads.filter("source_file = 's'").limit(1).first()[0]
    truth = golden(spark, known if case_sensitive else known.lower(), "not there")
    stored = spark.read.parquet(path)
    fields = [V.KEY, "totalCarrierPay"]
    result = V.validate_loads(truth, stored, fields=fields, case_sensitive=case_sensitive)
    want = V.validate_loads(truth, loads, fields=fields, case_sensitive=case_sensitive)
    assert sorted(map(tuple, result.collect())) == sorted(map(tuple, want.collect()))
    name = V.WRITTEN_KEY if case_sensitive else V.LOWER_KEY
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert f"In({name}" in plan
    wanted = stored.filter(F.col(name).isin([known if case_sensitive else known.lower(), "not there"])).select(name)
    assert scanned_rows(wanted) <= 10_000


def test_many_golden_keys_are_joined(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(V, "LISTED_KEYS", 1)
    loads = spark.createDataFrame([("A1", "1", "s"), ("B2", "1", "s")], f"{V.KEY} string, totalCarrierPay string, source_file string")
    path = str(tmp_path / "lookup")
    V.write_lookup(loads, path)
    truth = golden(spark, "a1", "b2", None, "c3")
    rows = V.validate_loads(truth, spark.read.parquet(path), fields=["totalCarrierPay"]).collect()
    assert sorted((r.load_id or "", r.status) for r in rows) == [
        ("", V.MISSING_RECORD), ("a1", V.MATCH), ("b2", V.MATCH), ("c3", V.MISSING_RECORD),
    ]
