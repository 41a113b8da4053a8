"""Files in other encodings, in splits; table functions; the metadata scans."""

import random

import pytest
from pyspark.sql import functions as F

from quillspark.functions import tables
from quillspark.sources import readers, settings


@pytest.fixture(scope="module")
def large(tmp_path_factory):
    """A CSV in windows-1251 of 2 MB, with quotes, separators inside, empty values and numbers that are none."""
    r = random.Random(3)
    words = "Завод Ромашка Ёлка «Юг» № 12 ЯЯЯ ооо".split()
    rows = [(i, " ".join(r.choice(words) for _ in range(6)), r.choice(["1,5", "2.5", "", "нет"])) for i in range(40_000)]
    path = tmp_path_factory.mktemp("files") / "large.csv"
    lines = ["номер;имя;значение"] + [f'{i};"{n}; да";{v}' for i, n, v in rows]
    path.write_bytes("\n".join(lines).encode("windows-1251"))
    return str(path), rows, lines


def test_split_csv(spark, large):
    path, rows, _ = large
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
        df = readers.read_csv(spark, path, "id int, name string, value double", "windows-1251", ";")
        tasks = df.select(F.spark_partition_id().alias("p")).distinct().count()
        got = sorted(map(tuple, df.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert tasks >= 4 and got == [(i, f"{n}; да", 2.5 if v == "2.5" else None) for i, n, v in rows]
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_lines(spark, large, tmp_path):
    path, _, lines = large
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
        df = readers.read_lines(spark, path, "cp1251")
        assert df.select(F.spark_partition_id()).distinct().count() >= 4 and sorted(r.value for r in df.collect()) == sorted(lines)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for encoding in ("koi8-r", "utf-8", "utf-16", "cp866"):
        (tmp_path / encoding).write_bytes("Ёлка\nЮг №1".encode(encoding) if encoding != "koi8-r" else "Ёлка\nЮг 1".encode(encoding))
        assert sorted(r.value for r in readers.read_lines(spark, str(tmp_path / encoding), encoding).collect()) == sorted(["Ёлка", "Юг 1" if encoding == "koi8-r" else "Юг №1"])


def test_other_csv(spark, tmp_path):
    """Two bytes a character; a record of several lines; a file without rows."""
    (tmp_path / "a.csv").write_bytes('id,name\n1,"Зав\nод"\n'.encode("utf-16"))
    assert readers.read_csv(spark, str(tmp_path / "a.csv"), "id int, name string", "utf-16").collect()[0].name == "Зав\nод"
    (tmp_path / "b.csv").write_bytes('id,name\n1,"Зав\nод"\n'.encode("cp1251"))
    assert readers.read_csv(spark, str(tmp_path / "b.csv"), "id int, name string", "cp1251", multi_line=True).collect()[0].name == "Зав\nод"
    (tmp_path / "c.csv").write_bytes("id,name\n".encode("cp1251"))
    assert readers.read_csv(spark, str(tmp_path / "c.csv"), "id int, name string", "cp1251").count() == 0


def test_metadata(spark, tmp_path):
    rows = [
        '{"doc_id": "a", "kind": "Письмо", "delivery_type": "Почта", "reg_date": "2020-01-02T00:00:00", "sender": "x"}', '{"doc_id": "b", "kind": "Письмо", "delivery_type": "МЭДО"}',
        '{"doc_id": "c", "kind": "Приказ", "delivery_type": null}', '{"doc_id": "d", "kind": "Письмо", "delivery_type": null}',
    ]
    (tmp_path / "m.json").write_text("\n".join(rows))
    meta = readers.read_metadata(spark, str(tmp_path / "m.json"))
    ids = lambda df: sorted(r.doc_id for r in df.collect())
    assert ids(readers.letters(meta)) == ["a", "d"] and ids(readers.letters(meta, True)) == ["a", "b", "d"] and meta.schema["reg_date"].dataType.simpleString() == "timestamp"
    (tmp_path / "pdf").mkdir()
    for name in ("x.pdf", "y.txt"):
        (tmp_path / "pdf" / name).write_text("12345")
    assert [(r.path.rsplit("/", 1)[1], r.length) for r in readers.list_pdfs(spark, str(tmp_path / "pdf")).collect()] == [("x.pdf", 5)]
    readers.write_table(meta, f"{tmp_path}/t", ["kind"])
    assert spark.read.parquet(f"{tmp_path}/t").count() == 4


def test_table_functions(spark):
    tables.register(spark)
    rows = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0]), (3, None), (4, [1.0, 2.0, 3.0])], "id int, v array<double>")
    got = spark.sql("SELECT id, a, b FROM {rows}, LATERAL named_values(v, 'a, b')", rows=rows).collect()
    assert sorted(map(tuple, got), key=str) == [(1, 1.0, 2.0), (2, 3.0, None), (3, None, None), (4, 1.0, 2.0)]
    with pytest.raises(Exception, match="constant"):
        spark.sql("SELECT a FROM {rows}, LATERAL named_values(v, CAST(id AS STRING))", rows=rows).collect()
    lines = spark.createDataFrame([("x", 2, "low"), ("x", 0, "UP"), ("x", 1, "UP2"), ("y", 0, None), ("y", 1, "a"), ("x", 3, "B")], "k string, place int, line string")
    got = spark.sql("SELECT * FROM case_islands(TABLE({lines}), 'k', 'place', 'line')", lines=lines).collect()
    assert sorted(map(tuple, got)) == [("x", 0, 2, "UP UP2"), ("x", 1, 1, "low"), ("x", 2, 1, "B"), ("y", 0, 2, " a")]
    assert spark.sql("SELECT partial_ratio('abc', 'xxabc') AS s").first().s == 100


def test_settings(spark, tmp_path):
    text = "RS: 7\nLEV_DISTANCE: 70 # threshold\nESTIMATOR_SIGNER: 'jaro_winkler'\nUNKNOWN: 1\nASSETS:\n  employees:\n    path: '/data/e.csv'\n  topics: null\n"
    (tmp_path / "params.yaml").write_text(text)
    got = settings.read_settings(spark, str(tmp_path / "params.yaml"))
    assert (got.rs, got.lev_distance, got.estimator_signer, got.estimator_sender, got.assets) == (7, 70.0, "jaro_winkler", "jaro_winkler", {"employees": "/data/e.csv"})
    (tmp_path / "none.yaml").write_text("")
    assert settings.read_settings(spark, str(tmp_path / "none.yaml")) == settings.Settings()
    with pytest.raises(ValueError, match="estimator"):
        settings.parsed("ESTIMATOR_SENDER: other")
    rows = spark.createDataFrame([(1, 59.0), (2, 60.0), (3, 71.0), (4, None)], "doc_id long, similarity double")
    assert [settings.accepted(rows, got, e).first().share for e in ("sender", "signer")] == [0.5, 0.25]


def test_settings_choose_estimators(spark):
    blocks = spark.createDataFrame([(1, 1, 0.9, "ООО Ромашка плюс"), (1, 1, 0.9, "другой текст")], "doc_id long, page_num int, ybot double, text string")
    truth = spark.createDataFrame([(1, "ромашка", "x")], "doc_id long, sender string, signer string")
    targets = lambda s: sorted(r.target for r in settings.mark_senders(blocks, truth, s).collect())
    assert targets(settings.parsed("ESTIMATOR_SENDER: lev_distance")) == ["other", "sender"] and targets(settings.Settings()) == []


def test_datasets(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "id int, t string")
    readers.write_table(df, f"{tmp_path}/x.parquet")
    df.write.json(f"{tmp_path}/x.json")
    df.write.option("header", True).csv(f"{tmp_path}/x.csv")
    (tmp_path / "y.json").write_text('[{"id": 1, "t": "a,b"},\n {"id": 2}]')
    for path, form in (("x.parquet", None), ("x.json", None), ("x.csv", None), ("y.json", "json_array")):
        assert sorted(map(tuple, readers.read_dataset(spark, f"{tmp_path}/{path}", "id int, t string", form).collect())) == [(1, "a,b"), (2, None)]
    with pytest.raises(ValueError, match="schema"):
        readers.read_dataset(spark, f"{tmp_path}/x.csv")
    meta = spark.createDataFrame([("a", "text"), ("b", " \n"), ("c", None), ("d", "t"), ("e", "t")], "doc_id string, content string")
    files = spark.createDataFrame([("a", ".PDF"), ("b", ".pdf"), ("d", ".doc"), ("a", ".pdf")], "doc_id string, extension string")
    assert [r.doc_id for r in readers.with_content(meta, files).collect()] == ["a"]


def test_mapping_of_several_lines(spark, tmp_path):
    (tmp_path / "m.json").write_text('{\n  "a": "x",\n  "b": null,\n  "c": "y"\n}\n')
    assert sorted(map(tuple, readers.read_mapping(spark, str(tmp_path / "m.json")).collect())) == [("a", "x"), ("c", "y")]


def test_paths(spark):
    meta = spark.createDataFrame([("a", "Письмо", "Почта"), ("b", "Письмо", "МЭДО"), ("c", "Приказ", None), ("d", "Письмо", None), ("a", "Письмо", "Почта")], "doc_id string, kind string, delivery_type string")
    files = spark.createDataFrame([("a", "1", 1, ".pdf"), ("a", "2", 2, ".PDF"), ("a", "3", 3, ".doc"), ("b", "4", 1, ".pdf"), ("c", "5", 1, ".pdf"), ("d", "6", 1, ".pdf")], "doc_id string, id string, `order` int, extension string")
    there = spark.createDataFrame([(i,) for i in "12345"], "id string")
    paths = lambda e: sorted(map(tuple, readers.pdf_paths("/root/", meta, files, there, e).collect()))
    assert paths(False) == [("a", "/root/a/2.PDF")] and paths(True) == [("a", "/root/a/2.PDF"), ("b", "/root/b/4.pdf")]
    full = meta.withColumns({c: F.lit("x") for c in ("sender", "sender_id", "signer", "signer_id")})
    assert readers.dedup_metadata(full).count() == 4
