"""Readers and writers on small files."""

import json

import pytest
from pyspark.sql import functions as F

from tidewell.operators.features import latest_runs
from tidewell.sources import files


def test_read_any_by_suffix(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,b\n")
    (tmp_path / "a.jsonl").write_text('{"x": 1}\n\nbroken\n{"x": 2}\n')
    spark.range(3).write.parquet(str(tmp_path / "a.parquet"))
    assert files.read_any(spark, str(tmp_path / "a.csv")).first()[:] == (1, "b")
    assert sorted(r.x for r in files.read_any(spark, str(tmp_path / "a.jsonl"), "x int").collect() if r.x is not None) == [1, 2]
    assert files.read_any(spark, str(tmp_path / "a.parquet")).count() == 3
    with pytest.raises(ValueError):
        files.read_any(spark, str(tmp_path / "a.xlsx"))


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "cp949"])
def test_csv_encodings(spark, tmp_path, encoding):
    (tmp_path / "k.csv").write_bytes("이름,값\n홍길동,가\n".encode(encoding))
    df = files.read_csv_any(spark, str(tmp_path / "k.csv"))
    assert df.columns == ["이름", "값"] and df.first()[:] == ("홍길동", "가")


def test_rows_are_trimmed_and_blank_ratings_are_zero(spark):
    df = spark.createDataFrame([(" a ", " 4.5"), ("b", " "), (None, None)], "n string, rating string")
    assert [tuple(r) for r in files.clean_rows(df, ["rating"]).collect()] == [("a", 4.5), ("b", 0.0), (None, 0.0)]


def test_columns_are_found_and_required(spark):
    df = spark.createDataFrame([(1, 2.0)], ["Timestamp", "VALUE"])
    assert files.assert_columns(df, ["timestamp", "value"], exact=True).columns == ["timestamp", "value"]
    with pytest.raises(ValueError):
        files.assert_columns(df, ["timestamp", "reading"])
    with pytest.raises(ValueError):
        files.assert_columns(df, ["timestamp"], exact=True)
    assert files.find_column(["Q", "q"], ["q"]) == "q" and files.find_column(["Q"], ["x", "q"]) == "Q"


def test_series_and_dated_csv(spark, tmp_path):
    (tmp_path / "s.csv").write_text(" Timestamp ,Value\n2024-01-01 00:00:01,1.5\nbad,NaN\n")
    rows = files.read_series_csv(spark, str(tmp_path / "s.csv")).collect()
    assert rows[0]["value"] == 1.5 and rows[1][:] == (None, None)
    (tmp_path / "d.csv").write_text("Date,High\n2017-01-03,NaN\n2017-01-04,2\n")
    rows = files.read_dated_csv(spark, str(tmp_path / "d.csv")).collect()
    assert rows[0]["High"] is None and rows[1]["High"] == 2.0 and str(rows[0]["Date"]) == "2017-01-03"


def test_jsonl_append_and_csv_write(spark, tmp_path):
    df = spark.createDataFrame([(1, "가")], "a int, b string")
    for _ in range(2):
        files.append_jsonl(df, str(tmp_path / "log"))
    assert files.read_jsonl(spark, str(tmp_path / "log"), "a int, b string").count() == 2
    files.write_csv(df, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).first()[:] == ("1", "가")


def test_documents_of_known_types_only(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_text("one\ntwo")
    (tmp_path / "sub" / "b.md").write_text("# x")
    (tmp_path / "c.bin").write_text("no")
    rows = {r.source.rsplit("/", 1)[1]: r.text for r in files.read_documents(spark, str(tmp_path)).collect()}
    assert rows == {"a.txt": "one\ntwo", "b.md": "# x"}


def test_glossary_entries(spark, tmp_path):
    text = "Alpha\n\nMeaning: first letter.\nExample: \"a\"\nRelated: x, y\n\nBeta\n\nMeaning: second: letter.\nExample: b\nRelated: z\n"
    (tmp_path / "g.txt").write_text(text)
    rows = files.read_glossary(spark, str(tmp_path / "g.txt"), ["Meaning", "Example", "Related"]).orderBy("pos").collect()
    assert [(r.term, r.definition, r.example, r.related) for r in rows] == [
        ("Alpha", "first letter.", '"a"', ["x", "y"]),
        ("Beta", "second: letter.", "b", ["z"]),
    ]


def test_versions_count_up(spark, tmp_path):
    path = str(tmp_path / "v")
    assert [files.write_version(spark.range(n), path) for n in (1, 2)] == [1, 2]
    assert {r.version: r["count"] for r in spark.read.parquet(path).groupBy("version").count().collect()} == {1: 1, 2: 2}


def test_cache_follows_its_input(spark, tmp_path):
    one = spark.createDataFrame([(1, "a")], "x int, y string")
    calls = []

    def shout(df):
        return lambda: calls.append(1) or df.withColumn("y", F.upper("y"))

    for _ in range(2):
        assert files.cached(one, shout(one), str(tmp_path), "k").first().y == "A"
    assert len(calls) == 1
    other = one.withColumn("y", F.lit("b"))
    assert files.cached(other, shout(other), str(tmp_path), "k").first().y == "B"
    swapped = [spark.createDataFrame([r], "x string, y string") for r in ((None, "v"), ("v", None))]
    assert files.fingerprint(swapped[0]) != files.fingerprint(swapped[1])
    assert len(list(tmp_path.iterdir())) == 2


def test_records_are_json_with_nulls(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 10:00:00.5' AS ts, double('NaN') AS v, 'x' AS s")
    assert json.loads(files.records_json(df, "ts").first().record) == {"ts": "2024-01-01 10:00:00", "v": None, "s": "x"}


def test_batches_and_runs_are_appended(spark, tmp_path):
    df = spark.createDataFrame([(i, i // 3 + 1) for i in range(7)], "i int, batch int")
    files.write_batches(df, str(tmp_path / "b"))
    assert sorted(p.name for p in (tmp_path / "b").iterdir() if p.is_dir()) == ["batch=1", "batch=2", "batch=3"]
    for n, at in ((1, "2024-01-01"), (2, "2024-01-02")):
        files.append_run(spark, str(tmp_path / "log"), "r", {"f1": n / 10, "depth": n}, at)
    latest = latest_runs(spark.read.parquet(str(tmp_path / "log")), ["run_id", "key"], "value", ["logged_at"])
    assert {r.key: (r.value, r.n_logged) for r in latest.collect()} == {"f1": ("0.2", 2), "depth": ("2", 2)}
