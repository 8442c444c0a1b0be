import json

import pytest
from pyspark.sql import functions as F, types as T

from claimwright.operators import models
from claimwright.session import scratch_path, shared_folder
from claimwright.sources import files, warehouse
from claimwright.operators.registry import ModelRegistry
from claimwright.streaming import ingest, score


@pytest.fixture
def text_file(tmp_path):
    path = tmp_path / "claims.txt"
    path.write_text("CLAIM_ID_KEY|SV_STAT|AMT_PAID\n" + "".join(f"{i}|{'01' if i % 2 else ''}|{i}.5\n" for i in range(100)))
    return str(path)


def test_read_delimited(spark, text_file):
    schema = files.claims_schema(files.header_of(spark, text_file))
    df = files.read_delimited(spark, text_file, schema)
    assert df.count() == 100 and df.dtypes == [("CLAIM_ID_KEY", "bigint"), ("SV_STAT", "string"), ("AMT_PAID", "double")]
    assert files.read_delimited(spark, text_file, schema, nrows=10).count() == 10
    some = files.read_delimited(spark, text_file, schema, ["AMT_PAID"])
    assert some.columns == ["AMT_PAID"] and some.first()[0] == 0.5
    assert df.filter("SV_STAT IS NULL").count() == 50
    with pytest.raises(ValueError):
        files.read_delimited(spark, text_file, schema, ["absent"])


def test_filter_without_match_is_empty(spark, text_file):
    df = files.read_delimited(spark, text_file)
    assert files.read_with_filter(df, "SV_STAT", ["zz"]).count() == 0
    assert files.read_with_filter(df, "SV_STAT", ["01"]).count() == 50


def test_formats_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 0.1), (2, None, None)], "i int, s string, d double")
    for fmt in files.FORMATS:
        path = str(tmp_path / fmt)
        files.write_object_store(df, path, fmt)
        assert sorted(map(tuple, files.read_object_store(spark, path, fmt, df.schema).collect())) == [(1, "a", 0.1), (2, None, None)]
    for call in (lambda: files.write_object_store(df, "x", "orc"), lambda: files.read_object_store(spark, "x", "orc")):
        with pytest.raises(ValueError):
            call()


def test_lookups(spark, tmp_path):
    (tmp_path / "REF_A.txt").write_text("CODE|TEXT\n01|one\n1|uno\n|unknown\n0E|x\n")
    (tmp_path / "REF_B.txt").write_text("CODE|TEXT|MORE\n0100|a|\n")
    (tmp_path / "notes.md").write_text("no table")
    a = files.read_lookup(spark, str(tmp_path / "REF_A.txt"))
    assert [r["CODE"] for r in a.collect()] == ["01", "1", None, "0E"]
    assert files.read_lookup(spark, str(tmp_path / "REF_B.txt"), infer=True).first()["CODE"] == 100
    with pytest.raises(FileNotFoundError):
        files.read_lookup(spark, str(tmp_path / "REF_C.txt"))
    tables = files.read_all_lookups(spark, str(tmp_path), register=True)
    assert set(tables) == {"REF_A", "REF_B"} and spark.table("REF_B").first()["CODE"] == "0100"
    df = spark.createDataFrame([("01",), ("1",), (None,), ("zz",)], "CODE string")
    repeated = a.unionByName(a.withColumn("TEXT", F.upper("TEXT")))
    got = {r[0]: r[1] for r in files.enrich_lookup(df, repeated, "CODE").collect()}
    assert got == {"01": "ONE", "1": "UNO", None: None, "zz": None}


def test_warehouse(spark, tmp_path):
    name = "test_predictions"
    warehouse.create_table(spark, name, warehouse.PREDICTIONS_TABLE, ["claim_id"], "prediction_id", str(tmp_path / "table"))
    warehouse.create_table(spark, name, warehouse.PREDICTIONS_TABLE)
    spark.createDataFrame([(7, "12.345", "extra")], "claim_id int, predicted_amount string, other string").write.parquet(str(tmp_path / "in"))
    warehouse.copy_into(spark, name, str(tmp_path / "in"))
    row = spark.table(name).first()
    assert row["claim_id"] == 7 and str(row["predicted_amount"]) == "12.35" and row["prediction_id"] is None and row["prediction_date"] is not None
    out = str(tmp_path / "out")
    warehouse.unload_query(spark, f"SELECT claim_id FROM {name} WHERE model_version IS NULL OR model_version <> 'it''s'", out, "json", parallel=False)
    assert spark.read.json(out).first()[0] == 7
    with pytest.raises(Exception):
        warehouse.copy_into(spark, name, str(tmp_path / "nowhere"))
    spark.sql(f"DROP TABLE {name}")


def test_ragged_lines_raise(spark, tmp_path):
    schema = "A int, B int, C int"
    for name, line in (("short", "4|5"), ("long", "6|7|8|9")):
        (tmp_path / name).write_text(f"A|B|C\n1|2|3\n{line}\n")
        for wanted in (None, ["A"]):
            with pytest.raises(Exception):
                files.read_delimited(spark, str(tmp_path / name), schema, wanted).collect()
        with pytest.raises(Exception):
            files.read_delimited(spark, str(tmp_path / name)).collect()
    (tmp_path / "good").write_text("A|B|C\n1|NA|3\n4|5|\n")
    got = files.read_delimited(spark, str(tmp_path / "good"), schema)
    assert sorted(map(tuple, got.collect())) == [(1, None, 3), (4, 5, None)] and got.count() == 2


def test_incremental_ingest_takes_each_file_once(spark, tmp_path):
    landing, out, state = (str(tmp_path / d) for d in ("landing", "out", "state"))
    df = spark.createDataFrame([(1, "a"), (2, "b")], "i int, s string")
    for expected in (2, 4):
        df.write.mode("append").option("header", True).csv(landing)
        ingest.scan_partitions(spark, landing, out, state, df.schema, "csv", 1)
        ingest.scan_partitions(spark, landing, out, state, df.schema, "csv", 1)
        assert spark.read.parquet(out).count() == expected


def test_bad_lines_have_a_place_of_their_own(spark, tmp_path):
    landing, out, bad, state = (str(tmp_path / d) for d in ("landing", "out", "bad", "state"))
    schema = spark.createDataFrame([], "i int, v double, s string").schema
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "one.csv").write_text('i|v|s\n1|2.5|a\n2|NA|\n3|x|c\n4|1\n5|1|b|more\n6|1|"x|y"\n\n')
    ingest.scan_partitions(spark, landing, out, state, schema, rejected=bad, sep="|")
    assert sorted(map(tuple, spark.read.parquet(out).drop("batch").collect())) == [(1, 2.5, "a"), (2, None, None), (6, 1.0, "x|y")]
    want = {("3|x|c", "bad value: v"), ("4|1", "wrong number of fields"), ("5|1|b|more", "wrong number of fields")}
    assert {(r["line"], r["error"]) for r in spark.read.parquet(bad).collect()} == want
    with pytest.raises(Exception, match="bad value|wrong number"):
        ingest.scan_partitions(spark, landing, str(tmp_path / "out2"), str(tmp_path / "state2"), schema, sep="|")


def test_a_repeated_batch_writes_once(spark, tmp_path):
    """The first try of a batch dies after it has written; its second try replaces what it wrote."""
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "one").write_text("a\nb\n")
    out, tries = str(tmp_path / "out"), []

    def body(batch, n):
        tries.append(n)
        batch.write.mode("overwrite").parquet(f"{out}/batch={n}")
        if len(tries) == 1:
            raise RuntimeError("lost")

    for _ in range(2):
        stream = ingest.stream_files(spark, str(tmp_path / "landing"), "value string", "text")
        try:
            ingest.run_batches(stream, str(tmp_path / "state"), body)
        except Exception as error:
            assert "lost" in str(error)
    assert tries == [0, 0] and spark.read.parquet(out).count() == 2


def test_stream_score_follows_the_registry(spark, tmp_path):
    rows = spark.range(200).selectExpr("CAST(id AS double) AS AMT_BILLED", "CAST(id % 7 AS double) AS Age", "0.5 * id + 3 * (id % 7) AS y")
    registry = ModelRegistry(spark, str(tmp_path / "registry"))
    landing = tmp_path / "landing"
    landing.mkdir()
    args = [str(tmp_path / d) for d in ("landing", "scores", "state")]
    for version, alpha in (("7", 1e-9), ("8", 1e9)):
        registry.save(models.train_model("ridge", rows, rows, ["AMT_BILLED", "Age"], "y", {"alpha": alpha}, version), "paid")
    lines = [
        json.dumps({"request_id": "a", "amt_billed": 100.0, "age": 2}),
        json.dumps([{"request_id": "b", "amt_billed": 10, "age": 0}, {"request_id": "c", "amt_billed": "many"}]),
        json.dumps({"request_id": "d", "amt_billed": 0, "age": "x"}),
        "{broken", "[]",
    ]
    (landing / "one.json").write_text("\n".join(lines))
    with pytest.raises(Exception, match="no model is in production"):
        score.stream_score(spark, *args, registry)
    registry.promote("paid", "7")
    score.stream_score(spark, *args, registry)
    got = {r["request_id"]: r for r in spark.read.parquet(args[1]).filter("request_id IS NOT NULL").collect()}
    assert float(got["a"]["predicted_amount"]) == 56.0 and float(got["b"]["predicted_amount"]) == 5.0
    assert got["a"]["success"] and got["a"]["model_version"] == "7"
    assert float(got["a"]["confidence_interval"]["upper"]) == pytest.approx(72.46)
    assert got["c"]["error"] == "bad value: amt_billed" and got["c"]["predicted_amount"] is None
    assert got["d"]["error"] == "bad value: age"
    assert spark.read.parquet(args[1]).filter("error = 'not a JSON record'").count() == 2
    (landing / "two.json").write_text(json.dumps({"request_id": "e", "amt_billed": 1}))
    registry.promote("paid", "8")
    score.stream_score(spark, *args, registry)
    after = spark.read.parquet(args[1])
    assert after.count() == 7 and after.where("request_id = 'e'").first()["model_version"] == "8"


class StubSession:
    """Just what ``shared_folder`` looks at."""

    def __init__(self, master, named=None):
        self.master, self.named, self.folder = master, named, None
        self.conf, self.sparkContext = self, self

    def get(self, key, default=None):
        return self.named if key == "spark.checkpoint.dir" else default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_folder_follows_the_session(spark):
    assert scratch_path(spark, "x").startswith(shared_folder(spark))
    named = StubSession("spark://host", "s3a://bucket/shared/")
    assert shared_folder(named) == "s3a://bucket/shared" and named.folder == "s3a://bucket/shared/"
    with pytest.raises(RuntimeError):
        shared_folder(StubSession("spark://host"))
    local = StubSession("local[2]")
    assert shared_folder(local) == shared_folder(local) == local.folder


def test_fields_that_do_not_parse(spark, tmp_path):
    path = tmp_path / "bad.txt"
    path.write_text("CLAIM_ID_KEY|SV_STAT|AMT_PAID\n1|NA|NULL\n2|P|1,200.00\n")
    schema = files.claims_schema(files.header_of(spark, str(path)))
    df = files.read_delimited(spark, str(path), schema)
    assert df.filter("SV_STAT IS NULL").count() == 1
    with pytest.raises(Exception, match="cannot read as double: 1,200.00"):
        df.collect()
    assert files.read_delimited(spark, str(path), schema, ["CLAIM_ID_KEY"]).count() == 2
    text = files.read_delimited(spark, str(path))
    assert [tuple(r) for r in text.collect()] == [("1", None, None), ("2", "P", "1,200.00")]
    with pytest.raises(Exception, match="MALFORMED"):
        files.read_object_store(spark, str(path), "csv", schema, sep="|").collect()


def test_trees_deeper_than_possible(spark):
    df = spark.createDataFrame([(float(i), float(i)) for i in range(50)], "x double, y double")
    with pytest.raises(ValueError, match="max_depth 50"):
        models.train_model("gradient_boosting", df, df, ["x"], "y", {"n_estimators": 1, "max_depth": 50})
    deep = models.train_model("random_forest", df, df, ["x"], "y", {"n_estimators": 1, "max_depth": 50, "bootstrap": False})
    assert deep.scores["train"]["r2"] == 1


def test_lines_are_parsed_once_for_each_side(spark):
    from claimwright.streaming.ingest import parse_lines

    lines = spark.createDataFrame([("1|2.5",), ("x|1",), ("1",), (None,), ("",)], "value string")
    rows = parse_lines(lines, T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType())]), "|")
    good, bad = rows.where("error IS NULL").drop("line", "error"), rows.where("error IS NOT NULL").select("line", "error")
    assert [tuple(r) for r in good.where("a is not null").collect()] == [(1, 2.5)]
    assert {("x|1", "bad value: a"), ("1", "wrong number of fields")} <= {tuple(r) for r in bad.collect()}
    assert rows.count() == 5
    for side in (good, bad):
        assert side._jdf.queryExecution().optimizedPlan().toString().count("from_csv") == 1
