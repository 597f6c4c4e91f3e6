"""Sources, snapshot tables, quality, jobs and settings."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from silverbrook.config import PipelineConfig, Settings
from silverbrook.errors import ConfigError, QualityError, SchemaError, SilverbrookError, SinkError, SourceError
from silverbrook.plans.declared import declared_checks, declared_pipeline
from silverbrook.plans.jobs import Job, Metrics, chain
from silverbrook.quality import report as R
from silverbrook.quality.checks import WARNING, Checks, summary
from silverbrook.quality.expectations import SuiteFolder, run_expectations
from silverbrook.quality.schema_diff import require_schema, schema_diff
from silverbrook.sales.jobs import GOLD, gold_job, ingest_customers, ingest_orders, quality_job
from silverbrook.sources import files as S, tables as T
from silverbrook.sources.jdbc import Jdbc, upsert_sql
from silverbrook.streaming.kafka import Kafka, decode, shape, start


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_csv_corrupt_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n1,2\nx,3\n")
    df = S.Csv(str(tmp_path / "a.csv"), "id int, v int, _corrupt_record string").read(spark)
    assert sorted((r.id, r._corrupt_record) for r in df.cache().collect() if r.id) == [(1, None)]
    assert df.where("_corrupt_record is not null").count() == 1
    with pytest.raises(ValueError):
        S.Csv().read(spark)
    info = S.Csv(str(tmp_path / "a.csv")).describe(spark)
    assert info["columns"] == ["id", "v"] and info["row_count"] == 2


def test_flatten_keeps_arrays(spark):
    df = spark.createDataFrame([((1, ("x",)), [1, 2])], "a struct<b:int,c:struct<d:string>>, l array<int>")
    assert rows(S.flatten(df)) == [(1, "x", [1, 2])] and S.flatten(df).columns == ["a_b", "a_c_d", "l"]


def test_sinks(spark, tmp_path):
    df = spark.range(10).withColumn("k", F.col("id") % 2)
    path = S.ParquetSink(str(tmp_path / "p"), partition_by=("k",)).write(df)
    assert spark.read.parquet(path).where("k = 1").count() == 5
    with pytest.raises(Exception, match="(?i)exist"):
        S.ParquetSink(path).write(df)
    with pytest.raises(SinkError):
        S.ParquetSink(path, mode="upsert").write(df)
    assert S.CsvSink(str(tmp_path / "c"), single_file=True).write(df) and len(list((tmp_path / "c").glob("*.csv"))) == 1


def test_merges_and_changes(spark, tmp_path):
    path, kind = str(tmp_path / "people"), "customer_id string, name string, score int"
    people = spark.createDataFrame([("c1", "Ann", 80), ("c2", "Bob", 70), ("c3", "Cid", 60)], kind)
    T.merge_into(path, people, ["customer_id"])
    T.merge_into(path, spark.createDataFrame([("c2", "Rob", 75), ("c4", "Dee", 90)], kind), ["customer_id"])
    now = spark.read.parquet(path)
    assert rows(now) == [("c1", "Ann", 80), ("c2", "Rob", 75), ("c3", "Cid", 60), ("c4", "Dee", 90)]
    assert {(r.customer_id, r._change_type) for r in T.changes(people, now, ["customer_id"]).collect()} == {("c2", "update_preimage"), ("c2", "update_postimage"), ("c4", "insert")}
    assert sorted(r._change_type for r in T.changes(people.unionByName(people), people).collect()) == ["delete"] * 3
    # insert only, conditional delete, null keys and unknown conditions, new columns, duplicates in the source
    more = T.merged(now, spark.createDataFrame([("c1", "No", 0), ("c5", "Eve", 1), (None, "Nil", 2)], kind), ["customer_id"], [T.When("insert")])
    assert ("c1", "Ann", 80) in [tuple(r) for r in more.collect()] and more.count() == 6
    less = T.merged(more, spark.createDataFrame([("c5", "x", 0), ("c1", "x", None)], kind), ["customer_id"], [T.When("delete", "t.score < 10"), T.When("update", "s.score > 0")])
    assert {r.customer_id: r.score for r in less.collect()} == {"c1": 80, "c2": 75, "c3": 60, "c4": 90, None: 2}
    wide = T.merged(now, spark.createDataFrame([("c1", True)], "customer_id string, vip boolean"), ["customer_id"], [T.When("update")])
    assert {(r.customer_id, r.name, r.vip) for r in wide.collect()} == {("c1", "Ann", True), ("c2", "Rob", None), ("c3", "Cid", None), ("c4", "Dee", None)}
    by = T.merged(now, people.where("score = 80"), condition="t.score > s.score", clauses=[T.When("update", set={"name": "s.name"})])
    assert {r.name for r in by.collect()} == {"Ann", "Rob", "Cid"} and by.count() == 4
    for bad in (lambda: T.merged(now, people.unionByName(people), ["customer_id"]), lambda: T.merged(now, people, condition="t.score > s.score"), lambda: T.merged(now, people)):
        with pytest.raises(SinkError):
            bad()
    T.replace(T.deleted(T.updated(spark.read.parquet(path), {"score": "score + 1"}, "name = 'Ann'"), "score > 85"), path)
    assert rows(spark.read.parquet(path).select("customer_id", "score")) == [("c1", 81), ("c2", 75), ("c3", 60)]


def test_replacing_partitions_and_compacting(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, k string").write.partitionBy("k").parquet(path)
    before = {f: f.stat().st_mtime_ns for f in tmp_path.rglob("k=b/*.parquet")}
    T.replace(spark.read.parquet(path).where("k = 'a'").selectExpr("id + 10 as id", "k"), path, ["k"])
    assert before == {f: f.stat().st_mtime_ns for f in tmp_path.rglob("k=b/*.parquet")}
    assert rows(spark.read.parquet(path), "id") == [(2, "b"), (11, "a")]
    spark.range(5000).repartition(9).write.parquet(str(tmp_path / "many"))
    assert T.compact(spark, str(tmp_path / "many"), str(tmp_path / "few"), ["id"], 20_000) == len(list((tmp_path / "few").glob("*.parquet"))) < 9
    assert spark.read.parquet(str(tmp_path / "few")).count() == 5000


def test_jdbc(spark):
    db = Jdbc("jdbc:derby:memory:unit;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver")
    db.execute(spark, "CREATE TABLE scores (id INT PRIMARY KEY, v INT)")
    db.execute(spark, "INSERT INTO scores VALUES (1, 10), (2, 20)")
    news = spark.createDataFrame([(2, 21), (3, 30)], "ID int, V int")
    news.write.format("jdbc").options(url=db.url, driver=db.driver, dbtable="stage", quoteIdentifiers="false").mode("overwrite").save()
    assert "ON CONFLICT (id) DO UPDATE SET v = EXCLUDED.v" in upsert_sql("s.scores", "s.stage_scores", ["id", "v"], ["id"])
    db.execute(spark, upsert_sql("scores", "stage", ['"ID"', '"V"'], ['"ID"'], dialect="merge"))
    assert rows(db.read(spark, "scores")) == [(1, 10), (2, 21), (3, 30)]
    assert rows(db.query(spark, "SELECT max(v) AS m FROM scores")) == [(30,)]
    with pytest.raises(SinkError):
        upsert_sql("t", "s", ["a"], [])


def test_database_in_the_driver_of_a_cluster(spark, monkeypatch):
    """Executors have other processes: no task may touch the database."""
    import datetime as dt
    from decimal import Decimal

    monkeypatch.setattr(Jdbc, "_through_driver", lambda self, spark: True)
    db = Jdbc("jdbc:derby:memory:apart;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver", batch_size=2, fetch_size=3)
    kinds = "id int, Name string, price decimal(9,2), at timestamp, day date, ok boolean, x double"
    given = [(i, None if i == 3 else f"n'{i}", Decimal("1.25") * i, dt.datetime(2024, 1, i, 3, 4, 5, 678000), dt.date(2024, 2, i), i % 2 == 0, i / 3) for i in range(1, 8)]
    df = spark.createDataFrame(given, kinds)
    db.write(df, "things", "overwrite")
    db.write(df.limit(0), "things")
    assert rows(db.read(spark, "things"), "id") == given
    assert rows(db.query(spark, 'SELECT max("price") AS m FROM things')) == [(Decimal("8.75"),)]
    assert db.query(spark, 'SELECT "id" FROM things WHERE "id" > 90').collect() == []
    db.write(df, "things", "ignore")
    assert db.read(spark, "things").count() == 7
    db.write(df.where("id < 3"), "things", "overwrite", truncate=True)
    assert db.read(spark, "things").count() == 2


def test_jdbc_on_a_cluster(tmp_path, data):
    """The four queries with executors in processes of their own."""
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    code = f"""
import sys
sys.path.insert(0, {str(root)!r})
from silverbrook import catalog
from silverbrook.catalog.compare import connect, differences
from silverbrook.catalog.tables import Tables
from silverbrook.session import session
spark = session("cluster", "local-cluster[1,2,1024]", {{"spark.executor.memory": "1g", "spark.ui.enabled": "false", "spark.checkpoint.dir": {str(tmp_path / "shared")!r}}})
data = {data!r}
for name in ("K2_ingest_orders", "S11_W14_jdbc", "S12_jdbc_query", "W15_jdbc_upsert"):
    query, sql = catalog.ENTRIES[name]
    assert differences(query(Tables(spark, data)), connect(data), sql) == [], name
spark.stop()
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=240)
    assert done.returncode == 0, done.stderr[-2000:]


def test_kafka_records(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, s string")
    records = df.transform(shape("id"))
    assert rows(records)[0] == ("1", '{"id":1,"s":"a"}')
    assert rows(records.transform(decode("id int, s string")).select("id", "s")) == [(1, "a"), (2, None)]
    assert rows(records.transform(shape())) == rows(records)
    with pytest.raises(ValueError):
        Kafka("h:1", "t", starting_offsets="latest")._options(False)
    assert Kafka("h:1", "t")._options(True)["startingOffsets"] == "latest"
    whole = Kafka("h:1,h:2", "t", group="g", starting_offsets="earliest", max_per_trigger=50, options={"failOnDataLoss": "false"})
    common = {"kafka.bootstrap.servers": "h:1,h:2", "subscribe": "t", "startingOffsets": "earliest", "kafka.group.id": "g", "failOnDataLoss": "false"}
    assert whole._options(False) == common and whole._options(True) == common | {"maxOffsetsPerTrigger": "50"}
    with pytest.raises(ValueError):
        start(None, "x", "sometimes")


class _Asked:
    """Stands for a reader or writer and keeps what it was asked."""

    def __init__(self) -> None:
        self.asked: dict = {}

    def __getattr__(self, name: str):
        def take(*args, **named):
            self.asked[args[0] if name == "option" else name] = args[1] if name == "option" else named or args
            return self

        return take


def test_kafka_connector_is_asked_for_what_it_needs(monkeypatch):
    """The connector isn't here; what it gets is."""
    from types import SimpleNamespace

    kafka = Kafka("h:1", "t", max_per_trigger=9)
    for method, side in (("read", "read"), ("read_stream", "readStream")):
        reader = _Asked()
        getattr(kafka, method)(SimpleNamespace(**{side: reader}))
        assert reader.asked["format"] == ("kafka",) and reader.asked["options"] == kafka._options(side == "readStream")
    for method, args, expected in (("write", (), {"save": ()}), ("write_stream", ("/c", None, "update", "1 minute"), {"outputMode": ("update",), "checkpointLocation": "/c", "trigger": {"processingTime": "1 minute"}, "start": ()})):
        writer = _Asked()
        frame = SimpleNamespace(write=writer, writeStream=writer)
        frame.transform = lambda _, frame=frame: frame
        getattr(kafka, method)(frame, *args)
        assert writer.asked == {"format": ("kafka",), "kafka.bootstrap.servers": "h:1", "topic": "t", **expected}


def test_checks(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (2, None, -1.0), (2, "z", None)], "id int, s string, v double")
    checks = Checks().not_null("s").unique("id").in_set("s", ["a", "b"]).in_range("v", 0).row_count(3).custom("boom", lambda d: 1 / 0).not_null("nope", severity=WARNING)
    out = {r.check_name: r for r in checks.run(df)}
    assert not out["not_null_s"].passed and out["not_null_s"].invalid == 1
    assert not out["unique_id"].passed and not out["in_set_s"].passed and not out["in_range_v"].passed and out["row_count"].passed
    assert "ZeroDivisionError" in out["boom"].error and "nope" in out["not_null_nope"].error
    # nulls pass sets and ranges
    assert Checks().in_set("s", ["a", "z"]).in_range("v", -5).run(df)[0].passed
    with pytest.raises(QualityError):
        checks.run(df, fail=True)
    assert Checks().not_null("s", severity=WARNING).run(df, fail=True)[0].passed is False
    assert summary(Checks().run(df))["score"] == 1.0


def test_expectations(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 5.0), (2, None, -1.0)], "id long, s string, v double")
    kinds = [
        ("expect_column_to_exist", {"column": "id"}, True),
        ("expect_column_to_exist", {"column": "x"}, False),
        ("expect_column_values_to_not_be_null", {"column": "s", "mostly": 0.5}, True),
        ("expect_column_values_to_be_in_set", {"column": "s", "value_set": ["a"]}, False),
        ("expect_column_values_to_be_between", {"column": "v", "min_value": -1, "max_value": 5}, True),
        ("expect_column_values_to_match_regex", {"column": "s", "regex": "^a$", "mostly": 0.5}, True),
        ("expect_column_mean_to_be_between", {"column": "v", "min_value": 3}, False),
        ("expect_column_values_to_be_of_type", {"column": "id", "type_": "int"}, True),
        ("expect_column_values_to_be_unique", {"column": "y"}, False),
        ("expect_nonsense", {}, False),
    ]
    found = run_expectations(df, [{"expectation_type": k, "kwargs": a} for k, a, _ in kinds])
    assert [o.success for o in found.outcomes] == [ok for _, _, ok in kinds]
    assert found.outcomes[4].details["observed_min"] == -1.0 and found.success_rate == 0.5
    assert all(o.success for o in run_expectations(df.limit(0), [{"expectation_type": kinds[3][0], "kwargs": kinds[3][1]}]).outcomes)
    suites = SuiteFolder(tmp_path)
    suites.create("orders", [{"expectation_type": "expect_column_to_exist", "kwargs": {"column": "id"}}])
    assert suites.names() == ["orders"] and suites.run(df, "orders", tmp_path / "out.json").success and (tmp_path / "out.json").exists()


def test_schema_diff(spark):
    df = spark.createDataFrame([(1, "a")], "id int, s string")
    want = StructType([StructField("id", LongType()), StructField("t", StringType())])
    d = schema_diff(df, want)
    assert (d.missing, d.extra, list(d.types), d.valid) == (["t"], ["s"], ["id"], False)
    with pytest.raises(SchemaError):
        require_schema(df, want)
    assert require_schema(df, StructType([StructField("id", IntegerType())])) is df
    assert not schema_diff(df, StructType([StructField("id", IntegerType())]), strict=True).valid


def test_report(spark, tmp_path):
    df = spark.createDataFrame([("a@b.co", 10.0, 2, 5.0), ("bad", 9.0, 2, 5.0), (None, -1.0, 1, None)], "email string, total double, n int, price double")
    out = {r.check_name: r for r in R.evaluate(df, [R.emails("email"), R.numbers("total", 0), R.consistent("total", "n * price"), *R.completeness(["email", "zip"]), *R.uniqueness("n", ["n", "total"])])}
    assert out["email_email"].score == 0.5 and not out["email_email"].passed
    assert out["consistency_total"].total == 2 and out["consistency_total"].valid == 1
    assert out["completeness_zip"].score == 0.0 and not out["uniqueness_n"].passed and out["uniqueness_n_total"].passed
    assert all(r.passed for r in R.evaluate(df.limit(0), [R.emails("email")]))
    with pytest.raises(ValueError, match="keys"):
        R.apply_rules(df, [R.Rule("keys", "not_null", "email", severity="critical")])
    found = quality_job(spark, {"t": df}, {"t": [R.emails("email")], "absent": []}, str(tmp_path / "report"))
    assert list(found) == ["t"] and spark.read.parquet(str(tmp_path / "report")).first().table_name == "t"
    with pytest.raises(ValueError):
        quality_job(spark, {"t": df}, {"t": [R.emails("email")]}, least=0.9)


def test_jobs(spark, tmp_path, data):
    metrics, seen = Metrics(), []
    metrics.listeners.append(lambda r: seen.append(r.status))
    sink = lambda name, df: df.write.mode("overwrite").parquet(str(tmp_path / name))
    job = Job("j", lambda s: {"input": s.range(5)}, chain(lambda d: d.where("id > 1")), sink, {"output": Checks().not_null("id")})
    run = job.run(spark, metrics)
    assert run.rows == {"output": 3} and run.to_dict()["records_processed"] == 3 and seen == ["success"]
    bad = Job("k", lambda s: {"input": s.range(5)}, chain(), sink, {"output": Checks().row_count(9)})
    with pytest.raises(QualityError):
        bad.run(spark, metrics)
    with pytest.raises(SilverbrookError):
        Job("l", lambda s: {}, chain(), sink).run(spark, metrics)
    assert metrics.totals() == {("j", "success"): 1, ("k", "failed"): 1, ("l", "failed"): 1}


def test_sales_jobs(spark, tmp_path, data):
    from silverbrook.catalog.sales import enriched
    from silverbrook.catalog.tables import Tables

    db = Jdbc("jdbc:derby:memory:sales;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver")
    db.write(spark.createDataFrame([("o1", 2), ("o2", 3)], "order_id string, quantity int"), "orders", "overwrite")
    assert ingest_orders(db, "orders", str(tmp_path / "bronze")).run(spark, Metrics()).rows == {"orders": 2}
    (tmp_path / "c.csv").write_text("customer_id,email,first_name,last_name,registration_date,is_active,gender,country\n1,a@b.co,A,B,2020-01-01,yes,F,fr\n")
    assert ingest_customers(S.Csv(str(tmp_path / "c.csv"), infer_schema=False), S.ParquetSink(str(tmp_path / "cust"))).run(spark, Metrics()).rows == {"customers": 1}
    enriched(Tables(spark, data)).write.parquet(str(tmp_path / "silver"))
    run = gold_job(str(tmp_path / "silver"), str(tmp_path / "gold")).run(spark, Metrics())
    assert set(run.rows) == set(GOLD) and run.rows["best_products"] == 100


def test_settings(tmp_path):
    folder = tmp_path / "sales"
    folder.mkdir()
    (folder / "dev.yaml").write_text("input:\n  path: ${ROOT}/in\n  n: 3\ntransformations:\n  - {op: trim}\n  - {op: high_value, threshold: 100}\nquality:\n  - {check: not_null, columns: [id]}\n")
    config = PipelineConfig.load(tmp_path, "sales", "dev", {"ROOT": "/data"})
    assert config.get("input.path") == "/data/in" and config.get("input.x", 7) == 7 and config.require("input.n") == 3
    assert len(declared_pipeline(config.get("transformations"))) == 2 and len(declared_checks(config.get("quality")).checks) == 1
    for bad in (lambda: config.require("no"), lambda: PipelineConfig.load(tmp_path, "sales", "prod"), lambda: PipelineConfig.load(tmp_path, "sales", "dev", {}), lambda: declared_pipeline([{"op": "nope"}]), lambda: Settings(environment="moon")):
        with pytest.raises(ConfigError):
            bad()
    assert Settings.from_environment({"SILVERBROOK_ENVIRONMENT": "prod", "SILVERBROOK_SHUFFLE_PARTITIONS": "9"}).shuffle_partitions == 9
