import pytest
from pyspark.sql import functions as F

from vetmill.operators import normalize
from vetmill.operators.sync import export_records, with_hashes
from vetmill.streaming import commits, keyed
from vetmill.streaming import sync as stream

APP = "id long, appointmentTypeId long, patientId long, startsAt string, updatedAt string, canceledAt string, status string, isConfirmed boolean"


def feed(spark, rows):
    return normalize.normalize_appointments(spark.createDataFrame([(i, 1, 2, "2024-01-01", at, None, status, None) for i, at, status in rows], APP))


class Crash(Exception):
    pass


@pytest.mark.parametrize("point", ["_write_data", "_write_manifest", "_rename", "after"])
@pytest.mark.parametrize("late", [False, True])
def test_a_crash_at_any_point_leaves_the_same_sink(spark, tmp_path, monkeypatch, point, late):
    sink, first, second = str(tmp_path / "sink"), [(1, "2024-01-01", "a"), (2, "2024-01-03", "a")], [(1, "2024-01-01", "a"), (2, "2024-01-03", "a"), (3, "2024-01-05", "b")]
    assert commits.state(spark, sink) == {}
    assert commits.sync_committed(feed(spark, first), "appointments", sink, "run1")
    before = commits.manifests(spark, sink).collect()
    real = getattr(commits, point, None)

    def crash(*args):
        if late and real:
            real(*args)
        raise Crash

    with monkeypatch.context() as m:
        if point == "after":
            commits.sync_committed(feed(spark, second), "appointments", sink, "run2")
        else:
            m.setattr(commits, point, crash)
            with pytest.raises(Crash):
                commits.sync_committed(feed(spark, second), "appointments", sink, "run2")
            if not (point == "_rename" and late):  # readers see nothing of the half batch
                assert commits.manifests(spark, sink).collect() == before and commits.state(spark, sink) == {"appointments": "2024-01-03"}
    commits.sync_committed(feed(spark, second), "appointments", sink, "run2")
    schema = "source_id string, idempotency_key string"
    got = commits.read(spark, sink, schema)
    assert sorted(r.source_id for r in got.collect()) == ["1", "2", "2", "3"] and got.distinct().count() == 4
    assert commits.state(spark, sink) == {"appointments": "2024-01-05"}
    assert not commits.sync_committed(feed(spark, second), "appointments", sink, "run2") and commits.read(spark, sink, schema).count() == 4


def test_nothing_committed(spark, tmp_path):
    assert commits.read(spark, str(tmp_path), "x int").count() == 0
    assert commits.append(spark.createDataFrame([], "x int"), str(tmp_path), "empty", "f", "2024") and commits.state(spark, str(tmp_path)) == {"f": "2024"}


def test_keyed_stream_over_three_runs(spark, tmp_path):
    landed, sink = str(tmp_path / "landed"), str(tmp_path / "sink")
    runs = [[(1, "2024-05-01", "a"), (2, "2024-05-01", "a"), (1, "2024-05-01", "a")], [(1, "2024-05-01", "a"), (2, "2024-05-02", "changed"), (3, "2019-01-01", "late")], [(4, "2024-05-03", "a")]]
    for rows, want in zip(runs, (2, 3, 4)):
        spark.createDataFrame([(i, 1, 2, "2024-01-01", at, None, status, None) for i, at, status in rows], APP).coalesce(1).write.mode("append").parquet(landed)
        keyed.sync_keyed(stream.read_landed(spark, landed, APP), normalize.normalize_appointments, "appointments", sink, str(tmp_path / "state")).awaitTermination()
        got = commits.read(spark, sink, "source_id string, idempotency_key string, payload struct<updated_at:string>")
        assert got.count() == want == got.select("idempotency_key").distinct().count()
    assert {r.source_id: r.payload.updated_at for r in got.collect()} == {"1": "2024-05-01", "2": "2024-05-01", "3": "2019-01-01", "4": "2024-05-03"}
    assert sorted(r.n_rows for r in commits.manifests(spark, sink).collect()) == [1, 1, 2]


def test_keyed_stream_takes_the_least_hash_and_no_python(spark, tmp_path):
    """Keys whose content differs within a batch, spread over files; the records of a stream without `keep` stay in the JVM."""
    landed, sink = str(tmp_path / "landed"), str(tmp_path / "sink")
    make = lambda df: df.selectExpr("id", "1L AS appointmentTypeId", "2L AS patientId", "'2024-01-01' AS startsAt", "'2024-05-0' || (id % 5 + n % 4 + 1) AS updatedAt", "CAST(NULL AS STRING) AS canceledAt", "'a' AS status", "n % 2 = 0 AS isConfirmed")
    df = make(spark.range(6000).selectExpr("id % 300 + 1 AS id", "id DIV 300 AS n").repartition(7))
    df.write.parquet(landed)
    records = export_records(with_hashes(normalize.normalize_appointments(df), "appointments"), "appointments", None)
    want = {r.idempotency_key: r.hash for r in records.groupBy("idempotency_key").agg(F.min("payload.source_hash").alias("hash")).collect()}
    assert records.select("idempotency_key", "payload.source_hash").distinct().count() > len(want) == 300
    check = spark.conf.get("spark.sql.streaming.unsupportedOperationCheck")
    for _ in range(2):
        stream_ = stream.read_landed(spark, landed, APP)
        keyed.sync_keyed(stream_, normalize.normalize_appointments, "appointments", sink, str(tmp_path / "state")).awaitTermination()
        got = commits.read(spark, sink, records.schema)
        assert got.count() == 300 and {r.idempotency_key: r.payload.source_hash for r in got.collect()} == want
        df.where("id < 50").withColumn("startsAt", F.lit("0")).write.mode("append").parquet(landed)
    assert spark.conf.get("spark.sql.streaming.unsupportedOperationCheck") == check
    plan = keyed.first_of_each_key(export_records(with_hashes(normalize.normalize_appointments(stream.read_landed(spark, landed, APP)), "appointments"), "appointments", None))
    assert "Pandas" not in plan._jdf.queryExecution().logical().toString()
