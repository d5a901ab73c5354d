import pytest

from checks import usage


def test_reconcile_stream_reads_files_written_in_parallel(spark, monkeypatch):
    side = spark.range(0, 8, 1, 4).selectExpr("current_timestamp() AS timestamp", "string(id) AS span_id")
    parts = []

    def stop(_, df):
        parts.append(df.rdd.getNumPartitions())
        raise InterruptedError

    monkeypatch.setattr(usage, "_two_sides", lambda *_: [side, side])
    monkeypatch.setattr(usage, "_fact_files", stop)
    with pytest.raises(InterruptedError):
        usage.reconcile_stream(spark, "")
    assert parts[0] >= 4


def test_reconcile_stream_keeps_its_state_on_disk(spark, monkeypatch):
    side = spark.range(2).selectExpr("current_timestamp() AS timestamp", "string(id) AS span_id")
    stores = []

    def stop(_, session):
        stores.append(session.conf.get("spark.sql.streaming.stateStore.providerClass"))
        raise InterruptedError

    monkeypatch.setattr(usage, "_two_sides", lambda *_: [side, side])
    monkeypatch.setattr(usage.jobs, "reconcile_stream", lambda *_: None)
    monkeypatch.setattr(usage, "_collected", stop)
    with pytest.raises(InterruptedError):
        usage.reconcile_stream(spark, "")
    assert "RocksDB" in stores[0] and "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
