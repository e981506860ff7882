"""Committed batches: torn, repeated and foreign attempts."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from riskweave.schema import SENSOR_SCHEMA
from riskweave.sources import commits
from riskweave.streaming import ingest

PLAIN = T.StructType([T.StructField("batch", T.LongType()), T.StructField("word", T.StringType())])


def rows(spark, *values):
    return spark.createDataFrame(values, PLAIN)


def read(spark, table):
    found = commits.read_committed(spark, table, PLAIN)
    assert found.columns == ["batch", "word"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_a_batch_counts_once_and_keeps_a_column_called_batch(spark, tmp_path):
    table = str(tmp_path / "t")
    assert read(spark, table) == []
    assert commits.commit(rows(spark, (7, "a"), (None, "b")), table, 0)
    assert not commits.commit(rows(spark, (9, "other")), table, 0)
    assert commits.commit(rows(spark, (8, "c")), table, 1)
    assert commits.commit(rows(spark), table, 2)
    assert commits.commit(rows(spark, (1, "d")), table, 0, writer="another")
    assert read(spark, table) == [(1, "d"), (7, "a"), (8, "c"), (None, "b")]
    known = {(r["writer"], r["batch"]): r["rows"] for r in commits.manifests(spark, table).collect()}
    assert known == {("once", 0): 2, ("once", 1): 1, ("once", 2): 0, ("another", 0): 1}
    assert commits.damaged_batches(spark, table) == []


def test_an_attempt_without_manifest_is_not_seen_and_is_replaced(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    commits.commit(rows(spark, (1, "a")), table, 0)

    def killed(*_):
        raise RuntimeError("killed between data and manifest")

    with monkeypatch.context() as patch:
        patch.setattr(commits, "publish", killed)
        with pytest.raises(RuntimeError, match="killed"):
            commits.commit(rows(spark, (2, "torn")), table, 1)
    assert read(spark, table) == [(1, "a")]
    assert len(list((tmp_path / "t").glob("batch=once-1-*"))) == 1
    assert commits.commit(rows(spark, (2, "whole")), table, 1)
    assert read(spark, table) == [(1, "a"), (2, "whole")]
    assert len(list((tmp_path / "t").glob("batch=once-1-*"))) == 1


def test_a_manifest_is_never_replaced(spark, tmp_path):
    commits.publish(spark, str(tmp_path / "m.json"), "first")
    with pytest.raises(Exception, match="(?i)exist"):
        commits.publish(spark, str(tmp_path / "m.json"), "second")
    assert (tmp_path / "m.json").read_text() == "first"


def test_damage_is_found(spark, tmp_path):
    table = str(tmp_path / "t")
    commits.commit(rows(spark, (1, "a")), table, 0)
    commits.commit(rows(spark, (2, "b")), table, 1)
    lost = next((tmp_path / "t").glob("batch=once-1-*/part-*.parquet"))
    lost.unlink()
    assert commits.damaged_batches(spark, table) == [lost.parent.name]


def test_a_killed_ingest_resumes_without_loss_or_repeat(spark, tmp_path, monkeypatch):
    """Killed between data and manifest, then between manifest and the stream's own commit."""
    source, table, check = tmp_path / "in", str(tmp_path / "out"), tmp_path / "check"
    source.mkdir()

    def run(name="check"):
        ingest.start_csv_ingest(spark, str(source), table, str(tmp_path / name)).awaitTermination()
        found = commits.read_committed(spark, table, SENSOR_SCHEMA)
        return sorted(r["device_id"] for r in found.collect())

    (source / "1.csv").write_text("device_id,ts,value\n1,a,0.5\n")

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(commits, "publish", killed)
        with pytest.raises(Exception, match="killed"):
            run()
    assert run() == [1]
    (source / "2.csv").write_text("device_id,ts,value\n2,a,0.5\n")
    assert run() == [1, 2]
    last = max(int(p.name) for p in (check / "commits").glob("[0-9]*"))
    for name in (str(last), f".{last}.crc"):
        (check / "commits" / name).unlink(missing_ok=True)
    assert run() == [1, 2]  # Spark repeats its last batch under the same id
    assert run("check-of-another-stream") == [1, 1, 2, 2]  # new batches, not taken for the old
