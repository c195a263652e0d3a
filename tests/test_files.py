"""Queries that drop files write them from many tasks, and come to the same result over many files."""
import pytest

from tests.oracle import compare, connect
from tidemark.plans import queries_tables as tables
from tidemark.plans.catalogue import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name, rows", [("k8_drop_scan", 1000), ("k11_delivery_gate", 600)])
def test_a_large_drop_comes_in_several_files(spark, monkeypatch, name, rows):
    sent = []
    drop_files = tables.drop_files
    monkeypatch.setattr(tables, "FILE_ROWS", rows)
    monkeypatch.setattr(tables, "drop_files", lambda *a, **k: sent.append(drop_files(*a, **k)) or sent[-1])
    assert compare(connect(SF), QUERIES[name](spark, SF), ORACLES[name]) == ""
    assert all(len(paths) > 1 for paths in sent)


@pytest.mark.parametrize("name", ["k5_stream_replay_dedup", "k6_stream_bars"])
def test_a_pass_is_written_by_all_tasks_that_read(spark, monkeypatch, name):
    drops, stream = [], tables.I.file_stream
    monkeypatch.setattr(tables.I, "file_stream", lambda s, path, schema: drops.append(
        len(spark.read.parquet(path).inputFiles())) or stream(s, path, schema))
    monkeypatch.setattr(tables.S, "table", lambda s, sf, t, read=tables.S.table: read(s, sf, t).repartition(3))
    assert compare(connect(SF), QUERIES[name](spark, SF), ORACLES[name]) == ""
    assert drops[0] >= 3
