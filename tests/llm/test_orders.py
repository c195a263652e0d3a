"""The join on shared prefixes deals one order at a time, so only one order's groups are on the disks."""
from tidemark.llm import jaccard


def test_orders_are_met_one_by_one(spark, monkeypatch):
    labels, written = [], jaccard.written
    monkeypatch.setattr(jaccard, "written", lambda df, label: labels.append(
        label) or written(df, label))
    base = [f"w{k}" for k in range(40)]
    texts = [" ".join(base), " ".join([*base[:-1], "x"]), " ".join(f"v{k}" for k in range(40)), None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(docs, 3, 90).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 3}
    assert labels.count("met-one") == jaccard.ORDERS
