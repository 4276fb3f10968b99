"""A second run over known texts scans the new ones only and moves no known text."""

from churnloom.llm import secret_ledger
from churnloom.session import scratch


def test_known_texts_are_not_scanned_again(spark, monkeypatch):
    texts = [(i, f"text {i} password=abcdefgh{i} " + f"filler{i} " * 400) for i in range(300)]
    docs = spark.createDataFrame(texts, "path bigint, text string")
    ledger = secret_ledger.Ledger(spark, scratch(spark, "ledger"))
    ledger.scan(docs)
    more = docs.unionByName(spark.createDataFrame([(900, "token=zzzzzzzz9"), (901, texts[0][1])], docs.schema))
    moved = []
    plain = secret_ledger.likely
    monkeypatch.setattr(secret_ledger, "likely", lambda *a: moved.append(plain(*a)) or moved[-1])
    ledger.scan(more)
    assert len(moved) == 1 and {r.path for r in moved[0].collect()} <= {900}
    assert ledger.scanned().select("run").distinct().count() == 2
    runs = {r.run: r.n for r in ledger.scanned().groupBy("run").count().withColumnRenamed("count", "n").collect()}
    assert sorted(runs.values()) == [len(secret_ledger.BASE), 300 * len(secret_ledger.BASE)]
    found = {r.path: r.n_assign for r in ledger.paths(ledger.versions().distinct()).collect()}
    assert len(found) == 302 and all(n == 1 for n in found.values())
