from churnloom.llm import decontamination


def test_what_is_broadcast_has_the_rows_that_were_counted(spark, make, monkeypatch):
    seen, plain = [], decontamination._bounded

    def bounded(df, rows):
        seen.append((df.count(), rows))
        return plain(df, rows)

    monkeypatch.setattr(decontamination, "_bounded", bounded)
    items = spark.createDataFrame([("a", "one two three four"), ("b", "never seen words"), ("c", "nor these ones")], "item_id string, text string")
    got = decontamination.contamination(make([(1, "zero one two three four five"), (2, "else")]), items)
    assert {r.doc_id: r.contaminated for r in got.collect()} == {1: True, 2: False}
    assert seen and all(n <= rows for n, rows in seen)
