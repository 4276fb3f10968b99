from churnloom.llm import queries


def test_query_shuffles_whole_documents(spark, monkeypatch):
    seen, plain = [], queries.stored
    monkeypatch.setattr(queries, "stored", lambda df, name: seen.append(plain(df, name)) or seen[-1])
    sf_dir = "/root/testdata/sf0.001"
    got = queries.op10_mixing(spark, sf_dir)
    docs = {r.doc_id: r.text for r in queries.table(spark, sf_dir, "documents").collect()}
    rows = seen[0].collect()
    assert len(rows) == got.count() > 0 and all(r.text == docs[r.doc_id] for r in rows)
