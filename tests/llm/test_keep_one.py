from churnloom.llm import simhash


def test_each_group_keeps_a_row_when_ids_repeat(make):
    a, b, c = "some words of the first text", "quite another story told here", "nobody gave this one an id"
    docs = [(3, a), (5, a), (5, b), (5, b), (None, c), (None, c), (None, a)]
    kept = simhash.keep_one(make(docs)).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.text) for r in kept) == [
        (False, 3, a), (False, 5, b), (True, None, c)
    ]
