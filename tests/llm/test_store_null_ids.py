from churnloom.llm import token_store
from churnloom.llm.queries import TOKENIZER


def test_an_id_is_read_from_a_block_with_null_ids(spark, make, tmp_path):
    path = str(tmp_path / "store")
    token_store.write_store(make([(None, "x"), (4, "b"), (9, "c")], 1), path, TOKENIZER)
    assert [r.doc_id for r in token_store.read_ids(spark, path, [4]).collect()] == [4]
