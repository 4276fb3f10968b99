from types import SimpleNamespace

import pyarrow as pa

from churnloom.llm import token_store
from churnloom.llm.queries import TOKENIZER


def test_tasks_of_a_worker_share_the_pieces_they_know(monkeypatch):
    here = SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0))
    monkeypatch.setattr(token_store, "TaskContext", here)
    made, plain = [], token_store.IdPieces
    monkeypatch.setattr(token_store, "IdPieces", lambda *a: made.append(a) or plain(*a))
    batch = pa.record_batch([pa.array([1, 2]), pa.array(["one two one", "two three"])], names=["doc_id", "text"])
    stores = [list(token_store._writer(TOKENIZER, 2, b"", 2)([batch])) for _ in range(2)]
    assert len(made) <= 1
    assert stores[0][0].to_pylist() == stores[1][0].to_pylist()
    assert stores[0][0].column("n_tokens").to_pylist()[0][0] > 3
