"""Token operators, classifier, chat, the pipeline and the registered SQL."""

import random
import zlib

import brute
import duckdb
import numpy as np
import pytest
from check import connect, difference
from conftest import bag
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from churnloom.llm import chat, queries, token_counts, token_store
from churnloom.llm import quality_classifier as C
from churnloom.llm.oracle import SQL
from churnloom.llm.queries import TOKENIZER

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(TOKENIZER)


@pytest.fixture(scope="module")
def hard():
    rng = random.Random(1)
    texts = ["́a ́", "'S 'LL THEY'RE", "...,,, a.b.c,", "ab" * 900 + ".", "İİ ok", "<|endoftext|><|startoftext|>"]
    for alphabet in ("abcdeoîéßΣ'.,!0123 \n\t<|>日İ", "aabbeetthhnnss"):
        texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(400)]
    return texts


def test_counts(make, odd, real, hard, tokenizer):
    docs = odd + real + [(1000 + i, t) for i, t in enumerate(hard)]
    want = []
    for d, t in docs:
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
        want.append((d, len((t or "").encode()), n, n > 2048))
    assert bag(token_counts.token_counts(make(docs), TOKENIZER).collect()) == bag(want)
    assert token_counts.token_counts(make([]), TOKENIZER).count() == 0


@pytest.mark.parametrize("chunk", [1, 5, 64])
def test_chunks_of_any_size_give_the_same_count(hard, odd, tokenizer, chunk):
    machine = token_counts.PieceCounts(TOKENIZER)
    for t in hard[:150] + [t for _, t in odd if t and len(t) < 1000]:
        want = len(tokenizer.encode(t, add_special_tokens=False).ids)
        assert token_counts.count_text(t, machine, chunk) == want


def test_small_tables_start_anew(monkeypatch, hard, tokenizer):
    from churnloom.llm import pieces

    monkeypatch.setattr(token_counts, "KEPT_STATES", 50)
    monkeypatch.setattr(token_counts, "KEPT_PAIRS", 50)
    monkeypatch.setattr(pieces, "REMEMBERED", 20)
    machine, ids = token_counts.PieceCounts(TOKENIZER), token_store.IdPieces(TOKENIZER, 2)
    for t in hard[:200]:
        want = tokenizer.encode(t, add_special_tokens=False).ids
        assert token_counts.count_text(t, machine) == len(want)
        assert np.frombuffer(ids.of(t), "<u2").tolist() == want


def test_store(spark, make, odd, real, hard, tokenizer, tmp_path, monkeypatch):
    monkeypatch.setattr(token_store, "BLOCK_DOCS", 7)
    docs = odd + [(d + 2000, t) for d, t in real] + [(5000 + i, t) for i, t in enumerate(hard[:100])]
    path = str(tmp_path / "store")
    token_store.write_store(make(docs, 4), path, TOKENIZER)
    got = token_store.read_digest(spark, path).collect()
    assert bag(got) == bag(brute.token_digest(docs, tokenizer))
    some = {r.doc_id: r.ids for r in token_store.read_ids(spark, path, [11, 5003, 99999]).collect()}
    texts = dict(docs)
    assert some == {d: [*tokenizer.encode(texts[d], add_special_tokens=False).ids, 2] for d in (11, 5003)}
    header = token_store._header(spark, path)
    monkeypatch.setattr(token_store, "_header", lambda spark, path: ("no", *header[1:]))
    with pytest.raises(Exception, match="another dictionary"):
        token_store.read_digest(spark, path).collect()


def test_store_small(spark, make, tmp_path, tokenizer):
    for i, docs in enumerate(([], [(1, None)], [(3, "b"), (3, "b"), (2, "a")])):
        path = str(tmp_path / f"store{i}")
        token_store.write_store(make(docs), path, TOKENIZER)
        assert bag(token_store.read_digest(spark, path).collect()) == bag(brute.token_digest(docs, tokenizer))


def test_classifier(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = C.scores(docs, labels)
    rows = {r.doc_id: r for r in got.collect()}
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows.values())
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in rows.items())
    assert all(r.predicted == (r.score >= 0.5) for r in rows.values())
    held = [(r.quality, rows[r.doc_id].predicted) for r in labels.collect() if rows[r.doc_id].held_out]
    for quality in (0, 1):
        part = [p for q, p in held if q == quality]
        assert part and sum(p == quality for p in part) / len(part) > 0.9


def test_classifier_learns_nothing_from_held_out_labels(spark, make):
    docs = make([(i, "good words here" if i % 2 else "### ### ###") for i in range(60)])
    true = [(i, i % 2) for i in range(60)]
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    wrong = [(i, 1 - q if held(i) else q) for i, q in true]
    a, b = (
        bag(C.scores(docs, spark.createDataFrame(x, "doc_id bigint, quality int")).collect()) for x in (true, wrong)
    )
    assert a == b and {r[0]: r[3] for r in a} == dict(true)


def test_classifier_odd(spark, make, odd):
    for labels in ([], [(1, 1), (2, None)], [(4, 0)], [(4, 0), (11, 1), (11, 0), (12, 1), (None, 1)]):
        table = spark.createDataFrame(labels, "doc_id bigint, quality int")
        assert C.scores(make(odd), table).count() == len(odd)
        kept = C.remove_rejected(make(odd), table)
        assert kept.columns == make(odd).columns
        if not any(q == 0 for _, q in labels):
            assert kept.count() == len(odd)
    assert C.scores(make([]), table).count() == 0


TALK = [
    (1, 0, "user", "How do I sort a list?\nIn place, please."),
    (1, 1, "assistant", "> how do I  sort a list?\nUse list.sort()."),
    (1, 2, "user", "An aside, quoting nobody."),
    (1, 3, "user", "> > How do I sort a list?\n> Use list.sort().\n\nThanks!"),
    (1, 4, "user", "> never written\nHm."),
    (1, 4, "user", "> never written\nHm."),
    (2, 0, "user", "> Use list.sort().\nfrom another conversation"),
    (2, 1, None, None), (None, 0, "user", "no id"), (3, None, "user", "no turn"), (3, 1, "system", ""),
]
TALK_SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def test_chat(spark):
    rows = spark.createDataFrame(TALK, TALK_SCHEMA)
    got = {(r.conv_id, r.segment): r for r in chat.formatted(rows).collect()}
    assert got[1, 0].n_messages == 5 and got[1, 0].n_linked == 3 and got[1, 0].n_quotes == 4
    turns = [t.split("\n", 1)[1].removesuffix("\n<|end|>") for t in got[1, 0].chat.split("\n<|user|>")[0:1]]
    assert turns[0].startswith("How do I sort")
    places = [got[1, 0].chat.index(x) for x in ("In place", "Use list.sort()", "Thanks!", "An aside", "Hm.")]
    assert places == sorted(places)  # the answers come before the aside
    assert ">" not in got[1, 0].chat.replace("|>", "")
    assert got[2, 0].n_linked == 0 and "<|unknown|>" in got[2, 0].chat
    assert got[None, 0].n_messages == 1 and got[3, 0].n_messages == 2


def test_chat_long_conversation_in_segments(spark):
    rows = spark.createDataFrame([(9, i, "user", f"m{i}") for i in range(150)], TALK_SCHEMA)
    got = {r.segment: r for r in chat.formatted(rows).collect()}
    assert [got[i].n_messages for i in range(3)] == [64, 64, 22]
    assert got[2].chat.startswith("<|user|>\nm128\n")
    assert chat.formatted(rows.limit(0)).count() == 0


def test_chat_same_as_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    rows = [r for r in TALK if r[1] is not None]
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    got = chat.formatted(spark.createDataFrame(rows, TALK_SCHEMA))
    assert difference(got, con, SQL["op9_chat_format"]) is None


def _threads(n, seed):
    """Conversations with quotes of several levels, side threads and things never written."""
    draw = random.Random(seed)
    rows = []
    for conv in range(n):
        said: list[str] = []
        for turn in range(draw.randrange(1, 14)):
            lines = []
            for level in sorted((draw.randrange(1, 4) for _ in range(draw.randrange(3))), reverse=True):
                source = draw.choice(said) if said and draw.random() < 0.85 else f"never {draw.randrange(9)}"
                marks = draw.choice(["> " * level, ">" * level, " >" * level + " "])
                lines += [marks + x for x in source.split("\n")] + [""] * draw.randrange(2)
            own = "\n".join(f"line {draw.randrange(60)} of {draw.choice('abc')}" for _ in range(draw.randrange(1, 4)))
            said.append(own)
            rows.append((conv, turn, draw.choice(["user", "assistant"]), "\n".join([*lines, own])))
    return rows


def test_chat_threads_same_as_sql(spark):
    rows = _threads(60, 3)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    got = chat.formatted(spark.createDataFrame(rows, TALK_SCHEMA))
    assert sum(r.n_linked for r in got.collect()) > 200
    assert difference(got, con, SQL["op9_chat_format"]) is None


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, name):
    assert difference(entry.queries()[name](spark, SMALL), connect(SMALL), SQL[name]) is None


@pytest.mark.parametrize("name", sorted({*queries.QUERIES, "pipeline"} - set(SQL)))
def test_registered_query_has_rows(spark, name):
    assert entry.queries()[name](spark, SMALL).count() > 0


def test_pipeline(spark, tokenizer):
    """Each stage against plain Python on what the stage before kept."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    seen = [rows]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        seen.append([tuple(r) for r in docs.collect()])
        docs = spark.createDataFrame(seen[-1], docs.schema)
    raw, good, single, clean, mixed = seen
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    scored = C.scores(spark.read.parquet(f"{SMALL}/documents.parquet"), labels)
    rejected = {r.doc_id for r in scored.collect() if not r.predicted}
    assert bag(good) == bag(r for r in raw if r[0] not in rejected) and rejected
    keep = {c for _, _, c in brute.simhash_groups([(r[0], r[1]) for r in good])}
    assert bag(single) == bag(r for r in good if r[0] in keep) and len(single) < len(good)
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {r[0] for r in brute.contamination([(r[0], r[1]) for r in single], items) if r[-1]}
    assert bag(clean) == bag(r for r in single if r[0] not in bad)
    assert set(mixed) <= set(clean) and len(mixed) > 0.6 * len(clean)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert bag(last) == bag(brute.token_digest([(r[0], r[1]) for r in mixed], tokenizer))
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("unit", ["日本語の文", "x=f(a)\t", "'ll<|endoftext|>=", "7", "🙂'"])
def test_a_long_open_piece_is_not_held(unit, tokenizer):
    machine, text = token_counts.PieceCounts(TOKENIZER), unit * 400
    for chunk in (16, 64):
        piece = token_counts.OpenPiece(machine, chunk)
        for i in range(0, len(text), chunk):
            piece.add(text[i : i + chunk])
            assert piece.held <= 4 * chunk
        want = len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert piece.close("") == want == token_counts.count_text(text, machine, chunk)
