"""Operators on single texts and searches, against plain Python."""

import brute
import pytest
from conftest import bag

from churnloom.llm import decontamination as D
from churnloom.llm import mixing as M
from churnloom.llm import quality_rules as Q
from churnloom.llm import secret_ledger as S
from churnloom.llm import simhash, substring

pytestmark = pytest.mark.filterwarnings("ignore")


def _paths(spark, rows, folder, rules=S.BASE):
    docs = spark.createDataFrame(rows, "path bigint, text string, blob string")
    ledger = S.Ledger(spark, folder)
    ledger.scan(docs, rules)
    return ledger


def test_secrets(spark, odd, real, tmp_path):
    rows = [(d, t, "clash") for d, t in odd + real]
    ledger = _paths(spark, rows, str(tmp_path / "ledger"))
    got = ledger.paths(ledger.versions()).collect()
    assert bag(got) == bag((d, *brute.secrets(t)) for d, t in odd + real)


def test_secrets_scans_only_unseen(spark, tmp_path):
    folder = str(tmp_path / "ledger")
    first = [(1, "token=aaaaaaaaa", ""), (2, "token=aaaaaaaaa", ""), (3, "clean", "")]
    ledger = _paths(spark, first, folder)
    assert ledger.scanned().count() == 2 * 3
    _paths(spark, [*first, (4, "secret: bbbbbbbbb", "")], folder)
    assert ledger.scanned().count() == 3 * 3  # one new blob
    assert ledger.findings().count() == 2
    newer = S.Rule("access", S.ACCESS.pattern, 0, 16, version=2)
    _paths(spark, first, folder, (S.ASSIGN, newer, S.HEX))
    assert ledger.scanned().count() == 3 * 3 + 2  # the new version over two blobs
    got = ledger.paths(ledger.versions().distinct()).where("n_assign > 0").select("path").collect()
    assert sorted(r.path for r in got) == [1, 2, 4]


def test_secrets_interrupted_run_does_not_count(spark, tmp_path):
    folder = str(tmp_path / "ledger")
    ledger = _paths(spark, [(1, "clean", "")], folder)
    blob = ledger.versions().first().blob
    lost = spark.createDataFrame([(blob, "hex", "hex@1", 0, 9, "lost")], S._FINDINGS)
    ledger._add(lost, "findings")
    assert ledger.findings().count() == 0


def test_secrets_empty(spark, tmp_path):
    ledger = _paths(spark, [], str(tmp_path / "ledger"))
    assert ledger.paths(ledger.versions()).count() == 0


ITEMS = [
    (1, "Alpha beta GAMMA delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"),
    (2, "short item"), (3, "word"), (4, None), (5, ""), (None, "null id item here"),
    (6, "Alpha beta GAMMA delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"), (7, "...!"),
]


def test_contamination(spark, make, odd, real):
    long = ITEMS[0][1]
    docs = [
        *odd, *real[:60], (100, "start " * 20 + long.upper() + " end " * 30), (101, long), (101, long),
        (102, " ".join(long.split()[1:14])), (103, " ".join(long.split()[2:13])), (104, "a Short; item. word"),
        (105, "null id item here " + "pad " * 100), (106, (long + " ") * 40),
    ]
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()
    items = ITEMS + [(r.item_id + 1000, r.text) for r in bench]
    table = spark.createDataFrame([(*i, "x") for i in items], "item_id bigint, text string, doc_id string")
    got = D.contamination(make(docs), table).drop("th").collect()
    assert bag(got) == bag(brute.contamination(docs, items))
    assert any(r.contaminated for r in got)


def test_contamination_without_broadcast(spark, make, monkeypatch):
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    docs = [(1, ITEMS[0][1]), (2, "nothing"), (3, "a short item")]
    table = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = D.contamination(make(docs), table).drop("th").collect()
    assert bag(got) == bag(brute.contamination(docs, ITEMS))


def test_contamination_empty(spark, make):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert [r.n_hit for r in D.contamination(make([(1, "some words")]), none).collect()] == [0]
    assert D.contamination(make([]), spark.createDataFrame(ITEMS, "item_id bigint, text string")).count() == 0


def test_remove_contaminated(spark, make):
    docs = make([(1, ITEMS[0][1]), (2, "fine text"), (2, "fine text"), (None, "short item"), (3, None)])
    table = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = D.remove_contaminated(docs, table)
    assert got.columns == docs.columns
    assert bag((r.doc_id,) for r in got.collect()) == bag([(2,), (2,), (3,)])


def test_rule_measures(odd, real):
    for _, t in odd + real:
        assert Q.measures(t or "")[:5] == brute.rule_measures(t)


def test_rules_keep_clean(make, odd, real):
    got = Q.judged(make(odd + real)).collect()
    assert len(got) == len(odd + real)
    for r in got:
        fails = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        assert r.base_failed == fails and not (fails and r.kept)
    symbols = [(1000 + i, "word$$$ other### " * 20 + f"{i} tail {i * 7}") for i in range(30)]
    clean = [(i, f"some quite ordinary sentence number {i} with words, that ends well.\nAnd line {i * 3} more.") for i in range(300)]
    kept = {r.doc_id: r.kept for r in Q.judged(make(clean + symbols)).collect()}
    assert all(kept[i] for i, _ in clean) and not any(kept[i] for i, _ in symbols)


def test_rules_empty(make):
    assert Q.judged(make([])).count() == 0


def test_verdict_as_by_hand(make, odd, real):
    """Votes, expectation-maximisation and verdict, document by document in plain Python."""
    docs = odd + real + [(2000 + i, "word$$$ other### " * 9 + f"tail {i}") for i in range(12)]
    got = {(r.doc_id, r.n_words, r.word_chars): (round(r.quality, 9), r.kept) for r in Q.judged(make(docs)).collect()}
    want = {(d, n, chars): (round(q, 9), kept) for d, n, chars, q, kept in brute.rule_verdicts(docs)}
    assert got == want and {k for _, k in got.values()} == {True, False}


def test_fit_finds_accurate_rules():
    n = len(Q.rules())
    votes = lambda *given: (*given, *[None] * (n - len(given)))
    # The second rule contradicts the first as often as not, the third only speaks of junk.
    patterns = [(votes(1, 1, None), 450), (votes(1, 0, None), 450), (votes(0, 1, 0), 50), (votes(0, 0, 0), 50)]
    good, accuracy = Q.fit(patterns)
    assert abs(good - 0.9) < 0.02
    assert accuracy[0] > 0.95 and accuracy[2] > 0.95 and accuracy[1] == Q.LEAST
    post = Q.posterior(Q._matrix([p for p, _ in patterns]), good, accuracy)
    assert (post > 0.5).tolist() == [True, True, False, False]


def test_simhash(make, odd, real):
    near = "the quick brown fox jumps over the lazy dog and runs away from here " * 4
    docs = odd + real + [(500 + i, near + f"tail {i}") for i in range(40)] + [(400, near), (401, near)]
    got = simhash.groups(make(docs)).collect()
    assert bag(got) == bag(brute.simhash_groups(docs))
    assert sum(r.component_id != r.doc_id for r in got) > 3


def test_simhash_links_find_all_pairs(spark):
    import random

    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(30)]
    fps = {b ^ sum(1 << k for k in rng.sample(range(64), rng.choice([0, 1, 2, 3]))) for b in base for _ in range(30)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(f,) for f in signed], "fp bigint")).collect()}
    want = {
        (min(a, b), max(a, b)) for i, a in enumerate(signed) for b in signed[:i]
        if ((a ^ b) & (2**64 - 1)).bit_count() <= 2
    }
    assert got == want and want


def test_components(spark):
    from churnloom.llm.components import components

    chain = [(i, i + 1) for i in range(100, 200)] + [(7, 7), (1, 2), (2, 1), (5, 3)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    got = dict(components(spark.createDataFrame(chain + star, "x bigint, y bigint")).collect())
    want = {i: 100 for i in range(100, 201)} | {1: 1, 2: 1, 3: 3, 5: 3} | {1000 + i: 1000 for i in range(300)}
    assert got == want
    assert components(spark.createDataFrame([], "x bigint, y bigint")).count() == 0


def test_keep_one(make, odd):
    docs = make(odd)
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    keep = {c for _, _, c in brute.simhash_groups(odd) if c is not None}
    assert bag((r.doc_id,) for r in got.collect()) == bag([(d,) for d in keep] + [(None,)])
    assert simhash.keep_one(make([])).count() == 0


def test_substring(make, odd, real):
    passage = " ".join(f"w{i}" for i in range(60))
    docs = odd + real + [
        (600, passage), (601, "before " + passage + " after"), (602, " ".join(passage.split()[:34])),
        (603, " ".join(passage.split()[10:45])), (604, (passage + " x ") * 3), (605, passage), (605, passage),
        (606, "tail " * 40), (607, " ".join(passage.split()[20:])),
    ]
    got = substring.repeated_windows(make(docs, 4)).collect()
    assert bag(r[:4] for r in got) == bag(brute.removed_windows(docs))
    assert all(sum(b - a for a, b in r.spans) == r.n_removed for r in got)


@pytest.mark.parametrize("window", [1, 3, 7])
def test_substring_small_windows_and_chunks(make, monkeypatch, window):
    import random

    monkeypatch.setattr(substring, "parts_for", lambda words: 7)
    rng = random.Random(window)
    docs = [(i, " ".join(rng.choice("abcd") * rng.randint(1, 2) for _ in range(rng.randint(0, 40)))) for i in range(60)]
    got = substring.repeated_windows(make(docs, 5), window).drop("spans").collect()
    assert bag(got) == bag(brute.removed_windows(docs, window))


def test_substring_empty(make):
    assert substring.repeated_windows(make([])).count() == 0


def test_mixing(make, spark):
    import math

    docs = make([(i, f"text {i}") for i in range(3000)] + [(1, "text 1")] * 2)
    got = M.copies(docs, {"s0": 1.0, "s1": 3.0}, total=9000).groupBy("source").count().collect()
    n = {r["source"]: r["count"] for r in got}
    assert set(n) == {"s0", "s1"}
    assert abs(n["s0"] - 2250) < 5 * math.sqrt(2250) and abs(n["s1"] - 6750) < 5 * math.sqrt(6750)
    again = M.copies(docs.repartition(7), {"s0": 1.0, "s1": 3.0}, total=9000).groupBy("doc_id").count()
    first = M.copies(docs, {"s0": 1.0, "s1": 3.0}, total=9000).groupBy("doc_id").count()
    assert bag(again.collect()) == bag(first.collect())
    assert M.mixed(docs).columns == docs.columns
    assert M.mixed(make([])).count() == 0
    with_null = M.rates(docs).where("_source is null").first()
    assert with_null["_rate"] > 0  # the null source is one of its own


def test_mixing_large_rate(make):
    n = M.copies(make([(0, "a"), (3, "b")]), {"s0": 1.0}, total=4000).agg({"*": "count"}).first()[0]
    assert abs(n - 4000) < 5 * 4000**0.5


def test_poisson_thresholds(spark):
    import math

    row = spark.range(1).select(M.thresholds(M.F.lit(3.5)).alias("c")).first()
    want = [sum(math.exp(-3.5) * 3.5**j / math.factorial(j) for j in range(k + 1)) for k in range(20)]
    assert all(abs(a - b) < 1e-12 for a, b in zip(row.c, want))
