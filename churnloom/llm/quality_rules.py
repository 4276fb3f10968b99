"""Quality rules as weak supervision instead of all-must-pass filters.

Method: each rule looks at a document's measures and votes good or bad, or abstains; most
rules know one defect and can only vote bad. Measures that speak of the same defect
(repeated lines, repeated words, few different words) share a rule, since the model takes
rules as independent. The votes of all documents are counted by pattern (three outcomes
for each of the rules, so at most 3 ** len(RULES) patterns, whatever the data).
Expectation-maximisation over these counts estimates how often each rule is right when it
votes, and the share of good documents; the posterior probability of a document's pattern
is its quality. A rule has a sense: its accuracy starts high and is held above one half,
so that a class can't turn into something the rules are not about. Documents with a hard
failure are not kept whatever the posterior is.

Defined results: null or empty text has no words and fails (fewer than 10 words); null
doc_id and repeated rows are kept, a row each; an empty table gives an empty table;
other columns are ignored. Measures count whole texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnloom.llm.common import texts, words_of
from churnloom.session import stored

SYMBOLS = str.maketrans(dict.fromkeys("#*$%&|<>"))
GRAM = 5
#: Fixed bounds of a hard failure.
LEAST_WORDS, REPEATED_PERCENT = 10, 20
ROUNDS = 100
#: Accuracy of a rule at the start, and the weight (in votes) with which it stays as a
#: prior; what it is held between.
START, PRIOR_VOTES = 0.9, 2.0
LEAST, MOST = 0.55, 0.99
#: Share of good documents at the start; it is estimated, with this weight in documents.
GOOD, PRIOR_DOCUMENTS = 0.5, 2.0

MEASURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint,"
    " n_repeat_words bigint, n_lines bigint, n_different bigint, n_capitals bigint, n_letters bigint"
)


def measures(text: str) -> tuple[int, ...]:
    words = words_of(text)
    n = len(words)
    chars = len(b"".join(words).decode("utf-8", "surrogatepass"))
    symbols = len(text) - len(text.translate(SYMBOLS))
    lines = Counter(line for line in text.split("\n") if words_of(line))
    dup_lines = sum(lines.values()) - len(lines)
    grams = Counter(zip(*(words[i:] for i in range(GRAM)))) if n >= GRAM else {}
    repeated = 0
    if len(grams) < n - GRAM + 1:
        reach = 0
        for i, gram in enumerate(zip(*(words[k:] for k in range(GRAM)))):
            if grams[gram] > 1:
                repeated += i + GRAM - max(reach, i)
                reach = i + GRAM
    if text.isascii():
        raw = np.frombuffer(text.encode(), np.uint8)
        capitals = int(((raw >= 65) & (raw <= 90)).sum())
        letters = capitals + int(((raw >= 97) & (raw <= 122)).sum())
    else:
        capitals, letters = sum(map(str.isupper, text)), sum(map(str.isalpha, text))
    return (n, chars, symbols, dup_lines, repeated, sum(lines.values()), len(set(words)), capitals, letters)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the measures, a row for each row."""
    names = [m.split()[0] for m in MEASURES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measures(t.as_py()) for t in batch.column("text")]
            columns = zip(*rows) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)],
                names=["doc_id", *names],
            )

    return texts(docs).mapInArrow(run, f"doc_id bigint, {MEASURES}")


def _vote(good: Column, bad: Column) -> Column:
    """1, 0 or null (abstains); bad goes first."""
    return F.when(bad, F.lit(0)).when(good, F.lit(1))


def _bad(bad: Column) -> Column:
    return F.when(bad, F.lit(0))


def rules() -> dict[str, Column]:
    n, lines = F.col("n_words"), F.col("n_lines")
    length = F.col("word_chars") / F.greatest(n, F.lit(1))
    symbols = F.col("n_symbols") / F.greatest(n, F.lit(1))
    letters = F.col("n_letters") / F.greatest(F.col("word_chars"), F.lit(1))
    dup = F.col("n_dup_lines") / F.greatest(lines, F.lit(1))
    repeated = F.col("n_repeat_words") / F.greatest(n, F.lit(1))
    different = F.col("n_different") / F.greatest(n, F.lit(1))
    capitals = F.col("n_capitals") / F.greatest(F.col("n_letters"), F.lit(1))
    varied = (dup <= 0.05) & (repeated <= 0.05) & (different >= 0.3)
    return {
        "clean": F.when((n >= LEAST_WORDS) & length.between(3, 10) & (symbols <= 0.02) & varied, F.lit(1)),
        "letters": _vote(letters >= 0.93, (n >= 20) & (letters < 0.88)),
        "symbols": _bad(symbols > 0.1),
        "repetition": _bad(
            (dup > 0.3) | (repeated > REPEATED_PERCENT / 100) | ((n >= 50) & (different < 0.15))
        ),
        "length": _bad(n < LEAST_WORDS),
        "word_length": _bad((n > 0) & ((length < 2) | (length > 15))),
        "capitals": _bad((F.col("n_letters") >= 20) & (capitals > 0.4)),
    }


def _matrix(patterns: list[tuple[int | None, ...]]) -> np.ndarray:
    """1 for a good vote, -1 for a bad one, 0 without a vote; a row for each pattern."""
    values = [[0 if v is None else 2 * v - 1 for v in p] for p in patterns]
    return np.array(values, dtype=float).reshape(len(patterns), len(rules()))


def fit(patterns: list[tuple[tuple[int | None, ...], int]], rounds: int = ROUNDS) -> tuple[float, np.ndarray]:
    """Share of good documents and the accuracy of each rule's votes."""
    patterns = sorted(patterns, key=lambda p: tuple(-1 if v is None else v for v in p[0]))
    votes = _matrix([p for p, _ in patterns])
    weight = np.array([n for _, n in patterns], dtype=float)
    good, accuracy = GOOD, np.full(votes.shape[1], START)
    for _ in range(rounds):
        post = posterior(votes, good, accuracy)
        right = np.where(votes > 0, post[:, None], np.where(votes < 0, 1 - post[:, None], 0.0))
        cast = weight @ (votes != 0)
        accuracy = np.clip((weight @ right + PRIOR_VOTES * START) / (cast + PRIOR_VOTES), LEAST, MOST)
        good = (weight @ post + PRIOR_DOCUMENTS * GOOD) / (weight.sum() + PRIOR_DOCUMENTS)
    return good, accuracy


def posterior(votes: np.ndarray, good: float, accuracy: np.ndarray) -> np.ndarray:
    """Probability of good: each vote moves the odds by those of its rule being right."""
    odds = np.log(good / (1 - good)) + votes @ np.log(accuracy / (1 - accuracy))
    return 1 / (1 + np.exp(np.clip(-odds, -700, 700)))


def judged(docs: DataFrame) -> DataFrame:
    """Measures, posterior probability of quality, base_failed and kept."""
    names = list(rules())
    rows = stored(measured(docs).withColumns(rules()), "measures")
    counted = rows.groupBy(*names).agg(F.count("*").alias("n")).collect()  # <= 3 ** rules, in no order
    patterns = [(tuple(r[c] for c in names), r.n) for r in counted]
    post = posterior(_matrix([p for p, _ in patterns]), *fit(patterns)).tolist()
    spark = docs.sparkSession
    table = spark.createDataFrame(
        [(*p, float(q)) for (p, _), q in zip(patterns, post)],
        ", ".join(f"_{c} int" for c in names) + ", quality double",
    )
    match = None
    for c in names:
        one = rows[c].eqNullSafe(table[f"_{c}"])
        match = one if match is None else match & one
    n = F.col("n_words")
    failed = (n < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * n)
    return (
        rows.join(F.broadcast(table), match)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("quality") >= 0.5))
        .drop(*(f"_{c}" for c in names))
    )
