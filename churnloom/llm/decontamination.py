"""Benchmark decontamination by a prefix-filtered set join; DataFrame operations only.

A window is ``window`` consecutive words of an item (an item of fewer words is one
window). A document contains it where all of its shingles follow each other. Method:

1. Shingles (runs of three words, fewer in windows that have fewer) of all documents
   meet the benchmark's shingles once; the hits are stored and give each shingle's
   frequency in the corpus.
2. Shingles are ordered by rarity. Containment asks for all shingles of a window, so its
   necessary prefix is the rarest one alone; a window whose rarest shingle occurs
   nowhere is dropped.
3. Hits of prefix shingles are candidates. Positional bound: the window starts as many
   words before the hit as the shingle lies behind its start, not before the text.
   Length bound: it ends within the text.
4. Candidates are verified word for word on the documents that have any.

Equal windows of several items are one window until the end, and a document is
identified by doc_id and the hash of its text, so repeated rows are counted as one row.

Defined results: null or empty text has no words and is not contaminated; null doc_id is
a value like any other; repeated rows get equal results, a row each; a null item_id is
listed as an empty string; items without words have no windows; without documents or
items the result is empty or all clean; extra columns are ignored by ``contamination``
and kept by ``remove_contaminated``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnloom.llm.common import same, texts
from churnloom.session import stored

WINDOW = 13
SHINGLE = 3
#: Benchmark rows (shingles, windows) that are broadcast at most; beyond, joins shuffle.
BROADCAST_ROWS = 1_000_000

_UPPER = "".join(map(chr, range(0x41, 0x5B)))
_BREAKS = "".join(
    chr(c) for a, b in ((0x00, 0x30), (0x3A, 0x41), (0x5B, 0x61), (0x7B, 0x80)) for c in range(a, b)
)


def words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    plain = F.translate(text, _UPPER + _BREAKS, _UPPER.lower() + " " * len(_BREAKS))
    return F.array_remove(F.split(plain, " "), "")


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _shingle(of: Column, at: Column, size: int) -> Column:
    """Hash of the ``size`` words from ``at`` (zero-based) on."""
    return F.xxhash64(F.lit(size), *[F.get(of, at + i) for i in range(size)])


def _shingles(of: Column, n: Column, size: int) -> Column:
    last = F.greatest(n - size, F.lit(-1))
    steps = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(steps, lambda i: _shingle(of, i, size))


def _windows(items: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """Different windows (wid, ws, size) and the items of each (wid, item)."""
    tokens = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        words(F.coalesce(F.col("text"), F.lit(""))).alias("w"),
    ).where(F.size("w") > 0)
    last = F.greatest(F.size("w") - window, F.lit(0))
    of_item = tokens.select("item", "w", F.explode(F.sequence(F.lit(0), last)).alias("at")).select(
        "item", F.slice("w", F.col("at") + 1, F.lit(window)).alias("ws")
    )
    named = stored(
        of_item.withColumn("wid", F.sha2(F.array_join("ws", " "), 256)).dropDuplicates(["wid", "item"]),
        "windows",
    )
    different = named.groupBy("wid").agg(F.first("ws").alias("ws"))
    return (
        stored(different.withColumn("size", F.size("ws")), "window-words"),
        named.select("wid", "item"),
    )


def _keyed(docs: DataFrame) -> DataFrame:
    return texts(docs).withColumn("th", F.xxhash64("text"))


def _same_doc(a: DataFrame, b: DataFrame) -> Column:
    return same(a["doc_id"], b["doc_id"]) & (a["th"] == b["th"])


def _occurrences(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc_id, th, found) with the verified windows of a document, repeated rows once."""
    width = F.least(F.lit(SHINGLE), F.col("size"))
    pieces = stored(
        windows.withColumn("k", width)
        .select(
            "wid", "size", "k",
            F.posexplode(
                F.when(F.col("k") == 1, _shingles(F.col("ws"), F.col("size"), 1))
                .when(F.col("k") == 2, _shingles(F.col("ws"), F.col("size"), 2))
                .otherwise(_shingles(F.col("ws"), F.col("size"), SHINGLE))
            ).alias("offset", "h"),
        ),
        "window-shingles",
    )
    sizes = [r.k for r in pieces.select("k").distinct().collect()]  # 1, 2 or 3
    wanted = stored(pieces.select("h").distinct(), "shingles")
    tokens = _keyed(docs).select("doc_id", "th", words(F.col("text")).alias("w"))
    tokens = tokens.withColumn("n", F.size("w"))
    hits = None
    for k in sizes:
        part = tokens.select(
            "doc_id", "th", "n", F.posexplode(_shingles(F.col("w"), F.col("n"), k)).alias("pos", "h")
        )
        hits = part if hits is None else hits.unionByName(part)
    if hits is None:
        hits = tokens.select("doc_id", "th", "n", F.lit(0).alias("pos"), F.col("th").alias("h")).limit(0)
    hits = stored(hits.join(_bounded(wanted, wanted.count()), "h"), "hits")

    counts = hits.groupBy("h").agg(F.count("*").alias("freq"))
    prefix = (
        pieces.join(counts, "h", "left")
        .groupBy("wid", "size")
        .agg(F.min(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "h", "offset")).alias("p"))
        .where("p.freq > 0")
        .select("wid", "size", "p.h", "p.offset")
    )
    prefix = stored(prefix, "prefixes")
    n_prefix = prefix.count()
    # Only the words of windows with a prefix, so that the count bounds them too.
    needed = stored(windows.select("wid", "ws").join(prefix, "wid", "left_semi"), "prefix-words")
    start = F.col("pos") - F.col("offset")
    bounds = (F.col("q.h") == F.col("p.h")) & (start >= 0) & (start + F.col("size") <= F.col("n"))
    candidates = (
        hits.alias("q")
        .join(_bounded(prefix, n_prefix).alias("p"), bounds)
        .select("doc_id", "th", start.alias("start"), "size", "wid")
        .join(_bounded(needed, n_prefix), "wid")
        .groupBy("doc_id", "th")
        .agg(F.collect_set(F.struct("start", "size", "wid", "ws")).alias("found"))
    )
    candidates = stored(candidates, "candidates")
    rows = _keyed(docs)
    matched = rows.join(candidates, _same_doc(rows, candidates)).select(
        rows["doc_id"], rows["th"], words(F.col("text")).alias("w"), "found"
    )
    exact = F.filter(
        "found", lambda c: F.slice(F.col("w"), c["start"] + 1, c["size"]) == c["ws"]
    )
    slim = F.transform(exact, lambda c: F.struct(c["start"], c["size"], c["wid"]))
    return stored(matched.select("doc_id", "th", slim.alias("found")), "found")


def _covered(found: Column) -> Column:
    """Words inside any of the windows, from their union in order of the starts."""
    zero = F.struct(F.lit(0).cast("bigint").alias("words"), F.lit(0).cast("bigint").alias("end"))

    def step(acc: Column, c: Column) -> Column:
        end = (c["start"] + c["size"]).cast("bigint")
        fresh = end - F.greatest(acc["end"], c["start"].cast("bigint"))
        return F.struct(
            (acc["words"] + F.greatest(fresh, F.lit(0).cast("bigint"))).alias("words"),
            F.greatest(acc["end"], end).alias("end"),
        )

    return F.aggregate(F.array_sort(found), zero, step)["words"]


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and th (the hash of
    the text, which with doc_id names a row of ``docs``)."""
    windows, of_items = _windows(items, window)
    found = _occurrences(docs, windows).where(F.size("found") > 0).dropDuplicates(["doc_id", "th"])
    found = stored(found, "occurrences")
    # One row per document and item.
    listed = (
        found.select("doc_id", "th", F.explode(F.array_distinct("found.wid")).alias("wid"))
        .join(_bounded(of_items, of_items.count()), "wid")
        .groupBy("doc_id", "th")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    hit = found.select("doc_id", "th", _covered(F.col("found")).alias("n_hit"))
    hit = hit.join(listed, _same_doc(hit, listed)).select(hit["doc_id"], hit["th"], "n_hit", "items")
    hit = stored(hit, "contaminated")
    rows = _keyed(docs).select(
        "doc_id", "th", F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("bigint").alias("n_words")
    )  # capital letters are not changed to count words
    joined = rows.join(hit, _same_doc(rows, hit), "left")
    n_hit = F.coalesce(hit["n_hit"], F.lit(0).cast("bigint"))
    names = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        rows["doc_id"],
        "n_words",
        n_hit.alias("n_hit"),
        F.size(names).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
        rows["th"],
    )


def remove_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    bad = contamination(docs, items, window).where("contaminated").select("doc_id", "th").distinct()
    bad = stored(bad, "rejected").withColumnsRenamed({"doc_id": "_bad_id", "th": "_bad_text"})
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.join(
        bad,
        same(docs["doc_id"].cast("bigint"), bad["_bad_id"]) & (F.xxhash64(text) == bad["_bad_text"]),
        "left_anti",
    )
