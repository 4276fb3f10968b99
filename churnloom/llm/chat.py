"""Chat formatting with quotation linking; DataFrame operations only.

Method: leading ``>`` marks of a line are its quote level (nested quotes have several).
A passage is a run of neighbouring lines of one level without a blank line, white space
and case normalised; passages and their single lines are hashed. A quoted passage is
joined, within its conversation, to the message that first wrote it unquoted, and counts
as linked if that message is earlier. A message answers the latest message linked from
its quotes of level one. Messages are ordered by the message their chain of answers
starts from, then by turn, so an answer follows what it answers; without quotes that is
the order of turns. Quoted lines are left out of the formatted text.

A conversation may hold a large share of all rows: its messages are numbered by ranges,
not in one task, and formatted ``SEGMENT`` messages to a row. Of a passage that many
messages wrote only the first is joined, so links do not multiply.

Defined results: null text is empty, null role ``unknown``, null turn comes first; null
conv_id is one conversation; repeated rows are one message, but not where turn or
conv_id is null, since they may be different messages; messages with equal turns
are ordered by their hash and do not link to each other; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnloom.functions.running import running_sums
from churnloom.llm.common import same
from churnloom.session import stored

#: Messages of a formatted row, at most.
SEGMENT = 64
_MARKS = r"^[ \t]*(?:>[ \t]?)+"
_BREAK = r"\r\n|\r|\n"
_KEYS = ("conv_id", "turn", "mid")


def _lines(text: Column) -> Column:
    return F.split(text, _BREAK, -1)


def _normal(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def unquoted(text: Column) -> Column:
    """The text without its quoted lines and the white space around what is left."""
    own = F.filter(_lines(text), lambda line: ~line.rlike(_MARKS))
    return F.regexp_replace(F.array_join(own, "\n"), r"^\s+|\s+$", "")


def messages(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, mid (hash of role and text), role, text and ``copies``: repeated rows
    are one message, but where turn or conv_id is null each row is one."""
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.coalesce(F.col("turn").cast("bigint"), F.lit(-(2**63))).alias("turn"),
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        (F.col("conv_id").isNull() | F.col("turn").isNull()).alias("loose"),
    )
    mid = F.unhex(F.sha2(F.concat_ws("\x00", "role", "text"), 256))
    return (
        rows.withColumn("mid", mid)
        .groupBy(*_KEYS)
        .agg(
            F.first("role").alias("role"),
            F.first("text").alias("text"),
            F.when(F.bool_or("loose"), F.count("*")).otherwise(F.lit(1).cast("bigint")).alias("copies"),
        )
    )


def passages(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, mid, level, place, h): passages and lines, each with its hash."""
    lines = rows.select(*_KEYS, F.posexplode(_lines(F.col("text"))).alias("line", "raw"))
    marks = F.regexp_extract("raw", _MARKS, 0)
    lines = lines.select(
        *_KEYS,
        "line",
        F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"),
        _normal(F.regexp_replace("raw", _MARKS, "")).alias("body"),
    )
    # A line opens a passage if the one before is blank or of another level. The rows
    # of a window are the lines of one message.
    one = f"partition by {', '.join(_KEYS)} order by line"
    lines = lines.withColumn(
        "opens",
        F.expr(f"coalesce(lag(level) over ({one}) <> level or lag(body) over ({one}) = '', true)"),
    ).withColumn("run", F.expr(f"sum(cast(opens as int)) over ({one})"))
    lines = lines.where("body <> ''")
    joined = F.array_join(F.array_sort(F.collect_list(F.struct("line", "body")))["body"], " ")
    whole = lines.groupBy(*_KEYS, "level", "run").agg(joined.alias("body"), F.count("*").alias("n"))
    both = whole.where("n > 1").select(*_KEYS, "level", F.col("run").alias("place"), "body").unionByName(
        lines.select(*_KEYS, "level", (-F.col("line") - 1).alias("place"), "body")
    )
    return both.select(*_KEYS, "level", "place", F.sha2("body", 256).alias("h"))


def links(found: DataFrame) -> DataFrame:
    """(conv_id, turn, mid, level, place, origin): quotes and the turn they come from."""
    first = stored(
        found.where("level = 0").groupBy("conv_id", "h").agg(F.min("turn").alias("origin")), "first"
    )
    quotes = found.where("level > 0").alias("q")
    f = first.alias("f")
    key = same(F.col("q.conv_id"), F.col("f.conv_id")) & (F.col("q.h") == F.col("f.h"))
    earlier = F.col("f.origin") < F.col("q.turn")
    return quotes.join(f, key & earlier, "left").select(
        *[f"q.{c}" for c in (*_KEYS, "level", "place")], "f.origin"
    )


def _roots(answers: DataFrame) -> DataFrame:
    """(conv_id, turn, mid, root): the turn at the start of a message's chain.

    Each round doubles the part of the chain that is known; a chain ends at a message
    that answers none. Turns that answer are looked up by their latest answer.
    """
    hops = stored(answers.withColumnRenamed("reply_to", "root"), "hops")
    while True:
        by_turn = stored(hops.groupBy("conv_id", "turn").agg(F.min("root").alias("up")), "by-turn")
        h, t = hops.alias("h"), by_turn.alias("t")
        key = same(F.col("h.conv_id"), F.col("t.conv_id")) & (F.col("h.root") == F.col("t.turn"))
        if h.join(t, key, "left_semi").isEmpty():
            return hops
        hops = stored(
            h.join(t, key, "left").select(
                *[f"h.{c}" for c in _KEYS], F.coalesce("t.up", "h.root").alias("root")
            ),
            "hops",
        )


def _with_quotes(rows: DataFrame) -> DataFrame:
    """Messages of the conversations in which some line is quoted; in the others there is
    nothing to link."""
    marked = rows.where(F.col("text").rlike(r"(?:^|[\r\n])[ \t]*>"))
    some = stored(marked.select(F.col("conv_id").alias("_conv")).distinct(), "quoting")
    return rows.join(some, same(rows["conv_id"], some["_conv"]), "left_semi")


def ordered(conversations: DataFrame) -> DataFrame:
    """Messages with reply_to (null if none), n_quotes, n_linked, body without quotes,
    ``cum_one`` (place in the conversation, from one) and ``all_one`` (its messages).

    Places are counted on keys alone; the texts are joined afterwards.
    """
    rows = stored(messages(conversations), "messages")
    linked = stored(links(stored(passages(_with_quotes(rows)), "passages")), "links")
    per_message = linked.groupBy(*_KEYS).agg(
        F.count_if(F.col("place") < 0).alias("n_quotes"),
        F.count_if((F.col("place") < 0) & F.col("origin").isNotNull()).alias("n_linked"),
        F.max(F.when(F.col("level") == 1, F.col("origin"))).alias("reply_to"),
    )
    per_message = stored(per_message, "replies")
    answers = per_message.where("reply_to is not null").select(*_KEYS, "reply_to")
    roots = stored(_roots(answers), "roots")

    def matches(a: str, b: str) -> Column:
        return (
            same(F.col(f"{a}.conv_id"), F.col(f"{b}.conv_id"))
            & (F.col(f"{a}.turn") == F.col(f"{b}.turn"))
            & (F.col(f"{a}.mid") == F.col(f"{b}.mid"))
        )

    zero = F.lit(0).cast("bigint")
    keyed = (
        rows.alias("r")
        .join(per_message.alias("p"), matches("r", "p"), "left")
        .join(roots.alias("t"), matches("r", "t"), "left")
        .select(
            "r.conv_id",
            F.struct(F.coalesce("t.root", "r.turn").alias("root"), "r.turn", "r.mid").alias("place"),
            "p.reply_to",
            F.coalesce("p.n_quotes", zero).alias("n_quotes"),
            F.coalesce("p.n_linked", zero).alias("n_linked"),
            F.col("r.copies").alias("one"),
        )
    )
    placed = running_sums(keyed, "place", ["one"], ["conv_id"]).select("*", "place.turn", "place.mid").drop("place")
    whole = placed.alias("k").join(rows.alias("r"), matches("k", "r")).select(
        "k.*", "r.role", unquoted(F.col("r.text")).alias("body")
    )
    # Equal messages that are no repeats follow each other.
    each = F.explode(F.sequence(F.col("cum_one") - F.col("one") + 1, F.col("cum_one")))
    return whole.withColumn("cum_one", each).withColumn("one", F.lit(1).cast("bigint"))


def formatted(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """conv_id, segment (from zero), n_messages, n_quotes, n_linked and chat."""
    rows = ordered(conversations)
    part = F.floor((F.col("cum_one") - 1) / segment).cast("bigint")
    turn = F.concat(F.lit("<|"), "role", F.lit("|>\n"), "body", F.lit("\n<|end|>"))
    in_order = F.array_sort(F.collect_list(F.struct("cum_one", turn.alias("turn"))))
    return rows.groupBy("conv_id", part.alias("segment")).agg(
        F.count("*").alias("n_messages"),
        F.sum("n_quotes").alias("n_quotes"),
        F.sum("n_linked").alias("n_linked"),
        F.array_join(in_order["turn"], "\n").alias("chat"),
    )
