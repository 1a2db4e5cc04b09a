"""Quotation linking for chats and mail threads, in DataFrame functions only.

A message's lines are parted by quote level (the number of leading ``>``). Runs
of quoted lines are cut into passages at blank lines, normalised and hashed, and
joined to the hashes of what messages themselves wrote. A passage that nobody
wrote as a whole is looked for again by its lines and sentences. A message
answers the one that its outermost quotation comes from.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk.llm.common import read, written

#: Copies of an original's row in the joins: a passage that a third of all
#: messages quote is dealt over so many keys.
SALTS = 16
#: No repeated group: its depth would be the matcher's stack.
MARK = r"^[ \t>]*>[ \t]?"
#: White space after a sentence's end.
SENTENCE = r"(?<=[.!?])\s+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, not in each turn of an inner loop."""
    return F.element_at(F.transform(F.array(value), body), 1)


def runs_of(text: Column) -> Column:
    """Array of (level, text): the maximal runs of lines of one quote level, marks taken off."""
    lines = F.transform(
        F.split(text, "\n"),
        lambda x: F.struct(F.length(F.regexp_replace(F.regexp_extract(x, MARK, 0), "[^>]", "")).alias("level"), F.regexp_replace(x, MARK, "").alias("body")),
    )

    def cut(parsed: Column) -> Column:
        n = F.size(parsed)
        starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (parsed[i]["level"] != F.get(parsed, i - 1)["level"]))
        return let(
            starts,
            lambda at: F.transform(
                at,
                lambda s, k: F.struct(
                    parsed[s]["level"].alias("level"),
                    F.array_join(F.transform(F.slice(parsed, s + 1, F.coalesce(F.get(at, k + 1), n) - s), lambda x: x["body"]), "\n").alias("body"),
                ),
            ),
        )

    return let(lines, cut)


def normal(c: Column) -> Column:
    """Lower case, any white space as one blank."""
    return F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))


def paragraphs(body: Column) -> Column:
    """The paragraphs of a run, in order, white space as written; blank ones left out."""
    return F.filter(F.split(body, r"\n[ \t]*\n"), lambda p: normal(p) != "")


def digest(part: Column) -> Column:
    return F.sha2(normal(part).cast("binary"), 256)


def passages(body: Column) -> Column:
    """Hashes of the paragraphs of a run, in order; blank ones left out."""
    return F.transform(paragraphs(body), digest)


def pieces(paragraph: Column) -> Column:
    """The lines, the sentences of lines, and the sentences across lines of a paragraph."""
    cuts = [F.split(paragraph, "\n"), F.split(paragraph, rf"\n|{SENTENCE}"), F.split(paragraph, SENTENCE)]
    return F.array_distinct(F.filter(F.transform(F.concat(*cuts), normal), lambda p: p != ""))


def originals(quotes: DataFrame, wrote: DataFrame) -> DataFrame:
    """``quotes`` (row, conv_id, turn, key, ...) with ``origin``: who wrote the key first, null if nobody.

    ``wrote``: (conv_id, turn, key) without nulls. The earliest earlier message of
    the same conversation, else the earliest by (conversation, turn) of another.
    """
    here = wrote.groupBy("key", "conv_id").agg(F.min("turn").alias("o_turn"))
    # the two earliest conversations that wrote it: one of them is another one. Each task
    # hands on two rows of a key, however many conversations wrote it
    nth = F.row_number().over(Window.partitionBy("key").orderBy("conv_id", "o_turn"))
    two = here.withColumn("nth", nth).filter("nth <= 2").groupBy("key")
    at = lambda k: F.min(F.when(F.col("nth") == k, F.struct("conv_id", "o_turn")))
    earliest = two.agg(at(1).alias("a"), at(2).alias("b"))
    quotes = quotes.withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int"))
    wanted = quotes.select("key").distinct()
    dealt = lambda df: df.join(wanted, "key", "left_semi").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = quotes.join(dealt(here), ["key", "salt", "conv_id"], "left").join(dealt(earliest), ["key", "salt"], "left")
    elsewhere = F.when(F.col("a.conv_id") != F.col("conv_id"), F.col("a")).otherwise(F.col("b"))
    origin = F.when(F.col("o_turn") < F.col("turn"), F.struct("conv_id", "o_turn")).when(F.col("turn").isNotNull() & F.col("conv_id").isNotNull(), elsewhere)
    return found.withColumn("origin", origin).drop("salt", "o_turn", "a", "b")


def link(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each message: ``conv_id, turn, role, reply_conv, reply_turn, n_quotes, n_linked, max_level, text``.

    ``text`` is the message without its quoted lines (outer blank lines off),
    ``n_quotes`` the number of quoted passages, ``n_linked`` of those whose
    original was found, ``max_level`` the deepest nesting. The original of a
    passage is the earliest message of the same conversation, before the quoting
    one, that wrote it as a paragraph, as a line, or as a whole run; failing
    that, the earliest by (conversation, turn) in another conversation. Of a passage
    that nobody wrote so (a trimmed one), each line and each sentence is looked for
    in the same way among all lines, sentences and passages written; the longest
    piece found in the same conversation, else the longest found elsewhere, gives
    the original (the first in order of equal ones). A cut within a sentence or, in
    text without sentence ends, within a line is not found. A message
    replies to the original of its outermost, first linked passage; without one,
    to the turn before its own, if there is such a message, else to nothing.

    The rows are in no order; ``in_reply_order`` sorts them.

    A null text is empty; a null conversation or turn links to nothing. Repeated
    rows are each returned and linked alike. Empty tables give empty results.
    Only the four columns are read. They are parsed once, into a written table of own
    text, hashes and quoted passages; its row numbers are the same for all that read it.
    """
    base = messages.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("raw"))
    parsed = base.withColumn("row", F.monotonically_increasing_id()).withColumn("runs", runs_of(F.col("raw")))
    own = F.array_join(F.transform(F.filter("runs", lambda r: r["level"] == 0), lambda r: r["body"]), "\n")

    owned = F.filter("runs", lambda r: r["level"] == 0)
    wrote = F.flatten(
        F.transform(
            owned,
            lambda r: F.concat(passages(r["body"]), passages(F.regexp_replace(r["body"], "\n", "\n\n")), passages(F.regexp_replace(r["body"], r"\n[ \t]*(?=\n)", ""))),
        )
    )
    parts = F.transform(F.flatten(F.transform(owned, lambda r: F.flatten(F.transform(paragraphs(r["body"]), pieces)))), digest)
    quoted = F.flatten(F.transform(F.filter("runs", lambda r: r["level"] > 0), lambda r: F.transform(paragraphs(r["body"]), lambda p: F.struct(r["level"].alias("level"), p.alias("part")))))
    parsed = parsed.select(
        "row", "conv_id", "turn", "role", F.regexp_replace(own, r"^(?:[ \t]*\n)+|(?:\n[ \t]*)+$", "").alias("text"),
        F.array_distinct(wrote).alias("wrote"), F.array_distinct(parts).alias("parts"), quoted.alias("quoted"))
    base, _ = written(parsed, "passages")
    known = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    by = lambda keys: base.filter(known).select("conv_id", "turn", F.explode(keys).alias("key"))

    quotes = base.select("row", "conv_id", "turn", F.posexplode("quoted").alias("place", "q")).select("row", "conv_id", "turn", "place", "q.level", "q.part")
    whole = originals(quotes.withColumn("key", digest(F.col("part"))), by(F.col("wrote")))

    trimmed = whole.filter(F.col("origin").isNull() & known)
    trimmed = trimmed.select("row", "conv_id", "turn", "place", F.posexplode(pieces(F.col("part"))).alias("nth", "piece"))
    trimmed = trimmed.select("row", "conv_id", "turn", "place", "nth", F.length("piece").alias("size"), digest(F.col("piece")).alias("key"))
    # the smallest of (elsewhere, -length, order): in the same conversation, the longest, the first
    rank = F.struct((F.col("origin.conv_id") != F.col("conv_id")).alias("elsewhere"), (-F.col("size")).alias("less"), "nth", "origin")
    rest = originals(trimmed, by(F.array_union("wrote", "parts"))).filter("origin is not null")
    rest = rest.groupBy("row", "place").agg(F.min(rank).alias("piece")).select("row", "place", F.col("piece.origin").alias("p_origin"))
    found = whole.join(rest, ["row", "place"], "left").withColumn("origin", F.coalesce("origin", "p_origin"))
    quoting = found.groupBy("row").agg(
        F.count("*").alias("n_quotes"),
        F.count("origin").alias("n_linked"),
        F.max("level").alias("max_level"),
        F.min(F.when(F.col("origin").isNotNull(), F.struct("level", "place", "origin"))).alias("best"),
    )
    before = base.select(F.col("conv_id").alias("p_conv"), F.col("turn").alias("p_turn")).distinct()
    before = before.withColumn("p_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = base.select("row", "conv_id", "turn", "role", "text")
    out = rows.join(quoting, "row", "left").withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int"))
    out = out.join(before, (F.col("conv_id") == F.col("p_conv")) & (F.col("turn") - 1 == F.col("p_turn")) & (F.col("salt") == F.col("p_salt")), "left")
    linked = F.col("best").isNotNull()
    return out.select(
        "conv_id",
        "turn",
        "role",
        F.when(linked, F.col("best.origin.conv_id")).otherwise(F.col("p_conv")).alias("reply_conv"),
        F.when(linked, F.col("best.origin.o_turn")).otherwise(F.col("p_turn")).alias("reply_turn"),
        F.coalesce("n_quotes", F.lit(0)).cast("bigint").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).cast("bigint").alias("n_linked"),
        F.coalesce("max_level", F.lit(0)).cast("bigint").alias("max_level"),
        "text",
    )


def in_reply_order(linked: DataFrame) -> DataFrame:
    """The rows of ``link`` sorted: each message after the one of its conversation that it answers.

    Conversations stand one after the other; in each, the messages that answer
    none of it come first (a link to another conversation gives no place in this
    one), then by the turn answered, so that answers to one message are together,
    and by turn. A message answers an earlier turn, so that turn's own row is
    before. Null conversations and turns come first, repeated rows together. The
    sort is dealt by ranges of all keys, so a conversation of any size is parted.
    """
    parent = F.when(F.col("reply_conv") == F.col("conv_id"), F.col("reply_turn"))
    # the last key parts rows that are the same in the others
    keyed = linked.withColumn("row", F.monotonically_increasing_id())
    return keyed.orderBy("conv_id", parent.asc_nulls_first(), "turn", "row").drop("row")


def op4_chat(spark, sf_dir):
    """All conversations, linked by their quotations, in reply order."""
    return in_reply_order(link(read(spark, sf_dir, "conversations")))


ORACLE_SQL = r"""
WITH m AS (SELECT row_number() OVER () AS rid, conv_id, turn, role, string_split(coalesce(text, ''), chr(10)) AS ls FROM conversations),
l AS (SELECT rid, conv_id, turn, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM m),
p AS (SELECT rid, conv_id, turn, i, length(replace(replace(regexp_extract(line, '^[ \t>]*>[ \t]?'), ' ', ''), chr(9), '')) AS level,
             regexp_replace(line, '^[ \t>]*>[ \t]?', '') AS body FROM l),
s AS (SELECT *, sum(CASE WHEN level = prev THEN 0 ELSE 1 END) OVER (PARTITION BY rid ORDER BY i) AS run
      FROM (SELECT *, lag(level) OVER (PARTITION BY rid ORDER BY i) AS prev FROM p)),
runs AS (SELECT rid, conv_id, turn, level, run, string_agg(body, chr(10) ORDER BY i) AS body FROM s GROUP BY rid, conv_id, turn, level, run),
pieces AS (SELECT rid, conv_id, turn, level, run, 0 AS way, unnest(regexp_split_to_array(body, '\n[ \t]*\n')) AS x, generate_subscripts(regexp_split_to_array(body, '\n[ \t]*\n'), 1) AS k FROM runs
           UNION ALL SELECT rid, conv_id, turn, level, run, 1, unnest(string_split(body, chr(10))), 0 FROM runs WHERE level = 0
           UNION ALL SELECT rid, conv_id, turn, level, run, 1, body, 0 FROM runs WHERE level = 0),
keys AS (SELECT *, trim(regexp_replace(lower(x), '\s+', ' ', 'g')) AS key FROM pieces),
q AS (SELECT rid, conv_id, turn, level, key, row_number() OVER (PARTITION BY rid ORDER BY run, k) AS place FROM keys WHERE level > 0 AND key <> ''),
w AS (SELECT key, conv_id, min(turn) AS o FROM keys WHERE level = 0 AND key <> '' AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY key, conv_id),
c AS (SELECT q.*, w.conv_id AS oc, w.o, row_number() OVER (PARTITION BY rid, place ORDER BY CASE WHEN w.conv_id = q.conv_id THEN 0 ELSE 1 END, w.conv_id, w.o) AS pick
      FROM q LEFT JOIN w ON q.key = w.key AND q.turn IS NOT NULL AND (w.conv_id <> q.conv_id OR w.o < q.turn)),
f AS (SELECT rid, count(*) AS n_quotes, count(oc) AS n_linked, max(level) AS max_level, min(CASE WHEN oc IS NOT NULL THEN {'l': level, 'p': place, 'c': oc, 't': o} END) AS best FROM c WHERE pick = 1 GROUP BY rid),
own AS (SELECT rid, string_agg(body, chr(10) ORDER BY i) AS t FROM s WHERE level = 0 GROUP BY rid),
prev AS (SELECT DISTINCT conv_id AS pc, turn AS pt FROM conversations)
SELECT m.conv_id, m.turn, m.role, CASE WHEN best IS NOT NULL THEN best.c ELSE pc END AS reply_conv, CASE WHEN best IS NOT NULL THEN best.t ELSE pt END AS reply_turn,
       CAST(coalesce(n_quotes, 0) AS BIGINT) AS n_quotes, CAST(coalesce(n_linked, 0) AS BIGINT) AS n_linked, CAST(coalesce(max_level, 0) AS BIGINT) AS max_level,
       regexp_replace(coalesce(own.t, ''), '^(?:[ \t]*\n)+|(?:\n[ \t]*)+$', '', 'g') AS text
FROM m LEFT JOIN f USING (rid) LEFT JOIN own USING (rid) LEFT JOIN prev ON m.conv_id = pc AND m.turn - 1 = pt
"""
