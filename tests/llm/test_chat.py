"""Quotation links on a worked thread, and against the SQL twin."""

from __future__ import annotations

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from tests.llm.helpers import with_clashes
from txrisk.llm import chat

ROWS = [
    (1, 0, "u", "Hello  World\nsecond line\n\nA new para."),
    (1, 1, "a", "> hello world\n> second line\n\nI agree."),
    (1, 2, "u", ">> Hello world\n>> second line\n> I agree.\n\nthanks"),
    (1, 4, "a", "> second line\nonly a line\n> nowhere to be found"),
    (2, 0, "u", "> A new para.\nfrom elsewhere\n\n\n"),
    (2, 1, "a", ">\n> \n"),
    (2, 2, None, None),
    (2, 3, "u", ""),
    (None, 1, "x", "> I agree."),
    (3, None, "x", "> I agree.\nI agree."),
    (3, 1, "q", "I agree."),
    (3, 2, "q", "> > I agree.\n>>>deep\n \tx\n\t>tab"),
    (3, 2, "q", "> > I agree.\n>>>deep\n \tx\n\t>tab"),
    (4, 0, "u", "deep"),
    (4, 1, "u", "> thanks\n> \n> thanks\nok"),
    (5, 0, "u", "thanks"),
    (6, 0, "u", "> " * 3000 + "far\n" + "line\n" * 20_000),
]
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def test_worked_thread(spark):
    out = {(r.conv_id, r.turn, r.n_quotes): r for r in chat.link(with_clashes(spark.createDataFrame(ROWS, SCHEMA))).collect()}
    a = out[(1, 1, 1)]
    assert (a.reply_conv, a.reply_turn, a.n_linked, a.max_level, a.text) == (1, 0, 1, 1, "I agree.")
    b = out[(1, 2, 2)]  # answers the author of its outermost quotation
    assert (b.reply_conv, b.reply_turn, b.n_linked, b.max_level, b.text) == (1, 1, 2, 2, "thanks")
    c = out[(1, 4, 2)]  # a single line of a longer message; no previous turn
    assert (c.reply_turn, c.n_linked, c.text) == (0, 1, "only a line")
    d = out[(2, 0, 1)]  # from another conversation
    assert (d.reply_conv, d.reply_turn, d.text) == (1, 0, "from elsewhere")
    assert out[(2, 1, 0)].reply_turn == 0 and out[(2, 3, 0)].reply_turn == 2 and out[(2, 2, 0)].text == ""
    assert out[(3, None, 1)].reply_conv is None and out[(None, 1, 1)].n_linked == 0
    far = out[(6, 0, 1)]
    assert far.max_level == 3000 and far.text.count("line") == 20_000


def test_reply_order_puts_answers_after_what_they_answer(spark):
    rows = [r for r in chat.link(spark.createDataFrame(ROWS[:4], SCHEMA)).collect()]
    order = sorted(rows, key=lambda r: (-1 if r.reply_turn is None else r.reply_turn, r.turn))
    seen = set()
    for r in order:
        assert r.reply_turn is None or r.reply_turn in seen
        seen.add(r.turn)


def test_equals_sql_twin(spark):
    rows = ROWS[:-1]
    got = chat.link(spark.createDataFrame(rows, SCHEMA)).toPandas().convert_dtypes()
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"}))
    want = con.execute(chat.ORACLE_SQL).df().convert_dtypes()
    cols = list(got.columns)
    flat = lambda d: (tuple(None if pd.isna(v) else str(v) for v in r) for r in d[cols].itertuples(index=False))
    assert sorted(map(str, flat(got))) == sorted(map(str, flat(want)))


def test_empty_table_and_plan(spark):
    assert chat.link(spark.createDataFrame([], SCHEMA)).count() == 0
    plan = chat.op4_chat(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_reply_order_with_links_to_other_conversations(spark):
    rows = [
        (1, 0, "u", "one start"),
        (1, 1, "a", "> from two, late\nan answer elsewhere"),
        (1, 2, "u", "> an answer elsewhere\nthird"),
        (1, 3, "a", "> one start\nfourth"),
        (1, 4, "u", "> third\nfifth"),
        (2, 3, "u", "> one start\nlinks to one"),
        (2, 50, "u", "from two, late"),
        (2, 51, "a", "> links to one\nlast"),
    ]
    got = chat.in_reply_order(chat.link(spark.createDataFrame(rows, SCHEMA).repartition(5))).collect()
    assert [(r.conv_id, r.turn) for r in got] == [(1, 0), (1, 1), (1, 3), (1, 2), (1, 4), (2, 3), (2, 50), (2, 51)]
    assert {(r.conv_id, r.turn): (r.reply_conv, r.reply_turn) for r in got}[1, 1] == (2, 50)
    seen = set()
    for r in got:
        assert r.reply_conv != r.conv_id or (r.conv_id, r.reply_turn) in seen
        seen.add((r.conv_id, r.turn))


def test_query_is_in_reply_order(spark):
    got = chat.op4_chat(spark, "/root/testdata/sf0.001").collect()
    parent = [r.reply_turn if r.reply_conv == r.conv_id and r.reply_turn is not None else -1 for r in got]
    keys = [(r.conv_id, p, r.turn) for r, p in zip(got, parent)]
    assert keys == sorted(keys)


def test_trimmed_quotations_are_found_by_their_pieces(spark):
    rows = [
        (1, 0, "u", "line one\nline two\nline three\n\nA second paragraph. It has two sentences,\none over lines! And more."),
        (1, 1, "a", "something else"),
        (1, 2, "u", "ok"),
        (1, 3, "a", "not this"),
        (1, 4, "u", "nor this"),
        (1, 5, "a", "> line one\n> line two\ntwo of three lines"),
        (1, 6, "u", "> line three\n> A second paragraph. It has two sentences,\nwithout the blank line"),
        (1, 7, "a", "> A second paragraph.\na sentence within a line"),
        (1, 8, "u", "> It has two\n> sentences, one over lines!\nwrapped anew"),
        (1, 9, "a", "> ok\n> line two\nthe longest piece decides"),
        (1, 10, "u", "> never written\n> by anybody\nto the turn before"),
        (2, 0, "u", "> line two\n> line three\nfrom elsewhere"),
    ]
    out = {(r.conv_id, r.turn): (r.reply_conv, r.reply_turn, r.n_quotes, r.n_linked) for r in chat.link(with_clashes(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert all(out[1, t] == (1, 0, 1, 1) for t in (5, 6, 7, 8, 9)), out
    assert out[1, 10] == (1, 9, 1, 0) and out[2, 0] == (1, 0, 1, 1)


def test_links_are_the_same_however_the_rows_come(spark):
    rows = [(c, t, "u", f"> Passage {c}-{t - 1} of it\nPassage {c}-{t} of it" if t else f"Passage {c}-0 of it") for c in range(40) for t in range(5)]
    want = {(c, t): (c if t else None, t - 1 if t else None, 1 if t else 0, f"Passage {c}-{t} of it") for c, t, _, _ in rows}
    df = spark.createDataFrame(rows, SCHEMA)
    for given in (df, df.repartition(8), df.orderBy(F.rand(3))):
        got = {(r.conv_id, r.turn): (r.reply_conv, r.reply_turn, r.n_linked, r.text) for r in chat.link(given).collect()}
        assert got == want


def test_a_passage_that_many_conversations_wrote(spark):
    """The earliest other conversation, whichever one quotes."""
    rows = [(c, 0, "u", "A common line.") for c in range(300)] + [(c, 1, "a", "> A common line.\nyes") for c in (0, 7)] + [(500, 0, "u", "> A common line.\nno")]
    got = {(r.conv_id, r.turn): (r.reply_conv, r.reply_turn) for r in chat.link(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (got[0, 1], got[7, 1], got[500, 0]) == ((0, 0), (7, 0), (0, 0))
    late = [(c, 3, "u", "A common line.") for c in range(9)] + [(0, 1, "a", "> A common line."), (8, 1, "a", "> A common line.")]
    got = {(r.conv_id, r.turn): (r.reply_conv, r.reply_turn) for r in chat.link(spark.createDataFrame(late, SCHEMA)).collect()}
    assert (got[0, 1], got[8, 1]) == ((1, 3), (0, 3))
