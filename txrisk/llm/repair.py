"""Conversation structure repair: cheapest edits by a square-root checkpointed DP.

A conversation's turns have faults (blank, seen earlier, cut off) and roles out of
order. Edits make the role initials ``(s?(ua)+)?``: keep a row (0), rerole it to
user or assistant (1), delete it (2, a must for blank and repeated rows), insert an
empty row (5); a cut-off row that stays costs 5 more. Four states tell which
initials may follow: nothing yet, after the system row, after user, after assistant.

The cheapest edits come from costs of what is left, so they are computed backwards,
while the ASCII-least of the cheapest edits are read off forwards. Backward costs of
every row would be kept for that; here they are kept only at every ``sqrt(n)``-th
row, and the rows between two checkpoints are computed again as the walk comes to
them. Of the edits D, I, K, R the first that loses nothing is taken.

What is dealt how: rows are put in order by one range partitioning over all
conversations, so a long one is dealt over many tasks, and are numbered by
partition and place. One letter a row says its fault and its initial; letters are
gathered in pieces of at most ``PIECE`` rows, pieces per conversation: a task that
repairs a conversation holds a byte a row, like the audit that it returns. Repeated
rows are found by the first place of each (conversation, role, text), a grouped
minimum that is joined back on salted keys. The digest of a conversation's text is
one sequential hash by definition: its rows stream through one task after the
audit, in batches, and are never gathered.

Defined results: a null conv_id, turn, role or text reads as one space where it is
hashed or written, and rows of null conv_id are one conversation; null turns come
first, rows of one turn by role and a hash of the text. An initial is a role's first code point,
whatever follows. A conversation of which the damage leaves no row gives zeros and
the digest of the empty string. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import SPACES, map_batches, read, ship, written
from txrisk.operators.features import join_group_stats

#: Rows whose letters are gathered at once.
PIECE = 4096
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5

#: Letters: fault (fine, cut off, blank, repeated) times initial (s, u, a, another).
FAULTS, INITIALS = "ftbd", "sua-"
LETTERS = "".join(chr(ord("A") + i) for i in range(len(FAULTS) * len(INITIALS)))

#: States and where a user or assistant row (kept, reroled or inserted) leads.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
#: What an inserted or reroled row is called in the state that it leads to.
ROLE = {USER: "user", ASSISTANT: "assistant"}
INFINITE = 1 << 60
#: Costs of finishing without a row left: one or two insertions, or none.
END = (0, 2 * INSERT, INSERT, 0)


def kept_state(state: int, initial: str) -> int | None:
    """Where a kept row of that initial leads, None if it may not stand here."""
    if initial == "s" and state == START:
        return SYSTEM
    if initial == "u" and state != USER or initial == "a" and state == USER:
        return NEXT[state]
    return None


def moves(letter: str, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) for a row that is used up, in ASCII order of the edits."""
    fault, initial = FAULTS[LETTERS.index(letter) // 4], INITIALS[LETTERS.index(letter) % 4]
    out = [("D", DELETE, state)]
    if fault in "ft":
        more = CUT_OFF if fault == "t" else 0
        to = kept_state(state, initial)
        if to is not None:
            out.append(("K", KEEP + more, to))
        out.append(("R", REROLE + more, NEXT[state]))
    return out


MOVES = {letter: [moves(letter, s) for s in range(4)] for letter in LETTERS}


def before(letter: str, after: tuple) -> tuple:
    """Costs from the four states before a row, given those after it."""
    used = [min(cost + after[to] for _, cost, to in MOVES[letter][s]) for s in range(4)]
    # rows may be inserted first; after three the states repeat
    for _ in range(3):
        used = [min(used[s], INSERT + used[NEXT[s]]) for s in range(4)]
    return tuple(used)


class Costs:
    """Backward steps by table: relative costs take few values, so each (row, costs)
    is computed once."""

    def __init__(self):
        self.known: dict = {}

    def step(self, letter: str, after: tuple) -> tuple[tuple, int]:
        """Costs before the row less their least, and that least."""
        found = self.known.get((letter, after))
        if found is None:
            costs = before(letter, after)
            least = min(costs)
            found = self.known[letter, after] = (tuple(c - least for c in costs), least)
        return found


def repair(letters: str, costs: Costs | None = None) -> tuple[int, str]:
    """Cost and ASCII-least cheapest edits of a conversation."""
    costs = costs or Costs()
    n = len(letters)
    gap = isqrt(n) + 1
    checkpoints, at, total = {n: END}, END, 0
    for i in range(n - 1, -1, -1):
        at, least = costs.step(letters[i], at)
        total += least
        if i % gap == 0:
            checkpoints[i] = at
    cost, edits, state = total + at[START], [], START
    for lo in range(0, n, gap):
        hi = min(n, lo + gap)
        block = [(checkpoints[hi], 0)]  # costs after each row of the block, last row first
        for i in range(hi - 1, lo - 1, -1):
            block.append(costs.step(letters[i], block[-1][0]))
        for i in range(lo, hi):
            (here, least), (after, _) = block[hi - i], block[hi - i - 1]
            while True:
                left = here[state] + least
                tight = {edit: to for edit, cost, to in MOVES[letters[i]][state] if cost + after[to] == left}
                if "D" in tight:
                    edits.append("D")
                    break
                if INSERT + here[NEXT[state]] + least == left:
                    edits.append("I")
                    state = NEXT[state]
                    continue
                edit = min(tight)
                edits.append(edit)
                state = tight[edit]
                break
    while END[state]:
        edits.append("I")
        state = NEXT[state]
    return cost, "".join(edits)


def illegal(letters: str) -> int:
    """Adjacent initials that are not su, ua or au."""
    initials = [INITIALS[LETTERS.index(c) % 4] for c in letters]
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def damaged(rows: DataFrame) -> DataFrame:
    """The rows (conv, turn, role, text, copy) after the damage: by crc32 of
    ``conv_id:turn`` modulo 20 a row is dropped (0), emptied (1), loses ``[.!?]``
    (2), is repeated (3), or is said by the user (4)."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hurt = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    one = rows.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), shown("role").alias("r"), shown("text").alias("t"), hurt.alias("hurt"))
    text = F.when(F.col("hurt") == 1, "").when(F.col("hurt") == 2, F.translate("t", ".!?", "")).otherwise(F.col("t"))
    role = F.when(F.col("hurt") == 4, "user").otherwise(F.col("r"))
    copies = F.when(F.col("hurt") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return one.filter("hurt <> 0").select("conv", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy"))


def lettered(rows: DataFrame) -> DataFrame:
    """(conv, at, turn, role, text, key, own): rows in order of ``at`` by conversation
    and turn; ``key`` is one of conversation, role and text, ``own`` the place of the
    row's own fault in ``FAULTS``, which its being repeated comes after."""
    order = ["conv", "turn", "role", F.xxhash64("text"), "copy"]
    key = F.sha2(F.concat_ws("\n", F.coalesce(F.col("conv").cast("string"), F.lit(" ")), F.length("role").cast("string"), "role", "text"), 256)
    solid = F.rtrim(F.col("text"), F.lit(SPACES))
    own = F.when(F.length(solid) == 0, 2).when(~F.substring(solid, -1, 1).isin(".", "!", "?"), 1).otherwise(0)
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.select("conv", F.monotonically_increasing_id().alias("at"), "turn", "role", "text", key.alias("key"), own.alias("own"))


def with_letter(rows: DataFrame) -> DataFrame:
    """(conv, at, letter): a row whose key comes earlier, and that isn't blank, is a
    repeated one."""
    slim = rows.select("conv", "at", "key", "own", F.substring("role", 1, 1).alias("initial"))
    first = slim.groupBy("key").agg(F.min("at").alias("first"))
    which = F.when((F.col("own") != 2) & (F.col("at") > F.col("first")), 3).otherwise(F.col("own"))
    initial = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    return join_group_stats(slim, first, "key").select("conv", "at", F.substring(F.lit(LETTERS), which * 4 + initial + 1, F.lit(1)).alias("letter"))


def sequences(rows: DataFrame) -> DataFrame:
    """(conv, letters): a conversation's letters in order, gathered in pieces."""
    def joined(of: str, by: str) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(by, of))), lambda s: s[of]), "")

    pieces = rows.groupBy("conv", F.shiftright("at", PIECE.bit_length() - 1).alias("piece")).agg(joined("letter", "at").alias("some"))
    return pieces.groupBy("conv").agg(joined("some", "piece").alias("letters"))


def _repaired(columns: tuple) -> object:
    def make():
        costs = Costs()

        def run(batch: pa.RecordBatch) -> list[pa.Array]:
            out = []
            for letters in batch.column(batch.schema.get_field_index("letters")).to_pylist():
                count = [sum(letters.count(c) for c in LETTERS[4 * f: 4 * f + 4]) for f in range(4)]
                out.append((count[2], count[3], count[1], illegal(letters), *repair(letters, costs)))
            return [pa.array([o[i] for o in out], kind) for i, kind in enumerate(columns)]

        return run

    return make


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation the digest of its repaired rows: the audit comes first, the rows follow in order."""
    at, audit, done, state, digest, lines = None, "", 0, START, None, 0
    names, found = [], []

    def put(line: str) -> None:
        nonlocal lines
        digest.update((("\n" if lines else "") + line).encode())
        lines += 1

    def inserts() -> None:
        nonlocal done, state
        while done < len(audit) and audit[done] == "I":
            state = NEXT[state]
            put(f"{ROLE[state]}:")
            done += 1

    for batch in batches:
        for conv, header, role, text, edits in zip(*(c.to_pylist() for c in batch.columns)):
            if header:
                if digest is not None:
                    inserts()
                    names.append(at)
                    found.append(digest.hexdigest())
                at, audit, done, state, digest, lines = conv, edits, 0, START, hashlib.sha256(), 0
                continue
            inserts()
            edit, done = audit[done], done + 1
            if edit == "K":
                state = kept_state(state, role[:1])
                put(f"{role}:{text}")
            elif edit == "R":
                state = NEXT[state]
                put(f"{ROLE[state]}:{text}")
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(found, pa.string())], names=["conv", "repaired_sha256"])
            names, found = [], []
    if digest is not None:
        inserts()
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([digest.hexdigest()], pa.string())], names=["conv", "repaired_sha256"])


def repaired(conversations: DataFrame) -> DataFrame:
    """One row per conversation of ``conversations`` (conv_id, turn, role, text)
    after the damage: faults, cost, audit and the digest of the repaired text."""
    spark = conversations.sparkSession
    ship(spark)
    source = conversations.select("conv_id", "turn", "role", "text")
    rows, _ = written(lettered(damaged(source)), "turns")

    numbers = "blank long, duplicate long, truncated long, illegal long, cost long, audit string"
    kinds = (*[pa.int64()] * 5, pa.string())
    audits, _ = written(map_batches(sequences(with_letter(rows)), ["conv"], numbers, _repaired(kinds)), "audits")

    text = rows.select("conv", F.lit(False).alias("header"), "at", "role", "text", F.lit(None).cast("string").alias("audit"))
    header = audits.select("conv", F.lit(True).alias("header"), F.lit(-1).cast("long").alias("at"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "audit")
    stream = header.unionByName(text).repartition("conv").sortWithinPartitions("conv", "at").select("conv", "header", "role", "text", "audit")
    digests = stream.mapInArrow(_digests, "conv long, repaired_sha256 string")

    turns = rows.groupBy("conv").agg(F.min("turn").alias("lo"), F.max("turn").alias("hi"), F.countDistinct("turn").alias("n"))
    gaps = turns.select("conv", F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("n"), F.lit(0)).alias("gaps"))

    # one row a conversation on every side; null conv_ids are one conversation
    named = lambda df: df.withColumn("key", F.coalesce(F.col("conv").cast("string"), F.lit(" ")))
    every = named(source.select(F.col("conv_id").cast("long").alias("conv")).distinct())
    out = every
    for part in (gaps, audits, digests):
        out = out.join(named(part).drop("conv"), "key", "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = hashlib.sha256(b"").hexdigest()
    return out.select(F.col("conv").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))


def op13_repair(spark, sf_dir):
    """The repaired conversations of the whole table."""
    return repaired(read(spark, sf_dir, "conversations"))


#: The same rules in SQL, step by step over all conversations at once.
ORACLE_SQL = """
WITH RECURSIVE shown AS MATERIALIZED (
  SELECT conv_id AS conv, turn, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name,
         coalesce(role, ' ') AS role, coalesce(text, ' ') AS text
  FROM conversations),
hurt AS MATERIALIZED (
  SELECT *, xor(list_reduce(list_transform(range(1, length(name) + 1), lambda i: CAST(ascii(name[i]) AS BIGINT)),
                lambda crc, b: list_reduce(range(0, 8), lambda c, k: xor(c >> 1, (c & 1) * 3988292384), xor(crc, b)),
                4294967295), 4294967295) % 20 AS h
  FROM shown),
after AS MATERIALIZED (
  SELECT conv, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN h = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM hurt WHERE h <> 0),
placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid
  FROM after),
judged AS MATERIALIZED (
  SELECT conv, turn, role, text, i, role[1] AS initial,
         CASE WHEN solid = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 'd'
              WHEN solid[-1] NOT IN ('.', '!', '?') THEN 't' ELSE 'f' END AS fault,
         coalesce(lag(role[1]) OVER (PARTITION BY conv ORDER BY i) || role[1] NOT IN ('su', 'ua', 'au'), false) AS illegal
  FROM placed),
counts AS MATERIALIZED (
  SELECT conv, count(*) AS n, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
         count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (illegal) AS illegal,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps
  FROM judged GROUP BY conv),
costs(conv, i, v) AS (
  SELECT conv, n + 1, [0, 10, 5, 0] FROM counts
  UNION ALL
  SELECT conv, i, [least(u0, 5 + u2, 10 + u3), least(u1, 5 + u2, 10 + u3), least(u2, 5 + u3), least(u3, 5 + u2)]
  FROM (
    SELECT conv, i,
           least(2 + v[1], CASE WHEN stay AND initial = 's' THEN v[2] + t WHEN stay AND initial = 'u' THEN v[3] + t END, CASE WHEN stay THEN 1 + t + v[3] END) AS u0,
           least(2 + v[2], CASE WHEN stay AND initial = 'u' THEN v[3] + t END, CASE WHEN stay THEN 1 + t + v[3] END) AS u1,
           least(2 + v[3], CASE WHEN stay AND initial = 'a' THEN v[4] + t END, CASE WHEN stay THEN 1 + t + v[4] END) AS u2,
           least(2 + v[4], CASE WHEN stay AND initial = 'u' THEN v[3] + t END, CASE WHEN stay THEN 1 + t + v[3] END) AS u3
    FROM (SELECT c.conv, j.i, c.v, j.initial, j.fault IN ('f', 't') AS stay, CASE WHEN j.fault = 't' THEN 5 ELSE 0 END AS t
          FROM costs c JOIN judged j ON c.conv IS NOT DISTINCT FROM j.conv AND j.i = c.i - 1))),
kept_costs AS MATERIALIZED (SELECT * FROM costs),
walk(conv, step, i, state, edit, line) AS (
  SELECT conv, 0, CAST(1 AS BIGINT), 1, '', CAST(NULL AS VARCHAR) FROM counts
  UNION ALL
  SELECT conv, step + 1, CASE WHEN e = 'I' THEN i ELSE i + 1 END,
         CASE WHEN e = 'D' THEN state WHEN e = 'K' AND initial = 's' THEN 2 ELSE [3, 3, 4, 3][state] END, e,
         CASE e WHEN 'D' THEN NULL WHEN 'K' THEN role || ':' || text
                ELSE CASE WHEN state = 3 THEN 'assistant:' ELSE 'user:' END || CASE WHEN e = 'R' THEN text ELSE '' END END
  FROM (
    SELECT w.conv, w.step, w.i, w.state, j.role, j.text, j.initial,
           CASE WHEN j.i IS NULL THEN 'I'
                WHEN 2 + b.v[w.state] = a.v[w.state] THEN 'D'
                WHEN 5 + a.v[[3, 3, 4, 3][w.state]] = a.v[w.state] THEN 'I'
                WHEN a.v[w.state] = CASE WHEN j.fault = 't' THEN 5 ELSE 0 END
                     + CASE WHEN j.initial = 's' AND w.state = 1 THEN b.v[2] WHEN j.initial = 'u' AND w.state <> 3 THEN b.v[3]
                            WHEN j.initial = 'a' AND w.state = 3 THEN b.v[4] END THEN 'K'
                ELSE 'R' END AS e
    FROM walk w
    JOIN kept_costs a ON w.conv IS NOT DISTINCT FROM a.conv AND w.i = a.i
    LEFT JOIN kept_costs b ON w.conv IS NOT DISTINCT FROM b.conv AND b.i = w.i + 1
    LEFT JOIN judged j ON w.conv IS NOT DISTINCT FROM j.conv AND j.i = w.i
    WHERE j.i IS NOT NULL OR w.state IN (2, 3))),
told AS (
  SELECT conv, coalesce(string_agg(edit, '' ORDER BY step), '') AS audit, sha256(coalesce(string_agg(line, chr(10) ORDER BY step), '')) AS digest
  FROM walk GROUP BY conv)
SELECT o.conv AS conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
       coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, CAST(coalesce(k.v[1], 0) AS BIGINT) AS cost,
       coalesce(t.audit, '') AS audit, coalesce(t.digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv FROM shown) o
LEFT JOIN counts c ON o.conv IS NOT DISTINCT FROM c.conv
LEFT JOIN kept_costs k ON o.conv IS NOT DISTINCT FROM k.conv AND k.i = 1
LEFT JOIN told t ON o.conv IS NOT DISTINCT FROM t.conv
"""
