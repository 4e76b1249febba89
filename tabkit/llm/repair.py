"""Conversation repair: weighted CYK interval parsing with a repair grammar.

The roles of a sound conversation spell ``(s?(ua)+)?``: nothing, or an optional system turn
and pairs of user and assistant.  With the automaton's four states START, S, U and A as
ends, the repair grammar in Chomsky normal form has one nonterminal [p,q] for each pair of
states, what a span of rows can be edited into so as to lead from p to q, and the rules

    [p,q] -> [p,r] [r,q]     for every state r between,
    [p,q] -> row             keep, rerole or delete it, behind any cheapest inserted turns.

A cell holds the least (cost, audit) of its nonterminal, ``audit`` being the edits' initials
in order.  Equal costs never leave one audit as the head of another (the tail would be
inserted turns, which cost), so the least of two spans joined is the join of their least.
As r runs over all states, every split of a span yields the same cells: one split a span is
enough, and the chart is built bottom-up over spans of 1, 2, 4, ... rows.

Nothing gathers a conversation.  Narrow rows (no texts) are sorted over all tasks by
conversation and turn; a task parses the runs that it holds, and the cells of a long
conversation's runs are joined as any other spans are.  The texts are shuffled once, stream
behind their conversation's audit in order, and are edited one by one.

Defined results: rows go by turn, missing turns first, rows of one turn by role, then by a
digest of role and text.  NULL role or text counts as one space.  Rows without conversation
id form one conversation.  Roles count by their first letter; other letters, and an empty
role, can only be replaced.  An empty table gives no rows.  Columns other than the four
named are never read.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.llm.common import query, reach_package, slices, table
from tabkit.session import materialize

# Costs of the edits: fixed values of the repair grammar.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
# States of the automaton: nothing yet, behind system, user, assistant.  Those to end in.
START, S, U, A = range(4)
STATES, ENDS = range(4), (START, A)
MOVES = {(START, "s"): S, (START, "u"): U, (S, "u"): U, (U, "a"): A, (A, "u"): U}
NEIGHBOURS = ("su", "ua", "au")
# Rows as codes: first letter of the role (x: any other) by fault.
LETTERS, FAULTS = "suax", ("none", "blank", "duplicate", "truncated")
# Few repeated turns are broadcast, by count; beyond it Spark joins and splits hot keys.
BROADCAST_KEYS = 200_000
BLANK = r"[^\x20\x09-\x0D]"
SPACE = " \t\n\x0b\x0c\r"

Cells = tuple  # 16 times (cost, audit) or None, by START state and end state


def join(left: Cells, right: Cells) -> Cells:
    """The cells of two neighbouring spans' union: [p,q] -> [p,r] [r,q]."""
    out = []
    for p in STATES:
        for q in STATES:
            best = None
            for r in STATES:
                a, b = left[4 * p + r], right[4 * r + q]
                if a is not None and b is not None:
                    cost = a[0] + b[0]
                    if best is None or cost < best[0] or (cost == best[0] and a[1] + b[1] < best[1]):
                        best = (cost, a[1] + b[1])
            out.append(best)
    return tuple(out)


def _closure() -> Cells:
    """Cheapest inserted turns, none included, between every two states."""
    cells = [(0, "") if p == q else None for p in STATES for q in STATES]
    for (p, letter), q in MOVES.items():
        if letter in "ua":
            cells[4 * p + q] = (INSERT, "I")
    closed = tuple(cells)
    while (longer := join(closed, closed)) != closed:
        closed = longer
    return closed


INSERTED = _closure()


@lru_cache(maxsize=None)
def leaf(code: int) -> Cells:
    """Cells of one row: its edits behind any inserted turns."""
    letter, fault = LETTERS[code // 4], FAULTS[code % 4]
    cells: list = [None] * 16

    def offer(p: int, q: int, edit: tuple[int, str]) -> None:
        if cells[4 * p + q] is None or edit < cells[4 * p + q]:
            cells[4 * p + q] = edit

    for p in STATES:
        offer(p, p, (DELETE, "D"))
        if fault in ("none", "truncated"):
            more = TRUNCATED if fault == "truncated" else 0
            for role in "ua":
                if (p, role) in MOVES:
                    offer(p, MOVES[p, role], (REROLE + more, "R"))
            if (p, letter) in MOVES:
                offer(p, MOVES[p, letter], (KEEP + more, "K"))
    return join(INSERTED, tuple(cells))


class Chart:
    """Cells of the spans of a run of rows, bottom-up; spans of equal length are joined at once."""

    def __init__(self):
        self.spans: list[tuple[int, Cells]] = []

    def add(self, cells: Cells) -> None:
        length = 1
        while self.spans and self.spans[-1][0] == length:
            cells = join(self.spans.pop()[1], cells)
            length *= 2
        self.spans.append((length, cells))

    def whole(self) -> Cells | None:
        """The cells of all rows together; None without rows."""
        cells = None
        for _, left in reversed(self.spans):
            cells = left if cells is None else join(left, cells)
        return cells


def cheapest(cells: Cells | None) -> tuple[int, str]:
    """(cost, audit) of a whole conversation, turns inserted behind its last row included."""
    if cells is None:
        return 0, ""
    closed = join(cells, INSERTED)
    return min(closed[4 * START + q] for q in ENDS if closed[4 * START + q] is not None)


class Run:
    """What consecutive rows of one conversation add up to; runs in order can be joined."""

    COUNTS = ("n", "blank", "duplicate", "truncated", "illegal", "turns")

    def __init__(self):
        self.n = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = ""
        self.low = self.high = None
        self.chart = Chart()

    def _meet(self, first: str, last: str, low, high) -> None:
        if self.n and self.last + first not in NEIGHBOURS:
            self.illegal += 1
        self.first, self.last = (self.first if self.n else first), last
        if low is not None:
            self.turns -= self.high == low
            self.low, self.high = (low if self.low is None else self.low), high

    def add(self, code: int, turn) -> None:
        letter, fault = LETTERS[code // 4], code % 4
        self._meet(letter, letter, turn, turn)
        self.turns += turn is not None
        self.n += 1
        self.blank += fault == 1
        self.duplicate += fault == 2
        self.truncated += fault == 3
        self.chart.add(leaf(code))

    def append(self, run: dict) -> None:
        """Join a later run, as ``record`` gives it."""
        self._meet(run["first"], run["last"], run["low"], run["high"])
        for name in self.COUNTS:
            setattr(self, name, getattr(self, name) + run[name])
        self.chart.add(tuple(None if c is None else (c, a) for c, a in zip(run["costs"], run["audits"])))

    def record(self) -> dict:
        cells = self.chart.whole()
        return {name: getattr(self, name) for name in self.COUNTS} | {
            "first": self.first, "last": self.last, "low": self.low, "high": self.high,
            "costs": [c and c[0] for c in cells], "audits": [c and c[1] for c in cells],
        }

    def report(self) -> dict:
        cost, audit = cheapest(self.chart.whole())
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {
            "gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
            "illegal": self.illegal, "cost": cost, "audit": audit,
        }


RUN_SCHEMA = (
    "n long, blank long, duplicate long, truncated long, illegal long, turns long, first string, last string, "
    "low long, high long, costs array<long>, audits array<string>"
)
REPORT_SCHEMA = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _emit(records: list[dict], schema: pa.Schema):
    """Records as batches of some thousand rows."""
    for at in range(0, len(records), 4096):
        yield pa.RecordBatch.from_pylist(records[at : at + 4096], schema)


def _runs(df: DataFrame, start, take, done: str, schema: str) -> DataFrame:
    """One row for each run of equal ``conv_id`` in the order that rows come; see ``parse``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kind = df.schema["conv_id"].dataType.simpleString()
    out = StructType.fromDDL(f"conv_id {kind}, row long, {schema}")
    arrow = to_arrow_schema(out)

    def run(batches):
        now, at, current, found = None, None, None, []
        for batch in batches:
            for rows in slices_of(batch):
                for r in rows:
                    if current is None or r["conv_id"] != now:
                        if current is not None:
                            found.append({"conv_id": now, "row": at} | getattr(current, done)())
                        now, at, current = r["conv_id"], r["row"], start()
                    take(current, r)
                yield from _emit(found, arrow)
                found = []
        if current is not None:
            yield from _emit([{"conv_id": now, "row": at} | getattr(current, done)()], arrow)

    return df.mapInArrow(run, out)


def slices_of(batch: pa.RecordBatch, rows: int = 4096):
    """The rows of a batch as dictionaries, some thousand at once."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows).to_pylist()


def prepared(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """conv_id, turn, role, text, a digest of role and text, and the code as far as one row tells."""
    named = [F.coalesce(F.col(f"`{c}`"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))]
    rows = turns.select(F.col(f"`{conv}`").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"), *named)
    letter = F.substring("role", 1, 1)
    known = F.when(letter == "", 3).otherwise(F.coalesce(F.nullif(F.instr(F.lit("sua"), letter), F.lit(0)) - 1, F.lit(3)))
    end = F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1)
    fault = F.when(~F.col("text").rlike(BLANK), 1).when(~end.isin(".", "!", "?"), 3).otherwise(0)
    same = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    return rows.withColumns({"same": same, "code": (known * 4 + fault).cast("int")})


ORDER = ["conv_id", "turn", "role", "same"]


def parse(rows: DataFrame) -> DataFrame:
    """One row a conversation of ``prepared`` rows: counts, cost and audit."""
    narrow = rows.select(*ORDER, "code").repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    # within a task the numbers follow one another, and tasks follow the ranges
    turns = materialize(narrow.withColumn("row", F.monotonically_increasing_id()), "turns")
    firsts = turns.groupBy("conv_id", "same").agg(F.min("row").alias("earliest"), F.count("*").alias("many"))
    firsts = materialize(firsts.filter("many > 1").drop("many"), "repeated")
    if firsts.count() <= BROADCAST_KEYS:
        firsts = F.broadcast(firsts)
    known = firsts.select(F.col("conv_id").alias("of"), F.col("same").alias("what"), "earliest")
    both = turns.join(known, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("same") == F.col("what")), "left")
    again = (F.col("row") > F.col("earliest")) & (F.col("code") % 4 != 1)
    told = both.select("conv_id", "turn", "row", F.when(again, F.col("code") - F.col("code") % 4 + 2).otherwise(F.col("code")).alias("code"))
    dealt = told.repartition(F.shiftright("row", 33)).sortWithinPartitions("row")
    runs = _runs(dealt, Run, lambda run, r: run.add(r["code"], r["turn"]), "record", RUN_SCHEMA)
    ordered = runs.repartition("conv_id").sortWithinPartitions("conv_id", "row")
    return _runs(ordered, Run, Run.append, "report", REPORT_SCHEMA).drop("row")


class Editor:
    """Applies an audit to the rows of a conversation as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.place = audit, 0, 0
        self.odd = (len(audit) - audit.count("D")) % 2  # only with a system turn ahead

    def _role(self) -> str:
        """Role of the next turn, by its place: user and assistant take turns."""
        return "assistant" if (self.place - self.odd) % 2 else "user"

    def inserted(self):
        """(place, edit, role, text) of the turns inserted here."""
        while self.audit[self.at : self.at + 1] == "I":
            yield self.place, "I", self._role(), ""
            self.at += 1
            self.place += 1

    def row(self, role: str, text: str):
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            yield self.place, edit, role if edit == "K" else self._role(), text
            self.place += 1


def edited(rows: DataFrame, report: DataFrame) -> DataFrame:
    """The repaired turns (conv_id, place, edit, role, text), each conversation's in one piece, in order."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    reach_package(rows.sparkSession)
    audits = report.select("conv_id", F.lit(0).alias("kind"), *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ORDER[1:]], F.col("audit").alias("text"))
    texts = rows.select("conv_id", F.lit(1).alias("kind"), *ORDER[1:], "text")
    stream = audits.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *ORDER[1:])
    kind = rows.schema["conv_id"].dataType.simpleString()
    out = StructType.fromDDL(f"conv_id {kind}, place long, edit string, role string, text string")
    arrow = to_arrow_schema(out)

    def run(batches):
        now, editor, found = None, Editor(""), []
        for batch in batches:
            for part in slices(batch, 3):
                for r in part.to_pylist():
                    if r["kind"] == 0:
                        found += [(now, *t) for t in editor.inserted()]
                        now, editor = r["conv_id"], Editor(r["text"])
                    else:
                        found += [(now, *t) for t in editor.row(r["role"], r["text"])]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), arrow)], schema=arrow)
                found = []
        found = [(now, *t) for t in editor.inserted()]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), arrow)], schema=arrow)

    return stream.select("conv_id", "kind", "role", "text").mapInArrow(run, out)


def repair(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(report, repaired turns): one row a conversation with its faults, cost and audit; and its turns."""
    reach_package(turns.sparkSession)
    rows = prepared(turns, conv, turn, role, text)
    report = materialize(parse(rows), "report")
    return report, edited(rows, report)


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of its ``role:text`` lines, of turns as ``edited`` hands them on.

    A digest runs over the whole conversation, turn by turn, so no text is kept.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kind = repaired.schema["conv_id"].dataType.simpleString()
    out = StructType.fromDDL(f"conv_id {kind}, repaired_sha256 string")
    arrow = to_arrow_schema(out)

    def run(batches):
        now, digest, found = None, None, []
        for batch in batches:
            for part in slices(batch, 3):
                for r in part.to_pylist():
                    if r["place"] == 0:
                        if digest is not None:
                            found.append({"conv_id": now, "repaired_sha256": digest.hexdigest()})
                        now, digest = r["conv_id"], hashlib.sha256()
                    else:
                        digest.update(b"\n")
                    digest.update(f"{r['role']}:{r['text']}".encode())
                yield from _emit(found, arrow)
                found = []
        if digest is not None:
            yield from _emit([{"conv_id": now, "repaired_sha256": digest.hexdigest()}], arrow)

    return repaired.select("conv_id", "place", "role", "text").mapInArrow(run, out)


def damaged(turns: DataFrame) -> DataFrame:
    """The turns with the query's faults: by a checksum of id and turn some are dropped, emptied,
    robbed of their sentence ends, repeated, or given to the user."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("fault"),
    ).filter("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    times = F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


NONE_SHA = hashlib.sha256(b"").hexdigest()


def _sql() -> str:
    """The same, with the parse row by row: the best audit of every state behind every row."""
    bits = "CASE WHEN x >= 0 THEN xor(c, x) WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    key = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
    steps = f"flatten(list_transform(string_split({key}, ''), lambda s: [CAST(ascii(s) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))"
    crc = f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {steps}), lambda c, x: {bits}), 4294967295)"
    ins = ", ".join(
        f"({p}, {q}, {INSERTED[4 * p + q][0]}, '{INSERTED[4 * p + q][1]}')" for p in STATES for q in STATES if INSERTED[4 * p + q]
    )
    moves = ", ".join(f"({p}, '{letter}', {q})" for (p, letter), q in MOVES.items())
    letter = "CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'x' END"
    score = lambda cost, audit: f"lpad(CAST({cost} AS VARCHAR), 12, '0') || {audit}"
    return rf"""
    WITH RECURSIVE given AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc} % 20 AS f FROM conversations
    ),
    spoilt AS (
      SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN f = 1 THEN '' WHEN f = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE WHEN f = 3 THEN 2 ELSE 1 END)) AS copy
      FROM given WHERE f <> 0
    ),
    placed AS (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(length(role) || ':' || role || text)) AS k,
        {letter} AS letter FROM spoilt
    ),
    told AS (
      SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'duplicate'
        WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE 'none' END AS fault,
        lag(letter) OVER (PARTITION BY conv_id ORDER BY k) AS before
      FROM placed
    ),
    moves(p, letter, q) AS (VALUES {moves}), ins(p, q, cost, audit) AS (VALUES {ins}),
    edits AS (
      SELECT t.conv_id, t.k, s.p, s.p AS q, {DELETE} AS cost, 'D' AS edit FROM told t, (SELECT unnest(range(4)) AS p) s
      UNION ALL
      SELECT t.conv_id, t.k, m.p, m.q, CASE WHEN t.letter = m.letter THEN {KEEP} ELSE {REROLE} END
          + CASE WHEN fault = 'truncated' THEN {TRUNCATED} ELSE 0 END, CASE WHEN t.letter = m.letter THEN 'K' ELSE 'R' END
      FROM told t JOIN moves m ON t.letter = m.letter OR m.letter <> 's' WHERE fault IN ('none', 'truncated')
    ),
    reached AS (
      SELECT conv_id, CAST(0 AS BIGINT) AS k, 0 AS p, lpad('', 12, '0') AS best FROM told GROUP BY conv_id
      UNION ALL
      SELECT r.conv_id, r.k + 1, e.q,
        min({score("CAST(r.best[1:12] AS BIGINT) + i.cost + e.cost", "r.best[13:] || i.audit || e.edit")})
      FROM reached r JOIN ins i ON i.p = r.p
        JOIN edits e ON e.conv_id IS NOT DISTINCT FROM r.conv_id AND e.k = r.k + 1 AND e.p = i.q
      GROUP BY r.conv_id, r.k, e.q
    ),
    sizes AS (
      SELECT conv_id, max(k) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (before IS NOT NULL AND (before || letter) NOT IN ('su', 'ua', 'au')) AS illegal
      FROM told GROUP BY conv_id
    ),
    ended AS (
      SELECT s.*, min({score("CAST(r.best[1:12] AS BIGINT) + i.cost", "r.best[13:] || i.audit")}) AS best
      FROM sizes s JOIN reached r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.k = s.n
        JOIN ins i ON i.p = r.p AND i.q IN ({START}, {A}) GROUP BY ALL
    ),
    audits AS (SELECT *, CAST(best[1:12] AS BIGINT) AS cost, best[13:] AS audit FROM ended),
    steps AS (
      SELECT conv_id, unnest(range(1, length(audit) + 1)) AS i, length(replace(audit, 'D', '')) % 2 AS odd,
        unnest(string_split(audit, '')) AS edit FROM audits
    ),
    counted AS (
      SELECT *, count(*) FILTER (edit <> 'I') OVER w AS k, count(*) FILTER (edit <> 'D') OVER w - 1 AS place
      FROM steps WHERE edit <> '' WINDOW w AS (PARTITION BY conv_id ORDER BY i)
    ),
    repaired AS (
      SELECT c.conv_id, sha256(string_agg(CASE WHEN c.edit = 'K' THEN t.role
          WHEN (c.place - c.odd) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' ||
          CASE WHEN c.edit = 'I' THEN '' ELSE t.text END, chr(10) ORDER BY c.place)) AS digest
      FROM counted c LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM c.conv_id AND t.k = c.k
      WHERE c.edit <> 'D' GROUP BY c.conv_id
    )
    SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
      coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
      coalesce(audit, '') AS audit, coalesce(digest, '{NONE_SHA}') AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) o
      LEFT JOIN audits a ON a.conv_id IS NOT DISTINCT FROM o.conv_id
      LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM o.conv_id
    """


def _beside(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join by conversation, a missing id being one."""
    key = right.withColumnRenamed("conv_id", "of")
    return left.join(key, F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")


@query("op12_conversation_repair", _sql())
def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    given = table(spark, folder, "conversations")
    report, repaired = repair(damaged(given))
    every = _beside(_beside(given.select("conv_id").distinct(), report), digests(repaired))
    zeros = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    filled: list[Column] = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in zeros]
    return every.select(
        "conv_id", *filled,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(NONE_SHA)).alias("repaired_sha256"),
    )
