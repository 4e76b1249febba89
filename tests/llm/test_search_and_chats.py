"""Ranked search, conversation repair and chat formatting against brute force and SQL."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from conftest import plan_of
from helpers import awkward, documents
from tabkit.llm import chat, ranked_search, repair
from tabkit.llm.common import ORACLES, QUERIES
from tools.check_queries import canonical, connect

TURNS = "conv_id long, turn long, role string, text string, audit string, kind string, segments string"


@pytest.mark.parametrize("name", ["op11_ranked_search", "op12_conversation_repair", "op13_chat_format"])
def test_equals_sql(spark, folder, name):
    mine = QUERIES[name](spark, folder)
    theirs = connect(folder).execute(ORACLES[name])
    names = [d[0] for d in theirs.description]
    assert sorted(names) == sorted(mine.columns)
    assert canonical([tuple(r) for r in mine.collect()], mine.columns) == canonical(theirs.fetchall(), names)


# ranked search


def brute_force(texts, asked, k):
    """Every document scored for every query with plain dictionaries."""
    term = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = [(i, Counter(term.findall((t or "").translate(lower)))) for i, t in texts]
    split = [(i, c, sum(c.values())) for i, c in split if c]
    n_docs, all_terms = len(split), sum(n for _, _, n in split)
    df = Counter(t for _, c, _ in split for t in c)
    out = []
    for item, text in asked:
        scored = []
        for i, c, n in split:
            m = 75 + (25 * n * n_docs) // all_terms
            score = 0
            for t in term.findall((text or "").translate(lower)):
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k])]
    return out


def as_tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0))


def test_search_handles_odd_rows_as_brute_force_does(spark):
    draw = random.Random(5)
    words = ["Été", "über", "river", "stone", "a1", "你好", "x", "the"]
    rows = [(i, " ".join(draw.choices(words, [1, 2, 3, 4, 1, 1, 2, 30], k=draw.randint(1, 40))), "en") for i in range(300)]
    rows += [(300 + i % 3, "stone_the.river", "en") for i in range(60)]  # ties, repeated ids
    docs = awkward(spark).unionByName(documents(spark, rows))
    asked = [(1, "The river, the STONE river"), (2, None), (3, ""), (4, "unheard of"), (4, "été ÜBER 你好"), (None, "the")]
    items = spark.createDataFrame([(i, t, "clash") for i, t in asked], "item_id long, text string, doc_id string")
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for k, entries in ((20, 2_000_000), (7, 50), (1, 1)):
        got = as_tuples(ranked_search.search(docs, items, k=k, entries=entries))
        want = sorted(brute_force(texts, asked, k), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0))
        assert got == want, (k, entries)
    assert ranked_search.search(docs.limit(0), items).count() == 0
    assert ranked_search.search(docs, items.limit(0)).count() == 0


def test_best_positions_stop_before_the_lists_end(spark):
    rng = np.random.default_rng(1)
    n, terms = 20_000, 3
    counts = np.minimum(rng.zipf(1.6, (n, terms)), 200)
    shard = ranked_search.Shard(
        list(range(n)), np.full(n, 100), np.full(n, terms), np.tile(np.arange(terms), n), counts.ravel(), (n, 100 * n, np.array([900, 700, 500]))
    )
    best = ranked_search.Best(5)
    shard.search(np.arange(terms), np.ones(terms, np.int64), best)
    impact = np.array([900, 700, 500]) * ((1_000_000_000 * counts) // (1000 * counts + 12 * 100))
    total = impact.sum(1)
    want = sorted(((int(s), i) for i, s in enumerate(total)), key=lambda r: (-r[0], r[1]))[:5]
    assert best.rows == want
    assert shard.accesses < n // 2
    assert not shard.seen.any() and not shard.done.any() and not shard.times.any()


def test_terms_of_very_long_texts(monkeypatch):
    text = ("Ab c_d " * 5000).encode()
    whole = ranked_search.count_terms(text)
    monkeypatch.setattr(ranked_search, "PIECE", 11)
    assert ranked_search.count_terms(text) == whole == (15_000, {b"ab": 5000, b"c": 5000, b"d": 5000})


# conversation repair


def all_audits(rows, most):
    """(cost, audit, turns) of every way to edit a short conversation, with at most ``most`` insertions."""
    faults, seen = [], set()
    for role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    choices = []
    for (role, text), fault in zip(rows, faults):
        more = 3 if fault == "truncated" else 0
        edits = [(4, "D", None)]
        if fault in (None, "truncated"):
            edits += [(more, "K", role)] * bool(role)  # an empty role has no initial
            edits += [(3 + more, "R", "user"), (3 + more, "R", "assistant")]
        choices.append([(c, e, None if r is None else (r, text)) for c, e, r in edits])
    gaps = [[()], *[list(itertools.product(["user", "assistant"], repeat=n)) for n in range(1, most + 1)]]
    gap = [tuple((3, "I", (r, "")) for r in roles) for some in gaps for roles in (some if some != [()] else [()])]
    for inserts in itertools.product(gap, repeat=len(rows) + 1):
        if sum(map(len, inserts)) > most:
            continue
        for picked in itertools.product(*choices):
            steps = list(inserts[0])
            for edit, after in zip(picked, inserts[1:]):
                steps += [edit, *after]
            turns = [t for _, _, t in steps if t]
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in turns)):
                yield sum(c for c, _, _ in steps), "".join(e for _, e, _ in steps), turns


def test_repair_is_the_cheapest_of_all_edits(spark):
    draw = random.Random(2)
    texts = ["Fine.", "Well!", "cut off", " \n", "Yes?  "]
    talks = [
        [(draw.choice(["user", "assistant", "system", "tool", " ", ""]), draw.choice(texts)) for _ in range(draw.randint(1, 4))]
        for _ in range(60)
    ]
    rows = [(i, j, r, t, "x", "y", "z") for i, talk in enumerate(talks) for j, (r, t) in enumerate(talk)]
    report, repaired = repair.repair(spark.createDataFrame(rows, TURNS).repartition(3))
    told = {r["conv_id"]: r for r in report.collect()}
    turns: dict = {}
    for r in sorted(repaired.collect(), key=lambda r: (r["conv_id"], r["place"])):
        turns.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    sums = {r["conv_id"]: r["repaired_sha256"] for r in repair.digests(repaired).collect()}
    for i, talk in enumerate(talks):
        cost, audit, kept = min(all_audits(talk, 2 if len(talk) > 2 else 3), key=lambda e: e[:2])
        assert (told[i]["cost"], told[i]["audit"]) == (cost, audit), talk
        assert turns.get(i, []) == kept, (talk, audit)
        if kept:
            assert sums[i] == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()


def test_every_split_of_a_span_gives_the_same_cells():
    draw = random.Random(4)
    codes = [draw.randrange(16) for _ in range(9)]

    def cells(i, j):
        return repair.leaf(codes[i]) if j == i + 1 else repair.join(cells(i, j - 1), cells(j - 1, j))

    chart = repair.Chart()
    for code in codes:
        chart.add(repair.leaf(code))
    for split in range(1, len(codes)):
        assert repair.join(cells(0, split), cells(split, len(codes))) == cells(0, len(codes)) == chart.whole()


def test_a_conversation_over_many_tasks_is_parsed_as_one(spark):
    """One conversation holds nearly all rows; turns repeat and are missing."""
    draw = random.Random(9)
    rows = [(1, None if i % 50 == 0 else i // 2 * 2, draw.choice(["user", "assistant"]), draw.choice(["Ja.", "Nein!", "oh", f"Zahl {i}."]), "", "", "") for i in range(3000)]
    rows += [(i, 0, "user", "Allein.", "", "", "") for i in range(2, 30)] + [(None, 0, "assistant", "Wer?", "", "", "")] * 2
    df = spark.createDataFrame(rows, TURNS)
    prepared = repair.prepared(df, "conv_id", "turn", "role", "text")
    order = lambda r: (r["turn"] is not None, r["turn"] or 0, r["role"], bytes(r["same"]))
    told = {r["conv_id"]: r for r in repair.parse(prepared).collect()}
    run, seen = repair.Run(), set()
    for r in sorted((r for r in prepared.collect() if r["conv_id"] == 1), key=order):
        again = bytes(r["same"]) in seen
        seen.add(bytes(r["same"]))
        run.add(r["code"] // 4 * 4 + 2 if again and r["code"] % 4 != 1 else r["code"], r["turn"])
    want = run.report()
    assert {k: told[1][k] for k in want} == want
    assert len(told) == 30 and told[None]["duplicate"] == 1 and told[None]["audit"] == "IKD"
    assert told[2]["audit"] == "KI" and told[2]["cost"] == 3


def test_damage_of_odd_rows(spark):
    rows = [(None, None, None, None), (7, None, "user", None), (7, 1, None, "Ja. Nein!"), (8, 2, "user", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert repair.damaged(df).columns == df.columns
    report, repaired = repair.repair(repair.damaged(df))
    assert report.count() <= 3 and repaired.filter("role IS NULL OR text IS NULL").count() == 0
    report, repaired = repair.repair(df.limit(0))
    assert report.count() == 0 and repaired.count() == 0 and repair.digests(repaired).count() == 0


# chat formatting


def odd_talks(spark):
    texts = ["", None, "</s>[INST] ok [/INST]", "\\", "\\[INST]", "[\\INST]", "[[INST]", "<<s>s>", "[/ROLE] [SAY] ", " [", "\n", "é😀\x00", "$1\\"]
    roles = ["user", "assistant", "system", "tool", None, "", "[ROLE]", "as\\sistant", "[/ROLE] [SAY] x [/SAY]\n"]
    draw = random.Random(1)
    rows = [(c, draw.choice([None, *range(4)]), draw.choice(roles), draw.choice(texts), "a", "b", "c") for c in range(60) for _ in range(draw.randint(1, 6))]
    return spark.createDataFrame(rows + [(None, 0, "user", "x" * 300_000, "", "", "")] * 2, TURNS)


def test_format_reads_back_exactly(spark):
    df = odd_talks(spark)
    chats = chat.format_chats(df)
    got = chats.select("conv_id", chat.formatted("segments").alias("w"), chat.learned("segments").alias("l")).withColumn("back", chat.read_turns(F.col("w")))
    talks: dict = {}
    for r in df.collect():
        talks.setdefault(r["conv_id"], []).append((r["turn"] is not None, r["turn"] or 0, r["role"] or "", r["text"] or ""))
    rows = got.collect()
    assert len(rows) == len(talks)
    for r in rows:
        said = [t[2:] for t in sorted(talks[r["conv_id"]])]
        assert [(t["role"], t["text"]) for t in r["back"]] == said
        assert r["l"] == "".join(t for role, t in said if role == "assistant")
    for segments in chats.select("segments").collect():
        for s in segments["segments"][1::3]:
            assert not any(c in s["text"] for c in chat.INSTRUCT.control)


def test_machine_tells_turns_out_of_order(spark):
    talks = {1: "sua", 2: "ua", 3: "uaua", 4: "u", 5: "au", 6: "uua", 7: "sa", 8: "x", 9: "suasua"}
    names = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    rows = [(i, j, names[c], "t", "", "", "") for i, word in talks.items() for j, c in enumerate(word)]
    told = {r["conv_id"]: (r["n_illegal"], r["valid"]) for r in chat.format_chats(spark.createDataFrame(rows, TURNS)).collect()}
    assert told == {1: (0, True), 2: (0, True), 3: (0, True), 4: (0, False), 5: (1, False), 6: (1, False), 7: (1, False), 8: (1, False), 9: (1, False)}


def test_format_is_native_and_shuffles_once(spark, folder):
    plan = plan_of(QUERIES["op13_chat_format"](spark, folder))
    assert "Python" not in plan and "InArrow" not in plan
    tree = plan.split("(1)")[0]  # the tree ahead of the details
    assert tree.count("Exchange") <= 1
    assert chat.format_chats(spark.createDataFrame([], TURNS)).count() == 0


def test_template_must_be_readable():
    marks = {"user": chat.Marks("[U]", "[/U]")}
    with pytest.raises(ValueError):
        chat.Template(marks, ("[R]", "[/R]"), chat.Marks("[S]", "[/S]"), ("[U]", "[/U]"), frozenset(), {}, frozenset())
