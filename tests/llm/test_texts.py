from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from helpers import awkward, documents, sentence
from tabkit.llm import fingerprints, language, licenses, quality
from tabkit.llm.common import SpanHasher, bucket_of
from tools.check_queries import canonical, connect


# --- language ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def bilingual(spark):
    draw = random.Random(1)
    rows = [(i, sentence(draw, lang, draw.randint(3, 30)), lang) for i in range(120) for lang in ("en", "de")]
    return documents(spark, [(k, t, lang) for k, (_, t, lang) in enumerate(rows)])


def test_language_of_held_out_rows(spark, bilingual):
    model = language.train(language.learnable(bilingual))
    got = {r["doc_id"]: r for r in language.predict(bilingual, model).collect()}
    held = bilingual.filter(bucket_of("doc_id", 4) == 2).collect()
    assert len(held) > 30
    assert np.mean([got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_backs_off_to_shorter_grams(bilingual):
    model = language.train(bilingual)
    scorer = language.Scorer(model)

    def row(word):
        at = scorer[word]  # the table may grow
        return scorer.rows[at].copy()

    assert np.allclose(row("stone"), model.word_rows[model.words["stone"]])
    known = [model.gram_rows[model.grams[g]] for g in language.grams_of("stoneriver", 4) if g in model.grams]
    assert "stoneriver" not in model.words and np.allclose(row("stoneriver"), np.mean(known, axis=0))
    assert np.allclose(row("ßqßq"), model.gram_rows[model.grams["ß"]])
    assert not row("你").any()
    scorer.forget()
    assert "stoneriver" not in scorer and np.allclose(row("stone"), model.word_rows[model.words["stone"]])


def test_language_equals_plain_dictionaries(spark, bilingual):
    """Every score again, word by word, from counts of the same labelled rows."""
    learnt = bilingual.collect()
    counts = {lang: Counter(w for r in learnt if r["lang"] == lang for w in re.findall(r"[^\W\d_]+", r["text"].lower())) for lang in ("de", "en")}

    def pieces(word, n):
        marked = f"_{word}_"
        return list(word) if n == 1 else [marked[i : i + n] for i in range(len(marked) - n + 1)]

    grams = {n: {lang: Counter() for lang in counts} for n in range(1, 5)}
    for lang, words in counts.items():
        for word, times in words.items():
            for n in grams:
                for g in pieces(word, n):
                    grams[n][lang][g] += times

    def logs(tables, item):
        floor = 0.5 / max(sum(c.values()) for c in tables.values())
        return np.array([np.log(tables[x][item] / sum(tables[x].values()) if tables[x][item] else floor) for x in ("de", "en")])

    def of_word(word):
        if any(word in c for c in counts.values()):
            return logs(counts, word)
        for n in range(4, 0, -1):
            found = [logs(grams[n], g) for g in pieces(word, n) if any(g in c for c in grams[n].values())]
            if found:
                return np.mean(found, axis=0)
        return np.zeros(2)

    texts = ["stone unheard flussname", "qqq", "Häuser der unter", "the 12 walking dead", "é è", *[r["text"] for r in learnt[:20]]]
    model = language.train(bilingual)
    got = {r["doc_id"]: r for r in language.predict(documents(spark, [(i, t, None) for i, t in enumerate(texts)]), model).collect()}
    for i, text in enumerate(texts):
        total = sum((of_word(w) for w in re.findall(r"[^\W\d_]+", text.lower())), np.zeros(2))
        best = int(total.argmax())
        if total.any():
            assert got[i]["lang_pred"] == ("de", "en")[best]
            assert got[i]["score"] == pytest.approx(1 / np.exp(total - total[best]).sum())


def test_language_of_awkward_rows(spark, bilingual):
    model = language.train(bilingual)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(awkward(spark), model).collect()}
    for i in (1, 2, 3, 5):
        assert got[i] == ("und", 0.0)
    assert got[6][0] == "en" and got[7][0] == "de" and got[8][0] == "en" and got[9][0] in ("en", "de")
    nothing = language.train(bilingual.limit(0))
    assert {r["lang_pred"] for r in language.predict(bilingual, nothing).collect()} == {"und"}
    assert language.predict(bilingual.limit(0), model).count() == 0


def test_language_with_one_short_document_draws_no_others(spark, bilingual):
    es = "el río y la casa bajo la luz de la mañana con gente del pueblo"
    rare = bilingual.unionByName(documents(spark, [(9001, es, "es"), (9002, "1234 !!", "xx")]))
    model = language.train(rare)
    assert model.languages == ["de", "en", "es"] and abs(model.prior.sum() - 1) < 1e-9
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(rare, model).collect()}
    rows = bilingual.collect()
    assert np.mean([got[r["doc_id"]] == r["lang"] for r in rows]) > 0.97
    assert got[9001] == "es" and got[9002] == "und"
    none = language.train(documents(spark, [(1, "1234 !!", "xx"), (2, "", "yy")]))
    assert none.languages == [] and not none.words


def test_language_query_holds_out(spark, folder):
    rows = language.op1_language_id(spark, folder).collect()
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(docs) and 20 < len(held) < 80
    assert np.mean([r["lang_pred"] == docs[r["doc_id"]] for r in held]) > 0.95


# --- quality ----------------------------------------------------------------------------


def test_quality_of_held_out_rows(spark, folder):
    rows = {r["doc_id"]: r for r in quality.op6_quality_knn(spark, folder).collect()}
    labels = [r for r in spark.read.parquet(f"{folder}/labels.parquet").collect()]
    held = [r for r in labels if rows[r["doc_id"]]["held_out"]]
    assert len(held) > 15
    assert np.mean([rows[r["doc_id"]]["predicted"] == r["quality"] for r in held]) > 0.9


def test_votes_weigh_by_similarity():
    vectors = np.array([[1.0, 0.0], [0.6, 0.8], [0.0, 1.0]])
    model = quality.Model(np.zeros(1), np.zeros((1, 2)), vectors, np.array([1.0, 0.0, 0.0]))
    got = quality.vote(model, np.array([[1.0, 0.0], [0.0, 1.0], [0.0, 0.0]]))
    weights = np.array([1.0, 0.6, 0.0]) ** quality.SHARPNESS
    assert got[0] == pytest.approx(weights[0] / weights.sum()) and got[1] < 0.01 and got[2] == 0.0


def test_quality_equals_plain_cosine_and_vote(spark, folder):
    """Every score again: term vectors by hand, one cosine at a time, all ties included."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = quality.train(docs, quality.learnable(labels))
    got = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    terms = quality.Terms()
    for r in docs.collect():
        places, amounts = terms.counts(r["text"])
        vector = np.zeros(quality.TERMS)
        for place, amount in zip(places, amounts):
            vector[place] += amount * model.weights[place]
        point = vector @ model.directions
        size = np.sqrt((point**2).sum())
        alike = sorted(((float(point @ v) / size if size else 0.0, y) for v, y in zip(model.vectors, model.labels)), reverse=True)
        last = alike[min(quality.NEIGHBOURS, len(alike)) - 1][0]
        votes = [(max(a, 0.0) ** quality.SHARPNESS, y) for a, y in alike if a >= last - 1e-9]
        total = sum(w for w, _ in votes)
        want = sum(w * y for w, y in votes) / total if total else 0.0
        assert got[r["doc_id"]] == pytest.approx(want, abs=1e-6), r["doc_id"]


def test_quality_learns_one_row_an_id_and_lets_ties_vote(spark):
    text = "Some words, of a text that is good."
    rows = [(1, text, "en")] * 40 + [(2, "x y z 00 11 !!", "en")]
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    assert len(quality.train(documents(spark, rows), labels).labels) == 2
    vectors = np.tile([[1.0, 0.0]], (40, 1))
    model = quality.Model(np.zeros(1), np.zeros((1, 2)), vectors, np.array([1.0] * 10 + [0.0] * 30))
    assert quality.vote(model, np.array([[1.0, 0.0]]))[0] == pytest.approx(0.25)
    assert quality.shape("a" * 100 + "B7") == "aaA0"


def test_quality_of_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(6, 1, 0), (7, 1, 0), (9, 0, 0), (5, 0, 1), (8, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    rows = quality.score(docs, model).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == 15 and all(0 <= r["score"] <= 1 for r in rows)
    assert got[1]["score"] == got[2]["score"] == got[3]["score"] == 0.0
    assert got[6]["predicted"] == 1 and got[9]["predicted"] == 0
    empty = quality.train(docs, labels.limit(0))
    assert {r["score"] for r in quality.score(docs, empty).collect()} == {0.0}
    assert quality.score(docs.limit(0), model).count() == 0


# --- fingerprints -----------------------------------------------------------------------


def test_peeling_recovers_the_differences():
    draw = np.random.default_rng(1)
    left, right = [], []
    for n in (0, 1, 3, 40, 400, 3000):
        shared = draw.integers(0, 1 << 62, n).astype(np.uint64)
        left.append(np.concatenate([shared, draw.integers(0, 1 << 62, n // 3 + 1).astype(np.uint64)]))
        right.append(np.concatenate([shared, draw.integers(0, 1 << 62, n // 2).astype(np.uint64)]))
    for a, b, (more, less) in zip(left, right, fingerprints.differences(left, right)):
        assert set(more.tolist()) == set(a.tolist()) - set(b.tolist())
        assert set(less.tolist()) == set(b.tolist()) - set(a.tolist())


def test_likeness_counts_repeats():
    hasher = SpanHasher()
    sets = [fingerprints.passage_digests(hasher, t) for t in ("a b c\n" * 30, "a b c\n" * 60)]
    both = 2 * min(map(len, sets)) / sum(map(len, sets))
    assert fingerprints.likeness(sets[:1], sets[1:])[0] == pytest.approx(both)


@pytest.mark.parametrize("size", [fingerprints.RANGE_BYTES, 20_000])
def test_every_text_is_compared_with_the_next(spark, folder, size):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = {r["doc_id"]: r for r in fingerprints.compare_with_next(docs, range_bytes=size).collect()}
    texts = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), reverse=True)
    assert len(rows) == len(texts)
    prints = {}
    for (doc, text), (_, following) in zip(texts, texts[1:] + texts[:1]):
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        r = rows[doc]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        if changed == text:
            assert r["near_edited"] == 1.0 and r["fingerprint"] == r["edited_fingerprint"]
        if following == text:
            assert r["near_next"] == 1.0
    near = np.array([(r["near_edited"], r["near_next"]) for r in rows.values()])
    assert np.median(near[:, 0]) > 0.4 and np.median(near[:, 1]) < 0.1


def test_one_cutting_rule_for_every_script_and_size():
    hasher, draw = SpanHasher(), np.random.default_rng(3)
    letters = "".join(draw.choice(list("abcdefghij"), 20_000))
    chinese = "".join(chr(c) for c in draw.integers(0x4E00, 0x9FFF, 3000))
    following = "Some words of the next document, which has white space. " * 400
    for text in (letters, chinese, "hello world", "one two three four five six seven eight nine"):
        sets = [fingerprints.passage_digests(hasher, t) for t in (text, fingerprints.edited(text, following))]
        assert fingerprints.likeness(sets[:1], sets[1:])[0] > 0.3, text[:20]
    for text in (letters, chinese, "x" * 5000, "a b " * 999):
        data = np.frombuffer(text.encode(), np.uint8)
        ends = fingerprints.ends_of_passages(data)
        assert ends[-1] == len(data) and (np.diff(ends) > 0).all() and np.diff(np.r_[0, ends]).max() <= fingerprints.MOST_BYTES


def test_an_edit_moves_no_cut_far_from_it():
    text = "".join(np.random.default_rng(5).choice(list("abcdefghij \n"), 4000))
    one = fingerprints.ends_of_passages(np.frombuffer(text.encode(), np.uint8))
    other = fingerprints.ends_of_passages(np.frombuffer((text[:2000] + "INSERTED" + text[2000:]).encode(), np.uint8))
    assert (one[one < 1990] == other[other < 1990]).all()
    late = set((other[other > 2150] - 8).tolist()) & set(one[one > 2142].tolist())
    assert len(late) > 0.95 * (one > 2142).sum()


def test_fingerprints_of_awkward_rows(spark):
    rows = fingerprints.compare_with_next(awkward(spark)).collect()
    assert len(rows) == 15
    got = {r["doc_id"]: r for r in rows}
    assert got[1]["n_chars"] == 0 and got[1]["fingerprint"] == got[2]["fingerprint"]
    assert got[11]["fingerprint"] == got[12]["fingerprint"]
    one = fingerprints.compare_with_next(documents(spark, [(1, "only one text here", "en")])).first()
    assert one["near_next"] == 1.0
    assert fingerprints.compare_with_next(awkward(spark).limit(0)).count() == 0


# --- licences ---------------------------------------------------------------------------


def test_licences_equal_sql(spark, folder):
    frame = licenses.op3_license_scan(spark, folder)
    found = connect(folder).execute(licenses._sql())
    names = [d[0] for d in found.description]
    assert canonical([tuple(r) for r in frame.collect()], frame.columns) == canonical(found.fetchall(), names)


def test_bounds_prune_nothing_that_could_match():
    for n in range(1, 40):
        low, high = licenses.bounds(n, 0.8)
        for m in range(1, 100):
            assert (2 * min(n, m) / (n + m) >= 0.8 - 1e-9) == (low <= m <= high)


def test_licences_of_awkward_rows(spark):
    rows = [
        (20, "Some words.\nRELEASED under the   MIT license\nmore", "en"),
        (21, "Licensed under\nthe Apache License,\nVersion 2.0.", "en"),
        (22, "Released under the new MIT License.", "en"),
        (23, "License", "en"),
    ]
    docs = awkward(spark).unionByName(documents(spark, rows))
    got = {r["doc_id"]: (r["n_lines"], r["license"], r["dice"]) for r in licenses.scan(docs).collect()}
    assert got[20] == (1, "MIT", 1.0) and got[21] == (1, "Apache-2.0", 1.0) and got[23] == (0, None, None)
    assert got[22] == (0, None, None)  # 2 * 3 / 9 is below the threshold
    for i in (1, 2, 3, 8, 9):
        assert got[i] == (0, None, None)
    assert licenses.scan(docs.limit(0)).count() == 0


def test_a_notice_counts_once_in_texts_of_any_length(spark):
    notice, tail = "Released under the MIT License.\nok", "\nmore words of another kind stand here" * 40
    rows = [(1, notice, "en"), (2, notice + tail, "en"), (3, "Released under\nthe MIT License.", "en"), (4, f"{notice}\n{notice}", "en")]
    got = {r["doc_id"]: (r["n_lines"], r["license"]) for r in licenses.scan(documents(spark, rows)).collect()}
    assert got == {1: (1, "MIT"), 2: (1, "MIT"), 3: (1, "MIT"), 4: (2, "MIT")}


# The five notices of the documents table, written out: templates must know them without help.
PLANTED = {
    "All rights reserved.": "Rights-Reserved",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Released under the MIT License.": "MIT",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
}


def test_planted_notices_are_found(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = {r["doc_id"]: (r["n_lines"], r["license"]) for r in licenses.scan(docs).collect()}
    seen = 0
    for row in docs.collect():
        named = [PLANTED[x] for x in (row["text"] or "").split("\n") if x in PLANTED]
        if named:
            seen += len(named)
            assert got[row["doc_id"]][0] >= len(named) and got[row["doc_id"]][1] in named
    assert seen > 0
    rows = [(i, f"Some words of a longer story.\n{notice}\nand more of them, told at length.", "en") for i, notice in enumerate(PLANTED)]
    got = {r["doc_id"]: (r["n_lines"], r["license"], r["dice"]) for r in licenses.scan(documents(spark, rows)).collect()}
    assert got == {i: (1, name, 1.0) for i, name in enumerate(PLANTED.values())}


def test_notices_inside_lines_and_wrapped(spark):
    prose = "the river and the house under bright morning light with people of the town "
    mit = dict(licenses.FULL_TEXTS)["MIT"]
    cut = mit.replace("free of charge, ", "").replace("subject to the", "under the")
    rows = [
        (1, prose * 20 + "Released under the MIT License. " + prose * 20, "en"),
        (2, prose * 20 + "\nThis work is licensed under the\nGNU General Public License,\nversion 3.\n" + prose * 20, "en"),
        (3, f"{prose}\nCopyright 2020 Somebody.\n{mit}\n{prose}", "en"),
        (4, prose + cut.replace("\n", " ") + prose, "en"),
        (5, prose + "All rights reserved. " + prose + "Licensed under CC BY 4.0. " + prose, "en"),
        (6, "All rights reserved.\n" * 3 + prose * 3, "en"),
        (7, prose * 30, "en"),
    ]
    got = {r["doc_id"]: (r["n_lines"], r["license"], r["dice"]) for r in licenses.scan(documents(spark, rows)).collect()}
    assert got[1] == (1, "MIT", 1.0) and got[2] == (1, "GPL-3.0", 1.0) and got[3] == (1, "MIT", 1.0)
    assert got[4][:2] == (1, "MIT") and 0.9 < got[4][2] < 1
    assert got[5] == (2, "CC-BY-4.0", 1.0) and got[6] == (3, "Rights-Reserved", 1.0) and got[7] == (0, None, None)


def test_windows_equal_brute_force(spark):
    draw = random.Random(5)
    templates = {"A": "a b c d e", "B": "b a b a c b a", "C": "e d c"}
    texts = ["".join(draw.choice("abcdex") + " " for _ in range(draw.randint(0, 30))) for _ in range(150)]
    got = {r["doc_id"]: r for r in licenses.scan(documents(spark, [(i, t, "en") for i, t in enumerate(texts)]), templates=templates).collect()}

    def pairs(words):
        return list(zip(words, words[1:]))

    for i, text in enumerate(texts):
        words, hits = text.split(), []
        for name, body in templates.items():
            want = Counter(pairs(body.split()))
            for a in range(len(words)):
                for b in range(a + 2, len(words) + 1):
                    have = pairs(words[a:b])
                    dice = 2 * (Counter(have) & want).total() / (len(have) + want.total())
                    if dice >= 0.8 - 1e-9:
                        hits.append((-dice, a - b, name, a, b))
        kept = []
        for h in sorted(hits):
            if all(h[4] <= k[3] or k[4] <= h[3] for k in kept):
                kept.append(h)
        top = min(((h[0], h[2]) for h in kept), default=None)
        assert got[i]["n_lines"] == len(kept), text
        assert (got[i]["license"], got[i]["dice"]) == ((top[1], round(-top[0], 6)) if top else (None, None))


def test_the_sql_of_the_licence_scan_looks_at_whole_texts(spark):
    """Notices wrapped over lines, inside long lines, and of many sentences: in SQL as in the scan."""
    import duckdb
    import pyarrow as pa

    filler = " ".join(f"word{i}" for i in range(300))
    full = dict(licenses.FULL_TEXTS)
    texts = [
        "Released under the\nMIT License.", f"{filler} All rights reserved. {filler}", full["MIT"], full["ISC"].replace(" ", "\n"),
        "All rights reserved.\nReleased under the BSD\n3-Clause License. All rights reserved.", f"{full['GPL-3.0']} {filler} {full['Apache-2.0']}",
        "rights reserved", "", None,
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1, texts[1]), (None, texts[0])]
    want = sorted(map(repr, map(tuple, licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect())))
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]}))
    got = con.execute(licenses._sql()).fetchall()
    assert sorted(map(repr, got)) == want
    found = {i: (n, name) for i, n, name, _ in got}
    assert found[0] == (1, "MIT") and found[2] == (1, "MIT") and found[4] == (3, "BSD-3-Clause") and found[5] == (2, "Apache-2.0")


def test_lines_that_match_by_themselves_count_beside_a_better_one(spark):
    """A start's best window may run into the next notice; its shorter ones still stand, in scan and SQL."""
    import duckdb
    import pyarrow as pa

    full = dict(licenses.FULL_TEXTS)
    texts = [
        "CC BY-SA 4.0\nLicensed under CC BY-SA 4.0.",
        "Under the BSD 3-Clause License.\nReleased under the BSD 2-Clause License.",
        "Is licensed under the GNU General Public License, version\nThis work is licensed under the GNU General Public License, version 3.",
        f"Licensed under CC BY-SA 4.0.\nis subject to the terms of the Mozilla Public License, version 2\n{licenses.TEMPLATES['MPL-2.0']}",
        f"{full['Apache-2.0']}\n{full['MIT']}\n{full['MIT'][:-200]}\n{full['GPL-3.0']}",
    ]
    want = [(0, 2, "CC-BY-SA-4.0", 1.0), (1, 2, "BSD-2-Clause", 1.0), (2, 2, "GPL-3.0", 1.0), (3, 3, "CC-BY-SA-4.0", 1.0), (4, 4, "Apache-2.0", 1.0)]
    got = licenses.scan(documents(spark, [(i, t, "en") for i, t in enumerate(texts)])).collect()
    assert sorted(map(tuple, got)) == want
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": list(range(len(texts))), "text": texts}))
    assert sorted(con.execute(licenses._sql()).fetchall()) == want
