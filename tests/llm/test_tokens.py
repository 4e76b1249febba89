from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from helpers import awkward, documents
from tabkit.llm import byte_bpe, packing, token_counts

RANKS = byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.VOCABULARY))


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def strange_texts(n):
    draw = random.Random(5)
    tokens = list(RANKS)
    for k in range(n):
        if k % 3 == 0:
            yield "".join(draw.choice("aábcn é\n\t'") for _ in range(draw.randint(0, 60)))
        elif k % 3 == 1:
            yield b"".join(draw.choice(tokens) for _ in range(draw.randint(1, 8))).decode("utf-8", "ignore")
        else:
            yield draw.choice("abe =\n0-") * draw.randint(1, 300)


def test_backtracking_gives_the_merges(reference):
    encoder = byte_bpe.Encoder(RANKS)
    memo, pattern = byte_bpe.Memo(encoder), regex.compile(public_tokenizers.PATTERN)
    for text in strange_texts(3000):
        ids = byte_bpe.encode_text(memo, pattern, text)
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
        assert byte_bpe.decode_ids(encoder.data, ids) == text.encode()


def test_compatible_is_what_merging_leaves():
    encoder, draw = byte_bpe.Encoder(RANKS), random.Random(9)
    usable = list(encoder.shorter)
    for _ in range(3000):
        a, b = draw.choice(usable), draw.choice(usable)
        left = byte_bpe.merge_all(RANKS, encoder.data[a] + encoder.data[b])
        assert encoder.compatible(a, b) == (left == [encoder.data[a], encoder.data[b]])


def test_encode_decode_and_digests(spark, reference):
    docs = awkward(spark)
    path = public_tokenizers.path(byte_bpe.VOCABULARY)
    texts = [r["text"] or "" for r in docs.collect()]
    encoded = byte_bpe.encode(docs, path)
    ids = [r["ids"] for r in encoded.collect()]
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == [reference.encode_ordinary(t) for t in texts]
    decoded = [bytes(r["data"]).decode() for r in byte_bpe.decode(encoded, path).collect()]
    assert decoded == texts
    rows = byte_bpe.digests(docs, path).collect()
    assert [r["n_tokens"] for r in rows] == [len(x) // 4 for x in ids]
    assert [r["decoded_sha256"] for r in rows] == [hashlib.sha256(t.encode()).hexdigest() for t in texts]
    assert byte_bpe.digests(docs.limit(0), path).count() == 0


def plain_count(pieces, unknown, text):
    """The same segmentation over the whole text, place by place."""
    body = token_counts.SPACE + text.replace(" ", token_counts.SPACE) if text else ""
    best = [(0.0, 0)]
    for end in range(1, len(body) + 1):
        choice = None
        for start in range(max(0, end - 16), end):
            piece = body[start:end]
            if piece in pieces:
                score, count = best[start][0] + pieces[piece], best[start][1] + 1
            elif start == end - 1:
                score, count = best[start][0] + unknown, best[start][1] + len(piece.encode())
            else:
                continue
            if choice is None or score > choice[0]:
                choice = (score, count)
        best.append(choice)
    return best[-1][1]


def test_counts_equal_a_plain_search(spark):
    pieces, unknown = token_counts.read_pieces(public_tokenizers.path(token_counts.MODEL))
    draw = random.Random(2)
    texts = ["".join(draw.choice(" abcé你😀\n▁ñthe ") for _ in range(draw.randint(0, 60))) for _ in range(300)]
    texts += ["Hello  world   again", " ", "   ", "▁"]
    docs = documents(spark, [(i, t, "en") for i, t in enumerate(texts)])
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.counts(docs, public_tokenizers.path(token_counts.MODEL)).collect()}
    assert got == {i: plain_count(pieces, unknown, t) for i, t in enumerate(texts)}


def test_counts_equal_sentencepiece():
    """The library, told to read the file as a unigram model, with tame scores for exact sums."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    model.ParseFromString(open(public_tokenizers.path(token_counts.MODEL), "rb").read())
    model.trainer_spec.model_type = 1
    for piece in model.pieces:
        piece.score = max(piece.score, -40_000.0)
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    pieces, _ = token_counts.read_pieces(public_tokenizers.path(token_counts.MODEL))
    pieces = {p: max(s, -40_000.0) for p, s in pieces.items()}
    trie = token_counts.CountTrie(pieces, -40_000.0 + token_counts.UNKNOWN_PENALTY)
    draw = random.Random(4)
    for _ in range(2000):
        text = "".join(draw.choice(["the ", "on", "ing", "é", "x", " ", "\n", "你", "😀", "tion", "er"]) for _ in range(draw.randint(0, 25)))
        words = token_counts.pretokens(text)
        trie.count_all(set(words))
        assert sum(trie.terminals[w] for w in words) == len(library.encode(text)), text


def test_counts_of_awkward_rows(spark):
    path = public_tokenizers.path(token_counts.MODEL)
    found = token_counts.counts(awkward(spark), path)
    got = {r["doc_id"]: r["n_tokens"] for r in found.collect()}
    assert got[1] == got[2] == 0 and got[9] > 0
    assert token_counts.counts(awkward(spark).limit(0), path).count() == 0


def expected_pieces(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    out = []
    for doc, text in texts:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        for k, at in enumerate(range(0, len(ids), packing.CAPACITY)):
            part = ids[at : at + packing.CAPACITY]
            out.append((doc, k, at, len(part), zlib.crc32(part.tobytes())))
    return out


def test_ids_are_the_tokenizers_own(spark):
    """Whole texts through the public tokenizer, its marks inside the texts included."""
    texts = ["a <|endoftext|> b", "<|startoftext|><|endoftext|>", "<|ENDOFTEXT|> <|end", "It's 12 o'clock, Été!", "你好<|endoftext|>", "<|endoftext|>" * 3000]
    docs = documents(spark, [(i, t, "en") for i, t in enumerate(texts)])
    got = packing.pieces(docs, public_tokenizers.path(packing.VOCABULARY)).collect()
    want = expected_pieces(enumerate(texts))
    assert sorted(tuple(r)[:5] for r in got) == sorted(want)


def check_packing(rows):
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    return len(bins)


def test_packing_of_awkward_rows(spark):
    docs = awkward(spark)
    path = public_tokenizers.path(packing.VOCABULARY)
    rows = packing.pack(docs, path).collect()
    got = sorted((r[0] or -1, *r[1:5]) for r in rows)
    assert got == sorted((d or -1, *x) for d, *x in expected_pieces([(r["doc_id"], r["text"]) for r in docs.collect()]))
    check_packing(rows)
    assert packing.pack(docs.limit(0), path).count() == 0


def test_packing_is_nearly_full(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = packing.pack(docs, public_tokenizers.path(packing.VOCABULARY), block_pieces=60).collect()
    total = sum(r["length"] for r in rows)
    assert sorted(tuple(r[:5]) for r in rows) == sorted(expected_pieces([(r["doc_id"], r["text"]) for r in docs.collect()]))
    assert check_packing(rows) <= -(-total // packing.CAPACITY) + 3


def test_crossover_and_mutation_keep_packings_whole():
    rng = np.random.default_rng(1)
    lengths = np.sort(rng.integers(1, 900, 300))[::-1].astype(np.int64)
    population = packing.first_packings(lengths, 2048, 4, rng)
    for _ in range(30):
        a, b = rng.integers(0, len(population), 2)
        child = packing.crossover(lengths, population[a], population[b], 2048, rng)
        child = packing.mutate(lengths, child, 2048, rng)
        assert len(child) == len(lengths) and child.min() == 0
        assert packing.fills(lengths, child).max() <= 2048 and packing.fills(lengths, child).min() > 0
        population.append(child)
    best = packing.evolve(lengths, population, 2048, 10, rng)[0]
    assert best.max() + 1 <= min(p.max() for p in population) + 1


def test_genetic_search_beats_best_fit_where_it_can():
    # thirds of a bin that best fit by falling length packs badly
    rng, lengths = np.random.default_rng(3), []
    for _ in range(40):
        a, b = sorted(rng.integers(300, 1700, 2))
        lengths += [a, b - a, 2048 - b] if b > a else [a, 2048 - a]
    lengths = np.sort(np.array(lengths))[::-1].astype(np.int64)
    first = packing.first_packings(lengths, 2048, 6, rng)
    assert packing.evolve(lengths, first, 2048, 60, rng)[0].max() <= first[0].max()
    # the case that best fit by falling length is known to pack worst
    hard = np.repeat([510, 270, 260, 230], [12, 12, 12, 24]).astype(np.int64)
    first = packing.first_packings(hard, 1000, packing.POPULATION, rng)
    found = packing.evolve(hard, first, 1000, 60, rng)[0]
    assert first[0].max() + 1 == 22 and found.max() + 1 < 22
    assert (packing.fills(hard, found) <= 1000).all() and len(found) == len(hard)


def test_crossover_builds_the_packing_also_where_best_fit_reaches_the_bound():
    rng = np.random.default_rng(7)
    lengths = np.sort(rng.integers(20, 900, 1500))[::-1].astype(np.int64)
    first = packing.first_packings(lengths, 2048, packing.POPULATION, rng)
    assert first[0].max() + 1 == packing.least_bins(lengths, 2048) and len(first) == packing.FEW_PARENTS
    found = packing.evolve(lengths, first, 2048, packing.GENERATIONS, rng, packing.LEAST_GENERATIONS)[0]
    assert found.max() == first[0].max() and (packing.fills(lengths, found) <= 2048).all()
    assert packing.fitness(lengths, found, 2048) >= packing.fitness(lengths, first[0], 2048)


def test_a_task_ends_by_giving_memory_back(spark, monkeypatch):
    """Workers outlive their tasks: what a map over batches freed must not stay with them."""
    from tabkit.llm import common

    told = []
    monkeypatch.setattr(common, "release", lambda: told.append("released"))
    assert list(common.released(lambda batches: (2 * b for b in batches))([1, 2])) == [2, 4] and told == ["released"]
