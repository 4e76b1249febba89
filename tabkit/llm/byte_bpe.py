"""Byte-level BPE encoding and decoding by backtracking.

Bytes are mapped to Latin-1, so that pyahocorasick, which works on text, finds all
vocabulary entries of a pre-token in one pass.  The encoder takes the longest entry at
each place and steps back to shorter ones where two neighbours could not stand side by
side in a true encoding.  That test is memoised, and a place found to lead nowhere is
never tried again, so the work is linear in the text and the result equals the merges.

Null text is taken as empty; an empty text has no ids.  Special tokens are not used.
"""

from __future__ import annotations

import base64
import hashlib

import ahocorasick
import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tabkit.llm.common import map_text, query, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
# Entries of the two memo tables; a full one is emptied and fills again.
MEMO_ENTRIES = 1_000_000
NEVER = 1 << 60


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merge_all(ranks: dict[bytes, int], data: bytes, below: int = NEVER) -> list[bytes]:
    """Plain BPE: join the leftmost pair of lowest rank until none is left."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > 1:
        best, at = below, -1
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1], NEVER)
            if rank < best:
                best, at = rank, i
        if at < 0:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Encoder:
    """Encodes single pre-tokens; one object per Python worker and vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.data = {rank: token for token, rank in ranks.items()}
        self.length = {rank: len(token) for token, rank in ranks.items()}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.automaton = ahocorasick.Automaton()
        usable = set()
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) > 1:
                # the last merge of the token; entries that merging never makes stay out
                parts = merge_all(ranks, token, rank)
                if len(parts) != 2:
                    continue
                self.left[rank], self.right[rank] = ranks[parts[0]], ranks[parts[1]]
            usable.add(token)
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.shorter = {}
        for token in usable:
            prefix = next((token[:n] for n in range(len(token) - 1, 0, -1) if token[:n] in usable), None)
            self.shorter[ranks[token]] = None if prefix is None else ranks[prefix]
        self.beside: dict[tuple[int, int], bool] = {}

    def compatible(self, a: int, b: int) -> bool:
        """Whether the merges of ``a`` followed by ``b`` leave just these two tokens.

        The merges along the border are undone, latest first; a pair that could have
        joined across the border before one of its sides grew rules the two out.
        """
        known = self.beside.get((a, b))
        if known is not None:
            return known
        x, y, grown_x, grown_y, answer = a, b, NEVER, NEVER, True
        while True:
            joint = self.ranks.get(self.data[x] + self.data[y], NEVER)
            if joint < grown_x and joint <= grown_y and joint != NEVER:
                answer = False
                break
            born_x = x if x in self.right else -1
            born_y = y if y in self.left else -1
            if born_x < 0 and born_y < 0:
                break
            if born_x > born_y:
                grown_x, x = x, self.right[x]
            else:
                grown_y, y = y, self.left[y]
        if len(self.beside) >= MEMO_ENTRIES:
            self.beside.clear()
        self.beside[a, b] = answer
        return answer

    def encode(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        n = len(data)
        if not n:
            return []
        length, longest = self.length, [0] * n
        for end, token in self.automaton.iter(data.decode("latin-1")):
            longest[end + 1 - length[token]] = token  # later ends are longer
        dead = bytearray(n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            while token is not None:
                end = at + length[token]
                if not dead[end] and (not out or self.compatible(out[-1], token)):
                    break
                token = self.shorter[token]
            if token is None:
                dead[at] = 1
                token = out.pop()
                at -= length[token]
            else:
                out.append(token)
                at = end
                if at < n:
                    token = longest[at]
        return out


class Memo(dict):
    """Pre-token to its ids as little-endian bytes."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, word: str) -> bytes:
        ids = np.array(self.encoder.encode(word.encode("utf-8", "surrogatepass")), "<u4").tobytes()
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        if len(word) <= 256:  # longer ones hardly repeat
            self[word] = ids
        return ids


_WORKERS: dict[tuple, tuple] = {}


def worker(key: tuple, ranks: dict[bytes, int], pattern: str):
    """The encoder of this Python process, kept between tasks."""
    if key not in _WORKERS:
        _WORKERS.clear()
        _WORKERS[key] = (Memo(Encoder(ranks)), regex.compile(pattern))
    return _WORKERS[key]


def encode_text(memo: Memo, pattern, text: str) -> bytes:
    return b"".join(map(memo.__getitem__, pattern.findall(text)))


def decode_ids(ranks_data: dict[int, bytes], ids: bytes) -> bytes:
    return b"".join(map(ranks_data.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode(
    df: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, text: str = "text", keep=("doc_id",)
) -> DataFrame:
    """``keep`` and ``ids``, the little-endian unsigned 32-bit ids of each text."""
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(path))  # as large as the vocabulary file

    def make():
        memo, compiled = worker((path, pattern), ranks.value, pattern)
        return lambda texts: [[encode_text(memo, compiled, t or "") for t in texts]]

    return map_text(df, text, keep, [T.StructField("ids", T.BinaryType())], make)


def decode(df: DataFrame, path: str, ids: str = "ids", keep=("doc_id",)) -> DataFrame:
    """``keep`` and ``data``, the bytes that the ids stand for; NULL ids give none."""
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(path))

    def make():
        data = {rank: token for token, rank in ranks.value.items()}
        return lambda blobs: [[decode_ids(data, b or b"") for b in blobs]]

    return map_text(df, ids, keep, [T.StructField("data", T.BinaryType())], make)


def digests(
    df: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, text: str = "text", keep=("doc_id",)
) -> DataFrame:
    """Encode and decode in one pass, keeping counts and SHA-256 of ids and bytes."""
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(path))
    fields = [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]

    def make():
        memo, compiled = worker((path, pattern), ranks.value, pattern)
        data = memo.encoder.data

        def work(texts):
            counts, ids_sha, data_sha = [], [], []
            for t in texts:
                ids = encode_text(memo, compiled, t or "")
                counts.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                data_sha.append(hashlib.sha256(decode_ids(data, ids)).hexdigest())
            return counts, ids_sha, data_sha

        return work

    return map_text(df, text, keep, fields, make)


@query("op5_byte_bpe")
def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return digests(table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))
