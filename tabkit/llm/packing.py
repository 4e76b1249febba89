"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

Pieces of documents are dealt at random into blocks, and every block is packed by
several islands.  An individual is a packing; crossover injects well-filled bins of one
parent whole into the other, takes out the bins that then hold something twice, and
best-fits what they held besides.  After some generations the islands' best packings
migrate: each goes to the next island of its block.  A block whose packing needs no more
bins than its tokens fill is done.  Bins left poorly filled are pooled over all blocks
and packed once more, so that little is lost to the division into blocks.

Null and empty texts are one piece, the closing token alone.  Every row is packed, also
repeated ones and those without an id.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.llm.common import query, reach_package, released, slices, table
from tabkit.session import materialize

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 2048
CLOSING = 0
BLOCK_PIECES = 4_000
ISLANDS = 2
ROUNDS = 2
GENERATIONS = 5
POPULATION = 6
ELITES = 3
# Generations that every block goes through, also where its first packing has as few bins as
# any can have, and how many packings and children it then has: bins are already as few as
# can be, but children may fill them more unevenly, which leaves less to pack again.
LEAST_GENERATIONS, FEW_PARENTS, FEW_CHILDREN = 1, 3, 2
# A bin filled less than this goes to the pool that is packed again.
POOL_FILL = 0.97
# White-space chunks, and parts of them, that a task remembers the ids of; a full memory is
# emptied, and with the task it goes.
MEMO_ENTRIES = 300_000

# --- pieces ---------------------------------------------------------------------------

SEPARATORS = re.compile("[ \t\n\r\x0b\x0c]+")
# Characters that make a text odd: those beyond Latin, and four that ``str.split`` cuts at
# although the tokenizer keeps them.
ODD = re.compile("[^\x00-\x1b\x20-\u024f]")
# The vocabulary's own rules (fixed values of its file): how chunks part, and up to which
# character two Unicode versions cannot disagree about letters.
PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
LAST_LATIN = "\u024f"


def byte_letters() -> list[str]:
    """The letters that byte-level vocabularies write bytes with: visible Latin-1 as it is."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in visible else next(others)) for b in range(256)]


class PartIds(dict):
    """Part of a chunk to its ids: the vocabulary's merges, without its reading of text."""

    def __init__(self, model):
        super().__init__()
        self.model, self.letters = model, byte_letters()

    def __missing__(self, part: str) -> bytes:
        spelt = part if part.isascii() and part.isprintable() else "".join([self.letters[b] for b in part.encode()])
        ids = array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()
        if len(self) > MEMO_ENTRIES:
            self.clear()
        self[part] = ids
        return ids


class ChunkIds(dict):
    """White-space chunk to its ids, as bytes; no token of this vocabulary spans white space."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a task on each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # the vocabulary's own marks, which it reads as one id wherever they stand
        self.marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.parts = PartIds(self.tokenizer.model)

    def __missing__(self, chunk: str) -> bytes:
        if chunk.isascii() or max(chunk) <= LAST_LATIN:  # there, normal form changes nothing
            plain = chunk.lower()
            parts = [plain] if plain.isalpha() else PARTS.findall(plain)
            ids = b"".join(map(self.parts.__getitem__, parts))
        else:
            ids = array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()
        if len(chunk) <= 256:  # longer ones hardly repeat
            self[chunk] = ids
        return ids

    @staticmethod
    def chunks(text: str) -> list[str]:
        """Chunks with the same ids as the text's; in lower case, which makes fewer different ones."""
        return SEPARATORS.split(text) if ODD.search(text) else text.lower().split()

    def forget(self) -> None:
        self.clear()
        self.parts.clear()

    def ids(self, text: str) -> bytes:
        if len(self) > MEMO_ENTRIES:
            self.clear()
        if any(mark in text for mark in self.marks):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.__getitem__, self.chunks(text)))


_CHUNKS: dict[str, ChunkIds] = {}
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """The token pieces of every document: only documents longer than a sequence are cut."""
    reach_package(docs.sparkSession)
    closing = np.array([CLOSING], "<u4").tobytes()

    def run(batches):
        if path not in _CHUNKS:
            _CHUNKS[path] = ChunkIds(path)
        memo = _CHUNKS[path]
        memo.forget()
        for batch in batches:
            for part in slices(batch, 1):
                rows = []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    body = memo.ids(text or "") + closing
                    for piece, at in enumerate(range(0, len(body), 4 * capacity)):
                        ids = body[at : at + 4 * capacity]
                        rows.append((doc, piece, at // 4, len(ids) // 4, zlib.crc32(ids)))
                columns = zip(*rows)
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )
        memo.forget()

    source = docs.select(F.col(f"`{key}`").cast("long"), F.col(f"`{text}`"))
    return source.mapInArrow(released(run), PIECES)


# --- packings -------------------------------------------------------------------------


class Bins:
    """Open bins by the room they have left; finds the tightest fit in constant time."""

    def __init__(self, capacity: int, rooms: dict[int, int]):
        self.capacity = capacity
        self.by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.present = 0  # bit r: some bin has room r
        for number, room in rooms.items():
            self.put(number, room)
        self.next = max(rooms, default=-1) + 1

    def put(self, number: int, room: int) -> None:
        if room:
            self.by_room[room].append(number)
            self.present |= 1 << room

    def best_fit(self, length: int) -> int:
        """Place an item; opens a bin if none has room."""
        open_bins = self.present >> length
        if not open_bins:
            number, self.next = self.next, self.next + 1
            self.put(number, self.capacity - length)
            return number
        room = length + (open_bins & -open_bins).bit_length() - 1
        number = self.by_room[room].pop()
        if not self.by_room[room]:
            self.present &= ~(1 << room)
        self.put(number, room - length)
        return number


def place(lengths: np.ndarray, packing: np.ndarray, items: np.ndarray, capacity: int) -> np.ndarray:
    """Best-fit ``items`` (longest first) into a packing where -1 marks what is not placed."""
    placed = packing >= 0
    fill = np.bincount(packing[placed], lengths[placed]).astype(np.int64)
    open_bins = np.flatnonzero(fill)
    bins = Bins(capacity, dict(zip(open_bins.tolist(), (capacity - fill[open_bins]).tolist())))
    out = packing.copy()
    sizes = lengths.tolist()
    for i in items.tolist():
        out[i] = bins.best_fit(sizes[i])
    return renumber(out)


def renumber(packing: np.ndarray) -> np.ndarray:
    return np.unique(packing, return_inverse=True)[1].astype(np.int32)


def fills(lengths: np.ndarray, packing: np.ndarray) -> np.ndarray:
    return np.bincount(packing, lengths)


def fitness(lengths: np.ndarray, packing: np.ndarray, capacity: int) -> float:
    """Mean squared fill: fewer and fuller bins are better."""
    return float(np.mean((fills(lengths, packing) / capacity) ** 2))


def least_bins(lengths: np.ndarray, capacity: int) -> int:
    """Below this no packing can go: tokens over capacity, or pieces over half of it."""
    return max(-(-int(lengths.sum()) // capacity), int((2 * lengths > capacity).sum()))


def crossover(lengths, giver, taker, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Inject well-filled bins of ``giver`` whole into ``taker`` and repair by best fit."""
    full = fills(lengths, giver) / capacity
    wanted = rng.random(len(full)) < 0.5 * (full >= np.quantile(full, 0.5))
    injected = wanted[giver]
    doubled = np.zeros(int(taker.max()) + 1, bool)
    doubled[taker[injected]] = True  # bins of the taker that hold an injected item
    displaced = doubled[taker] & ~injected
    child = taker.astype(np.int64) + len(full)
    child[injected] = giver[injected]
    child[displaced] = -1
    return place(lengths, child, np.flatnonzero(displaced), capacity)


def mutate(lengths, packing, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Dissolve the emptiest bins and a few others, and place their items again."""
    full = fills(lengths, packing)
    few = max(2, len(full) // 50)
    gone = np.zeros(len(full), bool)
    gone[np.argsort(full, kind="stable")[:few]] = True
    gone[rng.integers(0, len(full), few)] = True
    loose = gone[packing]
    rest = packing.astype(np.int64)
    rest[loose] = -1
    return place(lengths, rest, np.flatnonzero(loose), capacity)


def next_fit(lengths: np.ndarray, order: np.ndarray, capacity: int) -> np.ndarray:
    """A cheap packing: bins are closed as soon as the next item does not fit."""
    sums, start, number = np.cumsum(lengths[order]), 0, 0
    out = np.empty(len(lengths), np.int32)
    while start < len(order):
        before = sums[start - 1] if start else 0
        stop = int(np.searchsorted(sums, before + capacity, "right"))
        out[order[start:stop]] = number
        start, number = stop, number + 1
    return out


def first_packings(lengths: np.ndarray, capacity: int, many: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Best fit of the pieces by falling length, and packings of orders disturbed more and more.

    Where best fit has reached the least number of bins, cheap packings do for the others.
    """
    empty = np.full(len(lengths), -1, np.int64)
    found = [place(lengths, empty, np.arange(len(lengths)), capacity)]
    reached = found[0].max() + 1 <= least_bins(lengths, capacity)
    for k in range(1, FEW_PARENTS if reached else many):
        order = np.argsort(-lengths * rng.normal(1.0, 0.05 * k, len(lengths)), kind="stable")
        found.append(next_fit(lengths, order, capacity) if reached else place(lengths, empty, order, capacity))
    return found


def evolve(
    lengths: np.ndarray,
    population: list[np.ndarray],
    capacity: int,
    generations: int,
    rng: np.random.Generator,
    least_generations: int = 0,
) -> list[np.ndarray]:
    """The population after some generations, best first; ``lengths`` fall.

    Fewer bins are better, of as many bins the more unevenly filled ones.
    """
    least = least_bins(lengths, capacity)

    def rank(packing):
        return (int(packing.max()) + 1, -fitness(lengths, packing, capacity))

    population = sorted(population, key=rank)
    for generation in range(generations):
        reached = population[0].max() + 1 <= least
        if reached and generation >= least_generations:
            break
        children = []
        for _ in range(FEW_CHILDREN if reached else POPULATION // 2):
            a, b = rng.permutation(len(population))[:2] if len(population) > 1 else (0, 0)
            child = crossover(lengths, population[min(a, b)], population[max(a, b)], capacity, rng)
            children.append(mutate(lengths, child, capacity, rng))
        population = sorted(population + children, key=rank)[:POPULATION]
    return population


# --- jobs -----------------------------------------------------------------------------

STATE = "block long, island int, rows binary, lengths binary, bins int, elites array<binary>"


def _state(block, island, rows, lengths, population) -> dict:
    return {
        "block": block,
        "island": island,
        "rows": rows.astype("<i8").tobytes(),
        "lengths": lengths.astype("<i4").tobytes(),
        "bins": int(population[0].max()) + 1,
        "elites": [p.astype("<i4").tobytes() for p in population[:ELITES]],
    }


STATE_ARROW = pa.schema(
    [("block", pa.int64()), ("island", pa.int32()), ("rows", pa.binary()), ("lengths", pa.binary()),
     ("bins", pa.int32()), ("elites", pa.list_(pa.binary()))]
)


def settle(items: DataFrame, capacity: int, block_pieces: int, rounds: int) -> DataFrame:
    """``block, rows, lengths, elites`` with the best packing of every block first.

    ``items`` has ``row`` (a number of its own) and ``length``; longest pieces first,
    equal ones by row, so a lost task gives the same packing again.
    """
    n = items.count()
    blocks = max(1, -(-n // block_pieces))
    dealt = items.select(F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"), "row", "length")

    def begin(group: pa.Table) -> pa.Table:
        rows, lengths = group["row"].to_numpy(), group["length"].to_numpy()
        order = np.lexsort((rows, -lengths))
        rows, lengths = rows[order], lengths[order]
        block, states = int(group["block"][0].as_py()), []
        for island in range(ISLANDS):
            rng = np.random.default_rng([block, island])
            population = first_packings(lengths, capacity, POPULATION, rng)
            population = evolve(lengths, population, capacity, GENERATIONS, rng, LEAST_GENERATIONS)
            states.append(_state(block, island, rows, lengths, population))
            if states[-1]["bins"] <= least_bins(lengths, capacity):
                break
        return pa.Table.from_pylist(states, STATE_ARROW)

    def go_on(turn: int):
        def run(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    lengths = np.frombuffer(row["lengths"], "<i4").astype(np.int64)
                    population = [np.frombuffer(p, "<i4") for p in row["elites"]]
                    population += [np.frombuffer(p, "<i4") for p in row["guests"] or []]
                    rng = np.random.default_rng([row["block"], row["island"], turn])
                    population = evolve(lengths, population, capacity, GENERATIONS, rng)
                    rows = np.frombuffer(row["rows"], "<i8")
                    state = _state(row["block"], row["island"], rows, lengths, population)
                    yield pa.RecordBatch.from_pylist([state], STATE_ARROW)

        return run

    state = materialize(dealt.groupBy("block").applyInArrow(begin, STATE), "islands")
    for turn in range(1, rounds):
        # the best packing of each island visits the next island of its block
        guests = state.select(
            "block",
            F.pmod(F.col("island") + 1, F.lit(ISLANDS)).cast("int").alias("island"),
            F.slice("elites", 1, 1).alias("guests"),
        )
        state = materialize(
            state.join(guests, ["block", "island"], "left").mapInArrow(go_on(turn), STATE), "islands"
        )
    best = state.groupBy("block").agg(
        F.min_by(F.struct("rows", "lengths", "elites"), F.struct("bins", "island")).alias("best")
    )
    return best.select("block", "best.rows", "best.lengths", F.element_at("best.elites", 1).alias("packing"))


def unpacked(settled: DataFrame, capacity: int, pool_fill: float) -> DataFrame:
    """``row, length, block, bin, offset`` of every piece; ``loose`` marks poorly filled bins."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.frombuffer(row["lengths"], "<i4").astype(np.int64)
                packing = np.frombuffer(row["packing"], "<i4")
                order = np.argsort(packing, kind="stable")
                ends = np.cumsum(lengths[order])
                start = ends - lengths[order]
                first = np.r_[True, packing[order][1:] != packing[order][:-1]]
                offset = np.empty(len(order), np.int64)
                offset[order] = start - np.maximum.accumulate(np.where(first, start, 0))
                loose = (fills(lengths, packing) < pool_fill * capacity)[packing]
                n = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(row["rows"], "<i8")), pa.array(lengths),
                     pa.array(np.full(n, row["block"], np.int64)), pa.array(packing.astype(np.int64)),
                     pa.array(offset), pa.array(loose)],
                    names=["row", "length", "block", "bin", "offset", "loose"],
                )

    return settled.mapInArrow(run, "row long, length long, block long, bin long, offset long, loose boolean")


def pack(
    docs: DataFrame,
    path: str,
    text: str = "text",
    key: str = "doc_id",
    capacity: int = CAPACITY,
    block_pieces: int = BLOCK_PIECES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Every piece with its sequence and its place there."""
    found = pieces(docs, path, text, key, capacity).withColumn("row", F.monotonically_increasing_id())
    found = materialize(found, "pieces")  # from here on the row numbers stand
    placed = materialize(unpacked(settle(found, capacity, block_pieces, rounds), capacity, POOL_FILL), "packed")
    again = placed.filter("loose").select("row", "length")
    pooled = unpacked(settle(again, capacity, block_pieces, rounds), capacity, 0.0)

    def numbered(rows: DataFrame, level: int) -> DataFrame:
        # blocks have fewer than 2^24 bins, and there are fewer than 2^38 blocks
        number = F.shiftleft(F.col("block"), 24) + F.col("bin") + F.lit(level << 62)
        return rows.select("row", number.alias("sequence_id"), "offset")

    where = numbered(placed.filter("NOT loose"), 0).unionByName(numbered(pooled, 1))
    return found.join(where, "row").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query("op2_best_fit_packing")
def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))
