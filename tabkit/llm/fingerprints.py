"""Document fingerprints by invertible Bloom lookup sketches.

A text is cut into short passages behind bytes that a hash of themselves and the three
before them chooses, inside words as well as between them, so that an edit moves no cut far
from it.  Passages are shorter near the start of a text, so that short texts have enough of
them to be told apart; the rule is one for all texts, whatever their size or script, and
no passage is longer than a stated number of bytes.  Each passage's
digest is added to three cells of a sketch; a cell holds a count, a sum of digests and a
sum of checks.  Subtracting two sketches leaves the differing digests, which are peeled
off cell by cell.  If peeling gets stuck, both texts are sketched again with more cells.

A repeated passage counts every time: its digest includes how often it came before.
Likeness is twice the number of shared digests over the number of all, 1 for two empty
texts.  The fingerprint is the text's sketch at the smallest size, with its number of
digests, in hexadecimal; equal texts have equal ones.  Null text is taken as empty.
"""

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.llm.common import U64, SpanHasher, mix, query, reach_package, table

# Mean bytes of a passage at the start of a text and far from it, how many bytes further in
# it is one byte longer, and the most bytes of any.
FIRST_BYTES, PASSAGE_BYTES, GROWS_EVERY, MOST_BYTES = 3, 24, 16, 96
# Odd multipliers of the hash that chooses cuts: fixed values of our own.
TURNS = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)
HASHES = 3
# Cells per hash of the fingerprint, and how much larger a retry is.
SMALLEST = 8
GROWTH = 2
CHECK = 0xA0761D6478BD642F
STEP = 0xE7037ED1A0B428DB
# Text of one task of the query that pairs each document with the next.
RANGE_BYTES = 24 << 20


def _odds() -> np.ndarray:
    """Below which hash a byte is a cut, by its place; the last holds for all further ones."""
    mean = np.arange(FIRST_BYTES, PASSAGE_BYTES + 1).repeat(GROWS_EVERY)
    return (2**32 // mean).astype(np.uint32)


ODDS = _odds()


def ends_of_passages(data: np.ndarray) -> np.ndarray:
    """Where the passages of a text end, by its bytes."""
    x = data.astype(np.uint32) + np.uint32(1)
    h = x.copy()
    with np.errstate(over="ignore"):
        for back, turn in enumerate(TURNS, start=1):
            h[back:] += x[:-back] * np.uint32(turn)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(13)
    near = min(len(h), len(ODDS))
    chosen = h < ODDS[-1]
    chosen[:near] = h[:near] < ODDS[:near]
    chosen[-1] = True
    ends = np.flatnonzero(chosen) + 1
    starts = np.r_[0, ends[:-1]]
    more = (ends - starts - 1) // MOST_BYTES  # cuts of its own that a long passage gets
    if more.any():
        inner = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1
        ends = np.sort(np.r_[ends, np.repeat(starts, more) + inner * MOST_BYTES])
    return ends


def passage_digests(hasher: SpanHasher, text: str) -> np.ndarray:
    """64-bit digests of the passages of a text, repeats told apart."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if not len(data):
        return np.zeros(0, U64)
    ends = ends_of_passages(data)
    return tell_apart(hasher.spans(data, np.r_[0, ends[:-1]], ends))


def tell_apart(digest: np.ndarray) -> np.ndarray:
    """Give the second, third ... of equal digests a digest of its own."""
    ranked = np.sort(digest)
    if not (ranked[1:] == ranked[:-1]).any():
        return digest
    fresh = np.r_[True, ranked[1:] != ranked[:-1]]
    place = np.arange(len(ranked))
    earlier = place - np.maximum.accumulate(np.where(fresh, place, 0))
    with np.errstate(over="ignore"):
        return np.where(earlier == 0, ranked, mix(ranked + earlier.astype(U64) * U64(STEP)))


class Sketches:
    """Sketches of many sets side by side, each with ``width`` cells for every hash."""

    def __init__(self, sets: int, width: int):
        self.width, self.sets = width, sets
        cells = sets * width * HASHES
        self.count = np.zeros(cells, np.int64)
        self.digests = np.zeros(cells, U64)
        self.checks = np.zeros(cells, U64)

    def cells_of(self, owner: np.ndarray, digest: np.ndarray) -> np.ndarray:
        """The three cells of every digest, one row per hash."""
        with np.errstate(over="ignore"):
            rows = []
            for i in range(HASHES):
                slot = (mix(digest + U64((i + 1) * STEP % (1 << 64))) % U64(self.width)).astype(np.int64)
                rows.append((owner * HASHES + i) * self.width + slot)
        return np.stack(rows)

    def add(self, owner: np.ndarray, digest: np.ndarray, sign: int = 1) -> None:
        with np.errstate(over="ignore"):
            value, check = digest, mix(digest ^ U64(CHECK))
            if sign < 0:
                value, check = U64(0) - value, U64(0) - check
        for cells in self.cells_of(owner, digest):
            np.add.at(self.count, cells, sign)
            np.add.at(self.digests, cells, value)
            np.add.at(self.checks, cells, check)

    def part(self, start: int, stop: int) -> "Sketches":
        """The sketches of some of the sets."""
        out, cells = Sketches(0, self.width), self.width * HASHES
        out.sets = stop - start
        for name in ("count", "digests", "checks"):
            setattr(out, name, getattr(self, name)[start * cells : stop * cells])
        return out

    def __sub__(self, other: "Sketches") -> "Sketches":
        out = Sketches(0, self.width)
        out.sets = self.sets
        with np.errstate(over="ignore"):
            out.count = self.count - other.count
            out.digests = self.digests - other.digests
            out.checks = self.checks - other.checks
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Owners, digests and signs of the differing digests; which sets came out whole."""
        found = []
        while True:
            pure = np.flatnonzero(np.abs(self.count) == 1)
            with np.errstate(over="ignore"):
                negative = self.count[pure] < 0
                value = np.where(negative, U64(0) - self.digests[pure], self.digests[pure])
                check = np.where(negative, U64(0) - self.checks[pure], self.checks[pure])
            good = check == mix(value ^ U64(CHECK))
            pure, value, sign = pure[good], value[good], np.where(negative[good], -1, 1)
            if not len(pure):
                break
            owner = pure // (self.width * HASHES)
            # a digest alone in several cells is taken once
            with np.errstate(over="ignore"):
                _, once = np.unique(mix(value + owner.astype(U64) * U64(STEP)), return_index=True)
            owner, value, sign = owner[once], value[once], sign[once]
            for s in (1, -1):
                if (sign == s).any():
                    self.add(owner[sign == s], value[sign == s], -s)
            found.append((owner, value, sign))
        left = (self.count != 0) | (self.digests != 0) | (self.checks != 0)
        whole = ~left.reshape(self.sets, -1).any(axis=1) if self.sets else np.zeros(0, bool)
        if not found:
            empty = np.zeros(0, np.int64)
            return empty, np.zeros(0, U64), empty, whole
        owner, value, sign = (np.concatenate(x) for x in zip(*found))
        return owner, value, sign, whole


def _flat(sets: list[np.ndarray], chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = [len(sets[i]) for i in chosen]
    if not sum(sizes):
        return np.zeros(0, np.int64), np.zeros(0, U64)
    return np.repeat(np.arange(len(chosen)), sizes), np.concatenate([sets[i] for i in chosen])


def sketch(sets: list[np.ndarray], chosen: np.ndarray, width: int) -> Sketches:
    out = Sketches(len(chosen), width)
    out.add(*_flat(sets, chosen))
    return out


def apart(sketches: Sketches) -> np.ndarray:
    """How many digests each subtracted sketch seems to hold, from the spread of its counts."""
    counts = sketches.count.reshape(sketches.sets, HASHES, sketches.width)
    net = counts[:, 0].sum(axis=1)
    spread = (counts**2).sum(axis=(1, 2)) / HASHES - net**2 / sketches.width
    return np.maximum(spread * sketches.width / max(1, sketches.width - 1), np.abs(net))


def differences(
    left: list[np.ndarray], right: list[np.ndarray], first: Sketches | None = None
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every pair of sets, the digests only on the left and only on the right.

    ``first`` are their smallest sketches, subtracted.  Pairs that do not peel are
    sketched again, with as many cells as the counts of the failed try call for and at
    least twice as many as it had.
    """
    out: list = [None] * len(left)
    everything = np.arange(len(left))
    if first is None:
        first = sketch(left, everything, SMALLEST) - sketch(right, everything, SMALLEST)
    waiting: dict[int, list[int]] = {}

    def settle(part: np.ndarray, found: Sketches) -> None:
        likely = apart(found)
        owner, value, sign, whole = found.peel()
        order = np.argsort(owner, kind="stable")
        owner, value, sign = owner[order], value[order], sign[order]
        cuts = np.searchsorted(owner, np.arange(len(part) + 1))
        for k, i in enumerate(part.tolist()):
            if whole[k]:
                v, g = value[cuts[k] : cuts[k + 1]], sign[cuts[k] : cuts[k + 1]]
                out[i] = (v[g > 0], v[g < 0])
            else:
                width = found.width * GROWTH
                while width * HASHES < 1.5 * likely[k]:
                    width *= GROWTH
                waiting.setdefault(width, []).append(i)

    settle(everything, first)
    while waiting:
        width = min(waiting)
        group = np.array(waiting.pop(width))
        # sets beside each other as memory allows
        step = max(1, (1 << 18) // (width * HASHES))
        for at in range(0, len(group), step):
            part = group[at : at + step]
            settle(part, sketch(left, part, width) - sketch(right, part, width))
    return out


def likeness(left: list[np.ndarray], right: list[np.ndarray], first: Sketches | None = None) -> list[float]:
    """Twice the shared digests over all digests, from the peeled differences."""
    found = []
    for a, b, (more, less) in zip(left, right, differences(left, right, first)):
        total = len(a) + len(b)
        found.append(1.0 if not total else (total - len(more) - len(less)) / total)
    return found


def fingerprints(sets: list[np.ndarray], sketches: Sketches) -> list[str]:
    """The smallest sketches as text: number of digests, then counts, digests and checks."""
    cells = SMALLEST * HASHES
    parts = [x.reshape(len(sets), cells) for x in (sketches.count, sketches.digests, sketches.checks)]
    return [
        len(s).to_bytes(4, "little").hex()
        + parts[0][i].astype("<u4").tobytes().hex()
        + parts[1][i].astype("<u8").tobytes().hex()
        + (parts[2][i] >> U64(32)).astype("<u4").tobytes().hex()
        for i, s in enumerate(sets)
    ]


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the start of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


COLUMNS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def ranges(docs: DataFrame, key: str, text: str, range_bytes: int) -> DataFrame:
    """Documents in ranges of descending id, each range with the document that follows it.

    Only the ends of the ranges and one id a range come to the driver (16 bytes for
    ``range_bytes`` of text), and a text moves once (twice if it leads a range).  ``lead``
    marks the copy that only follows.  Rows without an id come last.
    """
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"))
    rows = rows.withColumn("place", F.coalesce(-F.col("doc_id"), F.lit((1 << 63) - 1)))
    size, n = rows.agg(F.sum(F.octet_length("body")), F.count("*")).first()
    many = max(1, min(int((size or 0) // range_bytes) + 1, n or 1))
    found = rows.approxQuantile("place", [i / many for i in range(1, many)], 0.1 / many) if many > 1 else []
    context = docs.sparkSession.sparkContext
    cuts = context.broadcast(np.unique(np.array(found, np.float64)))

    def number(place: np.ndarray) -> np.ndarray:
        """The range of a place: how many cuts are at or below it."""
        return np.searchsorted(cuts.value, place.astype(np.float64), side="right")

    @F.pandas_udf("long")
    def range_of(place: pd.Series) -> pd.Series:
        return pd.Series(number(place.to_numpy()))

    leads = rows.groupBy(range_of("place").alias("range")).agg(F.min("place").alias("place")).toArrow()
    order = np.argsort(leads["range"].to_numpy())
    ends = context.broadcast((leads["range"].to_numpy()[order], leads["place"].to_numpy()[order]))

    @F.pandas_udf("range long, before long")
    def ranges_of(place: pd.Series) -> pd.DataFrame:
        """The range, and for its first document also the range before (that of the very first: the last)."""
        present, first = ends.value
        own = place.to_numpy()
        at = np.minimum(np.searchsorted(first, own), len(first) - 1)
        before = np.where(first[at] == own, present[at - 1], -1)
        return pd.DataFrame({"range": number(own), "before": before})

    rows = rows.withColumn("r", ranges_of("place"))
    own = F.struct(F.col("r.range").alias("range"), F.lit(False).alias("lead"))
    other = F.struct(F.col("r.before").alias("range"), F.lit(True).alias("lead"))
    copies = F.when(F.col("r.before") >= 0, F.array(own, other)).otherwise(F.array(own))
    return rows.select("doc_id", "body", "place", F.explode(copies).alias("x")).select(
        "doc_id", "body", "place", "x.range", "x.lead"
    )


def _compare(rows: pa.Table) -> pa.Table:
    """All columns of the result for one range, its follower last."""
    lead = np.asarray(rows["lead"].to_numpy(zero_copy_only=False), bool)
    place = rows["place"].to_numpy()
    body = rows["body"].to_pylist()
    # equal ids in the order of their texts, so that the outcome is always the same
    order = sorted(range(len(body)), key=lambda i: (bool(lead[i]), place[i], body[i]))
    count = int((~lead).sum())
    hasher = SpanHasher()
    ids, out = rows["doc_id"].to_pylist(), [[] for _ in range(7)]
    step = 256
    for at in range(0, count, step):
        chosen = [body[i] for i in order[at : min(at + step, count) + 1]]
        if at + step >= count and len(chosen) == min(step, count - at):
            chosen.append(chosen[-1])
        own, following = chosen[:-1], chosen[1:]
        changed = [edited(a, b) for a, b in zip(own, following)]
        sets = [passage_digests(hasher, t) for t in chosen]
        changed_sets = [passage_digests(hasher, t) for t in changed]
        n = len(own)
        small = sketch(sets, np.arange(n + 1), SMALLEST)
        mine, small_changed = small.part(0, n), sketch(changed_sets, np.arange(n), SMALLEST)
        values = (
            [ids[i] for i in order[at : at + len(own)]],
            [len(t) for t in own],
            [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
            fingerprints(sets[:-1], mine),
            fingerprints(changed_sets, small_changed),
            likeness(sets[:-1], changed_sets, mine - small_changed),
            likeness(sets[:-1], sets[1:], mine - small.part(1, n + 1)),
        )
        for column, part in zip(out, values):
            column.extend(part)
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return pa.table([pa.array(x, t) for x, t in zip(out, types)], names=names)


def compare_with_next(docs: DataFrame, text: str = "text", key: str = "doc_id", range_bytes: int = RANGE_BYTES) -> DataFrame:
    reach_package(docs.sparkSession)
    return ranges(docs, key, text, range_bytes).groupBy("range").applyInArrow(_compare, COLUMNS)


@query("op7_fingerprints")
def op7_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return compare_with_next(table(spark, folder, "documents"))
