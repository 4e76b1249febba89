"""Token counts under a unigram model, by dynamic programming shared along a trie.

The distinct pre-tokens of a batch go into a trie; the best score of every prefix is
found once, however many pre-tokens share it, and each terminal keeps the number of
tokens of its best segmentation.  A text's count is the sum over its pre-tokens.

The model is a public sentencepiece file read as a unigram model: pieces with their
scores, characters without a piece spelt in bytes.  Of two equally good segmentations
the one whose last differing piece starts earlier is taken, as sentencepiece does.

A null text counts as empty; empty texts have no tokens.  Spaces are kept, one marked
space stands before the text, and no other character is changed.
"""

from __future__ import annotations

import public_tokenizers
import regex
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tabkit.llm.common import map_text, query, table

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
# Added to the lowest score for a character that no piece covers (fixed value of the format).
UNKNOWN_PENALTY = -10.0
# Distinct pre-tokens a worker remembers; a full memory is emptied and fills again.
MEMO_ENTRIES = 1_000_000
# A pre-token starts at a run of spaces: no piece holds a space after another character.
PRETOKEN = regex.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


def read_pieces(path: str) -> tuple[dict[str, float], float]:
    """Scores of the normal pieces, and that of an uncovered character."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    normal = {
        model.id_to_piece(i): model.get_score(i)
        for i in range(model.get_piece_size())
        if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))
    }
    return normal, min(normal.values()) + UNKNOWN_PENALTY


class CountTrie:
    """Counts the tokens of pre-tokens; prefixes met before are not scored again.

    Nodes are numbers: ``edges`` leads from a node and a character to the node one
    longer, ``score`` and ``count`` hold the best segmentation of each prefix.  The root
    is the space that every pre-token starts with.
    """

    def __init__(self, pieces: dict[str, float], unknown: float):
        self.pieces, self.unknown = pieces, unknown
        # a start is worth a look only while what follows it ends some piece
        self.ends = {p[i:] for p in pieces for i in range(len(p))}
        self.forget()

    def forget(self) -> None:
        self.edges: dict[int, int] = {}
        self.terminals: dict[str, int] = {}
        self.score, self.count = [0.0], [0]
        self.extend([0], SPACE, 1)

    def insert(self, word: str) -> int:
        edges, path, full = self.edges, [0, 1], SPACE + word
        node = 1
        for i, char in enumerate(word):
            edge = node << 21 | ord(char)
            below = edges.get(edge)
            if below is None:
                below = edges[edge] = self.extend(path, full, i + 2)
            node = below
            path.append(node)
        return self.count[node]

    def extend(self, path: list[int], word: str, end: int) -> int:
        """The best way to reach ``end`` from the ways to reach the places before it."""
        best, count, scores, counts = None, 0, self.score, self.count
        pieces, ends = self.pieces, self.ends
        for start in range(end - 1, -1, -1):
            tail = word[start:end]
            if tail in pieces:
                reached = scores[path[start]] + pieces[tail]
                if best is None or reached >= best:  # of equals the longer piece
                    best, count = reached, counts[path[start]] + 1
            elif start == end - 1:
                best = scores[path[start]] + self.unknown
                count = counts[path[start]] + len(tail.encode("utf-8", "surrogatepass"))
            if tail not in ends:
                break
        scores.append(best)
        counts.append(count)
        return len(scores) - 1

    def count_all(self, words) -> None:
        """Make sure that every word has its terminal count."""
        new = [w for w in words if w not in self.terminals]
        if len(self.terminals) + len(new) > MEMO_ENTRIES or len(self.score) > 4 * MEMO_ENTRIES:
            self.forget()
            new = words
        for word in new:
            self.terminals[word] = self.insert(word)


def pretokens(text: str) -> list[str]:
    """The pre-tokens of a text, each without the space it starts with."""
    if not text:
        return []
    words = text.split(" ")
    if SPACE not in text and "" not in words:
        return words
    return [w[1:] for w in PRETOKEN.findall(SPACE + text.replace(" ", SPACE))]


_TRIES: dict[str, CountTrie] = {}


def counts(df: DataFrame, path: str, text: str = "text", keep=("doc_id",)) -> DataFrame:
    """``keep`` and ``n_tokens`` of every whole text."""
    model = df.sparkSession.sparkContext.broadcast(read_pieces(path))  # as large as the vocabulary file

    def make():
        if path not in _TRIES:
            _TRIES[path] = CountTrie(*model.value)
        trie = _TRIES[path]

        def work(texts):
            split = [pretokens(t or "") for t in texts]
            trie.count_all(set().union(*split))
            return [[sum(map(trie.terminals.__getitem__, words)) for words in split]]

        return work

    return map_text(df, text, keep, [T.StructField("n_tokens", T.LongType())], make)


@query("op8_token_counts")
def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return counts(table(spark, folder, "documents"), public_tokenizers.path(MODEL))
