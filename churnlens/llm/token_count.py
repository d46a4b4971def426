"""Token counts by a linear longest-match automaton.

Greedy longest-match word pieces need no pieces to be counted. Each node of the
vocabulary's trie has a failure link, to the node where matching goes on once the
node's longest pieces are taken, and the number of pieces taken on that way. So a
word is one pass over its bytes.
"""

from __future__ import annotations

import base64
from collections import deque

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.tables import map_batches

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
_START, _INSIDE, _NONE = 0, 1, -1
_KNOWN_WORDS = 400_000  # counts that a worker remembers


def read_ranks(path: str) -> list[bytes]:
    """The pieces of a vocabulary file with a base64 piece and a rank in each line."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


class Automaton:
    """Counts the pieces of a word. A piece that begins with a space begins a word,
    any other goes on with one."""

    def __init__(self, pieces: list[bytes]) -> None:
        self.next: dict[int, int] = {}
        ends, children = set(), [[], []]
        for piece in pieces:
            node, rest = (_START, piece[1:]) if piece[:1] == b" " else (_INSIDE, piece)
            if node == _START and not rest:
                continue  # a lone space is what a word begins with, see below
            for byte in rest:
                step = node << 8 | byte
                if step not in self.next:
                    self.next[step] = len(children)
                    children[node].append(byte)
                    children.append([])
                node = self.next[step]
            if rest:
                ends.add(node)
        self.link = [_NONE] * len(children)
        self.taken = [0] * len(children)
        # A word whose start is in no longer piece takes the lone space for one piece.
        if b" " in pieces:
            self.link[_START], self.taken[_START] = _INSIDE, 1
        waiting = deque([_START, _INSIDE])
        while waiting:
            node = waiting.popleft()
            for byte in children[node]:
                child = self.next[node << 8 | byte]
                waiting.append(child)
                if child in ends:
                    self.link[child], self.taken[child] = _INSIDE, 1
                    continue
                to, taken = self.link[node], self.taken[node]
                while to != _NONE and to << 8 | byte not in self.next:
                    taken += self.taken[to]
                    to = self.link[to]
                if to != _NONE:
                    self.link[child], self.taken[child] = self.next[to << 8 | byte], taken

    def count(self, word: bytes) -> int:
        """Pieces of ``word``; 1, one unknown piece, if it cannot be cut into pieces."""
        steps, link, taken = self.next, self.link, self.taken
        node = count = 0
        for byte in word:
            while (step := steps.get(node << 8 | byte)) is None:
                if link[node] == _NONE:
                    return 1
                count += taken[node]
                node = link[node]
            node = step
        while node != _INSIDE:
            if link[node] == _NONE:
                return 1
            count += taken[node]
            node = link[node]
        return count


class _Counts(dict):
    """Counts of the words seen so far; starts anew when full."""

    def __init__(self, automaton: Automaton) -> None:
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        count = self.automaton.count(word)
        if len(word) <= 64:
            if len(self) >= _KNOWN_WORDS:
                self.clear()
            self[word] = count
        return count


def token_counts(
    docs: DataFrame, *, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``id_col``, ``n_bytes``, ``n_words``, ``n_tokens``.

    Words are runs of anything but ASCII white space, cut greedily into the longest
    pieces of the vocabulary (a file on the driver). Null, empty and blank texts have no
    words. Repeated rows and null ids are counted like any other; no row is left out.
    """
    automaton = docs.sparkSession.sparkContext.broadcast(Automaton(read_ranks(vocabulary)))
    kind = dict(docs.dtypes)[id_col]

    def count(batches):
        known = _Counts(automaton.value)
        for batch in batches:
            texts = [t or b"" for t in batch["text"]]
            words = [t.split() for t in texts]
            yield {
                id_col: batch[id_col],
                "n_bytes": [len(t) for t in texts],
                "n_words": [len(w) for w in words],
                "n_tokens": [sum(map(known.__getitem__, w)) for w in words],
            }

    texts = docs.select(id_col, F.col(text_col).alias("text"))
    schema = f"`{id_col}` {kind}, n_bytes bigint, n_words bigint, n_tokens bigint"
    return map_batches(texts, {id_col: kind, "text": "binary"}, count, schema)
