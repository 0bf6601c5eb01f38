"""Token counts by greedy longest match in time linear in the text.

A vocabulary trie has two roots: pieces that open a word and pieces that go on inside it.
Where the walk gets stuck, the failure link of a node leads to the node that holds what is
left after the longest pieces were taken off its front; how many pieces that were is stored
with the link. A word is counted in one pass over its bytes without building any piece.
"""

from __future__ import annotations

import base64
from collections import deque

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tradeledger.llm.common import map_texts

OPEN, INSIDE, NONE = 0, 1, -1
#: Words with a remembered count per task; beyond it the memory starts anew.
MEMORY = 200_000
#: The automaton is sent to every executor; its size is checked against this many trie nodes.
MAX_NODES = 5_000_000


class Automaton:
    """Longest-match automaton over bytes."""

    def __init__(self, opening: list[bytes], inside: list[bytes]) -> None:
        self.goto: dict[int, int] = {}
        piece = [False, False]
        for root, pieces in ((OPEN, opening), (INSIDE, inside)):
            for word in pieces:
                at = root
                for byte in word:
                    key = at << 8 | byte
                    at = self.goto.get(key, NONE)
                    if at == NONE:
                        at = self.goto[key] = len(piece)
                        piece.append(False)
                if word:
                    piece[at] = True
                if len(piece) > MAX_NODES:
                    raise ValueError(f"the vocabulary needs more than {MAX_NODES} nodes")
        self.fail = [NONE] * len(piece)
        self.popped = [0] * len(piece)
        self._link(piece)

    def _link(self, piece: list[bool]) -> None:
        below: list[list[tuple[int, int]]] = [[] for _ in piece]
        for key, child in self.goto.items():
            below[key >> 8].append((key & 255, child))
        queue = deque([OPEN, INSIDE])  # by depth: links lead to nodes that are less deep
        while queue:
            parent = queue.popleft()
            for byte, node in below[parent]:
                queue.append(node)
                if piece[node]:
                    self.fail[node], self.popped[node] = INSIDE, 1
                    continue
                at, popped = self.fail[parent], self.popped[parent]
                while at != NONE and (at << 8 | byte) not in self.goto:
                    popped += self.popped[at]
                    at = self.fail[at]
                if at != NONE:
                    self.fail[node], self.popped[node] = self.goto[at << 8 | byte], popped

    def count(self, word: bytes) -> int:
        """Pieces of ``word``; -1 if the vocabulary cannot spell it."""
        goto, fail, popped = self.goto, self.fail, self.popped
        at, n = OPEN, 0
        for byte in word:
            to = goto.get(at << 8 | byte)
            while to is None:
                n += popped[at]
                at = fail[at]
                if at == NONE:
                    return -1
                to = goto.get(at << 8 | byte)
            at = to
        while at != INSIDE:
            n += popped[at]
            at = fail[at]
            if at == NONE:
                return -1
        return n


def byte_vocabulary(path: str) -> tuple[list[bytes], list[bytes]]:
    """Opening and inside pieces of a ranks file: a piece with a space in front opens a word."""
    with open(path, "rb") as file:
        pieces = [base64.b64decode(line.split()[0]) for line in file if line.strip()]
    return [p for p in pieces if p[:1] == b" "], [p for p in pieces if p[:1] != b" "]


UNKNOWN = 1 << 40


class Counted(dict):
    """Remembers the count of a word; an unknown word is one token, marked above bit 40."""

    def __init__(self, automaton: Automaton, prefix: bytes) -> None:
        self.automaton, self.prefix = automaton, prefix

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.count(self.prefix + word)
        if len(self) >= MEMORY:
            self.clear()
        n = n if n >= 0 else UNKNOWN + 1
        if len(word) <= 64:
            self[word] = n
        return n


def token_counts(
    docs: DataFrame, automaton: Automaton, text: str = "text", keep: list[str] | None = None, prefix: bytes = b" "
) -> DataFrame:
    """``keep`` columns with n_words, n_tokens, n_unknown and n_bytes (long).

    Words are runs of other bytes than ASCII white space. Each word is matched with ``prefix``
    in front, for vocabularies that mark openings by a space. A word that cannot be spelled
    counts as one unknown token. A null text has no words; repeated rows each get their row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(automaton)
    names = ("n_words", "n_tokens", "n_unknown", "n_bytes")

    def make():
        counted = Counted(shared.value, prefix)

        def step(texts):
            out: list[list[int]] = [[], [], [], []]
            for t in texts:
                words = (t or b"").split()
                total = sum(map(counted.__getitem__, words))
                for column, value in zip(out, (len(words), total % UNKNOWN, total // UNKNOWN, len(t or b""))):
                    column.append(value)
            return out

        return step

    return map_texts(docs, text, [T.StructField(n, T.LongType()) for n in names], make, keep)
