"""Greedy word-piece lengths in one pass over each word.

The vocabulary is a trie. A node knows how many pieces are certain once the walk
cannot go on from it (``popped``) and at which node the rest of what was
read stands (``fail``). The walk therefore never reads a byte twice, and the
pieces are only counted, never made.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm import words


@dataclass
class Automaton:
    edges: np.ndarray  # node * 256 + byte, sorted
    child: np.ndarray
    fail: np.ndarray  # -1: the word cannot be split
    popped: np.ndarray


def build(vocabulary: list[bytes]) -> Automaton:
    """The automaton of a vocabulary; empty entries are left out."""
    root: dict = {}
    nodes: list[dict] = [root]
    ends: list[bool] = [False]
    for token in vocabulary:
        at = 0
        for byte in token:
            to = nodes[at].get(byte)
            if to is None:
                to = nodes[at][byte] = len(nodes)
                nodes.append({})
                ends.append(False)
            at = to
        if token:
            ends[at] = True
    fail, popped = [-1] * len(nodes), [0] * len(nodes)
    queue = deque([0])
    while queue:
        parent = queue.popleft()
        for byte, node in nodes[parent].items():
            queue.append(node)
            if ends[node]:
                fail[node], popped[node] = 0, 1
                continue
            back, count = fail[parent], popped[parent]
            while back >= 0 and byte not in nodes[back]:
                count += popped[back]
                back = fail[back]
            if back >= 0:
                fail[node], popped[node] = nodes[back][byte], count
    pairs = sorted((n * 256 + b, to) for n, kids in enumerate(nodes) for b, to in kids.items())
    return Automaton(
        np.array([p for p, _ in pairs], np.int64),
        np.array([c for _, c in pairs], np.int64),
        np.array(fail, np.int64),
        np.array(popped, np.int64),
    )


def lengths(auto: Automaton, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lead: bytes):
    """Number of pieces of ``lead`` + each word; 1 for a word that cannot be
    split (it is one unknown token). All words walk side by side."""
    n = len(starts)
    out = np.zeros(n, np.int64)
    if not n or not len(auto.edges):
        return np.ones(n, np.int64)
    node, dead = np.zeros(n, np.int64), np.zeros(n, bool)
    size = ends - starts + len(lead)
    order = np.argsort(-size, kind="stable")
    still = np.searchsorted(-size[order], -np.arange(int(size.max())), "left")

    def popping(which: np.ndarray) -> None:
        out[which] += auto.popped[node[which]]
        node[which] = auto.fail[node[which]]

    for i in range(int(size.max())):
        live = order[: still[i]]
        live = live[~dead[live]]
        byte = (
            np.full(len(live), lead[i]) if i < len(lead) else raw[starts[live] + i - len(lead)]
        ).astype(np.int64)
        while len(live):
            want = node[live] * 256 + byte
            at = np.minimum(np.searchsorted(auto.edges, want), len(auto.edges) - 1)
            hit = auto.edges[at] == want
            node[live[hit]] = auto.child[at[hit]]
            live, byte = live[~hit], byte[~hit]
            popping(live)
            lost = node[live] < 0
            dead[live[lost]] = True
            live, byte = live[~lost], byte[~lost]
    live = np.flatnonzero(~dead & (node > 0))
    while len(live):
        popping(live)
        dead[live[node[live] < 0]] = True
        live = live[node[live] > 0]
    out[dead] = 1
    return out


def _counted(auto: Automaton, lead: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, pieces, longest = [], [], []
            for _, raw, bounds in words.slices(batch.column("text")):
                starts, ends = words.spans(raw, bounds)
                at = np.searchsorted(starts, bounds)
                hashed = words.hashes(raw, starts, ends)
                _, first, which = np.unique(hashed, return_index=True, return_inverse=True)
                each = lengths(auto, raw, starts[first], ends[first], lead)[which]
                total = np.concatenate([[0], np.cumsum(each)])
                count.append(np.diff(at))
                pieces.append(np.diff(total[at]))
                most = np.zeros(len(bounds) - 1, np.int64)
                np.maximum.at(most, np.repeat(np.arange(len(most)), np.diff(at)), each)
                longest.append(most)
            join = lambda x: pa.array(np.concatenate([np.zeros(0, np.int64), *x]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), join(count), join(pieces), join(longest)],
                ["doc_id", "n_words", "n_tokens", "max_word_tokens"],
            )

    return run


def token_counts(
    docs: DataFrame,
    vocabulary: list[bytes],
    lead: bytes = b" ",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_words, n_tokens, max_word_tokens`` for every row.

    Words are runs of characters other than ASCII spaces; each is split with
    ``lead`` before it, always into the longest piece that the vocabulary has. Case
    counts. A word that cannot be split is one token. Null, empty and blank
    texts have 0 words and tokens. Null ids and rows that repeat are kept. Other
    columns are not read; an empty table gives an empty result.
    """
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
    ).mapInArrow(
        _counted(build(vocabulary), lead),
        "doc_id long, n_words long, n_tokens long, max_word_tokens long",
    )
