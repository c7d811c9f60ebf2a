"""Token alignment: the tokens of two tokenizers over the same bytes, put side by side.

Tasks encode whole texts with both tokenizers, each chunk that recurs once, and turn token
bytes into end offsets. All
texts of a slice advance in lockstep: one state vector holds a pair of pointers for every
text (a long text has one for each run of ``LANE`` bytes, so that it does not walk on alone).
A step compares all pairs of ends at once, emits a link and a cut where they are equal,
moves the pointer that lies behind (both at a link), and drops pairs that are done.

How often two tokens are linked counts over the whole corpus. A task gathers its texts in
blocks of bounded size and sends each different link of a block once, with its number;
Spark adds these up and finds the highest count of every B id. The counts go back to the
blocks, whose documents then add them up.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm import words
from cardloom.llm.common import staged

# Bytes of text encoded at once, of one state pair, and of a block.
SLICE, LANE, BLOCK = 1 << 20, 1 << 10, 1 << 23
# Different links of a block in one row.
CHUNK = 1 << 16
# Both tokenizers always cut before a single space, which goes with what follows.
SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
# Chunks between such cuts remembered; then it begins anew, with the same results.
MOST = 300_000
# Chunks encoded as one text.
TOGETHER = 1_000
SPACE_MARK = "▁"

DOC = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable
    Latin-1 characters for themselves, the others from U+0100 on in their order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class _Bytes:
    """The bytes of every token id."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        shift = np.repeat(self.begin[ids] - (np.cumsum(size) - size), size)
        return self.flat[shift + np.arange(len(shift))]


class _Coders:
    def __init__(self, byte_level: str, pieces: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_level)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        alphabet = byte_alphabet()
        specials = {t["id"]: t["content"].encode() for t in json.loads(byte_level)["added_tokens"]}
        vocabulary = {i: t for t, i in self.a.get_vocab().items()}
        self.a_bytes = _Bytes(
            [
                specials[i] if i in specials else bytes(alphabet[c] for c in vocabulary.get(i, ""))
                for i in range(max(vocabulary) + 1)
            ]
        )
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = _Bytes(
            [
                bytes([int(t[3:5], 16)]) if self.b.is_byte(i) else t.replace(SPACE_MARK, " ").encode()
                for i, t in enumerate(names)
            ]
        )
        # Without a piece that goes on over a space, a text may be cut before one.
        self.cuts = not any(SPACE_MARK in t.lstrip(SPACE_MARK) for t in names)
        self.forget()

    def forget(self) -> None:
        self.slot: dict[str, int] = {}  # of each chunk met
        self.size = 0
        self.ids = [np.zeros(0, np.int32), np.zeros(0, np.int32)]  # of all chunks in turn
        self.ends = [np.zeros(1, np.int64), np.zeros(1, np.int64)]
        self.kept = np.zeros(0, bool)  # both sides give back the chunk's bytes

    def _learn(self, new: list[str]) -> None:
        """Encode chunks, many of them as one text, told apart by their bytes. Where a side does not
        give that text back, its chunks are encoded one by one."""
        found: list[tuple[list, list]] = [([], []), ([], [])]  # ids and counts of both sides
        kept = []
        tables = self.a_bytes, self.b_bytes
        # Only chunks without white space at their ends stay apart when joined by a space.
        firm = [t for t in new if t == t.strip()]
        loose = [t for t in new if t != t.strip()]
        new = firm + loose
        todo = [firm[k : k + TOGETHER] for k in range(0, len(firm), TOGETHER)] + [[t] for t in loose]
        while todo:
            part = todo.pop(0)
            text = " ".join(part)
            sides = (
                self.a.encode(f" {text}", add_special_tokens=False).ids,
                self.b.encode(text),
            )
            sides = [np.array(x, np.int64) for x in sides]
            want = np.frombuffer(f" {text}".encode(), np.uint8)
            ends = [np.cumsum(t.size[x]) for t, x in zip(tables, sides)]
            good = all(
                len(e) and e[-1] == len(want) and (t.joined(x) == want).all()
                for t, x, e in zip(tables, sides, ends)
            )
            if not good and len(part) > 1:
                step = max(1, len(part) // 8)
                todo = [part[k : k + step] for k in range(0, len(part), step)] + todo
                continue
            kept += [good] * len(part)
            cuts = np.cumsum([len(t.encode()) + 1 for t in part])
            for (ids, count), x, e in zip(found, sides, ends):
                ids.append(x)
                at = np.searchsorted(e, cuts) + 1 if good else [len(x)]
                count.append(np.diff(at, prepend=0))
        for side, (ids, count) in enumerate(found):
            self.ids[side] = np.concatenate([self.ids[side], *ids], dtype=np.int32)
            last = self.ends[side][-1]
            self.ends[side] = np.concatenate([self.ends[side], last + np.cumsum(np.concatenate(count))])
        self.kept = np.concatenate([self.kept, np.array(kept, bool)])
        self.slot.update(zip(new, range(len(self.slot), len(self.slot) + len(new))))
        self.size += sum(map(len, new))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """A ids of a space and the text, B ids of the text, one text after the other, and
        the number of each text's ids; none of a text that either side does not give
        back byte by byte."""
        if len(self.slot) > MOST or self.size > SLICE * 16:
            self.forget()
        chunks, count = [], []
        for text in texts:
            mine = SAFE_CUT.split(text) if self.cuts else [text]
            mine = mine if text else []
            chunks += mine
            count.append(len(mine))
        if new := [t for t in dict.fromkeys(chunks) if t not in self.slot]:
            self._learn(new)
        at = np.fromiter(map(self.slot.__getitem__, chunks), np.int64, len(chunks))
        of = np.repeat(np.arange(len(texts)), count)
        good = np.ones(len(texts), bool)
        good[of[~self.kept[at]]] = False
        at, of = at[good[of]], of[good[of]]
        out = []
        for ids, ends in zip(self.ids, self.ends):
            size = ends[at + 1] - ends[at]
            shift = np.repeat(ends[at] - (np.cumsum(size) - size), size)
            out.append(ids[shift + np.arange(len(shift))].astype(np.int64))
            out.append(np.bincount(of, size, len(texts)).astype(np.int64))
        return tuple(out)


@lru_cache(maxsize=1)
def _coders(byte_level: str, pieces: bytes) -> _Coders:
    return _Coders(byte_level, pieces)


def lockstep(
    end_a: np.ndarray, end_b: np.ndarray, bounds: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Positions in both arrays of ends that are equal. Ends rise strictly; ``bounds``
    are the bytes where texts begin and end."""
    size = np.diff(bounds)
    lanes = -(-size // LANE)
    step = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    low = np.repeat(bounds[:-1], lanes) + step * LANE
    high = np.minimum(low + LANE, np.repeat(bounds[1:], lanes))
    i, j = np.searchsorted(end_a, low, "right"), np.searchsorted(end_b, low, "right")
    stop_i, stop_j = np.searchsorted(end_a, high, "right"), np.searchsorted(end_b, high, "right")
    links_a, links_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while True:
        going = (i < stop_i) & (j < stop_j)
        if not going.all():
            i, j, stop_i, stop_j = i[going], j[going], stop_i[going], stop_j[going]
        if not len(i):
            break
        x, y = end_a[i], end_b[j]
        equal = x == y
        links_a.append(i[equal])
        links_b.append(j[equal])
        i = i + (x <= y)
        j = j + (y <= x)
    return np.sort(np.concatenate(links_a)), np.sort(np.concatenate(links_b))


def group_texts(
    a: np.ndarray, b: np.ndarray, link_a: np.ndarray, link_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of ``a1,a2|b1;...;`` of all groups in turn, and where those of each
    group end. The last token of either side is linked."""
    ends_a, ends_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    ends_a[link_a], ends_b[link_b] = True, True
    before = np.cumsum(ends_a) - ends_a  # the group of each token
    after = np.cumsum(ends_b) - ends_b
    place_a = np.arange(len(a)) + np.concatenate([[0], link_b + 1])[before]
    place_b = np.arange(len(b)) + link_a[after] + 1
    ids = np.empty(len(a) + len(b), np.int64)
    mark = np.empty(len(ids), np.uint8)
    ids[place_a], ids[place_b] = a, b
    mark[place_a] = np.where(ends_a, ord("|"), ord(","))
    mark[place_b] = np.where(ends_b, ord(";"), ord(","))
    width = len(str(ids.max())) if len(ids) else 1
    names = np.array([f"{i:>{width}}" for i in range(int(ids.max()) + 1 if len(ids) else 0)], f"S{width}")
    letters = np.empty((len(ids), width + 1), np.uint8)
    letters[:, :width] = names.view(np.uint8).reshape(-1, width)[ids]
    letters[:, width] = mark
    used = letters != ord(" ")
    end = np.cumsum(used.sum(axis=1))
    out = letters[used]
    return out, end[place_b[link_b]]


def align(texts: list[str], coders: _Coders) -> Iterator[tuple[int, int, np.ndarray, str]]:
    """For each text the numbers of A and B tokens, its links as ``a << 32 | b`` and the digest
    of its groups."""
    a, n_a, b, n_b = coders.encode(texts)
    end_a, end_b = np.cumsum(coders.a_bytes.size[a]), np.cumsum(coders.b_bytes.size[b])
    last_a = np.concatenate([[0], np.cumsum(n_a)])
    link_a, link_b = lockstep(end_a, end_b, np.concatenate([[0], end_a])[last_a])
    text, ends = group_texts(a, b, link_a, link_b)
    ends = np.concatenate([[0], ends])
    of = np.searchsorted(link_a, last_a)
    pairs = (a[link_a] << 32) | b[link_b]
    for k, (first, last) in enumerate(zip(of[:-1], of[1:])):
        digest = hashlib.sha256(text[ends[first] : ends[last] - 1]).hexdigest() if last > first else ""
        yield int(n_a[k]), int(n_b[k]), pairs[first:last], digest


def _first(byte_level: str, pieces: bytes):
    """Rows of documents, whose ``links`` are places in the list of their block's
    different links, and rows of these lists."""
    names = ["block", *[c.split()[0] for c in DOC.split(", ")], "links", "first", "pairs", "times"]

    def rows(block: int, docs: list) -> Iterator[pa.RecordBatch]:
        every = np.concatenate([np.zeros(0, np.int64), *[d[3] for d in docs]])
        pairs, which, times = np.unique(every, return_inverse=True, return_counts=True)
        order = np.argsort(-times, kind="stable")
        place = np.empty(len(order), "<u2" if len(order) <= 1 << 16 else "<u4")
        place[order] = np.arange(len(order))
        links = np.split(place[which], np.cumsum([len(d[3]) for d in docs])[:-1])
        pairs, times = pairs[order], times[order]
        cuts = range(0, len(pairs), CHUNK)
        n, m = len(docs), len(cuts)
        n_links = [len(d[3]) for d in docs]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([block] * (n + m), pa.int64()),
                pa.array([d[0] for d in docs] + [None] * m, pa.int64()),
                pa.array([d[1] for d in docs] + [None] * m, pa.int64()),
                pa.array([d[2] for d in docs] + [None] * m, pa.int64()),
                pa.array(n_links + [None] * m, pa.int64()),  # every link ends a group
                pa.array(n_links + [None] * m, pa.int64()),
                pa.array([d[4] for d in docs] + [None] * m, pa.string()),
                pa.array([x.tobytes() for x in links[:n]] + [None] * m, pa.binary()),
                pa.array([None] * n + list(cuts), pa.int64()),
                pa.array([None] * n + [pairs[c : c + CHUNK] for c in cuts], pa.list_(pa.int64())),
                pa.array([None] * n + [times[c : c + CHUNK] for c in cuts], pa.list_(pa.int64())),
            ],
            names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = _coders(byte_level, pieces)
        block, size, docs = TaskContext.get().partitionId() << 32, 0, []
        for batch in batches:
            texts = batch.column("text")
            for at, raw, bounds in words.slices(texts, SLICE):
                part = [t or "" for t in texts[at : at + len(bounds) - 1].to_pylist()]
                ids = batch.column("doc_id")[at : at + len(part)].to_pylist()
                docs += [(i, *found[:3], found[3]) for i, found in zip(ids, align(part, coders))]
                size += len(raw)
                if size >= BLOCK:
                    yield from rows(block, docs)
                    block, size, docs = block + 1, 0, []
        if docs:
            yield from rows(block, docs)

    return run


def _second(left: pa.Table, right: pa.Table) -> pa.Table:
    """Documents of one block, and count and whether it is the highest of its links."""
    place = right.column("place").to_numpy()
    count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    count[place] = right.column("count").to_numpy()
    best[place] = right.column("best").to_numpy()
    links = [
        np.frombuffer(x, f"<u{len(x) // n}" if n else "<u4")
        for x, n in zip(left.column("links").to_pylist(), left.column("n_links").to_pylist())
    ]
    return (
        left.drop_columns(["block", "links"])
        .append_column("n_best", pa.array([int(best[x].sum()) for x in links], pa.int64()))
        .append_column("count_sum", pa.array([int(count[x].sum()) for x in links], pa.int64()))
    )


def token_alignment(
    docs: DataFrame,
    byte_level: str,
    pieces: bytes,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum`` for
    every row of ``docs``.

    A are the tokens of a space and the text by a byte-level tokenizer (the text of its
    file), B those of the text by a sentencepiece model (its bytes) that adds the space.
    Special tokens' strings are plain text. Where tokens of both sides end at the same byte,
    they are linked and a group ends. ``count_sum`` adds up over a text's links how often
    the corpus has the link, ``n_best`` counts those that are the most frequent of their B
    id, ties included. ``groups_sha256`` digests ``a1,a2|b1;a3|b2,b3``.

    A null or empty text, or one that a tokenizer does not give back byte by byte, has
    zeros and an empty digest. Null ids and repeated rows are documents like others;
    an empty table gives an empty result; other columns are not read.
    """
    docs = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
    )
    first = staged(
        docs.mapInArrow(
            _first(byte_level, pieces),
            f"block long, {DOC}, links binary, first long, pairs array<long>, times array<long>",
        ),
        "token_links",
    )
    lists = (
        first.where("first is not null")
        .select("block", "first", F.posexplode(F.arrays_zip("pairs", "times")).alias("at", "x"))
        .select(F.col("block").alias("of"), F.expr("first + at").alias("place"), "x.pairs", "x.times")
    )
    counts = (
        lists.groupBy("pairs")
        .agg(F.sum("times").alias("count"))
        .withColumn("b", F.expr("pairs & 4294967295"))
    )
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    judged = staged(
        counts.join(highest, "b").select("pairs", "count", F.expr("cast(count = highest as long)").alias("best")),
        "link_counts",
    )
    known = lists.select("of", "place", "pairs").join(judged, "pairs").drop("pairs")
    of_docs = first.where("first is null").drop("first", "pairs", "times")
    return (
        of_docs.groupBy("block")
        .cogroup(known.groupBy("of"))
        .applyInArrow(_second, f"{DOC}, n_best long, count_sum long")
    )
