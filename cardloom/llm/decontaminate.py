"""Benchmark decontamination: where do documents repeat benchmark items, up to a
few edits?

Texts are compared as code points, lower-cased one by one, with every run of
white space as one space. A leak is a passage of ``WINDOW`` characters of an item, or a
whole item that is shorter. Every such passage is a window, one at each place of the
item (``STEP`` is 1), so none is missed for where it begins. A window of m characters
occurs where a part of the text can be made from it with at most e = RATE * m
insertions, deletions and substitutions.

The q-gram lemma finds these places: e edits destroy at most ``q e`` of the window's c
q-grams, so such a part has the q-grams of at least ``c - q e`` places, and their diagonals
(place in the text less place in the item) differ by e at most. So they meet in one of the bands
of 2 (e + 1) diagonals that begin every e + 1. Shared places are counted once per item and
band; the windows with enough of them follow from sliding along the sorted places. Those are
aligned, within their diagonals only. An index holds an item's characters and
q-grams once; its windows are numbered one after another and made where they are met.

A q-gram that repeats itself every four characters or less (a divider line, padding) is not
counted. A window of which less than ``MIN_SHARE`` of the q-grams count says too little, as does
an item of fewer than ``min_chars`` characters, and is not searched: it would be
found in clean text. Items of fewer than ``EXACT`` characters must occur without an edit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

Q = 8
WINDOW = 60
STEP = 1
RATE = 0.08
# Without a word of the caller, shorter items are not searched; Q characters at least.
MIN_CHARS = 16
EXACT = 24
MIN_SHARE = 0.75
PERIODS = 4
# Benchmarks are searched in blocks of about so many characters, one index each,
# so that what is sent to the executors does not grow with the benchmark.
BLOCK_CHARS = 4_000_000
# Characters of documents looked at together; pairs of a place in a text and one in an item,
# and windows to be aligned, likewise.
SLICE = 1 << 21
PAIRS = 1 << 21
ALIGNED = 1 << 14

_LOWER = np.array(
    [ord(c.lower()) if len(c.lower()) == 1 else i for i, c in enumerate(map(chr, range(0x10000)))],
    np.uint32,
)
_LOWER[[i for i in range(0x10000) if chr(i).isspace()]] = 32
_BASE = 0x01000193
_TABLE_BITS = 21


def _folded(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Folded code points and the place of each in ``text``."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    high = codes >= 0x10000
    codes = np.where(high, codes, _LOWER[codes & 0xFFFF]) if high.any() else _LOWER[codes]
    space = codes == 32
    space[1:] &= space[:-1].copy()
    if len(space):
        space[0] = False
    at = np.flatnonzero(~space)
    return codes[at], at


def _grams(codes: np.ndarray) -> np.ndarray:
    """A number for each run of Q = 8 characters."""
    out, width, base = codes, 1, _BASE
    while width < Q:
        out = out[:-width] * np.uint32(base) + out[width:]
        width, base = 2 * width, base * base % 2**32
    return out


def _telling(codes: np.ndarray) -> np.ndarray:
    """Whether each q-gram does not repeat itself."""
    out = np.ones(max(0, len(codes) - Q + 1), bool)
    for k in range(1, PERIODS + 1):
        same = np.concatenate([[0], np.cumsum(codes[k:] == codes[:-k])])
        out &= same[Q - k :][: len(out)] - same[: len(out)] < Q - k
    return out


def _slot(grams: np.ndarray) -> np.ndarray:
    return (grams * np.uint32(0x9E3779B1)) >> np.uint32(32 - _TABLE_BITS)


@dataclass
class Index:
    item: np.ndarray  # of each item: its id, its place in codes, its first window, m, e
    base: np.ndarray
    first: np.ndarray
    size: np.ndarray
    edits: np.ndarray
    codes: np.ndarray  # all items one after another, and room for a window
    keys: np.ndarray  # distinct q-grams, sorted, with the bounds of their postings
    bounds: np.ndarray
    owner: np.ndarray  # of each posting: its item, and its place in the item
    place: np.ndarray
    windows: np.ndarray  # of each item: how many
    floor: np.ndarray  # of each window: places to be shared, more than it has where not searched
    fewest: np.ndarray  # of each item: the least of them

    def items(self, window: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, window, "right") - 1

    def starts(self, window: np.ndarray) -> np.ndarray:
        return window - self.first[self.items(window)]


def build_index(
    items: list[tuple[int | None, str | None]], min_chars: int = MIN_CHARS
) -> Index | None:
    """None where no item is long enough."""
    ids, codes = [], []
    for item, text in items:
        folded, _ = _folded((text or "").strip())
        if len(folded) >= max(Q, min_chars):
            ids.append(item)
            codes.append(folded)
    if not ids:
        return None
    length = np.array([len(c) for c in codes])
    size = np.minimum(WINDOW, length)
    windows = length - size + 1
    edits = np.where(size < EXACT, 0, np.floor(RATE * size + 1e-9)).astype(np.int64)
    floors, grams, owners, places = [], [], [], []
    for k, c in enumerate(codes):
        telling = _telling(c)
        has = np.concatenate([[0], np.cumsum(telling)])
        all_ = size[k] - Q + 1
        count = has[all_:] - has[:-all_]
        floor = count - Q * edits[k]
        floors.append(np.where((count >= MIN_SHARE * all_) & (floor > 0), floor, WINDOW))
        places.append(np.flatnonzero(telling))
        grams.append(_grams(c)[telling])
        owners.append(np.full(len(places[-1]), k))
    if min(map(np.min, floors)) >= WINDOW:
        return None
    flat, owner, place = map(np.concatenate, (grams, owners, places))
    order = np.argsort(flat, kind="stable")
    keys, first = np.unique(flat[order], return_index=True)
    return Index(
        np.array(ids, object),
        np.cumsum(length) - length,
        np.cumsum(windows) - windows,
        size,
        edits,
        np.concatenate([*codes, np.zeros(WINDOW, np.uint32)]),
        keys,
        np.append(first, len(flat)),
        owner[order],
        place[order],
        windows,
        np.concatenate(floors),
        np.array([f.min() for f in floors]),
    )


def _runs(low: np.ndarray, many: np.ndarray) -> np.ndarray:
    """low, low + 1, ... of each, ``many`` numbers."""
    return np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())


class Searcher:
    """Finds the windows of an index in texts."""

    def __init__(self, index: Index):
        self.index = index
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[_slot(index.keys)] = True
        self.most = int(index.edits.max())
        self.stride = self.most + 1
        self.fewest = int(index.floor.min())
        self.reach = int((index.size + index.edits).max()) - Q + 1
        self.longest = int(index.windows.max() + index.size.max())
        # Postings by q-gram and item, to look at some items only.
        key = np.repeat(np.arange(len(index.keys)), np.diff(index.bounds))
        self.by_item = key * len(index.item) + index.owner

    def hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and q-grams that may be a window's, where enough of them lie
        close together to be an occurrence."""
        grams = _grams(codes)
        found = self.table[_slot(grams)]
        total = np.zeros(len(found) + 1, np.int32)
        np.cumsum(found, out=total[1:])
        width = min(self.reach, len(found))
        dense = total[width:] - total[:-width] >= self.fewest
        near = np.zeros(len(dense) + 1, np.int32)
        np.cumsum(dense, out=near[1:])
        at = np.flatnonzero(found)
        to = np.minimum(at + 1, len(dense))
        at = at[near[to] > near[np.clip(at - width + 1, 0, len(dense))]]
        return at, grams[at]

    def bands(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window and first diagonal of the bands with enough q-grams."""
        none = np.zeros(0, np.int64)
        if len(codes) < Q:
            return none, none
        at, grams = self.hits(codes)
        if not len(at):
            return none, none
        ix = self.index
        key = np.minimum(np.searchsorted(ix.keys, grams), len(ix.keys) - 1)
        same = ix.keys[key] == grams
        at, key = at[same], key[same]
        # All q-grams of a band lie within ``span`` places; parts of the text overlap by as many.
        span = self.reach + 2 * self.stride
        pairs = np.concatenate([[0], np.cumsum(ix.bounds[key + 1] - ix.bounds[key])])
        windows, lows, a = [none], [none], 0
        while a < len(at):
            b = int(np.searchsorted(pairs, pairs[a] + PAIRS, "right")) - 1
            b = max(b, int(np.searchsorted(at, at[a] + span, "right")))
            to = int(np.searchsorted(at, at[min(b, len(at)) - 1] + span, "right"))
            # Where that makes too many pairs, some of the items at a time.
            todo = [(0, len(ix.item))]
            while todo:
                begin, end = todo.pop()
                low = np.searchsorted(self.by_item, key[a:to] * len(ix.item) + begin)
                many = np.searchsorted(self.by_item, key[a:to] * len(ix.item) + end) - low
                if many.sum() > 4 * PAIRS and end - begin > 1:
                    todo += [(begin, (begin + end) // 2), ((begin + end) // 2, end)]
                elif many.sum():
                    window, diagonal = self._counted(at[a:to], low, many, len(codes))
                    windows.append(window)
                    lows.append(diagonal)
            a = b
        found = np.unique(np.stack([np.concatenate(windows), np.concatenate(lows)]), axis=1)
        return found[0], found[1]

    def _counted(
        self, at: np.ndarray, low: np.ndarray, many: np.ndarray, n: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Window and first diagonal where enough places are shared; of each place of the
        text ``many`` postings from ``low`` on."""
        ix = self.index
        post = _runs(low, many)
        owner, place = ix.owner[post], ix.place[post]
        # Diagonals are counted from -longest, and a band begins one stride lower.
        band = (np.repeat(at, many) - place + self.longest) // self.stride + 1
        wide = (n + self.longest) // self.stride + 3
        group = owner * wide + band
        shared = np.concatenate([group, group - 1]) * self.longest + np.concatenate([place, place])
        shared = np.unique(shared)
        group, place = shared // self.longest, shared % self.longest
        owner = group // wide
        # With the fewest places any window of the item needs, from the k-th shared one on: the
        # windows that hold all of them begin from low to high.
        last = np.arange(len(shared)) + ix.fewest[owner] - 1
        inside = last < len(shared)
        last = np.minimum(last, len(shared) - 1)
        reach = ix.size[owner] - Q + 1
        low = np.maximum(place[last] - reach + 1, 0)
        high = np.minimum(place, ix.windows[owner] - 1)
        good = inside & (group[last] == group) & (low <= high)
        group, owner, low, high = group[good], owner[good], low[good], high[good]
        if not len(group):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        same = np.concatenate([[False], group[1:] == group[:-1]])
        low[1:] = np.where(same[1:], np.maximum(low[1:], high[:-1] + 1), low[1:])
        many = np.maximum(high - low + 1, 0)
        start, group, owner = _runs(low, many), np.repeat(group, many), np.repeat(owner, many)
        first = np.searchsorted(shared, group * self.longest + start)
        end = group * self.longest + np.minimum(start + ix.size[owner] - Q + 1, self.longest)
        window = ix.first[owner] + start
        good = np.searchsorted(shared, end) - first >= ix.floor[window]
        band = group[good] % wide
        return window[good], (band - 1) * self.stride - self.longest + start[good]

    def align(
        self, codes: np.ndarray, window: np.ndarray, low: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fewest edits of each window within its band, and where that part of the
        text begins and ends (the first such begin)."""
        width = 2 * self.stride + 2 * self.most
        base = low - self.most
        big = np.int64(1) << 40  # edits in the high bits, the begin in the low ones
        column = np.arange(width) * big
        now = np.broadcast_to(np.arange(width), (len(window), width)).astype(np.int64).copy()
        best = np.full((len(window), 2), np.iinfo(np.int64).max)
        item = self.index.items(window)
        size, begin = self.index.size[item], self.index.base[item] + self.index.starts(window)
        pattern = self.index.codes[begin[:, None] + np.arange(int(size.max()))]
        for i in range(1, int(size.max()) + 1):
            place = base[:, None] + np.arange(width) + i - 1
            inside = (place >= 0) & (place < len(codes))
            text = np.where(inside, codes[np.clip(place, 0, len(codes) - 1)], 0xFFFFFFFF)
            step = now + (text != pattern[:, i - 1 : i]) * big
            step[:, :-1] = np.minimum(step[:, :-1], now[:, 1:] + big)
            now = np.minimum.accumulate(step - column, axis=1) + column
            done = size == i
            if done.any():
                j = now[done].argmin(axis=1)
                best[done, 0] = now[done, j]
                best[done, 1] = base[done] + i + j
        return best[:, 0] // big, base + best[:, 0] % big, best[:, 1]

    def search(self, texts: list[str]) -> Iterator[tuple[int, int, int, int, int]]:
        """``(text, window, begin, end, edits)``, begins and ends in characters
        of the text as it is. One row for each window and text: the fewest
        edits, then the first begin."""
        gap = self.most + 1  # no occurrence reaches over so many zeros
        at = 0
        while at < len(texts):
            to, chars = at, 0
            while to < len(texts) and (to == at or chars + len(texts[to]) <= SLICE):
                chars += len(texts[to])
                to += 1
            part = texts[at:to]
            codes, place = _folded(("\0" * gap).join(part))
            window, low = self.bands(codes)
            if len(window):
                edits, begin, end = map(
                    np.concatenate,
                    zip(
                        *(
                            self.align(codes, window[k : k + ALIGNED], low[k : k + ALIGNED])
                            for k in range(0, len(window), ALIGNED)
                        )
                    ),
                )
                good = edits <= self.index.edits[self.index.items(window)]
                window, edits, begin, end = window[good], edits[good], begin[good], end[good]
                starts = np.cumsum([0, *(len(t) + gap for t in part)])
                first, last = place[begin], place[end - 1] + 1
                text = np.searchsorted(starts, first, "right") - 1
                order = np.lexsort((first, edits, window, text))
                seen = None
                for k in order:
                    if seen != (text[k], window[k]):
                        seen = (text[k], window[k])
                        s = starts[text[k]]
                        yield (
                            at + int(text[k]),
                            int(window[k]),
                            int(first[k] - s),
                            int(last[k] - s),
                            int(edits[k]),
                        )
            at = to


def _indexes(
    benchmark: DataFrame, id_col: str, text_col: str, min_chars: int = MIN_CHARS
) -> Iterator[Index]:
    """One index for each block of the benchmark."""
    items = benchmark.select(
        F.col(f"`{id_col}`").alias("item"), F.col(f"`{text_col}`").alias("text")
    ).where(f"length(text) >= {max(Q, min_chars)}")
    chars = items.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    blocks = -(-int(chars) // BLOCK_CHARS)
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("text", "item"), F.lit(blocks)) == k)
        index = build_index([(r["item"], r["text"]) for r in part.collect()], min_chars)
        if index is not None:
            yield index


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    min_chars: int = MIN_CHARS,
) -> DataFrame:
    """``doc_id, item_id, item_start, doc_start, doc_end, edits``: one row for
    every document row and window of an item that occurs in it; of several
    occurrences that with the fewest edits, then the first.

    ``item_start`` counts characters of the folded item, ``doc_start`` and
    ``doc_end`` characters of the text. Null and empty texts contain nothing;
    items of fewer than ``min_chars`` (at least 8) characters are not searched; rows and items
    that repeat are reported as often; null ids are kept. Other columns are not
    read. Empty tables give an empty result.
    """
    schema = (
        "doc_id long, item_id long, item_start long, doc_start long, doc_end long, edits long"
    )
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
    )
    out = None
    for index in _indexes(benchmark, item_id, item_text, min_chars):
        found = rows.mapInArrow(_finder(index), schema)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def _finder(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(index)
        for batch in batches:
            ids = batch.column("doc_id")
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found = list(searcher.search(texts))
            text, window, begin, end, edits = zip(*found) if found else ([],) * 5
            window = np.array(window, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(text, pa.int64())),
                    pa.array(index.item[index.items(window)].tolist(), pa.int64()),
                    pa.array(index.starts(window)),
                    pa.array(begin, pa.int64()),
                    pa.array(end, pa.int64()),
                    pa.array(edits, pa.int64()),
                ],
                ["doc_id", "item_id", "item_start", "doc_start", "doc_end", "edits"],
            )

    return run


def _flagger(index: Index):
    @arrow_udf("boolean")
    def leaky(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        searcher = Searcher(index)
        for batch in texts:
            flags = np.zeros(len(batch), bool)
            for text, *_ in searcher.search([t or "" for t in batch.to_pylist()]):
                flags[text] = True
            yield pa.array(flags)

    return leaky


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    **columns: str,
) -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs, with all their
    columns. Cases as in ``leaks``."""
    for index in _indexes(
        benchmark, columns.get("item_id", "item_id"), columns.get("item_text", "text"), min_chars
    ):
        docs = docs.where(~_flagger(index)(F.col(f"`{text_col}`")))
    return docs
