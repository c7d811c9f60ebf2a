"""Packing: documents as token ids, cut into full training windows whose parts
belong together.

Documents are tokenized once and written down, then dealt out by a lexical key
(the smallest hash among their longer words, then the id), so that texts with
rare words in common come to the same shard and no shard grows with the corpus.
A shard holds a BM25 inverted index of its documents. The first document not yet used
opens a window; the index returns its unused neighbours, best first, and they
fill the window. What does not fit goes on in the next window, for which it is the seed.

Every window but the last of a task is full. That one is cut into pieces as
long as the powers of two its length is the sum of, so nothing is padded.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm import words
from cardloom.llm.common import staged

WINDOW = 2048
# Tokens of one shard, and of the documents dealt to one task.
SHARD_TOKENS = 1 << 18
TASK_TOKENS = 1 << 23
K1, B = 1.2, 0.75
# The key looks at words of more bytes than this if there are any.
KEY_BYTES = 5


def _kind(tokenizer: str) -> str:
    """How ids are stored, by the highest one of the tokenizer's file."""
    file = json.loads(tokenizer)
    ids = [*file["model"]["vocab"].values(), *(t["id"] for t in file["added_tokens"])]
    return "<u2" if max(ids) < 1 << 16 else "<u4"


class _Coder:
    """Token ids of words, each distinct word encoded once.

    ``tokenizer`` ignores case, drops white space and never joins characters over
    it, so the ids of a text are those of its words in turn. It also cuts between
    letters and anything else, so a word of letters is one piece, whose last id alone
    carries the end-of-word mark; many of them are encoded in one call and told
    apart by that mark. Other words are encoded between two special tokens. A special token in a
    text is its id, as the tokenizer has it.
    """

    # Distinct words remembered; then it begins anew, with the same results.
    MOST = 1_000_000
    AT_ONCE = 500

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.whole = Tokenizer.from_str(tokenizer)
        model = json.loads(tokenizer)["model"]
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        # The words that come here are new ones: a cache of its own would not help.
        self.letters = Tokenizer(
            models.BPE(
                vocab=model["vocab"],
                merges=merges,
                cache_capacity=0,
                end_of_word_suffix=model["end_of_word_suffix"],
            )
        )
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.CharDelimiterSplit(" "),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        vocabulary = self.whole.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self.kind = _kind(tokenizer)
        self.ends = np.zeros(self.size, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        special = json.loads(tokenizer)["added_tokens"]
        self.mark = special[-1]["content"] if special else None
        self.mark_id = special[-1]["id"] if special else None
        self.specials = tuple(t["content"] for t in special)
        self.forget()

    def folded(self, raw: np.ndarray) -> np.ndarray:
        """Small letters, but for what would be a special token only then: those are met in
        the text as it is."""
        low = _folded(raw)
        data = low.tobytes()
        for name in (s.encode() for s in self.specials):
            at = data.find(name)
            while at >= 0:
                low[at : at + len(name)] = raw[at : at + len(name)]
                at = data.find(name, at + 1)
        return low

    def forget(self) -> None:
        self.names = np.zeros(0, words.U64)  # hashes, sorted, and the slot of each
        self.slot = np.zeros(0, np.int64)
        self.begin = np.zeros(1, np.int64)  # of slot k; the last one is the end of all
        self.ids = np.zeros(0, np.uint32)

    def _encoded(self, coder, texts: list[str]) -> list[np.ndarray]:
        found = coder.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]

    def _of_letters(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Ids and counts of words of lower-case letters."""
        ids = []
        for a in range(0, len(starts), self.AT_ONCE):
            size = ends[a : a + self.AT_ONCE] - starts[a : a + self.AT_ONCE] + 1
            joined = low[np.minimum(_runs(starts[a : a + self.AT_ONCE], size), len(low) - 1)]
            joined[np.cumsum(size) - 1] = 32
            ids.append(joined.tobytes().decode())
        ids = np.concatenate([np.zeros(0, np.uint32), *self._encoded(self.letters, ids)])
        last = np.flatnonzero(self.ends[ids])
        if len(last) != len(starts):
            raise ValueError("a word of letters is not one piece")
        return ids, np.diff(last, prepend=-1)

    def _of_others(self, chunks: list[str]):
        safe = [not self.mark or any(x in c for x in self.specials) for c in chunks]
        count = np.zeros(len(chunks), np.int64)
        each: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(chunks)
        mixed = [k for k, s in enumerate(safe) if not s]
        for a in range(0, len(mixed), self.AT_ONCE):
            part = mixed[a : a + self.AT_ONCE]
            ids = self._encoded(self.whole, [self.mark.join([*(chunks[k] for k in part), ""])])[0]
            for k, x in zip(part, np.split(ids, np.flatnonzero(ids == self.mark_id) + 1)):
                each[k] = x[:-1]
        for k, x in zip(
            np.flatnonzero(safe), self._encoded(self.whole, [c for c, s in zip(chunks, safe) if s])
        ):
            each[k] = x
        count[:] = [len(x) for x in each]
        return np.concatenate([np.zeros(0, np.uint32), *each]), count

    def slots(
        self, hashed: np.ndarray, low: np.ndarray, starts: np.ndarray, ends: np.ndarray
    ) -> np.ndarray:
        """The slot of each of the distinct words, whose hashes are sorted."""
        if len(self.names) + len(hashed) > self.MOST:
            self.forget()
        at = np.searchsorted(self.names, hashed)
        known = np.zeros(len(hashed), bool)
        if len(self.names):
            known = self.names[np.minimum(at, len(self.names) - 1)] == hashed
        out = np.empty(len(hashed), np.int64)
        out[known] = self.slot[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            total = np.concatenate([[0], np.cumsum(~_is_letter(low))])
            plain = total[ends[new]] == total[starts[new]]
            letters, others = new[plain], new[~plain]
            ids, count = self._of_letters(low, starts[letters], ends[letters])
            data = low.tobytes()
            more, many = self._of_others(
                [data[a:b].decode() for a, b in zip(starts[others].tolist(), ends[others].tolist())]
            )
            first = len(self.begin) - 1
            out[letters] = first + np.arange(len(letters))
            out[others] = first + len(letters) + np.arange(len(others))
            self.ids = np.concatenate([self.ids, ids, more])
            count = np.concatenate([count, many])
            self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(count)])
            self.names = np.insert(self.names, at[new], hashed[new])
            self.slot = np.insert(self.slot, at[new], out[new])
        return out


def _folded(raw: np.ndarray) -> np.ndarray:
    """Bytes with A-Z and the capitals of two bytes that begin with C3 made small."""
    low = words.LOWER[raw]
    after = np.zeros(len(raw), bool)
    after[1:] = raw[:-1] == 0xC3
    low[after & (raw >= 0x80) & (raw <= 0x9E) & (raw != 0x97)] += 0x20
    return low


def _is_letter(low: np.ndarray) -> np.ndarray:
    """Whether a byte belongs to a-z or to a small letter that begins with C3."""
    lead = low == 0xC3
    tail = np.zeros(len(low), bool)
    tail[1:] = lead[:-1]
    tail &= (low != 0x97) & (low != 0xB7)
    lead[:-1] = tail[1:]
    lead[-1:] = False
    return _LETTER[low] | tail | lead


def _runs(begin: np.ndarray, many: np.ndarray) -> np.ndarray:
    """All places of the runs that begin there and have so many places."""
    total = np.cumsum(many)
    return np.repeat(begin - total + many, many) + np.arange(total[-1] if len(total) else 0)


_coders: dict[int, _Coder] = {}
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
# A full stop or comma after ASCII letters is a word of its own.
_POINTS = np.zeros(256, bool)
_POINTS[[ord("."), ord(",")]] = True


def _cut(low: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, points cut off, and the texts' bounds among them."""
    starts, ends = words.spans(low, bounds)
    point = _POINTS[low[ends - 1]] & (ends - starts > 1)
    point[point] = _LETTER[low[ends[point] - 2]]
    order = np.cumsum(1 + point)
    both = np.empty((2, order[-1] if len(order) else 0), np.int64)
    both[0, order - 1], both[1, order - 1] = starts, ends
    both[0, order[point] - 1] = ends[point] - 1
    both[0, order[point] - 2], both[1, order[point] - 2] = starts[point], ends[point] - 1
    return both[0], both[1], np.searchsorted(both[0], bounds)


def _tokenized(tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = hash(tokenizer)
        coder = _coders.get(name) or _coders.setdefault(name, _Coder(tokenizer))
        for batch in batches:
            ids, size, key = [], [], []
            for _, raw, bounds in words.slices(batch.column("text"), 2 * words.CHUNK):
                low = coder.folded(raw)
                starts, ends, at = _cut(low, bounds)
                hashed = words.hashes(low, starts, ends)
                names, first, which = np.unique(hashed, return_index=True, return_inverse=True)
                slot = coder.slots(names, low, starts[first], ends[first])[which]
                begin, many = coder.begin[slot], coder.begin[slot + 1] - coder.begin[slot]
                out = coder.ids[_runs(begin, many)]
                cuts = np.concatenate([[0], np.cumsum(many)])[at]
                # A document has its end id, so none is empty.
                out = np.insert(out, cuts[1:], np.uint32(end_id)).astype(coder.kind)
                cuts = cuts + np.arange(len(cuts))
                long = np.where(ends - starts > KEY_BYTES, hashed, hashed | words.U64(1 << 63))
                for a, b, w, v in zip(cuts[:-1], cuts[1:], at[:-1], at[1:]):
                    ids.append(out[a:b].tobytes())
                    size.append(int(b - a))
                    key.append(int(long[w:v].min() >> words.U64(1)) if v > w else 0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(key, pa.int64()),
                    pa.array(size, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                ["doc_id", "key", "doc_tokens", "ids"],
            )

    return run


class _Shard:
    """A BM25 index of some documents, each an array of token ids."""

    def __init__(self, docs: list[np.ndarray], end_id: int):
        n = len(docs)
        size = np.array([len(d) for d in docs])
        owner = np.repeat(np.arange(n), size)
        term = np.concatenate(docs).astype(np.int64)
        word = term != end_id
        pair, count = np.unique(owner[word] << 32 | term[word], return_counts=True)
        owner, term = pair >> 32, pair & 0xFFFFFFFF
        names, term = np.unique(term, return_inverse=True)
        df = np.bincount(term, minlength=len(names))
        # Terms of more than half of the documents weigh nothing and are left out.
        idf = np.log((n - df + 0.5) / (df + 0.5))
        useful = idf[term] > 0
        owner, term, count = owner[useful], term[useful], count[useful]
        norm = K1 * (1 - B + B * size / size.mean())
        weight = idf[term] * count * (K1 + 1) / (count + norm[owner])
        self.n = n
        self.bounds = np.searchsorted(owner, np.arange(n + 1))
        self.terms = term
        order = np.argsort(term, kind="stable")
        self.doc, self.weight = owner[order], weight[order]
        self.posts = np.searchsorted(term[order], np.arange(len(names) + 1))

    def neighbours(self, seed: int) -> np.ndarray:
        """All documents, the highest BM25 score for the seed's terms first."""
        terms = self.terms[self.bounds[seed] : self.bounds[seed + 1]]
        begin, many = self.posts[terms], self.posts[terms + 1] - self.posts[terms]
        place = _runs(begin, many)
        score = np.bincount(self.doc[place], self.weight[place], self.n)
        return np.argsort(-score, kind="stable")


class _Packer:
    """Fills windows in turn; ``pieces`` has (document, start, window, offset, ids)."""

    def __init__(self, window: int, end_id: int):
        self.size, self.end_id = window, end_id
        self.window = self.used = 0
        self.open: list[list] = []
        self.pieces: list[tuple] = []

    def put(self, doc: int, ids: np.ndarray) -> bool:
        """Place a whole document; whether a window was begun on the way."""
        at, before = 0, self.window
        while at < len(ids):
            n = min(len(ids) - at, self.size - self.used)
            self.open.append((doc, at, self.window, self.used, ids[at : at + n]))
            at, self.used = at + n, self.used + n
            if self.used == self.size:
                self.close()
        return self.window != before

    def close(self) -> None:
        self.pieces += self.open
        self.open, self.used, self.window = [], 0, self.window + 1

    def shard(self, first: int, docs: list[np.ndarray]) -> None:
        index = _Shard(docs, self.end_id)
        unused = np.ones(len(docs), bool)
        seed = 0
        while seed < len(docs):
            if not unused[seed]:
                seed += 1
                continue
            unused[seed] = False
            centre = seed
            self.put(first + seed, docs[seed])
            while self.used and unused.any():
                for k in index.neighbours(centre).tolist():
                    if unused[k]:
                        unused[k] = False
                        if self.put(first + k, docs[k]):
                            centre = k
                            break

    def finish(self) -> None:
        """The open window as pieces of 2^i tokens, long ones first."""
        left = 1 << self.used.bit_length()
        rest, self.open, at = self.open, [], 0
        room = 0
        for doc, start, _, _, ids in rest:
            done = 0
            while done < len(ids):
                if not room:
                    while left > self.used - at:
                        left >>= 1
                    room, offset = left, 0
                n = min(room, len(ids) - done)
                self.pieces.append((doc, start + done, self.window, offset, ids[done : done + n]))
                done, room, offset, at = done + n, room - n, offset + n, at + n
                if not room:
                    self.window += 1


def _packed(window: int, end_id: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 40
        packer = _Packer(window, end_id)
        names: list = []  # of the documents with pieces not yet sent
        sizes: list[int] = []
        shard: list[np.ndarray] = []
        gone = 0

        def send(all_done: bool) -> Iterator[pa.RecordBatch]:
            nonlocal gone
            pieces, packer.pieces = packer.pieces, []
            if pieces:
                doc = [p[0] - gone for p in pieces]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([names[d] for d in doc], pa.int64()),
                        pa.array([p[1] for p in pieces], pa.int64()),
                        pa.array([len(p[4]) for p in pieces], pa.int64()),
                        pa.array([sizes[d] for d in doc], pa.int64()),
                        pa.array([task + p[2] for p in pieces], pa.int64()),
                        pa.array([p[3] for p in pieces], pa.int64()),
                        pa.array([p[4].astype("<u4").tobytes() for p in pieces], pa.binary()),
                    ],
                    ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
                )
            first = min((p[0] for p in packer.open), default=gone + len(names))
            del names[: first - gone], sizes[: first - gone]
            gone = first

        held = 0
        for batch in batches:
            for name, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                ids = np.frombuffer(ids.as_buffer(), kind)
                names.append(name)
                sizes.append(len(ids))
                shard.append(ids)
                held += len(ids)
                if held >= SHARD_TOKENS:
                    packer.shard(gone + len(names) - len(shard), shard)
                    shard, held = [], 0
                    yield from send(False)
        if shard:
            packer.shard(gone + len(names) - len(shard), shard)
        packer.finish()
        yield from send(True)

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, start, length, doc_tokens, sequence_id, offset, ids``: the pieces
    of all documents. ``ids`` holds the piece's ids as little-endian 32-bit numbers.

    ``tokenizer`` is the text of a tokenizer file that drops white space. A document is its
    ids and ``end_id``; each of these lies in one piece, ``start`` ids from the
    document's first one and ``offset`` ids from the first one of its sequence.
    Sequences have ``window`` (a power of two) ids, or, the last ones of a task, a smaller power of two.

    A null or empty text is the end id alone. Null ids and rows that repeat are
    documents like others. Other columns are not read. An empty table gives no pieces.
    """
    docs = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
    )
    tokens = staged(
        docs.mapInArrow(
            _tokenized(tokenizer, end_id),
            "doc_id long, key long, doc_tokens long, ids binary",
        ),
        "tokens",
    )
    total = tokens.agg(F.sum("doc_tokens").alias("n")).first()["n"] or 0
    return (
        tokens.repartitionByRange(max(1, -(-total // TASK_TOKENS)), "key", "doc_id")
        .sortWithinPartitions("key", "doc_id", "doc_tokens", "ids")
        .select("doc_id", "ids")
        .mapInArrow(
            _packed(window, end_id, _kind(tokenizer)),
            "doc_id long, start long, length long, doc_tokens long, sequence_id long, "
            "offset long, ids binary",
        )
    )
