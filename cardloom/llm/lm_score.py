"""Scoring documents by masked pseudo-likelihood.

Each token is predicted from its neighbours on both sides by a small network: an
embedding of the left word and one of the right word are added, passed through
tanh and turned into probabilities of all classes. The score of a document is the sum
of the log-probabilities of its tokens.

The network predicts a word's class: the most frequent words of the corpus have their
own, all others share ``BUCKETS`` by hash. A word that shares its class is scored as
p(class | context) * p(word | class); the second factor comes from the counts of all
words in all documents, a table that grows with the corpus and is never collected.
With a window of one word to either side, what the corpus says about the network is
the table of counts of (left, right, token). All documents are counted; full-batch
training then runs over that table, which stays distributed: a task returns the
gradient of its part. Training ends when the likelihood levels off.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm import words
from cardloom.llm.common import staged

CLASSES = 256
BUCKETS = 64
WIDTH = 16
RATE = 0.1
# The likelihood has levelled off when ``LOOK`` steps together raise a token's mean
# log-likelihood by less than ``LEVEL``, or when steps of a ``LEAST``-th rate still lower it.
LOOK = 4
LEVEL = 2e-3
LEAST = 1 / 128
# Beside the classes, what stands before the first and after the last token.
EDGE = CLASSES


@dataclass
class Vocabulary:
    """Hashes of the words with a class of their own, sorted; their classes."""

    hashes: np.ndarray
    ids: np.ndarray

    def classes(self, hashed: np.ndarray) -> np.ndarray:
        out = (CLASSES - BUCKETS + (hashed >> words.U64(20)) % words.U64(BUCKETS)).astype(np.int64)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashed), len(self.hashes) - 1)
            hit = self.hashes[at] == hashed
            out[hit] = self.ids[at[hit]]
        return out


@dataclass
class Network:
    left: np.ndarray  # (CLASSES + 1) x WIDTH
    right: np.ndarray
    out: np.ndarray  # WIDTH x CLASSES
    bias: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.left, self.right, self.out, self.bias]

    def table(self) -> np.ndarray:
        """Log-probability of every token between every left and right."""
        hidden = np.tanh(self.left[:, None, :] + self.right[None, :, :]).reshape(-1, WIDTH)
        out = np.empty((len(hidden), CLASSES), np.float32)
        for a in range(0, len(hidden), 4096):
            odds = hidden[a : a + 4096] @ self.out + self.bias
            odds -= odds.max(axis=1, keepdims=True)
            out[a : a + 4096] = odds - np.log(np.exp(odds).sum(axis=1, keepdims=True))
        return out.reshape(-1)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, raw, bounds in words.slices(batch.column("text"), 8 * words.CHUNK):
            hashed, _ = words.word_hashes(raw, bounds, lower=True)
            names, count = np.unique(hashed, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names.view(np.int64)), pa.array(count)], ["word", "n"]
            )


def lexicon(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``word, n``: every word (its hash) of all documents, with its number."""
    return staged(
        docs.select(F.col(f"`{text_col}`").alias("text"))
        .mapInArrow(_word_counts, "word long, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n")),
        "lexicon",
    )


def vocabulary(
    docs: DataFrame, text_col: str = "text", known: DataFrame | None = None
) -> Vocabulary:
    """The most frequent words of all documents (the smaller hash first among
    equals): ``CLASSES - BUCKETS`` of them are fetched. ``known`` is the lexicon of
    ``docs``, where there is one."""
    rows = (
        (lexicon(docs, text_col) if known is None else known)
        .orderBy(F.desc("n"), "word")
        .limit(CLASSES - BUCKETS)
        .collect()
    )
    hashed = np.array([r["word"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(hashed)
    return Vocabulary(hashed[order], np.arange(len(rows))[order])


# The bucket of a word without a class of its own, as in ``Vocabulary.classes``.
_BUCKET = f"cast(shiftrightunsigned(word, 20) % {BUCKETS} as int)"


def bucket_sizes(known: DataFrame, vocab: Vocabulary) -> list[int]:
    """Tokens of all words that share each bucket."""
    own = [int(h) for h in vocab.hashes.view(np.int64)]
    rows = known.where(~F.col("word").isin(own)) if own else known
    out = [0] * BUCKETS
    for r in rows.groupBy(F.expr(_BUCKET).alias("b")).agg(F.sum("n").alias("n")).collect():
        out[r["b"]] = r["n"]
    return out


def _around(vocab: Vocabulary, hashed: np.ndarray, at: np.ndarray):
    """Left, right and own class of every token of texts with bounds ``at``."""
    token = vocab.classes(hashed)
    left = np.concatenate([[EDGE], token])[: len(token)]
    right = np.concatenate([token[1:], [EDGE]])[: len(token)]
    left[at[:-1][at[:-1] < len(token)]] = EDGE
    last = at[1:][at[1:] > 0] - 1
    right[last] = EDGE
    return left, right, token


def _contexts(vocab: Vocabulary):
    """``(place, n)``: how often each (left, right, token) occurs in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((CLASSES + 1) ** 2 * CLASSES, np.int32)
        for batch in batches:
            for _, raw, bounds in words.slices(batch.column("text")):
                left, right, token = _around(vocab, *words.word_hashes(raw, bounds, lower=True))
                place, n = np.unique(
                    (left * (CLASSES + 1) + right) * CLASSES + token, return_counts=True
                )
                total[place] += n.astype(np.int32)
                if len(total) and total.max() > 1 << 30:
                    yield from _sent(total)
        yield from _sent(total)

    return run


def _sent(total: np.ndarray) -> Iterator[pa.RecordBatch]:
    place = np.flatnonzero(total)
    for a in range(0, len(place), 1 << 18):
        part = place[a : a + (1 << 18)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(total[part].astype(np.int64))],
            ["place", "n"],
        )
    total[place] = 0


def counts(docs: DataFrame, vocab: Vocabulary, text_col: str = "text") -> DataFrame:
    """``context, tokens, ns``: for every (left, right) the tokens between them
    with their numbers. At most (CLASSES + 1)^2 rows of CLASSES entries, however
    large the corpus."""
    return staged(
        docs.select(F.col(f"`{text_col}`").alias("text"))
        .mapInArrow(_contexts(vocab), "place int, n long")
        .groupBy("place")
        .agg(F.sum("n").alias("n"))
        .groupBy(F.expr(f"cast(place div {CLASSES} as int)").alias("context"))
        .agg(F.collect_list(F.struct(F.expr(f"place % {CLASSES}").alias("t"), "n")).alias("c"))
        .select("context", F.col("c.t").alias("tokens"), F.col("c.n").alias("ns")),
        "contexts",
    )


def _gradient(net: Network):
    """One row per task: tokens, log-likelihood and the gradient of all parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slopes = [np.zeros(p.shape) for p in net.parts()]
        seen = gain = 0.0
        for whole in batches:
            for a in range(0, len(whole), 4096):
                batch = whole.slice(a, 4096)
                context = batch.column("context").to_numpy()
                tokens, ns = batch.column("tokens"), batch.column("ns")
                row = np.repeat(np.arange(len(context)), np.diff(tokens.offsets.to_numpy()))
                n = np.zeros((len(context), CLASSES))
                n[row, tokens.flatten().to_numpy()] = ns.flatten().to_numpy()
                left, right = context // (CLASSES + 1), context % (CLASSES + 1)
                hidden = np.tanh(net.left[left] + net.right[right])
                odds = hidden @ net.out + net.bias
                odds -= odds.max(axis=1, keepdims=True)
                log = odds - np.log(np.exp(odds).sum(axis=1, keepdims=True))
                total = n.sum(axis=1, keepdims=True)
                seen += total.sum()
                gain += (n * log).sum()
                err = n - total * np.exp(log)
                back = (err @ net.out.T) * (1 - hidden**2)
                np.add.at(slopes[0], left, back)
                np.add.at(slopes[1], right, back)
                slopes[2] += hidden.T @ err
                slopes[3] += err.sum(axis=0)
        flat = np.concatenate([s.ravel() for s in slopes])
        yield pa.RecordBatch.from_arrays(
            [pa.array([seen]), pa.array([gain]), pa.array([flat.tobytes()], pa.binary())],
            ["seen", "gain", "slope"],
        )

    return run


def train(
    table: DataFrame, rounds: int | None = None, seed: int = 7
) -> tuple[Network, list[float]]:
    """The network after Adam steps over all counts until the likelihood levels off, or
    ``rounds`` times, and the mean log-likelihood of a token before each step that was
    kept. A step that lowers it is taken back and tried at half the rate."""
    rng = np.random.default_rng(seed)
    small = lambda *shape: rng.normal(0, 0.3, shape)
    unigram = np.ones(CLASSES)
    for r in (
        table.select(F.explode(F.arrays_zip("tokens", "ns")).alias("c"))
        .groupBy("c.tokens")
        .agg(F.sum("c.ns").alias("n"))
        .collect()
    ):
        unigram[r["tokens"]] += r["n"]
    net = Network(
        small(CLASSES + 1, WIDTH),
        small(CLASSES + 1, WIDTH),
        small(WIDTH, CLASSES) * 0.1,
        np.log(unigram / unigram.sum()),
    )
    sizes = [p.size for p in net.parts()]
    flat = np.concatenate([p.ravel() for p in net.parts()])
    mean, square = np.zeros((2, len(flat)))
    history: list[float] = []
    kept, push, rate, tried = flat, np.zeros(len(flat)), RATE, 0
    while rounds is None or tried < rounds:
        tried += 1
        seen, gain, slope = 0.0, 0.0, np.zeros(len(flat))
        for r in table.mapInArrow(_gradient(net), "seen double, gain double, slope binary").collect():
            seen, gain = seen + r["seen"], gain + r["gain"]
            slope += np.frombuffer(r["slope"])
        if not seen:
            break
        if history and gain / seen <= history[-1]:
            rate /= 2
            if rate < RATE * LEAST:
                _set(net, kept, sizes)
                break
        else:
            history.append(gain / seen)
            kept = flat
            if rounds is None and len(history) > LOOK and history[-1] - history[-1 - LOOK] < LEVEL:
                break
            mean += 0.1 * (slope / seen - mean)
            square += 0.01 * ((slope / seen) ** 2 - square)
            step = len(history)
            push = (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        flat = kept + rate * push
        _set(net, flat, sizes)
    return net, history


def _set(net: Network, flat: np.ndarray, sizes: list[int]) -> None:
    for part, new in zip(net.parts(), np.split(flat, np.cumsum(sizes)[:-1])):
        part[...] = new.reshape(part.shape)


def _scored(vocab: Vocabulary, net: Network):
    """One row per text with its number of tokens and the score of their classes, and one
    for each of its words without a class of its own, with ``many`` its number in the
    text. The former have a made-up ``word`` that deals them out evenly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log = net.table()
        for batch in batches:
            keys = batch.column("row").to_numpy()
            for first, raw, bounds in words.slices(batch.column("text")):
                hashed, at = words.word_hashes(raw, bounds, lower=True)
                left, right, token = _around(vocab, hashed, at)
                each = log[(left * (CLASSES + 1) + right) * CLASSES + token]
                n = len(bounds) - 1
                owner = np.repeat(np.arange(n), np.diff(at))
                row = keys[first : first + n]
                yield _rows(
                    row,
                    words.mix(row.view(np.uint64)),
                    np.zeros(n, np.int64),
                    batch.column("doc_id").slice(first, n),
                    np.diff(at),
                    np.bincount(owner, each, n),
                )
                rare = token >= CLASSES - BUCKETS
                order = np.lexsort((hashed[rare], owner[rare]))
                owner, hashed = owner[rare][order], hashed[rare][order]
                new = np.ones(len(owner), bool)
                new[1:] = (owner[1:] != owner[:-1]) | (hashed[1:] != hashed[:-1])
                start = np.flatnonzero(new)
                many = np.diff(np.append(start, len(owner)))
                for a in range(0, len(start), 1 << 17):
                    part = start[a : a + (1 << 17)]
                    k = len(part)
                    yield _rows(
                        row[owner[part]],
                        hashed[part],
                        many[a : a + k],
                        pa.nulls(k, pa.int64()),
                        np.zeros(k, np.int64),
                        np.zeros(k),
                    )

    return run


def _rows(row, word, many, doc_id, n_tokens, score) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(row),
            pa.array(word.view(np.int64)),
            pa.array(many),
            doc_id,
            pa.array(n_tokens),
            pa.array(score.astype(np.float64)),
        ],
        ["row", "word", "many", "doc_id", "n_tokens", "score"],
    )


def score(
    docs: DataFrame,
    vocab: Vocabulary,
    net: Network,
    id_col: str = "doc_id",
    text_col: str = "text",
    known: DataFrame | None = None,
) -> DataFrame:
    """``doc_id, n_tokens, log_likelihood, mean_log_likelihood`` for every row.

    ``known`` is the lexicon; without one, only the classes of the words are scored. A
    word outside the lexicon counts as seen once more in its bucket. Null, empty and
    blank texts have 0 tokens, log-likelihood 0 and a null mean. Null ids and rows
    that repeat are kept; other columns are not read.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").alias("text"),
        F.monotonically_increasing_id().alias("row"),
    ).mapInArrow(
        _scored(vocab, net),
        "row long, word long, many long, doc_id long, n_tokens long, score double",
    )
    if known is None:
        rows = rows.where("many = 0").withColumn("log_likelihood", F.col("score"))
    else:
        # One more than was seen: the share of all words that were not.
        logs = F.array(*(F.lit(float(np.log(n + 1))) for n in bucket_sizes(known, vocab)))
        word = F.log(F.coalesce("n", F.lit(1)).cast("double")) - logs[F.expr(_BUCKET)]
        rows = (
            # The same plan at every size.
            rows.join(known.hint("merge"), "word", "left")
            .withColumn("word_score", F.when(F.col("many") > 0, F.col("many") * word).otherwise(0.0))
            .groupBy("row")
            .agg(
                F.max("doc_id").alias("doc_id"),
                F.sum("n_tokens").alias("n_tokens"),
                F.sum(F.col("score") + F.col("word_score")).alias("log_likelihood"),
            )
        )
    return rows.select("doc_id", "n_tokens", "log_likelihood").withColumn(
        "mean_log_likelihood",
        F.expr("case when n_tokens > 0 then log_likelihood / n_tokens end"),
    )


def pseudo_likelihood(
    docs: DataFrame, rounds: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Train on ``docs`` and score them. An empty table gives an empty result."""
    known = lexicon(docs, text_col)
    vocab = vocabulary(docs, text_col, known)
    net, _ = train(counts(docs, vocab, text_col), rounds)
    return score(docs, vocab, net, id_col, text_col, known)
