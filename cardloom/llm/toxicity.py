"""Toxicity by multiple-instance learning: labels are known for documents only,
yet the model scores sentences.

A sentence's probability is a logistic function of hashed features: its words and
their first four, five and six bytes, so that inflected forms share what they
begin with. A document is toxic unless every sentence is clean (noisy-or):
``1 - prod(1 - p)``. The weights are fitted through that formula from document
labels; the sentences that carry the score can then be named. What a sentence
without any weight has in fitting is taken off when documents are scored, so such
sentences add nothing, however many there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cardloom.llm import words
from cardloom.llm.common import staged

FEATURE_BITS = 18
PREFIXES = (4, 5, 6)
# The model is fitted on at most this many labelled documents, those with the
# smallest hash of their id.
MAX_TRAIN = 8_000
ROUNDS = 200
RATE = 0.15
# What a feature must earn: so many documents' worth of slope is taken off its weight.
PENALTY = 0.2
# Only a feature whose documents are toxic more often than all are, by so many
# standard deviations, gets a weight; it is never negative.
MIN_SCORE = 2.5
# The log-odds in fitting of a sentence without any weight; scores are without it. It is
# not fitted: clean documents would pull it down and down, and the weights could not keep up.
START = -10.5
THRESHOLD = 0.3

# Letters, digits and bytes of letters outside ASCII make words.
_BETWEEN = np.ones(256, bool)
_BETWEEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?\n"]] = True


@dataclass
class Model:
    weights: np.ndarray
    bias: float


def _features(raw: np.ndarray, bounds: np.ndarray):
    """``(feature, sentence)`` of every feature found, the document of each
    sentence, and where sentences begin and end. A sentence has a word."""
    starts, ends = words.spans(raw, bounds, _BETWEEN)
    breaks = np.flatnonzero(_ENDS[raw]) + 1
    cuts = np.union1d(breaks, bounds)
    part = np.searchsorted(cuts, starts, "right")
    own, sentence = np.unique(part, return_inverse=True)
    begin = cuts[own - 1] if len(own) else own
    end = cuts[np.minimum(own, len(cuts) - 1)] if len(own) else own
    doc = np.searchsorted(bounds, begin, "right") - 1
    whole, *heads = words.hashes(words.LOWER[raw], starts, ends, PREFIXES)
    found, where = [whole], [sentence]
    for n, head in zip(PREFIXES, heads):
        long = ends - starts > n
        found.append(words.mix(head[long]))  # the head of a word is not the same word
        where.append(sentence[long])
    feature = (np.concatenate(found) >> words.U64(64 - FEATURE_BITS)).astype(np.int32)
    return feature, np.concatenate(where), doc, begin, end


def _sentences(raw: np.ndarray, bounds: np.ndarray, model: Model):
    """Log-odds, document, begin and end of every sentence. Its probability of being
    clean is that of the model over that of a sentence without any weight, so that
    the latter has log-odds of minus infinity."""
    feature, sentence, doc, begin, end = _features(raw, bounds)
    # A feature counts once in a sentence, in fitting and here; few have a weight.
    hit = model.weights[feature] != 0
    pair = np.unique(sentence[hit] << 32 | feature[hit])
    weight = np.bincount(pair >> 32, model.weights[pair & 0xFFFFFFFF], len(doc))
    # (1 + exp(bias + weight)) / (1 + exp(bias)) - 1 are the odds, without overflow.
    odds = np.full(len(doc), -np.inf)
    some = weight > 0
    odds[some] = weight[some] + np.log(-np.expm1(-weight[some]))
    odds += model.bias - np.logaddexp(0, model.bias)
    return odds, doc, begin, end


def _noisy_or(odds: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    return -np.expm1(-np.bincount(doc, np.logaddexp(0, odds), n))


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its features in order of sentence and the sentences' lengths."""
    for batch in batches:
        features, lengths = [], []
        for _, raw, bounds in words.slices(batch.column("text")):
            feature, sentence, doc, _, _ = _features(raw, bounds)
            pair = np.unique(sentence.astype(np.int64) << 32 | feature)
            sentence, feature = pair >> 32, (pair & 0xFFFFFFFF).astype("<i4")
            many = np.bincount(sentence, minlength=len(doc)).astype("<i4")
            cuts = np.searchsorted(doc, np.arange(len(bounds)))
            ends = np.concatenate([[0], np.cumsum(many)])
            for a, b in zip(cuts[:-1], cuts[1:]):
                features.append(feature[ends[a] : ends[b]].tobytes())
                lengths.append(many[a:b].tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("toxic"),
                pa.array(features, pa.binary()),
                pa.array(lengths, pa.binary()),
            ],
            ["toxic", "features", "lengths"],
        )


def _unpacked(batch: pa.RecordBatch):
    """Of the documents of ``_gathered``: label, number of sentences, and for every
    feature its document and its sentence (numbered through the batch)."""
    toxic = batch.column("toxic").to_numpy()
    lengths = [np.frombuffer(x, "<i4") for x in batch.column("lengths").to_pylist()]
    feature = np.concatenate(
        [np.zeros(0, np.int32), *(np.frombuffer(x, "<i4") for x in batch.column("features").to_pylist())]
    )
    per = np.concatenate([np.zeros(0, np.int32), *lengths])
    count = np.array([len(x) for x in lengths], np.int64)
    sentence = np.repeat(np.arange(len(per)), per)
    return toxic, count, feature, np.repeat(np.arange(len(count)), count)[sentence], sentence


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per feature the documents that have it, and the toxic ones among them."""
    seen, bad = np.zeros((2, 1 << FEATURE_BITS), np.int64)
    for whole in batches:
        for a in range(0, len(whole), 500):
            toxic, _, feature, doc, _ = _unpacked(whole.slice(a, 500))
            pair = np.unique(feature.astype(np.int64) << 32 | doc)
            seen += np.bincount(pair >> 32, minlength=len(seen))
            bad += np.bincount((pair >> 32)[toxic[pair & 0xFFFFFFFF] == 1], minlength=len(bad))
    found = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays(
        [pa.array(found), pa.array(seen[found]), pa.array(bad[found])], ["feature", "seen", "bad"]
    )


def _found(known: np.ndarray):
    """Per document its label, its sentences, and the features of ``known`` (sorted) with
    their sentences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, len(whole), 500):
                toxic, count, feature, doc, sentence = _unpacked(whole.slice(a, 500))
                hit = np.isin(feature, known)
                cuts = np.searchsorted(doc[hit], np.arange(len(toxic) + 1)).astype(np.int32)
                lists = lambda x: pa.ListArray.from_arrays(cuts, pa.array(x[hit].astype(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(toxic), pa.array(count), lists(feature), lists(sentence)],
                    ["toxic", "n", "features", "sentences"],
                )

    return run


def fit(
    toxic: np.ndarray,
    n: np.ndarray,
    doc: np.ndarray,
    sentence: np.ndarray,
    feature: np.ndarray,
) -> Model:
    """Weights that make the labels likely: full-batch Adam on the noisy-or
    likelihood with a small penalty on weights. ``toxic`` and the number of
    sentences ``n`` are per document, the others per feature found; a sentence
    without any has the bias alone."""
    weights = np.zeros(1 << FEATURE_BITS)
    if not toxic.any() or not len(feature):
        return Model(weights, -30.0)
    names, feature = np.unique(feature, return_inverse=True)
    pair, sentence = np.unique(doc << 32 | sentence, return_inverse=True)
    owner = pair >> 32
    rest = n - np.bincount(owner, minlength=len(n))
    state = np.zeros((3, len(names)))  # weights and Adam's two means
    clean = rest * np.logaddexp(0, START)
    for step in range(1, ROUNDS + 1):
        odds = START + np.bincount(sentence, state[0][feature], len(owner))
        total = np.bincount(owner, np.logaddexp(0, odds), len(n)) + clean
        # d/dz of -log P: p for a clean document; for a toxic one -p q / (1 - q),
        # where q is the probability that all its sentences are clean.
        pull = np.where(toxic == 1, -1 / np.expm1(np.maximum(total, 1e-12)), 1.0)
        grad = pull[owner] / (1 + np.exp(-np.clip(odds, -40, 40)))
        slope = (np.bincount(feature, grad[sentence], len(names)) + PENALTY) / len(n)
        state[1] = 0.9 * state[1] + 0.1 * slope
        state[2] = 0.99 * state[2] + 0.01 * slope**2
        state[0] -= RATE * (state[1] / (1 - 0.9**step)) / (
            np.sqrt(state[2] / (1 - 0.99**step)) + 1e-6
        )
        state[0] = np.maximum(state[0], 0)
    weights[names] = state[0]
    return Model(weights, START)


def train(
    docs: DataFrame,
    labels: DataFrame,
    max_train: int = MAX_TRAIN,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id: str = "doc_id",
    label_col: str = "toxic",
) -> Model:
    """Fit on the documents of ``labels``, at most ``max_train`` of them.

    Rows with a null id or label are not used; of several labels of one id the
    highest counts. Without a toxic document every score becomes (almost) 0.
    """
    chosen = (
        labels.select(
            F.col(f"`{label_id}`").cast("long").alias("id"),
            F.col(f"`{label_col}`").cast("int").alias("toxic"),
        )
        .dropna()
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(max_train)
    )
    # At most max_train rows of 12 bytes are sent.
    rows = (
        docs.select(
            F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")
        )
        .join(F.broadcast(chosen), "id")
        .select("toxic", "text")
    )
    gathered = staged(
        rows.mapInArrow(_gathered, "toxic int, features binary, lengths binary"), "training"
    )
    size = gathered.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.expr("cast(toxic = 1 as int)")).alias("bad")
    ).first()
    if not size["bad"] or size["bad"] == size["n"]:
        return fit(np.array([size["bad"] or 0]), *np.zeros((4, 0), np.int64))
    share = size["bad"] / size["n"]
    # At most 2^18 numbers, whatever is trained on; then only what these features hit.
    known = (
        gathered.mapInArrow(_occurrences, "feature long, seen long, bad long")
        .groupBy("feature")
        .agg(F.sum("seen").alias("seen"), F.sum("bad").alias("bad"))
        .where(f"(bad - seen * {share}D) / sqrt(seen * {share * (1 - share)}D) >= {MIN_SCORE}D")
        .select("feature")
        .toArrow()["feature"]
        .to_numpy()
    )
    found = gathered.mapInArrow(
        _found(np.sort(known)),
        "toxic int, n long, features array<long>, sentences array<long>",
    ).toArrow()
    features = found["features"].combine_chunks()
    sentences = found["sentences"].combine_chunks()
    many = np.diff(features.offsets.to_numpy()) if len(features) else np.zeros(0, np.int64)
    return fit(
        found["toxic"].to_numpy(),
        found["n"].to_numpy(),
        np.repeat(np.arange(len(many)), many),
        sentences.flatten().to_numpy(),
        features.flatten().to_numpy(),
    )


def score_column(model: Model):
    """A function of a text column: the probability that the text is toxic. Null,
    empty and wordless texts have no sentence and score 0."""
    small = Model(model.weights.astype(np.float32), model.bias)

    @arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            out = [np.zeros(0)]
            for _, raw, bounds in words.slices(batch):
                odds, doc, _, _ = _sentences(raw, bounds, small)
                out.append(_noisy_or(odds, doc, len(bounds) - 1))
            yield pa.array(np.concatenate(out))

    return score


def offending(
    docs: DataFrame,
    model: Model,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, sentence, probability``: the sentences at or above ``threshold``,
    as they stand in the text, with the mark that ends them."""
    small = Model(model.weights.astype(np.float32), model.bias)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts, scores = [], [], []
            for at, raw, bounds in words.slices(batch.column("text")):
                odds, doc, begin, end = _sentences(raw, bounds, small)
                p = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
                for k in np.flatnonzero(p >= threshold):
                    rows.append(at + int(doc[k]))
                    texts.append(raw[begin[k] : end[k]].tobytes().decode().strip())
                    scores.append(float(p[k]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(texts, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "sentence", "probability"],
            )

    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
    ).mapInArrow(run, "doc_id long, sentence string, probability double")


def reject_toxic(
    docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text"
) -> DataFrame:
    """The rows that score below ``threshold``, with all their columns."""
    return docs.where(score_column(model)(F.col(f"`{text_col}`")) < threshold)
