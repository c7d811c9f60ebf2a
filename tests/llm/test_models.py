import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest

from cardloom.llm import lm_score, toxicity, words
from cardloom.llm.queries import op7_pseudo_likelihood, op10_toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))


def test_toxicity_on_held_out_labels(spark):
    got = op10_toxicity(spark, SF).toPandas()
    assert got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    got = got.merge(spark.read.parquet(f"{SF}/labels.parquet").toPandas(), on="doc_id")
    test = got[got.held_out]
    right = (test.predicted == test.toxic).mean()
    assert right > 0.93 and test[test.toxic == 1].predicted.mean() > 0.5


def test_offending_sentences_explain_the_score(spark, model):
    docs = spark.createDataFrame(
        [(1, "All is well here. You are an idiot and a clown. Good day"), (2, "Nothing. Here"), (3, None)],
        "doc_id long, text string",
    )
    found = toxicity.offending(docs, model).collect()
    assert [(r.doc_id, r.sentence) for r in found] == [(1, "You are an idiot and a clown.")]
    kept = toxicity.reject_toxic(docs, model)
    assert [r.doc_id for r in kept.collect()] == [2, 3]


def test_noisy_or_of_sentences(model):
    texts = ["fine words. an idiot is here. so", "An IDIOT idiot idiot", "", "..", "idiot" * 9]
    raw, bounds = words.buffer(pa.array(texts))
    odds, doc, begin, end = toxicity._sentences(raw, bounds, model)
    got = toxicity._noisy_or(odds, doc, len(texts))
    for k in range(len(texts)):
        p = 1 / (1 + np.exp(-odds[doc == k]))
        assert got[k] == pytest.approx(1 - np.prod(1 - p))
    assert got[2] == got[3] == 0
    assert raw[begin[1] : end[1]].tobytes().strip() == b"an idiot is here."


def test_toxicity_of_odd_tables(spark, odd_documents):
    labels = spark.createDataFrame(
        [(1, None), (None, 1), (2, 0), (2, 0), (1, 0)], "doc_id long, toxic int"
    )
    for used in (labels, labels.limit(0)):
        model = toxicity.train(odd_documents, used)
        out = toxicity.reject_toxic(odd_documents, model)
        assert out.columns == odd_documents.columns and out.count() == odd_documents.count()
    assert toxicity.reject_toxic(odd_documents.limit(0), model).count() == 0
    assert toxicity.offending(odd_documents.limit(0), model).count() == 0


def test_gradient_is_that_of_the_likelihood(spark):
    rng = np.random.default_rng(1)
    classes, width = lm_score.CLASSES, lm_score.WIDTH
    net = lm_score.Network(
        rng.normal(size=(classes + 1, width)),
        rng.normal(size=(classes + 1, width)),
        rng.normal(size=(width, classes)) * 0.1,
        rng.normal(size=classes) * 0.1,
    )
    batch = pa.RecordBatch.from_pydict(
        {
            "context": pa.array([5, 300, 70_000 % 257**2], pa.int32()),
            "tokens": [[1, 2], [9], [200, 3, 4]],
            "ns": [[4, 1], [2], [1, 1, 7]],
        }
    )
    def gain():
        out = next(lm_score._gradient(net)(iter([batch])))
        return out["gain"][0].as_py(), np.frombuffer(out["slope"][0].as_py())

    base, slope = gain()
    at = 0
    for part in net.parts():
        flat = part.reshape(-1)
        for k in rng.choice(len(flat), 40, replace=False):
            flat[k] += 1e-6
            assert (gain()[0] - base) / 1e-6 == pytest.approx(slope[at + k], abs=2e-3)
            flat[k] -= 1e-6
        at += len(flat)
    table = net.table().reshape(-1, classes)
    assert np.exp(table).sum(axis=1) == pytest.approx(1, abs=1e-4)


def test_pseudo_likelihood(spark, sample):
    docs = spark.read.parquet(f"{sample}/documents.parquet")
    vocab = lm_score.vocabulary(docs)
    counted = lm_score.counts(docs, vocab)
    n_words = sum(len([w for w in r.text.split() if w]) for r in docs.collect())
    total = counted.selectExpr("aggregate(ns, 0L, (a, x) -> a + x) as n").groupBy().sum("n")
    assert total.first()[0] == n_words
    net, history = lm_score.train(counted)
    assert all(b > a for a, b in itertools.pairwise(history))
    got = {r.doc_id: r for r in lm_score.score(docs, vocab, net).collect()}
    log = net.table().reshape(lm_score.CLASSES + 1, lm_score.CLASSES + 1, lm_score.CLASSES)
    for r in docs.limit(5).collect():
        raw, bounds = words.buffer(pa.array([r.text]))
        token = vocab.classes(words.word_hashes(raw, bounds, lower=True)[0])
        around = [lm_score.EDGE, *token, lm_score.EDGE]
        want = sum(log[around[i], around[i + 2], t] for i, t in enumerate(token))
        assert got[r.doc_id].log_likelihood == pytest.approx(want, rel=1e-4)
    mean = np.mean([r.log_likelihood / r.n_tokens for r in got.values()])
    noise = docs.selectExpr("doc_id", "concat_ws(' ', shuffle(split(lower(reverse(text)), ' '))) as text")
    other = lm_score.score(noise, vocab, net).selectExpr("avg(mean_log_likelihood)").first()[0]
    assert other < mean


def test_pseudo_likelihood_of_odd_documents(spark, odd_documents):
    got = lm_score.pseudo_likelihood(odd_documents, rounds=2).collect()
    assert len(got) == odd_documents.count()
    for r in got:
        assert (r.n_tokens == 0) == (r.mean_log_likelihood is None)
    assert lm_score.pseudo_likelihood(odd_documents.limit(0), rounds=2).collect() == []


def test_pseudo_likelihood_query(spark, sample):
    assert op7_pseudo_likelihood(spark, sample).count() == 200


def test_a_word_counts_as_itself_not_as_its_bucket(spark, sample):
    docs = spark.read.parquet(f"{sample}/documents.parquet").select("doc_id", "text")
    known = lm_score.lexicon(docs)
    vocab = lm_score.vocabulary(docs, known=known)
    counted = lm_score.counts(docs, vocab)
    net, history = lm_score.train(counted)
    assert len(history) > 12
    assert history[-1] - history[-1 - lm_score.LOOK] < lm_score.LEVEL
    # Two words of one bucket and one nobody has seen, in the same place of the same text.
    rows = [r for r in known.collect() if r.word not in set(vocab.hashes.view(np.int64).tolist())]
    size, seen = {}, {}
    for r in rows:
        b = (r.word % 2**64 >> 20) % lm_score.BUCKETS
        size[b] = size.get(b, 0) + r.n
        seen[r.word] = r.n
    of = lambda w: words.word_hashes(*words.buffer(pa.array([w])), lower=True)[0].view(np.int64)[0]
    texts = sorted({w for r in docs.collect() for w in r.text.lower().split() if w.isascii()})
    texts = [w for w in texts if of(w) in seen][:400] + [f"zzqx{i}" for i in range(200)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = {r.doc_id: r for r in lm_score.score(frame, vocab, net, known=known).collect()}
    plain = {r.doc_id: r for r in lm_score.score(frame, vocab, net).collect()}
    assert len(whole) == len(texts)
    for i, w in enumerate(texts):
        b = (int(of(w)) % 2**64 >> 20) % lm_score.BUCKETS
        want = np.log(seen.get(of(w), 1) / (size[b] + 1))
        assert whole[i].log_likelihood - plain[i].log_likelihood == pytest.approx(want)
    assert len({round(r.log_likelihood, 9) for r in whole.values()}) > lm_score.BUCKETS


def test_length_alone_is_not_toxic(spark, model):
    texts = ["so.\n" * 50_000, "so. " * 50_000 + "You are an idiot and a clown.", "You are an idiot and a clown."]
    raw, bounds = words.buffer(pa.array(texts))
    odds, doc, _, _ = toxicity._sentences(raw, bounds, model)
    got = toxicity._noisy_or(odds, doc, len(texts))
    assert len(doc) > 100_000
    assert got[0] == 0
    assert got[1] == pytest.approx(got[2]) and got[2] > toxicity.THRESHOLD
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.doc_id for r in toxicity.reject_toxic(frame, model).collect()] == [0]
