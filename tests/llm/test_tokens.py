import random
import re
import zlib

import numpy as np
from tokenizers import Tokenizer

from cardloom.llm import packing, wordpiece
from cardloom.llm.queries import op9_packing, tokenizer, vocabulary


def greedy(word, vocab):
    n = 0
    while word:
        k = next((k for k in range(len(word), 0, -1) if word[:k] in vocab), 0)
        if not k:
            return 1
        word, n = word[k:], n + 1
    return n


def expected(texts, vocab, lead):
    out = []
    for t in texts:
        words = re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode())
        each = [greedy(lead + w, vocab) for w in words]
        out.append((len(words), sum(each), max(each, default=0)))
    return out


def test_greedy_lengths_of_random_vocabularies(spark):
    rng = random.Random(3)
    for lead in (b"", b"_"):
        words = ["".join(rng.choices("abc", k=rng.randint(1, 5))) for _ in range(25)]
        vocab = [w.encode() for w in words] + [b"_", b"_a", b"", b"a"]
        texts = [
            " ".join("".join(rng.choices("abcd", k=rng.randint(1, 12))) for _ in range(20))
            for _ in range(40)
        ]
        frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        got = wordpiece.token_counts(frame, vocab, lead).orderBy("doc_id").collect()
        assert [tuple(r)[1:] for r in got] == expected(texts, set(vocab), lead)


def test_token_counts_of_odd_documents(spark, odd_documents):
    vocab = vocabulary()
    rows = odd_documents.collect()
    want = expected([r.text for r in rows], set(vocab), b" ")
    got = wordpiece.token_counts(odd_documents, vocab).collect()
    key = lambda x: str(x)
    assert sorted(map(tuple, got), key=key) == sorted(
        [(r.doc_id, *w) for r, w in zip(rows, want)], key=key
    )
    assert wordpiece.token_counts(odd_documents.limit(0), vocab).collect() == []
    none = wordpiece.token_counts(odd_documents, []).where("n_words <> n_tokens")
    assert none.collect() == []


def whole(pieces, texts, n_rows):
    """Check the pieces and return the ids of every document in turn."""
    coder = Tokenizer.from_str(tokenizer())
    assert pieces.length.gt(0).all()
    size = pieces.groupby("sequence_id").length.sum()
    assert ((size & (size - 1)) == 0).all() and (size <= 2048).all()
    by_seq = pieces.sort_values(["sequence_id", "offset"])
    assert (by_seq.offset == by_seq.groupby("sequence_id").length.cumsum() - by_seq.length).all()
    return {k: coder.encode(t or "", add_special_tokens=False).ids + [1] for k, t in texts.items()}


def test_packing_is_a_round_trip(spark, sample):
    docs = spark.read.parquet(f"{sample}/documents.parquet")
    pieces = packing.pack(docs, tokenizer()).toPandas()
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = whole(pieces, texts, len(texts))
    for name, part in pieces.sort_values("start").groupby("doc_id"):
        got = np.concatenate([np.frombuffer(x, "<u4") for x in part.ids])
        assert got.tolist() == want[name]
        assert (part.doc_tokens == len(got)).all()
        assert (part.start == part.length.cumsum() - part.length).all()
    assert set(pieces.doc_id) == set(texts)
    crc = op9_packing(spark, sample).toPandas()
    one = crc[crc.start == 0].iloc[0]
    ids = np.array(want[one.doc_id][: one.length], "<u4").tobytes()
    assert one.ids_crc32 == zlib.crc32(ids)


def test_packing_of_odd_documents(spark, odd_documents):
    rows = odd_documents.collect()
    pieces = packing.pack(odd_documents, tokenizer()).toPandas()
    want = whole(pieces, dict(enumerate(r.text for r in rows)), len(rows))
    assert pieces.length.sum() == sum(map(len, want.values()))
    for name in {r.doc_id for r in rows if r.doc_id is not None and r.doc_id != 7}:
        part = pieces[pieces.doc_id == name].sort_values("start")
        got = np.concatenate([np.frombuffer(x, "<u4") for x in part.ids])
        assert got.tolist() == want[[r.doc_id for r in rows].index(name)]
    assert packing.pack(odd_documents.limit(0), tokenizer()).collect() == []


def test_special_tokens_in_texts_are_the_tokenizers(spark):
    """As the tokenizer gives them without a switch, in any case and place."""
    texts = [
        "a <|endoftext|> b", "x<|startoftext|>y. <|ENDOFTEXT|> z", "<|endoftext|>", "<|endoftext|><|endoftext|>.",
        "<|EndOfText|>,<|endoftext|>", "É<|endoftext|>É ok", "<|endoftext", "a <|endoftext|>, b", "plain words, here.",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pieces = packing.pack(frame, tokenizer()).toPandas()
    want = whole(pieces, dict(enumerate(texts)), len(texts))
    assert want[0] == [320, 49407, 321, 1]
    for name, part in pieces.sort_values("start").groupby("doc_id"):
        got = np.concatenate([np.frombuffer(x, "<u4") for x in part.ids])
        assert got.tolist() == want[name], texts[name]


def test_seed_gets_its_nearest_document():
    docs = [np.array(x) for x in ([5, 6, 7, 8], [90, 91, 92], [6, 7, 40], [50, 51], [60, 61], [62])]
    shard = packing._Shard(docs, end_id=1)
    assert shard.neighbours(0).tolist()[:2] == [0, 2]


def test_few_documents_are_cut(spark):
    """Nothing is padded, and a sequence is full unless its task ends."""
    docs = [(i, "word " * (i % 700)) for i in range(300)]
    pieces = packing.pack(
        spark.createDataFrame(docs, "doc_id long, text string"), tokenizer()
    ).toPandas()
    size = pieces.groupby("sequence_id").length.sum()
    assert (size != 2048).sum() <= 11
