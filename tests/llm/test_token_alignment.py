import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cardloom.llm import token_alignment as ta
from cardloom.llm.queries import alignment_files, op12_token_alignment


def plain(rows):
    """The same with one pass per text over Python lists."""
    byte_level, pieces = alignment_files()
    a_coder = Tokenizer.from_str(byte_level)
    a_coder.encode_special_tokens = True
    a_names = {i: t for t, i in a_coder.get_vocab().items()}
    alphabet = ta.byte_alphabet()
    b_coder = sentencepiece.SentencePieceProcessor(model_proto=pieces)

    def b_bytes(i):
        t = b_coder.id_to_piece(i)
        return bytes([int(t[3:5], 16)]) if b_coder.is_byte(i) else t.replace("▁", " ").encode()

    found, total = [], Counter()
    for doc_id, text in rows:
        a = a_coder.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_coder.encode(text) if text else []
        in_a = [bytes(alphabet[c] for c in a_names[i]) for i in a]
        in_b = [b_bytes(i) for i in b]
        want = (" " + text).encode() if text else b""
        if b"".join(in_a) != want or b"".join(in_b) != want:
            a = b = []
        ends = [{}, {}]
        for side, parts in zip(ends, (in_a[: len(a)], in_b[: len(b)])):
            at = 0
            for k, p in enumerate(parts):
                at += len(p)
                side[at] = k
        cuts = sorted(set(ends[0]) & set(ends[1]))
        links = [(a[ends[0][c]], b[ends[1][c]]) for c in cuts]
        groups, i, j = [], 0, 0
        for c in cuts:
            p, q = ends[0][c] + 1, ends[1][c] + 1
            groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
            i, j = p, q
        total.update(links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        found.append((doc_id, len(a), len(b), links, digest))
    highest = {}
    for (_, b), n in total.items():
        highest[b] = max(n, highest.get(b, 0))
    return [
        (i, na, nb, len(links), len(links), digest, sum(total[x] == highest[x[1]] for x in links),
         sum(total[x] for x in links))
        for i, na, nb, links, digest in found
    ]


def same(got, rows):
    assert sorted(map(tuple, got), key=str) == sorted(plain(rows), key=str)


def test_query_against_a_plain_version(spark, sample):
    docs = spark.read.parquet(f"{sample}/documents.parquet").select("doc_id", "text")
    same(op12_token_alignment(spark, sample).collect(), [tuple(r) for r in docs.collect()])


def test_odd_documents(spark, odd_documents, monkeypatch):
    files = alignment_files()
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    same(ta.token_alignment(odd_documents, *files).collect(), rows)
    odd = ["<|endoftext|> <s> </s>", "▁mark", "a  b   c ", "\r\n\t", "<0x41> \x00", "x" * 3000, "é ﬁ"]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(odd)], "doc_id long, text string")
    same(ta.token_alignment(frame, *files).collect(), list(enumerate(odd)))
    assert ta.token_alignment(odd_documents.limit(0), *files).collect() == []
    none = ta.token_alignment(frame.where("doc_id = 1"), *files).collect()
    assert [tuple(r) for r in none] == [(1, 0, 0, 0, 0, "", 0, 0)]


def test_texts_are_cut_where_nothing_changes():
    """Chunks one by one, remembered or not, give the ids of the whole text."""
    coders = ta._Coders(*alignment_files())
    rng = random.Random(2)
    parts = ["a", "b", "th", "9", "0", " ", " ", "  ", ".", ",", "\n", "'s", "'", "é", "ß", "漢", "\u00a0", "\t", "-"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 300))) for _ in range(500)]
    assert coders.cuts
    for _ in range(2):
        a, n_a, b, n_b = coders.encode(texts)
        for k, text in enumerate(texts):
            want_a = coders.a.encode(" " + text, add_special_tokens=False).ids if text else []
            want_b = coders.b.encode(text)
            got_a, got_b = a[n_a[:k].sum():n_a[:k + 1].sum()], b[n_b[:k].sum():n_b[:k + 1].sum()]
            if text and len(got_a):
                assert got_a.tolist() == want_a and got_b.tolist() == want_b
            elif text:
                in_b = b"".join(
                    bytes([int(t[3:5], 16)]) if coders.b.is_byte(i) else t.replace("▁", " ").encode()
                    for i, t in ((i, coders.b.id_to_piece(i)) for i in want_b)
                )
                assert in_b != (" " + text).encode()
        coders.forget()


@pytest.mark.parametrize("lane", [1, 3, 64, 1 << 20])
def test_lockstep(monkeypatch, lane):
    monkeypatch.setattr(ta, "LANE", lane)
    rng = np.random.default_rng(lane)
    bounds = np.concatenate([[0], np.cumsum(rng.integers(0, 60, 40))])
    ends = [np.union1d(rng.integers(1, bounds[-1] + 1, 500), bounds[1:][np.diff(bounds) > 0]) for _ in "ab"]
    a, b = ta.lockstep(*ends, bounds)
    assert (ends[0][a] == ends[1][b]).all()
    assert (ends[0][a] == np.intersect1d(*ends)).all()


def test_blocks_do_not_change_the_counts(spark, sample, monkeypatch):
    docs = spark.read.parquet(f"{sample}/documents.parquet")
    want = sorted(map(tuple, ta.token_alignment(docs, *alignment_files()).collect()))
    monkeypatch.setattr(ta, "BLOCK", 1)
    monkeypatch.setattr(ta, "SLICE", 1 << 12)
    monkeypatch.setattr(ta, "CHUNK", 7)
    one = ta._first(*alignment_files())

    class Context:
        partitionId = staticmethod(lambda: 3)  # noqa: N815

    monkeypatch.setattr(ta.TaskContext, "get", staticmethod(lambda: Context))
    batch = docs.select("doc_id", "text").limit(30).toArrow().to_batches()
    out = [r for b in one(iter(batch)) for r in b.to_pylist()]
    assert len({r["block"] for r in out}) > 3 and any((r["first"] or 0) > 0 for r in out)
    by_id = {w[0]: w for w in want}
    for r in out:
        if r["first"] is None:
            assert (r["n_a"], r["n_b"], r["n_links"], r["groups_sha256"]) == (
                *by_id[r["doc_id"]][1:3], by_id[r["doc_id"]][4], by_id[r["doc_id"]][5])
