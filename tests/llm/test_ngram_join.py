import random
import re

import pytest

from cardloom.llm.components import components
from cardloom.llm.ngram_join import ngram_join, one_of_each


def shingles(text, n):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x20\x09-\x0d]+", low)
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(docs, n, percent):
    """Components by comparing all pairs."""
    sets = [shingles(t, n) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (name, _) in enumerate(docs):
        group = [docs[j][0] for j in range(len(docs)) if find(j) == find(i)]
        out.append((name, len(sets[i]), min((g for g in group if g is not None), default=None)))
    return sorted(out, key=str)


def corpus(seed):
    """Random texts, near copies at all distances, and chains of copies of copies."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = [rng.choices(vocabulary, k=rng.randint(0, 60)) for _ in range(25)]
    for _ in range(60):
        text = list(rng.choice(texts))
        for _ in range(rng.randint(0, 3)):
            if text:
                k = rng.randrange(len(text))
                text[k : k + rng.randint(0, 1)] = rng.choices(vocabulary, k=rng.randint(0, 2))
        texts.append(text)
    passage = rng.choices(vocabulary, k=30)
    texts += [passage + rng.choices(vocabulary, k=k) for k in range(0, 20, 2)]
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed,n,percent", [(1, 4, 85), (2, 5, 80), (3, 2, 60), (4, 1, 95)])
def test_equals_all_pairs(spark, seed, n, percent):
    docs = corpus(seed)
    got = ngram_join(spark.createDataFrame(docs, "doc_id long, text string"), n, percent)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, n, percent)


def test_group_of_near_copies_with_no_common_centre(spark):
    base = [f"b{i}" for i in range(120)]
    docs = []
    for i in range(150):
        text = list(base)
        for k in range(i % 5):
            text[(i * 7 + k * 13) % 120] = f"x{i}_{k}"
        docs.append((1000 - i, " ".join(text)))
    got = ngram_join(spark.createDataFrame(docs, "doc_id long, text string"), 4, 85)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, 4, 85)


def test_odd_documents(spark, odd_documents):
    docs = [(r.doc_id, r.text) for r in odd_documents.collect()]
    got = ngram_join(odd_documents, 4, 85)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, 4, 85)


def test_one_of_each(spark, odd_documents):
    kept = one_of_each(odd_documents, 4, 85)
    assert kept.columns == odd_documents.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids == sorted([1, 2, 3, 4, 5, 7, 9, None, None], key=str)


def test_one_of_each_by_row_not_by_id(spark):
    """Ids that repeat or lack, and near copies among them: of every component of all
    pairs exactly one row stays, and every row without a word."""
    rng = random.Random(11)
    docs = []
    for _, text in corpus(6):
        docs += [(rng.choice([None, *range(12)]), text)] * rng.choice([1, 1, 2])
    docs += [(3, ""), (3, ""), (None, None), (None, " ")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    kept = [tuple(r) for r in one_of_each(frame, 4, 85).collect()]
    blank = [d for d in docs if not (d[1] or "").strip()]
    assert sorted((d for d in kept if not (d[1] or "").strip()), key=str) == sorted(blank, key=str)
    texts = [t for _, t in docs if (t or "").strip()]
    group = dict(zip(texts, (c for _, _, c in numbered(texts))))
    got = [group[t] for _, t in kept if (t or "").strip()]
    assert sorted(got) == sorted(set(group.values()))


def numbered(texts):
    """Components of texts by all pairs, with a number of their own."""
    found = dict((i, (i, n, c)) for i, n, c in brute(list(enumerate(texts)), 4, 85))
    return [found[i] for i in range(len(texts))]


def test_empty_table(spark, odd_documents):
    assert ngram_join(odd_documents.limit(0)).collect() == []
    assert one_of_each(odd_documents.limit(0)).collect() == []


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 150)}
