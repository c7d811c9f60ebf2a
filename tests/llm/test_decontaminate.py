import random
import tracemalloc

import numpy as np
import pytest

from cardloom.llm import decontaminate as d


def fold(text):
    out = []
    for c in text:
        low = c.lower() if len(c.lower()) == 1 else c
        low = " " if low.isspace() else low
        if low != " " or not out or out[-1] != " ":
            out.append(low)
    return "".join(out)


def edits_of_best_part(pattern, text):
    """Fewest edits of ``pattern`` against any part of ``text``, by the full table."""
    row = np.zeros(len(text) + 1, int)
    for i, c in enumerate(pattern, 1):
        new = np.empty_like(row)
        new[0] = i
        for j in range(1, len(text) + 1):
            new[j] = min(row[j - 1] + (text[j - 1] != c), row[j] + 1, new[j - 1] + 1)
        row = new
    return int(row.min())


def repeats(gram):
    return any(gram[k:] == gram[:-k] for k in range(1, d.PERIODS + 1))


def brute(docs, items):
    out = set()
    for item, text in items:
        folded = fold(text.strip())
        if len(folded) < d.MIN_CHARS:
            continue
        m = min(d.WINDOW, len(folded))
        starts = {*range(0, len(folded) - m + 1, d.STEP), len(folded) - m}
        for k, (name, whole) in enumerate(docs):
            for s in starts:
                most = int(d.RATE * m + 1e-9) if m >= d.EXACT else 0
                grams = [folded[k : k + d.Q] for k in range(s, s + m - d.Q + 1)]
                told = sum(not repeats(g) for g in grams)
                if told < d.MIN_SHARE * len(grams) or told <= d.Q * most:
                    continue
                e = edits_of_best_part(folded[s : s + m], fold(whole or ""))
                if e <= most:
                    out.add((name, item, s, e))
    return out


def edited(rng, text, n):
    text = list(text)
    for _ in range(n):
        k = rng.randrange(len(text))
        text[k : k + rng.randint(0, 1)] = rng.choices("abcdefgh ", k=rng.randint(0, 1))
    return "".join(text)


@pytest.fixture(scope="module")
def case():
    rng = random.Random(5)
    syllables = ["the", "ing", "tion", "ou", "ea", "nd ", "st", " ", "er", "É", "漢"]
    say = lambda n: "".join(rng.choices(syllables, k=n))
    items = [(i, say(n)) for i, n in enumerate([40, 30, 70, 12, 3, 25])] + [(9, "  short  ")]
    items += [(20, "What is two plus two?"), (21, say(10) + "-" * 30 + say(20)), (22, "=" * 80)]
    docs = [(0, None), (1, ""), (2, say(60))]
    for k in range(14):
        item = items[k % 4][1]
        part = item if k % 3 else item[: max(30, len(item) * 2 // 3)]
        docs.append((10 + k, say(25) + edited(rng, part, k) + say(15)))
    docs.append((50, items[0][1].upper().replace(" ", "\n \t")))
    docs.append((60, say(5) + "what is  two plus TWO? " + say(5)))
    docs.append((61, say(5) + "what is two plus tw0? " + say(5)))
    docs.append((62, say(9) + items[8][1] + "=" * 100 + say(9)))
    docs.append((51, items[1][1][:40]))
    docs.append((52, items[1][1][40:]))
    return docs, items


def test_same_as_aligning_everything(spark, case):
    docs, items = case
    found = d.leaks(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    ).collect()
    got = {(r.doc_id, r.item_id, r.item_start, r.edits) for r in found}
    assert got == brute(docs, items)
    assert any(r.edits for r in found) and len(found) == len(got)
    texts, named = dict(docs), dict(items)
    for r in found:
        folded = fold(named[r.item_id].strip())
        m = min(d.WINDOW, len(folded))
        part = fold(texts[r.doc_id][r.doc_start : r.doc_end])
        assert edits_of_best_part(folded[r.item_start : r.item_start + m], part) == r.edits


def test_filter_keeps_clean_rows_as_they_are(spark, case, odd_documents):
    docs, items = case
    bench = spark.createDataFrame(items, "item_id long, text string")
    kept = d.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), bench)
    bad = {x[0] for x in brute(docs, items)}
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - bad
    odd = d.decontaminate(odd_documents, bench)
    assert odd.columns == odd_documents.columns and odd.count() == odd_documents.count()


def test_blocks_of_a_large_benchmark(spark, case, monkeypatch):
    docs, items = case
    monkeypatch.setattr(d, "BLOCK_CHARS", 150)
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.item_id, r.item_start, r.edits) for r in d.leaks(frame, bench).collect()}
    assert got == brute(docs, items)


def test_items_with_a_divider_line_stay_small():
    """Two thousand items and a text share a line of dashes: one task stays below 1 GB,
    and what is found is what each item alone gives."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrst", k=rng.randint(2, 8)))
    say = lambda n: " ".join(word() for _ in range(n))
    items = [(i, f"{say(12)}\n{'-' * 80}\n{say(12)}") for i in range(2000)]
    texts = [f"{say(40)}\n{'-' * 80}\n{say(40)}" for _ in range(20)]
    texts += [say(20) + items[7][1] + say(20), say(20) + items[1500][1].replace("-", "=") + say(20)]
    searcher = d.Searcher(d.build_index(items))
    tracemalloc.start()
    found = list(searcher.search(texts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1 << 30
    assert {(t, int(searcher.index.items(np.array([w]))[0])) for t, w, *_ in found} == {(20, 7), (21, 1500)}
    alone = d.Searcher(d.build_index([items[7]]))
    first = searcher.index.first[7]
    assert sorted(alone.search(texts)) == sorted((t, w - first, *x) for t, w, *x in found if t == 20)


def test_empty_tables(spark, case):
    docs = spark.createDataFrame(case[0], "doc_id long, text string")
    bench = spark.createDataFrame(case[1], "item_id long, text string")
    assert d.leaks(docs.limit(0), bench).collect() == []
    assert d.leaks(docs, bench.limit(0)).collect() == []
    assert d.decontaminate(docs, bench.limit(0)).count() == len(case[0])
    nulls = spark.createDataFrame([(1, None)], "item_id long, text string")
    assert d.leaks(docs, nulls).collect() == []


def test_every_passage_of_a_window_is_found_wherever_it_begins(spark, monkeypatch):
    rng = random.Random(3)
    item = "".join(rng.choices("abcdefghijklmnop ", k=200)).replace("  ", " x").strip()
    part = lambda k: "QZ" * 40 + item[k : k + d.WINDOW] + "ZQ" * 40
    places = [k for k in range(len(item) - d.WINDOW + 1) if " " not in (item[k], item[k + d.WINDOW - 1])]
    docs = [(k, part(k)) for k in places] + [(1000, " ".join([item] * 3)), (1001, "QZ" * 90)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = {(r.doc_id, r.item_start): r.edits for r in d.leaks(frame, bench).collect()}
    assert all(found[k, k] == 0 for k in places)
    assert sum(k[0] == 1000 for k in found) == len(item) - d.WINDOW + 1
    assert [r.doc_id for r in d.decontaminate(frame, bench).collect()] == [1001]
    # Small parts give what one large part does.
    searcher = d.Searcher(d.build_index([(1, item)]))
    texts = [t for _, t in docs]
    whole = list(searcher.search(texts))
    monkeypatch.setattr(d, "PAIRS", 100)
    monkeypatch.setattr(d, "ALIGNED", 7)
    assert list(searcher.search(texts)) == whole
