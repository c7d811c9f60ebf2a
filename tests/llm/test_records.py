import base64
import gzip
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cardloom.llm import chat, quality, url_filter, warc
from cardloom.llm.queries import RULES

PAGES = [
    (1, "http://a/", "same"),
    (5, None, "same"),
    (3, "http://b/", "ends early\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"),
    (4, "http://c/", None),
    (None, "http://d/", ""),
    (None, "http://e/", "null id"),
    (7, "u", "é\n"),
    (7, "u", "é\n"),
    (7, "v", "é\n"),
    (8, "\r\nX-Evil: y", "é\n"),
    (9, "http://f/", "x" * 3_000_000),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn(
        "copy", F.lit("mine")
    )


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


@pytest.mark.parametrize("min_bytes", [0, 1, 3])
def test_archives_come_back_whole(spark, pages, tmp_path, min_bytes):
    got = warc.rewrite(pages, str(tmp_path / "w"), min_bytes).collect()
    want = []
    groups = {}
    for page, _, html in PAGES:
        groups.setdefault(html or "", []).append(page)
    for html, ids in groups.items():
        size = len(html.encode())
        top = max(ids, key=lambda x: (x is not None, x or 0))
        rest = list(ids)
        if size >= min_bytes:
            rest.remove(top)
            want.append((top, size, digest(html), "response", None))
            want += [(p, size, digest(html), "revisit", top) for p in rest]
        else:
            want += [(p, size, digest(html), "response", None) for p in rest]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_files_are_archives(spark, pages, tmp_path):
    warc.rewrite(pages, str(tmp_path / "w")).collect()
    files = list(Path(tmp_path / "w").glob("*.gz"))
    records = [r for f in files for r in warc.parse(f.read_bytes())]
    assert len(records) == len(PAGES)
    assert len({f["WARC-Record-ID"] for f, _, _ in records}) == len(PAGES)
    whole = {f["WARC-Record-ID"] for f, _, _ in records if f["WARC-Type"] == "response"}
    for fields, http, payload in records:
        assert "X-Evil" not in fields and http.startswith(b"HTTP/1.1 200 OK")
        if fields["WARC-Type"] == "revisit":
            assert fields["WARC-Refers-To"] in whole and not payload
        else:
            assert fields["WARC-Payload-Digest"] == "sha1:" + digest(payload.decode())
    for f in files:
        assert gzip.decompress(f.read_bytes()).endswith(b"\r\n\r\n")
    back = warc.read_archives(spark, str(tmp_path / "w"), payloads=True)
    sizes = back.where("record_type = 'response'").selectExpr("max(length(payload))").first()
    assert sizes[0] == 3_000_000


def test_no_pages(spark, pages, tmp_path):
    assert warc.rewrite(pages.limit(0), str(tmp_path / "w")).collect() == []


def test_urls_are_split(spark):
    cases = {
        "http://A.Net": ("a.net", ""),
        "http://a.net/x?y#z": ("a.net", "/x"),
        "http://a.net?x=http://b.org/c": ("a.net", ""),
        "x#://h/p": ("h", "/p"),
        "a\nb://h\n/p\nq#r": ("h\n", "/p\nq"),
        "no scheme/path": ("", ""),
        "://": ("", ""),
        "": ("", ""),
        None: ("", ""),
    }
    rows = spark.createDataFrame([(u,) for u in cases], "url string")
    got = rows.select("url", url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url")))
    assert {r[0]: (r[1], r[2]) for r in got.collect()} == cases


def test_rules_then_reputation(spark):
    urls = [
        (1, "http://x.net/en/"),
        (2, "http://example.net/en/1"),
        (3, "http://a.example.com/de/"),
        (4, "http://badexample.com/de/"),
        (5, "http://good.org/fr/1"),
        (6, "http://bad.org/"),
        (7, "http://new.bad.org/"),
        (8, "http://x.net"),
        (None, None),
        (6, "http://bad.org/"),
    ]
    pages = spark.createDataFrame(urls, "page_id long, url string").withColumn("host", F.lit(1))
    seen = [("bad.org", 1)] * 50 + [("good.org", 0)] * 60 + [("other.com", 0)] * 90
    seen += [("fine.com", 0)] * 90 + [("bad.org", None), (None, 1)]
    labelled = spark.createDataFrame(seen, "host string, bad int")
    got = url_filter.judge(pages, labelled, RULES).collect()
    assert len(got) == len(urls)
    verdicts = {r.page_id: (r.rule, r.verdict) for r in got}
    assert verdicts[1] == ("net/", "block") and verdicts[2] == ("example.net/en/", "allow")
    assert verdicts[3] == ("example.com/de/", "block") and verdicts[4] == (None, "allow")
    assert verdicts[5] == ("org/fr/", "allow") and verdicts[6] == (None, "block")
    assert verdicts[8] == (None, "allow") and verdicts[None] == (None, "allow")
    lower = {r.page_id: r.lower for r in got}
    assert lower[6] > lower[7] > lower[4]  # a new host leans on its domain
    empty = url_filter.judge(pages, labelled.limit(0))
    assert {r.verdict for r in empty.collect()} == {"allow"}
    assert url_filter.judge(pages.limit(0), labelled, RULES).collect() == []


def test_perspectives(spark):
    rows = [
        (1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "hey"), (1, 3, "ann", None),
        (1, 600, "cy", "late"), (2, 0, None, "<|im_end|>x"), (3, 0, "system", "alone"),
        (None, 0, "ann", "lost"), (4, None, "ann", "lost"), (5, 0, "a", "t"), (5, 0, "a", "t"),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = turns.withColumn("part", F.lit("x")).withColumn("speaker", F.lit(0))
    got = {(r.conv_id, r.speaker, r.part): r for r in chat.perspectives(turns).collect()}
    assert set(got) == {(1, s, p) for s in ("ann", "bob", "cy") for p in (0, 2)} | {
        (2, "unknown", 0), (5, "a", 0)
    }
    for c, speaker in ((1, "ann"), (1, "bob"), (1, "cy")):
        parts = [got[c, speaker, p] for p in (0, 2)]
        text = "".join(p.text for p in parts)
        assert parts[1].start == len(parts[0].text)
        said = [text[m.start : m.start + m.length] for p in parts for m in p.mask]
        assert said == [f"{t or ''}<|im_end|>\n" for _, _, s, t in rows[:5] if s == speaker]
        assert sum(p.target_chars for p in parts) == sum(map(len, said))
    assert got[1, "bob", 0].text == (
        "<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>user name=ann\nhi<|im_end|>\n"
        "<|im_start|>assistant\nhey<|im_end|>\n<|im_start|>user name=ann\n<|im_end|>\n"
    )
    assert got[5, "a", 0].n_turns == 2 and "<im_end>x" in got[2, "unknown", 0].text
    assert chat.perspectives(turns.limit(0)).collect() == []


def test_quality_counts(spark, odd_documents):
    got = {r.doc_id: r for r in quality.judge(odd_documents.where("doc_id is not null")).collect()}
    assert tuple(got[2])[1:6] == tuple(got[3])[1:6] == tuple(got[4])[1:6] == (0, 0, 0, 0, 0)
    assert got[2].base_failed and not got[2].kept
    assert got[5].n_words == 60_000 and got[5].n_repeat_words == 0
    texts = ["a b c a b c", "a b c d a b c", "x x x x", "l one\nl one\n \nl one", "A a"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = quality.judge(rows).orderBy("doc_id").collect()
    assert [r.n_repeat_words for r in found] == [6, 6, 4, 6, 0]
    assert [r.n_dup_lines for r in found] == [0, 0, 0, 2, 0]


def test_quality_keeps_columns_and_agrees_with_judge(spark, odd_documents, sample):
    assert quality.keep_good(odd_documents).columns == odd_documents.columns
    assert quality.keep_good(odd_documents.limit(0)).collect() == []
    docs = spark.read.parquet(f"{sample}/documents.parquet")
    kept = {r.doc_id for r in quality.keep_good(docs).collect()}
    assert kept == {r.doc_id for r in quality.judge(docs).where("kept").collect()}


def test_one_rule_that_misfires_is_outvoted(spark):
    """Votes are weighed by what the corpus says about the rules."""
    rows = [(*v, n) for v, n in (
        ((1, 1, 1, 1, 1, 1, 1), 900), ((-1, -1, 1, 1, 1, 1, 1), 60), ((1, 1, -1, -1, 1, 1, 1), 50),
        ((1, 1, 1, 1, 1, 1, -1), 40),
    )]
    names = [f"v{k}" for k in range(len(quality.RULES))]
    votes = spark.createDataFrame(rows, ", ".join(f"{c} int" for c in names) + ", n long")
    model = quality.learn(votes)
    p = votes.select(quality.posterior(model, [F.col(c) for c in names]).alias("p")).collect()
    assert p[0].p > 0.9 and p[1].p < 0.2 and p[2].p < 0.2


def test_suffixes_of_the_caller(spark):
    hosts = ["a.bad.co.nz", "new.co.nz", "x.y.city.kobe.jp", "shop.uk", "b.c.co.uk", "10.0.0.1"]
    frame = spark.createDataFrame([(h,) for h in hosts], "host string")
    long = ("Co.nz", "co.uk", "city.kobe.jp")
    got = frame.select(
        url_filter.domain_of(F.col("host"), long), url_filter.suffix_of(F.col("host"), long)
    ).collect()
    assert [tuple(r) for r in got] == [
        ("bad.co.nz", "co.nz"),
        ("new.co.nz", "co.nz"),
        ("y.city.kobe.jp", "city.kobe.jp"),
        ("shop.uk", "uk"),
        ("c.co.uk", "co.uk"),
        ("10.0.0.1", "1"),
    ]
    labelled = [("a.bad.co.nz", 1)] * 300 + [(f"h{i}.co.nz", 0) for i in range(20) for _ in range(30)]
    labelled = spark.createDataFrame(labelled, "host string, bad int")
    pages = spark.createDataFrame([(1, "http://b.bad.co.nz/"), (2, "http://c.h3.co.nz/")], "page_id long, url string")
    lower = lambda **k: {r.page_id: r.lower for r in url_filter.judge(pages, labelled, **k).collect()}
    alike, apart = lower(), lower(long=long)
    assert alike[1] == alike[2]
    assert apart[1] > apart[2]


def test_a_host_is_blocked_by_its_own_evidence_at_any_size(spark):
    def verdicts(times, share):
        """20 hosts with ``share`` of bad pages and one with 60 %, ``times`` 20 pages each."""
        seen = [(f"h{i}.com", int(j % 20 < 20 * share)) for i in range(20) for j in range(20 * times)]
        seen += [("worst.com", int(j % 20 < 12)) for j in range(20 * times)]
        labelled = spark.createDataFrame(seen, "host string, bad int")
        urls = [(1, "http://h3.com/"), (2, "http://worst.com/"), (3, "http://unseen.com/"), (4, "http://x.org/")]
        pages = spark.createDataFrame(urls, "page_id long, url string")
        found = {r.page_id: (r.verdict, r.lower) for r in url_filter.judge(pages, labelled).collect()}
        return {k: v for k, (v, _) in found.items()}, {k: low for k, (_, low) in found.items()}

    for times in (10, 100):
        # The base rate of 0.25 is above the fixed share, at both sizes.
        by, lower = verdicts(times, 0.25)
        assert by == {1: "allow", 2: "block", 3: "allow", 4: "allow"}
        assert lower[2] > lower[1] > lower[3] >= lower[4]
        # Where all hosts are alike, however bad, none is.
        assert set(verdicts(times, 0.6)[0].values()) == {"allow"}


def test_reputation_counts_pages_not_the_prior(spark):
    rows = [(f"h{i}.com", j % 4 == 0) for i in range(30) for j in range(40)]
    labelled = spark.createDataFrame([(h, int(b)) for h, b in rows], "host string, bad int")
    hosts = spark.createDataFrame([("h1.com",), ("new.com",), ("new.org",)], "host string")
    got = {r.host: r for r in url_filter.reputation(labelled, hosts).collect()}
    assert abs(got["h1.com"].mean - 0.25) < 0.01 and abs(got["h1.com"].base - 0.25) < 0.01
    assert got["h1.com"].var < got["new.com"].var < got["new.org"].var
    nothing = url_filter.reputation(labelled.limit(0), hosts).collect()
    assert {(r.mean, r.lower, r.base) for r in nothing} == {(0.5, 0.0, None)}


def test_verdicts_equal_sql_where_hosts_differ(spark, tmp_path):
    """The sample's hosts are alike; here shares differ by host, domain and suffix."""
    import duckdb

    from cardloom.llm import queries
    from cardloom.llm.oracle import ORACLES

    urls, labels, n = [], [], 0
    for d in range(12):
        suffix = ("com", "org", "co.uk")[d % 3]
        for h in range(5):
            for j in range(3 + 7 * h):
                labels.append((n, 0 if (j * 7 + h) % 10 < (9 if d == 4 else 6 if h == 2 else 1) else 1, None if j == 2 else 0))
                urls.append((n, f"http://h{h}.d{d}.{suffix}/xx/{n}"))
                n += 1
    urls += [(n + i, u) for i, u in enumerate(["http://new.d4.org/", "http://new.other.org/", "http://a.zz/", None])]
    spark.createDataFrame(urls, "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    con = duckdb.connect()
    for name in ("pages", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({ORACLES['op1_url_reputation']})").fetchall()
    got = queries.op1_url_reputation(spark, str(tmp_path)).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    by_host = {r.host: r.verdict for r in got}
    assert by_host["h4.d4.org"] == "block" and by_host["h4.d0.com"] == "allow"
