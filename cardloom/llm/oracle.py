"""DuckDB SQL of the queries that SQL can express.

The others (decontamination by edit distance, greedy tokens, trained models,
packing) are compared with brute force in the tests.
"""

from __future__ import annotations

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = rf"""
WITH urls AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path,
         try_cast(regexp_extract(url, '://[^/?#]*/[a-z]+/([0-9]+)', 1) AS BIGINT) AS doc_id
  FROM pages
), rules(rule, action) AS (
  VALUES ('net/', 'block'), ('example.net/en/', 'allow'), ('example.com/de/', 'block'), ('org/fr/', 'allow')
), fits AS (
  SELECT page_id, u.host, u.path, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
  FROM urls u JOIN rules
    ON ends_with('.' || u.host, '.' || split_part(rule, '/', 1))
   AND starts_with(u.path, substr(rule, strpos(rule, '/')))
  GROUP BY ALL
), cut AS (
  SELECT host, string_split(host, '.') AS l,
         host IN (SELECT host FROM urls WHERE regexp_matches(host, '^[0-9.:]+$')) AS ip FROM (SELECT DISTINCT host FROM urls)
), named AS (
  SELECT host,
         CASE WHEN two IN ('ac.uk','co.jp','co.uk','com.au','com.br','gov.uk','org.uk') THEN two ELSE l[-1] END AS suffix,
         CASE WHEN ip THEN host WHEN two IN ('ac.uk','co.jp','co.uk','com.au','com.br','gov.uk','org.uk')
              THEN array_to_string(l[-3:], '.') ELSE two END AS domain
  FROM (SELECT *, array_to_string(l[-2:], '.') AS two FROM cut)
), counted AS (
  SELECT host, suffix, domain, sum(bad)::DOUBLE AS bad, count(*)::DOUBLE AS pages
  FROM (SELECT u.host, (l.quality = 0 OR l.toxic = 1)::INT AS bad FROM urls u JOIN labels l USING (doc_id))
  JOIN named USING (host) WHERE bad IS NOT NULL GROUP BY ALL
), total AS (
  SELECT (sum(bad) + 0.5::DOUBLE) / (sum(pages) + 1) AS base, sum(pages) AS all_pages FROM counted
), su AS (
  SELECT suffix, sum(bad) AS bad, sum(pages) AS pages, any_value(base) AS prior,
         any_value(base * (1 - base) / (all_pages + 1)) AS unsure FROM counted, total GROUP BY suffix
), ss AS (
  SELECT greatest(2.0::DOUBLE, least(1000.0::DOUBLE, CASE WHEN m > 0 AND s > e THEN m / (s - e) - 1 ELSE 1000.0::DOUBLE END)) AS k
  FROM (SELECT sum(pages * power(bad / pages - prior, 2)) AS s, sum(prior * (1 - prior)) AS e,
               sum(prior * (1 - prior) * (pages - 1)) AS m FROM su)
), sp AS (
  SELECT suffix, mean, mean * (1 - mean) / (pages + k + 1) + power(k / (pages + k), 2) * unsure AS var
  FROM (SELECT *, (bad + k * prior) / (pages + k) AS mean FROM su, ss)
), du AS (
  SELECT domain, suffix, sum(bad) AS bad, sum(pages) AS pages, any_value(mean) AS prior, any_value(var) AS unsure
  FROM counted JOIN sp USING (suffix) GROUP BY domain, suffix
), ds AS (
  SELECT greatest(2.0::DOUBLE, least(1000.0::DOUBLE, CASE WHEN m > 0 AND s > e THEN m / (s - e) - 1 ELSE 1000.0::DOUBLE END)) AS k
  FROM (SELECT sum(pages * power(bad / pages - prior, 2)) AS s, sum(prior * (1 - prior)) AS e,
               sum(prior * (1 - prior) * (pages - 1)) AS m FROM du)
), dp AS (
  SELECT domain, mean, mean * (1 - mean) / (pages + k + 1) + power(k / (pages + k), 2) * unsure AS var
  FROM (SELECT *, (bad + k * prior) / (pages + k) AS mean FROM du, ds)
), hu AS (
  SELECT host, bad, pages, mean AS prior, var AS unsure FROM counted JOIN dp USING (domain)
), hs AS (
  SELECT greatest(2.0::DOUBLE, least(1000.0::DOUBLE, CASE WHEN m > 0 AND s > e THEN m / (s - e) - 1 ELSE 1000.0::DOUBLE END)) AS k
  FROM (SELECT sum(pages * power(bad / pages - prior, 2)) AS s, sum(prior * (1 - prior)) AS e,
               sum(prior * (1 - prior) * (pages - 1)) AS m FROM hu)
), hp AS (
  SELECT host, mean, mean * (1 - mean) / (pages + k + 1) + power(k / (pages + k), 2) * unsure AS var
  FROM (SELECT *, (bad + k * prior) / (pages + k) AS mean FROM hu, hs)
), means AS (
  SELECT host, coalesce(hp.mean, dp.mean, sp.mean, base) AS mean, hp.var AS hv, dp.var AS dv, sp.var AS sv, base, all_pages,
         1 / (hs.k + 1) AS h, 1 / (ds.k + 1) AS d, 1 / (ss.k + 1) AS s
  FROM named LEFT JOIN hp USING (host) LEFT JOIN dp USING (domain) LEFT JOIN sp USING (suffix), total, hs, ds, ss
), known AS (
  SELECT host, base, greatest(0, mean - 1.645 * sqrt(coalesce(hv, dv + mean * (1 - mean) * h, sv + mean * (1 - mean) * (h + d),
           mean * (1 - mean) * (h + d + s) + base * (1 - base) / (all_pages + 1)))) AS lower
  FROM means
)
SELECT u.page_id, u.host, u.path, f.rule,
       coalesce(f.action, CASE WHEN lower > 0.2 AND lower * (1 - base) > 2 * base * (1 - lower)
                               THEN 'block' ELSE 'allow' END) AS verdict
FROM urls u JOIN known USING (host) LEFT JOIN fits f USING (page_id)
"""


def same_groups(n: int, percent: int) -> str:
    """``doc_id, n_shingles, component_id``; common table expressions up to ``result``."""
    return f"""
toks AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM docs
), grams AS MATERIALIZED (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {n} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(w[i:i + {n - 1}], ' ')) END)) AS g FROM toks
), sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM grams GROUP BY 1
), links AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, p.n, q.n HAVING 100 * count(*) >= {percent} * (p.n + q.n - count(*))
), reach(x, y) AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), result AS (
  SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, coalesce(r.y, d.doc_id)) AS component_id
  FROM docs d LEFT JOIN sizes s USING (doc_id) LEFT JOIN (SELECT x, min(y) AS y FROM reach GROUP BY x) r ON r.x = d.doc_id
)"""


OP3 = f"WITH RECURSIVE docs AS (SELECT doc_id, text FROM documents), {same_groups(4, 85)} SELECT * FROM result"

OP4 = """
WITH t AS (
  SELECT conv_id, turn, translate(replace(replace(coalesce(role, 'unknown'), '<|im_start|>', '<im_start>'), '<|im_end|>', '<im_end>'), chr(13) || chr(10), '  ') AS role,
         replace(replace(coalesce(text, ''), '<|im_start|>', '<im_start>'), '<|im_end|>', '<im_end>') AS said,
         floor(turn / 256)::BIGINT AS part
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL
), s AS (
  SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> 'system'
), r AS (
  SELECT conv_id, speaker, part, turn, t.role, said, t.role = speaker AS own,
         CASE WHEN t.role = speaker THEN '<|im_start|>assistant' WHEN t.role = 'system' THEN '<|im_start|>system'
              ELSE '<|im_start|>user name=' || t.role END || chr(10) AS head
  FROM t JOIN s USING (conv_id)
), p AS (
  SELECT *, head || said || '<|im_end|>' || chr(10) AS piece,
         row_number() OVER (PARTITION BY conv_id, speaker ORDER BY turn, role, said) AS k FROM r
), o AS (
  SELECT *, coalesce(sum(length(piece)) OVER (PARTITION BY conv_id, speaker ORDER BY k
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begins FROM p
)
SELECT conv_id, speaker, part, count(*) AS n_turns, min(begins) AS start, string_agg(piece, '' ORDER BY k) AS text,
       coalesce(string_agg((begins + length(head)) || ':' || (length(said) + 11), ',' ORDER BY k) FILTER (own), '') AS mask,
       coalesce(sum(length(said) + 11) FILTER (own), 0)::BIGINT AS target_chars
FROM o GROUP BY conv_id, speaker, part
"""

_VOTES = (
    ("n_symbols::DOUBLE / n_words", 0.1, 0.02),
    ("n_punctuation::DOUBLE / word_chars", 0.12, 0.08),
    ("n_capitals::DOUBLE / word_chars", 0.5, 0.1),
    ("n_marks::DOUBLE / n_words", 0.3, 0.05),
    ("n_repeat_words::DOUBLE / n_words", 0.4, 0.2),
    ("n_dup_lines::DOUBLE / n_lines", 0.5, 0.3),
    ("abs(word_chars::DOUBLE / n_words - 5.5)", 4.5, 3.0),
)
RULES = range(len(_VOTES))
_ODDS = "ln(m.good / (1 - m.good))" + "".join(
    f" + CASE v{i} WHEN 1 THEN ln(m.g{i}p / m.b{i}p) WHEN -1 THEN ln(m.g{i}m / m.b{i}m) ELSE ln(m.g{i}z / m.b{i}z) END"
    for i in RULES
)


def _em_step(k: int) -> str:
    """One round of expectation-maximisation: the model m{k} from m{k-1}."""
    names = {"p": 1, "z": 0, "m": -1}
    chances = ", ".join(
        f"(coalesce(sum(p * n) FILTER (v{i} = {v}), 0) + 1) / (sum(p * n) + 3) AS g{i}{c}, "
        f"(coalesce(sum((1 - p) * n) FILTER (v{i} = {v}), 0) + 1) / (sum((1 - p) * n) + 3) AS b{i}{c}"
        for i in RULES
        for c, v in names.items()
    )
    return (
        f"e{k} AS MATERIALIZED (SELECT pat.*, 1 / (1 + exp(-({_ODDS}))) AS p FROM pat, m{k - 1} m), "
        f"m{k} AS MATERIALIZED (SELECT (sum(p * n) + 1) / (sum(n) + 2) AS good, {chances} FROM e{k})"
    )


def quality(rounds: int = 15) -> str:
    """Common table expressions up to ``judged``."""
    votes = ", ".join(
        f"CASE WHEN n_words > 0 AND {value} >= {bad}::DOUBLE THEN -1 WHEN n_words > 0 AND {value} <= {good}::DOUBLE THEN 1 ELSE 0 END AS v{i}"
        for i, (value, bad, good) in enumerate(_VOTES)
    )
    first = ", ".join(
        f"0.9::DOUBLE AS g{i}p, 0.08::DOUBLE AS g{i}z, 0.02::DOUBLE AS g{i}m, 0.5::DOUBLE AS b{i}p, 0.1::DOUBLE AS b{i}z, 0.4::DOUBLE AS b{i}m"
        for i in RULES
    )
    steps = ", ".join(_em_step(k) for k in range(1, rounds + 1))
    bare = "regexp_replace({}, '" + SPACE + "', '', 'g')"
    return f"""
base AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(t, '{WORD}') AS w, t, list_filter(string_split(t, chr(10)), lambda x: {bare.format('x')} <> '') AS l
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM docs)
), runs AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, r) AS c
  FROM (SELECT doc_id, i, w[i:i + 2] AS r FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM base WHERE len(w) > 2))
), reps AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM runs WHERE c > 1) GROUP BY 1
), feat AS MATERIALIZED (
  SELECT doc_id, len(w)::BIGINT AS n_words, length({bare.format('t')})::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(reps.n, 0)::BIGINT AS n_repeat_words,
         len(l) AS n_lines, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_capitals,
         length(regexp_replace(t, '[^!?]', '', 'g')) AS n_marks,
         length(regexp_replace(t, '[^\\x21-\\x2F\\x3A-\\x40\\x5B\\x5D-\\x60\\x7B-\\x7E]', '', 'g')) AS n_punctuation
  FROM base LEFT JOIN reps USING (doc_id)
), voted AS MATERIALIZED (SELECT *, {votes} FROM feat
), pat AS MATERIALIZED (SELECT {', '.join(f'v{i}' for i in RULES)}, count(*)::DOUBLE AS n FROM voted GROUP BY ALL
), m0 AS (SELECT 0.8::DOUBLE AS good, {first}), {steps}, judged AS (
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
         NOT base_failed AND p >= 0.5 AS kept
  FROM (SELECT voted.*, 1 / (1 + exp(-({_ODDS}))) AS p, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
        FROM voted, m{rounds} m)
)"""


OP5 = f"WITH docs AS (SELECT doc_id, text FROM documents), {quality()} SELECT * FROM judged"

OP8 = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), bits AS (
  SELECT page_id, payload_bytes, hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((('0x' || substr(hex, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INT, 1), '' ORDER BY i) AS payload_digest
  FROM p, range(32) r(i) GROUP BY ALL
), m AS (SELECT payload_digest, max(page_id) AS top FROM bits GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM bits JOIN m USING (payload_digest)
"""

_NEAREST = """
near{k} AS MATERIALIZED (
  SELECT r, p, v, e, d FROM (
    SELECT r, x.p, x.v, b.e, list_sum([(x.v[i] - b.v[i]) * (x.v[i] - b.v[i]) for i in range(1, len(b.v) + 1)])::BIGINT AS d
    FROM x JOIN book{k} b USING (p))
  QUALIFY row_number() OVER (PARTITION BY r, p ORDER BY d, e) = 1
)"""
_BOOK = """
book{n} AS MATERIALIZED (
  SELECT p, e, coalesce(m.v, b.v) AS v FROM book{k} b LEFT JOIN (
    SELECT p, e, list(floor(s::DOUBLE / n)::BIGINT ORDER BY i) AS v FROM (
      SELECT p, e, i, sum(v[i]) AS s, count(*) AS n FROM near{k}, unnest(range(1, len(v) + 1)) u(i) GROUP BY ALL)
    GROUP BY ALL) m USING (p, e)
)"""

OP13 = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
         [floor(256 * c::DOUBLE)::BIGINT for c in embedding] AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len([c for c in embedding if c IS NULL OR isnan(c) OR isinf(c)]) = 0
), x AS MATERIALIZED (
  SELECT r, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS v FROM kept, range(16) t(p)
), book0 AS MATERIALIZED (SELECT p, r - 1 AS e, v FROM x WHERE r <= 64
), {_NEAREST.format(k=0)}, {_BOOK.format(k=0, n=1)}, {_NEAREST.format(k=1)}, {_BOOK.format(k=1, n=2)}, {_NEAREST.format(k=2)},
digest AS (
  SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256
  FROM (SELECT p, e, i, v[i] AS c FROM book2, unnest(range(1, len(v) + 1)) u(i))
), coded AS (
  SELECT r, string_agg(lower(printf('%02x', e)), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near2 GROUP BY r
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), digest
"""

ORACLES = {
    "op1_url_reputation": OP1,
    "op3_ngram_join": OP3,
    "op4_perspectives": OP4,
    "op5_quality_rules": OP5,
    "op8_warc_revisits": OP8,
    "op13_vector_codes": OP13,
}
