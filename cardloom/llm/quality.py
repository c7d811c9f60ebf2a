"""Quality rules under weak supervision.

Each rule looks at one property of a text and votes good, bad or abstains. How
far a rule can be trusted is not set by hand: rules are assumed to err
independently of each other given the (unknown) quality, and expectation-maximisation estimates
from all votes how often documents are good and how each rule votes on good and on
bad ones. A document is kept when its posterior probability of being good is
high enough, so one rule that misfires does not throw it away.

Only counts of vote patterns are needed: at most ``3 ** rules`` rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import fresh, staged

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
ROUNDS = 15
# A document is good when its posterior probability is at least this.
KEEP = 0.5
# Rule: (name, value, bad at or above, good at or below). Between them it abstains.
RULES = (
    ("symbols", "n_symbols / n_words", 0.1, 0.02),
    ("punctuation", "n_punctuation / word_chars", 0.12, 0.08),
    ("capitals", "n_capitals / word_chars", 0.5, 0.1),
    ("marks", "n_marks / n_words", 0.3, 0.05),
    ("repeated_words", "n_repeat_words / n_words", 0.4, 0.2),
    ("repeated_lines", "n_dup_lines / n_lines", 0.5, 0.3),
    ("word_length", "abs(word_chars / n_words - 5.5)", 4.5, 3.0),
)
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~"
# Where the estimate begins: a good document rarely trips a rule, a bad one trips
# some and passes others. Chances of votes good, none and bad.
PRIOR_GOOD = 0.8
ON_GOOD, ON_BAD = (0.9, 0.08, 0.02), (0.5, 0.1, 0.4)
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_MORE = ("n_lines", "n_punctuation", "n_capitals", "n_marks")


def _without(text: str, characters: str) -> str:
    listed = "".join({"\\": "\\\\", "'": "\\'"}.get(c, c) for c in characters)
    return f"translate({text}, '{listed}', '')"


def with_features(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the counts of ``BASE`` and four more (64-bit), and the column
    that has each: another name where ``docs`` has that one already.

    Words are runs of characters other than ASCII spaces. ``n_repeat_words`` counts the words
    that lie in a run of three words found at least twice in the text.
    """
    text, words, hashes, runs, places, rows = (
        fresh(docs, c) for c in ("text_", "words_", "hashes_", "runs_", "places_", "lines_")
    )
    df = docs.withColumn(text, F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    df = df.withColumn(
        words,
        F.expr(f"filter(split(`{text}`, '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w <> '')"),
    )
    df = df.withColumn(
        hashes,
        F.expr(
            f"if(size(`{words}`) < 3, array(), transform(slice(`{words}`, 1, size(`{words}`) - 2), (w, i) ->"
            f" xxhash64(w, element_at(`{words}`, i + 2), element_at(`{words}`, i + 3))))"
        ),
    )
    # All runs of three words with their places, equal ones side by side; nothing
    # to sort where they all differ.
    df = df.withColumn(
        runs,
        F.expr(
            f"if(size(array_distinct(`{hashes}`)) = size(`{hashes}`), array(),"
            f" sort_array(transform(`{hashes}`, (h, i) -> struct(h as h, i as i))))"
        ),
    )
    # Places of those that occur again, in order of place.
    df = df.withColumn(
        places,
        F.expr(
            f"sort_array(transform(filter(`{runs}`, (r, k) ->"
            f" (k > 0 and `{runs}`[greatest(k - 1, 0)].h = r.h)"
            f" or (k + 1 < size(`{runs}`) and `{runs}`[least(k + 1, size(`{runs}`) - 1)].h = r.h)), r -> r.i))"
        ),
    )
    t, lines = f"`{text}`", f"`{rows}`"
    df = df.withColumn(
        rows, F.expr(f"filter(split({t}, '\\n', -1), x -> {_without('x', SPACES)} <> '')")
    )
    values = {
        "n_words": f"size(`{words}`)",
        "word_chars": f"length({_without(t, SPACES)})",
        "n_symbols": f"length({t}) - length({_without(t, SYMBOLS)})",
        "n_dup_lines": f"size({lines}) - size(array_distinct({lines}))",
        # Each place covers three words, less what the next one covers too.
        "n_repeat_words": f"aggregate(`{places}`, struct(0L as n, -3 as last), (a, p) ->"
        " struct(a.n + least(3, p - a.last) as n, p as last), a -> a.n)",
        "n_lines": f"size({lines})",
        "n_punctuation": f"length({t}) - length({_without(t, PUNCTUATION)})",
        "n_capitals": f"length({t}) - length({_without(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')})",
        "n_marks": f"length({t}) - length({_without(t, '!?')})",
    }
    names = {k: fresh(docs, k) for k in values}
    # As the output of a generator the counts are made once per row: a filter on
    # plain expressions would be pushed down and make all of the above again for each use.
    counted = fresh(docs, "counts_")
    counts = F.struct(*[F.expr(v).cast("long").alias(k) for k, v in values.items()])
    out = df.select(
        *[F.col(f"`{c}`") for c in docs.columns], F.explode(F.array(counts)).alias(counted)
    ).select(
        *[F.col(f"`{c}`") for c in docs.columns],
        *[F.col(f"`{counted}`.{k}").alias(names[k]) for k in values],
    )
    return out, names


def votes(names: dict[str, str]) -> list[Column]:
    """Of every rule 1 (good), -1 (bad) or 0 (abstains; also where there is no word)."""
    out = []
    for _, value, bad, good in RULES:
        # No lines or words: nothing to divide by, and null is neither bad nor good.
        value = re.sub(r"(\w+) / (\w+)", r"try_divide(\1, \2)", value)
        value = re.sub(
            r"\b(n_\w+|word_chars)", lambda m: f"cast(`{names[m[0]]}` as double)", value
        )
        known = f"`{names['n_words']}` > 0"
        out.append(
            F.expr(
                f"case when {known} and {value} >= {bad}D then -1"
                f" when {known} and {value} <= {good}D then 1 else 0 end"
            )
        )
    return out


def failed(names: dict[str, str]) -> Column:
    """Too short, or too much of it repeated."""
    n, r = names["n_words"], names["n_repeat_words"]
    return F.expr(f"`{n}` < {MIN_WORDS} or 100 * `{r}` > {MAX_REPEAT_PERCENT} * `{n}`")


def first_model() -> dict:
    """Share of good documents; per rule the chances of votes 1, 0 and -1."""
    return {
        "good": PRIOR_GOOD,
        "on_good": [dict(zip((1, 0, -1), ON_GOOD)) for _ in RULES],
        "on_bad": [dict(zip((1, 0, -1), ON_BAD)) for _ in RULES],
    }


def posterior(model: dict, voted: list[Column]) -> Column:
    """Probability of being good, by the rules' votes."""
    odds = F.lit(math.log(model["good"] / (1 - model["good"])))
    for vote, good, bad in zip(voted, model["on_good"], model["on_bad"]):
        gain = {v: math.log(good[v] / bad[v]) for v in good}
        odds = odds + F.when(vote == 1, F.lit(gain[1])).when(vote == -1, F.lit(gain[-1])).otherwise(
            F.lit(gain[0])
        )
    return 1 / (1 + F.exp(-odds))


def learn(patterns: DataFrame, rounds: int = ROUNDS) -> dict:
    """The model after ``rounds`` of expectation-maximisation on ``patterns(v0,
    v1, ..., n)``, one row per pattern, so at most ``3 ** rules`` rows come to the driver.
    Sums are smoothed by one document, so no chance becomes 0."""
    rules = range(len(RULES))
    rows = [tuple(r) for r in patterns.select(*[f"v{k}" for k in rules], "n").collect()]
    model = first_model()
    every = sum(n for *_, n in rows)
    for _ in range(rounds if every else 0):
        good, yes, no = 0.0, [Counter() for _ in rules], [Counter() for _ in rules]
        first = math.log(model["good"] / (1 - model["good"]))
        for *voted, n in rows:
            pairs = zip(voted, model["on_good"], model["on_bad"])
            odds = first + sum(math.log(g[v] / b[v]) for v, g, b in pairs)
            p = n / (1 + math.exp(-odds))
            good += p
            for k, v in enumerate(voted):
                yes[k][v] += p
                no[k][v] += n - p
        bad = every - good
        model = {
            "good": (good + 1) / (every + 2),
            "on_good": [{v: (yes[k][v] + 1) / (good + 3) for v in (1, 0, -1)} for k in rules],
            "on_bad": [{v: (no[k][v] + 1) / (bad + 3) for v in (1, 0, -1)} for k in rules],
        }
    return model


def fit(features: DataFrame, names: dict[str, str], rounds: int = ROUNDS) -> dict:
    """The model of the votes of all rows of ``with_features``."""
    patterns = (
        features.select(*[v.cast("int").alias(f"v{k}") for k, v in enumerate(votes(names))])
        .groupBy(*[f"v{k}" for k in range(len(RULES))])
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return learn(staged(patterns, "vote_patterns"), rounds)


def judge(
    docs: DataFrame, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, the counts of ``BASE``, ``good`` (posterior probability of being
    good), ``base_failed`` and ``kept`` for every row of ``docs``.

    All texts are counted in fitting the model. A null, empty or blank text has no
    word: every rule abstains and the base rule fails. Null ids and rows that
    repeat are kept and count as often. Other columns are not read; an empty
    table gives an empty result.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    features, names = with_features(rows)
    features = staged(features.drop("text"), "quality_counts")
    model = fit(features, names, rounds)
    return (
        features.withColumn("good", posterior(model, votes(names)))
        .withColumn("base_failed", failed(names))
        .select(
            "doc_id",
            *BASE,
            "good",
            "base_failed",
            (~F.col("base_failed") & (F.col("good") >= KEEP)).alias("kept"),
        )
    )


def keep_good(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """The rows that ``judge`` keeps, with the columns of ``docs``, whatever
    their names. The rows are staged with their counts: counting costs far more
    than writing and reading them again."""
    features, names = with_features(docs, text_col)
    features = staged(features, "counted_documents")
    model = fit(features, names, rounds)
    good = posterior(model, votes(names)) >= KEEP
    return features.where(~failed(names) & good).select(*[F.col(f"`{c}`") for c in docs.columns])
