"""Target encodings in which no card sees its own target.

A card of fold f is encoded from all other folds, a test card (fold -1) from
every train card. Sums and counts per value and fold are taken once; the
encoding for a fold is the total less that fold.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.functions.arrays import groups, states
from cardloom.functions.lookup import SMALL_ROWS, hot_split_lookup, lookup, together
from cardloom.functions.stats import AGGREGATES, smoothed_mean
from cardloom.operators.folds import card_folds
from cardloom.sources.staging import staged

TEST_FOLD = -1
# Row count at which a value's own mean and the prior weigh the same.
CENTER = 85.0
# The encoded columns of a raw log, in feature order.
ENCODED_KEYS = (
    "city_id",
    "category_1",
    "installments",
    "authorized_flag",
    "category_3",
    "merchant_category_id",
    "month_lag",
    "merchant_id",
    "category_2",
    "state_id",
    "subsector_id",
)
_ENCODED_SQL = {
    **{s: AGGREGATES[s] for s in ("sum", "mean", "max", "min", "var")},
    "mean": "try_divide(sum({c}), count({c}))",
}
ENCODING_FOLDS = 7
# Columns per grouped aggregate.
BLOCK = 22
LOG_SEED = 10
DATE_SEED = 1199


def lookup_encode(
    df: DataFrame, table: DataFrame, column: str, value: str, name: str | None = None
) -> DataFrame:
    """Adds ``name``: the table's ``value`` for the row's key; NULL when unseen."""
    renamed = table.select(F.col(column), F.col(value).alias(name or f"{column}_enc"))
    return lookup(df, renamed, [column])


def label_transactions(log: DataFrame, folds: DataFrame) -> DataFrame:
    """Each row with the target and fold of its card."""
    return lookup(log, folds.select("card_id", "target", "fold"), ["card_id"])


def smoothed_target_mean(
    df: DataFrame, column: str, prior: Column, target: str = "target", center: float = CENTER
) -> DataFrame:
    """column, n, encoding; the encoding is NULL for a value without a target."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.sum(target).alias("s"), F.count(target).alias("n"))
        .select(column, "n", smoothed_mean(F.col("s"), F.col("n"), prior, center).alias("encoding"))
    )


def leave_fold_out(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    """From ``s`` and ``n`` per keys and fold to the same over all other folds,
    plus a row for fold -1 with the full total. A group has one entry per fold."""
    total = sums.groupBy(*keys).agg(
        F.sum("s").alias("__s"),
        F.sum("n").alias("__n"),
        F.concat(
            F.collect_list(F.struct("fold", "s", "n")),
            F.array(
                F.struct(
                    F.lit(TEST_FOLD).alias("fold"),
                    F.lit(0.0).alias("s"),
                    F.lit(0).cast("long").alias("n"),
                )
            ),
        ).alias("__held"),
    )
    return total.withColumn("__f", F.explode("__held")).select(
        *keys,
        F.col("__f.fold").alias("fold"),
        (F.col("__s") - F.col("__f.s")).alias("s"),
        (F.col("__n") - F.col("__f.n")).alias("n"),
    )


def transaction_prior(labelled: DataFrame) -> DataFrame:
    """fold, prior: mean target over the rows of the other folds."""
    sums = (
        labelled.filter(F.col("target").isNotNull())
        .groupBy("fold")
        .agg(F.sum("target").alias("s"), F.count("target").alias("n"))
    )
    return leave_fold_out(sums, []).select("fold", F.try_divide("s", "n").alias("prior"))


def _prior_column(priors: Mapping[int, float | None]) -> Column:
    out = F.lit(None).cast("double")
    for fold, value in priors.items():
        out = F.when(F.col("fold") == fold, F.lit(value)).otherwise(out)
    return out


def fold_statistics(labelled: DataFrame, keys: Sequence[str]) -> DataFrame:
    """key_ix, value, fold, s, n over the other folds, for all keys in one pass
    over the log. key_ix -1 is the whole log, from which the prior follows."""
    entries = [F.struct(F.lit(-1).alias("key_ix"), F.lit("").alias("value"))]
    entries += [
        F.struct(F.lit(i).alias("key_ix"), F.col(k).cast("string").alias("value"))
        for i, k in enumerate(keys)
    ]
    sums = (
        labelled.filter(F.col("target").isNotNull())
        .select("fold", "target", F.explode(F.array(*entries)).alias("e"))
        .select("fold", "target", "e.key_ix", "e.value")
        .filter(F.col("value").isNotNull())
        .groupBy("key_ix", "value", "fold")
        .agg(F.sum("target").alias("s"), F.count("target").alias("n"))
    )
    return leave_fold_out(sums, ["key_ix", "value"])


def encode_rows(labelled: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, bool]:
    """card_id and one ``<key>taren`` column per key for each row of the log, and
    whether all encodings were broadcast, which leaves the rows in their place."""
    stats = staged(fold_statistics(labelled, keys), "fold-statistics")
    # One row per fold.
    overall = stats.filter(F.col("key_ix") == -1).collect()
    prior = _prior_column({r["fold"]: r["s"] / r["n"] if r["n"] else None for r in overall})
    encoding = smoothed_mean(F.col("s"), F.col("n"), prior, CENTER)
    rows = labelled.select(
        "card_id", "fold", *[F.col(k).cast("string").alias(f"__k{i}") for i, k in enumerate(keys)]
    )
    table = stats.filter(F.col("key_ix") >= 0).select(
        "key_ix", "value", "fold", encoding.alias("encoding")
    )
    sizes = {r["key_ix"]: r["count"] for r in table.groupBy("key_ix").count().collect()}
    small = [i for i in range(len(keys)) if sizes.get(i, 0) <= SMALL_ROWS]
    # All small encodings come over in one go: at most SMALL_ROWS per key.
    local = table.filter(F.col("key_ix").isin(small)).toArrow()
    for i, k in enumerate(keys):
        on = [f"__k{i}", "fold"]
        columns = [F.col("value").alias(f"__k{i}"), "fold", F.col("encoding").alias(f"{k}taren")]
        if i in small:
            part = local.filter(pc.equal(local["key_ix"], i))
            part = rows.sparkSession.createDataFrame(part, table.schema).select(*columns)
            rows = rows.join(F.broadcast(part), on, "left")
        else:
            part = table.filter(F.col("key_ix") == i).select(*columns)
            rows = hot_split_lookup(rows, part, on)
    return rows.select("card_id", *[f"{k}taren" for k in keys]), len(small) == len(keys)


def ratio_name(a: str, b: str) -> str:
    return f"{a}taren{b}tarensou"


def target_ratio_pairs(encoded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds the ratio of each pair of encodings."""
    ratios = (f"try_divide({a}taren, {b}taren) AS {ratio_name(a, b)}" for a, b in combinations(keys, 2))
    return encoded.selectExpr("*", *ratios)


def encoding_profile(encoded: DataFrame, columns: Sequence[str], prefix: str) -> DataFrame:
    """Per card sum, mean, max, min and var of the given columns. Mean is taken
    from sum and count to keep the aggregation buffer small, and the columns are
    aggregated in blocks, since a single buffer of hundreds of values outgrows
    generated code. The blocks share the partitioning by card."""

    def block(names: Sequence[str]) -> DataFrame:
        exprs = [
            F.expr(sql.replace("{c}", f"`{name}`") + f" AS `{prefix}{name}_{stat}`")
            for name in names
            for stat, sql in _ENCODED_SQL.items()
        ]
        return encoded.groupBy("card_id").agg(*exprs)

    blocks = [block(columns[i : i + BLOCK]) for i in range(0, len(columns), BLOCK)]
    return reduce(lambda a, b: a.join(b, "card_id"), blocks)


class _Sums:
    """Per card the numbers of its rows and copies and the states of each column."""

    def __init__(self, cards: pa.Array, rows: np.ndarray, copies: np.ndarray, states: dict[str, np.ndarray]):
        self.cards, self.rows, self.copies, self.states = cards, rows, copies, states

    def __getitem__(self, at: slice) -> _Sums:
        return _Sums(self.cards[at], self.rows[at], self.copies[at], {f: v[:, at] for f, v in self.states.items()})

    def after(self, held: _Sums) -> _Sums:
        """With the one card of ``held`` in front, or in the first place if it is the same."""
        before, here = held.cards[0], self.cards[0]
        if before.is_valid != here.is_valid or (here.is_valid and before != here):
            cards = pa.concat_arrays([held.cards, self.cards])
            rows, copies = (np.concatenate(x) for x in ((held.rows, self.rows), (held.copies, self.copies)))
            return _Sums(cards, rows, copies, {f: np.concatenate([held.states[f], v], axis=1) for f, v in self.states.items()})
        self.rows[0] += held.rows[0]
        a, b = ({f: v[:, 0] for f, v in x.states.items()} for x in (held, self))
        n, s = a["n"] + b["n"], a["s"] + b["s"]
        mean = s / np.maximum(n, 1)
        off = [np.where(x["n"] > 0, x["s"] / np.maximum(x["n"], 1) - mean, 0) for x in (a, b)]
        m2 = a["m2"] + b["m2"] + a["n"] * off[0] ** 2 + b["n"] * off[1] ** 2
        hi = np.where(a["n"] == 0, b["hi"], np.where(b["n"] == 0, a["hi"], np.maximum(a["hi"], b["hi"])))
        for f, v in {"n": n, "s": s, "lo": np.fmin(a["lo"], b["lo"]), "hi": hi, "m2": m2}.items():
            self.states[f][:, 0] = v
        return self

    def profile(self, labels: Sequence[str]) -> pa.RecordBatch:
        """As ``_ENCODED_SQL`` has it; NULL throughout for a card without a row."""
        n, s, lo, hi, m2 = (self.states[f] for f in _STATES)
        none = n == 0
        made = {
            "sum": (s, np.broadcast_to(self.rows == 0, n.shape)),
            "mean": (s / np.maximum(n, 1), none),
            "max": (hi, none),
            "min": (lo, none),
            "var": (m2 / np.maximum(n - 1, 1), n < 2),
        }
        values = [pa.array(made[t][0][i], mask=made[t][1][i]) for i in range(len(n)) for t in _ENCODED_SQL]
        batch = pa.RecordBatch.from_arrays([self.cards, *values], ["card_id", *labels])
        if (self.copies != 1).any():
            batch = batch.take(pa.array(np.repeat(np.arange(len(self.cards)), self.copies)))
        return batch


_STATES = ("n", "s", "lo", "hi", "m2")


def _sorted_profile(columns: int, labels: Sequence[str]):
    def sums(batch: pa.RecordBatch) -> _Sums:
        codes = batch.column("card_id").dictionary_encode("encode")
        starts, sizes = groups(codes.indices.to_numpy())
        rows = np.add.reduceat(batch.column("__in").is_valid().to_numpy(zero_copy_only=False), starts, dtype=np.int64)
        found = [states(batch.column(f"v{i}"), None, starts, sizes, _STATES) for i in range(columns)]
        copies = batch.column("__copies").to_numpy()[starts]
        return _Sums(batch.column("card_id").take(pa.array(starts)), rows, copies, {f: np.stack([x[f] for x in found]) for f in _STATES})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not len(batch):
                continue
            made = sums(batch)
            made = made if held is None else made.after(held)
            if len(made.cards) > 1:
                yield made[:-1].profile(labels)
            held = made[-1:]  # it may go on in the next batch
        if held is not None:
            yield held.profile(labels)

    return run


def placed_encoding_profile(joined: DataFrame, columns: Sequence[str], prefix: str) -> DataFrame:
    """``encoding_profile`` of doubles where a card's rows are in one partition, in one pass that makes
    its statistics as arrays. ``joined`` has all cards: ``__in`` is NULL in the row of a card
    without transactions, and ``__copies`` says how many rows a card has in the result."""
    labels = [f"{prefix}{name}_{stat}" for name in columns for stat in _ENCODED_SQL]
    kind = joined.schema["card_id"].dataType.simpleString()
    rows = joined.select(
        "card_id", "__in", "__copies", *[F.col(f"`{c}`").cast("double").alias(f"v{i}") for i, c in enumerate(columns)]
    )
    return rows.sortWithinPartitions("card_id").mapInArrow(
        _sorted_profile(len(columns), labels), f"card_id {kind}, {', '.join(f'`{x}` double' for x in labels)}"
    )


def join_encoding_left(cards: DataFrame, encoding: DataFrame) -> DataFrame:
    """All cards; those without transactions get NULL encodings."""
    return cards.join(encoding, "card_id", "left")


def oof_target_encode(
    log: DataFrame,
    cards: DataFrame,
    prefix: str = "hist_target_encoding_",
    keys: Sequence[str] = ENCODED_KEYS,
    k: int = ENCODING_FOLDS,
    seed: int = LOG_SEED,
    ratios: bool = True,
) -> DataFrame:
    """Encoded profile of every train and test card from a raw log."""
    folds = staged(card_folds(cards, k, seed), "card-folds")
    known = log.filter(F.col("card_id").isNotNull()).select("card_id", *keys)
    labelled = label_transactions(known, folds).filter(F.col("fold").isNotNull())
    # Narrow rows, written once for the passes below.
    labelled = staged(labelled, "labelled")
    encoded, _ = encode_rows(labelled, keys)
    base = [f"{c}taren" for c in keys]
    names = base + [ratio_name(a, b) for a, b in combinations(keys, 2)] if ratios else base
    # As an array, so that all blocks of columns read the same shuffle.
    rows = encoded.select("card_id", F.array(*[F.col(f"`{c}`") for c in base]).alias("__encoded"))

    def wide(rows: DataFrame) -> DataFrame:
        rows = rows.select("*", *[F.col("__encoded")[i].alias(c) for i, c in enumerate(base)])
        return target_ratio_pairs(rows, keys) if ratios else rows

    def profile(rows: DataFrame, placed: bool, cards: DataFrame) -> DataFrame:
        if not placed:
            return join_encoding_left(cards, encoding_profile(wide(rows), names, prefix))
        # The cards join the rows, which lie by card, and not the results, which as output of a
        # task are not known to.
        cards = cards.groupBy("card_id").agg(F.count(F.lit(1)).alias("__copies"))
        joined = join_encoding_left(cards, rows.withColumn("__in", F.lit(1)))
        return placed_encoding_profile(wide(joined), names, prefix)

    return together(rows, "card_id", profile, count_in=labelled, beside=folds.select("card_id"))


def last_observation_date(hist: DataFrame) -> DataFrame:
    """Month after the one that lag 0 stands for, from each card's last purchase."""
    return (
        hist.filter(F.col("card_id").isNotNull())
        .groupBy("card_id")
        .agg(
            F.max("month_lag").alias("hist_month_lag"),
            F.max("purchase_date").alias("hist_purchase_date"),
        )
        .withColumn(
            "observation_date",
            F.add_months(
                F.trunc("hist_purchase_date", "MM"), F.lit(1) - F.col("hist_month_lag")
            ),
        )
    )


def first_new_observation_date(new: DataFrame) -> DataFrame:
    return (
        new.filter(F.col("card_id").isNotNull())
        .groupBy("card_id")
        .agg(
            F.min("month_lag").alias("new_month_lag"),
            F.min("purchase_date").alias("new_purchase_date"),
        )
        .withColumn(
            "observation_date",
            F.add_months(F.trunc("new_purchase_date", "MM"), F.lit(1) - F.col("new_month_lag")),
        )
    )


def join_observation_date(cards: DataFrame, dates: DataFrame, how: str = "left") -> DataFrame:
    """``how='full'`` also keeps cards seen only in the log."""
    return cards.join(dates, "card_id", how)


def date_target_encode(
    cards: DataFrame, hist: DataFrame, k: int = ENCODING_FOLDS, seed: int = DATE_SEED
) -> DataFrame:
    """Out-of-fold target mean of the card's observation date; prior: card mean."""
    folds = staged(card_folds(cards, k, seed), "card-folds")
    dated = join_observation_date(
        folds, last_observation_date(hist).select("card_id", "observation_date")
    )
    stats = staged(fold_statistics(dated, ["observation_date"]), "fold-statistics")
    overall = stats.filter(F.col("key_ix") == -1).collect()
    prior = _prior_column({r["fold"]: r["s"] / r["n"] if r["n"] else None for r in overall})
    table = stats.filter(F.col("key_ix") == 0).select(
        F.col("value").cast("date").alias("observation_date"),
        "fold",
        smoothed_mean(F.col("s"), F.col("n"), prior, CENTER).alias("observation_date_target"),
    )
    return lookup(dated, table, ["observation_date", "fold"]).select(
        "card_id", "observation_date_target"
    )
