"""The three jobs end to end: feature build, stacking and blending, fast path.

Every stage is a table under one output folder, written once and read back, so
a lost executor or a failed stage costs that stage only.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.functions.lookup import clustered
from cardloom.models import blend, boosting, extra_trees, network, oof, ordered
from cardloom.models.scaling import embed_2d, minmax_scale, model_inputs
from cardloom.models.selection import KEEP, SELECTION_SEED, select_by_importance
from cardloom.operators import (
    assemble,
    calendar,
    cards as card_ops,
    cuts,
    encode,
    lags,
    merchants,
    profiles,
)
from cardloom.operators.columns import feature_names
from cardloom.operators.folds import card_folds
from cardloom.sources.readers import by_merchant, write_scores_csv
from cardloom.sources.staging import remove, resumed, stage_root

LAG_FROM = (0, -2, -6)
AMOUNT_RANGES = ((-7, -3), (-1, 100), (-3, 100), (-100, 100))
STACK_SEEDS = (40, 400, 4000)
# The first two stacks have a learner more.
STACK_EXTRA = (True, True, False)
# Boosted on histograms for all folds at once; the other slot is ordered boosting.
HISTOGRAM_SLOTS = ("xgb", "lgb", "lgb2")
EXTRA = dict(seed=4950, numTrees=300)


@dataclass(frozen=True)
class Settings:
    """``as_of`` is the day ages are counted to; the dates fit the data's years."""

    as_of: str
    out: str
    holidays: Mapping[str, str] = field(default_factory=lambda: dict(calendar.HOLIDAYS))
    new_holidays: Mapping[str, str] = field(
        default_factory=lambda: {h: calendar.HOLIDAYS[h] for h in calendar.NEW_HOLIDAYS}
    )
    quarter_starts: Sequence[str] = calendar.QUARTER_STARTS
    keep: Sequence[int] = KEEP
    folds: int = blend.MODEL_FOLDS
    # Overrides for every boosted model and forest, e.g. fewer trees.
    boosting: Mapping[str, object] = field(default_factory=dict)
    forest: Mapping[str, object] = field(default_factory=dict)
    # The same for both networks.
    network: Mapping[str, object] = field(default_factory=dict)


def _stage(
    make: Callable[..., DataFrame], s: Settings, name: str, *args: object, **settings: object
) -> DataFrame:
    """The named stage ``make(*args)``. A run into the same folder goes on where the last one
    ended; what is finished is made again only if an input, among ``args`` or a list there, or
    another argument or setting is a different one now."""
    inputs, plain = [], dict(settings)
    for k, arg in enumerate(args):
        frames = arg if isinstance(arg, (list, tuple)) else [arg]
        if frames and all(isinstance(f, DataFrame) for f in frames):
            inputs += frames
        else:
            plain[f"argument {k}"] = arg
    made_by = f"{make.__module__}.{make.__qualname__}"
    return resumed(
        SparkSession.active(), lambda: make(*args), f"{s.out}/{name}", made_by, plain, inputs
    )


def _job(run):
    """Stages inside operators go below the job's own folder, and are deleted at its end."""

    @functools.wraps(run)
    def inner(*args, **kwargs):
        s = next(a for a in (*args, *kwargs.values()) if isinstance(a, Settings))
        with stage_root(f"{s.out}/_work"):
            return run(*args, **kwargs)

    return inner


def clean_up(spark: SparkSession, s: Settings) -> None:
    """Delete what only the jobs themselves needed."""
    remove(spark, f"{s.out}/_work")


def by_card(log: DataFrame, s: Settings, name: str) -> DataFrame:
    """The log as parquet, card by card: parsed once, and every per-card
    aggregate over it combines on the map side."""
    return _stage(clustered, s, name, log, "card_id")


@_job
def build_features(
    train: DataFrame, test: DataFrame, hist: DataFrame, new: DataFrame, s: Settings
) -> dict[str, DataFrame]:
    """Three growing feature tables, one row per card: 'base', 'merchants' (adds
    the merchants' profiles) and 'amounts' (adds quarters and amounts). Each part
    is a stage of its own: its plan stays small, and a failure repeats only it."""
    cards = _stage(card_ops.card_table, s, "cards", train, test, s.as_of)
    hist, new = by_card(hist, s, "hist"), by_card(new, s, "new")

    def table(name: str, make: Callable[..., DataFrame], *args) -> DataFrame:
        return _stage(make, s, f"part-{name}", *args)

    profile = assemble.assemble_features(
        cards,
        [
            table("hist", profiles.hist_card_profile, hist, s.as_of, s.holidays),
            table("new", profiles.new_card_profile, new, s.as_of, s.new_holidays),
        ],
    )
    profile = assemble.to_epoch_seconds(assemble.first_last_buy(profile))
    # All month ranges from one pass over the log.
    ranges = table(
        "ranges",
        cuts.lag_and_amount_profiles,
        hist,
        s.as_of,
        s.holidays,
        LAG_FROM,
        AMOUNT_RANGES,
    )
    parts = [
        table("hist-encoding", encode.oof_target_encode, hist, cards),
        table("new-encoding", encode.oof_target_encode, new, cards, "new_target_encoding_"),
        table("date-encoding", encode.date_target_encode, cards, hist),
        ranges.select("card_id", *[c for c in ranges.columns if c.startswith("hist_monthlag")]),
        table("monthly", lags.monthly_change, hist, new),
        table("embedding", embed_2d, cards, feature_names(cards)),
    ]
    base = _stage(
        assemble.assemble_features, s, "base", assemble.hist_new_combine(profile), parts
    )

    sides = {
        "new": table("new-merchants", merchants.new_merchant_profile, new, s.as_of, s.holidays),
        # Only merchants in the new log are looked up there.
        "hist": table(
            "hist-merchants", merchants.hist_merchant_profile, hist, s.as_of, s.holidays, "clip", new
        ),
    }
    stored = _stage(
        lambda a, b: by_merchant(merchants.merchant_combined(a, b)),
        s,
        "merchant-profiles",
        sides["new"],
        sides["hist"],
    )
    visited = table("visited", merchants.card_merchant_profile, new, stored)
    with_merchants = _stage(assemble.assemble_features, s, "merchants", base, [visited])

    more = [
        table("quarters", profiles.quarter_profile, hist, s.quarter_starts),
        table("new-amounts", profiles.new_amount_profile, new, s.as_of),
        ranges.select("card_id", *[c for c in ranges.columns if "_amount" in c and c.startswith("hist_month-")]),
    ]
    amounts = _stage(assemble.assemble_features, s, "amounts", with_merchants, more)
    return {"base": base, "merchants": with_merchants, "amounts": amounts}


@_job
def select(features: DataFrame, s: Settings, name: str) -> DataFrame:
    """card_id, outliers, target and the best features."""

    def make(features: DataFrame) -> DataFrame:
        folds = card_folds(features, s.folds, SELECTION_SEED).select("card_id", "fold")
        return select_by_importance(
            features.join(folds, "card_id"),
            s.keep,
            estimator=oof.gbt(**(oof.BOOSTED["lgb2"] | dict(s.boosting))),
        )

    return _stage(make, s, name, features, keep=s.keep, folds=s.folds, boosting=dict(s.boosting))


@_job
def stack(
    selected: DataFrame, seed: int, s: Settings, name: str, extra: bool = False
) -> DataFrame:
    """Level-1 predictions of one selected feature set. ``extra`` adds trees of random
    thresholds, grown on all rows."""

    def make(selected: DataFrame) -> DataFrame:
        features = feature_names(selected)
        folds = card_folds(selected, s.folds, seed).select("card_id", "fold")
        inputs = minmax_scale(model_inputs(selected, features), features).join(folds, "card_id")
        data = oof.vectors(inputs, features)
        boosted = {m: p | dict(s.boosting) for m, p in oof.BOOSTED.items()}
        learners = {}
        by_histogram = {m: boosting.slot(boosted[m]) for m in HISTOGRAM_SLOTS}
        learners["random"] = oof.forest(**s.forest)
        learners["ridgek"] = oof.ridge(data, oof.LEVEL1_ALPHA)
        plain = oof.stack_level1(data, learners, s.folds)
        # All inputs of this slot are numbers by now, so it has no category columns.
        cat = ordered.oof_ordered(data, oof.VECTOR, (), s.folds, ordered.slot(boosted["cat"]), "cat")
        both = plain.join(boosting.slots(data, oof.VECTOR, s.folds, by_histogram), "card_id")
        net = replace(network.Params(widths=network.LEVEL1_WIDTHS), **s.network)
        nn = network.oof_network(data, oof.VECTOR, s.folds, net)
        for found in (cat.select("card_id", "cat"), nn.select("card_id", "nn")):
            both = both.join(found, "card_id")
        if not extra:
            return both
        found = extra_trees.oof_extra(data, oof.VECTOR, s.folds, extra_trees.slot(EXTRA | dict(s.forest)), "extra")
        return both.join(found.select("card_id", "extra"), "card_id")

    return _stage(
        make,
        s,
        name,
        selected,
        seed=seed,
        extra=extra,
        folds=s.folds,
        boosting=dict(s.boosting),
        forest=dict(s.forest),
        network=dict(s.network),
    )


@_job
def blend_stacks(stacks: Sequence[DataFrame], s: Settings) -> DataFrame:
    """card_id, target, pred over all cards, from all three learners of the second level."""
    weights = blend.WEIGHTS
    net = replace(network.Params(widths=network.LEVEL2_WIDTHS, patience=18), **s.network)
    stacked = _stage(blend.stack_features, s, "stacked", list(stacks))
    return _stage(
        lambda table: blend.level2(table, weights, k=s.folds, net=net, **dict(s.boosting)),
        s,
        "blended",
        stacked,
        weights=dict(weights),
        folds=s.folds,
        boosting=dict(s.boosting),
        network=dict(s.network),
    )


def write_scores(scored: DataFrame, path: str) -> str:
    test = scored.filter(F.col("target").isNull())
    return write_scores_csv(test.select("card_id", F.col("pred").alias("target")), path, "overwrite")


@_job
def stacked_scores(features: Mapping[str, DataFrame], s: Settings) -> DataFrame:
    """The ordinary path: select and stack each feature table, then blend."""
    stacks = []
    for (name, table), seed, extra in zip(features.items(), STACK_SEEDS, STACK_EXTRA):
        chosen = select(table, s, f"selected-{name}")
        stacks.append(stack(chosen, seed, s, f"stack-{name}", extra))
    blended = blend_stacks(stacks, s)
    write_scores(blended, f"{s.out}/test-scores")
    return blended


@_job
def fast_scores(base: DataFrame, s: Settings) -> DataFrame:
    """The fast path: one boosted model on the selected base features. Its
    out-of-fold error by fold and over all is written beside the scores."""
    selected = select(base, s, "selected-fast")
    features = feature_names(selected)
    predictions = _stage(
        lambda table: blend.score_single(table, features, s.folds, **dict(s.boosting))[0],
        s,
        "single-model-predictions",
        selected,
        folds=s.folds,
        boosting=dict(s.boosting),
    )
    write_scores(predictions, f"{s.out}/single-model")
    _stage(oof.fold_rmse, s, "single-model-rmse", predictions)
    return predictions
