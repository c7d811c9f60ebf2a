"""N-gram Jaccard join: documents whose word n-gram sets are nearly equal.

Two sets link when ``100 * common >= percent * union``. Every step below only
drops what provably has no link, so the result is the same as comparing all pairs.

1. Documents with equal sets form one class; only classes are compared.
2. A class whose set holds more than ``(100 - percent) %`` n-grams that no other
   class has links with nothing: these rarest n-grams alone fill its prefix.
   Counting them in a fixed fraction of the hash space is enough to see it.
3. The others order their n-grams rarest first. If x and y link, then x has an
   n-gram of its prefix in common with the prefix of y (prefix filter). The sizes
   bound the union (length filter) and the places of the common n-gram bound
   what can follow it (positional filter).
4. Of the classes that share a prefix n-gram, one with the fewest n-grams of its
   own is compared with all others first. Groups of near copies fall into
   one component here, with a number of pairs in proportion to their size. Only
   those left outside are compared with the rest, each pair once.
5. A pair is verified by the suffix filter and then by counting.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm import words
from cardloom.llm.common import WORD, fresh, staged
from cardloom.llm.components import components
from cardloom.sources.staging import remove, stage_path

# Step 2 looks at the n-grams in this fraction of the hash space. A smaller one
# moves fewer rows and leaves more classes to step 3; no value changes the result.
SCREEN = 0.25
# The order of an n-gram: eight steps per doubling of its frequency, then its hash.
STEPS = 8
HASH_BITS = 55


def _signatures(n: int):
    cut = np.uint64(int(SCREEN * 2**64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, one, two, low, at = [], [], [], [], [0]
            for s in words.text_shingles(batch.column("text"), n):
                size.append(len(s))
                one.append(words.mix(s).sum(dtype=np.uint64))
                two.append(words.mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64))
                low.append(s[: np.searchsorted(s, cut)])
                at.append(at[-1] + len(low[-1]))
            flat = np.concatenate(low) if low else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("key"),
                    batch.column("hash"),
                    pa.array(np.array(size, np.int64)),
                    pa.array(np.array(one, np.uint64).view(np.int64)),
                    pa.array(np.array(two, np.uint64).view(np.int64)),
                    pa.ListArray.from_arrays(np.array(at, np.int32), flat.view(np.int64)),
                ],
                ["doc_id", "key", "hash", "n", "one", "two", "low"],
            )

    return run


def _grams(n: int):
    """``(one, two, gram)`` of the documents whose sum ``one`` is the wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            want = batch.column("want").to_numpy().view(np.uint64)
            for i, s in enumerate(words.text_shingles(batch.column("text"), n)):
                one = words.mix(s).sum(dtype=np.uint64)
                if one == want[i]:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(s), one).view(np.int64)),
                            pa.array(s.view(np.int64)),
                        ],
                        ["one", "gram"],
                    )

    return run


def _apart(x: np.ndarray, y: np.ndarray, depth: int) -> int:
    """A lower bound of the n-grams that only one of two sorted sets has: both
    are split at the middle n-gram of y and the sizes of the halves compared."""
    if not depth or not len(x) or not len(y):
        return abs(len(x) - len(y))
    mid = len(y) // 2
    cut = int(np.searchsorted(x, y[mid]))
    found = int(cut < len(x) and x[cut] == y[mid])
    return (
        _apart(x[:cut], y[:mid], depth - 1)
        + (1 - found)
        + _apart(x[cut + found :], y[mid + 1 :], depth - 1)
    )


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            ga, gb = batch.column("ga"), batch.column("gb")
            good = np.zeros(len(a), bool)
            for i in range(len(a)):
                x, y = ga[i].values.to_numpy(), gb[i].values.to_numpy()
                both = int(na[i] + nb[i])
                # 100 c >= p (both - c), or both - 2 c <= room
                need = -(-percent * both // (100 + percent))
                own = both - len(x) - len(y)  # n-grams that no other class has
                if own + _apart(x, y, 3) > both - 2 * need:
                    continue
                good[i] = len(np.intersect1d(x, y, assume_unique=True)) >= need
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[good]), pa.array(b[good])], ["a", "b"]
            )

    return run


def _passes(percent: int) -> str:
    """Length and positional filter of rows x and y with one n-gram in common."""
    need = f"({percent} * (x.n + y.n) + {99 + percent}) div {100 + percent}"
    return f"least(x.n - x.place, y.n - y.place) >= {need}"


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The verified of ``pairs(a, b)``."""
    one = sets.select(F.col("one").alias("a"), F.col("n").alias("na"), F.col("grams").alias("ga"))
    two = sets.select(F.col("one").alias("b"), F.col("n").alias("nb"), F.col("grams").alias("gb"))
    found = pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "ga", "gb")
    return staged(found.mapInArrow(_verified(percent), "a long, b long"), "verified_links")


def _pairs(found: DataFrame) -> DataFrame:
    return found.select(
        F.least("x.one", "y.one").alias("a"), F.greatest("x.one", "y.one").alias("b")
    ).distinct()


def _sets(docs: DataFrame, open_: DataFrame, n: int) -> DataFrame:
    """``one, n, grams``: of every open class the n-grams that at least two open
    classes have, rarest first, as sortable numbers."""
    wanted = open_.select("key", F.col("one").alias("want"))
    spark = docs.sparkSession
    path = stage_path(spark, "open_grams")
    grams = staged(
        # The wanted keys grow with the corpus, so they are never broadcast.
        docs.join(wanted.hint("merge"), "key").select("want", "text").mapInArrow(
            _grams(n), "one long, gram long"
        ),
        "open_grams",
        path,
    )
    often = staged(
        grams.groupBy("gram")
        .agg(
            F.count(F.lit(1)).alias("df"),
            F.min("one").alias("first"),
            F.max("one").alias("last"),
        )
        .where("first <> last")
        .select(
            "gram",
            F.expr(
                f"shiftleft(least(255L, cast(floor({STEPS} * log2(df)) as bigint)), {HASH_BITS})"
                f" | shiftrightunsigned(gram, {64 - HASH_BITS})"
            ).alias("rank"),
        ),
        "gram_ranks",
    )
    shared = (
        grams.join(often, "gram")
        .groupBy("one")
        .agg(F.sort_array(F.collect_set("rank")).alias("grams"))
    )
    sets = staged(open_.join(shared, "one").select("one", "n", "grams"), "open_sets")
    remove(spark, path)  # the largest stage; nothing reads it any more
    return sets


def _open_roots(sets: DataFrame, percent: int) -> DataFrame:
    """``one, root`` of the classes that link with another one."""
    prefix = staged(
        sets.withColumn("own", F.expr("n - size(grams)"))
        .withColumn(
            "grams",
            F.expr(f"slice(grams, 1, cast(greatest(0, n * {100 - percent} div 100 + 1 - own) as int))"),
        )
        .select("one", "n", "own", F.posexplode("grams").alias("i", "gram"))
        .select("gram", "one", "n", "own", F.expr("own + i").alias("place")),
        "prefixes",
    )
    first = staged(
        prefix.groupBy("gram")
        .agg(
            F.min(F.struct("own", "one", "n", "place")).alias("y"),
            F.count(F.lit(1)).alias("rows"),
        )
        .where("rows > 1")
        .select("gram", "y.one", "y.n", "y.place"),
        "first_of_gram",
    )
    tried = staged(
        _pairs(
            prefix.alias("x")
            .join(first.alias("y"), F.expr("x.gram = y.gram"))
            .where(f"x.one <> y.one and {_passes(percent)}")
        ),
        "first_pairs",
    )
    near = _links(tried, sets, percent)
    roots = components(near)

    # Who is not with the first of a common n-gram meets all others that share it.
    rooted = lambda df: (
        df.join(roots, F.col("one") == F.col("node"), "left")
        .withColumn("root", F.expr("coalesce(root, one)"))
        .drop("node")
    )
    placed = staged(rooted(prefix), "placed")
    heads = staged(rooted(first).select("gram", F.col("root").alias("head")), "heads")
    outside = staged(
        placed.join(heads, "gram").where("root <> head").drop("head"), "outside"
    )
    rest = staged(
        _pairs(
            outside.alias("x")
            .join(placed.alias("y"), F.expr("x.gram = y.gram"))
            .where(f"x.root <> y.root and {_passes(percent)}")
        ).join(tried, ["a", "b"], "left_anti"),
        "other_pairs",
    )
    far = _links(rest, sets, percent)

    # The roots that the second kind of links joins.
    merged = components(
        far.join(roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left")
        .join(roots.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left")
        .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    ).select(F.col("node").alias("root"), F.col("root").alias("top"))
    nodes = roots.unionByName(
        far.select(F.explode(F.array("a", "b")).alias("node"))
        .distinct()
        .join(roots, "node", "left_anti")
        .select("node", F.col("node").alias("root"))
    )
    return nodes.join(merged, "root", "left").select(
        F.col("node").alias("one"), F.coalesce("top", "root").alias("root")
    )


def ngram_join(
    docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    ``n_shingles`` is the number of distinct runs of ``n`` words (A-Z folded to
    lower case; a shorter text counts as one run), ``component_id`` the smallest id
    among the documents that links lead to, the document itself included.

    A null, empty or blank text has 0 n-grams, links with nothing and keeps its
    own id. Rows that repeat come out as often as they came in. Rows without an
    id are compared like others; their component is the smallest id in it that is
    not null, or null. Other columns of ``docs`` are not read. An empty table
    gives an empty result. Ids are integers.
    """
    rows, named = _grouped(docs, n, percent, id_col, text_col)
    return (
        rows.select("doc_id", "n", "one", "two")
        .join(named, ["one", "two"], "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.coalesce("first.doc_id", "doc_id").alias("component_id"),
        )
    )


def _grouped(
    docs: DataFrame, n: int, percent: int, id_col: str, text_col: str
) -> tuple[DataFrame, DataFrame]:
    """``doc_id, key, hash, n, one, two`` of every row, and for every class ``one, two``
    the ``first`` row of its component: smallest id, none last, then smallest hash of the text."""
    docs = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
    ).withColumn("hash", F.xxhash64("text"))
    docs = docs.withColumn("key", F.coalesce("doc_id", "hash"))
    rows = staged(
        docs.mapInArrow(
            _signatures(n),
            "doc_id long, key long, hash long, n long, one long, two long, low array<long>",
        ),
        "shingle_sets",
    )
    classes = staged(
        rows.where("n > 0")
        .groupBy("one", "two")
        .agg(
            F.max("n").alias("n"),
            F.min(F.struct(F.isnull("doc_id").alias("unnamed"), "doc_id", "hash")).alias("first"),
            F.min("key").alias("key"),
        ),
        "classes",
    )
    alone = (
        rows.select("one", F.explode("low").alias("gram"))
        .groupBy("gram")
        .agg(F.min("one").alias("one"), F.max("one").alias("last"))
        .where("one = last")
        .groupBy("one")
        .agg(F.count(F.lit(1)).alias("alone"))
    )
    open_ = staged(
        classes.join(alone, "one", "left").where(
            f"100 * coalesce(alone, 0) <= {100 - percent} * n"
        ),
        "open_classes",
    )
    linked = classes.join(_open_roots(_sets(docs, open_, n), percent), "one")
    least = linked.groupBy("root").agg(F.min("first").alias("component"))
    named = staged(
        classes.join(
            linked.join(least, "root").select("one", "two", "component"), ["one", "two"], "left"
        ).select("one", "two", F.coalesce("component", "first").alias("first")),
        "named_classes",
    )
    return rows, named


def one_of_each(
    docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of ``docs`` of each component, with all its columns: that with the smallest
    id, none last, then the smallest hash of its text; of equal rows any one. Ids need not be
    unique: different texts of one id are rows of their own. Rows without a word link with
    nothing and all stay."""
    rows, named = _grouped(docs, n, percent, id_col, text_col)
    id_name, hash_name = fresh(docs, "id_"), fresh(docs, "hash_")
    gone = (
        rows.where("n > 0")
        .join(named, ["one", "two"])
        .where("not (doc_id <=> first.doc_id and hash = first.hash)")
        .select(F.col("doc_id").alias(id_name), F.col("hash").alias(hash_name))
        .distinct()
    )
    text = F.col(f"`{text_col}`")
    blank = ~F.coalesce(text.rlike(WORD), F.lit(False))
    keyed = docs.where(~blank).withColumn(id_name, F.col(f"`{id_col}`").cast("long"))
    keyed = keyed.withColumn(hash_name, F.xxhash64(text))
    same = keyed[id_name].eqNullSafe(gone[id_name]) & (keyed[hash_name] == gone[hash_name])
    kept = (
        keyed.join(gone, same, "left_anti")
        .dropDuplicates([id_name, hash_name])
        .drop(id_name, hash_name)
    )
    return kept.unionByName(docs.where(blank))
