"""Item-item neighbours over a catalogue of the most bought products, of any length.

Items are numbered and dealt out to blocks of ``BLOCK_ITEMS``. Co-purchases are a
product of blocks: for each pair of blocks that a user's items touch, a task adds the
user's part to a matrix of the two blocks, which is all it holds at a time.
Similarities stay rows of a table. Users are scored block by block too: a slab holds
the similarities of all items to those of one block, and meets the users in portions,
and what a user gets of each block is a bounded list. Users are never joined with each
other and never brought together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trolley.functions.hashing import digest_number, seeded_digest
from trolley.functions.skew import BROADCAST_ROWS, dense_index
from trolley.functions.stats import ratio
from trolley.operators.metrics import confusion_metrics, roc_auc
from trolley.sources.storage import settled

BLOCK_ITEMS = 512
# Users of one portion that meets a slab, and parts that a pair of blocks is counted in.
PORTION_USERS = 20_000
COUNT_PARTS = 64
# Matrices of two blocks that a task keeps before it sends their counts on.
HELD_MATRICES = 64
SCORE_DIGITS = 9


def catalogue(df: DataFrame, products: int = 200) -> DataFrame:
    """(product_name, item): the most bought names, numbered from 0 in name order.

    The list is stored, so that what follows does not scan the table again.
    """
    top = (
        df.filter(F.col("product_name").isNotNull())
        .groupBy("product_name")
        .agg(F.count(F.lit(1)).alias("_n"))
        .orderBy(F.desc("_n"), "product_name")
        .limit(products)
    )
    numbered = dense_index(top, "product_name")
    return settled(numbered.select(F.col("id").alias("product_name"), F.col("idx").cast("int").alias("item")), "catalogue")


def _named(items: DataFrame) -> DataFrame:
    """The catalogue for a join: broadcast if it is short."""
    return F.broadcast(items) if items.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else items


def user_items(
    df: DataFrame,
    items: DataFrame,
    min_items: int = 5,
    users: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """(user_id, items): the catalogue items each user bought, for users with enough of them.

    ``users`` draws that many users by digest; ``None`` keeps all.
    """
    return drawn_users(bought_items(df, items), min_items, users, seed)


def bought_items(df: DataFrame, items: DataFrame) -> DataFrame:
    """(user_id, items): the catalogue items of every user who bought any, in order."""
    return (
        df.filter(F.col("user_id").isNotNull())
        .join(_named(items), "product_name")
        .select("user_id", "item")
        .distinct()
        .groupBy("user_id")
        .agg(F.sort_array(F.collect_list("item")).alias("items"))
    )


def drawn_users(bought: DataFrame, min_items: int, users: int | None = None, seed: int = 42) -> DataFrame:
    """The users of ``bought_items`` with enough of them; of these as many as ``user_items`` draws."""
    kept = bought.filter(F.size("items") >= min_items)
    if users is None:
        return kept
    return kept.orderBy(seeded_digest(seed, "user_id"), "user_id").limit(users)


def interactions(held: DataFrame, items: DataFrame) -> DataFrame:
    """(user_id, product_name): one row per user and item."""
    pairs = held.select("user_id", F.explode("items").alias("item"))
    return pairs.join(_named(items), "item").select("user_id", "product_name")


# --- similarity -----------------------------------------------------------


def co_counts(rows: DataFrame, group: str, n_items: int, block: int = BLOCK_ITEMS) -> DataFrame:
    """(group, a, b, together): in how many rows of a group items a <= b occur together.

    A catalogue of one block needs no shuffle of the rows: each task adds up one
    matrix per group. Otherwise a row goes, with the items of two blocks, to the task
    that counts a part of this pair of blocks; a row of very many items is cut into its
    blocks first, so no array is longer than a block. Tasks send sums.
    """
    kinds = f"{group} int, a int, b int, together long"
    if n_items <= block:
        held = F.array_sort("items")
        pairs = rows.select(group, F.lit(0).alias("low"), F.lit(0).alias("high"), held.alias("first"), held.alias("second"))
    else:
        row = F.monotonically_increasing_id() if "user_id" not in rows.columns else F.col("user_id")
        parts = (
            rows.select(group, row.alias("_row"), F.explode("items").alias("_item"))
            .groupBy(group, "_row", F.floor(F.col("_item") / block).cast("int").alias("_block"))
            .agg(F.collect_list(F.col("_item") % block).alias("_items"))
        )
        first = parts.select(group, "_row", F.col("_block").alias("low"), F.col("_items").alias("first"))
        second = parts.select(group, "_row", F.col("_block").alias("high"), F.col("_items").alias("second"))
        part = F.pmod(F.xxhash64("_row"), F.lit(COUNT_PARTS))
        pairs = (
            first.join(second, [group, "_row"])
            .filter("low <= high")
            .withColumn("_part", part)
            .repartition(group, "low", "high", "_part")
            .select(group, "low", "high", "first", "second")
        )
    partial = pairs.mapInPandas(_multiplied(group, block), kinds)
    return partial.groupBy(group, "a", "b").agg(F.sum("together").alias("together"))


def _multiplied(group: str, block: int):
    def rows_of(lists: pd.Series) -> np.ndarray:
        bought = np.zeros((len(lists), block), dtype=np.float32)
        bought[np.repeat(np.arange(len(lists)), lists.map(len).to_numpy()), np.concatenate(lists.to_numpy())] = 1.0
        return bought

    def counted(key, matrix: np.ndarray) -> pd.DataFrame:
        value, low, high = key
        a, b = np.nonzero(np.triu(matrix) if low == high else matrix)
        return pd.DataFrame(
            {group: value, "a": a + low * block, "b": b + high * block, "together": matrix[a, b].astype(np.int64)}
        )

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict = {}
        for batch in batches:
            for key, part in batch.groupby([group, "low", "high"]):
                first = rows_of(part["first"])
                second = first if key[1] == key[2] else rows_of(part["second"])
                sums[key] = sums.get(key, 0.0) + (first.T @ second).astype(np.float64)
                if len(sums) > HELD_MATRICES:
                    yield counted(key, sums.pop(key))
        for key, matrix in sums.items():
            yield counted(key, matrix)

    return multiply


def cosine(counts: DataFrame, group: str) -> DataFrame:
    """(group, a, b, similarity) for a < b from co-counts that include a = b."""
    own = counts.filter(F.col("a") == F.col("b"))
    first = own.select(group, "a", F.col("together").alias("_na"))
    second = own.select(group, "b", F.col("together").alias("_nb"))
    similarity = F.col("together") / F.sqrt(F.col("_na").cast("double") * F.col("_nb"))
    return (
        counts.filter((F.col("a") < F.col("b")) & (F.col("together") > 0))
        .join(first, [group, "a"])
        .join(second, [group, "b"])
        .select(group, "a", "b", similarity.alias("similarity"))
    )


def item_cosine(held: DataFrame, items: DataFrame) -> DataFrame:
    """(item_a, item_b, similarity) for every pair of items with a common buyer, a < b."""
    counts = co_counts(held.withColumn("fold", F.lit(0)), "fold", items.count())
    names = _named(items)
    return (
        cosine(counts, "fold")
        .join(names.select(F.col("item").alias("a"), F.col("product_name").alias("item_a")), "a")
        .join(names.select(F.col("item").alias("b"), F.col("product_name").alias("item_b")), "b")
        .select("item_a", "item_b", "similarity")
    )


# --- scoring --------------------------------------------------------------


class _Slab:
    """Similarities of all items to those of one block, as rows sorted by item."""

    def __init__(self, frame: pd.DataFrame, first: int, width: int):
        order = np.lexsort((frame["target"].to_numpy(), frame["held"].to_numpy()))
        self.held = frame["held"].to_numpy()[order]
        self.target = frame["target"].to_numpy()[order] - first
        self.similarity = frame["similarity"].to_numpy()[order]
        self.first, self.width = first, width

    def scores(self, held: np.ndarray, ks: tuple[int, ...]) -> tuple[np.ndarray, list[np.ndarray]]:
        """The items of the block that a user does not hold, and per k the sums of their k largest similarities to held ones."""
        is_open = np.ones(self.width, dtype=bool)
        mine = held[(held >= self.first) & (held < self.first + self.width)] - self.first
        is_open[mine] = False
        best = np.zeros((0, self.width))
        for start in range(0, len(held), 1024):
            part = held[start : start + 1024]
            begin, end = np.searchsorted(self.held, part), np.searchsorted(self.held, part, side="right")
            sizes = end - begin
            places = np.arange(sizes.sum()) + np.repeat(begin - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
            near = np.zeros((len(part), self.width))
            near[np.repeat(np.arange(len(part)), sizes), self.target[places]] = self.similarity[places]
            best = -np.sort(-np.concatenate([best, near]), axis=0)[: max(ks)]
        columns = best[:, is_open]
        return np.flatnonzero(is_open).astype(np.int32) + self.first, [
            np.round(np.ascontiguousarray(columns[:k].T).sum(axis=1), SCORE_DIGITS) for k in ks
        ]


def _met(rows: DataFrame, similarity: DataFrame, n_items: int, block: int):
    """``rows`` (fold, items, ...) and slabs, grouped by slab and portion of users for ``applyInPandas``."""
    n_blocks = -(-n_items // block)
    cores = rows.sparkSession.sparkContext.defaultParallelism
    portions = max(cores, rows.count() // PORTION_USERS)
    both = similarity.select("fold", F.col("a").alias("held"), F.col("b").alias("target"), "similarity").unionByName(
        similarity.select("fold", F.col("b").alias("held"), F.col("a").alias("target"), "similarity")
    )
    slabs = both.withColumn("slab", F.floor(F.col("target") / block).cast("int")).withColumn(
        "portion", F.explode(F.sequence(F.lit(0), F.lit(portions - 1)))
    )
    dealt = rows.withColumn("slab", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).withColumn(
        "portion", F.pmod(F.xxhash64("user_id"), F.lit(portions)).cast("int")
    )
    keys = ("fold", "slab", "portion")
    return dealt.groupBy(*keys).cogroup(slabs.groupBy(*keys))


def knn_scores(
    visible: DataFrame, similarity: DataFrame, n_items: int, ks: tuple[int, ...] = (30,), block: int = BLOCK_ITEMS
) -> DataFrame:
    """(fold, user_id, k, item, score) for every item a user does not hold.

    The score is the sum of the ``k`` largest similarities to items the user
    holds. ``visible`` has fold, user_id and items; ``similarity`` is the table of
    ``cosine``. All scores are as many rows as users x items: ``top_items`` lists the
    best only.
    """

    def score(key, users: pd.DataFrame, slab: pd.DataFrame) -> pd.DataFrame:
        fold, at, _ = key
        first = at * block
        slab = _Slab(slab, first, min(block, n_items - first))
        scored = [slab.scores(np.sort(items), ks) for items in users["items"]]
        sizes = [len(items) for items, _ in scored]
        if not scored:
            return pd.DataFrame({c: [] for c in ("fold", "user_id", "k", "item", "score")})
        return pd.concat(
            pd.DataFrame(
                {
                    "fold": fold,
                    "user_id": np.repeat(users["user_id"].to_numpy(), sizes),
                    "k": k,
                    "item": np.concatenate([items for items, _ in scored]),
                    "score": np.concatenate([sums[place] for _, sums in scored]),
                }
            )
            for place, k in enumerate(ks)
        )

    rows = visible.select("fold", "user_id", "items")
    return _met(rows, similarity, n_items, block).applyInPandas(score, "fold int, user_id long, k int, item int, score double")


def _whole_similarity(held: DataFrame, n_items: int) -> tuple[DataFrame, DataFrame]:
    whole = held.withColumn("fold", F.lit(0))
    return whole, settled(cosine(co_counts(whole, "fold", n_items), "fold"), "similarity")


def user_scores(held: DataFrame, items: DataFrame, k: int = 30) -> DataFrame:
    """(user_id, product_name, score) for every catalogue item a user has not bought."""
    n_items = items.count()
    scored = knn_scores(*_whole_similarity(held, n_items), n_items, (k,))
    return scored.join(_named(items), "item").select("user_id", "product_name", "score")


def top_items(held: DataFrame, items: DataFrame, k: int = 30, top_n: int = 10, block: int = BLOCK_ITEMS) -> DataFrame:
    """(user_id, place, product_name, score): the ``top_n`` best items each user has not bought; ties go to the smaller number.

    A user gets a list of ``top_n`` from every slab, and the best of these lists; items
    of score 0 are not recommended.
    """
    n_items = items.count()

    def best(key, users: pd.DataFrame, slab: pd.DataFrame) -> pd.DataFrame:
        slab = _Slab(slab, key[1] * block, min(block, n_items - key[1] * block))
        rows = []
        for user, own in zip(users["user_id"], users["items"]):
            open_items, (sums,) = slab.scores(np.sort(own), (k,))
            rows += [(user, open_items[i], sums[i]) for i in np.lexsort((open_items, -sums))[:top_n] if sums[i] > 0]
        return pd.DataFrame(rows, columns=["user_id", "item", "score"])

    whole, similarity = _whole_similarity(held, n_items)
    lists = _met(whole.select("fold", "user_id", "items"), similarity, n_items, block).applyInPandas(
        best, "user_id long, item int, score double"
    )
    place = F.row_number().over(W.partitionBy("user_id").orderBy(F.desc("score"), "item"))
    ranked = lists.withColumn("place", place).filter(F.col("place") <= top_n)
    return ranked.join(_named(items), "item").select("user_id", "place", "product_name", "score")


# --- cross-validation -----------------------------------------------------


def holdout_folds(held: DataFrame, folds: int = 5, seed: int = 42) -> DataFrame:
    """Give each user a fold, and hide a fifth of the items (at least one) of users with two or more.

    Returns user_id, fold, items (all), visible and hidden.
    """
    fold = digest_number(seeded_digest(seed, F.lit("fold"), "user_id")) % folds + 1
    shuffled = F.array_sort(
        F.transform(
            "items",
            lambda item: F.struct(seeded_digest(seed, F.lit("hide"), "user_id", item).alias("at"), item.alias("item")),
        )
    )
    n = F.size("items")
    hide = F.when(n >= 2, F.greatest(F.lit(1), F.floor(n / 5))).otherwise(0).cast("int")
    hidden = F.transform(F.slice("_shuffled", F.lit(1), F.col("_hide")), lambda s: s["item"])
    return (
        held.withColumns({"fold": fold.cast("int"), "_shuffled": shuffled, "_hide": hide})
        .withColumn("hidden", F.sort_array(hidden))
        .withColumn("visible", F.array_except("items", "hidden"))
        .select("user_id", "fold", "items", "visible", "hidden")
    )


def fold_similarity(folded: DataFrame, n_items: int, folds: int = 5) -> DataFrame:
    """Cosine per fold, from all users, with the hidden items of that fold's users left out.

    Users are counted once with all and once with their visible items. The
    counts of a fold are then those of all users, less those of its own users,
    plus those of its own users' visible items.
    """
    versions = F.array(
        F.struct((F.col("fold") * 2).alias("part"), F.col("items")),
        F.struct((F.col("fold") * 2 + 1).alias("part"), F.col("visible").alias("items")),
    )
    counts = co_counts(folded.select(F.inline(versions)), "part", n_items)
    is_visible = F.col("part") % 2 == 1
    # From here on at most folds x items x items rows.
    per_fold = counts.groupBy(F.floor(F.col("part") / 2).cast("int").alias("fold"), "a", "b").agg(
        F.sum(F.when(~is_visible, F.col("together")).otherwise(0)).alias("_all"),
        F.sum(F.when(is_visible, F.col("together")).otherwise(0)).alias("_visible"),
    )
    everywhere = (
        per_fold.groupBy("a", "b")
        .agg(F.sum("_all").alias("_total"))
        .withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(folds))))
    )
    trained = everywhere.join(per_fold, ["fold", "a", "b"], "left").select(
        "fold",
        "a",
        "b",
        (F.col("_total") - F.coalesce("_all", F.lit(0)) + F.coalesce("_visible", F.lit(0))).alias("together"),
    )
    return cosine(trained.filter(F.col("together") > 0), "fold")


def knn_cv_counts(
    folded: DataFrame,
    n_items: int,
    ks: tuple[int, ...] = (30,),
    folds: int = 5,
    top_n: int = 10,
    block: int = BLOCK_ITEMS,
) -> DataFrame:
    """(fold, k, score, label, predicted, n): how many items not visible to their user have this outcome.

    ``label`` tells whether the item was hidden, ``predicted`` whether it is among
    the user's ``top_n`` (ties go to the smaller item number). Users are scored
    and counted slab by slab. Where a catalogue has several, each also gives the best
    items of a user, and the outcomes of the best of all are moved once these are known.
    """
    similarity = settled(fold_similarity(folded, n_items, folds), "fold-similarity")
    tested = folded.filter(F.size("hidden") > 0).select("fold", "user_id", F.col("visible").alias("items"), "hidden")
    n_blocks = -(-n_items // block)
    kinds = "fold int, k int, user_id long, item int, score double, label int, predicted int, n long"

    def count(key, users: pd.DataFrame, slab: pd.DataFrame) -> pd.DataFrame:
        fold, at, _ = key
        slab = _Slab(slab, at * block, min(block, n_items - at * block))
        outcomes: list[list] = [[] for _ in ks]
        best = []
        for user, visible, hidden in zip(users["user_id"], users["items"], users["hidden"]):
            open_items, sums = slab.scores(np.sort(visible), ks)
            label = np.isin(open_items, hidden)
            for place, (k, score) in enumerate(zip(ks, sums)):
                first = np.lexsort((open_items, -score))[:top_n]
                predicted = np.zeros(len(open_items), dtype=np.int64)
                if n_blocks == 1:
                    predicted[first] = 1
                else:
                    best += [(fold, k, user, open_items[i], score[i], int(label[i]), 0, 1) for i in first]
                outcomes[place].append(np.stack([score, 2.0 * label + predicted], axis=1))
        names = [x.split()[0] for x in kinds.split(", ")]
        rows = [pd.DataFrame(best, columns=["fold", "k", "user_id", "item", "score", "label", "predicted", "n"])] if best else []
        for k, found in zip(ks, outcomes):
            if not found:
                continue
            pairs, times = np.unique(np.concatenate(found), axis=0, return_counts=True)
            kind = pairs[:, 1].astype(np.int64)
            rows.append(
                pd.DataFrame({"score": pairs[:, 0], "label": kind // 2, "predicted": kind % 2, "n": times}).assign(fold=fold, k=k)
            )
        whole = pd.concat(rows) if rows else pd.DataFrame({c: [] for c in names})
        return whole.reindex(columns=names).astype({"user_id": "Int64", "item": "Int64"})

    counted = _met(tested, similarity, n_items, block).applyInPandas(count, kinds)
    outcome = ["fold", "k", "score", "label", "predicted"]
    if n_blocks == 1:
        return counted.groupBy(*outcome).agg(F.sum("n").alias("n"))
    counted = settled(counted, "slab-outcomes")
    place = F.row_number().over(W.partitionBy("fold", "k", "user_id").orderBy(F.desc("score"), "item"))
    chosen = counted.filter("item IS NOT NULL").withColumn("_place", place).filter(F.col("_place") <= top_n)
    moved = F.array(F.struct(F.lit(0).alias("predicted"), F.lit(-1).alias("n")), F.struct(F.lit(1).alias("predicted"), F.lit(1).alias("n")))
    shifts = chosen.select("fold", "k", "score", "label", F.inline(moved))
    return (
        counted.filter("item IS NULL")
        .select(*outcome, "n")
        .unionByName(shifts.select(*outcome, F.col("n").cast("long").alias("n")))
        .groupBy(*outcome)
        .agg(F.sum("n").alias("n"))
        .filter("n > 0")
    )


def knn_cv_metrics(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1, accuracy and AUC per fold."""
    return confusion_metrics(counts, ["fold"]).join(roc_auc(counts, ["fold"]), ["fold"])


def knn_summary(per_fold: DataFrame) -> DataFrame:
    """The mean of each metric over the folds."""
    return per_fold.agg(*[F.mean(m).alias(m) for m in ("precision", "recall", "f1", "accuracy", "auc")])


def knn_k_sweep(folded: DataFrame, n_items: int, ks: tuple[int, ...] = (10, 20, 30, 40, 50)) -> DataFrame:
    """Users, precision and recall among the top ten for several k."""
    counts = knn_cv_counts(folded, n_items, ks)
    users = folded.filter(F.size("hidden") > 0).count()
    hits = F.sum(F.col("label") * F.col("predicted") * F.col("n"))
    return counts.groupBy("k").agg(
        F.lit(users).cast("long").alias("users"),
        ratio(hits, F.sum(F.col("predicted") * F.col("n"))).alias("precision"),
        ratio(hits, F.sum(F.col("label") * F.col("n"))).alias("recall"),
    )


def run_knn_recommender(
    df: DataFrame, users: int | None = None, products: int = 200, bought: tuple[DataFrame, DataFrame] | None = None
) -> DataFrame:
    """Mean metrics of five-fold cross-validation. ``bought``: the catalogue and ``bought_items``, where they are stored."""
    items = bought[0] if bought else catalogue(df, products)
    held = drawn_users(bought[1] if bought else bought_items(df, items), 5, users)
    folded = settled(holdout_folds(held), "folds", "user_id")
    return knn_summary(knn_cv_metrics(settled(knn_cv_counts(folded, items.count()), "counts")))
