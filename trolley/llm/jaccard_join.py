"""Near-duplicate documents by min-hash banding, verified exactly.

Each document is the set of its word 5-grams. Documents that share the key of
some band (here called a tree) of min-hashes are candidates. All bands have one
length, the longest, up to a depth, that a pair at the similarity threshold
shares in some band with the target probability. This is the length at which an
LSH forest would stop for such a pair; there are no tries, and no prefix is
shortened by what it has matched, as all pairs above the threshold are sought
and not a number of nearest ones.

Candidates are gathered into components, whose sets are then compared exactly,
in square cells of bounded size: no pair is ever written, however large a group
of near copies is. Documents with equal sets are one class and are compared once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import (
    WordCodes,
    key_filter,
    key_mask,
    maybe_among,
    mixed,
    new_names,
    passes,
    passing_items,
    release_memory,
    short_batches,
)
from trolley.sources.storage import discard, settled

SHINGLE = 5
THRESHOLD = 0.8
TREES = 40
DEPTH = 10
TARGET_RECALL = 0.9999
BLOCK = 64
BLOCK_SHINGLES = 1 << 19  # 4 MB of hashes
SPACES = " \t\n\x0b\x0c\r"


def prefix_length(threshold: float, trees: int, depth: int, target: float) -> int:
    """The longest prefix, of ``depth`` at most, that a pair at the threshold shares with the target probability."""
    for length in range(depth, 0, -1):
        if 1 - (1 - threshold**length) ** trees >= target:
            return length
    raise ValueError("the target recall needs more trees")


def shingle_set(text: str | None, hashes: dict[str, int] | None = None) -> np.ndarray:
    """Sorted 64-bit hashes of the word 5-grams of a text; a shorter text is one shingle, no words give none."""
    hashes = WordCodes() if hashes is None else hashes
    # Only ASCII white space parts words.
    words = [w for w in (text or "").translate(_TO_SPACE).split(" ") if w]
    if not words:
        return np.zeros(0, dtype=np.uint64)
    codes = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(SHINGLE, len(words))
    grams = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        grams = mixed(grams) + codes[k : k + len(grams)]
    return np.unique(mixed(grams))


_TO_SPACE = {ord(c): " " for c in SPACES}


def set_digest(shingles: np.ndarray) -> bytes:
    """16 bytes that tell sets apart."""
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _hash_functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(20240229))
    return (
        rng.integers(0, 1 << 32, count, dtype=np.uint32)[:, None],
        (rng.integers(0, 1 << 32, count, dtype=np.uint32) | np.uint32(1))[:, None],
    )


def prefix_keys(shingles: np.ndarray, functions, trees: int, length: int) -> np.ndarray:
    """One key per tree: the first ``length`` min-hashes of the tree's signature and the tree's number."""
    flips, factors = functions
    low = ((shingles >> np.uint64(32)) ^ (shingles & np.uint64(0xFFFFFFFF))).astype(np.uint32)
    least = np.full(len(flips), 0xFFFFFFFF, dtype=np.uint32)
    for start in range(0, len(low), 2048):
        np.minimum(least, ((low[start : start + 2048] ^ flips) * factors).min(axis=1), out=least)
    keys = np.arange(1, trees + 1, dtype=np.uint64)
    for level in least.reshape(trees, length).T:
        keys = mixed(keys) + level.astype(np.uint64)
    return mixed(keys).view(np.int64)


def _signatures(trees: int, length: int):
    functions = _hash_functions(trees * length)

    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hashes = WordCodes()
        for texts in batches:
            rows = []
            for text in texts:
                shingles = shingle_set(text, hashes)
                if len(shingles):
                    digest = set_digest(shingles)
                    head = int.from_bytes(digest[:8], "big", signed=True)
                    rows.append((digest, head, len(shingles), prefix_keys(shingles, functions, trees, length)))
                else:
                    rows.append((None, None, None, None))
            yield pd.DataFrame(rows, columns=["digest", "head", "size", "keys"]).astype({"head": "Int64", "size": "Int64"})
        hashes.clear()
        release_memory()

    return F.pandas_udf(sign, "digest binary, head long, size long, keys array<long>")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the graph of ``edges`` (a, b).

    Returns (node, component), where the component is its least node. Labels
    move along edges and then jump to the label of their label, so the number of
    rounds follows the logarithm of the longest path.
    """
    edges = settled(
        edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).filter("a <> b").distinct(), "edges"
    )
    labels = settled(edges.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    while True:
        near = settled(
            edges.join(labels, edges["b"] == labels["node"])
            .groupBy(edges["a"].alias("at"))
            .agg(F.min("label").alias("near")),
            "near-labels",
        )
        moved = settled(
            labels.join(near, labels["node"] == near["at"]).select("node", "label", F.least("label", "near").alias("next")),
            "moved-labels",
        )
        ahead = moved.select(F.col("node").alias("at"), F.col("next").alias("ahead"))
        jumped = settled(
            moved.join(ahead, moved["next"] == ahead["at"]).select(
                "node", F.col("ahead").alias("label"), (F.col("ahead") != F.col("label")).alias("changed")
            ),
            "jumped-labels",
        )
        discard(labels, near, moved)
        labels = jumped
        if jumped.filter("changed").isEmpty():
            discard(edges)
            return labels.select("node", F.col("label").alias("component"))


def _links(keys: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which of left x right share a key and have a Jaccard similarity of the threshold or more."""
    shared = np.zeros((len(left), len(right)), dtype=bool)
    for tree in keys.T:
        shared |= tree[left][:, None] == tree[right][None, :]
    shared &= left[:, None] != right[None, :]
    sizes = np.array([len(s) for s in sets])
    least, most = np.minimum.outer(sizes[left], sizes[right]), np.maximum.outer(sizes[left], sizes[right])
    shared &= least >= threshold * most - 1e-9
    pairs = np.argwhere(shared)
    common = np.zeros(shared.shape)
    if len(pairs) <= 4 * len(sets):
        for i, j in pairs:
            common[i, j] = len(np.intersect1d(sets[left[i]], sets[right[j]], assume_unique=True))
    else:
        owner = np.repeat(np.arange(len(sets)), sizes)
        values, place, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        several = counts[place] > 1
        owner, place = owner[several], (np.cumsum(counts > 1) - 1)[place[several]]
        order = np.argsort(place, kind="stable")
        owner, place = owner[order], place[order]
        width = 4096
        for start in range(0, int(place[-1]) + 1 if len(place) else 0, width):
            a, b = np.searchsorted(place, [start, start + width])
            has = np.zeros((len(sets), width), dtype=np.float32)
            has[owner[a:b], place[a:b] - start] = 1
            common += has[left] @ has[right].T
    # The same numbers as common / union >= threshold, without dividing.
    union = sizes[left][:, None] + sizes[right][None, :] - common
    return shared & (common >= threshold * union - 1e-9)


def _verified(threshold: float):
    def verify(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("digest").reset_index(drop=True)
        low, high = frame["low"].iloc[0], frame["high"].iloc[0]
        left = np.flatnonzero(frame["block"] == low)
        right = np.flatnonzero(frame["block"] == high)
        keys = np.stack(frame["keys"].to_numpy())
        sets = [np.frombuffer(s, dtype=np.uint64) for s in frame["shingles"]]
        weights = frame["rows"].to_numpy()
        linked = _links(keys, sets, left, right, threshold)
        links = np.zeros(len(frame), dtype=np.int64)
        links[left] += linked @ weights[right]
        if low != high:
            links[right] += linked.T @ weights[left]
        label = np.arange(len(frame))
        near = np.zeros((len(frame), len(frame)), dtype=bool)
        near[np.ix_(left, right)] = linked
        near |= near.T
        while True:
            reach = np.where(near, label[None, :], len(frame)).min(axis=1, initial=len(frame))
            lower = np.minimum(label, reach)
            lower = lower[lower]
            if (lower == label).all():
                break
            label = lower
        found = links > 0
        digests = frame["digest"].to_numpy()
        if len(frame) > BLOCK:
            release_memory()
        return pd.DataFrame({"digest": digests[found], "links": links[found], "label": digests[label[found]]})

    return verify


def jaccard_join(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    trees: int = TREES,
    depth: int = DEPTH,
    target_recall: float = TARGET_RECALL,
    block: int = BLOCK,
) -> DataFrame:
    """Near-duplicate classes of documents and the number of links of each.

    Returns one row per row of ``docs``: doc_id, class_id, n_links, same_as. Two
    documents are linked if the Jaccard similarity of their sets of word 5-grams
    is ``threshold`` or more. ``n_links`` counts the other rows that a row is
    linked to; ``class_id`` is the smallest doc_id that can be reached by links;
    ``same_as`` is the smallest doc_id with an equal set. A text of fewer than
    five words is one shingle; null texts, and texts without words, have no
    links, and their class is their own id. Rows that repeat a doc_id count as
    documents of their own. An empty table gives no rows. Other columns are
    ignored. 64-bit hashes stand for the shingles.
    """
    short_batches(docs.sparkSession)
    length = prefix_length(threshold, trees, depth, target_recall)
    sign = _signatures(trees, length)
    signed = settled(
        docs.select(F.col("doc_id").alias("doc_id"), sign(F.col("text")).alias("s")).select("doc_id", "s.*"), "signatures"
    )

    # Buckets of the forest with two different sets or more; the least member is the centre.
    leaves = signed.filter("head IS NOT NULL").select("head", F.explode("keys").alias("key"))
    buckets = settled(
        leaves.groupBy("key")
        .agg(F.min("head").alias("centre"), F.max("head").alias("last"))
        .filter("centre <> last")
        .select(F.col("key").alias("bucket"), "centre"),
        "buckets",
    )
    # Most keys are in no such bucket, which a filter tells without a shuffle.
    hits = signed.filter("head IS NOT NULL").select(
        "head", F.explode(passing_items(key_filter(buckets, "bucket"))(F.col("keys"))).alias("key")
    )
    # The centres of a set are joined to the least of them, and the set to that one only.
    centres = settled(
        hits.join(buckets, hits["key"] == buckets["bucket"])
        .groupBy("head")
        .agg(F.collect_set("centre").alias("centres"))
        .select("head", "centres", F.array_min("centres").alias("least")),
        "centres",
    )
    # What follows needs the ids and digests only.
    ids = settled(signed.select("doc_id", "digest", "head", "size"), "ids")
    discard(signed, buckets)
    spokes = centres.select(F.col("head").alias("a"), F.col("least").alias("b")).union(
        centres.select(F.explode("centres"), "least").distinct()
    )
    gathered = components(spokes)
    discard(centres)

    # The sets of candidates, one row per class of equal sets.
    classes = settled(
        ids.filter("head IS NOT NULL")
        .groupBy("digest", "head", "size")
        .agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("rows")),
        "set-classes",
    )
    members = settled(classes.join(gathered, classes["head"] == gathered["node"]).drop("node", "head"), "members")
    repeated = not ids.filter("head IS NOT NULL").groupBy("doc_id").count().filter("count > 1").isEmpty()
    sets = settled(_sets_of(docs, members, trees, length, repeated), "candidate-sets")
    by_count, by_size = F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum("size") / BLOCK_SHINGLES)
    sizes = settled(
        members.groupBy(F.col("component").alias("whole")).agg(F.greatest(by_count, by_size).cast("int").alias("blocks")),
        "component-sizes",
    )
    cells = (
        sets.join(sizes, sets["component"] == sizes["whole"])
        .withColumn("block", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "component",
            F.least("block", "with").alias("low"),
            F.greatest("block", "with").alias("high"),
            "block",
            "digest",
            "rows",
            "keys",
            "shingles",
        )
    )
    links = settled(
        cells.groupBy("component", "low", "high").applyInPandas(
            _verified(threshold), "digest binary, links long, label binary"
        ),
        "links",
    )
    discard(sets, sizes, members)
    joined = components(links.select(F.col("digest").alias("a"), F.col("label").alias("b")))
    counted = links.groupBy("digest").agg(F.sum("links").alias("links"))
    facts = settled(
        classes.join(counted, "digest", "left")
        .join(joined, classes["digest"] == joined["node"], "left")
        .select(
            "digest",
            "first_id",
            (F.col("rows") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "digest").alias("component"),
        ),
        "class-facts",
    )
    firsts = settled(
        facts.groupBy(F.col("component").alias("whole")).agg(F.min("first_id").alias("class_id")), "class-firsts"
    )
    named = settled(
        facts.join(firsts, facts["component"] == firsts["whole"]).select(
            F.col("digest").alias("of"), "class_id", "n_links", F.col("first_id").alias("same_as")
        ),
        "class-names",
    )
    discard(classes, links, facts, firsts)
    known = F.col("of").isNotNull()
    return ids.join(named, ids["digest"] == named["of"], "left").select(
        "doc_id",
        F.when(known, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(known, F.col("same_as")).otherwise(F.col("doc_id")).alias("same_as"),
    )


def _sets_of(docs: DataFrame, members: DataFrame, trees: int, length: int, repeated: bool) -> DataFrame:
    """Shingles and keys of one document of each member class, made again from its text.

    Only where ids are ``repeated`` may a class come up more than once.
    """
    functions = _hash_functions(trees * length)

    def make(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordCodes()
        for frame in frames:
            rows = []
            for text, digest, component, count in zip(
                frame["text"], frame["digest"], frame["component"], frame["rows"], strict=True
            ):
                shingles = shingle_set(text, hashes)
                # Another text may carry the same id.
                if set_digest(shingles) == bytes(digest):
                    rows.append(
                        (component, digest, count, prefix_keys(shingles, functions, trees, length), shingles.tobytes())
                    )
            yield pd.DataFrame(rows, columns=["component", "digest", "rows", "keys", "shingles"])
        hashes.clear()
        release_memory()

    texts = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    wanted = key_filter(members.select(F.xxhash64("first_id").alias("id_hash")), "id_hash")
    texts = texts.filter(passes(wanted)(F.xxhash64("doc_id")))
    chosen = texts.join(members, texts["doc_id"].eqNullSafe(members["first_id"])).select(
        "text", "digest", "component", "rows"
    )
    made = chosen.mapInPandas(make, "component long, digest binary, rows long, keys array<long>, shingles binary")
    return made.dropDuplicates(["digest"]) if repeated else made


def one_per_class(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row left of each near-duplicate class, all columns unchanged.

    The row with the class's smallest doc_id stays. Of rows that repeat this id,
    those with equal texts are one row and the first text in order stays.
    """
    key, n, maybe = new_names(docs, "key", "n", "maybe")
    joined = settled(jaccard_join(docs, **options), "near-duplicates")
    stays = F.col("doc_id").eqNullSafe(F.col("class_id"))
    # Ids of which a row goes, or which repeat; rows of other ids stay where they lie.
    open_ids = joined.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.bool_and(stays).alias("all"))
    mask = settled(key_mask(open_ids.filter("n > 1 OR NOT all"), "doc_id"), "near-duplicates-mask")
    marked = maybe_among(docs, F.col("doc_id"), mask, maybe)
    kept = settled(
        maybe_among(joined.filter(stays), F.col("doc_id"), mask, "maybe")
        .filter("maybe")
        .groupBy(F.col("doc_id").alias(key))
        .agg(F.count(F.lit(1)).alias(n)),
        "near-duplicates-kept",
    )
    discard(joined)
    alone = marked.filter(~F.col(maybe)).select(*docs.columns)
    left = marked.filter(maybe).join(kept, F.col("doc_id").eqNullSafe(F.col(key)))
    once = left.filter(F.col(n) == 1).select(*docs.columns)
    if kept.filter(F.col(n) > 1).isEmpty():
        return alone.unionByName(once)
    again = left.filter(F.col(n) > 1).dropDuplicates([key, "text"]).select(*docs.columns)
    return alone.unionByName(once).unionByName(again)
