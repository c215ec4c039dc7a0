"""Exact dedup, the Jaccard join and mixing against plain Python."""

import collections
import random
import re

import pytest
from brute import WHITE, exact_groups, near_duplicates, odd_documents

from trolley.llm import exact_dedup, jaccard_join, mixing

BITS = [64, 6]


def random_documents(spark, n=300, seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 80))) for _ in range(n // 3)]
    for _ in range(n // 3):
        copy = rng.choice(texts).split(" ")
        for _ in range(rng.randrange(3)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        texts.append(("  " if rng.random() < 0.3 else " ").join(copy))
    texts += [rng.choice(texts) for _ in range(n - len(texts))]
    rows = [(i, t, "en", f"s{i % 7}" if i % 10 else None, 0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), rows


# A short hash makes different texts collide, so that chains are followed.
@pytest.mark.parametrize("bits", BITS)
def test_exact_duplicates(spark, bits):
    docs, rows = random_documents(spark)
    found = {r["doc_id"]: r for r in exact_dedup.exact_duplicates(docs, capacity=16, hash_bits=bits).collect()}
    assert len(found) == len(rows)
    for (doc_id, *_), (keep, size) in zip(rows, exact_groups([(r[0], r[1]) for r in rows])):
        assert (found[doc_id]["keep_id"], found[doc_id]["group_size"]) == (keep, size)
        assert found[doc_id]["kept"] == (doc_id == keep)


@pytest.mark.parametrize("bits", BITS)
def test_exact_duplicates_of_odd_rows(spark, bits):
    docs = odd_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_duplicates(docs, hash_bits=bits).collect()]
    wanted = [(i, k, n, i == k) for (i, _), (k, n) in zip(rows, exact_groups(rows))]
    assert collections.Counter(found) == collections.Counter(wanted)
    left = exact_dedup.drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(WHITE.sub("", r["text"] or "") for r in left.collect()) == sorted({WHITE.sub("", t or "") for _, t in rows})
    assert exact_dedup.exact_duplicates(docs.limit(0)).count() == 0
    assert exact_dedup.drop_exact_duplicates(docs.limit(0)).count() == 0


def test_directory_splits_overfull_buckets(spark):
    keys = spark.range(5000).selectExpr("xxhash64(id) AS _key")
    directory = exact_dedup.build_directory(keys, capacity=100)
    rows = directory.collect()
    assert sum(r["n_keys"] for r in rows) == 5000
    assert max(r["n_keys"] for r in rows) <= 100
    placed = exact_dedup.with_bucket(keys, directory).groupBy("bucket").count().collect()
    assert sorted(r["count"] for r in placed) == sorted(r["n_keys"] for r in rows)


def test_jaccard_join(spark):
    docs, rows = random_documents(spark, 400, seed=2)
    found = {r["doc_id"]: r for r in jaccard_join.jaccard_join(docs, block=8).collect()}
    for (doc_id, *_), wanted in zip(rows, near_duplicates([(r[0], r[1]) for r in rows])):
        assert (found[doc_id]["class_id"], found[doc_id]["n_links"]) == wanted


def test_jaccard_join_of_one_large_group(spark):
    rng = random.Random(4)
    base = [f"v{i}" for i in range(300)]
    texts = []
    for i in range(150):
        words = list(base)
        words[rng.randrange(300)] = f"x{i}"
        texts.append((i, " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = jaccard_join.jaccard_join(docs, block=16).collect()
    assert {(r["class_id"], r["n_links"]) for r in found} == {(0, 149)}
    assert jaccard_join.one_per_class(docs).count() == 1


def test_jaccard_join_of_odd_rows(spark):
    docs = odd_documents(spark)
    found = {(r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard_join.jaccard_join(docs).collect()}
    assert {f for f in found if f[0] == 3} == {(3, 3, 2)}
    assert {f for f in found if f[0] in (4, 5, 6)} == {(4, 4, 2), (5, 4, 2), (6, 4, 2)}
    assert {f for f in found if f[0] in (0, 1, 2)} == {(0, 0, 0), (1, 1, 0), (2, 2, 0)}
    left = jaccard_join.one_per_class(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect() if r["doc_id"] is not None) == [0, 1, 2, 3, 4, 7, 8, 9]
    assert jaccard_join.jaccard_join(docs.limit(0)).count() == 0


def test_prefix_is_shortened_until_the_target():
    assert jaccard_join.prefix_length(0.8, 40, 10, 0.5) > jaccard_join.prefix_length(0.8, 40, 10, 0.9999)
    with pytest.raises(ValueError):
        jaccard_join.prefix_length(0.1, 2, 10, 0.999)


def test_targets_stop_at_three_times_the_source():
    targets = mixing.source_targets({"a": 10, "b": 1000, "c": 1000, None: 500})
    assert targets["a"] == 30
    assert abs(sum(targets.values()) - 2510) < 1e-6
    assert abs(targets["b"] / targets["c"] - 2) < 1e-9
    assert targets[None] == 1500  # null comes last, so its weight is the first again: 5
    assert mixing.source_targets({}) == {} and mixing.source_targets({"a": 0}) == {"a": 0.0}


@pytest.mark.parametrize("slots", [1 << 17, 50])
def test_mix_against_walking_the_schedule(spark, slots):
    docs, rows = random_documents(spark, 200, seed=3)
    found = {r["doc_id"]: r for r in mixing.mix_sources(docs, slots=slots).collect()}
    sizes = {r[0]: len(re.findall(r"[^\x20\x09-\x0D]+", r[1])) for r in rows}
    total = sum(sizes.values())
    block = min(max(total // slots, 1), mixing.MAX_BLOCK)
    per_source = collections.Counter()
    for r in rows:
        per_source[r[3]] += sizes[r[0]]
    targets = mixing.source_targets(dict(per_source))
    ordered = sorted(per_source, key=lambda s: (s is None, s or ""))
    edges, at = [], 0.0
    for s in ordered:
        at += targets[s]
        edges.append(at / total)
    # One slot after the other, one word after the other.
    import hashlib

    stream = {
        s: [r[0] for r in sorted((r for r in rows if r[3] == s), key=lambda r: hashlib.md5(f"mix|{r[0]}".encode()).hexdigest()) for _ in range(sizes[r[0]])]
        for s in ordered
    }
    taken, reached = collections.Counter(), collections.Counter()
    for slot in range(-(-total // block)):
        point = ((slot + 1) * mixing.GOLDEN % 2**64) / 2.0**64
        source = next((s for s, e in zip(ordered, edges) if point < e), ordered[-1])
        for _ in range(block):
            if reached[source] < 3 * per_source[source]:
                taken[stream[source][reached[source] % per_source[source]]] += 1
                reached[source] += 1
    for r in rows:
        row = found[r[0]]
        assert (row["size"], row["source_size"], row["taken"]) == (sizes[r[0]], per_source[r[3]], taken[r[0]])
        assert abs(row["target"] - targets[r[3]]) < 1e-6
    for s in ordered:
        assert abs(sum(found[r[0]]["taken"] for r in rows if r[3] == s) - targets[s]) <= 8 * block


# Wherever the small source stands among the sources, and whatever its size.
@pytest.mark.parametrize("name, words", [("a", 1), ("m", 300), (None, 900)])
def test_mix_of_a_small_source_beside_blocks_of_2048(spark, name, words):
    large = [(i, "w " * 4096, f"{'bn'[i % 2]}") for i in range(50)]
    small = [(100 + i, "v " * min(100, words - 100 * i), name) for i in range(-(-words // 100))]
    docs = spark.createDataFrame(large + small, "doc_id long, text string, source string")
    found = mixing.mix_sources(docs, slots=100).collect()
    assert min((50 * 4096 + words) // 100, mixing.MAX_BLOCK) == 2048
    mine = [r for r in found if r["doc_id"] >= 100]
    target = mixing.source_targets({"b": 25 * 4096, "n": 25 * 4096, name: words})[name]
    assert target == 3 * words and sum(r["taken"] for r in mine) == target
    assert all(r["taken"] == 3 * r["size"] for r in mine)
    mixed = mixing.mixed_documents(docs, slots=100)
    assert mixed.filter("doc_id >= 100").count() == 3 * len(small)


@pytest.mark.parametrize("total", [85_000_000, 5_000_000_000])
def test_counts_of_sources_at_large_totals(total):
    block = min(max(total // mixing.SLOTS, 1), mixing.MAX_BLOCK)
    n_slots = -(-total // block)
    for small in (150, 600, 3000, 10_000, 3_000_000, 300 * block, 3000 * block):
        for share in (0.123, 0.789):
            before = (total - small) * share
            targets = {"a": before, "b": small, "c": total - small - before}
            quotas = mixing.counted_out(targets, block)
            if "b" in quotas:
                assert quotas["b"] == small
                continue
            place = mixing.slot_sources(n_slots, block, list(targets.values()))
            chunks = mixing.pd.DataFrame({"chunk": range(-(-n_slots // mixing.SLOT_CHUNK))})
            got = sum(int((f["src"] == 1).sum()) for f in place([chunks])) * block
            assert abs(got - small) <= 0.01 * small


def test_mix_of_odd_rows(spark):
    docs = odd_documents(spark)
    found = mixing.mix_sources(docs).collect()
    assert len(found) == docs.count()
    assert all(r["taken"] <= 3 * r["size"] for r in found)
    again = mixing.mix_sources(docs.repartition(7)).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() > 0
    assert mixing.mix_sources(docs.limit(0)).count() == 0
    assert mixing.mixed_documents(docs.filter("text IS NULL")).count() == 0
