"""Top-k search and WARC archives against plain Python."""

import collections
import gzip
import hashlib
import math
import random

import numpy as np
import pytest

from trolley.llm import top_k, warc
from trolley.sources.storage import new_shared_folder


def vectors(spark, n=300, dims=12, seed=1, spread=1.0):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, spread) for _ in range(dims)]) for i in range(n)]
    rows += [(n + i, rows[i][1]) for i in range(20)]  # ties
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>"), rows


def brute_top_k(rows, wanted, k):
    whole = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    found = {}
    for q in wanted:
        scores = sorted(((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q))[:k]
        found |= {(q, rank): (i, -s) for rank, (s, i) in enumerate(scores, 1)}
    return found


# Small shards and blocks; components beyond what doubles can add exactly.
@pytest.mark.parametrize("shard,block,spread", [(64, 4, 1.0), (8192, 2048, 1.0), (100, 8, 3e6)])
def test_top_k(spark, shard, block, spread):
    table, rows = vectors(spark, spread=spread)
    whole = top_k.whole_components(table)
    found = top_k.top_k(whole, whole.filter("vec_id % 50 = 0"), 5, shard, block).collect()
    assert {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in found} == brute_top_k(rows, range(0, 320, 50), 5)


def test_search_stops_early_when_the_bound_allows():
    rng = np.random.default_rng(3)
    rows = np.floor(rng.normal(0, 10, (20_000, 2)))
    rows[:10] = 1000
    lists = top_k.SortedLists(np.arange(len(rows)), rows)
    _, scores, depth = lists.search(np.array([5.0, 3.0]), -1, 5)
    assert depth < len(rows) // 10
    assert scores.tolist() == sorted((rows @ [5, 3]).tolist(), reverse=True)[:5]


def test_top_k_of_odd_rows(spark):
    rows = [
        (0, [1.0, 0.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]),
        (5, [1.0]), (6, []), (7, [1.0, 0.0]), (None, [1.0, 1.0]), (50, [0.0, 0.0]), (100, None),
    ]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int")
    whole = top_k.whole_components(table)
    found = top_k.top_k(whole, whole.filter("vec_id % 50 = 0"), 5).collect()
    by_query = collections.defaultdict(list)
    for r in sorted(found, key=lambda r: r["rank"]):
        by_query[r["query_id"]].append((r["vec_id"], r["score"]))
    assert by_query[0] == [(5, 65536), (7, 65536), (6, 0), (50, 0)]
    assert by_query[50] == [(0, 0), (5, 0), (6, 0), (7, 0)]
    assert set(by_query) == {0, 50}
    assert top_k.top_k(whole.limit(0), whole.limit(0), 5).count() == 0


def pages(spark):
    rows = [(i, f"https://www{i % 3}.Example.com:443/a/{i}?q=1#x", f"<p>page {i % 40}</p>" * 20) for i in range(200)]
    rows += [
        (200, None, "no url " * 30), (201, "", "short"), (202, "http://x.org", "short"), (203, "http://x.org", None),
        (204, "http://x.org/ü ?\r\nSet: 1", "ünïcode 日本 🙂\r\n\r\n" * 30), (None, "http://n.org", "<p>page 1</p>" * 20),
        (205, "http://long.org", "y" * 2_000_000), (7, "https://www1.Example.com:443/a/7?q=1#x", "<p>page 7</p>" * 20),
    ]
    return spark.createDataFrame([(*r, "d", 5) for r in rows], "page_id long, url string, html string, digest string, offset int"), rows


def wanted_records(rows):
    first = {}
    for page_id, _, html in rows:
        if page_id is not None:
            first[html or ""] = min(first.get(html or "", page_id), page_id)
    found = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        revisit = len(data) >= 100 and page_id != first.get(html or "", page_id)
        found.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first[html or ""] if revisit else None))
    return found


def test_archives_round_trip(spark):
    table, rows = pages(spark)
    found = [tuple(r) for r in warc.archived(table).collect()]
    assert collections.Counter(found) == collections.Counter(wanted_records(rows))
    assert warc.archived(table.limit(0)).count() == 0


def test_payloads_and_look_up(spark):
    table, rows = pages(spark)
    folder = new_shared_folder(spark, "test-archives")
    captures = warc.write_archives(table, folder)
    index = warc.build_index(captures, new_shared_folder(spark, "test-index"), block_captures=7)
    asked = spark.createDataFrame([(rows[5][1], 5), ("http://x.org", 203), ("http://never.org/", 5), (None, 200)], "url string, page_id long")
    hits = warc.look_up(index, asked)
    assert sorted(r["page_id"] for r in hits.collect()) == [5, 200, 203]
    read = {r["page_id"]: r for r in warc.read_records(hits, folder, with_payload=True).collect()}
    assert bytes(read[5]["payload"]).decode() == rows[5][2] and bytes(read[203]["payload"]) == b""
    # Any gzip reader can read the whole archive.
    name = captures.filter("page_id = 5").first()["file"]
    path = folder.removeprefix("file://") + "/" + name
    data = gzip.open(path).read()
    assert data.startswith(b"WARC/1.1\r\n") and data.count(b"WARC/1.1\r\nWARC-Type: ") == captures.filter(captures["file"] == name).count()


def test_every_capture_is_found_by_binary_search(spark):
    table, _ = pages(spark)
    captures = warc.write_archives(table, new_shared_folder(spark, "test-archives"))
    for size in (1, 3, 1000):
        index = warc.build_index(captures, new_shared_folder(spark, "test-index"), block_captures=size)
        assert warc.look_up(index, table).count() == table.count()


def test_url_keys(spark):
    urls = ["http://WWW.Example.COM/A?b=C#d", "https://user@a.b.org:443/x", "http://a.b.org:8080", "", None]
    keys = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").select(warc.url_key(warc.F.col("u"))).collect()]
    assert keys == ["com,example,www)/A?b=C", "org,b,a)/x", "org:8080,b,a)", "", ""]


def test_damaged_record():
    data = warc.record(1, "http://a/", b"payload", hashlib.sha256(b"payload").hexdigest(), None)
    assert warc.parse_record(data)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse_record(data.replace(b"payload", b"PAYLOAD"))
