"""Fill-in-middle, quality rules and phrase mining, against plain Python."""

import collections
import hashlib
import math
import random
import re

import pytest
from brute import odd_documents
from frames import bag
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trolley.llm import fim, phrases, quality_rules

SF = "/root/testdata/sf0.001"
TYPES = "doc_id long, text string, lang string"


def example(doc_id, text):
    """(n, form, output) from the whole token list."""
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    low, high = sorted((h[0] % (len(tokens) + 1), h[1] % (len(tokens) + 1)))
    a, b, c = "".join(tokens[:low]), "".join(tokens[low:high]), "".join(tokens[high:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(tokens), "plain", None, None, text
    output = f"<S>{c}<P>{a}<M>{b}" if h[3] % 100 < 20 else f"<P>{a}<S>{c}<M>{b}"
    return len(tokens), "spm" if h[3] % 100 < 20 else "psm", len(a), len(b), output


def test_examples_follow_the_token_list(spark):
    rng = random.Random(3)
    shared = "".join(rng.choice(["word", " ", "é", "x1", "\n", "日本", "🙂", "LongerWordHere"]) for _ in range(3000))
    texts = [shared, "abc" + shared, shared[:700] + "?" + shared[700:], "a" * 30_000, "é" * 9_000, "<P> in it", "<", "<P", "S>"]
    rows = [(i, t, "en") for i, t in enumerate(texts * 3)]
    docs = spark.createDataFrame(rows, TYPES).unionByName(odd_documents(spark, extra=False).select("doc_id", "text", "lang"))
    found = fim.fill_in_middle(docs).withColumn("back", fim.restored(F.col("output"), F.col("form")))
    expected = collections.Counter(
        (r.doc_id, *example(r.doc_id, r.text), r.text or "") for r in docs.collect()
    )
    assert bag(found, "doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "back") == expected
    assert {r.form for r in found.collect()} == {"plain", "psm", "spm"}


def test_examples_of_clashing_and_empty_tables(spark):
    odd = odd_documents(spark)
    assert fim.fill_in_middle(odd.limit(0)).count() == 0
    clashing = odd.withColumn("n", F.lit(1)).withColumn("form", F.lit("x")).withColumn("third", F.lit(2)).withColumn("at", F.lit(0))
    assert bag(fim.fill_in_middle(clashing)) == bag(fim.fill_in_middle(odd))


@settings(deadline=None)
@given(st.lists(st.sampled_from(["word", "W", " ", "é", "日", "<", "🙂", "\n", "x" * 70, "ab " * 100]), max_size=60))
def test_cuts_from_chunks_equal_cuts_from_tokens(parts):
    text = "".join(parts)
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    cut = fim.Cutter(text.encode(), fim.ChunkCounts(bound=2000))
    assert cut.n == len(tokens)
    ends = [0]
    for t in tokens:
        ends.append(ends[-1] + len(t))
    some = range(0, len(tokens) + 1, 1 + len(tokens) // 200)
    assert [cut.points_before(i) for i in some] == [ends[i] for i in some]


def test_shared_passages_are_counted_once():
    rng = random.Random(5)
    shared = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(4000)).encode()
    counts = fim.ChunkCounts()
    fim.Cutter(shared, counts)
    first = counts.counted
    for lead in (b"x", b"some other words before ", b"\xc3\xa9" * 77):
        fim.Cutter(lead + shared, counts)
    assert first > 20
    assert counts.counted - first <= 3 * 4  # only chunks next to what is new


def slow_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {i + j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(8)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(inside),
        len(lines),
        sum("A" <= c <= "Z" for c in text),
        sum(c.isascii() and c.isalpha() for c in text),
        sum(c in "!?" for c in text),
    )


@settings(deadline=None)
@given(
    st.lists(st.sampled_from(["a", "b", "é", "\n", " ", "\t", "#", "Q!", "日本", "\x0b", " ", "same line\n"]), max_size=80),
    st.integers(1, 3),
)
def test_measures_equal_plain_counts(parts, times):
    text = " ".join(parts * times)
    assert quality_rules.measures(text.encode()) == slow_measures(text)


def test_measures_of_odd_documents(spark):
    odd = odd_documents(spark)
    found = quality_rules.measured(odd).select("doc_id", *quality_rules.BASE, *quality_rules.MORE)
    assert bag(found) == collections.Counter((r.doc_id, *slow_measures(r.text)) for r in odd.collect())


def exact_chance(k, n, p):
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


@pytest.mark.parametrize("k,n,p", [(0, 10, 0.02), (3, 200, 0.02), (40, 300, 0.1), (5, 5, 0.3), (0, 0, 0.1), (90, 1000, 0.1)])
def test_binomial_chances(k, n, p):
    assert quality_rules.chance_of_at_most(k, n, p) == pytest.approx(min(1.0, exact_chance(k, n, p)), rel=1e-9)


def graded(level, i):
    """A text whose share of symbols reaches the given policy first (none for 0)."""
    cutoffs = quality_rules.CUTOFFS["symbols"]
    words = [f"w{i}x{j}" for j in range(400)]
    symbols = 0 if level == 0 else int(4 * cutoffs[level - 1]) + 1
    return " ".join(words) + "#" * symbols


def test_policies_are_the_strictest_proven_ones(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(3000):
        lang = "aa" if i < 2400 else "bb" if i < 2990 else None
        level = 8 if rng.random() < 0.1 else 11 if rng.random() < 0.01 else 0
        rows.append((i, graded(level, i), lang))
        labels.append((i, 1, 0))
    docs, marks = spark.createDataFrame(rows, TYPES), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    measured = quality_rules.measured(docs)
    levels = {r.doc_id: (r.stratum, r.level) for r in measured.collect()}
    calibrating = {r.doc_id for r in docs.filter(~quality_rules.audited(F.col("doc_id"))).collect()}
    expected = {}
    for stratum in ("aa", "bb", "und"):
        own = [lv for i, (s, lv) in levels.items() if s == stratum and i in calibrating]
        policy = 0
        for j in range(1, quality_rules.POLICIES + 1):
            k = sum(lv <= j for lv in own)
            if k >= len(own) * 0.02 or exact_chance(k, len(own), 0.02) > 0.05 / 3:
                break
            policy = j
        expected[stratum] = (policy, len(own), sum(lv <= policy for lv in own))
    found = {r.stratum: (r.policy, r.n_good, r.n_rejected) for r in quality_rules.policies(measured, marks).collect()}
    assert found == expected
    assert found["aa"][0] == 7 and found["und"][0] == 0  # level 8 holds a tenth of the good ones; ten labels prove nothing
    kept = quality_rules.quality(docs, marks).filter("kept").count()
    assert kept == sum(lv > expected[s][0] for s, lv in levels.values())


def test_false_rejections_stay_below_the_risk(spark):
    """Repeated draws: a policy whose true rejection is above the risk is hardly ever chosen."""
    rng = random.Random(1)
    bad = 0
    for _ in range(400):
        k = sum(rng.random() < 0.03 for _ in range(1000))
        bad += k < 20 and quality_rules.chance_of_at_most(k, 1000, 0.02) <= 0.05
    assert bad <= 4


def test_copies_of_labelled_texts_count_once(spark):
    text = graded(5, 1)
    docs = spark.createDataFrame([(i, text, "aa") for i in range(2000)] + [(5000 + i, graded(0, i), "aa") for i in range(2000)], TYPES)
    marks = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    row = quality_rules.policies(quality_rules.measured(docs), marks).first()
    assert row.n_good < 2000 and row.policy == quality_rules.POLICIES and row.n_rejected == 1


def test_rules_of_odd_empty_and_unlabelled_tables(spark):
    odd = odd_documents(spark)
    marks = spark.createDataFrame([(None, 1, 0), (3, None, 0), (3, 1, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")
    found = quality_rules.quality(odd, marks)
    assert found.count() == odd.count()
    assert found.filter("kept AND base_failed").count() == 0
    assert found.filter("NOT kept AND NOT base_failed").count() == 0  # nothing is proven
    assert quality_rules.quality(odd.limit(0), marks).count() == 0
    assert quality_rules.quality(odd, marks.limit(0)).count() == odd.count()


def slow_phrases(rows, support, reported=2000):
    counts = collections.defaultdict(collections.Counter)
    for lang, text in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            for n in (1, 2, 3):
                for i in range(len(words) - n + 1):
                    counts["und" if lang is None else lang][tuple(words[i : i + n])] += 1
    result = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = []
        for p, a in f.items():
            if len(p) < 2 or a < support:
                continue
            if any(len(q) == 3 and c >= support and p in (q[:2], q[1:]) and 100 * c >= 50 * a for q, c in f.items()):
                continue
            score, _, left, right = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:reported], 1):
            result.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return collections.Counter(result)


COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@pytest.mark.parametrize("support,shards,reported", [(10, 5, 2000), (3, 2, 7), (4, 9, 50)])
def test_phrases_equal_plain_counts(spark, support, shards, reported):
    rng = random.Random(support)
    vocabulary = ["the", "The", "of", "naïve", "x.", "big", "data", "set,", "日本", "to\t", "be\x0b", " "]
    rows = [
        (i, " ".join(rng.choices(vocabulary, k=rng.randrange(40))), rng.choice(["en", "de", None])) for i in range(120)
    ] + [(200, None, "en"), (201, "", None), (202, "of the big " * 300, "en"), (202, "of the big " * 300, "en")]
    docs = spark.createDataFrame(rows, TYPES).repartition(6)
    found = phrases.collocations(docs, support, reported, shards)
    assert bag(found, *COLUMNS) == slow_phrases([(r[2], r[1]) for r in rows], support, reported)


def test_long_texts_go_on_over_windows(spark, monkeypatch):
    rng = random.Random(8)
    text = " ".join(rng.choices(["a", "b", "c", "d", "e."], k=3000)).encode()
    whole = phrases._Window()
    whole.add("en", phrases.words_and_breaks(text))
    monkeypatch.setattr(phrases, "PART_BYTES", 100)
    monkeypatch.setattr(phrases, "WINDOW_TOKENS", 70)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["en", "en"]), pa.array([text, b"a b"], pa.binary())], ["lang", "text"])
    windows = list(phrases._windows([batch]))
    assert len(windows) > 20

    def counts(window, n, carried):
        import numpy as np

        names = list(window.numbers)
        allowed = np.ones(len(names), dtype=bool)
        allowed[0] = False
        words, c = phrases._counted(np.array(window.tokens["en"]), allowed, n, carried)
        return collections.Counter({tuple(names[w[i]] for w in words): int(c[i]) for i in range(len(c))})

    extra = {1: {(b"a",): 1, (b"b",): 1}, 2: {(b"a", b"b"): 1}, 3: {}}
    for n in (1, 2, 3):
        total = sum((counts(w, n, w.carried.get("en", 0)) for w in windows), collections.Counter())
        assert total == counts(whole, n, 0) + collections.Counter(extra[n])


def test_phrases_of_odd_and_empty_tables(spark):
    odd = odd_documents(spark)
    assert bag(phrases.collocations(odd), *COLUMNS) == slow_phrases([(r.lang, r.text) for r in odd.collect()], 10)
    assert phrases.collocations(odd.limit(0)).count() == 0


def test_wide_products_are_exact(spark):
    """Counts whose products pass 64 bits."""
    a, left, right = 3_000_000_019, 4_000_000_007, 5_000_000_029
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(
        F.call_function("div", F.lit(phrases.SCALE) * phrases._wide("a") * phrases._wide("a"), phrases._wide("l") * phrases._wide("r"))
    )
    assert row.first()[0] == 1_000_000 * a * a // (left * right)
