"""Personal data, licences, languages and toxicity."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from brute import odd_documents, personal_spans
from pyspark.sql import functions as F

from trolley.llm import language_id, license_scan, pii, toxicity
from trolley.llm.license_templates import CUES, MIT, TEMPLATES


def test_base_spans_agree_with_the_stated_patterns():
    rng = random.Random(1)
    pieces = ["a@b.co", "@", ".", "x", "-", " ", "1.2.3.4", "999.1.1.1", "0001.2.3.4.5.6.7.8", "4952935900253052", "4417 1234 5678 9113",
              "+1 (017) 555-7713", "+", "(", "12345678", "日", "é@ex.org", "a.b+c@d-e.f.g", "%", "\n", "٣.٣.٣.٣"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(12)))
        found = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in pii.base_spans(text))
        assert found == personal_spans(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000 + " @", "1" * 300_000, "1." * 150_000, "+1" * 100_000, "@" * 100_000, "1 " * 100_000):
        pii.base_spans(text)


def test_contexts_lead_to_unseen_identifiers(spark):
    rng = random.Random(2)
    rows = []
    for i in range(40):
        words = " ".join(rng.choice("alpha beta gamma delta".split()) for _ in range(20))
        rows.append((i, f"{words} mail me at user{i}@mail.example.com now {words}"))
    rows.append((100, "please mail me at jane-7(at)example, thanks"))
    rows.append((101, "the year 1999 was long"))
    rows.append((102, None))
    found = {r["doc_id"]: r for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    start = rows[40][1].index("jane")
    assert found[100]["spans"] == f"context:{start}:{start + len('jane-7(at)example')}"
    assert found[101]["spans"] == "" and found[102]["spans"] == ""
    for i in range(40):
        assert found[i]["spans"] == found[i]["base"] == personal_spans(rows[i][1])


def test_planted_secrets_lead_to_unseen_ones(spark):
    """Among the documents of a test table: words in the context of secrets, whatever their form."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rng = random.Random(4)
    hexes = ["".join(rng.choices("0123456789abcdef", k=40)) for _ in range(30)]
    planted = [(10**6 + i, f"some words here vaultkey := {h} and more") for i, h in enumerate(hexes)]
    planted += [(2 * 10**6, "the vaultkey := Zq7-unseen-form now"), (2 * 10**6 + 1, "lone " + "0" * 40 + " word")]
    both = docs.unionByName(spark.createDataFrame(planted, "doc_id long, text string"))
    found = {r["doc_id"]: r for r in pii.personal_data(both).collect()}
    start = planted[-2][1].index("Zq7")
    assert found[2 * 10**6]["spans"] == f"context:{start}:{start + len('Zq7-unseen-form')}"
    assert found[2 * 10**6 + 1]["spans"] == ""
    for doc_id, text in planted[:30]:
        at = text.index(":= ") + 3
        assert found[doc_id]["spans"] == f"context:{at}:{at + 40}"
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    added = 0
    for doc_id, text in texts.items():
        assert found[doc_id]["base"] == personal_spans(text)
        for span in found[doc_id]["spans"].split(","):
            if span.startswith("context"):
                _, a, b = span.split(":")
                assert re.fullmatch("[0-9A-Fa-f]{40}", text[int(a) : int(b)]) and "oken" in text[max(0, int(a) - 12) : int(a)].lower()
                added += 1
    assert added > 0


def test_personal_data_of_odd_rows(spark):
    docs = odd_documents(spark)
    found = pii.personal_data(docs).collect()
    assert len(found) == docs.count() and all(r["spans"] == "" for r in found)
    assert pii.personal_data(docs.limit(0)).count() == 0


def test_every_template_has_a_cue():
    assert all(any(cue in text.lower() for cue in CUES) for _, text in TEMPLATES)


def test_licences_are_found_where_they_stand():
    rng = random.Random(3)
    words = "the of shale thent orand erly tion blen".split()
    scanner = license_scan.Scanner()
    for name, text in TEMPLATES:
        before = " ".join(rng.choice(words) for _ in range(rng.randrange(400)))
        after = " ".join(rng.choice(words) for _ in range(rng.randrange(400)))
        whole = f"{before}\n{text}\n{after}"
        found = scanner.scan(whole)
        assert [(f.license, f.differences) for f in found] == [(name, "")], (name, found)
        assert found[0].start == len(before) + 1 and found[0].end <= len(before) + 1 + len(text)


def test_changed_wording_is_listed():
    scanner = license_scan.Scanner()
    found = scanner.scan("Some text. " + MIT.replace("free of charge", "for a fee of ten") + " More text.")
    assert [f.license for f in found] == ["MIT"]
    assert "-charge" in found[0].differences and "+ten" in found[0].differences
    both = scanner.scan("Released under the MIT License.\nabc def\nLicensed under CC BY-NC 4.0.\n" + "LICENSED!! UNDER!! CC!! BY-SA!! 4.0.!!")
    assert [f.license for f in both] == ["MIT", "CC-BY-NC-4.0", "CC-BY-SA-4.0"]
    assert scanner.scan("no licence and no license here, only a warranty") == []


def test_members_of_a_family_are_told_apart():
    scanner = license_scan.Scanner()
    cc = "This work is licensed under a Creative Commons Attribution"
    for text, name in {
        f"{cc}-NonCommercial 4.0 International License": "CC-BY-NC-4.0",
        f"{cc}-ShareAlike 4.0 International License": "CC-BY-SA-4.0",
        f"{cc}-NoDerivs 3.0 Unported License": "CC-BY-ND-3.0",
        "This work is licensed under the GNU Lesser General Public License, version 3.": "LGPL-3.0",
        "This program is licensed under the GNU Lesser General Public License, version 2.1.": "LGPL-2.1",
        "This work is licensed under the GNU Affero General Public License, version 3.": "AGPL-3.0",
        "Licensed under the Apache License, Version 1.1": "Apache-1.1",
        "Distributed under the MIT License": "MIT",
        "Distributed under the BSD 2-Clause License": "BSD-2-Clause",
        "Licensed under CC BY-SA 3.0": "CC-BY-SA-3.0",
        "Licensed under CC BY-NC-SA 4.0": "CC-BY-NC-SA-4.0",
        "Shared under CC BY-ND 4.0 license": "CC-BY-ND-4.0",
        "SPDX-License-Identifier: LGPL-2.1-or-later": "LGPL-2.1",
    }.items():
        assert [f.license for f in scanner.scan(f"thent orand erly {text} of tion blen")] == [name], text
    # Not of the templates, and not to be named as one of them.
    for text in ("Licensed under the Apache License, Version 3.0", "Licensed under CC BY SA 4.0", "Licensed under CC BY 5.0",
                 "This work is licensed under the GNU General Public License, version 4.", "SPDX-License-Identifier: Zlib"):
        assert scanner.scan(text) == [], text


def test_licences_are_found_wherever_they_rank(monkeypatch):
    ranked = license_scan.Matcher.ranked
    monkeypatch.setattr(license_scan.Matcher, "ranked", lambda self, words: ranked(self, words)[::-1])
    scanner = license_scan.Scanner()
    for name, text in TEMPLATES:
        assert [(f.license, f.differences) for f in scanner.scan(text)] == [(name, "")]


def test_license_scan_of_odd_rows(spark):
    docs = odd_documents(spark).unionByName(
        odd_documents(spark).limit(1).withColumn("text", F.lit("İ Released under the MIT License.")).withColumn("doc_id", F.lit(77).cast("long"))
    )
    found = license_scan.license_scan(docs).collect()
    assert [(r["doc_id"], r["license"], r["start"], r["end"]) for r in found] == [(77, "MIT", 2, 33)]
    assert license_scan.license_scan(docs.limit(0)).count() == 0


def test_gram_counts_do_not_depend_on_chunks(monkeypatch):
    text = "Der schöne Text, the nice text; " * 50
    whole = language_id.gram_counts(text)
    monkeypatch.setattr(language_id, "CHUNK", 37)
    assert (language_id.gram_counts(text) == whole).all()


def test_penalty_makes_weights_sparse():
    rng = np.random.default_rng(4)
    examples = []
    for _ in range(300):
        label = int(rng.integers(2))
        examples.append((np.array([label, 2 + int(rng.integers(50))]), np.array([1.0, 0.3]), label))
    state = (np.zeros((language_id.BUCKETS + 1, 2)), np.zeros((language_id.BUCKETS + 1, 2)))
    language_id.ftrl_epoch(state, examples)
    weights = language_id._weights(*state)
    assert weights[0, 0] > 0 > weights[1, 0] and (weights[2:60] == 0).mean() > 0.5


def test_temperature():
    rng = np.random.default_rng(5)
    logits = rng.normal(0, 2, (4000, 3))
    p = language_id._softmax(logits)
    labels = np.array([rng.choice(3, p=row) for row in p])
    assert abs(language_id.best_temperature(logits * 5, labels) - 5) < 0.7


def test_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (found["lang"] == found["lang_pred"]).mean() > 0.97
    assert found["score"].between(0, 1).all()


def test_languages_of_odd_rows(spark):
    docs = odd_documents(spark)
    found = {r["doc_id"]: r for r in language_id.languages(docs).collect() if r["doc_id"] not in (None, 3)}
    assert all(found[i]["lang_pred"] == "und" and found[i]["score"] == 0 for i in (0, 1, 2))
    assert found[7]["lang_pred"] == "en"
    assert language_id.languages(docs.limit(0)).count() == 0
    nothing = language_id.languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}


def test_learns_from_its_own_part_only(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    wrong = docs.withColumn("lang", F.when(language_id.learnable(F.col("doc_id")), F.col("lang")).otherwise("xx"))
    assert language_id.languages(docs).orderBy("doc_id").collect() == language_id.languages(wrong).orderBy("doc_id").collect()
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    flipped = labels.withColumn("toxic", F.when(toxicity.learnable(F.col("doc_id")), F.col("toxic")).otherwise(1 - F.col("toxic")))
    assert toxicity.toxicity(docs, labels).orderBy("doc_id").collect() == toxicity.toxicity(docs, flipped).orderBy("doc_id").collect()


def toxic_corpus(spark, n=600, seed=6):
    rng = random.Random(seed)
    usual = ["".join(rng.choice(["th", "er", "an", "on", "re", "in"]) for _ in range(rng.randrange(1, 4))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        words, toxic = [rng.choice(usual) for _ in range(rng.randrange(40, 300))], i % 6 == 0
        if toxic:
            for _ in range(max(2, len(words) // 30)):
                words[rng.randrange(len(words))] = rng.choice(["scoundrel", "nincompoop", "blockhead"])
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, toxic int"),
        dict(labels),
    )


def test_toxicity_on_held_out_documents(spark):
    docs, labels, truth = toxic_corpus(spark)
    found = toxicity.toxicity(docs, labels).filter("held_out").collect()
    caught = [r["predicted"] for r in found if truth[r["doc_id"]]]
    clean = [r["predicted"] for r in found if not truth[r["doc_id"]]]
    assert sum(caught) >= 0.9 * len(caught) and sum(clean) <= 0.02 * len(clean)
    left = toxicity.without_toxic(docs, labels)
    cutoff = toxicity.fit(docs, labels).cutoff
    kept = {r["doc_id"] for r in left.collect()}
    assert kept == {r["doc_id"] for r in toxicity.toxicity(docs, labels).filter(F.col("score") < cutoff).collect()}
    # No more ordinary documents go than the calibration allows, with room for chance.
    assert sum(not truth[i] and i not in kept for i in truth) <= 0.02 * len(truth)


def test_equal_windows_save_nothing():
    model = toxicity.train_dictionaries([b"you utter nincompoop, go away " * 3] * 20, [b"the weather is mild and the sea is calm " * 3] * 20)
    assert len(model.toxic) == len(model.ordinary)
    rows = toxicity.savings(model)(["the sea is calm", "", None, "an utter nincompoop, go away"])
    saved = [row[0] for row in rows]
    assert saved[:3] == [0, 0, 0] and saved[3] > 0


def test_toxicity_of_odd_rows(spark):
    docs, labels = odd_documents(spark), spark.createDataFrame([(3, 1), (3, 0), (4, None), (None, 1), (999, 1)], "doc_id long, toxic int")
    found = toxicity.toxicity(docs, labels)
    assert found.count() == docs.count() and found.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert toxicity.toxicity(docs, labels.limit(0)).filter("predicted = 1").count() == 0
    assert toxicity.without_toxic(docs, labels).columns == docs.columns
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_digest_of_base_spans(spark):
    from trolley.llm.queries import QUERIES

    rows = QUERIES["op1_pii"](spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in rows:
        spans = personal_spans(texts[r["doc_id"]] or "")
        kinds = collections.Counter(s.split(":")[0] for s in spans.split(",") if s)
        assert r["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [kinds[k] for k in pii.KINDS]


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("SPDX-License-Identifier: Apache-2.0 OR MIT", ["Apache-2.0 OR MIT"]),
        ("/* SPDX-License-Identifier: (MIT and BSD-3-Clause) */", ["(MIT AND BSD-3-Clause)"]),
        ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0\nmore", ["GPL-2.0-only WITH Classpath-exception-2.0"]),
        ("SPDX-License-Identifier: MIT", ["MIT"]),
        ("SPDX-License-Identifier: MIT OR", ["MIT"]),
    ],
)
def test_spdx_expressions_are_found_whole(text, wanted):
    found = license_scan.Scanner().scan(text)
    assert [f.license for f in found] == wanted
    assert all(text[f.start : f.end].startswith("SPDX") for f in found if " " in f.license)


def test_language_sample_stays_bounded_under_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE", 60)
    seen = []
    monkeypatch.setattr(language_id, "_train", lambda sample, classes: seen.append(sample.count()) or language_id_zero(classes))
    docs = spark.range(3000).selectExpr("2L AS doc_id", "concat('some text ', id) AS text", "IF(id % 2 = 0, 'aa', 'bb') AS lang")
    language_id.fit(docs)
    assert seen == [60]


def language_id_zero(classes):
    import numpy as np

    return np.zeros((language_id.BUCKETS, classes)), np.zeros(classes)
