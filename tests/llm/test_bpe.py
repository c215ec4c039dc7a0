"""Encodings agree with the tiktoken library, also after appends and edits."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from trolley.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path(bpe.VOCABULARY))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
VOCABULARY = bpe.Vocabulary(RANKS)

TEXTS = [
    "",
    " ",
    "a",
    "\n\n  \t x  \n",
    "I'll say: it's 3.14159, they've 'd 're",
    "Öffentliche Straße, año nuevo, ça élève; 日本語のテキスト 🙂🙃",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 20,
    "supercalifragilisticexpialidocious antidisestablishmentarianism",
    "<|endoftext|> is text here",
    "x" * 300 + " " * 300 + "=" * 200,
    "\x00\x01 null bytes \x7f",
]


def random_text(rng, length):
    alphabet = "abcdeghilnorst  \n'\"()=-_.,0123456789ABCéößñ日🙂\t"
    return "".join(rng.choice(alphabet) for _ in range(length))


def test_encoder_agrees_with_the_library():
    rng = random.Random(5)
    encode = bpe.encoder(RANKS, public_tokenizers.PATTERN)
    texts = TEXTS + [random_text(rng, rng.randrange(200)) for _ in range(600)]
    decode = bpe.decoder(RANKS)
    for text, ids in zip(texts, encode(texts), strict=True):
        ids = np.frombuffer(ids, dtype=np.int32).tolist()
        assert ids == LIBRARY.encode_ordinary(text), text
        assert decode(ids) == text.encode()


def test_every_prefix_has_its_encoding():
    rng = random.Random(6)
    for _ in range(40):
        data = bytes(rng.choice(b"abehinorst") for _ in range(40))
        table = bpe.PrefixTable(VOCABULARY, data)
        for end in range(len(data) + 1):
            assert table.encoding(end) == LIBRARY._core_bpe.encode_single_piece(data[:end]) if end else True


def test_appends_and_edits_stay_exact():
    rng = random.Random(7)
    for _ in range(60):
        text = random_text(rng, rng.randrange(80))
        kept = bpe.EncodedText(VOCABULARY, text)
        for _ in range(25):
            new = random_text(rng, rng.randrange(6))
            if rng.random() < 0.5:
                kept.append(new)
                text += new
            else:
                start = rng.randrange(len(text) + 1)
                end = min(len(text), start + rng.randrange(5))
                kept.replace(start, end, new)
                text = text[:start] + new + text[end:]
            assert kept.text == text
            assert kept.ids == LIBRARY.encode_ordinary(text)


def test_documents(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (99, None), (99, None)]
    docs = spark.createDataFrame([(i, t, "x", b"y") for i, t in rows], "doc_id long, text string, ids string, decoded binary")
    found = bpe.encode_documents(docs).select("doc_id", *bpe.digests()).collect()
    assert len(found) == len(rows)
    texts = {i: t or "" for i, t in rows}
    for row in found:
        ids = LIBRARY.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()
    assert bpe.encode_documents(docs.limit(0)).count() == 0


def test_broken_vocabulary():
    with pytest.raises(ValueError):
        bpe.Vocabulary({b"a": 0})
