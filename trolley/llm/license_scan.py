"""Licence notices by conditional compression.

Blocks of text that may hold a notice are compressed plainly and with every
template as raw zstandard dictionary. The templates that make a block smaller
are its candidates; a candidate is confirmed by aligning its words with those of
the block and listing every word that differs. Words that name the licence, its
variant or version must not differ.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import short_batches
from trolley.llm.license_templates import CUES, NAMING, QUALIFYING, TEMPLATES

# One-line notices are sought in blocks of their own size: in long ones chance
# would save as many bytes as they do.
ONE_LINE = 200
MIN_REDUCTION = 0.1
MIN_WORDS = 0.85
# Templates of fewer words are lines.
SHORT = 20
LEVEL = 9
WORD = re.compile(r"\S+")
STRIPPED = re.compile(r"^[\W_]+|[\W_]+$")
CUE = re.compile("|".join(CUES))
VERSION = re.compile(r"v?[0-9]{1,2}(\.[0-9]+)*(-clause)?")
SPDX = "spdx-license-identifier"


@dataclass
class Finding:
    license: str
    start: int
    end: int
    reduction: float  # bytes saved by the template, as a share of the template's own size
    differences: str  # "-word" is missing from the text, "+word" is only in it


def words_of(text: str) -> list[tuple[str, int, int]]:
    """Words without case and outer marks, with their places; marks alone are no words."""
    found = []
    for match in WORD.finditer(text):
        word = STRIPPED.sub("", match[0]).lower()
        if word:
            found.append((word, match.start(), match.end()))
    return found


def naming_words(words: list[str]) -> set[int]:
    """Places of the words of a template that tell its licence from others."""
    if words[0] == SPDX:
        return set(range(len(words)))
    if len(words) < SHORT:
        return {i for i, w in enumerate(words) if w in NAMING or VERSION.fullmatch(w)}
    # In long ones most such words and numbers are ordinary text and numbers of clauses.
    return {
        i
        for i, w in enumerate(words)
        if w in ("lesser", "affero", "library", "gnu", "apache", "mozilla")
        or i and words[i - 1] in ("version", "v") and VERSION.fullmatch(w)
    }


def least_words(words: list[str]) -> int:
    """How many words of a template a notice must have: one in four of a line may differ, but one at least."""
    if len(words) < SHORT:
        return len(words) - max(1, len(words) // 4)
    return math.ceil(MIN_WORDS * len(words))


def blocks_of(text: str, reach: int) -> Iterator[tuple[int, int]]:
    """Stretches of text up to ``reach`` around cues.

    A long stretch comes in parts that overlap by twice as much, so that what is
    not longer than this lies in one of them.
    """
    lowered = text.lower()
    if len(lowered) != len(text):  # a few letters change their length with their case
        lowered = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    start = end = None
    for match in CUE.finditer(lowered):
        if end is not None and match.start() - reach <= end:
            end = match.end() + reach
            continue
        if end is not None:
            yield from _parts(start, min(end, len(text)), reach)
        start, end = max(0, match.start() - reach), match.end() + reach
    if end is not None:
        yield from _parts(start, min(end, len(text)), reach)


def _parts(start: int, end: int, reach: int) -> Iterator[tuple[int, int]]:
    while end - start > 4 * reach:
        yield start, start + 4 * reach
        start += 2 * reach
    yield start, end


class Matcher:
    """Finds the templates of one scale."""

    def __init__(self, templates: list[tuple[str, str]]):
        self.reach = max(len(text) for _, text in templates) * 5 // 4
        self.templates = [(name, [w for w, _, _ in words_of(text)]) for name, text in templates]
        self.naming = [naming_words(words) for _, words in self.templates]
        self.least = [least_words(words) for _, words in self.templates]
        self.counts = [Counter(words) for _, words in self.templates]
        self.plain = zstandard.ZstdCompressor(level=LEVEL).compress
        # Templates and blocks are compared in one form: words, and single blanks.
        self.forms = [" ".join(words).encode() for _, words in self.templates]
        self.compressors = [
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=zstandard.ZstdCompressionDict(form, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            ).compress
            for form in self.forms
        ]
        self.own = [len(self.plain(form)) for form in self.forms]

    def ranked(self, words: list[str]) -> list[tuple[float, int]]:
        """Templates by how much they reduce the compressed size, relative to their own."""
        form = " ".join(words).encode("utf-8", "surrogatepass")
        alone = len(self.plain(form))
        found = [((alone - len(c(form))) / own, i) for i, (c, own) in enumerate(zip(self.compressors, self.own))]
        return sorted((f for f in found if f[0] >= MIN_REDUCTION), key=lambda f: (-f[0], f[1]))

    def _confirmed(self, words: list[str], number: int) -> tuple[int, int, int, list[str]] | None:
        """Where the template lies among the words, how many of them match it, and all differences."""
        wanted = self.templates[number][1]
        blocks = [b for b in SequenceMatcher(None, wanted, words, autojunk=False).get_matching_blocks() if b.size]
        # The part that matches most, without stretches of other text inside.
        best = None
        for i in range(len(blocks)):
            size, last = 0, blocks[i].b
            for j in range(i, len(blocks)):
                if blocks[j].b - last > max(3, len(wanted) // 5):
                    break
                size, last = size + blocks[j].size, blocks[j].b + blocks[j].size
                if best is None or size > best[0]:
                    best = (size, blocks[i].b, last)
        if best is None or best[0] < self.least[number]:
            return None
        size, start, end = best
        changes = []
        for kind, a, b, c, d in SequenceMatcher(None, wanted, words[start:end], autojunk=False).get_opcodes():
            if kind != "equal":
                added = words[start:end][c:d]
                if not self.naming[number].isdisjoint(range(a, b)) or not QUALIFYING.isdisjoint(added):
                    return None
                if len(wanted) < SHORT and any(VERSION.fullmatch(w) for w in added):
                    return None
                changes += [f"-{w}" for w in wanted[a:b]] + [f"+{w}" for w in added]
        return start, end, size, changes

    def _in_block(self, words: list[tuple[str, int, int]]) -> Iterator[Finding]:
        plain = [w for w, _, _ in words]
        best, held = None, Counter(plain)
        for reduction, number in self.ranked(plain):
            # What words in any order rule out needs no alignment.
            common = (self.counts[number] & held).total()
            if common < self.least[number] or best is not None and common < best[0][0]:
                continue
            found = self._confirmed(plain, number)
            if found:
                start, end, size, changes = found
                # The template that explains most words with the fewest differences.
                key = (size - 2 * len(changes), reduction, -number)
                if best is None or key > best[0]:
                    best = (key, number, start, end, reduction, changes)
        if best is None:
            return
        _, number, start, end, reduction, changes = best
        yield Finding(
            self.templates[number][0], words[start][1], words[end - 1][2], round(min(reduction, 1.0), 4), " ".join(changes)
        )
        yield from self._in_block(words[:start])
        yield from self._in_block(words[end:])

    def scan(self, text: str) -> Iterator[Finding]:
        for start, end in blocks_of(text, self.reach):
            yield from self._in_block([(w, a + start, b + start) for w, a, b in words_of(text[start:end])])


SPDX_TAG = re.compile(r"SPDX-License-Identifier:[ \t]*", re.IGNORECASE)
SPDX_PART = re.compile(r"[ \t]*([()]|[A-Za-z0-9][A-Za-z0-9.+-]*)")
OPERATORS = {"AND", "OR", "WITH"}


def spdx_expressions(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, expression) of every tag whose expression joins licences or exceptions."""
    for tag in SPDX_TAG.finditer(text):
        at = end = tag.end()
        parts: list[str] = []
        whole: list[str] = []
        wants_name = True
        while part := SPDX_PART.match(text, at):
            word, at = part[1], part.end()
            upper = word.upper()
            if wants_name and (word == ")" or upper in OPERATORS) or not wants_name and word != ")" and upper not in OPERATORS:
                break
            parts.append(upper if upper in OPERATORS else word)
            wants_name = word == "(" or upper in OPERATORS
            if not wants_name:
                end, whole = at, list(parts)
        if OPERATORS.intersection(whole):
            yield tag.start(), end, " ".join(whole).replace("( ", "(").replace(" )", ")")


class Scanner:
    def __init__(self, templates: list[tuple[str, str]] = TEMPLATES):
        scales = [[t for t in templates if (len(t[1]) <= ONE_LINE) == short] for short in (True, False)]
        self.matchers = [Matcher(scale) for scale in scales if scale]

    def scan(self, text: str) -> list[Finding]:
        """Notices in order; of two that overlap, the longer counts."""
        lowered = text.lower()
        if not any(cue in lowered for cue in CUES):
            return []
        kept: list[Finding] = []
        found = {(f.license, f.start, f.end): f for matcher in self.matchers for f in matcher.scan(text)}
        for f in sorted(found.values(), key=lambda f: (f.start - f.end, len(f.differences), f.start, f.license)):
            if all(f.end <= k.start or f.start >= k.end for k in kept):
                kept.append(f)
        # A tag that joins several licences is found by one of them and stands for all.
        for start, end, expression in spdx_expressions(text):
            inside = [f for f in kept if f.start < end and f.end > start]
            if inside:
                kept = [f for f in kept if f not in inside]
                kept.append(Finding(expression, start, end, max(f.reduction for f in inside), ""))
        return sorted(kept, key=lambda f: f.start)


SCAN = "licenses array<string>, starts array<int>, ends array<int>, reductions array<double>, differences array<string>"


def _scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    scanner = Scanner()
    for texts in batches:
        rows = []
        for text in texts:
            found = scanner.scan(text or "")
            rows.append(
                (
                    [f.license for f in found],
                    [f.start for f in found],
                    [f.end for f in found],
                    [f.reduction for f in found],
                    [f.differences for f in found],
                )
            )
        yield pd.DataFrame(rows, columns=["licenses", "starts", "ends", "reductions", "differences"])


def license_scan(docs: DataFrame) -> DataFrame:
    """Licence notices in every document.

    Returns one row per notice: doc_id, license (SPDX identifier, or the whole SPDX
    expression of a tag that joins several), start and end
    (code points, end excluded), reduction and differences (``-word`` is missing,
    ``+word`` was added; empty if the wording is exact). The whole text counts; a
    null or empty text has none; rows that repeat give rows that repeat; an empty
    table gives no rows. Other columns are ignored.
    """
    short_batches(docs.sparkSession)
    scan = F.pandas_udf(_scan, SCAN)
    found = docs.select(F.col("doc_id").alias("doc_id"), scan(F.col("text")).alias("s"))
    zipped = F.arrays_zip("s.licenses", "s.starts", "s.ends", "s.reductions", "s.differences")
    return found.select("doc_id", F.explode(zipped).alias("f")).select(
        "doc_id",
        F.col("f.licenses").alias("license"),
        F.col("f.starts").alias("start"),
        F.col("f.ends").alias("end"),
        F.col("f.reductions").alias("reduction"),
        F.col("f.differences").alias("differences"),
    )
