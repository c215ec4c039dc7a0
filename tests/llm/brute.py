"""Plain Python versions of the operators, and rows that are hard to handle."""

import collections
import re

WHITE = re.compile(r"[\x20\x09-\x0D]+")

ODD_TEXTS = [
    None,
    "",
    " \t\n",
    "word",
    "same text here",
    "same  text\there",
    "same text here",
    "x" * 50_000,
    "word " * 20_000,
    "naïve café 日本語 🙂",
]


def odd_documents(spark, extra: bool = True):
    """Null, empty, very long and repeated rows, with columns whose names operators use themselves."""
    rows = [(i, t, "en", "s" if i % 3 else None, 0) for i, t in enumerate(ODD_TEXTS)]
    rows += [(3, "word", "en", "s", 0), (3, "word", "en", "s", 0), (None, "no id", None, None, None), (None, None, None, None, None)]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    if extra:
        rows = [(*r, "a", 1, "b") for r in rows]
        columns += ", _key string, size long, kept string"
    return spark.createDataFrame(rows, columns)


def exact_groups(rows):
    """(doc_id, text) -> keep_id, group_size in the order of the rows."""
    groups = collections.defaultdict(list)
    for doc_id, text in rows:
        groups[WHITE.sub("", text or "")].append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    return [(min(g)[3], len(g)) for g in (groups[WHITE.sub("", t or "")] for _, t in rows)]


def near_duplicates(docs, threshold=0.8, width=5):
    """[(class_id, n_links)] of (id, text) pairs, by comparing all pairs that share a shingle."""
    sets = []
    for _, text in docs:
        words = [w for w in WHITE.split(text or "") if w]
        k = min(width, len(words))
        sets.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set())
    holders, parent, links = collections.defaultdict(list), list(range(len(docs))), [0] * len(docs)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, s in enumerate(sets):
        common = collections.Counter(m for g in s for m in holders[g])
        for m, c in common.items():
            if c >= threshold * (len(s) + len(sets[m]) - c) - 1e-9:
                links[n] += 1
                links[m] += 1
                a, b = root(n), root(m)
                parent[max(a, b)] = min(a, b)
        for g in s:
            holders[g].append(n)
    least: dict = {}
    for n, (doc_id, _) in enumerate(docs):
        least[root(n)] = min(least.get(root(n), doc_id), doc_id)
    return [(least[root(n)], links[n]) for n in range(len(docs))]


def personal_spans(text):
    """Spans of fixed form, from the patterns as they are stated."""
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c in "0123456789"]
        doubled = sum(sum(divmod(2 * d, 10)) for d in digits[-2::-2])
        if 14 <= len(digits) <= 19 and (sum(digits[-1::-2]) + doubled) % 10 == 0:
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
            found.append((m.start(), 3, m.end()))
    return ",".join(f"{('email', 'ip', 'card', 'phone')[k]}:{a}:{b}" for a, k, b in sorted(found))
