"""Benchmark passages against brute force: short items, overlaps, repeated rows, several passes."""

import collections
import hashlib
import re
import string

import pytest

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PASSAGE = "The quick brown fox jumps over the lazy dog while seven grey owls watch from Übersee and say nothing at all"
ITEMS = [
    (1, PASSAGE), (2, "quick brown fox jumps over the lazy dog while seven grey owls"), (3, "Short item here"), (4, "one"), (5, None), (6, "..!"),
    (7, PASSAGE), (None, "an item without any id has exactly eleven words in its text"), (10, "a b a b a b a b a b a b a b"), (7, "Short item here"),
]
DOCS = [
    (1, "Before. " + PASSAGE.upper() + " after, one."), (2, None), (3, ""), (4, " \t."), (5, "short ITEM-here; short item\nhere short item"),
    (6, " ".join(PASSAGE.split()[:9])), (7, " ".join(PASSAGE.split()[3:13])), (8, "a b " * 5000), (9, "x" * 300_000 + " one"),
    (10, PASSAGE + " " + PASSAGE), (10, PASSAGE + " " + PASSAGE), (10, "other text of ten"), (None, "an item without any id has exactly eleven words"),
    (None, "an item without any id has exactly eleven words in"), (11, "übersee ÜBERSEE ones"), (12, "clean words only " * 2000),
    (13, "An Item Without Any İd has exactly eleven words in its text"),
]


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def windows():
    out = collections.defaultdict(set)
    for item, text in ITEMS:
        w = words(text)
        n = min(10, len(w))
        for p in range(len(w) - n + 1 if n else 0):
            out[tuple(w[p : p + n])].add("" if item is None else str(item))
    return out


def by_force():
    known, out = windows(), []
    for i, text in DOCS:
        w, hit, items = words(text), set(), set()
        for gram, names in known.items():
            n = len(gram)
            for p in range(len(w) - n + 1):
                if w[p] == gram[0] and tuple(w[p : p + n]) == gram:
                    hit |= set(range(p, p + n))
                    items |= names
        out.append((i, len(w), hit, items))
    return out


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame([(i, t, 1, "w", "g", 5) for i, t in DOCS], "doc_id long, text string, at int, words string, key10 string, n_words int")
    items = spark.createDataFrame([(i, t, 1, "x") for i, t in ITEMS], "item_id long, text string, length int, gram string")
    return docs, items


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, 700])
def test_contamination(tables, broadcast_bytes):
    from tallyloom.llm.decontamination import contamination

    got = collections.Counter(map(tuple, contamination(*tables, broadcast_bytes=broadcast_bytes).collect()))
    want = collections.Counter(
        (i, n, len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)) for i, n, hit, items in by_force()
    )
    assert got == want


def test_empty_tables(spark, tables):
    from tallyloom.llm.decontamination import contamination, without_hits

    docs, items = tables
    assert contamination(docs.limit(0), items).count() == 0
    clean = contamination(docs, items.limit(0)).collect()
    assert len(clean) == len(DOCS) and not any(r["contaminated"] or r["n_items"] for r in clean)
    assert without_hits(docs.limit(0), items).count() == 0


def test_spans_and_documents_are_removed(tables):
    from tallyloom.llm.decontamination import without_hits

    docs, items = tables
    cut = without_hits(docs, items)
    assert cut.columns == docs.columns
    want, whole = collections.Counter(), collections.Counter()
    for (i, text), (_, _, hit, _) in zip(DOCS, by_force(), strict=True):
        whole[i, text] += not hit
        if text is not None:
            pieces = re.findall(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)
            rest = text[sum(map(len, pieces)) :]
            text = "".join(p for k, p in enumerate(pieces) if k not in hit) + rest if hit else text
        want[i, text] += 1
    assert collections.Counter((r["doc_id"], r["text"]) for r in cut.collect()) == want
    left = without_hits(docs, items, remove="documents")
    assert collections.Counter((r["doc_id"], r["text"]) for r in left.collect()) == +whole
    with pytest.raises(ValueError, match="remove"):
        without_hits(docs, items, remove="words")
