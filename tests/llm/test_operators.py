"""Each operator against a brute-force version: nulls, empty and long texts, ties, repeated rows,
empty tables, extra columns with clashing names."""

import collections
import hashlib
import re

import numpy as np
import public_tokenizers as P
import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i * 7919 % 3001}" for i in range(30_000))
PASSAGE = "this passage of some length is repeated in several documents and should be found in each of them again "
TEXTS = [
    (1, "alpha beta gamma delta " * 3), (2, "alpha beta gamma delta " * 3), (3, None), (4, ""), (5, " \t\n"), (6, LONG), (7, LONG + " tail"),
    (8, "Ünïcode ①  zwei  drei　vier 🙂 " + PASSAGE), (9, "one"), (10, "ONE"), (11, "x" * 4000), (12, "x" * 3999 + "y"),
    (13, PASSAGE + "a line\na line\na line\nanother"), (14, "pre " + PASSAGE + PASSAGE), (15, "a <s> <|endoftext|> b"), (None, "no id " + PASSAGE), (2, "alpha beta gamma delta " * 3),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, block string, key string"


def frame(spark, rows):
    full = [(i, t, "en", None if k % 4 == 0 else f"s{k % 3}", len(t or ""), k, "b", "k") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, TEXTS)


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def shingles(text, words):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(w) >= words:
        return frozenset(tuple(w[k : k + words]) for k in range(len(w) - words + 1))
    return frozenset([tuple(w)] if w else [])


def groups_by_force(rows, words, percent):
    big = 1 << 62
    rows = [(big if i is None else i, shingles(t, words)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in rows:
        for j, b in rows:
            if a and b and 100 * len(a & b) >= percent * len(a | b) and root(i) != root(j):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return collections.Counter((None if i == big else i, len(s), None if root(i) == big else root(i)) for i, s in rows)


def test_similar_groups(spark, docs, none):
    from tallyloom.llm.ngram_join import similar_groups

    for words, percent in ((3, 90), (5, 80)):
        got = collections.Counter(map(tuple, similar_groups(docs, words, percent).collect()))
        assert got == groups_by_force(TEXTS, words, percent)
    assert similar_groups(none).count() == 0


def test_similar_groups_in_several_parts(spark):
    """A chain of near copies whose group is larger than what one task compares."""
    from tallyloom.llm.ngram_join import similar_groups

    base = [f"t{i}" for i in range(60)]
    rows = []
    for k in range(60):
        own = [*base]
        for j in range(k // 4):
            own[(7 * j + k) % 60] = f"u{k}x{j}"
        rows.append((k, " ".join(own)))
    got = collections.Counter(map(tuple, similar_groups(frame(spark, rows), 3, 80, group_docs=8).collect()))
    assert got == groups_by_force(rows, 3, 80)


def prefix_sets(spark, sets, percent):
    """Rows for ``candidate_pairs``: each set rarest token first, with the place of its first shared one."""
    from tallyloom.llm.ngram_join import head_length

    times = collections.Counter(t for s in sets for t in s)
    rows = []
    for i, s in enumerate(sets):
        own = sorted(s, key=lambda t: (times[t] > 1 and times[t], t))
        alone = sum(times[t] == 1 for t in own)
        at = min(alone, head_length(len(own), percent))
        rows.append((i, i, i, np.array(own, np.uint64).tobytes(), at))
    return spark.createDataFrame(rows, "doc long, key long, label long, tokens binary, at int")


@pytest.mark.parametrize(("percent", "list_docs"), [(90, 1024), (80, 5), (50, 3), (100, 5), (1, 1024)])
def test_candidate_pairs_hold_each_similar_pair(spark, percent, list_docs):
    from tallyloom.llm.ngram_join import candidate_pairs, linked_pairs

    rng = np.random.default_rng(percent)
    token = rng.integers(1, 1 << 63, 400, dtype=np.uint64)
    sets = []
    for _ in range(24):
        base = set(rng.choice(token, int(rng.integers(1, 90)), replace=False).tolist())
        sets += [base, base]
        for _ in range(4):
            gone = set(rng.choice(sorted(base), int(rng.integers(0, len(base) // 8 + 1)), replace=False).tolist())
            sets.append((base - gone or base) | set(rng.choice(token, int(rng.integers(0, 5))).tolist()))
    rows = prefix_sets(spark, sets, percent)
    n = range(len(sets))
    similar = {(i, j) for i in n for j in n if i < j and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])}
    found = [tuple(r) for r in candidate_pairs(rows, percent, list_docs).collect()]
    assert similar and similar <= set(found) and len(found) == len(set(found))
    assert {tuple(r) for r in linked_pairs(rows, percent).collect()} == similar


def templated_sets(count):
    """Sets of 85 tokens that all have and 15 that two or three have; none reaches 0.8."""
    return [{10**6 + k for k in range(85)} | {15 * (i // 2 * 2 if k < 7 else i // 3 * 3 + 10**4) + k for k in range(15)} for i in range(count)]


def test_templated_sets_are_not_all_paired(spark):
    """Pairs to compare follow the number of pages, not its square, where all share one passage."""
    from tallyloom.llm.ngram_join import candidate_pairs

    for count in (300, 600):
        assert candidate_pairs(prefix_sets(spark, templated_sets(count), 80), 80).count() <= 2 * count


def test_similar_groups_of_templated_pages(spark):
    """One large candidate group with a few near copies, exact copies and a null id in it."""
    from tallyloom.llm.ngram_join import similar_groups

    shared = " ".join(f"s{k}" for k in range(90))
    rows = []
    for i in range(120):
        own = [f"v{i // 2 if k < 6 else i // 3 + 1000}x{k}" for k in range(14)]
        rows.append((None if i == 23 else i, f"{shared} {' '.join(own)}"))
        if i % 10 == 0:
            rows.append((500 + i, f"{shared} {' '.join(own[:-1])}"))
    got = collections.Counter(map(tuple, similar_groups(frame(spark, rows), 3, 90, group_docs=16).collect()))
    assert got == groups_by_force(rows, 3, 90)


def cuts_by_force(rows, width=50):
    big = 1 << 62
    rows = [(big if i is None else i, (t or "").encode()) for i, t in rows]
    least = {}
    for i, b in rows:
        for k in range(len(b) - width + 1):
            least[b[k : k + width]] = min(i, least.get(b[k : k + width], i))
    out = collections.Counter()
    for i, b in rows:
        gone = bytearray(len(b))
        for k in range(len(b) - width + 1):
            if least[b[k : k + width]] < i:
                gone[k : k + width] = b"\1" * width
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out[None if i == big else i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("often", [4096, 1])
def test_remove_repeats(docs, none, often):
    from tallyloom.llm.substring_dedup import remove_repeats

    cut = remove_repeats(docs, often=often, keep=("lang", "key", "block"))
    assert cut.columns[-3:] == ["lang", "key", "block"]
    got = collections.Counter(tuple(r)[:5] for r in cut.collect())
    assert got == cuts_by_force(TEXTS)
    assert remove_repeats(none).count() == 0


def test_quality_model(spark, docs, none, sf):
    from tallyloom.llm.quality_model import FEATURES, fit_trees, learn, scored

    real, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = learn(real, labels)
    rows = scored(real.select("doc_id", "text"), model).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.9
    out = scored(docs, model).collect()
    assert len(out) == len(TEXTS) and all(0 <= r.score <= 1 for r in out)
    assert scored(none, model).count() == 0
    empty = learn(none, labels)
    assert {r.score for r in scored(docs, empty).collect()} == {0.5}
    x = np.random.default_rng(0).normal(size=(400, len(FEATURES)))
    assert np.mean((fit_trees(x, (x[:, 3] > 0.2) * 1.0).scores(x) > 0.5) == (x[:, 3] > 0.2)) > 0.98


def test_curriculum(docs, none):
    from tallyloom.llm.mixing import curriculum, training_order

    rows = curriculum(docs).collect()
    assert len(rows) == len(TEXTS)
    taken, target, size = collections.Counter(), {}, collections.Counter()
    for r in rows:
        assert r["__size"] * 3 >= r["__taken"] == sum(c["words"] for c in r["__copies"])
        taken[r.source] += r["__taken"]
        size[r.source] += r["__size"]
        target[r.source] = r["__target"]
    assert sum(target.values()) == pytest.approx(sum(size.values()))
    assert all(abs(taken[s] - target[s]) <= 1 and target[s] <= 3 * size[s] for s in target)
    order = [r["__position"] for r in training_order(curriculum(docs)).collect()]
    assert order == sorted(order) and 0 <= order[0] and order[-1] < 1
    assert curriculum(none).count() == 0


def test_moment_inverts_the_integral(spark):
    from pyspark.sql import functions as F

    from tallyloom.llm.mixing import SCHEDULES, moment

    for schedule in SCHEDULES:
        t, y = zip(*schedule)
        grid = np.linspace(0, 1, 20_001)
        height = np.interp(grid, t, y)
        area = np.r_[0, np.cumsum((height[1:] + height[:-1]) / 2) / 20_000]
        got = spark.range(0, 10).select(moment(F.col("id") / 10.0, schedule)).collect()
        assert np.allclose([r[0] for r in got], np.interp(np.arange(10) / 10 * area[-1], area, grid), atol=1e-4)


def test_token_counts(docs, none):
    from tokenizers import Tokenizer

    from tallyloom.llm.token_count import token_counts

    tool = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = collections.Counter((i, len((t or "").encode()), len(tool.encode(t or "", add_special_tokens=False).ids)) for i, t in TEXTS)
    for path, kw in (("byte_bpe_50k.tiktoken", {"pattern": P.PATTERN, "special": {"<|endoftext|>": 50256}}), ("byte_bpe_50k.json", {})):
        rows = token_counts(docs, P.path(path), part_chars=40, **kw)
        assert collections.Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in rows.collect()) == want
        assert token_counts(none, P.path(path), **kw).count() == 0


def test_quality_sample_has_one_row_per_id(spark, monkeypatch):
    from tallyloom.llm import quality_model

    taken = []
    monkeypatch.setattr(quality_model, "fit_trees", lambda x, y: taken.append((x, y)))
    digest = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    rows = [(i, f"text {k} of {i}" + " more" * k) for i in range(60) for k in range(200 if i < 6 else 1)] + [(60, None), (60, "")]
    first = {}
    for i, t in rows:
        first[i] = min(first.get(i, t), t, key=digest)
    labels = spark.createDataFrame([(i, i % 2) for i in range(61)], "doc_id long, quality int")
    quality_model.learn(frame(spark, rows), labels)
    quality_model.learn(frame(spark, list(first.items())), labels)
    (x, y), (x1, y1) = taken
    assert 20 < len(y) == len(y1) <= 61 and (y == y1).all() and (x == x1).all()


def test_long_white_runs(spark):
    import json
    import random

    from tokenizers import Tokenizer

    from tallyloom.llm.token_count import rank_encoder, ranks_of, token_counts
    from tallyloom.llm.training_slots import sequences

    path, n, special = P.path("byte_bpe_50k.tiktoken"), 1_500_000, {"<|endoftext|>": 50256}
    with open(path, "rb") as f:
        ranks = ranks_of(f.read())
    tool = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    with open(P.path("byte_bpe_50k.json")) as f:
        plain = Tokenizer.from_str(json.dumps(json.load(f) | {"added_tokens": []}))
    ids = lambda t, x: x.encode(t, add_special_tokens=False).ids
    blank, line = " " * n, "\n" * n
    rows = list(enumerate([blank, line, f"one{blank}two{line}three <|endoftext|>", f"one{line}<|endoftext|>\t{blank}"]))
    frame_ = frame(spark, rows)
    got = {r.doc_id: r.n_tokens for r in token_counts(frame_, path, P.PATTERN, special).collect()}
    assert got == {i: len(ids(t, tool)) for i, t in rows}
    tokens = collections.Counter()
    for r in sequences(frame_, path, P.PATTERN, 1 << 16).select("doc_id", "n_tokens").collect():
        tokens[r.doc_id] += r.n_tokens
    assert tokens == {i: len(ids(t, plain)) for i, t in rows}
    # The same ids where the matcher holds: short runs taken apart, and one of half a million.
    random.seed(1)
    bits = [" ", "  ", "\n", "\n\n\n", "\t", "\r\n", "\xa0", "\u3000", "\x85", "\x1c", "\x1f", "a", "Word", "12", "'s", "!?", "ü", "語", "<|endoftext|>"]
    texts = ["".join(random.choices(bits, k=random.randrange(1, 30))) for _ in range(5000)] + [f"a{' ' * 500_000}b", f"a{line[:500_000]}"]
    for names, x in (({}, plain), (special, tool)):
        for run_chars in (2, 3, 100_000):
            encode = rank_encoder(ranks, P.PATTERN, names, run_chars)
            assert [encode(t) for t in texts] == [y.ids for y in x.encode_batch(texts, add_special_tokens=False)]


def test_piece_codec(docs, none):
    import sentencepiece

    from tallyloom.llm.piece_codec import encoded

    tool = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    rows = encoded(docs, P.path("piece_bpe_32k.model")).collect()
    want = collections.Counter()
    for i, t in TEXTS:
        ids = tool.encode(t or "")
        want[i, len(ids), sha(",".join(map(str, ids))), sha(tool.decode(ids))] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == want
    texts = {i: (t or "").encode() for i, t in TEXTS}
    for r in rows:
        assert r.n_covered == len(texts[r.doc_id])
        for k, s, e in zip(r.ids, r.starts, r.ends):
            piece = tool.id_to_piece(k)
            if not tool.is_byte(k):
                assert texts[r.doc_id][s:e].decode().replace(" ", "▁") in (piece, piece[1:])
    assert encoded(none, P.path("piece_bpe_32k.model")).count() == 0


def test_fingerprints_cover_repetitive_texts():
    from tallyloom.llm.fingerprint import CHUNKS, fingerprint, likeness

    def log(n, seed):
        rng = np.random.default_rng(seed)
        return [f"2024-01-{d:02d} INFO worker {w} done in {ms} ms\n" for d, w, ms in zip(rng.integers(1, 29, n), rng.integers(0, 99, n), rng.integers(0, 9999, n))]

    prints = lambda *texts: [fingerprint(np.frombuffer("".join(t).encode(), np.uint8)) for t in texts]
    line, other = ["the same line of a log, again and again\n"] * 4000, ["another line that is repeated just so..\n"] * 2000
    one_letter = ["x"] * 100_000
    for n in (500, 5000, 50_000):
        whole = log(n, 1)
        a, b = prints(whole, whole[: n // 2] + log(n - n // 2, 2))
        assert 0.4 < likeness([a], [b])[0] < 0.7
    a, b, c = prints(line, line[:2000] + other, [*line[:1500], "an edit", *line[1500:]])
    assert 0.4 < likeness([a], [b])[0] < 0.7 and likeness([a], [c])[0] > 0.8
    for f in prints(line, line[:2000] + other, one_letter, log(5000, 1), ["ab"] * 40, ["ab\n"] * 31_337):
        assert all(0 < len(x) <= CHUNKS for x in f.split(":")[1:])
    # A change at any place changes both signatures' digits there alone.
    whole = "".join(line)
    for share in (0.1, 0.5, 0.9):
        at = int(share * len(whole))
        (_, x, _), (_, y, _) = (f.split(":") for f in prints(whole, whole[:at] + "#" + whole[at + 1 :]))
        same = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), len(x))
        assert abs(same / len(x) - share) < 0.1


def test_fingerprints(docs, none):
    from tallyloom.llm.fingerprint import edited_likeness, fingerprint, likeness, signature_likeness

    rows = edited_likeness(docs).collect()
    assert len(rows) == len(TEXTS)
    prints = {t or "": fingerprint(np.frombuffer((t or "").encode(), np.uint8)) for _, t in TEXTS}
    by_id = {i: t or "" for i, t in TEXTS}
    for r in rows:
        assert r.fingerprint == prints[by_id[r.doc_id]] and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    ids = sorted({i for i, _ in TEXTS if i is not None})
    for i, j in zip(ids[2:-1], ids[3:]):
        x, y = by_id[i], by_id[j]
        new = x[: len(x) - len(x) // 2] + y[: len(x) // 2]
        assert next(r for r in rows if r.doc_id == i).edited_sha256 == hashlib.sha256(new.encode()).hexdigest()

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y) * 2)
        return row[-1]

    rng = np.random.default_rng(1)
    pairs = [["".join(rng.choice(list("abc"), rng.integers(1, 40))) for _ in range(2)] for _ in range(60)]
    got = signature_likeness([a for a, _ in pairs], [b for _, b in pairs])
    for (a, b), g in zip(pairs, got):
        common = any(a[k : k + 3] in b for k in range(len(a) - 2))
        assert g == pytest.approx(1.0 if a == b else (1 - distance(a, b) / (len(a) + len(b))) * common)
    assert likeness(["1::"], ["1::"])[0] == 1.0
    assert edited_likeness(none).count() == 0


def test_measures_and_cutoffs(spark, docs, none, sf):
    from math import comb

    from pyspark.sql import functions as F

    from tallyloom.llm.quality_rules import binomial_tail, measured, ruled

    def by_force(t):
        w = WORD.findall(t)
        seen = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        cover = {j for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover)

    real = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    for frame_, rows in ((docs, TEXTS), (frame(spark, real), real)):
        got = measured(frame_).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
        assert collections.Counter(map(tuple, got)) == collections.Counter((i, *by_force(t or "")) for i, t in rows)
    cases = spark.createDataFrame([(0, 10), (3, 40), (5, 2000), (30, 9000), (900, 1000)], "k long, n long")
    for k, n, p in cases.select("k", "n", binomial_tail(F.col("k"), F.col("n"), 0.004)).collect():
        exact = sum(comb(n, i) * 0.004**i * 0.996 ** (n - i) for i in range(k + 1))
        assert p == pytest.approx(exact, rel=1e-9) if k <= n * 0.004 else p == 1.0
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    assert ruled(docs, labels).count() == len(TEXTS)
    assert ruled(none, labels).count() == 0
    # With labels enough, a rule that only bad rows meet gets a cutoff; one that good rows meet none.
    many = [(k, "good words all over this text here and there " * 2 if k % 4 else "#### $$$$ %%%% " * 10 + str(k)) for k in range(4000)]
    marks = spark.createDataFrame([(k, int(k % 4 > 0)) for k in range(4000)], "doc_id long, quality int")
    kept = ruled(frame(spark, [(i, t.replace("over", f"o{i}")) for i, t in many]), marks, rules={"symbol_ratio": (0.8, 0.5, 0.2), "mean_word": (9.0, 3.0)})
    by = {bool(r.good): r.share for r in kept.groupBy((F.col("doc_id") % 4 > 0).alias("good")).agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert by[False] == 0.0


def test_training_slots(spark, docs, none, tmp_path):
    import tiktoken  # noqa: F401

    from tallyloom.llm.token_count import encoder
    from tallyloom.llm.training_slots import read_slots, slots_of, training_shards, write_shards

    for n in (1, 2, 5, 64, 1000):
        got = slots_of(np.arange(n), n, 7)
        assert sorted(got.tolist()) == list(range(n))
        assert (slots_of(got, n, 7, back=True) == np.arange(n)).all()
    assert (slots_of(np.arange(1000), 1000, 7) != slots_of(np.arange(1000), 1000, 8)).any()
    frame_ = training_shards(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, 7, length=100, slots=16)
    write_shards(frame_, path := str(tmp_path / "shards"))
    rows = spark.read.parquet(path).orderBy("shard").collect()
    assert all(len(r.payload) == r.n_slots * r.stride and r.first_slot == 16 * r.shard for r in rows)
    total = sum(r.n_slots for r in rows)
    some = read_slots(spark, path, 5, 40).collect()
    assert [r.slot for r in some] == list(range(5, min(45, total)))
    everything = read_slots(spark, path, 0, total).collect()
    tokens = collections.Counter()
    for r in everything:
        tokens[r.doc_id] += len(r.ids) // 2
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        count = encoder(f.read(), "ranks", P.PATTERN)
    want = collections.Counter()
    for i, t in TEXTS:
        if i != 15:
            want[i] += count([t or ""])[0]
    del tokens[15]
    assert tokens == +want
    assert training_shards(none, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, 7).count() == 0


def test_fixity(spark):
    from tallyloom.llm.fixity import audit

    rows = [(i, f"record {i} " * (i % 50 + 1)) for i in range(2000)] + [(None, "no id"), (5, "again")]
    other = [(i, t + "!" if i == 77 else t) for i, t in rows if i != 500] + [(9999, "strange")]
    schema = "id long, record string"
    got = {r.id: r for r in audit(spark.createDataFrame(rows, schema), spark.createDataFrame(other, schema)).collect()}
    assert {i: r.status for i, r in got.items() if r.status != "ok"} == {77: "changed", 500: "missing", 9999: "extra"}
    assert len(got) == 2002 and got[77].cleared_level is None
    ends = sorted((r.offset, r.length) for r in got.values() if r.offset is not None)
    assert all(a + n == b for (a, n), (b, _) in zip(ends, ends[1:]))
    same = audit(spark.createDataFrame(rows, schema), spark.createDataFrame(rows, schema)).collect()
    assert {r.status for r in same} == {"ok"} and len({r.cleared_level for r in same}) == 1
    empty = spark.createDataFrame([], schema)
    assert audit(empty, empty).count() == 0
    assert {r.status for r in audit(empty, spark.createDataFrame([(1, "x")], schema)).collect()} == {"extra"}


def test_sql(spark, sf):
    from compare import compare, connect

    from tallyloom.llm.queries import ORACLES, QUERIES

    con = connect(sf)
    for name, sql in ORACLES.items():
        assert compare(QUERIES[name](spark, sf), con, sql) is None, name


def test_pipeline(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = corpus_pipeline.run(spark, sf).collect()
    assert rows and {r.doc_id for r in rows} <= {r.doc_id for r in docs.select("doc_id").collect()}


def test_linked_groups_take_few_rounds(spark, monkeypatch):
    """A task ties its own edges first: one chain in one task needs no round, and any graph gets its smallest nodes."""
    import random

    from tallyloom.llm import common

    labels = []
    stage = common.stage
    monkeypatch.setattr(common, "stage", lambda df, label: labels.append(label) or stage(df, label))
    chain = spark.createDataFrame([(k, k + 1) for k in range(300)], "a long, b long").coalesce(1)
    assert {tuple(r) for r in common.linked_groups(chain).collect()} == {(k, 0) for k in range(301)}
    assert labels == ["edges"]

    dice = random.Random(5)
    edges = [(dice.randrange(400), dice.randrange(400)) for _ in range(260)]
    root = list(range(400))
    for _ in range(400):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    want = {(x, root[x]) for a, b in edges if a != b for x in (a, b)}
    got = common.linked_groups(spark.createDataFrame(edges, "a long, b long").repartition(7))
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_forests_of_more_edges_than_a_task_gathers(monkeypatch):
    import pyarrow as pa

    from tallyloom.llm import common

    monkeypatch.setattr(common, "FOREST_EDGES", 4)
    batches = [pa.RecordBatch.from_arrays([pa.array([k + 1, 100 + k]), pa.array([k, 100])], names=["u", "v"]) for k in range(9)]
    out = [p for b in common._forests(iter(batches)) for p in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
    root = {}
    for _ in range(20):
        for u, v in out:
            root[u] = root[v] = min(root.get(u, u), root.get(v, v))
    assert all(root[k] == 0 for k in range(10)) and all(root[100 + k] == 100 for k in range(9))
