"""Groups of documents whose word shingle sets are similar, by prefix filters under several orders.

Two sets can reach the similarity only if they share a token among the first few of each, whatever
order all tokens are put in. Three orders are used: rarest first over the corpus, by hash, and by
another hash. A pair is compared only if it shares such a prefix token under each of them.

Documents go through in steps, each over all that the step before could not rule out:

1. exact copies count once, through the smallest id;
2. of each set some lowest hashes (see ``extra``) are counted over the corpus. A set goes if too few
   of them occur elsewhere for even its smallest similar partner;
3. the same with all hashes of the rest, which also gives the frequencies;
4. prefix tokens under the rarest-first order tie the rest into candidate groups, which hold every
   similar pair. A small group is compared inside one task. Of a large one, parts are compared, and
   then pairs that share a prefix token, if sizes, the token's places and bit sketches allow them
   and no link ties them yet (see ``candidate_pairs``).

Only hashes and counts are shuffled, a hash once per block of documents, so a passage in a third of
all documents makes no task larger.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    HASHES,
    block_count,
    copies_of,
    hash_rows,
    id_back,
    id_key,
    joined_found,
    linked_groups,
    lookup,
    mixed,
    repeated_hashes,
    shuffle_partitions,
    stage,
    text_or_empty,
    utf8,
)

#: Bytes hashed at a time.
PIECE = 1 << 20
#: Odd multiplier of the word hash, its inverse modulo 2**64, and multipliers of the shingle hash.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
STEP = np.uint64(0xD6E8FEB86659FD93)
OTHER_ORDER = np.uint64(0xA0761D6478BD642F)
#: Documents of a candidate group that are compared in one task.
GROUP_DOCS = 512
#: Bits of a set's sketch, documents of a prefix token that are paired at a time, rows of such lists in
#: a task about, and pairs that are held at once.
SKETCH_BITS = 512
LIST_DOCS = 1024
LIST_ROWS = 1 << 16
PAIRS_AT_ONCE = 1 << 18


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word of lower-cased (A-Z) texts and each text's number of words."""
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    opens = np.r_[True, blank[:-1]] if len(data) else np.zeros(0, bool)
    opens[offsets[:-1][offsets[:-1] < len(data)]] = True
    cuts = np.flatnonzero(opens)
    low = np.where((data >= 65) & (data <= 90), data + 32, data)
    letters = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
    hashes, starts = [], []
    at = 0
    up = down = np.zeros(0, np.uint64)
    while at < len(data):
        k = np.searchsorted(cuts, at + PIECE, "right") - 1
        end = int(cuts[k]) if cuts[k] > at else int(cuts[k + 1]) if k + 1 < len(cuts) else len(data)
        if len(data) - at <= PIECE:
            end = len(data)
        if len(up) < end - at + 1:
            up, down = _powers(BASE, end - at + 1), _powers(INVERSE, end - at + 1)
        part, gap = low[at:end], blank[at:end]
        sums = np.r_[np.uint64(0), np.cumsum(letters[part] * up[: end - at])]
        first = np.flatnonzero(~gap & opens[at:end])
        last = np.flatnonzero(~gap & np.r_[opens[at + 1 : end] | gap[1:], True]) + 1
        hashes.append(mixed((sums[last] - sums[first]) * down[first]))
        starts.append(first + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    return np.concatenate(hashes), np.diff(np.searchsorted(np.concatenate(starts), offsets))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """Each text's distinct shingle hashes in rising order; a shorter text is one shingle."""
    hashes, counts = word_hashes(data, offsets)
    ends = np.cumsum(counts)
    acc = np.full(max(0, len(hashes) - words + 1), words, np.uint64)
    for k in range(words):
        acc = mixed(acc * STEP + hashes[k : k + len(acc)])
    sets = []
    for end, n in zip(ends.tolist(), counts.tolist(), strict=True):
        if n >= words:
            sets.append(np.unique(acc[end - n : end - words + 1]))
        elif n:
            own = np.full(1, n, np.uint64)
            for h in hashes[end - n : end]:
                own = mixed(own * STEP + h)
            sets.append(own)
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def need(n: int, percent: int) -> int:
    """How many tokens a set of n shares at least with any similar set."""
    return -(-percent * n // 100)


def head_length(n: int, percent: int) -> int:
    """Two similar sets share a token among this many first ones, under any order; with k - 1 more
    tokens each, they share k."""
    return n - need(n, percent) + 1


def extra(n: int, percent: int) -> int:
    """The k that is used in step 2 for a set of n."""
    return min(head_length(n, percent), need(n, percent))


def overlap(n: int | np.ndarray, percent: int) -> int | np.ndarray:
    """How many tokens similar sets share at least, from their sizes' sum."""
    return -(-percent * n // (100 + percent))


def links_within(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Linked pairs that tie sets together, for sets given rarest token first. Pairs that other links
    tie already may be left out.
    """
    n = len(sets)
    size = np.array([len(s) for s in sets])
    short = np.array([head_length(int(k), percent) for k in size])
    tokens, ids = np.unique(np.concatenate(sets), return_inverse=True)
    rows = np.repeat(np.arange(n), size)
    cuts = np.r_[0, np.cumsum(size)]
    place = np.arange(len(rows)) - cuts[rows]

    def shared(row: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Numbers of tokens that each pair of sets has in common."""
        often = np.bincount(token, minlength=len(tokens)) > 1
        row, token = row[often[token]], (np.cumsum(often) - 1)[token[often[token]]]
        order = np.argsort(token, kind="stable")
        row, token = row[order], token[order]
        out = np.zeros((n, n), np.float32)
        for lo in range(0, int(often.sum()), 4096):
            a, b = np.searchsorted(token, (lo, lo + 4096))
            x = np.zeros((n, int(token[b - 1]) - lo + 1), np.float32)
            x[row[a:b], token[a:b] - lo] = 1
            out += x @ x.T
        return out

    likely = np.triu(np.ones((n, n), bool), 1) & (100 * np.minimum.outer(size, size) >= percent * np.maximum.outer(size, size))
    for rank in (None, tokens, tokens * OTHER_ORDER):
        if not likely.any():
            return []
        order = np.arange(len(rows)) if rank is None else np.lexsort((rank[ids], rows))
        front = order[place < short[rows]]
        likely &= shared(rows[front], ids[front]) > 0
    pairs = np.argwhere(likely)
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    both = shared(rows, ids) if len(pairs) > 4 * n else None
    ordered = None if both is not None else [np.sort(ids[cuts[i] : cuts[i + 1]]) for i in range(n)]
    found = []
    for i, j in pairs.tolist():
        if root(i) == root(j):
            continue
        k = int(both[i, j]) if both is not None else len(np.intersect1d(ordered[i], ordered[j], assume_unique=True))
        if 100 * k >= percent * (int(size[i]) + int(size[j]) - k):
            parent[root(i)] = root(j)
            found.append((i, j))
    return found


def sketch(s: np.ndarray) -> np.ndarray:
    """Bits that each token turns over. Two sketches differ in no more bits than their sets in tokens."""
    places = (mixed(s * STEP) >> np.uint64(32)).astype(np.int64) % SKETCH_BITS
    return np.packbits(np.bincount(places, minlength=SKETCH_BITS) & 1)


FRONT = "token long, doc long, label long, n int, place int, bits binary"


def front_rows(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """A ``FRONT`` row for each prefix token that occurs elsewhere, from ``doc, label, tokens, at``."""
    for batch in batches:
        names = batch.schema.names
        doc, label, tokens, at = (batch.column(names.index(c)) for c in ("doc", "label", "tokens", "at"))
        for lo in range(0, len(batch), 64):
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in tokens[lo : lo + 64]]
            firsts = at[lo : lo + 64].to_pylist()
            fronts = [s[k : head_length(len(s), percent)] for s, k in zip(sets, firsts, strict=True)]
            each = [len(x) for x in fronts]
            rows = np.repeat(np.arange(len(sets)), each)
            place = np.arange(len(rows)) - np.repeat(np.cumsum(each) - each - np.array(firsts), each)
            cols = [
                np.concatenate(fronts).view(np.int64),
                doc[lo : lo + 64].take(pa.array(rows)),
                label[lo : lo + 64].take(pa.array(rows)),
                np.repeat([len(s) for s in sets], each).astype(np.int32),
                place.astype(np.int32),
                pa.array([sketch(s).tobytes() for s in sets], pa.binary()).take(pa.array(rows)),
            ]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], names=["token", "doc", "label", "n", "place", "bits"])


def pairs_of_lists(table: pa.Table, percent: int) -> np.ndarray:
    """Distinct pairs of ``doc`` that may be similar, from ``FRONT`` rows of the cells ``(token, lo, hi)``
    where ``own`` is the block of a row.

    The smaller of two similar sets has their rarest common token among the first ones that leave room
    for the overlap with a set of its own size, and no list names a token of the other beyond its prefix.
    """
    cols = {c: table[c].to_numpy() for c in ("token", "lo", "hi", "n", "doc", "label", "place", "own")}
    order = np.lexsort([cols[c] for c in ("n", "hi", "lo", "token")])
    token, lo, hi, n, doc, label, place, own = (cols[c][order] for c in ("token", "lo", "hi", "n", "doc", "label", "place", "own"))
    n, place = n.astype(np.int64), place.astype(np.int64)
    bits = np.frombuffer(b"".join(table["bits"].to_pylist()), np.uint64).reshape(len(n), -1)[order]
    cell = np.cumsum(np.r_[False, (np.diff(token) != 0) | (np.diff(lo) != 0) | (np.diff(hi) != 0)])
    most = int(n.max()) + 1
    ends = np.searchsorted(cell * most + n, cell * most + np.minimum(100 * n // percent, most - 1), "right")
    first = np.flatnonzero(place <= n - overlap(2 * n, percent))
    found = []
    todo = np.cumsum(ends[first] - first - 1)
    at = 0
    while at < len(first):
        done = int(todo[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(todo, done + PAIRS_AT_ONCE, "right")))
        some = first[at:to]
        each = ends[some] - some - 1
        x = np.repeat(some, each)
        y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(each) - each, each)
        at = to
        least = overlap(n[x] + n[y], percent)
        rest = np.minimum(n[x] - place[x], n[y] - place[y])
        keep = (rest >= least) & (label[x] != label[y]) & ((lo[x] == hi[x]) | (own[x] != own[y]))
        x, y, least = x[keep], y[keep], least[keep]
        keep = np.bitwise_count(bits[x] ^ bits[y]).sum(1, dtype=np.int64) <= n[x] + n[y] - 2 * least
        a, b = doc[x[keep]], doc[y[keep]]
        found.append(np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0))
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)


def candidate_pairs(rows: DataFrame, percent: int, list_docs: int = LIST_DOCS) -> DataFrame:
    """Pairs ``(a, b)`` of ``rows(doc, label, tokens, at)`` that may be similar and differ in ``label``.

    Documents are listed by the tokens of their prefixes; a long list is cut into blocks, and each two
    blocks meet in a cell of their own.
    """
    rows = stage(rows.select("doc", "label", "tokens", "at").mapInArrow(lambda batches: front_rows(batches, percent), FRONT), "front-rows")
    lists = rows.groupBy("token").agg(F.count("*").alias("docs")).filter("docs > 1")
    lists = lists.withColumn("blocks", F.ceil(F.col("docs") / list_docs).cast("int"))
    total = lists.agg(F.sum(F.col("docs") * F.col("blocks")).alias("s")).first()["s"] or 0
    buckets = max(shuffle_partitions(rows), -(-int(total) // LIST_ROWS))
    rows = rows.join(lists.drop("docs"), "token").withColumn("own", F.pmod(F.xxhash64("doc"), "blocks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")})
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("token", "lo", "hi"), F.lit(buckets))).drop("blocks", "other")

    def paired(table: pa.Table) -> pa.Table:
        found = pairs_of_lists(table, percent)
        return pa.table([pa.array(found[:, 0], pa.int64()), pa.array(found[:, 1], pa.int64())], names=["a", "b"])

    return rows.groupBy("bucket").applyInArrow(paired, "a long, b long").distinct()


def share_heads(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sets share a prefix token under both orders by hash."""
    for turn in (np.uint64(1), OTHER_ORDER):
        heads = [s[np.argsort(s * turn)[: head_length(len(s), percent)]] for s in (x, y)]
        if not len(np.intersect1d(*heads, assume_unique=True)):
            return False
    return True


def linked_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """The keys ``(a, b)`` of similar pairs of ``rows(doc, key, label, tokens, at)`` that differ in ``label``.
    Candidates share a prefix token under the rarest-first order; the other two orders are asked here."""

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for s, t in zip(*(batch.column(batch.schema.names.index(c)) for c in ("s", "t")), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (s, t))
                enough = overlap(len(x) + len(y), percent)
                keep.append(share_heads(x, y, percent) and len(np.intersect1d(x, y, assume_unique=True)) >= enough)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    pairs = stage(candidate_pairs(rows, percent), "candidate-pairs")
    ends = [rows.select(F.col("doc").alias(d), F.col("key").alias(k), F.col("tokens").alias(t)) for d, k, t in (("x", "a", "s"), ("y", "b", "t"))]
    both = pairs.toDF("x", "y").join(ends[0], "x").join(ends[1], "y")
    return both.select("a", "b", "s", "t").mapInArrow(similar, "a long, b long")


def similar_groups(docs: DataFrame, words: int = 5, percent: int = 80, group_docs: int = GROUP_DOCS) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``docs(doc_id, text)``.

    Two documents link when ``100 * intersection >= percent * union`` of their shingle sets of
    ``words`` words; the component is the smallest id reachable. A null or blank text has no shingle
    and links with nothing. Rows that share an id are one document to the links. A null id counts as
    one document after all others, with a null component if it reaches no other.
    """
    base = docs.select(id_key().alias("key"), text_or_empty().alias("text"))
    base = base.withColumn("h", F.sha2("text", 256))
    blocks = block_count(base, F.octet_length("text"))
    buckets = blocks
    base = base.withColumn("block", F.pmod(F.xxhash64("key", "h"), F.lit(blocks)).cast("int"))
    ids, copies = copies_of(base)
    texts = base.select("block", "key", "h", "text")
    none = F.lit(None).cast("binary")
    copies = copies.select("*", none.alias("hashes"), none.alias("counts"))

    def sets_of(table: pa.Table, side: pa.Table) -> tuple[list[int], list[str], list[np.ndarray]]:
        skip = {x for x in zip(side["key"].to_pylist(), side["h"].to_pylist(), strict=True)}
        keep, keys, hs = [], [], []
        for i, x in enumerate(zip(table["key"].to_pylist(), table["h"].to_pylist(), strict=True)):
            if x not in skip:
                skip.add(x)
                keep.append(i)
                keys.append(x[0])
                hs.append(x[1])
        data, offsets = utf8(table["text"].take(pa.array(keep, pa.int64())))
        return keys, hs, shingle_sets(data, offsets, words)

    def head(s: np.ndarray) -> np.ndarray:
        return s[: head_length(len(s), percent) + extra(len(s), percent) - 1]

    def counted(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))

    def low_hashes(key: tuple, table: pa.Table, side: pa.Table) -> pa.Table:
        _, _, sets = sets_of(table, side)
        return hash_rows(key[0].as_py(), *counted([head(s) for s in sets]), buckets)

    def after_low(key: tuple, table: pa.Table, side: pa.Table) -> pa.Table:
        keys, hs, sets = sets_of(table, side)
        found = side.filter(pc.is_valid(side["hashes"]))
        known, times = joined_found(found["hashes"].to_pylist(), found["counts"].to_pylist())
        rest = []
        for s in sets:
            least = extra(need(len(s), percent), percent)
            rest.append(s.tobytes() if len(s) and (lookup(head(s), known, times) > 1).sum() >= least else None)
        cols = [keys, hs, [len(s) for s in sets], rest]
        return pa.table(cols, schema=pa.schema([("key", pa.int64()), ("h", pa.string()), ("n", pa.int64()), ("tokens", pa.binary())]))

    grouped = texts.groupBy("block")
    low = grouped.cogroup(copies.groupBy("b")).applyInArrow(low_hashes, HASHES)
    found = repeated_hashes(low).select("block", F.lit(None).cast("long").alias("key"), F.lit(None).cast("string").alias("h"), "hashes", "counts")
    sets = grouped.cogroup(copies.union(found).groupBy("b")).applyInArrow(after_low, "key long, h string, n long, tokens binary")
    sets = stage(sets, "shingle-sets")

    left = sets.filter("tokens is not null")
    parts = block_count(left, F.octet_length("tokens"))
    left = left.select(F.pmod(F.xxhash64("key", "h"), F.lit(parts)).cast("int").alias("block"), "key", "n", "tokens")

    def all_hashes(key: tuple, table: pa.Table) -> pa.Table:
        own = [np.frombuffer(x, np.uint64) for x in table["tokens"].to_pylist()]
        return hash_rows(key[0].as_py(), *counted(own), parts)

    def ordered(key: tuple, table: pa.Table, side: pa.Table) -> pa.Table:
        known, times = joined_found(side["hashes"].to_pylist(), side["counts"].to_pylist())
        cols: list[list] = [[], [], [], []]
        for k, x in zip(table["key"].to_pylist(), table["tokens"].to_pylist(), strict=True):
            s = np.frombuffer(x, np.uint64)
            often = lookup(s, known, times)
            if (often > 1).sum() >= need(len(s), percent):
                order = np.lexsort((s, often))
                s, often = s[order], often[order]
                p = head_length(len(s), percent)
                front = s[:p][often[:p] > 1].view(np.int64)
                for c, v in zip(cols, (k, s.tobytes(), p - len(front), front), strict=True):
                    c.append(v)
        return pa.table(cols, schema=pa.schema([("key", pa.int64()), ("tokens", pa.binary()), ("at", pa.int32()), ("front", pa.list_(pa.int64()))]))

    often = repeated_hashes(left.groupBy("block").applyInArrow(all_hashes, HASHES))
    near = stage(left.groupBy("block").cogroup(often.groupBy("block")).applyInArrow(ordered, "key long, tokens binary, at int, front array<long>"), "near-sets")

    fronts = near.select("key", F.explode("front").alias("token"))
    hubs = fronts.groupBy("token").agg(F.min("key").alias("hub"), F.max("key").alias("top")).filter("hub < top").drop("top")
    tied = linked_groups(fronts.join(hubs, "token").filter("key != hub").select(F.col("key").alias("a"), F.col("hub").alias("b")))
    members = stage(near.drop("front").join(tied, near["key"] == tied["node"]).drop("node"), "candidate-groups")
    sizes = members.groupBy("group").agg(F.ceil(F.count("*") / group_docs).cast("int").alias("parts"))
    members = members.join(sizes, "group").withColumn("part", F.pmod(F.xxhash64("key"), "parts").cast("int"))

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        keys = table["key"].to_pylist()
        own = [np.frombuffer(x, np.uint64) for x in table["tokens"].to_pylist()]
        pairs = links_within(own, percent) if len(own) > 1 else []
        pairs = [(keys[i], keys[j]) for i, j in pairs]
        return pa.table([[a for a, _ in pairs], [b for _, b in pairs]], schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    # Each part of a large group also gets the group's first document, which ties most of them.
    first_to_all = F.when(F.col("key") == F.col("group"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array("part"))
    round_one = members.select("group", F.explode(first_to_all).alias("p"), "key", "tokens")
    links = stage(round_one.groupBy("group", "p").applyInArrow(compare, "a long, b long"), "links")
    split = members.filter("parts > 1").withColumn("doc", F.monotonically_increasing_id())
    if not split.isEmpty():
        split = stage(split.select("doc", "key", "tokens", "at"), "split-groups")
        # First one document of each set of linked ones, which ties most, then all that are not linked yet.
        for heads_only in (True, False):
            label = linked_groups(links).withColumnRenamed("group", "label")
            rows = split.join(label, split["key"] == label["node"], "left").drop("node").withColumn("label", F.coalesce("label", "key"))
            rows = stage(rows.filter("key = label") if heads_only else rows, "labelled-sets")
            links = stage(links.union(linked_pairs(rows, percent)), "linked-pairs")
    label = linked_groups(links)
    return (
        ids.join(sets.select("h", "n").distinct(), "h")
        .join(label, F.when(F.col("n") > 0, F.col("first")) == label["node"], "left")
        .select(
            id_back("key").alias("doc_id"),
            F.col("n").alias("n_shingles"),
            F.coalesce("group", F.when(F.col("n") > 0, F.col("first")).otherwise(F.col("key"))).alias("component"),
        )
        .select("doc_id", "n_shingles", id_back("component").alias("component_id"))
    )
