"""The pipeline's near-dedup against all pairs of texts with a five-word similarity of 0.8 or more."""

import random
from collections import Counter, defaultdict

import numpy as np

from haplospark.llm import simhash


def plain_set(text):
    words = [w.lower() for w in (text or "").encode().split()]
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def similar_pairs(texts):
    """Positions of all pairs at 0.8 or more: they share one of the rarest fifth of the shingles."""
    sets = [plain_set(t) for t in texts]
    often, seen, pairs = Counter(s for one in sets for s in one), defaultdict(list), set()
    for k, one in enumerate(sets):
        for s in sorted(one, key=lambda s: (often[s], s))[: len(one) - -(-len(one) * 4 // 5) + 1]:
            for other in seen[s]:
                both = len(one & sets[other])
                if 5 * both >= 4 * (len(one) + len(sets[other]) - both):
                    pairs.add((other, k))
            seen[s].append(k)
    return pairs


def plain_kept(rows):
    """Smallest doc_id of each group; texts without words are one group."""
    texts = [t for _, t in rows]
    empty = [k for k, t in enumerate(texts) if not plain_set(t)]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in [*similar_pairs(texts), *zip(empty, empty[1:], strict=False)]:
        parent[root(a)] = root(b)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        least[root(k)] = min(least.get(root(k), doc_id), doc_id)
    return set(least.values())


def edited(draw, words, share):
    """A copy with so many edits that about ``share`` of all shingles are common to both."""
    found = list(words)
    while True:
        found[draw.randrange(len(found))] = "e%x" % draw.getrandbits(40)
        a, b = plain_set(" ".join(words)), plain_set(" ".join(found))
        if len(a & b) < share * len(a | b):
            return " ".join(found)


def test_recall_and_threshold(spark):
    draw, rows = random.Random(3), []
    for k in range(400):
        words = ["w%x" % draw.getrandbits(30) for _ in range(draw.randint(150, 600))]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, edited(draw, words, 0.83 if k % 4 else 0.78))]
    near = similar_pairs([t for _, t in rows])
    far = {2 * k + 1 for k in range(400)} - {b for _, b in near}
    assert len(near) >= 280 and len(far) >= 90
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    kept = {r["doc_id"] for r in simhash.keep_one_of_each(docs).collect()}
    assert kept == plain_kept(rows) == {2 * k for k in range(400)} | far
    small = simhash.SETS
    simhash.SETS = 3
    many = [(k, edited(random.Random(k), words, 0.95)) for k in range(40)]
    assert [r["doc_id"] for r in simhash.keep_one_of_each(spark.createDataFrame(many, docs.schema)).collect()] == [0]
    simhash.SETS = small


def test_whole_table(spark):
    """Recall on the given texts: edited copies go, and nothing that is not linked to one."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    texts = {t for _, t in rows}
    pairs = similar_pairs(sorted(texts))
    kept = {r["doc_id"] for r in simhash.keep_one_of_each(docs).select("doc_id").collect()}
    assert len(pairs) >= 40 and kept == plain_kept(rows)


def test_links_are_a_forest_of_all_near_pairs():
    draw = np.random.default_rng(4)
    fps = np.unique(draw.integers(0, 2**64, 700, dtype=np.uint64) & np.uint64(0xFFFFFFFFFFF))
    refs = np.array(simhash.pivots()).astype(np.uint64)
    distances = np.bitwise_count(fps[:, None] ^ refs[None, :]).astype(np.int16)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= simhash.WIDE_RADIUS
    forest = list(simhash.wide_links(fps, distances))
    groups = list(range(len(fps)))
    for a, b in forest:
        assert near[a, b] and groups[a] != groups[b]
        groups = [groups[b] if g == groups[a] else g for g in groups]
    assert all(groups[a] == groups[b] for a, b in zip(*np.nonzero(near), strict=True))


def test_close_fingerprints_are_candidates_without_a_common_band(spark):
    """Fingerprints within two bits meet by their own bits, also where no band of minimum hashes is shared."""
    text = " ".join(f"word{k}" for k in range(300))
    docs = spark.createDataFrame([(1, text), (2, f"{text} more"), (3, f"{text} again")], "doc_id bigint, text string")
    rows = [(1, 0x0FFF, [1, 2], "a"), (2, 0x0FFC, [3, 4], "b"), (3, 0x0FE3, [5, 6], "c")]
    signed = spark.createDataFrame(rows, "_key bigint, _fp bigint, _bands array<bigint>, _node string")
    found = simhash.similar_links_of(docs, docs["doc_id"], signed).collect()
    assert [sorted(r) for r in found] == [["a", "b"]]


def test_short_texts_lose_no_link(spark):
    """Pairs of four and five shingles: one more sets many bits, and rarely leaves a band of minimum hashes as it was."""
    draw, rows = random.Random(14), []
    for k in range(4000):
        words = ["v%x" % draw.getrandbits(40) for _ in range(9)]
        rows += [(2 * k, " ".join(words[:8])), (2 * k + 1, " ".join(words if k % 2 else ["b%x" % k, *words[:8]]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert {r["doc_id"] for r in simhash.keep_one_of_each(docs).select("doc_id").collect()} == set(range(0, 8000, 2))


def test_what_discards_candidates_loses_none():
    """Similar sets share one of their rarest shingles, and are close by size and parity, at any size."""
    draw = np.random.default_rng(5)
    counts = draw.integers(0, 200, 1 << simhash.COUNT_BITS, dtype=np.uint64).astype(np.uint8)
    for size in (1, 4, 5, 9, 63, 64, 65, 130, 1000, 70_000):
        whole = np.unique(draw.integers(0, 2**64, size, dtype=np.uint64))
        for cut in {0, size // 10, size - -(-size * 4 // 5)}:
            part = np.sort(draw.choice(whole, len(whole) - cut, replace=False))
            assert simhash.similar(whole, part)
            assert set(simhash.rarest(whole, counts).tolist()) & set(simhash.rarest(part, counts).tolist())
            sizes, parities = [len(whole), len(part)], [simhash.parity(whole), simhash.parity(part)]
            assert len(list(simhash.close_sets(sizes, parities))) == 1
    other = np.unique(draw.integers(0, 2**64, 1000, dtype=np.uint64))
    whole = np.unique(draw.integers(0, 2**64, 1000, dtype=np.uint64))
    assert not list(simhash.close_sets([1000, 1000], [simhash.parity(whole), simhash.parity(other)]))
