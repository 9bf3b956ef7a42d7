"""Every link of a class is counted."""

import random

import numpy as np

from helpers import prose, words
from helpers import rows_of
from starmart.llm.ngram_join import ngram_classes, ngram_links, ngram_set, similar_counts


def _links(sets):
    return [sum(len(a & b) >= 0.8 * len(a | b) for j, b in enumerate(sets) if i != j) for i, a in enumerate(sets)]


def _near_copies(rng, n):
    base = prose(rng, 150, 5000)
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(1, 4)):
            copy[rng.randrange(150)] = f"changed{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def test_counts_of_blocks_against_brute_force():
    rng = random.Random(41)
    sets = [ngram_set(t, 5) for t in _near_copies(rng, 30)]
    want = _links([set(s.tolist()) for s in sets])
    rows = [(i % 2, i, s) for i, s in enumerate(sets)]
    got = np.zeros(30, int)
    for low, high in ((0, 0), (0, 1), (1, 1)):
        for node, n in similar_counts([r for r in rows if r[0] in (low, high)], ("r", low, high), 0.8, width=64):
            got[node] += n
    assert got.tolist() == want


def test_links_inside_a_connected_class_are_counted(spark):
    rng = random.Random(42)
    texts = [*_near_copies(rng, 60), *_near_copies(rng, 2), *(" ".join(prose(rng, 90)) for _ in range(5))]
    grams = [{tuple(words(t)[i:i + 5]) for i in range(len(words(t)) - 4)} for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_links"] for r in ngram_classes(docs).collect()}
    assert [got[i] for i in range(len(texts))] == _links(grams)


def test_classes_without_counted_links(spark):
    rng = random.Random(44)
    texts = [*_near_copies(rng, 30), *(" ".join(prose(rng, 90)) for _ in range(5)), ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bare = ngram_classes(docs, count_links=False)
    assert bare.where("n_links IS NOT NULL").isEmpty()
    assert rows_of(bare.drop("n_links")) == rows_of(ngram_classes(docs).drop("n_links"))


def test_strangers_around_a_shared_passage_lose_no_link(spark):
    """A family at 0.6 to 0.95 around one passage: most members are no partners
    of the hub, and some are linked only with each other, in few of the buckets
    that they share."""
    rng = random.Random(45)
    base = prose(rng, 150, 5000)
    texts = []
    for _ in range(40):
        one = list(base)
        for _ in range(rng.randrange(3, 9)):
            one[rng.randrange(150)] = f"own{rng.randrange(10**6)}"
        texts.append(one)
        if rng.random() < 0.5:
            two = list(one)
            for _ in range(rng.randrange(1, 5)):
                two[rng.randrange(150)] = f"own{rng.randrange(10**6)}"
            texts.append(two)
    sets = [{tuple(t[i:i + 5]) for i in range(146)} for t in texts]
    group = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    assert 2 < len(set(group)) < len(sets)
    want = [min(k for k in range(len(sets)) if group[k] == g) for g in group]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    for hubs in (1, 64):
        got = {r["doc_id"]: r["class_id"] for r in ngram_classes(docs, first_hubs=hubs).collect()}
        assert [got[i] for i in range(len(sets))] == want
    # a pair is linked once, however many buckets it shares
    links = ngram_links(docs)[1]
    assert links.count() == links.select("a", "b").distinct().count()
