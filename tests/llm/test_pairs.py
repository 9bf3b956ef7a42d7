"""N-gram join, passages and components against brute force."""

import collections
import random

import numpy as np
import pytest

from conftest import SF_SMALL
from helpers import odd_table, prose, rows_of, with_clashes, words
from starmart.llm.common import documents
from starmart.llm.graph import components
from starmart.llm.ngram_join import band_hashes, choose_bands, ngram_classes, ngram_links, ngram_set
from starmart.llm.substring_dedup import (_common, _extend, _extend_all, align, chains, minimizers, repeated_passages, seeds_of)
from starmart.llm.hashing import word_hashes


class Sets(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self[b] = a


# components

@pytest.mark.parametrize("n, m", [(30, 10), (200, 190), (60, 400)])
def test_components_against_union_find(spark, n, m):
    rng = random.Random(n)
    links = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(1000 + i, 1001 + i) for i in range(40)]
    sets = Sets()
    for a, b in links:
        sets.join(a, b)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert set(got) == linked
    groups = collections.defaultdict(set)
    for node, root in got.items():
        groups[root].add(sets.find(node))
    assert all(len(g) == 1 for g in groups.values())
    assert len(groups) == len({sets.find(x) for x in linked})


def test_components_of_nothing(spark):
    empty = spark.createDataFrame([(3, 3), (None, 1)], "a long, b long")
    assert components(empty).collect() == []


# n-gram join

def _grams(text, n=5):
    w = words(text)
    n = min(n, len(w))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if w else frozenset()


def _brute_classes(rows, similarity=0.8):
    """Class members by position, from all pairs."""
    sets, grams = Sets(), [_grams(t) for _, t in rows]
    holders = collections.defaultdict(list)
    for k, g in enumerate(grams):
        sets.find(k)
        for x in g:
            holders[x].append(k)
    common = collections.Counter((a, b) for h in holders.values() for i, b in enumerate(h) for a in h[:i])
    for (a, b), c in common.items():
        if c / (len(grams[a]) + len(grams[b]) - c) >= similarity:
            sets.join(a, b)
    out = collections.defaultdict(list)
    for k in range(len(rows)):
        out[sets.find(k)].append(rows[k][0])
    return out


def _same_classes(got, rows):
    want = []
    for ids in _brute_classes(rows).values():
        low = min(ids, key=lambda i: (i is None, i))
        want += [(i, low, len(ids)) for i in ids]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(((r["doc_id"], r["class_id"], r["class_size"]) for r in got), key=key) == sorted(want, key=key)


def test_bands_reach_the_recall():
    for s, recall in ((0.8, 0.9999), (0.5, 0.99), (1.0, 0.9)):
        bands, rows = choose_bands(s, recall, 256)
        assert 1 - (1 - s ** rows) ** bands >= recall
    with pytest.raises(ValueError):
        choose_bands(0.2, 0.9999, 3)


def test_band_hashes_estimate_similarity():
    rng = np.random.default_rng(0)
    common, a, b = (np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (800, 100, 100))
    one = band_hashes(np.union1d(common, a), 1000, 1, 0)
    two = band_hashes(np.union1d(common, b), 1000, 1, 0, block=64)
    assert abs((one == two).mean() - 0.8) < 0.05


def test_classes_of_shipped_rows(spark):
    docs = documents(spark, SF_SMALL)
    _same_classes(ngram_classes(docs).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_classes_of_odd_rows(spark):
    docs = odd_table(spark)
    _same_classes(ngram_classes(with_clashes(docs)).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert ngram_classes(docs.limit(0)).count() == 0


def test_chained_copies_and_many_near_copies(spark):
    """Neighbours of a drifting series are similar, its ends are not; a large
    group of near copies has strangers that share many of its n-grams."""
    rng = random.Random(8)
    rows, text = [], prose(rng, 200, 5000)
    for i in range(40):
        rows.append((i, " ".join(text)))
        text = text[4:] + prose(rng, 4, 5000)
    base = prose(rng, 150, 5000)
    for i in range(100, 180):
        copy = list(base)
        copy[rng.randrange(150)] = "changed"
        rows.append((i, " ".join(copy)))
    for i in range(200, 230):
        copy = base[:rng.randrange(105, 140)]
        rows.append((i, " ".join(copy + prose(rng, 150 - len(copy), 5000))))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    _same_classes(ngram_classes(docs, first_hubs=2).collect(), rows)
    _, links, _ = ngram_links(docs)
    # a group costs about one link per member, not one per pair
    assert links.count() < 6 * len(rows)
    grams = {}
    members = {bytes(r["node"]): r["id"] for r in ngram_links(docs)[0].collect()}
    texts = dict(rows)
    for r in links.collect():
        a, b = (grams.setdefault(k, _grams(texts[members[bytes(k)]])) for k in (bytes(r["a"]), bytes(r["b"])))
        assert r["jaccard"] == pytest.approx(len(a & b) / len(a | b)) and r["jaccard"] >= 0.8 - 1e-12
    assert len(ngram_set(rows[0][1], 5)) == len(_grams(rows[0][1]))


# passages

def test_minimizers_are_shared_by_equal_runs():
    rng = random.Random(6)
    run = prose(rng, 40, 1000)
    one, two = (word_hashes(" ".join(prose(rng, n, 1000) + run + prose(rng, n, 1000))) for n in (33, 71))
    (k1, x1), (k2, x2) = seeds_of(one, 6, 16), seeds_of(two, 6, 16)
    shared = set(k1.tolist()) & set(k2.tolist())
    assert shared
    at1, at2 = dict(zip(k1.tolist(), x1.tolist())), dict(zip(k2.tolist(), x2.tolist()))
    assert all(at2[k] - at1[k] == 38 for k in shared)
    assert minimizers(np.array([5, 3, 4]), 16).tolist() == [1]
    same = seeds_of(word_hashes("la " * 60), 6, 16)[0]
    assert len(set(same.tolist())) == len(same) == 40  # every occurrence is a key of its own


def test_best_chain_against_quadratic_search():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randrange(1, 14)
        pts = list({(rng.randrange(60), rng.randrange(60)) for _ in range(n)})
        x, y = np.array([p[0] for p in pts]), np.array([p[1] for p in pts])
        found = chains(x, y, 6, 1000)
        assert sorted(i for c in found for i in c) == list(range(len(pts)))
        for c in found:
            assert all(x[b] > x[a] and y[b] > y[a] for a, b in zip(c, c[1:]))
        score = {}
        for p in sorted(pts):
            score[p] = 6 + max([0.0, *(score[q] - 0.25 * (p[0] - q[0] + p[1] - q[1])
                                       for q in score if q[0] < p[0] and q[1] < p[1])])
        c = found[0]
        assert 6 * len(c) - 0.25 * (x[c[-1]] - x[c[0]] + y[c[-1]] - y[c[0]]) == pytest.approx(max(score.values()))


def test_alignment_pieces():
    assert _common([1, 2, 3, 4], [2, 9, 4]) == 2
    assert _common([], [1]) == 0
    assert _extend([1, 2, 3, 9, 4, 5, 6], [1, 2, 3, 8, 4, 5, 6]) == (7, 7, 6)
    assert _extend([1, 2, 3, 4, 5, 6], [1, 2, 3, 8, 8, 4, 5, 6, 7]) == (6, 8, 6)
    assert _extend([1, 2], [3, 4]) == (0, 0, 0)
    assert _extend_all(np.arange(3000), np.delete(np.arange(3000), 1500)) == (3000, 2999, 2999)
    a = np.arange(100)
    b = np.concatenate((np.arange(500, 507), a[10:40], [999], a[41:90], [7, 7]))
    assert align(a, b, [12, 30, 60], [9, 27, 57], 6) == (10, 90, 7, 87, 79 / 80)


def _spans(rows, doc):
    return [(r["start_word"], r["end_word"]) for r in rows if r["doc_id"] == doc] + [
        (r["source_start"], r["source_end"]) for r in rows if r["source_id"] == doc]


def test_planted_passages_and_clean_rows(spark):
    rng = random.Random(21)
    rows, planted = [], {}
    exact = [prose(rng, n, 50_000) for n in (55, 80, 300)]
    fuzzy = prose(rng, 120, 50_000)
    for i in range(120):
        before = prose(rng, rng.randrange(200), 50_000)
        after = prose(rng, rng.randrange(200), 50_000)
        middle = []
        if i < 60:
            middle = exact[i % 3]
        elif i < 80:  # one word in twenty-three replaced, dropped or doubled
            middle = [x for w in fuzzy for x in rng.choices([[w], ["other"], [], [w, w]], [66, 1, 1, 1])[0]]
        if middle:
            planted[i] = (len(before), len(before) + len(middle))
        rows.append((i, " ".join(before + middle + after)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = repeated_passages(docs).collect()
    assert {r["doc_id"] for r in found} | {r["source_id"] for r in found} == set(planted)
    for i, (start, end) in planted.items():
        spans = _spans(found, i)
        slack = 0 if i < 60 else 20
        # random words next to the passage do not match
        assert any(s <= start + slack and e >= end - slack for s, e in spans), i
        assert all(s >= start - 8 and e <= end + 8 for s, e in spans), i
    assert all(r["doc_id"] > r["source_id"] and r["similarity"] >= 0.8 and r["n_words"] >= 50 for r in found)
    # a passage in twenty documents costs rows by its holders, not by their pairs
    assert len(found) < 4 * len(planted)


def test_exact_repeats_of_shipped_rows_are_covered(spark):
    docs = documents(spark, SF_SMALL)
    found = repeated_passages(docs).collect()
    texts = {r["doc_id"]: words(r["text"]) for r in docs.collect()}
    holders = collections.defaultdict(set)
    for i, w in texts.items():
        for j in range(len(w) - 49):
            holders[tuple(w[j:j + 50])].add(i)
    total = missed = 0
    for i, w in texts.items():
        covered = {p for s, e in _spans(found, i) for p in range(s, e)}
        for j in range(len(w) - 49):
            if len(holders[tuple(w[j:j + 50])]) > 1:
                total += 1
                missed += not {j, j + 25, j + 49} <= covered
    assert total and missed == 0
    caught = {r["doc_id"] for r in found} | {r["source_id"] for r in found}
    assert {i for h in holders.values() if len(h) > 1 for i in h} <= caught


def test_passages_of_odd_rows(spark):
    docs = odd_table(spark)
    found = repeated_passages(with_clashes(docs)).collect()
    pairs = {(r["doc_id"], r["source_id"]) for r in found}
    assert {(9, 7), (8, 7), (8, 8), (11, 10), (13, 12)} <= pairs
    assert not {r["doc_id"] for r in found} & {None, 1, 2, 3, 4, 5, 6, 14, 16}
    assert [r["n_words"] for r in found if (r["doc_id"], r["source_id"]) == (13, 12)] == [600 * 40]
    assert repeated_passages(docs.limit(0)).count() == 0
    assert repeated_passages(docs.limit(0)).columns == repeated_passages(docs).columns
    assert rows_of(repeated_passages(docs.repartition(3))) == rows_of(repeated_passages(docs))
