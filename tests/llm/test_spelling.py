"""Spelling variants against words changed letter by letter."""

import random
import re
import zlib
from collections import Counter

import pytest

from conftest import SF_SMALL
from helpers import odd_rows, odd_table, rows_of, with_clashes
from starmart.llm.common import documents
from starmart.llm.queries import op13_spelling_variants
from starmart.llm.spelling import _blocks, _GAP, last_forms, near_words, spelling_variants

ALPHABET = [*map(chr, range(ord("a"), ord("z") + 1)), *map(chr, range(0xC0, 0x100))]


def near_of(word, known, alphabet=ALPHABET):
    out = set()
    for i in range(len(word) + 1):
        rest = word[i:]
        out |= {word[:i] + rest[1:]} if rest else set()
        for c in alphabet:
            out.add(word[:i] + c + rest)
            if rest:
                out.add(word[:i] + c + rest[1:])
    return (out & known) - {word}


def plain(docs, slip_every=199, min_length=6, min_count=5, ratio=5):
    counts = Counter()
    for doc_id, text, *_ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % slip_every == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            counts[word] += 1
    n = {w: k for w, k in counts.items() if len(w) >= min_length and k >= min_count}
    near = {w: near_of(w, set(n)) for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= ratio * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((form.get(w), n.get(form.get(w)), n[w], len(near[w]), root, w))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


COLUMNS = ("form", "form_n", "n", "n_near", "root", "word")


def spelt_docs():
    rng = random.Random(8)
    letters = "abAé"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 9))) for _ in range(300)]
    rows = list(odd_rows())
    for i in range(200, 260):
        rows.append((i if i % 7 else None, "-".join(words[int(rng.random() ** 3 * 300)] for _ in range(400)), "en", "s", 1))
    return rows + [rows[-1]] * 3


@pytest.mark.parametrize("slip_every", [199, 3])
def test_against_plain_loops(spark, slip_every):
    docs = spelt_docs()
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    got = spelling_variants(with_clashes(df).repartition(5), slip_every=slip_every, flush=50)
    want = plain(docs, slip_every)
    assert sum(r[0] is not None for r in want) > 10
    assert rows_of(got, *COLUMNS) == want


def test_shipped_rows(spark):
    docs = [(r["doc_id"], r["text"]) for r in documents(spark, SF_SMALL).collect()]
    assert rows_of(op13_spelling_variants(spark, SF_SMALL), *COLUMNS) == plain(docs)


@pytest.mark.parametrize("limits", [{}, {"most": 2}, {"most": 70}, {"most_letters": 60}])
def test_dense_words_in_groups_of_any_size(spark, limits):
    """Words over two letters, so that groups are large and letters too many
    may stand at several places; large groups are split without a loss."""
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(6, 11))) for _ in range(1500)}
                   | {"a" * k for k in range(6, 90)} | {"a" * k + "ÿ" for k in (6, 7, 64, 65, 66, 3000, 3001)})
    rng.shuffle(words)
    rank = {w: i + 1 for i, w in enumerate(words)}
    want = {}
    for w in words:
        if len(w) < 100 and (near := near_of(w, set(words), "abÿ")):
            want[rank[w]] = (len(near), min(rank[v] for v in near))
    for a, b in ((3000, 3001), (3001, 3000)):
        want[rank["a" * a + "ÿ"]] = (1, rank["a" * b + "ÿ"])
    vocab = spark.createDataFrame([(i, w) for w, i in rank.items()], "rank long, word string").repartition(3)
    assert {r["rank"]: (r["n_near"], r["best"]) for r in near_words(vocab, 6, **limits).collect()} == want


def test_chains_end_at_the_last_form(spark):
    chain = [(i, i - 1) for i in range(2, 12)] + [(50, 5)]
    got = {r["rank"]: r["root"] for r in last_forms(spark.createDataFrame(chain, "rank long, form long")).collect()}
    assert got == {i: 1 for i, _ in chain}


def test_blocks_keep_runs_whole():
    text = "Word " * 50 + "x" * 100 + " éa1b" * 30
    for size in (1, 7, 60, 10_000):
        parts = list(_blocks(text, size))
        assert [w for p in parts for w in _GAP.split(p) if w] == [w for w in _GAP.split(text) if w]


def test_empty_table(spark):
    full = spelling_variants(odd_table(spark))
    empty = spelling_variants(odd_table(spark).limit(0))
    assert empty.count() == 0 and empty.schema == full.schema
    with pytest.raises(ValueError):
        spelling_variants(odd_table(spark), ratio=1)
