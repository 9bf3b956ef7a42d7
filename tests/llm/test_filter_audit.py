"""The filter audit against plain loops over documents and orders."""

import random
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pytest

from helpers import odd_table, rows_of, with_clashes, words
from starmart.llm.filter_audit import audit_filters, audit_masks, removal_steps
from starmart.llm.oracles import ORACLE_SQL

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


def audited_docs():
    """Odd rows, and short texts that fail every mixture of filters."""
    from helpers import odd_rows

    rng = random.Random(9)
    rows = list(odd_rows())
    for i in range(100, 220):
        n = rng.choice([5, 99, 100, 130])
        w = [rng.choice(["x", "Y", "zz", "AB"]) + str(k if rng.random() < 0.9 else 1) for k in range(n)]
        text = " ".join(w) + rng.choice(["", " #", " ok", "$"])
        rows.append((i, text, rng.choice(["en", "de", None, ""]), "s", 1))
        if rng.random() < 0.3:
            rows.append((rng.choice([i, i + 1000, None, 50]), text, rng.choice(["en", "de"]), "s", 1))
    return rows


def audited_labels():
    rng = random.Random(3)
    rows = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 1300, 2)]
    return rows + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (100, None, None)]


def plain(docs, labels):
    least = {}
    for d, text, *_ in docs:
        if d is not None:
            least[text or ""] = min(least.get(text or "", d), d)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    masks = Counter()
    for d, text, lang, *_ in docs:
        text = text or ""
        w = words(text)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w),
                 "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
                 "D": any(c in "#$%&*|" for c in text), "E": d is not None and d > least[text]}
        masks[lang or "", frozenset(f for f in fails if fails[f]), d in good, d in toxic] += 1
    out = []
    for part in {p for p, *_ in masks}:
        mine = [(m, g, t, n) for (p, m, g, t), n in masks.items() if p == part]
        shapley, rows = Counter(), []
        for order in permutations("ABCDE"):
            left = list(mine)
            for k, f in enumerate(order):
                hit = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                removed = sum(x[3] for x in hit)
                shapley[f] += removed
                rows.append((f, part, "".join(order), k + 1, sum(x[3] for x in left), removed,
                             sum(n for m, _, _, n in mine if f in m) - removed,
                             sum(n for m, _, _, n in mine if m == {f}),
                             sum(x[3] for x in hit if x[1]), sum(x[3] for x in hit if x[2])))
        out += [(*r[1:], shapley[r[0]]) for r in rows]
    return out


COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_against_plain_loops(spark):
    docs, labels = audited_docs(), audited_labels()
    df = audit_filters(with_clashes(spark.createDataFrame(docs, DOCS)).repartition(5),
                       spark.createDataFrame(labels, LABELS).selectExpr("*", "1 AS id", "'x' AS part", "2 AS g", "3 AS mask"))
    assert rows_of(df, *COLUMNS) == in_order(plain(docs, labels))


def test_against_sql(spark):
    docs, labels = audited_docs(), audited_labels()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", docs)
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INT, toxic INT)")
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", labels)
    found = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLE_SQL['op12_filter_audit']})").fetchall()
    assert in_order(found) == in_order(plain(docs, labels))


def test_empty_tables(spark):
    docs, labels = odd_table(spark), spark.createDataFrame(audited_labels(), LABELS)
    assert audit_filters(docs.limit(0), labels).count() == 0
    bare = audit_filters(docs, labels.limit(0))
    assert bare.count() == 600 * docs.selectExpr("coalesce(lang, '')").distinct().count()
    assert bare.where("good_lost + toxic_lost > 0").isEmpty()
    assert audit_filters(docs.limit(0), labels).schema == bare.schema


def test_other_numbers_of_filters(spark):
    rng = random.Random(1)
    for letters in ("X", "PQR", "ABCDEF"):
        rows = [("p", m, rng.randrange(9), rng.randrange(3), rng.randrange(3)) for m in range(1 << len(letters))]
        df = audit_masks(spark.createDataFrame(rows, "part string, mask int, n long, good long, toxic long"), letters)
        got = {(r["filter_order"], r["step"]): r for r in df.collect()}
        for order in rng.sample(["".join(p) for p in permutations(letters)], min(6, len(list(permutations(letters))))):
            left = {m: n for _, m, n, _, _ in rows}
            for k, f in enumerate(order):
                bit = 1 << letters.index(f)
                removed = sum(n for m, n in left.items() if m & bit)
                left = {m: n for m, n in left.items() if not m & bit}
                assert (got[order, k + 1]["removed"], got[order, k + 1]["kept"]) == (removed, sum(left.values()))
    with pytest.raises(ValueError):
        audit_masks(df, "AA")


def test_min_plus_product():
    rng = np.random.default_rng(2)
    masks, steps = rng.random((7, 4)) < 0.4, np.argsort(rng.random((9, 4)), axis=1) + 1
    got = removal_steps(masks, steps)
    for o in range(9):
        for m in range(7):
            assert got[o, m] == min((steps[o, f] for f in range(4) if masks[m, f]), default=np.inf)
