"""The mix, exact dedup, shards and quality rules beyond their SQL forms."""

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash

from conftest import SF_SMALL
from helpers import odd_table, prose, rows_of, with_clashes, words
from starmart.llm.common import documents
from starmart.llm.exact_dedup import exact_dedup
from starmart.llm.mix import mix_sources, water_fill
from starmart.llm.quality import judge_quality, quality_rules
from starmart.llm.queries import op2_mix_sources
from starmart.llm.shards import Shard, assign_shards, grow, shard_tree


def _python_in(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_native_plans_have_no_python(spark):
    docs = documents(spark, SF_SMALL)
    for df in (exact_dedup(docs), assign_shards(docs), quality_rules(docs), mix_sources(docs)):
        assert not _python_in(df)


# mix

def test_taken_is_near_target_and_capped(spark):
    rows = op2_mix_sources(spark, SF_SMALL).join(documents(spark, SF_SMALL).select("doc_id", "source"), "doc_id").collect()
    taken, size, target = Counter(), Counter(), {}
    largest = max(r["size"] for r in rows)
    for r in rows:
        assert r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        size[r["source"]] += r["size"]
        target[r["source"]] = r["target"]
    assert math.isclose(sum(target.values()), 1.5 * sum(size.values()))
    for s in size:
        assert target[s] <= 2 * size[s] and abs(taken[s] - target[s]) <= largest


def test_water_fill_against_plain_loop(spark):
    rng = random.Random(2)
    sources = [(f"s{i}", rng.choice([0, 1, 5, 40, 1000]), float(rng.choice([1, 2, 5]))) for i in range(30)]
    df = spark.createDataFrame(sources, "source string, source_size long, weight double")
    got = {r["source"]: r["target"] for r in water_fill(df, 1.5, 2.0).collect()}
    budget = 1.5 * sum(s for _, s, _ in sources)
    want, open_ = {}, list(sources)
    while open_:
        level = (budget - sum(want.values())) / sum(w for _, _, w in open_)
        full = [x for x in open_ if 2.0 * x[1] <= x[2] * level]
        if not full:
            want |= {n: w * level for n, _, w in open_}
            break
        want |= {n: 2.0 * s for n, s, _ in full}
        open_ = [x for x in open_ if x not in full]
    assert got == pytest.approx(want)


def test_mix_again_and_other_seed(spark):
    docs = documents(spark, SF_SMALL)
    assert rows_of(mix_sources(docs)) == rows_of(mix_sources(docs.repartition(7)))
    assert rows_of(mix_sources(docs)) != rows_of(mix_sources(docs, seed=1))
    # short runs give the same draw
    assert rows_of(mix_sources(docs)) == rows_of(mix_sources(docs, run_rows=2))


# exact dedup

def test_filter_size_does_not_change_the_result(spark):
    docs = odd_table(spark).unionByName(documents(spark, SF_SMALL))
    full = rows_of(exact_dedup(docs))
    assert rows_of(exact_dedup(docs, max_bits=1)) == full == rows_of(exact_dedup(docs, bits_per_row=4096))


def test_two_repeats_of_the_survivor_are_kept(spark):
    out = [r for r in exact_dedup(odd_table(spark)).collect() if r["doc_id"] == 8]
    assert [(r["keep_id"], r["group_size"], r["kept"]) for r in out] == [(8, 2, True)] * 2


# shards

def _signed(h):
    return h - (1 << 64) if h >= 1 << 63 else h


def _xx(value, seed=42):
    return xxhash.xxh64_intdigest(value.encode(), seed)


def _brute_shard(key, tree, seed=0):
    path = ()
    for level in range(3):
        kids = defaultdict(float)
        for s in tree:
            full = (s.region, s.rack, s.number)
            if full[:level] == path:
                kids[full[level]] += s.weight
        def draw(kid):
            h = _xx(f"{seed}/" + ".".join(map(str, path + (kid,))), _xx(key))
            return -math.log(((h >> 11) + 0.5) / 2 ** 53) / kids[kid]
        path += (min(kids, key=draw),)
    return path[2]


def test_shards_against_brute_force(spark):
    docs = odd_table(spark).unionByName(documents(spark, SF_SMALL))
    out = assign_shards(with_clashes(docs), 24).collect()
    tree = shard_tree(24)
    assert sorted(s.number for s in tree) == list(range(24))
    source = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=str)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in out), key=str) == sorted(
        ((i, len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in source), key=str)
    slots = defaultdict(list)
    for r in out:
        key = "null" if r["doc_id"] is None else f"i{r['doc_id']}"
        assert r["law"] == "key"
        assert r["shard"] == _brute_shard(key, tree)
        assert r["grown_shard"] == _brute_shard(key, grow(tree))
        assert r["grown_shard"] in (r["shard"], 24)
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_a_count_of_shards_has_one_layout(spark):
    for n in (24, 25, 40):
        assert shard_tree(n + 1) == grow(shard_tree(n))
    docs = documents(spark, SF_SMALL)
    for n in (24, 25):
        now = {r["doc_id"]: r["grown_shard"] for r in assign_shards(docs, n).collect()}
        assert now == {r["doc_id"]: r["shard"] for r in assign_shards(docs, n + 1).collect()}
    # a first build-out of any size may be grown the same way
    assert shard_tree(7, built=6) == grow(shard_tree(6, built=6))


def test_shards_follow_weights_and_confine_movement(spark):
    ids = spark.range(6000).selectExpr("id AS doc_id", "cast(null AS string) AS text")
    tree = [Shard(0, 0, 0), Shard(1, 0, 0, 3.0), Shard(2, 0, 1, 2.0), Shard(3, 1, 0, 2.0), Shard(4, 1, 1, 0.0)]
    at = {r["doc_id"]: r["shard"] for r in assign_shards(ids, tree).collect()}
    n = Counter(at.values())
    for s in tree:
        assert abs(n[s.number] / 6000 - s.weight / 8) < 0.03
    # weight moves inside rack 0 of region 0: nothing outside that rack moves
    other = [Shard(0, 0, 0, 3.0), Shard(1, 0, 0, 1.0), *tree[2:]]
    then = {r["doc_id"]: r["shard"] for r in assign_shards(ids, other).collect()}
    assert all({at[k], then[k]} <= {0, 1} for k in at if at[k] != then[k])
    assert any(at[k] != then[k] for k in at)
    assert assign_shards(ids.limit(0), tree).count() == 0


def test_slots_do_not_depend_on_runs(spark):
    docs = documents(spark, SF_SMALL)
    assert rows_of(assign_shards(docs)) == rows_of(assign_shards(docs.repartition(5), run_rows=1))


# quality

def test_quality_rules_on_lines(spark):
    rng = random.Random(3)
    good = " ".join(prose(rng, 80, 5000)) + "."
    texts = {
        1: good,
        2: "Home | News | About | Contact | More\n" + good,
        3: "All rights reserved.\nMenu\n" + good,
        4: " ".join(f"{w}!!" for w in prose(rng, 80, 5000)),
        5: " ".join(f"{w}###" for w in prose(rng, 80, 5000)),
        6: " | ".join(prose(rng, 80, 5000)),
        7: good + "\n\n" + good.upper(),
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = {r["doc_id"]: r for r in quality_rules(docs).collect()}
    assert {k for k, r in out.items() if r["kept"]} == {1, 2, 3, 7}
    assert out[2]["clean_text"] == out[3]["clean_text"] == good
    assert out[7]["clean_text"] == texts[7]


def test_quality_counts_against_plain_python(spark):
    out = rows_of(quality_rules(odd_table(spark)), "doc_id", "n_words", "n_repeat_words", "word_chars")
    want = []
    for r in odd_table(spark).collect():
        w = words(r["text"])
        seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        covered = {j for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
        want.append((r["doc_id"], len(w), len(covered), sum(map(len, w))))
    assert out == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_judge_quality_refuses_a_clashing_name(spark):
    with pytest.raises(ValueError):
        judge_quality(with_clashes(odd_table(spark)))


def test_labels_of_the_shipped_rows(spark):
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    rows = quality_rules(documents(spark, SF_SMALL)).join(labels, "doc_id").collect()
    assert all(r["kept"] for r in rows if r["quality"] == 1 and not r["base_failed"])
    assert not any(r["kept"] for r in rows if r["quality"] == 0)
