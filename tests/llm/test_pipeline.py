"""The corpus pipeline, stage by stage against plain Python on each stage's own input."""

import collections

import public_tokenizers
import pytest

import corpus_pipeline as P
from conftest import SF_SMALL
from helpers import SCHEMA, odd_table, rows_of, with_clashes, words
from starmart.llm.common import documents
from starmart.llm.mix import mix_sources
from starmart.llm.pieces import decode_pieces
from starmart.llm.quality import quality_rules
from starmart.session import materialize
from test_pairs import _brute_classes


def _stage(name):
    return dict(P.STAGES)[name]


@pytest.fixture(scope="module", params=["shipped", "odd"])
def steps(request, spark):
    """Every stage's input and output, written and read again."""
    docs = documents(spark, SF_SMALL) if request.param == "shipped" else with_clashes(odd_table(spark))
    out = [docs]
    for name, stage in P.STAGES:
        docs = materialize(stage(spark, docs, SF_SMALL), "test-stage")
        out.append(docs)
    return out


def test_stages_are_the_five_in_order():
    assert [n for n, _ in P.STAGES] == ["quality rules", "exact dedup", "n-gram Jaccard join", "mixing sources",
                                        "SentencePiece encoding"]
    assert P.ORACLE_SQL is None


def test_columns_stay(steps):
    for df in steps[1:-1]:
        assert df.dtypes == steps[0].dtypes  # parquet makes every column nullable
    assert steps[-1].columns == ["doc_id", "pieces", "n_pieces"]


def test_quality_keeps_what_the_operator_keeps(steps):
    judged = quality_rules(steps[0]).where("kept").select("doc_id", "clean_text")
    assert rows_of(steps[1], "doc_id", "text") == rows_of(judged.withColumnRenamed("clean_text", "text"), "doc_id", "text")
    before = collections.Counter(rows_of(steps[0], "doc_id", "text", "n_chars"))
    for i, t, n in rows_of(steps[1], "doc_id", "text", "n_chars"):
        assert before[i, t, n] or n == len(t)


def _firsts(rows, groups):
    """Rows whose id is the smallest of a group, as the stages keep them."""
    low = {min(ids, key=lambda i: (i is None, i)) for ids in groups}
    gone = {i for ids in groups for i in ids} - low
    return sorted(i for i, _ in rows if i not in gone)


def test_exact_dedup_keeps_one_of_each_text(steps):
    rows = rows_of(steps[1], "doc_id", "text")
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups["".join(words(t))].append((-len(t), i))
    first = {min(g)[1] for g in groups.values()}
    gone = {i for g in groups.values() for _, i in g} - first
    assert sorted(r["doc_id"] for r in steps[2].collect()) == sorted(i for i, _ in rows if i not in gone)


def test_near_dedup_keeps_one_of_each_class(steps):
    rows = rows_of(steps[2], "doc_id", "text")
    want = _firsts(rows, _brute_classes(rows).values())
    assert sorted(r["doc_id"] for r in steps[3].collect()) == want


def test_mix_repeats_rows(steps):
    want = collections.Counter()
    for r in mix_sources(steps[3]).collect():
        want[r["doc_id"]] += r["repeats"]
    got = collections.Counter(r["doc_id"] for r in steps[4].collect())
    assert got == +want
    assert set(rows_of(steps[4])) <= set(rows_of(steps[3]))


def test_pieces_decode_to_the_texts(steps):
    back = decode_pieces(steps[5], public_tokenizers.path("piece_bpe_32k.model"))
    assert rows_of(back, "doc_id", "text") == rows_of(steps[4], "doc_id", "text")


def test_run_is_the_stages(spark):
    got = rows_of(P.run(spark, SF_SMALL), "doc_id", "n_pieces")
    docs = documents(spark, SF_SMALL)
    for _, stage in P.STAGES:
        docs = materialize(stage(spark, docs, SF_SMALL), "test-run")
    assert got == rows_of(docs, "doc_id", "n_pieces") and got


def test_clean_documents_stay_until_the_mix(spark):
    """Good documents without a copy pass the three filtering stages."""
    import random

    from helpers import prose

    rng = random.Random(4)
    rows = [(i, ". ".join(" ".join(prose(rng, 12, 9000)).capitalize() for _ in range(8)) + ".", "en", "s", 0)
            for i in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("quality rules", "exact dedup", "n-gram Jaccard join"):
        docs = materialize(_stage(name)(spark, docs, SF_SMALL), "test-clean")
    assert rows_of(docs) == rows_of(spark.createDataFrame(rows, SCHEMA))


def test_empty_documents(spark):
    docs = documents(spark, SF_SMALL).limit(0)
    for _, stage in P.STAGES:
        docs = materialize(stage(spark, docs, SF_SMALL), "test-empty")
    assert docs.count() == 0
