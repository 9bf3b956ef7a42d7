"""Token counts, pieces, line index and toxicity against libraries and brute force."""

import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from conftest import SF_SMALL
from helpers import odd_table, prose, rows_of, with_clashes
from starmart.llm import pieces as pieces_module
from starmart.llm import toxicity as tox
from starmart.llm.common import documents
from starmart.llm.hashing import ngram_hashes, word_hashes
from starmart.llm import line_dedup as line_module
from starmart.llm.line_dedup import CuckooFilter, LineIndex, line_dedup, line_key
from starmart.llm.pieces import Encoder, PieceModel, decode_pieces, encode_pieces
from starmart.llm.queries import op4_token_counts, op7_pieces, op10_toxicity
from starmart.llm.tokens import TokenCounter, count_tokens

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _by_id(df):
    return sorted(((r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()), key=str)


# hashes

def test_word_hashes_ignore_blocks_and_spacing():
    rng = random.Random(1)
    text = " ".join(prose(rng, 3000)) + " " + "x" * 5000 + "\n\té " * 40
    assert (word_hashes(text, block=64) == word_hashes(text)).all()
    assert (word_hashes(" \t" + text.replace(" ", " \r\n")) == word_hashes(text)).all()
    seen = {}
    for w, h in zip(text.split(), word_hashes(text).tolist()):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    assert len(word_hashes("")) == len(word_hashes(" \n")) == len(ngram_hashes(word_hashes(""), 5)) == 0
    assert len(ngram_hashes(word_hashes("a b c"), 5)) == 1


# token counts

def test_token_counts_match_the_library(spark):
    library = tokenizers.Tokenizer.from_file(BPE)
    for got, docs in ((op4_token_counts(spark, SF_SMALL), documents(spark, SF_SMALL)),
                      (count_tokens(with_clashes(odd_table(spark)), BPE), odd_table(spark))):
        want = []
        for i, t in _by_id(docs):
            n = len(library.encode(t, add_special_tokens=False).ids)
            want.append((i, len(t.encode()), n, n > 1024))
        assert rows_of(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == want
    assert count_tokens(odd_table(spark).limit(0), BPE).count() == 0


def test_token_counter_blocks_and_cache():
    library = tokenizers.Tokenizer.from_file(BPE)
    rng = random.Random(7)
    alphabet = "aaaabcdehilnorst  '\n\t é 日0123!?<|>"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(400))) for _ in range(200)]
    texts += ["a" * 3001, "ab" * 700, " " * 900, "<|endoftext|>" * 3, "x<|endoftext|> y", "don't 'll we've"]
    counter = TokenCounter(BPE, cache_size=50, block=64)
    assert counter.counts(texts) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


# pieces

@pytest.fixture(scope="module")
def model():
    return PieceModel(PIECES)


def _encoded(encoder, texts, keys=None):
    flat, count = encoder.encode(texts, np.arange(len(texts), dtype=np.uint64) if keys is None else keys)
    return [part.tolist() for part in np.split(flat, np.cumsum(count)[:-1])]


def test_no_dropout_is_the_library(spark, model):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = [t for _, t in _by_id(documents(spark, SF_SMALL)) + _by_id(odd_table(spark)) if "▁" not in t]
    assert _encoded(Encoder(model, 0.0, 0), texts) == library.encode(texts)


def test_arrays_and_heap_agree_under_dropout(model, monkeypatch):
    rng = random.Random(4)
    words = ["▁" + "".join(rng.choice("abcdeinorst日é▁") for _ in range(rng.randrange(1, 40))) for _ in range(800)]
    stream = np.arange(len(words)) % 8
    for dropout in (0.0, 0.1, 0.6):
        encoder = Encoder(model, dropout, 11)
        arrays = [x.tolist() for x in encoder.encode_words(words, stream)]
        monkeypatch.setattr(pieces_module, "LONG", 0)
        assert [x.tolist() for x in encoder.encode_words(words, stream)] == arrays
        monkeypatch.undo()


def test_dropout_varies_by_seed_and_decodes(spark, model):
    docs = with_clashes(odd_table(spark))
    runs = {}
    for seed, dropout in ((0, 0.3), (1, 0.3), (0, 1.0), (0, 0.0)):
        encoded = encode_pieces(docs, PIECES, dropout, seed)
        runs[seed, dropout] = rows_of(encoded, "doc_id", "pieces")
        assert rows_of(decode_pieces(encoded, PIECES), "doc_id", "text") == _by_id(docs)
    assert runs[0, 0.3] != runs[1, 0.3]
    total = {k: sum(len(p) for _, p in v) for k, v in runs.items()}
    assert total[0, 0.0] < total[0, 0.3] < total[0, 1.0]
    # the same under other batches and partitions
    again = encode_pieces(docs.repartition(3), PIECES, 0.3, 0, block_bytes=10)
    assert rows_of(again, "doc_id", "pieces") == runs[0, 0.3]
    assert encode_pieces(docs.limit(0), PIECES).count() == 0


def test_dropout_share_of_candidates(model):
    encoder = Encoder(model, 0.25, 3)
    n = np.arange(200_000)
    assert abs(encoder._skips(n.astype(np.uint64), n % 7, n % 11, n % 13).mean() - 0.25) < 0.01


def test_pieces_query_decodes_every_text(spark):
    want = sorted((i, hashlib.sha256(t.encode()).hexdigest()) for i, t in _by_id(documents(spark, SF_SMALL)))
    rows = op7_pieces(spark, SF_SMALL)
    assert rows_of(rows, "doc_id", "decoded_sha256") == sorted(want, key=str)
    assert all(r["n_pieces"] == len(r["pieces"]) for r in rows.collect())


# line index

def test_cuckoo_filter_inserts_and_deletes():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 63, 60_000, dtype=np.uint64))
    kept = CuckooFilter()
    for part in np.array_split(keys, 7):
        kept.insert(part)
    kept = CuckooFilter.from_bytes(kept.to_bytes())
    assert kept.contains(keys).all()
    absent = rng.integers(1 << 63, 1 << 64, 100_000, dtype=np.uint64)
    assert kept.contains(absent).mean() < 0.01
    kept.delete(keys[:20_000])
    assert kept.contains(keys[20_000:]).all()
    assert kept.contains(keys[:20_000]).mean() < 0.02
    kept.delete(keys[20_000:])
    assert sum(int((t != 0).sum()) for t in kept.tables) == 0
    assert not CuckooFilter.from_bytes(None).contains(keys).any()


def test_line_index_is_reversible(spark):
    docs = documents(spark, SF_SMALL)
    some, gone = docs.where("doc_id % 3 <> 0"), docs.where("doc_id % 3 = 0")
    plain, undone = LineIndex(spark, shards=3), LineIndex(spark, shards=3)
    plain.insert(plain.lines_of(some))
    undone.insert(undone.lines_of(gone))
    undone.insert(undone.lines_of(some))
    undone.insert(undone.lines_of(some))  # a second time changes nothing
    undone.delete(gone)
    assert rows_of(undone.counts()) == rows_of(plain.counts())
    assert rows_of(undone.clean(some)) == rows_of(plain.clean(some))
    # filters hold as many fingerprints as there are keys
    held = sum(int((t != 0).sum()) for r in undone._filters().collect() for t in CuckooFilter.from_bytes(r["filter"]).tables)
    assert held == undone.counts().count()
    undone.delete(docs)
    assert undone.counts().count() == 0
    undone.insert(undone.lines_of(docs))
    assert rows_of(undone.clean(docs)) == rows_of(line_dedup(docs))


def test_filters_decide_the_result(spark, monkeypatch):
    """A filter that never finds a key makes every batch's keys new."""
    docs = documents(spark, SF_SMALL)
    right = rows_of(line_dedup(docs))
    monkeypatch.setattr(line_module, "_probe", lambda keys, filters: keys[["key", "shard"]].assign(maybe=False))
    assert rows_of(line_dedup(docs)) != right
    # one that always does only asks the exact tables more often
    monkeypatch.setattr(line_module, "_probe", lambda keys, filters: keys[["key", "shard"]].assign(maybe=True))
    assert rows_of(line_dedup(docs)) == right


def test_line_index_changes_against_a_dictionary(spark):
    """Inserts and deletions in any order, also of ids that come again."""
    rng = random.Random(12)
    lines = [f"a line of text number {i}" for i in range(12)]
    held, index = {}, LineIndex(spark, shards=4)
    for step in range(6):
        ids = rng.sample([None, *range(9)], 4)
        if step % 3 < 2:
            docs = [(i, "\n".join(rng.sample(lines, 3))) for i in ids]
            index.insert(index.lines_of(spark.createDataFrame(docs, "doc_id long, text string")))
            for i, text in docs:
                held.setdefault(i, set()).update(text.split("\n"))
        else:
            index.delete(spark.createDataFrame([(i,) for i in ids], "doc_id long"))
            for i in ids:
                held.pop(i, None)
        want = sorted((line_key(x, 10), sum(x in v for v in held.values()),
                       min((i for i in held if x in held[i]), key=lambda i: (i is None, i)))
                      for x in lines if any(x in v for v in held.values()))
        got = sorted((bytes(r["key"]), r["n_docs"], r["first_id"]) for r in index.counts().collect())
        assert got == want
        found = sum(int((t != 0).sum()) for r in index._filters().collect() for t in CuckooFilter.from_bytes(r["filter"]).tables)
        assert found == len(want)


def test_a_small_change_touches_its_shards_only(spark):
    docs = documents(spark, SF_SMALL)
    index = LineIndex(spark, shards=64)
    index.insert(index.lines_of(docs))
    one = spark.createDataFrame([(10**9, "a line that nobody else has written")], "doc_id long, text string")
    index.insert(index.lines_of(one))
    index.delete(one)
    for table, rows in (("refs", 1), ("fresh", 1), ("gone", 1), ("again", 1)):
        assert spark.read.parquet(index.at[table][-1]).count() == rows
    assert [spark.read.parquet(at).count() for at in index.at["filters"]][1:] == [1, 1]


def test_line_dedup_batches_and_key():
    assert line_key("  A Line of Text\r", 10) == line_key("a line of text", 10)
    assert line_key("À line of text", 10) != line_key("à line of text", 10)
    assert line_key("  short   ", 10) is None and line_key("ten chars!", 10) is not None


def test_line_dedup_does_not_depend_on_batches(spark):
    docs = documents(spark, SF_SMALL)
    assert rows_of(line_dedup(docs, batches=1)) == rows_of(line_dedup(docs.repartition(5), batches=3, keys_per_shard=100))


# toxicity

def _tiny(window=6):
    shape = tox.Shape(window=window, stride=3, hidden=3, embed=2, attention=3, steps=2, batch=4)
    net = tox.Net(shape, np.random.default_rng(0).standard_normal(1 << tox.EVIDENCE_BITS))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    return net


def test_gradients_against_differences(monkeypatch):
    net = _tiny()
    words = ["alpha", "b", "gamma", "delta", "e", "zeta"]
    index = np.array([[0, 1, 2, 3, 4, 5], [2, 2, 1, 0, 0, 0]])
    mask = np.array([[True] * 6, [True] * 3 + [False] * 3])

    def loss():
        x, _ = net.inputs(words)
        return float((net.forward(net.project(x), index, mask) * np.array([1.0, -2.0])).sum())

    x, at = net.inputs(words)
    tape = {}
    net.forward(net.project(x), index, mask, tape)
    grads = net.backward(x, at, index, mask, tape, np.array([1.0, -2.0]))
    rng = np.random.default_rng(1)
    for name, g in grads.items():
        spots = np.argwhere(np.abs(g) > 1e-9)
        for spot in spots[rng.permutation(len(spots))[:4]]:
            spot, keep = tuple(spot), net.p[name][tuple(spot)]
            net.p[name][spot] = keep + 1e-2
            up = loss()
            net.p[name][spot] = keep - 1e-2
            down = loss()
            net.p[name][spot] = keep
            # inputs are float32, so differences are coarse
            assert (up - down) / 2e-2 == pytest.approx(g[spot], rel=5e-2, abs=5e-3), name


def test_windows_cover_every_word():
    net = _tiny()
    for n in range(1, 60):
        starts = net.windows(n)
        covered = {i for s in starts for i in range(s, min(s + 6, n))}
        assert covered == set(range(n))
        assert all(b - a <= 3 for a, b in zip(starts, starts[1:]))


def test_scores_do_not_depend_on_batches():
    rng = random.Random(9)
    texts = [" ".join(prose(rng, rng.randrange(80))) for _ in range(40)] + ["", " \n"]
    net = _tiny()
    one = tox.Scorer(net, block_chars=1).scores(texts)
    assert one == pytest.approx(tox.Scorer(net).scores(texts), abs=1e-5)
    assert one[-1] == one[-2] == 0.0


def test_learns_planted_words_and_word_families(spark):
    rng = random.Random(12)
    docs, labels = [], []
    for i in range(900):
        w = prose(rng, rng.randrange(30, 250), 3000)
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):  # a word, or one of a family that shares a stem
                w.insert(rng.randrange(len(w)), rng.choice(["grubel", f"zorp{rng.randrange(1000)}"]))
        docs.append((i, " ".join(w)))
        if i % 3:
            labels.append((i, int(toxic)))
    docs += [(None, None), (900, ""), (900, "")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame([*labels, (1, None), (None, 1)], "doc_id long, toxic int")
    shape = tox.Shape(steps=120)
    out = tox.score_toxicity(with_clashes(d), lab, shape=shape).collect()
    assert len(out) == len(docs)
    held = [r for r in out if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 900]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in held)
    right = sum(r["predicted"] == (r["doc_id"] % 5 == 0) for r in held) / len(held)
    assert right >= 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)
    assert {r["score"] for r in out if r["doc_id"] in (None, 900)} == {0.0}
    # held-out labels do not matter
    flipped = lab.selectExpr("doc_id", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    assert rows_of(tox.score_toxicity(d, flipped, shape=shape)) == rows_of(tox.score_toxicity(d, lab, shape=shape))


def test_one_class_or_no_rows(spark):
    d = odd_table(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in tox.score_toxicity(d, none).collect()} == {0.0}
    assert tox.score_toxicity(d.limit(0), none).count() == 0


def test_held_out_accuracy_on_shipped_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = op10_toxicity(spark, sf).where("held_out").join(labels, "doc_id").collect()
    n = collections.Counter((r["toxic"], r["predicted"]) for r in rows)
    assert (n[0, 0] + n[1, 1]) / sum(n.values()) >= 0.9
    assert n[1, 1] / (n[1, 0] + n[1, 1]) >= 0.6  # most toxic texts are found
    toxic, clean = ([r["score"] for r in rows if r["toxic"] == k] for k in (1, 0))
    above = sum((t > c) + 0.5 * (t == c) for t in toxic for c in clean)
    assert above / (len(toxic) * len(clean)) >= 0.9  # area under the ROC curve


def test_the_sample_is_bounded(spark):
    """One id on a third of the rows, and a very long text."""
    rows = [(3, f"copy {i} " * 20) for i in range(2000)] + [(i, f"text {i}") for i in range(4, 40)] + [(41, "w " * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(42)], "doc_id long, toxic int")
    texts, marks = tox.labelled_sample(docs, labels, 10, 10, max_chars=500)
    assert 0 < len(texts) == len(marks) <= 20 and max(map(len, texts)) <= 500
    again = tox.labelled_sample(docs.repartition(7), labels, 10, 10, max_chars=500)
    assert again == (texts, marks)
    every = tox.labelled_sample(docs, labels, max_chars=500)[0]
    assert sum(t.startswith("copy") for t in every) <= 1
