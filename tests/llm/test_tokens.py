"""Token counts, word BPE and training order against the public libraries."""

import collections
import hashlib
import random
from array import array

import numpy as np
import public_tokenizers
import pytest

from pagecat.llm import bpe, counts, order
from tests.llm import helpers

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def words():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS)


def test_safe_parts_have_the_tokens_of_the_text(pieces):
    rnd = random.Random(1)
    symbols = [*"ab  ▁\n\té<s/> 1　x", "the", "tion", "<s>"]
    for _ in range(3000):
        text = "".join(rnd.choice(symbols) for _ in range(rnd.randint(0, 14)))
        assert counts.lengths(PIECES, [text]) == [len(pieces.encode(text))], repr(text)
        parts = counts.safe_parts(text)
        known = counts.part_ids(PIECES, [parts])
        assert np.frombuffer(b"".join(known[p] for p in parts), np.uint16).tolist() == pieces.encode(text)


def test_counts_of_a_table(spark, pieces):
    docs = helpers.table(spark)
    got = counts.token_counts(docs, PIECES, limit=100).collect()
    want = [(r.doc_id, len((r.text or "").encode()), len(pieces.encode(r.text or ""))) for r in docs.select("doc_id", "text").collect()]
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == collections.Counter((*w, w[2] > 100) for w in want)
    assert counts.token_counts(helpers.table(spark, []), PIECES).count() == 0


def test_remembered_parts_do_not_change_counts(monkeypatch, pieces):
    monkeypatch.setattr(counts, "REMEMBERED", 3)
    texts = [t for t, _ in helpers.texts(4) if t]
    assert [counts.lengths(PIECES, [t])[0] for t in texts] == [len(pieces.encode(t)) for t in texts]


def test_ids_of_many_words_are_remembered(monkeypatch, pieces):
    counts._ids.cache_clear()
    first = [f"w{k}" for k in range(310_000)]
    counts.part_ids(PIECES, [first])
    known = counts.part_ids(PIECES, [["other"]])
    assert len(known) == 310_001 and known["w7"] == array("H", pieces.encode("w7")).tobytes()
    monkeypatch.setattr(counts, "REMEMBERED_IDS", 1000)
    assert set(counts.part_ids(PIECES, [["w7", "new"]])) == {"w7", "new"}
    counts._ids.cache_clear()


def test_word_bpe_like_the_library(words):
    model = bpe.vocabulary(WORDS)
    rnd = random.Random(2)
    symbols = [*"aabcdtheing'slrvm éÉ 12\n\t　Σσς漢字🎉ǅİﬁ<|>.,!-\x1c", "<|endoftext|>", "<|startoftext|>", "é", "ing", "aaaa"]
    for _ in range(5000):
        text = "".join(rnd.choice(symbols) for _ in range(rnd.randint(0, 24)))
        ids = words.encode(text, add_special_tokens=False).ids
        assert list(model.encode(text)) == ids, repr(text)
        assert model.decode(model.encode(text)) == words.decode(ids, skip_special_tokens=False)


def test_neighbours_are_those_an_encoding_has(words):
    model = bpe.vocabulary(WORDS)
    for word in ["internationalisation", "aaaaaaaaaaaaaaa", "thethethe", "bananarama", "zzzzzzqx"]:
        ids = model.encode_symbols(model.symbols(word + "</w>"))
        assert all(model.neighbours(a, b) for a, b in zip(ids, ids[1:]))
        assert ids == words.encode(word, add_special_tokens=False).ids


def test_word_bpe_of_a_table(spark, words):
    docs = helpers.table(spark)
    got = bpe.encoded(docs, WORDS)
    want = collections.Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = words.encode(r.text or "", add_special_tokens=False).ids
        text = words.decode(ids, skip_special_tokens=False)
        want[r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), tuple(ids)] += 1
    assert collections.Counter((*r[:4], tuple(r.ids)) for r in got.collect()) == want
    back = {r.doc_id: r.text for r in bpe.decoded(got, WORDS).collect()}
    assert back[0] == words.decode(words.encode(helpers.texts()[0][0], add_special_tokens=False).ids, skip_special_tokens=False)
    assert bpe.encoded(helpers.table(spark, []), WORDS).count() == 0


@pytest.mark.parametrize("total", [1, 2, 3, 7, 64, 65, 1000, 4097])
def test_slots_are_a_keyed_permutation(total):
    a, b = (order.slots(np.arange(total), total, key) for key in (1, 2))
    assert sorted(a) == sorted(b) == list(range(total))
    assert total < 60 or (a != b).any() and (a != np.arange(total)).any()


def test_shards_hold_every_sequence_at_its_slot(spark, pieces, tmp_path):
    docs = helpers.table(spark)
    rows = order.materialised(docs, PIECES, str(tmp_path / "shards"), key=7, length=32, per_shard=16)
    got = sorted(rows.collect())
    assert [r.slot for r in got] == list(range(len(got)))
    ids = order.read_slots(str(tmp_path / "shards"), 0, len(got), 32, 16)
    for r, record in zip(got, ids):
        assert r.shard == r.slot // 16 and r.offset == r.slot % 16 * 64
        assert r.ids_sha256 == hashlib.sha256(record.tobytes()).hexdigest()
    # Reading on from any slot gives the same ids; sequences in order of their numbers give all texts.
    assert (order.read_slots(str(tmp_path / "shards"), 5, 20, 32, 16) == ids[5:25]).all()
    by_number = sorted(got, key=lambda r: r.number)
    stream = [i for r in by_number for i in ids[r.slot][: r.n_tokens].tolist()]
    texts, now = [], []
    for i in stream:
        if i == order.END:
            texts.append(tuple(now))
            now = []
        else:
            now.append(i)
    want = [(r.doc_id, tuple(pieces.encode(r.text or ""))) for r in docs.select("doc_id", "text").collect()]
    assert collections.Counter(texts) == collections.Counter(t for _, t in want) and not now
    assert {d for r in got for d in r.doc_ids} == {d for d, _ in want}
    assert order.materialised(helpers.table(spark, []), PIECES, str(tmp_path / "none")).count() == 0
