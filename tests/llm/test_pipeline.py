"""The pipeline's stages against brute force over small tables."""

import random
from types import SimpleNamespace

import public_tokenizers

import corpus_pipeline
from tests.llm import helpers
from tests.llm.test_duplicates import plain_leaks, plain_one_of_each, removed_by_brute_force


def written_tables(spark, folder):
    rnd = random.Random(8)
    items = [(i, helpers.prose(rnd, 30)) for i in range(5)]
    rows = helpers.texts()
    shared = helpers.prose(rnd, 120)
    rows += [(helpers.prose(rnd, 50) + " " + shared + " " + helpers.prose(rnd, 50), "aa") for _ in range(3)]
    rows += [(helpers.prose(rnd, 40) + " " + t + " " + helpers.prose(rnd, 40), "aa") for _, t in items[:3]]
    docs = helpers.table(spark, rows)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs, items


def test_run_like_brute_force(spark, tmp_path):
    docs, items = written_tables(spark, str(tmp_path))
    rows = [SimpleNamespace(**r.asDict()) for r in docs.collect()]
    rows = [r for r in rows if any(c.isalpha() for c in r.text or "")]
    rows = plain_one_of_each([(r.doc_id, r.text) for r in rows])
    cut = [w[4].decode("utf-8", "ignore") for w in removed_by_brute_force([t for _, t in rows], 400)]
    kept = [(i, t) for (i, _), t in zip(rows, cut) if not plain_leaks(t, items)[0]]
    assert len(kept) < len(rows)

    from tokenizers import Tokenizer

    words = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = sorted((i if i is not None else -1, words.encode(t, add_special_tokens=False).ids) for i, t in kept)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.ids) for r in got) == want


def test_stages_keep_the_columns_and_take_an_empty_table(spark, tmp_path):
    written_tables(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").where("doc_id < 0")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0, name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert sorted(out.columns) == sorted(docs.columns), name


def test_passages_of_over_fifty_words_go(spark):
    rnd = random.Random(5)
    passage, few, long = helpers.prose(rnd, 56)[:340], " ".join("x" * 9 + rnd.choice("abcd") * 20 for _ in range(10)), helpers.prose(rnd, 120)
    copy = helpers.prose(rnd, 60)[:380]
    own = [helpers.prose(rnd, 80) for _ in range(10)]
    assert len(passage.split()) > 50 and 250 <= len(passage) < 400 and 250 <= len(few) < 400 < len(long) and 250 <= len(copy) < 400
    texts = [f"{own[k]}{k}|{passage}|{k}{own[k + 1]}" for k in (0, 2, 4)]  # in otherwise different documents
    texts += [f"{own[6]}|{few}|", f"{own[7]}|{few}|"]  # few words
    texts += [copy, copy + " end"]  # one passage and no more
    texts += [long + "#", "#" + long]  # 400 bytes go wherever they stand
    out = corpus_pipeline.repeated_passages(spark, helpers.table(spark, [(t, "aa") for t in texts]).dropDuplicates(["doc_id"]).where("doc_id is not null"), "")
    got = {r.doc_id: r.text for r in out.collect()}
    # The marks beside a passage are shared too.
    assert [got[k] for k in range(3)] == [f"{own[k]}{k}{k}{own[k + 1]}" for k in (0, 2, 4)]
    assert [got[k] for k in range(3, 7)] == texts[3:7]
    assert [got[7], got[8]] == ["#", "#"]
