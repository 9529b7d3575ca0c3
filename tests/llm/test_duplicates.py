"""Suffix runs, SimHash and decontamination against brute force."""

import collections
import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pagecat.llm import decontaminate, repeats, simhash, suffixes
from tests.llm import helpers


def test_merge_gives_order_and_common_prefixes():
    rnd = random.Random(1)
    for _ in range(500):
        runs = [sorted(bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 8))) for _ in range(rnd.randint(0, 12))) for _ in range(rnd.randint(1, 7))]
        out = list(suffixes.merged([suffixes.decoded(*suffixes.front_coded(r)) for r in runs]))
        assert [s for s, _, _ in out] == sorted(sum(runs, []))
        before = b""
        for s, k, _ in out:
            assert k == suffixes.common_prefix(before, s)
            before = s


def test_no_known_prefix_is_compared_again(monkeypatch):
    seen = []
    plain = suffixes.common_prefix
    monkeypatch.setattr(suffixes, "common_prefix", lambda a, b, known=0: seen.append((known, plain(a, b))) or plain(a, b, known))
    rnd = random.Random(2)
    runs = [sorted({b"x" * 50 + bytes(rnd.choice(b"ab") for _ in range(9)) for _ in range(40)}) for _ in range(4)]
    coded = [suffixes.front_coded(r) for r in runs]
    seen.clear()
    out = list(suffixes.merged([suffixes.decoded(*c) for c in coded]))
    read = sum(end - known for known, end in seen)
    assert len(out) == sum(map(len, runs)) and read < 4 * 50 + 20 * len(out)


def test_anchors_depend_on_the_window_alone():
    rnd = random.Random(3)
    for _ in range(100):
        text = bytes(rnd.choice(b"abc") for _ in range(rnd.randint(0, 120)))
        at, first, last, _ = suffixes.anchors(np.frombuffer(text, np.uint8), 20, 6)
        places = {i: p for p, b, e in zip(at, first, last) for i in range(b, e + 1)}
        assert sorted(places) == list(range(max(0, len(text) - 19)))
        seen = {}
        for i, p in places.items():
            assert i <= p <= i + 14 and seen.setdefault(text[i : i + 20], p - i) == p - i


def removed_by_brute_force(texts, size):
    data = [(t or "").encode() for t in texts]
    starts = collections.Counter(b[i : i + size] for b in data for i in range(len(b) - size + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if starts[b[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        rest = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest(), rest))
    return out


@pytest.mark.parametrize("size,gram,piece", [(20, 4, 2000), (400, 64, 7)])
def test_repeats_like_brute_force(spark, monkeypatch, size, gram, piece):
    monkeypatch.setattr(repeats, "PIECE", piece)
    rnd = random.Random(size)
    texts = []
    for _ in range(40):
        t = "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 3 * size)))
        if texts and rnd.random() < 0.6:
            s = rnd.choice(texts) or "x"
            a, b = sorted(rnd.randint(0, len(s)) for _ in range(2))
            t = t[: size // 2] + s[a:b] + "é" + s[: rnd.randint(0, 3 * size)] + t[size // 2 :]
        texts.append(t)
    texts += [texts[1], texts[1], None, "", "ab" * (2 * size), "x" + "ab" * size, texts[2] + "tail"]
    docs = spark.createDataFrame([(i, t, "w", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, k1 string, n_chars long").repartition(3)
    want = removed_by_brute_force(texts, size)
    got = {r.doc_id: tuple(r)[1:] for r in repeats.digests(docs, size, gram).collect()}
    assert got == {i: w[:4] for i, w in enumerate(want)}
    kept = repeats.deduplicated(docs, size, gram)
    assert kept.columns == docs.columns
    for r in kept.collect():
        text = None if texts[r.doc_id] is None else want[r.doc_id][4].decode("utf-8", "ignore")
        assert (r.text, r.n_chars) == (text, len(text or ""))


def test_repeats_of_the_usual_cases(spark):
    docs = helpers.table(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = collections.Counter((i, *w[:4]) for (i, _), w in zip(rows, removed_by_brute_force([t for _, t in rows], 400)))
    assert collections.Counter(tuple(r) for r in repeats.digests(docs).collect()) == want
    assert repeats.digests(helpers.table(spark, [])).count() == 0


def plain_fingerprint(text, shingle):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def reachable(nodes, linked):
    root = {}
    for start in nodes:
        if start in root:
            continue
        todo, root[start] = [start], start
        while todo:
            u = todo.pop()
            for v in nodes:
                if v not in root and linked(u, v):
                    root[v] = start
                    todo.append(v)
    return root


def test_simhash_like_brute_force(spark):
    docs = helpers.table(spark)
    rows = [(r.doc_id, plain_fingerprint(r.text, 4)) for r in docs.collect()]
    root = reachable(sorted({f for _, f in rows}), lambda a, b: bin(a ^ b).count("1") <= 4)
    least = {}
    for i, f in rows:
        if i is not None:
            least[root[f]] = min(least.get(root[f], i), i)
    want = collections.Counter((i, f"{f:016x}", least[root[f]]) for i, f in rows)
    assert collections.Counter(tuple(r) for r in simhash.near_duplicates(docs).collect()) == want
    assert simhash.near_duplicates(helpers.table(spark, [])).count() == 0


@pytest.mark.parametrize("block", [2048, 40])
def test_links_connect_dense_groups(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rnd = random.Random(block)
    values = set()
    for _ in range(400):
        x = (7, 1 << 63 | 99)[rnd.randrange(2)]
        for _ in range(rnd.randint(0, 9)):
            x ^= 1 << rnd.randrange(64)
        values.add(x)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"))
    for r in edges.collect():
        assert bin((r.a ^ r.b) & (1 << 64) - 1).count("1") <= 4
    found = {r.node: r.root for r in simhash.components(edges).collect()}
    want = reachable(sorted(signed), lambda a, b: bin((a ^ b) & (1 << 64) - 1).count("1") <= 4)
    assert {v: found.get(v, v) for v in signed} == want
    assert edges.count() < 70 * len(signed)


def signed_hash(text):
    h = xxhash.xxh64_intdigest(text, 42)
    return h - (1 << 64) if h >> 63 else h


def plain_one_of_each(rows):
    """Of each component of rows (doc_id, text) the one with the smallest id, then the smallest hash; no id comes last."""
    fp = {t: plain_fingerprint(t, 4) for _, t in rows}
    root = reachable(sorted(set(fp.values())), lambda a, b: bin(a ^ b).count("1") <= simhash.BITS)
    best = {}
    for i, t in rows:
        rank = (i is None, i or 0, signed_hash(t) if t is not None else 42)
        best[root[fp[t]]] = min(best.get(root[fp[t]], (rank, i, t)), (rank, i, t), key=lambda x: x[0])
    return [(i, t) for _, i, t in best.values()]


def test_one_of_each_like_brute_force(spark):
    rnd = random.Random(7)
    base = helpers.prose(rnd, 400).split()
    copies = []
    for _ in range(30):
        words = list(base)
        words[rnd.randrange(400)] = "other"
        copies.append((" ".join(words), "aa"))
    docs = helpers.table(spark, helpers.texts() + copies)
    same_id = docs.where("doc_id = 3").limit(1)
    docs = docs.unionByName(same_id.withColumn("text", F.lit("another text under the id of one that is kept")))
    out = simhash.one_of_each(docs)
    assert out.columns == docs.columns
    mine = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert mine == sorted(plain_one_of_each([(r.doc_id, r.text) for r in docs.collect()]), key=str)
    assert simhash.one_of_each(docs.where("doc_id < 0")).count() == 0


def plain_words(text):
    import regex

    return [w for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w]


def plain_leaks(text, items):
    def grams(w):
        return collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else collections.Counter([tuple(w)] if w else [])

    words, out = plain_words(text), {}
    for item, t in items:
        w = plain_words(t)
        if not w:
            continue
        b = grams(w)
        for s in range(max(1, len(words) - len(w) + 1)):
            a = grams(words[s : s + len(w)]) if len(w) >= 5 else grams(words)
            both = sum((a & b).values())
            out[item] = max(out.get(item, 0), both / (sum(a.values()) + sum(b.values()) - both))
    return sorted(i for i, x in out.items() if x >= 0.8), max(out.values(), default=0)


def test_decontamination_like_brute_force(spark):
    rnd = random.Random(4)
    items = [(i, helpers.prose(rnd, rnd.randint(18, 40))) for i in range(12)] + [(90, None), (91, ""), (92, "two words"), (3, helpers.prose(rnd, 25))]
    docs = []
    for k in range(60):
        t = helpers.prose(rnd, rnd.randint(0, 80))
        if k % 3 == 0:
            w = items[k % 12][1].split()
            if k % 2:
                w[rnd.randrange(len(w))] = "changed"
            if k % 5 == 0:
                w = w[:-1]
            t += " " + " ".join(w).upper() + ", " + helpers.prose(rnd, 20)
        docs.append((k, t, k))
    docs += [(60, None, 1), (61, "", 1), (62, "Two words!", 1), (0, docs[0][1], 1), (None, docs[3][1], 1)]
    table = spark.createDataFrame(docs, "doc_id long, text string, m long")
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, hashes long")
    got = decontaminate.contaminated(table, bench).collect()
    assert len(got) == len(docs)
    want = collections.Counter((i, tuple(plain_leaks(t, items)[0])) for i, t, _ in docs)
    assert collections.Counter((r.doc_id, tuple(r["items"])) for r in got) == want
    assert all(r.contaminated == (r.n_items > 0) == (r.similarity >= 0.8) for r in got)
    clean = decontaminate.cleaned(table, bench)
    assert collections.Counter(r.doc_id for r in clean.collect()) == collections.Counter(r.doc_id for r in got if not r.contaminated)
    none = bench.where("item_id < 0")
    assert not decontaminate.contaminated(table, none).where("contaminated").count()
    assert decontaminate.contaminated(table.where("doc_id < 0"), bench).count() == 0


def test_decontamination_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SHINGLES_PER_PASS", 20)
    rnd = random.Random(5)
    items = [(i, helpers.prose(rnd, 20)) for i in range(6)]
    docs = [(i, "before " + t + " after", 1) for i, t in items] + [(9, helpers.prose(rnd, 50), 1)]
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string, x int"), spark.createDataFrame(items, "item_id long, text string"))
    assert {r.doc_id: r["items"] for r in got.collect()} == {i: [i] for i, _ in items} | {9: []}


def test_decontamination_has_no_python(spark):
    table = helpers.table(spark)
    bench = spark.createDataFrame([(1, "a b c d e f g h")], "item_id long, text string")
    plan = decontaminate.contaminated(table, bench)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_block_index_finds_all_within_the_radius(spark):
    rnd = random.Random(6)
    pairs = []
    for k in range(300):
        a = rnd.getrandbits(64)
        b = a
        for bit in rnd.sample(range(64), rnd.randint(0, decontaminate.RADIUS)):
            b ^= 1 << bit
        pairs.append((k, *(x - (1 << 64) if x >> 63 else x for x in (a, b))))
    df = spark.createDataFrame(pairs, "k int, a long, b long")
    left = df.select("k", F.inline(decontaminate.block_keys(F.col("a"), 0)))
    right = df.select("k", F.inline(decontaminate.block_keys(F.col("b"), decontaminate.NEAR)))
    assert left.join(right, ["k", "block", "value"]).select("k").distinct().count() == 300


def test_no_join_with_the_index_is_a_broadcast(spark, monkeypatch):
    plans = []
    plain = decontaminate.written
    monkeypatch.setattr(decontaminate, "written", lambda df, name: plans.append((name, df._jdf.queryExecution().executedPlan().toString())) or plain(df, name))
    items = spark.createDataFrame([(1, "one two three four five six seven")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "zero one two three four five six seven eight")], "doc_id long, text string")
    assert decontaminate.contaminated(docs, items).first().contaminated
    verified = dict(plans)["verified"]
    near = [line for line in verified.splitlines() if "block#" in line and "Join" in line]
    assert near and all("SortMergeJoin" in line for line in near)


def test_similarity_with_and_without_repeats(spark):
    rnd = random.Random(5)
    rows = [([rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 8))], rnd.sample("abcdefgh", rnd.randint(1, 8))) for _ in range(200)]
    rows += [(a, [rnd.choice("abcd") for _ in range(6)]) for a, _ in rows[:100]]
    found = spark.createDataFrame(rows, "a array<string>, b array<string>").select("a", "b", decontaminate.similarity("a", "b").alias("s")).collect()
    for r in found:
        both = sum((collections.Counter(r.a) & collections.Counter(r.b)).values())
        assert r.s == both / (len(r.a) + len(r.b) - both)
