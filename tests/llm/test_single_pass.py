"""Top-k, chat, URL rules, mixing, sharding, toxicity and encoding on small cases."""

import gc
import hashlib
import os
import random
import subprocess
import sys
import tracemalloc
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import make_docs, words
from pyspark.sql import functions as F

from churnlake.llm import chat, kdtree, mixing, pieces, topk, toxicity, urls
from churnlake.llm.queries import piece_model
from churnlake.llm.vectors import exact_scores

ROOT = str(Path(__file__).resolve().parents[2])


def test_top_k_with_ties_over_many_tiles(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 6) / 64]) for i in range(90)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.top_k(topk.whole_vectors(frame), F.col("vec_id") % 9 == 0, 7, query_block=4, shard=8, fan_in=3)
    whole = np.array([np.floor(np.array(v) * 64) for _, v in rows])
    want = set()
    for q in range(0, 90, 9):
        order = sorted((i for i in range(90) if i != q), key=lambda i: (-whole[q] @ whole[i], i))[:7]
        want |= {(q, r + 1, i, int(whole[q] @ whole[i])) for r, i in enumerate(order)}
    assert {tuple(r) for r in found.collect()} == want


def test_top_k_leaves_unsound_vectors_out(spark):
    nan = float("nan")
    rows = [(0, [1.0, 1.0]), (20, None), (40, [nan, 1.0]), (1, [None, 1.0]), (None, [1.0, 1.0]), (2, [0.5]), (2, [0.25]), (3, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.top_k(topk.whole_vectors(frame), F.col("vec_id") % 20 == 0).orderBy("rank").collect()
    assert [tuple(r) for r in found] == [(0, 1, 2, 64 * 16), (0, 2, 3, 0)]
    assert topk.top_k(topk.whole_vectors(frame.limit(0)), F.col("vec_id") % 20 == 0).count() == 0


def test_top_k_takes_finite_vectors_of_any_size(spark):
    big = float(1 << 40)
    rows = [(0, [big, 1.0]), (1, [big, 0.0]), (2, [-1e30, 1.0]), (3, [3e38, 3e38])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"v": F.lit(1), "id": F.lit(1), "w": F.lit(1)})
    found = topk.top_k(topk.whole_vectors(frame), F.col("vec_id") == 0).orderBy("rank").collect()
    whole = [[int(x * 64) for x in v] for _, v in rows]
    scores = {i: sum(a * b for a, b in zip(whole[0], whole[i])) for i in (1, 2, 3)}
    end = 1 << 63
    held = {i: max(-end, min(end - 1, s)) for i, s in scores.items()}
    assert [(r["vec_id"], r["score"]) for r in found] == sorted(held.items(), key=lambda x: (-x[1], x[0]))


def test_products_are_exact_at_each_size():
    rng = np.random.default_rng(5)
    for bits in (10, 25, 29, 45):
        a, b = (rng.integers(-(1 << bits), 1 << bits, (5, 7)).astype(float) for _ in range(2))
        exact = [[sum(int(x) * int(y) for x, y in zip(r, q)) for q in b] for r in a]
        held = [[max(-(1 << 63), min((1 << 63) - 1, x)) for x in row] for row in exact]
        assert exact_scores(a, b).tolist() == held


def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_chat_windows_keep_the_budget_and_every_turn_once(spark):
    rng = random.Random(2)
    marks = ["<|end|>\n", "\\", "[INST]", "</s>", "|>", "<|user|>\n", "ä漢", "\n", "\\<"]
    rows, budget = [], 200
    for conv in range(6):
        if conv % 2:
            rows.append((conv, 0, "system", "be " + rng.choice(marks)))
        rows += [(conv, t, ["user", "assistant"][t % 2], "".join(rng.choices([*marks, "word "], k=rng.randrange(60)))) for t in range(1, 40)]
    windows = chat.chat_windows(turns(spark, rows), budget=budget, history_tokens=60).cache()
    back = chat.read_back(windows)
    got = {}
    for r in back.orderBy("conv_id", "window").collect():
        got.setdefault(r["conv_id"], []).extend((t["role"], t["text"]) for t in r["turns"])
    learned = {}
    for r in back.orderBy("conv_id", "window").collect():
        learned.setdefault(r["conv_id"], []).extend(r["learned"])
    for conv in range(6):
        mine = [r for r in sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])]
        assert got[conv] == [(r[2], r[3]) for r in mine]
        assert "".join(learned[conv]) == "".join(r[3] for r in mine if r[2] == "assistant")
    for r in windows.collect():
        shown = r["text"].split(chat.TURN_END)[:-1]
        size = sum(-(-len(t.split("|>\n", 1)[1].replace("\\", "").encode()) // 4) + 4 for t in shown)
        assert size <= budget or len(shown) - r["repeated"] == 1
        assert shown[0].startswith("<|system|>") == bool(r["conv_id"] % 2)
        assert r["repeated"] <= 3


def test_chat_of_awkward_turns(spark):
    rows = [(1, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, 1, "user", "x"), (2, 5, "assistant", "y" * 9000)]
    back = chat.read_back(chat.chat_windows(turns(spark, rows).withColumn("window", F.lit(1)))).orderBy("conv_id", "window").collect()
    said = {}
    for r in back:
        said.setdefault(r["conv_id"], []).extend((t["role"], t["text"]) for t in r["turns"])
    assert said == {1: [("", ""), ("user", "a"), ("user", "a"), ("user", "b")], 2: [("assistant", "y" * 9000)]}
    assert chat.chat_windows(turns(spark, [])).count() == 0


RULES = [("allow", "com", "/"), ("block", "bad.com", "/x/"), ("block", "net", "/"), ("allow", "ok.net", "/")]


def test_blocks_spread_over_redirects_and_canonical_links(spark):
    link = '<html><head><LINK href="{}" rel="canonical"></head>'
    jump = '<meta http-equiv="refresh" content="0; url={}">'
    pages = [
        (1, "http://a.org/1", link.format("http://b.org/2")),
        (2, "http://B.org/2#top", jump.format("//c.org/3")),
        (3, "http://c.org/3", link.format("https://www.site.net/p?x=1&amp;y=2")),
        (4, "http://www.OK.net/", link.format("http://c.org/3")),
        (5, "http://d.org/q/w", link.format("/q/e")),
        (6, "http://d.org/q/e", "<p>canonical</p>"),
        (7, "https://u.bad.com/x/y#f", None),
        (8, None, link.format("http://c.org/3")),
        (9, "no scheme", "x"),
        (9, "no scheme", "x"),
        (10, "http://notcom/", ""),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit("z"))
    rules = spark.createDataFrame(RULES, "action string, host string, path string")
    found = [tuple(r)[:5] for r in urls.judge(frame, rules).collect()]
    want = [
        (1, "a.org", "/1", None, "block"),
        (2, "b.org", "/2", None, "block"),
        (3, "c.org", "/3", None, "block"),
        (4, "www.ok.net", "/", "ok.net/", "allow"),
        (5, "d.org", "/q/w", None, "allow"),
        (6, "d.org", "/q/e", None, "allow"),
        (7, "u.bad.com", "/x/y", "bad.com/x/", "block"),
        (8, "", "", None, "allow"),
        (9, "", "", None, "allow"),
        (9, "", "", None, "allow"),
        (10, "notcom", "/", None, "allow"),
    ]
    assert sorted(found, key=str) == sorted(want, key=str)
    told = spark.createDataFrame([("http://d.org/q/e", "http://z.net/")], "url string, target string")
    verdicts = {r["page_id"]: r["verdict"] for r in urls.judge(frame, rules, told).collect()}
    assert verdicts[5] == verdicts[6] == "block"
    assert urls.judge(frame.limit(0), rules).count() == 0


def test_references_resolve_as_the_standard_says(spark):
    base = "http://Site.org/b/c/d;p?q"
    # Examples of RFC 3986, section 5.4, without fragments.
    want = {
        "g": "/b/c/g", "./g": "/b/c/g", "g/": "/b/c/g/", "/g": "/g", "?y": "/b/c/d;p?y", "g?y": "/b/c/g?y", "g#s": "/b/c/g",
        "#s": "/b/c/d;p?q", ";x": "/b/c/;x", ".": "/b/c/", "./": "/b/c/", "..": "/b/", "../": "/b/", "../g": "/b/g", "../..": "/",
        "../../g": "/g", "../../../g": "/g", "/./g": "/g", "/../g": "/g", "g.": "/b/c/g.", "..g": "/b/c/..g", "./../g": "/b/g",
        "./g/.": "/b/c/g/", "g/./h": "/b/c/g/h", "g/../h": "/b/c/h",
    }
    frame = spark.createDataFrame(list(want), "string").select(F.col("value").alias("href"), F.lit(base).alias("url"))
    found = frame.select("href", urls._absolute(F.col("url"), F.col("href"))).collect()
    assert {r[0]: r[1] for r in found} == {k: "http://site.org" + v for k, v in want.items()}


def test_blocks_reach_aliases_by_any_reference_and_no_others(spark):
    def page(i, url, target=None):
        return (i, url, f'<link rel="canonical" href="{target}">' if target else "<p>")

    rows = [
        page(1, "http://bad.org/x/y", "?p=1"), page(2, "http://a.org/l", "http://bad.org/x/y?p=1"),
        page(3, "http://bad.org/x/z/w", "../v"), page(4, "http://b.org/l", "http://bad.org/x/v"),
        page(5, "http://a.org/x\ny", "http://bad.org/x/y"), page(6, "http://a.org/x\nw"), page(7, "http://a.org/x"),
    ]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    rules = spark.createDataFrame([("block", "bad.org", "/x/")], "action string, host string, path string")
    verdicts = {r["page_id"]: r["verdict"] for r in urls.judge(frame, rules).collect()}
    assert verdicts == {1: "block", 2: "block", 3: "block", 4: "block", 5: "block", 6: "allow", 7: "allow"}


def test_the_model_is_the_same_in_each_process():
    code = (
        "import random; from churnlake.llm import toxicity as t; r = random.Random(1); w = [f'w{i}' for i in range(90)];"
        "texts = [' '.join(r.choices(w, k=12)) + (' idiot you' if i % 3 == 0 else '') for i in range(240)];"
        "m = t.fit(texts, [int(i % 3 == 0) for i in range(240)]); print(repr((m.slope, m.offset, float(m.weights.sum()), m.alphabet)))"
    )
    out = {
        subprocess.run([sys.executable, "-c", code], env={**os.environ, "PYTHONHASHSEED": s, "PYTHONPATH": ROOT}, capture_output=True, text=True, check=True).stdout
        for s in ("1", "2")
    }
    assert len(out) == 1 and out.pop()


def test_letters_of_any_script_tell_words_apart():
    kernel = toxicity.Kernel("abc")
    for a, b in (("дурак", "слово"), ("שלוםש", "מילהמ"), ("abcab", "cbacb")):
        own = kernel.scores([f" {a} "], kernel.table(f" {a} "))[0]
        assert own > 0.99 and kernel.scores([f" {b} "], kernel.table(f" {a} "))[0] < 0.8


def test_each_class_is_limited_by_itself(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, toxic: seen.append(sorted(toxic)))
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 4 != 2][:20]
    docs = make_docs(spark, [(i, f"text {i} {c}") for i in ids for c in range(3)])
    labels = spark.createDataFrame([(i, int(n % 2)) for n, i in enumerate(ids)], "doc_id long, toxic int")
    toxicity.learn(docs, labels, max_toxic=4, max_clean=6)
    assert seen == [[0] * 6 + [1] * 4]


def test_mix_comes_near_its_targets(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randrange(0, 60), rng.choice(["a", "a", "a", "b", "é", None])) for i in range(600)]
    rows += [(1000, None, "empty"), (1001, "", "empty"), (5, "x y", "b"), (5, "x y", "b")]
    found = mixing.mix_words(make_docs(spark, rows)).collect()
    assert len(found) == len(rows)
    by_id = {r[0]: r[2] for r in rows}
    taken, target, size = Counter(), {}, Counter()
    for r in found:
        source = by_id[r["doc_id"]]
        taken[source] += r["taken"]
        size[source] += r["size"]
        target[source] = r["target"]
        assert r["taken"] <= 2 * r["size"]
    assert abs(sum(target.values()) - 1.5 * sum(size.values())) < 1e-6
    assert all(target[s] <= 2 * size[s] for s in target)
    assert all(abs(taken[s] - target[s]) <= 60 for s in target)
    again = mixing.mix_words(make_docs(spark, rows).repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_mix_of_awkward_rows(spark, awkward):
    assert mixing.mix_words(awkward).count() == awkward.count()
    assert mixing.repeat(awkward).columns == awkward.columns
    assert mixing.mix_words(awkward.limit(0)).count() == 0
    assert mixing.mix_words(make_docs(spark, [(1, None), (2, "")])).select(F.sum("taken")).first()[0] == 0


def test_shards_have_near_equal_bytes_even_with_a_hot_text(spark):
    rng = random.Random(4)
    rows = [(i, "same text " * 6 if i % 3 == 0 else "x" * rng.randrange(0, 120)) for i in range(3000)]
    found = kdtree.kd_shards(make_docs(spark, rows), shards=5).collect()
    load, slots = Counter(), {}
    for r in found:
        load[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(load) == list(range(5))
    assert max(load.values()) - min(load.values()) <= 500
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = kdtree.kd_shards(make_docs(spark, rows).repartition(5), shards=5).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_shards_by_target_bytes_and_awkward_rows(spark, awkward):
    assert kdtree.kd_shards(awkward, shards=4).count() == awkward.count()
    few = kdtree.kd_shards(make_docs(spark, [(i, "y" * 99) for i in range(100)]), target_bytes=2500)
    assert few.select(F.countDistinct("shard")).first()[0] == 4
    assert kdtree.kd_shards(awkward.limit(0), target_bytes=10).count() == 0


def toxic_corpus(n):
    rng = random.Random(5)
    clean = ["".join(rng.choices("abcdeilmnorst", k=rng.randrange(2, 9))) for _ in range(3000)]
    insults = ["blargface", "snorkwit", "dunderhead"]
    texts, labels = [], []
    for i in range(n):
        text = rng.choices(clean, k=rng.randrange(20, 200))
        bad = i % 5 == 0
        if bad:
            for _ in range(3):
                text[rng.randrange(len(text))] = rng.choice(insults)
        texts.append(" ".join(text))
        labels.append(int(bad))
    return texts, labels


def test_toxicity_holds_out_and_sees_through_gaps():
    texts, labels = toxic_corpus(600)
    model = toxicity.fit(texts[:400], labels[:400])
    kernel = toxicity.Kernel(model.alphabet)
    worst = np.array([model.margins(list(toxicity.units_of(t)), kernel).max() for t in texts[400:]])
    predicted = model.probability(worst) >= 0.3
    assert np.mean(predicted == np.array(labels[400:], bool)) > 0.97
    shown = toxicity.units_of("you s n o r k w i t") | {"blarg-face", "blaargface", "d.u.n.d.e.r.h.e.a.d"}
    by_word = dict(zip(shown, model.probability(model.margins(list(shown), kernel))))
    assert all(by_word[w] >= 0.3 for w in ("snorkwit", "blarg-face", "blaargface", "d.u.n.d.e.r.h.e.a.d"))
    assert by_word["you"] < 0.3


def test_kernel_counts_shared_subsequences():
    kernel = toxicity.Kernel("abcdef")

    def plain(x, y):
        def spread(w):
            out = Counter()
            for i in range(len(w)):
                for j in range(i + 1, len(w)):
                    for k in range(j + 1, len(w)):
                        if k - i < toxicity.SPAN:
                            out[w[i] + w[j] + w[k]] += toxicity.DECAY ** (k - i + 1)
            return out

        a, b = spread(x), spread(y)
        lengths = kernel.norms(np.array([len(x), len(y)]))
        return sum(a[s] * b[s] for s in a) / lengths[0] / lengths[1]

    words_ = ["abc", "abdc", "fabcde", "cab", "aaaa", "ab"]
    found = kernel.against(words_, words_)
    assert np.allclose(found, [[plain(x, y) for y in words_] for x in words_])


def test_toxicity_without_labels_and_of_awkward_rows(spark, awkward):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.learn(awkward, labels)
    scored = toxicity.score_texts(awkward, model, "score")
    assert scored.count() == awkward.count() and set(scored.columns) == set(awkward.columns)
    assert scored.filter("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.score_texts(awkward.limit(0), model).count() == 0


@pytest.fixture(scope="module")
def model():
    return pieces.Model(piece_model())


def best_by_force(word, model, known):
    if word not in known:
        ends = [(best_by_force(word[:i], model, known) + model.score.get(word[i:], None if len(word) - i > 1 else model.unknown)) for i in range(len(word)) if len(word) - i == 1 or word[i:] in model.score]
        known[word] = max(ends)
    return known[word]


def test_viterbi_finds_the_best_score(model):
    rng = random.Random(6)
    found = sorted({" " + "".join(rng.choices("theing é漢.\n", k=rng.randrange(1, 12))).replace(" ", "") for _ in range(400)})
    cost = lambda ids: sum(model.score.get(model.pieces[i].replace("▁", " "), 0.0) for i in ids)
    for word, ids in zip(found, pieces.encode_sorted(found, model)):
        unknown = sum(c not in model.score for c in word)
        assert cost(ids) + unknown * model.unknown == pytest.approx(best_by_force(word, model, {"": 0.0}))
        assert ids == pieces.encode_sorted([word], model)[0]  # shared prefixes change nothing


def test_encoding_gives_every_text_back(spark, model, awkward):
    texts = ["", "a", " ", "  b ", "\n", "a\tb", "😀x", "\x00", "▁", "a▁b", "héé 漢字 ﷺ", "x" * 3000, " lead", "trail ", "</s><unk>"]
    docs = make_docs(spark, list(enumerate(texts))).union(awkward.select("doc_id", "text", "lang", "source", "n_chars"))
    coded = pieces.encode_documents(docs, piece_model())
    assert coded.filter("not exact").count() == 0
    back = sorted(map(str, (tuple(r) for r in pieces.decode_documents(coded, piece_model()).collect())))
    assert back == sorted(map(str, ((r[0], r[1] or "") for r in docs.select("doc_id", "text").collect())))
    assert pieces.encode_documents(docs.limit(0), piece_model()).count() == 0


def test_pieces_decode_as_in_the_library(model):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_proto=piece_model())
    coder, decoder = pieces.Encoder(model), pieces.Decoder(model)
    for text in ["The quick brown fox", "naïve café 漢字", "two  spaces"]:
        ids, counts = coder.encode([text])
        assert library.decode(ids.tolist()) == decoder.decode(ids, counts)[0] == text


def test_a_worker_keeps_no_words_of_a_finished_encoding():
    data = piece_model()
    run = lambda n: list(pieces._encode(data)(iter([pa.record_batch({"doc_id": range(n), "text": [f"word{i} other{i}" for i in range(n)]})])))
    run(1)  # the model itself stays
    tracemalloc.start()
    try:
        coded = run(20_000)
        assert sum(b.num_rows for b in coded) == 20_000 and all(all(b.column("exact").to_pylist()) for b in coded)
        del coded
        gc.collect()
        assert tracemalloc.get_traced_memory()[0] < 1 << 20
    finally:
        tracemalloc.stop()


def test_texts_are_encoded_alike_in_chunks_of_any_size(model, monkeypatch):
    texts = [f"word{i % 7} naïve {i}  漢字" * (i % 5) for i in range(200)] + [None, "", "x" * 3000]
    batch = pa.record_batch({"doc_id": range(len(texts)), "text": texts})
    told = lambda: [r for b in pieces._encode(piece_model())(iter([batch])) for r in b.to_pylist()]
    whole = told()
    monkeypatch.setattr(pieces, "OBJECT_BYTES", 500)
    assert told() == whole and len(whole) == len(texts)


def test_seeds_and_digests_read_words_alike():
    assert [len(words(t)) for t in ("a\x0bb", "a\xa0b", "\x1c")] == [2, 1, 1]
    assert hashlib.sha256(b" ".join("a\x0bb\x1c".encode().split())).digest() == hashlib.sha256(b"a b\x1c").digest()
