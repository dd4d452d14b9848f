"""Near copies, repeated passages and near vectors against brute force."""

import hashlib
import random

import numpy as np
from llm_cases import LOWER, make_docs, words
from pyspark.sql import functions as F

from churnlake.llm import fmindex, itq, partenum, sharedkeys
from churnlake.llm.components import components


def lowest(n, links):
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def shingle_set(text):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def near_copies(seed, n):
    rng = random.Random(seed)
    base = [[f"t{rng.randrange(400)}" for _ in range(rng.choice([3, 6, 9, 30, 90, 200]))] for _ in range(12)]
    out = []
    for i in range(n):
        text = list(rng.choice(base))
        for _ in range(rng.randrange(0, 1 + len(text) // 25)):
            text[rng.randrange(len(text))] = f"n{i}"
        out.append((i, " ".join(text).title() if i % 3 else " ".join(text)))
    return out


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 160)] + [(5, 5), (None, 3)]
    found = {r[0]: r[1] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 21)} | {i: 100 for i in range(101, 160)}


def test_components_of_no_edges(spark):
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_jaccard_groups_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(partenum, "TESTS_PER_MEMBER", 0)  # the way for large groups
    rows = near_copies(1, 150)
    sets = [shingle_set(t) for _, t in rows]
    links = [
        (a, b)
        for a in range(len(sets))
        for b in range(a)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    label = lowest(len(rows), links)
    found = {r[0]: (r[1], r[2]) for r in partenum.jaccard_groups(make_docs(spark, rows)).collect()}
    assert found == {i: (len(sets[i]), label[i]) for i in range(len(rows))}


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(3)
    for size in [1, 2, 4, 5, 6, 7, 8, 9, 12, 20, 50, 333, 1000]:
        for _ in range(60):
            pool = np.unique(rng.integers(0, 1 << 62, 2 * size + 4).astype(np.uint64))
            x = pool[:size]
            # As many differences as the threshold allows, some by removal and some by exchange.
            away = int(rng.integers(0, size // 5 + 1))
            new = int(rng.integers(0, size // 8 + 1))
            y = np.sort(np.concatenate([rng.permutation(x)[away:], pool[size : size + new]]))
            common = len(np.intersect1d(x, y))
            if len(y) and 100 * common >= 80 * (len(x) + len(y) - common):
                assert np.intersect1d(partenum.signatures(x), partenum.signatures(y)).size


def test_enumerated_pairs_survive_every_spread_of_differences():
    rng = np.random.default_rng(4)
    for size in [3, 6, 11, 16, 21, 24, 40, 90, 333, 1000]:
        x = np.unique(rng.integers(0, 1 << 64, size, dtype=np.uint64))
        band = int(np.searchsorted(partenum._bands(80), len(x)))
        groups, agreeing, bounds, pairs, salts = partenum._pairs(band, 80)
        assert agreeing >= 1 and len(pairs) % groups == 0 and len(np.unique(salts)) == len(pairs)
        assert len(np.unique(pairs, axis=0)) == len(pairs)
        for turn in range(40):
            # Removals, first of the elements whose ranges spoil most groups, or of one range.
            at = np.searchsorted(bounds, x, side="right") - 1
            order = np.lexsort((rng.random(len(x)), at if turn % 2 else rng.permutation(len(bounds))[at]))
            once = order[np.unique(at[order], return_index=True)[1]] if turn % 3 else order
            gone = once[: len(x) // 5]
            y = np.delete(x, gone)
            if len(y) * 100 >= 80 * len(x):
                assert np.intersect1d(partenum.signatures(x), partenum.signatures(y)).size


def test_members_of_a_signature_settled_in_one_chunk_and_alone_in_others():
    import pyarrow as pa

    n, m, p, key = 5, 7, 9, 1234
    chunks = [[n, m], [n], [p]]
    parts = [sharedkeys.pack(np.full(len(c), key), np.array(c), np.zeros(len(c)), 4, i) for i, c in enumerate(chunks)]
    table = pa.Table.from_batches(parts)
    members = set()
    for b in range(4):
        found = partenum._buckets(table.filter(pa.compute.equal(table["bin"], b)))
        members |= {r["b"] for r in found.to_pylist() if r["kind"] == partenum._MEMBER and r["a"] == key}
    assert members == {n, m, p}


def test_jaccard_groups_of_awkward_rows(spark, awkward):
    found = sorted(((r[0], r[1], r[2]) for r in partenum.jaccard_groups(awkward).collect()), key=str)
    n = 40_000 - 4
    want = [(1, 2, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4), (5, n, 5), (6, n, 5), (None, 1, None), (7, 1, 7), (7, 1, 7)]
    assert found == sorted(want, key=str)
    assert partenum.jaccard_groups(awkward.limit(0)).count() == 0
    kept = partenum.one_per_group(awkward)
    assert kept.columns == awkward.columns
    assert sorted((str(r[0]) for r in kept.select("doc_id").collect())) == sorted(map(str, [1, 2, 3, 4, 5, 7, None]))


def test_one_per_group_goes_by_document_and_text(spark):
    same, other = "a b c d e f g", "unique words of its own here"
    rows = [(1, same), (5, same), (5, other), (5, other), (None, same), (6, same), (6, None), (1, same)]
    names = ("d", "h", "hash", "group", "node", "stays", "copies", "first")
    docs = make_docs(spark, rows).withColumns({n: F.lit("z") for n in names})
    kept = partenum.one_per_group(docs)
    assert kept.columns == docs.columns
    found = sorted(((r[0], r[1]) for r in kept.select("doc_id", "text").collect()), key=str)
    assert found == sorted([(1, same), (5, other), (None, same), (6, None)], key=str)


def test_signatures_shared_by_many_components(spark):
    # One run of boilerplate in otherwise different texts: shared shingles, no links but copies.
    boiler = " ".join(f"b{i}" for i in range(30))
    rows = [(i, boiler + " " + " ".join(f"t{i // 3}_{j}" for j in range(30 + i % 3))) for i in range(150)]
    sets = [shingle_set(t) for _, t in rows]
    links = [(a, b) for a in range(150) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    label = lowest(150, links)
    found = {r[0]: r[2] for r in partenum.jaccard_groups(make_docs(spark, rows)).collect()}
    assert found == dict(enumerate(label)) and len(set(label)) == 50


def test_members_of_a_signature_are_tested_in_tiles(spark, monkeypatch):
    rng = np.random.default_rng(5)
    sets = []
    for size in [3, 3, 100, 118, 131, 150] * 4:
        base = np.unique(rng.integers(0, 1 << 62, size).astype(np.uint64))
        for away in [0, 1, size // 12, size // 8, size // 5, size // 3]:
            new = rng.integers(0, 1 << 62, away // 2).astype(np.uint64)
            sets.append(np.unique(np.concatenate([rng.permutation(base)[away:], new])))
    sketches = [partenum._sketch(x) for x in sets]
    assert len({len(s) for s in sketches}) == 2  # some pairs need folding
    # One signature of all, of which every third is in the main component; one of a few; one without.
    lists = [(1, range(len(sets)), 0), (2, range(0, len(sets), 7), 7), (3, range(4), 0)]
    part = lambda key, i, main: main if i % 3 == main % 3 and key != 3 else 6 * (i // 6)
    rows = [(key, i, part(key, i, main), main, len(sets[i]), sketches[i].tolist()) for key, of, main in lists for i in of]
    want = set()
    for key, a, ca, main, na, sa in rows:
        for other, b, cb, _, nb, sb in rows:
            short = min(len(sa), len(sb))
            fold = lambda s: np.bitwise_xor.reduce(np.reshape(s, (-1, short)))  # noqa: E731, B023
            if key == other and ca != main and ca != cb and min(na, nb) * 100 >= max(na, nb) * 80:
                flips = int(np.bitwise_count((fold(sa) ^ fold(sb)).view(np.uint64)).sum())
                if flips * 180 <= (na + nb) * 20:
                    want.add((min(a, b), max(a, b)))
    assert len(want) > 10
    frame = spark.createDataFrame(rows, "key long, node long, component long, main long, n int, sketch array<long>")
    firsts = F.array_sort(F.collect_set("key")).alias("first_keys")
    frame = frame.join(frame.groupBy("node").agg(firsts), "node")
    for side in (4096, 16, 1):
        monkeypatch.setattr(partenum, "TILE_ROWS", side, raising=False)
        met = partenum._across(frame, 80)
        found = [(r[0], r[1]) for r in met.collect()]
        assert len(found) == len(want) and set(found) == want
        # A pair that is dropped is never a row.
        assert "bit_count" not in met._jdf.queryExecution().toString()
    assert partenum._across(frame.limit(0), 80).count() == 0


def repeats_by_force(rows, width=13):
    known = {}
    for i, text in sorted(rows):
        w = words(text)
        for j in range(len(w) - width + 1):
            known.setdefault(tuple(w[j : j + width]), i)
    out = {}
    for i, text in rows:
        w = words(text)
        stay = [True] * len(w)
        for j in range(len(w) - width + 1):
            if known[tuple(w[j : j + width])] < i:
                stay[j : j + width] = [False] * width
        kept = " ".join(x for x, s in zip(w, stay) if s)
        out[i] = (len(w), len(w) - sum(stay), hashlib.sha256(kept.encode()).hexdigest())
    return out


def passages(seed, n):
    rng = random.Random(seed)
    shared = [[f"p{k}_{i % 9}" for i in range(rng.choice([12, 13, 14, 40, 90]))] for k in range(6)]
    rows = []
    for i in range(n):
        text = []
        for _ in range(rng.randrange(0, 5)):
            text += [f"u{rng.randrange(60)}" for _ in range(rng.randrange(0, 30))] + rng.choice(shared)[rng.randrange(0, 5) :]
        rows.append((i, "  ".join(text)))
    return rows


def test_repeats_equal_brute_force_on_both_ways(spark):
    rows = passages(4, 120)
    for frequent in (fmindex.FREQUENT, 2):
        found = fmindex.repeat_digest(make_docs(spark, rows), frequent=frequent).collect()
        assert {r[0]: (r[1], r[2], r[3]) for r in found} == repeats_by_force(rows)


def test_segments_of_the_same_words_in_another_order():
    import pyarrow as pa

    rng = random.Random(9)
    texts = ["x y p q y x r s t u v w z", "y x p q x y r s t u v w z"]
    texts += [" ".join(rng.choice(["no", "yes"]) for _ in range(rng.randrange(13, 24))) for _ in range(150)]
    texts += texts[:2]
    everywhere = [[np.arange(len(t.split()), dtype=np.int32).tobytes()] for t in texts]
    batch = pa.table({"doc_id": list(range(len(texts))), "text": texts, "places": everywhere}).to_batches()[0]
    found = [r for part in fmindex._segments(13)(iter([batch])) for r in part.to_pylist()]
    first = {}
    for r in sorted(found, key=lambda r: r["doc_id"]):
        segment = tuple(texts[r["doc_id"]].split()[r["start"] : r["start"] + r["length"]])
        sent = first.setdefault(segment, r["doc_id"]) == r["doc_id"]
        assert r["words"] == (" ".join(segment) if sent else None)
    assert {r["doc_id"] for r in found if r["words"] is None} >= {len(texts) - 2, len(texts) - 1}


def test_a_chunk_sends_each_segment_once(spark):
    """Also windows that segments of different words share, and a document's own repeats."""
    import pyarrow as pa

    line = " ".join(f"l{i}" for i in range(13))
    texts = ["of " * 500] + [f"a{i} b{i} {line} c{i} d{i}" for i in range(40)] + [f"{line} of " + "of " * 30]
    everywhere = [[np.arange(len(t.split()), dtype=np.int32).tobytes()] for t in texts]
    batch = pa.table({"doc_id": list(range(len(texts))), "text": texts, "places": everywhere}).to_batches()[0]
    keys = np.unique([r["key"] for part in fmindex._segments(13)(iter([batch])) for r in part.to_pylist()])
    all_windows = {tuple(t.split()[i : i + 13]) for t in texts for i in range(len(t.split()) - 12)}
    for often in (keys[:0], keys):
        dealt = [r for part in fmindex._dealt(13, 3, often)(iter([batch])) for r in part.to_pylist()]
        sizes = [np.frombuffer(r["sizes"], np.int32) for r in dealt if r["words"]]
        bounds = [np.cumsum(np.append(0, n)) for n in sizes]
        sent = [r["words"][a:b] for r, at in zip([r for r in dealt if r["words"]], bounds) for a, b in zip(at, at[1:])]
        assert len(sent) == len(set(sent)) and b" ".join([b"of"] * 13) in sent
        assert len(often) == 0 or {tuple(w.decode().split()) for w in sent} == all_windows
        shards = [fmindex._judge(13)(pa.Table.from_pylist([r for r in dealt if r["shard"] == k], pa.schema([(n, pa.int32() if n == "shard" else pa.binary()) for n in fmindex._DEALT_NAMES]))) for k in range(3)]
        gone = {(d, w) for t in shards for d, a, b in zip(*(t[c].to_pylist() for c in ("doc_id", "start", "until"))) for w in range(a, b)}
        lost = repeats_by_force(list(enumerate(texts)))
        assert {i: sum(d == i for d, _ in gone) for i in lost} == {i: n for i, (_, n, _) in lost.items()}


def test_repeats_of_awkward_rows(spark, awkward):
    found = sorted(((r[0], r[1], r[2]) for r in fmindex.repeat_digest(awkward).collect()), key=str)
    want = [(1, 6, 0), (2, 0, 0), (3, 0, 0), (4, 0, 0), (5, 40_000, 0), (6, 40_000, 40_000), (None, 2, 0), (7, 1, 0), (7, 1, 0)]
    assert found == sorted(want, key=str)
    cut = fmindex.without_repeats(awkward)
    assert cut.columns == awkward.columns and cut.count() == awkward.count()
    assert {(r[0], r[1]) for r in cut.select("doc_id", "n_chars").filter("doc_id in (1, 6)").collect()} == {(1, 11), (6, 0)}
    assert fmindex.repeat_digest(awkward.limit(0)).count() == 0


def test_backward_search_gives_every_range():
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 12, 60)
    symbols = rng.integers(1, 5, lengths.sum())
    owners = rng.integers(0, 40, 60)
    index = fmindex.FMIndex(symbols, lengths, owners, 5)
    texts = np.split(symbols, np.cumsum(lengths)[:-1])
    for _ in range(200):
        pattern = rng.integers(1, 5, rng.integers(1, 5))
        low, high = np.array([0]), np.array([index.size])
        for c in pattern[::-1]:
            low, high = index.extend(np.array([c]), low, high)
        at = [o for t, o in zip(texts, owners) for i in range(len(t)) if t[i : i + len(pattern)].tolist() == pattern.tolist()]
        assert int(high[0] - low[0]) == len(at)
        if at:
            assert index.least.of(low, high)[0] == min(at)


def test_shared_keys_are_whole_across_chunks():
    import pyarrow as pa

    rng = np.random.default_rng(6)
    keys, owners = rng.integers(0, 60, 400).astype(np.uint64), rng.integers(0, 50, 400)
    parts = [sharedkeys.pack(keys[i::3], owners[i::3], np.arange(400)[i::3], 4, i) for i in range(3)]
    table = pa.Table.from_batches(parts)
    found = set()
    for b in range(4):
        for k, o, e, fresh in sharedkeys.bin_groups(table.filter(pa.compute.equal(table["bin"], b))):
            found |= set(zip(k[fresh].tolist(), o[fresh].tolist(), e[fresh].tolist()))
    several = {k for k in set(keys.tolist()) if len(set(owners[keys == k].tolist())) > 1}
    assert found == {(int(k), int(o), i) for i, (k, o) in enumerate(zip(keys, owners)) if int(k) in several}


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_near_vectors_recall_and_exactness(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(40, 64))
    rows = [(i, [float(x) for x in base[i % 40] + rng.normal(size=64) * rng.choice([0, 0.05, 0.2])]) for i in range(400)]
    x = np.array([r[1] for r in rows], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    close = x @ x.T >= 0.9
    n = close.sum(axis=1) - 1
    for block in (itq.BLOCK, 4):
        found = {r[0]: r for r in itq.near_groups(vectors(spark, rows), block=block).collect()}
        mine = np.array([found[i]["n_links"] for i in range(400)])
        assert (mine <= n).all() and mine.sum() >= 0.9 * n.sum()
        assert all(found[i]["kept"] == (found[i]["component_id"] == i) for i in found)
        label = lowest(400, list(zip(*np.nonzero(close))))
        assert np.mean([found[i]["component_id"] == label[i] for i in range(400)]) >= 0.9


def spread_pairs(seed, n, mean):
    """Unit vectors with a common mean, and for each one of cosine 0.90 to 0.96 with it."""
    rng = np.random.default_rng(seed)
    unit = lambda x: x / np.linalg.norm(x, axis=1)[:, None]
    m = np.zeros(64)
    m[0] = mean
    draw = lambda: unit(unit(rng.normal(size=(n, 64))) * np.sqrt(1 - mean * mean) + m)
    x, away = draw(), draw()
    away = unit(away - (away * x).sum(axis=1)[:, None] * x)
    cosine = rng.uniform(0.9, 0.96, n)[:, None]
    return x, cosine * x + np.sqrt(1 - cosine**2) * away


def test_near_vectors_recall_close_to_the_threshold(spark):
    for mean in (0.0, 0.8):
        x = np.concatenate(spread_pairs(3, 1500, mean)).astype(np.float32)
        rows = [(i, v) for i, v in enumerate(x.tolist())]
        x = x.astype(float)
        x /= np.linalg.norm(x, axis=1)[:, None]
        n = (x @ x.T >= 0.9).sum(axis=1) - 1
        mine = np.array([r[1] for r in sorted(itq.near_groups(vectors(spark, rows)).collect())])
        assert (mine <= n).all() and mine.sum() >= 0.95 * n.sum()


def test_tables_for_many_vectors_catch_pairs_close_to_the_threshold():
    for mean in (0.0, 0.8):
        x, y = spread_pairs(4, 3000, mean)
        model = itq.learn(x)
        for count in (500, 10_000, 1_000_000):
            model.tables = itq.choose_tables(model, x[:count], count, 0.9)
            assert model.tables.shape[1] > 0  # not by comparing all with all
            met = (model.parts(model.codes(x)) == model.parts(model.codes(y))).any(axis=1)
            assert met.mean() >= 0.95


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0])]
    rows += [(9, [1.0, 0.0]), (None, [1.0, 0.0]), (10, [0.0, 1.0, 0.0]), (11, [0.0, 5.0])]
    found = {r[0]: tuple(r[1:]) for r in itq.near_groups(vectors(spark, rows)).collect()}
    assert found[1] == (2, 1, True) and found[2] == (2, 1, False) and found[9] == (2, 1, False)
    assert all(found[i] == (0, i, True) for i in range(3, 9)) and found[None] == (0, None, False)
    assert found[10] == (1, 10, True) and found[11] == (1, 10, False)
    assert itq.near_groups(vectors(spark, [])).count() == 0
