"""Every stage of the pipeline against plain recomputation, and run() against the stages."""

import hashlib
from collections import Counter

import corpus_pipeline
from llm_cases import words
from test_similar import lowest, repeats_by_force, shingle_set

from churnlake.llm import mixing, toxicity
from churnlake.llm.queries import TOXIC_FROM
from churnlake.plans.bounded import freeze


def test_stages_equal_plain_recomputation(spark, base):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{base}/documents.parquet")
    columns, rows = docs.columns, docs.collect()

    model = toxicity.learn(docs, spark.read.parquet(f"{base}/labels.parquet"))
    scores = toxicity._Scorer(model)([r["text"] for r in rows])
    docs = freeze(stages["toxicity"](spark, docs, base))
    clean = sorted(r for r, s in zip(rows, scores) if s < TOXIC_FROM)
    assert docs.columns == columns and sorted(docs.collect()) == clean and len(clean) < len(rows)

    sets = [shingle_set(r["text"]) for r in clean]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    label = lowest(len(sets), links)
    docs = freeze(stages["n-gram Jaccard join"](spark, docs, base))
    single = [r for i, r in enumerate(clean) if label[i] == i]  # clean is in order of doc_id
    assert docs.columns == columns and sorted(docs.collect()) == single and len(single) < len(clean)

    want = repeats_by_force([(r["doc_id"], r["text"]) for r in single])
    docs = freeze(stages["substring dedup"](spark, docs, base))
    got = {r["doc_id"]: r for r in docs.collect()}
    assert docs.columns == columns and got.keys() == want.keys() and any(w[1] for w in want.values())
    for r in single:
        mine = got[r["doc_id"]]
        assert hashlib.sha256(" ".join(words(mine["text"])).encode()).hexdigest() == want[r["doc_id"]][2]
        assert (mine["lang"], mine["source"]) == (r["lang"], r["source"]) and mine["n_chars"] == len(mine["text"])

    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_words(docs).collect()}
    docs = freeze(stages["mixing sources to target weights"](spark, docs, base))
    taken = docs.collect()
    assert docs.columns == columns and all(r == got[r["doc_id"]] for r in taken)
    assert Counter(r["doc_id"] for r in taken) == {i: n for i, n in copies.items() if n}

    last = stages["SentencePiece encoding and decoding"](spark, docs, base).collect()
    assert all(r["exact"] for r in last) and Counter(r["doc_id"] for r in last) == Counter(r["doc_id"] for r in taken)
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, base).collect()) == sorted(tuple(r) for r in last)
