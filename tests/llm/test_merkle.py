"""Dataset manifests and document fingerprints against plain recomputation."""

import hashlib
import re
import zlib

import pytest
from llm_cases import DOCS, make_docs
from pyspark.sql import functions as F

from churnlake.llm import fingerprints, manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(nodes, fan):
    """Root of a list of digests, and per leaf the siblings left and right at each level."""
    siblings, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, a in enumerate(at):
            run = a // fan * fan
            siblings[i].append(("".join(nodes[run:a]), "".join(nodes[a + 1 : run + fan])))
        at = [a // fan for a in at]
        nodes = [sha("".join(nodes[j : j + fan])) for j in range(0, len(nodes), fan)]
    return nodes[0], siblings


def plain_manifest(rows, fan, every=7):
    def leaf(r, more=0):
        values = (r["doc_id"], r["source"], r["lang"], None if r["n_chars"] is None else r["n_chars"] + more, r["text"])
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    ordered = [sorted(groups[x], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r))) for x in langs]
    trees = [tree([leaf(r) for r in rs], fan) for rs in ordered]
    root, tops = tree([t[0] for t in trees], fan)
    out = []
    for rs, (subroot, siblings), top in zip(ordered, trees, tops):
        for r, below in zip(rs, siblings):
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % every == 0
            folded = leaf(r, int(hit))
            for a, b in below + top:
                folded = sha(a + folded + b)
            proof = sha("".join(a + b for a, b in below + top))
            out.append((r["doc_id"], leaf(r), subroot, root, proof, folded, folded == root))
    return sorted(out, key=str)


def found_manifest(docs, **how):
    return sorted((tuple(r) for r in manifest.checked_manifest(docs, **how).collect()), key=str)


@pytest.mark.parametrize("fan, depth", [(2, 8), (2, 2), (3, 1)])
def test_manifest_equals_plain_trees(spark, fan, depth):
    rows = [(i, f"text {i} é漢", ["en", "de", None, "", "fr"][min(i % 7, 4)], None if i % 3 else "s", i) for i in range(83)]
    rows += [(900, "alone", "zz", "s", 5)]
    docs = spark.createDataFrame(rows, DOCS)
    assert found_manifest(docs, fan=fan, depth=depth) == plain_manifest([r.asDict() for r in docs.collect()], fan)


def test_manifest_of_awkward_rows(spark, awkward):
    nulls = make_docs(spark, [(None, None)]).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in make_docs(spark, []).schema])
    names = ("grp", "node", "item", "row", "place", "block", "levels", "above", "carry", "leaf", "altered", "_grp", "_total")
    docs = awkward.unionByName(nulls, allowMissingColumns=True).withColumns({n: F.lit(1) for n in names})
    assert found_manifest(docs) == plain_manifest([r.asDict() for r in docs.collect()], 2)


def test_manifest_of_one_row_and_of_none(spark):
    one = make_docs(spark, [(3, "x")])
    (row,) = manifest.checked_manifest(one).collect()
    assert row["leaf"] == row["subroot"] == row["root"] and row["proof_sha256"] == sha("") and row["verified"]
    assert manifest.checked_manifest(one.limit(0)).count() == 0


def test_tampering_shows(spark):
    docs = make_docs(spark, [(i, f"t{i}") for i in range(60)])
    rows = manifest.checked_manifest(docs).collect()
    assert {r["doc_id"] for r in rows if not r["verified"]} == {i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 0}


SENTENCES = re.compile(r"\A[^.!?]{1,12}[.!?]*|[^.!?]{1,48}[.!?]*|[.!?]+")


def mark(text):
    paragraphs = []
    for p in text.split("\n"):
        digests = [sha(s) for s in SENTENCES.findall(p)]
        paragraphs.append((sha("".join(digests)), [d[:8] for d in digests]))
    sections, current = [], []
    for p in paragraphs:
        current.append(p)
        if not p[1] or p[0][0] < "4":
            sections.append(current)
            current = []
    sections += [current] if current else []
    digests = [sha("".join(p[0] for p in s)) for s in sections]
    shown = [d[:8] + ":" + ";".join(",".join([p[0][:8], *p[1]]) for p in s) for d, s in zip(digests, sections)]
    return "|".join([sha("".join(digests)), *shown])


def like(a, b):
    x, y = (set(re.findall(",([0-9a-f]{8})", m)) for m in (a, b))
    return 1.0 if a[:64] == b[:64] else len(x & y) / len(x | y) if x | y else 0.0


def plain_fingerprints(rows):
    def key(d):
        ident = "-" if d[0] is None else str(d[0])
        return (d[0] is None, -(d[0] or 0), sha(f"{ident}:{d[1]}"))

    docs, out = sorted({(r["doc_id"], r["text"] or "") for r in rows}, key=key), {}
    for i, (doc, text) in enumerate(docs):
        after, cut = docs[(i + 1) % len(docs)][1], len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        marks = mark(text), mark(edited)
        out[doc, text] = (doc, len(text), sha(edited), *marks, like(*marks), like(marks[0], mark(after)))
    return sorted([out[r["doc_id"], r["text"] or ""] for r in rows], key=str)


def found_fingerprints(docs):
    return sorted((tuple(r) for r in fingerprints.edited_fingerprints(docs).collect()), key=str)


def test_fingerprints_equal_plain_ones(spark):
    line = "Who said so? I did! Then it went on without an end in sight for quite a while, 漢字 and all.."
    rows = [(i, "\n".join(f"{line[: 7 * k % 90]} {i} {k}" if k % 5 else "" for k in range(i % 23))) for i in range(40)]
    docs = make_docs(spark, rows)
    assert found_fingerprints(docs) == plain_fingerprints([r.asDict() for r in docs.collect()])


def test_fingerprints_of_awkward_rows(spark, awkward):
    names = ("key", "copies", "previous", "takes", "head", "tail", "next", "fingerprint", "n", "row", "_total", "copy")
    docs = awkward.unionByName(make_docs(spark, [(7, "another"), (8, "\n\n"), (9, "a. \U0001f600!")]), allowMissingColumns=True)
    docs = docs.withColumns({n: F.lit("z") for n in names})
    assert found_fingerprints(docs) == plain_fingerprints([r.asDict() for r in docs.collect()])
    assert fingerprints.edited_fingerprints(docs.limit(0)).count() == 0


def test_a_lone_document_is_its_own_next(spark):
    (row,) = fingerprints.edited_fingerprints(make_docs(spark, [(1, "abcdef")])).collect()
    assert row["edited_sha256"] == sha("abcdab") and row["near_next"] == 1.0


def test_equal_roots_mean_equal_texts(spark):
    texts = ["a b", "a b\n", "a\nb", "a b.", "", "\n", "a  b", "A b"]
    marks = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(fingerprints.fingerprint(F.col("t"))).collect()]
    assert len({m[:64] for m in marks}) == len(texts)


def test_edits_are_located(spark):
    before = "\n".join(f"Opening number {i} here. Then a second one. And a third." for i in range(30))
    lines = before.split("\n")
    lines[11] = lines[11].replace("second", "changed")
    lines.insert(20, "Something new.")
    after = "\n".join(lines)
    frame = spark.createDataFrame([(before, after)], "a string, b string")
    marks = frame.select(fingerprints.fingerprint(F.col("a")).alias("a"), fingerprints.fingerprint(F.col("b")).alias("b"))
    found, none, fresh = marks.select(
        fingerprints.edits(F.col("a"), F.col("b")), fingerprints.edits(F.col("b"), F.col("b")), F.col("b")
    ).first()
    assert none == []
    sections = [s.split(":")[1].split(";") for s in fresh.split("|")[1:]]
    spots = [sum(len(s) for s in sections[: e["section"] - 1]) + e["paragraph"] - 1 for e in found]
    assert spots == [11, 20]
    assert [e["sentences"] for e in found][0] and len(found[0]["sentences"]) < 4
