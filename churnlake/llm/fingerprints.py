"""Document fingerprints: a Merkle tree over sections and paragraphs, written as one string.

A text is cut at line ends into paragraphs and each paragraph into sentences: runs of at most
``SENTENCE`` code points (``OPENING`` at the start of a paragraph, so that a short text has
branches too) up to a full stop, question or exclamation mark. Paragraphs in a row
form a section; one ends after an empty paragraph and after each paragraph whose digest starts
with 0 to 3, so that an insertion moves the bounds of its own section only. A paragraph's
digest is the hash of its sentences' digests, a section's of its paragraphs', the root of its
sections'. The fingerprint holds the whole root and the first eight digits of every other
node::

    root|section:paragraph,sentence,sentence;paragraph,sentence|section:...

Equal texts have equal roots and, up to collisions of SHA-256, only they. Where the roots
differ, equal digests of sections and of paragraphs tell which branches need no look, and the
sentences below the others locate the edit. All of it is Spark SQL functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.plans.bounded import freeze, frozen_scope
from churnlake.plans.ordering import number_rows

#: Most code points of a sentence before its closing marks.
SENTENCE = 48
OPENING = 12
_SENTENCES = rf"^[^.!?]{{1,{OPENING}}}[.!?]*|[^.!?]{{1,{SENTENCE}}}[.!?]*|[.!?]+"
_SHORT = 8
_ROOT = 64


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _sha(c: Column) -> Column:
    return F.sha2(c, 256)


def _short(c: Column) -> Column:
    return F.substring(c, 1, _SHORT)


def _paragraph(text: Column) -> Column:
    """``d``, the digest, and ``s``, the short digests of the sentences with commas before."""
    digests = F.transform(F.regexp_extract_all(text, F.lit(_SENTENCES), F.lit(0)), _sha)
    return _let(
        digests,
        lambda ds: F.struct(
            _sha(F.array_join(ds, "")).alias("d"),
            F.array_join(F.transform(ds, lambda x: F.concat(F.lit(","), _short(x))), "").alias("s"),
        ),
    )


def _section(paragraphs: Column) -> Column:
    """``d``, the digest, and ``s``, the section as it stands in the fingerprint."""
    return _let(
        _sha(F.array_join(paragraphs["d"], "")),
        lambda d: F.struct(
            d.alias("d"),
            F.concat(
                F.lit("|"),
                _short(d),
                F.lit(":"),
                F.array_join(F.transform(paragraphs, lambda p: F.concat(_short(p["d"]), p["s"])), ";"),
            ).alias("s"),
        ),
    )


def _sections(paragraphs: Column) -> Column:
    n = F.size(paragraphs)

    def closes(i: Column) -> Column:
        p = paragraphs[i - 1]
        return (i == n) | (p["s"] == "") | (F.substring(p["d"], 1, 1) < "4")

    def cut(ends: Column) -> Column:
        def one(end: Column, j: Column) -> Column:
            before = F.when(j == 0, 0).otherwise(F.get(ends, j - 1))
            return _let(F.slice(paragraphs, before + 1, end - before), _section)

        return F.transform(ends, one)

    return _let(F.filter(F.sequence(F.lit(1), n), closes), cut)


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text; null counts as empty."""
    paragraphs = F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), _paragraph)
    return _let(
        _let(paragraphs, _sections),
        lambda s: F.concat(_sha(F.array_join(s["d"], "")), F.array_join(s["s"], "")),
    )


def root(mark: Column) -> Column:
    return F.substring(mark, 1, _ROOT)


def sentences(mark: Column) -> Column:
    """Short digests of all sentences of a fingerprint."""
    return F.regexp_extract_all(mark, F.lit(rf",([0-9a-f]{{{_SHORT}}})"), F.lit(1))


def likeness(a: Column, b: Column) -> Column:
    """1 if the roots are equal, else the share of distinct sentences that both have. 0 if
    neither has any."""

    def share(x: Column) -> Column:
        union = F.size(F.array_union(x["a"], x["b"]))
        return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(x["a"], x["b"])) / union)

    both = F.struct(sentences(a).alias("a"), sentences(b).alias("b"))
    return F.when(root(a) == root(b), 1.0).otherwise(_let(both, share))


def edits(a: Column, b: Column) -> Column:
    """Where ``b`` differs from ``a``: for each paragraph of ``b`` that ``a`` does not have,
    ``section`` and ``paragraph`` (from 1) and ``sentences``, its sentences (from 1) that no
    paragraph of ``a`` has. Sections that ``a`` has as a whole are passed over. Fingerprints with equal
    roots give an empty array, as does a text that only lacks parts of ``a``."""

    def branches(mark: Column) -> Column:
        each = F.split(mark, r"\|")
        return F.slice(each, 2, F.size(each))

    def paragraphs_of(section: Column) -> Column:
        return F.split(F.substring(section, _SHORT + 2, F.length(section)), ";")

    def named(items: Column, kind: str) -> Column:
        return F.transform(items, lambda x, i: F.struct((i + 1).alias(kind), x.alias("x")))

    def changed(section: Column, known: Column) -> Column:
        new = F.filter(named(paragraphs_of(section["x"]), "paragraph"), lambda p: ~F.array_contains(known["p"], _short(p["x"])))
        return F.transform(
            new,
            lambda p: F.struct(
                section["section"].alias("section"),
                p["paragraph"].alias("paragraph"),
                F.transform(
                    F.filter(named(sentences(p["x"]), "n"), lambda s: ~F.array_contains(known["l"], s["x"])), lambda s: s["n"]
                ).alias("sentences"),
            ),
        )

    def look(known: Column) -> Column:
        new = F.filter(named(branches(b), "section"), lambda s: ~F.array_contains(known["s"], _short(s["x"])))
        return F.flatten(F.transform(new, lambda s: changed(s, known)))

    of_a = _let(
        branches(a),
        lambda s: F.struct(
            F.transform(s, _short).alias("s"),
            F.flatten(F.transform(s, lambda x: F.transform(paragraphs_of(x), _short))).alias("p"),
            sentences(a).alias("l"),
        ),
    )
    return F.when(root(a) == root(b), F.array().cast("array<struct<section:int,paragraph:int,sentences:array<int>>>")).otherwise(
        _let(of_a, look)
    )


def _numbered(docs: DataFrame) -> DataFrame:
    """``key, doc_id, n, copies, row, _total`` of each document by descending doc_id (null
    last). A document is what shares doc_id and text; the key is a hash of both."""
    return number_rows(
        docs.groupBy("key").agg(
            F.min("doc_id").alias("doc_id"), F.min(F.length("text")).cast("long").alias("n"), F.count(F.lit(1)).alias("copies")
        ),
        [("doc_id", "desc")],
        ["key"],
        "row",
    )


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of documents and of edited ones: the last third of a text's code points
    gives way to as many of the next document's first (or all it has), by descending doc_id;
    after the last comes the first, so a lone document is its own next.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``,
    one row for each row of ``docs``; rows equal in doc_id and text are one document. A null
    text is empty, documents without doc_id come last. Other columns are not read.

    Order and lengths come from hashes alone. Then texts are shuffled once, by document; of a
    next document only the part that its predecessor takes moves, with its fingerprint.
    """
    text = F.coalesce("text", F.lit(""))
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    key = F.substring(F.unhex(F.sha2(F.concat(id_text, F.lit(":"), text), 256)), 1, 16)
    base = docs.select("doc_id", text.alias("text"), key.alias("key"))
    with frozen_scope(docs.sparkSession) as scope:
        order = freeze(_numbered(base), "order")
        before = order.select(
            F.col("key").alias("previous"), F.floor(F.col("n") / 3).cast("int").alias("takes"), (F.col("row") % F.col("_total") + 1).alias("row")
        )
        links = freeze(order.join(before, "row").drop("row", "_total"), "links")
        scope.keep(links)
    texts = base.groupBy("key").agg(F.first("text").alias("text"))
    own = texts.join(links, "key")
    selves = own.select(
        "key",
        "doc_id",
        "copies",
        F.col("n").alias("n_chars"),
        F.substring("text", F.lit(1), (F.col("n") - F.floor(F.col("n") / 3)).cast("int")).alias("head"),
        fingerprint(F.col("text")).alias("fingerprint"),
    )
    tails = own.select(
        F.col("previous").alias("key"),
        F.substring("text", F.lit(1), F.col("takes")).alias("tail"),
        fingerprint(F.col("text")).alias("next"),
    )
    edited = selves.join(tails, "key").withColumn("edited", F.concat("head", "tail"))
    marked = edited.withColumns(
        {"edited_sha256": _sha(F.col("edited")), "edited_fingerprint": fingerprint(F.col("edited"))}
    )
    each = marked.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return each.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next")).alias("near_next"),
    )
