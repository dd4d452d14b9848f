"""SentencePiece encoding by shared-prefix Viterbi, and decoding.

A text, with one space put before it, is cut into marked words: a run of spaces (the model
file's word marks) and what follows up to the next space. No piece has a mark after another
character, so the best segmentation of a text is that of its marked words one after another. The distinct words of a chunk of input are sorted, which
lays them out as a trie walked depth-first: the forward scores of a word's first characters
are those of the word before it, as far as both agree, and are kept.

The score of a segmentation is the sum of its pieces' scores in the model file. Characters
without a piece cost 10 below the lowest score and are written as byte pieces; so is a word
mark that stands in a text itself, so that decoding always gives the text back.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  as pa.compute
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.llm.words import OBJECT_BYTES, chunks, tidy

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Words whose pieces a task keeps at hand; the memory is emptied when it is full.
REMEMBERED = 1_000_000


class Model:
    """Pieces, scores and byte pieces of a SentencePiece model file."""

    def __init__(self, data: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.special = [sp.is_control(i) or sp.is_unknown(i) for i in range(len(self.pieces))]
        self.score: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.byte = {}
        for i, piece in enumerate(self.pieces):
            if sp.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
            elif not self.special[i] and not sp.is_unused(i):
                marked = piece.replace(MARK, " ")
                self.ids[marked], self.score[marked] = i, sp.get_score(i)
        if any(" " in p.lstrip(" ") for p in self.ids):
            raise ValueError("a piece has a word mark inside; marked words can't be encoded one by one")
        if len(self.byte) != 256:
            raise ValueError("the model has no byte pieces, so decoding would lose characters")
        # Lengths of the pieces that end with given two characters, longest first.
        lengths: dict[str, set[int]] = {}
        for piece in self.ids:
            if len(piece) > 1:
                lengths.setdefault(piece[-2:], set()).add(len(piece))
        self.lengths = {tail: sorted(found, reverse=True) for tail, found in lengths.items()}
        self.unknown = min(self.score.values()) - UNKNOWN_PENALTY
        self.bytes_of = [
            bytes([int(p[3:5], 16)]) if i in set(self.byte.values()) else b"" if self.special[i] else p.replace(MARK, " ").encode()
            for i, p in enumerate(self.pieces)
        ]


@lru_cache(maxsize=4)
def _model(data: bytes) -> Model:
    return Model(data)


def words_of(text: str) -> list[str]:
    """Marked words of a text; an empty text has none."""
    if not text:
        return []
    words = [" " + part for part in text.split(" ")]
    if " " not in words:
        return words
    joined, run = [], ""  # a lone mark is part of the next word
    for word in words:
        if word == " ":
            run += word
        else:
            joined.append(run + word)
            run = ""
    return joined + [run] if run else joined


def encode_sorted(words: list[str], model: Model) -> list[list[int]]:
    """Best pieces of each of ``words``, which must be distinct and sorted.

    ``best[i]`` is the score of the best way to write the first i characters of the present
    word and ``back[i]`` where its last piece begins. Of equal scores the longer last piece
    counts.
    """
    score, lengths, unknown = model.score, model.lengths, model.unknown
    best, back = [0.0], [0]
    last, out = "", []
    for word in words:
        limit = min(len(word), len(last))
        same = 0
        while same < limit and word[same] == last[same]:
            same += 1
        del best[same + 1 :], back[same + 1 :]
        for end in range(same + 1, len(word) + 1):
            top, at = best[end - 1] + score.get(word[end - 1], unknown), end - 1
            for length in lengths.get(word[end - 2 : end], ()) if end > 1 else ():
                if length <= end:
                    piece = score.get(word[end - length : end])
                    if piece is not None:
                        piece += best[end - length]
                        if piece > top or (piece == top and end - length < at):
                            top, at = piece, end - length
            best.append(top)
            back.append(at)
        last = word
        pieces, end = [], len(word)
        while end:
            begin = back[end]
            known = model.ids.get(word[begin:end])
            if known is None:
                pieces.extend(model.byte[b] for b in reversed(word[begin:end].encode()))
            else:
                pieces.append(known)
            end = begin
        pieces.reverse()
        out.append(pieces)
    return out


class Decoder:
    """Texts of lists of pieces. Control pieces are left out, the space put before a text is
    taken away, and bytes that are no UTF-8 become replacement characters."""

    def __init__(self, model: Model):
        self.bytes = np.frombuffer(b"".join(model.bytes_of), np.uint8)
        self.count = np.array([len(b) for b in model.bytes_of], np.int64)
        self.begin = np.cumsum(self.count) - self.count

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        sizes = self.count[ids]
        upto = np.cumsum(sizes)
        total = int(upto[-1]) if len(ids) else 0
        data = self.bytes[np.arange(total) + np.repeat(self.begin[ids] - (upto - sizes), sizes)].tobytes()
        ends = np.concatenate([[0], upto])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [data[a + (data[a : a + 1] == b" ") : b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]


class Encoder:
    """Encodes chunks of texts, keeping the pieces of words it has seen lately.

    It goes with its task. Spark's workers live on and run the tasks of other stages, which
    would have its words beside them in the executor's memory.
    """

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, int] = {}
        self._clear()

    def _clear(self) -> None:
        self.known.clear()
        self.pieces = np.zeros(0, np.int32)
        self.begin = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)

    def _learn(self, words: list[str]) -> None:
        found = encode_sorted(words, self.model)
        counts = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((p for f in found for p in f), np.int32, int(counts.sum()))
        self.known.update(zip(words, range(len(self.count), len(self.count) + len(words))))
        self.begin = np.concatenate([self.begin, len(self.pieces) + np.cumsum(counts) - counts])
        self.count = np.concatenate([self.count, counts])
        self.pieces = np.concatenate([self.pieces, flat])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of all texts one after another, and their number per text."""
        split = [words_of(t or "") for t in texts]
        distinct = set().union(*split)
        if len(self.known) + len(distinct) > REMEMBERED:
            self._clear()
        self._learn(sorted(w for w in distinct if w not in self.known))
        known = self.known
        n = sum(map(len, split))
        which = np.fromiter((known[w] for words in split for w in words), np.int64, n)
        counts = self.count[which]
        upto = np.cumsum(counts)
        total = int(upto[-1]) if n else 0
        places = np.arange(total) + np.repeat(self.begin[which] - (upto - counts), counts)
        ends = np.concatenate([[0], upto])[np.cumsum([0] + [len(w) for w in split])]
        return self.pieces[places], np.diff(ends)


@lru_cache(maxsize=4)
def _decoder(data: bytes) -> Decoder:
    return Decoder(_model(data))


def _encode(data: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(_model(data)), _decoder(data)
        for batch in batches:
            for part in chunks(batch, each=OBJECT_BYTES):
                texts = part.column("text").to_pylist()
                ids, counts = encoder.encode(texts)
                exact = [a == (b or "") for a, b in zip(decoder.decode(ids, counts), texts)]
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                pieces = pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts, pa.int64()), pieces, pa.array(exact, pa.bool_())],
                    names=["doc_id", "n_pieces", "pieces", "exact"],
                )

    return run


def _decode(data: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(data)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                lists = part.column("pieces")
                counts = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                texts = decoder.decode(lists.flatten().to_numpy(zero_copy_only=False), counts)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return run


def encode_documents(docs: DataFrame, model: bytes) -> DataFrame:
    """``doc_id, n_pieces, pieces, exact`` for every row of ``docs (doc_id, text)``.

    ``model`` is the content of a SentencePiece model file with byte pieces. ``exact`` tells
    whether decoding the pieces gave the text back. A null or empty text has no pieces. Rows
    keep their doc_id, null or repeated as it may be; an empty table gives no rows. There is
    no shuffle.
    """
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        tidy(_encode(model)), "doc_id long, n_pieces long, pieces array<int>, exact boolean"
    )


def decode_documents(encoded: DataFrame, model: bytes) -> DataFrame:
    """``doc_id, text`` for every row of ``encoded (doc_id, pieces)``; null pieces: empty."""
    return encoded.select(F.col("doc_id").cast("long"), "pieces").mapInArrow(_decode(model), "doc_id long, text string")
