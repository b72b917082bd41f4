"""SentencePiece encoding and decoding over a relational lattice.

A piece table comes from a model file.  Texts are cut into words, each with the blanks
before it; no piece of the model reaches over the start of a word, so words are encoded
alone.  The most frequent words of the corpus are encoded as relations: their substrings
of bounded length are exploded and joined to the piece table on equality, the edges are
grouped by word, and a fold of Spark's ``aggregate`` finds the path.  The result is a
dictionary of at most ``DICTIONARY_WORDS`` words, small enough to be broadcast, which covers
most of any text.  Texts are then encoded map-only: a word that is not in the dictionary
goes through the same lattice in the task that meets it, so no occurrence of a word is ever
shuffled.

Two folds find a path.  For models with log-probabilities, the Viterbi fold: the path with
the largest sum of scores; of equal paths, the one whose last piece is longest, and so on
towards the front.  Scores of a byte-pair model are only the order of its merges, and their
sums mean nothing; its ids come from the merge fold, which joins the neighbouring parts whose
piece has the best score, the leftmost of equals, until none is left.  ``Pieces.merges`` tells
which; it is read off the scores.

Every character has a way through, as the bytes of its UTF-8 form, at a score below all
pieces.  Decoding therefore gives back every text exactly.

Defined results: a null text is encoded as null and an empty one as no ids; blanks, line
feeds, and U+2581 (which models write for a blank) all survive; repeated rows are encoded
one by one; other columns, whatever their names, pass through.
"""

from __future__ import annotations

import re
from array import array
from dataclasses import dataclass, field
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.frames import most_frequent, once, quoted, unused, with_column_in_arrow, written

DICTIONARY_WORDS = 200_000

# Longer words are left to the tasks that meet them; the dictionary stays bounded.
LONGEST_WORD = 64

_BLANK = "▁"
_WORDS = re.compile(r"(?<=[^ ])(?= )").split


@dataclass
class Pieces:
    """A piece table: scores and ids by text (with plain blanks), and ids of single bytes."""

    scores: dict[str, tuple[float, int]]
    bytes_of: list[int]
    texts: list[bytes]
    merges: bool = False
    known: dict[str, bytes] = field(default_factory=dict)

    MOST_WORDS = 200_000

    @classmethod
    def load(cls, model: str) -> Pieces:
        """From a SentencePiece model file whose pieces do not reach over the start of a word."""
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=model)
        scores, single, texts = {}, [0] * 256, []
        for i in range(processor.vocab_size()):
            piece = processor.id_to_piece(i)
            if processor.is_byte(i):
                single[int(piece[1:-1], 16)] = i
                texts.append(bytes([int(piece[1:-1], 16)]))
            elif processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i):
                texts.append(b"")
            else:
                text = piece.replace(_BLANK, " ")
                if re.search("[^ ] ", text):
                    raise ValueError(f"piece {piece!r} reaches over the start of a word")
                scores[text] = (processor.get_score(i), i)
                texts.append(text.encode())
        # Merges are numbered: whole scores that fall by one from each piece to the next.
        ordered = sorted(scores.values(), key=lambda v: v[1])[-1000:]
        merges = all(a[0] - b[0] == b[1] - a[1] for a, b in zip(ordered, ordered[1:]))
        return cls(scores, single, texts, merges)

    def __getstate__(self) -> dict:
        return {k: self.__dict__[k] for k in ("scores", "bytes_of", "texts", "merges", "known")}

    def path(self, word: str) -> list[int]:
        """Ids of a word, by the fold that the model asks for."""
        return self.merged_path(word) if self.merges else self.best_path(word)

    def _single(self, character: str) -> list[int]:
        found = self.scores.get(character)
        return [found[1]] if found else [self.bytes_of[b] for b in character.encode()]

    def merged_path(self, word: str) -> list[int]:
        """Ids of one word by merging neighbours, best score first, leftmost of equals."""
        return self._merged_short(word) if len(word) <= LONGEST_WORD else self._merged_long(word)

    def _merged_short(self, word: str) -> list[int]:
        """By looking at all neighbours after each merge."""
        parts, score, none = list(word), self._score.get, self._byte_score
        best = [score(word[i : i + 2], none) for i in range(len(word) - 1)]
        while best:
            top = max(best)
            if top == none:
                break
            i = best.index(top)
            parts[i] = joined = parts[i] + parts.pop(i + 1)
            del best[i]
            if i:
                best[i - 1] = score(parts[i - 1] + joined, none)
            if i < len(best):
                best[i] = score(joined + parts[i + 1], none)
        ids, out = self._id, []
        for part in parts:
            found = ids(part)
            if found is None:
                out += self._single(part)
            else:
                out.append(found)
        return out

    def _merged_long(self, word: str) -> list[int]:
        """With a heap of neighbours, for words of any length."""
        n, scores = len(word), self.scores
        after = list(range(1, n + 1))  # where the part that begins here ends; 0 once it is gone
        before = list(range(-1, n))  # where the part in front of this place begins
        heap: list[tuple[float, int, int, int]] = []

        def offer(start: int) -> None:
            middle = after[start]
            if start >= 0 and middle < n:
                found = scores.get(word[start : after[middle]])
                if found:
                    heappush(heap, (-found[0], start, middle, after[middle]))

        for start in range(n):
            offer(start)
        while heap:
            _, start, middle, end = heappop(heap)
            if after[start] != middle or after[middle] != end:
                continue
            after[start], after[middle] = end, 0
            if end < n:
                before[end] = start
            if before[start] >= 0:
                offer(before[start])
            offer(start)
        out, at = [], 0
        while at < n:
            part = word[at : after[at]]
            out += [scores[part][1]] if len(part) > 1 else self._single(part)
            at = after[at]
        return out

    @property
    def longest(self) -> int:
        return max(map(len, self.scores))

    @property
    def byte_score(self) -> float:
        """Score of one byte, below that of any path of pieces worth taking."""
        return min(score for score, _ in self.scores.values()) - 10.0

    def best_path(self, word: str) -> list[int]:
        """Ids of the best path through the lattice of one word."""
        n, longest, scores = len(word), self._longest, self.scores
        best = [0.0] + [float("-inf")] * n
        back: list[tuple[int, list[int]]] = [(0, [])] * (n + 1)
        for end in range(1, n + 1):
            for start in range(max(0, end - longest), end):
                found = scores.get(word[start:end])
                if found is not None and best[start] + found[0] > best[end]:
                    best[end], back[end] = best[start] + found[0], (start, [found[1]])
            raw = word[end - 1].encode()
            score = best[end - 1] + len(raw) * self._byte_score
            if score > best[end]:
                best[end], back[end] = score, (end - 1, [self.bytes_of[b] for b in raw])
        path: list[list[int]] = []
        at = n
        while at:
            at, ids = back[at]
            path.append(ids)
        return [i for ids in reversed(path) for i in ids]

    def ready(self) -> Pieces:
        self._longest, self._byte_score = self.longest, self.byte_score
        self._score = {text: score for text, (score, _) in self.scores.items()}
        self._id = {text: i for text, (_, i) in self.scores.items()}.get
        self._remembered = _Remembered(self)
        return self

    def ids(self, text: str) -> np.ndarray:
        """Ids of a text."""
        if not text:
            return np.empty(0, np.int32)
        words = _WORDS(" " + text)
        return np.frombuffer(b"".join(map(self._remembered.__getitem__, words)), np.int32)

    def text(self, ids: np.ndarray) -> str:
        """The text of a sequence of ids."""
        raw = b"".join(map(self.texts.__getitem__, ids.tolist()))
        return raw.decode(errors="replace")[1:]


class _Remembered(dict):
    """Ids of the words of the dictionary, and of others as they are met, so many at a time."""

    def __init__(self, pieces: Pieces):
        super().__init__(pieces.known)
        self.pieces = pieces
        self.most = len(self) + pieces.MOST_WORDS

    def __missing__(self, word: str) -> bytes:
        part = array("i", self.pieces.path(word)).tobytes()
        if len(self) >= self.most:
            self.clear()
            self.update(self.pieces.known)
        self[word] = part
        return part


def frequent_words(docs: DataFrame, text: str, most: int = DICTIONARY_WORDS) -> DataFrame:
    """The most frequent words, ``word``, of all texts, nearly ``most``."""
    cut = once(f"split(concat(' ', {quoted(text)}), '(?<=[^ ])(?= )', -1)")
    filled = docs.filter(F.length(quoted(text)) > 0).select(F.expr(cut).alias("words"))
    words = filled.select(F.explode("words").alias("word")).filter(f"length(word) <= {LONGEST_WORD}")
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    # A word that occurs once is no gain over the task that meets it.
    return most_frequent(written(counts.filter("n > 1"), "counts"), most, "word").select("word")


def lattice(words: DataFrame, pieces: Pieces) -> DataFrame:
    """Edges of each word: ``word``, ``start``, ``end``, ``score`` and ``ids``.

    Substrings are joined to the piece table, which is as large as the model's vocabulary;
    characters also have an edge of bytes.
    """
    spark = words.sparkSession
    table = spark.createDataFrame(
        [(text, score, i) for text, (score, i) in pieces.scores.items()], "piece string, piece_score double, id int"
    )
    spans = (
        "transform(sequence(0, length(word) - 1), s -> transform(sequence(1, "
        f"least({pieces.longest}, length(word) - s)), n -> struct(s AS start, s + n AS end, substring(word, s + 1, n) AS piece)))"
    )
    cut = words.filter("length(word) > 0").select("word", F.expr(once(f"flatten({spans})")).alias("spans"))
    exploded = cut.select("word", F.explode("spans").alias("e")).select("word", "e.*")
    joined = exploded.join(F.broadcast(table), "piece").select(
        "word", "start", "end", F.col("piece_score").alias("score"), F.array("id").alias("ids")
    )
    single = exploded.filter("end = start + 1")
    code = "conv(substring(hex(encode(piece, 'UTF-8')), 2 * i + 1, 2), 16, 10)"
    values = "array(" + ", ".join(map(str, pieces.bytes_of)) + ")"
    raw = f"transform(sequence(0, octet_length(piece) - 1), i -> get({values}, cast({code} AS int)))"
    fallback = single.select(
        "word", "start", "end",
        F.expr(f"octet_length(piece) * cast({pieces.byte_score!r} AS double)").alias("score"), F.expr(raw).alias("ids"),
    )
    return joined.unionByName(fallback)


def best_paths(edges: DataFrame) -> DataFrame:
    """``word`` and the ``ids`` of its best path, by folds over its edges."""
    to = edges.groupBy("word", "end").agg(
        F.sort_array(F.collect_list(F.struct("start", "score", "ids"))).alias("ways")
    )
    whole = to.groupBy("word").agg(F.sort_array(F.collect_list(F.struct("end", "ways"))).alias("steps"))
    # Forward: the best score to each place, and the way into it.  Of equal ways the one
    # from the earliest start comes first in the order of the edges, and is kept.
    way = """aggregate(step.ways, struct(cast('-Infinity' AS double) AS score, -1 AS start, cast(array() AS array<int>) AS ids),
        (b, w) -> if(get(s.scores, w.start) + w.score > b.score,
            struct(get(s.scores, w.start) + w.score AS score, w.start AS start, w.ids AS ids), b))"""
    forward = f"""aggregate(steps,
        struct(array(0D) AS scores, cast(array() AS array<struct<start: int, ids: array<int>>>) AS ways),
        (s, step) -> aggregate(array({way}), s, (t, b) -> struct(
            concat(t.scores, array(b.score)) AS scores,
            concat(t.ways, array(struct(b.start AS start, b.ids AS ids))) AS ways)))"""
    # Backward: from the end, along the ways.
    backward = """aggregate(reverse(sequence(1, size(f.ways))),
        struct(size(f.ways) AS at, cast(array() AS array<int>) AS ids),
        (s, e) -> if(e = s.at, struct(get(f.ways, e - 1).start AS at, concat(get(f.ways, e - 1).ids, s.ids) AS ids), s),
        s -> s.ids)"""
    found = whole.select("word", F.expr(once(forward)).alias("f"))
    return found.select("word", F.expr(backward).alias("ids"))


def merged_paths(edges: DataFrame) -> DataFrame:
    """``word`` and its ``ids`` by merging, by a fold over the places where its parts meet."""
    whole = edges.groupBy("word").agg(
        F.collect_list(F.struct("start", "end", "score", "ids")).alias("edges"), F.max("end").alias("n")
    )
    # An edge is a merge if it begins at a cut and ends at the next but one.
    fits = "filter(edges, e -> get(c, cast(array_position(c, e.start) AS int) + 1) = e.end AND array_contains(c, e.start))"
    best = f"array_max(transform({fits}, e -> struct(e.score AS score, -e.start AS place, e.end AS end)))"
    fold = f"""aggregate(sequence(1, n), sequence(0, n), (c, k) -> aggregate(array({best}), c,
        (d, b) -> if(b IS NULL, d, filter(d, x -> x <= -b.place OR x >= b.end))))"""
    between = "filter(edges, e -> e.start = get(cuts, i) AND e.end = get(cuts, i + 1))"
    part = f"array_max(transform({between}, e -> struct(e.score AS score, e.ids AS ids))).ids"
    cut = whole.select("word", "edges", F.expr(once(fold)).alias("cuts"))
    return cut.select("word", F.expr(f"flatten(transform(sequence(0, size(cuts) - 2), i -> {part}))").alias("ids"))


def fit(docs: DataFrame, model: str, *, text: str = "text", most: int = DICTIONARY_WORDS) -> Pieces:
    """The pieces of a model, with the frequent words of ``docs`` encoded."""
    pieces = Pieces.load(model)
    words = written(frequent_words(docs, text, most), "words")
    fold = merged_paths if pieces.merges else best_paths
    encoded = written(fold(lattice(words, pieces)), "paths").toArrow()
    ids = [np.array(path, np.int32).tobytes() for path in encoded.column("ids").to_pylist()]
    pieces.known = dict(zip(encoded.column("word").to_pylist(), ids))
    return pieces


def _of(shared) -> Pieces:
    """The broadcast pieces, made ready once per process."""
    pieces = shared.value
    if not hasattr(pieces, "_remembered"):
        pieces.ready()
    return pieces


def encoded(docs: DataFrame, pieces: Pieces, *, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` and the ``ids`` of their texts, as a column of integer arrays."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    def run(batch: pa.RecordBatch) -> pa.Array:
        own = _of(shared)
        texts = batch.column(batch.schema.names.index(text)).to_pylist()
        return _listed([None if body is None else own.ids(body) for body in texts])

    return with_column_in_arrow(docs, ids, "array<int>", run)


def encoded_and_checked(
    docs: DataFrame, pieces: Pieces, *, text: str = "text", ids: str = "ids", whole: str = "round_trip"
) -> DataFrame:
    """``docs``, the ``ids`` of their texts, and in ``whole`` whether decoding them gives
    the text back; one pass over the texts for both."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces)
    name = unused(docs, "encoded")

    def run(batch: pa.RecordBatch) -> pa.Array:
        own = _of(shared)
        texts = batch.column(batch.schema.names.index(text)).to_pylist()
        parts = [None if body is None else own.ids(body) for body in texts]
        good = [p is None or own.text(p) == body for p, body in zip(parts, texts)]
        return pa.StructArray.from_arrays([_listed(parts), pa.array(good)], names=["ids", "good"])

    both = with_column_in_arrow(docs, name, "struct<ids: array<int>, good: boolean>", run)
    return both.select(
        *[F.col(quoted(c)) for c in docs.columns], F.col(f"{name}.ids").alias(ids), F.col(f"{name}.good").alias(whole)
    )


def _listed(parts: list[np.ndarray | None]) -> pa.Array:
    """Arrays as a column of lists, nulls staying nulls."""
    sizes = np.array([0 if p is None else len(p) for p in parts])
    flat = np.concatenate([p for p in parts if p is not None] or [np.empty(0, np.int32)])
    edges = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
    return pa.ListArray.from_arrays(edges, pa.array(flat, pa.int32()), mask=pa.array([p is None for p in parts]))


def decoded(docs: DataFrame, pieces: Pieces, *, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` and the ``text`` of their ``ids``."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    def run(batch: pa.RecordBatch) -> pa.Array:
        own = _of(shared)
        column = batch.column(batch.schema.names.index(ids))
        flat = column.flatten().to_numpy()
        sizes = pc.list_value_length(column).fill_null(0).to_numpy()
        edges = np.concatenate(([0], np.cumsum(sizes)))
        valid = column.is_valid().to_pylist()
        spans = zip(valid, edges[:-1].tolist(), edges[1:].tolist())
        return pa.array([own.text(flat[a:b]) if ok else None for ok, a, b in spans], pa.string())

    return with_column_in_arrow(docs, text, "string", run)
