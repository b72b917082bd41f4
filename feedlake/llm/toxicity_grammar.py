"""Toxicity by a weighted finite-state grammar over clauses.

A lexicon is learned from labelled rows: words and word beginnings that stand in
toxic documents far more often than in others.  It tags the words of a clause as
insults and threats; short fixed lists tag targets, negation and speech verbs.
Transducers for negation, reported speech and target are composed into one
machine, which rewrites every insult or threat by the clause it stands in (aimed
at someone, denied, quoted, or plain) and weighs it; a second one reads what it wrote
from the end, for targets that stand behind.  The score of a document is a
logistic function of the weights of its matched clauses.

The lexicon is found in a text by an Aho-Corasick automaton; only clauses with a
match go through the machine.  Scoring is map-only.  Learning takes a sample of
labelled rows of fixed size (``sample_rows``), chosen by a hash of the id over all
of them, so its cost does not grow.

Defined results: null and empty texts have no clauses and get the score of a text
without a match; a label without ``doc_id`` or ``toxic`` teaches nothing; repeated
labels of a document count once, as toxic if any is; without labels of both kinds
the score is 0 everywhere.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property
from math import exp, log, log1p

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.frames import quoted, unused, with_column_in_arrow, written

SAMPLE_ROWS = 20_000
LEAST_SUPPORT = 5
LEAST_WEIGHT = 2.5
PREFIXES = (4, 5, 6, 7)

# Symbols of the input tape; the lexicon adds insults.
WORD, INSULT, THREAT, TARGET, NEGATION, SPEECH, END = "word insult threat target negation speech end".split()
SYMBOLS = (WORD, INSULT, THREAT, TARGET, NEGATION, SPEECH, END)

# Fixed word lists, in the four languages of the corpus.
LISTS = {
    THREAT: "kill hurt destroy shoot stab murder umbringen töten verletzen tuer blesser frapper matar herir golpear",
    TARGET: "you your yours yourself du dich dir dein deine ihr euch tu te toi vous ton tú ti usted ustedes tus",
    NEGATION: "not never no nor cannot don't isn't nicht kein keine nie pas jamais ne nunca tampoco",
    SPEECH: "said says wrote quoted claimed called sagte schrieb zitierte dit écrit cita dijo escribió citó",
}

_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_CLAUSE_END = re.compile(r"[.!?;:\n]+")


@dataclass(frozen=True)
class Transducer:
    """A deterministic weighted transducer; what has no arc keeps state and symbol.

    ``arcs`` maps (state, symbol) to (state, symbol, weight).
    """

    start: object
    arcs: dict

    def step(self, state: object, symbol: str) -> tuple[object, str, float]:
        return self.arcs.get((state, symbol), (state, symbol, 0.0))

    def then(self, after: Transducer, symbols: Iterable[str]) -> Transducer:
        """The composition: ``after`` reads what this one writes."""
        start, arcs = (self.start, after.start), {}
        todo, known = [start], {start}
        symbols = tuple(symbols)
        while todo:
            state = todo.pop()
            for symbol in symbols:
                one, middle, w1 = self.step(state[0], symbol)
                two, out, w2 = after.step(state[1], middle)
                arcs[state, symbol] = ((one, two), out, w1 + w2)
                if (one, two) not in known:
                    known.add((one, two))
                    todo.append((one, two))
        return Transducer(start, arcs)


HOSTILE = (INSULT, THREAT)


def _within(trigger: str, reach: int, mark: str, weight: float, marks: Iterable[str], symbols: Iterable[str]) -> Transducer:
    """Marks hostile symbols that follow ``trigger`` within ``reach`` symbols."""
    arcs = {}
    for left in range(reach + 1):
        for symbol in symbols:
            if symbol == END:
                arcs[left, symbol] = (0, symbol, 0.0)
            elif symbol == trigger:
                arcs[left, symbol] = (reach, symbol, 0.0)
            elif symbol in marks and left:
                arcs[left, symbol] = (left - 1, f"{mark} {symbol}", weight)
            else:
                arcs[left, symbol] = (max(left - 1, 0), symbol, 0.0)
    return Transducer(0, arcs)


def grammar() -> Transducer:
    """Negation, then reported speech, then target."""
    tape = list(SYMBOLS)
    machine = _within(NEGATION, 3, "denied", log(0.5), HOSTILE, tape)
    tape += [f"denied {s}" for s in HOSTILE]
    speech = _within(SPEECH, 12, "quoted", log(0.5), tape[1:3] + tape[7:], tape)
    machine = machine.then(speech, SYMBOLS)
    tape += [f"quoted {s}" for s in tape[1:3] + tape[7:]]
    aimed = _within(TARGET, 4, "aimed", log(1.5), HOSTILE, tape)
    return machine.then(aimed, SYMBOLS)


def target_behind() -> Transducer:
    """A target that stands behind what it is aimed at; reads what :func:`grammar` writes from its end."""
    tape = {*SYMBOLS, *(out for _, out, _ in grammar().arcs.values())}
    return _within(TARGET, 4, "aimed", log(1.5), HOSTILE, sorted(tape))


FEATURES = ("plain", "aimed", "denied", "quoted", "threat", "per_words", "any")


@dataclass
class Model:
    """Lexicon (``idiot`` is a word, ``idio*`` a beginning) with weights, and the logistic."""

    lexicon: dict[str, float]
    weights: list[float] = field(default_factory=lambda: [0.0] * len(FEATURES))
    bias: float = -50.0

    def __getstate__(self) -> dict:
        return {k: self.__dict__[k] for k in ("lexicon", "weights", "bias")}

    @cached_property
    def machine(self) -> Transducer:
        return grammar()

    @cached_property
    def behind(self) -> Transducer:
        return target_behind()

    @cached_property
    def tags(self) -> dict[str, str]:
        return {word: symbol for symbol, words in LISTS.items() for word in words.split()}

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        out = ahocorasick.Automaton()
        for entry in [*self.lexicon, *LISTS[THREAT].split()]:
            out.add_word(entry.rstrip("*"), len(entry.rstrip("*")))
        out.make_automaton()
        return out

    def hostile(self, word: str) -> tuple[str, float] | None:
        """Symbol and weight of a word of the lexicon."""
        weight = self.lexicon.get(word, 0.0)
        for size in PREFIXES:
            if len(word) > size:
                weight = max(weight, self.lexicon.get(word[:size] + "*", 0.0))
        symbol = THREAT if self.tags.get(word) == THREAT else INSULT
        return (symbol, weight) if weight else None

    def clauses(self, text: str) -> Iterator[str]:
        """Clauses in which the automaton finds an entry at the start of a word."""
        last = -1
        ends = None
        for at, size in self.automaton.iter(text):
            begin = at - size + 1
            if begin < last or (begin and text[begin - 1].isalpha()):
                continue
            if ends is None:
                ends = [m.span() for m in _CLAUSE_END.finditer(text)]
                stops = [s for s, _ in ends]
            k = int(np.searchsorted(stops, begin))
            start = ends[k - 1][1] if k else 0
            last = stops[k] if k < len(stops) else len(text)
            yield text[start:last]

    def _read(self, clause: str) -> list[tuple[float, str, float]]:
        """Lexicon weight, output and grammar weight of each insult and threat of a clause."""
        tape = []
        state = self.machine.start
        for word in _WORD.findall(clause):
            found = self.hostile(word)
            symbol = found[0] if found else self.tags.get(word, WORD)
            if symbol == THREAT and not found:
                symbol = WORD  # a threat counts if the labels bear it out
            state, out, weight = self.machine.step(state, symbol)
            tape.append((found[1] if found else 0.0, out, weight))
        state = self.behind.start
        read = []
        for found, out, weight in reversed(tape):
            state, out, more = self.behind.step(state, out)
            if found:
                read.append((found, out, weight + more))
        return read[::-1]

    def features(self, text: str) -> list[float]:
        """Summed weights of matched clauses by kind, in the order of FEATURES."""
        text = text.lower()
        sums = dict.fromkeys(FEATURES, 0.0)
        for clause in self.clauses(text):
            for found, out, weight in self._read(clause):
                kind = out.split()[0] if " " in out else "plain"
                sums[kind] += found * exp(weight)
                sums["threat"] += out.endswith(THREAT)
                sums["any"] = 1.0
        total = sum(sums[k] for k in ("plain", "aimed", "denied", "quoted"))
        if total:
            sums["per_words"] = total / max(1, text.count(" ") + 1)
        return [sums["any"] if k == "any" else log1p(sums[k]) for k in FEATURES]

    def score(self, text: str) -> float:
        z = self.bias + sum(w * x for w, x in zip(self.weights, self.features(text)))
        return 1 / (1 + exp(-max(-500.0, min(500.0, z))))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> tuple[list[float], float]:
    """Weights and bias by Newton's method with a ridge."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        change = np.linalg.solve(hessian, gradient)
        w -= np.clip(change, -5, 5)
        if np.abs(change).max() < 1e-8:
            break
    return w[:-1].tolist(), float(w[-1])


def _sample(docs: DataFrame, labels: DataFrame, sample_rows: int) -> DataFrame:
    """Texts of at most ``sample_rows`` labelled documents, with ``toxic``.

    The chosen ids are bounded by that parameter, hence the broadcast.
    """
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
    one = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return written(texts.join(F.broadcast(chosen), "doc_id"), "labelled")


def _lexicon(sample: DataFrame) -> dict[str, float]:
    """Words and beginnings that mark toxic documents.

    Support counts different texts, not copies: documents are told apart by the
    smallest hash of their 5-word runs, which near copies have in common.
    """
    words = F.expr(r"array_remove(split(lower(text), '[^\\p{L}]+'), '')")
    runs = F.expr(
        "array_min(transform(sequence(0, greatest(size(w) - 5, 0)), "
        "i -> xxhash64(get(w, i), get(w, i + 1), get(w, i + 2), get(w, i + 3), get(w, i + 4))))"
    )
    keyed = sample.select("toxic", words.alias("w")).select("toxic", runs.alias("text_key"), F.array_distinct("w").alias("w"))
    told = written(keyed, "keyed").select("toxic", "text_key", F.explode("w").alias("word"))
    beginnings = ", ".join(f"if(length(word) > {n}, concat(left(word, {n}), '*'), NULL)" for n in PREFIXES)
    entries = told.select("toxic", "text_key", F.explode(F.expr(f"array_compact(array(word, {beginnings}))")).alias("entry"))
    by_text = entries.groupBy("entry", "text_key").agg(F.max("toxic").alias("toxic"))
    counts = by_text.groupBy("entry").agg(
        F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")
    )
    texts = told.groupBy("text_key").agg(F.max("toxic").alias("toxic"))
    bad, good = texts.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    if not bad or not good:
        return {}
    weight = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("good") + 2) / (good + 4))
    best = (
        counts.filter(F.col("bad") >= LEAST_SUPPORT)
        .withColumn("weight", weight)
        .filter(F.col("weight") >= LEAST_WEIGHT)
        .collect()  # bounded by the labelled rows of the sample
    )
    return {row["entry"]: row["weight"] for row in best}


def fit(docs: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn lexicon and logistic from ``labels`` (``doc_id``, ``toxic``) of ``docs``."""
    sample = _sample(docs, labels, sample_rows)
    model = Model(_lexicon(sample))
    if not model.lexicon:
        return model

    def features(batch: pa.RecordBatch) -> pa.Array:
        texts = batch.column(batch.schema.names.index("text")).to_pylist()
        return pa.array([model.features(text) for text in texts], pa.list_(pa.float64()))

    rows = with_column_in_arrow(sample, "features", "array<double>", features).select("toxic", "features").collect()
    x = np.array([row["features"] for row in rows])
    y = np.array([row["toxic"] for row in rows], float)
    model.weights, model.bias = _logistic(x, y)
    return model


def scored(docs: DataFrame, model: Model, *, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` and their toxicity ``score`` between 0 and 1."""

    def scores(batch: pa.RecordBatch) -> pa.Array:
        texts = batch.column(batch.schema.names.index(text)).to_pylist()
        return pa.array([model.score(body or "") for body in texts], pa.float64())

    return with_column_in_arrow(docs, score, "double", scores)


def keep_civil(docs: DataFrame, model: Model, *, threshold: float = 0.5, **options) -> DataFrame:
    """``docs`` with a score below ``threshold``."""
    name = unused(docs, "score")
    return scored(docs, model, score=name, **options).filter(F.col(quoted(name)) < threshold).drop(name)
