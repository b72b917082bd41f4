"""Quality rules by robust multivariate outliers.  DataFrame functions only.

Each text becomes a vector of transformed statistics.  For every language and
source a minimum covariance determinant (MCD) estimate of location and scatter is
fitted to the vectors, and a document whose Mahalanobis distance from it is beyond
a chi-square quantile is rejected.

* Statistics are computed within the row, by sorting the hashes of its own 3-word
  windows; texts are not shuffled.
* Fits are aggregates with partial sums, and the estimates go to the vectors, not the
  vectors to the estimates (up to ``SENT_POOLS`` pools), so a source that holds a third of
  the rows costs no task more than its share.  The half of the rows that a C-step keeps is
  found by a mergeable quantile sketch.  Nothing is collected but one number per
  step, which tells when the steps have settled.
* Fits start from three robust first guesses, as deterministic MCD does; the one of
  the smallest determinant goes on.

A language and source of fewer than ``least_rows`` rows is pooled with the other
small sources of the language; what is small even so is judged by an estimate over
all rows.  With fewer rows than that in all, only the base rules reject.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable
from math import exp, lgamma, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.frames import once, quoted, unused, written

Sender = Callable[[DataFrame], DataFrame]

# Fixed values of the base rules.
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

# Rows a fit needs; share of rows whose scatter is made smallest; chance that a
# normally distributed vector is rejected.  The tails of clean texts are heavier than
# that: some are long, some repeat a third of their lines.
LEAST_ROWS = 100
KEPT_SHARE = 0.6
TAIL = 1e-24

# The statistics and the least standard deviation each is taken to have.  Most clean
# texts have no symbols and no repetition at all; without a floor their scatter would
# be zero there and any repeated line an outlier.
VECTOR = {
    "ln(n_words)": 0.25,
    "ln(word_chars / n_words)": 0.05,
    "asinh(100D * n_symbols / word_chars)": 0.25,
    "n_repeat_words / n_words": 0.12,
    "ln(1 + n_dup_lines)": 1.0,
}
_D = len(VECTOR)
_X = [f"x{i}" for i in range(_D)]
_M = [f"m{i}" for i in range(_D)]
_PAIRS = [(i, j) for i in range(_D) for j in range(i, _D)]

_BLANK = r"[\\x20\\x09-\\x0D]+"
_BLANKS = r" \t\n\u000B\u000C\r"
_ALL = "[]"
_STARTS = 3
_FIRST_STEPS = 2
_MOST_STEPS = 30

# Estimates of this many pools are sent to every executor (some 500 bytes each), and the
# vectors stay where they are; those of more pools are joined.
SENT_POOLS = 20_000


def chi_square_point(tail: float, freedom: int) -> float:
    """The value that a chi-square variable exceeds with probability ``tail``."""

    def above(x: float) -> float:
        # Upper tail by its continued fraction, lower tail by its series.
        a, x = freedom / 2, x / 2
        head = exp(a * log(x) - x - lgamma(a))
        if x < a + 1:
            term = total = 1 / a
            n = a
            while term > total * 1e-16:
                n += 1
                term *= x / n
                total += term
            return 1 - total * head
        b = x + 1 - a
        c, d = 1e300, 1 / b
        h = d
        for i in range(1, 500):
            k = -i * (i - a)
            b += 2
            d = 1 / (k * d + b)
            c = b + k / c
            h *= d * c
            if abs(d * c - 1) < 1e-15:
                break
        return head * h

    low, high = 1e-9, 1e4
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if above(middle) > tail else (low, middle)
    return low


def text_statistics(docs: DataFrame, text: str = "text", name: str | None = None) -> tuple[DataFrame, str]:
    """``docs`` and a struct of statistics, with the name of that column.

    A word is a run of other characters than ASCII white space; a null text has none.
    ``n_repeat_words`` counts words inside 3-word windows that the text has twice or
    more, ``n_dup_lines`` lines with a word that equal an earlier line.
    """
    name = name or unused(docs, "statistics")
    body = f"coalesce({quoted(text)}, '')"
    lines = f"filter(split({body}, '\\n', -1), x -> length(trim(BOTH '{_BLANKS}' FROM x)) > 0)"
    one = docs.select(
        "*",
        F.expr(once(f"array_remove(split({body}, '{_BLANK}', -1), '')")).alias(f"{name}_w"),
        F.expr(once(lines)).alias(f"{name}_l"),
        F.expr(f"cast(length(translate({body}, '{_BLANKS}', '')) AS bigint)").alias(f"{name}_c"),
        F.expr(f"cast(length({body}) - length(translate({body}, '#*$%&|<>', '')) AS bigint)").alias(f"{name}_s"),
    )
    w = f"{name}_w"
    windows = f"transform(sequence(0, size({w}) - 3), i -> xxhash64(get({w}, i), get({w}, i + 1), get({w}, i + 2)))"
    two = one.select(
        "*",
        F.expr(once(f"if(size({w}) < 3, cast(array() AS array<bigint>), {windows})")).alias(f"{name}_h"),
    )
    h = f"{name}_h"
    # Positions of windows that occur again: neighbours in the order of (hash, position).
    ordered = f"sort_array(transform({h}, (x, i) -> struct(x, i)))"
    three = two.select(
        "*", F.expr(once(f"if(size(array_distinct({h})) = size({h}), NULL, {ordered})")).alias(f"{name}_o")
    )
    o = f"{name}_o"
    again = f"""sort_array(transform(
        filter({o}, (e, k) -> e.x <=> get({o}, k - 1).x OR e.x <=> get({o}, k + 1).x), e -> e.i))"""
    four = three.select("*", F.expr(once(f"if({o} IS NULL, NULL, {again})")).alias(f"{name}_p"))
    # Each such window covers three words, less what the one before it covers.
    covered = f"""aggregate({name}_p, struct(cast(-3 AS int) AS last, 0L AS total),
        (s, p) -> struct(p AS last, s.total + least(3, p - s.last) AS total), s -> s.total)"""
    found = f"""named_struct(
        'n_words', cast(size({w}) AS bigint),
        'word_chars', {name}_c,
        'n_symbols', {name}_s,
        'n_dup_lines', cast(size({name}_l) - size(array_distinct({name}_l)) AS bigint),
        'n_repeat_words', if({name}_p IS NULL, 0L, {covered}))"""
    return four.select(*[F.col(quoted(c)) for c in docs.columns], F.expr(once(found)).alias(name)), name


def base_failed(at: str = "") -> Column:
    """The base rules: too few words, or too many of them repeated."""
    return F.expr(
        f"({at}n_words < {LEAST_WORDS} OR 100 * {at}n_repeat_words > {MOST_REPEATED_PERCENT} * {at}n_words)"
    )


def _vector(at: str) -> list[Column]:
    out = []
    for x, formula in zip(_X, VECTOR):
        for column in ("n_words", "word_chars", "n_symbols", "n_repeat_words", "n_dup_lines"):
            formula = formula.replace(column, f"{at}{column}")
        out.append(F.expr(formula).cast("double").alias(x))
    return out


def _pools(rows: DataFrame, least_rows: int) -> DataFrame:
    """``lang``, ``source`` and the ``pool`` whose estimate judges them."""
    counts = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    small = f"n < {least_rows}"
    rest = counts.filter(small).groupBy("lang").agg(F.sum("n").alias("n_lang"))
    rest = rest.withColumnRenamed("lang", "of_lang")
    pool = (
        F.when(~F.expr(small), F.to_json(F.array("lang", "source")))
        .when(F.expr(f"n_lang >= {least_rows}"), F.to_json(F.array("lang")))
        .otherwise(F.lit(_ALL))
    )
    joined = counts.join(rest, F.col("lang").eqNullSafe(F.col("of_lang")), "left")
    return joined.select("lang", "source", pool.alias("pool"))


def _pooled(rows: DataFrame, pools: DataFrame, least_rows: int) -> DataFrame:
    """The vectors of each pool; the pool of all rows is there only if it is needed."""
    pools = written(pools, "pools")
    same = rows["lang"].eqNullSafe(pools["lang"]) & rows["source"].eqNullSafe(pools["source"])
    own = rows.join(pools, same).filter(F.col("pool") != _ALL).select("pool", *_X)
    if pools.filter(F.col("pool") == _ALL).head(1) and rows.count() >= least_rows:
        own = own.unionByName(rows.select(F.lit(_ALL).alias("pool"), *_X))
    return written(own, "pooled")


def _moments(by: list[str], rows: DataFrame, xs: list[str]) -> DataFrame:
    """Means m0, m1, ... and the covariance matrix ``s``, row by row, of ``xs``."""
    sums = [F.avg(x).alias(f"m{i}") for i, x in enumerate(xs)]
    sums += [F.covar_pop(xs[i], xs[j]).alias(f"s{i}{j}") for i, j in _PAIRS]
    matrix = F.array(*[F.coalesce(F.col(f"s{min(i, j)}{max(i, j)}"), F.lit(0.0)) for i in range(_D) for j in range(_D)])
    return rows.groupBy(*by).agg(*sums).select(*by, *_M, matrix.alias("s"))


def _inverted(fits: DataFrame, by: list[str]) -> DataFrame:
    """Inverse ``p`` of the scatter with its floors, and ``log_det``, by sweeping each row."""
    floors = F.array(*[F.lit(f * f if i == j else 0.0) for i, f in enumerate(VECTOR.values()) for j in range(_D)])
    with_floors = fits.select(*by, *_M, F.zip_with("s", floors, lambda a, b: a + b).alias("s"))
    d = _D
    sweep = f"""aggregate(sequence(0, {d - 1}), struct(s AS a, 0D AS log_det), (t, k) -> struct(
        transform(t.a, (v, e) -> CASE
            WHEN e div {d} = k AND e % {d} = k THEN -1D / v
            WHEN e div {d} = k OR e % {d} = k THEN v / get(t.a, k * {d + 1})
            ELSE v - get(t.a, cast((e div {d}) * {d} + k AS int)) * get(t.a, k * {d} + e % {d}) / get(t.a, k * {d + 1})
        END) AS a, t.log_det + ln(get(t.a, k * {d + 1})) AS log_det))"""
    out = with_floors.select(*by, *_M, F.expr(sweep).alias("t"))
    return out.select(*by, *_M, F.expr("transform(t.a, v -> -v)").alias("p"), F.col("t.log_det").alias("log_det"))


def _squared(x: str = "", fitted: str = "") -> str:
    """SQL: squared Mahalanobis distance of x from m under the inverse scatter p."""
    return " + ".join(
        f"{1 if i == j else 2} * get({fitted}p, {i * _D + j})"
        f" * ({x}x{i} - {fitted}m{i}) * ({x}x{j} - {fitted}m{j})"
        for i, j in _PAIRS
    )


def _sent(rows: DataFrame) -> Sender:
    """What to do with a table that has a few rows per pool of ``rows`` before it is joined to them."""
    few = rows.select("pool").distinct().limit(SENT_POOLS + 1).count() <= SENT_POOLS
    return F.broadcast if few else lambda estimates: estimates


def _first_guesses(rows: DataFrame, sent: Sender) -> DataFrame:
    """Three robust guesses of location and scatter for each pool."""
    median = [F.percentile_approx(x, 0.5, 10000).alias(f"c{i}") for i, x in enumerate(_X)]
    centred = rows.join(sent(rows.groupBy("pool").agg(*median)), "pool")
    spread = [
        F.greatest(
            1.4826 * F.percentile_approx(F.abs(F.col(x) - F.col(f"c{i}")), 0.5, 10000), F.lit(floor)
        ).alias(f"d{i}")
        for i, (x, floor) in enumerate(zip(_X, VECTOR.values()))
    ]
    middle = written(
        centred.groupBy("pool").agg(*spread, *[F.first(f"c{i}").alias(f"c{i}") for i in range(_D)]), "middle"
    )
    scaled = rows.join(sent(middle), "pool")
    z = [f"((x{i} - c{i}) / d{i})" for i in range(_D)]
    length = "sqrt(" + " + ".join(f"{v} * {v}" for v in z) + ")"
    scores = [
        F.array(*[F.expr(f"tanh({v})") for v in z]),
        F.array(*[F.expr(f"if({length} = 0, 0D, {v} / {length})") for v in z]),
    ]
    both = scaled.select("pool", F.posexplode(F.array(*scores)).alias("start", "z"))
    both = both.select("pool", "start", *[F.col("z")[i].alias(f"z{i}") for i in range(_D)])
    shapes = _moments(["pool", "start"], both, [f"z{i}" for i in range(_D)]).drop(*_M)
    spreads = F.array(*[F.col(f"d{i}") * F.col(f"d{j}") for i in range(_D) for j in range(_D)])
    centres = [F.col(f"c{i}").alias(f"m{i}") for i in range(_D)]
    shaped = shapes.join(middle, "pool").select(
        "pool", "start", *centres, F.zip_with("s", spreads, lambda a, b: a * b).alias("s")
    )
    diagonal = F.array(
        *[F.col(f"d{i}") * F.col(f"d{i}") if i == j else F.lit(0.0) for i in range(_D) for j in range(_D)]
    )
    plain = middle.select("pool", F.lit(_STARTS - 1).alias("start"), *centres, diagonal.alias("s"))
    return shaped.unionByName(plain)


def _c_step(rows: DataFrame, fits: DataFrame, share: float, sent: Sender) -> DataFrame:
    """Moments of the ``share`` of rows that is nearest to each fit."""
    by = ["pool", "start"]
    near = rows.join(sent(_inverted(fits, by)), "pool").select(*by, *_X, F.expr(_squared()).alias("distance"))
    limits = near.groupBy(*by).agg(F.percentile_approx("distance", share, 10000).alias("limit"))
    kept = near.join(sent(limits), by).filter("distance <= limit")
    return written(_moments(by, kept, _X), "fits")


def fit(rows: DataFrame, *, share: float = KEPT_SHARE, label: str = "mcd") -> DataFrame:
    """MCD estimate of each ``pool`` of vectors x0, x1, ...: m0, m1, ..., p and ``scale``.

    C-steps go on until the summed log-determinants of all pools stand still.  The
    distances are then scaled so that their median is that of a chi-square variable,
    and the estimate is sharpened once by all rows within the 97.5 % quantile.
    """
    sent = _sent(rows)
    fits = written(_first_guesses(rows, sent), label)
    for _ in range(_FIRST_STEPS):
        fits = _c_step(rows, fits, share, sent)
    ranked = _inverted(fits, ["pool", "start"]).groupBy("pool").agg(
        F.min(F.struct(F.round("log_det", 9).alias("log_det"), "start")).alias("best")
    )
    chosen = ranked.select("pool", F.col("best.start").alias("start"))
    fits = written(fits.join(chosen, ["pool", "start"]), label)
    state = None
    for _ in range(_MOST_STEPS):
        now = _inverted(fits, ["pool", "start"]).agg(F.round(F.sum("log_det"), 6)).first()[0]
        if now == state:
            break
        state, fits = now, _c_step(rows, fits, share, sent)
    else:
        warnings.warn(f"estimates still moved after {_MOST_STEPS} steps", stacklevel=2)
    raw = _scaled(rows, fits, sent)
    inner = rows.join(sent(raw), "pool").filter(F.expr(f"({_squared()}) / scale") <= chi_square_point(0.025, _D))
    sharp = _moments(["pool"], inner.select("pool", *_X), _X).withColumn("start", F.lit(0))
    return written(_scaled(rows, written(sharp, label), sent), label)


def _scaled(rows: DataFrame, fits: DataFrame, sent: Sender) -> DataFrame:
    inverse = _inverted(fits, ["pool"])
    middle = F.percentile_approx(F.expr(_squared()), 0.5, 10000).alias("median")
    median = rows.join(sent(inverse), "pool").groupBy("pool").agg(middle)
    scale = F.greatest(F.col("median") / chi_square_point(0.5, _D), F.lit(1e-3)).alias("scale")
    return inverse.join(median.select("pool", scale), "pool")


def judged(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    verdict: str = "verdict",
    keep: list[str] | None = None,
    reuse: bool = False,
    least_rows: int = LEAST_ROWS,
    tail: float = TAIL,
) -> DataFrame:
    """``docs`` (or their columns ``keep``) and a struct ``verdict``: the five counts,
    ``base_failed``, ``distance`` and ``kept``.

    ``distance`` is the squared Mahalanobis distance in the units of the chi-square
    quantile, null for rows that the base rules reject or whose pool is too small.
    With ``reuse`` the statistics are written once and judged from there, which suits
    a narrow ``keep``; without it the texts are read a second time rather than moved.

    Defined results: null and empty texts have no words and fail the base rules; a
    null ``lang`` or ``source`` is a value like any other; repeated rows each count; an
    empty table gives an empty table.
    """
    columns = [quoted(c) for c in (keep if keep is not None else docs.columns)]
    described, name = text_statistics(docs, text)
    slim = [F.col(quoted(lang)).alias("lang"), F.col(quoted(source)).alias("source")]
    if reuse:
        described = written(
            described.select(*columns, *[c.alias(f"{name}_{c0}") for c, c0 in zip(slim, ("lang", "source"))], name),
            "statistics",
        )
        slim = [F.col(f"{name}_{c}").alias(c) for c in ("lang", "source")]
        vectors = described
    else:
        vectors, _ = text_statistics(docs, text, name)
    at = f"{name}."
    rows = vectors.filter(~base_failed(at)).select(*slim, *_vector(at))
    rows = written(rows, "vectors")
    pools = written(_pools(rows, least_rows), "pools")
    estimates = pools.join(fit(_pooled(rows, pools, least_rows)), "pool").drop("pool", "log_det")
    estimates = estimates.withColumnsRenamed({"lang": "of_lang", "source": "of_source"})
    fitted = F.struct(*estimates.columns).alias(f"{name}_fit")
    estimates = written(estimates.select(fitted), "estimates")
    lang_of, source_of = (F.col(f"{name}_{c}") for c in ("lang", "source")) if reuse else (
        F.col(quoted(lang)), F.col(quoted(source)))
    match = lang_of.eqNullSafe(F.col(f"{name}_fit.of_lang")) & source_of.eqNullSafe(F.col(f"{name}_fit.of_source"))
    placed = described.join(estimates, match, "left")
    distance = _squared(f"{name}_v.", f"{name}_fit.")
    placed = placed.withColumn(f"{name}_v", F.when(~base_failed(at), F.struct(*_vector(at))))
    placed = placed.withColumn(f"{name}_d", F.expr(f"({distance}) / {name}_fit.scale"))
    kept = ~base_failed(at) & F.coalesce(
        F.col(f"{name}_d") <= chi_square_point(tail, _D), F.lit(True)
    )
    out = F.struct(
        *[F.col(f"{at}{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base_failed(at).alias("base_failed"),
        F.col(f"{name}_d").alias("distance"),
        kept.alias("kept"),
    )
    return placed.select(*columns, out.alias(verdict))


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without those that the rules reject."""
    name = unused(docs, "verdict")
    return judged(docs, verdict=name, **options).filter(F.col(f"{name}.kept")).drop(name)
