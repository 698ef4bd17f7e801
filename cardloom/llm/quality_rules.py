"""Quality rules (operator 3): robust multivariate outliers by minimum-covariance-determinant estimates per language and source.

Counts over whole texts give the base rules and a vector of four transformed statistics.  For each (language, source) with
enough rows that pass the base rules, the location and scatter with the smallest determinant over three quarters of the rows
are found from three deterministic starts (coordinate-wise, spatial signs, hyperbolic tangents) by concentration steps: sort by
distance, keep the nearest, estimate again, until no determinant falls any more.  All starts take each step together, as grouped
aggregations over a staged table of a few numbers per document, which the parameters - a row per key - are sent to.  The distance
that three quarters of the rows stay below is found to ACCURACY of their rank.  A row is rejected if its squared Mahalanobis distance exceeds the cutoff.  Sources with too few rows
are judged by an estimate from all sources of their language, however few these are.  Only where a whole language has under FEWEST_ROWS,
its estimate is the coordinate-wise start, medians and quartiles with the variance floors; languages are never judged by each other.

Everything is DataFrame expressions.  The variance floors keep a statistic that is constant in clean text (no symbols at all)
from rejecting the first document with one.

Defined results.  Null and empty texts: all counts 0, failed by the base rules.  Null language or source: a group of its own.
Repeated rows count each.  Empty table: no rows.  Further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import SPACE_CHARS, SPACE_CLASS, WORD_CLASS, spread_join, staged

STATISTICS = 4
#: Variance floors: standard deviations below which differences of a statistic don't count.
FLOORS = (0.06, 0.4, 0.4, 0.5)
SHARE = 0.75
#: One over the error of a quantile, in ranks.
ACCURACY = 10_000
#: Fall of the logarithm of a determinant's root below which an estimate stands still.
STILL = 1e-4
#: Keys (some 50 numbers each) up to which parameters are broadcast; beyond, rows are shuffled to them.
BROADCAST_KEYS = 50_000
#: Sound rows from which a source has an estimate of its own; smaller ones are judged by their language.
LEAST_ROWS = 100
#: Sound rows of a language below which three quarters of them do not span the statistics, so that there is nothing to concentrate; and
#: the first letter of the keys of such estimates.
FEWEST_ROWS = 2 * (STATISTICS + 1)
FEW = "q"
#: Clean rows that a normal distribution would lose.
TAIL = 1e-5
STARTS = ("a", "b", "c")
_PAIRS = [(i, j) for i in range(STATISTICS) for j in range(i + 1)]


def _chi2_cdf(x: float, k: int) -> float:
    """Chi-square distribution with an even number of degrees of freedom."""
    half = x / 2
    return 1 - math.exp(-half) * sum(half**i / math.factorial(i) for i in range(k // 2))


def _chi2_quantile(p: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2_cdf(mid, k) < p else (low, mid)
    return high


CUTOFF = _chi2_quantile(1 - TAIL, STATISTICS)
#: The scatter of the nearest SHARE of normal rows, times this, is that of all.
CONSISTENCY = SHARE / _chi2_cdf(_chi2_quantile(SHARE, STATISTICS), STATISTICS + 2)


def _bound(value: Column, use) -> Column:
    """use(value), with value computed once: it is the variable of a lambda over an array of one."""
    return F.transform(F.array(value), use)[0]


def _repeated(words: Column) -> Column:
    """Words in three-word windows that occur twice or more.  Windows are compared by 64-bit hashes.  Most texts end at the
    first test; in the others, sorted (hash, position) pairs show which windows repeat, and their union is measured."""
    n = F.size(words)
    windows = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))).otherwise(F.array().cast("array<bigint>"))

    def covered(pairs: Column) -> Column:
        again = F.transform(pairs, lambda e, k: F.when((e["h"] == F.get(pairs, k - 1)["h"]) | (e["h"] == F.get(pairs, k + 1)["h"]), e["p"]))
        start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("end"))
        return F.aggregate(
            F.sort_array(F.filter(again, lambda p: p.isNotNull())), start,
            lambda acc, p: F.struct((acc["sum"] + p + 3 - F.greatest(acc["end"], p)).alias("sum"), (p + 3).alias("end")), lambda acc: acc["sum"],
        )

    def measured(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, p: F.struct(h.alias("h"), p.alias("p"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(_bound(pairs, covered))

    return _bound(windows, measured)


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the five counts of every whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    words = F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{SPACE_CLASS}+"))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD_CLASS))
    return docs.select(
        "doc_id", "lang", "source",
        _bound(words, lambda w: F.struct(F.size(w).alias("n"), _repeated(w).alias("again"))).alias("w"),
        F.length(F.regexp_replace(text, f"{SPACE_CLASS}+", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        _bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    ).select("doc_id", "lang", "source", F.col("w.n").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", F.col("w.again").cast("long").alias("n_repeat_words"))


def _vector() -> list[Column]:
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return [
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n), F.log(1 + 100 * F.col("n_symbols") / n),
        F.log(1 + 10 * F.col("n_repeat_words") / n), F.log(1 + 100 * F.col("n_dup_lines") / n),
    ]


def _factor(params: DataFrame, start: str, covariance: dict[tuple[int, int], Column], scale: float = 1.0) -> DataFrame:
    """Adds the Cholesky factor of scale * covariance + floors, as columns l<start><i><j>, and the logarithm of its determinant."""
    done: dict[tuple[int, int], str] = {}
    for i, j in _PAIRS:
        value = scale * covariance[i, j] + (FLOORS[i] ** 2 if i == j else 0.0)
        for k in range(j):
            value = value - F.col(done[i, k]) * F.col(done[j, k])
        done[i, j] = f"l{start}{i}{j}"
        params = params.withColumn(done[i, j], F.sqrt(F.greatest(value, F.lit(FLOORS[i] ** 2 / 4))) if i == j else value / F.col(done[j, j]))
    logs = [F.log(F.col(done[i, i])) for i in range(STATISTICS)]
    return params.withColumn(f"det{start}", sum(logs[1:], logs[0]))


def _distance(start: str) -> Column:
    """Squared Mahalanobis distance of x0..x3 by forward substitution."""
    solved: list[Column] = []
    for i in range(STATISTICS):
        value = F.col(f"x{i}") - F.col(f"m{start}{i}")
        for k in range(i):
            value = value - F.col(f"l{start}{i}{k}") * solved[k]
        solved.append(value / F.col(f"l{start}{i}{i}"))
    squares = [y * y for y in solved]
    return sum(squares[1:], squares[0])


def _parameters(start: str) -> list[str]:
    return [f"m{start}{i}" for i in range(STATISTICS)] + [f"l{start}{i}{j}" for i, j in _PAIRS] + [f"det{start}"]


class _Rows:
    """The sound rows of all keys: key and x0 to x3."""

    def __init__(self, rows: DataFrame) -> None:
        self.rows = rows
        self.counts = staged(rows.groupBy("key").agg(F.count("*").alias("k")), "counts")
        self.keys = self.counts.count()
        self.total = 0 if self.keys <= BROADCAST_KEYS else rows.count()

    def beside(self, params: DataFrame) -> DataFrame:
        """Each row with the parameters of its key.  No row moves while the keys are few, whatever share of the rows one of them holds."""
        if self.keys <= BROADCAST_KEYS:
            return self.rows.join(F.broadcast(params), "key")
        return spread_join(self.rows, params.join(self.counts, "key"), "key", self.total)


def _nearest(sound: _Rows, params: DataFrame) -> DataFrame:
    """One concentration step of every start: the nearest SHARE of each key's rows, and their location and scatter."""
    measured = sound.beside(params).select("key", *[_distance(s).alias(f"d{s}") for s in STARTS])
    cuts = measured.groupBy("key").agg(*[F.percentile_approx(f"d{s}", SHARE, ACCURACY).alias(f"q{s}") for s in STARTS])
    cut = staged(params.join(cuts, "key"), "cuts")
    near = sound.beside(cut).select("key", *[f"x{i}" for i in range(STATISTICS)], *[(_distance(s) <= F.col(f"q{s}")).alias(f"in{s}") for s in STARTS])
    sums = []
    for s in STARTS:
        sums.append(F.sum(F.col(f"in{s}").cast("long")).alias(f"n{s}"))
        sums += [F.sum(F.when(F.col(f"in{s}"), F.col(f"x{i}"))).alias(f"s{s}{i}") for i in range(STATISTICS)]
        sums += [F.sum(F.when(F.col(f"in{s}"), F.col(f"x{i}") * F.col(f"x{j}"))).alias(f"p{s}{i}{j}") for i, j in _PAIRS]
    out = near.groupBy("key").agg(*sums)
    for s in STARTS:
        out = out.withColumns({f"m{s}{i}": F.col(f"s{s}{i}") / F.col(f"n{s}") for i in range(STATISTICS)})
        out = _factor(out, s, {(i, j): F.col(f"p{s}{i}{j}") / F.col(f"n{s}") - F.col(f"m{s}{i}") * F.col(f"m{s}{j}") for i, j in _PAIRS}, CONSISTENCY)
    return out.select("key", *[c for s in STARTS for c in _parameters(s)])


def _concentrated(sound: _Rows, first: DataFrame) -> DataFrame:
    """Concentration steps until no start of any key has a determinant that falls.  Each step keeps the better estimate of a start;
    determinants cannot fall below those of the floors, so the steps end."""
    now = staged(_nearest(sound, first), "params")  # a start's own determinant is no estimate of the nearest rows yet
    while True:
        step = _nearest(sound, now)
        old = now.select("key", *[F.col(c).alias(f"old_{c}") for s in STARTS for c in _parameters(s)])
        better = {s: F.col(f"det{s}") < F.col(f"old_det{s}") - STILL for s in STARTS}
        chosen = [F.when(better[s], F.col(c)).otherwise(F.col(f"old_{c}")).alias(c) for s in STARTS for c in _parameters(s)]
        falls = better[STARTS[0]] | better[STARTS[1]] | better[STARTS[2]]
        after = staged(step.join(old, "key").select("key", *chosen, falls.alias("falls")), "params")
        now = after.drop("falls")
        if after.filter("falls").isEmpty():
            return now


def _first(sound: _Rows) -> DataFrame:
    """The three starts.  All lie at the medians; scatters come from quartiles, spatial signs, and hyperbolic tangents."""
    quartiles = sound.rows.groupBy("key").agg(*[F.percentile_approx(f"x{i}", [0.25, 0.5, 0.75], ACCURACY).alias(f"q{i}") for i in range(STATISTICS)])
    centre = quartiles.select("key", *[F.col(f"q{i}")[1].alias(f"m{i}") for i in range(STATISTICS)], *[F.greatest((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, F.lit(FLOORS[i])).alias(f"w{i}") for i in range(STATISTICS)])
    centre = staged(centre, "centre")
    z = sound.beside(centre).select("key", *[((F.col(f"x{i}") - F.col(f"m{i}")) / F.col(f"w{i}")).alias(f"z{i}") for i in range(STATISTICS)])
    norm = F.greatest(F.sqrt(sum((F.col(f"z{i}") ** 2 for i in range(1, STATISTICS)), F.col("z0") ** 2)), F.lit(1e-9))
    z = z.select("key", *[(F.col(f"z{i}") / norm).alias(f"u{i}") for i in range(STATISTICS)], *[F.tanh(f"z{i}").alias(f"t{i}") for i in range(STATISTICS)])
    means = [F.avg(f"t{i}").alias(f"mt{i}") for i in range(STATISTICS)]
    means += [F.avg(F.col(f"u{i}") * F.col(f"u{j}")).alias(f"u{i}{j}") for i, j in _PAIRS] + [F.avg(F.col(f"t{i}") * F.col(f"t{j}")).alias(f"t{i}{j}") for i, j in _PAIRS]
    out = z.groupBy("key").agg(*means).join(centre, "key")
    for s in STARTS:
        out = out.withColumns({f"m{s}{i}": F.col(f"m{i}") for i in range(STATISTICS)})
    wide = {(i, j): F.col(f"w{i}") * F.col(f"w{j}") for i, j in _PAIRS}
    out = _factor(out, "a", {(i, j): wide[i, j] if i == j else F.lit(0.0) for i, j in _PAIRS})
    out = _factor(out, "b", {(i, j): wide[i, j] * STATISTICS * F.col(f"u{i}{j}") for i, j in _PAIRS})
    out = _factor(out, "c", {(i, j): wide[i, j] * (F.col(f"t{i}{j}") - F.col(f"mt{i}") * F.col(f"mt{j}")) for i, j in _PAIRS})
    return staged(out.select("key", *[c for s in STARTS for c in _parameters(s)]), "params")


def _keys(rows: DataFrame) -> DataFrame:
    """lang, source, the key of the estimate that judges them, and grounds: the keys of the estimates that are made from them."""
    own = rows.filter("not base_failed").groupBy("lang", "source").agg(F.count("*").alias("n"))
    by_lang = own.groupBy("lang").agg(F.sum("n").alias("nl"), F.min("n").alias("least"))
    source_key = F.when(F.col("n") >= LEAST_ROWS, F.concat(F.lit("s"), F.to_json(F.struct("lang", "source"))))
    lang_key = F.concat(F.when(F.col("nl") >= FEWEST_ROWS, F.lit("l")).otherwise(F.lit(FEW)), F.to_json(F.struct("lang")))
    grounds = F.array_compact(F.array(source_key, F.when(F.col("least") < LEAST_ROWS, lang_key)))
    same = F.col("own.lang").eqNullSafe(F.col("by.lang"))
    joined = own.alias("own").join(by_lang.alias("by"), same).select("own.lang", "own.source", "n", "nl", "least")
    return staged(joined.select("lang", "source", F.coalesce(source_key, lang_key).alias("key"), grounds.alias("grounds")), "keys")


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """doc_id, the five counts, base_failed, kept, and distance (the squared Mahalanobis distance; null if no row of the language and source passes the base rules)."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = text_statistics(docs).withColumn("base_failed", failed)
    rows = staged(rows.select("*", *[x.alias(f"x{i}") for i, x in enumerate(_vector())]), "statistics")
    keys = _keys(rows)
    same = F.col("r.lang").eqNullSafe(F.col("k.lang")) & F.col("r.source").eqNullSafe(F.col("k.source"))
    keys = F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys
    keyed = staged(rows.alias("r").join(keys.alias("k"), same, "left").select("r.*", "key", "grounds").drop("lang", "source"), "keyed")
    sound = keyed.filter("key is not null and not base_failed").select(F.explode("grounds").alias("key"), *[f"x{i}" for i in range(STATISTICS)])
    rows = _Rows(staged(sound, "sound"))
    first = _first(rows)
    few = F.col("key").startswith(FEW)
    params = _concentrated(rows, first.filter(~few))
    least = F.least(*[f"det{s}" for s in STARTS])
    best = params.select("key", *[F.when(F.col("deta") == least, F.col(a)).when(F.col("detb") == least, F.col(b)).otherwise(F.col(c)).alias(a) for a, b, c in zip(*map(_parameters, STARTS))])
    best = best.unionByName(first.filter(few).select("key", *_parameters("a")))
    distance = _distance("a")
    near = F.broadcast(best) if rows.keys <= BROADCAST_KEYS else best
    judged = keyed.join(near, "key", "left").withColumn("distance", distance)
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= CUTOFF, F.lit(True))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "distance")
