"""Quality rules with thresholds that adapt to each language and source.

Fixed rules come first: a text with too few words, or with too many words in repeated windows, fails.
For the texts that pass them, four integer signals are measured and gathered, per language and source, in
quantile sketches. A sketch counts values in log-linear buckets: values below 128 are exact, above that a
bucket spans at most 1/64 of its value. Counts add up, so sketches merge in any order and give the same
result on every partitioning; those of the sources of a language merge into the language's, and all
into one. From quantiles follow fences, and a text outside a fence of its group is not kept.
Everything runs as DataFrame operations; a hot source only adds to counts before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepwell.llm.common import SPACE_CLASS, fresh_name, let, words_of
from keepwell.scratch import materialise

WINDOW = 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SIGNALS = ("word_length", "symbols", "dup_lines", "repeats")


@dataclass(frozen=True)
class Fences:
    """Fences that the group's own sketch decides.

    ``upper`` is the percentage of each signal that counts as usual; its mirror image bounds the lower end.
    A fence lies ``spreads`` times the way from the median to that quantile beyond it, as far as their
    buckets leave open how long that is, and one bucket's width at least, which decides only where the quantile equals the median. Repeated lines and
    repeated words are absent from most texts, so their spread shows only far up. ``min_rows`` texts make a
    group's own sketch count; a smaller group takes the sketch of its language, and a smaller language the
    sketch of all.
    """

    upper: tuple[int, int, int, int] = (75, 75, 98, 98)
    spreads: tuple[int, int, int, int] = (10, 10, 1, 2)
    min_rows: int = 100

    def percents(self, signal: int) -> tuple[int, ...]:
        return 100 - self.upper[signal], 50, self.upper[signal]

    def bounds(self, signal: int) -> tuple[Column, Column]:
        low, mid, high = (F.col(quantile_name(p, signal)) for p in self.percents(signal))
        blur = bucket_width(mid) - 1  # quantiles are known to within their bucket
        below = F.greatest(self.spreads[signal] * (mid - low + blur), bucket_width(low))
        above = F.greatest(self.spreads[signal] * (high - mid + blur), bucket_width(high))
        return low - below, high + above


def quantile_name(percent: int, signal: int) -> str:
    return f"q{percent}_{signal}"


def repeat_words(words: Column, size: int = WINDOW) -> Column:
    """Number of words that lie in windows of ``size`` words found twice or more in the text.

    Windows are first compared by hash. Only a text in which two hashes agree has its windows sorted,
    by their words, so that the result is exact.
    """
    n = F.size(words)
    starts = F.sequence(F.lit(0), n - size)

    def hashes(h: Column) -> Column:
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(size)]))

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, k: F.least(F.get(places, k + 1) - p, F.lit(size)))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def twins(ordered: Column) -> Column:
        def same(x: Column, k: Column) -> Column:
            return F.coalesce(F.get(ordered, k)["words"] == x["words"], F.lit(False))

        return F.filter(ordered, lambda x, k: same(x, k - 1) | same(x, k + 1))

    ordered = F.sort_array(
        F.transform(starts, lambda i: F.struct(F.slice(words, i + 1, size).alias("words"), i.alias("at")))
    )
    places = F.sort_array(F.transform(let(ordered, twins), lambda x: x["at"]))
    exact = let(places, covered)
    by_hash = let(F.transform(words, lambda w: F.xxhash64(w)), hashes)
    none = let(by_hash, lambda h: F.size(F.array_distinct(h)) == F.size(h))
    return F.when((n <= size) | none, F.lit(0)).otherwise(exact)


def measure(docs: DataFrame, text_col: str, carry: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """``carry`` columns with the five measures and the number of lines that have a word.

    Measure columns get names that no carried column has; the second result maps measure to column.
    """
    names = {m: fresh_name(carry, m) for m in (*MEASURES, "n_lines")}
    words, text = fresh_name(docs.columns, "words"), F.coalesce(F.col(text_col), F.lit(""))
    split = docs.withColumn(words, words_of(F.col(text_col)))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE_CLASS[1:]}"))
    measures = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(F.col(words), "")),
        "n_symbols": F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        "n_repeat_words": repeat_words(F.col(words)),
        "n_lines": F.size(lines),
    }
    columns = [F.col(c) for c in carry]
    return split.select(*columns, *[e.cast("long").alias(names[m]) for m, e in measures.items()]), names


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 10) | (100 * n_repeat_words > 20 * n_words)


def signals(m: dict[str, str]) -> list[Column]:
    """Integer signals: hundredths of a letter per word, symbols per 1000 letters, thousandths of lines and words."""

    def share(part: str, whole: str, unit: int) -> Column:
        return F.expr(f"{unit} * `{m[part]}` div greatest(`{m[whole]}`, 1)")

    return [
        share("word_chars", "n_words", 100),
        share("n_symbols", "word_chars", 1000),
        share("n_dup_lines", "n_lines", 1000),
        share("n_repeat_words", "n_words", 1000),
    ]


def bucket_width(value: Column) -> Column:
    return F.pow(F.lit(2), F.greatest(F.length(F.bin(value)) - 7, F.lit(0))).cast("long")


def bucket(value: Column) -> Column:
    """Lower end of the value's bucket: its seven leading binary digits, zeros behind."""
    return value - value % bucket_width(value)


def build_sketches(measured: DataFrame, m: dict[str, str], keys: Sequence[str]) -> DataFrame:
    """Counts per key, signal and bucket over the rows that pass the fixed rules."""
    passed = measured.filter(~base_failed(F.col(m["n_words"]), F.col(m["n_repeat_words"])))
    values = F.array(*[F.struct(F.lit(i).alias("signal"), bucket(s).alias("low")) for i, s in enumerate(signals(m))])
    listed = passed.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.inline(values))
    return listed.groupBy(*[f"k{i}" for i in range(len(keys))], "signal", "low").agg(F.count("*").alias("n"))


def merge_sketches(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    return sketches.groupBy(*keys, "signal", "low").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, keys: Sequence[str], fences: Fences) -> DataFrame:
    """One row per key: number of texts, and the quantiles of every signal that the fences need."""
    group = Window.partitionBy(*keys, "signal")
    upto = F.sum("n").over(group.orderBy("low").rowsBetween(Window.unboundedPreceding, 0))
    placed = sketches.withColumns({"upto": upto, "rows": F.sum("n").over(group)})
    aggs = [F.max("rows").alias("rows")]
    for i in range(len(SIGNALS)):
        for p in fences.percents(i):
            reached = (F.col("signal") == i) & (100 * F.col("upto") >= p * F.col("rows"))
            aggs.append(F.min(F.when(reached, F.col("low"))).alias(quantile_name(p, i)))
    return placed.groupBy(*keys).agg(*aggs)


def thresholds(sketches: DataFrame, fences: Fences) -> DataFrame:
    """Lower and upper fence of every signal for every (language, source), however small."""
    values = [quantile_name(p, i) for i in range(len(SIGNALS)) for p in fences.percents(i)]
    own = quantiles(sketches, ["k0", "k1"], fences)
    lang = quantiles(merge_sketches(sketches, ["k0"]), ["k0"], fences)
    every = quantiles(merge_sketches(sketches.withColumn("all", F.lit(1)), ["all"]), ["all"], fences)

    def renamed(df: DataFrame, level: str) -> DataFrame:
        return df.withColumnsRenamed({c: f"{level}_{c}" for c in df.columns})

    joined = (
        own.withColumn("all", F.lit(1))
        .join(renamed(lang, "l"), F.col("k0").eqNullSafe(F.col("l_k0")), "left")
        .join(renamed(every, "a"), F.col("all") == F.col("a_all"), "left")
    )

    def chosen(name: str) -> Column:
        return (
            F.when(F.col("rows") >= fences.min_rows, F.col(name))
            .when(F.col("l_rows") >= fences.min_rows, F.col(f"l_{name}"))
            .otherwise(F.col(f"a_{name}"))
        )

    picked = joined.select("k0", "k1", *[chosen(v).alias(v) for v in values])
    bounds = []
    for i in range(len(SIGNALS)):
        low, high = fences.bounds(i)
        bounds += [low.alias(f"low_{i}"), high.alias(f"high_{i}")]
    return picked.select("k0", "k1", *bounds)


def quality_rules(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    carry: Sequence[str] | None = None,
    fences: Fences = Fences(),
) -> tuple[DataFrame, dict[str, str]]:
    """Measures, ``base_failed`` and ``kept`` for every row, beside the ``carry`` columns (default: all).

    NULL and empty texts have no words and fail the fixed rules. NULL languages and sources are groups of
    their own. A very long text is measured in its row, by array expressions whose time grows with its words
    (times their logarithm where windows repeat). Repeated rows are judged, and counted in the sketches, one by one; ties cannot arise. An
    empty table gives an empty result. Added columns take other names where carried ones clash; the
    second result maps measure to column. The measured rows are written once, to the shared folder, and read for
    the sketches and for the verdict; the join with the fences has one row per group on one side.
    """
    carry = docs.columns if carry is None else list(carry)
    keyed = list(dict.fromkeys([*carry, lang_col, source_col]))
    measured, names = measure(docs, text_col, keyed)
    measured = materialise(measured, "measured")
    names |= {c: fresh_name(measured.columns, c) for c in ("base_failed", "kept")}
    sketches = materialise(build_sketches(measured, names, [lang_col, source_col]), "sketches")
    limits = materialise(thresholds(sketches, fences), "fences")
    limits = limits.withColumnsRenamed({c: fresh_name(measured.columns, f"_fence_{c}") for c in limits.columns})
    k0, k1, *bounds = limits.columns
    same = measured[lang_col].eqNullSafe(limits[k0]) & measured[source_col].eqNullSafe(limits[k1])
    inside = F.lit(True)
    for i, value in enumerate(signals(names)):
        low, high = F.col(bounds[2 * i]), F.col(bounds[2 * i + 1])
        inside &= (value <= high) & (value >= low)
    failed = base_failed(F.col(names["n_words"]), F.col(names["n_repeat_words"]))
    judged = measured.join(limits, same, "left").select(
        *[F.col(c) for c in carry],
        *[F.col(names[m]) for m in MEASURES],
        failed.alias(names["base_failed"]),
        (~failed & F.coalesce(inside, F.lit(True))).alias(names["kept"]),
    )
    return judged, names


def kept_documents(docs: DataFrame, **columns: str) -> DataFrame:
    """The rows that pass all rules, with their columns as they are."""
    judged, names = quality_rules(docs, **columns)
    return judged.filter(F.col(names["kept"])).select(*docs.columns)
