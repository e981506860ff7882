"""Quality rules whose thresholds follow from quantiles per language and source.

Every statistic has a quantile sketch for each language and source: counts of its
values in buckets whose bounds grow by a fixed ratio, so that a quantile is right
within one percent. Such sketches merge by adding counts, in any order and with the
same result, which Spark does before its shuffle; merged over sources they give the
quantiles of a language, merged over languages those of the table.

A threshold lies a number of spreads beyond the median. The spread is the distance
of the nearer quartile to the median, which junk on one side does not reach until it
is half of a group, and at least one bucket: less is not told from zero. Median and spread of a group of n rows count n, those of its
language ``WEIGHT`` rows; a language leans on the table in the same way, and the table
on a fixed prior. So every group has a say at every size, and none switches. A source
that is mostly junk can move its thresholds only between a quarter and five quarters of
the reach of its language.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.text import add_columns, rolling, utf8, word_hashes
from riskweave.operators.joins import measure, sized_join
from riskweave.sources.workspace import settle

GROWTH = 1.02
LEAST = 1e-4
ZERO = -1_000_000
FACTOR = 20.0  # spreads from the median to the threshold
WEIGHT = 200.0  # rows that the level above counts for
NEAREST, FARTHEST = 0.25, 1.25  # of a language's reach, within which its sources stay
_SPACES = b" \t\n\v\f\r"
_SYMBOLS = b"#*$%&|<>"
_WINDOW = 5
_ROLL = 0x9E3779B97F4A7C15

# Statistic, side on which values are outliers, and prior spread of the table.
RULES = (
    ("symbol_ratio", "high", 0.01),
    ("upper_ratio", "high", 0.003),
    ("repeat_ratio", "high", 0.01),
    ("dup_line_ratio", "high", 0.1),
    ("mean_word", "high", 0.1),
    ("mean_word", "low", 0.1),
)
STATISTICS = tuple(dict.fromkeys(name for name, _, _ in RULES))


def repeated_words(words: list[bytes], window: int = _WINDOW) -> int:
    """Words covered by windows that occur twice or more in the text."""
    hashes = rolling(word_hashes(words), window, _ROLL)
    if len(hashes) < 2:
        return 0
    _, at, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    repeated = counts[at] > 1
    covered = np.zeros(len(words), bool)
    for i in range(window):
        covered[i : i + len(repeated)] |= repeated
    return int(covered.sum())


def measures(text: bytes | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper, n_letters."""
    text = text or b""
    words = text.split()
    points = text.translate(None, bytes(range(0x80, 0xC0)))  # one byte per code point
    lines = [line for line in text.split(b"\n") if line.strip()]
    upper, lower = (len(text) - len(text.translate(None, bytes(range(a, a + 26)))) for a in (65, 97))
    return (
        len(words),
        len(points.translate(None, _SPACES)),
        len(text) - len(text.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        upper,
        upper + lower,
    )


FIELDS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, n_lines bigint, n_upper bigint, n_letters bigint"
)


def with_measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of each row."""

    def start():
        return lambda part: list(zip(*map(measures, utf8(part)), strict=True)) or [[]] * 8

    return add_columns(docs.select("doc_id", "lang", "source", "text"), FIELDS, start).drop("text")


def with_statistics(measured: DataFrame, smoothed: bool = False) -> DataFrame:
    """Ratios of the counts; ``smoothed`` with one event more on both sides.

    Sketches take the smoothed ones: a count that is mostly zero has no spread, but
    how much one event would weigh spreads with the lengths of the texts. Texts are
    judged by the plain ones, so that one without any event is never an outlier.
    """

    def ratio(over: str, under: str, event: int = 1) -> Column:
        if smoothed:
            return (F.col(over) + event) / (F.col(under) + event)
        return F.coalesce(F.try_divide(F.col(over), F.col(under)), F.lit(0.0))

    return measured.withColumns(
        {
            "symbol_ratio": ratio("n_symbols", "n_words"),
            "upper_ratio": ratio("n_upper", "n_letters"),
            "repeat_ratio": ratio("n_repeat_words", "n_words", _WINDOW),
            "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
            "mean_word": F.coalesce(F.try_divide(F.col("word_chars"), F.col("n_words")), F.lit(0.0)),
        }
    )


def bucket(value: Column) -> Column:
    """Sketch bucket of a value; all below ``LEAST`` share one."""
    place = F.ceil(F.log(value / LEAST) / math.log(GROWTH)).cast("int")
    return F.when(value >= LEAST, place).otherwise(F.lit(ZERO))


def _middle(place: Column) -> Column:
    value = LEAST * F.pow(F.lit(GROWTH), place - 0.5)
    return F.when(place == ZERO, F.lit(0.0)).otherwise(value)


def sketches(rows: DataFrame) -> DataFrame:
    """``lang, source, name, place, n``: the sketch of each statistic per group."""
    named = [F.struct(F.lit(s).alias("name"), bucket(F.col(s)).alias("place")) for s in STATISTICS]
    return (
        rows.select("lang", "source", F.explode(F.array(*named)).alias("s"))
        .groupBy("lang", "source", "s.name", "s.place")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def quartiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """``by, name, size, median, spread, at_least`` from merged sketches.

    The spread is the distance of the nearer quartile to the median, at least one bucket.
    """
    merged = sketch.groupBy(*by, "name", "place").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "name")
    upto = group.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = merged.withColumns({"upto": F.sum("n").over(upto), "all": F.sum("n").over(group)})
    reaches = lambda q: F.min(F.when(F.col("upto") >= q * F.col("all"), F.col("place")))
    found = summed.groupBy(*by, "name").agg(
        *[_middle(reaches(q)).alias(f"q{round(100 * q)}") for q in (0.25, 0.5, 0.75)],
        F.max("all").alias("size"),
    )
    near = F.least(F.col("q75") - F.col("q50"), F.col("q50") - F.col("q25"))
    bucket_width = (GROWTH - 1) * F.col("q50")
    return found.select(
        *by,
        "name",
        "size",
        F.col("q50").alias("median"),
        F.greatest(near, bucket_width).alias("spread"),
        (near < bucket_width).alias("at_least"),
    )


def _leaning(own: str, above: str) -> Column:
    """A value of a group, drawn to that of the level above by its weight."""
    size = F.col("size")
    return (size * F.col(own) + WEIGHT * F.col(above)) / (size + WEIGHT)


def thresholds(sketch: DataFrame) -> DataFrame:
    """``lang, source, name, side, size, median, spread, at_least, threshold`` of each rule and group.

    ``at_least`` says that the group's own spread was below one bucket.
    """
    priors: dict[str, float] = {}
    for name, _, prior in RULES:
        priors[name] = prior
    prior = F.create_map(*[F.lit(x) for pair in priors.items() for x in pair])
    table = quartiles(sketch, []).select(
        "name",
        F.col("median").alias("table_median"),
        ((F.col("size") * F.col("spread") + WEIGHT * prior[F.col("name")]) / (F.col("size") + WEIGHT)).alias(
            "table_spread"
        ),
    )
    languages = (
        quartiles(sketch, ["lang"])
        .join(F.broadcast(table), "name")  # a row per statistic
        .select(
            "lang",
            "name",
            _leaning("median", "table_median").alias("lang_median"),
            _leaning("spread", "table_spread").alias("lang_spread"),
        )
    )
    own = quartiles(sketch, ["lang", "source"]).join(languages, ["lang", "name"])
    rules = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(s).alias("side")) for n, s, _ in RULES])
    leaned = own.select(
        "lang",
        "source",
        "name",
        "size",
        _leaning("median", "lang_median").alias("median"),
        _leaning("spread", "lang_spread").alias("spread"),
        "at_least",
        "lang_median",
        "lang_spread",
        F.explode(F.filter(rules, lambda r: r["rule"] == F.col("name"))).alias("r"),
    )
    sign = F.when(F.col("r.side") == "high", 1.0).otherwise(-1.0)
    # How far the group's own threshold is from the median of the language, outwards.
    reach = sign * (F.col("median") - F.col("lang_median")) + FACTOR * F.col("spread")
    of_lang = FACTOR * F.col("lang_spread")
    bounded = F.least(F.greatest(reach, NEAREST * of_lang), FARTHEST * of_lang)
    value = F.col("lang_median") + sign * bounded
    slack = F.when(sign > 0, value * GROWTH).otherwise(value / GROWTH)  # error of the sketch
    return leaned.select(
        "lang", "source", "name", "r.side", "size", "median", "spread", "at_least", slack.alias("threshold")
    )


def _limits(found: DataFrame) -> DataFrame:
    """One row per group, with a column for each rule."""
    each = [
        F.max(F.when((F.col("name") == n) & (F.col("side") == s), F.col("threshold"))).alias(f"{n}_{s}")
        for n, s, _ in RULES
    ]
    return found.groupBy("lang", "source").agg(*each)


def judged(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of counts and statistics with ``base_failed``, settled, and their ``thresholds``."""
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    group = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit(""))
    measured = with_measures(docs).withColumns({"lang": group("lang"), "source": group("source")})
    kept = settle(measured.withColumn("row", F.monotonically_increasing_id()))
    rows = kept.withColumn("base_failed", failed)
    learned_from = with_statistics(rows.where(~F.col("base_failed")), smoothed=True)
    return with_statistics(rows), settle(thresholds(settle(sketches(learned_from))))


def quality_rules(docs: DataFrame) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` for each row of ``docs``.

    ``base_failed`` is a fixed rule: fewer than 10 words, or over a fifth of them
    in repeated windows. ``kept`` also needs every statistic within the thresholds of
    the row's language and source, learned from the rows that pass the fixed rule. A
    NULL language or source is a group of its own, apart from ''; a NULL text
    has no words; repeated rows come back repeated and count as often; an empty
    table gives no rows; other columns are ignored.
    """
    rows, found = judged(docs)
    key = F.concat_ws("\x00", "lang", "source").alias("group")
    limits = _limits(found).select(key, *[f"{n}_{s}" for n, s, _ in RULES])
    joined = sized_join(
        rows.select("*", key), limits, "group", "left", measure(limits), salt_by=["row"]
    )
    inside = F.lit(True)
    for name, side, _ in RULES:
        limit = F.col(f"{name}_{side}")
        inside &= F.col(name) <= limit if side == "high" else F.col(name) >= limit
    return joined.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & F.coalesce(inside, F.lit(True))).alias("kept"),
    )
