"""Quality rules with thresholds from quantile sketches per language and source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.binding import with_once
from tidemark.llm.store import free_name, written
from tidemark.llm.texts import SPACE_RUN, SPACES, symbol_count, word_array, word_chars

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SKETCH_K = 200
#: Per ratio: a cutoff is the third quartile and so many spreads, where a spread is the
#: interquartile range or, in sources whose texts are nearly all alike, the value given.
RATIOS = {"symbol_ratio": (3.0, 0.03), "dup_line_ratio": (3.0, 0.10), "long_word": (5.0, 0.75)}


def with_counts(docs: DataFrame, text_column: str = "text", repeats: bool = True) -> DataFrame:
    """Adds ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` and, if asked,
    ``n_repeat_words``. Null text has no words.

    Repeated windows are found by sorting the hashes of a text's windows, so the work is
    n log n per text and no row is exploded or shuffled.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    words = with_once(docs, {"__w": word_array(text)})
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    counted = with_once(words, {
        "n_words": F.size("__w").cast("long"),
        "word_chars": word_chars(text),
        "n_symbols": symbol_count(text),
        "__lines": lines,
        **({"__grams": F.when(F.size("__w") >= 4, F.transform(
            F.sequence(F.lit(0), F.size("__w") - 3),
            lambda i: F.xxhash64(F.get(F.col("__w"), i), F.get(F.col("__w"), i + 1), F.get(F.col("__w"), i + 2)),
        ))} if repeats else {}),
    }).withColumn("n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long")).withColumn(
        "__n_lines", F.size("__lines")).drop("__w", "__lines")
    if not repeats:
        return counted
    some = F.size(F.array_distinct("__grams")) < F.size("__grams")
    in_order = with_once(counted, {"__s": F.when(some, F.sort_array(
        F.transform("__grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))))}).drop("__grams")
    same = lambda x, other: F.coalesce(other["g"] == x["g"], F.lit(False))
    again = F.filter("__s", lambda x, j: (
        same(x, F.get(F.col("__s"), j - 1)) | same(x, F.get(F.col("__s"), j + 1))))
    places = with_once(in_order, {"__p": F.sort_array(F.transform(again, lambda x: x["i"]))}).drop("__s")
    gaps = F.transform("__p", lambda p, j: F.least(F.lit(3), F.coalesce(F.get(F.col("__p"), j + 1) - p, F.lit(3))))
    covered = F.aggregate(gaps, F.lit(0).cast("long"), lambda a, b: a + b)
    return with_once(places, {"n_repeat_words": F.coalesce(covered, F.lit(0).cast("long"))}).drop("__p")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _ratios() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "symbol_ratio": F.col("n_symbols") / words,
        "dup_line_ratio": F.col("n_dup_lines") / F.greatest(F.col("__n_lines"), F.lit(1)),
        "long_word": F.col("word_chars") / words,
    }


def thresholds(counted: DataFrame, keys: list[str]) -> DataFrame:
    """Cutoffs ``max_<ratio>`` per group of ``keys``, from mergeable KLL sketches. The sketches are merged from partial ones, so a hot group moves one sketch per task."""
    ratios = _ratios()
    sketches = counted.where("n_words > 0").groupBy(*keys).agg(
        *[F.kll_sketch_agg_double(c, F.lit(SKETCH_K)).alias(n) for n, c in ratios.items()])
    third = {n: F.kll_sketch_get_quantile_double(n, F.lit(0.75)) for n in ratios}
    first = {n: F.kll_sketch_get_quantile_double(n, F.lit(0.25)) for n in ratios}
    return sketches.select(*keys, *[
        (third[n] + RATIOS[n][0] * F.greatest(F.lit(RATIOS[n][1]), third[n] - first[n])).alias(f"max_{n}") for n in ratios])


def judged(docs: DataFrame, text_column: str = "text", lang_column: str = "lang", source_column: str = "source", into: str = "__q") -> DataFrame:
    """The columns of ``docs`` and ``into``, which must not be one of them: a struct of the counts, ``base_failed``,
    ``kept`` and the group's cutoffs.

    The first pass sketches the ratios of all documents, the second counts again and joins
    the cutoffs on, one row per language and source; no text moves.

    Null text: no words, so ``base_failed``. Null language or source: a group of its own.
    A group without any word has no cutoff and rejects nothing beyond the base rule.
    Repeated rows: judged alike. Empty input: no rows.
    """
    keys = {"lang": F.col(lang_column), "source": F.col(source_column)}
    only = docs.select(F.col(text_column).alias("text"), *[c.alias(n) for n, c in keys.items()])
    cuts = written(thresholds(with_counts(only, repeats=False), list(keys)), "quality-cuts")
    packed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("__row"), F.col(text_column).alias("text"), *[c.alias(n) for n, c in keys.items()])
    counted = with_counts(packed).drop("text").alias("d")
    cuts = cuts.alias("c")
    joined = counted.join(cuts, F.col("d.lang").eqNullSafe(F.col("c.lang")) & F.col("d.source").eqNullSafe(F.col("c.source")), "left")
    over = F.lit(False)
    for name, ratio in _ratios().items():
        over = over | F.coalesce(ratio > F.col(f"max_{name}"), F.lit(False))
    verdict = F.struct(
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), (~base_failed() & ~over).alias("kept"),
        *[F.col(f"max_{n}") for n in RATIOS])
    return joined.select("__row.*", verdict.alias(into))


def quality_filter(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns, whatever their names."""
    name = free_name(docs, "__q")
    return judged(docs, into=name).where(F.col(name)["kept"]).drop(name)
