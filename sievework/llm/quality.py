"""Quality rules whose cut-offs come from the corpus: quantile sketches per language and source.

Every document is measured inside the JVM.  Its ratios are summarised by mergeable KLL
sketches per (language, source); a group with too few documents borrows the merged sketch
of its language, and a language with too few that of all documents.  The sketches give
fences around the middle half of each ratio, and a join applies them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.columns import let, words
from sievework.session import through_storage

WINDOW = 5
MIN_WORDS, MAX_REPEATED_PERCENT = 10, 20
SYMBOLS = r"[#*$%&|<>]"
#: Items a sketch keeps; up to this many values the quantiles are exact, beyond it the rank error is about 0.1 %.
SKETCH_K = 4096
#: A group with fewer measured documents uses the fences of its language, then those of the corpus.
MIN_GROUP = 50
#: A fence lies this many quartile distances outside the quartiles, plus the slack of its ratio.
SPREAD = 6.0
SLACK = {"symbol_ratio": 0.1, "word_length": 2.0, "dup_line_ratio": 0.3, "repeat_ratio": 0.1}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _covered(starts: Column) -> Column:
    """Positions covered by windows that begin at the ascending ``starts``."""
    gaps = F.transform(starts, lambda x, j: F.when(
        j + 1 < F.size(starts), F.least(F.lit(WINDOW), F.get(starts, j + 1) - x)).otherwise(F.lit(WINDOW)))
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)


def _repeated(hashes: Column) -> Column:
    """Words inside windows whose hash occurs at least twice; windows are only sorted where one repeats."""
    def neighbours(s: Column) -> Column:
        same = F.filter(F.transform(s, lambda x, j: F.when(
            (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"]), x["i"])), lambda i: i.isNotNull())
        return let(F.sort_array(same), _covered)
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(let(pairs, neighbours))


def _windows(w: Column) -> Column:
    return F.when(F.size(w) <= WINDOW, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW),
                    lambda i: F.xxhash64(*[w[i + k] for k in range(WINDOW)])))


def measures(text: Column) -> Column:
    """One struct: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (NULL counts as no text)."""
    text = F.coalesce(text, F.lit(""))

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"),
                        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                        let(_windows(w), _repeated).alias("n_repeat_words"))

    by_word = let(words(text), of_words)
    repeats = let(F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
                  lambda lines: (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"))
    return let(by_word, lambda m: F.struct(
        m["n_words"].alias("n_words"), m["word_chars"].alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"), repeats.alias("n_dup_lines"),
        m["n_repeat_words"].alias("n_repeat_words")))


def _ratios(m: Column) -> dict[str, Column]:
    n = F.greatest(m["n_words"], F.lit(1)).cast("double")
    return {"symbol_ratio": m["n_symbols"] / n, "word_length": m["word_chars"] / n,
            "dup_line_ratio": m["n_dup_lines"] / n, "repeat_ratio": m["n_repeat_words"] / n}


def _fences(sketches: DataFrame, prefix: str) -> list[Column]:
    out = []
    for r in SLACK:
        q1, q3 = (F.kll_sketch_get_quantile_double(F.col(r), F.lit(q)) for q in (0.25, 0.75))
        reach = (q3 - q1) * SPREAD + SLACK[r]
        out.append(F.struct((q1 - reach).alias("lo"), (q3 + reach).alias("hi")).alias(f"{prefix}{r}"))
    return [F.col("n").alias(f"{prefix}n"), *out]


def fences(measured: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """Per (lang, source), NULLs being values of their own: lo and hi of every ratio.

    ``measured`` has lang, source and m (the struct of ``measures``); documents that failed
    the base rules are left out by the caller.
    """
    ratios = {k: v for k, v in _ratios(F.col("m")).items()}
    fine = (measured.select("lang", "source", *[v.alias(k) for k, v in ratios.items()]).groupBy("lang", "source")
            .agg(F.count(F.lit(1)).alias("n"), *[F.kll_sketch_agg_double(r, F.lit(SKETCH_K)).alias(r) for r in ratios]))
    fine = through_storage(fine, "quality-sketches")
    merged = [F.sum("n").alias("n"), *[F.kll_merge_agg_double(r, F.lit(SKETCH_K)).alias(r) for r in ratios]]
    by_lang, everything = fine.groupBy("lang").agg(*merged), fine.groupBy().agg(*merged)
    none = F.lit(None).cast("struct<lo:double,hi:double>")
    overall = {r: none for r in ratios}
    if not fine.isEmpty():
        row = everything.select(*_fences(everything, "")).first()  # one row: the fences of the whole corpus
        overall = {r: F.struct(F.lit(row[r]["lo"]).alias("lo"), F.lit(row[r]["hi"]).alias("hi")) for r in ratios}
    joined = fine.select("lang", "source", *_fences(fine, "g_")).join(
        by_lang.select(F.col("lang").alias("l_lang"), *_fences(by_lang, "l_")), F.col("lang").eqNullSafe(F.col("l_lang")))
    chosen = [F.when(F.col("g_n") >= min_group, F.col(f"g_{r}")).when(F.col("l_n") >= min_group, F.col(f"l_{r}"))
              .otherwise(overall[r]).alias(r) for r in ratios]
    return joined.select("lang", "source", *chosen)


def judge(docs: DataFrame, keep_columns: list[str], min_group: int = MIN_GROUP) -> DataFrame:
    """``keep_columns`` of ``docs`` as struct ``d``, its measures ``m``, base_failed and kept.

    Needs text, lang, source.  NULL or empty text has no words and fails the base rules; a
    NULL language or source is a group of its own; repeated rows and repeated ids are judged
    row by row; extra columns may have any name; an empty table gives an empty result.
    A base failure is fewer than 10 words, or more than a fifth of the words in repeated
    five-word windows.  Other documents stay if every ratio lies within the fences of
    their group.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep_columns]).alias("d"), F.col("lang"), F.col("source"),
                       measures(F.col("text")).alias("m"))
    rows = through_storage(rows, "quality-measures")
    m = F.col("m")
    failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEATED_PERCENT * m["n_words"])
    cut = fences(rows.where(~failed), min_group).select(
        F.col("lang").alias("f_lang"), F.col("source").alias("f_source"), *SLACK)
    inside = F.lit(True)
    for name, ratio in _ratios(m).items():
        inside = inside & ratio.between(F.col(name)["lo"], F.col(name)["hi"])
    joined = rows.join(cut, F.col("lang").eqNullSafe(F.col("f_lang")) & F.col("source").eqNullSafe(F.col("f_source")), "left")
    return joined.select("d", "m", failed.alias("base_failed"), (~failed & F.coalesce(inside, F.lit(False))).alias("kept"))
