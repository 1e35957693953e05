"""Quality rules with adaptive thresholds (operator 6), in built-in functions only.

Five measures of every document go into mergeable KLL sketches per language and source. Sketches
of a language's sources merge into the language's, those into that of all. Rates of rare things
(symbols, bangs, repeated lines) count one more than was found and are taken as logarithms, so they
spread in every group, with or without such things; word length and letter share are taken as they
are. A limit is the group's own middle value plus or less a multiple of the distance from there to
its own quarter. There is no fixed cutoff: a group's quartiles are averaged with its language's,
which count as ``PRIOR`` documents, and those with the quartiles of all, so small groups lean on
larger ones by degrees; a spread is never below a quarter of the wider group's, and a limit never
nearer to the middle than ``SLACK``, so a group of like texts does not drop what is hardly different. The limits are joined back and a document is kept if it passes the base
rules and all of them.

Defined cases: a null text has no words; a null language or source is a group of its own;
documents without words fail the base rules and enter no sketch; whole texts are measured, however
long; repeated rows count each; columns of any other name stay as they are; an empty table gives an
empty result.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, durable, small_or_not, text_or_empty

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
WINDOW = 5
#: Base rule: percentage of words in repeated windows.
MAX_REPEAT_PERCENT = 20
#: Measure: multiples of the lower and the upper quarter's distance from the middle, None where that side is free.
RULES = {"symbol_rate": (None, 6.0), "bang_rate": (None, 6.0), "dup_line_rate": (None, 6.0), "word_length": (10.0, 10.0), "letter_share": (12.0, None)}
#: How far from the middle a limit lies at least: two more found in a text with none, half a character a word, a twentieth of the characters.
#: It matters only where a group's quartiles nearly coincide.
SLACK = {"symbol_rate": log(3), "bang_rate": log(3), "dup_line_rate": log(3), "word_length": 0.5, "letter_share": 0.05}
#: A quarter's distance is at least this share of that of the group's language, and that one's of that of all.
LEAST_SPREAD = 0.25
#: Documents that the wider group's quartiles count as.
PRIOR = 50.0
KLL_K = 200
BROADCAST_GROUPS = 100_000


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def window_hashes(words: Column, window: int = WINDOW) -> Column:
    """Hashes of all windows of ``window`` words; none for shorter texts.

    Each word is hashed once. A window's hash xors its words' hashes, each shifted by its place:
    different windows agree with a chance of 2 ** -60."""
    def mixed(w: Column) -> Column:
        out = w["c0"]
        for i in range(1, window):
            out = out.bitwiseXOR(F.shiftleft(w[f"c{i}"], i))
        return out

    def zipped(h: Column) -> Column:
        n = F.greatest(F.size(h) - window + 1, F.lit(0))
        return F.transform(F.arrays_zip(*(F.slice(h, F.lit(i + 1), n).alias(f"c{i}") for i in range(window))), mixed)

    return _let(F.transform(words, lambda w: F.xxhash64(w)), zipped)


def repeated_words(windows: Column, window: int = WINDOW) -> Column:
    """Words that lie in windows found twice or more, from :func:`window_hashes`.

    Most texts repeat no window, which a hash set tells. For the others the windows are sorted
    with their positions; each repeated one covers the words up to the next, ``window`` at most."""

    def covered(s: Column) -> Column:
        same = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
        at = F.sort_array(F.transform(F.filter(s, lambda x, i: same(x, i + 1) | same(x, i - 1)), lambda x: x["i"]))
        return _let(at, lambda p: F.when(F.size(p) == 0, 0).otherwise(window + F.aggregate(
            F.transform(p, lambda x, j: F.when(j > 0, F.least(F.lit(window), x - F.get(p, j - 1))).otherwise(0)), F.lit(0), lambda a, x: a + x)))

    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(_let(pairs, covered)).cast("long")


def without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def measured(docs: DataFrame, carry: list[Column], text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """The carried columns, ``lang, source``, the measures of the base rules, ``base_failed`` and the five of ``RULES``."""
    text = F.col("text")
    m = docs.select(F.struct(*carry).alias("own"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), text_or_empty(text_col).alias("text"))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    m = m.select(
        "*", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"),
        (F.char_length(text) - F.char_length(without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        (F.char_length(text) - F.char_length(without(text, "!"))).alias("n_bangs"),
        F.char_length(F.regexp_replace(text, r"[^\p{L}\p{M}]+", "")).alias("n_letters"),
        _let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("lines"))
    m = m.select("*", F.size("words").cast("long").alias("n_words"), F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
                 repeated_words(window_hashes(F.col("words"))).alias("n_repeat_words"))
    rate = lambda found, of: F.log((found + 1) / (of + 10))
    return m.select(
        "own", "lang", "source", "n_words", "word_chars", "n_symbols", F.col("lines.dup").alias("n_dup_lines"), "n_repeat_words",
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"),
        rate(F.col("n_symbols"), F.col("n_words")).alias("symbol_rate"), rate(F.col("n_bangs"), F.col("n_words")).alias("bang_rate"),
        rate(F.col("lines.dup"), F.col("lines.n")).alias("dup_line_rate"),
        (F.col("word_chars") / F.greatest("n_words", F.lit(1))).alias("word_length"), (F.col("n_letters") / F.greatest("word_chars", F.lit(1))).alias("letter_share"))


def sketches(measures: DataFrame) -> DataFrame:
    """A KLL sketch for each language, source and measure, with the group's documents."""
    return measures.where("n_words > 0").groupBy("lang", "source").agg(
        F.count("*").alias("n"), *(F.kll_sketch_agg_double(k, F.lit(KLL_K)).alias(k) for k in RULES))


def thresholds(groups: DataFrame) -> DataFrame:
    """``lang, source`` and the limits (low, high) of each measure, from :func:`sketches` (a written table)."""
    merged = lambda *by: groups.groupBy(*by).agg(F.sum("n").alias("n"), *(F.kll_merge_agg_double(k, F.lit(KLL_K)).alias(k) for k in RULES))

    def quartiles(df: DataFrame, name: str, *by: Column | str) -> DataFrame:
        of = lambda k: F.array(*(F.kll_sketch_get_quantile_double(k, F.lit(p)) for p in (0.25, 0.5, 0.75))).alias(k)
        return df.where("n > 0").select(*by, F.struct("n", *map(of, RULES)).alias(name))

    def leaning(own: str, wider: Column, k: str) -> Column:
        n = F.col(f"{own}.n")
        mixed = F.zip_with(F.col(f"{own}.{k}"), wider, lambda a, b: (n * a + PRIOR * b) / (n + PRIOR))

        def spread(q: Column) -> Column:
            at = lambda x, i: F.get(x, F.lit(i))
            return F.array(F.least(at(q, 0), at(q, 1) - LEAST_SPREAD * (at(wider, 1) - at(wider, 0))), at(q, 1), F.greatest(at(q, 2), at(q, 1) + LEAST_SPREAD * (at(wider, 2) - at(wider, 1))))

        return _let(mixed, spread).alias(k)

    joined = (
        quartiles(groups, "own", "lang", "source")
        .join(quartiles(merged("lang"), "of_lang", F.col("lang").alias("l")), F.col("lang").eqNullSafe(F.col("l")))
        .withColumn("one", F.lit(1)).join(quartiles(merged(), "of_all", F.lit(1).alias("one")), "one"))
    joined = joined.select("*", *(leaning("of_lang", F.col(f"of_all.{k}"), k) for k in RULES))
    joined = joined.select("lang", "source", *(leaning("own", F.col(k), k) for k in RULES))

    def limit(k: str) -> Column:
        below, above = RULES[k]
        q1, q2, q3 = (F.get(k, F.lit(i)) for i in range(3))
        low = F.lit(float("-inf")) if below is None else q2 - F.greatest(below * (q2 - q1), F.lit(SLACK[k]))
        high = F.lit(float("inf")) if above is None else q2 + F.greatest(above * (q3 - q2), F.lit(SLACK[k]))
        return F.struct(low.alias("low"), high.alias("high")).alias(k)

    return joined.select("lang", "source", F.struct(*map(limit, RULES)).alias("limits"))


def judged(measures: DataFrame, groups: DataFrame) -> DataFrame:
    """``measures`` with ``kept``; ``groups`` are the sketches of their documents."""
    limits = durable(thresholds(durable(groups, "quality-sketches")), "quality-limits")
    few = small_or_not(limits.select(F.struct("lang", "source", "limits").alias("of")), BROADCAST_GROUPS)
    m = measures.join(few, F.col("lang").eqNullSafe(F.col("of.lang")) & F.col("source").eqNullSafe(F.col("of.source")), "left")
    passes = F.lit(True)
    for k in RULES:
        passes = passes & F.coalesce(F.col(k).between(F.col(f"of.limits.{k}.low"), F.col(f"of.limits.{k}.high")), F.lit(True))
    return m.withColumn("kept", ~F.col("base_failed") & passes)


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The measures and the verdict of every document; each text is read once."""
    m = durable(measured(docs, [F.col(id_col).alias("doc_id")], text_col, lang_col, source_col), "quality-measures")
    return judged(m, sketches(m)).select(
        "own.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def kept_documents(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The documents that are kept, with their own columns. The sketches take a pass of their own
    over the cheap measures, so that no text is written with them."""
    m = measured(docs, [F.col(f"`{c}`") for c in docs.columns], text_col, lang_col, source_col)
    return judged(m, sketches(m)).where("kept").select("own.*")
