"""Quality rules (operator 5): a table of thresholds compiled into one Spark
projection. Only built-in functions; nothing is shuffled.

Nulls and empty texts have no words and fail the length rule. Repeated rows
are judged each on its own. Extra columns are kept; a column named like a
metric is replaced by the metric.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from culedger.llm.common import UNEVEN_BLANKS, WORD, let

#: Characters counted as symbols, and frequent function words of
#: English, French, German and Spanish.
SYMBOLS = "#*$%&|<>"
STOP_WORDS = (
    "the of and to in de la le les que der die und el los"
).split()

#: (rule, ratio, lowest, highest): a document is kept if every ratio lies
#: within its bounds; None is no bound. Ratios are named in ``RATIOS``.
RULES = (
    ("length", "n_words", 10, None),
    ("repeated windows", "repeat_ratio", None, 0.20),
    ("mean word length, short", "mean_word", 1.5, None),
    ("mean word length, long", "mean_word", None, 25.0),
    ("symbols", "symbol_ratio", None, 0.25),
    ("shouting", "bang_ratio", None, 0.50),
    ("duplicate lines", "dup_line_ratio", None, 0.60),
    ("stop words", "stop_shortfall", None, 0.0),
)

#: What each ratio of the table is, over the measured columns. Stop words are
#: asked for (one in a hundred words) from 80 words on only: a short text may
#: well have none.
RATIOS = {
    "n_words": "n_words",
    "repeat_ratio": "n_repeat_words / n_words",
    "mean_word": "word_chars / n_words",
    "symbol_ratio": "n_symbols / n_words",
    "bang_ratio": "n_bangs / n_words",
    "dup_line_ratio": "n_dup_lines / n_lines",
    "stop_shortfall": "if(n_words >= 80, 0.01 * n_words - n_stop_words, 0)",
}

WINDOW = 5


def _drop(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def _covered(grams: Column) -> Column:
    """Words in windows that occur twice or more; grams: a text's windows of
    ``WINDOW`` words in order, as strings."""
    def spans(at: Column) -> Column:  # at: ascending starts
        steps = F.transform(at, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda total, x: total + x)

    def twins(pairs: Column) -> Column:  # pairs: by hash, then start
        same = F.filter(pairs, lambda x, i: F.coalesce(F.get(pairs, i + 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(pairs, i - 1)["h"] == x["h"], F.lit(False)))
        return let(F.sort_array(F.transform(same, lambda x: x["i"])), spans)

    pairs = F.transform(grams, lambda g, i: F.struct(F.xxhash64(g).alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(grams)) < F.size(grams), let(F.sort_array(pairs), twins)).otherwise(F.lit(0))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts that the rules are made of: n_words, word_chars,
    n_symbols, n_lines, n_dup_lines, n_bangs, n_stop_words (in lower case, with a
    word on either side) and n_repeat_words (long).

    The five-word windows of a text are cut out by one pattern; only texts
    that hold a window twice look at positions, by 64-bit hashes."""
    flat, compact = F.col("__flat"), F.col("__compact")
    word, lines = "[^ ]+", F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: F.regexp_like(x, F.lit(WORD)))
    counts = {
        "n_words": F.length(flat) - F.length(compact) + (flat != "").cast("int"),
        "word_chars": F.length(compact),
        "n_symbols": F.length(compact) - F.length(_drop(compact, f"[{SYMBOLS}]")),
        "n_bangs": F.length(compact) - F.length(F.replace(compact, F.lit("!"))),
        "n_stop_words": F.regexp_count(flat, F.lit(f" (?:{'|'.join(STOP_WORDS)})(?= )")),
        "n_lines": F.size("__lines"),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": _covered(F.col("__grams")),
    }
    out = docs.withColumn("__flat", F.trim(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), UNEVEN_BLANKS, " ")))
    out = out.withColumns({"__compact": F.replace(flat, F.lit(" ")), "__lines": lines, "__grams": F.regexp_extract_all(flat, F.lit(f"(?<![^ ])(?=({' '.join([word] * WINDOW)}))"), F.lit(1))})
    return out.withColumns({k: v.cast("long") for k, v in counts.items()}).drop("__flat", "__compact", "__lines", "__grams")


def passes(rules=RULES) -> Column:
    """The threshold table as one condition over the measured columns; a ratio
    without a denominator is no reason to reject."""
    ok = F.lit(True)
    for _, ratio, low, high in rules:
        value = F.expr("try_divide({}, {})".format(*RATIOS[ratio].split(" / ")) if " / " in RATIOS[ratio] else RATIOS[ratio])
        if low is not None:
            ok = ok & F.coalesce(value >= low, F.lit(True))
        if high is not None:
            ok = ok & F.coalesce(value <= high, F.lit(True))
    return ok


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def judge(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """``docs`` with the measured counts, ``base_failed`` and ``kept``."""
    out = measure(docs, text)
    return out.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & passes(rules))


def keep_good(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The documents that the rules keep, with their own columns only."""
    names = [f"__own{i}" for i in range(len(docs.columns))]
    own = docs.toDF(*names)
    at = names[docs.columns.index(text)]
    return judge(own, at, rules).where("kept").select(*names).toDF(*docs.columns)
