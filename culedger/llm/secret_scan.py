"""Secret scans with a random forest against false positives (operator 6).

Candidates are long runs of token characters, matches of the known formats
inside them, and the values after an assignment to a credential's name, quoted
or up to a blank, of any length and characters. They may overlap; a span is one
candidate, whoever proposes it. Each is described by its length, its character
transitions, how much of it dictionary fragments cover, whether it is a path,
and the words around it. A forest trained on labelled findings keeps the likely secrets.
Only built-in functions and Spark's own forest.

``findings`` labels are rows (label, and the feature columns). Where none are
given, they are drawn from the corpus: candidates in a known credential format
or as the value of a credential's name are secrets (a value with blanks, letters
only or code in it is open), candidates that are prose, addresses or paths are
not; the rest is for the forest to decide. It is
fitted on at most ``sample`` findings of either sort, those with the least
hashes; all candidates of all texts are judged.

Nulls: a null text has no candidates. Repeated rows are scanned each. Extra
columns are not read. Without findings of both sorts only candidates in a
known format are reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from culedger.llm.common import let, materialize

#: Fixed value: a whole run of token characters.
CANDIDATE = r"(?<![A-Za-z0-9+/_.@-])[A-Za-z0-9+/_.@-]{16,}+={0,2}"
#: Characters of a text before a candidate that are looked at.
BEFORE = 48
#: Formats that are credentials whatever stands around them.
FORMAT = r"(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)"
FORMATS = f"^{FORMAT}$"
#: A format inside a run, between characters that are no letters or digits.
INSIDE = f"(?<![A-Za-z0-9]){FORMAT}(?![A-Za-z0-9])"
CUES = r"(?i)(?:token|secret|passw(?:or)?d|pwd|api_?key|apikey|access_?key|private_?key|auth|credential)s?"
ASSIGN = CUES + r"""["']? ?[:=]{1,2}>? ?["']?"""
ASSIGNED = ASSIGN + "$"
#: An assignment and, looked ahead at, its value (group 2): with the closing
#: quote, or up to a blank or the next assignment.
VALUE = f"({ASSIGN})" + r"""(?=((?<=")(?:[^"\\\n]++|\\.)++"|(?<=')(?:[^'\\\n]++|\\.)++'|(?![\s"'])""" + rf"(?:(?!{ASSIGN})\S)++))"
#: Closing marks that are not a run's, and not an unquoted value's.
RUN_END, VALUE_END = r"(?<![.@])[.@]+$", r"""(?<!["',;&])["',;&]+$"""
#: Frequent letter groups of English, French, German and Spanish.
FRAGMENTS = "the|and|ing|ion|tion|ent|ment|for|with|que|les|des|eau|elle|der|die|sch|ung|keit|ver|los|las|ado|ent|est|ere|ati|her|all|ter|ess|com|example|mail|www|http"
FEATURES = ("length", "transitions", "digit_share", "upper_share", "distinct_share", "hex", "vowel_share", "dictionary", "path", "address", "cue", "quoted")


def _spans(pattern: str, shortest: int, value) -> Column:
    """(start, candidate, before, after) of each match in the text ``t``.
    ``value(match, group 2, following character)`` gives the candidate, what
    of the match lies ahead of it, and the character after it. No match has fewer than ``shortest`` characters, so
    a few matches and what lies between them hold the BEFORE characters."""
    t, back = F.col("t"), -(-BEFORE // shortest)
    parts = F.struct(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)).alias("m"), F.split(t, pattern, -1).alias("b"), F.regexp_extract_all(t, F.lit(pattern), F.lit(2 if pattern == VALUE else 0)).alias("v"))

    def spans(x: Column) -> Column:
        lengths = F.transform(x["m"], lambda m, i: F.length(F.get(x["b"], i)) + F.length(m))
        at = F.aggregate(lengths, F.array(F.lit(0)).cast("array<int>"), lambda acc, n: F.array_append(acc, F.element_at(acc, -1) + n))
        tails = F.transform(x["m"], lambda m, i: F.right(F.concat(F.get(x["b"], i), m), F.lit(BEFORE)))

        def each(m: Column, i: Column, y: Column) -> Column:
            follows = F.concat(F.get(x["b"], i + 1), F.coalesce(F.get(x["m"], i + 1), F.lit("")))
            own, ahead, after = value(m, F.get(x["v"], i), follows)
            near = F.array_join(F.slice(y["tails"], F.greatest(i - back, F.lit(0)) + 1, F.least(i, F.lit(back))), "")
            before = F.right(F.concat(near, F.get(x["b"], i), ahead), F.lit(BEFORE))
            start = F.get(y["at"], i) + F.length(F.get(x["b"], i)) + F.length(ahead)
            return F.struct(start.alias("start"), own.alias("candidate"), before.alias("before"), F.left(after, F.lit(1)).alias("after"))

        return let(F.struct(at.alias("at"), tails.alias("tails")), lambda y: F.transform(x["m"], lambda m, i: each(m, i, y)))

    none = F.array().cast("array<struct<start:int,candidate:string,before:string,after:string>>")
    return F.when(F.regexp_like(t, F.lit(pattern)), let(parts, spans)).otherwise(none)


def _format(m: Column, _: Column, follows: Column) -> tuple[Column, Column, Column]:
    return m, F.lit(""), follows


def _run(m: Column, _: Column, follows: Column) -> tuple[Column, Column, Column]:
    own = F.regexp_replace(m, RUN_END, "")
    return own, F.lit(""), F.concat(F.substring(m, F.length(own) + 1, F.length(m)), follows)


def _value(m: Column, own: Column, _: Column) -> tuple[Column, Column, Column]:
    quote = F.right(m, F.lit(1))
    opened, closed = quote.isin("'", '"'), quote.isin("'", '"') & (F.right(own, F.lit(1)) == quote)
    bare = F.when(opened, own).otherwise(F.regexp_replace(own, VALUE_END, ""))
    return F.when(closed, F.left(own, F.length(own) - 1)).otherwise(bare), m, F.when(closed, quote).otherwise("")


def candidates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rows (doc_id, key, row, number, candidate, before, after), a row for each
    candidate; ``row`` numbers the rows of ``docs``, so repeated ones are told
    apart; ``number`` counts a text's candidates by their start from 0."""
    own = F.coalesce(F.col(text), F.lit(""))
    found = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(doc_id), F.col(text)).alias("key"), F.monotonically_increasing_id().alias("row"), own.alias("t"))
    spans = F.array_sort(F.concat(_spans(CANDIDATE, 16, _run), _spans(INSIDE, 11, _format), _spans(VALUE, 4, _value)))
    once = let(spans, lambda a: F.filter(a, lambda c, i: (i == 0) | (c != F.coalesce(F.get(a, i - 1), c))))
    rows = found.select("doc_id", "key", "row", F.posexplode_outer(once).alias("number", "c")).where("c.candidate != ''")
    return rows.select("doc_id", "key", "row", F.col("number").cast("long").alias("number"), "c.candidate", "c.before", "c.after")


def _share(pattern: str) -> Column:
    return F.regexp_count("candidate", F.lit(pattern)) / F.length("candidate")


def features() -> dict[str, Column]:
    c = F.col("candidate")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[a-z]", "a"), "[A-Z]", "b"), "[0-9]", "1"), "[^ab1]", "-")
    return {
        "length": F.length(c).cast("double"),
        "transitions": (F.length(F.regexp_replace(kinds, r"(.)\1*", "$1")) - 1) / F.length(c),
        "digit_share": _share("[0-9]"),
        "upper_share": _share("[A-Z]"),
        "distinct_share": F.size(F.array_distinct(F.split(c, ""))) / F.length(c),
        "hex": F.regexp_like(c, F.lit("^[0-9a-fA-F]+$")).cast("double"),
        "vowel_share": _share("[aeiouAEIOU]"),
        "dictionary": 1 - F.length(F.regexp_replace(F.lower(c), FRAGMENTS, "")) / F.length(c),
        "path": F.regexp_like(c, F.lit(r"/.*/|\.(?:html?|php|js|css|png|jpe?g|py|com|org|net)\b")).cast("double"),
        "address": c.contains("@").cast("double"),
        "cue": F.regexp_like("before", F.lit(CUES)).cast("double"),
        "quoted": (F.regexp_like("before", F.lit("""["']$""")) & F.col("after").isin("\"", "'")).cast("double"),
    }


def weak_label() -> Column:
    """1: a known format, or the value of a credential's name; 0: prose,
    addresses, paths and plain numbers; null: open."""
    c = F.col("candidate")
    mixed = F.regexp_like(c, F.lit("[0-9]")) & F.regexp_like(c, F.lit("[A-Za-z]"))
    assigned, quoted, blank = F.regexp_like("before", F.lit(ASSIGNED)), F.col("quoted") > 0, F.regexp_like(c, F.lit(r"\s"))
    code = ~quoted & F.regexp_like(c, F.lit(r"[(){}\[\]<>$]"))
    secret = F.regexp_like(c, F.lit(FORMATS)) | (assigned & mixed & ~blank & ~code)
    plain = ~F.regexp_like(c, F.lit("[0-9]")) | F.regexp_like(c, F.lit("^[0-9./_-]+$")) | c.contains("@") | F.regexp_like(c, F.lit("^/|://"))
    return F.when(secret, 1).when(plain & ~(assigned & quoted & ~blank), 0).cast("int")


def fit(findings: DataFrame, sample: int, seed: int = 11):
    """A forest over rows (label, features); None without both labels."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    draw = F.xxhash64(*FEATURES)
    rank = Window.partitionBy("label").orderBy("draw")
    own = findings.where("label is not null").select("label", *FEATURES).distinct().withColumn("draw", draw)
    drawn = own.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= sample)
    drawn = materialize(drawn.coalesce(1).orderBy("draw", "label"), "findings")
    if drawn.select("label").distinct().count() < 2:
        return None
    vector = array_to_vector(F.array(*[F.col(f).cast("double") for f in FEATURES]))
    return RandomForestClassifier(labelCol="label", featuresCol="vector", numTrees=24, maxDepth=6, seed=seed).fit(drawn.select(F.col("label").cast("double").alias("label"), vector.alias("vector")).coalesce(1))


def scan(docs: DataFrame, findings: DataFrame | None = None, sample: int = 10_000, threshold: float = 0.5, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rows (doc_id, key, row, number, candidate, probability, secret), one for
    each candidate."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = candidates(docs, text, doc_id).withColumns(features()).withColumn("label", weak_label())
    rows = materialize(rows, "candidates")
    model = fit(rows if findings is None else findings, sample)
    known = F.regexp_like("candidate", F.lit(FORMATS))
    if model is None:
        out = rows.withColumn("probability", known.cast("double"))
    else:
        vector = array_to_vector(F.array(*[F.col(f).cast("double") for f in FEATURES]))
        out = model.transform(rows.withColumn("vector", vector).drop("label")).withColumn("probability", vector_to_array("probability")[1])
    return out.select("doc_id", "key", "row", "number", "candidate", "probability", (known | (F.col("probability") >= threshold)).alias("secret"))
