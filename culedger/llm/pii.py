"""Personal data: candidate gradient boosting (operator 10).

Plain patterns with checks (octets, Luhn, digit counts) give the base spans,
which always stay. High-recall generators propose further, overlapping spans,
also wider ones around base spans: cards with other separators, written-out
addresses, numbers in groups, full and compressed IPv6, letters beyond ASCII
next to an address, extensions of a phone number. Boosted trees judge them by format and context, and thresholds calibrated on
held-out labelled candidates select what is added.

Labels come from the checks: a candidate that passes its kind's pattern and
check is personal data, one that matches the pattern and fails the check is
not. The trees and thresholds come from all labelled candidates, counted by
their features; every candidate of every text is judged. Without labels of both
sorts nothing is added.

Nulls: a null text is an empty one without spans; a null doc_id is an ordinary
row. Repeated rows are judged alike. Extra columns are not read.
"""

from __future__ import annotations

import ipaddress
import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from culedger.llm.common import materialize

#: The kinds in order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Generators beyond the base: written-out addresses, numbers in groups, and
#: groups of hexadecimal digits.
SPELT = r"(?i)[A-Za-z0-9._%+-]{1,64} ?(?:[(\[{]at[)\]}] ?[A-Za-z0-9-]{1,63}(?: ?(?:[(\[{]dot[)\]}]|\.) ?[A-Za-z0-9-]{2,63}){1,4}| at [A-Za-z0-9-]{1,63}(?: dot [A-Za-z0-9-]{2,63}){1,4})"
NUMBERS = r"(?<![0-9A-Za-z.+_-])\(?[0-9]{2,5}\)?(?:[ .-]?\(?[0-9]{2,5}\)?){1,5}(?![0-9A-Za-z_])"
COLONS = r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){5,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])"
COMPRESSED = r"(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f:]{0,37}::)[0-9A-Fa-f:]{3,39}(?:(?:\.[0-9]{1,3}){3})?(?![0-9A-Za-z:])"
EXTENSION = r"(?i),? ?(?:x|ext\.?|extension) ?[0-9]{1,6}(?![0-9A-Za-z])"
#: What may part a card's groups of digits, up to three of them.
PARTING = frozenset(" .-_/\t\u00a0\u00b7\u2009\u2010\u2011\u2013\u202f")
#: Words nearby that speak for each kind.
CUES = {"email": ("mail", "e-mail", "email", "contact", "write"), "ip": ("ip", "host", "server", "address", "from"), "card": ("card", "visa", "credit", "payment", "pay"), "phone": ("phone", "tel", "call", "fax", "mobile")}

#: Rows of distinct features that the trees are fitted on in one partition.
PART_ROWS = 200_000

FEATURES = ("kind", "length", "digits", "groups", "longest", "separators", "plus", "parentheses", "at_sign", "luhn", "octets", "cue", "upper_before", "digit_near", "letters")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _card(digits: str) -> bool:
    return 14 <= len(digits) <= 19 and luhn(digits)


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def emails(text: str, local: frozenset, domain: re.Pattern) -> list:
    """Leftmost non-overlapping addresses; time in proportion to the text."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start, go_on = at, at + 1
        while start > end and text[start - 1] in local:
            start -= 1
        if start < at and (m := domain.match(text, at + 1)):
            out.append((start, m.end()))
            end = go_on = m.end()
        at = text.find("@", go_on)
    return out


def base_matches(text: str, patterns: dict) -> list:
    """(kind, start, end, whether the check passes) of the base patterns."""
    out = [("email", s, e, True) for s, e in emails(text, patterns["local"], patterns["domain"])] if "@" in text else []
    for m in patterns["ip"].finditer(text):
        out.append(("ip", *m.span(), all(map(_octet, m[0].split(".")))))
    for m in patterns["card"].finditer(text):
        d = _digits(m[0]) if m.end() - m.start() <= 64 else ""
        if m.end() - m.start() > 64 or len(d) > 5:
            out.append(("card", *m.span(), 14 <= len(d) <= 19 and luhn(d)))
    if "+" in text:
        for m in patterns["phone"].finditer(text):
            out.append(("phone", *m.span(), 10 <= len(_digits(m[0])) <= 15))
    return out


def features(text: str, kind: str, start: int, end: int) -> list:
    s = text[start:end][:256]
    d = _digits(s)
    runs = re.findall(r"[0-9]+", s)
    near = re.findall(r"[a-z-]+", text[max(0, start - 40) : start].lower())[-3:] + re.findall(r"[a-z-]+", text[end : end + 30].lower())[:2]
    octets = s.split(".")
    around = text[max(0, start - 2) : start] + text[end : end + 2]
    return [float(x) for x in (KINDS.index(kind), end - start, len(d), len(runs), max(map(len, runs), default=0), sum(c in " .-:" for c in s), "+" in s, "(" in s, "@" in s, 14 <= len(d) <= 19 and luhn(d), sum(len(o) < 8 and _digits(o) == o != "" and int(o) < 256 for o in octets) if len(octets) == 4 else 0, any(w in CUES[kind] for w in near), text[max(0, start - 1) : start].isupper(), any("0" <= c <= "9" for c in around), sum(c.isalpha() for c in s))]


def _ipv6(s: str) -> bool:
    try:
        ipaddress.IPv6Address(s)
    except ValueError:
        return False
    return any(c != ":" for c in s)


def cards(text: str, groups: re.Pattern) -> list:
    """(kind, start, end, label) of digit groups in a row, parted by up to three
    characters, that have 14 to 19 digits: to be judged if they pass Luhn; a
    whole row that fails is clean."""
    out, chain = [], []

    def close() -> None:
        digits = [text[s:e] for s, e in chain]
        if sum(map(len, digits)) >= 14:
            for i, (start, _) in enumerate(chain):
                d = ""
                for j in range(i, len(chain)):
                    d += digits[j]
                    if len(d) > 19:
                        break
                    if len(d) >= 14:
                        ok = luhn(d)
                        if ok or (i == 0 and j == len(chain) - 1):
                            out.append(("card", start, chain[j][1], None if ok else 0))
        chain.clear()

    for m in groups.finditer(text):
        s, e = m.span()
        if chain and not (s - chain[-1][1] <= 3 and PARTING.issuperset(text[chain[-1][1] : s])):
            close()
        chain.append((s, e))
    close()
    return out


def wider(text: str, base: list, patterns: dict) -> list:
    """(kind, start, end, None) of spans around base spans: addresses with
    letters beyond ASCII, phone numbers with their extension."""
    out = []
    for kind, start, end in base:
        if kind == "email":
            s = start
            while s > max(0, start - 64) and (text[s - 1].isalnum() or text[s - 1] in patterns["local"]):
                s -= 1
            e = patterns["letters"].match(text, end).end()
            if (s, e) != (start, end):
                out.append((kind, s, e, None))
        elif kind == "phone" and (m := patterns["extension"].match(text, end)):
            out.append((kind, start, m.end(), None))
    return out


def candidates(text: str, patterns: dict) -> tuple[list, list]:
    """Base spans (kind, start, end), and candidates (kind, start, end, label,
    features); label None is for the trees to decide."""
    matches = base_matches(text, patterns)
    base = [m[:3] for m in matches if m[3]]
    out = [(k, s, e, int(ok)) for k, s, e, ok in matches if ok or k == "card" or not _card(_digits(text[s:e]))]
    taken = sorted((s, e) for _, s, e in base)
    more = wider(text, base, patterns) + cards(text, patterns["digits"])
    if "at" in text.lower():
        more += [("email", *m.span(), None) for m in patterns["spelt"].finditer(text)]
    for m in patterns["numbers"].finditer(text):
        d = _digits(m[0])
        if len(d) <= 15 or not _card(d):  # else proposed as a card
            more.append(("phone", *m.span(), None if 10 <= len(d) <= 15 else 0))
    if ":" in text:
        more += [("ip", *m.span(), None) for m in patterns["colons"].finditer(text)]
    if "::" in text:
        more += [("ip", *m.span(), None) for m in patterns["compressed"].finditer(text) if _ipv6(m[0])]
    more.sort(key=lambda c: c[1])
    i = reach = 0
    seen = {c[:3] for c in out}
    for c in more:
        while i < len(taken) and taken[i][0] <= c[1]:
            reach, i = max(reach, taken[i][1]), i + 1
        apart = reach <= c[1] and (i == len(taken) or taken[i][0] >= c[2])
        # Within a base span nothing is added; what reaches beyond one is judged.
        if c[:3] not in seen and (apart or (c[3] is None and reach < c[2])):
            seen.add(c[:3])
            out.append(c)
    return base, [(*c, features(text, *c[:3])) for c in out]


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rows (doc_id, key, base, candidates), one for each document."""
    def run(batches):
        span = [("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]
        schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("base", pa.list_(pa.struct(span))), ("candidates", pa.list_(pa.struct([*span, ("label", pa.int32()), ("features", pa.list_(pa.float64()))])))])
        patterns = {"local": frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")}
        patterns |= {k: re.compile(p) for k, p in (("domain", DOMAIN), ("ip", IP), ("card", CARD), ("phone", PHONE), ("spelt", SPELT), ("numbers", NUMBERS), ("colons", COLONS), ("compressed", COMPRESSED), ("extension", EXTENSION), ("digits", r"[0-9]+"), ("letters", r"(?:[\w-]|\.(?=[\w-]))*"))}
        for b in batches:
            bases, found = [], []
            for t in b.column(2):
                base, more = candidates(t.as_py() or "", patterns)
                bases.append([{"kind": KINDS.index(k), "start": s, "end": e} for k, s, e in base])
                found.append([{"kind": KINDS.index(k), "start": s, "end": e, "label": label, "features": f} for k, s, e, label, f in more])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(bases, schema.types[2]), pa.array(found, schema.types[3])], schema=schema)

    span = "kind: int, start: int, end: int"
    ident = F.col(doc_id).cast("long")
    rows = docs.select(ident.alias("doc_id"), F.xxhash64(ident, F.col(text)).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"doc_id long, key long, base array<struct<{span}>>, candidates array<struct<{span}, label: int, features: array<double>>>")


def fit(labelled: DataFrame, precision: float, seed: int = 7):
    """Boosted trees over all rows (label, features, draw), and the threshold
    for each kind: the lowest score of 0.5 or more from which on held-out
    candidates (a quarter, by ``draw``) reach ``precision``, 0.9 at most. None if
    there are no labels of both sorts.

    Candidates that look alike are one row with their number as its weight, so
    the trees and thresholds are those of all candidates while the rows are the
    distinct features. Up to ``PART_ROWS`` of them are in one partition, whose
    order fixes every sum; beyond that, sums may differ in their last bits."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array

    held = F.pmod("draw", F.lit(4)) == 0
    alike = labelled.groupBy("features", "label").agg(F.count_if(~held).alias("n_train"), F.count_if(held).alias("n_held"))
    alike = materialize(alike, "labelled").withColumn("vector", array_to_vector("features"))
    train = alike.where("n_train > 0")
    by_label = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}  # two rows
    if len(by_label) < 2:
        return None
    rows = sum(by_label.values())
    parts = -(-rows // PART_ROWS)
    train = train.select("features", "vector", F.col("label").cast("double").alias("label"), F.col("n_train").cast("double").alias("weight"))
    train = train.repartitionByRange(parts, "features", "label").sortWithinPartitions("features", "label")
    # Spark places the trees' splits by max(maxBins ** 2, 10,000) rows: by all.
    bins = max(32, math.isqrt(rows - 1) + 1)
    model = GBTClassifier(labelCol="label", featuresCol="vector", weightCol="weight", maxIter=12, maxDepth=4, maxBins=bins, seed=seed).fit(train)
    scored = model.transform(alike.where("n_held > 0")).select(F.col("features")[0].cast("int").alias("kind"), "label", "n_held", vector_to_array("probability")[1].alias("p"))
    by_score = scored.groupBy("kind", "p").agg(F.sum("n_held").alias("n"), F.sum(F.col("n_held") * F.col("label")).alias("good"))
    above = Window.partitionBy("kind").orderBy(F.desc("p")).rowsBetween(Window.unboundedPreceding, 0)  # a row for each score
    enough = by_score.withColumn("share", F.sum("good").over(above) / F.sum("n").over(above)).where((F.col("share") >= precision) & (F.col("p") >= 0.5))
    lowest = {r["kind"]: r["p"] for r in enough.groupBy("kind").agg(F.min("p").alias("p")).collect()}  # a row for each kind
    return model, {kind: min(0.9, lowest.get(kind, 0.9)) for kind in range(len(KINDS))}


def _string(spans: Column) -> Column:
    """kind:start:end by start, then kind, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def find(docs: DataFrame, precision: float = 0.98, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rows (doc_id, key, base, spans), one for each document: arrays of
    (kind, start, end) in code points, end exclusive; ``spans`` are the base
    spans and those that the trees add, which do not overlap each other and lie
    apart from base spans or reach beyond them."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    found = materialize(scan(docs, text, doc_id), "candidates")
    each = found.select("key", F.explode("candidates").alias("c")).select("key", "c.*")
    draw = F.xxhash64("key", "kind", "start", "end")
    fitted = fit(each.where("label is not null").select("label", "features", draw.alias("draw")), precision)
    if fitted is None:
        return found.select("doc_id", "key", "base", F.col("base").alias("spans"))
    model, thresholds = fitted
    limit = F.element_at(F.create_map(*[x for k, t in thresholds.items() for x in (F.lit(k), F.lit(float(t)))]), F.col("kind"))
    asked = each.where("label is null").withColumn("vector", array_to_vector("features"))
    chosen = model.transform(asked).withColumn("p", vector_to_array("probability")[1]).where(F.col("p") >= limit)
    best = F.array_sort(F.collect_list(F.struct((-F.col("p")).alias("p"), "start", "end", "kind")))
    apart = lambda done, x: F.when(F.exists(done, lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"])), done).otherwise(F.array_append(done, x))
    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    added = chosen.groupBy("key").agg(best.alias("best")).select("key", F.aggregate(F.transform("best", lambda b: F.struct(b["kind"].alias("kind"), b["start"].alias("start"), b["end"].alias("end"))), none, apart).alias("added"))
    return found.join(added, "key", "left").select("doc_id", "key", "base", F.concat("base", F.coalesce("added", none)).alias("spans"))


def redact(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **how) -> DataFrame:
    """``docs`` with every span of personal data replaced by its kind in
    brackets."""
    found = find(docs, text=text, doc_id=doc_id, **how).select(F.col("key").alias("__key"), F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind")))).alias("__spans")).dropDuplicates(["__key"])
    kinds = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    own = F.col(text)

    def step(acc, s):
        cut = F.concat(acc["out"], F.substring(own, acc["at"] + 1, s["start"] - acc["at"]), F.get(kinds, s["kind"]))
        more = F.struct(acc["out"].alias("out"), F.greatest(acc["at"], -s["back"]).alias("at"))
        return F.when(s["start"] < acc["at"], more).otherwise(F.struct(cut.alias("out"), (-s["back"]).alias("at")))

    done = F.aggregate("__spans", start, step, lambda acc: F.concat(acc["out"], F.substring(own, acc["at"] + 1, F.length(own))))
    keyed = docs.withColumn("__key", F.xxhash64(F.col(doc_id).cast("long"), own)).join(found, "__key")
    return keyed.withColumn(text, F.when(F.size("__spans") > 0, done).otherwise(own)).select(docs.columns)


def report(found: DataFrame) -> DataFrame:
    """Counts of the base spans by kind, their digest, and all spans."""
    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_string(F.col("base")).cast("binary"), 256).alias("base_sha256"), _string(F.col("spans")).alias("spans"))
