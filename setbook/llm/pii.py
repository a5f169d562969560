"""Personal data: candidate generators and gradient-boosted selection.

1. Generators propose spans, overlapping across kinds, with one pass over
   each whole text.  Four of them (email, ip, card, phone) carry a base rule
   whose matches are always redacted; two wide ones (number, secret) propose
   whatever looks like an identifier.
2. Every candidate becomes a row with its offsets (code points) and format
   and context features.
3. Boosted trees learn from weak labels: a candidate is positive if it
   passes a base rule's check (ranges, Luhn, digit counts) or a key word
   such as ``password=`` stands before it; the key words themselves are not
   features.  They are fitted on about ``train_rows`` candidates, at most
   half of all, drawn by a hash of doc_id, text, kind and start.
4. Every wide candidate is scored, and the threshold of each wide kind is
   calibrated on all of them that the trees were not fitted on: the lowest
   score from which on the precision is at least ``precision``.  Wide
   candidates that reach it and touch no base span are redacted too.

All steps are DataFrame functions; the trees are Spark ML's.  The patterns
are written so that the regex engine works by character classes only: no
group is repeated, so neither the stack nor the time grows beyond the
length of the text.  Separators that a pattern must not cross are first
replaced one for one by a sentinel.

Defined results: a null text counts as empty; an empty text has no spans
and the digest of the empty string; every row of the input gets a row, also
repeated ones; an empty table gives an empty one.  With candidates of one
class only, nothing is learned and only base spans are returned.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, stored, whole_text

# fixed values: the kinds in the order of the contract, then the added ones
KINDS = ("email", "ip", "card", "phone", "number", "secret")
BASE = 4

_CUT = "\u0001"                      # stands for a separator that ends a match
_LOCAL = r"A-Za-z0-9._%+\-" + _CUT   # a cut dot still belongs to a local part
_PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9][0-9\x20-]+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "number": r"(?<![0-9A-Za-z])[0-9][0-9\x20()./-]{5,}[0-9]",
    "secret": r"(?<![A-Za-z0-9_])(?=[A-Za-z_]*+[0-9])[A-Za-z0-9_]{16,}+",
}
# every character that a match can hold
_MARKS = string.ascii_letters + string.digits + "._%+-@ ()/" + _CUT
# fixed values: words that announce a secret or an identifier
_KEY_WORDS = r"(?i)(pass(word|wd)?|token|secret|api[_-]?key|key|ssn|iban|account)[\"']?\s*[:=]?\s*[\"']?$"

FEATURES = ("length", "digits", "letters", "seps", "groups", "upper", "switches", "distinct",
            "after_space", "before_space", "prev_digit", "prev_equals", "prev_quote", "next_quote", "wide_kind")


def _source(kind: str, text: Column) -> Column:
    """The text in which a kind's pattern is looked for, of the same length."""
    if kind == "email":
        return F.regexp_replace(text, r"\.(?![A-Za-z0-9-])|(?<![A-Za-z0-9-])\.", _CUT)
    if kind == "card":
        return F.regexp_replace(text, r"(?<![0-9])[\x20-]|[\x20-](?![0-9])", _CUT)
    return text


def _proposals(k: int, text: Column) -> Column:
    """Array of a kind's matches with the length and the ends of the texts between them."""
    src, pattern = _source(KINDS[k], text), F.lit(_PATTERNS[KINDS[k]])
    found = F.regexp_extract_all(src, pattern, F.lit(0))
    gaps = F.split(src, _PATTERNS[KINDS[k]], -1)
    return F.transform(
        F.arrays_zip(found.alias("m"), F.slice(gaps, F.lit(1), F.size(found)).alias("g"),
                     F.slice(gaps, F.lit(2), F.size(found)).alias("h")),
        lambda x, i: F.struct(
            F.lit(k).alias("kind"), i.alias("i"), F.length(x["m"]).alias("len"),
            F.length(x["g"]).alias("gap"), x["m"].alias("m"),
            F.substring(x["g"], -24, 24).alias("prev"), F.substring(x["h"], 1, 2).alias("next")))


def _with_gate(text: Column) -> Column:
    """All proposals of a text; texts without digit and ``@`` cannot have any."""
    marks = {"email": "@", "phone": "+"}
    parts = []
    for k, kind in enumerate(KINDS):
        own = _proposals(k, text)
        gate = text.contains(marks[kind]) if kind in marks else text.rlike(
            {"ip": r"[0-9]\.[0-9]", "card": r"[0-9][0-9\x20-]{11}", "number": r"[0-9][0-9\x20()./-]{5}",
             "secret": r"[A-Za-z0-9_]{16}"}[kind])
        none = F.array().cast("array<struct<kind:int,i:int,len:int,gap:int,m:string,prev:string,next:string>>")
        parts.append(F.when(gate, own).otherwise(none))
    return F.when(text.rlike("[0-9@]"), F.concat(*parts))


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)
    value = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)), F.lit(0),
        lambda acc, i: acc + F.when(i % 2 == 1, F.substr(back, i, F.lit(1)).cast("int")).otherwise(
            F.element_at(F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
                         F.substr(back, i, F.lit(1)).cast("int") + 1)))
    return value % 10 == 0


def _passes(kind: Column, m: Column) -> Column:
    """Whether a match of a base kind meets its rule."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    n = F.length(digits)
    octet = r"0*+(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
    return (F.when(kind == 0, True)
            .when(kind == 1, m.rlike(rf"^{octet}\.{octet}\.{octet}\.{octet}$"))
            .when(kind == 2, F.when(n.between(13, 19), _luhn(digits)).otherwise(False))
            .when(kind == 3, n.between(9, 15))
            .otherwise(False))


def candidates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): every input row as (row, doc_id), and every candidate with
    row, key (hash of doc_id and text), kind, start, end, m, prev, next and
    ``base`` (meets its base rule)."""
    text = F.translate(whole_text(), _CUT, "\u0002")
    found = stored(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                               F.xxhash64("doc_id", whole_text()).alias("key"),
                               _with_gate(text).alias("found")), "pii")
    w = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    spans = (found.select("row", "key", F.inline("found"))
             .withColumn("end", F.sum(F.col("gap") + F.col("len")).over(w))
             .withColumn("start", F.col("end") - F.col("len"))
             .withColumn("base", _passes(F.col("kind"), F.col("m"))))
    return found.select("row", "doc_id"), spans.select(
        "row", "key", "kind", "start", "end", "m", "prev", "next", "base")


def _features(spans: DataFrame) -> DataFrame:
    m, prev, nxt = F.col("m"), F.col("prev"), F.col("next")
    count = lambda cls: F.length(m) - F.length(F.regexp_replace(m, cls, ""))
    once = lambda pattern: F.length(F.regexp_replace(m, pattern, _CUT))
    runs = lambda pattern: once(pattern) - F.length(F.regexp_replace(m, pattern, ""))
    between = r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])"
    cols = {
        "length": F.length(m), "digits": count("[0-9]"), "letters": count("[A-Za-z]"),
        "seps": count("[^A-Za-z0-9]"), "upper": count("[A-Z]"),
        "groups": runs("[^A-Za-z0-9]+") + 1,
        "switches": once(between) - F.length(m) + 1,
        "distinct": F.size(F.filter(F.array(*[F.lit(c) for c in _MARKS]), lambda c: m.contains(c))),
        "after_space": prev.rlike(r"\s$"), "before_space": nxt.rlike(r"^\s"),
        "prev_digit": prev.rlike("[0-9]"), "prev_equals": prev.rlike(r"[=:]\s*[\"']?$"),
        "prev_quote": prev.rlike("[\"']$"), "next_quote": nxt.rlike("^[\"']"),
        "wide_kind": F.col("kind") >= BASE,
    }
    label = F.col("base") | prev.rlike(_KEY_WORDS)
    return spans.select("row", "key", "kind", "start", "end", label.cast("double").alias("label"),
                        *[cols[c].cast("double").alias(c) for c in FEATURES])


def _assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features")


def _score(model: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    return model.transform(_assembler().transform(rows)).withColumn(
        "score", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def _draw() -> Column:
    """A number below 1 << 40 for each candidate; it does not depend on how the table is dealt."""
    return F.pmod(F.xxhash64("key", "kind", "start"), F.lit(1 << 40))


def fit(spans: DataFrame, train_rows: int = 20_000) -> tuple[GBTClassificationModel | None, int]:
    """(model, limit): trees fitted on the candidates whose draw is below ``limit``,
    about ``train_rows`` and at most half of all; model None if there is nothing to learn."""
    n = spans.count()
    if not n:
        return None, 0
    limit = int((1 << 40) * min(0.5, train_rows / n)) + 1
    order = ("key", "kind", "start")
    fitting = stored(_features(spans.where(_draw() < limit)).repartition(8, *order)
                     .sortWithinPartitions(*order), "pii-train")
    if fitting.agg(F.count_distinct("label")).first()[0] < 2:
        return None, limit
    return GBTClassifier(maxIter=12, maxDepth=4, stepSize=0.3, seed=7, labelCol="label").fit(
        _assembler().transform(fitting)), limit


def thresholds_of(held: DataFrame, precision: float = 0.95) -> dict[int, float]:
    """By kind, the lowest score from which on the precision of ``held`` (kind, score, label) is reached."""
    bins = (held.groupBy("kind", F.floor(F.col("score") * 100).alias("bin"))
            .agg(F.sum("label").alias("pos"), F.count(F.lit(1)).alias("all")).collect())   # 101 bins a kind at most
    thresholds = {}
    for kind in {b["kind"] for b in bins}:
        pos = total = 0
        for b in sorted((b for b in bins if b["kind"] == kind), key=lambda b: -b["bin"]):
            pos, total = pos + b["pos"], total + b["all"]
            if total and pos / total >= precision:
                thresholds[kind] = b["bin"] / 100
    return thresholds


def _added(spans: DataFrame, train_rows: int, precision: float) -> DataFrame | None:
    model, limit = fit(spans, train_rows)
    if model is None:
        return None
    wide = _score(model, _features(spans.where(F.col("kind") >= BASE)))
    scored = stored(wide.select("row", "kind", "start", "end", "label", "score", (_draw() < limit).alias("fitted")),
                    "pii-scores")
    thresholds = thresholds_of(scored.where(~F.col("fitted")), precision)
    if not thresholds:
        return None
    enough = F.lit(False)
    for kind, t in thresholds.items():
        enough = enough | ((F.col("kind") == kind) & (F.col("score") >= t))
    both = scored.where(enough).select("row", "kind", "start", "end").unionByName(
        spans.where("base").select("row", "kind", "start", "end"))
    is_base = F.col("kind") < BASE
    ahead = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    clear = (both.withColumn("left", F.max(F.when(is_base, F.col("end"))).over(ahead))
             .withColumn("right", F.min(F.when(is_base, F.col("start"))).over(behind)))
    return clear.where(~is_base & (F.coalesce("left", F.lit(0)) <= F.col("start"))
                       & (F.coalesce("right", F.col("end")) >= F.col("end"))).select("row", "kind", "start", "end")


def find_personal_data(docs: DataFrame, train_rows: int = 20_000, precision: float = 0.95) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id and ``redactions``, an
    array of (kind number, start, end) in that order; kinds as in ``KINDS``."""
    rows, spans = candidates(docs.select("doc_id", "text"))
    spans = stored(spans, "pii-spans")
    chosen = spans.where("base").select("row", "kind", "start", "end")
    added = _added(spans, train_rows, precision)
    if added is not None:
        chosen = chosen.unionByName(added)
    lists = chosen.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("kind", "start", "end"))).alias("found"))
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    return rows.join(lists, "row", "left").select("doc_id", F.coalesce("found", none).alias("redactions"))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: the personal data of every document, counted and listed."""
    found = find_personal_data(documents(spark, sf_dir))
    spans = F.col("redactions")
    counts = [_count(spans, k).alias(f"n_{KINDS[k]}") for k in range(BASE)]
    return found.select("doc_id", *counts,
                        F.sha2(_joined(F.filter(spans, lambda s: s["kind"] < BASE)), 256).alias("base_sha256"),
                        _joined(spans).alias("spans"), F.size(spans).cast("long").alias("n_spans"))
