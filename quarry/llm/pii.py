"""Personal data by candidates and gradient-boosted trees (native: DataFrame functions and Spark ML).

High-recall generators propose spans, which may overlap: the four base patterns
(email, ip, card, phone), whose checked matches always stay, and looser forms of
each kind. Boosted trees judge the loose candidates by format (length, digits,
separators, letters around them) and context (the characters and the word
before and after). They learn from a bounded sample of the candidates, where a
candidate that holds a checked base match of its kind is positive; features
that would give the check away (Luhn, part values) are left out. A calibrated
threshold (the least score above which candidates of a fold of their own are
right with ``PRECISION``) selects the spans that are added.

Places come from one pass a pattern: matches are set off by two characters that
are no characters (U+FDD0, U+FDD1), the text is split there, and the lengths of
the parts are added up. Patterns use possessive repeats and start only where a
run of their characters starts or the last match ended, so a text of one very
long run takes linear time and no deep recursion; matches are the same.

Defined results: null text counts as empty; rows that repeat are judged each
(a row number of the written candidates, not the id, names a row); a table
without positive or negative candidates adds no spans; an empty table gives no
rows.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import written

KINDS = ("email", "ip", "card", "phone")
TRAINING_ROWS = 40_000
PRECISION = 0.98
TREES = 8
SEED = 7

_OPEN, _SHUT = "﷐", "﷑"
# The base patterns, each with the place where it may start.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Cheap conditions without which a pattern cannot match.
_GATE = {"email": "[A-Za-z0-9._%+-]@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]",
         "phone": r"\+[0-9]"}
# Looser forms of each kind.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,63}+(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9])[0-9]{1,3}+(?:[.,][0-9]{1,3}+){3}+",
    "card": r"(?<![0-9])[0-9](?:[\x20._-]?[0-9]){12,18}+(?![0-9])",
    "phone": r"(?<![0-9])\+?(?:\(?[0-9]{1,4}+\)?[\x20./-]{0,2}+){2,5}+[0-9]{2,4}+(?![0-9])",
}
_LOOSE_GATE = {"email": r"@|\(at\)|\[at\]", "ip": r"[0-9][.,][0-9]", "card": _GATE["card"], "phone": r"[0-9][\x20./)-]{1,3}[0-9(]"}
_SPAN = "array<struct<kind:int,start:int,end:int,text:string>>"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """True if the digits' weighted sum (every second one from the right doubled) ends in 0."""
    backwards = F.split(F.reverse(digits), "")
    values = F.transform(F.filter(backwards, lambda c: c != ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(values, F.lit(0), lambda a, c: a + c) % 10 == 0


def _valid(kind: str, text: Column) -> Column:
    """The base pattern's check of a match."""
    if kind == "ip":
        part = "0*+(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return text.rlike(rf"^(?:{part}\.){{3}}{part}$") | text.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2}|(?<=0))(?:\.|$)){4}$")
    n = F.length(_digits(text))
    if kind == "card":
        return F.when(n.between(13, 19), _luhn(_digits(text))).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _spans(text: Column, kind: str, pattern: str, gate: str) -> Column:
    """All matches with their places, as an array of structs."""
    parts = F.split(F.regexp_replace(text, f"({pattern})", f"{_OPEN}$1{_SHUT}"), f"[{_OPEN}{_SHUT}]")
    start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("match"), F.array().cast(_SPAN).alias("found"))

    def step(state: Column, part: Column) -> Column:
        end = state["at"] + F.length(part)
        span = F.struct(F.lit(KINDS.index(kind)).alias("kind"), state["at"].alias("start"), end.alias("end"), part.alias("text"))
        return F.struct(end.alias("at"), (~state["match"]).alias("match"),
                        F.when(state["match"], F.concat(state["found"], F.array(span).cast(_SPAN))).otherwise(state["found"]).alias("found"))

    return F.when(text.rlike(gate), F.aggregate(parts, start, step, lambda s: s["found"])).otherwise(F.array().cast(_SPAN))


def _base(text: Column, kind: str) -> Column:
    """The matches of a base pattern that pass its check."""
    return F.filter(_spans(text, kind, BASE[kind], _GATE[kind]), lambda s: _valid(kind, s["text"]))


def _plain(text: Column) -> Column:
    """The text with its own U+FDD0 and U+FDD1 made U+FFFD (as long, and in no pattern)."""
    text = F.coalesce(text, F.lit(""))
    return F.when(text.contains(_OPEN) | text.contains(_SHUT), F.translate(text, _OPEN + _SHUT, "��")).otherwise(text)


def _string(spans: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


# Format and context features of a candidate with columns text, left, right.
FEATURES = {
    "kind": lambda: F.col("kind"),
    "length": lambda: F.length("text"),
    "digits": lambda: F.length(_digits(F.col("text"))),
    "groups": lambda: F.size(F.split("text", "[^0-9A-Za-z]+")),
    "first_group": lambda: F.length(F.regexp_extract("text", "^[^0-9]*([0-9]*)", 1)),
    "last_group": lambda: F.length(F.regexp_extract("text", "([0-9]*)$", 1)),
    "dots": lambda: F.length(F.regexp_replace("text", "[^.]", "")),
    "blanks": lambda: F.length(F.regexp_replace("text", "[^ ]", "")),
    "dashes": lambda: F.length(F.regexp_replace("text", "[^-]", "")),
    "brackets": lambda: F.length(F.regexp_replace("text", r"[^()\[\]]", "")),
    "plus": lambda: F.col("text").startswith("+").cast("int"),
    "letter_before": lambda: F.col("left").rlike(r"[A-Za-z_=\"'#/]$").cast("int"),
    "blank_before": lambda: F.col("left").rlike(r"(^|\s)$").cast("int"),
    "letter_after": lambda: F.col("right").rlike(r"^[A-Za-z_=\"'#/]").cast("int"),
    "blank_after": lambda: F.col("right").rlike(r"^([\s.,;:!?]|$)").cast("int"),
    "named_before": lambda: F.lower("left").rlike(r"(tel|phone|call|fax|mobile|mail|contact|card|visa|ip|host|server)\W{0,3}$").cast("int"),
    "code_before": lambda: F.lower("left").rlike(r"(token|key|id|isbn|ref|hash|no|order|version|v)\W{0,4}$").cast("int"),
    "capital_before": lambda: F.col("left").rlike(r"\b[A-Z][a-z]*\W*$").cast("int"),
}


def _added(candidates: DataFrame, precision: float, training_rows: int) -> DataFrame | None:
    """Of candidates (uid, kind, start, end, text, left, right, base, free), the
    free ones that the trees select; None if there is nothing to learn from."""
    rows = candidates.select("uid", "kind", "start", "end", "free", F.col("base").cast("double").alias("label"),
                             F.pmod(F.xxhash64("text", "left"), F.lit(4)).alias("fold"),
                             *[make().cast("double").alias(f"f_{n}") for n, make in FEATURES.items()])
    features = VectorAssembler(inputCols=[f"f_{n}" for n in FEATURES], outputCol="features").transform(rows)
    sample, seen = written(
        features.where("fold < 3").orderBy(F.xxhash64("uid", "kind", "start")).limit(training_rows).select("features", "label"),
        "pii", good=F.sum("label"))
    if not seen["rows"] or not seen["good"] or seen["good"] == seen["rows"]:
        return None
    trees = GBTClassifier(maxIter=TREES, maxDepth=4, stepSize=0.3, seed=SEED, subsamplingRate=1.0).fit(sample)
    scored = trees.transform(features).withColumn("score", F.round(vector_to_array("probability")[1], 3))
    # calibration: by score, the share of right candidates at this score and above (at most 1,001 rows)
    steps = (scored.where("fold = 3").groupBy("score").agg(F.sum("label").alias("good"), F.count("*").alias("n"))
             .orderBy(F.desc("score")).collect())
    least, good, n = None, 0.0, 0
    for r in steps:
        good, n = good + r["good"], n + r["n"]
        if good >= precision * n:
            least = r["score"]
    if least is None:
        return None
    return scored.where(F.col("free") & (F.col("score") >= least)).select("uid", "kind", "start", "end")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", precision: float = PRECISION,
             training_rows: int = TRAINING_ROWS) -> DataFrame:
    """doc_id, base and spans (arrays of kind number, start, end; sorted) for each row."""
    text = _plain(docs[text_col].cast("string"))
    slim = docs.select(docs[id_col].alias("doc_id"), text.alias("text"))
    base = F.concat(*[_base(F.col("text"), k) for k in KINDS])
    loose = F.concat(*[_spans(F.col("text"), k, LOOSE[k], _LOOSE_GATE[k]) for k in KINDS])
    narrow = "struct<kind:int,start:int,end:int>"
    found = slim.select("doc_id", base.alias("base"), loose.alias("loose"), "text")
    candidate = F.transform("loose", lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["text"].alias("text"),
        F.substring("text", F.greatest(s["start"] - 23, F.lit(1)), F.least(s["start"], F.lit(24))).alias("left"),
        F.substring("text", s["end"] + 1, F.lit(8)).alias("right"),
        F.exists("base", lambda x: (x["kind"] == s["kind"]) & (x["start"] < s["end"]) & (s["start"] < x["end"])).alias("base"),
        (~F.exists("base", lambda x: (x["start"] < s["end"]) & (s["start"] < x["end"]))).alias("free")))
    rows, _ = written(found.select("doc_id", F.transform("base", lambda s: F.struct(s["kind"], s["start"], s["end"]))
                                   .cast(f"array<{narrow}>").alias("base"), candidate.alias("loose"))
                      .withColumn("uid", F.monotonically_increasing_id()), "pii")
    added = _added(rows.select("uid", F.inline("loose")), precision, training_rows)
    if added is None:
        return rows.select("doc_id", "base", F.col("base").alias("spans"))
    more = added.groupBy("uid").agg(F.collect_list(F.struct("kind", "start", "end")).cast(f"array<{narrow}>").alias("more"))
    spans = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("more", F.array().cast(f"array<{narrow}>")))))
    return rows.select("uid", "doc_id", "base").join(more, "uid", "left").select("doc_id", "base", spans.alias("spans"))


def pii_digest(found: DataFrame) -> DataFrame:
    """The contract's columns of ``find_pii``'s rows."""
    def n(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[n(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
                        F.sha2(_string(F.col("base")), 256).alias("base_sha256"), _string(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[PII]") -> DataFrame:
    """``docs`` with the spans of unique ids replaced by ``mark`` (overlapping spans as one)."""
    spans = found.select(F.col("doc_id").alias("_id"), F.sort_array(F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end")))).alias("_spans"))
    text = F.col("_text")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(state: Column, s: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        new = F.when((s["start"] < state["at"]) & (s["end"] > state["at"]), state["out"]) \
            .when(s["end"] <= state["at"], state["out"]).otherwise(F.concat(state["out"], gap, F.lit(mark)))
        return F.struct(new.alias("out"), F.greatest(state["at"], s["end"]).alias("at"))

    cut = F.aggregate("_spans", start, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    joined = docs.withColumn("_text", F.coalesce(docs[text_col], F.lit(""))).join(spans, docs[id_col] == F.col("_id"), "left")
    return joined.withColumn(text_col, F.when(F.size("_spans") > 0, cut).otherwise(F.col(text_col))).select(*docs.columns)
