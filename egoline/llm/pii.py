"""Personal data: regular expressions propose, checksums confirm, context scores (DataFrame functions only).

Each kind has a pattern that proposes spans, a validator that rejects what
cannot be of that kind (Luhn, mod-97, number ranges, digit counts), a score of
its own and context words that raise the score when they stand within
``CONTEXT`` characters of the span. A span is reported from ``THRESHOLD`` on.
The four base kinds start at the threshold, so no context can remove them.

Positions come from splitting the text by the pattern: the lengths of the gaps
and matches before a span add up to its start, in code points.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from egoline.llm.common import unused

CONTEXT = 40
THRESHOLD = 0.6
BYTE = r"0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: In one run of capitals or of small letters, or printed in groups of four.
IBAN = (r"(?<![A-Za-z0-9])(?:[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}|[a-z]{2}[0-9]{2}[a-z0-9]{11,30}"
        r"|[A-Z]{2}[0-9]{2}(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
#: kind, what a text must match to be searched, pattern, own score, context words, score that they add. The look-behind
#: with \G gives the same leftmost matches as the bare pattern and keeps long runs of such characters linear; possessive
#: repeats, equal here since nothing follows that could take a character back, are matched without recursion.
KINDS = [
    ("email", "@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)++", 0.9, "mail|contact|write", 0.1),
    ("ip", r"[0-9]\.[0-9]", r"(?:\G|(?<![0-9]))[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", 0.6, "address|host|server|ip", 0.2),
    ("card", r"[0-9][\x20-]?[0-9]", r"[0-9]([\x20-]?[0-9])++", 0.8, "card|visa|credit|payment", 0.2),
    ("phone", r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", 0.7, "phone|call|tel|mobile", 0.2),
    ("iban", r"[A-Za-z][A-Za-z][0-9]{2}", IBAN, 0.8, "iban|account|bank|konto|compte|cuenta", 0.2),
    ("ssn", r"[0-9]-[0-9]{2}-[0-9]", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", 0.4, "ssn|social security|security number", 0.4),
]
BASE = ["email", "ip", "card", "phone"]
SPAN = "array<struct<start:int,rank:int,end:int,kind:string,score:double>>"


def valid(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "ip":
        return m.rlike(rf"^{BYTE}(\.{BYTE}){{3}}$")
    if kind == "card":
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "iban":
        plain = F.upper(F.replace(m, F.lit(" "), F.lit("")))
        turned = F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4)))
        value = F.transform(F.split(turned, "(?!^)(?!$)"), lambda c: F.ascii(c) - F.when(c >= "A", 55).otherwise(48))
        return F.aggregate(value, F.lit(0), lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97) == 1
    if kind == "ssn":
        return ~m.rlike("^(000|666|9)") & ~m.rlike("-00-") & ~m.rlike("-0000$")
    return F.lit(True)


def spans_of(t: Column, rank: int) -> Column:
    """Spans of one kind: the matches of a plain left-to-right search that hold."""
    kind, probe, pattern, own, words, more = KINDS[rank]
    gaps, found = F.split(t, pattern, -1), F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
    # the ends of gaps before a match are the only text that context needs
    parts = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("m"),
                         F.slice(gaps, 2, F.size(found)).alias("next"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(acc, p):
        begin = acc["at"] + F.length(p["gap"])
        end = begin + F.length(p["m"])
        around = F.lower(F.concat(F.right(p["gap"], F.lit(CONTEXT)), F.lit(" "), F.left(p["next"], F.lit(CONTEXT))))
        score = F.lit(own) + F.when(around.rlike(rf"(?<![a-z])({words})"), more).otherwise(0.0)
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), score.alias("score"))
        holds = valid(kind, p["m"]) & (score >= THRESHOLD)
        return F.struct(end.alias("at"), F.when(holds, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    return F.when(t.rlike(probe), F.aggregate(parts, start, step, lambda acc: acc["out"])).otherwise(F.array().cast(SPAN))


def with_spans(docs: DataFrame, spans: str, text_col: str = "text") -> DataFrame:
    """``docs`` and a new column ``spans``: all spans by start, then kind as listed."""
    columns, text = docs.columns, unused(docs, "_pii_text")
    docs = docs.withColumn(text, F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    kinds = []
    for k in range(len(KINDS)):
        kinds.append(unused(docs, f"_pii_{k}"))
        docs = docs.withColumn(kinds[-1], spans_of(F.col(text), k))
    return docs.select(*columns, F.array_sort(reduce(F.concat, [F.col(k) for k in kinds])).alias(spans))


def joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and spans per document.

    Null texts are empty and hold no span. Repeated rows are searched one by
    one, texts of any length whole. Columns other than the id and the text are
    ignored, whatever their names. An empty table gives an empty result.
    """
    d = with_spans(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "_spans")
    base = F.filter("_spans", lambda s: s["rank"] < len(BASE))
    count = [F.size(F.filter(F.transform("_spans", lambda s: s["kind"]), F.lit(k).eqNullSafe)).cast("long").alias(f"n_{k}") for k in BASE]
    return d.select("doc_id", *count, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("_spans")).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans become one mark, that of the first.

    Texts without a span, null ones included, stay as they are, and so do all
    other columns, whatever their names.
    """
    spans = unused(docs, "_spans")
    d = with_spans(docs, spans, text_col)
    t = F.col(text_col)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        gap = F.substr(t, acc["at"] + 1, s["start"] - acc["at"])
        fresh = F.concat(acc["out"], gap, F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(s["start"] >= acc["at"], fresh).otherwise(acc["out"]).alias("out"))

    clean = F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substr(t, acc["at"] + 1)))
    return d.withColumn(text_col, F.when(F.size(spans) > 0, clean).otherwise(t)).select(*docs.columns)
