"""Secret scans: patterns, and character Markov models for random strings.

Base spans come from three patterns (leftmost, not overlapping within a kind). The
values they find are the labelled samples of random strings; other tokens of twelve
characters or more are the samples of ordinary identifiers. Markov models are
learned from both, over the whole corpus (a token is rated by models of the half of
the samples that it is not in), and a token of ``MIN_TOKEN`` characters or
more that overlaps no base span becomes a further span (kind ``model``) where the
log-likelihood ratio per character reaches a cut calibrated on the samples.

Texts are read once; what is found is stored, and learning and scoring work on that.
Rows are never shuffled: the counts of cells are combined map-side into a number of
groups that the alphabet fixes.

Defined cases: NULL text is as empty: no spans; repeated rows are scanned alike;
positions count code points, ends are exclusive; without samples of both kinds in
both halves there are no further spans; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm import markov
from weir.llm.common import let, stored

ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # runs are maximal, so short ones may be left out at once
TOKEN = r"[A-Za-z0-9+/_=-]{12,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
KINDS = ("assign", "access", "hex", "model")
MIN_VALUE, MIN_ACCESS, MIN_TOKEN = 6, 20, 20


def _matches(text: Column, pattern: str, kind: int, value_group: int = 0) -> Column:
    """array<struct<start, kind, end, value>> of all matches. Texts without a match
    are told by one search; in the others, the gaps between the matches give the
    positions."""
    regexp = F.lit(pattern)
    whole = F.regexp_extract_all(text, regexp, F.lit(0))
    parts = F.struct(
        F.transform(F.split(text, pattern, -1), F.length).alias("gaps"),
        whole.alias("whole"),
        (F.regexp_extract_all(text, regexp, F.lit(value_group)) if value_group else F.lit(None)).alias("group"),
    )
    none = F.array().cast("array<bigint>")
    begin = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("starts"))

    def step(p, acc, i):
        start = acc["at"] + F.get(p["gaps"], i)
        return F.struct(
            (start + F.length(F.get(p["whole"], i))).alias("at"), F.concat(acc["starts"], F.array(start)).alias("starts")
        )

    def spans_of(p):
        every = F.sequence(F.lit(0), F.size(p["whole"]) - 1)
        starts = F.aggregate(every, begin, lambda acc, i: step(p, acc, i), lambda acc: acc["starts"])
        return F.transform(
            starts,
            lambda s, i: F.struct(
                s.alias("start"),
                F.lit(kind).alias("kind"),
                (s + F.length(F.get(p["whole"], i))).alias("end"),
                F.get(p["group" if value_group else "whole"], i).alias("value"),
            ),
        )

    spans = let(parts, spans_of)
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,value:string>>")
    return F.when(text.rlike(pattern), spans).otherwise(empty)


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, base, tokens): base spans by start and kind, and long tokens apart from them."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select(
        "doc_id",
        F.filter(_matches(text, ASSIGN, 0, 2), lambda m: F.length(m["value"]) >= MIN_VALUE).alias("assign"),
        F.filter(_matches(text, ACCESS, 1), lambda m: m["end"] - m["start"] >= MIN_ACCESS).alias("access"),
        _matches(text, HEX, 2).alias("hex"),
        _matches(text, TOKEN, 3).alias("tokens"),
    )
    based = found.withColumn("base", F.array_sort(F.concat("assign", "access", "hex")))

    def apart(token):
        return ~F.exists("base", lambda b: (b["start"] < token["end"]) & (token["start"] < b["end"]))

    free = F.when(F.size("base") == 0, F.col("tokens")).otherwise(F.filter("tokens", apart))
    return based.select("doc_id", "base", free.alias("tokens"))


def _text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    each = F.transform(
        spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(each, ",")


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every document."""
    spark = docs.sparkSession
    found = stored(spark, find(docs), "secret-found")
    samples = found.select(F.explode("base.value").alias("value"), F.lit(True).alias("positive")).unionByName(
        found.select(F.explode("tokens.value").alias("value"), F.lit(False).alias("positive"))
    )
    samples = samples.select(markov.cells(F.col("value"), ALPHABET).alias("cells"), "positive")
    models, cut = markov.learn(samples, ALPHABET, empty_cut=1e9)

    long = F.filter("tokens", lambda t: t["end"] - t["start"] >= MIN_TOKEN)
    held = markov.with_models(found, models).withColumn("__cut", cut.scalar())

    def random(token):
        rated = markov.score(markov.cells(token["value"], ALPHABET), F.col("__even"), F.col("__odd"))
        return rated >= F.col("__cut")

    added = F.filter(long, random)
    spans = held.select(
        "doc_id", "base", F.when(F.size(long) > 0, added).otherwise(F.filter("tokens", lambda t: F.lit(False))).alias("added")
    )

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    return spans.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_text(F.col("base")), 256).alias("base_sha256"),
        _text(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )
