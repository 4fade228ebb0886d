"""URL filter: ratio of character language models for accepted and rejected URLs.

Rules (host and path prefix, longest first) judge what they fit. Their verdicts are
the training data: one model is learned from all accepted, one from all rejected
URLs, each over host and path. A URL that no rule fits gets the log-likelihood
difference of the models per character, against a cut calibrated on the same verdicts.

Everything is row by row but the counting of cells, which is combined map-side into
a fixed number of groups: no shuffle of URLs, so no key can be hot.

Defined cases: a NULL url, or one without ``://``, has an empty host and path, fits
no rule, scores 0 and takes the verdict of that score; repeated rows are judged alike;
without verdicts of both kinds (in both halves of the samples) the cut is 0, and all
scores are where no verdict trains a model, so everything is allowed then;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm import markov

#: Symbols of the models; everything else counts as one more.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789./-_"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    text: str  # host, then the path prefix from its first slash

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, F.lit("://"))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def fitting_rule(host: Column, path: Column, rules: list[Rule], attribute: str) -> Column:
    """``text`` or ``verdict`` of the longest rule that fits, else NULL."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        same = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
        fits = same & F.startswith(path, F.lit(rule.path))
        found = F.when(fits, F.lit(getattr(rule, attribute))).otherwise(found)
    return found


def judge_urls(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for every page."""
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    ruled = parsed.select(
        "*",
        fitting_rule(F.col("host"), F.col("path"), rules, "text").alias("rule"),
        fitting_rule(F.col("host"), F.col("path"), rules, "verdict").alias("ruled"),
        markov.cells(F.lower(F.concat("host", "path")), ALPHABET).alias("cells"),
    )
    samples = ruled.where("ruled IS NOT NULL").select("cells", (F.col("ruled") == "allow").alias("positive"))
    models, cut = markov.learn(samples, ALPHABET)
    judged = markov.with_score(ruled, models)
    own = F.when(F.col("score") >= cut.scalar(), "allow").otherwise("block")
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "score"
    )
