"""Secrets in texts: fixed patterns, and character Markov models for the rest.

Three patterns give the base spans. Two first-order Markov models of characters are trained on
labelled samples from the whole corpus: random strings are the values inside base spans, ordinary
identifiers are long runs of letters outside of them, in a second round without those that the
first takes for random. Random strings draw evenly within a class of characters, so
their model is one of turns between classes, mixed with an even one for alphabets that no sample
shows. Other long tokens that hold a letter, with
or without digits, are secrets where the mean log-likelihood ratio per step exceeds ``RATIO``. Only DataFrame
functions are used; the model is a table of 128 x 128 numbers, whatever the corpus.

Offsets are code points, ends exclusive. Method spans never overlap base spans. Cases: a null or
empty text has no spans; rows may repeat and ids may be null, each row is scanned; without
samples of a kind both models are even and the method adds nothing. Extra columns are ignored,
an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math
import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import staged, table

ASSIGN = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{16,}"  # a maximal run of 20 or more, as a longer match never starts inside a short run
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")
#: A maximal run of 16 or more with a letter; the ordinary sample says nothing on runs without.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{16,}+"
ORDINARY = r"(?<![A-Za-z0-9+/_.=-])[A-Za-z]{16,}+(?![A-Za-z0-9+/_=-])"
CLASSES = (string.ascii_lowercase, string.ascii_uppercase, string.digits, "+/_.=-")
ALPHABET = "".join(CLASSES)
RATIO = 0.0  # nats a step
EVEN = 0.3  # share of steps in random strings that go to any character
ESCAPE = 0.05  # share of steps in ordinary identifiers that may go to any character
BACKOFF = 10.0  # weight of how often a character occurs at all, in counts of the pair's row
_LIST = 1024  # spans that are put together at a time
_SPAN = "array<struct<start:int,rank:int,end:int,value:string>>"


def _spans(text: F.Column, pattern: str, rank: int, keep=None) -> F.Column:
    """All matches as (start, rank, end, value); the text between matches gives the places.

    Arrays grow by copying, so spans are put into lists of ``_LIST`` and the lists joined at the
    end: the work is in proportion to the matches.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.split(text, pattern, -1)
    none = F.array().cast(_SPAN)

    def step(acc, pair):
        start = acc["at"] + F.length(pair["before"])
        end = start + F.length(pair["match"])
        one = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), pair["match"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    def add_list(acc, pairs):
        one = F.aggregate(pairs, F.struct(acc["at"].alias("at"), none.alias("out")), step)
        return F.struct(one["at"].alias("at"), F.concat(acc["lists"], F.array(one["out"])).alias("lists"))

    pairs = F.zip_with(F.slice(parts, 1, F.size(found)), found, lambda p, m: F.struct(p.alias("before"), m.alias("match")))
    lists = F.transform(F.sequence(F.lit(1), F.size(found), F.lit(_LIST)), lambda i: F.slice(pairs, i, F.lit(_LIST)))
    fresh = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("lists"))
    spans = F.flatten(F.aggregate(lists, fresh, add_list, lambda acc: acc["lists"]))
    if keep is not None:
        spans = F.filter(spans, keep)
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(_SPAN))


def _assigned(match: F.Column) -> F.Column:
    return F.regexp_extract(match, ASSIGN, 2)


def scanned(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One pass over the texts: base spans by kind, candidates, ordinary long words."""
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    text = F.col("text")
    return rows.select(
        "id",
        _spans(text, ASSIGN, 0, lambda s: F.length(_assigned(s["value"])) >= 6).alias("assign"),
        _spans(text, ACCESS, 1).alias("access"),
        _spans(text, HEX, 2).alias("hex"),
        _spans(text, CANDIDATE, 3).alias("candidates"),
        _spans(text, ORDINARY, 4).alias("ordinary"),
    )


def _steps(samples: DataFrame, label: str) -> DataFrame:
    steps = F.length("value") - 1
    pair = F.explode(F.zip_with(F.slice("chars", 1, steps), F.slice("chars", 2, steps), lambda a, b: F.concat(a, b)))
    chars = samples.where(F.length("value") >= 2).select("value", F.split("value", "").alias("chars"))
    return chars.select(F.lit(label).alias("label"), pair.alias("pair")).groupBy("label", "pair").agg(F.count(F.lit(1)).alias("n"))


def _free(c: F.Column, *base: str) -> F.Column:
    """Whether a span overlaps none of the base spans.

    Spans of one kind are in order and apart, so the last one of it that starts before ``c`` ends
    is the only one to look at; it is found by halving.
    """

    def apart(kind):
        def halve(acc, _):
            mid = F.shiftright(acc["low"] + acc["high"] + 1, 1)
            before = F.element_at(kind, F.greatest(mid, F.lit(1)))["start"] < c["end"]
            return F.struct(F.when(before, mid).otherwise(acc["low"]).alias("low"), F.when(before, acc["high"]).otherwise(F.greatest(mid - 1, acc["low"])).alias("high"))

        whole = F.struct(F.lit(0).alias("low"), F.size(kind).alias("high"))
        rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(kind) + 1)).cast("int"))
        last = F.aggregate(rounds, whole, halve, lambda acc: acc["low"])
        return F.when(F.size(kind) == 0, True).otherwise(F.when(last == 0, True).otherwise(F.element_at(kind, F.greatest(last, F.lit(1)))["end"] <= c["start"]))

    return functools.reduce(lambda a, b: a & b, (apart(F.col(k)) for k in base))


def _model(numbers: list[float]) -> F.Column:
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<double>")  # a constant of the plan


def _score(value: F.Column, model: F.Column) -> F.Column:
    def step(acc, char):
        code = F.ascii(char)
        more = F.when(acc["last"] < 0, 0.0).otherwise(F.element_at(model, F.greatest(acc["last"], F.lit(0)) * 128 + code + 1))
        return F.struct(code.alias("last"), (acc["total"] + more).alias("total"))

    whole = F.aggregate(F.split(value, ""), F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("total")), step, lambda acc: acc["total"])
    return whole / (F.length(value) - 1)


def ratios(found: DataFrame, first: list[float] | None = None) -> list[float]:
    """Log-likelihood ratio of random to ordinary per pair of characters.

    With ratios of a ``first`` round, samples that these take for random aren't ordinary. At most two counts for each pair of the alphabet reach the driver.
    """
    secret = found.select(F.explode(F.concat(F.transform("assign", lambda s: _assigned(s["value"])), F.transform("access", lambda s: s["value"]), F.transform("hex", lambda s: s["value"]))).alias("value"))
    outside = F.filter("ordinary", lambda c: _free(c, *KINDS[:3]))
    plain = found.select(F.explode(F.transform(outside, lambda s: s["value"])).alias("value"))
    if first is not None:
        plain = plain.where(_score(F.col("value"), _model(first)) <= 0)
    counts = {(r.label, r.pair): r.n for r in _steps(secret, "random").unionByName(_steps(plain, "ordinary")).collect()}
    out = [0.0] * (128 * 128)
    count = lambda label, start, then: sum(counts.get((label, x + y), 0) for x in start for y in then)
    turns = {c: {d: count("random", c, d) + 1 for d in CLASSES} for c in CLASSES}
    alone = {y: count("ordinary", ALPHABET, y) + 1 for y in ALPHABET}
    total = sum(alone.values())
    for c in CLASSES:
        for x in c:
            row = count("ordinary", x, ALPHABET)
            for d in CLASSES:
                drawn = (1 - EVEN) * turns[c][d] / sum(turns[c].values()) / len(d) + EVEN / len(ALPHABET)
                for y in d:
                    seen = (counts.get(("ordinary", x + y), 0) + BACKOFF * alone[y] / total) / (row + BACKOFF)
                    out[ord(x) * 128 + ord(y)] = round(math.log(drawn / ((1 - ESCAPE) * seen + ESCAPE / len(ALPHABET))), 6)
    if not any(k[0] == "random" for k in counts) or not any(k[0] == "ordinary" for k in counts):
        return [0.0] * len(out)
    return out


def spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: float = RATIO) -> DataFrame:
    """Per row: id and ``base`` and ``extra`` as sorted arrays of (start, rank, end, value)."""
    found = staged(scanned(df, id_col, text_col))
    model = _model(ratios(found, ratios(found)))
    rows = found.select("id", F.array_sort(F.concat("assign", "access", "hex")).alias("base"), "candidates", *KINDS[:3], F.size("assign").alias("n_assign"), F.size("access").alias("n_access"), F.size("hex").alias("n_hex"))
    extra = F.filter("candidates", lambda c: _free(c, *KINDS[:3]) & (_score(c["value"], model) > ratio))
    return rows.select("id", "base", extra.alias("extra"), "n_assign", "n_access", "n_hex")


def _written(column: F.Column) -> F.Column:
    kind = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["rank"] + 1)
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", kind(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op9(spark, sf_dir: str) -> DataFrame:
    got = spans(table(spark, sf_dir, "documents"))
    return got.select(
        F.col("id").alias("doc_id"),
        *(F.col(c).cast("long").alias(c) for c in ("n_assign", "n_access", "n_hex")),
        F.sha2(_written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _written(F.array_sort(F.concat("base", "extra"))).alias("spans"),
    )
