"""Mixing sources to target weights by entropy balancing.

Among all document rates between 0 and ``most`` whose words meet each source's target and whose
sum keeps the mean length of its documents, the one nearest to the base rate in relative entropy
is wanted. The convex dual has two variables a source, and its solution tilts the rates
exponentially: ``rate = most * q e^(a + b z) / (1 - q + q e^(a + b z))`` with ``z`` the length in
units of the source's mean. Newton steps run as Spark jobs over the counts of documents by source
and length, which is all that the dual depends on. Rates are then rounded into whole copies, from
long documents to short ones, carrying the words that rounding gains or loses.

Cases: a null text has no words; documents without words are taken zero times, and a source of
only such documents has target 0. A null source is a source of its own, last in order. Rows may
repeat; equal rows are told apart by their place in a hash order, and get equal copies up to one.
An empty table gives an empty result. Columns of other names are ignored.

The table of sources is sorted in one task: its rows are sources, not documents.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordloom.llm.common import staged, table

WORD = r"[^\x20\x09-\x0D]+"
SHARES = (3.0, 1.0, 2.0)
BUDGET = 1.5  # of all words
MOST = 2.0  # times that a document or a source may be taken
STEPS = 12
#: Documents of one source and length whose last copies are dealt out in one sorted group.
GROUP = 4096


def sized(df: DataFrame, id_col: str, text_col: str, source_col: str, extra: list[str] = ()) -> DataFrame:
    words = F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(WORD)), F.lit(0)).cast("long")
    name = F.col(f"`{source_col}`").cast("string")
    key = F.when(name.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), name))  # sorts by code point, null last
    return df.select(F.col(f"`{id_col}`").alias("id"), key.alias("source_key"), words.alias("size"), *extra)


def targets(bins: DataFrame, shares=SHARES, budget: float = BUDGET, most: float = MOST) -> DataFrame:
    """source_key, source_size, docs, target. Shares repeat along the sorted sources; what a full
    source can't take goes to the others by share. Sources fill up in the order of most * size / share,
    so one pass of running sums finds all that are full."""
    rows = bins.groupBy("source_key").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size"), F.sum("docs").alias("docs"))
    by_name = Window.orderBy("source_key")
    share = F.element_at(F.array(*map(F.lit, shares)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(shares))) + 1).cast("int"))
    everything = Window.partitionBy()
    rows = rows.withColumn("share", share).withColumn("room", F.col("source_size") * F.lit(most)).withColumn("wanted", F.sum("source_size").over(everything) * F.lit(budget))
    before = Window.orderBy(F.col("room") / F.col("share"), "source_key").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("wanted") - F.coalesce(F.sum("room").over(before), F.lit(0.0))
    rest = F.sum("share").over(everything) - F.coalesce(F.sum("share").over(before), F.lit(0.0))
    rows = rows.withColumn("level", left / rest).withColumn("full", F.col("room") <= F.col("level") * F.col("share"))
    level = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)  # at the first that isn't full; it falls from there
    target = F.when(F.col("full"), F.col("room")).otherwise(F.col("share") * level)
    return rows.select("source_key", "source_size", "docs", target.alias("target"))


def _rate(most: float):
    return F.lit(most) / (F.lit(1.0) + F.exp(-(F.col("a") + F.col("b") * F.col("z"))))


def duals(bins: DataFrame, goals: DataFrame, most: float = MOST, steps: int = STEPS) -> DataFrame:
    """Newton steps from zero; every step reads the counts once and keeps two numbers a source."""
    mean = F.greatest(F.col("source_size") / F.col("docs"), F.lit(1e-9))
    goals = goals.withColumn("mean", mean).withColumn("share", F.least(F.col("target") / F.greatest(F.col("source_size"), F.lit(1)), F.lit(most)))
    state = goals.select("source_key", "mean", "docs", "share", F.lit(0.0).alias("a"), F.lit(0.0).alias("b"))
    for step in range(steps):
        at = bins.join(state.withColumnRenamed("docs", "n"), "source_key").withColumn("z", F.col("size") / F.col("mean"))
        at = at.withColumn("r", _rate(most)).withColumn("v", F.col("r") * (F.lit(1.0) - F.col("r") / F.lit(most)))
        part = F.col("docs") / F.col("n")  # moments per document
        sums = at.groupBy("source_key").agg(
            F.sum(part * (F.col("r") - F.col("share"))).alias("g0"),
            F.sum(part * (F.col("r") - F.col("share")) * F.col("z")).alias("g1"),
            F.sum(part * F.col("v")).alias("h0"),
            F.sum(part * F.col("v") * F.col("z")).alias("h1"),
            F.sum(part * F.col("v") * F.col("z") * F.col("z")).alias("h2"),
        )
        h0, h2 = F.col("h0") + F.lit(1e-9), F.col("h2") + F.lit(1e-9)
        det = h0 * h2 - F.col("h1") * F.col("h1")
        bound = lambda x: F.greatest(F.least(x, F.lit(4.0)), F.lit(-4.0))  # noqa: E731  damped
        da = bound((h2 * F.col("g0") - F.col("h1") * F.col("g1")) / det)
        db = bound((h0 * F.col("g1") - F.col("h1") * F.col("g0")) / det)
        state = state.join(sums, "source_key").select("source_key", "mean", "docs", "share", (F.col("a") - da).alias("a"), (F.col("b") - db).alias("b"))
        if step % 4 == 3 or step == steps - 1:
            state = staged(state)
    return state.select("source_key", "mean", F.round("a", 9).alias("a"), F.round("b", 9).alias("b"))


def _round_source(rows: pd.DataFrame) -> pd.DataFrame:
    """Copies of each length of one source: one row per distinct length, longest first."""
    rows = rows.sort_values("size", ascending=False)
    carry, copies, target = 0.0, [], float(rows["target"].iloc[0])
    full = target >= float(rows["room"].iloc[0])
    for size, docs, rate, most in zip(rows["size"], rows["docs"], rows["rate"], rows["most"]):
        if size == 0:
            copies.append(0)
        elif full:
            copies.append(int(most) * docs)
        else:
            carry += size * docs * rate
            n = min(max(round(carry / size), 0), int(most) * docs)
            carry -= n * size
            copies.append(n)
    return pd.DataFrame({"source_key": rows["source_key"], "size": rows["size"], "n": rows["docs"], "copies": copies})


def mixed(rows: DataFrame, most: float = MOST, ties: tuple[str, ...] = (), **goal) -> DataFrame:
    """``rows`` of id, source_key, size and any others; adds source_size, target, copies.

    Columns in ``ties`` order rows of equal ids.
    """
    bins = staged(rows.groupBy("source_key", "size").agg(F.count(F.lit(1)).alias("docs")))
    goals = staged(targets(bins, most=most, **goal))
    tilt = duals(bins, goals, most)
    joined = bins.join(tilt, "source_key").join(goals.select("source_key", "target", "source_size"), "source_key")
    rates = joined.withColumn("z", F.col("size") / F.col("mean")).select(
        "source_key", "size", "docs", "target", (F.col("source_size") * F.lit(most)).alias("room"), F.round(_rate(most), 7).alias("rate"), F.lit(most).alias("most")
    )
    plan = staged(rates.groupBy("source_key").applyInPandas(_round_source, "source_key string, size long, n long, copies long"))
    # a length with very many documents is dealt out in groups of about GROUP of them
    each = rows.join(plan, ["source_key", "size"])
    groups = F.ceil(F.col("n") / F.lit(GROUP))
    h = F.xxhash64("id")
    each = each.withColumn("group", F.pmod(h, groups)).withColumn("h", F.xxhash64("id", F.lit(7)))
    part = Window.partitionBy("source_key", "size", "group")
    rank = F.row_number().over(part.orderBy("h", "id", *ties))
    here = F.count(F.lit(1)).over(part)
    extra = F.col("copies") % F.col("n")
    # a group takes its share of the last copies; the golden ratio evens out what rounding leaves
    golden = F.col("group") * F.lit(0.6180339887498949)
    share = F.floor(F.col("here") * F.col("extra") / F.col("n") + (golden - F.floor(golden)))
    share = F.when(F.col("n") <= GROUP, F.col("extra")).otherwise(share)
    each = each.withColumn("rank", rank).withColumn("here", here).withColumn("extra", extra)
    copies = F.floor(F.col("copies") / F.col("n")) + F.when(F.col("rank") <= share, 1).otherwise(0)
    keep = [c for c in rows.columns]
    return each.select(*keep, copies.cast("long").alias("copies")).join(goals.select("source_key", "source_size", "target"), "source_key")


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **goal) -> DataFrame:
    """Per document: id, size, source_size, target, copies, taken (words)."""
    got = mixed(staged(sized(df, id_col, text_col, source_col)), **goal)
    return got.select("id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **goal) -> DataFrame:
    """The rows of the mix, each as often as it is taken, with the columns as they came.

    Every row is kept whole in a written table under a number of its own, by which copies are
    found and given, so rows need no unique id.
    """
    whole = F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")
    rows = staged(sized(df, id_col, text_col, source_col, [whole, F.monotonically_increasing_id().alias("key")]))
    found = mixed(rows.select("id", "source_key", "size", "key"), ties=("key",), **goal).where("copies > 0").select("key", "copies")
    joined = rows.select("key", "row").join(found, "key")
    return joined.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("_")).select("row.*")


def op1(spark, sf_dir: str) -> DataFrame:
    got = mix(table(spark, sf_dir, "documents"))
    return got.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "copies")
