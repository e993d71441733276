"""Near duplicates by ProbMinHash, banding and verification.

The five-word shingles of a text weigh 1 + ln(times they occur). Each shingle is a Poisson
process whose rate is its weight; an arrival lands in one of the registers, and a register keeps
the shingle of its first arrival. Two texts agree in a register with the probability Jaccard
similarity of their weighted shingles. A second set of registers has weights of 1, so that two
texts agree in one with the similarity of their shingle sets, which decides; both sets give
candidates, and register agreement is taken from the second. A shingle stops as soon as its next arrival is later than
the latest first arrival of all registers. Registers in bands give candidates; candidates are
verified by the exact Jaccard similarity of the shingle sets of the whole texts.

Texts with equal shingle sets are one class and go on as one representative. In every band
bucket all members are first verified against the smallest. Where that leaves a bucket in
several components, the best pairs across these, a spanning forest of them, are verified in two
more rounds. Then the bucket's texts meet in tiles of bounded size: texts whose registers agree
enough with one of another component are compared by the shingles that they share, and a tile
gives a spanning forest of its verified links, fewer than its texts. So no link between different
texts is lost to a hub, and neither candidates nor links grow with the square of a group.

Cases: texts without words (null, empty, blank) are a class of their own each. Shorter texts are
one shingle. Rows with equal ids share a class; null ids are never linked and are kept. Extra
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm import textops
from recordloom.llm.common import runs, staged, table, width
from recordloom.llm.components import components

WORDS = 5
SIMILAR = 0.8
BANDS, ROWS = 26, 5
#: Agreement of registers below which a pair across components isn't verified. At a similarity
#: of 0.8 a pair agrees in 104 of 130 on average; 86 is four standard deviations below.
AGREE = 0.66
TILE = 512  # texts of one side of a tile
COLUMNS = 2048  # shared shingles counted at a time
MEMBERS = 512  # texts verified in one group


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], registers: int) -> np.ndarray:
    """ProbMinHash registers of (shingles, weights) per text, all texts at once."""
    n = len(sets)
    first = np.full(n * registers, np.inf)
    held = np.zeros(n * registers, np.uint64)
    if not n:
        return held.reshape(0, registers)
    items = np.concatenate([s for s, _ in sets])
    rates = np.concatenate([w for _, w in sets])
    doc = np.repeat(np.arange(n), [len(s) for s, _ in sets])
    at = np.zeros(len(items))
    step = 0
    while len(items):
        rounds = int(max(1, min(128, 100_000 // len(items))))
        for k in range(step, step + rounds):
            u = textops.mix(items + np.uint64((2 * k + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
            at = at - np.log(((u >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rates
            place = doc * registers + (textops.mix(u ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(registers)).astype(np.int64)
            np.minimum.at(first, place, at)
            won = first[place] == at
            held[place[won]] = items[won]
        step += rounds
        latest = first.reshape(n, registers).max(1)
        on = at < latest[doc]
        items, rates, doc, at = items[on], rates[on], doc[on], at[on]
    return held.reshape(n, registers)


def _sign(words: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for batch in batches:
            ids = batch.column("id").to_pylist()
            for first, texts in textops.chunks(batch.column("text")):
                sets = []
                for s in textops.Words(texts, cache).shingles(words):
                    s, n = np.unique(s, return_counts=True)
                    sets.append((s, 1.0 + np.log(n)))
                full = [i for i, (s, _) in enumerate(sets) if len(s)]
                if not full:
                    continue
                got = signatures([(sets[i][0], np.ones(len(sets[i][0]))) for i in full], bands * rows)
                weighted, often = got.copy(), [k for k, i in enumerate(full) if sets[i][1].max() > 1]
                if often:  # without repeats both are the same
                    weighted[often] = signatures([sets[full[k]] for k in often], bands * rows)
                keys = np.zeros((len(full), 2 * bands), np.uint64)
                for r in range(rows):
                    keys = keys * np.uint64(textops._BASE) + np.hstack([got[:, r::rows], weighted[:, r::rows]])
                keys = textops.mix(keys + np.tile(np.arange(bands, dtype=np.uint64), 2) * np.uint64(0x632BE59BD9B4E019))
                low = (got & np.uint64(255)).astype(np.uint8)
                one = [int((sets[i][0] * np.uint64(3)).sum()) & (2**63 - 1) for i in full]
                two = [int(textops.mix(sets[i][0]).sum()) & (2**63 - 1) for i in full]
                flat = pa.array(keys.view(np.int64).ravel())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[first + i] for i in full], pa.int64()),
                        pa.array(one, pa.int64()),
                        pa.array(two, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(full) + 1, dtype=np.int32) * 2 * bands), flat),
                        pa.array([x.tobytes() for x in low], pa.binary()),
                    ],
                    names=["id", "one", "two", "bands", "registers"],
                )

    return run


def _verify(words: int, similar: float):
    """Groups of one pivot text and its members; the pivot leads, members stream past it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        group = pivot = mine = None
        for batch in batches:
            keys, roles, ids = (batch.column(c).to_pylist() for c in ("group", "role", "id"))
            a, b = [], []
            for first, texts in textops.chunks(batch.column("text")):
                for i, s in enumerate(textops.Words(texts, cache).shingles(words), first):
                    s = np.unique(s)
                    if roles[i] == 0:
                        group, pivot, mine = keys[i], ids[i], s
                    elif keys[i] == group and len(s) and len(mine):
                        common = len(np.intersect1d(s, mine, assume_unique=True))
                        if common >= similar * (len(s) + len(mine) - common) - 1e-9:
                            a.append(pivot)
                            b.append(ids[i])
            if a:
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def verified(pairs: DataFrame, texts: DataFrame, words: int, similar: float) -> DataFrame:
    """Pairs (a, b) whose texts (id, text) are similar. Groups share a; large ones are cut up."""
    spark = pairs.sparkSession
    per = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    cut = pairs.join(per, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / F.lit(MEMBERS))))
    cut = staged(cut.select("a", "b", F.xxhash64("a", "part").alias("group")))
    sides = cut.select(F.col("b").alias("id"), "group", F.lit(1).alias("role")).unionAll(cut.select(F.col("a").alias("id"), "group", F.lit(0).alias("role")).distinct())
    rows = texts.join(staged(sides).hint("merge"), "id").repartition(width(spark), "group").sortWithinPartitions("group", "role")
    return rows.select("group", "role", "id", "text").mapInArrow(_verify(words, similar), "a long, b long")


def _agreeing(rows: pa.Table, agree: float) -> np.ndarray:
    """Agreement of registers between the members of a tile, 0 for pairs across components below ``agree``.

    Members of one component agree fully: what is connected costs nothing.
    """
    home = rows.column("component").to_numpy()
    codes = np.frombuffer(b"".join(rows.column("registers").to_pylist()), np.uint8).reshape(len(home), -1)
    same = np.zeros((len(home), len(home)), np.float32)
    for lo in range(0, len(home), 32):
        same[lo : lo + 32] = (codes[lo : lo + 32][:, None, :] == codes[None, :, :]).mean(2)
    apart = home[:, None] != home[None, :]
    same[apart & (same < agree)] = 0
    same[~apart] = 2
    return same


def _forest(agree: float):
    """Pairs across components of a spanning forest that prefers the best agreement: a line a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, "cell"):
            n, ids = rows.num_rows, rows.column("id").to_numpy()
            same = _agreeing(rows, agree)
            if (same == 2).all():
                continue
            best, by, out = same[0].copy(), np.zeros(n, np.int64), []
            best[0] = -1
            for _ in range(n - 1):
                at = int(best.argmax())
                if 0 < best[at] <= 1:
                    out.append((by[at], at))
                nearer = (same[at] > best) & (best >= 0)
                best[nearer], by[nearer] = same[at][nearer], at
                best[at] = -1
            x, y = ids[np.array(out, np.int64).reshape(-1, 2).T]
            if len(x):
                yield pa.RecordBatch.from_pydict({"a": pa.array(np.minimum(x, y)), "b": pa.array(np.maximum(x, y))})

    return run


_CLOSE = "cell long, id long, component long"


def _close(agree: float):
    """The members of each tile that agree enough with one of another component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, "cell"):
            same = _agreeing(rows, agree)
            at = np.flatnonzero(((same > 0) & (same <= 1)).any(1))
            if len(at):
                got = rows.select(["cell", "id", "component"]).take(pa.array(at)).combine_chunks()
                yield from got.to_batches()

    return run


def linked(sets: list[np.ndarray], home: np.ndarray, similar: float) -> list[tuple[int, int]]:
    """A spanning forest, over what ``home`` joins already, of all similar pairs of some sets."""
    n, size = len(sets), np.array([len(s) for s in sets], np.float64)
    _, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), size.astype(np.int64))
    common = np.zeros((n, n), np.float32)  # whole numbers, exact up to 2**24
    shared = np.cumsum(times > 1) - 1
    keep = times[place] > 1
    column, owner = shared[place[keep]], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    last = int(column[-1]) + 1 if len(column) else 0
    for lo in range(0, last, COLUMNS):
        part = slice(*np.searchsorted(column, [lo, lo + COLUMNS]))
        holds = np.zeros((n, min(COLUMNS, last - lo)), np.float32)
        holds[owner[part], column[part] - lo] = 1
        common += holds @ holds.T
    whole = size[:, None] + size[None, :] - common
    similar_ = (common >= similar * whole - 1e-9) & (whole > 0)
    label, out = home.copy(), []
    for i in range(n):
        others = np.flatnonzero(similar_[i] & (label != label[i]))
        while len(others):
            out.append((i, int(others[0])))
            label[label == label[others[0]]] = label[i]
            others = others[label[others] != label[i]]
    return out


def _verify_tiles(words: int, similar: float):
    """Links between components inside each tile, verified on the texts: fewer than its members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for rows in runs(batches, "cell"):
            sets = []
            for _, texts in textops.chunks(rows.column("text")):
                sets += map(np.unique, textops.Words(texts, cache).shingles(words))
            found = linked(sets, rows.column("component").to_numpy(), similar)
            if found:
                x, y = rows.column("id").to_numpy()[np.array(found, np.int64).T]
                yield pa.RecordBatch.from_pydict({"a": pa.array(np.minimum(x, y)), "b": pa.array(np.maximum(x, y))})

    return run


def _open(crowded: DataFrame, marks: DataFrame, state: DataFrame) -> DataFrame:
    """Members of the buckets that lie in several components, dealt out in tiles."""
    placed = crowded.join(state.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    split = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count(F.lit(1)).alias("n")).where("x <> y")
    open_ = placed.join(split.select("key", "n"), "key").join(marks, "id")
    tiles = F.ceil(F.col("n") / F.lit(TILE)).cast("int")
    grid = open_.withColumn("chunk", F.pmod(F.xxhash64("id"), tiles).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
    cell = F.xxhash64("key", F.least("chunk", "other"), F.greatest("chunk", "other"))
    grid = grid.select("id", "component", "registers", cell.alias("cell"))
    return grid.repartition(width(crowded.sparkSession), "cell").sortWithinPartitions("cell")


def near_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similar: float = SIMILAR, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per row: id, component_id (smallest id of its class), kept."""
    spark = df.sparkSession
    slim = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    signed = staged(slim.where("id is not null").mapInArrow(_sign(words, bands, rows), "id long, one long, two long, bands array<long>, registers binary"))
    classes = signed.groupBy("one", "two").agg(F.min("id").alias("rep"))
    members = staged(signed.select("id", "one", "two").join(classes, ["one", "two"]).select("id", "rep"))
    reps = signed.join(members.where("id = rep").select("id").distinct(), "id", "left_semi")
    buckets = staged(reps.select("id", F.explode("bands").alias("key")).distinct())
    hubs = buckets.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("top")).where("a <> top").select("key", "a")
    crowded = staged(buckets.join(hubs, "key"))
    tried = staged(crowded.where("id <> a").select("a", F.col("id").alias("b")).distinct())
    involved = crowded.select("id").distinct()
    texts = staged(slim.join(involved.hint("merge"), "id", "left_semi"))  # one plan at every size
    marks = staged(reps.select("id", "registers").dropDuplicates(["id"]).join(involved, "id"))
    state = staged(components(verified(tried, texts, words, similar)))
    of_state = lambda: state.select(F.col("node").alias("a"), F.col("component").alias("b"))
    for _ in range(2):  # the likeliest links first; they join most of what belongs together
        across = _open(crowded.select("key", "id"), marks, state).mapInArrow(_forest(AGREE), "a long, b long").where("a <> b").distinct()
        across = staged(across.join(tried, ["a", "b"], "left_anti"))
        tried = tried.unionAll(across)
        state = staged(components(verified(across, texts, words, similar).unionAll(of_state())))
    # then all pairs that are left, inside their tiles: neither pairs nor verified pairs leave them
    close = staged(_open(crowded.select("key", "id"), marks, state).mapInArrow(_close(AGREE), _CLOSE))
    tiles = texts.join(close.hint("merge"), "id").repartition(width(spark), "cell").sortWithinPartitions("cell", "id")
    links = tiles.select("cell", "id", "component", "text").mapInArrow(_verify_tiles(words, similar), "a long, b long")
    state = staged(components(links.unionAll(of_state())))
    final = components(state.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(members.where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))))
    got = slim.select("id").join(final.withColumnRenamed("node", "id"), "id", "left")
    home = F.coalesce("component", "id")
    return got.select("id", home.alias("component_id"), (F.col("id").isNull() | (F.col("id") == home)).alias("kept"))


def deduplicated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows that stay, as they came: one of each class, and all rows with a null id.

    Rows are numbered in a written table and compared under these numbers, so different texts
    may share an id. Of a class the row with the smallest id stays.
    """
    whole = F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")
    own = F.col(f"`{id_col}`")
    key = F.when(own.isNotNull(), F.monotonically_increasing_id()).alias("key")
    rows = staged(df.select(key, whole))
    rows = rows.select("key", "row", F.col("row")[id_col].alias("own"), F.col("row")[text_col].alias("text"))
    classes = near_classes(rows.select("key", "text"), "key", "text", **how).where("id is not null").select(F.col("id").alias("key"), "component_id")
    first = F.min(F.struct("own", "key"))["key"].alias("key")
    stay = rows.select("key", "own").join(classes, "key").groupBy("component_id").agg(first).select("key")
    return rows.select("key", "row").join(stay, "key", "left_semi").unionByName(rows.where("key is null").select("key", "row")).select("row.*")


def op4(spark, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
