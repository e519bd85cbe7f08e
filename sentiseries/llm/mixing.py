"""Interleaving sources to target weights by proportionate fair scheduling.

Every source's documents are put in the order of a hash of id and row and cut into blocks. A source of
weight w must have had its block k (from 0) no earlier than slot floor(k / w) and before
slot ceil((k + 1) / w); in every slot the released block with the earliest deadline is
taken. With weights that add up to 1 this meets all deadlines, so that after any number
of slots every source is less than one block away from its share.

Weights are taken exactly, as ratios of whole numbers, so the distance does not grow with
the number of slots. The schedule is made on the driver, one step for each block and
source (not for each slot: where nothing is released it goes on to the next release), in
eight bytes a block. The work on documents is one window per (source, slice), where
a source is cut by the hash into so many slices that each holds about ``SLICE`` documents; a
table gives each slice the number of documents before it and the slots of its blocks.

When a source has no documents left its share of the slots stays free, and blocks of the
others, once released, may take it; ``balanced`` is true for the slots before the first
source ran out. All documents are returned. A null source is a source of its own, null
ids and repeated rows are placed like any other. There is no limit on sources; a weight
so small that a slot's number passes 63 bits raises OverflowError.
"""

from __future__ import annotations

import heapq
import math
import re
from array import array
from collections import Counter
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sentiseries.llm.common import free_name
from sentiseries.sources.storage import stored

BLOCK = 16
SLICE = 2_000
#: Up to so many sources their table is broadcast.
FEW_SOURCES = 100_000


def exact(weights: dict[str | None, float]) -> dict[str | None, int]:
    """Whole numbers in the very ratio of the weights."""
    if any(not 0 < w < math.inf for w in weights.values()):
        raise ValueError("weights must be positive")
    ratios = {s: Fraction(w) for s, w in weights.items()}
    scale = math.lcm(*(r.denominator for r in ratios.values()))
    return {s: int(r * scale) for s, r in ratios.items()}


def schedule(shares: dict[str | None, int], blocks: dict[str | None, int] | None = None) -> dict[str | None, array]:
    """The slots of each source's first ``blocks``, by default of those of one period."""
    names = sorted(shares, key=lambda s: (s is not None, s or ""))
    total = sum(shares.values())
    wanted = [(shares if blocks is None else blocks).get(s, 0) for s in names]
    slots = [array("q") for _ in names]
    waiting, ready = [(0, j) for j, n in enumerate(wanted) if n], []
    slot = 0
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            _, j = heapq.heappop(waiting)
            release, rest = divmod((len(slots[j]) + 1) * total, shares[names[j]])
            heapq.heappush(ready, (release + (rest > 0), j, release))
        _, j, release = heapq.heappop(ready)
        slots[j].append(slot)
        slot += 1
        if len(slots[j]) < wanted[j]:
            heapq.heappush(waiting, (release, j))
    return dict(zip(names, slots))


def tempered(counts: dict[str | None, int], power: float = 0.5) -> dict[str | None, float]:
    """Weights that lift small sources: document counts to a power below 1."""
    return {s: n**power for s, n in counts.items()}


def _marked(source: str | None) -> str:
    return "" if source is None else f"={source}"


def _ahead(spark: SparkSession, sizes: list[tuple[str, int, int]], slots: dict[str, array], block: int, names: tuple[str, ...]) -> DataFrame:
    """(source, slice, documents of the source before it, slots of the blocks it has a part of)."""
    before, firsts, offsets, values = Counter(), [], [0], array("q")
    for s, _, n in sizes:
        values += slots[s][before[s] // block : (before[s] + n - 1) // block + 1]
        offsets.append(len(values))
        firsts.append(before[s])
        before[s] += n
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(memoryview(values), pa.int64()))
    sources, parts = pa.array([r[0] for r in sizes], pa.string()), pa.array([r[1] for r in sizes], pa.int64())
    return spark.createDataFrame(pa.table([sources, parts, pa.array(firsts, pa.int64()), lists], names=list(names)))


def mix(documents: DataFrame, weights: dict[str | None, float] | None = None, key: str = "doc_id", source: str = "source", block: int = BLOCK) -> DataFrame:
    """All rows and columns, and block (of the source), slot, place (in the block), balanced.

    Ordered by slot and place the rows are the mixture. Sources without a weight raise
    ValueError; without ``weights`` they are ``tempered`` counts. Columns of the added
    names are replaced.
    """
    spark = documents.sparkSession
    counts = {r["s"]: r["n"] for r in documents.groupBy(F.col(source).cast("string").alias("s")).agg(F.count("*").alias("n")).collect()}
    added = ("block", "slot", "place", "balanced")
    if not counts:
        out = documents.withColumns({"block": F.lit(0).cast("long"), "slot": F.lit(0).cast("long"), "place": F.lit(0).cast("long"), "balanced": F.lit(True)})
        return out.select(*(c for c in documents.columns if c not in added), *added)
    weights = tempered(counts) if weights is None else weights
    if missing := set(counts) - set(weights):
        raise ValueError(f"no weight for {sorted(map(str, missing))}")
    # one block more than are full: the first that a source cannot fill ends the balance
    slots = schedule(exact(weights), {s: n // block + 1 for s, n in counts.items()})
    end = min(slots[s][n // block] for s, n in counts.items())
    names = {n: free_name(documents, f"mix_{n}") for n in ("s", "h", "slice", "rank", "before", "slots", "parts")}
    s, h, part, rank, before, at, parts = (names[n] for n in ("s", "h", "slice", "rank", "before", "slots", "parts"))
    # a key that is never null, so that the join finds the rows where the window left them
    marked = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))
    # maps and variants have no hash; what else a row holds tells equal ids apart
    hashed = [c for c, kind in documents.dtypes if not re.search("map<|variant", kind)]
    keyed = documents.withColumns({s: marked, h: F.xxhash64(F.lit("mix"), *(F.col(f"`{c}`") for c in hashed))})
    # one row a source: sent to the tasks while it is small, for a join by source moves whole rows
    cuts = spark.createDataFrame([(_marked(k), max(1, n // SLICE)) for k, n in counts.items()], f"{s} string, {parts} long")
    keyed = keyed.join(F.broadcast(cuts) if len(counts) <= FEW_SOURCES else cuts, s)
    keyed = keyed.withColumn(part, F.floor(F.shiftrightunsigned(h, 33) * F.col(parts) / F.lit(2**31)).cast("long"))
    sizes = sorted(tuple(r) for r in keyed.groupBy(s, part).agg(F.count("*").alias("n")).collect())
    ahead = stored(_ahead(spark, sizes, {_marked(k): v for k, v in slots.items()}, block, (s, part, before, at)), "mixing_slots")
    # the slice is cut from the top of the unsigned hash, so slices follow in hash order
    ranked = keyed.withColumn(rank, F.row_number().over(Window.partitionBy(s, part).orderBy(F.shiftrightunsigned(h, 1), h, key)) - 1)
    nth = free_name(documents, "mix_nth")
    number = F.col(rank) + F.col(before)
    timed = ranked.join(ahead, [s, part]).withColumns({nth: F.floor(number / block), "place": (number % block).cast("long")})
    slot = F.get(at, (F.col(nth) - F.floor(F.col(before) / block)).cast("int"))
    return timed.select(
        *(c for c in documents.columns if c not in added), F.col(nth).cast("long").alias("block"), slot.cast("long").alias("slot"), F.col("place"), (slot < end).alias("balanced")
    )
