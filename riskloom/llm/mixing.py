"""Mixing of sources to target weights by weighted fair queueing.

Every source is a queue of its documents in hash order, up to ``most`` rounds long. A document's
virtual finish time is the words of its source up to and with it, over the source's target. All
documents of all sources, sorted by finish time, are the mix; it ends at the total budget.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm import texts
from riskloom.session import materialise

#: Documents per part of a queue: what one task sorts. Parts grow in number with the table.
PART_ROWS = 20_000


def word_count(text: Column) -> Column:
    """Runs of anything but the six ASCII blanks; null has none."""
    @F.arrow_udf("long")
    def compute(column: pa.Array) -> pa.Array:
        found = [np.diff(texts.words(raw, offsets)[2]) for _, _, raw, offsets in texts.chunks(column)]
        return pa.array(np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64))

    return compute(text.cast("string"))


def targets(sources: DataFrame, most: float = 3.0) -> DataFrame:
    """``sources`` (source, source_size) with ``target``: the total size shared by weight, where
    sources by code point, null last, weigh 1, 2, 3, 1, 2, 3 and so on. No target is above
    ``most`` times its source's size; what is over goes to the others by weight.

    A source reaches its ceiling the earlier, the lower its ceiling is for its weight. In that
    order the share of a unit of weight, once all before are at their ceilings, follows from
    running sums; the first source below its ceiling sets the share of all after it. The table of sources is
    small beside the documents; its window runs in one task.
    """
    byte_order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    filling = Window.orderBy("ratio", F.col("source").isNull(), F.encode("source", "UTF-8")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    ranked = sources.withColumn("weight", ((F.row_number().over(byte_order) - 1) % 3 + 1).cast("double"))
    ranked = ranked.withColumn("ceiling", F.lit(float(most)) * F.col("source_size")).withColumn("ratio", F.col("ceiling") / F.col("weight"))
    total, weights = F.sum("source_size").over(every).cast("double"), F.sum("weight").over(every)
    level = (total - F.coalesce(F.sum("ceiling").over(filling), F.lit(0.0))) / (weights - F.coalesce(F.sum("weight").over(filling), F.lit(0.0)))
    ranked = ranked.withColumn("level", level).withColumn("full", F.col("ratio") <= F.col("level"))
    rest = F.max(F.when(~F.col("full"), F.col("level"))).over(every)
    return ranked.select("source", "source_size", F.when(F.col("full"), F.col("ceiling")).otherwise(F.col("weight") * rest).alias("target"))


def mix(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", most: int = 3,
        seed: int = 0, part_rows: int = PART_ROWS, carry: str | None = None) -> DataFrame:
    """``key``, size, source_size, target, copies, taken for every row of ``docs``, and the column ``carry``.

    ``copies`` is how often the mix takes the row (0 to ``most``), ``taken`` = copies * size. The
    order of a queue is a hash of key, text and ``seed``, so reruns agree. A row of size 0 costs
    nothing and is taken once if its source's queue gets to it. Null sources are one source, the
    last; null texts have size 0; rows repeated in all columns are queued one after the other. If
    no row has words, all targets are 0 and nothing is taken. An empty table gives an empty one.
    Only the named columns are read. A source is cut by hash into parts of
    about ``part_rows``, whose sums give the others their start, so a source with a third of all rows is spread.
    """
    sized = docs.select(
        F.col(f"`{key}`").alias("id"), F.col(f"`{source}`").cast("string").alias("source"), word_count(F.col(f"`{text}`")).alias("size"),
        F.xxhash64(F.lit(seed), F.col(f"`{key}`"), F.col(f"`{text}`").cast("string")).alias("order"),
        *([F.col(f"`{carry}`").alias("__carried")] if carry else []))
    sized = materialise(sized, "mix-sizes")
    bare = F.col("source").isNull().cast("int").alias("bare")
    rows = sized.withColumn("bare", bare).withColumn("source", F.coalesce("source", F.lit("")))
    queue = ["source", "bare"]

    per = rows.groupBy(*queue).agg(F.sum("size").alias("source_size"), F.ceil(F.count("*") / part_rows).alias("parts"))
    per = materialise(targets(per.select(F.when(F.col("bare") == 0, F.col("source")).alias("source"), "source_size"), most)
                      .withColumn("bare", F.col("source").isNull().cast("int")).withColumn("source", F.coalesce("source", F.lit("")))
                      .join(per.select(*queue, "parts"), queue), "mix-sources")

    # Parts of a queue are ranges of the hash, in order.
    part = F.floor((F.shiftrightunsigned("order", 33).cast("double") / float(1 << 31)) * F.col("parts"))
    cut = rows.join(per.select(*queue, "parts", "source_size", "target"), queue).withColumn("part", part)
    sums = cut.groupBy(*queue, "part").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy(*queue).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*queue, "part", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("before"))
    inside = Window.partitionBy(*queue, "part").orderBy(F.shiftrightunsigned("order", 33), "order", "id").rowsBetween(Window.unboundedPreceding, 0)
    queued = cut.withColumn("upto", F.sum("size").over(inside)).withColumn("nth", F.count("*").over(inside))
    queued = queued.join(sums, [*queue, "part"]).withColumn("upto", F.col("upto") + F.col("before"))
    queued = materialise(queued.select("id", "size", "source_size", "target", "upto", "nth", "part", *queue, *(["__carried"] if carry else [])), "mix-queues")

    place = ["finish", *queue, "part", "nth", "round"]

    def at(row: Column) -> list[Column]:
        """A document's place in the mix in its round, as ``place``."""
        finish = ((row * F.col("source_size") + F.col("upto")) / F.col("target")).alias("finish")
        return [finish, *(F.col(c) for c in (*queue, "part", "nth")), row.alias("round")]

    rounds = F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("round")
    items = queued.where("target > 0").select("*", rounds).select("size", *at(F.col("round")))
    whole = rows.agg(F.sum("size").alias("words"), F.count("*").alias("rows")).first()
    left, slices = int(whole["words"] or 0), int(whole["rows"]) // part_rows * 4 + 16
    # The end is looked for in whole units of virtual time, in slices of the unit it is in, then in
    # that slice alone: no step sorts more than a slice.
    end = True
    for slot in (F.floor("finish"), F.floor((F.col("finish") - F.floor("finish")) * slices)):
        sums = items.groupBy(slot.alias("slot")).agg(F.sum("size").alias("words"))
        running = sums.withColumn("upto", F.sum("words").over(Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)))
        end = running.where(F.col("upto") > left).orderBy("slot").first()
        if end is None:
            break
        left -= end["upto"] - end["words"]
        items = items.where(slot == end["slot"])
    if end is not None:
        upto = F.sum("size").over(Window.orderBy(*place).rowsBetween(Window.unboundedPreceding, 0))
        end = items.withColumn("upto", upto).where(F.col("upto") > left).orderBy(*place).first()
        end = F.struct(*(F.lit(end[c]).cast(t).alias(c) for c, t in items.select(*place).dtypes))
    hits = [F.col("target") > 0 if end is None else (F.col("target") > 0) & (F.struct(*at(F.lit(r))) < end) for r in range(most)]
    taken = sum((h.cast("int") for h in hits[1:]), hits[0].cast("int"))
    copies = F.when(F.col("size") > 0, taken).otherwise(F.least(taken, F.lit(1)))
    return queued.select(F.col("id").alias(key), "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"),
                         *([F.col("__carried").alias(carry)] if carry else []))


def with_copies(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", most: int = 3,
                seed: int = 0, part_rows: int = PART_ROWS) -> DataFrame:
    """``docs``, all columns, with ``copies``: how often ``mix`` takes the row.

    A round of the mix takes the documents at the head of each queue, up to some place. That place, per source and
    round, is all that goes back to the documents, so texts are neither shuffled nor written: a row's own hash tells
    on which side it stands. Rows equal in key and text stand at one place; where a round ends among them, that many of them, as they come, are taken.
    """
    order = F.xxhash64(F.lit(seed), F.col(f"`{key}`"), F.col(f"`{text}`").cast("string"))
    origin = F.struct(F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")).alias("of"), F.col(f"`{source}`").isNull().alias("bare"))

    def place(hashed: Column, one: Column) -> Column:
        return F.struct(F.shiftrightunsigned(hashed, 33).alias("high"), hashed.alias("hash"), one.alias("id"))

    queued = mix(docs.withColumn("__at", F.struct(order.alias("order"), origin.alias("origin"))), text, key, source, most, seed, part_rows, carry="__at")
    at = queued.select(F.col("__at.origin").alias("__origin"), place(F.col("__at.order"), F.col(f"`{key}`")).alias("spot"), "copies")
    last = at.groupBy("__origin").agg(*[F.max(F.when(F.col("copies") > r, F.col("spot"))).alias(f"__last{r}") for r in range(most)])
    last = materialise(last, "mix-ends")
    # Rows at the very end of a round: how many there are, and how many of them it takes.
    edge = at.join(last, "__origin")
    ends = edge.groupBy("__origin").agg(*[F.count_if((F.col("spot") == F.col(f"__last{r}")) & (F.col("copies") > r)).alias(f"__hits{r}") for r in range(most)],
                                        *[F.count_if(F.col("spot") == F.col(f"__last{r}")).alias(f"__all{r}") for r in range(most)])
    ends = materialise(last.join(ends, "__origin"), "mix-places")

    spot, filled = place(order, F.col(f"`{key}`")), F.length(F.btrim(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), F.lit(" \t\n\x0b\x0c\r"))) > 0
    marked = docs.withColumns({"__origin": origin, "__spot": spot, "__filled": filled}).join(ends, "__origin")
    rounds = range(most)
    split = [F.col(f"__hits{r}") < F.col(f"__all{r}") for r in rounds]
    here = [F.coalesce(F.col("__spot") == F.col(f"__last{r}"), F.lit(False)) for r in rounds]
    torn = F.lit(False)
    for r in rounds:
        torn = torn | (here[r] & split[r])
    marked = marked.withColumn("__torn", torn)

    def copies(nth: Column) -> Column:
        hits = [F.coalesce(F.col("__spot") < F.col(f"__last{r}"), F.lit(False)) | (here[r] & (nth <= F.col(f"__hits{r}"))) for r in rounds]
        if most == 1:
            return hits[0].cast("int")
        more = sum((h.cast("int") for h in hits[2:]), hits[1].cast("int"))
        return hits[0].cast("int") + F.when(F.col("__filled"), more).otherwise(0)

    # Where a round ends, rows of the last place are taken by their number among them; of a place that is taken whole any number does.
    nth = F.row_number().over(Window.partitionBy("__origin", "__spot").orderBy("__spot"))
    whole = marked.where(~F.col("__torn")).withColumn("copies", copies(F.lit(1)))
    some = marked.where("__torn").withColumn("__nth", nth).withColumn("copies", copies(F.col("__nth")))
    wanted = [*[F.col(f"`{c}`") for c in docs.columns], F.col("copies")]
    return whole.select(*wanted).unionByName(some.select(*wanted))
