"""WARC volumes and their fixity: Merkle trees over records and offset ranges.

A volume is a run of WARC records at ascending offsets. Its tree has the records' digests as
leaves; above them nodes for offset ranges of 64 KiB, 1 MiB, 16 MiB and so on, each the digest of
its children in order of offset; then the volume; then groups of volumes up to one root. To
audit a replica the roots are compared, and where nodes differ their children, down to records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.session import materialise

#: Bits of the smallest offset range, and by how many a range grows per level.
RANGE_BITS, STEP_BITS, RANGE_LEVELS = 16, 4, 3
#: Volumes per group, in bits, and levels of groups.
GROUP_BITS, GROUP_LEVELS = 8, 3


def record(key: Column, url: Column, body: Column) -> Column:
    """A WARC 1.1 resource record of a web page; null parts are empty."""
    body = F.coalesce(body.cast("string"), F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "), F.coalesce(url.cast("string"), F.lit("")),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(">\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def volumes(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html", rows: int = 1024) -> DataFrame:
    """(volume, offset, length, id, record): the pages as records, ``rows`` consecutive keys to a volume.

    Records follow each other by key, equal keys by their bytes. Pages with a null key make up the
    volume -1. An empty table gives an empty one; other columns are not read.
    """
    id_ = F.col(f"`{key}`").cast("long")
    made = pages.select(F.coalesce(F.floor(id_ / rows), F.lit(-1)).alias("volume"), id_.alias("id"), record(id_, F.col(f"`{url}`"), F.col(f"`{body}`")).alias("record"))
    made = made.withColumn("length", F.octet_length("record").cast("long"))
    before = Window.partitionBy("volume").orderBy("id", "record").rowsBetween(Window.unboundedPreceding, -1)
    return made.select("volume", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"), "length", "id", "record")


def leaves(records: DataFrame) -> DataFrame:
    """(volume, offset, length, id, digest) of the records of an archive, for ``audit``. A null
    record is an empty one; lengths are taken from the bytes that are there."""
    found = F.coalesce("record", F.lit(""))
    return records.select("volume", "offset", F.octet_length(found).cast("long").alias("length"), "id", F.sha2(found, 256).alias("digest"))


def _digest(*order: Column) -> Column:
    """Digest of a node from its children's, in the given order."""
    children = F.sort_array(F.collect_list(F.struct(*order, "digest")))
    return F.sha2(F.concat_ws(";", F.transform(children, lambda c: F.concat_ws(",", *(c[f"k{i}"].cast("string") for i in range(len(order))), c["digest"]))), 256)


def tree(records: DataFrame) -> list[DataFrame]:
    """The nodes by level, from records to the root: (volume, node, digest), the records with
    offset, length and id too. A level has about a sixteenth of the rows of the one below, and no
    more rows meet in a node than an offset range has records."""
    k = F.col
    records = records.withColumn("node", F.shiftright("offset", RANGE_BITS))
    levels = [records]
    below = records.groupBy("volume", "node").agg(_digest(k("offset").alias("k0"), k("length").alias("k1")).alias("digest"))
    below = materialise(below, "fixity-ranges")
    levels.append(below)
    for _ in range(RANGE_LEVELS):
        below = below.groupBy("volume", F.shiftright("node", STEP_BITS).alias("up")).agg(_digest(k("node").alias("k0")).alias("digest")).withColumnRenamed("up", "node")
        levels.append(below)
    below = below.groupBy("volume").agg(_digest(k("node").alias("k0")).alias("digest")).withColumn("node", F.lit(0).cast("long"))
    below = materialise(below.select("volume", "node", "digest"), "fixity-volumes")
    levels.append(below)
    for _ in range(GROUP_LEVELS):
        below = below.groupBy(F.shiftright("volume", GROUP_BITS).alias("up")).agg(_digest(k("volume").alias("k0")).alias("digest"))
        below = below.select(F.col("up").alias("volume"), F.lit(0).cast("long").alias("node"), "digest")
        levels.append(below)
    root = below.agg(_digest(k("volume").alias("k0")).alias("digest")).select(F.lit(0).cast("long").alias("volume"), F.lit(0).cast("long").alias("node"), "digest")
    return [*levels, root]


def _parent(level: int) -> tuple[Column, Column]:
    """(volume, node) of the parent of a node of a level."""
    v, n = F.col("volume"), F.col("node")
    if level == 0:
        return v, n
    if level <= RANGE_LEVELS:
        return v, F.shiftright(n, STEP_BITS)
    if level == RANGE_LEVELS + 1:
        return v, F.lit(0).cast("long")
    if level < RANGE_LEVELS + 2 + GROUP_LEVELS:
        return F.shiftright(v, GROUP_BITS), F.lit(0).cast("long")
    return F.lit(0).cast("long"), F.lit(0).cast("long")


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """(volume, offset, length, id, state) of the records in which ``replica`` differs from ``primary``.

    Both are tables like that of ``leaves``. State is "altered" (other bytes at the place),
    "missing" (not in the replica) or "extra" (only there, with the replica's length). A record
    that occurs more than once at its place is compared as often. Two equal or empty archives give
    an empty table. Of each level only children of differing nodes are compared.
    """
    ours, theirs = tree(primary), tree(replica)
    differing = None
    for level in range(len(ours) - 1, 0, -1):
        a, b = (t[level].select("volume", "node", "digest") for t in (ours, theirs))
        if differing is not None:
            a, b = (_children(x, level, differing) for x in (a, b))
        both = a.join(b.withColumnRenamed("digest", "other"), ["volume", "node"], "full")
        # Written at each level: both sides of the next one are narrowed by it.
        differing = materialise(both.where(~F.col("digest").eqNullSafe(F.col("other"))).select("volume", "node"), "fixity-differing")
    places = ["volume", "offset", "length"]
    nth = F.row_number().over(Window.partitionBy("volume", "offset").orderBy("length", "digest"))
    a, b = (_children(t[0], 0, differing).withColumn("nth", nth) for t in (ours, theirs))
    b = b.select("volume", "offset", "nth", *(F.col(c).alias(f"b_{c}") for c in ("length", "id", "digest")))
    both = a.join(b, ["volume", "offset", "nth"], "full").where(~(F.col("digest").eqNullSafe(F.col("b_digest")) & F.col("length").eqNullSafe(F.col("b_length"))))
    state = F.when(F.col("b_digest").isNull(), "missing").when(F.col("digest").isNull(), "extra").otherwise("altered")
    return both.select(*places[:2], F.coalesce("length", "b_length").alias("length"), F.coalesce("id", "b_id").alias("id"), state.alias("state"))


def _children(nodes: DataFrame, level: int, differing: DataFrame) -> DataFrame:
    volume, node = _parent(level)
    up = differing.select(F.col("volume").alias("up_volume"), F.col("node").alias("up_node"))
    return nodes.withColumn("up_volume", volume).withColumn("up_node", node).join(up, ["up_volume", "up_node"], "left_semi").drop("up_volume", "up_node")
