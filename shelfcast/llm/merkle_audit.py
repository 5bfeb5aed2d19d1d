"""Fixity audit of WARC replicas by Merkle trees, with built-in functions only.

Pages become WARC response records, dealt to files of bounded size and laid out in order of their id;
the manifest holds file, offset, length and digest of each record. A leaf covers an offset range of the primary and so a
range of its ids. Each replica builds its tree from its own records alone: they fall into the ranges by id, records
that the primary lacks included. Records of a range are hashed in order into a leaf, ``FAN_OUT`` nodes into their parent, up to a root per
file. The audit compares the roots and descends only where digests differ: a level reads the children of the
nodes that differed above, and records of the two replicas meet only inside ranges that differ.

Both trees are aggregations by (file, node); a range is hashed in blocks of ``BLOCK`` records and a node has at most ``FAN_OUT``
children, so no group grows with the data. A level is written before the next is built.

Defined cases: null url or html counts as empty; a null id sorts first and matches a null id; repeated
records of one id are laid out one after the other, told apart by their number; records that only the
replica has are reported as ``extra`` without a place; empty tables give an empty report.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.tables import written

#: Files get this many bytes on average, and there are at least ``LEAST_FILES`` of them.
FILE_BYTES = 256 << 20
LEAST_FILES = 16
RANGE_BYTES = 64 << 10
FAN_OUT = 16
BLOCK = 4096
_LINE = "\r\n"


def warc_record(page_id: Column, url: Column, html: Column) -> Column:
    """The record's text: WARC header block, blank line, payload, two line ends."""
    payload = F.coalesce(html, F.lit(""))
    header = [
        F.lit("WARC/1.0"), F.lit("WARC-Type: response"),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), F.coalesce(url, F.lit(""))),
        F.concat(F.lit("Content-Length: "), F.octet_length(payload).cast("string")),
    ]
    return F.concat(F.concat_ws(_LINE, *header), F.lit(_LINE * 2), payload, F.lit(_LINE * 2))


def record_digests(pages: DataFrame) -> DataFrame:
    """(page_id, number, length, digest): the SHA-256 of each record; ``number`` parts repeated ids.

    Ids that occur once, which is nearly all, need no order; only ids that repeat are numbered.
    """
    record = warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), record.alias("record"))
    rows = rows.select("page_id", F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("digest"))
    counted = rows.groupBy("page_id", "length", "digest").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("page_id").orderBy("digest")) - F.col("n")
    numbered = counted.withColumn("before", before)
    numbered = numbered.withColumn("number", F.explode(F.sequence(F.col("before"), F.col("before") + F.col("n") - 1)))
    return numbered.select("page_id", "number", "length", "digest")


def _file(files: int) -> Column:
    return F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(files)).cast("int")


def file_count(records: DataFrame, file_bytes: int = FILE_BYTES, least_files: int = LEAST_FILES) -> int:
    total = records.agg(F.sum("length")).first()[0] or 0
    return max(least_files, -(-total // file_bytes))


def manifest(records: DataFrame, files: int, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(file, node, page_id, number, offset, length, digest): records of a file in order of their id, ``node`` their offset range."""
    order = Window.partitionBy("file").orderBy("page_id", "number")
    offset = F.sum("length").over(order) - F.col("length")
    placed = records.withColumn("file", _file(files)).withColumn("offset", offset)
    return placed.withColumn("node", F.floor(F.col("offset") / range_bytes).cast("long")).select("file", "node", "page_id", "number", "offset", "length", "digest")


def place_by_id(records: DataFrame, wanted: DataFrame, files: int) -> DataFrame:
    """(file, node, page_id, number, length, digest): a replica's records in the ranges of the manifest ``wanted``.

    Only the first id of each range is read from the manifest: a record belongs to the last range that starts at or before it.
    """
    starts = wanted.groupBy("file", "node").agg(F.min(F.struct("page_id", "number")).alias("s"))
    none = F.lit(None)
    starts = starts.select(
        "file", F.col("s.page_id").alias("page_id"), F.col("s.number").alias("number"), none.cast("long").alias("length"), none.cast("string").alias("digest"), "node"
    )
    rows = records.select(_file(files).alias("file"), "page_id", "number", "length", "digest", none.cast("long").alias("node"))
    # A start sorts before the record of the same id and number.
    order = Window.partitionBy("file").orderBy("page_id", "number", F.col("node").isNull())
    found = F.last("node", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = rows.unionByName(starts).withColumn("at", F.coalesce(found, F.lit(0).cast("long")))
    return placed.filter("digest IS NOT NULL").select("file", F.col("at").alias("node"), "page_id", "number", "length", "digest")


def _joined(items: Column) -> Column:
    """One digest of the digests of a group, in order of their place."""
    return F.sha2(F.array_join(F.transform(F.array_sort(items), lambda x: x["digest"]), ""), 256)


def merkle_levels(placed: DataFrame, nodes: int, fan_out: int = FAN_OUT) -> list[DataFrame]:
    """Levels (file, node, digest) of one replica from the leaves up; ``nodes`` is the number of ranges of the longest file.

    ``placed`` has file, node, page_id, number and digest.
    """
    order = Window.partitionBy("file", "node").orderBy("page_id", "number")
    blocks = placed.withColumn("block", F.floor((F.row_number().over(order) - 1) / BLOCK).cast("long"))
    blocks = blocks.groupBy("file", "node", "block").agg(_joined(F.collect_list(F.struct("page_id", "number", "digest"))).alias("digest"))
    leaves = blocks.groupBy("file", "node").agg(_joined(F.collect_list(F.struct("block", "digest"))).alias("digest"))
    levels = [written(leaves, "merkle-0")]
    while nodes > 1:
        parent = F.floor(F.col("node") / fan_out).cast("long").alias("parent")
        up = levels[-1].groupBy("file", parent).agg(_joined(F.collect_list(F.struct("node", "digest"))).alias("digest"))
        levels.append(written(up.withColumnRenamed("parent", "node"), f"merkle-{len(levels)}"))
        nodes = -(-nodes // fan_out)
    return levels


def differing_ranges(primary: list[DataFrame], replica: list[DataFrame], fan_out: int = FAN_OUT) -> DataFrame:
    """(file, node) of the leaves that differ or that one tree lacks, found from the roots down."""
    frontier = None
    for a, b in zip(reversed(primary), reversed(replica)):
        if frontier is not None:
            above = frontier.withColumnRenamed("node", "parent")
            parent = F.floor(F.col("node") / fan_out).cast("long")
            a, b = (x.withColumn("parent", parent).join(above, ["file", "parent"], "left_semi").drop("parent") for x in (a, b))
        both = a.withColumnRenamed("digest", "a").join(b.withColumnRenamed("digest", "b"), ["file", "node"], "full")
        frontier = both.filter(~F.col("a").eqNullSafe(F.col("b"))).select("file", "node")
    return frontier


def audit(
    primary: DataFrame, replica: DataFrame, range_bytes: int = RANGE_BYTES, fan_out: int = FAN_OUT, file_bytes: int = FILE_BYTES, least_files: int = LEAST_FILES
) -> DataFrame:
    """(file, offset, length, page_id, number, status, expected, found) of every record that differs.

    status is ``changed``, ``missing`` or ``extra``; ``primary`` and ``replica`` are tables of pages.
    """
    records = written(record_digests(primary), "records")
    files = file_count(records, file_bytes, least_files)
    wanted = written(manifest(records, files, range_bytes), "manifest")
    copy = written(place_by_id(record_digests(replica), wanted, files), "replica")
    nodes = (wanted.agg(F.max("node")).first()[0] or 0) + 1
    ranges = written(differing_ranges(merkle_levels(wanted, nodes, fan_out), merkle_levels(copy, nodes, fan_out), fan_out), "differing")
    a = wanted.join(ranges, ["file", "node"], "left_semi").alias("a")
    b = copy.join(ranges, ["file", "node"], "left_semi").alias("b")
    keys = ["file", "node", "page_id", "number"]
    same = reduce(Column.__and__, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    found = a.join(b, same, "full").filter(~F.col("a.digest").eqNullSafe(F.col("b.digest")))
    extra, missing = F.col("a.digest").isNull(), F.col("b.digest").isNull()
    either = lambda c: F.when(extra, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c)
    return found.select(
        F.col("a.file").alias("file"), F.col("a.offset").alias("offset"), either("length"), either("page_id"), either("number"),
        F.when(extra, "extra").when(missing, "missing").otherwise("changed").alias("status"),
        F.col("a.digest").alias("expected"), F.col("b.digest").alias("found"),
    )
