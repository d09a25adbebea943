"""Operator 9: fixity of web archives by Merkle trees.

Records are hashed; the hashes of the records whose offsets fall into one range make the
range's hash, ranges make wider ranges, and those make an archive's root. Two replicas are
compared from the roots down, and only ranges that differ are opened, so what is compared
in detail follows the damage, not the archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quireworks.llm.common import settled, table, with_position

RECORDS = 1000  # records of an archive
RANGES = (1 << 16, 1 << 20)  # bytes of an offset range, by level from the records up

# The record layout of WARC 1.1.
_HEAD = "WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"
_URI = ">\r\nWARC-Target-URI: "
_SIZE = "\r\nContent-Type: text/html\r\nContent-Length: "


def warc_record(page_id: Column, url: Column, html: Column) -> Column:
    """The bytes of a page's record; nulls are written as nothing."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit(_HEAD), F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(_URI), F.coalesce(url, F.lit("")),
        F.lit(_SIZE), F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    ).cast("binary")


def lay_out(records: DataFrame, per_archive: int = RECORDS) -> DataFrame:
    """Add archive, seq and offset to records (page_id, url, length, sha256, ...).

    Records follow each other by (page_id, url, sha256), ``per_archive`` to an archive. The
    order is made by ranges, so no key, however frequent, is gathered in one task.
    """
    order = [F.col(c).asc_nulls_last() for c in ("page_id", "url", "sha256")]
    placed = with_position(records, order, "position")
    before = Window.partitionBy("archive").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn("archive", F.floor(F.col("position") / per_archive).cast("long"))
        .withColumn("seq", F.col("position") % per_archive)
        .withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
        .drop("position")
    )


def merkle_levels(manifest: DataFrame, ranges: tuple[int, ...] = RANGES) -> list[DataFrame]:
    """The trees' nodes by level, records first, roots last: (archive, node, parent, hash).

    ``manifest`` has (archive, offset, length, sha256). A node is the number of its offset
    range; a root is node 0 with the parent null. A node's hash is that of its children's
    numbers and hashes in order. A group holds the children of one range. Each level is
    checkpointed: the one above and the audit read it, neither makes it again.
    """
    widths = [1, *ranges]
    leaf = F.sha2(F.concat_ws(":", "offset", "length", "sha256").cast("binary"), 256)
    level = settled(manifest.select(
        "archive", F.col("offset").alias("node"), F.floor(F.col("offset") / widths[1]).cast("long").alias("parent"), leaf.alias("hash")
    ))
    levels = [level]
    for width, above in zip(widths[1:], [*widths[2:], None]):
        parent = F.lit(0).cast("long") if above is None else F.floor(F.col("parent") * width / above).cast("long")
        children = F.array_sort(F.collect_list(F.struct("node", "hash")))
        written = F.array_join(F.transform(children, lambda c: F.concat_ws(":", c["node"], c["hash"])), ",")
        level = settled(
            level.groupBy("archive", "parent").agg(F.sha2(written.cast("binary"), 256).alias("hash"))
            .select("archive", F.col("parent").alias("node"), parent.alias("parent"), "hash")
        )
        levels.append(level)
    children = F.array_sort(F.collect_list(F.struct("node", "hash")))
    written = F.array_join(F.transform(children, lambda c: F.concat_ws(":", c["node"], c["hash"])), ",")
    levels.append(settled(
        level.groupBy("archive").agg(F.sha2(written.cast("binary"), 256).alias("hash"))
        .select("archive", F.lit(0).cast("long").alias("node"), F.lit(None).cast("long").alias("parent"), "hash")
    ))
    return levels


def audit(primary: DataFrame, replica: DataFrame, ranges: tuple[int, ...] = RANGES) -> DataFrame:
    """Records that differ: (archive, offset, state), state damaged, missing or extra.

    Both have (archive, offset, length, sha256). Level by level, from the roots down, the
    children of the nodes that differ are compared; a node that one side lacks differs.
    Equal replicas and empty tables give no rows.
    """
    mine, theirs = merkle_levels(primary, ranges), merkle_levels(replica, ranges)
    differing = None
    for level, (a, b) in enumerate(zip(reversed(mine), reversed(theirs))):
        if differing is not None:
            above = differing.select("archive", F.col("node").alias("parent"))
            if level > 1:
                a, b = (x.join(above, ["archive", "parent"], "left_semi") for x in (a, b))
            else:  # the roots' children: all ranges of the archive
                a, b = (x.join(above.select("archive"), "archive", "left_semi") for x in (a, b))
        one = a.select("archive", "node", F.col("hash").alias("mine"))
        other = b.select("archive", "node", F.col("hash").alias("theirs"))
        differing = settled(one.join(other, ["archive", "node"], "full").filter(~F.col("mine").eqNullSafe(F.col("theirs"))))
    state = F.when(F.col("theirs").isNull(), "missing").when(F.col("mine").isNull(), "extra").otherwise("damaged")
    return differing.select("archive", F.col("node").alias("offset"), state.alias("state"))


def replicas(pages: DataFrame, per_archive: int = RECORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Two replicas of the pages' archives and what was done to the second.

    The second has the first character of about one page in 128 overwritten and about one
    record in 256 lost, by the hash of page_id. Repeated rows are records of their own; null
    columns are written as nothing; an empty table gives no archives.
    """
    page_id, url, html = F.col("page_id"), F.col("url"), F.col("html")
    mark = F.substring(F.md5(F.coalesce(page_id.cast("string"), F.lit("")).cast("binary")), 1, 2)
    wrong = F.when(mark.isin("07", "a3"), F.overlay(html, F.lit("\u0001"), F.lit(1), F.lit(1))).otherwise(html)
    record = warc_record(page_id, url, html)
    rows = pages.select(
        "page_id",
        "url",
        F.octet_length(record).cast("long").alias("length"),
        F.sha2(record, 256).alias("sha256"),
        F.sha2(warc_record(page_id, url, F.when(F.length(html) > 0, wrong).otherwise(html)), 256).alias("second"),
        (mark == "1f").alias("lost"),
    )
    placed = lay_out(rows, per_archive).checkpoint()
    first = placed.select("archive", "offset", "length", "sha256")
    second = placed.filter(~F.col("lost")).select("archive", "offset", "length", F.col("second").alias("sha256"))
    return first, second, placed


def op9_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the pages' archives that a damaged replica lacks or has wrong."""
    first, second, placed = replicas(table(spark, sf_dir, "pages"))
    found = audit(first, second)
    return found.join(placed, ["archive", "offset"]).select(
        "archive",
        "seq",
        F.col("offset").alias("record_offset"),
        F.col("length").alias("record_length"),
        "page_id",
        "state",
        F.col("sha256").alias("primary_sha256"),
        F.when(~F.col("lost"), F.col("second")).alias("replica_sha256"),
    )


def _record_sql(html: str) -> str:
    return (
        "'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'"
        " || coalesce(page_id::VARCHAR, '') || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')"
        " || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: '"
        f" || strlen(coalesce({html}, ''))::VARCHAR || chr(13) || chr(10) || chr(13) || chr(10) || coalesce({html}, '')"
        " || chr(13) || chr(10) || chr(13) || chr(10)"
    )


OP9_SQL = f"""
WITH marked AS (
  SELECT page_id, url, html, substr(md5(coalesce(page_id::VARCHAR, '')), 1, 2) AS mark FROM pages),
changed AS (
  SELECT *, CASE WHEN length(html) > 0 AND mark IN ('07', 'a3') THEN chr(1) || substr(html, 2) ELSE html END AS wrong
  FROM marked),
records AS (
  SELECT page_id, url, mark, strlen({_record_sql("html")})::BIGINT AS record_length,
    sha256({_record_sql("html")}) AS one, sha256({_record_sql("wrong")}) AS two FROM changed),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY page_id NULLS LAST, url NULLS LAST, one) - 1 AS position FROM records),
placed AS (
  SELECT *, position // {RECORDS} AS archive, position % {RECORDS} AS seq,
    (sum(record_length) OVER (PARTITION BY position // {RECORDS} ORDER BY position) - record_length)::BIGINT AS record_offset
  FROM numbered)
SELECT archive, seq, record_offset, record_length, page_id,
  CASE WHEN mark = '1f' THEN 'missing' ELSE 'damaged' END AS state,
  one AS primary_sha256, CASE WHEN mark = '1f' THEN NULL ELSE two END AS replica_sha256
FROM placed WHERE mark = '1f' OR one <> two"""
