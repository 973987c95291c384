"""WARC records and a Merkle fixity audit of their replicas (operator 10).

Pages become WARC/1.1 response records, dealt by their digests to files of about `file_bytes`
and laid out in order of their ids, so each record has an offset range. A tree is built over
each file's ordered ranges: a leaf is the digest of a record with its offset range, a node
the digest of up to `FANOUT` children with theirs, and file roots are the leaves of a tree
over all files, whose root is the replica's. An audit compares the replica roots first, and
ends there if they agree; then a level's children are looked at only below nodes that
differ, so the work goes to the mismatching branches. All of it is grouping, hashing and
joining in built-in functions; no group is larger than `FANOUT`, and windows rank one file
at a time.

Defined results: null addresses and bodies count as empty; null ids come first in their file;
records with one id are ordered by their content, equal ones in any order; a record that only
one replica holds is `missing` or `extra`, one with other content `corrupt`, one that only
lies elsewhere in its file `moved`; empty replicas have no nodes and agree; columns of the
pages besides id, address and body are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

FANOUT = 16
FILE_BYTES = 4 << 20
#: Fixed value: records carry no clock of their own.
DATE = "2024-01-01T00:00:00Z"


def warc_record(url: Column, body: Column) -> Column:
    """One response record as text, its lengths in UTF-8 bytes."""
    body, url = F.coalesce(body, F.lit("")), F.coalesce(url, F.lit(""))
    digest = F.sha2(F.concat(url, F.lit("\n"), body), 256)
    identity = F.concat_ws("-", *[F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), url,
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Record-ID: <urn:uuid:"), identity,
        F.lit(">\r\nWARC-Block-Digest: sha256:"), F.sha2(body, 256),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    )


def records(pages: DataFrame, *, file_bytes: int = FILE_BYTES, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """page_id, file, place (0, 1, ... within the file), offset, length, digest of every page's record."""
    record = warc_record(F.col(url_col), F.col(body_col))
    base = common.saved(pages.select(F.col(id_col).alias("page_id"), record.alias("record")).select("page_id", F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("digest")), "warc-records")
    total = base.agg(F.sum("length").alias("n")).first().n or 0
    files = max(1, -(-int(total) // file_bytes))
    each = Window.partitionBy("file").orderBy("page_id", "digest")
    return (
        base.withColumn("file", F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") % F.lit(files))
        .withColumn("place", F.row_number().over(each).cast("long") - 1)
        .withColumn("offset", F.sum("length").over(each.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length"))
        .select("page_id", "file", "place", "offset", "length", "digest")
    )


def node_digest(children: str, at: str) -> Column:
    """Digest over the children's places, offset ranges and digests, in order."""
    return F.sha2(F.concat_ws("|", F.transform(children, lambda c: F.concat_ws(":", c[at].cast("string"), c["start"].cast("string"), c["stop"].cast("string"), c["digest"]))), 256)


def level_above(nodes: DataFrame) -> DataFrame:
    """nodes (file, place, start, stop, digest) -> their parents, each over FANOUT neighbours and their offset range."""
    return nodes.groupBy("file", F.floor(F.col("place") / FANOUT).cast("long").alias("parent")).agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.sort_array(F.collect_list(F.struct("place", "start", "stop", "digest"))).alias("children")
    ).select("file", F.col("parent").alias("place"), "start", "stop", node_digest("children", "place").alias("digest"))


def height(most: int) -> int:
    """Levels above leaves with places up to most."""
    n = 0
    while most > 0:
        most, n = most // FANOUT, n + 1
    return n


def merkle_tree(held: DataFrame, below: int, above: int) -> list[DataFrame]:
    """held: records of a replica. The levels from the records to one node a file (`below` steps up), then over the files to the root (`above` more)."""
    out = [common.saved(held.select("file", "place", F.col("offset").alias("start"), (F.col("offset") + F.col("length")).alias("stop"), "digest"), "merkle-leaves")]
    for k in range(below):
        out.append(common.saved(level_above(out[-1]), f"merkle-level-{k + 1}"))
    roots = out[-1].select(F.lit(0).cast("long").alias("file"), F.col("file").cast("long").alias("place"), "start", "stop", "digest")
    for k in range(above):
        roots = common.saved(level_above(roots), f"merkle-files-{k + 1}")
        out.append(roots)
    return out


def differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """(file, place) of nodes that differ or that one side lacks."""
    a, b = (x.select("file", "place", F.struct("digest", "start", "stop").alias(d)) for x, d in ((left, "a"), (right, "b")))
    return a.join(b, ["file", "place"], "full_outer").filter(~F.col("a").eqNullSafe(F.col("b")))


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """Records (page_id, file, place, offset, length, digest) of two replicas -> the places that differ: file, place, status."""
    most = first.unionByName(second).agg(F.max("place").alias("n"), F.max("file").alias("f")).first()
    below, above = height(most.n or 0), height(most.f or 0)
    one, two = merkle_tree(first, below, above), merkle_tree(second, below, above)
    status = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").when(F.col("a.digest") != F.col("b.digest"), "corrupt").otherwise("moved")

    def narrowed(nodes: DataFrame, bad: DataFrame, *, by_file: bool) -> DataFrame:
        """nodes below the bad ones"""
        if by_file:
            return nodes.join(bad.select(F.col("place").alias("file")), "file", "left_semi")
        parents = bad.select("file", F.col("place").alias("parent"))
        return nodes.withColumn("parent", F.floor(F.col("place") / FANOUT).cast("long")).join(parents, ["file", "parent"], "left_semi").drop("parent")

    bad = differing(one[-1], two[-1])
    if not bad.limit(1).count():  # the replica roots agree
        return bad.select("file", "place", status.alias("status"))
    for k in range(len(one) - 2, -1, -1):
        if k >= below:  # a level over files: the lowest of them are the file roots by number
            over = [t[k] if k > below else t[k].select(F.lit(0).cast("long").alias("file"), F.col("file").cast("long").alias("place"), "start", "stop", "digest") for t in (one, two)]
            bad = differing(*(narrowed(x, bad, by_file=False) for x in over))
        else:
            files = k == below - 1 and above > 0
            bad = differing(*(narrowed(t[k], bad, by_file=files) for t in (one, two)))
    if above and not below:
        bad = differing(*(narrowed(t[0], bad, by_file=True) for t in (one, two)))
    return bad.select("file", "place", status.alias("status"))


def replica_root(held: DataFrame) -> DataFrame:
    """One row: the digest of the root over all files."""
    most = held.agg(F.max("place").alias("n"), F.max("file").alias("f")).first()
    return merkle_tree(held, height(most.n or 0), height(most.f or 0))[-1].select("digest")


def op10_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as records, and where a second replica differs.

    The second replica stands for storage that decays: every 97th page (by id, remainder
    13) has its first byte changed and every 193rd (remainder 5) is lost.
    """
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    kept = common.saved(records(pages), "warc-layout")
    body = F.coalesce(F.col("html"), F.lit(""))
    stored = F.when(F.col("page_id") % 97 == 13, F.concat(F.lit("~"), F.substring(body, 2, 2147483647))).otherwise(body)
    second = pages.filter("page_id IS NULL OR page_id % 193 <> 5").select(F.col("page_id").alias("id"), F.sha2(warc_record(F.col("url"), body), 256).alias("was"), F.sha2(warc_record(F.col("url"), stored), 256).alias("now"))
    second = second.dropDuplicates(["id", "was"])
    decayed = kept.join(second, kept["page_id"].eqNullSafe(second["id"]) & (kept["digest"] == second["was"])).select("page_id", "file", "place", "offset", "length", F.col("now").alias("digest"))
    found = audit(kept, common.saved(decayed, "warc-replica"))
    return kept.join(found, ["file", "place"], "left").select("page_id", F.col("file").cast("long").alias("file"), "place", "offset", "length", F.col("digest").alias("record_sha256"), F.coalesce("status", F.lit("intact")).alias("status"))


ORACLE = rf"""
WITH d AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html,
         sha256(coalesce(url, '') || chr(10) || coalesce(html, '')) AS h FROM pages),
r AS (
  SELECT page_id, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url
      || chr(13) || chr(10) || 'WARC-Date: {DATE}' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:uuid:'
      || substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) || '>'
      || chr(13) || chr(10) || 'WARC-Block-Digest: sha256:' || sha256(html) || chr(13) || chr(10) || 'Content-Type: text/html'
      || chr(13) || chr(10) || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10) || html
      || chr(13) || chr(10) || chr(13) || chr(10) AS record FROM d),
m AS (SELECT page_id, CAST(strlen(record) AS BIGINT) AS length, sha256(record) AS record_sha256 FROM r),
f AS (SELECT *, CAST(('0x' || substr(record_sha256, 1, 8)) AS BIGINT) % (SELECT greatest(1, CAST(ceil(sum(length) / {float(FILE_BYTES)}) AS BIGINT)) FROM m) AS file FROM m)
SELECT page_id, file, row_number() OVER w - 1 AS place,
       CAST(sum(length) OVER (PARTITION BY file ORDER BY page_id, record_sha256 ROWS UNBOUNDED PRECEDING) - length AS BIGINT) AS "offset",
       length, record_sha256,
       CASE WHEN page_id % 193 = 5 THEN 'missing' WHEN page_id % 97 = 13 THEN 'corrupt' ELSE 'intact' END AS status
FROM f WINDOW w AS (PARTITION BY file ORDER BY page_id, record_sha256)
"""
