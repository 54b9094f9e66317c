"""WARC archives, and their index by external merge.

Writing: one record per page, text built by DataFrame functions and written by Spark's text
source (its line separator is the record separator, so each file is a WARC file). Of equal
payloads one is a full response, the others are revisit records without payload.

Reading: files are streamed record by record. Index: each reading task sorts its captures
locally into runs; runs are cut at key boundaries and sent to the key range they belong to,
where a loser tree merges the k sorted runs by URL key and capture time. Ranges in order are
then the globally ordered capture histories. Boundaries come from a bounded sample of keys
and only place the cuts; a URL with many captures is cut too, by time and id.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import app_folder, materialize
from . import textbytes as tb

SEPARATOR = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
FIRST_CAPTURE = "2024-01-01 00:00:00"
SAMPLE_KEYS = 20_000   # at most about so many keys are sampled for the boundaries
RANGE_ROWS = 50_000    # captures that one merge handles
RUN_ROWS = 20_000      # captures that a task sorts at a time
ENTRY = ("page_id long, url_key string, captured string, url string, record_type string, payload_bytes long, "
         "payload_digest string, refers_to long")


def base32_of_hex(hexed: Column) -> Column:
    """Upper-case base32 of a hex string of whole 5-digit (20-bit) groups."""
    out = []
    for group in range(8):
        number = F.conv(F.substring(hexed, 1 + 5 * group, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            out.append(F.substring(F.lit(BASE32), F.shiftright(number, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*out)


def records(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html", time_col: str | None = None) -> DataFrame:
    """One row per page with ``record``, the text of its WARC record.

    Equal payloads of at least ``min_bytes`` bytes: the record with the largest id is the
    response, those with smaller or null ids are revisits of it (rows that repeat the
    largest id are all responses). Null payloads are empty ones. Without ``time_col`` a
    capture's time is FIRST_CAPTURE plus the id in seconds.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    page = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.regexp_replace(F.col(url_col), r"[\x00-\x20]", "%20").alias("url"),
        html.alias("html"), F.sha1(html.cast("binary")).alias("hex"), F.octet_length(html).cast("long").alias("bytes"),
        (F.col(time_col).cast("timestamp") if time_col else F.timestamp_seconds(
            F.unix_timestamp(F.lit(FIRST_CAPTURE)) + F.pmod(F.coalesce(F.col(id_col).cast("long"), F.lit(0)), F.lit(1 << 31)))).alias("captured"))
    holders = (page.where(F.col("bytes") >= min_bytes).groupBy("hex")
               .agg(F.max("page_id").alias("holder"), F.count(F.lit(1)).alias("copies")).where("copies > 1").select("hex", "holder"))
    joined = page.join(holders, "hex", "left")
    revisit = F.col("holder").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("holder")))
    end = F.lit("\r\n")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes"), F.lit(SEPARATOR))
    body = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    fields = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")), end,
        F.coalesce(F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.col("page_id"), F.lit(">"), end), F.lit("")),
        F.lit("WARC-Date: "), F.date_format("captured", "yyyy-MM-dd'T'HH:mm:ss'Z'"), end,
        F.coalesce(F.concat(F.lit("WARC-Target-URI: "), F.col("url"), end), F.lit("")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("holder"), F.lit(">"), end,
                                 F.lit("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"), end))
        .otherwise(F.lit("")),
        F.lit("WARC-Payload-Digest: sha1:"), base32_of_hex(F.col("hex")), end,
        F.lit("Content-Type: application/http; msgtype=response"), end,
        F.lit("Content-Length: "), F.octet_length(head) + F.octet_length(body))
    return joined.select(F.concat(fields, F.lit(SEPARATOR), head, body).alias("record"))


def write_archives(recs: DataFrame, path: str, records_per_file: int = 100_000, compression: str = "gzip") -> None:
    (recs.write.mode("overwrite").option("lineSep", SEPARATOR).option("compression", compression)
     .option("maxRecordsPerFile", records_per_file).text(path))


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels reversed (without www.), port, path and query,
    lower-case host; an address that cannot be split is its own key."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        return url
    labels = host.removeprefix("www.").split(".")
    query = f"?{parts.query}" if parts.query else ""
    return ",".join(reversed(labels)) + (f":{port}" if port else "") + ")" + (parts.path or "/") + query


def parse_records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of each record of a stream that was parted at
    the separator, which blocks may hold too. Blank lines between records are skipped."""
    held = bytearray()
    for piece in pieces:
        held += piece
        held += b"\r\n\r\n"
        while True:
            skip = 0
            while held[skip:skip + 2] == b"\r\n":
                skip += 2
            if skip:
                del held[:skip]
            end = held.find(b"\r\n\r\n")
            if end < 0:
                break
            lines = held[:end].decode("utf-8", "replace").split("\r\n")
            fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            need = end + 4 + int(fields["content-length"])
            if len(held) < need + 4:  # the separator after the block
                break
            yield fields, bytes(held[end + 4:need])
            del held[:need]


def _page(name: str | None) -> int | None:
    return int(name[len("<urn:page:"):-1]) if name else None


def may_split(spark, path: str) -> bool:
    """Whether Spark may cut a file under ``path`` into several parts: it is not gzip and is
    longer than the least size of a part."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    least = min(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes(), spark._jsparkSession.sessionState().conf().filesOpenCostInBytes())
    files = folder.getFileSystem(conf).listFiles(folder, True)
    while files.hasNext():
        file = files.next()
        if not file.getPath().getName().endswith(".gz") and file.getLen() > least:
            return True
    return False


def read_archives(spark, path: str) -> DataFrame:
    """Captures of all records of the archives under ``path``; the digest of a response is
    recomputed from its payload, and payload_bytes of a revisit is what its HTTP head says.
    Only a record's length tells where it ends, so a file is read from its start in one
    stream: gzip files are not cut by Spark, parts of others are brought together in order."""
    def read(batches):
        def pieces():
            for batch in batches:
                for value in batch.column(0):
                    yield value.as_buffer().to_pybytes() if value.is_valid else b""
        rows = []
        for fields, block in parse_records(pieces()):
            head, _, payload = block.partition(b"\r\n\r\n")
            said = int(head.rsplit(b":", 1)[1])
            full = fields["warc-type"] == "response"
            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode() if full else fields["warc-payload-digest"].partition(":")[2]
            if full and (digest != fields["warc-payload-digest"].partition(":")[2] or len(payload) != said):
                raise ValueError(f"damaged record {fields.get('warc-record-id')}")
            url = fields.get("warc-target-uri")
            rows.append((_page(fields.get("warc-record-id")), url_key(url), fields["warc-date"], url, fields["warc-type"],
                         said, digest, _page(fields.get("warc-refers-to"))))
            if len(rows) >= 5000:
                yield _batch(rows)
                rows = []
        yield _batch(rows)
    pieces_read = spark.read.option("lineSep", SEPARATOR).text(path)
    if may_split(spark, path):
        order = ["file", "part", "place"]
        pieces_read = (pieces_read.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part"),
                                          F.monotonically_increasing_id().alias("place"))
                       .repartition("file").sortWithinPartitions(*order).select("value"))
    return pieces_read.mapInArrow(read, ENTRY)


_TYPES = pa.schema([("page_id", pa.int64()), ("url_key", pa.string()), ("captured", pa.string()), ("url", pa.string()),
                    ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())])


def _batch(rows: list[tuple], schema: pa.Schema = _TYPES) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


# --- external merge -------------------------------------------------------------------------

class LoserTree:
    """Merges k sorted iterators of (key, value): each inner node keeps the loser of its
    match, so the next winner takes one comparison per level."""

    def __init__(self, runs: list[Iterator]):
        self.runs = runs
        self.k = max(1, len(runs))
        self.heads = [next(r, None) for r in runs] or [None]
        self.tree = [-1] * self.k
        for leaf in range(self.k - 1, -1, -1):
            self._play(leaf)

    def _before(self, a: int, b: int) -> bool:
        """Run a's head comes before run b's (an ended run is last, ties: the lower run)."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x[0], a) < (y[0], b)

    def _play(self, leaf: int) -> None:
        node, winner = (leaf + self.k) >> 1, leaf
        while node > 0:
            other = self.tree[node]
            if other < 0:  # while building: wait here for the opponent
                self.tree[node] = winner
                return
            if self._before(other, winner):
                self.tree[node], winner = winner, other
            node >>= 1
        self.tree[0] = winner

    def __iter__(self):
        while self.heads[self.tree[0]] is not None:
            winner = self.tree[0]
            yield self.heads[winner]
            self.heads[winner] = next(self.runs[winner], None)
            self._play(winner)


_NUMBERED = _TYPES.append(pa.field("row", pa.int64()))


def _key(row: tuple) -> tuple:
    """URL key, time, id, row number; a null id comes first."""
    return (row[1], row[2], -1 << 63 if row[0] is None else row[0], row[len(_TYPES)])


def _rows(batch: pa.RecordBatch | pa.Table, columns: int) -> list[tuple]:
    return list(zip(*(batch.column(c).to_pylist() for c in range(columns))))


def sorted_runs(captures: DataFrame, boundaries: list[tuple]) -> DataFrame:
    """Runs: numbered captures with the key range, run number and place in the run."""
    from bisect import bisect_right
    schema = _NUMBERED
    for name in ("bucket", "run", "place"):
        schema = schema.append(pa.field(name, pa.int64()))

    def sort(batches):
        from pyspark import TaskContext
        task, number, held = TaskContext.get().partitionId(), 0, []

        def run():
            held.sort(key=_key)
            return _batch([(*r, bisect_right(boundaries, _key(r)), (task << 32) + number, place) for place, r in enumerate(held)], schema)
        for batch in batches:
            rows = _rows(batch, len(_NUMBERED))
            while rows:
                cut = RUN_ROWS - len(held)
                held, rows = held + rows[:cut], rows[cut:]
                if len(held) >= RUN_ROWS:
                    yield run()
                    number, held = number + 1, []
        if held:
            yield run()
    return captures.mapInArrow(sort, ENTRY + ", row long, bucket long, run long, place long")


def merge_runs(runs: DataFrame) -> DataFrame:
    """Captures with ``bucket`` and ``position``: in their order, all captures are ordered
    by URL key, time and id."""
    schema = _TYPES.append(pa.field("bucket", pa.int64())).append(pa.field("position", pa.int64()))

    def merge(batches):
        for table in tb.groups(batches, ["bucket"]):
            bucket = table.column("bucket")[0].as_py()
            rows = _rows(table, len(_NUMBERED))
            run = table.column("run").to_numpy()
            cuts = [0, *(np.flatnonzero(run[1:] != run[:-1]) + 1).tolist(), len(rows)]
            tree = LoserTree([iter([(_key(r), r) for r in rows[a:b]]) for a, b in zip(cuts[:-1], cuts[1:])])
            yield _batch([(*r[:len(_TYPES)], bucket, position) for position, (_, r) in enumerate(tree)], schema)
    ordered = runs.repartition("bucket").sortWithinPartitions("bucket", "run", "place")
    return ordered.mapInArrow(merge, ENTRY + ", bucket long, position long")


def merged_index(captures: DataFrame, label: str = "captures") -> DataFrame:
    """Globally ordered capture histories of a capture table, by external merge. The sample
    for the boundaries has about SAMPLE_KEYS rows, however often a key repeats."""
    captures = materialize(captures.withColumn("row", F.monotonically_increasing_id()), label)
    total = captures.count()
    every = max(1, total // SAMPLE_KEYS)
    picked = captures.where(F.pmod(F.xxhash64("url_key", "captured", "page_id", "row"), F.lit(every)) == 0)
    keys = sorted(_key(tuple(r)) for r in picked.toLocalIterator())
    ranges = min(total // RANGE_ROWS + 1, len(keys) or 1)
    boundaries = sorted({keys[len(keys) * k // ranges] for k in range(1, ranges)})
    return merge_runs(sorted_runs(captures, boundaries))


def archive_and_index(pages: DataFrame, path: str | None = None, min_bytes: int = 0, label: str = "warc", **options) -> DataFrame:
    """Writes the pages' archives (to ``path`` or a folder of this application), reads them
    back and returns the merged index: one row per page with page_id, url_key, captured,
    url, record_type, payload_bytes, payload_digest, refers_to, bucket and position.

    Null ids, urls and payloads are kept as such (payload: empty); repeated rows are records
    of their own; other columns are not read; an empty table gives no rows.
    """
    import uuid
    spark = pages.sparkSession
    path = path or f"{app_folder(spark)}/{label}-{uuid.uuid4().hex}"
    write_archives(records(pages, min_bytes, **options), path)
    return merged_index(read_archives(spark, path), label)


def _sql_base32(hexed: str) -> str:
    parts = [f"substr('{BASE32}', CAST((('0x' || substr({hexed}, {1 + 5 * g}, 5))::INT >> {s}) & 31 AS INT) + 1, 1)"
             for g in range(8) for s in (15, 10, 5, 0)]
    return " || ".join(parts)


SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS holder FROM p)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, {_sql_base32('x')} AS payload_digest,
  CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = holder THEN NULL ELSE holder END AS refers_to FROM m
"""
