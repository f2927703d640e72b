"""Contiguous shards of near-equal bytes from global prefix sums (native)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .prefix import SUB, ZONE, prefix_sums

LAW = "bytes"
#: Rows of one file that are sorted together, when a shard's rows keep an order of files and rows.
BLOCK = 4096


def shard(docs: DataFrame, n_shards: int = 24, overhead: int = 8, order: tuple[str, str] | None = None) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, any other columns) with its shard.

    Adds ``size`` (UTF-8 bytes of the text plus ``overhead``; a NULL text has
    no bytes), ``text_crc32`` (0 for a NULL text), ``law`` = 'bytes',
    ``shard``, ``slot`` and ``grown_shard`` (NULL: only a key law has one).
    Existing columns of these names are replaced.

    Rows stand in one global order: first 12 bits of md5(text), then
    md5(doc_id), then md5(text).  Equal texts so lie in one narrow zone of it
    and in one shard unless a cut falls in their zone, while a text that a
    third of all rows share is still split over many buckets.  A row belongs
    to the shard in which the middle of its bytes falls when all bytes are
    cut at equal targets, so shards differ by less than one row's size.
    Slots count from 0 without gaps.  Rows equal in id and text are
    interchangeable; an empty table gives no rows.

    ``order`` names two columns without NULLs, of which no two rows hold the
    same: a file, and a row's number in it.  The shards are the same, but
    their slots follow that order.  The two columns are not returned.
    """
    names = ("size", "text_crc32", "law", "shard", "slot", "grown_shard", "_text", "_doc", ZONE, SUB)
    place = list(order or ())
    rows = docs.drop(*names).withColumns({
        "size": (F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(overhead)).cast("long"),
        "text_crc32": F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long"),
        "_text": F.md5(F.coalesce("text", F.lit(""))),
        "_doc": F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))),
    })
    rows = rows.withColumns({ZONE: F.substring("_text", 1, 3), SUB: F.substring("_doc", 1, 2)})

    def placed(x: DataFrame) -> DataFrame:
        x = prefix_sums(x, [], ["_doc", "_text", *place], {"_before": F.col("size"), "_row": F.lit(1).cast("long")})
        total = rows.agg(F.sum("size").alias("_total")).scalar()
        return x.withColumn("_total", total).withColumn("shard", F.expr(f"(2 * _before + size) * {n_shards} div (2 * _total)").cast("int"))

    # neither branch below carries texts
    light = placed(rows.select("size", "_text", "_doc", ZONE, SUB, *place))
    if order:
        file, row = place
        light = light.withColumns({ZONE: F.col(file), SUB: F.floor(F.col(row) / BLOCK)})
        light = prefix_sums(light, ["shard"], [row], {"slot": F.lit(1).cast("long")})
        out = rows.join(light.select(*place, "shard", "slot"), place)
    else:
        first = light.groupBy("shard").agg(F.min("_row").alias("_first"))  # one row per shard
        out = placed(rows).join(F.broadcast(first), "shard").withColumn("slot", F.col("_row") - F.col("_first"))
    out = out.withColumns({"law": F.lit(LAW), "grown_shard": F.lit(None).cast("int")})
    kept = [c for c in docs.columns if c not in (*names, *place)]
    return out.select(*kept, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
