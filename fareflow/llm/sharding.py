"""Shards by extendible hashing.

The directory is indexed by the first bits of a row's hash. A bucket over the byte limit splits on
the next bit, and only such buckets do, until every shard fits. A row's key has 128 bits: the MD5 of
its id, then a hash of its content, then of its place in the written table, so rows of one id and
even equal rows can be told apart. Only a single row that is larger than the limit stays too large.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from fareflow.llm.columns import renamed
from fareflow.session import materialise

SHARD_BYTES = 1 << 20
#: Bits a pass looks beyond the depth at which average buckets fit; deeper buckets take another pass.
AHEAD = 3
KEY_BITS = 128


def _binary(hex_digits: Column, digits: int) -> Column:
    return F.lpad(F.conv(hex_digits, 16, 2), 4 * digits, "0")


def _prefix(depth: int) -> Column:
    """The first bits of a row's key."""
    low = lambda c: F.lpad(F.hex(F.col(c).bitwiseAND((1 << 32) - 1)), 8, "0")
    parts = [_binary(F.col("_head"), 16), _binary(low("_content"), 8), _binary(low("_place"), 8)]
    return F.substring(F.concat(*parts[:1 if depth <= 64 else 3]), 1, depth)


def assign(docs: DataFrame, limit: int = SHARD_BYTES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, shard, depth, n_bytes, shard_bytes, too_large) of every row.

    ``shard`` is the hash prefix of ``depth`` bits that its rows share, as 0s and 1s; one shard for
    all has depth 0 and the name ``''``. ``n_bytes`` is the length of the text in UTF-8, 0 for a null.
    A null id is hashed as an empty one. A shard of one row is never split; ``too_large`` marks it
    if the row alone is over the limit.
    """
    rows = renamed(docs, doc_id, text)
    digest = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    sized = materialise(rows.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        F.substring(digest, 1, 16).alias("_head"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_content")), "shard-rows")
    # The written rows keep their place, so it is the same however often they are read.
    left = sized.withColumn("_place", F.xxhash64(F.col("_metadata.file_name"), F.col("_metadata.row_index")))
    open_bytes = sized.agg(F.sum("n_bytes")).first()[0]
    depth, parts = 0, []
    while True:
        last = min(KEY_BITS, depth + max(1, math.ceil(math.log2(max(open_bytes or 0, 1) / limit))) + AHEAD)
        cells = left.groupBy(_prefix(last).alias("cell")).agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("n"))
        levels = (cells.withColumn("depth", F.explode(F.sequence(F.lit(depth), F.lit(last))))
                  .withColumn("shard", F.substring("cell", F.lit(1), F.col("depth"))))
        buckets = levels.groupBy("depth", "shard").agg(F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("shard_rows"))
        fit = buckets.where((F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1) | (F.col("depth") == KEY_BITS))
        directory = materialise(levels.join(fit, ["depth", "shard"]).groupBy("cell").agg(
            F.min(F.struct("depth", "shard", "shard_bytes")).alias("s")).select("cell", "s.*"), "shard-directory")
        placed = left.withColumn("cell", _prefix(last)).join(directory, "cell", "left")
        parts.append(placed.where("shard IS NOT NULL").select("doc_id", "shard", "depth", "n_bytes", "shard_bytes"))
        n_open, open_bytes = cells.join(directory, "cell", "left_anti").agg(F.count("*"), F.sum("bytes")).first()
        if not n_open:
            break
        left, depth = materialise(placed.where("shard IS NULL").select(*left.columns), "shard-overflow"), last
        open_bytes /= n_open
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("doc_id", "shard", F.col("depth").cast("long").alias("depth"), "n_bytes", "shard_bytes",
                      (F.col("shard_bytes") > limit).alias("too_large"))
