"""Seen-item sets as bitmaps (A18), one row per (user, bucket of 32,768 ids, word).

A bucket is cut into words of 64 ids, one bit each, and only words with a bit are
rows: a user's set takes at most one row of 8 bytes an item, however far apart
the ids lie, built by partial aggregation (bitwise OR); no task holds a user's
items as a list. Membership is an equi-join on (user, bucket, word) and one bit
test; what a user has of another set is the bitwise AND of two words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = 64                    # ids of a word
STEP = 100_000               # words unpacked at once


def _place(item: str):
    """(bucket, word, bit) columns of an id."""
    at = F.bitmap_bit_position(item)
    return F.bitmap_bucket_number(item), F.shiftright(at, 6).cast("int"), at.bitwiseAND(F.lit(WORD - 1)).cast("int")


def _bit(bit):
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)


def seen_bitmaps(pairs: DataFrame, user: str = "userId", item: str = "movieId") -> DataFrame:
    """(user, bucket, word, seen) of the distinct pairs without nulls."""
    rows = pairs.where(F.col(user).isNotNull() & F.col(item).isNotNull())
    bucket, word, bit = _place(item)
    return rows.groupBy(user, bucket.alias("bucket"), word.alias("word")).agg(F.bit_or(_bit(bit)).alias("seen"))


def is_seen(rows: DataFrame, bitmaps: DataFrame, user: str = "userId", item: str = "movieId") -> DataFrame:
    """``rows`` with a boolean ``is_seen``."""
    bucket, word, bit = _place(item)
    held = bitmaps.select(F.col(user).alias("_u"), F.col("bucket").alias("_c"), F.col("word").alias("_v"), "seen")
    j = rows.withColumn("_b", bucket).withColumn("_w", word).join(
        held, (F.col(user) == F.col("_u")) & (F.col("_b") == F.col("_c")) & (F.col("_w") == F.col("_v")), "left")
    return j.withColumn("is_seen", F.coalesce(F.col("seen").bitwiseAND(_bit(bit)) != 0, F.lit(False))).drop("_b", "_w", "_u", "_c", "_v", "seen")


def unseen_counts(bitmaps: DataFrame, users: DataFrame, items: DataFrame, user: str = "userId", item: str = "movieId") -> DataFrame:
    """(user, n_unseen): how many of the few ``items`` each user has not seen."""
    bucket, word, bit = _place(item)
    wanted = items.groupBy(bucket.alias("bucket"), word.alias("word")).agg(F.bit_or(_bit(bit)).alias("wanted"))
    total = items.select(item).distinct().count()
    both = bitmaps.join(F.broadcast(wanted), ["bucket", "word"])                # at most one row for each of the few items
    common = both.groupBy(user).agg(F.sum(F.bit_count(F.col("seen").bitwiseAND(F.col("wanted")))).alias("n"))
    return users.join(common, user, "left").select(user, (F.lit(total) - F.coalesce("n", F.lit(0))).alias("n_unseen"))


def _ids(batches):
    for batch in batches:
        words = batch.column("words")
        n = np.diff(np.asarray(words.offsets))
        flat = words.flatten()
        word, seen = np.asarray(flat.field("word"), np.int64), np.asarray(flat.field("seen"), "<i8")
        first = np.repeat(np.asarray(batch.column("bucket"), np.int64), n)
        row = np.repeat(np.arange(len(words)), n)
        ids, size = [np.zeros(0, np.int64)], np.zeros(len(words), np.int64)
        for lo in range(0, len(seen), STEP):
            bits = np.unpackbits(np.ascontiguousarray(seen[lo:lo + STEP]).view(np.uint8), bitorder="little").reshape(-1, WORD)
            at, bit = np.nonzero(bits)
            f, b = first[lo + at], word[lo + at] * WORD + bit
            ids.append(np.where(f > 0, (f - 1) * 32768 + 1 + b, f * 32768 - b))
            size += np.bincount(row[lo + at], minlength=len(words))
        ids, owner = np.concatenate(ids), np.repeat(np.arange(len(words)), size)
        ids = ids[np.lexsort((ids, owner))]
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(ids, pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column("bucket"), lists], names=[batch.schema.names[0], "bucket", "items"])


def seen_lists(bitmaps: DataFrame, user: str = "userId") -> DataFrame:
    """(user, bucket, items): the ids of each bucket, ascending; 32,768 at most
    (512 words)."""
    rows = bitmaps.groupBy(user, "bucket").agg(F.array_sort(F.collect_list(F.struct("word", "seen"))).alias("words"))
    return rows.mapInArrow(_ids, f"{user} {dict(bitmaps.dtypes)[user]}, bucket bigint, items array<bigint>")
