"""The ids of accepted events, bucketed by hash, with one Bloom filter per bucket.

    <folder>/ids/batch=<n>/bucket=<b>/       event_id
    <folder>/filters/batch=<n>/              bucket, word, bitmap: 32 768 bits of the bucket's filter

A filter is a bitmap that Spark's own bitmap aggregates build and combine. A trigger first asks the filters which of its
ids may have been seen, and then reads the buckets of those ids only. A filter that has filled up answers yes more often
and costs reads, never a wrong result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

IDS, FILTERS = "event_id string, batch long, bucket int", "bucket int, word long, bitmap binary, batch long"


class Ledger:
    """``buckets``, ``bits`` (of one bucket's filter) and ``hashes`` must stay the same for a folder.

    Ten bits for each id keep false alarms at about one in a hundred: 64 filters of 2^17 bits, the default, serve 800 000
    ids with 1 MB; a billion ids want 4 096 of 2^22.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 64, bits: int = 1 << 17, hashes: int = 5) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self.buckets, self.bits, self.hashes = buckets, bits, hashes

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("event_id"), F.lit(self.buckets)).cast("int").alias("bucket")

    def _places(self) -> Column:
        """The bits of an id, counted from 1."""
        return F.array(*[F.pmod(F.xxhash64("event_id", F.lit(i)), F.lit(self.bits)) + 1 for i in range(self.hashes)])

    def _probes(self, ids: DataFrame) -> DataFrame:
        placed = ids.select("event_id", self._bucket(), F.explode(self._places()).alias("place"))
        word, bit = F.bitmap_bucket_number("place"), F.bitmap_bit_position("place")
        return placed.select("event_id", "bucket", word.alias("word"), bit.alias("bit"))

    # -- writing --------------------------------------------------------------------------------------------

    def add(self, ids: DataFrame, batch: int) -> None:
        """Note the ids (event_id) of a trigger. Doing it again for the same trigger replaces what it noted."""
        named = ids.select("event_id").where("event_id is not null")
        dealt = named.withColumn("bucket", self._bucket()).repartition("bucket")
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/ids/batch={batch}")
        self._filters(named).write.mode("overwrite").parquet(f"{self.folder}/filters/batch={batch}")

    def _filters(self, ids: DataFrame) -> DataFrame:
        return self._probes(ids).groupBy("bucket", "word").agg(F.bitmap_construct_agg("bit").alias("bitmap"))

    def compact(self, before: int) -> None:
        """Put what triggers up to, and without, ``before`` have noted into the folder of the last of them, so that ids
        and filters are in few files. ``before`` is the trigger that may still be replayed, or one before it.

        The joined rows are added before the folders of the others go; if that is interrupted ids are there twice, which
        does no harm.
        """
        ids, filters = self.ids(before), self._read("filters", FILTERS, before)
        last = ids.agg(F.max("batch")).first()[0]
        if last is None:
            return
        joined = ids.select("event_id", "bucket").distinct().repartition("bucket")
        joined.write.mode("append").partitionBy("bucket").parquet(f"{self.folder}/ids/batch={last}")
        whole = filters.groupBy("bucket", "word").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        whole.write.mode("append").parquet(f"{self.folder}/filters/batch={last}")
        for kind in ("ids", "filters"):
            root, store = self._store(kind)
            for status in store.listStatus(root):
                name = status.getPath().getName()
                if name.startswith("batch=") and int(name.removeprefix("batch=")) < last:
                    store.delete(status.getPath(), True)

    # -- reading --------------------------------------------------------------------------------------------

    def _store(self, kind: str):
        """A folder and the file system it is on, as Spark's own Hadoop classes."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{kind}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _read(self, kind: str, schema: str, before: int) -> DataFrame:
        path, store = self._store(kind)
        if not store.exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{kind}").where(F.col("batch") < before)

    def empty(self) -> bool:
        """Whether no trigger has noted anything yet."""
        return self._read("filters", FILTERS, 1 << 62).isEmpty()

    def ids(self, before: int, buckets: list[int] | None = None) -> DataFrame:
        """The ids noted by triggers before this one; only the folders of the given buckets are read."""
        found = self._read("ids", IDS, before)
        return found if buckets is None else found.where(F.col("bucket").isin(buckets))

    def perhaps(self, ids: DataFrame, before: int) -> DataFrame:
        """Those of the ids (event_id, each once) that the filters can't rule out, with their bucket."""
        filters = self._read("filters", FILTERS, before).groupBy("bucket", "word")
        whole = filters.agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        byte = F.expr("cast(conv(hex(substring(bitmap, cast(bit div 8 as int) + 1, 1)), 16, 10) as long)")
        hit = F.getbit(byte, (F.col("bit") % 8).cast("int")) == 1
        found = self._probes(ids).join(whole, ["bucket", "word"]).where(hit)
        return found.groupBy("event_id", "bucket").agg(F.count("*").alias("n")).where(F.col("n") == self.hashes).drop("n")

    def repeated(self, ids: DataFrame, before: int) -> DataFrame:
        """Those of the ids (event_id, each once) that an earlier trigger has noted."""
        perhaps = self.perhaps(ids, before)
        # At most one number for each bucket.
        buckets = sorted(row["bucket"] for row in perhaps.select("bucket").distinct().collect())
        seen = self.ids(before, buckets).select("event_id")
        return seen.join(perhaps.select("event_id"), "event_id", "left_semi").distinct()
