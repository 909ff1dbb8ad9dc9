"""Silver documents batch by batch, with the survivors that one run over all batches would have.

State is a table with a row for each checksum seen: the least ``ord`` of its documents so far. A batch is cleaned and gated on its own; of its documents, those go
in whose checksum is new, or came with a greater ``ord`` before. Documents are appended by batch and never rewritten; one that a late
batch supersedes is told by the state, which ``survivors`` joins. State replaces state whole or not at all, and
a batch that is run again gives what it gave, so a run may stop anywhere and be repeated.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import medallion
from ..sources import files
from ..store import scope


@dataclass
class Increments:
    """``root`` holds ``documents`` and ``chunks`` (a folder each batch) and ``state``."""

    spark: SparkSession
    root: str
    config: medallion.Config = field(default_factory=medallion.Config)

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def state(self) -> DataFrame:
        """(checksum, first): what has been seen."""
        if files.recovered(self.spark, self.path("state")):
            return self.spark.read.parquet(self.path("state"))
        return self.spark.createDataFrame([], "checksum string, first long")

    def ingest(self, bronze: DataFrame, batch: int) -> int:
        """Take in a batch of bronze documents (``ord`` told over all batches); returns how many went in."""
        with scope(self.spark):
            documents = medallion.silver_documents(medallion.cleaned(bronze, self.config), self.config)
            known = documents.join(self.state(), F.col("checksum_sha256") == F.col("checksum"), "left")
            # equal: this batch's own row, from a run before
            fresh = known.filter(F.col("first").isNull() | (F.col("ord") <= F.col("first"))).drop("checksum", "first")
            files.write_table(fresh, self.path("documents", f"batch={batch}"))
            fresh = self.spark.read.parquet(self.path("documents", f"batch={batch}"))
            files.write_table(medallion.silver_chunks(fresh, self.config), self.path("chunks", f"batch={batch}"))
            told = self.state().unionByName(fresh.select(F.col("checksum_sha256").alias("checksum"), F.col("ord").alias("first")))
            files.write_table(told.groupBy("checksum").agg(F.min("first").alias("first")), self.path("state"))
            return fresh.count()

    def survivors(self) -> DataFrame:
        """The documents that one run over all batches keeps."""
        d, s = self.spark.read.parquet(self.path("documents")).drop("batch"), self.state()
        return d.join(s, (F.col("checksum_sha256") == F.col("checksum")) & (F.col("ord") == F.col("first")), "left_semi")

    def surviving_chunks(self) -> DataFrame:
        """Their chunks."""
        kept = self.survivors().select(F.col("ord").alias("_ord"))
        return self.spark.read.parquet(self.path("chunks")).drop("batch").join(kept, F.col("ord.doc") == F.col("_ord"), "left_semi")

    def follow(self, stream: DataFrame, checkpoint: str) -> None:
        """Take in what a stream of bronze documents has, a micro-batch at a time, then stop; a rerun takes up the rest."""
        q = stream.writeStream.foreachBatch(lambda df, n: self.ingest(df.drop("arrived"), n) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        q.awaitTermination()
