"""A band index on disk that later crawls are merged into.

Two tables below a folder only ever grow. ``buckets`` has a row for each band
hash seen so far, with one document of that bucket; ``forest`` has a row for
each document that is not the smallest of its group, with a smaller document of
the same group. Both are bucketed by the keys they are joined on, so a merge
reads them without shuffling them, and no document of an earlier crawl is
signed again: a later crawl meets the buckets, the groups it ties together are
joined, and roots that stop being roots get a parent. A document becomes a
child once, so rows are never rewritten.

A merge writes its rows under the next number of a generation and is part of
the index once a file with that number exists, which is made in one step. What
a merge that was broken off has left is not read, and the next merge takes
another number.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.operators.components import connected_components
from sievemark.operators.minhash import MinhashConfig, band_table, bands, star_edges
from sievemark.storage import discard, materialize

N_BUCKETS = 64


@dataclass(frozen=True)
class BandIndex:
    """The index in a folder that all executors reach.

    ``n_buckets``, the type of the ids and ``cfg`` are fixed when the folder is
    new. A table's bucket is read by one task, so their number should follow
    the size that the index is to reach. Groups are named by their smallest id.
    """

    spark: SparkSession
    folder: str
    cfg: MinhashConfig = MinhashConfig()
    n_buckets: int = N_BUCKETS
    id_type: str = "string"

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder.rstrip('/')}/{name}")

    def _files(self, name: str) -> list[str]:
        path = self._path(name)
        store = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return [f.getPath().getName() for f in store.listStatus(path)] if store.exists(path) else []

    def _mark(self, name: str) -> bool:
        """Make an empty file; false if it is there. One caller at most is told that it made it."""
        path = self._path(name)
        store = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            return bool(store.createNewFile(path))
        except Exception:  # some stores raise where others return false
            if store.exists(path):
                return False
            raise

    def generations(self) -> list[int]:
        """Numbers of the merges that ended."""
        return sorted(int(n) for n in self._files("merged") if n.isdigit())

    def _begin(self) -> int:
        """A number that no other merge has or had."""
        number = max([0, *[int(n) for n in self._files("begun") if n.isdigit()]]) + 1
        while not self._mark(f"begun/{number}"):
            number += 1
        return number

    def _table(self, name: str, schema: str, keys: tuple[str, ...]) -> str:
        """The table's name in this session's catalog; its rows are the files below the folder."""
        known = f"sievemark_{name}_{hashlib.md5(self.folder.encode()).hexdigest()}"
        path = f"{self.folder.rstrip('/')}/{name}"
        columns = ", ".join(keys)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {known} ({schema}) USING parquet CLUSTERED BY ({columns}) SORTED BY ({columns}) INTO {self.n_buckets} BUCKETS LOCATION '{path}'"
        )
        self.spark.catalog.refreshTable(known)
        return known

    def _read(self, table: str) -> DataFrame:
        """Rows of the merges that ended."""
        return self.spark.table(table).where(F.col("generation").isin(self.generations() or [-1])).drop("generation")

    def _append(self, rows: DataFrame, table: str, keys: tuple[str, ...], generation: int) -> None:
        numbered = rows.withColumn("generation", F.lit(generation)).repartition(self.n_buckets, *keys)
        numbered.sortWithinPartitions(*keys).write.insertInto(table)

    def _buckets_table(self) -> str:
        return self._table("buckets", f"band int, band_hash binary, member {self.id_type}, generation int", ("band", "band_hash"))

    def _forest_table(self) -> str:
        return self._table("forest", f"id {self.id_type}, parent {self.id_type}, generation int", ("id",))

    def buckets(self) -> DataFrame:
        """``band, band_hash, member``: one document of each bucket."""
        return self._read(self._buckets_table())

    def forest(self) -> DataFrame:
        """``id, parent`` of the documents that aren't the smallest of their group."""
        return self._read(self._forest_table())

    def _roots(self, ids: DataFrame) -> DataFrame:
        """``id, root`` of distinct ``id``: parents are followed until none has a parent.

        A path is no longer than the number of merges.
        """
        followed = materialize(ids.select("id", F.col("id").alias("root")), "roots")
        for _ in self.generations():
            up = self.forest().select(F.col("id").alias("root"), F.col("parent").alias("_up"))
            before, moved = followed, followed.join(up, "root", "left")
            followed = materialize(moved.select("id", F.coalesce("_up", "root").alias("root"), F.col("_up").isNotNull().alias("_moved")), "roots")
            discard(before)
            if not followed.where("_moved").limit(1).count():
                break
        return followed.select("id", "root")

    def merge(self, docs: DataFrame, id_col: str = "id", text: str = "text") -> int:
        """Add a crawl's documents; returns the number of the merge.

        Texts without a shingle and null ids are not indexed; a crawl without
        other texts adds nothing. Documents that were merged before are tied to
        whatever they resemble now as well, and keep what they were tied to.
        """
        keys = ("band", "band_hash")
        number = self._begin()
        slim = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast(self.id_type).alias("id"), F.col(text).alias("text"))
        signed = materialize(band_table(slim, "id", "text", self.cfg), "new-bands")
        inside = star_edges(signed, "id", self.cfg).select(F.col("child").alias("x"), F.col("parent").alias("y"))
        new = bands(signed, "id").groupBy(*keys).agg(F.min("id").alias("_new"))
        # The new side is dealt out as the old one lies, which stays where it is.
        met = materialize(new.repartition(self.n_buckets, *keys).join(self.buckets(), list(keys), "left").select(*keys, "_new", "member"), "met")
        across = met.where(F.col("member").isNotNull()).select(F.col("_new").alias("x"), F.col("member").alias("y"))
        links = materialize(inside.unionByName(across).distinct(), "new-links")
        roots = self._roots(links.select(F.explode(F.array("x", "y")).alias("id")).distinct())
        end = lambda c: roots.select(F.col("id").alias(c), F.col("root").alias(f"_{c}"))
        tied = links.join(end("x"), "x").join(end("y"), "y").where(F.col("_x") != F.col("_y"))
        edges = tied.select(F.greatest("_x", "_y").alias("child"), F.least("_x", "_y").alias("parent")).distinct()
        grouped = materialize(connected_components(edges), "new-groups")
        self._append(met.where(F.col("member").isNull()).select(*keys, F.col("_new").alias("member")), self._buckets_table(), keys, number)
        self._append(grouped.select("id", F.col("component").alias("parent")), self._forest_table(), ("id",), number)
        if not self._mark(f"merged/{number}"):
            raise RuntimeError(f"merge {number} has ended already")
        for table in (signed, met, links, roots, grouped):
            discard(table)
        return number

    def components(self) -> DataFrame:
        """``id, component`` of every document that isn't the smallest of its group, over all merges.

        Paths are halved round by round, so the rounds grow with the logarithm
        of the number of merges.
        """
        current = materialize(self.forest().select("id", F.col("parent").alias("component")), "components")
        for _ in range(max(len(self.generations()), 1).bit_length()):
            up = current.select(F.col("id").alias("component"), F.col("component").alias("_up"))
            before, moved = current, current.join(up, "component", "left")
            current = materialize(moved.select("id", F.coalesce("_up", "component").alias("component")), "components")
            discard(before)
        return current
