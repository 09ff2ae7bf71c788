"""Data mixes and held-out sets for comparing them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.operators.dedup import duplicate_clusters, near_dedup
from sievemark.operators.groups import join_groups
from sievemark.operators.minhash import MinhashConfig, band_table, bands
from sievemark.plans.ingest import IngestConfig, clean, ingest
from sievemark.storage import materialize

# The mixes, in report order.
VARIANTS = ("raw", "deduped", "deduped_filtered")


@dataclass(frozen=True)
class Mixes:
    """Documents split into training and held-out sources, before and after the ingest filters."""

    train_raw: DataFrame
    train_clean: DataFrame
    held_raw: DataFrame
    held_clean: DataFrame
    raw_bands: DataFrame
    clean_bands: DataFrame
    id_col: str
    text: str
    cfg: MinhashConfig

    def variants(self) -> DataFrame:
        """``(variant, id, text)`` of the three mixes of the training sources.

        ``raw`` is everything, ``deduped`` is raw without near copies, and
        ``deduped_filtered`` is the ingest output without near copies.
        """
        key = (self.id_col, self.text, self.cfg)
        parts = (
            self.train_raw,
            near_dedup(self.train_raw, *key, self.raw_bands),
            near_dedup(self.train_clean, *key, self.clean_bands),
        )
        return _stack("variant", dict(zip(VARIANTS, parts)), self.id_col, self.text)

    def measured(self, columns: Mapping[str, Column]) -> DataFrame:
        """``(variant, id, *columns)``: the rows of :meth:`variants` with columns made of the text in its place.

        Each is computed once for a text, though ``raw`` and ``deduped`` both have it.
        """
        slim = self.train_raw.select(self.id_col, *[c.alias(name) for name, c in columns.items()])
        copies = duplicate_clusters(self.train_raw, self.id_col, self.text, self.cfg, self.raw_bands)
        flagged = slim.join(copies.select(F.col("id").alias(self.id_col), F.lit(True).alias("_copy")), self.id_col, "left")
        both = F.when(F.col("_copy"), F.array(F.lit(VARIANTS[0]))).otherwise(F.array(*map(F.lit, VARIANTS[:2])))
        unfiltered = flagged.select(F.explode(both).alias("variant"), self.id_col, *columns)
        deduped = near_dedup(self.train_clean, self.id_col, self.text, self.cfg, self.clean_bands)
        filtered = deduped.select(F.lit(VARIANTS[2]).alias("variant"), self.id_col, *[c.alias(name) for name, c in columns.items()])
        return unfiltered.unionByName(filtered)

    def shared(self) -> DataFrame:
        """``(shared_set, id, text)`` of the held-out sources.

        ``filtered`` went through the same ingest filters, hence is closer to
        the last mix; ``unfiltered`` did not. A held-out document that shares a
        band with any training document is left out of both.
        """
        seen = [self.raw_bands, self.clean_bands]
        key = (self.id_col, self.text, self.cfg)
        parts = {
            "filtered": without_near_copies(self.held_clean, seen, *key),
            "unfiltered": without_near_copies(self.held_raw, seen, *key),
        }
        return _stack("shared_set", parts, self.id_col, self.text)


def _stack(name: str, parts: dict[str, DataFrame], id_col: str, text: str) -> DataFrame:
    named = [df.select(F.lit(value).alias(name), id_col, text) for value, df in parts.items()]
    return reduce(DataFrame.unionByName, named)


def prepare_mixes(
    docs: DataFrame,
    held_out: Sequence[str] = (),
    id_col: str = "id",
    text: str = "text",
    source: str = "source",
    ingest_cfg: IngestConfig = IngestConfig(),
    cfg: MinhashConfig = MinhashConfig(),
) -> Mixes:
    """Ingest once and sign the training documents once, for mixes and shared sets alike."""
    held = F.coalesce(F.col(source).isin(list(held_out)), F.lit(False))
    raw = docs.select(id_col, text, held.alias("_held_out"))
    kept = materialize(clean(ingest(raw, text, ingest_cfg)).select(id_col, text, "_held_out"), "mix-clean")
    train_raw, held_raw = _halves(raw)
    train_clean, held_clean = _halves(kept)
    raw_bands = materialize(band_table(train_raw, id_col, text, cfg), "raw-bands")
    clean_bands = materialize(band_table(train_clean, id_col, text, cfg), "clean-bands")
    return Mixes(train_raw, train_clean, held_raw, held_clean, raw_bands, clean_bands, id_col, text, cfg)


def _halves(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where(~F.col("_held_out")).drop("_held_out"), df.where("_held_out").drop("_held_out")


def without_near_copies(
    df: DataFrame, seen: Sequence[DataFrame], id_col: str = "id", text: str = "text", cfg: MinhashConfig = MinhashConfig()
) -> DataFrame:
    """Drop documents that share a band with any document of the ``seen`` band tables.

    Both sides are reduced to distinct bands before they meet, so a band that
    very many documents share is one row on each side.
    """
    keys = ["band", "band_hash"]
    table = materialize(band_table(df, id_col, text, cfg), "held-out-bands")
    rows = bands(table, id_col)
    mine = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    known = None
    for other in seen:
        part = bands(other, id_col).select(*keys)
        known = part if known is None else known.unionByName(part)
    common = mine.join(known.distinct(), keys, "left_semi")
    copies = join_groups(rows, common, keys, table.count() * cfg.num_buckets).select(id_col).distinct()
    return df.join(copies, id_col, "left_anti")


def variant_counts(variants: DataFrame) -> DataFrame:
    """Documents per mix."""
    return variants.groupBy("variant").agg(F.count(F.lit(1)).alias("n_docs"))
