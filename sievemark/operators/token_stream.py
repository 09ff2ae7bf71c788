"""A corpus as one long token stream: order, cuts and blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.functions.text import settle, tokens
from sievemark.operators.prefix import prefix_sum
from sievemark.storage import materialize

END = "<eot>"  # no token: tokens are letters and digits only


def shuffle_key(id_col: str, seed: int = 1234) -> Column:
    """A fixed pseudo-random order of documents."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def token_sequence(text: str = "text") -> Column:
    """The tokens of a document and the end marker."""
    return F.concat(tokens(F.coalesce(F.col(text), F.lit(""))), F.array(F.lit(END)))


def token_count(text: str = "text") -> Column:
    """How many tokens a document has with the end marker."""
    return F.size(token_sequence(text))


def document_offsets(
    docs: DataFrame, id_col: str = "id", text: str = "text", seed: int = 1234, ranges: int | None = None
) -> DataFrame:
    """``(variant, id, draw, n_tokens, offset)``: where each document starts in its stream.

    Written once without texts; every later cut works on this slim table. Where
    ``docs`` has ``n_tokens`` (:func:`token_count`) in place of texts, that is taken.
    """
    n_tokens = F.col("n_tokens") if "n_tokens" in docs.columns and text not in docs.columns else token_count(text)
    slim = docs.select("variant", id_col, shuffle_key(id_col, seed).alias("draw"), n_tokens.alias("n_tokens"))
    slim = materialize(slim, "document-lengths")
    return materialize(prefix_sum(slim, "draw", "n_tokens", by=["variant"], ranges=ranges), "document-offsets")


def stream_sizes(offsets: DataFrame, val_fraction: float = 0.1) -> DataFrame:
    """Per variant ``n_docs, n_tokens_total, n_train_tokens, n_val_tokens``."""
    totals = offsets.groupBy("variant").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens_total"))
    train = F.floor(F.col("n_tokens_total") * F.lit(1 - val_fraction))
    return totals.withColumn("n_train_tokens", train).withColumn("n_val_tokens", F.col("n_tokens_total") - train)


def equal_budget(sizes: DataFrame, budget: int) -> int:
    """Tokens each variant trains on: the budget, or the smallest training part if that is less."""
    smallest = sizes.agg(F.min("n_train_tokens")).first()[0] or 0
    return min(budget, smallest)


def token_cuts(offsets: DataFrame, limits: DataFrame) -> DataFrame:
    """Per variant: the document and the place in it where each limit falls.

    ``limits`` is ``(variant, limits array)``, one row per variant. Only the
    document that a limit falls into is ever cut, so knowing its draw is enough
    to place every other document: texts need no join with their offsets.
    """
    at = offsets.join(F.broadcast(limits.select("variant", F.posexplode("limits").alias("i", "limit"))), "variant")
    holding = at.where((F.col("offset") <= F.col("limit")) & (F.col("limit") < F.col("offset") + F.col("n_tokens")))
    cut = F.struct("i", "draw", (F.col("limit") - F.col("offset")).cast("int").alias("take"))
    return holding.groupBy("variant").agg(F.sort_array(F.collect_list(cut)).alias("cuts"))


def tokens_before(n_cuts: int, n_tokens: Column, draw: str = "draw", cuts: str = "cuts") -> list[Column]:
    """For each cut, how many tokens of a document lie before it (all, if the limit is past the end)."""
    taken = []
    for i in range(n_cuts):
        cut = F.get(F.filter(F.col(cuts), _numbered(i)), F.lit(0))
        taken.append(
            F.when(cut.isNull() | (F.col(draw) < cut["draw"]), n_tokens)
            .when(F.col(draw) == cut["draw"], cut["take"])
            .otherwise(F.lit(0))
        )
    return taken


def _numbered(i: int):
    return lambda cut: cut["i"] == i


def token_blocks(docs: DataFrame, offsets: DataFrame, block: int = 128, id_col: str = "id", text: str = "text") -> DataFrame:
    """``(variant, block_id, x, y)``: whole blocks of the stream, y = x one token later.

    A block takes ``block + 1`` tokens, the last shared with the next block, so
    a group is bounded by its block however long the documents are. Tokens move
    as one string with blanks between, which none of them holds; an array would
    take 16 bytes more for each.
    """
    joined = docs.select("variant", id_col, F.array_join(token_sequence(text), " ").alias("_joined"))
    placed = joined.join(offsets.select("variant", id_col, "offset", "n_tokens").hint("shuffle_hash"), ["variant", id_col])
    placed = settle(placed, {"_tokens": F.split("_joined", " ")}).drop("_joined")
    first = F.greatest(F.lit(0), F.floor((F.col("offset") - 1) / block))
    last = F.floor((F.col("offset") + F.col("n_tokens") - 1) / block)
    size = F.col("n_tokens").cast("long")

    def piece(block_id: Column) -> Column:
        start = F.greatest(F.lit(0), block_id * block - F.col("offset"))
        stop = F.least(size, (block_id + 1) * block + 1 - F.col("offset"))
        part = F.struct(
            F.greatest(F.col("offset"), block_id * block).alias("at"),
            F.array_join(F.slice("_tokens", (start + 1).cast("int"), (stop - start).cast("int")), " ").alias("part"),
        )
        return F.struct(block_id.alias("block_id"), part.alias("_piece"))

    # Cut before the rows multiply: a block's row holds its own tokens, never the whole document.
    spans = placed.select("variant", F.inline(F.transform(F.sequence(first, last), piece)))
    packed = spans.groupBy("variant", "block_id").agg(F.sort_array(F.collect_list("_piece")).alias("_pieces"))
    run = settle(packed, {"_run": F.split(F.array_join(F.transform("_pieces", lambda p: p["part"]), " "), " ")}).select("variant", "block_id", "_run")
    full = run.where(F.size("_run") == block + 1)
    return full.select("variant", "block_id", F.slice("_run", 1, block).alias("x"), F.slice("_run", 2, block).alias("y"))


def sample_blocks(blocks: DataFrame, n: int, seed: int = 1337, by: Sequence[str] = ("variant", "block_id")) -> DataFrame:
    """``n`` blocks drawn without replacement, the same ones on every run."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *by))
    drawn = blocks.select(*by, digest.alias("_draw")).orderBy("_draw").limit(n).drop("_draw")
    return blocks.join(drawn, list(by), "left_semi")


def random_starts(sizes: DataFrame, n: int, block: int = 128, seed: int = 1337) -> DataFrame:
    """``variant, draw_id, start``: ``n`` starts a variant, drawn with replacement, the same ones on every run.

    ``sizes`` is ``(variant, n_tokens_total)``. A start leaves room for the
    block and the token after it; a stream of ``block + 1`` tokens or fewer has none.
    """
    room = sizes.select("variant", (F.col("n_tokens_total") - F.lit(block + 1)).alias("_room")).where(F.col("_room") > 0)
    drawn = room.select("variant", "_room", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("draw_id"))
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), "variant", F.col("draw_id").cast("string")))
    # 60 bits of the digest: the remainder favours no start that a corpus could tell.
    number = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
    return drawn.select("variant", "draw_id", F.pmod(number, F.col("_room")).alias("start"))


def sample_batches(
    docs: DataFrame, offsets: DataFrame, n: int, block: int = 128, seed: int = 1337, id_col: str = "id", text: str = "text"
) -> DataFrame:
    """``(variant, draw_id, start, x, y)``: blocks that begin anywhere in the stream, y = x one token later.

    No block is built that isn't drawn. A start meets the documents that it
    touches through cells of the stream: a draw lies in one or two cells, a
    document in as many as it covers, so the join is one on equal cells over the slim table of
    offsets. Only the documents that are touched are tokenized, and a draw's
    rows hold its own tokens alone. Draws of the same place are rows of their
    own. ``offsets`` is the written table of :func:`document_offsets`.
    """
    sizes = offsets.groupBy("variant").agg(F.sum("n_tokens").alias("n_tokens_total"))
    starts = random_starts(sizes, n, block, seed).withColumn("stop", F.col("start") + F.lit(block + 1))
    cell = F.lit(max(4096, block + 1)).cast("long")
    floor = lambda c: F.floor(c / cell)
    wanted = starts.select("*", F.explode(F.sequence(floor(F.col("start")), floor(F.col("stop") - 1))).alias("_cell"))
    # n draws a variant, in two cells each: bounded by the arguments.
    wanted = materialize(wanted, "drawn")
    end = F.col("offset") + F.col("n_tokens")
    held = offsets.select("variant", id_col, "offset", "n_tokens", F.explode(F.sequence(floor(F.col("offset")), floor(end - 1))).alias("_cell"))
    met = held.join(F.broadcast(wanted), ["variant", "_cell"]).where((F.col("offset") < F.col("stop")) & (F.col("start") < end))
    first, last = F.greatest("offset", "start"), F.least(end, F.col("stop"))
    # A document and a draw meet in two cells at most: only the cell of their first common token counts.
    once = met.where(floor(first) == F.col("_cell"))
    cuts = once.select("variant", id_col, "draw_id", "start", first.alias("at"), (first - F.col("offset")).alias("_from"), (last - first).alias("_n"))
    cuts = materialize(cuts, "cuts")
    pieces = docs.select("variant", id_col, text).join(cuts, ["variant", id_col]).select(
        "variant", "draw_id", "start", "at", F.slice(token_sequence(text), (F.col("_from") + 1).cast("int"), F.col("_n").cast("int")).alias("part")
    )
    packed = pieces.groupBy("variant", "draw_id", "start").agg(F.sort_array(F.collect_list(F.struct("at", "part"))).alias("_pieces"))
    run = packed.select("variant", "draw_id", "start", F.flatten(F.transform("_pieces", lambda p: p["part"])).alias("_run"))
    return run.select("variant", "draw_id", "start", F.slice("_run", 1, block).alias("x"), F.slice("_run", 2, block).alias("y"))
