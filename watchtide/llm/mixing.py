"""Mixing of sources to target weights: hash-random order in each source, cut at the source's budget of words.

Rows get a hash key, which orders every source at random but alike in every run. Word counts are summed up along that
order in key ranges, side by side; a source is passed over as often as its budget holds it whole, and the last pass
ends where the budget does.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from watchtide.llm.prefix import attached, hash_key, running_total, with_rows
from watchtide.storage import stored

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """Weights of the sources in their order, repeating; the words of the mix in percent of all; passes at most."""

    weights: Sequence[float] = (5.0, 2.0, 1.0)
    percent: float = 100.0
    passes: int = 3
    whole: bool = False
    seed: str = "mix"


def targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """``source, source_size, source_rows`` with ``rank`` and ``target``, one row per source.

    Each source gets its weight's share of the words, at most ``passes`` times its own size. What that cuts off is
    shared anew until it fits: the level ``words per weight`` that comes out is the greatest one found when the
    sources are filled up in the order of their limit per weight. One row per source is all that meets here.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in mix.weights])
    ranked = sizes.withColumn("rank", F.row_number().over(ordered).cast("bigint"))
    ranked = ranked.withColumn("weight", F.element_at(weights, ((F.col("rank") - 1) % len(mix.weights) + 1).cast("int")))
    ranked = ranked.withColumn("limit", F.col("source_size").cast("double") * mix.passes)
    filled = Window.orderBy(F.col("limit") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    all_words = F.sum("source_size").over(whole) * (mix.percent / 100.0)
    left_words = all_words - F.coalesce(F.sum("limit").over(filled), F.lit(0.0))
    left_weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(filled), F.lit(0.0))
    levelled = ranked.withColumn("level", left_words / left_weight)
    level = F.max("level").over(whole)
    return levelled.select("source", "source_size", "source_rows", "rank", F.least("limit", level * F.col("weight")).alias("target"))


def mixed(docs: DataFrame, mix: Mix = Mix(), id: str = "doc_id", text: str = "text", source: str = "source", keep: Sequence[str] | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all when None) with ``size``, ``source_size``, ``target``, ``taken`` and ``copies``.

    ``size`` counts words. ``taken`` is how many words of the row the mix takes, repeats counted, and ``copies`` how
    often the row occurs in it. At the cut a row is taken in part, so that every source meets its target to the word;
    with ``whole`` it is taken or left as a whole, whichever comes closer. Null and wordless texts have size 0 and are
    taken as often as their place in the order says, for no words. A null source is a source, the last one. Rows of
    one id are ordered by source and size and each count. An empty table gives no rows; columns of the new names give
    way.
    """
    kept = [docs[c] for c in (docs.columns if keep is None else keep) if c not in ("size", "source_size", "target", "taken", "copies")]
    size = F.regexp_count(F.coalesce(docs[text], F.lit("")), F.lit(WORD)).cast("bigint")
    sized = docs.select(
        F.struct(*kept).alias("_row") if kept else F.lit(None).alias("_row"),
        docs[source].alias("_source"),
        docs[id].alias("_id"),
        hash_key(docs[id], F.lit(mix.seed)).alias("_key"),
        size.alias("size"),
    )
    keys = stored(sized.select("_source", "_key", "size"), "sizes")
    sums = stored(keys.groupBy("_source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows")), "sources")
    plan = stored(targets(sums.withColumnRenamed("_source", "source"), mix), "targets")
    rows = plan.agg(F.coalesce(F.sum("source_rows"), F.lit(0))).first()[0]
    plan = plan.select(F.col("source").alias("_plan"), "source_size", "rank", "target")
    dealt, narrow = (x.join(plan, F.col("_source").eqNullSafe(F.col("_plan"))).withColumnRenamed("rank", "_rank") for x in (sized, keys))
    placed = running_total(dealt, "_rank", "_key", ["_id", "size"], "size", "_before", rows, narrow)
    budget = F.round("target").cast("bigint")
    share = F.when(F.col("source_size") > 0, budget % F.col("source_size")).otherwise(0)
    passes = F.when(F.col("source_size") > 0, F.expr("_budget div source_size")).otherwise(1)
    placed = placed.withColumn("_budget", budget).withColumns({"_passes": passes, "_share": share})
    if mix.whole:
        part = F.when(2 * F.col("_before") + F.col("size") <= 2 * F.col("_share"), F.col("size")).otherwise(0)
        last = 2 * F.col("_before") + F.col("size") <= 2 * F.col("_share")
    else:
        part = F.greatest(F.least(F.col("_share") - F.col("_before"), F.col("size")), F.lit(0))
        last = F.col("_before") < F.col("_share")
    return placed.withColumns(
        {"taken": F.col("_passes") * F.col("size") + part, "copies": (F.col("_passes") + (last & (F.col("_share") > 0)).cast("int")).cast("int")}
    ).select(*(["_row.*"] if kept else []), "size", "source_size", "target", "taken", "copies")


def repeated(docs: DataFrame, mix: Mix, **names: str) -> DataFrame:
    """The mix itself: the columns of ``docs``, each row as often as the mix takes it, whole.

    Keys and sizes are ordered, texts are not: the copies are joined to them.
    """
    names = {"id": "doc_id", "text": "text", "source": "source"} | names
    rows = with_rows(docs, "rows")
    narrow = rows.select("_row", *[F.col("_all")[c].alias(k) for k, c in names.items()])
    taken = mixed(narrow, mix, "id", "text", "source", keep=["_row"]).filter("copies > 0").select("_row", "copies")
    return attached(rows, taken).select("_all", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_all.*")
