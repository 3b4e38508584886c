"""Mixing sources to target weights without sorting documents.

Every document gets a 60-bit hash of its id. Histograms of words by (source, hash bucket) show
where a source's budget ends; only the bucket on that boundary is split further, 12 bits a level,
until it holds one document, which is taken if that ends nearer to the budget. What remains is
one threshold for each source, and the mix is a
filter ``hash < threshold`` over the documents: no sort, no window over documents.

A source whose target exceeds its own size is taken whole once, and the threshold then chooses
the documents that are taken twice.

Only built-in DataFrame functions are used. Document-sized data is shuffled only as partial sums;
the hot source costs no more than any other, since its rows meet as at most 4096 bucket sums per
task. The thresholds (one row per source) are stored in the shared folder, so that the planner
knows their size and joins them by broadcast only below its threshold.

Edge cases: a null text or one without words has size 0 and takes nothing; a null source is a
source of its own, ordered last; documents with equal ids (or null ids) have equal hashes and are
taken or left together; an empty table gives an empty mix; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import n_words, stored

HASH_BITS = 60
LEVEL_BITS = 12
WEIGHTS = (5, 2, 1)


def id_hash(id_col: str) -> Column:
    """60 bits of the id's MD5 as a non-negative long: the same in every run and engine."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5,
                   most: int = 2) -> DataFrame:
    """One row per source: its size, weight and target.

    Sources in code point order (null last) weigh ``weights`` in turn and share ``share`` of all
    words; a target stops at ``most`` times its source's size and the excess goes to the others
    by weight. Sources are visited by cap/weight; the first that stays below its cap under the
    rate left by those before it fixes the rate for itself and all later ones.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rows = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rows = rows.withColumn("rank", F.row_number().over(by_name) - 1)
    rows = rows.withColumn("weight", F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
        .cast("long"))
    rows = rows.withColumn("cap", F.col("source_size") * most)
    visit = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = visit.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    rows = rows.withColumns({
        "budget": F.sum("source_size").over(whole).cast("double") * share,
        "all_weight": F.sum("weight").over(whole),
        "cap_before": F.coalesce(F.sum("cap").over(before), F.lit(0)),
        "weight_before": F.coalesce(F.sum("weight").over(before), F.lit(0)),
    })
    rows = rows.withColumn("rate", (F.col("budget") - F.col("cap_before"))
                           / (F.col("all_weight") - F.col("weight_before")))
    rows = rows.withColumn("full", F.col("cap") <= F.col("rate") * F.col("weight"))
    rows = rows.withColumn("level", F.max(F.when(~F.col("full"), F.col("rate"))).over(whole))
    return rows.select(
        "source", "source_size", "weight",
        F.when(F.col("full"), F.col("cap").cast("double"))
        .otherwise(F.col("weight") * F.col("level")).alias("target"))


def thresholds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per source: whole copies taken of each document, and the hash threshold below
    which a document is taken once more."""
    whole = F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1)))
    state = targets.select(
        "source", "source_size", "target", whole.alias("copies"),
        F.floor(F.col("target") - whole * F.col("source_size")).alias("left"),
        F.lit(0).cast("long").alias("prefix"), F.lit(None).cast("long").alias("threshold"))
    state = stored(state, "mix-state")
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        state, more = _refine(sizes, state, shift)
        if not more:
            break
    # What is left of an unsettled boundary bucket is one document or documents of equal hash.
    return state.select("source", "source_size", "target", "copies",
                        F.coalesce("threshold", "prefix").alias("threshold"))


def _refine(sizes: DataFrame, state: DataFrame, shift: int) -> tuple[DataFrame, bool]:
    """One level: histogram the boundary buckets, find where each budget ends."""
    first = shift == HASH_BITS - LEVEL_BITS
    opened = state.filter(F.col("threshold").isNull()).select(
        F.col("source").alias("s_source"), "prefix", "left")
    cell = F.shiftright("hash", shift)
    inside = sizes.join(opened, F.col("source").eqNullSafe(F.col("s_source")) & (
        F.lit(True) if first else F.shiftright("hash", shift + LEVEL_BITS)
        == F.shiftright("prefix", shift + LEVEL_BITS)))
    sums = inside.groupBy("source", "left", cell.alias("cell")).agg(
        F.sum("size").alias("size"), F.count(F.lit(1)).alias("docs"))
    up = Window.partitionBy("source").orderBy("cell")
    upto = F.sum("size").over(up)
    ends = (sums.withColumn("upto", upto).filter(F.col("upto") > F.col("left"))
            .groupBy("source").agg(F.min_by(F.struct(
                "cell", (F.col("left") - (F.col("upto") - F.col("size"))).alias("left"), "docs",
                "size"), "cell").alias("end")))
    ends = ends.select(F.col("source").alias("e_source"), "end")
    joined = state.join(ends, F.col("source").eqNullSafe(F.col("e_source")), "left")
    open_ = F.col("threshold").isNull()
    # The whole boundary bucket fits (or, at first, the whole source): its upper end.
    past = (F.lit(1 << HASH_BITS) if first else F.col("prefix") + (1 << (shift + LEVEL_BITS)))
    new = stored(joined.select(
        "source", "source_size", "target", "copies",
        F.when(open_ & F.col("end").isNotNull(), F.col("end.left")).otherwise(F.col("left"))
        .alias("left"),
        F.when(open_ & F.col("end").isNotNull(), F.shiftleft(F.col("end.cell"), shift))
        .otherwise(F.col("prefix")).alias("prefix"),
        F.when(open_ & F.col("end").isNull(), past.cast("long"))
        .when(open_ & (F.col("end.docs") == 1), F.shiftleft(F.col("end.cell"), shift)
              # A single document: taken if that ends nearer to the budget.
              + F.when(F.col("end.left") * 2 >= F.col("end.size"), 1 << shift).otherwise(0))
        .otherwise(F.col("threshold")).alias("threshold")), "mix-state")
    return new, bool(new.filter(F.col("threshold").isNull()).limit(1).count())


def plan_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", **how) -> tuple[DataFrame, DataFrame]:
    """(sizes of all documents, thresholds of all sources), both stored."""
    sizes = stored(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        n_words(F.col(text_col)).alias("size"), id_hash(id_col).alias("hash")), "mix-sizes")
    return sizes, stored(thresholds(sizes, source_targets(sizes, **how)), "mix-plan")


def _taken(plan: DataFrame) -> tuple[DataFrame, Column]:
    plan = plan.select(F.col("source").alias("p_source"), "source_size", "target", "copies",
                       "threshold")
    return plan, F.col("copies") + (F.col("hash") < F.col("threshold")).cast("long")


def mix_report(docs: DataFrame, **how) -> DataFrame:
    """Words that the mix takes of every document."""
    sizes, plan = plan_mix(docs, **how)
    plan, copies = _taken(plan)
    return (sizes.join(plan, F.col("source").eqNullSafe(F.col("p_source")))
            .select("doc_id", "size", "source_size", "target",
                    (F.col("size") * copies).alias("taken")))


def mix_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
                  **how) -> DataFrame:
    """The mix itself: every document as often as it is taken, in the columns of ``docs``."""
    _, plan = plan_mix(docs, id_col=id_col, source_col=source_col, **how)
    plan, copies = _taken(plan)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    return (docs.select(row, F.col(source_col).alias("_source"), id_hash(id_col).alias("hash"))
            .join(plan, F.col("_source").eqNullSafe(F.col("p_source")))
            .withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(1))))
            .filter(F.col("_copy") < copies)
            .select(*[F.col("_row")[c].alias(c) for c in docs.columns]))
