"""Gene-set methods: over-representation, ranked enrichment, set z-scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from countloom.functions.missing import finite
from countloom.functions.special import hypergeom_sf
from countloom.operators.ranking import bh_adjust, normalized_rank
from countloom.session import reuse


def ora(effects: DataFrame, sets: DataFrame, min_size: int = 10, max_size: int = 500, alpha: float = 0.05, abs_lfc: float = 1.0, by: Sequence[str] = ("dataset_id",), database: str = "GO") -> DataFrame:
    """Upper hypergeometric tail per set, up and down apart; the universe is what was tested."""
    by = list(by)
    tested = effects.select(*by, "gene_id").distinct()
    universe = tested.groupBy(*by).agg(F.count(F.lit(1)).alias("universe_size"))
    called = effects.where((F.col("padj") < alpha) & (F.abs("log2FoldChange") >= abs_lfc) & (F.col("log2FoldChange") != 0)).select(
        *by, "gene_id", F.when(F.col("log2FoldChange") > 0, F.lit("up")).otherwise(F.lit("down")).alias("direction")).distinct()
    selected = called.groupBy(*by, "direction").agg(F.count(F.lit(1)).alias("selected_size"))
    members = tested.join(sets.select("set_name", "gene_id").distinct(), "gene_id")
    sizes = members.groupBy(*by, "set_name").agg(F.count(F.lit(1)).alias("pathway_size")).where(F.col("pathway_size").between(min_size, max_size))
    grid = sizes.join(universe, by).withColumn("direction", F.explode(F.array(F.lit("up"), F.lit("down"))))
    # A kept set has at most max_size genes, which bounds the list.
    hits = members.join(sizes.select(*by, "set_name"), [*by, "set_name"], "left_semi").join(called, [*by, "gene_id"]).groupBy(*by, "set_name", "direction").agg(
        F.count(F.lit(1)).alias("overlap"), F.concat_ws(";", F.array_sort(F.collect_list("gene_id"))).alias("leading_genes"))
    rows = grid.join(hits, [*by, "set_name", "direction"], "left").join(selected, [*by, "direction"], "left").na.fill(0, ["overlap", "selected_size"]).na.fill("", ["leading_genes"])
    scored = rows.withColumn("pvalue", hypergeom_sf("overlap", "universe_size", "pathway_size", "selected_size"))
    return bh_adjust(scored.withColumn("database", F.lit(database)), "pvalue", [*by, "database", "direction"], small=True)


def _scores(hits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Enrichment score per key from its members' ranks alone.

    Between two members the running sum only falls, so its extremes lie at the
    members: no walk over all genes is needed.
    """
    w = W.partitionBy(*keys).orderBy("rank")
    upto = w.rowsBetween(W.unboundedPreceding, 0)
    walk = hits.withColumns({"_w": F.abs("stat"), "_i": F.row_number().over(w), "_n": F.count(F.lit(1)).over(W.partitionBy(*keys))}).withColumns(
        {"_sum": F.sum("_w").over(upto), "_all": F.sum("_w").over(W.partitionBy(*keys))})
    gone = F.try_divide(F.col("rank") - F.col("_i"), F.col("total") - F.col("_n"))
    share = lambda x: F.coalesce(F.try_divide(x, F.col("_all")), F.lit(0.0))
    walk = walk.withColumns({"_high": share(F.col("_sum")) - F.coalesce(gone, F.lit(0.0)), "_low": share(F.col("_sum") - F.col("_w")) - F.coalesce(gone, F.lit(0.0))})
    out = walk.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"), F.max("_high").alias("_high"), F.min("_low").alias("_low"), F.max_by("rank", "_high").alias("_top"), F.min_by("rank", "_low").alias("_bottom"))
    up = F.col("_high") >= -F.col("_low")
    return out.select(*keys, "size", F.when(up, F.col("_high")).otherwise(F.col("_low")).alias("ES"), F.when(up, F.col("_top")).otherwise(F.col("_bottom")).alias("edge_rank"))


def ranked_enrichment(effects: DataFrame, sets: DataFrame, permutations: int = 1000, seed: int = 1, min_size: int = 10, max_size: int = 500) -> DataFrame:
    """Running-sum score, its normalised form and a permutation p per set.

    Null scores use hashed random ranks (same draw on every retry); a rank drawn
    twice for one set counts once.  ``effects`` is one family (gene_id, stat).
    """
    stats = effects.select("gene_id", finite("stat").alias("stat")).where(F.col("stat").isNotNull()).withColumn("_neg", -F.col("stat")).withColumn("_one", F.lit(1))
    ranked = normalized_rank(stats, ["_one"], "_neg", "gene_id")
    size = stats.agg(F.count(F.lit(1)).alias("total"))
    ranked = reuse(ranked.crossJoin(F.broadcast(size)).select("gene_id", "stat", F.round(F.col("normalized_rank") * F.col("total")).cast("bigint").alias("rank"), "total"))  # one row
    members = sets.select("set_name", "gene_id").distinct().join(ranked, "gene_id")
    sizes = members.groupBy("set_name").agg(F.count(F.lit(1)).alias("_n"), F.max("total").alias("total")).where(F.col("_n").between(min_size, max_size))
    kept = members.join(sizes.select("set_name"), "set_name", "left_semi")
    observed = reuse(_scores(kept, ["set_name"]))
    draws = sizes.select("set_name", "total", F.explode(F.sequence(F.lit(1), F.lit(permutations))).alias("permutation"), "_n").select("set_name", "total", "permutation", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))).alias("_i"))
    drawn = draws.select("set_name", "permutation", (F.pmod(F.xxhash64(F.lit(seed), "set_name", "permutation", "_i"), F.col("total")) + 1).alias("rank")).distinct()
    null = _scores(drawn.join(ranked.select("rank", "stat", "total"), "rank"), ["set_name", "permutation"]).select("set_name", F.col("ES").alias("_null"))
    both = null.join(observed, "set_name")
    same = F.signum("_null") == F.signum("ES")
    tail = both.groupBy("set_name").agg(
        F.avg(F.when(same, F.abs("_null"))).alias("_mean"), F.count_if(same).alias("_same"), F.count_if(same & (F.abs("_null") >= F.abs("ES"))).alias("_over"))
    edge = kept.join(observed, "set_name").where(F.when(F.col("ES") >= 0, F.col("rank") <= F.col("edge_rank")).otherwise(F.col("rank") >= F.col("edge_rank")))
    leading = edge.groupBy("set_name").agg(F.concat_ws(";", F.transform(F.array_sort(F.collect_list(F.struct("rank", "gene_id"))), lambda s: s["gene_id"])).alias("leadingEdge"))
    out = observed.join(tail, "set_name").join(leading, "set_name").select(
        "set_name", ((F.col("_over") + 1) / (F.col("_same") + 1)).alias("pval"), "ES", F.try_divide("ES", "_mean").alias("NES"), "size", "leadingEdge")
    return bh_adjust(out, "pval", small=True)


def set_zscore(expression: DataFrame, sets: DataFrame, value: str = "value", by: Sequence[str] = ("dataset_id",)) -> DataFrame:
    """Sum of row-standardised values over the set's genes, over the root of their number.

    A zero entry contributes -mean/sd, which is one constant per gene, so only the
    entries present are joined.
    """
    by = list(by)
    samples = expression.select(*by, "sample_id").distinct()
    count = samples.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    x = F.col(value)
    gene = expression.groupBy(*by, "gene_id").agg(F.sum(x).alias("_s"), F.sum(x * x).alias("_q")).join(count, by)
    sd = F.sqrt(F.greatest(F.lit(0.0), F.try_divide(F.col("_q") - F.col("_s") * F.col("_s") / F.col("_n"), F.col("_n") - 1)))
    gene = gene.select(*by, "gene_id", (F.col("_s") / F.col("_n")).alias("_mean"), F.when(sd > 1e-12, sd).alias("_sd"))
    members = gene.join(sets.select("set_name", "gene_id").distinct(), "gene_id")
    base = members.groupBy(*by, "set_name").agg(F.count(F.lit(1)).alias("genes"), F.sum(F.coalesce(F.col("_mean") / F.col("_sd"), F.lit(0.0))).alias("_base"))
    present = expression.join(members.where(F.col("_sd").isNotNull()), [*by, "gene_id"]).groupBy(*by, "set_name", "sample_id").agg(F.sum(x / F.col("_sd")).alias("_sum"))
    grid = base.join(samples, by)
    return grid.join(present, [*by, "set_name", "sample_id"], "left").select(
        *by, F.col("set_name").alias("pathway"), "sample_id", "genes", ((F.coalesce("_sum", F.lit(0.0)) - F.col("_base")) / F.sqrt("genes")).alias("score"))
