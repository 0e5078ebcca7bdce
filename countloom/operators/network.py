"""Co-expression network, modules, cell fractions and survival scans."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from countloom.operators.counts import sample_pca, top_variance_genes
from countloom.operators.pairwise import gram, mirrored
from countloom.operators.ranking import bh_adjust
from countloom.session import reuse

FIT_TOLERANCE = 1e-9


def coexpression(expression: DataFrame, value: str = "value", power: float = 6.0, top_genes: int = 2000, tiles: int = 1) -> tuple[DataFrame, DataFrame]:
    """(edges with adjacency and topological overlap, connectivity per gene), per dataset.

    Correlations and shared neighbours are both sums of products between gene
    columns; the caller bounds the genes with ``top_genes``.
    """
    by = ["dataset_id"]
    chosen = top_variance_genes(expression, value, top_genes).where(F.col("variance") > 0).select(*by, "gene_id")
    rows = reuse(expression.join(chosen, [*by, "gene_id"], "left_semi").select(*by, "gene_id", "sample_id", F.col(value).cast("double").alias("x")))
    n = rows.select(*by, "sample_id").distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    sums = rows.groupBy(*by, "gene_id").agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"))
    dots = gram(rows, by, "sample_id", "gene_id", "x", tiles)
    side = lambda e: sums.select(*by, F.col("gene_id").alias(f"col_{e}"), F.col("s").alias(f"s{e}"), F.col("q").alias(f"q{e}"))
    pairs = dots.where(F.col("col_i") != F.col("col_j")).join(side("i"), [*by, "col_i"]).join(side("j"), [*by, "col_j"]).join(n, by)
    spread = F.sqrt(F.col("n") * F.col("qi") - F.col("si") * F.col("si")) * F.sqrt(F.col("n") * F.col("qj") - F.col("sj") * F.col("sj"))
    cor = F.least(F.lit(1.0), F.greatest(F.lit(-1.0), (F.col("n") * F.col("dot") - F.col("si") * F.col("sj")) / spread))
    adjacency = reuse(mirrored(pairs.select(*by, "col_i", "col_j", F.pow((1.0 + cor) / 2.0, F.lit(float(power))).alias("dot")), by))
    degree = adjacency.groupBy(*by, F.col("col_i").alias("gene_id")).agg(F.sum("dot").alias("connectivity"))
    shared = gram(adjacency, by, "col_i", "col_j", "dot", tiles).where(F.col("col_i") != F.col("col_j")).withColumnRenamed("dot", "_shared")
    end = lambda e: degree.select(*by, F.col("gene_id").alias(f"col_{e}"), F.col("connectivity").alias(f"k{e}"))
    edges = adjacency.where(F.col("col_i") < F.col("col_j")).join(shared, [*by, "col_i", "col_j"]).join(end("i"), [*by, "col_i"]).join(end("j"), [*by, "col_j"])
    a = F.col("dot")
    tom = (F.col("_shared") + a) / F.greatest(F.least("ki", "kj") + 1.0 - a, F.lit(2.220446049250313e-16))
    return edges.select(*by, F.col("col_i").alias("gene_a"), F.col("col_j").alias("gene_b"), a.alias("adjacency"), tom.alias("tom")), degree


def connected(nodes: DataFrame, edges: DataFrame, by: list[str]) -> DataFrame:
    """Smallest label reachable over the edges (a, b), per ``by``; runs until nothing moves.

    Large-star and small-star turns: each node hands its neighbours to the
    smallest one it knows, first those above it, then those below.  Edges never
    grow in number, distances shrink by a constant factor each turn, and the fixed
    point is a star around the smallest node of every component.
    """
    links = edges.where(F.col("a") != F.col("b"))
    links = reuse(links.select(*by, F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = F.xxhash64(*by, "a", "b")
    state = links.agg(F.count(F.lit(1)), F.bit_xor(mark)).first()
    while state[0]:
        for large in (True, False):
            pairs = links.select(*by, F.col("a").alias("u"), F.col("b").alias("v"))
            if large:
                pairs = pairs.unionByName(links.select(*by, F.col("b").alias("u"), F.col("a").alias("v")))
            lowest = pairs.groupBy(*by, "u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
            met = pairs.join(lowest, [*by, "u"])
            moved = met.where(F.col("v") > F.col("u")) if large else met.where(F.col("v") != F.col("m"))
            found = moved.select(*by, F.col("v").alias("a"), F.col("m").alias("b"))
            if not large:
                found = found.unionByName(met.select(*by, F.col("u").alias("a"), F.col("m").alias("b")))
            links = found.where(F.col("a") != F.col("b")).distinct()
        links = reuse(links)
        before, state = state, links.agg(F.count(F.lit(1)), F.bit_xor(mark)).first()
        if state == before:
            break
    stars = links.select(*by, F.col("a").alias("node"), F.col("b").alias("label"))
    return nodes.join(stars, [*by, "node"], "left").select(*by, "node", F.coalesce("label", "node").alias("label"))


def modules(edges: DataFrame, expression: DataFrame, value: str = "value", threshold: float = 0.2, min_size: int = 5) -> tuple[DataFrame, DataFrame]:
    """(module per gene, first component per module and sample); small modules are grey."""
    by = ["dataset_id"]
    nodes = edges.select(*by, F.col("gene_a").alias("node")).union(edges.select(*by, F.col("gene_b").alias("node"))).distinct()
    linked = edges.where(F.col("tom") >= threshold).select(*by, F.col("gene_a").alias("a"), F.col("gene_b").alias("b"))
    labels = connected(nodes, linked, by)
    sizes = labels.groupBy(*by, "label").agg(F.count(F.lit(1)).alias("_n"))
    named = reuse(labels.join(sizes, [*by, "label"]).select(*by, F.col("node").alias("gene_id"), F.when(F.col("_n") >= min_size, F.concat(F.lit("module_"), "label")).otherwise(F.lit("grey")).alias("module")))
    real = named.where(F.col("module") != "grey")
    samples = expression.select(*by, "sample_id").distinct()
    dense = real.join(samples, by).join(expression.select(*by, "gene_id", "sample_id", F.col(value).cast("double").alias("x")), [*by, "gene_id", "sample_id"], "left").na.fill(0.0, ["x"])
    w = W.partitionBy(*by, "gene_id")  # one gene's samples
    z = F.try_divide(F.col("x") - F.avg("x").over(w), F.stddev_samp("x").over(w))
    pair = F.to_json(F.struct("dataset_id", "module"))
    scaled = dense.select(pair.alias("dataset_id"), "gene_id", "sample_id", F.coalesce(z, F.lit(0.0)).alias("count"))
    parts = F.from_json("dataset_id", "dataset_id string, module string")
    first = sample_pca(scaled, k=1, transform="none").select(
        parts["dataset_id"].alias("dataset_id"), parts["module"].alias("module"), "sample_id", F.col("PC1").alias("eigengene")
    )
    return named, first


def cell_fractions(expression: DataFrame, signature: DataFrame, value: str = "value", min_genes: int = 10) -> DataFrame:
    """Non-negative least squares per sample, scaled to one, with its certificate.

    ``signature`` is (gene_id, cell_type, weight).  Only sums over genes are
    needed: cell types squared once, cell types per sample.  ``gradient`` is that of
    half the squared residual, over the largest product of the sample: at the
    optimum it is zero where the weight is positive and nowhere below zero.
    ``residual`` is the squared norm left over.
    """
    shared = signature.join(expression.select("gene_id").distinct(), "gene_id", "left_semi")
    genes = shared.select("gene_id").distinct().agg(F.count(F.lit(1)).alias("_genes"))
    shared = shared.crossJoin(F.broadcast(genes)).where(F.col("_genes") >= min_genes).drop("_genes")  # one row
    products = mirrored(gram(shared, [], "gene_id", "cell_type", "weight"), [])
    rows = products.groupBy("col_i").agg(F.transform(F.array_sort(F.collect_list(F.struct("col_j", "dot"))), lambda s: s["dot"]).alias("row"))  # cell types
    matrix = rows.agg(F.array_sort(F.collect_list(F.struct("col_i", "row"))).alias("_m")).select(F.transform("_m", lambda s: s["col_i"]).alias("types"), F.transform("_m", lambda s: s["row"]).alias("ata"))
    each = ["dataset_id", "sample_id"]
    target = expression.join(shared, "gene_id").groupBy(*each, "cell_type").agg(F.sum(F.col("weight") * F.col(value)).alias("_t"))
    per = target.groupBy(*each).agg(F.map_from_entries(F.collect_list(F.struct("cell_type", "_t"))).alias("_map"))
    known = shared.select("gene_id").distinct()
    norms = expression.join(known, "gene_id", "left_semi").groupBy(*each).agg(F.sum(F.col(value) * F.col(value)).alias("yty"))
    joined = per.join(norms, each).crossJoin(F.broadcast(matrix)).withColumn("aty", F.transform("types", lambda t: F.coalesce(F.try_element_at(F.col("_map"), t), F.lit(0.0))))  # one row
    x = fitted_weights("ata", "aty")
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda u, v: u * v), F.lit(0.0), lambda s, v: s + v)
    fitted = joined.withColumn("_x", x).withColumn("_fit", F.transform("ata", lambda r: dot(r, F.col("_x"))))
    scale = F.greatest(F.aggregate("aty", F.lit(0.0), lambda s, v: F.greatest(s, F.abs(v))), F.lit(1e-300))
    total = F.aggregate("_x", F.lit(0.0), lambda s, v: s + v)
    fitted = fitted.withColumns({
        "_total": total, "residual": F.greatest(F.lit(0.0), F.col("yty") - 2.0 * dot(F.col("_x"), F.col("aty")) + dot(F.col("_x"), F.col("_fit"))),
        "_g": F.zip_with("_fit", "aty", lambda f, t: (f - t) / scale)})
    shares = fitted.select(*each, "_total", "residual", F.explode(F.arrays_zip("types", "_x", "_g")).alias("_z"))
    weight, gradient = F.col("_z._x"), F.col("_z._g")
    # Whether this cell type's condition holds: no pull upwards, and none at all on a positive weight.
    return shares.select(
        *each, F.col("_z.types").alias("cell_type"), F.when(F.col("_total") > 0, weight / F.col("_total")).otherwise(F.lit(0.0)).alias("fraction"),
        gradient.alias("gradient"), ((gradient >= -FIT_TOLERANCE) & ((weight == 0) | (F.abs(gradient) <= FIT_TOLERANCE))).alias("converged"), "residual")


@pandas_udf(T.ArrayType(T.DoubleType()))
def fitted_weights(ata: pd.Series, aty: pd.Series) -> pd.Series:
    """Active sets: free the most wanted variable, solve on the free ones, step back to the border where one turns negative."""
    return pd.Series([_active_set(np.array([list(r) for r in m]), np.array(t)) for m, t in zip(ata, aty)])


def _active_set(ata: np.ndarray, aty: np.ndarray) -> np.ndarray:
    x, free, seen = np.zeros(len(aty)), np.zeros(len(aty), bool), set()
    floor = 1e-12 * max(np.abs(aty).max(initial=0.0), 1e-300)
    while True:
        pull = np.where(free, -np.inf, aty - ata @ x)
        # Each set of free variables comes once; among dependent cell types rounding could bring one back.
        if not pull.max(initial=-np.inf) > floor or free.tobytes() in seen:
            return x
        seen.add(free.tobytes())
        free[pull.argmax()] = True
        while free.any():
            z = np.zeros_like(x)
            z[free] = np.linalg.lstsq(ata[np.ix_(free, free)], aty[free], rcond=None)[0]
            low = free & (z <= 0)
            if not low.any():
                x = z
                break
            gap = x - z
            step = np.where(low, np.divide(x, gap, out=np.zeros_like(x), where=gap > 0), np.inf)
            x = x + step.min() * (z - x)
            free &= step > step.min()
            x[~free] = 0.0


def survival_scan(expression: DataFrame, survival: DataFrame, value: str = "value", max_genes: int = 500, min_samples: int = 5) -> DataFrame:
    """Proportional-hazards slope per gene of largest variance, with adjusted p.

    ``survival`` is (dataset_id, sample_id, time, event).  A gene's group is one
    row per sample; genes are spread over the tasks.
    """
    by = ["dataset_id"]
    about = survival.select(*by, "sample_id", F.col("time").cast("double").alias("time"), F.col("event").cast("double").alias("event"))
    rows = expression.join(about.select(*by, "sample_id"), [*by, "sample_id"], "left_semi")
    enough = about.join(rows.select(*by, "sample_id").distinct(), [*by, "sample_id"], "left_semi").groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_samples).select(*by)
    genes = top_variance_genes(rows, value, max_genes).select(*by, "gene_id").join(enough, by, "left_semi")
    dense = genes.join(about, by).join(rows.select(*by, "gene_id", "sample_id", F.col(value).cast("double").alias("x")), [*by, "gene_id", "sample_id"], "left").na.fill(0.0, ["x"])
    fits = dense.groupBy(*by, "gene_id").applyInPandas(_hazard, "dataset_id string, gene_id string, coefficient double, standard_error double, converged boolean")
    from countloom.functions.special import two_sided_p

    tested = fits.where(F.col("standard_error") > 0).withColumn("hazard_ratio", F.exp("coefficient")).withColumn("pvalue", two_sided_p(F.col("coefficient") / F.col("standard_error")))
    return bh_adjust(tested, "pvalue", by, small=True)  # at most max_genes per dataset


def _hazard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Newton steps on the partial likelihood with Efron's handling of tied times, halved until it grows.

    Ends at a step of no size, with ``converged``, or where the likelihood has no
    maximum: its curvature vanishes while the steps do not.
    """
    order = np.argsort(-rows["time"].to_numpy(), kind="stable")
    time, event, raw = (rows[c].to_numpy()[order] for c in ("time", "event", "x"))
    scale = raw.std() or 1.0
    x = (raw - raw.mean()) / scale
    dead = np.flatnonzero(event > 0)
    ends = np.searchsorted(-time, -time[dead], side="right") - 1
    _, first, tied, size = np.unique(-time[dead], return_index=True, return_inverse=True, return_counts=True)
    part = (np.arange(len(dead)) - first[tied]) / size[tied]

    def at(b: float) -> tuple[float, float, float]:
        """Log likelihood, score and information."""
        top = (b * x).max()
        w = np.exp(b * x - top)
        s0, s1, s2 = (np.cumsum(v)[ends] - part * np.bincount(tied, v[dead], len(size))[tied] for v in (w, w * x, w * x * x))
        with np.errstate(all="ignore"):
            mean = s1 / s0
            return (b * x[dead] - top - np.log(s0)).sum(), (x[dead] - mean).sum(), (s2 / s0 - mean * mean).sum()

    b, done = 0.0, False
    height, score, info = at(b) if len(dead) else (0.0, 0.0, 0.0)
    while info > 1e-12:
        step = score / info
        if abs(step) <= 1e-9 * (1 + abs(b)):
            done = True
            break
        trial = at(b + step)
        while not trial[0] > height and abs(step) > 1e-12 * (1 + abs(b)):
            step /= 2
            trial = at(b + step)
        if not trial[0] > height:
            # No higher point is told apart: the top, to rounding, if the slope says so too.
            done = abs(score / info) <= 1e-6 * (1 + abs(b))
            break
        b, (height, score, info) = b + step, trial
    error = 1.0 / np.sqrt(info) / scale if info > 1e-12 else float("nan")
    return pd.DataFrame({"dataset_id": [key[0]], "gene_id": [key[1]], "coefficient": [b / scale], "standard_error": [error], "converged": [done]})
