"""Driver tables shaped into the engine's schemas, in Spark and in plain SQL.

Each view exists twice on purpose: the DataFrame form feeds the operators, the
SQL text feeds the side-by-side check.  Nothing is subset: every view covers
its whole source tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


class Views:
    """Lazy views over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf

    def t(self, name: str) -> DataFrame:
        return table(self.spark, self.sf, name)

    def places(self) -> DataFrame:
        """Nations with their region: 25 rows whatever the scale."""
        return self.t("nation").join(self.t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
            "n_nationkey", "n_name", F.col("r_name").alias("dataset_id")
        )

    def supply(self) -> DataFrame:
        supplier = self.t("supplier").select("s_suppkey", "s_nationkey")
        return supplier.join(F.broadcast(self.places()), F.col("s_nationkey") == F.col("n_nationkey"))

    def lines(self) -> DataFrame:
        """Line items with the supplier's nation and region."""
        cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate"]
        return self.t("lineitem").select(*cols).join(self.supply(), F.col("l_suppkey") == F.col("s_suppkey"))

    def counts(self, grain: str = "supplier") -> DataFrame:
        """Bulk counts; a sample is a supplier, a nation, or a nation's ship year."""
        sample = {
            "supplier": F.concat(F.lit("S"), F.col("l_suppkey")),
            "nation": F.col("n_name"),
            "year": F.concat_ws("_", "n_name", F.year("l_shipdate")),
        }[grain]
        return (
            self.lines()
            .groupBy(
                "dataset_id",
                F.concat(F.lit("G"), F.col("l_partkey")).alias("gene_id"),
                sample.alias("sample_id"),
            )
            .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("count"))
        )

    def samples(self, grain: str = "supplier") -> DataFrame:
        side = lambda key: F.when(F.col(key) % 2 == 1, F.lit("case")).otherwise(F.lit("control"))
        if grain == "supplier":
            return self.supply().select(
                "dataset_id",
                F.concat(F.lit("S"), F.col("s_suppkey")).alias("sample_id"),
                F.concat(F.lit("D"), F.floor(F.col("s_suppkey") / 2).cast("bigint")).alias("subject_id"),
                side("s_suppkey").alias("group"),
                F.col("n_name").alias("batch"),
            )
        base = self.places().select(
            "dataset_id",
            F.col("n_name").alias("sample_id"),
            F.col("n_name").alias("subject_id"),
            side("n_nationkey").alias("group"),
            F.when(F.col("n_nationkey") < 13, F.lit("b1")).otherwise(F.lit("b2")).alias("batch"),
        )
        if grain == "nation":
            return base
        years = self.lines().select("n_name", F.year("l_shipdate").alias("y")).distinct()
        return base.join(years, F.col("sample_id") == F.col("n_name")).select(
            "dataset_id", F.concat_ws("_", "sample_id", "y").alias("sample_id"), "subject_id", "group",
            F.col("y").cast("string").alias("batch"),
        )

    def genes(self) -> DataFrame:
        return self.t("part").select(
            F.concat(F.lit("G"), F.col("p_partkey")).alias("gene_id"),
            F.col("p_name").alias("gene_symbol"),
            F.col("p_type").alias("pathway"),
            F.col("p_brand").alias("marker_set"),
        )

    def cells(self) -> DataFrame:
        """One cell per order; the donor is the customer, the label its priority."""
        customer = self.t("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        orders = self.t("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
        return (
            orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(F.broadcast(self.places()), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("o_orderkey").alias("cell_id"),
                "dataset_id",
                F.col("n_name").alias("sample_id"),
                F.concat(F.lit("C"), F.col("c_custkey")).alias("subject_id"),
                F.when(F.col("o_orderstatus") == "F", F.lit("case"))
                .when(F.col("o_orderstatus") == "O", F.lit("control"))
                .otherwise(F.lit("other"))
                .alias("group"),
                F.col("o_orderpriority").alias("author_label"),
                F.col("c_mktsegment").alias("batch"),
            )
        )

    def cell_counts(self) -> DataFrame:
        return (
            self.t("lineitem")
            .select("l_orderkey", "l_partkey", "l_quantity")
            .repartition("l_orderkey")  # the sums lie by cell, as their join asks for
            .groupBy("l_orderkey", "l_partkey")  # numbers are grouped, not texts
            .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("count"))
            .select(F.col("l_orderkey").alias("cell_id"), F.concat(F.lit("G"), F.col("l_partkey")).alias("gene_id"), "count")
        )

    def evidence(self, extra: tuple[str, ...] = ()) -> DataFrame:
        """Returned against accepted quantity per part and region, delta-method error."""
        q = F.col("l_quantity").cast("bigint")
        side = lambda flag, x: F.sum(F.when(F.col("l_returnflag") == flag, x).otherwise(0))
        sums = self.lines().groupBy("dataset_id", "l_partkey", *extra).agg(
            side("R", F.lit(1)).alias("n1"), side("R", q).alias("s1"), side("R", q * q).alias("q1"),
            side("A", F.lit(1)).alias("n0"), side("A", q).alias("s0"), side("A", q * q).alias("q0"),
        )
        div = F.try_divide  # a filter may run before or after these ratios

        def spread(n: str, s: str, q2: str):
            variance = div(F.col(q2) - div(F.col(s) * F.col(s), F.col(n)), F.col(n) - 1)
            return div(variance * F.col(n), F.col(s).cast("double") * F.col(s))

        rel = spread("n1", "s1", "q1") + spread("n0", "s0", "q0")
        scored = sums.where((F.col("n1") >= 2) & (F.col("n0") >= 2)).select(
            F.concat(F.lit("G"), F.col("l_partkey")).alias("gene_id"),
            "l_partkey",
            "dataset_id",
            *extra,
            F.log2(div(div(F.col("s1"), F.col("n1")), div(F.col("s0"), F.col("n0")))).alias("log2FoldChange"),
            (F.sqrt(rel) / F.log(F.lit(2.0))).alias("lfcSE"),
            (F.col("n1") + F.col("n0")).cast("double").alias("sample_size"),
        )
        from countloom.functions.special import two_sided_p

        parts = self.t("part").select("p_partkey", F.col("p_name").alias("gene_symbol"))
        return (
            scored.where(F.col("lfcSE") > 0)
            .withColumn("pvalue", two_sided_p(div(F.col("log2FoldChange"), F.col("lfcSE"))))
            .join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .drop("l_partkey", "p_partkey")
        )


def _erfc_sql(x: str) -> str:
    from countloom.functions import special as s

    def poly(coefficients, v):
        out = repr(float(coefficients[0])) + "::double"
        for c in coefficients[1:]:
            out = f"({out} * {v} + {float(c)!r}::double)"
        return out

    inv = "(1.0::double / (x * x))"
    return (
        f"list_transform([({x})::double], lambda x: CASE WHEN x <= 0.46875 THEN 1.0::double - x * {poly(s.ERF_NUM, '(x * x)')} / {poly(s.ERF_DEN, '(x * x)')} "
        f"WHEN x <= 4.0 THEN exp(-x * x) * {poly(s.ERFC_NUM, 'x')} / {poly(s.ERFC_DEN, 'x')} "
        f"ELSE exp(-x * x) / x * ({1.0 / s.SQRT_PI!r}::double - {inv} * {poly(s.TAIL_NUM, inv)} / {poly(s.TAIL_DEN, inv)}) END)[1]"
    )


def two_sided_sql(z: str) -> str:
    return _erfc_sql(f"abs({z}) / sqrt(2.0::double)")


def isf_sql(p: str) -> str:
    from countloom.functions import special as s

    def poly(coefficients, v):
        out = repr(float(coefficients[0])) + "::double"
        for c in coefficients[1:]:
            out = f"({out} * {v} + {float(c)!r}::double)"
        return out

    r = "(0.180625::double - (0.5 - v) * (0.5 - v))"
    t = "sqrt(-ln(least(v, 1.0 - v)))"
    near = f"{poly(s.QUANTILE_NEAR_NUM, f'({t} - 1.6)')} / {poly(s.QUANTILE_NEAR_DEN, f'({t} - 1.6)')}"
    far = f"{poly(s.QUANTILE_FAR_NUM, f'({t} - 5.0)')} / {poly(s.QUANTILE_FAR_DEN, f'({t} - 5.0)')}"
    return (
        f"list_transform([({p})::double], lambda v: CASE WHEN abs(0.5 - v) <= 0.425 THEN (0.5 - v) * {poly(s.QUANTILE_MID_NUM, r)} / {poly(s.QUANTILE_MID_DEN, r)} "
        f"ELSE sign(0.5 - v) * (CASE WHEN {t} <= 5.0 THEN {near} ELSE {far} END) END)[1]"
    )


def _evidence_sql(extra: str = "") -> str:
    also, on = (f", {extra}", f", {extra}") if extra else ("", "")
    spread = lambda k: f"(q{k} - s{k}::double * s{k} / n{k}) / (n{k} - 1) * n{k} / (s{k}::double * s{k})"
    return f"""
  SELECT 'G' || l_partkey AS gene_id, p_name AS gene_symbol, dataset_id{also}, fc AS log2FoldChange, se AS lfcSE,
         n::double AS sample_size, {two_sided_sql('fc / se')} AS pvalue
  FROM (SELECT l_partkey, dataset_id{also}, n1 + n0 AS n, log2((s1::double / n1) / (s0::double / n0)) AS fc,
               sqrt({spread('1')} + {spread('0')}) / ln(2.0::double) AS se
        FROM (SELECT l_partkey, dataset_id{also},
                sum((l_returnflag = 'R')::int)::bigint AS n1, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity::bigint ELSE 0 END)::bigint AS s1,
                sum(CASE WHEN l_returnflag = 'R' THEN l_quantity::bigint * l_quantity::bigint ELSE 0 END)::bigint AS q1,
                sum((l_returnflag = 'A')::int)::bigint AS n0, sum(CASE WHEN l_returnflag = 'A' THEN l_quantity::bigint ELSE 0 END)::bigint AS s0,
                sum(CASE WHEN l_returnflag = 'A' THEN l_quantity::bigint * l_quantity::bigint ELSE 0 END)::bigint AS q0
              FROM lines GROUP BY l_partkey, dataset_id{on}) WHERE n1 >= 2 AND n0 >= 2)
  JOIN part ON p_partkey = l_partkey WHERE se > 0"""


_SUPPLIER_COUNTS = "SELECT dataset_id, 'G' || l_partkey AS gene_id, {sample} AS sample_id, sum(l_quantity::bigint)::bigint AS count FROM lines GROUP BY ALL"

# View name -> (views it needs, SQL).
SQL_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "places": ((), "SELECT n_nationkey, n_name, r_name AS dataset_id FROM nation JOIN region ON n_regionkey = r_regionkey"),
    "supply": (("places",), "SELECT s_suppkey, n_nationkey, n_name, dataset_id FROM supplier JOIN places ON s_nationkey = n_nationkey"),
    "lines": (("supply",), "SELECT * FROM lineitem JOIN supply ON l_suppkey = s_suppkey"),
    "counts": (("lines",), _SUPPLIER_COUNTS.format(sample="'S' || l_suppkey")),
    "counts_nation": (("lines",), _SUPPLIER_COUNTS.format(sample="n_name")),
    "counts_year": (("lines",), _SUPPLIER_COUNTS.format(sample="n_name || '_' || year(l_shipdate)")),
    "samples": (
        ("supply",),
        "SELECT dataset_id, 'S' || s_suppkey AS sample_id, 'D' || (s_suppkey // 2) AS subject_id, "
        "CASE WHEN s_suppkey % 2 = 1 THEN 'case' ELSE 'control' END AS \"group\", n_name AS batch FROM supply",
    ),
    "samples_nation": (
        ("places",),
        "SELECT dataset_id, n_name AS sample_id, n_name AS subject_id, CASE WHEN n_nationkey % 2 = 1 THEN 'case' ELSE 'control' END AS \"group\", "
        "CASE WHEN n_nationkey < 13 THEN 'b1' ELSE 'b2' END AS batch FROM places",
    ),
    "genes": ((), "SELECT 'G' || p_partkey AS gene_id, p_name AS gene_symbol, p_type AS pathway, p_brand AS marker_set FROM part"),
    "cells": (
        ("places",),
        "SELECT o_orderkey AS cell_id, dataset_id, n_name AS sample_id, 'C' || c_custkey AS subject_id, "
        "CASE o_orderstatus WHEN 'F' THEN 'case' WHEN 'O' THEN 'control' ELSE 'other' END AS \"group\", "
        "o_orderpriority AS author_label, c_mktsegment AS batch "
        "FROM orders JOIN customer ON o_custkey = c_custkey JOIN places ON c_nationkey = n_nationkey",
    ),
    "cell_counts": (
        (),
        "SELECT l_orderkey AS cell_id, 'G' || l_partkey AS gene_id, sum(l_quantity::bigint)::bigint AS count FROM lineitem GROUP BY ALL",
    ),
    "evidence": (("lines",), _evidence_sql()),
    "cell_evidence": (("lines",), "SELECT *, l_linestatus AS cell_type FROM (" + _evidence_sql("l_linestatus") + ")"),
}


def sql(views: str, body: str, **extra: str) -> str:
    """``WITH`` clause for the named views (and what they need) plus the body."""
    order: list[str] = []

    def need(name: str) -> None:
        if name in order or name not in SQL_VIEWS:
            return
        for parent in SQL_VIEWS[name][0]:
            need(parent)
        order.append(name)

    for name in views.split():
        need(name)
    parts = [f"{n} AS ({SQL_VIEWS[n][1]})" for n in order] + [f"{n} AS ({q})" for n, q in extra.items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
