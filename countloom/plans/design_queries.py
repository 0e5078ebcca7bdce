"""Registered queries: designs with interactions, contrasts of pseudobulk units and joint builds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countloom.operators import designs as M
from countloom.operators import pseudobulk as P
from countloom.operators import studies
from countloom.plans.cell_queries import PB, bulk
from countloom.plans.registry import Registry, rounded
from countloom.plans.reviewed import TEXT, reviewed
from countloom.plans.rule_queries import MISS
from countloom.plans.views import Views, sql

queries = Registry()

FACTORS = ("group", "sex", "age", "batch", "condition")
#: Formula, its variables, and by hand the products of factors that need columns.
DESIGNS = {
    "~ group * sex + age": (("group", "sex", "age"), ((), ("group",), ("sex",), ("age",), ("group", "sex"))),
    "~ 0 + group:sex": (("group", "sex"), ((), ("group",), ("sex",), ("group", "sex"))),
    "~ group + condition": (("group", "condition"), ((), ("group",), ("condition",))),
    "~ C(age) + sex": (("age", "sex"), ((), ("C(age)",), ("sex",))),
    "(group + sex) * batch": (
        ("group", "sex", "batch"), ((), ("group",), ("sex",), ("batch",), ("group", "batch"), ("sex", "batch")),
    ),
    "~ age:group + condition:sex": (
        ("age", "group", "condition", "sex"), ((), ("age",), ("group", "age"), ("condition",), ("sex",), ("condition", "sex")),
    ),
}


def formulas(v: Views, names: dict) -> DataFrame:
    """The formulas of a query as a table; a handful of rows."""
    return v.spark.createDataFrame([(f,) for f in names], "formula string").withColumn("terms", M.formula_terms("formula"))


def _value(factors: tuple[str, ...]) -> str:
    return f"[{', '.join(repr(f) for f in factors)}]::VARCHAR[]"


def design_ctes(designs: dict, samples: str) -> dict[str, str]:
    """Ranks of the designs by coding every column, adding the products and eliminating row by row.

    ``samples`` gives ds, id and one text column per factor; a missing value is one of MISS.
    """
    needs = " UNION ALL ".join(f"SELECT '{f}' AS f, {_value(n)} AS needs" for f, (n, _) in designs.items())
    parts = " UNION ALL ".join(
        f"SELECT '{f}' AS f, {i} AS part, {repr(p[0]) if p else 'NULL'} AS a, {repr(p[1]) if len(p) > 1 else 'NULL'} AS b"
        for f, (_, ps) in designs.items() for i, p in enumerate(ps)
    )
    used = sorted({n for needed, _ in designs.values() for n in needed})
    long = " UNION ALL ".join(f"SELECT ds, id, '{c}' AS v, \"{c}\" AS value FROM samples" for c in used)
    column = "coalesce(CASE WHEN x.numeric THEN a WHEN a IS NOT NULL THEN a || '=' || xv.value END, 'Intercept') || coalesce(':' || CASE WHEN y.numeric THEN b ELSE b || '=' || yv.value END, '')"
    return {
        "samples": samples,
        "needs": needs,
        "parts": parts,
        "given": f"SELECT * FROM ({long}) WHERE value NOT IN {MISS}",
        "fine": "SELECT f, ds, id FROM needs CROSS JOIN (SELECT ds, id, list(v) AS have FROM given GROUP BY ALL) WHERE list_has_all(have, needs)",
        "facts": "SELECT DISTINCT f, factor, regexp_replace(factor, '^C\\((.*)\\)$', '\\1') AS v FROM (SELECT f, a AS factor FROM parts UNION ALL SELECT f, b FROM parts) WHERE factor IS NOT NULL",
        "levels": """SELECT f, ds, factor, v, min(value) AS base, count(DISTINCT value) AS k, bool_and(factor = 'age' AND TRY_CAST(value AS DOUBLE) IS NOT NULL) AS numeric
            FROM fine JOIN facts USING (f) JOIN given USING (ds, id, v) GROUP BY ALL""",
        "widths": """SELECT p.f, d.ds, sum(coalesce(CASE WHEN x.numeric THEN 1 ELSE x.k - 1 END, 1) * coalesce(CASE WHEN y.numeric THEN 1 ELSE y.k - 1 END, 1))::INT AS n_columns
            FROM parts p JOIN (SELECT DISTINCT f, ds FROM fine) d USING (f) LEFT JOIN levels x ON x.f = p.f AND x.ds = d.ds AND x.factor = a
            LEFT JOIN levels y ON y.f = p.f AND y.ds = d.ds AND y.factor = b GROUP BY ALL""",
        "coded": f"""SELECT fine.f, fine.ds, fine.id, {column} AS c, (CASE WHEN x.numeric THEN xv.value::DOUBLE ELSE 1 END) * (CASE WHEN y.numeric THEN yv.value::DOUBLE ELSE 1 END) AS x
            FROM fine JOIN parts USING (f) LEFT JOIN levels x ON x.f = fine.f AND x.ds = fine.ds AND x.factor = a LEFT JOIN given xv ON xv.ds = fine.ds AND xv.id = fine.id AND xv.v = x.v
            LEFT JOIN levels y ON y.f = fine.f AND y.ds = fine.ds AND y.factor = b LEFT JOIN given yv ON yv.ds = fine.ds AND yv.id = fine.id AND yv.v = y.v
            WHERE (a IS NULL OR x.numeric OR xv.value <> x.base) AND (b IS NULL OR y.numeric OR yv.value <> y.base)""",
        # Every design twice: with and without the columns of the tested factor.
        "twice": "SELECT *, true AS whole FROM coded UNION ALL SELECT *, false FROM coded WHERE NOT (c LIKE 'group=%' AND c NOT LIKE '%:%')",
        "cols": "SELECT f, ds, whole, c, sqrt(sum(x * x)) AS size, row_number() OVER (PARTITION BY f, ds, whole ORDER BY c) AS i FROM twice GROUP BY f, ds, whole, c",
        "dots": "SELECT p.f, p.ds, p.whole, p.c AS c1, q.c AS c2, sum(p.x * q.x) AS d FROM twice p JOIN twice q USING (f, ds, whole, id) GROUP BY ALL",
        "grid": """SELECT m.f, m.ds, m.whole, m.i, list(coalesce(d, 0) / m.size / o.size ORDER BY o.i) AS r FROM cols m JOIN cols o USING (f, ds, whole)
            LEFT JOIN dots ON dots.f = m.f AND dots.ds = m.ds AND dots.whole = m.whole AND c1 = m.c AND c2 = o.c GROUP BY ALL""",
        "turns": """SELECT f, ds, whole, 1 AS k, list(r ORDER BY i) AS m, 0 AS rank FROM grid GROUP BY ALL UNION ALL
            SELECT f, ds, whole, k + 1, CASE WHEN m[k][k] > 1e-9 THEN list_transform(m, lambda row: list_transform(range(1, len(m) + 1), lambda j: row[j] - row[k] * m[k][j] / m[k][k])) ELSE m END,
            rank + (m[k][k] > 1e-9)::INT FROM turns WHERE k <= len(m)""",
        "ranks": "SELECT f, ds, whole, rank FROM turns WHERE k = len(m) + 1",
        "tests": "SELECT f, ds, count(*) AS n FROM cols WHERE whole AND c LIKE 'group=%' AND c NOT LIKE '%:%' GROUP BY ALL",
        "fits": """SELECT n.f, s.ds, s.n_samples, coalesce(r.n_rows, 0) AS n_rows, coalesce(n_columns, 0) AS n_columns, coalesce(w.rank, 0) AS rank, coalesce(w.rank = n_columns, false) AS full_rank,
            coalesce(w.rank - coalesce(o.rank, 0) = t.n, false) AS estimable FROM needs n CROSS JOIN (SELECT ds, count(*) AS n_samples FROM samples GROUP BY ALL) s
            LEFT JOIN (SELECT f, ds, count(*) AS n_rows FROM fine GROUP BY ALL) r ON r.f = n.f AND r.ds = s.ds LEFT JOIN widths d ON d.f = n.f AND d.ds = s.ds
            LEFT JOIN ranks w ON w.f = n.f AND w.ds = s.ds AND w.whole LEFT JOIN ranks o ON o.f = n.f AND o.ds = s.ds AND NOT o.whole LEFT JOIN tests t ON t.f = n.f AND t.ds = s.ds""",
    }


def recursive(text: str) -> str:
    return text.replace("WITH ", "WITH RECURSIVE ", 1)


def manifest_designs(v: Views) -> DataFrame:
    """Six formulas over the samples of every dataset."""
    values = F.create_map(*[x for c in FACTORS for x in (F.lit(c), F.col(c))])
    rows = reviewed(v, "manifest").select("dataset_id", F.col("line").alias("row"), values.alias("values"))
    both = rows.join(F.broadcast(formulas(v, DESIGNS)))  # six rows
    return M.fit_designs(both, ["formula", "dataset_id"])


queries.add(
    "interaction_designs", manifest_designs,
    recursive(sql("", "SELECT f AS formula, ds AS dataset_id, * EXCLUDE (f, ds) FROM fits", manifest=TEXT["manifest"], **design_ctes(DESIGNS, 'SELECT dataset_id AS ds, line AS id, "group", sex, age, batch, condition FROM manifest'))),
)

UNIT_DESIGNS = {
    "~ group + dataset": (("group", "dataset"), ((), ("group",), ("dataset",))),
    "~ group * dataset": (("group", "dataset"), ((), ("group",), ("dataset",), ("group", "dataset"))),
    "~ dataset + group:batch": (("dataset", "group", "batch"), ((), ("dataset",), ("group",), ("batch",), ("group", "batch"))),
}


def unit_designs(v: Views) -> DataFrame:
    """Designs of the pseudobulk units of every cell type, all datasets together."""
    units = P.eligible(bulk(v)[1])
    values = F.create_map(F.lit("group"), F.col("group"), F.lit("dataset"), F.col("dataset_id"), F.lit("batch"), F.col("batch"))
    rows = units.select("cell_type", F.concat_ws("|", "dataset_id", "subject_id", "group").alias("row"), values.alias("values"))
    return M.fit_designs(rows.join(F.broadcast(formulas(v, UNIT_DESIGNS))), ["formula", "cell_type"])  # three rows


queries.add(
    "pseudobulk_designs", unit_designs,
    recursive(sql("cells cell_counts", "SELECT f AS formula, ds AS cell_type, * EXCLUDE (f, ds) FROM fits", **PB, **design_ctes(UNIT_DESIGNS, """SELECT cell_type AS ds, dataset_id || '|' || subject_id || '|' || "group" AS id, "group", dataset_id AS dataset, batch FROM pbm WHERE r = ''"""))),
)

CONTRASTS = """SELECT concat('P', r_regionkey) AS contrast_id, 'J1' AS analysis_id, 'scrna_pseudobulk' AS data_scope, CASE WHEN r_regionkey % 2 = 0 THEN 'case' ELSE 'other' END AS numerator, 'control' AS denominator,
    '~ group + dataset' AS design_formula, CASE r_regionkey WHEN 0 THEN '3' WHEN 1 THEN '2' WHEN 2 THEN '60' WHEN 3 THEN 'x' ELSE '2' END AS min_replicates_per_group, CASE WHEN r_regionkey = 4 THEN 'false' ELSE 'true' END AS enabled FROM region"""
PLAN = "SELECT 'J1' AS analysis_id, r_name AS dataset_id, 'true' AS include, 'discovery' AS role, 'joint_model' AS analysis_strategy FROM region"


def small(v: Views, text: str) -> DataFrame:
    return v.spark.sql(text.replace("FROM region", "FROM {region}"), region=v.t("region"))


SIDED = {
    "con": f"SELECT *, greatest(coalesce(TRY_CAST(min_replicates_per_group AS INT), 1), 2) AS minimum FROM ({CONTRASTS}) WHERE enabled = 'true'",
    "units": "SELECT dataset_id, subject_id, \"group\", cell_type, total_UMI FROM pbm WHERE r = ''",
    "sided": 'SELECT contrast_id, minimum, u.*, "group" = numerator AS up FROM units u JOIN con ON "group" IN (numerator, denominator)',
    "state": """SELECT contrast_id, cell_type, minimum, coalesce(n1, 0) AS n1, coalesce(n0, 0) AS n0 FROM con CROSS JOIN (SELECT DISTINCT cell_type FROM units)
        LEFT JOIN (SELECT contrast_id, cell_type, count(DISTINCT dataset_id || '|' || subject_id) FILTER (WHERE up) AS n1, count(DISTINCT dataset_id || '|' || subject_id) FILTER (WHERE NOT up) AS n0 FROM sided GROUP BY ALL) USING (contrast_id, cell_type)""",
}
queries.add(
    "pseudobulk_contrast_status", lambda v: P.contrast_status(bulk(v)[1], small(v, CONTRASTS), 2),
    sql("cells cell_counts", """SELECT contrast_id, cell_type, CASE WHEN n1 >= minimum AND n0 >= minimum THEN 'tested' ELSE 'skipped_insufficient_subjects' END AS status,
        minimum AS minimum_subjects_per_group, n1 AS numerator_subjects, n0 AS denominator_subjects FROM state""", **PB, **SIDED),
)
# The moments of the test written out; p-values follow from stat by the normal distribution, which the units tests hold.
queries.add(
    "pseudobulk_contrast_effects",
    lambda v: rounded(P.contrast_tests(*bulk(v, True), small(v, CONTRASTS), 2, adjust=False)[0].select("contrast_id", "cell_type", "gene_id", "sample_size", "baseMean", "log2FoldChange", "lfcSE", "stat"), "baseMean", "log2FoldChange", "lfcSE", "stat"),
    sql("cells cell_counts", """SELECT contrast_id, cell_type, gene_id, a + b AS sample_size, round(base, 6) AS baseMean, round(effect, 6) AS log2FoldChange, round(se, 6) AS lfcSE, round(effect / se, 6) AS stat FROM waldform""",
        **PB, **SIDED,
        tested="SELECT s.*, avg(total_UMI) OVER (PARTITION BY s.contrast_id, s.cell_type) AS level FROM sided s JOIN state t USING (contrast_id, cell_type) WHERE n1 >= t.minimum AND n0 >= t.minimum",
        scaled='SELECT contrast_id, cell_type, gene_id, up, count, count / total_UMI * level AS x, total_UMI / level AS f, dataset_id, subject_id FROM pbc JOIN tested USING (dataset_id, subject_id, "group", cell_type)',
        sides="SELECT contrast_id, cell_type, count(*) FILTER (WHERE up) AS a, count(*) FILTER (WHERE NOT up) AS b, avg(1 / f) FILTER (WHERE up) AS ra, avg(1 / f) FILTER (WHERE NOT up) AS rb FROM (SELECT DISTINCT contrast_id, cell_type, dataset_id, subject_id, up, f FROM scaled) GROUP BY ALL",
        moments="""SELECT contrast_id, cell_type, gene_id, sum(CASE WHEN up THEN x ELSE 0 END) AS s1, sum(CASE WHEN up THEN x * x ELSE 0 END) AS q1, sum(CASE WHEN up THEN 0 ELSE x END) AS s0, sum(CASE WHEN up THEN 0 ELSE x * x END) AS q0 FROM scaled GROUP BY ALL HAVING sum(count) > 0""",
        means="SELECT *, s1 / a AS m1, s0 / b AS m0, (s1 + s0) / (a + b) AS base, (a * ra + b * rb) / (a + b) * (s1 + s0) / (a + b) AS noise FROM moments JOIN sides USING (contrast_id, cell_type) WHERE a > 0 AND b > 0",
        spread="SELECT *, greatest(1e-8, ((q1 - s1 * m1 + q0 - s0 * m0) / (a + b - 2) - noise) / (base * base)) AS alpha FROM means",
        waldform="""SELECT *, log2((m1 + 0.5) / (m0 + 0.5)) AS effect, sqrt((m1 * ra + alpha * m1 * m1) / a / ((m1 + 0.5) * (m1 + 0.5)) + (m0 * rb + alpha * m0 * m0) / b / ((m0 + 0.5) * (m0 + 0.5))) / ln(2) AS se FROM spread""",
    ),
)


def joint_build(v: Views) -> DataFrame:
    """Units and counts that enter the joint model of all datasets, per dataset and cell type."""
    counts, metadata = bulk(v)
    genes = v.genes().select("gene_id").join(F.broadcast(v.t("region").select(F.col("r_name").alias("dataset_id"))))  # five rows
    on = small(v, CONTRASTS).where("contrast_id = 'P0'")
    stacked, units, _ = studies.joint_pseudobulk(counts, metadata.where(F.col("group") != "other"), genes, small(v, PLAN), on, "J1", 2)
    sums = stacked.groupBy("dataset_id", "cell_type").agg(F.count(F.lit(1)).alias("entries"), F.sum("count").alias("total"))
    return units.groupBy("dataset", "dataset_id", "cell_type").agg(F.count(F.lit(1)).alias("units")).join(sums, ["dataset_id", "cell_type"])


queries.add(
    "joint_pseudobulk", joint_build,
    sql("cells cell_counts", """SELECT dataset_id AS dataset, dataset_id, cell_type, units, entries, total FROM (SELECT dataset_id, cell_type, count(*) AS units FROM chosen GROUP BY ALL)
        JOIN (SELECT dataset_id, cell_type, count(*) AS entries, sum(count)::BIGINT AS total FROM pbc JOIN chosen USING (dataset_id, subject_id, "group", cell_type) GROUP BY ALL) USING (dataset_id, cell_type)""",
        **PB, chosen="SELECT dataset_id, subject_id, \"group\", cell_type FROM pbm WHERE r = '' AND \"group\" <> 'other'"),
)
