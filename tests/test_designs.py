"""Formula expansion, design ranks, contrasts of pseudobulk units and the gates of joint builds."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from countloom.operators import designs, pseudobulk, studies
from countloom.operators.rules.design import pseudobulk_preflight


@pytest.mark.parametrize(
    ("formula", "terms"),
    [
        ("~ group + batch", [(), ("group",), ("batch",)]), ("a*b", [(), ("a",), ("b",), ("a", "b")]), ("~ 0 + a", [("a",)]), ("a - 1", [("a",)]),
        ("~ (a + b) * c", [(), ("a",), ("b",), ("c",), ("a", "c"), ("b", "c")]), ("~ a*b - a:b", [(), ("a",), ("b",)]), ("C(age):a", [(), ("C(age)", "a")]),
        ("", [()]), (None, [()]), ("~ a +", None), ("a ~ b", None), ("a ** 2", None), ("a / b", None), ("(a", None), ("a b", None), ("a:0", None), ("log(a)", None),
    ],
)
def test_expand(formula, terms):
    assert designs.expand(formula) == terms


def dummy_rank(rows, terms, numeric):
    """Rank of the full indicator coding of every term: the span that the formula asks for."""
    blocks = []
    for term in terms:
        levels = [[None] if f in numeric else sorted({r[f] for r in rows}) for f in term]
        for combination in itertools.product(*levels):
            blocks.append([np.prod([float(r[f]) if v is None else float(r[f] == v) for f, v in zip(term, combination)] or [1.0]) for r in rows])
    return int(np.linalg.matrix_rank(np.array(blocks).T)) if blocks else 0


def test_ranks_equal_full_indicator_coding(spark):
    draw = random.Random(3)
    formulas = ["~ group*sex + age", "~ group:sex", "~ 0 + group + age:sex", "~ C(age) + group", "~ group*batch*sex", "~ batch:sex + age", "~ group + twin", "~ 1", "~ 0"]
    rows = [{"group": draw.choice("ab"), "batch": draw.choice("xyz"), "sex": draw.choice("FM"), "age": draw.choice(["20", "30", "41"])} for _ in range(40)]
    for r in rows:
        r["twin"] = r["group"] * 2
    rows[3]["batch"], rows[4]["sex"] = "NA", None
    data = [(f, str(i), r) for f in formulas for i, r in enumerate(rows)]
    table = spark.createDataFrame(data, "formula string, row string, values map<string,string>").withColumn("terms", designs.formula_terms("formula"))
    got = {r["formula"]: r for r in designs.fit_designs(table, ["formula"]).collect()}
    for formula in formulas:
        terms = designs.expand(formula)
        names = {f.removeprefix("C(").removesuffix(")") for t in terms for f in t}
        good = [r | {"C(age)": r["age"]} for r in rows if all(r[n] not in (None, "NA") for n in names)]
        assert got[formula]["n_rows"] == len(good) and got[formula]["n_samples"] == 40
        assert got[formula]["rank"] == dummy_rank(good, terms, ("age",)), formula
        assert got[formula]["full_rank"] == (got[formula]["rank"] == got[formula]["n_columns"]), formula
    assert got["~ group*sex + age"]["n_columns"] == 5 and got["~ group:sex"]["n_columns"] == 4 and got["~ 0"]["rank"] == 0
    assert not got["~ group + twin"]["full_rank"] and not got["~ group + twin"]["estimable"] and got["~ C(age) + group"]["estimable"]


def test_designs_without_rows(spark):
    schema = "formula string, row string, values map<string,string>"
    one = spark.createDataFrame([("~ a", "1", {"a": "NA"}), (None, "1", {})], schema).withColumn("terms", designs.formula_terms("formula"))
    got = {r["formula"]: r for r in designs.fit_designs(one, ["formula"]).collect()}
    assert (got["~ a"]["n_rows"], got["~ a"]["rank"], got["~ a"]["full_rank"]) == (0, 0, False) and got[None]["rank"] == 1
    assert designs.fit_designs(one.limit(0), ["formula"]).count() == 0


UNIT = "dataset_id string, subject_id string, `group` string, cell_type string, total_UMI long, eligibility string, eligible_for_de string, batch string"
CONTRAST = "analysis_id string, contrast_id string, data_scope string, numerator string, denominator string, design_formula string, min_replicates_per_group string, enabled string"


def units(spark, sides=(("x", "a", "b1"), ("x", "b", "b2"), ("y", "a", "b1"), ("y", "b", "b2")), n=3):
    rows = [(d, f"{d}{g}{i}", g, "T", 100, "eligible", "true", batch) for d, g, batch in sides for i in range(n)]
    return spark.createDataFrame(rows, UNIT)


def contrast(spark, formula="~ group", minimum="2"):
    return spark.createDataFrame([("J", "C", "scrna_pseudobulk", "a", "b", formula, minimum, "true")], CONTRAST)


def plan(spark, role="discovery", datasets="xy"):
    return spark.createDataFrame([("J", d, "true", role, "joint_model") for d in datasets], "analysis_id string, dataset_id string, include string, role string, analysis_strategy string")


@pytest.mark.parametrize(
    ("formula", "problems"),
    [
        ("~ group + dataset", set()), ("~ group * dataset", set()), ("NA", set()), ("~ group + batch", {"design_matrix_not_full_rank"}),
        ("~ group + moon", {"design_invalid"}), ("~ group ^ 2", {"design_invalid"}),
    ],
)
def test_preflight_reads_the_formula(spark, formula, problems):
    found = pseudobulk_preflight(units(spark), plan(spark), contrast(spark, formula), 2)
    assert {r["problem"] for r in found.collect()} == problems


def test_preflight_of_missing_values_few_subjects_and_confounding(spark):
    holes = units(spark).withColumn("batch", F.when(F.col("subject_id") == "xa0", "NA").otherwise(F.col("subject_id")))
    assert "design_rows_dropped" in {r["problem"] for r in pseudobulk_preflight(holes, plan(spark), contrast(spark, "~ group + batch"), 2).collect()}
    few = {r["problem"] for r in pseudobulk_preflight(units(spark), plan(spark), contrast(spark), 4).collect()}
    assert few == {"insufficient_subjects:a:3<4", "insufficient_subjects:b:3<4"}
    apart = units(spark, (("x", "a", "b1"), ("y", "b", "b1")))
    assert "dataset_group_complete_confounding" in {r["problem"] for r in pseudobulk_preflight(apart, plan(spark), contrast(spark), 1).collect()}


def test_joint_pseudobulk_gates(spark):
    table = units(spark)
    counts = table.select("dataset_id", "subject_id", "group", "cell_type", F.lit("G1").alias("gene_id"), F.lit(5).cast("bigint").alias("count"))
    genes = spark.createDataFrame([("x", "G1"), ("x", "G2"), ("y", "G1"), ("y", "G2")], "dataset_id string, gene_id string")
    build = lambda g=genes, p=None, c=None, t=table: studies.joint_pseudobulk(counts, t, g, p if p is not None else plan(spark), c if c is not None else contrast(spark), "J", 2)
    stacked, about, problems = build()
    assert stacked.count() == about.count() == 12 and problems.count() == 0 and set(about.select("dataset").distinct().toPandas()["dataset"]) == {"x", "y"}
    refused = [
        (dict(g=genes.where("gene_id = 'G1' OR dataset_id = 'x'")), "gene ids differ"), (dict(g=genes.where("gene_id = 'G2'")), "gene ids differ"),
        (dict(p=plan(spark, "validation")), "validation"), (dict(p=plan(spark, datasets="x")), "several"), (dict(c=contrast(spark).withColumn("enabled", F.lit("false"))), "no enabled"),
        (dict(p=plan(spark).withColumn("analysis_strategy", F.lit("per_dataset_meta"))), "not planned"), (dict(c=contrast(spark, "~ group + batch")), "design_matrix_not_full_rank"),
    ]
    for changed, reason in refused:
        with pytest.raises(RuntimeError, match=reason):
            build(**changed)


def test_joint_pseudobulk_sums_its_units_once(spark):
    table = units(spark)
    counts = table.select("dataset_id", "subject_id", "group", "cell_type", F.lit("G1").alias("gene_id"), F.lit(5).cast("bigint").alias("count"))
    genes = spark.createDataFrame([("x", "G1"), ("y", "G1")], "dataset_id string, gene_id string")
    sums = counts.groupBy("dataset_id", "subject_id", "group", "cell_type").agg(F.sum("count").alias("total_UMI"))
    made = table.drop("total_UMI").join(sums, ["dataset_id", "subject_id", "group", "cell_type"])
    about = studies.joint_pseudobulk(counts, made, genes, plan(spark), contrast(spark), "J", 2)[1]
    assert about.count() == 12
    # The units that the preflight and the result read are written, not summed from the counts again.
    assert not [w for w in ("Join", "Aggregate") if w in about._jdf.queryExecution().executedPlan().toString()]


def test_contrast_minimum_decides(spark):
    table = units(spark).unionByName(units(spark, (("x", "c", "b1"),)))
    counts = table.select("dataset_id", "subject_id", "group", "cell_type", F.lit("G1").alias("gene_id"), (F.length("subject_id") + 3).cast("bigint").alias("count"))
    several = contrast(spark).unionByName(contrast(spark, minimum="7").withColumn("contrast_id", F.lit("D")))
    several = several.unionByName(contrast(spark, minimum="x").withColumn("contrast_id", F.lit("E")).withColumn("numerator", F.lit("c")))
    effects, status = pseudobulk.contrast_tests(counts, table, several, 3)
    got = {r["contrast_id"]: (r["status"], r["minimum_subjects_per_group"], r["numerator_subjects"], r["denominator_subjects"]) for r in status.collect()}
    assert got == {"C": ("tested", 3, 6, 6), "D": ("skipped_insufficient_subjects", 7, 6, 6), "E": ("tested", 3, 3, 6)}
    assert {r["contrast_id"] for r in effects.collect()} == {"C", "E"}
    one = pseudobulk.contrast_tests(counts, table, several.where("contrast_id = 'C'"), 3)[0].collect()
    assert [tuple(r) for r in one] == [tuple(r) for r in effects.where("contrast_id = 'C'").collect()]


def test_rows_of_a_design_never_meet_in_one_task(spark):
    from countloom.session import spread

    assert spread(spark.range(25_000).coalesce(1), 10_000).rdd.getNumPartitions() == 3
    rows = spark.range(8).select((F.col("id") % 2).cast("string").alias("analysis_id"), "id", F.create_map(F.lit("group"), (F.col("id") % 2).cast("string")).alias("values"), F.array(F.array(F.lit("group"))).alias("terms"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = designs.fit_designs(rows, ["analysis_id"], "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "BroadcastHashJoin" in plan  # rows and their design
