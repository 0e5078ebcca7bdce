"""Registered queries: tables written out by Spark and read back by each source."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from countloom.functions.missing import is_integral
from countloom.operators.rules.authority import header_rules
from countloom.plans.registry import Registry, rounded
from countloom.plans.reviewed import TEXT, reviewed
from countloom.plans.views import Views, sql
from countloom.schemas import TABLES
from countloom.session import scratch
from countloom.sources import files as X
from countloom.sources import matrices as M
from countloom.sources import tables as T

queries = Registry()
COLUMNS = TABLES["sample_manifest"].columns
EVENT_TYPES = ("view", "signup", "click", "error", "purchase")


def headed(df, *lines: str):
    """Text rows with the same first lines in every file that is written."""
    def run(batches):
        yield pd.DataFrame({"text": list(lines)})
        for batch in batches:
            yield batch

    return df.mapInPandas(run, "text string")


def authority(v: Views):
    path = scratch(v.spark, "manifest")
    rows = reviewed(v, "manifest").select(F.concat_ws("\t", *COLUMNS).alias("text"))
    headed(rows.repartition(4), "\t".join(COLUMNS)).write.text(path)
    return path


queries.add("read_authority", lambda v: T.read_authority(v.spark, authority(v), "sample_manifest").groupBy("dataset_id", "include", "review_status").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("notes")).alias("notes")),
            sql("", "SELECT dataset_id, include, review_status, count(*) AS n, sum(length(notes))::bigint AS notes FROM manifest GROUP BY ALL", manifest=TEXT["manifest"]))
# Read as its own table the header fits; read as another one only the header is reported.
queries.add(
    "authority_header_rules",
    lambda v: header_rules(T.numbered_lines(v.spark, authority(v)).select("line", "text"), "contrasts").unionByName(header_rules(T.numbered_lines(v.spark, authority(v)).select("line", F.when(F.col("text").contains("pending"), F.concat("text", F.lit("\tx"))).otherwise(F.col("text")).alias("text")), "sample_manifest")).groupBy("check_id").agg(F.count(F.lit(1)).alias("n")),
    sql("", "SELECT 'HEADER_MISMATCH' AS check_id, 4::bigint AS n UNION ALL SELECT 'COLUMN_COUNT_MISMATCH', count(*) FROM manifest WHERE review_status = 'pending'", manifest=TEXT["manifest"]),
)


def table_round_trip(v: Views):
    path = scratch(v.spark, "table")
    T.write_table(v.t("customer").withColumn("extra", F.lit(1)), ["c_custkey", "c_name", "c_mktsegment"], path, "NA")
    return T.read_table(v.spark, path, ["c_custkey", "c_name", "c_mktsegment"])


queries.add("table_round_trip", table_round_trip, "SELECT c_custkey::varchar AS c_custkey, c_name, c_mktsegment FROM customer")


def json_round_trip(v: Views):
    path = scratch(v.spark, "json")
    T.write_json(v.t("supplier").select("s_suppkey", "s_name"), path)
    return v.spark.read.schema("s_name string, s_suppkey bigint").json(path)


queries.add("json_round_trip", json_round_trip, "SELECT s_suppkey, s_name FROM supplier")


def wide_matrix(v: Views):
    path = scratch(v.spark, "matrix")
    counts = v.counts("nation").groupBy("gene_id", F.col("dataset_id").alias("sample_id")).agg(F.sum("count").alias("count"))
    M.write_wide(counts, ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"], path)
    return path


queries.add("wide_matrix_to_long", lambda v: M.read_count_matrix(v.spark, wide_matrix(v)).where("value_text <> '0'").select("gene_id", "sample_id", F.col("value_text").cast("bigint").alias("count")),
            sql("counts_nation", "SELECT gene_id, dataset_id AS sample_id, sum(count)::bigint AS count FROM counts_nation GROUP BY ALL"))


def ragged_matrix(v: Views):
    """Genes of the region counts; each fifth key lacks its last field, the names hold a dot and a repeat."""
    path = scratch(v.spark, "ragged")
    rows = v.t("part").select(F.concat_ws("\t", F.concat(F.lit("G"), "p_partkey"), "p_size", F.when(F.col("p_partkey") % 5 != 0, F.col("p_retailprice").cast("bigint"))).alias("text"))
    headed(rows.repartition(4), "gene_id\tS.1\tS.1").write.text(path)
    return path


queries.add(
    "ragged_matrix_profile",
    lambda v: M.inspect_matrix(v.spark, ragged_matrix(v)).select("row_count", "malformed_rows", "entries", "genes", "sample_columns", F.col("total").cast("bigint").alias("total"), "count_type"),
    """SELECT count(*) AS row_count, count(*) FILTER (WHERE p_partkey % 5 = 0) AS malformed_rows, 2 * count(*) FILTER (WHERE p_partkey % 5 <> 0) AS entries, count(*) FILTER (WHERE p_partkey % 5 <> 0) AS genes, 1::bigint AS sample_columns,
        (sum(p_size + trunc(p_retailprice)) FILTER (WHERE p_partkey % 5 <> 0))::bigint AS total, 'raw_integer_counts' AS count_type FROM part""",
)
queries.add(
    "ragged_matrix_problems",
    lambda v: M.matrix_problems(v.spark, ragged_matrix(v)),
    """SELECT 'malformed_row' AS problem, 'G' || p_partkey AS gene_id, 'G' || p_partkey || chr(9) || p_size AS text FROM part WHERE p_partkey % 5 = 0 UNION ALL SELECT 'repeated_column', NULL, 'S.1'""",
)


def triplets(v: Views):
    folder = scratch(v.spark, "mtx")
    entries = v.t("lineitem").select(F.concat_ws(" ", F.col("l_partkey") + 1, F.col("l_suppkey") + 1, F.col("l_quantity").cast("bigint")).alias("text"))
    headed(entries, "%%MatrixMarket", "% note", "9 9 9").write.text(f"{folder}/m")
    # A name's place is its line; range-sorted parts of a list follow each other by file name.
    v.t("part").orderBy("p_partkey").select(F.concat(F.lit("G"), "p_partkey").alias("t")).write.text(f"{folder}/f")
    v.t("supplier").orderBy("s_suppkey").select(F.concat(F.lit("S"), "s_suppkey").alias("t")).write.text(f"{folder}/b")
    return M.read_mtx(v.spark, f"{folder}/m", f"{folder}/f", f"{folder}/b")


def faulty_triplets(v: Views):
    """Every line item, against name lists that are too short for both positions; 13 pieces are no number, flag A has four fields."""
    folder = scratch(v.spark, "mtx")
    pieces = F.when(F.col("l_quantity") == 13, F.lit("x")).otherwise(F.col("l_quantity").cast("bigint").cast("string"))
    more = F.when(F.col("l_returnflag") == "A", F.lit("1"))
    entries = v.t("lineitem").select(F.concat_ws(" ", F.col("l_partkey") + 1, F.col("l_suppkey") + 1, pieces, more).alias("text"))
    headed(entries.repartition(4), "%%MatrixMarket", "9 9 9").write.text(f"{folder}/m")
    v.t("supplier").orderBy("s_suppkey").select(F.concat(F.lit("G"), "s_suppkey").alias("t")).write.text(f"{folder}/f")
    v.t("nation").orderBy("n_nationkey").select(F.concat(F.lit("S"), "n_nationkey").alias("t")).write.text(f"{folder}/b")
    return M.mtx_problems(v.spark, f"{folder}/m", f"{folder}/f", f"{folder}/b").groupBy("problem").agg(F.count(F.lit(1)).alias("n"))


queries.add("matrix_market_problems", faulty_triplets,
            """SELECT problem, n FROM (SELECT 'not_three_fields' AS problem, count(*) AS n FROM lineitem WHERE l_returnflag = 'A' UNION ALL SELECT 'not_a_number', count(*) FROM lineitem WHERE l_quantity = 13
            UNION ALL SELECT 'row_without_name', count(*) FROM lineitem WHERE l_partkey + 1 > (SELECT count(*) FROM supplier) UNION ALL SELECT 'column_without_name', count(*) FROM lineitem WHERE l_suppkey + 1 > 25 UNION ALL SELECT 'entry_count_mismatch', 4) WHERE n > 0""")
queries.add("matrix_market_scan", lambda v: triplets(v).groupBy("barcode").agg(F.count(F.lit(1)).alias("entries"), F.sum("count").alias("total"), F.count_distinct("gene_id").alias("genes")),
            "SELECT 'S' || l_suppkey AS barcode, count(*) AS entries, sum(l_quantity) AS total, count(DISTINCT l_partkey) AS genes FROM lineitem GROUP BY 1")


def gene_sets(v: Views):
    path = scratch(v.spark, "gmt")
    # A set goes over as many lines as it needs for about a hundred genes on each.
    genes = v.genes()
    sizes = genes.groupBy("marker_set").agg(F.ceil(F.count(F.lit(1)) / 100).alias("_lines"))
    chunk = F.pmod(F.xxhash64("gene_id"), F.col("_lines"))
    lines = genes.join(sizes, "marker_set").groupBy("marker_set", chunk.alias("_chunk")).agg(F.concat_ws("\t", F.collect_list("gene_id")).alias("g"))
    lines.select(F.concat_ws("\t", "marker_set", F.lit("about"), "g").alias("t")).write.text(path)
    return M.read_gmt(v.spark, path).select("set_name", "gene_id")


queries.add("gene_set_scan", gene_sets, "SELECT p_brand AS set_name, 'G' || p_partkey AS gene_id FROM part")


def quant(v: Views):
    folder = scratch(v.spark, "quant")
    rows = v.lines().select("n_name", F.concat_ws("_", F.lit("T"), "l_partkey", "l_suppkey").alias("Name"), F.lit(100.0).alias("Length"), (F.col("l_suppkey") % 7 + 50.0).alias("EffectiveLength"), (F.col("l_quantity") / 2).alias("TPM"), (F.col("l_quantity") + 0.5).alias("NumReads"))
    rows.repartition("n_name").write.partitionBy("n_name").option("header", True).option("sep", "\t").csv(folder)
    tx = v.t("lineitem").select(F.concat_ws("_", F.lit("T"), "l_partkey", "l_suppkey").alias("transcript_id"), F.concat(F.lit("G"), "l_partkey").alias("gene_id")).distinct()
    return M.tx_to_gene(M.read_quant(v.spark, f"{folder}/*/*"), tx)


queries.add("transcript_to_gene", lambda v: rounded(quant(v), "count_estimate", "abundance", "length").withColumn("sample_id", F.regexp_replace("sample_id", "^n_name=", "")),
            sql("lines", "SELECT n_name AS sample_id, 'G' || l_partkey AS gene_id, round_even(sum(l_quantity + 0.5), 0)::bigint AS count, round(sum(l_quantity + 0.5), 6) AS count_estimate, round(sum(l_quantity / 2), 6) AS abundance, round(sum(l_quantity / 2 * (l_suppkey % 7 + 50)) / sum(l_quantity / 2), 6) AS length FROM lines GROUP BY ALL"))


def feature_counts(v: Views):
    path = scratch(v.spark, "features")
    rows = v.t("part").select(F.concat_ws("\t", F.concat(F.lit("G"), "p_partkey"), F.lit("c"), F.lit("1"), F.lit("2"), F.lit("+"), F.lit("9"), F.when(F.col("p_size") % 10 == 0, F.lit("x")).otherwise(F.col("p_size").cast("string"))).alias("t"))
    headed(rows.withColumnRenamed("t", "text").repartition(3), "# made by", "Geneid\tChr\tStart\tEnd\tStrand\tLength\ts").write.text(path)
    return M.normalize_feature_counts(v.spark, path)


queries.add("feature_count_scan", feature_counts, "SELECT 'G' || p_partkey AS gene_id, CASE WHEN p_size % 10 <> 0 THEN p_size::bigint END AS count, CASE WHEN p_size % 10 = 0 THEN 'not_a_count' END AS problem FROM part")


def reads(v: Views):
    folder = scratch(v.spark, "reads")
    record = v.t("events").select(F.concat_ws("\n", F.concat(F.when(F.col("user_id") % 9 == 0, F.lit("x")).otherwise(F.lit("@")), "event_id"), F.lit("ACGT"), F.lit("+"), F.lit("IIII")).alias("t"), (F.col("user_id") % 10).alias("lane"))
    record.repartitionByRange("lane", "t").sortWithinPartitions("lane").write.partitionBy("lane").text(folder)
    return X.fastq_integrity(v.spark, f"{folder}/*/*"), X.inventory_files(v.spark, folder, False)


# A lane may be several files; it passes if all of them do.
queries.add("fastq_integrity", lambda v: reads(v)[0].groupBy(F.regexp_extract("file", "lane=([0-9]+)", 1).alias("lane")).agg(F.sum("lines").alias("lines"), F.sum("records").alias("records"), F.min("integrity").alias("integrity")),
            "SELECT (user_id % 10)::varchar AS lane, count(*) * 4 AS lines, count(*) AS records, CASE WHEN bool_or(user_id % 9 = 0) THEN 'fail' ELSE 'pass' END AS integrity FROM events GROUP BY 1")
queries.add("file_inventory", lambda v: reads(v)[1].where(~F.col("path").contains("_SUCCESS")).select(F.regexp_extract("path", "lane=([0-9]+)", 1).alias("lane"), "module", (F.length("sha256") == 64).alias("hashed")).distinct(),
            "SELECT DISTINCT (user_id % 10)::varchar AS lane, 'other' AS module, true AS hashed FROM events")
queries.add("quant_log_metrics",
            lambda v: rounded(M.quant_metrics(v.t("orders").select(F.concat(F.lit("S"), "o_orderkey").alias("sample_id"), F.when(F.col("o_orderkey") % 2 == 0, F.lit("json")).otherwise(F.lit("pipe")).alias("kind"), F.when(F.col("o_orderkey") % 2 == 0, F.to_json(F.struct((F.col("o_custkey") + 10).alias("num_processed"), F.col("o_custkey").alias("num_mapped")))).otherwise(F.concat(F.lit("Number of input reads |\t"), "o_custkey", F.lit("\nUniquely mapped reads % |\t80.5%\n% of reads mapped to multiple loci |\t3.25%"))).alias("text")),
                                              v.t("orders").select(F.concat(F.lit("S"), F.col("o_orderkey") + 1).alias("sample_id"))), "mapping_rate"),
            """SELECT 'S' || (o_orderkey + 1) AS sample_id, CASE WHEN x IS NULL THEN NULL WHEN (o_orderkey + 1) % 2 = 0 THEN (x + 10)::double ELSE x::double END AS read_count, CASE WHEN x IS NULL THEN NULL WHEN (o_orderkey + 1) % 2 = 0 THEN round(100.0::double * x / (x + 10), 6) ELSE 83.75 END AS mapping_rate,
            CASE WHEN x IS NULL THEN 'not_available' WHEN (o_orderkey + 1) % 2 = 0 THEN 'json_log' ELSE 'pipe_log' END AS metric_source FROM orders LEFT JOIN (SELECT o_orderkey AS k, o_custkey AS x FROM orders) ON k = o_orderkey + 1""")
queries.add("merged_events", lambda v: T.merge_events([v.t("events").where(F.col("event_type") == t).select(F.col("ts").cast("string").alias("timestamp_utc"), "event_id") for t in EVENT_TYPES]).select("event_id"), "SELECT event_id FROM events")
queries.add("integer_tolerance", lambda v: v.t("orders").select("o_orderkey", is_integral("o_totalprice").alias("whole")), "SELECT o_orderkey, abs(o_totalprice - round_even(o_totalprice, 0)) <= 1e-8::double + 1e-5::double * abs(round_even(o_totalprice, 0)) AS whole FROM orders")


def cell_table(v: Views):
    path = scratch(v.spark, "cells")
    joined = v.cell_counts().join(v.cells().withColumnRenamed("author_label", "cell_type"), "cell_id")
    T.write_table(joined, ["cell_id", "dataset_id", "sample_id", "subject_id", "group", "cell_type", "gene_id", "count"], path)
    return M.read_cell_counts(v.spark, path)


queries.add("long_cell_table", lambda v: cell_table(v).groupBy("cell_type", "group").agg(F.count(F.lit(1)).alias("n"), F.sum("count").alias("total")),
            sql("cells cell_counts", "SELECT author_label AS cell_type, \"group\", count(*) AS n, sum(count)::bigint AS total FROM cells JOIN cell_counts USING (cell_id) GROUP BY ALL"))


def faulty_cells(v: Views):
    """Order lines as cells: counts of every kind, rows without subject or group, cells of two identities."""
    path = scratch(v.spark, "faulty")
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    count = F.when(k % 7 == 0, F.lit("1.5")).when(k % 11 == 0, F.lit("-3")).when(k % 13 == 0, F.lit("x")).otherwise(F.col("l_quantity").cast("bigint").cast("string"))
    rows = v.t("lineitem").select(
        k.alias("cell_id"), F.lit("D").alias("dataset_id"), F.lit("S").alias("sample_id"), F.when(k % 17 == 0, F.lit("NA")).otherwise(F.lit("P")).alias("subject_id"),
        F.when(k % 19 == 0, F.lit("")).otherwise(F.lit("case")).alias("group"), F.when((k % 23 == 0) & (n == 1), F.lit("T")).otherwise(F.lit("B")).alias("cell_type"), F.concat(F.lit("G"), n).alias("gene_id"), count.alias("count"))
    T.write_table(rows, list(M.CELL_COLUMNS), path)
    return path


queries.add(
    "cell_table_problems",
    lambda v: M.cell_problems(v.spark, faulty_cells(v)).select("problem", F.col("cell_id").cast("bigint").alias("cell_id"), F.split_part("detail", F.lit(" "), F.lit(1)).alias("place")),
    """SELECT problem, l_orderkey AS cell_id, 'G' || l_linenumber AS place FROM (SELECT *, unnest(list_filter([CASE WHEN l_orderkey % 17 = 0 THEN 'missing_subject' END, CASE WHEN l_orderkey % 19 = 0 THEN 'missing_group' END,
            CASE WHEN l_orderkey % 7 = 0 THEN 'fractional_count' WHEN l_orderkey % 11 = 0 THEN 'negative_count' WHEN l_orderkey % 13 = 0 THEN 'not_a_number' END], lambda p: p IS NOT NULL)) AS problem FROM lineitem)
        UNION ALL SELECT 'several_identities', l_orderkey, '2' FROM lineitem WHERE l_orderkey % 23 = 0 GROUP BY l_orderkey HAVING count(*) FILTER (WHERE l_linenumber = 1) > 0 AND count(*) FILTER (WHERE l_linenumber <> 1) > 0""",
)
