"""Readers and writers of files, over files made from the test tables (S1-S5, S8, K7, F8), report filter (P16), lookup gates (V6).

Each query writes its files under ``spark.checkpoint.dir`` and reads them back with the function that the entry
points call.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from ..operators.quality import check, lookup_key_violations
from ..session import ensure_checkpoint_dir
from ..sinks.report_workbooks import ReportWorkbooks
from ..sources.files import PROGRAM_COLUMNS, PROGRAM_WIDTH, read_birthdates, read_programs
from ..sources.lookups import towns
from ..sources.workbook_source import layout_option, register
from ..sources.workbooks import Section, is_workbook
from .billing import billing_report
from .billing_queries import _BASE_SQL, target_model
from .catalog import Tables, query


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("workbook_round_trip", """
SELECT 'nation-' || c_nationkey || '.xlsx' AS source, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS INTEGER) AS row_no,
       c_custkey, c_name, c_mktsegment, c_acctbal FROM customer WHERE c_nationkey <> 3""")
def workbook_round_trip(spark, sf):
    """A workbook per nation written by the data source writer and read by the data source."""
    t, out = Tables(spark, sf), _folder(spark, "books")
    spark.dataSource.register(ReportWorkbooks)
    register(spark)
    columns = ["c_custkey", "c_name", "c_mktsegment", "c_acctbal"]
    rows = t.customer.select(F.concat(F.lit("nation-"), "c_nationkey", F.lit(".xlsx")).alias("file"), F.lit(1).alias("sheet"), F.col("c_custkey").alias("row_no"),
                             F.array(*[F.col(c).cast("string") for c in columns]).alias("cells"))
    sheets = [["Summary", [["nothing", False]]], ["Customers", [["key", True], ["name", False], ["segment", False], ["balance", True]]]]
    rows.repartition("file").sortWithinPartitions("file", "row_no").write.format("report_workbooks").option("sheets", json.dumps(sheets)).mode("append").save(out)
    cells = spark.read.format("roster_workbooks").option("layout", layout_option([
        Section("customers", "rows", sheet="Customers", skip=1, width=4), Section("label", "cell", "A1")])).load(out)
    typed = cells.where("section = 'customers' and source <> 'nation-3.xlsx'")
    return typed.select("source", "row_no", F.col("cells")[0].cast("bigint").alias("c_custkey"), F.col("cells")[1].alias("c_name"),
                        F.col("cells")[2].alias("c_mktsegment"), F.col("cells")[3].cast("double").alias("c_acctbal"))


@query("program_list", """
SELECT 'site ' || s_suppkey AS name, n_name AS org_name, CASE WHEN s_suppkey % 4 >= 2 THEN 'L' || s_suppkey END AS license_no, 'F' || s_suppkey AS facility_code, s_phone AS zip
FROM (SELECT *, CAST(s_suppkey * 7 AS VARCHAR) AS s_phone FROM supplier) JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 6 <> 5""")
def program_list(spark, sf):
    """The program list as a CSV export of 83 columns, read by the shipped reader."""
    t, out = Tables(spark, sf), _folder(spark, "programs")
    key = F.col("s_suppkey")
    kept = {"contractor": F.concat(F.lit("Big, Inc, "), F.col("n_name"), F.when(key % 2 == 0, ",").otherwise("")),
            "name": F.when(key % 6 != 5, F.concat(F.lit("site "), key)), "zip": (key * 7).cast("string"),
            "license_no": F.when(key % 4 == 0, "Exempt").when(key % 4 == 1, "?").otherwise(F.concat(F.lit("L"), key)), "facility_code": F.concat(F.lit("F"), key)}
    at = dict(PROGRAM_COLUMNS)
    rows = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        *[kept.get(at.get(i), F.lit("x") if i not in at else F.lit(None).cast("string")).alias(f"h{i}") for i in range(PROGRAM_WIDTH)])
    rows.write.option("header", True).csv(out)
    return read_programs(spark, out).select("name", "org_name", "license_no", "facility_code", "zip")


@query("birth_dates", "SELECT DISTINCT 'S' || c_custkey % 400 AS sasid, DATE '2014-01-01' + CAST(c_custkey % 800 AS INTEGER) AS birthdate FROM customer")
def birth_dates(spark, sf):
    """Supplementary birth dates, months and days of one or two digits, distinct rows."""
    t, out = Tables(spark, sf), _folder(spark, "births")
    day = F.date_add(F.lit("2014-01-01").cast("date"), (F.col("c_custkey") % 800).cast("int"))
    t.customer.select(F.concat(F.lit("S"), F.col("c_custkey") % 400).alias("SASID"), F.date_format(day, "M/d/yyyy").alias("Birthdate")).write.option("header", True).csv(out)
    return read_birthdates(spark, out).select(F.col("SASID").alias("sasid"), F.col("Birthdate").alias("birthdate"))


_NAMES = "CASE WHEN p_partkey % 7 = 0 THEN '.keep' WHEN p_partkey % 3 = 0 THEN '~' || p_name ELSE p_name || '~.keep' END"


@query("workbook_names", f"SELECT p_partkey, {_NAMES} AS name FROM part WHERE {_NAMES} NOT LIKE '~%' AND {_NAMES} <> '.keep'")
def workbook_names(spark, sf):
    """Which files of a folder are workbooks, by the beginning of their names."""
    key = F.col("p_partkey")
    name = F.when(key % 7 == 0, ".keep").when(key % 3 == 0, F.concat(F.lit("~"), "p_name")).otherwise(F.concat("p_name", F.lit("~.keep")))
    rows = Tables(spark, sf).part.select("p_partkey", name.alias("name"), F.concat(F.lit("file:/folder/"), name).alias("path"))
    return rows.where(is_workbook()).select("p_partkey", "name")


@query("chosen_reports", _BASE_SQL + """
SELECT rep.report_id, name AS contractor, family_fees, CAST(coalesce(s.n, 0) AS BIGINT) AS n_subsidies
FROM rep LEFT JOIN (SELECT report_id, sum(n_subsidy) AS n FROM subs GROUP BY 1) s ON s.report_id = rep.report_id WHERE rep.organization_id IN (3, 11)""")
def chosen_reports(spark, sf):
    """The header of the reports that are asked for."""
    model = target_model(spark, sf)
    ids = model["report"].where(F.col("OrganizationId").isin(3, 11)).select("Id")
    return billing_report(model, ("header",), report_ids=ids)["header"].select("report_id", "contractor", "family_fees", "n_subsidies")


@query("lookup_gates", """
SELECT 'towns key unique' AS rule, 'stop' AS severity, CAST(0 AS BIGINT) AS n
UNION ALL SELECT 'segments key unique', 'stop', count(*) FROM (SELECT count(*) OVER (PARTITION BY c_nationkey, c_mktsegment) AS k FROM customer) WHERE k > 1
UNION ALL SELECT 'orders key unique', 'stop', count(*) FROM (SELECT count(*) OVER (PARTITION BY o_orderkey) AS k FROM orders) WHERE k > 1""")
def lookup_gates(spark, sf):
    """Lookup tables that are unique on their keys, and one that is not."""
    t = Tables(spark, sf)
    lookups = {"towns": (towns(spark), ["town"]), "segments": (t.customer, ["c_nationkey", "c_mktsegment"]), "orders": (t.orders, ["o_orderkey"])}
    return check(spark, lookup_key_violations(lookups)).select("rule", "severity", "n")
