"""Messy inputs for the jobs, derived from the given tables.

Each text is SQL that Spark and the checking engine both run. Tables are named in braces, which Spark binds to
DataFrames and the oracle strips.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

CONTRACT_RAW = """
SELECT CASE WHEN l_orderkey % 97 = 0 THEN 'Total' WHEN l_orderkey % 89 = 0 THEN NULL
            WHEN l_orderkey % 83 = 0 THEN '  ' ELSE concat(' School ', CAST(l_suppkey % 12 AS VARCHAR(8)), ' ') END AS school,
       CAST(l_partkey % 50 AS VARCHAR(8)) AS subject_no,
       CASE WHEN l_orderkey % 79 = 0 THEN 'RESULT' ELSE concat('Subject ', CAST(l_partkey % 50 AS VARCHAR(8))) END AS subject,
       CASE WHEN l_orderkey % 73 = 0 THEN 'Session TBA'
            ELSE concat(CASE WHEN month(l_shipdate) <= 6 THEN 'Autumn ' ELSE 'Spring ' END, CAST(year(l_shipdate) AS VARCHAR(4))) END AS teaching_session,
       CASE WHEN l_orderkey % 71 = 0 THEN NULL WHEN l_orderkey % 67 = 0 THEN 'n/a'
            WHEN l_orderkey % 5 = 0 THEN concat('$', CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR(24)))
            ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR(24)) END AS incl_oncosts,
       CASE WHEN l_orderkey % 1201 = 7 THEN '9e18' WHEN l_orderkey % 61 = 0 THEN NULL WHEN l_orderkey % 59 = 0 THEN '-3'
            WHEN l_suppkey % 12 = 11 THEN '0'
            ELSE concat(CAST(CAST(l_quantity AS INT) AS VARCHAR(8)), '.7') END AS student_count
FROM {lineitem}
"""

# the same rows as lines of an export, a file for each subject
CONTRACT_LINES = f"""
SELECT subject_no, concat(coalesce(school, ''), '|', subject_no, '|', coalesce(subject, ''), '|', teaching_session, '|',
       coalesce(incl_oncosts, ''), '|', coalesce(student_count, '')) AS line
FROM ({CONTRACT_RAW}) AS t
"""

# remarks with quotes, separators, line breaks and letters beyond ASCII
REMARKS = """
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'latin' ELSE 'utf8' END AS part,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN concat('José', chr(10), '"', o_orderpriority, '"', chr(10), chr(10), 'fin')
            WHEN o_orderkey % 3 = 0 THEN concat(o_orderpriority, ', ', o_orderstatus) ELSE o_orderpriority END AS remark,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR(24)) AS amount
FROM {orders}
"""

TRANSACTIONS_RAW = """
SELECT o_orderkey AS src_row,
       CASE WHEN o_orderkey % 41 = 0 THEN 'Unallocated'
            WHEN o_orderkey % 37 = 0 THEN CAST(o_custkey AS VARCHAR(12))
            ELSE concat(lpad(CAST(o_custkey AS VARCHAR(12)), 7, '0'), ' - Fund ', CAST(o_custkey % 30 AS VARCHAR(8))) END AS activity,
       CASE WHEN o_orderkey % 31 = 0 THEN '1,234.50' WHEN o_orderstatus = 'F' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR(24)) ELSE '0' END AS debit,
       CASE WHEN o_orderstatus = 'F' THEN '0' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR(24)) END AS credit,
       CASE WHEN o_orderkey % 29 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR(24))
            ELSE concat('-', CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR(24))) END AS net_amount,
       year(o_orderdate) AS year, CAST(month(o_orderdate) AS VARCHAR(2)) AS month, o_orderpriority AS journal_line_desc
FROM {orders}
"""

# years as an untyped export has them
TRANSACTIONS_TEXT = f"""
SELECT src_row, activity, debit, credit, net_amount,
       CASE WHEN src_row % 23 = 0 THEN 'FY' WHEN src_row % 19 = 0 THEN concat(CAST(year AS VARCHAR(4)), '.0')
            WHEN src_row % 17 = 0 THEN concat(CAST(year AS VARCHAR(4)), '.5')
            ELSE CAST(year AS VARCHAR(4)) END AS year,
       month, journal_line_desc
FROM ({TRANSACTIONS_RAW}) AS t
"""

REFERENCE_RAW = """
SELECT CAST(c_custkey AS VARCHAR(12)) AS tr_code, CAST(9000 + CAST(floor(c_custkey / 2) AS INT) AS VARCHAR(12)) AS staff_id,
       concat('Given', CAST(c_custkey % 40 AS VARCHAR(8))) AS first_name,
       CASE WHEN c_custkey % 101 = 0 THEN NULL ELSE concat('Family', CAST(CAST(floor(c_custkey / 2) AS INT) AS VARCHAR(12))) END AS family_name,
       concat('given', CAST(c_custkey % 40 AS VARCHAR(8)), '.family-', CAST(c_custkey AS VARCHAR(12)), '@example.org') AS email
FROM {customer} WHERE c_custkey % 10 <> 9
"""

# codes that are missing, blank, or equal to another one after padding
REFERENCE_FAULTY = f"""
SELECT CASE WHEN c_custkey % 211 = 0 THEN NULL WHEN c_custkey % 223 = 0 THEN ' ' WHEN c_custkey % 227 = 0 THEN 'NaN'
            ELSE CAST(c_custkey AS VARCHAR(12)) END AS tr_code, c_name AS first_name
FROM {{customer}}
UNION ALL
SELECT lpad(CAST(c_custkey AS VARCHAR(12)), 7, '0') AS tr_code, c_name AS first_name FROM {{customer}} WHERE c_custkey % 50 = 1
"""

# every word of the items, with the punctuation that it has; without it; and every two words next to each other, taken in turn
PEOPLE_RAW = "SELECT item_id, explode(regexp_extract_all(text, '([^ ]+)', 1)) AS first_name FROM {benchmark}"
PEOPLE_WORDS = "SELECT item_id, explode(regexp_extract_all(text, '([A-Za-z]+)', 1)) AS first_name FROM {benchmark}"
PEOPLE_PHRASES = "SELECT item_id, explode(regexp_extract_all(text, '([A-Za-z]+ [A-Za-z]+)', 1)) AS first_name FROM {benchmark}"

# files sorted by falling amount, with unreadable cells, bad codes and a few rows out of order
SPENDER_FILES = """
SELECT concat('spenders_', CAST(o_custkey % 5 AS VARCHAR(4))) AS file_key, o_orderkey + 2 AS row_num,
       CASE WHEN o_orderkey < 30 THEN concat(CAST(90 - o_orderkey AS VARCHAR(4)), 'e30') WHEN o_orderkey % 1009 = 1008 THEN '99,999,999.50' WHEN o_orderkey % 43 = 0 THEN 'n/a' WHEN o_orderkey % 47 = 0 THEN NULL
            ELSE CAST(CAST(10000000 - o_orderkey * 0.25 AS DECIMAL(18,2)) AS VARCHAR(24)) END AS total_net_spend,
       CASE WHEN o_orderkey % 53 = 0 THEN '12' ELSE lpad(CAST(o_custkey AS VARCHAR(12)), 7, '0') END AS tr_code
FROM {orders}
"""

# files sorted by falling year and month text, with the like
TREND_FILES = """
SELECT concat('trends_', CAST(o_custkey % 3 AS VARCHAR(4))) AS file_key, o_orderkey + 2 AS row_num,
       CASE WHEN o_orderkey % 907 = 906 THEN '9999' WHEN o_orderkey % 103 = 0 THEN '2020.5' WHEN o_orderkey % 113 = 0 THEN '2020.00000000001' WHEN o_orderkey % 107 = 0 THEN NULL
            WHEN o_orderkey % 109 = 0 THEN 'abc'
            ELSE CAST(9000 - CAST(floor(o_orderkey / 400) AS INT) AS VARCHAR(8)) END AS year,
       CASE WHEN o_orderkey % 101 = 0 THEN ' '
            ELSE split_part('9,8,7,6,5,4,3,2,12,11,10,1', ',', 1 + CAST(floor((o_orderkey % 400) / 34) AS INT)) END AS month
FROM {orders}
"""

# statements with totals that are right, off by one or two cents, absent or doubled, and amounts of 30 digits
STATEMENT_FILES = """
SELECT concat('statement_', CAST(o_custkey AS VARCHAR(12))) AS file_key, o_orderkey + 2 AS row_num, o_orderpriority AS description,
       CASE WHEN o_orderkey % 211 = 0 THEN 'x' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR(24)) END AS debit,
       CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE '1.25' END AS credit,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR(24)) AS net_amount
FROM {orders}
UNION ALL
SELECT concat('statement_', CAST(o_custkey AS VARCHAR(12))) AS file_key, max(o_orderkey) + 10 AS row_num, 'TOTAL' AS description,
       CAST(sum(CASE WHEN o_orderkey % 211 = 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(o_totalprice AS DECIMAL(18,2)) END) AS VARCHAR(40)) AS debit,
       CAST(sum(CASE WHEN o_orderkey % 29 = 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(1.25 AS DECIMAL(18,2)) END) AS VARCHAR(40)) AS credit,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) + CAST(CASE WHEN o_custkey % 11 = 0 THEN 0.02 WHEN o_custkey % 13 = 0 THEN 0.01 ELSE 0 END AS DECIMAL(18,2)) AS VARCHAR(40)) AS net_amount
FROM {orders} WHERE o_custkey % 17 <> 0 GROUP BY o_custkey
UNION ALL
SELECT concat('statement_', CAST(o_custkey AS VARCHAR(12))) AS file_key, max(o_orderkey) + 11 AS row_num, ' TOTAL' AS description,
       '7' AS debit, NULL AS credit, 'y' AS net_amount
FROM {orders} WHERE o_custkey % 19 = 0 GROUP BY o_custkey
UNION ALL
SELECT concat('statement_', CAST(o_custkey AS VARCHAR(12))) AS file_key, max(o_orderkey) + 12 AS row_num, 'Transfer in' AS description,
       '900000000000000000000000000000.25' AS debit, NULL AS credit, '0' AS net_amount
FROM {orders} WHERE o_custkey % 23 = 0 GROUP BY o_custkey
UNION ALL
SELECT concat('statement_', CAST(o_custkey AS VARCHAR(12))) AS file_key, max(o_orderkey) + 13 AS row_num, 'Transfer out' AS description,
       CASE WHEN o_custkey % 46 = 0 THEN '-900000000000000000000000000000.20' ELSE '-900000000000000000000000000000.25' END AS debit,
       NULL AS credit, '0' AS net_amount
FROM {orders} WHERE o_custkey % 23 = 0 GROUP BY o_custkey
"""

# the tables that each package holds
PACKAGES = """
SELECT concat('package_', CAST(o_custkey % 100 AS VARCHAR(8))) AS file_key,
       CASE WHEN o_orderkey % 900 = 0 THEN 'Transaction_Ledger' WHEN o_orderkey % 90 = 1 THEN 'All_Spenders'
            WHEN o_orderkey % 300 = 2 THEN 'Monthly_Trends' WHEN o_orderkey % 500 = 3 THEN 'Spending_by_Account'
            ELSE 'Notes' END AS name
FROM {orders}
"""

# three sheets: notes without a full header, the table with its header in row 5, and a later table
RAW_SHEET = """
SELECT 1 AS sheet_ord, 'Notes' AS sheet, o_orderkey + 1 AS row_idx,
       CASE WHEN o_orderkey = 2 THEN 'School' ELSE o_orderpriority END AS _c0, CASE WHEN o_orderkey = 2 THEN 'Subject' END AS _c1,
       CAST(NULL AS VARCHAR(8)) AS _c2, CAST(NULL AS VARCHAR(8)) AS _c3, CAST(NULL AS VARCHAR(8)) AS _c4,
       CAST(NULL AS VARCHAR(8)) AS _c5, CAST(NULL AS VARCHAR(8)) AS _c6, CAST(NULL AS VARCHAR(8)) AS _c7
FROM {orders}
UNION ALL
SELECT 2 AS sheet_ord, 'Data' AS sheet, o_orderkey + 1 AS row_idx,
       CASE WHEN o_orderkey = 4 THEN ' Subject  NUMBER' WHEN o_orderkey > 4 THEN CAST(o_custkey % 50 AS VARCHAR(12)) END AS _c0,
       CASE WHEN o_orderkey = 4 THEN 'School' WHEN o_orderkey > 4 THEN 'old' END AS _c1,
       CASE WHEN o_orderkey = 4 THEN 'Subject' WHEN o_orderkey > 4 THEN concat('Subject ', CAST(o_custkey % 50 AS VARCHAR(12))) END AS _c2,
       CASE WHEN o_orderkey = 4 THEN 'teaching session ' WHEN o_orderkey > 4 THEN concat('Autumn ', CAST(year(o_orderdate) AS VARCHAR(4))) END AS _c3,
       CASE WHEN o_orderkey = 4 THEN 'Incl. Oncosts' WHEN o_orderkey > 4 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR(24)) END AS _c4,
       CASE WHEN o_orderkey = 4 THEN 'Remarks' WHEN o_orderkey > 4 THEN o_orderpriority ELSE 'Export' END AS _c5,
       CASE WHEN o_orderkey = 4 THEN 'STUDENT COUNT' WHEN o_orderkey > 4 THEN CAST(o_orderkey % 40 AS VARCHAR(8)) END AS _c6,
       CASE WHEN o_orderkey = 4 THEN 'School' WHEN o_orderkey > 4 THEN concat('School ', CAST(o_custkey % 12 AS VARCHAR(8))) END AS _c7
FROM {orders}
UNION ALL
SELECT 3 AS sheet_ord, 'Later' AS sheet, o_orderkey + 1 AS row_idx,
       CASE WHEN o_orderkey = 1 THEN 'School' ELSE 'x' END AS _c0, CASE WHEN o_orderkey = 1 THEN 'Subject No' ELSE 'x' END AS _c1,
       CASE WHEN o_orderkey = 1 THEN 'Subject' ELSE 'x' END AS _c2, CASE WHEN o_orderkey = 1 THEN 'Teaching Session' ELSE 'x' END AS _c3,
       CASE WHEN o_orderkey = 1 THEN 'Incl Oncosts' ELSE 'x' END AS _c4, CASE WHEN o_orderkey = 1 THEN 'Student Count' ELSE 'x' END AS _c5,
       CAST(NULL AS VARCHAR(8)) AS _c6, CAST(NULL AS VARCHAR(8)) AS _c7
FROM {orders}
"""


def tables_in(sql: str) -> set[str]:
    return set(re.findall(r"\{(\w+)\}", sql))


def view(spark: SparkSession, folder: str, sql: str) -> DataFrame:
    """The view over the parquet tables of a folder."""
    tables = {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in tables_in(sql)}
    return spark.sql(sql, **tables)


def plain(sql: str) -> str:
    """The same text over tables by name."""
    return re.sub(r"\{(\w+)\}", r"\1", sql).replace("explode(", "unnest(").strip()
