"""Synthetic judgments from the TPC-H-like tables, by SQL that Spark and DuckDB both run.

The driver's tables hold no Chinese text. These views give cases with null, blank, repeated and ambiguous case numbers, amounts in
all notations, citations and fees, from integer columns alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: One judgment an order: k, case_no, z4 (reasoning), z3 (facts), full (the judgment), raw amounts.
CASES = """
SELECT k, case_no, raw, z3, z4, law, path,
       concat('（2023）民初', cast(k AS STRING), '号原告客户', cast(c AS STRING), '与被告公司', cast(c % 97 AS STRING), '民间借贷纠纷一案。经审理查明：', z3, '本院认为，', z4,
              '判决如下：被告于十日内付清。案件受理费', cast(k % 900 + 50 AS STRING), '元，由被告负担。审判员某某') AS full_text
FROM (
  SELECT *, concat('被告向原告借款', raw, '，约定月息二分；至今未还。') AS z3,
         concat(CASE k % 5 WHEN 0 THEN '被告应当偿还借款本金' WHEN 1 THEN '准予撤诉，受理费' WHEN 2 THEN '双方确认' WHEN 3 THEN '被告支付利息' ELSE '依照' END,
                CASE WHEN k % 5 = 4 THEN law ELSE raw END, '。') AS z4
  FROM (
    SELECT o_orderkey AS k, o_custkey AS c,
      CASE WHEN o_orderkey % 31 = 0 THEN NULL WHEN o_orderkey % 37 = 0 THEN '  '
           ELSE concat(' （2023）民初', cast(o_orderkey - CASE WHEN o_orderkey % 11 = 5 THEN 1 ELSE 0 END AS STRING), '号') END AS case_no,
      CASE o_orderkey % 9
        WHEN 0 THEN concat(cast(o_custkey % 90 + 1 AS STRING), '万元') WHEN 1 THEN '叁万元' WHEN 2 THEN concat(cast(o_custkey % 900 + 100 AS STRING), '.50元')
        WHEN 3 THEN '二十万元' WHEN 4 THEN concat('人民币', cast(o_custkey % 9 + 1 AS STRING), ',', cast(o_custkey % 900 + 100 AS STRING), '元') WHEN 5 THEN concat('0.', cast(o_custkey % 9 + 1 AS STRING), '亿')
        WHEN 6 THEN concat('约', cast(o_custkey % 9000 + 1000 AS STRING), '.20') WHEN 7 THEN '一百二十三万元' ELSE '若干' END AS raw,
      CASE o_orderkey % 4
        WHEN 0 THEN concat('《合同法》第六十条、第', cast(o_custkey % 300 + 1 AS STRING), '条，《民诉法》第64条') WHEN 1 THEN '《合同法》第六十条、第二百零六条、第六十条；《合同法》第九条'
        WHEN 2 THEN '〈担保法〉第十八条、第二十一条' ELSE '有关规定' END AS law,
      concat('input_data/', cast(2010 + o_orderkey % 7 AS STRING), '/', CASE o_orderkey % 4 WHEN 0 THEN 'result_' WHEN 1 THEN '' WHEN 2 THEN 'x' ELSE 'part-' END,
             cast(2010 + o_orderkey % 7 AS STRING), '-', CASE WHEN o_orderkey % 12 < 9 THEN '0' ELSE '' END, cast(o_orderkey % 12 + 1 AS STRING), CASE o_orderkey % 3 WHEN 0 THEN '.csv' WHEN 1 THEN '.json' ELSE '.csv.jsonl' END) AS path
    FROM orders
  ) a
) b
"""
#: Amount labels of cases: some invalid, filtered, of unknown type, or of cases without text.
LABELS = """
SELECT 'labels.json' AS _file, k AS _pos, CASE WHEN k % 41 = 7 THEN concat('无', cast(k AS STRING)) ELSE case_no END AS case_no,
  CASE k % 6 WHEN 0 THEN '20000' WHEN 1 THEN ' 350.5 ' WHEN 2 THEN '' WHEN 3 THEN '12a' WHEN 4 THEN '9000000' ELSE '70' END AS target_amount,
  CASE k % 7 WHEN 0 THEN 'unknown' WHEN 1 THEN 'payment' WHEN 2 THEN '涉案金额' ELSE '交付金额' END AS amount_type,
  CASE k % 10 WHEN 0 THEN 'none' WHEN 1 THEN 'Z3' ELSE 'Z4' END AS source_zone,
  CASE WHEN k % 8 = 3 THEN 'failed' WHEN k % 16 = 5 THEN 'skipped' ELSE 'success' END AS status
FROM cases
"""
#: Texts of cases: every thirteenth comes twice, and some are long.
TEXTS = """
SELECT 'texts.json' AS _file, k AS _pos, case_no, CASE WHEN k % 101 = 3 THEN repeat(z4, 700) ELSE z4 END AS z4, z3 FROM cases
UNION ALL
SELECT 'texts2.json' AS _file, k AS _pos, case_no, z4, z3 FROM cases WHERE k % 13 = 0
"""
#: Citations a case: k, i, law_name, article, source_span.
CITED = """
SELECT k, 1 AS i, CASE k % 6 WHEN 0 THEN '同法' WHEN 1 THEN '合同法' WHEN 2 THEN '' WHEN 3 THEN ' 担保法' WHEN 4 THEN '最高人民法院关于合同法' ELSE '本规定' END AS law_name,
  CASE k % 3 WHEN 0 THEN '第六十条' WHEN 1 THEN '第十八条 ' ELSE '' END AS article, CASE k % 5 WHEN 0 THEN '第六十条' WHEN 1 THEN '不在文中' ELSE '' END AS source_span FROM cases
UNION ALL
SELECT k, 2 AS i, CASE k % 4 WHEN 0 THEN '合同法' WHEN 1 THEN '该法' WHEN 2 THEN '民诉法' ELSE '担保法' END AS law_name, '第六十条' AS article, '' AS source_span FROM cases WHERE k % 7 <> 0
UNION ALL
SELECT k, 3 AS i, CASE k % 5 WHEN 0 THEN '本法' WHEN 1 THEN '合同法' ELSE '' END AS law_name, '第64条' AS article, '' AS source_span FROM cases WHERE k % 3 = 0
"""
#: Party roles and fee passages by file and case, with repeated cases and failures.
ROLES = """
SELECT concat('result_', cast(k % 12 AS STRING), '.jsonl') AS _file, k AS _pos, concat('案', cast(k - k % 2 AS STRING)) AS case_no, concat('原告', cast(k AS STRING), '''s') AS plaintiff,
  concat('被告', cast(k % 97 AS STRING)) AS defendant, CASE WHEN k % 9 = 0 THEN 'failed' ELSE 'success' END AS status FROM cases
"""
FEES = """
SELECT concat('result_', cast(k % 12 AS STRING), '.jsonl') AS _file, k AS _pos, CASE WHEN k % 29 = 0 THEN NULL ELSE concat('案', cast(k AS STRING)) END AS case_no,
  CASE WHEN k % 10 = 0 THEN NULL ELSE concat('案件受理费', cast(k % 500 AS STRING), '元，由被告', cast(k % 97 AS STRING), '负担。') END AS passage,
  k % 500 AS fee, CASE WHEN k % 14 = 1 THEN 'error' ELSE 'success' END AS status FROM cases
"""


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A synthetic table over an input folder.

    Two integers an order become long texts, so orders are dealt to the session's tasks first: a small file is one task's otherwise.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    orders = orders.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "o_orderkey")
    orders.createOrReplaceTempView("judgex_orders")
    cases = CASES.replace("FROM orders", "FROM judgex_orders")
    return spark.sql(cases if sql is CASES else f"WITH cases AS ({cases}) {sql}")


def duck(sql: str, **tables: str) -> str:
    """The same as the start of a DuckDB query: WITH cases, the named tables, and the query."""
    named = "".join(f", {k} AS ({v})" for k, v in tables.items())
    return f"WITH cases AS ({CASES}){named} {sql}"
