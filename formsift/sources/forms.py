"""Synthetic forms: one OCR text per customer, the employer taken from supplier.

The generated tables hold no form-like text, so forms are derived from them by plain arithmetic. The
same SQL text serves Spark and the checking engine; only array look-up and table names differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from formsift.constants import STATES

FIRST = ["James", "Maria", "Robert", "Linda", "Daniel", "Susan", "Carlos"]
LAST = ["Harlowe", "Cox", "Bailey", "Lawson", "Robertson", "Martinez", "Nguyen", "Fletcher", "Dalton",
        "Whitfield", "Okafor"]
ROAD = ["Quill Shoals", "Maple Street", "Juniper Radial Apt. 7", "Cedar Plaza", "Walnut Crest"]
CITY = ["Tarnwick", "Sedgebury", "Wrenfold", "Port Alder", "Lake Osmer", "Newfield", "Brookhaven",
        "Fairmont", "Oakdale", "Grantsburg", "Ridgefield", "Ashford", "West Adams"]


def forms_sql(pick, customer: str, supplier: str) -> str:
    """SQL for the forms; `pick(values, index)` renders an array look-up with a 0-based index."""
    copies = """
      concat_ws(chr(10),
        CASE WHEN v <> 2 THEN 'a Employee''s social security number' END,
        CASE WHEN v <> 2 THEN person_id END,
        'b Employer identification number (EIN)',
        ein,
        'c Employer''s name, address, and ZIP code',
        company,
        company_street,
        company_city,
        'd Control number',
        concat('C', CAST(k AS STRING)),
        CASE WHEN v = 9 THEN 'Last name' END,
        CASE WHEN v = 11 OR (v = 5 AND odd) THEN NULL
             WHEN v = 9 AND odd THEN 'e employee''s first name'
             ELSE 'e Employee''s first name and initial' END,
        CASE WHEN v <> 9 THEN 'Last name' END,
        CASE WHEN v = 8 THEN concat_ws(chr(10), first_name, '*** 11 ***',
               CASE WHEN k % 7 = 3 THEN concat_ws(chr(10), '*** 12 ***', '*** 13 ***', '*** 14 ***',
                                                  '*** 15 ***', '*** 16 ***') END, last_name)
             WHEN v = 10 THEN concat('Kirsten ', last_name)
             WHEN v = 12 AND odd THEN upper(concat(first_name, ' ', last_name))
             WHEN v = 12 THEN concat(last_name, ' Services')
             WHEN v = 13 AND odd THEN concat_ws(chr(10), first_name, 'A.', last_name)
             WHEN v = 13 THEN concat(first_name, ' A. ', last_name)
             WHEN k % 23 = 5 THEN concat('  ', first_name, chr(9), ' ', last_name, ' ')
             WHEN k % 29 = 6 THEN concat(first_name, chr(160), last_name)
             ELSE concat(first_name, ' ', last_name) END,
        street,
        CASE WHEN v = 3 THEN concat_ws(chr(10), city, state, zip)
             WHEN v = 4 THEN concat_ws(chr(10), concat(city, ' ', state), zip)
             WHEN v = 5 AND copy_no = 1 THEN zip
             WHEN v = 6 THEN concat_ws(chr(10), concat(city, ' ', state), zip5)
             WHEN v = 7 THEN concat_ws(chr(10), concat(state, ' ', zip), city)
             WHEN v = 15 THEN concat(city, ' ', state, ' ', zip5, '-813')
             ELSE concat(city, ' ', state, ' ', zip) END,
        'f Employee''s address and ZIP code',
        '1 Wages, tips, other compensation',
        concat(CAST(k * 7 % 90000 + 1000 AS STRING), '.5'),
        CASE WHEN k % 3 = 0 THEN 'Plan' END,
        'X')"""
    copy_one = copies.replace("copy_no", "1")
    copy_two = copies.replace("copy_no", "2")
    return f"""
SELECT k, v, path, substring_index_path AS file_name,
  CASE WHEN k % 97 = 0 THEN NULL
       WHEN k % 101 = 50 THEN concat('Employee''s first name and initial', chr(10), first_name, ' ', last_name,
                                     chr(10), 'Employee''s address and ZIP code')
       WHEN k % 101 = 51 THEN concat('c Employer''s name, address, and ZIP code', chr(10), company, chr(10), 'd Control number')
       WHEN k % 101 = 52 THEN concat('Cover sheet', chr(10), 'nothing to see')
       WHEN k % 17 = 0 THEN replace(text, chr(10), concat(chr(13), chr(10)))
       ELSE text END AS raw_text,
  CASE WHEN k % 97 = 0 THEN concat('OCR service error ', CAST(k % 7 AS STRING)) END AS error,
  CAST(k % 400 AS DOUBLE) / CAST(100 AS DOUBLE) AS processing_time_seconds,
  processed_second,
  first_name, last_name, street, city, state, zip, person_id
FROM (
  SELECT *,
    concat('raw/', CASE WHEN k % 2 = 0 THEN 'a' ELSE 'b' END, '/', file) AS path,
    file AS substring_index_path,
    CASE WHEN v = 1 THEN {copy_one}
         ELSE concat({copy_one}, chr(10), '   ', chr(10), {copy_two}) END AS text
  FROM (
    SELECT *,
      concat(CASE WHEN k % 10 = 7 THEN 'Form_' ELSE 'form_' END,
             CASE WHEN k % 6 < 4 THEN CASE WHEN k % 10 = 7 THEN 'CLEAN' ELSE 'clean' END
                  WHEN k % 6 = 4 THEN 'noisy' ELSE 'other' END,
             '_', lpad(CAST(k AS STRING), 12, '0'),
             CASE WHEN k % 13 = 5 THEN '.PDF' WHEN k % 19 = 4 THEN '.tif' ELSE '.pdf' END) AS file,
      concat('000-', lpad(CAST(k % 89 + 10 AS STRING), 2, '0'), '-',
             lpad(CAST(k % 9973 AS STRING), 4, '0')) AS person_id,
      concat('00-', lpad(CAST(k % 9999991 AS STRING), 7, '0')) AS ein,
      concat(replace(s_name, '#', ' '), ' Group') AS company,
      concat(CAST(s_suppkey % 9000 + 100 AS STRING), ' Commerce Way') AS company_street,
      concat('Newfield ', {pick(STATES, 's_suppkey % 51')}, ' ',
             lpad(CAST(s_suppkey % 90000 + 10000 AS STRING), 5, '0'), '-4444') AS company_city,
      concat(CASE WHEN v = 14 THEN CAST(k % 89999 + 10000 AS STRING)
                  ELSE CAST(k % 9998 + 1 AS STRING) END, ' ', {pick(ROAD, 'k % 5')}) AS street,
      {pick(FIRST, 'k % 7')} AS first_name,
      {pick(LAST, 'k % 11')} AS last_name,
      {pick(CITY, 'k % 13')} AS city,
      {pick(STATES, 'k % 51')} AS state,
      concat(lpad(CAST((k * 37 + 10007) % 100000 AS STRING), 5, '0'), '-',
             lpad(CAST(k * 13 % 10000 AS STRING), 4, '0')) AS zip,
      lpad(CAST((k * 37 + 10007) % 100000 AS STRING), 5, '0') AS zip5
    FROM (
      SELECT k, k % 16 AS v, k % 32 >= 16 AS odd, s_suppkey, s_name,
             1700000000 + k AS processed_second
      FROM (SELECT c_custkey AS k, c_custkey % (SELECT count(*) FROM {supplier}) AS sk
            FROM {customer}) c
      JOIN {supplier} s ON s.s_suppkey = c.sk
    ) keyed
  ) parts
) built"""


def truth_sql(pick, forms: str) -> str:
    """SQL for the ground truth of the forms; a few keys appear twice."""
    return f"""
SELECT t.file_name,
  CASE WHEN k % 6 < 4 THEN 'clean' WHEN k % 6 = 4 THEN 'noisy' ELSE 'unknown' END AS file_type,
  CASE WHEN k % 29 = 0 THEN ''
       WHEN k % 31 = 0 THEN concat(first_name, ' ', last_name, 'z')
       ELSE concat(first_name, ' ', last_name) END AS employee_name,
  CASE WHEN k % 23 = 0 THEN 'NOT_VERIFIABLE'
       WHEN v = 14 THEN concat(street, ' ', city, ' ', state, ' ',
                               substr(zip, 1, 9), CASE WHEN substr(zip, 10, 1) = '0' THEN '1' ELSE '0' END)
       WHEN v = 15 THEN concat(street, ', ', city, ', ', state, ' ', substr(zip, 1, 5), '-813')
       WHEN k % 19 = 4 THEN concat(street, ' No 7, ', city, ', ', state, ' ', zip)
       WHEN k % 19 = 5 THEN concat(substr(street, 1, length(street) - 2), ', ', city, ', ', state, ' ', zip)
       WHEN k % 19 = 6 THEN concat(street, ' Rear, Unit 8, ', city, ', ', state, ' ', zip)
       WHEN k % 19 = 8 THEN concat(city, ', ', street, ', ', state, ' ', zip)
       WHEN k % 19 = 7 THEN concat(substr(street, 1, 4), 's', substr(street, 6), ', ', substr(city, 2), ', ', state, ' ', zip)
       ELSE concat(street, ', ', city, ', ', state, ' ', zip) END AS employee_address,
  CASE WHEN k % 37 = 0 THEN 'NOT_VERIFIABLE' ELSE person_id END AS employee_ssn,
  CASE WHEN k % 23 = 0 THEN 'address cut off' ELSE '' END AS notes,
  k, copy_no
FROM (SELECT *, 1 AS copy_no FROM {forms}
      UNION ALL SELECT *, 2 AS copy_no FROM {forms} WHERE k % 211 = 3) t"""


def pick_spark(values: list[str], index: str) -> str:
    return "element_at(array(" + ", ".join(f"'{v}'" for v in values) + f"), CAST(1 + {index} AS INT))"


def pick_list(values: list[str], index: str) -> str:
    return "list_extract([" + ", ".join(f"'{v}'" for v in values) + f"], 1 + {index})"


def forms_from(spark: SparkSession, customer: str, supplier: str) -> DataFrame:
    df = spark.sql(forms_sql(pick_spark, customer, supplier))
    return df.withColumn("processed_at", df["processed_second"].cast("timestamp")).drop("processed_second")


def forms_of(customers: DataFrame, sf_dir: str, view: str = "form_keys") -> DataFrame:
    """One synthetic form for each of some customer rows.

    A form is about a hundred times the size of the key it is made from, so the keys are dealt out first.
    """
    spark = customers.sparkSession
    keys = customers.select("c_custkey").repartition(spark.sparkContext.defaultParallelism, "c_custkey")
    keys.createOrReplaceTempView(view)
    return forms_from(spark, view, f"parquet.`{sf_dir}/supplier.parquet`")


def forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One synthetic form per customer row."""
    return forms_of(spark.read.parquet(f"{sf_dir}/customer.parquet"), sf_dir)


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ground truth for the forms."""
    return spark.sql(truth_sql(pick_spark, "{forms}"), forms=forms(spark, sf_dir))


def prior_sql(forms: str) -> str:
    """SQL for results stored by earlier runs: three in five forms, some failed, some stored twice.

    `seq` is the order of storing; a form stored twice was in review the first time.
    """
    return f"""
SELECT processed_at, processing_time_seconds, file_name, path,
  CASE WHEN k % 6 < 4 THEN 'clean' WHEN k % 6 = 4 THEN 'noisy' ELSE 'unknown' END AS file_type,
  CASE WHEN k % 10 = 1 THEN NULL ELSE concat(first_name, ' ', last_name) END AS employee_name,
  CASE WHEN k % 10 = 1 OR k % 3 = 0 THEN NULL ELSE concat(street, ', ', city, ', ', state, ' ', zip) END
    AS employee_address,
  CASE WHEN k % 10 = 1 THEN NULL ELSE person_id END AS employee_ssn,
  CAST(NULL AS STRING) AS employer_name, CAST(NULL AS STRING) AS employer_address,
  CAST(NULL AS STRING) AS employer_ein,
  CAST(CASE WHEN k % 10 = 1 THEN 0 ELSE 95 END AS DOUBLE) / 100 AS name_confidence,
  CAST(CASE WHEN k % 10 = 1 OR k % 3 = 0 THEN 0 ELSE 90 END AS DOUBLE) / 100 AS address_confidence,
  CAST(CASE WHEN k % 10 = 1 THEN 0 ELSE 95 END AS DOUBLE) / 100 AS id_confidence,
  CAST(CASE WHEN k % 10 = 1 THEN 0 ELSE 92 END AS DOUBLE) / 100 AS overall_confidence,
  CASE WHEN k % 10 = 1 THEN 'FAILED' WHEN copy_no = 1 OR k % 3 = 0 THEN 'NEEDS_REVIEW' ELSE 'AUTO_APPROVED' END
    AS status,
  CASE WHEN k % 10 = 1 THEN concat('service said "no",', chr(10), 'twice') ELSE 'stored, earlier' END
    AS review_reason,
  k + 1000000000000 * copy_no AS seq, k
FROM (SELECT *, 2 AS copy_no FROM {forms} WHERE k % 5 < 3
      UNION ALL SELECT *, 1 AS copy_no FROM {forms} WHERE k % 20 = 0) p"""


def prior_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results stored by earlier runs, in the result columns with `seq`, `path` and `k`."""
    return spark.sql(prior_sql("{forms}"), forms=forms(spark, sf_dir))
