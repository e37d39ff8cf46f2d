"""Both feeds, derived from the ``customer`` and ``orders`` test tables.

The SQL is common to Spark and DuckDB, which only name two functions differently.
It covers every row of both tables; some rows are repeated, as older or identical
copies. Orders of every seventh customer become guest purchases that match nobody,
so some customers stay unmatched. Both feeds have blank emails, and one customer in
a thousand has no id.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

# The day all ages are measured from, so that results do not depend on today.
AS_OF = dt.date(2001, 12, 31)
AS_OF_TIME = dt.datetime(2001, 12, 31, 12, 0, 0)

CRM_RAW_SQL = """
WITH k AS (
  SELECT c_custkey AS k,
    {explode}(CASE WHEN c_custkey % 12 = 0 THEN {array}(0, 1)
                   WHEN c_custkey % 30 = 1 THEN {array}(0, 0)
                   ELSE {array}(0) END) AS dup
  FROM {customer})
SELECT
  CASE WHEN k % 1000 <> 77 THEN ' CRM' || lpad(cast(k as string), 8, '0') END AS customer_id,
  'First' || cast(k % 97 as string) || ' ' AS first_name,
  'Last' || cast(k % 101 as string) AS last_name,
  CASE WHEN k % 40 = 16 THEN ''
       WHEN k % 40 = 24 THEN '   '
       WHEN k % 8 = 0 THEN NULL
       WHEN k % 8 = 1 THEN '  Cust' || cast(k as string) || ' @Example.COM '
       WHEN k % 40 = 3 THEN 'bad-address-' || cast(k as string)
       ELSE 'cust' || cast(k as string) || '@example.com' END AS email,
  CASE WHEN k % 9 = 0 THEN NULL
       WHEN k % 2 = 0 AND k % 9 < 5 THEN '+44 (79) ' || lpad(cast(k as string), 8, '0')
       WHEN k % 2 = 0 THEN '079' || lpad(cast(k as string), 8, '0')
       WHEN k % 9 < 5 THEN '+33 6' || lpad(cast(k as string), 8, '0')
       ELSE '06 ' || lpad(cast(k as string), 8, '0') END AS phone,
  CASE WHEN k % 15 = 0 THEN NULL
       ELSE cast(100 + k as string) || CASE WHEN dup = 1 THEN ' Old St' ELSE ' Main St' END
       END AS address,
  CASE k % 4 WHEN 0 THEN 'London' WHEN 1 THEN 'Paris' WHEN 2 THEN 'Glasgow'
       ELSE 'Lyon' END AS city,
  CASE WHEN k % 2 = 0 THEN 'UK' ELSE 'France' END AS country,
  CASE WHEN k % 6 = 0
       THEN replace(cast(date '1990-01-01' + cast((k * 37) % 1500 as int) as string), '-', '')
       ELSE cast(date '1990-01-01' + cast((k * 37) % 1500 as int) as string)
       END AS registration_date,
  cast(date '1998-01-01' + cast((k * 11) % 300 as int) - cast(400 * dup as int) as string)
    AS last_updated
FROM k
"""

TRX_RAW_SQL = """
WITH copies AS (
  SELECT o_orderkey, o_custkey, cast(o_orderdate as date) AS ordered,
    {explode}(CASE WHEN o_orderkey % 50 = 0 THEN {array}(0, 30)
                   ELSE {array}(0) END) AS days_older
  FROM {orders}),
o AS (SELECT o_orderkey, o_custkey, ordered - days_older AS d FROM copies)
SELECT
  'TXN' || lpad(cast(o_orderkey as string), 9, '0') AS transaction_id,
  CASE WHEN o_custkey % 7 = 6
         THEN CASE WHEN o_orderkey % 2 = 0 THEN 'guest' || cast(o_custkey as string) || '@example.org' END
       WHEN o_orderkey % 40 = 10 THEN ''
       WHEN o_orderkey % 40 = 30 THEN ' '
       WHEN o_custkey % 8 = 0 OR o_orderkey % 10 = 0 OR o_custkey % 5 = 4 THEN NULL
       ELSE 'cust' || cast(o_custkey as string) || '@example.com' END AS customer_email,
  CASE WHEN o_custkey % 7 = 6 THEN 'Guest' ELSE 'First' || cast(o_custkey % 97 as string) END
    AS first_name,
  'Last' || cast(o_custkey % 101 as string) AS last_name,
  CASE WHEN o_custkey % 7 = 6 OR o_custkey % 3 = 0 THEN NULL
       WHEN o_custkey % 2 = 0 THEN '079' || lpad(cast(o_custkey as string), 8, '0')
       ELSE '06' || lpad(cast(o_custkey as string), 8, '0') END AS phone,
  CASE WHEN o_orderkey % 25 = 0 THEN NULL
       ELSE cast(100 + o_custkey as string) || ' Ship Rd' END AS shipping_address,
  CASE o_custkey % 4 WHEN 0 THEN 'London' WHEN 1 THEN 'Paris' WHEN 2 THEN 'Glasgow'
       ELSE 'Lyon' END AS city,
  CASE WHEN o_custkey % 2 = 0 THEN 'UK' ELSE 'France' END AS country,
  CASE WHEN o_orderkey % 5 = 0 THEN replace(cast(d as string), '-', '')
       ELSE cast(d as string) END AS purchase_date
FROM o
"""

# Spellings the two feeds do not contain, one per customer or order.
EMAIL_CASES_SQL = """
SELECT c_custkey AS id,
  CASE c_custkey % 8
    WHEN 0 THEN '  Jo.' || cast(c_custkey as string) || '@Mail.COM  '
    WHEN 1 THEN 'jo . ' || cast(c_custkey as string) || ' @ mail . com'
    WHEN 2 THEN NULL
    WHEN 3 THEN ''
    WHEN 4 THEN '   '
    WHEN 5 THEN 'JO' || chr(9) || cast(c_custkey as string) || chr(10) || '@MAIL.com'
    WHEN 6 THEN 'no-at-sign-' || cast(c_custkey as string)
    ELSE 'jo+' || cast(c_custkey as string) || '@mail.co.uk' END AS email
FROM {customer}
"""

PHONE_CASES_SQL = """
SELECT id, country,
  CASE id % 30
    WHEN 0 THEN NULL
    WHEN 1 THEN ''
    WHEN 2 THEN '+4479' || n8
    WHEN 3 THEN '+336' || n8
    WHEN 4 THEN '079' || n8
    WHEN 5 THEN '06' || n8
    WHEN 6 THEN '+44 (79) ' || n8
    WHEN 7 THEN 'abc' || substr(n8, 6, 3)
    WHEN 8 THEN '53' || n8
    WHEN 9 THEN '+44079' || n8
    WHEN 10 THEN '+3306' || n8
    WHEN 11 THEN '+1555' || n8
    WHEN 12 THEN '+0' || n8
    WHEN 13 THEN '004479' || n8
    WHEN 14 THEN '00336' || n8
    WHEN 15 THEN '4479' || n8
    WHEN 16 THEN '336' || n8
    WHEN 17 THEN '0033 0 6' || n8
    WHEN 18 THEN '079' || n8 || ' ext 5'
    WHEN 19 THEN '++44 79' || n8
    WHEN 20 THEN '079' || n8 || '+'
    WHEN 21 THEN '079+' || n8
    WHEN 22 THEN '-- ()'
    WHEN 24 THEN '001415555' || substr(n8, 5, 4)
    WHEN 25 THEN '00353 86 ' || substr(n8, 2, 7)
    WHEN 26 THEN '00 49 151 ' || n8
    WHEN 27 THEN '+353 0 86 ' || substr(n8, 2, 7)
    WHEN 28 THEN '＋４４ ７９' || n8
    WHEN 29 THEN '٠٧٩' || n8
    ELSE '0' || substr(n8, 1, 7) END AS phone
FROM (
  SELECT c_custkey AS id, lpad(cast(c_custkey as string), 8, '0') AS n8,
    CASE c_nationkey % 5 WHEN 0 THEN 'UK' WHEN 1 THEN 'France' WHEN 2 THEN 'UK'
         WHEN 3 THEN 'Spain' ELSE NULL END AS country
  FROM {customer}) AS numbered
"""

DATE_CASES_SQL = """
SELECT id,
  CASE id % 13
    WHEN 0 THEN iso
    WHEN 1 THEN replace(iso, '-', '')
    WHEN 2 THEN NULL
    WHEN 3 THEN ''
    WHEN 4 THEN replace(iso, '-', '/')
    WHEN 5 THEN ' ' || iso
    WHEN 6 THEN iso || ' '
    WHEN 7 THEN substr(iso, 1, 4) || '-1-5'
    WHEN 8 THEN substr(iso, 1, 4) || '-02-30'
    WHEN 9 THEN substr(iso, 1, 4) || '1301'
    WHEN 10 THEN iso || ' 10:00:00'
    WHEN 11 THEN iso || 'T10:00:00'
    ELSE substr(iso, 3, 8) END AS text
FROM (SELECT o_orderkey AS id, cast(cast(o_orderdate as date) as string) AS iso
      FROM {orders}) AS dated
"""


def duckdb(sql: str) -> str:
    return sql.format(
        customer="customer", orders="orders", explode="unnest", array="list_value"
    )


def spark_sql(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    frames = {
        name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
        for name in ("customer", "orders")
        if f"{{{name}}}" in sql
    }
    names = {name: f"{{{name}}}" for name in frames}
    return spark.sql(sql.format(**names, explode="explode", array="array"), **frames)


def crm_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_sql(spark, sf_dir, CRM_RAW_SQL)


def trx_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_sql(spark, sf_dir, TRX_RAW_SQL)


def email_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_sql(spark, sf_dir, EMAIL_CASES_SQL)


def phone_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_sql(spark, sf_dir, PHONE_CASES_SQL)


def date_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_sql(spark, sf_dir, DATE_CASES_SQL)


# Which of three batches brings a row. Copies of one id mostly come in different ones.
CRM_LOT = "(cast(coalesce(substr(trim(customer_id), 4), '0') as int) + cast(right(last_updated, 1) as int)) % 3"
TRX_LOT = "(cast(substr(transaction_id, 4) as int) + cast(right(purchase_date, 1) as int)) % 3"
BATCHES = 3

# Days of the snapshots that a history is made of: what had been bought by then.
SNAPSHOT_DAYS = (dt.date(1996, 1, 1), dt.date(1998, 1, 1), dt.date(2001, 12, 31))


def batches(feed: DataFrame, lot: str) -> list[DataFrame]:
    """All rows of a feed in its batches."""
    return [feed.filter(f"{lot} = {k}") for k in range(BATCHES)]


# Keys that several customers of the feed share: long chains in the larger test tables.
HOUSEHOLD_KEYS = (("last_name", "city", "country"), ("registration_date", "city"))


# Lines of the customer feed as they might arrive: some with a column too many or too few, some
# with a character that stands for broken bytes.
FEED_LINES_SQL = """
SELECT n % 50 IN (3, 7, 11) AS damaged, n % 50 AS kind,
  coalesce(customer_id, '') || ',' || first_name || CASE WHEN n % 50 = 11 THEN chr(65533) ELSE '' END || ',' || last_name
  || ',' || coalesce(email, '') || ',' || coalesce(phone, '') || ',' || coalesce(address, '') || ',' || city || ',' || country
  || ',' || registration_date || CASE n % 50 WHEN 7 THEN '' WHEN 3 THEN ',' || last_updated || ',x' ELSE ',' || last_updated END AS line
FROM (SELECT *, cast(coalesce(substr(trim(customer_id), 4), '0') as int) AS n FROM ({crm_raw})) AS numbered
"""
