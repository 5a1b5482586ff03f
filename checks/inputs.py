"""Inputs projected from the test tables, in SQL that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-02-15"

BASE_SQL = """
  SELECT o.o_orderkey AS k, CAST(o.o_orderdate AS DATE) AS d, o.o_orderpriority AS pr,
         c.c_name, c.c_mktsegment AS seg, n.n_name, o.o_custkey AS ck
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
                JOIN nation n ON c.c_nationkey = n.n_nationkey"""

PST_FIELDS_SQL = """
SELECT k AS seq,
  CASE k % 6 WHEN 0 THEN 'indeed' WHEN 1 THEN 'linkedin' WHEN 2 THEN 'zip_recruiter'
             WHEN 3 THEN 'glassdoor' WHEN 4 THEN 'naukri' ELSE 'reed' END AS site,
  concat('j', CAST(k - (k % 12) + k % 6 AS STRING)) AS id,
  concat('https://jobs.example.com/jobs/role-', CAST(k % 997 AS STRING), CASE k % 3 WHEN 0 THEN '/' WHEN 1 THEN '?page=2' ELSE '#top' END) AS job_url,
  concat(CASE k % 4 WHEN 0 THEN 'Senior Engineer' WHEN 1 THEN 'Remote Analyst' WHEN 2 THEN 'Sales' ELSE 'Data Intern' END, ' ', lower(seg)) AS title,
  c_name AS company_name,
  CASE k % 5 WHEN 0 THEN concat(n_name, ', CA') WHEN 1 THEN 'Dublin, Co. Dublin, Ireland' WHEN 2 THEN 'Remote' WHEN 3 THEN 'Pune, India' ELSE NULL END AS location_text,
  CASE k % 4 WHEN 0 THEN 'usa' WHEN 1 THEN 'united kingdom' WHEN 2 THEN 'ireland' ELSE 'worldwide' END AS country,
  CASE WHEN k % 11 = 0 THEN NULL ELSE d END AS date_posted,
  CASE k % 6 WHEN 0 THEN 'Today' WHEN 1 THEN '3 days ago' WHEN 2 THEN '30+ days ago' WHEN 3 THEN 'posted 2 weeks ago' WHEN 4 THEN '15 Jan 2024' ELSE '2w' END AS date_label,
  CASE k % 5 WHEN 0 THEN 'full-time' WHEN 1 THEN 'Part Time' WHEN 2 THEN 'Contract' WHEN 3 THEN 'Praktikum' ELSE NULL END AS job_type_text,
  CASE k % 7 WHEN 0 THEN 'hourly' WHEN 1 THEN 'daily' WHEN 2 THEN 'weekly' WHEN 3 THEN 'monthly' WHEN 4 THEN 'yearly' ELSE NULL END AS comp_interval,
  CASE WHEN k % 7 < 5 THEN CAST(20 + k % 60 AS DOUBLE) END AS comp_min,
  CASE WHEN k % 7 < 4 THEN CAST(90 + k % 60 AS DOUBLE) END AS comp_max,
  CASE k % 9
    WHEN 0 THEN concat('Pay $', CAST(20 + k % 60 AS STRING), '.50 - $', CAST(30 + k % 70 AS STRING), '/hr, full time')
    WHEN 1 THEN concat('Range $', CAST(60 + k % 90 AS STRING), 'k – $', CAST(120 + k % 50 AS STRING), 'K. Contract, work from home')
    WHEN 2 THEN concat('$', CAST(60 + k % 90 AS STRING), ',000 - ', CAST(100 + k % 99 AS STRING), ',500')
    WHEN 3 THEN concat('monthly $', CAST(2 + k % 9 AS STRING), ',', CAST(100 + k % 900 AS STRING), ' - $', CAST(4 + k % 40 AS STRING), ',000')
    WHEN 4 THEN 'signing bonus $1,000,000 - $2,000,000'
    WHEN 5 THEN concat('write to hr', CAST(k % 50 AS STRING), '@example.com or jobs@example.org')
    WHEN 6 THEN 'Internship, part time, remote' WHEN 7 THEN '' ELSE NULL END AS description,
  CASE k % 6
    WHEN 0 THEN concat(CAST(5 + k % 20 AS STRING), '-', CAST(25 + k % 20 AS STRING), ' Lacs P.A.') WHEN 1 THEN '1-2.5 Cr' WHEN 2 THEN 'Not disclosed'
    WHEN 3 THEN concat('€', CAST(30 + k % 40 AS STRING), ',000 - €', CAST(80 + k % 9 AS STRING), ',000 per annum')
    WHEN 4 THEN concat('$', CAST(35 + k % 9 AS STRING), ' per hour') ELSE 'Competitive' END AS salary_label
FROM base
"""

PST_SQL = f"\nWITH base AS ({BASE_SQL}){PST_FIELDS_SQL}"

SOC_SQL = """
SELECT l.l_orderkey * 10 + l.l_linenumber AS id, concat('user', CAST(l.l_suppkey % 50 AS STRING)) AS handle,
  CAST(CAST(l.l_shipdate AS DATE) AS STRING) AS iso,
  concat(
    CASE l.l_partkey % 4 WHEN 0 THEN 'Now hiring: Senior PHP Developer #php' WHEN 1 THEN 'Backend Engineer needed in our team' WHEN 2 THEN '#hiring Data Analyst' ELSE 'hello' END, chr(10),
    CASE l.l_suppkey % 6 WHEN 0 THEN 'Location: Berlin | on site' WHEN 1 THEN 'based in Dublin' WHEN 2 THEN 'call +44 20 7946 0000' WHEN 3 THEN 'apply https://acme.co.uk/jobs' WHEN 4 THEN 'salary £60k, join Acme Corp!' ELSE 'work from home, anywhere in India' END, chr(10),
    CASE l.l_linenumber % 3 WHEN 0 THEN 'full time' WHEN 1 THEN 'contract' ELSE 'see https://t.co/abc' END) AS text
FROM lineitem l
"""

SOURCE_TABLES = ("orders", "customer", "nation", "lineitem")


#: Bytes of a table's file that one task parses. Tasks become more, not longer, as a table grows.
PIECE = 1 << 20


def pieces(df: DataFrame) -> int:
    """Into how many parts a test table is dealt: by its size, and over all cores at least."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-size // PIECE))


def spread(df: DataFrame) -> DataFrame:
    """Rows of a test table over tasks of like size: it comes in one file, and parsing costs far more than this."""
    return df.repartition(pieces(df))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _project(spark: SparkSession, sf: str, sql: str) -> DataFrame:
    """Run a projection without leaving temporary views behind."""
    frames = {}
    for name in SOURCE_TABLES:
        marked = sql.replace(f"FROM {name} ", f"FROM {{{name}}} ").replace(
            f"JOIN {name} ", f"JOIN {{{name}}} "
        ).replace(f"FROM {name}\n", f"FROM {{{name}}}\n")
        if marked != sql:
            sql, frames[name] = marked, table(spark, sf, name)
    if "lineitem" in frames:
        frames["lineitem"] = spread(frames["lineitem"])
    return spark.sql(sql, **frames)


def pst(spark: SparkSession, sf: str) -> DataFrame:
    # Dealt out after the join: the optimizer would join large tables in no more tasks than there are cores.
    base = _project(spark, sf, BASE_SQL).repartition(pieces(table(spark, sf, "orders")))
    return spark.sql(PST_FIELDS_SQL.replace("FROM base", "FROM {base}"), base=base)


def soc(spark: SparkSession, sf: str) -> DataFrame:
    return _project(spark, sf, SOC_SQL)


def raw(df: DataFrame, payload, site="x", url=None, company="company_name", seq="seq") -> DataFrame:
    """A payload table from any frame. The payload is built once, as if it had been read.

    Only the payload is: who asks for one site doesn't build the payloads of others.
    """
    columns = {
        "seq": F.col(seq),
        "site": F.lit(site),
        "fetched_at": F.lit(None).cast("timestamp"),
        "url": F.lit(None).cast("string") if url is None else url,
        "company": F.col(company) if company in df.columns else F.lit(None).cast("string"),
    }
    built = F.inline(F.array(F.struct(payload.alias("payload"))))
    return df.select(*[c.alias(n) for n, c in columns.items()], built)


def plain(df: DataFrame) -> DataFrame:
    """Dates as text, which both engines write the same way."""
    return df.select(
        *[F.col(c).cast("string").alias(c) if t == "date" else F.col(c) for c, t in df.dtypes]
    )


def pst_sql(body: str, **ctes: str) -> str:
    """A statement over ``pst`` (and further named steps)."""
    steps = [f"pst AS ({PST_SQL})"] + [f"{n} AS ({q})" for n, q in ctes.items()]
    return f"WITH {', '.join(steps)} {body}"


def soc_sql(body: str, **ctes: str) -> str:
    steps = [f"soc AS ({SOC_SQL})"] + [f"{n} AS ({q})" for n, q in ctes.items()]
    return f"WITH {', '.join(steps)} {body}"
