"""Registered cohort queries (A5, A7, A8, A9; D1-D3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelake.operators.aggregate import cohort, cohort_counts, pivot_count
from carelake.operators.lookup import broadcast_small
from carelake.plans.population import NETWORK_LABEL, STANDARD_COHORTS, cohort_sql, population_cohorts
from carelake.plans.registry import query
from carelake.plans.standins import AFFILIATES_SQL, affiliates


def site_roll(t):
    return affiliates(t.customer).join(
        broadcast_small(t.nation.select("n_nationkey", "n_name")),
        F.col("c_nationkey") == F.col("n_nationkey"))


@query("cohort_counts_by_site", f"""
SELECT CASE WHEN grouping(n_name) = 1 THEN '{NETWORK_LABEL}' ELSE n_name END AS n_name,
  {cohort_sql(STANDARD_COHORTS)}
FROM ({AFFILIATES_SQL}) a JOIN nation n ON a.c_nationkey = n.n_nationkey
GROUP BY GROUPING SETS ((n_name), ())
""")
def cohort_counts_by_site(t):
    """45 age/sex cohorts per site plus the network total, one pass."""
    return population_cohorts(site_roll(t), "n_name")


@query("cohort_counts_strict", f"""
SELECT * FROM (
SELECT n_name, {cohort_sql(STANDARD_COHORTS)}
FROM ({AFFILIATES_SQL}) a JOIN nation n ON a.c_nationkey = n.n_nationkey
GROUP BY n_name) s
WHERE {' AND '.join(c.name + ' > 0' for c in STANDARD_COHORTS)}
""")
def cohort_counts_strict(t):
    """J5 replaced by A8 with ``strict=True``: sites present in every cohort."""
    return cohort_counts(site_roll(t), "n_name", STANDARD_COHORTS, strict=True)


@query("cohort_counts_strict_total", f"""
WITH s AS (SELECT n_name, {cohort_sql(STANDARD_COHORTS)}
FROM ({AFFILIATES_SQL}) a JOIN nation n ON a.c_nationkey = n.n_nationkey GROUP BY n_name),
k AS (SELECT * FROM s WHERE {' AND '.join(c.name + ' > 0' for c in STANDARD_COHORTS)})
SELECT * FROM k UNION ALL
SELECT '{NETWORK_LABEL}', {', '.join(f'CAST(sum({c.name}) AS BIGINT)' for c in STANDARD_COHORTS)} FROM k
""")
def cohort_counts_strict_total(t):
    """The network total is over the sites that stay."""
    return cohort_counts(site_roll(t), "n_name", STANDARD_COHORTS, strict=True, total_label=NETWORK_LABEL)


@query("population_from_branch_files", f"""
WITH a AS (SELECT CAST(c_nationkey % 5 AS VARCHAR) AS branch,
  year(DATE '2001-03-15') - year(born) - CASE WHEN month(born) * 100 + day(born) > 315 THEN 1 ELSE 0 END AS age,
  CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex
  FROM (SELECT *, CAST(DATE '1930-01-01' + CAST(c_custkey * 37 % 25000 AS INTEGER) AS DATE) AS born FROM customer) x)
SELECT CASE WHEN grouping(branch) = 1 THEN '{NETWORK_LABEL}' ELSE branch END AS branch, DATE '2001-03-15' AS period,
  {cohort_sql(STANDARD_COHORTS)}
FROM a GROUP BY GROUPING SETS ((branch), ())
""")
def population_from_branch_files(t):
    """D1 end to end: branch files landed as text -> union with the branch from
    the path -> age from the birth date -> 45 cohorts and the network row ->
    monthly gate and publish, read back."""
    import datetime as dt

    from carelake.functions.coerce import coerce_date
    from carelake.plans.population import with_ages
    from carelake.session import work_dir
    from carelake.sinks import tables as K
    from carelake.sources import readers as R
    spark = t.customer.sparkSession
    base = work_dir(spark, "population")
    born = F.date_add(F.lit(dt.date(1930, 1, 1)), (F.col("c_custkey") * 37 % 25000).cast("int"))
    (t.customer.select(F.col("c_custkey").cast("string").alias("id"), F.date_format(born, "dd/MM/yyyy").alias("born"),
                       F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("sex"), (F.col("c_nationkey") % 5).alias("branch"))
     .write.partitionBy("branch").option("encoding", "ISO-8859-1").csv(f"{base}/files"))
    roll = R.scan_union(spark, [f"{base}/files/branch={b}" for b in range(5)], names=["id", "born", "sex"], encoding="ISO-8859-1")
    run = dt.date(2001, 3, 15)
    roll = roll.withColumns({"branch": F.regexp_extract("source_file", r"branch=([0-9]+)", 1),
                             "born": coerce_date("born", "dd/MM/yyyy")})
    out = population_cohorts(with_ages(roll, "born", F.lit(run)), "branch").withColumn("period", F.lit(run))
    K.publish_all([K.PublishSpec("population", out)], f"{base}/out", f"{base}/log", run)
    return spark.read.parquet(f"{base}/out/population")


@query("cohort_pivot_sex", f"""
SELECT n_name, CAST(count_if(sex = 'F') AS BIGINT) AS F, CAST(count_if(sex = 'M') AS BIGINT) AS M
FROM ({AFFILIATES_SQL}) a JOIN nation n ON a.c_nationkey = n.n_nationkey
GROUP BY n_name
""")
def cohort_pivot_sex(t):
    """Site x sex pivot count."""
    return pivot_count(site_roll(t), "n_name", "sex", ["F", "M"])


PARAMETRIC = [
    cohort("between", 10, 20), cohort("eq", 15), cohort("gt", 40), cohort("ge", 40),
    cohort("lt", 5), cohort("le", 5), cohort("between", 10, 20, sex="F"),
    cohort("lt", 5, sex="M"), cohort("le", 5, sex="F"), cohort("ge", 40, sex="M"),
]
_PART_SEX = "CASE WHEN p_partkey % 2 = 0 THEN 'F' ELSE 'M' END"


@query("parametric_cohorts", f"""
SELECT p_brand, {cohort_sql(PARAMETRIC, 'p_size', 'sex')}
FROM (SELECT p_brand, p_size, {_PART_SEX} AS sex FROM part) p
GROUP BY p_brand
""")
def parametric_cohorts(t):
    """The six comparison kinds (with and without sex) on ``p_size``."""
    p = t.part.withColumn("sex", F.when(F.col("p_partkey") % 2 == 0, "F").otherwise("M"))
    return cohort_counts(p, "p_brand", PARAMETRIC, age="p_size", sex="sex")


DENTAL = [cohort("le", 5), cohort("between", 6, 11), cohort("between", 12, 17), cohort("ge", 18), cohort("ge", 18, sex="F")]


@query("dental_cohorts", f"""
SELECT CASE WHEN grouping(n_name) = 1 THEN '{NETWORK_LABEL}' ELSE n_name END AS n_name, {cohort_sql(DENTAL)}
FROM ({AFFILIATES_SQL}) a JOIN nation n ON a.c_nationkey = n.n_nationkey GROUP BY GROUPING SETS ((n_name), ())
""")
def dental_cohorts(t):
    """D3: five parametric cohorts per site with the network total."""
    return cohort_counts(site_roll(t), "n_name", DENTAL, total_label=NETWORK_LABEL)


@query("new_affiliates", f"""
WITH cur AS (SELECT DISTINCT o_custkey FROM orders
             WHERE o_orderdate >= TIMESTAMP '2001-01-01' AND o_orderdate < TIMESTAMP '2001-02-01'),
     prev AS (SELECT DISTINCT o_custkey FROM orders
             WHERE o_orderdate >= TIMESTAMP '2000-12-01' AND o_orderdate < TIMESTAMP '2001-01-01'),
     newc AS (SELECT o_custkey FROM cur WHERE NOT EXISTS (SELECT 1 FROM prev WHERE prev.o_custkey = cur.o_custkey))
SELECT CASE WHEN grouping(n_name) = 1 THEN '{NETWORK_LABEL}' ELSE n_name END AS n_name,
  {cohort_sql(STANDARD_COHORTS)}
FROM newc JOIN ({AFFILIATES_SQL}) a ON a.c_custkey = newc.o_custkey
JOIN nation n ON a.c_nationkey = n.n_nationkey
GROUP BY GROUPING SETS ((n_name), ())
""")
def new_affiliates_q(t):
    """Cohorts of affiliates active this month and not the previous."""
    from carelake.functions.dates import in_range
    import datetime as dt
    o = t.orders.select("o_custkey", "o_orderdate")
    cur = o.filter(in_range("o_orderdate", dt.date(2001, 1, 1), dt.date(2001, 2, 1))).select("o_custkey").distinct()
    prev = o.filter(in_range("o_orderdate", dt.date(2000, 12, 1), dt.date(2001, 1, 1))).select("o_custkey")
    from carelake.plans.population import new_affiliates
    newc = new_affiliates(cur, prev, "o_custkey")
    roll = site_roll(t).join(newc, F.col("c_custkey") == F.col("o_custkey"), "left_semi")
    return population_cohorts(roll, "n_name", STANDARD_COHORTS)
