"""Row/column security queries (R1-R5, X1) with customers as employees
(department = market segment, salary = account balance)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators.security import (
    mask_group,
    mask_user,
    membership_frame,
    policy_frame,
    register_mask_function,
    register_row_filter_function,
    rls_group,
    rls_user,
    secured_view,
)
from .registry import register, table

# Fixed policy config: who may see which department, and who sees salaries.
GROUP_POLICY = [("hr_team", "HOUSEHOLD"), ("finance_team", "MACHINERY")]
USER_POLICY = [("ana@example.com", "AUTOMOBILE"), ("ben@example.com", "MACHINERY")]
MEMBERSHIP = [("ana@example.com", "hr_team"), ("ben@example.com", "finance_team"),
              ("cy@example.com", "hr_team"), ("cy@example.com", "finance_team")]
SALARY_GROUPS = ["finance_team"]
SALARY_USERS = ["ben@example.com"]


def employees(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("emp_id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("dept"), F.col("c_acctbal").alias("salary"))


_EMP = "SELECT c_custkey AS emp_id, c_name AS name, c_mktsegment AS dept, c_acctbal AS salary FROM customer"


@register("rls_group", f"SELECT * FROM ({_EMP}) e WHERE dept IN ('HOUSEHOLD', 'MACHINERY')")
def q_rls_group(spark, sf_dir):
    """An allowed viewer and one whom no policy names (and who sees nothing)."""
    policy, members = policy_frame(spark, GROUP_POLICY), membership_frame(spark, MEMBERSHIP)
    seen = [rls_group(employees(spark, sf_dir), "dept", policy, members, user=u) for u in ("cy@example.com", "eve@example.com")]
    return seen[0].unionByName(seen[1])


@register("rls_user", f"SELECT * FROM ({_EMP}) e WHERE dept = 'AUTOMOBILE'")
def q_rls_user(spark, sf_dir):
    """An allowed viewer and one whom no policy names (and who sees nothing)."""
    policy = policy_frame(spark, USER_POLICY, "user")
    seen = [rls_user(employees(spark, sf_dir), "dept", policy, user=u) for u in ("ana@example.com", "eve@example.com")]
    return seen[0].unionByName(seen[1])


def _by_viewer(frame_of, *users):
    """The same table as each viewer sees it."""
    return reduce(lambda a, b: a.unionByName(b), [frame_of(u).withColumn("viewer", F.lit(u)) for u in users])


_MASKED = f"""
SELECT emp_id, name, dept, CAST(NULL AS DOUBLE) AS salary, 'ana@example.com' AS viewer FROM ({_EMP}) e
UNION ALL SELECT emp_id, name, dept, salary, 'ben@example.com' FROM ({_EMP}) e"""


@register("mask_group", _MASKED)
def q_mask_group(spark, sf_dir):
    members = membership_frame(spark, MEMBERSHIP)
    return _by_viewer(lambda u: mask_group(employees(spark, sf_dir), ["salary"], SALARY_GROUPS, members, user=u),
                      "ana@example.com", "ben@example.com")


@register("mask_user", _MASKED)
def q_mask_user(spark, sf_dir):
    return _by_viewer(lambda u: mask_user(employees(spark, sf_dir), ["salary"], SALARY_USERS, user=u),
                      "ana@example.com", "ben@example.com")


@register("secured_view", f"""
SELECT emp_id, name, dept, CAST(NULL AS DOUBLE) AS salary FROM ({_EMP}) e
WHERE dept IN ('HOUSEHOLD', 'AUTOMOBILE')""")
def q_secured_view(spark, sf_dir):
    return secured_view(employees(spark, sf_dir), "employee_secured", row_column="dept",
                        group_policy=policy_frame(spark, GROUP_POLICY),
                        user_policy=policy_frame(spark, USER_POLICY, "user"),
                        membership=membership_frame(spark, MEMBERSHIP),
                        masks={"salary": SALARY_GROUPS}, user="ana@example.com")


@register("sql_udf_mask", f"""
SELECT emp_id, name, dept, salary AS salary_for_ben, CAST(NULL AS DOUBLE) AS salary_for_ana
FROM ({_EMP}) e WHERE dept = 'MACHINERY'""")
def q_sql_udf_mask(spark, sf_dir):
    register_row_filter_function(spark, "tm_dept_visible", USER_POLICY)
    register_mask_function(spark, "tm_mask_salary", SALARY_USERS)
    employees(spark, sf_dir).createOrReplaceTempView("tm_employee")
    return spark.sql("""
        SELECT emp_id, name, dept,
               tm_mask_salary(salary, 'ben@example.com') AS salary_for_ben,
               tm_mask_salary(salary, 'ana@example.com') AS salary_for_ana
        FROM tm_employee
        WHERE tm_dept_visible(dept, 'ben@example.com')""")
