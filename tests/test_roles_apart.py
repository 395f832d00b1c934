"""Steps of one role, read without the others'."""

import pytest
from pyspark.sql import functions as F

from weftline.plans import bindings

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("role", bindings.ROLES.values())
def test_only_one_role(spark, role):
    alone, whole = bindings.sample_steps(spark, DIR, role), bindings.sample_steps(spark, DIR).where(F.col("role") == role)
    assert sorted(map(tuple, alone.collect())) == sorted(map(tuple, whole.collect()))


def test_other_roles_go_before_steps_are_counted(spark):
    plan = bindings.sample_steps(spark, DIR, "read")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and "o_orderstatus" in plan[plan.index("Window") :]
    assert "o_orderstatus" not in "".join(x for x in plan[: plan.index("Window")].splitlines() if "Filter" in x)


def test_unknown_status_is_a_reference(spark, tmp_path):
    for name in ("lineitem", "part"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{DIR}/{name}.parquet")
    orders = spark.read.parquet(f"{DIR}/orders.parquet")
    orders.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus"))).write.parquet(str(tmp_path / "orders.parquet"))
    steps = bindings.sample_steps(spark, str(tmp_path))
    for role in bindings.ROLES.values():
        assert bindings.sample_steps(spark, str(tmp_path), role).count() == steps.where(F.col("role") == role).count()
