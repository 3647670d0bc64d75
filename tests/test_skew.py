"""A record with a third of all rows: joins are split, results stay whole."""

import pytest
from pyspark.sql import functions as F

from recordflow.operators import codes, dedup, upsert
from recordflow.schemas import EVENT, FIELD, INSTANCE, INSTRUMENT, RECORD, VALUE

ROWS = 200_000


@pytest.fixture
def hot(spark):
    """Long rows, a third of them of one record; thresholds low enough to see the split."""
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    for name, value in small.items():
        spark.conf.set(name, value)
    number = F.col("id")
    yield spark.range(ROWS, numPartitions=8).select(
        F.when(number % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), (number % 999).cast("string"))).alias(RECORD),
        F.when(number % 7 == 0, "source").otherwise("other").alias(FIELD),
        number.cast("string").alias(VALUE),
        F.lit("e").alias(EVENT),
        F.lit("i").alias(INSTRUMENT),
        (number % 2).cast("int").alias(INSTANCE),
    )
    for name in small:
        spark.conf.unset(name)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_rules_split_the_hot_record(hot):
    out = codes.apply_rules(hot, [codes.RecordRule("target", "source", lambda v: F.lit("x"))], [VALUE])
    assert "skew=true" in final_plan(out)
    assert out.where(F.col(FIELD) != "target").count() == ROWS
    assert out.where(F.col(FIELD) == "target").count() == hot.where(F.col(FIELD) == "source").select(RECORD).distinct().count()


def test_latest_instance_splits_the_hot_record(hot):
    out = dedup.latest_instance(hot)
    assert "skew=true" in final_plan(out)
    newest = hot.groupBy(RECORD).agg(F.max(INSTANCE).alias("m"))
    assert out.count() == hot.join(newest, RECORD).where(F.col(INSTANCE) == F.col("m")).count()


def test_upsert_splits_the_hot_key(hot):
    target = hot.select(RECORD, FIELD, VALUE, EVENT)
    out = upsert.eav_upsert(target, target.where(F.col(RECORD) != "hot").withColumn(VALUE, F.lit("new")))
    assert "skew=true" in final_plan(out)
    assert out.where(F.col(RECORD) == "hot").count() == target.where(F.col(RECORD) == "hot").count()
