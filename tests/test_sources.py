import pytest
from pyspark.sql import functions as F

from riskflow.contract import COUNTRIES, transaction_schema
from riskflow.functions.wire import keyed_records
from riskflow.operators.validate import validate_events
from riskflow.session import shared_folder
from riskflow.settings import FeatureSettings, LakeSettings, LogSettings, StreamSettings
from riskflow.sources.log import log_options, read_log
from tests.synthetic import TICKET_RANGE, GeneratorSettings, synthesize, transactions, with_anomalies


def test_same_seed_same_rows_on_any_partitioning(spark):
    one = transactions(spark, 500)
    other = synthesize(spark.range(1, 501, 1, 17).repartition(5))
    assert one.schema.names == transaction_schema().names
    assert [f.dataType for f in one.schema] == [f.dataType for f in transaction_schema()]
    assert one.exceptAll(other).count() == 0 and one.count() == 500
    assert one.exceptAll(transactions(spark, 500, GeneratorSettings(seed=7))).count() > 400


def test_generated_rows_are_valid_and_follow_the_rules(spark):
    made = transactions(spark, 2000)
    records = keyed_records(made).withColumns(
        {"topic": F.lit("t"), "partition": F.lit(0), "offset": F.lit(0)}
    )
    assert validate_events(records).where(~F.col("is_valid")).count() == 0
    assert made.where("channel = 'ATM' and transaction_type <> 'WITHDRAWAL'").count() == 0
    assert made.select("country").distinct().count() == len(COUNTRIES)
    assert made.groupBy("account_id").agg(F.count_distinct("device_id").alias("n")).where("n > 3").count() == 0
    for category, (low, high) in TICKET_RANGE.items():
        assert made.where(F.col("merchant_category") == category).where(~F.col("amount").between(low, high)).count() == 0
    second = F.unix_seconds("event_timestamp")
    stats = made.agg(F.min(second), F.max(second)).first()
    assert stats[0] >= 1767225605 and stats[1] <= 1767225600 + 2000 * 3600


def test_generator_arguments(spark):
    assert transactions(spark, 0).count() == 0
    with pytest.raises(ValueError):
        transactions(spark, -1)
    with pytest.raises(ValueError):
        GeneratorSettings(num_devices=0)
    with pytest.raises(ValueError):
        GeneratorSettings(countries=())


def test_anomalies_are_labelled(spark):
    made = with_anomalies(transactions(spark, 2000), rate=0.1)
    kinds = {r.anomaly: r["count"] for r in made.groupBy("anomaly").count().collect()}
    assert set(kinds) == {None, "geo", "device", "amount", "velocity"}
    assert kinds["velocity"] % 6 == 0
    assert made.where(F.col("is_fraud") != F.col("anomaly").isNotNull()).count() == 0
    assert with_anomalies(transactions(spark, 100), 0.0).where("is_fraud").count() == 0
    with pytest.raises(ValueError):
        with_anomalies(made, 2.0)


def test_log_source_options(spark):
    options = log_options(LogSettings(), "transactions.raw")
    assert options["startingOffsets"] == "earliest" and options["failOnDataLoss"] == "false"
    # The connector is not installed here; the builder must get as far as asking for it.
    with pytest.raises(Exception, match="(?i)kafka"):
        read_log(spark, LogSettings(), "transactions.raw")


def test_settings_defaults_and_overrides(monkeypatch):
    assert FeatureSettings.from_env() == FeatureSettings()
    assert LakeSettings.from_env() == LakeSettings()
    monkeypatch.setenv("HIGH_AMOUNT_THRESHOLD", "12.50")
    monkeypatch.setenv("LOCATION_GRID_DECIMALS", " ")
    monkeypatch.setenv("DATA_LAKE_DIR", "s3://bucket/lake")
    monkeypatch.setenv("SPARK_CONSOLE_SINK", "Yes")
    monkeypatch.setenv("SPARK_WATERMARK", "1 hour")
    monkeypatch.setenv("KAFKA_DLQ_TOPIC", "")
    settings = StreamSettings.from_env()
    assert str(settings.features.high_amount_threshold) == "12.50"
    assert settings.features.location_grid_decimals == 3
    assert settings.lake.silver_path == "s3://bucket/lake/silver/transactions"
    assert settings.lake.console_sink and settings.watermark == "1 hour"
    assert settings.log.dlq_topic == ""


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_folder(spark, "x") != shared_folder(spark, "x")
