"""Named queries over the benchmark tables; each callable takes ``(spark, folder)``.

Results use plain types: money as DOUBLE, instants as UTC timestamps without zone,
arrays as joined text, so that any engine can be compared with them.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskflow.contract import COUNTRIES, HOME
from riskflow.functions.geo import grid_cell, haversine_km
from riskflow.functions.wire import canonical_value, keyed_records
from riskflow.operators import behaviour as B
from riskflow.operators import evaluate, marts, quality, rules
from riskflow.operators.order_stats import amount_order
from riskflow.operators.parse import deduplicate, parse_events, prepare_events, with_event_time
from riskflow.operators.sessions import account_sessions, sliding_windows
from riskflow.operators.signals import with_transaction_signals
from riskflow.operators.sketches import (
    distinct_error,
    distinct_sketches,
    quantile_sketches,
    sketched_stability,
    united_distincts,
)
from riskflow.operators.validate import dead_letters, route, valid_events, validate_events
from riskflow.operators.windows import DAY_WINDOW, account_window_features, window_features
from riskflow.plans import forest, lake, models
from riskflow.plans.merge import merge_into, start_merge
from riskflow.plans.pipeline import build_lake, refine, upsert
from riskflow.session import configure, shared_folder, stored_table
from riskflow.settings import FeatureSettings
from riskflow.sources.records import FAULT_CASES, peek_records, raw_records, with_faults
from riskflow.sources.tables import read_table, read_transactions, transactions_from_events
from riskflow.streaming.history import (
    ProgressHistory,
    dead_letter_rate,
    duplicate_rate,
    history,
    observed_routing,
    observed_rows,
)
from riskflow.streaming.keyed import pair_state, pairs_by_transaction, start_keyed, temporal_stream, travel_stream
from riskflow.streaming.queries import silver_stream, start_gold, start_router_files, start_silver, start_table

Query = Callable[[SparkSession, str], DataFrame]

# The table's amounts are small, so the high-amount cut-off is lowered to their 90th percentile.
SETTINGS = FeatureSettings(high_amount_threshold=Decimal("110.00"))
HALF_WAY = "2024-01-01 07:30:00"
AMOUNT_CUTS = (0.01, 10, 20, 35, 50, 75, 100, 150, 200)


def plain(frame: DataFrame) -> DataFrame:
    """Portable column types for comparison with other engines."""

    def portable(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, ",")
        return column.alias(field.name)

    return frame.select(*[portable(field) for field in frame.schema])


# --- inputs -------------------------------------------------------------------


def number_of(transaction_id: str = "transaction_id") -> Column:
    return F.substring_index(transaction_id, "_", -1).cast("bigint")


def _with_copies(events: DataFrame) -> DataFrame:
    """Every tenth event twice, to give de-duplication something to do."""
    copies = F.when(F.col("event_id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    return events.select("*", F.explode(copies).alias("copy"))


def _wire_values(events: DataFrame) -> DataFrame:
    return transactions_from_events(events).select(canonical_value().alias("value"))


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions with ``is_fraud`` from the labels table, NULL where there is no label."""
    labels = read_table(spark, folder, "labels").select(
        F.concat(F.lit("txn_"), F.col("doc_id").cast("string")).alias("transaction_id"),
        (F.col("toxic") == 1).alias("is_fraud"),
    )
    return read_transactions(spark, folder).join(labels, "transaction_id", "left")


def _damaged_records(spark: SparkSession, folder: str) -> DataFrame:
    return _damaged(read_transactions(spark, folder))


def _damaged(events: DataFrame) -> DataFrame:
    """Raw records of all events; ten of every sixteen are damaged, each in its own way."""
    turn = F.pmod(number_of(), F.lit(16))
    case = F.get(F.array(*[F.lit(name) for name in FAULT_CASES]), turn.cast("int"))
    value = (
        F.when(turn == 7, F.lit("[1, 2]").cast("binary"))
        .when(turn == 8, F.concat(F.col("value"), F.lit(" trailing").cast("binary")))
        .when(turn == 9, F.unhex(F.lit("C328")))
        .when(turn != 6, F.col("value"))
    )
    damaged = with_faults(events, case)
    return damaged.select(
        F.col("account_id").cast("binary").alias("key"),
        value.alias("value"),
        F.lit("transactions.raw").alias("topic"),
        F.pmod(number_of(), F.lit(4)).cast("int").alias("partition"),
        number_of().alias("offset"),
        F.col("event_timestamp").alias("timestamp"),
    )


# --- the implemented feature path ----------------------------------------------


def q_parse_events(spark, folder):
    return parse_events(_wire_values(read_table(spark, folder, "events")))


def q_prepare_events(spark, folder):
    return prepare_events(_wire_values(_with_copies(read_table(spark, folder, "events"))))


def q_dedup(spark, folder):
    doubled = transactions_from_events(_with_copies(read_table(spark, folder, "events")))
    return deduplicate(doubled).select("transaction_id", "account_id", "event_timestamp", "amount")


def q_canonical_json(spark, folder):
    records = keyed_records(read_transactions(spark, folder))
    return records.select(F.col("key").cast("string").alias("record_key"), F.col("value").cast("string").alias("value"))


def q_high_amount(spark, folder):
    flagged = with_transaction_signals(read_transactions(spark, folder), SETTINGS)
    return flagged.select("transaction_id", "amount", "is_high_amount")


def q_window(label: str, size: str) -> Query:
    return lambda spark, folder: window_features(
        read_transactions(spark, folder), label, size, SETTINGS
    )


def q_account_window_features(spark, folder):
    return account_window_features(read_transactions(spark, folder), SETTINGS)


def q_signal(name: str) -> Query:
    def query(spark, folder):
        features = account_window_features(read_transactions(spark, folder), SETTINGS)
        return features.groupBy("account_id", "window_size").agg(
            F.count(F.lit(1)).alias("windows"), F.count_if(F.col(name)).alias("raised")
        )

    return query


def q_haversine(spark, folder):
    """Distance of every transaction from the home city of its country."""
    events = read_transactions(spark, folder)

    def home(axis: int) -> Column:
        places = F.create_map(*[F.lit(x) for code in COUNTRIES for x in (code, HOME[code][axis])])
        return F.element_at(places, F.col("country"))

    km = haversine_km(F.col("latitude"), F.col("longitude"), home(1), home(2))
    return events.select("transaction_id", F.round(km, 3).alias("distance_km"))


def q_location_grid(spark, folder):
    cell = grid_cell(F.col("latitude"), F.col("longitude"), SETTINGS.location_grid_decimals)
    return read_transactions(spark, folder).groupBy(cell.alias("cell")).agg(
        F.count(F.lit(1)).alias("txn_count")
    )


def q_silver(spark, folder):
    return lake.silver_transactions(read_transactions(spark, folder))


def q_gold(spark, folder):
    return lake.gold_account_features(q_account_window_features(spark, folder))


def _lake_paths(spark: SparkSession) -> tuple[str, str, str]:
    base = shared_folder(spark, "lake")
    return f"{base}/silver", f"{base}/gold", f"{base}/dlq"


def q_lake_round_trip(spark, folder):
    """Raw records written as a lake; Gold read back from its files."""
    silver, gold, dlq = _lake_paths(spark)
    build_lake(spark, _damaged_records(spark, folder), silver, gold, dlq, SETTINGS)
    return spark.read.parquet(gold)


def q_lake_summary(spark, folder):
    silver, gold, dlq = _lake_paths(spark)
    build_lake(spark, _damaged_records(spark, folder), silver, gold, dlq, SETTINGS)
    return lake.lake_summary(spark, silver, gold, require_gold=True)


# --- validation and routing ------------------------------------------------------


def q_validate_events(spark, folder):
    checked = validate_events(_damaged_records(spark, folder))
    return checked.select("offset", "is_valid", "error_type", "payload_version", "event.event_timestamp", "event.amount")


def q_valid_events(spark, folder):
    return valid_events(validate_events(_damaged_records(spark, folder)))


def q_error_counts(spark, folder):
    checked = validate_events(_damaged_records(spark, folder))
    return checked.groupBy(F.coalesce("error_type", F.lit("VALID")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("records")
    )


def q_dead_letters(spark, folder):
    letters = dead_letters(validate_events(_damaged_records(spark, folder)))
    return letters.drop("failed_at", "original_payload")


def q_route_topics(spark, folder):
    routed = route(_damaged_records(spark, folder))
    return routed.groupBy("topic", F.col("key").cast("string").alias("record_key")).agg(
        F.count(F.lit(1)).alias("records")
    )


ENVELOPE_TEXTS = ("error_type", "original_topic", "original_partition", "original_offset", "original_key")


def _routed_content(routed: DataFrame) -> DataFrame:
    """What was routed where: the canonical JSON, or the envelope without times and payload."""
    value = F.col("value").cast("string")
    letter = F.concat_ws("|", *[F.get_json_object(value, f"$.{name}") for name in ENVELOPE_TEXTS])
    return routed.select(
        F.col("topic").cast("string").alias("topic"),
        F.col("key").cast("string").alias("record_key"),
        F.when(F.col("topic") == "transactions.dlq", letter).otherwise(value).alias("content"),
    )


def q_routed_values(spark, folder):
    return _routed_content(route(_damaged_records(spark, folder)))


def q_validate_texts(spark, folder):
    """The validator over every whole text of the other tables: nothing there is a transaction."""
    texts = None
    for table, column in (
        ("documents", "text"),
        ("pages", "html"),
        ("conversations", "text"),
        ("benchmark", "text"),
        ("events", "props"),
    ):
        part = read_table(spark, folder, table).select(
            F.lit(table).alias("topic"),
            F.col(column).cast("binary").alias("value"),
        )
        texts = part if texts is None else texts.unionByName(part)
    return validate_events(texts).groupBy("topic", "error_type").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(F.length(F.col("value").cast("string"))).alias("characters"),
    )



def q_peek(spark, folder):
    shown = peek_records(_damaged_records(spark, folder), 20)
    return shown.select("key", "offset", "problem")


# --- synthetic source --------------------------------------------------------------




# --- streaming ----------------------------------------------------------------------


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = read_table(spark, folder, "events").schema
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    )


def _state_partitions(spark: SparkSession) -> int:
    """One state partition per core of the cluster."""
    return spark.sparkContext.defaultParallelism


def _stream_silver_table(spark: SparkSession, folder: str) -> str:
    base = shared_folder(spark, "stream-silver")
    values = _wire_values(_with_copies(_event_stream(spark, folder)))
    query = start_silver(
        prepare_events(values), f"{base}/table", f"{base}/checkpoint", None, _state_partitions(spark)
    )
    query.awaitTermination()
    return f"{base}/table"


def q_stream_silver(spark, folder):
    return spark.read.parquet(_stream_silver_table(spark, folder))


def q_stream_gold(spark, folder):
    """Gold straight from the value stream: only windows the watermark has closed."""
    base = shared_folder(spark, "stream-gold")
    values = _wire_values(_with_copies(_event_stream(spark, folder)))
    features = account_window_features(prepare_events(values), SETTINGS)
    start_gold(
        features, f"{base}/table", f"{base}/checkpoint", None, _state_partitions(spark)
    ).awaitTermination()
    return spark.read.parquet(f"{base}/table")


def q_stream_gold_from_silver(spark, folder):
    """Gold from the Silver table as a stream, so ids are remembered once, not per branch."""
    silver = _stream_silver_table(spark, folder)
    base = shared_folder(spark, "stream-gold")
    features = account_window_features(silver_stream(spark, silver, "10 minutes"), SETTINGS)
    start_gold(
        features, f"{base}/table", f"{base}/checkpoint", None, _state_partitions(spark)
    ).awaitTermination()
    return spark.read.parquet(f"{base}/table")


def q_stream_router(spark, folder):
    base = shared_folder(spark, "stream-router")
    events = _event_stream(spark, folder)
    records = raw_records(transactions_from_events(events), F.lit(0))
    start_router_files(records, f"{base}/table", f"{base}/checkpoint", trigger_seconds=None).awaitTermination()
    routed = spark.read.parquet(f"{base}/table")
    return routed.groupBy(F.col("topic").cast("string").alias("topic")).agg(F.count(F.lit(1)).alias("records"))


def q_stream_routed_values(spark, folder):
    """Damaged records through the router as a stream, read back from both topics' files."""
    base = shared_folder(spark, "stream-router")
    records = _damaged(transactions_from_events(_event_stream(spark, folder)))
    start_router_files(records, f"{base}/table", f"{base}/checkpoint", trigger_seconds=None).awaitTermination()
    return _routed_content(spark.read.parquet(f"{base}/table"))


def _keyed(spark: SparkSession, folder: str, rows: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A keyed-state stream over all events, read back from its table."""
    base = shared_folder(spark, "stream-keyed")
    events = with_event_time(transactions_from_events(_event_stream(spark, folder)))
    start_keyed(rows(events), "keyed", f"{base}/table", f"{base}/checkpoint", None, _state_partitions(spark)).awaitTermination()
    return spark.read.parquet(f"{base}/table")


def q_sessions(spark, folder):
    return account_sessions(read_transactions(spark, folder), "2 minutes")


def q_sliding(spark, folder):
    return sliding_windows(read_transactions(spark, folder))


def q_stream_sessions(spark, folder):
    return _keyed(spark, folder, lambda events: account_sessions(events, "2 minutes"))


def q_stream_sliding(spark, folder):
    return _keyed(spark, folder, sliding_windows)


def q_stream_travel(spark, folder):
    return _keyed(spark, folder, lambda events: travel_stream(events, min_km=25.0))


def q_stream_pairs(spark, folder):
    return pairs_by_transaction(_keyed(spark, folder, pair_state))


def q_stream_temporal(spark, folder):
    return _keyed(spark, folder, lambda events: temporal_stream(events, unusual_share=0.06))


# --- behaviour features -----------------------------------------------------------


def q_velocity_24h(spark, folder):
    return account_window_features(read_transactions(spark, folder), SETTINGS, DAY_WINDOW)


def q_rolling_velocity(spark, folder):
    return B.rolling_velocity(read_transactions(spark, folder))


def half_up(value: Column, digits: int) -> Column:
    """Half-up rounding by plain floating-point steps, which any engine repeats exactly."""
    scale = F.lit(10.0**digits)
    return F.floor(value * scale + 0.5) / scale


def _rounded(frame: DataFrame, digits: int, *names: str) -> DataFrame:
    return frame.withColumns({name: half_up(F.col(name), digits) for name in names})


def q_amount_deviation(spark, folder):
    return _rounded(
        B.amount_deviation(read_transactions(spark, folder)), 4,
        "account_mean_amount_30d", "account_std_amount_30d", "amount_zscore", "amount_vs_recent_average",
    )


def _travel(events: DataFrame) -> DataFrame:
    """The table's places lie within 80 km, so the distance limit is lowered."""
    return B.travel(events, min_km=25.0)


def q_amount_percentile(spark, folder):
    found = amount_order(read_transactions(spark, folder))
    return _rounded(found, 8, "amount_percentile").select("transaction_id", "prior_amount_count", "amount_percentile")


def q_rolling_median(spark, folder):
    """Over two hours, so that windows of the table's fifteen hours move."""
    found = amount_order(read_transactions(spark, folder), "2 hours")
    return _rounded(found, 6, "amount_vs_median").select(
        "transaction_id", "prior_amount_count", "rolling_median", "amount_vs_median"
    )


def q_travel(spark, folder):
    return _travel(read_transactions(spark, folder))


def q_countries(spark, folder):
    return B.countries_seen(read_transactions(spark, folder), "30 minutes")


def q_new_pairs(spark, folder):
    return B.new_pairs(read_transactions(spark, folder))


def q_device_activity(spark, folder):
    return B.device_activity(read_transactions(spark, folder))


def q_merchant_history(spark, folder):
    return _rounded(B.merchant_history(_labelled(spark, folder)), 6, "merchant_avg_amount", "merchant_fraud_rate")


def q_category_risk(spark, folder):
    return _rounded(B.category_risk(_labelled(spark, folder)), 6, "merchant_category_risk")


def q_temporal(spark, folder):
    return B.temporal(read_transactions(spark, folder), unusual_share=0.06)


def _decided(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """All features, rules, score and decision; the model is a fixed curve of the z-score.

    Events are read and derived once and the decided rows are written once, with those ``columns`` that
    the report reads (all without): each report on them reads a table.
    """
    events = stored_table(with_transaction_signals(_labelled(spark, folder), SETTINGS), "events")
    history = B.account_history(events, {"5m": "5 minutes"}, countries="30 minutes", min_km=25.0)
    features = B.with_features(
        events,
        [
            _rounded(history, 4, "amount_zscore").select(
                "transaction_id", "txn_count_5m", "amount_zscore", "country_count", "impossible_travel"
            ),
            B.new_pairs(events).select("transaction_id", "new_device_for_account"),
            B.device_usage(events).select("transaction_id", "device_account_count"),
            B.merchant_history(events).select("transaction_id", "merchant_fraud_rate"),
        ],
    )
    curve = half_up(1 / (1 + F.exp(-F.coalesce("amount_zscore", F.lit(0.0)))), 6)
    scored = rules.apply_rules(features).withColumn("model_probability", curve)
    score = half_up(rules.risk_score(F.col("model_probability"), F.col("rule_risk_total")), 6)
    decided = rules.decide(scored.withColumn("risk_score", score))
    return stored_table(decided.select(*columns) if columns else decided, "decided")


def q_rule_hits(spark, folder):
    hits = _decided(spark, folder, "transaction_id", "rule_hits").select("transaction_id", F.explode("rule_hits").alias("hit"))
    return hits.groupBy("hit.reason_code", "hit.severity").agg(
        F.count(F.lit(1)).alias("hits"), F.sum("hit.risk_delta").alias("risk_total")
    )


def q_risk_decision(spark, folder):
    return _decided(
        spark, folder, "transaction_id", "rule_risk_total", "model_probability", "risk_score", "decision", "reason_codes"
    )


def q_alerts(spark, folder):
    decided = _decided(spark, folder, "transaction_id", "account_id", "event_timestamp", "risk_score", "decision")
    return rules.alerts(decided, min_risk=0.6, start=HALF_WAY)


def q_score_by_channel(spark, folder):
    return _rounded(marts.score_by_channel(_decided(spark, folder, "channel", "risk_score", "decision")), 6, "avg_risk_score")


def q_account_risk(spark, folder):
    return _rounded(marts.account_risk_summary(_decided(spark, folder, "account_id", "event_timestamp", "risk_score", "decision")), 6, "avg_risk_score")


def q_false_positive_trend(spark, folder):
    return _rounded(marts.false_positive_trend(_decided(spark, folder, "event_timestamp", "is_fraud", "decision")), 6, "false_positive_rate")


def q_threshold_metrics(spark, folder):
    metrics = evaluate.threshold_metrics(_decided(spark, folder, "risk_score", "is_fraud"))
    return _rounded(metrics, 6, "precision", "recall", "f1", "false_positive_rate", "false_negative_rate")


def q_best_threshold(spark, folder):
    best = evaluate.best_threshold(evaluate.threshold_metrics(_decided(spark, folder, "risk_score", "is_fraud")))
    return best.select("threshold", "expected_cost")


def q_curve_areas(spark, folder):
    return _rounded(evaluate.curve_areas(_decided(spark, folder, "risk_score", "is_fraud")), 6, "roc_auc", "pr_auc")


def _model_scores(kind: str) -> Query:
    """Train on the earlier half of the labelled rows, score every row."""
    names = ["txn_count_5m", "amount_vs_recent_average", "seconds_since_previous_txn"]

    def query(spark, folder):
        # Read by three features and the table itself, so the labels are joined once.
        used = ["transaction_id", "account_id", "event_timestamp", "amount", "latitude", "longitude", "country", "is_fraud"]
        events = stored_table(_labelled(spark, folder).select(*used), "model-events")
        table = B.with_features(
            events.select("transaction_id", "event_timestamp", "is_fraud"),
            [
                B.rolling_velocity(events).select("transaction_id", names[0]),
                B.amount_deviation(events).select("transaction_id", names[1]),
                B.travel(events).select("transaction_id", names[2]),
            ],
        )
        folder_out = shared_folder(spark, "model-input")
        table.write.parquet(folder_out)
        stored = spark.read.parquet(folder_out)
        # Labels only cover the first events of the table; learn from the earlier half of them.
        at = F.unix_micros("event_timestamp")
        known = stored.where(F.col("is_fraud").isNotNull())
        cutoff = known.agg(F.percentile_approx(at, 0.5)).first()[0]
        early = stored.where(at < cutoff)
        model = models.train(early, names, kind)
        scored = models.score(model, stored, names)
        columns = ["transaction_id", "is_fraud", "fraud_probability"]
        if kind == "logistic":
            scored = scored.withColumn("formula_probability", models.logistic_probability(model, names))
            columns.append("formula_probability")
        return scored.select(*columns)

    return query


def q_model_summary(kind: str) -> Query:
    """What holds for a model's scores: every row once, labels kept, probabilities in range.

    A logistic model's are also what its weights say: ``by_formula`` counts the rows whose probability, written
    out from the fitted weights and medians, is the model's own.
    """

    def query(spark, folder):
        checks = []
        if kind == "logistic":
            apart = F.abs(F.col("fraud_probability") - F.col("formula_probability"))
            checks.append(F.count_if(apart < 1e-9).alias("by_formula"))
        return _model_scores(kind)(spark, folder).agg(
            *checks,
            F.count(F.lit(1)).alias("rows_scored"),
            F.count_distinct("transaction_id").alias("ids"),
            F.count("is_fraud").alias("labelled"),
            F.count_if("is_fraud").alias("frauds"),
            F.count_if(F.col("fraud_probability").between(0, 1)).alias("in_range"),
        )

    return query


# --- quality, drift, marts, replay, merge ----------------------------------------------


def q_quality_report(spark, folder):
    doubled = transactions_from_events(_with_copies(read_table(spark, folder, "events")))
    return quality.quality_report(doubled, F.lit("2024-01-01 14:00:00").cast("timestamp"))


def q_pipeline_report(spark, folder):
    checked = validate_events(_damaged_records(spark, folder))
    report = quality.pipeline_report(checked, _decided(spark, folder), max_dlq_ratio=0.5)
    return _rounded(report, 6, "measured")


def _halves(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    events = read_transactions(spark, folder)
    cut = F.lit(HALF_WAY).cast("timestamp")
    return events.where(F.col("event_timestamp") < cut), events.where(F.col("event_timestamp") >= cut)


def q_psi(spark, folder):
    old, new = _halves(spark, folder)
    amount = quality.population_stability(old, new, quality.amount_bin(AMOUNT_CUTS), "amount")
    category = quality.population_stability(old, new, F.col("merchant_category"), "merchant_category")
    country = quality.population_stability(old, new, F.col("country"), "country")
    return _rounded(amount.unionByName(category).unionByName(country), 8, "psi")


def q_ks(spark, folder):
    old, new = _halves(spark, folder)
    return _rounded(quality.kolmogorov_smirnov(old, new, "amount"), 8, "ks")


def q_daily_merchants(spark, folder):
    return marts.daily_merchant_summary(read_transactions(spark, folder))


def q_daily_volume(spark, folder):
    return marts.daily_volume(read_transactions(spark, folder))


def q_fraud_rate(column: str) -> Query:
    return lambda spark, folder: _rounded(
        marts.fraud_rate_by(_labelled(spark, folder), column), 6, "fraud_rate"
    )


def q_replay(spark, folder):
    """Bronze written and read back for a time range and one account, then refined again."""
    base = shared_folder(spark, "bronze")
    lake.write_bronze(_damaged_records(spark, folder), base)
    records = lake.replay(spark, base, "2024-01-01 03:00:00", "2024-01-01 09:00:00", "acct_1005")
    return refine(records, SETTINGS).gold


def q_upsert(spark, folder):
    events = read_transactions(spark, folder).select(
        "transaction_id", "account_id", "amount", F.col("event_timestamp").alias("processed_at")
    )
    existing = events.where(number_of() % 3 != 0)
    updates = events.where((number_of() % 2 == 0) | (number_of() % 3 == 0)).withColumns(
        {
            "amount": (F.col("amount") + 1).cast("decimal(12,2)"),
            "processed_at": F.col("processed_at") + F.expr("interval 1 hour"),
        }
    )
    return upsert(existing, updates.unionByName(updates))


def _changes(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """A dated table, and late changes: new amounts, some rows moved to the next day, and new rows, each twice."""
    columns = ["transaction_id", "account_id", "amount", F.col("event_timestamp").alias("processed_at")]
    events = read_transactions(spark, folder).select(*columns, F.to_date("event_timestamp").alias("event_date"))
    spread = F.date_add("event_date", F.pmod(number_of(), F.lit(20)).cast("int"))
    events = events.withColumn("event_date", spread)
    late = (number_of() % 20 == 7) & (number_of() % 3 != 2)
    moved = F.when(number_of() % 3 == 0, F.date_add("event_date", 1)).otherwise(F.col("event_date"))
    changes = events.where(late).withColumns(
        {
            "amount": (F.col("amount") + 1).cast("decimal(12,2)"),
            "processed_at": F.col("processed_at") + F.expr("interval 1 hour"),
            "event_date": moved,
        }
    )
    return events.where(~((number_of() % 20 == 7) & (number_of() % 3 == 1))), changes.unionByName(changes)


def q_merge(spark, folder):
    """Late changes merged twice into a table of twenty dates, two of them touched."""
    existing, changes = _changes(spark, folder)
    path = shared_folder(spark, "merged-table")
    lake.write_table(existing, path, ("event_date",))
    for _ in range(2):
        merge_into(spark, path, changes, ["event_date"])
    return spark.read.parquet(path)


def q_stream_alerts(spark, folder):
    """Alerts of decided rows, upserted by date from a stream that brings every row twice."""
    base = shared_folder(spark, "alerts")
    decided = _decided(spark, folder).withColumn("processed_at", F.col("event_timestamp"))
    for _ in range(2):
        decided.write.mode("append").parquet(f"{base}/in")
    stream = spark.readStream.schema(decided.schema).option("maxFilesPerTrigger", 64).parquet(f"{base}/in")
    columns = ["transaction_id", "account_id", "event_timestamp", "risk_score", "decision", "processed_at"]

    def found(rows: DataFrame) -> DataFrame:
        alerts = rules.alerts(rows, min_risk=0.6, start=HALF_WAY).select(*columns)
        return alerts.withColumn("alert_date", F.to_date("event_timestamp"))

    start_merge(stream, f"{base}/table", f"{base}/checkpoint", ["alert_date"], "alerts", trigger_seconds=None, prepare=found).awaitTermination()
    return spark.read.parquet(f"{base}/table").select(*columns[:5])


# --- sketches, history, anomalies ----------------------------------------------------------


def q_distinct_sketches(spark, folder):
    """Five-minute sketches, stored and united per account and day, against exact counts."""
    events = read_transactions(spark, folder)
    values = {"merchants": "merchant_id", "devices": "device_id", "transactions": "transaction_id"}
    stored = stored_table(distinct_sketches(events, values), "sketches")
    by = ["account_id", F.to_date("window_start").alias("day")]
    united = united_distincts(stored, list(values), by)
    exact = events.groupBy("account_id", F.to_date("event_timestamp").alias("day")).agg(
        *[F.count_distinct(column).alias(f"exact_{name}") for name, column in values.items()]
    )
    close = [F.abs(F.col(n) - F.col(f"exact_{n}")) <= F.ceil(F.col(f"exact_{n}") * F.lit(distinct_error())) for n in values]
    joined = exact.join(united, ["account_id", "day"], "left")
    return joined.select("account_id", "day", *[f"exact_{n}" for n in values], *[F.coalesce(c, F.lit(False)).alias(f"{n}_close") for c, n in zip(close, values)])


def q_psi_sketches(spark, folder):
    """Hourly sketches of the amounts, united into two halves, against bins at exact quantiles."""
    events = read_transactions(spark, folder)
    cents = (F.col("amount") * 100).cast("bigint")
    sketches = stored_table(quantile_sketches(events, {"amount": cents}, F.date_trunc("hour", "event_timestamp")), "quantiles")
    half = F.lit("2024-01-01 07:00:00").cast("timestamp")
    found = sketched_stability(sketches, F.col("period") < half, F.col("period") >= half)
    cents_old = events.where(F.col("event_timestamp") < half).select(cents.alias("cents"))
    cents_new = events.where(F.col("event_timestamp") >= half).select(cents.alias("cents"))
    cuts = cents_old.agg(F.percentile_approx("cents", [i / 10 for i in range(1, 10)], 1_000_000)).first()[0]
    bin_of = sum((F.coalesce(F.col("cents") > cut, F.lit(False)).cast("int") for cut in sorted(set(cuts))), F.lit(0))
    exact = quality.population_stability(cents_old.where("cents is not null"), cents_new.where("cents is not null"), bin_of, "amount")
    both = exact.withColumnRenamed("psi", "exact_psi").join(found.select("feature", "psi"), "feature")
    return both.select("feature", "bins", half_up(F.col("exact_psi"), 8).alias("exact_psi"), (F.abs(F.col("psi") - F.col("exact_psi")) < 0.02).alias("close"))


def _observed(spark: SparkSession, query: StreamingQuery, listener: ProgressHistory) -> DataFrame:
    query.awaitTermination()
    listener.wait_for(query.runId)
    spark.streams.removeListener(listener)
    return history(spark, listener.path).where(F.col("query_id") == query.id)


def q_stream_dead_letter_rate(spark, folder):
    """The router's own count of dead letters, from the history of its progress."""
    base = shared_folder(spark, "observed")
    listener = ProgressHistory(spark, f"{base}/history")
    spark.streams.addListener(listener)
    routed = observed_routing(route(_damaged(transactions_from_events(_event_stream(spark, folder)))))
    query = start_table(routed, "routing", f"{base}/table", f"{base}/checkpoint", None)
    return _rounded(dead_letter_rate(_observed(spark, query, listener)), 8, "dead_letter_rate").drop("query_name")


def q_stream_duplicate_rate(spark, folder):
    base = shared_folder(spark, "observed")
    listener = ProgressHistory(spark, f"{base}/history")
    spark.streams.addListener(listener)
    doubled = with_event_time(transactions_from_events(_with_copies(_event_stream(spark, folder))))
    kept = observed_rows(deduplicate(observed_rows(doubled, "arrived")), "kept")
    query = start_table(kept, "kept", f"{base}/table", f"{base}/checkpoint", None, _state_partitions(spark))
    return _rounded(duplicate_rate(_observed(spark, query, listener)), 8, "duplicate_rate").drop("query_name")


def q_isolation_forest(spark, folder):
    """All rows scored by a forest over amount and velocity."""
    events = read_transactions(spark, folder)
    names = ["amount", "txn_count_5m", "seconds_since_previous_txn"]
    table = B.with_features(
        events.select("transaction_id", F.col("amount").cast("double").alias("amount")),
        [B.rolling_velocity(events, {"5m": "5 minutes"}).select("transaction_id", names[1]), B.travel(events).select("transaction_id", names[2])],
    )
    stored = stored_table(table, "forest-input")
    return forest.score_forest(forest.fit_forest(stored, names), stored).select("transaction_id", "amount", "anomaly_score")


def q_isolation_forest_summary(spark, folder):
    """What holds for any forest: every row once, scores in range, the largest amounts stand out."""
    scored = stored_table(q_isolation_forest(spark, folder), "forest-scores")
    top = scored.agg(F.max("amount").alias("most"), F.avg("anomaly_score").alias("mean"))
    return scored.join(F.broadcast(top), F.col("amount") == F.col("most"), "left").agg(
        F.count(F.lit(1)).alias("rows_scored"),
        F.count_if(F.col("anomaly_score").between(0, 1)).alias("in_range"),
        F.coalesce(F.min(F.col("anomaly_score") > F.col("mean")), F.lit(False)).alias("largest_stands_out"),
    )


QUERIES: dict[str, Query] = {
    "parse_events": q_parse_events,
    "prepare_events": q_prepare_events,
    "dedup_transactions": q_dedup,
    "canonical_json": q_canonical_json,
    "high_amount_flag": q_high_amount,
    "window_features_5m": q_window("5m", "5 minutes"),
    "window_features_30m": q_window("30m", "30 minutes"),
    "account_window_features": q_account_window_features,
    "multi_device_signal": q_signal("multi_device_signal"),
    "rapid_transaction_signal": q_signal("rapid_transaction_signal"),
    "rapid_location_change_signal": q_signal("rapid_location_change_signal"),
    "haversine_distance": q_haversine,
    "location_grid": q_location_grid,
    "silver_transactions": q_silver,
    "gold_account_features": q_gold,
    "lake_round_trip": q_lake_round_trip,
    "lake_summary": q_lake_summary,
    "validate_events": q_validate_events,
    "valid_events": q_valid_events,
    "validation_error_counts": q_error_counts,
    "dead_letter_envelope": q_dead_letters,
    "route_topics": q_route_topics,
    "routed_values": q_routed_values,
    "validate_texts": q_validate_texts,
    "peek_records": q_peek,
    "stream_silver": q_stream_silver,
    "stream_gold": q_stream_gold,
    "stream_gold_from_silver": q_stream_gold_from_silver,
    "stream_router": q_stream_router,
    "stream_routed_values": q_stream_routed_values,
    "account_sessions": q_sessions,
    "sliding_windows": q_sliding,
    "stream_sessions": q_stream_sessions,
    "stream_sliding_windows": q_stream_sliding,
    "stream_previous": q_stream_travel,
    "stream_new_pairs": q_stream_pairs,
    "stream_temporal": q_stream_temporal,
    "velocity_24h": q_velocity_24h,
    "rolling_velocity": q_rolling_velocity,
    "amount_deviation": q_amount_deviation,
    "amount_percentile": q_amount_percentile,
    "rolling_median": q_rolling_median,
    "impossible_travel": q_travel,
    "countries_seen": q_countries,
    "new_device_merchant": q_new_pairs,
    "device_activity": q_device_activity,
    "merchant_history": q_merchant_history,
    "merchant_category_risk": q_category_risk,
    "temporal_features": q_temporal,
    "rule_hits": q_rule_hits,
    "risk_decision": q_risk_decision,
    "alerts": q_alerts,
    "score_by_channel": q_score_by_channel,
    "account_risk_summary": q_account_risk,
    "false_positive_trend": q_false_positive_trend,
    "threshold_metrics": q_threshold_metrics,
    "best_threshold": q_best_threshold,
    "curve_areas": q_curve_areas,
    "model_logistic": _model_scores("logistic"),
    "model_boosted_trees": _model_scores("boosted_trees"),
    "model_logistic_summary": q_model_summary("logistic"),
    "model_boosted_trees_summary": q_model_summary("boosted_trees"),
    "quality_report": q_quality_report,
    "pipeline_report": q_pipeline_report,
    "psi_drift": q_psi,
    "ks_drift": q_ks,
    "daily_merchant_summary": q_daily_merchants,
    "daily_volume": q_daily_volume,
    "fraud_rate_by_category": q_fraud_rate("merchant_category"),
    "fraud_rate_by_country": q_fraud_rate("country"),
    "replay_slice": q_replay,
    "upsert_transactions": q_upsert,
    "distinct_sketches": q_distinct_sketches,
    "psi_sketches": q_psi_sketches,
    "stream_dead_letter_rate": q_stream_dead_letter_rate,
    "stream_duplicate_rate": q_stream_duplicate_rate,
    "isolation_forest": q_isolation_forest,
    "isolation_forest_summary": q_isolation_forest_summary,
    "merge_partitions": q_merge,
    "stream_alerts": q_stream_alerts,
}


def catalog() -> dict[str, Query]:
    """All queries, in a UTC session and with portable result types."""

    def portable(query: Query) -> Query:
        return lambda spark, folder: plain(query(configure(spark), folder))

    return {name: portable(query) for name, query in QUERIES.items()}
