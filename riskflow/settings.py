"""Frozen settings objects; defaults are the documented ones, env vars override.

A blank feature, lake or trigger variable means "use the default". A blank
message-log variable is taken as given.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from decimal import Decimal


def _text(name: str, default: str) -> str:
    given = os.environ.get(name, "")
    return given if given.strip() else default


def _flag(name: str) -> bool:
    return os.environ.get(name, "").strip().lower() in ("1", "true", "yes", "on")


@dataclass(frozen=True)
class FeatureSettings:
    """Thresholds behind the per-transaction and per-window signals."""

    high_amount_threshold: Decimal = Decimal("5000.00")
    rapid_txn_count_threshold: int = 5
    multi_device_threshold: int = 2
    location_spread_km_threshold: float = 25.0
    location_grid_decimals: int = 3

    @classmethod
    def from_env(cls) -> FeatureSettings:
        base = cls()
        return cls(
            **{
                name: type(default)(_text(name.upper(), str(default)))
                for name, default in vars(base).items()
            }
        )


@dataclass(frozen=True)
class LakeSettings:
    """Silver and Gold locations with one checkpoint folder per streaming query."""

    root: str = "data"
    silver_path: str = "data/silver/transactions"
    gold_path: str = "data/gold/account_features"
    silver_checkpoint: str = ".checkpoints/silver-transactions"
    gold_checkpoint: str = ".checkpoints/gold-account-features"
    console_checkpoint: str = ".checkpoints/console-features"
    console_sink: bool = False

    @classmethod
    def under(cls, root: str, checkpoints: str) -> LakeSettings:
        """All paths below two folders, for example on one object store."""
        return cls(
            root=root,
            silver_path=f"{root}/silver/transactions",
            gold_path=f"{root}/gold/account_features",
            silver_checkpoint=f"{checkpoints}/silver-transactions",
            gold_checkpoint=f"{checkpoints}/gold-account-features",
            console_checkpoint=f"{checkpoints}/console-features",
        )

    @classmethod
    def from_env(cls) -> LakeSettings:
        base = cls.under(_text("DATA_LAKE_DIR", "data"), ".checkpoints")
        return cls(
            root=base.root,
            silver_path=_text("SILVER_TRANSACTIONS_PATH", base.silver_path),
            gold_path=_text("GOLD_FEATURES_PATH", base.gold_path),
            silver_checkpoint=_text("SILVER_CHECKPOINT_DIR", base.silver_checkpoint),
            gold_checkpoint=_text("GOLD_CHECKPOINT_DIR", base.gold_checkpoint),
            console_checkpoint=_text("SPARK_CHECKPOINT_DIR", base.console_checkpoint),
            console_sink=_flag("SPARK_CONSOLE_SINK"),
        )


@dataclass(frozen=True)
class LogSettings:
    """Message-log endpoint and topic names."""

    bootstrap_servers: str = "localhost:9092"
    raw_topic: str = "transactions.raw"
    validated_topic: str = "transactions.validated"
    dlq_topic: str = "transactions.dlq"
    validator_group: str = "riskflow-validator"

    @classmethod
    def from_env(cls) -> LogSettings:
        return cls(
            **{
                name: os.environ.get(f"KAFKA_{name.upper()}", default)
                for name, default in vars(cls()).items()
            }
        )


@dataclass(frozen=True)
class StreamSettings:
    """Everything one streaming run needs."""

    watermark: str = "10 minutes"
    trigger_seconds: int = 5
    log: LogSettings = field(default_factory=LogSettings)
    lake: LakeSettings = field(default_factory=LakeSettings)
    features: FeatureSettings = field(default_factory=FeatureSettings)

    @classmethod
    def from_env(cls) -> StreamSettings:
        return cls(
            watermark=_text("SPARK_WATERMARK", "10 minutes"),
            trigger_seconds=int(_text("SPARK_TRIGGER_SECONDS", "5")),
            log=LogSettings.from_env(),
            lake=LakeSettings.from_env(),
            features=FeatureSettings.from_env(),
        )
