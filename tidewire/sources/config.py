"""Configuration: YAML file, environment overrides, checks."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from pathlib import Path
from typing import Any

#: Places to look for the file, variables and the settings that they replace, and defaults.
PLACES = ("config.yaml", "config/config.yaml")
ENVIRONMENT = {"MONGODB_URI": "mongodb.uri", "MONGODB_DATABASE": "mongodb.database", "PUBSUB_PROJECT_ID": "pubsub.project_id", "PUBSUB_STATUS_TOPIC": "pubsub.status_topic"}
DEFAULTS: dict[str, Any] = {
    "pubsub.publisher.batch_settings": {"max_messages": 100, "max_bytes": 1048576, "max_latency": 0.1},
    "pubsub.publisher.circuit_breaker": {"failure_threshold": 5, "reset_timeout": 60.0, "half_open_max_calls": 3},
    "pubsub.publisher.backpressure": {"tokens_per_second": 1000, "bucket_size": 2000, "min_tokens_per_second": 100, "max_tokens_per_second": 5000, "error_decrease_factor": 0.8, "success_increase_factor": 1.1, "rate_update_interval": 5.0, "metrics_window_size": 100},
    "retry": {"initial_delay": 1.0, "max_delay": 60.0, "multiplier": 2.0, "max_attempts": 5},
    "health.heartbeat": {"interval": 30},
    "health.readiness": {"timeout": 5, "interval": 30, "failure_threshold": 3},
    "monitoring.logging": {"level": "INFO", "format": "json"},
    "resource": {
        "memory_warning_threshold": 0.7, "memory_critical_threshold": 0.85, "memory_emergency_threshold": 0.95, "cpu_warning_threshold": 0.7, "cpu_critical_threshold": 0.85, "cpu_emergency_threshold": 0.95,
        "monitoring_interval": 5.0, "log_interval": 60.0, "circuit_open_time": 30.0, "tracked_types": [],
    },
}
COLLECTION_DEFAULTS = {"deduplication": {"enabled": False, "memory_ttl": 3600, "memory_max_size": 10000, "persistent_enabled": True, "persistent_ttl": 86400, "cleanup_interval": 3600}, "log_sampling": {"enabled": False, "rate": 0.1, "strategy": "random"}}

#: Bounds. (more than, at most); None is no bound.
POSITIVE = (0, None)
BOUNDS: dict[str, tuple[float | None, float | None]] = {
    "pubsub.publisher.batch_settings.max_messages": (0, 1000), "pubsub.publisher.batch_settings.max_bytes": (0, 10 << 20), "pubsub.publisher.batch_settings.max_latency": (0, 600),
    "pubsub.publisher.circuit_breaker.failure_threshold": POSITIVE, "pubsub.publisher.circuit_breaker.reset_timeout": POSITIVE, "pubsub.publisher.circuit_breaker.half_open_max_calls": POSITIVE,
    "pubsub.publisher.backpressure.tokens_per_second": POSITIVE, "pubsub.publisher.backpressure.bucket_size": POSITIVE, "pubsub.publisher.backpressure.min_tokens_per_second": POSITIVE,
    "pubsub.publisher.backpressure.success_increase_factor": (1, None), "pubsub.publisher.backpressure.rate_update_interval": POSITIVE, "pubsub.publisher.backpressure.metrics_window_size": POSITIVE,
    "retry.initial_delay": POSITIVE, "retry.max_delay": POSITIVE, "retry.multiplier": POSITIVE, "retry.max_attempts": (0, 100),
    "firestore.ttl": (0, 365 * 24 * 3600), "health.heartbeat.interval": (0, 300), "health.readiness.timeout": POSITIVE, "health.readiness.interval": POSITIVE, "health.readiness.failure_threshold": POSITIVE,
    "resource.monitoring_interval": POSITIVE, "resource.log_interval": POSITIVE, "resource.circuit_open_time": POSITIVE,
}
#: Pairs of settings of which the first may not be above the second, or not even reach it.
AT_MOST = (
    ("pubsub.publisher.circuit_breaker.half_open_max_calls", "pubsub.publisher.circuit_breaker.failure_threshold"), ("retry.initial_delay", "retry.max_delay"),
    *((f"resource.{k}_{a}_threshold", f"resource.{k}_{b}_threshold") for k in ("memory", "cpu") for a, b in (("warning", "critical"), ("critical", "emergency"))), ("mongodb.options.min_pool_size", "mongodb.options.max_pool_size"),
)
BELOW = (("pubsub.publisher.backpressure.min_tokens_per_second", "pubsub.publisher.backpressure.max_tokens_per_second"), ("health.readiness.timeout", "health.readiness.interval"))
#: Settings with a choice, and whole numbers among the database's options with their bounds.
CHOICES: dict[str, tuple] = {
    "monitoring.logging.level": ("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL"), "monitoring.logging.format": ("json", "text"),
    "mongodb.options.w": ("majority", *range(1, 6), *map(str, range(1, 6))), "mongodb.options.readPreference": ("primary", "primaryPreferred", "secondary", "secondaryPreferred", "nearest"),
    "mongodb.options.ssl": (True, False), "mongodb.options.ssl_cert_reqs": ("CERT_NONE", "CERT_OPTIONAL", "CERT_REQUIRED"),
}
WHOLE = {"max_pool_size": (0, 1000), "min_pool_size": (-1, None), "connect_timeout_ms": (0, 300_000), "server_selection_timeout_ms": (0, 300_000), "socket_timeout_ms": (0, 300_000)}
STRATEGIES = ("random", "systematic", "reservoir")


def find_file(root: str = ".", environment: dict[str, str] | None = None) -> Path | None:
    env = os.environ if environment is None else environment
    for place in (*(Path(root) / p for p in PLACES), *([Path(env["CONFIG_PATH"])] if env.get("CONFIG_PATH") else [])):
        if place.is_file():
            return place
    return None


def load(path: str | Path, environment: dict[str, str] | None = None) -> dict[str, Any]:
    import yaml

    config = yaml.safe_load(Path(path).read_text()) or {}
    env = os.environ if environment is None else environment
    for variable, setting in ENVIRONMENT.items():
        if env.get(variable):
            at = config
            *parents, last = setting.split(".")
            for p in parents:
                at = at.setdefault(p, {})
            at[last] = env[variable]
    return config


def setting(config: dict[str, Any], path: str) -> Any:
    """The value at a dotted path, else its default; None if there is neither."""
    at: Any = config
    for p in path.split("."):
        at = at.get(p) if isinstance(at, dict) else None
    if at is None:
        parent, _, last = path.rpartition(".")
        return DEFAULTS.get(parent, {}).get(last)
    return at


def is_number(value: Any) -> bool:
    return isinstance(value, int | float) and not isinstance(value, bool)


def outside(name: str, value: Any, bounds: tuple[float | None, float | None]) -> Iterator[str]:
    low, high = bounds
    if value is None:
        return
    if not is_number(value):
        yield f"{name} is no number"
    elif low is not None and value <= low:
        yield f"{name} must be more than {low}"
    elif high is not None and value > high:
        yield f"{name} must be at most {high}"


def of_collection(c: dict[str, Any]) -> Iterator[str]:
    name = c.get("name")
    for k in ("name", "topic"):
        if not c.get(k):
            yield f"a collection has no {k}"
    if name and not re.fullmatch(r"[\w-]+", name):
        yield f"collection {name!r} has characters that names don't have"
    if c.get("topic") and not is_topic(c["topic"]):
        yield f"{name}: {c['topic']!r} is no topic"
    w = c.get("watch_filter")
    if w is not None and not (isinstance(w, list) and all(isinstance(x, dict) for x in w)):
        yield f"{name}: watch_filter is no list of dictionaries"
    dedup = COLLECTION_DEFAULTS["deduplication"] | (c.get("deduplication") or {})
    if dedup["enabled"]:
        yield from outside(f"{name}: memory_ttl", dedup["memory_ttl"], POSITIVE)
        yield from outside(f"{name}: memory_max_size", dedup["memory_max_size"], (0, 1_000_000))
        if dedup["persistent_enabled"]:
            yield from outside(f"{name}: persistent_ttl", dedup["persistent_ttl"], POSITIVE)
            yield from outside(f"{name}: cleanup_interval", dedup["cleanup_interval"], (0, dedup["persistent_ttl"]))
    sampling = COLLECTION_DEFAULTS["log_sampling"] | (c.get("log_sampling") or {})
    if sampling["enabled"]:
        yield from outside(f"{name}: sampling rate", sampling["rate"], (0, 1))
        if sampling["strategy"] not in STRATEGIES:
            yield f"{name}: no sampling strategy {sampling['strategy']!r}"


def is_topic(name: str) -> bool:
    return name.replace("-", "").isalnum()


def found_problems(config: dict[str, Any]) -> Iterator[str]:
    mongodb = config.get("mongodb") or {}
    for s in ("mongodb.uri", "mongodb.database", "pubsub.project_id"):
        if not setting(config, s):
            yield f"{s} is missing"
    if mongodb.get("uri") and not mongodb["uri"].startswith(("mongodb://", "mongodb+srv://")):
        yield "mongodb.uri must start with mongodb:// or mongodb+srv://"
    if mongodb.get("database") and not re.fullmatch(r"[\w-]+", mongodb["database"]):
        yield "mongodb.database has characters that names don't have"
    for s in ("pubsub.project_id", "pubsub.status_topic"):
        if (v := setting(config, s)) and not is_topic(v):
            yield f"{s}: {v!r} is no such name"
    collections = mongodb.get("collections") or []
    if not collections:
        yield "mongodb.collections is empty"
    for c in collections:
        yield from of_collection(c)
    for s, bounds in BOUNDS.items():
        yield from outside(s, setting(config, s), bounds)
    if (f := setting(config, "pubsub.publisher.backpressure.error_decrease_factor")) is not None and not 0 < f < 1:
        yield "pubsub.publisher.backpressure.error_decrease_factor must be between 0 and 1"
    for s, choice in CHOICES.items():
        v = setting(config, s)
        if v is not None and not any(v == x and isinstance(v, bool) == isinstance(x, bool) for x in choice):
            yield f"{s}: no choice {v!r}"
    for k, bounds in WHOLE.items():
        if (v := (mongodb.get("options") or {}).get(k)) is not None:
            if not isinstance(v, int) or isinstance(v, bool):
                yield f"mongodb.options.{k} is no whole number"
            else:
                yield from outside(f"mongodb.options.{k}", v, bounds)
    for k in ("memory", "cpu"):
        for level in ("warning", "critical", "emergency"):
            s = f"resource.{k}_{level}_threshold"
            v = setting(config, s)
            if not is_number(v) or not 0 <= v <= 1:
                yield f"{s} must be between 0 and 1"
    for pairs, wrong in ((AT_MOST, lambda x, y: x > y), (BELOW, lambda x, y: x >= y)):
        for a, b in pairs:
            x, y = setting(config, a), setting(config, b)
            if is_number(x) and is_number(y) and wrong(x, y):
                yield f"{a} must be {'at most' if pairs is AT_MOST else 'below'} {b}"
    types = setting(config, "resource.tracked_types")
    if not isinstance(types, list) or not all(isinstance(x, str) for x in types):
        yield "resource.tracked_types must be a list of names"
    if (store := config.get("firestore")) is not None and not re.fullmatch(r"[\w-]+", str(store.get("collection") or "")):
        yield "firestore.collection is no such name"
    if (tracing := (config.get("monitoring") or {}).get("tracing")) is not None:
        for k in ("service_name", "endpoint"):
            if k not in tracing:
                yield f"monitoring.tracing.{k} is missing"


def problems(config: dict[str, Any]) -> list[str]:
    """What is wrong with a configuration; empty if nothing."""
    return list(found_problems(config))


def checked(config: dict[str, Any]) -> dict[str, Any]:
    """The configuration; raises with everything that is wrong with it."""
    if found := problems(config):
        raise ValueError("; ".join(found))
    return config
