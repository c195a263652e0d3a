"""Configuration files: contracts, sources, calendars, policies, recipes, specifications."""
from __future__ import annotations

import json
from pathlib import Path

from tidemark.operators.calendar import TradingCalendar
from tidemark.operators.contract import Contract
from tidemark.operators.entitlements import Policy
from tidemark.plans.ingest import Source
from tidemark.plans.recipes import Recipe


def read(path: str | Path) -> dict:
    """JSON always; YAML where a YAML reader is installed."""
    text = Path(path).read_text(encoding="utf-8")
    if str(path).endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as exc:
        raise RuntimeError(f"{path}: reading YAML needs a YAML package") from exc
    return yaml.safe_load(text)


def contract(path) -> Contract:
    return Contract.from_dict(read(path))


def source(path, contract_path) -> Source:
    return Source.from_dict(read(path), contract(contract_path))


def calendar(path) -> TradingCalendar:
    return TradingCalendar.from_dict(read(path))


def recipe(path) -> Recipe:
    return Recipe.from_dict(read(path))


def policy(path) -> Policy:
    raw = read(path)
    return Policy(raw.get("default_consumer", "research"), raw.get("datasets", {}),
                  raw.get("consumers", {}))
