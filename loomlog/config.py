"""Configuration from TOML, checked before anything runs."""

from __future__ import annotations

import re
import tomllib
from pathlib import PurePosixPath

KNOWN = {
    "paths": {"transcripts", "output", "eventlogs", "exclude"}, "sweep": {"quiet_seconds", "limit", "max_attempts"}, "provider": {"type", "url", "model", "key", "argv", "timeout"},
    "headless": {"entrypoints", "agents"}, "thresholds": {"floor", "drop", "min_sessions"}, "hook": {"argv", "env", "timeout"},
}


def load(path: str) -> dict:
    """The configuration of a file; every fault is named at once."""
    with open(path, "rb") as f:
        config = tomllib.load(f)
    if faults := check(config):
        raise ValueError("; ".join(faults))
    return config


def check(config: dict) -> list[str]:
    """Faults: unknown sections and keys, secrets that are no reference to the environment, programs that
    are no list of arguments, output below its source or the other way round, shares beyond 0 to 1."""
    out = [f"unknown section {s}" for s in config if s not in KNOWN]
    out += [f"unknown key {s}.{k}" for s in KNOWN for k in config.get(s, {}) if k not in KNOWN[s]]
    key = config.get("provider", {}).get("key")
    if key is not None and not (isinstance(key, str) and re.fullmatch(r"\$\{[A-Z_][A-Z0-9_]*\}", key)):
        out.append("provider.key must name an environment variable as ${NAME}")
    for s in ("provider", "hook"):
        argv = config.get(s, {}).get("argv")
        if argv is not None and not (isinstance(argv, list) and argv and all(isinstance(a, str) for a in argv)):
            out.append(f"{s}.argv must be a list of texts")
    paths = config.get("paths", {})
    trees = [(k, PurePosixPath(paths[k])) for k in ("transcripts", "output", "eventlogs") if isinstance(paths.get(k), str)]
    for i, (a, p) in enumerate(trees):
        out += [f"paths.{a} and paths.{b} must not hold each other" for b, q in trees[i + 1 :] if p == q or p in q.parents or q in p.parents]
    limits = config.get("thresholds", {})
    for k in ("floor", "drop"):
        if k in limits and (isinstance(limits[k], bool) or not isinstance(limits[k], int | float) or not 0 <= limits[k] <= 1):
            out.append(f"thresholds.{k} must be from 0 to 1")
    return out
