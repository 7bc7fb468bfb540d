"""Structured logging: an event and its fields, as text for people or one JSON object a line (LOG_FORMAT=json)."""

from __future__ import annotations

import json
import logging
import os
import sys
from datetime import datetime, timezone

_PLAIN = {"exc_info", "stack_info", "stacklevel", "extra"}


class Log(logging.LoggerAdapter):
    """log.info("event", key=value, ...); bind(key=value) gives a logger that adds these fields to every event."""

    def process(self, msg, kwargs):
        fields = dict(self.extra or {}) | {k: kwargs.pop(k) for k in [*kwargs] if k not in _PLAIN}
        kwargs["extra"] = (kwargs.get("extra") or {}) | {"fields": fields}
        return msg, kwargs

    def bind(self, **fields) -> Log:
        return Log(self.logger, dict(self.extra or {}) | fields)


class Formatter(logging.Formatter):
    def __init__(self, as_json: bool):
        super().__init__()
        self.as_json = as_json

    def format(self, record: logging.LogRecord) -> str:
        at = datetime.fromtimestamp(record.created, timezone.utc).isoformat()
        fields = getattr(record, "fields", {})
        if record.exc_info:
            fields = fields | {"exception": self.formatException(record.exc_info)}
        if self.as_json:
            return json.dumps({"timestamp": at, "level": record.levelname.lower(), "logger": record.name, "event": record.getMessage()} | fields, default=str)
        return " ".join([at, f"[{record.levelname.lower()}]", record.name, record.getMessage(), *(f"{k}={v}" for k, v in fields.items())])


def get_logger(name: str) -> Log:
    return Log(logging.getLogger(name), {})


def configure() -> None:
    """Send events to standard error, in the form and from the level that the environment names; a handler that is there stays."""
    root = logging.getLogger()
    if not root.handlers:
        handler = logging.StreamHandler(sys.stderr)
        handler.setFormatter(Formatter(os.environ.get("LOG_FORMAT", "console").lower() == "json"))
        root.addHandler(handler)
        root.setLevel(os.environ.get("LOG_LEVEL", "INFO"))
