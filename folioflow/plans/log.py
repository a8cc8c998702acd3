"""The driver's log: short on the console, full and rotating in a file, one record a line."""

from __future__ import annotations

import logging
from logging.handlers import RotatingFileHandler
from pathlib import Path


class OneLine(logging.Formatter):
    def format(self, record: logging.LogRecord) -> str:
        return super().format(record).replace("\n", " ⏎ ")


def start(folder: str | Path, name: str = "folioflow", most_bytes: int = 5 << 20, keep: int = 3) -> logging.Logger:
    Path(folder).mkdir(parents=True, exist_ok=True)
    logger = logging.getLogger(name)
    logger.setLevel(logging.DEBUG)
    logger.handlers.clear()
    console, file = logging.StreamHandler(), RotatingFileHandler(Path(folder) / f"{name}.log", maxBytes=most_bytes, backupCount=keep, encoding="utf-8")
    console.setLevel(logging.INFO)
    for handler in (console, file):
        handler.setFormatter(OneLine("%(asctime)s %(levelname)s %(message)s"))
        logger.addHandler(handler)
    return logger
