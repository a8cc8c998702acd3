"""JSON that models write: fences, trailing commas and text around it."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import STIX_TYPES, split_sectors, strip

# The fields of the labels' object with the label each stands for, and the keys of a line of labels.
LABEL_FIELDS = (("Text is CII", "cii"), ("Text is standards", "standards"), ("Text is Technology", "technology"))
SHIFTED_KEYS = ("text is cii", "text is standards", "text is technology", "involved sector(s)")


def clean_json(c: Column) -> Column:
    """The widest {...} of a text, without trailing commas; fences and words around it fall away.  Empty where there is none."""
    widest = F.regexp_extract(F.coalesce(c, F.lit("")), r"(?s)(\{.*\})", 1)
    return F.replace(F.replace(widest, F.lit(",}"), F.lit("}")), F.lit(",]"), F.lit("]"))


def json_object(c: Column) -> Column:
    """The object as a map of strings; an empty map where nothing parses."""
    parsed = F.from_json(clean_json(c), "map<string,string>")
    return F.coalesce(parsed, F.create_map().cast("map<string,string>"))


def labels_from_json(c: Column) -> Column:
    """The labels whose field is "1", then the sectors named."""
    return labels_of(json_object(c))


def labels_of(obj: Column) -> Column:
    field = lambda name: strip(F.coalesce(F.try_element_at(obj, F.lit(name)), F.lit("")))
    flags = F.array(*(F.when(field(name) == "1", F.lit(label)) for name, label in LABEL_FIELDS))
    return F.concat(F.filter(flags, lambda x: x.isNotNull()), split_sectors(field("Involved Sector(s)")))


def is_shifted_labels(c: Column) -> Column:
    """Whether a line that should hold a description holds the labels' JSON."""
    low = F.lower(strip(F.coalesce(c, F.lit(""))))
    return F.contains(low, F.lit("{")) & F.contains(low, F.lit("reasoning")) & F.greatest(*(F.contains(low, F.lit(k)) for k in SHIFTED_KEYS))


#: the canonical types, the longest first, equally long ones as declared
_CANONICAL = sorted(dict.fromkeys(STIX_TYPES.values()), key=len, reverse=True)
_WIDEST = re.compile(r"\{.*\}", re.S)
_STATUS = re.compile(r"INJECTION_STATUS:\s*(CLEAR|INJECTION_DETECTED)")
_SECTORS = re.compile(r"[,;/]")


def read_object(text: str) -> dict:
    """The widest {...} of a text as an object, by the rules of ``clean_json``; empty where nothing parses."""
    found = _WIDEST.search(text)
    if not found:
        return {}
    try:
        value = json.loads(found[0].replace(",}", "}").replace(",]", "]"))
    except ValueError:
        return {}
    return value if isinstance(value, dict) else {}


def _field(obj: dict, name: str) -> str:
    value = obj.get(name)
    return "" if value is None else value.strip() if isinstance(value, str) else json.dumps(value)


def read_labels(obj: dict) -> list[str]:
    """As ``labels_of``."""
    flags = [label for name, label in LABEL_FIELDS if _field(obj, name) == "1"]
    sectors = _SECTORS.split(_field(obj, "Involved Sector(s)").replace(" and ", ","))
    return flags + [x for s in sectors if (x := s.strip().lower())]


def _shifted(line: str) -> bool:
    low = line.lower()
    return "{" in low and "reasoning" in low and any(k in low for k in SHIFTED_KEYS)


def read_type(text: str) -> str:
    """As ``stix_type``."""
    key = text.strip().lower()
    slug = key.replace(" ", "-")
    return STIX_TYPES.get(key) or next((t for t in _CANONICAL if t in slug), slug)


def read_name(text: str) -> str:
    """As ``without_prefix``."""
    text = text.strip()
    return text.partition(":")[2].strip() or text


def read_reply(reply: str | None) -> tuple[bool, str, str, str, list[str]]:
    """(injection_detected, summary, type, name, labels) of a model's reply, in either of two layouts."""
    lines = [x for raw in (reply or "").split("\n") if (x := raw.strip())]
    status = None
    if lines:
        first = lines[0].upper()
        known = _STATUS.fullmatch(first)
        status = known[1] == "INJECTION_DETECTED" if known else True if first == "INJECTION_DETECTED" else None
    if status is not None:
        lines = lines[1:]
    at = lambda i: lines[i] if i < len(lines) else ""
    obj = read_object("\n".join(lines[1:]))
    if obj:
        kind, name, labels = _field(obj, "stix"), _field(obj, "title"), obj.get("labels")
        labels = labels if isinstance(labels, dict) else read_object(_field(obj, "labels"))
    else:
        kind, name = at(1), at(2)
        labels = read_object("\n".join(lines[3 if _shifted(at(3)) else 4 :]))
    return bool(status), at(0), read_type(kind), read_name(name), read_labels(labels)


def parse_replies(df: DataFrame, reply: str) -> DataFrame:
    """Adds injection_detected, summary, stix_type, name and labels of a model's reply; each reply is read once, in an Arrow batch."""
    columns = ["injection_detected", "summary", "stix_type", "name", "labels"]

    @F.pandas_udf("injection_detected boolean, summary string, stix_type string, name string, labels array<string>")
    def read(batch: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([read_reply(r) for r in batch], columns=columns)

    staged = df.withColumn("_r", read(F.col(reply)))
    return staged.select(*(c for c in df.columns if c not in columns), *(f"_r.{c}" for c in columns))
