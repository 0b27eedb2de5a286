"""Reading JSON columns and the text that models reply with."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SUBSCORES = "struct<utility:tinyint,robustness:tinyint,safety:tinyint,flags:array<string>>"


def string_list(raw: Column) -> Column:
    """A JSON array as strings; anything else is an empty list."""
    return F.coalesce(F.from_json(raw, "array<string>"), F.array().cast("array<string>"))


def json_number(parsed: Column, name: str) -> Column:
    """The number a JSON object holds under ``name``; anything else, booleans too, is null."""
    kind = F.schema_of_variant(F.try_variant_get(parsed, f"$.{name}", "variant"))
    return F.when(kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), F.try_variant_get(parsed, f"$.{name}", "double"))


def subscores(raw: Column) -> Column:
    """Scores truncated to whole numbers in 0-10 (true is 1, whole numbers in quotes
    count, anything else is null) and flags; null unless a JSON object."""
    parsed = F.try_parse_json(raw)
    is_object = F.schema_of_variant(parsed).startswith("OBJECT")

    def score(name: str) -> Column:
        kind = F.schema_of_variant(F.try_variant_get(parsed, f"$.{name}", "variant"))
        said = F.try_variant_get(parsed, f"$.{name}", "string")
        value = F.when(kind == "BOOLEAN", F.when(said == "true", 1.0).otherwise(0.0)).when(kind == "STRING", F.when(said.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(said).try_cast("double"))).otherwise(json_number(parsed, name))
        return F.when(value.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(10.0), value)).cast("int").cast("tinyint"))

    flags = F.coalesce(F.try_variant_get(parsed, "$.flags", "array<string>"), F.array().cast("array<string>"))
    return F.when(is_object, F.struct(*[score(n).alias(n) for n in ("utility", "robustness", "safety")], flags.alias("flags")))


def unsafe(raw: Column, hard_flags: list[str]) -> Column:
    """Whether a judgement excludes: safety is a number below 3, or a hard flag stands in its list."""
    parsed = F.try_parse_json(raw)
    flags = F.try_variant_get(parsed, "$.flags", "array<string>")
    low = json_number(parsed, "safety") < 3
    hard = F.arrays_overlap(flags, F.array(*[F.lit(f) for f in hard_flags]))
    return F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False)) & (F.coalesce(low, F.lit(False)) | F.coalesce(hard, F.lit(False)))


def json_object(reply: Column) -> Column:
    """The JSON object in a reply, as text: thoughts and fences removed, the whole
    tried first, then from the first brace to the last; null if there is none."""
    text = F.trim(F.regexp_replace(reply, r"(?s)<think>.*?</think>", ""))
    text = F.trim(F.regexp_replace(F.regexp_replace(text, r"^```[a-zA-Z]*\s*", ""), r"\s*```$", ""))
    braced = F.regexp_extract(text, r"(?s)\{.*\}", 0)

    def checked(candidate: Column) -> Column:
        parsed = F.try_parse_json(candidate)
        return F.when(F.schema_of_variant(parsed).startswith("OBJECT"), F.to_json(parsed))

    return F.coalesce(checked(text), checked(braced))


def verdict_map(reply: Column, items: Column | None = None) -> Column:
    """``VERDICT[i]: 0|1`` lines as a map; the last line of an index counts.  With
    ``items``, the number of criteria, indices from there on are ignored and a
    reply that misses any index is null."""
    pattern = r"(?i)VERDICT\s*\[\s*(\d+)\s*\]\s*:?\s*([01])\b"
    index = F.transform(F.regexp_extract_all(reply, F.lit(pattern), 1), lambda x: x.cast("int"))
    value = F.transform(F.regexp_extract_all(reply, F.lit(pattern), 2), lambda x: x.cast("int"))
    pairs = F.arrays_zip(index.alias("i"), value.alias("v"))
    if items is not None:
        pairs = F.filter(pairs, lambda p: p["i"] < items)
    last = F.filter(pairs, lambda p, k: ~F.exists(F.slice(pairs, k + 2, F.size(pairs)), lambda q: q["i"] == p["i"]))
    made = F.map_from_entries(last)
    return made if items is None else F.when(F.size(last) == items, made)


def first_score(reply: Column, default: float = 5.0) -> Column:
    """The overall score a reply names, in 0-10; else the first number from 0 to 10
    among its first 200 characters, else ``default``."""
    # The forms in which a score is named, first form first.
    forms = [r"(?i)OVERALL SCORE:\s*(\d+(?:\.\d+)?)", r"(?i)Score:\s*(\d+(?:\.\d+)?)/10", r"(?i)Final Score:\s*(\d+(?:\.\d+)?)"]
    found = [F.nullif(F.regexp_extract(reply, p, 1), F.lit("")).cast("double") for p in forms]
    numbers = F.transform(F.regexp_extract_all(F.substring(reply, 1, 200), F.lit(r"\b(\d+(?:\.\d+)?)\b"), 1), lambda x: x.cast("double"))
    loose = F.try_element_at(F.filter(numbers, lambda x: x <= 10), F.lit(1))
    return F.coalesce(F.least(F.lit(10.0), F.coalesce(*found)), loose, F.lit(default))


def utc(raw: Column) -> Column:
    """ISO text to a timestamp; without an offset it is UTC, whatever the session's zone; unreadable text is null."""
    said = F.trim(raw)
    return F.try_to_timestamp(F.when(said.rlike(r"(?i)(z|[+-]\d\d:?\d\d)$"), said).otherwise(F.concat(said, F.lit("Z"))))
