"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridflow import config as C

__all__ = [
    "epoch_ms", "ms_to_timestamp", "kwh", "tariff_hundredths", "cost_from_energy",
    "is_valid_node_type", "topic_level", "topic_matches", "js_number", "js_parse_int",
    "json_field_text", "period_ms_of_payload", "period_seconds", "period_command_seconds",
    "nonneg_zero",
]


def epoch_ms(ts: Column) -> Column:
    """Timestamp (or timestamp_ntz read under a UTC session) -> epoch ms, floored."""
    return F.unix_millis(ts.cast("timestamp"))


def ms_to_timestamp(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def kwh(energy_ckw_ms: Column) -> Column:
    """centi-kW x ms (integer) -> kWh (double), divided once at the end."""
    return energy_ckw_ms / F.lit(float(C.CENTI_KW_MS_PER_KWH))


def tariff_hundredths(node_type: Column) -> Column:
    """Rate in hundredths per kWh: consumers pay, producers are credited, others 0."""
    expr = F.lit(0)
    for t, r in C.RATE_HUNDREDTHS.items():
        expr = F.when(node_type == t, F.lit(r)).otherwise(expr)
    return expr


def nonneg_zero(x: Column) -> Column:
    """Normalise -0.0 to 0.0 (a zero-energy credit would print as -0.0)."""
    return x + F.lit(0.0)


def cost_from_energy(energy_ckw_ms: Column, node_type: Column) -> Column:
    """Cost of an energy amount at the node type's tariff (exact integer product)."""
    return nonneg_zero((energy_ckw_ms * tariff_hundredths(node_type))
                       / F.lit(float(C.CENTI_KW_MS_PER_KWH) * 100.0))


def is_valid_node_type(t: Column) -> Column:
    return F.coalesce(t.isin(*C.NODE_TYPES), F.lit(False))


def topic_level(topic: Column, i: int) -> Column:
    """i-th level (0-based) of a '/'-separated topic; null when missing."""
    return F.get(F.split(topic, "/"), i)


def topic_pattern(pattern: str) -> str:
    """MQTT-style subscription as an anchored regex: '+' is one level, '#' the rest."""
    parts = []
    for lvl in pattern.split("/"):
        if lvl == "+":
            parts.append("[^/]+")
        elif lvl == "#":
            parts.append(".*")
        else:
            parts.append(_re_escape(lvl))
    return "/".join(parts)


def topic_matches(topic: Column, *patterns: str) -> Column:
    """Does the topic match any of the subscriptions (one regex for all)?"""
    return topic.rlike("^(" + "|".join(f"({topic_pattern(p)})" for p in patterns) + ")$")


def _re_escape(s: str) -> str:
    out = []
    for ch in s:
        out.append("\\" + ch if ch in ".^$*+?()[]{}|\\" else ch)
    return "".join(out)


# fixed value: the decimal literal grammar accepted as a number
DECIMAL_NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def js_number(text: Column) -> Column:
    """Number(text) restricted to finite decimal text: blanks around allowed,
    empty text is 0, anything else (junk, Infinity, NaN) is null.

    Hex / binary literals are not supported (documented divergence).
    """
    # all white space counts as blanks, not the space alone
    t = F.regexp_replace(text, r"^[\s\p{Z}\x{FEFF}]+|[\s\p{Z}\x{FEFF}]+$", "")
    return (F.when(t == "", F.lit(0.0))
             .when(t.rlike(DECIMAL_NUMBER_PATTERN), t.try_cast("double")))


def js_parse_int(text: Column) -> Column:
    """parseInt(text, 10): leading blanks, optional sign, leading digits; else null."""
    digits = F.regexp_extract(F.ltrim(text), r"^([+-]?[0-9]+)", 1)
    return F.when(digits == "", F.lit(None).cast("long")).otherwise(digits.try_cast("long"))


def json_field_text(body: Column, field: str) -> Column:
    """Flat JSON field as text; a missing field reads as ''."""
    return F.coalesce(F.get_json_object(body, f"$.{field}"), F.lit(""))


def period_ms_of_payload(payload: Column) -> Column:
    """Period payload: a number, or an object with periodMs; finite values only
    (null otherwise). The text is parsed once; the finite check binds it in a
    lambda so the parse is not repeated."""
    direct = js_number(payload)
    nested = js_number(F.get_json_object(payload, "$.periodMs"))
    v = F.coalesce(direct, nested)
    inf = F.lit(float("inf"))
    return F.try_element_at(F.filter(F.array(v), lambda x: ~F.isnan(x) & (F.abs(x) != inf)), F.lit(1))


def period_seconds(period_ms: Column) -> Column:
    """Math.round(ms / 1000): halves round up (towards +infinity)."""
    return F.floor(period_ms / F.lit(1000.0) + F.lit(0.5)).cast("long")


def period_command_seconds(cmd: Column) -> Column:
    """Leading digits after 'PERIOD:' as seconds; null when absent or not > 0."""
    d = F.regexp_extract(cmd, r"^PERIOD:([0-9]+)", 1)
    v = F.when(d != "", d.try_cast("long"))
    return F.when(v > 0, v)
