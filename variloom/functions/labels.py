"""Report texts: sizes, times, node labels, progress."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Size letters and binary units by power of 1024, in rising order.
SIZE_LETTERS = ["B", "K", "M", "G", "T", "P"]
BINARY_UNITS = ["B", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB"]

# Node states by label class; any other state is "secondary".
NODE_LABELS = {
    "alert": ["DOWN", "DRAINED", "DRAINING", "FAIL", "FAILING", "POWER_DOWN", "POWERING_DOWN",
              "RESERVED", "PERFCTRS"],
    "warning": ["UNKNOWN", "POWER_UP", "REBOOT", "MAINT", "FUTURE"],
    "success": ["ALLOCATED", "ALLOCATED+", "COMPLETING", "MIXED"],
    "primary": ["IDLE"],
}

# Text for a missing time, the time layout before the year, and the seconds after which the calendar
# repeats with its weekdays (400 years).
NO_TIME = "NA"
TIME_LAYOUT = "EEE MMM dd HH:mm:ss"
CYCLE_SECONDS, CYCLE_YEARS = 146_097 * 86_400, 400


def human_size(size: Column) -> Column:
    """Whole number of the largest fitting 1024 step, with its letter."""
    text = F.concat(size.cast("long").cast("string"), F.lit(SIZE_LETTERS[0]))
    for power, letter in enumerate(SIZE_LETTERS[1:], start=1):
        step = 1024**power
        scaled = F.floor(size / F.lit(step)).cast("string")
        text = F.when(size >= F.lit(step), F.concat(scaled, F.lit(letter))).otherwise(text)
    return text


def size_unit(size: Column) -> Column:
    """Binary unit a byte total is shown in."""
    unit = F.when(size.isNotNull(), BINARY_UNITS[0])
    for power, name in enumerate(BINARY_UNITS[1:], start=1):
        unit = F.when(size >= F.lit(1024**power), name).otherwise(unit)
    return unit


def format_epoch(seconds: Column) -> Column:
    """UTC time text of epoch seconds; 0 or NULL gives ``NA``. Needs session time zone UTC.

    The year has four digits, or more when it is later than 9999, without a sign. The time is formatted within one cycle
    of the calendar, so no number of seconds is beyond the range of timestamps.
    """
    whole = seconds.cast("bigint")
    inside = F.pmod(whole, F.lit(CYCLE_SECONDS))
    cycles = F.call_function("div", whole - inside, F.lit(CYCLE_SECONDS))
    at = F.timestamp_seconds(inside)
    year = F.year(at) + cycles * CYCLE_YEARS
    shown = F.concat(F.date_format(at, TIME_LAYOUT), F.format_string(" %04d", year))
    return F.when(F.coalesce(seconds, F.lit(0)) == 0, NO_TIME).otherwise(shown)


def node_label(state: Column) -> Column:
    """Label class of a node state."""
    label = F.lit("secondary")
    for name, states in NODE_LABELS.items():
        label = F.when(state.isin(states), name).otherwise(label)
    return label


def progress_label(running: Column, pending: Column, failed: Column) -> Column:
    """``running | pending | failed``."""
    return F.concat_ws(" | ", *(c.cast("string") for c in (running, pending, failed)))


def elapsed_seconds(text: Column) -> Column:
    """Seconds of ``[h:]m:ss.cc``; NULL when a part is no number."""
    parts = F.transform(F.split(text, ":"), lambda p: p.try_cast("double"))
    return F.aggregate(parts, F.lit(0.0), lambda total, part: total * 60 + part)


def percent(text: Column) -> Column:
    """Fraction of ``NN%``; NULL when it is no number."""
    return F.rtrim(text, F.lit("%")).try_cast("double") / 100
