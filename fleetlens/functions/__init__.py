"""Column expressions shared by the operators; all of them run inside the JVM."""

from fleetlens.functions.expressions import (
    fahrenheit, floor_div, interval_micros, is_complaint, micros, split_words, tokens, vehicle_of, whole,
)

__all__ = [
    "fahrenheit", "floor_div", "interval_micros", "is_complaint", "micros", "split_words", "tokens", "vehicle_of",
    "whole",
]
