"""Colours and contrast as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Colours as they are written.
RGB = r"rgb\(\s*(\d+)\s*,\s*(\d+)\s*,\s*(\d+)\s*\)"
COLOUR = r"(#[0-9a-fA-F]{3,6}|rgb\(\s*\d+\s*,\s*\d+\s*,\s*\d+\s*\))"


def normalised(colour: Column) -> Column:
    """#RGB and rgb() become #RRGGBB in upper case; other forms stay, in upper case."""
    parts = [F.regexp_extract(colour, RGB, k).try_cast("int") for k in (1, 2, 3)]
    # as in %02X: at least two digits
    hexed = F.concat(F.lit("#"), *[F.when(p < 16, F.concat(F.lit("0"), F.hex(p))).otherwise(F.hex(p)) for p in parts])
    tripled = F.upper(F.regexp_replace(colour, "^#(.)(.)(.)$", "#$1$1$2$2$3$3"))
    return F.when(colour.startswith("rgb"), hexed).when(F.length(colour) == 4, tripled).otherwise(F.upper(colour))


def valid(colour: Column) -> Column:
    """False where a channel has no digits at all (four-digit hex), so no ratio exists."""
    return F.length(colour) >= 6


def luminance(colour: Column) -> Column:
    def channel(start: int) -> Column:
        v = F.conv(F.substring(colour, start, 2), 16, 10).cast("double") / 255
        return F.when(v <= 0.03928, v / 12.92).otherwise(F.pow((v + 0.055) / 1.055, F.lit(2.4)))

    return channel(2) * 0.2126 + channel(4) * 0.7152 + channel(6) * 0.0722


def contrast(one: Column, other: Column) -> Column:
    """The ratio of two #RRGGBB colours, from 1 to 21."""
    a, b = luminance(one), luminance(other)
    return (F.greatest(a, b) + 0.05) / (F.least(a, b) + 0.05)


def is_dark(colour: Column) -> Column:
    """By perceived brightness; colours that aren't #RRGGBB count as light unless named dark."""
    v = [F.conv(F.substring(colour, s, 2), 16, 10).cast("double") for s in (2, 4, 6)]
    bright = (v[0] * 0.299 + v[1] * 0.587 + v[2] * 0.114) / 255
    # fixed values: names of dark colours
    named = F.lower(colour).isin("black", "navy", "darkblue", "darkgreen", "darkred", "purple", "maroon")
    return F.when(colour.rlike("^#[0-9a-fA-F]{6}$"), bright < 0.5).otherwise(named)


def is_large(tag: Column, style: Column) -> Column:
    """h1 to h3, 24 px and more, or bold from 18.67 px; pt, em and rem are converted."""
    size = F.regexp_extract(style, r"font-size:\s*(\d+)(px|pt|em|rem)", 1).try_cast("double")
    unit = F.regexp_extract(style, r"font-size:\s*(\d+)(px|pt|em|rem)", 2)
    pixels = F.when(unit == "pt", size * 1.333).when(unit.isin("em", "rem"), size * 16).otherwise(size)
    bold = tag.isin("b", "strong") | style.rlike(r"font-weight:\s*(bold|700|800|900)")
    return F.coalesce(tag.isin("h1", "h2", "h3") | (pixels >= 24) | ((pixels >= 18.67) & bold), F.lit(False))
