"""Fixed dimensions: severities, statuses and the criteria of WCAG 2.1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values.
SEVERITY = {"critical": 3, "major": 2, "minor": 1, "info": 0}
STATUSES = ("needs_remediation", "remediated", "auto_remediated", "compliant")

# The success criteria of WCAG 2.1 (number, level, name), as W3C publishes them.
WCAG = """
1.1.1 A Non-text Content
1.2.1 A Audio-only and Video-only (Prerecorded)
1.2.2 A Captions (Prerecorded)
1.2.3 A Audio Description or Media Alternative
1.2.4 AA Captions (Live)
1.2.5 AA Audio Description
1.2.6 AAA Sign Language
1.2.7 AAA Extended Audio Description
1.2.8 AAA Media Alternative
1.2.9 AAA Audio-only (Live)
1.3.1 A Info and Relationships
1.3.2 A Meaningful Sequence
1.3.3 A Sensory Characteristics
1.3.4 AA Orientation
1.3.5 AA Identify Input Purpose
1.3.6 AAA Identify Purpose
1.4.1 A Use of Color
1.4.2 A Audio Control
1.4.3 AA Contrast (Minimum)
1.4.4 AA Resize Text
1.4.5 AA Images of Text
1.4.6 AAA Contrast (Enhanced)
1.4.7 AAA Low or No Background Audio
1.4.8 AAA Visual Presentation
1.4.9 AAA Images of Text (No Exception)
1.4.10 AA Reflow
1.4.11 AA Non-text Contrast
1.4.12 AA Text Spacing
1.4.13 AA Content on Hover or Focus
2.1.1 A Keyboard
2.1.2 A No Keyboard Trap
2.1.3 AAA Keyboard (No Exception)
2.1.4 A Character Key Shortcuts
2.2.1 A Timing Adjustable
2.2.2 A Pause, Stop, Hide
2.2.3 AAA No Timing
2.2.4 AAA Interruptions
2.2.5 AAA Re-authenticating
2.2.6 AAA Timeouts
2.3.1 A Three Flashes or Below Threshold
2.3.2 AAA Three Flashes
2.3.3 AAA Animation from Interactions
2.4.1 A Bypass Blocks
2.4.2 A Page Titled
2.4.3 A Focus Order
2.4.4 A Link Purpose (In Context)
2.4.5 AA Multiple Ways
2.4.6 AA Headings and Labels
2.4.7 AA Focus Visible
2.4.8 AAA Location
2.4.9 AAA Link Purpose (Link Only)
2.4.10 AAA Section Headings
2.5.1 A Pointer Gestures
2.5.2 A Pointer Cancellation
2.5.3 A Label in Name
2.5.4 A Motion Actuation
2.5.5 AAA Target Size
2.5.6 AAA Concurrent Input Mechanisms
3.1.1 A Language of Page
3.1.2 AA Language of Parts
3.1.3 AAA Unusual Words
3.1.4 AAA Abbreviations
3.1.5 AAA Reading Level
3.1.6 AAA Pronunciation
3.2.1 A On Focus
3.2.2 A On Input
3.2.3 AA Consistent Navigation
3.2.4 AA Consistent Identification
3.2.5 AAA Change on Request
3.3.1 A Error Identification
3.3.2 A Labels or Instructions
3.3.3 AA Error Suggestion
3.3.4 AA Error Prevention (Legal, Financial, Data)
3.3.5 AAA Help
3.3.6 AAA Error Prevention (All)
4.1.1 A Parsing
4.1.2 A Name, Role, Value
4.1.3 AA Status Messages
"""


def wcag_rows() -> list[tuple[str, str, str]]:
    """(criterion, name, level)"""
    parts = [line.split(" ", 2) for line in WCAG.strip().splitlines()]
    return [(number, name, level) for number, level, name in parts]


def wcag(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(wcag_rows(), "criterion string, criterion_name string, criterion_level string")


def severity_rank(severity: Column, unknown: int = 0) -> Column:
    rank = F.lit(unknown)
    for name, value in SEVERITY.items():
        rank = F.when(severity == name, value).otherwise(rank)
    return rank
