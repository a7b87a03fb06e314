"""Analysis parameters (thresholds, limits, weights) as one frozen object.

Defaults are the documented configuration values of the analysed workflow.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# Required / optional fact columns, numeric columns and the
# strings a CSV reader treats as missing.
REQUIRED_FIELDS = ("campaign_name", "date", "spend", "impressions", "clicks", "revenue")
NUMERIC_FIELDS = ("spend", "impressions", "clicks", "revenue", "purchases", "ctr", "roas")
NA_STRINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# The four segmentation dimensions, in output order.
DIMENSIONS = ("campaign_name", "creative_type", "audience_type", "platform")


def strptime_to_spark(fmt: str) -> str:
    """Translate a strptime pattern (``%Y-%m-%d``) into a Spark datetime pattern."""
    table = {
        "%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm",
        "%S": "ss", "%y": "yy", "%b": "MMM", "%B": "MMMM", "%j": "DDD",
    }
    out, i = [], 0
    while i < len(fmt):
        tok = fmt[i:i + 2]
        if tok in table:
            out.append(table[tok])
            i += 2
        elif fmt[i].isalpha():
            out.append("'" + fmt[i] + "'")
            i += 1
        else:
            out.append(fmt[i])
            i += 1
    return "".join(out)


@dataclass(frozen=True)
class Params:
    # thresholds
    low_ctr: float = 0.01
    trend_stable_threshold: float = 0.05
    # generation limits
    max_hypotheses: int = 5
    min_data_points: int = 10
    # data quality
    date_format: str = "%Y-%m-%d"
    required_fields: tuple = field(default=REQUIRED_FIELDS)
    # confidence weights (insight, validation strength, segmentation evidence)
    weight_insight: float = 0.4
    weight_validation: float = 0.4
    weight_segmentation: float = 0.2
    # metric the hypotheses and texts are phrased around
    focus_metric: str = "roas"
    # trend gate on the raw ratio column (off: trends use the sums only)
    trend_requires_metric_column: bool = False
    # audience tagging: True reproduces plain substring rules ("female"
    # contains "male"); False matches whole words
    audience_substring_rules: bool = True

    @property
    def spark_date_format(self) -> str:
        return strptime_to_spark(self.date_format)

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)
