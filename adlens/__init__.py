"""adlens: ad-performance analytics as Spark DataFrame jobs.

One fact table of daily ad rows goes in; small result tables come out
(quality profile, summary, ratio metrics, week/month trends, one-pass
segmentation, rule-based hypotheses with statistical evidence, creative
recommendations, report tables and output-contract checks).  Every public
function maps DataFrame(s) to a DataFrame and never collects data to the
driver.
"""

from adlens.params import Params

__all__ = ["Params"]
__version__ = "0.1.0"
