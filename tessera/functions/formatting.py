"""Value formatting for reports (the reference prints its sweeps as text).

``format_string`` runs in the JVM (Java ``Formatter``), so a report line is
one more projection of the sweep, not a driver-side loop.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The line layout of the reference's threshold sweep printout.
SWEEP_LINE = "Threshold = %.2f | Precision = %.3f, Recall = %.3f"


def sweep_line(threshold: Column | str, precision: Column | str, recall: Column | str) -> Column:
    """``"Threshold = {:.2f} | Precision = {:.3f}, Recall = {:.3f}"`` per row."""
    return F.format_string(SWEEP_LINE, threshold, precision, recall)
