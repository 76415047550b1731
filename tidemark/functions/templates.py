"""The sentences of the reports, each written once and filled from columns or from SQL expressions."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

SLOT = re.compile(r"\{(\w+)\}")


def _pieces(template: str) -> list[tuple[bool, str]]:
    """(is a slot, text or name of the slot) in order."""
    parts = SLOT.split(template)
    return [(bool(i % 2), part) for i, part in enumerate(parts) if part]


def fill(template: str, **slots: Column) -> Column:
    """The sentence as a column; it is null if a slot is."""
    return F.concat(*[slots[part] if is_slot else F.lit(part) for is_slot, part in _pieces(template)])


def fill_sql(template: str, **slots: str) -> str:
    """The same sentence as an SQL expression."""
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    return " || ".join(slots[part] if is_slot else quoted(part) for is_slot, part in _pieces(template))


@dataclass(frozen=True)
class Finding:
    """A ranked finding: fixed kicker and tone, title and body with slots."""

    rank: int
    kicker: str
    tone: str
    title: str
    body: str


FINDINGS = {
    "largest": Finding(1, "Largest label", "blue", "Label {label} holds the most rows",
                       "{rows} rows, {share} of the table. Set against all rows, its {feature} stands out most: {direction}."),
    "smallest": Finding(2, "Smallest label", "warm", "Label {label} holds the fewest rows",
                        "{rows} rows. What sets them apart most is {feature}."),
    "widest": Finding(3, "Widest gap between labels", "gold", "{feature}",
                      "Label means of {feature} run from label {low} up to label {high}, the widest range of all features in deviations."),
    "missing": Finding(4, "Most missing values", "warm", "{column} is empty most often", "{share} of the rows have no value here."),
    "pair": Finding(5, "Highest correlation", "blue", "{x} with {y}", "Pearson coefficient {value} over rows that have both values."),
    "mix": Finding(6, "Clearest leader in the mix", "teal", "Label {label} leads in {feature}",
                   "Its median {feature} is further ahead of the second label than in any other share."),
    "largest_value": Finding(7, "Largest value", "gold", "{name}", "The largest total is {total}; medians are not moved by it, means are."),
}
NO_NAME = "Row without a name"
NO_FEATURE = "no single feature"
NO_DIRECTION = "no difference"

STATUS_READINGS = {
    "exits": "Most acquisitions of all labels: {acquired} acquired, {closed} closed.",
    "closures": "Most closures of all labels: {closed} closed.",
    "stable": "Fewest closures of all labels: {closed} closed, {operating} operating at the time of recording.",
    "active": "{operating} operating; few outcomes are known so far.",
    "unknown": "{unknown} without a known status, so the other shares are uncertain.",
    "mixed": "{operating} operating, {acquired} acquired, {closed} closed.",
    "overall": "Acquired most often: label {acquired_label} ({acquired}). Closed most often: label {closed_label} ({closed}).",
    "none": "No row has a status.",
}
TAKEAWAY = "The median total is largest in {top} ({top_value}) and smallest in {bottom} ({bottom_value})."
NO_TAKEAWAY = "No label has a total."
DESCRIBED_BY = "Described best by {feature}."
