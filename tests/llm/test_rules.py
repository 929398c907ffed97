"""What the text operators may bring to the driver, and what they never use."""

from __future__ import annotations

import re
from pathlib import Path

from caseloom.llm import queries

FOLDER = Path(queries.__file__).parent

#: Calls that bring rows to the driver, each bounded by a documented parameter or by a fixed size.
BOUNDED = {
    "decontam.py": "one block of benchmark items of 16 MB",
    "neighbours.py": "the rows that fit the forest, and the probing queries",
    "secrets.py": "labelled examples up to their number of symbols",
    "toxicity.py": "labelled rows up to their number",
}


def test_rows_reach_the_driver_only_where_their_number_is_bounded():
    found = {p.name for p in FOLDER.glob("*.py") if re.search(r"toPandas\(|toArrow\(|\.collect\(\)", p.read_text())}
    assert found <= BOUNDED.keys()


def test_never_used():
    for path in FOLDER.glob("*.py"):
        for word in ("localCheckpoint", "crossJoin", ".rdd", "tempfile", "/tmp"):
            assert word not in path.read_text(), f"{word} in {path.name}"
