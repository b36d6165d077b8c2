"""The README's operator map names every registered query."""

import os
import re

from faultline.plans import loads  # noqa: F401 (registers its own)
from faultline.plans.registered import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_readme_lists_every_registered_query():
    text = open(os.path.join(ROOT, "README.md"), encoding="utf-8").read()
    section = text[text.index("## Operator map"):text.index("## Scale design")]
    named = set(re.findall(r"`([a-z_]+)`", section))
    missing = sorted(set(QUERIES) - named)
    assert missing == [], f"not in the README operator map: {missing}"
