"""Rule sets: JSON documents (or dicts) in the KPI or the field dialects."""

from __future__ import annotations

import json
import os
import warnings
from collections.abc import Mapping

from .functions.numbers import OPERATORS, RuleError


def load_rules(source) -> dict:
    """A rule set from a dict, a JSON text or a JSON file path.

    Must be a non-empty JSON object. An unknown operator is reported by a
    warning when the rule set is loaded (in the run it is one failed row)."""
    if isinstance(source, Mapping):
        doc = dict(source)
    elif isinstance(source, str) and os.path.exists(source):
        with open(source, encoding="utf-8") as fh:
            doc = json.load(fh)
    else:
        doc = json.loads(source)
    if not isinstance(doc, dict) or not doc:
        raise RuleError("rule set must be a non-empty JSON object")
    if bad := bad_operators(doc):
        warnings.warn(f"rules with an unsupported operator, each a failed row of the run: {', '.join(bad)}", stacklevel=2)
    return doc


def bad_operators(doc: Mapping) -> list[str]:
    """Names of rules whose ``operator`` is not supported."""
    bad = []
    for section in ("businessrulevalidation", "formulavalidation", "trendvalidation"):
        for rule in doc.get(section, []) or []:
            op = rule.get("operator") if isinstance(rule, Mapping) else None
            if op is not None and op not in OPERATORS:
                bad.append(str(rule.get("name", section)))
    return bad
