"""Texts that hold JSON, Python literals or SQL literals: review messages, model replies, reviews, dump lines."""

from __future__ import annotations

import ast
import json
import re

#: Fixed rules of a valid review.
REQUIRED = {
    "vulnerability_analysis": ["summary", "severity", "root_cause", "attack_vector", "cwe_explanation"],
    "fix_analysis": ["summary", "changes_made", "fix_quality", "completeness"],
    "code_review": ["security_improvements", "remaining_concerns", "best_practices"],
}
ALLOWED = {
    ("vulnerability_analysis", "severity"): ["LOW", "MEDIUM", "HIGH", "CRITICAL"],
    ("fix_analysis", "fix_quality"): ["POOR", "FAIR", "GOOD", "EXCELLENT"],
    ("fix_analysis", "completeness"): ["INCOMPLETE", "PARTIAL", "COMPLETE", "COMPREHENSIVE"],
}
LISTS = {"vulnerability_analysis": ["affected_lines"], "fix_analysis": ["changes_made"], "code_review": ["security_improvements", "remaining_concerns", "best_practices"]}
WEIGHTS = {"json_valid": 0.25, "all_fields_present": 0.20, "cwe_mentioned": 0.15, "line_numbers_valid": 0.10, "reasonable_length": 0.10, "no_generic_response": 0.10, "severity_appropriate": 0.10}
GENERIC = ["as an ai", "i cannot", "i apologize", "sorry", "unable to", "i do not have"]
REGENERATE_BELOW = 0.6


def clean_message(message: str | None) -> str | None:
    """Plain text of a message: of a list of translations the English one, else the first that isn't empty."""
    text = (message or "").strip()
    if not text.startswith("["):
        return text or None
    for parse in (json.loads, ast.literal_eval):
        try:
            items = parse(text)
        except (ValueError, SyntaxError, MemoryError, RecursionError):
            continue
        found = [x for x in items if isinstance(x, dict) and x.get("value")] if isinstance(items, list) else []
        best = next((x for x in found if x.get("lang") == "en"), found[0] if found else None)
        return str(best["value"]).strip() if best else None
    return text


def description(raw: str | None) -> str:
    """The English text of a description column whose quotes are those of Python; what can't be read stays as it is."""
    text = raw or ""
    try:
        items = json.loads(text.replace("'", '"'))
    except ValueError:
        return text
    if not isinstance(items, list) or not items or not all(isinstance(x, dict) for x in items):
        return text
    return next((x.get("value", "") for x in items if x.get("lang") == "en"), items[0].get("value", ""))


def parse_reply(reply: str | None) -> str | None:
    """The JSON object of a model's reply as compact text: the whole reply, its fenced block, or the first balanced braces."""
    text = reply or ""
    fenced = re.search(r"```(?:json)?\s*(\{.*?\})\s*```", text, re.S)
    start, depth, braces = text.find("{"), 0, None
    for i in range(max(start, 0), len(text)):
        depth += (text[i] == "{") - (text[i] == "}")
        if start >= 0 and not depth:
            braces = text[start : i + 1]
            break
    for part in (text, fenced[1] if fenced else None, braces):
        try:
            return json.dumps(json.loads(part or ""))
        except ValueError:
            continue
    return None


def issues(review: dict) -> dict[str, list[str]]:
    """What is wrong with each section; empty for a valid review."""
    out: dict[str, list[str]] = {}
    for section, fields in REQUIRED.items():
        if section not in review:
            out[section] = ["Section missing"]
            continue
        body = review[section]
        has = body if isinstance(body, dict) else {}
        missing = [f for f in fields if f not in has]
        found = [f"Missing fields: {', '.join(missing)}"] if missing else []
        found += [f"Invalid {f}: {has[f]}" for (s, f), allowed in ALLOWED.items() if s == section and f in has and has[f] not in allowed]
        found += [f"{f} must be a list" for f in LISTS[section] if f in has and not isinstance(has[f], list)]
        if found:
            out[section] = found
    return out


def confidence(review: dict, cwe: str | None) -> float:
    """Weighted score of a review between 0 and 1."""
    text = json.dumps(review)
    low, size = text.lower(), len(text)
    analysis = review.get("vulnerability_analysis")
    has = analysis if isinstance(analysis, dict) else {}
    lines, severity = has.get("affected_lines", []), has.get("severity", "")
    there = "vulnerability_analysis" in review
    scores = {
        "json_valid": float(not issues(review)),
        "all_fields_present": sum(s in review for s in REQUIRED) / len(REQUIRED),
        "cwe_mentioned": float((cwe or "").lower() in low),
        "line_numbers_valid": (1.0 if isinstance(lines, list) and lines else 0.5) if there else 0.0,
        "reasonable_length": 1.0 if 500 < size < 5000 else 0.3 if size < 200 else 0.7 if size > 10000 else 0.8,
        "no_generic_response": float(not any(p in low for p in GENERIC)),
        "severity_appropriate": (1.0 if isinstance(severity, str) and severity and severity.isupper() else 0.5) if there else 0.0,
    }
    return round(sum(scores[k] * w for k, w in WEIGHTS.items()), 3)


def sql_values(line: str | None) -> list[str | None]:
    """Literals of a dump line ``INSERT INTO t VALUES(...);``: strings, numbers, NULL, and replace(..., char(10)) forms."""
    m = re.match(r"INSERT INTO \S+ VALUES\((.*)\);?\s*$", line or "", re.S)
    if not m:
        return []
    parts, depth, quoted, begin = [], 0, False, 0
    body = m[1]
    for i, c in enumerate(body):
        if c == "'":
            quoted = not quoted
        elif not quoted:
            depth += (c == "(") - (c == ")")
            if c == "," and not depth:
                parts.append(body[begin:i])
                begin = i + 1
    return [sql_literal(x) for x in [*parts, body[begin:]]]


def sql_literal(part: str) -> str | None:
    part = part.strip()
    if part.upper() == "NULL":
        return None
    if m := re.match(r"replace\((.*),\s*'((?:[^']|'')*)'\s*,\s*char\((\d+)\)\)$", part, re.S | re.I):
        inner = sql_literal(m[1])
        return None if inner is None else inner.replace(m[2].replace("''", "'"), chr(int(m[3])))
    value = part[1:-1].replace("''", "'") if len(part) > 1 and part[0] == part[-1] == "'" else part
    return None if value.lower() in ("", "none", "nan") else value
