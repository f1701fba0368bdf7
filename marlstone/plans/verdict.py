"""The verdict over validation rows, the run manifest, and reports. Small tables, folded on the driver."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame

from ..functions.config import CHECK_STATUSES, MODES, RESULTS

AGGREGATE = "validation_gate_result"


def aggregate(rows: list[dict], mode: str) -> dict:
    """The row that closes a run: worst of all statuses that matter in the mode."""
    worst = "PASS"
    for r in rows:
        if r["status"] not in CHECK_STATUSES:
            raise ValueError(f"unknown status {r['status']!r}")
        if r["status"] == "FAIL":
            worst = "FAIL"
        elif r["status"] != "PASS" and worst == "PASS":
            worst = r["status"]
    return {"check_id": AGGREGATE, "severity": "critical", "status": worst, "details": mode}


def blocking(rows: list[dict], mode: str) -> list[dict]:
    """Rows that stop acceptance: failures, and in full mode critical checks that were not evaluated."""
    full = mode == "FULL_VALIDATION"
    return [r for r in rows if r["status"] in ("FAIL", "WORKSPACE_INCOMPLETE") or (full and r["severity"] == "critical" and r["status"] in ("NOT_EVALUATED_MISSING_EVIDENCE", "SKIPPED_LIGHT_PACKAGE"))]


def verdict(rows: list[dict], mode: str, fresh: bool = True) -> tuple[str, str]:
    """(verdict, result). Fails closed: stale artifacts, an unknown mode or status, or no aggregate row mean NO-GO.
    A light review is never a plain GO."""
    known = mode in MODES and all(r["status"] in CHECK_STATUSES for r in rows)
    if not known or not fresh or mode == "WORKSPACE_INCOMPLETE" or sum(r["check_id"] == AGGREGATE for r in rows) != 1 or blocking(rows, mode):
        return "NO-GO", "FAILED"
    if mode == "LIGHT_REVIEW_MODE" or any(r["status"] != "PASS" for r in rows):
        return "GO WITH CAVEATS", "PASSED_WITH_CAVEATS"
    return "GO", "PASSED"


def collected(checks: DataFrame, most: int = 1000) -> list[dict]:
    """The validation table's rows, which are one for each gate."""
    rows = checks.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a validation table has no more than {most} rows")
    return [r.asDict() for r in rows]


def manifest(mode: str, started: str, refreshed: list[str], not_refreshed: list[str], tracked: list[str], commit: str) -> dict:
    return {"mode": mode, "result": "IN_PROGRESS", "started_at_utc": started, "completed_at_utc": None, "source_commit": commit, "refreshed": sorted(refreshed), "not_refreshed": sorted(not_refreshed), "tracked": sorted(tracked)}


def is_utc(value: str | None) -> bool:
    try:
        return value is not None and datetime.fromisoformat(value).utcoffset() == timezone.utc.utcoffset(None)
    except ValueError:
        return False


def commit_base(value: str) -> str:
    return value.split("+", 1)[0]


def manifest_errors(m: dict) -> list[str]:
    """What is wrong with a manifest: modes and results of the lists, times in UTC, artifacts split exactly."""
    out = []
    if m.get("mode") not in MODES:
        out.append("unknown mode")
    if m.get("result") not in RESULTS:
        out.append("unknown result")
    if not is_utc(m.get("started_at_utc")):
        out.append("start is not UTC")
    if m.get("result") != "IN_PROGRESS" and not is_utc(m.get("completed_at_utc")):
        out.append("end is not UTC")
    a, b, whole = m.get("refreshed", []), m.get("not_refreshed", []), m.get("tracked", [])
    if set(a) & set(b) or sorted(a + b) != sorted(whole):
        out.append("artifacts are not split exactly")
    return out


def report(title: str, rows: list[dict], mode: str, fresh: bool = True) -> str:
    """A short report in Markdown."""
    word, result = verdict(rows, mode, fresh)
    lines = [f"# {title}", "", f"Verdict: {word} ({result}), mode {mode}.", "", "| check | severity | status | details |", "|---|---|---|---|"]
    cell = lambda x: str(x).replace("|", "\\|").replace("\n", " ")
    return "\n".join([*lines, *(f"| {' | '.join(cell(r[k]) for k in ('check_id', 'severity', 'status', 'details'))} |" for r in rows)]) + "\n"


def injected(text: str, name: str, block: str) -> str:
    """``text`` with the block between marks of the name, put there or replaced; the same again changes nothing."""
    a, b = f"<!-- {name}:start -->", f"<!-- {name}:end -->"
    whole = f"{a}\n{block.rstrip()}\n{b}"
    if text.count(a) > 1 or text.count(a) != text.count(b):
        raise ValueError("marks do not pair")
    if a in text:
        head, rest = text.split(a, 1)
        return head + whole + rest.split(b, 1)[1]
    return text.rstrip("\n") + "\n\n" + whole + "\n"
