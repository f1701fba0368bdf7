"""What a run was made of: package modes, gate order, tree digests, snapshots, and audits of our own code. All
of it is about files beside the data and stays on the driver."""

from __future__ import annotations

import ast
import hashlib
import json
import os
import subprocess
from collections.abc import Callable
from pathlib import Path

from ..sources.fetch import inside, write_atomically
from ..sources.filings import unique_object
from .verdict import commit_base, manifest_errors


def package_mode(root: Path, full: list[str], marker: str) -> tuple[str, list[str]]:
    """FULL_VALIDATION if all files of a full package are there, else LIGHT_REVIEW_MODE if the marker is, else
    WORKSPACE_INCOMPLETE; with what is missing."""
    missing = [p for p in full if not (root / p).exists()]
    if not missing:
        return "FULL_VALIDATION", []
    return ("LIGHT_REVIEW_MODE" if (root / marker).exists() else "WORKSPACE_INCOMPLETE"), missing


def run_gates(gates: dict[str, tuple[list[str], Callable[[], dict]]], have: set[str]) -> list[dict]:
    """Runs each gate whose inputs are there; the others are not evaluated and never called."""
    out = []
    for check_id, (needs, run) in gates.items():
        lost = sorted(set(needs) - have)
        out.append(run() if not lost else {"check_id": check_id, "severity": "critical", "status": "NOT_EVALUATED_MISSING_EVIDENCE", "details": f"missing: {', '.join(lost)}"})
    return out


def tree(root: Path, paths: list[str]) -> tuple[str, dict[str, str]]:
    """The digest over the sorted files, a line for each: path, length, digest; and the digests by path."""
    h, digests = hashlib.sha256(), {}
    for p in sorted(paths):
        content = inside(root, p).read_bytes()
        digests[p] = hashlib.sha256(content).hexdigest()
        h.update(f"{p}\0{len(content)}\0{digests[p]}\n".encode())
    return h.hexdigest(), digests


def git_environment() -> dict[str, str]:
    """The environment without variables that point git elsewhere."""
    return {k: v for k, v in os.environ.items() if not k.startswith("GIT_")} | {"GIT_CONFIG_NOSYSTEM": "1", "GIT_TERMINAL_PROMPT": "0"}


def source_commit(root: Path) -> str:
    run = lambda *a: subprocess.run(["git", "-C", str(root), *a], env=git_environment(), capture_output=True, text=True, check=True).stdout.strip()
    return run("rev-parse", "HEAD") + ("+dirty" if run("status", "--porcelain") else "")


SNAPSHOT = {"state", "mode", "result", "source_commit", "source_tree", "source_files", "artifacts", "reason"}


def publish(root: Path, to: str, manifest: dict, sources: list[str]) -> dict:
    """Writes the snapshot of a finished run and checks it."""
    if manifest_errors(manifest):
        raise ValueError("; ".join(manifest_errors(manifest)))
    digest, files = tree(root, sources)
    _, artifacts = tree(root, manifest["refreshed"])
    snap = {"state": "PUBLISHED", "mode": manifest["mode"], "result": manifest["result"], "source_commit": manifest["source_commit"], "source_tree": digest, "source_files": files, "artifacts": artifacts, "reason": ""}
    write_atomically(inside(root, to), json.dumps(snap, sort_keys=True, indent=1).encode())
    if wrong := verify(root, to):
        raise ValueError("; ".join(wrong))
    return snap


def verify(root: Path, to: str, commit: str | None = None) -> list[str]:
    """What is wrong with a snapshot: its form, sources or artifacts that changed, another commit."""
    try:
        snap = json.loads(inside(root, to).read_text(), object_pairs_hook=unique_object)
    except (OSError, ValueError) as e:
        return [f"unreadable: {e}"]
    if set(snap) != SNAPSHOT:
        return ["other keys than a snapshot has"]
    out = [] if snap["state"] == "PUBLISHED" else [f"state {snap['state']}: {snap['reason']}"]
    for what in ("source_files", "artifacts"):
        for p, sha in snap[what].items():
            path = inside(root, p)
            if not path.is_file() or hashlib.sha256(path.read_bytes()).hexdigest() != sha:
                out.append(f"changed: {p}")
    if commit and commit_base(commit) != commit_base(snap["source_commit"]):
        out.append("another commit")
    return out


def fail(root: Path, to: str, reason: str) -> None:
    """Closes a run that broke: the snapshot says so, whatever it said before."""
    path = inside(root, to)
    try:
        snap = json.loads(path.read_text())
    except (OSError, ValueError):
        snap = {}
    snap = {k: snap.get(k) for k in SNAPSHOT} | {"state": "FAILED", "result": "FAILED", "reason": reason}
    write_atomically(path, json.dumps(snap, sort_keys=True, indent=1).encode())


def literals(source: str) -> set[str]:
    """All strings of a program, those it puts together from constants included."""
    def value(node: ast.AST) -> str | None:
        if isinstance(node, ast.Constant) and isinstance(node.value, (str, int)):
            return str(node.value)
        if isinstance(node, ast.BinOp) and isinstance(node.op, ast.Add):
            a, b = value(node.left), value(node.right)
            return a + b if a is not None and b is not None else None
        if isinstance(node, ast.JoinedStr):
            parts = [value(p.value) if isinstance(p, ast.FormattedValue) else value(p) for p in node.values]
            return "".join(parts) if all(p is not None for p in parts) else None
        return None

    return {v for n in ast.walk(ast.parse(source)) if (v := value(n)) is not None}


def identity_literals(root: Path, files: list[str], identities: list[str]) -> list[tuple[str, str]]:
    """(file, identity): where code names a company of the registry."""
    return [(f, i) for f in files for i in identities if any(i.lower() in s.lower() for s in literals((root / f).read_text()))]


def policy(raw: str) -> dict[str, list[str]]:
    """A policy of source files: the keys ``tracked`` and ``excluded``, sorted lists without repeats, disjoint."""
    p = json.loads(raw, object_pairs_hook=unique_object)
    if set(p) != {"tracked", "excluded"}:
        raise ValueError("a policy has the keys tracked and excluded")
    for k, v in p.items():
        if v != sorted(set(v)) or any(Path(x).is_absolute() or ".." in Path(x).parts for x in v):
            raise ValueError(f"{k}: sorted relative paths without repeats")
    if set(p["tracked"]) & set(p["excluded"]):
        raise ValueError("a path is tracked and excluded")
    return p
