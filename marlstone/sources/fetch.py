"""The driver's client for landing bytes: paced, audited, without redirects; files by their content's digest; a
ledger that only grows. Spark reads what is landed here."""

from __future__ import annotations

import csv
import fcntl
import hashlib
import http.client
import io
import json
import os
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone
from pathlib import Path

from ..functions.urls import official
from .filings import LEDGER, unique_object

FIELDS = [part.split()[0] for part in LEDGER.split(", ")]
RETRIED = frozenset({403, 429, 500, 502, 503, 504})
REQUIRED = ("user_agent", "rate_limit_per_sec", "max_retries", "initial_backoff_sec", "timeout_sec")


def load_config(path: Path) -> dict:
    raw = json.loads(Path(path).read_text(), object_pairs_hook=unique_object)
    return {k: raw[k] for k in REQUIRED}


def write_atomically(path: Path, content: bytes) -> None:
    """A sibling file takes the place of the old one; what is read back is what was written."""
    path.parent.mkdir(parents=True, exist_ok=True)
    temp = path.with_name(f".{path.name}.{uuid.uuid4().hex}")
    try:
        with temp.open("xb") as f:
            f.write(content)
            f.flush()
            os.fsync(f.fileno())
        os.replace(temp, path)
    finally:
        temp.unlink(missing_ok=True)
    if path.read_bytes() != content:
        raise OSError(f"{path} reads back otherwise")


def inside(root: Path, relative: str) -> Path:
    """A path below the root, with no step out of it and no link on the way."""
    path = root / relative
    if Path(relative).is_absolute() or ".." in Path(relative).parts:
        raise ValueError(f"not below the root: {relative}")
    for p in [path, *path.parents]:
        if p == root:
            break
        if p.is_symlink():
            raise ValueError(f"a link on the way: {p}")
    return path


def write_immutable(root: Path, name: str, content: bytes) -> str:
    """Keeps the bytes under their digest; the same again is fine, other bytes in the place are an error."""
    sha = hashlib.sha256(content).hexdigest()
    relative = f"request_attempts/{sha[:2]}/{sha}/{name}"
    path = inside(root, relative)
    path.parent.mkdir(parents=True, exist_ok=True)
    temp = path.with_name(f".{uuid.uuid4().hex}")
    temp.write_bytes(content)
    try:
        os.link(temp, path)
    except FileExistsError:
        if path.read_bytes() != content:
            raise ValueError(f"{relative} holds other bytes") from None
    finally:
        temp.unlink()
    return relative


@contextmanager
def locked(path: Path):
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.with_name(f".{path.name}.lock").open("w") as f:
        fcntl.flock(f, fcntl.LOCK_EX)
        yield


class Ledger:
    """Requests in batches of files that are never written again, each with the digest of all before it. An append
    costs its own rows, not those of the whole ledger."""

    def __init__(self, folder: Path):
        self.folder = Path(folder)

    def _parts(self) -> list[Path]:
        return sorted(self.folder.glob("part-*.csv"))

    def verify(self) -> str:
        """The digest of the chain; an error if a part is not what its manifest says, or is missing."""
        last = ""
        for i, part in enumerate(self._parts()):
            m = json.loads(part.with_suffix(".json").read_text(), object_pairs_hook=unique_object)
            content = part.read_bytes()
            own = hashlib.sha256((last + hashlib.sha256(content).hexdigest()).encode()).hexdigest()
            if m != {"seq": i, "rows": content.count(b"\n") - 1, "previous": last, "digest": own}:
                raise ValueError(f"{part.name} is not what its manifest says")
            last = own
        return last

    def append(self, rows: list[dict]) -> str:
        for r in rows:
            if set(r) != set(FIELDS) or any("\n" in str(v) or "\r" in str(v) for v in r.values()):
                raise ValueError("a row has other fields, or a line break")
        with locked(self.folder / "ledger"):
            last, n = self.verify(), len(self._parts())
            out = io.StringIO()
            w = csv.DictWriter(out, FIELDS, lineterminator="\n")
            w.writeheader()
            w.writerows(rows)
            content = out.getvalue().encode()
            own = hashlib.sha256((last + hashlib.sha256(content).hexdigest()).encode()).hexdigest()
            part = self.folder / f"part-{n:08d}.csv"
            write_atomically(part.with_suffix(".json"), json.dumps({"seq": n, "rows": len(rows), "previous": last, "digest": own}).encode())
            write_atomically(part, content)
            return own


class _Stay(urllib.request.HTTPRedirectHandler):
    def redirect_request(self, *args):
        return None


def transport(url: str, user_agent: str, timeout: float) -> tuple[int, bytes, dict]:
    """Status, body and headers; a redirect is an answer like any other."""
    opener = urllib.request.build_opener(_Stay)
    try:
        with opener.open(urllib.request.Request(url, headers={"User-Agent": user_agent}), timeout=timeout) as r:
            return r.status, r.read(), dict(r.headers)
    except urllib.error.HTTPError as e:
        return e.code, e.read(), dict(e.headers)


@dataclass
class Result:
    url: str
    status: int
    body: bytes
    path: str | None
    error: str = ""


class Client:
    def __init__(self, root: Path, config: dict, send: Callable = transport, sleep: Callable = time.sleep, clock: Callable = time.monotonic):
        self.root, self.config, self.send, self.sleep, self.clock = Path(root), config, send, sleep, clock
        self.ledger, self.last = Ledger(self.root / "ledger"), None

    def _pace(self) -> None:
        if self.last is not None:
            self.sleep(max(0.0, 1 / self.config["rate_limit_per_sec"] - (self.clock() - self.last)))
        self.last = self.clock()

    def fetch(self, url: str, purpose: str, name: str, accession: str = "") -> Result:
        """Fetches with retries; each attempt is a row of the ledger. A failure of transport has status 0 and is
        not tried again; one of the disk is recorded and raised."""
        official(url)
        inside(self.root, name)
        delay = self.config["initial_backoff_sec"]
        for attempt in range(self.config["max_retries"] + 1):
            self._pace()
            result = self._once(url, purpose, name, accession, attempt)
            if result.status not in RETRIED or attempt == self.config["max_retries"]:
                return result
            self.sleep(delay)
            delay *= 2
        raise AssertionError

    def _once(self, url: str, purpose: str, name: str, accession: str, attempt: int) -> Result:
        row = dict.fromkeys(FIELDS, "") | {"timestamp_utc": datetime.now(timezone.utc).isoformat(), "method": "GET", "source_url": url, "purpose": purpose, "accession": accession, "document_name": Path(name).name, "user_agent": self.config["user_agent"], "retry_attempt": attempt}
        try:
            status, body, head = self.send(url, self.config["user_agent"], self.config["timeout_sec"])
        except (OSError, http.client.HTTPException) as e:
            self.ledger.append([row | {"status_code": 0, "error": " ".join(str(e).split()) or type(e).__name__}])
            return Result(url, 0, b"", None, str(e))
        sha = hashlib.sha256(body).hexdigest()
        try:
            path = write_immutable(self.root, Path(name).name, body)
            sidecar = {"url": url, "status_code": status, "headers": head, "content_length": len(body), "sha256": sha, "saved_at_utc": row["timestamp_utc"]}
            headers = write_immutable(self.root, f"{Path(name).name}.headers.json", json.dumps(sidecar, sort_keys=True).encode())
            if status == 200:
                write_atomically(inside(self.root, name), body)
        except (OSError, ValueError) as e:
            self.ledger.append([row | {"status_code": 0, "error": f"not kept: status {status}, {len(body)} bytes, {sha}: {' '.join(str(e).split())}"}])
            raise
        self.ledger.append([row | {"status_code": status, "repo_relative_path": path, "headers_repo_relative_path": headers, "content_length": len(body), "content_sha256": sha}])
        return Result(url, status, body, path)
