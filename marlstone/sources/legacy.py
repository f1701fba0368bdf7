"""Request rows of the older form as rows of the ledger: a projection; what an old path was relative to is
worked out once for a row's body and headers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import accession_dashed
from .fetch import FIELDS, Ledger

#: The columns that tell a request row of the older form.
OLD_FIELDS = ("url", "local_path", "headers_path", "sha256")


def portable(rows: DataFrame, roots: list[str]) -> DataFrame:
    """(url, local_path, headers_path, sha256, …) to (source_url, repo_relative_path, headers_repo_relative_path,
    content_sha256, …). Paths lose the first of ``roots`` that both have; paths below none are null."""
    under = lambda p: F.coalesce(*[F.when(F.startswith(p, F.lit(r.rstrip("/") + "/")), F.lit(r.rstrip("/") + "/")) for r in roots], F.lit(None).cast("string"))
    body, head = under(F.col("local_path")), under(F.col("headers_path"))
    same = body.eqNullSafe(head) | F.col("headers_path").isNull()
    cut = lambda p: F.when(body.isNotNull() & same, F.expr(f"substring({p}, length(_root) + 1)"))
    x = rows.withColumn("_root", body)
    accession = accession_dashed(F.regexp_extract("url", r"/([0-9]{18})(?:/|$)", 1))
    renamed = x.withColumns({"source_url": F.col("url"), "repo_relative_path": cut("local_path"), "headers_repo_relative_path": cut("headers_path"), "content_sha256": F.lower("sha256"), "accession": F.coalesce(F.nullif("accession", F.lit("")), accession)})
    return renamed.drop("url", "local_path", "headers_path", "sha256", "_root")


def bootstrap(ledger: Ledger, fields: Sequence[str], rows: list[dict], authorized: bool = False) -> str:
    """Starts a ledger from projected rows of the older form, ``fields`` being the columns they were read with. Only
    an empty folder may be started, only from the older form, and only with explicit authorization; a ledger that
    is there must prove itself first and is then left alone, its digest returned."""
    if ledger.folder.exists() and any(ledger.folder.iterdir()):
        parts, manifests = ({p.stem for p in ledger.folder.glob(f"part-*.{kind}")} for kind in ("csv", "json"))
        if parts != manifests:
            raise FileNotFoundError(f"parts without manifests, or manifests without parts: {sorted(parts ^ manifests)}")
        if parts:
            return ledger.verify()
    if set(fields) >= set(FIELDS):
        raise FileNotFoundError("rows of the present form need their ledger, not a new one")
    if not set(fields) >= set(OLD_FIELDS):
        raise ValueError(f"neither form: {list(fields)}")
    if not authorized:
        raise PermissionError("starting a ledger from older rows needs explicit authorization")
    return ledger.append(rows)
