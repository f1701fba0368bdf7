"""Addresses of filings, as driver functions and as columns, and the guard on where requests may go."""

from __future__ import annotations

import re
from urllib.parse import urlsplit

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import accession_no_dash as no_dash_column
from .text import cik10 as cik10_column

# The public hosts and path forms.
HOSTS = ("www.sec.gov", "data.sec.gov")
ARCHIVE = "https://www.sec.gov/Archives/edgar/data"
DATA = "https://data.sec.gov"
TICKERS = "https://www.sec.gov/files/company_tickers_exchange.json"


def cik10(cik: int | str) -> str:
    if not re.fullmatch(r"[0-9]{1,10}", str(cik).strip()) or int(cik) <= 0:
        raise ValueError(f"not a CIK: {cik!r}")
    return f"{int(cik):010d}"


def accession_no_dash(accession: str) -> str:
    plain = accession.replace("-", "")
    if not re.fullmatch(r"[0-9]{18}", plain):
        raise ValueError(f"not an accession number: {accession!r}")
    return plain


def official(url: str) -> str:
    """The address, if it is https on an official host with no user and no port; else an error."""
    parts = urlsplit(url)
    if parts.scheme != "https" or parts.netloc not in HOSTS:
        raise ValueError(f"not an official address: {url!r}")
    return url


def submissions(cik) -> str:
    return f"{DATA}/submissions/CIK{cik10(cik)}.json"


def submissions_file(name: str) -> str:
    if not re.fullmatch(r"CIK[0-9]{10}-submissions-[0-9]{3}\.json", name):
        raise ValueError(f"not a submissions file: {name!r}")
    return f"{DATA}/submissions/{name}"


def companyfacts(cik) -> str:
    return f"{DATA}/api/xbrl/companyfacts/CIK{cik10(cik)}.json"


def companyconcept(cik, taxonomy: str, concept: str) -> str:
    return f"{DATA}/api/xbrl/companyconcept/CIK{cik10(cik)}/{taxonomy}/{concept}.json"


def directory(cik, accession: str) -> str:
    return f"{ARCHIVE}/{int(cik10(cik))}/{accession_no_dash(accession)}"


def index(cik, accession: str) -> str:
    return f"{directory(cik, accession)}/index.json"


def document(cik, accession: str, name: str) -> str:
    return f"{directory(cik, accession)}/{name}"


def _dashed(accession: str) -> str:
    p = accession_no_dash(accession)
    return f"{p[:10]}-{p[10:12]}-{p[12:]}"


def hdr_sgml(cik, accession: str) -> str:
    return f"{directory(cik, accession)}/{_dashed(accession)}.hdr.sgml"


def detail(cik, accession: str) -> str:
    return f"{directory(cik, accession)}/{_dashed(accession)}-index.htm"


def filing_summary(cik, accession: str) -> str:
    return f"{directory(cik, accession)}/FilingSummary.xml"


def document_column(cik: Column, accession: Column, name: Column) -> Column:
    return F.concat_ws("/", F.lit(ARCHIVE), cik10_column(cik).cast("long").cast("string"), no_dash_column(accession), name)


def official_column(url: Column) -> Column:
    return F.coalesce(url.rlike(r"^https://(www|data)\.sec\.gov(/|\?|$)"), F.lit(False))
