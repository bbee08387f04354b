"""Web fetch: urls of a table to responses, with bounded concurrency, retries and page classification."""

from __future__ import annotations

import ipaddress
import socket
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import pages

MOST_BYTES = 10 * 1024 * 1024
RETRIES, PAUSE_S, CONCURRENCY, TIMEOUT_S = 2, 1.0, 5, 30.0
#: User agents of the ladder: a plain client first, then two that look like browsers.
PROFILES = (None, "chrome", "firefox")
_AGENTS = {None: "millrace", "chrome": "Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/126.0 Safari/537.36", "firefox": "Mozilla/5.0 (X11; Linux x86_64; rv:127.0) Gecko/20100101 Firefox/127.0"}
SCHEMA = "status int, content_type string, headers map<string,string>, body string, profile string, attempts int, error string"


class _Unchanged(urllib.request.HTTPRedirectHandler):
    """Redirects are answers, not steps to follow: where they lead hasn't been asked for."""

    def redirect_request(self, *args):
        return None


def request(url: str, profile: str | None, timeout_s: float = TIMEOUT_S, allow_private: bool = False) -> dict:
    """One request; status and body whatever the status, OSError where there is no answer.

    Hosts that resolve to private, loopback or reserved addresses are refused unless allow_private.
    """
    parts = urlsplit(url)
    if parts.scheme not in ("http", "https") or not parts.hostname:
        raise ValueError(f"not a web address: {url[:100]}")
    if not allow_private:
        found = {x[4][0] for x in socket.getaddrinfo(parts.hostname, parts.port or 0, type=socket.SOCK_STREAM)}
        if not all(ipaddress.ip_address(a.partition("%")[0]).is_global for a in found):
            raise ValueError(f"private address: {parts.hostname}")
    opener = urllib.request.build_opener(_Unchanged)
    req = urllib.request.Request(url, headers={"User-Agent": _AGENTS[profile]})
    try:
        answer = opener.open(req, timeout=timeout_s)
    except urllib.error.HTTPError as e:
        answer = e
    with answer:
        data = answer.read(MOST_BYTES + 1)
        if len(data) > MOST_BYTES:
            raise ValueError("body over 10 MiB")
        headers = {k.lower(): v for k, v in answer.headers.items()}
        return {"status": answer.status, "content_type": headers.get("content-type", ""), "headers": headers, "body": data.decode("utf-8", "replace"), "profile": profile}


def is_transient(error: Exception) -> bool:
    """Errors that another attempt may not meet: no connection, a reset, a timeout; never a refused address."""
    return isinstance(error, (OSError, TimeoutError)) and not isinstance(error, ValueError)


def attempt(url: str | None, get: Callable[[str, str | None], dict], blocked: Callable[[dict], bool], retries: int = RETRIES, pause_s: float = PAUSE_S) -> dict:
    """A url up the ladder of profiles: on to the next while the answer is a challenge; transient errors are
    retried on the same rung.  What can't be had is an error row, so one url never fails the others."""
    out = dict.fromkeys(("status", "content_type", "headers", "body", "profile", "error")) | {"attempts": 0}
    if not url:
        return out | {"error": "no url"}
    for profile in PROFILES:
        for k in range(retries + 1):
            out["attempts"] += 1
            try:
                out |= get(url, profile) | {"error": None}
                break
            except Exception as e:  # noqa: BLE001  whatever a server does becomes this row's error
                out["error"] = str(e) or type(e).__name__
                if k == retries or not is_transient(e):
                    return out
                time.sleep(pause_s)
        if not blocked(out):
            return out if 200 <= out["status"] < 300 else out | {"error": f"HTTP {out['status']} from {url}"}
    return out | {"error": "blocked: the site asks for a browser"}


def _is_blocked(answer: dict) -> bool:
    return pages.challenge_of(answer["status"], answer["headers"], answer["body"])


def fetch_urls(df: DataFrame, url: str, concurrency: int = CONCURRENCY, retries: int = RETRIES, pause_s: float = PAUSE_S, timeout_s: float = TIMEOUT_S, allow_private: bool = False, get: Callable[[str, str | None], dict] | None = None) -> DataFrame:
    """All rows and columns, with the answer of each url: status, content_type, headers, body, profile, attempts, error.

    Each task keeps `concurrency` requests in the air and holds one batch of answers; a url asked for by several
    rows of a batch is requested once.  get(url, profile) stands in for the network in tests.
    """
    get = get or (lambda u, profile: request(u, profile, timeout_s, allow_private))
    names = df.columns

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(concurrency) as pool:
            for frame in frames:
                for lo in range(0, len(frame), 256):
                    part = frame.iloc[lo : lo + 256].reset_index(drop=True)
                    distinct = list(dict.fromkeys(part[url].where(part[url].notna(), None)))
                    got = dict(zip(distinct, pool.map(lambda u: attempt(u, get, _is_blocked, retries, pause_s), distinct), strict=True))
                    answers = pd.DataFrame([got[None if pd.isna(u) else u] for u in part[url]], dtype=object)
                    yield pd.concat([part[names], answers[["status", "content_type", "headers", "body", "profile", "attempts", "error"]]], axis=1)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(run, f"{kinds}, {SCHEMA}")


def with_query(url: Column, params: dict[str, Column]) -> Column:
    """The url with form-encoded parameters, after those it has."""
    if not params:
        return url
    form = lambda c: F.replace(F.url_encode(c), F.lit("%20"), F.lit("+"))
    pairs = F.concat_ws("&", *[F.concat(form(F.lit(k)), F.lit("="), form(F.coalesce(v.cast("string"), F.lit("")))) for k, v in params.items()])
    return F.concat(url, F.when(F.contains(url, F.lit("?")), "&").otherwise("?"), pairs)
