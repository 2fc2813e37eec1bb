"""HTTP scan: batches of URLs through a bounded pool of threads in each task, with retries."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from http.client import HTTPConnection, HTTPSConnection

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Fetch
from ..schema import first_reason, working


@dataclass
class Response:
    status: int
    url: str
    content_type: str
    body: str


def _opener(connect_s: float, read_s: float) -> urllib.request.OpenerDirector:
    """Follows redirects; connections have a time limit of their own, and then the one of reads."""

    def timed(base):
        class Timed(base):
            def connect(self):
                self.timeout = connect_s
                super().connect()
                self.sock.settimeout(read_s)

        return Timed

    class Plain(urllib.request.HTTPHandler):
        def http_open(self, request):
            return self.do_open(timed(HTTPConnection), request)

    class Secure(urllib.request.HTTPSHandler):
        def https_open(self, request):
            return self.do_open(timed(HTTPSConnection), request)

    return urllib.request.build_opener(Plain, Secure)


def get(url: str, cfg: Fetch) -> Response:
    """One GET that follows redirects."""
    request = urllib.request.Request(url, headers={"User-Agent": cfg.user_agent})
    try:
        with _opener(cfg.connect_timeout_s, cfg.timeout_s).open(request) as r:
            raw, kind = r.read(), r.headers.get("Content-Type", "")
            return Response(r.status, r.url, kind, raw.decode(r.headers.get_content_charset() or "utf-8", "replace"))
    except urllib.error.HTTPError as e:
        return Response(e.code, e.url, e.headers.get("Content-Type", ""), "")


# Seconds to wait after the first failure, more by as many after each, up to a limit.
BACK_OFF_S, MOST_BACK_OFF_S = 2, 8

_FETCHED = "input_pos long, status_code int, final_url string, content_type string, html string, fetched_at long, fetch_error string"


def _one(pos: int, url: str, cfg: Fetch, call: Callable[[str, Fetch], Response], sleep: Callable[[float], None]) -> tuple:
    error = None
    for attempt in range(cfg.max_retries + 1):
        try:
            r = call(url, cfg)
            return pos, r.status, r.url, r.content_type, r.body, int(time.time()), None
        except Exception as e:  # noqa: BLE001  whatever goes wrong is tried again and then recorded
            error = f"{type(e).__name__}: {e}"
            sleep(min(BACK_OFF_S * (attempt + 1), MOST_BACK_OFF_S))
    return pos, None, None, None, None, None, error


def fetch(urls: DataFrame, cfg: Fetch, call: Callable[[str, Fetch], Response] = get, tasks: int | None = None, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """The working record of each URL (input_pos, url, domain), with status, type and page or a drop reason.

    ``max_concurrency`` bounds requests over the whole run: it is shared out among the tasks. A
    retried task fetches again, so write the result before using it twice.
    """
    tasks = max(1, min(tasks or urls.sparkSession.sparkContext.defaultParallelism, cfg.max_concurrency))
    threads = max(1, cfg.max_concurrency // tasks)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(threads) as pool:
            for batch in batches:
                rows = list(pool.map(lambda r: _one(r[0], r[1], cfg, call, sleep), zip(batch["input_pos"], batch["url"])))
                out = pd.DataFrame(rows, columns=[c.split()[0] for c in _FETCHED.split(", ")])
                out["status_code"], out["fetched_at"] = out["status_code"].astype("Int32"), out["fetched_at"].astype("Int64")
                yield out

    got = urls.select("input_pos", "url").repartition(tasks).mapInPandas(run, _FETCHED)
    return judged(working(urls.select("input_pos", "url", "domain").join(got, "input_pos")), cfg)


def judged(fetched: DataFrame, cfg: Fetch) -> DataFrame:
    """Drop codes of responses; the page of a dropped one is not kept."""
    kind = F.lower(F.coalesce("content_type", F.lit("")))
    accepted = F.lit(False)
    for a in cfg.accept_content_types:
        accepted = accepted | F.contains(kind, F.lit(a))
    rules = [
        ("fetch_failed", F.col("status_code").isNull(), F.col("fetch_error")),
        ("http_error", F.col("status_code") >= 400, F.concat(F.lit("status="), F.col("status_code").cast("string"))),
        ("bad_content_type", ~accepted, F.col("content_type")),
    ]
    out = fetched.withColumn("drop", first_reason("fetch", rules))
    return out.withColumn("html", F.when(F.col("drop").isNull(), F.col("html")))


def pages_table(pages: DataFrame, filtered: DataFrame | None = None) -> DataFrame:
    """Offline scan: a table of pages (page_id, url, html) as fetched rows, for the URLs of ``filtered`` if given."""
    rows = pages.select(F.col("page_id").alias("input_pos"), "url", F.col("url").alias("final_url"), "html", F.lit(200).alias("status_code"), F.lit("text/html").alias("content_type"), F.lit(0).cast("long").alias("fetched_at"))
    if filtered is not None:
        rows = rows.drop("url").join(filtered.select("input_pos", "url", "domain"), "input_pos")
    return working(rows)
