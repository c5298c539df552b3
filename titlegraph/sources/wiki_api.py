"""Wiki API responses, live or captured, as tables; the polite client behind the live ones, and a category as a stream.

    titles = spark.readStream.format("wikicategory").option("api", url).option("category", c).load()
    answers = fetch_pages(titles, {"delay_ms": 2000})

The stream's offsets are the API's continuation tokens: a batch is one answer, at most 500 titles, and a query that is
started again goes on at the token of its checkpoint. Pages are fetched by tasks, one for each API.
"""

from __future__ import annotations

import email.utils
import http.client
import json
import os
import socket
import ssl
import struct
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType

from ..storage import arrow_file

RETRY = {408, 425, 429, 500, 502, 503, 504}
PAGE = "struct<pageid:long,title:string,fullurl:string,missing:string,pageprops:struct<wikibase_item:string>,revisions:array<struct<slots:struct<main:struct<content:string>>>>>"
RESPONSE = f"query struct<pages:map<string,{PAGE}>,redirects:array<struct<from:string,to:string>>,categorymembers:array<struct<pageid:long,title:string>>>"


def setting(given: str | None, env: str, default: str | None = None) -> str | None:
    """Given, else from the environment, else the default."""
    return given or os.environ.get(env) or default


def proxy_setting(given: str | None = None) -> str | None:
    return setting(given, "WIKI_PROXY", os.environ.get("ALL_PROXY"))


def delay_setting(given: str | int | None = None, default: int = 2000) -> int:
    """Milliseconds; the default where what is set is no number of at least 0."""
    raw = os.environ.get("WIKI_DELAY_MS") if given is None else given
    try:
        found = float(raw) if raw not in (None, "") else -1
    except ValueError:
        found = -1
    return int(found) if 0 <= found < float("inf") else default


def socks_connect(proxy: str, host: str, port: int, timeout: float = 60) -> socket.socket:
    """A connection to host:port through a SOCKS5 proxy (socks5://host:port) without a password; names are resolved there."""
    at = urllib.parse.urlsplit(proxy)
    try:
        s = socket.create_connection((at.hostname, at.port or 1080), timeout)
    except ConnectionRefusedError as e:
        raise OSError(f"could not connect to the SOCKS proxy {proxy}") from e

    def read(n: int) -> bytes:
        data = b""
        while len(data) < n:
            piece = s.recv(n - len(data))
            if not piece:
                raise OSError("the SOCKS proxy ended the connection")
            data += piece
        return data

    s.sendall(b"\x05\x01\x00")
    if read(2) != b"\x05\x00":
        raise OSError("the SOCKS proxy wants a password")
    name = host.encode("idna")
    s.sendall(b"\x05\x01\x00\x03" + bytes([len(name)]) + name + struct.pack(">H", port))
    _, code, _, kind = read(4)
    if code:
        raise OSError(f"the SOCKS proxy answered {code}")
    read({1: 4, 4: 16}.get(kind) or read(1)[0])
    read(2)
    return s


class _Socks(urllib.request.HTTPHandler, urllib.request.HTTPSHandler):
    def __init__(self, proxy: str):
        urllib.request.HTTPSHandler.__init__(self)
        self.proxy = proxy

    def _through(self, kind: type, request, tls: bool):
        proxy = self.proxy

        class Connection(kind):
            def connect(self):
                self.sock = socks_connect(proxy, self.host, self.port, self.timeout or 60)
                if tls:
                    self.sock = ssl.create_default_context().wrap_socket(self.sock, server_hostname=self.host)

        return self.do_open(Connection, request)

    def http_open(self, request):
        return self._through(http.client.HTTPConnection, request, False)

    def https_open(self, request):
        return self._through(http.client.HTTPSConnection, request, True)


def captured_fetch(path: str) -> Callable[[str], tuple[int, dict, str]]:
    """A fetch of answers that were captured: a JSON object from a request's sorted query, without format, to a body, or to
    a list of [status, headers, body] that are given one after the other, the last again and again."""
    store, at = arrow_file(path)
    with store.open_input_stream(at) as f:
        held = json.loads(f.read())

    def fetch(url: str) -> tuple[int, dict, str]:
        found = held.get(query_key(urllib.parse.urlsplit(url).query))
        if found is None:
            return 404, {}, ""
        if isinstance(found, list):
            status, headers, body = found.pop(0) if len(found) > 1 else found[0]
            return status, headers, body if isinstance(body, str) else json.dumps(body)
        return 200, {}, found if isinstance(found, str) else json.dumps(found)

    return fetch


def query_key(query: str) -> str:
    return urllib.parse.urlencode(sorted((k, v) for k, v in urllib.parse.parse_qsl(query) if k != "format"))


def wait_ms(header: str | None, attempt: int, delay_ms: int, cap_ms: int = 60_000) -> int:
    """How long to wait before the next attempt: Retry-After in seconds or as a date, else delay * 2^attempt; capped."""
    if header:
        if header.strip().isdigit():
            return min(cap_ms, int(header) * 1000)
        try:
            return min(cap_ms, max(0, int((email.utils.parsedate_to_datetime(header).timestamp() - time.time()) * 1000)))
        except (TypeError, ValueError):
            pass
    return min(cap_ms, delay_ms * 2**attempt)


class Client:
    """get(params) -> JSON: one request at a time, spaced by delay_ms, retried on busy answers. fetch: for tests."""

    def __init__(self, api: str, delay_ms: int = 2000, retries: int = 6, proxy: str | None = None, agent: str = "titlegraph", fetch: Callable | None = None, sleep: Callable = time.sleep):
        self.api, self.delay_ms, self.retries, self.sleep, self.last = api, delay_ms, retries, sleep, 0.0
        socks = (proxy or "").startswith("socks")
        opener = urllib.request.build_opener(urllib.request.ProxyHandler({"https": proxy, "http": proxy} if proxy and not socks else {}), *([_Socks(proxy)] if socks else []))
        self.fetch = fetch or (lambda url: self._open(opener, url, agent))

    @classmethod
    def configured(cls, options: dict) -> Client:
        """From options api, delay_ms, retries, proxy, agent and answers (a file of captured ones), else from the
        environment: WIKI_PROXY, ALL_PROXY, WIKI_DELAY_MS."""
        own = {k.lower(): v for k, v in options.items()}
        fetch = captured_fetch(own["answers"]) if own.get("answers") else None
        return cls(own["api"], delay_setting(own.get("delay_ms")), int(own.get("retries") or 6), proxy_setting(own.get("proxy")), own.get("agent") or "titlegraph", fetch)

    @staticmethod
    def _open(opener, url: str, agent: str) -> tuple[int, dict, str]:
        try:
            with opener.open(urllib.request.Request(url, headers={"User-Agent": agent}), timeout=60) as r:
                return r.status, dict(r.headers), r.read().decode()
        except urllib.error.HTTPError as e:
            return e.code, dict(e.headers), ""

    def get(self, params: dict) -> dict:
        url = f"{self.api}?{urllib.parse.urlencode({'format': 'json', **params})}"
        for attempt in range(self.retries + 1):
            pause = self.last + self.delay_ms / 1000 - time.monotonic()
            if pause > 0:
                self.sleep(pause)
            self.last = time.monotonic()
            status, headers, body = self.fetch(url)
            if status == 200:
                return json.loads(body)
            if status not in RETRY or attempt == self.retries:
                raise OSError(f"status {status}")
            self.sleep(wait_ms(headers.get("Retry-After"), attempt, self.delay_ms) / 1000)
        raise AssertionError

    def member_page(self, category: str, token: str = "") -> tuple[list[dict], str]:
        """One answer about a category's members, and the token of the next; an empty token begins, and ends."""
        got = self.get({"action": "query", "list": "categorymembers", "cmtitle": category, "cmlimit": 500, **({"cmcontinue": token} if token else {})})
        return got.get("query", {}).get("categorymembers", []), got.get("continue", {}).get("cmcontinue", "")

    def members(self, category: str, limit: int | None = None) -> Iterator[str]:
        """Titles in a category, page by page; stops asking at the limit."""
        seen, token = 0, ""
        while True:
            found, token = self.member_page(category, token)
            for m in found:
                yield m["title"]
                seen += 1
                if seen == limit:
                    return
            if not token:
                return

    def responses(self, titles: list[str], batch: int = 50, text: bool = False) -> Iterator[str]:
        """Raw answers about the titles, for captured(): ids, addresses and items, with text also the pages' source."""
        titles = list(dict.fromkeys(titles))
        for i in range(0, len(titles), batch):
            extra = {"rvprop": "content", "rvslots": "main"} if text else {}
            yield json.dumps(self.get({"action": "query", "redirects": 1, "prop": "info|pageprops" + "|revisions" * text, "inprop": "url", "titles": "|".join(titles[i : i + batch]), **extra}))


def captured(raw: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(pages, redirects) of captured answers: pages (title, wikitext, pageId, url, wikidataId), without missing ones."""
    q = raw.select(F.from_json(column, RESPONSE).alias("r")).select("r.query.*")
    pages = q.select(F.explode(F.map_values("pages")).alias("p")).where("p.missing is null and p.pageid is not null")
    text = F.get("p.revisions", F.lit(0))["slots"]["main"]["content"]
    return pages.select("p.title", text.alias("wikitext"), F.col("p.pageid").alias("pageId"), F.col("p.fullurl").alias("url"), F.col("p.pageprops.wikibase_item").alias("wikidataId")), q.select(F.explode("redirects").alias("x")).select(F.col("x.from").alias("source"), F.col("x.to").alias("target"))


def with_members(members: DataFrame, pages: DataFrame, redirects: DataFrame) -> DataFrame:
    """Every member title with its page, under the title that was asked for; null where there is none. Of several redirects
    of a title the last counts, by row_pos where redirects have it, as in normalize.resolve_redirects()."""
    hop = redirects.groupBy(F.col("source").alias("title")).agg(F.max_by("target", "row_pos" if "row_pos" in redirects.columns else "target").alias("to"))
    asked = members.select("title").distinct().join(hop, "title", "left").withColumn("at", F.coalesce("to", "title")).drop("to")
    return asked.join(pages.withColumnRenamed("title", "at"), "at", "left").drop("at")


class _Members(SimpleDataSourceStreamReader):
    """A batch for each answer. An offset is the number of answers so far, the next token, and whether that was the last."""

    def __init__(self, options: dict):
        self.options = options

    def initialOffset(self) -> dict:
        return {"answers": 0, "token": "", "done": False}

    def _rows(self, start: dict) -> tuple[list[tuple], dict]:
        found, token = Client.configured(self.options).member_page(self.options["category"], start["token"])
        rows = [(self.options["api"], self.options["category"], m["title"], m.get("pageid")) for m in found]
        return rows, {"answers": start["answers"] + 1, "token": token, "done": not token}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        if start["done"]:
            return iter([]), start
        rows, end = self._rows(start)
        return iter(rows), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        """A batch again, after a failure."""
        while start["answers"] < end["answers"]:
            rows, start = self._rows(start)
            yield from rows


class WikiCategory(DataSource):
    """A category's titles as a stream. Options: api, category, and those of Client.configured()."""

    @classmethod
    def name(cls) -> str:
        return "wikicategory"

    def schema(self) -> str:
        return "api string, category string, title string, pageid long"

    def simpleStreamReader(self, schema: StructType) -> SimpleDataSourceStreamReader:
        return _Members(dict(self.options))


def fetch_pages(titles: DataFrame, options: dict, text: bool = True, batch: int = 50) -> DataFrame:
    """Raw answers (value), for captured(), about titles (api, title): one task asks an API, politely, one request at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clients: dict[str, Client] = {}
        for b in batches:
            asked: dict[str, list[str]] = {}
            for api, title in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                asked.setdefault(api, []).append(title)
            for api, own in asked.items():
                client = clients.setdefault(api, Client.configured(options | {"api": api}))
                for answer in client.responses(own, batch, text):
                    yield pa.RecordBatch.from_arrays([pa.array([answer], pa.string())], names=["value"])

    return titles.select("api", "title").where("title is not null").repartition("api").mapInArrow(run, "value string")


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WikiCategory)
