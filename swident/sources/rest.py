"""Paged services as Python data sources: dictionary, graph and CVE pages.

Readers back off on throttling, pause between requests as the services ask for
(0.7 s with a key, 6.5 s without), end at the service's total, and use one
partition, as the services limit the rate of a caller, not of a connection.
A `fetch` option names an importable function(start, size) for other transports.
"""

from __future__ import annotations

import base64
import importlib
import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

THROTTLED = (403, 429)


def http_json(url: str, params: dict, headers: dict, attempts: int = 5, longest: float = 120.0, sleep: Callable[[float], None] = time.sleep) -> dict | None:
    """GET as JSON; None for 404; waits min(30 k, longest) s when throttled."""
    for k in range(1, attempts + 1):
        try:
            request = urllib.request.Request(f"{url}?{urllib.parse.urlencode(params)}", headers=headers)
            with urllib.request.urlopen(request, timeout=60) as r:
                return json.load(r)
        except urllib.error.HTTPError as e:
            if e.code == 404:
                return None
            if e.code not in THROTTLED or k == attempts:
                raise
            sleep(min(30.0 * k, longest))
    return None


def default_pause(apikey: str | None) -> float:
    return 0.7 if apikey else 6.5


def paced(fetch: Callable[..., dict | None], pause: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> Callable[..., dict | None]:
    """fetch with at least `pause` seconds from one call to the next."""
    last: list[float] = []

    def call(*args: object) -> dict | None:
        if last and (wait := last[0] + pause - clock()) > 0:
            sleep(wait)
        last[:] = [clock()]
        return fetch(*args)

    return call


def pages(fetch: Callable[[int, int], dict | None], size: int, start: int = 0, most: int | None = None) -> Iterator[tuple[int, dict]]:
    """(start, page) from `start` to the total, or until `most` rows were given; an empty page is the last."""
    given = 0
    while True:
        page = fetch(start, size)
        if page is None:
            return
        yield start, page
        step = int(page.get("resultsPerPage") or 0)
        if not step:
            return
        given += step
        start += step
        if start >= int(page.get("totalResults", 0)) or (most is not None and given >= most):
            return


def products(page: dict) -> Iterator[tuple]:
    """cpeName, cpeNameId, title and deprecated of a page's products."""
    for p in page.get("products", []):
        c = p.get("cpe", p)
        titles = c.get("titles", [])
        english = next((t.get("title", "") for t in titles if t.get("lang") == "en"), None)
        title = english if english is not None else (titles[0].get("title", "") if titles else "")
        yield c.get("cpeName", ""), c.get("cpeNameId", ""), title, bool(c.get("deprecated", False))


def graph_page(rows: list[dict], total: int) -> dict:
    """Graph rows (cpeName, vendor, product, version) in the shape of a service page."""
    named = lambda r: " ".join(str(r[k]) for k in ("vendor", "product", "version") if r.get(k) not in (None, "", "*"))
    return {"totalResults": total, "resultsPerPage": len(rows), "products": [{"cpe": {"cpeName": r["cpeName"], "cpeNameId": r.get("cpeNameId", ""), "titles": [{"title": named(r), "lang": "en"}], "deprecated": bool(r.get("deprecated", False))}} for r in rows]}


def graph_fetch(post: Callable[[str, dict], dict]) -> Callable[[int, int], dict]:
    """Pages of a graph database's platforms by SKIP and LIMIT, ordered by id; they are counted once.

    post sends a statement with its parameters and gives the transaction's answer.
    """
    total: list[int] = []

    def fetch(start: int, size: int) -> dict:
        if not total:
            total.append(int(post("MATCH (p:Platform) RETURN count(*)", {})["results"][0]["data"][0]["row"][0]))
        wanted = "p.cpeUri, p.cpeNameId, p.deprecated, p.vendor, p.product, p.version"
        got = post(f"MATCH (p:Platform) RETURN {wanted} ORDER BY p.cpeNameId SKIP $skip LIMIT $limit", {"skip": start, "limit": size})
        names = ("cpeName", "cpeNameId", "deprecated", "vendor", "product", "version")
        return graph_page([dict(zip(names, d["row"], strict=True)) for d in got["results"][0]["data"]], total[0])

    return fetch


def graph_post(url: str, user: str, password: str, database: str = "neo4j", timeout: float = 300.0) -> Callable[[str, dict], dict]:
    """Sends statements to a graph database's transactional HTTP endpoint."""
    login = base64.b64encode(f"{user}:{password}".encode()).decode()

    def post(statement: str, parameters: dict) -> dict:
        body = json.dumps({"statements": [{"statement": statement, "parameters": parameters}]}).encode()
        headers = {"Content-Type": "application/json", "Authorization": f"Basic {login}"}
        with urllib.request.urlopen(urllib.request.Request(f"{url.rstrip('/')}/db/{database}/tx/commit", data=body, headers=headers), timeout=timeout) as r:
            answer = json.load(r)
        if answer.get("errors"):
            raise RuntimeError(f"graph database: {answer['errors']}")
        return answer

    return post


def _fetcher(options: dict) -> Callable[[int, int], dict | None]:
    if name := options.get("fetch"):
        module, _, attr = name.rpartition(".")
        return paced(getattr(importlib.import_module(module), attr), float(options.get("pause", 0)))
    if graph := options.get("graph"):
        return graph_fetch(graph_post(graph, options.get("user", "neo4j"), options.get("password", ""), options.get("database", "neo4j")))
    headers = {"apiKey": options["apikey"]} if options.get("apikey") else {}
    extra = json.loads(options.get("params", "{}"))
    pause = float(options.get("pause", default_pause(options.get("apikey"))))
    return paced(lambda start, size: http_json(options["url"], extra | {"startIndex": start, "resultsPerPage": size}, headers), pause)


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        o = self.options
        most = int(o["most"]) if "most" in o else None
        for start, page in pages(_fetcher(o), int(o.get("pagesize", 2000)), int(o.get("start", 0)), most):
            yield from numbered(start, page)


class _StreamReader(SimpleDataSourceStreamReader):
    """Each batch is one page; the offset is the next start index, so a stopped build goes on there."""

    def __init__(self, options: dict) -> None:
        self.options = options
        self.fetch = _fetcher(options)

    def initialOffset(self) -> dict:
        return {"start": int(self.options.get("start", 0)), "total": -1}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        if 0 <= start["total"] <= start["start"]:
            return iter(()), start
        page = self.fetch(start["start"], int(self.options.get("pagesize", 2000)))
        rows = list(numbered(start["start"], page)) if page else []
        return iter(rows), {"start": start["start"] + len(rows), "total": int((page or {}).get("totalResults", 0))}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        page = self.fetch(start["start"], end["start"] - start["start"])
        return numbered(start["start"], page or {})

    def commit(self, end: dict) -> None:
        pass


def numbered(start: int, page: dict) -> Iterator[tuple]:
    """products() of a page with their place in the whole."""
    return ((*row, start + i) for i, row in enumerate(products(page)))


class DictionarySource(DataSource):
    """spark.read or readStream.format("cpe_dictionary"): the pages of a dictionary service or graph."""

    @classmethod
    def name(cls) -> str:
        return "cpe_dictionary"

    def schema(self) -> str:
        return "cpeName string, cpeNameId string, title string, deprecated boolean, ord long"

    def reader(self, schema: object) -> DataSourceReader:
        return _Reader(dict(self.options))

    def simpleStreamReader(self, schema: object) -> SimpleDataSourceStreamReader:
        return _StreamReader(dict(self.options))


def cve_items(names: DataFrame, fetch_of: Callable[[str], Callable[[int, int], dict | None]], pause: float = 0.0, most: int = 2000, size: int = 200) -> DataFrame:
    """(cpe, payload, error): the CVE items of each distinct name as a JSON array.

    fetch_of makes the page fetcher of a name.  One task asks, as the service
    limits the rate of a caller; a failed request is the name's error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wait = paced(lambda fetch, start, n: fetch(start, n), pause)
        for b in batches:
            rows = []
            for cpe in b.column(0).to_pylist():
                items, error = [], None
                try:
                    fetch = fetch_of(cpe)
                    for _, page in pages(lambda start, n, f=fetch: wait(f, start, n), size, most=most):
                        items += [v["cve"] for v in page.get("vulnerabilities", [])]
                except Exception as e:  # a failed request is the name's error
                    error = f"api error: {e}"
                rows.append((cpe, None if error else json.dumps(items), error))
            c, p, e = zip(*rows, strict=True) if rows else ((),) * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()), pa.array(p, pa.string()), pa.array(e, pa.string())], names=["cpe", "payload", "error"])

    return names.select("cpe").distinct().coalesce(1).mapInArrow(run, "cpe string, payload string, error string")


def cve_service(url: str, apikey: str = "") -> Callable[[str], Callable[[int, int], dict | None]]:
    """fetch_of for cve_items() over the public service."""
    headers = {"apiKey": apikey} if apikey else {}

    def fetch_of(cpe: str) -> Callable[[int, int], dict | None]:
        return lambda start, size: http_json(url, {"cpeName": cpe, "isVulnerable": "", "startIndex": start, "resultsPerPage": size}, headers)

    return fetch_of


def register(spark: SparkSession) -> None:
    spark.dataSource.register(DictionarySource)


def build_snapshot(spark: SparkSession, out: str, checkpoint: str, **options: str) -> None:
    """Dump the whole dictionary below `out` as JSON lines, page by page.

    Each page is committed with the next start index in the checkpoint: after an
    interruption the same call goes on from the last whole page.
    """
    register(spark)
    stream = spark.readStream.format("cpe_dictionary").options(**options).load()
    query = stream.writeStream.format("json").option("path", out).option("compression", "gzip").option("checkpointLocation", checkpoint).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
