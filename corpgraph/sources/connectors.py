"""Boundaries to the outside: page fetching and document stores, through callables that the user passes in."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpgraph.operators.ops import not_done

Put = Callable[[str, dict], None]


def fetch_pages(urls: DataFrame, fetch: Callable[[str], str | None], *, attempts: int = 2, pause: float = 0.0) -> DataFrame:
    """url, html, error of each distinct non-empty url. A failure is a value of the row: html is null and error says why.

    ``fetch`` runs in the executors, ``attempts`` times at most, with ``pause`` seconds
    after each call; partitions bound how many run at once.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for url in part["url"]:
                html, error = None, None
                for _ in range(attempts):
                    try:
                        html, error = fetch(url), None
                    except Exception as e:  # noqa: BLE001
                        error = str(e)
                    time.sleep(pause)
                    if html is not None:
                        break
                rows.append((url, html, error))
            yield pd.DataFrame(rows, columns=["url", "html", "error"])

    return urls.select("url").where("url <> ''").distinct().mapInPandas(run, "url string, html string, error string")


def search(queries: DataFrame, find: Callable[[str, int], Sequence[str]], most: int, *, column: str = "query", pause: float = 0.0) -> DataFrame:
    """query, rank (from 1), url, error: the first ``most`` hits of each distinct non-empty query, asked once each.

    ``find(query, most)`` runs in the executors. A failed query is one row with its error and no url.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for q in part["q"]:
                try:
                    rows += [(q, i, url, None) for i, url in enumerate(list(find(q, most))[:most], 1)]
                except Exception as e:  # noqa: BLE001
                    rows.append((q, None, None, str(e)))
                time.sleep(pause)
            yield pd.DataFrame(rows, columns=["query", "rank", "url", "error"]).astype({"rank": "Int32"})

    return queries.select(F.col(column).alias("q")).where("q <> ''").distinct().mapInPandas(run, "query string, rank int, url string, error string")


def list_messages(page: Callable[[str | None], tuple[Sequence[str], str | None]], most: int | None = None) -> Iterator[str]:
    """Message ids of a mailbox, page by page (``page(token)`` gives ids and the next token), ``most`` of them at most."""
    token, left = None, most
    while left is None or left > 0:
        ids, token = page(token)
        yield from ids if left is None else ids[:left]
        left = None if left is None else left - len(ids)
        if not token:
            return


def get_messages(ids: DataFrame, connect: Callable[[], Callable[[str], dict]], seen: DataFrame | None = None) -> DataFrame:
    """message_id, internal_date_ms, payload_json, error of ids that weren't ``seen``; each partition has a connection of its own."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = connect()
        for part in parts:
            rows = []
            for i in part["message_id"]:
                try:
                    m = get(i)
                    rows.append((i, str(m.get("internalDate", "0")), json.dumps(m.get("payload", {})), None))
                except Exception as e:  # noqa: BLE001
                    rows.append((i, None, None, str(e)))
            yield pd.DataFrame(rows, columns=["message_id", "internal_date_ms", "payload_json", "error"])

    return not_done(ids.select("message_id").distinct(), seen, "message_id").mapInPandas(run, "message_id string, internal_date_ms string, payload_json string, error string")


def put_documents(documents: DataFrame, connect: Callable[[], Put]) -> None:
    """Writes (path, json) rows to a document store, each partition over a connection of its own.

    ``connect()`` gives ``put(path, record)``, which must merge into what is there:
    a task that is run again writes the same records to the same paths.
    """

    def send(rows) -> None:
        put = connect()
        for r in rows:
            put(r.path, json.loads(r.json))

    documents.select("path", "json").foreachPartition(send)


def preview(bundles: DataFrame, limit: int = 5) -> list[str]:
    """What a dry run prints: the number of bundles, the first summaries by name, and how many more there are."""
    n = bundles.count()
    heads = bundles.orderBy("company_name").limit(limit).select(F.to_json(F.struct("company_name", "contacts_count", "subsidiaries_count")).alias("j")).collect()
    return [f"{n} bundles", *[r.j for r in heads], *([f"{n - limit} more"] if n > limit else [])]
