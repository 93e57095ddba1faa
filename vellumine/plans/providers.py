"""External calls behind one interface: errors are data, retries stay inside a call.

A provider maps a request (a string) to content.  ``called`` runs one over a
table, partition by partition, and gives each row a call record; nothing is
raised for a failed call.  Without a network only the stub provider runs here.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

RECORD = "provider string, model string, mode string, status int, elapsed_seconds double, usage string, content string, error string"

# Statuses after which a request is sent again.
RETRIED = {408, 429, 500, 502, 503, 504}
# Parts of the messages of a bridge's errors that pass.
TRANSIENT = ("timeout", "timed out", "fetch failed", "temporarily", "rate limit", "429", "502", "503", "504")


class CallError(Exception):
    """A call failed; ``status`` is None for a network error."""

    def __init__(self, message: str, status: int | None = None):
        super().__init__(message)
        self.status = status


@dataclass(frozen=True)
class Reply:
    content: str
    usage: str | None = None
    status: int = 200


Provider = Callable[[str], Reply]


def retried(send: Provider, attempts: int = 3, pause: Callable[[float], None] = time.sleep) -> Provider:
    """``send`` again, after 1, 2, 4 ... seconds, on network errors and on statuses that pass."""

    def call(request: str) -> Reply:
        for k in range(attempts):
            try:
                return send(request)
            except CallError as e:
                if k + 1 == attempts or not (e.status is None or e.status in RETRIED):
                    raise
                pause(2.0**k)
        raise AssertionError("attempts must be positive")

    return call


def retried_by_message(send: Provider, retries: int = 2, pause: Callable[[float], None] = time.sleep) -> Provider:
    """``send`` again, after 1, 2, 4 ... seconds, on errors whose message holds one of ``TRANSIENT``."""

    def call(request: str) -> Reply:
        for k in range(retries + 1):
            try:
                return send(request)
            except Exception as e:
                if k >= retries or not any(x in str(e).lower() for x in TRANSIENT):
                    raise
                pause(2.0**k)
        raise AssertionError("retries must not be negative")

    return call


def with_thinking(payload: dict, provider: str, enable: bool | None) -> dict:
    """``payload`` with the provider's field for thinking; unchanged where ``enable`` is None."""
    if enable is None:
        return payload
    if provider == "deepseek":
        return payload | {"thinking": {"type": "enabled" if enable else "disabled"}}
    return payload | {"enable_thinking": enable}


def stub(request: str) -> Reply:
    """Deterministic answer for tests: the request in upper case, its digest as usage."""
    return Reply(request.upper(), hashlib.sha256(request.encode()).hexdigest()[:8])


def called(df: DataFrame, request: str, make: Callable[[], Provider], provider: str, model: str, mode: str = "exact", into: str = "call") -> DataFrame:
    """``df`` with a call record for each row; ``make`` builds one client for each partition."""
    schema = S.StructType([*df.schema.fields, S.StructField(into, S._parse_datatype_string(RECORD))])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        send = retried(make())
        for frame in frames:
            records = []
            for text in frame[request]:
                began = time.monotonic()
                status = content = error = usage = None
                try:
                    reply = send(text if text is not None else "")
                    status, content, usage = reply.status, reply.content, reply.usage
                except CallError as e:
                    status, error = e.status, str(e)
                records.append({"provider": provider, "model": model, "mode": mode, "status": status, "elapsed_seconds": round(time.monotonic() - began, 3), "usage": usage, "content": content or "", "error": error})
            yield frame.assign(**{into: records})

    return df.mapInPandas(run, schema)


def all_or_nothing(calls: DataFrame, by: str, record: str = "call") -> DataFrame:
    """Groups whose calls all succeeded keep their contents; the others get one error."""
    failed = F.min(F.when(F.col(f"{record}.error").isNotNull(), F.col(f"{record}.error")))
    return calls.groupBy(by).agg(failed.alias("error"), F.when(failed.isNull(), F.array_sort(F.collect_list(F.struct("id", f"{record}.content")))).alias("contents"))
