"""Extractors: native, replayed and remote, all with the same result columns."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_field_answer, parse_response, positional_extract
from ..storage import stored

FIELDS = ["vendor", "product", "version", "update", "target_sw"]
MODES = ["single", "per-field"]
PROMPT = "Give vendor, product, version, update and target_sw of this software title as one JSON object."
FIELD_PROMPT = "Give only the {} of this software title, or null."
RETRIES = 2

#: A model's answer to (system, user): text, tokens in and tokens out.
Ask = Callable[[str, str], tuple[str, int, int]]


def positional(titles: DataFrame) -> DataFrame:
    """Entities by position, without any model."""
    return titles.withColumn("_e", positional_extract("title")).select("*", "_e.*", F.lit(None).cast("string").alias("error")).drop("_e")


def replay(titles: DataFrame, answers: DataFrame) -> DataFrame:
    """Entities of recorded answers(title, answer); unknown titles have none."""
    joined = titles.join(answers.select("title", F.col("answer").alias("_a")), "title", "left")
    return joined.withColumn("_e", parse_response(F.coalesce("_a", F.lit("{}")))).select("*", "_e.*").drop("_a", "_e")


def _post(url: str, body: dict, headers: dict, timeout: float) -> dict:
    request = urllib.request.Request(url, data=json.dumps(body).encode(), headers={"Content-Type": "application/json"} | headers)
    with urllib.request.urlopen(request, timeout=timeout) as r:
        return json.load(r)


def _post_with_extras(url: str, body: dict, extras: dict, headers: dict, timeout: float) -> dict:
    """POST with fields that a server may refuse: after a 400 they are left out for good."""
    try:
        return _post(url, body | extras, headers, timeout)
    except urllib.error.HTTPError as e:
        if e.code != 400 or not extras:
            raise
    extras.clear()
    return _post(url, body, headers, timeout)


def chat_completion(url: str, model: str, key: str = "", extras: dict | None = None, max_tokens: int = 300, timeout: float = 120.0) -> Ask:
    """A client of an OpenAI-style chat endpoint."""
    extras = dict(extras or {})

    def ask(system: str, user: str) -> tuple[str, int, int]:
        body = {"model": model, "max_tokens": max_tokens, "messages": [{"role": "system", "content": system}, {"role": "user", "content": user}]}
        d = _post_with_extras(url, body, extras, {"Authorization": f"Bearer {key}"}, timeout)
        usage = d.get("usage") or {}
        return d["choices"][0]["message"]["content"], usage.get("prompt_tokens", 0), usage.get("completion_tokens", 0)

    return ask


def messages_api(url: str, model: str, key: str, max_tokens: int = 300, timeout: float = 60.0) -> Ask:
    """A client of a Messages endpoint."""

    def ask(system: str, user: str) -> tuple[str, int, int]:
        body = {"model": model, "max_tokens": max_tokens, "system": system, "messages": [{"role": "user", "content": user}]}
        d = _post(url, body, {"x-api-key": key, "anthropic-version": "2023-06-01"}, timeout)
        usage = d.get("usage") or {}
        return d["content"][0]["text"], usage.get("input_tokens", 0), usage.get("output_tokens", 0)

    return ask


def local_server(url: str, model: str, reasoning: str | None = "off", max_tokens: int = 300, timeout: float = 120.0) -> Ask:
    """A client of a local model server's own chat endpoint, greedy and without stored chats."""
    extras = {"reasoning": reasoning} if reasoning else {}

    def ask(system: str, user: str) -> tuple[str, int, int]:
        body = {"model": model, "system_prompt": system, "input": user, "max_output_tokens": max_tokens, "temperature": 0.0, "store": False, "stream": False}
        d = _post_with_extras(url, body, extras, {}, timeout)
        text = []
        for item in d.get("output", []):
            if item.get("type") == "message":
                content = item.get("content", "")
                text.append(content if isinstance(content, str) else "".join(p.get("text", "") for p in content if isinstance(p, dict)))
        stats = d.get("stats") or {}
        return "\n".join(text), stats.get("input_tokens", 0), stats.get("total_output_tokens", 0)

    return ask


#: Remote providers by name, each made from url, model and key.
REMOTE: dict[str, Callable[[str, str, str], Ask]] = {
    "openai": lambda url, model, key: chat_completion(url, model, key),
    "messages": lambda url, model, key: messages_api(url, model, key),
    "local": lambda url, model, key: local_server(url, model),
}
PROVIDERS = ["positional", "replay", *REMOTE]


def remote_answers(titles: DataFrame, ask: Ask, per_field: bool = False, retries: int = RETRIES, wait: Callable[[float], None] = time.sleep) -> DataFrame:
    """title, answers, tokens_in, tokens_out, latency_ms and error, one model call (or five) a title.

    A failed call is tried again after 1, 2, 4 and at most 8 seconds.  Give it
    distinct titles: this is the only stage that waits for a service.
    """
    systems = [FIELD_PROMPT.format(f) for f in FIELDS] if per_field else [PROMPT]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for title in b.column(0).to_pylist():
                began, error, answers, n_in, n_out = time.monotonic(), None, [], 0, 0
                for at, system in enumerate(systems):
                    for attempt in range(retries + 1):
                        try:
                            text, i, o = ask(system, title)
                            answers.append(text)
                            n_in, n_out, error = n_in + i, n_out + o, None
                            break
                        except Exception as e:  # a failed call is the row's error
                            error = "provider failed" + (f" ({FIELDS[at]})" if per_field else "") + f": {type(e).__name__}: {e}"
                            if attempt < retries:
                                wait(min(2.0**attempt, 8.0))
                    if error:
                        break
                rows.append((title, None if error else answers, n_in, n_out, int(1000 * (time.monotonic() - began)), error))
            t, a, i, o, ms, e = zip(*rows, strict=True) if rows else ((),) * 6
            yield pa.RecordBatch.from_arrays([pa.array(t, pa.string()), pa.array(a, pa.list_(pa.string())), pa.array(i, pa.int64()), pa.array(o, pa.int64()), pa.array(ms, pa.int64()), pa.array(e, pa.string())], names=["title", "answers", "tokens_in", "tokens_out", "latency_ms", "error"])

    return titles.select("title").mapInArrow(run, "title string, answers array<string>, tokens_in long, tokens_out long, latency_ms long, error string")


def entities_of(answers: DataFrame, per_field: bool = False) -> DataFrame:
    """Parsed entities of remote_answers; a call's error comes before a parse error.

    Answers field by field have no confidence of their own: 0.
    """
    if per_field:
        fields = [clean_field_answer(F.get("answers", F.lit(i))).alias(f) for i, f in enumerate(FIELDS)]
        return answers.select("title", *fields, F.lit(0.0).alias("confidence"), "tokens_in", "tokens_out", "latency_ms", "error")
    e = answers.withColumn("_e", parse_response(F.coalesce(F.get("answers", F.lit(0)), F.lit(""))))
    return e.select("title", *[F.col(f"_e.{f}").alias(f) for f in FIELDS], "_e.confidence", "tokens_in", "tokens_out", "latency_ms", F.coalesce("error", "_e.error").alias("error"))


def extracted(titles: DataFrame, provider: str = "positional", mode: str = "single", ask: Ask | None = None, answers: DataFrame | None = None) -> DataFrame:
    """titles with entities, confidence, tokens_in, tokens_out, latency_ms and error.

    provider is one of PROVIDERS: positional needs nothing, replay recorded
    answers, remote ones a client (ask).  Only remote providers can answer field
    by field; for the others both modes are the same.
    """
    if provider not in PROVIDERS or mode not in MODES:
        raise ValueError(f"choose a provider of {PROVIDERS} and a mode of {MODES}")
    if provider in REMOTE:
        if ask is None:
            raise ValueError(f"{provider} needs a client")
        told = entities_of(stored(remote_answers(titles.select("title").distinct(), ask, mode == "per-field"), "answers"), mode == "per-field")
        return titles.join(told, "title")
    if provider == "replay":
        if answers is None:
            raise ValueError("replay needs recorded answers")
        out = replay(titles, answers)
    else:
        out = positional(titles)
    return out.withColumns({c: F.lit(0).cast("long") for c in ("tokens_in", "tokens_out", "latency_ms")})
