"""The plug for a language model: any callable from prompts to answers, run over Arrow batches. The default works offline."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from tidewell.contracts import log

_CLIENTS: dict[str, Callable[[], Callable[[str], str]]] = {}
_FENCE = re.compile(r"```(?:json)?\s*(.*?)```", re.S)


def register_client(name: str):
    """Register a factory of clients; a client is made once a task and answers one prompt at a call."""

    def put(f: Callable[[], Callable[[str], str]]):
        _CLIENTS[name] = f
        return f

    return put


@register_client("offline")
def offline() -> Callable[[str], str]:
    """Answers with an empty object, so every dimension stays without a value."""
    return lambda prompt: "{}"


def client(name: str) -> Callable[[], Callable[[str], str]]:
    if name not in _CLIENTS:
        raise ValueError(f"no client {name!r}; there are {', '.join(sorted(_CLIENTS))}")
    return _CLIENTS[name]


def extract_json(text: str | None) -> str | None:
    """The JSON in an answer: of a fenced block, else from the first bracket that can be decoded; null without one."""
    if not text:
        return None
    for part in [*_FENCE.findall(text), text]:
        for m in re.finditer(r"[{\[]", part):
            try:
                found, _ = json.JSONDecoder().raw_decode(part[m.start() :])
            except ValueError:
                continue
            return json.dumps(found, ensure_ascii=False)
    return None


def complete(df: DataFrame, prompt: str, make: Callable[[], Callable[[str], str]] = offline, answer: str = "answer", retries: int = 3, wait: float = 1.0) -> DataFrame:
    """df with the model's JSON answer to the column `prompt` and answer_error; a failed call is tried again, then noted, and never ends the job.

    Each different prompt of a batch is asked once. Null prompts get null.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = make()
        for b in batches:
            known: dict[str, tuple[str | None, str | None]] = {}
            failed, last = 0, None
            for p in b[prompt].dropna().unique():
                error = None
                for k in range(retries):
                    try:
                        known[p] = (extract_json(ask(p)), None)
                        break
                    except Exception as e:  # noqa: BLE001
                        error = str(e)
                        if k + 1 < retries:
                            time.sleep(wait * 2**k)
                else:
                    failed, last = failed + 1, error
                    known[p] = (None, error)
            if failed:
                log.warning("%d prompts of a batch failed, the last one: %s", failed, last)
            pairs = [known.get(p, (None, None)) for p in b[prompt]]
            yield b.assign(**{answer: [a for a, _ in pairs], f"{answer}_error": [e for _, e in pairs]})

    return df.mapInPandas(run, f"{schema}, {answer} string, {answer}_error string")


def fill(template: str, **columns):
    """A prompt column: {name} replaced by the columns given."""
    from pyspark.sql import functions as F

    out = F.lit(template)
    for name, c in columns.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(c.cast("string"), F.lit("null")))
    return out
