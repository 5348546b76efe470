"""Model calls: providers by type, errors that may be retried, outcomes as a struct column."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Attempts, seconds of the first wait, and how much longer a rate limit waits.
ATTEMPTS, BACKOFF, RATE_LIMIT = 3, 2.0, 3
OUTCOME = "reply string, attempts int, error string, provider_unavailable boolean, input_tokens long, output_tokens long"


class ProviderError(RuntimeError):
    """A call that failed. unavailable: the provider could not be reached (no connection, 429 or 5xx), which
    is always worth a retry; retryable: another try may go better."""

    def __init__(self, text: str, retryable: bool = False, status: int | None = None):
        super().__init__(text)
        self.status = status
        self.unavailable = status is not None and (status == 429 or status >= 500) or isinstance(self, Unreachable)
        self.retryable = retryable or self.unavailable


class Unreachable(ProviderError):
    """No connection, or none in time."""


@dataclass
class Completion:
    text: str
    input_tokens: int = 0
    output_tokens: int = 0


@dataclass
class Stub:
    """Answers every session with the same shape, for tests and dry runs."""

    name: str = "stub"

    def complete(self, system: str, user: str, timeout: float) -> Completion:
        return Completion(json.dumps({"asked": user[:80], "done": ["nothing recorded"]}), len(user) // 4, 20)


@dataclass
class Chat:
    """An HTTP endpoint of chat completions; send(url, body, timeout) posts JSON and returns it with the
    status, so that any transport serves."""

    url: str
    model: str
    send: Callable[[str, dict, float], tuple[int, dict]]
    name: str = "chat"

    def complete(self, system: str, user: str, timeout: float) -> Completion:
        body = {"model": self.model, "messages": [{"role": "system", "content": system}, {"role": "user", "content": user}]}
        try:
            status, answer = self.send(self.url, body, timeout)
        except OSError as e:
            raise Unreachable(str(e)) from e
        if status != 200:
            raise ProviderError(f"status {status}", status=status)
        try:
            use = answer.get("usage", {})
            return Completion(answer["choices"][0]["message"]["content"], use.get("prompt_tokens", 0), use.get("completion_tokens", 0))
        except (KeyError, IndexError, TypeError, AttributeError) as e:
            raise ProviderError("an answer without a message", retryable=True) from e


@dataclass
class Command:
    """A program that reads the prompt and prints the reply; run(argv, text, timeout) starts it."""

    argv: list[str]
    run: Callable[[list[str], str, float], tuple[int, str]]
    name: str = "command"

    def complete(self, system: str, user: str, timeout: float) -> Completion:
        code, out = self.run(self.argv, f"{system}\n\n{user}", timeout)
        if code:
            raise ProviderError(f"exit {code}", retryable=True)
        return Completion(out)


PROVIDERS: dict[str, Callable] = {"stub": Stub, "chat": Chat, "command": Command}


def provider(kind: str, **options):
    if kind not in PROVIDERS:
        raise ValueError(f"unknown provider type {kind}")
    return PROVIDERS[kind](**options)


@dataclass
class Outcome:
    reply: str | None = None
    attempts: int = 0
    errors: list[str] = field(default_factory=list)
    provider_unavailable: bool = False
    input_tokens: int = 0
    output_tokens: int = 0


def attempt(call: Callable[[str], Completion], check: Callable[[str], str | None], attempts: int = ATTEMPTS, backoff: float = BACKOFF, sleep: Callable[[float], None] = time.sleep) -> Outcome:
    """Calls until a reply passes the check, with longer waits after each failure. call gets a reminder of
    what was wrong with the last reply; check says what is wrong, or None. A failure that cannot be
    retried ends it, and the outcome says whether the last word was that nobody could be reached."""
    out, reminder = Outcome(), ""
    for k in range(1, attempts + 1):
        out.attempts = k
        try:
            got = call(reminder)
        except ProviderError as e:
            out.errors.append(str(e))
            if not e.retryable or k == attempts:
                out.provider_unavailable = e.unavailable
                break
            sleep(backoff * k * (RATE_LIMIT if e.status == 429 else 1))
            continue
        out.input_tokens += got.input_tokens
        out.output_tokens += got.output_tokens
        wrong = check(got.text)
        if wrong is None:
            out.reply = got.text
            break
        out.errors.append(wrong)
        reminder = f"\nThe last reply was refused: {wrong}"
    return out


def complete(logs: DataFrame, make: Callable[[], object], system: str, check: Callable[[str], str | None], text: str = "text", timeout: float = 120.0, attempts: int = ATTEMPTS, backoff: float = BACKOFF) -> DataFrame:
    """Adds outcome, a struct, to each row. Each task makes its own provider once and calls it for its rows;
    a row's failure is data, never a failed task."""

    def run(batches):
        own = make()
        for batch in batches:
            rows = [attempt(lambda reminder, t=t: own.complete(system + reminder, t, timeout), check, attempts, backoff) for t in batch["_t"]]
            yield pd.DataFrame({"_x": batch["_x"], "reply": [r.reply for r in rows], "attempts": [r.attempts for r in rows], "error": [r.errors[-1] if r.reply is None and r.errors else None for r in rows],
                                "provider_unavailable": [r.provider_unavailable for r in rows], "input_tokens": [r.input_tokens for r in rows], "output_tokens": [r.output_tokens for r in rows]})

    rows = logs.select(F.struct(*[logs[c] for c in logs.columns]).alias("_x"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    got = rows.mapInPandas(run, f"_x {rows.schema['_x'].dataType.simpleString()}, {OUTCOME}")
    names = [c.split()[0] for c in OUTCOME.split(", ")]
    return got.select("_x.*", F.struct(*names).alias("outcome"))
