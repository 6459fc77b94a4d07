"""Deterministic stand-ins for the enrichment service, used by tests and by
the oracle-checked queries. They are small per-row helpers: the work
around them (partitioning, retries, routing) is the Spark job."""

from __future__ import annotations

import json

from dossier.functions.text import PROMPT_TAIL_MARKER, PROMPT_TEXT_MARKER
from dossier.operators.parse import ANSWER_KEYS


def excerpt_words(prompt: str) -> list[str]:
    ex = prompt.split(PROMPT_TEXT_MARKER)[-1].split(PROMPT_TAIL_MARKER)[0]
    return [w for w in ex.split(" ") if w]


def rule_reply(prompt: str) -> str:
    """A rule-based 'model': the first words of the excerpt fill the
    answer fields, N/A where the excerpt is too short; confidence is the
    word count capped at 100."""
    w = excerpt_words(prompt)
    vals = [w[0] if len(w) > 0 else "N/A",
            (w[1] + " university") if len(w) > 1 else "N/A",
            "N/A",
            w[2] if len(w) > 2 else "N/A",
            str(min(100, len(w)))]
    return json.dumps(dict(zip(ANSWER_KEYS, vals)), ensure_ascii=False)


def birth_reply(prompt: str) -> str:
    """A rule-based 'model' for birth years: of the words after the prompt's last
    colon, none gives N/A, an odd number a graduation, else a year."""
    n = len([w for w in prompt.rsplit("nothing else: ", 1)[-1].split(" ") if w])
    return "N/A" if not n else f"Graduated in {1960 + n % 50}" if n % 2 else str(1940 + n % 60)


class RecordedService:
    """Answers from a reply recorded in a table: ``given`` is
    '<characters>:<reply>', null where there is none. Fails without a record
    (unless there is an ``otherwise``), and with its own time-out beyond
    ``limit`` characters."""

    def __init__(self, limit: int | None = None, otherwise: str | None = None):
        self.limit, self.otherwise = limit, otherwise

    def __call__(self, prompt: str, given: str | None) -> str:
        if given is None:
            if self.otherwise is None:
                raise LookupError("no record for this entity")
            return self.otherwise
        size, _, reply = given.partition(":")
        if self.limit is not None and int(size) > self.limit:
            raise TimeoutError(f"{size} characters")
        return reply


class FailsFirst:
    """Fails the first n tries of a prompt, n being the number its last word
    ends with, modulo ``of``; then names the profile."""

    def __init__(self, of: int = 4):
        self.of = of

    def __call__(self, prompt: str, attempt: int) -> str:
        if attempt <= int(prompt.rsplit("#", 1)[-1]) % self.of:
            raise ConnectionError(f"try {attempt}")
        return f"profile of {prompt}"
