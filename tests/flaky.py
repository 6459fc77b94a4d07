"""A scripted service for the tests of retries and deadlines."""

import json
import time

from dossier.operators.parse import ANSWER_KEYS


class FlakyService:
    """Keyed stub with scripted failures (integer keys):
    k % 7 == 0 always raises; k % 50 == 1 sleeps past any short deadline;
    k % 3 == 0 raises on the first call only; k % 10 == 4 replies with
    plain text (a parse error); all others reply with a valid object."""

    def __init__(self, sleep: float = 0.5, heal: bool = False):
        self.sleep, self.heal, self.calls = sleep, heal, {}

    def __call__(self, prompt: str, key) -> str:
        k = int(key)
        n = self.calls[k] = self.calls.get(k, 0) + 1
        if k % 7 == 0 and not self.heal:
            raise RuntimeError("service unavailable")
        if k % 50 == 1 and not self.heal:
            time.sleep(self.sleep)
        if k % 3 == 0 and n == 1 and not self.heal:
            raise ConnectionError("connection reset")
        if k % 10 == 4:
            return f"I could not find information about {prompt}"
        return json.dumps({ANSWER_KEYS[0]: f"major {k % 13}", ANSWER_KEYS[1]: f"college {k % 17}",
                           ANSWER_KEYS[2]: "N/A", ANSWER_KEYS[3]: f"job {k % 5}",
                           ANSWER_KEYS[4]: str(k % 101)})
