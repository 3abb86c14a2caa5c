"""Rule-based stand-ins for models and services, used by the registered
queries and tests (no weights, no network).  Their answers follow the same
variant rule as ``shapekit.sources.derived.gen_answer``, keyed by the text."""

from __future__ import annotations

import json

RETRY_NOTE = "Your previous answer was invalid or cut off. Return one complete JSON object only."


def answer(k: int, text: str) -> str:
    """Variant ``k`` around the whole text (first line the title, further lines in turn)."""
    title, *rest = text.split("\n")
    enc = lambda v: json.dumps(v, ensure_ascii=False)
    t, items, steps = enc(title), rest[0::2], rest[1::2]

    def obj(head="", ing=None, key="steps", last=("x",), tail=""):
        return f'{{{head}"title":{t},"ingredients":{enc(items) if ing is None else ing},"{key}":{enc([*steps, *last])}{tail}}}'
    bare = str.maketrans("{}", "()")
    forms = {
        0: lambda: obj(),
        1: lambda: f"```json\n{obj()}\n```",
        2: lambda: f"Sure, here it is: {obj()} Done.",
        3: lambda: "{" + obj()[1:-1].translate(bare),
        4: lambda: text.translate(bare),
        5: lambda: obj(tail=","),
        6: lambda: obj(head='"note":1,'),
        7: lambda: obj(key="directions"),
        8: lambda: obj(ing=t, last=()),
        9: lambda: obj(last=('a } b { " c',)) + " {}",
    }
    return forms[k]()


def make_rule_model():
    """Model stub: variant len(text) % 10, or (len(text) // 10) % 10 under the retry note."""
    def fn(prompts, max_new_tokens, system):
        out = []
        for p in prompts:
            k = (len(p) // 10) % 10 if system.endswith(RETRY_NOTE) else len(p) % 10
            out.append(answer(k, p))
        return out
    return fn


class _Transient(Exception):
    pass


class FlakyService:
    """Service stub: fails len(text) % 7 times per request (transient), raises a
    permanent error when len(text) % 11 == 10, then answers variant len(text) % 10."""

    def __init__(self):
        self.calls = 0

    def start_row(self, tries=0):
        self.calls = tries

    def __call__(self, prompt):
        from shapekit.operators.score import PermanentError
        n = self.calls
        self.calls += 1
        if len(prompt) % 11 == 10:
            raise PermanentError("bad request")
        if n < len(prompt) % 7:
            raise _Transient("rate limited")
        return answer(len(prompt) % 10, prompt)


def make_flaky_service():
    return FlakyService()


def make_length_tokenizer():
    return lambda text: [len(w) for w in text.split(" ")]
