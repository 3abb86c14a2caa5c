"""Where and why a JSON text fails to parse, as a native fold over its tokens.

The parser itself only says that a text is no JSON.  For the few texts that fail, this walks the tokens with the
open brackets and what may come next as its state, and stops at the first token that may not:
``<kind> at <offset>``, offset in characters from 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: a string (closed, or running to the end), punctuation, white space, or a bare run
TOKENS = r'"(?:[^"\\]++|\\[\s\S])*+"?|[{}\[\],:]|[\x20\t\r\n]++|[^\x20\t\r\n{}\[\],:"]++'
SCALAR = r"^(?:true|false|null|-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)$"
CLOSED = r'^"(?:[^"\\]++|\\[\s\S])*+"$'
#: the part of a string before its first wrong escape or control character
GOOD_START = r'^"(?:[^"\\\x00-\x1f]|\\["\\/bfnrt]|\\u[0-9a-fA-F]{4})*+'

# what may come next: a value, a value or ], a key, a key or }, a colon, a comma or the bracket's end, nothing
VALUE, FIRST_VALUE, KEY, FIRST_KEY, COLON, NEXT, END = "value", "first value", "key", "first key", "colon", "next", "end"


def _state(**kw) -> Column:
    return F.struct(*[v.alias(k) for k, v in kw.items()])


def json_fault(text: Column) -> Column:
    """``<kind> at <offset>`` of the first fault of a text that is no JSON; null for a null text.

    Kinds: ``empty``, ``unclosed`` (the text ends first), ``unclosed string``, ``bad escape``, ``control character``,
    ``bare word`` (unquoted text, single quotes, NaN, malformed numbers), ``trailing comma``, ``trailing text``,
    ``wrong bracket``, ``wrong colon``, ``missing comma``, ``missing colon``, ``missing key``, ``missing value``; and
    ``other`` (at the end) for a text whose tokens are in order."""
    tokens = F.regexp_extract_all(text, F.lit(TOKENS), 0)
    none = F.lit(None).cast("string")
    start = _state(open=F.lit(""), want=F.lit(VALUE), at=F.lit(0), comma=F.lit(-1), kind=none, fault=F.lit(0))

    def step(s: Column, t: Column) -> Column:
        want, stack, at = s["want"], s["open"], s["at"]
        first = F.substring(t, 1, 1)
        top = F.right(stack, F.lit(1))
        blank = first.isin(" ", "\t", "\r", "\n")
        string, opens, closes = first == '"', first.isin("{", "["), first.isin("}", "]")
        comma, colon = first == ",", first == ":"
        scalar = ~(blank | string | opens | closes | comma | colon)
        takes_value, takes_key = want.isin(VALUE, FIRST_VALUE), want.isin(KEY, FIRST_KEY)
        mate = F.when(first == "}", "{").otherwise("[")
        good = F.length(F.regexp_extract(t, GOOD_START, 0))
        whole = t.rlike(CLOSED)
        # the fault a token makes here, if any, and its offset beyond the token's start
        of_string = (F.when(whole & (good == F.length(t) - 1), none)
                     .when(F.substring(t, good + 1, F.lit(1)) == "\\", F.when(whole | (good + 2 < F.length(t)), "bad escape").otherwise("unclosed string"))
                     .when(~whole & (good == F.length(t)), "unclosed string").otherwise("control character"))
        misplaced = (F.when(want == END, "trailing text").when(want == COLON, "missing colon").when(want == NEXT, "missing comma")
                     .when(takes_key, F.when(scalar, "bare word").otherwise("missing key")).otherwise("missing value"))
        kind = (F.when(blank, none)
                .when(string, F.when(takes_value | takes_key, of_string).otherwise(misplaced))
                .when(scalar, F.when(takes_value, F.when(t.rlike(SCALAR), none).otherwise("bare word")).otherwise(misplaced))
                .when(opens, F.when(takes_value, none).otherwise(misplaced))
                .when(comma, F.when(want == NEXT, none).otherwise(misplaced))
                .when(colon, F.when(want == COLON, none).when(want == NEXT, "wrong colon").otherwise(misplaced))
                # closing
                .when(want == END, "trailing text").when(top != mate, "wrong bracket")
                .when((s["comma"] >= 0) & want.isin(KEY, VALUE), "trailing comma")
                .when(want.isin(NEXT, FIRST_VALUE, FIRST_KEY), none).otherwise(misplaced))
        inside = string & (takes_value | takes_key)
        place = F.when(inside & (kind != "unclosed string"), at + good).when(kind == "trailing comma", s["comma"]).otherwise(at)
        outer = (F.when(opens, F.concat(stack, first)).when(closes, F.substring(stack, F.lit(1), F.length(stack) - 1))
                 .otherwise(stack))
        done = F.when(F.length(outer) == 0, END).otherwise(NEXT)
        then = (F.when(blank, want).when(opens, F.when(first == "{", FIRST_KEY).otherwise(FIRST_VALUE))
                .when(string & takes_key, COLON).when(string | scalar | closes, done).when(colon, VALUE)
                .otherwise(F.when(top == "{", KEY).otherwise(VALUE)))
        return F.when(s["kind"].isNotNull(), s).otherwise(_state(
            open=outer, want=then, at=at + F.length(t), comma=F.when(comma, at).when(blank, s["comma"]).otherwise(-1),
            kind=kind, fault=F.when(kind.isNotNull(), place).otherwise(0)))

    def told(s: Column) -> Column:
        at_end = F.when(s["want"] == END, "other").when(F.trim(text) == "", "empty").otherwise("unclosed")
        return F.concat(F.coalesce(s["kind"], at_end), F.lit(" at "), F.when(s["kind"].isNotNull(), s["fault"]).otherwise(s["at"]).cast("string"))

    return F.when(text.isNotNull(), F.aggregate(tokens, start, step, told))
