"""Text clean-up and JSON block location as native Spark expressions.

The block finder follows the rule of the extraction scripts: start at the first
``{`` of the fence-stripped text and return the shortest balanced block, where
braces inside JSON strings (with backslash escapes) do not count.  Rows whose
block is deeper than the regex bound fall back to an exact fold over string /
brace tokens; both paths are JVM expressions, no Python worker is involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip()/re "\s" white space (Unicode): ASCII \s plus the
# information separators and the Unicode space characters.
PY_WS = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

# Fixed value: the fence pattern of the extraction scripts (any case).
FENCE_RE = r"(?i)```(?:json)?" + PY_WS + "*"

# A JSON string: quote, then plain runs or backslash escapes, then quote.
_STR = r'"(?:[^"\\]++|\\[\s\S])*+"'

# Nesting depth the single-regex path handles; deeper rows use the token fold.
REGEX_DEPTH = 4


def _block_pattern(depth: int) -> str:
    b = r'\{(?:[^{}"]++|' + _STR + r')*+\}'
    for _ in range(depth - 1):
        b = r'\{(?:[^{}"]++|' + _STR + "|" + b + r')*+\}'
    return b


# Anchored at the first brace: the possessive prefix cannot give a brace back,
# so a first object that never closes is not skipped in favour of a later one.
BLOCK_RE = r"^[^{]*+(" + _block_pattern(REGEX_DEPTH) + ")"

# Tokens from the first brace on: a JSON string (closed or running to the end),
# a single brace, or a run of anything else.
TOKEN_RE = r'"(?:[^"\\]++|\\[\s\S])*+"?|[{}]|[^{}"]++'


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Strip Unicode white space at both ends (Python ``str.strip``)."""
    return F.regexp_replace(_c(c), "^" + PY_WS + "+|" + PY_WS + "+$", "")


def strip_fences(c) -> Column:
    """Remove ```json / ``` marks (any case) with the white space after them, then strip."""
    return strip_ws(F.regexp_replace(_c(c), FENCE_RE, ""))


def _block_tokens(s: Column) -> Column:
    """String / brace / other-text tokens from the first brace on."""
    tail = F.substring(s, F.instr(s, "{"), F.lit(2_147_483_647))
    return F.regexp_extract_all(tail, F.lit(TOKEN_RE), 0)


def _block_end(toks: Column) -> Column:
    """Number of tokens up to the brace that closes the first one, else -1."""
    init = F.struct(F.lit(0).alias("d"), F.lit(0).alias("n"), F.lit(-1).alias("e"))

    def step(acc, t):
        d = acc["d"] + F.when(t == "{", 1).when(t == "}", -1).otherwise(0)
        n = acc["n"] + 1
        return F.when(acc["e"] >= 0, acc).otherwise(
            F.struct(d.alias("d"), n.alias("n"), F.when(d == 0, n).otherwise(-1).alias("e")))

    return F.aggregate(toks, init, step)["e"]


def _token_fold_block(s: Column) -> Column:
    """Exact scan for rows the bounded regex cannot settle (deep or unclosed)."""
    toks = _block_tokens(s)
    end = _block_end(toks)
    return F.when(end > 0, F.array_join(F.slice(toks, 1, end), ""))


def first_json_block(c, already_clean: bool = False) -> Column:
    """First balanced ``{...}`` block of the fence-stripped text, else null.

    Pass a column *name* (or set ``already_clean``) so the cleaned text is not
    rebuilt for each reference; see ``with_json_block`` for the staged form.
    """
    s = _c(c) if already_clean else strip_fences(c)
    hit = F.regexp_extract(s, BLOCK_RE, 1)
    return (F.when(s.isNull() | (F.instr(s, "{") == 0), F.lit(None).cast("string"))
            .when(hit != "", hit)
            .otherwise(_token_fold_block(s)))


def with_json_block(df, raw: str, out: str = "json_str", clean: str | None = None,
                    already_clean: bool = False):
    """Add ``out`` (the first JSON block of ``raw``) in staged projections."""
    cl = clean or f"_{out}_clean"
    hit, toks, end = f"_{out}_hit", f"_{out}_toks", f"_{out}_end"
    d = df.withColumn(cl, F.col(raw) if already_clean else strip_fences(raw))
    d = d.withColumn(hit, F.regexp_extract(F.col(cl), BLOCK_RE, 1))
    has_brace = F.col(cl).isNotNull() & (F.instr(F.col(cl), "{") > 0)
    # only rows with a brace and no regex hit are tokenised and folded
    d = d.withColumn(toks, F.when(has_brace & (F.col(hit) == ""), _block_tokens(F.col(cl))))
    d = d.withColumn(end, _block_end(F.col(toks)))
    blk = (F.when(~has_brace | F.col(cl).isNull(), F.lit(None).cast("string"))
           .when(F.col(hit) != "", F.col(hit))
           .when(F.col(end) > 0, F.array_join(F.slice(F.col(toks), 1, F.col(end)), "")))
    d = d.withColumn(out, blk).drop(hit, toks, end)
    return d if clean else d.drop(cl)


def block_detail(c, block: Column, already_clean: bool = False) -> Column:
    """Why no block was found: ``no_brace`` or ``unclosed`` (null when found)."""
    s = _c(c) if already_clean else strip_fences(c)
    return (F.when(block.isNotNull(), F.lit(None).cast("string"))
            .when(s.isNull() | (F.instr(s, "{") == 0), "no_brace")
            .otherwise("unclosed"))


def outer_brace_slice(c) -> Column:
    """From the first ``{`` to the last ``}`` of the stripped text; null unless last > first."""
    s = strip_ws(F.coalesce(_c(c), F.lit("")))
    a = F.instr(s, "{")
    b = F.length(s) - F.instr(F.reverse(s), "}") + 1
    ok = (a > 0) & (F.instr(s, "}") > 0) & (b > a)
    return F.when(ok, F.substring(s, a, b - a + 1))


# Quote characters folded to their plain form in title matching.
CURLY_QUOTES = "\u2018\u2019\u201a\u201b\u201c\u201d\u201e\u201f\u00b4`"
PLAIN_QUOTES = "''''\"\"\"\"''"


def normalise_title(c) -> Column:
    """Fold quotes, case and runs of white space so titles compare as keys."""
    t = F.translate(_c(c), CURLY_QUOTES, PLAIN_QUOTES)
    t = F.regexp_replace(t, PY_WS + "+", " ")
    return F.lower(strip_ws(t))


def format_flags(c, block: Column | None = None) -> Column:
    """Struct of output-format checks of a raw answer."""
    raw = _c(c)
    s = strip_ws(raw)
    blk = block if block is not None else first_json_block(raw)
    clean = strip_fences(raw)
    return F.struct(
        s.startswith("{").alias("starts_brace"),
        s.endswith("}").alias("ends_brace"),
        raw.contains("```").alias("has_fence"),
        (blk.isNotNull() & (F.length(clean) > F.length(blk))).alias("extra_text"),
    )
