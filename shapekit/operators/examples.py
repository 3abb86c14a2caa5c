"""Training examples: chat rendering, tokenisation, padding and label masks.

Rendering and the default tokeniser are native expressions; a user tokeniser
(any callable text -> ids) runs in an Arrow batch UDF, loaded once per worker.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shapekit.functions.arrays import attention_mask, mask_prefix, pad_truncate


@dataclass(frozen=True)
class ChatTemplate:
    """Role-tagged text layout; ``{role}`` is filled with the role name."""

    prefix: str = "<|im_start|>{role}\n"
    suffix: str = "<|im_end|>\n"
    generation: str = "<|im_start|>assistant\n"

    def turn(self, role: Column, content: Column) -> Column:
        pre = self.prefix.split("{role}")
        return F.concat(F.lit(pre[0]), role, F.lit(pre[1] if len(pre) > 1 else ""),
                        content, F.lit(self.suffix))


CHATML = ChatTemplate()


def render_messages(system: Column, user: Column, answer: Column | None = None,
                    template: ChatTemplate = CHATML) -> Column:
    """system + user (+ assistant answer); without answer it ends at the assistant marker."""
    parts = [template.turn(F.lit("system"), system), template.turn(F.lit("user"), user)]
    if answer is None:
        parts.append(F.lit(template.generation))
    else:
        parts.append(template.turn(F.lit("assistant"), answer))
    return F.concat(*parts)


def render_chat(df: DataFrame, template: ChatTemplate = CHATML, with_answer: bool = True,
                user_prefix: str = "", user_suffix: str = "") -> DataFrame:
    """(id, system, text, json) -> adds ``prompt`` (and ``full`` when ``with_answer``)."""
    user = F.concat(F.lit(user_prefix), F.col("text"), F.lit(user_suffix))
    d = df.withColumn("prompt", render_messages(F.col("system"), user, None, template))
    if with_answer:
        d = d.withColumn("full", render_messages(F.col("system"), user, F.col("json"), template))
    return d


def render_conversations(turns: DataFrame, template: ChatTemplate = CHATML, conv: str = "conv_id",
                         add_generation: bool = False) -> DataFrame:
    """Multi-turn rows (conv_id, turn, role, text) -> one rendered string per conversation."""
    g = turns.groupBy(conv).agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    body = F.array_join(F.transform("t", lambda x: template.turn(x["role"], x["text"])), "")
    if add_generation:
        body = F.concat(body, F.lit(template.generation))
    return g.select(conv, body.alias("rendered"))


# Fixed values of the offline tokeniser: ASCII word runs or single other
# non-space characters; ids from the first 8 hex digits of md5, offset past
# the special ids.
WORD_PIECE_RE = r"[A-Za-z0-9_]+|[^A-Za-z0-9_\s]"
VOCAB = 32000
N_SPECIAL = 3
PAD_ID = 0


def word_tokens(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(col, F.lit(WORD_PIECE_RE), 0)


def word_ids(c, vocab: int = VOCAB, hash_fn: str = "md5") -> Column:
    """Native default tokeniser: text -> ARRAY<INT> (no special tokens added).

    ``md5`` ids are reproducible in other engines (the SQL oracles use them);
    ``xxhash64`` gives different ids about three times faster.
    """
    if hash_fn == "xxhash64":
        return F.transform(word_tokens(c), lambda t: (
            F.pmod(F.xxhash64(t), F.lit(vocab - N_SPECIAL)) + N_SPECIAL).cast("int"))
    return _ids(word_tokens(c), vocab)


def _ids(tokens: Column, vocab: int = VOCAB) -> Column:
    return F.transform(tokens, lambda t: (
        F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("bigint") % (vocab - N_SPECIAL) + N_SPECIAL
    ).cast("int"))


def tokenizer_udf(make_tokenizer):
    """Arrow UDF around a user tokeniser factory (called once per worker process)."""
    cache = {}

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def tok(texts):
        import pandas as pd
        fn = cache.get("fn")
        if fn is None:
            fn = cache["fn"] = make_tokenizer()
        return pd.Series([None if t is None else list(fn(t)) for t in texts])
    return tok


def _native_ids(df: DataFrame, max_len: int, count_tokens=None) -> DataFrame:
    """Adds ``prefix_len``, ``full_len`` (of all tokens) and ``_full_ids``, the native ids of the first ``max_len``.

    No token runs over a line end, so a prompt that ends with one and begins the full text is cut into tokens once."""
    rest = F.substring("full", F.length("prompt") + 1, F.length("full"))
    shared = F.startswith("full", "prompt") & F.endswith("prompt", F.lit("\n"))
    d = (df.withColumn("_prompt", word_tokens("prompt"))
           .withColumn("_tokens", F.when(shared, F.concat("_prompt", word_tokens(rest))).otherwise(word_tokens("full"))))
    return (d.withColumn("prefix_len", count_tokens(F.col("prompt")) if count_tokens else F.size("_prompt"))
             .withColumn("full_len", F.size("_tokens"))
             .withColumn("_full_ids", _ids(F.slice("_tokens", 1, max_len))).drop("_prompt", "_tokens"))


def tokenize_examples(df: DataFrame, max_len: int, tokenize=word_ids, pad_id: int = PAD_ID,
                      mask_padding: bool = False, count_tokens=None) -> DataFrame:
    """(…, prompt, full) -> input_ids, attention_mask, labels (fixed length) + lengths.

    labels = ids with the first min(prefix_len, max_len) positions at -100;
    padding is not masked unless ``mask_padding``.  Right padding.  Only the
    prompt's token count is needed: ``count_tokens`` (default: the size of
    the native token list, or of ``tokenize``'s ids) avoids computing ids twice.
    """
    if tokenize is word_ids:
        d = _native_ids(df, max_len, count_tokens)
    else:
        count_tokens = count_tokens or (lambda c: F.size(tokenize(c)))
        d = (df.withColumn("_full_ids", tokenize(F.col("full")))
               .withColumn("prefix_len", count_tokens(F.col("prompt")))
               .withColumn("full_len", F.size("_full_ids")))
    d = (d.withColumn("input_ids", pad_truncate("_full_ids", max_len, pad_id))
           .withColumn("attention_mask", attention_mask("_full_ids", max_len)))
    real = F.least(F.col("full_len"), F.lit(max_len))
    d = d.withColumn("labels", mask_prefix("input_ids", "prefix_len", max_len, mask_padding, real))
    return d.drop("_full_ids")


def mask_audit(examples: DataFrame, max_len: int, by=()) -> DataFrame:
    """Shares of truncated, fully masked and padded positions."""
    r = lambda c: F.round(F.avg(F.when(c, 1.0).otherwise(0.0)), 6)
    g = examples.groupBy(*by) if by else examples.groupBy()
    return g.agg(
        F.count(F.lit(1)).alias("n"),
        r(F.col("full_len") > max_len).alias("truncated_share"),
        r(F.col("prefix_len") >= F.least(F.col("full_len"), F.lit(max_len))).alias("fully_masked_share"),
        F.round(F.avg((max_len - F.least(F.col("full_len"), F.lit(max_len))) / max_len), 6).alias("pad_share"))
